"""Bronze -> silver: typed cleaning, quarantine, one row per business key.

* :func:`cleanse` turns an all-string bronze frame into typed columns driven
  by a :class:`~tidewater.spec.TableSpec`, plus ``_motivos`` (comma-separated
  reasons a row cannot be trusted: unparseable value, null key; '' if none).
* :func:`silver` keeps the trusted rows and picks the latest row per key.
* :func:`quarantine` keeps the rest, with the raw record as JSON.
* :func:`latest_by_key` is an aggregate (``max`` of a struct), not a window:
  it is combined map-side, so a key holding a third of the rows does not
  land in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..spec import INGESTED_AT, PARTITION_COLUMN, SILVER_PARTITION_COLUMN, SeedSpec, TableSpec

REASONS = "_motivos"
RAW_LINE = "_linha"             # column of a bronze row whose line could not be read


def _reasoned(bronze: DataFrame, spec: TableSpec, carry: list[str] | None = None) -> DataFrame:
    """Typed columns + ``_motivos``, computed in three stages.

    Spark does not share subexpressions inside CASE branches, so building
    "parsed value" and "is it bad" straight from the raw text would strip and
    parse every value several times. Here each column is stripped once
    (stage 1), null-checked and parsed once (stage 2), and the typed value
    and the reasons read those results (stage 3). Catalyst keeps the stages
    apart (their outputs are used more than once) and fuses them into one
    codegen stage. ``carry`` names extra bronze columns passed through as is.
    """
    carry = [c for c in (carry or [])]
    part = [PARTITION_COLUMN] if PARTITION_COLUMN in bronze.columns else []
    s1, s2, typed, reasons = [], [], [], []
    for name in spec.columns:
        cat = spec.category(name)
        if cat in clean.STRIPPED_PARSERS:
            parse, can_fail = clean.STRIPPED_PARSERS[cat]
            r, st, nv, pv = f"_r_{name}", f"_s_{name}", f"_nv_{name}", f"_p_{name}"
            s1 += [F.col(name).alias(r), clean.strip(name).alias(st)]
            s2 += [clean.null_variant_from_stripped(F.col(r), F.col(st)).alias(nv), parse(F.col(st)).alias(pv)]
            typed.append(F.when(~F.col(nv), F.col(pv)).alias(name))
            if can_fail:
                reasons.append(F.when(~F.col(nv) & F.col(pv).isNull(), F.lit(f"{name}:{cat}")))
        else:
            s1.append(F.col(name))
            s2.append((clean.null_if_variant(name) if cat == "nullable_fks" else F.col(name)).alias(name))
            typed.append(F.col(name))
    s1.append(clean.is_null_variant(spec.key).alias("_nv_key"))
    s2.append(F.col("_nv_key"))
    reasons.append(F.when(F.col("_nv_key"), F.lit(f"{spec.key}:chave_nula")))
    passthrough = [F.col(c) for c in part + carry]
    staged = bronze.select(*s1, *passthrough).select(*s2, *passthrough)
    # concat_ws skips NULLs and stays in codegen (array_compact is a lambda
    # function that would push the whole projection out of codegen).
    return staged.select(*typed, *passthrough, F.concat_ws(",", *reasons).alias(REASONS))


def cleanse(bronze: DataFrame, spec: TableSpec, on_error: str = "quarantine") -> DataFrame:
    """Typed columns in spec order, the ingest partition, and ``_motivos``.

    ``on_error="fail"`` raises on the first bad value (the reference's
    behaviour); ``"quarantine"`` only records the reasons.
    """
    out = _reasoned(bronze, spec, carry=[c for c in (INGESTED_AT,) if c in bronze.columns])
    if PARTITION_COLUMN in out.columns:
        out = out.withColumnRenamed(PARTITION_COLUMN, SILVER_PARTITION_COLUMN)
    if on_error == "fail":
        m = F.col(REASONS)
        out = out.withColumn(REASONS, F.when(m != "", F.raise_error(
            F.concat(F.lit(f"{spec.name}: bad value "), m)).cast("string")).otherwise(m))
    elif on_error != "quarantine":
        raise ValueError("on_error must be 'quarantine' or 'fail'")
    return out


def trusted(bronze: DataFrame, spec: TableSpec, on_error: str = "quarantine") -> DataFrame:
    """Cleaned rows with no reason against them (duplicates not yet resolved)."""
    c = cleanse(bronze, spec, on_error)
    return c.where(F.col(REASONS) == "").drop(REASONS)


def latest_by_key(df: DataFrame, key: str, order: list[str] | None = None,
                  keep: Column | None = None, columns: list[str] | None = None) -> DataFrame:
    """One row per non-null ``key``: the greatest by ``order``, then by all columns.

    Ingest columns come first in the order, so the newest arrival wins; the
    remaining columns make the pick total and deterministic. Implemented as
    ``max(struct(...))`` per key: partial aggregation before the shuffle, so a
    key holding a third of all rows costs one row per input partition.
    ``keep`` restricts the candidates inside the aggregate (rows failing it
    are ignored; keys with no candidate disappear) without a pre-filter that
    Catalyst would push under the projection and evaluate twice. ``columns``
    names the columns that the reader wants beside the key: the greatest row's
    leading columns are the greatest leading columns, so what stands behind the
    last wanted one is neither compared nor shuffled, and the row is the same.
    """
    rest = [c for c in df.columns if c != key]
    order = [c for c in (order or []) if c in rest]
    ordered = order + [c for c in rest if c not in order]
    if columns is not None:
        if unknown := set(columns) - {key, *rest}:
            raise ValueError(f"no such columns: {sorted(unknown)}")
        last = max((ordered.index(c) for c in columns if c != key), default=-1)
        ordered, rest = ordered[:max(len(order), last + 1)], [c for c in rest if c in columns]
    candidate = F.struct(*[F.col(c) for c in ordered] or [F.lit(True)])
    if keep is not None:
        candidate = F.when(keep, candidate)
    # Grouping by (hash(key), key) gives the sort-based aggregate a long sort
    # prefix; business keys such as 'PED-000000123' share their first bytes,
    # which makes a plain string-key sort compare whole strings.
    best = (df.groupBy(F.xxhash64(key).alias("_h"), key).agg(F.max(candidate).alias("_best"))
              .where(F.col(key).isNotNull() & F.col("_best").isNotNull()))
    return best.select(key, *[F.col(f"_best.{c}").alias(c) for c in rest])


def silver(bronze: DataFrame, spec: TableSpec, on_error: str = "quarantine", columns: list[str] | None = None) -> DataFrame:
    """Trusted, typed, one row per business key: the latest by ingest stamp (where stored), then landing day.

    With ``columns`` only the key and those, of the same rows.
    """
    c = cleanse(bronze, spec, on_error)
    cols = [x for x in c.columns if x != REASONS]
    order = [x for x in (INGESTED_AT, SILVER_PARTITION_COLUMN) if x in cols]
    out = latest_by_key(c.select(*cols, (F.col(REASONS) == "").alias("_ok")),
                        spec.key, order, keep=F.col("_ok"), columns=cols if columns is None else columns)
    return out.select(*[x for x in cols if columns is None or x == spec.key or x in columns])


def quarantine(bronze: DataFrame, spec: TableSpec, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows that cannot be trusted: key, reasons, and the raw record as JSON, or the line itself where it is no JSON.

    The raw columns ride along untouched; the JSON is built only for the
    (rare) rows that fail. Failing rows are emitted by exploding a one-or-zero
    element array rather than by a filter: Catalyst would push a filter on
    the reasons down through every projection and evaluate the parsing (and
    whatever produced the raw text) again inside it. ``carry`` names columns of
    ``bronze`` to keep beside the record.
    """
    raw = list(bronze.columns)
    carried = bronze.select(*raw, *[F.col(c).alias(f"_q_{c}") for c in raw])
    r = _reasoned(carried, spec, carry=[f"_q_{c}" for c in raw])
    record = F.to_json(F.struct(*[F.col(f"_q_{c}").alias(c) for c in raw]), {"ignoreNullFields": "false"})
    reasons = F.col(REASONS)
    if RAW_LINE in raw:
        line = F.col(f"_q_{RAW_LINE}")
        record = F.coalesce(line, record)
        reasons = F.when(line.isNotNull(), F.lit("linha:malformada")).otherwise(reasons)
    failing = F.when(F.col(REASONS) != "", F.array(F.struct(reasons.alias("motivos"), record.alias("registro_bruto"))))
    return (r.select(F.lit(spec.name).alias("tabela"), F.col(f"_q_{spec.key}").alias("chave"), *[F.col(f"_q_{c}").alias(c) for c in carry],
                     F.explode(F.coalesce(failing, F.array().cast(
                         "array<struct<motivos:string,registro_bruto:string>>"))).alias("_f"))
             .select("tabela", "chave", "_f.motivos", "_f.registro_bruto", *carry))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys seen more than once, with their row count (map-side combined)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("linhas"))
              .where(F.col("linhas") > 1))


def promote_seed(bronze: DataFrame, spec: SeedSpec) -> DataFrame:
    """Seed text -> typed silver: booleans and integers cast, the rest text."""
    cols = []
    for c in spec.columns:
        if c in spec.booleans:
            cols.append(clean.parse_boolean(c).alias(c))
        elif c in spec.integers:
            cols.append(F.col(c).try_cast("bigint").alias(c))
        else:
            cols.append(F.col(c).cast("string").alias(c))
    return bronze.select(*cols)


def bronze_copy(df: DataFrame) -> DataFrame:
    """Every column as text: the faithful bronze copy of a seed."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
