"""Sinks and table helpers on plain parquet (no table-format jar needed).

A *versioned table* is a folder of immutable version folders and small manifests::

    <path>/versoes/v000000007-3f9c21ab/_balde=3/part-*.parquet
    <path>/manifesto/v000000007.json      buckets (folder and bytes each), their number, schema

Writers put a whole new version beside the old ones and then publish it by
putting one manifest into place if no other has that number, so readers see the
table before or after a write, never in between, and a crash leaves only an
unreferenced folder. Two writers may work at once: each has its own folder, and
the one that publishes second checks what the first changed. If it touched
other buckets both merges stand; otherwise the second merges again onto the new
version.

Buckets grow by linear hashing: a table of N buckets, 2**L <= N < 2**(L+1),
keeps a key in its hash modulo 2**(L+1) if that is below N, else modulo 2**L.
When the bytes ask for more buckets, the next ones in order are split off, by
one more hash bit each; a merge rewrites the buckets it touches and those it
splits, no others.

* :func:`upsert` - merge by business key, update-all / insert-all, idempotent.
  The source is evaluated once (staged).
* :func:`replace` - publish a whole new content.
* :func:`read_table` - the published content, with the table's full schema.
* :func:`read_or_empty` - a missing input path is an empty frame, not an error.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.silver import latest_by_key
from ..session import fresh_path

BUCKET = "_balde"
BUCKET_BYTES = 256 << 20        # a bucket's limit: buckets are split so that an average one stays below it
WRITER_BYTES = 16 << 20         # stored bytes that one task sorts and writes, about: a bucket of more is written by several
KEPT_VERSIONS = 2               # older versions that running readers may still use
ORPHAN_HOURS = 48               # folders that no manifest ever named are a crashed writer's after this time
ATTEMPTS = 6                    # merges of one source onto ever newer versions before giving up


class CommitConflict(RuntimeError):
    """Another writer changed what this one has read; the table is as the other left it."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``, sorted; none if it is absent."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_or_empty(spark: SparkSession, path: str, schema: StructType, fmt: str = "json",
                  **options) -> DataFrame:
    """Read ``path`` with ``schema``; an absent path yields an empty frame.

    Only a missing path is tolerated; unreadable data still fails.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


# ---- files put into place whole -------------------------------------------------

def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with all of ``text``, or leave the file that is there; whether this call created it.

    The text is written beside and put into place in one step: a hard link on a
    local file system, a rename that refuses an existing target elsewhere (one
    step on HDFS; a store whose renames are copies needs a lock of its own).
    """
    jvm = spark.sparkContext._jvm
    fs, final = _fs(spark, path)
    fs.mkdirs(final.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{final.getName()}.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            to_nio = lambda p: jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).toPath()     # noqa: E731
            jvm.java.nio.file.Files.createLink(to_nio(final), to_nio(draft))
        else:
            rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(fs.makeQualified(draft), fs.makeQualified(final), spark.sparkContext._gateway.new_array(rename, 0))
        return True
    except Exception:
        if fs.exists(final):
            return False
        raise
    finally:
        fs.delete(draft, False)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, whole."""
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


# ---- versioned tables ---------------------------------------------------------

def _manifest_names(spark: SparkSession, path: str) -> list[str]:
    return [n for n in list_names(spark, f"{path}/manifesto") if n.endswith(".json") and not n.startswith(".")]


def _manifest(spark: SparkSession, path: str) -> dict | None:
    names = _manifest_names(spark, path)
    return json.loads(read_text(spark, f"{path}/manifesto/{names[-1]}")) if names else None


def _publish(spark: SparkSession, path: str, manifest: dict) -> bool:
    """Put a finished manifest into place; False if another writer has published that version."""
    done = put_if_absent(spark, f"{path}/manifesto/v{manifest['versao']:09d}.json", json.dumps(manifest))
    if done:
        _vacuum(spark, path)
    return done


def _vacuum(spark: SparkSession, path: str) -> None:
    """Remove manifests before the last ``KEPT_VERSIONS + 1``, the folders that only they name, and old folders that none names.

    A folder that a running writer has not published yet is in no manifest: it
    goes only after ``ORPHAN_HOURS``.
    """
    names = _manifest_names(spark, path)
    read = lambda n: {b["pasta"] for b in json.loads(read_text(spark, f"{path}/manifesto/{n}"))["baldes"].values()}     # noqa: E731
    used: set[str] = set().union(*(read(n) for n in names[-(KEPT_VERSIONS + 1):]))
    gone: set[str] = set()
    for n in names[:-(KEPT_VERSIONS + 1)]:
        gone |= read(n) - used
        remove(spark, f"{path}/manifesto/{n}")
    fs, folder = _fs(spark, f"{path}/versoes")
    for st in fs.listStatus(folder) if fs.exists(folder) else []:
        v = st.getPath().getName()
        if v in gone or (v not in used and time.time() * 1000 - st.getModificationTime() > ORPHAN_HOURS * 3_600_000):
            fs.delete(st.getPath(), True)


def table_exists(spark: SparkSession, path: str) -> bool:
    return bool(_manifest_names(spark, path))


def _read_buckets(spark: SparkSession, path: str, m: dict, only: set[int] | None = None) -> DataFrame:
    schema = StructType.fromJson(m["esquema"])
    files = [f"{path}/versoes/{x['pasta']}/{BUCKET}={b}" for b, x in sorted(m["baldes"].items()) if only is None or int(b) in only]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The published content of a versioned table; buckets written before a column was added give NULL for it."""
    m = _manifest(spark, path)
    if m is None:
        raise FileNotFoundError(f"no published table at {path}")
    return _read_buckets(spark, path, m)


def _step(buckets: int) -> int:
    """2**L of a table of 2**L <= ``buckets`` < 2**(L+1) buckets."""
    return 1 << (buckets.bit_length() - 1)


def bucket_of(key: str, buckets: int) -> Column:
    """A key's bucket by linear hashing."""
    h, low = F.xxhash64(F.col(key)), _step(buckets)
    wide = h.bitwiseAND(F.lit(2 * low - 1))
    return F.when(wide < buckets, wide).otherwise(h.bitwiseAND(F.lit(low - 1))).cast("int")


def descendants(old: int, new: int) -> dict[int, list[int]]:
    """Which of ``new`` buckets the rows of each of ``old`` buckets are in."""
    out: dict[int, list[int]] = {b: [b] for b in range(old)}
    for b in range(old, new):
        parent = b
        while parent >= old:                    # the bucket that it was split from, by its highest bit
            parent -= 1 << (parent.bit_length() - 1)
        out[parent].append(b)
    return out


def buckets_for(size: int, least: int = 1) -> int:
    """Enough buckets that even those not split yet, twice as large as the others, stay below the limit."""
    return max(least, -(-2 * size // BUCKET_BYTES), 1)


def _write_version(spark: SparkSession, df: DataFrame, path: str, version: int, buckets: list[int], size: int) -> dict:
    """Write ``df`` (with its bucket column) as a version folder of this writer's own; folder and bytes of each bucket.

    ``buckets`` are those that ``df`` may have rows in, ``size`` is about its
    stored bytes. Every task writes one piece of one bucket: no two buckets meet
    in a task, and a piece has about ``WRITER_BYTES``, however large the table.
    """
    name = f"v{version:09d}-{uuid.uuid4().hex[:8]}"
    target = f"{path}/versoes/{name}"
    pieces = max(1, -(-size // (len(buckets) * WRITER_BYTES)))
    # Maps have no hash.
    piece = F.pmod(F.xxhash64(F.lit("piece"), *[F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]), F.lit(pieces))
    place = F.array_position(F.lit(buckets), F.col(BUCKET)) - 1
    (df.repartitionById(pieces * len(buckets), (place * pieces + piece).cast("int"))
       .write.partitionBy(BUCKET).parquet(target))
    fs, p = _fs(spark, target)
    sizes: dict[str, int] = {}
    files = fs.listFiles(p, True)               # one recursive listing
    while files.hasNext():
        f = files.next()
        folder = f.getPath().getParent().getName()
        if folder.startswith(f"{BUCKET}="):
            b = folder.split("=", 1)[1]
            sizes[b] = sizes.get(b, 0) + f.getLen()
    return {b: {"pasta": name, "bytes": n} for b, n in sizes.items()}


def _size(m: dict | None) -> int:
    return sum(x["bytes"] for x in m["baldes"].values()) if m else 0


def _rebased(base: dict | None, now: dict | None, mine: dict, touched: set[int]) -> dict:
    """``mine``, made from ``base``, as the version after ``now``; CommitConflict if ``now`` changed what it was made from."""
    if now is None or (base is not None and now["versao"] == base["versao"]):
        return mine
    same = base is not None and all(now[k] == base[k] for k in ("total_baldes", "esquema", "conteudo", "chave"))
    if not same or any(now["baldes"].get(str(b)) != base["baldes"].get(str(b)) for b in touched):
        raise CommitConflict(f"version {now['versao']} changed what version {mine['versao']} was made from")
    others = {b: x for b, x in now["baldes"].items() if int(b) not in touched}
    own = {b: x for b, x in mine["baldes"].items() if b not in base["baldes"] or x != base["baldes"][b]}
    return {**mine, "versao": now["versao"] + 1, "baldes": {**others, **own}}


def _commit(spark: SparkSession, path: str, base: dict | None, mine: dict, touched: set[int]) -> dict:
    """Publish ``mine``, after whatever others have published meanwhile if that does not conflict."""
    while not _publish(spark, path, mine):
        mine = _rebased(base, _manifest(spark, path), mine, touched)
    return mine


def _discard(spark: SparkSession, path: str, held: dict) -> None:
    for folder in {x["pasta"] for x in held.values()}:
        remove(spark, f"{path}/versoes/{folder}")


def upsert(spark: SparkSession, source: DataFrame, path: str, key: str,
           buckets: int | None = None, order: list[str] | None = None,
           allow_new_columns: bool = False) -> dict:
    """Merge ``source`` into the versioned table at ``path`` by ``key``.

    Source duplicates are resolved first (latest by ``order``), null keys are
    dropped (they can never match). Without ``order`` a source row replaces the
    table's row; with it the later of the two by ``order`` stays, the source's
    on a tie. ``buckets`` is the least number of buckets at the first load;
    more are split off as the bytes grow. If another writer changes the same
    buckets meanwhile, the source is merged again onto its version, up to
    ``ATTEMPTS`` times, then CommitConflict is raised. Returns run facts.
    """
    stage = fresh_path(spark, "upsert-stage")
    latest_by_key(source, key, order).write.parquet(stage)      # the source is evaluated once
    fs, p = _fs(spark, stage)
    try:
        src, size = spark.read.parquet(stage), fs.getContentSummary(p).getLength()
        for attempt in range(1, ATTEMPTS + 1):
            try:
                return {**_merge(spark, src, size, path, key, buckets, order, allow_new_columns), "tentativas": attempt}
            except CommitConflict:
                if attempt == ATTEMPTS:
                    raise
    finally:
        remove(spark, stage)


def _merge(spark: SparkSession, src: DataFrame, size: int, path: str, key: str, buckets: int | None, order: list[str] | None, allow_new_columns: bool) -> dict:
    """One merge of a staged source onto the table's present version."""
    m = _manifest(spark, path)
    if m is None:
        n = buckets_for(size, buckets or 1)
        held = _write_version(spark, src.withColumn(BUCKET, bucket_of(key, n)), path, 1, list(range(n)), size)
        first = {"versao": 1, "total_baldes": n, "chave": key, "conteudo": uuid.uuid4().hex, "baldes": held, "esquema": src.schema.jsonValue()}
        try:
            _commit(spark, path, None, first, set())
        except CommitConflict:
            _discard(spark, path, held)
            raise
        return {"modo": "primeira_carga", "baldes": n}
    schema = StructType.fromJson(m["esquema"])
    new = [f for f in src.schema.fields if f.name not in schema.names]
    if new and not allow_new_columns:
        raise ValueError(f"{path}: source has new columns {[f.name for f in new]}")
    schema = StructType(schema.fields + new)
    old = m["total_baldes"]
    n = buckets_for(_size(m) + size, old) if m["chave"] in (key, None) else old
    below = descendants(old, n)
    # At most one value per bucket.
    touched = {r[0] for r in src.select(bucket_of(key, old)).distinct().collect()} | {b for b, x in below.items() if len(x) > 1}
    target = _read_buckets(spark, path, m, touched)
    if order:
        both = target.withColumn("_novo", F.lit(0)).unionByName(src.withColumn("_novo", F.lit(1)), allowMissingColumns=True)
        merged = latest_by_key(both, key, [c for c in order if c in both.columns] + ["_novo"]).drop("_novo")
    else:
        merged = target.join(src.select(key), key, "left_anti").unionByName(src, allowMissingColumns=True)
    merged = merged.select(*schema.names).withColumn(BUCKET, bucket_of(key, n))
    rewritten = sorted(x for b in touched for x in below[b]) or [0]
    stored = sum(x["bytes"] for b, x in m["baldes"].items() if int(b) in touched)
    held = _write_version(spark, merged, path, m["versao"] + 1, rewritten, stored + size)
    kept = {b: x for b, x in m["baldes"].items() if int(b) not in touched}
    try:
        _commit(spark, path, m, {**m, "versao": m["versao"] + 1, "total_baldes": n, "chave": key, "baldes": {**kept, **held}, "esquema": schema.jsonValue()}, touched)
    except CommitConflict:
        _discard(spark, path, held)
        raise
    return {"modo": "merge", "baldes_reescritos": len(touched), "baldes": n}


def replace(spark: SparkSession, df: DataFrame, path: str, key: str | None = None) -> DataFrame:
    """Publish ``df`` as the table's whole content and read it back; columns may change.

    With ``key`` the content is dealt into buckets by its bytes, as a merge
    would; without, it is one bucket of as many files as ``df`` has partitions.
    A merge that runs at the same time is judged to come before or after, by
    which of the two publishes first; after means that it merges again.
    """
    m = _manifest(spark, path)
    version, n = (m["versao"] if m else 0) + 1, 1
    if key is None:
        name = f"v{version:09d}-{uuid.uuid4().hex[:8]}"
        target = f"{path}/versoes/{name}"
        df.write.parquet(f"{target}/{BUCKET}=0")
        fs, p = _fs(spark, target)
        held = {"0": {"pasta": name, "bytes": fs.getContentSummary(p).getLength()}}
    else:
        stage = fresh_path(spark, "replace-stage")
        try:
            df.write.parquet(stage)
            fs, p = _fs(spark, stage)
            size = fs.getContentSummary(p).getLength()
            n = buckets_for(size)
            held = _write_version(spark, spark.read.parquet(stage).withColumn(BUCKET, bucket_of(key, n)), path, version, list(range(n)), size)
        finally:
            remove(spark, stage)
    mine = {"versao": version, "total_baldes": n, "chave": key, "conteudo": uuid.uuid4().hex, "baldes": held, "esquema": df.schema.jsonValue()}
    while not _publish(spark, path, mine):
        mine["versao"] = _manifest(spark, path)["versao"] + 1
    return _read_buckets(spark, path, mine)


# ---- plain sinks --------------------------------------------------------------

def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None,
              dynamic: bool = False) -> None:
    w = df.write.mode("overwrite")
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back (cuts lineage)."""
    p = fresh_path(spark, name)
    df.write.parquet(p)
    return spark.read.parquet(p)
