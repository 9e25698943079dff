"""Column -> column cleaners for dirty landing text (bronze is all string).

Every cleaner is a native Catalyst expression (no Python UDF), so filters on
cleaned columns still reach the scan and the projection stays inside
whole-stage codegen. Each parser has a matching ``*_bad`` predicate: true when
the input is not a null spelling yet did not parse. Callers decide whether a
bad value fails the batch or sends the row to quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of "no value" (compared trimmed and lower-cased).
NULL_SPELLINGS = ("", "n/a", "null", "none")

# Accepted date layouts, day-first (d/M/yyyy) then ISO (yyyy-M-d).
DAY_FIRST_PATTERN = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"
ISO_DATE_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"

# Accepted timestamp layout, a whole date with an optional time
# of day and zone. A bare time of day is not one (it would mean "today").
TIMESTAMP_PATTERN = (r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
                     r"([T ][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$")

# Brazilian number layout. Thousands with '.', decimals with ','.
# Either grouped thousands or a plain digit run, optional sign and decimals.
BR_NUMBER_PATTERN = r"^[+-]?([0-9]{1,3}(\.[0-9]{3})*|[0-9]+)(,[0-9]+)?$"
#: Money: a third decimal that isn't zero would be rounded away, so it makes the value a bad one.
MONEY_PATTERN = r"^[+-]?([0-9]{1,3}(\.[0-9]{3})*|[0-9]+)(,[0-9]{1,2}0*)?$"

# Accented letters and their plain forms (same length, in order).
ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝ"
UNACCENTED = "aaaaaaeeeeiiiiooooouuuucnyyAAAAAAEEEEIIIIOOOOOUUUUCNY"

MONEY_TYPE = "decimal(18,2)"

# Whitespace trimmed at both ends, as code points: the ASCII
# whitespace set (tab, line feed, vertical tab, form feed, carriage return,
# space), the information separators, next line, and every Unicode space separator (no-break space, ogham space,
# en quad .. hair space, line and paragraph separators, narrow no-break space,
# medium mathematical space, ideographic space).
EDGE_SPACE_CODES = (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198,
                    8199, 8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288)
EDGE_SPACE = "".join(chr(c) for c in EDGE_SPACE_CODES)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Trim whitespace and Unicode space separators at both ends.

    A native trim over a fixed character set: plain ``trim`` keeps a
    no-break space, and a regex would decode every value to a Java string.
    """
    return F.trim(_c(c), F.lit(EDGE_SPACE))


def is_null_variant(c) -> Column:
    """True for SQL NULL or any null spelling, in any case, with any padding."""
    c = _c(c)
    return c.isNull() | F.lower(strip(c)).isin(*NULL_SPELLINGS)


# Parsers from already stripped text (the table cleaner strips each column once).

def date_from_stripped(s: Column) -> Column:
    """Day-first or ISO text -> date, without exceptions.

    A text of the whole shape ``d/M/yyyy`` is reordered to ISO with native
    string functions; both layouts go through the string-to-date cast, guarded
    by a full-shape match (the cast alone would accept partial dates such as
    ``2026`` or trailing text). Impossible days (31/02), two-digit years and
    extra parts (``1/2/3/2026``) give NULL.
    """
    day_first = F.concat(F.substring_index(s, "/", -1), F.lit("-"),
                         F.substring_index(F.substring_index(s, "/", 2), "/", -1), F.lit("-"),
                         F.substring_index(s, "/", 1))
    # The slash decides the layout, so each value meets one pattern.
    iso = (F.when(F.instr(s, "/") > 0, F.when(s.rlike(DAY_FIRST_PATTERN), day_first))
           .when(s.rlike(ISO_DATE_PATTERN), s))
    return iso.try_cast("date")


def number_from_stripped(s: Column, to: str = MONEY_TYPE) -> Column:
    canonical = F.translate(s, ",.", ".")        # ',' -> '.', thousands '.' dropped
    return F.when(s.rlike(MONEY_PATTERN if to == MONEY_TYPE else BR_NUMBER_PATTERN), canonical.try_cast(to))


def integer_from_stripped(s: Column) -> Column:
    """The part before the decimal comma: truncation toward zero of the exact value, no rounding first."""
    return F.when(s.rlike(BR_NUMBER_PATTERN), F.substring_index(F.translate(s, ".", ""), ",", 1).try_cast("bigint"))


def measure_from_stripped(s: Column) -> Column:
    """All decimals of a sensor value, as a double."""
    return number_from_stripped(s, "double")


def text_from_stripped(s: Column) -> Column:
    return F.lower(s)


def boolean_from_stripped(s: Column) -> Column:
    return F.lower(s) == F.lit("true")


def timestamp_from_stripped(s: Column) -> Column:
    return F.when(s.rlike(TIMESTAMP_PATTERN), s.try_cast("timestamp"))


def null_variant_from_stripped(raw: Column, s: Column) -> Column:
    return raw.isNull() | F.lower(s).isin(*NULL_SPELLINGS)


# Column -> column cleaners (each strips its own input).

def parse_date(c) -> Column:
    return F.when(~is_null_variant(c), date_from_stripped(strip(c)))


def parse_date_bad(c) -> Column:
    return ~is_null_variant(c) & parse_date(c).isNull()


def parse_number(c, to: str = MONEY_TYPE) -> Column:
    """Brazilian number text -> decimal. Guarded: ``1250.5``, ``nan``, ``1d`` fail."""
    return F.when(~is_null_variant(c), number_from_stripped(strip(c), to))


def parse_number_bad(c, to: str = MONEY_TYPE) -> Column:
    return ~is_null_variant(c) & parse_number(c, to).isNull()


def parse_integer(c) -> Column:
    """Number text -> bigint, truncating toward zero like an int cast."""
    return F.when(~is_null_variant(c), integer_from_stripped(strip(c)))


def parse_measure(c) -> Column:
    """Number text -> double for sensor values, with all its decimals."""
    return F.when(~is_null_variant(c), measure_from_stripped(strip(c)))


def clean_text(c) -> Column:
    """Null spelling -> NULL; else trimmed and lower-cased."""
    return F.when(~is_null_variant(c), F.lower(strip(c)))


def null_if_variant(c) -> Column:
    """Null spelling -> NULL; else the value untouched (not even trimmed)."""
    return F.when(~is_null_variant(c), _c(c))


def parse_boolean(c) -> Column:
    """Null spelling -> NULL; 'true' in any case -> true; anything else -> false."""
    return F.when(~is_null_variant(c), boolean_from_stripped(strip(c)))


def parse_timestamp(c) -> Column:
    return F.when(~is_null_variant(c), timestamp_from_stripped(strip(c)))


def parse_timestamp_bad(c) -> Column:
    return ~is_null_variant(c) & parse_timestamp(c).isNull()


def strip_accents(c) -> Column:
    return F.translate(_c(c), ACCENTED, UNACCENTED)


def format_number_locale(c, places: int = 2) -> Column:
    """1250.5 -> '1.250,50' (inverse of :func:`parse_number`)."""
    return F.translate(F.format_number(_c(c), places), ",.", ".,")


def hours_to_days(c) -> Column:
    """Whole days needed to cover a number of hours (ceiling)."""
    return F.ceil(_c(c) / F.lit(24)).cast("int")


# Category -> (parser from stripped text, can the value be unparseable?).
# The table cleaner strips each column once and reuses it.
STRIPPED_PARSERS = {
    "dates": (date_from_stripped, True),
    "integers": (integer_from_stripped, True),
    "money": (number_from_stripped, True),
    "measures": (measure_from_stripped, True),
    "texts": (text_from_stripped, False),
    "booleans": (boolean_from_stripped, False),
    "timestamps": (timestamp_from_stripped, True),
}
