"""Text and number normalisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters of Unicode white space.
_WHITE_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def strip(c: Column | str) -> Column:
    """Drop leading and trailing white space of any kind (plain ``trim`` drops spaces only)."""
    return F.btrim(_c(c), F.lit(_WHITE_SPACE))


def upper_strip(c: Column | str) -> Column:
    return F.upper(strip(c))


def title_case(c: Column | str) -> Column:
    """Capital after every non-letter, so ``CROHN'S`` gives ``Crohn'S``.

    ``initcap`` only starts a word after white space.
    """
    runs = F.regexp_extract_all(F.lower(strip(c)), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    capital = F.transform(
        runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), r.substr(F.lit(2), F.length(r)))
    )
    return F.array_join(capital, "")


def is_blank(c: Column | str) -> Column:
    c = _c(c)
    return c.isNull() | (strip(c.cast("string")) == "")


def clean_key(c: Column | str) -> Column:
    """Identifier text to bigint: ``12345.0`` and ``US-12345`` both give 12345."""
    digits = F.regexp_replace(strip(_c(c).cast("string")), r"\.0$", "")
    digits = F.regexp_replace(digits, r"[^0-9]", "")
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def to_number(c: Column | str) -> Column:
    """Text to double; what does not parse becomes null instead of failing."""
    return strip(_c(c).cast("string")).try_cast("double")


def within(c: Column | str, low: float, high: float, closed: bool = True) -> Column:
    """The value where it lies in the range, null elsewhere."""
    c = _c(c)
    inside = c.between(low, high) if closed else (c > low) & (c < high)
    return F.when(inside, c)


def valid_code(
    c: Column | str, codes, default: str | None, upper: bool = False, trim: bool = True
) -> Column:
    """Codes outside the set, and nulls, become the default."""
    c = _c(c)
    c = strip(c) if trim else c
    c = F.upper(c) if upper else c
    return F.when(c.isin(*codes), c).otherwise(F.lit(default))


def from_table(c: Column | str, table: dict, default=None) -> Column:
    """Look a code up in a small fixed table."""
    c = _c(c)
    out = None
    for key, value in table.items():
        out = F.when(c == F.lit(key), F.lit(value)) if out is None else out.when(c == F.lit(key), F.lit(value))
    return out.otherwise(F.lit(default))


def month_start(c: Column | str) -> Column:
    """First day of the month of a ``yyyymm[dd]`` text; unparsable text gives null."""
    return F.try_to_date(F.substring(_c(c).cast("string"), 1, 6), "yyyyMM")


def month_key(c: Column | str) -> Column:
    return F.date_format(month_start(c), "yyyy-MM")
