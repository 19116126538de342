"""Text cleaning as Column expressions (JVM side, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cyclebook.schema import FALSE_TOKENS, MONTH_CODES, TRUE_TOKENS

# Fixed value: Unicode dashes that count as a hyphen in keys.
UNICODE_DASHES = "‐‑‒–—―"

# Plain decimal or scientific notation. Java's own parser also takes "1d",
# "inf" and "nan", none of which is a number in a trade export.
# (?U) makes white space include the no-break space and its kin.
_NUMBER = r"(?U)^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)\s*$"

_SEPARATOR = r"(?:-|\s+)?"

# Label layouts per source: which separator may stand between month and year.
_STRICT_SEPARATOR = {"ICE": "", "Modern": "-", "Neon": _SEPARATOR}

_MONTH_NAMES = ("JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY",
                "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER")


# Spark copies an expression wherever a Column built from it is used, so the
# functions below refer to their cleaned text as few times as they can.


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(values: dict, c: Column) -> Column:
    """Value of a small fixed table; null for unknown keys."""
    pairs = [F.lit(x) for item in values.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), c)


def squish(c: Column | str) -> Column:
    """Trim, and reduce inner whitespace runs (no-break space included) to one blank."""
    return F.trim(F.regexp_replace(as_col(c).cast("string"), r"(?U)\s+", " "))


def has_text(c: Column | str) -> Column:
    """True when the value holds something other than whitespace; never null."""
    return F.coalesce(as_col(c).cast("string").rlike(r"(?U)\S"), F.lit(False))


def blank_to_na(c: Column | str) -> Column:
    return F.nullif(F.regexp_replace(squish(c), "^[Nn][Aa]$", ""), F.lit(""))


def ukey(c: Column | str) -> Column:
    """Matching key: squished, dashes unified, upper case, empty becomes null."""
    text = as_col(c).cast("string")
    dashed = F.translate(text, UNICODE_DASHES, "-" * len(UNICODE_DASHES))
    if isinstance(c, str):  # ASCII text has no such dash, and a column's own value costs nothing to look at
        dashed = F.when(F.octet_length(text) == F.char_length(text), text).otherwise(dashed)
    return F.nullif(F.upper(squish(dashed)), F.lit(""))


def clean_num(c: Column | str) -> Column:
    """Number from text such as ``$1,234.50``; null for anything else."""
    bare = F.translate(as_col(c).cast("string"), ",$", "")
    value = F.regexp_extract(bare, _NUMBER, 1).try_cast("double")
    infinite = F.lit(float("inf"))
    return F.nullif(F.nullif(value, infinite), -infinite)


def parse_bool(c: Column | str) -> Column:
    tokens = {**{t: True for t in TRUE_TOKENS}, **{t: False for t in FALSE_TOKENS}}
    return lookup(tokens, F.upper(squish(c)))


def is_yes(c: Column | str) -> Column:
    """Y / YES / TRUE / 1 in any spelling; anything else, null included, is false."""
    return F.coalesce(ukey(c).isin("Y", "YES", "TRUE", "1"), F.lit(False))


def _month_label(c: Column | str, layout: str, months: dict[str, str], year: str, to: str) -> Column:
    """First of the month from (month, year) groups; ``year`` rewrites short years."""
    text, layout = as_col(c).cast("string"), f"(?Ui){layout}"
    month = lookup(months, F.upper(F.regexp_extract(text, layout, 1)))
    digits = F.regexp_replace(F.regexp_extract(text, layout, 2), year, to)
    return F.concat(digits, month).try_cast("date")


def _month_parts(*names: tuple[str, ...]) -> dict[str, str]:
    return {n: f"-{i:02d}-01" for codes in names for i, n in enumerate(codes, 1)}


def parse_delivery_month(c: Column | str, strict: str | None = None) -> Column:
    """First of the month named by a label such as ``Jul26`` or ``JUL-2026``.

    The first "three letters, separator, digits" run in the label counts, so a
    range gives its first month. A year below 100 is always 20xx.

    ``strict`` names a source (ICE, Modern or Neon) whose older layout is then
    required for the whole label.
    """
    months = _month_parts(MONTH_CODES)
    if strict is None:
        layout = rf"([A-Z]{{3}}){_SEPARATOR}([0-9]{{4}}|[0-9]{{2}})"
        return _month_label(c, layout, months, "^(?:00)?([0-9]{2})$", "20$1")
    layout = rf"^\s*([A-Z]{{3}}){_STRICT_SEPARATOR[strict]}([0-9]{{4}}|[0-9]{{2}})\s*$"
    return _month_label(c, layout, months, "^([0-9]{2})$", "20$1")


def parse_period_words(c: Column | str) -> Column:
    """First of the month for ``Jul 26``, ``July 2026`` and the like (older layout).

    Two-digit years follow the usual century split: 69-99 are 19xx.
    """
    months = _month_parts(MONTH_CODES, _MONTH_NAMES)
    layout = r"^\s*([A-Z]{{3,9}})[\s./-]*({})\s*$"
    return F.coalesce(
        _month_label(c, layout.format("[0-9]{4}"), months, "", ""),
        _month_label(c, layout.format("69|[7-9][0-9]"), months, "^(..)$", "19$1"),
        _month_label(c, layout.format("[0-6][0-9]"), months, "^(..)$", "20$1"))


def market_without_strip(c: Column | str) -> Column:
    """Market text minus its last `` - xxx`` part."""
    return F.regexp_replace(as_col(c), r"(?U)\s+-\s+[^-]+$", "")


def derive_index_type(instrument: Column | str, price_basis: Column | str) -> Column:
    """Published index named by a row's text; the order of the tests matters."""
    text = F.upper(F.concat(F.coalesce(as_col(instrument), F.lit("")), F.lit(" "),
                            F.coalesce(as_col(price_basis), F.lit(""))))
    return (F.when(text.contains("BI4"), "Bi4")
            .when(text.contains("XAPP"), "XAPP")
            .when(text.contains("COMM"), "comm")
            .when(text.contains("1A"), "1a")
            .otherwise("other"))
