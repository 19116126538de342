"""Local wall-clock parsing as Column expressions.

Everything ends in DATE or TIMESTAMP_NTZ, so results never depend on
``spark.sql.session.timeZone``, and text that does not parse gives null rather
than an error under ANSI mode. Each field order is one regular expression
that rewrites the text to ISO form (or to nothing) and one cast; it only runs on
texts whose first characters have its shape.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cyclebook.functions.text import as_col, lookup, parse_delivery_month, squish

# Field orders: pattern and the ISO arrangement of its groups. Two-digit years
# up to 68 are 20xx, the rest 19xx (see ``_long_year``). A dashed date that begins with a number above 12
# begins with the year: 26-06-03 is never the 26th.
_YEAR = "([0-9]{4}|[0-9]{2})"
_DATE_ORDERS = {
    "ymd": (r"([0-9]{4}|(?:1[3-9]|[2-9][0-9])(?=-[0-9]{1,2}-))[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})", "$1-$2-$3"),
    "mdy": (rf"([0-9]{{1,2}})[-/.]([0-9]{{1,2}})[-/.]{_YEAR}", "$3-$1-$2"),
    "dmy": (rf"([0-9]{{1,2}})[-/.]([0-9]{{1,2}})[-/.]{_YEAR}", "$3-$2-$1"),
}
# Places of the first separator: after a year of two or four digits, or after one or two digits.
_SEPARATED = {"ymd": (3, 5), "mdy": (2, 3), "dmy": (2, 3)}
# The same with the month's name, rearranged to year|name|day.
_NAME, _SEP = r"([A-Za-z]{3})[a-z]*\.?", r"[-/.,\s]*"
_DAY = "([0-9]{1,2})(?:st|nd|rd|th)?"
_NAMED_ORDERS = {
    "ymd": (rf"([0-9]{{4}}){_SEP}{_NAME}{_SEP}{_DAY}", "$1|$2|$3"),
    "mdy": (rf"{_NAME}{_SEP}{_DAY}[-/.,\s]+{_YEAR}", "$3|$1|$2"),
    "dmy": (rf"{_DAY}{_SEP}{_NAME}{_SEP}{_YEAR}", "$3|$2|$1"),
}
_MONTHS = {n: f"-{i:02d}-" for i, n in enumerate(
    ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"), 1)}
_TAIL = {"seconds": r":[0-5]?[0-9]:[0-5]?[0-9](?:\.[0-9]+)?", "minutes": ":[0-5]?[0-9]"}
_GAP = r"(?:\s+|T)"
CLOCK_KINDS = ("12h seconds", "12h minutes", "24h seconds", "24h minutes")

# Fixed value: day zero of spreadsheet serial dates.
SERIAL_ORIGIN = "1899-12-30"
_LAST_SERIAL = 2958465  # 9999-12-31


def _once(value: Column | str, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.transform(F.array(as_col(value)), use)[0]


def _rewrite(c: Column | str, pattern: str, to: str) -> Column:
    """Text that matches as a whole, rearranged; other text loses all its parts.

    White space (no-break space included) may surround the pattern.
    """
    return F.regexp_replace(as_col(c), rf"(?Uis)^(?:\s*{pattern}\s*|.*)$", to)


def _long_year(iso: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of ISO text whose year of two digits, if it has one, got its century."""
    return _once(iso, lambda r: then(F.when(
        F.substring(r, 3, 1).isin("-", "|"), F.concat(F.when(r < "69", "20").otherwise("19"), r)).otherwise(r)))


def _may_fit(text: Column, order: str) -> Column:
    """Cheap test of a text's first characters that no text which fits the order's numbers fails.

    A digit follows the first separator. Texts that begin with something else than an ASCII digit or letter, such as white space, are
    left to the pattern.
    """
    first = F.substring(text, 1, 1)
    placed = (first < "0") | (first > "z")
    for place in _SEPARATED[order]:
        placed |= F.substring(text, place, 1).isin("-", "/", ".") & F.substring(text, place + 1, 1).between("0", "9")
    return placed


def _may_name(text: Column, order: str) -> Column:
    """The same for orders with a month's name: one begins with it, the others with a digit."""
    first = F.substring(text, 1, 1)
    return (first < "0") | (first > "9") if order == "mdy" else (first < "A") | (first > "z")


def _named_day(parts: Column) -> Column:
    """Date of a text year|name|day."""
    return F.concat(parts[0], lookup(_MONTHS, F.upper(parts[1])), parts[2]).try_cast("date")


def _named_date(c: Column | str, orders: Sequence[str]) -> Column:
    """Date with a month name by the first order that fits; only looked for in text with letters."""
    def tried(text: Column) -> Column:
        tries = [F.when(_may_name(text, order), _long_year(
            _rewrite(text, *_NAMED_ORDERS[order]), lambda r: _once(F.split(r, r"\|"), _named_day))) for order in orders]
        return F.when(text.rlike("[A-Za-z]{3}"), F.coalesce(*tries))
    return _once(c, tried)


def parse_date(c: Column | str, orders: Sequence[str] = ("ymd",)) -> Column:
    """Date by the first field order that gives a valid one, with numbers or a month name."""
    return _once(c, lambda text: F.coalesce(
        *[F.when(_may_fit(text, order), _long_year(_rewrite(text, *_DATE_ORDERS[order]), lambda r: r.try_cast("date")))
          for order in orders], _named_date(text, orders)))


def _clock_tails(kinds: Sequence[str], half: str) -> str:
    tails = [_TAIL[k.split()[1]] for k in kinds if k.startswith(half)]
    return "(?:" + "|".join(tails) + ")" if tails else ""


def _half_day(at: Column, half: Column) -> Column:
    """The instant of a clock of twelve hours, read as it is: 12 AM is midnight, and hours PM are later."""
    return (F.when((half == "A") & (F.hour(at) == 12), at - F.expr("INTERVAL 12 HOURS"))
            .when((half == "P") & (F.hour(at) != 12), at + F.expr("INTERVAL 12 HOURS")).otherwise(at))


def _numeric_timestamp(text: Column, orders: Sequence[str], kinds: Sequence[str],
                       allow_date_only: bool) -> Column:
    """One pattern for each order, which takes all clocks; ``|`` stands before the letter of AM or PM."""
    day_tail, half_tail = _clock_tails(kinds, "24h"), _clock_tails(kinds, "12h")
    clocks, parts = [], ""
    if day_tail:
        clocks.append(f"((?:[01]?[0-9]|2[0-3]){day_tail})")
        parts += f"${3 + len(clocks)}"
    if half_tail:
        clocks.append(rf"((?:0?[1-9]|1[0-2]){half_tail})\s*([AP])M")
        parts += f"${3 + len(clocks)}|${4 + len(clocks)}"
    clock = f"(?:{_GAP}(?:{'|'.join(clocks)}))" + ("?" if allow_date_only else "")

    def instant(r: Column) -> Column:
        if not half_tail:
            return r.try_cast("timestamp_ntz")
        return _once(F.split(r, r"\|"), lambda p: _once(
            p[0].try_cast("timestamp_ntz"), lambda at: _half_day(at, F.upper(p[1]))))

    tries = []
    for order in orders:
        day, iso = _DATE_ORDERS[order]
        tries.append(F.when(_may_fit(text, order), _long_year(_rewrite(text, day + clock, f"{iso} {parts}"), instant)))
    # Every clock has a colon, which spares texts without one all patterns.
    return F.coalesce(*tries) if allow_date_only else F.when(text.contains(":"), F.coalesce(*tries))


def parse_local_timestamp(c: Column | str, orders: Sequence[str] = ("ymd",),
                          kinds: Sequence[str] = CLOCK_KINDS,
                          allow_date_only: bool = False) -> Column:
    """Wall-clock instant from "date time" text with a blank or ``T`` between.

    The date may name its month; that is only looked for where no plain layout fits.
    """
    def named(text: Column) -> Column:
        day = _named_date(F.regexp_replace(text, r"(?i)(?:\s|T)[0-9]{1,2}:[0-9:.]*(?:\s*[AP]M)?\s*$", ""), orders)

        def timed(clock: Column) -> Column:
            at = _once(parse_clock(clock, kinds), lambda parsed: F.when(parsed.isNotNull(), at_clock(day, parsed)))
            return F.when(clock == "", day.cast("timestamp_ntz")).otherwise(at) if allow_date_only else at
        return _once(F.regexp_extract(text, r"(?i)(?:\s|T)([0-9]{1,2}:[0-9:.]*(?:\s*[AP]M)?)\s*$", 1), timed)

    return _once(c, lambda text: F.coalesce(_numeric_timestamp(text, orders, kinds, allow_date_only),
                                            F.when(text.rlike("[A-Za-z]{3}"), named(text))))


def parse_clock(c: Column | str, kinds: Sequence[str] = CLOCK_KINDS) -> Column:
    """Time of day from ``9:15:22 AM``, ``9:15 AM``, ``14:05:01`` or ``14:05``, on 1970-01-01."""
    return _once(F.concat(F.lit("1970-01-01 "), as_col(c)),
                 lambda text: _numeric_timestamp(text, ("ymd",), kinds, False))


def at_clock(day: Column, clock: Column) -> Column:
    """TIMESTAMP_NTZ of a date and a time of day; midnight when the time is missing."""
    since_midnight = clock - F.lit("1970-01-01").cast("timestamp_ntz")
    return _once(day.cast("timestamp_ntz"), lambda start: F.coalesce(start + since_midnight, start))


def ice_local_date(c: Column | str) -> Column:
    """Month/day/year in the first ten characters."""
    return parse_date(F.substring(squish(c), 1, 10), ("mdy",))


def ice_local_timestamp(c: Column | str) -> Column:
    """The date above with the clock in characters 12-19."""
    return _once(squish(c), lambda text: parse_local_timestamp(
        F.concat(F.substring(text, 1, 10), F.lit(" "), F.substring(text, 12, 8)),
        ("mdy",), ("24h seconds",)))


def modern_timestamp(c: Column | str) -> Column:
    return parse_local_timestamp(c, ("ymd",), ("12h seconds", "24h seconds", "24h minutes"))


def neon_timestamp(c: Column | str) -> Column:
    """Year first, in numbers or with a month name, to the second, the minute or the day."""
    return parse_local_timestamp(c, ("ymd",), ("24h seconds", "24h minutes"),
                                 allow_date_only=True)


def permissive_timestamp(c: Column | str) -> Column:
    """Any of the three field orders, to the second or the day (older layout)."""
    return parse_local_timestamp(c, ("ymd", "mdy", "dmy"), ("12h seconds", "24h seconds"),
                                 allow_date_only=True)


def onex_date(c: Column | str) -> Column:
    """Date text in any field order, an eight-digit date, or a spreadsheet serial number."""
    def counted(number: Column) -> Column:
        return F.when(number <= _LAST_SERIAL, F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), number.cast("int")))

    return _once(c, lambda text: F.coalesce(
        parse_date(text, ("ymd", "mdy", "dmy")),
        _once(F.floor(_rewrite(text, r"([0-9]+)(?:\.[0-9]+)?", "$1").try_cast("double")), counted),
        _rewrite(text, "([0-9]{4})([0-9]{2})([0-9]{2})", "$1-$2-$3").try_cast("date")))


def export_end(file_name: Column | str) -> Column:
    """Last day of an export range in a file name (``2026-06-01_2026-06-30``)."""
    day = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
    return F.regexp_extract(as_col(file_name), f"({day})_({day})", 2).try_cast("date")


def month_start(c: Column | str) -> Column:
    return F.trunc(as_col(c), "MM")


def neon_delivery_month(period: Column | str, delivery_start: Column | str) -> Column:
    """Month of the label, else of the delivery start."""
    start = neon_timestamp(delivery_start).cast("date")
    return F.coalesce(parse_delivery_month(period), month_start(start))
