"""Display text and calendar labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cyclebook.functions.text import as_col

# Labels shown to the user.
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}
MISSING = "—"


def weekday_number(day: Column | str) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return (F.weekday(as_col(day)) + 1).cast("int")


def weekday_label(day: Column | str) -> Column:
    """Mon .. Sun."""
    return F.dayname(as_col(day))


def season_of(month: Column | str) -> Column:
    number = F.month(as_col(month))
    label = F.lit("Fall")
    for name, months in SEASONS.items():
        label = F.when(number.isin(*months), name).otherwise(label)
    return label


def month_label(day: Column | str) -> Column:
    return F.date_format(as_col(day), "MMM yyyy")


def _cents(x: Column) -> Column:
    """Hundredths rounded as C's printf does: by the exact binary value, ties to even.

    ``r`` is the exact distance to the middle between two hundredths, up to a
    factor: the single-precision head and the remainder are multiplied apart.
    """
    k = F.floor(x * 100)
    head = x.cast("float").cast("double")
    r = (head * 200 - (2 * k + 1)) + (x - head) * 200
    return k + F.when((r > 0) | ((r == 0) & (k % 2 != 0)), 1).otherwise(0)


def fmt_diff(x: Column | str) -> Column:
    """Signed, two decimals; the sign survives rounding to zero."""
    x = as_col(x)
    cents = _cents(x)
    return (F.when(x.isNull(), MISSING)
            .when((x < 0) & (cents == 0), "-0.00")
            .otherwise(F.format_string("%+.2f", cents / 100)))


def fmt_int(x: Column | str) -> Column:
    """Whole number with thousands separators; adding zero drops the sign of -0."""
    x = as_col(x)
    return F.when(x.isNull(), MISSING).otherwise(F.format_number(F.bround(x, 0) + 0.0, 0))


def fmt_m3(x: Column | str) -> Column:
    x = as_col(x)
    return F.when(x.isNull(), MISSING).otherwise(F.concat(fmt_int(x), F.lit(" m³")))


def fmt_tod(minutes: Column | str) -> Column:
    """Minutes after midnight as HH:MM."""
    minutes = as_col(minutes).cast("int")
    return F.format_string("%02d:%02d", F.floor(minutes / 60).cast("int"), minutes % 60)
