"""Column expressions shared by every builder.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation; none of them needs Python at run time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r2(c: str | Column, digits: int = 2) -> Column:
    """Round half away from zero on the scaled value, as the warehouse does.

    ``round(x, 2)`` on a double in Spark rounds the decimal expansion of x,
    which differs at half-cent boundaries from scaling first; scaling by
    10^digits, rounding to an integer and scaling back matches.
    """
    scale = float(10**digits)
    return F.round(col(c).cast("double") * F.lit(scale), 0) / F.lit(scale)


# Money keeps ten decimals of the raw value, so sums are exact whatever the order of adding.
MONEY = "decimal(22,10)"


def money(c: str | Column) -> Column:
    """The raw value as an exact decimal, ready to be summed."""
    return col(c).cast("double").cast(MONEY)


def money_value(total: str | Column) -> Column:
    """ROUND(total, 2) of an exact sum, half away from zero, as double."""
    return F.round(col(total), 2).cast("double")


def money_avg(total: str | Column, n: str | Column) -> Column:
    """ROUND(total / n, 2) of an exact sum (at most decimal(32,10)), half away from zero, as double.

    The half-up quotient is the integer (2 * 100 * |total| + n) div 2n, which
    no intermediate rounding can move across a half cent; NULL for n = 0.
    """
    a, m = col(total).cast("decimal(32,10)"), col(n).cast("decimal(18,0)")
    m = F.when(m > 0, m)
    cents = F.call_function("div", F.abs(a) * F.lit(200).cast("decimal(3,0)") + m, m * F.lit(2).cast("decimal(1,0)"))
    return F.signum(a.cast("double")) * cents / F.lit(100.0)


def pct(num: str | Column, den: str | Column) -> Column:
    """100 * num / den in double precision (a SQL ``100.0`` literal is decimal in
    Spark); NULL when den is 0 (ANSI mode would raise)."""
    return F.lit(100.0) * col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))


def safe_div(num: str | Column, den: str | Column) -> Column:
    """num / NULLIF(den, 0)."""
    return col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))


def month_trunc(ts: str | Column) -> Column:
    """First instant of the month, kept as timestamp_ntz."""
    return F.date_trunc("month", col(ts)).cast("timestamp_ntz")


def month_diff(start: str | Column, end: str | Column) -> Column:
    """Number of month boundaries crossed from start to end (calendar months)."""
    s, e = col(start), col(end)
    return ((F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))).cast("long")


def day_diff(start: str | Column, end: str | Column) -> Column:
    """Number of day boundaries crossed from start to end."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start))).cast("long")


def floor_days(start: str | Column, end: str | Column) -> Column:
    """Whole days of (end - start), rounded toward minus infinity; NULL if either is NULL."""
    micros = F.timestamp_diff("MICROSECOND", col(start), col(end))
    return F.floor(micros / F.lit(MICROS_PER_DAY)).cast("int")


def year_month(ts: str | Column) -> Column:
    """'YYYY-MM' text of a timestamp (NULL stays NULL)."""
    return F.date_format(col(ts), "yyyy-MM")


# Every code point Python's str.strip() removes (str.isspace), derived by rule.
WHITESPACE = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def strip(c: str | Column) -> Column:
    """Remove leading and trailing whitespace as Python's ``str.strip()`` does
    (tab, newline, no-break space, ideographic space, ...).

    Spark's ``trim`` without a set only removes blanks; ``btrim`` with the
    explicit set is a plain scan, no regular expression.  An all-blank text
    becomes '' (not NULL).
    """
    return F.btrim(col(c), F.lit(WHITESPACE))


def label_text(c: str | Column) -> Column:
    """'credit_card' -> 'Credit Card' (replace underscores, title case)."""
    return F.initcap(F.regexp_replace(col(c), "_", " "))


# Texts the CSV reader treats as missing (the pandas defaults).
NA_VALUES = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def na_to_null(c: str | Column) -> Column:
    """NULL when the text is one of the missing-value words, else the text."""
    cc = col(c)
    return F.when(cc.isin(*NA_VALUES), F.lit(None).cast("string")).otherwise(cc)
