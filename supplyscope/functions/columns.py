"""Scalar column expressions shared by the operators.

Each helper returns a ``Column`` made of built-in functions, so it stays
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_or", "dec_round", "dec_bround", "season_of",
    "week_monday", "strip_lower", "severity_rank", "truncate_text",
    "pct_text", "millions", "stock_status", "status_code", "hash_id",
    "supply_days", "nonempty", "money_text", "int_text", "dec_text", "SEVERITY_RANK",
]

# Severity order used for sorting and escalation tests.
SEVERITY_RANK = {"LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec_round(c, scale: int, work_scale: int = 10) -> Column:
    """Half-up round through DECIMAL, returned as DOUBLE.

    Rounding the decimal form avoids the binary-double artefacts of
    rounding a double directly (2.675 stays a tie).
    """
    return F.round(col_or(c).cast(f"decimal(38,{work_scale})"), scale).cast("double")


def dec_bround(c, scale: int, work_scale: int = 10) -> Column:
    """Half-even round through DECIMAL (numpy / Python rounding)."""
    return F.bround(col_or(c).cast(f"decimal(38,{work_scale})"), scale).cast("double")


def season_of(month) -> Column:
    """Season code: 1 Dec-Feb, 2 Mar-May, 3 Jun-Aug, 4 Sep-Nov."""
    return (F.floor((col_or(month) % 12) / 3) + 1).cast("int")


def week_monday(year, week) -> Column:
    """Monday of week ``week`` of ``year`` under the %W rule.

    Week 1 starts on the first Monday of the year; weeks past the year's end
    roll into the next year (week 53 of 2016 is 2017-01-02).
    """
    first_monday = F.next_day(F.date_sub(F.make_date(col_or(year), F.lit(1), F.lit(1)), 1), "Mon")
    return F.date_add(first_monday, ((col_or(week) - 1) * 7).cast("int"))


def strip_lower(c) -> Column:
    """Strip all leading/trailing white space (not only blanks), lower-case."""
    return F.lower(F.regexp_replace(col_or(c), r"(^\s+)|(\s+$)", ""))


def severity_rank(c) -> Column:
    """LOW 1 .. CRITICAL 4; unknown 0 (sorts last when sorting desc)."""
    m = F.create_map(*[x for k, v in SEVERITY_RANK.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[col_or(c)], F.lit(0))


def truncate_text(c, n: int) -> Column:
    """First ``n`` characters plus '...' when longer."""
    c = col_or(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def pct_text(p) -> Column:
    """0.8734 -> '87.3%'."""
    return F.concat(dec_round(col_or(p) * 100, 1).cast("string"), F.lit("%"))


def millions(c) -> Column:
    return dec_round(col_or(c) / 1e6, 2)


def stock_status(days) -> Column:
    d = col_or(days)
    return F.when(d < 7, "CRITICAL").when(d < 14, "WARNING").otherwise("OK")


def status_code(status) -> Column:
    """PRJ30: stock status / label text -> 0 safe, 1 low, 2 critical; unknown 0."""
    s = F.lower(col_or(status))
    return (F.when(s.isin("ok", "safe"), 0).when(s.isin("warning", "low"), 1)
            .when(s == "critical", 2).otherwise(0)).cast("int")


def hash_id(*cols) -> Column:
    """Deterministic 60-bit id from the md5 of the '|'-joined key columns.

    The same value is computed by ``('0x' || substr(md5(key),1,15))::BIGINT``
    in SQL engines without Spark's hash functions.
    """
    key = F.concat_ws("|", *[F.coalesce(col_or(c).cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def supply_days(product) -> Column:
    """Seeded days-of-supply draw in 5..45 from the product name (hash draw)."""
    h = F.conv(F.substring(F.md5(col_or(product)), 1, 8), 16, 10).cast("bigint")
    return (F.lit(5) + h % 41).cast("int")


def nonempty(c) -> Column:
    """NULL for empty text so concat_ws skips it."""
    return F.nullif(col_or(c).cast("string"), F.lit(""))


def money_text(c) -> Column:
    """2-dp money with thousands separators, e.g. 1,234.50."""
    return F.format_number(col_or(c).cast("decimal(20,2)"), 2)


def int_text(c) -> Column:
    """Whole-number text, half-up rounded."""
    return F.round(col_or(c).cast("decimal(38,6)"), 0).cast("bigint").cast("string")


def dec_text(c, n: int) -> Column:
    """Fixed ``n``-dp text, half-up rounded through DECIMAL (no separators)."""
    return F.round(col_or(c).cast("decimal(38,6)"), n).cast("string")

