"""Pure column functions: parsing, calendar, grading. All stay in generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ratio(num: Column | str, den: Column | str, default: float = 0.0) -> Column:
    """num/den as double where den > 0, else ``default`` (null operands give ``default``)."""
    num, den = _c(num), _c(den)
    return F.coalesce(F.when(den > 0, num.cast("double") / den.cast("double")), F.lit(default))


def numeric_or_zero(col: Column | str) -> Column:
    """Parse a number from text; anything unparsable or null counts as 0 (truncated to int64)."""
    text = F.trim(_c(col).cast("string"))
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"),
                      F.lit(0).cast("bigint"))


def week_start_sunday(col: Column | str) -> Column:
    """Latest Sunday on or before the date, as DATE."""
    day = _c(col).cast("date")
    return F.date_sub(day, F.dayofweek(day) - 1)


def parse_compact_number(col: Column | str) -> Column:
    """``17.8M``, ``4.16B``, ``1,645`` to a count; exact decimal arithmetic, truncated."""
    text = F.upper(F.trim(_c(col)))
    suffix = F.right(text, F.lit(1))
    factor = (F.when(suffix == "K", F.lit(1_000)).when(suffix == "M", F.lit(1_000_000))
              .when(suffix == "B", F.lit(1_000_000_000)).otherwise(F.lit(1)).cast("decimal(10,0)"))
    digits = F.regexp_replace(text, "[^0-9.]", "")
    number = F.when(digits != "", digits).try_cast("decimal(24,6)")
    return (number * factor).try_cast("bigint")


def parse_grouped_int(col: Column | str, lo: int = 0, hi: int | None = None) -> Column:
    """Keep the digits; a value below ``lo``, or above ``hi`` if one is given, is null."""
    number = F.regexp_replace(_c(col).cast("string"), "[^0-9]", "").try_cast("bigint")
    return F.when(number >= lo if hi is None else number.between(lo, hi), number)


def clean_numeric(col: Column | str) -> Column:
    """Strip all but digits, dot and minus; truncate; failure gives 0."""
    text = F.regexp_replace(_c(col).cast("string"), "[^0-9.-]", "")
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"),
                      F.lit(0).cast("bigint"))


# fixed values: accepted date layouts, tried in this order (shape test, Spark pattern)
DATE_LAYOUTS = [
    (r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "yyyy-M-d"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "d/M/yyyy"),
    (r"^[0-9]{8}$", "yyyyMMdd"),
    (r"^[A-Za-z]{3} [0-9]{1,2} [0-9]{4}$", "MMM d yyyy"),
    (r"^[A-Za-z]+ [0-9]{1,2}, [0-9]{4}$", "MMMM d, yyyy"),
]


def parse_flexible_date(col: Column | str) -> Column:
    """First layout that fits, else epoch milliseconds or seconds, else null.

    The shape test in front of each layout keeps the parser off texts it would reject by
    raising an exception per row.
    """
    text = F.trim(_c(col).cast("string"))
    tries = [F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(pattern)))
             for shape, pattern in DATE_LAYOUTS]
    epoch = F.when(text.rlike("^[0-9]{1,18}$"), text.try_cast("bigint"))
    # beyond the year 9999 neither reading is a date
    tries.append(F.when(epoch.between(1_000_000_000_001, 253_402_300_799_999), F.timestamp_millis(epoch)))
    tries.append(F.when(epoch.between(1_000_000_001, 253_402_300_799), F.timestamp_seconds(epoch)))
    return F.coalesce(*tries).cast("date")


def near_any(col: Column | str, dates: Iterable, days: int = 14) -> Column:
    """True when the date lies within ``days`` of any listed junction date."""
    day = _c(col).cast("date")
    hits = [F.abs(F.datediff(day, F.lit(d).cast("date"))) <= days for d in dates]
    out = F.lit(False)
    for hit in hits:
        out = out | hit
    return F.coalesce(out, F.lit(False))


def normalize_handle(col: Column | str) -> Column:
    """Custom URL to handle: keep a leading ``@``, otherwise add one; empty stays empty."""
    text = F.coalesce(F.trim(_c(col)), F.lit(""))
    return F.when(text == "", F.lit("")).when(text.startswith("@"), text).otherwise(F.concat(F.lit("@"), text))


def map_status(privacy: Column | str, returned: Column | None = None) -> Column:
    """Entity status from the privacy status; an entity that was not returned is terminated."""
    privacy = _c(privacy)
    status = (F.when(privacy == "private", F.lit("private"))
              .when(privacy == "unlisted", F.lit("inactive")).otherwise(F.lit("active")))
    return status if returned is None else F.when(~returned, F.lit("terminated")).otherwise(status)


# fixed values: lower bound of each grade
GRADE_CUTS = [(0.95, "excellent"), (0.85, "good"), (0.75, "fair"), (0.60, "poor")]


def grade(score: Column | str, cuts=GRADE_CUTS, otherwise: str = "missing") -> Column:
    """Grade of a [0,1] score: the first cut it reaches."""
    score = _c(score)
    out = None
    for cut, name in cuts:
        out = F.when(score >= cut, F.lit(name)) if out is None else out.when(score >= cut, F.lit(name))
    return out.otherwise(F.lit(otherwise))


def clamp01(col: Column | str) -> Column:
    return F.least(F.greatest(_c(col).cast("double"), F.lit(0.0)), F.lit(1.0))


def fallback_name(key: Column | str, name: Column | str) -> Column:
    """Empty name becomes ``Channel_`` plus the first eight characters of the key."""
    name = F.coalesce(_c(name), F.lit(""))
    return F.when(name == "", F.concat(F.lit("Channel_"), F.substring(_c(key), 1, 8))).otherwise(name)


# fixed values: keywords of each chart library, in detection order
CHART_KEYWORDS = [
    ("dygraph", ["dygraph", "Dygraph", "dygraphs"]),
    ("highcharts", ["highcharts", "Highcharts", "highstock"]),
    ("plotly", ["plotly", "Plotly", "plotly.js"]),
    ("chartjs", ["chartjs", "Chart.js", "chart.min.js"]),
]


def detect_chart_library(html: Column | str) -> Column:
    html = _c(html)
    out = None
    for name, words in CHART_KEYWORDS:
        hit = F.lit(False)
        for word in words:
            hit = hit | html.contains(word)
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out.otherwise(F.lit("unknown"))


def parse_snapshot_ts(col: Column | str) -> Column:
    """14-digit archive stamp to a timestamp, null when malformed."""
    text = _c(col).cast("string")
    return F.when(text.rlike("^[0-9]{14}$"), F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")))


def score_snapshot(stamp: Column | str, status: Column | str, end) -> Column:
    """How well a stored page is expected to cover the period that ends at ``end``.

    max(0, 1 - days/365), times 1.2 for status 200, times 0.7 before 2020; malformed gives 0.
    """
    day = parse_snapshot_ts(stamp).cast("date")
    base = F.greatest(F.lit(0.0), 1.0 - F.abs(F.datediff(F.lit(end).cast("date"), day)) / F.lit(365.0))
    base = base * F.when(_c(status).cast("string") == "200", F.lit(1.2)).otherwise(F.lit(1.0))
    base = base * F.when(day < F.lit("2020-01-01").cast("date"), F.lit(0.7)).otherwise(F.lit(1.0))
    return F.coalesce(F.when(day.isNotNull(), base), F.lit(0.0))


def stable_week(as_of: Column | str, min_days: int = 3) -> Column:
    """Week to publish: this Sunday's week once ``min_days`` have passed, else the week before."""
    day = _c(as_of).cast("date")
    sunday = week_start_sunday(day)
    return F.when(F.datediff(day, sunday) >= min_days, sunday).otherwise(F.date_sub(sunday, 7))


def flag_add(flags: Column | str, flag: str, when: Column) -> Column:
    """Add ``flag`` to a set-like array where the condition holds (no duplicates)."""
    flags = F.coalesce(_c(flags), F.array().cast("array<string>"))
    return F.when(when, F.array_union(flags, F.array(F.lit(flag)))).otherwise(flags)


def flag_remove(flags: Column | str, flag: str, when: Column) -> Column:
    flags = F.coalesce(_c(flags), F.array().cast("array<string>"))
    return F.when(when, F.array_remove(flags, flag)).otherwise(flags)


def messages(*pairs: tuple[Column, str]) -> Column:
    """Array of the messages whose condition is true, in the given order."""
    return F.filter(F.array(*[F.when(cond, F.lit(text)) for cond, text in pairs]), lambda m: m.isNotNull())
