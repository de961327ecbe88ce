"""Partial dates as intervals.  Three rules exist side by side and are kept apart:
ingestion bounds, canonical sample intervals, and the older year-based interval."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V
from .scalars import one_of, text


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def bounds_start(t: Column) -> Column:
    """First day of ``YYYY``, ``YYYY-MM`` or a day; null if it is none."""
    return F.when(t.rlike(r"^\d{4}$"), F.try_to_date(F.concat(t, F.lit("-01-01")), "yyyy-MM-dd")).when(t.rlike(r"^\d{4}-\d{2}$"), F.try_to_date(F.concat(t, F.lit("-01")), "yyyy-MM-dd")).when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(t, "yyyy-MM-dd"))


def bounds_end(t: Column) -> Column:
    start = bounds_start(t)
    return F.when(t.rlike(r"^\d{4}$"), F.try_to_date(F.concat(t, F.lit("-12-31")), "yyyy-MM-dd")).when(t.rlike(r"^\d{4}-\d{2}$"), F.last_day(start)).otherwise(start)


def bounds_precision(t: Column) -> Column:
    """missing, year, month, day or invalid."""
    kind = F.when(t.rlike(r"^\d{4}$"), "year").when(t.rlike(r"^\d{4}-\d{2}$"), "month").otherwise("day")
    return F.when(one_of(t, V.NO_DATE), "missing").when(bounds_start(t).isNull(), "invalid").otherwise(kind)


def ingest(raw: Column) -> tuple[Column, Column, Column]:
    """(start, end, precision) of a raw date or ``a/b`` interval."""
    t = text(raw)
    a, b = F.trim(F.split(t, "/")[0]), F.trim(F.element_at(F.split(t, "/", 2), -1))
    two = t.contains("/")
    start = F.when(two, bounds_start(a)).otherwise(bounds_start(t))
    end = F.when(two, bounds_end(b)).otherwise(bounds_end(t))
    good = start.isNotNull() & end.isNotNull() & (start <= end)
    precision = F.when(two, F.when(good, "interval").otherwise("invalid")).otherwise(bounds_precision(t))
    usable = ~precision.isin("invalid", "missing")
    return F.when(usable, start), F.when(usable, end), precision


def decimal_year(day: Column) -> Column:
    """The year plus the part of it that has passed before the day."""
    year = F.year(day)
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    return year + (F.dayofyear(day) - 1) / F.when(leap, 366.0).otherwise(365.0)


def canonical(raw: Column, start: Column | None = None, end: Column | None = None, precision: Column | None = None, today: str = "2001-12-31") -> Column:
    """A struct (status, reason, start, end, precision, year_min, year_max, midpoint).

    Given bounds come first and must fit their precision; intervals that begin
    after ``today`` are ``future``; nothing acquires more precision than it had.
    """
    none = F.lit(None)
    s, e, p = (x if x is not None else none.cast(k) for x, k in ((start, "date"), (end, "date"), (precision, "string")))

    def bounds(t: Column) -> Column:
        raw_start, raw_end, raw_precision = ingest(t)
        return F.struct(t.alias("t"), s.alias("s"), e.alias("e"), p.alias("p"), raw_start.alias("rs"), raw_end.alias("re"), raw_precision.alias("rp"))

    def choose(x: Column) -> Column:
        given = x["s"].isNotNull() | x["e"].isNotNull()
        kind = F.when(given, F.coalesce(x["p"], F.when(x["s"] == x["e"], "day").otherwise("interval"))).otherwise(x["rp"])
        blank = ~given & one_of(x["t"], V.NO_DATE)
        return F.struct(F.when(given, x["s"]).otherwise(x["rs"]).alias("first"), F.when(given, x["e"]).otherwise(x["re"]).alias("last"), kind.alias("kind"), x["p"].alias("p"), blank.alias("blank"))

    def judge(x: Column) -> Column:
        first, last, kind = x["first"], x["last"], x["kind"]
        fits = (
            F.when(kind == "day", first == last)
            .when(kind == "month", (first == F.trunc(first, "month")) & (last == F.last_day(first)))
            .when(kind == "year", (first == F.trunc(first, "year")) & (last == F.make_date(F.year(first), F.lit(12), F.lit(31))))
            .when(kind == "interval", first <= last)
            .otherwise(F.lit(False))
        )
        bad = ~F.coalesce(fits & (first <= last), F.lit(False))
        state = F.when(x["p"].isin("missing", "invalid"), x["p"]).when(x["blank"], "missing").when(bad, "invalid").when(first > F.lit(today).cast("date"), "future").otherwise("valid")
        return F.struct(state.alias("state"), first.alias("first"), last.alias("last"), kind.alias("kind"))

    def measure(x: Column) -> Column:
        usable = x["state"].isin("valid", "future")
        return F.struct(x["state"].alias("state"), usable.alias("usable"), x["first"].alias("first"), x["last"].alias("last"), x["kind"].alias("kind"), F.when(usable, decimal_year(x["first"])).alias("low"), F.when(usable, decimal_year(x["last"])).alias("high"))

    def answer(x: Column) -> Column:
        return F.struct(
            x["state"].alias("status"),
            F.when(x["state"] != "valid", F.concat(x["state"], F.lit("_collection_date"))).alias("reason"),
            F.when(x["usable"], x["first"]).alias("start"),
            F.when(x["usable"], x["last"]).alias("end"),
            F.when(x["usable"], x["kind"]).otherwise(x["state"]).alias("precision"),
            x["low"].alias("year_min"),
            x["high"].alias("year_max"),
            ((x["low"] + x["high"]) / 2).alias("midpoint"),
        )

    found = let(text(raw), bounds)
    for step in (choose, judge, measure, answer):
        found = let(found, step)
    return found


def legacy_year(raw: Column, today: str, allow_future: bool = False) -> Column:
    """The year of the older rule: the whole value must be a date, and must not lie ahead."""
    t = text(raw)
    start = bounds_start(t)
    ok = start.isNotNull() if allow_future else start <= F.lit(today).cast("date")
    return F.when(ok, F.year(start))


def clock_bounds(raw: Column, today: str) -> Column:
    """A struct (status, year_min, year_max, precision) of a date as clock programs write it: decimals, ``[a:b]`` and ``XX`` parts."""
    t = text(raw)
    number, pair = r"^\d{4}\.\d+$", r"^\[(\d{4}(?:\.\d+)?):(\d{4}(?:\.\d+)?)\]$"
    low = F.when(t.rlike(number), t.try_cast("double")).when(t.rlike(pair), F.regexp_extract(t, pair, 1).try_cast("double"))
    high = F.when(t.rlike(number), t.try_cast("double")).when(t.rlike(pair), F.regexp_extract(t, pair, 2).try_cast("double"))
    numeric = t.rlike(number) | t.rlike(pair)
    good = (low >= 1) & (low <= high) & (high < 10000)
    calendar = (
        F.when(t.rlike(r"^\d{4}-XX-XX$"), F.substring(t, 1, 4))
        .when(t.rlike(r"^\d{4}-\d{2}-XX$"), F.substring(t, 1, 7))
        .when(t.rlike(r"^\d{4}-XX-\d{2}$"), F.concat(F.substring(t, 1, 4), F.lit("-01-"), F.substring(t, 9, 2), F.lit("/"), F.substring(t, 1, 4), F.lit("-12-"), F.substring(t, 9, 2)))
        .when((t == "") | t.rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$"), t)
        .otherwise("unsupported")
    )
    ahead = low > decimal_year(F.lit(today).cast("date"))

    def answer(c: Column) -> Column:
        status = F.when(numeric, F.when(~good, "invalid").when(ahead, "future").otherwise("valid")).otherwise(c["status"])
        usable = status.isin("valid", "future")
        kind = F.when(t.rlike(number), "numeric").when(t.rlike(pair), "interval").otherwise(c["precision"])
        return F.struct(status.alias("status"), F.when(usable, F.when(numeric, low).otherwise(c["year_min"])).alias("year_min"), F.when(usable, F.when(numeric, high).otherwise(c["year_max"])).alias("year_max"), kind.alias("precision"))

    return let(canonical(calendar, today=today), answer)


def clock_text(raw: Column) -> Column:
    """Years and months with their unknown parts spelled out."""
    t = text(raw)
    return F.when(t.rlike(r"^\d{4}$"), F.concat(t, F.lit("-XX-XX"))).when(t.rlike(r"^\d{4}-\d{2}$"), F.concat(t, F.lit("-XX"))).otherwise(t)


def period_comparison(a: Column, b: Column) -> Column:
    """Whether two raw dates share a month, a year, or neither."""
    month = lambda t: F.when(t.rlike(r"^\d{4}-\d{2}"), F.substring(t, 1, 7))
    year = lambda t: F.when(t.rlike(r"^\d{4}"), F.substring(t, 1, 4))
    x, y = text(a), text(b)
    return F.when(month(x) == month(y), "same_month").when(year(x) == year(y), "same_year").when(year(x).isNotNull() & year(y).isNotNull(), "between_years").otherwise("date_unavailable")


def patient_comparison(a: Column, b: Column) -> Column:
    x, y = text(a), text(b)
    return F.when((x == "") | (y == ""), "patient_unavailable").when(x == y, "same_patient").otherwise("different_patients")
