"""Opening hours: structured weeks to sorted, de-duplicated intervals."""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
SCHEMA_VERSION = "hours-v1"
WEEK_TYPE = "map<string,array<array<string>>>"
WEEKLY_TYPE = "array<struct<day:int,opens:string,closes:string,closes_day_offset:int>>"


def day_number(name: Column) -> Column:
    """1 for Monday to 7; null for other names."""
    return F.nullif(F.array_position(F.array(*(F.lit(d) for d in DAYS)), F.lower(name)), F.lit(0)).cast("int")


def clock(text: Column) -> Column:
    """``HH:MM``; 24:00 is 00:00; null for anything else."""
    t = F.trim(text)
    return F.when(t == "24:00", "00:00").when(t.rlike("^([01][0-9]|2[0-3]):[0-5][0-9]$"), t)


def closing_offset(opens: Column, closes: Column) -> Column:
    """1 if closing is on the next day: a plus sign, 24:00, or not after the opening."""
    t = F.trim(closes)
    return F.when(t.startswith("+") | (t == "24:00"), 1).when(clock(t) <= clock(opens), 1).otherwise(0)


def closing_clock(closes: Column) -> Column:
    return clock(F.regexp_replace(F.trim(closes), r"^\+", ""))


def weekly_intervals(week: Column) -> Column:
    """Sorted distinct intervals of a map from weekday to [opens, closes] pairs.

    Null if the week is null or holds an unknown day or a time that is none: a
    schedule is never guessed.
    """
    entries = F.map_entries(week)
    known = F.filter(entries, lambda e: ~e["key"].isin("regular", "special", "timezone", "schema_version"))
    intervals = F.flatten(F.transform(known, lambda e: F.transform(e["value"], lambda p: F.struct(
        day_number(e["key"]).alias("day"), clock(F.get(p, F.lit(0))).alias("opens"),
        closing_clock(F.get(p, F.lit(1))).alias("closes"),
        closing_offset(F.get(p, F.lit(0)), F.get(p, F.lit(1))).alias("closes_day_offset")))))
    bad = F.exists(known, lambda e: day_number(e["key"]).isNull()) | F.exists(
        intervals, lambda i: i["opens"].isNull() | i["closes"].isNull()) | F.exists(
        known, lambda e: F.exists(e["value"], lambda p: F.size(p) != 2))
    return F.when(~bad & (F.size(intervals) > 0), F.array_sort(F.array_distinct(intervals)))


def parse_week(text: Column) -> Column:
    """A JSON object of weekdays; free text gives null."""
    return F.from_json(text, WEEK_TYPE)


def weekly_valid(weekly: Column) -> Column:
    """Whether all intervals of a canonical week have a day 1-7, an offset 0 or 1 and two clock times."""
    return F.forall(weekly, lambda i: i["day"].between(1, 7) & i["closes_day_offset"].isin(0, 1)
                    & clock(i["opens"]).isNotNull() & clock(i["closes"]).isNotNull())


def special_interval(date: Column, closed: Column, opens: Column, closes: Column) -> Column:
    """A dated exception: closed, or with times; null if the date or a needed time is none."""
    day = date.try_cast("date")
    shut = F.coalesce(closed, F.lit(False))
    ok = day.isNotNull() & (shut | (clock(opens).isNotNull() & closing_clock(closes).isNotNull()))
    return F.when(ok, F.struct(
        day.alias("date"), shut.alias("closed"), F.when(~shut, clock(opens)).alias("opens"),
        F.when(~shut, closing_clock(closes)).alias("closes"),
        F.when(~shut, closing_offset(opens, closes)).alias("closes_day_offset")))


def valid_timezone(name: Column) -> Column:
    """Whether a text names a time zone of the zone database; null is none."""
    return F.coalesce(name.isin(*sorted(zoneinfo.available_timezones())), F.lit(False))


def has_hours(weekly: Column, special: Column | None = None) -> Column:
    filled = F.coalesce(F.size(weekly) > 0, F.lit(False))
    return filled if special is None else filled | F.coalesce(F.size(special) > 0, F.lit(False))


def hhmm(text: Column) -> Column:
    """``HHMM`` (or ``+HHMM``) with a colon; other texts unchanged."""
    return F.when(text.rlike(r"^\+?[0-9]{4}$"), F.regexp_replace(text, "([0-9]{2})([0-9]{2})$", "$1:$2")).otherwise(text)


def twelve_hour(text: Column) -> Column:
    """``16:30`` as ``4:30 PM``, full hours without minutes."""
    hour, minute = F.substring(text, 1, 2).cast("int"), F.substring(text, 4, 2)
    shown = F.when(hour % 12 == 0, 12).otherwise(hour % 12).cast("string")
    return F.concat(shown, F.when(minute == "00", "").otherwise(F.concat(F.lit(":"), minute)),
                    F.when(hour < 12, " AM").otherwise(" PM"))


def weekday_text(weekly: Column) -> Column:
    """``Monday: 4 PM - 2 AM`` lines of a canonical week, in order."""
    names = F.array(*(F.lit(d.capitalize()) for d in DAYS))
    return F.transform(weekly, lambda i: F.concat(
        F.element_at(names, i["day"]), F.lit(": "), twelve_hour(i["opens"]), F.lit(" - "), twelve_hour(i["closes"])))
