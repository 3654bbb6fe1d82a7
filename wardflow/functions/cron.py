"""Cron expressions as sets of allowed values, and a count of their slots.

Five fields: minute, hour, day of month, month, weekday (0 and 7 are Sunday);
each is a list of values, ranges and steps, months and weekdays also by name. A
day must match both day fields where one of them begins with a star, else
either of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The names of months from 1 and of weekdays from 0.
MONTHS = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split()
WEEKDAYS = "SUN MON TUE WED THU FRI SAT".split()
#: Lowest and highest value of each field, and its names with the first one's value.
FIELDS = [(0, 59, [], 0), (0, 23, [], 0), (1, 31, [], 0), (1, 12, MONTHS, 1), (0, 7, WEEKDAYS, 0)]

DAY_SECONDS = 86400


def field_values(text: Column, low: int, high: int, names: list[str], first: int) -> Column:
    """The values a field allows, sorted; null where it cannot be read."""
    named = F.upper(text)
    for number, name in enumerate(names, first):
        named = F.regexp_replace(named, rf"\b{name}\b", str(number))

    def part(item: Column, group: int) -> Column:
        return F.regexp_extract(item, r"^(\*|\d{1,2})(?:-(\d{1,2}))?(?:/(\d{1,2}))?$", group)

    def values(item: Column) -> Column:
        begin, end, step = (part(item, g) for g in (1, 2, 3))
        star, by = begin == "*", F.coalesce(step.try_cast("int"), F.lit(1))
        lo = F.when(star, F.lit(low)).otherwise(begin.try_cast("int"))
        hi = F.when(star, F.lit(high)).when(end != "", end.try_cast("int")).when(step != "", F.lit(high)).otherwise(lo)
        good = (lo >= low) & (lo <= hi) & (hi <= high) & (by >= 1) & ~(star & (end != ""))
        return F.when(good, F.sequence(lo, hi, by))

    found = F.transform(F.split(named, ",", -1), values)
    return F.when(F.forall(found, lambda v: v.isNotNull()), F.array_sort(F.array_distinct(F.flatten(found))))


def parsed(cron: Column) -> Column:
    """struct(minutes, hours, days, months, weekdays, either): null for an expression that cannot be read.

    ``either``: a day has to match only one of its two fields.
    """
    parts = F.split(F.trim(cron), r"\s+")
    sets = [field_values(F.get(parts, F.lit(i)), *spec) for i, spec in enumerate(FIELDS)]
    sets[4] = F.array_distinct(F.transform(sets[4], lambda d: d % 7))
    either = ~F.get(parts, F.lit(2)).startswith("*") & ~F.get(parts, F.lit(4)).startswith("*")
    names = ["minutes", "hours", "days", "months", "weekdays"]
    readable = F.size(parts) == 5
    for one in sets:
        readable = readable & one.isNotNull()
    return F.when(readable, F.struct(*[s.alias(n) for s, n in zip(sets, names)], either.alias("either")))


def on_day(cron: Column, day: Column) -> Column:
    """Whether a parsed expression has slots on a day."""
    of_month = F.array_contains(cron["days"], F.dayofmonth(day))
    of_week = F.array_contains(cron["weekdays"], F.dayofweek(day) - 1)
    by_day = F.when(cron["either"], of_month | of_week).otherwise(of_month & of_week)
    return F.array_contains(cron["months"], F.month(day)) & by_day


def day_of(moment: Column) -> Column:
    """The day of a moment, which is whole seconds since the epoch."""
    return F.date_from_unix_date(F.floor(moment / DAY_SECONDS).cast("int"))


def calendars(spans: DataFrame) -> DataFrame:
    """(line, cron, base, upto) of each ``line`` of ``spans(line, first, last)``; cron is null for one that cannot be read.

    ``base`` is the earliest day of the line's spans, and ``upto`` holds, for
    each day from there to the last one, how many days up to it have slots. So
    days are walked once for a line, however many sources share it.
    """
    lines = spans.groupBy("line").agg(F.min("first").alias("base"), F.max("last").alias("end"))
    # No filter by what was read: it would be moved before the grouping, and every row be read.
    read = lines.withColumn("cron", parsed(F.col("line")))
    days = read.select("line", "base", "cron", F.explode(F.sequence("base", F.greatest("base", "end"))).alias("day"))
    hits = days.select("line", "base", "cron", "day", on_day(F.col("cron"), F.col("day")).cast("int").alias("hit"))
    so_far = hits.withColumn("n", F.sum("hit").over(Window.partitionBy("line").orderBy("day")).cast("int"))
    upto = F.transform(F.sort_array(F.collect_list(F.struct("day", "n"))), lambda d: d["n"])
    return so_far.groupBy("line", "base", "cron").agg(upto.alias("upto"))


def days_between(base: Column, upto: Column, after: Column, before: Column) -> Column:
    """Days with slots that lie between the days of two moments, by :func:`calendars`."""
    place = lambda day: F.get(upto, F.date_diff(day, base))
    return place(F.date_sub(day_of(before), 1)) - place(day_of(after))


def slots_between(cron: Column, after: Column, before: Column, days: Column | None = None) -> Column:
    """Slots of a parsed expression after one moment and before another.

    Moments are whole seconds since the epoch. Each of the ``days`` with slots
    between the first and the last one counts all of a day's slots; they are
    walked where no number is given. Only on the first and the last one is the
    time of day looked at.
    """
    hours, minutes = cron["hours"], cron["minutes"]
    a_day = F.size(hours) * F.size(minutes)
    first, last = day_of(after), day_of(before)

    def rest(moment: Column, later: bool) -> Column:
        """Slots of the moment's day after it, or before it."""
        second = F.pmod(moment, F.lit(DAY_SECONDS))
        hour, left = F.floor(second / 3600), F.pmod(second, F.lit(3600))
        whole = F.size(F.filter(hours, lambda h: (h > hour) if later else (h < hour))) * F.size(minutes)
        part = F.size(F.filter(minutes, lambda m: (m * 60 > left) if later else (m * 60 < left)))
        return whole + F.when(F.array_contains(hours, hour.cast("int")), part).otherwise(0)

    if days is None:
        days = F.size(F.filter(F.sequence(first, last), lambda d: (d > first) & (d < last) & on_day(cron, d)))
    # Within one day, the slots up to the first moment and from the second on are apart.
    counts = F.when(first == last, F.when(on_day(cron, first), rest(after, True) + rest(before, False) - a_day).otherwise(0)).otherwise(
        days * a_day
        + F.when(on_day(cron, first), rest(after, True)).otherwise(0)
        + F.when(on_day(cron, last), rest(before, False)).otherwise(0)
    )
    return F.when(cron.isNotNull(), F.when(after < before, counts).otherwise(0))
