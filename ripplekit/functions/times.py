"""Date and time expressions on ``timestamp_ntz`` columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Zone names allowed by RFC 822 and their offsets in minutes.
RFC822_ZONES = {
    "UT": 0, "UTC": 0, "GMT": 0, "Z": 0,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}


def iso_year(ts: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), ts)


def iso_week(ts: Column) -> Column:
    return F.weekofyear(ts)


def with_iso_week(df: DataFrame, ts: str = "created_at") -> DataFrame:
    return df.withColumns({"iso_year": iso_year(F.col(ts)), "iso_week": iso_week(F.col(ts))})


def parse_first(text: Column, formats: list[str]) -> Column:
    """First format that parses wins; null when none does."""
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    return F.coalesce(*tries).cast("timestamp_ntz")


def parse_api_date(text: Column) -> Column:
    """``Sat Jan 01 10:11:12 +0800 2011`` to its wall-clock time (offset dropped)."""
    bare = F.regexp_replace(text, r"^\w{3} (\w{3} \d{2} [\d:]{8}) [+-]\d{4} (\d{4})$", "$1 $2")
    return parse_first(bare, ["MMM dd HH:mm:ss yyyy"])


def parse_pubdate(text: Column) -> Column:
    """Feed date to UTC; a non-RFC-822 date is read as ``yyyy/MM/dd`` at +08:00.

    Years may have two digits (70-99: the last century).  A zone is an offset, a
    name of RFC 822, or a name the JVM knows; with any other the date is null.
    """
    pattern = r"^(?:\w{3},\s*)?(\d{1,2} \w{3}) (\d{4}|\d{2}) ([\d:]{5,8})\s+(\S+)$"
    found = F.struct(*[F.regexp_extract(text, pattern, i).alias(n) for i, n in enumerate(("day", "year", "time", "zone"), 1)])

    def stated_at(part: Column) -> Column:
        day, year, time, zone = (part[n] for n in ("day", "year", "time", "zone"))
        century = F.when(F.length(year) == 4, "").when(year >= "70", "19").otherwise("20")
        stated = F.concat(day, F.lit(" "), century, year, F.lit(" "), time)
        wall = parse_first(stated, ["d MMM yyyy HH:mm:ss", "d MMM yyyy HH:mm"])
        digits = F.regexp_extract(zone, r"^[+-](\d{2})(\d{2})$", 1).try_cast("int") * 60 + F.regexp_extract(
            zone, r"^[+-](\d{2})(\d{2})$", 2
        ).try_cast("int")
        names = F.create_map(*[F.lit(x) for pair in RFC822_ZONES.items() for x in pair])
        offset = F.coalesce(
            F.when(zone.startswith("-"), -digits).otherwise(digits), F.try_element_at(names, F.upper(zone))
        )
        zoned = F.concat(stated, F.lit(" "), zone)
        formats = [f"d MMM yyyy {clock} {name}" for clock in ("HH:mm:ss", "HH:mm") for name in ("z", "VV")]
        named = F.coalesce(*[F.try_to_timestamp(zoned, F.lit(f)) for f in formats])
        instant = F.convert_timezone(F.current_timezone(), F.lit("UTC"), named.cast("timestamp_ntz"))
        return F.coalesce(
            wall - F.make_dt_interval(F.lit(0), F.lit(0), offset), F.when(zone.rlike("^[A-Za-z]"), instant)
        )

    fallback = parse_first(
        F.replace(text, F.lit("/"), F.lit("-")), ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd"]
    )
    # The parts are bound by a one-element ``transform``, so that the pattern is not run again for each use.
    return F.coalesce(
        F.get(F.transform(F.array(found), stated_at), F.lit(0)), fallback - F.make_dt_interval(F.lit(0), F.lit(8))
    )


def hour_floor(ts: Column) -> Column:
    """Start of the hour, without passing through the session time zone."""
    return ts - F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(ts), F.extract(F.lit("SECOND"), ts)
    )


def minute_floor(ts: Column) -> Column:
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.extract(F.lit("SECOND"), ts))


def bucket(ts: Column, interval: str = "h") -> Column:
    """Trend bucket: ``h`` hour, ``10m`` ten-minute floor, ``Nm`` N minutes
    rounded half-even from the hour, ``d`` day."""
    spec = interval.lower()
    if spec == "d":
        return F.to_date(ts).cast("timestamp_ntz")
    if spec == "10m":
        return hour_floor(ts) + F.make_dt_interval(
            F.lit(0), F.lit(0), (F.floor(F.minute(ts) / 10) * 10).cast("int")
        )
    if spec.endswith("m"):
        n = int(spec[:-1])
        steps = F.rint(F.minute(ts) / F.lit(float(n))).cast("int")
        return hour_floor(ts) + F.make_dt_interval(F.lit(0), F.lit(0), steps * n)
    return hour_floor(ts)


def day_grid(first: Column, last: Column) -> Column:
    """Every day from ``first`` to ``last``, as an array; each may then have its own ``bucket_grid``."""
    return F.sequence(F.date_trunc("day", first).cast("timestamp_ntz"), last, F.make_dt_interval(F.lit(1)))


def bucket_grid(first: Column, last: Column, interval: str, day: Column) -> Column:
    """Every bucket from ``first`` to ``last`` that begins with an hour of ``day``, as an array: 1,500 at most.

    Buckets of ``N`` minutes start anew each hour, as ``bucket`` makes them.
    """
    spec = interval.lower()
    if spec == "d":
        return F.array(day)
    begin = F.greatest(hour_floor(first), day)
    end = F.least(hour_floor(last), day + F.make_dt_interval(F.lit(0), F.lit(23)))
    hours = F.sequence(begin, end, F.make_dt_interval(F.lit(0), F.lit(1)))
    if not spec.endswith("m"):
        return hours
    n = int(spec[:-1])
    most = 5 if spec == "10m" else round(59 / n)  # round() is half-even, as rint
    inside = F.flatten(
        F.transform(
            hours,
            lambda h: F.transform(
                F.sequence(F.lit(0), F.lit(most)),
                lambda i: h + F.make_dt_interval(F.lit(0), F.lit(0), (i * n).cast("int")),
            ),
        )
    )
    return F.filter(inside, lambda t: t.between(first, last))


def period_start(spec: Column, today: Column) -> Column:
    """``Nd`` / ``Nw`` / ``Nm`` before ``today``; an unreadable N counts as 1."""
    n = F.coalesce(F.substr(spec, F.lit(1), F.length(spec) - 1).try_cast("int"), F.lit(1))
    unit = F.lower(F.right(spec, F.lit(1)))
    return (
        F.when(unit == "d", F.date_sub(today, n))
        .when(unit == "w", F.date_sub(today, n * 7))
        .when(unit == "m", F.add_months(today, -n))
    )


def epoch(ts: Column, zone: str = "UTC", unit: str = "s") -> Column:
    """Epoch seconds or milliseconds of a wall-clock time in ``zone``."""
    instant = F.convert_timezone(F.lit(zone), F.lit("UTC"), ts).cast("timestamp")
    return F.unix_millis(instant) if unit == "ms" else F.unix_seconds(instant)
