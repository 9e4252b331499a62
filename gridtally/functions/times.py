"""Zone arithmetic on ``TIMESTAMP_NTZ``, so that the session zone never matters."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The notations of a time, once compact ones have their separators.  A text
# that does not match as a whole is no time, whatever it holds.  A zone needs a time of day
# before it, so that the "-2022" of "01-01-2022" is not taken for one.
_TIME = (r"^(\d{4}-\d{1,2}-\d{1,2})"  # 1: date
         r"(?:[Tt ](\d{1,2})(?::(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?)?"  # 2 to 5: hour, minute, second, fraction
         r"\s*([Zz]|UTC|GMT|[+-]\d{1,2}(?::?\d{2})?|[A-Za-z]+(?:/[A-Za-z0-9_+-]+)+)?)?$")  # 6: zone
_OFFSET = r"^([+-])(\d{1,2}):?(\d{2})?$"

# Notations of a date in order of trial, beside ISO.  Months come before days.
DATE_FORMATS = ("yyyyMMdd", "yyyy/MM/dd", "MM/dd/yyyy", "dd.MM.yyyy", "MMM d yyyy", "MMM d, yyyy")


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def bound(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make(value)`` with the value computed once, however often ``make`` uses it.

    A column that is used several times is copied into each place when the plan is built; the variable of a lambda is not.
    """
    return F.get(F.transform(F.array(value), make), F.lit(0))


def utc_midnight(day: Column, timezone: str) -> Column:
    """Naive UTC time of the local midnight that begins ``day``; the later one where a clock change brings midnight twice."""
    midnight = day.cast("timestamp_ntz")
    to_local = lambda utc: F.convert_timezone(F.lit("UTC"), F.lit(timezone), utc)
    first = F.convert_timezone(F.lit(timezone), F.lit("UTC"), midnight)
    next_day = first + F.make_dt_interval(F.lit(1))
    second = midnight - (to_local(next_day) - next_day)
    return F.when(to_local(second) == midnight, second).otherwise(first)


def midnight_offset_text(day: Column, utc: Column) -> Column:
    """UTC offset at local midnight as ``+HH:MM``; ``utc`` is that midnight in UTC."""
    # The difference of two naive times is an interval; timestamp_diff would first
    # take both of them through the session zone.
    offset = day.cast("timestamp_ntz") - utc
    hours, minutes = F.extract(F.lit("HOUR"), offset), F.extract(F.lit("MINUTE"), offset)
    two_digits = lambda n: F.lpad(F.abs(n).cast("string"), 2, "0")
    return F.concat(
        F.when((hours < 0) | (minutes < 0), "-").otherwise("+"),
        two_digits(hours), F.lit(":"), two_digits(minutes),
    )


def hours_from(start: Column, n: int) -> Column:
    """Array of the ``n`` hours that begin at ``start``.  Stepping through a sequence is
    plain arithmetic, where adding an interval to every hour goes through java.time."""
    one = F.make_dt_interval(F.lit(0), F.lit(1))
    return F.sequence(start, start + F.make_dt_interval(F.lit(0), F.lit(n - 1)), one)


def hour_text(hour: Column) -> Column:
    """``T00`` to ``T23``."""
    return F.get(F.array(*[F.lit(f"T{h:02d}") for h in range(24)]), hour)


def utc_from_instant(ts: Column) -> Column:
    """Naive UTC time of a zone-aware timestamp."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), _epoch())


def utc_from_local(ts_ntz: Column, timezone: str) -> Column:
    """Naive UTC time of a naive local time; null where a clock change makes the
    local time missing or double.

    The zone's offsets a day before and a day after decide: the time is taken with the
    one, the other, or with neither if both or none of them give it back.  So a change may be of any size, as
    long as no two fall into the same two days.
    """
    day = F.make_dt_interval(F.lit(1))
    to_local = lambda utc: F.convert_timezone(F.lit("UTC"), F.lit(timezone), utc)

    def of_local(local: Column) -> Column:
        offsets = F.struct((to_local(local - day) - (local - day)).alias("before"),
                           (to_local(local + day) - (local + day)).alias("after"))
        return bound(offsets, lambda o: F.when(o["before"] == o["after"], local - o["before"]).otherwise(
            bound(F.struct((to_local(local - o["before"]) == local).alias("early"), (to_local(local - o["after"]) == local).alias("late")),
                  lambda fits: F.when(fits["early"] & ~fits["late"], local - o["before"])
                  .when(fits["late"] & ~fits["early"], local - o["after"]))))

    return bound(ts_ntz, of_local)


def _utc_from_text(text: Column, timezone: str) -> Column:
    """A text with a zone keeps its instant, one without is a local time; any other text has none."""
    text = F.regexp_replace(F.trim(text), r"^(\d{4})(\d{2})(\d{2})(?=$|[Tt ])", "$1-$2-$3")
    text = F.regexp_replace(text, r"(?<=[Tt ])(\d{2})(\d{2})(\d{2})?(?=$|[^\d:])", "$1:$2:$3")
    text = F.regexp_replace(text, r":(?=$|[^\d])", "")
    # One match gives all parts; what doesn't match has none.
    parts = lambda t: F.when(t.rlike(_TIME), F.split(F.regexp_replace(t, _TIME, "$1\n$2\n$3\n$4\n$5\n$6"), "\n"))
    return bound(text, lambda t: bound(parts(t), lambda p: _utc_from_parts(p, timezone)))


def _utc_from_parts(parts: Column, timezone: str) -> Column:
    """UTC time of the six parts of a text, empty ones where it has none."""
    part = lambda n: F.get(parts, F.lit(n - 1))
    two = lambda n: F.lpad(F.when(part(n) == "", "0").otherwise(part(n)), 2, "0")
    clock = F.concat(part(1), F.lit("T"), two(2), F.lit(":"), two(3), F.lit(":"), two(4), F.lit("."),
                     F.rpad(F.substring(part(5), 1, 6), 6, "0"))
    zone = part(6)
    offset = F.struct(*[F.regexp_extract(zone, _OFFSET, n).alias(name) for n, name in ((1, "sign"), (2, "hours"), (3, "minutes"))])

    def shifted(local: Column) -> Column:
        number = lambda c: F.coalesce(c.try_cast("int"), F.lit(0))
        moved = lambda o: F.when((number(o["hours"]) <= 18) & (number(o["minutes"]) < 60), local - F.make_dt_interval(
            F.lit(0), *[F.when(o["sign"] == "-", -1).otherwise(1) * number(o[c]) for c in ("hours", "minutes")]))
        return bound(offset, moved)

    return bound(clock.try_cast("timestamp_ntz"), lambda local: (
        F.when(zone == "", utc_from_local(local, timezone))
        .when(F.upper(zone).isin("Z", "UTC", "GMT"), local)
        .when(zone.rlike(_OFFSET), shifted(local))
        .otherwise(utc_from_instant(F.try_to_timestamp(F.concat(local.cast("string"), F.lit(" "), zone))))))


def parse_to_utc(df: DataFrame, column: str, timezone: str) -> Column:
    """Naive UTC time of ``df[column]``, null where there is none.

    Zone-aware timestamps and texts with an offset keep their instant; naive ones
    are local times of ``timezone``.  The choice is made row by row.
    """
    kind = df.schema[column].dataType
    col = F.col(column)
    if isinstance(kind, T.TimestampType):
        return utc_from_instant(col)
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return utc_from_local(col.cast("timestamp_ntz"), timezone)
    return _utc_from_text(col.cast("string"), timezone)


def to_day(df: DataFrame, column: str) -> Column:
    """Calendar date of a date, timestamp or text column, null where there is none."""
    kind = df.schema[column].dataType
    col = F.col(column)
    if isinstance(kind, T.DateType):
        return col
    if isinstance(kind, T.TimestampType):
        return F.to_date(utc_from_instant(col))
    if isinstance(kind, T.TimestampNTZType):
        return F.to_date(col)
    text = F.trim(col.cast("string"))
    return F.coalesce(
        F.to_date(text.try_cast("timestamp_ntz")),
        *[F.to_date(F.try_to_timestamp(text, F.lit(form))) for form in DATE_FORMATS],
    )
