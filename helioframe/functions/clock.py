"""The two clocks of the data: UTC instants in raw tables, plant-local naive times after staging.

Payload times move to local by a fixed three hours; the current time moves by the zone's own rules.
The two agree today but not for years with summer time, so they stay separate.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLANT_ZONE = "America/Sao_Paulo"
LOCAL_OFFSET_HOURS = 3
DAY = "date"


@dataclass(frozen=True)
class Clock:
    """The moment a run stands for, in UTC; stands in for the database's current time."""

    as_of: datetime
    zone: str = PLANT_ZONE

    def __post_init__(self) -> None:
        if self.as_of.tzinfo is not None:
            object.__setattr__(self, "as_of", self.as_of.astimezone(timezone.utc).replace(tzinfo=None))

    def instant(self) -> Column:
        return F.expr(f"TIMESTAMP '{self.as_of.isoformat(sep=' ')} UTC'")

    def utc(self) -> Column:
        return F.expr(f"TIMESTAMP_NTZ '{self.as_of.isoformat(sep=' ')}'")

    def local(self) -> Column:
        """Plant-local wall clock by the zone's rules."""
        return F.convert_timezone(F.lit("UTC"), F.lit(self.zone), self.utc())

    def fixed_local(self) -> Column:
        """Wall clock by the fixed offset that payload times use."""
        moment = self.as_of - timedelta(hours=LOCAL_OFFSET_HOURS)
        return F.expr(f"TIMESTAMP_NTZ '{moment.isoformat(sep=' ')}'")

    def today(self) -> Column:
        return F.to_date(self.local())


@dataclass(frozen=True)
class LiveClock(Clock):
    """The current time of whoever reads: a view over it moves on, and day partitions are still pruned."""

    as_of: datetime = datetime.max

    def instant(self) -> Column:
        return F.current_timestamp()

    def utc(self) -> Column:
        return F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))

    def fixed_local(self) -> Column:
        return self.utc() - F.expr(f"INTERVAL {LOCAL_OFFSET_HOURS} HOURS")


def interval(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


def naive_timestamp(moment: datetime | str) -> Column:
    """A naive time literal."""
    text = moment.isoformat(sep=" ") if isinstance(moment, datetime) else moment
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


#: A date with a time behind it; less would be filled up from the day the job runs.
FULL_TIME = r"^\s*[0-9]{4,6}-[0-9]{1,2}-[0-9]{1,2}[ T][0-9]{1,2}:[0-9]{1,2}"


def payload_instant(text: Column) -> Column:
    """The instant a payload names; a text without a full date and time names none."""
    return F.when(text.rlike(FULL_TIME), text.try_cast("timestamp"))


def payload_local(text: Column) -> Column:
    """Payload time text to plant-local naive time; unreadable text gives NULL."""
    return (payload_instant(text) - interval(f"{LOCAL_OFFSET_HOURS} hours")).cast("timestamp_ntz")


def zone_to_instant(local: Column, zone: str = PLANT_ZONE) -> Column:
    """Plant-local naive time back to the instant it names."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local).cast("timestamp")


def time_bucket(width: str, moment: Column) -> Column:
    """Start of the bucket a time falls in, for widths like ``1 day`` or ``15 minutes``."""
    if width in ("1 day", "1 hour", "1 minute"):
        return F.date_trunc(width.split()[1], moment).cast("timestamp_ntz")
    return F.window(moment, width)["start"]


def _column_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def between(
    df: DataFrame,
    lower: Column | None = None,
    upper: Column | None = None,
    *,
    column: str = "timestamp",
    closed_lower: bool = False,
) -> DataFrame:
    """Keep rows in a time range, naming the ``date`` partition too so that whole days are pruned.

    The lower bound is left out unless ``closed_lower``; the upper bound is always left out.
    """
    moment = F.col(column)
    pruned = DAY in df.columns and _column_type(df, DAY) == "date" and column == "timestamp"
    if lower is not None:
        df = df.filter(moment >= lower if closed_lower else moment > lower)
        if pruned:
            df = df.filter(F.col(DAY) >= F.to_date(lower))
    if upper is not None:
        df = df.filter(moment < upper)
        if pruned:
            df = df.filter(F.col(DAY) <= F.to_date(upper))
    return df
