"""Ranges of days, feeds that can be read by day, and tables stored by day."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.sources.contracts import CONTRACTS
from rollcall.sources.feeds import read_feed
from rollcall.sources.store import released


@dataclass(frozen=True)
class DayRange:
    """Closed range of days."""

    first: date
    last: date

    def widened(self, back: int, ahead: int) -> DayRange:
        return DayRange(self.first - timedelta(days=back), self.last + timedelta(days=ahead))

    def holds(self, day: str) -> Column:
        return F.col(day).between(F.lit(self.first), F.lit(self.last))

    def clipped(self, df: DataFrame, start: str, end: str) -> DataFrame:
        """Closed intervals that touch the range, cut to it."""
        first, last = F.lit(self.first), F.lit(self.last)
        return df.where((F.col(start) <= last) & (F.col(end) >= first)).withColumns(
            {start: F.greatest(start, first), end: F.least(end, last)}
        )

    def __iter__(self) -> Iterator[date]:
        for i in range((self.last - self.first).days + 1):
            yield self.first + timedelta(days=i)


class Undated:
    """The rows without a day. No interval holds them."""

    def holds(self, day: str) -> Column:
        return F.col(day).isNull()

    def clipped(self, df: DataFrame, start: str, end: str) -> DataFrame:
        return df.where(F.lit(False))


def parts(days: DayRange, rows: Mapping[date, int], most: int) -> list[DayRange]:
    """The range cut into ranges of at most `most` rows, though of one day at least; `rows` has those of each day."""
    out, first, held = [], days.first, 0
    for day in days:
        n = rows.get(day, 0)
        if held and held + n > most:
            out.append(DayRange(first, day - timedelta(days=1)))
            first, held = day, 0
        held += n
    return [*out, DayRange(first, days.last)]


def spans(days: Iterable[date], gap: int = 0) -> list[DayRange]:
    """The fewest ranges that hold all of `days`; gaps of at most `gap` days are closed."""
    out: list[DayRange] = []
    for day in sorted(set(days)):
        if out and (day - out[-1].last).days <= gap + 1:
            out[-1] = DayRange(out[-1].first, day)
        else:
            out.append(DayRange(day, day))
    return out


class LandedFeeds(Mapping[str, DataFrame]):
    """The feeds below a folder. `between` lists and reads only the partitions asked for."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark, self.root = spark, root

    def __getitem__(self, feed: str) -> DataFrame:
        if feed not in CONTRACTS:
            raise KeyError(feed)
        return read_feed(self._spark, self.root, feed)

    def __iter__(self) -> Iterator[str]:
        return iter(CONTRACTS)

    def __len__(self) -> int:
        return len(CONTRACTS)

    def between(self, feed: str, days: DayRange) -> DataFrame:
        return read_feed(self._spark, self.root, feed, days.first, days.last)

    def days(self, feed: str) -> DataFrame:
        """Days that landed, from the names of the partitions; of the files only footers are read."""
        path = f"{self.root}/{feed}"
        schema = T.StructType([T.StructField("dt", T.DateType())])
        return self._spark.read.schema(schema).option("basePath", path).parquet(path).select("dt").distinct()


def feed_between(feeds: Mapping[str, DataFrame], feed: str, days: DayRange) -> DataFrame:
    """Rows of a day feed that belong to the range, pruned where the feeds can be."""
    if isinstance(feeds, LandedFeeds):
        return feeds.between(feed, days)
    day = CONTRACTS[feed].day
    return feeds[feed].where(F.col(day).cast("date").between(F.lit(days.first), F.lit(days.last)))


def feed_days(feeds: Mapping[str, DataFrame], feed: str) -> DataFrame:
    """The distinct days `dt` of a day feed."""
    if isinstance(feeds, LandedFeeds):
        return feeds.days(feed)
    return feeds[feed].select(F.col(CONTRACTS[feed].day).cast("date").alias("dt")).distinct()


class DayTables:
    """Tables below a folder, partitioned by `local_date`. Replacing a range leaves other days' files alone."""

    DAY = "local_date"
    #: Days of a part up to which each of its tasks writes a file for each day. Beyond that the files would be many.
    FEW = 4

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark, self.root = spark, root
        self._schemas: dict[str, T.StructType] = {}

    def write(self, name: str, df: DataFrame, part: DayRange | Undated | None = None, add: bool = False) -> None:
        """The whole table, for a first build, or a part of its days: the first replaces the table, others `add` to it."""
        self._schemas[name] = df.schema
        mode = "append" if add else "overwrite"
        with released(self._spark):
            self._laid(df, part).write.mode(mode).partitionBy(self.DAY).parquet(f"{self.root}/{name}")

    def replace(self, name: str, df: DataFrame, days: DayRange, part: DayRange | None = None) -> None:
        """The days of the range only, or those of a part of it. Days that have no rows any more lose their partition."""
        days = part or days
        self._schemas[name] = df.schema
        seen = Observation()
        rows = df.where(days.holds(self.DAY)).observe(seen, F.collect_set(self.DAY).alias("days"))
        options = self._laid(rows, part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        with released(self._spark):
            options.partitionBy(self.DAY).parquet(f"{self.root}/{name}")
        for day in set(days) - set(seen.get["days"]):
            self._delete(f"{self.root}/{name}/{self.DAY}={day}")

    def read(self, name: str, days: DayRange | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        reader = self._spark.read.option("basePath", path)
        if schema := self._schemas.get(name):
            df = reader.schema(schema).parquet(path).select(*schema.names)
        else:
            df = reader.parquet(path)
        return df if days is None else df.where(days.holds(self.DAY))

    def _laid(self, df: DataFrame, part: DayRange | Undated | None) -> DataFrame:
        """A part of few days is written as it is, a file for each task and day; other rows are first shuffled by day."""
        few = isinstance(part, Undated) or part is not None and (part.last - part.first).days < self.FEW
        return df if few else self._shaped(df)

    def _shaped(self, df: DataFrame) -> DataFrame:
        return df.hint("rebalance", self.DAY)

    def _delete(self, folder: str) -> None:
        path = self._spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)
