"""Reading and writing the six feeds as Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.verify import contract_violations, partition_report, require
from rollcall.sources.contracts import CONTRACTS
from rollcall.sources.store import released


def read_feed(spark: SparkSession, root: str, feed: str, since=None, until=None) -> DataFrame:
    """Scan one feed under its declared schema; columns are matched by name across files.

    Day feeds keep their `dt` partition column out of the result, but `since` and `until`
    filter on it, so only the asked-for days are listed and read.
    """
    contract = CONTRACTS[feed]
    path = f"{root}/{feed}"
    if contract.day is None:
        return spark.read.schema(contract.schema).parquet(path)
    schema = contract.schema.add("dt", "date")
    days = spark.read.schema(schema).option("basePath", path).parquet(path)
    if since is not None:
        days = days.where(F.col("dt") >= F.lit(since).cast("date"))
    if until is not None:
        days = days.where(F.col("dt") <= F.lit(until).cast("date"))
    return days.drop("dt")


def read_feeds(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {feed: read_feed(spark, root, feed) for feed in CONTRACTS}


def scan_feed(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """The files of a feed as they landed: their own columns and types, merged across files."""
    landed = spark.read.option("mergeSchema", True).parquet(f"{root}/{feed}")
    return landed.drop("dt") if CONTRACTS[feed].day else landed


def landed_violations(spark: SparkSession, root: str, feeds=tuple(CONTRACTS)) -> DataFrame:
    """Contract counts of landed files, before any schema is imposed; every partition is read."""
    parts = [contract_violations(scan_feed(spark, root, feed), CONTRACTS[feed]) for feed in feeds]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def load_feeds(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All feeds under their declared types; raises `ContractBroken` if the files break a rule."""
    require(landed_violations(spark, root))
    return {
        feed: scan_feed(spark, root, feed).select(
            *(F.col(f.name).cast(f.type).alias(f.name) for f in contract.fields)
        )
        for feed, contract in CONTRACTS.items()
    }


def write_feed(df: DataFrame, root: str, feed: str, replace_days_only: bool = False) -> None:
    """Full refresh of one feed, or (for day feeds) a refresh of just the days present in `df`.

    A day is spread over several tasks by the other columns of its rows: clustering by the day
    alone would send a heavy day to one writer.
    """
    contract = CONTRACTS[feed]
    df = df.select(*(F.col(f.name).cast(f.type).alias(f.name) for f in contract.fields))
    with released(df.sparkSession):
        if contract.day is None:
            df.write.mode("overwrite").parquet(f"{root}/{feed}")
            return
        mode = "dynamic" if replace_days_only else "static"
        (
            df.withColumn("dt", _landing_day(contract.day))
            .hint("rebalance", "dt")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", mode)
            .partitionBy("dt")
            .parquet(f"{root}/{feed}")
        )


def _landing_day(column: str) -> Column:
    return F.col(column).cast("date")


def landed_partitions(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """(partition, rows, violations) of a landed feed: the contract counted by the folder of each file."""
    # Worked out for every row, so without a pattern, which tries each place of the path anew.
    folder = F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1)
    return partition_report(scan_feed(spark, root, feed), CONTRACTS[feed], folder)


def load_report(spark: SparkSession, root: str, feeds=tuple(CONTRACTS)) -> DataFrame:
    """Rows, partitions, partitions in which no rule is broken, and violations per landed feed; a feed without days is
    one partition. Files are read as they landed, so a report can be had of files that break their contract."""
    parts = [
        landed_partitions(spark, root, feed)
        .agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("partitions"),
            F.count_if(F.col("violations") == 0).alias("partitions_validated"),
            F.coalesce(F.sum("violations"), F.lit(0)).alias("violations"),
        )
        .select(F.lit(feed).alias("feed"), "*")
        for feed in feeds
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def write_manifest(counts: DataFrame, path: str) -> None:
    """(key, value) rows, a few of them, as one flat JSON object."""
    pairs = F.map_from_entries(F.collect_list(F.struct("key", F.col("value").cast("double").alias("value"))))
    counts.agg(F.to_json(pairs).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A flat JSON object of counts as (key, value) rows; what isn't a number is null."""
    texts = spark.read.text(path, wholetext=True)
    return texts.select(F.explode(F.from_json("value", "map<string,double>")).alias("key", "value"))
