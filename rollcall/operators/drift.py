"""Exact quantiles and the population stability index, without gathering values in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLICES = 200


def exact_quantiles(df: DataFrame, value: str, probabilities: list[float] | Column) -> DataFrame:
    """One row with `q`, the linearly interpolated quantiles in the order asked for. The probabilities may be an array
    that the query itself computes.

    Equal values are counted together first. Approximate quantiles of the distinct values then
    cut them into slices of about equal size, whatever their distribution; where exactly the
    cuts fall does not matter to the answer. Counts per slice give each slice its starting
    rank, so exact ranks need a window inside a slice only, and only in the few slices that
    hold an asked-for rank.
    """
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(value).cast("double").alias("x"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    fractions = [i / SLICES for i in range(1, SLICES)]
    cuts = counted.agg(F.percentile_approx("x", fractions, 100 * SLICES))
    sliced = counted.withColumn("cuts", cuts.scalar()).select(
        "x", "n", F.size(F.filter("cuts", lambda c: c <= F.col("x"))).alias("slice")
    )

    # One row per slice, so at most SLICES rows whatever the number of values.
    so_far = W.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        sliced.groupBy("slice")
        .agg(F.sum("n").alias("size"))
        .withColumn("start", F.coalesce(F.sum("size").over(so_far), F.lit(0)))
        .withColumn("total", F.sum("size").over(W.partitionBy()))
    )
    if not isinstance(probabilities, Column):
        probabilities = F.array(*map(F.lit, probabilities))
    rank = F.col("p") * (F.col("total") - 1)
    needed = (
        starts.select("*", F.posexplode(probabilities).alias("i", "p"))
        .select(
            "slice",
            "start",
            "size",
            "i",
            (rank - F.floor(rank)).alias("t"),
            F.floor(rank).alias("below"),
            F.ceil(rank).alias("above"),
        )
        .select(
            "slice",
            "start",
            "size",
            "i",
            "t",
            F.inline(
                F.array(
                    F.struct(F.lit("a").alias("side"), F.col("below").alias("rank")),
                    F.struct(F.lit("b").alias("side"), F.col("above").alias("rank")),
                )
            ),
        )
        .where("rank >= start AND rank < start + size")
    )
    within = W.partitionBy("slice").orderBy("x")
    # At most two asks per probability, so these lists have a fixed bound.
    hits = needed.groupBy("slice").agg(
        F.max("start").alias("start"),
        F.collect_list(F.struct("i", "t", "side", "rank")).alias("asks"),
    )
    running = F.sum("n").over(within.rowsBetween(W.unboundedPreceding, W.currentRow))
    found = (
        sliced.join(hits, "slice")
        .withColumn("upto", F.col("start") + running)
        .select("x", "n", "upto", F.inline("asks"))
        .where("rank < upto AND rank >= upto - n")
    )
    pairs = found.groupBy("i").agg(
        F.max("t").alias("t"),
        F.max(F.when(F.col("side") == "a", F.col("x"))).alias("a"),
        F.max(F.when(F.col("side") == "b", F.col("x"))).alias("b"),
    )
    answers = F.sort_array(F.collect_list(F.struct("i", _between().alias("q"))))
    return pairs.agg(answers.alias("r")).select(F.col("r.q").alias("q"))


def _between() -> Column:
    """Linear interpolation taken from the nearer end, as numerical libraries do."""
    a, b, t = F.col("a"), F.col("b"), F.col("t")
    return F.when(t < 0.5, a + (b - a) * t).otherwise(b - (b - a) * (1 - t))


def _fractions(buckets: Column) -> Column:
    """0, 1/buckets, ..., 1."""
    return F.transform(
        F.sequence(F.lit(0), buckets),
        lambda i: F.when(i == buckets, F.lit(1.0)).otherwise(i * (F.lit(1.0) / buckets)),
    )


def bucket_index(x: Column, edges: Column, buckets: int) -> Column:
    """1-based bucket of `x` between sorted edges, null outside them.

    Buckets are closed on the left, the last one on both sides.
    """
    last = F.size(edges) - 1
    inside = (x >= F.get(edges, F.lit(0))) & (x <= F.get(edges, last))
    passed = sum(F.when(F.get(edges, F.lit(i)) <= x, 1).otherwise(0) for i in range(buckets + 1))
    return F.when(inside, F.least(passed, last))


def psi(
    baseline: DataFrame, recent: DataFrame, value: str, buckets: int = 10, min_per_bucket: int = 8
) -> DataFrame:
    """Population stability index of `recent` against `baseline`: one row with `psi`,
    `buckets`, `baseline_n` and `recent_n`.

    Edges are quantiles of the baseline. The number of buckets shrinks with the smaller sample,
    down to two; too few values or fewer than three distinct edges can't be measured and give null.
    """
    x = F.col(value).cast("double").alias("x")
    baseline = baseline.where(F.col(value).isNotNull()).select(x, F.lit(False).alias("is_recent"))
    recent = recent.where(F.col(value).isNotNull()).select(x, F.lit(True).alias("is_recent"))
    both = baseline.unionByName(recent)
    sizes = [
        F.count_if(~F.col("is_recent")).alias("baseline_n"),
        F.count_if("is_recent").alias("recent_n"),
    ]
    enough = F.floor(F.least("baseline_n", "recent_n") / min_per_bucket).cast("int")
    used = F.least(F.lit(buckets), F.greatest(enough, F.lit(2)))

    # The bucket count depends on the data, so the query asks for its own quantiles.
    asked = both.agg(*sizes).select(_fractions(used))
    quantiles = exact_quantiles(baseline, "x", asked.scalar())
    edges = quantiles.select(F.sort_array(F.array_distinct("q")).alias("edges"))
    placed = both.select("is_recent", "x", edges.scalar().alias("edges")).select(
        "is_recent",
        F.size("edges").alias("n_edges"),
        bucket_index(F.col("x"), F.col("edges"), buckets).alias("bucket"),
    )
    hit = [F.col("bucket") == i + 1 for i in range(buckets)]
    counted = placed.agg(
        *sizes,
        F.max("n_edges").alias("n_edges"),
        F.array(*(F.count_if(~F.col("is_recent") & h) for h in hit)).alias("before"),
        F.array(*(F.count_if(F.col("is_recent") & h) for h in hit)).alias("after"),
    ).withColumn("buckets", used)
    width = F.greatest(F.col("n_edges") - 1, F.lit(0))
    parts = F.zip_with(
        _shares(F.slice("before", F.lit(1), width)),
        _shares(F.slice("after", F.lit(1), width)),
        lambda e, a: (a - e) * F.log(a / e),
    )
    total = F.aggregate(parts, F.lit(0.0), lambda acc, v: acc + v)
    measurable = (
        (F.col("baseline_n") >= F.col("buckets")) & (F.col("recent_n") > 0) & (F.col("n_edges") >= 3)
    )
    return counted.select(
        F.when(measurable, total).alias("psi"),
        "buckets",
        "baseline_n",
        "recent_n",
    )


def _shares(counts: Column) -> Column:
    total = F.greatest(F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, v: a + v), F.lit(1))
    return F.transform(counts, lambda c: F.greatest(c / total, F.lit(1e-6)))
