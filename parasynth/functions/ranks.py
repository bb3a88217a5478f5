"""Ranks over a whole column without a single-task sort.

Equal values are counted first (combined map-side, so a value holding most of
the rows becomes one row), distinct values fall into buckets cut at approximate
quantiles, and running counts within buckets are shifted by the totals of the
buckets before them.  The result is exact whatever the cuts are.
"""

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

RANK_BLOCK = 10_000


def _bucketed(df: DataFrame, value: str, splits: list[float]) -> DataFrame:
    edges = sorted({float(s) for s in splits if s == s and abs(s) != float("inf")})
    if not edges:
        return df.withColumn("__b", F.lit(0.0))
    return Bucketizer(
        splits=[float("-inf"), *edges, float("inf")], inputCol=value, outputCol="__b", handleInvalid="keep"
    ).transform(df)


def cumulative(
    df: DataFrame, value: str, weights: dict[str, Column] | None = None, group: Sequence[str] = (), buckets: int | None = None,
    cuts_from: DataFrame | None = None,
) -> DataFrame:
    """Per distinct (group, value): each weight's sum there and below it.

    Columns ``<w>`` and ``<w>_below``; the default weight ``n`` counts rows.
    ``cuts_from`` may be a cheaper table to take the bucket cuts from.
    """
    weights = weights or {"n": F.lit(1)}
    df = df.filter(F.col(value).isNotNull())
    sampled = df if cuts_from is None else cuts_from
    # A bucket is sorted by one task: their number follows the rows, within what a plan can hold.
    buckets = buckets or max(256, min(20_000, sampled.count() // 1_000_000))
    step = 1.0 / buckets
    splits = sampled.select(F.col(value).cast("double").alias(value)).approxQuantile(value, [i * step for i in range(1, buckets)], step / 4)
    reduced = df.groupBy(*group, value).agg(*[F.sum(w).alias(n) for n, w in weights.items()])
    reduced = _bucketed(reduced.withColumn("__v", F.col(value).cast("double")), "__v", splits).drop("__v")
    before = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    totals = reduced.groupBy(*group, "__b").agg(*[F.sum(n).alias(f"__t_{n}") for n in weights])
    totals = totals.select(  # at most ``buckets`` rows per group
        *group, "__b", *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in weights]
    )
    if not group:
        totals = F.broadcast(totals)  # at most ``buckets`` rows
    inside = Window.partitionBy(*group, "__b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    out = reduced.withColumns({f"{n}_below": F.coalesce(F.sum(n).over(inside), F.lit(0)) for n in weights})
    out = out.join(totals, [*group, "__b"])
    return out.select(
        *group, value, *weights, *[(F.col(f"{n}_below") + F.col(f"__o_{n}")).alias(f"{n}_below") for n in weights]
    )


def ordinal_rank(df: DataFrame, value: str, row: str, out: str = "rank") -> DataFrame:
    """Add 1..n by ``value``, equal values in order of the unique ``row``.

    Only rows that share their value are ranked a second time, by ``row``
    within the value and again in buckets.
    """
    counts = cut_lineage(cumulative(df, value))
    marked = df.join(counts, value)
    alone = marked.filter(F.col("n") == 1).withColumn(out, (F.col("n_below") + 1).cast("long")).drop("n", "n_below")
    shared = marked.filter(F.col("n") > 1).withColumnRenamed("n_below", "__base").drop("n")
    places = cumulative(shared, row, group=[value], cuts_from=df).select(value, row, F.col("n_below").alias("__place"))
    shared = shared.join(places, [value, row]).withColumn(
        out, (F.col("__base") + F.col("__place") + 1).cast("long")
    ).drop("__base", "__place")
    return alone.unionByName(shared)


def value_at_rank(df: DataFrame, rank: str, values: DataFrame, value: str) -> DataFrame:
    """Add the ``rank``-th smallest ``value`` of ``values`` to each row.

    Values stand for intervals of ranks, cut at fixed blocks of ranks, so one
    repeated many times is many balanced pieces. Within a block, rows and the
    starts of intervals are put in one order and each row takes the value that
    started last: work in proportion to rows and pieces.
    """
    block = lambda r: F.floor((r - 1) / F.lit(RANK_BLOCK)).cast("long")
    spans = cumulative(values, value).select(
        value, (F.col("n_below") + 1).alias("__from"), (F.col("n_below") + F.col("n")).alias("__to")
    )
    pieces = spans.withColumn("__block", F.explode(F.sequence(block(F.col("__from")), block(F.col("__to"))))).select(
        "__block", F.greatest(F.col("__from"), F.col("__block") * RANK_BLOCK + 1).alias("__rank"), F.lit(0).alias("__kind"),
        F.struct(value, "__to").alias("__span"),
    )
    rows = df.select(
        block(F.col(rank)).alias("__block"), F.col(rank).cast("long").alias("__rank"), F.lit(1).alias("__kind"), F.struct("*").alias("__row")
    )
    order = Window.partitionBy("__block").orderBy("__rank", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    both = pieces.unionByName(rows, allowMissingColumns=True).withColumn("__last", F.last("__span", True).over(order))
    return both.filter((F.col("__kind") == 1) & (F.col("__rank") <= F.col("__last.__to"))).select("__row.*", F.col(f"__last.{value}").alias(value))


def auc(df: DataFrame, score: str, positive: Column, group: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve (ties count half), one row per group."""
    hit = F.when(positive, 1).otherwise(0)
    c = cumulative(df, score, {"pos": hit, "neg": 1 - hit}, group)
    return c.groupBy(*group).agg(
        F.try_divide(
            F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)), F.sum("pos").cast("double") * F.sum("neg")
        ).alias("roc_auc")
    )
