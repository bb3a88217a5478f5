"""Exact Kolmogorov-Smirnov distance without ranking the column.

With u = F(x), the distance is the largest gap between the running share of
rows and u.  A histogram of u bounds that gap from both sides in every bucket,
and only buckets whose upper bound beats the best value already reached can
hold the maximum.  Those few are refined by a finer histogram and finally by
their distinct values.  Rows are never sorted or shuffled as a whole: each
level is one scan with a map-side combined count, and the histograms (at most
``buckets`` rows per group and level) are kept so that no level is recomputed.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, cut_lineage

BROADCAST_BUCKETS = 1 << 20
FEW_ROWS = 1 << 20


def ks_statistic(long: DataFrame, group: Sequence[str], buckets: int = 4096, levels: int = 2, counted: DataFrame | None = None) -> DataFrame:
    """(group, u) -> (group, n, d).  ``u`` lies in [0, 1]; NULLs are left out.

    ``counted`` is the first histogram (group, path, n, lo, hi) where a scan for
    other statistics has made it already. The table of candidate buckets is
    broadcast where it is counted to be small.
    """
    group = list(group)
    hint = lambda df: broadcast_if_small(df, BROADCAST_BUCKETS)  # noqa: E731  a part of a table written down
    slot = lambda share: F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("long")
    rows = long.filter(F.col("u").isNotNull()).select(*group, "u", slot(F.col("u")).alias("path"))

    if counted is None:
        counted = rows.groupBy(*group, "path").agg(F.count(F.lit(1)).alias("n"), F.min("u").alias("lo"), F.max("u").alias("hi"))
    running = Window.partitionBy(*group).orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    hist = counted.withColumns({
        "before": F.coalesce(F.sum("n").over(running), F.lit(0)), "total": F.sum("n").over(whole),
    })
    hist = cut_lineage(_bounds(hist).withColumn("best", F.max("reached").over(whole)))
    reached = [hist.groupBy(*group).agg(F.first("total").alias("n"), F.max("reached").alias("d"))]

    for level in range(1, levels):
        open_ = hist.filter(F.col("possible") > F.col("best"))
        left = open_.agg(F.sum("n")).first()[0] or 0
        if left <= FEW_ROWS:
            break
        open_ = hint(open_.select(*group, "path", "lo", "hi", "before", "total", "best"))
        share = F.try_divide(F.col("u") - F.col("lo"), F.col("hi") - F.col("lo"))
        rows = rows.join(open_, [*group, "path"]).select(
            *group, "u", F.col("path").alias("parent"), slot(F.coalesce(share, F.lit(0.0))).alias("sub"), "before", "total", "best"
        )
        counted = rows.groupBy(*group, "parent", "sub").agg(
            F.count(F.lit(1)).alias("n"), F.min("u").alias("lo"), F.max("u").alias("hi"),
            F.first("before").alias("base"), F.first("total").alias("total"), F.first("best").alias("best"),
        )
        inside = Window.partitionBy(*group, "parent").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
        hist = _bounds(counted.withColumn("before", F.col("base") + F.coalesce(F.sum("n").over(inside), F.lit(0))))
        hist = cut_lineage(hist.withColumn("path", F.col("parent") * buckets + F.col("sub")))
        rows = rows.select(*group, "u", (F.col("parent") * buckets + F.col("sub")).alias("path"))
        reached.append(hist.groupBy(*group).agg(F.first("total").alias("n"), F.max("reached").alias("d")))

    open_ = hist.filter(F.col("possible") > F.col("best")).select(*group, "path", "before", "total")
    if open_.isEmpty():
        return _largest(reached, group)
    open_ = hint(open_)
    values = rows.join(open_, [*group, "path"]).groupBy(*group, "path", "u").agg(
        F.count(F.lit(1)).alias("n"), F.first("before").alias("base"), F.first("total").alias("total")
    )
    inside = Window.partitionBy(*group, "path").orderBy("u").rowsBetween(Window.unboundedPreceding, -1)
    exact = _bounds(
        values.withColumns({"before": F.col("base") + F.coalesce(F.sum("n").over(inside), F.lit(0)), "lo": F.col("u"), "hi": F.col("u")})
    )
    reached.append(exact.groupBy(*group).agg(F.first("total").alias("n"), F.max("reached").alias("d")))

    return _largest(reached, group)


def _largest(reached: list[DataFrame], group: list[str]) -> DataFrame:
    out = reached[0]
    for part in reached[1:]:
        out = out.unionByName(part)
    return out.groupBy(*group).agg(F.first("n").alias("n"), F.max("d").alias("d"))


def _bounds(df: DataFrame) -> DataFrame:
    """Gap surely reached in a bucket, and the largest one it could hold.

    The first value of a bucket sees the count before it, the last one the
    count up to its end; a value in between cannot beat the mixed ends.
    """
    start = F.col("before") / F.col("total")
    end = (F.col("before") + F.col("n")) / F.col("total")
    return df.withColumns({
        "reached": F.greatest(F.col("lo") - start, end - F.col("hi")),
        "possible": F.greatest(F.col("hi") - start, end - F.col("lo")),
    })
