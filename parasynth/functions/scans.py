"""Running values along a long group without sorting it in one task.

Positions are cut into fixed ranges; each range is reduced first, the ranges
(few) are scanned, and rows only look inside their own range.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE = 1 << 16


def running_before(df: DataFrame, group: list[str], position: str, outputs: dict[str, tuple], span: int = RANGE) -> DataFrame:
    """Add, per output ``name: (aggregate, column)``, its value over earlier rows.

    ``aggregate`` is ``F.max`` or ``F.sum``; positions are distinct integers
    within a group.  Rows with nothing before them get NULL.
    """
    keyed = df.withColumn("__c", F.floor(F.col(position) / span).cast("long"))
    tops = keyed.groupBy(*group, "__c").agg(*[agg(value).alias(f"__t_{n}") for n, (agg, value) in outputs.items()])
    earlier = Window.partitionBy(*group).orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(*group, "__c", *[agg(f"__t_{n}").over(earlier).alias(f"__o_{n}") for n, (agg, _) in outputs.items()])
    inside = Window.partitionBy(*group, "__c").orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    out = keyed.withColumns({f"__i_{n}": agg(value).over(inside) for n, (agg, value) in outputs.items()})
    out = out.join(tops, [*group, "__c"])
    merged = {
        n: F.greatest(f"__i_{n}", f"__o_{n}") if agg is F.max
        else F.when(F.col(f"__i_{n}").isNull(), F.col(f"__o_{n}")).otherwise(F.col(f"__i_{n}") + F.coalesce(F.col(f"__o_{n}"), F.lit(0)))
        for n, (agg, _) in outputs.items()
    }
    return out.withColumns(merged).drop("__c", *[f"__{k}_{n}" for n in outputs for k in "io"])
