"""Parameters of several sources into one set per group."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..schemas import CATEGORIES, coerce_correlations, coerce_variables


def lineage(meta: DataFrame, group: str = "merge_group", position: str = "source_pos") -> DataFrame:
    """(source_id of the merged set, source_pos, member, source): always whole."""
    return meta.select(
        F.col(group).cast("string").alias("source_id"), F.col(position).alias("source_pos"),
        F.col("source_id").alias("member"), "source",
    )


def merge_parameters(
    variables: DataFrame,
    correlations: DataFrame,
    meta: DataFrame,
    group: str = "merge_group",
    position: str = "source_pos",
    merge_categories: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Average means, deviations and correlations per name within ``group``.

    ``meta`` names the group and the order of every source.  A group of one
    source passes unchanged.  By default categories are not carried over, so a
    merged categorical variable becomes normal; ``merge_categories`` averages
    label probabilities over the sources that have the variable instead.

    All aggregates combine map-side, so a group with most of the sources does
    not concentrate on one task.  The variables of a merged set are numbered by
    first source, then place in it, after the sources are combined.
    """
    members = meta.select("source_id", F.col(group).cast("string").alias("merged_id"), F.col(position).alias("pos"))
    sizes = members.groupBy("merged_id").agg(F.count(F.lit(1)).alias("n_sources"))

    v = variables.join(members, "source_id").withColumn("place", F.struct("pos", "var_pos"))
    first = lambda c: F.min_by(c, "place").alias(c)
    merged = v.groupBy("merged_id", "name").agg(
        first("distribution"), first("categories"), first("min"), first("max"),
        F.avg("mean").alias("mean"), F.avg("std").alias("std"), F.min("place").alias("place"),
    ).join(sizes, "merged_id")
    single = F.col("n_sources") == 1
    spread = F.col("std") * fv.BOUND_STD
    if merge_categories:
        carried = _averaged_categories(v)
        merged = merged.join(carried, ["merged_id", "name"], "left")
        categories = F.when(single, F.col("categories")).otherwise(F.col("averaged"))
    else:
        categories = F.when(single, F.col("categories")).otherwise(F.lit(None).cast(CATEGORIES))
    out_variables = coerce_variables(
        merged.select(
            F.col("merged_id").alias("source_id"), _order(F.col("place.var_pos"), single).alias("var_pos"),
            "name", "distribution", "mean", "std",
            F.when(single, F.col("min")).otherwise(F.col("mean") - spread).alias("min"),
            F.when(single, F.col("max")).otherwise(F.col("mean") + spread).alias("max"),
            categories.alias("categories"),
        )
    )

    c = correlations.join(members, "source_id").withColumn("place", F.struct("pos", "corr_pos"))
    out_correlations = coerce_correlations(
        c.groupBy("merged_id", "key").agg(
            first("var1"), first("var2"), first("direction"),
            F.avg("correlation").alias("correlation"), F.min("place").alias("place"),
        ).join(sizes, "merged_id").select(
            F.col("merged_id").alias("source_id"), _order(F.col("place.corr_pos"), single).alias("corr_pos"),
            "key", "var1", "var2", "correlation", "direction",
        )
    )
    return out_variables, out_correlations, _merged_meta(meta, members, sizes)


def _order(place, single):
    number = F.row_number().over(Window.partitionBy("merged_id").orderBy("place")) - 1
    return F.when(single, place).otherwise(number).cast("long")


def _averaged_categories(v: DataFrame) -> DataFrame:
    """Mean probability per label over the sources with categories for it."""
    have = v.filter(F.size("categories") > 0)
    n = have.groupBy("merged_id", "name").agg(F.count(F.lit(1)).alias("n"))
    labels = have.select("merged_id", "name", "place", F.posexplode("categories").alias("i", "c")).groupBy(
        "merged_id", "name", F.col("c.label").alias("label")
    ).agg(F.sum("c.prob").alias("mass"), F.min(F.struct("place", "i")).alias("first"))
    return labels.join(n, ["merged_id", "name"]).groupBy("merged_id", "name").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("first", "label", (F.col("mass") / F.col("n")).alias("prob")))),
            lambda x: F.struct(x["label"].alias("label"), x["prob"].alias("prob")),
        ).alias("averaged")
    )


def _merged_meta(meta: DataFrame, members: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per group, its title naming every member in order."""
    joined = meta.join(members, "source_id").join(sizes, "merged_id")
    first = joined.groupBy("merged_id").agg(
        F.first("n_sources").alias("n_sources"),
        F.min_by("extracted_at", "pos").alias("extracted_at"),
        F.min_by("extraction_method", "pos").alias("extraction_method"),
        F.min_by("source", "pos").alias("first_source"),
    )
    names = joined.filter(F.col("n_sources") > 1).groupBy("merged_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "source"))), lambda x: x["source"]), ", ").alias("names")
    )
    title = (
        F.when(F.col("n_sources") == 1, F.col("first_source")).otherwise(F.format_string("merged(%s)", "names"))
    )
    return first.join(names, "merged_id", "left").select(
        F.col("merged_id").alias("source_id"), title.alias("source"), "extracted_at", "extraction_method"
    )
