"""Real tables to parameter tables.

One pass over the rows builds *cells*: per source and combination of labels,
the count, means and centred moments of the continuous columns.  Cells are
merged by the usual parallel-variance rule, so the rows are read once, combined
map-side, and a source or label holding most of the rows costs nothing extra.
"""

from collections.abc import Sequence
from itertools import combinations
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.numeric import safe_ratio
from ..functions.text import fixed4
from ..schemas import CATEGORIES, CORRELATION_COLUMNS, CORRELATIONS, VARIABLE_COLUMNS
from ..session import cut_lineage


class Profile(NamedTuple):
    variables: DataFrame
    correlations: DataFrame


def cells(df: DataFrame, continuous: Sequence[str], categorical: Sequence[str], source: str | None = None) -> DataFrame:
    """Sufficient statistics per (source, label combination).

    Rows with a missing value in a used column are dropped.
    """
    used = [*continuous, *categorical]
    df = df.na.drop(subset=used)
    sid = F.col(source).cast("string") if source else F.lit("table")
    df = df.select(
        sid.alias("source_id"),
        *[F.col(c).cast("double").alias(c) for c in continuous],
        *[F.col(c).cast("string").alias(c) for c in categorical],
    )
    n = F.count(F.lit(1))
    aggregates = [n.alias("n")]
    for c in continuous:
        aggregates += [F.avg(c).alias(f"avg_{c}"), (F.var_pop(c) * n).alias(f"m2_{c}")]
    for a, b in combinations(continuous, 2):
        aggregates.append((F.covar_pop(a, b) * n).alias(f"cm_{a}__{b}"))
    return df.groupBy("source_id", *categorical).agg(*aggregates)


def continuous_moments(cell: DataFrame, continuous: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation per source, from cells."""
    means = cell.groupBy("source_id").agg(
        F.sum("n").alias("total"),
        *[safe_ratio(F.sum(F.col("n") * F.col(f"avg_{c}")), F.sum("n")).alias(f"mean_{c}") for c in continuous],
    )
    around = cell.join(means, "source_id").groupBy("source_id").agg(
        F.first("total").alias("total"),
        *[F.first(f"mean_{c}").alias(f"mean_{c}") for c in continuous],
        *[
            F.sum(F.col(f"m2_{c}") + F.col("n") * F.pow(F.col(f"avg_{c}") - F.col(f"mean_{c}"), F.lit(2.0))).alias(f"ss_{c}")
            for c in continuous
        ],
    )
    return around.withColumns(
        {f"std_{c}": F.sqrt(F.try_divide(F.col(f"ss_{c}"), F.col("total") - 1)) for c in continuous}
    )


def category_shares(cell: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """(source_id, name, categories) with labels in alphabetical order."""
    if not categorical:
        return cell.sparkSession.createDataFrame([], f"source_id string, name string, categories {CATEGORIES}")
    long = cell.unpivot(["source_id", "n"], list(categorical), "name", "label")
    counts = long.groupBy("source_id", "name", "label").agg(F.sum("n").alias("count"))
    grouped = counts.groupBy("source_id", "name").agg(
        F.sum("count").alias("total"),
        F.array_sort(F.collect_list(F.struct("label", "count"))).alias("labels"),
    )
    shares = F.transform(
        "labels", lambda x: F.struct(x["label"].alias("label"), (x["count"] / F.col("total")).alias("prob"))
    )
    return grouped.select("source_id", "name", shares.alias("categories"))


def pair_list(continuous: Sequence[str], categorical: Sequence[str], target: str | None) -> list[tuple[str, str]]:
    pairs = []
    if target is not None:
        pairs += [(c, target) for c in continuous if c != target]
        pairs += [(c, target) for c in categorical if c != target]
    return pairs + list(combinations(continuous, 2))


def pair_correlations(cell: DataFrame, shares: DataFrame, continuous, categorical, pairs) -> DataFrame:
    """Pearson correlations of the listed pairs, labels coded 0, 1, 2, ..."""
    coded = cell
    needed = [c for c in categorical if any(c in p for p in pairs)]
    for c in needed:
        codes = shares.filter(F.col("name") == c).select(
            "source_id", F.posexplode("categories").alias(f"code_{c}", "entry")
        ).select("source_id", F.col("entry.label").alias(c), F.col(f"code_{c}").cast("double"))
        coded = coded.join(codes, ["source_id", c])
    value = {c: F.col(f"avg_{c}") for c in continuous} | {c: F.col(f"code_{c}") for c in needed}
    means = coded.groupBy("source_id").agg(
        *[(F.sum(F.col("n") * v) / F.sum("n")).alias(f"mean_{c}") for c, v in value.items()]
    )
    away = {c: v - F.col(f"mean_{c}") for c, v in value.items()}
    within = lambda c: F.col(f"m2_{c}") if c in continuous else F.lit(0.0)
    together = lambda a, b: F.col(f"cm_{a}__{b}") if a in continuous and b in continuous else F.lit(0.0)
    sums = coded.join(means, "source_id").groupBy("source_id").agg(
        *[F.sum(within(c) + F.col("n") * away[c] * away[c]).alias(f"ss_{c}") for c in value],
        *[F.sum(together(a, b) + F.col("n") * away[a] * away[b]).alias(f"sp_{a}__{b}") for a, b in pairs],
    )
    rows = [
        F.struct(
            F.lit(i).cast("long").alias("corr_pos"), F.lit(f"{a}__{b}").alias("key"),
            F.lit(a).alias("var1"), F.lit(b).alias("var2"),
            F.try_divide(F.col(f"sp_{a}__{b}"), F.sqrt(F.col(f"ss_{a}")) * F.sqrt(F.col(f"ss_{b}"))).alias("correlation"),
        )
        for i, (a, b) in enumerate(pairs)
    ]
    out = sums.select("source_id", F.explode(F.array(*rows)).alias("p")).select("source_id", "p.*")
    out = out.filter(F.col("correlation").isNotNull())
    return out.withColumn("direction", F.when(F.col("correlation") >= 0, "positive").otherwise("negative"))


def profile_table(
    df: DataFrame,
    continuous: Sequence[str],
    categorical: Sequence[str] = (),
    target: str | None = None,
    source: str | None = None,
) -> Profile:
    """Means, deviations, label shares and correlations of a table.

    With ``source`` the table holds many data sets, profiled in one job.
    ``target`` (a categorical column) is listed last, as in the source texts.
    The cells feed four aggregates, so they are materialised once.
    """
    labels = [c for c in categorical if c != target] + ([target] if target else [])
    cell = cut_lineage(cells(df, continuous, labels, source))
    order = {c: i for i, c in enumerate([*continuous, *labels])}
    rows = [
        F.struct(
            F.lit(order[c]).cast("long").alias("var_pos"), F.lit(c).alias("name"),
            F.lit("normal").alias("distribution"),
            F.col(f"mean_{c}").alias("mean"), F.col(f"std_{c}").alias("std"),
            (F.col(f"mean_{c}") - F.col(f"std_{c}") * fv.BOUND_STD).alias("min"),
            (F.col(f"mean_{c}") + F.col(f"std_{c}") * fv.BOUND_STD).alias("max"),
            F.lit(None).cast(CATEGORIES).alias("categories"),
        )
        for c in continuous
    ]
    parts = []
    if rows:
        moments = continuous_moments(cell, continuous)
        parts.append(moments.select("source_id", F.explode(F.array(*rows)).alias("v")).select("source_id", "v.*"))
    shares = category_shares(cell, labels)
    if labels:
        position = F.element_at(F.create_map(*[F.lit(x) for c in labels for x in (c, order[c])]), F.col("name"))
        parts.append(
            shares.select(
                "source_id", position.cast("long").alias("var_pos"), "name", F.lit("categorical").alias("distribution"),
                F.lit(0.0).alias("mean"), F.lit(1.0).alias("std"), F.lit(None).cast("double").alias("min"),
                F.lit(None).cast("double").alias("max"), "categories",
            )
        )
    variables = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    pairs = pair_list(continuous, [c for c in labels if c != target], target)
    if pairs:
        correlations = pair_correlations(cell, shares, list(continuous), labels, pairs)
    else:
        correlations = df.sparkSession.createDataFrame([], CORRELATIONS)
    return Profile(
        variables.select("source_id", "var_pos", *VARIABLE_COLUMNS),
        correlations.select("source_id", "corr_pos", *CORRELATION_COLUMNS),
    )


def sentences(variables: DataFrame, correlations: DataFrame) -> DataFrame:
    """(source_id, section, pos, line): one line per parameter."""
    phrases = F.transform(
        "categories", lambda c: F.format_string(fv.CATEGORY_PHRASE, c["label"], fixed4(c["prob"]))
    )
    size = F.size("categories")
    listed = (
        F.when(size == 1, F.concat(F.lit(", and "), F.element_at(phrases, 1)))
        .when(size == 2, F.array_join(phrases, " and "))
        .otherwise(F.concat(F.array_join(F.slice(phrases, 1, F.greatest(size - 1, F.lit(0))), ", "), F.lit(", and "), F.element_at(phrases, -1)))
    )
    categorical = F.col("distribution") == "categorical"
    described = variables.select(
        "source_id", F.when(categorical, 1).otherwise(0).alias("section"), F.col("var_pos").alias("pos"),
        F.when(categorical, F.format_string(fv.CATEGORICAL_SENTENCE, "name", listed))
        .otherwise(F.format_string(fv.MEAN_STD_SENTENCE, "name", fixed4(F.col("mean")), fixed4(F.col("std")))).alias("line"),
    )
    related = correlations.select(
        "source_id", F.lit(2).alias("section"), F.col("corr_pos").alias("pos"),
        F.format_string(fv.CORRELATION_SENTENCE, "var1", "var2", fixed4(F.col("correlation"))).alias("line"),
    )
    return described.unionByName(related)


def source_text(variables: DataFrame, correlations: DataFrame) -> DataFrame:
    """One descriptive text per source; its size is its parameter count."""
    lines = sentences(variables, correlations)
    ordered = F.array_sort(F.collect_list(F.struct("section", "pos", "line")))
    return lines.groupBy("source_id").agg(
        F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("text")
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, count, mean, std, min, max) per numeric column in one pass."""
    aggregates = []
    for c in columns:
        x = F.col(c).cast("double")
        aggregates.append(
            F.struct(
                F.lit(c).alias("name"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
            ).alias(c)
        )
    return df.agg(*aggregates).select(F.explode(F.array(*columns)).alias("r")).select("r.*")
