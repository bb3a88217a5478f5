"""Parameter tables and their coercion rules (repair, never reject).

``variables``     one row per (source, variable), in ``var_pos`` order
``correlations``  one row per (source, declared pair), in ``corr_pos`` order
``meta``          one row per source

``categories`` is an array, not a map: the position of a label is its code.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed_values as fv
from .functions.arrays import bind
from .functions.numeric import clamp

CATEGORY = "struct<label:string,prob:double>"
CATEGORIES = f"array<{CATEGORY}>"
VARIABLE_FIELDS = (
    "name string, distribution string, mean double, std double, min double, max double, "
    f"categories {CATEGORIES}"
)
CORRELATION_FIELDS = "key string, var1 string, var2 string, correlation double, direction string"
VARIABLES = f"source_id string, var_pos bigint, {VARIABLE_FIELDS}"
CORRELATIONS = f"source_id string, corr_pos bigint, {CORRELATION_FIELDS}"
META = "source_id string, source string, extracted_at timestamp, extraction_method string"

VARIABLE_COLUMNS = ("name", "distribution", "mean", "std", "min", "max", "categories")
CORRELATION_COLUMNS = ("key", "var1", "var2", "correlation", "direction")


def known_distribution(name: Column) -> Column:
    return F.when(name.isin(*fv.DISTRIBUTIONS), name).otherwise(F.lit(fv.DEFAULT_DISTRIBUTION))


def normalised(categories: Column) -> Column:
    """Probabilities summing to one; no usable mass gives NULL."""
    total = lambda cs: F.aggregate(cs, F.lit(0.0), lambda acc, c: acc + c["prob"])
    shares = lambda cs, t: F.transform(
        cs, lambda c: F.struct(c["label"].alias("label"), F.try_divide(c["prob"], t).alias("prob"))
    )
    return bind(categories, lambda cs: F.when(F.size(cs) == 0, cs).otherwise(
        bind(total(cs), lambda t: F.when(t > 0, shares(cs, t)))
    ))


def has_categories(categories: Column) -> Column:
    return F.coalesce(F.size(categories) > 0, F.lit(False))


def settled_distribution(distribution: Column, categories: Column) -> Column:
    """A categorical variable without categories counts as normal."""
    return F.when(
        (distribution == "categorical") & ~has_categories(categories), F.lit(fv.DEFAULT_DISTRIBUTION)
    ).otherwise(distribution)


def valid_correlation(value: Column) -> Column:
    """Into [-1, 1]; unreadable (NULL) becomes 0; NaN becomes 1."""
    return F.coalesce(clamp(value, -1.0, 1.0), F.lit(0.0))


def default_bounds(df: DataFrame) -> DataFrame:
    spread = F.col("std") * fv.BOUND_STD
    return df.withColumns({
        "min": F.coalesce("min", F.col("mean") - spread),
        "max": F.coalesce("max", F.col("mean") + spread),
    })


def coerce_variables(df: DataFrame) -> DataFrame:
    df = df.withColumns({
        "distribution": known_distribution(F.col("distribution")),
        "mean": F.coalesce("mean", F.lit(0.0)),
        "std": F.coalesce("std", F.lit(1.0)),
        "categories": normalised(F.col("categories")),
    })
    return df.withColumn("distribution", settled_distribution(F.col("distribution"), F.col("categories")))


def coerce_correlations(df: DataFrame) -> DataFrame:
    return df.withColumn("correlation", valid_correlation(F.col("correlation")))


def is_categorical() -> Column:
    """Holds on coerced variables."""
    return F.col("distribution") == "categorical"


def is_gamma() -> Column:
    return (F.col("distribution") == "gamma") & (F.col("mean") > 0) & (F.col("std") > 0)


def is_uniform() -> Column:
    return F.col("distribution") == "uniform"


def uniform_low() -> Column:
    return F.coalesce("min", F.col("mean") - F.col("std") * fv.UNIFORM_HALF_WIDTH_STD)


def uniform_high() -> Column:
    return F.coalesce("max", F.col("mean") + F.col("std") * fv.UNIFORM_HALF_WIDTH_STD)


def gamma_shape() -> Column:
    return F.pow(F.try_divide(F.col("mean"), F.col("std")), F.lit(2.0))


def gamma_scale() -> Column:
    return F.try_divide(F.col("std") * F.col("std"), F.col("mean"))


def rejected(sources: DataFrame, variables: DataFrame) -> DataFrame:
    """Sources that cannot be synthesised, with the reason."""
    empty = sources.select("source_id").join(variables, "source_id", "left_anti").select(
        "source_id", F.lit(None).cast("string").alias("name"), F.lit("no variables").alias("reason")
    )
    negative = variables.filter(~is_categorical() & (F.col("std") < 0)).select(
        "source_id", "name", F.lit("negative std").alias("reason")
    )
    return empty.unionByName(negative)
