"""Reading evaluation tables, writing data, parameters and cards."""

import logging

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def read_headerless_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path)


def with_targets(features: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    return features.join(targets, key)


def write_results(df: DataFrame, path: str) -> bool:
    """Header CSV; an empty table writes nothing, a failed write is logged."""
    if df.isEmpty():
        return False
    try:
        df.write.mode("overwrite").option("header", True).csv(path)
    except PySparkException as error:
        log.warning("could not write %s: %s", path, error)
        return False
    return True


def write_dataset(df: DataFrame, path: str, run_id: str, iteration: int, fmt: str = "parquet") -> str:
    """Kept data under ``run_id=.../iteration=...``."""
    target = f"{path}/run_id={run_id}/iteration={iteration}"
    writer = df.write.mode("overwrite")
    (writer.option("header", True).csv if fmt == "csv" else writer.parquet)(target)
    return target


def parameters_json(variables: DataFrame, correlations: DataFrame, meta: DataFrame) -> DataFrame:
    """(source_id, json): variables and correlations as objects in their order."""
    shares = F.when(
        F.size("categories") > 0, F.map_from_entries(F.transform("categories", lambda c: F.struct(c["label"], c["prob"])))
    )
    v = variables.withColumn("categories", shares).groupBy("source_id").agg(
        F.array_sort(F.collect_list(F.struct("var_pos", F.to_json(F.struct("name")).alias("k"), F.to_json(
            F.struct("name", "distribution", "mean", "std", "min", "max", "categories"), {"ignoreNullFields": "false"}
        ).alias("j")))).alias("v")
    )
    c = correlations.groupBy("source_id").agg(
        F.array_sort(F.collect_list(F.struct("corr_pos", F.to_json(F.struct("key")).alias("k"), F.to_json(
            F.struct("var1", "var2", "correlation", "direction")
        ).alias("j")))).alias("c")
    )
    # A one-field object is {"name":"x"}: its quoted value starts after the field name.
    listed = lambda column, skip: F.concat(
        F.lit("{"),
        F.array_join(F.transform(column, lambda e: F.concat(F.substring(e["k"], skip, 1 << 30).substr(F.lit(1), F.length(e["k"]) - skip), F.lit(":"), e["j"])), ","),
        F.lit("}"),
    )
    info = F.to_json(F.struct("source", F.date_format("extracted_at", "yyyy-MM-dd'T'HH:mm:ss").alias("extracted_at"), "extraction_method"))
    joined = meta.join(v, "source_id", "left").join(c, "source_id", "left")
    return joined.select(
        "source_id",
        F.concat(
            F.lit('{"variables":'), F.coalesce(listed("v", 9), F.lit("{}")), F.lit(',"correlations":'),
            F.coalesce(listed("c", 8), F.lit("{}")), F.lit(',"meta":'), info, F.lit("}"),
        ).alias("json"),
    )


def write_parameters(variables: DataFrame, correlations: DataFrame, meta: DataFrame, path: str) -> None:
    parameters_json(variables, correlations, meta).select("json").write.mode("overwrite").text(path)


def write_cards(cards: DataFrame, path: str) -> None:
    """Cards are multi-line: one JSON record (source_id, card) per source."""
    cards.write.mode("overwrite").json(path)
