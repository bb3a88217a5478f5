"""What the loop keeps on disk: data, parameters and card of every source, newest improvement first.

A write makes a new version of each table for the sources that improved, and
the manifest of the version comes last. Readers take, per source, the newest
version that a manifest names, so a write that was cut off changes nothing and
the next one overwrites what it left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..operators import synthesize, validate
from ..plans import optimize
from ..session import cut_lineage
from .files import parameters_json

MANIFEST = "source_id string, iteration int, score double, noise double, version int"


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(source_id, iteration, score, noise, version): the newest entry of every source."""
    if not _exists(spark, f"{folder}/manifest"):
        return spark.createDataFrame([], MANIFEST)
    entries = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    newest = entries.groupBy("source_id").agg(F.max_by(F.struct("iteration", "score", "noise", "version"), "version").alias("m"))
    return newest.select("source_id", "m.*")


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder has a finished version."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS"))
    return found is not None and len(found) > 0


def write_improved(
    folder: str, state: DataFrame, variables: DataFrame, correlations: DataFrame, meta: DataFrame,
    n_rows: int = fv.DEFAULT_ROWS, seed: int = fv.DEFAULT_SEED, thresholds: dict | None = None,
) -> DataFrame:
    """Write the sources of ``state`` that are better than what ``folder`` has; return the manifest.

    ``state`` is that of ``optimize.run_loop``. Sources that never improved are
    left out. Nothing improved: no version is written.
    """
    spark = variables.sparkSession
    known = cut_lineage(manifest(spark, folder))
    before = known.select("source_id", F.col("score").alias("known"))
    better = state.filter(F.col("best_iteration").isNotNull()).join(before, "source_id", "left").filter(F.col("known").isNull() | (F.col("best_score") > F.col("known")))
    better = cut_lineage(better.drop("known"))
    if better.isEmpty():
        return known
    version = (known.agg(F.max("version")).first()[0] or 0) + 1
    own = lambda df: df.join(better.select("source_id"), "source_id", "left_semi")
    v, c, m = own(variables), own(correlations), own(meta)
    vectors = optimize.best_data(v, c, better, n_rows, seed).persist()
    try:
        synthesize.long_form(vectors, v).write.mode("overwrite").parquet(f"{folder}/data/version={version}")
        cards = validate.datacard(validate.validate(vectors, v, c, thresholds), v, m, thresholds)
        cards.write.mode("overwrite").json(f"{folder}/cards/version={version}")
    finally:
        vectors.unpersist()
    parameters_json(v, c, m).write.mode("overwrite").json(f"{folder}/parameters/version={version}")
    entries = better.select("source_id", F.col("best_iteration").alias("iteration"), F.col("best_score").alias("score"), F.col("best_noise").alias("noise"))
    entries.write.mode("overwrite").parquet(f"{folder}/manifest/version={version}")
    return manifest(spark, folder)


def read_kept(spark: SparkSession, folder: str, what: str = "data") -> DataFrame:
    """The kept rows of every source: ``data`` (source_id, row_id, name, num_value, str_value), ``cards`` or ``parameters``."""
    kinds = {
        "data": "source_id string, row_id bigint, name string, num_value double, str_value string, version int",
        "cards": "source_id string, card string, version int", "parameters": "source_id string, json string, version int",
    }
    reader = spark.read.schema(kinds[what])
    rows = (reader.parquet if what == "data" else reader.json)(f"{folder}/{what}")
    return rows.join(manifest(spark, folder).select("source_id", "version"), ["source_id", "version"], "left_semi").drop("version")
