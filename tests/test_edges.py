"""Degenerate data, continued loops, row counts at block edges, many sources, writers."""

import math

import pytest
from pyspark.sql import functions as F

from parasynth.functions import ranks
from parasynth.operators import merge, synthesize, validate
from parasynth.params import Parameters, Variable
from parasynth.plans import optimize
from parasynth.sources import files

PAIR = Parameters([Variable("a", "normal", 5.0, 1.0), Variable("b", "normal", 0.0, 1.0)])


def test_a_variable_without_deviation_fails(spark):
    flat = Parameters([Variable("a", "normal", 5.0, 0.0), Variable("b", "normal", 0.0, 1.0)])
    made = synthesize.synthesize(spark, PAIR, 2000, noise=0.0, keep_row_id=True).withColumn("a", F.lit(9.0))
    r = validate.validate_table(made, flat, row="row_id").first()
    assert r.ks_score == 50.0 and r.ks_pvalues["a"] == 0.0 and r.ks_stats["a"] is None and r.ks_pvalues["b"] > 0.05


def test_nan_counts_as_missing(spark):
    made = synthesize.synthesize(spark, PAIR, 2000, noise=0.0, keep_row_id=True)
    holed = made.withColumn("a", F.when(F.col("row_id") == 7, F.lit(float("nan"))).otherwise(F.col("a")))
    r = validate.validate_table(holed, PAIR, row="row_id").first()
    assert r.ks_score == 100.0 and r.bias_score == 100.0 and not math.isnan(r.overall_score)


@pytest.mark.parametrize("n", [0, 1, 999, 1000, 1001])
def test_row_counts(spark, n):
    assert synthesize.synthesize_many(*PAIR.tables(spark), n).count() == n


def test_loop_goes_on_with_new_draws(spark):
    v, c = PAIR.tables(spark)
    state, log = optimize.run_loop(v, c, 2, 500)
    state2, more = optimize.run_loop(v, c, 2, 500, start=state)
    assert [r.iteration for r in log.orderBy("iteration").collect()] == [0, 1]
    assert [r.iteration for r in more.orderBy("iteration").collect()] == [2, 3]
    assert state2.first().best_score >= state.first().best_score


def test_kept_data_is_the_scored_data(spark):
    v, c = PAIR.tables(spark)
    state, _ = optimize.run_loop(v, c, 1, 500)
    kept = optimize.best_data(v, c, state, 500)
    again = validate.validate(kept, v, c, privacy=False, buckets=256).first()
    assert again.overall_score == state.first().best_score
    wide = synthesize.wide_form(kept, PAIR)
    assert wide.columns == ["a", "b"] and wide.agg(F.sum("a")).first()[0] == pytest.approx(kept.agg(F.sum(F.get("x", F.lit(0)))).first()[0])


def test_grid_cells_draw_for_themselves(spark):
    rows = optimize.noise_grid(*PAIR.tables(spark), (0, 1), 2, 300).collect()
    assert len(rows) == 4 and len({(r.seed, r.iterations) for r in rows}) == 4


def test_value_at_rank_with_one_common_value(spark):
    values = spark.range(30_000).select(F.when(F.col("id") < 27_000, 5.0).otherwise(F.col("id").cast("double")).alias("v"))
    got = ranks.value_at_rank(spark.range(1, 30_001).withColumnRenamed("id", "r"), "r", values, "v").collect()
    assert len(got) == 30_000
    assert all(x.v == (5.0 if x.r <= 27_000 else float(x.r - 1)) for x in got)


def test_merge_names_all_sources(spark):
    n = 1_001
    v = spark.range(n).select(F.col("id").cast("string").alias("source_id"), F.lit(0).alias("var_pos"), F.lit("x").alias("name"), F.lit("normal").alias("distribution"), F.lit(1.0).alias("mean"), F.lit(1.0).alias("std"), F.lit(None).cast("double").alias("min"), F.lit(None).cast("double").alias("max"), F.lit(None).cast("array<struct<label:string,prob:double>>").alias("categories"))
    c = spark.createDataFrame([], "source_id string, corr_pos int, key string, var1 string, var2 string, correlation double, direction string")
    meta = spark.range(n).select(F.col("id").cast("string").alias("source_id"), F.concat(F.lit("s"), "id").alias("source"), F.current_timestamp().alias("extracted_at"), F.lit("regex").alias("extraction_method"), F.lit("g").alias("merge_group"), (F.col("id") + (1 << 39)).alias("source_pos"))
    out, _, titles = merge.merge_parameters(v, c, meta)
    assert titles.first().source == "merged(" + ", ".join(f"s{i}" for i in range(n)) + ")"
    assert [(r.name, r.var_pos) for r in out.collect()] == [("x", 0)]


def test_writers_and_readers(spark, tmp_path):
    data = synthesize.synthesize(spark, PAIR, 50)
    for fmt in ("parquet", "csv"):
        path = files.write_dataset(data, str(tmp_path / fmt), "r1", 2, fmt)
        back = spark.read.parquet(path) if fmt == "parquet" else spark.read.option("header", True).csv(path)
        assert path.endswith("run_id=r1/iteration=2") and back.count() == 50 and back.columns == ["a", "b"]
    assert files.write_results(data, str(tmp_path / "results")) and not files.write_results(data.limit(0), str(tmp_path / "none"))
    v, c = PAIR.tables(spark)
    meta = v.select("source_id").distinct().select("source_id", F.lit("s").alias("source"), F.current_timestamp().alias("extracted_at"), F.lit("regex").alias("extraction_method"))
    files.write_parameters(v, c, meta, str(tmp_path / "p"))
    assert '"variables":{"a":' in spark.read.text(str(tmp_path / "p")).first()[0]
    files.write_cards(spark.createDataFrame([("s", "# card\ntext")], "source_id string, card string"), str(tmp_path / "cards"))
    assert spark.read.json(str(tmp_path / "cards")).first().card == "# card\ntext"
    (tmp_path / "x.csv").write_text("1,2.5\n2,3.5\n")
    features = files.read_headerless_csv(spark, str(tmp_path / "x.csv"), "id int, f double")
    assert files.with_targets(features, spark.createDataFrame([(1, "y")], "id int, target string"), "id").collect() == [(1, 2.5, "y")]


@pytest.mark.parametrize("k", [12, 40])
def test_correlations_of_many_variables(spark, k):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, k)) + 1000.0
    x[:, 1] = x[:, 0] * 0.5 + x[:, 1]
    x[:, 2] = 7.0
    rows = [("s", [None if (r, c) in {(3, 0), (9, 5)} else float(x[r, c]) for c in range(k)]) for r in range(400)]
    got = {(r.i, r.j): r.r for r in validate.vector_correlations(spark.createDataFrame(rows, "source_id string, x array<double>"), k).collect()}
    assert len(got) == k * (k - 1) // 2 and got[0, 2] == 0.0
    seen = np.delete(x, 3, axis=0)
    assert got[0, 1] == pytest.approx(np.corrcoef(seen[:, 0], seen[:, 1])[0, 1], abs=1e-9)
    assert got[3, 4] == pytest.approx(np.corrcoef(x[:, 3], x[:, 4])[0, 1], abs=1e-9)
