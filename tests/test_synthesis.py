"""Random numbers, synthesis, ranks, validation, loop."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parasynth.functions import ranks, rng, special
from parasynth.functions.ks import ks_statistic
from parasynth.operators import clean, discover, evaluate, synthesize, validate
from parasynth.params import Parameters, Variable
from parasynth.plans import optimize

LEVELS = Variable("level", "categorical", categories=[("low", 0.5), ("mid", 0.3), ("high", 0.2)])
MIXED = Parameters(
    [Variable("a", "normal", 15.0, 1.0), Variable("b", "uniform", 5.0, 2.0, 0.0, 10.0), Variable("c", "gamma", 4.0, 2.0), LEVELS],
    [("a", "b", 0.8), ("a", "level", 0.5)],
)


def test_same_rows_whatever_the_partitions(spark):
    tables = [
        sorted(tuple(r) for r in synthesize.synthesize(spark, MIXED, 500, partitions=p).collect()) for p in (1, 4, 16)
    ]
    assert tables[0] == tables[1] == tables[2]


def test_law_of_wide_and_batch(spark):
    wide = synthesize.synthesize(spark, MIXED, 20000, noise=0.0)
    x = synthesize.synthesize_many(*MIXED.tables(spark), 20000, 0.0)
    batch = x.select(*[F.get("x", F.lit(i)).alias(n) for i, n in enumerate(["a", "b", "c", "code"])])
    for df in (wide, batch):
        r = df.agg(F.avg("a"), F.stddev("a"), F.avg("b"), F.avg("c"), F.stddev("c"), F.corr("a", "b")).first()
        assert r[0] == pytest.approx(15, abs=0.05) and r[1] == pytest.approx(1, abs=0.03) and r[2] == pytest.approx(5, abs=0.1)
        assert r[3] == pytest.approx(4, abs=0.06) and r[4] == pytest.approx(2, abs=0.06) and r[5] == pytest.approx(0.78, abs=0.03)
    shares = {r.level: r["count"] / 20000 for r in wide.groupBy("level").count().collect()}
    assert all(abs(shares[l] - p) < 0.02 for l, p in LEVELS.categories)
    means = {r.level: r[1] for r in wide.groupBy("level").agg(F.avg("a")).collect()}
    assert means["low"] < means["mid"] < means["high"]


def test_not_positive_definite_warns(spark):
    p = Parameters([Variable(n) for n in "abc"], [("a", "b", 0.9), ("a", "c", 0.9), ("b", "c", -0.9)])
    with pytest.warns(RuntimeWarning):
        df = synthesize.synthesize(spark, p, 100)
    assert (df.count(), len(df.columns)) == (100, 3)
    assert synthesize.synthesize_many(*p.tables(spark), 100).count() == 100


def test_edges_of_synthesis(spark):
    assert synthesize.synthesize(spark, Parameters([])).columns == []
    assert synthesize.synthesize(spark, Parameters([Variable("g", "gamma", -3.0, 2.0)]), 100).filter(F.isnan("g")).count() == 0
    with pytest.raises(ValueError):
        synthesize.synthesize(spark, Parameters([Variable("n", std=-1.0)]))
    many = Variable("m", "categorical", categories=[(f"l{i}", 1.0) for i in range(300)])
    assert synthesize.synthesize(spark, Parameters([many]), 20000).distinct().count() == 300


def test_high_row_numbers_differ(spark):
    df = spark.range(4).withColumn("row", F.col("id") * F.lit(1 << 33) + 7)
    u = [r.u for r in rng.with_uniforms(df, "row", {"u": rng.keys(1)}).collect()]
    assert len(set(u)) == 4


def brute_ks(x):
    x, n = np.sort(x), len(x)
    i = np.arange(1, n + 1)
    return max((i / n - x).max(), (x - (i - 1) / n).max())


@pytest.mark.parametrize("buckets,levels", [(4096, 2), (4, 2), (16, 3)])
def test_ks_distance_is_exact_on_hard_data(spark, buckets, levels, monkeypatch):
    monkeypatch.setattr("parasynth.functions.ks.FEW_ROWS", 10)
    g = np.random.default_rng(1)
    x = np.concatenate([g.uniform(0, 1, 800), np.full(700, 0.25), 0.5 + g.uniform(0, 1e-9, 900), np.ones(5)])
    df = spark.createDataFrame([("a", float(v)) for v in x] + [("b", float(v)) for v in x[:800]] + [("c", 0.3)], "g string, u double")
    got = {r.g: r.d for r in ks_statistic(df, ["g"], buckets, levels).collect()}
    assert got == pytest.approx({"a": brute_ks(x), "b": brute_ks(x[:800]), "c": 0.7}, abs=1e-12)


def test_special_functions():
    assert special.chi2_sf(5.991464547, 2) == pytest.approx(0.05, abs=1e-9)
    assert special.student_t_two_sided(2.228138852, 10) == pytest.approx(0.05, abs=1e-8)
    assert special.kolmogorov_sf(0.1, 140) == pytest.approx(1 - special._pelz_good(0.1, 140), abs=1e-6)
    assert special.kolmogorov_sf(0.0136, 10000) == pytest.approx(0.049, abs=1e-3)
    u = np.linspace(0.001, 0.999, 50)
    for shape in (0.3, 1.0, 4.0, 200.0):
        assert special.gamma_p(np.full(50, shape), special.gamma_ppf(np.full(50, shape), u)) == pytest.approx(u, abs=1e-10)
    assert special.wilcoxon_p(10, 10, 0, True) == pytest.approx(0.083984375)


def test_ranks_with_a_hot_value(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise((F.col("id") * 7919 % 1000).cast("double")).alias("v"))
    rows = df.collect()
    want = {r.id: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (r.v, r.id)))}
    assert {r.id: r["rank"] for r in ranks.ordinal_rank(df, "v", "id").collect()} == want
    placed = synthesize.rank_match(df.select("id", "v"), "v", "id", df.select(F.col("v").alias("w")), "w")
    assert all(r.v == r.w for r in placed.collect()) and placed.count() == 3000


def test_validation(spark):
    good = validate.validate_table(synthesize.synthesize(spark, MIXED, 5000, noise=0.0, keep_row_id=True), MIXED, row="row_id").first()
    assert good.approved and good.ks_score == 100.0 and set(good.ks_pvalues) == {"a", "b", "c", "level"}
    noisy = validate.validate_table(synthesize.synthesize(spark, MIXED, 5000, noise=0.8, keep_row_id=True), MIXED, row="row_id").first()
    assert noisy.ks_pvalues["a"] < 0.05 and noisy.ks_pvalues["b"] < 0.05 and noisy.ks_pvalues["c"] > 0.05
    assert noisy.overall_score < good.overall_score


def test_chi_square_unknown_labels_and_missing_columns(spark):
    p = Parameters([Variable("s", "categorical", categories=[("m", 0.5), ("f", 0.5)]), Variable("gone")])
    df = spark.createDataFrame([("m",)] * 50 + [("f",)] * 50 + [("other",)], "s string")
    fit = validate.distribution_fit(validate.wide_vectors(df, p, need_all=False), p.tables(spark)[0], ["s"]).collect()
    assert [(r.name, r.pvalue) for r in fit] == [("s", 0.0)]
    assert validate.bias_score(validate.wide_vectors(df, p, need_all=False), p.tables(spark)[0], ["s"]).first().bias == 1.0
    with pytest.raises(ValueError):
        validate.validate_table(df, p)


def test_constant_column_and_privacy(spark):
    p = Parameters([Variable("a"), Variable("b")])
    flat = spark.range(200).select("id", F.lit(1.0).alias("a"), F.lit(2.0).alias("b"))
    wide = spark.range(200).select("id", (F.col("id") * 7919 % 211).cast("double").alias("a"), (F.col("id") * 104729 % 197).cast("double").alias("b"))
    v, c = p.tables(spark)
    assert validate.correlation_similarity(validate.wide_vectors(flat, p), v, c).first().corr_similarity == 1.0
    near = [validate.privacy_score(validate.wide_vectors(d, p, "id"), v).first() for d in (flat, wide)]
    assert near[0].privacy_score == 0.0 < near[1].privacy_score
    few = wide.collect()
    x = np.array([[r.a, r.b] for r in few])
    x = (x - x.mean(0)) / x.std(0, ddof=1)
    gaps = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(gaps, np.inf)
    assert near[1].avg_min_dist == pytest.approx(gaps.min(1).mean(), abs=1e-4)


def test_noise_schedule(spark):
    scores = [95.0, 80.0, 79.0, 78.0, 77.0, 76.0, 99.0, 1.0]
    df = spark.createDataFrame([("r", i * 10, s) for i, s in enumerate(scores)], "run_id string, position bigint, score double")
    rows = optimize.noise_schedule(df).orderBy("position").collect()
    assert [r.noise for r in rows] == pytest.approx([0.1, 0.1, 0.11, 0.055, 0.0605, 0.1, 0.11, 0.11])
    assert [r.best_score for r in rows][-1] == 99.0


def test_loop_keeps_the_best(spark):
    v, c = Parameters([Variable("a", "normal", 10.0, 2.0)]).tables(spark)
    state, log = optimize.run_loop(v, c, 2, 500)
    best, scores = state.first(), [r.score for r in log.orderBy("iteration").collect()]
    assert best.best_score == max(scores) and len(scores) == 2
    assert optimize.best_data(v, c, state, 500).count() == 500
    with pytest.raises(ValueError):
        optimize.run_loop(v.filter("false"), c, 1)


def test_split_is_exact_and_stable(spark):
    df = spark.range(1003).select("id", F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("t"))
    a = evaluate.stratified_split(df, "t", "id", 0.2, 1)
    assert {r.t: r[1] for r in a.groupBy("t").agg(F.sum(F.col("is_test").cast("int"))).collect()} in ({"x": 67, "y": 134}, {"x": 68, "y": 133})
    assert a.orderBy("id").collect() == evaluate.stratified_split(df.repartition(7), "t", "id", 0.2, 1).orderBy("id").collect()


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.4), (1, 0.8)], "label int, score double")
    assert evaluate.roc_auc(df, "label", "score").first()[0] == pytest.approx(0.875)


def test_discovery_helpers(spark):
    got = spark.createDataFrame([("1, 3", 4), ("None", 4), ("I suggest that source 0 is the best one.", 4), ("9", 4)], "r string, n int")
    assert [r[0] for r in got.select(discover.suggested_indices(F.col("r"), F.col("n"))).collect()] == [[1, 3], [], [0], []]
    runs = spark.createDataFrame([(f"run_{i:03d}",) for i in range(5)], "run_id string")
    assert {r.run_id for r in clean.latest_runs(runs).collect()} == {"run_002", "run_003", "run_004"}
    pages = spark.createDataFrame([("<script>x</script>", "snip"), ("<p>a &amp; b</p>", "snip")], "html string, s string")
    assert [r.text for r in clean.html_to_text(pages, "html", "s").collect()] == ["snip", "a & b"]
