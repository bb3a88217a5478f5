"""Work on many sources together: blocks of draws, the loop, the grid, logistic models, the benchmark."""

import math
import random
from functools import reduce

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from parasynth.functions import special
from parasynth.operators import draws, evaluate, synthesize, validate
from parasynth.params import Parameters, Variable
from parasynth.plans import benchmark, optimize

MIXED = Parameters(
    [Variable("a", "normal", 15.0, 1.0), Variable("b", "uniform", 5.0, 2.0, 0.0, 10.0), Variable("c", "gamma", 4.0, 2.0), Variable("level", "categorical", categories=[("low", 0.5), ("mid", 0.3), ("high", 0.2)])],
    [("a", "b", 0.8), ("a", "level", 0.5)],
)


def many(spark, *names):
    parts = [Parameters(MIXED.variables, MIXED.correlations, n).tables(spark) for n in names]
    v, c = parts[0]
    for a, b in parts[1:]:
        v, c = v.unionByName(a), c.unionByName(b)
    return v, c


def test_blocks_of_draws_follow_the_counters(spark):
    """NumPy uniforms equal those of the expressions, also for rows beyond 32 bits."""
    from parasynth.functions import rng

    rows = [0, 1, 99_999, (1 << 33) + 7]
    own = draws.uniforms(np.array([rng.keys(1, 2)], np.uint64), np.array(rows, np.uint64))[0]
    df = spark.createDataFrame([(r,) for r in rows], "row long")
    want = {r.row: r.u for r in rng.with_uniforms(df, "row", {"u": rng.keys(1, 2)}).collect()}
    assert own.tolist() == [want[r] for r in rows]


@pytest.mark.parametrize("noise", [0.0, 0.8])
def test_scores_of_the_kernel_are_those_of_validation(spark, noise):
    v, c = many(spark, "s1", "s2")
    x = synthesize.synthesize_many(v, c, 4_000, noise, seed=3, iteration=5)
    want = {r.source_id: r.overall_score for r in validate.validate(x, v, c, privacy=False).collect()}
    pairs = synthesize.declared_pairs(v, c).groupBy("source_id").agg(F.collect_list(F.struct("i", "j", "r")).alias("pairs"))
    for row in synthesize.source_rows(v, c, 3).join(pairs, "source_id").collect():
        row = row.asDict(recursive=True)
        source = draws.Source(row)
        made = np.concatenate([source.draw(at, at + 1_000, noise, 5) for at in range(0, 4_000, 1_000)], axis=1)
        score = source.score(made, {(p["i"], p["j"]): p["r"] for p in row["pairs"]}, 0.05)
        assert score == pytest.approx(want[row["source_id"]], abs=0.006)
        listed = sorted(x.where(F.col("source_id") == row["source_id"]).collect(), key=lambda r: r.row_id)
        assert np.array([r.x for r in listed]).T == pytest.approx(made)


def test_loop_in_tasks_and_by_steps_agree(spark, monkeypatch):
    v, c = many(spark, "s1", "s2")
    state, log = optimize.run_loop(v, c, 3, 1_500)
    steps = sorted(map(tuple, log.collect()))
    more, second = optimize.run_loop(v, c, 2, 1_500, start=state)
    monkeypatch.setattr(draws, "WHOLE", 0)
    plain, plain_log = optimize.run_loop(v, c, 3, 1_500)
    assert [s[:2] for s in steps] == [s[:2] for s in sorted(map(tuple, plain_log.collect()))]
    for a, b in zip(steps, sorted(map(tuple, plain_log.collect()))):
        assert a[2] == b[2] and a[3] == pytest.approx(b[3], abs=0.011) and a[4] == b[4]
    assert {r.iteration for r in second.collect()} == {3, 4} and {r.next_iteration for r in more.collect()} == {5}
    assert sorted((r.source_id, r.best_iteration, r.streak) for r in state.collect()) == sorted((r.source_id, r.best_iteration, r.streak) for r in plain.collect())


def test_cells_of_the_grid_stop_after_their_own_steps(spark, monkeypatch):
    v, c = many(spark, "s1", "s2")
    seen = []
    real = optimize._loop
    monkeypatch.setattr(optimize, "_loop", lambda *a: seen.append(real(*a)) or seen[-1])
    grid = optimize.noise_grid(v, c, (0, 1, 3), 2, 400).collect()
    assert len(grid) == 2 * 3 * 2
    assert seen[0][1].count() == 2 * 2 * (1 + 1 + 3)
    monkeypatch.setattr(draws, "WHOLE", 0)
    slow = {(r.text_id, r.seed, r.iterations): r.score for r in optimize.noise_grid(v, c, (0, 1, 3), 1, 400).collect()}
    assert all(slow[r.text_id, r.seed, r.iterations] == pytest.approx(r.score, abs=0.011) for r in grid if r.seed == 0)


def test_gamma_elements_are_alone(spark):
    """A value's result doesn't depend on what else is in its batch."""
    rnd = random.Random(2)
    a = np.array([rnd.choice([0.3, 1.0, 2.0, 40.0, 900.0]) for _ in range(400)])
    u = np.array([rnd.random() for _ in range(400)])
    whole = special.gamma_ppf(a, u)
    assert whole.tolist() == [float(special.gamma_ppf(a[i : i + 1], u[i : i + 1])[0]) for i in range(400)]
    one = a == 1.0
    assert whole[one] == pytest.approx(-np.log1p(-u[one]), rel=1e-10)
    two = a == 2.0
    assert 1 - np.exp(-whole[two]) * (1 + whole[two]) == pytest.approx(u[two], abs=1e-12)


def test_logistic_models_together(spark):
    rnd = np.random.default_rng(4)
    rows = []
    for cell, scale in (("x", 1.0), ("y", 3_000.0), ("z", 1.0)):
        for _ in range(400):
            f = rnd.normal(size=2) * scale
            p = 1 / (1 + math.exp(-(0.7 + 1.5 * f[0] / scale - f[1] / scale)))
            rows.append((cell, 1, [float(f[0]), float(f[1])], float(rnd.random() < p) if cell != "z" else 1.0))
    df = spark.createDataFrame(rows, "cell string, part int, features array<double>, label double").repartition(5)
    models = evaluate.fit_logistic(df, ["cell", "part"])
    assert models.weights["z", 1].tolist() == [0.0, 0.0, math.inf]
    for cell in ("x", "y"):
        own = df.where(F.col("cell") == cell).select(array_to_vector("features").alias("features"), "label")
        want = LogisticRegression(maxIter=1000, tol=1e-14, regParam=1.0 / 400, standardization=False).fit(own)
        assert models.weights[cell, 1] == pytest.approx([*want.coefficients, want.intercept], rel=1e-5, abs=1e-9)
        score = {tuple(r.features): r.score for r in models.score(df.where(F.col("cell") == cell)).collect()}
        plain = {tuple(r.features): r.probability[1] for r in want.transform(own).collect()}
        assert all(score[k] == pytest.approx(plain[k], abs=1e-5) for k in plain)
    assert {r.prediction for r in models.score(df.where("cell = 'z'")).collect()} == {1.0}


def spec_of(spark, n=400, **changes):
    rnd = random.Random(6)
    rows = []
    for i in range(n):
        good = rnd.random() < 0.4
        rows.append((i, rnd.gauss(12 if good else 9, 2), rnd.gauss(5, 1), rnd.choice("pq"), ">yes" if good else "no"))
    df = spark.createDataFrame(rows, "id long, u double, w double, kind string, verdict string")
    return benchmark.DatasetSpec(**({"name": "set", "domain": "d", "df": df, "row": "id", "continuous": ["u", "w"], "target": "verdict", "categorical": ["kind"]} | changes))


def test_benchmark_of_all_seeds_together(spark):
    cells = benchmark.tstr(spec_of(spark), n_seeds=2, iterations=2).collect()
    assert {(r.seed, r.source) for r in cells} == {(s, x) for s in (0, 1) for x in benchmark.SOURCES}
    assert all(0.5 < r.accuracy <= 1 and 0 <= r.f1 <= 1 and r.roc_auc > 0.6 for r in cells if r.source in ("real", "parameters"))
    assert all((r.fidelity_score is not None) == (r.source == "parameters") for r in cells)
    assert all(abs(r.true_pos_rate - 0.4) < 0.1 and abs(r.train_pos_prev - 0.4) < 0.12 for r in cells)
    summary = benchmark.empirical_summary(spark.createDataFrame(cells)).collect()
    assert {r.source for r in summary} == {"parameters", "independent", "fitted_copula"} and all(r.n_seeds == 2 for r in summary)


def test_benchmark_isolates_data_sets(spark):
    good = spec_of(spark, 200)
    cells, skipped = benchmark.run_benchmark([
        spec_of(spark, 20, name="no target", target="gone"), spec_of(spark, 20, name="no column", continuous=["u", "lost"]),
        spec_of(spark, 0, name="empty"), good,
    ], n_seeds=1, iterations=1)
    assert {r.dataset for r in cells.collect()} == {"set"}
    why = {r.dataset: r.reason for r in skipped.collect()}
    assert why.keys() == {"no target", "no column", "empty"} and "gone" in why["no target"] and "lost" in why["no column"]


def test_one_scan_gives_what_separate_scans_give(spark, monkeypatch):
    """With nulls, unknown labels, several sources per task and few sources kept."""
    from parasynth.operators import onepass

    monkeypatch.setattr(onepass, "KEPT", 1)
    rnd = random.Random(8)
    p = Parameters(MIXED.variables[:2] + [Variable("k", "normal", 3.0, 0.0), MIXED.variables[3], Variable("g", "gamma", 4.0, 2.0)], [("a", "b", 0.4)])
    rows = [(f"s{i % 3}", i, [None if rnd.random() < 0.1 else rnd.gauss(15, 1), rnd.uniform(-1, 11), 3.0, rnd.choice([0.0, 1.0, 2.0, None]), rnd.gammavariate(4, 1)]) for i in range(3_000)]
    x = spark.createDataFrame(rows, "source_id string, row_id long, x array<double>").repartition(5)
    v, c = p.tables(spark)
    v = reduce(type(v).unionByName, [v.withColumn("source_id", F.lit(f"s{i}")) for i in range(3)])
    c = reduce(type(c).unionByName, [c.withColumn("source_id", F.lit(f"s{i}")) for i in range(3)])
    fast = validate.validate(x, v, c, privacy=False, buckets=64).orderBy("source_id").collect()
    monkeypatch.setattr(onepass, "VARIABLES", -1)
    slow = validate.validate(x, v, c, privacy=False, buckets=64).orderBy("source_id").collect()
    for a, b in zip(fast, slow):
        assert (a.source_id, a.overall_score, a.ks_score, a.corr_score, a.bias_score, a.n_rows, a.approved) == (b.source_id, b.overall_score, b.ks_score, b.corr_score, b.bias_score, b.n_rows, b.approved)
        assert a.ks_pvalues.keys() == b.ks_pvalues.keys() and all(a.ks_pvalues[k] == pytest.approx(b.ks_pvalues[k], abs=1e-9) for k in a.ks_pvalues)
        assert all(a.ks_stats[k] == (b.ks_stats[k] if b.ks_stats[k] is None else pytest.approx(b.ks_stats[k], abs=1e-10)) for k in a.ks_stats)


def test_noise_is_a_composition(spark, monkeypatch):
    """Blocks of blocks of steps, against the plain fold; a run of 20,000 rising steps."""
    from parasynth import fixed_values as fv

    monkeypatch.setattr(optimize, "STEP_BLOCK", 8)
    rnd = random.Random(3)
    runs = {r: [rnd.choice([rnd.random() * 40 + i / 9, rnd.random() * 10]) for i in range(n)] for r, n in (("a", 700), ("b", 5), ("c", 1))}
    rows = [(r, 3 * i, s) for r, own in runs.items() for i, s in enumerate(own)]
    got = {(r.run_id, r.position): r.noise for r in optimize.noise_schedule(spark.createDataFrame(rows, "run_id string, position long, score double").repartition(4)).collect()}
    for run, own in runs.items():
        noise, best, streak = fv.INITIAL_NOISE, fv.START_SCORE, 0
        for i, s in enumerate(own):
            assert got[run, 3 * i] == pytest.approx(noise, rel=1e-12)
            if s > best:
                best, streak = s, 0
                continue
            streak += 1
            if streak % (2 * fv.PATIENCE) == 0:
                noise = fv.INITIAL_NOISE
            elif streak % fv.PATIENCE == 0:
                noise = max(noise * fv.NOISE_DOWN, fv.MIN_NOISE)
            else:
                noise = min(noise * fv.NOISE_UP, fv.MAX_NOISE)
    monkeypatch.undo()
    rising = optimize.noise_schedule(spark.range(20_000).selectExpr("'r' AS run_id", "id AS position", "CAST(id AS double) AS score"))
    assert {(r.noise, r.streak) for r in rising.select("noise", "streak").distinct().collect()} == {(fv.INITIAL_NOISE, 0)} and rising.count() == 20_000


def test_kept_artifacts_outlive_a_killed_write(spark, tmp_path, monkeypatch):
    from parasynth.sources import artifacts

    v, c = many(spark, "s1", "s2")
    meta = v.select("source_id").distinct().select("source_id", F.concat(F.lit("about "), "source_id").alias("source"), F.to_timestamp(F.lit("2026-01-01 00:00:00")).alias("extracted_at"), F.lit("x").alias("extraction_method"))
    folder = str(tmp_path / "kept")
    state, _ = optimize.run_loop(v, c, 2, 200)
    first = {r.source_id: (r.version, r.score) for r in artifacts.write_improved(folder, state, v, c, meta, 200).collect()}
    assert {x for x, _ in first.values()} == {1} and first == {r.source_id: (1, r.best_score) for r in state.collect()}
    rows = artifacts.read_kept(spark, folder).collect()
    assert len(rows) == 2 * 200 * 4
    assert {r.source_id for r in artifacts.read_kept(spark, folder, "cards").collect()} == {r.source_id for r in artifacts.read_kept(spark, folder, "parameters").collect()} == {"s1", "s2"}
    assert {x[0] for x in first.values()} == {r.version for r in artifacts.write_improved(folder, state, v, c, meta, 200).collect()}  # nothing better, no new version
    up = state.withColumn("best_score", F.when(F.col("source_id") == "s1", F.lit(101.0)).otherwise(F.col("best_score")))
    real = artifacts.parameters_json
    monkeypatch.setattr(artifacts, "parameters_json", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        artifacts.write_improved(folder, up, v, c, meta, 200)
    assert sorted(artifacts.read_kept(spark, folder).collect()) == sorted(rows)
    monkeypatch.setattr(artifacts, "parameters_json", real)
    after = {r.source_id: r.version for r in artifacts.write_improved(folder, up, v, c, meta, 200).collect()}
    assert after == {"s1": 2, "s2": 1} and artifacts.read_kept(spark, folder).count() == 2 * 200 * 4
