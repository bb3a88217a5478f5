"""Synthesis-validation loop with a noise schedule, for many sources at once."""

import math
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.scans import running_before
from ..operators import draws, synthesize, validate
from ..session import cut_lineage


def next_noise(streak, noise):
    """Noise after a miss that made the streak ``streak`` long."""
    return (
        F.when(streak % (2 * fv.PATIENCE) == 0, F.lit(fv.INITIAL_NOISE))
        .when(streak % fv.PATIENCE == 0, F.greatest(noise * fv.NOISE_DOWN, F.lit(fv.MIN_NOISE)))
        .otherwise(F.least(noise * fv.NOISE_UP, F.lit(fv.MAX_NOISE)))
    )


def noise_schedule(scores: DataFrame, run: str = "run_id", position: str = "position", score: str = "score") -> DataFrame:
    """Replay the ratchet over score logs: one row per step with its noise.

    ``position`` orders a run by distinct integers.  Best score and streak come
    from scans over ranges of positions. What a step does to the noise is a
    function x -> clamp(m x, low, high); such functions are closed under
    composition, so the noise before a step is a prefix of compositions, taken
    within blocks of steps and over the blocks: linear work, and a run holding
    most of the log is spread over tasks.
    """
    g = [run]
    log = scores.select(run, F.col(position).alias("position"), F.col(score).cast("double").alias("score"))
    log = running_before(log, g, "position", {"earlier": (F.max, F.col("score")), "before": (F.sum, F.lit(1))})
    best = F.greatest(F.coalesce("earlier", F.lit(fv.START_SCORE)), F.lit(fv.START_SCORE))
    log = log.select(
        run, "position", "score", F.coalesce("before", F.lit(0)).cast("long").alias("iteration"),
        (F.col("score") > best).alias("improved"), best.alias("best_before"),
    )
    log = running_before(cut_lineage(log), g, "position", {"last_hit": (F.max, F.when(F.col("improved"), F.col("iteration")))})
    streak = F.when(F.col("improved"), F.lit(0)).otherwise(F.col("iteration") - F.coalesce("last_hit", F.lit(-1)))
    log = cut_lineage(log.withColumn("streak", streak.cast("long")).drop("last_hit"))
    down, reset = F.col("streak") % fv.PATIENCE == 0, F.col("streak") % (2 * fv.PATIENCE) == 0
    pick = lambda same, restart, less, more: (
        F.when(F.col("improved"), F.lit(same)).when(reset, F.lit(restart)).when(down, F.lit(less)).otherwise(F.lit(more)).cast("double")
    )
    steps = log.select(
        run, F.col("iteration").alias("at"), pick(1.0, 0.0, fv.NOISE_DOWN, fv.NOISE_UP).alias("m"),
        pick(-math.inf, fv.INITIAL_NOISE, fv.MIN_NOISE, -math.inf).alias("low"), pick(math.inf, fv.INITIAL_NOISE, math.inf, fv.MAX_NOISE).alias("high"),
    )
    noise = composed_before(steps, run).select(
        run, F.col("at").alias("iteration"), F.greatest(F.col("low"), F.least(F.col("high"), F.col("m") * fv.INITIAL_NOISE)).alias("noise")
    )
    return log.join(noise, [run, "iteration"]).select(
        run, "position", "iteration", "score", "noise", "improved", "streak", F.greatest("best_before", "score").alias("best_score"),
    )


#: Steps whose functions one task composes.
STEP_BLOCK = 4_096


def composed_before(steps: DataFrame, run: str) -> DataFrame:
    """(run, at, m, low, high): the functions of all steps before ``at``, one after the other, as one.

    ``at`` counts the steps of a run from 0.
    """
    kind = steps.schema[run].dataType.simpleString()
    own = f"`{run}` {kind}, at long, m double, low double, high double"
    steps = steps.withColumn("block", F.floor(F.col("at") / STEP_BLOCK))
    start = [F.lit(1.0).alias("start_m"), F.lit(-math.inf).alias("start_low"), F.lit(math.inf).alias("start_high")]
    if (steps.agg(F.max("block")).first()[0] or 0) == 0:
        placed = steps.select("*", *start)
    else:
        whole = cut_lineage(steps.groupBy(run, "block").applyInPandas(lambda pdf: _composed(pdf, run, True), own))
        before = composed_before(whole, run).select(run, F.col("at").alias("block"), F.col("m").alias("start_m"), F.col("low").alias("start_low"), F.col("high").alias("start_high"))
        placed = steps.join(before, [run, "block"])
    return cut_lineage(placed.groupBy(run, "block").applyInPandas(lambda pdf: _composed(pdf, run, False), own))


def _composed(pdf: pd.DataFrame, run: str, total: bool) -> pd.DataFrame:
    """The functions before each step of a block, given the one before the block; with ``total``, that of the whole block."""
    pdf = pdf.sort_values("at")
    m, low, high = (1.0, -math.inf, math.inf) if total else (float(pdf[c].iloc[0]) for c in ("start_m", "start_low", "start_high"))
    out = []
    for step_m, step_low, step_high in zip(pdf["m"].tolist(), pdf["low"].tolist(), pdf["high"].tolist()):
        out.append((m, low, high))
        clamp = lambda x: max(step_low, min(step_high, x))  # noqa: B023, E731
        m, low, high = step_m * m, clamp(step_m * low if step_m else 0.0), clamp(step_m * high if step_m else 0.0)
    if total:
        return pd.DataFrame({run: [pdf[run].iloc[0]], "at": [int(pdf["block"].iloc[0])], "m": [m], "low": [low], "high": [high]})
    return pd.DataFrame({run: pdf[run].to_numpy(), "at": pdf["at"].to_numpy(), **{c: [o[i] for o in out] for i, c in enumerate(("m", "low", "high"))}})


def ratchet_best(scores: DataFrame, run: str = "run_id", position: str = "position", score: str = "score") -> DataFrame:
    """(run, best_score, best_position): first step reaching the highest score."""
    ahead = F.struct(F.col(score).cast("double").alias("s"), (-F.col(position)).alias("p"))
    top = scores.groupBy(run).agg(F.max(ahead).alias("m"))
    return top.filter(F.col("m.s") > fv.START_SCORE).select(run, F.col("m.s").alias("best_score"), (-F.col("m.p")).alias("best_position"))


def run_loop(
    variables: DataFrame,
    correlations: DataFrame,
    iterations: int = 5,
    n_rows: int = fv.DEFAULT_ROWS,
    seed: int = fv.DEFAULT_SEED,
    thresholds: dict | None = None,
    start: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Run the loop for every source together: (state, log).

    The state is a row per source (best score, its draw and noise, current
    noise, streak); data is not kept, because a draw is reproduced from seed,
    iteration and noise by :func:`best_data`.  ``start`` continues from an
    earlier state, at the iteration after its last one, so no draw is scored
    twice.
    """
    if variables.isEmpty():
        raise ValueError("no variables were extracted: nothing to synthesise")
    state = start or first_state(variables)
    return _loop(variables, correlations, state.withColumn("steps", F.lit(iterations)), n_rows, seed, thresholds)


def first_state(variables: DataFrame) -> DataFrame:
    return variables.select("source_id").distinct().select(
        "source_id", F.lit(fv.START_SCORE).alias("best_score"), F.lit(None).cast("int").alias("best_iteration"),
        F.lit(None).cast("double").alias("best_noise"), F.lit(fv.INITIAL_NOISE).alias("noise"), F.lit(0).cast("long").alias("streak"),
        F.lit(0).alias("next_iteration"),
    )


STATE = ["source_id", "best_score", "best_iteration", "best_noise", "noise", "streak", "next_iteration"]
LOG = ["source_id", "iteration", "noise_level", "score", "improved", "approved"]


def _loop(variables: DataFrame, correlations: DataFrame, state: DataFrame, n_rows: int, seed: int, thresholds: dict | None) -> tuple[DataFrame, DataFrame]:
    """Each source takes ``steps`` steps of its own.

    A step depends on the source's own scores only, so where a task can hold a
    table, one job runs all steps of all sources side by side. Longer tables
    take a job per step over the sources that have steps left.
    """
    if n_rows > draws.WHOLE:
        return _loop_by_steps(variables, correlations, state, n_rows, seed, thresholds)
    limits = validate.thresholds(thresholds)
    pairs = synthesize.declared_pairs(variables, correlations).groupBy("source_id").agg(F.collect_list(F.struct("i", "j", "r")).alias("pairs"))
    state = cut_lineage(state)
    rows = state.join(synthesize.source_rows(variables, correlations, seed), "source_id", "left").join(pairs, "source_id", "left")
    # Rows of many steps and of few are mixed by the source's name.
    steps = cut_lineage(synthesize.spread_out(rows, "source_id").mapInArrow(draws.looped(n_rows, limits["ks_pvalue"], limits["fidelity_score"]), draws.STEPS))
    last = steps.groupBy("source_id").agg(F.max_by(F.struct(*STATE[1:-1], F.col("iteration")), "iteration").alias("s"))
    after = last.select("source_id", *[F.col(f"s.{c}").alias(c) for c in STATE[1:-1]], (F.col("s.iteration") + 1).alias("next_iteration"))
    idle = state.join(after, "source_id", "left_anti").select(*STATE)
    return after.unionByName(idle), steps.select(*LOG)


def _loop_by_steps(variables: DataFrame, correlations: DataFrame, state: DataFrame, n_rows: int, seed: int, thresholds: dict | None) -> tuple[DataFrame, DataFrame]:
    variables, correlations = cut_lineage(variables), cut_lineage(correlations)
    active, done, logs = cut_lineage(state), [], []
    log = variables.sparkSession.createDataFrame([], "source_id string, iteration int, noise_level double, score double, improved boolean, approved boolean")
    while True:
        done.append(active.filter("steps <= 0").select(*STATE))
        active = active.filter("steps > 0")
        if active.isEmpty():
            break
        vectors = synthesize.synthesize_many(
            variables, correlations, n_rows, active.select("source_id", "noise", F.col("next_iteration").alias("iteration")), seed
        ).persist()
        report = validate.validate(vectors, variables, correlations, thresholds, privacy=False, buckets=256)
        step = active.join(report.select("source_id", "overall_score", "approved"), "source_id", "left")
        score = F.coalesce("overall_score", F.lit(fv.START_SCORE))
        better = score > F.col("best_score")
        streak = F.when(better, F.lit(0)).otherwise(F.col("streak") + 1).cast("long")
        step = cut_lineage(
            step.withColumns({"score": score, "improved": better}).withColumn("new_streak", streak)
        )
        vectors.unpersist()
        logs.append(step.select("source_id", F.col("next_iteration").alias("iteration"), F.col("noise").alias("noise_level"), "score", "improved", "approved"))
        active = step.select(
            "source_id", F.when(F.col("improved"), F.col("score")).otherwise(F.col("best_score")).alias("best_score"),
            F.when(F.col("improved"), F.col("next_iteration")).otherwise(F.col("best_iteration")).alias("best_iteration"),
            F.when(F.col("improved"), F.col("noise")).otherwise(F.col("best_noise")).alias("best_noise"),
            F.when(F.col("improved"), F.col("noise")).otherwise(next_noise(F.col("new_streak"), F.col("noise"))).alias("noise"),
            F.col("new_streak").alias("streak"), (F.col("next_iteration") + 1).alias("next_iteration"), (F.col("steps") - 1).alias("steps"),
        )
    return reduce(DataFrame.unionByName, done), reduce(DataFrame.unionByName, logs, log)


def best_data(variables: DataFrame, correlations: DataFrame, state: DataFrame, n_rows: int = fv.DEFAULT_ROWS, seed: int = fv.DEFAULT_SEED) -> DataFrame:
    """The kept data set of every source, drawn again."""
    kept = state.filter(F.col("best_iteration").isNotNull()).select(
        "source_id", F.col("best_noise").alias("noise"), F.col("best_iteration").alias("iteration")
    )
    return synthesize.synthesize_many(variables, correlations, n_rows, kept, seed)


def noise_grid(
    variables: DataFrame, correlations: DataFrame, iterations_grid=(0, 1, 2, 3, 5, 10), n_seeds: int = 5, n_rows: int = fv.DEFAULT_ROWS
) -> DataFrame:
    """(text_id, seed, iterations, score) over sources x seeds x loop lengths.

    Every cell draws for itself: seed and length make its sources, and each
    leaves the loop after its own last step. Zero iterations score the first
    draw.
    """
    cells = F.explode(F.array(*[
        F.struct(F.lit(s).alias("seed"), F.lit(i).alias("iterations")) for s in range(n_seeds) for i in iterations_grid
    ])).alias("cell")

    def spread(df: DataFrame) -> DataFrame:
        named = F.concat_ws("/", "source_id", F.col("cell.seed"), F.col("cell.iterations"))
        return df.select("*", cells).withColumn("source_id", named).drop("cell")

    names = variables.select("source_id").distinct().select(F.col("source_id").alias("text_id"), cells).select(
        "text_id", F.col("cell.seed").alias("seed"), F.col("cell.iterations").alias("iterations"),
        F.concat_ws("/", "text_id", F.col("cell.seed"), F.col("cell.iterations")).alias("source_id"),
    )
    variables, correlations = spread(variables), spread(correlations)
    state = first_state(variables).join(names.select("source_id", F.greatest("iterations", F.lit(1)).alias("steps")), "source_id")
    _, log = _loop(variables, correlations, state, n_rows, 0, None)
    return log.join(names, "source_id").groupBy("text_id", "seed", "iterations").agg(F.max("score").alias("score"))
