"""Real-against-synthetic classification and its summaries."""

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import clean, evaluate, extract, profile, synthesize
from ..params import Parameters, load
from ..session import broadcast_if_small, cut_lineage
from . import optimize


@dataclass
class DatasetSpec:
    name: str
    domain: str
    df: DataFrame
    row: str
    continuous: Sequence[str]
    target: str
    categorical: Sequence[str] = field(default_factory=tuple)


SOURCES = ("real", "parameters", "independent", "fitted_copula")


def extracted_parameters(spec: DatasetSpec):
    """Table -> text -> parameters, with the real names of continuous columns.

    The text reader names continuous variables ``var_1``, ``var_2``, ... in
    order of appearance, which is the order of ``spec.continuous``.
    """
    p = profile.profile_table(spec.df, spec.continuous, list(spec.categorical), spec.target)
    texts = profile.source_text(*p)
    variables, correlations, meta = extract.extract_parameters(texts)
    names = F.create_map(*[F.lit(x) for i, c in enumerate(spec.continuous) for x in (f"var_{i + 1}", c)])
    variables = variables.withColumn("name", F.coalesce(F.try_element_at(names, F.col("name")), F.col("name")))
    return load(variables, correlations), meta


CELLS = (
    "dataset string, domain string, seed int, source string, accuracy double, f1 double, roc_auc double, "
    "pred_pos_rate double, true_pos_rate double, train_pos_prev double, fidelity_score double"
)


def _frames(spec: DatasetSpec, parameters: Parameters, split: DataFrame, n: int, seeds: list[int], iterations: int) -> tuple[DataFrame, DataFrame]:
    """Training rows (seed, source, columns) of every source, and the state of the loop per seed.

    Each seed has sources of its own in the batch operators, so each kind of
    source is one job for all seeds.
    """
    spark = split.sparkSession
    columns = [*spec.continuous, *spec.categorical, spec.target]
    per_seed = lambda df: df.drop("source_id").crossJoin(F.broadcast(spark.createDataFrame([(str(s),) for s in seeds], "source_id string")))  # noqa: E731  a row per seed
    v, c = (per_seed(t) for t in parameters.tables(spark))
    state, _ = optimize.run_loop(v, c, iterations, n)
    seed = F.col("source_id").cast("int").alias("seed")

    def tagged(vectors: DataFrame, source: str) -> DataFrame:
        wide = synthesize.wide_form(vectors, parameters, keep=[seed])
        return wide.select("seed", F.lit(source).alias("source"), *columns)

    real = split.filter("NOT is_test").select("seed", F.lit("real").alias("source"), *columns)
    frames = [
        real, tagged(optimize.best_data(v, c, state, n), "parameters"),  # the very rows that were scored
        tagged(synthesize.synthesize_many(v, c.limit(0), n, seed=1), "independent"),
    ]
    for s in seeds:
        fitted = synthesize.fit_copula(split.filter(f"NOT is_test AND seed = {s}"), spec.continuous, [*spec.categorical, spec.target])
        frames.append(synthesize.sample_copula(spark, fitted, n, s).select(F.lit(s).alias("seed"), F.lit("fitted_copula").alias("source"), *columns))
    return reduce(DataFrame.unionByName, frames), state.select(seed, "best_score")


def _coded(df: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """Adds ``<column>_code``: the place of the label among those of the seed's real training rows, NULL if it isn't there."""
    own = labels.filter(F.col("column") == column).select("seed", F.col("label").alias(column), F.col("code").alias(f"{column}_code"))
    return df.join(broadcast_if_small(own), ["seed", column], "left")


def tstr(spec: DatasetSpec, n_seeds: int = 5, iterations: int = 3) -> DataFrame:
    """(dataset, domain, seed, source, accuracy, f1, roc_auc, rates, fidelity).

    Trains on the real rows and on each synthetic table, tests on real rows.
    The models of all seeds and sources are fitted together, and so are their
    scores. A source with a label that the seed's real training rows lack is
    left out. Targets of more than two labels have a model of label code 1
    against the rest.
    """
    parameters, _ = extracted_parameters(spec)
    labelled = [*spec.categorical, spec.target]
    columns = [*spec.continuous, *labelled]
    base = spec.df.select(spec.row, *[F.col(c).cast("double").alias(c) for c in spec.continuous], *[F.col(c).cast("string").alias(c) for c in labelled])
    base = cut_lineage(base.na.drop())
    seeds = list(range(n_seeds))
    splits = [evaluate.stratified_split(base, spec.target, spec.row, 0.2, s).withColumn("seed", F.lit(s)) for s in seeds]
    split = cut_lineage(reduce(DataFrame.unionByName, splits))
    sizes = {r["seed"]: r["n"] for r in split.filter("NOT is_test").groupBy("seed").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = max(sizes.values(), default=0)  # the split takes the same number for every seed
    frames, state = _frames(spec, parameters, split, n, seeds, iterations)

    train = split.filter("NOT is_test")
    known = train.select("seed", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("label")) for c in labelled])).alias("e")).select("seed", "e.*").distinct()
    place = F.row_number().over(Window.partitionBy("seed", "column").orderBy("label")) - 1
    labels = cut_lineage(known.withColumn("code", place.cast("double")))
    marked = F.min(F.when(F.trim("label").startswith(">"), F.col("code")))
    positive = labels.filter(F.col("column") == spec.target).groupBy("seed").agg(F.coalesce(marked, F.max("code")).alias("positive"))

    inputs = F.array(*spec.continuous, *[f"{c}_code" for c in spec.categorical]).alias("features")
    unseen = reduce(lambda a, b: a | b, [F.col(f"{c}_code").isNull() for c in labelled])

    def prepared(df: DataFrame, *keep: str) -> DataFrame:
        for c in labelled:
            df = _coded(df, labels, c)
        return df.select(*keep, inputs, F.col(f"{spec.target}_code").alias("code"), (F.col(f"{spec.target}_code") == 1).cast("double").alias("label"), unseen.alias("unseen"))

    cells = ["seed", "source"]
    rows = cut_lineage(prepared(frames.select(*cells, *columns), *cells))
    bad = rows.groupBy(*cells).agg(F.max("unseen").alias("unseen")).filter("unseen").select(*cells)
    rows = rows.join(F.broadcast(bad), cells, "left_anti")  # at most a row per seed and source
    models = evaluate.fit_logistic(rows, cells)

    test = prepared(split.filter("is_test"), "seed")
    listed = rows.select(*cells).distinct()
    scored = cut_lineage(models.score(test.filter("NOT unseen").join(F.broadcast(listed), "seed"), "features").join(F.broadcast(positive), "seed"))
    predicted = F.when(F.col("prediction") == 1, 1.0).otherwise(0.0)
    basic = evaluate.classifier_metrics(scored, by=cells).join(evaluate.roc_auc(scored, "label", "score", cells), cells)
    rates = scored.groupBy(*cells).agg(evaluate.rate(predicted == F.col("positive")).alias("pred_pos_rate"), evaluate.rate(F.col("code") == F.col("positive")).alias("true_pos_rate"))
    prevalence = rows.join(F.broadcast(positive), "seed").groupBy(*cells).agg(evaluate.rate(F.col("code") == F.col("positive")).alias("train_pos_prev"))
    out = basic.join(rates, cells).join(prevalence, cells).join(F.broadcast(state.withColumn("source", F.lit("parameters"))), cells, "left")
    return out.select(
        F.lit(spec.name).alias("dataset"), F.lit(spec.domain).alias("domain"), *cells, "accuracy", "f1", "roc_auc",
        "pred_pos_rate", "true_pos_rate", "train_pos_prev", F.col("best_score").alias("fidelity_score"),
    )


def run_benchmark(specs: Sequence[DatasetSpec], n_seeds: int = 5, iterations: int = 3) -> tuple[DataFrame, DataFrame]:
    """(cells, skipped): the cells of every data set, and (dataset, reason) of those that can't run.

    A data set without its target or another required column, without rows, or
    that fails otherwise, doesn't stop the others.
    """
    cells, skipped = [], []
    for spec in specs:
        try:
            if spec.target not in spec.df.columns:
                raise ValueError(f"missing target: {spec.target}")
            if not clean.require_columns(spec.df, columns := [spec.row, *spec.continuous, *spec.categorical]):
                raise ValueError(f"missing columns: {', '.join(c for c in columns if c not in spec.df.columns)}")
            cells.append(cut_lineage(tstr(spec, n_seeds, iterations)))
        except Exception as error:  # noqa: BLE001  reported with its data set
            skipped.append((spec.name, f"{type(error).__name__}: {str(error).splitlines()[0] if str(error) else ''}"[:300]))
    spark = SparkSession.getActiveSession()
    return reduce(DataFrame.unionByName, cells, spark.createDataFrame([], CELLS)), spark.createDataFrame(skipped, "dataset string, reason string")


def empirical_summary(cells: DataFrame) -> DataFrame:
    """Mean and deviation over seeds: one row per synthetic source, beside the real baseline."""
    metrics = ["accuracy", "f1", "roc_auc"]
    real = evaluate.seed_summary(cells.filter("source = 'real'"), ["dataset"], metrics).drop("n_seeds")
    real = real.select("dataset", *[F.col(f"{m}_{s}").alias(f"trtr_{m}_{s}") for m in metrics for s in ("mean", "std")])
    synthetic = evaluate.seed_summary(cells.filter("source <> 'real'"), ["dataset", "domain", "source"], [*metrics, "fidelity_score"])
    for m in metrics:
        for s in ("mean", "std"):
            synthetic = synthetic.withColumnRenamed(f"{m}_{s}", f"tstr_{m}_{s}")
    return synthetic.join(real, "dataset")


def gap_summary(cells: DataFrame) -> DataFrame:
    """Why synthetic rows train worse models: one row per data set and synthetic source, beside the real rows.

    Mean and deviation over seeds of the F1 gap, of the rates of the positive
    class among predictions, true and training labels, and how far the training
    rate is from the real one.
    """
    rates = ["true_pos_rate", "pred_pos_rate", "train_pos_prev"]
    real = cells.filter("source = 'real'").select("dataset", "seed", F.col("f1").alias("real_f1"), F.col("pred_pos_rate").alias("real_pred"), F.col("train_pos_prev").alias("real_prev"))
    both = cells.filter("source <> 'real'").join(real, ["dataset", "seed"])
    both = both.withColumns({
        "f1_gap": F.col("real_f1") - F.col("f1"), "pred_rate_gap": F.col("pred_pos_rate") - F.col("real_pred"), "prevalence_gap": F.col("train_pos_prev") - F.col("real_prev"),
    })
    return evaluate.seed_summary(both, ["dataset", "source"], [*rates, "f1_gap", "pred_rate_gap", "prevalence_gap"])


def correlation_retention(tables: DataFrame, features: Sequence[str], positive: Column, real: str = "real") -> DataFrame:
    """(source, feature, corr, real_corr, retained): how much of each feature's correlation with the target a source keeps.

    ``tables`` has the rows of every source under ``source``. ``retained`` is
    NULL where the real rows have no correlation.
    """
    found = evaluate.target_correlation(tables, features, positive, ["source"])
    base = found.filter(F.col("source") == real).select("feature", F.col("corr").alias("real_corr"))
    joined = found.filter(F.col("source") != real).join(base, "feature")
    return joined.select("source", "feature", "corr", "real_corr", F.try_divide("corr", "real_corr").alias("retained"))


def loop_gain(grid: DataFrame, few: int = 0, many: int = 5) -> DataFrame:
    """Paired test over texts of the mean score after ``many`` and after ``few`` iterations."""
    pairs = evaluate.pair_up(grid.filter(F.col("iterations").isin(few, many)), ["text_id"], "iterations", many, few, "score")
    return evaluate.paired_ttest(pairs).withColumns({"few": F.lit(few), "many": F.lit(many)})
