"""Data and parameters to fidelity: fit, correlation, bias, privacy, score.

Data comes as *vectors* (source_id, x array<double>) in variable order, labels
as codes, so one set of operators serves a single wide table and many
generated sources alike.  NULL in a vector is a missing value or a label the
parameters do not know.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import rng
from ..functions.ks import ks_statistic
from ..functions.numeric import clamp, norm_cdf
from ..functions.special import chi2_sf_udf, gamma_cdf_udf, kolmogorov_sf_udf, mean_nearest_udf
from ..functions.text import fixed4
from ..params import Parameters
from ..schemas import (
    gamma_scale,
    gamma_shape,
    is_categorical,
    is_gamma,
    is_uniform,
    uniform_high,
    uniform_low,
)
from ..session import broadcast_if_small, cut_lineage, sealed, small
from . import onepass
from .onepass import Scan
from .synthesize import blocks_of, declared_pairs, indexed

DIRECT_PAIRS = 60


def thresholds(custom: dict | None = None) -> dict:
    """Custom values over the defaults."""
    return {**fv.THRESHOLDS, **(custom or {})}


def wide_vectors(df: DataFrame, parameters: Parameters, row: str | None = None, need_all: bool = True) -> DataFrame:
    """A wide table as vectors of one source."""
    missing = [n for n in parameters.names if n not in df.columns]
    if missing and need_all:
        raise ValueError(f"columns not in the data: {', '.join(missing)}")
    entries = []
    for v in parameters.variables:
        if v.name in missing:
            entries.append(F.lit(None).cast("double"))
        elif v.distribution == "categorical":
            pairs = [F.lit(x) for i, (label, _) in enumerate(v.categories) for x in (label, float(i))]
            entries.append(F.try_element_at(F.create_map(*pairs), F.col(v.name).cast("string")))
        else:
            entries.append(F.col(v.name).cast("double"))
    keep = [F.col(row).alias("row_id")] if row else []
    return df.select(F.lit(parameters.source_id).alias("source_id"), *keep, F.array(*entries).alias("x"))


def _with_variables(vectors: DataFrame, v: DataFrame) -> DataFrame:
    cells = vectors.select("source_id", F.posexplode("x").alias("idx", "value"))
    return cells.join(broadcast_if_small(v), ["source_id", "idx"])


# --- distribution fit -----------------------------------------------------------------


def distribution_positions(vectors: DataFrame, v: DataFrame) -> DataFrame:
    """(source_id, idx, u): each continuous value's place in its distribution."""
    cells = _with_variables(vectors, v.filter(~is_categorical()).select(
        "source_id", "idx", "distribution", "mean", "std", "min", "max"
    )).filter(F.col("value").isNotNull())
    scaled = F.when(
        is_uniform(), clamp(F.try_divide(F.col("value") - uniform_low(), uniform_high() - uniform_low()), 0.0, 1.0)
    ).otherwise(F.try_divide(F.col("value") - F.col("mean"), F.col("std")))
    plain = cells.filter(~is_gamma()).select("source_id", "idx", is_uniform().alias("flat"), scaled.alias("z"))
    out = plain.select("source_id", "idx", F.when(F.col("flat"), F.col("z")).otherwise(norm_cdf(F.col("z"))).alias("u"))
    if not v.filter(is_gamma()).isEmpty():
        skewed = cells.filter(is_gamma()).select("source_id", "idx", "value", gamma_shape().alias("a"), gamma_scale().alias("b"))
        out = out.unionByName(skewed.select("source_id", "idx", gamma_cdf_udf("value", "a", "b").alias("u")))
    return sealed(out)


def summary(vectors: DataFrame, v: DataFrame) -> DataFrame:
    """(source_id, idx, code, count, seen, avg, std) in one scan.

    Categorical variables have one row per code (NULL: unknown or missing),
    continuous ones a single row with their moments. Vectors that nothing was
    done to since ``synthesize_many`` are summed up in the tasks that draw them.
    """
    blocks = blocks_of(vectors)
    if blocks is None:
        sums = vectors.select("source_id", "x").mapInArrow(onepass.cell_sums, onepass.CELL_SUMS)
    else:
        sums = blocks.mapInArrow(onepass.drawn_sums, onepass.CELL_SUMS)
    labelled, code = F.coalesce(is_categorical(), F.lit(False)).alias("labelled"), F.col("value")
    declared = v.select("source_id", "idx", labelled, F.nanvl(F.coalesce("mean", F.lit(0.0)), F.lit(0.0)).alias("declared"))
    # Sums of a batch meet the variables, not its cells; a position's codes are used where it has labels.
    sums = sums.join(broadcast_if_small(declared), ["source_id", "idx"]).filter(F.col("labelled") | code.isNull())
    missing = F.col("labelled") & code.isNull()
    broken = F.when(missing & ~F.col("whole"), F.raise_error(F.lit("a label's code is not a whole number")).cast("long"))
    sums = sums.select(
        "source_id", "idx", F.when(F.col("labelled"), code.cast("int")).alias("code"), "declared",
        F.coalesce(broken, F.when(missing, F.col("n") - F.col("seen")).otherwise(F.col("n"))).alias("n"),
        F.when(missing, F.lit(0)).otherwise(F.col("seen")).alias("seen"),
        *[F.when(~missing, F.col(c)).alias(c) for c in ("total", "near", "square", "lo", "hi")],
    ).filter("n > 0")
    d = F.col("lo") - F.col("declared")
    found = sums.groupBy("source_id", "idx", "code").agg(
        F.sum("n").alias("count"), F.sum("seen").alias("seen"), F.sum("total").alias("total"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.sum(F.col("near") + F.col("seen") * d).alias("s"), F.sum(F.col("square") + d * F.col("near") * 2.0 + F.col("seen") * d * d).alias("q"),
    )
    # Merged deviations of a constant need not be exactly 0.
    spread = F.sqrt(F.greatest((F.col("q") - F.col("s") * F.try_divide(F.col("s"), F.col("seen"))) / (F.col("seen") - 1), F.lit(0.0)))
    std = F.when(F.col("seen") > 1, F.when((F.col("hi") > F.col("lo")) | F.isnan("hi"), spread).otherwise(0.0))
    return found.select("source_id", "idx", "code", "count", "seen", F.try_divide("total", "seen").alias("avg"), std.alias("std"))


def label_comparison(found: DataFrame, v: DataFrame) -> DataFrame:
    """(source_id, idx, label, prob, observed, total, unknown) per declared label."""
    labels = v.filter(is_categorical()).select("source_id", "idx", F.posexplode("categories").alias("code", "c"))
    counts = found.select("source_id", "idx", "code", "count")
    totals = counts.groupBy("source_id", "idx").agg(
        F.sum("count").alias("total"), F.sum(F.when(F.col("code").isNull(), F.col("count")).otherwise(0)).alias("unknown")
    )
    return labels.join(counts, ["source_id", "idx", "code"], "left").join(totals, ["source_id", "idx"]).select(
        "source_id", "idx", "code", F.col("c.label").alias("label"), F.col("c.prob").alias("prob"),
        F.coalesce("count", F.lit(0)).alias("observed"), "total", "unknown",
    )


def chi_square(comparison: DataFrame) -> DataFrame:
    """(source_id, idx, n, statistic, pvalue, unknown).

    A label expected never, or values outside the labels, give p = 0.
    """
    expected = F.col("prob") * F.col("total")
    tested = comparison.groupBy("source_id", "idx").agg(
        F.first("total").alias("n"), F.first("unknown").alias("unknown"), (F.count(F.lit(1)) - 1).alias("dof"),
        F.min(expected).alias("least"), F.sum(F.try_divide(F.pow(F.col("observed") - expected, F.lit(2.0)), expected)).alias("statistic"),
    )
    tested = tested.withColumn("p", F.when(F.col("dof") == 0, F.lit(1.0)).otherwise(chi2_sf_udf("statistic", "dof")))
    impossible = (F.col("least") <= 0) | (F.col("unknown") > 0)
    return tested.select(
        "source_id", "idx", "n", "statistic", F.when(impossible, F.lit(0.0)).otherwise(F.col("p")).alias("pvalue"), "unknown"
    )


def without_nan(vectors: DataFrame) -> DataFrame:
    """NaN counts as missing, so that one such value doesn't spoil every mean."""
    return sealed(vectors.withColumn("x", F.transform("x", lambda e: F.when(~F.isnan(e), e))))


def distribution_fit(
    vectors: DataFrame, variables: DataFrame, present: list[str] | None = None, buckets: int = 4096
) -> DataFrame:
    """(source_id, idx, name, test, n, statistic, pvalue) per variable.

    Continuous variables: KS against the declared distribution, without noise.
    Categorical ones: chi-square.  Variables absent from the data are skipped;
    one that can't be tested (declared deviation 0, no value) has p = 0 and no
    statistic, so it fails.
    """
    v, vectors = _present(variables, present), without_nan(vectors)
    if small(v, onepass.VARIABLES):
        scan = Scan(vectors, v, buckets)
        return _fit(vectors, v, scan.summary(), buckets, scan)
    return _fit(vectors, v, summary(vectors, v), buckets)


def _present(variables: DataFrame, present: list[str] | None) -> DataFrame:
    v = indexed(variables)
    return cut_lineage(v if present is None else v.filter(F.col("name").isin(*present)))


def _fit(vectors: DataFrame, v: DataFrame, found: DataFrame, buckets: int, scan: Scan | None = None) -> DataFrame:
    if scan is None:
        ks = ks_statistic(distribution_positions(vectors, v), ["source_id", "idx"], buckets)
    else:
        ks = ks_statistic(scan.places(), ["source_id", "idx"], buckets, counted=scan.histogram())
    ks = ks.select("source_id", "idx", "n", F.col("d").alias("statistic"), kolmogorov_sf_udf("d", "n").alias("p"))
    declared = v.filter(~is_categorical()).select("source_id", "idx").join(vectors.select("source_id").distinct(), "source_id", "left_semi")
    ks = declared.join(ks, ["source_id", "idx"], "left").select(
        "source_id", "idx", F.coalesce("n", F.lit(0)).alias("n"), "statistic", F.coalesce("p", F.lit(0.0)).alias("pvalue"), F.lit("ks").alias("test")
    )
    chi = chi_square(label_comparison(found, v)).withColumn("test", F.lit("chi2")).drop("unknown")
    return ks.unionByName(chi).join(v.select("source_id", "idx", "name"), ["source_id", "idx"])


# --- correlation -------------------------------------------------------------------------


def vector_correlations(vectors: DataFrame, k: int) -> DataFrame:
    """(source_id, i, j, r), i < j < k: pairwise complete, constants give 0."""
    pairs = [(i, j) for i in range(k) for j in range(i + 1, k)]
    if not pairs:
        return vectors.sparkSession.createDataFrame([], "source_id string, i int, j int, r double")

    def correlation(a, b):
        there = lambda x, y: F.when(y.isNotNull(), x)
        # Merged partial deviations of a constant need not be exactly 0.
        spread = lambda x, y: F.when(F.max(there(x, y)) > F.min(there(x, y)), F.stddev_pop(there(x, y)))
        return F.coalesce(F.try_divide(F.covar_pop(a, b), spread(a, b) * spread(b, a)), F.lit(0.0))

    if len(pairs) <= DIRECT_PAIRS:
        flat = vectors.select("source_id", *[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(k)])
        sized = flat.groupBy("source_id").agg(*[correlation(F.col(f"x{i}"), F.col(f"x{j}")).alias(f"r{i}_{j}") for i, j in pairs])
        rows = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"r{i}_{j}").alias("r")) for i, j in pairs])
        return sized.select("source_id", F.explode(rows).alias("p")).select("source_id", "p.*")
    # Shifted by the mean, so that sums of squares keep their digits.
    means = vectors.select("source_id", F.posexplode("x").alias("i", "a")).groupBy("source_id", "i").agg(F.avg("a").alias("m"))
    means = means.groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("m", F.lit(0.0)).alias("m")))).alias("ms"))
    near = vectors.join(broadcast_if_small(means, 10_000), "source_id").select(
        "source_id", F.zip_with("x", "ms", lambda a, m: a - m["m"]).alias("x")
    )
    moments = near.mapInArrow(_pair_moments, "source_id string, i int, j int, n double, a double, b double, aa double, bb double, ab double")
    total = moments.groupBy("source_id", "i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "a", "b", "aa", "bb", "ab")])
    n = F.col("n")
    spread = F.sqrt((n * F.col("aa") - F.col("a") * F.col("a")) * (n * F.col("bb") - F.col("b") * F.col("b")))
    r = F.when(spread > 0, (n * F.col("ab") - F.col("a") * F.col("b")) / spread)
    return total.select("source_id", "i", "j", F.coalesce(r, F.lit(0.0)).alias("r"))


def _pair_moments(batches):
    """Per batch and source: counts, sums and products of every pair of positions, over rows that have both."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        if not batch.num_rows:
            continue
        by_source = {}
        for source, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by_source.setdefault(source, []).append([np.nan if e is None else e for e in values])
        for source, rows in by_source.items():
            own = np.array(rows)
            there = ~np.isnan(own)
            own, there = np.where(there, own, 0.0), there.astype(float)
            n, s, q, p = there.T @ there, own.T @ there, (own**2).T @ there, own.T @ own
            i, j = np.triu_indices(own.shape[1], 1)
            columns = [pa.array([source] * len(i), pa.string()), pa.array(i, pa.int32()), pa.array(j, pa.int32())]
            columns += [pa.array(m) for m in (n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], p[i, j])]
            yield pa.RecordBatch.from_arrays(columns, ["source_id", "i", "j", "n", "a", "b", "aa", "bb", "ab"])


def correlation_similarity(vectors: DataFrame, variables: DataFrame, correlations: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """(source_id, corr_similarity): 1 - mean |difference| / 2 over all pairs.

    A pair that was not declared has target 0; fewer than two variables give 1.
    ``found`` holds the correlations where a scan has made them already.
    """
    sizes = cut_lineage(variables.groupBy("source_id").agg(F.count(F.lit(1)).alias("k")))
    if found is None:
        found = vector_correlations(vectors, sizes.agg(F.max("k")).first()[0] or 0)
    found = found.withColumnRenamed("r", "seen")
    found = found.join(sizes, "source_id").filter(F.col("j") < F.col("k"))
    wanted = declared_pairs(variables, correlations).filter("i <> j").withColumnRenamed("r", "wanted")
    scored = found.join(wanted, ["source_id", "i", "j"], "left").groupBy("source_id").agg(
        F.avg(F.abs(F.col("seen") - F.coalesce("wanted", F.lit(0.0)))).alias("err")
    )
    similarity = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - F.col("err") / 2.0))
    return sizes.join(scored, "source_id", "left").select(
        "source_id", F.when(F.col("k") < 2, F.lit(1.0)).otherwise(similarity).alias("corr_similarity")
    )


# --- bias ----------------------------------------------------------------------------------


def biased_variables(vectors: DataFrame, variables: DataFrame, present: list[str] | None = None) -> DataFrame:
    """(source_id, idx, name, biased) for the variables found in the data."""
    v = _present(variables, present)
    return _biased(v, summary(vectors, v))


def _biased(v: DataFrame, found: DataFrame) -> DataFrame:
    scale = F.when(F.col("mean") != 0, F.abs("mean")).when(F.col("v.std") != 0, F.col("v.std")).otherwise(1.0)
    continuous = found.alias("f").join(v.filter(~is_categorical()).alias("v"), ["source_id", "idx"]).select(
        "source_id", "idx", "name",
        F.coalesce(F.abs(F.col("avg") - F.col("mean")) / scale > fv.BIAS_RELATIVE_MEAN, F.lit(False)).alias("biased"),
    )
    off = F.abs(F.try_divide(F.col("observed"), F.col("total")) - F.col("prob")) > fv.BIAS_FREQUENCY
    categorical = label_comparison(found, v).groupBy("source_id", "idx").agg(F.max(F.coalesce(off, F.lit(True))).alias("biased"))
    categorical = categorical.join(v.select("source_id", "idx", "name"), ["source_id", "idx"])
    return continuous.unionByName(categorical.select("source_id", "idx", "name", "biased"))


def bias_score(vectors: DataFrame, variables: DataFrame, present: list[str] | None = None) -> DataFrame:
    """(source_id, bias): 1 - biased / all variables."""
    return _bias(variables, biased_variables(vectors, variables, present))


def _bias(variables: DataFrame, judged: DataFrame) -> DataFrame:
    totals = variables.groupBy("source_id").agg(F.count(F.lit(1)).alias("k"))
    biased = judged.groupBy("source_id").agg(F.sum(F.col("biased").cast("int")).alias("b"))
    return totals.join(biased, "source_id", "left").select(
        "source_id", (1.0 - F.coalesce("b", F.lit(0)) / F.col("k")).alias("bias")
    )


# --- privacy ---------------------------------------------------------------------------------


def standardised(vectors: DataFrame, v: DataFrame, found: DataFrame) -> DataFrame:
    """Continuous positions only, to mean 0 and deviation 1 over the source."""
    spread = F.when((F.col("f.std") == 0) | F.col("f.std").isNull(), F.lit(1.0)).otherwise(F.col("f.std"))
    listed = found.alias("f").join(v.filter(~is_categorical()).select("source_id", "idx"), ["source_id", "idx"])
    listed = listed.groupBy("source_id").agg(
        F.max("count").alias("rows"),
        F.array_sort(F.collect_list(F.struct("idx", F.col("avg").alias("m"), spread.alias("s")))).alias("ms"),
    )
    return vectors.join(broadcast_if_small(listed, 10_000), "source_id").withColumn(
        "x", F.transform("ms", lambda e: (F.get("x", e["idx"]) - e["m"]) / e["s"])
    ).drop("ms")


def privacy_score(vectors: DataFrame, variables: DataFrame, sample_size: int = fv.PRIVACY_SAMPLE, seed: int = 0) -> DataFrame:
    """(source_id, avg_min_dist, privacy_score) over the continuous variables.

    ``vectors`` carries ``row_id``; the sample is the rows with the smallest
    hash of it, picked per task before they meet.  Distances are between at
    most ``sample_size`` points per source.
    """
    v = _present(variables, None)
    return _privacy(vectors, v, summary(vectors, v), sample_size, seed)


def _privacy(vectors: DataFrame, v: DataFrame, found: DataFrame, sample_size: int = fv.PRIVACY_SAMPLE, seed: int = 0) -> DataFrame:
    keyed = sealed(rng.hash_order(vectors.select("source_id", "row_id", "x"), "row_id", seed, "h", "privacy"))
    rank = F.row_number().over(Window.partitionBy("source_id").orderBy("h", "row_id"))
    sample = keyed.withColumn("r", rank).filter(F.col("r") <= sample_size)
    points = standardised(sample, v, found)
    packed = points.groupBy("source_id").agg(F.first("rows").alias("rows"), F.max(F.size("x")).alias("k"), F.collect_list("x").alias("points"))
    usable = (F.col("rows") >= 2) & (F.col("k") > 0)
    measured = packed.withColumn("d", mean_nearest_udf("points")).withColumn("d", F.when(usable, F.col("d")).otherwise(0.0))
    share = F.when(usable, F.least(F.col("d") / F.sqrt("k"), F.lit(1.0))).otherwise(0.0)
    return measured.select("source_id", F.round("d", 4).alias("avg_min_dist"), F.round(share, 4).alias("privacy_score"))


# --- report -------------------------------------------------------------------------------------


def validate(
    vectors: DataFrame,
    variables: DataFrame,
    correlations: DataFrame,
    custom_thresholds: dict | None = None,
    privacy: bool = True,
    buckets: int = 4096,
) -> DataFrame:
    """One fidelity row per source.  ``vectors`` needs ``row_id`` for privacy."""
    limits = thresholds(custom_thresholds)
    v, vectors = _present(variables, None), without_nan(vectors)
    scan = Scan(vectors, v, buckets) if small(v, onepass.VARIABLES) else None
    found = cut_lineage(summary(vectors, v)) if scan is None else scan.summary()
    fit = _fit(vectors, v, found, buckets, scan)
    passed = F.avg((F.col("pvalue") >= limits["ks_pvalue"]).cast("double")) * 100.0
    as_map = lambda c: F.map_from_entries(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "name", c))), lambda e: F.struct(e["name"], e[c]))
    )
    fits = fit.groupBy("source_id").agg(
        passed.alias("ks"), F.max("n").alias("n_rows"), as_map("pvalue").alias("ks_pvalues"), as_map("statistic").alias("ks_stats")
    )
    out = fits.join(correlation_similarity(vectors, v.drop("idx"), correlations, scan and scan.correlations()), "source_id").join(_bias(v, _biased(v, found)), "source_id")
    overall = (
        F.col("ks") * fv.WEIGHT_FIT + F.col("corr_similarity") * 100.0 * fv.WEIGHT_CORRELATION + F.col("bias") * 100.0 * fv.WEIGHT_BIAS
    )
    out = out.withColumn("overall", overall)
    if privacy:
        out = out.join(_privacy(vectors, v, found), "source_id", "left")
    else:
        out = out.withColumns({"avg_min_dist": F.lit(None).cast("double"), "privacy_score": F.lit(None).cast("double")})
    return out.select(
        "source_id", "n_rows", F.round("overall", 2).alias("overall_score"), F.round("ks", 2).alias("ks_score"),
        F.round(F.col("corr_similarity") * 100.0, 2).alias("corr_score"), F.round(F.col("bias") * 100.0, 2).alias("bias_score"),
        "ks_pvalues", "ks_stats", F.coalesce("avg_min_dist", F.lit(0.0) if privacy else F.lit(None)).alias("avg_min_dist"),
        F.coalesce("privacy_score", F.lit(0.0) if privacy else F.lit(None)).alias("privacy_score"),
        (F.col("overall") >= limits["fidelity_score"]).alias("approved"),
    )


def validate_table(df: DataFrame, parameters: Parameters, custom_thresholds: dict | None = None, row: str | None = None) -> DataFrame:
    """Fidelity of one wide table against one set of parameters."""
    if row is None:
        df, row = df.withColumn("__row", F.monotonically_increasing_id()), "__row"
    variables, correlations = parameters.tables(df.sparkSession)
    return validate(wide_vectors(df, parameters, row), variables, correlations, custom_thresholds)


def datacard(fidelity: DataFrame, variables: DataFrame, meta: DataFrame, custom_thresholds: dict | None = None) -> DataFrame:
    """(source_id, card): a Markdown report per source."""
    limit = thresholds(custom_thresholds)["ks_pvalue"]
    v = indexed(variables)
    p = F.try_element_at("ks_pvalues", F.col("name"))
    line = F.format_string(
        "- %s **%s**: %s=%s", F.when(p >= limit, "[PASS]").otherwise("[FAIL]"), "name",
        F.when(is_categorical(), "Chi2 p-value").otherwise("KS p-value"), fixed4(p),
    )
    lines = fidelity.select("source_id", "ks_pvalues").join(v, "source_id").filter(p.isNotNull()).groupBy("source_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", line.alias("line")))), lambda e: e["line"]), "\n").alias("lines"),
        F.count(F.lit(1)).alias("columns"),
    )
    full = fidelity.join(lines, "source_id", "left").join(meta.select("source_id", "source", "extracted_at"), "source_id")
    return full.select("source_id", F.format_string(
        fv.DATACARD, "source", F.date_format("extracted_at", "yyyy-MM-dd'T'HH:mm:ss"), "n_rows", F.coalesce("columns", F.lit(0)),
        F.col("overall_score").cast("string"), F.coalesce("lines", F.lit("")), fixed4(F.col("corr_score") / 100.0), "bias_score",
        F.coalesce(F.col("avg_min_dist").cast("string"), F.lit("n/a")), F.coalesce(F.col("privacy_score").cast("string"), F.lit("n/a")),
    ).alias("card"))
