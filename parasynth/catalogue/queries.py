"""Query name -> callable(spark, folder)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import ranks
from ..functions.ks import ks_statistic
from ..operators import clean, discover, evaluate, extract, merge, profile, synthesize, validate
from ..params import Parameters, Variable
from ..plans import benchmark, optimize
from ..session import cut_lineage, table
from ..sources import files
from . import inputs

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _round(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# --- profiling and texts ------------------------------------------------------------


@query
def profile_continuous(spark, sf):
    p = profile.profile_table(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return _round(p.variables.select("name", "distribution", "mean", "std", "min", "max"), 4, "mean", "std", "min", "max")


@query
def profile_categorical(spark, sf):
    p = profile.profile_table(table(spark, sf, "orders"), [], ["o_orderstatus", "o_orderpriority"])
    labels = p.variables.select("name", F.posexplode("categories").alias("code", "c"))
    return _round(labels.select("name", F.col("code").cast("long").alias("code"), F.col("c.label").alias("label"), F.col("c.prob").alias("prob")), 6, "prob")


@query
def profile_correlation(spark, sf):
    return _round(inputs.lineitem_profile(spark, sf).correlations.select("key", "correlation", "direction"), 6, "correlation")


@query
def profile_by_source(spark, sf):
    v = inputs.supplier_profile(spark, sf).variables.filter("distribution = 'normal'")
    return _round(v.select("source_id", "name", "mean", "std"), 4, "mean", "std")


@query
def describe_table(spark, sf):
    return _round(profile.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]), 4, "mean", "std", "min", "max")


@query
def source_text(spark, sf):
    return inputs.supplier_texts(spark, sf)


# --- extraction -----------------------------------------------------------------------


@query
def extract_mean_std(spark, sf):
    v, _ = extract.extract_regex(inputs.part_texts(spark, sf))
    return _round(v.select("source_id", "name", "mean", "std", "min", "max"), 4, "mean", "std", "min", "max")


@query
def extract_categorical(spark, sf):
    v, _ = extract.extract_regex(inputs.supplier_texts(spark, sf))
    labels = v.filter("distribution = 'categorical'").select("source_id", "name", F.posexplode("categories").alias("code", "c"))
    return _round(labels.select("source_id", "name", F.col("code").cast("long").alias("code"), F.col("c.label").alias("label"), F.col("c.prob").alias("prob")), 6, "prob")


@query
def extract_correlation(spark, sf):
    _, c = extract.extract_regex(inputs.part_texts(spark, sf))
    return c.select("source_id", "key", "correlation", "direction")


@query
def extract_roundtrip(spark, sf):
    v, _ = extract.extract_regex(profile.source_text(*inputs.lineitem_profile(spark, sf)))
    return _round(v.select("var_pos", "name", "distribution", "mean", "std"), 3, "mean", "std")


@query
def parse_parameters_json(spark, sf):
    v, _, _ = extract.parse_responses(inputs.part_replies(spark, sf))
    first = F.get("categories", F.lit(0))
    out = v.select("source_id", "name", "distribution", "mean", "std", "min", "max", first["label"].alias("label"), first["prob"].alias("prob"))
    return _round(out, 4, "mean", "std", "min", "max", "prob")


@query
def parse_correlations_json(spark, sf):
    _, c, _ = extract.parse_responses(inputs.part_replies(spark, sf))
    return _round(c.select("source_id", "key", "var1", "var2", "correlation", "direction"), 4, "correlation")


@query
def extract_with_fallback(spark, sf):
    v, c, meta = extract.extract_parameters(inputs.part_texts(spark, sf), inputs.part_replies(spark, sf), "2026-01-01 00:00:00")
    n = v.groupBy("source_id").agg(F.count(F.lit(1)).alias("n_variables"))
    k = c.groupBy("source_id").agg(F.count(F.lit(1)).alias("n_correlations"))
    return meta.join(n, "source_id", "left").join(k, "source_id", "left").select("source_id", "extraction_method", "n_variables", "n_correlations")


@query
def process_pages(spark, sf):
    lines = F.array_join(F.transform(F.split("text", "\n"), lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), "\n")
    page = F.concat(F.lit("<html><head><title>mean 1 std 2</title></head><body><nav>menu</nav>"), lines, F.lit("<script>mean = 3</script></body></html>"))
    pages = inputs.part_texts(spark, sf).select("source_id", page.alias("html"))
    v, c, meta = extract.process_pages(pages, inputs.part_replies(spark, sf), "2026-01-01 00:00:00")
    n = v.groupBy("source_id").agg(F.count(F.lit(1)).alias("n_variables"))
    k = c.groupBy("source_id").agg(F.count(F.lit(1)).alias("n_correlations"))
    return meta.join(n, "source_id", "left").join(k, "source_id", "left").select("source_id", "extraction_method", "n_variables", "n_correlations")


@query
def normalize_parameters(spark, sf):
    c = table(spark, sf, "customer")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("normal", "uniform", "gamma", "categorical", "weird")]), (F.col("c_custkey") % 5 + 1).cast("int"))
    shares = F.array(
        F.struct(F.lit("a").alias("label"), F.greatest(F.col("c_acctbal"), F.lit(0.0)).alias("prob")),
        F.struct(F.lit("b").alias("label"), F.greatest(F.col("c_acctbal") / 3.0, F.lit(0.0)).alias("prob")),
    )
    raw = c.select(
        "c_custkey", kind.alias("distribution"), F.col("c_acctbal").alias("mean"), F.col("c_nationkey").cast("double").alias("std"),
        F.lit(None).cast("double").alias("min"), F.lit(None).cast("double").alias("max"), shares.alias("categories"),
        (F.col("c_acctbal") / 1000.0).alias("correlation"),
    )
    fixed = schemas.coerce_correlations(schemas.default_bounds(schemas.coerce_variables(raw)))
    out = fixed.select("c_custkey", "distribution", "min", "max", "correlation", F.get("categories", F.lit(0))["prob"].alias("prob"))
    return _round(out, 4, "min", "max", "correlation", "prob")


@query
def parameters_from_truth(spark, sf):
    s = table(spark, sf, "supplier")
    truth = s.select(F.col("s_suppkey").cast("string").alias("source_id"), F.lit(0).alias("var_pos"), F.lit("balance").alias("name"), F.col("s_acctbal").alias("mean"), F.lit(2.0).alias("std"))
    pairs = s.select(F.col("s_suppkey").cast("string").alias("source_id"), F.lit("balance").alias("var1"), F.lit("nation").alias("var2"), (F.col("s_nationkey") / 12.0 - 1.0).alias("correlation"))
    v, c = extract.parameters_from_truth(truth, pairs)
    return _round(v.join(c, "source_id").select("source_id", "name", "min", "max", "key", "correlation", "direction"), 4, "min", "max", "correlation")


@query
def merge_parameters(spark, sf):
    v, _, _ = inputs.merged_by_nation(spark, sf)
    return _round(v.select("source_id", "name", "distribution", "mean", "std", "min", "max"), 3, "mean", "std", "min", "max")


@query
def merge_categories(spark, sf):
    v, _, _ = inputs.merged_by_nation(spark, sf, True)
    labels = v.select("source_id", "name", F.posexplode("categories").alias("code", "c"))
    return _round(labels.select("source_id", "name", F.col("c.label").alias("label"), F.col("c.prob").alias("prob")), 5, "prob")


@query
def merge_correlations(spark, sf):
    _, c, _ = inputs.merged_by_nation(spark, sf)
    return _round(c.select("source_id", "key", "correlation"), 5, "correlation")


@query
def merge_sources(spark, sf):
    v, c = inputs.supplier_profile(spark, sf)
    return merge.merge_parameters(v, c, inputs.nation_members(spark, sf))[2].select("source_id", "source", "extraction_method")


@query
def merge_lineage(spark, sf):
    return merge.lineage(inputs.nation_members(spark, sf)).select("source_id", "member", "source")


@query
def score_extraction(spark, sf):
    p = inputs.supplier_profile(spark, sf)
    found, _ = extract.extract_regex(profile.source_text(*p))
    scores = extract.score_extraction(found, p.variables.filter("distribution = 'normal'"))
    return _round(scores, 4, "success_rate", "mean_rel_err", "std_rel_err")


@query
def method_list(spark, sf):
    _, _, meta = extract.extract_parameters(inputs.part_texts(spark, sf), inputs.part_replies(spark, sf), "2026-01-01 00:00:00")
    return clean.method_list(meta.withColumn("group_id", F.col("source_id").cast("long") % 20), "group_id")


@query
def rejected_sources(spark, sf):
    v, _, valid = extract.parse_responses(inputs.part_replies(spark, sf))
    return schemas.rejected(valid, v).select("source_id", "reason")


@query
def parameters_json(spark, sf):
    v, c, meta = inputs.merged_by_nation(spark, sf)
    return files.parameters_json(v, c, meta)


# --- cleaning and discovery ---------------------------------------------------------------


@query
def html_to_text(spark, sf):
    return clean.html_to_text(table(spark, sf, "pages")).select("page_id", "text")


@query
def assemble_pages(spark, sf):
    c = table(spark, sf, "conversations")
    return clean.assemble_pages(c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_no"), "text"))


@query
def statistical_density(spark, sf):
    d = table(spark, sf, "documents")
    return _round(d.select("doc_id", clean.statistical_density(F.col("text")).alias("density")), 6, "density")


@query
def expand_queries(spark, sf):
    return discover.expand_queries(*inputs.asked_and_answered(spark, sf))


@query
def run_discovery(spark, sf):
    found = discover.run_discovery(*inputs.asked_and_answered(spark, sf), inputs.corpus(spark, sf))
    return found.select("query_id", "query_pos", "result_pos", "doc_id", "hits", "source_type")


@query
def search_corpus(spark, sf):
    hits = discover.search_corpus(inputs.passage_queries(spark, sf), inputs.corpus(spark, sf))
    return hits.select("query_id", "source_type", "result_pos", "doc_id", "hits", "relevance_score")


@query
def dedup_sources(spark, sf):
    return discover.dedup_sources(inputs.page_sources(spark, sf))


@query
def classify_sources(spark, sf):
    return discover.classify_sources(inputs.page_sources(spark, sf)).select("page_id", "source_type", "relevance_score")


@query
def suggest_sources(spark, sf):
    return discover.suggest_sources(*inputs.judged_results(spark, sf))


@query
def select_sources(spark, sf):
    marked = discover.suggest_sources(*inputs.judged_results(spark, sf))
    return discover.select_sources(marked, True).select("query_id", "result_pos", "doc_id")


@query
def recode_clean(spark, sf):
    o = clean.rename(table(spark, sf, "orders"), {"o_orderpriority": "priority"})
    level = clean.recode(F.col("priority"), {"1-URGENT": "high", "2-HIGH": "high", "5-LOW": "low"})
    o = o.withColumns({"level": level, "status": clean.strip_trailing(F.concat("o_orderstatus", F.lit(".")))})
    return clean.project_complete(o, ["o_orderkey", "status", "level"])


@query
def latest_runs(spark, sf):
    e = table(spark, sf, "events")
    return clean.latest_runs(e.select(F.concat(F.lit("run_"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("run_id"), "event_type"))


@query
def preview(spark, sf):
    return clean.preview(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), [F.col("o_totalprice").desc(), "o_orderkey"])


# --- synthesis ------------------------------------------------------------------------------


def _rows(spark, sf):
    return table(spark, sf, "lineitem").count()


def _copula_parameters(spark, sf):
    p = inputs.lineitem_parameters(spark, sf)
    q, e, s, f = p.variables
    flat = Variable("l_quantity", "uniform", q.mean, q.std, 1.0, 50.0)
    return Parameters([flat, e, s, f], [("l_quantity", "l_extendedprice", 0.6), ("l_extendedprice", "l_returnflag", -0.3)])


@query
def synth_copula(spark, sf):
    p = _copula_parameters(spark, sf)
    return _round(synthesize.synthesize(spark, p, _rows(spark, sf), keep_row_id=True), 3, "l_quantity", "l_extendedprice")


@query
def synth_independent(spark, sf):
    p = _copula_parameters(spark, sf).without_correlations()
    return _round(synthesize.synthesize(spark, p, _rows(spark, sf), keep_row_id=True), 3, "l_quantity", "l_extendedprice")


@query
def synth_categorical(spark, sf):
    p = inputs.lineitem_parameters(spark, sf)
    df = synthesize.synthesize(spark, Parameters([v for v in p.variables if v.categories], []), _rows(spark, sf), seed=7)
    return df.groupBy("l_linestatus", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query
def synth_gamma(spark, sf):
    q = inputs.lineitem_parameters(spark, sf).variables[1]
    p = Parameters([Variable("price", "gamma", q.mean, q.std), Variable("other", "normal", q.mean, q.std)], [("price", "other", 0.5)])
    df = synthesize.synthesize(spark, p, _rows(spark, sf))
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg("price").alias("mean"), F.stddev_samp("price").alias("std"), F.corr("price", "other").alias("corr"))


@query
def synth_by_source(spark, sf):
    v, c = inputs.supplier_profile(spark, sf)
    x = synthesize.synthesize_many(v, c)
    v = cut_lineage(synthesize.indexed(v))
    found = validate.summary(x, v)  # labels stay codes until they are counted
    found = found.groupBy("source_id", "idx").agg(F.sum("count").alias("n"), F.max("avg").alias("avg"), F.count("code").alias("labels"))
    mean = F.when(F.col("distribution") != "categorical", F.col("avg")).alias("mean")
    return found.join(v, ["source_id", "idx"]).select("source_id", "name", "n", mean, "labels")


@query
def rank_match(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.unix_timestamp(F.date_trunc("month", "o_orderdate")).alias("month"))
    placed = synthesize.rank_match(o.select("o_orderkey", "month"), "month", "o_orderkey", o.select("o_totalprice"), "o_totalprice")
    return placed.select("o_orderkey", "rank", "o_totalprice")


@query
def fit_copula(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("revenue", F.col("l_extendedprice") * F.col("l_quantity"))
    fitted = synthesize.fit_copula(li, ["l_quantity", "l_extendedprice", "revenue"], ["l_returnflag"])
    df = synthesize.sample_copula(spark, fitted, _rows(spark, sf), 1)
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg("revenue").alias("mean_revenue"), F.corr("l_quantity", "revenue").alias("corr"), F.count_distinct("l_returnflag").alias("labels"))


# --- validation -------------------------------------------------------------------------------


def _ks(spark, sf, variable):
    p = Parameters([variable])
    v = validate.cut_lineage(synthesize.indexed(p.tables(spark)[0]))
    vectors = validate.wide_vectors(table(spark, sf, "lineitem"), p)
    d = ks_statistic(validate.distribution_positions(vectors, v), ["source_id", "idx"])
    return _round(d.select("n", F.col("d")), 8, "d")


@query
def ks_statistic_normal(spark, sf):
    return _ks(spark, sf, inputs.lineitem_parameters(spark, sf).variables[1])


@query
def ks_statistic_uniform(spark, sf):
    return _ks(spark, sf, Variable("l_quantity", "uniform", 25.0, 14.0, 1.0, 50.0))


@query
def ks_statistic_gamma(spark, sf):
    v = inputs.lineitem_parameters(spark, sf).variables[1]
    return _ks(spark, sf, Variable(v.name, "gamma", v.mean, v.std))


@query
def chi_square_fit(spark, sf):
    p = Parameters([Variable("o_orderstatus", "categorical", categories=[("F", 1.0), ("O", 1.0), ("P", 1.0)])])
    fit = validate.distribution_fit(validate.wide_vectors(table(spark, sf, "orders"), p), p.tables(spark)[0])
    return _round(fit.select("name", "n", "statistic", "pvalue"), 5, "statistic", "pvalue")


@query
def distribution_fit(spark, sf):
    p = inputs.lineitem_parameters(spark, sf)
    fit = validate.distribution_fit(validate.wide_vectors(table(spark, sf, "lineitem"), p), p.tables(spark)[0])
    return _round(fit.select("name", "test", "n", "statistic"), 6, "statistic")


def _claims(spark):
    return Parameters(
        [Variable("l_quantity", "normal", 30.0, 14.0), Variable("l_extendedprice", "normal", 40000.0, 30000.0),
         Variable("l_returnflag", "categorical", categories=[("R", 0.2), ("N", 0.5), ("A", 0.3)])],
        [("l_quantity", "l_extendedprice", 0.4), ("l_returnflag", "l_quantity", -0.2)],
    )


@query
def correlation_similarity(spark, sf):
    p = _claims(spark)
    out = validate.correlation_similarity(validate.wide_vectors(table(spark, sf, "lineitem"), p), *p.tables(spark))
    return _round(out.select("corr_similarity"), 6, "corr_similarity")


@query
def bias_variables(spark, sf):
    p = _claims(spark)
    return validate.biased_variables(validate.wide_vectors(table(spark, sf, "lineitem"), p), p.tables(spark)[0]).select("name", "biased")


@query
def bias_score(spark, sf):
    p = _claims(spark)
    return _round(validate.bias_score(validate.wide_vectors(table(spark, sf, "lineitem"), p), p.tables(spark)[0]).select("bias"), 6, "bias")


@query
def privacy_score(spark, sf):
    p = Parameters([Variable("c_acctbal"), Variable("c_nationkey")])
    c = table(spark, sf, "customer")
    out = validate.privacy_score(validate.wide_vectors(c, p, "c_custkey"), p.tables(spark)[0])
    return out.select("avg_min_dist", "privacy_score")


@query
def fidelity_report(spark, sf):
    p = inputs.lineitem_parameters(spark, sf)
    df = inputs.lineitem_row(table(spark, sf, "lineitem"))
    return validate.validate_table(df, p, row="row_id")


@query
def datacard(spark, sf):
    p = inputs.lineitem_parameters(spark, sf)
    df = inputs.lineitem_row(table(spark, sf, "lineitem"))
    meta = p.tables(spark)[0].select("source_id").distinct().select("source_id", F.lit("lineitem").alias("source"), F.to_timestamp(F.lit("2026-01-01 00:00:00")).alias("extracted_at"))
    return validate.datacard(validate.validate_table(df, p, row="row_id"), p.tables(spark)[0], meta)


# --- optimisation loop ---------------------------------------------------------------------------


@query
def noise_schedule(spark, sf):
    out = optimize.noise_schedule(inputs.score_log(spark, sf))
    return _round(out.select("run_id", "position", "iteration", "noise", "improved", "streak", "best_score"), 8, "noise")


@query
def ratchet_best(spark, sf):
    return optimize.ratchet_best(inputs.score_log(spark, sf))


@query
def optimization_loop(spark, sf):
    v, c, _ = inputs.merged_by_nation(spark, sf)
    state, _ = optimize.run_loop(v, c, 5, 10_000)
    return state.select("source_id", "best_score", "best_iteration", "best_noise")


@query
def noise_grid(spark, sf):
    v, c, _ = inputs.merged_by_nation(spark, sf)
    grid = optimize.noise_grid(v, c)
    return grid.groupBy("iterations").agg(F.avg("score").alias("mean"), F.stddev_samp("score").alias("std"), F.count(F.lit(1)).alias("count"))


# --- evaluation --------------------------------------------------------------------------------------


@query
def stratified_split(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return evaluate.stratified_split(o, "o_orderstatus", "o_orderkey", 0.2, 3)


@query
def label_encode(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return evaluate.label_encode(c, "c_mktsegment").select("c_custkey", F.col("c_mktsegment_code").cast("long").alias("code"))


@query
def unseen_labels(spark, sf):
    p = table(spark, sf, "part")
    return evaluate.unseen_labels(p.filter("p_size > 20"), "p_name", p.filter("p_size <= 20")).select("p_name")


@query
def positive_label(spark, sf):
    return evaluate.positive_label(table(spark, sf, "orders"), "o_orderpriority")


@query
def confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(inputs.returns(spark, sf), "label", "prediction")


@query
def class_report(spark, sf):
    return _round(evaluate.class_report(inputs.returns(spark, sf), "label", "prediction"), 6, "precision", "recall", "f1")


@query
def classifier_metrics(spark, sf):
    q = inputs.quality(spark, sf).select(F.col("quality").alias("label"), (F.col("n_chars") > 1000).cast("int").alias("prediction"), "lang")
    return _round(evaluate.classifier_metrics(q, by=["lang"]), 6, "accuracy", "f1")


@query
def roc_auc(spark, sf):
    li = table(spark, sf, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("label"), F.col("l_extendedprice").alias("score"))
    return _round(evaluate.roc_auc(li, "label", "score"), 8, "roc_auc")


@query
def positive_rates(spark, sf):
    r = inputs.returns(spark, sf)
    out = r.agg(evaluate.rate(F.col("prediction") == "R").alias("pred_pos_rate"), evaluate.rate(F.col("label") == "R").alias("true_pos_rate"))
    return _round(out, 6, "pred_pos_rate", "true_pos_rate")


@query
def target_correlation(spark, sf):
    li = table(spark, sf, "lineitem")
    out = evaluate.target_correlation(li, ["l_quantity", "l_extendedprice", "l_discount"], F.col("l_returnflag") == "R", ["l_linestatus"])
    return _round(out, 6, "corr")


@query
def seed_summary(spark, sf):
    e = table(spark, sf, "events").groupBy("event_type", (F.col("event_id") % 5).alias("seed")).agg(F.avg("value").alias("score"))
    return _round(evaluate.seed_summary(e, ["event_type"], ["score"]), 6, "score_mean", "score_std")


def _pairs(spark, sf):
    return evaluate.pair_up(inputs.ablation(spark, sf), ["text_id"], "method", "click", "view", "score")


@query
def paired_ttest(spark, sf):
    return _round(evaluate.paired_ttest(_pairs(spark, sf)).select("n", "mean_diff", "t"), 6, "mean_diff", "t")


@query
def wilcoxon(spark, sf):
    return _round(evaluate.wilcoxon(_pairs(spark, sf)).select("n", "w_plus", "w_minus", "statistic"), 3, "w_plus", "w_minus", "statistic")


@query
def paired_pvalues(spark, sf):
    t = evaluate.paired_ttest(_pairs(spark, sf)).select(F.lit("t").alias("test"), "p")
    return t.unionByName(evaluate.wilcoxon(_pairs(spark, sf)).select(F.lit("wilcoxon").alias("test"), "p"))


@query
def ablation_summary(spark, sf):
    a = inputs.ablation(spark, sf).select("method", F.col("score").alias("latency_s"), (F.col("score") > 5).cast("double").alias("success_rate"), (F.col("score") / 100).alias("mean_rel_err"), (F.col("score") / 200).alias("std_rel_err"))
    return _round(evaluate.extraction_summary(a), 6, "mean_latency_s", "mean_success_rate", "mean_rel_err", "std_rel_err")


@query
def cost_latency_summary(spark, sf):
    out = evaluate.run_summary(inputs.call_log(spark, sf))
    return _round(out, 6, "mean_latency_s", "std_latency_s", "mean_cost_usd", "mean_prompt_tokens", "mean_completion_tokens")


@query
def token_savings(spark, sf):
    c = table(spark, sf, "conversations")
    words = F.size(F.split(F.trim("text"), "[ ]+"))
    s = c.groupBy("role").agg(F.sum(F.length("text")).alias("verbose_tokens"), F.sum(words).alias("short_tokens"))
    return _round(s.withColumn("reduction_pct", evaluate.token_savings(F.col("verbose_tokens"), F.col("short_tokens"))), 6, "reduction_pct")


def _quality_spec(spark, sf):
    q = inputs.quality(spark, sf).select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", " ")).cast("double").alias("n_words"), "lang",
        F.when(F.col("quality") == 1, "good").otherwise("bad").alias("verdict"),
    )
    return benchmark.DatasetSpec("documents", "text", q, "doc_id", ["n_chars", "n_words"], "verdict", ["lang"])


@query
def tstr_metrics(spark, sf):
    return benchmark.tstr(_quality_spec(spark, sf))


@query
def loop_gain(spark, sf):
    v, c, _ = inputs.merged_by_nation(spark, sf)
    return _round(benchmark.loop_gain(optimize.noise_grid(v, c, (0, 5))), 6, "mean_diff", "t", "p")


@query
def benchmark_gaps(spark, sf):
    return benchmark.gap_summary(benchmark.tstr(_quality_spec(spark, sf)))


@query
def correlation_retention(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.when(F.col("l_linestatus") == "F", "real").otherwise("later").alias("source"), "l_returnflag",
        F.col("l_quantity").cast("double").alias("l_quantity"), F.col("l_extendedprice").cast("double").alias("l_extendedprice"),
        F.col("l_discount").cast("double").alias("l_discount"),
    )
    discounted = F.col("l_discount") > 0.05
    kept = benchmark.correlation_retention(li, ["l_quantity", "l_extendedprice", "l_discount"], discounted)
    return _round(kept, 6, "corr", "real_corr").drop("retained")


@query
def score_gaps(spark, sf):
    """Kinds of events as sources, users as seeds: gap of each kind to clicks."""
    e = table(spark, sf, "events").groupBy((F.col("user_id") % 20).cast("int").alias("seed"), F.col("event_type").alias("source")).agg(
        F.avg("value").alias("f1"), F.avg((F.col("value") > 50).cast("double")).alias("pred_pos_rate"),
        F.avg((F.col("value") > 20).cast("double")).alias("true_pos_rate"), F.avg((F.col("value") > 80).cast("double")).alias("train_pos_prev"),
    )
    cells = e.withColumn("source", F.when(F.col("source") == "click", "real").otherwise(F.col("source"))).withColumn("dataset", F.lit("events"))
    out = benchmark.gap_summary(cells)
    return _round(out, 6, *[c for c in out.columns if c.endswith(("_mean", "_std"))])
