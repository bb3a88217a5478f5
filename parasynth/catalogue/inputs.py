"""Inputs the queries share, all derived from the given tables."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import merge, profile
from ..params import Parameters, load
from ..session import table

CONTINUOUS = ["l_quantity", "l_extendedprice"]


def lineitem_row(df: DataFrame) -> DataFrame:
    return df.withColumn("row_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))


def lineitem_profile(spark: SparkSession, sf: str) -> profile.Profile:
    return profile.profile_table(table(spark, sf, "lineitem"), CONTINUOUS, ["l_linestatus"], "l_returnflag")


def lineitem_parameters(spark: SparkSession, sf: str) -> Parameters:
    return load(*lineitem_profile(spark, sf))


def supplier_profile(spark: SparkSession, sf: str) -> profile.Profile:
    """One source per supplier."""
    return profile.profile_table(table(spark, sf, "lineitem"), CONTINUOUS, ["l_linestatus"], "l_returnflag", "l_suppkey")


def supplier_texts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.source_text(*supplier_profile(spark, sf))


def part_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Prose per part, in both keyword orders, with signs and exponents."""
    p = table(spark, sf, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("source_id"),
        F.concat(
            F.lit("For "), "p_name", F.lit(" the mean is "), F.format_string("%.2f", "p_retailprice"),
            F.lit(" and the standard deviation of "), F.col("p_size").cast("string"), F.lit("e-1 was found.\nHere SD = "),
            F.col("p_size").cast("string"), F.lit(".5, average: -"), F.col("p_partkey").cast("string"),
            F.lit(".\nThe correlation between size and price is 0."), (F.col("p_partkey") % 90 + 10).cast("string"),
            F.lit(" while corr(price, size) = -."), (F.col("p_partkey") % 9 + 1).cast("string"), F.lit(" elsewhere."),
        ).alias("text"),
    )


def part_replies(spark: SparkSession, sf: str) -> DataFrame:
    """JSON replies per part; every seventh has a bad number, every eleventh is cut off."""
    p = table(spark, sf, "part")
    std = F.when(F.col("p_partkey") % 7 == 0, F.lit('"about 3"')).otherwise(F.col("p_size").cast("string"))
    whole = F.concat(
        F.lit('{"variables": {"price": {"distribution": "'), F.when(F.col("p_partkey") % 2 == 0, "normal").otherwise("odd"),
        F.lit('", "mean": '), F.format_string("%.2f", "p_retailprice"), F.lit(', "std": '), std, F.lit(', "min": null}, "kind": '),
        F.lit('{"distribution": "categorical", "mean": null, "categories": {"small": '), F.col("p_size").cast("string"),
        F.lit(', "large": 10}}}, "correlations": {"k": {"var1": "price", "var2": "kind", "correlation": '),
        (F.col("p_size") / 20.0 - 1.0).cast("string"), F.lit("}}}"),
    )
    return p.select(
        F.col("p_partkey").cast("string").alias("source_id"),
        F.when(F.col("p_partkey") % 11 == 0, F.substring(whole, 1, 60)).otherwise(whole).alias("response_json"),
    )


def nation_members(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as sources, merged by nation in key order."""
    s = table(spark, sf, "supplier")
    return s.select(
        F.col("s_suppkey").cast("string").alias("source_id"), F.col("s_name").alias("source"),
        F.to_timestamp(F.lit("2026-01-01 00:00:00")).alias("extracted_at"), F.lit("regex_fallback").alias("extraction_method"),
        F.col("s_nationkey").cast("string").alias("merge_group"), F.col("s_suppkey").alias("source_pos"),
    )


def merged_by_nation(spark: SparkSession, sf: str, merge_categories: bool = False):
    v, c = supplier_profile(spark, sf)
    return merge.merge_parameters(v, c, nation_members(spark, sf), merge_categories=merge_categories)


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    kind = F.when(F.col("doc_id") % 4 == 0, ".pdf").otherwise(".html")
    return d.select("doc_id", F.concat(F.lit("doc://"), "source", F.lit("/"), F.col("doc_id").cast("string"), kind).alias("url"), "text")


def passage_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Each benchmark passage as a query, all of its words."""
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.lit(0).alias("query_pos"), F.col("text").alias("query"))


def asked_and_answered(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Every user turn as a query, and the turn after it as the reply."""
    c = table(spark, sf, "conversations")
    name = lambda turn: F.concat_ws("-", "conv_id", turn).alias("query_id")
    asked = c.filter("role = 'user'").select(name(F.col("turn")), F.col("text").alias("query"))
    return asked, c.filter("role <> 'user'").select(name(F.col("turn") - 1), F.col("text").alias("reply"))


def page_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as search results: site and path only, every third one a PDF."""
    clean = F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), r"^https?://[^.]+\.", "")
    p = table(spark, sf, "pages")
    return p.select(
        (F.col("page_id") % 3).cast("int").alias("query_pos"), F.col("page_id").cast("int").alias("result_pos"), "page_id",
        F.when(F.col("page_id") % 3 == 0, F.concat(clean, F.lit(".pdf"))).otherwise(clean).alias("url"),
    )


def judged_results(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Search hits per passage and a reply naming some positions."""
    from ..operators import discover

    hits = discover.search_corpus(passage_queries(spark, sf), corpus(spark, sf))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("source_type", "result_pos")) - 1
    results = hits.select("query_id", place.alias("result_pos"), "doc_id")
    replies = table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"),
        F.when(F.col("item_id") % 5 == 0, "None")
        .otherwise(F.concat(F.lit("Sources "), (F.col("item_id") % 4).cast("string"), F.lit(", 2 and 17 look best."))).alias("reply"),
    )
    return results, replies


def returns(spark: SparkSession, sf: str) -> DataFrame:
    """True flag and a rule's guess per line."""
    guess = F.when(F.col("l_discount") < 0.03, "A").when(F.col("l_quantity") > 30, "N").otherwise("R")
    return table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("label"), guess.alias("prediction"))


def quality(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "text")
    return d.join(table(spark, sf, "labels"), "doc_id")


def call_log(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(
        F.col("event_type").alias("provider"), F.concat(F.lit("m"), F.col("user_id") % 3).alias("model"),
        (F.col("value") / 10.0).alias("latency_s"), (F.col("value") / 1000.0).alias("cost_usd"),
        F.length("props").alias("prompt_tokens"), (F.col("event_id") % 50).alias("completion_tokens"),
    )


def ablation(spark: SparkSession, sf: str) -> DataFrame:
    """Events as scores: user = text, kind of event = method."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("text_id"), F.col("event_type").alias("method"), F.col("value").alias("score")
    )


def score_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("position"), F.col("value").alias("score")
    )
