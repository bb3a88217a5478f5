"""Finding sources in a corpus: query expansion, search, choice."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv
from ..session import written
from . import postings

TERM = r"[a-z0-9]+"
#: Share of the documents, those with most terms, that say how many hits a query's last result has at least; about so many of each kind or more.
SHARE, BROAD = 0.01, 256


def expand_queries(queries: DataFrame, replies: DataFrame, most: int = fv.MAX_EXPANDED_QUERIES) -> DataFrame:
    """(query_id, query_pos, query): the query, then up to ``most`` reply lines."""
    lines = F.filter(F.transform(F.split("reply", "\n"), lambda x: F.trim(x, F.lit(" \t\r\f\u000b"))), lambda x: x != "")
    joined = queries.select("query_id", "query").join(replies.select("query_id", "reply"), "query_id", "left")
    extra = F.coalesce(F.slice(lines, 1, most), F.array().cast("array<string>"))
    return joined.select("query_id", F.posexplode(F.concat(F.array("query"), extra)).alias("query_pos", "query"))


def is_pdf(url: Column) -> Column:
    return url.endswith(".pdf")


def classify_sources(df: DataFrame) -> DataFrame:
    """Add ``source_type`` and the constant ``relevance_score`` of that kind."""
    pdf = is_pdf(F.col("url"))
    return df.withColumns({
        "source_type": F.when(pdf, "pdf").otherwise("html"),
        "relevance_score": F.when(pdf, fv.RELEVANCE["pdf"]).otherwise(fv.RELEVANCE["html"]),
    })


def terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def search_corpus(queries: DataFrame, corpus: DataFrame, max_results: int = fv.MAX_RESULTS_PER_KIND) -> DataFrame:
    """Best pages and PDF documents per query, by distinct query terms found.

    ``queries``: query_id, query_pos, query.  ``corpus``: doc_id, url, text.
    Blocks of queries meet blocks of documents without a shuffle, and a pair of
    blocks hands on the results that can be among a query's best: those with as
    many hits as its last result has among the documents of most terms, which
    all queries meet first.
    """
    keys, ids = ["query_id", "query_pos"], ["doc_id", "url"]
    hashed = lambda text: F.transform(terms(F.col(text)), lambda t: F.xxhash64(t)).alias("terms")
    posted = corpus.select(*ids, F.coalesce(is_pdf(F.col("url")), F.lit(False)).alias("pdf"), _place(corpus, "doc_id").alias("place"), hashed("text"))
    n = corpus.count()
    share = min(1.0, max(SHARE, 2 * BROAD / max(1, n)))
    places = T.ArrayType(T.LongType())
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("pdf", T.BooleanType()), T.StructField("ids", T.ArrayType(posted.select(*ids).schema)),
        T.StructField("places", places), T.StructField("body", T.BinaryType()), T.StructField("long_places", places), T.StructField("long", T.BinaryType()),
    ])
    documents = written(_together(posted, n, ids, ["pdf"]).mapInArrow(postings.document_blocks(ids, share), schema))
    wanted = queries.select(*keys, hashed("query"))
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("queries", T.ArrayType(wanted.select(*keys).schema)), T.StructField("body", T.BinaryType())])
    asked = written(_together(wanted, queries.count(), keys).mapInArrow(postings.query_blocks(keys), schema))
    asked = written(_with_least(asked, documents, max_results, max(1, -(-int(n * share) // postings.LONG))), batch=1)
    pairs = asked.withColumnsRenamed({"block": "asking", "body": "asked"}).hint("shuffle_replicate_nl").crossJoin(documents.drop("long_places", "long"))
    schema = T.StructType([
        T.StructField("query", wanted.select(*keys).schema), T.StructField("document", posted.select(*ids).schema), T.StructField("hits", T.LongType()),
    ])
    # Written down, as callers read the results more than once.
    hits = written(pairs.mapInArrow(postings.met(max_results, "doc_id"), schema), batch=1).select("query.*", "document.*", "hits")
    typed = classify_sources(hits)
    best = Window.partitionBy(*keys, "source_type").orderBy(F.col("hits").desc(), "doc_id")
    # The filter is on the bare row number, which Spark then also applies before the shuffle.
    ranked = typed.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= max_results)
    return ranked.withColumn("result_pos", F.col("nth") - 1).drop("nth")


def _together(rows: DataFrame, n: int, keys: list[str], kind: Sequence[str] = ()) -> DataFrame:
    """Rows of equal keys next to each other, sorted, in no more partitions than ``n`` rows make blocks."""
    return rows.repartition(*keys).coalesce(max(1, -(-n // postings.ROWS))).sortWithinPartitions(*kind, *keys)


def _place(df: DataFrame, name: str) -> Column:
    """A number that never falls along the order of a column; the same everywhere for types it isn't made for."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.coalesce(F.col(name).cast("long"), F.lit(-(2**63)))
    if kind == T.StringType():
        return F.coalesce(F.conv(F.rpad(F.hex(F.substring(F.col(name).cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long"), F.lit(-1))
    return F.lit(0).cast("long")


def _with_least(asked: DataFrame, documents: DataFrame, k: int, blocks: int) -> DataFrame:
    """Add to blocks of queries what a query's k-th best among the long documents has; these are put together in ``blocks`` partitions or fewer."""
    schema = T.StructType([documents.schema[c] for c in ("pdf", "long_places", "long")])
    long = written(documents.select(*schema.names).coalesce(blocks).mapInArrow(postings.long_blocks, schema))
    pairs = asked.select("block", F.size("queries").cast("long").alias("n"), F.col("body").alias("asked")).hint("shuffle_replicate_nl").crossJoin(long)
    best = pairs.mapInArrow(postings.best_long(k), "block long, pdf boolean, hits binary, places binary")
    best = best.groupBy("block").agg(F.collect_list(F.struct("pdf", "hits", "places")).alias("best"))
    bounds = [T.StructField(f"{c}_{kind}", T.ArrayType(T.LongType())) for kind in ("pdf", "html") for c in ("least", "last")]
    return asked.join(best, "block", "left").select(*asked.columns, "best").mapInArrow(postings.with_least(k), T.StructType([*asked.schema, *bounds]))


def dedup_sources(results: DataFrame) -> DataFrame:
    """First result per URL in (query_pos, result_pos) order.

    A map-side combined minimum, so an URL found everywhere is one row early.
    """
    rest = [c for c in results.columns if c not in ("url", "query_pos", "result_pos")]
    first = F.min_by(F.struct("query_pos", "result_pos", *rest), F.struct("query_pos", "result_pos"))
    return results.groupBy("url").agg(first.alias("s")).select("s.*", "url").select(*results.columns)


def suggested_indices(reply: Column, n: Column) -> Column:
    """Whole numbers in a reply that are valid positions; order and repeats kept."""
    found = F.transform(F.regexp_extract_all(reply, F.lit(r"\d+"), F.lit(0)), lambda x: x.try_cast("int"))
    nothing = reply.isNull() | (F.trim(reply) == "") | (F.lower(F.trim(reply)) == "none")
    return F.when(nothing, F.array().cast("array<int>")).otherwise(F.filter(found, lambda i: (i >= 0) & (i < n)))


def suggest_sources(results: DataFrame, replies: DataFrame) -> DataFrame:
    """Add ``suggested`` to (query_id, result_pos, ...) from a reply per query."""
    sizes = results.groupBy("query_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    picked = replies.join(sizes, "query_id").select("query_id", F.explode(suggested_indices(F.col("reply"), F.col("n"))).alias("result_pos"))
    picked = picked.distinct().withColumn("suggested", F.lit(True))
    return results.join(picked, ["query_id", "result_pos"], "left").withColumn("suggested", F.coalesce("suggested", F.lit(False)))


def select_sources(results: DataFrame, use_suggested: bool) -> DataFrame:
    """The suggested sources, or by default the first one of each query."""
    return results.filter(F.col("suggested") if use_suggested else F.col("result_pos") == 0)


def run_discovery(queries: DataFrame, replies: DataFrame, corpus: DataFrame, max_results: int = fv.MAX_RESULTS_PER_KIND) -> DataFrame:
    """Expand the queries, search for each, and keep the first result per URL."""
    found = search_corpus(expand_queries(queries, replies), corpus, max_results)
    numbered = found.withColumn("query_pos", F.struct("query_id", "query_pos")).withColumn("result_pos", F.struct("source_type", "result_pos"))
    first = dedup_sources(numbered)
    return first.select("query_pos.query_id", "query_pos.query_pos", "result_pos.result_pos", "doc_id", "url", "hits", "source_type", "relevance_score")
