"""Line dedup by log templates, in DataFrame operations only.

The tree has fixed depth: token count, then the leading tokens, tokens with a
digit being a variable field ``<*>``. A line's first template is itself with
those fields. Within a leaf other fields are generalised too: a place after
the leading tokens is constant if one token holds most lines of the leaf there,
else variable, and a line belongs to the leaf's template if enough of its
places hold the constants. Templates that recur across texts are dropped from
all of them but the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, sealed
from .common import checkpointed, text_key, texts

#: A template in this many different texts is dropped; a line's own one of LONG tokens or more already in LONG_DOCS.
MIN_DOCS, LONG, LONG_DOCS = 10, 20, 2
#: Leading tokens that choose a leaf, and the share of further places that must hold the leaf's constants.
DEPTH, SIMILARITY = 3, 0.6
#: A token (run of non-blanks) that holds a digit.
VARIABLE = r"(?<!\S)[^\s\d]*+\d\S*"


def _lines(docs: DataFrame, id_col: str, text_col: str, depth: int, longest: int | None = None) -> DataFrame:
    """Each line with a token (of ``longest`` characters at most): key of its text, number, tokens, leaf and template hash.

    Filters are on the plain line: one on its tokens would have them made twice.
    """
    key = text_key(F.col("text"))
    rows = texts(docs, id_col, text_col).select("doc_id", key["a"].alias("ka"), key["b"].alias("kb"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    rows = rows.where(F.col("line").rlike(r"\S"))
    if longest is not None:
        rows = rows.where(F.length("line") <= longest)
    masked = F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", VARIABLE, "<*>")).otherwise(F.col("line"))
    spaced = F.when(F.col("line").rlike(r"[\t\x0B\f\r]"), F.regexp_replace(masked, r"[\t\x0B\f\r]", " ")).otherwise(masked)
    rows = sealed(rows.select("doc_id", "ka", "kb", "line_no", F.length("line").alias("chars"), F.array_remove(F.split(spaced, " "), "").alias("tokens")))
    leaf = F.xxhash64(F.size("tokens"), *[F.get("tokens", F.lit(i)) for i in range(depth)])
    return rows.select("doc_id", "ka", "kb", "line_no", "chars", "tokens", leaf.alias("leaf"), F.xxhash64("tokens").alias("full"))


def _recurring(lines: DataFrame, by: str, min_docs: Column) -> DataFrame:
    """Templates in ``min_docs`` texts or more, with the text that keeps them: smallest identifier, then key.

    ``min_docs`` may depend on ``n``, the number of tokens.
    """
    once = lines.groupBy(by, "ka", "kb").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "ka", "kb"))
    found = once.groupBy(by).agg(F.count(F.lit(1)).alias("texts"), F.max("n").alias("n"), first.alias("first")).where(F.col("texts") >= min_docs)
    # Written down, so that a template of most lines is a join that Spark can split.
    return checkpointed(found.select(by, F.col("first.ka").alias("first_ka"), F.col("first.kb").alias("first_kb")))


def _marked(lines: DataFrame, by: str, min_docs: Column) -> DataFrame:
    elsewhere = (F.col("ka") != F.col("first_ka")) | (F.col("kb") != F.col("first_kb"))
    return lines.join(_recurring(lines, by, min_docs), by).where(elsewhere).select("ka", "kb", "line_no")


def _generalised(docs: DataFrame, lines: DataFrame, id_col: str, text_col: str, min_docs: int, depth: int, similarity: float) -> DataFrame:
    """Lines that belong to the template of their leaf, for leaves of several templates in enough texts."""
    leaves = lines.where(F.col("n") > depth).groupBy("leaf").agg(F.min("full").alias("least"), F.max("full").alias("most"), F.max("chars").alias("chars"), F.count(F.lit(1)).alias("n")).where((F.col("least") != F.col("most")) & (F.col("n") >= min_docs)).select("leaf", "chars")
    # Few leaves are left, and each row of them is one long: where a count bears that out, lines are filtered as they are read.
    leaves = checkpointed(leaves)
    longest = leaves.agg(F.max("chars")).first()[0] or 0
    rows = _lines(docs, id_col, text_col, depth, longest).where(F.size("tokens") > depth).join(broadcast_if_small(leaves.select("leaf")), "leaf", "left_semi")
    places = F.transform(F.slice("tokens", F.lit(depth + 1), F.size("tokens") - depth), lambda t: F.xxhash64(t))
    rows = checkpointed(rows.select("doc_id", "ka", "kb", "line_no", "leaf", places.alias("places")))
    votes = rows.select("leaf", F.posexplode("places").alias("at", "token")).groupBy("leaf", "at", "token").agg(F.count(F.lit(1)).alias("n"))
    fields = votes.groupBy("leaf", "at").agg(F.max_by("token", F.struct("n", "token")).alias("token"), (2 * F.max("n") > F.sum("n")).alias("constant"))
    constants = fields.groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("at", F.when(F.col("constant"), F.col("token")).alias("token")))).alias("constants"))
    held = F.size(F.filter("places", lambda t, i: F.coalesce(t == F.get(F.col("constants"), i)["token"], F.lit(False))))
    return rows.join(constants, "leaf").where(held >= F.lit(similarity) * F.size("places")).select("doc_id", "ka", "kb", "line_no", "leaf", F.size("places").alias("n"))


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, depth: int = DEPTH, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ka``, ``kb`` and ``dropped``, the sorted numbers (from 0) of a text's lines to drop; texts without any are left out.

    Equal texts count once, so copies of a document don't make its lines
    recur. A line of LONG tokens or more that is the same but for its variable
    fields in LONG_DOCS texts goes from all but the first. Counts are combined before each shuffle; a line in a third of all
    documents is one row from each task.
    """
    lines = checkpointed(_lines(docs, id_col, text_col, depth).select("doc_id", "ka", "kb", "line_no", "chars", "leaf", "full", F.size("tokens").alias("n")))
    general = _generalised(docs, lines, id_col, text_col, min_docs, depth, similarity)
    few = F.when(F.col("n") >= LONG, F.least(F.lit(LONG_DOCS), F.lit(min_docs))).otherwise(F.lit(min_docs))
    marked = _marked(lines, "full", few).unionAll(_marked(checkpointed(general), "leaf", F.lit(min_docs)))
    return marked.groupBy("ka", "kb").agg(F.array_sort(F.collect_set("line_no")).alias("dropped"))


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, depth: int = DEPTH, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text", counts: bool = False) -> DataFrame:
    """``docs`` without the lines of recurring templates, columns as they were; only ``text_col`` changes.

    ``counts`` adds ``n_lines`` and ``n_dropped``. Every row stays, also if no
    line does. A null text stays null; an empty one has no line with a token
    and stays. Blank lines are never dropped. Repeated rows are treated alike.
    """
    found = recurring_lines(docs, min_docs, depth, similarity, id_col, text_col)
    text = F.col(f"row.`{text_col}`").cast("string")
    key = text_key(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key["a"].alias("ka"), key["b"].alias("kb"))
    rows = rows.join(found, ["ka", "kb"], "left").select("row", "dropped", F.split(text, "\n").alias("lines"))
    before = lambda i: F.coalesce(F.get(F.col("dropped"), i - 1), F.lit(-1))
    after = lambda i: F.coalesce(F.get(F.col("dropped"), i), F.size("lines"))
    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("dropped")), lambda i: F.slice(F.col("lines"), before(i) + 2, after(i) - before(i) - 1)))
    new = F.when(F.col("dropped").isNull(), text).otherwise(F.array_join(kept, "\n"))
    more = [F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"), F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped")] if counts else []
    return rows.select(*[new.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns], *more)
