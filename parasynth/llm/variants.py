"""Spelling variants: words one edit apart, found level by level in a relational trie.

The words are the paths of a trie whose edges are a distributed table, and so
are the reversed words. Of two words one edit apart, either the first half of
the shorter or smaller one is untouched or the rest is, so a word enters the
frontier at the node where its untouched part ends, once in each direction.

The frontier holds states (word, position, node, edits). At each level it is
joined with the edges of that depth: a state without an edit follows its own
letter, or takes another edge as a replaced letter or as an inserted one; a
state with an edit follows its own letters only. A state with an edit that has
used up its word at the end of another word makes the two neighbours. Deletions
are the insertions seen from the other word, and a replacement is looked for
from the word with the smaller letter.

An edge knows the lengths of the words below it, the letters that follow, and
the hash of the only word below it if there is one: states that can't end are
not kept, and a state with one word below it is decided at once.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_folder
from .common import checkpointed, per_batch

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}
#: One run in so many loses a letter; code points of a word, and how often it must occur.
DAMAGE, LETTERS, LEAST = 97, 5, 3
#: A form is this many times as frequent as its variant.
RATIO = 2
#: Longest prefix that names its node itself; longer ones are named by their digest.
PLAIN = 48


def damaged(doc_id: int | None, run: str, one_in: int = DAMAGE) -> str:
    """``run``, lower-cased, without one letter if its checksum says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % one_in:
        return run
    return run[: (i := h % len(run))] + run[i + 1 :]


def words(docs: DataFrame, letters: int = LETTERS, least: int = LEAST, one_in: int = DAMAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word``, ``n``: words of ``letters`` code points or more that occur ``least`` times or more."""

    def work(batch: pa.RecordBatch) -> dict:
        found: Counter[str] = Counter()
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own: Counter[str] = Counter()
            for run, n in Counter(RUN.findall(text or "")).items():
                own[run.lower() if run.isascii() else run.translate(LOWER)] += n
            for run, n in own.items():
                if len(run) >= letters and len(word := damaged(doc_id, run, one_in)) >= letters:
                    found[word] += n
        return {"word": pa.array(list(found), pa.string()), "n": pa.array(list(found.values()), pa.int64())}

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return per_batch(rows, work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _key(prefix: Column) -> Column:
    return F.when(F.length(prefix) <= PLAIN, prefix).otherwise(F.concat(F.substring(prefix, 1, 16), F.lit("~"), F.md5(prefix)))


def _paths(known: DataFrame) -> DataFrame:
    """``side``, ``path``, ``start``: every word and the word reversed, and the length of the part that stays untouched."""
    half = F.floor(F.length("word") / 2).cast("int")
    ways = F.array(F.struct(F.lit(0).alias("side"), F.col("word").alias("path"), half.alias("start")), F.struct(F.lit(1).alias("side"), F.reverse("word").alias("path"), (F.length("word") - half).alias("start")))
    return known.select(F.inline(ways))


def _prefix(length: Column) -> Column:
    return F.substring("path", F.lit(1), length)


def _edges(paths: DataFrame, first: int) -> DataFrame:
    """The trie from prefixes of ``first`` letters on: ``depth``, ``side``, ``node``, ``c``, ``child``, and what is known of the words below the child."""
    p = F.col("p")
    steps = paths.select("side", "path", F.length("path").alias("size"), F.explode(F.sequence(F.lit(first), F.length("path"))).alias("p")).select(
        (p - 1).alias("depth"), "side", _key(_prefix(p - 1)).alias("node"), F.substring("path", p, F.lit(1)).alias("c"), _key(_prefix(p)).alias("child"),
        "size", (p == F.col("size")).alias("final"), F.xxhash64("path").alias("hash"),
    )
    edges = checkpointed(steps.groupBy("depth", "side", "node", "c", "child").agg(
        F.count(F.lit(1)).alias("below"), F.max("final").alias("final"), F.min("size").alias("shortest"), F.max("size").alias("longest"), F.max("hash").alias("only"),
    ))
    # A node has at most as many edges as there are letters.
    nodes = edges.groupBy("side", F.col("node").alias("child")).agg(F.concat_ws("", F.collect_list("c")).alias("follow"))
    return edges.join(nodes, ["side", "child"], "left").fillna({"follow": ""})


def _next_level(states: DataFrame, edges: DataFrame, depth: int) -> DataFrame:
    """States one edge further down, at nodes of ``depth`` + 1. A node with many states is a join that Spark splits."""
    at = lambda i: F.substring("path", i + 1, F.lit(1))
    i, same = F.col("i"), F.col("c") == at(F.col("i"))
    step = lambda i, edits: F.struct(i.alias("i"), F.lit(edits).alias("edits"))
    replaced = (F.col("c") > at(i)) & (i < F.length("path"))
    ways = (
        F.when(F.col("edits") == 1, F.array(step(i + 1, 1)))
        .when(same, F.array(step(i + 1, 0)))
        .when(replaced, F.array(step(i, 1), step(i + 1, 1)))
        .otherwise(F.array(step(i, 1)))
    )
    moved = states.join(edges.drop("depth"), ["side", "node"]).where((F.col("edits") == 0) | same)
    moved = moved.select("side", "path", "child", "below", "final", "shortest", "longest", "only", "follow", F.inline(ways))
    rest = F.length("path") - i
    found = (F.col("edits") == 1) & (rest == 0) & F.col("final")
    live = (rest > 0) & (F.instr("follow", at(i)) > 0) & (F.lit(depth + 1) + rest).between(F.col("shortest"), F.col("longest"))
    node = F.col("child")
    if depth + 1 <= PLAIN:
        whole = F.concat("child", F.substring("path", i + 1, F.greatest(rest, F.lit(0))))
        alone = F.col("below") == 1
        found |= (F.col("edits") == 1) & alone & (F.xxhash64(whole) == F.col("only"))
        live &= ~alone
        node = F.when(found, _key(whole)).otherwise(node)
    live = F.when(F.col("edits") == 0, F.col("below") > 1).otherwise(live)
    return moved.select("side", "path", "i", node.alias("node"), "edits", found.alias("found"), live.alias("live")).where("found OR live").drop("live")


def neighbours(known: DataFrame, letters: int = LETTERS) -> DataFrame:
    """``word``, ``near``: pairs of different words of the column ``word`` that are one edit apart, both ways round.

    ``letters`` is the least length of a word. There are about as many levels
    as the longest prefix that two paths share has letters.
    """
    spark = known.sparkSession
    folder = f"{checkpoint_folder(spark)}/variants-{uuid.uuid4().hex}"
    paths = checkpointed(_paths(known))
    _edges(paths, letters // 2).hint("rebalance", "depth").write.partitionBy("depth").parquet(f"{folder}/edges")
    edges = spark.read.schema(EDGES).parquet(f"{folder}/edges")
    shared = edges.where("below > 1").select("side", F.col("child").alias("node"))
    entering = paths.withColumn("node", _key(_prefix(F.col("start")))).join(shared, ["side", "node"])
    entering = entering.select("start", "side", "path", F.col("start").alias("i"), "node", F.lit(0).alias("edits"))
    entering.hint("rebalance", "start").write.partitionBy("start").parquet(f"{folder}/entering")
    entering = spark.read.schema(STATES + ", start int").parquet(f"{folder}/entering")
    levels = sorted(r["start"] for r in entering.select("start").distinct().collect())  # one per length
    states, depth = None, 0
    while levels or states is not None:
        depth = levels[0] if states is None else depth
        if levels and levels[0] == depth:
            new = entering.where(F.col("start") == levels.pop(0)).drop("start")
            states = new if states is None else states.unionByName(new)
        path = f"{folder}/states/level={depth + 1}"
        _next_level(states, edges.where(F.col("depth") == depth), depth).write.parquet(path)
        states = spark.read.schema(STATES + ", found boolean").parquet(path).where("NOT found").drop("found")
        states = None if states.isEmpty() else states
        depth += 1
    if not depth:
        return spark.createDataFrame([], "word string, near string")
    found = spark.read.schema(STATES + ", found boolean").parquet(f"{folder}/states").where("found").select("side", "path", "node")
    ends = paths.select("side", _key(F.col("path")).alias("node"), F.col("path").alias("near"))
    forward = lambda c: F.when(F.col("side") == 0, F.col(c)).otherwise(F.reverse(c)).alias(c)
    pairs = found.join(ends, ["side", "node"]).select(forward("path"), forward("near"))
    both = F.array(F.struct(F.col("path").alias("word"), F.col("near").alias("near")), F.struct(F.col("near").alias("word"), F.col("path").alias("near")))
    return pairs.select(F.inline(both)).distinct()


EDGES = "side int, child string, node string, c string, below long, final boolean, shortest int, longest int, only long, follow string, depth int"
STATES = "side int, path string, i int, node string, edits int"


def _roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` of ``word``, ``form``: each round doubles how far a root is followed. Forms at least double ``n``, so rounds are few."""
    made = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        further = made.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = checkpointed(made.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        made = step.select("word", "root")
        if step.where("moved").isEmpty():
            return made


def group_variants(docs: DataFrame, letters: int = LETTERS, least: int = LEAST, one_in: int = DAMAGE, ratio: int = RATIO, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``: one row per word.

    ``form`` is the most frequent word one inserted, deleted or replaced code
    point away (of ties the first in code-point order), if it is ``ratio`` times
    as frequent; ``root`` is the last of the forms that follow, the word itself
    if there are none. Null and empty texts have no words; a null identifier is
    an empty one in the checksum; repeated rows count each time; a very long
    text is counted whole and a very long word is a path like any other. An
    empty table gives no rows. Other columns aren't read.
    """
    if letters < 2:
        raise ValueError("a word has two letters or more")
    known = checkpointed(words(docs, letters, least, one_in, id_col, text_col))
    pairs = neighbours(known, letters).join(known.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    out = checkpointed(known.join(best, "word", "left"))
    often = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    out = out.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(often, F.col("best.near")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n"))
    roots = _roots(out.where("form IS NOT NULL"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
