"""Search in blocks against brute force, and what it hands on."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parasynth.operators import discover, postings


def _brute(queries, corpus, k):
    asked, texts = defaultdict(Counter), defaultdict(Counter)
    for query_id, query_pos, query in queries:
        asked[query_id, query_pos].update(set(re.findall("[a-z0-9]+", (query or "").lower())))
    for doc_id, url, text in corpus:
        texts[doc_id, url].update(set(re.findall("[a-z0-9]+", (text or "").lower())))
    out = set()
    for key, q in asked.items():
        for pdf in (True, False):
            hits = [(-sum(n * d[t] for t, n in q.items()), doc) for doc, d in texts.items() if bool(doc[1] and doc[1].endswith(".pdf")) == pdf]
            hits = sorted((h for h in hits if h[0]), key=lambda h: (h[0], h[1][0] is not None, h[1][0] or 0))[:k]
            out |= {(*key, *doc, -h, "pdf" if pdf else "html", i) for i, (h, doc) in enumerate(hits)}
    return out


def _tables(seed, docs=120, asked=50):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    text = lambda n: " ".join(words[int(200 * draw.random() ** 3)] for _ in range(n))
    corpus = [(i, f"u{i}.{'pdf' if i % 4 == 0 else 'html'}", text(draw.randint(0, 150))) for i in range(docs)]
    corpus += [*corpus[5:9], corpus[8], (None, None, text(40)), (None, None, text(90)), (docs, "empty", None), (docs + 1, None, text(60))]
    queries = [(f"q{i // 3}", i % 3, text(draw.randint(0, 40))) for i in range(asked)]
    queries += [*queries[:4], queries[0], (None, 0, text(12)), (None, 0, text(30)), ("none", 0, None), ("other", 0, "not there")]
    draw.shuffle(corpus), draw.shuffle(queries)
    return queries, corpus


@pytest.mark.parametrize("rows,broad", [(8_192, 256), (16, 6), (7, 1)])
def test_search_gives_the_best_whatever_the_blocks(spark, monkeypatch, rows, broad):
    monkeypatch.setattr(postings, "ROWS", rows)  # on the driver: so many partitions
    monkeypatch.setattr(discover, "BROAD", broad)
    queries, corpus = _tables(rows)
    found = discover.search_corpus(
        spark.createDataFrame(queries, "query_id string, query_pos int, query string"), spark.createDataFrame(corpus, "doc_id long, url string, text string"), 3
    )
    got = found.select("query_id", "query_pos", "doc_id", "url", "hits", "source_type", "result_pos").collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == _brute(queries, corpus, 3)


@pytest.mark.parametrize("at_once", [1, 60, 4_000_000])
def test_blocks_that_meet_in_parts(monkeypatch, at_once):
    monkeypatch.setattr(postings, "AT_ONCE", at_once), monkeypatch.setattr(postings, "ROWS", 40)
    draw = np.random.default_rng(at_once)
    words = lambda: pa.array([(200 * draw.random(draw.integers(0, 60)) ** 3).astype(np.int64) for _ in range(90)], pa.list_(pa.int64()))
    batches = lambda: [pa.RecordBatch.from_arrays([pa.array(np.sort(draw.integers(0, 70, 90)) + 100 * i), words()], ["id", "terms"]) for i in range(2)]
    asked, docs = ([(len(head), row, term) for _, head, row, term in postings.grouped(iter(batches()), ["id"])] for _ in range(2))
    assert len(asked) > 2 and all(n <= 40 for n, _, _ in asked)
    for n, row, term in asked:
        q = postings.Queries(postings.query_body(row, term), n)
        for m, drow, dterm in docs:
            d = postings.Documents(postings.document_body(drow, dterm), m)
            want = np.array([[(term[row == i][:, None] == dterm[drow == j]).sum() for j in range(m)] for i in range(n)])
            assert (q.all_hits(d) == want).all()
            part = np.sort(draw.permutation(m)[:5])
            assert (q.all_hits(postings.Documents(d.only(part), 5)) == want[:, part]).all()
            least = np.sort(want, axis=1)[:, -5]  # of the fifth best
            got = list(zip(*(x.tolist() for x in q.best(d, least, 4))))
            best = [(i, j, want[i, j]) for i in range(n) for j in sorted(range(m), key=lambda j: (-want[i, j], j))[:4] if want[i, j] >= max(1, least[i])]
            assert got == best


def test_pairs_of_common_terms_stay_in_their_block(spark):
    """Every query shares terms with every document; what goes on is bounded by the queries."""
    common = " ".join(f"c{i}" for i in range(20))
    queries = spark.range(300).select(F.col("id").alias("query_id"), F.lit(0).alias("query_pos"), F.concat(F.lit(common), F.lit(" r"), "id").alias("query"))
    corpus = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat("id", F.lit(".html")).alias("url"), F.concat(F.lit(common), F.lit(" r"), F.col("id") % 300).alias("text"))
    found = discover.search_corpus(queries, corpus)
    files = found.inputFiles()
    assert files and spark.read.parquet(*files).count() <= 300 * 5 * 2
    assert found.filter("hits = 21").count() == 1500 and found.count() == 1500


def test_search_without_rows(spark):
    queries = spark.createDataFrame([], "query_id string, query_pos int, query string")
    corpus = spark.createDataFrame([(1, "a", "x y")], "doc_id long, url string, text string")
    assert discover.search_corpus(queries, corpus).count() == 0
    asked = spark.createDataFrame([("q", 0, "x")], "query_id string, query_pos int, query string")
    assert discover.search_corpus(asked, corpus.limit(0)).count() == 0
    assert discover.search_corpus(asked, corpus).count() == 1


def test_results_read_twice_are_searched_once(spark, tmp_path):
    corpus = spark.createDataFrame([(i, f"{i}.html", f"x y{i % 3}") for i in range(9)], "doc_id long, url string, text string")
    corpus.write.parquet(str(tmp_path / "corpus"))
    queries = spark.createDataFrame([(7, 0, "x y1")], "query_id long, query_pos int, query string")
    results = discover.search_corpus(queries, spark.read.parquet(str(tmp_path / "corpus"))).select("query_id", "result_pos", "doc_id")
    marked = discover.suggest_sources(results, spark.createDataFrame([(7, "0 and 4")], "query_id long, reply string"))
    assert not [f for f in marked.inputFiles() if str(tmp_path) in f]
    assert sorted((r.doc_id, r.suggested) for r in marked.collect()) == [(0, False), (1, True), (2, True), (4, False), (7, False)]


def test_only_postings_that_can_matter_are_put_together(monkeypatch):
    """A result needs 39 of 41 terms that few documents have: the postings of a few of these are read, not of all."""
    docs = np.arange(3_000)
    row = np.concatenate([np.repeat(docs, 40), [5]])
    term = np.concatenate([(np.arange(40) + 40 * (docs[:, None] // 60)).ravel(), [-1]])
    d = postings.Documents(postings.document_body(row, term), len(docs))
    asked = np.append(np.arange(40), -1)
    q = postings.Queries(postings.query_body(np.zeros(41, np.int64), asked), 1)
    read, ranges = [], postings.ranges
    monkeypatch.setattr(postings, "ranges", lambda first, number: (read.append(int(number.sum())), ranges(first, number))[1])
    got = [x.tolist() for x in q.best(d, np.array([39]), 5)]
    assert got == [[0] * 5, [5, 0, 1, 2, 3], [41, 40, 40, 40, 40]]
    d.there
    read.clear()
    q.best(d, np.array([39]), 5)
    assert sum(read) < 10 * 60


def test_later_documents_of_equal_hits_need_one_more(monkeypatch):
    draw = np.random.default_rng(3)
    for seed in range(6):
        monkeypatch.setattr(postings, "AT_ONCE", [7, 300, 1_000_000][seed % 3])
        row, term = np.repeat(np.arange(150), 12), (60 * draw.random(1_800) ** 2).astype(np.int64)
        d = postings.Documents(postings.document_body(row, term if seed > 2 else term + np.tile(np.arange(12), 150) * 60), 150)
        rows, asked = np.repeat(np.arange(40), 9), (60 * draw.random(360) ** 2).astype(np.int64) + 60 * (seed <= 2) * np.tile(np.arange(9), 40)
        q = postings.Queries(postings.query_body(rows, asked), 40)
        hits = q.all_hits(d)
        best = [sorted(range(150), key=lambda j: (-hits[i, j], j)) for i in range(40)]
        for nth in (0, 3, 8):  # what is known: a result at least as good as the nth
            least = np.array([hits[i, best[i][nth]] for i in range(40)]).astype(int)
            until = np.array([best[i][nth] + 1 for i in range(40)])
            got = list(zip(*(x.tolist() for x in q.best(d, least, 4, until))))
            assert got == [(i, j, hits[i, j]) for i in range(40) for j in best[i][: min(4, nth + 1)] if hits[i, j]]
        top, places = q.most_hits(d, np.arange(150) // 2, 4)
        got = [sorted(zip((-t).tolist(), p.tolist())) for t, p in zip(top, places)]
        assert got == [[(-int(hits[i, j]), j // 2) for j in b[:4]] for i, b in enumerate(best)]


def test_order_of_equal_hits_by_names(spark, monkeypatch):
    """Identifiers that are strings, some equal in their first bytes, and documents in many blocks."""
    monkeypatch.setattr(postings, "ROWS", 5), monkeypatch.setattr(discover, "BROAD", 2)
    names = [None, "", "a", "a\0", "ab", "Zz", "é", "中文字", *(f"document-{i}" for i in range(30))]
    corpus = [(x, f"{i}.html", " ".join(f"t{j}" for j in range(4) if i % (j + 1) == 0)) for i, x in enumerate(names)]
    queries = [("q", i, " ".join(f"t{j}" for j in range(i + 1))) for i in range(4)]
    key = lambda x: (x is not None, (x or "").encode())
    found = discover.search_corpus(spark.createDataFrame(queries, "query_id string, query_pos int, query string"), spark.createDataFrame(corpus, "doc_id string, url string, text string"), 3)
    got = [(r.query_pos, r.result_pos, r.doc_id, r.hits) for r in found.orderBy("query_pos", "result_pos").collect()]
    want = []
    for _, pos, text in queries:
        hits = sorted(((-len(set(text.split()) & set(t.split())), key(x), x) for x, _, t in corpus), key=lambda h: h[:2])
        want += [(pos, i, x, -h) for i, (h, _, x) in enumerate([h for h in hits if h[0]][:3])]
    assert got == want
