"""The five stages over a small corpus, each on what the one before kept; the library without this package."""

import importlib
import random
import sys

import corpus_pipeline
import pytest
from parasynth.llm import secrets, simhash
from parasynth.llm.queries import TOKENIZER
from tokenizers import Tokenizer

WORDS = [f"{a}{b}" for a in "bcdfgklmnprst" for b in ("a", "er", "on", "is", "um")]


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(3)
    where = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, f"{prose(rnd, 90)}\nRead more at page {i} of this site\n{prose(rnd, 60)}") for i in range(40)]
    rows += [(100, "too short"), (101, None), (102, "again and again " * 60)]  # base rules
    rows += [(200 + i, rows[0][1]) for i in range(3)]  # copies of document 0
    near = rows[1][1].split(" ")
    near[40] = "changed"
    rows += [(300, " ".join(near))]
    first, second = rows[5][1].split("\n")[::2]
    rest = lambda t: int(simhash.majority_bits(simhash.shingle_hashes(t, 4)))
    word = next(w for w in WORDS if 0 < (rest(f"{first} {w}\n{second} {w}") ^ rest(f"{first}\n{second}")).bit_count() <= 4)
    rows += [(301, f"{first} {word}\nRead more at page 5 of this site\n{second} {word}")]  # few bits apart once the middle line is gone
    rows += [(400, prose(rnd, 120) + " password=x9Kq+vB2zQ7 " + prose(rnd, 40)), (401, prose(rnd, 3000))]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    return where, dict(rows)


def test_stages(spark, folder):
    where, texts = folder
    docs = spark.read.parquet(f"{where}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, where)
        if name != "best_fit_packing":
            assert made.columns == docs.columns
            docs = spark.createDataFrame(made.collect(), made.schema)
            seen[name] = {r.doc_id: r for r in docs.collect()}
    assert set(texts) - set(seen["quality_rules"]) == {100, 101, 102}
    lines = seen["line_dedup"]
    assert "Read more" in lines[0].text and "Read more" not in lines[5].text and all(r.n_chars == len(r.text) for r in lines.values())
    assert lines[300].text.split("\n") == texts[300].split("\n")[:1]  # its second line is long and that of document 1
    assert set(lines) - set(seen["simhash_near_dedup"]) == {200, 201, 202, 301}
    assert "[SECRET]" in seen["secret_scan"][400].text and seen["secret_scan"][401].text == texts[401]
    tokenizer = Tokenizer.from_file(TOKENIZER[0])
    packed = corpus_pipeline.run(spark, where).toPandas()
    for i, r in seen["secret_scan"].items():
        assert packed[packed.doc_id == i].length.sum() == len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1
    assert set(packed.doc_id) == set(seen["secret_scan"]) and packed.groupby("sequence_id").length.sum().max() <= 1024


def test_empty_corpus(spark, folder, tmp_path):
    where, _ = folder
    docs = spark.read.parquet(f"{where}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, where)
        assert made.count() == 0
        if name != "best_fit_packing":
            assert made.columns == docs.columns


def test_library_without_this_package(monkeypatch):
    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name == "corpus_pipeline" or name.split(".")[:2] == ["parasynth", "llm"]:
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    for name in [n for n in sys.modules if n in ("corpus_pipeline", "__spark_entry__") or n.startswith("parasynth.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert "pipeline" not in names and not any(n.startswith("op") and n[2].isdigit() for n in names) and "merge_sources" in names
    monkeypatch.delitem(sys.modules, "__spark_entry__")


def test_secret_mark_is_no_secret():
    assert secrets.scan("password=[SECRET]", {}) == []
