"""Repeated passages beyond what is broadcast: brute force of the other way, and what the plan shuffles."""

import re

import pyarrow as pa
import pytest

from parasynth.llm import repeats


@pytest.mark.parametrize("many", [1_000, 1])
def test_repeats_deal_texts_out_once(spark, monkeypatch, many):
    """Beyond the spans that are broadcast, identifiers meet the texts already dealt out; texts are not shuffled again."""
    monkeypatch.setattr(repeats, "FEW_TEXTS", -1)
    monkeypatch.setattr(repeats, "MANY", many)
    passage = "".join(chr(97 + i * i % 23) for i in range(500))
    rows = [(i, f"{i} {passage[: 400 + i % 90]} {i * i}") for i in range(30)] + [(40 + i, "alone " * 20 + passage) for i in range(5)]
    rows += [(None, passage), (50, passage), (50, passage), (51, None), (52, "short"), (53, "".join(chr(0x100 + i * i % 977) for i in range(300)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = repeats.drop_repeats(df)
    monkeypatch.setattr(repeats, "FEW_TEXTS", 1_000)
    few = repeats.drop_repeats(df)
    assert sorted(map(str, made.collect())) == sorted(map(str, few.collect()))
    assert made.where("n_spans > 0").count() == 30 + 5 + 3 and made.count() == len(rows)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"MapInArrow run\([^)]*\)[^\[]*\[[^\]]*body#", plan), plan  # texts packed for another way


def test_spans_of_a_text_are_joined_up():
    lists = pa.array([[{"lo": 30, "hi": 31}, {"lo": 0, "hi": 5}, {"lo": 6, "hi": 6}, {"lo": 17, "hi": 19}], [{"lo": 2, "hi": 2}], [{"lo": 0, "hi": 90}, {"lo": 5, "hi": 6}, {"lo": 50, "hi": 95}]])
    got = repeats._joined_up(10)(pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([4, 5, 6]), lists], ["ka", "kb", "runs"]).slice(0))
    assert got["runs"].to_pylist() == [[{"lo": 0, "hi": 6}, {"lo": 17, "hi": 19}, {"lo": 30, "hi": 31}], [{"lo": 2, "hi": 2}], [{"lo": 0, "hi": 95}]]
    for own, runs in zip(lists.to_pylist(), got["runs"].to_pylist()):
        pairs = [[(r["lo"], r["hi"]) for r in x] for x in (own, runs)]
        assert repeats.removed(bytes(range(120)), pairs[0], 10) == repeats.removed(bytes(range(120)), pairs[1], 10)
