"""Summaries of vectors: sums of batches and of blocks against plain Python, and what the plan hands on."""

import math
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from parasynth.operators import synthesize, validate
from parasynth.params import Parameters, Variable

NAN = float("nan")
DECLARED = [("a", 0, "normal", 5.0), ("a", 1, "categorical", 0.0), ("a", 2, "normal", None), ("b", 0, "categorical", 0.0), ("b", 1, "normal", 1e6), ("c", 0, "normal", 0.0), ("d", 0, "normal", 0.0)]
VECTORS = [
    ("a", [1.5, 0.0, 3.0]), ("a", [2.5, 1.0, 3.0]), ("b", [2.0, 1000001.0, 9.0]), ("a", [None, 1.0, 3.0]), ("a", [4.0, None]), ("a", []), ("a", None), ("d", [None]),
    ("b", [0.0, 1000003.5]), ("b", [2.0, 1000002.0]), ("c", [NAN]), ("c", [1.0]), (None, [1.0]), ("z", [1.0]), ("a", [7.0, 70000.0, 3.0]), ("b", [1.0, 1000000.0]),
]
MIXED = Parameters(
    [Variable("n", "normal", 3.0, 2.0), Variable("c", "categorical", 0.0, 1.0, categories=[("x", 0.25), ("y", 0.75)]), Variable("u", "uniform", 0.0, 1.0, -1.0, 1.0)],
    [("n", "u", 0.5)],
)


def plain(rows, declared):
    values = defaultdict(list)
    for source, x in rows:
        for idx, value in enumerate(x or []):
            kind = next((d[2] for d in declared if d[:2] == (source, idx)), None)
            if kind:
                values[source, idx, int(value) if kind == "categorical" and value is not None else None].append(value)
    out = {}
    for key, all_values in values.items():
        seen = [v for v in all_values if v is not None]
        broken = any(map(math.isnan, seen))
        avg = NAN if broken else statistics.fmean(seen) if seen else None
        out[key] = (len(all_values), len(seen), avg, None if len(seen) < 2 else NAN if broken else statistics.stdev(seen))
    return out


def same(got, wanted):
    assert got.keys() == wanted.keys()
    for key, row in wanted.items():
        for a, b in zip(got[key], row, strict=True):
            assert a == b or (None not in (a, b) and a == pytest.approx(b, rel=1e-9, nan_ok=True)), key


def by_cell(df):
    return {(r["source_id"], r["idx"], r["code"]): (r["count"], r["seen"], r["avg"], r["std"]) for r in df.collect()}


@pytest.mark.parametrize("parts, broadcast", [(1, True), (5, True), (1, False)])
def test_summary_of_odd_vectors(spark, monkeypatch, parts, broadcast):
    if not broadcast:
        monkeypatch.setattr(validate, "broadcast_if_small", lambda df: df)
    v = spark.createDataFrame(DECLARED, "source_id string, idx int, distribution string, mean double")
    x = spark.createDataFrame(VECTORS * 3, "source_id string, x array<double>").repartition(parts)
    same(by_cell(validate.summary(x, v)), plain(VECTORS * 3, DECLARED))


@pytest.mark.parametrize("rows", [[(None, [1.0])] * 3, [("a", [])], [("a", None)], [], [("a", [None])]])
def test_batches_without_cells(spark, rows):
    v = spark.createDataFrame(DECLARED, "source_id string, idx int, distribution string, mean double")
    x = spark.createDataFrame(rows, "source_id string, x array<double>").coalesce(1)
    same(by_cell(validate.summary(x, v)), plain(rows, DECLARED))


def test_constant_has_no_deviation(spark):
    v = spark.createDataFrame([("a", 0, "normal", 1e9)], "source_id string, idx int, distribution string, mean double")
    x = spark.createDataFrame([("a", [0.1])] * 7, "source_id string, x array<double>").repartition(3)
    assert validate.summary(x, v).first()["std"] == 0.0


def test_drawn_rows_stay_in_their_tasks(spark):
    """A job over many sources moves some sums per block of rows, not a row per cell."""
    v, c = MIXED.tables(spark)
    more = lambda df: df.drop("source_id").crossJoin(spark.range(3).select(F.col("id").cast("string").alias("source_id")))
    v, c = more(v), more(c)
    x = synthesize.synthesize_many(v, c, 20_500)
    v = validate.cut_lineage(synthesize.indexed(v))
    rows = [(r["source_id"], r["x"]) for r in x.collect()]
    assert len(rows) == 3 * 20_500
    found = validate.summary(x, v)
    same(by_cell(found), plain(rows, [tuple(r) for r in v.select("source_id", "idx", "distribution").collect()]))
    same(by_cell(validate.summary(x.select("*"), v)), by_cell(found))  # the same rows as any other vectors
    few = by_cell(validate.summary(x.where("row_id < 100"), v))
    assert few["0", 0, None][0] == 100  # a selection is no longer what was drawn
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode(x" not in plan and plan.count("MapInArrow") == 1, plan
