"""Extraction, coercion and merging on literal inputs."""

import pytest
from pyspark.sql import functions as F

from parasynth import schemas
from parasynth.functions.text import fixed4
from parasynth.operators import extract, merge, profile
from parasynth.sources import files


def texts(spark, *rows):
    return spark.createDataFrame(list(rows), "source_id string, text string")


def read(spark, text):
    v, c = extract.extract_regex(texts(spark, ("t", text)))
    return v.orderBy("var_pos").collect(), c.orderBy("corr_pos").collect()


@pytest.mark.parametrize("text,expected", [
    ("The mean is 10.5 and the standard deviation is 2.1.", [("var_1", 10.5, 2.1)]),
    ("mean = -5.3 and std = 1.2e-1 in the sample.", [("var_1", -5.3, 0.12)]),
    ("SD = 1.2, mean = 3.5", [("var_1", 3.5, 1.2)]),
    ("mean 1 std 2. Again mean 1 std 2.", [("var_1", 1.0, 2.0)]),
    ("Μ 5 Σ 6", [("var_1", 5.0, 6.0)]),
    ("μ = ٣ and σ = 2", [("var_1", 3.0, 2.0)]),
    ("nothing to see", []),
])
def test_mean_std(spark, text, expected):
    assert [(r.name, r["mean"], r["std"]) for r in read(spark, text)[0]] == expected


def test_categories_keep_order_and_need_two(spark):
    text = (
        "The categorical variable m takes value 'z' with probability 0.5, 'a' with probability 0.3, and 'k' with probability 0.2. "
        "The categorical variable lone takes value 'x' with probability 0.9. "
        "The categorical variable r takes value 'x' with probability 0.2, 'y' with probability 0.2 and 'x' with probability 0.6."
    )
    v, _ = read(spark, text)
    assert [r.name for r in v] == ["m", "r"]
    assert [c.label for c in v[0].categories] == ["z", "a", "k"]
    assert [(c.label, round(c.prob, 6)) for c in v[1].categories] == [("x", 0.75), ("y", 0.25)]


def test_very_long_category_list(spark):
    pairs = ", ".join(f"'l{i}' with probability 0.1" for i in range(20000))
    v, _ = read(spark, f"categorical variable n takes value {pairs}")
    assert len(v[0].categories) == 20000


def test_correlations_first_key_wins(spark):
    _, c = read(spark, "correlation between income and age is 0.65 overall; corr(income, age) = 0.1; corr(a, b) = -.4")
    assert [(r.key, r.correlation, r.direction) for r in c] == [("income__age", 0.65, "positive"), ("a__b", -0.4, "negative")]


def test_replies(spark):
    replies = spark.createDataFrame([
        ("ok", '{"variables":{"x":{"distribution":"normal","mean":5.0,"std":2.0}},"correlations":{"k":{"var1":"x","var2":"y","correlation":5.0}}}'),
        ("odd", '{"variables":{"v":{"distribution":"weird"},"g":{"distribution":"categorical","mean":null,"categories":{"b":3,"a":1}}}}'),
        ("bad", '{"variables":{"x":{"mean":"abc"}}}'), ("cut", '{"variables":{"x":{"mean":1'), ("none", "sorry"), ("empty", "{}"),
        ("null", '{"variables":null}'), ("list", "[1]"), ("half", '{"correlations":{"k":{"var1":"x"}}}'),
    ], "source_id string, response_json string")
    v, c, valid = extract.parse_responses(replies)
    assert {r.source_id for r in valid.filter("valid").collect()} == {"ok", "odd", "empty"}
    rows = {(r.source_id, r.name): r for r in v.collect()}
    assert rows["ok", "x"]["min"] == -1.0 and c.first().correlation == 1.0
    assert (rows["odd", "v"].distribution, rows["odd", "v"]["mean"], rows["odd", "v"]["std"]) == ("normal", 0.0, 1.0)
    assert [(x.label, x.prob) for x in rows["odd", "g"].categories] == [("b", 0.75), ("a", 0.25)]


def test_fallback(spark):
    t = texts(spark, ("a", "The mean is 10.5 and the standard deviation is 2.1."), ("b", "mean 1 std 2"))
    r = spark.createDataFrame([("a", "not json"), ("b", "{}")], "source_id string, response_json string")
    v, _, meta = extract.extract_parameters(t, r, "2026-01-01 00:00:00")
    assert {m.source_id: m.extraction_method for m in meta.collect()} == {"a": "regex_fallback", "b": "llm"}
    assert [x["mean"] for x in v.collect()] == [10.5]


def test_coercion(spark):
    df = spark.createDataFrame(
        [(1, float("nan")), (2, None), (3, 7.0), (4, -7.0), (5, 0.25)], "i int, correlation double"
    )
    got = [r.correlation for r in schemas.coerce_correlations(df).orderBy("i").collect()]
    assert got == [1.0, 0.0, 1.0, -1.0, 0.25]


def test_score_without_finds(spark):
    truth = spark.createDataFrame([("a", 0, 10.0, 2.0), ("a", 1, 50.0, 5.0)], "source_id string, var_pos bigint, mean double, std double")
    none = truth.filter("false")
    assert tuple(extract.score_extraction(none, truth).first()) == ("a", 0.0, None, None)
    found = spark.createDataFrame([("a", 0, 49.0, 5.0), ("a", 1, 10.0, 1.0)], truth.schema)
    row = extract.score_extraction(found, truth).first()
    assert row.success_rate == 1.0 and row.mean_rel_err == pytest.approx(0.01) and row.std_rel_err == pytest.approx(0.25)


def parameters(spark):
    shares = [("m", 0.5), ("f", 0.5)]
    v = spark.createDataFrame([
        ("s1", 0, "age", "normal", 30.0, 5.0, None, None, None), ("s1", 1, "sex", "categorical", 0.0, 1.0, None, None, shares),
        ("s2", 0, "age", "normal", 40.0, 7.0, None, None, None), ("s2", 1, "sex", "categorical", 0.0, 1.0, None, None, [("m", 0.1), ("x", 0.9)]),
        ("s3", 0, "sex", "categorical", 0.0, 1.0, None, None, shares),
    ], schemas.VARIABLES)
    c = spark.createDataFrame([("s1", 0, "c1", "a", "b", 0.6, "positive"), ("s2", 0, "c1", "a", "b", 0.8, "positive")], schemas.CORRELATIONS)
    meta = spark.createDataFrame([("s1", "A", "g", 0), ("s2", "B", "g", 1), ("s3", "C", "h", 0)], "source_id string, source string, merge_group string, source_pos int")
    return v, c, meta.withColumns({"extracted_at": F.to_timestamp(F.lit("2026-01-01")), "extraction_method": F.lit("regex_fallback")})


def test_merge(spark):
    v, c, meta = merge.merge_parameters(*parameters(spark))
    rows = {(r.source_id, r.name): r for r in v.collect()}
    assert (rows["g", "age"]["mean"], rows["g", "age"]["std"], rows["g", "age"]["max"]) == (35.0, 6.0, 53.0)
    assert rows["g", "sex"].distribution == "normal" and rows["h", "sex"].distribution == "categorical"
    assert c.first().correlation == pytest.approx(0.7)
    assert {m.source_id: m.source for m in meta.collect()} == {"g": "merged(A, B)", "h": "C"}
    v, _, _ = merge.merge_parameters(*parameters(spark), merge_categories=True)
    sex = v.filter("source_id = 'g' and name = 'sex'").first().categories
    assert [(x.label, round(x.prob, 6)) for x in sex] == [("m", 0.3), ("f", 0.25), ("x", 0.45)]


def test_parameters_json_reads_back(spark):
    import json

    v, c, meta = parameters(spark)
    docs = {r.source_id: json.loads(r.json) for r in files.parameters_json(v, c, meta).collect()}
    assert list(docs["s1"]["variables"]) == ["age", "sex"] and docs["s1"]["correlations"]["c1"]["correlation"] == 0.6
    assert docs["s1"]["variables"]["sex"]["categories"] == {"m": 0.5, "f": 0.5} and docs["s3"]["correlations"] == {}


def test_round_trip(spark):
    df = spark.range(1000).select(
        (20 + F.col("id") % 37 + F.when(F.col("id") % 3 == 0, 9.0).otherwise(0.0)).alias("age"),
        F.element_at(F.array(F.lit("m"), F.lit("n"), F.lit("p")), (F.col("id") % 3 + 1).cast("int")).alias("status"),
        F.when(F.col("id") % 5 < 2, "yes").otherwise("no").alias("outcome"),
    )
    v, c = profile.profile_table(df, ["age"], ["status"], "outcome")
    found, pairs = extract.extract_regex(profile.source_text(v, c))
    real = df.agg(F.avg("age"), F.stddev_samp("age")).first()
    rows = {r.name: r for r in found.collect()}
    assert rows["var_1"]["mean"] == pytest.approx(real[0], abs=1e-3) and rows["var_1"]["std"] == pytest.approx(real[1], abs=1e-3)
    assert [x.label for x in rows["status"].categories] == ["m", "n", "p"] and pairs.count() == 2


def test_formatting_matches_c_rounding(spark):
    values = [0.31875, 0.00005, 2.00005, -0.00001, 1 / 3, 12345678.00005, 0.5, 25.03125, -0.31875, 1e12]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(fixed4(F.col("x"))).collect()] == [f"{v:.4f}" for v in values]
