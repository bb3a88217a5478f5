"""Texts and model replies to parameter tables.

Everything a text yields is computed inside its row with array functions, so
extraction over a corpus is map-only: no shuffle, no grouping, and a long text
costs only the task that holds it.
"""

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.arrays import bind, first_by_key, first_place_last_value
from ..schemas import (
    CATEGORIES,
    CORRELATION_COLUMNS,
    CORRELATION_FIELDS,
    VARIABLE_COLUMNS,
    VARIABLE_FIELDS,
    known_distribution,
    normalised,
    settled_distribution,
    valid_correlation,
)
from ..session import cut_lineage, sealed, spread
from . import clean

VARIABLE_ARRAY = f"array<struct<{VARIABLE_FIELDS.replace(' ', ':').replace(',:', ',')}>>"
CORRELATION_ARRAY = f"array<struct<{CORRELATION_FIELDS.replace(' ', ':').replace(',:', ',')}>>"


@cache
def _digit_alphabet() -> tuple[str, str]:
    """All decimal digits of all scripts (``\\d`` matches them) and their values."""
    foreign = [c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
    return "".join(foreign), "".join(str(unicodedata.digit(c)) for c in foreign)


def _number(text: Column) -> Column:
    ascii_only = F.when(text.rlike("^[\\x00-\\x7F]*$"), text).otherwise(F.translate(text, *_digit_alphabet()))
    return ascii_only.try_cast("double") + F.lit(0.0)  # -0.0 and 0.0 are one value


def _matches(text: Column, pattern: str, **groups: int) -> Column:
    """All matches as structs of the named groups.

    The long text is scanned once; groups are read from the short matches.
    """
    java = fv.JAVA_FLAGS + pattern
    found = F.regexp_extract_all(text, F.lit(java), F.lit(0))
    return F.transform(
        found, lambda m: F.struct(*[F.regexp_extract(m, java, i).alias(g) for g, i in groups.items()])
    )


def mean_std_pairs(text: Column) -> Column:
    """Distinct (mean, std) pairs: mean-first matches, then std-first ones."""
    found = F.concat(_matches(text, fv.MEAN_THEN_STD, mean=1, std=2), _matches(text, fv.STD_THEN_MEAN, mean=2, std=1))
    # Encoded as text so that array_distinct can hash: on structs it compares all pairs.
    encoded = F.array_distinct(
        F.transform(found, lambda p: F.concat_ws("|", _number(p["mean"]).cast("string"), _number(p["std"]).cast("string")))
    )
    split = lambda s, i: F.element_at(F.split(s, "\\|"), i).cast("double")
    return F.transform(encoded, lambda s: F.struct(split(s, 1).alias("mean"), split(s, 2).alias("std")))


def _continuous(pairs: Column) -> Column:
    spread = lambda p: p["std"] * fv.BOUND_STD
    return F.transform(
        pairs,
        lambda p, i: F.struct(
            F.concat(F.lit("var_"), (i + 1).cast("string")).alias("name"), F.lit("normal").alias("distribution"),
            p["mean"].alias("mean"), p["std"].alias("std"),
            (p["mean"] - spread(p)).alias("min"), (p["mean"] + spread(p)).alias("max"),
            F.lit(None).cast(CATEGORIES).alias("categories"),
        ),
    )


def categorical_runs(text: Column) -> Column:
    """array<struct<name, pairs>>: each described variable with its label run.

    The text is cut at the headers and each run is read by an anchored pattern
    one pair at a time; a nested repeat over the run would exhaust the JVM stack.
    """
    header = fv.JAVA_FLAGS + fv.CATEGORICAL_HEADER + f"(?={fv.CATEGORY_PAIR.replace('(', '(?:', 1).replace('+)', '+)', 1)})"
    anchored = fv.JAVA_FLAGS + r"\G" + fv.CATEGORY_PAIR + fv.CATEGORY_JOINER
    names = F.regexp_extract_all(text, F.lit(header), F.lit(1))
    pieces = F.split(text, header, -1)
    tails = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def pairs(tail):
        found = F.regexp_extract_all(tail, F.lit(anchored), F.lit(0))
        return F.transform(
            found,
            lambda m: F.struct(
                F.regexp_extract(m, anchored, 1).alias("label"), _number(F.regexp_extract(m, anchored, 2)).alias("prob")
            ),
        )

    return F.zip_with(names, tails, lambda n, t: F.struct(n.alias("name"), pairs(t).alias("pairs")))


def _categorical(runs: Column, n_continuous: Column) -> Column:
    numbered = lambda name: F.coalesce(
        name.rlike("^var_[1-9][0-9]*$") & (F.substring(name, 5, 18).try_cast("long") <= n_continuous), F.lit(False)
    )
    usable = F.filter(runs, lambda r: (F.size(r["pairs"]) >= 2) & ~numbered(r["name"]))

    def variable(r, categories):
        return F.struct(
            r["name"].alias("name"), settled_distribution(F.lit("categorical"), categories).alias("distribution"),
            F.lit(0.0).alias("mean"), F.lit(1.0).alias("std"), F.lit(None).cast("double").alias("min"),
            F.lit(None).cast("double").alias("max"), categories.alias("categories"),
        )

    shares = lambda r: normalised(first_place_last_value(r["pairs"], "label"))
    return F.transform(first_by_key(usable, "name"), lambda r: bind(shares(r), lambda categories: variable(r, categories)))


def _correlations(text: Column) -> Column:
    found = F.concat(
        _matches(text, fv.CORRELATION_NAMED, var1=1, var2=2, value=3),
        _matches(text, fv.CORRELATION_CALL, var1=1, var2=2, value=3),
    )
    keyed = F.transform(
        found,
        lambda c: F.struct(
            F.concat(c["var1"], F.lit("__"), c["var2"]).alias("key"), c["var1"].alias("var1"), c["var2"].alias("var2"),
            valid_correlation(_number(c["value"])).alias("correlation"),
            F.when(_number(c["value"]) >= 0, "positive").otherwise("negative").alias("direction"),
        ),
    )
    return first_by_key(keyed, "key")


def _regex_arrays(df: DataFrame) -> DataFrame:
    """Add ``found_variables`` and ``found_correlations`` from ``text``."""
    text = F.coalesce("text", F.lit(""))
    df = df.withColumns({"__pairs": mean_std_pairs(text), "__runs": categorical_runs(text)})
    df = df.withColumn(
        "found_variables",
        F.concat(_continuous(F.col("__pairs")), _categorical(F.col("__runs"), F.size("__pairs"))).cast(VARIABLE_ARRAY),
    )
    return df.withColumn("found_correlations", _correlations(text).cast(CORRELATION_ARRAY)).drop("__pairs", "__runs")


def _tables(nested: DataFrame) -> tuple[DataFrame, DataFrame]:
    nested = sealed(nested.select("source_id", "found_variables", "found_correlations"))
    variables = nested.select("source_id", F.posexplode("found_variables").alias("var_pos", "v")).select(
        "source_id", F.col("var_pos").cast("long"), *[f"v.{c}" for c in VARIABLE_COLUMNS]
    )
    correlations = nested.select("source_id", F.posexplode("found_correlations").alias("corr_pos", "c")).select(
        "source_id", F.col("corr_pos").cast("long"), *[f"c.{c}" for c in CORRELATION_COLUMNS]
    )
    return variables, correlations


def extract_regex(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(source_id, text) -> variables, correlations."""
    return _tables(_regex_arrays(spread(texts.select("source_id", "text"))))


# --- model replies ----------------------------------------------------------------

REPLY = "variables map<string,map<string,string>>, correlations map<string,map<string,string>>"
NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def _strict_number(text: Column) -> Column:
    return F.when(text.rlike(NUMBER_TEXT), F.trim(text).try_cast("double"))


def _entries(mapping: Column) -> Column:
    return first_place_last_value(F.coalesce(F.map_entries(mapping), F.array().cast("array<struct<key:string,value:map<string,string>>>")), "key")


def _reply_arrays(df: DataFrame) -> DataFrame:
    """Add ``reply_valid``, ``reply_variables``, ``reply_correlations``.

    A reply counts as a whole: one unreadable number makes all of it invalid.
    Values are read as text first, since reading them as numbers would turn a
    bad one into NULL unnoticed.
    """
    reply = F.col("response_json")
    df = df.withColumns({
        "__r": F.from_json(reply, REPLY), "__k": F.json_object_keys(reply),
        "__closed": F.coalesce(reply.rlike(r"(?s)^\s*\{.*\}\s*$"), F.lit(False)),
    })
    df = df.withColumns({"__v": _entries(F.col("__r.variables")), "__c": _entries(F.col("__r.correlations"))})
    optional = lambda m, f, default: F.coalesce(_strict_number(m[f]), F.lit(default))
    readable = lambda x: x.isNull() | _strict_number(x).isNotNull()
    nothing = lambda x: x.isNull() | x.isin("{}", "[]", "", "0", "0.0", "false")
    category_map = lambda x: F.coalesce(
        F.map_entries(F.from_json(x, "map<string,string>")), F.array().cast("array<struct<key:string,value:string>>")
    )

    def variable_ok(e):
        m = e["value"]
        shares = category_map(m["categories"])
        return (
            m.isNotNull() & readable(m["mean"]) & readable(m["std"]) & readable(m["min"]) & readable(m["max"])
            & (nothing(m["categories"]) | (
                m["categories"].startswith("{") & (F.size(shares) > 0)
                & F.forall(shares, lambda s: s["value"].isNotNull() & _strict_number(s["value"]).isNotNull())
            ))
        )

    def correlation_ok(e):
        m = e["value"]
        return (
            m.isNotNull() & m["var1"].isNotNull() & m["var2"].isNotNull()
            & (~F.map_contains_key(m, "correlation") | _strict_number(m["correlation"]).isNotNull())
            & (~F.map_contains_key(m, "direction") | m["direction"].isNotNull())
        )

    def variable(e):
        m = e["value"]
        mean, std = optional(m, "mean", 0.0), optional(m, "std", 1.0)
        shares = F.transform(
            first_place_last_value(category_map(m["categories"]), "key"),
            lambda s: F.struct(s["key"].alias("label"), _strict_number(s["value"]).alias("prob")),
        )
        categories = F.when(~nothing(m["categories"]), normalised(shares))
        named = F.when(F.map_contains_key(m, "distribution"), m["distribution"]).otherwise(F.lit("normal"))
        return F.struct(
            e["key"].alias("name"), settled_distribution(known_distribution(named), categories).alias("distribution"),
            mean.alias("mean"), std.alias("std"),
            F.coalesce(_strict_number(m["min"]), mean - std * fv.BOUND_STD).alias("min"),
            F.coalesce(_strict_number(m["max"]), mean + std * fv.BOUND_STD).alias("max"),
            categories.alias("categories"),
        )

    def correlation(e):
        m = e["value"]
        return F.struct(
            e["key"].alias("key"), m["var1"].alias("var1"), m["var2"].alias("var2"),
            valid_correlation(optional(m, "correlation", 0.0)).alias("correlation"),
            F.coalesce(m["direction"], F.lit("positive")).alias("direction"),
        )

    present = lambda part: ~F.array_contains("__k", part) | F.col(f"__r.{part}").isNotNull()
    valid = F.coalesce(
        F.col("__closed") & F.col("__k").isNotNull() & present("variables") & present("correlations")
        & F.forall("__v", variable_ok) & F.forall("__c", correlation_ok),
        F.lit(False),
    )
    df = df.withColumn("reply_valid", valid)
    return df.withColumns({
        "reply_variables": F.transform("__v", variable).cast(VARIABLE_ARRAY),
        "reply_correlations": F.transform("__c", correlation).cast(CORRELATION_ARRAY),
    }).drop("__r", "__k", "__closed", "__v", "__c")


def parse_responses(responses: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(source_id, response_json) -> variables, correlations, (source_id, valid)."""
    parsed = sealed(_reply_arrays(spread(responses.select("source_id", "response_json"))).drop("response_json"))
    good = parsed.filter("reply_valid").select(
        "source_id", F.col("reply_variables").alias("found_variables"), F.col("reply_correlations").alias("found_correlations")
    )
    return (*_tables(good), parsed.select("source_id", F.col("reply_valid").alias("valid")))


def extract_parameters(
    texts: DataFrame, responses: DataFrame | None = None, extracted_at: str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Variables, correlations and meta per source.

    A valid reply is used as it is, even when it names no variable; anything
    else falls back to reading the text.  ``responses`` holds at most one reply
    per source.
    """
    keep = ["source_id", "text"] + (["source"] if "source" in texts.columns else [])
    df = spread(texts.select(*keep))
    if "source" not in keep:
        df = df.withColumn("source", F.col("source_id"))
    if responses is None:
        nested = _regex_arrays(df).withColumn("extraction_method", F.lit(fv.METHOD_REGEX))
    else:
        df = _reply_arrays(df.join(responses.select("source_id", "response_json"), "source_id", "left"))
        df = df.withColumn("text", F.when(~F.col("reply_valid"), F.col("text")))  # no scan where the reply counts
        df = _regex_arrays(df)
        nested = df.withColumns({
            "found_variables": F.when(F.col("reply_valid"), F.col("reply_variables")).otherwise(F.col("found_variables")),
            "found_correlations": F.when(F.col("reply_valid"), F.col("reply_correlations")).otherwise(F.col("found_correlations")),
            "extraction_method": F.when(F.col("reply_valid"), fv.METHOD_REPLY).otherwise(fv.METHOD_REGEX),
        })
    # Three tables come from the same pass: keep the parameters (not the texts).
    nested = cut_lineage(nested.select("source_id", "source", "extraction_method", "found_variables", "found_correlations"))
    at = F.to_timestamp(F.lit(extracted_at)) if extracted_at else F.current_timestamp()
    meta = nested.select("source_id", "source", at.alias("extracted_at"), "extraction_method")
    return (*_tables(nested), meta)


def parameters_from_truth(truth: DataFrame, correlations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Known (mean, std) and correlation values straight into parameter tables.

    ``truth``: source_id, var_pos, name, mean, std.
    ``correlations``: source_id, var1, var2, correlation.
    """
    spread = F.col("std") * fv.BOUND_STD
    variables = truth.select(
        "source_id", F.col("var_pos").cast("long").alias("var_pos"), "name", F.lit("normal").alias("distribution"),
        "mean", "std", (F.col("mean") - spread).alias("min"), (F.col("mean") + spread).alias("max"),
        F.lit(None).cast(CATEGORIES).alias("categories"),
    )
    declared = correlations.select(
        "source_id", F.lit(0).cast("long").alias("corr_pos"), F.concat("var1", F.lit("__"), "var2").alias("key"),
        "var1", "var2", valid_correlation(F.col("correlation")).alias("correlation"),
        F.when(F.col("correlation") >= 0, "positive").otherwise("negative").alias("direction"),
    )
    return variables, declared


def score_extraction(variables: DataFrame, truth: DataFrame) -> DataFrame:
    """Match found to known values by nearest mean and report relative errors.

    Each known value, in order, takes the nearest found one not yet taken; the
    lists are a text's own few parameters, so the matching is a fold in its row.
    """
    listed = lambda df, name: df.groupBy("source_id").agg(
        F.array_sort(F.collect_list(F.struct("var_pos", "mean", "std"))).alias(name)
    )
    both = listed(truth, "known").join(listed(variables, "found"), "source_id", "left")
    error = lambda x, t: F.abs(x - t) / F.greatest(F.abs(t), F.lit(1e-9))

    def step(state, t):
        nearest = F.array_min(
            F.transform(
                state["left"],
                lambda e: F.struct(
                    F.abs(e["mean"] - t["mean"]).alias("gap"), e["var_pos"].alias("var_pos"),
                    e["mean"].alias("mean"), e["std"].alias("std"),
                ),
            )
        )
        return F.when(F.size(state["left"]) == 0, state).otherwise(
            F.struct(
                F.filter(state["left"], lambda e: e["var_pos"] != nearest["var_pos"]).alias("left"),
                (state["matched"] + 1).alias("matched"),
                (state["mean_err"] + error(nearest["mean"], t["mean"])).alias("mean_err"),
                (state["std_err"] + error(nearest["std"], t["std"])).alias("std_err"),
            )
        )

    start = F.struct(
        F.coalesce("found", F.array().cast("array<struct<var_pos:bigint,mean:double,std:double>>")).alias("left"),
        F.lit(0).alias("matched"), F.lit(0.0).alias("mean_err"), F.lit(0.0).alias("std_err"),
    )
    known = F.col("known").cast("array<struct<var_pos:bigint,mean:double,std:double>>")
    folded = both.select("source_id", F.size("known").alias("n"), F.aggregate(known, start, step).alias("s"))
    return folded.select(
        "source_id", (F.col("s.matched") / F.col("n")).alias("success_rate"),
        F.try_divide("s.mean_err", "s.matched").alias("mean_rel_err"),
        F.try_divide("s.std_err", "s.matched").alias("std_rel_err"),
    )


def process_pages(pages: DataFrame, responses: DataFrame | None = None, extracted_at: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw pages (source_id, html) to parameters: visible text, then the reply or the patterns."""
    return extract_parameters(clean.html_to_text(pages).select("source_id", "text"), responses, extracted_at)
