"""Licence texts and notices in documents, in DataFrame operations only.

The lines of a text, its paragraphs and the whole text are each compared with
every template: normalised to lower-case words of ASCII letters and digits, by
the Dice coefficient of their sets of word bigrams. Two sets reach a
coefficient d only if the smaller has at least d / (2 - d) times the larger's
size, so a template is looked at for units of fitting size alone. All of it
happens in the document's row, without a shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import bind
from .common import texts
from .license_templates import TEMPLATES

#: Least Dice coefficient of a match.
LEAST = 0.8


def bigrams(text: str) -> list[str]:
    """The distinct word bigrams of a text, sorted."""
    words = re.findall("[a-z0-9]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _words(unit: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.regexp_replace(unit, "[^A-Za-z0-9]+", " ")), " "), "")


def _bigrams(words: Column) -> Column:
    """Distinct bigrams of an array of words that a lambda binds."""
    firsts = F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))
    return F.array_distinct(F.transform(firsts, lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1))))


def _best(found: Column, templates: list[tuple[str, str]], least: float) -> Column:
    """(dice, licence) of the template most like a set of bigrams that a lambda binds; null if none reaches ``least``."""
    options = []
    for name, wording in templates:
        own = bigrams(wording)
        share = least / (2 - least)
        fits = F.size(found).between(F.lit(share * len(own)), F.lit(len(own) / share))
        dice = 2 * F.size(F.array_intersect(found, F.array(*map(F.lit, own)))) / (F.size(found) + len(own))
        options.append(F.when(fits, F.struct(dice.alias("dice"), F.lit(name).alias("license"))))
    return bind(F.array_max(F.array(*options)), lambda top: F.when(top["dice"] >= least, top))


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``license``, ``dice``, ``licenses``, ``n_units``.

    ``license`` and ``dice`` are of the best unit (of equal ones the
    alphabetically last licence), null without a match; ``licenses`` has all
    matched, sorted, ``n_units`` counts the distinct units that match. Null and
    empty texts match nothing; repeated rows come back as often as they went in.
    """
    smallest = min(len(bigrams(w)) for _, w in templates) * least / (2 - least)
    lines, paragraphs = F.split("text", "\n"), F.when(F.col("text").rlike(r"\n[ \t]*\n"), F.split("text", r"\n[ \t]*\n")).otherwise(F.array().cast("array<string>"))
    rows = texts(docs, id_col, text_col).select("doc_id", F.array_distinct(F.concat(lines, paragraphs, F.array("text"))).alias("units"))
    enough = F.filter(F.transform("units", _words), lambda w: F.size(w) - 1 >= smallest)
    rows = rows.select("doc_id", F.transform(enough, lambda w: _best_of(w, templates, least)).alias("found"))
    rows = rows.select("doc_id", F.filter("found", lambda m: m.isNotNull()).alias("found"))
    top = F.array_max("found")
    return rows.select(
        "doc_id", top["license"].alias("license"), F.round(top["dice"], 6).alias("dice"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda m: m["license"]))), ",").alias("licenses"), F.size("found").cast("long").alias("n_units"),
    )


def _best_of(words: Column, templates: list[tuple[str, str]], least: float) -> Column:
    return bind(_bigrams(words), lambda found: _best(found, templates, least))
