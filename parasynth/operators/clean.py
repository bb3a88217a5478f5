"""Text and table cleaning."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv

DROPPED_ELEMENTS = ("script", "style", "noscript", "nav", "header", "footer", "head")
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
SPACE = r"[ \t\n\f\r]+"


def visible_text(html: Column) -> Column:
    text = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    for name in DROPPED_ELEMENTS:
        text = F.regexp_replace(text, rf"(?is)<{name}(?:[ \t\n\f\r][^>]*)?>.*?</{name}[ \t\n\f\r]*>", " ")
    text = F.regexp_replace(text, r"<[^>]+>", " ")
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return F.trim(F.regexp_replace(text, SPACE, " "))


def html_to_text(df: DataFrame, html: str = "html", snippet: str | None = None) -> DataFrame:
    """Add ``text``: visible text, else the snippet, else empty."""
    spare = F.col(snippet) if snippet else F.lit(None).cast("string")
    found = visible_text(F.col(html))
    return df.withColumn("text", F.coalesce(F.when(found != "", found), spare, F.lit("")))


def assemble_pages(pages: DataFrame) -> DataFrame:
    """(doc_id, page_no, text) -> one text per document, pages in order."""
    ordered = F.array_sort(F.collect_list(F.struct("page_no", "text")))
    return pages.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda p: p["text"]), "\n\n").alias("text"))


def statistical_density(text: Column) -> Column:
    """Numeric tokens over word tokens."""
    numbers = F.size(F.regexp_extract_all(text, F.lit(r"[0-9]+(?:\.[0-9]+)?"), F.lit(0)))
    words = F.size(F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9_]+"), F.lit(0)))
    return F.coalesce(F.try_divide(numbers, words), F.lit(0.0))


def recode(column: Column, mapping: Mapping[str, str]) -> Column:
    """Mapped label; anything else becomes NULL."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]), column)


def strip_trailing(column: Column, character: str = ".") -> Column:
    return F.rtrim(column, F.lit(character))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def project_complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).na.drop()


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def require_columns(df: DataFrame, columns: Sequence[str]) -> bool:
    return all(c in df.columns for c in columns)


def latest_runs(runs: DataFrame, keep: int = fv.KEEP_RUNS) -> DataFrame:
    """The runs with the last names in alphabetical order."""
    return runs.orderBy(F.col("run_id").desc()).limit(keep)


def preview(df: DataFrame, order: Sequence[Column | str], rows: int = 10) -> DataFrame:
    return df.orderBy(*order).limit(rows)


def method_list(meta: DataFrame, group: str) -> DataFrame:
    """Distinct extraction methods per group, joined by comma."""
    return meta.groupBy(group).agg(F.array_join(F.array_sort(F.collect_set("extraction_method")), ", ").alias("methods"))
