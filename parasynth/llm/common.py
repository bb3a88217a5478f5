"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, written  # noqa: F401

#: Characters that separate words: space and the controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Identifier and whole text under fixed names; a null text counts as empty.

    Only these two columns are read, so other columns of any name don't matter.
    """
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def text_key(text: Column) -> Column:
    """128 bits that stand for a text: rows of equal text have equal keys."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(1)).alias("b"))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def per_batch(df: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Apply ``work`` to Arrow batches; it returns one list or array per column of ``schema``.

    Batches are cut into slices of bounded bytes, so very long texts don't pile up.
    """
    names = [c.name for c in df.sparkSession.createDataFrame([], schema).schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                made = work(part)
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in (made[n] for n in names)], names)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    rows = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A numeric column without nulls as NumPy."""
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def checkpointed(df: DataFrame) -> DataFrame:
    return cut_lineage(df)


def replace_texts(df: DataFrame, text_col: str, work: Callable[[list], list]) -> DataFrame:
    """``df`` with ``text_col`` changed by ``work`` on lists of texts; all other columns pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                at = part.schema.get_field_index(text_col)
                columns = part.columns
                columns[at] = pa.array(work(part.column(at).to_pylist()), pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return df.mapInArrow(run, df.schema)
