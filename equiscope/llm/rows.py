"""Running a numpy function over the texts of a DataFrame's rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equiscope.llm.text import as_bytes, CHUNK_BYTES


def row_struct(df: DataFrame, columns: list[str]) -> Column:
    """``row``: the columns in a struct, all of them nullable, as Arrow
    results are."""
    row = F.struct(*[df[f"`{c}`"] for c in columns])
    return row.cast(df.select(row.alias("row")).schema["row"].dataType.simpleString()).alias("row")


def map_texts(
    docs: DataFrame,
    start: Callable[[], Callable[[list[bytes | None]], dict]],
    fields: str,
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """(row, *fields): ``row`` is a struct of the kept input columns (all, if
    None), so that no name of theirs can clash with ``fields``.

    ``start()`` runs once per task and returns the function that maps the
    texts of a chunk to arrays, in the order of ``fields``."""
    keep = docs.columns if keep is None else keep
    inside = keep.index(text) if text in keep else None
    row = row_struct(docs, keep)
    taken = docs.select(row) if inside is not None else docs.select(row, docs[text].alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = start()
        for batch in batches:
            rows = batch.column(0)
            for a, b, texts in chunks(rows.field(inside) if inside is not None else batch.column(1)):
                found = fn(texts)
                arrays = [x if isinstance(x, pa.Array) else pa.array(x) for x in found.values()]
                yield pa.RecordBatch.from_arrays([rows.slice(a, b - a), *arrays], names=["row", *found])

    return taken.mapInArrow(run, f"row {taken.schema['row'].dataType.simpleString()}, {fields}")


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, list[bytes | None]]]:
    """(from, to, texts) of about ``size`` bytes each; a longer text is a chunk
    of its own.  Memory that Arrow holds but no longer needs is given back."""
    held = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
    first = 0
    while first < len(held):
        done = held[first - 1] if first else 0
        last = max(int(np.searchsorted(held, done + size, "right")), first + 1)
        yield first, last, as_bytes(column.slice(first, last - first))
        first = last
    pa.default_memory_pool().release_unused()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; one of its own only
    where the setting is empty and the session is local (tests)."""
    from equiscope.session import ensure_checkpoint_dir

    return ensure_checkpoint_dir(spark)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: what follows reads written
    files, so a lost executor costs no recomputation and cannot change what
    was computed."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
