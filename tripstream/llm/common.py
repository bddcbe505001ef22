"""Helpers shared by the text operators."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Bytes of text that one step of an Arrow task holds decoded at a time.
STEP_BYTES = 8 << 20

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only (``lower`` also maps other letters)."""
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def crc_mod(col: Column, n: int) -> Column:
    """crc32(value as text) mod n; null stays null."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(n)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def store_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``write_table`` with the path, for ``remove_table``."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: cuts lineage at a
    copy every executor sees, so later steps survive a lost executor."""
    return store_table(df, name)[0]


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a stored table that a later one has replaced."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Join key of a document row that is never null: the id as text and a hash
    of the text. Rows equal in both are one document given several times."""
    return [F.coalesce(F.col(id_col).cast("string"), F.lit("\0null")).alias("_key_id"),
            F.xxhash64(F.col(text_col)).alias("_key_text")]


def bounded_batches(spark: SparkSession, most: str = "16m") -> None:
    """Bound Arrow batches by bytes in this session (rows vary in length by many
    orders of magnitude); a smaller bound that the session has stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key)
    if not now.rstrip("bB").isdigit() or int(now.rstrip("bB")) > 16 << 20:
        spark.conf.set(key, most)


def release_memory() -> None:
    """Hand freed memory back to the system: a worker process serves many tasks,
    and what its allocators keep counts against the executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):     # another C library
        ctypes.CDLL(None).malloc_trim(0)


def small_batches(batches: Iterator[pa.RecordBatch], text_col: str,
                  step_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of one piece have about
    ``step_bytes`` bytes (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        text = batch.column(batch.schema.get_field_index(text_col))
        ends = text_offsets(text)[1:]
        start, base = 0, text_offsets(text)[0]
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, base + step_bytes, side="right"))
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])


def text_offsets(text: pa.Array) -> np.ndarray:
    """Byte offsets (n + 1) of a string array, slice-aware."""
    kind = np.int64 if pa.types.is_large_string(text.type) else np.int32
    raw = np.frombuffer(text.buffers()[1], dtype=kind)
    return raw[text.offset:text.offset + len(text) + 1].astype(np.int64)


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string array; nulls count as empty texts."""
    if text.null_count:
        text = text.fill_null("")
    off = text_offsets(text)
    buf = text.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def strings_between(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The pieces of ``data`` between consecutive cuts, as an Arrow array
    without copying; pieces are binary, so a cut may be anywhere."""
    cuts = np.ascontiguousarray(cuts, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1,
                                 [None, pa.py_buffer(cuts), pa.py_buffer(data)])


def map_texts(docs: DataFrame, text_col: str, outputs: str, make, keep: list[str] | None = None,
              step_bytes: int = STEP_BYTES) -> DataFrame:
    """Run a batch function over the texts, row by row of the result.

    ``make()`` is called once per task and returns a function from a string
    array to the list of output arrays named in ``outputs`` (a DDL string).
    ``keep``: input columns to return (default all); those named like an output
    are replaced. Null texts reach the function as nulls.
    """
    from pyspark.sql import types as T
    new = T.StructType.fromDDL(outputs)
    names = {f.name.lower() for f in new.fields}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    bounded_batches(docs.sparkSession)
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").alias("__map_text"))
    schema = T.StructType([source.schema[c] for c in kept] + new.fields)

    def run(batches):
        work = make()
        for piece in small_batches(batches, "__map_text", step_bytes):
            made = work(piece.column(len(kept)))
            yield pa.RecordBatch.from_arrays(
                [piece.column(i) for i in range(len(kept))] + list(made),
                names=kept + [f.name for f in new.fields])
            del made
            release_memory()

    return source.mapInArrow(run, schema)
