"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col):
    """Lower-case A-Z only, as the contracts ask; other letters stay."""
    return F.translate(col, UPPER, LOWER)


def fold_crc(id_col, folds: int):
    """crc32 of the id as text, modulo folds: the fold that a row belongs to."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the folder that the cluster names; it survives lost executors.

    ``spark.checkpoint.dir`` is read from the session. Only where it is unset and all runs in one
    process (tests, a laptop) is a local folder used; a cluster must name one that its machines share.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="ckpt"))
    return df.checkpoint(eager=True)


def pieces(batches: Iterator[pa.RecordBatch], col: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``col`` holds about max_bytes at most (or one row), so that
    long texts do not pile up in a Python worker."""
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        sizes = pc.fill_null(pc.binary_length(b.column(col)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i in range(n):
            if held and held + sizes[i] > max_bytes:
                yield b.slice(start, i - start)
                start, held = i, 0
            held += int(sizes[i])
        yield b.slice(start)


def rows_of(docs: DataFrame, id_col: str, text_col: str, carry: list[str] | None = None) -> DataFrame:
    """(id, text) of each row, and as ``carry`` a struct of the columns asked for, whatever their names."""
    more = [F.struct(*(F.col(f"`{c}`") for c in carry)).alias("carry")] if carry else []
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *more)


def release_memory() -> None:
    """Give a Python worker's free memory back, as it stays alive for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # where the C library has it
        trim(0)


def map_arrow(rows: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """Run ``make()`` once per task and its result on pieces of the rows (id, text and maybe carry).

    The result's columns are ``schema`` after the id, and ``carry`` as it came.
    """
    carried = rows.columns[2:]
    kinds = [f"id {rows.schema['id'].dataType.simpleString()}", schema, *(f"{c} {rows.schema[c].dataType.simpleString()}" for c in carried)]

    def run(batches):
        f = make()
        for b in pieces(batches, "text"):
            out = f(b)
            yield pa.record_batch([b.column(0), *out.columns, *b.columns[2:]], names=["id", *out.schema.names, *carried])
        del f
        release_memory()

    return rows.mapInArrow(run, ", ".join(kinds))
