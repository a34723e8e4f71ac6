"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mvtax.session import bound_batches, ensure_checkpoint_dir, ship_package

#: A word is a maximal run of anything but the six ASCII white-space characters.
#: ``bytes.split()`` cuts at exactly these characters, so Python code splits UTF-8 bytes.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows a broadcast table may have. Above it the operators use a shuffled join.
BROADCAST_ROWS = 1_000_000


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder of ``spark.checkpoint.dir``; Spark's context
    cleaner deletes the files when the frame is gone (``cleanCheckpoints``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Scratch:
    """Tables of a loop, in a folder of their own under ``spark.checkpoint.dir``; the folder goes at the end.

    A loop reads back written tables: unlike a checkpointed frame they carry no constraints of the plan that
    made them, which would grow from round to round."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/loop-{uuid.uuid4().hex}"
        self.tables = 0

    def __enter__(self) -> Scratch:
        return self

    def table(self, df: DataFrame) -> DataFrame:
        self.tables += 1
        df.write.parquet(f"{self.folder}/{self.tables}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{self.tables}")

    def __exit__(self, *_) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def prepare(spark: SparkSession) -> None:
    """Before Python workers run: the package must be importable there, and batches of texts must be small."""
    ship_package(spark)
    bound_batches(spark)


def tasks(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` are within the bound, else unchanged."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the rows whose labels are never learnt: crc32 of the id's text is divisible by 5."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string")) % 5 == 0, F.lit(False))


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of a slice hold about ``limit`` bytes (one row at least);
    Python objects made from a slice stay bounded whatever the batch holds."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lens = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, size in enumerate(lens.tolist()):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        yield batch.slice(start, n - start)


def byte_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    col = batch.column(column)
    col = col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary())
    return [x or b"" for x in col.to_pylist()]
