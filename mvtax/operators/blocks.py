"""Rows of long-vector tables packed into bounded blocks, for the iterative operators.

A block holds at most about ``BLOCK_ROWS`` rows of one group: ``(gid, blk, ids, mat)`` with ``ids``
(int64, ascending) and ``mat`` (float64, row major) as bytes. A large group has many blocks spread over
the tasks, a small group one block: the operators run the same steps on both. ``gid`` is a 64-bit hash
of the group columns; ``group_table`` keeps what it stands for, one row a group.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package, spread

BLOCK_ROWS = 1024
#: Rows of a block where every block sends to all others, so that few blocks are sought.
WIDE_ROWS = 8192
#: A per-group table is broadcast up to this many bytes (counted rows times bytes a row), else shuffled.
BROADCAST_BYTES = 64 << 20


def small_side(df: DataFrame, rows: int, row_bytes: int = 256) -> DataFrame:
    """``df`` with a broadcast hint if its counted size is within the bound, else unchanged."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def gid_of(group_cols) -> Column:
    return F.xxhash64(*group_cols) if group_cols else F.lit(0).cast("long")


def group_table(rows: DataFrame, group_cols, *aggs, most: int | None = None) -> DataFrame:
    """One row per group: ``gid``, the group columns, row count ``n``, blocks ``nb`` and ``aggs``; materialised. With ``most``,
    a group has more blocks than that only where its blocks would hold more than ``WIDE_ROWS`` rows."""
    g = list(group_cols)
    t = rows.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), *aggs) if g else rows.agg(F.count(F.lit(1)).alias("n"), *aggs).where("n > 0")
    return cut_lineage(t.withColumn("gid", gid_of(g)).withColumn("nb", blocks_of("n", most)))


def blocks_of(n: str, most: int | None = None) -> Column:
    fine = F.ceil(F.col(n) / BLOCK_ROWS).cast("long")
    return fine if most is None else F.least(fine, F.greatest(F.lit(most), F.ceil(F.col(n) / WIDE_ROWS))).cast("long")


def block_of(id_col: str = "id") -> Column:
    return F.pmod(F.xxhash64(id_col), F.col("nb")).cast("long")


def pack(rows: DataFrame, groups: DataFrame, n_groups: int, group_cols, vec_col: str) -> DataFrame:
    """``rows`` (group columns, ``id``, an array column) as blocks; all vectors of a group have one length."""
    ship_package(rows.sparkSession)
    tagged = rows.select(gid_of(list(group_cols)).alias("gid"), F.col("id").cast("long").alias("id"), F.col(vec_col).alias("v"))
    tagged = tagged.join(small_side(groups.select("gid", "nb"), n_groups), "gid")
    packed = (tagged.withColumn("blk", block_of()).groupBy("gid", "blk")
              .agg(F.sort_array(F.collect_list(F.struct("id", "v"))).alias("r"))
              .select("gid", "blk", F.col("r.id").alias("i"), F.flatten("r.v").alias("m")))

    def to_bytes(it):
        for pdf in it:
            yield pdf.assign(ids=[np.asarray(x, np.int64).tobytes() for x in pdf["i"]],
                             mat=[np.asarray(x, np.float64).tobytes() for x in pdf["m"]])[["gid", "blk", "ids", "mat"]]

    return cut_lineage(spread(packed.mapInPandas(to_bytes, "gid long, blk long, ids binary, mat binary"), "gid", "blk"))


#: Bytes of groups that one partition of ``local_groups`` is meant to hold.
BIN_BYTES = 64 << 20


def local_groups(total: int, *tables: DataFrame, by: tuple[str, ...] = ("gid",)) -> list[DataFrame]:
    """Tables keyed by group (``by``), each dealt to the same bins of whole groups; ``total``: the bytes of all of them.
    There are as many bins as groups of ``BIN_BYTES`` fill, and one a core at least; a group of known bound is
    never cut, so a task holds about a bin's bytes beside its largest group."""
    spark = tables[0].sparkSession
    bins = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), int(total) // BIN_BYTES + 1)
    return [t.repartition(bins, *by) for t in tables]


def ids_of(row) -> np.ndarray:
    return np.frombuffer(row.ids, np.int64)


def mat_of(raw: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(raw, np.float64).reshape(rows, -1)


def uniform(ids: np.ndarray, *salt: int) -> np.ndarray:
    """Repeatable numbers in (0, 1) from ids and salts (splitmix64)."""
    x = ids.astype(np.uint64)
    for s in salt:
        x = x + np.uint64((s + 1) * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
