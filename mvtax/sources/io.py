"""CSV scan, known-column projection, label-cache read and result/cache write."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CSV_NA_VALUES, NEEDED_COLUMNS
from ..session import cut_lineage


def read_csv(spark: SparkSession, path: str, na_values=CSV_NA_VALUES) -> DataFrame:
    """Every column as string; quoted multi-line cells; pandas' NA spellings -> NULL."""
    df = (spark.read.option("header", "true").option("multiLine", "true")
          .option("quote", '"').option("escape", '"').option("inferSchema", "false")
          .csv(path))
    na = F.array(*[F.lit(v) for v in na_values])
    return df.select([F.when(F.array_contains(na, F.col(f"`{c}`")), F.lit(None)).otherwise(F.col(f"`{c}`"))
                      .alias(c) for c in df.columns])


def known_columns(df: DataFrame, columns=NEEDED_COLUMNS, id_col: str | None = "id") -> DataFrame:
    """S2 + S3: the known columns in fixed order, NULL -> ``""``, cast to string; absent -> ``""``.

    Adds a stable ``id`` when the input has none (``monotonically_increasing_id`` is unique,
    not dense; row order of a CSV scan is file order)."""
    if id_col and id_col not in df.columns:
        df = cut_lineage(df.withColumn(id_col, F.monotonically_increasing_id()))  # numbered once, for every later read
    sel = [F.col(id_col).cast("long").alias("id")] if id_col else []
    for c in columns:
        if c in df.columns:
            sel.append(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c))
        else:
            sel.append(F.lit("").alias(c))
    return df.select(*sel)


CACHE_SCHEMA = T.StructType([
    T.StructField("cache_key", T.StringType()),
    T.StructField("label", T.StringType()),
])


SNAPSHOT = "snapshot-"


def _published(spark: SparkSession, path: str) -> list[tuple[int, bool, str]]:
    """``(number, full, path)`` of the cache's committed snapshots, ascending. A snapshot counts once its job has written
    ``_SUCCESS``, which Spark does last: what a killed write leaves behind is never read."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for child in (f.getPath() for f in fs.listStatus(root)):
        name = child.getName()
        if name.startswith(SNAPSHOT) and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(child, "_SUCCESS")):
            number, _, kind = name[len(SNAPSHOT):].partition("-")
            found.append((int(number), kind == "full", child.toString()))
    return sorted(found)


def read_label_cache(spark: SparkSession, path: str | None) -> DataFrame:
    """``(cache_key, label)``; a missing table is an empty cache; the last write of a key wins.

    The cache is the union of its snapshots since the last full one, merged by their numbers. Files are never
    written over, so a frame read here stays valid while later snapshots are appended. A plain parquet table
    (``cache_key, label``, optional ``seq``) at ``path`` is read as well."""
    empty = spark.createDataFrame([], CACHE_SCHEMA)
    if not path:
        return empty
    found = _published(spark, path)
    if found:
        start = max([n for n, full, _ in found if full], default=0)
        parts = [spark.read.schema(CACHE_SCHEMA).parquet(p).withColumn("seq", F.lit(n)) for n, _, p in found if n >= start]
        raw = parts[0]
        for p in parts[1:]:
            raw = raw.unionByName(p)
        return raw.groupBy("cache_key").agg(F.max_by("label", "seq").alias("label"))
    try:
        raw = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no table, or only unfinished snapshots
            return empty
        raise  # an unreadable cache is an error
    if "cache_key" not in raw.columns or "label" not in raw.columns:
        return empty
    if "seq" not in raw.columns:
        raw = raw.withColumn("seq", F.lit(0))
    return (raw.groupBy(F.col("cache_key").cast("string").alias("cache_key"))
               .agg(F.max_by(F.col("label").cast("string"), "seq").alias("label")))


def append_label_cache(cache: DataFrame, path: str, full: bool = False) -> int | None:
    """A snapshot of the rows of ``cache`` that are not in the published cache as they stand (``full``: of the whole
    merged cache, so that readers skip all before it). Returns its number, None if there was nothing to write.

    ``cache`` may be read from ``path`` itself. Repeated keys: the greatest ``seq`` wins, else the greatest label.
    Two writers at once pick the same number; the second fails and leaves the first one's snapshot."""
    spark = cache.sparkSession
    order = F.col("seq") if "seq" in cache.columns else F.col("label")
    rows = cache.groupBy(F.col("cache_key").cast("string").alias("cache_key")).agg(F.max_by(F.col("label").cast("string"), order).alias("label"))
    old = read_label_cache(spark, path).withColumnRenamed("label", "_old")
    both = rows.join(old, "cache_key", "full" if full else "left")
    if full:
        both = both.select("cache_key", F.coalesce("label", "_old").alias("label"))
    else:
        both = both.where(~F.col("label").eqNullSafe(F.col("_old"))).select("cache_key", "label")
    both = cut_lineage(both)
    if both.isEmpty():
        return None
    number = 1 + max([n for n, _, _ in _published(spark, path)], default=0)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    taken = [f.getPath().getName() for f in fs.listStatus(root)] if fs.exists(root) else []
    while any(name.startswith(f"{SNAPSHOT}{number:08d}") for name in taken):  # an unfinished write holds the number
        number += 1
    both.write.mode("errorifexists").parquet(f"{path.rstrip('/')}/{SNAPSHOT}{number:08d}" + ("-full" if full else ""))
    return number


def write_outputs(result: DataFrame, cache: DataFrame, result_path: str, cache_path: str | None,
                  mode: str = "overwrite") -> None:
    """The label cache - what is new in it, as a snapshot - and the cluster table. The cache goes first: names that
    were paid for are kept even if the table's write fails."""
    if cache_path:
        append_label_cache(cache, cache_path)
    result.write.mode(mode).parquet(result_path)
