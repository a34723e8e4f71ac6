"""SparkSession helpers: sane defaults for the engine and a checkpoint directory."""

from __future__ import annotations

import os
import tempfile
import time
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "mvtax", shuffle_partitions: int | None = None,
              driver_memory: str = "16g") -> SparkSession:
    """Build (or reuse) a session with AQE, skew handling and Arrow enabled.

    On a cluster, ``master`` stays ``None`` and the launcher's settings win.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master).config("spark.driver.memory", driver_memory)
    parts = shuffle_partitions or int(os.environ.get("MVTAX_SHUFFLE_PARTITIONS", "0") or 0)
    if parts:
        b = b.config("spark.sql.shuffle.partitions", str(parts))
    b = (b.config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only when unset (tests, local mode)
    fall back to a fresh local scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3) for iterative operators")
    path = tempfile.mkdtemp(prefix="mvtax-ckpt-")
    sc.setCheckpointDir(path)
    return path


_TRACE = os.environ.get("MVTAX_TRACE") == "1"

#: Shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and read it back.

    Cuts lineage (survives executor loss, like ``checkpoint()``), and unlike a checkpointed RDD
    the re-read table carries real file-size statistics - so later size checks (broadcast
    thresholds, AQE) see the true size instead of an ever-growing estimate. The shuffle files of the
    write are removed with its end: nothing reads them but the table."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/mvtax-{uuid.uuid4().hex}"
    t = time.time()
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.parquet(path)
    out._table_path = path
    if _TRACE:
        import inspect
        fr = inspect.stack()[1]
        print(f"[trace] {os.path.basename(fr.filename)}:{fr.lineno} {fr.function} {time.time() - t:.2f}s", flush=True)
    return out


def drop_table(df: DataFrame) -> None:
    """Delete the table of a frame that ``cut_lineage`` returned and that nothing reads any more; other frames are left."""
    at = getattr(df, "_table_path", None)
    if at is not None:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


_SHIPPED: set = set()
_ZIP: list = []


def ship_package(spark: SparkSession) -> None:
    """Make ``mvtax`` importable in Python workers (``addPyFile`` of a zip of the package),
    once per SparkContext. Operators that run pandas functions call this first."""
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    if not _ZIP:
        root = os.path.dirname(os.path.abspath(__file__))
        fd, path = tempfile.mkstemp(prefix="mvtax-", suffix=".zip")
        os.close(fd)
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
            for d, _, files in os.walk(root):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(d, f)
                        zf.write(full, os.path.relpath(full, os.path.dirname(root)))
        _ZIP.append(path)
    sc.addPyFile(_ZIP[0])
    _SHIPPED.add(key)


#: Rows and bytes of an Arrow batch, which the JVM and the Python worker hold; one longer row is a batch of its own.
ARROW_ROWS = 2000
ARROW_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Keep the Arrow batches that Python workers get small, whatever a row holds."""
    for what, most in (("Records", ARROW_ROWS), ("Bytes", ARROW_BYTES)):
        name = f"spark.sql.execution.arrow.max{what}PerBatch"
        if not 0 < int(spark.conf.get(name).rstrip("b")) <= most:
            spark.conf.set(name, most)


def parallelism(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame, *cols) -> DataFrame:
    """Hash-partition by ``cols`` into a fixed count (>= the cluster's parallelism) before
    CPU-heavy pandas stages, so adaptive coalescing of small inputs cannot serialise them."""
    return df.repartition(parallelism(df.sparkSession), *cols)
