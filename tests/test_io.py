"""CSV scan with NA spellings, known columns, label cache round trip."""

import os
import tempfile

from pyspark.sql import functions as F

from mvtax.config import NEEDED_COLUMNS
from mvtax.sources.io import known_columns, read_csv, read_label_cache, write_outputs


def test_csv_known_columns(spark):
    d = tempfile.mkdtemp(prefix="mvtax-csv-")
    path = os.path.join(d, "c.csv")
    with open(path, "w") as f:
        f.write('company_name,ai_summary,roles,extra\n')
        f.write('Acme,"multi\nline, summary",NA,x\n')
        f.write('Beta,N/A,"[\'installer\', \'integrator\']",y\n')
    df = known_columns(read_csv(spark, path))
    assert df.columns == ["id"] + list(NEEDED_COLUMNS)
    rows = sorted(df.collect(), key=lambda r: r.company_name)
    assert rows[0].ai_summary == "multi\nline, summary" and rows[0].roles == ""
    assert rows[1].ai_summary == "" and rows[1].services == "" and rows[1].roles.startswith("[")


def test_label_cache_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="mvtax-cache-")
    assert read_label_cache(spark, os.path.join(d, "missing")).count() == 0
    res = spark.createDataFrame([(1, "a")], "id long, label string")
    cache = spark.createDataFrame([("k1", "L1"), ("k2", "L2")], "cache_key string, label string")
    write_outputs(res, cache, os.path.join(d, "res"), os.path.join(d, "cache"))
    back = {r.cache_key: r.label for r in read_label_cache(spark, os.path.join(d, "cache")).collect()}
    assert back == {"k1": "L1", "k2": "L2"}
    empty = cache.where(F.lit(False))
    write_outputs(res, empty, os.path.join(d, "res2"), os.path.join(d, "cache2"))
    assert not os.path.exists(os.path.join(d, "cache2"))


def test_snapshots_survive_a_killed_write_and_keep_readers_valid(spark):
    from mvtax.sources.io import append_label_cache
    path = os.path.join(tempfile.mkdtemp(prefix="mvtax-cache-"), "cache")
    row = lambda *r: spark.createDataFrame(list(r), "cache_key string, label string")
    see = lambda: {r.cache_key: r.label for r in read_label_cache(spark, path).collect()}
    assert append_label_cache(row(("a", "1"), ("b", "1")), path) == 1
    early = read_label_cache(spark, path)
    assert append_label_cache(early, path) is None  # nothing new
    assert append_label_cache(row(("b", "2"), ("c", "2")), path) == 2
    row(("a", "lost")).write.parquet(f"{path}/snapshot-00000003")
    os.remove(f"{path}/snapshot-00000003/_SUCCESS")  # as a killed write leaves it
    assert see() == {"a": "1", "b": "2", "c": "2"}
    assert append_label_cache(row(("d", "4")), path, full=True) == 4
    assert append_label_cache(row(("a", "5"), ("a", "4")), path) == 5
    assert see() == {"a": "5", "b": "2", "c": "2", "d": "4"}
    assert {r.cache_key: r.label for r in early.collect()} == {"a": "1", "b": "1"}


def test_only_an_unfinished_snapshot_is_an_empty_cache(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="mvtax-cache-"), "cache")
    os.makedirs(f"{path}/snapshot-00000001/_temporary/0")
    assert read_label_cache(spark, path).count() == 0
