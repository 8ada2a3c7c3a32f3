"""Published tables, stored catalogs, even splits, and scratch tables."""

import datetime as dt
from collections import Counter
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from guidepost import ControlTables
from guidepost import operators as ops
from guidepost.sources import (
    JdbcSource,
    QuantileSplit,
    drop_table,
    open_catalog,
    publish,
    published_versions,
    read_version,
    scratch_folder,
    snapshot,
    store_catalog,
)
from tests.helpers import rows

DAY = dt.datetime(2024, 1, 1)
WINDOWS = "extraction_id int, target_id int, delta_start timestamp_ntz, delta_end timestamp_ntz"


def windows(spark):
    later = DAY + dt.timedelta(days=1)
    return spark.createDataFrame([(i, i % 2, DAY, later) for i in range(6)], WINDOWS)


def ids(spark, *values, key="extraction_id"):
    return spark.createDataFrame([(v,) for v in values], f"{key} int")


def moved_days(spark, root, version=None):
    found = read_version(spark, root, version=version).collect()
    return {r["extraction_id"]: (r["delta_start"] - DAY).days for r in found}


def test_a_run_moves_a_window_once(spark, tmp_path):
    root = str(tmp_path)
    ops.publish_windows(spark, root, windows(spark))
    first = ops.advance_published(spark, root, "monday", ids(spark, 1, 2, 2, None))
    again = ops.advance_published(spark, root, "monday", ids(spark, 2, 1))
    assert first == again and first.number == 2
    assert moved_days(spark, root) == {0: 0, 1: 1, 2: 1, 3: 0, 4: 0, 5: 0}
    more = ops.advance_published(spark, root, "monday", ids(spark, 1, 2, 3))
    assert more.number == 3
    assert moved_days(spark, root) == {0: 0, 1: 1, 2: 1, 3: 1, 4: 0, 5: 0}
    ops.advance_published(spark, root, "tuesday", ids(spark, 3))
    ops.advance_published(spark, root, "tuesday", ids(spark, 0, key="target_id"), "target_id")
    assert moved_days(spark, root) == {0: 1, 1: 1, 2: 2, 3: 2, 4: 1, 5: 0}
    # Older versions stay as they were.
    versions = published_versions(spark, root)
    assert [v.number for v in versions] == [1, 2, 3, 4, 5]
    assert set(moved_days(spark, root, versions[0]).values()) == {0}
    assert [v.run for v in versions] == [None, "monday", "monday", "tuesday", "tuesday"]


def test_nothing_is_published_by_halves(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(LookupError, match="nothing is published"):
        ops.advance_published(spark, root, "monday", ids(spark, 1))
    ops.publish_windows(spark, root, windows(spark))
    bad = windows(spark).withColumn("target_id", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        publish(spark, root, {"table": bad}, 1)
    assert [v.number for v in published_versions(spark, root)] == [1]
    # Of two writers that start from the same version the second fails and leaves nothing.
    publish(spark, root, {"table": windows(spark)}, 1, "one")
    before = sorted(p.name for p in tmp_path.iterdir())
    with pytest.raises(RuntimeError, match="another writer"):
        publish(spark, root, {"table": windows(spark).limit(1)}, 1, "other")
    assert sorted(p.name for p in tmp_path.iterdir()) == before
    assert not [p for p in (tmp_path / "versions").iterdir() if p.name.startswith("_")]
    assert [v.run for v in published_versions(spark, root)] == [None, "one"]
    assert read_version(spark, root).count() == 6
    with pytest.raises(LookupError, match="no table"):
        read_version(spark, root, "other")


def test_stored_control_tables_agree_after_a_change(spark, tmp_path):
    source = f"{tmp_path}/targets"
    names = "target_id int, theme string, target_name string"
    spark.createDataFrame([(1, "a", "t")], names).write.parquet(source)
    extractions = spark.createDataFrame([(7, 1, DAY, DAY)], WINDOWS)
    tables = {"targets": spark.read.parquet(source), "extractions": extractions}
    kept = ControlTables(tables).stored(f"{tmp_path}/state")
    spark.createDataFrame([(2, "a", "other")], names).write.mode("overwrite").parquet(source)
    live = ControlTables(tables | {"targets": spark.read.parquet(source)})
    assert live.extractions_for_target("t").count() == 0
    for control in (kept, ControlTables.open(spark, f"{tmp_path}/state")):
        assert control.extractions_for_target("t").count() == 1
        assert control["targets"].schema == tables["targets"].schema
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        open_catalog(spark, f"{tmp_path}/targets")
    with pytest.raises(ValueError, match="no tables"):
        store_catalog({}, f"{tmp_path}/none")


KEYS = {
    "int": [1] * 500 + [2] * 3 + [7] * 200 + list(range(10, 300)) + [None] * 40,
    "string": ["it's"] * 400 + [f"k{i:03}" for i in range(300)] + ["", None, None],
    "date": [dt.date(2024, 1, 1 + i % 3) for i in range(90)] + [dt.date(2023, 1, 1), None],
    "timestamp_ntz": [DAY + dt.timedelta(minutes=i * i) for i in range(300)] + [None],
    "decimal(9,2)": [Decimal(i % 40) / 4 for i in range(400)],
}


@pytest.mark.parametrize("kind", [*KEYS, "one", "none"])
def test_quantile_splits_hold_each_row_once(spark, kind):
    values = KEYS.get(kind, [5] * 9 if kind == "one" else [None] * 3)
    kind = kind if kind in KEYS else "int"
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"k {kind}, n int")
    df.createOrReplaceTempView("split_keys")
    split = QuantileSplit("k", 8)
    bounds = [r["bound"] for r in spark.sql(f"SELECT * FROM {split.bounds_query('split_keys', 'k')}").collect()]
    conditions = split.conditions("k", bounds)
    assert len(conditions) <= 9
    parts = [{r["n"] for r in df.where(c).collect()} for c in conditions]
    assert Counter(n for part in parts for n in part) == Counter(range(len(values)))
    # A part exceeds its share by the rows of one value at most.
    most = max(Counter(v for v in values if v is not None).values(), default=0)
    assert max(map(len, parts)) <= max(-(-len(values) // 8) + most, values.count(None))


def test_quantile_split_of_a_database_table(spark):
    calls = []

    def jdbc(url, table, **options):
        calls.append((table, options.get("predicates")))
        return spark.createDataFrame([(1, 3), (2, 8)], "part int, bound int")

    source = JdbcSource("jdbc:x", {"user": "u"}, {"T": QuantileSplit("a]b", 2)})
    source.read(SimpleNamespace(read=SimpleNamespace(jdbc=jdbc)), "T", "dbo")
    assert calls[0][0].startswith("(SELECT part, MIN(k) AS bound") and "[dbo].[T]" in calls[0][0]
    assert "NTILE(2) OVER (ORDER BY [a]]b])" in calls[0][0]
    assert calls[1] == ("[dbo].[T]", ["[a]]b] < 8", "[a]]b] >= 8", "[a]]b] IS NULL"])
    with pytest.raises(ValueError, match="cannot hold float"):
        QuantileSplit("k", 2).conditions("k", [1.0, 2.5])


def test_scratch_tables_can_be_dropped(spark):
    table = snapshot(spark.range(5), "dropped")
    assert rows(table) == rows(spark.range(5))
    (path,) = {p.rsplit("/", 1)[0] for p in table.inputFiles()}
    drop_table(table)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError, match="once"):
        drop_table(table)


def session(spark, master, **conf):
    context = SimpleNamespace(
        applicationId="app", master=master, _jvm=spark.sparkContext._jvm,
        _jsc=spark.sparkContext._jsc,
    )
    get = lambda key, default=None: conf.get(key.replace(".", "_"), default)
    return SimpleNamespace(conf=SimpleNamespace(get=get), sparkContext=context)


def test_a_cluster_needs_a_shared_scratch_folder(spark):
    local = {"spark_sql_warehouse_dir": "file:/somewhere/spark-warehouse"}
    assert scratch_folder(session(spark, "local[8]", **local)).startswith("file:/somewhere/")
    for master in ("yarn", "k8s://host", "spark://host:7077"):
        with pytest.raises(ValueError, match="all executors share"):
            scratch_folder(session(spark, master, **local))
    shared = session(spark, "yarn", spark_checkpoint_dir="file:/mnt/all", **local)
    assert scratch_folder(shared) == "file:/mnt/all/guidepost-app"
