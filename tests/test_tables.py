from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from snapflow.sources.readers import key_history
from snapflow.sources.tables import (
    create_feature_table,
    create_table,
    ensure_schema,
    merge_rows,
    overwrite_table,
    replace_partitions,
    reset_table,
    set_quality,
    settle,
    shared_folder,
    upsert,
    with_partition_date,
)

START = datetime(2024, 3, 14)
KEYS = ["station_id", "ts"]


def rows(spark, hours, value, station=1):
    return spark.createDataFrame(
        [(station, START + timedelta(hours=h), value) for h in hours],
        "station_id bigint, ts timestamp, bikes bigint",
    )


def content(df):
    return sorted((r.station_id, r.ts, r.bikes) for r in df.collect())


def test_merge_rows(spark):
    merged = merge_rows(rows(spark, range(4), 1), rows(spark, (3, 4), 2), KEYS)
    wanted = rows(spark, range(3), 1).union(rows(spark, (3, 4), 2))
    assert content(merged) == content(wanted)


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    ensure_schema(spark, "features_db")
    table = "features_db.features"
    create_feature_table(rows(spark, range(72), 1), table, KEYS, path=str(tmp_path / "features"))

    def files():
        found = (tmp_path / "features").glob("**/*.parquet")
        return {str(p): p.stat().st_mtime_ns for p in found}

    before = files()
    updates = with_partition_date(rows(spark, range(30, 36), 5).union(rows(spark, [100], 6)), "date", "ts")
    wanted = merge_rows(rows(spark, range(72), 1), updates, KEYS)
    for _ in range(2):  # again changes nothing
        upsert(spark, table, updates, KEYS)
        assert content(spark.table(table)) == content(wanted)
    after = files()
    kept = {name for name in before if after.get(name) == before[name]}
    assert len(before) == 3 and len(kept) == 2
    assert len(after) == 4  # former folders are gone
    twice = with_partition_date(rows(spark, (1, 1), 3), "date", "ts")
    with pytest.raises(ValueError):
        upsert(spark, table, twice, KEYS)
    with pytest.raises(ValueError):
        create_feature_table(twice.drop("date"), "features_db.other", KEYS)


class Failing:
    """A session that breaks off at the n-th statement that switches a partition."""

    def __init__(self, spark, n):
        self.spark, self.left = spark, n

    def __getattr__(self, name):
        return getattr(self.spark, name)

    def sql(self, text):
        if text.startswith("ALTER"):
            self.left -= 1
            if self.left == 0:
                raise RuntimeError("broken off")
        return self.spark.sql(text)


def test_a_failed_upsert_can_be_repeated(spark, tmp_path):
    ensure_schema(spark, "features_db")
    table = "features_db.failing"
    base = rows(spark, range(72), 1)
    create_feature_table(base, table, KEYS, path=str(tmp_path / "failing"))
    updates = with_partition_date(rows(spark, [10, 30, 50, 100], 5), "date", "ts")
    wanted = content(merge_rows(base, updates, KEYS))
    for n in (1, 2, 4):
        with pytest.raises(RuntimeError):
            upsert(Failing(spark, n), table, updates, KEYS)
        spark.catalog.refreshTable(table)
        found = content(spark.table(table))
        # Every partition is as before or as after.
        assert {r[:2] for r in content(base)} <= {r[:2] for r in found} <= {r[:2] for r in wanted}
    upsert(spark, table, updates, KEYS)
    assert content(spark.table(table)) == wanted


def test_replaced_partitions_hold_the_given_rows_only(spark, tmp_path):
    ensure_schema(spark, "features_db")
    table = "features_db.replaced"
    base = rows(spark, range(72), 1)
    create_feature_table(base, table, KEYS, path=str(tmp_path / "replaced"))
    days = [(START + timedelta(days=n)).date() for n in (1, 2, 4)]
    new = rows(spark, [30, 100], 5)
    for _ in range(2):
        replace_partitions(spark, table, with_partition_date(new, "date", "ts"), days, keys=KEYS)
        assert content(spark.table(table)) == content(rows(spark, range(24), 1).union(new))
    twice = with_partition_date(rows(spark, (30, 30), 3), "date", "ts")
    with pytest.raises(ValueError):
        replace_partitions(spark, table, twice, days[:1], keys=KEYS)
    assert content(spark.table(table)) == content(rows(spark, range(24), 1).union(new))


def test_upsert_reads_touched_partitions_only(spark, tmp_path):
    ensure_schema(spark, "features_db")
    table = "features_db.pruned"
    create_feature_table(rows(spark, range(240), 1), table, KEYS, path=str(tmp_path / "pruned"))
    updates = with_partition_date(rows(spark, range(30, 36), 5), "date", "ts")
    seen = []
    real = type(spark.table(table)).filter

    def watch(self, condition):
        out = real(self, condition)
        if "PartitionFilters" in (plan := out._jdf.queryExecution().toString()):
            seen.append(plan.split("PartitionFilters:")[1].split("]")[0])
        return out

    type(spark.table(table)).filter = watch
    try:
        upsert(spark, table, updates, KEYS)
    finally:
        type(spark.table(table)).filter = real
    assert any("2024-03-15" in s or "19797" in s for s in seen)


def test_table_modes(spark):
    ensure_schema(spark, "modes_db")
    create_table(rows(spark, range(2), 1), "modes_db.t")
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        create_table(rows(spark, range(2), 1), "modes_db.t")
    create_table(rows(spark, range(2), 1), "modes_db.t", mode="append")
    assert spark.table("modes_db.t").count() == 4
    overwrite_table(rows(spark, range(3), 1), "modes_db.t")
    assert spark.table("modes_db.t").count() == 3
    set_quality(spark, "modes_db.t", "gold", "the stations' rows")
    assert "gold" in str(spark.sql("SHOW TBLPROPERTIES modes_db.t").collect())
    first = reset_table(spark, "modes_db.t", "t")
    assert not spark.catalog.tableExists("modes_db.t") and first != reset_table(spark, "modes_db.t", "t")


def test_settle_keeps_rows_and_schema(spark):
    df = rows(spark, range(5), 1)
    assert content(settle(df)) == content(df)
    empty = df.filter("bikes > 9")
    assert settle(empty).schema == empty.schema and settle(empty).count() == 0


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "x").startswith(base)


def test_history_filter_reaches_the_scan(spark):
    stored = settle(rows(spark, range(5), 1).union(rows(spark, range(3), 2, station=2)))
    found = key_history(stored, "station_id", 2)
    assert [r.ts for r in found.collect()] == [START + timedelta(hours=h) for h in range(3)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(station_id,2)" in plan
    assert found.filter(F.col("station_id") != 2).count() == 0
