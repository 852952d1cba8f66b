import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_snapshots import document, place, write_documents

from snapflow.operators.features import gold_features
from snapflow.operators.labels import label_stream, label_table
from snapflow.operators.nearest import nearest_k
from snapflow.operators.snapshots import dedup_snapshots, flatten_places, place_readings, slot_counts
from snapflow.operators.stations import station_catalogue, station_rows
from snapflow.schema import DOCUMENT
from snapflow.sources.readers import read_snapshot_stream, read_snapshots
from snapflow.sources.tables import create_feature_table, settle, upsert_stream, with_partition_date
from snapflow.streaming.jobs import (
    Job,
    backfill,
    bronze,
    build_gold,
    ingest_documents,
    current,
    refine_snapshots,
    refine_stations,
    run_all,
    run_models,
    run_to_folder,
    take_in_late,
)

START = datetime(2024, 3, 14)


def scrape(n, stations=7, minute=0, moved=0.0):
    at = START + timedelta(minutes=10 * n + minute)
    places = [
        place(s, bikes=(n * s) % 13, lat=47.5 + s / 100 + (moved if s == 4 else 0))
        for s in range(1, stations + 1)
    ]
    return at.strftime("%Y-%m-%dT%H-%M-%SZ.json"), document(places)


@pytest.fixture()
def folder(tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    return path


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def batch_snapshots(spark, path):
    return dedup_snapshots(place_readings(flatten_places(read_snapshots(spark, path, DOCUMENT))))


def before(df, slots):
    return df.filter(F.col("ts") < F.lit(START + timedelta(minutes=10 * slots)))


def test_chain_equals_batch_and_resumes(spark, tmp_path, folder):
    path = write_documents(folder, dict(scrape(n) for n in range(30)))
    (folder / "notes.json").write_text("{}")
    (folder / "2024-03-14T00-05-00Z.json").write_text('{"countries": [')
    job = Job(schema="chain_db", checkpoints=str(tmp_path / "ck"), max_files=7)
    run_all(spark, job, path)
    run_all(spark, job, path)  # nothing new, nothing twice
    gold = None

    def check(slots, known_slots):  # the slots from the watermark on wait
        nonlocal gold
        snapshots = before(batch_snapshots(spark, path), slots)
        table = spark.table(job.table("snapshots_silver"))
        assert rows(table.drop("date")) == rows(snapshots)
        stations = station_rows(snapshots)
        assert rows(spark.table(job.table("stations_silver"))) == rows(stations)
        catalogue = station_catalogue(snapshots)
        known = spark.table(job.table("station_catalogue"))
        assert rows(known.drop("seen", "shard")) == rows(catalogue.drop("district"))
        nearest = nearest_k(catalogue)
        assert rows(spark.table(job.table("stations_with_closest"))) == rows(nearest)
        # Gold of earlier runs keeps the neighbours of its time.
        fresh = gold_features(snapshots.select("station_id", "ts", "bikes"), nearest)
        fresh = settle(fresh.exceptAll(before(fresh, known_slots)))
        gold = fresh if gold is None else gold.unionByName(fresh)
        assert rows(spark.table(job.table("gold")).drop("date")) == rows(gold)
        assert rows(spark.table(job.table("label")).drop("date")) == rows(label_table(gold))

    check(27, 0)
    write_documents(folder, dict(scrape(n, moved=0.5 * (n != 33)) for n in range(30, 34)))
    run_all(spark, job, path)
    check(31, 27)
    assert spark.table(job.table("jsons_bronze")).count() == 36
    bad = spark.table(job.table("bad_documents")).collect()
    assert sorted((r.filename, r.fault) for r in bad) == [
        ("2024-03-14T00-05-00Z.json", "malformed"), ("notes.json", "no time"),
    ]
    assert spark.table(job.table("late_readings")).count() == 0
    assert spark.table(job.table("gold_changes")).count() == 0
    properties = spark.sql(f"SHOW TBLPROPERTIES {job.table('gold')}").collect()
    assert ("quality", "gold") in {(r.key, r.value) for r in properties}

    run_models(spark, job)
    run_models(spark, job)
    features = spark.table(job.table("features")).drop("date")
    assert rows(features) == rows(gold)
    versions = spark.table(job.table("models")).groupBy("station_id").count().collect()
    assert {r["count"] for r in versions} == {2} and len(versions) == 7
    current = spark.table(job.table("current_predictions"))
    newest = START + timedelta(minutes=300)
    assert {(r.ts, r.prediction_valid) for r in current.collect()} == {(newest, newest + timedelta(hours=4))}
    assert current.count() == 7 == spark.table(job.table("predictions")).count()


def test_bronze_scan_reads_the_needed_fields_only(spark, tmp_path, folder):
    path = write_documents(folder, dict(scrape(n) for n in range(3)))
    job = Job(schema="narrow_db", checkpoints=str(tmp_path / "ck"))
    ingest_documents(spark, job, path)
    plan = flatten_places(bronze(spark, job, stream=False))._jdf.queryExecution().sparkPlan()
    scan = plan.collectLeaves().head().requiredSchema().json()
    assert "bike_list" not in scan and "terms" not in scan and "maintenance" in scan


def test_late_scrape_within_the_delay_is_kept(spark, tmp_path, folder):
    job = Job(schema="late_db", checkpoints=str(tmp_path / "ck"), delay="30 minutes")
    path = str(folder)
    for batch in ([0, 1, 2], [5], [4, 1], [3, 6], [10]):
        write_documents(folder, dict(scrape(n, 2) for n in batch))
        ingest_documents(spark, job, path)
        refine_snapshots(spark, job)
    kept = spark.table(job.table("snapshots_silver"))
    slots = {int((r.ts - START).total_seconds()) // 600 for r in kept.collect()}
    assert slots == {0, 1, 2, 3, 4, 5, 6}
    assert kept.count() == 14
    # Far behind the watermark now: dropped, and found again by comparison.
    name, content = scrape(0, 3)
    write_documents(folder, {name.replace("00-00Z", "00-30Z"): content})
    ingest_documents(spark, job, path)
    refine_snapshots(spark, job)
    kept = spark.table(job.table("snapshots_silver"))
    assert kept.count() == 14
    refine_stations(spark, job)
    build_gold(spark, job)
    for _ in range(2):  # nothing is taken in twice
        take_in_late(spark, job)
        missed = spark.table(job.table("late_readings"))
        assert [(r.station_id, r.ts) for r in missed.collect()] == [(3, START)]
        assert rows(current(spark, job, "snapshots_silver").drop("date")) == rows(
            before(batch_snapshots(spark, path), 8)
        )


def test_late_minutes_give_the_batch_result(spark, tmp_path, folder):
    """Minutes that come a run or two late: new slots, earlier readings of known slots,
    ones that change nothing, and one for a station that its neighbours list."""
    job = Job(schema="late_minutes_db", checkpoints=str(tmp_path / "ck"))
    late = {(5, 2), (8, 0), (12, 9), (20, 0), (20, 2), (33, 0)}
    times = [(n, m) for n in range(60) for m in (0, 2, 9) if (n + m) % 4 or (n, m) in late]

    def document_of(n, m):
        at = START + timedelta(minutes=10 * n + m)
        places = [place(s, bikes=(7 * n + 3 * m + s) % 13, lat=47.5 + s / 100) for s in range(1, 7)]
        return at.strftime("%Y-%m-%dT%H-%M-%SZ.json"), document(places)

    def drop(some):
        return write_documents(folder, dict(document_of(n, m) for n, m in some))

    path = drop([t for t in times if t[0] < 45 and t not in late])
    run_all(spark, job, path)
    run_models(spark, job)
    drop([t for t in times if t[0] >= 45 and t not in late] + [(12, 9), (20, 2)])
    run_all(spark, job, path)
    drop(sorted(late - {(12, 9), (20, 2)}))
    run_all(spark, job, path)
    run_models(spark, job)
    snapshots = before(batch_snapshots(spark, path), 57)
    assert rows(current(spark, job, "snapshots_silver").drop("date")) == rows(snapshots)
    nearest = nearest_k(station_catalogue(snapshots))
    gold = settle(gold_features(snapshots.select("station_id", "ts", "bikes"), nearest))
    assert rows(current(spark, job, "gold").drop("date")) == rows(gold)
    assert rows(spark.table(job.table("features")).drop("date")) == rows(gold)
    assert rows(spark.table(job.table("label")).drop("date")) == rows(label_table(gold))
    assert spark.table(job.table("late_readings")).count() > 0


def test_backfill_and_streams_give_the_batch_result(spark, tmp_path, folder):
    """A history in batch, then streams from the moment of hand-over: no gap, no overlap."""
    job = Job(schema="backfill_db", checkpoints=str(tmp_path / "ck"))
    path = write_documents(folder, dict(scrape(n, 6, minute=m) for n in range(40) for m in (1, 8)))
    ingest_documents(spark, job, path)
    for _ in range(2):
        backfill(spark, job)
    assert spark.table(job.table("handover")).first()[0] == START + timedelta(minutes=360)
    run_all(spark, job, path)
    write_documents(folder, dict(scrape(n, 6, minute=m) for n in range(40, 55) for m in (0, 5)))
    run_all(spark, job, path)
    run_models(spark, job)
    snapshots = before(batch_snapshots(spark, path), 52)
    assert rows(current(spark, job, "snapshots_silver").drop("date")) == rows(snapshots)
    streamed = spark.table(job.table("snapshots_silver"))
    assert streamed.agg(F.min("ts")).first()[0] == START + timedelta(minutes=360)
    gold = settle(gold_features(snapshots.select("station_id", "ts", "bikes"), nearest_k(station_catalogue(snapshots))))
    assert rows(current(spark, job, "gold").drop("date")) == rows(gold)
    assert rows(spark.table(job.table("features")).drop("date")) == rows(gold)
    assert rows(spark.table(job.table("label")).drop("date")) == rows(label_table(gold))
    assert rows(spark.table(job.table("stations_silver"))) == rows(station_rows(snapshots))
    assert spark.table(job.table("late_readings")).count() == 0
    with pytest.raises(ValueError):
        backfill(spark, job)


def test_chain_holds_no_state_of_gold_and_makes_days_once(spark, tmp_path, folder):
    """Gold keeps no state; few files a day of snapshots; a run's new and changed gold rows
    are one micro-batch of labels; and gold that is there is not appended again."""
    job = Job(schema="days_db", checkpoints=str(tmp_path / "ck"))
    path = write_documents(folder, dict(scrape(n, 40, minute=5) for n in range(12)))
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        run_all(spark, job, path)
        late = (scrape(3, 40, minute=2)[0], scrape(5, 40)[1])
        write_documents(folder, dict([*(scrape(n, 40) for n in range(12, 18)), late]))
        run_all(spark, job, path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    assert not (tmp_path / "ck" / "gold" / "state").exists()
    files = {f.rsplit("/", 1)[1] for f in spark.table(job.table("snapshots_silver")).inputFiles()}
    assert len(files) <= 2 * 8
    assert spark.table(job.table("gold_changes")).count() > 0
    taken = [f for f in (tmp_path / "ck" / "label_days" / "commits").iterdir() if f.name.isdigit()]
    assert len(taken) == 2
    gold = settle(spark.table(job.table("gold")))
    again = Job(schema="days_db", checkpoints=str(tmp_path / "again"))
    build_gold(spark, again)
    assert rows(spark.table(job.table("gold"))) == rows(gold)


def test_labels_on_a_stream(spark, tmp_path, folder):
    """Batch by batch, with a gap, and rows that are held no longer than they must."""
    schema = "station_id long, ts timestamp, bikes long"
    slots = [(s, START + timedelta(minutes=10 * n), (n * s) % 7) for s in (1, 2) for n in range(80) if n % 9]
    path = str(folder / "slots")
    out, state = str(tmp_path / "out"), []
    for part in range(4):
        some = [r for r in slots if 20 * part <= (r[1] - START).total_seconds() / 600 < 20 * part + 20]
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(path)
        stream = label_stream(spark.readStream.schema(schema).parquet(path))
        state += run_once(stream, out, str(tmp_path / "ck"))
    found = spark.read.schema(stream.schema).parquet(out)
    batch = label_table(spark.createDataFrame(slots, schema))
    known = batch.filter(F.col("ts") + F.expr("INTERVAL 14410 SECONDS") < F.lit(START + timedelta(minutes=790)))
    assert rows(found) == rows(known) and found.filter("label IS NULL").count() > 0
    joins = [op for op in state if "Join" in op["operatorName"]]
    assert max(op["numRowsTotal"] for op in joins) < 2 * len(slots)
    assert sum(op["numRowsRemoved"] for op in joins) > 0


def test_labels_on_a_stream_meet_by_blocks_of_time(spark, tmp_path, folder, capsys):
    """Readings at odd times, over the edges of blocks, and one that comes twice; a row is
    compared with those of a block only."""
    schema = "station_id long, ts timestamp, bikes long"
    times = [(s, START + timedelta(milliseconds=1000 * ((n * 397 * s) % 40000) + n)) for s in (1, 2) for n in range(300)]
    read = [(s, t, n % 11) for n, (s, t) in enumerate(times)]
    read += [(1, START, 5), (1, START, 7), (1, START + timedelta(hours=1, seconds=100), 3)]
    read.append((1, START + timedelta(hours=1, seconds=-100), 8))
    path = str(folder / "read")
    spark.createDataFrame(read, schema).coalesce(1).write.parquet(path)
    stream = label_stream(spark.readStream.schema(schema).parquet(path), hours=1, tol_s=100, block_s=1800)
    run_once(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    found = spark.read.schema(stream.schema).parquet(str(tmp_path / "out")).collect()
    end = max(r[1] for r in read)
    known = {r[:2] for r in read if r[1] + timedelta(seconds=3700) < end}
    assert {(r.station_id, r.ts): r.label for r in found}.keys() == known and len(found) == len(known)
    for r in found:
        ahead = [b for s, t, b in read if s == r.station_id and abs((t - r.ts).total_seconds() - 3600) <= 100]
        assert r.label == (pytest.approx(sum(ahead) / len(ahead)) if ahead else None)
    assert sum(r.label is None for r in found) > 0
    stream.explain()
    joins = capsys.readouterr().out.split("StreamingSymmetricHashJoin ")[1:]
    assert len(joins) == 1 and "block" in joins[0].split("]")[0]


def test_archived_files_are_gone_and_not_read_twice(spark, tmp_path, folder):
    job = Job(schema="archive_db", checkpoints=str(tmp_path / "ck"), archive=str(tmp_path / "archive"))
    path = str(folder)
    for n in range(4):
        write_documents(folder, dict([scrape(n, 2)]))
        ingest_documents(spark, job, path)
        ingest_documents(spark, job, path)
    assert spark.table(job.table("jsons_bronze")).count() == 4
    left, moved = list(folder.glob("*.json")), list((tmp_path / "archive").rglob("*.json"))
    assert len(left) + len(moved) == 4 and len(left) <= 1


def test_stream_dedup_equals_batch_and_forgets(spark, tmp_path, folder):
    """Two readings in a slot, the later of which arrives first."""
    documents = [scrape(n, 3, minute=m, moved=m) for n in range(40) for m in (8, 4)]
    path = str(folder)
    kept = dedup_snapshots(
        place_readings(flatten_places(read_snapshot_stream(spark, path, DOCUMENT, max_files=10))),
        "30 minutes",
    )
    out, state = str(tmp_path / "out"), []
    for minute in ("8", "4"):
        write_documents(folder, dict(d for d in documents[:6] if d[0][15] == minute))
        state += run_once(kept, out, str(tmp_path / "ck"))
    write_documents(folder, dict(documents))
    state += run_once(kept, out, str(tmp_path / "ck"))
    assert sum(op["numRowsRemoved"] for op in state) > 0
    assert state[-1]["numRowsTotal"] < 40 * 3
    found = spark.read.schema(kept.schema).parquet(out)
    assert rows(found) == rows(before(batch_snapshots(spark, path), 37))


def run_once(df, out, checkpoint):
    """Run a stream over what there is; the state operators' reports."""
    query = (
        df.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return [op for p in query.recentProgress for op in json.loads(p.json)["stateOperators"]]


def test_stream_slot_counts(spark, tmp_path, folder):
    path = write_documents(folder, dict(scrape(n, 3, minute=m) for n in range(20) for m in (1, 8)))
    docs = read_snapshot_stream(spark, path, DOCUMENT, max_files=6)
    slots = slot_counts(place_readings(flatten_places(docs)), "10 minutes")
    got = run_to_folder(slots, "slots", str(tmp_path / "run"))
    batch = slot_counts(place_readings(flatten_places(read_snapshots(spark, path, DOCUMENT))))
    settled = batch.filter(F.col("ts") <= F.lit(START + timedelta(minutes=10 * 18)))
    assert rows(got) == rows(settled)


def test_gold_stream_does_not_broadcast_its_snapshots(spark, tmp_path, folder):
    """The batch without new data, in which the state passes on all slots; a station
    that has no list, and one without a number."""
    name, content = scrape(30, 3)
    documents = {**dict(scrape(n, 4) for n in range(20)), name: content}
    docs = read_snapshots(spark, write_documents(folder, documents), DOCUMENT)
    nearest = nearest_k(station_catalogue(place_readings(flatten_places(docs))))
    nearest = settle(nearest.filter("station_id <> 3"))

    def readings(docs):
        number = F.when(F.col("station_id") != 4, F.col("station_id"))
        return place_readings(flatten_places(docs)).withColumn("station_id", number)

    slots = slot_counts(readings(read_snapshot_stream(spark, str(folder), DOCUMENT)))
    query = (
        gold_features(slots, nearest)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "LocalTableScan <empty>" in plan and "BuildLeft" not in plan
    batch = gold_features(slot_counts(readings(docs)), nearest)
    found = spark.read.schema(batch.schema).parquet(str(tmp_path / "out"))
    assert found.count() == 2 * 20 and rows(found) == rows(before(batch, 28))


def test_upsert_from_a_stream(spark, tmp_path, folder):
    path = write_documents(folder, dict(scrape(n, 3) for n in range(10)))
    job = Job(schema="upsert_db", checkpoints=str(tmp_path / "ck"))
    ingest_documents(spark, job, path)
    refine_snapshots(spark, job)
    refine_stations(spark, job)
    build_gold(spark, job)
    source = spark.table(job.table("gold")).drop("date")
    assert source.count() == 21
    first = source.filter("station_id = 1").withColumn("bikes", F.lit(99).cast("bigint"))
    create_feature_table(first, job.table("features"), ["station_id", "ts"])
    stream = spark.readStream.table(job.table("gold"))
    upsert_stream(
        with_partition_date(stream.drop("date"), "date", "ts"),
        job.table("features"), ["station_id", "ts"], str(tmp_path / "up"), "features_stream",
    )
    assert rows(spark.table(job.table("features")).drop("date")) == rows(source)
