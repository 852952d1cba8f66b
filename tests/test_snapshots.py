import json
from datetime import datetime

from pyspark.sql import functions as F

from snapflow.operators.snapshots import (
    FIRST_REGULAR_SCRAPE,
    dedup_snapshots,
    first_scrape_per_slot,
    flatten_places,
    place_readings,
    slot_counts,
    untimed_rows,
)
from snapflow.schema import DOCUMENT, READING_DOCUMENT
from snapflow.sources.readers import read_snapshots, rows_at


def place(number, bikes=3, spot=True, bike=False, name=None, lat=47.5, lng=19.0):
    return {
        "number": number, "bikes": bikes, "spot": spot, "bike": bike, "maintenance": False,
        "name": name or f"0{number % 10}01-Somewhere", "lat": lat, "lng": lng,
        "bike_types": {"150": 1, "297": 2, "undefined": 0},
        "bike_list": [{"number": "860001", "active": True, "lock_types": ["frame_lock"]}],
    }


def document(places, country=True):
    if not country:
        return {"countries": []}
    return {"countries": [{"name": "somewhere", "cities": [{"uid": 1, "break": False, "places": places}]}]}


def write_documents(folder, documents):
    for name, content in documents.items():
        (folder / name).write_text(json.dumps(content))
    return str(folder)


def test_schema_holds_all_fields(spark):
    schema = spark.createDataFrame([], DOCUMENT).schema

    def fields(kind):
        if kind.typeName() == "array":
            return fields(kind.elementType)
        if kind.typeName() == "struct":
            return sum(1 + fields(f.dataType) for f in kind.fields)
        return 0

    assert fields(schema) == 93
    place_type = schema["countries"].dataType.elementType["cities"].dataType.elementType["places"]
    assert place_type.dataType.elementType["bike_types"].dataType.names == ["150", "297", "undefined"]


def test_documents_to_readings(spark, tmp_path):
    path = write_documents(
        tmp_path,
        {
            "2024-03-14T01-30-02Z.json": document(
                [place(2100), place(2101, spot=False, bike=True), place(2102, bike=True)]
            ),
            "2024-03-14T01-40-58Z.json": document([place(2100, 5), place(2102, 7)]),
            "2024-03-12T11-00-00Z.json": document([place(2100, 9)]),
            "2024-03-14T02-00-00Z.json": document([]),
            "2024-03-14T02-10-00Z.json": document(None, country=False),
            "broken.json": document([place(2100, 1)]),
        },
    )
    for schema in (DOCUMENT, READING_DOCUMENT, None):
        docs = read_snapshots(spark, path, schema)
        assert docs.count() == 6
        readings = place_readings(flatten_places(docs), FIRST_REGULAR_SCRAPE)
        got = sorted((r.ts, r.station_id, r.bikes) for r in readings.collect())
        assert got == [
            (datetime(2024, 3, 14, 1, 30), 2100, 3),
            (datetime(2024, 3, 14, 1, 40), 2100, 5),
            (datetime(2024, 3, 14, 1, 40), 2102, 7),
        ]
        assert [r.filename for r in untimed_rows(docs).collect()] == ["broken.json"]
    found = rows_at(readings, "station_id", 2100, "ts", "2024-03-14T01:40:00.000+00:00")
    assert [r.bikes for r in found.collect()] == [5]


def readings_frame(spark, rows):
    return spark.createDataFrame(
        [(ts, s, b, False, "01 A", 47.5, 19.0) for ts, s, b in rows],
        "ts string, station_id bigint, bikes bigint, maintenance boolean, "
        "station_name string, lat double, lng double",
    ).withColumn("ts", F.col("ts").cast("timestamp"))


ROWS = [
    ("2024-03-14 01:32:00", 1, 4),
    ("2024-03-14 01:31:00", 1, 9),
    ("2024-03-14 01:31:00", 1, 8),
    ("2024-03-14 01:40:00", 1, 5),
    ("2024-03-14 01:39:00", 2, 6),
]


def test_dedup_keeps_the_earliest_reading_in_any_order(spark):
    found = set()
    for parts in (1, 5):
        for rows in (ROWS, ROWS[::-1]):
            df = readings_frame(spark, rows).repartition(parts)
            for deduped in (dedup_snapshots(df), slot_counts(df)):
                got = sorted((r.ts, r.station_id, r.bikes) for r in deduped.collect())
                assert [g[:2] for g in got] == [
                    (datetime(2024, 3, 14, 1, 30), 1),
                    (datetime(2024, 3, 14, 1, 30), 2),
                    (datetime(2024, 3, 14, 1, 40), 1),
                ]
                assert got[0][2] in (8, 9) and [g[2] for g in got[1:]] == [6, 5]
            found.add(tuple(got))
    assert len(found) == 1  # of two readings of one moment, always the same
    since = dedup_snapshots(readings_frame(spark, ROWS), since="2024-03-14T01:35:00.000+00:00")
    assert since.count() == 2


def test_dedup_takes_all_columns_from_one_reading(spark):
    df = spark.range(2000).selectExpr(
        "timestamp'2024-03-14 01:31:00' AS ts", "id % 20 AS station_id", "id AS bikes",
        "id % 2 = 0 AS maintenance", "cast(id AS string) AS station_name",
        "id / 10 AS lat", "id / 7 AS lng",
    )
    mixed = dedup_snapshots(df).filter(
        "station_name <> bikes OR lat <> bikes / 10 OR maintenance <> (bikes % 2 = 0)"
    )
    assert mixed.count() == 0
    for found in (slot_counts(df), dedup_snapshots(df)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_dedup_keeps_null_names(spark):
    df = readings_frame(spark, ROWS).withColumn("station_name", F.lit(None).cast("string"))
    assert dedup_snapshots(df).filter("station_name is null").count() == 3


def test_first_scrape_keeps_all_its_rows(spark):
    rows = [
        ("2024-03-14 01:31:00", 1, 1),
        ("2024-03-14 01:31:00", 2, 2),
        ("2024-03-14 01:38:00", 3, 3),
        ("2024-03-14 01:48:00", 3, 4),
    ]
    got = first_scrape_per_slot(readings_frame(spark, rows)).collect()
    assert sorted((r.minute, r.station_id) for r in got) == [(30, 1), (30, 2), (40, 3)]
