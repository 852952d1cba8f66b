from pyspark.sql import functions as F

from snapflow.plans.queries import q_json_bad_documents
from snapflow.schema import READING_DOCUMENT
from snapflow.sources.readers import CORRUPT, read_snapshots
from snapflow.sources.tables import settle


def test_malformed_documents_have_the_name_of_their_folder(spark, tmp_path):
    """A file of many documents: one with a name, one without, one malformed."""
    (tmp_path / "day=2024-01-02T03-00-00Z.json").mkdir()
    lines = ['{"countries": [], "scraped": "2024-01-02T03-04-00Z.json"}', '{"countries": []}', '{"countries": [']
    (tmp_path / "day=2024-01-02T03-00-00Z.json" / "part.txt").write_text("\n".join(lines))
    docs = read_snapshots(spark, str(tmp_path), READING_DOCUMENT, folders=True, corrupt=True, named="scraped")
    docs = settle(docs)
    assert sorted((r.filename or "", r[CORRUPT] or "") for r in docs.collect()) == [
        ("", ""),
        ("2024-01-02T03-00-00Z.json", lines[2]),
        ("2024-01-02T03-04-00Z.json", ""),
    ]


def test_bad_documents_are_named(spark, tmp_path):
    """A malformed document has the name of its folder, which follows from the events."""
    at = F.lit("2024-01-05 07:41:13").cast("timestamp_ntz")
    columns = [F.col("id").alias("event_id"), at.alias("ts"), (F.col("id") * 6).alias("user_id")]
    # An event without a time makes a document without a name, which is none of them.
    at = F.when(F.col("id") > 0, at)
    columns[1] = at.alias("ts")
    made = spark.range(3).select(*columns, F.lit("view").alias("event_type"), F.lit(2.0).alias("value"))
    made.write.parquet(f"{tmp_path}/events.parquet")
    named = spark.range(3).selectExpr("id as s_suppkey", "1 as s_nationkey", "'S' as s_name")
    named.write.parquet(f"{tmp_path}/supplier.parquet")
    found = q_json_bad_documents(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in found) == [
        ("2024-01-05T07-00-00Z.json", '{"countries": ['), ("notes", None),
    ]
