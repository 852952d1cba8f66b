"""The chain of streams from documents to gold, and single streams run to their end.

Every stream runs over what has arrived and stops. A next stage reads the table that
the former has written, so a document is parsed once, and each stage can be started
again after a failure: its checkpoint knows what it has taken up.

Only the first stage bounds its micro-batches. A table's files of one write have no
order in time, so a later stage that took them up piece by piece could find its own
watermark ahead of rows still to come; it takes up all new files at once instead. A
long history is therefore better loaded in batch: `backfill` makes the tables up to a
moment that it notes, and the streams go on from there.
"""

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.functions.times import scrape_time, slot_start
from snapflow.operators.features import gold_features
from snapflow.operators.labels import HOURS_AHEAD, feature_columns, label_table, training_set
from snapflow.operators.linear import fit_and_evaluate
from snapflow.operators.models import champions, newest_predictions, predict, register_models
from snapflow.operators.nearest import nearest_k
from snapflow.operators.snapshots import (
    DEFAULT_DELAY,
    FIRST_REGULAR_SCRAPE,
    dedup_snapshots,
    flatten_places,
    place_readings,
)
from snapflow.operators.splits import temporal_split
from snapflow.operators.stations import (
    last_descriptions,
    latest_of,
    station_rows,
    with_district,
)
from snapflow.schema import DOCUMENT, READING_DOCUMENT
from snapflow.sources.readers import (
    CORRUPT,
    read_snapshot_stream,
    read_table_stream,
)
from snapflow.sources.tables import (
    append_rows,
    append_stream,
    create_feature_table,
    ensure_schema,
    overwrite_table,
    replace_partitions,
    reset_table,
    set_quality,
    settle,
    table_location,
    upsert,
    with_partition_date,
)

CATALOGUE = (
    "station_id bigint, seen timestamp, station_name string, lat double, lng double, shard int"
)
CATALOGUE_SHARDS = 16

#: Of a day's snapshots, in how many files a micro-batch writes them.
DAY_SHARDS = 8

#: What the tables of the chain are keyed by.
KEYS = ["station_id", "ts"]


@dataclass(frozen=True)
class Job:
    """Where a chain of streams reads and writes."""

    schema: str
    checkpoints: str
    since: str | None = FIRST_REGULAR_SCRAPE
    delay: str = DEFAULT_DELAY
    neighbours: int = 5
    max_files: int | None = None
    #: Names are those of folders, or lie in this field of each document.
    folders: bool = False
    named: str | None = None
    #: Where files go once they are taken up, so that listing them stays short.
    archive: str | None = None

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.checkpoints.rstrip('/')}/{name}"


def ingest_documents(spark: SparkSession, job: Job, path: str) -> None:
    """New files under `path` into the bronze table."""
    ensure_schema(spark, job.schema)
    docs = read_snapshot_stream(
        spark,
        path,
        DOCUMENT,
        job.max_files,
        folders=job.folders,
        corrupt=True,
        named=job.named,
        archive=job.archive,
    )
    dated = with_partition_date(docs, "date", scrape_time("filename"))
    name = job.table("jsons_bronze")
    append_stream(dated, name, job.checkpoint("jsons_bronze"), "json_stream", "date")
    set_quality(spark, name, "bronze", "Snapshot documents as they came, with file names")


def bronze(spark: SparkSession, job: Job, stream: bool = True) -> DataFrame:
    """The bronze table's file names and their times, dates and the fields that readings need.

    Its files are read with the narrow schema, so that the scan leaves out the rest.
    """
    place = table_location(spark, job.table("jsons_bronze"))
    reader = spark.readStream if stream else spark.read
    kind = f"{READING_DOCUMENT}, {CORRUPT} string, filename string, date date"
    return reader.schema(kind).parquet(place).withColumn("scraped", scrape_time("filename"))


def _readings(docs: DataFrame, job: Job) -> DataFrame:
    return place_readings(flatten_places(docs), job.since, "scraped")


def note_bad_documents(spark: SparkSession, job: Job) -> None:
    """New documents that are malformed, or whose file name holds no time."""
    faults = F.array(
        F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed")),
        F.when(F.col("scraped").isNull(), F.lit("no time")),
    )
    bad = bronze(spark, job).select("filename", F.explode(F.array_compact(faults)).alias("fault"))
    append_stream(bad, job.table("bad_documents"), job.checkpoint("bad_documents"), "bad_stream")


def corrected(log: DataFrame, changes: DataFrame) -> DataFrame:
    """The rows of an append-only table with the newest of `changes`, by station and time,
    in their place. Changes are few beside the table."""
    columns = [c for c in log.columns if c not in KEYS]
    newest = changes.groupBy(*KEYS).agg(F.max_by(F.struct(*columns), "version").alias("to"))
    newest = newest.select(*KEYS, *[F.col("to")[c].alias(c) for c in columns])
    return log.join(newest.select(*KEYS), KEYS, "left_anti").unionByName(newest)


def handover(spark: SparkSession, job: Job):
    """The moment from which on the streams have made the tables; None if always."""
    name = job.table("handover")
    return spark.table(name).first()[0] if spark.catalog.tableExists(name) else None


def backfill(spark: SparkSession, job: Job) -> None:
    """Snapshots, stations, gold and labels of the bronze table's history, in batch.

    The moment of hand-over is the last that a stream would have passed on by now; slots
    from then on are left to the streams, which begin after it. What the batch makes lies
    in tables of its own, which `current` joins with those of the streams. It is done
    once, before the streams; after a failure it may be done again.
    """
    if spark.catalog.tableExists(job.table("snapshots_silver")):
        raise ValueError("the streams have begun")
    docs = bronze(spark, job, stream=False)
    readings = _readings(docs, job)
    newest = readings.agg(F.max(slot_start("ts"))).first()[0]
    if newest is None:
        return
    moment = F.lit(newest) - F.expr(f"INTERVAL {job.delay}")
    moment = spark.range(1).select(slot_start(moment).alias("moment")).first()[0]
    history = dedup_snapshots(readings).filter(F.col("ts") < F.lit(moment))
    silver = job.table("snapshots_silver_backfill")
    overwrite_table(with_partition_date(history, "date", "ts"), silver, "date")
    overwrite_table(station_rows(spark.table(silver)), job.table("stations_silver"))
    overwrite_catalogue(spark, job, last_descriptions(spark.table(silver)))
    update_nearest(spark, job)
    nearest = spark.table(job.table("stations_with_closest"))
    made = gold_features(spark.table(silver).select(*KEYS, "bikes"), nearest, job.neighbours)
    overwrite_table(with_partition_date(made, "date", "ts"), job.table("gold_backfill"), "date")
    gold = spark.table(job.table("gold_backfill")).drop("date")
    for name, rows in (("label", label_table(gold)), ("features", gold)):
        reset_table(spark, job.table(name), name)
        create_feature_table(rows, job.table(name), KEYS)
    noted = spark.createDataFrame([(moment,)], "moment timestamp")
    overwrite_table(noted, job.table("handover"))


def current(spark: SparkSession, job: Job, name: str) -> DataFrame:
    """A table of the chain as it now stands, history and late readings included."""
    log, changes = spark.table(job.table(name)), job.table(f"{name}_changes")
    if handover(spark, job) is not None:
        log = log.unionByName(spark.table(job.table(f"{name}_backfill")))
    if not spark.catalog.tableExists(changes) or spark.table(changes).isEmpty():
        return log
    return corrected(log, spark.table(changes))


def _dates(df: DataFrame, column: str = "date") -> list:
    """The days of a few rows: a line for each to name the partitions to a scan."""
    return [r[0] for r in df.select(column).distinct().collect()]


def _on(df: DataFrame, days: list) -> DataFrame:
    return df.filter(F.col("date").isin(days))


def _unlike(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Those of `rows` that `known` does not have just so; nulls are equal."""
    same = F.lit(True)
    for c in rows.columns:
        same = same & rows[c].eqNullSafe(known[c])
    return rows.join(known, same, "left_anti")


def take_in_late(spark: SparkSession, job: Job) -> None:
    """Readings that came too late for the stream of snapshots, taken in after all.

    The stream has passed their slots on without them. Each new document's readings are
    compared with the snapshots; where a slot differs, it is made again from the documents
    of its day, and with it the gold rows of that moment, of the station and of those that
    list it. What differs goes to tables of changes, which are appended to: `current`
    joins them to the tables. Done twice, it changes nothing. Only new documents, and the
    days that they belong to, are read.
    """

    def take(batch: DataFrame, version: int) -> None:
        session = batch.sparkSession
        fresh = with_partition_date(dedup_snapshots(_readings(batch, job)), "date", "ts")
        met_days = _dates(with_partition_date(batch.drop("date"), "date", slot_start("scraped")))
        # Slots after the newest that was passed on still wait for the watermark.
        known = current(session, job, "snapshots_silver")
        newest = known.agg(F.max("ts")).first()[0]
        passed = fresh.filter(F.col("ts") <= F.lit(newest))
        suspects = settle(_unlike(passed, _on(known, met_days).select(*passed.columns)), "suspects")
        days = _dates(suspects)
        if not days:
            return
        docs = _on(bronze(session, job, stream=False), days)
        whole = with_partition_date(dedup_snapshots(_readings(docs, job)), "date", "ts")
        right = whole.join(suspects.select(*KEYS), KEYS, "left_semi").select(*passed.columns)
        late = settle(_unlike(right, _on(known, days).select(*right.columns)), "late")
        append_rows(late.withColumn("version", F.lit(version)), job.table("snapshots_silver_changes"))
        append_rows(late.select(*KEYS), job.table("late_readings"))

        moments = suspects.select("ts").distinct()
        met = _on(current(session, job, "snapshots_silver"), days).join(moments, "ts", "left_semi")
        nearest = session.table(job.table("stations_with_closest"))
        made = gold_features(met.select(*KEYS, "bikes"), nearest, job.neighbours)
        gold = current(session, job, "gold")
        made = with_partition_date(made, "date", "ts").select(*gold.columns)
        moved = _unlike(made, _on(gold, days))
        # Neighbours of other days stay as they were: only what the late rows touch moves.
        lists = nearest.select("station_id", F.explode("closest_stations").alias("listed"))
        reach = lists.unionByName(nearest.select("station_id", F.col("station_id").alias("listed")))
        touched = suspects.select(F.col("station_id").alias("listed"), "ts").join(reach, "listed")
        moved = settle(moved.join(touched.select(*KEYS), KEYS, "left_semi"), "moved")
        append_rows(moved.withColumn("version", F.lit(version)), job.table("gold_changes"))

    for name in ("snapshots_silver", "gold"):
        log = spark.table(job.table(name))
        if not spark.catalog.tableExists(job.table(f"{name}_changes")):
            empty = log.limit(0).withColumn("version", F.lit(0).cast("bigint"))
            append_rows(empty, job.table(f"{name}_changes"))
    append_rows(spark.table(job.table("gold")).limit(0).select(*KEYS), job.table("late_readings"))
    _each_batch(bronze(spark, job), "late_stream", job.checkpoint("late_readings"), take)
    for name in ("snapshots_silver_changes", "gold_changes", "late_readings"):
        spark.catalog.refreshTable(job.table(name))


def _each_batch(source: DataFrame, name: str, checkpoint: str, take) -> None:
    """Give what a stream holds now to `take`, and wait for its end."""
    query = (
        source.writeStream.queryName(name)
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(take)
        .start()
    )
    query.awaitTermination()


def refine_snapshots(spark: SparkSession, job: Job) -> None:
    """New documents into snapshots, partitioned by date."""
    docs = bronze(spark, job)
    readings = _readings(docs, job)
    moment = handover(spark, job)
    if moment is not None:
        readings = readings.filter(F.col("ts") >= F.lit(moment))
    dated = with_partition_date(dedup_snapshots(readings, job.delay), "date", "ts")
    # Else each part of the state writes a file for each day, which all that follows lists.
    shard = F.pmod(F.xxhash64("station_id"), F.lit(DAY_SHARDS))
    dated = dated.repartition("date", shard)
    name = job.table("snapshots_silver")
    append_stream(dated, name, job.checkpoint("snapshots_silver"), "snapshot_stream", "date")
    set_quality(spark, name, "silver", "One row per station and ten-minute slot")


def refine_stations(spark: SparkSession, job: Job) -> None:
    """New descriptions of stations; each station's nearest others, if any place is new.

    A description is new if the table does not have it, so nothing is kept in a stream's
    state.
    """
    name = job.table("stations_silver")
    if not spark.catalog.tableExists(name):
        append_rows(station_rows(spark.table(job.table("snapshots_silver")).limit(0)), name)

    def take_in(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        append_rows(settle(_unlike(station_rows(batch), session.table(name)), "descriptions"), name)

    source = read_table_stream(spark, job.table("snapshots_silver"))
    _each_batch(source, "stations_stream", job.checkpoint("stations_silver"), take_in)
    spark.catalog.refreshTable(name)
    set_quality(spark, name, "silver", "Distinct descriptions of stations")
    update_catalogue(spark, job)
    update_nearest(spark, job)


def update_nearest(spark: SparkSession, job: Job) -> None:
    """Nearest stations anew, where a station is new or has moved since the last time."""
    places = spark.table(job.table("station_catalogue")).select("station_id", "lat", "lng")
    known, name = job.table("searched_places"), job.table("stations_with_closest")
    if spark.catalog.tableExists(known) and spark.catalog.tableExists(name):
        if _unlike(places, spark.table(known)).isEmpty():
            return
    catalogue = with_district(spark.table(job.table("station_catalogue")))
    overwrite_table(nearest_k(catalogue, job.neighbours), name)
    overwrite_table(settle(places, "places"), known)


def _shard():
    return F.pmod(F.xxhash64("station_id"), F.lit(CATALOGUE_SHARDS)).cast("int")


def overwrite_catalogue(spark: SparkSession, job: Job, seen: DataFrame) -> None:
    """The table of each station's latest description, from `last_descriptions`."""
    overwrite_table(seen.withColumn("shard", _shard()), job.table("station_catalogue"), "shard")


def update_catalogue(spark: SparkSession, job: Job) -> None:
    """Take new snapshots into the table of each station's latest description.

    Only new snapshots are read. Each micro-batch is reduced to a row per station,
    set against the known rows, and upserted; done twice, it changes nothing.
    """
    name = job.table("station_catalogue")
    if not spark.catalog.tableExists(name):
        overwrite_catalogue(spark, job, spark.createDataFrame([], CATALOGUE).drop("shard"))

    def take_in(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        fresh = last_descriptions(batch)
        known = session.table(name).join(fresh, "station_id", "left_semi").drop("shard")
        latest = latest_of(fresh.unionByName(known)).withColumn("shard", _shard())
        upsert(session, name, settle(latest, "catalogue"), ["station_id"], "shard")

    source = read_table_stream(spark, job.table("snapshots_silver"))
    _each_batch(source, "catalogue_stream", job.checkpoint("station_catalogue"), take_in)
    spark.catalog.refreshTable(name)  # a stream writes in a session of its own


def build_gold(spark: SparkSession, job: Job) -> None:
    """New snapshots into feature rows.

    The stream of snapshots passes a slot on once and whole, and a micro-batch here takes
    up all that it has written, so that each has all rows of its moments: no state is
    held. Rows that gold has, after a failure, are not appended again.
    """
    name = job.table("gold")
    if not spark.catalog.tableExists(name):
        snapshots = spark.table(job.table("snapshots_silver"))
        kind = _gold_of(spark, job, snapshots).schema
        overwrite_table(spark.createDataFrame([], kind), name, "date")

    def take(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        made = _gold_of(session, job, batch)
        known = _on(session.table(name), _dates(batch))
        if not known.isEmpty():
            made = made.join(known.select(*KEYS), KEYS, "left_anti").select(*known.columns)
        append_rows(made.hint("rebalance", "date"), name, "date")

    source = read_table_stream(spark, job.table("snapshots_silver"))
    _each_batch(source, "gold_stream", job.checkpoint("gold"), take)
    spark.catalog.refreshTable(name)
    set_quality(spark, name, "gold", "Features per station and slot")


def _gold_of(spark: SparkSession, job: Job, snapshots: DataFrame) -> DataFrame:
    nearest = spark.table(job.table("stations_with_closest"))
    made = gold_features(snapshots.select(*KEYS, "bikes"), nearest, job.neighbours)
    return with_partition_date(made, "date", "ts")


def _each_changed_day(spark: SparkSession, job: Job, name: str, take) -> None:
    """Give the days of gold rows that are new or changed to `take`, once for all of them.

    `name` is that of the table that follows from gold, whose days `take` makes again.
    """

    def days_of(batch: DataFrame, _: int) -> None:
        days = _dates(batch)
        if days:
            take(batch.sparkSession, days)

    new, changed = (read_table_stream(spark, job.table(x)) for x in ("gold", "gold_changes"))
    days = new.select("date").unionByName(changed.select("date"))
    _each_batch(days, f"{name}_days", job.checkpoint(f"{name}_days"), days_of)
    spark.catalog.refreshTable(job.table(name))


def build_labels(spark: SparkSession, job: Job) -> None:
    """Labels of new and changed gold rows, and of the rows that look ahead to them.

    The labels of their days, and of the days before, follow from gold as it now stands;
    they are made again in one pass and put in the place of those days, and of gold only
    these days and those beside them are read.
    """
    name = job.table("label")
    if not spark.catalog.tableExists(name):
        empty = spark.table(job.table("gold")).limit(0)
        create_feature_table(label_table(empty), name, KEYS)

    def take(session: SparkSession, changed: list) -> None:
        days = sorted({d - timedelta(days=n) for d in changed for n in (0, 1)})
        gold = _on(current(session, job, "gold"), sorted({d + timedelta(days=n) for d in days for n in (0, 1)}))
        labels = _on(with_partition_date(label_table(gold), "date", "ts"), days)
        replace_partitions(session, name, labels, days, keys=KEYS)

    _each_changed_day(spark, job, "label", take)


def build_features(spark: SparkSession, job: Job) -> None:
    """New and changed gold rows into the keyed feature table.

    Its days are those of gold as it now stands, so the days of such rows are put in the
    place of the former.
    """
    name, gold = job.table("features"), job.table("gold")
    if not spark.catalog.tableExists(name):
        create_feature_table(spark.table(gold).drop("date").limit(0), name, KEYS)

    def take(session: SparkSession, days: list) -> None:
        replace_partitions(session, name, _on(current(session, job, "gold"), days), days, keys=KEYS)

    _each_changed_day(spark, job, "features", take)


def train_models(spark: SparkSession, job: Job) -> None:
    """A new version of each station's model, from all features and labels."""
    labels = spark.table(job.table("label")).drop("date")
    rows = settle(training_set(spark.table(job.table("features")).drop("date"), labels), "training")
    fitted = fit_and_evaluate(temporal_split(rows), "station_id", feature_columns(rows))
    name = job.table("models")
    known = spark.table(name) if spark.catalog.tableExists(name) else None
    append_rows(settle(register_models(fitted, known), "models"), name)


def forecast(spark: SparkSession, job: Job) -> None:
    """The champions' forecasts from the newest features: appended to all predictions,
    and in place of the current ones."""
    features = spark.table(job.table("features"))
    day = features.agg(F.max("date")).first()[0]
    newest = newest_predictions(features.filter(F.col("date") == F.lit(day))).drop("date")
    models = settle(champions(spark.table(job.table("models"))), "champions")
    xs = feature_columns(newest)
    made = settle(predict(newest, models, xs), "predictions")
    name = job.table("predictions")
    if spark.catalog.tableExists(name):
        known = spark.table(name).select("station_id", "ts")
        append_rows(made.join(known, ["station_id", "ts"], "left_anti"), name)
    else:
        append_rows(made, name)
    overwrite_table(made, job.table("current_predictions"))


def run_all(spark: SparkSession, job: Job, path: str) -> None:
    """From new documents to gold and labels."""
    ingest_documents(spark, job, path)
    refine_snapshots(spark, job)
    refine_stations(spark, job)
    build_gold(spark, job)
    take_in_late(spark, job)
    build_labels(spark, job)
    note_bad_documents(spark, job)


def run_models(spark: SparkSession, job: Job) -> None:
    """From gold and labels to models and current forecasts."""
    build_features(spark, job)
    train_models(spark, job)
    forecast(spark, job)


def run_to_folder(df: DataFrame, name: str, folder: str) -> DataFrame:
    """Run a stream over what there is, into parquet under `folder`; read it back."""
    query = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .queryName(name)
        .trigger(availableNow=True)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .start(f"{folder}/rows")
    )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/rows")

