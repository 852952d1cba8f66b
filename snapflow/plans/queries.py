"""The registered queries: each operator over the whole driver tables."""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow import domain
from snapflow.functions.times import calendar_columns, scrape_time, slot_start
from snapflow.operators import checks
from snapflow.operators.asof import asof_join
from snapflow.operators.features import gold_features, neighbour_bikes
from snapflow.operators.labels import (
    feature_columns,
    label_ahead,
    label_stream,
    label_table,
    labelled_gold,
    training_set,
)
from snapflow.operators.linear import fit_and_evaluate, fit_line, fit_linear, linear_value
from snapflow.operators.metrics import log_runs, regression_metrics
from snapflow.operators.models import (
    champions,
    newest_predictions,
    predict,
    register_models,
    with_validity,
)
from snapflow.operators.nearest import nearest_k, station_distances, with_closest
from snapflow.operators.search import (
    best_candidate,
    mean_scores,
    random_candidates,
    ridge_fold_scores,
)
from snapflow.operators.snapshots import (
    dedup_snapshots,
    first_scrape_per_slot,
    flatten_places,
    place_readings,
    slot_counts,
    untimed_rows,
)
from snapflow.operators.splits import forward_folds, hash_split, temporal_split
from snapflow.operators.station_trees import (
    HELD_OUT,
    REFIT,
    UNIT,
    Trees,
    evaluate_and_refit_trees,
    fit_station_trees,
    predict_station_trees,
    register_station_trees,
    search_station_trees,
    station_trees_champion,
)
from snapflow.operators.stations import station_catalogue, station_rows
from snapflow.schema import DOCUMENT, READING_DOCUMENT
from snapflow.sources.readers import (
    corrupt_documents,
    key_history,
    read_snapshots,
    read_table,
    read_table_stream,
    rows_at,
)
from snapflow.sources.tables import (
    append_rows,
    append_stream,
    create_feature_table,
    create_table,
    merge_rows,
    overwrite_table,
    reset_table,
    set_quality,
    settle,
    shared_folder,
    upsert,
    with_partition_date,
)
from snapflow.streaming.jobs import (
    Job,
    backfill,
    current,
    ingest_documents,
    run_all,
    run_models,
    run_to_folder,
)

Query = Callable[[SparkSession, str], DataFrame]

FEATURES = [
    "bikes", "weekday", "hour", "tenminute", *[f"close_bikes_{i}" for i in range(1, 6)],
]
PENALTIES = [0.0, 100.0, 1000.0, 10000.0, 100000.0]
FOLDS = 5
DELAY = "30 minutes"


def as_text(col: str):
    return F.concat_ws(",", F.col(col).cast("array<string>")).alias(col)


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def date_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.col("date").cast("string"))


# The tables of the chain. A dimension is settled before facts are joined with it,
# and gold is settled where more than one step reads it.


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_snapshots(domain.readings(spark, sf))


def fact_slots(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots without descriptions, for steps that need none."""
    return slot_counts(domain.counts(domain.events(spark, sf))).select(
        "station_id", "ts", "bikes", "maintenance"
    )


def stations(spark: SparkSession, sf: str) -> DataFrame:
    return settle(station_catalogue(domain.readings(spark, sf)), "stations")


def nearest(spark: SparkSession, sf: str) -> DataFrame:
    return settle(nearest_k(stations(spark, sf)), "nearest")


def gold(spark: SparkSession, sf: str) -> DataFrame:
    return gold_features(fact_slots(spark, sf), nearest(spark, sf))


def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    features = settle(gold(spark, sf), "gold")
    return training_set(features, label_table(features))


# Snapshots


def q_flatten_places(spark, sf):
    return flatten_places(domain.documents(spark, sf)).select(
        "filename",
        F.col("place.number").alias("station_id"),
        F.col("place.bikes").alias("bikes"),
        F.col("place.maintenance").alias("maintenance"),
        F.col("place.name").alias("station_name"),
    )


def q_place_readings(spark, sf):
    return place_readings(
        flatten_places(domain.documents(spark, sf)), since="2024-01-10T12:00:00.000+00:00"
    )


def q_ten_minute_floor(spark, sf):
    return domain.events(spark, sf).select(
        "event_id",
        F.date_trunc("minute", "ts").alias("minute_ts"),
        slot_start("ts").alias("slot_ts"),
    )


def q_filename_timestamp(spark, sf):
    name = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH-mm-ss"), F.lit("Z.json"))
    broken = F.when(F.col("event_type") == "error", F.lit("scrape-failed.json"))
    return domain.events(spark, sf).select(
        "event_id", scrape_time(F.coalesce(broken, name)).alias("scraped")
    )


def q_dedup_station_slot(spark, sf):
    return snapshots(spark, sf).drop("lat", "lng")


def q_first_scrape_per_slot(spark, sf):
    minute = domain.readings(spark, sf).withColumn("ts", F.date_trunc("minute", "ts"))
    found = first_scrape_per_slot(minute)
    return date_as_text(found).select("date", "hour", "minute", "ts", "station_id", "bikes")


def q_slot_counts(spark, sf):
    return date_as_text(slot_counts(domain.counts(domain.events(spark, sf))))


# Stations


def q_station_rows(spark, sf):
    return rounded(station_rows(snapshots(spark, sf)), 5, "lat", "lng")


def q_station_catalogue(spark, sf):
    return rounded(station_catalogue(domain.readings(spark, sf)), 5, "lat", "lng")


def q_distances_ordered(spark, sf):
    return station_distances(domain.customer_stations(spark, sf))


def q_distances_unordered(spark, sf):
    return station_distances(domain.customer_stations(spark, sf), ordered=False)


def q_nearest_five(spark, sf):
    return nearest_k(stations(spark, sf)).select("station_id", as_text("closest_stations"))


def q_nearest_five_grid(spark, sf):
    found = nearest_k(domain.customer_stations(spark, sf))
    return found.select("station_id", as_text("closest_stations"))


def q_stations_with_closest(spark, sf):
    known = stations(spark, sf)
    return with_closest(known, nearest_k(known)).select(
        "station_id", "station_name", "district", as_text("closest_stations")
    )


def q_neighbour_list_length(spark, sf):
    return checks.check_list_length(
        nearest_k(domain.customer_stations(spark, sf)), "closest_stations", 5
    )


def q_neighbour_list_sizes(spark, sf):
    """How many neighbours stations have."""
    return checks.list_length(nearest_k(domain.customer_stations(spark, sf)), "closest_stations")


# Features and labels


def q_neighbour_bikes(spark, sf):
    return neighbour_bikes(fact_slots(spark, sf), nearest(spark, sf))


def q_calendar_columns(spark, sf):
    return calendar_columns(domain.events(spark, sf).select("event_id", "ts"))


def q_gold_features(spark, sf):
    return gold(spark, sf)


def q_label_4h(spark, sf):
    return label_table(fact_slots(spark, sf))


def q_label_4h_events(spark, sf):
    """The label at the readings' own times, many of them within one frame."""
    readings = domain.events(spark, sf).select(
        "event_id", "event_type", "ts", "value"
    )
    labelled = label_ahead(
        readings, key="event_type", value="value", tol_s=600, one_per_moment=False
    )
    return labelled.select("event_id", F.round("label", 4).alias("label"))


def q_gold_with_label(spark, sf):
    return labelled_gold(gold(spark, sf))


def q_training_join(spark, sf):
    return training_rows(spark, sf)


def q_asof_features(spark, sf):
    seen = domain.events(spark, sf)
    bought = seen.filter(F.col("event_type") == "purchase").select(
        "user_id", "ts", "event_id", "value"
    )
    viewed = seen.filter(F.col("event_type") == "view").select(
        "user_id",
        "ts",
        F.col("event_id").alias("view_id"),
        F.col("value").alias("view_value"),
    )
    return asof_join(bought, viewed, "user_id", "ts")


def q_asof_training_set(spark, sf):
    features = settle(gold(spark, sf), "gold")
    rows = asof_join(
        label_table(features), features.drop("weekday"), "station_id", "ts", exclude=("ts",)
    )
    return rows.filter(F.col("label").isNotNull()).na.drop(how="any")


# Keyed tables


def _base_and_updates(spark, sf):
    slots = fact_slots(spark, sf)
    base = slots.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp"))
    updates = slots.filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp"))
    return base, updates.withColumn("bikes", F.col("bikes") + 1000)


def q_feature_upsert(spark, sf):
    base, updates = _base_and_updates(spark, sf)
    return merge_rows(base, updates, ["station_id", "ts"])


def q_feature_upsert_table(spark, sf):
    base, updates = _base_and_updates(spark, sf)
    folder = shared_folder(spark, "features")
    table = "features_" + folder[-32:]
    keys = ["station_id", "ts"]
    create_feature_table(base, table, keys, path=folder)
    upsert(spark, table, settle(with_partition_date(updates, "date", "ts")), keys)
    return spark.table(table).drop("date")


# Splits, models and search


def q_temporal_split(spark, sf):
    return temporal_split(fact_slots(spark, sf)).select("station_id", "ts", "is_train")


def q_hash_split(spark, sf):
    return hash_split(fact_slots(spark, sf), ["station_id", "ts"]).select(
        "station_id", "ts", "is_train"
    )


def q_forward_folds(spark, sf):
    return forward_folds(fact_slots(spark, sf), folds=FOLDS).select("station_id", "ts", "chunk")


def labelled_slots(spark, sf):
    return label_ahead(fact_slots(spark, sf)).filter(F.col("label").isNotNull())


def q_persistence_metrics(spark, sf):
    found = regression_metrics(labelled_slots(spark, sf), ["station_id"], "label", "bikes")
    return rounded(found, 4, "r2", "mse", "rmse")


def q_linear_fit_per_station(spark, sf):
    found = fit_line(labelled_slots(spark, sf), "station_id", "bikes", "label")
    return rounded(found, 4, "slope", "intercept", "r2")


def q_linear_fit_shifted(spark, sf):
    """Fits of values far from 0, which must cost no precision."""
    far = labelled_slots(spark, sf).select(
        "station_id", (F.col("bikes") + 1e7).alias("x"), (F.col("label") + 1e7).alias("label")
    )
    split = far.withColumn("is_train", F.lit(True)).unionByName(
        far.withColumn("is_train", F.lit(False))
    )
    # Tested on what it has learned, a line's r2 is that of its regression.
    found = fit_and_evaluate(split, "station_id", ["x"]).select(
        "station_id",
        (F.col("row_count") / 2).cast("bigint").alias("row_count"),
        F.get("coefficients", F.lit(1)).alias("slope"),
        "r2",
    )
    return rounded(found.filter("slope != 0"), 4, "slope", "r2")


def q_linear_holdout_metrics(spark, sf):
    split = temporal_split(settle(labelled_slots(spark, sf)))
    found = fit_and_evaluate(split, "station_id", ["bikes"])
    return rounded(
        found.select(
            "station_id",
            "row_count",
            "r2",
            "mse",
            "rmse",
            F.get("coefficients", F.lit(0)).alias("intercept"),
            F.get("coefficients", F.lit(1)).alias("slope"),
        ),
        4, "r2", "mse", "rmse", "intercept", "slope",
    )


def q_linear_models(spark, sf):
    """All features at once: what a fit on all rows leaves. Its residuals sum to 0, and so
    do their products with each feature, over the rows of each station."""
    rows = settle(training_rows(spark, sf))
    split = temporal_split(rows)
    xs = feature_columns(rows)
    models = settle(fit_and_evaluate(split, "station_id", xs), "models")
    joined = rows.join(models.select("station_id", "coefficients"), "station_id")
    rest = joined.withColumn("rest", F.col("label") - linear_value(xs))
    sums = rest.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        *[
            (F.round(F.sum(F.col("rest") * F.col(x)), 4) + 0.0).alias(f"rest_{x}")
            for x in ["bikes", "weekday", "hour", "tenminute"]
        ],
        (F.round(F.sum("rest"), 4) + 0.0).alias("rest_sum"),
    )
    return sums


def _fold_scores(spark, sf):
    chunked = forward_folds(settle(labelled_slots(spark, sf)), folds=FOLDS)
    return ridge_fold_scores(chunked, "station_id", ["bikes"], "label", PENALTIES)


def q_forward_fold_scores(spark, sf):
    return rounded(_fold_scores(spark, sf), 4, "r2", "rmse")


def q_best_candidate(spark, sf):
    means = mean_scores(_fold_scores(spark, sf), ["station_id", "penalty"])
    return rounded(best_candidate(means, ["station_id"], "penalty"), 4, "rmse")


def _linear_predictions(spark, sf):
    models = fit_linear(labelled_slots(spark, sf), ["station_id"], ["bikes"])
    return predict(fact_slots(spark, sf), settle(models, "models"), ["bikes"])


def q_predict_linear(spark, sf):
    return rounded(_linear_predictions(spark, sf), 4, "prediction").drop("prediction_bikes")


def q_newest_predictions(spark, sf):
    written = settle(_linear_predictions(spark, sf), "predictions")
    return rounded(newest_predictions(written), 4, "prediction").drop("prediction_bikes")


def q_champion_models(spark, sf):
    """Models of each week's rows, the newest of which is the champion."""
    rows = labelled_slots(spark, sf).withColumn("week", F.weekofyear("ts"))
    fitted = fit_linear(rows, ["station_id", "week"], ["bikes"])
    models = fitted.withColumn("version", F.col("week")).drop("week")
    return champions(models).select(
        "station_id",
        "version",
        "alias",
        "row_count",
        F.round(F.get("coefficients", F.lit(0)), 4).alias("intercept"),
        F.round(F.get("coefficients", F.lit(1)), 4).alias("slope"),
    )


def q_registered_versions(spark, sf):
    """A second fit of the stations seen late in the month gets the next version."""
    rows = settle(labelled_slots(spark, sf))
    first = register_models(fit_linear(rows, ["station_id"], ["bikes"]))
    late = rows.filter(F.col("ts") >= F.lit("2024-01-29").cast("timestamp"))
    second = register_models(fit_linear(late, ["station_id"], ["bikes"]), first)
    columns = ["station_id", "version", "row_count"]
    return first.select(*columns).unionByName(second.select(*columns))


def q_runs_log(spark, sf):
    found = regression_metrics(labelled_slots(spark, sf), ["station_id"], "label", "bikes")
    return rounded(log_runs(found, "persistence", ["station_id"]), 4, "value")


def q_runs_with_parameters(spark, sf):
    """Runs with what they were given, and when."""
    found = regression_metrics(labelled_slots(spark, sf), ["station_id"], "label", "bikes")
    told = log_runs(found, "persistence", ["station_id"], {"hours": 4, "tolerance_s": 10}, datetime(2024, 2, 1))
    given = F.map_entries("parameters")
    return rounded(told, 4, "value").select(
        *["run_name", "station_id", "metric", "value", "run_at"],
        F.array_join(F.transform(given, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("int"))), ",").alias(
            "parameters"
        ),
    )


def _tree_rows(spark, sf):
    """Gold rows, and the training rows among them with their temporal split."""
    features = settle(gold(spark, sf), "gold")
    rows = settle(training_set(features, label_table(features)), "training")
    return features, settle(temporal_split(rows), "split")


def q_boosted_trees(spark, sf):
    """Quality of each station's tuned trees on the last fifth of its rows."""
    return evaluate_and_refit_trees(_tree_rows(spark, sf)[1], FEATURES)[0]


def q_boosted_station_metrics(spark, sf):
    """Rows that each station's trees learned from and were tested on, and whether they are
    nearer to what they learned than its mean is, or it can not be split."""
    _, split = _tree_rows(spark, sf)
    quality, model = evaluate_and_refit_trees(split, FEATURES)
    learned = split.filter("is_train").withColumn("fit", F.lit(HELD_OUT))
    told = predict_station_trees(learned, model)
    error = regression_metrics(told, ["station_id"], "label", "prediction")
    error = error.selectExpr("station_id", "row_count as learned", "r2 > 1e-9 as lower")
    split_roots = model.of(HELD_OUT).nodes.filter("tree = 0 and node = 1").select("station_id", F.lit(True).alias("splits"))
    joined = error.join(split_roots, "station_id", "left").join(
        quality.select("station_id", F.col("row_count").alias("tested")), "station_id", "left"
    )
    return joined.selectExpr(
        "station_id", "learned", "coalesce(tested, 0L) as tested",
        "coalesce(lower, false) = coalesce(splits, false) as fits",
    )


def q_boosted_first_splits(spark, sf):
    """How the first tree of each station, over all its rows, splits its root."""
    rows = _tree_rows(spark, sf)[1].withColumn("fit", F.lit(0))
    model = fit_station_trees(rows, FEATURES, [Trees(0, trees=1)])
    return model.nodes.filter("node = 1").select(
        "station_id",
        "feature",
        "cut",
        F.round(F.col("gain") * UNIT * UNIT, 3).alias("gain"),
        F.col("n").alias("row_count"),
        F.col("left_n").alias("left_count"),
    )


def _forecast_trees(spark, sf):
    """Quality, models, and the gold rows as the refitted models forecast them."""
    features, split = _tree_rows(spark, sf)
    quality, model = evaluate_and_refit_trees(split, FEATURES)
    asked = features.withColumn("fit", F.lit(REFIT))
    return quality, model, asked


def q_boosted_predictions(spark, sf):
    _, model, asked = _forecast_trees(spark, sf)
    return with_validity(predict_station_trees(asked, model).select("station_id", "ts", "prediction"))


def q_boosted_reloaded(spark, sf):
    """Forecasts of the champion, loaded from where it was registered, less those of the
    model in memory."""
    quality, model, asked = _forecast_trees(spark, sf)
    models = settle(register_station_trees(spark, model, quality, "boosted"))
    again = station_trees_champion(spark, models, "boosted")
    before = predict_station_trees(asked, model).withColumnRenamed("prediction", "before")
    return with_validity(predict_station_trees(before, again)).select(
        "station_id",
        "ts",
        "prediction_valid",
        (F.col("prediction") - F.col("before")).alias("difference"),
    )


def q_boosted_search(spark, sf):
    """The search over the whole space of parameters: rows that each trial was tested on in
    each fold, and whether its mean error is below that of the best candidate."""
    _, split = _tree_rows(spark, sf)
    chunked = settle(forward_folds(split.drop("is_train"), folds=FOLDS), "chunks")
    scores = settle(search_station_trees(chunked, FEATURES, random_candidates(spark)), "scores")
    means = mean_scores(scores, ["trial"])
    best = best_candidate(means, [], "trial").select(F.col("rmse").alias("best"))
    judged = scores.join(means.select("trial", F.col("rmse").alias("mean")), "trial").join(F.broadcast(best))
    return judged.select("trial", "fold", "row_count", (F.col("mean") < F.col("best")).alias("below_best"))


# Checks and lookups


def q_null_profile(spark, sf):
    return checks.null_profile(gold(spark, sf))


def q_duplicate_keys(spark, sf):
    readings = domain.counts(domain.events(spark, sf)).withColumn("ts", slot_start("ts"))
    return checks.check_unique(readings, ["station_id", "ts"])


def q_one_station_history(spark, sf):
    return key_history(fact_slots(spark, sf), "station_id", 21)


# Streams


def q_stream_dedup(spark, sf):
    source = domain.readings(spark, sf, domain.event_stream(spark, sf))
    kept = dedup_snapshots(source, DELAY)
    found = run_to_folder(kept, "stream_dedup", shared_folder(spark, "stream"))
    return rounded(found, 5, "lat", "lng")


def q_stream_stations(spark, sf):
    source = domain.readings(spark, sf, domain.event_stream(spark, sf))
    found = run_to_folder(
        station_rows(source), "stream_stations", shared_folder(spark, "stream")
    )
    return rounded(found, 5, "lat", "lng")


def q_stream_slot_counts(spark, sf):
    slots = slot_counts(domain.counts(domain.event_stream(spark, sf)), DELAY)
    found = run_to_folder(slots, "stream_slot_counts", shared_folder(spark, "stream"))
    return date_as_text(found)


def q_stream_gold(spark, sf):
    slots = slot_counts(domain.counts(domain.event_stream(spark, sf)), DELAY)
    features = gold_features(slots, nearest(spark, sf))
    return run_to_folder(features, "stream_gold", shared_folder(spark, "stream"))


# From JSON files to gold, labels and forecasts


def _json_folder(spark, sf):
    folder = shared_folder(spark, "json")
    domain.write_documents(spark, sf, folder)
    return folder


def q_json_readings(spark, sf):
    """Documents read from JSON files with the whole schema."""
    docs = read_snapshots(spark, _json_folder(spark, sf), DOCUMENT, named=domain.NAMED)
    return rounded(place_readings(flatten_places(docs)), 5, "lat", "lng")


def q_json_bad_documents(spark, sf):
    docs = settle(
        read_snapshots(
            spark,
            _json_folder(spark, sf),
            READING_DOCUMENT,
            folders=True,
            corrupt=True,
            named=domain.NAMED,
        ),
        "parsed",
    )
    timed = docs.filter(F.col("filename").isNotNull())
    return corrupt_documents(docs).unionByName(
        untimed_rows(timed).withColumn("corrupt_document", F.lit(None).cast("string"))
    )


def q_json_inferred(spark, sf):
    """Documents read from JSON files whose schema Spark has found out."""
    docs = read_snapshots(spark, _json_folder(spark, sf), folders=True)
    named = docs.filter(F.col(domain.NAMED).isNotNull()).drop("filename")
    readings = place_readings(flatten_places(named.withColumnRenamed(domain.NAMED, "filename")))
    return rounded(readings, 5, "lat", "lng")


#: The chain's days before this one are its history.
HISTORY = "2024-01-11"

_CHAINS: dict[tuple, Job] = {}


def _files(spark, sf, *names: str) -> tuple:
    """The files of tables, and when each was written."""
    found = set()
    for name in names:
        meta = domain.table(spark, sf, name).select("_metadata.file_path", "_metadata.file_modification_time")
        found |= {tuple(r) for r in meta.distinct().collect()}
    return tuple(sorted(found))


def _chain(spark, sf) -> Job:
    """The chain over the JSON files, in tables of its own: the first days in batch, a run
    of the streams over the others, and another when the documents that are late have
    come, also of the first days. The tables are kept for the queries of an application
    that look at them, by the files that they come from."""
    at = (spark.sparkContext.applicationId, *_files(spark, sf, "events", "supplier"))
    if at not in _CHAINS or not spark.catalog.tableExists(_CHAINS[at].table("label")):
        folder = shared_folder(spark, "chain")
        job = Job("chain_" + folder[-32:], f"{folder}/checkpoints", since=None, named=domain.NAMED)
        path = f"{folder}/documents"
        domain.write_documents(spark, sf, path, late=False, until=HISTORY)
        ingest_documents(spark, job, path)
        backfill(spark, job)
        domain.write_documents(spark, sf, path, late=False, since=HISTORY)
        run_all(spark, job, path)
        domain.write_documents(spark, sf, path, late=True)
        run_all(spark, job, path)
        run_models(spark, job)
        _CHAINS[at] = job
    return _CHAINS[at]


def q_chain_snapshots(spark, sf):
    found = current(spark, _chain(spark, sf), "snapshots_silver").drop("date")
    return rounded(found, 5, "lat", "lng")


def q_chain_gold(spark, sf):
    return current(spark, _chain(spark, sf), "gold").drop("date")


def q_chain_features(spark, sf):
    """The keyed table that the chain upserts new and changed gold rows into."""
    return spark.table(_chain(spark, sf).table("features")).drop("date")


def q_chain_labels(spark, sf):
    return spark.table(_chain(spark, sf).table("label")).drop("date")


def q_chain_forecasts(spark, sf):
    """Stations and times of the current forecasts at the end of the chain."""
    found = spark.table(_chain(spark, sf).table("current_predictions"))
    return found.select("station_id", "ts", "prediction_valid")


def q_stream_labels(spark, sf):
    """Labels by a join of the stream of snapshots with itself, four hours on."""
    name = "slots_" + shared_folder(spark, "slots")[-32:]
    overwrite_table(fact_slots(spark, sf).select("station_id", "ts", "bikes"), name)
    labels = label_stream(read_table_stream(spark, name))
    return run_to_folder(labels, "stream_labels", shared_folder(spark, "stream"))


# Tables in other ways


def q_table_modes(spark, sf):
    """A table that is made, appended to, and read as a stream."""
    slots = fact_slots(spark, sf)
    name = "modes_" + shared_folder(spark, "modes")[-32:]
    create_table(slots.filter("station_id % 2 = 0"), name)
    append_rows(slots.filter("station_id % 2 = 1"), name)
    stream = read_table_stream(spark, name)
    return run_to_folder(stream, "table_modes", shared_folder(spark, "stream"))


def q_overwritten_table(spark, sf):
    slots = fact_slots(spark, sf)
    name = "written_" + shared_folder(spark, "written")[-32:]
    overwrite_table(slots.limit(10), name)
    overwrite_table(slots, name)
    return read_table(spark, name)


def q_reset_table(spark, sf):
    """A table that a stream has filled, dropped with its checkpoint, and filled anew: all
    rows come again, and once."""
    source, name = (f"{x}_{shared_folder(spark, x)[-32:]}" for x in ("source", "reset"))
    overwrite_table(fact_slots(spark, sf), source)
    append_stream(read_table_stream(spark, source), name, shared_folder(spark, "stream"), "reset_stream")
    fresh = reset_table(spark, name, "stream")
    append_stream(read_table_stream(spark, source), name, fresh, "reset_stream")
    return spark.table(name)


def q_table_quality(spark, sf):
    """What a table is tagged with."""
    name = "tagged_" + shared_folder(spark, "tagged")[-32:]
    overwrite_table(fact_slots(spark, sf), name)
    set_quality(spark, name, "silver", "One row per station and slot")
    tags = spark.sql(f"SHOW TBLPROPERTIES {name}").filter("key = 'quality'").select("key", "value")
    comment = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Comment'")
    told = tags.unionByName(comment.select(F.lit("comment").alias("key"), F.col("data_type").alias("value")))
    return told.join(spark.table(name).agg(F.count(F.lit(1)).alias("row_count")))


def q_rows_at(spark, sf):
    return rows_at(fact_slots(spark, sf), "station_id", 1, "ts", "2024-01-01 00:30:00")


QUERIES: dict[str, Query] = {
    name[2:]: query for name, query in list(globals().items()) if name.startswith("q_")
}
