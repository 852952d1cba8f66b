"""The registered queries as SQL over the same tables, for the comparison."""

# Building blocks: each name is a common table expression over those before it.
CTES = {
    "places": """
        SELECT s_suppkey AS station_id,
               CASE WHEN s_suppkey % 11 = 3 THEN s_name
                    ELSE lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || ' ' || s_name
               END AS first_name,
               (s_suppkey * s_suppkey * 31 + s_suppkey * 17) % 10007 * 2e-5 + 473e-1 AS lat,
               (s_suppkey * s_suppkey * 73 + s_suppkey * 29 + 11) % 10009 * 3e-5 + 189e-1 AS lng
        FROM supplier""",
    "facts": """
        SELECT ts, user_id // 6 AS station_id, CAST(floor(value) AS BIGINT) AS bikes,
               event_type = 'error' AS maintenance
        FROM events""",
    "readings": """
        SELECT f.*, first_name || CASE WHEN station_id % 7 = 0
                   AND ts >= TIMESTAMP '2024-01-16' THEN ' B' ELSE '' END AS station_name,
               lat, lng
        FROM facts f JOIN places USING (station_id)""",
    "ranked": """
        SELECT *, time_bucket(INTERVAL '10 minutes', ts) AS slot,
               row_number() OVER (
                   PARTITION BY station_id, time_bucket(INTERVAL '10 minutes', ts)
                   ORDER BY ts, bikes) AS turn
        FROM readings""",
    "snapshots": """
        SELECT slot AS ts, station_id, bikes, maintenance, station_name, lat, lng
        FROM ranked WHERE turn = 1""",
    "documents": """
        SELECT date_trunc('minute', ts) AS ts, station_id, station_name, lat, lng,
               max(bikes) AS bikes, bool_or(maintenance) AS maintenance
        FROM readings GROUP BY ALL""",
    "catalogue": """
        SELECT station_id, max_by(station_name, ts) AS station_name,
               max_by(lat, ts) AS lat, max_by(lng, ts) AS lng
        FROM readings GROUP BY station_id""",
    "spots": """
        SELECT station_id, lat, lng, cos(radians(lat)) * cos(radians(lng)) AS x,
               cos(radians(lat)) * sin(radians(lng)) AS y, sin(radians(lat)) AS z
        FROM catalogue""",
    "customer_spots": """
        SELECT *, cos(radians(lat)) * cos(radians(lng)) AS x,
               cos(radians(lat)) * sin(radians(lng)) AS y, sin(radians(lat)) AS z
        FROM (SELECT c_custkey AS station_id,
                     (c_custkey * c_custkey * 31 + c_custkey * 17) % 10007 * 2e-5 + 473e-1 AS lat,
                     (c_custkey * c_custkey * 73 + c_custkey * 29 + 11) % 10009 * 3e-5
                         + 189e-1 AS lng
              FROM customer)""",
    "pairs": """
        SELECT * FROM (
            SELECT a.station_id, b.station_id AS other, row_number() OVER (
                       PARTITION BY a.station_id
                       ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)
                              + (a.z - b.z) * (a.z - b.z), b.station_id) AS rank
            FROM spots a JOIN spots b ON a.station_id <> b.station_id)
        WHERE rank <= 5""",
    "customer_pairs": """
        SELECT * FROM (
            SELECT a.station_id, b.station_id AS other,
                   acos(greatest(-1.0, least(1.0, sin(radians(a.lat)) * sin(radians(b.lat))
                       + cos(radians(a.lat)) * cos(radians(b.lat))
                       * cos(radians(a.lng) - radians(b.lng))))) * 6371000.0 AS metres,
                   row_number() OVER (
                       PARTITION BY a.station_id
                       ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)
                              + (a.z - b.z) * (a.z - b.z), b.station_id) AS rank
            FROM customer_spots a JOIN customer_spots b ON a.station_id <> b.station_id)
        WHERE rank <= 5""",
    "closest": """
        SELECT station_id,
               array_to_string(list(other ORDER BY rank), ',') AS closest_stations,
               count(*) AS listed
        FROM pairs GROUP BY station_id""",
    "met": """
        SELECT s.station_id, s.ts, any_value(s.bikes) AS bikes, any_value(c.listed) AS listed,
               max(n.bikes) FILTER (WHERE p.rank = 1) AS at_1,
               max(n.bikes) FILTER (WHERE p.rank = 2) AS at_2,
               max(n.bikes) FILTER (WHERE p.rank = 3) AS at_3,
               max(n.bikes) FILTER (WHERE p.rank = 4) AS at_4,
               max(n.bikes) FILTER (WHERE p.rank = 5) AS at_5
        FROM snapshots s JOIN closest c USING (station_id) JOIN pairs p USING (station_id)
        LEFT JOIN snapshots n ON n.station_id = p.other AND n.ts = s.ts
        GROUP BY s.station_id, s.ts""",
    "neighbours": """
        SELECT station_id, ts, bikes,
               CASE WHEN listed >= 1 THEN coalesce(at_1, 0) END AS close_bikes_1,
               CASE WHEN listed >= 2 THEN coalesce(at_2, 0) END AS close_bikes_2,
               CASE WHEN listed >= 3 THEN coalesce(at_3, 0) END AS close_bikes_3,
               CASE WHEN listed >= 4 THEN coalesce(at_4, 0) END AS close_bikes_4,
               CASE WHEN listed >= 5 THEN coalesce(at_5, 0) END AS close_bikes_5
        FROM met""",
    "gold": """
        SELECT station_id, ts, bikes, CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday,
               CAST(hour(ts) AS INTEGER) AS hour,
               CAST(minute(ts) AS DOUBLE) / 10 AS tenminute,
               close_bikes_1, close_bikes_2, close_bikes_3, close_bikes_4, close_bikes_5
        FROM neighbours""",
    "labels": """
        SELECT station_id, ts, bikes, maintenance, avg(bikes) OVER (
                   PARTITION BY station_id ORDER BY ts
                   RANGE BETWEEN INTERVAL '14390 seconds' FOLLOWING
                             AND INTERVAL '14410 seconds' FOLLOWING) AS label
        FROM snapshots""",
    "known": """
        SELECT station_id, ts, bikes, label FROM labels WHERE label IS NOT NULL""",
    "placed": """
        SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts) AS position,
               count(*) OVER (PARTITION BY station_id) AS total
        FROM known""",
    "split": """
        SELECT *, position <= floor(total * 0.8::DOUBLE) AS is_train FROM placed""",
    "trained": """
        SELECT gold.*, label FROM gold JOIN known USING (station_id, ts)
        WHERE gold.bikes IS NOT NULL AND close_bikes_5 IS NOT NULL""",
    "tree_placed": """
        SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts) AS position,
               count(*) OVER (PARTITION BY station_id) AS total FROM trained""",
    "tree_split": """
        SELECT *, position <= floor(total * 0.8::DOUBLE) AS is_train FROM tree_placed""",
    "lines": """
        SELECT station_id, count(*) AS row_count,
               CASE WHEN regr_sxx(label, bikes) > 0 THEN regr_slope(label, bikes)
                    ELSE 0 END AS slope,
               CASE WHEN regr_sxx(label, bikes) > 0 THEN regr_intercept(label, bikes)
                    ELSE avg(label) END AS intercept
        FROM known GROUP BY station_id""",
    "chunked": """
        SELECT *, CAST(floor((position - 1) * 6 / total) AS INTEGER) AS chunk FROM placed""",
    "folds": """
        SELECT t.station_id, t.chunk AS fold, penalty, sums.*
        FROM (SELECT DISTINCT station_id, chunk FROM chunked WHERE chunk > 0) t
        CROSS JOIN (SELECT unnest([0.0, 100.0, 1000.0, 10000.0, 100000.0])::DOUBLE AS penalty)
        JOIN LATERAL (
            SELECT avg(bikes) AS mean_x, avg(label) AS mean_y,
                   regr_sxx(label, bikes) AS sxx, regr_sxy(label, bikes) AS sxy, count(*) AS n
            FROM chunked c WHERE c.station_id = t.station_id AND c.chunk < t.chunk) sums
        ON n > 0""",
    "scores": """
        SELECT f.station_id, f.penalty, f.fold,
               CASE WHEN var_pop(c.label) > 0
                    THEN 1 - avg((label - guess) * (label - guess)) / var_pop(label) END AS r2,
               sqrt(avg((label - guess) * (label - guess))) AS rmse
        FROM (SELECT f.*, CASE WHEN sxx + penalty > 0 THEN sxy / (sxx + penalty) ELSE 0
                          END AS slope
              FROM folds f) f
        JOIN (SELECT * FROM chunked) c ON c.station_id = f.station_id AND c.chunk = f.fold
        CROSS JOIN LATERAL (SELECT mean_y + slope * (c.bikes - mean_x) AS guess) g
        GROUP BY f.station_id, f.penalty, f.fold""",
    "predictions": """
        SELECT s.station_id, s.ts, intercept + slope * s.bikes AS prediction,
               s.ts + INTERVAL '4 hours' AS prediction_valid
        FROM snapshots s JOIN lines USING (station_id)""",
    "base": """
        SELECT station_id, ts, bikes, maintenance FROM snapshots
        WHERE ts < TIMESTAMP '2024-01-20'""",
    "updates": """
        SELECT station_id, ts, bikes + 1000 AS bikes, maintenance FROM snapshots
        WHERE ts >= TIMESTAMP '2024-01-15'""",
    "settled_slots": """
        SELECT * FROM snapshots
        WHERE ts <= (SELECT max(time_bucket(INTERVAL '10 minutes', ts)) FROM events)
                   - INTERVAL '30 minutes'""",
}

CTES["chain_slots"] = """
        SELECT * REPLACE (time_bucket(INTERVAL '10 minutes', ts) AS ts) FROM documents
        WHERE time_bucket(INTERVAL '10 minutes', ts) <= (
            SELECT max(time_bucket(INTERVAL '10 minutes', ts)) FROM documents)
            - INTERVAL '30 minutes'
        QUALIFY row_number() OVER (
            PARTITION BY station_id, time_bucket(INTERVAL '10 minutes', ts) ORDER BY ts) = 1"""
CTES["chain_met"] = CTES["met"].replace("snapshots", "chain_slots")
CTES["chain_neighbours"] = CTES["neighbours"].replace("FROM met", "FROM chain_met")
CTES["chain_gold"] = CTES["gold"].replace("FROM neighbours", "FROM chain_neighbours")

NEEDS = {
    "chain_slots": ["documents"],
    "chain_met": ["chain_slots", "closest", "pairs"],
    "chain_neighbours": ["chain_met"],
    "chain_gold": ["chain_neighbours"],
    "readings": ["facts", "places"],
    "ranked": ["readings"],
    "snapshots": ["ranked"],
    "documents": ["readings"],
    "catalogue": ["readings"],
    "spots": ["catalogue"],
    "pairs": ["spots"],
    "customer_pairs": ["customer_spots"],
    "closest": ["pairs"],
    "met": ["snapshots", "closest", "pairs"],
    "neighbours": ["met"],
    "gold": ["neighbours"],
    "labels": ["snapshots"],
    "known": ["labels"],
    "placed": ["known"],
    "split": ["placed"],
    "trained": ["gold", "known"],
    "tree_placed": ["trained"],
    "tree_split": ["tree_placed"],
    "lines": ["known"],
    "chunked": ["placed"],
    "folds": ["chunked"],
    "scores": ["chunked", "folds"],
    "predictions": ["snapshots", "lines"],
    "base": ["snapshots"],
    "updates": ["snapshots"],
    "settled_slots": ["snapshots"],
}


def _sql(final: str, *needs: str) -> str:
    wanted: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS.get(name, []):
            add(other)
        if name not in wanted:
            wanted.append(name)

    for name in needs:
        add(name)
    if not wanted:
        return final
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in wanted)
    return f"WITH {parts}\n{final}"


_SLOT = "time_bucket(INTERVAL '10 minutes', ts)"
_SLOT_COLUMNS = (
    "CAST(CAST(ts AS DATE) AS VARCHAR) AS date, CAST(hour(ts) AS INTEGER) AS hour,"
    " CAST(minute(ts) // 10 * 10 AS INTEGER) AS minute"
)
_UPSERTED = """
    SELECT station_id, ts, bikes, maintenance FROM (
        SELECT *, row_number() OVER (PARTITION BY station_id, ts ORDER BY turn DESC) AS pick
        FROM (SELECT *, 1 AS turn FROM base UNION ALL SELECT *, 2 AS turn FROM updates))
    WHERE pick = 1"""
_METRICS = """
    count(*) AS row_count,
    CASE WHEN var_pop(label) > 0
         THEN 1 - avg((label - bikes) * (label - bikes)) / var_pop(label) END AS r2,
    avg((label - bikes) * (label - bikes)) AS mse,
    sqrt(avg((label - bikes) * (label - bikes))) AS rmse"""

ORACLE: dict[str, str] = {
    "flatten_places": _sql(
        """SELECT strftime(ts, '%Y-%m-%dT%H-%M-%SZ.json') AS filename, station_id, bikes,
                  maintenance, station_name FROM documents""",
        "documents",
    ),
    "place_readings": _sql(
        """SELECT ts, station_id, bikes, maintenance, station_name, lat, lng FROM documents
           WHERE ts >= TIMESTAMP '2024-01-10 12:00:00'""",
        "documents",
    ),
    "ten_minute_floor": f"""SELECT event_id, date_trunc('minute', ts) AS minute_ts,
        {_SLOT} AS slot_ts FROM events""",
    "filename_timestamp": """SELECT event_id,
        CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS scraped
        FROM events""",
    "dedup_station_slot": _sql(
        "SELECT ts, station_id, bikes, maintenance, station_name FROM snapshots", "snapshots"
    ),
    "first_scrape_per_slot": _sql(
        f"""SELECT {_SLOT_COLUMNS}, ts, station_id, bikes FROM (
                SELECT *, dense_rank() OVER (
                    PARTITION BY CAST(ts AS DATE), hour(ts), minute(ts) // 10
                    ORDER BY ts) AS scrape
                FROM (SELECT * REPLACE (date_trunc('minute', ts) AS ts) FROM readings))
            WHERE scrape = 1""",
        "readings",
    ),
    "slot_counts": _sql(
        f"SELECT station_id, ts, bikes, maintenance, {_SLOT_COLUMNS} FROM snapshots",
        "snapshots",
    ),
    "station_rows": _sql(
        """SELECT DISTINCT station_id, station_name, round(lat, 5) AS lat, round(lng, 5) AS lng,
                  TRY_CAST(substr(station_name, 1, 2) AS INTEGER) AS district FROM snapshots""",
        "snapshots",
    ),
    "station_catalogue": _sql(
        """SELECT station_id, station_name, round(lat, 5) AS lat, round(lng, 5) AS lng,
                  TRY_CAST(substr(station_name, 1, 2) AS INTEGER) AS district FROM catalogue""",
        "catalogue",
    ),
    "distances_ordered": _sql(
        """SELECT station_id, other AS other_station_id,
                  CAST(trunc(metres) AS INTEGER) AS distance_meters FROM customer_pairs""",
        "customer_pairs",
    ),
    "distances_unordered": _sql(
        """SELECT least(station_id, other) AS station_id,
                  greatest(station_id, other) AS other_station_id,
                  CAST(trunc(min(metres)) AS INTEGER) AS distance_meters
           FROM customer_pairs GROUP BY ALL""",
        "customer_pairs",
    ),
    "nearest_five": _sql("SELECT station_id, closest_stations FROM closest", "closest"),
    "nearest_five_grid": _sql(
        """SELECT station_id, array_to_string(list(other ORDER BY rank), ',')
                  AS closest_stations
           FROM customer_pairs GROUP BY station_id""",
        "customer_pairs",
    ),
    "stations_with_closest": _sql(
        """SELECT station_id, station_name,
                  TRY_CAST(substr(station_name, 1, 2) AS INTEGER) AS district,
                  closest_stations FROM catalogue JOIN closest USING (station_id)""",
        "catalogue",
        "closest",
    ),
    "neighbour_list_length": _sql(
        """SELECT count(*) FILTER (WHERE n <> 5) AS wrong_rows, count(*) AS row_count
           FROM (SELECT count(*) AS n FROM customer_pairs GROUP BY station_id)""",
        "customer_pairs",
    ),
    "neighbour_bikes": _sql("SELECT * FROM neighbours", "neighbours"),
    "calendar_columns": """SELECT event_id, ts, CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday,
        CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS DOUBLE) / 10 AS tenminute
        FROM events""",
    "gold_features": _sql("SELECT * FROM gold", "gold"),
    "label_4h": _sql("SELECT station_id, ts, label FROM labels", "labels"),
    "label_4h_events": """SELECT event_id, round(avg(value) OVER (
            PARTITION BY event_type ORDER BY date_trunc('second', ts)
            RANGE BETWEEN INTERVAL '13800 seconds' FOLLOWING
                      AND INTERVAL '15000 seconds' FOLLOWING), 4) AS label
        FROM events""",
    "gold_with_label": _sql(
        """SELECT gold.*, label AS future_bikes FROM gold JOIN known USING (station_id, ts)""",
        "gold",
        "known",
    ),
    "training_join": _sql(
        """SELECT gold.*, label FROM gold JOIN known USING (station_id, ts)
           WHERE gold.bikes IS NOT NULL AND close_bikes_5 IS NOT NULL""",
        "gold",
        "known",
    ),
    "asof_features": """SELECT l.user_id, l.ts, l.event_id, l.value, r.event_id AS view_id,
               r.value AS view_value
        FROM (SELECT * FROM events WHERE event_type = 'purchase') l
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') r
        ON l.user_id = r.user_id AND l.ts >= r.ts""",
    "asof_training_set": _sql(
        """SELECT station_id, label, gold.* EXCLUDE (station_id, ts, weekday)
           FROM known ASOF JOIN gold USING (station_id, ts)
           WHERE close_bikes_5 IS NOT NULL""",
        "gold",
        "known",
    ),
    "feature_upsert": _sql(_UPSERTED, "base", "updates"),
    "feature_upsert_table": _sql(_UPSERTED, "base", "updates"),
    "temporal_split": _sql(
        """SELECT station_id, ts,
                  row_number() OVER (PARTITION BY station_id ORDER BY ts)
                  <= floor(count(*) OVER (PARTITION BY station_id) * 0.8::DOUBLE) AS is_train
           FROM snapshots""",
        "snapshots",
    ),
    "hash_split": _sql(
        """SELECT station_id, ts,
                  ('0x' || substr(md5('42|' || station_id || '|'
                      || epoch_us(ts)), 1, 8))::BIGINT
                  < 3865470566 AS is_train
           FROM snapshots""",
        "snapshots",
    ),
    "forward_folds": _sql(
        """SELECT station_id, ts, CAST(floor(
                  (row_number() OVER (PARTITION BY station_id ORDER BY ts) - 1) * 6
                  / count(*) OVER (PARTITION BY station_id)) AS INTEGER) AS chunk
           FROM snapshots""",
        "snapshots",
    ),
    "persistence_metrics": _sql(
        f"""SELECT station_id, row_count, round(r2, 4) AS r2, round(mse, 4) AS mse,
                   round(rmse, 4) AS rmse
            FROM (SELECT station_id, {_METRICS} FROM known GROUP BY station_id)""",
        "known",
    ),
    "linear_fit_per_station": _sql(
        """SELECT station_id, count(*) AS row_count,
                  CASE WHEN regr_sxx(label, bikes) > 0
                       THEN round(regr_slope(label, bikes), 4) END AS slope,
                  CASE WHEN regr_sxx(label, bikes) > 0
                       THEN round(regr_intercept(label, bikes), 4) END AS intercept,
                  CASE WHEN regr_sxx(label, bikes) > 0
                       THEN round(regr_r2(label, bikes), 4) END AS r2
           FROM known GROUP BY station_id""",
        "known",
    ),
    "linear_fit_shifted": _sql(
        """SELECT station_id, count(*) AS row_count, round(regr_slope(y, x), 4) AS slope,
                  round(regr_r2(y, x), 4) AS r2
           FROM (SELECT station_id, bikes + 1e7 AS x, label + 1e7 AS y FROM known)
           GROUP BY station_id HAVING regr_sxx(y, x) > 0""",
        "known",
    ),
    "linear_holdout_metrics": _sql(
        """SELECT station_id, row_count, round(r2, 4) AS r2, round(mse, 4) AS mse,
                  round(sqrt(mse), 4) AS rmse, round(intercept, 4) AS intercept,
                  round(slope, 4) AS slope
           FROM lines LEFT JOIN (
               SELECT station_id, avg((label - guess) * (label - guess)) AS mse,
                      CASE WHEN var_pop(label) > 0
                           THEN 1 - avg((label - guess) * (label - guess)) / var_pop(label)
                      END AS r2
               FROM (SELECT s.station_id, label, a + b * bikes AS guess
                     FROM split s JOIN (
                         SELECT station_id,
                                CASE WHEN regr_sxx(label, bikes) > 0
                                     THEN regr_slope(label, bikes) ELSE 0 END AS b,
                                CASE WHEN regr_sxx(label, bikes) > 0
                                     THEN regr_intercept(label, bikes)
                                     ELSE avg(label) END AS a
                         FROM split WHERE is_train GROUP BY station_id) USING (station_id)
                     WHERE NOT is_train)
               GROUP BY station_id) USING (station_id)""",
        "lines",
        "split",
    ),
    "forward_fold_scores": _sql(
        """SELECT station_id, penalty, fold, round(r2, 4) AS r2, round(rmse, 4) AS rmse
           FROM scores""",
        "scores",
    ),
    "best_candidate": _sql(
        """SELECT station_id, penalty, round(mean_rmse, 4) AS rmse FROM (
               SELECT *, row_number() OVER (
                   PARTITION BY station_id ORDER BY mean_rmse, penalty) AS pick
               FROM (SELECT station_id, penalty, avg(rmse) AS mean_rmse
                     FROM scores GROUP BY ALL))
           WHERE pick = 1""",
        "scores",
    ),
    "predict_linear": _sql(
        """SELECT station_id, ts, round(prediction, 4) AS prediction, prediction_valid
           FROM predictions""",
        "predictions",
    ),
    "newest_predictions": _sql(
        """SELECT station_id, ts, round(prediction, 4) AS prediction, prediction_valid
           FROM predictions WHERE ts = (SELECT max(ts) FROM predictions)""",
        "predictions",
    ),
    "champion_models": _sql(
        """SELECT station_id, CAST(week AS INTEGER) AS version, 'Champion' AS alias, row_count,
                  round(intercept, 4) AS intercept, round(slope, 4) AS slope
           FROM (SELECT station_id, weekofyear(ts) AS week, count(*) AS row_count,
                        CASE WHEN regr_sxx(label, bikes) > 0 THEN regr_slope(label, bikes)
                             ELSE 0 END AS slope,
                        CASE WHEN regr_sxx(label, bikes) > 0 THEN regr_intercept(label, bikes)
                             ELSE avg(label) END AS intercept
                 FROM known GROUP BY ALL)
           QUALIFY week = max(week) OVER (PARTITION BY station_id)""",
        "known",
    ),
    "registered_versions": _sql(
        """SELECT station_id, CAST(1 AS INTEGER) AS version, count(*) AS row_count
           FROM known GROUP BY station_id
           UNION ALL
           SELECT station_id, CAST(2 AS INTEGER), count(*) FROM known
           WHERE ts >= TIMESTAMP '2024-01-29' GROUP BY station_id""",
        "known",
    ),
    "runs_log": _sql(
        f"""SELECT 'persistence' AS run_name, station_id, metric, round(value, 4) AS value
            FROM (SELECT station_id, unnest(['row_count', 'r2', 'mse', 'rmse']) AS metric,
                         unnest([CAST(row_count AS DOUBLE), r2, mse, rmse]) AS value
                  FROM (SELECT station_id, {_METRICS} FROM known GROUP BY station_id))""",
        "known",
    ),
    "neighbour_list_sizes": _sql(
        """SELECT CAST(least(5, (SELECT count(*) - 1 FROM customer)) AS INTEGER) AS length,
                  count(*) AS row_count FROM customer""",
    ),
    "runs_with_parameters": _sql(
        f"""SELECT 'persistence' AS run_name, station_id, metric, round(value, 4) AS value,
                   TIMESTAMP '2024-02-01 00:00:00' AS run_at, 'hours=4,tolerance_s=10' AS parameters
            FROM (SELECT station_id, unnest(['row_count', 'r2', 'mse', 'rmse']) AS metric,
                         unnest([CAST(row_count AS DOUBLE), r2, mse, rmse]) AS value
                  FROM (SELECT station_id, {_METRICS} FROM known GROUP BY station_id))""",
        "known",
    ),
    "reset_table": _sql("SELECT station_id, ts, bikes, maintenance FROM snapshots", "snapshots"),
    "table_quality": _sql(
        """SELECT unnest(['quality', 'comment']) AS key,
                  unnest(['silver', 'One row per station and slot']) AS value,
                  (SELECT count(*) FROM snapshots) AS row_count""",
        "snapshots",
    ),
    "null_profile": _sql(
        """SELECT column_name, null_count FROM (UNPIVOT (
               SELECT count(*) - count(station_id) AS station_id, count(*) - count(ts) AS ts,
                      count(*) - count(bikes) AS bikes, count(*) - count(weekday) AS weekday,
                      count(*) - count(hour) AS hour, count(*) - count(tenminute) AS tenminute,
                      count(*) - count(close_bikes_1) AS close_bikes_1,
                      count(*) - count(close_bikes_2) AS close_bikes_2,
                      count(*) - count(close_bikes_3) AS close_bikes_3,
                      count(*) - count(close_bikes_4) AS close_bikes_4,
                      count(*) - count(close_bikes_5) AS close_bikes_5
               FROM gold) ON COLUMNS(*) INTO NAME column_name VALUE null_count)""",
        "gold",
    ),
    "duplicate_keys": _sql(
        f"""SELECT station_id, {_SLOT} AS ts, count(*) AS row_count FROM facts
            GROUP BY ALL HAVING count(*) > 1""",
        "facts",
    ),
    "one_station_history": _sql(
        """SELECT station_id, ts, bikes, maintenance FROM snapshots WHERE station_id = 21""",
        "snapshots",
    ),
    "stream_dedup": _sql(
        """SELECT ts, station_id, bikes, maintenance, station_name, round(lat, 5) AS lat,
                  round(lng, 5) AS lng FROM settled_slots""",
        "settled_slots",
    ),
    "json_readings": _sql(
        """SELECT ts, station_id, bikes, maintenance, station_name, round(lat, 5) AS lat,
                  round(lng, 5) AS lng FROM documents""",
        "documents",
    ),
    "json_inferred": _sql(
        """SELECT ts, station_id, bikes, maintenance, station_name, round(lat, 5) AS lat,
                  round(lng, 5) AS lng FROM documents""",
        "documents",
    ),
    "json_bad_documents": """
        SELECT strftime(date_trunc('hour', min(ts)), '%Y-%m-%dT%H-%M-%SZ.json') AS filename,
               '{"countries": [' AS corrupt_document FROM events
        UNION ALL SELECT 'notes', NULL""",
    "chain_snapshots": _sql(
        """SELECT ts, station_id, bikes, maintenance, station_name, round(lat, 5) AS lat,
                  round(lng, 5) AS lng FROM chain_slots""",
        "chain_slots",
    ),
    "chain_gold": _sql("SELECT * FROM chain_gold", "chain_gold"),
    "chain_features": _sql("SELECT * FROM chain_gold", "chain_gold"),
    "stream_labels": _sql(
        """SELECT station_id, ts, label FROM labels
           WHERE ts + INTERVAL '14410 seconds' < (SELECT max(ts) FROM snapshots)""",
        "labels",
    ),
    "chain_labels": _sql(
        """SELECT g.station_id, g.ts, l.bikes::DOUBLE AS label FROM chain_gold g
           LEFT JOIN chain_gold l
           ON l.station_id = g.station_id AND l.ts = g.ts + INTERVAL '4 hours'""",
        "chain_gold",
    ),
    "chain_forecasts": _sql(
        """SELECT station_id, ts, ts + INTERVAL '4 hours' AS prediction_valid
           FROM chain_gold WHERE ts = (SELECT max(ts) FROM chain_gold)
           AND close_bikes_5 IS NOT NULL AND station_id IN (
               SELECT g.station_id FROM chain_gold g JOIN chain_gold l
               ON l.station_id = g.station_id AND l.ts = g.ts + INTERVAL '4 hours'
               WHERE g.close_bikes_5 IS NOT NULL)""",
        "chain_gold",
    ),
    "linear_models": _sql(
        """SELECT station_id, count(*) AS row_count, 0.0::DOUBLE AS rest_bikes,
                  0.0::DOUBLE AS rest_weekday, 0.0::DOUBLE AS rest_hour,
                  0.0::DOUBLE AS rest_tenminute, 0.0::DOUBLE AS rest_sum
           FROM gold JOIN known USING (station_id, ts)
           WHERE gold.bikes IS NOT NULL AND close_bikes_5 IS NOT NULL GROUP BY station_id""",
        "gold",
        "known",
    ),
    "boosted_reloaded": _sql(
        """SELECT station_id, ts, ts + INTERVAL '4 hours' AS prediction_valid,
                  0.0::DOUBLE AS difference
           FROM gold WHERE bikes IS NOT NULL AND close_bikes_5 IS NOT NULL AND station_id IN (
               SELECT station_id FROM trained)""",
        "trained",
    ),
    "boosted_station_metrics": _sql(
        """SELECT station_id, count(*) FILTER (WHERE is_train) AS learned,
                  count(*) FILTER (WHERE NOT is_train) AS tested, true AS fits
           FROM tree_split GROUP BY station_id HAVING learned > 0""",
        "tree_split",
    ),
    "boosted_first_splits": _sql(
        """, fixed AS (
               SELECT *, CAST(floor(label * 1048576 + 0.5) AS BIGINT) AS y FROM trained
           ), started AS (
               SELECT *, y - CAST(floor(CAST(sum(y) OVER s AS DOUBLE) / count(*) OVER s + 0.5)
                               AS BIGINT) AS rest
               FROM fixed WINDOW s AS (PARTITION BY station_id)
           ), cells AS (
               SELECT station_id, rest, unnest(range(9)) AS feature, unnest([
                   bikes, weekday, hour, tenminute, close_bikes_1, close_bikes_2, close_bikes_3,
                   close_bikes_4, close_bikes_5]::DOUBLE[]) AS cut FROM started
           ), sums AS (
               SELECT station_id, feature, cut, count(*) AS cell_n, sum(rest) AS cell_s
               FROM cells GROUP BY ALL
           ), sides AS (
               SELECT station_id, feature, cut, sum(cell_n) OVER f AS n, sum(cell_s) OVER f AS s,
                      sum(cell_n) OVER c AS left_n, sum(cell_s) OVER c AS left_s
               FROM sums WINDOW f AS (PARTITION BY station_id, feature),
                                c AS (PARTITION BY station_id, feature ORDER BY cut)
           ), gains AS (
               SELECT *, CAST(left_s AS DOUBLE) * n - CAST(s AS DOUBLE) * left_n AS apart
               FROM sides WHERE left_n >= 14 AND n - left_n >= 14
           ), found AS (
               SELECT *, apart * apart / (CAST(n AS DOUBLE) * left_n * (n - left_n)) AS gain
               FROM gains
           )
           SELECT station_id, CAST(feature AS INTEGER) AS feature, cut,
                  round(gain / 1099511627776, 3) AS gain,
                  CAST(n AS BIGINT) AS row_count, CAST(left_n AS BIGINT) AS left_count
           FROM found WHERE gain > 0
           QUALIFY row_number() OVER (PARTITION BY station_id
                                      ORDER BY gain DESC, feature, cut) = 1""",
        "trained",
    ),
    "boosted_search": _sql(
        """SELECT trial, fold, count(*) AS row_count, false AS below_best
           FROM (SELECT CAST(floor((position - 1) * 6 / total) AS INTEGER) AS fold
                 FROM tree_split),
                (SELECT unnest(range(20)) AS trial)
           WHERE fold > 0 GROUP BY trial, fold""",
        "tree_split",
    ),
    "table_modes": _sql("SELECT station_id, ts, bikes, maintenance FROM snapshots", "snapshots"),
    "overwritten_table": _sql(
        "SELECT station_id, ts, bikes, maintenance FROM snapshots", "snapshots"
    ),
    "rows_at": _sql(
        """SELECT station_id, ts, bikes, maintenance FROM snapshots
           WHERE station_id = 1 AND ts = TIMESTAMP '2024-01-01 00:30:00'""",
        "snapshots",
    ),
    "stream_stations": _sql(
        """SELECT DISTINCT station_id, station_name, round(lat, 5) AS lat, round(lng, 5) AS lng,
                  TRY_CAST(substr(station_name, 1, 2) AS INTEGER) AS district FROM readings""",
        "readings",
    ),
    "stream_slot_counts": _sql(
        f"SELECT station_id, ts, bikes, maintenance, {_SLOT_COLUMNS} FROM settled_slots",
        "settled_slots",
    ),
    "stream_gold": _sql(
        """SELECT gold.* FROM gold WHERE ts <= (
               SELECT max(time_bucket(INTERVAL '10 minutes', ts)) FROM events)
               - INTERVAL '30 minutes'""",
        "gold",
    ),
}
