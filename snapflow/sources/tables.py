"""Writers of tables: append, overwrite, create, upsert, and reset."""

import re
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from snapflow.operators.checks import check_unique


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach.

    It lies under the cluster's `spark.checkpoint.dir`, or else under the warehouse.
    A warehouse on this machine's disk is refused unless the session is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.conf.get("spark.sql.warehouse.dir")
        local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        if not local and re.match(r"file:|/", base):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/snapflow-{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame, purpose: str = "step") -> DataFrame:
    """Write `df` to the shared folder and read it back.

    It cuts the lineage in a way that outlives executors, and gives Spark the
    measured size by which it decides whether a join may broadcast the result.
    """
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def ensure_schema(spark: SparkSession, name: str, use: bool = False) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")
    if use:
        spark.sql(f"USE {name}")


def append_stream(
    df: DataFrame,
    table: str,
    checkpoint: str,
    name: str,
    partition_by: str | None = None,
    await_: bool = True,
) -> StreamingQuery:
    """Append to `table` what the stream holds now, then stop.

    Each query needs a checkpoint folder of its own. By default the call returns
    only when the data is in the table, so that a next step may read it.
    """
    writer = (
        df.writeStream.outputMode("append")
        .queryName(name)
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    query = writer.toTable(table)
    if await_:
        query.awaitTermination()
    return query


def overwrite_table(df: DataFrame, table: str, partition_by: str | None = None) -> None:
    """Replace `table` as a whole. `df` must not read from it."""
    writer = df.write.mode("overwrite")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(table)


def append_rows(df: DataFrame, table: str, partition_by: str | None = None) -> None:
    """Append to `table`, which is made if it does not exist."""
    writer = df.write.mode("append")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(table)


def create_table(df: DataFrame, table: str, mode: str = "error") -> None:
    """Write a table that does not exist yet; `mode` says what to do if it does."""
    df.write.mode(mode).saveAsTable(table)


def set_quality(spark: SparkSession, table: str, quality: str, comment: str) -> None:
    """Tag a table as bronze, silver or gold, and say what it holds."""
    text = comment.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('quality' = '{quality}')")
    spark.sql(f"COMMENT ON TABLE {table} IS '{text}'")


def create_feature_table(
    df: DataFrame,
    table: str,
    keys: list[str],
    partition_col: str = "date",
    ts: str = "ts",
    path: str | None = None,
) -> None:
    """Create a keyed time-series table, partitioned by the date of `ts`.

    Rows that share a key are refused. With `path` the files lie there.
    """
    require_unique(df, keys)
    dated = with_partition_date(df, partition_col, ts)
    writer = dated.hint("rebalance", partition_col).write.mode("error")
    if path is not None:
        writer = writer.option("path", path)
    writer.partitionBy(partition_col).saveAsTable(table)


def with_partition_date(df: DataFrame, partition_col: str, ts: str | Column) -> DataFrame:
    return df.withColumn(partition_col, F.to_date(ts))


def require_unique(df: DataFrame, keys: list[str]) -> None:
    if not check_unique(df, keys).isEmpty():
        raise ValueError(f"more than one row with the same {', '.join(keys)}")


def merge_rows(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `target` with those of `updates` put in place of equal keys."""
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def upsert(
    spark: SparkSession,
    table: str,
    updates: DataFrame,
    keys: list[str],
    partition_col: str = "date",
) -> None:
    """Insert `updates` into a partitioned table, replacing rows of equal keys.

    Only partitions that `updates` touches are read and rewritten, which needs
    `partition_col` to follow from the keys. The distinct partition values of the
    updates, a line per partition, are fetched to name the partitions to the scan.

    It may be repeated after a failure, and so may serve `foreachBatch`.
    """
    updates = settle(updates, "updates")
    require_unique(updates, keys)
    target = spark.table(table)
    touched = [r[0] for r in updates.select(partition_col).distinct().collect()]
    if not touched:
        return
    if None in touched:
        raise ValueError(f"updates without {partition_col}")
    merged = merge_rows(target.filter(F.col(partition_col).isin(touched)), updates, keys)
    replace_partitions(spark, table, merged, touched, partition_col)


def replace_partitions(
    spark: SparkSession,
    table: str,
    rows: DataFrame,
    touched: list,
    partition_col: str = "date",
    keys: list[str] | None = None,
) -> None:
    """Put `rows` in place of the partitions `touched`, of which they are all rows.

    With `keys`, rows that share a key are refused.

    A partition's new rows are written whole to a folder of their own before the
    catalog is told of it, one partition after the other, and former folders go at the
    end. So a failure at any time leaves every partition old or new, and running it again
    changes nothing more.
    """
    place = table_location(spark, table)
    folder = f"{place}/_versions/{uuid.uuid4().hex}"
    rows = rows.select(*spark.table(table).columns)
    rows.hint("rebalance", partition_col).write.partitionBy(partition_col).parquet(folder)
    if keys is not None:
        kept = [f for f in rows.schema.fields if f.name in keys]
        require_unique(spark.read.schema(T.StructType(kept)).parquet(folder), keys)
    written = {unquote(f.rsplit("=", 1)[1]) for f in _folders(spark, folder)}
    known = {unquote(r[0].split("=", 1)[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    new = [v for v in touched if str(v) in written and str(v) not in known]
    if new:
        specs = [f"PARTITION ({partition_col} = '{v}') LOCATION '{folder}/{partition_col}={v}'" for v in new]
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(specs)}")
    for value in touched:
        if str(value) in known:
            to = f"SET LOCATION '{folder}/{partition_col}={value}'"
            if str(value) in written:
                spark.sql(f"ALTER TABLE {table} PARTITION ({partition_col} = '{value}') {to}")
            else:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition_col} = '{value}')")
    spark.catalog.refreshTable(table)
    homes = [place, *(f for f in _folders(spark, f"{place}/_versions") if f != folder)]
    for value in touched:
        for home in homes if str(value) in known else []:
            remove_folder(spark, f"{home}/{partition_col}={value}")


def _folders(spark: SparkSession, folder: str) -> list[str]:
    """The folders in a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [f"{folder}/{f.getPath().getName()}" for f in files.listStatus(path) if f.isDirectory()]


def table_location(spark: SparkSession, table: str, partition: str = "") -> str:
    """The folder of a table, or of one partition of it."""
    told = spark.sql(f"DESCRIBE FORMATTED {table} {partition}")
    return told.filter("col_name = 'Location'").collect()[0]["data_type"].rstrip("/")


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder that this library has written, and all in it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def upsert_stream(
    df: DataFrame,
    table: str,
    keys: list[str],
    checkpoint: str,
    name: str,
    partition_col: str = "date",
    await_: bool = True,
) -> StreamingQuery:
    """Upsert each micro-batch of a stream into `table`."""

    def write(batch: DataFrame, _: int) -> None:
        upsert(batch.sparkSession, table, batch, keys, partition_col)

    query = (
        df.writeStream.queryName(name)
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .start()
    )
    if await_:
        query.awaitTermination()
        # The stream writes in a session of its own; this one has an old file list.
        df.sparkSession.catalog.refreshTable(table)
    return query


def reset_table(spark: SparkSession, table: str, purpose: str) -> str:
    """Drop a table in development, and return a checkpoint folder to start afresh.

    A dropped table with the old checkpoint would never see the old rows again.
    """
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    return shared_folder(spark, purpose)
