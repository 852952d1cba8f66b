"""A session for local runs, set up as the library expects."""

from pyspark.sql import SparkSession


def local_session(cores: str = "*", app: str = "snapflow", memory: str = "8g") -> SparkSession:
    """On a cluster the submitted configuration takes the place of this."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Small local tables: a task per core rather than per megabyte.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Noting each column call's place in the Python code costs 10 ms a call.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
