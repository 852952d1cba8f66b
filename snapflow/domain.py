"""The driver's tables seen as stations and their snapshots.

An event is a reading of a station: users are spread over stations, so that both
the stations and the readings grow with the tables. The supplier of the same number
gives a station its name, and its coordinates follow from the number.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.sources.tables import settle

USERS_PER_STATION = 6

RENAMED_FROM = "2024-01-16 00:00:00"

EVENT_FIELDS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = spark.readStream.schema(EVENT_FIELDS).parquet(f"{sf_dir}/events*.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def latitude(number: Column) -> Column:
    return (number * number * 31 + number * 17) % 10007 * F.lit(2e-5) + F.lit(47.3)


def longitude(number: Column) -> Column:
    return (number * number * 73 + number * 29 + 11) % 10009 * F.lit(3e-5) + F.lit(18.9)


def _place(number: Column) -> list[Column]:
    return [latitude(number).alias("lat"), longitude(number).alias("lng")]


def counts(events_df: DataFrame) -> DataFrame:
    """Readings without the stations' descriptions; works on streams."""
    return events_df.select(
        "ts",
        F.expr(f"user_id div {USERS_PER_STATION}").alias("station_id"),
        F.floor("value").alias("bikes"),
        (F.col("event_type") == "error").alias("maintenance"),
    )


def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name and place that each possible station carries. Some names lack the
    district number, and some stations are renamed later."""
    number = F.col("s_suppkey")
    numbered = F.concat(
        F.lpad(F.col("s_nationkey").cast("string"), 2, "0"), F.lit(" "), F.col("s_name")
    )
    return table(spark, sf_dir, "supplier").select(
        number.alias("station_id"),
        F.when(number % 11 == 3, F.col("s_name")).otherwise(numbered).alias("first_name"),
        (number % 7 == 0).alias("renamed"),
        *_place(number),
    )


def readings(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    """Readings with the description that the station had at the time."""
    facts = counts(events(spark, sf_dir) if source is None else source)
    return facts.join(descriptions(spark, sf_dir), "station_id").select(
        "ts", "station_id", "bikes", "maintenance", _name_at("ts").alias("station_name"), "lat", "lng"
    )


def _name_at(ts: str) -> Column:
    later = F.col("renamed") & (F.col(ts) >= F.lit(RENAMED_FROM).cast("timestamp"))
    return F.when(later, F.concat("first_name", F.lit(" B"))).otherwise(F.col("first_name"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings packed as snapshot documents: one per minute, its places the stations read
    in that time and a bike left in the street.

    Stations are renamed at the turn of a minute, so that readings are put together before
    they are joined with descriptions, of which equal ones count once."""
    read = (
        counts(events(spark, sf_dir))
        .groupBy(F.date_trunc("minute", "ts").alias("minute"), "station_id")
        .agg(F.max("bikes").alias("bikes"), F.bool_or("maintenance").alias("maintenance"))
    )
    real = read.join(descriptions(spark, sf_dir).distinct(), "station_id")
    real = real.withColumn("station_name", _name_at("minute"))
    place = F.struct(
        F.lit(False).alias("bike"),
        "bikes",
        "lat",
        "lng",
        "maintenance",
        F.col("station_name").alias("name"),
        F.col("station_id").alias("number"),
        F.lit(True).alias("spot"),
    )
    stray = F.struct(
        F.lit(True).alias("bike"),
        F.lit(1).cast("bigint").alias("bikes"),
        F.lit(47.5).alias("lat"),
        F.lit(19.0).alias("lng"),
        F.lit(False).alias("maintenance"),
        F.lit("BIKE 860").alias("name"),
        F.lit(900001).cast("bigint").alias("number"),
        F.lit(False).alias("spot"),
    )
    places = F.concat(F.collect_list(place), F.array(stray))
    packed = real.groupBy("minute").agg(places.alias("places"))
    city = F.struct("places")
    return packed.select(
        F.array(F.struct(F.array(city).alias("cities"))).alias("countries"),
        F.date_format("minute", NAME_FORMAT).alias("filename"),
    )


NAME_FORMAT = "yyyy-MM-dd'T'HH-mm-ss'Z.json'"

#: The field of a document that holds its name, where a file holds many.
NAMED = "scraped"


def write_documents(
    spark: SparkSession,
    sf_dir: str,
    folder: str,
    late: bool | None = None,
    since: str | None = None,
    until: str | None = None,
) -> None:
    """Documents of each minute as JSON lines, a file for each day, every document with its
    name; and a document without a time on the first day, and a malformed one, which only
    its folder names, by the first hour.

    One document in nine is late: with `late` only those are written, or all the others;
    `since` and `until` are days, the latter left out.
    """

    def asked(named: DataFrame) -> DataFrame:
        found = named.withColumn("day", F.substring(NAMED, 1, 10))
        if late is not None:
            is_late = F.pmod(F.xxhash64(NAMED), F.lit(9)) == 0
            found = found.filter(is_late if late else ~is_late)
        if since is not None:
            found = found.filter(F.col("day") >= since)
        if until is not None:
            found = found.filter(F.col("day") < until)
        return found

    docs = asked(documents(spark, sf_dir).withColumnRenamed("filename", NAMED))
    lines = docs.select(F.to_json(F.struct("countries", NAMED)).alias("value"), NAMED, "day")
    if not late and since is None:
        minutes = readings(spark, sf_dir).select(F.date_trunc("minute", "ts").alias("minute")).distinct()
        names = asked(minutes.select(F.date_format("minute", NAME_FORMAT).alias(NAMED)))
        first = settle(names.agg(F.min(NAMED).alias(NAMED)), "first-name")
        hour = F.concat(F.substring(NAMED, 1, 13), F.lit("-00-00Z.json"))
        notes = f'{{"countries": [], "{NAMED}": "notes"}}'
        for text, day in (('{"countries": [', hour), (notes, F.substring(NAMED, 1, 10))):
            lines = lines.unionByName(first.select(F.lit(text).alias("value"), NAMED, day.alias("day")))
    lines.drop(NAMED).repartition("day").write.mode("append").partitionBy("day").text(folder)


def customer_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A larger set of places, one per customer."""
    number = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        number.alias("station_id"), *_place(number)
    )
