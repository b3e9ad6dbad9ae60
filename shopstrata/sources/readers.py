"""Readers for events, change rows and keyed logs, as a batch or a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shopstrata import schemas

CORRUPT = "_corrupt_record"


def read_events(spark: SparkSession, path: str, streaming: bool = False, tolerant: bool = False) -> DataFrame:
    """Nested behaviour events from JSON lines. Malformed lines fail the job unless `tolerant`.

    A tolerant read keeps the text of a malformed line in `_corrupt_record`; see `quarantine`.
    """
    reader = spark.readStream if streaming else spark.read
    schema = schemas.EVENT
    if tolerant:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return reader.schema(schema).option("mode", "PERMISSIVE" if tolerant else "FAILFAST").json(path)


def quarantine(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a tolerant read into good events and the text of malformed lines."""
    bad = F.col(CORRUPT).isNotNull()
    return events.filter(~bad).drop(CORRUPT), events.filter(bad).select(CORRUPT)


def read_changes(spark: SparkSession, path: str, table: T.StructType, streaming: bool = False) -> DataFrame:
    """Change rows (op, seq, columns[, before]) of a business table from JSON lines."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schemas.change_schema(table)).option("mode", "FAILFAST").json(path)


def read_business(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A business table kept as parquet, in its declared schema."""
    return spark.read.schema(schemas.BUSINESS_TABLES[name]).parquet(f"{folder}/{name}")


def read_kafka(spark: SparkSession, servers: str, topic: str, streaming: bool = True) -> DataFrame:
    """A topic from its earliest offset. Needs the Kafka connector on the classpath."""
    reader = spark.readStream if streaming else spark.read
    return (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )


def decode_events(records: DataFrame, value: str = "value") -> DataFrame:
    """Events from JSON text. Malformed text fails the job."""
    parsed = F.from_json(F.col(value).cast("string"), schemas.EVENT, {"mode": "FAILFAST"})
    return records.select(parsed.alias("event")).select("event.*")


def decode_keyed(records: DataFrame, key: T.StructType, value: T.StructType, seq: str = "offset") -> DataFrame:
    """Keyed records to change rows. A record without a value deletes its key."""
    fields = [field for field in value.fieldNames() if field not in key.fieldNames()]
    parsed = records.select(
        F.when(F.col("value").isNull(), "d").otherwise("u").alias("op"),
        F.col(seq).cast("bigint").alias("seq"),
        F.from_json(F.col("key").cast("string"), key, {"mode": "FAILFAST"}).alias("k"),
        F.from_json(F.col("value").cast("string"), value, {"mode": "FAILFAST"}).alias("v"),
    )
    return parsed.select("op", "seq", "k.*", *[f"v.{field}" for field in fields])


def encode_events(events: DataFrame) -> DataFrame:
    """One JSON text per event, missing fields kept as null."""
    return events.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split: tuple[str, int, int, int] | None = None,
    **options: str,
) -> DataFrame:
    """A database table. `split` = (numeric column, lower, upper, partitions) reads it in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if split:
        column, lower, upper, partitions = split
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load()
