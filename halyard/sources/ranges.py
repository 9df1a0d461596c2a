"""Tables partitioned by ranges of the account key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from halyard.contract import ACCOUNT_RANGE_COUNT, ACCOUNT_RANGE_HIGH, ACCOUNT_RANGE_LOW
from halyard.sources.tables import SchemaError, conform

BUCKET = "account_bucket"
_PROPERTY = "halyard.range."


def with_range_bucket(
    frame: DataFrame,
    key: str = "account_id",
    low: int = ACCOUNT_RANGE_LOW,
    high: int = ACCOUNT_RANGE_HIGH,
    count: int = ACCOUNT_RANGE_COUNT,
    output: str = BUCKET,
) -> DataFrame:
    """Bucket 1..count for keys in [low, high), 0 below and count + 1 from ``high`` on."""
    return frame.withColumn(
        output, F.width_bucket(F.col(key), F.lit(low), F.lit(high), F.lit(count).cast("bigint"))
    )


def write_by_range(
    frame: DataFrame,
    path: str,
    key: str = "account_id",
    low: int = ACCOUNT_RANGE_LOW,
    high: int = ACCOUNT_RANGE_HIGH,
    count: int = ACCOUNT_RANGE_COUNT,
) -> str:
    """Write one directory per range.

    Rebalancing on the bucket gathers a range's rows into few files, and adaptive execution
    splits a range that holds too much for one task; a plain repartition would not.
    """
    bucketed = with_range_bucket(frame, key, low, high, count)
    bucketed.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
    return path


def read_account_range(
    spark: SparkSession,
    path: str,
    first: int | None = None,
    last: int | None = None,
    key: str = "account_id",
    low: int = ACCOUNT_RANGE_LOW,
    high: int = ACCOUNT_RANGE_HIGH,
    count: int = ACCOUNT_RANGE_COUNT,
) -> DataFrame:
    """Keys between ``first`` and ``last`` inclusive.

    Spark cannot know that the bucket follows from the key, so the bucket condition that the key
    condition implies is added here; with it only the directories in question are read.
    """
    return _within(spark.read.parquet(path), KeyRanges(key, low, high, count), first, last)


@dataclass(frozen=True)
class KeyRanges:
    """The key of a table and the ranges that its partitions stand for."""

    key: str = "account_id"
    low: int = ACCOUNT_RANGE_LOW
    high: int = ACCOUNT_RANGE_HIGH
    count: int = ACCOUNT_RANGE_COUNT


def _within(
    frame: DataFrame, ranges: KeyRanges, first: int | None, last: int | None
) -> DataFrame:
    def bucket_of(value: int):
        return F.width_bucket(
            F.lit(value), F.lit(ranges.low), F.lit(ranges.high), F.lit(ranges.count).cast("bigint")
        )

    key = F.col(ranges.key)
    if first is not None:
        frame = frame.where((key >= first) & (F.col(BUCKET) >= bucket_of(first)))
    if last is not None:
        frame = frame.where((key <= last) & (F.col(BUCKET) <= bucket_of(last)))
    return frame


def table_ranges(spark: SparkSession, name: str) -> KeyRanges:
    """The ranges that a table was declared with."""
    declared = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if f"{_PROPERTY}key" not in declared:
        raise SchemaError(f"table {name} is not partitioned by ranges")
    low, high, count = (int(declared[_PROPERTY + p]) for p in ("low", "high", "count"))
    return KeyRanges(declared[f"{_PROPERTY}key"], low, high, count)


def ensure_range_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    ranges: KeyRanges = KeyRanges(),
    location: str | None = None,
) -> None:
    """Create an empty table with the declared columns, partitioned by the range of its key, if it
    does not exist. The ranges are kept with the table: nobody has to know them to fill or
    read it. A table that exists with other ranges is an error."""
    if ranges.key not in schema.fieldNames() or BUCKET in schema.fieldNames():
        raise SchemaError(f"the columns need {ranges.key} and must not have {BUCKET}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    where = "" if location is None else f" LOCATION '{location}'"
    properties = ", ".join(f"'{_PROPERTY}{k}' = '{v}'" for k, v in vars(ranges).items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, `{BUCKET}` BIGINT) USING parquet"
        f" PARTITIONED BY (`{BUCKET}`){where} TBLPROPERTIES ({properties})"
    )
    if table_ranges(spark, name) != ranges:
        raise SchemaError(f"table {name} exists with other ranges")


def load_range_table(frame: DataFrame, name: str, overwrite: bool = False) -> None:
    """Put rows with the table's declared columns into it. The partition is derived from the key
    and cannot be given, so a row is always where a reader looks for it."""
    spark = frame.sparkSession
    ranges = table_ranges(spark, name)
    declared = StructType([f for f in spark.table(name).schema if f.name != BUCKET])
    bucketed = with_range_bucket(
        conform(frame, declared), ranges.key, ranges.low, ranges.high, ranges.count
    )
    bucketed.hint("rebalance", BUCKET).write.insertInto(name, overwrite=overwrite)


def read_range_table(
    spark: SparkSession, name: str, first: int | None = None, last: int | None = None
) -> DataFrame:
    """Rows with keys between ``first`` and ``last`` inclusive, from their partitions alone."""
    return _within(spark.table(name), table_ranges(spark, name), first, last)
