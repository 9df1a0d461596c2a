"""Reading and writing tables, reports and views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

IMPORTANCE_SCHEMA = "feature string, importance double"


class SchemaError(ValueError):
    """A frame does not have the declared columns."""


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Headered CSV with a declared schema; a wrong header or value is an error."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_csv(frame: DataFrame, path: str) -> str:
    """CSV with header, one file per task."""
    frame.write.mode("overwrite").option("header", True).csv(path)
    return path


def conform(frame: DataFrame, schema: StructType, allow_extra: bool = False) -> DataFrame:
    """Project and cast to the declared columns; names what is missing or unexpected."""
    declared = schema.fieldNames()
    missing = [c for c in declared if c not in frame.columns]
    extra = [] if allow_extra else [c for c in frame.columns if c not in declared]
    if missing or extra:
        raise SchemaError(f"missing columns {missing}, unexpected columns {extra}")
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database if it does not exist."""
    where = "" if location is None else f" LOCATION '{location}'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def ensure_table(
    spark: SparkSession, name: str, schema: StructType, location: str | None = None
) -> None:
    """Create an empty table with the declared columns if it does not exist."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    where = "" if location is None else f" LOCATION '{location}'"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where}")


def load_table(frame: DataFrame, name: str, schema: StructType, overwrite: bool = True) -> None:
    """Put rows with the declared columns into an existing table."""
    conform(frame, schema).write.insertInto(name, overwrite=overwrite)


def scan_view(spark: SparkSession, name: str) -> DataFrame:
    """All rows of a named table or view, still lazy: later filters and projections reach it."""
    return spark.table(name)


def register_views(views: Mapping[str, DataFrame]) -> list[str]:
    """Create or replace lazy views."""
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return list(views)


def materialise(frame: DataFrame, path: str) -> DataFrame:
    """Write once as parquet and read back: stored rows, no lineage left."""
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def write_metrics_json(metrics: DataFrame, path: str) -> str:
    """A metric record as JSON; null metrics are kept."""
    metrics.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def read_report_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", False).json(path)


def read_report_csv(
    spark: SparkSession, path: str, schema: StructType | str = IMPORTANCE_SCHEMA
) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_report_in_order(
    spark: SparkSession, path: str, schema: StructType | str, position: str = "place"
) -> DataFrame:
    """A CSV report with the place of every row in it, from 1: files by name, rows as they stand.

    Spark writes an ordered frame's partitions to files in order, so the places are those of the
    order that was written. Reports are of bounded size: all rows are numbered in one task.
    """
    rows = read_report_csv(spark, path, schema).select(
        "*",
        F.col("_metadata.file_name").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__row"),
    )
    order = Window.orderBy("__file", "__block", "__row")
    numbered = rows.withColumn(position, F.row_number().over(order).cast("bigint"))
    return numbered.drop("__file", "__block", "__row")
