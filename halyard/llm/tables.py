"""Reading inputs and storing intermediate tables in the shared folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard.sources.workspace import workspace_path

# --- fixed values: the white space that separates words -----------------------
SPACE = r"\x20\x09-\x0D"
# --- end of fixed values ----------------------------------------------------


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write the frame to the shared folder and read it back: it is computed once, its lineage
    is cut, and a lost executor costs no recomputation of what lies before."""
    path = workspace_path(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Delete the files of a stored frame that nothing reads any more."""
    files = frame.inputFiles()
    if files:
        context = frame.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def crc_remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % F.lit(modulus)


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def only(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns and no others, so that extra columns cannot clash with added ones."""
    return frame.select(*[F.col(f"`{c}`") for c in columns])
