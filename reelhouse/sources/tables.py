"""Reading and writing the box-office tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.schemas import SCHEMAS, schema_of


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table with its declared schema; nothing is inferred, filters and columns push down."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}")


def read_jdbc(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """The same table from a relational database. Give partitionColumn and bounds to read in parallel."""
    rows = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**options).load()
    return rows.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema_of(name).fields if f.name in rows.columns]
    )


def write_table(df: DataFrame, folder: str, name: str, partition_by: list[str] | None = None) -> None:
    """Replace a table; a partitioned one is written by partition, so a weekend lands in its own files."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{folder.rstrip('/')}/{name}")
