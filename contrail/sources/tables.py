"""Parquet and CSV tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contrail.operators.clean import require_columns
from contrail.session import materialize


def read_table(
    spark: SparkSession, path: str, cols: Sequence[str] | None = None, required: Sequence[str] = ()
) -> DataFrame:
    """Parquet table reduced to those of ``cols`` it has; the scan reads only them."""
    df = require_columns(spark.read.parquet(path), required)
    return df if cols is None else df.select(*[c for c in cols if c in df.columns])


def load_split(spark: SparkSession, path: str, split: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows of one split; on a table partitioned by ``split`` only that folder is listed."""
    df = spark.read.parquet(path).where(F.col("split") == split)
    return df if cols is None else df.select(*[c for c in cols if c in df.columns])


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, cols: Sequence[str] | None = None
) -> DataFrame:
    """CSV with a header and a declared schema (no inference pass)."""
    df = spark.read.csv(path, schema=schema, header=True)
    return df if cols is None else df.select(*cols)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), max_records: int = 5_000_000
) -> None:
    """Snappy parquet, replaced as a whole.

    Tasks write what they hold: rows are not shuffled by partition value first, which would send a split holding
    a third of the rows to one task. ``max_records`` bounds the file size instead.
    """
    writer = df.write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", max_records)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def with_row_id(df: DataFrame, out: str = "ID") -> DataFrame:
    """Number rows 0, 1, 2 ... in file order.

    The rows are stored first. Each stored row then knows its place within its file, and one small table says
    how many rows the files before it hold; no row moves and no global order is computed.
    """
    stored = materialize(df, "numbered")
    rows = stored.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = files.select("_file", F.coalesce(before, F.lit(0)).alias("_before"))  # one row per file
    return rows.join(offsets, "_file").select((F.col("_before") + F.col("_row")).alias(out), *df.columns)
