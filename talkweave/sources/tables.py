"""Tables in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# one row per chat message, labels missing as NULL
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in (
            ("book_id", T.StringType()),
            ("bookclub", T.StringType()),
            ("topic", T.StringType()),
            ("course", T.StringType()),
            ("pseudonym", T.StringType()),
            ("message", T.StringType()),
            ("time", T.StringType()),
            ("is_answer", T.StringType()),
            ("chat_crew", T.StringType()),
            ("page", T.StringType()),
            ("response_number", T.StringType()),
            ("discussion_type", T.StringType()),
            ("dialogic_spell", T.StringType()),
            ("uptake", T.StringType()),
            ("question", T.StringType()),
            ("pivot", T.StringType()),
        )
    ]
)


def read_messages(
    spark: SparkSession, path: str, schema: T.StructType | str = MESSAGE_SCHEMA, columns: Sequence[str] | None = None,
    multi_line: bool = True, fmt: str = "csv",
) -> DataFrame:
    """Messages from CSV with a header and quoted line breaks (``fmt='csv'``), or from Parquet (``fmt='parquet'``).

    The schema is given, never inferred, so a scan starts without reading the data twice. An empty
    CSV field is NULL. A CSV file with line breaks inside quotes is read by one task: give
    many files, or ``multi_line=False`` where there are none, or Parquet. Parquet brings its own schema;
    columns it lacks are an error as soon as ``columns`` names them.
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt != "csv":
        raise ValueError(f"fmt {fmt!r}")
    else:
        df = (
            spark.read.schema(schema)
            .option("header", True)
            .option("multiLine", multi_line)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    return df.select(*columns) if columns else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash the rows over all cores when the scan alone gives fewer tasks than cores.

    For costly row-local work on small files. A scan with enough splits is returned unchanged, so
    large tables are never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    mode: str = "errorifexists",
) -> None:
    """Write Parquet (default), JSON or CSV, split into folders by ``partition_by``."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = (
            writer.option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
