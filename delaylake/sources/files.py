"""File scans with the missing-file and empty-file policies."""

from __future__ import annotations

import codecs
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import IATA_DELAY_CODES, WEATHER_CODES


# Names under which Spark knows the encodings Python spells differently.
_SPARK_ENCODINGS = {"iso8859-1": "ISO-8859-1", "ascii": "US-ASCII"}


def load_if_present(spark: SparkSession, path: str, load: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame ``load`` gives, or None when nothing is at ``path``; the file system is asked, no job is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return load() if found else None


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    sep: str = ",",
    encoding: str = "utf-8",
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header. ``encoding`` takes any usual name of one Spark reads.

    With ``multi_line`` quoted values may hold line breaks; Spark then reads each file in one task. Without, large files
    are split among tasks.
    """
    encoding = _SPARK_ENCODINGS.get(codecs.lookup(encoding).name, encoding)
    return spark.read.schema(schema).csv(
        path, header=True, sep=sep, encoding=encoding, multiLine=multi_line, quote='"', escape='"', mode="FAILFAST"
    )


def read_parquet(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    require_file: bool = False,
    require_rows: bool = False,
) -> DataFrame:
    """Parquet with an explicit schema.

    A missing path is an error with ``require_file`` and an empty frame without; ``require_rows``
    refuses an empty result (it reads at most one row).
    """
    df = load_if_present(spark, path, lambda: spark.read.schema(schema).parquet(path))
    if df is None:
        if require_file:
            raise FileNotFoundError(path)
        df = spark.createDataFrame([], schema)
    if require_rows and df.isEmpty():
        raise ValueError(f"{path} has no rows")
    return df


def with_file_position(df: DataFrame, into: str = "file_position") -> DataFrame:
    """``df``, just read from Parquet, with where each row stands: its file, and its place there.

    Files come in the order of their paths. The column outlives filters and joins, so it can order rows later (W1).
    """
    return df.withColumn(into, F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")))


def read_reference_codes(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Delay codes (``kind="iata"``) or weather codes (``kind="weather"``) from their CSV files."""
    return read_csv(spark, path, {"iata": IATA_DELAY_CODES, "weather": WEATHER_CODES}[kind], multi_line=True)
