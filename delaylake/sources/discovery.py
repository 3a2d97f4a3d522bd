"""Landed files as a table: what to open is decided from names, sizes and times, before any file is."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .documents import read_weather_documents

# An airport in a path: its folder, or the three letters that end the name of a file.
_AIRPORT_FOLDER, _AIRPORT_NAME = r"airport_iata=([A-Z]{3})/", r"([A-Z]{3})\.json[^/]*$"


def file_table(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``path, length, modified, airport`` of the files below ``path``; no content is read.

    ``airport`` is NULL where the path names none. ``glob`` is a pattern for file names. Empty files do not appear.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    named = [F.nullif(F.regexp_extract("path", pattern, 1), F.lit("")) for pattern in (_AIRPORT_FOLDER, _AIRPORT_NAME)]
    files = reader.load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"), F.coalesce(*named).alias("airport"))


def read_weather_files(
    spark: SparkSession,
    path: str,
    airports: Iterable[str] | None = None,
    since: dt.datetime | None = None,
    multi_line: bool = True,
) -> DataFrame | None:
    """Weather documents of some airports, or of files changed after ``since``; None when no file is left.

    One path per file to open reaches the driver, as in any scan.
    """
    files = file_table(spark, path)
    if airports is not None:
        files = files.where(F.col("airport").isin(list(airports)))
    if since is not None:
        files = files.where(F.col("modified") > F.lit(since))
    paths = [row.path for row in files.select("path").orderBy("path").collect()]
    return read_weather_documents(spark, paths, multi_line, base_path=path) if paths else None


def content_digest(spark: SparkSession, path: str) -> str:
    """A digest of all bytes below ``path``, whatever the files' names and times; for small files such as code lists."""
    files = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("digest"))
    return files.agg(F.sha2(F.array_join(F.sort_array(F.collect_list("digest")), ","), 256)).first()[0]
