"""What the operators share: the registry, words as the contracts define them, and row identity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure as configure_library
from ..session import shared_folder, written

__all__ = [
    "ORACLES", "QUERIES", "configure", "kept_rows", "register", "row_digest", "row_key", "shared_folder", "table", "text_of",
    "words_of", "written",
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The white space that separates words, for Java's and RE2's patterns.
SPACES = r"[\x20\x09-\x0D]+"


# Python sees texts in batches of bounded bytes, however long the texts are.
BATCH_BYTES = "4m"


def configure(spark: SparkSession) -> SparkSession:
    configure_library(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    # Steps are written and read again, so shuffle files of a finished one serve nobody.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def register(sql: str | None = None):
    """Register under the function's name, with SQL that must give the same rows where SQL can say it."""

    def add(query: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(configure(spark), sf_dir)

        run.__doc__ = query.__doc__
        QUERIES[query.__name__] = run
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a missing one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Words: maximal runs of anything but space, tab, line feed, vertical tab, form feed, carriage return."""
    return F.array_remove(F.split(text, SPACES), "")


def row_key(*columns: str) -> Column:
    """A 64-bit key of a row's identity: rows equal in all these columns share it."""
    return F.xxhash64(*[F.struct(F.col(c)) for c in columns], *[F.col(c).isNull() for c in columns])


def row_digest(*columns: str) -> Column:
    """A 128-bit key of a row's identity, for steps that take rows of one key for the same."""
    parts = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.md5(F.concat(*parts))


def kept_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` named in ``kept`` (``doc_id``, ``text_sha256``), each once, with all their columns.

    Rows move by one key of doc_id and text, once: a text that many documents share is not one key, and the
    same partitioning serves to leave out repeated rows.
    """

    def key(sha: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), sha).alias("__key")

    rows = docs.select(F.struct("*").alias("__doc"), key(F.sha2(text_of().cast("binary"), 256)))
    named = kept.select(key(F.col("text_sha256")))
    return rows.join(named, "__key", "left_semi").dropDuplicates(["__key"]).select("__doc.*")
