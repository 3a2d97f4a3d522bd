"""Exact dedup by Grace hashing: spill buckets, open-addressing tables over complete content."""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_rows, register, table, text_of, written

TABLE_BYTES = 48 << 20  # complete content one table may hold
FAN_OUT = 16  # spill files per level of recursion

Record = tuple[bytes, "int | None", int]  # text, largest doc_id, rows


def _larger(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


def grace_groups(records: Iterable[Record], table_bytes: int = TABLE_BYTES, level: int = 0) -> Iterator[Record]:
    """One record per distinct text.

    A dict is the open-addressing table: it probes by hash and compares whole keys. When its content
    outgrows ``table_bytes``, records whose text it does not hold go to ``FAN_OUT`` spill files by the
    next digits of their digest, each then handled alike. A file with a single distinct text always
    fits, however large, so the recursion ends.
    """
    held: dict[bytes, list] = {}
    used, spills = 0, None
    for text, doc_id, n in records:
        entry = held.get(text)
        if entry is not None:
            entry[0] = _larger(entry[0], doc_id)
            entry[1] += n
        elif spills is None and (not held or used + len(text) <= table_bytes):
            held[text] = [doc_id, n]
            used += len(text) + 100
        else:
            if spills is None:
                spills = [tempfile.TemporaryFile() for _ in range(FAN_OUT)]
            digit = hashlib.blake2b(text, digest_size=8, key=level.to_bytes(4, "little")).digest()[0] % FAN_OUT
            pickle.dump((text, doc_id, n), spills[digit])
    for text, (doc_id, n) in held.items():
        yield text, doc_id, n
    held.clear()
    for file in spills or ():
        file.seek(0)
        yield from grace_groups(_unspilled(file), table_bytes, level + 1)
        file.close()


def _unspilled(file) -> Iterator[Record]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


_GROUP = pa.schema([("text", pa.binary()), ("keep_id", pa.int64()), ("n", pa.int64())])
_GROUP_DDL = "text binary, keep_id bigint, n bigint"


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[Record]:
    for batch in batches:
        columns = batch.to_pydict()
        yield from zip(columns["text"], columns["keep_id"], columns["n"])


def _batches(records: Iterable[Record], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, used = [], 0
    for record in records:
        held.append(record)
        used += len(record[0]) + 16
        if used >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _GROUP)], schema=_GROUP)
            held, used = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _GROUP)], schema=_GROUP)


def _combine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Before the shuffle: equal texts of one task become one record, within bounded memory."""

    def flushed():
        held: dict[bytes, list] = {}
        used = 0
        for text, doc_id, n in _records(batches):
            entry = held.get(text)
            if entry is not None:
                entry[0] = _larger(entry[0], doc_id)
                entry[1] += n
                continue
            held[text] = [doc_id, n]
            used += len(text) + 100
            if used > TABLE_BYTES:
                yield from ((t, *e) for t, e in held.items())
                held, used = {}, 0
        yield from ((t, *e) for t, e in held.items())

    yield from _batches(flushed())


def _resolve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _batches(grace_groups(_records(batches)))


def text_groups(docs: DataFrame) -> DataFrame:
    """One row per distinct text: ``text_sha256, keep_id, n``.

    Tasks combine their equal texts first, so a text with a third of all rows sends one record per
    task; the shuffle by digest is the first level of partitioning, spill files are the further ones.
    """
    rows = docs.select(
        text_of().cast("binary").alias("text"), F.col("doc_id").cast("bigint").alias("keep_id"), F.lit(1).cast("bigint").alias("n")
    )
    local = rows.mapInArrow(_combine, _GROUP_DDL)
    groups = local.repartition(F.xxhash64("text")).mapInArrow(_resolve, _GROUP_DDL)
    return groups.select(F.sha2("text", 256).alias("text_sha256"), "keep_id", "n")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with the document that stays for its text.

    Columns: ``doc_id, keep_id, group_size, kept, text_sha256``. A missing text equals an empty one. A
    missing doc_id counts as the smallest; a group without any doc_id has no keep_id and one of its rows
    stays. Of rows alike in doc_id and text exactly one stays, and each counts in ``group_size``. Other columns are
    not read, whatever their names. An empty table gives an empty result. Two different texts with one
    digest would end the job: texts are compared whole, and a digest must name one group.
    """
    groups = written(text_groups(docs), "exact_groups")
    if groups.groupBy("text_sha256").count().where("count > 1").take(1):
        raise ValueError("two texts share a digest")
    # Rows alike in doc_id and text are one row with a count from here on: no window over a large group.
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.sha2(text_of().cast("binary"), 256).alias("text_sha256")
    )
    rows = rows.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("copies"))
    joined = rows.join(groups, "text_sha256")
    return joined.select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"),
        "text_sha256",
    ).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256",
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return kept_rows(docs, exact_duplicates(docs).where("kept"))


@register("""
SELECT doc_id, max(doc_id) OVER t AS keep_id, count(*) OVER t AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW t AS (PARTITION BY coalesce(text, ''))
""")
def op4_exact_dedup(spark, sf_dir):
    """Exact duplicates among all documents."""
    return exact_duplicates(table(spark, sf_dir, "documents"))
