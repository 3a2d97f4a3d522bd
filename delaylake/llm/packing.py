"""Packing documents into fixed windows by best-fit decreasing."""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import register, row_key, table, written

WINDOW = 1024
END_ID = 0  # follows every document
BLOCK_PIECES = 20_000  # pieces packed together
END_OF_TEXT = "<|endoftext|>"  # fixed value: the vocabulary's added token, whose id follows the ranks
# Fixed value: the pattern by which the byte-level vocabularies cut a text before merging.
CUTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], list[int]]:
    """Ids of a text by a public vocabulary file; the end-of-text name in a text is its one special id.

    A ``.json`` file is read by ``tokenizers``; a ``.tiktoken`` file holds a byte-level vocabulary as ranks, for which the
    quicker library gives the same ids of what stands between those names.
    """
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        special = {END_OF_TEXT: len(ranks)}
        encoding = tiktoken.Encoding("ranks", pat_str=CUTS, mergeable_ranks=ranks, special_tokens=special)
        return lambda text: encoding.encode(text, allowed_special="all")
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("row_key", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())]
)
_PIECES_DDL = "doc_id bigint, row_key bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary"


def document_pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Every document's ids, an end id behind them, cut into full windows and a rest.

    Without ``with_ids`` the column ``ids`` is null and only its digest travels.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        end = np.array([END_ID], "<u4").tobytes()
        size = 4 * window
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                data = np.array(encode(text or ""), "<u4").tobytes() + end
                for at in range(0, len(data), size):
                    piece = data[at : at + size]
                    rows.append((doc_id, key, at // 4, len(piece) // 4, zlib.crc32(piece), len(data) // 4, piece if with_ids else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key("doc_id", "text").alias("row_key"), "text")
    return rows.mapInArrow(cut, _PIECES_DDL)


def best_fit(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each piece, and the number of sequences.

    Longest first, ties in the given order. A segment tree over remaining capacities holds which of them some open
    window has; the least one that suffices is found by one climb and one descent.
    """
    size = 1 << window.bit_length()
    tree = [0] * (2 * size)  # open windows below each node
    open_at: list[list[int]] = [[] for _ in range(window + 1)]
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    made = 0

    def change(capacity: int, by: int) -> None:
        node = size + capacity
        while node:
            tree[node] += by
            node >>= 1

    def tightest(least: int) -> int:
        node = size + least
        if tree[node]:
            return least
        while node > 1 and (node & 1 or not tree[node + 1]):
            node >>= 1
        if node <= 1:
            return -1
        node += 1
        while node < size:
            node = 2 * node if tree[2 * node] else 2 * node + 1
        return node - size

    for i in np.argsort(-lengths, kind="stable"):
        length = int(lengths[i])
        capacity = tightest(length)
        if capacity < 0:
            where, capacity, made = made, window, made + 1
        else:
            where = open_at[capacity].pop()
            change(capacity, -1)
        sequence[i], offset[i] = where, window - capacity
        if capacity - length:
            open_at[capacity - length].append(where)
            change(capacity - length, 1)
    return sequence, offset, made


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (``ids`` on request).

    A missing or empty text is one piece, its end id. Full windows are sequences of their own. The rests are dealt by a hash
    of document and text into blocks of about ``BLOCK_PIECES``, and each block is packed by best fit, so a task holds
    numbers of one block only. Repeated rows spread like others, and each is packed. A sequence's id joins
    its block and its number there. Other columns are not read; an empty table gives an empty result.
    """
    pieces = document_pieces(docs, tokenizer_path, window, with_ids)
    pieces = written(pieces if with_ids else pieces.drop("ids"), "pieces")
    count = pieces.count()
    blocks = count // BLOCK_PIECES + 1
    # Equal rows would meet in one block: number them apart by chance of where they were read.
    block = F.pmod(F.xxhash64("row_key", "start", F.monotonically_increasing_id()), F.lit(blocks))
    columns = [f.name for f in pieces.schema.fields if f.name != "row_key"]
    schema = ", ".join(f"{c} {'binary' if c == 'ids' else 'bigint'}" for c in columns) + ", sequence_id bigint, offset bigint"

    def packed(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row_key", "start"], kind="stable", ascending=[False, True, True])
        sequence, offset, _ = best_fit(rows["length"].to_numpy(), window)
        return rows[columns].assign(sequence_id=(int(key[0]) << 32) + sequence, offset=offset)

    return pieces.withColumn("__block", block).groupBy("__block").applyInPandas(
        lambda key, rows: packed(key, rows), schema
    )


def default_tokenizer() -> str:
    """Path of the ranks of the public byte-level vocabulary of 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@register()
def op6_packing(spark, sf_dir):
    """All documents packed into sequences of at most 1024 ids."""
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer())
