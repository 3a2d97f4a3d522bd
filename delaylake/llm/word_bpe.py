"""Encoding and decoding by a byte-pair vocabulary of lower-case words: numpy rounds over many words at once."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import register, table, text_of

# How this kind of vocabulary normalises and cuts a text.
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")

# Scripts whose letters and digits every Unicode version since the vocabulary's knows alike; texts with other characters
# are normalised and cut by the library that the vocabulary belongs to, since that decides which characters are letters.
OTHER_SCRIPTS = re.compile("[^\u0000-\u001b\u0020-©«-±´-¸»¿-ԯ‐-‧‰-⁞]")
SPACE = re.compile(r"[ \t\n\r]")

PIECE_CHARS = 1 << 20  # longer texts are read in pieces that end before white space
PENDING_WORDS = 200_000  # words coded together
KNOWN_SYMBOLS = 4_000_000  # symbols of words remembered between batches
NONE = np.iinfo(np.int32).max  # the rank of two symbols that never merge


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it prints, else the next one from U+0100 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    table = {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


class Vocabulary:
    """Symbols of bytes, merges as sorted pair keys, and the text of every id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, added = data["model"], data["added_tokens"]
        suffix = model["end_of_word_suffix"]
        cut = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if model["type"] != "BPE" or data["normalizer"]["normalizers"] != NORMALIZERS or cut != CUTS:
            raise ValueError(f"{path} is not a byte-pair vocabulary of lower-case words")
        if data["decoder"] is not None or any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path} has a decoder or added tokens of another kind")
        self.path, ids = path, model["vocab"]
        characters = _byte_characters()
        self.byte_of = {c: b for b, c in enumerate(characters)}
        self.inner = np.array([ids[c] for c in characters], np.int64)
        self.last = np.array([ids[c + suffix] for c in characters], np.int64)
        self.names = {a["content"]: a["id"] for a in added}
        self.name = re.compile("(" + "|".join(re.escape(n) for n in sorted(self.names, key=len, reverse=True)) + ")")
        self.texts = {i: token for token, i in ids.items()} | {i: n for n, i in self.names.items()}
        self.size = max(self.texts) + 1
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        order = np.argsort(left * self.size + right)
        self.keys = (left * self.size + right)[order]
        self.ranks, self.made = order.astype(np.int32), made[order]
        # Where each symbol is made once, after its parts, merging one pair cannot bring forth a pair of lower rank.
        since = np.full(self.size, -1)
        since[made] = np.arange(len(made))
        ranks = np.arange(len(made))
        self.orderly = len(np.unique(made)) == len(made) and bool(((since[left] < ranks) & (since[right] < ranks)).all())

    def look_up(self, words: np.ndarray, symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of the pairs that begin at ``at``, by binary search."""
        after = np.minimum(at + 1, len(symbols) - 1)
        keys = symbols[at] * self.size + symbols[after]
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = (self.keys[place] == keys) & (after > at) & (words[after] == words[at])
        return np.where(known, self.ranks[place], NONE), self.made[place]

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words, one behind the other, and how many each word has.

        ``symbols`` holds the words' base symbols. A round merges in every word the pair of lowest rank wherever it
        stands, left to right; only pairs beside a merge are looked up again. Words without a pair to merge leave the array.
        """
        words = np.repeat(np.arange(len(lengths)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank, made = self.look_up(words, symbols, np.arange(len(symbols)))
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
            sizes = np.diff(np.r_[starts, len(words)])
            least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            ended = least == NONE
            if ended.any():
                done.append((words[ended], symbols[ended]))
                words, symbols, rank, made, least = (x[~ended] for x in (words, symbols, rank, made, least))
                if not len(symbols):
                    break
            hits = np.flatnonzero(rank == least)
            if self.orderly:
                # In a run such as aaaa the pairs overlap: every second one merges.
                first = np.r_[True, np.diff(hits) != 1]
                hits = hits[(hits - np.maximum.accumulate(np.where(first, hits, 0))) % 2 == 0]
            else:
                hits = hits[np.r_[True, words[hits[1:]] != words[hits[:-1]]]]
            symbols[hits] = made[hits]
            stays = np.ones(len(symbols), bool)
            stays[hits + 1] = False
            at = (np.cumsum(stays) - 1)[hits]
            words, symbols, rank, made = (x[stays] for x in (words, symbols, rank, made))
            touched = np.concatenate([at, at[at > 0] - 1])
            rank[touched], made[touched] = self.look_up(words, symbols, touched)
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(lengths), np.int64)
        words, symbols = (np.concatenate(parts) for parts in zip(*done))
        return symbols[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(lengths))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def _library(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _pieces(text: str) -> Iterator[str]:
    """A long text in pieces that end before white space, which no word crosses."""
    at = 0
    while len(text) - at > PIECE_CHARS and (space := SPACE.search(text, at + PIECE_CHARS)):
        yield text[at : space.start()]
        at = space.start()
    yield text[at:]


class Encoder:
    """Ids of texts; words met before are remembered, new ones of a batch are merged together."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        # No word holds white space, so names of added tokens get keys of their own.
        names = self.vocabulary.names
        self.known = {" " + name: i for i, name in enumerate(names)}
        self.flat = np.array(list(names.values()), np.int64)
        self.starts, self.lengths = np.arange(len(names)), np.ones(len(names), np.int64)

    def _words(self, text: str) -> Iterator[list[str]]:
        for i, part in enumerate(self.vocabulary.name.split(text)):
            if i % 2:
                yield [" " + part]
                continue
            for piece in _pieces(part):
                if OTHER_SCRIPTS.search(piece):
                    yield self._other_words(piece)
                else:
                    # Without the capital whose lower case depends on its place, lower() goes character by character.
                    yield WORD.findall(unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower())

    def _other_words(self, piece: str) -> list[str]:
        library, byte_of = _library(self.vocabulary.path), self.vocabulary.byte_of
        found = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(piece))
        return [bytes(byte_of[c] for c in word).decode() for word, _ in found]

    def _codes(self, words: list[str]) -> np.ndarray:
        fresh = [w for w in dict.fromkeys(words) if w not in self.known]
        if fresh:
            data = [w.encode() for w in fresh]
            lengths = np.fromiter(map(len, data), np.int64, len(data))
            octets = np.frombuffer(b"".join(data), np.uint8)
            symbols = self.vocabulary.inner[octets]
            ends = np.cumsum(lengths) - 1
            symbols[ends] = self.vocabulary.last[octets[ends]]
            ids, counts = self.vocabulary.merge(symbols, lengths)
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
            self.lengths = np.concatenate([self.lengths, counts])
            self.flat = np.concatenate([self.flat, ids])
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def encode(self, texts: Iterable[str | None]) -> pa.Array:
        """One list of ids per text."""
        if len(self.flat) > KNOWN_SYMBOLS:
            self._forget()
        pending: list[str] = []
        codes, counts = [np.zeros(0, np.int64)], [0]
        for text in texts:
            counts.append(0)
            for words in self._words(text or ""):
                pending += words
                counts[-1] += len(words)
                if len(pending) > PENDING_WORDS:
                    codes.append(self._codes(pending))
                    pending = []
        codes = np.concatenate([*codes, self._codes(pending)])
        lengths = self.lengths[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        places = np.repeat(self.starts[codes] - ends[:-1], lengths) + np.arange(ends[-1])
        offsets = ends[np.cumsum(counts)]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(self.flat[places], pa.int32()))


def decoder(vocabulary: Vocabulary, ids: pa.Array) -> pa.Array:
    """The texts of lists of ids, joined by a space; an id that the vocabulary lacks adds nothing."""
    texts = vocabulary.texts
    out = []
    for row in ids:
        found = row.values.to_numpy() if row.is_valid else ()
        out.append(" ".join([texts[i] for i in found.tolist() if i in texts]) if len(found) else "")
    return pa.array(out, pa.string())


def encoded_ids(text: Column, path: str) -> Column:
    """Ids of a text column (array of int); NULL and empty texts have none."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(vocabulary(path))
        for batch in batches:
            yield encoder.encode(batch.to_pylist())

    return encode(text)


def decoded_text(ids: Column, path: str) -> Column:
    """The text of an array of ids; NULL and no ids give the empty text."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield decoder(vocabulary(path), batch)

    return decode(ids)


def encode_documents(docs: DataFrame, path: str, column: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``column`` in ``into``, which replaces a column of that name.

    The vocabulary's added names are found first, in the text as it is; what stands between them is normalised, cut into
    words and merged word by word. A missing or empty text has no ids. Texts of any length are read whole, in pieces. Repeated
    rows stay, an empty table gives an empty one, and no other column is read, whatever its name. Tasks need nothing of one
    another: there is no shuffle, and a lost one is run again.
    """
    return docs.withColumn(into, encoded_ids(text_of(f"`{column}`"), path))


def decode_documents(encoded: DataFrame, path: str, column: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text of the ids of ``column`` in ``into``; the cases are those of ``encode_documents``."""
    return encoded.withColumn(into, decoded_text(F.col(f"`{column}`"), path))


def default_vocabulary() -> str:
    """Path of the public vocabulary of 49,408 ids."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register()
def op12_bpe_round_trip(spark, sf_dir):
    """Ids of all documents and the texts they decode to, as digests."""
    path = default_vocabulary()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = decode_documents(encode_documents(docs, path), path)
    return done.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
