"""Language identification by a byte convolutional network trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import register, table, written

LENGTH = 128  # bytes of a window
WIDTHS, FILTERS, EMBEDDING = (2, 3, 4), 16, 8
SAMPLE_ROWS = 2_000  # of the labelled sample, shared equally by the languages
LEAST_ROWS = 100  # of each language, however many languages there are
SAMPLE_WINDOWS = 4  # windows of a sampled document used for training
EPOCHS, BATCH, RATE, SEED = 6, 128, 4e-3, 7


@dataclass
class Network:
    """Byte embedding, filters of several widths, maximum over positions, softmax.

    A filter over embedded bytes is a sum of one table entry per byte, so applying it needs look-ups only.
    """

    labels: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # per width: width x EMBEDDING x FILTERS
    bias: list[np.ndarray]
    dense: np.ndarray
    offset: np.ndarray

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        out = []
        for kernel, bias in zip(self.filters, self.bias):
            tables = np.einsum("be,kef->kbf", self.embedding, kernel).astype(np.float32)
            last = windows.shape[1] - len(kernel) + 1
            total = tables[0][windows[:, :last]]
            for k in range(1, len(kernel)):
                total += tables[k][windows[:, k : k + last]]
            out.append(np.maximum(total.max(1) + bias, 0))
        return np.concatenate(out, 1)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        scores = self.pooled(windows) @ self.dense + self.offset
        scores -= scores.max(1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(1, keepdims=True))


def windows_of(text: str, length: int = LENGTH) -> np.ndarray:
    """All bytes of the lower-cased text, in windows of fixed length; the last is filled with blanks."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    count = max(1, -(-len(data) // length))
    out = np.full(count * length, 32, np.uint8)
    out[: len(data)] = data
    return out.reshape(count, length)


def train(texts: Sequence[str], labels: Sequence[str], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Fit by Adam on single windows; the same texts in the same order give the same network."""
    rng = np.random.default_rng(seed)
    names = sorted(set(labels))
    parts, target = [], []
    for text, label in zip(texts, labels):
        w = windows_of(text)
        parts.append(w[rng.permutation(len(w))[:SAMPLE_WINDOWS]])
        target += [names.index(label)] * len(parts[-1])
    x, y = np.concatenate(parts), np.array(target)
    weight = (len(y) / len(names) / np.bincount(y, minlength=len(names)))[y]  # rare languages count as much
    p = [rng.normal(0, 0.3, (256, EMBEDDING))]
    p += [rng.normal(0, (w * EMBEDDING) ** -0.5, (w, EMBEDDING, FILTERS)) for w in WIDTHS]
    p += [np.zeros(FILTERS) for _ in WIDTHS]
    p += [rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(names))), np.zeros(len(names))]
    p = [a.astype(np.float32) for a in p]
    moment, square = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    n, step = len(WIDTHS), 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at : at + BATCH]
            xb, count = x[rows], len(rows)
            embedded = p[0][xb]  # rows x LENGTH x EMBEDDING
            pooled, where = [], []
            for k, width in enumerate(WIDTHS):
                last = LENGTH - width + 1
                stacked = np.concatenate([embedded[:, j : j + last] for j in range(width)], 2)
                response = stacked @ p[1 + k].reshape(-1, FILTERS)
                best = response.argmax(1)
                pooled.append(np.take_along_axis(response, best[:, None], 1)[:, 0] + p[1 + n + k])
                where.append(best)
            hidden = np.maximum(np.concatenate(pooled, 1), 0)
            scores = hidden @ p[-2] + p[-1]
            scores -= scores.max(1, keepdims=True)
            chance = np.exp(scores)
            chance /= chance.sum(1, keepdims=True)
            chance[np.arange(count), y[rows]] -= 1
            slope = (chance * weight[rows][:, None] / count).astype(np.float32)
            grad = [np.zeros_like(a) for a in p]
            grad[-2], grad[-1] = hidden.T @ slope, slope.sum(0)
            back = (slope @ p[-2].T) * (hidden > 0)
            for k, width in enumerate(WIDTHS):
                part = back[:, k * FILTERS : (k + 1) * FILTERS]
                grad[1 + n + k] = part.sum(0)
                for j in range(width):
                    bytes_at = np.take_along_axis(xb, where[k] + j, 1)  # rows x FILTERS
                    grad[1 + k][j] = np.einsum("rf,rfe->ef", part, p[0][bytes_at])
                    np.add.at(grad[0], bytes_at, part[:, :, None] * p[1 + k][j].T[None])
            step += 1
            for a, g, m, s in zip(p, grad, moment, square):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                a -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Network(names, p[0], p[1 : 1 + n], p[1 + n : 1 + 2 * n], p[-2], p[-1])


def held_out(doc_id: str | Column = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def training_sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[list[str], list[str]]:
    """Distinct labelled texts that are not held out: of each language the same number, those with the least hash.

    A language's quota is its equal share of ``rows``, but at least ``LEAST_ROWS``, and all its texts where it has fewer. A text
    counts once, under its most frequent label, however many copies it has. Only hashes and labels are shuffled to
    choose; each chosen text then sends its hash-chosen part of 2,048 characters to the driver, so the sample's size
    is bounded in bytes by the number of languages.
    """
    part = F.substring("text", (F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - 2047, F.lit(1))) + 1).cast("int"), F.lit(2048))
    usable = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    usable = usable.select(F.xxhash64(F.lit("sample"), "text").alias("h"), part.alias("part"), "lang")
    counts = usable.groupBy("h", "lang").agg(F.count("*").alias("n"))
    texts = written(counts.groupBy("h").agg(F.max_by("lang", F.struct("n", "lang")).alias("lang")), "language_texts")
    languages = texts.select("lang").distinct().count()
    quota = max(LEAST_ROWS, rows // max(1, languages))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = written(texts.withColumn("place", place).where(F.col("place") <= quota).select("h", "lang"), "language_sample")
    parts = usable.select("h", "part").join(chosen, "h").groupBy("h", "lang").agg(F.min("part").alias("part"))
    got = parts.orderBy("h").collect()
    return [r["part"] for r in got], [r["lang"] for r in got]


def identify(docs: DataFrame, network: Network) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row.

    A document's score of a language is the softmax of its windows' mean log probabilities over the whole text, read in batches
    of fixed-length windows. A missing text, or one without a letter, is ``und`` with score 0. A missing doc_id is not held out.
    Repeated rows get the same answer, an empty table gives an empty result; columns other than doc_id and text are not read.
    """
    labels = np.array(network.labels)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sums = np.zeros((len(texts), len(labels)))
            counts = np.zeros(len(texts))
            held, owners, waiting = [], [], 0

            def flush():
                x, owner = np.concatenate(held), np.concatenate(owners)
                for at in range(0, len(x), 64):
                    np.add.at(sums, owner[at : at + 64], network.log_probabilities(x[at : at + 64]))
                np.add.at(counts, owner, 1)
                held.clear()
                owners.clear()

            for i, text in enumerate(texts):
                if text is None:
                    continue
                w = windows_of(text)
                for at in range(0, len(w), 4096):
                    held.append(w[at : at + 4096])
                    owners.append(np.full(len(held[-1]), i))
                    waiting += len(held[-1])
                    if waiting >= 4096:
                        flush()
                        waiting = 0
            if held:
                flush()
            mean = sums / np.maximum(counts, 1)[:, None]
            chance = np.exp(mean - mean.max(1, keepdims=True)) if len(labels) else np.zeros((len(texts), 0))
            chance /= chance.sum(1, keepdims=True)
            best = chance.argmax(1)
            named = counts > 0
            yield pd.DataFrame(
                {
                    "lang_pred": np.where(named, labels[best], "und"),
                    "score": np.where(named, chance[np.arange(len(texts)), best], 0.0),
                }
            )

    lettered = F.when(F.col("text").rlike(r"\p{L}"), F.col("text"))
    rows = docs.select(
        F.col("doc_id"), F.coalesce(held_out(), F.lit(False)).alias("held_out"), predict(lettered).alias("p")
    )
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score")


def identify_languages(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Train on the bounded sample, then predict for every row; without labelled rows every answer is ``und``."""
    texts, labels = training_sample(docs, rows)
    if not labels:
        unknown = F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score")
        return docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), *unknown)
    return identify(docs, train(texts, labels))


@register()
def op10_language_id(spark, sf_dir):
    """Language of every document, learnt from those that are not held out."""
    return identify_languages(table(spark, sf_dir, "documents"))
