"""Mixing sources to target weights by weighted sampling with exponential keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import register, row_digest, table, text_of, words_of, written

WEIGHTS = (1.0, 2.0, 3.0)  # by source in code point order, repeating
MAX_EPOCHS = 3
BUCKET_ROWS, MAX_BUCKETS = 500, 65_536  # rows per step of the prefix sum, steps per source


def letter_share(text: Column) -> Column:
    """Quality of a document between 0.1 and 1: its share of letters, marks left out."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return F.greatest(F.lit(0.1), letters / F.greatest(F.length(text), F.lit(1)))


def source_targets(
    sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, most: int = MAX_EPOCHS
) -> dict[str | None, float]:
    """Words to take from each source.

    Sources by code point, null last, share all sizes by weight; one whose share exceeds ``most`` times its
    size stops there, and the excess goes to the others by weight until none is above.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    left, free, targets = float(sum(sizes.values())), set(names), {}
    while free:
        unit = left / sum(weight[s] for s in names if s in free)
        full = [s for s in names if s in free and weight[s] * unit > most * sizes[s]]
        if not full:
            targets |= {s: weight[s] * unit for s in free}
            break
        for s in full:
            targets[s] = float(most * sizes[s])
            left -= targets[s]
            free.discard(s)
    return targets


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MAX_EPOCHS, quality: Column | None = None
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, source, text_key`` for every row.

    ``size`` counts words, none for a missing text. A source gives complete epochs of all its documents, as many
    as its target holds; the rest comes from its documents by rising key ``-ln(u) / quality``, ``u`` being a hash of
    doc_id and text, until their sizes reach the target. The document that crosses it gives only what is missing, so a source's
    taken words equal its target rounded. Reruns agree. Rows alike in doc_id and text have equal keys; which of them
    the target cuts is not told apart. A missing source is a source of its own, last. Documents without words take
    none. An empty table gives an empty result; other columns are not read.

    The prefix sum has two steps: sums of key ranges, then rows within one, so no source is sorted
    in one task. The driver sees one row per source.
    """
    text = text_of()
    u = (F.pmod(F.xxhash64(F.lit("mix"), "__row"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    rows = docs.select(
        F.col("doc_id"),
        F.col("source"),
        F.size(words_of(text)).cast("bigint").alias("size"),
        row_digest("doc_id", "text").alias("__row"),
        (letter_share(text) if quality is None else quality).cast("double").alias("__quality"),
    )
    rows = rows.select("doc_id", "source", "size", "__row", (-F.log(u) / F.col("__quality")).alias("__key"))
    rows = written(rows, "mix_rows")
    totals = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    targets = source_targets({r["source"]: r["size"] for r in totals}, weights, most)
    plan = []
    for r in totals:
        target = round(targets[r["source"]])
        epochs = min(most, target // r["size"]) if r["size"] else 0
        buckets = min(MAX_BUCKETS, r["n"] // BUCKET_ROWS + 1)
        plan.append((r["source"], r["size"], targets[r["source"]], epochs, target - epochs * r["size"], buckets))
    plan = docs.sparkSession.createDataFrame(
        plan, "source string, source_size bigint, target double, epochs bigint, budget bigint, buckets bigint"
    )
    plan = plan.withColumnRenamed("source", "__source")  # one row per source: Spark broadcasts it only when small
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("__source")))
    rows = rows.drop("__source").withColumn("__bucket", F.floor(F.col("buckets") * F.col("__key") / (F.col("__key") + 1)))
    sums = rows.groupBy("source", "__bucket").agg(F.sum("size").alias("__sum"))
    before = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("__s"), F.col("__bucket").alias("__b"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before")
    )
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__bucket") == F.col("__b")))
    within = Window.partitionBy("source", "__bucket").orderBy("__key", "doc_id", "__row").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("__before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    part = F.greatest(F.lit(0), F.least("size", F.col("budget") - start))
    return rows.select(
        "doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).cast("bigint").alias("taken"),
        "source", F.col("__row").alias("text_key"),
    )


def mixed_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """The mix as rows with the columns of ``docs``: a document stands there as often as it is taken whole.

    The one that a source's target cuts comes with its first words, joined by single spaces, and ``n_chars``
    counts these where the table has that column. Documents without words are never taken.
    """
    taken = mix_sources(docs, weights, most).groupBy("text_key").agg(F.sum("taken").alias("__taken"), F.first("size").alias("__size"))
    rows = docs.select(F.struct("*").alias("__doc"), row_digest("doc_id", "text").alias("text_key")).dropDuplicates(["text_key"])
    rows = rows.join(taken.where("__taken > 0"), "text_key")
    whole, part = F.floor(F.col("__taken") / F.col("__size")), F.col("__taken") % F.col("__size")
    copies = F.array_repeat(F.lit(0).cast("bigint"), whole.cast("int"))
    rows = rows.select(
        "__doc", F.explode(F.concat(copies, F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))).alias("__part")
    )
    text = F.col("__doc.text")
    first = F.array_join(F.slice(words_of(text), F.lit(1), F.col("__part").cast("int")), " ")
    rows = rows.withColumn("__text", F.when(F.col("__part") == 0, text).otherwise(first))
    columns = {c: F.col(f"__doc.`{c}`") for c in docs.columns} | {"text": F.col("__text")}
    if "n_chars" in columns:
        cut = F.length("__text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("__part") == 0, F.col("__doc.n_chars")).otherwise(cut)
    return rows.select([c.alias(n) for n, c in columns.items()])


@register()
def op2_source_mixing(spark, sf_dir):
    """All documents mixed by weights 1, 2, 3 of their sources."""
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")
