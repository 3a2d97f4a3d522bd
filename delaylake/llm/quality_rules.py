"""Quality rules: robust multivariate outliers by minimum covariance determinant, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, kept_rows, register, table, text_of, written

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50  # fixed values of the base rule
UNIT = 1024  # transformed statistics are whole multiples of 1/UNIT, so that sums are exact in any order
#: Transformed statistics, with the least standard deviation assumed of each (a group of near equal values has
#: no scale of its own) and the greatest value, which bounds their distinct values.
STATISTICS = {
    "x_length": (0.7, 24.0),  # log2 of words
    "x_word": (0.3, 16.0),  # log2 of characters per word
    "x_symbols": (1 / UNIT, 1.0),  # share of symbols among characters
    "x_lines": (0.05, 1.0),  # share of repeated lines
    "x_repeats": (0.05, 1.0),  # share of words in repeated windows
}
COVERED = 0.75  # share of a group's documents whose covariance determinant is made small
STEPS = 4  # concentration steps after the start
#: Covariances of the covered part times this are those of a normal distribution: 0.75 / P(chi2(7) <= q), with q the quantile
#: of chi2(5) at 0.75.
CONSISTENCY = 0.75 / 0.5311
CUT = 25.745  # squared distance: the quantile of chi2(5) at 0.9999
LEAST_GROUP = 200  # smaller groups of a language are estimated together, and smaller languages with all languages
LEAST_TABLE = 25  # documents, five for each statistic; fewer in the whole table give no estimate
SYMBOLS = r"[#*$%&|<>]"


def base_statistics(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with ``__n_words, __word_chars, __n_symbols, __n_dup_lines, __n_repeat_words``.

    Everything is computed within the row: a window of three words is found twice when its hash stands beside an
    equal one in the sorted hashes of the row.
    """
    text = text_of()
    words, windows = F.col("__words"), F.col("__windows")
    at = lambda i: F.get(words, i)
    hashed = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(F.xxhash64(at(i), at(i + 1), at(i + 2)).alias("h"), i.alias("i"))
    )
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    same = lambda i, j: F.get(windows, i)["h"] == F.get(windows, j)["h"]
    twice = F.filter(
        F.transform(
            windows,
            lambda w, k: F.when(
                F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)), w["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform(F.col("__twice"), lambda i: F.array(i, i + 1, i + 2)))))
    rows = docs.withColumn("__words", F.array_remove(F.split(text, SPACES), ""))
    rows = rows.withColumn(
        "__windows", F.array_sort(F.when(F.size(words) >= 3, hashed).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    )
    rows = rows.withColumn("__lines", lines).withColumn("__twice", twice)
    return rows.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.size("__words").cast("bigint").alias("__n_words"),
        F.length(F.array_join("__words", "")).cast("bigint").alias("__word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("bigint").alias("__n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("__n_dup_lines"),
        covered.cast("bigint").alias("__n_repeat_words"),
    )


def _transformed(rows: DataFrame) -> DataFrame:
    """The statistics as whole numbers of 1/UNIT; only for rows that pass the base rule, which have words."""
    n = F.greatest(F.col("__n_words"), F.lit(1)).cast("double")
    values = {
        "x_length": F.log2(n),
        "x_word": F.log2(F.greatest(F.col("__word_chars") / n, F.lit(1.0))),
        "x_symbols": F.col("__n_symbols") / F.greatest(F.col("__word_chars"), F.lit(1)),
        "x_lines": F.col("__n_dup_lines") / n * 10,
        "x_repeats": F.col("__n_repeat_words") / n,
    }
    return rows.withColumns(
        {k: F.round(F.least(v, F.lit(STATISTICS[k][1])) * UNIT).cast("bigint") for k, v in values.items()}
    )


def _lower(estimates: DataFrame) -> DataFrame:
    """Means and Cholesky factors of each group from its exact sums; one small row per group."""
    names = list(STATISTICS)
    n = F.col("n").cast("double")
    out = {f"m_{a}": F.col(f"s_{a}") / n / float(UNIT) for a in names}
    rows = estimates.withColumns(out)
    for i, a in enumerate(names):
        for j in range(i + 1):
            b = names[j]
            rest = F.col(f"p_{a}_{b}") / n / float(UNIT * UNIT) - F.col(f"m_{a}") * F.col(f"m_{b}")
            if i == j:
                rest = rest + STATISTICS[a][0] ** 2  # the floor, as a ridge
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            rows = rows.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l_{j}_{j}"))
    return rows.select("g_lang", "g_source", *out, *[f"l_{i}_{j}" for i in range(len(names)) for j in range(i + 1)])


def _by_factors() -> Column:
    y: list[Column] = []
    for i, name in enumerate(STATISTICS):
        rest = F.col(name) / float(UNIT) - F.col(f"m_{name}")
        for k in range(i):
            rest = rest - F.col(f"l_{i}_{k}") * y[k]
        y.append(rest / F.col(f"l_{i}_{i}"))
    return sum((v * v for v in y[1:]), y[0] * y[0])


def _sums() -> list[Column]:
    names = list(STATISTICS)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[: i + 1]]
    return [F.count("*").alias("n"), *[F.sum(a).alias(f"s_{a}") for a in names]] + [
        F.sum((F.col(a) * F.col(b)).cast("decimal(24,0)")).alias(f"p_{a}_{b}") for a, b in pairs
    ]


def _grouped(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with their group's columns; groups are few against rows, and Spark broadcasts them only when small."""
    g = groups.withColumnsRenamed({"g_lang": "__gl", "g_source": "__gs"})
    on = F.col("g_lang").eqNullSafe(F.col("__gl")) & F.col("g_source").eqNullSafe(F.col("__gs"))
    return rows.join(g, on).drop("__gl", "__gs")


def robust_estimates(rows: DataFrame) -> DataFrame:
    """Mean and Cholesky factors per group by concentration steps.

    The start takes the share ``COVERED`` of documents nearest to the medians in units of the median
    deviations; each step takes those nearest under the mean and covariance of the last, which never
    raises the determinant. Medians and quantiles are taken over whole numbers, so tasks exchange counts
    per value, not documents, and results do not depend on the order of rows.
    """
    names = list(STATISTICS)
    groups = ["g_lang", "g_source"]
    medians = rows.groupBy(*groups).agg(*[F.percentile(a, F.lit(0.5)).alias(f"c_{a}") for a in names])
    away = _grouped(rows, written(medians, "mcd_medians"))
    spread = away.groupBy(*groups).agg(
        *[F.first(f"c_{a}").alias(f"c_{a}") for a in names],
        *[F.percentile(F.abs(F.col(a) - F.col(f"c_{a}")), F.lit(0.5)).alias(f"d_{a}") for a in names],
    )
    spread = written(spread, "mcd_spread")
    scaled = [
        F.pow((F.col(a) - F.col(f"c_{a}")) / (F.col(f"d_{a}") * 1.4826 + STATISTICS[a][0] * UNIT), F.lit(2.0)) for a in names
    ]
    near = _grouped(rows, spread).withColumn("__d", sum(scaled[1:], scaled[0]))
    estimates = None
    for _ in range(STEPS + 1):
        # Distances to whole steps of 1/128 of their logarithm: a bounded number of values per group.
        near = near.withColumn("__q", F.round(F.log1p("__d") * 128).cast("bigint"))
        cut = near.groupBy(*groups).agg(F.percentile("__q", F.lit(COVERED)).alias("__cut"))
        chosen = _grouped(near.select(*groups, *names, "__q"), cut).where(F.col("__q") <= F.ceil("__cut"))
        estimates = written(_lower(chosen.groupBy(*groups).agg(*_sums())), "mcd_step")
        near = _grouped(rows, estimates).withColumn("__d", _by_factors())
    return estimates


def judge_quality(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with ``__n_words, __word_chars, __n_symbols, __n_dup_lines, __n_repeat_words`` and the verdict of
    the base rule, ``__base_failed``: fewer than 50 words, or over half of them in repeated windows of three."""
    judged = base_statistics(docs)
    judged = judged.withColumn(
        "__base_failed",
        (F.col("__n_words") < MIN_WORDS) | (100 * F.col("__n_repeat_words") > MAX_REPEAT_PERCENT * F.col("__n_words")),
    )
    return judged


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, text_sha256``.

    The base rule of ``judge_quality`` rejects first. Among the rest, each language and source has its own estimate; sources of a
    language with fewer than ``LEAST_GROUP`` documents share one, and where even that is smaller, one over the documents of all
    languages serves; only a table of fewer than ``LEAST_TABLE`` loses none. A document goes when its squared distance, made
    consistent, exceeds ``CUT``. A missing language or source is a group like any other, a missing text has no words. Repeated
    rows get the same verdict, other columns are not read, whatever their names, and an empty table gives an empty result.
    """
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "text"
    )
    rows = judge_quality(narrow).withColumn("text_sha256", F.sha2(text_of().cast("binary"), 256)).drop("text")
    rows = written(rows, "quality_rows")
    # Small groups of a language together, and small languages together, under names of their own kind: a number sets them apart.
    sizes = rows.where("not __base_failed").groupBy("g_lang", "g_source").agg(F.count("*").alias("__n"))
    sizes = written(sizes, "quality_groups").select(F.col("g_lang").alias("__l"), F.col("g_source").alias("__s"), "__n")
    small = sizes.where(F.col("__n") < LEAST_GROUP).groupBy("__l").agg(F.sum("__n").alias("__pool"))
    sizes = sizes.join(small.withColumnRenamed("__l", "__k"), F.col("__l").eqNullSafe(F.col("__k")), "left").drop("__k")
    level = F.when(F.col("__n") >= LEAST_GROUP, 0).when(F.col("__pool") >= LEAST_GROUP, 1).otherwise(2)
    sizes = written(sizes.select("__l", "__s", "__n", level.alias("__level")), "quality_levels")
    total, rare = sizes.agg(F.sum("__n"), F.max("__level")).first()
    on = F.col("g_lang").eqNullSafe(F.col("__l")) & F.col("g_source").eqNullSafe(F.col("__s"))
    passed = _transformed(rows.where("not __base_failed")).join(sizes.drop("__n"), on).drop("__l", "__s")
    at = F.col("__level")
    lang = F.struct(at.alias("level"), F.when(at < 2, F.col("g_lang")).alias("lang"))
    passed = passed.withColumns({"g_lang": lang, "g_source": F.when(at < 1, F.col("g_source"))}).drop("__level")
    passed = written(passed, "quality_passed")
    told = passed.select("g_lang", "g_source", *STATISTICS)
    if rare == 2:  # small languages are judged by an estimate over the documents of all languages
        everything = F.struct(F.lit(2).alias("level"), F.lit(None).cast("string").alias("lang"))
        told = told.where("g_lang.level < 2").unionByName(
            told.withColumns({"g_lang": everything, "g_source": F.lit(None).cast("string")})
        )
    estimates = robust_estimates(told)
    far = _grouped(passed, estimates).select(
        "doc_id", "__n_words", "__word_chars", "__n_symbols", "__n_dup_lines", "__n_repeat_words", "__base_failed", "text_sha256",
        ((_by_factors() <= CONSISTENCY * CUT) | F.lit((total or 0) < LEAST_TABLE)).alias("kept"),
    )
    failed = rows.where("__base_failed").select(*far.columns[:-1], F.lit(False).alias("kept"))
    plain = {c: c.removeprefix("__") for c in far.columns}
    return far.unionByName(failed).withColumnsRenamed(plain)


def clean_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; rows alike in doc_id and text stay once."""
    return kept_rows(docs, quality_verdicts(docs).where("kept"))


@register()
def op9_quality_rules(spark, sf_dir):
    """Quality verdict on every document."""
    return quality_verdicts(table(spark, sf_dir, "documents")).drop("text_sha256")
