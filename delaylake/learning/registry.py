"""Model registry rows and champion/challenger promotion (M8, M9)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def promote(
    registry: DataFrame,
    candidate: Mapping[str, int] | Column,
    threshold: float,
    direction: str = "max",
    archive_superseded: bool = True,
) -> DataFrame:
    """New stages after the candidate version of each model name met the gate.

    ``max``: below the threshold the candidate is archived. ``min``: above it the candidate is not
    registered, so its row goes. A passing candidate becomes Staging and, if strictly better than the
    best Production metric, Production, which archives the old one. ``archive_superseded`` also archives
    every other version that is neither archived nor in production.

    ``candidate`` is ``{name: version}`` or a boolean column over the registry rows. The same metric is
    compared on both sides.
    """
    if direction not in ("max", "min"):
        raise ValueError(f"unknown direction {direction!r}")
    if isinstance(candidate, Column):
        is_new = candidate
    else:
        is_new = F.lit(False)
        for name, version in candidate.items():
            is_new = is_new | ((F.col("name") == name) & (F.col("version") == version))
    marked = registry.withColumn("is_new", is_new)
    production = (F.col("stage") == "Production") & ~F.col("is_new")
    champion_metric = F.when(production, F.col("metric"))
    champion = (
        F.coalesce(F.max(champion_metric), F.lit(0.0))
        if direction == "max"
        else F.coalesce(F.min(champion_metric), F.lit(float("inf")))
    )
    standing = marked.groupBy(F.col("name").alias("standing_name")).agg(
        champion.alias("champion"), F.max(F.when(F.col("is_new"), F.col("metric"))).alias("challenger")
    )
    joined = marked.join(standing, F.col("name") == F.col("standing_name"))
    challenger, best = F.col("challenger"), F.col("champion")
    if direction == "max":
        passes, better = challenger >= threshold, challenger > best
    else:
        passes, better = challenger <= threshold, challenger < best
    passes, wins = F.coalesce(passes, F.lit(False)), F.coalesce(passes & better, F.lit(False))
    old_stage = F.col("stage")
    stage = (
        F.when(F.col("is_new") & ~passes, "Archived")
        .when(F.col("is_new") & wins, "Production")
        .when(F.col("is_new"), "Staging")
        .when(wins & (old_stage == "Production"), "Archived")
    )
    if archive_superseded:
        stage = stage.when(passes & ~old_stage.isin("Archived", "Production"), "Archived")
    result = joined.withColumn("stage", stage.otherwise(old_stage))
    if direction == "min":
        result = result.filter(~F.col("is_new") | passes)
    return result.select(registry.columns)


def register(registry: DataFrame, name: str, metric: float, model_path: str, tags: Mapping[str, str]) -> tuple[DataFrame, int]:
    """Registry with a new version of ``name`` in stage None, and its number."""
    last = registry.filter(F.col("name") == name).agg(F.max("version")).first()[0]
    version = (last or 0) + 1
    row = registry.sparkSession.createDataFrame(
        [(version, "None", float(metric), model_path, dict(tags), name)],
        "version int, stage string, metric double, model_path string, tags map<string,string>, name string",
    )
    return registry.select(row.columns).unionByName(row), version


def production_version(registry: DataFrame, name: str) -> dict | None:
    """Latest Production version of ``name``; the registry holds one row per version."""
    row = (
        registry.filter((F.col("name") == name) & (F.col("stage") == "Production"))
        .orderBy(F.col("version").desc())
        .first()
    )
    return row.asDict() if row else None


def tag_version(registry: DataFrame, version: int, tags: Mapping[str, str]) -> DataFrame:
    """Registry with ``tags`` set on one version; other tags stay."""
    kept = F.map_filter("tags", lambda key, _: ~key.isin(list(tags)))
    added = F.create_map(*[F.lit(part) for item in tags.items() for part in item])
    return registry.withColumn(
        "tags", F.when(F.col("version") == version, F.map_concat(kept, added)).otherwise(F.col("tags"))
    )
