"""Run KPIs as exposition text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..operators.kpis import exposition_lines, run_kpis
from ..sinks.files import write_text


def publish_run_kpis(runs: DataFrame, path: str, since: Column | None = None) -> None:
    """KPIs of the workflow runs as a text file a scraper can pick up."""
    write_text(exposition_lines(run_kpis(runs, since)).select("value"), path)
