"""Writes: layered tables, snapshot replacement, upserts and files."""

from .files import write_by_key, write_csv, write_parquet, write_text
from .lake import Lake
from .snapshots import checked_batch, replace_snapshots, snapshot_replace
from .tables import jdbc_load, load_table
from .upserts import merge_predictions, reconcile_table, update_minutes_table, upsert_predictions_table

__all__ = [
    "Lake",
    "checked_batch",
    "jdbc_load",
    "load_table",
    "merge_predictions",
    "reconcile_table",
    "replace_snapshots",
    "snapshot_replace",
    "update_minutes_table",
    "upsert_predictions_table",
    "write_by_key",
    "write_csv",
    "write_parquet",
    "write_text",
]
