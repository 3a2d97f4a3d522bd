"""Table operators: every one takes and returns DataFrames and runs no job unless its name says so."""

from .columns import (
    BatchFunction,
    RowFunction,
    add_snapshot_columns,
    apply_columns,
    apply_frame_function,
    convert_dates,
    convert_types,
    drop_columns,
    extract_array_text,
    rename_columns,
    select_features,
)
from .dedupe import drop_duplicates, latest_version
from .enrich import (
    add_flight_features,
    enrich_with_codes,
    enrich_with_weather,
    flight_feature_rules,
    scheduled_feature_rules,
)
from .filters import delayed_with_target, filter_landed, filter_pending, recent
from .joins import anti_join, checked_broadcast, equi_join, lookup_with_default, semi_join
from .kpis import exposition_lines, prediction_mix, run_kpis
from .lookups import departure_hours, destinations, origins, prediction_lookup, validate_requests
from .quality import (
    count_stage,
    head_rows,
    missing_values,
    null_profile,
    observed_head,
    readiness,
    require_min_rows,
    require_rows,
)
from .reconcile import apply_minutes, reconcile
from .selection import best_of, best_tag, distinct_sorted, first_match, sort_nulls_last
from .sets import except_rows, intersect_rows, union_by_name

__all__ = [
    "head_rows",
    "observed_head",
    "BatchFunction",
    "RowFunction",
    "add_flight_features",
    "add_snapshot_columns",
    "anti_join",
    "apply_columns",
    "apply_frame_function",
    "apply_minutes",
    "best_of",
    "best_tag",
    "checked_broadcast",
    "convert_dates",
    "convert_types",
    "count_stage",
    "delayed_with_target",
    "departure_hours",
    "destinations",
    "distinct_sorted",
    "drop_columns",
    "drop_duplicates",
    "enrich_with_codes",
    "enrich_with_weather",
    "equi_join",
    "except_rows",
    "exposition_lines",
    "extract_array_text",
    "filter_landed",
    "filter_pending",
    "first_match",
    "flight_feature_rules",
    "intersect_rows",
    "latest_version",
    "lookup_with_default",
    "missing_values",
    "null_profile",
    "origins",
    "prediction_lookup",
    "prediction_mix",
    "readiness",
    "recent",
    "reconcile",
    "rename_columns",
    "require_min_rows",
    "require_rows",
    "run_kpis",
    "scheduled_feature_rules",
    "select_features",
    "semi_join",
    "sort_nulls_last",
    "union_by_name",
    "validate_requests",
]
