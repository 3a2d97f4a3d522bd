"""Scans: nested JSON, CSV, Parquet, tables, and the flight view over an event table."""

from .discovery import content_digest, file_table, read_weather_files
from .documents import (
    flatten_flights,
    flatten_structs,
    flatten_weather,
    parse_flight_documents,
    parse_weather_documents,
    read_flight_documents,
    read_json_payload,
    read_weather_documents,
)
from .files import read_csv, read_parquet, read_reference_codes, with_file_position
from .tables import incremental_scan, jdbc_scan, table_scan
from .windows import in_reference_day, on_route, reference_day

__all__ = [
    "content_digest",
    "file_table",
    "flatten_flights",
    "flatten_structs",
    "flatten_weather",
    "in_reference_day",
    "incremental_scan",
    "jdbc_scan",
    "on_route",
    "parse_flight_documents",
    "parse_weather_documents",
    "read_csv",
    "read_flight_documents",
    "read_json_payload",
    "read_parquet",
    "read_reference_codes",
    "read_weather_documents",
    "read_weather_files",
    "reference_day",
    "table_scan",
    "with_file_position",
]
