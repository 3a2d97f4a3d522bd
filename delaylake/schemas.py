"""Schemas of documents and tables. Nothing is inferred from data at read time."""

from __future__ import annotations

# All names below are those of the documents and tables that exist already.
FLIGHT_COLUMNS = (
    "flight_id",
    "flight_number",
    "airline_code",
    "date",
    "scheduled_departure",
    "actual_departure",
    "scheduled_arrival",
    "actual_arrival",
    "origin_airport",
    "destination_airport",
    "status",
    "delay_minutes",
    "delay_code",
    "registration",
    "type_code",
    "type_name",
    "owner_airline",
    "wifi_enabled",
)

FLIGHT_TIMESTAMPS = ("scheduled_departure", "actual_departure", "scheduled_arrival", "actual_arrival")
FLIGHT_TEXTS = (
    "flight_id",
    "flight_number",
    "airline_code",
    "origin_airport",
    "destination_airport",
    "status",
    "delay_code",
    "registration",
    "type_code",
    "type_name",
    "owner_airline",
)

WEATHER_METRICS = (
    "temp_max",
    "temp_min",
    "temp_mean",
    "precipitation_sum",
    "rain_sum",
    "snowfall_sum",
    "precipitation_hours",
    "wind_speed_max",
    "wind_gusts_max",
    "wind_direction",
    "weather_code",
)


SNAPSHOT_DDL = (
    "semaine_photo int, annee_photo int, execution_date timestamp, instance_id string, dag_id string, date_photo date"
)

# delayCode and delayMinutes come as null, number, text or array: kept as JSON text and normalised later.
FLIGHT_DOCUMENT = """
operationalFlights array<struct<
  id: string,
  flightNumber: string,
  airline: struct<code: string>,
  flightScheduleDate: string,
  flightStatusPublic: string,
  flightLegs: array<struct<
    departureInformation: struct<airport: struct<code: string>, times: struct<scheduled: string, actual: string>>,
    arrivalInformation: struct<airport: struct<code: string>, times: struct<scheduled: string, actual: string>>,
    irregularity: struct<delayMinutes: string, delayCode: string>,
    aircraft: struct<registration: string, typeCode: string, typeName: string, ownerAirlineName: string,
                     wifiEnabled: string>
  >>
>>
"""

# Source array name -> column name; the order is that of the table.
WEATHER_ARRAYS = {
    "time": "date",
    "temperature_2m_max": "temp_max",
    "temperature_2m_min": "temp_min",
    "temperature_2m_mean": "temp_mean",
    "precipitation_sum": "precipitation_sum",
    "rain_sum": "rain_sum",
    "snowfall_sum": "snowfall_sum",
    "precipitation_hours": "precipitation_hours",
    "wind_speed_10m_max": "wind_speed_max",
    "wind_gusts_10m_max": "wind_gusts_max",
    "wind_direction_10m_dominant": "wind_direction",
    "weather_code": "weather_code",
}


def _weather_array_type(name: str) -> str:
    if name == "time":
        return "array<string>"
    return "array<int>" if name in ("wind_direction_10m_dominant", "weather_code") else "array<double>"


WEATHER_DOCUMENT = (
    "daily struct<" + ", ".join(f"{name}: {_weather_array_type(name)}" for name in WEATHER_ARRAYS) + ">"
)

_WEATHER_METRICS_DDL = ", ".join(
    f"{name} {'int' if name in ('wind_direction', 'weather_code') else 'double'}" for name in WEATHER_METRICS
)

_ENRICHED_DDL = f"""{_WEATHER_METRICS_DDL}, weather_description string,
    code_iata string, title_iata string, description_iata string"""

_STAGED_FLIGHT_DDL = """
    flight_id string, flight_number string, airline_code string, date date,
    scheduled_departure timestamp, actual_departure timestamp,
    scheduled_arrival timestamp, actual_arrival timestamp,
    destination_airport string, status string, {delay_minutes}delay_code {delay_code},
    registration string, type_code string, type_name string, owner_airline string, wifi_enabled boolean"""

RAW_FLIGHTS = (
    ", ".join(f"{c} string" for c in FLIGHT_COLUMNS if c != "origin_airport")
    + f", {SNAPSHOT_DDL}, origin_airport string"
)
RAW_WEATHER = f"date string, {_WEATHER_METRICS_DDL}, {SNAPSHOT_DDL}, airport_iata string"
STAGING_WEATHER = f"date date, {_WEATHER_METRICS_DDL}, {SNAPSHOT_DDL}, airport_iata string"
STAGING_FLIGHTS = (
    _STAGED_FLIGHT_DDL.format(delay_minutes="delay_minutes string, ", delay_code="string")
    + f", {SNAPSHOT_DDL}, origin_airport string"
)
ANALYTICS_FLIGHTS = (
    _STAGED_FLIGHT_DDL.format(delay_minutes="", delay_code="bigint")
    + f""", {_ENRICHED_DDL}, day_of_week int, month int, dep_hour int, arr_hour int,
    day_name string, month_name string, delay_minutes double, delay_category string,
    departure_time_block string, is_delayed boolean, is_major_delay boolean, is_cancelled boolean,
    is_landed boolean, is_delayed_predicted boolean, {SNAPSHOT_DDL}, origin_airport string"""
)
ANALYTICS_SCHEDULED = (
    _STAGED_FLIGHT_DDL.format(delay_minutes="", delay_code="bigint")
    + f""", {_ENRICHED_DDL}, day_of_week int, month int, dep_hour int, arr_hour int,
    day_name string, month_name string, departure_time_block string, is_cancelled boolean,
    {SNAPSHOT_DDL}, origin_airport string"""
)

IATA_DELAY_CODES = "id int, code string, title string, description string"
WEATHER_CODES = "code int, description string"

PREDICTIONS = """
    flight_number string, dep_hour int, origin_airport string, destination_airport string,
    departure_time_block string, day_of_week int, month int, is_cancelled boolean, is_delayed boolean,
    prediction_date timestamp, run_id string, model_name string, model_version string,
    predicted_delay_minutes double, regression_model_name string, regression_model_version string,
    flight_date date"""

QUARANTINE = "reason string, content string, load_table string, date_photo date"
MODEL_REGISTRY = "version int, stage string, metric double, model_path string, tags map<string,string>, name string"
ML_RUNS = """run_id string, model string, params map<string,string>, metrics map<string,double>,
    logged_at timestamp, experiment string"""
