"""Nested JSON documents to flat rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import delay_code_to_braces, last_element
from ..schemas import FLIGHT_DOCUMENT, WEATHER_ARRAYS, WEATHER_DOCUMENT
from .files import load_if_present


def _required(value: Column, condition: Column, message: str) -> Column:
    """``value``, failing the job where ``condition`` does not hold.

    Sits in the value and not in a filter: filters may be reordered, and another one could drop the row first.
    """
    return F.when(condition, value).otherwise(F.raise_error(F.lit(message)))


def read_flight_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Flight documents, one per file; with ``multi_line=False`` one per line, which Spark can split."""
    return spark.read.schema(FLIGHT_DOCUMENT).json(path, multiLine=multi_line, mode="FAILFAST")


def parse_flight_documents(df: DataFrame, column: str) -> DataFrame:
    """The same documents held as text in a column."""
    return df.select(F.from_json(column, FLIGHT_DOCUMENT, {"mode": "FAILFAST"}).alias("d")).select("d.*")


def flatten_flights(documents: DataFrame, strict: bool = True) -> DataFrame:
    """One row of 18 columns per flight, taken from its last leg.

    ``strict`` fails on documents without the flight list and on flights without the required fields.
    """
    listed = F.col("operationalFlights")
    if strict:
        listed = _required(listed, listed.isNotNull(), "document without 'operationalFlights'")
    flights = documents.select(F.explode(listed).alias("f")).filter(F.col("f").isNotNull())
    parts = F.struct("f", last_element(F.col("f.flightLegs")).alias("leg"))
    if strict:
        departure, arrival = parts["leg"]["departureInformation"], parts["leg"]["arrivalInformation"]
        required = [
            F.col("f.id"),
            F.col("f.flightNumber"),
            F.col("f.airline.code"),
            F.col("f.flightScheduleDate"),
            departure["times"]["scheduled"],
            arrival["times"]["scheduled"],
            departure["airport"]["code"],
            arrival["airport"]["code"],
            parts["leg"]["aircraft"],
        ]
        complete = reduce(lambda a, b: a & b, [field.isNotNull() for field in required])
        parts = _required(parts, complete, "flight without a required field")
    flights = flights.select(parts.alias("parts")).select("parts.f", "parts.leg")
    departure, arrival = F.col("leg.departureInformation"), F.col("leg.arrivalInformation")
    return flights.select(
        F.col("f.id").alias("flight_id"),
        F.col("f.flightNumber").alias("flight_number"),
        F.col("f.airline.code").alias("airline_code"),
        F.col("f.flightScheduleDate").alias("date"),
        departure["times"]["scheduled"].alias("scheduled_departure"),
        departure["times"]["actual"].alias("actual_departure"),
        arrival["times"]["scheduled"].alias("scheduled_arrival"),
        arrival["times"]["actual"].alias("actual_arrival"),
        departure["airport"]["code"].alias("origin_airport"),
        arrival["airport"]["code"].alias("destination_airport"),
        F.col("f.flightStatusPublic").alias("status"),
        F.col("leg.irregularity.delayMinutes").alias("delay_minutes"),
        delay_code_to_braces(F.col("leg.irregularity.delayCode")).alias("delay_code"),
        F.col("leg.aircraft.registration").alias("registration"),
        F.col("leg.aircraft.typeCode").alias("type_code"),
        F.col("leg.aircraft.typeName").alias("type_name"),
        F.col("leg.aircraft.ownerAirlineName").alias("owner_airline"),
        F.col("leg.aircraft.wifiEnabled").alias("wifi_enabled"),
    )


def read_weather_documents(
    spark: SparkSession, path: str | list[str], multi_line: bool = True, base_path: str | None = None
) -> DataFrame:
    """Daily weather documents of all airports in one scan.

    The airport is the ``airport_iata=`` folder when the files are laid out that way, otherwise the
    three letters the file name ends with (``..._NCE.json`` or ``NCE.json``). ``base_path`` is where the folders begin
    when single files are named.
    """
    reader = spark.read.schema(WEATHER_DOCUMENT)
    reader = reader.option("basePath", base_path) if base_path else reader
    documents = reader.json(path, multiLine=multi_line, mode="FAILFAST")
    if "airport_iata" in documents.columns:
        return documents
    airport = F.regexp_extract(F.col("_metadata.file_path"), r"([A-Z]{3})\.json[^/]*$", 1)
    return documents.withColumn("airport_iata", F.nullif(airport, F.lit("")))


def parse_weather_documents(df: DataFrame, column: str, airport: str | Column = "airport_iata") -> DataFrame:
    """The same documents held as text in a column, next to their airport."""
    code = F.col(airport) if isinstance(airport, str) else airport
    return df.select(
        F.from_json(column, WEATHER_DOCUMENT, {"mode": "FAILFAST"}).alias("d"), code.alias("airport_iata")
    ).select("d.*", "airport_iata")


def flatten_weather(documents: DataFrame) -> DataFrame:
    """Parallel arrays to one row per day.

    ``arrays_zip`` pads short arrays with NULL, so unequal lengths are refused first; so are documents
    without ``daily`` or without any day.
    """
    days = F.size(F.col("daily.time"))
    aligned = F.col("daily").isNotNull() & (days > 0)
    for name in WEATHER_ARRAYS:
        aligned = aligned & (F.size(F.col(f"daily.{name}")) == days)
    zipped = F.arrays_zip(*[F.col(f"daily.{name}") for name in WEATHER_ARRAYS])
    checked = _required(zipped, F.coalesce(aligned, F.lit(False)), "weather document without aligned daily data")
    rows = documents.select("airport_iata", F.inline(checked))
    return rows.withColumnsRenamed(WEATHER_ARRAYS).select(*WEATHER_ARRAYS.values(), "airport_iata")


def read_json_payload(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """One JSON document per file; a missing path gives an empty frame of the given schema."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = load_if_present(spark, path, lambda: reader.json(path, multiLine=True))
    return spark.createDataFrame([], schema or StructType([])) if df is None else df


def flatten_structs(df: DataFrame, separator: str = ".") -> DataFrame:
    """Nested structs to one column per leaf, named by its path; arrays stay as they are."""

    def leaves(schema: StructType, prefix: tuple[str, ...]):
        for field in schema.fields:
            path = (*prefix, field.name)
            if isinstance(field.dataType, StructType):
                yield from leaves(field.dataType, path)
            else:
                yield path

    return df.select(
        [
            F.col(".".join(f"`{part}`" for part in path)).alias(separator.join(path))
            for path in leaves(df.schema, ())
        ]
    )
