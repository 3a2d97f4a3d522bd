"""Flights, weather and raw text records derived from an event table.

Lets every operator run on event data of any size: a row of ``events`` becomes one flight by plain
column expressions (no shuffle), and weather is a per-day, per-airport aggregate of the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...constants import EXPECTED_AIRPORTS, HUB_AIRPORT
from ...schemas import FLIGHT_TIMESTAMPS, WEATHER_ARRAYS, WEATHER_METRICS


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def event_flights(events: DataFrame) -> DataFrame:
    """Staged flights: UTC timestamps, one row per event."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    )
    k, event_id, user_id = F.col("k"), F.col("event_id"), F.col("user_id")
    arrival = F.timestamp_add("MINUTE", 10 - (user_id % 5) * 20, F.date_trunc("HOUR", "ts"))
    departure = F.timestamp_add("MINUTE", F.lit(-90), arrival)
    status = (
        F.when(F.col("event_type") == "error", "CANCELLED")
        .when(F.col("event_type") == "purchase", "ARRIVED")
        .when(F.col("event_type") != "view", "ON_TIME")
    )
    date = F.col("ts").cast("date")
    return events.select(
        event_id.cast("string").alias("flight_id"),
        user_id.cast("string").alias("flight_number"),
        F.lit("AF").alias("airline_code"),
        date.alias("date"),
        departure.alias("scheduled_departure"),
        F.when(event_id % 11 != 0, F.timestamp_add("MINUTE", F.lit(-90), F.col("ts"))).alias("actual_departure"),
        arrival.alias("scheduled_arrival"),
        F.when(event_id % 11 != 0, F.col("ts")).alias("actual_arrival"),
        _pick(EXPECTED_AIRPORTS, event_id % 5).alias("origin_airport"),
        F.lit(HUB_AIRPORT).alias("destination_airport"),
        status.alias("status"),
        F.when(k % 10 == 0, "{}")
        .when(k % 10 == 1, F.concat(F.lit("{"), k, F.lit(","), k + 1, F.lit("}")))
        .otherwise(F.concat(F.lit("{"), k, F.lit("}")))
        .alias("delay_code"),
        F.concat(F.lit("F-"), user_id % 40).alias("registration"),
        _pick(("320", "321", "223"), k % 3).alias("type_code"),
        F.when(k % 3 == 0, "Y").when(k % 3 == 1, "N").alias("wifi_enabled"),
        F.date_add(date, (event_id % 3).cast("int")).alias("date_photo"),
        F.col("ts").alias("execution_date"),
        k.alias("k"),
        F.col("value").alias("value"),
        event_id.alias("event_id"),
    )


def event_weather(flights: DataFrame) -> DataFrame:
    """Daily weather per airport: partial aggregation first, so the result is days x airports rows."""
    cents, k = F.round(F.col("value") * 100).cast("bigint"), F.col("k")
    rows = F.count(F.lit(1))
    return flights.groupBy("date", F.col("origin_airport").alias("airport_iata")).agg(
        F.max("value").alias("temp_max"),
        F.min("value").alias("temp_min"),
        (F.sum(cents) / rows / 100.0).alias("temp_mean"),
        (F.sum(cents) / 100.0).alias("precipitation_sum"),
        F.count_if(k % 2 == 0).cast("double").alias("rain_sum"),
        F.count_if(k % 7 == 0).cast("double").alias("snowfall_sum"),
        (rows % 24).cast("double").alias("precipitation_hours"),
        F.max(k).cast("double").alias("wind_speed_max"),
        (F.max(k) * 1.5).alias("wind_gusts_max"),
        (F.max(k) * 7 % 360).alias("wind_direction"),
        F.max(k).alias("weather_code"),
    )


def event_weather_documents(weather: DataFrame) -> DataFrame:
    """Weather as JSON documents of parallel arrays, one per airport and month.

    A group holds the days of one month, so no more than 31 rows.
    """
    day = F.struct(F.col("date").cast("string").alias("date"), *WEATHER_METRICS)
    months = weather.groupBy("airport_iata", F.trunc("date", "MM").alias("month")).agg(
        F.array_sort(F.collect_list(day)).alias("days")
    )
    arrays = [F.col(f"days.{column}").alias(name) for name, column in WEATHER_ARRAYS.items()]
    return months.select("airport_iata", F.to_json(F.struct(F.struct(*arrays).alias("daily"))).alias("document"))


def event_raw_flights(flights: DataFrame) -> DataFrame:
    """Flights as the source sends them: all text, ISO times with offset, some of them broken."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    texts = {c: F.date_format(c, iso) for c in FLIGHT_TIMESTAMPS}
    texts["actual_departure"] = F.when(F.col("event_id") % 13 == 0, "not_a_date").otherwise(texts["actual_departure"])
    texts |= {"date": F.col("date").cast("string"), "delay_minutes": F.lit(None).cast("string")}
    texts |= {"type_name": F.concat(F.lit("AIRBUS A"), F.col("type_code")), "owner_airline": F.lit("AF")}
    return flights.withColumns(texts)


def event_flight_documents(flights: DataFrame) -> DataFrame:
    """Raw flights as nested JSON: a NULL entry, a first leg to be ignored, and a code in every form it takes."""
    raw = event_raw_flights(flights)
    k = F.col("k")
    code = (
        F.when(k % 10 == 1, F.to_json(F.array(k.cast("string"), (k + 1).cast("string"))))
        .when(k % 10 == 2, k.cast("string"))
        .when(k % 10 != 0, F.concat(F.lit('"'), k.cast("string"), F.lit('"')))
    )

    def stop(airport: Column, scheduled: Column, actual: Column) -> Column:
        return F.struct(
            F.struct(airport.alias("code")).alias("airport"),
            F.struct(scheduled.alias("scheduled"), actual.alias("actual")).alias("times"),
        )

    def leg(origin: Column, code_marker: Column | None) -> Column:
        irregularity = F.struct(code_marker.alias("delayCode")) if code_marker is not None else F.struct(
            F.lit("first leg").alias("delayCode")
        )
        return F.struct(
            stop(origin, F.col("scheduled_departure"), F.col("actual_departure")).alias("departureInformation"),
            stop(F.col("destination_airport"), F.col("scheduled_arrival"), F.col("actual_arrival")).alias(
                "arrivalInformation"
            ),
            irregularity.alias("irregularity"),
            F.struct(
                F.col("registration"),
                F.col("type_code").alias("typeCode"),
                F.col("type_name").alias("typeName"),
                F.col("owner_airline").alias("ownerAirlineName"),
                F.col("wifi_enabled").alias("wifiEnabled"),
            ).alias("aircraft"),
        )

    flight = F.struct(
        F.col("flight_id").alias("id"),
        F.col("flight_number").alias("flightNumber"),
        F.struct(F.col("airline_code").alias("code")).alias("airline"),
        F.col("date").alias("flightScheduleDate"),
        F.col("status").alias("flightStatusPublic"),
        F.array(leg(F.lit("XXX"), None), leg(F.col("origin_airport"), F.lit("#code#"))).alias("flightLegs"),
    )
    text = F.to_json(F.struct(F.array(flight, F.lit(None)).alias("operationalFlights")))
    # The code is put in as JSON, since one column cannot be number, text and array at once.
    return raw.select(F.replace(text, F.lit('"#code#"'), F.coalesce(code, F.lit("null"))).alias("document"))


def event_predictions(flights: DataFrame) -> DataFrame:
    """One rule-based prediction per flight number and day."""
    return flights.groupBy("flight_number", F.col("date").alias("flight_date")).agg(
        F.min("origin_airport").alias("origin_airport"),
        F.min("destination_airport").alias("destination_airport"),
        F.min(F.hour("scheduled_departure")).alias("dep_hour"),
        (F.max("k") % 2 == 0).alias("is_delayed"),
        F.max("execution_date").alias("prediction_date"),
    )
