"""The jobs in order, from landed files to reconciled predictions."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from delaylake.constants import EXPECTED_AIRPORTS
from delaylake.learning import evaluate_predicted_labels
from delaylake.plans import (
    build_analytics,
    cycle_ready,
    import_reference_codes,
    load_flights,
    load_weather,
    predict_delays,
    predict_minutes,
    publish_run_kpis,
    snapshot_null_profile,
    stage_flights,
    stage_weather,
    train_delay_classifier,
    train_minutes_regressor,
)
from delaylake.plans.queries import QUERIES, sources
from delaylake.plans.staging import NotReady
from delaylake.sources import parse_flight_documents, parse_weather_documents, read_flight_documents, read_weather_documents
from test_sources import daily, write_json

RUN = dt.datetime(2026, 3, 8, 7, tzinfo=dt.timezone.utc)
DAY = dt.date(2026, 3, 7)


def flight(i, day, origin, hour, delay, status="ARRIVED"):
    departure = dt.datetime(day.year, day.month, day.day, hour, tzinfo=dt.timezone.utc)
    arrival = departure + dt.timedelta(minutes=90)
    actual = (arrival + dt.timedelta(minutes=delay)).isoformat() if delay is not None else None
    return {
        "id": f"AF{i}{day}", "flightNumber": str(i), "airline": {"code": "AF"}, "flightScheduleDate": str(day),
        "flightStatusPublic": status,
        "flightLegs": [{
            "departureInformation": {"airport": {"code": origin}, "times": {"scheduled": departure.isoformat()}},
            "arrivalInformation": {"airport": {"code": "CDG"}, "times": {"scheduled": arrival.isoformat(), "actual": actual}},
            "irregularity": {"delayCode": ["93"] if i % 2 else None},
            "aircraft": {"typeCode": "320" if i % 3 else "321", "wifiEnabled": "Y" if i % 2 else "N"},
        }],
    }


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    """Two hundred flown flights of the day before, late in the evening; as many scheduled for the day."""
    root = tmp_path_factory.mktemp("landing")
    rng = random.Random(11)
    for name, day in (("raw", DAY), ("scheduled", RUN.date())):
        for airport in EXPECTED_AIRPORTS:
            flights = []
            for n in range(40):
                i = EXPECTED_AIRPORTS.index(airport) * 40 + n
                hour = n % 18 + 4
                delay = (20 + hour + rng.uniform(0, 5) if hour > 11 else rng.uniform(-10, 10)) if name == "raw" else None
                flights.append(flight(i, day, airport, hour, delay))
            flights.append(None)
            folder = root / name / "flights"
            folder.mkdir(parents=True, exist_ok=True)
            write_json(folder / f"{airport}.json", {"operationalFlights": flights + flights[:1]})
            folder = root / name / "weather"
            folder.mkdir(parents=True, exist_ok=True)
            write_json(folder / f"weather_{airport}.json", daily())
    (root / "iata.csv").write_text('id,code,title,description\n93,RA,AIRCRAFT ROTATION,"late arrival\nof aircraft"\n')
    (root / "weather.csv").write_text("code,description\n10,Mist\n11,Patches\n")
    return root


def soon():
    return F.lit("2026-03-08 08:59:00").cast("timestamp")


def run_cycle(spark, lake, landed):
    import_reference_codes(lake, str(landed / "iata.csv"), str(landed / "weather.csv"))
    for mode in ("raw", "scheduled"):
        documents = read_flight_documents(spark, str(landed / mode / "flights"))
        assert load_flights(lake, documents, mode, RUN, "flights", "run-1") == 205
        weather = read_weather_documents(spark, str(landed / mode / "weather"))
        assert load_weather(lake, weather, mode, RUN, "weather", "run-1") == 5
        assert stage_flights(lake, mode, as_of=soon()) == 200
        assert stage_weather(lake, mode) == 5
        assert build_analytics(lake, mode, as_of=soon()) == 200


def test_cycle(spark, lake, landed, tmp_path):
    run_cycle(spark, lake, landed)
    run_cycle(spark, lake, landed)  # a second poll of the same day changes nothing

    as_of = F.lit("2026-03-08 08:59:00").cast("timestamp")
    tables = [("staging", "raw_flights"), ("staging", "raw_weather")]
    assert cycle_ready(lake, tables, as_of).isEmpty()
    assert cycle_ready(lake, tables, as_of + F.expr("INTERVAL 1 HOUR")).count() == 10

    flights = lake.table("analytics", "raw_flights")
    assert flights.count() == 200
    row = flights.filter("flight_number = '1'").first()
    assert (row.delay_code, row.code_iata, row.description_iata) == (93, "RA", "late arrival\nof aircraft")
    assert (row.weather_description, row.temp_max, row.date, row.date_photo) == ("Mist", 10.0, DAY, RUN.date())
    assert (row.dep_hour, row.departure_time_block, row.wifi_enabled, row.is_landed) == (6, "morning", True, True)
    assert flights.filter("code_iata IS NULL").count() == 100
    profile = {r.column_name: r for r in snapshot_null_profile(lake, "staging", "raw_flights").collect()}
    assert profile["type_name"].breached and not profile["flight_id"].breached
    profile = {r.column_name: r for r in snapshot_null_profile(lake, "analytics", "raw_flights").collect()}
    assert profile["type_name"].breached and not profile["code_iata"].breached

    assert train_delay_classifier(lake, {"Tree": DecisionTreeClassifier()}) == "Production"
    assert train_minutes_regressor(lake, {"Tree": DecisionTreeRegressor()}) == "Production"
    # equal metrics do not beat the champion
    assert train_delay_classifier(lake, {"Tree": DecisionTreeClassifier()}) == "Staging"
    runs = lake.table("ml", "runs")
    assert runs.count() == 3 and runs.filter("metrics['f1'] > 0.9").count() == 2

    mix = predict_delays(lake, "run-1", as_of=soon()).first()
    assert mix.num_predictions == 200 and 40 < mix.pct_delayed < 70
    scoring = lake.table("ml", "runs").filter("run_id = 'run-1'").first()
    assert scoring.metrics["pct_delayed"] == mix.pct_delayed and scoring.params["model_used"] == "Tree"
    tags = lake.table("ml", "model_registry").filter("stage = 'Production' AND tags['f1'] IS NOT NULL").first().tags
    assert tags["last_num_predictions"] == "200" and tags["last_prediction_run_id"] == "run-1"
    predict_delays(lake, "run-2", as_of=soon())
    predictions = lake.table("ml", "flight_predictions")
    assert predictions.count() == 200 and predictions.filter("run_id = 'run-2'").count() == 200
    late = predictions.filter("is_delayed").count()
    assert predict_minutes(lake, RUN.date()) == late > 0
    assert predict_minutes(lake, DAY) == 0
    minutes = lake.table("ml", "flight_predictions").filter("predicted_delay_minutes > 15").count()
    assert minutes == late

    # next day: the scheduled flights have flown, and meet their predictions
    day, run = RUN.date(), RUN + dt.timedelta(days=1)
    flown = tmp_path / "flown"
    flown.mkdir()
    for airport in EXPECTED_AIRPORTS:
        document = json.loads((landed / "scheduled" / "flights" / f"{airport}.json").read_text())
        for f in filter(None, document["operationalFlights"]):
            arrival = f["flightLegs"][0]["arrivalInformation"]["times"]
            late_by = 30 if int(f["flightLegs"][0]["departureInformation"]["times"]["scheduled"][11:13]) > 11 else 0
            arrival["actual"] = (
                dt.datetime.fromisoformat(arrival["scheduled"]) + dt.timedelta(minutes=late_by)
            ).isoformat()
        write_json(flown / f"{airport}.json", document)
    assert load_flights(lake, read_flight_documents(spark, str(flown)), "raw", run, "flights", "run-3") == 205
    assert load_weather(lake, read_weather_documents(spark, str(landed / "raw" / "weather")), "raw", run, "weather", "r") == 5
    assert (stage_flights(lake, gate=False), stage_weather(lake), build_analytics(lake, gate=False)) == (200, 5, 200)
    outcome = lake.table("analytics", "raw_flights").filter(F.col("date") == F.lit(day))
    assert outcome.filter("is_delayed_predicted IS NOT NULL").count() == 200
    assert evaluate_predicted_labels(outcome).first().f1 > 0.9
    assert lake.table("analytics", "raw_flights").filter("is_delayed_predicted IS NULL").count() == 200


def test_an_incomplete_cycle_publishes_nothing(spark, lake, landed, tmp_path):
    import_reference_codes(lake, str(landed / "iata.csv"), str(landed / "weather.csv"))
    documents = read_flight_documents(spark, str(landed / "raw" / "flights" / "[NLMT]*.json"))
    assert load_flights(lake, documents, "raw", RUN, "flights", "run-1") == 164
    with pytest.raises(NotReady, match="BOD"):
        stage_flights(lake, as_of=soon())
    assert not lake.exists("staging", "raw_flights")
    with pytest.raises(NotReady):  # arrived, but too long ago
        stage_flights(lake, as_of=soon() + F.expr("INTERVAL 1 HOUR"))
    assert stage_flights(lake, gate=False) == 160


def test_rows_of_no_or_another_day_go_to_quarantine(spark, lake, landed, tmp_path):
    document = json.loads((landed / "raw" / "flights" / "NCE.json").read_text())
    rows = [f for f in document["operationalFlights"] if f]
    rows[0]["flightScheduleDate"] = "soon"
    rows[1]["flightScheduleDate"] = "2026-03-01"
    write_json(tmp_path / "odd.json", {"operationalFlights": rows})
    for _ in range(2):  # loading again replaces the quarantined rows
        assert load_flights(lake, read_flight_documents(spark, str(tmp_path / "odd.json")), "raw", RUN, "flights", "r") == 39
        kept = lake.table("ops", "quarantine").groupBy("reason").count().collect()
        assert {r.reason: r["count"] for r in kept} == {"unreadable date": 1, "another day": 1}


def counted_documents(spark, lines):
    """Documents of one line each, and the count of lines that jobs have read of them."""
    read = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            read.add(len(frame))
            yield frame

    texts = spark.createDataFrame([(json.dumps(line),) for line in lines], "value string").repartition(2)
    return texts.mapInPandas(count, "value string"), read


def kept_in_quarantine(lake, table):
    kept = lake.table("ops", "quarantine").filter(F.col("load_table") == f"raw.{table}")
    return sorted(((r.reason, str(r.date_photo), json.loads(r.content)) for r in kept.collect()), key=str) if lake.exists("ops", "quarantine") else []


def test_a_load_with_quarantined_flights_reads_every_document_once(spark, lake):
    flights = [flight(i, DAY, "NCE", 9, 5) for i in range(4)]
    flights[1]["flightScheduleDate"] = "soon"
    flights[2]["flightScheduleDate"] = "2026-03-01"
    abroad = flight(9, DAY, "JFK", 9, 5)  # not on the route: neither loaded nor kept
    # Every flight alone in a document, one of another day and one loaded twice.
    texts, read = counted_documents(spark, [{"operationalFlights": [f, None]} for f in (*flights, flights[0], flights[2], abroad)])
    for run in ("r1", "r2"):  # a repeated load replaces what the first has kept
        assert load_flights(lake, parse_flight_documents(texts, "value"), "raw", RUN, "flights", run) == 3
        kept = kept_in_quarantine(lake, "raw_flights")
        assert [(reason, date, row["flight_id"], row["date"]) for reason, date, row in kept] == [
            ("another day", "2026-03-08", flights[2]["id"], "2026-03-01"), ("another day", "2026-03-08", flights[2]["id"], "2026-03-01"),
            ("unreadable date", "2026-03-08", flights[1]["id"], "soon"),
        ]
        assert all((row["instance_id"], row["dag_id"], row["annee_photo"]) == (run, "flights", 2026) and "date_photo" not in row for *_, row in kept)
        loaded = lake.table("raw", "raw_flights").select("flight_id", "instance_id").collect()
        assert sorted(map(tuple, loaded)) == sorted((flights[i]["id"], run) for i in (0, 0, 3))
    assert read.value == 2 * 7  # two loads of seven documents
    assert spark._jsc.getPersistentRDDs().isEmpty()


def test_a_load_without_flights_of_its_day_keeps_them_all(spark, lake):
    texts, read = counted_documents(spark, [{"operationalFlights": [flight(i, DAY + dt.timedelta(days=3), "NCE", 9, 5)]} for i in range(5)])
    assert load_flights(lake, parse_flight_documents(texts, "value"), "raw", RUN, "flights", "r") == 0
    assert len(kept_in_quarantine(lake, "raw_flights")) == read.value == 5


def test_a_weather_load_reads_every_document_once(spark, lake):
    document = daily()
    document["daily"]["time"][0] = None
    texts, read = counted_documents(spark, [daily(), document])
    documents = parse_weather_documents(texts.withColumn("airport_iata", F.lit("NCE")), "value")
    loaded = load_weather(lake, documents, "raw", RUN, "weather", "r")
    kept = kept_in_quarantine(lake, "raw_weather")
    assert sorted({reason for reason, *_ in kept}) == ["another day", "unreadable date"]
    assert loaded + len(kept) == 2 * len(document["daily"]["time"])
    assert read.value == 2


def test_load_flights_job_reads_every_landed_document_once(spark, tmp_path, monkeypatch):
    at = dt.datetime(2024, 1, 10, 9)
    # Half of the flights are of the day, one event comes twice, one has no type and no value.
    events = [(i, 7 + i, at + dt.timedelta(days=i % 2), "click", 1.0, '{"k": %d}' % i) for i in range(8)] + [(2, 9, at, None, None, '{"k": 2}')]
    ddl = "event_id bigint, user_id bigint, ts timestamp, event_type string, value double, props string"
    spark.createDataFrame(events, ddl).write.parquet(str(tmp_path / "events.parquet"))
    read = spark.sparkContext.accumulator(0)

    def counted(spark, path, multi_line):
        def count(frames):
            for frame in frames:
                read.add(len(frame))
                yield frame

        return parse_flight_documents(spark.read.text(path).mapInPandas(count, "value string"), "value")

    monkeypatch.setattr(sources, "read_flight_documents", counted)
    loaded = sorted(QUERIES["load_flights_job"](spark, str(tmp_path)).select("flight_id", "status", "delay_code", "date_photo").collect(), key=str)
    assert list(map(tuple, loaded)) == [
        ("0", "ON_TIME", "{}", "2024-01-11"), ("2", "ON_TIME", "{2}", "2024-01-11"), ("2", None, "{2}", "2024-01-11"),
        ("4", "ON_TIME", "{4}", "2024-01-11"), ("6", "ON_TIME", "{6}", "2024-01-11"),
    ]
    assert read.value == len(events)


def test_a_failed_load_leaves_nothing_kept(spark, lake):
    broken = flight(1, DAY, "NCE", 9, 5) | {"flightNumber": None}
    texts, _ = counted_documents(spark, [{"operationalFlights": [broken]}])
    with pytest.raises(Exception, match="flight without a required field"):
        load_flights(lake, parse_flight_documents(texts, "value"), "raw", RUN, "flights", "r")
    assert spark._jsc.getPersistentRDDs().isEmpty()


def test_kpi_file(spark, tmp_path):
    runs = spark.createDataFrame(
        [("success", "2026-03-07T06:00:00Z", "2026-03-07T06:01:00Z"), ("failure", "2026-02-01T06:00:00Z", None)],
        "conclusion string, created_at string, updated_at string",
    )
    path = str(tmp_path / "metrics")
    publish_run_kpis(runs, path, F.lit("2026-03-01 00:00:00").cast("timestamp"))
    lines = [r.value for r in spark.read.text(path).collect()]
    assert "deployment_total 1" in lines and "# TYPE deployment_failed gauge" in lines


def test_minutes_without_model_or_predictions(lake):
    assert predict_minutes(lake, DAY) == 0
    with pytest.raises(Exception):
        predict_delays(lake, "run", gate=False)


def test_restaging_reads_what_changed_and_nothing_else(spark, lake, monkeypatch):
    from delaylake.plans import restage_flights
    from delaylake.sinks.versions import VersionedTable

    lake.create("raw", "raw_flights")
    schema = lake.table("raw", "raw_flights").schema
    days = [DAY + dt.timedelta(days=i) for i in range(4)]

    def load(day, airport, *numbers, at=6, status="ON_TIME"):
        empty = {f.name: None for f in schema.fields}
        rows = [
            {**empty, "flight_id": str(n), "date": str(day), "status": status, "wifi_enabled": "Y", "date_photo": day,
             "origin_airport": airport, "execution_date": dt.datetime(2026, 3, 8, at)}
            for n in numbers
        ]
        lake.replace_partitions("raw", "raw_flights", spark.createDataFrame(rows, schema))

    for day in days:
        for airport in ("NCE", "LYS"):
            load(day, airport, 1, 2, 2)
    opened = []
    original = VersionedTable._rows
    monkeypatch.setattr(VersionedTable, "_rows", lambda self, v, parts: opened.extend((self.path, p.folder) for p in parts) or original(self, v, parts))

    def restage():
        opened.clear()
        count = restage_flights(lake)
        assert len([1 for path, _ in opened if "/raw/" in path]) == count
        return count

    assert restage() == 8
    assert lake.table("staging", "raw_flights").count() == 16  # one row per key
    assert restage() == 0
    load(days[1], "LYS", 3, status="LATE")
    lake.drop_partitions("raw", "raw_flights", lambda spec: spec["date_photo"] == str(days[3]))
    assert restage() == 1
    staged = lake.table("staging", "raw_flights").collect()
    assert sorted({(r.date_photo, r.origin_airport) for r in staged}) == sorted((d, a) for d in days[:3] for a in ("LYS", "NCE"))
    assert [(r.flight_id, r.status, r.wifi_enabled) for r in staged if (r.date_photo, r.origin_airport) == (days[1], "LYS")] == [("3", "LATE", True)]
    # A writer that ends before it publishes leaves the change to the next call.
    load(days[0], "NCE", 9)
    with monkeypatch.context() as broken:
        broken.setattr(VersionedTable, "_publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            restage_flights(lake)
    assert restage() == 1


def test_the_run_log_survives_retries(spark, lake):
    from delaylake.plans import log_runs

    ddl = "run_id string, model string, params map<string,string>, metrics map<string,double>, logged_at timestamp, experiment string"
    row = lambda run, f1: (run, "m", {"a": "b"}, {"f1": f1}, dt.datetime(2026, 3, 8), "e")
    log_runs(lake, spark.createDataFrame([row("one", 0.1), row("two/%", 0.2)], ddl))
    log_runs(lake, spark.createDataFrame([row("one", 0.3)], ddl))
    log_runs(lake, spark.createDataFrame([row("one", 0.3)], ddl))
    assert sorted((r.run_id, r.metrics["f1"]) for r in lake.table("ml", "runs").collect()) == [("one", 0.3), ("two/%", 0.2)]
