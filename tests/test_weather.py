import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from stratalake.operators.calendar import month_days
from stratalake.operators.lineage import Run
from stratalake.operators.nesting import document_days, last_per_key, monthly_documents
from stratalake.operators.planning import (
    days_to_fetch,
    document_inventory,
    document_keys,
    missing_documents,
    missing_months,
    month_plan,
)
from stratalake.operators.quality import QualityError, contract_gaps, outcome_tally
from stratalake.plans import weather as plan
from stratalake.schemas import SILVER_WEATHER, WEATHER_DAY
from stratalake.sinks.tables import WEATHER_PARTITIONS, partition_keys
from stratalake.sources.files import list_files, only_cities, read_table, read_weather_documents, weather_paths

RUN = Run("batch", dt.datetime(2024, 2, 1, 8, 30))


def record(day, pressure=1012, cloud=100, lat=40.5):
    return {
        "lat": lat,
        "lon": -73.5,
        "date": day,
        "temperature": {"min": 1.0, "max": 5.0, "afternoon": 4.25, "night": 2.0, "evening": 3.0, "morning": 1.5},
        "pressure": {"afternoon": pressure},
        "humidity": {"afternoon": 64},
        "cloud_cover": {"afternoon": cloud},
        "precipitation": {"total": 0.75},
        "wind": {"max_speed": 5.5, "max_direction": 180},
    }


def document(days, city="New York", year=2024, month=1):
    metadata = {
        "city": city,
        "year": year,
        "month": month,
        "source": "openweathermap",
        "ingestion_timestamp": "2025-03-04T06:07:08.091011",
        "record_count": len(days or []),
    }
    return {"city": city, "year": year, "month": month, "data": {"metadata": metadata, "data": days}, "s3_key": "k"}


def land(root, *documents):
    for doc in documents:
        folder = root / f"city={doc['city'].lower().replace(' ', '_')}" / f"year={doc['year']}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{doc['month']:02d}.json").write_text(json.dumps(doc, indent=1))
    return str(root)


def test_two_days(spark, tmp_path):
    root = land(tmp_path / "b", document([record("2024-01-01"), record("2024-01-02", None, None)]))
    silver = plan.weather_to_silver(spark, weather_paths(root, ["all"]))
    assert contract_gaps(silver, SILVER_WEATHER) == []
    first, second = silver.orderBy("observation_date").collect()
    assert (first.observation_date, second.observation_date) == (dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    assert (first.data_confidence_score, second.data_confidence_score) == (1.0, 0.8)
    assert (first.city, first.year, first.source_system) == ("new_york", 2024, "openweathermap")
    assert (first.pressure_hpa, first.humidity_percent, first.cloud_cover_percent) == (1012, 64, 100.0)
    assert (second.pressure_hpa, second.cloud_cover_percent) == (None, None)
    assert first.ingestion_datetime == dt.datetime(2025, 3, 4, 6, 7, 8, 91011)
    assert partition_keys(silver, WEATHER_PARTITIONS).count() == 1


def test_types_do_not_depend_on_the_batch(spark, tmp_path):
    """All clouds null, integer precipitation: inference would change types."""
    day = record("2024-01-01", 1000.0, None)
    day["precipitation"]["total"] = 1
    root = land(tmp_path / "b", document([day]))
    silver = plan.weather_to_silver(spark, weather_paths(root, ["all"]))
    assert contract_gaps(silver, SILVER_WEATHER) == []
    assert silver.first().precipitation_mm == 1.0


def test_null_and_empty_arrays_give_no_rows(spark, tmp_path):
    root = land(
        tmp_path / "b", document([], month=1), document(None, month=2), document([record("2024-03-01")], month=3)
    )
    docs = read_weather_documents(spark, weather_paths(root, ["all"]))
    assert docs.count() == 3
    assert document_days(docs).count() == 1


def test_city_choice(spark, tmp_path):
    root = land(
        tmp_path / "b",
        document([record("2024-01-01")]),
        document([record("2024-01-01", lat=51.5)], city="London"),
        document([record("2023-01-01", lat=51.5)], city="London", year=2023),
    )
    read = lambda cities: plan.standardize_weather(read_weather_documents(spark, weather_paths(root, cities)))
    assert read(["all"]).count() == 3
    assert read(["New York"]).count() == 1
    assert read(["London"]).count() == 2
    target = str(tmp_path / "silver")
    plan.publish_weather(read(["all"]), target)
    chosen = only_cities(read_table(spark, target), ["London"])
    assert chosen.count() == 2
    assert re.search(r"PartitionFilters: \[[^\]]*city", chosen._jdf.queryExecution().executedPlan().toString())
    assert only_cities(read_table(spark, target), ["all"]).count() == 3


def test_out_of_range_is_not_published(spark, tmp_path):
    days = [record(f"2024-01-{d:02d}") for d in range(1, 32)]
    days[-1]["lat"] = 200.0
    root = land(tmp_path / "b", document(days))
    with pytest.raises(QualityError, match="latitude_in_range"):
        plan.weather_to_silver(spark, weather_paths(root, ["all"]))


def test_a_document_that_cannot_be_read_is_told(spark, tmp_path):
    root = land(tmp_path / "b", document([record("2024-01-01")]), document([record("x")], month=2), document([], month=3))
    whole = tmp_path / "b" / "city=new_york" / "year=2024" / "04.json"
    whole.write_text(json.dumps(document([record("2024-04-01")], month=4))[:-30])
    got = {r.path.rsplit("/", 1)[1]: (r.status, r.reason, r.row_count) for r in plan.document_outcomes(spark, weather_paths(root, ["all"])).collect()}
    assert got == {
        "01.json": ("passed", None, 1),
        "02.json": ("failed", "reading without a date", 1),
        "03.json": ("failed", "no readings", 0),
        "04.json": ("failed", "unreadable", 0),
    }
    with pytest.raises(QualityError, match="unreadable"):
        plan.weather_to_silver(spark, weather_paths(root, ["all"]))


def test_humidity_is_checked_before_it_is_an_integer(spark, tmp_path):
    day = record("2024-01-01")
    day["humidity"]["afternoon"] = 72.9
    root = land(tmp_path / "b", document([day]))
    with pytest.raises(QualityError, match="humidity_percent_in_range"):
        plan.weather_to_silver(spark, weather_paths(root, ["all"]))


def test_two_batches_of_a_year(spark, tmp_path):
    target = str(tmp_path / "silver")
    for month in (1, 2, 1):
        root = land(tmp_path / f"b{month}", document([record(f"2024-0{month}-01")], month=month))
        plan.publish_weather(plan.weather_to_silver(spark, weather_paths(root, ["all"])), target)
    assert read_table(spark, target).count() == 2


def test_fetch_cycle(spark, tmp_path):
    """What the own writer landed is not planned again, odd city names included."""
    names = ["New York", "L'Aquila", "A+B [x]", "50% x"]
    cities = spark.createDataFrame([(c,) for c in names], "city string")
    rows = [(c, f"2024-01-{d:02d}", 1.0, 1) for c in names for d in (1, 2)]
    delivered = readings(spark, rows).drop("landed_at")
    first = plan.fetch_cycle(spark, cities, delivered, "2024-01", "2024-02", str(tmp_path), RUN)
    assert {(r.status, r["keys"]) for r in outcome_tally(first).collect()} == {("passed", 8), ("failed", 4 * 60 - 8)}
    again = plan.plan_fetch(spark, cities, "2024-01", "2024-02", str(tmp_path))
    assert sorted((r.city, r.month) for r in again.collect()) == sorted((c, 2) for c in names)
    silver = plan.weather_to_silver(spark, weather_paths(f"{tmp_path}/bronze/openweathermap", names))
    assert silver.select("city").distinct().count() == 4


def readings(spark, rows):
    """Rows of (city, date, temperature, landed_at)."""
    schema = WEATHER_DAY.simpleString().removeprefix("struct<").removesuffix(">")
    data = [(c, at, *tuple_of(record(d) | {"lat": t})) for c, d, t, at in rows]
    return spark.createDataFrame(data, f"city string, landed_at int, {schema}")


def tuple_of(day):
    return tuple(
        tuple(float(v) for v in day[n].values()) if isinstance(day[n], dict) else day[n]
        for n in WEATHER_DAY.fieldNames()
    )


def test_documents_per_month(spark):
    rows = [("New York", f"2024-01-{d:02d}", 1.0, 1) for d in (3, 1, 2)] + [("New York", "2024-02-10", 1.0, 1)]
    docs = {(r.year, r.month): r for r in monthly_documents(readings(spark, rows).drop("landed_at"), RUN).collect()}
    january = docs[2024, 1]
    assert [d.date for d in january.data.data] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert january.data.metadata.record_count == 3
    assert january.data.metadata.ingestion_timestamp == "2024-02-01T08:30:00.000000"
    assert january.s3_key == "bronze/openweathermap/city=new_york/year=2024/01.json"
    assert docs[2024, 2].data.metadata.record_count == 1 and len(docs) == 2


def test_refetched_day_replaces_the_earlier_reading(spark):
    rows = [("A", "2024-01-01", float(i), i) for i in range(50)] + [("A", "2024-01-02", 7.0, 0)]
    doc = monthly_documents(readings(spark, rows), RUN, "landed_at").first()
    assert doc.data.metadata.record_count == 2
    assert [d.lat for d in doc.data.data] == [49.0, 7.0]


def test_one_day_read_very_often(spark):
    """Copies of one city and day never gather in a document."""
    copies = F.explode(F.sequence(F.lit(1), F.lit(20_000)))
    hot = readings(spark, [("A", "2024-01-01", 1.0, 1)]).drop("landed_at").withColumn("copy", copies).drop("copy")
    doc = monthly_documents(hot.unionByName(readings(spark, [("A", "x", 1.0, 1)]).drop("landed_at")), RUN).collect()
    assert [len(d.data.data) for d in doc] == [1]


def test_last_per_key_settles_ties_and_null_order(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", None, "z")], "k string, o int, v string")
    got = {r.k: (r.o, r.v) for r in last_per_key(df, ["k"], "o").collect()}
    assert got == {"a": (1, "y"), "b": (None, "z")}


def test_documents_land_and_come_back(spark, tmp_path):
    rows = [("New York", f"2024-01-{d:02d}", 40.0, 1) for d in range(1, 32)] + [("London", "2023-12-31", 51.0, 1)]
    docs = monthly_documents(readings(spark, rows), RUN, "landed_at")
    plan.land_documents(docs, str(tmp_path))
    root = f"{tmp_path}/bronze/openweathermap"
    silver = plan.weather_to_silver(spark, weather_paths(root, ["all"]))
    assert {(r.city, r["count"]) for r in silver.groupBy("city").count().collect()} == {("new_york", 31), ("london", 1)}
    assert list_files(spark, root, "*.json").count() == 2


def test_fetch_plan(spark, tmp_path):
    land(tmp_path / "bronze" / "openweathermap", document([], month=2), document([], city="London", month=1))
    cities = spark.createDataFrame([("New York",), ("London",)], "city string")
    todo = plan.plan_fetch(spark, cities, "2023-12", "2024-02", str(tmp_path))
    assert {(r.city, r.year, r.month) for r in todo.collect()} == {
        ("New York", 2023, 12),
        ("New York", 2024, 1),
        ("London", 2023, 12),
        ("London", 2024, 2),
    }
    days = days_to_fetch(todo.filter("city = 'London'"))
    assert days.count() == 31 + 29
    assert month_days(todo).columns[-1] == "date"


def test_inventory_normalises_blanks(spark):
    df = spark.createDataFrame(
        [("s3a://b/bronze/openweathermap/city=new york/year=2024/01.json",), ("s3a://b/other/x.json",)], "path string"
    )
    assert [r.document_key for r in document_inventory(df).collect()] == [
        "bronze/openweathermap/city=new_york/year=2024/01.json"
    ]


def test_nothing_stored_yet(spark, tmp_path):
    cities = spark.createDataFrame([("Rome",)], "city string")
    assert plan.plan_fetch(spark, cities, "2024-01", "2024-12", str(tmp_path / "none")).count() == 12
    wanted = month_plan(cities, "2024-01", "2024-01")
    assert missing_documents(wanted, wanted.select("document_key")).count() == 0


def test_fetch_outcomes(spark):
    cities = spark.createDataFrame([("A",)], "city string")
    planned = days_to_fetch(month_plan(cities, "2024-01", "2024-01"))
    arrived = readings(spark, [("A", "2024-01-05", 1.0, 1), ("A", "2024-01-05", 2.0, 2)])
    tally = {r.status: (r["keys"], r.row_count) for r in outcome_tally(plan.fetch_outcomes(planned, arrived)).collect()}
    assert tally == {"passed": (1, 1), "failed": (30, 0)}


def test_files_of_a_missing_folder(spark, tmp_path):
    assert list_files(spark, str(tmp_path / "none")).count() == 0
    assert list_files(spark, str(tmp_path)).select(F.col("path")).count() == 0


def test_missing_months_equals_the_anti_join(spark):
    """Both forms agree over a period longer than one month set, with odd paths."""
    cities = spark.createDataFrame([("New York",), ("London",), ("Rome",)], "city string")
    paths = [
        f"x/bronze/openweathermap/city={c}/year={y}/{m:02d}.json"
        for c in ("new york", "london")
        for y in range(2009, 2022)
        for m in range(1, 13)
        if (y * 12 + m) % (5 if c == "london" else 3)
    ]
    odd = ["x/bronze/openweathermap/city=rome/year=2015/1.json", "x/bronze/openweathermap/city=rome/year=2015/01.txt"]
    keys = document_keys(spark.createDataFrame([(p,) for p in paths * 2 + odd], "path string"))
    fast = missing_months(cities, keys, "2010-03", "2020-11")
    plain = missing_documents(month_plan(cities, "2010-03", "2020-11"), keys.distinct())
    assert sorted(map(tuple, fast.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))
    assert fast.filter("city = 'Rome'").count() == 129


def test_bad_documents_and_readings_are_set_aside(spark, tmp_path):
    land(tmp_path / "in", document([record("2024-01-05"), record("2024-01-06")], month=1))
    land(tmp_path / "in", document([record("2024-02-05")], month=2))
    folder = tmp_path / "in" / "city=x" / "year=2024"
    folder.mkdir(parents=True)
    (folder / "03.json").write_text('{"data": {"metadata"')
    result = plan.split_documents(spark, weather_paths(str(tmp_path / "in"), ["all"]))
    assert result.silver.count() == 3 and result.rejected.count() == 0
    assert sorted((r.status, r.reason) for r in result.outcomes.collect() if r.status == "failed") == [("failed", "unreadable")]
    for frame in (result.silver, result.rejected, result.outcomes):  # texts are parsed once, when they are staged
        assert "json" not in frame._jdf.queryExecution().optimizedPlan().toString().lower()
    with pytest.raises(QualityError, match="unreadable"):
        plan.split_documents(spark, weather_paths(str(tmp_path / "in"), ["all"]), max_rejected=0.3)
