"""The spark-submit jobs, chained from raw files to the daily table."""

import datetime as dt

import pytest

from stratalake import jobs
from stratalake.operators.quality import QualityError
from stratalake.sources.files import read_table
from tests.test_bars import GOOD, HEADER, drop
from tests.test_events import LINES, write_csv
from tests.test_weather import document, land, record


def test_jobs_from_raw_files_to_daily_table(spark, tmp_path):
    silver = tmp_path / "silver"
    write_csv(tmp_path / "events", LINES)
    land(tmp_path / "weather", document([record("2020-11-17")], year=2020, month=11))
    drop(tmp_path / "bars", "AAPL", "20240101_000000", HEADER, GOOD.replace("2024-01-01", "2020-11-17"))
    run = lambda job, source, target, *more: jobs.main(
        [job, "--input", str(tmp_path / source), "--output", str(target), *more]
    )
    run("events", "events", silver / "ecommerce")
    run("weather", "weather", silver / "openweathermap", "--cities", "all")
    run("bars", "bars", silver / "alphavantage")
    run("gold", "silver", tmp_path / "gold")
    table = read_table(spark, str(tmp_path / "gold"))
    assert table.count() == 181
    day = table.filter("date = DATE'2020-11-17'").first()
    assert (day.sales_event_count, day.market_stocks_traded, day.weather_is_cold) == (4, 1, 1)
    assert round(day.sales_total_revenue, 2) == 160.80


def test_events_job_sets_bad_rows_aside(spark, tmp_path):
    source = write_csv(tmp_path / "in", [*LINES[:4], LINES[4].replace(",view,", ",refund,")])
    args = ["events", "--input", source, "--output", str(tmp_path / "out"), "--rejects", str(tmp_path / "bad"), "--max-rejected"]
    with pytest.raises(QualityError, match="event_type_in_set"):
        jobs.main([*args, "0.1"])
    assert not (tmp_path / "out").exists()
    for _ in range(2):
        jobs.main([*args, "0.2"])
    assert read_table(spark, str(tmp_path / "out")).count() == 4
    assert [r.broken_rules for r in read_table(spark, str(tmp_path / "bad")).collect()] == [["event_type_in_set"]]


def test_land_and_bars_jobs_by_manifest(spark, tmp_path):
    (tmp_path / "in" / "IBM").mkdir(parents=True)
    (tmp_path / "in" / "IBM" / "payload").write_text(f"{HEADER}\n{GOOD}")
    known = ["--manifest", str(tmp_path / "manifest")]
    jobs.main(["land", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--batch-ts", "20240101_000000", *known])
    jobs.main(["bars", "--input", str(tmp_path / "out"), "--output", str(tmp_path / "silver"), *known])
    assert [(r.ticker, r.volume) for r in read_table(spark, str(tmp_path / "silver")).collect()] == [("IBM", 700)]


def test_plan_job(spark, tmp_path):
    land(tmp_path / "in" / "bronze" / "openweathermap", document([], month=2))
    months = ["--cities", "New York", "--start-month", "2024-01", "--end-month", "2024-03"]
    jobs.main(["plan", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "todo"), *months])
    assert {r.month for r in read_table(spark, str(tmp_path / "todo")).collect()} == {1, 3}
    now = f"{dt.datetime.now(dt.timezone.utc):%Y%m%d_%H%M%S}"
    drop(tmp_path / "bars", "AAPL", now, HEADER, GOOD)
    symbols = ["--symbols", "AAPL", "IBM"]
    jobs.main(["plan", "--input", str(tmp_path / "bars"), "--output", str(tmp_path / "s"), *symbols])
    assert [r.symbol for r in read_table(spark, str(tmp_path / "s")).collect()] == ["IBM"]
    jobs.main(["plan", "--input", str(tmp_path / "bars"), "--output", str(tmp_path / "f"), *symbols, "--force-refresh"])
    assert read_table(spark, str(tmp_path / "f")).count() == 2


def test_land_job(spark, tmp_path):
    (tmp_path / "in" / "IBM").mkdir(parents=True)
    (tmp_path / "in" / "IBM" / "payload").write_text(f"{HEADER}\n{GOOD}")
    jobs.main(["land", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--batch-ts", "20240101_000000"])
    assert len(list((tmp_path / "out" / "symbol=IBM" / "batch_ts=20240101_000000").glob("*.csv"))) == 1
