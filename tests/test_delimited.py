"""CSV by header group: line breaks in cells, headers in any order, large files in splits; order across splits."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratalake.operators.lineage import Run
from stratalake.operators.nesting import payload_bars, text_lines
from stratalake.operators.order import order_report
from stratalake.plans import bars as plan
from stratalake.plans import landing
from stratalake.sources.delimited import read_delimited, whole_texts
from stratalake.sources.files import list_files
from stratalake.sources.manifest import disagreements, landed_files, record_landing
from tests.test_bars import GOOD, HEADER, drop, outcomes

RUN = Run("batch", dt.datetime(2024, 1, 10, 12))
SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, "2kb")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set(SPLIT, before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def days(n, start=dt.date(2001, 1, 1)):
    return [f"{start + dt.timedelta(i)},1.5,2.5,0.5,2.0,{i}" for i in range(n)]


def test_quoted_line_breaks_and_header_orders(spark, tmp_path):
    drop(tmp_path, "BREAK", "20240102_000000", "note," + HEADER, '"one\ntwo, ""three""",' + GOOD, '"\n",' + GOOD.replace("01-01", "01-02"))
    drop(tmp_path, "TURNED", "20240102_000000", "volume,close,low,high,open,timestamp,note", '7,4,3,5,2,2024-01-03,"a\r\nb"')
    drop(tmp_path, "PLAIN", "20240102_000000", "﻿" + HEADER, "", GOOD, "")
    result = plan.bars_to_silver(spark, str(tmp_path), run=RUN)
    assert outcomes(result) == {"BREAK": ("passed", None, 2), "TURNED": ("passed", None, 1), "PLAIN": ("passed", None, 1)}
    rows = {(r.ticker, r.trade_date.day): (r.open_price, r.close_price, r.volume) for r in result.silver.collect()}
    assert rows == {("BREAK", 1): (50, 52, 700), ("BREAK", 2): (50, 52, 700), ("TURNED", 3): (2, 4, 7), ("PLAIN", 1): (50, 52, 700)}


def test_an_open_quote_fails_its_ticker_only(spark, tmp_path):
    drop(tmp_path, "OPEN", "20240102_000000", HEADER, GOOD, '2024-01-02,"1,2,3,4,5')
    drop(tmp_path, "GOOD", "20240102_000000", HEADER, GOOD)
    told = outcomes(plan.bars_to_silver(spark, str(tmp_path), run=RUN))
    assert told["OPEN"][0] == "failed" and told["GOOD"] == ("passed", None, 1)


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path, small_splits):
    drop(tmp_path, "BIG", "20240102_000000", HEADER, *days(400))
    files = list_files(spark, str(tmp_path), "*.csv").select(F.lit("BIG").alias("ticker"), "path")
    rows = read_delimited(spark, str(tmp_path), files, "ticker").withColumn("task", F.spark_partition_id())
    held = rows.collect()
    assert len(held) == 400 and len({r.task for r in held}) > 3 and len({r.split for r in held}) > 3
    assert plan.bars_to_silver(spark, str(tmp_path), run=RUN).silver.count() == 400


def test_order_is_stitched_at_the_borders_of_splits(spark, tmp_path, small_splits):
    rising, lines = days(400), days(400)
    drop(tmp_path, "UP", "20240102_000000", HEADER, *rising)
    drop(tmp_path, "DOWN", "20240102_000000", HEADER, *reversed(rising))
    for at in (57, 200, 399):  # wherever splits end
        drop(tmp_path, f"SWAP{at}", "20240102_000000", HEADER, *lines[: at - 1], lines[at], lines[at - 1], *lines[at + 1 :])
        drop(tmp_path, f"TWICE{at}", "20240102_000000", HEADER, *lines[:at], lines[at], *lines[at:])
    got = {r.ticker: (r.status, r.row_count, r.out_of_order) for r in plan.order_outcomes(spark, str(tmp_path)).collect()}
    assert got["UP"] == got["DOWN"] == ("passed", 400, 0)
    for at in (57, 200, 399):
        assert got[f"SWAP{at}"] == ("failed", 400, 1) and got[f"TWICE{at}"] == ("failed", 401, 1)


def test_every_border_counts(spark):
    """Splits of one record each: all steps are steps between splits; a split without a value is passed over."""
    values = [3, 4, None, 4, 6, 5, 7]
    rows = spark.createDataFrame([("k", "p", i * 10, i, v) for i, v in enumerate(values)], "key string, path string, split long, place long, v int")
    assert [tuple(r) for r in order_report(rows, "key", "v").collect()] == [("k", 6, 2)]
    assert order_report(rows.limit(0), "key", "v").count() == 0


def test_records_of_a_text(spark):
    text = f'note,{HEADER}\r\n"a\nb ""c"", d",{GOOD}\n"\r\n",{GOOD.replace("01-01", "01-02")}\n'
    df = spark.createDataFrame([("S", text)], "symbol string, value string")
    assert len(df.select(text_lines(F.col("value"))).first()[0]) == 3
    rows = landing.typed_bars(payload_bars(df)).collect()
    assert sorted((str(r.trade_date), r.open, r.volume) for r in rows) == [("2024-01-01", 50.0, 700), ("2024-01-02", 50.0, 700)]


def test_a_very_long_quoted_cell(spark):
    text = f'note,{HEADER}\n"{"x" * 200_000}",{GOOD}'
    df = spark.createDataFrame([("S", text)], "symbol string, value string")
    assert landing.typed_bars(payload_bars(df)).first().volume == 700


def test_payload_files_of_all_kinds(spark, tmp_path, small_splits):
    """CSV payloads are read in splits, JSON ones as a whole; a symbol may come in several files."""
    days = [(dt.date(2020, 1, 1) + dt.timedelta(n)).isoformat() for n in range(700)]
    entry = lambda day: f'"{day}": {{"1. open": "1.5", "2. high": "2", "3. low": "1", "4. close": "1.5", "5. volume": "9"}}'
    pretty = '{"Time Series (Daily)": {\n  ' + ",\n  ".join(map(entry, days[:300])) + "\n}}"
    long = "\n".join([HEADER, *(f"{day},1,2,1,1.5,{n}" for n, day in enumerate(days))])
    files = {
        ("LONG", "a"): long, ("JSON", "a"): pretty, ("BROKEN", "a"): pretty[:-9], ("NONE", "a"): "", ("BLANK", "a"): "\n \r\n",
        ("HEAD", "a"): f"\n{HEADER}\n\n", ("MORE", "a"): f"{HEADER},dividend\n{GOOD},1", ("LESS", "a"): "a,b\n1,2", ("ERROR", "a"): f"{HEADER}\nInvalid API Key",
        ("QUOTED", "a"): f'volume,close,low,high,open,timestamp\r\n"7\n",52.0,48.0,55.0,50.0,"2024-01-01"\r\n', ("BOTH", "a"): f"{HEADER}\n{GOOD}", ("BOTH", "b"): pretty,
        ("SPOILED", "a"): f"{HEADER}\n{GOOD}", ("SPOILED", "b"): "Invalid API call",
    }
    for (symbol, name), text in files.items():
        (tmp_path / "in" / symbol).mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / symbol / name).write_bytes(text.encode())
    root = str(tmp_path / "in")
    result = landing.land_payloads(spark, root, str(tmp_path / "out"), "20240101_000000")
    assert {r.symbol: (r.status, r.reason, r.row_count) for r in result.outcomes.collect()} == {
        "LONG": ("passed", None, 700), "JSON": ("passed", None, 300), "BROKEN": ("failed", "missing columns", 0), "NONE": ("failed", "empty", 0),
        "BLANK": ("failed", "empty", 0), "HEAD": ("failed", "too short", 0), "MORE": ("failed", "unexpected columns", 0), "LESS": ("failed", "missing columns", 0),
        "ERROR": ("failed", "error message", 0), "QUOTED": ("passed", None, 1), "BOTH": ("passed", None, 301), "SPOILED": ("failed", "error message", 1),
    }
    assert {r.symbol: r["count"] for r in result.bars.groupBy("symbol").count().collect()} == {"LONG": 700, "JSON": 300, "QUOTED": 1, "BOTH": 301}
    assert result.bars.filter("symbol = 'LONG'").agg(F.sum(F.col("volume").cast("long"))).first()[0] == sum(range(700))
    listed = list_files(spark, root).filter("path LIKE '%/LONG/%' OR path LIKE '%/JSON/%'").selectExpr("path", "CASE WHEN path LIKE '%LONG%' THEN 'LONG' ELSE 'JSON' END AS symbol")
    records = read_delimited(spark, root, listed.filter("symbol = 'LONG'"), "symbol")
    assert records.select("split").distinct().count() > 5
    assert {r.value for r in whole_texts(spark, root, listed).collect()} == {long, pretty}
    assert landing.land_payloads(spark, str(tmp_path / "no"), str(tmp_path / "out2"), "20240101_000000").outcomes.count() == 0


def test_manifest_follows_landings(spark, tmp_path):
    for symbol in ("IBM", "A%B"):
        (tmp_path / "in" / symbol).mkdir(parents=True)
        (tmp_path / "in" / symbol / "payload").write_text(f"{HEADER}\n{GOOD}")
    root, known = str(tmp_path / "out"), str(tmp_path / "manifest")
    assert landed_files(spark, known).count() == 0
    for batch in ("20240101_000000", "20240102_000000", "20240102_000000"):
        landing.land_payloads(spark, str(tmp_path / "in"), root, batch, known)
    told = {r.key: r.asDict() for r in disagreements(list_files(spark, root, "*.csv"), landed_files(spark, known)).collect()}
    assert {k: (r["agreed"], r["only_listed"], r["only_recorded"], r["other_length"]) for k, r in told.items()} == {"IBM": (2, 0, 0, 0), "A%B": (2, 0, 0, 0)}
    result = plan.bars_to_silver(spark, root, run=RUN, landed=landed_files(spark, known))
    assert outcomes(result) == {"IBM": ("passed", None, 1), "A%B": ("passed", None, 1)}
    drop(tmp_path / "out", "symbol=NEW/batch_ts=20240103_000000", "part", HEADER, GOOD)
    record_landing(spark, root, known, "20240103_000000")
    assert landed_files(spark, known).count() == 5
