"""The jobs behind ``run_job.py``.

Storage credentials, table format jars and cluster size are session
configuration and stay with ``spark-submit``.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators.planning import freshness, symbols_to_fetch
from .operators.quality import outcome_tally
from .plans import bars, events, gold, landing, weather
from .session import clear_scratch, get_session, staged
from .sinks.tables import overwrite_table
from .sources.files import list_files, weather_paths
from .sources.manifest import landed_files


def run_events(spark: SparkSession, args) -> None:
    """Publish what keeps the contract; the others go to ``--rejects``, up to the share of ``--max-rejected``."""
    result = events.split_events(spark, args.input, max_rejected=args.max_rejected)
    events.publish_events(result.accepted, args.output, fmt=args.format, mode=args.mode or "append")
    if args.rejects:
        events.publish_events(result.rejected, args.rejects, fmt=args.format)


def run_weather(spark: SparkSession, args) -> None:
    result = weather.split_documents(spark, weather_paths(args.input, args.cities), args.max_rejected)
    weather.publish_weather(result.silver, args.output, fmt=args.format, mode=args.mode or "append")
    if args.rejects:
        weather.publish_weather(result.rejected, args.rejects, fmt=args.format)
    outcome_tally(result.outcomes).show()


def run_bars(spark: SparkSession, args) -> None:
    landed = landed_files(spark, args.manifest) if args.manifest else None
    result = bars.bars_to_silver(spark, args.input, args.tickers, landed=landed)
    bars.publish_bars(result.silver, args.output, fmt=args.format, mode=args.mode or "replace")
    outcome_tally(result.outcomes).show()


def run_land(spark: SparkSession, args) -> None:
    """Land payloads; symbols that are fresh in the target are not fetched and count as passed."""
    stamp = args.batch_ts or f"{dt.datetime.now(dt.timezone.utc):%Y%m%d_%H%M%S}"
    held = landed_files(spark, args.manifest) if args.manifest else list_files(spark, args.output, "*.csv")
    known = staged(
        freshness(held, F.current_timestamp(), days=args.days, force_refresh=args.force_refresh),
        "fresh",
    )
    result = landing.land_payloads(spark, args.input, args.output, stamp, args.manifest)
    outcome_tally(landing.with_skipped(result.outcomes, known)).show()


def run_plan(spark: SparkSession, args) -> None:
    """City-months, or symbols, that still have to be fetched."""
    if args.symbols:
        wanted = spark.createDataFrame([(s,) for s in args.symbols], "symbol string")
        known = freshness(
            list_files(spark, args.input), F.current_timestamp(), days=args.days, force_refresh=args.force_refresh
        )
        todo = symbols_to_fetch(wanted, known)
    else:
        if "all" in args.cities:
            raise SystemExit("a fetch plan needs --cities or --symbols by name")
        cities = spark.createDataFrame([(c,) for c in args.cities], "city string")
        todo = weather.plan_fetch(spark, cities, args.start_month, args.end_month, args.input)
    overwrite_table(todo, args.output, fmt=args.format)


def run_gold(spark: SparkSession, args) -> None:
    standard = gold.Period()
    period = gold.Period(
        start=args.start or standard.start,
        end=args.end or standard.end,
        tickers=tuple(args.tickers or standard.tickers),
        city=args.city or standard.city,
    )
    result = gold.run_gold(spark, args.input, args.output, period, fmt=args.format)
    print(result.summary)
    for row in result.preview:
        print(row)


JOBS = {
    "events": run_events,
    "weather": run_weather,
    "bars": run_bars,
    "land": run_land,
    "plan": run_plan,
    "gold": run_gold,
}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--mode", choices=["replace", "append"])
    parser.add_argument("--max-rejected", type=float, default=0.0)
    parser.add_argument("--rejects")
    parser.add_argument("--manifest")
    parser.add_argument("--cities", nargs="+", default=["all"])
    parser.add_argument("--city")
    parser.add_argument("--tickers", nargs="+")
    parser.add_argument("--symbols", nargs="+")
    parser.add_argument("--force-refresh", action="store_true")
    parser.add_argument("--days", type=float, default=1)
    parser.add_argument("--batch-ts")
    parser.add_argument("--start-month", default="2024-01")
    parser.add_argument("--end-month", default="2024-03")
    parser.add_argument("--start", type=dt.date.fromisoformat)
    parser.add_argument("--end", type=dt.date.fromisoformat)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = get_session(f"stratalake-{args.job}")
    try:
        JOBS[args.job](spark, args)
    finally:
        clear_scratch(spark)


if __name__ == "__main__":
    main()
