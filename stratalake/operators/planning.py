"""What still has to be fetched, and which stored file of a key counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import _decoded, batch_time, city_folder, month_file, path_batch, path_key
from .calendar import MONTH, month_days, month_range
from .joins import drop_listed, keep_listed
from .nesting import DOCUMENT_PREFIX


def _bounded_cities(cities: DataFrame, start_month: str, end_month: str, prefix: str) -> DataFrame:
    """Cities with their document folder and the first and last wanted month.

    A city row is tiny and becomes one row per month, so the cities are dealt
    out over all shuffle partitions: one block of the city table would otherwise
    make the plan rows of many million cities in a single task.
    """
    tasks = int(cities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cities.select(
        "city",
        city_folder(F.col("city"), prefix).alias("folder"),
        F.to_date(F.lit(f"{start_month}-01")).alias("low"),
        F.to_date(F.lit(f"{end_month}-01")).alias("high"),
    ).repartition(tasks, "folder")


def _with_document_key(months: DataFrame) -> DataFrame:
    key = month_file(F.col("folder"), F.col("year"), F.col("month"))
    return months.withColumn("document_key", key).drop("folder")


def month_plan(cities: DataFrame, start_month: str, end_month: str, prefix: str = DOCUMENT_PREFIX) -> DataFrame:
    """Wanted documents: every city for every month from ``yyyy-MM`` to ``yyyy-MM``.

    The months are spread per city row, not by a cross join.
    """
    return _with_document_key(month_range(_bounded_cities(cities, start_month, end_month, prefix), "low", "high"))


def document_keys(files: DataFrame, prefix: str = DOCUMENT_PREFIX) -> DataFrame:
    """Document key of every listed document, blanks in names written as ``_``.

    A document is the file ``<month>.json`` of its year, or any JSON file in the
    ``month=`` folder that the own writer makes. Values of folders are decoded.
    """
    start = f"{prefix}/city="
    found = files.filter(F.col("path").contains(start))
    rest = F.substr("path", F.instr("path", start))
    own = F.regexp_replace(rest, r"/month=(\d+)/[^/]+\.json$", "/$1.json")
    city = _decoded(F.regexp_extract(own, r"/city=([^/]+)/", 1))
    key = F.concat(F.lit(start), F.translate(city, " ", "_"), F.regexp_extract(own, r"/city=[^/]+(/.*)$", 1))
    return found.select(key.alias("document_key"))


def document_inventory(files: DataFrame, prefix: str = DOCUMENT_PREFIX) -> DataFrame:
    """Distinct keys of the documents already stored."""
    return document_keys(files, prefix).distinct()


def missing_documents(plan: DataFrame, inventory: DataFrame) -> DataFrame:
    """Rows of any plan with a ``document_key`` that is not stored yet."""
    return drop_listed(plan, inventory, ["document_key"])


# Months held by one long of a month set.
WORD = 62


def _month_number(text: str) -> int:
    year, month = text.split("-")
    return int(year) * 12 + int(month)


def stored_month_sets(keys: DataFrame, start_month: str, end_month: str) -> DataFrame:
    """Months of the period each document folder holds, as bits of a few longs.

    Bits combine by ``or`` before the shuffle: a folder costs a few longs however
    many files it lists, and the aggregation needs no collected arrays.
    """
    first, months = _month_number(start_month), _month_number(end_month) - _month_number(start_month) + 1
    key = F.col("document_key")
    name = F.split_part(key, F.lit("/year="), F.lit(2))
    number = F.substring(name, 1, 4).try_cast("int") * 12 + F.substring(name, 6, 2).try_cast("int")
    indexed = keys.select(
        F.split_part(key, F.lit("/year="), F.lit(1)).alias("folder"),
        F.when(name.rlike(r"^\d{4}/\d{2}\.json$"), number - first).alias("month_index"),
    )
    bit = F.expr(f"shiftleft(1L, month_index % {WORD})")
    sets = [
        F.bit_or(F.when(F.col("month_index").between(low, min(low + WORD, months) - 1), bit)).alias(f"months_{low}")
        for low in range(0, months, WORD)
    ]
    return indexed.groupBy("folder").agg(*sets)


def missing_months(
    cities: DataFrame, keys: DataFrame, start_month: str, end_month: str, prefix: str = DOCUMENT_PREFIX
) -> DataFrame:
    """``missing_documents(month_plan(…))``, compared before the months are spread.

    The stored months of a city meet its wanted months as one row, and only the
    missing ones are made. What is shuffled is a short row per city and per
    folder; the plan rows never are.
    """
    stored = stored_month_sets(keys, start_month, end_month)
    words = F.array(*[F.coalesce(c, F.lit(0).cast("bigint")) for c in stored.columns if c != "folder"])
    spread = (
        _bounded_cities(cities, start_month, end_month, prefix)
        .join(stored, "folder", "left")
        .select(
            "city",
            "folder",
            words.alias("words"),
            F.posexplode(F.sequence("low", "high", F.expr(MONTH))).alias("index", "month_start"),
        )
    )
    held = F.expr(f"shiftright(get(words, index div {WORD}), index % {WORD}) & 1L") == 1
    return _with_document_key(
        spread.filter(~held).select(
            "city", "folder", "month_start", F.year("month_start").alias("year"), F.month("month_start").alias("month")
        )
    )


def days_to_fetch(missing: DataFrame) -> DataFrame:
    """One row per day of each missing document."""
    return month_days(missing)


def latest_files(
    files: DataFrame,
    *,
    key: str = "ticker",
    suffix: str = ".csv",
    allowed: DataFrame | None = None,
) -> DataFrame:
    """Greatest file path per key folder; keys without a matching file give no row."""
    keyed = _keyed(files, key, suffix, allowed)
    return keyed.groupBy(key).agg(F.max("path").alias("path"))


def latest_batch_files(
    files: DataFrame,
    *,
    key: str = "ticker",
    suffix: str = ".csv",
    allowed: DataFrame | None = None,
) -> DataFrame:
    """Every file of the newest batch of each key, where a batch may have many files."""
    keyed = _keyed(files, key, suffix, allowed).withColumn("batch", path_batch(F.col("path")))
    newest = keyed.groupBy(key).agg(F.max("batch").alias("batch"))
    return keyed.join(newest, [key, "batch"], "left_semi").select(key, "path")


def _keyed(files: DataFrame, key: str, suffix: str, allowed: DataFrame | None) -> DataFrame:
    keyed = files.filter(F.col("path").endswith(suffix)).select(path_key(F.col("path")).alias(key), "path")
    return keyed if allowed is None else keep_listed(keyed, allowed, [key])


def freshness(
    files: DataFrame,
    run_ts: Column,
    *,
    key: str = "symbol",
    days: float = 1,
    force_refresh: bool = False,
) -> DataFrame:
    """Whether the newest file of each key is younger than ``days`` before the run.

    The greatest file name is the newest one; a name that is no time stamp is
    not fresh. ``force_refresh`` makes every key stale.
    """
    newest = files.groupBy(path_key(F.col("path")).alias(key)).agg(
        F.max(path_batch(F.col("path"))).alias("newest_batch")
    )
    stamp = batch_time(F.col("newest_batch"))
    threshold = run_ts - F.make_dt_interval(secs=F.lit(days * 86400.0).cast("decimal(18,6)"))
    fresh = F.lit(not force_refresh) & F.coalesce(stamp > threshold, F.lit(False))
    return newest.select(key, "newest_batch", stamp.alias("newest_stamp"), fresh.alias("fresh"))


def symbols_to_fetch(wanted: DataFrame, fresh: DataFrame, key: str = "symbol") -> DataFrame:
    """Wanted keys without a fresh file, including those never stored."""
    return drop_listed(wanted, fresh.filter("fresh"), [key])
