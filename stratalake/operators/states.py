"""Daily aggregates as states that merge: parts of a day give the figures of the day.

A state holds sums, counts, moments (n, mean, squared deviations) and sketches of
distinct values. Batches write states of their own rows; a day is read by merging
its states, so a new batch never needs the rows of the earlier ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefeatures import flag
from .calendar import as_date
from .daily import change_pct

# log2 of the registers of a sketch: its relative standard error is about 1.04 / sqrt(2^LG_K).
LG_K = 12


def sales_states(events: DataFrame, by: Sequence[str] = (), price_decimals: int = 2, lg_k: int = LG_K) -> DataFrame:
    """Mergeable sales per day (and ``by``): events, revenue in units of the price, users, products."""
    units = F.rint(F.col("price") * 10**price_decimals).cast("bigint")
    return events.groupBy(F.to_date("event_time").alias("date"), *by).agg(
        F.count(F.lit(1)).alias("events"),
        F.count("price").alias("priced"),
        F.coalesce(F.sum(units), F.lit(0).cast("long")).alias("revenue_units"),
        F.hll_sketch_agg("user_id", lg_k).alias("users"),
        F.hll_sketch_agg("product_id", lg_k).alias("products"),
    )


def merge_sales_states(states: DataFrame, by: Sequence[str] = ("date",)) -> DataFrame:
    """States of the same ``by`` as one; merging in any grouping gives the same state."""
    return states.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("events", "priced", "revenue_units")],
        *[F.hll_union_agg(c).alias(c) for c in ("users", "products")],
    )


def sales_of(states: DataFrame, price_decimals: int = 2) -> DataFrame:
    """Daily sales from merged states; distinct counts are estimates."""
    revenue = F.col("revenue_units") / F.lit(float(10**price_decimals))
    users = F.hll_sketch_estimate("users")
    return states.select(
        "date",
        F.col("events").alias("sales_event_count"),
        F.when(F.col("priced") > 0, revenue).alias("sales_total_revenue"),
        F.try_divide(revenue, "priced").alias("sales_avg_price"),
        users.alias("sales_unique_users"),
        F.hll_sketch_estimate("products").alias("sales_unique_products"),
        F.try_divide(F.when(F.col("priced") > 0, revenue), users).alias("sales_revenue_per_user"),
    )


def _squares(value: Column) -> Column:
    """Sum of squared deviations of the values that are there."""
    return F.coalesce(F.var_pop(value) * F.count(value), F.lit(0.0))


def market_states(bars: DataFrame, tickers: Sequence[str], start, end, by: Sequence[str] = ()) -> DataFrame:
    """Mergeable market figures per day (and ``by``): moments of the change, counts, volume."""
    inside = F.col("ticker").isin(*tickers) & F.col("trade_date").between(as_date(start), as_date(end))
    rows = bars.filter(inside).withColumn("change", change_pct(F.col("open_price"), F.col("close_price")))
    return rows.groupBy(F.col("trade_date").cast("date").alias("date"), *by).agg(
        F.count("change").alias("n"),
        F.coalesce(F.avg("change"), F.lit(0.0)).alias("mean"),
        _squares(F.col("change")).alias("m2"),
        F.sum(flag(F.col("change") > 0)).alias("positive"),
        F.count(F.lit(1)).alias("bars"),
        F.count("volume").alias("volumes"),
        F.sum(F.col("volume").cast("double")).alias("volume"),
    )


def merge_market_states(states: DataFrame) -> DataFrame:
    """States of a day as one.

    Means are taken relative to the mean of one of the day's states, so squares of
    large numbers are never subtracted from one another. One short row per day is
    joined back for that.
    """
    nearby = states.filter("n > 0").groupBy("date").agg(F.max("mean").alias("near"))
    shifted = states.join(nearby, "date", "left").withColumn("off", F.coalesce(F.col("mean") - F.col("near"), F.lit(0.0)))
    sums = shifted.groupBy("date").agg(
        F.sum("n").alias("n"), F.max("near").alias("near"),
        F.sum(F.col("n") * F.col("off")).alias("first"), F.sum(F.col("n") * F.col("off") * F.col("off")).alias("second"),
        *[F.sum(c).alias(c) for c in ("m2", "positive", "bars", "volumes", "volume")],
    )
    off = F.coalesce(F.try_divide("first", "n"), F.lit(0.0))
    m2 = F.col("m2") + F.greatest(F.col("second") - F.col("n") * off * off, F.lit(0.0))
    mean = F.coalesce(F.col("near") + off, F.lit(0.0))
    return sums.select("date", "n", mean.alias("mean"), m2.alias("m2"), "positive", "bars", "volumes", "volume")


def market_of(states: DataFrame) -> DataFrame:
    """Daily market figures from merged states; volatility is the sample deviation."""
    return states.select(
        "date",
        F.when(F.col("n") > 0, F.col("mean")).alias("market_avg_change_pct"),
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("market_volatility"),
        (F.col("positive") / F.col("bars")).alias("market_positive_ratio"),
        F.col("bars").alias("market_stocks_traded"),
        F.try_divide("volume", "volumes").alias("market_avg_volume"),
    )
