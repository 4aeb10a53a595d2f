"""Price and demand distributions, offer curves, offers next to demand."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from halfhourly.operators.ordered import quantiles, running_total

PROBABILITIES = [0.05, 0.25, 0.5, 0.75, 0.95]


def price_distribution(prices: DataFrame, keys: list[str],
                       probabilities: list[float] | None = None, exact: bool = True) -> DataFrame:
    """Price quantiles per group: ``probability``, ``value``.

    ``exact=False`` takes Spark's quantile sketch, one pass and one shuffle.
    """
    return _distribution(prices, keys, "price", probabilities, exact)


def demand_distribution(demand: DataFrame, keys: list[str],
                        probabilities: list[float] | None = None,
                        exact: bool = True) -> DataFrame:
    """Demand quantiles per group, such as load area and trading period."""
    return _distribution(demand, keys, "demand", probabilities, exact)


def _distribution(df, keys, col, probabilities, exact) -> DataFrame:
    steps = probabilities or PROBABILITIES
    if exact:
        return quantiles(df, keys, col, steps)
    sketch = df.groupBy(*keys).agg(F.percentile_approx(col, steps, 10_000).alias("_q"))
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in steps]).alias("probability"),
                         F.col("_q").alias("value"))
    return sketch.select(*keys, F.inline(pairs).alias("probability", "value"))


def histogram(df: DataFrame, keys: list[str], col: str, width: float) -> DataFrame:
    """Rows per group and value bin of a given width."""
    lower = F.floor(F.col(col) / F.lit(width)) * F.lit(width)
    return (df.where(F.col(col).isNotNull()).groupBy(*keys, lower.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def offer_curve(bands: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Offered MW added up in price order, one step per price, per trading period.

    ``bands`` is the long form of the offers (see ``query_offer``).
    """
    keys = keys or ["trading_date", "trading_period"]
    return running_total(bands.select(*keys, "price", "power"), keys, "price", "power",
                         "cumulative_power")


def merge_offers_demand(offers: DataFrame, demand: DataFrame,
                        node_col: str = "grid_injection_point") -> DataFrame:
    """Offers with the demand of their node, date and trading period.

    Demand has one row per key, so a key with many offers is only split, never
    multiplied; adaptive execution splits the partitions of such keys.
    """
    side = demand.select("trading_date", "trading_period", F.col("node").alias(node_col), "demand")
    return offers.join(side, ["trading_date", "trading_period", node_col])
