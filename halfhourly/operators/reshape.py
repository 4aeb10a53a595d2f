"""Wide to long and back: half-hour columns, stations, offer bands, lakes, quotes."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, Observation, functions as F

from halfhourly.operators.exact import exact_sums, is_floating, present, written_sums
from halfhourly.schemas import HALF_HOUR_NAMES, MW_PER_HALF_HOUR_KWH, TABLES
from halfhourly.session import staged

_PERIOD_COLUMN = re.compile(r"^TP\d+$", re.IGNORECASE)


def half_hour_to_long(df: DataFrame, factor: float = MW_PER_HALF_HOUR_KWH) -> DataFrame:
    """Wide half-hour energy (TP1..TP50, kWh) as average MW, one row per period.

    Rows that share all other columns are added up exactly (see :mod:`halfhourly.operators.exact`). A row that is
    alone under its key needs no sum: it stays wide, so the shuffle carries one row per day instead of
    fifty. Only the rows of repeated keys are spread first. Empty periods give no row, and rows
    with a null in an id column drop out.
    """
    named = df.toDF(*[HALF_HOUR_NAMES.get(c.upper(), c.upper()) for c in df.columns])
    periods = [c for c in named.columns if _PERIOD_COLUMN.match(c)]
    ids = [c for c in named.columns if c not in periods]
    labelled = named.withColumn("Unit_Measure", F.lit("MW"))
    ids = ids if "Unit_Measure" in ids else [*ids, "Unit_Measure"]
    complete = labelled.dropna(subset=ids)
    if not any(is_floating(complete.schema[p].dataType) for p in periods):
        long = _periods(complete.groupBy(*ids).agg(*[F.sum(p).alias(p) for p in periods]), ids, periods)
    else:
        seen = Observation()
        wide = staged(complete.groupBy(*ids).agg(F.count(F.lit(1)).alias("_rows"), *[F.max(p).alias(p) for p in periods])
                      .observe(seen, F.count_if(F.col("_rows") > 1).alias("repeated")), "half-hours")
        long = _periods(wide.where("_rows = 1"), ids, periods)
        if seen.get["repeated"]:
            spread = _periods(complete.join(wide.where("_rows > 1").select(*ids), ids, "left_semi"), ids, periods)
            filled, keys = spread.where(F.col("Average_Output").isNotNull()), [*ids, "Trading_Period"]
            seen = Observation()
            sums = staged(written_sums(filled, keys, "Average_Output", "Average_Output")
                          .observe(seen, F.sum("Average_Output_odd").alias("unheld")), "half-hour-sums")
            if seen.get["unheld"]:
                sums = exact_sums(filled, keys, {"Average_Output": "Average_Output"})
            long = long.unionByName(sums.select(*keys, "Average_Output"))
    value = F.col("Average_Output") * F.lit(factor)
    return long.where(F.col("Average_Output").isNotNull()).withColumn("Average_Output", value)


def _periods(wide: DataFrame, ids: list[str], periods: list[str]) -> DataFrame:
    """One row per id and filled period, without an array of all periods for each row."""
    named = {p: f"_{p[2:]}" for p in periods}
    cells = wide.select(*ids, *[present(F.col(p).cast("double")).alias(n) for p, n in named.items()])
    long = columns_to_rows(cells, ids, list(named.values()), "_period", "Average_Output")
    return long.select(*ids, F.substring("_period", 2, 9).cast("int").alias("Trading_Period"), "Average_Output")


def columns_to_rows(df: DataFrame, ids: list[str], columns: list[str], name: str,
                    value: str) -> DataFrame:
    """One row per id and filled column."""
    return df.unpivot(ids, columns, name, value).where(F.col(value).isNotNull())


def wind_to_long(df: DataFrame) -> DataFrame:
    """Wind station columns as rows (stamp, station, mw)."""
    stations = [c for c in TABLES["scada_wind_data"].names if c != "stamp"]
    return columns_to_rows(df, ["stamp"], stations, "station", "mw")


def offer_bands(df: DataFrame, offer_type: str) -> DataFrame:
    """Offer bands as rows: the offer's own columns, the band, its MW and price.

    Energy gives ``band, power, price``.  Reserve offers add ``product`` (PLSR,
    TWDSR or IL), ``reserve_class`` (6s or 60s) and, where offered, ``percent``.
    Bands without power or without price are left out.  Bands a table lacks are
    passed over, so a narrower table reads the same way.
    """
    present = set(df.columns)
    bands = [b for b in _bands(offer_type) if b["power"] in present and b["price"] in present]
    if not bands:
        raise ValueError(f"no {offer_type} band columns in {df.columns}")
    used = {c for c in present if re.match(r"^band\d+_", c)}
    ids = [c for c in df.columns if c not in used]
    stacked = F.array(*[F.struct(*_band_fields(b, present)) for b in bands])
    return (df.select(*ids, F.inline(stacked))
            .where(F.col("power").isNotNull() & F.col("price").isNotNull()))


def _bands(offer_type: str) -> list[dict[str, str]]:
    if offer_type == "Energy":
        return [{"band": b, "power": f"band{b}_power", "price": f"band{b}_price"}
                for b in range(1, 6)]
    if offer_type == "PLSR":
        return [{"band": b, "product": p, "reserve_class": s,
                 "power": f"band{b}_{p.lower()}_{s}_max",
                 "price": f"band{b}_{p.lower()}_{s}_price",
                 "percent": f"band{b}_{p.lower()}_{s}_percent"}
                for b in range(1, 4) for p in ("PLSR", "TWDSR") for s in ("6s", "60s")]
    if offer_type == "IL":
        return [{"band": b, "product": "IL", "reserve_class": s,
                 "power": f"band{b}_{s}_max", "price": f"band{b}_{s}_price"}
                for b in range(1, 4) for s in ("6s", "60s")]
    raise ValueError(f"offer type {offer_type!r}: use Energy, PLSR or IL")


def _band_fields(band: dict, present: set) -> list[Column]:
    fields = [F.lit(band["band"]).alias("band")]
    fields += [F.lit(band[k]).alias(k) for k in ("product", "reserve_class") if k in band]
    fields += [F.col(band[k]).cast("double").alias(k) for k in ("power", "price")]
    if "percent" in band:
        percent = F.col(band["percent"]) if band["percent"] in present else F.lit(None)
        fields.append(percent.cast("double").alias("percent"))
    return fields


def rows_to_columns(df: DataFrame, keys: list[str], name: str, value: str,
                    names: list) -> DataFrame:
    """One column per given name; missing cells are null.

    The names are given, so no pass is needed to find them, and each task reduces
    its rows to one per key before the shuffle.
    """
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(name) == F.lit(n), F.col(value))).alias(str(n)) for n in names])


def lakes_to_columns(df: DataFrame, lakes: list[str], value: str = "lake_levels") -> DataFrame:
    """Date by lake."""
    return rows_to_columns(df, ["trading_date"], "lake", value, lakes)


def quarters(begin: dt.date, end: dt.date) -> list[dt.date]:
    """The first days of the quarters of a range of days."""
    found = []
    for year in range(begin.year, end.year + 1):
        for month in (1, 4, 7, 10):
            if (begin.year, (begin.month - 1) // 3) <= (year, month // 3) and dt.date(year, month, 1) <= end:
                found.append(dt.date(year, month, 1))
    return found


def expiries_of(quotes: DataFrame) -> list:
    """The expiries of a series in order: a few for each year, as they become columns."""
    return [r[0] for r in quotes.select("expiry").where(F.col("expiry").isNotNull()).distinct()
            .orderBy("expiry").collect()]


def quotes_to_columns(df: DataFrame, fields: list[str], expiries: list, outside: str | None = None) -> DataFrame:
    """Fields of the futures quotes by product and quote date, a column ``expiry_field`` for each.

    ``outside`` names a column that counts the quotes whose expiry is none of those given, so none goes unnoticed.
    """
    others = F.count_if(~F.coalesce(F.col("expiry").isin(expiries), F.lit(False)))
    return df.groupBy("product", "quote_date").agg(
        *[F.max(F.when(F.col("expiry") == F.lit(e), F.col(f))).alias(f"{e}_{f}")
          for e in expiries for f in fields], *([others.alias(outside)] if outside else []))
