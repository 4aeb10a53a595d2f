"""Queries on nodal prices, nodal demand and offers.

Each is one lazy DataFrame; Catalyst pushes the filters to the scan and prunes
the years.  The functions take the table to query; :class:`Market` finds the
tables itself and is the form without default nodes and with an inner metadata
join.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession

from halfhourly.operators.aggregates import group_by_meta
from halfhourly.operators.joins import merge_meta
from halfhourly.operators.predicates import (check_optional_range, check_required_range, choose,
                                             date_filter, leave_out, named_nodes, period_filter,
                                             settled, value_filter)
from halfhourly.operators.reshape import offer_bands
from halfhourly.schemas import OFFER_TYPES
from halfhourly.sources.tables import (Load, bytes_per_year, create_tables, insert_from_csv, stored_bytes,
                                       read_table)

# A demand bound of zero asks for consuming nodes, so it leaves zero itself out.
LEAST_DEMAND = 0.0001


def _market_rows(table, dates, begin_date, end_date, periods, begin_period, end_period,
                 range_break) -> DataFrame:
    dates, periods = settled(dates), settled(periods)
    check_required_range(dates, begin_date, end_date)
    check_optional_range(periods, begin_period, end_period)
    dated = date_filter(table, dates, begin_date, end_date, range_break=range_break)
    return period_filter(dated, periods, begin_period, end_period)


def _with_meta(df, metadata, col, meta_how) -> DataFrame:
    if metadata is None:
        raise ValueError("apply_meta needs the metadata table")
    return merge_meta(df, metadata, col, meta_how)


def query_nodal_price(prices: DataFrame, begin_date=None, end_date=None, dates=None,
                      begin_period=None, end_period=None, periods=None, minimum_price=None,
                      maximum_price=None, nodes="Major", apply_meta: bool = False,
                      metadata: DataFrame | None = None, meta_how: str = "left",
                      range_break: str = "Year") -> DataFrame:
    """Prices of some dates (one, a list, or a range), optionally of some trading
    periods, nodes (or the sets ``"Major"`` and ``"Core"``) and price bounds.

    ``apply_meta`` joins the node metadata.
    """
    found = _market_rows(prices, dates, begin_date, end_date, periods, begin_period,
                         end_period, range_break)
    found = choose(found, node=named_nodes(nodes))
    found = value_filter(found, "price", minimum_price, maximum_price)
    return _with_meta(found, metadata, "price", meta_how) if apply_meta else found


def query_nodal_demand(demand: DataFrame, begin_date=None, end_date=None, dates=None,
                       begin_period=None, end_period=None, periods=None, nodes=None,
                       minimum_demand=None, maximum_demand=None, apply_meta: bool = False,
                       meta_group=None, meta_agg=None, excl_nodes=None,
                       metadata: DataFrame | None = None, meta_how: str = "left",
                       range_break: str = "Year") -> DataFrame:
    """Demand of some dates, optionally of some periods, nodes and bounds, without
    the nodes in ``excl_nodes`` (``"Wind"`` names the wind farms).

    ``apply_meta`` joins the node metadata; ``meta_group`` and ``meta_agg`` then
    group by any column and aggregate the others.
    """
    if (meta_group is None) != (meta_agg is None) or (meta_group is not None and not apply_meta):
        raise ValueError("grouping needs apply_meta, meta_group and meta_agg together")
    found = _market_rows(demand, dates, begin_date, end_date, periods, begin_period,
                         end_period, range_break)
    found = leave_out(choose(found, node=named_nodes(nodes)), node=named_nodes(excl_nodes))
    if minimum_demand is not None and float(minimum_demand) == 0:
        minimum_demand = LEAST_DEMAND
    found = value_filter(found, "demand", minimum_demand, maximum_demand)
    if not apply_meta:
        return found
    rich = _with_meta(found, metadata, "demand", meta_how)
    return rich if meta_group is None else group_by_meta(rich, meta_group, meta_agg)


def query_offer(offers: DataFrame, offer_type: str, dates=None, begin_date=None, end_date=None,
                periods=None, begin_period=None, end_period=None, companies=None, stations=None,
                nodes=None, as_offerframe: bool = True, range_break: str = "Year") -> DataFrame:
    """Offers of a type (Energy, PLSR, IL), optionally of some companies, stations
    and nodes; one row per band unless ``as_offerframe`` is false.
    """
    if offer_type not in OFFER_TYPES:
        raise ValueError(f"offer type {offer_type!r}: use one of {list(OFFER_TYPES)}")
    node_col = OFFER_TYPES[offer_type][1]
    found = _market_rows(offers, dates, begin_date, end_date, periods, begin_period,
                         end_period, range_break)
    found = choose(found, company=companies, station=stations, **{node_col: nodes})
    return offer_bands(found, offer_type) if as_offerframe else found


class Market:
    """The market tables below one folder, or given as DataFrames, with their queries."""

    def __init__(self, spark: SparkSession, root: str | None = None,
                 tables: dict[str, DataFrame] | None = None,
                 metadata: DataFrame | None = None):
        self.spark = spark
        self.root = root.rstrip("/") if root else None
        self.tables = dict(tables or {})
        self.metadata = metadata

    def table(self, name: str) -> DataFrame:
        if name in self.tables:
            return self.tables[name]
        if self.root is None:
            raise ValueError(f"no table {name!r} given and no folder to read it from")
        return read_table(self.spark, f"{self.root}/{name}", name)

    def _place(self, name: str) -> str:
        if self.root is None:
            raise ValueError("a market without a folder stores nothing")
        return f"{self.root}/{name}"

    def create_all_tables(self, database: str = "default") -> None:
        create_tables(self.spark, database=database, location=self._place("")[:-1])

    def insert_from_csv(self, table: str, csvfile: str | list[str], mode: str = "skip_rows") -> Load:
        """Loads one CSV file; known rows are skipped, or reject it (``reject_file``)."""
        return insert_from_csv(self.spark, csvfile, self._place(table), table, mode)

    def insert_many_csv(self, table: str, folder: str, mode: str = "skip_rows") -> Load:
        """Loads every CSV file of a folder, all in one job."""
        return insert_from_csv(self.spark, folder, self._place(table), table, mode, "*.csv")

    def get_all_table_sizes(self, table: str) -> DataFrame:
        """Stored bytes of each year of a table."""
        if table in self.tables:
            return bytes_per_year(self.tables[table])
        return stored_bytes(self.spark, self._place(table), table)

    def query_nodal_price(self, nodes=None, meta_how: str = "inner", **options) -> DataFrame:
        return query_nodal_price(self.table("nodal_prices"), nodes=nodes, meta_how=meta_how,
                                 metadata=self.metadata, **options)

    def query_nodal_demand(self, meta_how: str = "inner", **options) -> DataFrame:
        return query_nodal_demand(self.table("nodal_demand"), meta_how=meta_how,
                                  metadata=self.metadata, **options)

    def query_offer(self, master_table: str, grid_points=None, **options) -> DataFrame:
        by_table = {table: kind for kind, (table, _) in OFFER_TYPES.items()}
        if master_table not in by_table:
            raise ValueError(f"{master_table!r} holds no offers")
        return query_offer(self.table(master_table), by_table[master_table], nodes=grid_points,
                           **options)


def stack(frames: list[DataFrame]) -> DataFrame:
    """Results below each other, duplicates kept, columns matched by name."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return stacked
