"""Table schemas, unique keys and domain constants of the market data model.

Every table is one DataFrame.  Tables marked ``by_year`` carry an extra
``trading_year`` column they are partitioned by on disk.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values of the market ------------------------------------------------

CORE_NODES = ("OTA2201", "BEN2201", "HAY2201", "HLY2201",
              "MAN2201", "BPE2201", "PEN2201", "ISL2201")
MAJOR_NODES = ("OTA2201", "HAY2201", "BEN2201")
WIND_NODES = ("TWC2201", "WDV1101", "WWD1101", "WWD1102", "WWD1103", "TWH0331")

NODE_SETS = {"Core": CORE_NODES, "Major": MAJOR_NODES, "Wind": WIND_NODES}

# offer type -> (table, column that holds the node)
OFFER_TYPES = {"Energy": ("energy_offers", "grid_injection_point"),
               "PLSR": ("generatorreserves_offers", "grid_point"),
               "IL": ("ilreserves_offers", "grid_exit_point")}

PERIOD_MINUTES = 30
NORMAL_PERIODS = 48          # 46 or 50 on the two clock-change days
MAX_PERIODS = 50
MW_PER_HALF_HOUR_KWH = 1.0 / 500.0

# measure word in a lake file -> (name, unit, table, value column)
LAKE_MEASURES = {"stored": ("Lake Levels", "GWh", "lake_levels", "lake_levels"),
                 "inflow": ("Inflows", "GWh/d", "lake_inflows", "inflows"),
                 "cusum": ("Cusum", "GWh", "lake_cusum", "cusum")}

# futures product -> (expiry frequency, series name, day before the first quote)
_FIRST = dt.date(2009, 7, 13)
_SECOND = dt.date(2013, 12, 8)
FUTURES_PRODUCTS = {"BB": ("Q", "BB_90D", _FIRST), "TY": ("Q", "TY_3YR", _FIRST),
                    "TN": ("Q", "TN_10Y", _FIRST), "ZO": ("M", "ZO_OCR", _FIRST),
                    "EA": ("Q", "EA_OTA", _FIRST), "EB": ("A", "EB_OTA", _FIRST),
                    "EC": ("Q", "EC_OTA", _SECOND), "ED": ("M", "ED_OTA", _SECOND),
                    "EE": ("Q", "EE_BEN", _FIRST), "EF": ("A", "EF_BEN", _FIRST),
                    "EG": ("Q", "EG_BEN", _SECOND), "EH": ("M", "EH_BEN", _SECOND)}
# field headings in a futures page
FUTURES_FIELDS = ("Op Int", "Volume", "Sett")

WEATHER_LOCATIONS = ("Newmarket-Auckland", "Christchurch-Canterbury",
                     "Kelburn-Wellington", "Napier-HawkesBay",
                     "PalmerstonNorth-Manawatu", "Dunedin-Otago")

# wide half-hour column in upper case -> name in the tidy table
HALF_HOUR_NAMES = {"POC": "Grid_Point", "NWK_CODE": "Distribution_Network",
                   "GENERATION_TYPE": "Generation_Type", "TRADER": "Company",
                   "UNIT_MEASURE": "Unit_Measure", "FLOW_DIRECTION": "Flow_Direction",
                   "STATUS": "Status", "TRADING_DATE": "Trading_Date"}

# --- Tables: fixed values, as published ------------------------------------------
# Names, order, types, lengths and unique keys of the columns.


@dataclass(frozen=True)
class Table:
    """Columns, unique key and year split of one table.

    ``columns`` maps a lower-case name to ``date``, ``int``, ``double``,
    ``timestamp``, ``time`` (text ``HH:mm``), ``text`` or ``text(n)``.
    """

    name: str
    columns: dict[str, str]
    key: tuple[str, ...]
    by_year: bool = True
    date_col: str = "trading_date"

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c, _spark_type(k)) for c, k in self.columns.items()])

    @property
    def names(self) -> list[str]:
        return list(self.columns)

    def max_length(self, column: str) -> int | None:
        kind = self.columns[column]
        return int(kind[5:-1]) if kind.startswith("text(") else None


def _spark_type(kind: str) -> T.DataType:
    if kind.startswith("text") or kind == "time":
        return T.StringType()
    return {"date": T.DateType(), "int": T.IntegerType(), "double": T.DoubleType(),
            "timestamp": T.TimestampNTZType()}[kind]


def _doubles(names) -> dict[str, str]:
    return {n: "double" for n in names}


PERIOD_COLUMNS = [f"tp{p}" for p in range(1, MAX_PERIODS + 1)]
_PERIODS = _doubles(PERIOD_COLUMNS)

_ENERGY_BANDS = _doubles(f"band{b}_{f}" for b in range(1, 6) for f in ("power", "price"))
# spinning reserve is offered with a percentage, tail-water reserve without
_GENERATOR_BANDS = _doubles(
    f"band{b}_{product}_{speed}_{field}"
    for b in range(1, 4)
    for product, fields in (("plsr", ("price", "max", "percent")), ("twdsr", ("price", "max")))
    for speed in ("6s", "60s")
    for field in fields)
_LOAD_BANDS = _doubles(f"band{b}_{speed}_{field}" for b in range(1, 4)
                       for speed in ("6s", "60s") for field in ("price", "max"))

_GRID = {"poc": "text(7)", "nwk_code": "text(4)", "generation_type": "text(2)",
           "trader": "text(4)", "unit_measure": "text(3)", "flow_direction": "text(1)",
           "status": "text(1)", "trading_date": "date"} | _PERIODS
_GRID_KEY = ("poc", "nwk_code", "generation_type", "trader", "trading_date")


def _lake(name: str, value: str, unit: int) -> Table:
    return Table(name, {"trading_date": "date", value: "double", "lake": "text(12)", "unit": f"text({unit})"},
                 ("trading_date", "lake"), by_year=False)


TABLES: dict[str, Table] = {t.name: t for t in (
    Table("nodal_prices",
          {"trading_date": "date", "trading_period": "int", "node": "text(7)",
           "price": "double"},
          ("trading_date", "trading_period", "node")),
    Table("nodal_demand",
          {"trading_date": "date", "trading_period": "int", "time": "time",
           "island": "text(2)", "node": "text(7)", "demand": "double"},
          ("trading_date", "trading_period", "node")),
    Table("rich_demand_group",
          {"trading_date": "date", "trading_period": "int", "time": "time",
           "island": "text(2)", "load_area": "text(255)", "island_name": "text(255)",
           "demand": "double"},
          ("trading_date", "trading_period", "load_area")),
    Table("energy_offers",
          {"company": "text(4)", "grid_injection_point": "text(7)", "station": "text(3)",
           "unit": "int", "trading_date": "date", "trading_period": "int",
           "max_output": "double", "max_ramp_up_rate": "double",
           "max_ramp_down_rate": "double"}
          | _ENERGY_BANDS | {"created_date": "date", "last_amended_date": "date"},
          ("company", "grid_injection_point", "station", "unit",
           "trading_date", "trading_period")),
    Table("generatorreserves_offers",
          {"company": "text(4)", "grid_point": "text(7)", "trading_date": "date",
           "trading_period": "int", "station": "text(3)", "unit": "int"}
          | _GENERATOR_BANDS | {"created_date": "date", "last_amended_date": "date"},
          ("company", "grid_point", "trading_date", "trading_period", "station", "unit")),
    Table("ilreserves_offers",
          {"company": "text(4)", "grid_exit_point": "text(7)", "trading_date": "date",
           "trading_period": "int", "int_load_6s": "text(1)", "int_load_60s": "text(1)"}
          | _LOAD_BANDS | {"created_date": "date", "last_amended_date": "date"},
          ("company", "grid_exit_point", "trading_date", "trading_period")),
    Table("grid_imports", _GRID, _GRID_KEY),
    Table("grid_exports", _GRID, _GRID_KEY),
    Table("hvdc_flows", _GRID,
          ("poc", "generation_type", "flow_direction", "trader", "trading_date")),
    Table("embedded_generation",
          {"poc": "text(7)", "nwk_code": "text(4)", "participant_code": "text(4)",
           "loss_code": "text(7)", "flow_direction": "text(1)", "trading_date": "date"} | _PERIODS,
          ("poc", "nwk_code", "participant_code", "flow_direction", "trading_date")),
    Table("unit_level_generation",
          {"poc": "text(7)", "unit_code": "text(4)", "participant_code": "text(4)",
           "gen_measure": "text(3)", "flow_direction": "text(1)", "gen_type": "text(1)",
           "trading_date": "date"} | _PERIODS,
          ("poc", "unit_code", "participant_code", "gen_type", "trading_date")),
    Table("frequency_keeping_final_offers",
          {"submission_date": "timestamp", "pnode_name": "text(13)",
           "trader_name": "text(4)", "trading_period_start_date": "date", "mw": "double",
           "price": "double", "min_mw": "double", "max_mw": "double",
           "src_offer_block_id": "int", "trading_period": "int"},
          ("pnode_name", "trader_name", "trading_period_start_date", "trading_period"),
          date_col="trading_period_start_date"),
    Table("frequency_keeping_final_dispatch",
          {"offer_submission_date": "timestamp", "trading_period_start_date": "date",
           "offer_price": "double", "frequency_band_mw": "double",
           "island_name": "text(2)", "pnode_name": "text(13)", "trader_name": "text(4)",
           "trading_period": "int"},
          ("trader_name", "pnode_name", "trading_period_start_date", "trading_period"),
          date_col="trading_period_start_date"),
    Table("scada_wind_data",
          {"stamp": "timestamp", "bpe_statn_generation_twf_mw": "double",
           "ltn_statn_generation_twf_mw": "double",
           "twc_statn_generation_twc_mw": "double",
           "twh_statn_generation_tuk_mw": "double",
           "trh_statn_generation_trh_mw": "double",
           "hwb_statn_generation_mah_mw": "double",
           "wdv_statn_generation_tap_mw": "double",
           "wwd_statn_generate_wwd_a_mw": "double",
           "wwd_statn_generate_wwd_b_mw": "double",
           "nma_statn_generation_whl_mw": "double"},
          ("stamp",), date_col="stamp"),
    Table("temperature_data",
          {"local_time": "time", "temperature": "int", "dewpoint": "int",
           "humidity": "int", "barometer": "int", "visibility": "int",
           "wind_direction": "text(15)", "wind_speed": "double", "gust_speed": "double",
           "precipitation": "double", "events": "text(255)", "conditions": "text(255)",
           "trading_date": "date", "location": "text(255)"},
          ("trading_date", "local_time", "location")),
    _lake("lake_levels", "lake_levels", 3),
    _lake("lake_inflows", "inflows", 5),
    _lake("lake_cusum", "cusum", 3),
    Table("reserve_prices",
          {"period_start": "timestamp", "period_end": "timestamp",
           "trading_period": "int", "region_id": "text(2)", "region": "text(255)",
           "fir_price": "double", "sir_price": "double"},
          ("period_start", "trading_period", "region"), by_year=False,
          date_col="period_start"),
    # published under the name of the table above, with other columns
    Table("reserve_prices_final",
          {"trading_date": "date", "trading_period": "int", "region": "text(255)",
           "fir_price": "double", "sir_price": "double"},
          ("trading_date", "trading_period", "region"), by_year=False),
)}

# --- Published sources: fixed values ---------------------------------------------
# What a published file is called and which table it feeds.


@dataclass(frozen=True)
class Seed:
    name: str
    pattern: str
    date_type: str
    extension: str
    compression: str = ""
    rename: str | None = None
    table: str | None = None
    match_type: str = "href"


SEEDS: dict[str, Seed] = {s.name: s for s in (
    Seed("WITS_Energy_Offers", "offers", "Daily", ".csv", ".Z", table="energy_offers"),
    Seed("WITS_Generator_Reserve_Offers", "generatorreserves", "Daily", ".csv", ".Z",
         table="generatorreserves_offers"),
    Seed("WITS_IL_Reserve_Offers", "ilreserves", "Daily", ".csv", ".Z",
         table="ilreserves_offers"),
    Seed("WITS_Recent_Nodal_Demand", "DemandDaily", "Daily", ".csv", ".gz",
         table="nodal_demand"),
    Seed("WITS_Historic_Energy_Offers", "offers", "Daily", ".csv", ".Z",
         table="energy_offers"),
    Seed("WITS_Historic_Generator_Reserve_Offers", "generatorreserves", "Daily", ".csv", ".Z",
         table="generatorreserves_offers"),
    Seed("WITS_Historic_IL_Reserve_Offers", "ilreserves", "Daily", ".csv", ".Z",
         table="ilreserves_offers"),
    Seed("WITS_Historic_Nodal_Demand", "DemandDaily", "Daily", ".csv", ".gz",
         table="nodal_demand"),
    Seed("EMI_Final_Prices", "Final_prices", "Monthly", ".csv", rename="Final_pricing",
         table="nodal_prices"),
    Seed("EMI_HVDC_Flows", "HVDC_flows", "Monthly", ".csv", table="hvdc_flows"),
    Seed("EMI_Unit_Generation", "Unit_level_generation", "Monthly", ".csv",
         table="unit_level_generation"),
    Seed("EMI_Embedded_Generation", "Embedded_generation", "Monthly", ".csv",
         table="embedded_generation"),
    Seed("EMI_Grid_Import", "Grid_import", "Monthly", ".csv", table="grid_imports"),
    Seed("EMI_Grid_Export", "Grid_export", "Monthly", ".csv", table="grid_exports"),
    Seed("EMI_GDX_Download", "FP_", "Daily", ".gdx"),
    Seed("EMI_Final_FK_Offers", "Final_FK_offers", "Daily", ".XML",
         table="frequency_keeping_final_offers"),
    Seed("EMI_Final_FK_Dispatch", "FK_offers_dispatched", "Daily", ".XML",
         table="frequency_keeping_final_dispatch"),
    Seed("EMI_Final_Hedge_Disclosure", "Hedge_contracts_report", "Daily", ".pdf"),
    Seed("EMI_Binding_Constraints", "Binding_constraints", "Daily", ".pdf"),
)}
