"""The configuration of published sources as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from halfhourly.schemas import SEEDS

_FIELDS = ("pattern", "url", "base_url", "file_location", "date_type", "match_type", "extension",
           "cextension", "rename")


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """The sources in a JSON configuration: each entry with a pattern, one row per source.

    Other entries (folders, databases) are passed over.
    """
    entries = spark.read.text(path, wholetext=True).select(F.explode(
        F.from_json("value", "map<string,string>")).alias("name", "entry"))
    fields = F.from_json("entry", ", ".join(f"{f} string" for f in _FIELDS))
    seeds = entries.where(F.col("entry").startswith("{")).select("name", fields.alias("s"))
    return seeds.where(F.col("s.pattern").isNotNull()).select("name", "s.*")


def known_seeds(spark: SparkSession) -> DataFrame:
    """The sources the library knows, with the table each one feeds."""
    return spark.createDataFrame(
        [(s.name, s.pattern, s.date_type, s.match_type, s.extension, s.compression, s.rename, s.table)
         for s in SEEDS.values()],
        "name string, pattern string, date_type string, match_type string, extension string, "
        "cextension string, rename string, table string")
