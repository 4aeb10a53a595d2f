"""Days as bits: which days a key holds, in words of 64 days, merged by OR; missing days by AND NOT.

A stored table has a row per key and word. Loads append the bits of their own days; nothing is compared
or read for that, and the same bits twice are the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from halfhourly.functions.dates import day

_WORD = 64


def _number(date: Column) -> Column:
    return F.unix_date(date)


def _word(number: Column) -> Column:
    return F.floor(number / _WORD).cast("int")


def day_bits(df: DataFrame, keys: list[str], date_col: str = "trading_date") -> DataFrame:
    """``keys``, ``word`` and ``bits`` of the days of a table; each task reduces its rows first."""
    number = _number(F.col(date_col))
    rows = df.where(F.col(date_col).isNotNull()).select(*keys, number.alias("_n"))
    return rows.groupBy(*keys, _word(F.col("_n")).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(_n, {_WORD}) AS INT))")).alias("bits"))


def merged_bits(bits: DataFrame, keys: list[str]) -> DataFrame:
    return bits.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))


def add_bits(bits: DataFrame, path: str) -> None:
    """Adds the bits of further rows to a stored table of them."""
    bits.write.mode("append").parquet(path)


def read_bits(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    return merged_bits(spark.read.parquet(path), keys)


def held_days(bits: DataFrame, keys: list[str]) -> DataFrame:
    """How many days each key holds."""
    return merged_bits(bits, keys).groupBy(*keys).agg(F.sum(F.bit_count("bits")).cast("bigint").alias("n_days"))


def days_missing(bits: DataFrame, keys: list[str], begin, end, day_col: str = "trading_date") -> DataFrame:
    """For each key, the days of a range that it does not hold.

    A key's words of the range, one for 64 days, are compared with the range as bits.
    """
    first, last = day(begin), day(end)
    epoch = day("1970-01-01")
    a, b = (first - epoch).days, (last - epoch).days
    near = merged_bits(bits.select(*keys, "word", F.when(F.col("word").between(a // _WORD, b // _WORD), F.col("bits"))
                                   .otherwise(0).cast("bigint").alias("bits")), keys)
    entry = F.when(F.col("bits") != 0, F.struct("word", "bits"))
    held = near.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("_held"))
    everything = (1 << _WORD) - 1
    masks = []
    for word in range(a // _WORD, b // _WORD + 1):
        low, high = max(a - word * _WORD, 0), min(b - word * _WORD, _WORD - 1)
        mask = (everything << low) & (everything >> (_WORD - 1 - high)) & everything
        masks.append(F.struct(F.lit(word).alias("word"), F.lit(mask - (1 << _WORD) if mask >> 63 else mask)
                              .cast("bigint").alias("wanted")))
    words = held.select(*keys, "_held", F.inline(F.array(*masks)))
    known = F.coalesce(F.try_element_at("_held", F.col("word")), F.lit(0).cast("bigint"))
    missing = words.select(*keys, "word", F.col("wanted").bitwiseAND(F.bitwise_not(known)).alias("_bits")).where("_bits <> 0")
    bit = F.explode(F.filter(F.sequence(F.lit(0), F.lit(_WORD - 1)),
                             lambda i: F.getbit("_bits", i) == 1)).alias("_bit")
    return missing.select(*keys, "word", bit).select(
        *keys, F.date_from_unix_date(F.col("word") * _WORD + F.col("_bit")).alias(day_col))
