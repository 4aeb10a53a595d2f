"""Sums of floating numbers that do not depend on the order in which they are added.

Numbers as they are published, below 10^17 and with ten decimal places at most, are added up as decimals: the sum is
the double nearest to the sum of the numbers as they are written. Any other double, tiny or huge,
is cut into whole numbers: a bucket of sixteen powers of two and four digits inside it. Digits of one
bucket are added up as whole numbers, in parts and in any order; the few buckets of a group are
put together at the end, with the sum of its decimals, and rounded once.

NaN counts as missing, as a null does. An infinite value makes the sum infinite, two of both signs make it NaN.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Powers of two in a bucket, bits in each of the three lower digits, and places of a group's
#: whole number that are read before the rest is only told zero from not zero.
_BUCKET, _DIGIT, _ENOUGH = 16, 18, 2 ** 60
_INFINITE, _WRITTEN = 1000, -2000
DECIMAL = "decimal(28,10)"
PARTS = ["bucket", "written", "d0", "d1", "d2", "d3", "n"]
_BIG = "decimal(38,0)"
#: Bits of the lower part of a whole number of ten-thousandths.
_LOW = 20


def is_floating(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DoubleType, T.FloatType))


def present(value: Column) -> Column:
    """A floating value, null where it is NaN."""
    return F.when(~F.isnan(value), value)


def is_written(value: Column) -> Column:
    """Whether a double is the nearest one to a number that decimals hold: of ten places, of four beyond
    900,000, whole beyond 900 billion. Up to those bounds the scaled number is exact in a double."""
    size = F.abs(value)

    def of_places(scale: float) -> Column:
        return F.rint(value * scale) / scale == value

    return F.coalesce(((size < 9e5) & of_places(1e10)) | ((size < 9e11) & of_places(1e4))
                      | ((size < 1e17) & (F.rint(value) == value)), F.lit(False))


def as_written(value: Column) -> Column:
    """A double as the decimal it is written as; null where that is not held."""
    return F.when(is_written(value), value).cast(DECIMAL)


def _two_to(power: Column) -> Column:
    return F.pow(F.lit(2.0), power.cast("double"))


def _then(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``PARTS`` of the column ``_v``, which is no NaN; a null is a zero that does not count.

    Each step is a projection of its own, so it is worked out once and compiled.
    """
    rows = rows.select(*keys, F.col("_v").isNotNull().cast("bigint").alias("n"),
                       F.coalesce("_v", F.lit(0.0)).alias("_v"))
    rows = rows.select(*keys, "n", "_v", as_written(F.col("_v")).alias("written"))
    infinite = F.abs("_v") == F.lit(float("inf"))
    bucket = F.when(F.col("written").isNotNull(), _WRITTEN).when(infinite, F.signum("_v").cast("int") * _INFINITE) \
        .otherwise(F.floor(F.log2(F.abs("_v")) / _BUCKET).cast("int"))
    rows = rows.select(*keys, "n", "_v", "written", bucket.alias("bucket"))
    rows = rows.select(*keys, "n", "written", "bucket", F.signum("_v").alias("_sign"),
                       F.when(F.col("bucket") == _WRITTEN, 0.0).when(infinite, 1.0).otherwise(F.abs("_v")).alias("_r"),
                       F.when(F.abs("bucket") < _INFINITE, _two_to(-F.col("bucket") * (_BUCKET // 2)))
                       .otherwise(1.0).alias("_half"))
    # in two steps, as one factor alone may lie beyond the largest double
    rows = rows.select(*keys, "n", "written", "bucket", "_sign", (F.col("_r") * F.col("_half") * F.col("_half")).alias("_r"))
    names, kept = PARTS[2:6], [*keys, "n", "written", "bucket", "_sign"]
    for i, name in enumerate(names):
        rows = rows.select(*kept, *names[:i], "_r", F.floor("_r").alias(name))
        rows = rows.select(*kept, *names[:i + 1], ((F.col("_r") - F.col(name)) * 2 ** _DIGIT).alias("_r"))
    return rows.select(*keys, "bucket", F.coalesce("written", F.lit(0).cast(DECIMAL)).alias("written"),
                       *[(F.col("_sign").cast("bigint") * F.col(c)).alias(c) for c in names], "n")


def _whole(entry: Column) -> Column:
    """The digits of an entry as one whole number."""
    return sum((entry[f"d{i}"].cast(_BIG) * F.lit(2 ** (_DIGIT * (3 - i))).cast("decimal(17,0)") for i in range(3)),
               entry["d3"].cast(_BIG)).cast(_BIG)


def _total(written: Column, odd: Column) -> Column:
    """The double nearest to a sum of decimals, with the entries of a group's other values."""
    buckets = F.transform(odd, lambda e: e["bucket"])
    up, down = (F.array_contains(buckets, b) for b in (_INFINITE, -_INFINITE))
    return (F.when(F.size(odd) == 0, written.cast("double"))
            .when(up & down, F.lit(float("nan"))).when(up, F.lit(float("inf"))).when(down, F.lit(float("-inf")))
            .otherwise(written.cast("double") + _put_together(odd)))


def _put_together(entries: Column) -> Column:
    """The double nearest to the sum of entries of digits."""
    buckets = F.transform(entries, lambda e: e["bucket"])
    zero = F.lit(0).cast(_BIG)
    base = F.lit(2 ** _BUCKET).cast("decimal(6,0)")

    def carry(state: Column, bucket: Column) -> Column:
        here = F.aggregate(F.filter(entries, lambda e: e["bucket"] == bucket), state["carry"],
                           lambda sum_, e: (sum_ + _whole(e)).cast(_BIG))
        return _then(here, lambda t: _then(F.pmod(t, base), lambda digit: F.struct(
            ((t - digit) / base).cast(_BIG).alias("carry"),
            F.concat(F.array(digit.cast("int")), state["low"]).alias("low"))))

    def bring_down(state: Column, digit: Column) -> Column:
        enough = F.abs(state["top"]) >= F.lit(_ENOUGH).cast(_BIG)
        return F.struct(
            F.when(enough, state["top"]).otherwise((state["top"] * base + digit).cast(_BIG)).alias("top"),
            F.when(enough, state["read"]).otherwise(state["read"] + 1).alias("read"),
            (state["rest"] | (enough & (digit != 0))).alias("rest"))

    carried = F.aggregate(F.sequence(F.array_min(buckets), F.array_max(buckets)),
                          F.struct(zero.alias("carry"), F.array().cast("array<int>").alias("low")), carry)

    def rounded(c: Column) -> Column:
        return _then(F.aggregate(c["low"], F.struct(c["carry"].alias("top"), F.lit(0).alias("read"),
                                                    F.lit(False).alias("rest")), bring_down), result)

    def result(s: Column) -> Column:
        # a last place for "more than this", which only a tie asks for
        value = (s["top"] * 2 + F.when(s["rest"], 1).otherwise(0)).cast(_BIG).cast("double")
        power = (F.array_max(buckets) + 1 - s["read"]) * _BUCKET - 3 * _DIGIT - 1
        half = F.floor(power / 2)
        return value * _two_to(half) * _two_to(power - half)

    return _then(carried, rounded)


def added(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Entries of equal keys and bucket added up; ``rows`` has ``PARTS``."""
    return rows.groupBy(*keys, "bucket").agg(*[F.sum(p).alias(p) for p in PARTS[1:]])


def parts(df: DataFrame, keys: list[str], col: Column | str) -> DataFrame:
    """``keys`` and ``PARTS`` of a column, added up by key and bucket; these add up again, see :func:`added`."""
    value = (F.col(col) if isinstance(col, str) else col).cast("double")
    rows = df.select(*keys, present(value).alias("_v"))
    return added(_digits(rows, keys), keys)


def totals(sums: DataFrame, keys: list[str], alias: str = "total", count: str | None = None) -> DataFrame:
    """``keys``, the rounded sum of their entries and, with a name for it, the number of values in it."""
    # one entry for each bucket, 135 at most
    odd = F.collect_list(F.when(F.col("bucket") != _WRITTEN, F.struct(*PARTS)))
    whole = sums.groupBy(*keys).agg(F.sum("written").alias("_written"), odd.alias("_odd"), F.sum("n").alias("_n"))
    value = F.when(F.col("_n") > 0, _total(F.col("_written"), F.col("_odd")))
    return whole.select(*keys, value.alias(alias), *([F.col("_n").alias(count)] if count else []))


def written_sums(df: DataFrame, keys: list[str], col: Column | str, alias: str) -> DataFrame:
    """``keys``, the sum of a column by ``alias``, ``alias_n`` and ``alias_odd``: how many values are in it, and are no decimals.

    One aggregate without lists of entries; where no value is odd the sum is that of :func:`exact_sums`, else it lacks
    the odd values. Values below 10^8 with four decimal places are added up as whole numbers, in two parts.
    """
    value = (F.col(col) if isinstance(col, str) else col).cast("double")
    rows = df.select(*keys, present(value).alias("_v"))
    scaled = F.rint(F.col("_v") * 1e4)
    short = (F.abs("_v") < 1e8) & (scaled / 1e4 == F.col("_v"))
    rows = rows.select(*keys, "_v", F.when(short, scaled.cast("bigint")).alias("_k"))
    rows = rows.select(*keys, "_v", "_k", F.when(F.col("_k").isNull(), as_written(F.col("_v"))).alias("_w"))
    odd = F.col("_v").isNotNull() & F.col("_k").isNull() & F.col("_w").isNull()
    sums = rows.groupBy(*keys).agg(
        F.sum(F.shiftright("_k", _LOW)).alias("_high"), F.sum(F.col("_k").bitwiseAND(F.lit(2 ** _LOW - 1))).alias("_low"),
        F.sum("_w").alias("_w"), F.count("_v").alias("_n"), F.count_if(odd).alias("_odd"))
    high, low = (F.coalesce(F.col(c), F.lit(0)).cast("decimal(20,0)") for c in ("_high", "_low"))
    whole = (high * F.lit(2 ** _LOW).cast("decimal(7,0)") + low) * F.lit("0.0001").cast("decimal(4,4)")
    total = F.when(F.col("_w").isNull(), whole.cast("double")).otherwise(
        (whole.cast("decimal(37,10)") + F.col("_w").cast("decimal(37,10)")).cast("double"))
    return sums.select(*keys, F.when(F.col("_n") > 0, total).alias(alias), F.col("_n").alias(f"{alias}_n"),
                       F.col("_odd").alias(f"{alias}_odd"))


def exact_sums(df: DataFrame, keys: list[str], columns: Mapping[str, str]) -> DataFrame:
    """``keys`` and the sum of each column by its alias, with ``alias_n``, the number of values in it.

    Rows are dealt by key, column and bucket, so a key with many rows is added up in parts on the way. The sum
    of a key without a value is null.
    """
    names = list(columns.items())
    if len(names) == 1:
        alias, col = names[0]
        return totals(parts(df, keys, col), keys, alias, f"{alias}_n")
    cells = df.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(i).alias("_which"), F.col(c).cast("double").alias("_value")) for i, (_, c) in enumerate(names)])))
    each = totals(parts(cells, [*keys, "_which"], "_value"), [*keys, "_which"], "_total", "_n")
    return each.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_which") == i, F.col(c))).alias(a)
        for i, (alias, _) in enumerate(names) for c, a in (("_total", alias), ("_n", f"{alias}_n"))])
