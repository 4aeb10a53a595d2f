"""Dates, trading periods and dates hidden in names (all plain column expressions)."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, functions as F

from halfhourly.functions.text import _c, base_name, decode_link, squeeze_blanks
from halfhourly.schemas import NORMAL_PERIODS, PERIOD_MINUTES

# Accepted shapes of a date text and how each is read, once its
# separators are dashes.  Year-first stays year-first, everything else is
# day-first; a month that cannot be one is taken as the day, as in "05/14/2014".
DATE_SHAPES = (
    (r"^\d{8}$", ("yyyyMMdd",)),
    (r"^\d{4}-", ("yyyy-M-d",)),
    (r"^\d{1,2}-", ("d-M-yyyy", "M-d-yyyy")),
    (r" [A-Za-z]{3} ", ("d MMM yyyy",)),
    (r" ", ("d MMMM yyyy",)),
)
# the date part of a text, which a time may follow
DATE_PART = (r"^(\d{8}|\d{4}([-/.])\d{1,2}\2\d{1,2}|\d{1,2}([-/.])\d{1,2}\3\d{4}"
             r"|\d{1,2} [A-Za-z]{3,9} \d{4})(?:[ T].*)?$")
_PY_CODES = {"yyyy": "%Y", "MMMM": "%B", "MMM": "%b", "MM": "%m", "dd": "%d", "M": "%m", "d": "%d"}


def day(value) -> dt.date:
    """A date argument (text, ``yyyymmdd`` int, date or datetime) as a date, day first."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    found = re.match(DATE_PART, str(value).strip())
    part = re.sub("[/.]", "-", found.group(1)) if found else ""
    patterns = next((p for shape, p in DATE_SHAPES if re.search(shape, part)), ())
    for pattern in patterns:
        code = re.sub("yyyy|MMMM|MMM|MM|dd|M|d", lambda m: _PY_CODES[m.group()], pattern)
        try:
            return dt.datetime.strptime(part, code).date()
        except ValueError:
            pass
    raise ValueError(f"not a date: {value!r}")


def parse_date(col: Column | str) -> Column:
    """Date from text or a ``yyyymmdd`` number, day first; null when it is no date.

    The shape of the text picks the format, so each row is parsed once.
    """
    part = F.translate(F.regexp_extract(F.trim(_c(col).cast("string")), DATE_PART, 1), "/.", "--")
    parsed = None
    for shape, patterns in DATE_SHAPES:
        value = F.coalesce(*[F.try_to_date(part, p) for p in patterns])
        parsed = F.when(part.rlike(shape), value) if parsed is None \
            else parsed.when(part.rlike(shape), value)
    return parsed


def parse_timestamp(col: Column | str) -> Column:
    """Zone-less timestamp from a date text with an optional ``HH:mm[:ss]`` tail."""
    text = F.trim(_c(col).cast("string"))
    clock = F.regexp_extract(text, r"[ T](\d{1,2}):(\d{2})(?::\d{2})?", 0)
    seconds = (F.coalesce(_digits(clock, r"(\d{1,2}):").cast("int"), F.lit(0)) * 3600
               + F.coalesce(_digits(clock, r":(\d{2})").cast("int"), F.lit(0)) * 60
               + F.coalesce(_digits(clock, r":\d{2}:(\d{2})").cast("int"), F.lit(0)))
    return F.timestamp_add("SECOND", seconds, parse_date(text).cast("timestamp_ntz"))


def trading_timestamp(date: Column | str, period: Column | str,
                      offset: int = PERIOD_MINUTES) -> Column:
    """Time ``offset`` minutes before the end of a trading period (30 = its start).

    Periods 49 and 50 of a clock-change day fold to the first period.
    """
    number = _c(period).cast("int")
    number = F.when(number > NORMAL_PERIODS, 1).otherwise(number)
    return F.timestamp_add("MINUTE", number * PERIOD_MINUTES - F.lit(offset),
                           _c(date).cast("date").cast("timestamp_ntz"))


def trading_timestamp_of_id(trading_id: Column | str, offset: int = PERIOD_MINUTES) -> Column:
    """:func:`trading_timestamp` of a ``yyyymmddpp`` number or text."""
    number = _c(trading_id).cast("bigint")
    date = F.try_to_date(F.floor(number / 100).cast("string"), "yyyyMMdd")
    return trading_timestamp(date, number % 100, offset)


def trading_id(date: Column | str, period: Column | str) -> Column:
    """The ``yyyymmddpp`` number of a trading period."""
    d = _c(date)
    return (F.year(d) * 1000000 + F.month(d) * 10000 + F.dayofmonth(d) * 100
            + _c(period)).cast("bigint")


#: Where trading periods are counted; its clock changes give days of 46 and 50 periods.
MARKET_ZONE = "Pacific/Auckland"


def _utc_midnight(date: Column, zone: str) -> Column:
    """The zone-less UTC time at which a local day begins."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), date.cast("timestamp_ntz"))


def periods_of_day(date: Column | str, zone: str = MARKET_ZONE) -> Column:
    """How many trading periods a local day has: 48, or 46 and 50 when clocks change."""
    d = _c(date).cast("date")
    minutes = F.timestamp_diff("MINUTE", _utc_midnight(d, zone), _utc_midnight(F.date_add(d, 1), zone))
    return (minutes / PERIOD_MINUTES).cast("int")


def period_start_utc(date: Column | str, period: Column | str, zone: str = MARKET_ZONE) -> Column:
    """The zone-less UTC time at which a trading period begins, null beyond the day's last period.

    Periods are counted through the day in the order they pass, so each has a time of its own, on days of 46, 48 and
    50 periods alike; :func:`trading_timestamp` gives the local time instead and folds the last two.
    """
    d, number = _c(date).cast("date"), _c(period).cast("int")
    start = F.timestamp_add("MINUTE", (number - 1) * PERIOD_MINUTES, _utc_midnight(d, zone))
    return F.when(number.between(1, periods_of_day(d, zone)), start)


def period_at_utc(stamp: Column | str, zone: str = MARKET_ZONE) -> Column:
    """Local ``trading_date`` and ``trading_period`` of a zone-less UTC time, as a struct."""
    at = _c(stamp)
    d = F.convert_timezone(F.lit("UTC"), F.lit(zone), at).cast("date")
    minutes = F.timestamp_diff("MINUTE", _utc_midnight(d, zone), at)
    return F.struct(d.alias("trading_date"), (F.floor(minutes / PERIOD_MINUTES) + 1).cast("int").alias("trading_period"))


def utc_instant(stamp: Column | str) -> Column:
    """A zone-less timestamp as an instant, whatever the session zone.

    Event times of streams have to be instants.
    """
    return F.timestamp_seconds(F.timestamp_diff("SECOND", _epoch(), _c(stamp)))


def utc_stamp(instant: Column | str) -> Column:
    """The reverse of :func:`utc_instant`."""
    return F.timestamp_add("SECOND", F.unix_seconds(_c(instant)), _epoch())


def period_of(stamp: Column | str) -> Column:
    """Trading period (1..48) a timestamp falls into."""
    ts = _c(stamp)
    return (F.hour(ts) * 2 + F.when(F.minute(ts) >= PERIOD_MINUTES, 1).otherwise(0) + 1).cast("int")


def format_day(col: Column | str, pattern: str = "dd-MM-yyyy") -> Column:
    return F.date_format(_c(col), pattern)


def join_days(days: Column | str, separator: str = "','", pattern: str = "dd-MM-yyyy") -> Column:
    """An array of dates as one text."""
    return F.array_join(F.transform(_c(days), lambda d: F.date_format(d, pattern)), separator)


def file_year(name: Column | str) -> Column:
    """Year text from the first digit run (``yyyy``, ``yyyymm`` or ``yyyymmdd``) of a name."""
    run = F.regexp_extract(base_name(name), r"(\d+)", 1)
    length = F.length(run)
    year = run.substr(1, 4)
    return (F.when(length == 4, run)
            .when((length == 6) & F.try_to_date(run, "yyyyMM").isNotNull(), year)
            .when((length == 8) & F.try_to_date(run, "yyyyMMdd").isNotNull(), year))


def file_date_digits(name: Column | str, pattern: str, ext: str,
                     rename: str | None = None) -> Column:
    """The 4, 6 or 8 digits next to the source's name, present or former, in a file name or link.

    Null for a name of another form.  A price case (``.gdx``) may say after its date that it
    is final and which revision it is; an interim one has no such form.
    """
    source = "|".join(re.escape(n) for n in (pattern, rename) if n)
    status = "x?(?:_?F)?[ab]?" if ext == ".gdx" else ""
    form = (rf"^_*(?:{source})?_*([0-9]{{8}}|[0-9]{{6}}|[0-9]{{4}})_*(?:{source})?{status}_*"
            rf"(?:\.csv)?(?i:{re.escape(ext)})?$")
    return _digits(base_name(decode_link(name)), form)


def days_of_file(name: Column | str, pattern: str, ext: str, rename: str | None = None,
                 date_type: str = "Daily") -> Column:
    """Array of the days a file stands for: none when its name holds no date.

    ``Daily`` takes day files (one day) and month files (each day of the month),
    ``Monthly`` and ``Yearly`` give the first day.
    """
    if date_type not in ("Daily", "Monthly", "Yearly"):
        raise ValueError(f"date type {date_type!r}: use Daily, Monthly or Yearly")

    def days(digits: Column) -> Column:
        if date_type == "Daily":
            month = F.try_to_date(digits, "yyyyMM")
            found = (F.when(F.length(digits) == 6, F.sequence(month, F.last_day(month)))
                     .when(F.length(digits) == 8, F.array(F.try_to_date(digits, "yyyyMMdd"))))
        else:
            fmt = "yyyyMM" if date_type == "Monthly" else "yyyy"
            found = F.when(F.length(digits) == len(fmt), F.array(F.try_to_date(digits, fmt)))
        return F.coalesce(F.array_compact(found), F.array().cast("array<date>"))

    # the digits are worked out once, however often they are used
    return F.get(F.transform(F.array(file_date_digits(name, pattern, ext, rename)), days), F.lit(0))


def link_text_date(text: Column | str) -> Column:
    """Date of a link text such as ``1  January 2014``."""
    clean = squeeze_blanks(text)
    return F.when(clean.rlike(r"^\d{1,2} [A-Za-z]+ \d{4}$"),
                  F.try_to_date(clean, "d MMMM yyyy"))


def summary_page_date(name: Column | str) -> Column:
    """Date in the name of a daily futures page: six digits ``yymmdd`` after ``Summary``."""
    digits = F.regexp_extract(base_name(name), r"^[^.]*?Summary(\d{6})", 1)
    return F.when(digits != "", F.try_to_date(F.concat(F.lit("20"), digits), "yyyyMMdd"))


def summary_page_name(date: Column | str, head: str = "EODWebMarketSummary",
                      tail: str = "ZFT") -> Column:
    """The name of the daily futures page of a date."""
    return F.concat(F.lit(head), F.date_format(_c(date), "yyMMdd"), F.lit(tail + ".htm"))


def clock_text(col: Column | str) -> Column:
    """Local time such as ``1:30 PM`` or ``13:30`` as ``HH:mm``."""
    text = F.upper(squeeze_blanks(col))
    twelve = r"^\d{1,2}:\d{2} [AP]M$"
    return (F.when(text.rlike(twelve),
                   F.date_format(F.try_to_timestamp(text, F.lit("h:mm a")), "HH:mm"))
            .when(text.rlike(r"^\d{1,2}:\d{2}(:\d{2})?$"),
                  F.date_format(F.try_to_timestamp(text.substr(F.lit(1), F.locate(":", text) + 2),
                                                   F.lit("H:mm")), "HH:mm")))


def expiry_label(date: Column | str, frequency: Column | str) -> Column:
    """First day of the quarter (Q), month (M) or year (A) an expiry falls into."""
    d = _c(date)
    f = F.lit(frequency) if isinstance(frequency, str) and frequency in ("Q", "M", "A") \
        else _c(frequency)
    return (F.when(f == "Q", F.trunc(d, "quarter")).when(f == "M", F.trunc(d, "month"))
            .when(f == "A", F.trunc(d, "year")))


def is_weekday(col: Column | str) -> Column:
    return F.weekday(_c(col)) < 5


def _digits(text: Column, regex: str) -> Column:
    return F.nullif(F.regexp_extract(text, regex, 1), F.lit(""))


def _epoch() -> Column:
    return F.lit(dt.date(1970, 1, 1)).cast("timestamp_ntz")
