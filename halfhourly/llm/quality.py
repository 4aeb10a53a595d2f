"""Line-first cleaning: rules judge each line, failing lines go, and a text that loses too much is rejected.

A line with a word fails when
  punctuation  it does not end in a closing mark, or over a tenth of its words end in "!!" or "??";
  navigation   it holds three or more menu separators, or is nothing but a menu word;
  symbols      over a tenth of its characters in words are symbols ``#*$%&|<>``;
  boilerplate  it holds a stock phrase of web pages, or equals an earlier line of the text.
Lines without a word stay and count for nothing. A text is kept when it passes the
base rules (at least ``min_words`` words, at most ``max_repeat_percent`` of them in
repeated windows) and the failing lines hold at most ``max_lost_percent`` of its
characters in words.

Everything is one expression over the row: no shuffle, no Python. Windows of words are
compared by 64-bit hashes of the words' hashes; the sort that finds repeated ones is
only made where a text has any, and costs n log n whatever repeats how often.

Defined cases: a null text has no words and lines and is rejected; so is an empty one.
Repeated rows are judged alike, a null id is passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from halfhourly.llm.common import fresh, let

WORD_GAP = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
CLOSED = r"[.!?:;…。！？।॥؟۔؛։።။។།][\"'”’»)\]]*[\x20\x09-\x0D]*\z"
SHOUTS = r"(!!|\?\?)[\x20\x09-\x0D]|(!!|\?\?)\z"
SEPARATORS = r"[|»›•·→]"
MENU = r"(?i)^[\x20\x09-\x0D]*(home|menu|next|previous|back to top|log ?in|sign (in|up)|skip to content|search|contact( us)?)[\x20\x09-\x0D.]*\z"
STOCK = (r"(?i)(cookie policy|privacy policy|terms of (use|service)|all rights reserved"
         r"|enable javascript|javascript is (disabled|required)|lorem ipsum|subscribe to our"
         r"|sign up for|click here|share this|powered by)")

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW, MAX_LOST_PERCENT = 20, 30, 8, 50


def _long(value: Column) -> Column:
    return value.cast("long")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _repeat_words(words: Column, window: int) -> Column:
    """How many words lie in windows that the text has twice or more."""

    def covered(keys: Column) -> Column:
        def spans(order: Column) -> Column:
            twice = F.filter(order, lambda x, i: (F.get(order, i - 1)["key"] == x["key"])
                             | (F.get(order, i + 1)["key"] == x["key"]))
            places = F.sort_array(F.transform(twice, lambda x: x["at"]))
            return let(places, lambda p: _total(F.transform(
                p, lambda x, i: _long(F.least(F.lit(window), F.coalesce(F.get(p, i + 1), x + window) - x)))))

        order = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("key"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0).cast("long")) \
            .otherwise(let(order, spans))

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - (window - 1))
        return let(F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, window))), covered)

    return F.when(F.size(words) <= window, F.lit(0).cast("long")).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), windows))


def _word_chars(text: Column) -> Column:
    return _long(F.length(F.regexp_replace(text, WORD_GAP, "")))


def line_passes(line: Column) -> Column:
    """Whether a line with a word passes the rules that need no other line."""
    words = F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+"))
    return (line.rlike(CLOSED)
            & (F.regexp_count(line, F.lit(SHOUTS)) * 10 <= words)
            & (F.regexp_count(line, F.lit(SEPARATORS)) < 3)
            & ~line.rlike(MENU)
            & (F.regexp_count(line, F.lit(SYMBOLS)) * 10 <= _word_chars(line))
            & ~line.rlike(STOCK))


def _judged(lines: Column, n_dup: Column) -> Column:
    """The lines in order, each with whether it has a word, and passes."""

    def first_of_its_kind(order: Column) -> Column:
        return F.transform(F.sort_array(F.transform(
            order, lambda x, i: F.struct(
                x["at"].alias("at"), x["line"].alias("line"),
                F.coalesce(F.get(order, i - 1)["line"] == x["line"], F.lit(False)).alias("again")))),
            lambda x: F.struct(x["line"].alias("line"), x["again"].alias("again")))

    plain = F.transform(lines, lambda x: F.struct(x.alias("line"), F.lit(False).alias("again")))
    sorted_lines = F.sort_array(F.transform(lines, lambda x, i: F.struct(x.alias("line"), i.alias("at"))))
    marked = F.when(n_dup == 0, plain).otherwise(let(sorted_lines, first_of_its_kind))
    return F.transform(marked, lambda x: F.struct(
        x["line"].alias("line"),
        (~x["line"].rlike(HAS_WORD) | (~x["again"] & line_passes(x["line"]))).alias("passes")))


def judged_texts(docs: DataFrame, text_col: str = "text", result: str = "judged",
                 min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
                 window: int = WINDOW, max_lost_percent: int = MAX_LOST_PERCENT,
                 with_text: bool = True) -> DataFrame:
    """``docs`` with a struct ``result``: counts, ``base_failed``, ``lost_chars``, ``kept`` and,
    if asked for, ``text`` without its failing lines."""

    def counted(words: Column, lines: Column, text: Column) -> Column:
        n_words = _long(F.size(words))
        return F.struct(
            n_words.alias("n_words"),
            _total(F.transform(words, lambda w: _long(F.length(w)))).alias("word_chars"),
            _long(F.regexp_count(text, F.lit(SYMBOLS))).alias("n_symbols"),
            _long(F.size(F.filter(lines, lambda x: x.rlike(HAS_WORD)))
                  - F.size(F.array_distinct(F.filter(lines, lambda x: x.rlike(HAS_WORD))))).alias("n_dup_lines"),
            _repeat_words(words, window).alias("n_repeat_words"))

    def verdict(n: Column, lines: Column) -> Column:
        failed = (n["n_words"] < min_words) | (100 * n["n_repeat_words"] > max_repeat_percent * n["n_words"])

        def with_lines(judged: Column) -> Column:
            lost = _total(F.transform(F.filter(judged, lambda x: ~x["passes"]),
                                      lambda x: _word_chars(x["line"])))
            text = [F.array_join(F.transform(F.filter(judged, lambda x: x["passes"]),
                                             lambda x: x["line"]), "\n").alias("text")] if with_text else []
            return let(lost, lambda gone: F.struct(
                *[n[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                failed.alias("base_failed"), gone.alias("lost_chars"),
                (~failed & (100 * gone <= max_lost_percent * n["word_chars"])).alias("kept"), *text))

        return let(_judged(lines, n["n_dup_lines"]), with_lines)

    def of(text: Column) -> Column:
        words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
        return let(F.split(text, "\n"), lambda lines: let(
            let(words, lambda w: counted(w, lines, text)), lambda n: verdict(n, lines)))

    return docs.withColumn(result, let(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), of))


def clean(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", **rules) -> DataFrame:
    """The kept documents with their failing lines removed, same columns.

    ``length_col``, if ``docs`` has it, follows the new text.
    """
    mark, kept = fresh(docs, "judged"), fresh(docs, "kept_text")
    judged = judged_texts(docs, text_col, mark, **rules)
    # a row for each kept text: a condition of its own would judge the text a second time
    rows = judged.select(*[F.col(f"`{c}`") for c in docs.columns],
                         F.explode(F.filter(F.array(mark), lambda j: j["kept"])).alias(mark)) \
        .withColumn(kept, F.col(mark)["text"])
    new = {text_col: F.col(kept)}
    if length_col in docs.columns:
        new[length_col] = F.length(kept).cast(docs.schema[length_col].dataType)
    return rows.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


#: DuckDB SQL of the registered query, with the default rules.
ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '{WORD_GAP}'), lambda x: x <> '') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{HAS_WORD}')) AS lines FROM d),
keys AS (SELECT r, i, array_to_string(words[i:i + 7], ' ') AS k
         FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM keys) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r),
ln AS (SELECT r, unnest(lines) AS x, unnest(range(1, len(lines) + 1)) AS i FROM w),
bad AS (SELECT r, sum(length(regexp_replace(x, '{WORD_GAP}', '', 'g'))) AS lost FROM (
          SELECT r, x, row_number() OVER (PARTITION BY r, x ORDER BY i) > 1 AS again FROM ln)
        WHERE again OR NOT regexp_matches(x, '{CLOSED.replace("'", "''")}')
           OR len(regexp_extract_all(x, '{SHOUTS}')) * 10 > len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))
           OR len(regexp_extract_all(x, '{SEPARATORS}')) >= 3
           OR regexp_matches(x, '{MENU}') OR regexp_matches(x, '{STOCK}')
           OR len(regexp_extract_all(x, '{SYMBOLS}')) * 10 > length(regexp_replace(x, '{WORD_GAP}', '', 'g'))
        GROUP BY r),
base AS (SELECT w.r, doc_id, len(words)::BIGINT AS n_words,
                coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
                len(regexp_extract_all(t, '{SYMBOLS}'))::BIGINT AS n_symbols,
                (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS lost_chars
         FROM w LEFT JOIN covered ON covered.r = w.r LEFT JOIN bad ON bad.r = w.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed, lost_chars,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
           AND 100 * lost_chars <= 50 * word_chars AS kept
FROM base
"""
