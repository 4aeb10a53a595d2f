"""The text operators over their whole given tables, as registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from halfhourly.llm import decontamination, language, licenses, packing, prefixtrie, quality, repair, secrets, sharding, simhash, tokencounts, toxicity, urls
from halfhourly.llm.common import table

TOKENIZER, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query under a name, with the SQL of the same result if there is one."""

    def add(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return add


def tokenizer_path(name: str = TOKENIZER) -> str:
    """The vocabulary file of the registered queries; the operator takes any path."""
    import public_tokenizers
    return public_tokenizers.path(name)


def crc32_sql(text: str) -> str:
    """DuckDB's expression for the CRC-32 of an ASCII string, bit by bit."""
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 " \
           "THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    codes = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {step}), 4294967295)"


@query("op1_secret_scans")
def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans and findings of the randomness battery in every document."""
    docs = table(spark, sf_dir, "documents")
    found = secrets.found_secrets(docs, ["doc_id"], secrets.fit(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"),
                        "spans", "n_random")


@query("op2_packing")
def sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path(), ["doc_id"])


@query("op3_quality_rules", quality.ORACLE)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the line-first verdict for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judged_texts(docs, with_text=False)
    return judged.select("doc_id", *[F.col("judged")[c].alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "lost_chars", "kept")])


@query("op4_url_filters", urls.ORACLE)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page."""
    rules = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict"))
        for h, p, v in urls.RULES])))
    return urls.judged_urls(table(spark, sf_dir, "pages"), rules, ["page_id"])


@query("op5_license_scans")
def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence statement in the documents, with its place and differences in wording."""
    return licenses.found_licenses(table(spark, sf_dir, "documents"), ["doc_id"])


@query("op6_language_id")
def language_of_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a model of those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return language.predicted(docs, language.fit(docs))


@query("op7_sharding")
def balanced_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal numbers of rows; equal texts are drawn together."""
    return (sharding.sharded_by_text(table(spark, sf_dir, "documents"), ["doc_id"], n_shards=16)
            .withColumn("grown_shard", F.lit(None).cast("int")))


@query("op8_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that its tiles cover."""
    return decontamination.contained_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])


@query("op9_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's fingerprint and the smallest doc_id it reaches by links of two bits."""
    docs = table(spark, sf_dir, "documents")
    return simhash.simhash_components(docs, shingle=3, max_bits=2).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id", "n_links")


@query("op10_toxicity")
def toxic_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How likely each document is toxic, by a model of the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query("op12_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it has more than 4096 tokens."""
    return tokencounts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(PIECES), ["doc_id"])


_REPAIR_SQL = f"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("concat_ws(':', coalesce(conv_id::VARCHAR, ' '), coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
  FROM conversations),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM raw WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place FROM hurt),
judged AS (
  SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS initial,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN min(place) OVER (PARTITION BY conv_id, role, text) < place THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) AS n,
         count(*) FILTER (place > 1 AND before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
moves(state, edit, initial, next) AS (VALUES
  (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (3, 'K', 'u', 2), (2, 'K', 'a', 3),
  (0, 'R', '', 2), (1, 'R', '', 2), (3, 'R', '', 2), (2, 'R', '', 3),
  (0, 'D', '', 0), (1, 'D', '', 1), (2, 'D', '', 2), (3, 'D', '', 3)),
inserts(state, edits, next, lines) AS (VALUES
  (0, '', 0, []::VARCHAR[]), (1, '', 1, []), (2, '', 2, []), (3, '', 3, []),
  (0, 'I', 2, ['user:']), (1, 'I', 2, ['user:']), (3, 'I', 2, ['user:']), (2, 'I', 3, ['assistant:']),
  (0, 'II', 3, ['user:', 'assistant:']), (1, 'II', 3, ['user:', 'assistant:']),
  (3, 'II', 3, ['user:', 'assistant:']), (2, 'II', 2, ['assistant:', 'user:'])),
walk AS (
  SELECT conv_id, 0::BIGINT AS place, i.next AS state,
         {{'cost': 5 * length(i.edits), 'audit': i.edits, 'lines': i.lines}} AS best
  FROM counts, inserts i WHERE i.state = 0
  UNION ALL
  SELECT w.conv_id, w.place + 1, i.next, min({{
      'cost': w.best.cost + CASE m.edit WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
              + CASE WHEN m.edit <> 'D' AND j.fault = 'truncated' THEN 5 ELSE 0 END + 5 * length(i.edits),
      'audit': w.best.audit || m.edit || i.edits,
      'lines': w.best.lines || CASE m.edit WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [j.role || ':' || j.text]
               ELSE [CASE m.next WHEN 2 THEN 'user:' ELSE 'assistant:' END || j.text] END || i.lines}})
  FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.place = w.place + 1
  JOIN moves m ON m.state = w.state AND (m.edit = 'D' OR j.fault IN ('', 'truncated')
       AND (m.edit = 'R' OR m.initial = j.initial))
  JOIN inserts i ON i.state = m.next
  GROUP BY w.conv_id, w.place, i.next),
ends AS (
  SELECT w.conv_id, min(w.best) AS best FROM walk w
  JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.place WHERE w.state IN (0, 3) GROUP BY w.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(e.best.cost, 0)::BIGINT AS cost, coalesce(e.best.audit, '') AS audit,
       sha256(coalesce(array_to_string(e.best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@query("op11_conversation_repair", _REPAIR_SQL)
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and the cheapest repair of every conversation, after damage by a fixed rule."""
    turns = table(spark, sf_dir, "conversations")
    found = repair.repaired_conversations(repair.damaged(turns))
    every = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_rows"))
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c)
              for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (every.alias("o").join(found.alias("f"), F.col("o.conv_id").eqNullSafe(F.col("f.conv_id")), "left")
            .select("o.conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


_TRIE_SQL = f"""
WITH placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
known AS (
  SELECT conv_id, place, dense_rank() OVER (ORDER BY role, text) AS id,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM placed),
sizes AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, count(*) AS n, {crc32_sql("conv_id::VARCHAR")} % 4 AS h
  FROM known GROUP BY conv_id),
rebuilt AS (
  SELECT s.conv_id, 0 AS source, k.place, k.id FROM sizes s JOIN known k ON k.conv_id = s.base AND k.place < s.h
  UNION ALL
  SELECT s.conv_id, 1, k.place, k.id FROM sizes s JOIN known k ON k.conv_id = s.conv_id AND k.place >= s.h),
sequences AS (
  SELECT s.conv_id, coalesce(list(r.id ORDER BY r.source, r.place) FILTER (r.id IS NOT NULL), []) AS seq
  FROM sizes s LEFT JOIN rebuilt r ON r.conv_id = s.conv_id GROUP BY s.conv_id),
steps AS (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS depth FROM sequences),
nodes AS (
  SELECT seq[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(seq) = depth), '') AS ids
  FROM steps GROUP BY 1, 2),
children AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
words AS (SELECT id, any_value(words) AS words FROM known GROUP BY id),
own AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children, (n.n_convs - 1) * coalesce(w.words, 0) AS saved
  FROM nodes n LEFT JOIN children c ON c.prefix = n.prefix LEFT JOIN words w ON w.id = n.prefix[n.depth]),
above AS (SELECT prefix, n_children, saved, unnest(range(0, depth + 1)) AS d FROM own),
sums AS (
  SELECT prefix[1:d] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM above GROUP BY 1)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, sha256(o.ids) AS ends_sha256
FROM own o JOIN sums s ON s.prefix = o.prefix
LEFT JOIN nodes p ON p.depth = o.depth - 1 AND p.prefix = o.prefix[1:o.depth - 1]
"""


@query("op13_prefix_trie", _TRIE_SQL)
def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prefix of the conversations, which are first given shared beginnings by a fixed rule."""
    placed = prefixtrie.placed_turns(table(spark, sf_dir, "conversations"))
    nodes = prefixtrie.prefix_nodes(*prefixtrie.shared_starts(placed))
    return nodes.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"),
                        "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
                        F.col("ends").alias("ends_sha256"))
