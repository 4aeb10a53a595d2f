"""URL rules by a sorted sweep over reversed-host keys.

A rule is a host and a start of the path. It fits its host and all subdomains, and
paths that start with its own; the longest fitting rule (host and path together,
then host) decides.

A host read backwards by labels, with "/" and the path behind it, makes a rule's
urls one interval of keys: those that start with the rule's key. A url has one key
for each level of its host, ``com``, ``com.example``, ``com.example.www``; only levels
that some rule names are looked at. Keys and rules are sorted together in ranges.
Intervals of prefixes nest or are apart, so the sweep holds a stack: at a rule, the
rules around it that are still open and the rule itself. For a key the stack at the
last rule before it is what counts, less the rules that have ended, those that do not
start the key. Ranges hand over one row each, their last rule.

Each level of each different host and path goes through the sweep once, however many
rows have it, so a host that holds a third of all rows costs one key per path; equal
keys are no group, and ranges are cut anywhere. All is DataFrame work, no Python.

Defined cases: a null url, or one without ``://``, has an empty host and path and gets
the default verdict, as does a url that no rule fits; a rule with a null host or path
is left out; of repeated rules one is used, the smallest verdict; no rules is fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from halfhourly.llm.common import let
from halfhourly.session import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What lies between the first ``://`` and ``/ ? #``, A-Z lower-cased; then up to ``? #``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _reversed(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), ".")


def _levels(host: Column) -> Column:
    """The host and the domains above it, each read backwards: ``com``, ``com.example`` ..."""
    return let(F.reverse(F.split(host, r"\.")), lambda labels: F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, 1, n), ".")))


def _stacks(rules: DataFrame) -> DataFrame:
    """Each rule's key with the keys of the rules around it, outermost first, itself last.

    A rule's starts are looked up among the rules: as many as its path has characters.
    """
    starts = rules.select("key", "rule", F.explode(F.transform(
        F.sequence(F.length("level") + 1, F.length("key")),
        lambda n: F.substring(F.col("key"), F.lit(1), n))).alias("around"))
    others = rules.select(F.col("key").alias("around"), F.struct(
        F.length("key").alias("size"), F.col("key").alias("key"), F.col("rule").alias("rule"),
        F.col("verdict").alias("verdict")).alias("entry"))
    return (starts.join(others, "around").groupBy("key")
            .agg(F.sort_array(F.collect_list("entry")).alias("stack")))


def _swept(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """(level, path, entry) for the keys that a rule of their level fits: the innermost open rule."""
    events = (keys.select("key", "level", "path", F.lit(None).cast("array<struct<size:int,key:string,rule:string,verdict:string>>").alias("stack"))
              .unionByName(_stacks(rules).select("key", F.lit(None).cast("string").alias("level"),
                                                 F.lit(None).cast("string").alias("path"), "stack")))
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a rule comes before the keys that are equal to it
    events = (events.withColumn("is_key", F.col("stack").isNull())
              .repartitionByRange(n, "key", "is_key", "path").withColumn("range", F.spark_partition_id()))
    rows = staged(events, "sweep")
    last = rows.where(~F.col("is_key")).groupBy("range").agg(F.max_by("stack", "key").alias("last_stack"))
    reached = rows.select("range").distinct().join(last, "range", "left")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    # written, so that its size tells how to join
    handed = staged(reached.select("range", F.last("last_stack", ignorenulls=True).over(before).alias("handed")), "handed")
    sweep = Window.partitionBy("range").orderBy("key", "is_key").rowsBetween(Window.unboundedPreceding, 0)
    seen = rows.withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).where("is_key")
    stack = F.coalesce("open", "handed")
    return (seen.join(handed, "range")
            .select("level", "path", F.try_element_at(F.filter(stack, lambda e: F.col("key").startswith(e["key"])), F.lit(-1))
                    .alias("entry")).where(F.col("entry").isNotNull()))


def judged_urls(pages: DataFrame, rules: DataFrame, keep: list[str], url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """The ``keep`` columns of each page with ``host``, ``path``, ``rule`` (host and path of the
    deciding rule, or null) and ``verdict``. ``rules`` has ``host``, ``path`` and ``verdict``."""
    names = [f"k{i}" for i in range(len(keep))]
    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    urls = pages.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(keep, names)],
                        host.alias("host"), path.alias("path"))
    level = _reversed(F.split("host", r"\."))
    known = (rules.where("host IS NOT NULL AND path IS NOT NULL")
             .select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
             .groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
             .select(level.alias("level"), F.concat(level, F.lit("/"), F.col("path")).alias("key"),
                     F.concat("host", "path").alias("rule"), "verdict"))
    different = urls.select("host", "path").where("host <> ''").distinct()
    probes = different.select("host", "path", F.explode(_levels(F.col("host"))).alias("level"))
    named = known.select("level").distinct()
    probes = probes.join(named, "level", "left_semi")
    keys = (probes.select("level", "path").distinct()
            .withColumn("key", F.concat("level", F.lit("/"), F.col("path"))))
    hits = _swept(keys, known)
    size = F.length(F.col("entry")["rule"])
    best = (probes.join(hits, ["level", "path"]).groupBy("host", "path")
            .agg(F.max_by("entry", F.struct(size, F.length("level"))).alias("entry")))
    return (urls.join(best, ["host", "path"], "left")
            .select(*[F.col(k).alias(c) for c, k in zip(keep, names)], "host", "path",
                    F.col("entry")["rule"].alias("rule"),
                    F.coalesce(F.col("entry")["verdict"], F.lit(default)).alias("verdict")))


#: The rules of the registered query.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]

ORACLE = """
WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                      ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
SELECT page_id, host, path,
       (SELECT max_by(h || p, length(h || p)) FROM r
        WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule,
       coalesce((SELECT max_by(v, length(h || p)) FROM r
                 WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)), 'allow') AS verdict
FROM u
"""
