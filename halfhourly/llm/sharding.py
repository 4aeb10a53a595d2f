"""Balanced label propagation: linked rows move towards their neighbours' shards under quotas.

A link is a set of rows that belong together, such as the rows with one text; an edge of
a graph is a link of two. Rows start in the shard of their hash. In each round every
link names the two shards that hold most of its rows, and a row wants to go where most of its
neighbours are, itself not counted. Half of the rows, by a hash, are awake in a round, so
that two rows do not swap for ever. Wishes per pair of shards, at most shards squared numbers, are gathered;
opposite wishes cancel out, and beyond them a shard takes linked rows up to its capacity
(rows without links can make room at no cost).
A pair that has more wishes than quota grants them by a hash of the row. Rounds end
when nothing moves, or after ``rounds``.

At last sizes are made even: rows beyond a shard's share, those without links first and then
link by link, the largest first, fill the shards that lack some. Numbers of rows then differ by one at most.

A link of any size is counted per shard before it is shuffled and meets its rows in a
join that may be split; it is never gathered. A link too large for one shard is dealt
over several by the quotas.

Defined cases: a null text counts as the empty one and links with it; repeated rows are rows of their
own and belong together like any equal texts; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from halfhourly.llm.common import numbered
from halfhourly.session import staged

ROUNDS, SLACK = 8, 0.05


def _quotas(wishes: dict[tuple[int, int], int], held: dict[int, int], capacity: float) -> dict[tuple[int, int], float]:
    """The share of the wishes for each (from, to) that is granted."""
    even = {pair: min(n, wishes.get(pair[::-1], 0)) for pair, n in wishes.items()}
    more: dict[int, int] = {}
    for pair, n in wishes.items():
        more[pair[1]] = more.get(pair[1], 0) + n - even[pair]
    shares = {}
    for pair, n in wishes.items():
        room = max(0.0, capacity - held.get(pair[1], 0))
        extra = (n - even[pair]) * min(1.0, room / more[pair[1]]) if more[pair[1]] else 0.0
        shares[pair] = (even[pair] + extra) / n
    return shares


def _shared(links: DataFrame) -> DataFrame:
    """The links of two rows and more, with their number of rows ``n``."""
    return staged(links.groupBy("link").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")


def propagated(rows: DataFrame, links: DataFrame, n_shards: int, rounds: int = ROUNDS,
               slack: float = SLACK) -> DataFrame:
    """(row, shard) for ``rows`` (row) linked by ``links`` (row, link), sizes held within ``slack``."""
    start = F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("int")
    # what joins the links is written first: a join of two plain shuffles is one Spark can split
    links = staged(links.join(_shared(links), "link").select("row", "link"), "links")
    labels = rows.select("row", start.alias("shard"))
    capacity = (1 + slack) * rows.count() / n_shards
    linked = staged(links.select("row").distinct().select("row", start.alias("shard")), "labels")
    for k in range(rounds):
        held = {r.shard: r.n for r in linked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        placed = links.join(linked, "row")
        counts = placed.groupBy("link", "shard").agg(F.count(F.lit(1)).alias("n"))
        order = F.pmod(F.xxhash64("link") + F.col("shard"), F.lit(n_shards))
        # of a link's shards, one entry each, the two with most rows
        votes = staged(counts.groupBy("link").agg(F.slice(F.sort_array(F.collect_list(
            F.struct(F.col("n"), order.alias("order"), F.col("shard").alias("to"))), asc=False), 1, 2).alias("votes")), "votes")
        asked = (placed.join(votes, "link").select("row", "shard", F.explode("votes").alias("vote"))
                 .groupBy("row", "shard", F.col("vote.to").alias("to"))
                 .agg(F.sum(F.col("vote.n") - (F.col("vote.to") == F.col("shard")).cast("int")).alias("weight"))
                 .groupBy("row", "shard").agg(F.max_by("to", F.struct(
                     F.col("weight"), F.col("to") == F.col("shard"), F.xxhash64("row", "to"))).alias("to")))
        awake = F.pmod(F.xxhash64("row", F.lit(-1 - k)), F.lit(2)) == 0
        wanted = staged(asked.withColumn("awake", awake), "wishes")
        wishes = {(r.shard, r.to): r.n for r in wanted.where("shard <> to").groupBy("shard", "to")
                  .agg(F.count_if("awake").alias("n")).collect()}
        if not wishes:
            break
        shares = _quotas({pair: n for pair, n in wishes.items() if n}, held, capacity)
        share = F.element_at(F.create_map(F.lit(""), F.lit(0.0), *[
            x for (a, b), s in shares.items() for x in (F.lit(f"{a}>{b}"), F.lit(s))]), F.concat_ws(">", "shard", "to"))
        draw = F.pmod(F.xxhash64("row", F.lit(k)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        moves = F.col("awake") & (F.col("shard") != F.col("to")) & (draw < share)
        linked = staged(wanted.select("row", F.when(moves, F.col("to")).otherwise(F.col("shard")).alias("shard")),
                        "labels")
    moved = linked.select("row", F.col("shard").alias("new"))
    return labels.join(moved, "row", "left").select("row", F.coalesce("new", "shard").alias("shard"))


def evened(placed: DataFrame, n_shards: int) -> DataFrame:
    """``placed`` (row, shard, link and its number of rows ``n``, or nulls) with numbers of rows at
    most one apart, and a gapless ``slot``."""
    ordered = placed.select("row", "shard", F.col("link").isNotNull().alias("linked"),
                            (-F.coalesce("n", F.lit(0))).alias("size"), F.coalesce("link", F.lit("")).alias("link"))
    ranked = staged(numbered(ordered, ["shard"], ["linked", "size", "link", "row"], "place", "ranked"), "places")
    held = {r.shard: r.n for r in ranked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(held.values())
    share = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    over = [max(0, held.get(s, 0) - share[s]) for s in range(n_shards)]
    lack = [max(0, share[s] - held.get(s, 0)) for s in range(n_shards)]
    over_before = [sum(over[:s]) for s in range(n_shards)]
    lack_before = [sum(lack[:s]) for s in range(n_shards)]

    def of_shard(values: list[int], shard):
        return F.array(*[F.lit(v).cast("long") for v in values])[shard]

    leaves = F.col("place") < of_shard(over, F.col("shard"))
    spare = of_shard(over_before, F.col("shard")) + F.col("place")
    target = sum((F.when(spare >= lack_before[s] + lack[s], 1).otherwise(0) for s in range(n_shards)), F.lit(0))
    moved = ranked.withColumn("leaves", leaves).withColumn("spare", spare).withColumn("to", target)
    stayed = [held.get(s, 0) - over[s] for s in range(n_shards)]
    return moved.select(
        "row", F.when(F.col("leaves"), F.col("to")).otherwise(F.col("shard")).cast("int").alias("shard"),
        F.when(F.col("leaves"), of_shard(stayed, F.col("to")) + F.col("spare") - of_shard(lack_before, F.col("to")))
        .otherwise(F.col("place") - of_shard(over, F.col("shard"))).cast("long").alias("slot"))


def sharded_by_text(docs: DataFrame, keep: list[str], text_col: str = "text", n_shards: int = 16,
                    rounds: int = ROUNDS, slack: float = SLACK) -> DataFrame:
    """The ``keep`` columns, ``size`` (bytes of the text and one), ``text_crc32``, ``law`` (rows),
    ``shard`` and ``slot`` of each row; rows with equal texts are linked."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    names = [f"k{i}" for i in range(len(keep))]
    rows = staged(docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(keep, names)],
                              (F.octet_length(text).cast("long") + 1).alias("size"),
                              F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("link"),
                              F.monotonically_increasing_id().alias("row")), "rows")
    shards = propagated(rows, rows.select("row", "link"), n_shards, rounds, slack)
    known = rows.select("row", "link").join(_shared(rows), "link")
    placed = shards.join(known, "row", "left").select("row", "shard", "link", "n")
    done = evened(placed, n_shards)
    return rows.join(done, "row").select(
        *[F.col(k).alias(c) for c, k in zip(keep, names)], "size", "text_crc32",
        F.lit("rows").alias("law"), "shard", "slot")
