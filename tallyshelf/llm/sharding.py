"""Balanced label propagation: documents that belong together move to one shard, sizes stay even."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, stored

MAX_ROUNDS = 40


# How groups pick their shard, one after the other as a round brings nothing: shards with unlinked documents by votes,
# all shards by votes, any shard of the group in a new turn each.
_WAYS = ["open", "all", "any", "any", "any", "any"]


def _quotas(wanted: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """Most moves for each (from, to) of which no shard gains more than ``room``, the unlinked documents it can give away.

    All moves are made, then as few as possible taken back: surplus goes over the
    cheapest paths to shards that lack some. A step takes one move back (cost 1),
    makes one again (-1) or hands over unlinked documents (0, by way of a hub).
    """
    hub, allowed, handed = len(room), dict(wanted), [0] * len(room)
    net = [0] * (hub + 1)
    for (a, b), n in wanted.items():
        net[a] -= n
        net[b] += n
    while any(n > 0 for n in net):
        cost: list = [0 if n > 0 else None for n in net]
        came: dict[int, tuple] = {}
        changed = True
        while changed:
            changed = False
            steps = [(b, a, 1, n, (a, b)) for (a, b), n in allowed.items()]
            steps += [(a, b, -1, wanted[a, b] - n, (a, b)) for (a, b), n in allowed.items()]
            steps += [(s, hub, 0, room[s] - handed[s], None) for s in range(hub)]
            steps += [(hub, s, 0, 1 << 62, None) for s in range(hub)]
            for u, v, c, most, move in steps:
                if most > 0 and cost[u] is not None and (cost[v] is None or cost[u] + c < cost[v]):
                    cost[v], came[v], changed = cost[u] + c, (u, c, most, move), True
        end = min((s for s in range(hub) if net[s] < 0 and cost[s] is not None), key=lambda s: cost[s])
        path, at = [], end
        while at in came:
            path.append((at, *came[at]))
            at = came[at][0]
        some = min(net[at], -net[end], *(most for _, _, _, most, _ in path))
        for v, u, c, _, move in path:
            if move:
                allowed[move] -= c * some
            elif v == hub:
                handed[u] += some
            else:
                handed[v] -= some
        net[at] -= some
        net[end] += some
    return allowed


def _refill(net: list[int]) -> list[tuple[int, int, int, int]]:
    """(from, first, last, to): which unlinked documents, by their number in a shard, go where sizes fell short."""
    lacking = [[s, -n] for s, n in enumerate(net) if n < 0]
    runs = []
    for s, n in enumerate(net):
        first = 0
        while n > 0:
            to = lacking[-1]
            some = min(n, to[1])
            runs.append((s, first, first + some - 1, to[0]))
            first, n, to[1] = first + some, n - some, to[1] - some
            if not to[1]:
                lacking.pop()
    return runs


def balanced_shards(docs: DataFrame, shards: int = 16, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, digest, shard, slot): shard sizes in rows at most one apart, equal texts together.

    Documents start dealt out evenly. Equal texts are linked through their
    group: in each round a group's documents, counted by shard, vote for the
    shard with room that holds most of them, and those elsewhere ask to move
    there. Shards take as many as they can give away unlinked documents for, or
    as leave them; unlinked documents then go where room was left, so sizes
    never change. A round that brings fewer linked pairs together than before
    is dropped; then full shards are asked too, so linked documents change
    places, and then other shards of a group than that of most votes, until
    ``_WAYS`` is through or ``max_rounds`` are over. Votes are
    aggregated map-side and joined back by group; what the driver gets is a
    count for each pair of shards. A group larger than a shard fills one shard
    after another.

    Size: bytes of the text plus 1. A null text has no bytes, and is grouped
    with null texts only. Null or repeated doc_ids and repeated rows are rows
    like any other. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    base = stored(docs.select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.when(text.isNull(), F.unhex(F.lit("00"))).otherwise(F.unhex(F.sha2(text, 256))).alias("digest"),
    ), "rows")
    total = base.count()
    order = ["doc_id", "digest"]
    groups = base.groupBy("digest").agg((F.count(F.lit(1)) > 1).alias("linked"))
    dealt = numbered(base.withColumn("all", F.lit(0)), ["all"], order, "n", total).drop("all")
    state = stored(
        dealt.join(groups, "digest").select(
            "doc_id", "size", "text_crc32", "digest", "linked", F.pmod("n", F.lit(shards)).cast("int").alias("shard")
        ), "shards",
    )

    def survey(now: DataFrame) -> tuple[DataFrame, list[int], int]:
        """Votes of each group, unlinked documents of each shard, linked pairs that are apart."""
        votes = stored(now.filter("linked").groupBy("digest", "shard").agg(F.count(F.lit(1)).alias("votes")), "votes")
        free = {r["shard"]: r["n"] for r in now.filter("not linked").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        wide = F.col("votes").cast("decimal(38,0)")
        apart = votes.groupBy("digest").agg((F.sum(wide) * F.sum(wide) - F.sum(wide * wide)).cast("decimal(38,0)").alias("d"))
        row = apart.agg(F.sum("d")).first()
        return votes, [free.get(s, 0) for s in range(shards)], int(row[0] or 0)

    votes, free, apart = survey(state)
    way = 0
    for turn in range(max_rounds):
        if not apart or way == len(_WAYS):
            break
        # At first a full shard of linked documents takes no more; ties go to a shard that differs by group and round.
        targets = [s for s in range(shards) if free[s]] if _WAYS[way] == "open" else list(range(shards))
        if not targets:
            way += 1
            targets = list(range(shards))
        by_votes = _WAYS[way] != "any"
        rank = F.struct(
            F.col("votes") if by_votes else F.lit(0).cast("long").alias("votes"),
            F.xxhash64("digest", "shard", F.lit(turn)).alias("h"), F.col("shard").alias("s"),
        )
        best = votes.filter(F.array_contains(F.array(*map(F.lit, targets)), F.col("shard")))
        best = best.groupBy("digest").agg(F.max(rank).alias("best"))
        asks = votes.join(best, "digest").filter("shard <> best.s")
        asks = (asks.filter("votes <= best.votes") if by_votes else asks).select(
            "digest", "shard", F.col("best.s").alias("to"), "votes"
        )
        asks = stored(asks, "asks")
        wanted = {(r["shard"], r["to"]): r["n"] for r in asks.groupBy("shard", "to").agg(F.sum("votes").alias("n")).collect()}
        allowed = _quotas(wanted, free)
        if not any(allowed.values()):
            way += 1
            continue
        net = [0] * shards
        for (a, b), n in allowed.items():
            net[a] -= n
            net[b] += n
        asked = state.filter("linked").join(asks.select("digest", "shard", "to"), ["digest", "shard"], "left")
        if allowed != wanted:
            # The first in line move; a group's documents stand together in it as far as they fit a bucket.
            quota = spark.createDataFrame([(a, b, n) for (a, b), n in allowed.items()], "shard int, to int, quota long")
            line = numbered(asked.filter("to is not null"), ["shard", "to"], ["digest", "doc_id"], "line", total)
            line = line.join(F.broadcast(quota), ["shard", "to"])
            line = line.withColumn("to", F.when(F.col("line") < F.col("quota"), F.col("to")))
            asked = line.select(asked.columns).unionByName(asked.filter("to is null"))
        moved = asked.withColumn("shard", F.coalesce("to", "shard")).select(state.columns)
        runs = spark.createDataFrame(_refill(net) or [(-1, 0, -1, 0)], "from int, first long, last long, goes int")
        rest = numbered(state.filter("not linked"), ["shard"], order, "place", total)
        rest = rest.join(
            F.broadcast(runs), (F.col("shard") == F.col("from")) & F.col("place").between(F.col("first"), F.col("last")), "left"
        ).withColumn("shard", F.coalesce("goes", "shard")).select(state.columns)
        after = stored(moved.unionByName(rest), "shards")
        votes_after, free_after, now = survey(after)
        if now < apart:
            state, votes, free, apart, way = after, votes_after, free_after, now, min(way, 1)
        else:
            way += 1
    return numbered(state, ["shard"], order, "slot", total).drop("linked")
