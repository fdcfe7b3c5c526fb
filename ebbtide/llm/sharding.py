"""Minimax contiguous sharding of atomic groups, in DataFrame operations only.

Documents with equal texts form one atomic group. Groups are ordered by the digest of their text, and the
order is cut into shards so that the largest shard is as small as can be: the smallest capacity at which
greedy filling needs no more shards than allowed is found by binary search. A group larger than the capacity
has a shard of its own, so a hot text does not set the capacity of the shards beside it, and the largest shard
is still the smallest possible. Shards that greedy filling has left over go to the middle of the largest ones,
so none is empty while another holds two groups. The driver never sees the groups. It holds byte totals of digest prefixes, searches with them, and asks for finer totals only where a
cut may fall, until every cut is known to the group. A bounded number of totals is fetched a round.

Defined results: null texts count as empty ones; repeated rows are rows of their own in one group; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window as W, functions as F

from ebbtide.llm.shared import written

SHARDS = 8
DIGITS = 3  # hexadecimal digits a prefix grows by in a round: 4,096 totals for each refined prefix
REFINED = 16  # prefixes refined in a round, at most
BUCKET_ROWS = 2000  # rows numbered together in one window partition
MOST_BUCKETS = 1 << 16


@dataclass(frozen=True)
class Segment:
    """A stretch of the order: all groups whose digest begins with ``prefix``."""

    prefix: str
    size: int
    groups: int

    @property
    def atomic(self) -> bool:
        return self.groups == 1


def fill(segments: list[Segment], capacity: int, shards: int, fluid: bool) -> list[int] | None:
    """Greedy cut positions (in bytes) at a capacity, or None when it does not suffice.

    A single group beyond the capacity fills a shard alone.
    ``fluid`` lets cuts fall anywhere inside stretches of several groups, which gives the furthest positions
    the true cuts can have; otherwise stretches stay whole, which gives a partition that surely works.
    """
    cuts, begin, at = [], 0, 0
    for s in segments:
        while at + s.size - begin > capacity:
            if at == begin and s.atomic:
                break
            if fluid and not s.atomic:
                cuts.append(max(begin + capacity, at))
            elif at == begin:
                return None
            else:
                cuts.append(at)
            begin = cuts[-1]
            if len(cuts) >= shards:
                return None
        at += s.size
    return cuts


def smallest(segments: list[Segment], shards: int, fluid: bool) -> int:
    """Smallest capacity at which greedy filling needs at most ``shards`` shards."""
    low, high = 1, sum(s.size for s in segments)
    while low < high:
        middle = (low + high) // 2
        if fill(segments, middle, shards, fluid) is None:
            low = middle + 1
        else:
            high = middle
    return low


def _touched(segments: list[Segment], low: int, high: int) -> list[Segment]:
    out, at = [], 0
    for s in segments:
        if at < high and at + s.size > low and not s.atomic:
            out.append(s)
        at += s.size
    return out


def unsettled(segments: list[Segment], shards: int) -> list[Segment]:
    """Stretches of several groups in which a cut of the best partition may fall, first ones first."""
    least, most = smallest(segments, shards, True), smallest(segments, shards, False)
    # Cuts move right with the capacity, so the outer cases bound them.
    furthest = fill(segments, most, shards, True)
    nearest, begin, at = [], 0, 0
    for s in segments:
        if at + s.size - begin > least and at > begin:
            nearest.append(at)
            begin = at
        at += s.size
    total, out = at, []
    for k in range(max(len(furthest), min(len(nearest), shards - 1))):
        low = nearest[k] if k < len(nearest) else total
        high = furthest[k] if k < len(furthest) else total
        out += [s for s in _touched(segments, min(low, high), max(low, high)) if s not in out]
        if len(out) >= REFINED:
            break
    return out[:REFINED]


def _totals(groups: DataFrame, length: int, inside: list[str]) -> dict[str, Segment]:
    if inside:
        groups = groups.where(F.substring("digest", 1, len(inside[0])).isin(inside))
    rows = groups.groupBy(F.substring("digest", 1, length).alias("prefix")).agg(F.sum("size").alias("size"), F.count("*").alias("groups"))
    return {r["prefix"]: Segment(r["prefix"], r["size"], r["groups"]) for r in rows.collect()}


def spread(segments: list[Segment], cuts: list[int], shards: int) -> list[int]:
    """More cuts, up to the number of shards: each halves the largest shard that has a place for one."""
    edges = [0]
    for s in segments:
        edges.append(edges[-1] + s.size)
    out = sorted(cuts)
    while len(out) < shards - 1:
        bounds = [0, *out, edges[-1]]
        inner = [(a - b, a, b, edges[bisect_right(edges, a):bisect_left(edges, b)]) for a, b in zip(bounds, bounds[1:])]
        open_ = [x for x in inner if x[3]]
        if not open_:
            break
        _, a, b, places = min(open_, key=lambda x: x[:3])
        out = sorted([*out, min(places, key=lambda e: (abs(2 * e - a - b), e))])
    return out


def cut_points(groups: DataFrame, shards: int = SHARDS) -> list[str]:
    """Digest prefixes at which shards 1, 2, ... begin; ``groups`` has one row per digest with its bytes."""
    found = _totals(groups, DIGITS, [])
    # At most as many groups as shards can be beyond a capacity that suffices; these are told apart first.
    large = [r["digest"] for r in groups.orderBy(F.desc("size"), "digest").limit(shards).collect()]
    while True:
        segments = [found[p] for p in sorted(found)]
        if not segments:
            return []
        pending = [s for s in segments if not s.atomic and any(d.startswith(s.prefix) for d in large)] or unsettled(segments, shards)
        if not pending:
            cuts = spread(segments, fill(segments, smallest(segments, shards, False), shards, False), shards)
            # Only stretches that are still whole can hold a place for a missing cut.
            pending = [s for s in segments if not s.atomic][:REFINED] if len(cuts) < shards - 1 else []
        if not pending:
            break
        shortest = min(len(s.prefix) for s in pending)
        split = [s.prefix for s in pending if len(s.prefix) == shortest]
        finer = _totals(groups, shortest + DIGITS, split)
        for p in split:
            del found[p]
        found.update(finer)
    at, starts = 0, {}
    for s in segments:
        starts[at] = s.prefix
        at += s.size
    return [starts[c] for c in cuts]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, digest, size and checksum of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.substring(F.sha2(text, 256), 1, 32).alias("digest"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
    )


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard and slot of every document, by the law of near equal bytes."""
    rows = written(measured(docs), "sharding-rows")
    groups = written(rows.groupBy("digest").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "sharding-groups")
    begins = cut_points(groups.select("digest", "size"), shards)
    shard = F.lit(0)
    for b in begins:
        shard = shard + F.when(F.col("digest") >= b, 1).otherwise(0)
    n = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    buckets = max(1, min(MOST_BUCKETS, -(-n // (BUCKET_ROWS * shards))))
    # Rows are numbered inside buckets dealt by document, so a group with a third of all rows spreads too.
    placed = rows.withColumns({"shard": shard.cast("int"), "bucket": F.pmod(F.xxhash64("doc_id", "digest"), F.lit(buckets))})
    sizes = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))  # at most shards x MOST_BUCKETS rows
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = W.partitionBy("shard", "bucket").orderBy("doc_id", "digest")
    numbered = placed.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(F.broadcast(offsets), ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + F.col("place")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
