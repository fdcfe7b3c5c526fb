"""N-gram Jaccard join of documents, size-aware: small sets by their subsets, large sets by inverted lists.

A document's set holds its distinct shingles of SHINGLE words. Equal sets are one set from the start. Two sets
link when their Jaccard similarity is PERCENT or more, so they have a known least overlap. Both can be given:
``op8_jaccard_join`` takes the values below, the stage of the pipeline takes its own.

* Small sets (up to a boundary that a cost model takes from the histogram of sizes) write down all their
  subsets of the least overlaps they can have with partners; linked small sets share one.
* Large sets, and small ones that can link with them, go into inverted lists. A shingle in one set only can
  link nothing. A set whose such shingles already outnumber the differences a link allows has no partner
  and is done. Of the others the rarest shingles are looked up, as many as it takes to meet every partner.

Sets that share a key hang together with the smallest of them, which gives closed groups of candidates
without listing pairs. Groups are cut into blocks; a task takes a pair of blocks, scans the inverted lists of
its sets, counts overlaps exactly, and returns the links that connect them. All links between different sets
are found or implied by others; components follow from them.

Defined results: null texts and texts without words have the empty set and link with nothing; fewer words
than a shingle are one shingle; repeated rows are rows of one set; a component is named by its smallest doc_id; other
columns are not read. Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from ebbtide.llm.components import components
from ebbtide.llm.shared import attach, written
from ebbtide.llm.words import SPACED, cut, give_back, mix, pieces, span_hashes

SHINGLE = 4
PERCENT = 85
PART_POSTINGS = 1 << 20  # postings of one part of the inverted lists, and those a task packs at once
BLOCK = 512  # sets of one block of a candidate group
BUCKET_ROWS = 2048  # sets that a verifying task takes at once
MOST_SUBSETS = 5000  # a set beyond so many subsets is never small


def least_overlap(s: int, t: int, percent: int = PERCENT) -> int:
    """Smallest overlap at which sets of these sizes link."""
    return -(-percent * (s + t) // (100 + percent))


def overlaps(n: int, largest: int, percent: int = PERCENT) -> list[int]:
    """All least overlaps of a set of size n with partners of sizes up to ``largest``."""
    sizes = range(max(1, -(-percent * n // 100)), min(largest, 100 * n // percent) + 1)
    return sorted({o for t in sizes if (o := least_overlap(n, t, percent)) <= min(n, t)})


def boundary(histogram: dict[int, int], percent: int = PERCENT) -> int:
    """Largest size counted as small: the one with the fewest rows written for subsets and postings together."""
    best, cost_of_best = 0, None
    for b in range(0, 60):
        subsets = [sum(comb(n, o) for o in overlaps(n, b, percent)) for n in range(1, b + 1)]
        if subsets and max(subsets) > MOST_SUBSETS:
            break
        cost = sum(histogram.get(n, 0) * w for n, w in zip(range(1, b + 1), subsets)) + sum(2 * n * k for n, k in histogram.items() if n >= listed_from(b, percent))
        if cost_of_best is None or cost < cost_of_best:
            best, cost_of_best = b, cost
    return best


def listed_from(small: int, percent: int = PERCENT) -> int:
    """Smallest size that can link with a set beyond the boundary, and so stands in the inverted lists."""
    return max(1, -(-percent * (small + 1) // 100))


class Sets:
    """Distinct shingles of every text of a piece: values[first[i]:first[i + 1]], ascending."""

    def __init__(self, texts: pa.Array, shingle: int = SHINGLE):
        words = cut(texts, SPACED)
        at, grams = words.grams(shingle)
        owner = words.text_of()[at]
        short = np.flatnonzero((words.counts > 0) & (words.counts < shingle))
        if len(short):
            owner = np.concatenate([owner, short])
            grams = np.concatenate([grams, span_hashes(words.hashes, words.first[short], words.first[short + 1])])
        order = np.lexsort((grams, owner))
        owner, grams = owner[order], grams[order]
        new = np.ones(len(order), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (grams[1:] != grams[:-1])
        self.values = grams[new]
        self.first = np.searchsorted(owner[new], np.arange(len(words.first)))
        self.sizes = np.diff(self.first)
        total = np.zeros(len(self.values) + 1, np.uint64)
        np.cumsum(mix(self.values), out=total[1:])
        self.ids = mix(total[self.first[1:]] - total[self.first[:-1]] + self.sizes.astype(np.uint64)).view(np.int64)


def _bytes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def document_sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, set_id, n of every row."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            s = Sets(batch.column("text"), shingle)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(s.ids), pa.array(s.sizes.astype(np.int64))], names=["doc_id", "set_id", "n"])

    return docs.select("doc_id", "text").mapInArrow(job, "doc_id long, set_id long, n long")


_BLOCKS = "part int, chunk long, owners binary, hashes binary"
_SHARED = _BLOCKS + ", lengths binary"
_CHUNK_SETS = 50_000  # sets of a chunk: their numbers fit in two bytes


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * (len(rows[0]) - 2)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["part", "chunk", "owners", "hashes", "lengths"][: len(kinds)])


def postings(docs: DataFrame, least: int, parts: int, shingle: int = SHINGLE) -> DataFrame:
    """Shingles of all sets of at least this size, packed by part of the inverted lists.

    A task gathers its sets in chunks and names a set by its place in the chunk, so a posting takes ten bytes
    however many parts there are. Ids and sizes of a chunk's sets go once to a part of their own, ``parts``
    and up. Equal sets are sent once a task.
    """

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        chunk = TaskContext.get().partitionId() << 24

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal chunk
            ids, sizes, hashes = (np.concatenate(x) for x in zip(*held))
            held.clear()
            owner = np.repeat(np.arange(len(ids), dtype=np.uint16), sizes)
            part = (hashes >> np.uint64(33)).astype(np.int64) % parts
            order = np.argsort(part, kind="stable")
            hashes, owner = hashes[order], owner[order]
            edges = np.searchsorted(part[order], np.arange(parts + 1))
            rows = [(p, chunk, _bytes(owner[edges[p] : edges[p + 1]]), _bytes(hashes[edges[p] : edges[p + 1]])) for p in np.flatnonzero(np.diff(edges)).tolist()]
            if rows:
                yield _packed([*rows, (parts + chunk % parts, chunk, _bytes(ids), _bytes(sizes.astype(np.int64)))])
            chunk += 1

        for batch in pieces(batches):
            s = Sets(batch.column("text"), shingle)
            _, every = np.unique(s.ids, return_index=True)
            every = [k for k in every.tolist() if s.sizes[k] >= least and int(s.ids[k]) not in done]
            done.update(s.ids[every].tolist())
            if len(done) > 1 << 20:
                done.clear()
            for begin in range(0, len(every), _CHUNK_SETS):
                at = np.array(every[begin : begin + _CHUNK_SETS], np.int64)
                if held and sum(len(h[0]) for h in held) + len(at) > _CHUNK_SETS:
                    yield from flush()
                sizes = s.sizes[at]
                pick = np.repeat(s.first[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
                held.append((s.ids[at], sizes, s.values[pick]))
                if sum(len(h[2]) for h in held) >= PART_POSTINGS:
                    yield from flush()
        if held:
            yield from flush()

    return docs.select("text").mapInArrow(job, _BLOCKS)


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _column(table: pa.Table, name: str, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]


def shared_shingles(blocks: DataFrame, parts: int) -> DataFrame:
    """The postings whose inverted list has two entries or more, with the list's length, packed by chunk.

    Copies of a set in several tasks have entries of their own; that keeps shingles, and drops none.
    """
    schema = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), *((c, pa.binary()) for c in ("owners", "hashes", "lengths"))])

    def job(table: pa.Table) -> pa.Table:
        if table.column("part")[0].as_py() >= parts:  # what chunks consist of, passed on to where they are put together
            rows = [(r["part"] - parts, r["chunk"], r["owners"], r["hashes"], None) for r in table.to_pylist()]
            return pa.Table.from_batches([_packed(rows)], schema=schema)
        owners, hashes, chunks = _column(table, "owners", np.uint16), _column(table, "hashes", np.uint64), table.column("chunk").to_numpy()
        source = np.repeat(np.arange(len(chunks)), [len(x) for x in owners])
        owner, values = np.concatenate(owners), np.concatenate(hashes)
        order = np.argsort(values, kind="stable")
        starts = _starts(values[order])
        runs = np.diff(np.append(starts, len(values)))
        length = np.empty(len(values), np.uint16)
        length[order] = np.repeat(np.minimum(runs, 65535), runs)
        many = np.flatnonzero(length > 1)
        many = many[np.argsort(chunks[source[many]], kind="stable")]
        rows, of_chunk = [], chunks[source[many]]
        edges = np.append(_starts(of_chunk), len(many))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            own = many[a:b]
            rows.append((int(of_chunk[a]) % parts, int(of_chunk[a]), _bytes(owner[own]), _bytes(values[own]), _bytes(length[own])))
        give_back()
        return pa.Table.from_batches([_packed(rows)] if rows else [], schema=schema)

    return blocks.groupBy("part").applyInArrow(job, _SHARED)


_SURVIVORS = "set_id long, n long, shingles binary, keys array<long>"


def _level(n: np.ndarray, percent: int) -> np.ndarray:
    """Linked sets have equal or neighbouring levels."""
    return np.floor(np.log(n) / np.log(100 / percent) + 1e-9).astype(np.int64)


def survivors(shared: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Sets that can have a partner: their shared shingles, and the keys under which they meet every partner."""

    def job(table: pa.Table) -> pa.Table:
        out: dict[int, tuple] = {}
        for chunk in pc.unique(table.column("chunk")).to_pylist():
            own = table.filter(pc.equal(table.column("chunk"), chunk))
            facts, entries = own.filter(pc.is_null(own.column("lengths"))), own.filter(pc.is_valid(own.column("lengths")))
            if not entries.num_rows:
                continue
            ids, sizes = _column(facts, "owners", np.int64)[0], _column(facts, "hashes", np.int64)[0]
            owner, hashes, length = (np.concatenate(_column(entries, c, t)) for c, t in (("owners", np.uint16), ("hashes", np.uint64), ("lengths", np.uint16)))
            order = np.lexsort((hashes, length, owner))
            owner, hashes = owner[order], hashes[order]
            starts = _starts(owner)
            counts = np.diff(np.append(starts, len(owner)))
            n, names = sizes[owner[starts]], ids[owner[starts]]
            looked_up = n - -(-percent * n // 100) + 1 - (n - counts)  # the set's own shingles come first and meet nobody
            levels = _level(np.maximum(n, 1), percent)
            for k in np.flatnonzero(looked_up > 0).tolist():
                mine = hashes[starts[k] : starts[k] + counts[k]]
                rare = mine[: looked_up[k]]
                keys = np.concatenate([mix(rare ^ mix(np.full(1, levels[k] + d, np.uint64))) for d in (0, 1)])  # the own level, and the one above
                out[int(names[k])] = (int(names[k]), int(n[k]), _bytes(np.sort(mine)), keys.view(np.int64))
        columns = list(zip(*out.values())) or [[], [], [], []]
        give_back()
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())))], names=["set_id", "n", "shingles", "keys"])

    return shared.groupBy("part").applyInArrow(job, _SURVIVORS)


def small_sets(docs: DataFrame, small: int, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """Sets up to the boundary, keyed by their subsets of every least overlap with a small partner."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            s, out = Sets(batch.column("text"), shingle), {}
            for k in np.flatnonzero((s.sizes > 0) & (s.sizes <= small)).tolist():
                if int(s.ids[k]) in out:
                    continue
                own = s.values[s.first[k] : s.first[k + 1]]
                codes, n, keys = mix(own), len(own), []
                for size in overlaps(n, small, percent):
                    left_out = np.array(list(combinations(range(n), n - size)), np.int64).reshape(comb(n, size), n - size)
                    keys.append(mix(codes.sum(dtype=np.uint64) - codes[left_out].sum(1, dtype=np.uint64) + np.uint64(size)))
                out[int(s.ids[k])] = (int(s.ids[k]), n, _bytes(own), np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64))
            columns = list(zip(*out.values())) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())))], names=["set_id", "n", "shingles", "keys"])

    return docs.select("text").mapInArrow(job, _SURVIVORS)


def hubs(sets: DataFrame) -> DataFrame:
    """a, b: every set with the smallest set that shares one of its keys."""
    keyed = sets.select("set_id", F.explode("keys").alias("key"))
    lists = written(keyed.groupBy("key").agg(F.min("set_id").alias("hub"), F.count("*").alias("n")).where("n > 1"), "jaccard-lists")
    return attach(keyed, lists, "key", "n", ["set_id"]).where("hub <> set_id").select(F.col("set_id").alias("a"), F.col("hub").alias("b")).distinct()


def _links(left: list[np.ndarray], right: list[np.ndarray] | None, sizes: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Links that connect what is linked among the sets (right is None) or across the two lists, by scanning inverted lists."""
    sets = left + (right or [])
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), lengths)
    _, number = np.unique(values, return_inverse=True)
    order = np.argsort(number, kind="stable")
    lists, bounds = owner[order], np.concatenate([[0], np.cumsum(np.bincount(number))])
    first = np.concatenate([[0], np.cumsum(lengths)])
    label = np.arange(len(sets))
    for a in range(len(left)):
        others = np.arange(a + 1, len(sets)) if right is None else np.arange(len(left), len(sets))
        if not (label[others] != label[a]).any():
            continue
        own = number[first[a] : first[a + 1]]
        size = bounds[own + 1] - bounds[own]
        met = lists[np.repeat(bounds[own] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]
        both = np.bincount(met, minlength=len(sets))[others]
        linked = others[100 * both >= percent * (sizes[a] + sizes[others] - both)]
        for b in linked.tolist():
            if label[a] != label[b]:
                yield a, b
                label[label == label[b]] = label[a]


def verified(sets: DataFrame, groups: DataFrame, percent: int = PERCENT) -> DataFrame:
    """a, b: true links that connect all linked sets of every candidate group.

    Groups larger than a block are cut by hash into blocks, and every pair of blocks is a unit of its own.
    """
    counts = written(groups.groupBy("root").agg(F.count("*").alias("n")), "jaccard-groups")
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    placed = attach(groups, counts.select("root", "n", blocks.alias("blocks")), "root", "n", ["node"])
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(F.col("mine"), j).alias("i"), F.greatest(F.col("mine"), j).alias("j")))
    units = placed.withColumn("mine", mine).select("root", "node", "mine", F.explode(pairs).alias("p")).select("root", "node", "mine", "p.i", "p.j")
    total = counts.agg(F.coalesce(F.sum(F.col("n") * F.ceil(F.col("n") / F.lit(BLOCK))), F.lit(0)).alias("n")).first()["n"]
    buckets = max(1, -(-int(total) // BUCKET_ROWS))
    units = written(units.withColumn("bucket", F.pmod(F.xxhash64("root", "i", "j"), F.lit(buckets)).cast("int")), "jaccard-units")
    shipped = units.join(sets.select(F.col("set_id").alias("node"), F.col("n").alias("size"), "shingles"), "node")

    def job(table: pa.Table) -> pa.Table:
        table = table.sort_by([("root", "ascending"), ("i", "ascending"), ("j", "ascending"), ("mine", "ascending"), ("node", "ascending")])
        root, i, j, mine, node, size = (table.column(c).to_numpy() for c in ("root", "i", "j", "mine", "node", "size"))
        shingles = table.column("shingles").to_pylist()
        new = np.ones(len(root), bool)
        new[1:] = (root[1:] != root[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        edges = np.append(np.flatnonzero(new), len(root))
        a, b = [], []
        for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            own = [np.frombuffer(x, np.uint64) for x in shingles[begin:end]]
            cut_at = int(np.searchsorted(mine[begin:end], i[begin], "right")) if i[begin] != j[begin] else len(own)
            for x, y in _links(own[:cut_at], own[cut_at:] if i[begin] != j[begin] else None, size[begin:end], percent):
                a.append(int(node[begin + x]))
                b.append(int(node[begin + y]))
        give_back()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return shipped.groupBy("bucket").applyInArrow(job, "a long, b long")


def joined(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    rows = written(document_sets(docs, shingle), "jaccard-rows")
    own = written(rows.where("n > 0").groupBy("set_id", "n").agg(F.min("doc_id").alias("doc"), F.count("*").alias("copies")), "jaccard-sets")
    histogram = {r["n"]: r["k"] for r in own.groupBy("n").agg(F.count("*").alias("k")).collect()}  # bounded by the longest text
    small = boundary(histogram, percent)
    least = listed_from(small, percent)
    parts = max(1, -(-sum(n * k for n, k in histogram.items() if n >= least) // PART_POSTINGS))
    able = survivors(shared_shingles(postings(docs, least, parts, shingle), parts), percent)
    able = written(able.dropDuplicates(["set_id", "n"]), "jaccard-survivors")
    found = able
    if small:
        few = written(small_sets(docs, small, percent, shingle).dropDuplicates(["set_id", "n"]), "jaccard-small")
        found = able.unionByName(few)
    groups = components(hubs(found))
    groups = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct())
    # Small sets are verified with all their shingles: the lists may lack those they share with sets that stand in none.
    sets = able.where(F.col("n") > small).unionByName(few) if small else able
    links = components(verified(sets, groups, percent))
    named = own.join(links, own["set_id"] == links["node"], "left").select("set_id", "doc", "copies", F.coalesce("root", "set_id").alias("root"))
    names = named.groupBy("root").agg(F.min("doc").alias("component"))
    named = written(named.join(names, "root").select("set_id", "copies", "component"), "jaccard-names")
    return attach(rows, named, "set_id", "copies", ["doc_id"]).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def representatives(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """One row of every component, with all its columns: that of the smallest doc_id.

    Documents with the empty set all stay; of rows equal in id and text one stays.
    """
    found = joined(docs, percent, shingle)
    names = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__id")).distinct()
    kept = docs.join(names.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    same = W.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id")
    return kept.withColumn("__copy", F.row_number().over(same)).where("__copy = 1").select(*docs.columns)
