"""Suffix-array deduplication: bytes under any 50-byte string that also starts in a document with a smaller id go.

Every window of 50 bytes belongs to the smallest hash of the 16-byte grams in it, its anchor, so equal windows share
their anchor wherever they stand. Anchors that only one document has are told apart by one shuffle of lists of them by
bucket; what a task can tell on its own is reduced to one entry per anchor before. Runs of windows with one anchor form
fragments, equal fragments become one with its smallest document, and the fragments of an anchor meet in one bucket.
There a suffix array by two-stage sorting stands over them: suffixes smaller than their successors are sorted
directly, the others are induced by scanning the buckets of first bytes in order; it holds the suffixes that start a
window and those they are induced from. Common prefixes of neighbours cut the array into groups of equal windows, and a
window goes when its group holds a smaller document.

Anchors with more different fragments than a bucket should hold are split into their windows, which are joined with
the smallest document of the same window: that is exact as well and spreads by window.

Defined results: null and empty texts have no bytes, texts under 50 bytes lose nothing; rows without an id lose
nothing and others lose nothing to them; rows with the same id lose nothing to each other, repeated rows get the same
result each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ebbtide.llm.shared import attach, drop, stored
from ebbtide.llm.words import _BASE, _BYTE_CODE, buffers, give_back, mix, pieces, span_hashes

LENGTH = 50
GRAM = 16
STRETCH = LENGTH - GRAM + 1  # grams in a window, and the most windows of a fragment (a mask of 64 bits holds them)
CHUNK_BYTES = 8 << 20  # text whose anchors a task compares before it hands them on
PIECE_BYTES = 256 << 10  # text cut at once: its arrays of numbers stay in the processor's cache
BUCKET_BYTES = 2 << 20
MOST_FRAGMENTS = 20_000  # different fragments of an anchor that go to one bucket
MOST_BROADCAST = 200_000  # crowded anchors that are sent to every task; more are joined by a shuffle
HELD_FRAGMENTS = 1 << 20  # places where a task remembers fragments to send their bytes once
_GAP = 255  # between fragments; no byte of UTF-8


# --- two-stage suffix sorting


def _eights(t: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as one big-endian number; zeros follow the end, with room for LENGTH more."""
    room = len(t) + LENGTH + 16
    padded = np.zeros(room + 7, np.uint8)
    padded[: len(t)] = t
    return np.ndarray(room, ">u8", buffer=padded, strides=(1,)).astype(np.uint64)


def _below_next(t: np.ndarray) -> np.ndarray:
    """Whether the suffix at each position is smaller than the next one."""
    n = len(t)
    differs = np.append(t[:-1] != t[1:], True)
    ends = np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1]  # of the run of equal bytes
    after = np.append(t.astype(np.int16), -1)
    return after[ends] < after[ends + 1]


def _direct(at: np.ndarray, eights: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their first bytes, eight at a time; only those still equal are looked at again."""
    key = eights[at]
    order = np.argsort(key)
    at, key = at[order], key[order]
    group = np.cumsum(np.append(False, key[1:] != key[:-1])) if len(at) else at
    for step in range(8, depth, 8):
        same = np.append(group[1:] == group[:-1], False)
        tied = np.flatnonzero(same | np.append(False, same[:-1]))
        if not len(tied):
            break
        key = eights[at[tied] + step]
        order = np.argsort(key)
        key = key[order]
        rank = np.empty(len(tied), np.int64)
        rank[order] = np.cumsum(np.append(False, key[1:] != key[:-1]))
        both = group[tied] * len(tied) + rank
        order = np.argsort(both)
        at[tied] = at[tied][order]
        both = both[order]
        new = np.append(False, both[1:] != both[:-1])
        # Numbers only have to grow along the order and to tell neighbours apart.
        group = group * len(at)
        group[tied] += np.cumsum(new)
        group = np.cumsum(np.append(False, group[1:] != group[:-1]))
    return at


def _needed(asked: np.ndarray, below: np.ndarray) -> np.ndarray:
    """The positions asked for and those their order is induced from: all that follow up to one sorted directly."""
    at = np.arange(len(asked))
    last = np.maximum.accumulate(np.where(asked, at, -1))
    direct = np.maximum.accumulate(np.where(below, at, -1))
    return last > np.append(-1, direct[:-1])


def suffix_array(t: np.ndarray, depth: int = LENGTH, eights: np.ndarray | None = None, asked: np.ndarray | None = None) -> np.ndarray:
    """Positions of ``t`` in the order of the suffixes there, as far as their first ``depth`` bytes tell.

    With a mask ``asked``, only positions in it.
    """
    n = len(t)
    if not n:
        return np.zeros(0, np.int64)
    eights = _eights(t) if eights is None else eights
    below = _below_next(t)
    needed = np.ones(n, bool) if asked is None else _needed(asked, below)
    induced = needed & ~below
    out = np.empty(np.count_nonzero(needed), np.int64)
    starts = np.concatenate([[0], np.cumsum(np.bincount(t[needed], minlength=256))])
    larger = np.bincount(t[induced], minlength=256)  # suffixes to be induced, at the head of each bucket
    direct = _direct(np.flatnonzero(needed & below), eights, depth)
    tails = np.concatenate([[0], np.cumsum(np.bincount(t[direct], minlength=256))])
    head = starts[:-1].copy()

    def induce(scanned: np.ndarray) -> None:
        before = scanned[scanned > 0] - 1
        before = before[induced[before]]
        first = t[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        counts = np.bincount(first, minlength=256)
        out[head[first] + np.arange(len(before)) - (np.cumsum(counts) - counts)[first]] = before
        head[:] += counts

    if needed[-1]:  # the empty suffix comes first and induces the last one
        out[head[t[-1]]] = n - 1
        head[t[-1]] += 1
    for c in np.flatnonzero(np.diff(starts)).tolist():
        done = starts[c]
        while done < head[c]:  # suffixes induced within the bucket are scanned in turn
            end = head[c]
            induce(out[done:end])
            done = end
        assert head[c] == starts[c] + larger[c]
        tail = direct[tails[c] : tails[c + 1]]
        out[head[c] : starts[c + 1]] = tail
        induce(tail)
    return out if asked is None else out[asked[out]]


def common_prefixes(at: np.ndarray, eights: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Equal first bytes, up to ``most``, of each suffix and the one before it in ``at``; 0 for the first."""
    out = np.zeros(len(at), np.int64)
    live = np.arange(1, len(at))
    for step in range(0, most, 8):
        x = eights[at[live] + step] ^ eights[at[live - 1] + step]
        # The exponent as a double tells the highest bit; without the bits after set ones no rounding reaches the next.
        highest = ((x & ~(x >> np.uint64(1))).astype(np.float64).view(np.int64) >> 52) - 1023
        equal = np.minimum((63 - highest) >> 3, 8)
        out[live] += equal
        live = live[equal == 8]
    return np.minimum(out, most)


def repeated_windows(contents: list[bytes], owners: np.ndarray) -> np.ndarray:
    """For each fragment a mask of its windows (bit 0 the first) that also stand in a fragment of a smaller owner."""
    lengths = np.fromiter(map(len, contents), np.int64, len(contents))
    t = np.frombuffer(bytes([_GAP]).join(contents) + bytes([_GAP]), np.uint8)
    begin = np.cumsum(lengths + 1) - lengths - 1
    windows = lengths - LENGTH + 1
    fragment = np.full(len(t), -1)
    inside = np.repeat(begin, windows) + (offset := np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows))
    fragment[inside] = np.repeat(np.arange(len(contents)), windows)
    eights = _eights(t)
    order = suffix_array(t, LENGTH, eights, fragment >= 0)
    groups = np.flatnonzero(common_prefixes(order, eights) < LENGTH)
    owner = owners[fragment[order]]
    least = np.repeat(np.minimum.reduceat(owner, groups), np.diff(np.append(groups, len(order)))) if len(order) else owner
    goes = np.zeros(len(t), np.uint64)
    goes[order] = least < owner
    masks = np.bitwise_or.reduceat(goes[inside] << offset.astype(np.uint64), np.cumsum(windows) - windows)
    return masks.view(np.int64)


# --- anchors and fragments of texts


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from every position that has so many."""
    eights, count = _eights(data), len(data) - GRAM + 1
    return mix(eights[:count] * _BASE + eights[GRAM - 8 :][:count])


def fragments(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: text, first byte in all bytes, number of windows, anchor; and bytes and offsets."""
    data, offsets = buffers(texts)
    count = len(data) - LENGTH + 1
    if count <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none, data, offsets
    least = _gram_hashes(data)
    size = 1
    while 2 * size <= STRETCH:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:count], least[STRETCH - size : STRETCH - size + count]).view(np.int64)
    whole = np.ones(len(data), bool)
    ahead = np.unique(offsets)[:, None] - np.arange(1, LENGTH)  # windows from there reach into the next text
    whole[ahead[ahead >= 0]] = False
    whole = whole[:count]
    begins = whole.copy()
    begins[1:] &= ~whole[:-1] | (least[1:] != least[:-1])
    first = np.flatnonzero(begins)
    ends = whole.copy()
    ends[:-1] &= begins[1:] | ~whole[1:]
    run = np.flatnonzero(ends) + 1 - first
    # Runs over repeating text are cut into fragments of bounded length.
    parts = -(-run // STRETCH)
    which = np.repeat(np.arange(len(first)), parts)
    step = (np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)) * STRETCH
    start = first[which] + step
    text = np.searchsorted(offsets, start, "right") - 1
    return text, start, np.minimum(run[which] - step, STRETCH), least[start], data, offsets


def _lists(ids: np.ndarray, values: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Different ids in order, and for each the list of its values; equal values of an id once if they are in order."""
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order]
    other = np.append(True, ids[1:] != ids[:-1])[: len(ids)]
    fresh = other | np.append(True, values[1:] != values[:-1])[: len(ids)]
    ids, values, other = ids[fresh], values[fresh], other[fresh]
    first = np.flatnonzero(other)
    return pa.array(ids[first]), pa.ListArray.from_arrays(pa.array(np.append(first, len(ids)).astype(np.int32)), pa.array(values))


def shared_anchors(docs: DataFrame, buckets: int) -> DataFrame:
    """id, anchors: anchors of a document that another document has as well.

    A row is what a task sends to a bucket: lists of anchors with the smallest and largest document that has them.
    """

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, anchors, held = [], [], 0
        names = ["bucket", "id", "anchors", "low", "high"]

        def flush() -> Iterator[pa.RecordBatch]:
            i, a = np.concatenate(ids), np.concatenate(anchors)
            order = np.argsort(a)
            i, a = i[order], a[order]
            first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
            low, high = np.minimum.reduceat(i, first), np.maximum.reduceat(i, first)
            bucket = (a[first].view(np.uint64) % np.uint64(buckets)).astype(np.min_scalar_type(buckets))
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            begin = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            cuts = pa.array(np.append(begin, len(bucket)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x[order])) for x in (a[first], low, high)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[begin].astype(np.int64)), pa.nulls(len(begin), pa.int64()), *lists], names=names)
            known = np.repeat(low < high, np.diff(np.append(first, len(a))))  # two documents of this chunk have it
            id_, lists = _lists(i[known], a[known])
            anywhere = (mix(id_.to_numpy().view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            none = pa.nulls(len(id_), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(anywhere), id_, lists, none, none], names=names)

        for batch in pieces(batches, limit=PIECE_BYTES):
            text, _, _, anchor, data, _ = fragments(batch.column("text"))
            if len(text):
                ids.append(batch.column("doc_id").to_numpy(zero_copy_only=False)[text])
                anchors.append(anchor)
            held += len(data)
            if held > CHUNK_BYTES and ids:
                yield from flush()
                ids, anchors, held = [], [], 0
        if ids:
            yield from flush()

    def meet(table: pa.Table) -> pa.Table:
        """Anchors that one document of a chunk has and one of another chunk; lists of what is known already pass by."""
        sent = pc.is_null(table.column("id"))
        passed, table = table.filter(pc.invert(sent)).select(["id", "anchors"]), table.filter(sent)
        a, low, high = (pc.list_flatten(table.column(c)).to_numpy() for c in ("anchors", "low", "high"))
        if not len(a):
            return passed
        order = np.argsort(a)
        a, low, high = a[order], low[order], high[order]
        first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        several = np.minimum.reduceat(low, first) < np.maximum.reduceat(high, first)
        fresh = (low == high) & np.repeat(several, np.diff(np.append(first, len(a))))
        ids, lists = _lists(low[fresh], a[fresh])
        return pa.concat_tables([passed, pa.table({"id": ids, "anchors": lists}).cast(passed.schema)])

    rows = docs.select("doc_id", "text").mapInArrow(job, "bucket long, id long, anchors array<long>, low array<long>, high array<long>")
    shared = rows.groupBy("bucket").applyInArrow(meet, "id long, anchors array<long>")
    return shared.groupBy("id").agg(F.flatten(F.collect_list("anchors")).alias("anchors"))


def _first_sent(mark: np.ndarray, owner: np.ndarray, marks: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Which rows have to carry their bytes: of each mark the smallest owner, unless one as small is remembered.

    ``marks`` and ``owners`` are the memory, a place by remainder; a mark whose place another one took is sent again.
    """
    order = np.lexsort((owner, mark))
    least = order[np.append(True, mark[order][1:] != mark[order][:-1])]
    place = mark[least] & (len(marks) - 1)
    least, place = least[new := (marks[place] != mark[least]) | (owners[place] > owner[least])], place[new]
    # Of two marks for one place the last is kept, in both arrays alike.
    taken = np.unique(place[::-1], return_index=True)[1]
    kept = least[::-1][taken]
    marks[place[::-1][taken]], owners[place[::-1][taken]] = mark[kept], owner[kept]
    fresh = np.zeros(len(mark), bool)
    fresh[least] = True
    return fresh


def shared_fragments(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """id, row, at, windows, mark, anchor, content: fragments at shared anchors.

    A task sends bytes and anchor of equal ones once, with their smallest document.
    """

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(HELD_FRAGMENTS, np.int64), np.full(HELD_FRAGMENTS, np.iinfo(np.int64).max)  # marks, smallest documents
        for batch in pieces(batches, limit=PIECE_BYTES):
            text, start, windows, anchor, data, offsets = fragments(batch.column("text"))
            wanted = batch.column("anchors")
            of_text = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
            salt = np.uint64(0x9E3779B97F4A7C15)
            both = lambda a, k: a.view(np.uint64) ^ ((k.astype(np.uint64) + np.uint64(1)) * salt)
            listed = wanted.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            hit = np.isin(both(np.ascontiguousarray(anchor), text), both(np.ascontiguousarray(listed), of_text))
            text, start, windows, anchor = text[hit], start[hit], windows[hit], anchor[hit]
            if not len(text):
                continue
            end = start + windows + LENGTH - 1
            mark = span_hashes(_BYTE_CODE[data], start, end).view(np.int64)
            owner = batch.column("doc_id").to_numpy(zero_copy_only=False)[text]
            fresh = _first_sent(mark, owner, *held)
            raw = data.tobytes()
            contents = [raw[a:b] if f else None for f, a, b in zip(fresh.tolist(), start.tolist(), end.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner), batch.column("row").take(pa.array(text)), pa.array(start - offsets[text]), pa.array(windows.astype(np.int8)), pa.array(mark), pa.array(anchor, mask=~fresh), pa.array(contents, pa.binary())],
                names=["id", "row", "at", "windows", "mark", "anchor", "content"],
            )

    rows = docs.join(lists, docs["doc_id"] == lists["id"]).select("doc_id", F.xxhash64("text").alias("row"), "text", "anchors")
    return rows.mapInArrow(job, "id long, row long, at long, windows byte, mark long, anchor long, content binary")


def _sorted_masks(contents: DataFrame, buckets: int) -> DataFrame:
    """mark, mask: by suffix arrays over buckets of whole anchors."""

    def job(table: pa.Table) -> pa.Table:
        anchor, mark, owner = (table.column(c).to_numpy() for c in ("anchor", "mark", "id"))
        order = np.argsort(mark)
        first = np.flatnonzero(np.append(True, mark[order][1:] != mark[order][:-1]))
        chosen, owner = order[first], np.minimum.reduceat(owner[order], first)  # of each fragment the smallest document
        _, place, count = np.unique(anchor[chosen], return_inverse=True, return_counts=True)
        several = count[place] > 1  # a fragment alone has nothing to meet
        chosen, owner = chosen[several], owner[several]
        masks = repeated_windows(table.column("content").take(pa.array(chosen)).to_pylist(), owner) if len(chosen) else np.zeros(0, np.int64)
        found = masks != 0
        give_back()
        return pa.table({"mark": pa.array(mark[chosen[found]]), "mask": pa.array(masks[found])})

    bucketed = contents.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
    return bucketed.select("bucket", "anchor", "mark", "id", "content").groupBy("bucket").applyInArrow(job, "mark long, mask long")


def _window_masks(contents: DataFrame) -> DataFrame:
    """mark, mask: for crowded anchors, window by window."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "content"):
            data, offsets = buffers_of(batch.column("content"))
            windows = np.diff(offsets) - LENGTH + 1
            which = np.repeat(np.arange(batch.num_rows), windows)
            place = np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows, windows)
            start = offsets[which] + place
            take = pa.array(which)
            yield pa.RecordBatch.from_arrays(
                [batch.column("mark").take(take), batch.column("low").take(take), pa.array(place.astype(np.int32)), pa.array(span_hashes(_BYTE_CODE[data], start, start + LENGTH).view(np.int64))],
                names=["mark", "low", "place", "window"],
            )

    contents = contents.groupBy("mark").agg(F.min("id").alias("low"), F.max("content").alias("content"))
    windows = contents.select("mark", "low", "content").mapInArrow(job, "mark long, low long, place int, window long")
    least = windows.groupBy("window").agg(F.min("low").alias("least"), F.count("*").alias("n"))
    met = attach(windows, least, "window", "n", ["mark", "place"]).where("least < low")
    return met.groupBy("mark").agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("mask"))


def buffers_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary array without nulls."""
    wide = column.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    offsets = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def repeated(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, most_fragments: int = MOST_FRAGMENTS) -> DataFrame:
    """id, row (tells rows of one id apart), at, mask: of documents that lose bytes the fragments and which of their windows go."""
    own = docs.where("doc_id IS NOT NULL AND length(text) > 0").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    lists = stored(shared_anchors(own, max(1, -(-size // bucket_bytes))), "anchors")
    found = stored(shared_fragments(own, lists), "fragments")
    drop(lists)
    grouped = found.groupBy("mark").agg(F.max("anchor").alias("anchor"), F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n"), F.max("windows").alias("windows"))
    marks = stored(grouped, "marks")
    total = marks.agg(F.coalesce(F.sum(F.col("windows") + LENGTH), F.lit(0)).alias("n")).first()["n"]
    crowded = stored(marks.groupBy("anchor").count().where(F.col("count") > most_fragments).select("anchor"), "crowded")
    contents = found.where("content IS NOT NULL").select("id", "anchor", "mark", "content")
    buckets = max(1, -(-total // bucket_bytes))
    many = crowded.count()
    if many:
        few = F.broadcast(crowded) if many <= MOST_BROADCAST else crowded
        masks = _sorted_masks(contents.join(few, "anchor", "left_anti"), buckets).unionByName(_window_masks(contents.join(few, "anchor", "left_semi")))
    else:
        masks = _sorted_masks(contents, buckets)
    masks = stored(masks, "masks")
    table = stored(marks.select("mark", "low", "high", "n").join(masks, "mark", "left").where("high > low OR mask IS NOT NULL").drop("high"), "repeated")
    drop(marks)
    met = attach(found.select("id", "row", "at", "windows", "mark"), table, "mark", "n", ["id", "at"]).where("low IS NOT NULL")
    gone = F.when(F.col("id") > F.col("low"), F.expr("shiftleft(1L, windows) - 1")).otherwise(F.coalesce("mask", F.lit(0)))
    spans = met.select("id", "row", "at", gone.alias("mask")).where("mask <> 0").groupBy("id", "row").agg(F.collect_list("at").alias("at"), F.collect_list("mask").alias("mask"))
    out = stored(spans, "spans")
    for table in (found, masks, table):
        drop(table)
    return out


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, kept (the remaining bytes) and spans (removed runs of bytes, as begin and end) of every row."""
    marks = repeated(docs, **options).withColumnRenamed("id", "doc_id")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("row")).join(marks, ["doc_id", "row"], "left")

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.arange(STRETCH)
        for batch in pieces(batches):
            sizes, kept, spans = [], [], []
            ats, masks = batch.column("at"), batch.column("mask")
            for k, text in enumerate(batch.column("text").to_pylist()):
                data = (text or "").encode()
                sizes.append(len(data))
                if not ats[k].is_valid:
                    kept.append(data)
                    spans.append([])
                    continue
                at, mask = ats[k].values.to_numpy(), masks[k].values.to_numpy()
                starts = (at[:, None] + bits)[(mask[:, None] >> bits) & 1 == 1]
                edge = np.bincount(starts, minlength=len(data) + 1)[: len(data) + 1] - np.bincount(starts + LENGTH, minlength=len(data) + 1)
                covered = np.cumsum(edge)[:-1] > 0
                turns = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
                spans.append([{"begin": a, "end": b} for a, b in turns.reshape(-1, 2).tolist()])
                kept.append(np.frombuffer(data, np.uint8)[~covered].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "n_bytes", "kept", "spans"],
            )

    return rows.select("doc_id", "text", "at", "mask").mapInArrow(
        job, "doc_id long, n_bytes long, kept binary, spans array<struct<begin: long, end: long>>"
    )


def report(docs: DataFrame, **options) -> DataFrame:
    """Per row: bytes, removed bytes, removed runs and the digest of what remains."""
    removed = (F.col("n_bytes") - F.length("kept")).cast("long")
    return deduplicated(docs, **options).select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
