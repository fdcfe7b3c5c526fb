"""Benchmark decontamination with an FM-index over each shard of training texts.

A shard is the run of texts that a task holds at once. Its words become numbers: words that no test phrase
uses are one separator, and stretches between separators that are shorter than the shortest phrase hold no
occurrence and are left out. Over the rest stands an FM-index: a suffix array whose transform is kept in a
wavelet matrix, with every eighth suffix position sampled. All phrases are searched at once, last word
first; occurrences are located by walking back to a sampled position, and the spans they cover are merged.

Defined results: null and empty texts have no words and no hits; phrases without words are ignored;
repeated rows are judged one by one; other columns pass through. Nothing is shuffled. The phrases travel
with the tasks in blocks of bounded size, so a larger benchmark means more passes over a shard in memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ebbtide.llm.words import Words, cut, pieces

WINDOW = 10
SAMPLE = 8
BLOCK_BYTES = 32 << 20  # benchmark texts that one block of phrases is made from


@dataclass
class Phrases:
    """Windows of benchmark items as rows of word numbers, by length; number 0 stands for every other word."""

    vocabulary: np.ndarray  # sorted word hashes; the word at i has number i + 1
    by_length: dict[int, np.ndarray] = field(default_factory=dict)  # length -> distinct windows
    items: dict[int, list[list[str]]] = field(default_factory=dict)  # length -> items of each window

    @property
    def shortest(self) -> int:
        return min(self.by_length, default=0)


def phrases_of(item_ids: list, texts: list, window: int = WINDOW) -> Phrases:
    words = cut(pa.array(texts, pa.string()))
    vocabulary, numbers = np.unique(words.hashes, return_inverse=True)
    found: dict[int, dict[tuple, set]] = {}
    for k, item in enumerate(item_ids):
        own = numbers[words.first[k] : words.first[k + 1]] + 1
        size = min(window, len(own))
        for at in range(len(own) - size + 1 if size else 0):
            found.setdefault(size, {}).setdefault(tuple(own[at : at + size].tolist()), set()).add(str(item))
    return Phrases(
        vocabulary,
        {size: np.array(list(rows), np.int64).reshape(-1, size) for size, rows in found.items()},
        {size: [sorted(x) for x in rows.values()] for size, rows in found.items()},
    )


def blocks_of(benchmark: DataFrame, window: int, block_bytes: int) -> list[Phrases]:
    """The phrases in blocks. The benchmark is the query set; rows are fetched a partition at a time."""
    blocks, ids, texts, size = [], [], [], 0
    for row in benchmark.where("text IS NOT NULL").select("item_id", "text").toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1])
        if size >= block_bytes:
            blocks.append(phrases_of(ids, texts, window))
            ids, texts, size = [], [], 0
    return blocks + ([phrases_of(ids, texts, window)] if ids or not blocks else [])


class WaveletMatrix:
    """Counts of a symbol before a position, for many symbols and positions at once."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            ones = np.zeros(len(bit) + 1, np.int64)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((level, ones, len(bit) - int(ones[-1])))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        begin = np.zeros_like(at)
        for level, ones, zeros in self.levels:
            up = (symbols >> level) & 1 == 1
            at = np.where(up, zeros + ones[at], at - ones[at])
            begin = np.where(up, zeros + ones[begin], begin - ones[begin])
        return at - begin


def suffix_order(sequence: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; zeros are separators, each a symbol of its own in text order."""
    n, parted = len(sequence), sequence == 0
    rank = sequence + int(parted.sum())
    rank[parted] = np.arange(int(parted.sum()))
    step = 1
    while True:
        following = np.zeros(n, np.int64)
        following[:-step] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + following
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.zeros(n, np.int64)
        np.cumsum(ordered[1:] != ordered[:-1], out=new[1:])
        if new[-1] == n - 1:
            return order
        rank[order] = new
        step *= 2


class FMIndex:
    """Full-text index of a sequence of word numbers that ends with a separator (0)."""

    def __init__(self, sequence: np.ndarray, symbols: int, sample: int = SAMPLE):
        order = suffix_order(sequence)
        self.last = sequence[order - 1]  # the symbol before each suffix; before the first one stands the final separator
        self.below = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=symbols + 1))])
        self.tree = WaveletMatrix(self.last, max(1, int(symbols).bit_length()))
        self.sampled = (order % sample == 0) | (self.last == 0)  # a walk never needs to pass a separator
        self.places = np.where(self.sampled, order, -1)
        self.size = len(sequence)

    def _back(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.below[symbols] + self.tree.rank(symbols, at)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of patterns, position in the sequence) of every occurrence."""
        low, high, which = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size), np.arange(len(patterns))
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbols = patterns[which, column]
            low, high = self._back(symbols, low), self._back(symbols, high)
            found = high > low
            low, high, which = low[found], high[found], which[found]
        counts = high - low
        rows = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))
        return np.repeat(which, counts), self.locate(rows)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        places, walked, open_ = np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        while len(open_):
            known = self.sampled[rows]
            places[open_[known]] = self.places[rows[known]] + walked
            rows, open_ = rows[~known], open_[~known]
            rows = self._back(self.last[rows], rows)
            walked += 1
        return places


def occurrences(words: Words, phrases: Phrases) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each window length: (length, window numbers, first words in the shard) of all occurrences."""
    if not phrases.by_length or not len(words.hashes):
        return
    at = np.minimum(np.searchsorted(phrases.vocabulary, words.hashes), len(phrases.vocabulary) - 1)
    numbers = np.where(phrases.vocabulary[at] == words.hashes, at + 1, 0)
    # Stretches of known words inside one text.
    known = numbers > 0
    begin = known.copy()
    begin[1:] &= ~known[:-1]
    begin[words.first[:-1][words.counts > 0]] = known[words.first[:-1][words.counts > 0]]
    stretch = np.cumsum(begin)[known] - 1
    long = (np.bincount(stretch) >= phrases.shortest)[stretch] if len(stretch) else np.zeros(0, bool)
    kept = np.flatnonzero(known)[long]
    if not len(kept):
        return
    apart = np.flatnonzero(np.diff(stretch[long])) + 1
    sequence = np.append(np.insert(numbers[kept], apart, 0), 0)
    origin = np.append(np.insert(kept, apart, -1), -1)
    index = FMIndex(sequence, len(phrases.vocabulary))
    for size, patterns in phrases.by_length.items():
        which, places = index.search(patterns)
        yield size, which, origin[places]


class _Matcher:
    """Hits of one piece of texts: per word whether it is hit, and the (text, item) pairs that occur."""

    def __init__(self, texts: pa.Array, blocks: list[Phrases]):
        self.words = words = cut(texts)
        hit = np.zeros(len(words.hashes) + 1, np.int64)
        self.items: dict[int, set[str]] = {}
        text_of = words.text_of()
        for phrases in blocks:
            for size, which, places in occurrences(words, phrases):
                np.add.at(hit, places, 1)
                np.add.at(hit, places + size, -1)
                owners = phrases.items[size]
                for text, window in np.unique(np.stack([text_of[places], which], 1), axis=0).tolist():
                    self.items.setdefault(text, set()).update(owners[window])
        self.hit = np.cumsum(hit[:-1]) > 0

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merged removal spans: (text, first byte, end byte), each over a run of neighbouring hit words."""
        hit, words = self.hit, self.words
        text_of = words.text_of()
        begin, end = hit.copy(), hit.copy()
        begin[1:] &= ~(hit[:-1] & (text_of[1:] == text_of[:-1]))
        end[:-1] &= ~(hit[1:] & (text_of[1:] == text_of[:-1]))
        begin, end = np.flatnonzero(begin), np.flatnonzero(end)
        return text_of[begin], words.starts[begin], words.ends[end]


REPORT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: words, words inside an occurrence of a window, and the items that occur."""
    blocks = blocks_of(benchmark, window, block_bytes)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = _Matcher(batch.column("text"), blocks)
            counts = found.words.counts
            sums = np.concatenate([[0], np.cumsum(found.hit)])
            n_hit = sums[found.words.first[1:]] - sums[found.words.first[:-1]]
            none = sha256(b"").hexdigest()
            items = [found.items.get(i) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x or ()) for x in items], pa.int64()),
                    pa.array([sha256(",".join(sorted(x)).encode()).hexdigest() if x else none for x in items], pa.string()), pa.array(n_hit > 0),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return docs.select("doc_id", "text").mapInArrow(job, REPORT)


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with all hit spans cut out of their texts; every row and column stays."""
    blocks = blocks_of(benchmark, window, block_bytes)
    at = docs.columns.index("text")

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = _Matcher(batch.column(at), blocks)
            cuts: dict[int, list[tuple[int, int]]] = {}
            for text, begin, end in zip(*(x.tolist() for x in found.spans())):
                cuts.setdefault(text, []).append((begin, end))
            if cuts:
                texts, data = batch.column(at).to_pylist(), found.words.data
                for text, spans in cuts.items():
                    edges = [found.words.offsets[text], *(x for span in spans for x in span), found.words.offsets[text + 1]]
                    texts[text] = b"".join(data[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2])).decode()
                columns = batch.columns
                columns[at] = pa.array(texts, batch.schema.field(at).type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    return docs.mapInArrow(job, docs.schema)


def removed(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``remove`` with the column n_chars, where there is one, brought up to date."""
    out = remove(docs, benchmark, **options)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out
