"""Quality rules by line labels: a linear-chain conditional random field marks lines as content or boilerplate.

Every non-blank line gets a vector of shape features (symbols, capitals, repeats, length, ...). A chain with
two states is fitted in numpy on a sample of labelled documents, whose lines take the label of their
document as a weak label. Viterbi decoding of all documents of a task at once gives each line its label; a
document is kept when at least half of its words stand on content lines and no plain rule fails it.

Defined results: null and empty texts have no words and fail the length rule; without labelled documents of
both kinds the chain has zero weights and every line counts as content; repeated rows are judged one by
one; other columns pass through. One pass over the texts, nothing is shuffled but the training sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ebbtide.llm.words import SPACED, Words, cut, give_back, pieces, span_hashes

SAMPLE = 1000  # labelled documents the chain is fitted on, at most; the documented bound of the fit
LEAST_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 20, 8, 30
CONTENT_SHARE = 0.5
CONTENT, BOILERPLATE = 0, 1
FEATURES = 12

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LOWER = (_BYTE >= 97) & (_BYTE <= 122)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_SYMBOL = np.isin(_BYTE, [ord(c) for c in "#*$%&|<>"])
_SHOUT = np.isin(_BYTE, [ord("!"), ord("?")])
_START = (_BYTE & 0xC0) != 0x80  # first byte of a character


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _between(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return sums[end] - sums[begin]


def _earlier_equal(owner: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the same (owner, key) stands earlier in the order of the arrays."""
    order = np.lexsort((np.arange(len(keys)), keys, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (keys[order][1:] == keys[order][:-1])
    out = np.zeros(len(keys), bool)
    out[order[1:]] = same
    return out


class Lines:
    """Non-blank lines of a piece of texts with their words and features."""

    def __init__(self, texts: pa.Array):
        self.words = words = cut(texts, SPACED, lower=False)
        data, offsets = words.data, words.offsets
        breaks = np.flatnonzero(data == 10)
        begin = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
        begin = begin[begin < len(data)] if len(data) else begin[:0]
        end = np.concatenate([begin[1:], [len(data)]])[: len(begin)]
        end = end - (data[end - 1] == 10) if len(begin) else end
        low, high = np.searchsorted(words.starts, begin), np.searchsorted(words.starts, end)
        some = high > low
        self.begin, self.end, self.low, self.high = begin[some], end[some], low[some], high[some]
        self.text = np.searchsorted(offsets, self.begin, "right") - 1
        self.first = np.searchsorted(self.text, np.arange(len(offsets)))
        self.n_words = self.high - self.low
        self.hashes = span_hashes(_CODES[data], self.begin, self.end)
        self.repeated = _earlier_equal(self.text, self.hashes)

    def repeated_words(self) -> np.ndarray:
        """Per word: inside a window of eight words that stands in its text twice or more."""
        words = self.words
        at, grams = words.grams(REPEAT_WINDOW)
        owner = words.text_of()[at]
        key = np.lexsort((grams, owner))
        o, g = owner[key], grams[key]
        same = (o[1:] == o[:-1]) & (g[1:] == g[:-1])
        twice = np.zeros(len(key), bool)
        twice[1:] |= same
        twice[:-1] |= same
        hits = at[key[twice]]
        cover = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(cover, hits, 1)
        np.add.at(cover, hits + REPEAT_WINDOW, -1)
        return np.cumsum(cover[:-1]) > 0

    def features(self) -> np.ndarray:
        data, words, begin, end = self.words.data, self.words, self.begin, self.end
        share = lambda flags, per: _between(_sums(flags[data]), begin, end) / np.maximum(per, 1)
        size = (end - begin).astype(float)
        same_word = np.zeros(len(words.hashes), bool)
        same_word[1:] = words.hashes[1:] == words.hashes[:-1]
        repeats = _between(_sums(same_word), np.minimum(self.low + 1, self.high), self.high) / np.maximum(self.n_words - 1, 1)
        letters = _between(_sums((_UPPER | _LOWER)[data]), begin, end)
        with_symbol = np.add.reduceat(np.append(_SYMBOL[data], False), words.starts).astype(bool) if len(words.starts) else np.zeros(0, bool)
        out = np.zeros((len(begin), FEATURES))
        part = lambda x, full: np.minimum(x / full, 1.0)  # noqa: E731  shares saturate: beyond ``full`` more says no more
        out[:, 0] = 1.0
        out[:, 1] = part(share(_SYMBOL, size), 0.1)
        out[:, 2] = part(_between(_sums(with_symbol), self.low, self.high) / self.n_words, 0.3)
        out[:, 3] = _between(_sums(_UPPER[data]), begin, end) / np.maximum(letters, 1)
        out[:, 4] = part(share(_SHOUT, size), 0.1)
        out[:, 5] = share(_DIGIT, size)
        out[:, 6] = part(repeats, 0.3)
        out[:, 7] = self.repeated
        out[:, 8] = np.log1p(self.n_words) / 5
        out[:, 9] = size / np.maximum(self.n_words, 1) / 20
        out[:, 10] = self.n_words <= 3
        out[:, 11] = _between(_sums(self.repeated_words()), self.low, self.high) / self.n_words
        return out


_CODES = np.random.default_rng(7).integers(1, 1 << 63, 256).astype(np.uint64)


def _by_step(first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For step 0, 1, ...: the chains at least that long, and the index of their line at that step."""
    lengths = np.diff(first)
    chains = np.flatnonzero(lengths > 0)
    chains = chains[np.argsort(-lengths[chains], kind="stable")]
    lengths = lengths[chains]
    for step in range(int(lengths[0]) if len(lengths) else 0):
        live = chains[: int(np.searchsorted(-lengths, -step, "left"))]
        yield live, first[live] + step


def viterbi(emission: np.ndarray, transition: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best state of every line; all chains advance together, one line a step."""
    best, back = np.zeros((len(first) - 1, 2)), np.zeros((len(emission), 2), np.int8)
    steps = list(_by_step(first))
    for step, (live, at) in enumerate(steps):
        if step:
            via = best[live][:, :, None] + transition[None]
            back[at] = via.argmax(1)
            best[live] = via.max(1) + emission[at]
        else:
            best[live] = emission[at]
    state, out = best.argmax(1), np.zeros(len(emission), np.int8)
    for live, at in reversed(steps):
        now = state[live]
        out[at] = now
        state[live] = back[at, now]
    return out


def marginals(emission: np.ndarray, transition: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State probabilities of every line, and expected transition counts, by forward and backward sums."""
    n = len(emission)
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    steps = list(_by_step(first))
    for step, (_, at) in enumerate(steps):
        forward[at] = emission[at] if not step else emission[at] + np.logaddexp.reduce(forward[at - 1][:, :, None] + transition[None], axis=1)
    last = np.zeros(n, bool)
    last[first[1:][np.diff(first) > 0] - 1] = True
    for _, at in reversed(steps):
        at = at[~last[at]]
        backward[at] = np.logaddexp.reduce(transition[None] + (emission[at + 1] + backward[at + 1])[:, None, :], axis=2)
    joint = forward + backward
    total = np.logaddexp.reduce(joint, axis=1)
    inner = np.flatnonzero(~last)
    pairs = forward[inner][:, :, None] + transition[None] + (emission[inner + 1] + backward[inner + 1])[:, None, :] - total[inner][:, None, None]
    return np.exp(joint - total[:, None]), np.exp(pairs).sum(0)


def fit(features: np.ndarray, states: np.ndarray, first: np.ndarray, rounds: int = 200, rate: float = 0.1, penalty: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the emissions (features x states) and transitions, by gradient ascent with per-weight step sizes (Adam)."""
    weights, transition = np.zeros((features.shape[1], 2)), np.zeros((2, 2))
    if len(np.unique(states)) < 2:
        return weights, transition
    inner = np.ones(len(states), bool)
    inner[first[1:][np.diff(first) > 0] - 1] = False
    at = np.flatnonzero(inner)
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (states[at], states[at + 1]), 1)
    seen = features.T @ np.eye(2)[states]
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(transition), np.zeros_like(transition)]
    n = len(states)
    for step in range(1, rounds + 1):
        p, pairs = marginals(features @ weights, transition, first)
        for k, (value, gradient) in enumerate(((weights, (seen - features.T @ p) / n - penalty * weights), (transition, (seen_pairs - pairs) / n - penalty * transition))):
            moments[2 * k] = 0.9 * moments[2 * k] + 0.1 * gradient
            moments[2 * k + 1] = 0.99 * moments[2 * k + 1] + 0.01 * gradient**2
            value += rate * (moments[2 * k] / (1 - 0.9**step)) / (np.sqrt(moments[2 * k + 1] / (1 - 0.99**step)) + 1e-8)
    return weights, transition


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """The chain, fitted on at most ``sample`` labelled documents: those whose ids have the smallest hashes."""
    picked = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").where("text IS NOT NULL").orderBy("doc_id").limit(sample).toArrow()
    lines = Lines(rows.column("text"))
    states = np.where(np.array(rows.column("quality").to_pylist(), dtype=int) > 0, CONTENT, BOILERPLATE) if rows.num_rows else np.zeros(0, int)
    model = fit(lines.features(), states[lines.text], lines.first) if len(lines.text) else (np.zeros((FEATURES, 2)), np.zeros((2, 2)))
    del rows, lines, states
    give_back()  # the driver keeps none of the texts
    return model


class Verdicts:
    """Counts and verdicts of one piece of texts."""

    def __init__(self, texts: pa.Array, model: tuple[np.ndarray, np.ndarray]):
        lines = Lines(texts)
        words = lines.words
        n = len(words.first) - 1
        per_text = lambda values, at: np.bincount(at, values, n).astype(np.int64)
        self.n_words = words.counts
        chars = _sums(_START[words.data])
        self.word_chars = per_text(_between(chars, words.starts, words.ends), words.text_of())
        self.n_symbols = _between(_sums(_SYMBOL[words.data]), words.offsets[:-1], words.offsets[1:])
        self.n_dup_lines = per_text(lines.repeated, lines.text)
        self.n_repeat_words = per_text(lines.repeated_words(), words.text_of())
        self.base_failed = (self.n_words < LEAST_WORDS) | (100 * self.n_repeat_words > REPEAT_PERCENT * self.n_words)
        labels = viterbi(lines.features() @ model[0], model[1], lines.first)
        content = per_text(lines.n_words * (labels == CONTENT), lines.text)
        self.content_share = content / np.maximum(self.n_words, 1)
        self.kept = ~self.base_failed & (self.content_share >= CONTENT_SHARE)


REPORT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, content_share double"
)


def report(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Counts, the plain rules' verdict and the chain's verdict per document."""
    model = train(docs, labels, sample)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            v = Verdicts(batch.column("text"), model)
            columns = [v.n_words, v.word_chars, v.n_symbols, v.n_dup_lines, v.n_repeat_words]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *(pa.array(c, pa.int64()) for c in columns), pa.array(v.base_failed), pa.array(v.kept), pa.array(v.content_share)],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"],
            )

    return docs.select("doc_id", "text").mapInArrow(job, REPORT)


def keep(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that pass, as they are."""
    model, at = train(docs, labels, sample), docs.columns.index("text")

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, at):
            yield batch.filter(pa.array(Verdicts(batch.column(at), model).kept))

    return docs.mapInArrow(job, docs.schema)


def line_labels(texts: list[str | None], model: tuple[np.ndarray, np.ndarray]) -> list[list[str]]:
    """Labels of the non-blank lines of a few texts, for inspection."""
    lines = Lines(pa.array(texts, pa.string()))
    labels = viterbi(lines.features() @ model[0], model[1], lines.first)
    names = np.array(["content", "boilerplate"])[labels].tolist()
    return [names[a:b] for a, b in zip(lines.first[:-1], lines.first[1:])]


__all__ = ["CONTENT_SHARE", "Lines", "Verdicts", "Words", "fit", "keep", "line_labels", "marginals", "report", "train", "viterbi"]
