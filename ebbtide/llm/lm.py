"""Language-model scores from a log-bilinear neural model, trained by noise-contrastive estimation.

Words have classes: the most frequent ones a class of their own, all others one of a fixed number of classes by
their last two bytes. The model predicts the class of a token from the classes of the two before it: position
matrices times class vectors give a predicted vector, whose products with the output vectors are the scores. A
word in a shared class then gets its share of the class by add-one counts, so probabilities are normalised.

Everything the model learns from is counted over all training documents: tokens by name, and class triples.
Triples are bounded by the number of classes, so numpy fits the model on the driver: the noise term is taken in
expectation over the noise distribution instead of sampled, which makes the fit repeatable. A batched matrix
product over all pairs of context classes gives the normalised log-probabilities, which scoring looks up.

Counts of the most frequent tokens travel to the scoring tasks; all rarer tokens meet their counts in a shuffle
join, so nothing that grows with the corpus is broadcast.

Defined results: null texts are empty and consist of one end token; documents without an id are training
documents; repeated rows count and are scored one by one; without training documents every class is equally
likely; other columns are not read. Tokens are told apart by 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ebbtide.llm.shared import written
from ebbtide.llm.words import LOWER, SPACED, cut, mix, pieces

OWN_CLASSES = 96  # most frequent tokens with a class of their own, the end of a text among them
TAIL_CLASSES = 64
CLASSES = OWN_CLASSES + TAIL_CLASSES
FREQUENT = 1 << 18  # tokens whose counts travel to the scoring tasks
FOLDS, HELD_OUT = 7, 2
WIDTH, NOISE, EPOCHS, BATCH = 32, 20, 30, 1024
END = np.uint64(0x5EED_0E0D_7E87)  # stands for the end of a text
_FLUSH = 1 << 20
_SLICE = 1 << 16


@dataclass
class Tokens:
    """Tokens of a piece of texts: words, and an end after each text."""

    hashes: np.ndarray
    tails: np.ndarray  # class by last two bytes
    first: np.ndarray  # tokens of text i are first[i]:first[i + 1]

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def select(self, texts: np.ndarray) -> "Tokens":
        chosen = texts[self.text_of()]
        return Tokens(self.hashes[chosen], self.tails[chosen], np.concatenate([[0], np.cumsum(np.diff(self.first)[texts])]))


def tokens_of(texts: pa.Array) -> Tokens:
    words = cut(texts, SPACED)
    last = LOWER[words.data[words.ends - 1]].astype(np.uint64)
    before = np.where(words.ends - words.starts > 1, LOWER[words.data[words.ends - 2]], 0).astype(np.uint64)
    tails = (mix(before << np.uint64(8) | last) % np.uint64(TAIL_CLASSES)).astype(np.int64)
    stops = words.first[1:]
    return Tokens(np.insert(words.hashes, stops, END), np.insert(tails, stops, 0), words.first + np.arange(len(words.first)))


def held_out(ids: list) -> np.ndarray:
    return np.array([zlib.crc32(str(i).encode() if i is not None else b"") % FOLDS == HELD_OUT for i in ids], bool)


def token_counts(docs: DataFrame) -> DataFrame:
    """token (hash), tail, n over all training documents; tasks add up before they send."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, tails, counts, size = [], [], [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            if keys:
                own, at, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
                n = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)
                own_tails = np.concatenate(tails)[at]
                for k in range(0, len(own), 1 << 17):
                    part = slice(k, k + (1 << 17))
                    yield pa.RecordBatch.from_arrays([pa.array(own[part].view(np.int64)), pa.array(own_tails[part].astype(np.int32)), pa.array(n[part])], names=["token", "tail", "n"])

        for batch in pieces(batches):
            t = tokens_of(batch.column("text")).select(~held_out(batch.column("doc_id").to_pylist()))
            own, at, n = np.unique(t.hashes, return_index=True, return_counts=True)
            keys.append(own)
            tails.append(t.tails[at])
            counts.append(n)
            size += len(own)
            if size > _FLUSH:
                yield from packed()
                keys, tails, counts, size = [], [], [], 0
        yield from packed()

    return docs.select("doc_id", "text").mapInArrow(job, "token long, tail int, n long").groupBy("token", "tail").agg(F.sum("n").alias("n"))


class Classes:
    """Class of every token: frequent ones have their own."""

    def __init__(self, own: np.ndarray):
        own = np.concatenate([[END], own[own != END][: OWN_CLASSES - 1]]).astype(np.uint64)  # the end is class 0
        order = np.argsort(own)
        self.sorted, self.numbers = own[order], order

    def of(self, tokens: Tokens) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.sorted, tokens.hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == tokens.hashes, self.numbers[at], OWN_CLASSES + tokens.tails)


def contexts(classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of the pair of classes before each token; ends stand before the first token."""
    before, second = np.zeros_like(classes), np.zeros_like(classes)
    before[1:], second[2:] = classes[:-1], classes[:-2]
    starts = first[:-1]
    before[starts] = 0
    second[starts] = 0
    seconds = starts + 1
    second[seconds[seconds < first[1:]]] = 0
    return second * CLASSES + before


def triple_counts(docs: DataFrame, classes: Classes) -> np.ndarray:
    """Counts of (context, class) over all training documents: contexts x classes."""
    cells = CLASSES**3

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for batch in pieces(batches):
            t = tokens_of(batch.column("text")).select(~held_out(batch.column("doc_id").to_pylist()))
            own = classes.of(t)
            at, n = np.unique(contexts(own, t.first) * CLASSES + own, return_counts=True)
            total[at] += n
        for k in range(0, cells, _SLICE):
            part = total[k : k + _SLICE]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k // _SLICE], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=["slice", "packed"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, packed in zip(batch.column("slice").to_pylist(), batch.column("packed").to_pylist()):
                part = np.frombuffer(zlib.decompress(packed), np.int64)
                sums[k] = sums[k] + part if k in sums else part
        for k, part in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=["slice", "packed"])

    schema = "slice int, packed binary"
    sliced = docs.select("doc_id", "text").mapInArrow(job, schema)
    summed = sliced.repartition(64, "slice").mapInArrow(add, schema)
    out = np.zeros(cells, np.int64)
    for row in summed.toLocalIterator():  # one row per slice: bounded by the number of classes
        part = np.frombuffer(zlib.decompress(row["packed"]), np.int64)
        out[row["slice"] * _SLICE : row["slice"] * _SLICE + len(part)] += part
    return out.reshape(CLASSES * CLASSES, CLASSES)


class LogBilinear:
    """Class vectors, a matrix per context position, output vectors and biases."""

    def __init__(self, width: int = WIDTH, seed: int = 11):
        random = np.random.default_rng(seed)
        self.vectors = random.normal(0, 0.1, (CLASSES, width))
        self.positions = np.stack([np.eye(width), np.eye(width)])  # second and first token before
        self.outputs = random.normal(0, 0.1, (CLASSES, width))
        self.biases = np.zeros(CLASSES)

    def predicted(self, pairs: np.ndarray) -> np.ndarray:
        second, before = np.divmod(pairs, CLASSES)
        return self.vectors[second] @ self.positions[0] + self.vectors[before] @ self.positions[1]

    def scores(self, pairs: np.ndarray) -> np.ndarray:
        return self.predicted(pairs) @ self.outputs.T + self.biases

    def log_probabilities(self, step: int = 4096) -> np.ndarray:
        """Normalised log10 probabilities of every class in every context, by batched matrix products."""
        out = np.empty((CLASSES * CLASSES, CLASSES), np.float32)
        for k in range(0, len(out), step):
            s = self.scores(np.arange(k, min(k + step, len(out))))
            s -= s.max(1, keepdims=True)
            out[k : k + step] = (s - np.log(np.exp(s).sum(1, keepdims=True))) / np.log(10)
        return out


def fit(counts: np.ndarray, noise: int = NOISE, epochs: int = EPOCHS, rate: float = 0.02, seed: int = 5) -> LogBilinear:
    """Noise-contrastive fit: tell the seen classes of a context from ``noise`` times as many drawn by their frequency."""
    model = LogBilinear()
    total = counts.sum(0).astype(float)
    if not total.sum():
        return model
    drawn = (total + 0.5) / (total + 0.5).sum()
    model.biases = np.log(drawn)
    seen = np.flatnonzero(counts.sum(1))
    random, step = np.random.default_rng(seed), 0
    names = ("vectors", "positions", "outputs", "biases")
    first, second = ({n: np.zeros_like(getattr(model, n)) for n in names} for _ in range(2))
    steps = epochs * -(-len(seen) // BATCH)
    for _ in range(epochs):
        order = random.permutation(seen)
        for k in range(0, len(order), BATCH):
            pairs = order[k : k + BATCH]
            n = counts[pairs].astype(float)
            weight = np.sqrt(n.sum(1)) / n.sum(1)  # damps the few contexts that hold most tokens
            n *= weight[:, None]
            r = model.predicted(pairs)
            s = r @ model.outputs.T + model.biases
            true = 1 / (1 + np.exp(np.clip(np.log(noise * drawn) - s, -50, 50)))
            push = (n * (1 - true) - noise * n.sum(1)[:, None] * drawn * true) / n.sum()
            toward = push @ model.outputs
            a, b = np.divmod(pairs, CLASSES)
            vectors = np.zeros_like(model.vectors)
            np.add.at(vectors, a, toward @ model.positions[0].T)
            np.add.at(vectors, b, toward @ model.positions[1].T)
            gradients = {
                "vectors": vectors, "outputs": push.T @ r, "biases": push.sum(0),
                "positions": np.stack([model.vectors[a].T @ toward, model.vectors[b].T @ toward]),
            }
            step += 1
            pace = rate * (1 - step / (steps + 1))
            for name, g in gradients.items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                value = getattr(model, name) + pace * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-9)
                setattr(model, name, value)
    return model


@dataclass
class Scorer:
    """What the scoring tasks need; all of bounded size."""

    classes: Classes
    frequent: np.ndarray  # sorted token hashes
    weights: np.ndarray  # log10(count + 1) of them
    log_p: np.ndarray
    class_base: np.ndarray  # log10 of the mass a class shares out; 0 for classes of one token

    def piece(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: log10(count + 1) of frequent tokens, how many they are, and the model's part; rare tokens as (text, hash)."""
        text, n = tokens.text_of(), len(tokens.first) - 1
        at = np.minimum(np.searchsorted(self.frequent, tokens.hashes), max(len(self.frequent) - 1, 0))
        known = self.frequent[at] == tokens.hashes if len(self.frequent) else np.zeros(len(at), bool)
        own = self.classes.of(tokens)
        counted = np.where(known, self.weights[at] if len(self.weights) else 0.0, 0.0)
        model = self.log_p[contexts(own, tokens.first), own] - self.class_base[own]
        # Words with a class of their own need no share of it.
        shared = np.where(own >= OWN_CLASSES, counted, 0.0)
        rare = ~known
        return np.bincount(text, counted, n), np.bincount(text, known, n).astype(np.int64), np.bincount(text, model + shared, n), text[rare], tokens.hashes[rare]


_PARTS = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, counted double, model double, tokens array<long>, times array<int>"


def _parts(docs: DataFrame, scorer: Scorer) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(scorer)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, own = TaskContext.get().partitionId() << 40, shipped.value
        for batch in pieces(batches):
            t = tokens_of(batch.column("text"))
            counted, known, model, text, rare = own.piece(t)
            order = np.lexsort((rare, text))
            text, rare = text[order], rare[order]
            new = np.ones(len(rare), bool)
            new[1:] = (rare[1:] != rare[:-1]) | (text[1:] != text[:-1])
            starts = np.flatnonzero(new)
            times = np.diff(np.append(starts, len(rare)))
            bounds = pa.array(np.searchsorted(text[starts], np.arange(batch.num_rows + 1)).astype(np.int32))
            ids = batch.column("doc_id").cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + batch.num_rows)), ids, pa.array(held_out(ids.to_pylist())), pa.array(np.diff(t.first)), pa.array(known), pa.array(counted), pa.array(model),
                    pa.ListArray.from_arrays(bounds, pa.array(rare[starts].view(np.int64))), pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32))),
                ],
                names=[x.split()[0] for x in _PARTS.split(", ")],
            )
            row += batch.num_rows

    return docs.select("doc_id", "text").mapInArrow(job, _PARTS)


def scored(docs: DataFrame) -> DataFrame:
    """Every document with its add-one unigram score and the model's, both in log10."""
    counts = written(token_counts(docs), "lm-counts")
    figures = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_train, distinct = int(figures["n"]), int(figures["v"])
    top = counts.orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    tokens, n = top.column("token").to_numpy().view(np.uint64), top.column("n").to_numpy()
    classes = Classes(tokens[:OWN_CLASSES])
    order = np.argsort(tokens)
    singles = [int(x) for x in classes.sorted.view(np.int64)]
    tails = counts.where(~F.col("token").isin(singles)).groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    class_base = np.zeros(CLASSES)
    for r in tails:
        class_base[OWN_CLASSES + r["tail"]] = np.log10(r["n"] + r["v"] + 1)
    model = fit(triple_counts(docs, classes))
    scorer = Scorer(classes, tokens[order], np.log10(n[order] + 1.0), model.log_probabilities(), class_base)
    parts = written(_parts(docs, scorer), "lm-parts")
    rare = parts.select("row", F.explode(F.arrays_zip("tokens", "times")).alias("x")).select("row", F.col("x.tokens").alias("token"), F.col("x.times").alias("times"))
    met = rare.join(counts.select("token", "n"), "token")  # tokens never seen in training add nothing to either score
    sums = met.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("times").alias("met"))
    more = F.coalesce("more", F.lit(0.0))
    return parts.drop("tokens", "times").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("met", F.lit(0))).alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("counted") + more - F.col("n_tokens") * F.lit(float(np.log10(n_train + distinct + 1)))).alias("base_score"), (F.col("model") + more).alias("score"),
    )
