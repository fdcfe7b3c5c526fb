"""Byte-pair encoding with a transducer lexicon of frequent words, and decoding.

The words of all documents are counted once; the most frequent ones are encoded and compiled into a minimal
acyclic transducer: equal suffixes share states, and numbers on the arcs add up to the number of the word,
which points to its token ids. The arrays go to the executors as one file each and are memory-mapped there.
Words outside the lexicon are merged exactly, many at a time, by the ranks of the vocabulary. The result
does not depend on the lexicon, only the speed does.

Defined results: null is an empty text without tokens; special tokens standing in a text get their own id,
as the vocabulary file defines them; repeated rows are encoded one by one; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import sha256
from io import BytesIO
from itertools import chain
from uuid import uuid4

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbtide.llm.shared import put
from ebbtide.llm.words import buffers, give_back, pieces

LEXICON_WORDS = 1 << 17  # bound of the transducer; other words are merged on their own
CACHE_WORDS = 1 << 18  # words a task remembers between pieces
#: Pre-tokenisation of byte-level vocabularies (fixed: the file's ids depend on it).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same over the first 256 characters, where the classes can be listed; the standard library is faster at it.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
NARROW = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
PIECE = 4 << 20  # bytes of text whose new words are merged together
_WIDE = 64  # longer words are merged one at a time


def vocabulary_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Vocabulary:
    """Merges and token bytes of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        ids, letters = content["model"]["vocab"], _byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in ids.items():
            self.token_bytes[i] = token.encode() if token in self.special else bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.of_byte = np.array([ids[c] for c in letters], np.int64)
        self.size = size
        rows = []
        for rank, pair in enumerate(content["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            rows.append((ids[a] * size + ids[b], rank, ids[a + b]))
        table = np.array(sorted(rows), np.int64)
        self.pairs, self.ranks, self.merged = table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()
        self.none = len(rows)  # rank of pairs that do not merge
        self.by_rank = np.empty(len(rows), np.int64)
        self.by_rank[self.ranks] = self.merged
        # Slots of an open hash table over the pairs, for lookups of whole arrays.
        self.bits = 18
        self.slots = np.full(1 << self.bits, -1, np.int64)
        left = np.arange(len(self.pairs))
        slot = self._slot(self.pairs)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            lost = self.slots[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, or ``none``; negative ids never merge."""
        keys = left * self.size + right
        out = np.full(len(keys), self.none, np.int64)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        slot = self._slot(keys[at])
        while len(at):
            entry = self.slots[slot]
            hit = (entry >= 0) & (self.pairs[entry] == keys[at])
            out[at[hit]] = self.ranks[entry[hit]]
            go = (entry >= 0) & ~hit
            at, slot = at[go], (slot[go] + 1) & ((1 << self.bits) - 1)
        return out

    def merge_one(self, word: bytes) -> list[int]:
        """Token ids of one word of any length, by a heap of candidate merges."""
        ids = self.of_byte[np.frombuffer(word, np.uint8)]
        n = len(ids)
        first = self.rank_of(ids[:-1], ids[1:])
        heap = [(int(r), i, int(ids[i]), int(ids[i + 1])) for i, r in enumerate(first) if r < self.none]
        heapq.heapify(heap)
        ids, after, before = ids.tolist(), [*range(1, n), -1], [*range(-1, n - 1)]
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else -1
            if j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = int(self.by_rank[rank]), -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0:
                    r = int(self.rank_of(np.array([ids[x]]), np.array([ids[y]]))[0])
                    if r < self.none:
                        heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def merge_many(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of many words; words of similar length advance together, one merge a step."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        out: list[list[int]] = [[]] * len(words)
        for low, high in ((0, 8), (8, 12), (12, 16), (16, 24), (24, _WIDE)):
            chosen = np.flatnonzero((lengths > low) & (lengths <= high))
            for begin in range(0, len(chosen), 1 << 15):
                part = chosen[begin : begin + (1 << 15)]
                for k, ids in zip(part.tolist(), self._merge_block([words[i] for i in part.tolist()], lengths[part], high)):
                    out[k] = ids
        for k in np.flatnonzero(lengths > _WIDE).tolist():
            out[k] = self.merge_one(words[k])
        return out

    def _merge_block(self, words: list[bytes], lengths: np.ndarray, width: int) -> list[list[int]]:
        n = len(words)
        ids = np.full((n, width + 1), -1, np.int64)
        filled = np.arange(width)[None, :] < lengths[:, None]
        ids[:, :width][filled] = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        ranks = self.rank_of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width)
        live = np.arange(n)
        length = lengths.copy()
        while len(live):
            at = ranks[live].argmin(1)
            best = ranks[live, at]
            go = best < self.none
            live, at, best = live[go], at[go], best[go]
            if not len(live):
                break
            # Close the gap: what stands right of the merged pair moves one place left.
            columns = np.arange(width)[None, :]
            source = np.minimum(columns + (columns > at[:, None]), width)
            row = ids[live]
            moved = np.full_like(row, -1)
            moved[:, :width] = np.take_along_axis(row, source, 1)
            moved[np.arange(len(live)), at] = self.by_rank[best]
            ids[live] = moved
            r = np.full((len(live), width), self.none, np.int64)
            r[:, : width - 1] = np.take_along_axis(ranks[live], source[:, : width - 1].clip(max=width - 1), 1)
            mine = np.arange(len(live))
            r[mine, at] = self.rank_of(moved[mine, at], moved[mine, at + 1])
            left = np.flatnonzero(at > 0)
            r[left, at[left] - 1] = self.rank_of(moved[left, at[left] - 1], moved[left, at[left]])
            ranks[live] = r
            length[live] -= 1
        flat, ends = ids[:, :width][np.arange(width)[None, :] < length[:, None]].tolist(), np.cumsum(length).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends)]


class Transducer:
    """Minimal acyclic automaton over byte strings; the numbers on a word's arcs add up to its number."""

    def __init__(self, keys: np.ndarray, targets: np.ndarray, outputs: np.ndarray, final: np.ndarray):
        self.keys, self.targets, self.outputs, self.final = keys, targets, outputs, final

    @staticmethod
    def compile(words: list[bytes]) -> "Transducer":
        """From sorted distinct words: states are frozen bottom-up and looked up by their content, so equal suffixes meet."""
        register: dict[tuple, int] = {}
        frozen: list[tuple] = []  # (is final, ((byte, state), ...)) by state number
        path: list[list] = [[False, []]]  # states of the last word that can still change

        def freeze(depth: int) -> None:
            while len(path) > depth + 1:
                end, arcs = path.pop()
                content = (end, tuple(arcs))
                state = register.setdefault(content, len(frozen))
                if state == len(frozen):
                    frozen.append(content)
                above = path[-1][1]
                above[-1] = (above[-1][0], state)

        last = b""
        for word in words:
            shared = 0
            while shared < min(len(last), len(word)) and last[shared] == word[shared]:
                shared += 1
            freeze(shared)
            for byte in word[shared:]:
                path[-1][1].append((byte, -1))
                path.append([False, []])
            path[-1][0] = True
            last = word
        freeze(0)
        root = len(frozen)
        frozen.append((path[0][0], tuple(path[0][1])))
        below = [0] * len(frozen)  # words readable from a state
        keys, targets, outputs = [], [], []
        for state, (end, arcs) in enumerate(frozen):
            count = int(end)
            for byte, target in arcs:
                keys.append((root - state) << 8 | byte)
                targets.append(root - target)
                outputs.append(count)
                count += below[target]
            below[state] = count
        order = np.argsort(np.array(keys, np.int64))
        final = np.array([end for end, _ in frozen[::-1]], bool)
        return Transducer(np.array(keys, np.int64)[order], np.array(targets, np.int32)[order], np.array(outputs, np.int32)[order], final)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, or -1; all words walk together, one byte a step."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        begin = np.cumsum(lengths) - lengths
        state, number, found = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64)
        live, step = np.arange(len(words)), 0
        while len(live) and len(self.keys):
            done = lengths[live] == step
            ended = live[done]
            good = ended[self.final[state[ended]]]
            found[good] = number[good]
            live = live[~done]
            wanted = state[live] << 8 | data[begin[live] + step]
            arc = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            on = self.keys[arc] == wanted
            live, arc = live[on], arc[on]
            state[live] = self.targets[arc]
            number[live] += self.outputs[arc]
            step += 1
        return found


class Lexicon:
    """A transducer and the token ids of its words, as arrays that can be mapped from files."""

    ARRAYS = ("keys", "targets", "outputs", "final", "ids", "bounds")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.transducer = Transducer(*(arrays[a] for a in self.ARRAYS[:4]))
        self.ids, self.bounds = arrays["ids"], arrays["bounds"]

    @staticmethod
    def build(words: list[bytes], vocabulary: Vocabulary) -> dict[str, np.ndarray]:
        words = sorted(set(words))
        automaton = Transducer.compile(words)
        ids = vocabulary.merge_many(words)  # a word's number is its place in the sorted list
        bounds = np.cumsum([0, *map(len, ids)])
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(bounds[-1]))
        values = (automaton.keys, automaton.targets, automaton.outputs, automaton.final, flat, bounds.astype(np.int64))
        return dict(zip(Lexicon.ARRAYS, values))

    def look_up(self, words: list[bytes]) -> list[list[int] | None]:
        out: list[list[int] | None] = [None] * len(words)
        numbers = self.transducer.numbers(words)
        known = np.flatnonzero(numbers >= 0)
        for k, a, b in zip(known.tolist(), self.bounds[numbers[known]].tolist(), self.bounds[numbers[known] + 1].tolist()):
            out[k] = self.ids[a:b].tolist()
        return out


def publish(spark: SparkSession, arrays: dict[str, np.ndarray]) -> str:
    """Put the lexicon's files where every executor can fetch and map them; returns their common name."""
    name, files = f"lexicon-{uuid4().hex[:12]}", {}
    for key in Lexicon.ARRAYS:
        out = BytesIO()
        np.save(out, np.ascontiguousarray(arrays[key]), allow_pickle=False)
        files[f"{name}-{key}.npy"] = out.getvalue()
    for uri in put(spark, "lexicon", files):
        spark.sparkContext.addFile(uri)
    return name


_mapped: dict[str, Lexicon] = {}


def mapped(name: str) -> Lexicon:
    """The published lexicon, memory-mapped; workers of one executor share its pages."""
    if name not in _mapped:
        _mapped.clear()
        _mapped[name] = Lexicon({k: np.load(SparkFiles.get(f"{name}-{k}.npy"), mmap_mode="r") for k in Lexicon.ARRAYS})
    return _mapped[name]


def word_cutter() -> Callable[[str], list[str]]:
    """A function that cuts a text into words by PATTERN."""
    wide, narrow = regex.compile(PATTERN).findall, re.compile(NARROW).findall

    def cut(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return wide(text)
        # Four controls count as white space to one library only.
        return wide(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else narrow(text)

    return cut


class Encoder:
    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.words = word_cutter()
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")") if vocabulary.special else None
        self.known: dict[str, tuple[list[int], str, bytes]] = {}
        self.decimal = [str(i) for i in range(vocabulary.size)]

    def split(self, text: str) -> list[str]:
        """The words of a text; special tokens stand for themselves."""
        if self.special is None or not any(t in text for t in self.vocabulary.special):
            return self.words(text)
        parts = self.special.split(text)
        return [w for k, part in enumerate(parts) for w in ([("\0" + part)] if k % 2 else self.words(part))]

    def learn(self, new: list[str]) -> None:
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        marked = [w for w in new if w[0] == "\0" and w[1:] in self.vocabulary.special]
        for w in marked:
            i = self.vocabulary.special[w[1:]]
            self.known[w] = ([i], str(i), self.vocabulary.token_bytes[i])
        new = [w for w in new if w not in self.known]
        coded = [w.encode() for w in new]
        ids = self.lexicon.look_up(coded) if self.lexicon and coded else [None] * len(coded)
        unseen = [k for k, x in enumerate(ids) if x is None]
        for k, x in zip(unseen, self.vocabulary.merge_many([coded[k] for k in unseen])):
            ids[k] = x
        token, decimal = self.vocabulary.token_bytes, self.decimal
        for word, own in zip(new, ids):
            if len(own) == 1:
                self.known[word] = (own, decimal[own[0]], token[own[0]])
            else:
                self.known[word] = (own, ",".join([decimal[i] for i in own]), b"".join([token[i] for i in own]))

    def texts(self, texts: list[str | None]) -> Iterator[list[tuple[list[int], str, bytes]]]:
        """For each text its words as (ids, ids in decimal, bytes of the ids)."""
        split = [self.split(t) if t else [] for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        if new := set(chain.from_iterable(split)).difference(self.known):
            self.learn(list(new))
        known = self.known
        for words in split:
            yield [known[w] for w in words]


def decode(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    """The text of token ids, special tokens included; broken characters become U+FFFD."""
    token = vocabulary.token_bytes
    return b"".join([token[i] for i in ids]).decode("utf-8", "replace")


def count_words(docs: DataFrame) -> DataFrame:
    """Words of all texts with their counts; tasks count first and spill their counts when there are many."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = word_cutter(), Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            keys, values = list(counts), list(counts.values())
            counts.clear()
            for at in range(0, len(keys), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + 50_000], pa.string()), pa.array(values[at : at + 50_000], pa.int64())], names=["word", "n"])

        for batch in pieces(batches):
            for text in batch.column("text").to_pylist():
                if text:
                    counts.update(words(text))
            if len(counts) > 2 * CACHE_WORDS:
                yield from flush()
        yield from flush()

    return docs.select("text").mapInArrow(job, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, size: int) -> list[bytes]:
    top = count_words(docs).where(F.length("word") <= _WIDE).orderBy(F.desc("n"), "word").limit(size).select("word")
    return [w.encode() for w in top.toArrow().column("word").to_pylist()]


def lexicon_of(docs: DataFrame, vocabulary: Vocabulary, size: int = LEXICON_WORDS) -> str:
    """Compile and publish the lexicon of the most frequent words."""
    name = publish(docs.sparkSession, Lexicon.build(frequent_words(docs, size), vocabulary))
    give_back()  # the driver keeps none of it
    return name


def encoded(docs: DataFrame, path: str | None = None, lexicon_words: int = LEXICON_WORDS, with_ids: bool = True) -> DataFrame:
    """Per document: doc_id, n_tokens, ids (when asked for), and digests of the ids and of the text decoded from them."""
    path = path or vocabulary_file()
    vocabulary = Vocabulary(path)
    name = lexicon_of(docs, vocabulary, lexicon_words)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, mapped(name))
        for batch in pieces(batches, limit=PIECE):
            counts, digests, decoded, ids = [], [], [], []
            data, offsets = buffers(batch.column("text"))
            for k, words in enumerate(encoder.texts(batch.column("text").to_pylist())):
                own, decimal, raw = zip(*words) if words else ((), (), ())
                counts.append(sum(map(len, own)))
                digests.append(sha256(",".join(decimal).encode()).hexdigest())
                back = b"".join(raw)
                if back != data[offsets[k] : offsets[k + 1]].tobytes():  # bytes that are no whole characters
                    back = back.decode("utf-8", "replace").encode()
                decoded.append(sha256(back).hexdigest())
                if with_ids:
                    ids.append(np.fromiter(chain.from_iterable(own), np.int32, counts[-1]))
            out = [batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))))
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(out)])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(job, schema)


def decoded(rows: DataFrame, path: str | None = None) -> DataFrame:
    """Texts of token ids: rows (doc_id, ids) -> (doc_id, text); null ids give an empty text."""
    vocabulary = Vocabulary(path or vocabulary_file())

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode(ids or [], vocabulary) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(job, "doc_id long, text string")
