"""Decontamination, quality rules, encoding and license scans against plain versions and planted cases."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ebbtide.llm import bpe, decontaminate, licenses, quality
from tests.llm.brute import frame, lower, passage

EDGES = [(1, None), (2, ""), (3, " \n\t "), (None, "no id here"), (4, "twice"), (4, "twice"), (5, "x" * 5000), (6, "a\nb " * 3000)]


# --- decontamination


def brute_hits(text, items, window=10):
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words, hit, names = cut.findall(lower(text)), set(), set()
    for item, t in items:
        own = cut.findall(lower(t))
        size = min(window, len(own))
        for k in range(len(own) - size + 1 if size else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == own[k : k + size]:
                    hit.update(range(at, at + size))
                    names.add(str(item))
    return len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def test_decontamination_matches_brute_force(spark):
    item = passage("q", 14)
    items = [(1, item), (2, "Short one, HERE"), (3, None), (4, " "), (5, passage("q", 14)), (6, "ß é"), (10, passage("r", 10))]
    rows = EDGES + [
        (10, f"before {item} after"), (11, item.upper()), (12, passage("q", 9)), (13, "well short One here short one here"), (14, "ß-é!é ß é"),
        (15, f"{item}\n{item}"), (16, passage("q", 14).replace(" ", ", ")), (17, passage("r", 10) * 1 + " " + passage("q", 11)), (18, "short one" + " here"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (1, 1 << 20):
        got = decontaminate.report(frame(spark, rows), bench, block_bytes=block).collect()
        want = Counter((i, *brute_hits(t, items)) for i, t in rows)
        assert Counter(tuple(r) for r in got) == want


def test_decontamination_random_sequences(spark):
    random.seed(3)
    text = lambda n: " ".join(random.choice("abcd") for _ in range(n))
    rows = [(k, text(random.randrange(0, 60))) for k in range(60)]
    items = [(k, text(random.randrange(1, 14))) for k in range(12)]
    got = decontaminate.report(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), window=5).collect()
    assert Counter(tuple(r) for r in got) == Counter((i, *brute_hits(t, items, 5)) for i, t in rows)


def test_removal_cuts_only_the_spans(spark):
    item = passage("q", 12)
    rows = [(1, f"keep this, {item}! and this"), (2, "clean text"), (3, None), (4, item)]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = frame(spark, rows).selectExpr("*", "lang AS n_words", "1 AS hit")
    got = {r["doc_id"]: r for r in decontaminate.removed(docs, bench).collect()}
    assert got[1]["text"] == "keep this, ! and this" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] == "clean text" and got[3]["text"] is None and got[4]["text"] == "" and got[1]["n_words"] == "en"
    assert decontaminate.report(frame(spark, []), bench).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.report(frame(spark, rows), bench.limit(0)).collect())


def test_index_finds_all_occurrences():
    random.seed(1)
    sequence = np.array([random.choice([0, 1, 2, 3]) for _ in range(500)] + [0])
    index = decontaminate.FMIndex(sequence, 3)
    for size in (1, 2, 3, 6):
        patterns = np.array([[random.choice([1, 2, 3]) for _ in range(size)] for _ in range(30)])
        which, places = index.search(patterns)
        want = {(k, at) for k, p in enumerate(patterns.tolist()) for at in range(len(sequence) - size) if sequence[at : at + size].tolist() == p}
        assert set(zip(which.tolist(), places.tolist())) == want


# --- quality rules


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    hit = {at for k in range(len(words) - 7) if grams[tuple(words[k : k + 8])] > 1 for at in range(k, k + 8)}
    seen, equal = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            equal += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), equal, len(hit), len(words) < 20 or 100 * len(hit) > 30 * len(words)


def corpus():
    random.seed(5)
    word = lambda: "".join(random.choice("etaonrish") for _ in range(random.randrange(2, 8)))
    prose = lambda: "\n".join(" ".join(word() for _ in range(random.randrange(8, 20))).capitalize() + "." for _ in range(5))
    junk = [lambda: " ".join(word() + random.choice(["###", "$$$", "***"]) for _ in range(60)), lambda: " | ".join(word() for _ in range(60)), lambda: " ".join(word().upper() + "!!" for _ in range(50))]
    good, bad = [(k, prose()) for k in range(80)], [(100 + k, junk[k % 3]()) for k in range(60)]
    return good, bad


def test_quality_counts_and_verdicts(spark):
    good, bad = corpus()
    rows = EDGES + [(1000 + i if i is not None else None, t) for i, t in good + bad]
    labels = spark.createDataFrame([(1000 + i, 1, 0) for i, _ in good[:50]] + [(1000 + i, 0, 0) for i, _ in bad[:30]] + [(None, 1, 0), (1000, None, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    got = quality.report(docs, labels).collect()
    assert Counter((r["doc_id"], *tuple(r)[1:7]) for r in got) == Counter((i, *brute_counts(t)) for i, t in rows)
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert {1000 + i for i, _ in good[50:]} <= kept and not kept & {1000 + i for i, _ in bad[30:]}  # documents the fit has not seen
    clashing = quality.keep(docs.selectExpr("*", "1 AS kept", "2 AS n_words"), labels)
    assert {r["doc_id"] for r in clashing.collect()} == kept and clashing.columns[-2:] == ["kept", "n_words"]
    assert quality.report(frame(spark, []), labels).count() == 0
    assert all(r["kept"] != r["base_failed"] for r in quality.report(docs, labels.limit(0)).collect())


def test_viterbi_and_marginals_against_enumeration():
    from itertools import product

    rng = np.random.default_rng(2)
    first = np.array([0, 3, 3, 4, 9])
    emission, transition = rng.normal(size=(9, 2)), rng.normal(size=(2, 2))
    states = quality.viterbi(emission, transition, first)
    p, pairs = quality.marginals(emission, transition, first)
    expected = np.zeros((2, 2))
    for a, b in zip(first[:-1], first[1:]):
        score = lambda s: sum(emission[a + k, x] for k, x in enumerate(s)) + sum(transition[x, y] for x, y in zip(s, s[1:]))
        paths = list(product((0, 1), repeat=b - a))
        assert a == b or tuple(states[a:b]) == max(paths, key=score)
        weights = np.exp([score(s) for s in paths])
        weights /= weights.sum()
        for s, w in zip(paths, weights):
            for x, y in zip(s, s[1:]):
                expected[x, y] += w
        for k in range(b - a):
            assert np.isclose(p[a + k, 1], sum(w for s, w in zip(paths, weights) if s[k] == 1))
    assert np.allclose(pairs, expected)


# --- encoding

TEXTS = [
    "I'm he'll\n\n\n x\t\ty", "a<|endoftext|>b <|endoftext|><|endoftext|>", "x" * 700, "é" * 70 + "日本語テキスト", "\x00\x01", "!!!!????" * 30, "  　x ", "12345 67 8",
    "aaaaaaaaaaaaaaaaa", "İ ß 😀😀", "'s's 'S", "\r\n\r\n x", "ababababab" * 9, "The The the and of to", "\0<|endoftext|>",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.vocabulary_file())
    t.no_truncation()
    t.no_padding()
    return t


def test_encoding_equals_the_library(spark, library):
    rows = EDGES + [(100 + k, t) for k, t in enumerate(TEXTS)]
    docs = frame(spark, rows).selectExpr("*", "1 AS ids", "2 AS n_tokens")
    for size in (1, 20, 1000):
        got = Counter((r["doc_id"], r["n_tokens"], tuple(r["ids"]), r["ids_sha256"], r["decoded_sha256"]) for r in bpe.encoded(docs, lexicon_words=size).collect())
        want = Counter()
        for i, t in rows:
            ids = library.encode(t or "", add_special_tokens=False).ids
            sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
            want[(i, len(ids), tuple(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))] += 1
        assert got == want
    assert bpe.encoded(frame(spark, [])).count() == 0


def test_decoding_is_a_round_trip(spark, library):
    docs = frame(spark, [(k, t) for k, t in enumerate(TEXTS)])
    assert {r["doc_id"]: r["text"] for r in bpe.decoded(bpe.encoded(docs)).collect()} == dict(enumerate(TEXTS))
    broken = spark.createDataFrame([(1, [200, 50256]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in bpe.decoded(broken).collect()}
    assert got == {1: library.decode([200, 50256], skip_special_tokens=False), 2: "", 3: ""}


def test_transducer_is_exact_and_minimal():
    words = sorted(x.encode() for x in ["tops", "top", "stops", "stop", "tap", "taps", "é"])
    automaton = bpe.Transducer.compile(words)
    assert automaton.numbers(words + [b"to", b"topsy", b""]).tolist() == [*range(len(words)), -1, -1, -1]
    suffixes = {frozenset(w[len(p):] for w in words if w.startswith(p)) for w in words for p in (w[:k] for k in range(len(w) + 1))}
    assert len(automaton.final) == len(suffixes)  # a state per distinct set of endings


# --- licenses


def test_license_scan(spark):
    notice = licenses.TEMPLATES["MIT"][2]
    rows = EDGES + [
        (10, "Text before. Licensed under the Apache License, Version 2.0. And more text follows here."), (11, "Licensed under the Apache License, Version 1.1."),
        (12, "He had a license to drive and published it."), (13, f"intro\n{notice}.\nend"), (14, notice.replace("free of charge", "without any charge")),
        (15, "This work is licensed under the GNU General Public License, version 3.\nReleased under the MIT License."), (16, "Released  under the\tMIT License"),
        (17, "Licensed under CC BY 4.0. Licensed under CC BY-NC 4.0."), (18, "filler words " * 4000 + "Released under the MIT License."),
    ]
    got = {r["doc_id"]: r for r in licenses.report(frame(spark, rows)).collect()}
    names = {i: got[i]["licenses"] for i in range(10, 19)}
    assert names == {10: "Apache-2.0", 11: "", 12: "", 13: "MIT", 14: "MIT", 15: "GPL-3.0,MIT", 16: "MIT", 17: "CC-BY-4.0,CC-BY-NC-4.0", 18: "MIT"}
    assert "without" in got[14]["differences"] and got[13]["differences"] == "" and got[11]["n_blocks"] == 2 and got[1]["n_blocks"] == 0
    assert licenses.report(frame(spark, [])).count() == 0


DISCLAIMER = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED. " * 3


def test_every_wording_has_its_own_name(spark):
    wordings = [(n, w) for n, ws in licenses.TEMPLATES.items() for w in [*ws, *[f"SPDX-License-Identifier: {i}" for i in licenses.SPDX[n]]]]
    rows = [(k, w) for k, (_, w) in enumerate(wordings)]
    rows += [(1000 + k, f"Some words before it.\n{w}\n{DISCLAIMER}") for k, (_, w) in enumerate(wordings)]
    got = {r["doc_id"]: r["licenses"] for r in licenses.report(frame(spark, rows)).collect()}
    assert [(n, got[k], got[1000 + k]) for k, (n, _) in enumerate(wordings)] == [(n, n, n) for n, _ in wordings]


def test_a_variant_without_a_wording_is_not_taken_for_another():
    scan = lambda text: [f.license for f in licenses.Scanner().scan(text)[1]]
    for old, new in [("Attribution 4.0", "Attribution-NonCommercial-NoDerivatives 4.0"), ("Attribution 4.0", "Attribution-NonCommercial-ShareAlike 4.0"), ("4.0", "3.0")]:
        assert scan(licenses.TEMPLATES["CC-BY-4.0"][1].replace(old, new)) == []
    assert scan(licenses.TEMPLATES["AGPL-3.0"][1].replace("version 3", "version 2")) == []
    assert scan("SPDX-License-Identifier: Zlib") == []


def test_wording_differences_against_brute_force():
    random.seed(4)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
            row = new
        return row[-1]

    for _ in range(60):
        a, b = ([random.choice("abc") for _ in range(random.randrange(1, 7))] for _ in range(2))
        total, missing, added, used = licenses.wording_differences(a, b)
        assert total == min(distance(a, b[j:k]) for k in range(len(b) + 1) for j in range(k + 1))
        assert max(len(missing), len(added)) <= total <= len(missing) + len(added)
        assert total == min(distance(a, b[j:used]) for j in range(used + 1))


def test_pieces_keep_every_row():
    from ebbtide.llm.words import pieces

    batch = pa.record_batch({"text": pa.array(["abc", None, "x" * 50, "", "yy"])})
    assert [t for p in pieces([batch], limit=4) for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()


def test_narrow_pattern_cuts_like_the_wide_one():
    import regex

    random.seed(8)
    wide, cut = regex.compile(bpe.PATTERN).findall, bpe.word_cutter()
    for k in range(256):
        for text in (chr(k), f"a{chr(k)}1", f" {chr(k)} {chr(k)}{chr(k)}b", f"{chr(k)}\n \t{chr(k)}"):
            assert cut(text) == wide(text)
    for top in (128, 256, 0x2FFF):
        for _ in range(300):
            text = "".join(random.choice((chr(random.randrange(top)), " ", "\n", "e", "7", "'", "ll")) for _ in range(60))
            assert cut(text) == wide(text)
