"""Suffix-array dedup, whitening and the source audit against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from ebbtide.llm import divergence, suffixes, whitening
from ebbtide.llm.shared import written
from ebbtide.llm.sql import SQL
from tests.llm.brute import frame, lower, passage

# --- suffix-array dedup


def brute_suffixes(rows, length=50):
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - length + 1) if i is not None else ():
            first[data[k : k + length]] = min(first.get(data[k : k + length], i), i)
    out = Counter()
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1) if i is not None else ():
            if first[data[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[i, len(data), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()] += 1
    return out


def mixed_texts(seed, n):
    """Texts cut from a common stock, so that passages of all lengths repeat, with copies, near copies and runs of one letter."""
    random.seed(seed)
    words = ["".join(random.choice("abcdeé") for _ in range(random.randrange(1, 9))) for _ in range(200)]
    stock = " ".join(random.choice(words) for _ in range(600))
    fresh = lambda k: " ".join(random.choice(words) for _ in range(k))
    rows = []
    for i in range(n):
        kind, at = random.randrange(6), random.randrange(len(stock) - 400)
        text = {0: fresh(60), 1: stock[at : at + 300], 2: fresh(10) + stock[at : at + random.randrange(40, 90)] + fresh(9), 3: "a" * random.randrange(30, 300), 4: fresh(3), 5: "ab" * 70 + fresh(4)}[kind]
        rows.append((i, text))
    rows += [(random.choice(rows)[0] + random.choice([0, 1000]), random.choice(rows)[1]) for _ in range(n // 5)]
    return rows


EDGES = [(1, None), (2, ""), (3, "short"), (None, "no id " * 20), (4, "no id " * 20), (4, "no id " * 20), (9, "y" * 49), (10, "y" * 50), (11, "y" * 51), (12, "\0\x01" * 60), (13, "x\0\x01" * 60), (14, "é" * 400), (15, "x" + "é" * 400), (5, "z" * 200_000), (6, "z" * 70)]


@pytest.mark.parametrize("options", [{}, {"most_fragments": 1}, {"bucket_bytes": 300}])
def test_suffix_dedup_matches_brute_force(spark, options):
    rows = mixed_texts(5, 90) + EDGES
    got = suffixes.report(frame(spark, rows), **options).collect()
    assert Counter(tuple(r) for r in got) == brute_suffixes(rows)


def test_suffix_dedup_over_chunks(spark):
    """Anchors meet whether one task, several or all see them."""
    rows = mixed_texts(6, 60)
    got = suffixes.report(frame(spark, rows).repartition(7)).collect()
    assert Counter(tuple(r) for r in got) == brute_suffixes(rows)


def test_suffix_dedup_hot_passage_and_empty_table(spark):
    hot = passage("h", 30)
    rows = [(i, f"{i * 7919} {hot} {i * 104729}") for i in range(300)]
    want = brute_suffixes(rows)
    assert Counter(tuple(r) for r in suffixes.report(frame(spark, rows)).collect()) == want
    for r in suffixes.deduplicated(frame(spark, rows), most_fragments=40).collect():
        text, spans = rows[r["doc_id"]][1].encode(), [tuple(s) for s in r["spans"]]
        assert len(spans) == (r["doc_id"] > 0) and all(text[a:b].count(hot.encode()) for a, b in spans)
        assert r["kept"] == (text[: spans[0][0]] + text[spans[0][1] :] if spans else text)
    assert suffixes.report(frame(spark, [])).collect() == []
    clashing = frame(spark, mixed_texts(8, 20)).selectExpr("*", "'e' AS row", "1 AS id", "2 AS at", "3 AS mask", "4 AS anchor")
    assert Counter(tuple(r) for r in suffixes.report(clashing).collect()) == brute_suffixes(mixed_texts(8, 20))


def test_two_stage_order_and_prefixes():
    rng = np.random.default_rng(3)
    for trial in range(60):
        t = rng.integers(97, 97 + rng.integers(1, 5), rng.integers(1, 250)).astype(np.uint8)
        data = t.tobytes()
        for depth in (50, 400):
            order = suffixes.suffix_array(t, depth).tolist()
            assert sorted(order) == list(range(len(data)))
            cut = [data[k : k + depth] for k in order]
            assert cut == sorted(cut)
        order = np.array([k for k in order if k + 50 <= len(data)], np.int64)
        for k, n in zip(range(1, len(order)), suffixes.common_prefixes(order, suffixes._eights(t))[1:].tolist()):
            a, b = data[order[k - 1] :][:50], data[order[k] :][:50]
            assert n == next((m for m in range(50) if a[m] != b[m]), 50)


def test_order_of_asked_positions_sorts_no_others(monkeypatch):
    """Only suffixes that start a window, and those they are induced from, are sorted."""
    rng = np.random.default_rng(4)
    sorted_directly, direct = [], suffixes._direct
    monkeypatch.setattr(suffixes, "_direct", lambda at, *rest: direct(sorted_directly.append(len(at)) or at, *rest))
    for trial in range(60):
        t = rng.integers(97, 97 + rng.integers(1, 5), rng.integers(1, 250)).astype(np.uint8)
        asked, data = rng.random(len(t)) < rng.random(), t.tobytes()
        order = suffixes.suffix_array(t, 50, asked=asked).tolist()
        assert sorted(order) == np.flatnonzero(asked).tolist()
        cut = [data[k : k + 50] for k in order]
        assert cut == sorted(cut)
        assert sorted_directly.pop() <= asked.sum()


def test_fragments_and_their_anchors():
    """Fragments hold every window once; equal windows have equal anchors, wherever they are."""
    texts = [t for _, t in mixed_texts(9, 40)] + ["", "short", None, "é" * 30, "x" * 50]
    anchors, seen = {}, Counter()
    for some in (texts, texts[::-1], texts[3:]):
        text, start, windows, anchor, data, offsets = suffixes.fragments(pa.array(some, pa.string()))
        for k, a, n, h in zip(text.tolist(), start.tolist(), windows.tolist(), anchor.tolist()):
            assert offsets[k] <= a and a + n + 49 <= offsets[k + 1]
            for at in range(a, a + n):
                window = data[at : at + 50].tobytes()
                assert anchors.setdefault(window, h) == h
                seen[window] += 1
    want = Counter(d[k : k + 50] for some in (texts, texts, texts[3:]) for d in [(t or "").encode() for t in some] for k in range(len(d) - 49))
    assert seen == want


def test_bytes_of_a_fragment_are_sent_with_its_smallest_document():
    rng = np.random.default_rng(5)
    memory, least, sent = (np.zeros(8, np.int64), np.full(8, np.iinfo(np.int64).max)), {}, {}
    for trial in range(50):
        mark, owner = rng.integers(-20, 20, 12), rng.integers(0, 1000, 12)
        fresh = suffixes._first_sent(mark, owner, *memory)
        for m, i, f in zip(mark.tolist(), owner.tolist(), fresh.tolist()):
            least[m] = min(least.get(m, i), i)
            if f:
                sent[m] = min(sent.get(m, i), i)
        assert sent == least
    again = np.zeros(3, np.int64), np.array([7, 5, 5])
    fresh_memory = np.zeros(8, np.int64), np.full(8, np.iinfo(np.int64).max)
    assert suffixes._first_sent(*again, *fresh_memory).sum() == 1 and not suffixes._first_sent(*again, *fresh_memory).any()


def test_anchors_are_shuffled_as_lists(spark):
    """A task sends a row a bucket and document, not one an anchor."""
    rows = frame(spark, [(i, passage(f"own {i}", 200)) for i in range(40)]).select("doc_id", "text").coalesce(1)
    plan = suffixes.shared_anchors(rows, 3)
    assert {r["id"]: set(r["anchors"]) for r in plan.collect()} == {}
    assert "Window" not in plan._jdf.queryExecution().toString()
    twice = rows.unionByName(rows.selectExpr("doc_id + 1000 AS doc_id", "text")).repartition(5)
    assert {r["id"]: len(r["anchors"]) == len(set(r["anchors"])) > 20 for r in suffixes.shared_anchors(twice, 3).collect()} == {i + k: True for i in range(40) for k in (0, 1000)}


# --- whitening


def reference_whitening(rows, components=16):
    rows = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    length = Counter(len(v) for _, v in rows)
    d = max(length, key=lambda k: (length[k], k))
    xs = [(i, tuple(math.floor(64 * c) + 1000000 for c in v)) for i, v in rows if len(v) == d]
    fit = sorted({x for _, x in xs})
    n, s = len(fit), [sum(x[k] for x in fit) for k in range(d)]
    y = np.array([[(n * c - t) / n for c, t in zip(x, s)] for x in fit])
    e, v = np.linalg.eigh(y.T @ y / n)
    return xs, n, s, e[::-1][:components], v[:, ::-1][:, :components], float(np.trace(y.T @ y / n))


def held(rows, got, components=16):
    xs, n, s, e, v, trace = reference_whitening(rows, components)
    e, v = e[e > 1e-9 * e[0]], v[:, e > 1e-9 * e[0]]
    assert Counter(r["vec_id"] for r in got) == Counter({i: c * len(e) for i, c in Counter(i for i, _ in xs).items()})
    x_of = defaultdict(set)
    for i, x in xs:
        x_of[i].add(x)
    signs = {}
    for r in got:
        k = r["component"] - 1
        assert r["n"] == n and r["identity_error"] <= 1e-8 and r["explained"] == pytest.approx(e[k] / trace, rel=1e-9)
        fits = []
        for x in x_of[r["vec_id"]]:
            w = float(np.dot([(n * c - t) / n for c, t in zip(x, s)], v[:, k]) / math.sqrt(e[k]))
            if r["deviation"] == sum((n * c - t) ** 2 for c, t in zip(x, s)) and abs(abs(w) - abs(r["whitened"])) < 1e-6:
                fits.append(w)
        assert fits
        if abs(fits[0]) > 1e-3 and len(x_of[r["vec_id"]]) == 1:
            assert signs.setdefault(k, fits[0] * r["whitened"] > 0) == (fits[0] * r["whitened"] > 0)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_whitening_matches_an_eigenvalue_solver(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(np.float32(c)) for c in rng.normal(size=20) * np.linspace(3, 0.2, 20)]) for k in range(150)]
    rows += [(200 + k, rows[k % 3][1]) for k in range(60)] + [(7, rows[9][1]), (None, rows[4][1])]
    extra = [(300, None), (301, []), (302, [float("nan")] * 20), (303, [1.0] * 19 + [float("inf")]), (304, [None] + [1.0] * 19), (305, [1.0] * 7)]
    got = whitening.whitened(vectors(spark, [(i, v, 0) for i, v in rows + extra]).repartition(9)).collect()
    held(rows, got)


def test_whitening_of_few_and_equal_vectors(spark):
    few = [(1, [1.0, 2.0, 3.0]), (2, [4.0, 2.0, 1.0]), (3, [4.0, 2.0, 1.0])]
    held(few, whitening.whitened(vectors(spark, [(*r, 0) for r in few])).collect())
    assert whitening.whitened(vectors(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).collect() == []
    empty = whitening.whitened(vectors(spark, []))
    assert empty.collect() == [] and empty.columns[-1] == "identity_error"
    wide = vectors(spark, [(*r, 0) for r in few]).selectExpr("*", "1 AS x", "2 AS d", "3 AS count")
    held(few, whitening.whitened(wide).collect())


def test_whitening_stays_exact_for_large_entries(spark):
    rows = [(k, [float(2**44 * (k + 1)), float(2**40 * (k * k % 7)), 1.0]) for k in range(9)]
    for r in whitening.whitened(vectors(spark, [(*r, 0) for r in rows]).selectExpr("vec_id", "cast(embedding as array<double>) AS embedding")).collect():
        xs, n, s, *_ = reference_whitening(rows)
        exact = sum((n * c - t) ** 2 for c, t in zip(dict(xs)[r["vec_id"]], s))
        assert r["deviation"] == (exact if exact < 1 << 63 else None)


@pytest.mark.parametrize("kind", ["plain", "graded", "two values", "near equal", "low rank", "whole numbers"])
def test_bidiagonal_solver(kind):
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    a = {
        "plain": lambda: rng.normal(size=(90, 30)), "graded": lambda: rng.normal(size=(90, 30)) * np.logspace(0, -6, 30), "two values": lambda: np.diag([3.0] * 14 + [1.0] * 16) @ q,
        "near equal": lambda: (1 + 1e-9 * rng.normal(size=(30, 1))) * q, "low rank": lambda: rng.normal(size=(5, 30)), "whole numbers": lambda: rng.integers(-3, 4, size=(60, 30)).astype(float),
    }[kind]()
    r = np.linalg.qr(a, mode="r")
    r = np.vstack([r, np.zeros((30 - len(r), 30))])
    values, vectors_ = whitening.principal(r, 30)
    right = np.linalg.svd(r, compute_uv=False) ** 2
    rank = int((right > 1e-20 * right[0]).sum())
    assert len(values) == rank and np.allclose(values, right[:rank], rtol=1e-10)
    assert np.abs(vectors_.T @ vectors_ - np.eye(rank)).max() < 1e-9
    assert np.abs(r.T @ (r @ vectors_) - vectors_ * values).max() < 1e-11 * right[0]


# --- source audit


def brute_audit(rows, least, top=10):
    """rows: (text, lang, source)."""
    cut, spread, counts = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"), defaultdict(Counter), defaultdict(Counter)
    rows = [(t or "", g or "", s or "") for t, g, s in rows]
    for text, lang, source in rows:
        own = cut.findall(lower(text))
        counts[lang, source].update(own)
        spread[lang].update(set(own))
    out = set()
    for lang in {g for _, g, _ in rows}:
        kept = {t for t, n in spread[lang].items() if n >= least}
        sources = {s for _, g, s in rows if g == lang}

        def shares(of):
            of = {t: of[t] for t in kept}
            whole = sum(of.values()) + 2 * len(kept)
            return {t: 1 + (1000000000 * (c + 2)) // whole for t, c in of.items()}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda a, b: ((a - b) * (a - b)) // (a + b)
        for s in sources:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t])[:top]
            out |= {(lang, s, part, name.decode(), -value, k) for part, ranked in (("pair", pairs), ("term", terms)) for k, (value, name) in enumerate(ranked, 1)}
    return out


def audited(rows):
    return {(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in rows}


def audit_rows(seed, n):
    random.seed(seed)
    words = ["Alpha", "beta", "ÉTÉ", "été", "x", "y1z", "ß", "日本", "\U0001F600", "￿", "delta", "eps"] + [f"w{chr(97 + k)}" for k in range(26)]
    text = lambda: None if random.random() < 0.05 else " ".join(random.choice(words) for _ in range(random.randrange(0, 12)))
    return [(text(), random.choice(["en", "de", None, ""]), random.choice(["s1", "s2", "s2", "s2", None, "é", "Z"])) for _ in range(n)]


@pytest.mark.parametrize("least", [1, 3, 10, 1000])
def test_audit_matches_brute_force(spark, least):
    rows = audit_rows(least, 120) + [("!!! 12", "xx", "lonely"), (None, "en", "silent"), ("word " * 5000, "en", "s1")]
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string").selectExpr("*", "1 AS n", "2 AS term", "3 AS total", "4 AS a")
    got = divergence.audit(docs, least).collect()
    assert len(got) == len(audited(got)) and audited(got) == brute_audit(rows, least)


def test_audit_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.audit(docs).collect() == []


def test_audit_sql_agrees(spark):
    rows = [(k, *r) for k, r in enumerate(audit_rows(4, 200))]
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([dict(zip(("doc_id", "text", "lang", "source"), r)) for r in rows]))
    want = {tuple(r) for r in con.execute(SQL["op13_source_divergence"]).fetchall()}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert audited(divergence.audit(docs).collect()) == want


def test_divergence_broadcasts_no_terms(spark):
    """Compressed, the table of terms looks smaller than it is, so that Spark's size checks would broadcast it."""
    docs = spark.createDataFrame([("alpha beta gamma", "en", s) for s in "ab"] * 3, "text string, lang string, source string")
    kept = written(divergence.kept_terms(docs, 1), "terms")
    groups = written(divergence._groups(docs, kept), "groups")
    for frame_ in (divergence.source_pairs(kept, groups), divergence.distinctive_terms(kept, groups)):
        plan = spark._jvm.PythonSQLUtils.explainString(frame_._jdf.queryExecution(), "formatted")
        sent = re.findall(r"\) BroadcastExchange\nInput \[\d+\]: \[(.*)\]", plan)
        assert "SortMergeJoin" in plan and not [x for x in sent if re.search(r"\b(term|n|total|n_a|n_b)#", x)]
