"""Line dedup, sharding, archives, chat linking, the Jaccard join, scoring and the pipeline on small tables."""

import base64
import gzip
import hashlib
import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ebbtide.llm import jaccard, linededup, lm, sharding, toolcalls, warc
from ebbtide.llm.components import components
from ebbtide.llm.shared import attach, new_folder, store
from tests.llm import brute
from tests.llm.brute import frame, passage

EDGES = [(1, None), (2, ""), (3, " \n\t "), (None, "no id here"), (4, "twice"), (4, "twice"), (5, "x" * 5000), (6, "a\nb " * 2000)]


# --- skew helper and components


def test_attach_is_a_left_join_for_hot_and_cold_keys(spark):
    rows = spark.range(6000).selectExpr("id", "CASE WHEN id < 2500 THEN 7 WHEN id % 10 = 0 THEN NULL ELSE id END AS k")
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("least")).where("k IS NOT NULL AND k % 3 <> 2")
    plain = rows.join(table.select("k", "least"), "k", "left").select("id", "k", "least")
    assert Counter(map(tuple, attach(rows, table, "k", "n", ["id"]).collect())) == Counter(map(tuple, plain.collect()))


def test_components_against_union_find(spark):
    random.seed(8)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 540)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- line dedup


def _gram_key(spark, texts):
    """The operator's hash of every stretch of lines that the brute-force version may ask for."""
    lines = sorted({x.strip(" \t\n\x0b\x0c\r") for t in texts if t for x in t.split("\n")})
    frame_ = spark.createDataFrame([(x,) for x in lines], "x string").select("x", F.xxhash64("x").alias("h"))
    one = {r["x"]: r["h"] for r in frame_.collect()}
    cache = {}

    def key(gram):
        if gram not in cache:
            row = spark.createDataFrame([([one[x] for x in gram],)], "g array<long>").select(F.xxhash64("g").alias("h")).first()
            cache[gram] = row["h"]
        return cache[gram]

    return key


def test_line_dedup_against_brute_force(spark):
    random.seed(6)
    pool = [passage(f"l{k}", random.randrange(3, 30)) for k in range(14)]
    rows = EDGES[:6] + [(10 + k, "\n".join(random.choice(pool + ["", " "]) for _ in range(random.randrange(1, 9)))) for k in range(14)]
    rows += [(rows[8][0], rows[9][1]), rows[8]]  # an id with another text, and a repeated row
    got = linededup.deduplicated(frame(spark, rows).selectExpr("*", "1 AS runs", "2 AS dig")).collect()
    texts = spark.createDataFrame([(t,) for t in {t for _, t in rows}], "t string").select("t", F.xxhash64("t").alias("h"))
    want = brute.line_dedup(rows, key=_gram_key(spark, [t for _, t in rows]), digest={r["t"]: r["h"] for r in texts.collect()}.get)
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(want)
    assert any(a[1] != b[1] for a, b in zip(rows, want)) and all(r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) for r in got)


def test_repeated_passages_go_and_the_first_stays(spark):
    one, many = passage("one", 60), "\n".join(passage(f"m{k}", 12) for k in range(6))
    rows = [(k, f"{passage(f'a{k}', 9)}\n{one}\n{passage(f'b{k}', 30)}") for k in range(40)]
    rows += [(100 + k, f"{passage(f'c{k}', 20)}\n{many}") for k in range(40)] + [(300, f"{passage('d', 5)}\n{passage('d', 5)}")]
    got = {r["doc_id"]: r["text"] for r in linededup.deduplicated(frame(spark, rows)).collect()}
    texts = dict(rows)
    assert got[0] == texts[0] and got[100] == texts[100] and got[300] == texts[300]
    assert all(got[k] == texts[k].replace(one + "\n", "") for k in range(1, 40))
    assert all(got[100 + k] == passage(f"c{k}", 20) for k in range(1, 40))
    assert linededup.deduplicated(frame(spark, [])).count() == 0


def test_every_repeated_run_goes_wherever_its_lines_stand_first(spark):
    x, y, z, long, one, two = (passage(n, k) for n, k in (("x", 26), ("y", 27), ("z", 28), ("long", 60), ("one", 6), ("two", 7)))
    rows = [(k, f"{passage(f'e{k}', 9)}\n{line}\n{passage(f'f{k}', 9)}") for k, line in enumerate([x, y, z, long, x + "\n" + z])]
    rows += [(10 + k, f"{passage(f'g{k}', 9)}\n{x}\n \n{y}\n{z}\n{passage(f'h{k}', 9)}") for k in range(3)]
    rows += [(20 + k, f"{passage(f'i{k}', 9)}\n{one}\n{long}\n{one}\n{two}\n{passage(f'j{k}', 9)}") for k in range(3)]
    texts = spark.createDataFrame([(t,) for _, t in rows], "t string").select("t", F.xxhash64("t").alias("h"))
    digest = {r["t"]: r["h"] for r in texts.collect()}.get
    gone = brute.long_runs(rows, digest=digest)
    assert [len(gone[r]) for r in rows[5:]] == [0, 4, 4, 1, 4, 4]
    key = _gram_key(spark, [t for _, t in rows])
    want = brute.line_dedup(rows, key=key, digest=digest, also=gone)
    got = linededup.deduplicated(frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(want) != Counter(brute.line_dedup(rows, key=key, digest=digest))
    assert dict(want)[11] == f"{passage('g1', 9)}\n{passage('h1', 9)}" and dict(want)[22] == f"{passage('i2', 9)}\n{passage('j2', 9)}"


# --- sharding


def _check_shards(rows, got, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots, homes, bytes_ = defaultdict(list), defaultdict(set), Counter()
    texts = defaultdict(set)
    for i, t in rows:
        texts[i].add(t or "")
    for r in got:
        slots[r["shard"]].append(r["slot"])
        bytes_[r["shard"]] += r["size"]
        for t in texts[r["doc_id"]]:
            homes[t].add(r["shard"]) if len(texts[r["doc_id"]]) == 1 else None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    assert all(len(h) == 1 for h in homes.values())
    groups = Counter()
    for _, t in rows:
        groups[hashlib.sha256((t or "").encode()).hexdigest()[:32]] += len((t or "").encode()) + 1
    return max(bytes_.values()), [groups[g] for g in sorted(groups)]


@pytest.mark.parametrize("hot", [0, 40])
def test_shards_are_minimax(spark, monkeypatch, hot):
    monkeypatch.setattr(sharding, "DIGITS", 1)
    monkeypatch.setattr(sharding, "REFINED", 2)
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 3)
    random.seed(hot)
    rows = EDGES[:6] + [(10 + k, "y" * random.randrange(1, 400)) for k in range(120)] + [(500 + k, "hot text " * 30) for k in range(hot)]
    got = sharding.sharded(frame(spark, rows).selectExpr("*", "1 AS shard", "2 AS slot")).collect()
    largest, sizes = _check_shards(rows, got, 8)
    assert largest == brute.minimax(sizes, 8)
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


def _cuts(sizes, shards, digits, monkeypatch):
    """cut_points over groups with random digests, its totals taken from a list."""
    monkeypatch.setattr(sharding, "DIGITS", digits)
    digests = sorted(f"{random.getrandbits(128):032x}" for _ in sizes)

    def totals(_, length, inside):
        out = {}
        for d, n in zip(digests, sizes):
            if not inside or d[: len(inside[0])] in inside:
                old = out.get(d[:length])
                out[d[:length]] = sharding.Segment(d[:length], n + (old.size if old else 0), 1 + (old.groups if old else 0))
        return out

    class Groups:
        def orderBy(self, *_): return self
        def limit(self, k): return type("Top", (), {"collect": lambda _: [{"digest": d} for _, d in sorted(zip([-n for n in sizes], digests))[:k]]})()

    monkeypatch.setattr(sharding, "_totals", totals)
    begins = sharding.cut_points(Groups(), shards)
    place = [sum(d >= b for b in begins) for d in digests]
    return [[n for n, k in zip(sizes, place) if k == shard] for shard in range(shards)]


def _second(sizes, shards):
    """Smallest capacity, by trying all, that every shard keeps to unless it is a single group."""
    for capacity in range(1, sum(sizes) + 1):
        used, room = 0, 0
        for n in sizes:
            if n > capacity:
                used, room = used + 1, 0
            elif n > room:
                used, room = used + 1, capacity - n
            else:
                room -= n
        if used <= shards:
            return capacity


@pytest.mark.parametrize("digits", [1, 3])
def test_hot_groups_leave_no_shard_empty(monkeypatch, digits):
    random.seed(digits)
    cases = [[1] * 30 + [33] + [1] * 36, [5] * 9, [1, 1, 90], [7], [2] * 13, [40, 1, 1, 40, 1, 1, 1, 40, 1, 1]]
    cases += [[random.choice([1, 2, 3, 9, 200]) for _ in range(random.randrange(1, 90))] for _ in range(150)]
    for sizes in cases:
        shards = _cuts(sizes, 8, digits, monkeypatch)
        assert [n for s in shards for n in s] == sizes
        assert max(map(sum, shards)) == brute.minimax(sizes, 8)
        capacity = _second(sizes, 8)
        assert all(sum(s) <= capacity or len(s) == 1 for s in shards), (sizes, shards, capacity)
        assert sum(map(bool, shards)) == min(8, len(sizes)), (sizes, shards)


def test_shards_of_little_and_nothing(spark):
    assert sharding.sharded(frame(spark, [])).count() == 0
    got = sharding.sharded(frame(spark, [(1, "a"), (2, None), (3, "")])).collect()
    assert len({r["shard"] for r in got if r["doc_id"] in (2, 3)}) == 1 and len(got) == 3


# --- archives


def test_pages_round_trip(spark):
    big = "<p>é</p>" * 5000
    pages = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (5, None, "same"), (3, "http://b\r\nX: y", big), (4, "u", None), (6, "u", ""), (7, "u", "once"), (7, "u", "once"), (None, "n", "nil"), (9, "n", big + "x")]
    frame_ = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS top")
    folder = new_folder(spark, "warc-test")
    warc.write(warc.with_revisits(frame_), folder)
    got = Counter(map(tuple, warc.page_report(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()))
    top = {}
    for i, _, h in pages:
        if i is not None:
            top[h or ""] = max(top.get(h or "", i), i)
    want = Counter()
    for i, _, h in pages:
        raw = (h or "").encode()
        first = top.get(h or "")
        response = first is None or i == first
        want[(i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if response else "revisit", None if response else first)] += 1
    assert got == want
    back = warc.read(spark, folder).where("record_type = 'response'")
    assert sorted(r["payload"].decode() for r in back.collect()) == sorted((h or "") for i, _, h in pages if top.get(h or "") in (i, None))
    empty = new_folder(spark, "warc-none")
    warc.write(warc.with_revisits(frame_.limit(0)), empty)
    assert warc.page_report(spark, empty).count() == 0


def test_predicates_reach_the_source_and_payloads_stay_packed(spark, monkeypatch):
    folder = new_folder(spark, "warc-push")
    pages = spark.range(50).selectExpr("id AS page_id", "concat('http://x/', id) AS url", "repeat(cast(id % 5 AS string), 3000) AS html")
    warc.write(warc.with_revisits(pages), folder)
    chosen = warc.read(spark, folder).where("record_type = 'response' AND target_uri LIKE 'http://x/4%' AND payload_bytes > 10")
    assert sorted(r["record_id"] for r in chosen.collect()) == [f"urn:page:{k}" for k in range(45, 50)]  # pushed: type and address; left to Spark: size
    reader = warc.WarcReader({"path": folder})
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "response"), warc.GreaterThan(("payload_bytes",), 10)]))
    assert len(reader.pushed) == 1 and len(left) == 1
    monkeypatch.setattr(warc.zlib, "decompress", lambda *a: pytest.fail("a payload was inflated"))
    reader.payload = "none"
    assert sum(b.num_rows for part in reader.partitions() for b in reader.read(part)) == 5


def test_archives_from_elsewhere(spark, tmp_path):
    one = warc.record("response", "urn:x:1", "http://x", "2020-01-01T00:00:00Z", b"first")
    two = warc.record("response", "urn:x:2", "http://y", "2020-01-01T00:00:00Z", b"second" * 999)
    (tmp_path / "a.warc").write_bytes(one + two)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))
    got = warc.read(spark, str(tmp_path)).where("target_uri = 'http://y'").collect()
    assert [bytes(r["payload"]) for r in got] == [b"second" * 999] * 2
    assert warc.read(spark, str(tmp_path), "none").where("record_type = 'revisit'").count() == 0
    bad = one.replace(b"first", b"wrong")
    (tmp_path / "a.warc").write_bytes(bad)
    with pytest.raises(Exception, match="does not match"):
        warc.read(spark, str(tmp_path)).collect()


def test_only_files_of_the_manifest_are_read(spark):
    folder = new_folder(spark, "warc-lost")
    warc.write(warc.with_revisits(spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string")), folder)
    files, path = store(folder)
    with files.open_output_stream(f"{path}/part-00000-lost.warc.gz", compression=None) as out:  # what a lost attempt leaves
        out.write(warc.member(warc.record("response", "urn:page:1", "u", "2020-01-01T00:00:00Z", b"h")))
    assert warc.page_report(spark, folder).count() == 1


# --- chat


def test_chat_linking(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "user", "hi \"x\"\n"), (1, 2, "assistant", "hello"), (1, 3, "user", "bye"), (2, 0, "assistant", "alone"), (3, 5, "user", None), (3, 6, "assistant", "a"), (3, 6, "assistant", "b"), (None, 1, "user", "no id"), (4, 0, None, "who")]
    rows = toolcalls.chat_report(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS depth", "2 AS errors")).collect()
    got = defaultdict(list)
    for r in rows:
        got[(r["conv_id"], r["turn"])].append(r)
    assert [got[(1, k)][0]["depth"] for k in range(4)] == [0, 1, 2, 3] and len(rows) == len(turns)
    assert {k: got[k][0]["status"] for k in got} == {(1, 0): "open", (1, 1): "linked", (1, 2): "linked", (1, 3): "open", (2, 0): "unanswerable", (3, 5): "dangling", (3, 6): "linked", (None, 1): "open", (4, 0): "open"}
    assert got[(3, 5)][0]["errors"] == "missing prompt" and got[(3, 5)][0]["n_results"] == 2 and got[(4, 0)][0]["errors"].startswith("unknown tool")
    assert got[(1, 1)][0]["json"] == json.dumps({"arguments": {"prompt": "hi \"x\"\n", "turn": 1}, "id": "1:1", "name": "reply", "type": "call"}, separators=(",", ":"))
    assert got[(1, 2)][0]["json"] == '{"call_id":"1:1","content":"hello","id":"1:2","name":"reply","type":"result"}'
    for r in rows:
        assert json.dumps(json.loads(r["json"]), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r["json"]


def test_order_schemas_and_cycles(spark):
    tools = {"add": {"a": toolcalls.Argument("integer"), "b": toolcalls.Argument("number", False), "tags": toolcalls.Argument("array", False)}}
    schema = "conv_id long, turn long, id string, after string, kind string, call_id string, name string, arguments string, content string"
    call = lambda i, after, name, arguments: (0, 0, i, after, "call", None, name, arguments, None)
    rows = [
        call("a", None, "add", '{"b": 2.50, "a": 1}'), call("b", "a", "add", '{"a": "1", "z": 0}'), call("c", "b", "add", "not json"), call("d", "zz", "sub", "{}"), call("p", "q", "add", '{"a":1,"tags":[1]}'),
        call("q", "p", "add", "[1]"), (0, 0, "r", "c", "result", "a", None, None, "out"), (0, 0, "s", "r", "result", "zz", None, None, None), (0, 0, None, None, "result", "a", None, None, "x"),
    ] + [call(f"n{k}", f"n{k - 1}" if k else None, "add", '{"a":1}') for k in range(70)]
    got = {r["id"]: r for r in toolcalls.linked(spark.createDataFrame(rows, schema), tools).collect()}
    assert [got[x]["depth"] for x in "abcdrs"] == [0, 1, 2, 0, 3, 4] and got["p"]["depth"] is None and got[None]["depth"] == 0
    assert [got[f"n{k}"]["depth"] for k in range(70)] == list(range(70))
    assert got["a"]["errors"] == [] and got["b"]["errors"] == ["a is not integer", "unknown z"] and got["c"]["errors"] == ["arguments are no JSON object"] and got["d"]["errors"] == ["unknown tool sub"]
    assert {x: got[x]["status"] for x in "abdpqrs"} == {"a": "linked", "b": "open", "d": "dangling", "p": "cycle", "q": "cycle", "r": "linked", "s": "unanswerable"}
    assert got["a"]["n_results"] == 2 and got["a"]["json"] == '{"arguments":{"a":1,"b":2.5},"id":"a","name":"add","type":"call"}'
    assert toolcalls.linked(spark.createDataFrame([], schema), tools).count() == 0


# --- Jaccard join


def _near(seed):
    random.seed(seed)
    word = lambda: f"v{random.randrange(60)}"
    rows = list(EDGES[:6])
    for base in range(14):
        text = [word() for _ in range(random.choice([2, 4, 7, 10, 14, 16, 17, 18, 30, 60, 90]))]
        for k in range(random.randrange(1, 7)):
            own = list(text)
            for _ in range(random.randrange(0, 3)):
                at = random.randrange(len(own))
                own[at : at + random.randrange(0, 2)] = [word() for _ in range(random.randrange(0, 2))]
            rows.append((len(rows) * 3 % 211 + 10, " ".join(own) if k % 2 else " ".join(own).upper()))
    shared = passage("s", 40)
    return rows + [(600 + k, f"{shared} {passage(k, 30)}") for k in range(10)]


@pytest.mark.parametrize("seed", range(3))
def test_jaccard_join_against_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(jaccard, "BLOCK", 4 if seed else 512)
    rows = [(k, t) for k, (_, t) in enumerate(_near(seed))] + [(None, "nobody knows this document at all here")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.joined(frame(spark, rows).selectExpr("*", "1 AS n", "2 AS set_id")).collect()}
    want = brute.components(rows[:-1])
    assert {k: v for k, v in got.items() if k is not None} == want and got[None][1] is None
    assert len({v[1] for v in want.values()}) < len(want)


def test_small_and_large_sets_meet_at_every_boundary(spark, monkeypatch):
    for b in (0, 7, 13):
        monkeypatch.setattr(jaccard, "boundary", lambda histogram, percent, b=b: b)
        rows = [(k, passage("z", n)) for k, n in enumerate(range(4, 40))] + [(100 + n, passage("z", n) + " end") for n in range(4, 30)]
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.joined(frame(spark, rows)).collect()}
        assert got == brute.components(rows)


def test_boundary_follows_the_costs():
    assert jaccard.boundary({}) == 0 and jaccard.boundary({500: 100}) >= 0
    assert 6 <= jaccard.boundary({5: 1000, 12: 1000, 400: 10}) <= 20
    for n in range(1, 40):
        for t in range(n, 60):
            o = jaccard.least_overlap(n, t)
            assert 100 * o >= 85 * (n + t - o) and 100 * (o - 1) < 85 * (n + t - o + 1)


def test_one_document_of_each_group_stays(spark):
    text = passage("k", 80)
    rows = [(5, text), (3, text + " more"), (9, text), (9, text), (7, passage("u", 30)), (1, None), (2, ""), (8, passage("u", 30) + " " + passage("t", 30)), (None, "unknown")]
    kept = jaccard.representatives(frame(spark, rows).selectExpr("*", "1 AS component_id"))
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([3, 7, 1, 2, 8, None], key=str)
    assert jaccard.joined(frame(spark, [])).count() == 0


def test_the_stage_takes_five_words_and_eighty_percent(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    base = passage("n", 60).split()
    rows = [(k, t) for k, (_, t) in enumerate(_near(1))]
    rows += [(1000, " ".join(base)), (1001, " ".join(base[:30] + ["other"] + base[31:])), (1002, " ".join(base[:52])), (1003, " ".join([*base[:8], "other", *base[8:]]))]
    rows += [(2000 + n, " ".join(base[:n])) for n in range(4, 60, 3)]
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, frame(spark, rows), "").collect()}
    want = {c for _, c in brute.components(rows, 80, 5).values()}
    assert kept == want and want != {c for _, c in brute.components(rows).values()}


# --- scoring


def brute_base(rows):
    counts, split = Counter(), []
    for i, t in rows:
        tokens = brute.PLAIN.findall(brute.lower(t)) + [None]
        held = zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2
        split.append((i, held, tokens))
        if not held:
            counts.update(tokens)
    n, v = sum(counts.values()), len(counts)
    return [(i, held, len(t), sum(counts[x] > 0 for x in t), n, sum(np.log10((counts[x] + 1) / (n + v + 1)) for x in t)) for i, held, t in split]


def _lm_rows():
    random.seed(9)
    tongues = [[f"{s}{c}" for s in "abcdefgh" for c in ends] for ends in (("th", "ng"), ("ux", "oi"))]
    rows = list(EDGES)
    for k in range(240):
        words, out = tongues[k % 2], ["The"]
        for _ in range(60):
            out.append(words[(words.index(out[-1]) * 5 + random.randrange(3)) % len(words)] if out[-1] in words and random.random() < 0.8 else random.choice(words))
        rows.append((100 + k, " ".join(out + [f"rare{k}"])))
    return rows


@pytest.mark.parametrize("frequent", [4, 1 << 18])
def test_scores(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", max(frequent, lm.OWN_CLASSES) if frequent > 4 else frequent)
    monkeypatch.setattr(lm, "EPOCHS", 5)
    rows = _lm_rows()
    got = lm.scored(frame(spark, rows).selectExpr("*", "1 AS score", "2 AS row")).collect()
    key = lambda r: (str(r[0]), r[2])
    for r, w in zip(sorted(map(tuple, got), key=key), sorted(brute_base(rows), key=key), strict=True):
        assert r[:5] == w[:5] and np.isclose(r[5], w[5])
    if frequent > 4:
        held = [r for r in got if r["held_out"] and r["doc_id"] and r["doc_id"] >= 100]
        assert held and sum(r["score"] for r in held) > 0.85 * sum(r["base_score"] for r in held)  # less negative: better on unseen texts
    assert lm.scored(frame(spark, [])).count() == 0


def test_probabilities_are_normalised_and_fit():
    rng = np.random.default_rng(0)
    counts = np.zeros((lm.CLASSES**2, lm.CLASSES), np.int64)
    for a in range(6):
        for b in range(6):
            counts[a * lm.CLASSES + b, (2 * b) % 6] = 400 + rng.integers(50)
            counts[a * lm.CLASSES + b, (3 * a + 1) % 6] = 100
    p = 10 ** lm.fit(counts, epochs=400).log_probabilities().astype(float)
    assert np.allclose(p.sum(1), 1, atol=1e-4)
    seen = counts.sum(1) > 0
    gain = (counts[seen] * np.log(p[seen])).sum() / counts.sum() - (counts.sum(0) * np.log(np.maximum(counts.sum(0) / counts.sum(), 1e-12))).sum() / counts.sum()
    assert gain > 0.3


# --- pipeline


def test_pipeline_stages(spark, tmp_path):
    random.seed(2)
    word = lambda: "".join(random.choice("etaonrish") for _ in range(random.randrange(2, 8)))
    line = lambda: " ".join(word() for _ in range(12)) + "."
    clean = {k: "\n".join(line() for _ in range(8)) for k in range(60)}
    junk = {100 + k: " ".join(word() + "###" for _ in range(60)) for k in range(30)}
    repeated = " ".join(word() for _ in range(70))
    item = " ".join(word() for _ in range(15))
    rows = {**clean, **junk, 200: clean[0] + " x", 201: clean[1] + "\n" + repeated, 202: clean[2][:40] + " ".join(word() for _ in range(40)) + "\n" + repeated, 203: clean[3].replace("\n", " ", 1), 204: " ".join(word() for _ in range(30)) + " " + item}
    frame(spark, list(rows.items())).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(40)] + [(100 + k, 0, 0) for k in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen.append({r["doc_id"]: r["text"] for r in docs.collect()})
    assert set(clean) <= set(seen[0]) and not set(junk) & set(seen[0])
    assert repeated in seen[1][201] and repeated not in seen[1][202]
    assert set(seen[2]) <= set(seen[1]) and set(clean) <= set(seen[2])
    assert item in seen[2][204] and item not in seen[3][204] and set(seen[3]) == set(seen[2])
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(out) == set(seen[3])
    assert all(out[k]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest() for k, t in seen[3].items())
