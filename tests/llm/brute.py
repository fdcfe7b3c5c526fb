"""Plain re-implementations that the operators are held against, and the small documents they share."""

import re
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows, schema=SCHEMA):
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    return spark.createDataFrame(full, schema)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def passage(seed, n):
    """n distinct invented words."""
    return " ".join(f"w{seed}x{k}" for k in range(n))


def shingles(text, size=4):
    words = PLAIN.findall(lower(text))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def components(rows, percent=85, size=4):
    """(doc_id, text) -> {doc_id: (set size, smallest doc_id reachable)} over all pairs."""
    sets = {}
    for i, t in rows:
        sets.setdefault(i, shingles(t, size))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def long_runs(rows, reach=50, digest=hash):
    """{row: places of lines} of all runs of ``reach`` words or more that stand earlier anywhere, by comparing all places with all."""
    out, spots = defaultdict(set), []
    for d in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1]))):
        own = [(x.strip(" \t\n\x0b\x0c\r"), at, len(PLAIN.findall(x))) for at, x in enumerate(d[1].split("\n"))]
        own = [x for x in own if x[2]]
        spots += [(d, own, k) for k in range(len(own))]
    for n, (d, own, i) in enumerate(spots):
        for _, other, k in spots[:n]:
            size = 0
            while i + size < len(own) and k + size < len(other) and own[i + size][0] == other[k + size][0]:
                size += 1
            if sum(x[2] for x in own[i : i + size]) >= reach:
                out[d].update(range(own[i][1], own[i + size - 1][1] + 1))
    return out


def line_dedup(rows, gram=25, reach=50, key=hash, digest=hash, also=None):
    """Winnowed grams against their first occurrence, extended both ways; ``key`` maps a gram's lines, ``digest`` a text to its hash, ``also`` a row to more places that go."""
    docs = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1])))
    lines = {}
    for d in docs:
        if d[1] is not None:
            found = [(x.strip(" \t\n\x0b\x0c\r"), at, len(PLAIN.findall(x))) for at, x in enumerate(d[1].split("\n"))]
            lines[d] = [x for x in found if x[2]]
    prints, first = defaultdict(set), {}
    for d, own in lines.items():
        def stretch(i, size):
            j, n = i, 0
            while j < len(own) and n < size:
                n, j = n + own[j][2], j + 1
            return (i, j) if n >= size else None

        for i in range(len(own)):
            window = stretch(i, reach)
            if window:
                grams = [g for g in (stretch(k, gram) for k in range(i, window[1])) if g and g[1] <= window[1]]
                best = min(grams, key=lambda g: (key(tuple(x[0] for x in own[g[0] : g[1]])), g[0]))
                prints[d].add((key(tuple(x[0] for x in own[best[0] : best[1]])), best[0]))
    for d in lines:
        for h, i in sorted(prints[d], key=lambda x: x[1]):
            first.setdefault(h, (d, i))
    out = []
    for d in rows:
        drop = set((also or {}).get(d, ()))
        for h, i in prints.get(d, ()):
            e, k = first[h]
            if (e, k) == (d, i):
                continue
            a, b = 0, 0
            own, other = lines[d], lines[e]
            while i + b < len(own) and k + b < len(other) and own[i + b][0] == other[k + b][0]:
                b += 1
            while i - a > 0 and k - a > 0 and own[i - a - 1][0] == other[k - a - 1][0]:
                a += 1
            drop.update(range(own[i - a][1], own[i + b - 1][1] + 1))
        out.append((d[0], None if d[1] is None else "\n".join(x for n, x in enumerate(d[1].split("\n")) if n not in drop)))
    return out


def minimax(sizes, shards):
    """Smallest largest sum of a contiguous partition, by dynamic programming."""
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        best = [0] + [min(max(best[j], sum(sizes[j:i])) for j in range(i + 1)) for i in range(1, len(sizes) + 1)]
    return best[-1]


__all__ = ["Counter", "components", "frame", "line_dedup", "long_runs", "lower", "minimax", "passage", "shingles"]
