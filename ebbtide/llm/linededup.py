"""Line dedup by winnowing, in DataFrame operations only.

Lines with words are hashed. From each line on, the shortest stretch of at least GRAM words is a gram; among
the grams inside the shortest stretch of at least REACH words, the one with the smallest hash is a
fingerprint. So any run of whole lines with REACH words or more that stands twice has a fingerprint in
common. Every fingerprint is held against its first occurrence (by document id, then line), the match is
extended line by line both ways, and the later run is deleted. Runs of fewer than GRAM words never are.

A fingerprint may stand first in another context than the run. So the shortest stretches of at least REACH
words that begin or end with a line are held against first occurrences of their own, and the later ones are
deleted. They cover every run of REACH words or more, and each has a fingerprint that stands twice, so only
stretches around such fingerprints are joined.

Defined results: null texts stay null and empty ones empty; lines are compared without white space at their
ends; lines without words are deleted only inside a run; a document may end up with an empty text, its row
stays; rows equal in id and text are one document and get the same result; rows with equal ids and other
texts are documents of their own; documents without an id come first. Other columns pass through.

Lines travel as hashes; the texts are shuffled once, to meet their deletions. Fingerprints are counted before
they are joined, and those with a large share of all rows are answered by a bounded broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ebbtide.llm.shared import attach, written

GRAM = 25
REACH = 50
_BLANKS = " \t\n\x0b\x0c\r"
_WORD = r"[^\x20\x09-\x0D]+"


def _key(docs: DataFrame) -> tuple[Column, Column]:
    return F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("dig")


def line_table(docs: DataFrame) -> DataFrame:
    """doc_id, dig and the lines with words as (hash, place, words); one row per document."""
    lines = F.transform(
        F.split("text", "\n", -1),
        lambda x, i: F.struct(F.xxhash64(F.trim(x, F.lit(_BLANKS))).alias("h"), i.alias("at"), F.regexp_count(x, F.lit(_WORD)).alias("n")),
    )
    rows = docs.where("text IS NOT NULL").select(*_key(docs), F.filter(lines, lambda x: x["n"] > 0).alias("lines"))
    return rows.dropDuplicates(["doc_id", "dig"])


def fingerprints(lines: DataFrame, gram: int = GRAM, reach: int = REACH) -> DataFrame:
    """doc_id, dig, line (number among the lines with words), print: the winnowed grams of every document."""
    doc = W.partitionBy("doc_id", "dig")
    rows = lines.select("doc_id", "dig", F.posexplode("lines").alias("line", "x")).select("doc_id", "dig", "line", F.col("x.h").alias("h"), F.col("x.n").cast("long").alias("n"))
    rows = rows.withColumn("begin", F.sum("n").over(doc.orderBy("line").rowsBetween(W.unboundedPreceding, 0)) - F.col("n"))
    stretch = lambda size: doc.orderBy("begin").rangeBetween(0, size - 1)  # noqa: E731  lines that begin before ``size`` words are full
    end = F.col("begin") + F.col("n")
    rows = rows.withColumns({"g": F.collect_list("h").over(stretch(gram)), "g_end": F.max(end).over(stretch(gram))}).withColumns({
        "g": F.when(F.col("g_end") - F.col("begin") >= gram, F.xxhash64("g")),
    })
    rows = rows.withColumns({
        "inside": F.collect_list(F.struct("g", "line", "g_end")).over(stretch(reach)), "r_end": F.max(end).over(stretch(reach)),
    }).where(F.col("r_end") - F.col("begin") >= reach)
    least = F.array_min(F.filter("inside", lambda x: x["g"].isNotNull() & (x["g_end"] <= F.col("r_end"))))
    return rows.select("doc_id", "dig", least.alias("m")).select("doc_id", "dig", F.col("m.line").alias("line"), F.col("m.g").alias("print")).distinct()


def _met(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Rows whose key stands twice, with its first occurrence: ``first`` (doc_id, dig, line)."""
    firsts = written(
        rows.groupBy(key).agg(F.min(F.struct("doc_id", "dig", "line")).alias("first"), F.count("*").alias("n")).where("n > 1"), f"{name}-firsts",
    )
    return attach(rows, firsts, key, "n", ["doc_id", "dig", "line"]).where("first IS NOT NULL")


def matches(met: DataFrame) -> DataFrame:
    """Fingerprints that stand earlier too: (doc_id, dig, first_id, first_dig, shift, lines)."""
    return met.where(F.struct("doc_id", "dig", "line") > F.col("first")).groupBy(
        "doc_id", "dig", F.col("first.doc_id").alias("first_id"), F.col("first.dig").alias("first_dig"), (F.col("line") - F.col("first.line")).alias("shift"),
    ).agg(F.collect_list("line").alias("anchors"))


def _equal_run(left: Column, right: Column) -> Column:
    """How many leading elements are equal."""
    differ = F.array_position(F.zip_with(left, right, lambda a, b: ~(F.coalesce(a == b, F.lit(False)))), True)
    return F.when(differ > 0, differ - 1).otherwise(F.size(left)).cast("int")


def repeated_runs(lines: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, dig, runs: the places (first, last) of later repeated runs, extended both ways."""
    own = lines.select(F.col("doc_id").alias("own_id"), F.col("dig").alias("own_dig"), F.col("lines").alias("own"))
    first = lines.select(F.col("doc_id").alias("other_id"), F.col("dig").alias("other_dig"), F.transform("lines", lambda x: x["h"]).alias("other"))
    both = (
        found.join(own, (F.col("dig") == F.col("own_dig")) & F.col("doc_id").eqNullSafe(F.col("own_id")))
        .join(first, (F.col("first_dig") == F.col("other_dig")) & F.col("first_id").eqNullSafe(F.col("other_id")))
    )
    hashes = F.transform("own", lambda x: x["h"])

    def run(line: Column) -> Column:
        there = line - F.col("shift")
        onward = _equal_run(F.slice(hashes, line + 1, F.size("own")), F.slice("other", there + 1, F.size("other")))
        back = _equal_run(F.reverse(F.slice(hashes, F.lit(1), line)), F.reverse(F.slice("other", F.lit(1), there)))
        place = lambda k: F.get("own", k)["at"]
        return F.struct(place(line - back).alias("a"), place(line + onward - 1).alias("b"))

    runs = both.select("doc_id", "dig", F.array_distinct(F.transform("anchors", run)).alias("runs"))
    return runs.groupBy("doc_id", "dig").agg(F.array_distinct(F.flatten(F.collect_list("runs"))).alias("runs"))


def repeated_stretches(lines: DataFrame, met: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, dig, a, b: the places of stretches of at least ``reach`` words that stand earlier, in whatever context."""
    doc = W.partitionBy("doc_id", "dig")
    every = lines.select("doc_id", "dig", F.posexplode("lines").alias("line", "x")).select(
        "doc_id", "dig", "line", F.col("x.h").alias("h"), F.col("x.at").alias("at"), F.col("x.n").cast("long").alias("n"), F.lit(False).alias("shared"),
    )
    marks = met.select("doc_id", "dig", "line", F.lit(True).alias("shared"))
    rows = every.unionByName(marks, allowMissingColumns=True).repartition("doc_id", "dig").groupBy("doc_id", "dig", "line").agg(*[F.max(c).alias(c) for c in ("h", "at", "n", "shared")])
    rows = rows.withColumn("end", F.sum("n").over(doc.orderBy("line").rowsBetween(W.unboundedPreceding, 0))).withColumn("begin", F.col("end") - F.col("n"))

    def stretch(over: W) -> Column:
        of = lambda f, c: f(c).over(over)
        return F.struct(
            of(F.min, "line").alias("line"), of(F.min, "at").alias("a"), of(F.max, "at").alias("b"), of(F.min, "begin").alias("begin"), of(F.max, "end").alias("end"),
            of(F.max, "shared").alias("shared"), F.xxhash64(of(F.collect_list, "h")).alias("stretch"),
        )

    rows = rows.withColumns({"onward": stretch(doc.orderBy("begin").rangeBetween(0, reach - 1)), "back": stretch(doc.orderBy("end").rangeBetween(1 - reach, 0))})
    # A stretch that is still long enough without its last line is not the shortest from its first; all others are found from there.
    back = F.when(F.col("begin") - F.col("back.begin") >= reach, F.col("back"))
    found = F.filter(F.array("onward", back), lambda x: x["shared"] & (x["end"] - x["begin"] >= reach))
    found = rows.select("doc_id", "dig", F.explode(found).alias("x")).select("doc_id", "dig", "x.line", "x.a", "x.b", "x.stretch")
    met = _met(written(found, "dedup-stretches"), "stretch", "dedup-stretches")
    return met.where(F.struct("doc_id", "dig", "line") > F.col("first")).select("doc_id", "dig", "a", "b")


def merged(runs: DataFrame) -> DataFrame:
    """doc_id, dig, runs: overlapping and adjoining places (a, b) of every document as one."""
    order = W.partitionBy("doc_id", "dig").orderBy("a", "b")
    new = F.coalesce(F.col("a") > F.max("b").over(order.rowsBetween(W.unboundedPreceding, -1)) + 1, F.lit(True))
    apart = runs.withColumn("new", new.cast("int")).withColumn("island", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    whole = apart.groupBy("doc_id", "dig", "island").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return whole.groupBy("doc_id", "dig").agg(F.collect_list(F.struct("a", "b")).alias("runs"))


def deduplicated(docs: DataFrame, gram: int = GRAM, reach: int = REACH) -> DataFrame:
    """The documents without later repeated runs of lines."""
    lines = written(line_table(docs), "dedup-lines")
    met = written(_met(fingerprints(lines, gram, reach), "print", "dedup"), "dedup-met")
    runs = repeated_runs(lines, matches(met)).select("doc_id", "dig", F.inline("runs"))
    runs = merged(runs.unionByName(repeated_stretches(lines, met, reach)))
    runs = runs.select(F.col("doc_id").alias("__id"), F.col("dig").alias("__dig"), "runs").withColumnRenamed("runs", "__runs")
    joined = docs.withColumn("__of", F.xxhash64("text")).join(
        runs.hint("shuffle_hash"), (F.col("__of") == F.col("__dig")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left",
    )
    kept = F.filter(F.split("text", "\n", -1), lambda x, i: ~F.exists("__runs", lambda r: (i >= r["a"]) & (i <= r["b"])))
    text = F.when(F.col("__runs").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    columns = {"text": text, **({"n_chars": F.length(text).cast("long")} if "n_chars" in docs.columns else {})}
    return joined.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns])
