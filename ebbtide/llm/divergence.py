"""Divergence of the sources of a language, exact, by ranking cells of counts instead of terms.

Tasks count terms per (lang, source) and the documents they stand in; one shuffle by (lang, term) adds these up
and keeps the terms of enough documents. From there on everything works on cells: terms of a group with the same
count in the group and in the language have the same value, so a value is computed once per cell. Cells of equal
value merge, the merged ones are ranked by the number of terms before them, and only terms of cells that reach the
asked ranks are looked up and put in UTF-8 order. Sums over all terms of two sources need no term without
occurrences: with f for counts (a, b) of a term, the sum of f(a, b) is that of f(a, b) - f(a, 0) - f(0, b) + f(0, 0)
over cells of terms both have, of f(a, 0) - f(0, 0) and f(0, b) - f(0, 0) over cells of either, and V f(0, 0).

Defined results: null text, lang and source are empty; groups without terms have zero counts, and zero values where
the language keeps no term; repeated rows count as documents of their own; texts of any length are counted whole;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ebbtide.llm.shared import stored
from ebbtide.llm.words import LOWER, give_back

LEAST_DOCS = 10  # documents of a language a kept term stands in
TOP_TERMS = 10
UNIT = 1_000_000_000
HELD_TERMS = 300_000  # terms a task holds before it hands its counts on
LONG_TEXT = 1 << 20  # longer texts are counted word by word instead of by a list of words

_TERM = re.compile(rb"[a-z\x80-\xff]+")
_LOWERED = LOWER.tobytes()


def counted(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, n_docs: counts of single tasks, to be added up."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occurs, stands = defaultdict(Counter), defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), counts in occurs.items():
                docs_of, terms = stands[lang, source], list(counts)
                for at in range(0, len(terms), 50_000):
                    part = terms[at : at + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(pa.scalar(lang, pa.string()), len(part)), pa.repeat(pa.scalar(source, pa.string()), len(part)), pa.array(part, pa.binary()).cast(pa.string()),
                            pa.array([counts[t] for t in part], pa.int64()), pa.array([docs_of[t] for t in part], pa.int64()),
                        ],
                        names=["lang", "source", "term", "n", "n_docs"],
                    )
            occurs.clear()
            stands.clear()

        held = 0
        for batch in batches:
            for text, lang, source in zip(*(column.to_pylist() for column in batch.columns)):
                data, key = (text or "").encode().translate(_LOWERED), (lang or "", source or "")
                before = len(occurs[key])
                if len(data) > LONG_TEXT:
                    own = Counter(m[0] for m in _TERM.finditer(data))
                    occurs[key].update(own)
                else:
                    own = _TERM.findall(data)
                    occurs[key].update(own)
                stands[key].update(set(own))
                held += len(occurs[key]) - before
                if held > HELD_TERMS:
                    yield from flush()
                    held = 0
        yield from flush()
        give_back()

    return docs.select("text", "lang", "source").mapInArrow(job, "lang string, source string, term string, n long, n_docs long")


def kept_terms(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """lang, source, term, n, total, first: kept terms a source has, with counts there and in the language.

    ``first`` marks one row of every term of a language.
    """
    sums = counted(docs).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    of_term = Window.partitionBy("lang", "term")
    whole = sums.withColumns({"total": F.sum("n").over(of_term), "spread": F.sum("n_docs").over(of_term), "first": F.col("source") == F.min("source").over(of_term)})
    return whole.where(F.col("spread") >= least).select("lang", "source", "term", "n", "total", "first")


def _p(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a count, in whole units; null where the language keeps no term."""
    over = F.nullif((total + 2 * terms).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    return F.call_function("div", (count + 2).cast("decimal(28,0)") * F.lit(UNIT).cast("decimal(10,0)"), over) + 1


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _shuffled(rows: DataFrame) -> DataFrame:
    """Rows that no join may broadcast: a compressed table takes many times the size that Spark's checks see of it."""
    return rows.hint("merge")


def _groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, own (count of all kept terms), whole (that of the language), terms (kept ones of the language)."""
    named = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    langs = kept.groupBy("lang").agg(F.sum("n").alias("whole"), F.count_if("first").alias("terms"))
    sources = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    return named.join(langs, "lang", "left").join(sources, ["lang", "source"], "left").fillna(0, ["own", "whole", "terms"])


def distinctive_terms(kept: DataFrame, groups: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, item, value, rank: the terms a source has more of than its language, highest values first."""
    group = ["lang", "source"]
    cells = kept.groupBy(*group, "n", "total").agg(F.count("*").alias("m")).join(F.broadcast(groups), group)  # far fewer groups than rows of the result
    p, q = _p(F.col("n"), F.col("own"), F.col("terms")), _p(F.col("total"), F.col("whole"), F.col("terms"))
    valued = cells.withColumns({"p": p, "q": q}).where("p > q").select(*group, "n", "total", "m", _f(F.col("p"), F.col("q")).alias("value"))
    falling = Window.partitionBy(*group).orderBy(F.desc("value"))
    # Every value stands for a term at least, so no more values than ranks can matter.
    values = valued.groupBy(*group, "value").agg(F.sum("m").alias("m")).withColumn("place", F.row_number().over(falling)).where(F.col("place") <= top)
    before = F.coalesce(F.sum("m").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reached = values.withColumn("before", before).where(F.col("before") < top).select(*group, "value")
    chosen = _shuffled(valued).join(reached, [*group, "value"]).select(*group, "n", "total", "value")
    ranked = _shuffled(kept).join(chosen, [*group, "n", "total"]).withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("value"), "term")))
    return ranked.where(F.col("rank") <= top).select(*group, F.col("term").alias("item"), "value", "rank")


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value, rank: every other source of the language, most different first."""
    side = lambda k: groups.select("lang", F.col("source").alias(k), F.col("own").alias(f"own_{k}"), "terms")
    pairs = side("a").join(side("b").drop("terms"), "lang").where("a <> b")
    share = lambda k, count: _p(count, F.col(f"own_{k}"), F.col("terms"))
    none = F.lit(0).cast("long")

    has = lambda k: kept.select("lang", "term", F.col("source").alias(k), F.col("n").alias(f"n_{k}"))
    both = _shuffled(has("a")).join(has("b"), ["lang", "term"]).where("a < b").groupBy("lang", "a", "b", "n_a", "n_b").agg(F.count("*").alias("m"))
    both = both.join(side("a"), ["lang", "a"]).join(side("b").drop("terms"), ["lang", "b"])
    both = both.withColumns({"pa": share("a", F.col("n_a")), "pb": share("b", F.col("n_b")), "za": share("a", none), "zb": share("b", none)})
    gain = _f(F.col("pa"), F.col("pb")) - _f(F.col("pa"), F.col("zb")) - _f(F.col("za"), F.col("pb")) + _f(F.col("za"), F.col("zb"))
    shared = both.groupBy("lang", "a", "b").agg(F.sum(F.col("m") * gain).alias("part"))

    alone = _shuffled(kept.groupBy("lang", F.col("source").alias("a"), "n").agg(F.count("*").alias("m"))).join(pairs, ["lang", "a"])
    alone = alone.withColumns({"pa": share("a", F.col("n")), "za": share("a", none), "zb": share("b", none)})
    alone = alone.groupBy("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(
        F.sum(F.col("m") * (_f(F.col("pa"), F.col("zb")) - _f(F.col("za"), F.col("zb")))).alias("part")
    )
    base = pairs.where("a < b").select("lang", "a", "b", (F.col("terms") * _f(share("a", none), share("b", none))).alias("part"))
    sums = base.unionByName(shared).unionByName(alone).groupBy("lang", "a", "b").agg(F.coalesce(F.sum("part"), F.lit(0)).alias("value"))
    way = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    both_ways = sums.select("lang", way.alias("way"), "value").select("lang", "way.source", "way.item", "value")
    return both_ways.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    kept = stored(kept_terms(docs, least), "terms")
    groups = stored(_groups(docs, kept), "groups")
    parts = [frame.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, frame in (("pair", source_pairs(kept, groups)), ("term", distinctive_terms(kept, groups, top)))]
    return parts[0].unionByName(parts[1])
