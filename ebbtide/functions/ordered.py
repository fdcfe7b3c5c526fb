"""Global order without a global sort task: running totals, ranks and exact quantiles.

A window without partitions (or with one huge partition) pulls its rows into a single task. Here the
ordered rows are cut into blocks at splitter keys; every block is scanned on its own and shifted by the
totals of the blocks before it. Splitters are the keys with the smallest hashes, a uniform sample that
comes out the same on every evaluation, so a recomputed task lands in the same block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def _blocks(df: DataFrame) -> int:
    return max(16, min(1024, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def _block(step: int) -> Column:
    """Position of a key among the splitters: first among every step-th one, then inside that stretch."""
    at_or_below = lambda splits: F.size(F.filter(splits, lambda s: s <= F.col("_key")))
    stretch = F.slice("_splits", (F.col("_coarse_at") - 1) * step + 1, F.lit(step))
    return F.when(F.col("_coarse_at") == 0, F.lit(0)).otherwise((F.col("_coarse_at") - 1) * step + at_or_below(stretch))


def running_totals(cells: DataFrame, order: list[str], sums: dict[str, str], group: list[str] = []) -> DataFrame:
    """Add inclusive running sums along ``order`` inside each ``group``.

    ``cells`` must hold one row per (group, order) key; ``sums`` maps an input column with non-negative
    values to the output name. Pre-aggregating to such cells is what removes hot keys.
    """
    key, blocks = F.struct(*group, *order), _blocks(cells)
    step = max(4, int(blocks ** 0.5))
    weight = F.greatest(*[F.col(c) for c in sums]) if len(sums) > 1 else F.col(next(iter(sums)))
    # The weight filter keeps every cell; it makes this branch read the same columns as the others, so
    # Spark computes the cells once and reuses the exchange.
    splitters = (
        cells.where(weight >= 0).select(key.alias("_key"))
        .orderBy(F.xxhash64("_key"), "_key").limit(blocks)
        .agg(F.sort_array(F.collect_list("_key")).alias("fine"))
        .select(F.struct("fine", F.expr(f"CASE WHEN size(fine) > 0 THEN transform(sequence(0, size(fine) - 1, {step}), i -> fine[i]) ELSE fine END").alias("coarse")).alias("s"))
    )
    blocked = (
        cells.withColumns({"_s": splitters.scalar(), "_key": key})
        .withColumns({"_splits": F.col("_s.fine"), "_coarse_at": F.size(F.filter("_s.coarse", lambda s: s <= F.col("_key")))})
        .withColumn("_block", _block(step))
        .drop("_s", "_key", "_splits", "_coarse_at")
    )
    # At most one row per block and group: a bounded table.
    totals = blocked.groupBy(*group, "_block").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    before = W.partitionBy(*(group or [F.lit(0)])).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"_g_{g}") for g in group], F.col("_block").alias("_b"),
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums],
    )
    on = blocked["_block"] == offsets["_b"]
    for g in group:
        on = on & blocked[g].eqNullSafe(offsets[f"_g_{g}"])
    inside = W.partitionBy(*group, "_block").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    joined = blocked.join(F.broadcast(offsets), on, "left")
    out = joined.select(
        *cells.columns,
        *[(F.sum(c).over(inside) + F.col(f"_o_{c}")).alias(name) for c, name in sums.items()],
    )
    return out


def attach_row(rows: DataFrame, figures: DataFrame) -> DataFrame:
    """Add the columns of a one-row table to every row, as a scalar subquery instead of a join."""
    whole = figures.select(F.struct(*figures.columns).alias("_r")).scalar()
    return rows.withColumn("_r", whole).select(*rows.columns, *[F.col(f"_r.{c}").alias(c) for c in figures.columns])


def ranked(rows: DataFrame, order: list[str], group: list[str] = [], rank: str = "rank", carry: dict[str, str] | None = None) -> DataFrame:
    """1-based row number along a unique ``order``; ``carry`` adds running sums of further columns."""
    one = rows.withColumn("_one", F.lit(1).cast("long"))
    return running_totals(one, order, {"_one": rank, **(carry or {})}, group).drop("_one")


def exact_quantiles(df: DataFrame, value: str, probs: list[tuple[int, int]], group: list[str] = []) -> DataFrame:
    """Linearly interpolated quantiles per group: columns ``*group, n, quantiles array<double>``.

    ``probs`` are fractions (numerator, denominator); positions are computed in whole numbers, so a
    quantile that falls on a data point is exactly that point. NULL and NaN are ignored.
    """
    clean = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    cells = clean.groupBy(*group, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    cum = running_totals(cells, ["_v"], {"_n": "_cum"}, group)
    sizes = cells.groupBy(*group).agg(F.sum("_n").alias("n"))
    wanted = F.array(*[
        F.struct(
            F.lit(i).alias("i"),
            F.expr(f"((n - 1) * {num}) div {den}").alias("lo"),
            (F.expr(f"((n - 1) * {num}) % {den}") / F.lit(float(den))).alias("frac"),
        )
        for i, (num, den) in enumerate(probs)
    ])
    # One row per group: bounded by the number of groups the caller compares.
    targets = sizes.select(*[F.col(g).alias(f"_s_{g}") for g in group], "n", wanted.alias("_want"))
    if group:
        on = cum[group[0]].eqNullSafe(targets[f"_s_{group[0]}"])
        for g in group[1:]:
            on = on & cum[g].eqNullSafe(targets[f"_s_{g}"])
        held = cum.join(F.broadcast(targets), on)
    else:
        held = attach_row(cum, targets)
    first, last = F.col("_cum") - F.col("_n"), F.col("_cum")
    hit = F.filter("_want", lambda w: ((w["lo"] >= first) & (w["lo"] < last)) | ((w["lo"] + 1 >= first) & (w["lo"] + 1 < last)))
    points = held.select(*group, "n", "_v", first.alias("_first"), last.alias("_last"), F.explode(hit).alias("_w"))
    lo = F.max(F.when((F.col("_w.lo") >= F.col("_first")) & (F.col("_w.lo") < F.col("_last")), F.col("_v")))
    hi = F.max(F.when((F.col("_w.lo") + 1 >= F.col("_first")) & (F.col("_w.lo") + 1 < F.col("_last")), F.col("_v")))
    per_prob = points.groupBy(*group, "n", F.col("_w.i").alias("_i"), F.col("_w.frac").alias("_f")).agg(lo.alias("_lo"), hi.alias("_hi"))
    value_at = F.when(F.col("_f") == 0, F.col("_lo")).otherwise(
        F.col("_lo") + (F.coalesce("_hi", "_lo") - F.col("_lo")) * F.col("_f"))
    listed = per_prob.groupBy(*group, "n").agg(F.sort_array(F.collect_list(F.struct("_i", value_at.alias("q")))).alias("_q"))
    return listed.select(*group, "n", F.transform("_q", lambda x: x["q"]).alias("quantiles"))


def group_index(edges: Column, value: Column) -> Column:
    """Number of interior edges at or below the value, i.e. a 0-based left-closed bin index."""
    return F.size(F.filter(edges, lambda e: e <= value))
