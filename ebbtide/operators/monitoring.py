"""Reference profiles, drift statistics, data-quality findings and the check suite.

Features are compared in a long layout ``(feature, value)``, so one grouped job covers all of them.
``by`` names batch columns to check separately, for example the as-of day. Everything after the first
aggregation has a few rows per feature of the contract and per batch key, which bounds what is broadcast.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ebbtide.contracts import ASOF, CATEGORICAL, CUSTOMER, FEATURES, LABEL, NUMERIC, RANGES
from ebbtide.functions.ordered import attach_row, exact_quantiles, running_totals
from ebbtide.settings import MonitorThresholds

RANK = {"skipped": 0, "unknown": 0, "ok": 1, "warn": 2, "alert": 3}

ACTIONS = {"alert": "hold the batch", "warn": "look at the findings", "ok": "no action"}

# Quantile fractions of a profile: the bin edges first, then the reported percentiles.
_PERCENTILES = [("p01", 1), ("p25", 25), ("p50", 50), ("p75", 75), ("p99", 99)]


class Profile(NamedTuple):
    """The frozen training distribution every later batch is compared with."""

    numeric: DataFrame
    bins: DataFrame
    levels: DataFrame


def long_values(rows: DataFrame, by: list[str] = [], features: list[str] = NUMERIC) -> DataFrame:
    """(by.., feature, value), NaN read as NULL."""
    present = [f for f in features if f in rows.columns]
    pairs = ", ".join(f"'{f}', cast({f} AS double)" for f in present)
    long = rows.selectExpr(*by, f"stack({len(present)}, {pairs}) AS (feature, value)")
    return long.withColumn("value", F.expr("CASE WHEN isnan(value) THEN NULL ELSE value END"))


def numeric_profile(train: DataFrame, thresholds: MonitorThresholds = MonitorThresholds()) -> DataFrame:
    """One row per numeric feature: moments, percentiles, null rate, and the interior bin edges.

    A feature with fewer than three distinct edges gets no interior edge, hence a single bin.
    """
    long, bins = long_values(train), thresholds.bins
    moments = long.groupBy("feature").agg(
        F.count("*").alias("n_rows"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.avg(F.col("value").isNull().cast("double")).alias("null_rate"))
    probs = [(i, bins) for i in range(bins + 1)] + [(p, 100) for _, p in _PERCENTILES]
    quantiles = exact_quantiles(long, "value", probs, ["feature"])
    edges = f"array_distinct(slice(quantiles, 1, {bins + 1}))"
    shaped = quantiles.selectExpr(
        "feature", f"CASE WHEN size({edges}) < 3 THEN array() ELSE slice({edges}, 2, size({edges}) - 2) END AS edges",
        *[f"quantiles[{bins + 1 + i}] AS {name}" for i, (name, _) in enumerate(_PERCENTILES)])
    return moments.join(F.broadcast(shaped), "feature")


def binned_counts(rows: DataFrame, profile: DataFrame, by: list[str] = []) -> DataFrame:
    """(by.., feature, bin, n): values counted on the frozen edges, bins closed on the left."""
    edges = profile.select("feature", "edges")
    # One row per feature of the contract.
    placed = long_values(rows, by).where("value IS NOT NULL").join(F.broadcast(edges), "feature")
    return placed.withColumn("bin", F.expr("size(filter(edges, e -> e <= value))")).groupBy(*by, "feature", "bin").agg(F.count("*").alias("n"))


def expected_bins(train: DataFrame, profile: DataFrame) -> DataFrame:
    """(feature, bin, lo, hi, expected_pct) with every bin of the frozen edges, also empty ones."""
    bins = profile.selectExpr("feature", "edges", "explode(sequence(0, size(edges))) AS bin")
    counts = binned_counts(train, profile)
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    return bins.join(F.broadcast(counts), ["feature", "bin"], "left").join(F.broadcast(totals), "feature", "left").selectExpr(
        "feature", "bin",
        "CASE WHEN bin = 0 THEN double('-infinity') ELSE edges[bin - 1] END AS lo",
        "CASE WHEN bin = size(edges) THEN double('infinity') ELSE edges[bin] END AS hi",
        "coalesce(n, 0) / cast(greatest(coalesce(total, 1), 1) AS double) AS expected_pct")


def categorical_profile(train: DataFrame, features: list[str] = CATEGORICAL) -> DataFrame:
    """(feature, level, n, expected_pct, null_rate) of each categorical feature."""
    levels = _levels(train, [], features)
    totals = levels.groupBy("feature").agg(F.sum("n").alias("total"), F.sum("nulls").alias("nulls"))
    return levels.drop("nulls").join(F.broadcast(totals), "feature").selectExpr(
        "feature", "level", "n", "n / cast(total AS double) AS expected_pct", "nulls / cast(total AS double) AS null_rate")


def _levels(rows: DataFrame, by: list[str], features: list[str]) -> DataFrame:
    present = [f for f in features if f in rows.columns]
    pairs = ", ".join(f"'{f}', cast({f} AS string)" for f in present)
    long = rows.selectExpr(*by, f"stack({len(present)}, {pairs}) AS (feature, level)")
    return long.groupBy(*by, "feature", F.coalesce("level", F.lit("None")).alias("level")).agg(
        F.count("*").alias("n"), F.count_if(F.col("level").isNull()).alias("nulls"))


def reference_profile(train: DataFrame, thresholds: MonitorThresholds = MonitorThresholds()) -> Profile:
    numeric = numeric_profile(train, thresholds)
    return Profile(numeric, expected_bins(train, numeric), categorical_profile(train))


def target_rate(train: DataFrame) -> DataFrame:
    return train.agg(F.count("*").alias("n_rows"), F.avg(LABEL).alias("base_rate"))


def psi_of(shares: DataFrame, keys: list[str]) -> DataFrame:
    """PSI per key from rows with ``expected_pct`` and ``actual_pct``; both floored at 1e-6 and renormalised.

    A key without any actual value (``actual_pct`` NULL) has no PSI.
    """
    floored = shares.selectExpr(*keys, "greatest(expected_pct, 1e-6D) AS e", "CASE WHEN actual_pct IS NOT NULL THEN greatest(actual_pct, 1e-6D) END AS a")
    over = f"OVER (PARTITION BY {', '.join(keys)})"
    scaled = floored.selectExpr(*keys, f"e / sum(e) {over} AS e", f"a / sum(a) {over} AS a")
    return scaled.groupBy(*keys).agg(F.expr("sum((a - e) * ln(a / e)) AS psi"))


def psi_numeric(batch: DataFrame, profile: Profile, by: list[str] = []) -> DataFrame:
    """(by.., feature, psi) of numeric features on the frozen bins."""
    counts = binned_counts(batch, profile.numeric, by)
    totals = counts.groupBy(*by, "feature").agg(F.sum("n").alias("total"))
    bins = profile.bins.select("feature", "bin", "expected_pct")
    if by:
        # All bins of the contract as one value, repeated for the few batch keys.
        listed = bins.agg(F.collect_list(F.struct("feature", "bin", "expected_pct"))).scalar()
        bins = batch.select(*by).distinct().withColumn("_bins", listed).select(*by, F.inline("_bins"))
    joined = bins.join(F.broadcast(counts), [*by, "feature", "bin"], "left").join(F.broadcast(totals), [*by, "feature"], "left")
    shares = joined.selectExpr(*by, "feature", "expected_pct", "CASE WHEN total > 0 THEN coalesce(n, 0) / cast(total AS double) END AS actual_pct")
    return psi_of(shares, [*by, "feature"])


def psi_categorical(batch: DataFrame, profile: Profile, by: list[str] = [], features: list[str] = CATEGORICAL) -> DataFrame:
    """(by.., feature, psi, n_unseen); levels unknown to the profile share one bucket expected at 1e-6."""
    seen = _levels(batch, by, features).drop("nulls")
    totals = seen.groupBy(*by, "feature").agg(F.sum("n").alias("total"))
    known = profile.levels.select("feature", "level", "expected_pct")
    unseen = seen.join(known, ["feature", "level"], "left_anti").groupBy(*by, "feature").agg(
        F.sum("n").alias("n"), F.count("*").alias("n_unseen"))
    listed = known.join(F.broadcast(totals), "feature").join(seen, [*by, "feature", "level"], "left").selectExpr(
        *by, "feature", "expected_pct", "coalesce(n, 0) / cast(total AS double) AS actual_pct")
    folded = unseen.join(F.broadcast(totals), [*by, "feature"]).selectExpr(*by, "feature", "1e-6D AS expected_pct", "n / cast(total AS double) AS actual_pct")
    psi = psi_of(listed.unionByName(folded), [*by, "feature"])
    return psi.join(F.broadcast(unseen.drop("n")), [*by, "feature"], "left").withColumn("n_unseen", F.coalesce("n_unseen", F.lit(0)))


def unseen_levels(batch: DataFrame, profile: Profile, features: list[str] = CATEGORICAL) -> DataFrame:
    """The levels of the batch that the profile does not know, with their rows."""
    return _levels(batch, [], features).drop("nulls").join(profile.levels.select("feature", "level"), ["feature", "level"], "left_anti")


def severity(psi: Column, thresholds: MonitorThresholds) -> Column:
    return (
        F.when(psi.isNull() | F.isnan(psi), F.lit("unknown")).when(psi >= thresholds.psi_alert, F.lit("alert"))
        .when(psi >= thresholds.psi_warn, F.lit("warn")).otherwise(F.lit("ok")))


def ks_two_sample(reference: DataFrame, batch: DataFrame, thresholds: MonitorThresholds = MonitorThresholds()) -> DataFrame:
    """(feature, n_ref, n_batch, ks_stat, ks_pvalue, low_power): largest gap between the two distribution functions.

    The p-value is the asymptotic Kolmogorov series; batches too small for it to say much are marked.
    """
    both = long_values(reference).selectExpr("feature", "value", "1L AS r", "0L AS b").unionByName(
        long_values(batch).selectExpr("feature", "value", "0L AS r", "1L AS b")).where("value IS NOT NULL")
    cells = both.groupBy("feature", "value").agg(F.sum("r").alias("r"), F.sum("b").alias("b"))
    sizes = cells.groupBy("feature").agg(F.sum("r").alias("n_ref"), F.sum("b").alias("n_batch"))
    cum = running_totals(cells, ["value"], {"r": "cr", "b": "cb"}, ["feature"]).join(F.broadcast(sizes), "feature")
    stat = cum.groupBy("feature", "n_ref", "n_batch").agg(F.expr("max(abs(try_divide(cr, n_ref) - try_divide(cb, n_batch))) AS d"))
    lam = "sqrt(cast(n_ref AS double) * n_batch / (n_ref + n_batch)) * d"
    series = "2D * aggregate(sequence(1, 100), 0D, (acc, k) -> acc + CASE WHEN k % 2 = 1 THEN 1D ELSE -1D END * exp(-2D * k * k * lam * lam))"
    p = f"CASE WHEN lam < 0.04D THEN 1D ELSE least(greatest({series}, 0D), 1D) END"
    enough = "n_batch > 0 AND n_ref > 0"
    return stat.withColumn("lam", F.expr(lam)).selectExpr(
        "feature", "n_ref", "n_batch", f"CASE WHEN {enough} THEN d END AS ks_stat", f"CASE WHEN {enough} THEN {p} END AS ks_pvalue", f"n_batch < {thresholds.ks_min_rows} AS low_power")


def feature_drift(profile: Profile, train: DataFrame, batch: DataFrame, thresholds: MonitorThresholds = MonitorThresholds()) -> DataFrame:
    """One row per feature: PSI and its severity, KS, and how mean and median moved.

    KS compares with the whole training column, not with a sample of it.
    """
    psi = psi_numeric(batch, profile)
    means = long_values(batch).groupBy("feature").agg(F.avg("value").alias("batch_mean"))
    medians = exact_quantiles(long_values(batch), "value", [(1, 2)], ["feature"]).selectExpr("feature", "quantiles[0] AS batch_p50")
    numbers = (
        psi.join(F.broadcast(ks_two_sample(train, batch, thresholds)), "feature", "left").join(F.broadcast(means), "feature", "left")
        .join(F.broadcast(medians), "feature", "left").join(F.broadcast(profile.numeric.select("feature", "mean", "std", "p50")), "feature")
    ).selectExpr(
        "feature", "'numeric' AS kind", "psi", "ks_stat", "ks_pvalue",
        f"coalesce(ks_pvalue < {thresholds.ks_pvalue}, false) AS ks_flag", "mean AS ref_mean", "batch_mean",
        "(batch_mean - mean) / greatest(std, 1e-9D) AS mean_shift_in_ref_sd", "p50 AS ref_p50", "batch_p50", "0L AS n_unseen")
    levels = psi_categorical(batch, profile).selectExpr("feature", "'categorical' AS kind", "psi", "false AS ks_flag", "n_unseen")
    return numbers.unionByName(levels, allowMissingColumns=True).withColumn("severity", severity(F.col("psi"), thresholds))


def top_drifting(drift: DataFrame, n: int = 8) -> DataFrame:
    return drift.orderBy(F.desc("psi"), "feature").limit(n)


def psi_table(profile: Profile, batch: DataFrame, by: list[str], thresholds: MonitorThresholds = MonitorThresholds()) -> DataFrame:
    """(by.., feature, psi, severity) of all features, for several batches at once."""
    numbers = psi_numeric(batch, profile, by)
    levels = psi_categorical(batch, profile, by).drop("n_unseen")
    return numbers.unionByName(levels).withColumn("severity", severity(F.col("psi"), thresholds))


def drift_rollup(drift: DataFrame, thresholds: MonitorThresholds = MonitorThresholds(), by: list[str] = []) -> DataFrame:
    """Share of drifting features and the overall status; ``n_confirmed`` needs PSI and KS to agree."""
    confirmed = F.count_if((F.col("severity") != "ok") & F.col("ks_flag")) if "ks_flag" in drift.columns else F.lit(None).cast("long")
    counts = drift.groupBy(*by).agg(
        F.count("*").alias("n_features"), F.count_if(F.col("severity") == "alert").alias("n_alert"),
        F.count_if(F.col("severity") == "warn").alias("n_warn"), confirmed.alias("n_confirmed"))
    rate = F.coalesce(F.try_divide((F.col("n_alert") + F.col("n_warn")).cast("double"), F.col("n_features")), F.lit(0.0))
    status = (
        F.when((rate >= thresholds.drift_share) | (F.col("n_alert") >= thresholds.drift_alerts), F.lit("alert"))
        .when(F.col("n_alert") + F.col("n_warn") > 0, F.lit("warn")).otherwise(F.lit("ok")))
    return counts.withColumn("drift_share", F.round(rate, 4)).withColumn("severity", status)


def prediction_drift(reference: DataFrame, batch: DataFrame, thresholds: MonitorThresholds = MonitorThresholds()) -> DataFrame:
    """One row: PSI of the score ``p`` on the reference deciles, mean scores and positive rates at 0.5."""
    deciles = exact_quantiles(reference, "p", [(i, 10) for i in range(11)])
    edges = deciles.selectExpr("array_distinct(quantiles) AS u").selectExpr(
        "CASE WHEN size(u) < 3 THEN array(0.5D) ELSE slice(u, 2, size(u) - 2) END AS edges")
    both = reference.selectExpr("p", "1L AS r", "0L AS b").unionByName(batch.selectExpr("p", "0L AS r", "1L AS b"))
    placed = both.withColumn("edges", edges.scalar()).withColumn("bin", F.expr("size(filter(edges, e -> e <= p))"))
    counts = placed.groupBy("bin").agg(F.sum("r").alias("r"), F.sum("b").alias("b"))
    totals = counts.agg(F.sum("r").alias("tr"), F.sum("b").alias("tb"))
    every = both.sparkSession.range(1).select(edges.scalar().alias("edges")).selectExpr("explode(sequence(0, size(edges))) AS bin")
    bins = attach_row(every.join(F.broadcast(counts), "bin", "left"), totals)
    psi = psi_of(bins.selectExpr("'p' AS score", "coalesce(r, 0) / cast(tr AS double) AS expected_pct", "coalesce(b, 0) / cast(tb AS double) AS actual_pct"), ["score"])
    facts = both.agg(F.expr("avg(CASE WHEN r = 1 THEN p END) AS ref_mean_score"), F.expr("avg(CASE WHEN b = 1 THEN p END) AS batch_mean_score"),
        F.expr("avg(CASE WHEN r = 1 THEN cast(p >= 0.5D AS int) END) AS ref_positive_rate"), F.expr("avg(CASE WHEN b = 1 THEN cast(p >= 0.5D AS int) END) AS batch_positive_rate"))
    return attach_row(psi.drop("score"), facts).withColumn("severity", severity(F.col("psi"), thresholds))


def schema_findings(batch: DataFrame) -> dict[str, list[str]]:
    """Missing, unexpected and wrongly typed columns, from the schema alone."""
    types = {f.name: f.dataType for f in batch.schema.fields}
    extra = {CUSTOMER, ASOF, LABEL, "feature_timestamp"}
    return {
        "missing": [f for f in FEATURES if f not in types],
        "unexpected": [c for c in batch.columns if c not in FEATURES and c not in extra],
        "wrong_type": [f for f in NUMERIC if f in types and not isinstance(types[f], T.NumericType)],
    }


def quality_findings(batch: DataFrame, ranges: dict = RANGES, thresholds: MonitorThresholds = MonitorThresholds(), by: list[str] = []) -> DataFrame:
    """(by.., feature, issue, value, threshold, severity) for null rates, ranges, constants and duplicates."""
    present = [f for f in FEATURES if f in batch.columns]
    numbers = [f for f in present if f in NUMERIC]
    clean = batch.selectExpr(*by, *([CUSTOMER] if CUSTOMER in batch.columns else []), *[
        f"CASE WHEN isnan(cast({f} AS double)) THEN NULL ELSE cast({f} AS double) END AS {f}" if f in NUMERIC else f for f in present])
    aggs = ["count(*) AS n_rows"] + [f"count_if({f} IS NULL) AS null_{f}" for f in present]
    aggs += [f"count_if({f} < {ranges[f][0]}D OR {f} > {ranges[f][1]}D) AS out_{f}" for f in numbers if f in ranges]
    aggs += [f"(CASE WHEN max({f}) IS NULL THEN 0 WHEN min({f}) = max({f}) THEN 1 ELSE 2 END) AS kinds_{f}" for f in numbers]
    facts = clean.groupBy(*by).agg(*[F.expr(a) for a in aggs])
    row = "named_struct('feature', '{}', 'issue', '{}', 'value', cast({} AS double), 'threshold', '{}', 'severity', {}, 'found', {})"
    rows = [row.format(f, "high_null_rate", f"round(null_{f} / greatest(n_rows, 1), 4)", thresholds.null_rate, "'alert'",
                       f"null_{f} / greatest(n_rows, 1) > {thresholds.null_rate}D") for f in present]
    rows += [row.format(f, "out_of_range", f"out_{f}", f"[{ranges[f][0]}, {ranges[f][1]}]",
                        f"CASE WHEN out_{f} / greatest(n_rows, 1) > {thresholds.out_of_range_share}D THEN 'alert' ELSE 'warn' END", f"out_{f} > 0")
             for f in numbers if f in ranges]
    rows += [row.format(f, "constant_column", f"kinds_{f}", "> 1", "'alert'", f"kinds_{f} <= 1") for f in numbers]
    found = facts.selectExpr(*by, f"inline(array({', '.join(rows)}))").where("found").drop("found")
    if CUSTOMER not in batch.columns:
        return found
    copies = clean.groupBy(*by, CUSTOMER).agg(F.count("*").alias("n")).groupBy(*by).agg(F.expr("sum(n - 1) AS extra")).where("extra > 0")
    return found.unionByName(copies.selectExpr(
        *by, f"'{CUSTOMER}' AS feature", "'duplicate_entities' AS issue", "cast(extra AS double) AS value", "'0' AS threshold", "'warn' AS severity"))


def quality_rollup(findings: DataFrame) -> DataFrame:
    """One row: number of findings and the worst severity, ok when there are none."""
    return findings.agg(
        F.count("*").alias("n_findings"),
        F.when(F.count_if(F.col("severity") == "alert") > 0, "alert").when(F.count("*") > 0, "warn").otherwise("ok").alias("severity"))


def suite(profile: Profile, batch: DataFrame, name: str, reference_scores: DataFrame | None = None, batch_scores: DataFrame | None = None,
          ranges: dict = RANGES, thresholds: MonitorThresholds = MonitorThresholds()) -> DataFrame:
    """(batch, check, severity, passed, low_power), one row per check and an overall row with the action to take.

    A schema break ends the suite before any data is read; drift of small batches is reported and marked.
    The status of the drift check follows from PSI alone; ``feature_drift`` has the details per feature.
    """
    schema = schema_findings(batch)
    broken = bool(schema["missing"] or schema["wrong_type"])
    spark = batch.sparkSession
    sure = F.lit(False).alias("low_power")
    one = spark.range(1).select(F.lit("schema").alias("check"), F.lit("alert" if broken else "ok").alias("severity"), sure)
    if broken:
        checks = one.unionByName(spark.range(1).select(F.lit("data_quality").alias("check"), F.lit("skipped").alias("severity"), sure))
    else:
        quality = quality_rollup(quality_findings(batch, ranges, thresholds)).select(F.lit("data_quality").alias("check"), "severity", sure)
        size = batch.agg(F.count("*")).scalar()
        drift = drift_rollup(psi_table(profile, batch, [], thresholds), thresholds).select(
            F.lit("feature_drift").alias("check"), "severity", (size < thresholds.min_rows).alias("low_power"))
        checks = one.unionByName(quality).unionByName(drift)
        if reference_scores is not None and batch_scores is not None:
            scores = prediction_drift(reference_scores, batch_scores, thresholds).select(F.lit("prediction_drift").alias("check"), "severity", sure)
            checks = checks.unionByName(scores)
    order = F.create_map(*[x for s, r in RANK.items() for x in (F.lit(s), F.lit(r))])
    # At most four checks: listed once, so that the overall row does not run them again.
    worst = F.max(F.struct(F.element_at(order, F.col("severity")).alias("r"), "severity"))["severity"]
    listed = checks.agg(F.collect_list(F.struct("check", "severity", "low_power")).alias("each"), worst.alias("worst"), F.bool_or("low_power").alias("weak"))
    rows = listed.select(F.inline(F.concat("each", F.array(F.struct(F.lit("overall").alias("check"), F.col("worst").alias("severity"), F.col("weak").alias("low_power"))))))
    action = F.when(F.col("check") == "overall", F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv]), F.col("severity")), F.lit("no action")))
    passed = F.when(F.col("check") == "data_quality", ~F.col("severity").isin("alert", "skipped")).otherwise(F.col("severity").isin("ok", "skipped"))
    return rows.select(F.lit(name).alias("batch"), "check", "severity", passed.alias("passed"), action.alias("action"), "low_power")


# --- damaged batches for negative controls -------------------------------------------------------

def shifted_batch(batch: DataFrame, ranges: dict = RANGES, factor: float = 5.0, days: float = 45.0) -> DataFrame:
    """Money off by a factor and recency late by some days."""
    money = ("revenue_30d", "revenue_90d", "revenue_180d", "lifetime_revenue", "aov_90d")
    low, high = ranges["recency_days"]
    return batch.withColumns({
        **{f: F.col(f) * factor for f in money},
        "recency_days": F.least(F.greatest(F.col("recency_days") + days, F.lit(low)), F.lit(high)),
    })


def faulty_batch(batch: DataFrame, missing_one_of: int = 3, impossible_one_of: int = 11, impossible: float = -0.5, stuck: float = 77.0) -> DataFrame:
    """Missing lifetime revenue and impossible breadth for part of the customers, and a stuck tenure."""
    number = F.col(CUSTOMER).cast("long")
    return batch.withColumns({
        "lifetime_revenue": F.when(number % missing_one_of == 0, F.lit(None).cast("double")).otherwise(F.col("lifetime_revenue")),
        "product_breadth_ratio": F.when(number % impossible_one_of == 0, F.lit(impossible)).otherwise(F.col("product_breadth_ratio")),
        "tenure_days": F.lit(stuck),
    })


def row_violations(rows: DataFrame, ranges: dict = RANGES) -> DataFrame:
    """Rows whose numeric fields are missing or outside their bounds, with the field names in contract order."""
    fields = ", ".join(f"CASE WHEN {f} IS NULL OR isnan({f}) OR {f} < {lo}D OR {f} > {hi}D THEN '{f}' END" for f, (lo, hi) in ranges.items())
    return rows.withColumn("violations", F.expr(f"array_compact(array({fields}))"))


def row_contract(rows: DataFrame, ranges: dict = RANGES) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) rows; unknown or missing columns are an error of the whole table."""
    known = {*FEATURES, CUSTOMER, ASOF, LABEL, "feature_timestamp", "fold"}
    strange = [c for c in rows.columns if c not in known] + [f for f in FEATURES if f not in rows.columns]
    if strange:
        raise ValueError(f"columns outside the contract: {sorted(strange)}")
    checked = row_violations(rows, ranges)
    return checked.where("size(violations) = 0").drop("violations"), checked.where("size(violations) > 0")
