"""Quality of scores per group: ranking, thresholded and probability metrics, curves and depths.

``scored`` tables hold ``model, fold, snapshot_date, customer_id, y, p``; ``group`` names the columns to
compare by. Curves work on distinct scores, so a score shared by many rows is one cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.contracts import ASOF, CUSTOMER
from ebbtide.functions.exact import share
from ebbtide.functions.ordered import exact_quantiles, ranked, running_totals

GROUP = ["model", "fold"]

# fixed values: the contactable shares reported in the metric panel
SLICES = {"decile": 0.10, "quintile": 0.20}


def _match(left: DataFrame, right: DataFrame, group: list[str]) -> DataFrame:
    """Attach per-group figures: one row per compared group, so the right side is small by construction."""
    return left.join(F.broadcast(right), group)


def score_curve(scored: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """Distinct scores with their rows, and the true and false positives at or above each of them."""
    cells = scored.groupBy(*group, "p").agg(F.sum(F.col("y").cast("long")).alias("pos"), F.sum((1 - F.col("y")).cast("long")).alias("neg"))
    totals = cells.groupBy(*group).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    cum = running_totals(cells, ["p"], {"pos": "cum_pos", "neg": "cum_neg"}, group)
    return _match(cum, totals, group).withColumns({
        "tp": F.col("all_pos") - F.col("cum_pos") + F.col("pos"), "fp": F.col("all_neg") - F.col("cum_neg") + F.col("neg")})


def rank_metrics(scored: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """Tie-aware ROC AUC and step-wise average precision; NULL where a class is missing."""
    curve = score_curve(scored, group)
    wins = F.sum(F.col("pos").cast("double") * (2 * F.col("cum_neg") - F.col("neg")))
    steps = F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp"))))
    p, n = F.max("all_pos").cast("double"), F.max("all_neg").cast("double")
    return curve.groupBy(*group).agg(
        F.try_divide(wins, 2 * p * n).alias("roc_auc"), F.try_divide(steps, p).alias("pr_auc"))


def roc_curve(scored: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """One point per distinct threshold, and the origin with a NULL threshold."""
    curve = score_curve(scored, group).select(
        *group, F.col("p").alias("threshold"), share(F.col("fp"), F.col("all_neg")).alias("fpr"), share(F.col("tp"), F.col("all_pos")).alias("tpr"))
    origin = scored.select(*group).distinct().select(*group, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return curve.unionByName(origin)


def pr_curve(scored: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """Precision and recall per distinct threshold, and the end point (1, 0) with a NULL threshold."""
    curve = score_curve(scored, group).select(
        *group, F.col("p").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        share(F.col("tp"), F.col("all_pos")).alias("recall"))
    end = scored.select(*group).distinct().select(*group, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return curve.unionByName(end)


def threshold_metrics(scored: DataFrame, threshold: float = 0.5, group: list[str] = GROUP) -> DataFrame:
    """Confusion counts and what follows from them at a threshold, plus Brier score and log loss."""
    y, hit = F.col("y") == 1, F.col("p") >= threshold
    clipped = F.least(F.greatest(F.col("p"), F.lit(1e-6)), F.lit(1 - 1e-6))
    counts = scored.groupBy(*group).agg(
        F.count("*").alias("n"), F.avg("y").alias("base_rate"),
        F.count_if(y & hit).alias("tp"), F.count_if(~y & hit).alias("fp"),
        F.count_if(y & ~hit).alias("fn"), F.count_if(~y & ~hit).alias("tn"),
        F.avg((F.col("p") - F.col("y")) * (F.col("p") - F.col("y"))).alias("brier"),
        F.avg(-F.when(y, F.log(clipped)).otherwise(F.log(1 - clipped))).alias("log_loss"))
    or_zero = lambda a, b: F.coalesce(share(a, b), F.lit(0.0))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *group, "n", "base_rate", F.lit(threshold).alias("threshold"), "tp", "fp", "fn", "tn",
        ((tp + tn) / F.col("n")).alias("accuracy"), or_zero(tp, tp + fp).alias("precision"), or_zero(tp, tp + fn).alias("recall"),
        or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"), "brier", "log_loss")


def ranking(scored: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """Rows with their rank by score, ties by customer and day, and the positives found so far."""
    rows = scored.select(*group, ASOF, CUSTOMER, "p", F.col("y").cast("long").alias("y"), (-F.col("p")).alias("_minus"))
    return ranked(rows, ["_minus", CUSTOMER, ASOF], group, carry={"y": "captured"}).drop("_minus")


def _depth(n: Column, part: Column) -> Column:
    return F.greatest(F.ceil(n * part), F.lit(1)).cast("long")


def topk_mask(scored: DataFrame, part: float, group: list[str] = GROUP) -> DataFrame:
    """Every row with its rank and whether it is in the top part of its group."""
    sizes = scored.groupBy(*group).agg(F.count("*").alias("_n"))
    rows = _match(ranking(scored, group), sizes, group)
    return rows.withColumn("selected", F.col("rank") <= _depth(F.col("_n"), F.lit(part))).drop("_n", "captured")


def at_depths(scored: DataFrame, parts: list[float], group: list[str] = GROUP) -> DataFrame:
    """Rows contacted and positives captured when each group is worked down to the given parts."""
    sizes = scored.groupBy(*group).agg(F.count("*").alias("n"), F.sum(F.col("y").cast("long")).alias("n_pos"))
    wanted = F.transform(F.array(*[F.lit(float(x)) for x in parts]), lambda x: F.struct(x.alias("part"), _depth(F.col("n"), x).alias("k")))
    rows = _match(ranking(scored, group), sizes.withColumn("_want", wanted), group)
    hits = rows.select(*group, "n", "n_pos", "rank", "captured", F.explode(F.filter("_want", lambda w: w["k"] == F.col("rank"))).alias("_w"))
    return hits.select(*group, F.col("_w.part").alias("part"), "n", "n_pos", F.col("rank").alias("k"), "captured")


def slice_metrics(scored: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """Precision, recall and lift in the top decile and quintile, one row per group."""
    depths = at_depths(scored, list(SLICES.values()), group)
    base = F.col("n_pos") / F.col("n")
    rated = depths.withColumns({
        "precision": F.col("captured") / F.col("k"), "recall": F.coalesce(share(F.col("captured"), F.col("n_pos")), F.lit(0.0)),
        "lift": F.try_divide(F.col("captured") / F.col("k"), base)})
    pick = lambda metric, part: F.max(F.when(F.col("part") == part, F.col(metric)))
    return rated.groupBy(*group).agg(*[
        pick(metric, part).alias(f"{metric}_at_top_{name}") for name, part in SLICES.items() for metric in ("precision", "recall", "lift")])


def metric_panel(scored: DataFrame, threshold: float = 0.5, group: list[str] = GROUP) -> DataFrame:
    """All metrics side by side, one row per group."""
    panel = threshold_metrics(scored, threshold, group).drop("tp", "fp", "fn", "tn", "threshold")
    return _match(_match(panel, rank_metrics(scored, group), group), slice_metrics(scored, group), group).select(
        *group, "n", "base_rate", "roc_auc", "pr_auc", "accuracy", "precision", "recall", "f1", "brier", "log_loss",
        *[f"{m}_at_top_{s}" for s in SLICES for m in ("precision", "recall", "lift")])


def calibration_curve(scored: DataFrame, bins: int = 10, group: list[str] = GROUP) -> DataFrame:
    """Mean score and observed rate per quantile bin of the score; empty bins do not appear."""
    edges = exact_quantiles(scored, "p", [(i, bins) for i in range(1, bins)], group).select(*group, "quantiles")
    cells = scored.groupBy(*group, "p").agg(F.count("*").alias("rows"), F.sum("y").alias("pos"))
    binned = _match(cells, edges, group).withColumn("bin", F.size(F.filter("quantiles", lambda e: e < F.col("p"))))
    return binned.groupBy(*group, "bin").agg(
        F.sum("rows").alias("n"), F.round(F.sum(F.col("p") * F.col("rows")) / F.sum("rows"), 6).alias("mean_predicted"),
        F.round(F.sum("pos") / F.sum("rows"), 6).alias("observed_rate"))


def gains_curve(scored: DataFrame, points: int = 60, low: float = 0.02, high: float = 1.0, group: list[str] = GROUP) -> DataFrame:
    """Share of all positives captured at evenly spaced contact depths."""
    grid = [low + i * (high - low) / (points - 1) for i in range(points)]
    return at_depths(scored, grid, group).withColumn("gain", F.coalesce(share(F.col("captured"), F.col("n_pos")), F.lit(0.0)))


def snapshot_stability(scored: DataFrame) -> DataFrame:
    """AUC and top-quintile precision of every model at every as-of day, purged ones included."""
    group = ["model", ASOF, "fold"]
    base = scored.groupBy(*group).agg(F.count("*").alias("n"), F.avg("y").alias("churn_rate"))
    top = slice_metrics(scored, group).select(*group, "precision_at_top_quintile")
    return _match(_match(base, rank_metrics(scored, group).select(*group, "roc_auc"), group), top, group)


def generalisation_gap(stability: DataFrame) -> DataFrame:
    """Mean AUC on training days against later days, per model."""
    inside = F.avg(F.when(F.col("fold") == "train", F.col("roc_auc")))
    outside = F.avg(F.when(F.col("fold") != "train", F.col("roc_auc")))
    return stability.groupBy("model").agg(inside.alias("auc_in_sample"), outside.alias("auc_out_of_sample"), (inside - outside).alias("gap"))
