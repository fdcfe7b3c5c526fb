"""Boosted trees with second-order leaf values, grown leaf by leaf from histograms, over DataFrames.

Features become bin numbers once. A round adds one tree to the margins, which are a column of the rows, so the search
for the number of rounds goes on from where it stands and repeats none. A tree is grown from sums of gradients per
(leaf, feature, bin): one aggregate gives those of half of the new leaves, their parents the rest, and what reaches the driver is bounded by leaves,
features and bins, whatever the number of rows. Up to ``ROWS_OF_A_TASK`` rows one task runs a block of rounds with the
same sums, which saves a job a pass.
Gradients are summed as whole numbers, so a fit does not depend on the order of rows or tasks. Trees are rows of a small
table; a prediction walks all of them for an Arrow batch of rows at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from ebbtide.contracts import ASOF, CUSTOMER, LABEL, NUMERIC
from ebbtide.operators.ranking import rank_metrics
from ebbtide.session import checkpoint_folder

UNIT = 1 << 20  # gradients are summed in whole parts of this
BINS = 64
ROWS_OF_A_TASK = 2_000_000  # up to here one task runs a block of rounds; more rows are summed by an aggregate a pass
BLOCK, SMALL_BLOCK = 25, 100  # rounds between two ratings of the held rows, with a checkpoint each; the second for few rows
TRAIL_CELLS = 20_000_000  # margins of rated rows that a block keeps, but for blocks of ``BLOCK`` rounds
CHUNK = 1 << 16  # rows whose curvatures and number are summed in one double each, exactly
JOINT, JOINT_ROWS = 5_000, 6_000  # cells of the features that are summed together, and rows of a leaf from which this pays
ROW = [CUSTOMER, ASOF, "y", "fits", "rated", "key", "bins", "margin", "trail"]
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
TREE = "tree int, depth int, feature array<int>, cut array<int>, left array<int>, value array<double>"


@dataclass(frozen=True)
class BoostingSettings:
    """Fixed values, equal to those of the configuration these models are compared under: the cap of rounds, the step,
    leaves, rows of a leaf, shares of rows and features of a tree, the L2 term and the patience."""

    max_rounds: int = 600
    step: float = 0.05
    leaves: int = 31
    min_leaf: int = 40
    subsample: float = 0.9
    feature_share: float = 0.8
    l2: float = 1.0
    least_rounds: int = 20
    patience: int = 50  # rounds without gain that end the search


@dataclass
class Tree:
    """Nodes in arrays; ``left`` is the first of a node's two children, or -1 in a leaf."""

    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    depths: list[int] = field(default_factory=lambda: [0])

    @property
    def depth(self) -> int:
        return max(self.depths)

    def split(self, node: int, feature: int, cut: int, values: tuple[float, float]) -> tuple[int, int]:
        first = len(self.left)
        self.feature[node], self.cut[node], self.left[node] = feature, cut, first
        for value in values:
            for column, x in zip((self.feature, self.cut, self.left, self.value, self.depths), (0, 0, -1, value, self.depths[node] + 1)):
                column.append(x)
        return first, first + 1

    def row(self, number: int) -> tuple:
        return number, self.depth, self.feature, self.cut, self.left, self.value


def _leaf_sql(bins: str, depth: str, feature: str, cut: str, left: str) -> str:
    step = f"IF({left}[n] < 0, n, IF({bins}[{feature}[n]] <= {cut}[n], {left}[n], {left}[n] + 1))"
    return f"aggregate(sequence(0, {depth}), 0, (n, i) -> {step})"


def _array(values: list) -> str:
    return "array(" + ",".join(repr(v) + ("D" if isinstance(v, float) else "") for v in values) + ")"


def leaf_of(tree: Tree) -> Column:
    """The leaf of a row with a column ``bins``."""
    return F.expr(_leaf_sql("bins", str(tree.depth), _array(tree.feature), _array(tree.cut), _array(tree.left)))


# --- bins


def bin_edges(train: DataFrame, levels: list[str], bins: int = BINS) -> DataFrame:
    """One row: upper edges of the bins of every numeric feature, and the kept country levels.

    Edges are quantiles with a relative rank error of at most one in 10,000; equal ones are one.
    """
    probs = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    edges = [F.array_sort(F.array_distinct(F.coalesce(F.percentile_approx(F.nanvl(f, F.lit(None).cast("double")), probs, 10000), F.array().cast("array<double>")))) for f in NUMERIC]
    return train.agg(F.array(*edges).alias("edges")).withColumn("levels", F.array(*[F.lit(x) for x in levels]).cast("array<string>"))


def binned(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Add ``bins``: 0 for a missing number, else one more than the edges below it; then 0 or 1 per kept country level."""
    whole = edges.first()
    cuts, levels = [np.array(x, float) for x in whole["edges"]], whole["levels"]
    numbers = F.array(*[F.col(f).cast("double") for f in NUMERIC]).alias("_v")
    places = F.array(*[(F.coalesce("country_grp", F.lit("Unknown")) == x).cast("int") for x in levels]).cast("array<int>").alias("_l")

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            values, own = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for c in ("_v", "_l")) if n else (np.zeros((0, len(cuts))), np.zeros((0, len(levels))))
            found = [np.where(np.isnan(v), 0, 1 + np.searchsorted(cut, v)) for v, cut in zip(values.T, cuts)]
            bins = np.concatenate([np.array(found).T.reshape(n, len(cuts)), own], axis=1).astype(np.int32)
            ends = np.arange(n + 1, dtype=np.int32) * bins.shape[1]
            yield batch.drop_columns(["_v", "_l"]).append_column("bins", pa.ListArray.from_arrays(pa.array(ends), pa.array(bins.ravel())))

    return rows.select("*", numbers, places).mapInArrow(job, StructType([*rows.schema.fields, StructField("bins", ArrayType(IntegerType()))]))


# --- growing


def _histograms(rows: DataFrame, node: Column, open_: list[int], shape: tuple[int, int]) -> dict[int, np.ndarray]:
    """Sums (gradient, curvature, rows) by leaf, feature and bin for the leaves in ``open_``."""
    at = rows.select(node.alias("node"), "g", "h", "bins").where(F.array_contains(F.expr(_array(open_)), F.col("node")))
    cells = at.select("node", "g", "h", F.posexplode("bins").alias("feature", "bin")).groupBy("node", "feature", "bin")
    table = cells.agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count("*").alias("n")).toArrow()
    node_, feature, bin_, g, h, n = (table.column(c).to_numpy() for c in ("node", "feature", "bin", "g", "h", "n"))
    out = {k: np.zeros((*shape, 3)) for k in open_}
    for k in open_:
        mine = node_ == k
        for c, values in enumerate((g / UNIT, h / UNIT, n)):
            out[k][feature[mine], bin_[mine], c] = values[mine]
    return out


def _best_splits(cells: np.ndarray, features: list[int], s: BoostingSettings) -> list[tuple[float, int, int, tuple[float, float], int] | None]:
    """For each leaf: gain, feature, last bin of the left side, both leaf values and the side (0, 1) with fewer rows, of
    its best admissible split."""
    features = sorted(features)
    low = np.cumsum(np.moveaxis(cells[:, features], -1, 0), axis=-1)
    whole, low = low[..., -1:], low[..., :-1]
    high = whole - low
    score = lambda x: x[0] ** 2 / (x[1] + s.l2)
    gain = score(low) + score(high) - score(whole)
    gain[(low[2] < s.min_leaf) | (high[2] < s.min_leaf)] = -np.inf
    value = lambda x: float(-s.step * x[0] / (x[1] + s.l2))
    out = []
    for k, best in enumerate(gain.reshape(len(cells), -1).argmax(1)):
        f, cut = divmod(int(best), gain.shape[2])
        a, b = low[:, k, f, cut], high[:, k, f, cut]
        found = float(gain[k, f, cut]), features[f], cut, (value(a), value(b)), int(a[2] > b[2])
        out.append(found if found[0] > 1e-12 else None)
    return out


def _chosen(number: int, width: int, s: BoostingSettings, seed: int) -> list[int]:
    return Random(f"{seed}:{number}").sample(range(width), max(1, round(s.feature_share * width)))


def _drawn(number: int | Column, s: BoostingSettings, seed: int) -> Column:
    return F.pmod(F.xxhash64(CUSTOMER, ASOF, F.lit(number), F.lit(seed)), F.lit(10_000)) < F.lit(int(s.subsample * 10_000))


def _grown(histograms: Callable[[Tree, list[int]], dict[int, np.ndarray]], chosen: list[int], s: BoostingSettings) -> Tree:
    """A tree from sums over the rows; a pass splits the best of the leaves that can be split.

    Only the child with fewer rows is summed: what its parent holds beyond that is the other child's, exactly.
    """
    tree, left = Tree(), s.leaves - 1
    held = histograms(tree, [0])
    while held and left > 0:
        best = _best_splits(np.stack(list(held.values())), chosen, s)
        splits = sorted(((b, k) for b, k in zip(best, held) if b), key=lambda x: (-x[0][0], x[1]))[:left]
        fewer = {}
        for (_, feature, cut, values, light), k in splits:
            children = tree.split(k, feature, cut, values)
            fewer[children[light]] = children[1 - light], held[k]
        left, held = left - len(splits), {}
        if fewer and left > 0:
            found = histograms(tree, list(fewer))
            for child, (other, parent) in fewer.items():
                held |= {child: found[child], other: parent - found[child]}
    return tree


def grow(rows: DataFrame, number: int, width: int, s: BoostingSettings, seed: int) -> Tree:
    """One tree for rows with ``bins``, ``y`` and ``margin``, by an aggregate a pass."""
    p = 1 / (1 + F.exp(-F.col("margin")))
    sample = rows.where(_drawn(number, s, seed)).select("bins", F.round((p - F.col("y")) * UNIT).cast("long").alias("g"), F.round(p * (1 - p) * UNIT).cast("long").alias("h"))
    return _grown(lambda tree, open_: _histograms(sample, leaf_of(tree), open_, (width, BINS + 1)), _chosen(number, width, s, seed), s)


# --- a block of rounds in tasks that keep their rows


def _hashed(number: int, before: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of one more whole number, after the hash of the values before it."""
    p1, p2, p3, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
    word = np.uint64(number % (1 << 32) * int(p1) % (1 << 64))
    h = (before + (p5 + np.uint64(4))) ^ word
    h = ((h << np.uint64(23)) | (h >> np.uint64(41))) * p2 + p3
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


def _drawn_rows(key: np.ndarray, number: int, s: BoostingSettings, seed: int) -> np.ndarray:
    """What ``_drawn`` says of rows with the hash ``key`` of their ids."""
    return _hashed(seed, _hashed(number, key.view(np.uint64))).view(np.int64) % 10_000 < int(s.subsample * 10_000)


def _joint(columns: np.ndarray) -> list[tuple[list[int], list[int], np.ndarray]]:
    """Features that are summed together, with their bins and one number a row for all of them."""
    sizes = [int(c.max(initial=0)) + 1 for c in columns]
    groups: list[list[int]] = []
    for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
        fitting = [g for g in groups if np.prod([sizes[x] for x in g]) * sizes[f] <= JOINT]
        fitting[0].append(f) if fitting else groups.append([f])
    out = []
    for g in groups:
        key = np.zeros(columns.shape[1], np.uint16)
        for f in g:
            key = key * np.uint16(sizes[f]) + columns[f]
        out.append((g, [sizes[f] for f in g], key))
    return out


class _TaskRows:
    """The rows of a task by the leaf they are in: bins by feature, those drawn for the tree and the others."""

    def __init__(self, columns: np.ndarray):
        self.columns = columns
        self.place = np.ascontiguousarray((columns + (np.arange(len(columns)) * (BINS + 1)).astype(np.uint16)[:, None]).T)
        self.joint = _joint(self.columns)

    def begin(self, mine: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
        """A new tree; ``mine`` tells the rows that it is grown from."""
        self.weights = g, h + float(1 << 36)  # the number of rows stands above the sum of their curvatures
        self.leaves = {0: (np.flatnonzero(mine), np.flatnonzero(~mine))}

    def settle(self, tree: Tree) -> None:
        """Move the rows of nodes that were split to their leaves."""
        while split := [k for k in self.leaves if tree.left[k] >= 0]:
            for k in split:
                column, cut = self.columns[tree.feature[k]], tree.cut[k]
                sides = [(at[low], at[~low]) for at in self.leaves.pop(k) for low in [column[at] <= cut]]
                self.leaves[tree.left[k]], self.leaves[tree.left[k] + 1] = zip(*sides)

    def sums(self, open_: list[int]) -> np.ndarray:
        """Gradient, curvature in whole parts and rows by leaf, feature and bin."""
        width = len(self.columns)
        out = np.zeros((3, len(open_), width, BINS + 1))

        def add(where: tuple, of_g: np.ndarray, of_rest: np.ndarray) -> None:
            n = np.floor(of_rest / (1 << 36))
            out[0][where] += of_g
            out[1][where] += of_rest - n * (1 << 36)
            out[2][where] += n

        few = [k for k, leaf in enumerate(open_) if len(self.leaves[leaf][0]) < JOINT_ROWS]
        if few:
            rows = np.concatenate([self.leaves[open_[k]][0] for k in few])
            slot = np.repeat(np.arange(len(few)) * (width * (BINS + 1)), [len(self.leaves[open_[k]][0]) for k in few])
            for start in range(0, len(rows), JOINT_ROWS):
                part = rows[start : start + JOINT_ROWS]
                keys = (self.place[part] + slot[start : start + JOINT_ROWS, None]).ravel()
                add((few,), *(np.bincount(keys, np.repeat(w[part], width), len(few) * width * (BINS + 1)).reshape(len(few), width, BINS + 1) for w in self.weights))
        for k in sorted({*range(len(open_))} - {*few}):
            at = self.leaves[open_[k]][0]
            for start in range(0, len(at), CHUNK):
                part = at[start : start + CHUNK]
                weights = [w[part] for w in self.weights]
                for features, sizes, key in self.joint:
                    keys, cells = key[part].astype(np.intp), int(np.prod(sizes))
                    both = np.stack([np.bincount(keys, w, cells) for w in weights]).reshape(2, *sizes)
                    for axis, f in enumerate(features):
                        add((k, f, slice(sizes[axis])), *both.sum(tuple(x + 1 for x in range(len(sizes)) if x != axis)))
        return out


def _block_of_rounds(first: int, rounds: int, width: int, s: BoostingSettings, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A block of rounds over the rows of one task, with the sums that ``_histograms`` would give."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = [], [np.zeros((width, 0), np.uint8)]
        for batch in batches:
            parts.append(batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(-1, width).T.astype(np.uint8))
            held.append(batch.drop_columns(["bins"]))
        names = [CUSTOMER, ASOF, "y", "fits", "rated", "key"]
        types = [pa.string(), pa.date32(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64()]
        table = pa.Table.from_batches(held) if held else pa.table([pa.array([], t) for t in [*types, pa.float64()]], names=[*names, "margin"])
        n, bins = table.num_rows, np.concatenate(parts, axis=1)
        parts.clear()
        y, fits, margin, rated, key = (table.column(c).to_numpy() for c in ("y", "fits", "margin", "rated", "key"))
        rows, trees, margin, rated = _TaskRows(bins), [], margin.copy(), np.flatnonzero(rated)
        trail = np.zeros((len(rated), rounds))
        units = np.array([UNIT, UNIT, 1.0])

        def sums(tree: Tree, open_: list[int]) -> dict[int, np.ndarray]:
            rows.settle(tree)
            return dict(zip(open_, np.moveaxis(rows.sums(open_), 0, -1) / units))

        for k in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            rows.begin(fits & _drawn_rows(key, first + k, s, seed), np.rint((p - y) * UNIT), np.rint((p * (1 - p)) * UNIT))
            tree = _grown(sums, _chosen(first + k, width, s, seed), s)
            rows.settle(tree)
            for leaf, parts in rows.leaves.items():
                for at in parts:
                    margin[at] += tree.value[leaf]
            trees.append(tree)
            trail[:, k] = margin[rated]
        columns, ends = [table.column(c).combine_chunks() for c in names], np.arange(10_001, dtype=np.int32)
        for start in range(0, n, 10_000):
            end = min(start + 10_000, n)
            low, high = np.searchsorted(rated, [start, end])
            ended = np.concatenate([[0], np.cumsum(np.isin(np.arange(start, end), rated[low:high]) * rounds)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ended), pa.array(trail[low:high].ravel()))
            own = pa.ListArray.from_arrays(pa.array(ends[: end - start + 1] * width), pa.array(bins[:, start:end].T.astype(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays([*(c.slice(start, end - start) for c in columns), own, pa.array(margin[start:end]), lists, pa.nulls(end - start, pa.string())], names=[*ROW, "trees"])
        text = json.dumps([[t.feature, t.cut, t.left, t.value, t.depths] for t in trees])
        none = [*types, pa.list_(pa.int32()), pa.float64(), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in none), pa.array([text])], names=[*ROW, "trees"])

    return job


def _values(tree: Tree) -> Column:
    return F.expr(f"{_array(tree.value)}[{_leaf_sql('bins', str(tree.depth), _array(tree.feature), _array(tree.cut), _array(tree.left))}]")


def _drop(frame: DataFrame) -> None:
    """Delete the files of a checkpoint that nothing reads any more."""
    spark, file = frame.sparkSession, frame._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        path = spark._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Boosting:
    """Rounds over persisted rows: those with ``fits`` grow the trees, those with ``rated``, else all, keep their margins after each round."""

    def __init__(self, rows: DataFrame, edges: DataFrame, fits: Column, s: BoostingSettings, seed: int, rated: Column | None = None):
        checkpoint_folder(rows.sparkSession)
        base = binned(rows.select(CUSTOMER, ASOF, F.col(LABEL).alias("y"), "country_grp", *NUMERIC, fits.alias("fits"), (F.lit(True) if rated is None else rated).alias("rated")), edges)
        self.s, self.seed, self.trees = s, seed, []
        self.width = len(NUMERIC) + edges.select(F.size("levels").alias("n")).first()["n"]
        plain = base.select(CUSTOMER, ASOF, "y", "fits", "rated", F.xxhash64(CUSTOMER, ASOF).alias("key"), "bins", F.lit(0.0).alias("margin"), F.array().cast("array<double>").alias("trail"))
        whole = plain.checkpoint()
        n = whole.count()
        # Few rows stay together, so that their passes need no shuffle.
        self.parts = max(1, -(-n // ROWS_OF_A_TASK))
        self.rows = self.kept = whole.coalesce(self.parts).checkpoint()
        self.small = self.parts == 1
        kept = whole.where("rated").count()
        _drop(whole)
        self.block = min(SMALL_BLOCK, max(BLOCK, TRAIL_CELLS // max(kept, 1))) if self.small else BLOCK

    def advance(self, rounds: int) -> None:
        """Add ``rounds`` trees; the rated rows carry their margins after each of them until the next call."""
        if self.small:
            return self._advance_small(rounds)
        at, held = self.rows.withColumn("trail", F.array().cast("array<double>")), []
        for _ in range(rounds):
            tree = grow(at.where("fits"), len(self.trees), self.width, self.s, self.seed)
            self.trees.append(tree)
            at = at.withColumn("margin", F.col("margin") + _values(tree)).withColumn("trail", F.when(F.col("rated"), F.concat("trail", F.array("margin"))).otherwise(F.col("trail"))).persist()
            held.append(at)
        self._keep(at.checkpoint())
        for frame in held:
            frame.unpersist()

    def _advance_small(self, rounds: int) -> None:
        first = len(self.trees)
        kinds = dict(self.rows.dtypes)
        schema = ", ".join(f"{c} {kinds[c]}" for c in ROW) + ", trees string"
        out = self.rows.drop("trail").mapInArrow(_block_of_rounds(first, rounds, self.width, self.s, self.seed), schema).checkpoint()
        self.trees += [Tree(*columns) for columns in json.loads(out.where("trees IS NOT NULL").first()["trees"])]
        self._keep(out)
        self.rows = out.where("trees IS NULL").drop("trees")

    def _keep(self, rows: DataFrame) -> None:
        """Go on with a new checkpoint, without the files of the one before."""
        before, self.rows, self.kept = self.kept, rows, rows
        _drop(before)

    def close(self) -> None:
        """Delete the rows; the trees stay."""
        _drop(self.kept)

    def held_aucs(self) -> list[float]:
        """AUC of the rated rows after each of the last rounds."""
        # Dealt out by round: the rows may be in one partition, and what follows needs no other shuffle.
        scored = self.rows.where("NOT fits").select("y", F.posexplode("trail").alias("round", "p")).repartition("round")
        conf = self.rows.sparkSession.conf
        before = conf.get(CLEANUP)
        conf.set(CLEANUP, "true")  # the shuffle files go with the query
        try:
            found = {r["round"]: r["roc_auc"] for r in rank_metrics(scored, ["round"]).select("round", "roc_auc").collect()}
        finally:
            conf.set(CLEANUP, before)
        return [0.5 if found.get(k) is None else found[k] for k in range(max(found, default=-1) + 1)]

    def table(self, rounds: int) -> DataFrame:
        rows = [t.row(k) for k, t in enumerate(self.trees[:rounds])]
        return self.rows.sparkSession.createDataFrame(rows, TREE)


def best_round(aucs: list[float], patience: int) -> tuple[int, bool]:
    """Rounds up to the first best AUC, and whether ``patience`` rounds without gain ended the search."""
    best = 0
    for k, auc in enumerate(aucs):
        if auc > aucs[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def tune_rounds(train: DataFrame, edges: DataFrame, s: BoostingSettings = BoostingSettings(), seed: int = 42) -> dict:
    """Rounds found on an inner split in time: all but the last as-of day fit, the last decides.

    One sequence of rounds goes on until ``patience`` of them bring no better AUC on the held day, or to the cap. With
    a single as-of day a fifth of its customers, by hash, is held instead. The count grows with the ratio of rows for
    the final fit.
    """
    days = [r[0] for r in train.select(ASOF).distinct().orderBy(ASOF).collect()]
    held = F.col(ASOF) == F.lit(days[-1]) if len(days) > 1 else F.pmod(F.xxhash64(CUSTOMER), F.lit(5)) == 0
    run, aucs = Boosting(train, edges, ~held, s, seed, held), []
    while True:
        run.advance(min(run.block, s.max_rounds - len(run.trees)))
        aucs += run.held_aucs() or [0.5] * (len(run.trees) - len(aucs))
        best, stopped = best_round(aucs, s.patience)
        if stopped or len(run.trees) == s.max_rounds:
            break
    sizes = run.rows.agg(F.count("*").alias("n"), F.count_if("fits").alias("fits")).first()
    run.close()
    rounds = min(max(int(best * sizes["n"] / max(sizes["fits"], 1)), s.least_rounds), s.max_rounds)
    return {"tuned": True, "best_inner": best, "rounds": rounds, "cap": s.max_rounds, "searched": len(run.trees), "auc": aucs[best - 1]}


def fit(train: DataFrame, edges: DataFrame, rounds: int | Callable[[], int], s: BoostingSettings = BoostingSettings(), seed: int = 42) -> DataFrame:
    """The trees, as a table.

    A search for ``rounds`` runs beside the fit: the trees do not depend on their number, so those beyond it are left out.
    """
    with ThreadPoolExecutor(1) as beside:
        found = beside.submit(rounds if callable(rounds) else lambda: rounds)
        run = Boosting(train, edges, F.lit(True), s, seed, F.lit(False))
        while callable(rounds) and not found.done() and len(run.trees) < s.max_rounds:
            run.advance(min(run.block, s.max_rounds - len(run.trees)))
        while len(run.trees) < found.result():
            run.advance(min(run.block, found.result() - len(run.trees)))
        run.close()
        return run.table(found.result())


def _by_feature(feature: list[int], cut: list[int], left: list[int], value: list[float]) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
    """A tree as tables: for each feature and bin the leaves, as bits from the left, that it leaves possible; and the leaves' values.

    A row's leaf is the first one that all its features leave possible.
    """
    words, tables, values = -(-sum(x < 0 for x in left) // 64), {}, []

    def walk(node: int) -> None:
        if left[node] < 0:
            values.append(value[node])
            return
        start = len(values)
        walk(left[node])
        table = tables.setdefault(feature[node], np.full((words, BINS + 1), ~np.uint64(0)))
        gone = (1 << len(values)) - (1 << start)  # those to the left, for rows that go right
        for word in range(words):
            table[word, cut[node] + 1 :] &= ~np.uint64(gone >> 64 * word & (1 << 64) - 1)
        walk(left[node] + 1)

    walk(0)
    return list(tables.items()), np.array(values)


def margins(trees: DataFrame, rows: DataFrame) -> DataFrame:
    """Add ``margin`` to rows with ``bins``: the sum over all trees, which reach the tasks as one broadcast table."""
    nodes = [(r["feature"], r["cut"], r["left"], r["value"]) for r in trees.orderBy("tree").collect()]
    model = rows.sparkSession.sparkContext.broadcast(nodes)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [_by_feature(*tree) for tree in model.value]
        for batch in batches:
            n, total = batch.num_rows, np.zeros(batch.num_rows)
            columns = batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(n, -1).T.astype(np.intp, order="C") if n else None
            for tables, values in scorers if n else ():
                leaf = np.zeros(n, np.intp)
                for word in reversed(range(-(-len(values) // 64))):
                    possible = np.full(n, ~np.uint64(0))
                    for f, table in tables:
                        possible &= table[word][columns[f]]
                    here = 64 * word + np.bitwise_count(~possible & (possible - np.uint64(1))).astype(np.intp)
                    leaf = np.where(possible > 0, here, leaf)
                total += values[leaf]
            yield batch.append_column("margin", pa.array(total))

    return rows.mapInArrow(walk, StructType([*rows.schema.fields, StructField("margin", DoubleType())]))


def predict(model: tuple[DataFrame, DataFrame], rows: DataFrame) -> DataFrame:
    """Rows with the probability ``p`` of the positive class; ``model`` is (edges, trees)."""
    edges, trees = model
    return margins(trees, binned(rows, edges)).select(*rows.columns, (1 / (1 + F.exp(-F.col("margin")))).alias("p"))
