"""Regularised second-order boosted trees for a binary label, many models in the same passes over the rows.

Features are cut into quantile bins once, and the rows are kept as blocks of columns in binary values, so that a pass moves few
large values. Rows of a block with the same label, fold and bins form a cell: all trees give them the same margin, so a cell has it once,
and a pass only counts its rows that are in a tree's sample. Two features have at most 65 x 65 combinations of bins, however many rows
there are; where no two rows agree, a cell is a row. Every level of every tree is one aggregate: each task sums the gradients and
hessians of its rows per (model, node, feature, bin), the sums are added up across tasks, and the best split of each (model, node)
is picked from the running sums of its bins, so what reaches the driver is one row per node. A node that at most SUBTREE_ROWS cells reach
sends them, binned, to one task, which grows all of its subtree, if no pass thereby moves over MOVED_ROWS cells. All models of a search, each with its own held-out
fold, grow in the same aggregates. A model stops when the AUC of its held-out rows stops improving.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroute.operators.schema import col
from tallyroute.session import discard, materialize_at, scratch_path

BINS = 64
QUANTILE_ERROR = 0.001
STOP_AFTER = 20
#: Trees that are added to the margins by expression before the margins are written anew.
WRITE_EVERY = 4
SMALLEST_GAIN = 1e-6
SMALLEST_SUM = 1e-12  # what rounding may leave of a side without rows
SUM_PARTITIONS = 4
MOST_SUM_PARTITIONS = 512
MARGINS_A_TASK = 2_000_000
LEAST_MARGINS_A_TASK = 100_000  # where that leaves fewer than LEAST_TASKS tasks
LEAST_TASKS = 16
GROUP_ROWS = 500_000  # rows a task holds to find those that form a cell
BLOCK_BYTES = 400_000  # margins in a block
MOST_BLOCK_CELLS = 10_000
SUBTREE_ROWS = 500_000  # cells of a node whose subtree one task grows
MOVED_ROWS = 20_000_000  # cells, once for each model, that a pass sends so at most
SENT_ROWS = 100_000  # cells a task holds before it sends them
NODES_A_GROUP = 16  # nodes of a level whose sums are added up together
LAST_BIN = np.iinfo(np.int8).max  # no row's bin is greater
#: Held-out probabilities are compared to this many places.
AUC_PLACES = 4


@dataclass(frozen=True)
class Params:
    """One model's parameters; the meaning of each is that of gradient boosting with a second-order gain."""

    max_depth: int = 6
    learning_rate: float = 0.3
    n_estimators: int = 100
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    min_child_weight: float = 1.0
    gamma: float = 0.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0


@dataclass
class Tree:
    """Nodes by heap number (root 1, children 2n and 2n + 1): the split of inner ones, the value of leaves, the cover of all."""

    depth: int
    feature: dict[int, int] = field(default_factory=dict)
    bin: dict[int, int] = field(default_factory=dict)
    missing_left: dict[int, bool] = field(default_factory=dict)
    gain: dict[int, float] = field(default_factory=dict)
    sums: dict[int, tuple[float, float]] = field(default_factory=dict)
    value: dict[int, float] = field(default_factory=dict)

    def grown_depth(self) -> int:
        """Levels of splits there are."""
        return max((n.bit_length() for n in self.feature), default=0)

    def arrays(self, depth: int) -> dict[str, np.ndarray]:
        """The tree as arrays over the heap numbers down to a depth; below a leaf every row goes left, with the leaf's value."""
        size = 2 ** (depth + 1)
        made = {
            "feature": np.zeros(size, np.int64), "bin": np.full(size, LAST_BIN, np.int8), "far": np.zeros(size, bool), "value": np.zeros(size),
        }
        for n in range(1, size):
            if n in self.feature:
                made["feature"][n], made["bin"][n], made["far"][n] = self.feature[n], self.bin[n], not self.missing_left[n]
            made["value"][n] = self.value.get(n, 0.0) if n == 1 or n // 2 in self.feature else made["value"][n // 2]
        return made

    def settle(self, params: Params) -> None:
        """Take back splits below the smallest gain, from the bottom, and give the leaves their values."""
        for n in sorted(self.feature, reverse=True):
            if 2 * n not in self.feature and 2 * n + 1 not in self.feature and self.gain[n] < params.gamma:
                for part in (self.feature, self.bin, self.missing_left, self.gain):
                    del part[n]
        reached = [1]
        for n in reached:
            if n in self.feature:
                reached += [2 * n, 2 * n + 1]
        self.sums = {n: self.sums[n] for n in reached}
        self.value = {n: params.learning_rate * weight(*self.sums[n], params) for n in reached if n not in self.feature}


def shrunk(g: float, alpha: float) -> float:
    return math.copysign(max(abs(g) - alpha, 0.0), g)


def weight(g: float, h: float, params: Params) -> float:
    """Best value of a leaf with these sums of gradients and hessians."""
    return -shrunk(g, params.reg_alpha) / (h + params.reg_lambda) if h + params.reg_lambda > 0 else 0.0


@dataclass
class Boosted:
    """Fitted trees over named features, on top of ``base``, the log-odds of all training rows.

    ``edges`` are the upper ends of each feature's bins but the last.
    """

    features: list[str]
    edges: list[list[float]]
    trees: list[Tree]
    params: Params
    base: float = 0.0
    aucs: list[float] = field(default_factory=list)

    def _bound(self, tree: Tree, node: int) -> float | None:
        """Up to which value rows go left at a split; none parts missing values from all others."""
        edges, place = self.edges[tree.feature[node]], tree.bin[node]
        return edges[place] if place < len(edges) else None

    def log_odds(self) -> Column:
        """Sum of the trees' leaves as a column expression; null and NaN are missing."""
        values = F.array(*[_value(name) for name in self.features])
        listed = []
        for tree in self.trees:
            places = range(2 ** (tree.depth + 1))
            at = [self._bound(tree, n) if n in tree.feature else None for n in places]
            listed.append({
                "feature": [tree.feature.get(n) for n in places], "at": at, "left": [tree.missing_left.get(n, False) for n in places],
                "value": [tree.value.get(n, 0.0) for n in places], "depth": tree.depth,
            })
        if not listed:
            return F.lit(self.base)
        kind = "array<struct<feature:array<int>,at:array<double>,left:array<boolean>,value:array<double>,depth:int>>"
        trees = F.from_json(F.lit(json.dumps(listed)), kind)

        def leaf(tree: Column) -> Column:
            def down(n: Column, _: Column) -> Column:
                x, at = F.get(values, F.get(tree["feature"], n)), F.get(tree["at"], n)
                right = F.when(x.isNull(), ~F.get(tree["left"], n)).otherwise(F.coalesce(x > at, F.lit(False)))
                return F.when(F.get(tree["feature"], n).isNull(), n).otherwise(2 * n + right.cast("int"))

            return F.get(tree["value"], F.aggregate(F.sequence(F.lit(1), F.greatest(tree["depth"], F.lit(1))), F.lit(1), down))

        return F.aggregate(trees, F.lit(self.base), lambda total, tree: total + leaf(tree))

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.log_odds()))

    def importance(self) -> dict[str, float]:
        """Share of each feature in the gains of all splits."""
        total = dict.fromkeys(self.features, 0.0)
        for tree in self.trees:
            for n, f in tree.feature.items():
                total[self.features[f]] += tree.gain[n]
        whole = sum(total.values())
        return {name: gain / whole if whole else 0.0 for name, gain in total.items()}


def _value(name: str) -> Column:
    value = col(name).cast("double")
    return F.when(~F.isnan(value), value)


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Upper ends of each feature's bins but the last: its quantiles over all rows, so at most ``bins`` - 1 values."""
    shares = [i / bins for i in range(1, bins)]
    found = df.select(*[_value(name).alias(f"f{i}") for i, name in enumerate(features)])
    quantiles = found.approxQuantile(found.columns, shares, QUANTILE_ERROR)
    tops = found.agg(*[F.max(c).alias(c) for c in found.columns]).first()
    return [sorted({q for q in some if q < top}) if top is not None else [] for some, top in zip(quantiles, tops)]


BLOCK_DDL = "rid binary, n binary, y binary, fold binary, bins binary"
BLOCK_SCHEMA = pa.schema([(name, pa.binary()) for name in ("rid", "n", "y", "fold", "bins")])


def alike(columns: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows that brings those together that agree in all columns (of whole numbers), and where each such group begins."""
    code, width = np.zeros(len(columns[0]), np.int64), 1
    for column in columns:
        low = int(column.min())
        span = int(column.max()) - low + 1
        if width * span >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
            width = int(code.max()) + 1
        code, width = code * span + (column - low), width * span
    order = np.argsort(code.astype(np.uint16) if width <= 1 << 16 else code, kind="stable")
    code = code[order]
    return order, np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))


def id_bytes(rid: np.ndarray) -> bytes:
    """Row ids of one task: the least one, and how far the others are above it."""
    least = rid.min()
    return least.tobytes() + (rid - least).astype(np.uint32).tobytes()


def ids_at(batch: pa.RecordBatch, row: int) -> np.ndarray:
    held = batch.column("rid")[row].as_buffer()
    return np.frombuffer(held, np.uint32, offset=8) + np.frombuffer(held, np.int64, 1)


def binned(df: DataFrame, features: Sequence[str], label: str, edges: list[list[float]], fold: Column, models: int = 1) -> DataFrame:
    """Blocks of cells: n (rows of each cell), y, fold, bins (feature by feature the number of edges below the value, -1 if missing), and rid, the rows cell by cell.

    ``fold`` may use ``rid`` and ``_fold``, a column of ``df``; a block has room for the margins of so many models.
    """
    kept = [F.col("_fold")] if "_fold" in df.columns else []
    values = [_value(name).alias(f"v{i}") for i, name in enumerate(features)]
    rows = df.select(F.monotonically_increasing_id().alias("rid"), col(label).cast("double").alias("y"), *kept, *values)
    rows = rows.select("rid", "y", fold.cast("int").alias("fold"), *[f"v{i}" for i in range(len(features))])
    size = max(1, min(MOST_BLOCK_CELLS, BLOCK_BYTES // (8 * models)))

    def place(values: np.ndarray, ends: list[float]) -> np.ndarray:
        return np.where(np.isnan(values), -1, np.searchsorted(ends, values)).astype(np.int8)

    def blocks(held):
        rid, y, own = (np.concatenate(side) for side in list(zip(*held))[:3])
        bins = np.concatenate([side[3] for side in held], axis=1)
        order, begin = alike([own, np.unique(y, return_inverse=True)[1], *bins])
        first, ends = order[begin], np.append(begin, len(order))
        rid, y, own, bins = rid[order], y[first], own[first], bins[:, first]
        for start in range(0, len(begin), size):
            here = slice(start, min(start + size, len(begin)))
            n = np.diff(ends[here.start : here.stop + 1]).astype(np.int32)
            parts = [id_bytes(rid[ends[here.start] : ends[here.stop]]), *(part.tobytes() for part in (n, y[here], own[here], bins[:, here]))]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.binary()) for part in parts], schema=BLOCK_SCHEMA)

    def pack(batches):
        held, n = [], 0
        for batch in batches:
            rid, y, own, *values = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if len(rid):
                bins = np.stack([place(v, ends) for v, ends in zip(values, edges, strict=True)])
                held.append((rid.astype(np.int64), y.astype(np.float64), own.astype(np.int32), bins))
                n += len(rid)
            if n >= GROUP_ROWS:
                yield from blocks(held)
                held, n = [], 0
        if n:
            yield from blocks(held)

    return rows.mapInArrow(pack, BLOCK_DDL)


PART_DDL = "m int, node int, kind int, at binary, g binary, h binary, n binary"
PART_SCHEMA = pa.schema([("m", pa.int32()), ("node", pa.int32()), ("kind", pa.int32()), *((name, pa.binary()) for name in ("at", "g", "h", "n"))])
SUMS, ROWS, AUC = 1, 2, 3  # kinds of parts: sums of nodes, binned rows of a node, held-out rows by probability


BEST_DDL = "m int, node int, f int, bin int, missing_left boolean, gain double, gl double, hl double, ga double, ha double, auc double, nl long, na long"
BEST_SCHEMA = pa.schema(
    [("m", pa.int32()), ("node", pa.int32()), ("f", pa.int32()), ("bin", pa.int32()), ("missing_left", pa.bool_())]
    + [(name, pa.float64()) for name in ("gain", "gl", "hl", "ga", "ha", "auc")]
    + [("nl", pa.int64()), ("na", pa.int64())]
)


def best_split(g: np.ndarray, h: np.ndarray, params: Params) -> tuple:
    """Column, bin, whether missing values go left, gain, sums of the left side, and sums of the node.

    ``g`` and ``h`` hold a row per feature, its first cell the missing values. Gains that are equal to nine places go to the
    first feature, then the lowest bin, then missing values to the left. Without a split the gain is -1.
    """
    ga, ha = g.sum(axis=1)[:, None, None], h.sum(axis=1)[:, None, None]
    # Both ways for the missing values: with the left side, then with the right one.
    gl, hl = (np.stack([c := x.cumsum(axis=1)[:, 1:], c - x[:, :1]], axis=2) for x in (g, h))

    def score(g, h):
        return np.maximum(np.abs(g) - params.reg_alpha, 0) ** 2 / (h + params.reg_lambda)

    allowed = (h[:, 1:, None] > 0) & (np.minimum(hl, ha - hl) >= params.min_child_weight) & (hl > 0) & (ha - hl > SMALLEST_SUM)
    allowed[:, :, 1] &= h[:, :1] > 0
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(allowed, score(gl, hl) + score(ga - gl, ha - hl) - score(ga, ha), -1.0)
    f, place, side = np.unravel_index(np.round(gain, 9).argmax(), gain.shape)
    return (int(f), int(place), side == 0, float(gain[f, place, side]), float(gl[f, place, side]), float(hl[f, place, side]), float(ga[f, 0, 0]), float(ha[f, 0, 0]))


def area(positives: np.ndarray, negatives: np.ndarray) -> float | None:
    """Area under the ROC curve from counts by score; none without a row of either label."""
    below = negatives.cumsum() - negatives / 2
    pairs = positives.sum() * negatives.sum()
    return float((positives * below).sum() / pairs) if pairs else None


def left_rows(n: np.ndarray, place: int, missing_left: bool) -> int:
    """Rows of the left side of a split, given those of each cell of its feature."""
    return int(n[1 : place + 2].sum() + (n[0] if missing_left else 0))


def walked(tree: dict[str, np.ndarray], bins: np.ndarray, steps: int) -> np.ndarray:
    """The node that each row reaches in so many steps; ``bins`` has a row per feature."""
    n = bins.shape[1]
    node, rows, flat = np.ones(n, np.int64), np.arange(n), bins.ravel()
    for step in range(steps):
        here = slice(1 << step, 2 << step)
        own = flat.take(tree["feature"].take(node) * n + rows)
        right = own > tree["bin"].take(node)
        if tree["far"][here].any():
            right |= (own < 0) & tree["far"].take(node)
        node = 2 * node + right
    return node


def grown(bins: np.ndarray, g: np.ndarray, h: np.ndarray, params: Params, per_node: int, root: int) -> list[tuple]:
    """The subtree below a node of these rows: (node, the split as in ``best_split``, rows left, rows) of the node and of every split."""
    node, found, first = np.zeros(len(g), np.int64), [], root
    for level in range(root.bit_length() - 1, params.max_depth):
        nodes = first // root
        size = nodes * per_node
        at = node * per_node + 1
        sums = np.stack([[np.bincount(at + own, weights, size) for own in bins] for weights in (g, h, None)]).reshape(3, len(bins), nodes, per_node)
        f, place, far, splits = np.zeros(nodes, np.int64), np.full(nodes, LAST_BIN, np.int8), np.zeros(nodes, bool), np.zeros(nodes, bool)
        for i in np.flatnonzero(sums[2, 0].any(axis=1)):
            best = best_split(sums[0, :, i], sums[1, :, i], params)
            splits[i] = best[3] > SMALLEST_GAIN
            if splits[i] or level == root.bit_length() - 1:
                n = sums[2, best[0], i]
                found.append((first + int(i), *best, left_rows(n, best[1], best[2]), int(n.sum())))
            f[i], place[i], far[i] = best[0], best[1], not best[2]
        keep = splits[node]
        if not keep.any():
            break
        bins, g, h, node = bins[:, keep], g[keep], h[keep], node[keep]
        own = bins[f[node], np.arange(len(node))]
        node = 2 * node + ((own > place[node]) | ((own < 0) & far[node]))
        first *= 2
    return found


def in_sample(rid: np.ndarray, seed: int, share: float) -> np.ndarray:
    """Which rows a tree sees: by a hash of row and seed."""
    if share >= 1:
        return np.ones(len(rid), bool)
    x = rid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) < np.uint64(int(share * 2**63) * 2)


def sampled(rid: np.ndarray, n: np.ndarray, seed: int, share: float) -> np.ndarray:
    """How many of each cell's rows a tree sees."""
    own = in_sample(rid, seed, share)
    return own.astype(np.int64) if len(own) == len(n) else np.add.reduceat(own, np.cumsum(n) - n, dtype=np.int64)


def part(m: int, node: int, kind: int, *columns: np.ndarray) -> tuple:
    """A row of parts; sums and counts by cell, or a node's rows."""
    return m, node, kind, *(c.tobytes() for c in columns), *([b""] * (4 - len(columns)))


def part_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, field.type) for c, field in zip(zip(*rows, strict=True), schema)], schema=schema)


def array_at(batch: pa.RecordBatch, name: str, row: int, kind) -> np.ndarray:
    return np.frombuffer(batch.column(name)[row].as_buffer(), kind)


@dataclass
class Model:
    """A model while it grows."""

    params: Params
    held: int
    seed: int
    trees: list[Tree] = field(default_factory=list)
    aucs: list[float] = field(default_factory=list)
    growing: bool = True
    base: float = 0.0
    tree: Tree | None = None
    columns: list[int] = field(default_factory=list)
    cells: int = 0

    def next_tree(self, n_features: int) -> None:
        draw = random.Random(f"{self.seed}:{len(self.trees)}")
        size = max(1, int(self.params.colsample_bytree * n_features))
        self.columns = sorted(draw.sample(range(n_features), size))
        self.tree = Tree(self.params.max_depth)


class Grower:
    """Grows models tree by tree over one binned table."""

    def __init__(self, table: DataFrame, models: list[Model], n_features: int, bins: int = BINS):
        # Sums per model, node, feature and bin are small whatever the table: they need few partitions and no re-planning.
        self.spark = table.sparkSession.newSession()
        self.spark.conf.set("spark.sql.adaptive.enabled", "false")
        self.spark.conf.set("spark.sql.shuffle.partitions", str(SUM_PARTITIONS))
        # A row of these tables is a block: few at a time fill a batch.
        self.spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "16")
        self.spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
        self.models, self.n_features, self.bins = models, n_features, bins
        self.path = scratch_path(self.spark, "margins")

        def counted(batches):
            for batch in batches:
                rows = []
                for i in range(batch.num_rows):
                    own, y, n = (array_at(batch, c, i, kind) for c, kind in (("fold", np.int32), ("y", np.float64), ("n", np.int32)))
                    for fold in np.unique(own):
                        here = own == fold
                        rows.append((int(fold), int(here.sum()), int(n[here].sum()), float((y[here] * n[here]).sum())))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["fold", "cells", "n", "placed"])

        counts = table.mapInArrow(counted, "fold long, cells long, n long, placed double").groupBy("fold")
        folds = {r.fold: r[1:] for r in counts.agg(F.sum("cells"), F.sum("n"), F.sum("placed")).collect()}
        for model in models:
            model.cells, rows, placed = (sum(own[i] for fold, own in folds.items() if fold != model.held) for i in range(3))
            model.base = math.log(placed / (rows - placed)) if 0 < placed < rows else 0.0
        bases = np.array([model.base for model in models])

        def begun(batches):
            for batch in batches:
                start = [np.repeat(bases, len(array_at(batch, "y", i, np.float64))).tobytes() for i in range(batch.num_rows)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(start, pa.binary())], names=[*batch.schema.names, "margins"])

        work = sum(cells * len(models) + n for cells, n, _ in folds.values())
        tasks = min(math.ceil(work / LEAST_MARGINS_A_TASK), max(LEAST_TASKS, math.ceil(work / MARGINS_A_TASK)))
        ddl = f"{BLOCK_DDL}, margins binary"
        start = table.repartition(max(tasks, 1)).mapInArrow(begun, ddl)
        materialize_at(start, self.path)
        self.state = self.spark.read.schema(start.schema).parquet(self.path)
        self.written = [0] * len(models)

    def _plan(self, open_nodes: dict[int, dict[int, int]]) -> list[dict]:
        """What the tasks need to know of the models that grow or have trees not yet in the margins."""
        plan = []
        for m, model in enumerate(self.models):
            pending = [(t.arrays(depth), depth) for t in model.trees[self.written[m] :] for depth in [t.grown_depth()]]
            if m in open_nodes or pending:
                seed = random.Random(f"rows {model.seed}:{len(model.trees)}").getrandbits(62)
                plan.append({"m": m, "held": model.held, "columns": np.array(model.columns, np.int64), "share": model.params.subsample, "seed": seed,
                             "growing": m in open_nodes, "pending": pending})
        return plan

    def write_margins(self) -> None:
        """Add the trees grown since the last time to the written margins."""
        plan, width, n_features = self._plan({}), len(self.models), self.n_features

        def add(batches):
            for batch in batches:
                made = []
                for i in range(batch.num_rows):
                    bins, margins = array_at(batch, "bins", i, np.int8).reshape(n_features, -1), array_at(batch, "margins", i, np.float64).reshape(width, -1).copy()
                    for own in plan:
                        for tree, depth in own["pending"]:
                            margins[own["m"]] += tree["value"].take(walked(tree, bins, depth))
                    made.append(margins.tobytes())
                at = batch.schema.get_field_index("margins")
                yield batch.set_column(at, batch.schema.field(at).name, pa.array(made, pa.binary()))

        path = scratch_path(self.spark, "margins")
        self.state = materialize_at(self.state.mapInArrow(add, self.state.schema), path)
        discard(self.spark, self.path)
        self.path, self.written = path, [len(model.trees) for model in self.models]

    def level(self, open_nodes: dict[int, dict[int, int]], level: int) -> list:
        """Best splits of the open nodes (per model: node to cells that may reach it) of a level, and all splits below the small ones.

        One row per node; at the top also the AUC of the held-out rows so far.
        """
        width, n_features, per_node = len(self.models), self.n_features, self.bins + 1
        nodes, places = 1 << level, 10**AUC_PLACES + 1
        small = {(m, n) for m, own in open_nodes.items() for n, cells in own.items() if cells <= SUBTREE_ROWS}
        if sum(open_nodes[m][n] for m, n in small) > MOVED_ROWS:
            small = set()
        self.finished = small
        plan = [p for p in self._plan(open_nodes) if p["growing"]]
        for own in plan:
            m = own["m"]
            own["tree"], own["kind"] = self.models[m].tree and self.models[m].tree.arrays(level), np.zeros(nodes, np.int8)
            for n in open_nodes[m]:
                own["kind"][n - nodes] = ROWS if (m, n) in small else SUMS
            own["kinds"] = set(own["kind"].tolist())

        def cells(batches):
            # Sums of the task's rows: as many as models, nodes, features and bins, whatever the number of rows.
            sums = {p["m"]: np.zeros((3, len(p["columns"]), nodes * per_node)) for p in plan if SUMS in p["kinds"]}
            held = {p["m"]: np.zeros((2, places)) for p in plan if level == 0}
            rows, n_rows = [], 0
            for batch in batches:
                for i in range(batch.num_rows):
                    y, fold, n = (array_at(batch, c, i, kind) for c, kind in (("y", np.float64), ("fold", np.int32), ("n", np.int32)))
                    bins, margins = array_at(batch, "bins", i, np.int8).reshape(n_features, -1), array_at(batch, "margins", i, np.float64).reshape(width, -1)
                    samples = {}  # the folds of a trial share their sample
                    for own in plan:
                        margin = margins[own["m"]]
                        for tree, depth in own["pending"]:
                            margin = margin + tree["value"].take(walked(tree, bins, depth))
                        p = 1 / (1 + np.exp(-margin))
                        if level == 0:
                            test = fold == own["held"]
                            place = np.rint(p[test] * (places - 1)).astype(np.int64)
                            for j, label in enumerate((y[test] * n[test], (1 - y[test]) * n[test])):
                                held[own["m"]][j] += np.bincount(place, label, places)
                        if own["tree"] is None:
                            continue
                        node = walked(own["tree"], bins, level) - nodes
                        kind = own["kind"].take(node)
                        seen, times = (fold != own["held"]) & (kind > 0), n
                        if own["share"] < 1:
                            drawn = own["seed"], own["share"]
                            if drawn not in samples:
                                samples[drawn] = sampled(ids_at(batch, i), n, *drawn)
                            times = samples[drawn]
                            seen &= times > 0
                        g, h = (p - y) * times, p * (1 - p) * times
                        if SUMS in own["kinds"]:
                            here = np.flatnonzero(seen & (kind == SUMS))
                            start, weights = node[here] * per_node + 1, (g[here], h[here], None)
                            for j, f in enumerate(own["columns"]):
                                at = start + bins[f].take(here)
                                for part_of, w in enumerate(weights):
                                    sums[own["m"]][part_of, j] += np.bincount(at, w, nodes * per_node)
                        if ROWS in own["kinds"]:
                            here = np.flatnonzero(seen & (kind == ROWS))
                            here = here[np.argsort(node[here], kind="stable")]
                            which, begin = np.unique(node[here], return_index=True)
                            for at, sent in zip(which.tolist(), np.split(here, begin[1:])):
                                rows.append(part(own["m"], nodes + at, ROWS, bins[own["columns"]][:, sent], g[sent], h[sent]))
                                n_rows += len(sent)
                    if n_rows >= SENT_ROWS:
                        yield part_batch(rows, PART_SCHEMA)
                        rows, n_rows = [], 0
            if rows:
                yield part_batch(rows, PART_SCHEMA)
            for m, own in sums.items():
                for first in range(0, nodes, NODES_A_GROUP):
                    g, h, n = own[:, :, first * per_node : (first + NODES_A_GROUP) * per_node].reshape(3, -1)
                    (at,) = np.nonzero(n)
                    if len(at):
                        yield part_batch([part(m, nodes + first, SUMS, at, g[at], h[at], n[at])], PART_SCHEMA)
            for m, (pos, neg) in held.items():
                (at,) = np.nonzero(pos + neg)
                yield part_batch([part(m, 1, AUC, at, pos[at], neg[at])], PART_SCHEMA)

        # The tasks' sums are added and compared where the cells of a node come together: one shuffle a level, as large
        # as the sums of all tasks and the rows of the small nodes.
        groups = len(small) + sum(math.ceil(nodes / NODES_A_GROUP) for p in plan if SUMS in p["kinds"])
        parts = min(max(SUM_PARTITIONS, groups), MOST_SUM_PARTITIONS)
        params, columns = [model.params for model in self.models], [model.columns for model in self.models]
        group = min(nodes, NODES_A_GROUP)

        def choose(batches):
            sums, scores, members = {}, {}, {}
            for batch in batches:
                for i, (m, node, kind) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("m", "node", "kind")), strict=True)):
                    g, h = (array_at(batch, c, i, np.float64) for c in ("g", "h"))
                    if kind == ROWS:
                        members.setdefault((m, node), []).append((array_at(batch, "at", i, np.int8).reshape(len(columns[m]), -1), g, h))
                        continue
                    at, size = array_at(batch, "at", i, np.int64), places if kind == AUC else len(columns[m]) * group * per_node
                    whole = [g, h] if kind == AUC else [g, h, array_at(batch, "n", i, np.float64)]
                    to = (scores if kind == AUC else sums).setdefault((m, node), np.zeros((len(whole), size)))
                    for own, more in zip(to, whole):
                        own[at] += more
            rows = []
            for (m, first), own in sums.items():
                own = own.reshape(3, len(columns[m]), group, per_node)
                for i in np.flatnonzero(own[2, 0].any(axis=1)):
                    best = best_split(own[0, :, i], own[1, :, i], params[m])
                    n = own[2, best[0], i]
                    rows.append((m, first + int(i), columns[m][best[0]], *best[1:], None, left_rows(n, best[1], best[2]), int(n.sum())))
            for (m, node), held in members.items():
                bins, g, h = (np.concatenate(side, axis=-1) for side in zip(*held, strict=True))
                for n, f, *split, nl, na in grown(bins, g, h, params[m], per_node, node):
                    rows.append((m, n, columns[m][f], *split, None, nl, na))
            rows += [(m, 1, *[None] * 8, area(*own), None, None) for (m, _), own in scores.items()]
            if rows:
                yield part_batch(rows, BEST_SCHEMA)

        return self.state.mapInArrow(cells, PART_DDL).repartition(parts, "m", "node").mapInArrow(choose, BEST_DDL).collect()

    def round(self, growing: list[int]) -> None:
        """One more tree for each of the models, and the AUC before it."""
        if max(len(self.models[m].trees) - self.written[m] for m in growing) >= WRITE_EVERY:
            self.write_margins()
        for m in growing:
            self.models[m].next_tree(self.n_features)
        open_nodes, level = {m: {1: self.models[m].cells} for m in growing}, 0
        while open_nodes:
            below: dict[int, dict[int, int]] = {}
            for best in self.level(open_nodes, level):
                model, n = self.models[best.m], best.node
                if best.auc is not None:
                    model.aucs.append(best.auc)
                if best.ga is None:
                    continue
                if n == 1:
                    model.tree.sums[1] = (best.ga, best.ha)
                if best.gain > SMALLEST_GAIN:
                    model.tree.feature[n], model.tree.bin[n], model.tree.missing_left[n], model.tree.gain[n] = best.f, best.bin, best.missing_left, best.gain
                    model.tree.sums[2 * n], model.tree.sums[2 * n + 1] = (best.gl, best.hl), (best.ga - best.gl, best.ha - best.hl)
                    if level + 1 < model.params.max_depth and n in open_nodes[best.m] and (best.m, n) not in self.finished:
                        below.setdefault(best.m, {}).update({2 * n: best.nl, 2 * n + 1: best.na - best.nl})
            open_nodes, level = below, level + 1
        for m in growing:
            model = self.models[m]
            if 1 in model.tree.sums:
                model.tree.settle(model.params)
                model.trees.append(model.tree)
            else:
                model.growing = False
            model.tree = None

    def last_aucs(self, models: list[int]) -> None:
        """The AUC after the last tree."""
        for row in self.level({m: {} for m in models}, 0):
            if row.auc is not None:
                self.models[row.m].aucs.append(row.auc)

    def close(self) -> None:
        discard(self.spark, self.path)


def _rounds(grower: Grower, groups: list[list[int]], rounds: int, stop_after: int) -> list[list[float]]:
    """Grow groups of models (the folds of a trial) until each stops improving in its mean AUC; the mean AUCs per group and round.

    The first AUC is that after the first tree; a group without a held-out row of either label never stops early.
    """
    history: list[list[float]] = [[] for _ in groups]

    def going(i: int) -> bool:
        seen, models = history[i], [grower.models[m] for m in groups[i]]
        grown = len(models[0].trees)
        best = max(range(len(seen)), key=lambda r: seen[r]) if seen else -1
        return grown < min(rounds, models[0].params.n_estimators) and len(seen) - 1 - best < stop_after and all(m.growing for m in models)

    def note(i: int) -> None:
        # A fold whose held-out rows all have one label has no AUC; the others decide.
        own = [grower.models[m].aucs for m in groups[i] if grower.models[m].aucs]
        upto = min(map(len, own), default=0)
        # The AUC before the first tree is that of a constant.
        history[i] = [sum(a[r] for a in own) / len(own) for r in range(1, upto)]

    active = [i for i in range(len(groups))]
    for i in active:
        note(i)
    while active := [i for i in active if going(i)]:
        grower.round([m for i in active for m in groups[i]])
        for i in active:
            note(i)
    return history


def fit(
    train: DataFrame, val: DataFrame | None, features: Sequence[str], label: str, params: Params | None = None,
    *, seed: int = 42, bins: int = BINS, stop_after: int = STOP_AFTER,
) -> Boosted:
    """Boosted trees; with ``val`` they end ``stop_after`` rounds after its best AUC, and those up to the best are kept.

    Rows without a label are left out.
    """
    params, names = params or Params(), list(features)
    keep = [*[col(f) for f in names], col(label)]
    rows = train.select(*keep, F.lit(0).alias("_fold"))
    if val is not None:
        rows = rows.unionByName(val.select(*keep, F.lit(1).alias("_fold")))
    rows = rows.where(col(label).isNotNull())
    edges = bin_edges(rows.where("_fold = 0"), names, bins)
    path = scratch_path(train.sparkSession, "binned")
    table = materialize_at(binned(rows, names, label, edges, F.col("_fold")), path)
    grower = Grower(table, [Model(params, 1, seed)], len(names), bins)
    (model,) = grower.models
    (aucs,) = _rounds(grower, [[0]], params.n_estimators, stop_after)
    if val is not None and model.trees:
        grower.last_aucs([0])
        aucs = model.aucs[1:]
    grower.close()
    discard(train.sparkSession, path)
    kept = max(range(len(aucs)), key=lambda r: aucs[r]) + 1 if val is not None and aucs else len(model.trees)
    return Boosted(names, edges, model.trees[:kept], params, model.base, aucs)


def whole(low: int, high: int):
    """A whole number: from the unit scale, and back to it."""
    return (lambda u: min(high, low + int(u * (high - low + 1))), lambda v: (v - low + 0.5) / (high - low + 1))


def even(low: float, high: float):
    """A number, evenly."""
    return (lambda u: low + u * (high - low), lambda v: (v - low) / (high - low))


def scaled(low: float, high: float):
    """A number, evenly on a logarithmic scale."""
    return (lambda u: low * (high / low) ** u, lambda v: math.log(v / low) / math.log(high / low))


# The names and bounds of the search space.
SPACE: dict[str, tuple[Callable, Callable]] = {
    "max_depth": whole(3, 8),
    "learning_rate": scaled(0.01, 0.3),
    "n_estimators": whole(100, 600),
    "subsample": even(0.6, 1.0),
    "colsample_bytree": even(0.6, 1.0),
    "min_child_weight": whole(1, 10),
    "gamma": even(0.0, 1.0),
    "reg_alpha": even(0.0, 1.0),
    "reg_lambda": even(0.5, 2.0),
}
TRIALS = 50
FOLDS = 5
BATCH = 10  # trials that are drawn and grown together
FIRST_RUNG = 20  # rounds after which the better half of a batch goes on, then twice as many, and so on
GOOD_SHARE = 0.25
CANDIDATES = 24


def draw_params(done: list[tuple[Params, float]], generator: random.Random, space=None) -> Params:
    """Parameters for the next trial: at random at first, then where the better quarter of the trials lies denser than the rest.

    Each parameter is modelled by itself, by a Gaussian kernel around every trial in the unit scale of its range.
    """
    space = space or SPACE
    ranked = sorted(done, key=lambda pair: -pair[1])
    cut = max(1, math.ceil(GOOD_SHARE * len(ranked)))
    good, rest = ranked[:cut], ranked[cut:]
    drawn = {}
    for name, (make, unit) in space.items():
        if len(done) < BATCH:
            drawn[name] = make(generator.random())
            continue
        better, worse = ([unit(getattr(p, name)) for p, _ in part] for part in (good, rest))
        wide = max(0.05, len(better) ** -0.5 / 4)

        def density(u: float, points: list[float], wide: float = wide) -> float:
            return (1 + sum(math.exp(-(((u - x) / wide) ** 2) / 2) for x in points)) / (1 + len(points))

        tried = [min(1 - 1e-9, max(0.0, generator.gauss(generator.choice(better), wide))) for _ in range(CANDIDATES)]
        drawn[name] = make(max(tried, key=lambda u: density(u, better) / density(u, worse)))
    return Params(**drawn)


@dataclass
class Trial:
    """A drawn set of parameters, its best mean AUC over the folds, and the rounds until then."""

    number: int
    params: Params
    auc: float
    rounds: int


def search(
    train: DataFrame, features: Sequence[str], label: str, *, trials: int = TRIALS, folds: int = FOLDS, seed: int = 42,
    space=None, bins: int = BINS, batch: int = BATCH, first_rung: int = FIRST_RUNG, stop_after: int = STOP_AFTER,
) -> list[Trial]:
    """Cross-validated search; the trials in the order they were drawn.

    Trials are drawn in batches, each from what the ones before showed. All folds of all trials of a batch grow in the same
    aggregates; after ``first_rung`` rounds, twice as many and so on the better half goes on. A trial ends ``stop_after``
    rounds after its best mean AUC.
    """
    names, generator = list(features), random.Random(seed)
    rows = train.select(*[col(f) for f in names], col(label)).where(col(label).isNotNull())
    edges = bin_edges(rows, names, bins)
    path = scratch_path(train.sparkSession, "binned")
    fold = F.pmod(F.xxhash64("rid", F.lit(seed)), F.lit(folds))
    table = materialize_at(binned(rows, names, label, edges, fold, min(batch, trials) * folds), path)
    done: list[Trial] = []
    while len(done) < trials:
        known = [(t.params, t.auc) for t in done]
        drawn = [draw_params(known, generator, space) for _ in range(min(batch, trials - len(done)))]
        models = [Model(p, fold, seed + len(done) + i) for i, p in enumerate(drawn) for fold in range(folds)]
        grower = Grower(table, models, len(names), bins)
        groups = [list(range(i * folds, (i + 1) * folds)) for i in range(len(drawn))]
        seen: list[list[float]] = [[] for _ in groups]
        running, rounds = list(range(len(groups))), first_rung
        most = max(p.n_estimators for p in drawn)
        while running:
            for i, aucs in zip(running, _rounds(grower, [groups[i] for i in running], rounds, stop_after), strict=True):
                seen[i] = aucs
            if rounds >= most:
                break
            best = sorted(running, key=lambda i: -max(seen[i], default=0.0))[: max(1, len(running) // 2)]
            ended = [i for i in best if len(seen[i]) + 1 < rounds or not all(models[m].growing for m in groups[i])]
            running, rounds = [i for i in best if i not in ended], rounds * 2
        grower.close()
        for i, (params, aucs) in enumerate(zip(drawn, seen, strict=True)):
            top = max(range(len(aucs)), key=lambda r: aucs[r]) if aucs else -1
            done.append(Trial(len(done), params, aucs[top] if aucs else float("nan"), top + 1))
    discard(train.sparkSession, path)
    return done


def best_params(trials: list[Trial]) -> Params:
    """Parameters of the trial with the highest AUC; of equal ones the first."""
    return max(trials, key=lambda t: (not math.isnan(t.auc), t.auc, -t.number)).params


def save(model: Boosted, spark: SparkSession, path: str) -> None:
    """The model as one JSON document; an older one at ``path`` is replaced."""
    spark.createDataFrame([(json.dumps(asdict(model)),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load(spark: SparkSession, path: str) -> Boosted:
    found = json.loads(spark.read.text(path, wholetext=True).first()[0])
    parts = ("feature", "bin", "missing_left", "gain", "sums", "value")
    trees = [Tree(t["depth"], *({int(n): tuple(v) if p == "sums" else v for n, v in t[p].items()} for p in parts)) for t in found["trees"]]
    return Boosted(found["features"], found["edges"], trees, Params(**found["params"]), found["base"], found["aucs"])
