"""Exact Shapley values of boosted trees, by the paths to their leaves.

The value of a set of features at a leaf is the leaf's value, times one for each feature of the set whose cell the row falls
in (else nothing), times the share of training rows that went its way for each feature outside. Summed over the leaves this
is the tree's mean when only the set is known. A leaf knows at most as many features as the tree is deep, so
the Shapley values of a leaf depend on which of its few cells the row falls in: a small table per leaf, made once a task.
The contributions of all features and the base add up to the model's log-odds.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import factorial, inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroute.operators.boosting import Boosted, Tree
from tallyroute.operators.schema import col


def paths(tree: Tree, edges: Sequence[Sequence[float]]) -> list[tuple[float, dict[int, tuple[float, float, bool, float]]]]:
    """Per leaf its value, and per feature on the way to it: (above, up to, whether missing values come here, share of rows)."""
    found = []

    def down(node: int, cells: dict) -> None:
        if node not in tree.feature:
            found.append((tree.value[node], cells))
            return
        f, cover = tree.feature[node], tree.sums[node][1]
        ends, place = edges[f], tree.bin[node]
        bound = ends[place] if place < len(ends) else inf
        above, upto, missing, share = cells.get(f, (-inf, inf, True, 1.0))
        for child, left in ((2 * node, True), (2 * node + 1, False)):
            part = tree.sums[child][1] / cover
            own = (above, min(upto, bound)) if left else (max(above, bound), upto)
            down(child, {**cells, f: (*own, missing and tree.missing_left[node] == left, share * part)})

    down(1, {})
    return found


def expected(model: Boosted) -> float:
    """The base of all contributions: the mean log-odds of the training rows as the trees' covers tell it."""
    return model.base + sum(value * float(np.prod([c[3] for c in cells.values()])) for tree in model.trees for value, cells in paths(tree, model.edges))


def leaf_table(value: float, shares: np.ndarray) -> np.ndarray:
    """Shapley values of a leaf's features, by which of their cells hold the row (bit j of the row's number for feature j)."""
    n = len(shares)
    inside = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    made = np.empty((1 << n, n))
    for j in range(n):
        # Coefficients of the product of (share + inside * t) over the other features: by the number of known ones.
        sums = np.zeros((1 << n, n))
        sums[:, 0] = 1.0
        for k in range(n):
            if k != j:
                sums[:, 1:] = sums[:, 1:] * shares[k] + sums[:, :-1] * inside[:, [k]]
                sums[:, 0] *= shares[k]
        weights = np.array([factorial(s) * factorial(n - 1 - s) / factorial(n) for s in range(n)])
        made[:, j] = value * (inside[:, j] - shares[j]) * (sums @ weights)
    return made


def contributions(df: DataFrame, model: Boosted, keep: Sequence[str] = ()) -> DataFrame:
    """Kept columns, and one column per feature with its contribution to the log-odds; null and NaN are missing values."""
    names, edges, trees = model.features, model.edges, model.trees

    def explain(batches):
        leaves = []
        for tree in trees:
            for value, cells in paths(tree, edges):
                if cells:
                    leaves.append((list(cells), list(cells.values()), leaf_table(value, np.array([c[3] for c in cells.values()]))))
        for batch in batches:
            columns = [np.asarray(c.to_numpy(zero_copy_only=False), float) for c in batch.columns[-len(names) :]]
            total = np.zeros((batch.num_rows, len(names)))
            for features, cells, table in leaves:
                place = np.zeros(batch.num_rows, np.int64)
                for j, (f, (above, upto, missing, _)) in enumerate(zip(features, cells, strict=True)):
                    x = columns[f]
                    here = ((x > above) | (above == -inf)) & (x <= upto)
                    place |= np.where(np.isnan(x), missing, here).astype(np.int64) << j
                total[:, features] += table[place]
            made = [pa.array(total[:, i]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: -len(names)], *made], names=[*[f"k{i}" for i in range(len(keep))], *[f"c{i}" for i in range(len(names))]])

    inputs = df.select(*[col(k).alias(f"k{i}") for i, k in enumerate(keep)], *[col(f).cast("double").alias(f"c{i}") for i, f in enumerate(names)])
    kinds = [f"k{i} {inputs.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))]
    wide = inputs.mapInArrow(explain, ", ".join([*kinds, *[f"c{i} double" for i in range(len(names))]]))
    return wide.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keep)], *[F.col(f"c{i}").alias(f) for i, f in enumerate(names)])
