"""Isolation trees with NumPy: growing one from its sample, level by level, and walking all on a batch of rows."""

import hashlib
import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from logquarry.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES

# tasks receive these helpers with the function they run, so executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Sample per tree, and the Euler-Mascheroni constant of the path-length formula.
SAMPLE_SIZE = 256
EULER_GAMMA = 0.5772156649015329

MICRO = 1_000_000  # path lengths are whole millionths, so their sums don't depend on an order


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary tree of ``n`` points: c(n) of the paper."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def uniform(*values: Column) -> Column:
    """Hash to [0, 1): thirteen hexadecimal digits of the MD5 of the values joined by colons."""
    digits = F.substring(F.md5(F.concat_ws(":", *[v.cast("string") for v in values])), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(1 << 52))


def height_of(size: int) -> int:
    return max(1, math.ceil(math.log2(max(size, 2))))


FEATURES = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
_NUMBERS = len(NUMERIC_FEATURES)
NODE_SCHEMA = "tree int, node int, depth int, rows bigint, feature string, threshold double, category string, path bigint"


def draw(*parts) -> float:
    """``uniform`` for plain values."""
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / float(1 << 52)


def _split(numbers: np.ndarray, codes: np.ndarray, labels: list[np.ndarray], key: tuple, seed: int):
    """(feature index, threshold, category or None, goes-right mask) of a node's rows, or None where all are equal.

    A node may be split at a number that varies in it or by a category value that only some of its rows
    hold. Each such choice draws a number by hash of tree, node and choice, and the smallest wins, which
    chooses evenly whatever the order of rows.
    """
    low, high = numbers.min(axis=0), numbers.max(axis=0)
    choices = [(draw(*key, NUMERIC_FEATURES[i], seed), int(i), None) for i in np.flatnonzero(high > low)]
    for j, name in enumerate(CATEGORICAL_FEATURES):
        present = np.unique(codes[:, j])
        if len(present) > 1:
            choices += [(draw(*key, name, labels[j][code], seed), _NUMBERS + j, int(code)) for code in present]
    if not choices:
        return None
    _, index, code = min(choices)
    if code is not None:
        return index, None, str(labels[index - _NUMBERS][code]), codes[:, index - _NUMBERS] == code
    cut = low[index] + (high[index] - low[index]) * draw(*key, NUMERIC_FEATURES[index], "at", seed)
    cut = cut if cut < high[index] else low[index]  # the product can be rounded up to the end
    return index, float(cut), None, numbers[:, index] > cut


def grow_tree(sample: pd.DataFrame, seed: int) -> pd.DataFrame:
    """The nodes of one tree from its sample, of any order: tree, node, depth, rows, feature, threshold, category, path.

    The root is node 1, the children of node k are 2k, the left one, and 2k + 1. A row goes right when its
    number exceeds the threshold or its category is the node's. A leaf has no feature but a path length in
    millionths.
    """
    tree = int(sample["tree"].iloc[0])
    numbers = sample[NUMERIC_FEATURES].to_numpy(dtype=float)
    labels, codes = [], np.empty((len(sample), len(CATEGORICAL_FEATURES)), dtype=np.int32)
    for j, name in enumerate(CATEGORICAL_FEATURES):
        values, codes[:, j] = np.unique(sample[name].to_numpy(dtype=str), return_inverse=True)
        labels.append(values)
    nodes, level = [], [(1, np.arange(len(sample)))]
    for depth in range(height_of(len(sample)) + 1):
        below = []
        for node, rows in level:
            split = _split(numbers[rows], codes[rows], labels, (tree, node), seed) if depth < height_of(len(sample)) else None
            if split is None:
                path = round((depth + average_path(len(rows))) * MICRO)
                nodes.append((tree, node, depth, len(rows), None, None, None, path))
                continue
            index, cut, category, right = split
            nodes.append((tree, node, depth, len(rows), FEATURES[index], cut, category, None))
            below += [(2 * node, rows[~right]), (2 * node + 1, rows[right])]
        level = below
    columns = [c.split(" ")[0] for c in NODE_SCHEMA.split(", ")]
    return pd.DataFrame(nodes, columns=columns).astype({"path": "Int64"})


def combine(nodes: list, size: int) -> dict:
    """Grown nodes as plain arrays indexed [tree][node], path lengths as [tree][slot].

    A numeric split sends a row right when its value lies in (low, high]; a category split does the
    same on the position of its value in the vocabulary. A leaf sends every row left, down to the bottom
    level, where the path lengths stand.
    """
    height = height_of(size)
    bottom, trees = 1 << height, 1 + max((n["tree"] for n in nodes), default=-1)
    vocabulary = sorted({n["category"] for n in nodes if n["category"] is not None})
    positions = {value: float(i) for i, value in enumerate(vocabulary)}
    feature = np.zeros((trees, bottom - 1), dtype=np.intp)
    low, high = np.full((trees, bottom - 1), np.inf), np.full((trees, bottom - 1), np.inf)
    path = np.zeros((trees, bottom), dtype=np.int64)
    for n in nodes:
        tree, node = n["tree"], n["node"]
        if n["feature"] is None:
            path[tree, (node << (height - n["depth"])) - bottom] = n["path"]
            continue
        feature[tree, node - 1] = FEATURES.index(n["feature"])
        if n["category"] is None:
            low[tree, node - 1] = n["threshold"]
        else:
            at = positions[n["category"]]
            low[tree, node - 1], high[tree, node - 1] = at - 0.5, at + 0.5
    return {"feature": feature, "low": low, "high": high, "path": path, "positions": positions, "normal_depth": average_path(size)}


def score_rows(forest: dict, numbers: np.ndarray, categories: list[pd.Series]) -> np.ndarray:
    """Negated anomaly score of each row, lower = more anomalous."""
    rows, width = len(numbers), len(NUMERIC_FEATURES) + len(CATEGORICAL_FEATURES)
    values = np.empty((rows, width))
    values[:, : len(NUMERIC_FEATURES)] = numbers
    for j, column in enumerate(categories, start=len(NUMERIC_FEATURES)):
        codes, uniques = pd.factorize(column)
        values[:, j] = np.array([forest["positions"].get(u, -1.0) for u in uniques] or [-1.0])[codes]
    flat, offset = values.ravel(), np.arange(rows) * width
    slots = forest["path"].shape[1]
    total = np.zeros(rows, dtype=np.int64)
    for feature, low, high, path in zip(forest["feature"], forest["low"], forest["high"], forest["path"]):
        node = np.zeros(rows, dtype=np.intp)
        for _ in range(slots.bit_length() - 1):
            value = flat[offset + feature[node]]
            node = 2 * node + 1 + ((value > low[node]) & (value <= high[node]))
        total += path[node - (slots - 1)]
    return -np.exp2(-total / (MICRO * len(forest["path"]) * forest["normal_depth"]))
