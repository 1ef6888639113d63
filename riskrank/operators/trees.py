"""Exact decision trees and forests of any depth, all trees of a grid grown together.

Trees that differ only in where they stop are one family: `max_depth` and `min_samples_split` cut the same tree short,
so a model is a view of its family's trees and a grid grows each family once.  Split points lie between any two values
that follow each other, the children's weighted Gini index decides, a node stays whole when it is pure, too small, or
all its values are equal.  Ties go to the lower feature, then the lower threshold.

Nodes above `SMALL` rows are split level by level for all trees at once: one aggregation gives the class counts by
(tree, node, feature, value), rows are placed by range in that order, and running sums over the ranges give both sides
of every split point; no group has to fit a task.  Once a node is small its rows go to one task, which grows the rest of
the subtree from lists sorted once per feature.  The result does not depend on where this happens.  A row's path through
the upper part is walked again from the few splits known so far, so rows are not rewritten from level to level.

Boosting (`boost`) grows regression trees on the residuals round by round, for all boosted models at once.

Bootstrap weights and the features a node may use are hashes of row, tree and node, so a rerun grows the same trees.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Collection, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from math import log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskrank.operators.ranking import place_rows
from riskrank.session import cut_lineage, delete_path, scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package

#: A node of at most this many rows is finished by one task.
SMALL = 100_000
#: Nodes of trees that are broadcast together for scoring, and so the most a single tree may have there.
BROADCAST_NODES = 2_000_000
NODES = ("family string, tree int, node long, depth int, n long, w double, wy double, wh double, feature int, "
         "threshold double, gain double, lower long, upper long")
#: Of a node: rows, their weight, the sums of their targets, and of what a boosted leaf divides them by.
_STATS = ("n", "w", "wy", "wh")


@dataclass(frozen=True)
class Family:
    """Trees grown alike; `max_depth` and `min_split` are the loosest that any view asks for."""

    name: str
    trees: int = 1
    bootstrap: bool = False
    max_features: int | None = None  # of the features that vary in a node; None: all
    min_leaf: int = 1
    min_weight: float = 0.0  # least share of all rows in a child
    max_depth: int | None = None
    min_split: int = 2
    seed: int = 17
    rate: float | None = None  # learning rate of a boosted family
    subsample: float = 1.0  # share of the rows that a boosted tree sees


@dataclass
class TreeView:
    """The first `trees` trees of a family as one model stops them.

    The probability is the mean over the trees, or for a boosted model (with a `rate`) the logistic function of its
    start and the rate times the sum over the trees.
    """

    nodes: DataFrame
    family: str
    trees: int
    max_depth: int | None
    min_split: int
    rate: float | None = None
    start: float = 0.0


def feature_count(setting: str | int | float | None, features: int, auto: str = "sqrt") -> int | None:
    """How many features a node looks at."""
    named = {"auto": auto, "all": None}.get(setting, setting)
    if named is None:
        return None
    if named in ("sqrt", "log2"):
        return max(1, int(sqrt(features) if named == "sqrt" else log2(features)))
    return max(1, int(named * features)) if isinstance(named, float) else int(named)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hash(*numbers: int) -> int:
    """A signed 64-bit number that stands for the given ones."""
    h = np.array([0x9E3779B97F4A7C15], np.uint64)
    for x in numbers:
        h = _mix((h ^ np.array([x & ((1 << 64) - 1)], np.uint64)) + np.uint64(0x9E3779B97F4A7C15))
    return int(h.view(np.int64)[0])


def _weights(family: Family, tree: int, rid: np.ndarray) -> np.ndarray:
    """How often each row is drawn into a tree, hashed from both: a Poisson number of mean one in a bootstrap, and once
    or not at all in a subsample."""
    if not family.bootstrap and family.subsample >= 1.0:
        return np.ones(len(rid), np.int64)
    u = _mix(rid.view(np.uint64) ^ np.uint64(_hash(family.seed, tree, 1) & ((1 << 64) - 1))) / 2.0**64
    if not family.bootstrap:
        return (u < family.subsample).astype(np.int64)
    limits, p = [], np.exp(-1.0)
    for k in range(1, 20):
        limits.append((limits[-1] if limits else 0.0) + p)
        p /= k
    return np.searchsorted(np.array(limits), u, "right")


def _rank_features(family: Family, node: int, features: int) -> np.ndarray:
    """The order in which a node considers features."""
    seed = np.uint64(node & ((1 << 64) - 1))
    return np.argsort(_mix(seed ^ (np.arange(1, features + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))))


def _children(node: int) -> tuple[int, int]:
    return _hash(node, 0), _hash(node, 1)


def _whole(family: Family, depth: int, n: float, w: float, wy: float) -> bool:
    """Whether a node may not be split, whatever its values."""
    pure = family.rate is None and (wy <= 0 or wy >= w)  # a pure node of residuals splits into equal leaves
    return n < max(2, family.min_split) or pure or family.max_depth is not None and depth >= family.max_depth


def _impurity(family: Family, w: float, wy: float) -> float:
    """Weighted Gini index; of residuals, their squared sum's part of the squared deviations."""
    return 2.0 * wy * (w - wy) / w if family.rate is None else -wy * wy / w


def _between(a: float, b: float) -> float:
    middle = a + (b - a) / 2.0
    return a if middle >= b else middle


def grow_small(family: Family, root: int, depth: int, x: np.ndarray, w: np.ndarray, y: np.ndarray,
               least_weight: float, h: np.ndarray | None = None) -> list[tuple]:
    """All nodes of the subtree below `root`, from the rows in it; `x` has a row per feature."""
    features, wh_all = len(x), np.zeros(len(w)) if h is None else w * h
    everything = np.argsort(x, axis=1, kind="stable")
    side, out = np.zeros(x.shape[1], bool), []
    stack = [(root, depth, everything)]
    wy_all = w * y
    while stack:
        node, depth, order = stack.pop()
        rows = order[0] if features else np.arange(x.shape[1])
        n, total, positive = len(rows), float(w[rows].sum()), float(wy_all[rows].sum())
        split = None
        if features and not _whole(family, depth, n, total, positive):
            values = np.take_along_axis(x, order, 1)
            step = values[:, 1:] != values[:, :-1]
            allowed = step.any(axis=1)
            if family.max_features is not None and family.max_features < features:
                ranked = _rank_features(family, node, features)
                ranked = ranked[allowed[ranked]][:family.max_features]
                allowed = np.zeros(features, bool)
                allowed[ranked] = True
            if allowed.any():
                left, left_y = np.cumsum(w[order], axis=1)[:, :-1], np.cumsum(wy_all[order], axis=1)[:, :-1]
                right, right_y = total - left, positive - left_y
                step &= allowed[:, None] & (left >= least_weight) & (right >= least_weight)
                if family.min_leaf > 1:
                    count = np.arange(1, n)
                    step &= (count >= family.min_leaf) & (n - count >= family.min_leaf)
                if step.any():
                    score = np.where(step, left_y * left_y / left + right_y * right_y / right, -np.inf)
                    feature, at = divmod(int(np.argmax(score)), n - 1)
                    split = (feature, _between(values[feature, at], values[feature, at + 1]),
                             _impurity(family, total, positive)
                             - _impurity(family, left[feature, at], left_y[feature, at])
                             - _impurity(family, right[feature, at], right_y[feature, at]))
        sums = (n, total, positive, float(wh_all[rows].sum()))
        if split is None:
            out.append((node, depth, *sums, -1, None, 0.0, None, None))
            continue
        feature, threshold, gain = split
        lower, upper = _children(node)
        out.append((node, depth, *sums, feature, float(threshold), float(gain), lower, upper))
        side[rows] = x[feature, rows] <= threshold
        goes = side[order]
        stack.append((upper, depth + 1, order[~goes].reshape(features, -1)))
        stack.append((lower, depth + 1, order[goes].reshape(features, -1)))
    return out


class _Upper:
    """The part of all trees above their small nodes: splits by tree and node, and what is open below them."""

    def __init__(self):
        self.splits: dict[int, dict[int, tuple[int, float, int, int]]] = defaultdict(dict)

    def walk(self, tree: int, x: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Where rows (columns of `x`) that start at the nodes come to rest."""
        splits = self.splits.get(tree)
        while splits:
            moved = False
            for at in np.unique(node).tolist():
                found = splits.get(at)
                if found is not None:
                    feature, threshold, lower, upper = found
                    rows = np.flatnonzero(node == at)
                    node[rows] = np.where(x[feature, rows] <= threshold, lower, upper)
                    moved = True
            if not moved:
                break
        return node


def _matrix(batch: pa.RecordBatch, features: int) -> np.ndarray:
    columns = [batch.column(f"x{i}") for i in range(features)]
    if any(c.null_count for c in columns):
        raise ValueError("NULL in a feature column")
    return np.stack([c.to_numpy(zero_copy_only=False) for c in columns]) if columns else np.zeros((0, batch.num_rows))


def _settled(trees: Sequence[tuple[Family, int]], upper: _Upper, features: int, batch: pa.RecordBatch):
    """Per tree: its number, the rows of a batch drawn into it, their weights, targets (two rows: the target and what a
    boosted leaf divides it by), and the nodes they rest in."""
    x, rid, label = _matrix(batch, features), batch.column("rid").to_numpy(), batch.column("y").to_numpy()
    for number, (family, tree) in enumerate(trees):
        w = _weights(family, tree, rid)
        rows = np.flatnonzero(w)
        at = upper.walk(number, x[:, rows], np.full(len(rows), _hash(family.seed, tree), np.int64))
        if family.rate is None:
            target = np.stack([label[rows], np.zeros(len(rows))])
        else:
            p = _logistic(batch.column(f"f{number}").to_numpy()[rows])
            target = np.stack([label[rows] - p, p * (1.0 - p)])
        yield number, x[:, rows], w[rows], target, at


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))


def _counts(train: DataFrame, trees, upper: _Upper, features: int, wanted: dict[int, set[int]]) -> DataFrame:
    """(tree, node, feature, value and their `_STATS`) of the rows in the wanted nodes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, x, w, y, at in _settled(trees, upper, features, batch):
                for node in np.unique(at).tolist():
                    if node not in wanted.get(number, ()):
                        continue
                    rows = np.flatnonzero(at == node)
                    for feature in range(features):
                        value, which = np.unique(x[feature, rows], return_inverse=True)
                        sums = [np.bincount(which, weights=s, minlength=len(value))
                                for s in (np.ones(len(rows)), w[rows], *(w[rows] * y[:, rows]))]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(value), number, np.int32)), pa.array(np.full(len(value), node)),
                             pa.array(np.full(len(value), feature, np.int32)), pa.array(value),
                             pa.array(sums[0].astype(np.int64)), *map(pa.array, sums[1:])],
                            names=["tree", "node", "feature", "value", *_STATS])

    schema = "tree int, node long, feature int, value double, n long, w double, wy double, wh double"
    return train.mapInArrow(count, schema).groupBy("tree", "node", "feature", "value").agg(
        *[F.sum(s).alias(s) for s in _STATS])


def _best_splits(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """(tree, node, feature, best): each feature's best split point of each node, null where none is allowed.

    Rows lie in ranges of (tree, node, feature, value).  Sums up to a row are those within its range and those of the
    ranges before it, of which there is one row per range and feature of a node.
    """
    group = ["tree", "node", "feature"]
    placed = place_rows(counts, [F.col(c).asc() for c in (*group, "value")])
    parts = placed.groupBy("_part", *group).agg(*[F.sum(s).alias(f"part_{s}") for s in _STATS],
                                                F.min("value").alias("first"))
    over = Window.partitionBy(*group)
    before = over.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "_part", *group, F.lead("first").over(over.orderBy("_part")).alias("after"),
        *[F.coalesce(F.sum(f"part_{s}").over(before), F.lit(0)).alias(f"before_{s}") for s in _STATS],
        *[F.sum(f"part_{s}").over(over).alias(f"all_{s}") for s in _STATS])
    inside = Window.partitionBy("_part", *group).orderBy("value")
    rows = placed.select("_part", *group, "value", F.lead("value").over(inside).alias("next"),
                         *[F.sum(s).over(inside).alias(s) for s in _STATS])
    rows = rows.join(parts, ["_part", *group]).join(F.broadcast(limits), "tree").withColumn(
        "next", F.coalesce("next", "after")).filter(F.col("next").isNotNull())
    lower = {s: F.col(s) + F.col(f"before_{s}") for s in _STATS}
    upper = {s: F.col(f"all_{s}") - lower[s] for s in _STATS}
    score = lower["wy"] * lower["wy"] / lower["w"] + upper["wy"] * upper["wy"] / upper["w"]
    fits = F.least(lower["n"], upper["n"]) >= F.col("min_leaf")
    fits &= F.least(lower["w"], upper["w"]) >= F.col("least_weight")
    found = F.struct(score.alias("score"), (-F.col("value")).alias("minus"), "next",
                     *[lower[s].alias(f"lower_{s}") for s in _STATS])
    return rows.groupBy(*group).agg(F.max(F.when(fits, found)).alias("best"))


def grow(train: DataFrame, families: Sequence[Family], features: int, small: int = SMALL) -> DataFrame:
    """The nodes (see `NODES`) of all trees of all families, written to the shared folder.

    `train` has `rid` (a long that stays with its row), `y` (0 or 1) and `x0`, `x1`, ... (double).
    """
    return cut_lineage(_grow(train, [(f, t) for f in families for t in range(f.trees)], features, small))


def _grow(train: DataFrame, trees: list[tuple[Family, int]], features: int, small: int) -> DataFrame:
    spark = train.sparkSession
    rows = train.count()
    least = [f.min_weight * rows for f, _ in trees]
    limits = spark.createDataFrame([(i, f.min_leaf, least[i]) for i, (f, _) in enumerate(trees)],
                                   "tree int, min_leaf int, least_weight double")
    upper, done = _Upper(), []
    roots = {(i, _hash(f.seed, t)): 0 for i, (f, t) in enumerate(trees)}
    open_small = dict(roots) if rows <= small else {}
    large = {} if rows <= small else roots
    while large:
        wanted = defaultdict(set)
        for tree, node in large:
            wanted[tree].add(node)
        counts = cut_lineage(_counts(train, trees, upper, features, dict(wanted)))
        sizes = {(r["tree"], r["node"]): tuple(r[s] for s in _STATS) for r in counts.filter("feature = 0").groupBy(
            "tree", "node").agg(*[F.sum(s).alias(s) for s in _STATS]).collect()}  # one row per large node
        best = defaultdict(dict)
        for r in _best_splits(counts, limits).collect():  # one row per large node and feature
            best[r["tree"], r["node"]][r["feature"]] = r["best"]
        below = {}
        for (tree, node), depth in large.items():
            family, (n, w, wy, wh) = trees[tree][0], sizes[tree, node]
            found = best[tree, node]  # the features that vary
            ranked = [f for f in _rank_features(family, node, features).tolist() if f in found]
            ranked = ranked if family.max_features is None else ranked[:family.max_features]
            usable = [] if _whole(family, depth, n, w, wy) else [f for f in ranked if found[f] is not None]
            if not usable:
                done.append((family.name, trees[tree][1], node, depth, n, w, wy, wh, -1, None, 0.0, None, None))
                continue
            feature = min(usable, key=lambda f: (-found[f]["score"], f))
            b = found[feature]
            threshold, ids = _between(-b["minus"], b["next"]), _children(node)
            sides = [(b["lower_n"], b["lower_w"], b["lower_wy"])]
            sides.append((n - sides[0][0], w - sides[0][1], wy - sides[0][2]))
            gain = _impurity(family, w, wy) - _impurity(family, *sides[0][1:]) - _impurity(family, *sides[1][1:])
            done.append((family.name, trees[tree][1], node, depth, n, w, wy, wh, feature, threshold, gain, *ids))
            upper.splits[tree][node] = (feature, threshold, *ids)
            for child, (n_child, *_) in zip(ids, sides):
                (open_small if n_child <= small else below)[tree, child] = depth + 1
        large = below

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, x, w, y, at in _settled(trees, upper, features, batch):
                for node in np.unique(at).tolist():
                    if (number, node) not in open_small:
                        continue
                    rows = np.flatnonzero(at == node)
                    blob = b"".join(part.astype("<f8").tobytes() for part in (x[:, rows], w[rows], y[:, rows]))
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([node]), pa.array([blob])],
                                                     names=["number", "top", "rows"])

    def finish(key, table):
        number, node = key[0].as_py(), key[1].as_py()
        family, tree = trees[number]
        parts = [np.frombuffer(b, "<f8").reshape(features + 3, -1) for b in table.column("rows").to_pylist()]
        data = np.concatenate(parts, axis=1)
        data = data[:, np.lexsort(data[::-1])]  # the same order, however the rows arrived
        found = grow_small(family, node, open_small[number, node], data[:features], data[-3], data[-2], least[number],
                           data[-1])
        return pa.Table.from_arrays(
            [pa.array([family.name] * len(found), pa.string()), pa.array([tree] * len(found), pa.int32()),
             *(pa.array([r[i] for r in found], t) for i, t in enumerate(kinds))], names=names)

    names = [c.split()[0] for c in NODES.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int32(), pa.float64(),
             pa.float64(), pa.int64(), pa.int64()]
    grown = train.mapInArrow(deal, "number int, top long, rows binary").groupBy("number", "top").applyInArrow(finish, NODES)
    return grown.unionByName(spark.createDataFrame(done, NODES))


def boost(train: DataFrame, families: Sequence[Family], features: int, small: int = SMALL) -> tuple[DataFrame, float]:
    """Boosted trees of all families, round by round, and the log-odds they start from.

    A round's trees are grown on the residuals like any others, for all families that still go on.  A leaf's value is a
    Newton step, the residuals' sum by that of p * (1 - p).  The rows' scores so far are one column per family, written
    anew each round; the round's trees, of bounded depth or one task's rows, are broadcast for that.
    """
    spark = train.sparkSession
    row = train.agg(F.avg("y").alias("share")).first()
    start = float(np.log(row["share"] / (1.0 - row["share"])))
    path, scored, before = scratch_path(spark, "boosted"), None, None
    scored = train.select("*", *[F.lit(start).alias(f"f{i}") for i in range(len(families))])
    for number in range(max(f.trees for f in families)):
        going = [f for f in families if f.trees > number]
        columns = [i for i, f in enumerate(families) if f.trees > number]
        current = scored.select("rid", "y", *[f"x{i}" for i in range(features)],
                                *[F.col(f"f{i}").alias(f"f{j}") for j, i in enumerate(columns)])
        _grow(current, [(f, number) for f in going], features, small).write.mode("append").parquet(f"{path}/round={number}")
        if number + 1 == max(f.trees for f in families):
            break
        found = spark.read.schema(NODES).parquet(f"{path}/round={number}").collect()  # a few trees' nodes
        if len(found) > BROADCAST_NODES:
            raise ValueError(f"{len(found)} nodes in a round, at most {BROADCAST_NODES} are broadcast")
        packed = spark.sparkContext.broadcast(_pack(found, [f.name for f in going]))

        def add(batches: Iterator[pa.RecordBatch], packed=packed, going=going, columns=columns, number=number):
            for batch in batches:
                x, out = _matrix(batch, features), {n: batch.column(n) for n in batch.schema.names}
                for i, family in zip(columns, going):
                    sums = np.zeros((1, batch.num_rows))
                    _add_values(packed.value, sums, x, [(family.name, number + 1, family.max_depth, family.min_split)])
                    out[f"f{i}"] = pa.array(batch.column(f"f{i}").to_numpy() + family.rate * sums[0])
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

        place = scratch_path(spark, "scores")
        scored.mapInArrow(add, scored.schema).write.parquet(place)
        scored = spark.read.schema(scored.schema).parquet(place)
        if before is not None:
            delete_path(spark, before)
        before = place
    return spark.read.schema(NODES).parquet(*[f"{path}/round={n}" for n in range(max(f.trees for f in families))]), start


def _value(node, boosted: bool) -> float:
    """What a leaf predicts: its share of positives, or in a boosted tree the residuals' Newton step."""
    if not boosted:
        return node["wy"] / node["w"]
    return node["wy"] / node["wh"] if node["wh"] > 1e-150 else 0.0


def _pack(rows: Sequence, boosted: Collection[str] = ()) -> dict[tuple[str, int], tuple[np.ndarray, ...]]:
    """Trees as arrays: feature, threshold, places of both children, rows and value of every node."""
    by_tree, out = defaultdict(list), {}
    for r in rows:
        by_tree[r["family"], r["tree"]].append(r)
    for key in sorted(by_tree):
        found = sorted(by_tree[key], key=lambda r: (r["depth"], r["node"]))
        place = {r["node"]: i for i, r in enumerate(found)}
        out[key] = (
            np.array([r["feature"] for r in found], np.int32),
            np.array([0.0 if r["threshold"] is None else r["threshold"] for r in found]),
            np.array([place.get(r["lower"], 0) for r in found], np.int32),
            np.array([place.get(r["upper"], 0) for r in found], np.int32),
            np.array([r["n"] for r in found], np.int64), np.array([_value(r, r["family"] in boosted) for r in found]))
    return out


def _add_values(trees: dict, sums: np.ndarray, x: np.ndarray, views: Sequence[tuple]) -> None:
    """Add to each view's sums (a row per view) the values where its trees stop the rows (columns of `x`)."""
    for (family, tree), (feature, threshold, lower, upper, n, value) in trees.items():
        mine = [i for i, v in enumerate(views) if v[0] == family and tree < v[1]]
        live = {i: np.ones(x.shape[1], bool) for i in mine}
        at, depth, rows = np.zeros(x.shape[1], np.int32), 0, np.arange(x.shape[1] if mine else 0)
        while len(rows):
            here = at[rows]
            leaf = feature[here] < 0
            for i in mine:
                _, _, max_depth, min_split = views[i]
                stop = leaf | (n[here] < min_split) | (max_depth is not None and depth >= max_depth)
                hit = rows[stop & live[i][rows]]
                sums[i, hit] += value[at[hit]]
                live[i][hit] = False
            rows = rows[~leaf & np.any([live[i][rows] for i in mine], axis=0)]
            here = at[rows]
            at[rows] = np.where(x[feature[here], rows] <= threshold[here], lower[here], upper[here])
            depth += 1


def _finish(view: TreeView) -> tuple[float, float | None]:
    """What a view's sum is multiplied by, and what is added before the logistic function, if there is one."""
    return (1.0 / view.trees, None) if view.rate is None else (view.rate, view.start)


def score_views(views: dict[str, TreeView], features: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(keys, model_id, probability): one pass over the features for as many trees as one broadcast holds."""
    spark, passes = features.sparkSession, []
    tables = {id(v.nodes): v.nodes for v in views.values()}
    wide = features.select(*keys, *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide.select(*keys).schema.fields)
    for table, nodes in tables.items():
        mine = {m: v for m, v in views.items() if id(v.nodes) == table}
        names, some_views = list(mine), list(mine.values())
        boosted = [v.family for v in some_views if v.rate is not None]
        plan = [(v.family, v.trees, v.max_depth, v.min_split) for v in mine.values()]
        most = {}
        for family, trees, *_ in plan:
            most[family] = max(trees, most.get(family, 0))
        sizes = nodes.filter(F.col("family").isin(list(most))).groupBy("family", "tree").count().orderBy("family", "tree")
        chunks, room = [], 0
        for r in sizes.collect():  # one row per tree
            if r["tree"] >= most[r["family"]]:
                continue
            if r["count"] > BROADCAST_NODES:
                raise ValueError(f"a tree of {r['count']} nodes, at most {BROADCAST_NODES} are broadcast")
            if r["count"] > room:
                chunks.append(defaultdict(list))
                room = BROADCAST_NODES
            chunks[-1][r["family"]].append(r["tree"])
            room -= r["count"]
        for number, chunk in enumerate(chunks):
            some = reduce(lambda a, b: a | b, [(F.col("family") == f) & F.col("tree").between(t[0], t[-1])
                                               for f, t in chunk.items()])
            packed = spark.sparkContext.broadcast(_pack(nodes.filter(some).collect(), boosted))
            held = [i for i, p in enumerate(plan) if p[0] in chunk and chunk[p[0]][0] < p[1]]

            def score(batches: Iterator[pa.RecordBatch], packed=packed, held=held, number=number, names=names, plan=plan,
                      last=[_finish(v) if len(chunks) == 1 else (1.0, None) for v in some_views]):
                for batch in batches:
                    x = _matrix(batch, len(columns))
                    sums = np.zeros((len(held), batch.num_rows))
                    _add_values(packed.value, sums, x, [plan[i] for i in held])
                    for i, found in zip(held, sums):
                        factor, first = last[i]
                        found = found * factor if first is None else _logistic(first + found * factor)
                        yield pa.RecordBatch.from_arrays(
                            [*(batch.column(j) for j in range(len(keys))), pa.array([names[i]] * batch.num_rows, pa.string()),
                             pa.array(found), pa.array(np.full(batch.num_rows, number, np.int32))],
                            names=[*keys, "model_id", "probability", "_pass"])

            passes.append((len(chunks), wide.mapInArrow(score, f"{schema}, model_id string, probability double, _pass int")))
    whole = [df.drop("_pass") for n, df in passes if n == 1]
    split = [df for n, df in passes if n > 1]
    if split:  # a forest over several passes: its parts are added in order
        parts = reduce(DataFrame.unionByName, split).groupBy(*keys, "model_id").agg(
            F.sort_array(F.collect_list(F.struct("_pass", "probability"))).alias("parts"))
        added = parts.withColumn("sum", F.aggregate("parts", F.lit(0.0), lambda s, p: s + p["probability"]))
        factor, first = (F.create_map(*[F.lit(x) for m, v in views.items() for x in (m, _finish(v)[i])])[F.col("model_id")]
                         for i in (0, 1))
        done = F.when(first.isNull(), F.col("sum") * factor).otherwise(1 / (1 + F.exp(-(first + F.col("sum") * factor))))
        whole.append(added.select(*keys, "model_id", done.alias("probability")))
    return reduce(DataFrame.unionByName, whole)


def view_importances(views: dict[str, TreeView], features: int) -> dict[str, list[float]]:
    """Impurity importances of each model: shares within a tree, then the mean over its trees that split at all; of a
    boosted model, shares of all its trees together."""
    out = {m: [0.0] * features for m in views}
    for table in {id(v.nodes): v.nodes for v in views.values()}.values():
        mine = {m: v for m, v in views.items() if v.nodes is table}
        spark = table.sparkSession
        plan = spark.createDataFrame(
            [(m, v.family, v.trees, v.max_depth, v.min_split, v.rate is not None) for m, v in mine.items()],
            "model_id string, family string, trees int, max_depth int, min_split long, boosted boolean")
        inside = table.filter("feature >= 0").join(F.broadcast(plan), "family").filter(
            (F.col("tree") < F.col("trees")) & (F.col("n") >= F.col("min_split"))
            & (F.col("max_depth").isNull() | (F.col("depth") < F.col("max_depth"))))
        inside = inside.withColumn("tree", F.when(F.col("boosted"), 0).otherwise(F.col("tree")))
        by_tree = inside.groupBy("model_id", "tree", "feature").agg(F.sum("gain").alias("gain"))
        share = F.try_divide("gain", F.sum("gain").over(Window.partitionBy("model_id", "tree")))
        shares = by_tree.select("model_id", "tree", "feature", F.coalesce(share, F.lit(0.0)).alias("share"))
        counts = shares.groupBy("model_id").agg(F.countDistinct("tree").alias("split"))
        for r in shares.groupBy("model_id", "feature").agg(F.sum("share").alias("s")).join(counts, "model_id").collect():
            out[r["model_id"]][r["feature"]] = r["s"] / r["split"]
    return out


def save_view(view: TreeView, path: str, nodes_path: str) -> None:
    """The view's settings under `path`; its trees lie under `nodes_path`."""
    spark = view.nodes.sparkSession
    row = [(nodes_path.rsplit("/", 1)[-1], view.family, view.trees, view.max_depth, view.min_split, view.rate, view.start)]
    schema = "nodes string, family string, trees int, max_depth int, min_split long, rate double, start double"
    spark.createDataFrame(row, schema).coalesce(
        1).write.mode("overwrite").parquet(f"{path}/view")


def load_view(spark: SparkSession, path: str) -> TreeView | None:
    """A saved view, or nothing where none was saved."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/view")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    r = spark.read.parquet(f"{path}/view").first()
    nodes = spark.read.parquet(f"{path.rsplit('/', 1)[0]}/{r['nodes']}")
    return TreeView(nodes, r["family"], r["trees"], r["max_depth"], r["min_split"], r["rate"], r["start"])
