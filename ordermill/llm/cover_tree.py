"""Near-duplicate embeddings by dual traversal of cover trees: every pair within a distance, exactly.

Vectors are scaled to length one, so a cosine of at least c is a distance of
at most sqrt(2 - 2c). Of equal vectors one stands for all. The vectors of a
label are dealt to chunks of bounded size; each chunk becomes a cover tree:
nested levels whose radii halve, nodes of a level further apart than its
radius, each node with the radius that covers its descendants. Two trees are
walked together: a pair of nodes further apart than the distance and both
covering radii is dropped with all below; a pair whose farthest descendants
are still near links all of them at once; others are opened on the side with
the larger radius. Pairs left over are compared by the cosine itself.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.components import components
from ordermill.operators.skew import join_one
from ordermill.sources.scratch import materialize

COSINE = 0.93
CHUNK = 2048  # vectors of a tree; bounds the memory of a task, not what is compared
BLOCK = 1024  # nodes of one side compared at once
SLACK = 1e-6  # pairs this close to a bound are compared by the cosine itself
DIRECT = 4096  # two nodes with at most so many pairs below them are compared without going down further
LEAF = 2.0**-6  # radius below which a node's vectors are listed and no longer divided


class CoverTree:
    """Nodes of a cover tree as arrays: center, covering radius, range in ``order``, children.

    ``units``: vectors of length one. A node's children are told apart at
    half its level's radius: each is further than that from the ones before
    it, and takes what lies within. The node's own center is its first child.
    """

    def __init__(self, units: np.ndarray) -> None:
        self.units = units
        gaps = distances(units, units)
        nodes: list[tuple[int, float, int, int]] = []
        self.children: list[np.ndarray] = []
        order: list[int] = []

        def build(center: int, members: np.ndarray, radius: float) -> int:
            node = len(nodes)
            covered = float(gaps[center, members].max())
            nodes.append((center, covered, len(order), 0))
            self.children.append(np.zeros(0, np.int64))
            while covered <= radius / 2 and radius > LEAF:
                radius /= 2
            if len(members) == 1 or radius <= LEAF:
                order.extend(members.tolist())
            else:
                own, pivot, rest = [], center, members
                while len(rest):
                    near = gaps[pivot, rest] <= radius / 2
                    own.append(build(pivot, rest[near], radius / 2))
                    rest = rest[~near]
                    pivot = int(rest[0]) if len(rest) else -1
                self.children[node] = np.array(own, np.int64)
            nodes[node] = (center, covered, nodes[node][2], len(order))
            return node

        if len(units):
            build(0, np.arange(len(units)), 2.0)
        table = np.array(nodes, float).reshape(-1, 4)
        self.centers, self.radii = table[:, 0].astype(np.int64), table[:, 1]
        self.starts, self.ends = table[:, 2].astype(np.int64), table[:, 3].astype(np.int64)
        self.order = np.array(order, np.int64)

    def below(self, node: int) -> np.ndarray:
        """Numbers of the vectors below a node."""
        return self.order[self.starts[node] : self.ends[node]]


def units_of(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the largest component first, so nothing overflows."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of vectors of length one; right to about SLACK."""
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


class Links:
    """Partners (rows, copies counted) of the vectors of two trees, and pairs that join all that link."""

    def __init__(self, a: CoverTree, counts_a: np.ndarray, b: CoverTree, counts_b: np.ndarray, same: bool) -> None:
        self.counts_a, self.counts_b, self.same = counts_a, counts_b, same
        self.left = np.zeros(len(a.units), np.int64)
        self.right = self.left if same else np.zeros(len(b.units), np.int64)
        self.shift = 0 if same else len(a.units)
        self.pairs: list[np.ndarray] = []

    def all_of(self, own: np.ndarray, other: np.ndarray) -> None:
        """Every one of ``own`` links with every one of ``other``; no vector is in both."""
        self.left[own] += self.counts_b[other].sum()
        self.right[other] += self.counts_a[own].sum()
        self._join(np.full(len(other), own[0]), other)
        self._join(own, np.full(len(own), other[0]))

    def within(self, own: np.ndarray) -> None:
        """Every two of ``own`` link."""
        self.left[own] += self.counts_a[own].sum() - self.counts_a[own]
        self._join(np.full(len(own) - 1, own[0]), own[1:])

    def some(self, i: np.ndarray, j: np.ndarray) -> None:
        """Single pairs, each once."""
        np.add.at(self.left, i, self.counts_b[j])
        np.add.at(self.right, j, self.counts_a[i])
        self._join(i, j)

    def _join(self, i: np.ndarray, j: np.ndarray) -> None:
        self.pairs.append(np.stack([i, j + self.shift], 1))
        if sum(map(len, self.pairs)) > 1 << 20:
            self.pairs = [self.forest()]

    def forest(self) -> np.ndarray:
        """Pairs (vector, least number reachable) of all that are joined."""
        least = np.arange(len(self.left) + (0 if self.same else len(self.right)))
        pairs = np.concatenate(self.pairs) if self.pairs else np.zeros((0, 2), np.int64)
        while True:
            low = np.minimum(least[pairs[:, 0]], least[pairs[:, 1]])
            after = least.copy()
            np.minimum.at(after, pairs[:, 0], low)
            np.minimum.at(after, pairs[:, 1], low)
            after = after[after]
            if (after == least).all():
                break
            least = after
        moved = np.flatnonzero(least != np.arange(len(least)))
        return np.stack([moved, least[moved]], 1)


def traverse(
    a: CoverTree, counts_a: np.ndarray, b: CoverTree, counts_b: np.ndarray, cosine: float, same: bool = False
) -> Links:
    """All pairs of at least the cosine between two trees, or (``same``) within one, each pair once."""
    bound = np.sqrt(max(0.0, 2.0 - 2.0 * cosine))
    links = Links(a, counts_a, b, counts_b, same)
    if not len(a.units) or not len(b.units):
        return links

    def compare(own: np.ndarray, other: np.ndarray, once: bool = False) -> None:
        for at in range(0, len(own), BLOCK):
            near = a.units[own[at : at + BLOCK]] @ b.units[other].T >= cosine
            if once:
                near &= np.arange(at, at + len(near))[:, None] < np.arange(len(other))[None, :]
            i, j = np.nonzero(near)
            links.some(own[at + i], other[j])

    sizes_a, sizes_b = a.ends - a.starts, b.ends - b.starts
    root = np.zeros(1, np.int64)
    work = [(root, root, same)]  # nodes of either side, all against all; True: a set against itself
    while work:
        left, right, itself = work.pop()
        single_i, single_j = [], []
        for at in range(0, len(left), BLOCK):
            rows = left[at : at + BLOCK]
            gaps = distances(a.units[a.centers[rows]], b.units[b.centers[right]])
            reach = a.radii[rows][:, None] + b.radii[right][None, :]
            alive = gaps <= bound + reach + SLACK
            if itself:
                alive &= np.arange(at, at + len(rows))[:, None] <= np.arange(len(right))[None, :]
            i, j = np.nonzero(alive)
            sure = gaps[i, j] + reach[i, j] < bound - SLACK
            n, m = rows[i], right[j]
            one = (a.ends[n] - a.starts[n] == 1) & (b.ends[m] - b.starts[m] == 1)
            own = same & (n == m)
            single = one & ~own
            single_i.append(a.centers[n[single]])
            single_j.append(b.centers[m[single]])
            rest = np.flatnonzero(~one)
            for x, y, all_near in zip(n[rest].tolist(), m[rest].tolist(), sure[rest].tolist()):
                if same and x == y:
                    if 2 * a.radii[x] < bound - SLACK:
                        links.within(a.below(x))
                    elif sizes_a[x] ** 2 <= DIRECT:
                        compare(a.below(x), a.below(x), once=True)
                    elif len(a.children[x]):
                        work.append((a.children[x], a.children[x], True))
                    else:
                        compare(a.below(x), a.below(x), once=True)
                elif all_near:
                    links.all_of(a.below(x), b.below(y))
                elif sizes_a[x] * sizes_b[y] <= DIRECT:
                    compare(a.below(x), b.below(y))
                elif len(a.children[x]) and (a.radii[x] >= b.radii[y] or not len(b.children[y])):
                    work.append((a.children[x], np.array([y]), False))
                elif len(b.children[y]):
                    work.append((np.array([x]), b.children[y], False))
                else:
                    compare(a.below(x), b.below(y))
        i, j = np.concatenate(single_i), np.concatenate(single_j)
        for at in range(0, len(i), 1 << 18):
            x, y = i[at : at + (1 << 18)], j[at : at + (1 << 18)]
            near = np.einsum("ij,ij->i", a.units[x], b.units[y]) >= cosine
            links.some(x[near], y[near])
    return links


TREE_SCHEMA = "label string, dims int, chunk int, chunks int, ids binary, counts binary, vectors binary, tree binary"
FOUND_SCHEMA = "a long, b long, links long"


def _grow(group: pd.DataFrame) -> pd.DataFrame:
    """One row with a chunk's cover tree."""
    group = group.sort_values("vec_id")
    vectors = np.stack(group["embedding"].to_list()).astype(np.float64)
    tree = CoverTree(units_of(vectors))
    row = {
        "label": group["label"].iloc[0], "dims": group["dims"].iloc[0],
        "chunk": group["chunk"].iloc[0], "chunks": group["chunks"].iloc[0],
        "ids": group["vec_id"].to_numpy(np.int64).tobytes(),
        "counts": group["copies"].to_numpy(np.int64).tobytes(),
        "vectors": tree.units.tobytes(),
        "tree": pickle.dumps((tree.centers, tree.radii, tree.starts, tree.ends, tree.order, tree.children)),
    }
    return pd.DataFrame([row])


def _thaw(row: pd.Series) -> tuple[CoverTree, np.ndarray, np.ndarray]:
    tree = CoverTree.__new__(CoverTree)
    tree.units = np.frombuffer(row["vectors"]).reshape(-1, row["dims"])
    tree.centers, tree.radii, tree.starts, tree.ends, tree.order, tree.children = pickle.loads(row["tree"])
    return tree, np.frombuffer(row["ids"], np.int64), np.frombuffer(row["counts"], np.int64)


def _walk(cosine: float):
    def work(group: pd.DataFrame) -> pd.DataFrame:
        rows = [row for _, row in group.sort_values("chunk").iterrows()]
        a, ids_a, counts_a = _thaw(rows[0])
        same = len(rows) == 1
        b, ids_b, counts_b = (a, ids_a, counts_a) if same else _thaw(rows[1])
        links = traverse(a, counts_a, b, counts_b, cosine, same)
        ids = ids_a if same else np.concatenate([ids_a, ids_b])
        partners = links.left if same else np.concatenate([links.left, links.right])
        linked = np.flatnonzero(partners)
        joined = ids[links.forest()]
        return pd.DataFrame(
            {
                "a": np.concatenate([ids[linked], joined[:, 0]]),
                "b": pd.array(np.concatenate([np.zeros(len(linked), np.int64), joined[:, 1]]), "Int64"),
                "links": np.concatenate([partners[linked], np.zeros(len(joined), np.int64)]),
            }
        ).assign(b=lambda t: t["b"].mask(t["links"] > 0))

    return work


def _usable(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, chunk: int = CHUNK) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row.

    Rows link if their labels and dimensions are equal, their labels not
    null, and the cosine is at least ``cosine``. ``n_links``: other rows
    linked directly; ``component_id``: the least ``vec_id`` reachable, itself
    included; ``kept``: it is its own component's. Vectors that are null,
    zero, or hold null or non-finite components link with nothing, nor do
    rows with a null id or label. Rows may repeat and an id may have several
    vectors; each row counts and has its own links. Extra columns are not read.

    Copies of a vector are one point with a count. Chunks of a label are
    compared in pairs, each pair in a task of its own with two trees of
    at most about ``chunk`` points; nothing larger is ever gathered.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    usable = _usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    point = F.sha2(F.concat_ws("|", "label", F.col("embedding").cast("string")).cast("binary"), 256)
    keyed = materialize(rows.withColumn("point", F.when(usable, point)), "tree-rows")
    points = materialize(
        keyed.where("point is not null")
        .groupBy("point")
        .agg(
            F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"),
            F.first("label").alias("label"), F.first("embedding").alias("embedding"),
        )
        .withColumn("dims", F.size("embedding"))
        .withColumn("node", F.monotonically_increasing_id()),  # an id may stand for several points
        "tree-points",
    )
    kind = F.concat_ws("|", "dims", "label")
    sizes = points.groupBy(kind.alias("kind")).agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
    dealt = join_one(points.withColumn("kind", kind), sizes, "kind", "vec_id").withColumn(
        "chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int")
    )
    grown = dealt.select("label", "dims", "chunk", "chunks", F.col("node").alias("vec_id"), "copies", "embedding")
    trees = materialize(grown.groupBy("label", "dims", "chunk").applyInPandas(_grow, TREE_SCHEMA), "tree-chunks")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    paired = trees.select("*", other.alias("other")).select(
        "*", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j")
    )
    found = materialize(paired.groupBy("label", "dims", "i", "j").applyInPandas(_walk(cosine), FOUND_SCHEMA), "tree-links")
    partners = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    joined = components(found.where("b is not null").select("a", "b"), "tree-components")
    named = points.select("node", "vec_id").join(joined, "node")
    least = named.groupBy("component").agg(F.min("vec_id").alias("least_id"))
    of_point = (
        points.join(partners, "node", "left")
        .join(join_one(joined, least, "component", "node", "inner").select("node", "least_id"), "node", "left")
        .select(
            "point",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("least_id", "vec_id").alias("component_id"),
        )
    )
    linked = join_one(keyed.select("vec_id", "point"), of_point, "point", "vec_id")
    component = F.coalesce("component_id", "vec_id")
    return linked.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
