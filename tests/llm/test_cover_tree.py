from __future__ import annotations

import numpy as np
import pytest

from ordermill.llm import cover_tree


def blobs(seed: int, count: int, dims: int) -> np.ndarray:
    random = np.random.default_rng(seed)
    centers = random.normal(size=(12, dims))
    return centers[random.integers(0, 12, count)] + random.normal(size=(count, dims)) * random.choice([0.001, 0.1, 0.4], (count, 1))


@pytest.mark.parametrize("dims", [2, 3, 8, 64])
@pytest.mark.parametrize("cosine", [0.5, 0.93, 0.999])
def test_traversals_equal_brute_force(dims, cosine):
    a, b = cover_tree.units_of(blobs(dims, 250, dims)), cover_tree.units_of(blobs(dims, 180, dims))
    random = np.random.default_rng(9)
    count_a, count_b = random.integers(1, 4, len(a)), random.integers(1, 4, len(b))
    tree_a, tree_b = cover_tree.CoverTree(a), cover_tree.CoverTree(b)
    near = a @ a.T >= cosine
    np.fill_diagonal(near, False)
    found = cover_tree.traverse(tree_a, count_a, tree_a, count_a, cosine, same=True)
    assert (found.left == (near * count_a).sum(1)).all()
    across = a @ b.T >= cosine
    found = cover_tree.traverse(tree_a, count_a, tree_b, count_b, cosine)
    assert (found.left == (across * count_b).sum(1)).all()
    assert (found.right == (across * count_a[:, None]).sum(0)).all()


def test_levels_cover_their_descendants():
    units = cover_tree.units_of(blobs(4, 300, 5))
    tree = cover_tree.CoverTree(units)
    assert sorted(tree.order.tolist()) == list(range(300))
    for node, center in enumerate(tree.centers.tolist()):
        gaps = cover_tree.distances(units[[center]], units[tree.below(node)])
        assert gaps.max() <= tree.radii[node] + 1e-6


def brute(rows: list[tuple], cosine: float) -> dict[int, tuple]:
    usable = [
        (i, v, l) for i, v, l in rows
        if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = {i: 0 for i, _, _ in rows}
    root = {i: i for i, _, _ in rows}

    def top(i):
        return i if root[i] == i else top(root[i])

    for x, (i, v, l) in enumerate(usable):
        for y, (j, w, m) in enumerate(usable):
            if x != y and l == m and len(v) == len(w):
                a, b = np.array(v, float), np.array(w, float)
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= cosine:
                    links[i] += 1
                    low, high = sorted((top(i), top(j)))
                    root[high] = low
    return {i: (links[i], top(i)) for i in links}


def test_query_equals_brute_force_on_odd_rows(spark):
    vectors = blobs(2, 60, 4).astype(np.float32).astype(float).tolist()
    rows = [(i, v, i % 2) for i, v in enumerate(vectors)]
    rows += [(100 + i, vectors[0], 0) for i in range(5)]  # copies
    rows += [(200, None, 0), (201, [0.0] * 4, 0), (202, [1.0, None, 0.0, 0.0], 0), (203, [float("nan")] * 4, 0)]
    rows += [(204, [float("inf"), 0.0, 0.0, 0.0], 0), (205, vectors[0], None), (206, vectors[0][:3], 0), (207, [], 0)]
    rows += [(208, [x * 2 for x in vectors[0]], 0)]
    made = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    extra = made.selectExpr("*", "'x' point", "1 chunk", "2 copies", "3 links")
    expected = brute(rows, cover_tree.COSINE)
    for chunk in (cover_tree.CHUNK, 8):
        found = {r["vec_id"]: r for r in cover_tree.near_duplicates(extra, chunk=chunk).collect()}
        assert len(found) == len(rows)
        assert {i: (r["n_links"], r["component_id"]) for i, r in found.items()} == expected
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


def test_empty_repeated_and_null_ids(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert cover_tree.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (2, [1.0, 0.01], 0)]
    found = sorted(map(tuple, cover_tree.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert found == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 0, None, False), (2, 2, 1, False)], key=str)


def test_an_id_with_several_vectors_has_links_of_its_own_for_each(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.001]), (3, [0.9999, 0.002]), (4, [0.001, 1.0])]
    df = spark.createDataFrame([(i, "x", v) for i, v in rows], "vec_id long, label string, embedding array<double>")
    found = cover_tree.near_duplicates(df).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == [(1, 1, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 1, 1)]
