"""The adaptive scan: what it reads, what it finds, and that an exact test never errs."""

from collections import defaultdict

import numpy as np
import pytest

from siltstone.llm import adaptive_scan as scan
from siltstone.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.1"


def _vectors(spark, directory):
    rows = spark.read.parquet(f"{directory}/embeddings.parquet").orderBy("vec_id").collect()
    return np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)


@pytest.mark.parametrize("directory", ["/root/testdata/sf0.01", TABLES])
def test_recall_against_brute_force(spark, directory):
    ids, vectors = _vectors(spark, directory)
    found = defaultdict(list)
    for r in sorted(QUERIES["op10_adaptive_scan"](spark, directory).collect(), key=lambda r: r["rank"]):
        found[r.query_id].append((r.vec_id, r.score))
    right = 0
    for query, near in found.items():
        scores = (vectors * vectors[ids == query]).sum(axis=1)
        order = [ids[i] for i in np.lexsort((ids, -scores)) if ids[i] != query][:20]
        right += len(set(order) & {x for x, _ in near})
        assert [s for _, s in near] == sorted((s for _, s in near), reverse=True)
        assert all(s == scores[ids == x][0] for x, s in near)
    assert len(found) == (ids % 20 == 0).sum()
    assert right >= 0.95 * 20 * len(found)


def test_most_columns_of_most_candidates_are_not_read(spark):
    _, vectors = _vectors(spark, TABLES)
    lists = scan.fit_lists(vectors, 45)
    tests = scan.fit_tests(lists, vectors, 20, 0.001)
    turned = lists.turned(vectors)
    queries = turned[::20]
    scores = queries @ turned.T
    bars = np.partition(scores, -21, axis=1)[:, -21]
    rows, columns, read = scan.scan(queries, bars, turned, tests, 21)
    assert read < 0.55 * scores.size * 64
    wanted = set(zip(*np.nonzero(scores >= bars[:, None]), strict=True))
    assert len(wanted & set(zip(rows.tolist(), columns.tolist(), strict=True))) >= 0.97 * len(wanted)
    # A tenth of the lists gives a bar that still abandons.
    near = lists.nearest(turned)
    first = lists.probed(queries, 4)
    seen = (near[None, :, None] == first[:, None, :]).any(axis=2)
    low = np.partition(np.where(seen, scores, -np.inf), -21, axis=1)[:, -21]
    assert scan.scan(queries, low, turned, tests, 21)[2] < 0.75 * scores.size * 64


def test_a_critical_value_of_one_is_exact():
    rng = np.random.default_rng(1)
    candidates, queries = rng.normal(size=(3000, 20)), rng.normal(size=(40, 20))
    candidates[500:700] = candidates[3]
    scores = queries @ candidates.T
    for bars in (np.full(40, -np.inf), np.partition(scores, -10, axis=1)[:, -10], np.full(40, 1e9)):
        rows, columns, _ = scan.scan(queries, bars, candidates, np.ones(3), 10)
        found = set(zip(rows.tolist(), columns.tolist(), strict=True))
        bound = np.maximum(bars, np.partition(scores, -10, axis=1)[:, -10])
        assert {(i, j) for i, j in zip(*np.nonzero(scores >= bound[:, None] + 1e-8), strict=True)} <= found
        assert all(scores[i, j] >= bars[i] - 1e-6 for i, j in found)


def test_ties_widths_and_few_rows(spark):
    rows = [(i, [1.0, 0.0, float(i % 2)]) for i in range(50)] + [(100 + i, [1.0, 2.0]) for i in range(5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in sorted(scan.nearest_neighbours(frame).collect(), key=lambda r: r["rank"]):
        found[r.query_id].append(r.vec_id)
    evens = [i for i in range(0, 50, 2)]
    odds = [i for i in range(1, 50, 2)]
    assert sorted(found) == [0, 20, 40]
    # All products with an even query are 1: the smallest ids, whatever the vector.
    assert all(found[q] == [i for i in sorted(evens + odds) if i != q][:20] for q in found)
    small = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (20, [-1.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(scan.nearest_neighbours(small).collect())] == [
        (0, 1, 1), (0, 2, 20), (20, 1, 0), (20, 2, 1),
    ]
