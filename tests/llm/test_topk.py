"""Top-k search against all scores."""

import math
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clicktally.llm import topk
from clicktally.llm.queries import EXPECTED, op8_no_random_access_top_k


def plain(rows, is_query, k, scale=256):
    usable = []
    for vec_id, vector in rows:
        if vec_id is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((vec_id, [math.floor(scale * x) for x in vector]))
    out = []
    for query_id, q in {(i, tuple(v)) for i, v in usable if is_query(i)}:
        scores = [
            (-sum(a * b for a, b in zip(q, v, strict=False)), i) for i, v in usable if i != query_id
        ]
        out += [(query_id, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def test_op8_against_sql(spark, sf_dir):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS FROM '{sf_dir}/embeddings.parquet'")
    wanted = sorted(duckdb.sql(EXPECTED["op8_no_random_access_top_k"]).fetchall())
    assert sorted(map(tuple, op8_no_random_access_top_k(spark, sf_dir).collect())) == wanted


@pytest.mark.parametrize("cell", [7, 64])
def test_cells_ties_and_odd_vectors(spark, monkeypatch, cell):
    monkeypatch.setattr(topk, "CELL_CANDIDATES", cell)
    monkeypatch.setattr(topk, "CELL_QUERIES", 5)
    monkeypatch.setattr(topk, "RESOLVED", 2)
    rng = random.Random(cell)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, [0.5] * 6) for i in range(40)]
    rows += [(300, None), (305, []), (306, [1.0, None]), (307, [float("nan")] * 6)]
    rows += [(308, [float("inf")] * 6), (None, [1.0] * 6), (310, [2.0]), (0, rows[0][1])]
    frame = spark.createDataFrame(
        [(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, row string, column int"
    )
    found = topk.top_k(frame, F.col("vec_id") % 10 == 0, 4)
    assert sorted(map(tuple, found.collect())) == plain(rows, lambda i: i % 10 == 0, 4)


def test_queries_are_dealt_by_their_values(spark, monkeypatch):
    monkeypatch.setattr(topk, "CELL_QUERIES", 5)
    rows = [(i, [float(i % 7), 1.0]) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    plan = topk.top_k(frame, F.col("vec_id") % 2 == 0, 3)._jdf.queryExecution().analyzed().toString()
    placed = [line for line in plan.split("\n") if "monotonically_increasing_id" in line]
    # Only candidates, which no shuffle comes before, are dealt by their place.
    assert len(placed) == 1 and "AS column" in placed[0]


class Watched(np.ndarray):
    """Vectors that note how many of them are fetched, and when."""

    def __getitem__(self, places):
        self.fetched.append((self.lists.depth, len(places)))
        return np.asarray(self)[places]


def test_whole_vectors_are_fetched_only_when_few_are_left():
    rng = np.random.default_rng(5)
    count, k = 2000, 3
    vectors, queries = rng.integers(-50, 51, (count, 4)), rng.integers(-50, 51, (20, 4))
    lists = topk.Lists(np.arange(count), vectors)
    watched = vectors.view(Watched)
    watched.lists, watched.fetched = lists, []
    lists.vectors = watched
    query, place, score = lists.best(np.full(20, -1), queries, k)
    scores = queries @ vectors.T
    for q in range(20):
        order = np.lexsort((np.arange(count), -scores[q]))[:k]
        assert place[query == q].tolist() == order.tolist()
    # One fetch for each query, of no more than may be left before the end of the lists.
    most = max(topk.RESOLVED, topk.RESOLVED_SHARE * count)
    assert len(watched.fetched) == len(queries)
    assert all(size <= most for depth, size in watched.fetched if depth < count)


def test_skewed_vectors_take_less_than_all_scores():
    rng = np.random.default_rng(8)
    count, k = 4000, 5
    vectors = np.floor(256 * rng.lognormal(0, 1.5, (count, 6))).astype(np.int64)
    queries = rng.integers(1, 200, (30, 6))
    queries[::3, 2] *= -1
    lists = topk.Lists(np.arange(count), vectors)
    query, place, score = lists.best(np.full(30, -1), queries, k)
    scores = queries @ vectors.T
    for q in range(30):
        order = np.lexsort((np.arange(count), -scores[q]))[:k]
        assert place[query == q].tolist() == order.tolist()
    assert lists.depth <= count // 8
    # Bounds of all steps together are fewer than a score for every pair.
    assert lists.bounded < queries.shape[0] * count / 2


def test_a_query_of_zeros_has_candidates_by_id():
    vectors = np.random.default_rng(1).integers(-9, 9, (500, 3))
    lists = topk.Lists(np.arange(500), vectors)
    query, place, score = lists.best(np.array([0, 1]), np.zeros((2, 3), np.int64), 3)
    assert place.tolist() == [1, 2, 3, 0, 2, 3] and not score.any()


def test_scores_that_may_not_fit_end_the_run():
    vectors = np.array([[2**40, 1], [1, 2**40]])
    with pytest.raises(ValueError, match="64 bits"):
        topk.Lists(np.arange(2), vectors).best(np.array([0]), vectors[:1], 1)
    assert len(topk.Lists(np.arange(2), vectors >> 20).best(np.array([0]), vectors[:1] >> 20, 1)[0]) == 1


def test_few_or_no_vectors(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(frame, F.col("vec_id") == 0, 5).collect()] == [
        (0, 1, 1, 256 * 512)
    ]
    assert topk.top_k(frame.limit(0), F.col("vec_id") == 0, 5).collect() == []
    assert topk.top_k(frame.filter("vec_id = 0"), F.col("vec_id") == 0, 5).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 300), st.integers(1, 6))
def test_bounds_hold_at_every_depth(seed, count, k):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-5, 6, (count, 8))
    queries = rng.integers(-5, 6, (3, 8))
    lists = topk.Lists(np.arange(count), vectors)
    scores = queries @ vectors.T
    for depth in sorted({1, count // 3 or 1, count}):
        lists.read(depth)
        assert (lists.bounds(queries, lists.least) <= scores).all()
        assert (lists.bounds(queries, lists.most) >= scores).all()
    query, place, score = topk.Lists(np.arange(count), vectors).best(np.array([-1] * 3), queries, k)
    for q in range(3):
        order = np.lexsort((np.arange(count), -scores[q]))[:k]
        assert place[query == q].tolist() == order.tolist()
        assert score[query == q].tolist() == scores[q][order].tolist()
