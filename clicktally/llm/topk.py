"""Exact top-k by inner product with no-random-access aggregation.

The candidates are one list per component, sorted by its value. A query reads the lists of its
positive components from the top and those of its negative ones from the bottom, so each list falls
in the score that it adds. At a depth every candidate that some list has shown has a lower bound, its
components read so far plus the end of every list that has not shown it, and an upper bound, the same
with the place reached instead of the end; no outsider can score more than the places reached together.
The lists are read on, in growing steps from a small part, until outsiders cannot reach the k-th best
lower bound. From then on only the candidates whose upper bound does are carried, and when few are left
these alone get their whole score. Ties go to the smaller id.

Queries and candidates are dealt to cells, each with a bounded number of both, and every pair of a
query and a candidate meets in one cell: all work is that of the stated query set against all rows,
in blocks. The best k of every cell are ranked once more.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Queries and candidates of a cell, and queries whose bounds are held at once.
CELL_QUERIES = 4096
CELL_CANDIDATES = 16_384
TOGETHER = 64

# Parts of the lists that are read before the bounds are compared.
DEPTHS = (1 / 64, 1 / 32, 1 / 16, 1 / 8, 1 / 4, 1 / 2, 3 / 4, 7 / 8, 15 / 16, 1.0)

# Bounds are made for single candidates where these are less than one in so many, and else for all of a
# cell at once, by products of matrices; before this depth such products tell too little.
SPARSE = 2
DENSE_FROM = 0.5

# Scores that 64-bit integers hold without any doubt.
MOST_SCORE = 2.0**62

# Share of a cell's candidates, and a number of them, that may be left to resolve.
RESOLVED_SHARE, RESOLVED = 1 / 32, 64

FOUND = "query_id long, query_hash long, vec_id long, score long"


class Lists:
    """The candidates of a cell as sorted lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        self.vectors = vectors
        self.columns = vectors.T.astype(np.float64)
        self.order = np.argsort(-vectors.T, axis=1, kind="stable")
        self.sorted = np.take_along_axis(self.columns, self.order, 1)
        self.depth = 0
        self.top = np.zeros(self.columns.shape, bool)
        self.bottom = np.zeros(self.columns.shape, bool)

    def read(self, depth: int) -> None:
        """Read every list on, from its top and from its bottom, down to a depth."""
        new = self.order[:, self.depth : depth]
        np.put_along_axis(self.top, new, True, 1)
        count = len(self.ids)
        new = self.order[:, count - depth : count - self.depth]
        np.put_along_axis(self.bottom, new, True, 1)
        self.depth = depth
        high, low = self.sorted[:, depth - 1 : depth], self.sorted[:, count - depth, None]
        first, last = self.sorted[:, :1], self.sorted[:, -1:]
        # What a list read from the top or from the bottom adds at most, and at least; a row a candidate.
        self.most = self._rows(self.top, high), self._rows(self.bottom, low)
        self.least = self._rows(self.top, last), self._rows(self.bottom, first)

        self.edges = high[:, 0], low[:, 0]

    def _rows(self, shown: np.ndarray, others: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(np.where(shown, self.columns, others).T)

    @staticmethod
    def bounds(
        queries: np.ndarray, values: tuple[np.ndarray, np.ndarray], places=slice(None)
    ) -> np.ndarray:
        """Bounds of all candidates, or of those at some places."""
        rising, falling = np.maximum(queries, 0), np.minimum(queries, 0)
        return rising @ values[0][places].T + falling @ values[1][places].T

    def shown(self, query: np.ndarray) -> np.ndarray:
        """The places of the candidates that a list of the query has shown."""
        rising = self.order[query > 0, : self.depth]
        falling = self.order[query < 0, len(self.ids) - self.depth :]
        return np.unique(np.concatenate([rising.ravel(), falling.ravel()]))

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """Place of the query, place of the candidate and score of the best k of every query."""
        count, found = len(self.ids), []
        reach = np.abs(queries).max(1, initial=0) * np.abs(self.columns).max(initial=0)
        if reach.max(initial=0) * queries.shape[1] >= MOST_SCORE:
            raise ValueError("components too large: a score may not fit 64 bits")
        # Both the threshold and what is compared with it are rounded sums.
        slack = 2 * reach * queries.shape[1] * 2.0**-48
        few = max(RESOLVED, RESOLVED_SHARE * count)
        known = np.full(len(queries), -np.inf)
        own = [np.flatnonzero(self.ids == query_id) for query_id in query_ids]
        lists = np.count_nonzero(queries, axis=1).tolist()
        # The places a query still carries, once outsiders cannot qualify.
        carried: dict[int, np.ndarray] = {}
        active = list(range(len(queries)))
        self.bounded = 0

        def narrowed(query: int, places: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> None:
            """Raise the threshold of a query and keep the places that reach it, if no others can.

            The bounds of the query's own rows are below all.
            """
            if len(places) - len(own[query]) >= k:
                known[query] = max(known[query], np.partition(lower, -k)[-k])
            least = known[query] - slack[query]
            edges = (self.edges[0][None], self.edges[1][None])
            outside = self.bounds(queries[query].astype(np.float64), edges)[0]
            if query in carried or len(places) == count or outside < least:
                carried[query] = places[(upper >= least) & (upper > -np.inf)]

        for share in DEPTHS:
            depth = max(1, math.ceil(share * count))
            few_shown = {query for query in active if depth < count and SPARSE * lists[query] * depth < count}
            if share < DENSE_FROM and not few_shown and not carried:
                continue
            if depth > self.depth:
                self.read(depth)
            dense = []
            for query in active:
                if query in carried:
                    places = carried[query]
                elif query in few_shown:
                    places = self.shown(queries[query])
                else:
                    places = None
                if places is not None and SPARSE * len(places) < count:
                    vector = queries[query].astype(np.float64)
                    lower, upper = (self.bounds(vector, v, places) for v in (self.least, self.most))
                    mine = np.isin(places, own[query])
                    lower[mine] = upper[mine] = -np.inf
                    self.bounded += len(places)
                    narrowed(query, places, lower, upper)
                elif share >= DENSE_FROM:
                    dense.append(query)
            every = np.arange(count)
            for first in range(0, len(dense), TOGETHER):
                part = dense[first : first + TOGETHER]
                vectors = queries[part].astype(np.float64)
                lower, upper = self.bounds(vectors, self.least), self.bounds(vectors, self.most)
                self.bounded += lower.size
                for row, query in enumerate(part):
                    lower[row, own[query]] = upper[row, own[query]] = -np.inf
                    narrowed(query, every, lower[row], upper[row])
            left = []
            for query in active:
                if query not in carried or (len(carried[query]) > few and depth < count):
                    left.append(query)
                    continue
                open_ = carried.pop(query)
                scores = self.vectors[open_] @ queries[query]
                best = np.lexsort((self.ids[open_], -scores))[:k]
                found.append((np.full(len(best), query), open_[best], scores[best]))
            active = left
            if not active:
                break
        return [np.concatenate(part) for part in zip(*found, strict=True)]


def _matrix(table: pa.Table, column: str, dimensions: int) -> np.ndarray:
    """The vectors of a column as rows; what a shorter one lacks is zero."""
    values = table.column(column).combine_chunks()
    lengths = np.diff(values.offsets.to_numpy())
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), dimensions), np.int64)
    out[np.arange(dimensions) < lengths[:, None]] = flat
    return out


def quantised(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component, null for a vector that holds anything but numbers."""
    usable = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    return F.when(
        usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    )


def top_k(vectors: DataFrame, is_query: Column, k: int, scale: int = 256) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` for rows of ``vec_id`` and ``embedding``.

    Rows without an id, and vectors that are null or hold a null or non-finite component, take no part.
    A query is no candidate of its own, nor are other rows of its id; equal query rows are one query, other
    repeated rows are candidates each. A shorter vector counts as one with zeros behind. With fewer
    than ``k`` candidates all are given. Components so large that a score may not fit 64 bits end the
    run. Other columns are left out.
    """
    usable = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        quantised(F.col("embedding"), scale).alias("v"),
    ).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    queries = usable.filter(is_query).distinct().withColumn("query_hash", F.xxhash64("v"))
    counts = usable.agg(F.count("*").alias("all"), F.count_if(is_query).alias("queries")).first()
    columns = max(1, -(-counts["all"] // CELL_CANDIDATES))
    rows = max(1, -(-counts["queries"] // CELL_QUERIES))

    def dealt(frame: DataFrame, key: Column, own: str, cells: int, other: str, others: int) -> DataFrame:
        place = F.pmod(F.xxhash64(key), F.lit(cells)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return frame.withColumn(own, place).withColumn(other, every)

    # Queries come out of a shuffle, where the place of a row can change when a task runs again; they
    # are distinct, so their values deal them. Repeated candidates are only told apart by their place.
    left = dealt(queries, F.struct("vec_id", "v"), "row", rows, "column", columns)
    right = dealt(usable, F.monotonically_increasing_id(), "column", columns, "row", rows)

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        empty = [pa.array([], pa.int64())] * 4
        names = [field.split()[0] for field in FOUND.split(", ")]
        if not asked.num_rows or not held.num_rows:
            return pa.Table.from_arrays(empty, names)
        sizes = [
            int(np.diff(t.column("v").combine_chunks().offsets.to_numpy()).max())
            for t in (asked, held)
        ]
        lists = Lists(held.column("vec_id").to_numpy(), _matrix(held, "v", max(sizes)))
        ids = asked.column("vec_id").to_numpy()
        query, place, score = lists.best(ids, _matrix(asked, "v", max(sizes)), k)
        hashes = asked.column("query_hash").to_numpy()
        arrays = [ids[query], hashes[query], lists.ids[place], score.astype(np.int64)]
        return pa.Table.from_arrays([pa.array(values) for values in arrays], names)

    cells = left.groupBy("row", "column").cogroup(right.groupBy("row", "column"))
    found = cells.applyInArrow(search, FOUND)
    best = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
