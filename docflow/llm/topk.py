"""Exact top-k inner products by no-random-access aggregation.

Vectors are packed into blocks of bounded size. A block holds one list per component, sorted by value. For a query
its lists are read in parallel from the end that adds most; what was read gives each row a lower bound (lists not
yet read count with their last value) and an upper bound (with their value at the present depth). Reading stops when
no row beside the candidates can still reach the k-th lower bound, then the candidates' scores are resolved exactly.
As a value was read if it lies beyond the value at the present depth, the bounds of all rows for all queries of a block
are products of clipped values and queries. Blocks of candidates meet blocks of queries by an equi-join on a slot
number, and each task carries the k best candidates of a query from block to block.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block of candidates and of queries.
BLOCK, QUERY_BLOCK = 2048, 128
#: Query blocks whose best candidates a task remembers; more are sent on and begun anew, which only costs speed.
REMEMBERED = 512
#: Depths at which the bounds of a block may be looked at, in equal steps.
STEPS = 16
#: Reading stops when this part of a block is left; resolving so few costs less than reading on.
FEW_LEFT = 16
#: Pairs of rows and queries that are resolved at once.
PAIRS = 1 << 16
EXACT = float(1 << 53)


class Block:
    """Integer vectors with their ids, and for each component the list of its values in order. read: entries of lists read so far."""

    def __init__(self, ids: np.ndarray, data: np.ndarray):
        self.ids, self.data = ids, data
        n = len(data)
        lists = np.sort(data, axis=0)
        self.single = data.astype(np.float32)
        _, counts = np.unique(ids, return_counts=True)
        self.copies = int(counts.max()) if n else 1
        self.largest = np.abs(data).max(0, initial=0.0)
        self.depth = np.unique(np.ceil(np.arange(1, STEPS + 1) * n / STEPS).astype(int))
        self.depth = self.depth[self.depth > 0]
        self.ends = (lists[0], lists[-1]) if n else (self.largest, self.largest)
        self.bottom, self.top = lists[self.depth - 1], lists[n - self.depth]  # the values last read at each depth
        below, above = np.cumsum(lists, axis=0)[self.depth - 1], np.cumsum(lists[::-1], axis=0)[self.depth - 1]
        unread = (n - self.depth)[:, None]
        self.mean_bottom, self.mean_top = (below + unread * self.bottom) / max(1, n), (above + unread * self.top) / max(1, n)
        self.read = 0

    def upper(self, at: int, queries: np.ndarray) -> np.ndarray:
        """Upper bounds (rows x queries) at a depth: values not yet read count as the one last read."""
        x, q = self.single, queries.astype(np.float32).T
        return np.maximum(x, self.top[at].astype(np.float32)) @ np.maximum(q, 0) + np.minimum(x, self.bottom[at].astype(np.float32)) @ np.minimum(q, 0)

    def lower(self, at: int, queries: np.ndarray) -> np.ndarray:
        """Lower bounds (rows x queries) at a depth: values not yet read count as the last of their list."""
        x, q = self.single, queries.astype(np.float32).T
        top, bottom = self.top[at].astype(np.float32), self.bottom[at].astype(np.float32)
        least, most = (e.astype(np.float32) for e in self.ends)
        return np.where(x >= top, x, least) @ np.maximum(q, 0) + np.where(x <= bottom, x, most) @ np.minimum(q, 0)

    def exact(self, queries: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs by whole numbers of any size, cut to the ends of a long."""
        ints = [[int(a) for a in x] for x in self.data]
        scores = np.array([[min(max(sum(int(a) * b for a, b in zip(q, x)), -(1 << 63)), (1 << 63) - 1) for x in ints] for q in queries], np.int64).reshape(len(queries), len(ints))
        place, rows = np.nonzero(self.ids[None, :] != own[:, None])
        return place, rows, scores[place, rows]

    def best(self, queries: np.ndarray, own: np.ndarray, k: int, reached: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the query, row, score) of at least all rows of the k best ids of each query that score at least its reached; rows of the query's own id take no part."""
        n = len(self.ids)
        empty = np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.int64)
        if not n or not len(queries):
            return empty
        weight = np.abs(queries) @ self.largest
        if weight.max() >= EXACT:  # beyond what doubles hold exactly
            return self.exact(queries, own)
        k *= self.copies
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        slack = weight * (2e-7 * (queries.shape[1] + 8))  # bounds are in single precision
        bound, last = reached - slack, len(self.depth) - 1
        going = np.flatnonzero(up @ self.ends[1] + down @ self.ends[0] >= bound)  # others cannot qualify before anything is read
        new = going[np.isneginf(bound[going])]
        if len(new) and n - self.copies > k and last:  # no candidates yet: the k-th lower bound takes their place
            at = last // 2
            lower = self.lower(at, queries[new])
            lower[self.ids[:, None] == own[None, new]] = -np.inf
            bound[new] = np.partition(lower, n - k, axis=0)[n - k] - 2 * slack[new]
        mean = self.mean_top @ up.T + self.mean_bottom @ down.T  # of all rows' upper bounds, by depth and query
        found = []
        wanted = np.where((mean < bound).any(0), (mean < bound).argmax(0), last)
        for at in range(last + 1):  # the lists are read on, and looked at where the mean says that it is worth while
            mine = going[wanted[going] == at]
            if not len(mine):
                continue
            if at < last:
                alive = self.upper(at, queries[mine]) + slack[mine] >= bound[mine]
                many = alive.sum(0) > max(4 * k, n // FEW_LEFT)
                wanted[mine[many]] = at + 1
                mine, alive = mine[~many], alive[:, ~many]
                self.read += len(mine) * self.data.shape[1] * int(self.depth[at])
                place, rows = np.nonzero(alive.T)
                found += [(mine[place[i : i + PAIRS]], rows[i : i + PAIRS], np.einsum("ij,ij->i", queries[mine[place[i : i + PAIRS]]], self.data[rows[i : i + PAIRS]])) for i in range(0, len(rows), PAIRS)]
            else:
                self.read += len(mine) * self.data.size
                scores = queries[mine] @ self.data.T
                scores[self.ids[None, :] == own[mine, None]] = -np.inf
                least = np.partition(scores, n - k, axis=1)[:, n - k] if n > k else np.full(len(mine), -np.inf)
                place, rows = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
                found.append((mine[place], rows, scores[place, rows]))
        if not found:
            return empty
        place, rows, scores = (np.concatenate(x) for x in zip(*found))
        keep = (scores >= reached[place]) & (self.ids[rows] != own[place])
        return place[keep], rows[keep], np.rint(scores[keep]).astype(np.int64)


def k_best(place: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each place its k best distinct ids, each with its best score, ties to smaller ids; ordered by place and rank."""
    order = np.lexsort((~scores, ids, place))
    place, ids, scores = place[order], ids[order], scores[order]
    first = np.concatenate([[True], (place[1:] != place[:-1]) | (ids[1:] != ids[:-1])]) if len(place) else np.zeros(0, bool)
    place, ids, scores = place[first], ids[first], scores[first]
    order = np.lexsort((ids, ~scores, place))
    place, ids, scores = place[order], ids[order], scores[order]
    start = np.searchsorted(place, place)
    keep = np.arange(len(place)) - start < k
    return place[keep], ids[keep], scores[keep]


def pack(df: DataFrame, size: int, scale: float) -> DataFrame:
    """(block, dim, n, ids, data): blocks of at most size vectors of one length, scaled and floored, as packed numbers."""

    def run(batches):
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        count = 0
        prefix = TaskContext.get().partitionId() << 32

        def block(dim: int):
            nonlocal count
            ids = np.concatenate([a for a, _ in held[dim]])
            data = np.concatenate([b for _, b in held[dim]])
            held[dim] = [(ids[size:], data[size:])]
            ids, data = ids[:size], data[:size]
            count += 1
            small = not data.size or np.abs(data).max() < 1 << 15
            raw = data.astype(np.int16 if small else np.float64).tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([prefix + count]), pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([raw], pa.binary())],
                names=["block", "dim", "n", "ids", "data"],
            )

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            lens = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            begin = np.cumsum(lens) - lens
            for dim in np.unique(lens).tolist():
                rows = np.flatnonzero(lens == dim)
                data = np.floor(flat[begin[rows][:, None] + np.arange(dim)[None, :]] * scale)
                held.setdefault(dim, []).append((ids[rows].astype(np.int64), data))
                while sum(len(a) for a, _ in held[dim]) >= size:
                    yield block(dim)
        for dim in list(held):
            while sum(len(a) for a, _ in held[dim]):
                yield block(dim)

    return df.mapInArrow(run, "block bigint, dim int, n int, ids binary, data binary")


def unpack(ids: bytes, data: bytes, n: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    kind = np.int16 if len(data) == 2 * n * dim else np.float64
    return np.frombuffer(ids, np.int64), np.frombuffer(data, kind).reshape(n, dim).astype(np.float64)


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: float = 1024.0, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Returns (query_id, rank from 1, id, score): for each query its k best other vectors by integer inner product, ties to smaller ids.

    is_query: a condition on the columns of vectors. Components become floor(scale * x). Vectors that are null, hold
    null or non-finite components or have a null id take no part; only vectors of one length are compared. An id that
    stands in several rows counts once, with its best score, as query and as candidate. A query without candidates has
    no rows; an empty table gives none. Scores beyond a long are its ends. Other columns are not carried.
    """
    x = F.col(vector_col).cast("array<double>")
    sound = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))), F.lit(False))
    usable = vectors.where(sound)
    picked = lambda df: df.select(F.col(id_col).cast("long").alias("id"), x.alias("v"))
    size = usable.agg(F.count("*").alias("all"), F.count_if(is_query).alias("queries")).first()
    slots = max(1, min(-(-size["all"] // block), max(64, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    n_query_blocks = max(1, -(-size["queries"] // query_block))
    asked = picked(usable.where(is_query)).withColumn("b", F.pmod(F.xxhash64("id"), F.lit(n_query_blocks))).repartition(n_query_blocks, "b").select("id", "v")
    q = pack(asked, query_block, scale).select("dim", F.col("block").alias("q_block"), F.col("n").alias("q_n"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    c = pack(picked(usable), block, scale).withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int"))
    pairs = c.join(q, ["slot", "dim"]).select("block", "dim", "n", "ids", "data", "q_block", "q_n", "q_ids", "q_data")

    def run(batches):
        held: tuple[int, Block | None] = (-1, None)
        reached: OrderedDict[int, tuple] = OrderedDict()  # of a query block its ids, and the places, ids and scores of their best candidates

        def told(own, place, ids, scores):
            return pa.RecordBatch.from_arrays([pa.array(own[place]), pa.array(ids), pa.array(scores)], names=["query_id", "id", "score"])

        for batch in batches:
            for r in range(batch.num_rows):
                number, dim, n, ids, data, q_number, q_n, q_ids, q_data = (batch.column(i)[r].as_py() for i in range(9))
                if held[0] != number:
                    held = (number, Block(*unpack(ids, data, n, dim)))
                own, queries = unpack(q_ids, q_data, q_n, dim)
                _, place, known, scores = reached.pop(q_number, (own, np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0, np.int64)))
                least = np.full(q_n, -np.inf)
                full = np.bincount(place, minlength=q_n) >= k
                least[full] = scores[np.searchsorted(place, np.flatnonzero(full), side="right") - 1]
                p, rows, s = held[1].best(queries, own, k, least)
                reached[q_number] = (own, *k_best(np.concatenate([place, p]), np.concatenate([known, held[1].ids[rows]]), np.concatenate([scores, s]), k))
                if len(reached) > REMEMBERED:
                    yield told(*reached.popitem(last=False)[1])
        for x in reached.values():
            yield told(*x)

    scored = pairs.mapInArrow(run, "query_id bigint, id bigint, score bigint")
    once = scored.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
