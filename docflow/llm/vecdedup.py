"""Near-duplicates among vectors by a robust-pruned graph.

Vectors go to the shards of their nearest centers, so shards overlap. Each shard builds a graph by greedy searches
and robust pruning; the adjacency lists that a vector got in its shards are united. Over the united lists each shard
searches greedily from its medoid and from the vector itself, and expands on while there are neighbours in range.
What it finds is verified in double precision. A sample of vectors is compared with all others by brute force, and
the search is repeated with wider overlap and beam if its recall is too low. If none of the tries comes up to it, all
pairs are compared, chunk by chunk.

Equal vectors are one vector with a weight. Large tight groups, found on the sample, are balls around a leader of
half the angle in range, so all their pairs are links and are only counted. Only balls with others near take part in
the search. Shards beyond a size are cut into chunks of which all pairs are searched.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.components import components, local_labels, tree_edges
from docflow.llm.shared import cut

#: Rows of a shard on average and at most; rows sampled for centers and leaders; rows audited (all expected or bounded).
SHARD_ROWS, MOST_ROWS, SAMPLE_ROWS, AUDIT_ROWS = 1500, 6000, 8192, 512
#: The sample grows to four rows for each shard, but not beyond this.
MOST_SAMPLE = 1 << 16
#: Vectors that stand in more rows than this share of all are joined by broadcast: as many as its inverse at most.
HOT_SHARE = 1e-4
#: Out-degree, pruning factor, length of the candidate list, nodes expanded in one step, queries searched together.
DEGREE, ALPHA, BEAM, EXPAND, TOGETHER = 24, 1.2, 48, 4, 256
#: Sampled neighbours that make a sampled vector the leader of a ball.
LEADS = 8
LEAST_RECALL, TRIES = 0.95, 3


def search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, starts: np.ndarray, beam: int):
    """Greedy search for rows of x over a padded adjacency matrix (-1: none). Returns scores (queries x nodes, -2: not visited) and expanded nodes."""
    b, n = len(queries), len(x)
    q = x[queries]
    scores = np.full((b, n + 1), -2, np.float32)  # the last column takes what is padding
    open_ = np.zeros((b, n + 1), bool)  # visited, not expanded
    rows = np.arange(b)[:, None]
    scores[rows, starts] = np.einsum("brd,bd->br", x[starts], q)
    open_[rows, starts] = True
    ids = np.full((b, beam), n)
    ids[:, : starts.shape[1]] = starts
    value = np.take_along_axis(scores, ids, 1)
    going = np.arange(b)
    while len(going):
        r = going[:, None]
        waiting = np.where(open_[r, ids[going]], value[going], -3)
        pick = np.argpartition(-waiting, EXPAND - 1, axis=1)[:, :EXPAND]
        chosen = np.take_along_axis(ids[going], pick, 1)
        chosen = np.where(np.take_along_axis(waiting, pick, 1) > -3, chosen, n)
        alive = (chosen < n).any(1)
        going, chosen = going[alive], chosen[alive]
        if not len(going):
            break
        r = going[:, None]
        open_[r, chosen] = False
        new = expand(x, graph, q, scores, open_, going, chosen)
        every = np.concatenate([ids[going], new], 1)
        got = np.concatenate([value[going], scores[r, new]], 1)
        got[:, beam:][new == n] = -2
        best = np.argpartition(-got, beam - 1, axis=1)[:, :beam]
        ids[going], value[going] = np.take_along_axis(every, best, 1), np.take_along_axis(got, best, 1)
    return scores, open_


def expand(x, graph, q, scores, open_, going, chosen) -> np.ndarray:
    """Visits the neighbours of chosen nodes for the queries in going; returns those visited first (padding else)."""
    n = len(x)
    near = np.concatenate([graph, np.full((1, graph.shape[1]), -1, graph.dtype)])[chosen].reshape(len(going), -1)
    near = np.where(near < 0, n, near)
    near.sort(axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = n
    r = going[:, None]
    near = np.where(scores[r, near] > -2, n, near)
    a, b = np.nonzero(near < n)
    node = near[a, b]
    scores[going[a], node] = np.einsum("ij,ij->i", x[node], q[going[a]])
    open_[going[a], node] = True
    return near


def in_range(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, starts: np.ndarray, beam: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(place in queries, node) of the nodes found that score at least `least`: expands on from each such node."""
    scores, open_ = search(x, graph, queries, starts, beam)
    n = len(x)
    while True:
        wanted = open_[:, :n] & (scores[:, :n] >= least)
        going = np.flatnonzero(wanted.any(1))
        if not len(going):
            break
        w = wanted[going]
        chosen = np.where(w.any(1)[:, None], np.argsort(~w, axis=1, kind="stable")[:, : EXPAND * 2], n)
        chosen = np.where(np.take_along_axis(w, np.minimum(chosen, n - 1), 1), chosen, n)
        open_[going[:, None], chosen] = False
        expand(x, graph, scores=scores, open_=open_, q=x[queries], going=going, chosen=chosen)
    return np.nonzero(scores[:, :n] >= least)


def robust_prune(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours of each node from a row of candidates (-1: none): the nearest, then the nearest not much nearer to one kept."""
    b, c = candidates.shape
    valid = (candidates >= 0) & (candidates != nodes[:, None])
    vec = x[np.maximum(candidates, 0)]
    far = 1 - np.einsum("bcd,bd->bc", vec, x[nodes])
    far[~valid] = np.inf
    kept = np.full((b, degree), -1, np.int32)
    rows = np.arange(b)
    for k in range(degree):
        j = far.argmin(1)
        some = np.isfinite(far[rows, j])
        if not some.any():
            break
        kept[some, k] = candidates[rows, j][some]
        apart = 1 - np.einsum("bcd,bd->bc", vec, vec[rows, j])
        far[(alpha * apart <= far) & some[:, None]] = np.inf
        far[rows, j] = np.inf
    return kept


def build(x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, beam: int = BEAM) -> np.ndarray:
    """Adjacency matrix (-1: none) of unit vectors: nodes come in batches, each linked to the pruned nodes that its search visits."""
    n = len(x)
    graph = np.full((n, degree), -1, np.int32)
    if n < 2:
        return graph
    rng = np.random.default_rng(n)
    order = rng.permutation(n)
    medoid = int((x @ x.mean(0)).argmax())
    order = np.concatenate([[medoid], order[order != medoid]])
    size, done = 32, 1
    while done < n:  # batches grow with the graph
        batch = order[done : done + min(size, TOGETHER)]
        scores, open_ = search(x, graph, batch, np.full((len(batch), 1), medoid), beam)
        seen = scores[:, :n].copy()
        inside = x[batch] @ x[batch].T  # nodes of one batch see each other
        seen[:, batch] = np.maximum(seen[:, batch], inside)
        seen[np.arange(len(batch)), batch] = -2
        c = min(n - 1, 2 * beam)
        best = np.argpartition(-seen, c - 1, axis=1)[:, :c].astype(np.int32)
        best[np.take_along_axis(seen, best, 1) <= -2] = -1
        graph[batch] = robust_prune(x, batch, best, degree, alpha)
        source, target = np.repeat(batch, degree), graph[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        o = np.argsort(target, kind="stable")
        source, target = source[o], target[o]
        nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
        width = int(counts.max()) if len(counts) else 0
        for k in range(0, len(nodes), TOGETHER):
            p, f, m = nodes[k : k + TOGETHER], first[k : k + TOGETHER], counts[k : k + TOGETHER]
            back = np.where(np.arange(width)[None, :] < m[:, None], source[np.minimum(f[:, None] + np.arange(width)[None, :], len(source) - 1)], -1)
            both = np.concatenate([graph[p], back], 1).astype(np.int32)
            both.sort(axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            graph[p] = robust_prune(x, p, both, degree, alpha)
        done += len(batch)
        size *= 2
    return graph


def both_ways(graph: np.ndarray, extra: int = DEGREE) -> np.ndarray:
    """The adjacency matrix with up to `extra` edges back to each node, so that a node that others were preferred to is reached as well."""
    source, k = np.nonzero(graph >= 0)
    target = graph[source, k]
    known = (graph[target] == source[:, None]).any(1)
    source, target = source[~known], target[~known]
    order = np.lexsort((source, target))
    source, target = source[order], target[order]
    first = np.concatenate([[True], target[1:] != target[:-1]]) if len(target) else np.zeros(0, bool)
    rank = np.arange(len(target)) - np.maximum.accumulate(np.where(first, np.arange(len(target)), 0))
    some = rank < extra
    back = np.full((len(graph), extra), -1, graph.dtype)
    back[target[some], rank[some]] = source[some]
    return np.concatenate([graph, back], axis=1)


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def centers_of(sample: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means on the sample."""
    rng = np.random.default_rng(k)
    c = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(6):
        near = (sample @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, near, sample)
        norm = np.linalg.norm(total, axis=1)
        c = np.where(norm[:, None] > 1e-9, total / np.maximum(norm, 1e-9)[:, None], c)
    return c


def leaders_of(sample: np.ndarray, cos_radius: float) -> np.ndarray:
    """Centers of balls that hold at least LEADS of the sample and do not share members of it."""
    count = np.concatenate([(sample[k : k + 1024] @ sample.T >= cos_radius).sum(1) for k in range(0, len(sample), 1024)]) if len(sample) else np.zeros(0, int)
    left, found = count > LEADS, []
    while left.any():
        i = int(np.where(left, count, -1).argmax())
        found.append(sample[i])
        left &= sample @ sample[i] < cos_radius
    return np.array(found).reshape(-1, sample.shape[1])


def all_in_range(exact: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """All places (a, b), a < b, of unit vectors that score at least `least`."""
    found = []
    for k in range(0, len(exact), TOGETHER):
        a, b = np.nonzero(exact[k : k + TOGETHER] @ exact[k:].T >= least)
        found.append((a[a < b] + k, b[a < b] + k))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def links_of(reps: DataFrame, dim: int, least: float, overlap: int, beam: int, sample: np.ndarray, n: int, exhaustive: bool = False):
    """reps: (rep, w, v binary). Returns (placed, (rep, w, node, n_links), (a, b) edges of nodes): node is the rep, or -1 - ball.

    exhaustive: one shard, whose chunks are compared pair by pair without a graph.
    """
    angle = np.arccos(least)
    cos_radius, cos_border = np.cos(angle / 2) + 1e-9, np.cos(1.5 * angle) - 1e-9
    leaders = leaders_of(sample, cos_radius)
    shards = 1 if exhaustive else max(1, min(round(n / SHARD_ROWS), len(sample) // 4 or 1))
    centers = centers_of(sample, shards)
    top = min(overlap, len(centers))

    def assign(batches):
        for batch in batches:
            x = unit(np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float64).reshape(-1, dim))
            to_leader = x @ leaders.T
            ball = np.where((to_leader >= cos_radius).any(1), to_leader.argmax(1), -1) if len(leaders) else np.full(len(x), -1)
            border = to_leader >= cos_border
            border[np.arange(len(x))[ball >= 0], ball[ball >= 0]] = False
            near = [np.flatnonzero(r).tolist() for r in border] if len(leaders) else [[]] * len(x)
            to_center = x @ centers.T
            own = np.sort(np.argpartition(-to_center, top - 1, axis=1)[:, :top], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(ball.astype(np.int32)), pa.array(near, pa.list_(pa.int32())), pa.array(own.tolist(), pa.list_(pa.int32()))],
                names=["rep", "w", "v", "ball", "near", "shards"],
            )

    placed = cut(reps.mapInArrow(assign, "rep bigint, w bigint, v binary, ball int, near array<int>, shards array<int>"))
    busy = [r[0] for r in placed.select(F.explode("near")).distinct().collect()] if len(leaders) else []  # leaders at most
    active = placed.where((F.col("ball") < 0) | F.col("ball").isin(busy)) if busy else placed.where("ball < 0")
    spread = active.select("rep", "w", "v", "ball", "shards", F.explode("shards").alias("shard"))
    sizes = {r["shard"]: r["count"] for r in spread.groupBy("shard").count().collect()}  # as many as centers
    chunks = F.element_at(F.create_map(*[F.lit(y) for s, c in sizes.items() for y in (s, -(-c // MOST_ROWS))]), F.col("shard")) if sizes else F.lit(1)
    mine = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.struct(F.least(j, F.col("mine")).alias("i"), F.greatest(j, F.col("mine")).alias("j")))
    tasks = spread.withColumn("chunks", chunks.cast("int")).withColumn("mine", mine).withColumn("p", F.explode(pairs)).select("rep", "w", "v", "ball", "shards", "shard", "mine", "p.i", "p.j")

    def matrix(pdf: pd.DataFrame) -> np.ndarray:
        return np.frombuffer(b"".join(pdf["v"]), np.float64).reshape(-1, dim)

    def build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")
        reps_ = pdf["rep"].to_numpy()
        graph = build(unit(matrix(pdf)).astype(np.float32), beam=beam)
        return pd.DataFrame({"rep": reps_, "out": [reps_[g[g >= 0]] for g in graph]})

    if exhaustive:
        joined = tasks.withColumn("out", F.array().cast("array<bigint>"))
    else:
        lists = tasks.groupBy("shard", "i", "j").applyInPandas(build_shard, "rep bigint, out array<bigint>")
        joined = tasks.join(lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("out"))).alias("out")), "rep")

    def in_graph(reps_: np.ndarray, x: np.ndarray, out) -> tuple[np.ndarray, np.ndarray]:
        """Places (a, b), a < b, found from the medoid and from each vector itself over the united lists."""
        n = len(x)
        graph = np.full((n, max(1, max(map(len, out)))), -1, np.int32)
        for r, o in enumerate(out):
            at = np.searchsorted(reps_, o)
            at = at[(at < n) & (reps_[np.minimum(at, n - 1)] == o)]
            graph[r, : len(at)] = at
        graph = both_ways(graph)
        medoid = int((x @ x.mean(0)).argmax())
        found = []
        for k in range(0, n, TOGETHER):
            q = np.arange(k, min(n, k + TOGETHER))
            a, b = in_range(x, graph, q, np.stack([np.full(len(q), medoid), q], 1), beam, least - 1e-5)
            found.append((q[a], b))
        a, b = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        both = np.unique(np.minimum(a, b).astype(np.int64) * n + np.maximum(a, b))
        a, b = both // n, both % n
        return a[a != b], b[a != b]

    def search_shard(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep").reset_index(drop=True)
        reps_, exact = pdf["rep"].to_numpy(), unit(matrix(pdf))
        n = len(exact)
        a, b = all_in_range(exact, least) if exhaustive else in_graph(reps_, exact.astype(np.float32), pdf["out"])
        ok = np.einsum("ij,ij->i", exact[a], exact[b]) >= least
        a, b = a[ok], b[ok]
        ball, mine, own = pdf["ball"].to_numpy(), pdf["mine"].to_numpy(), pdf["shards"].tolist()
        if key[1] != key[2]:
            ok = mine[a] != mine[b]  # pairs of one chunk have a task of their own
            a, b = a[ok], b[ok]
        ok = (ball[a] < 0) | (ball[a] != ball[b])
        ok &= np.array([min(set(own[p]) & set(own[q])) == key[0] for p, q in zip(a.tolist(), b.tolist())], bool).reshape(len(a))
        a, b = a[ok], b[ok]
        w = pdf["w"].to_numpy()
        links = np.bincount(a, weights=w[b], minlength=n) + np.bincount(b, weights=w[a], minlength=n)
        node = np.where(ball < 0, reps_, -1 - ball.astype(np.int64))
        labels = local_labels(n, a, b)
        some = np.bincount(labels, minlength=n)[labels] > 1
        ea, eb = tree_edges(labels[some], node[some])
        rows = np.flatnonzero(links)
        return pd.DataFrame(
            {"rep": np.concatenate([reps_[rows], np.full(len(ea), -1)]), "links": np.concatenate([links[rows].astype(np.int64), np.zeros(len(ea), np.int64)]), "a": np.concatenate([np.full(len(rows), -1), ea]), "b": np.concatenate([np.full(len(rows), -1), eb])}
        ).astype("int64")

    found = cut(joined.groupBy("shard", "i", "j").applyInPandas(search_shard, "rep bigint, links bigint, a bigint, b bigint"))
    counted = found.where("links > 0").groupBy("rep").agg(F.sum("links").alias("links"))
    nodes = placed.select("rep", "w", "ball", F.when(F.col("ball") < 0, F.col("rep")).otherwise(-1 - F.col("ball").cast("long")).alias("node"))
    balls = placed.where("ball >= 0").groupBy("ball").agg(F.sum("w").alias("ball_w"))  # leaders at most
    linked = nodes.join(counted, "rep", "left").join(F.broadcast(balls), "ball", "left")
    total = F.col("w") - 1 + F.coalesce("links", F.lit(0)) + F.coalesce(F.col("ball_w") - F.col("w"), F.lit(0))
    return placed, linked.select("rep", "w", "node", total.alias("n_links")), found.where("links = 0").select("a", "b")


def audit(placed: DataFrame, linked: DataFrame, dim: int, least: float, n: int) -> float:
    """Recall by brute force for about AUDIT_ROWS vectors against all: of all their links, or on average of each vector outside of balls if that is less."""
    chosen = placed.where(F.pmod(F.xxhash64("rep", F.lit(7)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, AUDIT_ROWS / max(1, n)))).select("rep", "v").collect()
    if not chosen:
        return 1.0
    ids = np.array([r["rep"] for r in chosen])
    q = unit(np.frombuffer(b"".join(bytes(r["v"]) for r in chosen), np.float64).reshape(-1, dim))

    def run(batches):
        for batch in batches:
            x = unit(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float64).reshape(-1, dim))
            w = batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(((q @ x.T >= least) * w).sum(1))], names=["rep", "real"])

    real = placed.select("v", "w").mapInArrow(run, "rep bigint, real bigint").groupBy("rep").agg((F.sum("real") - 1).alias("real")).where(F.col("real") > 0)
    found = F.least("real", "n_links")
    r = linked.where(F.col("rep").isin(ids.tolist())).join(real, "rep").agg((F.sum(found) / F.sum("real")).alias("all"), F.avg(F.when(F.col("node") >= 0, found / F.col("real"))).alias("each")).first()
    return min(1.0 if x is None else x for x in r)


def of_length(rows: DataFrame, dim: int, least: float, overlap: int, beam: int) -> DataFrame:
    """rows: (id, x), sound vectors of one length. Returns (id, n_links, component_id)."""
    grouped = cut(rows.groupBy("x").agg(F.min("id").alias("rep"), F.count("*").alias("w")))

    def to_binary(batches):
        for batch in batches:
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in flat], pa.binary())], names=["rep", "w", "v"])

    reps = grouped.select("rep", "w", "x").mapInArrow(to_binary, "rep bigint, w bigint, v binary")
    size = grouped.agg(F.count("*").alias("n"), F.sum("w").alias("rows")).first()
    n = size["n"]
    share = int((1 << 20) * min(1.0, max(SAMPLE_ROWS, min(MOST_SAMPLE, 4 * n // SHARD_ROWS)) / n))
    sample = reps.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < share).select("v").collect() or reps.limit(1).select("v").collect()
    sample = unit(np.frombuffer(b"".join(bytes(r["v"]) for r in sample), np.float64).reshape(-1, dim))
    for t in range(TRIES + 1):
        placed, linked, edges = links_of(reps, dim, least, overlap + t, beam << t, sample, n, exhaustive=t == TRIES)
        linked = cut(linked)
        if t == TRIES or audit(placed, linked, dim, least, n) >= LEAST_RECALL:
            break
    of = components(edges)
    named = linked.join(of, "node", "left").select("rep", "n_links", F.coalesce("component", "node").alias("label"))
    smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    known = named.join(smallest, "label").select("rep", "n_links", "component_id")
    by_vector = cut(grouped.join(known, "rep").select("x", "w", "n_links", "component_id"))
    hot = F.col("w") > size["rows"] * HOT_SHARE
    often = F.broadcast(by_vector.where(hot).drop("w"))
    seldom = rows.join(often.select("x"), "x", "left_anti").join(by_vector.where(~hot).drop("w"), "x")
    return rows.join(often, "x").unionByName(seldom).select("id", "n_links", "component_id")


def near_duplicates(vectors: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", overlap: int = 3, beam: int = BEAM) -> DataFrame:
    """Returns (id, n_links, component_id, kept) for each row.

    n_links counts the other rows whose vector has a cosine of at least `least`; component_id is the smallest id
    reachable over links, kept tells whether it is the row's own. Only vectors of one length link. Vectors that are
    null, zero, or hold null or non-finite components have no links and are their own component; so are rows with a null
    id, whose component is null and which are not kept. Rows with equal vectors, repeated rows included, link with one
    another. Other columns are not carried; an empty table gives no rows.
    """
    x = F.col(vector_col).cast("array<double>")
    sound = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(x, lambda v: v != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(sound, x).alias("x"))
    out = rows.where("x is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    for r in rows.where("x is not null").select(F.size("x").alias("d")).distinct().orderBy("d").collect():  # lengths of vectors: few
        out = out.unionByName(of_length(rows.where(F.size("x") == r["d"]), r["d"], least, overlap, beam))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
