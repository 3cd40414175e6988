"""Near-duplicates by SimHash and a binary trie self-join.

A fingerprint has a bit set where more than half of a document's shingle hashes have it. The self-join traverses
pairs of trie nodes together from the root, adds up the bits in which their paths differ, and drops a pair as soon
as the error budget is exceeded. It is spread over tasks by the pigeonhole principle: of b + 1 blocks of bits at
least one is free of b errors, so the tries below each value of each block can be joined apart; their roots
already stand at the end of a path on which no bit differs. Tries that are too large are cut the same way again.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.components import components, local_labels, tree_edges
from docflow.llm.shared import cut, slices

SEED = 42
#: Fingerprints below one root that a task joins at once; larger tries are cut again, this often at most.
TRIE_ROWS, MOST_CUTS = 1024, 4
#: Node pairs that a traversal holds at once; it goes on depth first beyond.
FRONTIER = 2_000_000
#: Documents of which common shingles are counted (expected, and a sixteenth of all at least), common shingles kept, and documents of a bucket that are all paired at once.
SAMPLE_DOCS, COMMON, FEW_DOCS = 8192, 500_000, 16
#: Ids that are broadcast at most (counted first); more are joined by shuffles.
BROADCAST_IDS = 500_000
#: Leaves of two nodes that are compared at once instead of going further down.
FEW = 8


def shingle_hashes(text: str | None, words: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of so many words, A-Z lower-cased; fewer words are one shingle, none give no hash."""
    w = (text or "").encode().lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(w) <= words:
        return np.array([digest(b" ".join(w), seed)], np.uint64)
    whole = b" ".join(w)
    ends = np.cumsum([len(x) + 1 for x in w])
    begins = [0, *ends[:-words].tolist()]
    return np.fromiter((digest(whole[i : j - 1], seed) for i, j in zip(begins, ends[words - 1 :].tolist())), np.uint64, len(w) - words + 1)


def fingerprint(hashes: np.ndarray) -> int:
    if not len(hashes):
        return 0
    bits = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65536):
        bits += np.unpackbits(hashes[k : k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns (id, fingerprint long, its 64 bits) for each row; a text that is null or has no words has 0."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found = np.array([fingerprint(shingle_hashes(t, words)) for t in part.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], names=["id", "fingerprint"])

    return df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(run, f"id {kind}, fingerprint bigint").withColumnRenamed("id", id_col)


def trie_pairs(codes: np.ndarray, roots: np.ndarray, budget: int, labels: np.ndarray | None = None):
    """Yields arrays (i, j) of places in codes, which are sorted below each root, that differ in at most budget bits.

    A node is a range of places. With labels, pairs of nodes whose leaves all have one label are dropped: nothing new.
    """
    n = len(codes)
    edge = np.concatenate([[0], np.flatnonzero(roots[1:] != roots[:-1]) + 1, [n]])
    lo, hi = edge[:-1], edge[1:]
    keep = hi - lo > 1
    lo, hi = lo[keep].astype(np.int32), hi[keep].astype(np.int32)
    turns = None if labels is None else np.concatenate([[0], np.cumsum(labels[1:] != labels[:-1])])
    stack = [(0, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    ones_of: dict[int, np.ndarray] = {}
    while stack:
        depth, al, ah, bl, bh, diff = stack.pop()
        if labels is not None:
            new = ~((turns[ah - 1] == turns[al]) & (turns[bh - 1] == turns[bl]) & (labels[al] == labels[bl]))
            al, ah, bl, bh, diff = al[new], ah[new], bl[new], bh[new], diff[new]
        if len(al) > FRONTIER:
            half = len(al) // 2
            stack += [(depth, al[half:], ah[half:], bl[half:], bh[half:], diff[half:]), (depth, al[:half], ah[:half], bl[:half], bh[:half], diff[:half])]
            continue
        few = ((ah - al).astype(np.int64) * (bh - bl) <= FEW) | (depth == 64)
        if few.any():
            sa, sb = (ah - al)[few].astype(np.int64), (bh - bl)[few].astype(np.int64)
            reps = sa * sb
            k = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
            width = np.repeat(sb, reps)
            i, j = np.repeat(al[few], reps) + k // width, np.repeat(bl[few], reps) + k % width
            near = (i < j) & (np.bitwise_count(codes[i] ^ codes[j]) <= budget)
            if near.any():
                yield i[near], j[near]
            rest = ~few
            al, ah, bl, bh, diff = al[rest], ah[rest], bl[rest], bh[rest], diff[rest]
        if not len(al):
            continue
        if depth not in ones_of:
            ones_of[depth] = np.concatenate([[0], np.cumsum((codes >> np.uint64(63 - depth)) & np.uint64(1), dtype=np.int32)]).astype(np.int32)
        c = ones_of[depth]
        am, bm = ah - (c[ah] - c[al]), bh - (c[bh] - c[bl])
        same = al == bl  # nodes of one depth are equal or disjoint
        parts = []
        for x0, x1, y0, y1, more, use in ((al, am, bl, bm, 0, None), (am, ah, bm, bh, 0, None), (al, am, bm, bh, 1, None), (am, ah, bl, bm, 1, ~same)):
            ok = (x1 > x0) & (y1 > y0) & (diff + more <= budget)
            if use is not None:
                ok &= use
            ok &= ~((x0 == y0) & (x1 - x0 < 2))
            parts.append((x0[ok], x1[ok], y0[ok], y1[ok], diff[ok] + np.int8(more)))
        stack.append((depth + 1, *(np.concatenate(x) for x in zip(*parts))))


def linked(codes: np.ndarray, roots: np.ndarray, budget: int) -> np.ndarray:
    """Label of each place: places of one root that are linked, directly or over others, have one label."""
    labels = np.arange(len(codes))
    for b in sorted({min(1, budget), budget}):  # close ones first: large dense groups are then one label early
        known = labels
        for i, j in trie_pairs(codes, roots, b, known):
            labels = local_labels(len(codes), i, j, labels)
    return labels


def masks(bits: list[int], budget: int, blocks: int) -> list[list[int]]:
    """Bits of each choice of blocks of which at least one choice is free of budget errors."""
    ends = [round(k * len(bits) / blocks) for k in range(blocks + 1)]
    return [sorted(x for k in choice for x in bits[ends[k] : ends[k + 1]]) for choice in combinations(range(blocks), blocks - budget)]


def _as_long(bits: list[int]) -> int:
    x = sum(1 << b for b in bits)
    return x - (1 << 64) if x >> 63 else x


def join_tries(codes: DataFrame, budget: int, task, schema: str, trie_rows: int = TRIE_ROWS) -> DataFrame:
    """codes: (node long, fingerprint long, path string: tries of different paths are joined apart). Calls task on sorted parts.

    task: (codes, nodes, roots) of whole tries, sorted by root and code, to a record batch of the schema.
    """
    n = codes.count()
    blocks = budget + 1 + (n > 1 << 22) + (n > 1 << 28)  # finer roots for more fingerprints

    def rooted(df: DataFrame, bits: list[int], used: list[int], parts: int) -> DataFrame:
        choice = [F.struct(F.concat("path", F.lit(f".{k}")).alias("path"), F.col("fingerprint").bitwiseAND(F.lit(_as_long(used + m))).alias("root")) for k, m in enumerate(masks(bits, budget, parts))]
        return df.select("node", "fingerprint", F.explode(F.array(*choice)).alias("x")).select("node", "fingerprint", "x.path", "x.root")

    every = list(range(64))
    todo = rooted(codes, every, [], blocks)
    layout = {f".{k}": m for k, m in enumerate(masks(every, budget, blocks))}  # by what follows the first part of a path
    ready = []
    for turn in range(MOST_CUTS + 1):
        todo = cut(todo)
        large = cut(todo.groupBy("path", "root").count().where(F.col("count") > trie_rows)) if turn < MOST_CUTS else None
        if large is None or large.isEmpty():
            ready.append(todo)
            break
        keys = large.select("path", "root")
        ready.append(todo.join(keys, ["path", "root"], "left_anti"))
        inside = todo.join(keys, ["path", "root"], "left_semi")
        ends = {r["end"] for r in keys.select(F.regexp_extract("path", r"(\..*)$", 1).alias("end")).distinct().collect()}  # the choices of blocks so far at most
        todo = None
        for end in sorted(ends):
            used = layout[end]
            bits = [b for b in every if b not in used]
            layout |= {f"{end}.{k}": used + m for k, m in enumerate(masks(bits, budget, budget + 1))}
            x = rooted(inside.where(F.regexp_extract("path", r"(\..*)$", 1) == end), bits, used, budget + 1)
            todo = x if todo is None else todo.union(x)
    whole = ready[0]
    for x in ready[1:]:
        whole = whole.unionByName(x)

    def work(t: pa.Table) -> pa.RecordBatch:
        found = t["fingerprint"].to_numpy().view(np.uint64)
        nodes, root = t["node"].to_numpy(), t["root"].to_numpy()
        path = t["path"].combine_chunks().dictionary_encode().indices.to_numpy()
        order = np.lexsort((nodes, found, root, path))
        found, nodes, root, path = found[order], nodes[order], root[order], path[order]
        return task(found, nodes, np.cumsum(np.concatenate([[True], (root[1:] != root[:-1]) | (path[1:] != path[:-1])])))

    def join(batches):
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 50_000:  # all tries but the last are complete: rows stand in the order of their roots
                t = pa.Table.from_batches(held).combine_chunks()
                path, root = t["path"], t["root"].to_numpy()
                last, at = path[len(path) - 1].as_py(), len(root)
                while at and root[at - 1] == root[-1] and path[at - 1].as_py() == last:
                    at -= 1
                if at:
                    yield work(t.slice(0, at))
                held = t.slice(at).to_batches()
                rows = len(root) - at
        if rows:
            yield work(pa.Table.from_batches(held))

    parts = max(1, int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return whole.repartition(parts, "path", "root").sortWithinPartitions("path", "root").mapInArrow(join, schema)


def links(reps: DataFrame, budget: int = 4, trie_rows: int = TRIE_ROWS) -> DataFrame:
    """reps: (node long, fingerprint long), fingerprints distinct. Returns edges (a, b) that span each group of linked nodes.

    Nodes of one component of an edge table are exactly those reachable from one another over pairs that differ in at
    most budget bits; edges need not be such pairs themselves.
    """

    def task(codes, nodes, roots):
        labels = linked(codes, roots, budget)
        some = np.bincount(labels, minlength=len(labels))[labels] > 1
        a, b = tree_edges(labels[some], nodes[some])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return join_tries(reps.select("node", "fingerprint", F.lit("").alias("path")), budget, task, "a bigint, b bigint", trie_rows)


def groups(df: DataFrame, words: int = 4, budget: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns (id, fingerprint long, component_id) for each row: component_id is the smallest id reachable over fingerprints that differ in at most budget bits.

    The id must be a whole number. Texts that are null, empty or without words have the fingerprint 0, linked like any
    other. Rows with a null id get the component of their fingerprint (null if none of it has an id). Repeated rows
    stay repeated; other columns are not carried; an empty table gives no rows.
    """
    found = cut(fingerprints(df, words, id_col, text_col))
    reps = cut(found.groupBy("fingerprint").agg(F.min(id_col).cast("long").alias("node")))
    named = reps.where("node is not null")
    of = components(links(named, budget))
    known = reps.join(of, "node", "left").select("fingerprint", F.coalesce("component", "node").alias("component_id"))
    return found.join(known, "fingerprint").select(id_col, "fingerprint", "component_id")


def prefix_length(n: int, similarity: float) -> int:
    """So many smallest shingles of n, in any order common to all documents, hold one of each set with that similarity."""
    return n - math.ceil(similarity * n - 1e-9) + 1


def prefix(hashes: np.ndarray, similarity: float, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of a sorted set: rare ones by hash, then common ones (sorted hashes) by their rank."""
    n = len(hashes)
    if not n:
        return hashes
    key = hashes >> np.uint64(1)
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        key = np.where(common[at] == hashes, np.uint64(1 << 63) + rank[at], key)
    return hashes[np.argsort(key, kind="stable")[: prefix_length(n, similarity)]]


def to_bytes(hashes: np.ndarray) -> bytes:
    """A set of hashes as the 48 lower bits of each: two texts of 20,000 words share one by chance in one of 10^5 cases."""
    return np.unique(hashes & np.uint64((1 << 48) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def from_bytes(data) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def common_shingles(texts: DataFrame, words: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, rank from rare to common) of shingles that several documents of a sample hold; which they are decides on speed only."""
    share = min(1.0, max(SAMPLE_DOCS, n // 16) / max(1, n))

    def count(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [np.unique(shingle_hashes(t, words)) for t in part.column(1).to_pylist()]
                found, times = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times)], names=["h", "c"])

    sample = texts.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int((1 << 20) * share))
    counts = sample.mapInArrow(count, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= 3)
    found = counts.orderBy(F.desc("c"), "h").limit(COMMON).toArrow()
    h = found["h"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], (len(h) - 1 - order).astype(np.uint64)


def star_pairs(node, size, place, label, reach: float):
    """Places (i, j) of one bucket: all pairs of a small one; of a larger one each document and the one with the fewest rarer shingles, in each class of sizes."""
    if len(node) <= FEW_DOCS:
        i, j = np.triu_indices(len(node), 1)
    else:
        kind = np.floor(np.log(size) / np.log(1.25)).astype(int)
        order = np.lexsort((node, place, kind))
        first = order[np.concatenate([[True], kind[order][1:] != kind[order][:-1]])]
        i, j = np.repeat(first, len(node)), np.tile(np.arange(len(node)), len(first))
    return i, j


def cross_pairs(node, size, place, label, reach: float):
    """Places (i, j) of one bucket: all pairs of different labels."""
    names, inverse, times = np.unique(label, return_inverse=True, return_counts=True)
    main = inverse == times.argmax()
    every, ends = np.arange(len(node)), [(np.zeros(0, int), np.zeros(0, int))]
    if len(node) <= FEW_DOCS:
        return ends[0]  # star_pairs gave them all
    for i in np.flatnonzero(~main).tolist():
        j = every[(main | (every > i)) & (label != label[i])]
        j = j[np.minimum(size[i] - place[i], size[j] - place[j]) >= reach * (size[i] + size[j])]
        ends.append((np.full(len(j), i), j))
    return tuple(np.concatenate(x) for x in zip(*ends))


def bucket_pairs(shared: DataFrame, pairs, similarity: float) -> DataFrame:
    """shared: (token, node, size, place, label). Returns distinct (a, b), a < b, that pairs() chooses below each token.

    If a token is the first one that two prefixes share, nothing before it is shared and what follows bounds the overlap.
    """
    reach = similarity / (1 + similarity) - 1e-9

    def work(t: pa.Table):
        token, node, size, place, label = (t[c].to_numpy() for c in ("token", "node", "size", "place", "label"))
        edge = np.concatenate([[0], np.flatnonzero(token[1:] != token[:-1]) + 1, [len(token)]])
        found, held = [], 0
        for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
            i, j = pairs(node[lo:hi], size[lo:hi], place[lo:hi], label[lo:hi], reach)
            i, j = i + lo, j + lo
            ok = (node[i] != node[j]) & (np.minimum(size[i] - place[i], size[j] - place[j]) >= reach * (size[i] + size[j]))
            i, j = node[i[ok]], node[j[ok]]
            found.append(np.stack([np.minimum(i, j), np.maximum(i, j)], 1))
            held += len(i)
            if held > 500_000:
                yield np.unique(np.concatenate(found), axis=0)
                found, held = [], 0
        if held:
            yield np.unique(np.concatenate(found), axis=0)

    def run(batches):
        for t in whole_runs(batches):
            for x in work(t):
                yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], names=["a", "b"])

    parts = max(1, int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return shared.repartition(parts, "token").sortWithinPartitions("token").mapInArrow(run, "a bigint, b bigint").distinct()


def whole_runs(batches):
    """Tables of rows sorted by token, with all rows of each token in one table."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= 50_000:
            t = pa.Table.from_batches(held).combine_chunks()
            token = t["token"].to_numpy()
            at = int(np.searchsorted(token, token[-1]))
            if at:
                yield t.slice(0, at)
            held, rows = t.slice(at).to_batches(), len(token) - at
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def shared_tokens(tokens: DataFrame) -> DataFrame:
    """The rows of tokens (token, node, size, place) whose token stands with another node."""

    def run(batches):
        for t in whole_runs(batches):
            token = t["token"].to_numpy()
            same = np.concatenate([[False], token[1:] == token[:-1], [False]])
            yield from t.filter(pa.array(same[1:] | same[:-1])).combine_chunks().to_batches()

    parts = max(1, int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return tokens.repartition(parts, "token").sortWithinPartitions("token").mapInArrow(run, "token bigint, node bigint, size int, place int")


def similar_groups(df: DataFrame, words: int = 5, similarity: float = 0.8, budget: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns (id, component_id) for each row with an id: the smallest id reachable over documents whose sets of word shingles have a Jaccard similarity of at least `similarity`.

    The trie self-join of the documents' fingerprints gives the first pairs. What fingerprints miss is found by a prefix
    filter: in an order common to all documents, rare shingles first, two sets that are so similar share one of their
    first shingles. Documents of one such shingle are a bucket. First each document of a large bucket meets the one with
    the fewest rarer shingles; then all pairs that are not yet in one group and whose sizes and places allow it are
    verified, so no pair that could join two groups is left out. Pairs are verified on the whole texts (sets of 48 bits of
    the shingle hashes).
    Equal sets of shingles are one group: null, empty and blank texts too. Ids must be whole numbers; rows that repeat
    an id are repeated.
    """
    picked = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    common, rank = common_shingles(picked, words, picked.count())
    sc = df.sparkSession.sparkContext
    known = sc.broadcast((common, rank))

    def scan(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                hashes = [shingle_hashes(t, words) for t in part.column(1).to_pylist()]
                codes, sets = np.array([fingerprint(h) for h in hashes], np.uint64), [np.unique(h) for h in hashes]
                whole = [xxhash.xxh3_128_hexdigest(x.tobytes()) for x in sets]
                firsts = [prefix(x, similarity, *known.value) for x in sets]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in firsts])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(firsts).view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(whole), pa.array(codes.view(np.int64)), lists, pa.array([len(x) for x in sets], pa.int32())], names=["id", "whole", "fingerprint", "tokens", "size"])

    rows = cut(picked.mapInArrow(scan, "id bigint, whole string, fingerprint bigint, tokens array<bigint>, size int"))
    known.unpersist()
    named = cut(rows.groupBy("whole").agg(F.min("id").alias("node"), F.min_by("fingerprint", "id").alias("fingerprint")))
    reps = cut(named.groupBy("fingerprint").agg(F.min("node").alias("node")))
    same = named.join(reps.select("fingerprint", F.col("node").alias("a")), "fingerprint").where("a <> node").select("a", F.col("node").alias("b"))
    alike = links(reps, budget).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).union(same)
    copies = cut(rows.select("whole", "id").join(named, "whole").where("id <> node").select("whole", "id").distinct())
    tokens = rows.join(F.broadcast(copies) if copies.count() <= BROADCAST_IDS else copies, ["whole", "id"], "left_anti").select("id", "size", F.posexplode("tokens").alias("place", "token"))
    shared = cut(shared_tokens(tokens.select("token", F.col("id").alias("node"), "size", "place")))

    def shingles(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [to_bytes(shingle_hashes(t, words)) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["id", "set"])

    def verify(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                both = np.concatenate([from_bytes(x.as_buffer()), from_bytes(y.as_buffer())])
                both.sort(kind="stable")
                overlap = int((both[1:] == both[:-1]).sum())
                keep.append(overlap >= similarity * (len(both) - overlap))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def verified(edges: DataFrame) -> DataFrame:
        wanted = cut(edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct())
        some = picked.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, "id")
        sets = some.mapInArrow(shingles, "id bigint, set binary").groupBy("id").agg(F.min("set").alias("set"))
        left = sets.select(F.col("id").alias("a"), F.col("set").alias("x"))
        right = sets.select(F.col("id").alias("b"), F.col("set").alias("y"))
        return cut(edges.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(verify, "a bigint, b bigint"))

    first = cut(bucket_pairs(shared.withColumn("label", F.col("node")), star_pairs, similarity).union(alike).distinct())
    sure = verified(first)
    of = components(sure)
    labelled = shared.join(of, "node", "left").select("token", "node", "size", "place", F.coalesce("component", "node").alias("label"))
    more = cut(bucket_pairs(labelled, cross_pairs, similarity).join(first, ["a", "b"], "left_anti"))
    if not more.isEmpty():
        of = components(sure.unionByName(verified(more)))
    found = named.join(of, "node", "left").select("whole", F.coalesce("component", "node").alias("component_id"))
    return rows.select("id", "whole").join(found, "whole").select(F.col("id").alias(id_col), "component_id")


def first_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of df without near-duplicates: of each group the row with the smallest id stays.

    Rows that repeat an id are one; rows with a null id stay, as nothing tells them apart. Null, empty and blank texts are
    one group. Texts are compared whole, whatever their length. An empty table stays empty; all columns are kept.
    """
    found = cut(similar_groups(df, id_col=id_col, text_col=text_col, **how))
    drop = cut(found.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct())
    kept = df.join(F.broadcast(drop) if drop.count() <= BROADCAST_IDS else drop, id_col, "left_anti")
    if found.count() == found.select(id_col).distinct().count():
        return kept.select(df.columns)
    named = kept.where(F.col(id_col).isNotNull()).dropDuplicates([id_col])
    return named.unionByName(kept.where(F.col(id_col).isNull())).select(df.columns)
