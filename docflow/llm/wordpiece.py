"""Token counts by a linear longest-match automaton.

The vocabulary is a trie with failure links. A node knows how many tokens are popped when no edge matches there and
to which node (a prefix of a continuation) the rest leads. So one pass over the bytes of a word counts the tokens of
the greedy longest-match split without building a piece. All distinct words of a slice move through it together.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docflow.llm.bpe import PairTable
from docflow.llm.shared import slices

#: Words kept in a worker's cache before it is emptied.
CACHE_WORDS = 400_000


class Automaton:
    """first: pieces that begin a word; rest: pieces that continue one. A word without a split counts as one unknown token."""

    def __init__(self, first: list[bytes], rest: list[bytes]):
        children: list[dict[int, int]] = [{}, {}]  # 0: root of first, 1: root of rest
        token = [False, False]
        for root, pieces in ((0, first), (1, rest)):
            for p in pieces:
                node = root
                for c in p:
                    if c not in children[node]:
                        children[node][c] = len(children)
                        children.append({})
                        token.append(False)
                    node = children[node][c]
                token[node] = token[node] or bool(p)
        n = len(children)
        fail, pops = np.full(n, -1, np.int32), np.zeros(n, np.int32)
        queue = [(0, 0, 0), (1, 0, 1)]
        for node, _, _ in queue:
            for c, child in children[node].items():
                if token[child]:
                    fail[child], pops[child] = 1, 1
                else:  # as its parent fails, then on by c
                    z, count = int(fail[node]), int(pops[node])
                    while z >= 0 and c not in children[z]:
                        z, count = int(fail[z]), count + int(pops[z])
                    if z >= 0:
                        fail[child], pops[child] = children[z][c], count
                queue.append((child, c, node))
        self.fail, self.pops = fail, pops
        self.edges = PairTable({(a, c): (0, b) for a, x in enumerate(children) for c, b in x.items()})

    def counts(self, words: list[bytes]) -> np.ndarray:
        n = len(words)
        out = np.zeros(n, np.int64)
        order = sorted(range(n), key=lambda i: -len(words[i]))
        sizes = np.array([len(words[i]) for i in order], np.int64)
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if n else sizes
        data = np.frombuffer(b"".join(words[i] for i in order) or b"\0", np.uint8)
        state, count = np.zeros(n, np.int32), np.zeros(n, np.int64)
        alive = np.ones(n, bool)
        width = int(sizes.max()) if n else 0
        still = n
        for t in range(width):
            while still and sizes[still - 1] <= t:  # words stand from the longest to the shortest
                still -= 1
            todo = np.flatnonzero(alive[:still])
            if not len(todo):
                break
            byte = data[begin[todo] + t]
            while len(todo):
                at = self.edges.find(state[todo], byte)
                to = self.edges.merged[at]
                hit = to >= 0
                state[todo[hit]] = to[hit]
                todo, byte = todo[~hit], byte[~hit]
                count[todo] += self.pops[state[todo]]
                state[todo] = self.fail[state[todo]]
                lost = state[todo] < 0
                alive[todo[lost]] = False
                todo, byte = todo[~lost], byte[~lost]
        todo = np.flatnonzero(alive & (sizes > 0))  # the end of the word pops what is left
        todo = todo[state[todo] != 1]
        while len(todo):
            count[todo] += self.pops[state[todo]]
            state[todo] = self.fail[state[todo]]
            lost = state[todo] < 0
            alive[todo[lost]] = False
            todo = todo[~lost & (state[todo] != 1)]
        out[order] = np.where(alive | (sizes == 0), count, 1)
        return out


@functools.cache
def rank_file_automaton(path: str) -> Automaton:
    """From a file of base64 tokens: those with a leading space begin a word, the others continue one."""
    import base64

    with open(path, "rb") as f:
        tokens = [base64.b64decode(x.split()[0]) for x in f if x.strip()]
    return Automaton([t[1:] for t in tokens if t[:1] == b" " and len(t) > 1], [t for t in tokens if t[:1] != b" "])


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns (id, n_words, n_tokens) for each row; words are what stands between ASCII white space.

    A null or empty text counts 0. Texts are read whole, whatever their length. Repeated rows stay repeated, a null id
    stays null, an empty table gives no rows; other columns are not carried. An unknown word counts as one token.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        automaton, cache = rank_file_automaton(path), {}
        for batch in batches:
            for part in slices(batch, "text"):
                split = [(t or "").encode().split() for t in part.column(1).to_pylist()]
                seen = set().union(*split)
                new = [w for w in seen if w not in cache]
                if len(cache) + len(new) > CACHE_WORDS:
                    cache.clear()
                    new = list(seen)
                cache.update(zip(new, automaton.counts(new).tolist()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(len, split), pa.int64()), pa.array([sum(map(cache.__getitem__, words)) for words in split], pa.int64())], names=["id", "n_words", "n_tokens"])

    return df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(run, f"id {kind}, n_words bigint, n_tokens bigint").withColumnRenamed("id", id_col)
