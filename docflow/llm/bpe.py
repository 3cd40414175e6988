"""Byte-level BPE encoding and decoding on length-bucketed padded numpy matrices.

Each distinct pre-token of a slice of documents is one row of a padded matrix of token ids. In every round each
row merges its leftmost pair of minimum rank; ranks come from a hashed pair table, and finished rows leave the
matrix (compaction). A very long row stands alone in its matrix; its round merges, from left to right, all pairs of
minimum rank of which the next would be the leftmost one anyway. Results are kept in a bounded cache of pre-tokens.
"""

from __future__ import annotations

import base64
import functools
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from docflow.llm.shared import plain_pattern, slices

#: Pre-tokens kept in a worker's cache before it is emptied.
CACHE_PIECES = 200_000
#: Cells of a matrix at most, but for rows that alone have more, and the length of rows that stand alone.
CELLS, LONG_ROW = 1 << 18, 2048
NONE = np.int32(2**31 - 1)
NEVER = np.int64(2**63 - 1)


class PairTable:
    """Open-addressing hash table from a pair of ids to its (rank, merged id)."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, NONE, np.int32)
        self.merged = np.full(1 << bits, -1, np.int32)
        self.score = np.full(1 << bits, NEVER, np.int64)
        if not pairs:
            return
        ab = np.array(list(pairs), np.int64)
        keys, values = ab[:, 0] << 32 | ab[:, 1], np.array(list(pairs.values()), np.int32)
        at, left = self.slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at] == -1
            _, first = np.unique(at[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.keys[at[won]] = keys[left[won]]
            self.rank[at[won]], self.merged[at[won]] = values[left[won], 0], values[left[won], 1]
            rest = np.ones(len(left), bool)
            rest[won] = False
            left, at = left[rest], (at[rest] + 1) & self.mask
        self.score = np.where(self.rank == NONE, NEVER, self.rank.astype(np.int64) << 32 | self.merged.astype(np.int64) & 0xFFFFFFFF)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slots of the pairs; the slot of an absent pair has the rank NONE."""
        keys = a.astype(np.int64) << 32 | b.astype(np.int64) & 0xFFFFFFFF
        at = self.slot(keys)
        seen = self.keys[at]
        left = np.flatnonzero((seen != keys) & (seen != -1))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            seen = self.keys[at[left]]
            left = left[(seen != keys[left]) & (seen != -1)]
        return at


class Numbered(dict):
    """Numbers of pre-tokens; new ones get the next number and are kept in a list."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        self[piece] = n = len(self)
        return n


class Codec:
    """tokens: bytes of each id. pairs: (left id, right id) to (rank, merged id). whole: a pre-token that is a token itself is not split."""

    def __init__(self, tokens: dict[int, bytes], pairs: dict, pattern: str, whole: bool, special: dict[str, int] | None = None):
        self.table, self.pattern, self.special = PairTable(pairs), plain_pattern(pattern), special or {}
        self.byte_id = np.zeros(256, np.int32)
        self.ids = {v: k for k, v in tokens.items()} if whole else {}
        for k, v in tokens.items():
            if len(v) == 1:
                self.byte_id[v[0]] = k
        size = max(tokens) + 1
        self.lens = np.zeros(size + 1, np.int64)  # the last stands for ids that are none
        for k, v in tokens.items():
            self.lens[k] = len(v)
        self.starts = np.concatenate([[0], np.cumsum(self.lens)[:-1]])
        self.buffer = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(size)) or b"\0", np.uint8)
        self.forget()

    def forget(self) -> None:
        self.number, self.held = Numbered(), np.zeros(0, np.int32)
        self.held_start, self.held_len = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each pre-token, and the ids of all in order."""
        data = [p.encode() for p in pieces]
        size = np.fromiter(map(len, data), np.int64, len(data))
        start = np.cumsum(size) - size
        raw = np.frombuffer(b"".join(data) + b"\0", np.uint8)
        counts, found = np.zeros(len(data), np.int64), []
        known = np.fromiter((self.ids.get(p, -1) for p in data), np.int64, len(data)) if self.ids else np.full(len(data), -1)
        if self.special:
            known = np.fromiter((self.special.get(p, k) for p, k in zip(pieces, known.tolist())), np.int64, len(data))
        rows = np.flatnonzero(known >= 0)
        counts[rows] = 1
        found.append((rows, known[rows].astype(np.int32)))
        width = np.where(size <= 12, size, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
        width[(known >= 0) | (size == 0)] = 0
        for w in np.unique(width[(width > 0) & (size <= LONG_ROW)]).tolist():
            rows = np.flatnonzero((width == w) & (size <= LONG_ROW))
            step = max(1, CELLS // w)
            for k in range(0, len(rows), step):
                part = rows[k : k + step]
                tok = self.byte_id[raw[np.minimum(start[part][:, None] + np.arange(w)[None, :], len(raw) - 1)]]
                done, counts[part] = self.rounds(tok, size[part])
                found.append((part, done[np.arange(w)[None, :] < counts[part][:, None]]))
        for i in np.flatnonzero((size > LONG_ROW) & (width > 0)).tolist():
            ids = self.long_row(self.byte_id[raw[start[i] : start[i] + size[i]]])
            counts[i] = len(ids)
            found.append((np.array([i]), ids))
        begin = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int32)
        for part, ids in found:
            n = counts[part]
            out[np.repeat(begin[part] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return counts, out

    def rounds(self, tok: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged rows of a padded matrix of ids and their numbers of ids."""
        n, width = tok.shape
        done, done_size = np.zeros((n, width), np.int32), np.zeros(n, np.int64)
        rows = np.arange(n)
        score = np.full((n, width), NEVER, np.int64)  # rank and merged id of the pair that begins here
        if width > 1:
            at = self.table.find(tok[:, :-1].ravel(), tok[:, 1:].ravel()).reshape(n, width - 1)
            score[:, :-1] = np.where(np.arange(1, width)[None, :] < sizes[:, None], self.table.score[at], NEVER)
        while len(rows):
            every = np.arange(len(rows))
            j = score.argmin(1)
            best = score[every, j]
            going = best != NEVER
            if not going.all():
                over = ~going
                done[rows[over], : tok.shape[1]], done_size[rows[over]] = tok[over], sizes[over]
                rows, tok, score, sizes, j, best = rows[going], tok[going], score[going], sizes[going], j[going], best[going]
                every = every[: len(rows)]
                if not len(rows):
                    break
            width -= 1  # a merge shortens each row by one
            right = np.arange(width)[None, :] > j[:, None]
            tok, score = np.where(right, tok[:, 1:], tok[:, :-1]), np.where(right, score[:, 1:], score[:, :-1])
            sizes = sizes - 1
            tok[every, j] = best & 0xFFFFFFFF
            r = every[j + 1 < sizes]
            a = j[r]
            score[r, a] = self.table.score[self.table.find(tok[r, a], tok[r, a + 1])]
            r = every[j + 1 >= sizes]
            score[r, j[r]] = NEVER
            r = every[j > 0]
            a = j[r] - 1
            score[r, a] = self.table.score[self.table.find(tok[r, a], tok[r, a + 1])]
        return done, done_size

    def long_row(self, tok: np.ndarray) -> np.ndarray:
        """The merges of one row of any length.

        Of the pairs of minimum rank that do not overlap, taken from the left, a round merges all up to the first one
        after which a pair of lower rank would come first.
        """
        scores = lambda a, b: self.table.score[self.table.find(a, b)]
        score = scores(tok[:-1], tok[1:])
        while len(score):
            best = score.min()
            if best == NEVER:
                break
            at = np.flatnonzero(score == best)
            run = np.concatenate([[True], np.diff(at) > 1])
            at = at[(np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))) % 2 == 0]
            merged = np.full(len(at), best & 0xFFFFFFFF, tok.dtype)
            joined = np.concatenate([[False], np.diff(at) == 2])  # what stands on the left was merged just before
            left = np.where(joined, merged, tok[np.maximum(at - 1, 0)])
            sooner = ((at > 0) & (scores(left, merged) < best)) | ((at + 2 < len(tok)) & (scores(merged, tok[np.minimum(at + 2, len(tok) - 1)]) < best))
            if sooner.any():
                at, merged = at[: int(sooner.argmax()) + 1], merged[: int(sooner.argmax()) + 1]
            keep = np.ones(len(tok), bool)
            keep[at + 1] = False
            tok[at] = merged
            at = at - np.arange(len(at))
            tok, score = tok[keep], score[keep[:-1]] if keep[-1] else score[keep[:-1]][:-1]
            for changed in (at[at > 0] - 1, at[at < len(score)]):
                score[changed] = scores(tok[changed], tok[changed + 1])
        return tok

    def split(self, text: str) -> list[str]:
        if self.special and any(s in text for s in self.special):
            parts = re.split("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")", text)
            return [p for x in parts for p in ([x] if x in self.special else self.pattern.findall(x))]
        return self.pattern.findall(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and where each text's begin; the last place is their end."""
        if len(self.number) > CACHE_PIECES:
            self.forget()
        number = self.number.__getitem__
        numbers = []
        for t in texts:
            pieces = self.split(t)
            numbers.append(np.fromiter(map(number, pieces), np.int32, len(pieces)))
        if self.number.new:
            counts, ids = self.encode_pieces(self.number.new)
            self.held_start = np.concatenate([self.held_start, len(self.held) + np.cumsum(counts) - counts])
            self.held_len, self.held = np.concatenate([self.held_len, counts]), np.concatenate([self.held, ids])
            self.number.new = []
        every = np.concatenate([np.zeros(0, np.int32), *numbers])
        size = self.held_len[every]
        ends = np.cumsum(size)
        out = self.held[np.repeat(self.held_start[every] - (ends - size), size) + np.arange(int(size.sum()))]
        return out, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum([len(x) for x in numbers])]).astype(np.int64)]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids, one after the other; ids outside the vocabulary have none."""
        ids = np.where((ids < 0) | (ids >= len(self.lens)), len(self.lens) - 1, ids)
        lens = self.lens[ids]
        begin = np.cumsum(lens) - lens
        return self.buffer[np.arange(int(lens.sum())) + np.repeat(self.starts[ids] - begin, lens)]


@functools.cache
def ranks_codec(path: str, pattern: str) -> Codec:
    """A codec from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
    pairs = {(ids[a], ids[b]): (k, k) for t, k in ids.items() for i in range(1, len(t)) if (a := t[:i]) in ids and (b := t[i:]) in ids}
    return Codec({v: k for k, v in ids.items()}, pairs, pattern, whole=True)


@functools.cache
def merges_codec(path: str, pattern: str) -> Codec:
    """A codec from a tokenizer's JSON with a byte-level vocabulary and a list of merges; its special tokens stand alone in a text."""
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    model, special = whole["model"], {x["content"]: x["id"] for x in whole.get("added_tokens", [])}
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    to_byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
    vocab = model["vocab"]
    tokens = {k: bytes(to_byte[c] for c in t) for t, k in vocab.items() if t not in special}
    tokens |= {k: s.encode() for s, k in special.items()}
    pairs = {}
    for r, m in enumerate(model["merges"]):
        a, b = m.split(" ") if isinstance(m, str) else m
        pairs[vocab[a], vocab[b]] = (r, vocab[a + b])
    return Codec(tokens, pairs, pattern, whole=False, special=special)


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns (id, ids array<int>) for each row; of other columns none is carried, whatever their names.

    A null or empty text has no ids. Repeated rows stay repeated, a null id stays null and an empty table gives no rows. A
    text of any length is encoded whole.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        codec = ranks_codec(path, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, begins = codec.encode([t or "" for t in part.column(1).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["id", "ids"])

    out = df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(run, f"id {kind}, ids array<int>")
    return out.withColumnRenamed("id", id_col)


def decode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Returns (id, ids, decoded binary) for each row. Null ids give no bytes, as do nulls among them and ids outside the vocabulary.

    Repeated rows stay repeated, whatever their length; an empty table gives no rows.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        codec = ranks_codec(path, pattern)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                ids = part.column(1)
                lists = ids.fill_null([]) if ids.null_count else ids
                counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                data = codec.decode(flat)
                size = codec.lens[np.where((flat < 0) | (flat >= len(codec.lens)), len(codec.lens) - 1, flat)]
                ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
                out = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column(0), ids, out], names=["id", "ids", "decoded"])

    out = df.select(df[id_col].alias("id"), df[ids_col].cast("array<int>").alias("ids")).mapInArrow(run, f"id {kind}, ids array<int>, decoded binary")
    return out.withColumnRenamed("id", id_col).withColumnRenamed("ids", ids_col)
