"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import functools
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from docflow.lineage import cut

__all__ = ["char_class", "cut", "letter_runs", "plain_pattern", "slices", "table"]

#: Text handled in one go inside a Python worker, in bytes; bounds its memory.
SLICE_BYTES = 2 << 20

# The characters of the Unicode property White_Space.
WHITE_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Cuts a batch into runs of rows whose texts have about `limit` bytes together; a longer text stands alone.

    Memory of earlier batches that Arrow keeps for later ones goes back first: workers live on from stage to stage.
    """
    pa.default_memory_pool().release_unused()
    texts = batch.column(batch.schema.get_field_index(column))
    sizes = pc.binary_length(texts).fill_null(0).to_pylist()
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > limit:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield batch.slice(begin)


@functools.cache
def char_class(prop: str, last: int) -> str:
    """The characters of a Unicode property, up to a last code point, as ranges for a set of the standard re module."""
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, last + 1)]))
    parts = []
    for m in regex.finditer(rf"\p{{{prop}}}+", every):
        run = m.group()
        begin = 0  # the string skips the surrogates, so a run may bridge them
        for i in range(1, len(run) + 1):
            if i == len(run) or ord(run[i]) != ord(run[i - 1]) + 1:
                parts.append(f"{re.escape(run[begin])}-{re.escape(run[i - 1])}")
                begin = i
    return "".join(parts)


def _translated(pattern: str, last: int) -> re.Pattern:
    inside = pattern.replace(r"[^\s", "[^" + WHITE_SPACE).replace(r"\S", f"[^{WHITE_SPACE}]").replace(r"\s", f"[{WHITE_SPACE}]")
    out, depth, i = [], 0, 0
    while i < len(inside):
        if m := re.match(r"\\p\{(\w+)\}", inside[i:]):
            ranges = char_class(m[1], last)
            out.append(ranges if depth else f"[{ranges}]")
            i += m.end()
        elif inside[i] == "\\":
            out.append(inside[i : i + 2])
            i += 2
        else:
            depth += {"[": 1, "]": -1}.get(inside[i], 0)
            out.append(inside[i])
            i += 1
    return re.compile("".join(out))


class Splitter:
    r"""A pattern with \p{L}, \p{N}, \s and \S run by the faster standard module, with the same meaning as in the regex module.

    The standard module looks a character up in one step only in sets without characters beyond the first plane,
    so texts without such characters get sets of their own.
    """

    def __init__(self, pattern: str):
        self.near, self.far = _translated(pattern, 0xFFFF), _translated(pattern, 0x10FFFF)
        self.beyond = re.compile("[\U00010000-\U0010ffff]").search

    def findall(self, text: str) -> list[str]:
        return (self.far if self.beyond(text) else self.near).findall(text)


@functools.cache
def plain_pattern(pattern: str) -> Splitter:
    return Splitter(pattern)


@functools.cache
def letter_runs() -> Splitter:
    return plain_pattern(r"\p{L}+")
