"""Best-fit packing of documents into sequences with several capacities.

Every piece of a document is a vector (tokens, 1 document, tokens squared: its attention cost). Pieces are taken
from the longest to the shortest; each goes to the open sequence with the largest weighted dot product of piece and
residual capacities, or with the smallest weighted norm of what would be left, among those where it fits under
every capacity. Pieces are dealt by a hash into groups of bounded size, each packed on its own.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.bpe import merges_codec
from docflow.llm.shared import slices

#: Documents dealt to a group on average; a group is packed in one task.
GROUP_DOCS = 6_000


def vector_best_fit(lengths: np.ndarray, capacity: int, max_docs: int, max_attention: int, weights=(1.0, 0.001, 0.001), rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece. A piece that alone exceeds a capacity gets a sequence of its own."""
    n = len(lengths)
    sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    limit = np.array([capacity, max_docs, max_attention], float)
    w = np.array(weights, float)
    left = np.empty((n, 3))  # residual capacities of the open sequences
    name = np.empty(n, np.int64)
    filled = np.zeros(n, np.int64)
    opened = kept = 0
    order = np.argsort(-lengths, kind="stable")
    shortest = np.minimum.accumulate(lengths[order][::-1])[::-1] if n else lengths
    for turn, i in enumerate(order.tolist()):
        size = int(lengths[i])
        item = np.array([size, 1, size * size], float)
        best = -1
        if kept and size < capacity:
            fits = np.flatnonzero((left[:kept, 0] >= item[0]) & (left[:kept, 1] >= 1) & (left[:kept, 2] >= item[2]))
            if len(fits):
                rest = left[fits]
                if rule == "dot":
                    best = fits[np.argmax((rest / limit) @ (w * item / limit))]
                else:
                    best = fits[np.argmin(((((rest - item) / limit) ** 2) @ w))]
        if best < 0:
            best, name[kept], left[kept], filled[kept] = kept, opened, limit, 0
            kept, opened = kept + 1, opened + 1
        sequence[i], offset[i] = name[best], filled[best]
        filled[best] += size
        left[best] -= item
        smallest = shortest[turn]
        if left[best, 0] < smallest or left[best, 1] < 1 or left[best, 2] < smallest * smallest:  # nothing more can come in
            kept -= 1
            name[best], left[best], filled[best] = name[kept], left[kept], filled[kept]
    return sequence, offset


def cut_documents(df: DataFrame, path: str, pattern: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of each piece of each document; the ids end with end_id."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        codec, end = merges_codec(path, pattern), end_id.to_bytes(4, "little")
        for batch in batches:
            for part in slices(batch, "text"):
                rows: list[list[int]] = [[], [], [], [], []]
                ids, begins = codec.encode([t or "" for t in part.column(1).to_pylist()])
                packed, places = memoryview(ids.astype("<u4").tobytes()), begins.tolist()
                for k, (begin, stop) in enumerate(zip(places, places[1:])):
                    total = stop - begin + 1  # with the end id
                    first = total % capacity or capacity
                    for piece, start in enumerate([0, *range(first, total, capacity)]):
                        size = capacity if piece else first
                        crc = zlib.crc32(packed[4 * (begin + start) : 4 * min(begin + start + size, stop)])
                        for x, v in zip(rows, (k, piece, start, size, zlib.crc32(end, crc) if start + size == total else crc)):
                            x.append(v)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows[0], pa.int64())), *(pa.array(x, pa.int64()) for x in rows[1:])], names=["id", "piece", "start", "length", "ids_crc32"])

    return df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(run, f"id {kind}, piece bigint, start bigint, length bigint, ids_crc32 bigint").withColumnRenamed("id", id_col)


def pack(
    df: DataFrame, path: str, pattern: str, capacity: int = 1024, end_id: int = 2, max_docs: int | None = None, max_attention: int | None = None,
    weights=(1.0, 0.001, 0.001), rule: str = "norm", group_docs: int = GROUP_DOCS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Returns a row for each piece: id, piece int, start, length, ids_crc32, sequence_id, offset.

    A null text counts as empty and still has its end id. Repeated rows are packed as often as they stand; a null id
    stays null. max_docs and max_attention are no limit by default. An empty table gives no rows. Sequences are
    numbered by group and place in it.
    """
    groups = max(1, -(-df.select(id_col).count() // group_docs))
    pieces = cut_documents(df, path, pattern, capacity, end_id, id_col, text_col)
    kind = df.schema[id_col].dataType.simpleString()
    docs, attention = max_docs or capacity, max_attention or capacity * capacity

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "ids_crc32", id_col, "piece"], kind="stable").reset_index(drop=True)
        sequence, offset = vector_best_fit(pdf["length"].to_numpy(), capacity, docs, attention, weights, rule)
        return pdf.drop(columns="group").assign(sequence_id=(int(key[0]) << 32) + sequence, offset=offset)

    dealt = pieces.withColumn("group", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32", F.spark_partition_id()), F.lit(groups)))
    return (
        dealt.groupBy("group")
        .applyInPandas(run, f"{id_col} {kind}, piece bigint, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
        .withColumn("piece", F.col("piece").cast("int"))
    )
