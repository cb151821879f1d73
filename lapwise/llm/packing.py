"""Best-fit packing of documents into sequences under several capacities.

Every document becomes token ids with an end token; longer ones are cut. Pieces are dealt at random into groups of a
bounded number, each of which is packed by vector best fit: pieces in order of falling length, each into the
sequence that fits best among all that have room for it in every dimension (tokens, documents, attention cost, the
sum of squared lengths). What fits best is either the smallest weighted norm of what stays free, or the largest
weighted dot product of what the piece needs and what is free. Only the last sequences of a group stay open, so
groups cost a fraction of a percent.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.llm.jobs import prepare, written
from lapwise.llm.texts import slices
from lapwise.llm.tokens import encoder

#: Pieces packed together; bounds the memory and time of a task.
GROUP_PIECES = 16_384


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds, and how much each dimension counts in choosing one; None: as many as tokens allow."""

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"

    def __post_init__(self) -> None:
        if self.tokens < 1 or (self.documents is not None and self.documents < 1):
            raise ValueError("capacities must be positive")
        if self.attention is not None and self.attention < self.tokens**2:
            raise ValueError("the attention capacity must hold one full piece")
        if self.rule not in ("norm", "dot"):
            raise ValueError("rule must be norm or dot")

    @property
    def limits(self) -> np.ndarray:
        documents = self.tokens if self.documents is None else self.documents
        attention = self.tokens**2 if self.attention is None else self.attention
        return np.array([self.tokens, documents, attention], dtype=np.int64)


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, id_column: str = "doc_id", text_column: str = "text", end_id: int = 0, keep_ids: bool = False
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every row: ids of its whole text, then ``end_id``.

    Rows of more than ``capacity`` ids are cut into pieces of that length, of which the first may be shorter.
    ``start`` counts the row's ids before the piece. Null texts are empty: their one piece is the end token.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if keep_ids else "")

    def cut(batches):
        encode = encoder(tokenizer).encode
        for batch, texts in slices(batches, "text"):
            ids, bounds = encode(texts)
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            for r in range(len(texts)):
                own = np.append(ids[bounds[r] : bounds[r + 1]], np.uint32(end_id)).astype("<u4")
                pieces = -(-len(own) // capacity)
                first = len(own) - (pieces - 1) * capacity
                at = 0
                for p in range(pieces):
                    size = first if p == 0 else capacity
                    row.append(r)
                    piece.append(p)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(own[at : at + size].tobytes()))
                    if keep_ids:
                        kept.append(own[at : at + size].astype(np.int64))
                    at += size
            columns = [
                batch.column(0).take(pa.array(row, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(cut, schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: Capacity = Capacity(),
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = 0,
    keep_ids: bool = False,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` (and ``ids``).

    Sequences hold whole pieces one after another from offset 0 and never exceed a capacity. Ids may be null or
    repeat, as every row is packed on its own; other columns are ignored; an empty table gives an empty result.
    """
    pieces = token_pieces(docs, tokenizer, capacity.tokens, id_column, text_column, end_id, keep_ids)
    staged = written(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    n = staged.count()
    groups = max(1, round(n / group_pieces))
    # Dealt by row, so that no id or length gathers in one group.
    dealt = staged.select("uid", "length", F.pmod(F.xxhash64("uid"), F.lit(groups)).alias("grp"))

    def pack_group(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "uid"], ascending=[False, True])
        sequence, offset = best_fit(frame["length"].to_numpy(), capacity)
        return pd.DataFrame(
            {"uid": frame["uid"], "sequence_id": frame["grp"].to_numpy() * (1 << 32) + sequence, "offset": offset}
        )

    placed = dealt.groupBy("grp").applyInPandas(pack_group, "uid long, sequence_id long, offset long")
    return staged.join(placed, "uid").drop("uid").withColumnRenamed("id", id_column)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of pieces in the given order (falling lengths pack best); ties: first opened."""
    limits = capacity.limits
    scale = np.array(capacity.weights) / limits.astype(float) ** 2
    room = np.zeros((max(len(lengths), 1), 3), dtype=np.int64)
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    least = int(lengths.min()) if len(lengths) else 0
    is_open = np.zeros(0, dtype=np.int64)
    opened = 0
    for i, length in enumerate(lengths.tolist()):
        need = np.array([length, 1, length * length], dtype=np.int64)
        chosen = -1
        if len(is_open) and length < capacity.tokens:
            free = room[is_open]
            fits = np.flatnonzero((free >= need).all(axis=1))
            if len(fits):
                if capacity.rule == "norm":
                    rank = ((free[fits] - need).astype(float) ** 2) @ scale
                else:
                    rank = -(free[fits].astype(float) @ (need * scale))
                chosen = int(is_open[fits[np.argmin(rank)]])
        if chosen < 0:
            chosen = opened
            opened += 1
            room[chosen] = limits
            is_open = np.append(is_open, chosen)
        sequence[i] = chosen
        offset[i] = limits[0] - room[chosen, 0]
        room[chosen] -= need
        if room[chosen, 0] < least or room[chosen, 1] < 1 or room[chosen, 2] < least * least:
            is_open = is_open[is_open != chosen]
    return sequence, offset
