"""Vector best-fit packing of documents into training sequences.

A document is its token ids and an end id. Longer ones than a sequence are cut, the first piece taking the remainder. A
sequence has three capacities: tokens, pieces and attention cost (sum of squared lengths). Pieces are placed by
decreasing length; of the bins that have room in every dimension the one with the smallest weighted norm of what
would remain is taken (or the largest weighted dot product of piece and room).

Pieces are dealt by hash to groups of about ``group_pieces``, which are packed side by side; a group leaves about one
sequence partly filled, so the loss is one in some thousand. Token ids never leave the task that made them: only lengths and check sums
are moved. NULL text is an empty document (the end id alone); repeated rows are packed each.
"""

from __future__ import annotations

import base64
import json
import math
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsurvey.llm.common import own_columns, release_memory, slices
from cellsurvey.session import durable

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_PLACED = _PIECES + ", sequence_id bigint, offset bigint"


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of whole texts, as bytes of little-endian 32-bit numbers.

    The vocabulary is that of the ``tokenizers`` file; its rank table gives the same ids several times faster (tests
    compare the two). Texts of over ``longest`` characters go through ``tokenizers`` itself, whose matcher has no limit
    on runs of white space.
    """

    def __init__(self, file: str, ranks_file: str, longest: int = 1_000_000):
        import public_tokenizers
        import tiktoken

        with open(file, encoding="utf-8") as description:
            special = {t["content"]: t["id"] for t in json.load(description)["added_tokens"]}
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.file, self.longest = file, longest

    def slow(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.file)  # kept by nobody: it is large and hardly ever needed

    def __call__(self, text: str) -> bytes:
        if len(text) > self.longest:
            ids = self.slow().encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode(text, allowed_special="all")
        return np.array(ids, "<u4").tobytes()


_ENCODERS: dict[str, Encoder] = {}  # of this worker, kept between tasks


def _piecer(tokenizer: str | None, size: int, end_id: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        release_memory()
        file = tokenizer or tokenizer_file()
        encode = _ENCODERS.get(file) or _ENCODERS.setdefault(file, Encoder(file, file.removesuffix(".json") + ".tiktoken"))
        end = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches):
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                n = len(ids) // 4
                bounds = [0, *range(n % size or size, n + 1, size)]
                out += [(doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return cut


def pieces(docs: DataFrame, size: int = 2048, end_id: int = 0, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), a narrow step. 

    ``tokenizer``: a file every executor has, its rank table beside it."""
    return own_columns(docs, "doc_id", "text").mapInArrow(_piecer(tokenizer, size, end_id), _PIECES)


def best_fit(lengths: np.ndarray, size: int, most_pieces: int, most_cost: float,
             weights: tuple[float, float, float] = (1.0, 0.05, 0.05), rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece. Capacities are scaled to 1; full bins leave the search."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    w = np.array(weights)
    shortest = lengths.min(initial=size)
    room = np.empty((256, 3))  # of open bins: tokens, pieces, cost, as fractions
    ids, used, n_open, n_bins = np.empty(256, np.int64), np.empty(256, np.int64), 0, 0
    for i in order:
        length = int(lengths[i])
        need = np.array([length / size, 1 / most_pieces, length * length / most_cost])
        best = -1
        if n_open:
            left = room[:n_open] - need
            fits = (left > -1e-9).all(axis=1)
            if fits.any():
                value = ((left * w) ** 2).sum(axis=1) if rule == "norm" else -(room[:n_open] * need * w).sum(axis=1)
                best = int(np.argmin(np.where(fits, value, np.inf)))
        if best < 0:
            if n_open == len(ids):
                room, ids, used = np.vstack([room, np.empty_like(room)]), np.concatenate([ids, ids]), np.concatenate([used, used])
            best = n_open
            room[best], ids[best], used[best] = 1.0, n_bins, 0
            n_open, n_bins = n_open + 1, n_bins + 1
        bins[i], offsets[i] = ids[best], used[best]
        room[best] -= need
        used[best] += length
        if used[best] + shortest > size or room[best, 1] < 0.5 / most_pieces:
            n_open -= 1
            room[best], ids[best], used[best] = room[n_open], ids[n_open], used[n_open]
    return bins, offsets


def pack(docs: DataFrame, size: int = 2048, most_pieces: int | None = None, most_cost: float | None = None, end_id: int = 0,
         tokenizer: str | None = None, group_pieces: int = 16_384) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all pieces.

    Every capacity must admit one full piece: ``most_cost`` is ``size ** 2`` unless given and not below it. ``most_pieces`` is ``size``
    unless given, which no sequence can exceed. Groups are dealt by place in the written table, so equal rows spread over all of them.
    """
    most_pieces = size if most_pieces is None else most_pieces
    most_cost = float(most_cost or size * size)
    if most_cost < size * size or most_pieces < 1:
        raise ValueError("a capacity does not admit one full piece")
    cut = durable(pieces(docs, size, end_id, tokenizer))
    groups = max(1, math.ceil(cut.count() / group_pieces))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "start", "ids_crc32"], kind="stable", ignore_index=True)
        bins, offsets = best_fit(rows["length"].to_numpy(), size, most_pieces, most_cost)
        rows["sequence_id"], rows["offset"] = rows.pop("__group") * (1 << 32) + bins, offsets
        return rows

    return (
        cut.withColumn("__group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))
        .groupBy("__group").applyInPandas(place, _PLACED))
