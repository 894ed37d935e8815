"""Benchmark decontamination: prefix-filtered join of document shingles with item windows.

A window is ``window`` consecutive words of an item (a shorter item is one window). As a set of three-word shingles a
window is contained in a document only if all its shingles are, so the necessary prefix is a single shingle: the
rarest one, by its count in the whole corpus. Documents are joined on those shingles only; the place of the shingle in
the window gives the place where the window would have to start, which has to lie inside the document (length and
positional bound); there the words are compared one by one.

The item index is shipped with the tasks in blocks of at most ``block_windows`` windows. One block is one pass over the
documents; a benchmark of more blocks takes more passes, whose intervals are united per document. So nothing that is
shipped grows without bound, and documents are never shuffled for one block.

NULL texts have no words; NULL item texts no windows; equal item ids are one item; repeated documents give repeated rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsurvey.llm.common import WordHashes, own_columns, raw, release_memory, shingles, slices

_SHINGLE = 3
#: lower-cases A-Z and turns every other ASCII character that is no digit or letter into a blank
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_HITS = "n_words bigint, hit_starts array<int>, hit_ends array<int>, items array<string>"


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def item_windows(benchmark: DataFrame, window: int) -> Iterator[tuple[str, list[bytes]]]:
    """(item, words) of every window, streamed through the driver item by item."""
    for item_id, text in own_columns(benchmark, "item_id", "text").filter("item_id is not null and text is not null").toLocalIterator():
        w = words(text.encode())
        for start in range(max(1, len(w) - window + 1) if w else 0):
            yield str(item_id), w[start : start + window]


def blocks(windows: Iterator[tuple[str, list[bytes]]], most: int) -> Iterator[dict[tuple[bytes, ...], set[str]]]:
    """Distinct windows with their items, at most ``most`` in a block."""
    block: dict[tuple[bytes, ...], set[str]] = {}
    for item, w in windows:
        key = tuple(w)
        if key not in block and len(block) >= most:
            yield block
            block = {}
        block.setdefault(key, set()).add(item)
    if block:
        yield block


def _members(h: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in h whose value is one of the sorted ``wanted``."""
    at = np.searchsorted(wanted, h)
    at[at == len(wanted)] = 0
    return np.flatnonzero(wanted[at] == h)


def shingle_counts(docs: DataFrame, wanted: dict[int, np.ndarray]) -> dict[int, int]:
    """Occurrences of the wanted shingles in the corpus; sums per task, then one small aggregation."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = WordHashes(), defaultdict(int)
        for batch in slices(batches):
            for text in raw(batch.column(0)):
                h = table.of(words(text)) if text else np.empty(0, np.uint64)
                for size, values in wanted.items():
                    if len(h) >= size:
                        s = shingles(h, size)
                        for v in s[_members(s, values)].tolist():
                            total[v] += 1
        table.clear()
        release_memory()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.fromiter(total, np.uint64, len(total)).view(np.int64)), pa.array(list(total.values()), pa.int64())], names=["h", "n"])

    rows = docs.select("text").mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n")).collect()
    return {h % (1 << 64): n for h, n in rows}  # at most one row per shingle of the block


class Index:
    """Rarest shingle -> windows that need it, with the place of the shingle in the window."""

    def __init__(self, block: dict[tuple[bytes, ...], set[str]]):
        self.block, self.table = block, WordHashes()
        self.of_window = {}
        for w in block:
            size = min(_SHINGLE, len(w))
            self.of_window[w] = (size, shingles(self.table.of(w), size))

    def all_shingles(self) -> dict[int, np.ndarray]:
        by = defaultdict(list)
        for size, s in self.of_window.values():
            by[size].append(s)
        return {size: np.unique(np.concatenate(parts)) for size, parts in by.items()}

    def ordered(self, counts: dict[int, int]) -> dict[int, tuple[np.ndarray, dict[int, list]]]:
        """Per shingle size: sorted prefix shingles, and their windows."""
        need: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        for w, (size, s) in self.of_window.items():
            place = min(range(len(s)), key=lambda i: (counts.get(int(s[i]), 0), int(s[i])))
            if counts.get(int(s[place]), 0):  # else the corpus does not hold it
                need[size][int(s[place])].append((place, list(w), sorted(self.block[w])))
        return {size: (np.array(sorted(of), np.uint64), dict(of)) for size, of in need.items()}


def merged(starts: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    """Union of intervals."""
    out_s, out_e = [], []
    for s, e in sorted(zip(starts, ends)):
        if out_e and s <= out_e[-1]:
            out_e[-1] = max(out_e[-1], e)
        else:
            out_s.append(s)
            out_e.append(e)
    return out_s, out_e


def _finder(index: dict[int, tuple[np.ndarray, dict[int, list]]], at: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes()
        for batch in slices(batches):
            sizes, all_s, all_e, all_i = [], [], [], []
            for text in raw(batch.column(at)):
                w = words(text) if text else []
                h, starts, ends, items = table.of(w), [], [], set()
                for size, (wanted, windows) in index.items():
                    if len(w) < size:
                        continue
                    s = shingles(h, size)
                    for p in _members(s, wanted).tolist():
                        for place, window, of in windows[int(s[p])]:
                            start = p - place
                            # length and positional bound, then the words themselves
                            if start >= 0 and start + len(window) <= len(w) and w[start : start + len(window)] == window:
                                starts.append(start)
                                ends.append(start + len(window))
                                items.update(of)
                starts, ends = merged(starts, ends)
                sizes.append(len(w))
                all_s.append(starts)
                all_e.append(ends)
                all_i.append(sorted(items))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes, pa.int64()), pa.array(all_s, pa.list_(pa.int32())),
                 pa.array(all_e, pa.list_(pa.int32())), pa.array(all_i, pa.list_(pa.string()))],
                names=[*batch.schema.names, "n_words", "hit_starts", "hit_ends", "items"])
        table.clear()
        release_memory()

    return find


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = 13, block_windows: int = 200_000) -> DataFrame:
    """All columns of ``docs``, and n_words, hit_starts, hit_ends (word intervals), items (sorted), n_hit, contaminated.

    Columns of ``docs`` with these names are replaced.
    """
    docs = docs.drop("n_words", "hit_starts", "hit_ends", "items", "n_hit", "contaminated")
    # fields are read by place, so that odd names cannot clash
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + [_HITS])
    passes = []
    for block in blocks(item_windows(benchmark, window), block_windows):
        index = Index(block)
        ordered = index.ordered(shingle_counts(docs, index.all_shingles()))
        passes.append(docs.mapInArrow(_finder(ordered, docs.columns.index("text")), schema))
    if not passes:
        passes.append(docs.mapInArrow(_finder({}, docs.columns.index("text")), schema))
    hits = passes[0] if len(passes) == 1 else _united(passes, docs.columns)
    covered = F.aggregate(
        F.zip_with("hit_ends", "hit_starts", lambda e, s: (e - s).cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return hits.withColumn("n_hit", covered).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def _united(passes: list[DataFrame], columns: list[str]) -> DataFrame:
    """Union of the intervals and items that several passes found in the same row; repeated rows stay repeated."""
    out = passes[0].withColumn("__pass", F.lit(0))
    for i, one in enumerate(passes[1:], 1):
        out = out.unionByName(one.withColumn("__pass", F.lit(i)))
    grouped = out.groupBy(*columns, "n_words").agg(
        F.flatten(F.collect_list(F.arrays_zip("hit_starts", "hit_ends"))).alias("__spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.sum((F.col("__pass") == 0).cast("int")).alias("__copies"))
    # sorted intervals, then a fold that extends the last one or opens another
    fold = F.aggregate(
        F.array_sort("__spans"),
        F.array().cast("array<struct<hit_starts:int,hit_ends:int>>"),
        lambda a, x: F.when(
            (F.size(a) > 0) & (x["hit_starts"] <= F.element_at(a, -1)["hit_ends"]),
            F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(
                F.element_at(a, -1)["hit_starts"].alias("hit_starts"),
                F.greatest(F.element_at(a, -1)["hit_ends"], x["hit_ends"]).alias("hit_ends")))))
        .otherwise(F.concat(a, F.array(x))))
    return grouped.withColumn("__spans", fold).withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).select(
        *columns, "n_words", F.col("__spans.hit_starts").alias("hit_starts"), F.col("__spans.hit_ends").alias("hit_ends"), "items")
