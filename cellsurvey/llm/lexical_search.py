"""Ranked lexical search: an inverted index in shards, searched by Block-Max MaxScore.

A shard holds some thousand documents; its lists are cut into blocks of postings, stored as variable-length integers. Beside every
block lie its last document and the pairs (occurrences, document length) that no other posting of the block beats, from which the
largest score of the block follows exactly once the statistics of the whole corpus are known. So shards are built in one pass over
the texts, no posting is ever exchanged, and new documents only add shards.

A search joins the terms of the queries to the index. In a shard the lists of a query are ordered by their bounds: lists whose
bounds together cannot lift a document above the current k-th score are not essential and add no candidates. For candidates of the
essential lists the block maxima of the other lists are added first; only blocks that may still matter are unpacked. The k best of
every shard are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellsurvey.llm.common import own_columns, raw, slices
from cellsurvey.session import durable

#: a term's bytes: digits, letters (A-Z lower-cased), everything beyond ASCII; the rest separates
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_INDEX = ("shard bigint, term string, df int, last array<int>, size array<int>, n_best array<int>, best_tf array<int>, best_len array<int>, "
          "postings binary, doc_ids array<bigint>, doc_lens array<int>")
_POSTINGS = "shard bigint, part int, term string, weight bigint, uses array<struct<query:bigint,times:bigint>>, " + _INDEX.split(", ", 3)[3]
_SCALE, _LENGTH_SHARE = 1_000_000_000, 25


# ------------------------------------------------------------------------------------------------ variable-length integers

def pack_ints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of non-negative integers, 7 bits each, the last byte of a value below 128; and the number of bytes of each."""
    width = np.ones(len(values), np.int64)
    for bits in range(7, 63, 7):
        width += values >= (1 << bits)
    ends = np.cumsum(width)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(width.max(initial=0))):
        has = width > k
        byte = (values[has] >> (7 * k)) & 127
        out[ends[has] - width[has] + k] = byte | np.where(width[has] > k + 1, 128, 0)
    return out, width


def unpack_ints(data: np.ndarray) -> np.ndarray:
    """The inverse of ``pack_ints``."""
    last = data < 128
    ends = np.flatnonzero(last)
    if len(ends) == len(data):
        return data.astype(np.int64)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts)


# ------------------------------------------------------------------------------------------------ index

def _tokens(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """Number of the text and the term of every token."""
    data = np.frombuffer((b" ".join(texts) + b" ").translate(_TERM_BYTES), np.uint8)
    inside = data != 32
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edge[::2], edge[1::2]  # the last byte is a separator, so every start has its end
    first = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
    doc = np.searchsorted(first, starts, "right") - 1
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    return doc, pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.int32)))


def build_shard(shard: int, ids: list[int | None], texts: list[bytes], block: int) -> pa.RecordBatch:
    """Index rows of one shard, and one row without a term that holds its documents; documents are numbered by ascending id."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i]))
    ids, texts = [ids[i] for i in order], [texts[i] for i in order]
    doc, tokens = _tokens(texts)
    lengths = np.bincount(doc, minlength=len(ids))
    coded = tokens.dictionary_encode()
    terms = coded.dictionary
    ranked = pc.sort_indices(terms).to_numpy()
    place = np.empty(len(terms), np.int64)
    place[ranked] = np.arange(len(terms))
    keys = place[coded.indices.to_numpy()] * len(ids) + doc
    keys.sort()
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    tf = np.diff(np.append(new, len(keys)))
    term, doc = np.divmod(keys[new], max(len(ids), 1))
    del keys, tokens, coded

    n = len(term)
    list_starts = np.flatnonzero(np.diff(term, prepend=-1))
    df = np.diff(np.append(list_starts, n))
    inside = np.arange(n) - np.repeat(list_starts, df)
    starts = inside % block == 0
    block_starts = np.flatnonzero(starts)
    block_of = np.cumsum(starts) - 1
    gap = np.diff(doc, prepend=0)
    gap[list_starts] = doc[list_starts]  # the first posting of a list counts from 0, of a later block from the block before
    packed, width = pack_ints(np.stack([gap, tf], axis=1).ravel())
    posting_bytes = width[::2] + width[1::2]
    block_bytes = np.add.reduceat(posting_bytes, block_starts) if n else posting_bytes
    list_bytes = np.concatenate([[0], np.cumsum(np.add.reduceat(posting_bytes, list_starts) if n else posting_bytes)]).astype(np.int32)

    # of every block the postings that no other has both more occurrences and a shorter document than
    length = lengths[doc]
    by = np.lexsort((length, -tf, block_of))
    falling = length[by] + (len(block_starts) - block_of[by]) * (1 << 40)
    best = by[np.diff(np.minimum.accumulate(falling), prepend=1 << 62) < 0] if n else by
    n_best = np.bincount(block_of[best], minlength=len(block_starts))
    blocks_before = np.append(block_of[list_starts], len(block_starts)) if n else np.zeros(1, np.int64)
    best_before = np.concatenate([[0], np.cumsum(n_best)])[blocks_before]
    last = doc[np.append(block_starts[1:], n) - 1] if n else doc

    columns = [
        pa.array(np.full(len(terms), shard)), terms.take(pa.array(ranked)).cast(pa.binary()).cast(pa.string()), pa.array(df.astype(np.int32)),
        _lists(blocks_before, last), _lists(blocks_before, block_bytes), _lists(blocks_before, n_best), _lists(best_before, tf[best]), _lists(best_before, length[best]),
        pa.BinaryArray.from_buffers(pa.binary(), len(terms), [None, pa.py_buffer(list_bytes), pa.py_buffer(packed)]),
        pa.nulls(len(terms), pa.list_(pa.int64())), pa.nulls(len(terms), pa.list_(pa.int32())),
    ]
    names = [c.split()[0] for c in _INDEX.split(", ")]
    schema = pa.schema([(name, c.type) for name, c in zip(names, columns)])
    documents = pa.RecordBatch.from_pylist([{"shard": shard, "doc_ids": ids, "doc_lens": lengths.tolist()}], schema=schema)
    return [documents, pa.RecordBatch.from_arrays(columns, schema=schema)]


def _indexer(shard_docs: int, shard_bytes: int, block: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, shard = [], [], 0, TaskContext.get().partitionId() << 24
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), raw(batch.column(1))):
                if ids and (len(ids) >= shard_docs or size + len(text or b"") > shard_bytes):
                    yield from build_shard(shard, ids, texts, block)
                    ids, texts, size, shard = [], [], 0, shard + 1
                ids.append(doc_id)
                texts.append(text or b"")
                size += len(texts[-1])
        if ids:
            yield from build_shard(shard, ids, texts, block)

    return index


def build_index(docs: DataFrame, shard_docs: int = 16_384, shard_bytes: int = 16 << 20, block: int = 64) -> DataFrame:
    """The index of ``docs`` (doc_id, text), a row per shard and term, written to the shared folder; a narrow step.

    Texts are indexed whole; NULL and empty ones are documents without terms. A text longer than ``shard_bytes`` is a shard of its own.
    """
    return durable(own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_indexer(shard_docs, shard_bytes, block), _INDEX))


# ------------------------------------------------------------------------------------------------ search

class PostingList:
    """One list of a shard; ``impacts`` are scores without the weight of the term."""

    def __init__(self, row, impact):
        self.last, sizes = np.asarray(row.last), np.asarray(row.size)
        self.data = np.frombuffer(row.postings, np.uint8)
        self.ends = np.cumsum(sizes)
        counts = np.asarray(row.n_best)
        self.block_max = np.maximum.reduceat(impact(np.asarray(row.best_tf, np.int64), np.asarray(row.best_len, np.int64)), np.cumsum(counts) - counts)
        self.bound = int(self.block_max.max())
        self._impact, self._blocks = impact, {}

    def block(self, b: int, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block, unpacked when it is first needed."""
        found = self._blocks.get(b)
        if found is None:
            values = unpack_ints(self.data[self.ends[b - 1] if b else 0 : self.ends[b]]).reshape(-1, 2)
            docs = np.cumsum(values[:, 0]) + (self.last[b - 1] if b else 0)
            found = self._blocks[b] = docs, self._impact(values[:, 1], lengths[docs])
        return found

    def maxima(self, docs: np.ndarray) -> np.ndarray:
        """The largest impact that the block around each document allows."""
        b = np.searchsorted(self.last, docs)
        return np.where(b < len(self.last), self.block_max[np.minimum(b, len(self.last) - 1)], 0)

    def at(self, docs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Impacts at ascending documents; only the blocks around them are unpacked."""
        out = np.zeros(len(docs), np.int64)
        where = np.searchsorted(self.last, docs)
        for b in np.unique(where[where < len(self.last)]).tolist():
            mine = slice(*np.searchsorted(where, [b, b + 1]))
            found, impacts = self.block(b, lengths)
            place = np.minimum(np.searchsorted(found, docs[mine]), len(found) - 1)
            out[mine] = np.where(found[place] == docs[mine], impacts[place], 0)
        return out

    def between(self, low: int, high: int, lengths: np.ndarray):
        """Blocks with documents from ``low`` to below ``high``."""
        for b in range(int(np.searchsorted(self.last, low)), min(int(np.searchsorted(self.last, high)) + 1, len(self.last))):
            docs, impacts = self.block(b, lengths)
            inside = slice(*np.searchsorted(docs, [low, high]))
            yield docs[inside], impacts[inside]


def best_documents(lists: list[tuple[PostingList, int]], lengths: np.ndarray, k: int, window: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """The k documents with the highest scores above 0 and these scores; of equal scores the smaller number wins.

    Documents come in ascending order, so a later one has to exceed the k-th score and a bound equal to it rejects.
    """
    lists = sorted(lists, key=lambda x: x[0].bound * x[1])
    bounds = np.array([p.bound * w for p, w in lists], np.int64)
    together = np.concatenate([[0], np.cumsum(bounds)])
    top_docs, top_scores, least = np.empty(0, np.int64), np.empty(0, np.int64), 0
    for low in range(0, len(lengths), window):
        high = min(low + window, len(lengths))
        idle = int(np.searchsorted(together[1:], least, "right"))  # so many lists cannot exceed the k-th score together
        if idle == len(lists):
            break
        dense = np.zeros(high - low, np.int64)
        for postings, weight in lists[idle:]:
            for docs, impacts in postings.between(low, high, lengths):
                dense[docs - low] += impacts * weight
        docs = np.flatnonzero(dense)
        scores = dense[docs]
        keep = scores + together[idle] > least
        docs, scores = docs[keep] + low, scores[keep]
        if idle and len(docs):
            others = lists[:idle]
            maxima = np.array([p.maxima(docs) * w for p, w in others])
            left = maxima.sum(axis=0)
            for i in range(idle - 1, -1, -1):
                keep = scores + left > least
                docs, scores, left, maxima = docs[keep], scores[keep], left[keep], maxima[:, keep]
                if not len(docs):
                    break
                scores = scores + others[i][0].at(docs, lengths) * others[i][1]
                left = left - maxima[i]
        keep = scores > least
        top_docs, top_scores = np.concatenate([top_docs, docs[keep]]), np.concatenate([top_scores, scores[keep]])
        best = np.argsort(-top_scores, kind="stable")[:k]  # earlier documents come first among equals
        top_docs, top_scores = top_docs[best], top_scores[best]
        if len(top_docs) == k:
            least = int(top_scores[-1])
    return top_docs, top_scores


def _searcher(k: int, n_docs: int, n_terms: int):
    def search(rows: pd.DataFrame) -> pd.DataFrame:
        about = rows[rows["term"].isna()].iloc[0]
        ids, lengths = about["doc_ids"], np.asarray(about["doc_lens"], np.int64)
        # Python integers where a corpus is so large that 64 bits would not hold the product
        m = 100 - _LENGTH_SHARE + (_LENGTH_SHARE * lengths * n_docs // n_terms if int(lengths.max()) * n_docs < 1 << 57 else
                                   np.array([_LENGTH_SHARE * int(n) * n_docs // n_terms for n in lengths], np.int64))
        norm_of = dict(zip(lengths.tolist(), m.tolist()))
        score = lambda tf, norm: (_SCALE * tf) // (1000 * tf + 12 * norm)
        by_length = np.zeros(int(lengths.max()) + 1, np.int64) if lengths.max() < 1 << 22 else None
        if by_length is not None:
            by_length[lengths] = m
        norms = (lambda n: by_length[n]) if by_length is not None else (lambda n: np.array([norm_of[int(x)] for x in n], np.int64))
        impact = lambda tf, n: score(tf, norms(n))
        queries: dict[int, list] = {}
        for row in rows[rows["term"].notna()].itertuples(index=False):
            postings = PostingList(row, impact)
            for use in row.uses:
                queries.setdefault(use["query"], []).append((postings, int(row.weight) * use["times"]))
        out = []
        for query, lists in queries.items():
            docs, scores = best_documents([x for x in lists if x[1] > 0], lengths, k)
            out += [(query, ids[d], s) for d, s in zip(docs.tolist(), scores.tolist())]
        return pd.DataFrame(out, columns=["query", "doc_id", "score"]).astype({"query": "int64", "doc_id": "Int64", "score": "int64"})

    return search


def rank_documents(index: DataFrame, items: DataFrame, k: int = 20, part: int = 256) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every row of ``items`` (item_id, text).

    Every row is a query of its own, also where ids repeat; NULL and empty texts have no terms and no results. Of equal scores the
    smaller doc_id ranks first (NULL last). ``part`` queries at most are handled at once in a shard; what a task holds is bounded by the
    shard and by that. The terms and uses of the queries are tables that are joined, not shipped.
    """
    numbered = durable(own_columns(items, "item_id", "text").withColumn("query", F.monotonically_increasing_id()))
    n_items = numbered.count()
    parts = max(1, math.ceil(n_items / part))
    totals = index.filter("term IS NULL").agg(
        F.sum(F.expr("cast(size(filter(doc_lens, n -> n > 0)) as bigint)")).alias("n"), F.sum(F.expr("aggregate(doc_lens, 0L, (a, n) -> a + n)")).alias("l")).first()
    n_docs, n_terms = totals["n"] or 0, totals["l"] or 0
    lowered = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = (numbered.select("query", F.explode(F.split(lowered, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).alias("term")).filter("term <> ''")
             .groupBy("query", "term").agg(F.count(F.lit(1)).alias("times")))
    uses = durable(terms.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int")).groupBy("part", "term").agg(
        F.collect_list(F.struct("query", "times")).alias("uses")))  # a part is bounded, so is this list
    df = index.join(uses.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("bigint")
    wanted = durable(uses.join(df, "term").select("term", "part", weight.alias("weight"), "uses"))
    columns = [c.split()[0] for c in _POSTINGS.replace("query:bigint,times:bigint", "").split(", ")]
    found = index.join(wanted, "term").select(*columns)
    shards = index.filter("term IS NULL").select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    about = shards.withColumn("weight", F.lit(None).cast("bigint")).withColumn("uses", F.lit(None).cast(found.schema["uses"].dataType)).select(*columns)
    if not n_docs:
        about, found = about.limit(0), found.limit(0)
    best = found.unionByName(about).groupBy("shard", "part").applyInPandas(_searcher(k, n_docs, max(n_terms, 1)), "query bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)  # the k best of a task leave it, not of a shard
    return ranked.join(numbered.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
