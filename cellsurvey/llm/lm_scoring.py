"""Language-model scoring with stupid backoff over the corpus itself.

The model is made of the unigram and bigram counts of all documents. A document is scored by the others: its own counts
are taken off first. A word after another scores C(v w) / C(v) if the pair occurs in another document, else
``backoff`` * C(w) / N; the first word C(w) / N; a count of 0 stands as ``unseen``. The score is the sum of the logarithms.

All documents count. Texts are exploded to one entry for every pair of a document, and the entries are partitioned by the hash of
the pair once; there they meet their count, so that the count table and the entries that are joined with it lie in the same
partition and neither moves again. What a slice of at most 256 documents sends to a partition travels as one row. Words among the
``frequent`` ones are named by their places, so that an entry takes 8 bytes and the words' counts are looked up by place in an array of
at most ``frequent``; other words stay open and are joined with the whole unigram table. A word that occurs once is in no other document and
needs neither: a bitmap of bounded size tells most of them from the other open words, and what it lets through is only moved in vain.
Uses of an open word meet in the partition of its hash, where they are its count.
Found pairs are summed per document before they leave the partition, and the sums of a slice leave it together.

A hot pair, one that occurs ``hot_rows`` times or more, would swell its partition. Tasks watch for such pairs while they count
words (with a table of bounded size, of which the rare pairs are dropped: a pair it loses is not hot). Rows of hot pairs are
dealt to many partitions, counted by a sum with map-side combination, and joined with those counts at the end, as rows that
a skewed join can split. There are at most 2^20 hot pairs, because the limit rises with the corpus beyond 2^38 words.

Words stand between white space, A-Z lowered. NULL and empty texts score 0; the rows of one id (NULL is one) are parts of one document
whose scores are added, each scored by all other rows; texts of any length are scored whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsurvey.llm.common import WordHashes, mixed, own_columns, raw, release_memory, slices
from cellsurvey.session import durable

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_WATCHED = 1 << 18  # pairs that a task remembers while it looks for hot ones

_COUNTS = "word bigint, pair bigint, n bigint"
# A pair of two frequent words is one number: their places (20 bits each), the uses in the document (6 bits), and the own counts of the words
# (9 bits each). ``others`` are records of what does not fit, of pairs that are hot or have open words, and of open words.
_USES, _OWN, _MOST_FREQUENT, _MOST_BITS = 6, 9, 1 << 20, 1 << 26
_PACKED = _USES + 2 * _OWN
_HOT, _LEFT, _RIGHT, _WORD = 1, 2, 4, 8  # kinds of records; _LEFT and _RIGHT: that word is open, and named by its hash instead of its place
_OTHER = np.dtype([("left", "<i8"), ("right", "<i8"), ("n", "<i4"), ("own_left", "<i4"), ("own_right", "<i4"), ("doc", "u1"), ("kind", "u1")])
_ROWS = "part int, slice bigint, docs binary, items binary, others binary, doc_ids array<bigint>, sizes array<int>, base array<double>"
_APART = pa.struct([("hot", pa.int64()), ("n", pa.int32()), ("gain", pa.float64()), ("left", pa.int64()), ("own_left", pa.int32()), ("right", pa.int64()), ("own_right", pa.int32())])
_SUMS = ("slice bigint, docs array<tinyint>, found array<int>, value array<double>, doc_ids array<bigint>, sizes array<int>, "
         "apart_docs array<tinyint>, apart array<struct<hot:bigint,n:int,gain:double,left:bigint,own_left:int,right:bigint,own_right:int>>")
_DOCS = ("slice bigint, doc int, doc_id bigint, n_words bigint, found bigint, value double, "
         "apart array<struct<hot:bigint,n:int,gain:double,left:bigint,own_left:int,right:bigint,own_right:int>>")


def _hashed(batches: Iterator[pa.RecordBatch], column: int, rows: int = 128) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    table = WordHashes()
    for batch in slices(batches, rows):
        yield batch, [table.of(t.lower().split()) if t else np.empty(0, np.uint64) for t in raw(batch.column(column))]
    release_memory()


def _pairs(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first words of pairs, and the pairs' hashes."""
    at = np.flatnonzero(doc[1:] == doc[:-1])
    return at, mixed(h[at] * _FACTOR + h[at + 1])


class Tally:
    """Counts of 64-bit keys; ``raw`` keys are counted together."""

    def __init__(self):
        self.raw, self.n_raw, self.keys, self.counts, self.held = [], 0, [], [], 0

    def add(self, keys: np.ndarray) -> bool:
        """True if there is something new to compact."""
        self.raw.append(keys)
        self.n_raw += len(keys)
        return self.n_raw >= 1 << 20 and self.count()

    def count(self) -> bool:
        keys, counts = np.unique(np.concatenate(self.raw), return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        self.raw, self.n_raw, self.held = [], 0, self.held + len(keys)
        return True

    def compact(self) -> tuple[np.ndarray, np.ndarray]:
        if self.raw:
            self.count()
        keys, place = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.bincount(place, weights=np.concatenate(self.counts)).astype(np.int64)
        self.keys, self.counts, self.held = [keys], [counts], len(keys)
        return keys, counts

    def keep(self, most: int) -> None:
        """Only keys that occur twice, and of them the most frequent."""
        keys, counts = self.compact() if len(self.keys) > 1 else (self.keys[0], self.counts[0])
        keys, counts = keys[counts > 1], counts[counts > 1]
        if len(keys) > most:
            best = np.argpartition(counts, -most)[-most:]
            keys, counts = keys[best], counts[best]
        self.keys, self.counts, self.held = [keys], [counts], len(keys)


def _count(least_pair: int):
    """Counts of the words of a task, and of the pairs it may call hot."""

    def out(words: bool, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        keys, none = pa.array(keys.view(np.int64)), pa.nulls(len(keys), pa.int64())
        return pa.RecordBatch.from_arrays([keys, none, pa.array(n)] if words else [none, keys, pa.array(n)], names=["word", "pair", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, some = Tally(), Tally(), Tally()
        for _, docs in _hashed(batches, 0):
            h = np.concatenate(docs)
            if words.add(h) and words.held > 1_000_000:
                found = words.compact()
                if words.held > 500_000:
                    yield out(True, *found)
                    words = Tally()
            if some.add(_pairs(h, np.repeat(np.arange(len(docs)), [len(d) for d in docs]))[1]):
                some.keep(_WATCHED)
                pairs.keys += some.keys
                pairs.counts += some.counts
                pairs.held += some.held
                some = Tally()
                if pairs.held > 4 * _WATCHED:
                    pairs.keep(_WATCHED)
        if words.held or words.raw:
            yield out(True, *words.compact())
        pairs.raw = some.raw
        if pairs.held or pairs.raw:
            keys, n = pairs.compact()
            yield out(False, keys[n >= least_pair], n[n >= least_pair])

    return run


class Model:
    """Counts of the frequent words, sorted by hash, the hot pairs, and a bitmap that holds all other words that occur twice."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, hot: np.ndarray, bitmap: np.ndarray, total: int, backoff: float, unseen: float):
        self.hashes, self.counts, self.hot, self.bitmap = hashes, counts, hot, bitmap
        self.total, self.backoff, self.unseen = total, backoff, unseen

    def of(self, words: np.ndarray) -> np.ndarray:
        """Places among the frequent words; -1 for others."""
        if not len(self.hashes):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return np.where(self.hashes[at] == words, at, -1)

    def may_repeat(self, words: np.ndarray) -> np.ndarray:
        """False only for words that occur once, if they are not frequent."""
        if not len(self.bitmap):
            return np.zeros(len(words), bool)
        slot = words & np.uint64(64 * len(self.bitmap) - 1)
        return (self.bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)

    def is_hot(self, pairs: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(pairs), bool)
        return self.hot[np.minimum(np.searchsorted(self.hot, pairs), len(self.hot) - 1)] == pairs


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Records, cut behind the ``ends``, as binary values."""
    offsets = (np.r_[0, ends] * data.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _records(column: pa.Array, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All records of a binary column without nulls, and how many each value holds."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(dtype) if data else np.empty(0, dtype), np.diff(offsets) // dtype.itemsize


def _lists(values: np.ndarray | pa.Array, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), values if isinstance(values, pa.Array) else pa.array(values))


def _key(kind: np.ndarray, left: np.ndarray, right: np.ndarray, places: int) -> np.ndarray:
    """Keys of pairs: hashes stand below 0, places above."""
    some = (kind & (_LEFT | _RIGHT)).astype(np.uint64)
    return np.where(some > 0, mixed(left.view(np.uint64) * _FACTOR + right.view(np.uint64) + some) | np.uint64(1 << 63), (left * places + right).view(np.uint64)).view(np.int64)


def _explode(model: Model, parts: int):
    """(doc_id, text) -> one row for every slice and partition, of the documents' pairs and open words, and one row of the documents of a slice."""

    part_of = lambda key: (mixed(key.view(np.uint64)) % np.uint64(parts)).astype(np.int32)

    def rows_of(ids: pa.Array, docs: list[np.ndarray], name: int) -> Iterator[pa.RecordBatch]:
        size = np.array([len(d) for d in docs])
        h, doc = np.concatenate(docs), np.repeat(np.arange(len(docs)), size)
        spread = mixed(np.arange(len(docs), dtype=np.uint64) + np.uint64(name << 8))  # for what needs no partition of its own
        words, word = np.unique(h, return_inverse=True)
        own_word, place, own = np.unique(doc * max(1, len(words)) + word, return_inverse=True, return_counts=True)
        owner, own_word = own_word // max(1, len(words)), own_word % max(1, len(words))
        places = model.of(words)
        single = (places < 0) & ~model.may_repeat(words)  # no other document holds them
        rank, once, named = places[own_word], single[own_word], words[own_word]
        is_open = (rank < 0) & ~once
        # logarithms of the counts elsewhere
        elsewhere = np.where(once, 0, (model.counts[rank] if len(model.counts) else 0) - own)
        logs = np.where(is_open, 0.0, np.log(np.maximum(elsewhere, model.unseen)))
        base = np.bincount(doc, weights=logs[place], minlength=len(docs)) - size * np.log(np.maximum(model.total - size, 1))
        base += np.maximum(size - 1, 0) * math.log(model.backoff)
        whole = lambda values: _lists(values, np.array([len(docs)]))
        empty = pa.array([b""])
        yield pa.RecordBatch.from_arrays(
            [pa.array(part_of(spread[:1])), pa.array([name]), empty, empty, empty, whole(ids), whole(size.astype(np.int32)), whole(base)],
            names=["part", "slice", "docs", "items", "others", "doc_ids", "sizes", "base"])

        at, pair = _pairs(h, doc)
        _, first, n = np.unique(mixed(pair + spread[doc[at]]), return_index=True, return_counts=True)
        order = np.argsort(first)  # a document's pairs stay together
        first, n = first[order], n[order]
        pair, at = pair[first], at[first]
        left, right, of = place[at], place[at + 1], doc[at]
        if once.any():
            some = ~(once[left] | once[right])
            n, pair, left, right, of = n[some], pair[some], left[some], right[some], of[some]
        hot = model.is_hot(pair)
        name_of = np.where(is_open, named.view(np.int64), rank)
        kind = (hot * _HOT | is_open[left] * _LEFT | is_open[right] * _RIGHT).astype(np.uint8)
        key = _key(kind, name_of[left], name_of[right], len(model.hashes))
        part = part_of(np.where(hot, mixed(pair + spread[of]), key.view(np.uint64)))
        own_left, own_right = own[left], own[right]
        apart = (kind > 0) | (n >> _USES > 0) | (np.maximum(own_left, own_right) >> _OWN > 0)

        pairs, opened = np.flatnonzero(apart), np.flatnonzero(is_open)
        other = np.zeros(len(pairs) + len(opened), _OTHER)
        x, y = other[: len(pairs)], other[len(pairs) :]
        x["kind"], x["doc"], x["n"] = kind[pairs], of[pairs], n[pairs]
        x["left"], x["own_left"], x["right"], x["own_right"] = name_of[left[pairs]], own_left[pairs], name_of[right[pairs]], own_right[pairs]
        y["kind"], y["doc"], y["left"], y["own_left"] = _WORD, owner[opened], name_of[opened], own[opened]
        other_part = np.r_[part[pairs], part_of(mixed(named[opened]))]

        x = np.flatnonzero(~apart)
        x = x[np.argsort(part[x].astype(np.uint16) if parts < 1 << 16 else part[x], kind="stable")]
        item = ((key[x] << _USES | n[x]) << _OWN | own_left[x]) << _OWN | own_right[x]
        order = np.argsort(other_part, kind="stable")
        to = np.unique(np.r_[part[x], other_part])
        ends, none = np.searchsorted(part[x], to, "right"), pa.nulls(len(to))
        yield pa.RecordBatch.from_arrays(
            [pa.array(to), pa.array(np.full(len(to), name)), _binary(of[x].astype(np.uint8), ends), _binary(item, ends),
             _binary(other[order], np.searchsorted(other_part[order], to, "right")), none.cast(pa.list_(pa.int64())), none.cast(pa.list_(pa.int32())),
             none.cast(pa.list_(pa.float64()))], names=["part", "slice", "docs", "items", "others", "doc_ids", "sizes", "base"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = TaskContext.get().partitionId() << 32
        for batch, docs in _hashed(batches, 1, 256):
            # long texts apart
            cuts = np.flatnonzero(np.diff(np.cumsum([len(d) for d in docs]) >> 20)) + 1
            for start, end in zip(np.r_[0, cuts], np.r_[cuts, len(docs)]):
                yield from rows_of(batch.column(0).slice(start, end - start), docs[start:end], name)
                name += 1

    return run


def _meet(counts: np.ndarray, unseen: float):
    """All rows of one partition -> sums over the found pairs and the open words of every document in it, and its pairs that are hot or have open words."""

    names, item_type, places = ["slice", "docs", "found", "value", "doc_ids", "sizes", "apart_docs", "apart"], np.dtype(np.uint64), len(counts)
    counts = counts if places else np.zeros(1, np.int64)
    log_of = lambda place, own: np.log(np.maximum(counts[place] - own, unseen))
    number = lambda values, shift, width: (values >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_of, sizes, docs, items, others, n_others = ([np.empty(0, t)] for t in (np.int64, np.int64, np.uint8, item_type, _OTHER, np.int64))
        for batch in batches:
            doc, size = _records(batch.column(2), np.dtype(np.uint8))
            other, n_other = _records(batch.column(4), _OTHER)
            for column, values in ((slice_of, batch.column(1).to_numpy()), (sizes, size), (docs, doc), (items, _records(batch.column(3), item_type)[0]),
                                   (others, other), (n_others, n_other)):
                column.append(values)
            heads = batch.filter(batch.column(5).is_valid())
            if heads.num_rows:
                ids, in_slice, base = (heads.column(c) for c in (5, 6, 7))
                n = np.diff(ids.offsets.to_numpy())
                doc, ends = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n), np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [heads.column(1), _lists(doc.astype(np.uint8).view(np.int8), ends), _lists(np.zeros(len(doc), np.int32), ends), _lists(base.flatten(), ends),
                     _lists(ids.flatten(), ends), _lists(in_slice.flatten(), ends), pa.nulls(len(n), pa.list_(pa.int8())), pa.nulls(len(n), pa.list_(_APART))], names=names)
        slice_of, size, doc, item, other, n_other = (np.concatenate(x) for x in (slice_of, sizes, docs, items, others, n_others))
        del docs, items, others
        kind = other["kind"]
        counted = np.flatnonzero(kind & (_HOT | _WORD) == 0)
        other_key = _key(kind, other["left"], other["right"], places)
        key = np.r_[(item >> np.uint64(_PACKED)).view(np.int64), other_key[counted]]
        n = np.r_[number(item, 2 * _OWN, _USES), other["n"][counted]]
        # the count table of the partition, joined with what it was counted from
        order = np.argsort(key)
        key, n = key[order], n[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        count = np.repeat(np.add.reduceat(n.astype(np.int64), first), np.diff(np.r_[first, len(key)])) if len(key) else n
        del key
        found = count > n
        at, count = order[found], count[found]
        del order, n, found
        plain = at < len(item)

        # pairs of frequent words, summed per document; a slot is a row and a document
        x = at[plain]
        of, n = item[x], number(item[x], 2 * _OWN, _USES)
        left, right = np.divmod((of >> np.uint64(_PACKED)).astype(np.int64), max(1, places))
        value, uses = np.zeros(len(item)), np.zeros(len(item), np.int32)
        value[x] = n * (np.log(count[plain] - n) - log_of(left, number(of, _OWN, _OWN)) - log_of(right, number(of, 0, _OWN)))
        uses[x] = n
        slot = np.repeat(np.arange(len(size)) << 8, size) | doc
        if len(item):
            start = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
            value, uses, slot = np.add.reduceat(value, start), np.add.reduceat(uses, start, dtype=np.int32), slot[start]

        # the other pairs, as far as words are frequent, and open words
        other_slot = np.repeat(np.arange(len(n_other)) << 8, n_other) | other["doc"]
        gain = np.zeros(len(other))
        for side, opened in (("left", _LEFT | _WORD), ("right", _RIGHT | _WORD)):
            x = np.flatnonzero(kind & opened == 0)
            gain[x] += log_of(other[side][x], other[f"own_{side}"][x])
        other_value, other_uses = np.zeros(len(other)), np.zeros(len(other), np.int32)
        x = counted[at[~plain] - len(item)]
        other_uses[x] = other["n"][x]
        other_value[x] = other["n"][x] * (np.log(count[~plain] - other["n"][x]) - gain[x])
        x = np.flatnonzero(kind & _WORD)
        _, word = np.unique(other["left"][x], return_inverse=True)
        own = other["own_left"][x]
        other_value[x] = own * np.log(np.maximum(np.bincount(word, weights=own)[word] - own, unseen))

        some = uses > 0
        used = np.flatnonzero((other_uses > 0) | (kind & _WORD > 0))
        slot, place = np.unique(np.r_[slot[some], other_slot[used]], return_inverse=True)
        value = np.bincount(place, weights=np.r_[value[some], other_value[used]], minlength=len(slot))
        uses = np.bincount(place, weights=np.r_[uses[some], other_uses[used]], minlength=len(slot)).astype(np.int32)
        rest = np.flatnonzero((kind & _HOT > 0) | (other_uses > 0) & (kind & (_LEFT | _RIGHT) > 0))
        rest_slot = other_slot[rest]
        rest, rest_slot = rest[order := np.argsort(rest_slot, kind="stable")], rest_slot[order]
        here = np.unique(np.r_[slot, rest_slot] >> 8)
        if len(here):
            ends, rest_ends = np.searchsorted(slot >> 8, here, "right"), np.searchsorted(rest_slot >> 8, here, "right")
            in_slice = lambda slot: (slot & 255).astype(np.uint8).view(np.int8)
            o, k = other[rest], kind[rest]
            column = lambda values, there: pa.array(np.ascontiguousarray(values), mask=~there)
            is_hot, left, right = k & _HOT > 0, k & _LEFT > 0, k & _RIGHT > 0
            apart = pa.StructArray.from_arrays(
                [column(other_key[rest], is_hot), column(o["n"], k > 0), column(gain[rest], is_hot), column(o["left"], left), column(o["own_left"], left),
                 column(o["right"], right), column(o["own_right"], right)], fields=list(_APART))
            yield pa.RecordBatch.from_arrays(
                [pa.array(slice_of[here]), _lists(in_slice(slot), ends), _lists(uses, ends), _lists(value, ends), pa.nulls(len(here), pa.list_(pa.int64())),
                 pa.nulls(len(here), pa.list_(pa.int32())), _lists(in_slice(rest_slot), rest_ends), _lists(apart, rest_ends)], names=names)
        release_memory()

    return run


def _sum_slice(rows: pa.Table) -> pa.Table:
    """All rows of one slice -> its documents with their sums, and lists of what stays apart."""
    flat = {name: pa.chunked_array([c.flatten() for c in rows.column(name).chunks], rows.schema.field(name).type.value_type).combine_chunks()
            for name in ("docs", "found", "value", "doc_ids", "sizes", "apart_docs", "apart")}
    numpy = lambda name: flat[name].to_numpy(zero_copy_only=False)
    name, n, doc = rows.column("slice")[0], len(flat["doc_ids"]), numpy("docs").view(np.uint8)
    add = lambda name: np.bincount(doc, weights=numpy(name), minlength=n)
    apart_doc = numpy("apart_docs").view(np.uint8)
    order = np.argsort(apart_doc, kind="stable")
    apart = _lists(flat["apart"].take(pa.array(order)), np.searchsorted(apart_doc[order], np.arange(n), "right"))
    columns = [pa.repeat(name, n), np.arange(n, dtype=np.int32), flat["doc_ids"], flat["sizes"].cast(pa.int64()), add("found").astype(np.int64), add("value"), apart]
    return pa.table(columns, names=["slice", "doc", "doc_id", "n_words", "found", "value", "apart"])


def _model(read: DataFrame, backoff: float, unseen: float, frequent: int, hot_rows: int) -> tuple[Model, DataFrame]:
    """The shipped part of the model, and the whole unigram table."""
    counted = durable(read.select("text").mapInArrow(_count(min(64, hot_rows)), _COUNTS).groupBy("word", "pair").agg(F.sum("n").alias("n")))
    words = counted.filter("word is not null").select("word", "n")
    # the lowest count (beyond 64: power of two) such that at most ``frequent`` words occur as often
    step = F.when(F.col("n") < 64, F.col("n")).otherwise(F.pow(F.lit(2.0), F.floor(F.log2("n"))).cast("bigint"))
    levels = words.groupBy(step.alias("level")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).collect()
    kept, cut = 0, 1 << 62
    for level, size, _ in sorted(levels, reverse=True):
        if kept + size > frequent:
            break
        kept, cut = kept + size, level
    total = sum(n for _, _, n in levels)
    top = words.filter(F.col("n") >= cut).toArrow()
    hashes = top.column("word").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    # each is counted less often than it occurs or as often, so there are at most total / limit
    limit = max(hot_rows, total >> 20)
    hot = counted.filter(F.col("pair").isNotNull() & (F.col("n") >= limit)).select("pair").toArrow().column("pair").to_numpy().astype(np.int64)
    # one bit for every other word that occurs twice, 16 bits a word as long as they are few
    repeated = sum(size for level, size, _ in levels if 2 <= level < cut)
    bits = min(_MOST_BITS, 1 << max(6, (16 * repeated).bit_length()))
    bitmap = np.zeros(bits // 64 if repeated else 0, np.uint64)
    if repeated:
        set_bits = (
            words.filter((F.col("n") >= 2) & (F.col("n") < cut)).select(F.col("word").bitwiseAND(F.lit(bits - 1)).alias("slot"))
            .groupBy(F.shiftright("slot", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("set")).toArrow())
        bitmap[set_bits.column("at").to_numpy()] = set_bits.column("set").to_numpy().view(np.uint64)
    return Model(hashes[order], top.column("n").to_numpy().astype(np.int64)[order], np.sort(hot.view(np.uint64)), bitmap, total, backoff, unseen), words


def backoff_scores(docs: DataFrame, backoff: float = 0.4, unseen: float = 0.5, frequent: int = 1 << 20, hot_rows: int = 1 << 18,
                   part_rows: int = 3_000_000) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score)."""
    if frequent > _MOST_FREQUENT:
        raise ValueError(f"frequent: {_MOST_FREQUENT} at most")
    read = own_columns(docs, "doc_id", "text")
    model, words = _model(read, backoff, unseen, frequent, hot_rows)
    parts = max(1, math.ceil(model.total / part_rows))
    met = read.mapInArrow(_explode(model, parts), _ROWS).repartitionById(parts, "part").mapInArrow(_meet(model.counts, unseen), _SUMS)
    # hot pairs and found pairs with open words stay rows; everything else is a sum. A slice is bounded by its 256 documents
    sums = durable(met.groupBy("slice").applyInArrow(_sum_slice, _DOCS))
    log_of = lambda count, own: F.log(F.greatest(count - own, F.lit(unseen)))
    rest = sums.select("slice", "doc", F.explode("apart").alias("apart")).select("slice", "doc", "apart.*")
    hot = rest.filter("hot is not null")
    counts = durable(hot.groupBy("hot").agg(F.sum("n").alias("count")))
    found = hot.join(counts, "hot").filter(F.col("count") > F.col("n"))
    opened = rest.filter("hot is null").drop("hot").unionByName(found.drop("hot", "count"))
    terms = (
        opened.select("slice", "doc", "n", F.explode(F.array(
            F.struct(F.col("left").alias("word"), F.col("own_left").alias("own")), F.struct(F.col("right").alias("word"), F.col("own_right").alias("own")))).alias("use"))
        .select("slice", "doc", "n", "use.*").filter("word is not null").join(words.withColumnRenamed("n", "count"), "word")
        .select("slice", "doc", (-F.col("n") * log_of(F.col("count"), F.col("own"))).alias("value")))
    # found instead of backed off: log C(v w) - log C(v) in place of log backoff + log C(w) - log N
    gained = F.col("n") * (F.log(F.col("count") - F.col("n")) - F.col("gain"))
    not_backed_off = F.log(F.greatest(F.lit(model.total) - F.col("n_words"), F.lit(1))) - math.log(backoff)
    zero = F.lit(0).cast("bigint")
    return (
        sums.select("slice", "doc", "doc_id", "n_words", "found", "value")
        .unionByName(found.select("slice", "doc", F.col("n").cast("bigint").alias("found"), gained.alias("value")), allowMissingColumns=True)
        .unionByName(terms, allowMissingColumns=True)
        .groupBy("slice", "doc").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.coalesce(F.sum("found"), zero).alias("found"), F.sum("value").alias("value"))
        .groupBy("doc_id").agg(F.coalesce(F.sum("n_words"), zero).alias("n_words"), F.coalesce(F.sum(F.col("value") + F.col("found") * not_backed_off), F.lit(0.0)).alias("log_score"))
        .withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))))
