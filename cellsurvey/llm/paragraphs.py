"""Substring deduplication by paragraph MinHash banding.

Paragraphs (lines of at least ``least_words`` words) are sets of five-word shingles. Bands of a MinHash signature are tuned
so that a pair at the threshold collides in one of them with probability ``recall``; colliding paragraphs are verified by
exact Jaccard similarity and clustered by connected components. Sentences of a paragraph are pieces as well, matched by
equality; those of more than ``longest_sentence`` words are cut at words chosen by hash.

So that passages are found wherever they begin and end, and whatever their lines and sentences are, anchors are chosen over
the whole text: of every ``w`` consecutive runs of ``k`` words the one with the smallest hash, k + w - 1 = ``least_span``. Two
documents that share ``least_span`` words in a row share an anchor in them, and further ones touch (w <= k). Where a run of
repeated anchors ends, fewer than ``w`` words can be missing; there the text is read once more and the anchor grown
word by word as long as another document continues in the same way. So equal passages of ``least_span`` words are found whole.

A piece is repeated if its cluster occurs in two documents or more. The document with the smallest id keeps it, the others
may lose it; words count as removed if any repeated piece over them is kept by another document. Repeated pieces of a document that touch, or leave at most ``gap`` words between them, form one passage;
passages of at least ``least_span`` words are returned, those that are kept too (with nothing to remove).

NULL and empty texts have no pieces; documents without an id cannot be named and are left out; repeated rows of one document are no
repetition; texts of any length are cut whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellsurvey.llm.common import mixed, own_columns, raw, release_memory, shingles, slices
from cellsurvey.llm.components import connected_components
from cellsurvey.llm.ngram_join import hash_family, intersections, spanning
from cellsurvey.session import discard, durable

_SHINGLE = 5
_PIECES = "doc_id bigint, node binary, sentence bigint, first int, last int, bands array<bigint>, anchor boolean, common boolean"
_AROUND = "key bigint, after boolean, size int, doc_id bigint, place bigint, words binary, common boolean"  # place: first word and one, of edges alone
_GROWN = "doc_id bigint, first int, last int, kept bigint"
_LENGTHS = "key bigint, low bigint, high bigint"
_EDGES = "key bigint, doc_id bigint, first int, last int"
_BASE = 0x9E3779B97F4A7C15
_NAMES = (np.uint64(0x94D049BB133111EB), np.uint64(0xC2B2AE3D27D4EB4F))
_ENDS, _SPACE = (np.isin(np.arange(256), list(x)) for x in (b".!?", b" \t\n\r\x0b\x0c"))  # last bytes of words that end a sentence, what separates words
_BLOCK, _SHARE = 1 << 18, 2048  # a task marks what makes up a 2048th or more of a block of its pieces


def tune_bands(threshold: float, recall: float, most_hashes: int = 32) -> tuple[int, int]:
    """(rows, bands): the longest rows for which few enough hashes reach the recall at the threshold."""
    for rows in range(most_hashes, 0, -1):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))
        if rows * bands <= most_hashes:
            return rows, bands
    raise ValueError("no banding reaches this recall")


def paragraph_sets(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every word interval (not empty): its distinct shingles, sorted and laid end to end, where each set begins, and 16 bytes that name the set."""
    size = np.maximum(last - first - _SHINGLE + 1, 1)
    owner = np.repeat(np.arange(len(first)), size)
    values = np.r_[shingles(hashes, _SHINGLE), np.zeros(_SHINGLE, np.uint64)][np.arange(len(owner)) + np.repeat(first - (np.cumsum(size) - size), size)]
    begin = np.cumsum(size) - size
    for i in np.flatnonzero(last - first < _SHINGLE):
        values[begin[i]] = shingles(hashes[first[i] : last[i]], _SHINGLE)[0]
    for a, b in zip(begin.tolist(), (begin + size).tolist()):
        values[a:b].sort()
    new = np.ones(len(owner), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    begin = np.searchsorted(np.flatnonzero(new), begin)
    values = values[new]
    name = np.stack([np.add.reduceat(mixed(values ^ salt), begin) for salt in _NAMES], axis=1) if len(begin) else np.empty((0, 2), np.uint64)
    return values, begin, np.ascontiguousarray(name)


def _names(name: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(name), [None, pa.py_buffer(name.tobytes())]).cast(pa.binary())


def band_keys(values: np.ndarray, begin: np.ndarray, family: tuple[np.ndarray, np.ndarray], rows: int) -> pa.Array:
    """One number for every band of ``rows`` MinHash functions (32 bits each), of the sets that begin at the places."""
    out = np.repeat(np.arange(len(family[0]) // rows, dtype=np.uint64)[None, :], len(begin), axis=0)
    for k, (scale, shift) in enumerate(zip(*family)):
        least = np.minimum.reduceat(values * scale + shift, begin) >> np.uint64(32)
        out[:, k // rows] = mixed(out[:, k // rows] * np.uint64(_BASE) + least)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(begin) + 1, dtype=np.int32) * np.int32(out.shape[1])), pa.array(out.view(np.int64).ravel()))


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of the texts one after another, the number of words up to the end of each line that has some, and of each text.

    The lowest bit of a hash says whether the word may end a sentence.
    """
    data = b"\n".join([*texts, b""])
    words = data.split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    held = np.frombuffer(data, np.uint8)
    space = _SPACE[held]
    last = np.flatnonzero(space[1:] & ~space[:-1])  # last bytes of the words
    hashes = hashes & ~np.uint64(1) | _ENDS[held[last]]
    lines = np.searchsorted(last, np.flatnonzero(held == 10))
    ends = np.searchsorted(last, np.cumsum([len(t) + 1 for t in texts]) - 1)
    return hashes, lines[np.diff(lines, prepend=0) > 0], ends


def sentences(hashes: np.ndarray, lines: np.ndarray, least: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Word intervals of the sentences of all lines, long ones cut."""
    stop = (hashes & np.uint64(1)).astype(bool)
    stop[lines - 1] = True
    last = np.flatnonzero(stop) + 1
    first = np.r_[0, last[:-1]]
    long = np.flatnonzero(last - first > longest)
    more = []
    places = np.flatnonzero((hashes >> np.uint64(8)) % np.uint64(8) == 0) + 1
    within = zip(first[long].tolist(), last[long].tolist(), np.searchsorted(places, first[long], "right"), np.searchsorted(places, last[long], "right"))
    for start, end, a, b in within:
        for cut in places[a:b].tolist():
            if cut - start >= least:
                more.append((start, cut))
                start = cut
        more.append((start, end))
    if more:
        cut = np.array(more)
        first, last = np.r_[np.delete(first, long), cut[:, 0]], np.r_[np.delete(last, long), cut[:, 1]]
    keep = last - first >= least
    return first[keep], last[keep]


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of the base and of its inverse


def _power(which: int, size: int) -> np.ndarray:
    if len(_powers[which]) < size:
        base = _BASE if which == 0 else pow(_BASE, -1, 1 << 64)
        _powers[which] = np.cumprod(np.r_[np.uint64(1), np.full(size, base, np.uint64)])
    return _powers[which][:size]


class Runs:
    """Hashes of any runs of consecutive words of one text, or of several laid end to end."""

    def __init__(self, hashes: np.ndarray):
        self.words, self.inverse = len(hashes), _power(1, len(hashes) + 1)
        self.sums = np.r_[np.uint64(0), np.cumsum(hashes * _power(0, len(hashes)))]

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mixed((self.sums[last] - self.sums[first]) * self.inverse[first] + (last - first).astype(np.uint64)).view(np.int64)


def _sliding(best: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        x, done = best(x[:-step], x[step:]), done + step
    return x


def anchors(runs: Runs, ends: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """(first words, hashes) of the runs of k words that have the smallest hash of w consecutive ones, in texts that end at ``ends``."""
    if runs.words < k + w - 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.arange(runs.words - k + 1)
    h = runs.of(first, first + k)
    lowest = np.iinfo(np.int64).min
    edge = np.full(w - 1, lowest)
    least = _sliding(np.minimum, h, w)
    starts = np.arange(len(least))
    least[starts + (k + w - 1) > ends[np.searchsorted(ends, starts, "right")]] = lowest  # not inside one text
    chosen = np.flatnonzero(_sliding(np.maximum, np.r_[edge, least, edge], w) == h)
    return chosen, h[chosen]


def _marks(key: np.ndarray) -> pa.Array:
    """Which rows of a block have a key that makes up a large part of it."""
    _, number, count = np.unique(key, return_inverse=True, return_counts=True)
    return pa.array(count[number] >= _BLOCK // _SHARE)


def _cutter(least_words: int, least_sentence: int, longest_sentence: int, hashes: int, band: int, seed: int, k: int, w: int):
    names = [c.split()[0] for c in _PIECES.split(", ")]

    def parts(waiting: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        doc_id, key, first, last, anchor = (np.concatenate(c) for c in zip(*waiting))
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_id, pa.int64()), pa.nulls(len(key), pa.binary()), pa.array(key), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
             pa.nulls(len(key), pa.list_(pa.int64())), pa.array(anchor), _marks(key)], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family(hashes, seed)
        waiting, rows = [], 0
        for batch in slices(batches, 64):
            batch = batch.filter(batch.column(1).is_valid())
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            h, lines, ends = layout(raw(batch.column(1)))
            if not len(h):
                continue
            runs, begins = Runs(h), np.r_[0, ends[:-1]]
            place = lambda at: np.searchsorted(ends, at, "right")
            a, key = anchors(runs, ends, k, w)
            x, y = sentences(h, lines, least_sentence, longest_sentence)
            for first, last, key, kind in ((a, a + k, key, True), (x, y, ~runs.of(x, y), False)):  # a sentence is not taken for an anchor
                doc = place(first)
                waiting.append((ids[doc], key, first - begins[doc], last - begins[doc], np.full(len(first), kind)))
                rows += len(first)
            if rows >= _BLOCK:
                yield parts(waiting)
                waiting, rows = [], 0
            first = np.r_[0, lines[:-1]]
            wide = lines - first >= least_words
            if wide.any():
                first, last = first[wide], lines[wide]
                values, begin, name = paragraph_sets(h, first, last)
                doc, n = place(first), len(first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[doc], pa.int64()), _names(name), pa.nulls(n, pa.int64()), pa.array((first - begins[doc]).astype(np.int32)),
                     pa.array((last - begins[doc]).astype(np.int32)), band_keys(values, begin, family, band), pa.array(np.zeros(n, bool)), pa.array(np.zeros(n, bool))], names=names)
        if rows:
            yield parts(waiting)

    return cut


def _grower(k: int, w: int):
    """(doc_id, text, places) -> the anchors at the places, each with up to w - 1 words (48 bits of their hashes) before or after it.

    The key names the anchor, the side and the first word there: who shares any word beside an anchor shares that one.
    """

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        more, names = np.arange(1, w), [c.split()[0] for c in _AROUND.split(", ")]
        waiting: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def block() -> pa.RecordBatch:
            key, after, size, doc_id, place, words = (np.concatenate(c) for c in zip(*waiting))
            data = pa.FixedSizeBinaryArray.from_buffers(pa.binary(6 * (w - 1)), len(key), [None, pa.py_buffer(words.tobytes())])
            return pa.RecordBatch.from_arrays([*map(pa.array, (key, after, size, doc_id, place)), data.cast(pa.binary()), _marks(key)], names=names)

        for batch in slices(batches, 128):
            h, _, ends = layout(raw(batch.column(1)))
            runs, short, begins = Runs(h), np.r_[h, np.uint64(0)].view(np.uint8).reshape(-1, 8)[:, 2:], np.r_[0, ends[:-1]]
            places = batch.column(2).flatten()
            p, key, left, right, head, tail = (places.field(n).to_numpy(zero_copy_only=False) for n in range(6))
            doc = np.repeat(np.arange(len(ends)), np.diff(batch.column(2).offsets.to_numpy()))
            at = begins[doc] + p
            here = np.flatnonzero(at + k <= ends[doc])
            here = here[runs.of(at[here], at[here] + k) == key[here]]  # another row of this id may have another text
            ids = batch.column(0).to_numpy()
            for after, side, edge in ((False, left, head), (True, right, tail)):
                i = here[side[here].astype(bool)]
                room = ends[doc[i]] - at[i] - k if after else at[i] - begins[doc[i]]
                i, size = i[room > 0], np.minimum(room[room > 0], w - 1)
                word = at[i][:, None] + (k - 1 + more if after else -more)
                word[more > size[:, None]] = len(h)
                beside = mixed(mixed(key[i].view(np.uint64) * np.uint64(2) + np.uint64(after)) * np.uint64(_BASE) + h[word[:, 0]]).view(np.int64)
                waiting.append((beside, np.full(len(i), after), size.astype(np.int32), ids[doc[i]], np.where(edge[i].astype(bool), p[i].astype(np.int64) + 1, 0),
                                short[word].reshape(len(i), 6 * (w - 1))))
                rows += len(i)
            if rows >= _BLOCK // 8:
                yield block()
                waiting, rows = [], 0
        if rows:
            yield block()
        release_memory()

    return grow


def _around(table: pa.RecordBatch, steps: int) -> tuple[np.ndarray, ...]:
    """Columns of rows of ``_grower`` but the last; the words as numbers."""
    key, after, size, doc_id, place = (table.column(c).to_numpy(zero_copy_only=False) for c in range(5))
    words = np.zeros((len(key), steps, 8), np.uint8)
    words[:, :, 2:] = np.frombuffer(b"".join(table.column(5).to_pylist()), np.uint8).reshape(len(key), steps, 6)
    return key, after, size, doc_id, place, words.view(np.uint64)[:, :, 0]


def _span(place: np.ndarray, after: np.ndarray, length: np.ndarray, k: int) -> list[np.ndarray]:
    """First and last words of anchors at the places that are longer by the lengths."""
    first = place - 1 - np.where(after, 0, length)
    return [first.astype(np.int32), (first + k + length).astype(np.int32)]


def longest(key: np.ndarray, after: np.ndarray, size: np.ndarray, doc_id: np.ndarray, place: np.ndarray, words: np.ndarray, k: int) -> list[np.ndarray]:
    """(doc_id, first, last, kept) of the anchors at edges, for every ``kept`` as long as another document has the same words around the anchor.

    Rows come by key. Word by word, rows stay that still share all words so far with a row of another document.
    """
    group = np.cumsum(np.r_[0, key[1:] != key[:-1]])
    alive, length, best, found = np.arange(len(key)), np.zeros(len(key), np.int64), np.zeros(len(key), np.int64), []
    take = lambda rows: found.append((doc_id[rows], *_span(place[rows], after[rows], length[rows], k), best[rows]))
    for step in range(words.shape[1]):
        alive = alive[size[alive] > step]
        if not len(alive):
            break
        alive = alive[np.lexsort((words[alive, step], group[alive]))]
        g, word = group[alive], words[alive, step]
        begin = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (word[1:] != word[:-1])])
        number = np.repeat(np.arange(len(begin)), np.diff(np.r_[begin, len(alive)]))
        low, high = (best_of.reduceat(doc_id[alive], begin) for best_of in (np.minimum, np.maximum))
        stays = ((low != high) & np.logical_or.reduceat(place[alive] > 0, begin))[number]
        alive, kept = alive[stays], low[number[stays]]
        group[alive] = number[stays]
        take(alive[(place[alive] > 0) & (length[alive] > 0) & (best[alive] != kept)])
        best[alive], length[alive] = kept, step + 1
    take(np.flatnonzero((place > 0) & (length > 0)))
    return [np.concatenate(c) for c in zip(*found)]


def _longest(k: int, w: int):
    """Rows of ``_grower`` sorted by key -> the grown anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rest = [c.split()[0] for c in _GROWN.split(", ")], None
        done = lambda rows: pa.RecordBatch.from_arrays(list(map(pa.array, longest(*_around(rows, w - 1), k))), names=names)
        for batch in batches:
            rows = pa.concat_batches([rest, batch]) if rest is not None and rest.num_rows else batch
            key = rows.column(0).to_numpy()
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0  # a key may go on in the next batch
            if last:
                yield done(rows.slice(0, last))
            rest = rows.slice(last)
        if rest is not None and rest.num_rows:
            yield done(rest)
        release_memory()

    return run


def _lengths(k: int, w: int, edges: bool = False):
    """A row for every length, with a key of the anchor and its words: of rows of ``_grower`` the spans, of aggregated ones their smallest and largest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in (_EDGES if edges else _LENGTHS).split(", ")]
        for batch in slices(batches, 4096):
            key, after, size, low, high, words = _around(batch, w - 1)  # of an edge: its id and place
            now = key.view(np.uint64)
            for step in range(w - 1):
                now = mixed(now * np.uint64(_BASE) + words[:, step])
                i = np.flatnonzero(size > step)
                rest = _span(high[i], after[i], np.full(len(i), step + 1), k) if edges else [high[i]]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, [now[i].view(np.int64), low[i], *rest])), names=names)

    return run


def _repeated(pieces: DataFrame, key: str) -> DataFrame:
    """(key, kept) of what occurs in two documents or more."""
    return pieces.groupBy(key).agg(F.min("doc_id").alias("kept"), F.max("doc_id").alias("other")).filter("kept <> other").drop("other")


def with_keeper(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key occurs in two documents or more, with the smallest id among these as ``kept``.

    The rows are moved once, by their key. What some task marked as common is aggregated before it is moved instead, and
    joined with the few results, so that no key, however frequent, meets in one task.
    """
    common = durable(rows.filter("common").select(key).distinct())
    frequent = rows.join(common, key, "left_semi").drop("common")
    by_key = Window.partitionBy(key)
    rest = (
        rows.join(common, key, "left_anti").drop("common")
        .withColumn("kept", F.min("doc_id").over(by_key)).withColumn("other", F.max("doc_id").over(by_key))
        .filter("kept <> other").drop("other"))
    return rest.unionByName(frequent.join(durable(_repeated(frequent, key)), key))


def grown_anchors(docs: DataFrame, found: DataFrame, k: int, w: int) -> DataFrame:
    """(doc_id, first, last, kept): repeated anchors at the ends of runs of such, with the words around them that are repeated too."""
    by_place = Window.partitionBy("doc_id").orderBy("first")  # bounded by the document's own length
    placed = durable(
        found.select("doc_id", "first", "last", "sentence").distinct()
        .withColumn("head", F.coalesce(F.col("first") > F.lag("last").over(by_place), F.lit(True)))
        .withColumn("tail", F.coalesce(F.lead("first").over(by_place) > F.col("last"), F.lit(True))))
    # all places of an anchor that ends a run somewhere
    ends = durable(placed.filter("head or tail").groupBy("sentence").agg(F.max("head").alias("left"), F.max("tail").alias("right")))
    places = placed.join(ends, "sentence").groupBy("doc_id").agg(
        F.collect_list(F.struct("first", "sentence", "left", "right", "head", "tail")).alias("places"))
    around = durable(
        own_columns(docs, "doc_id", "text").filter("text is not null").join(places, "doc_id")
        .select("doc_id", "text", "places").mapInArrow(_grower(k, w), _AROUND))
    common = durable(around.filter("common").select("key").distinct())
    rest = (
        around.join(common, "key", "left_anti").select(*around.columns[:-1])
        .repartition("key").sortWithinPartitions("key").mapInArrow(_longest(k, w), _GROWN))
    # what is common meets in no task: equal words around an anchor are one row before lengths are made of them, edges are joined with the results
    frequent = around.join(common, "key", "left_semi").select(*around.columns[:-1])
    alike = frequent.groupBy("key", "after", "size", "words").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    kept = durable(
        alike.select("key", "after", "size", "low", "high", "words").mapInArrow(_lengths(k, w), _LENGTHS)
        .groupBy("key").agg(F.min("low").alias("kept"), F.max("high").alias("other")).filter("kept <> other").drop("other"))
    edges = frequent.filter("place > 0").mapInArrow(_lengths(k, w, True), _EDGES)
    return rest.unionByName(edges.join(kept, "key").select("doc_id", "first", "last", "kept"))


def _shingler(least_words: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            h, lines, _ = layout(raw(batch.column(0)))
            first = np.r_[0, lines[:-1]].astype(np.int64)[: len(lines)]
            wide = lines - first >= least_words
            if wide.any():
                values, begin, name = paragraph_sets(h, first[wide], lines[wide])
                sets = pa.ListArray.from_arrays(pa.array(np.r_[begin, len(values)].astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([_names(name), sets], names=["node", "shingles"])

    return cut


def _verifier(threshold: float):
    """Rows sorted by (band, key, i, j): a run is two chunks of one bucket, or one. Gives a spanning forest of the links."""

    def compare(run: list[tuple]) -> list[tuple[bytes, bytes]]:
        run.sort(key=lambda r: r[2])
        sets = [np.asarray(r[3]) for r in run]
        i, j = run[0][1][2:]
        left = np.array([k for k, r in enumerate(run) if r[0] == i], dtype=np.int64)
        right = np.array([k for k, r in enumerate(run) if r[0] == j], dtype=np.int64)
        size = np.array([len(s) for s in sets])
        common = intersections(sets, left, right)
        linked = common >= threshold * (size[left][:, None] + size[right][None, :] - common) - 1e-9
        if i == j:
            np.fill_diagonal(linked, False)
        root = spanning(len(run), left, right, linked)
        return [(run[k][2], run[r][2]) for k, r in enumerate(root) if k != r]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[tuple] = []
        for batch in slices(batches, 2048):
            band, key, i, j, chunk, node = [batch.column(k).to_pylist() for k in range(6)]
            sets, out = batch.column(6), []
            for k, bucket in enumerate(zip(band, key, i, j)):
                if run and run[0][1] != bucket:
                    out += compare(run)
                    run = []
                run.append((chunk[k], bucket, node[k], sets[k].values.to_numpy()))
            yield _edges(out)
        if run:
            yield _edges(compare(run))

    return verify


def _edges(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)], names=["a", "b"])


def near_paragraphs(docs: DataFrame, nodes: DataFrame, threshold: float, least_words: int, chunk: int) -> DataFrame:
    """Verified links (a, b) between colliding paragraphs, as spanning forests."""
    keys = nodes.select("node", F.explode("bands").alias("key"))
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = durable(keys.join(sizes, "key"))
    wanted = durable(members.select("node").distinct())
    # shingles of colliding paragraphs only, from the first document that holds each
    texts = own_columns(docs, "doc_id", "text").filter("text is not null").join(
        nodes.join(wanted, "node").select(F.col("keep").alias("doc_id")).distinct(), "doc_id", "left_semi").select("text")
    sets = texts.mapInArrow(_shingler(least_words), "node binary, shingles array<bigint>").join(wanted, "node", "left_semi").dropDuplicates(["node"])
    # buckets of two are pairs: one that collides in several bands is compared once
    pairs = members.filter("n = 2").groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("m")).select("m").distinct().select(
        F.lit(-1).alias("band"), F.xxhash64("m").alias("key"), F.explode("m").alias("node"), F.lit(0).alias("chunk"), F.lit(0).alias("i"), F.lit(0).alias("j"))
    # every other paragraph goes to the pairs of chunks of its bucket that its own chunk is in
    dealt = (
        members.filter("n > 2").withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int"))
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        .select(F.lit(0).alias("band"), "key", "node", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select("band", "key", "node", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
        .unionByName(pairs))
    blocks = (
        dealt.join(sets, "node").select("band", "key", "i", "j", "chunk", "node", "shingles")
        .repartition("band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j"))
    return durable(blocks.mapInArrow(_verifier(threshold), "a binary, b binary").distinct())


def repeated_passages(docs: DataFrame, threshold: float = 0.8, recall: float = 0.999, least_words: int = 20,
                      least_sentence: int = 6, longest_sentence: int = 30, least_span: int = 30, gap: int = 8, chunk: int = 512, seed: int = 2) -> DataFrame:
    """(doc_id, first_word, last_word (exclusive), n_words, n_removed, kept_doc_id) of every repeated passage."""
    rows, bands = tune_bands(threshold, recall)
    w = (least_span + 1) // 2
    k = least_span + 1 - w
    pieces = durable(own_columns(docs, "doc_id", "text").filter("doc_id is not null").mapInArrow(
        _cutter(least_words, least_sentence, longest_sentence, rows * bands, rows, seed, k, w), _PIECES))
    lines, parts = pieces.filter("node is not null"), pieces.filter("node is null")
    # equal sets have equal bands; as a part of the key they need no sorting
    nodes = durable(lines.groupBy("node", "bands").agg(F.min("doc_id").alias("keep"), F.max("doc_id").alias("other")))
    roots = connected_components(near_paragraphs(docs, nodes, threshold, least_words, chunk))
    placed = nodes.select("node", "keep", "other").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    clusters = placed.groupBy("root").agg(F.min("keep").alias("kept"), F.max("other").alias("other")).filter("kept <> other")
    owner = durable(placed.select("node", "root").join(clusters.select("root", "kept"), "root").select("node", "kept"))
    lines = durable(lines.select("doc_id", "node", "first", "last"))
    twice = durable(with_keeper(parts.drop("node", "bands"), "sentence"))
    discard(pieces)  # the largest table, before the anchors are grown
    found = (
        lines.join(owner, "node").select("doc_id", "first", "last", "kept")
        .union(twice.select("doc_id", "first", "last", "kept"))
        .union(grown_anchors(docs, twice.filter("anchor"), k, w))
        .distinct())  # repeated rows of a document, before it is put together
    # a document's pieces are bounded by its own length
    by_place = Window.partitionBy("doc_id").orderBy("first", "last", "kept")
    reach = F.max("last").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    islands = (
        found.withColumn("reach", reach)
        .withColumn("new", (F.col("reach").isNull() | (F.col("first") > F.col("reach") + gap)).cast("int"))
        .withColumn("lost", F.max(F.when(F.col("kept") != F.col("doc_id"), F.col("last"))).over(by_place.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("fresh", F.greatest(F.lit(0), F.col("last") - F.greatest("first", F.coalesce("lost", "first"))))
        .withColumn("island", F.sum("new").over(by_place)))
    return (
        islands.groupBy("doc_id", "island")
        .agg(F.min("first").alias("first_word"), F.max("last").alias("last_word"),
             F.sum(F.when(F.col("kept") != F.col("doc_id"), F.col("fresh")).otherwise(0)).alias("n_removed"), F.min("kept").alias("kept_doc_id"))
        .withColumn("n_words", F.col("last_word") - F.col("first_word"))
        .filter(F.col("n_words") >= least_span)
        .select("doc_id", "first_word", "last_word", "n_words", "n_removed", "kept_doc_id"))
