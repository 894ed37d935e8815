"""Spelling variants of the words of a corpus.

Letters are hashed to a few symbols. Every distinct reduced word is joined with all reduced words that lie in its full one-edit
neighbourhood; the words behind such a pair are compared as they are. Two words that differ by one edit always reduce to equal
words or to words that differ by one edit, so none is lost, and the neighbourhood of a word of n letters has about 16 n entries
instead of the several hundred times n over the whole alphabet.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsurvey.llm.common import own_columns, raw, slices
from cellsurvey.session import durable

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_KEPT_WORDS = 1 << 18  # distinct words a task counts before it hands them on
_MULTIPLIER = 0x9E3779B97F4A7C15

#: A-Z to a-z, other ASCII to a blank; for texts whose only letters beyond ASCII are U+00C0 to U+00FF (lead byte C3)
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_OTHER_LEADS = bytes(c for c in range(0xC2, 0xF5) if c != 0xC3)
_LOWER = {c: c + 32 for c in range(65, 91)}


def runs(text: bytes) -> list[bytes]:
    """Maximal runs of letters, A-Z lower-cased, as UTF-8."""
    if len(text.translate(None, _OTHER_LEADS)) == len(text):
        return text.translate(_LETTERS).split()
    return [w.encode() for w in _RUN.findall(text.decode().translate(_LOWER))]


def _count(drop_one_in: int, least_length: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = defaultdict(int)

        def handed() -> pa.RecordBatch:
            kept = {w: n for w, n in seen.items() if len(w) >= least_length and len(w.decode()) >= least_length}
            seen.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(kept), pa.binary()).cast(pa.string()), pa.array(list(kept.values()), pa.int64())], names=["word", "n"])

        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), raw(batch.column(1))):
                start = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id) if drop_one_in else 0
                start = zlib.crc32(b":", start)
                for word, n in Counter(runs(text or b"")).items():
                    h = zlib.crc32(word, start)
                    if drop_one_in and h % drop_one_in == 0:
                        letters = word.decode()
                        at = h % len(letters)
                        word = (letters[:at] + letters[at + 1 :]).encode()
                    seen[word] += n
            if len(seen) > _KEPT_WORDS:
                yield handed()
        yield handed()

    return count


def vocabulary(docs: DataFrame, least_length: int = 5, least_count: int = 3, drop_one_in: int = 0) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text) with enough letters and occurrences.

    A word is a maximal run of ``[A-Za-z\\u00C0-\\u00FF]``, with A-Z lower-cased. With ``drop_one_in`` = d every run whose crc32 (of
    ``<doc_id>:<run>``) is divisible by d loses the letter that the crc32 points at, which plants variants to be found again; a NULL
    id is an empty one. NULL texts have no words; repeated rows count each time.
    """
    counted = own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        _count(drop_one_in, least_length), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _symbols(words: list[str], length: int, symbols: int) -> np.ndarray:
    """Symbols 1 to ``symbols`` of words of one length, a row a word."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, length).astype(np.uint64)
    return (points * np.uint64(_MULTIPLIER) >> np.uint64(40)) % np.uint64(symbols) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _MULTIPLIER, np.uint64)]), dtype=np.uint64)


def reduced_keys(marks: np.ndarray) -> np.ndarray:
    """64-bit keys of reduced words. Equal words have equal keys; a chance collision only adds a pair that is then rejected."""
    length = marks.shape[1]
    return (marks * _powers(length)[:length][::-1]).sum(axis=1, dtype=np.uint64)


def neighbourhood_keys(marks: np.ndarray, symbols: int) -> np.ndarray:
    """Keys of everything within one edit of each reduced word: itself, deletions, replacements and insertions (with repetitions)."""
    n, length = marks.shape
    power = _powers(length + 1)
    before, after = np.zeros((n, length + 1), np.uint64), np.zeros((n, length + 1), np.uint64)
    for i in range(length):
        before[:, i + 1] = before[:, i] * power[1] + marks[:, i]
    for i in range(length - 1, -1, -1):
        after[:, i] = marks[:, i] * power[length - 1 - i] + after[:, i + 1]
    letters = np.arange(1, symbols + 1, dtype=np.uint64)
    keys = [before[:, length:]]
    for i in range(length):
        rest = after[:, i + 1 : i + 2]
        keys += [before[:, i : i + 1] * power[length - 1 - i] + rest, before[:, i : i + 1] * power[length - i] + letters * power[length - 1 - i] + rest]
    for i in range(length + 1):
        keys.append(before[:, i : i + 1] * power[length + 1 - i] + letters * power[length - i] + after[:, i : i + 1])
    return np.concatenate(keys, axis=1)


def _by_length(words: list[str], most: int = 1 << 16):
    """Positions of words of equal length, few enough at a time to bound the arrays made of them."""
    places = defaultdict(list)
    for i, w in enumerate(words):
        places[len(w)].append(i)
    for length, at in places.items():
        step = max(1, most // max(length, 1) ** 2)
        for k in range(0, len(at), step):
            yield length, at[k : k + step]


def _reduce(symbols: int):
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16_384):
            words = batch.column(0).to_pylist()
            keys = np.empty(len(words), np.uint64)
            for length, at in _by_length(words):
                keys[at] = reduced_keys(_symbols([words[i] for i in at], length, symbols))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys.view(np.int64))], names=[*batch.schema.names, "reduced"])

    return reduce


def _surround(symbols: int):
    def surround(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            words, own = batch.column(1).to_pylist(), batch.column(0).to_numpy(zero_copy_only=False)
            for length, at in _by_length(words):
                keys = np.sort(neighbourhood_keys(_symbols([words[i] for i in at], length, symbols), symbols), axis=1)
                first = np.ones(keys.shape, bool)
                first[:, 1:] = keys[:, 1:] != keys[:, :-1]
                ends = np.concatenate([[0], np.cumsum(first.sum(axis=1))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[at]), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[first].view(np.int64)))], names=["reduced", "near"])

    return surround


def near_words(words: DataFrame, symbols: int = 8) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of ``words`` (word, n) that differ by exactly one inserted, deleted or replaced code point.

    Words have to be distinct and not NULL. Pairs of reduced words are few (a dozen per word); words are joined to both ends of such a
    pair and compared in the same stage, so only true pairs go on. ``symbols`` trades the size of the neighbourhoods for the number of
    words that reduce to the same one.
    """
    words = durable(words.select("word", "n").mapInArrow(_reduce(symbols), "word string, n bigint, reduced bigint"))
    distinct = words.groupBy("reduced").agg(F.min("word").alias("sample"))
    around = distinct.mapInArrow(_surround(symbols), "reduced bigint, near array<bigint>").select("reduced", F.explode("near").alias("other"))
    pairs = durable(around.join(words.select(F.col("reduced").alias("other")).distinct(), "other"))
    other = words.select(F.col("reduced").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return (words.join(pairs, "reduced").join(other, "other")
            .filter((F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1)).select("word", "n", "near", "near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): ``forms`` (word, form) followed to the last. A form is always more frequent than its word, so there are no circles;
    each round doubles the steps taken, and the longest chain is bounded by the logarithm of the largest count."""
    current = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = durable(current.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")))
        current = moved.select("word", "root")
        if not moved.filter("went").take(1):
            return current


def variant_groups(docs: DataFrame, least_length: int = 5, least_count: int = 3, least_ratio: int = 2, drop_one_in: int = 0,
                   symbols: int = 8) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    The form is the near word of largest n (ties: smallest in code-point order) if it occurs at least ``least_ratio`` (more than 1) times
    as often as the word, else NULL. The root is where following forms ends. An empty table gives no rows. Columns other than
    doc_id and text are not read.
    """
    if least_ratio <= 1:
        raise ValueError("least_ratio has to be above 1: forms must not go in circles")
    words = durable(vocabulary(docs, least_length, least_count, drop_one_in))
    best = near_words(words, symbols).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    joined = durable(words.join(best, "word", "left").withColumn("best_n", -F.col("best.minus")).withColumn(
        "form", F.when(F.col("best_n") >= least_ratio * F.col("n"), F.col("best.near"))))
    found = roots(joined.filter("form IS NOT NULL"))
    return joined.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"))
