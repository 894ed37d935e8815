"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Texts are sets of ``words``-word shingles. Every set has ``trees`` labels of ``depth`` MinHash values; a tree is the sorted
trie of its labels, so the sets that share a prefix of length d are one node at level d. The join starts with the
longest prefixes and shortens them level by level. At each level only pairs are looked at that share a prefix in some
tree for the first time, and every one is verified on the whole shingle sets. A link of similarity J is found down to
level d with probability 1 - (1 - J^d)^trees, and the join goes down to the level where that reaches ``recall`` for a link
at the threshold. So the chance to find a link depends on its own similarity alone, not on what else the table holds.

Equal sets are one node with a number of copies, so copies are never expanded into pairs. A trie node of at most
``small`` sets gives its pairs, which are compared by signature (those far from the threshold go) and then exactly. A
larger one is cut by hash into chunks of about ``chunk`` sets and ``chunk_shingles`` shingles; a task compares two chunks and returns counts of links and a spanning
forest, at most one row per set. So no group is ever gathered whole, and no pairs of a large group are written.

Words are what stands between white space, as they are. NULL and empty texts have no shingles and no links; fewer words
than a shingle are one shingle; repeated rows and rows without an id are copies like others (a class is named by the
smallest id in it, NULL if it has none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsurvey.llm.common import WordHashes, own_columns, raw, release_memory, shingles, slices
from cellsurvey.llm.components import connected_components
from cellsurvey.session import durable


def hash_family(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1 << 62, size=count, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(1 << 63, size=count, dtype=np.uint64)


def minhash(values: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Smallest 32-bit hash of the values under each function of the family."""
    best = np.full(len(family[0]), np.iinfo(np.uint64).max)
    for start in range(0, len(values), 1024):
        part = values[start : start + 1024, None] * family[0] + family[1]
        np.minimum(best, part.min(axis=0), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)


def _sets(texts: list[bytes | None], words: int, table: WordHashes) -> Iterator[np.ndarray]:
    for text in texts:
        yield np.unique(shingles(table.of(text.split()), words)) if text else np.empty(0, np.uint64)


def _digest(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def _signer(words: int, count: int, seed: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, family = WordHashes(), hash_family(count, seed)
        for batch in slices(batches):
            rows = [(_digest(s), len(s), minhash(s, family).view(np.int32) if len(s) else None) for s in _sets(raw(batch.column(1)), words, table)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.list_(pa.int32()))],
                names=["doc_id", "node", "size", "label"])
        table.clear()
        release_memory()

    return sign


def _shingler(words: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes()
        for batch in slices(batches):
            found = list(_sets(raw(batch.column(0)), words, table))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(s) for s in found], pa.binary()), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))],
                names=["node", "shingles"])
        table.clear()
        release_memory()

    return cut


class Forest:
    """Parameters of a join, and what follows from them."""

    def __init__(self, words: int, threshold: float, recall: float, trees: int, depth: int, small: int, chunk: int,
                 chunk_shingles: int, seed: int):
        self.words, self.threshold, self.recall = words, threshold, recall
        self.trees, self.depth, self.small, self.seed = trees, depth, small, seed
        self.chunk, self.chunk_shingles = chunk, chunk_shingles

    def found(self, similarity, level: int):
        """Probability that a pair has shared a prefix of this length in some tree."""
        return 1 - (1 - similarity**level) ** self.trees

    def levels(self) -> list[int]:
        """Prefix lengths to go through, down to the first at which a link at the threshold is found with the target recall."""
        enough = [d for d in range(1, self.depth + 1) if self.found(self.threshold, d) >= self.recall]
        return list(range(self.depth, max(enough, default=1) - 1, -1))

    def least_matches(self) -> int:
        """Equal signature values below which a pair at the threshold falls with a probability under 1e-9."""
        n = self.trees * self.depth
        return int(n * self.threshold - 6 * (n * self.threshold * (1 - self.threshold)) ** 0.5)

    def prefix(self, label: str, tree: Column, level: int) -> Column:
        return F.slice(F.col(label), tree * self.depth + 1, F.lit(level))

    def shared(self, a: str, b: str, trees: Column, level: int) -> Column:
        return F.exists(trees, lambda t: self.prefix(a, t, level) == self.prefix(b, t, level))


def compare_chunks(forest: Forest, level: int):
    """Verify all new pairs of two chunks of one trie node (or of one chunk)."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tree, i, j = int(key[0]), int(key[2]), int(key[3])
        pdf = pdf.sort_values("node", kind="stable", ignore_index=True)
        left = np.flatnonzero((pdf["chunk"] == i).to_numpy())
        right = np.flatnonzero((pdf["chunk"] == j).to_numpy())
        labels = np.stack(list(pdf["label"])).reshape(len(pdf), forest.trees, forest.depth)
        new = np.ones((len(left), len(right)), bool)
        owner = np.full(new.shape, -1, np.int16)
        hot = np.zeros((len(pdf), forest.trees), bool)
        for row, trees in enumerate(pdf["hot"]):
            hot[row, trees] = True
        for t in range(forest.trees):
            same = np.ones(new.shape, bool)
            for d in range(level):
                same &= labels[left, t, d][:, None] == labels[right, t, d][None, :]
            # a pair is looked at once: in the first large node it shares at this level
            owner[same & hot[left, t][:, None] & (owner < 0)] = t
            if level < forest.depth:
                new &= ~(same & (labels[left, t, level][:, None] == labels[right, t, level][None, :]))
        new &= owner == tree
        if i == j:
            new &= left[:, None] < right[None, :]
        common = intersections(list(pdf["shingles"]), left, right)
        size = pdf["size"].to_numpy()
        union = size[left][:, None] + size[right][None, :] - common
        linked = new & (common >= forest.threshold * union - 1e-9)
        copies = pdf["copies"].to_numpy()
        links = np.zeros(len(pdf), np.int64)
        np.add.at(links, left, (linked * copies[right][None, :]).sum(axis=1))
        np.add.at(links, right, (linked * copies[left][:, None]).sum(axis=0))
        root = spanning(len(pdf), left, right, linked)
        nodes = pdf["node"].to_numpy()
        out = pd.DataFrame({"node": nodes, "root": nodes[root], "links": links})
        return out[out["links"] > 0]

    return run


def intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, width: int = 2048) -> np.ndarray:
    """Sizes of all intersections, as products of 0/1 matrices over slices of the shared shingles."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, columns, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1  # shingles of one set alone cannot be common
    keep = counts[columns] > 1
    rows, columns = rows[keep], number[columns[keep]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    out = np.zeros((len(left), len(right)))
    for start in range(0, int(columns[-1]) + 1 if len(columns) else 0, width):
        a, b = np.searchsorted(columns, (start, start + width))
        has = np.zeros((len(sets), width), np.float32)
        has[rows[a:b], columns[a:b] - start] = 1
        out += has[left] @ has[right].T
        del has
    return out


def spanning(n: int, left: np.ndarray, right: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Smallest row that each row is connected with."""
    label = np.arange(n)
    while True:
        before = label.copy()
        l = np.where(linked, label[right][None, :], n).min(axis=1, initial=n)
        np.minimum.at(label, left, l)
        r = np.where(linked, label[left][:, None], n).min(axis=0, initial=n)
        np.minimum.at(label, right, r)
        label = label[label]
        if (label == before).all():
            return label


def _level(forest: Forest, docs: DataFrame, nodes: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Of the pairs first seen at this level: (node, links) counts, and edges (a, b)."""
    trees = F.sequence(F.lit(0), F.lit(forest.trees - 1))
    keys = nodes.select("node", "size", F.posexplode(F.transform(trees, lambda t: F.xxhash64(t, forest.prefix("label", t, level)))).alias("tree", "key"))
    sizes = keys.groupBy("tree", "key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("sum")).filter("n > 1")
    members = durable(keys.drop("size").join(sizes, ["tree", "key"]))
    hot = durable(members.filter(F.col("n") > forest.small).groupBy("node").agg(F.sort_array(F.collect_set("tree")).alias("hot")))  # of at most ``trees`` values
    lists = members.filter(F.col("n") <= forest.small).groupBy("tree", "key").agg(F.sort_array(F.collect_list("node")).alias("m"))
    pairs = lists.select(F.explode(F.flatten(F.transform(
        "m", lambda x, i: F.transform(F.slice(F.col("m"), i + 2, F.greatest(F.size("m") - i - 1, F.lit(0))), lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("p")
    ).select("p.*").distinct()
    known = nodes.join(hot, "node", "left")
    side = lambda s: known.select(F.col("node").alias(s), F.col("label").alias(f"label_{s}"), F.col("hot").alias(f"hot_{s}"))
    seen = forest.shared("label_a", "label_b", trees, level + 1) if level < forest.depth else F.lit(False)
    elsewhere = F.coalesce(forest.shared("label_a", "label_b", F.col("hot_a"), level), F.lit(False))
    equal = F.size(F.filter(F.zip_with("label_a", "label_b", lambda x, y: x == y), lambda x: x))
    close = durable(
        pairs.join(side("a"), "a").join(side("b").drop("hot_b"), "b")
        .filter((equal >= forest.least_matches()) & ~seen & ~elsewhere).select("a", "b"))
    # shingles of the sets that are still in question, cut once more from the texts of their first documents
    wanted = durable(
        close.select(F.col("a").alias("node")).union(close.select("b")).union(hot.select("node")).distinct()
        .join(nodes.select("node", "first"), "node"))
    text = own_columns(docs, "doc_id", "text").join(
        wanted.select(F.col("first").alias("f")).distinct(), F.col("doc_id").eqNullSafe(F.col("f")), "left_semi").select("text")
    cut = text.mapInArrow(_shingler(forest.words), "node binary, shingles array<bigint>").join(wanted.select("node"), "node", "left_semi")
    sets = durable(cut.dropDuplicates(["node"]).join(known, "node").select("node", "shingles", "label", "hot", "size", "copies"))

    of = lambda s: sets.select(F.col("node").alias(s), F.col("shingles").alias(f"s_{s}"), F.col("size").alias(f"n_{s}"), F.col("copies").alias(f"c_{s}"))
    common = F.size(F.array_intersect("s_a", "s_b"))
    union = F.col("n_a") + F.col("n_b") - F.col("common")
    near = durable(
        close.join(of("a"), "a").join(of("b"), "b").withColumn("common", common)
        .filter(F.col("common") >= forest.threshold * union - 1e-9)
        .select("a", "b", "c_a", "c_b"))
    # large trie nodes: every set goes to the pairs of chunks its own chunk is in
    chunks = F.greatest(F.ceil(F.col("n") / forest.chunk), F.ceil(F.col("sum") / forest.chunk_shingles)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    dealt = (
        members.filter(F.col("n") > forest.small).withColumn("chunks", chunks).withColumn("chunk", own)
        .select("tree", "key", "node", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select("tree", "key", "node", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j")))
    blocks = durable(
        dealt.join(sets, "node").groupBy("tree", "key", "i", "j")
        .applyInPandas(compare_chunks(forest, level), "node binary, root binary, links bigint"))
    counts = blocks.select("node", "links").union(near.select("a", "c_b")).union(near.select("b", "c_a"))
    edges = near.select("a", "b").union(blocks.filter("node <> root").select("node", "root"))
    return counts, edges


def jaccard_classes(docs: DataFrame, words: int = 5, threshold: float = 0.8, recall: float = 0.9999, trees: int = 12,
                    depth: int = 4, small: int = 24, chunk: int = 768, chunk_shingles: int = 400_000, seed: int = 1) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, n_links (rows with similarity >= threshold), n_copies (equal sets)."""
    forest = Forest(words, threshold, recall, trees, depth, small, chunk, chunk_shingles, seed)
    signed = durable(own_columns(docs, "doc_id", "text").mapInArrow(
        _signer(words, trees * depth, seed), "doc_id bigint, node binary, size bigint, label array<int>"))
    nodes = durable(
        signed.filter("size > 0").groupBy("node")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first"), F.first("size").alias("size"), F.first("label").alias("label")))
    counts, edges = None, None
    for level in forest.levels():
        c, e = _level(forest, docs, nodes, level)
        counts, edges = (c, e) if counts is None else (counts.union(c), edges.union(e))
    linked = counts.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(edges)
    known = durable(
        nodes.select("node", "copies", "first").join(linked, "node", "left").join(roots, "node", "left")
        .select("node", "copies", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root")))
    classes = known.groupBy("root").agg(F.min("first").alias("class_id"))
    named = known.join(classes, "root").select("node", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "copies")
    return signed.select("doc_id", "node", "size").join(named, "node", "left").select(
        "doc_id", F.when(F.col("size") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("copies", F.lit(1)).alias("n_copies"))


def keep_one(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id.

    Rows without an id stay, they cannot be referred to. An id goes if none of its rows names a class; an id
    that has several rows keeps one of each text.
    """
    rows = classes.filter("doc_id is not null").groupBy("doc_id").agg(
        F.bool_and(F.col("doc_id") != F.col("class_id")).alias("goes"), (F.count(F.lit(1)) > 1).alias("repeated"))
    marked = durable(rows.filter("goes or repeated"))
    kept = docs.join(marked.filter("goes").select("doc_id"), "doc_id", "left_anti")
    repeated = marked.filter("repeated and not goes").select("doc_id")
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(
        kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns))
