"""Similarity networks between cells: neighbours, neighbour voting, pairwise correlation, components.

Work over all pairs of cells runs on pairs of blocks. A block holds about ``block`` cells of one
project, chosen by hash, so no block grows with the data and a large project becomes many block
pairs. A task compares two blocks with numpy and emits only what the result needs (k neighbours,
sums or extremes per cell), never the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellsurvey.functions import fixed_values as fixed
from cellsurvey.functions.numeric import normal_upper_tail
from cellsurvey.functions.ranking import average_rank, number_rows, running_totals, tie_histogram
from cellsurvey.operators.decomposition import components, components_with_basis  # noqa: F401
from cellsurvey.operators.ledger import distinct_terms
from cellsurvey.operators.neighbours import approximate_neighbours
from cellsurvey.session import durable

CELL = ["proj_id", "cell_id"]


# ---------------------------------------------------------------- block pairs

def _place(rows: DataFrame, cells: DataFrame, block: int) -> DataFrame:
    """Give every row the block of its cell; the number of blocks follows the project's size."""
    n = durable(cells.groupBy("proj_id").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("__blocks")))
    return rows.join(n, "proj_id").withColumn("__block", F.pmod(F.xxhash64("cell_id"), F.col("__blocks")).cast("int"))


def _packed(rows: pd.DataFrame) -> bytes:
    """The rows of a block as one compressed Arrow stream."""
    table, sink = pa.Table.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(table)
    return sink.getvalue().to_pybytes()


def _pack_blocks(placed: DataFrame) -> DataFrame:
    """(proj_id, block, blocks, data): a row per block, so what is sent on is rows in the square of the blocks, not of the cells."""
    columns = [c for c in placed.columns if c not in ("proj_id", "__block", "__blocks")]

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"proj_id": [key[0]], "block": [key[1]], "blocks": [pdf["__blocks"].iloc[0]], "data": [_packed(pdf[columns])]})

    return durable(placed.groupBy("proj_id", "__block").applyInPandas(pack, "proj_id string, block int, blocks int, data binary"))


def _on_block_strips(placed: DataFrame, fn: Callable, schema: str, strip: int) -> DataFrame:
    """Run ``fn(own, partners)`` for every block and every strip of ``strip`` partner blocks (itself among them) of its project.

    The partners come one after the other, so a task can sum over all of them and a cell leaves once per strip, not once per block pair.
    """
    packed = _pack_blocks(placed)
    strips = F.ceil(F.col("blocks") / F.lit(strip)).cast("int")
    owners = packed.select("proj_id", "data", F.col("block").alias("bi"), F.explode(F.sequence(F.lit(0), strips - 1)).alias("strip"), F.lit(-1).alias("partner"))
    partners = packed.select(
        "proj_id", "data", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("bi"),
        F.floor(F.col("block") / F.lit(strip)).cast("int").alias("strip"), F.col("block").alias("partner"))
    names = [part.split()[0] for part in schema.split(", ")]

    def task(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("partner")
        if pdf["partner"].iloc[0] >= 0 or len(pdf) < 2:
            return pd.DataFrame(columns=names)  # a block without cells
        read = (pa.ipc.open_stream(data).read_pandas() for data in pdf["data"])
        out = fn(next(read), read)
        out.insert(0, "proj_id", key[0])
        return out

    return owners.unionByName(partners).groupBy("proj_id", "bi", "strip").applyInPandas(task, schema)


def _on_block_pairs(placed: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Run ``fn(left, right, same)`` on every unordered pair of blocks of a project."""
    names = [part.split()[0] for part in schema.split(", ")]
    packed = _pack_blocks(placed)
    own = F.col("block")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(
        F.least(own, other).alias("bi"), F.greatest(own, other).alias("bj"), (other < own).alias("second")
    ))
    sent = packed.select("proj_id", "data", F.explode(pairs).alias("p")).select("proj_id", "data", "p.*")

    def task(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        same = bool(key[1] == key[2])
        blocks = {bool(second): pa.ipc.open_stream(data).read_pandas() for second, data in zip(pdf["second"], pdf["data"])}
        if False not in blocks or not (same or True in blocks):
            return pd.DataFrame(columns=names)  # a block without cells
        out = fn(blocks[False], blocks[False] if same else blocks[True], same)
        out.insert(0, "proj_id", key[0])
        return out

    return sent.groupBy("proj_id", "bi", "bj").applyInPandas(task, schema)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances; pairs too close for the product form are computed from their difference."""
    aa, bb = (a * a).sum(1), (b * b).sum(1)
    scale, squared = aa[:, None] + bb[None, :], a @ b.T  # the only two arrays of all pairs
    squared *= -2.0
    squared += scale
    scale *= 1e-6
    i, j = np.nonzero(squared < scale)
    for s in range(0, len(i), 65536):
        d = a[i[s:s + 65536]] - b[j[s:s + 65536]]
        squared[i[s:s + 65536], j[s:s + 65536]] = (d * d).sum(1)
    return np.sqrt(np.maximum(squared, 0.0, out=squared), out=squared)


# ---------------------------------------------------------------- nearest neighbours

def nearest_neighbours(vectors: DataFrame, k: int = fixed.N_NEIGHBOURS, block: int = 2048, method: str = "exact") -> DataFrame:
    """The k nearest other cells of every cell (ties: smallest id), exact; with ``method="lsh"`` nearly so, by linear work.

    ``vectors(proj_id, cell_id, features array<double>)``. A task keeps k candidates per cell and block
    pair; the candidates of one cell are then cut to k.
    """
    if method != "exact":
        return approximate_neighbours(vectors, k)
    id_type = vectors.schema["cell_id"].dataType.simpleString()

    def top(ids: np.ndarray, own: np.ndarray, other: np.ndarray, a: np.ndarray, b: np.ndarray, dist: np.ndarray):
        if dist.shape[1] > k:
            bound = np.partition(dist, k - 1, axis=1)[:, k - 1]
            i, j = np.nonzero(dist <= bound[:, None] * (1 + 1e-9))
        else:
            i, j = np.nonzero(np.isfinite(dist))
        keep = np.isfinite(dist[i, j])
        i, j = i[keep], j[keep]
        exact = np.empty(len(i))
        for s in range(0, len(i), 65536):
            d = a[i[s:s + 65536]] - b[j[s:s + 65536]]
            exact[s:s + 65536] = np.sqrt((d * d).sum(1))
        order = np.lexsort((other[j], exact, i))
        i, j, exact = i[order], j[order], exact[order]
        start = np.r_[0, np.nonzero(np.diff(i))[0] + 1] if len(i) else np.array([], dtype=int)
        place = np.arange(len(i)) - np.repeat(start, np.diff(np.r_[start, len(i)]))
        near = place < k
        return pd.DataFrame({"cell_id": own[i[near]], "neighbour": other[j[near]], "distance": exact[near]})

    def task(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
        a, b = np.stack(left["features"].to_numpy()), np.stack(right["features"].to_numpy())
        ia, ib = left["cell_id"].to_numpy(), right["cell_id"].to_numpy()
        dist = _distances(a, b)
        if same:
            dist[ia[:, None] == ib[None, :]] = np.inf
        out = top(ia, ia, ib, a, b, dist)
        return out if same else pd.concat([out, top(ib, ib, ia, b, a, dist.T)], ignore_index=True)

    placed = _place(vectors.select(*CELL, "features"), vectors, block)
    found = _on_block_pairs(placed, task, f"proj_id string, cell_id {id_type}, neighbour {id_type}, distance double")
    w = Window.partitionBy(*CELL).orderBy("distance", "neighbour")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def symmetric_edges(neighbours: DataFrame) -> DataFrame:
    """Neighbour lists -> undirected weighted edges, both directions, weight 1 - distance / largest distance."""
    neighbours = durable(neighbours)  # read twice, and the search is the dear part
    largest = durable(neighbours.groupBy("proj_id").agg(F.max("distance").alias("__max")))
    weighted = neighbours.join(largest, "proj_id").select(
        "proj_id", F.col("cell_id").alias("src"), F.col("neighbour").alias("dst"),
        F.when(F.col("__max") > 0, 1 - F.col("distance") / F.col("__max")).otherwise(1.0).alias("w"),
    )
    both = weighted.unionByName(weighted.select("proj_id", F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    return both.groupBy("proj_id", "src", "dst").agg(F.max("w").alias("w"))


def similarity(edges: DataFrame, distance: str = "distance") -> DataFrame:
    """1 - distance / largest distance of the project."""
    edges = durable(edges)
    largest = durable(edges.groupBy("proj_id").agg(F.max(distance).alias("__max")))
    return edges.join(largest, "proj_id").withColumn(
        "w", F.when(F.col("__max") > 0, 1 - F.col(distance) / F.col("__max")).otherwise(1.0)
    ).drop("__max")


def rank_standardise(edges: DataFrame, value: str = "w", missing: float = 0.5) -> DataFrame:
    """Average-tie rank of the finite weights of a project scaled to [0, 1]; others become ``missing``."""
    finite = F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    known = edges.filter(finite)
    ranks = tie_histogram(known, ["proj_id"], value)
    top = durable(ranks.groupBy("proj_id").agg((F.max("rank") - 1).alias("__top")))
    scores = ranks.join(top, "proj_id").select(
        "proj_id", value, F.when(F.col("__top") > 0, (F.col("rank") - 1) / F.col("__top")).alias("standardised")
    )
    scaled = known.join(scores, ["proj_id", value])
    rest = edges.filter(~F.coalesce(finite, F.lit(False))).withColumn("standardised", F.lit(missing))
    return scaled.select(*edges.columns, "standardised").unionByName(rest)


# ---------------------------------------------------------------- membership

def membership(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(proj_id, node, term): one term per value of each column."""
    text = cells.select(*CELL, *[F.col(c).cast("string").alias(c) for c in columns])
    long = text.unpivot(CELL, list(columns), "variable", "value").filter(F.col("value").isNotNull())
    return long.select("proj_id", F.col("cell_id").alias("node"), F.concat_ws("=", "variable", "value").alias("term"))


def sized_terms(members: DataFrame, cells: DataFrame, min_count: int = 5, max_share: float = 0.95) -> DataFrame:
    """Terms with distinct member sets and min_count < size < ceil(max_share * cells)."""
    unique = distinct_terms(members)
    n = cells.groupBy("proj_id").agg(F.count(F.lit(1)).alias("__n"))
    sizes = unique.groupBy("proj_id", "term").agg(F.count(F.lit(1)).alias("__size")).join(n, "proj_id")
    kept = sizes.filter((F.col("__size") > min_count) & (F.col("__size") < F.ceil(F.col("__n") * max_share)))
    return unique.join(kept.select("proj_id", "term"), ["proj_id", "term"], "left_semi")


def with_folds(members: DataFrame, n_fold: int) -> DataFrame:
    """Number the members of a project in (node, term) order and deal them to the folds in turn."""
    numbered = number_rows(members, ["proj_id"], ["node", "term"], "__p")
    return numbered.select("proj_id", "node", "term", F.pmod(F.col("__p") - 1, F.lit(n_fold)).cast("int").alias("fold"))


# ---------------------------------------------------------------- neighbour voting

def _folds_to_auroc(scores: DataFrame, sizes: DataFrame) -> DataFrame:
    """AUROC of held-out members against non-members for every (term, fold).

    ``scores(proj_id, term, fold, score, positive)`` holds the candidates with a score above 0; the
    others tie at the bottom. ``sizes`` gives held-out members ``np`` and non-members ``nn``.
    """
    key = ["proj_id", "term", "fold"]
    hist = scores.groupBy(*key, "score").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("positive"), 1)).alias("hits"))
    run = running_totals(hist, key, ["score"], ["n"])
    per = run.groupBy(*key).agg(
        F.sum("n").alias("seen"), F.sum("hits").alias("hits"),
        F.sum(F.col("hits") * (F.col("n_before") + (F.col("n") + 1) / 2)).alias("ranks"),
    )
    np_, nn = F.col("np"), F.col("nn")
    zeros = np_ + nn - F.col("seen")
    total = F.col("ranks") + zeros * F.col("hits") + (np_ - F.col("hits")) * (zeros + 1) / 2
    return sizes.join(per, key, "left").na.fill(0, ["seen", "hits", "ranks"]).select(
        *key, "np", "nn", F.when((np_ > 0) & (nn > 0), (total / np_ - (np_ + 1) / 2) / nn).alias("auc")
    )


def _voting_result(fold_auc: DataFrame, degree: DataFrame, members: DataFrame, n_fold: int) -> DataFrame:
    np_, nn = F.col("np"), F.col("nn")
    z = F.abs(F.col("auc") * np_ * nn - np_ * nn / 2) / F.sqrt(np_ * nn * (np_ + nn + 1) / 12)
    cv = fold_auc.groupBy("proj_id", "term").agg(
        F.avg("auc").alias("auc"), (F.sum(z) / F.sqrt(F.lit(float(n_fold)))).alias("z")
    )
    ranked = average_rank(degree, ["proj_id"], "degree")
    n = degree.groupBy("proj_id").agg(F.count(F.lit(1)).alias("n_nodes"))
    own = (
        members.select("proj_id", "node", "term").join(ranked, ["proj_id", "node"])
        .groupBy("proj_id", "term").agg(
            F.avg("degree").alias("avg_node_degree"), F.sum("rank").alias("ranks"), F.count(F.lit(1)).alias("size"))
        .join(n, "proj_id")
    )
    size, others = F.col("size"), F.col("n_nodes") - F.col("size")
    null_auc = F.when(others > 0, (F.col("ranks") / size - (size + 1) / 2) / others)
    return cv.join(own.select("proj_id", "term", "avg_node_degree", null_auc.alias("degree_null_auc")), ["proj_id", "term"]).select(
        "proj_id", "term", "auc", "avg_node_degree", "degree_null_auc", normal_upper_tail("z").alias("p_value")
    )


def _fold_sizes(folds: DataFrame, nodes: DataFrame, n_fold: int) -> DataFrame:
    n = nodes.groupBy("proj_id").agg(F.count(F.lit(1)).alias("n_nodes"))
    size = folds.groupBy("proj_id", "term").agg(
        F.count(F.lit(1)).alias("size"), *[F.count(F.when(F.col("fold") == f, 1)).alias(f"f{f}") for f in range(n_fold)]
    ).join(n, "proj_id")
    per = F.array(*[F.struct(F.lit(f).alias("fold"), F.col(f"f{f}").alias("np")) for f in range(n_fold)])
    return size.select("proj_id", "term", "size", (F.col("n_nodes") - F.col("size")).alias("nn"), F.explode(per).alias("e")).select(
        "proj_id", "term", "e.fold", "e.np", "nn"
    )


def neighbour_voting(edges: DataFrame, nodes: DataFrame, members: DataFrame, n_fold: int = 3, digits: int = 10) -> DataFrame:
    """Neighbour voting on a sparse network: cross-validated AUROC, degree and p-value per term.

    ``edges(proj_id, src, dst, w)`` in both directions with positive weights, ``nodes(proj_id, node)``.
    Every node also has an edge of weight 1 to itself. Pairs without an edge weigh 0, so nodes without
    an edge into a term tie at score 0 and are never built.
    """
    loops = nodes.select("proj_id", F.col("node").alias("src"), F.col("node").alias("dst"), F.lit(1.0).alias("w"))
    all_edges = edges.filter((F.col("src") != F.col("dst")) & (F.col("w") > 0)).unionByName(loops)
    degree = all_edges.groupBy("proj_id", F.col("dst").alias("node")).agg(F.round(F.sum("w"), digits).alias("degree"))
    folds = durable(with_folds(members, n_fold))
    votes = (
        all_edges.join(folds.withColumnRenamed("node", "src"), ["proj_id", "src"])
        .groupBy("proj_id", F.col("dst").alias("node"), "term")
        .agg(*[F.sum(F.when(F.col("fold") != f, F.col("w"))).alias(f"s{f}") for f in range(n_fold)])
    )
    scores = _candidate_scores(votes, degree, folds, n_fold, digits).filter(F.col("score") > 0)
    auc = _folds_to_auroc(scores, _fold_sizes(folds, nodes, n_fold))
    return _voting_result(auc, degree, folds, n_fold)


def _candidate_scores(votes: DataFrame, degree: DataFrame, folds: DataFrame, n_fold: int, digits: int) -> DataFrame:
    """Training votes / degree of the candidates of each fold: non-members and held-out members."""
    own = folds.withColumnRenamed("fold", "own")
    per = F.array(*[F.struct(F.lit(f).alias("fold"), F.col(f"s{f}").alias("s")) for f in range(n_fold)])
    return (
        votes.join(degree, ["proj_id", "node"]).join(own, ["proj_id", "node", "term"], "left")
        .select("proj_id", "node", "term", "degree", "own", F.explode(per).alias("e"))
        .filter(F.col("own").isNull() | (F.col("own") == F.col("e.fold")))
        .select("proj_id", "term", F.col("e.fold").alias("fold"), "node",
                F.round(F.coalesce(F.col("e.s"), F.lit(0.0)) / F.col("degree"), digits).alias("score"),
                F.col("own").isNotNull().alias("positive"))
    )


def neighbour_voting_dense(
    vectors: DataFrame, members: DataFrame, n_fold: int = 3, block: int = 4096, digits: int = 10, strip: int = 16, rows_at_once: int = 256,
) -> DataFrame:
    """Neighbour voting on the full network of weights 1 - distance / largest distance.

    A node's votes only need the sum of its distances to the members of each fold, its sum over all
    nodes and the largest distance. A task sums them over a strip of ``strip`` partner blocks, so what is exchanged is
    cells x codes x strips; the n x n network never exists, and of a pair of blocks only the distances of ``rows_at_once`` cells do.
    """
    id_type = vectors.schema["cell_id"].dataType.simpleString()
    folds = durable(with_folds(members, n_fold))
    terms = number_rows(folds.select("proj_id", "term").distinct(), ["proj_id"], ["term"], "__t")
    coded = folds.join(terms, ["proj_id", "term"]).groupBy("proj_id", F.col("node").alias("cell_id")).agg(
        F.collect_list((F.col("__t") * n_fold + F.col("fold")).cast("int")).alias("codes")  # terms of one cell
    )
    rows = vectors.select(*CELL, "features").join(coded, CELL, "left")

    def sums(own: pd.DataFrame, partners: Iterable[pd.DataFrame]) -> pd.DataFrame:
        a = np.stack(own["features"].to_numpy())
        total, far = np.zeros((len(own), 1)), np.full(len(own), -1.0)  # over all cells first, then per code
        used = {0}
        for other in partners:
            b = np.stack(other["features"].to_numpy())
            lists = [np.asarray(c, dtype=int) if c is not None else np.array([], dtype=int) for c in other["codes"]]
            flat = np.concatenate(lists)
            if flat.max(initial=-1) + 2 > total.shape[1]:
                total = np.pad(total, ((0, 0), (0, flat.max() + 2 - total.shape[1])))
            marks = np.zeros((len(other), total.shape[1]))
            marks[:, 0] = 1.0
            marks[np.repeat(np.arange(len(other)), [len(x) for x in lists]), flat + 1] = 1.0
            used.update((flat + 1).tolist())
            for s in range(0, len(a), rows_at_once):
                dist = _distances(a[s:s + rows_at_once], b)
                total[s:s + rows_at_once] += dist @ marks
                far[s:s + rows_at_once] = np.maximum(far[s:s + rows_at_once], dist.max(1))
        columns = np.array(sorted(used))
        n, m = len(own), len(columns)
        largest = np.full((n, m), -1.0)
        largest[:, 0] = far
        return pd.DataFrame({
            "cell_id": np.repeat(own["cell_id"].to_numpy(), m), "code": np.tile(columns - 1, n).astype("int32"),
            "d": total[:, columns].ravel(), "far": largest.ravel(),
        })

    found = _on_block_strips(_place(rows, vectors, block), sums, f"proj_id string, cell_id {id_type}, code int, d double, far double", strip)
    summed = durable(found.groupBy(*CELL, "code").agg(F.sum("d").alias("d"), F.max("far").alias("far")))
    scale = durable(summed.filter(F.col("code") == -1).groupBy("proj_id").agg(F.max("far").alias("largest"), F.count(F.lit(1)).alias("n_nodes")))
    weight = lambda count, d: count - F.when(F.col("largest") > 0, d / F.col("largest")).otherwise(0.0)
    degree = summed.filter(F.col("code") == -1).join(scale, "proj_id").select(
        "proj_id", F.col("cell_id").alias("node"), F.round(weight(F.col("n_nodes"), F.col("d")), digits).alias("degree")
    )
    counts = folds.join(terms, ["proj_id", "term"]).groupBy("proj_id", "term", "__t", "fold").agg(F.count(F.lit(1)).alias("c"))
    fold_weights = (
        summed.filter(F.col("code") >= 0).join(
            counts.withColumn("code", (F.col("__t") * n_fold + F.col("fold")).cast("int")), ["proj_id", "code"])
        .join(scale, "proj_id")
        .select("proj_id", F.col("cell_id").alias("node"), "term", "fold", weight(F.col("c"), F.col("d")).alias("w"))
    )
    votes = fold_weights.groupBy("proj_id", "node", "term").agg(
        *[F.sum(F.when(F.col("fold") != f, F.col("w"))).alias(f"s{f}") for f in range(n_fold)]
    )
    nodes = degree.select("proj_id", "node")
    scores = _candidate_scores(votes, degree, folds, n_fold, digits).filter(F.col("score") > 0)
    auc = _folds_to_auroc(scores, _fold_sizes(folds, nodes, n_fold))
    return _voting_result(auc, degree, folds, n_fold)


# ---------------------------------------------------------------- pairwise correlation

_Entries = tuple[np.ndarray, np.ndarray, np.ndarray, int]  # gene numbers, places of the cells, values, number of cells


def _by_gene(entries: _Entries) -> _Entries:
    """Entries in the order of genes; of a (gene, cell) named twice the last one counts."""
    gene, place, x, n = entries
    key = gene * n + place
    order = np.argsort(key, kind="stable")
    order = order[np.r_[np.diff(key[order]) != 0, np.ones(min(1, len(key)), dtype=bool)]]
    return gene[order], place[order], x[order], n


def _products(left: _Entries, right: _Entries, most: int = 1 << 21, width: int = 1024) -> np.ndarray:
    """Dot products of all cells of two blocks over their genes.

    A gene costs the entries it has on one side times those on the other, so the work follows what the cells have in common and
    not the length of the gene list. Only genes that most cells have are multiplied densely, ``width`` at a time.
    """
    (ga, pa, xa, n), (gb, pb, xb, m) = _by_gene(left), _by_gene(right)
    dot = np.zeros((n, m))
    if not len(ga) or not len(gb):
        return dot
    size = int(max(ga[-1], gb[-1])) + 1
    fa, fb = np.bincount(ga, minlength=size), np.bincount(gb, minlength=size)
    common = fa * fb
    dense = np.nonzero(common * 32 > n * m)[0]
    for s in range(0, len(dense), width):
        at = np.full(size, -1)
        at[dense[s:s + width]] = np.arange(len(dense[s:s + width]))
        sides = []
        for gene, place, x, cells in ((ga, pa, xa, n), (gb, pb, xb, m)):
            slab, here = np.zeros((cells, width)), at[gene] >= 0
            slab[place[here], at[gene[here]]] = x[here]
            sides.append(slab)
        dot += sides[0] @ sides[1].T
    common[dense] = 0
    mine = np.nonzero(common[ga])[0]  # entries with a partner, and how many it has
    first, partners = (np.cumsum(fb) - fb)[ga[mine]], fb[ga[mine]]
    upto = np.cumsum(partners)
    flat, start = dot.reshape(-1), 0
    while start < len(mine):
        done = upto[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, done + most, "right")))
        count = partners[start:stop]
        i = np.repeat(mine[start:stop], count)
        j = np.arange(len(i)) + np.repeat(first[start:stop] - (upto[start:stop] - count - done), count)
        flat += np.bincount(pa[i] * m + pb[j], xa[i] * xb[j], n * m)
        start = stop
    return dot


def correlation_extremes(counts: DataFrame, genes: DataFrame, block: int = 2048, value: str = "n") -> DataFrame:
    """Smallest and largest Pearson correlation of every cell with the other cells of its project.

    All genes of the project count, also those silent in both cells. Cells without variance have no
    correlation.
    """
    id_type = counts.schema["cell_id"].dataType.simpleString()
    n_genes = durable(genes.groupBy("proj_id").agg(F.count(F.lit(1)).alias("g")))
    rows = counts.select(*CELL, "gene_id", F.col(value).cast("double").alias("x")).join(n_genes, "proj_id")
    cells = counts.select(*CELL).distinct()

    def profile(df: pd.DataFrame):
        ids, place = np.unique(df["cell_id"].to_numpy(), return_inverse=True)
        x = df["x"].to_numpy()
        return ids, place, x, np.bincount(place, x, len(ids)), np.bincount(place, x * x, len(ids))

    def task(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
        g = float(left["g"].iloc[0])
        ia, pa, xa, sa, qa = profile(left)
        ib, pb, xb, sb, qb = profile(right)
        code, _ = pd.factorize(np.concatenate([left["gene_id"].to_numpy(), right["gene_id"].to_numpy()]), use_na_sentinel=False)
        r = _products((code[:len(left)], pa, xa, len(ia)), (code[len(left):], pb, xb, len(ib)))
        va, vb = g * qa - sa * sa, g * qb - sb * sb
        with np.errstate(divide="ignore", invalid="ignore"):
            r *= g
            r -= np.outer(sa, sb)
            r /= np.sqrt(np.outer(va, vb))
        r[~(va > 0), :] = np.nan
        r[:, ~(vb > 0)] = np.nan
        if same:
            r[ia[:, None] == ib[None, :]] = np.nan
        ends = lambda ids, axis: pd.DataFrame({
            "cell_id": ids, "lo": np.fmin.reduce(r, axis, initial=np.inf), "hi": np.fmax.reduce(r, axis, initial=-np.inf)})
        return ends(ia, 1) if same else pd.concat([ends(ia, 1), ends(ib, 0)], ignore_index=True)

    found = _on_block_pairs(_place(rows, cells, block), task, f"proj_id string, cell_id {id_type}, lo double, hi double")
    ext = found.groupBy(*CELL).agg(F.min("lo").alias("min_corr"), F.max("hi").alias("max_corr"))
    known = lambda c: F.when(F.abs(c) != float("inf"), F.col(c)).alias(c)
    return ext.select(*CELL, known("min_corr"), known("max_corr"))
