"""Leading components of the cell x gene matrix of every project, by a block Krylov method over all projects at once.

Cells are packed once into blocks, each a row with a sparse matrix over the genes it uses. A round sends the current directions of a project
to its blocks; a block multiplies with its matrix and its transpose in one pass. What leaves a task is one sum per project over all its
blocks, cut into slices of genes, so neither the non-zeros nor their products are exchanged again. Only arrays of genes x basis, whose
size does not depend on the cells, are brought together per project.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsurvey.functions import fixed_values as fixed
from cellsurvey.session import durable

_DENSE = 1 << 22  # entries of the dense piece of a block that is multiplied at a time
_SLICE = 512  # genes whose sums travel together
_SPREAD = 4  # blocks of a project that share one copy of its directions


def _bytes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, dtype=np.float64).tobytes()


def _array(data: bytes, width: int, rows: int = -1) -> np.ndarray:
    return np.frombuffer(data, np.float64).reshape(rows, width)


def _packed_blocks(values: DataFrame, block: int) -> DataFrame:
    """One row per block of cells: its cells and genes, and the non-zeros as (cell, gene, x) by position; repeated entries add up."""
    id_type, gene_type = (values.schema[c].dataType.simpleString() for c in ("cell_id", "gene_id"))
    n = durable(values.groupBy("proj_id", "cell_id").agg(F.lit(1)).groupBy("proj_id").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks")))
    placed = values.join(n, "proj_id").withColumn("block", F.pmod(F.xxhash64("cell_id"), F.col("blocks")).cast("int"))

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        cells, at = np.unique(pdf["cell_id"].to_numpy(), return_inverse=True)
        genes, of = np.unique(pdf["gene_id"].to_numpy(), return_inverse=True)
        order = np.argsort(at, kind="stable")
        return pd.DataFrame({
            "proj_id": [key[0]], "part": [key[1] // _SPREAD], "parts": [-(-int(pdf["blocks"].iloc[0]) // _SPREAD)], "cells": [cells.tolist()], "genes": [genes.tolist()],
            "at": [at[order].astype(np.int32).tobytes()], "of": [of[order].astype(np.int32).tobytes()], "x": [_bytes(pdf["x"].to_numpy()[order])]})

    return durable(placed.groupBy("proj_id", "block").applyInPandas(
        pack, f"proj_id string, part int, parts int, cells array<{id_type}>, genes array<{gene_type}>, at binary, of binary, x binary"))


def _multiply(row, z: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
    """(A z, A' A z) of a packed block for directions ``z`` of its genes; dense pieces of some cells at a time."""
    at, of, x = np.frombuffer(row.at, np.int32), np.frombuffer(row.of, np.int32), np.frombuffer(row.x, np.float64)
    n_cells, n_genes = len(row.cells), len(row.genes)
    image, v = np.empty((n_cells, z.shape[1])), np.zeros(z.shape)
    step = max(1, _DENSE // n_genes)
    for first in range(0, n_cells, step):
        a, b = np.searchsorted(at, [first, first + step])
        height = min(step, n_cells - first)
        dense = np.bincount((at[a:b] - first).astype(np.int64) * n_genes + of[a:b], x[a:b], height * n_genes).reshape(height, n_genes)
        image[first : first + step] = dense @ z
        if back:
            v += dense.T @ image[first : first + step]
    return image, v


def _positions(genes: np.ndarray, all_genes: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.asarray(all_genes), np.asarray(genes))


def _sent(packed: DataFrame, directions: DataFrame) -> DataFrame:
    """Blocks with the directions of their project; a project of many blocks is spread over as many keys."""
    copies = directions.select(
        "proj_id", F.col("genes").alias("all_genes"), "z", "width", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return packed.drop("parts").join(copies, ["proj_id", "part"]).drop("part")


def _images(packed: DataFrame, active: DataFrame) -> DataFrame:
    """(proj_id, slice, v): A' A z of the unfinished projects, summed."""
    def multiply(batches):
        sums: dict[str, np.ndarray] = {}
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                z = _array(row.z, row.width)
                at = _positions(row.genes, row.all_genes)
                if row.proj_id not in sums:
                    sums[row.proj_id] = np.zeros_like(z)
                sums[row.proj_id][at] += _multiply(row, z[at], True)[1]
        for proj, v in sums.items():
            starts = range(0, len(v), _SLICE)
            yield pd.DataFrame({"proj_id": proj, "slice": list(starts), "v": [_bytes(v[s : s + _SLICE]) for s in starts]})

    def total(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = sum(np.frombuffer(v, np.float64) for v in pdf["v"])
        return pd.DataFrame({"proj_id": [key[0]], "slice": [key[1]], "v": [_bytes(out)]})

    schema = "proj_id string, slice int, v binary"
    return _sent(packed, active.select("proj_id", "genes", "parts", "z", "width")).mapInPandas(multiply, schema).groupBy("proj_id", "slice").applyInPandas(total, schema)


def _orthonormal(r: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Directions of ``r`` that the orthonormal ``basis`` does not hold yet; columns that bring nothing new go."""
    scale = np.linalg.norm(r, axis=0).max(initial=0.0)
    for _ in range(2):
        r = r - basis @ (basis.T @ r)
        u, s, _ = np.linalg.svd(r, full_matrices=False)
        r = u[:, s > 1e-12 * max(scale, 1e-300)] if scale else u[:, :0]
        scale = 1.0
    return r


def _step(k: int, tol: float, most_blocks: int):
    def step(state: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        if not len(state):
            return state
        row = state.iloc[0]
        z, n = _array(row["z"], row["width"]), len(row["genes"])
        v = np.concatenate([_array(x, row["width"]) for x in sums.sort_values("slice")["v"]])
        basis, image = np.hstack([_array(row["basis"], row["held"], n), z]), np.hstack([_array(row["image"], row["held"], n), v])
        theta, u = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        order = np.argsort(-theta)
        theta, u = theta[order], u[:, order]
        lead, lead_image = basis @ u[:, :k], image @ u[:, :k]
        rest = lead_image - lead * theta[:k]
        residual = np.linalg.norm(rest, axis=0).max(initial=0.0) / max(theta[0], 1e-300)
        if basis.shape[1] >= most_blocks * k:  # go on with the best half
            basis, image = basis @ u[:, : most_blocks * k // 2], image @ u[:, : most_blocks * k // 2]
        new = _orthonormal(rest, basis)[:, : max(0, n - basis.shape[1])]
        out = state.copy()
        out["done"] = bool(residual <= tol or not new.shape[1])
        signs = np.where(lead.sum(axis=0) < 0, -1.0, 1.0)
        found = np.zeros((n, k))
        found[:, : lead.shape[1]] = lead * signs
        s = np.zeros(k)
        s[: len(theta[:k])] = np.sqrt(np.maximum(theta[:k], 0.0))
        for name, value in (("z", new), ("basis", basis), ("image", image), ("lead", found)):
            out[name] = [_bytes(value)]
        out["width"], out["held"], out["s"] = new.shape[1], basis.shape[1], [s.tolist()]
        return out

    return step


def components_with_basis(values: DataFrame, k: int, tol: float = 1e-7, most_rounds: int = 60, block: int = 2048) -> tuple[DataFrame, DataFrame]:
    """(scores, singular values): ``pc`` array<double> per cell of ``values(proj_id, cell_id, gene_id, x)``, and ``s`` array<double> per project.

    A round multiplies k directions, adds them to the basis and takes the best k combinations of all. The next directions are what
    these leave over. A project is done when that is below ``tol`` of the largest eigenvalue for every component, which puts singular
    values within about tol squared, and takes no part in later rounds; it raises if ``most_rounds`` do not get there. A basis of eight
    blocks is reduced to its leading half. Missing components (fewer genes or cells than k) are 0.
    """
    values = durable(values.select("proj_id", "cell_id", "gene_id", F.col("x").cast("double").alias("x")))
    gene_type = values.schema["gene_id"].dataType.simpleString()
    packed = _packed_blocks(values, block)
    schema = f"proj_id string, genes array<{gene_type}>, parts int, z binary, width int, basis binary, image binary, held int, lead binary, s array<double>, done boolean"

    def start(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                z = np.linalg.qr(np.random.default_rng(len(row.genes)).standard_normal((len(row.genes), min(k, len(row.genes)))))[0]
                yield pd.DataFrame({"proj_id": [row.proj_id], "genes": [np.unique(np.asarray(row.genes)).tolist()], "parts": row.parts, "z": [_bytes(z)], "width": z.shape[1], "basis": [b""],
                                    "image": [b""], "held": 0, "lead": [b""], "s": [[]], "done": False})

    # the gene list of a project: one row, bounded by the genome
    genes = packed.select("proj_id", "parts", F.explode("genes").alias("gene"))
    listed = genes.groupBy("proj_id").agg(F.collect_set("gene").alias("genes"), F.max("parts").alias("parts"))
    state = durable(listed.mapInPandas(start, schema))
    finished = []
    for _ in range(most_rounds):
        sums = _images(packed, state)
        state = durable(state.groupBy("proj_id").cogroup(sums.groupBy("proj_id")).applyInPandas(_step(k, tol, 8), schema))
        finished.append(state.filter("done"))
        state = state.filter(~F.col("done"))
        if not state.take(1):
            break
    else:
        raise ValueError(f"components not found in {most_rounds} rounds")
    result = finished[0]
    for more in finished[1:]:
        result = result.unionByName(more)
    result = durable(result.select("proj_id", "genes", "parts", F.col("lead").alias("z"), F.lit(k).alias("width"), "s"))
    id_type = values.schema["cell_id"].dataType.simpleString()

    def score(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                z = _array(row.z, row.width)[_positions(row.genes, row.all_genes)]
                yield pd.DataFrame({"proj_id": row.proj_id, "cell_id": row.cells, "pc": list(_multiply(row, z, False)[0])})

    scores = _sent(packed, result.drop("s")).mapInPandas(score, f"proj_id string, cell_id {id_type}, pc array<double>")
    return scores, result.select("proj_id", "s")


def components(values: DataFrame, k: int = fixed.N_COMPONENTS, tol: float = 1e-7, most_rounds: int = 60) -> DataFrame:
    """Scores on the k leading components of each project's cell x gene matrix, without centring.

    ``values(proj_id, cell_id, gene_id, x)`` holds the non-zeros of the chosen genes. Column ``pc`` array<double>; the
    loadings of each component sum to a positive number. See ``components_with_basis``.
    """
    return components_with_basis(values, k, tol, most_rounds)[0]
