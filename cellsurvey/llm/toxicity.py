"""Toxicity by classifier chains.

Categories are predicted one after the other by linear (logistic) models over hashed words and word beginnings; every
later model also sees the probabilities of the earlier categories. While training, those are out-of-fold predictions:
they come from models that have not seen the document, as will be the case in use.

The labels only say whether a document is toxic. The categories of the chain refine that: ``insult`` (toxic, with a word
of the insult list), ``veiled`` (toxic, without one), and ``toxic`` itself, which decides. Features are scaled by how
much more often than expected they occur in the category (log ratio, positive ones only), so words that say nothing
weigh nothing however long a text is.

Training uses at most ``max_train`` labelled documents, those with the smallest hash of their id; scoring covers all
documents and whole texts. The cutoff is the lowest in ``cut_range`` that at most ``false_positives`` of the clean
training documents reach out of fold. NULL and empty texts have no features; a document labelled twice counts as toxic if
any label says so; where the labels hold one class only the probability is 0 and nothing is toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsurvey.llm.common import own_columns, release_memory, slices
from cellsurvey.session import durable

#: fixed values: common English insults
INSULTS = frozenset("stupid disgusting clown trash moron worthless scum pathetic idiot loser".split())
CATEGORIES = ("insult", "veiled", "toxic")
_EDGE = ".,;:!?\"'()[]#*$%&|<>"
_BEGINNINGS = (4, 5, 6)
_ANY_INSULT = 0  # feature number of "has a word of the list"
_CACHED = 60_000
_FITTED = 1 << 18  # occurrences of a block while a model is fitted


@dataclass
class Model:
    """Logit = bias + weights of the present features + weights of the earlier probabilities."""

    ids: np.ndarray
    weights: np.ndarray
    dense: np.ndarray  # bias, then one weight per earlier category


@dataclass
class Chain:
    models: list[Model | None]
    dimensions: int
    cutoff: float


class Features(dict):
    """Word -> numbers of its features, remembered per task."""

    def __init__(self, dimensions: int):
        super().__init__()
        self.dimensions = dimensions

    def number(self, term: str) -> int:
        return 1 + xxhash.xxh3_64_intdigest(term.encode("utf-8", "replace")) % (self.dimensions - 1)

    def __missing__(self, word: str) -> list[int]:
        if len(self) >= _CACHED:
            self.clear()
        bare = word.strip(_EDGE)
        found = [self.number(bare)] if bare else []
        found += [self.number(f"{n}:{bare[:n]}") for n in _BEGINNINGS if len(bare) > n]
        if bare in INSULTS:
            found.append(_ANY_INSULT)
        self[word] = found
        return found

    def of(self, text: str | None) -> np.ndarray:
        """Distinct features of a whole text."""
        found: set[int] = set()
        for word in set((text or "").lower().split()):
            found.update(self[word])
        return np.fromiter(found, np.int32, len(found))


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(at: np.ndarray, size: np.ndarray, earlier: np.ndarray, y: np.ndarray, dimensions: int, steps: int = 80,
        rate: float = 0.3, penalty: float = 1e-3, least_ratio: float = 0.3) -> Model | None:
    """Logistic model by full gradients with adaptive steps; None if there is one class only.

    ``at`` holds the features of all documents end to end, ``size`` how many each has. Occurrences are by far the most memory
    here: two arrays of 32 bits are kept of those that are used, and whatever is made of them is made for a block at a time.
    """
    share = y.mean() if len(y) else 0.0
    if share in (0.0, 1.0):
        return None
    n, ends = len(y), np.r_[0, np.cumsum(size)]
    cuts = np.unique(np.r_[0, np.searchsorted(ends, np.arange(_FITTED, ends[-1], _FITTED)), n])
    blocks = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]  # of whole documents
    inside = lambda docs: (at[ends[docs.start]:ends[docs.stop]], np.repeat(np.arange(docs.start, docs.stop, dtype=np.int32), size[docs]))
    seen, hits = np.zeros(dimensions, np.int64), np.zeros(dimensions, np.int64)
    for docs in blocks:
        values, doc = inside(docs)
        seen += np.bincount(values, minlength=dimensions)
        hits += np.bincount(values[(y > 0)[doc]], minlength=dimensions)
    ratio = np.log((hits + share) / (share * (seen + 1)))
    ratio[(seen < 2) | (ratio < least_ratio)] = 0
    wanted = (ratio != 0) & (seen > 0)
    ids, number = np.flatnonzero(wanted), (np.cumsum(wanted) - 1).astype(np.int32)
    scale, parts = ratio[ids].astype(np.float32), []
    for docs in blocks:
        values, doc = inside(docs)
        use = wanted[values]
        parts.append((docs, number[values[use]], doc[use]))
    dense = np.column_stack([np.ones(n), earlier])
    w, d = np.zeros(len(ids)), np.zeros(dense.shape[1])
    d[0] = np.log(share / (1 - share))
    gw2, gd2 = np.full(len(w), 1e-12), np.full(len(d), 1e-12)
    for _ in range(steps):
        z, product = np.empty(n), w * scale
        for docs, x, doc in parts:
            z[docs] = np.bincount(doc - docs.start, weights=product[x], minlength=docs.stop - docs.start)
        error = _logistic(z + dense @ d) - y
        sums = np.zeros(len(ids))
        for _, x, doc in parts:
            np.add.at(sums, x, error[doc] * scale[x])
        gw = sums / n + penalty * w
        gd = dense.T @ error / n
        gw2 += gw * gw
        gd2 += gd * gd
        w -= rate * gw / np.sqrt(gw2)
        d -= rate * gd / np.sqrt(gd2)
    return Model(ids.astype(np.int32), w * ratio[ids], d)


class Scorer:
    """A model with its weights laid out by feature number."""

    def __init__(self, model: Model, dimensions: int):
        self.table = np.zeros(dimensions)
        self.table[model.ids] = model.weights
        self.dense = model.dense

    def __call__(self, features: np.ndarray, earlier) -> float:
        z = self.table[features].sum() + self.dense[0] + np.dot(self.dense[1:], earlier)
        return float(_logistic(z))


def _labelled(dimensions: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Features(dimensions)
        for batch in slices(batches):
            found = [table.of(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int32())), pa.array([_ANY_INSULT in f for f in found]), batch.column(2)],
                names=["doc_id", "features", "insult", "toxic"])
        table.clear()
        release_memory()

    return make


def train(docs: DataFrame, labels: DataFrame, dimensions: int = 1 << 18, folds: int = 3, max_train: int = 16_000,
          false_positives: float = 0.001, cut_range: tuple[float, float] = (0.2, 0.5), least_ratio: float = 0.3) -> Chain:
    """Fit the chain. A round per category; its fold models and the final one are fitted side by side.

    Features that no model can use, by counts over the training documents, go before the documents are dealt to the folds.
    """
    known = durable(
        own_columns(labels, "doc_id", "toxic").filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))
    made = own_columns(docs, "doc_id", "text").join(known, "doc_id").select("doc_id", "text", "toxic").mapInArrow(
        _labelled(dimensions), "doc_id bigint, features array<int>, has_insult boolean, is_toxic boolean")
    rows = durable(made.select(
        "doc_id", "features", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(folds)).cast("int").alias("fold"),
        (F.col("is_toxic") & F.col("has_insult")).cast("double").alias("insult"),
        (F.col("is_toxic") & ~F.col("has_insult")).cast("double").alias("veiled"),
        F.col("is_toxic").cast("double").alias("toxic")))
    telling = _telling(rows, folds, least_ratio)
    rows = durable(rows.mapInArrow(_kept(np.unique(np.concatenate(list(telling.values()))), dimensions), rows.schema))
    rounds: list[list[Model | None]] = []  # of every category the models without fold 0, 1, ..., and the final one
    for category in CATEGORIES:
        dealt = rows.mapInArrow(
            _training(category, telling[category], rounds, dimensions),
            "doc_id bigint, features array<int>, fold int, y double, earlier array<double>")
        held = F.filter(F.sequence(F.lit(0), F.lit(folds)), lambda h: h != F.col("fold"))  # fold that is held out; the last: none
        found = dealt.withColumn("held", F.explode(held)).groupBy("held").applyInArrow(
            _round(dimensions, least_ratio), "held int, ids array<int>, weights array<double>, dense array<double>")
        models = {r[0]: Model(*map(np.array, r[1:], (np.int32, float, float))) for r in found.collect()}  # of a fixed number of features
        rounds.append([models.get(h) for h in range(folds + 1)])
    clean = rows.filter("toxic = 0").mapInArrow(_training(CATEGORIES[-1], np.empty(0, np.int32), rounds, dimensions),
                                                "doc_id bigint, features array<int>, fold int, y double, earlier array<double>")
    cut = clean.agg(F.percentile(F.element_at("earlier", -1), F.lit(1 - false_positives))).first()[0]
    low, high = cut_range
    return Chain([models[-1] for models in rounds], dimensions, min(high, max(low, cut if cut is not None else high)))


def _telling(rows: DataFrame, folds: int, least_ratio: float) -> dict[str, np.ndarray]:
    """Of every category the features that some fold's model gives a weight: the rule of ``fit`` on counts per feature and fold.

    At most one row per feature number comes back, whatever the documents are.
    """
    with_, kinds = range(folds), CATEGORIES
    inside = lambda j, c: F.sum(F.when(F.col("fold") == j, F.col(c)).otherwise(0))
    sizes = rows.select("fold", F.lit(1.0).alias("seen"), *kinds).agg(
        *[inside(j, c).alias(f"{c}{j}") for j in with_ for c in ("seen", *kinds)]).first().asDict()
    counts = rows.select("fold", *kinds, F.lit(1.0).alias("seen"), F.explode("features").alias("id")).groupBy("id").agg(
        *[inside(j, c).alias(f"{c}{j}") for j in with_ for c in ("seen", *kinds)])
    useful = {c: F.lit(False) for c in kinds}
    for held in range(folds + 1):
        trained = [j for j in with_ if j != held]
        total = lambda c: sum((F.col(f"{c}{j}") for j in trained), F.lit(0.0))
        n = sum(sizes[f"seen{j}"] or 0 for j in trained)
        for c in kinds:
            share = sum(sizes[f"{c}{j}"] or 0 for j in trained) / n if n else 0.0
            if 0 < share < 1:
                useful[c] = useful[c] | ((total("seen") >= 2) & (F.log((total(c) + share) / (share * (total("seen") + 1))) >= least_ratio - 1e-9))
    found = counts.select("id", *[u.alias(c) for c, u in useful.items()]).filter(" or ".join(kinds)).toArrow()
    return {c: found["id"].filter(found[c]).to_numpy().astype(np.int32) for c in kinds}


def _only(lists: pa.ListArray, wanted: np.ndarray) -> pa.ListArray:
    values = lists.flatten().to_numpy(zero_copy_only=False)
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    use = wanted[values]
    before = np.concatenate([[0], np.cumsum(use)])[ends].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(before), pa.array(values[use], pa.int32()))


def _kept(ids: np.ndarray, dimensions: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(dimensions, bool)
        wanted[ids] = True
        for batch in slices(batches):
            new = _only(batch.column("features"), wanted)
            yield pa.RecordBatch.from_arrays([new if name == "features" else batch.column(name) for name in batch.schema.names], names=batch.schema.names)
        release_memory()

    return keep


def _training(category: str, ids: np.ndarray, rounds: list[list[Model | None]], dimensions: int):
    """Rows to train a category on: features of ``ids`` alone, and the earlier probabilities by the models without the row's fold."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(dimensions, bool)
        wanted[ids] = True
        scorers = [[m and Scorer(m, dimensions) for m in models[:-1]] for models in rounds]
        for batch in slices(batches):
            lists, folds, out = batch.column("features"), batch.column("fold").to_numpy(), []
            values, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            for fold, a, b in zip(folds, ends[:-1], ends[1:]):
                earlier: list[float] = []
                for models in scorers:
                    earlier.append(models[fold](values[a:b], earlier) if models[fold] else 0.0)
                out.append(earlier)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _only(lists, wanted), batch.column("fold"), batch.column(category), pa.array(out, pa.list_(pa.float64()))],
                names=["doc_id", "features", "fold", "y", "earlier"])
        release_memory()

    return make


def _round(dimensions: int, least_ratio: float):
    """Training rows of one held-out fold -> their model, if they have both classes."""

    def run(rows: pa.Table) -> pa.Table:
        held = rows["held"][0].as_py()
        rows = rows.select(["doc_id", "features", "y", "earlier"]).combine_chunks()
        rows = rows.take(pa.array(np.argsort(rows["doc_id"].to_numpy(), kind="stable"))).combine_chunks()
        lists, n = rows["features"].combine_chunks(), rows.num_rows
        at, size = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
        earlier, y = rows["earlier"].combine_chunks().flatten().to_numpy().reshape(n, -1), rows["y"].to_numpy()
        model = fit(at, size, earlier, y, dimensions, least_ratio=least_ratio)
        del rows, lists, at
        release_memory()
        found = {"held": [held], "ids": [model.ids], "weights": [model.weights], "dense": [model.dense]} if model else {c: [] for c in ("held", "ids", "weights", "dense")}
        kinds = [pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.float64())]
        return pa.table([pa.array(v, t) for v, t in zip(found.values(), kinds)], names=list(found))

    return run


def _scorer(chain: Chain, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Features(chain.dimensions)
        scorers = [m and Scorer(m, chain.dimensions) for m in chain.models]
        for batch in slices(batches):
            columns = [[] for _ in scorers]
            for text in batch.column(at).to_pylist():
                features, earlier = table.of(text), []
                for out, scorer in zip(columns, scorers):
                    earlier.append(scorer(features, earlier) if scorer else 0.0)
                    out.append(earlier[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(c, pa.float64()) for c in columns]],
                names=[*batch.schema.names, *[f"p_{c}" for c in CATEGORIES]])
        table.clear()
        release_memory()

    return run


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """All columns of ``docs``, p_insult, p_veiled, p_toxic and is_toxic (columns of these names are replaced). A narrow step."""
    docs = docs.drop(*[f"p_{c}" for c in CATEGORIES], "is_toxic")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + [f"p_{c} double" for c in CATEGORIES])
    scored = docs.mapInArrow(_scorer(chain, docs.columns.index("text")), schema)
    return scored.withColumn("is_toxic", F.col(f"p_{CATEGORIES[-1]}") >= chain.cutoff)
