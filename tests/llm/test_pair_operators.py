"""Joins, deduplication, scoring, packing, archives, dialogues and the pipeline against brute force, and their edge cases."""

import collections
import gzip
import hashlib
import math
import pathlib
import random
import zlib

import numpy as np
import pyarrow.fs
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cellsurvey.llm import dialogue, lm_scoring, ngram_join, packing, paragraphs, queries, secrets, warc
from cellsurvey.llm.components import connected_components

FOLDER = "/root/testdata/sf0.001"


def frame(spark, rows, extra="root string, size int, chunk string"):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "r", 1, "c") for i, t in rows], f"doc_id long, text string, {extra}")


def shingle_set(text, n=5):
    w = (text or "").encode().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def groups(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ------------------------------------------------------------------------------------------------ components

def test_components(spark):
    rng = random.Random(5)
    edges = [(f"{rng.randrange(400):03}", f"{rng.randrange(400):03}") for _ in range(260)]
    edges += [(f"h{i:04}", f"h{i + 1:04}") for i in range(300)] + [("hub", f"s{i}") for i in range(500)] + [("x", "x"), (None, "y")]
    got = dict(connected_components(spark.createDataFrame(edges, "a string, b string")).collect())
    real = [(a, b) for a, b in edges if a and b and a != b]
    want = groups(real, {x for e in real for x in e})
    assert got == {n: r for n, r in want.items() if n != r}
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


# ------------------------------------------------------------------------------------------------ n-gram join

def near_texts(seed=1):
    """Families of near copies, copies, short texts and a passage shared by texts that differ otherwise."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    texts = []
    for size, n, change in ((60, 60, 2), (200, 25, 8), (30, 8, 1), (1500, 3, 20)):
        base = [word() for _ in range(size)]
        for _ in range(n):
            t = list(base)
            for _ in range(rng.randrange(change + 1)):
                t[rng.randrange(size)] = word()
            texts.append(" ".join(t))
    passage = " ".join(word() for _ in range(30))
    texts += [passage + " " + " ".join(word() for _ in range(60)) for _ in range(40)]
    texts += texts[:5] * 3 + [texts[0].replace(" ", "\n\t ")] + ["a", "a", "a b", "", None, "  ", "a b c d e", "a b c d e f"]
    return texts


def brute_links(texts):
    sets = [shingle_set(t) for t in texts]
    return sets, [(i, j) for i in range(len(sets)) for j in range(i) if jaccard(sets[i], sets[j]) >= 0.8]


@pytest.mark.parametrize("small,chunk", [(24, 512), (2, 7), (0, 1000)])
def test_join(spark, small, chunk):
    texts = near_texts()
    sets, links = brute_links(texts)
    want = groups(links, range(len(texts)))
    count = collections.Counter(x for e in links for x in e)
    rows = ngram_join.jaccard_classes(frame(spark, enumerate(texts)), small=small, chunk=chunk).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts)
    assert {i: r.class_id for i, r in got.items()} == want
    assert {i: r.n_links for i, r in got.items()} == {i: count[i] for i in got}


def test_join_query_against_brute_force(spark):
    docs = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    sets = {i: shingle_set(t) for i, t in docs.items()}
    ids = sorted(sets)
    links = [(i, j) for k, i in enumerate(ids) for j in ids[:k] if jaccard(sets[i], sets[j]) >= 0.8]
    rows = queries.QUERIES["op2_ngram_join"](spark, FOLDER).collect()
    want, count = groups(links, ids), collections.Counter(x for e in links for x in e)
    assert {r.doc_id: (r.class_id, r.n_links) for r in rows} == {i: (want[i], count[i]) for i in ids}


def test_join_beside_a_hot_group(spark):
    """Links at the threshold are found beside a large group of very similar texts, which alone would reach any share of all links."""
    rng = random.Random(9)
    word = lambda: f"z{rng.randrange(1_000_000)}"
    hot, texts = [word() for _ in range(200)], []
    for _ in range(400):
        t = list(hot)
        t[-1] = word()
        texts.append(" ".join(t))
    n = len(texts)
    for _ in range(3000):  # 84 shingles, 75 of them in both: 75 / 93 = 0.806
        t = [word() for _ in range(88)]
        texts += [" ".join(t), " ".join([*t[:79], *[word() for _ in range(9)]])]
    rows = {r.doc_id: r for r in ngram_join.jaccard_classes(frame(spark, enumerate(texts))).collect()}
    assert [i for i in range(n, len(texts)) if rows[i].n_links != 1] == []
    assert all(rows[i].n_links == n - 1 for i in range(n))


def test_join_levels():
    for recall in (0.99, 0.9999, 0.999999):
        forest = ngram_join.Forest(5, 0.8, recall, 12, 4, 24, 768, 400_000, 1)
        assert forest.levels()[0] == 4 and forest.found(0.8, forest.levels()[-1]) >= recall


def test_join_edges_of_input(spark):
    docs = frame(spark, [(7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (None, "x"), (9, None)])
    rows = sorted(ngram_join.jaccard_classes(docs).collect(), key=str)
    assert [(r.doc_id, r.class_id, r.n_links, r.n_copies) for r in rows if r.doc_id == 7] == [(7, 7, 2, 3)] * 2
    assert sorted((str(r.class_id), r.n_links) for r in rows if r.doc_id is None) == [("7", 2), ("None", 0)]
    assert [(r.class_id, r.n_links) for r in rows if r.doc_id == 9] == [(9, 0)]
    kept = ngram_join.keep_one(docs, ngram_join.jaccard_classes(docs)).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in kept) == [("7", "a b c d e f"), ("9", "None"), ("None", "a b c d e f"), ("None", "x")]
    assert ngram_join.jaccard_classes(docs.limit(0)).count() == 0


def test_block_arithmetic():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40)).astype(np.int64)) for _ in range(30)] + [np.empty(0, np.int64)]
    left, right = np.arange(0, 15), np.arange(10, 31)
    got = ngram_join.intersections(sets, left, right, width=7)
    assert all(got[i, j] == len(set(sets[a]) & set(sets[b])) for i, a in enumerate(left) for j, b in enumerate(right))
    assert ngram_join.intersections([np.empty(0, np.int64)] * 2, np.arange(1), np.arange(1, 2)).tolist() == [[0.0]]


# ------------------------------------------------------------------------------------------------ paragraphs

def test_bands():
    for recall in (0.9, 0.99, 0.999):
        rows, bands = paragraphs.tune_bands(0.8, recall)
        assert 1 - (1 - 0.8**rows) ** bands >= recall and rows * bands <= 32


def passage_documents():
    rng = random.Random(8)
    word = lambda: f"v{rng.randrange(100_000)}"
    line = lambda n: " ".join(word() for _ in range(n))
    sentence = lambda: line(9) + "."
    whole = line(60)
    inside = " ".join(sentence() for _ in range(7))  # begins and ends within a line
    near = line(80).split()
    docs = {i: f"{line(30)}\n{sentence()} {sentence()}\n{line(12)}" for i in range(40)}
    for i in (3, 8, 12):
        docs[i] += "\n" + whole
    for i in (5, 9):
        docs[i] = f"{line(10)} {line(5)}. {inside} {line(20)}\n{docs[i]}"
    for i in (20, 21, 22):
        t = list(near)
        t[i] = word()
        docs[i] += "\n" + " ".join(t) + "\n" + line(25)
    bare = line(70)  # no sentence ends, in the middle of other words
    for i in (24, 26):
        docs[i] += f"\n{line(17)} {bare} {line(23)}"
    docs[30] += "\nshort boilerplate line"
    docs[31] += "\nshort boilerplate line"
    docs[32] = docs[33] = f"{line(25)}\n{line(25)}"
    return docs


@pytest.mark.parametrize("chunk", [512, 1])
def test_passages(spark, chunk):
    docs = passage_documents()
    rows = [*docs.items(), (33, docs[33]), (None, docs[3]), (100, None), (101, "")]
    found = paragraphs.repeated_passages(frame(spark, rows), chunk=chunk).collect()
    by = {r.doc_id: r for r in found}
    assert set(by) == {3, 8, 12, 5, 9, 20, 21, 22, 24, 26, 32, 33} and len(found) == len(by)
    assert {i for i, r in by.items() if r.n_removed > 0} == {8, 12, 9, 21, 22, 26, 33}
    assert by[8].kept_doc_id == by[12].kept_doc_id == 3 and by[22].kept_doc_id == 20 and by[9].kept_doc_id == 5
    assert " ".join(docs[8].split()[by[8].first_word : by[8].last_word]) == docs[3].split("\n")[-1] and by[8].n_removed == 60
    assert by[9].n_words == 63 and by[33].n_removed == 50
    assert paragraphs.repeated_passages(frame(spark, rows).limit(0)).count() == 0


def test_pieces_are_dropped_before_anchors_grow(spark, monkeypatch):
    """The largest table does not stay on disk beside the grown anchors, and nothing needs it any more."""
    left = []
    real = paragraphs.grown_anchors
    durable = paragraphs.durable
    tables = []
    monkeypatch.setattr(paragraphs, "durable", lambda df: tables.append(durable(df)) or tables[-1])
    monkeypatch.setattr(paragraphs, "grown_anchors", lambda *a: left.append(
        [t.inputFiles()[0] for t in tables[:1] if pathlib.Path(t.inputFiles()[0].removeprefix("file:")).exists()]) or real(*a))
    found = paragraphs.repeated_passages(frame(spark, passage_documents().items())).collect()
    assert left == [[]] and len(found) == 12


def equal_runs(docs, least):
    """Document -> positions inside runs of ``least`` words or more that another document has too."""
    runs = collections.defaultdict(set)
    for i, t in docs.items():
        w = t.split()
        for k in range(len(w) - least + 1):
            runs[tuple(w[k : k + least])].add((i, k))
    out = collections.defaultdict(set)
    for places in runs.values():
        if len({i for i, _ in places}) > 1:
            for i, k in places:
                out[i].update(range(k, k + least))
    return out


def check_passages(spark, docs, least=30):
    """Exactly the equal runs are found (the texts have no near ones)."""
    want = equal_runs(docs, least)
    got = collections.defaultdict(set)
    for r in paragraphs.repeated_passages(frame(spark, docs.items())).collect():
        got[r.doc_id].update(range(r.first_word, r.last_word))
    assert got == want
    return want


def test_passages_inside_lines(spark):
    rng = random.Random(4)
    word = lambda: f"p{rng.randrange(100_000)}"
    for stops in (0.0, 0.1):  # without and with sentence ends
        line = lambda n: " ".join(word() + "." * (rng.random() < stops) for _ in range(n))
        docs = {}
        for i in range(0, 240, 3):
            passage = line(rng.choice([30, 31, 45]) if i < 60 else rng.randint(51, 60))
            docs |= {i + j: f"{line(rng.randint(1, 40))} {passage} {line(rng.randint(1, 40))}\n{line(25)}" for j in range(2)}
            docs[i + 2] = line(50)
        want = check_passages(spark, docs)
        assert len(want) == 160


def test_passages_of_short_lines(spark):
    """Lists, verse, dialogue: no line and no sentence is long enough for a piece of its own."""
    rng = random.Random(6)
    docs = {}
    for i, (per, sep) in enumerate([(5, "\n"), (1, "\n"), (3, ". "), (5, "!\n"), (2, "?\n\n")]):
        text = lambda n: sep.join(" ".join(f"q{rng.randrange(100_000)}" for _ in range(per)) for _ in range(n // per))
        passage = text(60)
        docs |= {10 * i + j: f"{text(20)}{sep}{passage}{sep}{text(30)}" for j in range(3)}
    want = check_passages(spark, docs)
    assert len(want) == 15 and all(len(v) >= 60 for v in want.values())


def test_words_around_anchors():
    """One row per anchor at an edge, side and keeper: the longest, as brute force over all lengths has it."""
    rng, steps, k = np.random.default_rng(5), 4, 3
    n = 400
    key, after = np.sort(rng.integers(0, 12, n)), np.zeros(n, bool)
    after[:] = key % 2 == 1
    size, doc = rng.integers(1, steps + 1, n).astype(np.int32), rng.integers(0, 40, n)
    place, words = np.where(rng.random(n) < 0.5, rng.integers(10, 99, n), 0), rng.integers(0, 3, (n, steps)).astype(np.uint64)
    want = {}
    for i in np.flatnonzero(place):
        for e in range(1, size[i] + 1):
            ids = {doc[j] for j in range(n) if key[j] == key[i] and size[j] >= e and (words[j, :e] == words[i, :e]).all()}
            if len(ids) > 1:
                first = place[i] - 1 - (0 if after[i] else e)
                want[i, min(ids)] = (doc[i], first, first + k + e, min(ids))
    got = list(zip(*paragraphs.longest(key, after, size, doc, place, words, k)))
    assert want and sorted(got) == sorted(want.values())


@pytest.mark.parametrize("copies", [6, 1200])
def test_anchors_do_not_leave_a_row_per_length(spark, monkeypatch, copies):
    """What leaves the task that reads the texts is a row per anchor and side, common or not."""
    rng = random.Random(11)
    line = lambda n: " ".join(f"g{rng.randrange(100_000)}" for _ in range(n))
    passage = line(60)
    docs = {i: f"{line(20)} {passage} {line(20)}" for i in range(copies)}
    made, durable = [], paragraphs.durable
    monkeypatch.setattr(paragraphs, "durable", lambda df: made.append(durable(df)) or made[-1])
    check_passages(spark, docs)
    around, = [t for t in made if {"place", "words"} <= set(t.columns)]
    assert 0 < around.count() <= 2 * copies * 60 and (around.filter("common").count() > 0) == (copies > 1000)


def test_passage_query(spark):
    """Every line of 30 words or more that two documents share exactly is inside a passage of each, and all else is near such a line."""
    docs = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    lines = collections.defaultdict(set)
    for i, t in docs.items():
        for x in t.split("\n"):
            if len(x.split()) >= 30:
                lines[tuple(x.split())].add(i)
    got = collections.defaultdict(list)
    for r in queries.QUERIES["op10_paragraph_dedup"](spark, FOLDER).collect():
        got[r.doc_id].append((r.first_word, r.last_word))
    shared = {i for ids in lines.values() if len(ids) > 1 for i in ids}
    assert shared and shared <= set(got)
    for x, ids in lines.items():
        if len(ids) > 1:
            for i in ids:
                w = docs[i].split()
                assert any(tuple(w[k : k + len(x)]) == x for a, b in got[i] for k in range(a, b - len(x) + 1))


# ------------------------------------------------------------------------------------------------ language model

def brute_scores(rows, alpha=0.4, unseen=0.5):
    uni, bi, docs, out = collections.Counter(), collections.Counter(), [], collections.defaultdict(float)
    for i, t in rows:
        w = (t or "").encode().lower().split()
        docs.append((i, w))
        uni.update(w)
        bi.update(zip(w, w[1:]))
    total = sum(uni.values())
    for i, w in docs:
        own, own2 = collections.Counter(w), collections.Counter(zip(w, w[1:]))
        out[i] += 0.0
        for k, x in enumerate(w):
            p = max(uni[x] - own[x], unseen) / max(total - len(w), 1)
            if k:
                b = (w[k - 1], x)
                p = (bi[b] - own2[b]) / max(uni[b[0]] - own[b[0]], unseen) if bi[b] > own2[b] else alpha * p
            out[i] += math.log(p)
    return out


@pytest.mark.parametrize("frequent,hot_rows,part_rows", [(1 << 20, 1 << 18, 3_000_000), (20, 30, 5000), (60, 1 << 18, 5000), (0, 5, 2000)])
def test_scores(spark, frequent, hot_rows, part_rows):
    rng = random.Random(3)
    words = [f"W{int(rng.paretovariate(0.6))}" for _ in range(500)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))) for i in range(400)]
    rows += [(1000 + i, f"the of x{i % 7} the of") for i in range(300)]  # a pair most documents hold
    rows += [(900, None), (901, ""), (None, "a b c"), (None, "a b"), (902, "hot pair hot pair"), (903, "one"), (904, "x " * 20_000), (902, "hot pair")]
    got = {r.doc_id: r for r in lm_scoring.backoff_scores(frame(spark, rows), frequent=frequent, hot_rows=hot_rows, part_rows=part_rows).collect()}
    want = brute_scores(rows)
    assert set(got) == set(want)
    for i in want:
        assert got[i].log_score == pytest.approx(want[i], rel=1e-10, abs=1e-8)
    assert got[904].n_words == 20_000 and got[900].mean_log_score is None
    assert lm_scoring.backoff_scores(frame(spark, rows).limit(0)).count() == 0


def test_scores_are_moved_in_slices(spark, monkeypatch):
    """A slice of documents sends one row to each partition, words that occur once send none, and no partition is sorted by Spark."""
    rows = [(i, f"a b c d{i} b{i % 7} e{i} a b") for i in range(600)]
    sent = []
    real = lm_scoring._explode

    def spy(model, parts):
        run = real(model, parts)
        sent.append((parts, frame(spark, rows).coalesce(1).mapInArrow(run, lm_scoring._ROWS).collect()))
        return run

    plans = []
    durable = lm_scoring.durable
    monkeypatch.setattr(lm_scoring, "_explode", spy)
    monkeypatch.setattr(lm_scoring, "durable", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or durable(df))
    got = {r.doc_id: r.log_score for r in lm_scoring.backoff_scores(frame(spark, rows), frequent=5, part_rows=1000).collect()}
    want = brute_scores(rows)
    assert all(got[i] == pytest.approx(want[i], rel=1e-10) for i in want)
    parts, moved = sent[0]
    assert len(moved) <= 3 * (parts + 1) and not any("Window" in plan for plan in plans)
    records = np.frombuffer(b"".join(r.others for r in moved), lm_scoring._OTHER)
    assert 0 < len(records) < 4 * 600  # the open words b0 to b6 and few pairs with them; d and e would add four a document


def test_score_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_scores(docs)
    for r in queries.QUERIES["op7_backoff_scores"](spark, FOLDER).collect():
        assert r.log_score == pytest.approx(want[r.doc_id], rel=1e-10, abs=1e-8)


# ------------------------------------------------------------------------------------------------ packing

def test_packing_of_empty_texts(spark):
    """Thousands of equal rows of one token each: as few sequences as there can be, spread over several groups."""
    docs = spark.createDataFrame([(None if i % 3 else 7, None if i % 2 else "") for i in range(5000)], "doc_id long, text string")
    rows = packing.pack(docs).collect()
    assert len(rows) == 5000 and len({(r.sequence_id, r.offset) for r in rows}) == 5000 and len({r.sequence_id for r in rows}) == 3
    spread_out = packing.pack(docs, group_pieces=500).groupBy((F.col("sequence_id") / (1 << 32)).cast("int").alias("g")).count().collect()
    assert len(spread_out) == 10 and max(r["count"] for r in spread_out) < 1000


def test_perspectives_of_null_and_empty_ids(spark):
    turns = spark.createDataFrame([(None, 1, "a", "x"), ("", 1, "b", "yy")], "conv_id string, turn int, role string, text string")
    got = {(r.conv_id, r.perspective, r.text) for r in dialogue.rotate(turns).collect()}
    assert got == {(None, "a", "<|im_start|>assistant\nx<|im_end|>\n"), ("", "b", "<|im_start|>assistant\nyy<|im_end|>\n")}


def check_packing(rows, size, most_pieces):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size and len(places) <= most_pieces
    return len(by)


def test_pack_query(spark):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(packing.tokenizer_file()).encode
    docs = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    rows = queries.QUERIES["op8_best_fit"](spark, FOLDER).collect()
    pieces, total = collections.defaultdict(dict), 0
    for r in rows:
        pieces[r.doc_id][r.piece] = r
    for i, text in docs.items():
        ids = np.array([*encode(text, add_special_tokens=False).ids, 0], "<u4")
        own, at = [pieces[i][k] for k in range(len(pieces[i]))], 0
        assert len(own) == math.ceil(len(ids) / 2048) and all(p.length == 2048 for p in own[1:])
        for p in own:
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
        total += at
    assert check_packing(rows, 2048, 2048) <= math.ceil(total / 2048) + 2


def test_pack_edges(spark):
    docs = frame(spark, [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "b"), (4, "word " * 700), (5, " <|endoftext|>  x \n\n ")])
    rows = packing.pack(docs, size=64, most_pieces=3, group_pieces=9).collect()
    assert [(r.length, r.ids_crc32) for r in rows if r.doc_id in (1, 2)] == [(1, zlib.crc32(b"\0\0\0\0"))] * 2
    assert sum(r.doc_id == 3 for r in rows) == 2
    check_packing(rows, 64, 3)
    assert packing.pack(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, size=64, most_cost=100)


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_capacities(rule):
    lengths = np.random.default_rng(2).integers(1, 101, 800)
    bins, offsets = packing.best_fit(lengths, 100, 4, 10_000.0, rule=rule)
    for b in np.unique(bins):
        own = lengths[bins == b]
        assert own.sum() <= 100 and len(own) <= 4 and (own**2).sum() <= 10_000
        order = np.argsort(offsets[bins == b])
        assert (np.r_[0, np.cumsum(own[order])[:-1]] == offsets[bins == b][order]).all()


# ------------------------------------------------------------------------------------------------ WARC

def test_archives(spark):
    big = "<p>é</p>" * 60
    rows = [(5, "http://a/b c\r\n", big), (3, None, big), (9, "u", big), (1, "u", "tiny"), (2, "u", "tiny"), (4, "u", None), (None, "n", big), (3, None, big),
            (6, "v", "x" * 5_000_000), (7, "w", "a\r\n\r\nb" * 40)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    index = warc.write_archives(pages)
    assert index.count() == len(rows)
    got = warc.read_records(index, gap=10, most=2000).collect()
    assert len(got) == len(rows)
    payload = {(i, h): (h or "").encode() for i, _, h in rows}
    kinds = collections.Counter((r.page_id, r.record_type, r.refers_to) for r in got)
    assert kinds[3, "response", None] == 2 and kinds[5, "revisit", 3] == kinds[9, "revisit", 3] == kinds[None, "revisit", 3] == 1
    assert kinds[1, "response", None] == kinds[2, "response", None] == kinds[4, "response", None] == 1
    for r in got:
        want = next(v for (i, _), v in payload.items() if i == r.page_id)
        assert (r.payload_bytes, r.payload_digest) == (len(want), hashlib.sha256(want).hexdigest())
        assert r.payload == (want if r.record_type == "response" else None)
    # a selection reads its records alone, and the files are ordinary gzip archives
    assert {r.page_id for r in warc.read_records(index.filter("page_id in (6, 7)")).collect()} == {6, 7}
    for (file,) in index.select("file").distinct().collect():
        files, path = pyarrow.fs.FileSystem.from_uri(file)
        data = files.open_input_file(path).read()
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == index.filter(F.col("file") == file).count()
    assert warc.read_records(warc.write_archives(pages.limit(0))).count() == 0


def test_warc_query(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "html").collect()
    first = {}
    for i, h in sorted(pages):
        first.setdefault(h, i)
    for r in queries.QUERIES["op5_warc"](spark, FOLDER).collect():
        html = next(h for i, h in pages if i == r.page_id)
        data = html.encode()
        same = first[html] if len(data) >= 100 and first[html] != r.page_id else None
        assert (r.payload_bytes, r.payload_digest, r.refers_to) == (len(data), hashlib.sha256(data).hexdigest(), same)
        assert r.record_type == ("response" if same is None else "revisit")


# ------------------------------------------------------------------------------------------------ dialogues

def render(turns, who):
    out, mask, at = "", [], 0
    for speaker, text in turns:
        head = "system" if speaker == "system" else "assistant" if speaker == who else f"user name={speaker}"
        out += f"<|im_start|>{head}\n"
        if speaker == who:
            mask.append((len(out), len(out) + len(text) + len("<|im_end|>")))
        out += f"{text}<|im_end|>\n"
    return out, mask


@pytest.mark.parametrize("per_part", [256, 2])
def test_rotation(spark, per_part):
    rows = [(1, 1, "Ann", "hé"), (1, 2, "Bob", "ho"), (1, 3, "Ann", None), (1, 3, "Cem", "x"), (1, None, None, "rules"), (2, 1, "system", "alone"),
            (None, 1, "Ann", "lost"), (3, 1, "Ann", "twice"), (3, 1, "Ann", "twice")] + [(4, i % 3, f"p{i % 2}", f"t{i}") for i in range(40)]
    frame_ = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, speaker string, text string, perspective string, part int")
    got = collections.defaultdict(list)
    for r in dialogue.rotate(frame_, speaker="speaker", turns_per_part=per_part).orderBy("part").collect():
        got[r.conv_id, r.perspective].append(r)
    want = {}
    for conv in (1, 2, None, 3, 4):
        turns = sorted(((t is not None, t or 0, s or "system", x or "") for c, t, s, x in rows if c == conv))
        for who in {t[2] for t in turns} - {"system"}:
            want[conv, who] = render([t[2:] for t in turns], who)
    assert set(got) == set(want)
    for key, parts in got.items():
        assert "".join(p.text for p in parts) == want[key][0]
        assert [(m.start, m.end) for p in parts for m in p["mask"]] == want[key][1]
        assert all(p.n_turns <= per_part for p in parts)
    assert dialogue.rotate(frame_.limit(0), speaker="speaker").count() == 0


# ------------------------------------------------------------------------------------------------ pipeline

def test_pipeline(spark):
    """Stage by stage: what goes, what stays, and what the next one gets."""
    docs = corpus_pipeline.table(spark, FOLDER, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "decontamination", "secrets", "packing"]
    texts = dict(docs.select("doc_id", "text").collect())
    results, current = [], docs
    for name, stage in corpus_pipeline.STAGES:
        path = f"{ngram_join.durable.__globals__['scratch_path'](spark, name)}"
        stage(spark, current, FOLDER).write.parquet(path)
        current = spark.read.parquet(path)
        results.append(current)
    toxic, near, clean, secret, packed = results
    assert all(set(r.columns) == set(docs.columns) for r in results[:-1])
    labels = {r.doc_id: r.toxic for r in corpus_pipeline.table(spark, FOLDER, "labels").collect()}
    left = {r.doc_id for r in toxic.select("doc_id").collect()}
    assert not [i for i in left if labels.get(i)] and not [i for i, t in labels.items() if not t and i not in left]
    # near duplicates: what stays is one document of each group of the predecessor's
    sets = {i: shingle_set(texts[i]) for i in left}
    links = [(i, j) for i in left for j in left if j < i and jaccard(sets[i], sets[j]) >= 0.8]
    kept = {r.doc_id for r in near.select("doc_id").collect()}
    assert kept == {i for i, root in groups(links, sorted(left)).items() if i == root}
    hits = {r.doc_id: r.contaminated for r in queries.QUERIES["op9_decontamination"](spark, FOLDER).collect()}
    assert {r.doc_id for r in clean.select("doc_id").collect()} == {i for i in kept if not hits[i]}
    scanner = secrets.Scanner()
    after = dict(secret.select("doc_id", "text").collect())
    assert after == {i: secrets.redacted(texts[i], scanner.spans(texts[i])) for i in after} and len(after) == clean.count()
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(after)
    assert sorted(map(str, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(str, packed.collect()))
