"""Scans, rules, decontamination and toxicity against brute force, and their edge cases."""

import collections
import hashlib
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from exact_binomial import upper_tail_ok

from cellsurvey.llm import decontamination, quality, queries, secrets, toxicity

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, n_words string, kinds int"  # two names clash with result columns


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "x", 1) for i, t in enumerate(texts)], DOCS)


# ------------------------------------------------------------------------------------------------ secrets

def base_spans(text):
    out = []
    for kind, pattern, keep in (
        ("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 12),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
    ):
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text, re.ASCII) if keep(m)]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def crc_token(prefix, body):
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = secrets._BASE62[d] + digits
    return prefix + body + digits


def extended_key(payload=b"\x04\x88\xad\xe4" + bytes(range(74))):
    data = payload + hashlib.sha256(hashlib.sha256(payload).digest()).digest()[:4]
    value, out = int.from_bytes(data, "big"), ""
    while value:
        value, d = divmod(value, 58)
        out = secrets._BASE58[d] + out
    return out


SECRET_TEXTS = [
    None, "", "nothing here", "password=abcdefghijkl", "PassWord : 'ABCDEFGH.1234' token=\"short\" api_key: 0123456789ab",
    "tokentokentoken=aaaaaaaaaaaaaaaa", "secret=" + "f" * 40, "AKIA" + "A" * 14 + " AKIAAKIA" + "B" * 20 + " AKIA123", "0123456789abcde 0123456789abcdef0 é" + "ab" * 40,
    "İİ password=abcdefghijkl", "Key apiKey=abcdefghijklmn paſsword=abcdefghijklmn", "password=secret=token=abcdefghijklmnop",
    "password" * 2000 + "=aaaaaaaaaaaaaaaa", "x" * 100_000 + " secret = 0123456789abcdef" + "0" * 5000, "api_key='password=abcdefghijklm",
]


@pytest.mark.parametrize("text", SECRET_TEXTS)
def test_base_spans(text):
    found = [s for s in secrets.Scanner().spans(text or "") if s[0] in secrets.BASE_KINDS]
    assert found == base_spans(text or "")


def test_checksums():
    good = crc_token("ghp_", "a1B2c3D4e5" * 3)
    npm, key = crc_token("npm_", "Z" * 30), extended_key()
    text = f"{good} {good[:-1]}_ {npm} {key} {key[:-1]}{'A' if key[-1] != 'A' else 'B'} ghp_{'a' * 36}"
    kinds = [k for k, s, e in secrets.Scanner().spans(text) if k not in secrets.BASE_KINDS]
    assert kinds == ["github", "npm", "bip32"]
    # a wrong check sum is no secret
    assert not secrets.Scanner().spans("npm_" + "Z" * 36)


def test_secret_query(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op1_secrets"](spark, FOLDER).collect()}
    for doc_id, text in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect():
        want = base_spans(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert got[doc_id].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[doc_id].n_assign, got[doc_id].n_access, got[doc_id].n_hex] == [sum(s[0] == k for s in want) for k in secrets.BASE_KINDS]


def test_redact(spark):
    docs = docs_of(spark, SECRET_TEXTS).withColumn("n_chars", F.length("text").cast("bigint"))
    rows = secrets.redact(docs).collect()
    assert len(rows) == len(SECRET_TEXTS) and rows[0].text is None and rows[2].text == "nothing here" and rows[3].text == "<assign>"
    assert all(not base_spans(r.text or "") for r in rows) and all(r.text is None or r.n_chars == len(r.text) for r in rows)
    assert secrets.redacted("abcdef", [("hex", 0, 4), ("assign", 2, 5)]) == "<hex>f"
    assert secrets.scan_secrets(docs.limit(0)).count() == 0


# ------------------------------------------------------------------------------------------------ quality rules

def brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


QUALITY_TEXTS = [
    None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a", "a a a", "x\ny\nx\n \n \nx", "a b c d a b c d a b c d",
    "#|<> $ é é", "same line\nsame line\r\nsame line\n", "w " * 5000, " ".join(f"w{i % 700}" for i in range(4000)), "a\x0bb\x0cc a\x0bb\x0cc",
]


def test_statistics(spark):
    got = {r[0]: tuple(r[1:]) for r in quality.statistics(docs_of(spark, QUALITY_TEXTS)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
    for i, text in enumerate(QUALITY_TEXTS):
        assert got[i] == brute_statistics(text), text


def test_quality_query(spark):
    texts = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    rows = queries.QUERIES["op3_quality_rules"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, chars, symbols, dup, repeat = brute_statistics(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n)
        assert r.kept == (not r.base_failed and r.failed_rules == "")


def test_binomial(spark):
    cases = [(0, 10), (0, 1000), (3, 1000), (5, 100), (0, 0), (40, 10_000), (20, 10_000), (900, 100_000), (1, 1), (4500, 1_000_000)]
    for p in (0.005, 0.02):
        rows = spark.createDataFrame(cases, "k long, n long").withColumn("t", quality.binomial_tail(F.col("k"), F.col("n"), p)).collect()
        for k, n, t in rows:
            assert upper_tail_ok(k, n, p, t), (k, n, p, t)


def test_cutoffs_keep_good_documents(spark):
    """5000 good documents without symbols, 40 good ones with many: a cutoff is chosen that rejects few enough."""
    rows = [("en", 100, 500, i % 125 == 0 and 60 or 0, 5, 0, 0, 1) for i in range(5000)] + [("de", 100, 500, 90, 5, 0, 0, 1)] * 30
    frame = spark.createDataFrame(rows, "lang string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, quality int")
    loose = {(r.lang, r.rule): r for r in quality.select_cutoffs(frame, risk=0.08).collect()}
    assert loose["en", "symbols"].cutoff == 0.02 and loose["en", "symbols"].n_rejected == 40
    strict = {(r.lang, r.rule): r for r in quality.select_cutoffs(frame, risk=0.02).collect()}
    assert strict["en", "symbols"].cutoff == 0.75  # 40 of 5000 are too many for 0.5 %
    assert not [k for k in strict if k[0] == "de"]  # 30 documents prove nothing
    assert quality.select_cutoffs(frame.limit(0)).count() == 0


def test_quality_without_labels_or_rows(spark):
    docs = docs_of(spark, QUALITY_TEXTS).withColumn("lang", F.lit(None).cast("string"))
    labels = spark.createDataFrame([(None, 1), (0, 1), (0, 0), (99, None)], "doc_id long, quality int")
    rows = quality.judge(docs.union(docs.limit(1)), labels).collect()
    assert len(rows) == len(QUALITY_TEXTS) + 1 and not any(r.failed_rules for r in rows)
    assert quality.judge(docs.limit(0), labels.limit(0)).count() == 0


# ------------------------------------------------------------------------------------------------ decontamination

def brute_hits(text, items, window=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = words(text), set(), set()
    for item_id, t in items:
        x = words(t)
        if item_id is None:
            continue
        for s in range(max(1, len(x) - window + 1) if x else 0):
            part = x[s : s + window]
            for p in range(len(w) - len(part) + 1):
                if w[p : p + len(part)] == part:
                    hit |= set(range(p, p + len(part)))
                    found.add(str(item_id))
    return len(w), len(hit), sorted(found)


ITEMS = [(1, " ".join(f"a{i}" for i in range(30))), (2, "short item"), (3, "one"), (4, None), (5, "..."), (10, "short item"), (None, "zz"),
         (6, "rep " * 20), (7, "É Ünicode-wörter, x9")]
HIT_TEXTS = [
    None, "", "...", "one", "SHORT, item! one short", " ".join(f"A{i}" for i in range(13)), " ".join(f"a{i}" for i in range(5, 17)), "rep " * 13, "rep " * 40,
    "é É ünicode wörter x9 Ünicode wörter x9", "b " * 500 + " ".join(f"a{i}" for i in range(3, 20)), "w " * 400 + "short item " + "w " * 400, "short item short item" * 3,
]


@pytest.mark.parametrize("block", [200_000, 3])
def test_hits(spark, block):
    docs = docs_of(spark, HIT_TEXTS)
    docs = docs.union(docs.filter("doc_id = 4"))
    bench = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")
    rows = decontamination.find_hits(docs, bench, block_windows=block).collect()
    assert len(rows) == len(HIT_TEXTS) + 1
    for r in rows:
        n, hit, items = brute_hits(HIT_TEXTS[r.doc_id], ITEMS)
        assert (r.n_words, r.n_hit, r["items"]) == (n, hit, items), r.doc_id
        assert r.contaminated == (hit > 0 and 20 * hit >= n) and r.kinds == 1
    assert decontamination.find_hits(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert decontamination.find_hits(docs.limit(0), bench).count() == 0


def test_decontamination_query(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    texts = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").filter("length(text) < 4000").collect())
    got = {r.doc_id: r for r in queries.QUERIES["op9_decontamination"](spark, FOLDER).collect()}
    assert sum(r.contaminated for r in got.values()) > 0
    for doc_id, text in texts.items():
        n, hit, found = brute_hits(text, items)
        r = got[doc_id]
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(found))
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()


# ------------------------------------------------------------------------------------------------ toxicity

def test_held_out_accuracy(spark):
    """Half of the labels train, the other half is predicted."""
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id", F.lit("test")), F.lit(2)) == 0
    chain = toxicity.train(docs, labels.filter(half))
    judged = toxicity.score(docs.select("doc_id", "text", F.lit(7).alias("p_toxic")), chain).select("doc_id", "is_toxic").join(labels.filter(~half), "doc_id")
    n = {(t, p): c for t, p, c in judged.groupBy("toxic", "is_toxic").count().collect()}
    assert n[1, True] >= 0.85 * (n[1, True] + n.get((1, False), 0)) and n.get((0, True), 0) <= 0.003 * n[0, False]


def test_chain_uses_out_of_fold_probabilities(spark):
    texts = [f"good words number {i} here" for i in range(60)] + [f"you idiot number {i} here" for i in range(20)] + [f"veiledslur number {i} here" for i in range(20)]
    docs = docs_of(spark, texts + [None, "", "plain"])
    labels = spark.createDataFrame([(i, int(i >= 60)) for i in range(100)] + [(3, 0), (None, 1), (500, 1), (101, None)], "doc_id long, toxic int")
    chain = toxicity.train(docs, labels)
    assert [len(m.dense) for m in chain.models] == [1, 2, 3]  # bias and the earlier probabilities
    got = {r.doc_id: r for r in toxicity.score(docs, chain).collect()}
    assert len(got) == len(texts) + 3 and not got[100].is_toxic and not got[101].is_toxic
    assert all(got[i].is_toxic == (i >= 60) for i in range(100))
    assert got[65].p_insult > 0.5 > got[65].p_veiled and got[90].p_veiled > 0.5 > got[90].p_insult


def test_one_class_or_nothing(spark):
    docs = docs_of(spark, ["a", None, "b c"])
    labels = spark.createDataFrame([(0, 0), (2, 0)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0)):
        assert [r.is_toxic for r in toxicity.score(docs, toxicity.train(docs, some)).collect()] == [False] * 3


def test_a_fold_is_fitted_in_little_memory():
    """A task holds the occurrences of its training rows once, not further rows and not many numbers of 64 bits for each."""
    rng, n, per = np.random.default_rng(3), 2000, 1000
    rows = pa.table({
        "held": pa.array(np.zeros(n, np.int32)), "doc_id": pa.array(np.arange(n)),
        "features": pa.ListArray.from_arrays(pa.array(np.arange(0, n * per + 1, per, dtype=np.int32)), pa.array(rng.integers(0, 1 << 14, n * per).astype(np.int32))),
        "y": pa.array(np.repeat([0.0, 1.0], n // 2)), "earlier": pa.array([[0.5]] * n)})
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    model = toxicity._round(1 << 14, -9.0)(rows)  # hardly a feature is unused
    numpy_peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model["ids"][0]) > 15_000 and pa.total_allocated_bytes() - before < n * per * 4
    assert numpy_peak < n * per * 20


def test_folds_get_the_features_of_their_category():
    features = pa.array([[1, 2, 3], [], [2, 4]], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([7, 8, 9]), features, pa.array([0, 1, 0], pa.int32()), pa.array([1.0, 0.0, 1.0])], names=["doc_id", "features", "fold", "veiled"])
    model = toxicity.Model(np.array([2], np.int32), np.array([1.5]), np.array([0.25]))
    out = next(toxicity._training("veiled", np.array([2, 3], np.int32), [[model, None, model]], 8)(iter([batch])))
    assert out["features"].to_pylist() == [[2, 3], [], [2]] and out["y"].to_pylist() == [1, 0, 1]
    p = 1 / (1 + np.exp(-1.75))
    assert np.allclose([e[0] for e in out["earlier"].to_pylist()], [p, 0, p])
