"""Spelling variants, ranked search and page texts against brute force, and their edge cases."""

import collections
import html
import math
import random
import re
import zlib

import numpy as np
import pytest

from cellsurvey.llm import html_text, lexical_search, queries, spelling

FOLDER = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}
CLASHING = "doc_id long, text string, word string, n string, shard int, reduced int, term string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "w", "n", 1, 2, "t") for i, t in rows], CLASHING)


# ------------------------------------------------------------------------------------------------ spelling variants

def brute_variants(rows, least_length=5, least_count=3, drop_one_in=97):
    counts = collections.Counter()
    for doc_id, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if drop_one_in and h % drop_one_in == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    kept = {w: n for w, n in counts.items() if n >= least_count and len(w) >= least_length}
    near = collections.defaultdict(set)
    masked = collections.defaultdict(set)
    for w in kept:
        for i in range(len(w)):
            masked[w[:i], w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in kept:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for group in masked.values():
        for w in group:
            near[w] |= group - {w}
    forms = {}
    for w in kept:
        if near[w]:
            best = min(near[w], key=lambda x: (-kept[x], x))
            if kept[best] >= 2 * kept[w]:
                forms[w] = best
    out = set()
    for w, n in kept.items():
        root = w
        while root in forms:
            root = forms[root]
        out.add((w, forms.get(w), root, n, len(near[w]), kept[forms[w]] if w in forms else None))
    return out


def test_variant_query(spark):
    rows = [tuple(r) for r in queries.table(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    got = queries.op11_spelling_variants(spark, FOLDER).collect()
    assert {tuple(r) for r in got} == brute_variants(rows) and len(got) == len({r.word for r in got})


@pytest.mark.parametrize("symbols", [2, 8, 40])
def test_variants_on_small_words(spark, symbols):
    rng = random.Random(5)
    words = ["".join(rng.choice("abé÷") for _ in range(rng.randint(1, 6))) for _ in range(600)]
    rows = [(i % 7, " ".join(rng.choices(words, k=200))) for i in range(40)]
    rows += [(None, None), (None, "abab ABAB abaB"), (1, ""), (1, "x" * 3000 + " " + ("y" * 2000 + "-") * 3 + "—œuvre œuvre œuvre"), (3, rows[3][1]), (3, rows[3][1])]
    for kwargs in ({"least_length": 1, "least_count": 1, "drop_one_in": 5}, {"least_length": 3, "least_count": 2, "drop_one_in": 0}):
        got = spelling.variant_groups(docs_of(spark, rows), symbols=symbols, **kwargs)
        assert {tuple(r) for r in got.collect()} == brute_variants(rows, **kwargs)


def test_variant_chain_and_ties(spark):
    chain = ["abcde", "abcdf", "abcgf", "abhgf", "aihgf", "jihgf"]  # each twice as frequent as the one before
    text = " ".join(w for i, w in enumerate(chain) for _ in range(3 * 2 ** i)) + " zzzzz zzzzz zzzzz" + " zzzzy" * 6 + " zzzzx" * 6
    found = {r.word: r for r in spelling.variant_groups(docs_of(spark, [(1, text)])).collect()}
    assert all(found[w].root == "jihgf" for w in chain) and found["abcde"].form == "abcdf" and found["jihgf"].form is None
    assert found["zzzzz"].form == "zzzzx" and found["zzzzx"].form is None  # the tie goes to the smaller word


def test_no_documents(spark):
    empty = docs_of(spark, []).limit(0)
    assert spelling.variant_groups(empty).count() == 0
    index = lexical_search.build_index(empty)
    items = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert lexical_search.rank_documents(index, items).count() == 0
    with pytest.raises(ValueError):
        spelling.variant_groups(empty, least_ratio=1)


def test_neighbourhoods_are_complete():
    rng = random.Random(1)
    for _ in range(200):
        word = [rng.randint(1, 3) for _ in range(rng.randint(1, 7))]
        around = {tuple(word)} | {tuple(word[:i] + word[i + 1 :]) for i in range(len(word))}
        around |= {tuple(word[:i] + [c] + word[i + k :]) for k in (0, 1) for i in range(len(word) + 1 - k) for c in (1, 2, 3)}
        want = {int(spelling.reduced_keys(np.array([w], np.uint64))[0]) if w else 0 for w in around}
        assert set(spelling.neighbourhood_keys(np.array([word], np.uint64), 3)[0].tolist()) == want


# ------------------------------------------------------------------------------------------------ ranked search

TERM = "[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def brute_ranks(docs, items, k=20):
    counted = [(i, collections.Counter(re.findall(TERM, (t or "").translate(LOWER)))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in counted]
    n_docs, n_terms = sum(n > 0 for n in lengths), sum(lengths)
    df = collections.Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        uses, scored = collections.Counter(re.findall(TERM, (text or "").translate(LOWER))), []
        for (doc, c), n in zip(counted, lengths):
            m = 75 + 25 * n * n_docs // n_terms if n_terms else 0
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                        for t, times in uses.items() if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, r, doc, -s) for r, (s, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x) for x in r))


def test_search_query(spark):
    rows = lambda name, key: [tuple(r) for r in queries.table(spark, FOLDER, name).select(key, "text").collect()]
    got = order(queries.op12_lexical_search(spark, FOLDER).collect())
    assert got == order(brute_ranks(rows("documents", "doc_id"), rows("benchmark", "item_id")))


def random_corpus(seed, n=700):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)] + ["Ärger", "naïve", "日本", "x9"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i * 3 % 701, " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 60)))) for i in range(n)]
    docs += [(9000 + i, docs[5][1]) for i in range(100)]  # copies: ties
    docs += [(None, None), (9200, ""), (9201, "w1 " * 50_000 + "w3"), (9202, "!?"), (9203, "W0 w0\nW0-ÄRGER")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 30)))) for i in range(40)] + [(40, None), (41, ""), (42, "unknown"), (43, docs[5][1])]
    return docs, items


@pytest.mark.parametrize("shape", [dict(shard_docs=100, block=4), dict(shard_docs=16_384, block=64), dict(shard_bytes=2000, block=1)])
def test_search_against_brute_force(spark, shape):
    docs, items = random_corpus(3)
    index = lexical_search.build_index(docs_of(spark, docs).repartition(3), **shape)
    got = lexical_search.rank_documents(index, spark.createDataFrame(items, "item_id long, text string"), part=16)
    assert order(got.collect()) == order(brute_ranks(docs, items))


def test_repeated_documents_and_items(spark):
    docs, items = [(1, "a b"), (1, "a b"), (2, "a c"), (3, "d e f")], [(7, "a"), (7, "a"), (None, "c")]
    got = lexical_search.rank_documents(lexical_search.build_index(docs_of(spark, docs)), spark.createDataFrame(items, "item_id long, text string"))
    assert order(got.collect()) == order(brute_ranks(docs, items))  # every row of either table counts


def test_blocks_are_skipped():
    """Once a rare term has filled the heap, most blocks of a common term are never unpacked, and the result is that of all of them."""
    rng = random.Random(2)
    ids = list(range(8000))
    texts = [("common " * rng.randint(1, 4) + "filler " * rng.randint(5, 60) + ("rare " * 5 if i % 90 == 0 else "")).encode() for i in ids]
    lengths = np.array([len(t.split()) for t in texts])
    _, terms = lexical_search.build_shard(0, ids, texts, 64)
    rows = {r["term"]: r for r in terms.to_pylist()}
    impact = lambda tf, n: 10 ** 9 * tf // (1000 * tf + 12 * (75 + 25 * n * 8000 // int(lengths.sum())))
    lists = [(lexical_search.PostingList(type("Row", (), rows[t]), impact), w) for t, w in (("common", 3), ("rare", 4500))]
    docs, scores = lexical_search.best_documents(lists, lengths, 20, window=500)
    dense = np.zeros(8000, np.int64)
    for t, w in (("common", 3), ("rare", 4500)):
        tf = np.array([x.split().count(t.encode()) for x in texts])
        dense += w * impact(tf, lengths) * (tf > 0)
    best = np.lexsort((np.arange(8000), -dense))[:20]
    assert docs.tolist() == best.tolist() and scores.tolist() == dense[best].tolist()
    assert len(lists[0][0]._blocks) < 0.7 * len(lists[0][0].last)


def test_packed_integers():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2 ** 31, 5, 2 ** 40], np.int64)
    assert lexical_search.unpack_ints(lexical_search.pack_ints(values)[0]).tolist() == values.tolist()
    assert len(lexical_search.pack_ints(values[:0])[0]) == 0


# ------------------------------------------------------------------------------------------------ page texts

def inside_article(source):
    """For the given tables, whose pages all have an article element."""
    blocks = re.split("</?(?:p|h1)>", re.search("<article>(.*)</article>", source, re.S)[1])
    lines = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def test_page_query(spark):
    pages = {r.page_id: r for r in queries.table(spark, FOLDER, "pages").collect()}
    got = queries.op13_html_text(spark, FOLDER).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, inside_article(pages[r.page_id].html), len(r.text))


S = "This sentence of the story has a comma, some length, and an end."
LONG = " ".join([S] * 4)
PAGES = [
    # menus, headers, sidebars, adverts, comments, forms and footers named by tag or class
    (f"""<html><body class="has-sidebar"><header class="site-header"><h1>Site</h1><nav><a href=/>Home</a></nav></header>
      <div id="content"><h1>Title &amp; more</h1><p class="byline">By A. Writer</p><p>{LONG}</p><p>Short.</p><ul><li>one<li>two <a href=x>link</a></ul>
      <div class="ad">Buy</div><blockquote><p>{S}</p></blockquote><h2>Part</h2><p>{S}<br>after</p><pre>x  =  1\n y</pre></div>
      <div class="sidebar"><p>{LONG}</p></div><section id="comments"><h2>Comments</h2><div class="comment"><p>{LONG}{LONG}</p></div></section>
      <form><label>Name</label><input></form><div class="cookie-notice"><p>{LONG}</p></div><footer>&copy; me</footer></body></html>""",
     f"Title & more\nBy A. Writer\n{LONG}\nShort.\none\ntwo link\n{S}\nPart\n{S} after\nx = 1 y"),
    # nothing is named: density decides, and both halves of the story are found
    (f"""<html><body><div><a href=1>Home</a> | <a href=2>News</a> | <a href=3>More</a></div><div><div><h1>Head</h1><div><p>{LONG}</p><p>{S}</p><p>Hi.</p></div>
      <div><p>{S}</p><p>{LONG}</p></div></div><div><a href=4>Related one</a><a href=5>Related two</a><a href=6>Related three</a></div></div>
      <div>Copyright 2020 somebody</div></body></html>""", f"Head\n{LONG}\n{S}\nHi.\n{S}\n{LONG}"),
    # a layout table, a page without paragraphs, text alone
    (f"<body><table><tr><td><a href=1>a</a><br><a href=2>b</a><br><a>c</a></td><td><p>{S}<p>{LONG}<p>{S}</td></tr></table></body>", f"{S}\n{LONG}\n{S}"),
    (f"<div id=main><div>{LONG}</div><div>{S}</div></div><div><ul><li><a>x</a><li><a>y</a><li><a>z</a></ul></div>", f"{LONG}\n{S}"),
    ("just text, no tags", "just text, no tags"),
    # scripts, comments and attributes that look like markup; references without a semicolon
    (f"<body><script>if (a<b) w('<p>no</p>')</script><!-- <p>no</p> --><div><p title='a > b'>{S}</p><p>x < y, AT&T &#8212; &eacute;&nbsp;&amp end</p></div>",
     f"{S}\nx < y, AT&T — é & end"),
    # comments may be articles, titles may lie outside the article
    (f"<main><h1>T</h1><article><header><h2>Sub</h2></header><p>{S}</p><aside>no</aside></article><article class='comment'><p>{LONG}</p></article></main>", f"T\nSub\n{S}"),
    ("<nav><a href=x>menu</a></nav><article><h1>Hi</h1></article><div class=ad>buy buy buy</div>", "Hi"),
    (f"<p><b>{S}<br><p>{S}</div></i></p>", f"{S}\n{S}"), ("", ""), (None, ""), ("<html><body></body></html>", ""), ("<", "<"), ("<p", ""), ("<!-- x", ""), ("<script>x", ""),
]


@pytest.mark.parametrize("source, text", PAGES)
def test_main_text(source, text):
    assert html_text.main_text(source) == text


def test_deep_and_long_pages():
    assert html_text.main_text("<div>" * 20_000 + S) == S
    assert html_text.main_text("<article>" + f"<p>{S}</p>" * 20_000 + "</article>") == "\n".join([S] * 20_000)
    assert html_text.main_text('<a b="' * 5000) == "" and html_text.main_text("<" * 20_000 + " x") == "<" * 20_000 + " x"


def test_page_rows(spark):
    rows = [(1, "u", PAGES[0][0], 5, "t"), (1, "u", PAGES[0][0], 5, "t"), (None, None, None, None, None), (3, "", "", 1, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string")
    got = html_text.extract_text(pages).collect()
    assert sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in got) == sorted(
        (i or 0, u or "", html_text.main_text(h), len(html_text.main_text(h))) for i, u, h, _, _ in rows)
    assert html_text.extract_text(pages.limit(0)).count() == 0
