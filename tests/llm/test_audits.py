"""Main text, whitening and source divergence against brute force and hand-written cases."""

from __future__ import annotations

import random
import re
from collections import Counter
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest

from llm import divergence, main_text, whitening

# --- main text -----------------------------------------------------------------------------------

LONG_TEXT = "The paragraph of the story is long and it is in the middle of the page, so that it can be decided by its own words."


def _page(*parts):
    return "<html><head><title>The title of it</title><script>var t='<p>no</p>';</script></head><body>" + "".join(parts) + "</body></html>"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (None, ""),
        ("", ""),
        ("plain & simple", ""),
        (LONG_TEXT, LONG_TEXT),
        (_page("<nav><a href='/'>Home</a></nav>", f"<article><h1>Title</h1><p>{LONG_TEXT}</p><p>Short.</p></article>", "<footer>The end</footer>"), f"Title\n{LONG_TEXT}\nShort."),
        (_page(f"<article><h1>A</h1><p>{LONG_TEXT}<div class='ad'>{LONG_TEXT}</div><p>B &amp;lt; c&nbsp;&#x41;</article>"), f"A\n{LONG_TEXT}\nB &lt; c A"),
        (_page(f"<article><p>{LONG_TEXT}</p></article><section id='comments'><article><p>{LONG_TEXT}</p></article></section>"), LONG_TEXT),
        (_page(f"<div class='content no-sidebar'><p>{LONG_TEXT}</p><p>Short.</p></div><div class='sidebar-left'><p>{LONG_TEXT}</p></div>"), f"{LONG_TEXT}\nShort."),
        (_page(f"<p><b>{LONG_TEXT}<br><p>a\n\t b<form><p>{LONG_TEXT}</p></form>"), f"{LONG_TEXT}\na b"),
        (_page(f"<article><p>{LONG_TEXT}</p><p><a href='/x'>Read more of this and that</a></p></article>"), LONG_TEXT),
        (_page("<article><p>Xyz.</p><p>Qrs.</p></article>"), "Xyz.\nQrs."),
        (f"<article><p title='a > b'>{LONG_TEXT}</p><!-- <p>no</p> --><p>yes</p><p>cut <a hre", f"{LONG_TEXT}\nyes\ncut"),
        (f"<article><p>{LONG_TEXT}</p><script>no", LONG_TEXT),
        (f"<article><p>{LONG_TEXT} 1 < 2</p></article>", f"{LONG_TEXT} 1 < 2"),
        (_page(f"<article><header><h1>Head</h1></header><p>{LONG_TEXT}</p></article>"), f"Head\n{LONG_TEXT}"),
        (_page(f"<div role='dialog'>{LONG_TEXT}</div><p style='x'>{LONG_TEXT}</p><div style='display: none'>{LONG_TEXT}</div>"), LONG_TEXT),
        ("<article><p>" + "<b>x" * 50_000 + "</p></article>", "x" * 50_000),
        ("<article>" + f"<div><p>{LONG_TEXT}</p>" * 3000, "\n".join([LONG_TEXT] * 3000)),
    ],
)
def test_main_text(html, want):
    assert (main_text.main_text(html) if html else "") == want


def test_second_pass():
    def block(article=0, out=False, text="x"):
        return main_text.Block(text, article, out, 0)

    decide = main_text.second_pass
    assert decide([block() for _ in range(4)], [False, None, None, True]) == [False, False, True, True]
    assert decide([block() for _ in range(3)], [False, None, True]) == [False, False, True]
    assert decide([block(1) for _ in range(3)], [False, None, True]) == [False, True, True]
    assert decide([block(1, out=True), block(1), block(1)], [False, None, None]) == [False, True, True]
    assert decide([block(), block(text="y" * 100)], [None, None]) == [False, True]
    assert decide([], []) == []


def test_pages(spark):
    rows = [(1, "u", _page(f"<article><p>{LONG_TEXT}</p></article>"), "clash"), (1, "u", _page(f"<article><p>{LONG_TEXT}</p></article>"), "clash"), (None, None, None, None), (2, "é", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in main_text.extract(pages).collect()), key=repr)
    assert got == sorted([(1, "u", LONG_TEXT, len(LONG_TEXT))] * 2 + [(None, None, "", 0), (2, "é", "", 0)], key=repr)
    assert main_text.extract(pages.limit(0)).collect() == []


def test_registered_pages(spark, folder):
    from llm.queries import QUERIES

    got = {r["page_id"]: r["text"] for r in QUERIES["op11_block_rules_main_text"](spark, folder).collect()}
    for page in spark.read.parquet(f"{folder}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", page["html"], re.DOTALL)[1]
        words = main_text.html.unescape(re.sub(r"<[^>]*>", " ", article)).split()
        assert got[page["page_id"]].split() == words


# --- whitening -------------------------------------------------------------------------------------


def _exact_polynomial(matrix):
    """Faddeev and LeVerrier's recurrence, lowest coefficient first."""
    d = len(matrix)
    a = np.array([[Fraction(x) for x in row] for row in matrix], object)
    one = np.array([[Fraction(i == j) for j in range(d)] for i in range(d)], object)
    c, m = [Fraction(1)], one * 0
    for k in range(1, d + 1):
        m = a @ m + c[-1] * one
        c.append(-(a @ m).trace() / k)
    return [int(x) for x in reversed(c)]


@pytest.mark.parametrize("d", [1, 2, 3, 5, 9])
def test_characteristic_polynomial(spark, d):
    rng = np.random.default_rng(d)
    b = rng.integers(-(10**6), 10**6, (d, d + 2))
    b[:, 0] *= d % 2  # a zero row of the Hessenberg form in some of the cases
    matrix = (b @ b.T).tolist()
    assert whitening.characteristic_polynomial(spark, matrix) == _exact_polynomial(matrix)
    diagonal = [[(i + 1) * (i == j) for j in range(d)] for i in range(d)]
    assert whitening.characteristic_polynomial(spark, diagonal) == _exact_polynomial(diagonal)


def test_roots():
    polynomial = [1]
    for root in (7, 7, 5, 1, 0):
        polynomial = [a - root * b for a, b in zip([0, *polynomial], [*polynomial, 0], strict=True)]
    close = [float(r) for r in whitening.largest_roots(polynomial, 8)]
    assert close == pytest.approx([7, 7, 5, 1], rel=1e-15)
    assert whitening.roots_above(polynomial, 1) == 3
    assert whitening.roots_above(polynomial, 0) == 4
    assert whitening.largest_roots([0, 1], 3) == []
    vectors = whitening.unit_vectors([[2, 0, 0], [0, 2, 0], [0, 0, 1]], [Decimal(2), Decimal(2), Decimal(1)])
    gram = np.array([[float(a @ b) for a in vectors] for b in vectors])
    assert np.abs(gram - np.eye(3)).max() < 1e-15


def _reference_whitening(vectors):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    z = x - s / n
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    return ((n * x - s) ** 2).sum(axis=1), z @ u / np.sqrt(e), e / (z.T @ z / n).trace()


@pytest.mark.parametrize("size", [6, 12])
def test_whitening(spark, size):
    rng = np.random.default_rng(5)
    good = (rng.normal(size=(200, size)) * np.linspace(1, 3, size)).astype(np.float32).tolist()
    good.append(good[0])
    bad = [None, [None] * size, [1.0] * (size - 1), [float("nan")] * size, [float("inf")] + [0.0] * (size - 1), []]
    rows = [(k, v, "clash", 1) for k, v in enumerate(good + bad)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string, n int").repartition(3)
    got = whitening.whiten(vectors).toPandas().sort_values(["vec_id", "component"])
    deviation, whitened, explained = _reference_whitening(good)
    number = min(8, size)
    assert got["vec_id"].tolist() == np.repeat(np.arange(len(good)), number).tolist()
    assert got["deviation"].astype(object).tolist() == [Decimal(int(x)) for x in np.repeat(deviation, number)]
    np.testing.assert_allclose(np.abs(got["whitened"].to_numpy().reshape(-1, number)), np.abs(whitened), rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(got["explained"].to_numpy()[:number], explained, rtol=1e-12)
    assert got["n"].unique().tolist() == [len(good)]
    assert got["identity_error"].max() < 1e-12


def test_whitening_of_little(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, []), (2, None)], schema)).collect() == []
    two = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (None, [3.0, 2.0])], schema)).collect()
    assert sorted(abs(round(r["whitened"], 6)) for r in two) == [0.707107, 0.707107, 1.414214]
    assert {r["component"] for r in two} == {1}
    large = [(k, [1e9 * k, 5e12 * (k % 3)]) for k in range(50)]
    got = whitening.whiten(spark.createDataFrame(large, schema)).toPandas()
    deviation = {}
    x = [[int(1024 * c) + 100_000 for c in v] for _, v in large]
    for (k, _), row in zip(large, x, strict=True):
        deviation[k] = sum((50 * a - sum(r[i] for r in x)) ** 2 for i, a in enumerate(row))
    assert all(int(r.deviation) == deviation[r.vec_id] for r in got.itertuples())
    assert got["identity_error"].max() < 1e-9


# --- source divergence -------------------------------------------------------------------------------


def _audit(rows, least, top):
    docs = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), g or "", s or "") for t, g, s in rows]
    inside = Counter((g, w) for words, g, _ in docs for w in set(words))
    kept = {x for x, n in inside.items() if n >= least}
    counts = Counter((g, s, w) for words, g, s in docs for w in words if (g, w) in kept)
    whole = Counter((g, w) for words, g, _ in docs for w in words if (g, w) in kept)
    out = []
    groups = sorted({(g, s) for _, g, s in docs})
    for g, s in groups:
        words = [w for h, w in kept if h == g]

        def share(n, total, v=len(words)):
            return 1 + 10**9 * (n + 2) // (total + 2 * v)

        def p(source, g=g, words=words, share=share):
            total = sum(counts[g, source, w] for w in words)
            return {w: share(counts[g, source, w], total) for w in words}

        mine, total = p(s), sum(whole[g, w] for w in words)
        pairs = []
        for h, other in groups:
            if h == g and other != s:
                theirs = p(other)
                pairs.append((sum((mine[w] - theirs[w]) ** 2 // (mine[w] + theirs[w]) for w in words), other))
        q = {w: share(whole[g, w], total) for w in words}
        terms = [((mine[w] - q[w]) ** 2 // (mine[w] + q[w]), w) for w in words if counts[g, s, w] and mine[w] > q[w]]
        for part, found in (("pair", pairs), ("term", terms)):
            found = sorted(found, key=lambda x: (-x[0], x[1].encode()))
            out += [(g, s, part, item, value, k + 1) for k, (value, item) in enumerate(found) if part == "pair" or k < top]
    return sorted(out)


@pytest.fixture(scope="module")
def audited():
    rng = random.Random(9)
    words = ["the", "The", "th", "t", "then", "é", "éa", "中文字", "x" * 300, "x" * 299 + "y", "a" * 64, "a" * 63, "a" * 65, "A1b_c"]
    words += ["".join(rng.choices("abc", k=rng.randint(1, 12))) for _ in range(60)]
    out = []
    for k in range(90):
        text = " ".join(rng.choices(words, weights=[5] * 14 + [1] * 60, k=rng.randint(0, 40)))
        out.append((text, rng.choice(["en", "fr", None]), rng.choice(["s1", "s1", "s1", "s2", None, "é"])))
    return [*out, (None, "en", "empty"), ("", "zz", "s1"), ("123 ...", "zz", "s2"), *[("twice the same", "en", "s1")] * 2]


def test_divergence(spark, audited):
    rows = [(*r, "clash", "clash", 1) for r in audited]
    docs = spark.createDataFrame(rows, "text string, lang string, source string, term string, prefix string, count int").repartition(4)
    want = _audit(audited, 10, 10)
    assert len(want) > 50
    assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == want
    # a full bitmap prunes nothing, tiny tasks split everything: the results stay
    assert sorted(tuple(r) for r in divergence.audit(docs, bits=64, task_cells=5).collect()) == want
    assert sorted(tuple(r) for r in divergence.audit(docs, least=1, top=3).collect()) == _audit(audited, 1, 3)
    assert divergence.audit(docs.limit(0)).collect() == []


def test_prefix_levels(spark, audited, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_BYTES", 500)
    docs = spark.createDataFrame(audited, "text string, lang string, source string").coalesce(2)
    blocked = divergence.blocks(docs)
    got = {(r["lang"], bytes(r["prefix"])): r["docs"] for r in divergence.level_counts(blocked, 2, 0, None, 64).collect() if not r["complete"]}
    want = Counter((g or "", x) for t, g, _ in audited for x in {w[:2] for w in re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").encode().lower()) if len(w) > 2})
    assert got == want
