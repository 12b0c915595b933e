"""Page text, whitening and fill-in-the-middle: edge cases, and whole small tables against brute force."""

import hashlib
import html
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import SF
from pyspark.sql import functions as F

from phaseloom.llm import fim, html_text, whitening
from phaseloom.llm.queries import QUERIES

PAGE = "page_id long, url string, html string"


# Page text


def _main(page):
    return [t for kind, _, t in html_text.page_texts(page) if kind == html_text.MAIN]


def test_op11(spark):
    pages = {r["page_id"]: r for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()}
    rows = QUERIES["op11_html_text"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]]["html"], re.S)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", p))).strip() for p in re.split(r"</?p>|</?h1>|<br>", article)]
        want = "\n".join(p for p in parts if p)
        assert (r["url"], r["text"], r["n_chars"]) == (pages[r["page_id"]]["url"], want, len(want))


def test_markup():
    page = """<!DOCTYPE html><html class="no-js menu"><head><title>T &lt;/b></title><style>p{}</style><script>var x="</p>";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li>a<li>b</ul></nav><div id="cookie-notice">We use cookies</div>
    <article class="post"><header><h1>A  title</h1></header><p>One &amp; two<b>bold
    <br><p>x &lt; y, a<5 &eacute;&#233;&nbsp;z<!-- no --> end<div class="ad">buy</div>
    <form><label>mail</label><input></form><blockquote>Q</blockquote><table><tr><td>1<td>2</tr><tr><th>3</th></tr></table>
    <aside>side</aside><section id="comments"><article>first!</article></section><article>nested</article><ul><li>i</li><li>j</ul></p></div>
    last</article><div class="comment-list">c</div><footer>&copy; f"""
    assert _main(page) == ["A title", "One & twobold", "x < y, a<5 éé z end", "Q", "1 2", "3", "i", "j", "last"]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", []),
        ("   ", []),
        ("no tags", []),
        ("<article>a</div></section>b</article>", ["a", "b"]),
        ("<nav>never closed<article>text", ["text"]),
        ("<article><!-- open", []),
        ("<article>a<script>never closed", ["a"]),
        ("<main><p>m</p></main><aside>x</aside>", ["m"]),
        ("<article>&am; &amp &unknown; &#x41;</article>", ["&am; & &unknown; A"]),
        ("<article><p title='a>b'>c</p></article>", ["c"]),
        ("<article>a 　\t\n b</article>", ["a b"]),
    ],
)
def test_odd_pages(page, want):
    assert _main(page) == want


def test_suffix_array_orders_by_first_tokens():
    rng = np.random.default_rng(5)
    for size in (1, 2, 7, 300):
        tokens = rng.integers(0, 3, size)
        for depth in (1, 2, 5, 6, 8):
            order, rank = html_text.suffix_array(tokens, depth)
            own = [tuple(tokens[k : k + depth].tolist()) for k in range(size)]
            assert [own[k] for k in order] == sorted(own)
            assert all((rank[a] == rank[b]) == (own[a] == own[b]) for a in range(0, size, 11) for b in range(size))


def _covered(pages, n):
    """Brute force: for each page whether each of its tokens lies in a run of n that another page of the host has."""
    streams = {k: html_text.stream(html_text.page_texts(p["html"]), {}) for k, p in enumerate(pages)}
    seen: dict = {}
    for k, (ids, _) in streams.items():
        host = html_text._hosts([pages[k]["url"]])[0]
        for at in range(len(ids) - n + 1):
            if (ids[at : at + n] >= 0).all():
                seen.setdefault((host, tuple(ids[at : at + n])), set()).add((pages[k]["page_id"], pages[k]["url"]))
    out = {}
    for k, (ids, owner) in streams.items():
        host, hit = html_text._hosts([pages[k]["url"]])[0], np.zeros(len(ids), bool)
        for at in range(len(ids) - n + 1):
            if len(seen.get((host, tuple(ids[at : at + n])), ())) > 1:
                hit[at : at + n] = True
        out[k] = sum(2 * hit[owner == j][1:].sum() >= (owner == j).sum() - 1 for j in set(owner.tolist()) - {-1})
    return out


def test_coverage_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(9)]
    say = lambda: " ".join(rng.choice(words, rng.integers(1, 9)))
    lines = [say() for _ in range(12)]
    pages = []
    for k in range(160):
        parts = [f"<div>{rng.choice(lines) if rng.random() < 0.6 else say()}</div>" for _ in range(rng.integers(0, 6))]
        if rng.random() < 0.4:
            parts.insert(rng.integers(0, len(parts) + 1), f"<article><p>{rng.choice(lines)}</p></article>")
        pages.append({"page_id": k, "url": f"http://h{rng.integers(0, 6)}.org/{k}", "html": "".join(parts)})
    out = {r["page_id"]: r["n_covered"] for r in html_text.extract(spark.createDataFrame(pages, PAGE).repartition(7)).collect()}
    assert out == _covered(pages, 6)


def test_unique_runs_stay_where_no_markup_tells(spark):
    top, bottom = "Home of the very large site about many things", "All rights are kept by the owners of this site"
    rows = [(k, f"http://h{k % 2}.org/{k}", f"<div>{top}</div><div><p>Own text number {k} with words w{k} v{k}</p></div><div>{bottom}</div>") for k in range(12)]
    rows += [(50, "http://one.org/", f"<p>{top}<p>alone"), (None, None, None), (51, "no host", ""), (1, rows[1][1], rows[1][2])]
    df = spark.createDataFrame(rows, PAGE)
    for c in ("row", "page", "run", "covered", "text", "low", "at"):
        df = df.withColumn(c, F.lit("x"))
    out = html_text.extract(df.repartition(4)).collect()
    assert len(out) == len(rows)
    for r in out:
        if r["page_id"] is None or r["page_id"] == 51:
            assert (r["text"], r["n_chars"]) == ("", 0)
        elif r["page_id"] == 50:
            assert r["text"] == f"{top}\nalone"
        else:
            assert r["text"] == f"Own text number {r['page_id']} with words w{r['page_id']} v{r['page_id']}"
    assert html_text.extract(spark.createDataFrame([], PAGE)).count() == 0


def test_a_page_and_its_copy_are_one_page(spark):
    rows = [(1, "http://h/1", "<div>the same text on the same page twice over</div>")] * 3
    assert [(r["text"], r["n_covered"]) for r in html_text.extract(spark.createDataFrame(rows, PAGE).repartition(3)).collect()] == [("the same text on the same page twice over", 0)] * 3


# Whitening

VEC = "vec_id long, embedding array<float>"


def _check_whitened(spark, rows, w=whitening.Whitening()):
    df = spark.createDataFrame(rows, VEC).withColumns({c: F.lit("x") for c in ("x", "n", "mean", "rows", "dim")})
    out = whitening.whiten(df.repartition(5), w).collect()
    dims = max((len(v) for _, v in rows if v), default=0)
    kept = [(k, [int(np.floor(w.scale * np.float64(np.float32(c)))) + w.offset for c in v]) for k, v in rows if v and len(v) == dims and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), np.int64).reshape(-1, dims)
    n, sums = len(fit), [int(s) for s in fit.sum(0)]
    parts = min(w.components, dims)
    assert len(out) == len(kept) * parts
    told = sorted((str(k), str(sum((n * v - s) ** 2 for v, s in zip(x, sums, strict=True)))) for k, x in kept)
    assert sorted((str(r["vec_id"]), str(r["deviation"])) for r in out if r["component"] == 1) == told
    assert {r["n"] for r in out} <= {n}
    return out, fit, kept


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 20)) * np.linspace(3, 0.2, 20)
    rows = [(k, [float(c) for c in np.float32(v)]) for k, v in enumerate(base)]
    rows += [(1000 + k, rows[7][1]) for k in range(200)] + [(None, rows[8][1]), (7, rows[9][1])]
    rows += [(2000, None), (2001, []), (2002, [None] * 20), (2003, [float("nan")] + [0.0] * 19), (2004, [0.0] * 19 + [float("-inf")]), (2005, [1.0] * 19)]
    out, fit, kept = _check_whitened(spark, rows)
    centred = fit - fit.mean(0)
    e, v = np.linalg.eigh(centred.T @ centred / len(fit))
    e, v = e[::-1], v[:, ::-1]
    for c in range(16):
        own = {r["vec_id"]: r for r in out if r["component"] == c + 1 and r["vec_id"] is not None and r["vec_id"] != 7}
        want = {k: (np.array(x) - fit.mean(0)) @ v[:, c] / np.sqrt(e[c]) for k, x in kept if k is not None and k != 7}
        signs = np.sign([own[k]["whitened"] * want[k] for k in want])
        assert abs(signs.sum()) == len(signs)
        assert np.allclose([own[k]["whitened"] * signs[0] for k in want], list(want.values()), atol=1e-9)
        assert abs(own[0]["explained"] - e[c] / e.sum()) < 1e-12
    assert all(r["identity_error"] < 1e-9 for r in out)


def test_whitening_without_variance(spark):
    out, *_ = _check_whitened(spark, [(1, [1.0, 2.0, 3.0])] * 4)
    assert {(r["whitened"], r["explained"], r["identity_error"], r["deviation"]) for r in out} == {(None, 0.0, 0.0, 0)}
    out, *_ = _check_whitened(spark, [(1, [1.0, 2.0, 3.0]), (2, [2.0, 2.0, 3.0])])
    assert {(r["component"], r["whitened"] is None) for r in out} == {(1, False), (2, True), (3, True)}
    assert [abs(r["whitened"]) for r in out if r["component"] == 1] == pytest.approx([1, 1])
    for rows in ([], [(1, None)], [(1, [None])]):
        assert whitening.whiten(spark.createDataFrame(rows, VEC)).count() == 0


def test_deviations_beyond_fast_arithmetic():
    x = np.array([[2**40, 5], [0, 7]], np.int64)
    sums = [2**40, 12]
    exact = [sum((2 * int(v) - s) ** 2 for v, s in zip(r, sums, strict=True)) for r in x]
    assert whitening._deviations(x, 2, sums) == [e if e < 2**63 else None for e in exact] == [None, None]
    assert whitening._deviations(x % 1000, 2, [776, 12]) == [sum((2 * int(v) - s) ** 2 for v, s in zip(r, [776, 12], strict=True)) for r in x % 1000]


def test_merging_loses_nothing():
    rng = np.random.default_rng(6)
    x = rng.integers(-500, 500, (400, 12)) + 1_000_000
    part = (0, np.zeros(12), np.zeros((0, 12)))
    for k in (0, 1, 3, 50, 51, 200, 400):
        own = x[:k] if part[0] == 0 else x[part[0] : k]
        part = whitening.merged(part, whitening._start(own)) if len(own) else part
    c = x - x.mean(0)
    assert part[0] == 400 and np.allclose(part[1], x.mean(0), rtol=1e-14) and np.allclose(part[2].T @ part[2], c.T @ c, rtol=1e-10, atol=1e-4)


# Fill-in-the-middle

TEXTS = [
    (1, None),
    (2, ""),
    (3, "a b  c\n"),
    (4, " \t "),
    (None, "hello <P> world"),
    (None, "x y z w"),
    (7, "ä 漢字 \U0001f600\U0001f600 b　c  "),
    (7, "ä 漢字 \U0001f600\U0001f600 b　c  "),
    (7, "another text of one id"),
    (8, "w " * 30_000),
    (9, "a<S>b"),
]


def _brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n = len(units)
    told = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(told[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fim_against_brute_force(spark):
    rows = TEXTS + [(k, " ".join(f"w{j}" for j in range(k % 13)) + " " * (k % 3)) for k in range(10, 260)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("k1", "k2", "n", "form", "first", "second", "ordinal", "chars", "p", "m", "s")})
    out = fim.transformed(df.repartition(5)).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert all(r["back"] == r["text"] for r in out)
    key = lambda x: str(tuple(x))
    assert sorted([key(r[c] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")) for r in out]) == sorted(map(key, (_brute(*r) for r in rows)))
    assert {r["form"] for r in out} == {"plain", "spm", "psm"}
    assert fim.digests(df.limit(0)).count() == 0
