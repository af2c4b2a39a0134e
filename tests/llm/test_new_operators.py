"""Token alignment, whitening and page texts against brute force, the libraries and plain linear algebra."""

import collections
import hashlib
import html
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.llm import align, pagetext, queries, whiten

SF = "/root/testdata/sf0.001"
public_tokenizers = pytest.importorskip("public_tokenizers")
supplied = pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables aren't here")


# 13


@pytest.fixture(scope="module")
def files():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as g:
        return f.read(), g.read()


def alignments(rows, files):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups), and pair counts, by comparing byte ranges."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_str(files[0]), sentencepiece.SentencePieceProcessor(model_proto=files[1])
    a.encode_special_tokens = True
    entry, code = {i: t for t, i in a.get_vocab().items()}, align.byte_characters()
    spell_a = lambda i: bytes(code[c] for c in entry[i])
    spell_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def ranges(ids, spell):
        ends = np.cumsum([0, *(len(spell(i)) for i in ids)]).tolist()
        return list(zip(ids, ends, ends[1:], strict=False))

    found, counts = [], collections.Counter()
    for text in rows:
        ia, ib = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        if not text or not b"".join(map(spell_a, ia)) == b"".join(map(spell_b, ib)) == (" " + text).encode():
            found.append(((0, 0, 0), [], ""))
            continue
        ra, rb = ranges(ia, spell_a), ranges(ib, spell_b)
        cuts = sorted({e for _, _, e in ra} & {e for _, _, e in rb})
        of = lambda r, lo, hi: ",".join(str(i) for i, _, e in r if lo < e <= hi)
        groups = ";".join(f"{of(ra, lo, hi)}|{of(rb, lo, hi)}" for lo, hi in zip([0, *cuts], cuts, strict=False)) if len(text) < 4000 else None
        links, first = [], 0
        for i, s, e in ra:
            while rb[first][2] <= s:
                first += 1
            k = first
            while k < len(rb) and rb[k][1] < e:
                links.append((i, rb[k][0]))
                k += 1
        counts.update(set(links))
        found.append(((len(ia), len(ib), len(cuts)), links, groups))
    best = collections.defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    return [(*n, len(x), sum(counts[p] == best[p[0]] for p in x), sum(counts[p] for p in x), g) for n, x, g in found], counts


ODD = ["", None, " ", "  two  spaces ", "a b\nc \n\n d", "\n\nlead", "trail \n", "a b 　c", "▁mark a", "x ▁ y", "<s> </s> <|endoftext|> <0x41>", "\x00 nul", "É 中文 🙂", "don't we'll", "0123 45 6", "a" * 3000, " " * 3000, "tab\tand\r\nline"]


def test_alignment_of_odd_texts(spark, files):
    rng = random.Random(4)
    texts = [*ODD, *("".join(rng.choice("ab c'\n.é1 ▁") for _ in range(rng.randint(1, 40))) for _ in range(200)), "the same text", "the same text"]
    docs = spark.createDataFrame([(None if k % 9 == 0 else k // 2, t, k) for k, t in enumerate(texts)], "doc_id long, text string, block long").repartition(3)
    docs = docs.withColumn("text", F.col("text"))
    got, pairs = align.align(docs, *files, groups=True)
    want, counts = alignments(texts, files)
    as_rows = lambda rows: collections.Counter(rows)
    assert as_rows((None if k % 9 == 0 else k // 2, *w) for k, w in enumerate(want)) == as_rows(
        (r["id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups"]) for r in got.collect()
    )
    assert {(r["a"], r["b"]): r["count"] for r in pairs.collect()} == counts
    assert all(r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") for r in got.collect())
    none, no_pairs = align.align(docs.limit(0), *files)
    assert none.count() == no_pairs.count() == 0


@supplied
def test_op13(spark, files):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want, _ = alignments([t for _, t in rows], files)
    got = {r["doc_id"]: r for r in queries.op13_token_alignment(spark, SF).collect()}
    assert len(got) == len(rows)
    for (i, _), w in zip(rows, want, strict=True):
        r = got[i]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"]) == w[:6]
        if w[6] is not None:
            assert r["groups_sha256"] == (hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "")


def test_words_and_whole_texts_align_alike(files):
    import pyarrow as pa

    a, b, written = align.sides(*files)
    rng = random.Random(7)
    texts = pa.array([" ".join("".join(rng.choice("abcdeé.'-") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 60))) for _ in range(60)])
    by_words, whole = (align.Aligned(a, b, written, texts, w) for w in (None, np.ones(60, bool)))
    assert [bytes(g) for g in by_words.groups] == [bytes(g) for g in whole.groups]
    assert by_words.n_links.tolist() == whole.n_links.tolist()
    assert set(zip(by_words.text.tolist(), by_words.pair.tolist(), by_words.times.tolist(), strict=True)) == set(zip(whole.text.tolist(), whole.pair.tolist(), whole.times.tolist(), strict=True))


# 11


def expected(rows, most=8):
    x = np.floor(1024 * np.array([v for _, v in rows], float)) + 100_000
    n = len(x)
    c = x - x.mean(axis=0)
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1][:most], v[:, ::-1][:, :most]
    deviations = [sum((n * int(a) - s) ** 2 for a, s in zip(r, [int(s) for s in x.sum(axis=0)], strict=True)) for r in x]
    return n, deviations, c @ v / np.sqrt(e), e / (c**2).sum() * n


@supplied
def test_op11(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    n, deviations, z, explained = expected(rows)
    got = {(r["vec_id"], r["component"]): r for r in queries.op11_whitening(spark, SF).collect()}
    assert len(got) == 8 * len(rows)
    for j in range(8):
        column = np.array([got[i, j + 1]["whitened"] for i, _ in rows])
        assert min(np.abs(column - z[:, j]).max(), np.abs(column + z[:, j]).max()) < 1e-9
        assert abs(got[rows[0][0], j + 1]["explained"] / explained[j] - 1) < 1e-12
    assert [got[i, 1]["deviation"] for i, _ in rows] == deviations
    assert {r["n"] for r in got.values()} == {n} and max(r["identity_error"] for r in got.values()) < 1e-10


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(2)
    good = rng.normal(size=(200, 3)) * [3, 1, 0.1]
    rows = [(k, v.tolist()) for k, v in enumerate(good)] + [(0, good[0].tolist()), (None, good[1].tolist())]
    bad = [(900, None), (901, [1.0, None, 2.0]), (902, [1.0, float("nan"), 0.0]), (903, [float("inf")] * 3), (904, []), (905, [1.0, 2.0]), (906, [1e30, 0.0, 0.0])]
    vectors = spark.createDataFrame([(i, v, 1.0) for i, v in rows + bad], "vec_id long, embedding array<double>, x double").repartition(20)
    got = whiten.whiten(vectors).collect()
    n, deviations, z, explained = expected(rows)
    assert n == 202 and len(got) == 3 * n
    assert collections.Counter((r["id"], int(r["deviation"])) for r in got if r["component"] == 1) == collections.Counter((i, d) for (i, _), d in zip(rows, deviations, strict=True))
    for j in range(3):
        assert np.allclose(np.sort([abs(r["whitened"]) for r in got if r["component"] == j + 1]), np.sort(np.abs(z[:, j])), atol=1e-9)
    assert max(r["identity_error"] for r in got) < 1e-10
    assert whiten.whiten(vectors.limit(0)).count() == 0
    assert whiten.whiten(vectors.filter("vec_id = 5")).count() == 0
    same = spark.createDataFrame([(k, [0.5, 0.25]) for k in range(9)], "vec_id long, embedding array<float>")
    assert whiten.whiten(same).count() == 0


def test_exact_deviations_of_many_vectors():
    n, sums = 10**9, [10**14 + 7, 3]
    model = whiten.Whitening(n, sums, np.eye(2), np.ones(2), 2.0)
    x = np.array([[100_000, 2], [5, 900]], np.int64)
    assert [int(d) for d in model.deviations(x).to_pylist()] == [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]


@pytest.mark.parametrize(
    "x",
    [
        np.random.default_rng(0).normal(size=(300, 40)) * np.logspace(0, -6, 40),
        np.linalg.qr(np.random.default_rng(1).normal(size=(100, 20)))[0] * np.r_[[3.0] * 4, [1.0] * 16],
        np.diag(np.arange(1.0, 21)),
        np.hstack([np.random.default_rng(2).normal(size=(80, 8))] * 2),
        np.random.default_rng(3).normal(size=(3, 12)),
        np.ones((4, 1)),
    ],
    ids=["graded", "ties", "diagonal", "repeated dimensions", "few", "one dimension"],
)
def test_singular_vectors(x):
    r = np.linalg.qr(x, mode="r")
    r = np.vstack([r, np.zeros((x.shape[1] - len(r), x.shape[1]))])
    values, v = whiten.leading(r, 8)
    want = np.linalg.svd(x, compute_uv=False) ** 2
    assert len(values) == min(8, int((want > 1e-20 * want[0]).sum()))
    assert np.allclose(values, want[: len(values)], rtol=1e-12)
    assert np.abs(v.T @ v - np.eye(len(values))).max() < 1e-12
    assert np.abs(x.T @ (x @ v) - v * values).max() < 1e-13 * want[0] * len(want)


def test_dqds_keeps_small_values():
    a, b = 10.0 ** -np.arange(0, 16, 2), 10.0 ** -np.arange(0.5, 15, 2)[:7]
    from fractions import Fraction

    got = whiten.dqds(a, b)
    n = len(a)
    rows = [[Fraction(0)] * n for _ in range(n)]
    for i in range(n):
        rows[i][i] += Fraction(float(a[i])) ** 2 + (Fraction(float(b[i - 1])) ** 2 if i else 0)
        if i < n - 1:
            rows[i][i + 1] = rows[i + 1][i] = Fraction(float(a[i])) * Fraction(float(b[i]))

    def below(x):  # how many eigenvalues are smaller, exactly
        count, d = 0, Fraction(1)
        for i in range(n):
            d = rows[i][i] - x - (rows[i][i - 1] ** 2 / d if i else 0)
            count += d < 0
        return count

    for k, value in enumerate(got):
        assert below(Fraction(float(value)) * (1 - Fraction(1, 10**12))) <= n - 1 - k < below(Fraction(float(value)) * (1 + Fraction(1, 10**12)))


# 12


def said(text):
    page = pagetext.parse(text)
    return [page.lines[k].text for k, _ in page.chosen()]


def test_lines_of_pages():
    page = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body class="has-sidebar"><header><h1>Site</h1></header>
    <div class="cookie-notice">We use cookies</div><main><article class="post"><header class="entry-header"><h1>Title &amp;
    more</h1><p>By me</p></header><p>One <b>tw</b>o &lt;x&gt; a < b<br>new<!-- no --></p><div class="ad">Buy</div><aside>side</aside><form><label>mail</label><input></form>
    <ul><li>item<li>next</ul><p>open<p>paragraphs <section id="comments"><article class="comment"><p>nice</p></article></section><footer>f</footer></article>
    <div>related</div></main><div class="sidebar"><article><p>teaser</p></article></div><footer>c</footer></body>"""
    assert said(page) == ["Title & more", "One two <x> a < b", "new", "item", "next", "open", "paragraphs"]
    assert said("<div id=nav><a href=x>Home</a></div><p>Text <a href=y>with a link</a> that is long enough.<p class=ad>buy<p>stay<script>x</scr") == ["Text with a link that is long enough.", "stay"]
    assert said('<form action="/"><div><p>All is within a form.</p></div><select><option>no</select></form>') == ["All is within a form."]
    assert said('<p title="a > b">q</p><nav><ul><li>m<article><p>art</p></article>tail') == ["art"]
    assert said('<article><p title="unclosed>r</p><p>s</p></article>') == ["r", "s"]
    assert said('<div class="main with-sidebar"><p>body</p><div id="pageSidebar">side</div><div class="cookieNotice">c</div></div>') == ["body"]
    assert said("") == said("<p>") == said("<script>only") == []
    assert said("plain text, a <3 b") == ["plain text, a <3 b"]
    assert len(said("<article>" + "<div>x" * 50_000)) == 50_000
    assert len(said("<article><p>" + "word " * 400_000)[0]) == 5 * 400_000 - 1


def test_longest_common_subsequences(monkeypatch):
    rng = random.Random(1)

    def length(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    for size in (4096, 3):
        monkeypatch.setattr(pagetext, "TABLE", size)
        for _ in range(400):
            a, b = ([rng.randint(0, 6) for _ in range(rng.randint(0, 14))] for _ in range(2))
            found, rest = pagetext.common(a, b), iter(b)
            assert len(found) == length(a, b) and found == sorted(set(found)) and all(a[i] in rest for i in found)


def site(k, host="h.example", body=None):
    parts = [f"Own line {k} with words of its own", f"And another, number {k}, that only this page has"]
    inner = "".join(f"<div>{x}</div>" for x in body or parts)
    return f"https://{host}/a/{k:04}", f"<title>{(body or parts)[0]}</title><div>Shared start</div><div>Another shared line</div>{inner}<div>Shared end</div>"


def test_differencing_finds_what_pages_share(spark, monkeypatch):
    monkeypatch.setattr(pagetext, "GROUP", 8)
    rows = [(k, *site(k)) for k in range(100)]
    rows += [(200 + k, *site(500 + k, body=["A copied article that many pages hold", "with a second line of it"])) for k in range(3)]
    rows += [(300, *site(7, host="alone.example")), (301, None, site(8)[1]), (302, "https://h.example/a/0003", None), (5, *site(5)), (None, *site(5)), (303, "no url", "<p>text</p>")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string").repartition(5)
    got = collections.Counter((r["page_id"], r["text"]) for r in pagetext.extract(pages).collect())
    own = lambda k: f"Own line {k} with words of its own And another, number {k}, that only this page has"
    framed = lambda x: f"Shared start Another shared line {x} Shared end"
    copied = "A copied article that many pages hold with a second line of it"
    want = [(k, own(k)) for k in range(100)] + [(200 + k, copied) for k in range(3)]
    want += [(300, framed(own(7))), (301, framed(own(8))), (302, ""), (5, own(5)), (None, own(5)), (303, "text")]
    assert got == collections.Counter(want)
    assert pagetext.extract(pages.limit(0)).count() == 0


def test_shared_prose_of_articles_stays(spark):
    page = lambda k: (k, f"http://h.example/{k}", f"<title>{k}</title><article><h1>Head {k}</h1><p>A licence that all pages quote.</p><p>Only {k} says this, and at some length.</p><div>Share this page</div></article>")
    got = pagetext.extract(spark.createDataFrame([page(k) for k in range(6)], "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {k: f"Head {k} A licence that all pages quote. Only {k} says this, and at some length." for k in range(6)}


@supplied
def test_op12(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r["page_id"]: r for r in queries.op12_page_text(spark, SF).collect()}
    assert len(got) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p["html"], re.S)[1]
        words = re.sub(r"<[^>]*>", lambda m: " " if re.match(r"</?(p|h1|br)\b", m[0]) else "", article)
        assert (got[p["page_id"]]["text"], got[p["page_id"]]["url"]) == (" ".join(html.unescape(words).split()), p["url"])
        assert got[p["page_id"]]["n_chars"] == len(got[p["page_id"]]["text"])


# 2


def test_other_definitions_go_through_the_library(spark, tmp_path):
    import json

    from tokenizers import Tokenizer

    from parlance.llm import tokenfile

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    texts = ["Hello World", "  two  SPACES é", "don't 12 <|endoftext|> x", "", None]
    docs = spark.createDataFrame([*enumerate(texts), (None, "b"), (None, "a"), (None, None), (None, "a")], "doc_id long, text string").repartition(3)
    for change in ({}, {"normalizer": None}, {"pre_tokenizer": {"type": "Whitespace"}}):
        definition = json.dumps(spec | change)
        library = Tokenizer.from_str(definition)
        path = str(tmp_path / str(len(change) and next(iter(change))))
        tokenfile.write_tokens(docs, definition, path, end_id=2)
        rows = tokenfile.read_tokens(spark, path).orderBy("start").collect()
        want = [(None, t) for t in (None, "a", "a", "b")] + list(enumerate(texts))
        assert [r["doc_id"] for r in rows] == [i for i, _ in want]
        assert [np.frombuffer(r["ids"], "<u4").tolist() for r in rows] == [[*library.encode(t or "", add_special_tokens=False).ids, 2] for _, t in want]
    with pytest.raises(TypeError):
        tokenfile.write_tokens(docs.withColumn("doc_id", F.lit("x")), json.dumps(spec), str(tmp_path / "no"), end_id=2)
