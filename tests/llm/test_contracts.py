"""The registered queries on the smallest tables, column by column, against plain Python and the tokenizer libraries."""

import collections
import hashlib
import os
import re
import zlib

import pytest
import regex

import brute
from parlance.llm import decontam, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables aren't here")
public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def rows(spark):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def result(spark, name):
    return {r["doc_id"]: r for r in queries.queries()[name](spark, SF).collect()}


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def test_op1(spark, rows):
    got = result(spark, "op1_simhash")
    prints = [brute.fingerprint(t) for _, t, _, _ in rows]
    want = brute.components([r[0] for r in rows], prints)
    assert {r[0]: (f"{p:016x}", c) for r, p, c in zip(rows, prints, want, strict=True)} == {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()}


def test_op2(spark, rows):
    from tokenizers import Tokenizer

    t, before, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, {}
    for i, text, _, _ in sorted(rows):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        want[i] = (before, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)))
        before += len(ids)
    assert {i: (r["start"], r["n_tokens"], r["ids_crc32"]) for i, r in result(spark, "op2_token_files").items()} == want


def leaks(docs, items, p=decontam.Params()):
    """(doc, item): (covered, tokens) by comparing every window of every text with every window of every item."""
    cut = regex.compile(decontam.TOKEN)

    def forms(tokens):
        low = [t.lower() for t in tokens]
        plain = ["<num>" if x[0] in "0123456789" or x in decontam.NUMBERS else "<unit>" if x in decontam.UNITS else x for x in low]
        named = [n if n[0] == "<" and len(n) > 2 else "<name>" if t != x and len(t) > 1 and t[1:] == x[1:] else n for t, x, n in zip(tokens, low, plain, strict=True)]
        return plain, named, low

    found = {}
    table = collections.defaultdict(list)
    size = {}
    for i, text in items:
        tokens = cut.findall(text or "")
        size[i] = len(tokens)
        f = forms(tokens)
        w = min(p.window, len(tokens))
        for at in range(len(tokens) - w + 1 if w else 0):
            few = [sum(x[0] != "<" for x in f[m][at : at + w]) < p.min_words for m in (0, 1)]
            for m in range(3):
                if (few[0] or few[1]) if m == 2 else not few[m]:
                    slots = [k for k in range(w) if m < 2 and f[m][at + k][0] == "<"]
                    table[w, tuple(f[m][at : at + w])].append((i, m, at, f[2][at : at + w], slots))
    for d, text in docs:
        tokens = cut.findall(text or "")
        f, lines = forms(tokens), collections.defaultdict(list)
        for w in {k[0] for k in table}:
            for at in range(len(tokens) - w + 1):
                for key in {tuple(x[at : at + w]) for x in f}:
                    for i, m, pos, was, slots in table.get((w, key), ()):
                        lines[i, m, w, at - pos].append((pos, {(was[k], f[2][at + k]) for k in slots}))
        spans = collections.defaultdict(set)
        for (i, _, w, _), hits in lines.items():
            bound = set().union(*(b for _, b in hits))
            if len({a for a, _ in bound}) < len(bound):
                hits = [h for h in hits if all(a == b for a, b in h[1])]
            for pos, _ in hits:
                spans[i] |= set(range(pos, pos + w))
        found |= {(d, i): (len(s), size[i]) for i, s in spans.items() if len(s) >= p.coverage * size[i]}
    return found


def test_op3(spark, rows):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.op3_decontamination(spark, SF).collect()
    assert {(r["doc_id"], r["item_id"]): (r["covered_tokens"], r["item_tokens"]) for r in got} == leaks([r[:2] for r in rows], items) and got


def test_op3_short_and_slot_rich_items(spark):
    items = [(1, "Who wrote the old red book"), (2, "3 km 4 km 5 km 6 km 7 km"), (3, "Paris"), (4, "Anna has 12 apples and gives Ben 5 of them today."), (5, ""), (6, None)]
    docs = [
        (1, "He asked: who wrote the old red book? Nobody knew."), (2, "Run 3 km 4 km 5 km 6 km 7 km now"), (3, "Run 8 km 9 km 5 km 6 km 7 km now"), (4, "We saw Paris in spring"),
        (5, "Carl has 30 apples and gives Dora 7 of them today."), (6, "Carl has 30 apples and gives Carl 7 of them today."), (7, None), (8, ""), (None, "who wrote the old red book"), (9, "Who wrote the old blue book"),
    ]
    got = decontam.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    pairs = {(r["doc_id"], r["item_id"]): (r["covered_tokens"], r["item_tokens"]) for r in got}
    assert pairs == leaks(docs, items)
    assert {(1, 1), (None, 1), (2, 2), (4, 3), (5, 4)} <= set(pairs) and (9, 1) not in pairs and (3, 2) not in pairs


def test_op5(spark, rows):
    from parlance.llm import secrets

    p, spans, has = secrets.Params(), {}, collections.defaultdict(set)
    for i, t, lang, source in rows:
        t = t or ""
        found = [(m.start(), 0, m.end(), m[2]) for m in brute.ASSIGN.finditer(t) if len(m[2]) >= 8]
        found += [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        found += [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        bare = [(m.start(), 3, m.end(), m[0]) for m in re.finditer(rf"[A-Za-z0-9+/_-]{{{p.bare_least},}}", t) if re.search("[0-9].*[0-9]", m[0]) and re.search("[A-Za-z].*[A-Za-z]", m[0])]
        spans[i] = sorted(found + [b for b in bare if not any(f[0] < b[2] and b[0] < f[2] for f in found)])
        for s in spans[i]:
            has[s[3]].add((source, f"{source}/{lang}"))
    got = result(spark, "op5_secrets")
    names = ("assign", "access", "hex", "owned")
    for i, t, _, _ in rows:
        live = lambda v: len({o for o, _ in has[v]}) <= p.max_owners and len({r for _, r in has[v]}) <= p.max_repos
        want = [s for s in spans[i] if s[1] < 3 or live(s[3])]
        r = got[i]
        assert r["spans"] == ",".join(f"{names[k]}:{a}:{b}" for a, k, b, _ in want)
        assert r["base_sha256"] == sha(brute.base_spans(t or "")) and [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in want) for k in range(3)]


def test_secret_overlaps_of_long_listings(spark):
    """Thousands of base spans in one text, some of which bare candidates touch."""
    from parlance.llm import secrets

    line = lambda k: f"{hashlib.md5(str(k).encode()).hexdigest()} Key{k:05d}Ab12Cd34Ef56 token={k:010d}x/{hashlib.sha1(str(k).encode()).hexdigest().upper()}"
    text = "\n".join(map(line, range(1500)))
    got = secrets.scan(spark.createDataFrame([(1, text, "a/b")], "doc_id long, text string, source string")).first()["secrets"]
    base = [(m.start(), m.end()) for m in brute.ASSIGN.finditer(text)] + [(m.start(), m.end()) for m in re.finditer("[0-9a-f]{32,}", text)]
    inside = set()
    for a, b in base:
        inside |= set(range(a, b))
    bare = [(m.start(), m.end()) for m in re.finditer("[A-Za-z0-9+/_-]{16,}", text) if not inside & set(range(m.start(), m.end()))]
    assert [(s["start"], s["end"]) for s in got if s["kind"] == "owned"] == bare and len(got) == len(bare) + len(base)


def test_op6(spark, rows):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {}
    for i, t, _, _ in rows:
        ids = sp.encode(t or "")
        want[i] = (len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)))
    assert {i: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for i, r in result(spark, "op6_sentencepiece").items()} == want


def test_op7(spark, rows):
    want = brute.deduplicated([r[:2] for r in rows], 20)
    got = result(spark, "op7_substring_dedup")
    assert {r[0]: want[k] for k, r in enumerate(rows)} == {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()}


def test_op8(spark, rows):
    m = brute.Katz([t for i, t, _, _ in rows if not brute.held(i, 5)])
    got = result(spark, "op8_katz")
    for i, t, _, _ in rows:
        r, tokens = got[i], m.tokens(t)
        score, base = m.score(t)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (brute.held(i, 5), len(tokens), sum(w in m.c1 for w in tokens), m.n)
        assert abs(r["base_score"] - base) < 1e-9 * max(1, abs(base)) and abs(r["score"] - score) < 1e-9 * max(1, abs(score))


def test_op9(spark, rows):
    got = result(spark, "op9_quality")
    for i, t, _, _ in rows:
        raw = (t or "").encode()
        words = WORDS.findall(raw)
        lines = [x for x in raw.split(b"\n") if WORDS.search(x)]
        seen = collections.Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        hit = {j for k in range(len(words) - 4) if seen[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
        failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
        r = got[i]
        want = (len(words), len(b"".join(words).decode()), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit), failed)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want and (not failed or not r["kept"])


def test_op10(spark, rows):
    got = result(spark, "op10_language_id")
    learned = {r[2] for r in rows if r[2] and not brute.held(r[0], 3)}
    assert all(r["held_out"] == brute.held(i, 3) and (r["lang_pred"] in learned or r["lang_pred"] == "und") and 0 <= r["score"] <= 1 for i, r in got.items())
    judged = [got[i]["lang_pred"] == lang for i, t, lang, _ in rows if brute.held(i, 3) and lang and regex.search(r"\p{L}", t or "")]
    assert sum(judged) >= 0.95 * len(judged)


def test_language_learns_tied_words(spark):
    from parlance.llm import langid

    rows = [(1, "eins zwei drei vier fünf sechs", "de"), (2, "one two six seven eight nine", "en"), (3, "eins two zwei", "de")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    docs = spark.createDataFrame([(1, "zwei vier sechs"), (2, "nine eight")], "doc_id long, text string")
    assert [r["lang_pred"] for r in langid.predict(docs, model).select("doc_id", "language.*").orderBy("doc_id").collect()] == ["de", "en"]


def test_blocks_are_bounded_without_blanks(spark, monkeypatch):
    from parlance.llm import katz, substrings

    monkeypatch.setattr(substrings, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(substrings, "BLOCK_TEXTS", 50)
    monkeypatch.setattr(katz, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(katz, "BLOCK_TEXTS", 50)
    docs = [(k, "中" * 200) for k in range(40)] + [(100 + k, "") for k in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("held", langid_false())
    assert substrings.blocks(df, "doc_id", "text").count() >= 8 and katz.blocks(df, "doc_id", "text", "held").count() >= 8
    got = substrings.deduplicate(df).collect()
    assert len(got) == 240 and all(r["n_removed"] == 0 for r in got)


def langid_false():
    from pyspark.sql import functions as F

    return F.lit(False)


def test_archive_query_and_pipeline_columns(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "n_tokens", "ids"} <= set(out.columns)
