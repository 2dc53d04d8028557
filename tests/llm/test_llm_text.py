"""HTML text, fingerprints, packing, language identification, personal data, n-gram join, pipeline."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pulsegrid.llm import common, fingerprints, html_text, kernels, langid, ngram_join, packing, pii

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingles(t, n):
    w = WORD.findall(lower(t))
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


# --- kernels


def test_words_and_shingles(monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("aAbÉ \n\t😀\u00a0") for _ in range(rng.randint(0, 60))) for _ in range(300)] + [None, "", "x" * 900, "y z " * 500]
    for piece in (64, 1 << 20):
        monkeypatch.setattr(kernels, "PIECE", piece)
        words, at = kernels.word_hashes(*kernels.utf8(pa.array(texts)))
        seen = {}
        for t, a, b in zip(texts, at[:-1], at[1:]):
            own = WORD.findall(lower(t))
            assert b - a == len(own)
            for w, h in zip(own, words[a:b].tolist()):
                assert seen.setdefault(w, h) == h
            assert len(kernels.shingles(words[a:b], 3)) == len(shingles(t, 3))
        assert len(set(seen.values())) == len(seen)


# --- HTML


@pytest.mark.parametrize("source, want", [
    (None, ""), ("", ""), ("<", "<"), ("just text", "just text"), ("<p>a &lt;b&gt;<br>c&nbsp;&am", "a <b> c &am"),
    ("<body><nav>menu</nav><article><h1>Title</h1><p>One  <b>two</b>\n three<p>Four</article><footer>f</footer></body>", "Title\nOne two three\nFour"),
    ("<body><div class='cookie-notice'>We use cookies here and there</div><article><p>Text.</p><script>var a='</p>';</script><p>More.</p></article>"
     "<div id=comments><p>me too</p><p>and me, at great length</p></div>", "Text.\nMore."),
    ("<article><p>cut off <a hre", "cut off"), ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<script>never closed <p>x", ""), ("<p>a</b></i></p><p>b", "a\nb"),
    ("<ul><li>x<li>y</ul>", "x\ny"), ("<form><p>name</p></form><p title='a>b'>kept</p>", "kept"),
])
def test_main_text(source, want):
    assert html_text.main_text(source) == want


def blocks(tag, k, size):
    return [f"{tag}{i} " + ("word " * size)[:size - 4].strip() for i in range(k)]


@pytest.mark.parametrize("outer", ["article", "main", "div"])
def test_articles_of_sections_lists_and_tables(outer):
    dress = lambda tag, lines: "".join(f"<{tag}>{x}</{tag}>" for x in lines)
    one, two, three, items, cells = blocks("a", 3, 200), blocks("b", 3, 200), blocks("c", 2, 40), blocks("d", 40, 60), blocks("e", 12, 30)
    page = "<body><ul>" + "".join(f"<li><a href=x>go {i}</a></li>" for i in range(30)) + f"</ul><{outer}>%s</{outer}><p><a>next page</a></p></body>"
    sections = f"<h1>Title</h1><section>{dress('p', one)}</section><section><h2>Part two</h2>{dress('p', two)}</section><section>{dress('p', three)}</section>"
    assert html_text.main_text(page % sections).split("\n") == ["Title", *one, "Part two", *two, *three]
    assert html_text.main_text(page % f"<h1>Title</h1>{dress('p', one)}<ul>{dress('li', items)}</ul><p>end</p>").split("\n") == ["Title", *one, *items, "end"]
    table = "<table><tr>" + dress("td", cells) + "</tr></table>"
    assert html_text.main_text(page % f"<h1>Title</h1>lead <b>in</b><section>{dress('p', one)}</section>{table}").split("\n") == ["Title", "lead in", *one, *cells]


LONG = "This is a sentence of the article, and it is a long one. " * 4


@pytest.mark.parametrize("source, want", [
    (f"<div id=content class='has-sidebar'><p>{LONG}</p></div>", LONG.strip()),
    (f"<main class='with-ads'><p>{LONG}</p></main>", LONG.strip()),
    (f"<article class='post no-comments'><p>{LONG}</p></article>", LONG.strip()),
    (f"<div class='layout sidebar-right'><nav>menu</nav><p>{LONG}</p></div>", LONG.strip()),
    (f"<div class='sidebar'><article><p>{LONG}</p></article><div class='ad-slot'>Buy now</div></div>", LONG.strip()),
    (f"<article><div class='article-header'><h1>Title</h1></div><p>{LONG}</p><p class='promotion-history'>His promotion</p></article>", f"Title\n{LONG.strip()}\nHis promotion"),
    ("<div class=notice><p>one</div><div class=alert><p>two</div><div class=related><p>three</div>", "one\ntwo\nthree"),
    (f"<article><p>{LONG}</p><p>Area <math><mi>a</mi><mo>=</mo><mn>2</mn></math>.</p><svg><title>t</title><text>left</text><text>right</text></svg></article>",
     f"{LONG.strip()}\nArea a=2.\nleft\nright"),
    (f"<article><p>{LONG}</p></article><div class='comments-area'>{'<p>me too</p>' * 90}</div><div class='site-footer'>f</div><div id=cookie-banner>c</div>", LONG.strip()),
])
def test_words_cut_no_article(source, want):
    assert html_text.main_text(f"<body>{source}</body>") == want


@pytest.mark.parametrize("source, want", [
    *[(f"<article><p>{LONG}</p></article><section class='{c}'>{f'<p>{LONG}</p>' * 3}</section>", LONG.strip())
      for c in ("user-comments", "reader-feedback", "cookie-message-v2", "xyz", "was-sagen-andere")],
    *[(f"<div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><div class='{c}'><p>me too, and at length</p></div></div>", "\n".join([LONG.strip()] * 3))
      for c in ("user-comments", "reader-feedback", "cookie-message-v2", "fb-comments", "article-comments", "dfp2-ads", "post-newsletter-3")],
    (f"<article><header class='top'><h1>Own <i>title</i></h1><p>by A. Author<br>now</p><div><h2>Second</h2></div></header><p>{LONG}</p></article>",
     f"Own title\nSecond\n{LONG.strip()}"),
    (f"<header><h1>Site</h1></header><main><header><h1>Title</h1><a href=x>share</a></header><p>{LONG}</p><nav><h2>No</h2></nav></main>", f"Title\n{LONG.strip()}"),
    (f"<article><header><nav><h2>Menu</h2></nav><h1>T</h1></header><p class='cookies-recipe'>{LONG}</p></article>", f"T\n{LONG.strip()}"),
])
def test_parts_of_unknown_names_and_titles(source, want):
    assert html_text.main_text(f"<body><nav><a href=x>home</a></nav>{source}</body>") == want


def test_densities_against_brute_force():
    rng = np.random.default_rng(3)

    def tree(depth):  # (tag, parts): parts are texts and trees
        tag = rng.choice(["div", "section", "ul", "span", "a", "b"]) if depth else "div"
        return tag, [tree(depth + 1) if depth < 5 and rng.random() < 0.6 else "x" * int(rng.integers(0, 40)) + " y" for _ in range(rng.integers(0, 5))]

    def source(t):
        return t if isinstance(t, str) else f"<{t[0]}>{''.join(map(source, t[1]))}</{t[0]}>"

    def count(t, linked):  # characters, link characters, tags and link tags below
        if isinstance(t, str):
            c = len(t.replace(" ", ""))
            return c, c * linked, 0, 0
        parts = [count(x, linked or t[0] == "a") for x in t[1]]
        own = [sum(p[i] for p in parts) for i in range(4)]
        inner = [x[0] for x in t[1] if not isinstance(x, str)]
        return own[0], own[1], own[2] + len(inner), own[3] + inner.count("a")

    def walk(t, linked, share, out):
        c, lc, tags, links = count(t, linked)
        at, d = len(out), 0.0
        out.append(None)
        if c:
            base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            d = c / max(tags, 1) * math.log(max(c / max(lc, 1) * max(tags, 1) / max(links, 1), 1)) / max(math.log(base), 0.1)
        below = [(x[0], walk(x, linked or t[0] == "a", share, out)) for x in t[1] if not isinstance(x, str)]
        out[at] = (c, lc, d, sum(v for tag, v in below if tag not in html_text.INLINE))
        return d

    for _ in range(60):
        t = tree(0)
        page = html_text.Page(source(t))
        c, lc = count(t, False)[:2]
        want = []
        walk(t, False, lc / max(c, 1), want)
        got = list(zip(*page.densities()))[1:]
        assert len(got) == len(want)
        for g, w in zip(got, want):
            assert g[:2] == w[:2] and g[2:] == pytest.approx(w[2:])


def test_second_article_is_whole():
    part = lambda c: f"<article><h1>Title {c}</h1>" + "".join("<section>" + "".join(f"<p>{x}</p>" for x in blocks(c + str(i), 3, 200)) + "</section>" for i in range(2)) + "</article>"
    want = [x for c in "xy" for x in (f"Title {c}", *blocks(c + "0", 3, 200), *blocks(c + "1", 3, 200))]
    assert html_text.main_text(f"<body><div>{part('x')}</div><div>{part('y')}</div></body>").split("\n") == want


def test_extract_against_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.page_id: (r.text, r.n_chars) for r in html_text.op3(spark, SF).collect()}
    import html

    for r in pages.collect():
        m = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)
        inner = m[1] if m else ""
        lines = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*(>|$)", "", x.replace("<br>", " ")))).strip() for x in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(x for x in lines if x)
        assert found[r.page_id] == (want, len(want))


def test_extract_edges(spark):
    d = spark.createDataFrame([(None, None, "x"), (1, "<p>a", None), (1, "<p>a", None)], "page_id long, html string, text string")
    assert sorted((r.text, r.n_chars) for r in html_text.extract(d).collect()) == [("", 0), ("a", 1), ("a", 1)]
    assert html_text.extract(d.limit(0)).count() == 0


# --- fingerprints


def test_edits_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = sorted(rows + [(-1, None), (-2, ""), (-3, "Çé 😀 x")], key=lambda r: -r[0])
    got = {r.doc_id: r for r in fingerprints.edits(spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1))).collect()}
    errors = []
    for (i, t), (j, x) in zip(rows, rows[1:] + rows[:1]):
        t, x = t or "", x or ""
        e = t[:len(t) - len(t) // 2] + x[:len(t) // 2]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        errors += [abs(got[i].near_edited - jaccard(shingles(t, 5), shingles(e, 5))), abs(got[i].near_next - jaccard(shingles(t, 5), shingles(x, 5)))]
    assert np.mean(errors) < 0.05 and max(errors) < 0.25


def test_edits_edges(spark):
    d = spark.createDataFrame([(1, None), (None, ""), (1, "a b c"), (1, "a b c")], "doc_id long, text string")
    out = fingerprints.edits(d).collect()
    assert len(out) == 4 and len({bytes(r.fp) for r in out}) == 2
    one = fingerprints.edits(d.filter("text = 'a b c'").limit(1)).collect()
    assert one[0].near_next == 1.0
    assert fingerprints.edits(d.limit(0)).count() == 0


def test_signature_of_long_text_in_stretches(monkeypatch):
    texts = [" ".join(f"w{i % 97}_{i}" for i in range(500)), "a b", "", "q " * 300]
    whole = fingerprints.signatures(pa.array(texts))
    monkeypatch.setattr(fingerprints, "CHUNK", 64)
    assert (fingerprints.signatures(pa.array(texts)) == whole).all()


def test_near_duplicates_by_bands(spark):
    rows = near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in fingerprints.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_components(rows, 5, 80)
    assert {i: g[0] for i, g in got.items()} == {i: w[0] for i, w in want.items()}
    assert sum(got[i] == want[i] for i in want) >= 0.95 * len(want)
    groups = collections.defaultdict(set)
    for i, (_, low) in got.items():
        groups[low].add(want[i][1])
    assert all(len(g) == 1 for g in groups.values())  # nothing is linked that isn't
    e = spark.createDataFrame([(1, None), (None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (6, " ")], "doc_id long, text string")
    assert sorted(((r.doc_id, r.component_id) for r in fingerprints.near_duplicates(e).collect()), key=str) == sorted([(1, 1), (None, 3), (3, 3), (3, 3), (6, 6)], key=str)
    assert fingerprints.near_duplicates(e.limit(0)).count() == 0


def test_texts_are_packed_and_unpacked():
    texts = ["", "a", "Çé 😀 \x00 x", "\n", "word " * 70000]
    b = pa.record_batch([pa.array(range(5)), pa.array(texts), pa.array(range(5))], ["id", "text", "tie"])
    out = list(fingerprints.packed([b]))[0]
    assert fingerprints.unpacked(out.column(2), out.column(3)) == texts
    assert len(out.column(3)[4].as_py()) < 2000


def test_pairs_just_above_the_threshold_are_found(spark):
    rng, rows = random.Random(12), []
    for i in range(200):
        w = [f"w{rng.randrange(1 << 40)}" for _ in range(200)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:rng.randint(162, 166)]))]
    got = fingerprints.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(jaccard(shingles(rows[2 * i][1], 5), shingles(rows[2 * i + 1][1], 5)) >= 0.8 for i in range(200))
    assert {r.doc_id: r.component_id for r in got} == {i: i // 2 * 2 for i, _ in rows}


def test_bands_of_texts_that_share_passages_make_few_pairs(spark, monkeypatch):
    rng, rows, made = random.Random(14), [], []
    for g in range(6):  # edits of one passage: most share bands, few link
        for _ in range(40):
            w = [f"g{g}w{i}" for i in range(300)]
            for i in rng.sample(range(300), rng.choice([4, 9, 14, 20, 26])):
                w[i] = f"x{rng.randrange(1 << 40)}"
            rows.append((len(rows), " ".join(w)))

    def counted(*args, f=ngram_join.left_over):
        out = ngram_join.cut(f(*args))
        made.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "left_over", counted)
    got = fingerprints.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_components(rows, 5, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) > 60
    assert sum(made) < len(rows)


def test_op4_has_components(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_components(rows, 5, 80)
    got = fingerprints.op4(spark, SF).collect()
    assert len(got) == len(rows) and {r.doc_id: r.component_id for r in got} == {i: w[1] for i, w in want.items()}


# --- packing


def test_pack_fills_and_never_overflows():
    rng = random.Random(5)
    for sizes in ([], [2047], [1] * 3000, [rng.randint(1, 2047) for _ in range(400)], [1025] * 50, [2047, 1, 2046, 2]):
        bins = packing.pack(sizes)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 2048 for b in bins)
    sizes = [rng.randint(1, 2047) for _ in range(512)]
    assert sum(sizes) / (2048 * len(packing.pack(sizes))) > 0.93


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(80).collect()]
    hard = ["", None, "a   b\n\n c \t", "x\u00a0 y\u2003  z", "<|endoftext|> it's  ", " lead", "😀 é\u3000 \u3000q", "\n", "word" * 9000, "end "]
    rows += [(1000 + i, x) for i, x in enumerate(hard)]
    out = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("clash"))).collect()
    ids = {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in rows}
    by, windows = collections.defaultdict(list), collections.defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    for i, pieces in by.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[i])
            assert r.ids_crc32 == zlib.crc32(np.array(ids[i][at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids[i])
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == w[0].sequence_length <= 2048
    assert set(by) == set(ids)


def test_packing_edges(spark):
    d = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, text string")
    assert sorted(r.doc_tokens for r in packing.pack_documents(d).collect()) == [1, 2, 2]
    assert packing.pack_documents(d.limit(0)).count() == 0


def test_memory_of_words_may_forget(monkeypatch):
    import public_tokenizers

    ids = packing.Ids(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [" ".join(f"word{i * j}" for i in range(50)) for j in range(20)]
    want = ids.encode(texts)
    monkeypatch.setattr(packing, "CACHE", 100)
    monkeypatch.setattr(kernels, "PIECE", 512)
    assert [x.tolist() for _, x in ids.rows(*kernels.utf8(pa.array(texts)))] == want


# --- language identification


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    out = langid.op7(spark, sf).join(docs, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert len(out) == docs.count() and 0.2 < len(held) / len(out) < 0.5
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)


def test_language_edges(spark):
    d = spark.createDataFrame([(1, None, "en", 1), (2, "123 !?", "en", 1), (None, "the of and", "en", 1), (4, "the of and", None, 2), (4, "the of and", None, 2)],
                              "doc_id long, text string, lang string, score int")
    model = [("en", b" the of and to in is " * 40), ("fr", b" le la les et de que " * 40)]
    got = sorted((r.lang_pred, r.rejected) for r in langid.identify(d, model).collect())
    assert got == [("en", False)] * 3 + [("und", True)] * 2
    assert langid.identify(d.limit(0), model).count() == 0
    assert langid.fit(d.limit(0)) == [] and langid.identify(d, []).filter("not rejected").count() == 0


# --- personal data


def test_emails_equal_the_pattern():
    rng = random.Random(6)
    for _ in range(5000):
        t = "".join(rng.choice("ab.@-+ 1%é") for _ in range(rng.randint(0, 30)))
        assert list(pii.emails(t)) == [m.span() for m in pii.EMAIL.finditer(t)]
        plain = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t.replace("a", "2").replace("b", "."))]
        assert [m.span() for m in pii.IP.finditer(t.replace("a", "2").replace("b", "."))] == plain


def test_rules():
    t = "x a.b@c-d.example 300.1.1.1 10.0.0.255 4111 1111 1111 1111 4111111111111112 +1 (788) 555-0037 +12 34"
    assert [(pii.KINDS[k], t[a:b]) for k, a, b in pii.by_rules(t)] == [
        ("email", "a.b@c-d.example"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (788) 555-0037")] or "4111 1111 1111 1111 41" in t


def test_decoding_is_the_best_segmentation():
    rng = np.random.default_rng(8)
    w = rng.normal(0, 1, (len(pii.KINDS), pii.FEATURES))
    text = "+1 788-555-0037 4111"
    cuts, spans, x, may = pii.segments(text, 0, len(text))
    best = (x @ w.T + may).max(axis=1)
    top = {0: 0.0}
    for j in range(1, len(cuts)):  # every segmentation, by recursion over the last segment
        top[j] = max([top[j - 1]] + [top[a] + best[k] for k, (a, b) in enumerate(spans) if b == j])
    got = pii.decode(w, text, 0, len(text))
    at = {(cuts[i], cuts[j]): k for k, (i, j) in enumerate(spans)}
    assert sum(best[at[a, b]] for _, a, b in got) == pytest.approx(top[len(cuts) - 1])


def test_field_learns_looser_writings(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    w = pii.fit(docs)
    assert pii.spans_of("call (788) 555-0037 now", w)[1] == [(3, 5, 19)]
    assert pii.spans_of("order 1234 5678 90, 4111111111111112", w) == ([], [])
    d = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "tel +1 (788) 555-0037.", 5), (3, "tel +1 (788) 555-0037.", 5), (None, "clean", 5)], "doc_id long, text string, n_chars int")
    found = pii.find(d, w).collect()
    assert [len(r.rule_spans) for r in found] == [0, 0, 1, 1, 0]
    red = pii.redact(d).collect()
    assert [r.text for r in red] == [None, "", "tel [PHONE].", "tel [PHONE].", "clean"] and [r.n_chars for r in red] == [5, 5, 12, 12, 5]
    assert pii.redact(d.limit(0)).count() == 0


@pytest.mark.parametrize("stretch", [5, 512])
def test_long_runs_of_numbers_are_one_zone(spark, monkeypatch, stretch):
    monkeypatch.setattr(pii, "STRETCH", stretch)
    text = " ".join(f"(555) 123-{4567 + i}" for i in range(40))
    assert list(pii.zones(text)) == [(0, len(text))]
    w = pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert pii.spans_of(text, w)[1] == [(3, 15 * i, 15 * i + 14) for i in range(40)]


def test_base_spans_stay(spark):
    for r in pii.op10(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), "doc_id").collect():
        rules = pii.by_rules(r.text)
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in rules)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert {x for x in joined.split(",") if x} <= set(r.spans.split(","))


# --- n-gram join and pipeline


def brute_components(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), 1 << 60), d)
    return {d: (len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(rows)}


def near_copies(seed=9):
    """A chain (each like its neighbours only), a group of near copies, shared passages, short texts."""
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(4000)]
    rows = []
    chain = rng.sample(words, 400)
    for i in range(20):
        rows.append(" ".join(chain[i * 6:i * 6 + 120]))
    base = rng.sample(words, 150)
    for i in range(40):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(150)] = rng.choice(words)
        rows.append(" ".join(w))
    passage = rng.sample(words, 60)
    for i in range(30):
        rows.append(" ".join(passage + rng.sample(words, rng.randint(0, 40))))
    rows += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 5))) for _ in range(30)]
    rng.shuffle(rows)
    return [(i + 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("n, percent, short, block", [(4, 85, 8, 1 << 18), (5, 80, 2, 64)])
def test_ngram_join_against_brute_force(spark, monkeypatch, n, percent, short, block):
    monkeypatch.setattr(ngram_join, "SHORT", short)
    monkeypatch.setattr(ngram_join, "ROWS", block)
    rows = near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string"), n=n, percent=percent).collect()}
    assert got == brute_components(rows, n, percent)


@pytest.mark.parametrize("classes, size", [(2048, 1 << 20), (7, 1 << 20), (2048, 500)])
def test_links_found_are_all_links(spark, monkeypatch, classes, size):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", classes)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", size)
    rows = near_copies()
    rows += [(1000 + i, t) for i, (_, t) in enumerate(rows[:20])]
    sets = {i: shingles(t, 4) for i, t in rows}
    linked = lambda a, b: a and b and 100 * len(a & b) >= 85 * len(a | b)
    want = {i: sum(bool(x != s and linked(x, s)) for x in set(sets.values())) for i, s in sets.items()}
    assert max(want.values()) > 10
    assert {r.doc_id: r.links_found for r in ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string"), n=4, percent=85).collect()} == want


def test_overlaps(monkeypatch):
    monkeypatch.setattr(ngram_join, "DENSE", 5)
    rng = random.Random(2)
    x, y = ([np.unique([rng.choice((rng.randint(0, 12), rng.randint(13, 3000))) for _ in range(rng.randint(1, 30))]).astype(np.int64) for _ in range(m)] for m in (40, 60))
    assert ngram_join.overlaps(x, y).tolist() == [[len(set(a) & set(b)) for b in y.copy()] for a in x]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    comp = {r.node: r.comp for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert comp == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_keep_one(spark):
    rows = [(1, None, "x"), (None, "a b c d e", "x"), (3, "a b c d e", "y"), (3, "A b c d e", "z"), (4, "q", ""), (5, "Q", ""), (6, "  ", ""), (None, "only null", "")]
    d = spark.createDataFrame(rows, "doc_id long, text string, name string")
    got = sorted(((r.doc_id, r.text) for r in ngram_join.keep_one(d).collect()), key=str)
    assert got == sorted([(1, None), (3, "A b c d e"), (4, "q"), (6, "  "), (None, "only null")], key=str)
    assert ngram_join.keep_one(d).columns == d.columns and ngram_join.keep_one(d.limit(0)).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    d, kept = docs, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, d, SF)
        if name != "pack":
            assert out.columns == docs.columns
        d = out.checkpoint()
        kept.append(d)
    language, unique, private, mixed, packed = kept
    assert language.join(docs, docs.columns, "left_anti").count() == 0
    rows = [tuple(r) for r in language.select("doc_id", "text").collect()]
    want = {low for _, low in brute_components(rows, 5, 80).values()}
    assert sorted(r.doc_id for r in unique.collect()) == sorted(want)
    assert private.count() == unique.count()
    assert not [r for r in private.collect() if pii.by_rules(r.text)]
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in private.collect()}
    assert packed.select("sequence_id").distinct().count() > 0
    assert packed.agg(F.countDistinct("doc_id")).first()[0] == mixed.agg(F.countDistinct("doc_id")).first()[0]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_pipeline_keeps_columns_with_clashing_names(spark):
    own = {"score": 7, "lang_pred": "x", "rejected": True, "size": 1, "row": 2, "name": "n", "id": 5, "hinted": False, "c0": 3, "fits": 0, "taken": 4}
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    for k, v in own.items():
        docs = docs.withColumn(k, F.lit(v))
    d = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, SF).checkpoint()
        assert d.columns == docs.columns and d.count() > 0
        assert d.select(*own).distinct().collect() == [tuple(own.values())]
    assert corpus_pipeline.STAGES[-1][1](spark, d, SF).count() > 0


def test_cut_leaves_no_shuffle_files(spark):
    """What a cut shuffled goes with it (op4's disk); what other queries shuffled, and the setting, stay."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    counted = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    assert counted.agg(F.sum("count")).first()[0] == 10_000
    before, setting = shuffled(), spark.conf.get(common.CLEANUP)
    made = common.cut(counted.repartition("count"))
    end = time.time() + 10  # executors are told, not waited for
    while shuffled() - before and time.time() < end:
        time.sleep(0.1)
    assert not shuffled() - before
    assert spark.conf.get(common.CLEANUP) == setting
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, counted.collect())) == [(k, 100) for k in range(100)]


def test_components_stop_at_stars(spark):
    """Stars are recognised without another round, and rings, chains and repeats still close."""
    def rounds(edges):
        made, before = [], ngram_join.cut
        ngram_join.cut = lambda df: made.append(1) or before(df)
        try:
            comp = {r.node: r.comp for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        finally:
            ngram_join.cut = before
        return comp, len(made)

    star = [(1, k) for k in range(2, 40)]
    assert rounds(star + star[:5]) == ({k: 1 for k in range(1, 40)}, 2)
    ring = [(k, k + 1) for k in range(50, 69)] + [(69, 50), (70, 70)]
    assert rounds(ring + star)[0] == {k: 1 for k in range(1, 40)} | {k: 50 for k in range(50, 70)}
