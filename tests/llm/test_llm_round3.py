"""SimHash near-duplicates, phrase collocations and cross-tokenizer alignment against brute force."""

import collections
import hashlib
import itertools
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from pyspark.sql import functions as F

import corpus_pipeline

from pulsegrid.llm import alignment, chat, collocations, html_text, kernels, langid, packing, pii, simhash

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def texts_of(spark, n=None):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows][:n]


# --- SimHash


def plain_fingerprint(t, n=3):
    w = WORD.findall(lower(t))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + n]).encode(), 42) for i in range(max(1, len(w) - n + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, fps):
    comp = list(range(len(ids)))

    def top(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 2:
            comp[top(i)] = top(j)
    least = {}
    for i, k in enumerate(ids):
        if k is not None:
            least[top(i)] = min(least.get(top(i), k), k)
    return [least.get(top(i)) for i in range(len(ids))]


def test_simhash_bits(monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choice("aAbÉ \n\t😀 ") for _ in range(rng.randint(0, 90))) for _ in range(200)] + [None, "", " \n", "one", "one two", "A b C", "x y " * 700]
    for stretch, hashes in ((1 << 20, 1 << 17), (7, 11)):
        monkeypatch.setattr(simhash, "STRETCH", stretch)
        monkeypatch.setattr(simhash, "HASHES", hashes)
        got = simhash.fingerprints([None if t is None else t.encode() for t in texts])
        assert got.tolist() == [plain_fingerprint(t) for t in texts]


@pytest.mark.parametrize("crowd", [32, 2, 0])
def test_simhash_components(spark, crowd):
    rng = random.Random(6)
    fps = [rng.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1, 1 << 63]
    for f in list(fps[:20]):
        for _ in range(12):  # chains and stars of neighbours, and pairs three bits apart
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
            fps.append(f)
    fps = sorted(set(fps))
    classes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    found = {r.node: r.comp for r in simhash.link_fingerprints(classes, crowd).collect()}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    assert [found.get(s, s) for s in signed] == plain_components(signed, fps)


def test_simhash_whole_table(spark):
    docs = texts_of(spark)
    docs += [(9001, None), (9002, ""), (9003, docs[0][1]), (9003, docs[0][1]), (None, docs[1][1]), (None, "only here, without an id"), (-5, docs[2][1] + " end")]
    want_fp = [plain_fingerprint(t) for _, t in docs]
    want = collections.Counter(zip([i for i, _ in docs], [f"{f:016x}" for f in want_fp], plain_components([i for i, _ in docs], want_fp)))
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "Doc_Id long, text string, fp int, `a.cell` int")
    got = simhash.simhash(df, id_col="Doc_Id").collect()
    assert collections.Counter(map(tuple, got)) == want
    assert simhash.simhash(df.limit(0), id_col="Doc_Id").collect() == []
    assert any(c[0] != c[2] for c in want)


# --- phrase collocations


def plain_collocations(docs, least, cover, top):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, t in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", lower(t)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                f[lang].update(" ".join(w[i:i + m]) for i in range(len(w) - m + 1))
    out = set()
    for lang, own in f.items():
        rows = []
        phrases = {p: a for p, a in own.items() if a >= least and " " in p}
        for p, a in phrases.items():
            w = p.split(" ")
            cuts = [(2000000 * a // (own[" ".join(w[:k])] + own[" ".join(w[k:])]), k, own[" ".join(w[:k])], own[" ".join(w[k:])]) for k in range(1, len(w))]
            longer = [b for q, b in phrases.items() if len(q) > len(p) and f" {p} " in f" {q} "]
            if not any(100 * b >= cover * a for b in longer):
                score, _, l, r = min(cuts)
                rows.append((-score, -a, p.encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top]):
            out.add((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return out


def collocation_docs():
    rng = random.Random(8)
    words = ["New", "york", "city", "ö", "😀x", "of", "the", "a", "#1", "York"] + [f"w{i}" for i in range(30)]
    texts = [(rng.choice(["en", "fr", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?"]) for _ in range(rng.randint(0, 80)))) for _ in range(500)]
    return texts + [("en", None), (None, ""), ("fr", " .,"), ("en", "new york city of the " * 300), ("en", ("x" * 500 + " a ") * 40)]


@pytest.mark.parametrize("sizes", [(1 << 18, 1 << 20), (6, 9), (1, 1)])
def test_collocations_brute_force(spark, monkeypatch, sizes):
    docs = collocation_docs()
    df = spark.createDataFrame([(lang, t, "x", "y") for lang, t in docs], "lang string, text string, phrase string, `a.b` string").repartition(3)
    for least, top in ((8, 2000), (3, 25)):
        got = list(map(tuple, collocations.collocations(df, least=least, top=top, word_ids=sizes[0], phrase_ids=sizes[1]).collect()))
        assert len(got) == len(set(got)) and set(got) == plain_collocations(docs, least, 80, top)
        assert len(got) > 5


def test_collocation_stretches_and_tiles(monkeypatch):
    docs = collocation_docs()
    batch = lambda: iter([pa.record_batch([pa.array([x for x, _ in docs], pa.string()), pa.array([x for _, x in docs], pa.string())], ["lang", "text"])])
    whole = [(lang, t) for lang, t in collocations.stretches(batch(), 0)]
    monkeypatch.setattr(collocations, "STRETCH", 50)
    parts = collections.defaultdict(collections.Counter)
    for lang, t in collocations.stretches(batch(), 2):
        parts[lang].update(x for x in zip(t, t[1:], t[2:]) if all(map(collocations.is_word, x)))
    want = collections.defaultdict(collections.Counter)
    for lang, t in whole:
        want[lang].update(x for x in zip(t, t[1:], t[2:]) if all(map(collocations.is_word, x)))
    assert {k: v for k, v in parts.items() if v} == {k: v for k, v in want.items() if v}
    monkeypatch.setattr(collocations, "DENSE_PAIRS", 40)
    rng = np.random.default_rng(3)
    pairs, total = collocations.Pairs(), collections.Counter()
    for _ in range(5):
        x, y = (rng.exponential(900, 400).astype(np.int64) for _ in range(2))
        pairs.add(x, y)
        total.update(zip(x.tolist(), y.tolist()))
    assert 0 < len(pairs.dense) <= collocations.DENSE_TILES
    found = collections.Counter()
    for b in [*pairs.sparse(), *pairs.tiles()]:
        for code, n in zip(b.column(0).to_pylist(), b.column(3).to_pylist()):
            found[(code >> 20, code & (1 << 20) - 1)] += n
    assert found == total


def test_collocations_beyond_the_tables_cost_no_call_per_place(spark, monkeypatch, tmp_path):
    rng, calls, digest = random.Random(5), str(tmp_path / "calls"), collocations.xxh64_intdigest
    docs = [("en", " ".join(f"w{int(300 * rng.random() ** 2)}" for _ in range(2000))) for _ in range(20)]

    def counted(*args):
        with open(calls, "ab") as f:  # workers share the folder here
            f.write(b".")
        return digest(*args)

    monkeypatch.setattr(collocations, "xxh64_intdigest", counted)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    got = list(map(tuple, collocations.collocations(df, least=5, word_ids=4, phrase_ids=4).collect()))
    assert len(got) > 100 and set(got) == plain_collocations(docs, 5, 80, 2000)
    assert 0 < os.path.getsize(calls) < 10_000  # of 40,000 words, for each length


def test_collocations_small_blocks(spark, monkeypatch):
    for name, n in (("STRETCH", 60), ("BLOCK", 300), ("KEEP", 60), ("DENSE_PAIRS", 2)):
        monkeypatch.setattr(collocations, name, n)
    docs = collocation_docs()
    docs += [("a.b", "x\0 x " * 9), ("a.b", "wörter " * 20 + " " * 500 + "und . mehr " * 30), ("", ("y" * 9 + " " + "z" * 70 + "\t ") * 12), ("", ("z" * 71 + " " + "z" * 70 + ",") * 9)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(2)
    for sizes in ((40, 60), (1 << 18, 1 << 20)):
        got = list(map(tuple, collocations.collocations(df, least=8, word_ids=sizes[0], phrase_ids=sizes[1]).collect()))
        assert len(got) == len(set(got)) and set(got) == plain_collocations(docs, 8, 80, 2000)


def test_collocation_ids():
    rng = np.random.default_rng(4)
    h = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    h[:50] = (np.uint64(7) << np.uint64(58)) + np.arange(50, dtype=np.uint64)  # of one place
    bits = np.zeros(1 << 20, bool)
    bits[(h[2000:2500] >> np.uint64(44)).astype(int)] = True
    ids = collocations.Ids(pa.array(["en"] * 2000), pa.array([b"a"] * 2000, pa.binary()), h[:2000], np.packbits(bits, bitorder="little"))
    got = collocations.Ids.of(ids.tables()).find(np.concatenate([h, h[:50] + np.uint64(50)]))
    assert got[:2000].tolist() == list(range(2000)) and (got[2000:2500] == collocations.BEYOND).all()
    assert (got[2500:] == collocations.NONE).mean() > 0.9
    assert collocations.Ids(pa.array([], pa.string()), pa.array([], pa.binary()), h[:0], None).find(h).tolist() == [collocations.NONE] * 3000


def test_collocations_empty(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(df).collect() == []
    assert collocations.collocations(spark.createDataFrame([(None, None), ("en", "a b")], "lang string, text string")).collect() == []


# --- cross-tokenizer alignment


def random_tokens(rng, n):
    a, b = (sorted({n, *(rng.randint(1, n) for _ in range(rng.randint(0, n)))}) for _ in range(2))
    return [[e << alignment.ID_BITS | rng.randint(0, 5) for e in side] for side in (a, b)]


def plain_groups(a, b):
    """Groups between offsets where both end, and in each the pairs whose ranges overlap."""
    spans = [[(e0, t >> 17, t & (1 << 17) - 1) for e0, t in zip([0, *(x >> 17 for x in side)], side)] for side in (a, b)]
    groups, start = [], 0
    for end in sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]}):
        x, y = ([s for s in side if start <= s[0] and s[1] <= end] for side in spans)
        groups.append((",".join(str(s[2]) for s in x) + "|" + ",".join(str(s[2]) for s in y), sorted(p[2] << 17 | q[2] for p in x for q in y if p[0] < q[1] and q[0] < p[1])))
        start = end
    return groups


def test_fragments_are_a_monoid():
    rng = random.Random(11)
    for _ in range(300):
        n = rng.randint(1, 40)
        a, b = random_tokens(rng, n)
        want = plain_groups(a, b)
        groups, rest = alignment.align(a, b)
        assert [(t, sorted(x)) for t, x in groups] == want and rest == ([], [])
        cuts = sorted({0, *(rng.randint(0, n) for _ in range(5))})
        parts = []  # (fragment, groups with their place) of the tokens that start in each range
        for lo, hi in zip(cuts, [*cuts[1:], n]):
            own = [[t for e0, t in zip([0, *(x >> 17 for x in side)], side) if lo <= e0 < hi] for side in (a, b)]
            f, g = alignment.fragment(*own)
            parts.append((f, [(t, sorted(x)) for t, x in g]))
        order = []
        while len(parts) > 1:  # in any order of composition
            i = rng.randrange(len(parts) - 1)
            f, between = alignment.compose(parts[i][0], parts[i + 1][0])
            parts[i:i + 2] = [(f, parts[i][1] + [(t, sorted(x)) for t, x in between] + parts[i + 1][1])]
        f, inner = parts[0]
        last, _ = alignment.align(*f.head)  # a text begins where both sides start
        assert [(t, sorted(x)) for t, x in last] + inner == want and f.tail == ([], [])


def plain_alignment(docs):
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    chars = alignment.byte_of()
    counts, made = collections.Counter(), []
    for i, t in docs:
        groups = None
        if t:
            ids = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
            texts = [[bytes(chars[c] for c in a.id_to_token(x)) for x in ids[0]],
                     [bytes([int(p[3:5], 16)]) if b.is_byte(x) else p.replace("▁", " ").encode() for x in ids[1] for p in [b.id_to_piece(x)]]]
            if all(b"".join(x) == (" " + t).encode() for x in texts):
                sides = [[int(e) << 17 | x for e, x in zip(np.cumsum([len(y) for y in own]), side)] for own, side in zip(texts, ids)]
                groups = plain_groups(*sides) if len(t) < 3000 else [(x, sorted(y)) for x, y in alignment.align(*sides)[0]]
                counts.update(x for g in groups for x in g[1])
        made.append((i, sides if groups else ([], []), groups or []))
    best = collections.defaultdict(int)
    for c, n in counts.items():
        best[c & (1 << 17) - 1] = max(best[c & (1 << 17) - 1], n)
    out = []
    for i, sides, groups in made:
        links = [x for g in groups for x in g[1]]
        sha = hashlib.sha256(";".join(g[0] for g in groups).encode()).hexdigest() if groups else ""
        out.append((i, len(sides[0]), len(sides[1]), len(groups), len(links), sum(counts[x] == best[x & (1 << 17) - 1] for x in links), sum(counts[x] for x in links), sha))
    return collections.Counter(out)


def alignment_docs(spark):
    rng = random.Random(12)
    odd = ["a", " ", "  ", "\n", " b", "né", " ", "日本", "😀", "'s", "<|endoftext|>", "<0x41>", "<s>", "12", "\t", "x" * 40, " the", " and,", "--", "　"]
    docs = texts_of(spark, 60) + [(i, "".join(rng.choice(odd) for _ in range(rng.randint(1, 60)))) for i in range(1000, 1060)]
    docs += [(1, None), (2, ""), (3, " "), (4, " lead"), (5, "trail  "), (6, "a ▁b"), (7, "has ▁ inside " + "long text here " * 300), (7, "twice twice"), (None, "no id"), (8, "▁")]
    return docs + [(9, "One two, three! " * 400), (10, "z" * 3000 + " tail of it"), (11, "日本語のテキスト" * 200 + " x y " * 300), (12, "    a b  c d" * 200), (13, "x y" + "q" * 900)]


@pytest.mark.parametrize("size, fan, table", [(1 << 16, 8, 1 << 20), (100, 2, 50), (700, 3, 2000)])
def test_alignment_brute_force(spark, size, fan, table):
    docs = alignment_docs(spark)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, row int, `a.k` string").repartition(3)
    got = collections.Counter(map(tuple, alignment.align_documents(df, size=size, fan=fan, table=table).collect()))
    want = plain_alignment(docs)
    assert got == want
    assert sum(x[1] == 0 for x in want) >= 4


def test_alignment_empty(spark):
    assert alignment.align_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_ranges_hold_all_bytes():
    rng = random.Random(13)
    for _ in range(200):
        t = "".join(rng.choice(["ab", " ", "  ", "é", "c d", "\n"]) for _ in range(rng.randint(1, 80))).encode()
        at, raw = 0, b" " + t
        for k, base, skip, stop, part in alignment.ranges(t, rng.randint(1, 30)):
            assert base + skip == at and raw[base:base + len(part)] == part and part[:1] == b" "
            at = base + stop
        assert at == len(raw)


# --- faults of earlier rounds


@pytest.mark.parametrize("space", [" ", "\t", "\n", "\r\n", " \n"])
def test_packing_never_cuts_a_run_of_white_space(monkeypatch, space):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    monkeypatch.setattr(kernels, "PIECE", 24)
    path = P.path("byte_bpe_50k.json")
    ids, plain = packing.Ids(path), Tokenizer.from_file(path)
    texts = ["ab" * k + "c" * odd + space * run + "Word and" + space * run for run in range(1, 9) for k in range(6, 13) for odd in (0, 1)]
    raw, offsets = kernels.utf8(pa.array(texts))
    for row, got in ids.rows(raw, offsets):
        assert got.tolist() == plain.encode(texts[row], add_special_tokens=False).ids


def test_chat_roles_of_any_length(spark):
    roles = ["r" * 1_000_000, ":" * 300_000, "\\" * 300_000, "#\\:</turn>" * 50_000, "", ":", "\\", "a\nb: c", "😀:"]
    rows = [(i, 0, r, f"text: {r[-20:]} \\: x") for i, r in enumerate(roles)]
    df = spark.createDataFrame(rows, "conv_id long, place int, role string, text string")
    out = chat.render(df).withColumn("turns", chat.read_back(F.col("formatted"))).collect()
    assert sorted((r.conv_id, t.role, t.text) for r in out for t in r.turns) == sorted((i, r, t) for i, _, r, t in rows)


def test_languages_need_a_letter():
    assert [langid.letters(t) for t in ("½ ²", "①", "", None, "1_2", "́ ")] == [b""] * 6
    assert langid.letters("हिन्दी में, Été!") == " हिन्दी में été ".encode()


def test_dictionaries_share_all_sampled_texts(spark):
    rows = [(f"{chr(97 + i % 26)}{'abcdefghij'[i // 26]} " * 3000, "xx") for i in range(200)]
    (name, content), = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert name == "xx" and langid.DICTIONARY - 2 * langid.SAMPLE <= len(content) <= langid.DICTIONARY
    picked = len({xx for xx in content.split() if len(xx) == 2})
    assert 60 < picked <= langid.SAMPLE


def test_columns_of_any_name(spark):
    d = spark.createDataFrame([(1, "write to a.b@example.org now", 5, "x")], "doc_id long, text string, `row.x` int, `hinted` string")
    got = pii.redact(d)
    assert got.columns == d.columns and got.first()[2:] == (5, "x")
    p = spark.createDataFrame([(1, "<p>Some text here</p>", "old")], "page_id long, html string, Text string")
    out = html_text.extract(p)
    assert out.columns == ["page_id", "text", "n_chars"] and out.first().text == "Some text here"


def test_pipeline_keeps_documents_without_any_label(spark):
    d = spark.createDataFrame([(1, "some text", None, "s", 9), (2, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars int")
    assert corpus_pipeline.language_id(spark, d, SF).count() == 2
