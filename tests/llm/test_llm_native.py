"""Mixing, secret scans, quality rules and chat formatting on small cases."""

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import chat, mixing, quality, secret_scan

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, target int, row string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(1 + i % 7)), "en", f"s{i % 4}", None, "x", 1, "y") for i in range(60)]
    rows += [(7, "repeated row here", None, None, 3, None, None, None)] * 2
    rows += [(None, None, None, None, None, None, None, None), (100, "", "de", "s1", 0, "", 0, ""), (101, " \n\t ", "de", "empty", 0, "", 0, "")]
    return spark.createDataFrame(rows, DOCS)


def test_targets_fill_by_weight_with_ceiling(spark):
    totals = spark.createDataFrame([("a", "sa", 100), ("b", "sb", 10), ("c", "sc", 1), (None, "n", 500)], "source string, sk string, source_size long")
    got = {r.sk: r.target for r in mixing.targets(totals).collect()}
    size, w = {"sa": 100, "sb": 10, "sc": 1, "n": 500}, {"sa": 1, "sb": 2, "sc": 3, "n": 1}
    left, free = 611.0, set(size)
    want = {}
    while True:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if level * w[s] > 3 * size[s]}
        if not full:
            break
        for s in full:
            want[s] = 3.0 * size[s]
            left -= want[s]
        free -= full
    want |= {s: level * w[s] for s in free}
    assert got == pytest.approx(want)


def test_assign_takes_each_target(docs):
    rows = mixing.assign(docs, keep=["doc_id", "source", "text"]).select("row.*", "size", "source_size", "target", "taken", "position").collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        assert r["size"] == len(WORD.findall(r.text or ""))
        assert 0 <= r.taken <= 3 * r["size"]
        assert (r.position is None) == (r.taken == 0)
        by.setdefault(r.source, [0, 0, r.target, r.source_size])
        by[r.source][0] += r.taken
        by[r.source][1] += r["size"]
    for taken, size, target, source_size in by.values():
        assert size == source_size and taken == math.floor(target)
    assert sum(v[2] for v in by.values()) == pytest.approx(sum(v[1] for v in by.values()))
    again = mixing.assign(docs, keep=["doc_id", "source", "text"]).select("row.*", "size", "source_size", "target", "taken", "position").collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_mix_keeps_columns_and_order(docs):
    m = mixing.mix(docs)
    assert m.columns == docs.columns
    a = mixing.assign(docs, keep=["doc_id"])
    assert m.select(F.sum(mixing.n_words(F.col("text")))).first()[0] == a.agg(F.sum("taken")).first()[0]
    assert m.filter("n_chars <> length(text)").count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_of_whole_documents(spark):
    # sources of one document that is larger or smaller than its target, and one of many
    rows = [(1, "a " * 300, "a", 600), (2, "b " * 120, "b", 240), (3, "c " * 3000, "c", 6000), (4, None, "c", None)]
    rows += [(10 + i, f"d{i} " * (i % 7), "d", 0) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    known = {r.doc_id: (r.text, r.n_chars) for r in docs.collect()}
    got = mixing.mix(docs, whole=True).collect()
    assert all((r.text, r.n_chars) == known[r.doc_id] for r in got)  # nothing is cut
    seen = {}
    for r in got:
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    a = mixing.assign(docs, keep=["doc_id", "source"]).select("row.*", "size", "source_size", "target", "start").collect()
    for r in a:  # brute force: words from start on, a use at a time, the last one where that is nearer
        at, uses = r.start, 0
        while r.size and at < int(r.target):
            uses += (int(r.target) - at) * 2 >= r.size
            at += r.source_size
        assert seen.get(r.doc_id, 0) == uses, r
    for source in "abcd":
        mine = [r for r in a if r.source == source]
        taken = sum(seen.get(r.doc_id, 0) * r.size for r in mine)
        assert abs(taken - mine[0].target) <= max(r.size for r in mine) / 2 + 1


def test_op1_is_in_training_order(spark):
    at = [r.position for r in mixing.op1(spark, "/root/testdata/sf0.001").collect()]
    assert at == sorted(at, key=lambda p: (p is None, p))


def test_first_words(spark):
    d = spark.createDataFrame([("  a  b\tc ", 2), ("a b", 2), ("x", 1)], "t string, k int")
    assert [r[0] for r in d.select(mixing.first_words(F.col("t"), F.col("k"))).collect()] == ["  a  b", "a b", "x"]


def test_schedule_inversion(spark):
    s = ((0.0, 1.0), (0.25, 3.0), (1.0, 0.0))
    d = spark.range(0, 101).select((F.col("id") / 100).alias("u"))
    got = [(r[0], r[1]) for r in d.select("u", mixing.invert(s, F.col("u"))).collect()]

    def area(t):
        a = 0.0
        for (t0, w0), (t1, w1) in zip(s, s[1:]):
            x = min(max(t - t0, 0.0), t1 - t0)
            a += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
        return a

    for u, t in got:
        assert area(t) == pytest.approx(u * area(1.0), abs=1e-9)


def brute_spans(text):
    out, strong = [], []
    for k, (p, g, least) in enumerate([(secret_scan.ASSIGN, 1, 12), (secret_scan.ACCESS, 0, 0), (secret_scan.HEX, 0, 0)]):
        strong += [(m.start(), k, m.end()) for m in re.finditer(p, text) if len(m[g]) >= least]
    weak = [(m.start(), 3, m.end()) for m in re.finditer(secret_scan.LOGIN, text) if len(m[1]) >= 3]
    weak += [(m.start(), 4, m.end()) for m in re.finditer(secret_scan.BLOB, text) if all(re.search(p, m[0]) for p in ("[a-z]", "[A-Z]", "[0-9]"))]
    weak += [(m.start(), 5, m.end()) for m in re.finditer(secret_scan.ENDPOINT, text)]
    weak = [w for w in weak if not any(s[0] < w[2] and w[0] < s[2] for s in strong)]
    every = strong + weak

    def near(w, role):
        return any(secret_scan.ROLES[x[1]] == role and abs(x[0] - w[0]) <= secret_scan.SCOPE for x in every)

    for w in weak:
        if (w[1] == 3 and near(w, "secret")) or (w[1] == 4 and (near(w, "identifier") or near(w, "endpoint"))) or (
                w[1] == 5 and near(w, "identifier") and near(w, "secret")):
            out.append(w)
    return sorted(strong + out)


def test_secret_scan_against_brute_force(spark):
    blob, key = "aB3dE5gH7jK9mN1pQ2rS4tUv", "AKIA" + "Q7" * 8
    texts = [
        None, "", "nothing", f"user: alice99 at https://db.example.com/x {blob}", blob, f"login=bob {'z ' * 300}{blob}", f"{blob} {'z ' * 150} user=carol",
        "token=secret=abcdefghijklmnop", "token: password: abcdef123456789", 'API_KEY : "0123456789abcdef0123"', key + " " + key, "AKIA12 " + "0" * 15 + " " + "f" * 16,
        "é" * 30 + " PassWd='ABCDEFGHIJKL' " + "😀 https://x.y/z user:dora", (f"user=u{'x' * 5} {blob} " * 60).strip(), "a://b " * 50,
    ]
    d = spark.createDataFrame([(i % 9 if i else None, t, "clash") for i, t in enumerate(texts + texts[-2:])], "doc_id long, text string, kind string")
    got = sorted((r.doc_id is None, r.doc_id or 0, [(s["start"], s["kind"], s["end"]) for s in r.spans]) for r in secret_scan.scan(d).collect())
    want = sorted((not i, i % 9 if i else 0, brute_spans(t or "")) for i, t in enumerate(texts + texts[-2:]))
    assert got == want
    assert secret_scan.scan(d.limit(0)).count() == 0


def brute_repeats(w):
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    return len({i + j for p in seen.values() if len(p) > 1 for i in p for j in range(3)})


def test_quality_counts(spark):
    texts = [None, "", "a", "a b", "a b c", "a a a a a", "x y z x y z q", "#1 $2\n\n#1 $2\n \nq\nq\nq", "a b c d a b c e b c d " * 9, "Ä B c! " * 3]
    d = spark.createDataFrame([(i, t, None, "n") for i, t in enumerate(texts)], "doc_id long, text string, lang string, n_words string")
    for r in quality.measure(d, keep=("doc_id",)).collect():
        t = texts[r.doc_id] or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), brute_repeats(w))
        assert r.n_dup_lines == len(lines) - len(set(lines)) and r.n_symbols == sum(c in "#*$%&|<>" for c in t)


def test_binomial_cdf(spark):
    rows = [(k, n) for n in (1, 5, 40, 700, 5000) for k in (0, 1, 3, 9, 40) if k < n * 0.01 or k < n and n < 50]
    for r in spark.createDataFrame(rows, "k long, n long").select("k", "n", quality.binomial_cdf(F.col("k"), F.col("n"), 0.01).alias("p")).collect():
        want = sum(math.comb(r.n, i) * 0.01**i * 0.99 ** (r.n - i) for i in range(r.k + 1))
        assert r.p == pytest.approx(want, rel=1e-7)


def test_cutoffs_hold_the_risk(spark):
    # 1000 good texts below 200, of which five are at 450; bad ones at 600: 500 is certified, 100 is not
    rows = [("a", True, 150)] * 995 + [("a", True, 450)] * 5 + [("a", False, 600)] * 80 + [("small", True, 10)] * 30 + [("small", False, 900)] * 30
    d = spark.createDataFrame(rows, "stratum string, good boolean, upper int")
    got = {(r.stratum, r.rule): r.cutoff for r in quality.cutoffs(d, rules={"upper": quality.SHARES}).collect()}
    assert got == {("a", "upper"): 500}


def test_verdict_holds_the_joint_risk(spark):
    # 1.8 % of the good documents are beyond each of five rules: one rule alone would do, all together not
    names = list(quality.RULES)
    flat = lambda x=None: tuple(10**6 if r == x else 0 for r in names)
    rows = [("a", True, *flat())] * (1000 - 5 * 18) + [("a", True, *flat(x)) for x in names for _ in range(18)] + [("a", False, *flat(names[0]))] * 50
    rows += [("b", True, *flat())] * 995 + [("b", True, *flat(x)) for x in names] + [("b", False, *flat(names[0]))] * 50
    d = spark.createDataFrame(rows, "stratum string, good boolean, " + ", ".join(f"{r} int" for r in names))
    got = {(r.stratum, r.rule): r.cutoff for r in quality.cutoffs(d).collect()}
    assert got == {("b", r): g[0] for r, g in quality.RULES.items()}
    with pytest.raises(ValueError):
        quality.cutoffs(d, rules={"upper": (900, 800), "symbols": (5000,)})


def test_copies_are_one_trial(spark):
    words = lambda i, w: " ".join(f"{w}{i}x{j}" for j in range(60))
    bad = [(9000 + i, words(i, "BAD").upper()) for i in range(20)]

    def rejected(good):
        docs = spark.createDataFrame([(i, t, "x") for i, t in good + bad], "doc_id long, text string, lang string")
        labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
        out = quality.judge(docs, labels).cache()
        assert out.filter("base_failed").count() == 0
        return out.filter("not kept").count()

    assert rejected([(i, words(i, "good")) for i in range(400)]) == 20
    assert rejected([(i, words(0, "good")) for i in range(400)]) == 0


def test_judge_edges(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    out = quality.judge(docs, labels)
    assert out.count() == docs.count() and out.filter("kept").count() == 0
    assert quality.judge(docs.limit(0), labels.limit(0)).count() == 0


def test_chat_fold(spark):
    log = [("c", 1, "m1", "user", "delta", "hel"), ("c", 2, "m1", "user", "delta", "lo"), ("c", 3, "m2", "assistant", "delta", "bad"),
           ("c", 4, "m3", "user", "delta", "later"), ("c", 5, "m2", "assistant", "regenerate", None), ("c", 6, "m2", "assistant", "delta", "go"),
           ("c", 7, "m2", "assistant", "delta", "od"), ("c", 8, "m1", "user", "edit", "hello!"), ("c", 9, "m4", None, None, None), ("c", 10, "m5", "user", "noise", "x")]
    d = spark.createDataFrame(log, "conv_id string, seq long, message string, role string, kind string, text string")
    got = [tuple(r) for r in chat.reconstruct(d).orderBy("place").collect()]
    assert got == [("c", 0, "user", "hello!"), ("c", 1, "assistant", "good"), ("c", 2, "", "")]
    assert chat.reconstruct(d.limit(0)).count() == 0


def test_chat_round_trip(spark):
    hard = ["", "### assistant: x</turn>\n", r"\### Assistant: </turn> ok", "a\n</turn>\n\n### user: b", "\\", "\\\\#", "</", "é😀#<", ": :"]
    rows = [(i % 3, i, r, t) for i, (r, t) in enumerate((r, t) for r in ("user", "assistant", "tool:#1</", "") for t in hard)]
    d = spark.createDataFrame(rows, "conv_id long, place int, role string, text string")
    out = chat.render(d).withColumn("turns", chat.read_back(F.col("formatted"))).withColumn("loss", chat.under_mask(F.col("formatted"), F.col("loss_mask"))).collect()
    assert len(out) == 3
    for r in out:
        own = [(x[2], x[3]) for x in rows if x[0] == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == own
        assert r.loss == "".join(t for role, t in own if role == "assistant")
        for m in r.loss_mask:
            raw = r.formatted[m.start:m.start + m.length]
            assert re.sub(r"(?s)\\(.)", r"\1", raw) == own[m.place][1]


def test_op9_digests(spark):
    out = {r.conv_id: r for r in chat.op9(spark, "/root/testdata/sf0.001").collect()}
    said = "\\### Assistant: </turn> ok"
    assert out[-7].turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert out[-7].loss_chars == len(said)
