r"""Personal data by a semi-Markov conditional random field (operator 10).

Text is looked at in zones: stretches around digits or an at sign that could hold an
entity. A zone is cut into tokens (runs of letters, runs of digits, single other signs). A
segment is a run of at most ``LONGEST`` tokens, and whole-span features (length, digits,
groups, separators, checksums, dots, words before) score it for each type. The score of a
segmentation is the sum over its segments, tokens outside entities counting 0; dynamic
programming over segment ends, bounded by ``LONGEST``, finds the best one, which decides
boundaries and types together.

Weights are trained here by the conditional likelihood (forward-backward over the same
bounded segments) on a bounded sample of the corpus: at most ``ZONES`` zones, whose
segmentations come from the exact rules for e-mail, IP, card and phone below, and copies
of them in looser writings (no plus sign, "at" and "dot" in words) that the rules miss.
Spans found by the rules always stay; the field adds spans that overlap none of them.

Scale: one pass without a shuffle; texts without a digit, an at sign or "at"/"dot" in
brackets never leave the JVM. A zone is as long as its signs go on and is
decoded in its length times ``LONGEST``, ``STRETCH`` tokens at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..workers import ship_by_value
from . import kernels
from .common import read

KINDS = ("email", "ip", "card", "phone")
LONGEST, ZONES, EPOCHS = 24, 600, 12
#: Tokens whose segments are scored at once.
STRETCH = 512
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: Possessive from the start of a run of digits: the same matches as without, in linear time.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Texts that may hold an entity, for Spark and Python alike.
HINT = r"[0-9@]|\[at\]|\(at\)"
ZONE = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++[\x20]?(?:@|\[at\]|\(at\))[\x20]?[A-Za-z0-9.()\[\]-]+(?:[\x20](?:\[dot\]|\(dot\))[\x20][A-Za-z0-9-]+)*|[+(]?[0-9](?:[\x20().0-9/+-]*[0-9])?")
TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|.", re.S)
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of EMAIL, found from the at signs (a search from every letter would take
    a time square in the length of a run of letters)."""
    done = 0
    at = text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at)
        a = at
        while a > done and text[a - 1] in LOCAL_SIGNS:
            a -= 1
        if m and a < at:
            yield a, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def by_rules(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the exact rules, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    out += [(1, *m.span()) for m in IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


FEATURES = 24


def features(text: str, a: int, b: int) -> np.ndarray:
    """Whole-span features of a segment."""
    s = text[a:b]
    digits = re.sub("[^0-9]", "", s)
    n, groups = len(digits), re.findall("[0-9]+", s)
    before = text[a - 1] if a else " "
    after = text[b] if b < len(text) else " "
    letters = sum(c.isalpha() for c in s)
    dots = s.count(".")
    words = re.findall(r"[a-z]+", text[max(0, a - 24):a].lower())[-2:]
    return np.array([
        1, before.isalnum(), after.isalnum(), letters > 0, letters == 0 and n > 0,
        13 <= n <= 19 and letters == 0, 13 <= n <= 19 and letters == 0 and luhn(digits), 9 <= n <= 15 and letters == 0, n < 7, n > 19,
        len(groups) == 4 and dots == 3 and all(len(g) <= 3 and int(g) <= 255 for g in groups) and len(s) == n + 3, len(groups) == 4 and dots == 3,
        s[0] == "+", s[0] == "(", len(groups) >= 3 and letters == 0 and dots == 0 and all(2 <= len(g) <= 4 for g in groups[1:]), s[0].isalnum() or s[0] in "+(", s[-1].isalnum(),
        "@" in s and 0 < s.find("@") < len(s) - 3, bool(re.fullmatch(r"[\w.%+-]+\s?(@|\[at\]|\(at\))\s?[\w-]+((\.|\s\[dot\]\s|\s\(dot\)\s)[\w-]+)+", s, re.A)), "[at]" in s or "(at)" in s,
        " " in s, s.count("(") != s.count(")"), any(w in ("tel", "phone", "call", "fax", "mobile") for w in words), any(w in ("card", "visa", "credit", "mail", "email", "ip") for w in words),
    ], dtype=np.float64)


def zones(text: str) -> Iterator[tuple[int, int]]:
    for m in ZONE.finditer(text):
        s = m[0]
        if "@" in s or "at" in s or sum(c.isdigit() for c in s) >= 4:
            yield m.span()


def allowed(text: str, a: int, b: int) -> list[bool]:
    """Kinds that a segment can be at all, by kind."""
    s = text[a:b]
    n = sum(c.isdigit() for c in s)
    plain = not any(c.isalpha() for c in s)
    return ["@" in s or "[at]" in s or "(at)" in s, plain and s.count(".") == 3, plain and 13 <= n <= 19, plain and 9 <= n <= 15 and any(c in s for c in "+(-.")]


def cuts_of(text: str, a: int, b: int) -> list[int]:
    """Token starts (with the end)."""
    return [a + m.start() for m in TOKEN.finditer(text[a:b])] + [b]


def segments(text: str, a: int, b: int) -> tuple[list[int], list[tuple[int, int]], np.ndarray, np.ndarray]:
    """Token starts (with the end), the candidate segments by token, their features,
    and what kinds are ruled out. A segment begins and ends with a sign that an entity can
    begin and end with."""
    cuts = cuts_of(text, a, b)
    return cuts, *segments_from(text, cuts, 0, len(cuts) - 1)


def segments_from(text: str, cuts: list[int], first: int, last: int) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """The segments that begin at the tokens from ``first`` to before ``last``."""
    spans = [(i, j) for i in range(first, min(last, len(cuts) - 1)) for j in range(i + 1, min(i + LONGEST, len(cuts) - 1) + 1)
             if cuts[j] - cuts[i] >= 7 and (text[cuts[i]].isalnum() or text[cuts[i]] in "+(") and text[cuts[j] - 1].isalnum()]
    may = np.array([allowed(text, cuts[i], cuts[j]) for i, j in spans], bool).reshape(len(spans), len(KINDS))
    spans = [s for s, m in zip(spans, may) if m.any()]
    may = may[may.any(axis=1)]
    x = np.stack([features(text, cuts[i], cuts[j]) for i, j in spans]) if spans else np.zeros((0, FEATURES))
    return spans, x, np.where(may, 0.0, -1e9)


def decode(weights: np.ndarray, text: str, a: int, b: int) -> list[tuple[int, int, int]]:
    """Best segmentation of a zone as (kind, start, end)."""
    cuts = cuts_of(text, a, b)
    spans, kinds, top = [], [], []  # segments that score above 0
    into: dict[int, list[int]] = {}
    for first in range(0, len(cuts) - 1, STRETCH):
        some, x, may = segments_from(text, cuts, first, first + STRETCH)
        if some:
            score = x @ weights.T + may
            most = score.max(axis=1)
            for k in np.flatnonzero(most > 0):
                into.setdefault(some[k][1], []).append(len(spans))
                spans.append(some[k])
                kinds.append(int(score[k].argmax()))
                top.append(most[k])
    if not spans:
        return []
    best, by = [0.0] * len(cuts), [-1] * len(cuts)
    for j in range(1, len(cuts)):
        best[j], by[j] = best[j - 1], -1
        for k in into.get(j, ()):
            v = best[spans[k][0]] + top[k]
            if v > best[j]:
                best[j], by[j] = v, k
    out, j = [], len(cuts) - 1
    while j > 0:
        if by[j] < 0:
            j -= 1
        else:
            i, e = spans[by[j]]
            out.append((kinds[by[j]], cuts[i], cuts[e]))
            j = i
    return out[::-1]


def train(samples: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = EPOCHS, rate: float = 0.5, l2: float = 1e-3) -> np.ndarray:
    """Weights (kind by feature) of the largest conditional likelihood of the segmentations of
    the sample texts, each one zone, by stochastic gradients (Adagrad)."""
    w = np.zeros((len(KINDS), FEATURES))
    w[:, 0] = -1.0
    seen = np.full_like(w, 1e-6)
    ready = []
    for text, gold in samples:
        cuts, spans, x, may = segments(text, 0, len(text))
        if spans:
            at = {(cuts[i], cuts[j]): k for k, (i, j) in enumerate(spans)}
            ready.append((len(cuts), spans, x, may, [(kind, at[a, b]) for kind, a, b in gold if (a, b) in at]))
    rng = np.random.default_rng(3)
    for _ in range(epochs):
        for r in rng.permutation(len(ready)):
            n, spans, x, may, gold = ready[r]
            score = x @ w.T + may
            each = np.logaddexp.reduce(score, axis=1)
            forward, backward = np.full(n, -np.inf), np.full(n, -np.inf)
            forward[0] = backward[-1] = 0.0
            order: dict[int, list[int]] = {}
            for k, (_, j) in enumerate(spans):
                order.setdefault(j, []).append(k)
            for j in range(1, n):
                forward[j] = np.logaddexp.reduce([forward[j - 1], *(forward[spans[k][0]] + each[k] for k in order.get(j, ()))])
            starts: dict[int, list[int]] = {}
            for k, (i, _) in enumerate(spans):
                starts.setdefault(i, []).append(k)
            for i in range(n - 2, -1, -1):
                backward[i] = np.logaddexp.reduce([backward[i + 1], *(each[k] + backward[spans[k][1]] for k in starts.get(i, ()))])
            i, j = np.array([s[0] for s in spans]), np.array([s[1] for s in spans])
            p = np.exp(forward[i][:, None] + score + backward[j][:, None] - forward[-1])
            grad = -(p.T @ x) - l2 * w
            for kind, k in gold:
                grad[kind] += x[k]
            seen += grad * grad
            w += rate * grad / np.sqrt(seen)
    return w


def looser(text: str, gold: list[tuple[int, int, int]]) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Copies of a zone that is one entity, in writings that the rules miss."""
    if len(gold) != 1 or gold[0][1:] != (0, len(text)):
        return []
    if gold[0][0] == 0:
        user, _, host = text.partition("@")
        out = [f"{user} [at] {host.replace('.', ' [dot] ')}", f"{user} (at) {host}"]
    elif gold[0][0] == 3 and "(" in text:
        rest = text[text.index("("):]
        out = [rest, rest.replace("(", "").replace(") ", "-")]
    else:
        out = []
    return [(t, [(gold[0][0], 0, len(t))]) for t in out]


def fit(docs: DataFrame, text_col: str = "text", most: int = ZONES) -> np.ndarray:
    """Weights from at most ``most`` zones: those of the texts of least hash, of whose
    places around a candidate ``most`` are taken, those of least hash. Without any, the field adds nothing."""
    t = docs.select(F.col(text_col).alias("text")).filter(F.col("text").rlike(HINT)).withColumn("h", F.xxhash64("text"))
    least = t.select("h").distinct().orderBy("h").limit(most)  # the bounded sample
    texts = t.join(F.broadcast(least), "h").groupBy("h").agg(F.min(F.expr(f"regexp_extract_all(text, '(?s).{{0,80}}(?:{HINT.replace(chr(92), chr(92) * 2)}).{{0,80}}', 0)")).alias("near"))
    near = texts.select(F.explode("near").alias("text")).orderBy(F.xxhash64("text"), "text").limit(most).collect()
    samples = []
    for r in near:
        rules = by_rules(r.text)
        for a, b in zones(r.text):
            gold = [(k, x - a, y - a) for k, x, y in rules if a <= x and y <= b]
            gold = [g for i, g in enumerate(gold) if not any(g[1] < o[2] and o[1] < g[2] for o in gold[:i])]
            samples.append((r.text[a:b], gold))
            samples += looser(r.text[a:b], gold)
    return train(samples[:2 * most]) if samples else np.full((len(KINDS), FEATURES), -1.0)


def spans_of(text: str | None, weights: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """((kind, start, end) of the rules, those added by the field), each by kind and start."""
    if not text:
        return [], []
    rules = by_rules(text)
    taken = sorted((a, b) for _, a, b in rules)
    merged: list[list[int]] = []
    for a, b in taken:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    begins = [m[0] for m in merged]
    added = []
    for a, b in zones(text):
        # a zone that the rules cover whole needs no decoding: nothing could be added
        i = int(np.searchsorted(begins, a, "right")) - 1
        if i >= 0 and merged[i][1] >= b:
            continue
        for kind, x, y in decode(weights, text, a, b):
            i = int(np.searchsorted(begins, y, "left")) - 1
            if i < 0 or merged[i][1] <= x:
                added.append((kind, x, y))
    return rules, sorted(added)


def masked(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with every span written as its kind's mask; overlapping spans as the first."""
    if text is None:
        return None
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= at:
            out += [text[at:a], MASKS[KINDS[kind]]]
        at = max(at, b)
    return "".join(out) + text[at:]


def find(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """The input with ``rule_spans`` and ``added_spans`` (arrays of kind, start, end in code
    points, end exclusive) added; input columns of these names are replaced.

    A null or empty text has no spans. Rows are handled one by one, repeated or not; an
    empty table gives an empty result.
    """
    own = "rule_spans array<struct<kind:int,start:bigint,end:bigint>>, added_spans array<struct<kind:int,start:bigint,end:bigint>>"
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("rule_spans", "added_spans")])
    hinted = docs.select("*", F.when(F.col(f"`{text_col}`").rlike(HINT), F.col(f"`{text_col}`")).alias("\0hinted"))
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(own).fields])
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in kernels.slices(batches):
            found = [spans_of(t.as_py(), weights) for t in b.column(b.num_columns - 1)]
            cols = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in f[i]] for f in found], kind) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *cols], names=schema.names)

    return hinted.mapInArrow(run, schema)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The input with personal data in ``text_col`` masked and ``n_chars``, if there, counted
    anew. Texts without spans stay as they are. Other columns may have any name."""
    weights = fit(docs, text_col)
    place = docs.columns.index(text_col)
    count = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    hinted = plain.select("*", F.col(f"c{place}").rlike(HINT).alias("hinted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in kernels.slices(batches):
            cols, texts, hints = list(b.columns[:-1]), b.column(place).to_pylist(), b.column(b.num_columns - 1).to_pylist()
            new = [masked(t, [s for x in spans_of(t, weights) for s in x]) if h else t for t, h in zip(texts, hints)]
            cols[place] = pa.array(new, cols[place].type)
            if count is not None:
                cols[count] = pa.array([n if x is y or x == y else len(y) for n, x, y in zip(cols[count].to_pylist(), texts, new)], cols[count].type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1])

    return hinted.mapInArrow(run, plain.schema).toDF(*docs.columns)


def op10(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    names = F.array(*map(F.lit, KINDS))
    say = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda c: F.array_join(F.transform(c, say), ",")
    count = lambda k: F.size(F.filter("rule_spans", lambda s: s["kind"] == k)).cast("long")
    found = find(docs, fit(docs)).drop("text")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(joined("rule_spans"), 256).alias("base_sha256"),
                        joined(F.array_sort(F.concat("rule_spans", "added_spans"))).alias("spans"))


ship_by_value(__name__)
