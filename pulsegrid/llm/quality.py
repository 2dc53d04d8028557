"""Quality rules with risk-controlled thresholds (operator 8), DataFrame functions only.

Each rule is a per-mille statistic of a text with a fixed grid of cutoffs, loosest first;
step i of the verdict rejects a text that is beyond the i-th cutoff of any rule. On the
labelled documents a step is certified for a stratum if the exact binomial test rejects
"this verdict, all rules together, throws away more than ``risk`` of the good documents".
Steps are tested from the loosest on and testing stops at the first that fails (fixed
sequence), so the grid costs no correction; strata are corrected by Bonferroni. Of the
certified steps the one that separates bad from good labels best is used, the loosest among
equals. With probability 1 - ``error`` the verdict falsely rejects at most ``risk`` of the
good documents in every stratum. Copies of a text are one trial, as the exact test needs.

Scale: texts are measured inside their rows and never shuffled; what is cut with a
checkpoint and joined to the labels is one short row of counts per document. Labels are
reduced to counts by (stratum, step) with partial sums before any window. The
table of cutoffs has one row per stratum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, let, read, words

RISK, ERROR = 0.02, 0.05
SHARES = (950, 900, 800, 700, 600, 500, 400, 300, 200, 100)
#: Rule -> cutoffs, in per mille, loosest first.
RULES = {
    "symbols": (5000, 3000, 2000, 1500, 1000, 700, 500, 300, 200, 100),
    "dup_lines": SHARES,
    "repeats": SHARES,
    "upper": SHARES,
    "exclaims": (5000, 3000, 2000, 1500, 1000, 700, 500, 300, 200, 100),
}
SYMBOLS = "#*$%&|<>"
UPPER = "".join(chr(c) for c in (*range(0x41, 0x5B), *range(0xC0, 0xD7), *range(0xD8, 0xDF)))


def n_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def repeated_words(w: Column) -> Column:
    """Words in windows of three that stand twice or more in the array ``w``.

    Windows are compared by a 64-bit hash; equal neighbours in the sorted (hash, place)
    pairs are the repeated windows, and the places they cover are added up in order.
    """
    def window(i):
        return F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    def covered(h):
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        same = lambda s, x, i: F.coalesce(F.get(s, i)["h"] == x["h"], F.lit(False))
        twice = let(pairs, lambda s: F.filter(s, lambda x, i: same(s, x, i - 1) | same(s, x, i + 1)))
        places = F.sort_array(F.transform(twice, lambda x: x["p"]))
        step = lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"))
        return F.aggregate(places, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")), step, lambda a: a["n"])

    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), window)
    return F.when(F.size(w) < 4, 0).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))))


def measure(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """``keep`` and the counts of each text (null: no words, all counts 0)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, " \t\n\x0b\f\r", "") != "")
    counts = let(words(text), lambda w: F.struct(F.size(w).alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    dup = let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    own = {
        "n_words": F.col("_w.n_words"), "word_chars": F.length(F.translate(text, " \t\n\x0b\f\r", "")), "n_symbols": n_of(text, SYMBOLS),
        "n_dup_lines": F.col("_l.n_dup_lines"), "n_repeat_words": F.col("_w.n_repeat_words"), "n_lines": F.col("_l.n_lines"),
        "n_upper": n_of(text, UPPER), "n_exclaims": n_of(text, "!"),
    }
    base = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text_col}`").alias(text_col),
                       counts.alias("_w"), dup.alias("_l"))
    return base.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *[v.cast("long").alias(k) for k, v in own.items()])


def statistics() -> dict[str, Column]:
    """Rule -> its statistic in whole per mille (null where it is not defined)."""
    per = lambda a, b: F.when(F.col(b) > 0, F.expr(f"(1000 * {a}) div {b}"))
    return {"symbols": per("n_symbols", "n_words"), "dup_lines": per("n_dup_lines", "n_lines"), "repeats": per("n_repeat_words", "n_words"),
            "upper": per("n_upper", "word_chars"), "exclaims": per("n_exclaims", "n_words")}


def ln_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 1 (Stirling's series at x + 8)."""
    y, product = x + 8, x
    for i in range(1, 8):
        product = product * (x + i)
    series = F.lit(1 / 12) / y - F.lit(1 / 360) / (y * y * y) + F.lit(1 / 1260) / (y * y * y * y * y)
    return (y - 0.5) * F.log(y) - y + F.lit(0.9189385332046727) + series - F.log(product)


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), k < n p: the sum of its terms from k down. Terms
    more than 12 standard deviations below the first are under double precision."""
    k, n = k.cast("double"), n.cast("double")
    first = ln_gamma(n + 1) - ln_gamma(k + 1) - ln_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log1p(F.lit(-p))
    terms = F.least(k, F.ceil(F.sqrt(n * p) * 12) + 50).cast("long")
    down = lambda a, j: F.struct((a["t"] * (k - j + 1) / (n - k + j) * ((1 - p) / p)).alias("t"),
                                 (a["s"] + a["t"] * (k - j + 1) / (n - k + j) * ((1 - p) / p)).alias("s"))
    steps = F.when(terms > 0, F.sequence(F.lit(1).cast("long"), terms)).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(steps, F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")), down, lambda a: a["s"])
    return F.exp(first) * total


def cutoffs(labelled: DataFrame, risk: float = RISK, error: float = ERROR, rules=RULES) -> DataFrame:
    """(stratum, good, and a column per rule in ``statistics()``) -> (stratum, rule, cutoff):
    the cutoffs of the stratum's certified step, none if no step is certified. Rows are the
    trials. Documents without a statistic count as not rejected by its rule. Grids have one length."""
    if len({len(g) for g in rules.values()}) != 1:
        raise ValueError("the grids of the rules need one length")
    steps = len(next(iter(rules.values())))
    # beyond counts the cutoffs below a statistic, and the loosest comes first: step i
    # rejects what is beyond at least (steps - i) cutoffs of one rule
    beyond = F.array_max(F.array(*[sum((F.coalesce((F.col(r) > c).cast("int"), F.lit(0)) for c in g), F.lit(0)) for r, g in rules.items()]))
    c = labelled.select("stratum", "good", beyond.alias("beyond")).groupBy("stratum", "beyond").agg(
        F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad"))
    whole = c.groupBy("stratum").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"),
                                     F.collect_list(F.struct("beyond", "good", "bad")).alias("b"))  # a grid's size and one
    t = whole.select("*", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("i"))
    hit = F.filter("b", lambda x: x["beyond"] >= F.lit(steps) - F.col("i"))
    total = lambda f: F.aggregate(hit, F.lit(0).cast("long"), lambda a, x: a + x[f])
    t = t.withColumn("k", total("good")).withColumn("hits", total("bad"))
    level = F.lit(error) / whole.select(F.count("*")).scalar()
    t = t.withColumn("passed", (F.col("k") < F.col("n_good") * risk) & (binomial_cdf(F.col("k"), F.col("n_good"), risk) <= level))
    by = Window.partitionBy("stratum")
    t = t.withColumn("certified", F.min(F.col("passed").cast("int")).over(by.orderBy("i")) == 1)
    gain = F.col("hits") / F.col("n_bad") - F.col("k") / F.col("n_good")
    best = t.filter(F.col("certified") & (F.col("n_bad") > 0)).withColumn("gain", F.round(gain, 9)).filter("gain > 0").withColumn(
        "r", F.row_number().over(by.orderBy(F.col("gain").desc(), "i"))).filter("r = 1")
    grids = F.array(*[F.struct(F.lit(r).alias("rule"), F.get(F.array(*map(F.lit, g)), F.col("i")).alias("cutoff")) for r, g in rules.items()])
    return best.select("stratum", F.inline(grids))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang",
          risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Counts, ``base_failed``, ``failed_rules`` (array) and ``kept`` per document.

    Null texts have no words and fail the base. A null stratum is a stratum of its own;
    without ``stratum_col`` all documents are one. Strata with too few good labels to certify
    a step apply no rule. Label rows without an id or a quality are ignored; a document with
    several, or a text with several documents, is good if one says so. Repeated documents
    each give a row; an empty table of documents or labels works.
    """
    stratum = F.coalesce(F.concat(F.lit("s"), F.col(stratum_col).cast("string")), F.lit("n")) if stratum_col else F.lit("n")
    measured = cut(measure(docs.select(F.col(id_col).alias("id"), stratum.alias("stratum"), F.md5(text_col).alias("digest"), F.col(text_col).alias("text")),
                           "text", ("id", "stratum", "digest")))
    stats = statistics()
    marks = labels.filter(F.col(id_col).isNotNull() & F.col("quality").isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        (F.max("quality") > 0).alias("good"))
    # a base failure never reaches the rules
    able = measured.withColumn("base_failed", base_failed())
    held = able.filter(~F.col("base_failed")).join(marks, "id").select("stratum", "digest", "good", *[v.alias(k) for k, v in stats.items()])
    held = held.groupBy("stratum", "digest").agg(F.max("good").alias("good"), *[F.first(k).alias(k) for k in stats])  # a text is one trial
    found = cutoffs(held, risk, error).groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    out = able.join(found, "stratum", "left")
    fails = F.array_compact(F.array(*[F.when(v > F.element_at("cutoffs", F.lit(k)), F.lit(k)) for k, v in stats.items()]))
    out = out.withColumn("failed_rules", F.when(F.col("cutoffs").isNull(), F.array().cast("array<string>")).otherwise(fails))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).withColumnRenamed("id", id_col).drop("cutoffs", "stratum", "digest")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def digest(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                         F.array_join("failed_rules", ",").alias("failed_rules"))


def op8(spark, sf_dir: str) -> DataFrame:
    return digest(judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))


def pooled(spark, sf_dir: str) -> DataFrame:
    """The same with one stratum for all languages, whose labels suffice on small tables too."""
    return digest(judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), stratum_col=None))


def _sql(stratum: str) -> str:
    stats = {"symbols": "n_symbols / n_words", "dup_lines": "n_dup_lines / n_lines", "repeats": "n_repeat_words / n_words",
             "upper": "n_upper / word_chars", "exclaims": "n_exclaims / n_words"}
    stat = ", ".join(f"CASE WHEN {x.split(' / ')[1]} > 0 THEN (1000 * {x.split(' / ')[0]}) // {x.split(' / ')[1]} END AS {r}" for r, x in stats.items())
    grid = " UNION ALL ".join(f"SELECT {i} AS i, " + ", ".join(f"{c} AS c_{r}" for r, c in zip(RULES, cs)) for i, cs in enumerate(zip(*RULES.values())))
    hit = " OR ".join(f"coalesce({r} > c_{r}, false)" for r in RULES)
    fails = ", ".join(f"CASE WHEN {r} > c_{r} THEN '{r}' END" for r in RULES)
    return rf"""
WITH w AS (SELECT doc_id, {stratum} AS stratum, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln FROM documents),
tri AS (SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM w)),
rep AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, t) AS n FROM tri) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM rep) GROUP BY doc_id),
c AS (SELECT w.doc_id, stratum, md5(text) AS digest, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(text) - length(translate(text, '{SYMBOLS}', '')) AS n_symbols, len(ln) - len(list_distinct(ln)) AS n_dup_lines,
    coalesce(cov.n, 0) AS n_repeat_words, len(ln) AS n_lines, length(text) - length(translate(text, '{UPPER}', '')) AS n_upper,
    length(text) - length(translate(text, '!', '')) AS n_exclaims FROM w LEFT JOIN cov USING (doc_id)),
m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {stat} FROM c),
h AS (SELECT stratum, digest, bool_or(good) AS good, {", ".join(f"any_value({r}) AS {r}" for r in RULES)} FROM m JOIN
    (SELECT doc_id, max(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) USING (doc_id) WHERE NOT base_failed GROUP BY stratum, digest),
g AS ({grid}),
k AS (SELECT stratum, g.*, count(*) FILTER (good) AS n, count(*) FILTER (NOT good) AS nb,
    count(*) FILTER (good AND ({hit})) AS k, count(*) FILTER (NOT good AND ({hit})) AS hits FROM h, g GROUP BY ALL),
t AS (SELECT *, k < n * {RISK} AND list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(n + 1.0) - lgamma(j + 1.0) - lgamma(n - j + 1.0)
    + j * ln({RISK}) + (n - j) * ln(1 - {RISK})))) <= {ERROR} / (SELECT count(DISTINCT stratum) FROM h) AS passed FROM k),
f AS (SELECT *, min(CAST(passed AS INT)) OVER (PARTITION BY stratum ORDER BY i) = 1 AS certified, round(hits / nb - k / n, 9) AS gain FROM t),
best AS (SELECT * FROM f WHERE certified AND nb > 0 AND gain > 0 QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY gain DESC, i) = 1),
o AS (SELECT m.*, array_to_string(list_filter([{fails}], lambda x: x IS NOT NULL), ',') AS failed_rules FROM m LEFT JOIN best USING (stratum))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM o
"""


OP8_SQL = _sql("coalesce('s' || lang, 'n')")
POOLED_SQL = _sql("'n'")
