r"""Secret scans with multipart credential linking (operator 6), DataFrame functions only.

Strong kinds are reported wherever they match: ``assign`` (a secret's name, a sign and a
value of 12 or more characters), ``access`` (access key identifiers) and ``hex`` (16 or
more hex digits). Weak parts say little alone: ``login`` (a user, account or client name
given with a sign), ``blob`` (a run of 20 or more letters and digits with both cases and a
digit) and ``endpoint`` (a URL of a service). Identifiers (``access``, ``login``), secrets
(``assign``, ``hex``, ``blob``) and endpoints are joined on overlapping scopes, and a weak
part is reported only with its complement: a login with a secret, a blob with an
identifier or an endpoint, an endpoint with an identifier and a secret. Two parts share a
scope if they start within ``SCOPE`` code points of each other in one text.

Scale: a text is read once; matches are found inside its row and only their lengths go
on, cut with a checkpoint. Positions are running sums in a window per text and kind. The
interval join is an equi-join on (text, bin) of parts with the first and last start of
each role in their own and the two next bins: at most three rows a part and role, however
many parts meet in a scope, and no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, let, read

SCOPE = 400
#: Kinds in the order in which they are listed; the first three are strong.
KINDS = ("assign", "access", "hex", "login", "blob", "endpoint")
ROLES = ("secret", "identifier", "secret", "identifier", "secret", "endpoint")


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _given(*names: str) -> str:
    return "(?:" + "|".join(map(_any_case, names)) + ")[\"']?\\x20*[:=]\\x20*[\"']?"


ASSIGN = _given("password", "passwd", "secret", "token", "api_?key") + "([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
LOGIN = _given("username", "user_?id", "user", "login", "account", "client_?id") + "([A-Za-z0-9._@+-]+)"
BLOB = "[A-Za-z0-9+/_-]{20,}"
ENDPOINT = "[A-Za-z][A-Za-z0-9+.-]*://[A-Za-z0-9][^\\x20\\x09-\\x0D\"'<>]+"


def matches(text: Column, kind: int, pattern: str, may: Column, group: int = 0, least: int = 0, also: tuple[str, ...] = ()) -> Column:
    """Array of (kind, gap, length, ok) of the matches of ``pattern``: the code points
    between a match and the one before, its length, and whether it counts: its ``group``
    has ``least`` characters and it holds each pattern in ``also``. ``may``: false where no
    match is possible."""
    def found(whole: Column, part: Column) -> Column:
        def at(pieces: Column) -> Column:
            def one(m, i):
                ok = F.length(F.get(part, i)) >= least
                for p in also:
                    ok = ok & F.regexp_like(m, F.lit(p))
                return F.struct(F.lit(kind).alias("kind"), F.length(F.get(pieces, i)).cast("long").alias("gap"), F.length(m).cast("long").alias("length"), ok.alias("ok"))
            return F.transform(whole, one)
        return let(F.split(text, pattern, -1), at)

    none = F.array().cast("array<struct<kind:int,gap:bigint,length:bigint,ok:boolean>>")
    get = lambda g: F.regexp_extract_all(text, F.lit(pattern), F.lit(g))
    hits = let(get(0), lambda m: F.when(F.size(m) == 0, none).otherwise(found(m, m) if not group else let(get(group), lambda g: found(m, g))))
    return F.when(may, hits).otherwise(none)


def parts(text: Column) -> Column:
    sign = F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))
    return F.concat(
        matches(text, 0, ASSIGN, sign, group=1, least=12),
        matches(text, 1, ACCESS, F.contains(text, F.lit("AKIA"))),
        matches(text, 2, HEX, F.lit(True)),
        matches(text, 3, LOGIN, sign, group=1, least=3),
        matches(text, 4, BLOB, F.lit(True), also=("[a-z]", "[A-Z]", "[0-9]")),
        matches(text, 5, ENDPOINT, F.contains(text, F.lit("://"))),
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(id, spans) per document: an array of (start, kind, end) by start and kind, in code
    points, end exclusive, kind a place in ``KINDS``.

    A null or empty text has no spans. Each row of the input is a text of its own, also
    where ids or rows repeat or the id is null; an empty table gives an empty result. Only
    the two named columns are read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = cut(docs.select(F.col(id_col).alias("id"), parts(text).alias("parts"))).withColumn("row", F.monotonically_increasing_id())
    spans = located(found.select("row", "parts"))
    strong = spans.filter("kind < 3")
    kept = strong.unionByName(linked(spans, scope))
    kept = kept.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    return found.select("row", "id").join(kept, "row", "left").select(
        F.col("id").alias(id_col), F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")).alias("spans"))


def located(found: DataFrame) -> DataFrame:
    """(row, kind, start, end) of the parts that count, weak ones that overlap a strong one left out."""
    p = found.select("row", F.posexplode("parts").alias("i", "p")).select("row", "i", "p.*")
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p = p.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(upto)).filter("ok")
    p = p.select("row", "kind", (F.col("end") - F.col("length")).alias("start"), "end")
    own = Window.partitionBy("row").orderBy("start", "kind")
    last = F.max(F.when(F.col("kind") < 3, F.col("end"))).over(own.rowsBetween(Window.unboundedPreceding, -1))
    following = F.min(F.when(F.col("kind") < 3, F.col("start"))).over(own.rowsBetween(1, Window.unboundedFollowing))
    clash = F.coalesce(last > F.col("start"), F.lit(False)) | F.coalesce(following < F.col("end"), F.lit(False))
    return p.withColumn("clash", clash).filter("kind < 3 or not clash").drop("clash")


def linked(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts whose complements start within ``scope``."""
    role = F.element_at(F.array(*map(F.lit, ROLES)), F.col("kind") + 1)
    s = spans.withColumn("role", role).withColumn("bin", F.floor(F.col("start") / scope))
    near = s.groupBy("row", "bin", "role").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    near = near.select("row", "role", "first", "last", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin"))
    weak = s.filter("kind >= 3").select("row", "kind", "start", "end", "bin")
    j = weak.join(near.withColumnRenamed("role", "other"), ["row", "bin"])
    j = j.filter((F.col("first") <= F.col("start") + scope) & (F.col("last") >= F.col("start") - scope))
    has = lambda r: F.max((F.col("other") == r).cast("int")) == 1
    j = j.groupBy("row", "kind", "start", "end").agg(has("identifier").alias("i"), has("secret").alias("s"), has("endpoint").alias("e"))
    ok = F.when(F.col("kind") == 3, F.col("s")).when(F.col("kind") == 4, F.col("i") | F.col("e")).otherwise(F.col("i") & F.col("s"))
    return j.filter(ok).select("row", "kind", "start", "end")


def op6(spark, sf_dir: str) -> DataFrame:
    names = F.array(*map(F.lit, KINDS))
    say = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda c: F.array_join(F.transform(c, say), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return scan(read(spark, sf_dir, "documents")).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _sql() -> str:
    q = lambda p: p.replace("'", "''")
    pats = ((ASSIGN, "length(regexp_extract(m, '{p}', 1)) >= 12"), (ACCESS, "true"), (HEX, "true"), (LOGIN, "length(regexp_extract(m, '{p}', 1)) >= 3"),
            (BLOB, "regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')"), (ENDPOINT, "true"))
    each = " UNION ALL ".join(
        f"SELECT doc_id, kind, i, m, gap, {ok.replace('{p}', q(p))} AS ok FROM (SELECT doc_id, {k} AS kind, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS m, "
        f"unnest(y[1:len(x)]) AS gap FROM (SELECT doc_id, regexp_extract_all(text, '{q(p)}') AS x, string_split_regex(text, '{q(p)}') AS y FROM documents WHERE text IS NOT NULL))"
        for k, (p, ok) in enumerate(pats))
    near = lambda r: f"EXISTS (SELECT 1 FROM v o WHERE o.doc_id = v.doc_id AND o.role = '{r}' AND abs(o.s - v.s) <= {SCOPE})"
    role = " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(ROLES))
    name = " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(KINDS))
    return f"""
WITH p AS ({each}),
e AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS e FROM p),
u AS (SELECT doc_id, kind, CAST(e - length(m) AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM e WHERE ok),
v AS (SELECT u.*, CASE kind {role} END AS role FROM u WHERE kind < 3 OR NOT EXISTS
  (SELECT 1 FROM u b WHERE b.kind < 3 AND b.doc_id = u.doc_id AND b.s < u.e AND b.e > u.s)),
k AS (SELECT doc_id, kind, s, CASE kind {name} END || ':' || s || ':' || e AS t FROM v WHERE kind < 3 OR (kind = 3 AND {near('secret')})
  OR (kind = 4 AND ({near('identifier')} OR {near('endpoint')})) OR (kind = 5 AND {near('identifier')} AND {near('secret')})),
a AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  string_agg(t, ',' ORDER BY s, kind) FILTER (kind < 3) AS base, string_agg(t, ',' ORDER BY s, kind) AS spans FROM k GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents LEFT JOIN a USING (doc_id)
"""


OP6_SQL = _sql()
