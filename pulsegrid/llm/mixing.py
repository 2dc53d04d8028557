"""Mixing sources to target weights with a time-varying curriculum (operator 1).

Every source has a weight schedule: a piecewise-linear function of training time in
[0, 1]. Its integral is the source's share of the budget; shares stop at ``max_repeat``
times the source's size and the excess is poured over the others by weight. Inside a
source, documents stand in a seeded order; a document's place in that order is a place
in the source's cumulative demand, and inverting the integral of the schedule turns it
into a training position. Range-sorting by position gives the training order.

Scale: only (source, bucket) totals are aggregated ahead, with partial sums in the map
tasks. A source is cut into ``BUCKETS`` pieces of its seeded order, so a source with a
third of all rows is spread over that many window partitions; running totals inside a
bucket stream. The table of sources (one row each) is the only thing that is ordered as
a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, WS, let, read

#: Pieces of a source's order: the first three hex digits of the order key.
BUCKET_DIGITS = 3
WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
#: Weight over training time by the source's place in the cycle of weights, as (time,
#: factor) knots; each has the mean 1, so the integral of a source's weight is its weight.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (1.0, 1.5)),
)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def invert(schedule: tuple[tuple[float, float], ...], share: Column) -> Column:
    """The time at which the integral of ``schedule`` has reached ``share`` of its whole."""
    segments, area = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        segments.append((t0, w0, (w1 - w0) / (t1 - t0), area))
        area += (w0 + w1) / 2 * (t1 - t0)
    if not area > 0:
        raise ValueError("a schedule needs a positive integral")
    demand, out = share * F.lit(area), None
    for t0, w0, slope, before in segments:
        d = demand - F.lit(before)
        at = F.lit(t0) + F.lit(2.0) * d / (F.lit(w0) + F.sqrt(F.lit(w0 * w0) + F.lit(2.0 * slope) * d))
        out = at if out is None else F.when(demand >= before, at).otherwise(out)
    return F.when(share > 0, out).otherwise(F.lit(schedule[0][0]))


def targets(totals: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, sk, source_size) -> the same with place (in the cycle of weights) and target.

    Filling by weight with a ceiling: in the order of ceiling over weight, a source is at
    its ceiling if the level, which the sources from it on would get, reaches it. Levels
    rise up to the first source below its ceiling and fall after it, so the common level
    is the largest.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    t = totals.withColumn("place", ((F.row_number().over(by_name) - 1) % len(weights)).cast("int"))
    t = t.withColumn("w", F.element_at(cycle, F.col("place") + 1).cast("long"))
    t = t.withColumn("cap", F.col("source_size") * max_repeat)
    by_ratio = Window.orderBy(F.col("cap").cast("double") / F.col("w"), F.col("source").asc_nulls_last())
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                     .cast("double") / F.sum("w").over(after))
    free = F.col("cap").cast("double") / F.col("w") > F.col("level")
    t = t.withColumn("common", F.max(F.when(free, F.col("level"))).over(everything))
    t = t.withColumn("target", F.least(F.col("cap").cast("double"), F.coalesce(F.col("common") * F.col("w"), F.col("cap").cast("double"))))
    return t.select("sk", "source_size", "place", "target")


def assign(docs: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text",
           source_col: str = "source", weights=WEIGHTS, max_repeat: int = MAX_REPEAT, schedules=SCHEDULES,
           seed: int = 17) -> DataFrame:
    """Each document's part of the mix: a struct ``row`` of the columns in ``keep`` (all by
    default, so names in the input never clash with names made here), ``size``,
    ``source_size``, ``target``, ``start`` (words of its source before it in the seeded
    order), ``taken`` (words taken, repeats counted), ``position`` of its first use (null
    if the mix never reaches it).

    A null text has size 0 and is never taken; a null source is a source of its own, last
    in order; rows with equal id and text are separate documents. Sources of size 0 get
    target 0. An empty table gives an empty result. The last document of a source is cut
    where its target is reached, so that taken words add up to the target's whole part.
    """
    keep = docs.columns if keep is None else keep
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n")).alias("sk"),
        key.alias("key"), n_words(F.col(text_col)).alias("size"),
    ).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    parts = sized.groupBy("sk", "source", "bucket").agg(F.sum("size").alias("part"))
    whole = Window.partitionBy("sk")
    offsets = parts.withColumn("ahead", F.coalesce(F.sum("part").over(
        whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    t = targets(parts.groupBy("sk", "source").agg(F.sum("part").alias("source_size")), weights, max_repeat)
    offsets = offsets.select("sk", "bucket", "ahead").join(t, "sk")
    inside = Window.partitionBy("sk", "bucket").orderBy("key", "size")
    out = sized.drop("source").withColumn("inner", F.coalesce(F.sum("size").over(
        inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = out.join(offsets, ["sk", "bucket"]).withColumn("start", F.col("ahead") + F.col("inner"))
    goal = F.floor("target")
    rest = F.greatest(F.lit(0), F.least(F.col("size"), F.pmod(goal, F.col("source_size")) - F.col("start")))
    taken = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size") * F.col("size") + rest).otherwise(F.lit(0))
    out = out.withColumn("taken", taken.cast("long"))
    return out.withColumn("position", F.when(F.col("taken") > 0, position(F.col("start"), schedules))).select(
        "row", "size", "source_size", "target", "start", "taken", "place", "position")


def position(start: Column, schedules=SCHEDULES) -> Column:
    """Training position of the word ``start`` of a source's demand (columns place, target)."""
    share, out = start.cast("double") / F.floor("target").cast("double"), None
    for i, s in enumerate(schedules):
        out = invert(s, share) if out is None else F.when(F.col("place") % len(schedules) == i, invert(s, share)).otherwise(out)
    return out


def first_words(text: Column, k: Column) -> Column:
    """The text up to the end of its k-th word, white space before and between kept."""
    def at(p: Column) -> Column:
        n = k.cast("int") + F.when(F.element_at(p, 1) == "", 1).otherwise(0)
        size = lambda a, m: F.aggregate(F.slice(a, 1, m), F.lit(0), lambda x, w: x + F.length(w))
        gaps = F.regexp_extract_all(text, F.lit(WS), F.lit(0))
        return F.substring(text, F.lit(1), size(p, n) + size(gaps, F.greatest(n - 1, F.lit(0))))
    return let(F.split(text, WS, -1), at)


def mix(docs: DataFrame, text_col: str = "text", schedules=SCHEDULES, whole: bool = False, **kw) -> DataFrame:
    """The mix as documents in training order: the input's columns, a row for each use of a
    document, range-sorted by position. The use at which a source reaches its target keeps
    only the words that still fit; with ``whole`` no text is cut: that use is taken if at
    least half of its words fit and left otherwise, whichever comes nearer to the target."""
    a = assign(docs, text_col=text_col, schedules=schedules, **kw)
    goal = F.floor("target")
    uses = F.when(F.col("taken") > 0, F.sequence(F.lit(0), F.expr("(floor(target) - start - 1) div source_size").cast("int"))).otherwise(
        F.array().cast("array<int>"))
    u = a.select("*", F.explode(uses).alias("use")).withColumn("at", F.col("start") + F.col("use") * F.col("source_size"))
    u = u.withColumn("position", position(F.col("at"), schedules)).withColumn("fits", goal - F.col("at"))
    text = F.when(F.col("fits") < F.col("size"), first_words(F.col(f"row.`{text_col}`"), F.col("fits"))).otherwise(F.col(f"row.`{text_col}`"))
    u = u.filter(F.col("size") > 0)
    if whole:
        return u.filter(F.col("fits") * 2 >= F.col("size")).orderBy("position", F.xxhash64("row")).select("row.*")
    u = u.withColumn("row", F.col("row").withField(f"`{text_col}`", text))
    if "n_chars" in docs.columns:
        u = u.withColumn("row", F.col("row").withField("n_chars", F.length(F.col(f"row.`{text_col}`")).cast(docs.schema["n_chars"].dataType)))
    return u.orderBy("position", F.xxhash64("row")).select("row.*")


def op1(spark, sf_dir: str) -> DataFrame:
    mixed = assign(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.orderBy(F.col("position").asc_nulls_last(), F.xxhash64("row")).select(
        "row.doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"))


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS place, source_size * 3 AS cap FROM s),
r AS (SELECT *, place + 1 AS w, CAST(cap AS DOUBLE) / (place + 1) AS ratio FROM w),
l AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
      / sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
c AS (SELECT *, max(CASE WHEN ratio > level THEN level END) OVER () AS common FROM l),
t AS (SELECT source, source_size, place, least(CAST(cap AS DOUBLE), coalesce(common * w, CAST(cap AS DOUBLE))) AS target FROM c),
d AS (SELECT sized.doc_id, sized.size, t.*, CAST(floor(t.target) AS BIGINT) AS goal,
        coalesce(sum(size) OVER (PARTITION BY t.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM sized JOIN t ON sized.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, CASE WHEN source_size > 0 THEN (goal // source_size) * size + greatest(0, least(size, goal % source_size - start)) ELSE 0 END AS taken FROM d),
p AS (SELECT *, CAST(start AS DOUBLE) / CAST(goal AS DOUBLE) AS u, [1.5, 1.0, 0.5][place + 1] AS w0, [-1.0, 0.0, 1.0][place + 1] AS slope FROM k)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(taken AS BIGINT) AS taken,
  round(CASE WHEN taken > 0 THEN CASE WHEN u > 0 THEN 2.0 * u / (w0 + sqrt(w0 * w0 + 2.0 * slope * u)) ELSE 0.0 END END, 9) AS position
FROM p
"""
