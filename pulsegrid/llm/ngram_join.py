"""N-gram Jaccard join (operator 2).

The document by n-gram incidence matrix A is multiplied with its transpose in blocks, only
as far as a pair can still reach the similarity. A pair of sets of sizes a and b links if
100 * overlap >= percent * union, that is if the overlap reaches ``need(a, b)``.

1. Sets are hashed; documents of equal sets are one class from here on.
2. Every n-gram is counted into a sketch of fixed size. It gives all n-grams one order, rare
   ones first. A set's columns are cut to its first ``a - ceil(percent a / 100) + 1`` n-grams:
   linked sets share one of them, whatever the order is.
3. The columns are dealt out by n-gram and multiplied in blocks: where a class stands at place
   i and another at place j, at most min(a - i, b - j) n-grams can still be shared, and pairs
   below need(a, b) are discarded. A column of up to ``SHORT`` classes gives all its pairs, a
   longer one only the pairs with its most central class (the least place).
4. Of a candidate pair the overlap of its first n-grams is counted whole; if what is left of
   one set could not make up the rest, the pair is discarded. The others are verified on
   whole sets and linked ones put into components.
5. What is left of long columns are pairs of different components. These are formed, bounded
   and verified too, and the components closed over all links. So no component is missed, and
   a group of thousands of near copies costs one pair a copy instead of all pairs.
6. Where links are asked for, all pairs inside a component are multiplied, on whole sets and
   in blocks of classes. Only a number of links for each class and block leaves a task, so a
   group's sets are moved once for each of its blocks and its pairs never.

Scale: two passes over the texts make the sets (they are not stored), a third makes those
of classes in candidate pairs. What is broadcast, the sketch and a bit filter of class
ids, has a fixed size. Components are found by alternating large and small stars with a
checkpoint each round.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..workers import ship_by_value
from . import kernels
from .common import cut, read

WORDS, PERCENT = 5, 80
#: Counters of the sketch and places of the bit filter: 4 MB each as sent to the tasks.
SKETCH_BITS = 22
SHORT, ROWS = 8, 1 << 18
CHUNK_BITS = 16
#: Classes and n-grams of a block of step 6, and columns of a dense product.
BLOCK_CLASSES, BLOCK_SHINGLES, DENSE = 2048, 1 << 20, 2048


def need(a, b, percent: int):
    """Least overlap at which sets of sizes a and b link."""
    return -(-percent * (a + b) // (100 + percent))


def sets_of(batch: pa.RecordBatch, place: int, n: int) -> list[np.ndarray]:
    words, at = kernels.word_hashes(*kernels.utf8(batch.column(place)))
    return [kernels.shingles(words[x:y], n) for x, y in zip(at[:-1], at[1:])]


def name_of(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


# --- counts of fixed size over all rows


def chunks(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    for i in range(0, len(counts), 1 << CHUNK_BITS):
        c = counts[i:i + (1 << CHUNK_BITS)]
        if c.any():
            yield i >> CHUNK_BITS, zlib.compress(c.tobytes(), 1)


def gathered(parts: DataFrame, bits: int = SKETCH_BITS) -> np.ndarray:
    """uint8 levels (bits of the count) from the tasks' (chunk, counts); a fixed number of bytes."""
    def add(frames: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << CHUNK_BITS, np.int64)
        for x in frames["counts"]:
            total += np.frombuffer(zlib.decompress(x), np.uint32)
        level = np.where(total > 0, np.log2(np.maximum(total, 1)).astype(np.uint8) + 1, 0).astype(np.uint8)
        return pd.DataFrame({"chunk": [frames["chunk"].iloc[0]], "counts": [zlib.compress(level.tobytes(), 1)]})

    levels = np.zeros(1 << bits, np.uint8)
    for r in parts.select("chunk", "counts").groupBy("chunk").applyInPandas(add, "chunk int, counts binary").collect():
        levels[r.chunk << CHUNK_BITS:(r.chunk + 1) << CHUNK_BITS] = np.frombuffer(zlib.decompress(r.counts), np.uint8)
    return levels


def bit_filter(keys: DataFrame, bits: int = SKETCH_BITS) -> np.ndarray:
    """Which of 2^bits places the long column ``h`` hits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for b in batches:
            counts[place_of(b.column(0).to_numpy(zero_copy_only=False), bits)] = 1
        found = list(chunks(counts))
        if found:
            yield pa.record_batch([pa.array([c for c, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())], ["chunk", "counts"])

    return gathered(keys.select("h").mapInArrow(run, "chunk int, counts binary"), bits) > 0


def place_of(h: np.ndarray, bits: int) -> np.ndarray:
    return (h.astype(np.int64).view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


# --- the passes over the texts


def named(docs: DataFrame, n: int, count: bool) -> DataFrame:
    """(id, n, name) per document and, if asked, the sketch's (chunk, counts) per task."""
    schema = StructType([docs.schema["id"], *StructType.fromDDL("n long, name binary, chunk int, counts binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kind = np.zeros(1 << SKETCH_BITS, np.uint32), None
        for b in kernels.slices(batches):
            kind, sets, m = b.column(0).type, sets_of(b, 1, n), b.num_rows
            if count:
                for s in sets:  # each once in a set, so without repeats
                    counts[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] += 1
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([name_of(s) if len(s) else None for s in sets], pa.binary()),
                                              pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names=schema.names)
        found = list(chunks(counts)) if count and kind is not None else []
        if found:
            m = len(found)
            yield pa.RecordBatch.from_arrays([pa.nulls(m, kind), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.array([c for c, _ in found], pa.int32()),
                                              pa.array([x for _, x in found], pa.binary())], names=schema.names)

    return docs.select("id", "text").mapInArrow(run, schema)


def first_of(s: np.ndarray, level: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """A set's first n-grams in the order of the sketch, and the place of the last of them."""
    rank = (level[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(58)) | (s >> np.uint64(6))
    size = len(s) + percent * len(s) // -100 + 1
    first = np.argpartition(rank, size - 1)[:size] if size < len(s) else np.arange(len(s))
    first = first[np.argsort(rank[first])]
    return s[first].view(np.int64), int(rank[first[-1]] >> np.uint64(1))


def prefixes(docs: DataFrame, levels: np.ndarray, n: int, percent: int) -> DataFrame:
    """(name, n, prefix, last) per document with words: its first n-grams in the order of the
    sketch, and the place of the last of them in that order."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        for b in kernels.slices(batches):
            out = []
            for s in sets_of(b, 0, n):
                if len(s):
                    out.append((name_of(s), len(s), *first_of(s, level, percent)))
            if out:
                yield prefix_rows("name", pa.binary(), out)

    return docs.select("text").mapInArrow(run, "name binary, n int, prefix array<long>, last long")


def prefix_rows(key: str, kind: pa.DataType, out: list[tuple]) -> pa.RecordBatch:
    flat, offsets = np.concatenate([x[2] for x in out]), np.concatenate([[0], np.cumsum([len(x[2]) for x in out])]).astype(np.int32)
    return pa.record_batch([pa.array([x[0] for x in out], kind), pa.array([x[1] for x in out], pa.int32()),
                            pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array([x[3] for x in out], pa.int64())], [key, "n", "prefix", "last"])


def rare_first(sets: DataFrame, percent: int) -> DataFrame:
    """(cid, n, prefix, last) as ``prefixes`` makes them, of (cid, shingles): the order is that
    of a sketch of these sets alone, so that what many of them share comes last."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for b in batches:
            np.add.at(counts, place_of(b.column(0).flatten().to_numpy(zero_copy_only=False), SKETCH_BITS), 1)
        found = list(chunks(counts))
        if found:
            yield pa.record_batch([pa.array([c for c, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())], ["chunk", "counts"])

    shared = sets.sparkSession.sparkContext.broadcast(gathered(sets.select("shingles").mapInArrow(counted, "chunk int, counts binary")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in kernels.slices(batches):
            cid, flat, at = b.column(0).to_pylist(), b.column(1).values.to_numpy(zero_copy_only=False).view(np.uint64), b.column(1).offsets.to_numpy()
            own = [flat[x:y] for x, y in zip(at[:-1], at[1:])]
            yield prefix_rows("cid", pa.int64(), [(c, len(s), *first_of(s, shared.value, percent)) for c, s in zip(cid, own)])

    return sets.select("cid", "shingles").mapInArrow(run, "cid long, n int, prefix array<long>, last long")


def whole_sets(docs: DataFrame, wanted: np.ndarray, n: int) -> DataFrame:
    """(name, shingles) of the documents whose id may be wanted."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in kernels.slices(batches):
            b = b.filter(pa.array(shared.value[place_of(b.column(0).to_numpy(zero_copy_only=False), SKETCH_BITS)]))
            if b.num_rows:
                sets = sets_of(b, 1, n)
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                yield pa.record_batch([pa.array([name_of(s) for s in sets], pa.binary()),
                                       pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view(np.int64)))], ["name", "shingles"])

    return docs.select(F.xxhash64("id").alias("h"), "text").mapInArrow(run, "name binary, shingles array<long>")


# --- the blocked product


def multiply(postings: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b), repeated, and with b null the entries (a, token, n, pos) of long
    columns. Entries come by token and place; a block of rows is multiplied at once, and of a
    column that outlasts a block only its most central class is kept in hand."""
    names = ["a", "b", "token", "n", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((4, 0), np.int64)
        pivot = None  # of a long column under way
        for b in batches:
            held = np.concatenate([held, np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])], axis=1)
            if held.shape[1] >= ROWS:
                last = int(np.flatnonzero(np.diff(held[0], prepend=held[0, 0] - 1))[-1])  # the last column's start
                if last == 0 and held.shape[1] <= SHORT:
                    continue
                done = last or held.shape[1]
                out, pivot = block(held[:, :done], pivot, open_end=not last)
                held = held[:, done:]
                yield from out
        if held.shape[1]:
            yield from block(held, pivot, False)[0]

    def block(x: np.ndarray, pivot, open_end: bool):
        token, cid, n, pos = x
        starts = np.flatnonzero(np.diff(token, prepend=token[0] - 1))
        size = np.diff(np.append(starts, len(token)))
        centre = np.repeat(starts, size)
        long = np.repeat(size > SHORT, size)
        going = pivot is not None and pivot[0] == token[0]
        if going or (open_end and len(starts) == 1):
            long[:size[0]] = True
        found = []

        def pairs(ca, na, pa_, cb, nb, pb):
            ok = (np.minimum(na - pa_, nb - pb) >= need(na, nb, percent)) & (ca != cb)
            if ok.any():
                found.append(np.unique(np.stack([np.minimum(ca, cb)[ok], np.maximum(ca, cb)[ok]]), axis=1))

        for d in range(1, SHORT):
            i = np.flatnonzero((token[:-d] == token[d:]) & ~long[:-d]) if d < len(token) else np.zeros(0, np.int64)
            if len(i):
                pairs(cid[i], n[i], pos[i], cid[i + d], n[i + d], pos[i + d])
        i = np.flatnonzero(long)
        if len(i):
            c, m, p = cid[centre[i]].copy(), n[centre[i]].copy(), pos[centre[i]].copy()
            if going:
                own = i < size[0]
                c[own], m[own], p[own] = pivot[1:]
            pairs(c, m, p, cid[i], n[i], pos[i])
        out = []
        if found:
            f = np.concatenate(found, axis=1)
            k = f.shape[1]
            out.append(pa.record_batch([pa.array(f[0]), pa.array(f[1]), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32())], names))
        if len(i):
            out.append(pa.record_batch([pa.array(cid[i]), pa.nulls(len(i), pa.int64()), pa.array(token[i]), pa.array(n[i].astype(np.int32)), pa.array(pos[i].astype(np.int32))], names))
        if open_end:
            pivot = pivot if going and len(starts) == 1 else (token[-1], cid[starts[-1]], n[starts[-1]], pos[starts[-1]])
        else:
            pivot = None
        return out, pivot

    p = postings.select("token", "cid", "n", "pos").repartition("token").sortWithinPartitions("token", "pos", "n", "cid")
    return p.mapInArrow(run, "a long, b long, token long, n int, pos int")


def bounded(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that can still link, the overlap of their first n-grams counted whole.

    Of two sets, let x be the one whose first n-grams end earlier in the order. What x has of
    them beyond those counted is not in the other set, so that at most the n-grams of x after
    its first ones can be added to the count.
    """
    side = lambda c, own: prefixes.select(F.col("cid").alias(own), *[F.col(x).alias(f"{c}_{x}") for x in ("n", "prefix", "last")])
    j = pairs.join(side("x", "a"), "a").join(side("y", "b"), "b")
    after = F.when(F.col("x_last") <= F.col("y_last"), F.col("x_n") - F.size("x_prefix")).otherwise(F.col("y_n") - F.size("y_prefix"))
    most = F.size(F.array_intersect("x_prefix", "y_prefix")) + after
    return j.filter(most * (100 + percent) >= (F.col("x_n") + F.col("y_n")) * percent).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets."""
    x = pairs.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("x")), "a")
    y = x.join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("y")), "b")
    both, sizes = F.size(F.array_intersect("x", "y")), F.size("x") + F.size("y")
    return y.filter(both * (100 + percent) >= sizes * percent).select("a", "b")


def across(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs (a, b) of different components."""
    side = lambda c: comp.select(F.col("node").alias(c), F.col("comp").alias(f"{c}_comp"))
    j = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return j.filter(F.coalesce("a_comp", "a") != F.coalesce("b_comp", "b")).select("a", "b")


def unsettled(entries: DataFrame, comp: DataFrame) -> DataFrame:
    """(cid) of the classes that stand in a long column of more than one component."""
    e = entries.join(comp, F.col("a") == F.col("node"), "left").select("token", F.col("a").alias("cid"), F.coalesce("comp", "a").alias("comp"))
    open_ = e.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("token")
    return e.join(open_, "token").select("cid").distinct()


def left_over(entries: DataFrame, comp: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that meet in a long column, can still link and
    were not tried. In each column only classes outside its largest component are joined."""
    e = entries.join(comp, F.col("a") == F.col("node"), "left").select("token", F.col("a").alias("cid"), "n", "pos", F.coalesce("comp", "a").alias("comp"))
    each = e.groupBy("token", "comp").agg(F.count("*").alias("k"))
    most = each.groupBy("token").agg(F.max(F.struct("k", "comp")).alias("m"), F.count("*").alias("comps")).filter("comps > 1")
    e = cut(e.join(most.select("token", F.col("m.comp").alias("main")), "token"))
    x = e.filter("comp <> main").select("token", *[F.col(c).alias(f"x_{c}") for c in ("cid", "n", "pos", "comp")])
    j = x.join(e, "token").filter("x_comp <> comp")
    least = F.expr(f"({percent} * (x_n + n) + {99 + percent}) div {100 + percent}")
    j = j.filter(F.least(F.col("x_n") - F.col("x_pos"), F.col("n") - F.col("pos")) >= least)
    j = j.select(F.least("x_cid", "cid").alias("a"), F.greatest("x_cid", "cid").alias("b")).distinct()
    return j.join(tried, ["a", "b"], "left_anti")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of the nodes in ``edges`` (a, b), comp the least node reachable: large and
    small stars in turn until every node has one edge to a node that has none."""
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    while True:
        both = e.filter("u <> v").select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low.hint("merge"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(low.hint("merge"), "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), "m")
        # a star's centre has an edge to itself, which is left out of the next round
        e = cut(star.select(F.inline(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("m").alias("u"), F.col("m").alias("v"))))).distinct())
        ends = e.filter("u <> v").select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("low")).filter("up > 1 or up = 1 and low = 0").isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("comp"))


def merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` of all links so far, from those before and the new links (a, b)."""
    return comp if links.isEmpty() else components(comp.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionByName(links))


def overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of each set of ``x`` with each of ``y``. N-grams that
    stand in many of both are multiplied as a dense matrix, the others pair by pair."""
    token, at = np.unique(np.concatenate([*x, *y]), return_inverse=True)
    rows, cols = np.repeat(np.arange(len(x)), [len(s) for s in x]), np.repeat(np.arange(len(y)), [len(s) for s in y])
    ax, ay = at[:len(rows)], at[len(rows):]
    cx, cy = np.bincount(ax, minlength=len(token)), np.bincount(ay, minlength=len(token))
    dense = cx * cy * 128 > len(x) * len(y)
    out = np.zeros(len(x) * len(y), np.int64)
    column = np.cumsum(dense) - 1
    for start in range(0, int(dense.sum()), DENSE):
        sides = []
        for m, own, a in ((len(x), rows, ax), (len(y), cols, ay)):
            i = np.flatnonzero(dense[a] & (column[a] >= start) & (column[a] < start + DENSE))
            side = np.zeros((m, DENSE), np.float32)
            side[own[i], column[a[i]] - start] = 1
            sides.append(side)
        out += (sides[0] @ sides[1].T).astype(np.int64).ravel()
    order = np.argsort(ay, kind="stable")
    begin = np.cumsum(cy) - cy
    i = np.flatnonzero(~dense[ax] & (cy[ax] > 0))
    ends = np.cumsum(cy[ax[i]])
    a = 0
    while a < len(i):  # up to 2^22 pairs at once, or one entry's
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + (1 << 22), "right")))
        k = cy[ax[i[a:b]]]
        place = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) + np.repeat(begin[ax[i[a:b]]], k)
        out += np.bincount(np.repeat(rows[i[a:b]], k) * len(y) + cols[order[place]], minlength=len(out))
        a = b
    return out.reshape(len(x), len(y))


def degrees(classes: DataFrame, sets: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """(cid, links_found): with how many classes each class of ``comp`` (node, comp) links,
    from ``classes`` (cid, n) and ``sets`` (cid, shingles). Two classes alone are one link."""
    c = comp.select(F.col("node").alias("cid"), "comp")
    size = c.join(classes.select("cid", "n"), "cid").groupBy("comp").agg(F.count("*").alias("k"), F.sum("n").alias("m"))
    c = c.join(size, "comp")
    parts = F.greatest(F.ceil(F.col("k") / BLOCK_CLASSES), F.ceil(F.col("m") / BLOCK_SHINGLES)).cast("int")
    own = F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int")
    many = c.filter("k > 2").withColumn("parts", parts).withColumn("own", own).join(sets, "cid")
    many = many.select("comp", "cid", "shingles", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    many = many.select("comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "cid", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides = None, ([], [])
        for b in batches:
            keys = list(zip(*(b.column(k).to_pylist() for k in range(3))))
            side, cid, sets = b.column(3).to_pylist(), b.column(4).to_pylist(), b.column(5)
            flat, at = sets.values.to_numpy(zero_copy_only=False), sets.offsets.to_numpy()
            for r, k in enumerate(keys):
                if k != key:
                    if key:
                        yield count(sides, key[1] == key[2])
                    key, sides = k, ([], [])
                sides[side[r]].append((cid[r], flat[at[r]:at[r + 1]].copy()))
        if key:
            yield count(sides, key[1] == key[2])

    def count(sides, same: bool) -> pa.RecordBatch:
        x, y = sides[0], sides[0] if same else sides[1]
        if not x or not y:
            return pa.record_batch([pa.array([], pa.int64()), pa.array([], pa.int64())], ["cid", "k"])
        sx, sy = [s for _, s in x], [s for _, s in y]
        nx, ny = np.array([len(s) for s in sx]), np.array([len(s) for s in sy])
        found = overlaps(sx, sy) >= need(nx[:, None], ny[None], percent)
        if same:
            np.fill_diagonal(found, False)
            return pa.record_batch([pa.array([c for c, _ in x], pa.int64()), pa.array(found.sum(axis=1), pa.int64())], ["cid", "k"])
        return pa.record_batch([pa.array([c for c, _ in (*x, *y)], pa.int64()), pa.array(np.concatenate([found.sum(axis=1), found.sum(axis=0)]), pa.int64())], ["cid", "k"])

    many = many.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j", "side").mapInArrow(run, "cid long, k long")
    return many.groupBy("cid").agg(F.sum("k").alias("links_found")).unionByName(c.filter("k = 2").select("cid", F.lit(1).cast("long").alias("links_found")))


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, percent: int = PERCENT, count: bool = True) -> DataFrame:
    """(id, n_shingles, name, component, links_found, component_id) per document.

    ``name`` tells the document's set (null without words: an empty set, linked with nothing)
    and ``component`` is a number for its component (null with the name);
    ``links_found`` is the number of classes that link with its class (not there without
    ``count``, which spares step 6); ``component_id`` is the least id reachable
    by links. Null ids are never least unless all are null; equal ids of different texts are
    different documents. Empty tables give empty results. Other columns are not read.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    first = cut(named(d, n, True))
    rows = first.filter("chunk is null").select("id", "n", "name")
    levels = gathered(first.filter("chunk is not null"))
    p = cut(prefixes(d, levels, n, percent).dropDuplicates(["name"])).withColumn("cid", F.monotonically_increasing_id())
    entries = p.select("cid", "n", F.posexplode("prefix").alias("pos", "token"))
    return closed(d, rows, p, entries, lambda pairs: bounded(pairs, p, percent), n, percent, count).withColumnRenamed("id", id_col)


def closed(d: DataFrame, rows: DataFrame, classes: DataFrame, entries: DataFrame, bound, n: int, percent: int, count: bool = True, rare: bool = False) -> DataFrame:
    """Steps 3 to 6 for the entries (token, cid, n, pos) of any candidate scheme: pairs from
    the columns, verified on the sets of ``d`` (id, text), closed to components over
    ``rows`` (id, n, name). ``classes``: (cid, name, n), with their least id if it is known;
    ``bound`` may discard pairs ahead.

    ``rare`` is for schemes whose columns also hold many classes that don't link: the classes
    of unsettled long columns then go through steps 2 to 5 as an n-gram join of their own,
    which finds all their links, instead of being paired within the columns."""
    made = cut(multiply(entries, percent))
    pairs = cut(made.filter("b is not null").select("a", "b").distinct())
    classes = classes.select("name", "n", "cid", *["id"] * ("id" in classes.columns))
    if "id" not in classes.columns:
        classes = classes.join(rows.filter("name is not null").groupBy("name").agg(F.min("id").alias("id")), "name")

    def sets_for(cids: DataFrame) -> DataFrame:
        wanted = classes.select("name", "cid", F.xxhash64("id").alias("h")).join(cids, "cid")
        return cut(whole_sets(d, bit_filter(wanted), n).dropDuplicates(["name"]).join(wanted, "name").select("cid", "shingles"))

    def linked(some: DataFrame) -> tuple[DataFrame, DataFrame]:
        able = cut(bound(some))
        sets = sets_for(able.select(F.explode(F.array("a", "b")).alias("cid")).distinct())
        return cut(verified(able, sets, percent)), sets

    def settled(sets: DataFrame, comp: DataFrame, dense: DataFrame) -> tuple[DataFrame, DataFrame]:
        sets = sets.unionByName(sets_for(dense.join(sets.select("cid"), "cid", "left_anti")))
        p = cut(rare_first(sets.join(dense, "cid"), percent))
        made = cut(multiply(p.select("cid", "n", F.posexplode("prefix").alias("pos", "token")), percent))
        pairs = cut(across(made.filter("b is not null").select("a", "b").distinct(), comp))
        comp = merged(comp, cut(verified(bounded(pairs, p, percent), sets, percent)))
        more = cut(left_over(made.filter("b is null").select("a", "token", "n", "pos"), comp, pairs, percent))
        if not more.isEmpty():
            comp = merged(comp, cut(verified(bounded(more, p, percent), sets, percent)))
        return sets, comp

    links, sets = linked(pairs)
    comp = components(links)
    long = made.filter("b is null").select("a", "token", "n", "pos")
    more = cut(unsettled(long, comp) if rare else left_over(long, comp, pairs, percent))
    if rare and not more.isEmpty():
        sets, comp = settled(sets, comp, more)
    elif not more.isEmpty():
        new, new_sets = linked(more)
        sets = sets.unionByName(new_sets.join(sets.select("cid"), "cid", "left_anti"))
        comp = merged(comp, new)
    c = classes.select("name", "cid", "id").join(comp.withColumnRenamed("node", "cid"), "cid", "left")
    c = c.withColumn("comp", F.coalesce("comp", "cid"))
    c = c.join(c.groupBy("comp").agg(F.min("id").alias("component_id")), "comp")
    if count:
        c = c.join(degrees(classes, sets, comp, percent), "cid", "left").withColumn("links_found", F.coalesce("links_found", F.lit(0)))
    c = c.select("name", "component_id", *["links_found"] * count, F.col("comp").alias("component"))
    out = rows.join(c, "name", "left")
    return out.select("id", F.col("n").alias("n_shingles"), "name", "component", *[F.coalesce("links_found", F.lit(0)).alias("links_found")] * count,
                      F.when(F.col("name").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each component with all its columns: the row of the least id (nulls
    last), of equal ids the one of the least set name, of rows equal in both the one of the
    least text. Documents without words are linked with nothing and all stay."""
    found = link(docs, id_col, text_col, n, percent, count=False).filter("name is not null")
    best = found.groupBy("component").agg(F.min(F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), "name")).alias("b"))
    best = best.select(F.col("b.id").alias("best_id"), F.col("b.name").alias("best_name"))
    t = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = StructType([t.schema["row"], t.schema["id"], *StructType.fromDDL("name binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in kernels.slices(batches):
            names = pa.array([name_of(s) if len(s) else None for s in sets_of(b, 2, n)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), names], names=schema.names)

    # documents without words get a key of their own, so that they don't meet in one task
    t = t.mapInArrow(run, schema).withColumn("key", F.coalesce("name", F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")).cast("binary")))
    t = t.join(best, (F.col("key") == F.col("best_name")) & F.col("id").eqNullSafe(F.col("best_id")), "left")
    nth = F.row_number().over(Window.partitionBy("key", "id").orderBy(F.col(f"row.`{text_col}`")))
    t = t.filter("name is null or best_name is not null").withColumn("nth", nth)
    return t.filter("name is null or nth = 1").select("row.*")


def op2(spark, sf_dir: str) -> DataFrame:
    return link(read(spark, sf_dir, "documents"), n=4, percent=85).select("doc_id", "n_shingles", "component_id", "links_found")


ship_by_value(__name__)
