"""MinHash document fingerprints (operator 4).

A text's set is its distinct word shingles (five words by default, letters A-Z as a-z). A
fingerprint keeps the last 8 bits of ``PERMUTATIONS`` minima over universal hashes of the
set, computed for a whole batch at once in numpy. The share of equal places, less what
chance adds, estimates the sets' Jaccard similarity. For near duplicates, bands of a signature are
joined in Spark and candidate pairs verified by the Jaccard similarity of their sets.

Scale: fingerprints are made in a pass without a shuffle; only they and ids are moved.
``near_duplicates`` folds equal sets into one class; a band key shared by a third of all
rows makes a pair per class and not all pairs, and sets are moved only for the classes
that stand in a candidate pair or in such a key of several components. The latter are mostly
texts that share passages but don't link: their further links are sought by rare n-grams.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..workers import ship_by_value
from . import kernels, ngram_join
from .common import cut, read

PERMUTATIONS, WORDS = 128, 5
#: Share of the threshold that the fingerprints' likeness of a candidate pair must reach.
LEAST = 0.6875
#: Texts hashed at once: shingles times permutations that are held in memory.
CHUNK = 1 << 14
_rng = np.random.default_rng(7)
MULTIPLY = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def signatures(column: pa.Array, n: int = WORDS) -> np.ndarray:
    """The last bytes of the minima, a row of ``PERMUTATIONS`` for each text (all ones without a word)."""
    raw, offsets = kernels.utf8(column)
    words, at = kernels.word_hashes(raw, offsets)
    return signatures_of(words, at, n).astype(np.uint8)


def signatures_of(words: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    out = np.full((len(at) - 1, PERMUTATIONS), 0xFFFFFFFF, np.uint32)
    i = 0
    while i < len(at) - 1:
        # texts together up to CHUNK words; a longer text in stretches of its own
        j = max(i + 1, int(np.searchsorted(at, at[i] + CHUNK, "right")) - 1)
        for a in range(int(at[i]), max(int(at[j]), int(at[i]) + 1), CHUNK):
            b = min(a + CHUNK, int(at[j]))
            if b > a:
                minima(words, at, i, j, a, b, n, out)
        i = j
    return out


def minima(words, at, i, j, a, b, n, out) -> None:
    """Lower ``out[i:j]`` to the hashes of the shingles that begin in words a to b."""
    stop = np.repeat(at[i + 1:j + 1], np.minimum(at[i + 1:j + 1], b).clip(a) - np.maximum(at[i:j], a).clip(None, b))
    start = np.repeat(at[i:j], np.minimum(at[i + 1:j + 1], b).clip(a) - np.maximum(at[i:j], a).clip(None, b))
    place = np.arange(a, b)
    size = np.minimum(n, stop - start)
    begins = np.flatnonzero((place + size <= stop) & ((stop - start >= n) | (place == start)))
    if not len(begins):
        return
    p, size = place[begins], size[begins]
    h = size.astype(np.uint64)
    for k in range(n):
        use = size > k
        h = h + np.where(use, words[np.minimum(p + k, len(words) - 1)] * kernels.SHINGLE[k], np.uint64(0))
    h = kernels.mix(h)
    row = np.searchsorted(at, p, "right") - 1
    first = np.flatnonzero(np.diff(row, prepend=-1))
    rows = row[first]
    for k in range(PERMUTATIONS):  # multiply-add-shift: universal on 64-bit keys
        v = ((h * MULTIPLY[k] + ADD[k]) >> np.uint64(32)).astype(np.uint32)
        out[rows, k] = np.minimum(out[rows, k], np.minimum.reduceat(v, first))


def as_binary(sigs: np.ndarray) -> pa.Array:
    width = PERMUTATIONS
    offsets = pa.py_buffer((np.arange(len(sigs) + 1) * width).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(sigs), [None, offsets, pa.py_buffer(np.ascontiguousarray(sigs).tobytes())])


def as_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), PERMUTATIONS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of the texts, 0 to 1: unequal minima share their last byte
    once in 256 times. A text without a word is like another such text only."""
    return np.maximum(0.0, ((a == b).mean(axis=1) - 1 / 256) / (1 - 1 / 256))


def fingerprint(docs: DataFrame, text_col: str = "text", name: str = "fingerprint", n: int = WORDS) -> DataFrame:
    """The input with the binary fingerprint ``name`` added (an input column of this name is
    replaced). Null and empty texts have the fingerprint of the empty set; texts of fewer
    than ``n`` words are one shingle. Equal texts have equal fingerprints."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != name.lower()])
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in kernels.slices(batches):
            yield pa.RecordBatch.from_arrays([*b.columns, as_binary(signatures(b.column(place), n))], names=[*b.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *StructType.fromDDL(f"`{name}` binary").fields]))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, percent: int = 80, bands: int = 32, count: bool = True) -> DataFrame:
    """Near-duplicate groups: (id, n_shingles, name, component, links_found, component_id) per
    document, as the n-gram join returns them, candidates being the texts that share a band.

    Texts of equal sets are one class. Of a band key shared by many classes only pairs with
    one of them are made; if it then holds different components, its classes are joined by
    their rare n-grams, so that no link is lost and no key gives all its pairs. A candidate links if the
    Jaccard similarity of the whole sets reaches ``percent``. Texts without a word are linked
    with nothing; repeated rows, equal and null ids are handled as there. With 32 bands of 4,
    texts of similarity 0.8 miss every band with probability 5e-8. Without ``count`` the
    column links_found is left out.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = StructType([d.schema["id"], *StructType.fromDDL("n long, name binary, fp binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in kernels.slices(batches):
            words, at = kernels.word_hashes(*kernels.utf8(b.column(1)))
            sets = [kernels.shingles(words[x:y], n) for x, y in zip(at[:-1], at[1:])]
            names = pa.array([ngram_join.name_of(s) if len(s) else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), names, as_binary(signatures_of(words, at, n).astype(np.uint8))],
                                             names=schema.names)

    return grouped(d, cut(d.mapInArrow(run, schema)), n, percent, bands, count).withColumnRenamed("id", id_col)


def grouped(d: DataFrame, rows: DataFrame, n: int, percent: int, bands: int, count: bool) -> DataFrame:
    """``near_duplicates`` of (id, text) whose (id, n, name, fp) are known: only texts of
    classes in candidate pairs are read again.

    Of a band only an 8-byte key is moved. Candidates whose fingerprints are less alike than
    ``LEAST`` are left out before sets are moved: at a similarity of 0.8 that is less likely,
    with 128 places, than 2e-9 (Chernoff's bound).
    """
    classes = rows.filter("name is not null").groupBy("name").agg(F.first("n").alias("n"), F.first("fp").alias("fp"), F.min("id").alias("id"))
    classes = cut(classes).withColumn("cid", F.monotonically_increasing_id())
    size = PERMUTATIONS // bands
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.substring(F.col("fp"), i * size + 1, F.lit(size))))
    entries = classes.select("cid", F.col("n").cast("int").alias("n"), F.explode(keys).alias("token"), F.lit(0).alias("pos"))

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = likeness(as_matrix(b.column(2)), as_matrix(b.column(3))) >= LEAST * percent / 100
            yield b.select(["a", "b"]).filter(pa.array(keep))

    def bound(pairs: DataFrame) -> DataFrame:
        side = lambda c, fp: classes.select(F.col("cid").alias(c), F.col("fp").alias(fp))
        return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(alike, "a long, b long")

    return ngram_join.closed(d, rows.select("id", "n", "name"), classes.select("name", "n", "cid", "id"), entries, bound, n, percent, count, rare=True)


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, tie, size, packed) of (id, text, tie): each text as zstd, and its bytes before."""
    codec = pa.Codec("zstd", 1)
    for b in kernels.slices(batches):
        raw = [t.encode() for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(map(len, raw), pa.int32()), pa.array([codec.compress(x, asbytes=True) for x in raw], pa.binary())],
                                         names=["id", "tie", "size", "packed"])


def unpacked(size: pa.Array, column: pa.Array) -> list[str]:
    codec = pa.Codec("zstd", 1)
    return [codec.decompress(x, k, asbytes=True).decode() if k else "" for k, x in zip(size.to_pylist(), column.to_pylist())]


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS) -> DataFrame:
    """Fingerprints of every text and of its edited text, one row per document.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many
    (or all) of the next document by descending id, after the last the first. Rows of equal
    id stand by a hash of their text, null ids after all others; null texts are empty. A
    single document is its own next. An empty table gives an empty result. ``set_name`` tells
    the text's set of shingles as ``name`` does in ``near_duplicates``.

    Documents are range-partitioned and sorted once, their texts compressed one by one (a shuffle's
    own blocks are packed by a third less). A task works through its range with one
    row in hand; the last row of each range waits for the first of the next; these two meet in a second,
    small step, a row for each range.
    """
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    order = [F.col("id").desc_nulls_last(), F.col("tie")]
    d = d.mapInArrow(packed, StructType([*d.select("id", "tie").schema.fields, *StructType.fromDDL("size int, packed binary").fields]))
    d = d.repartitionByRange(*order).sortWithinPartitions(*order, "packed").select("id", "size", "packed")
    id_type = d.schema.fields[0]
    result = "n_chars long, edited_sha256 string, fp binary, edited_fp binary, near_edited double, near_next double, set_name binary, n_shingles long"
    waiting = StructType([id_type, *StructType.fromDDL(result + ", part int, edge int, text string").fields])
    final = StructType(waiting.fields[:9])

    def pairs(ids, texts, sigs, nexts, next_sigs):
        new = [t[:len(t) - len(t) // 2] + x[:len(t) // 2] for t, x in zip(texts, nexts)]
        e = signatures(pa.array(new, pa.large_string()), n)
        return [ids, pa.array(map(len, texts), pa.int64()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in new]), as_binary(sigs), as_binary(e),
                pa.array(likeness(sigs, e)), pa.array(likeness(sigs, next_sigs)), *names_of(texts)]

    def names_of(texts):
        words, at = kernels.word_hashes(*kernels.utf8(pa.array(texts, pa.large_string())))
        sets = [kernels.shingles(words[x:y], n) for x, y in zip(at[:-1], at[1:])]
        return pa.array([ngram_join.name_of(s) if len(s) else None for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, first = TaskContext.get().partitionId(), None, None

        def edge(row, which):
            i, t, s = row
            nothing = [pa.nulls(1, f.type) for f in to_arrow_schema(waiting)][1:9]
            nothing[2] = as_binary(s[None])
            return pa.RecordBatch.from_arrays([i, *nothing, pa.array([part], pa.int32()), pa.array([which], pa.int32()), pa.array([t])], names=waiting.names)

        for b in kernels.slices(batches):
            ids, texts = b.column(0), unpacked(b.column(1), b.column(2))
            sigs = signatures(pa.array(texts, pa.large_string()), n)
            if first is None:
                first = (ids.slice(0, 1), texts[0], sigs[0])
            if held:
                ids = pa.concat_arrays([held[0], ids])
                texts, sigs = [held[1], *texts], np.vstack([held[2][None], sigs])
            held = (ids.slice(len(texts) - 1), texts[-1], sigs[-1])
            if len(texts) > 1:
                cols = pairs(ids.slice(0, len(texts) - 1), texts[:-1], sigs[:-1], texts[1:], sigs[1:])
                m = len(texts) - 1
                yield pa.RecordBatch.from_arrays([*cols, pa.nulls(m, pa.int32()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.string())], names=waiting.names)
        if held:
            yield edge(first, 0)
            yield edge(held, 1)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in kernels.slices(batches, 64):
            texts, nexts = b.column(1).to_pylist(), b.column(3).to_pylist()
            yield pa.RecordBatch.from_arrays(pairs(b.column(0), texts, as_matrix(b.column(2)), nexts, as_matrix(b.column(4))), names=final.names)

    made = cut(d.mapInArrow(run, waiting))
    firsts = made.filter("edge = 0").select(F.col("part").alias("then"), F.col("text").alias("next_text"), F.col("fp").alias("next_fp"))
    lasts = made.filter("edge = 1")
    ranges = Window.orderBy("part")  # of numbers, as many as there are ranges
    then = F.coalesce(F.lead("part").over(ranges), F.min("part").over(ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    joined = lasts.select("id", "text", "fp", "part").join(lasts.select("part", then.alias("then")), "part").join(firsts, "then")
    rest = cut(joined.select("id", "text", "fp", "next_text", "next_fp").mapInArrow(close, final))
    return made.filter("edge is null").select(*final.names).unionByName(rest).withColumnRenamed("id", id_col)


def op4(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    made = edits(docs)
    rows = made.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), F.col("set_name").alias("name"), "fp")
    found = grouped(docs.select(F.col("doc_id").alias("id"), "text"), rows, WORDS, 80, 32, False)
    groups = found.filter("name is not null").groupBy(F.col("name").alias("set_name")).agg(F.first("component_id").alias("component_id"))
    component = F.when(F.col("set_name").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return made.join(groups, "set_name", "left").select(
        "doc_id", "n_chars", "edited_sha256", F.base64("fp").alias("fingerprint"), F.base64("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next",
        component.alias("component_id"))


ship_by_value(__name__)
