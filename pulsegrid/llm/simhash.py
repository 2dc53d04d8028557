"""SimHash near-duplicates by a segment-popcount embedding (operator 13).

A text's fingerprint has bit i set if over half of the XXH64 hashes (seed 42) of its shingles,
repeats included, have it set. Two fingerprints link at ``DISTANCE`` = 2 or fewer differing
bits. Documents of one fingerprint are one class; classes are linked in a grid:

1. The 64 bits are cut into ``SEGMENTS`` of four and a fingerprint is mapped to the number of
   ones in each. The Manhattan distance of two such points is never more than the number of
   differing bits.
2. Points at Manhattan distance 2 or less have a point between them, at most one step from
   either. So each fingerprint is entered at its own cell of the grid and all cells one step
   away (33 at most), and linked ones share a cell.
3. What shares a cell is verified exactly, by the bits that differ.
4. A cell of more than ``CROWD`` fingerprints is not multiplied out. Its fingerprints are
   entered in the finest grid, whose segments are single bits: there the Manhattan distance
   is the number of differing bits, so that all of a cell link with each other and one link
   each, to the least, keeps them together. Such a cell is a point and its 64 neighbours, so
   no cell of it ever holds more than 65 fingerprints, whatever the corpus has.
5. Components are closed over all links.

Scale: one pass over the texts gives 16 bytes a document; from there only fingerprints move.
Copies fold into their class by partial aggregation. Crowded cells are found by partial counts
and told to the tasks in a bit filter of fixed size (4 MB); a cell that the filter names by
mistake is refined without need, which changes no link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, LongType
from xxhash import xxh64_intdigest

from ..workers import ship_by_value
from . import kernels
from .common import cut, read
from .ngram_join import SKETCH_BITS, bit_filter, components, place_of

WORDS, SEED = 3, 42
#: Bits that linked fingerprints may differ in; both grids rest on it.
DISTANCE = 2
SEGMENTS, CROWD = 16, 32
#: Bytes of a text that are split into words at once, and hashes whose bits are counted at once.
STRETCH, HASHES = 1 << 20, 1 << 17
ONE = np.uint64(1)


def shingle_hashes(raw: bytes, n: int) -> Iterator[np.ndarray]:
    """XXH64 of all ``n``-word shingles of a text, in stretches; words keep their order and are
    joined by one space. Fewer words are one shingle, no words none."""
    held, a, seen = [], 0, False
    while a < len(raw):
        b = a + STRETCH
        while b < len(raw) and not kernels.SPACE[raw[b]]:
            b += 1
        words = held + raw[a:b].lower().split()  # for bytes: A-Z, and space with U+0009 to U+000D
        a = b
        if len(words) >= n:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.append(0, ends[:-1] + 1)
            cuts = map(slice, starts[:len(words) - n + 1].tolist(), ends[n - 1:].tolist())
            yield np.fromiter(map(xxh64_intdigest, map(joined.__getitem__, cuts), repeat(SEED)), np.uint64, len(words) - n + 1)
            seen = True
        held = words[len(words) - n + 1:] if len(words) >= n else words
    if held and not seen:
        yield np.array([xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprints(texts: list[bytes | None], n: int = WORDS) -> np.ndarray:
    """The fingerprint of each text (null, empty or without a word: 0)."""
    ones, total = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    waiting: list[np.ndarray] = []
    rows: list[int] = []

    def count() -> None:
        flat = np.concatenate(waiting)
        size = np.array([len(x) for x in waiting])
        for a in range(0, len(flat), HASHES):
            bits = np.unpackbits(flat[a:a + HASHES].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row = np.repeat(rows, size)[a:a + HASHES]
            first = np.flatnonzero(np.diff(row, prepend=-1))
            ones[row[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        waiting.clear()
        rows.clear()

    held = 0
    for i, text in enumerate(texts):
        for h in shingle_hashes(text or b"", n):
            waiting.append(h)
            rows.append(i)
            total[i] += len(h)
            held += len(h)
            if held >= HASHES:
                count()
                held = 0
    if waiting:
        count()
    bits = ones * 2 > total[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def popcounts(fp: np.ndarray) -> np.ndarray:
    """The ones of each of the 16 segments, four bits each, in one number."""
    x = fp - ((fp >> ONE) & np.uint64(0x5555555555555555))
    return (x & np.uint64(0x3333333333333333)) + ((x >> np.uint64(2)) & np.uint64(0x3333333333333333))


def cells(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell): the cell of each fingerprint's point and those one step away, mixed so that
    their first bits are even."""
    p, row = popcounts(fp), np.arange(len(fp))
    rows, found = [row], [p]
    for s in range(SEGMENTS):
        step, ones = ONE << np.uint64(4 * s), (p >> np.uint64(4 * s)) & np.uint64(15)
        for ok, to in ((ones < 64 // SEGMENTS, p + step), (ones > 0, p - step)):
            rows.append(row[ok])
            found.append(to[ok])
    return np.concatenate(rows), kernels.mix(np.concatenate(found))


def table(schema: str, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c.astype(np.uint64).view(np.int64)) for c in columns], [x.split()[0] for x in schema.split(", ")])


def longs(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def entries(classes: DataFrame) -> DataFrame:
    """(cell, fp): every fingerprint at its own cell and those one step away."""
    schema = "cell long, fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = longs(b.column(0))
            row, cell = cells(fp)
            yield table(schema, cell, fp[row])

    return classes.select("fp").mapInArrow(run, schema)


def dealt(classes: DataFrame, crowded: np.ndarray) -> DataFrame:
    """The entries of cells that are not crowded, and with cell null each fingerprint that
    stands in a crowded one."""
    shared = classes.sparkSession.sparkContext.broadcast(crowded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = longs(b.column(0))
            row, cell = cells(fp)
            full = shared.value[place_of(cell.view(np.int64), SKETCH_BITS)]
            again = fp[np.unique(row[full])].view(np.int64)
            yield pa.record_batch([pa.array(np.append(cell[~full].view(np.int64), again), mask=np.arange((~full).sum() + len(again)) >= (~full).sum()),
                                   pa.array(np.append(fp[row[~full]].view(np.int64), again))], ["cell", "fp"])

    return classes.select("fp").mapInArrow(run, "cell long, fp long")


def verified(light: DataFrame) -> DataFrame:
    """Links (a, b) within the cells: all pairs of a cell, of few fingerprints each, by the bits
    that differ. Rows come by cell; a block of rows is compared at once."""
    schema = "a long, b long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, fp = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        for b in batches:
            cell, fp = np.append(cell, longs(b.column(0))), np.append(fp, longs(b.column(1)))
            last = int(np.flatnonzero(cell != cell[-1])[-1]) + 1 if (cell != cell[-1]).any() else 0
            yield pairs(cell[:last], fp[:last])
            cell, fp = cell[last:], fp[last:]
        yield pairs(cell, fp)

    def pairs(cell: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        a, b, d = [fp[:0]], [fp[:0]], 1
        i = np.arange(len(cell))
        while True:
            i = i[i + d < len(cell)]
            i = i[cell[i] == cell[i + d]]
            if not len(i):
                break
            near = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= DISTANCE]
            a.append(fp[near])
            b.append(fp[near + d])
            d += 1
        found = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
        return table(schema, found[0], found[1])

    return light.repartition("cell").sortWithinPartitions("cell", "fp").mapInArrow(run, schema)


def refined(fps: DataFrame) -> DataFrame:
    """Links (a, b) of the finest grid: each fingerprint with the least of every cell that it
    is entered in. A cell is a point and what is one bit from it, 65 fingerprints at most."""
    schema = "cell long, fp long"
    step = np.append(np.uint64(0), ONE << np.arange(64, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in kernels.slices(batches):
            fp = longs(b.column(0))
            yield table(schema, (fp[:, None] ^ step).ravel(), np.repeat(fp, 65))

    e = fps.mapInArrow(run, schema).withColumn("least", F.min("fp").over(Window.partitionBy("cell")))
    return e.filter("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b"))


def link_fingerprints(classes: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(node, comp) of the fingerprints in ``classes`` (fp, distinct) that link with another
    one; comp is the least fingerprint reachable."""
    crowds = entries(classes).groupBy("cell").count().filter(F.col("count") > crowd)
    put = cut(dealt(classes, bit_filter(crowds.select(F.col("cell").alias("h")))))
    near = verified(put.filter("cell is not null"))
    return components(near.unionByName(refined(put.filter("cell is null").select("fp"))).distinct())


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, crowd: int = CROWD) -> DataFrame:
    """(id, fingerprint, component_id) per document; the fingerprint as 16 lower-case hex digits.

    Null texts, empty ones and those without a word have fingerprint zero, which links as any
    other. ``component_id`` is the least id reachable by links, itself included; null ids are
    never least unless all are null. Repeated rows and ids stay rows of their own. An empty
    table gives an empty result. Only the two named columns are read.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = StructType([d.schema["id"], StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in kernels.slices(batches):
            fp = fingerprints(b.column(1).cast(pa.large_binary()).to_pylist(), n)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=schema.names)

    rows = cut(d.mapInArrow(run, schema))
    classes = cut(rows.groupBy("fp").agg(F.min("id").alias("least")))
    comp = link_fingerprints(classes.select("fp"), crowd)
    c = classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    of = c.join(c.groupBy("comp").agg(F.min("least").alias("component_id")), "comp").select("fp", "component_id")
    out = rows.join(of, "fp")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op13(spark, sf_dir: str) -> DataFrame:
    return simhash(read(spark, sf_dir, "documents"))


ship_by_value(__name__)
