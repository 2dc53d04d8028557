"""Phrase collocations by direct-address tiling of frequency-ranked ids (operator 12).

Texts are lower-cased (A-Z) and cut at punctuation and line ends into pieces of words. All is
counted per language. A phrase of m words is the pair of the two overlapping phrases of m - 1
words in it, so that every length is counted in the same way:

1. The frequent phrases of m - 1 words are ranked by frequency; the rank is their id.
2. A task turns its texts into ids, place by place, and counts the pairs of neighbouring ids.
   A pair's ids name a tile and a place in it. Tiles that get many of a block's pairs (those
   of frequent ids, near the corner) are counted by ``bincount`` into a dense table, the
   others as sorted coordinates with counts.
3. The tasks' counts are added up; pairs that are frequent are the phrases of m words, are
   ranked anew, and the next length follows.

No phrase is lost by ranking: what has an infrequent part is infrequent itself. Tables of ids
that are sent to tasks have a fixed size (``WORD_IDS`` and ``PHRASE_IDS`` entries of bounded
length). Frequent phrases beyond them have no id; tasks know them by a bit filter of bounded
size and count phrases with such a part as texts, exactly.

A block of texts is handled as arrays: no Python object is made per word or place, with or
without an id. Places are looked up, and equal texts of a task are put together, by 64-bit hashes.

Scale: one pass over the texts for each length, and a shuffle of each task's distinct pairs,
summed up before it. The sums are moved in buckets, a row for each bucket and task, and added
up a bucket at a time. Scores and the drop rule are joins of frequent phrases only; the best of
a language are found among the best of ``SHARES`` shares of its phrases.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ..workers import ship_by_value
from .common import cut, read
from . import kernels

LONGEST, LEAST, COVER, TOP, SHARES = 4, 30, 80, 2000, 64
#: Entries of the tables of ids that tasks get, and the bytes that a word of an entry may have on average.
WORD_IDS, PHRASE_IDS, WORD_BYTES = 1 << 18, 1 << 20, 32
#: Ids have so many bits, a tile's sides so many, and a dense tile is made for so many pairs of a block.
ID_BITS, TILE_BITS, DENSE_PAIRS, DENSE_TILES = 20, 10, 1 << 14, 8
#: Bytes of a stretch of text and of a block of them, and distinct entries and bytes of texts that a task holds.
STRETCH, BLOCK, KEEP, KEEP_BYTES = 1 << 20, 1 << 22, 3 << 19, 1 << 25
#: A-Z become a-z, a tab a space, and all that parts pieces a full stop.
PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz ..........")
BREAK = re.compile(rb"[ .]")
#: Places without an id: what can't be part of a frequent phrase, and what is frequent beyond the table.
NONE, BEYOND = -1, -2
#: A bit filter has 2^20 to 2^27 bits, which are gathered in chunks of 2^16.
LEAST_BITS, MOST_BITS, CHUNK_BITS = 20, 27, 16
#: Buckets are 2^8 to 2^12 (what a bucket leaves of a pair's code has 32 bits); an odd factor deals out the codes.
LEAST_BUCKETS, MOST_BUCKETS = 8, 12
CODES = (1 << 2 * ID_BITS) - 1
DEAL = 0x9E3779B97F4A7C15 & CODES
UNDEAL = pow(DEAL, -1, CODES + 1)
#: Of a bucket, the counts of pairs (codes) or of texts (bytes of each, and all in a row).
COUNTED = "bucket int, codes binary, sizes binary, texts binary, f binary"
FOUND = "lang string, phrase binary, f long, h long"
U = np.uint64
#: Of eight bytes, those of a word of so many.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], U)


def cuts(batches: Iterator[pa.RecordBatch], overlap: int) -> Iterator[tuple[str, bytes]]:
    """(lang, plain text) of all texts of (lang, text), a long text in stretches that repeat the
    last ``overlap`` words of the piece that is cut."""
    for b in kernels.slices(batches):
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.large_binary()).to_pylist()):
            text = (text or b"").translate(PLAIN)
            a, held = 0, b""
            while a < len(text):
                m = BREAK.search(text, a + STRETCH) if len(text) - a > STRETCH else None
                end = m.start() if m else len(text)
                part, last = held + text[a:end], []
                yield "und" if lang is None else lang, part
                while len(last) < overlap and end < len(text):
                    part = part.rstrip(b" ")
                    if not part or part.endswith(b"."):
                        break
                    i = max(part.rfind(b" "), part.rfind(b".")) + 1
                    last.insert(0, part[i:] + b" ")
                    part = part[:i]
                a, held = end, b"".join(last)


def stretches(batches: Iterator[pa.RecordBatch], overlap: int) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, tokens) of what ``cuts`` gives. A token is a word, or a full stop for what parts pieces."""
    for lang, text in cuts(batches, overlap):
        yield lang, text.replace(b".", b" . ").split()


def is_word(token: bytes) -> bool:
    return token != b"."


def blocks(batches: Iterator[pa.RecordBatch], overlap: int) -> Iterator["Words"]:
    langs, texts, held = [], [], 0
    for lang, text in cuts(batches, overlap):
        langs.append(lang)
        texts.append(text)
        held += len(text)
        if held >= BLOCK:
            yield Words(langs, texts)
            langs, texts, held = [], [], 0
    if texts:
        yield Words(langs, texts)


class Words:
    """The words of some plain texts, as arrays."""

    def __init__(self, langs: list[str], texts: list[bytes]):
        raw = b".".join(texts) + b"."
        x = np.frombuffer(raw, np.uint8)
        stop = x == 46
        edges = np.flatnonzero(np.diff(stop | (x == 32), prepend=True, append=True))
        self.raw, self.starts, self.ends = raw, edges[::2], edges[1::2]
        self.piece = np.cumsum(stop, dtype=np.int32)[self.starts]
        names = {lang: i for i, lang in enumerate(dict.fromkeys(langs))}
        bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.lang = np.repeat(np.array([names[lang] for lang in langs], np.int32), np.diff(np.searchsorted(self.starts, bounds)))
        self.names = pa.array([lang.encode() for lang in names], pa.large_binary())
        self.seeds = np.array([xxh64_intdigest(lang.encode(), 42) for lang in names], U)
        self.hashes = self.hashed()

    def hashed(self) -> np.ndarray:
        size = self.ends - self.starts
        eight = np.ndarray((len(self.raw),), "<u8", self.raw + bytes(8), strides=(1,))
        h = kernels.mix((eight[self.starts] & FIRST[np.minimum(size, 8)]) + size.astype(U) * U(kernels.BASE))
        for i in np.flatnonzero(size > 64):
            h[i] = xxh64_intdigest(self.raw[self.starts[i]:self.ends[i]], 42)
        more, k = np.flatnonzero((size > 8) & (size <= 64)), 8
        while len(more):
            h[more] = kernels.mix(h[more] * U(kernels.BASE) + (eight[self.starts[more] + k] & FIRST[np.minimum(size[more] - k, 8)]))
            k += 8
            more = more[size[more] > k]
        return h

    def phrases(self, m: int, at: np.ndarray | None = None) -> np.ndarray:
        """Hashes of the phrases of m words and their language, from the places ``at`` or every place on."""
        n = max(len(self.hashes) - m + 1, 0)
        word = (lambda j: self.hashes[j:n + j]) if at is None else (lambda j: self.hashes[at + j])
        h = self.seeds[self.lang[:n] if at is None else self.lang[at]] + U(m)
        for j in range(m):
            h += word(j) * kernels.SHINGLE[j]
        return kernels.mix(h)

    def whole(self, m: int) -> np.ndarray:
        """Whether the m words from each place on are of one piece."""
        n = max(len(self.piece) - m + 1, 0)
        return self.piece[:n] == self.piece[len(self.piece) - n:]

    def texts(self, at: np.ndarray, m: int) -> pa.Array:
        """Of the phrases of m words from ``at`` on: language, a full stop, words with a space between them."""
        sizes = self.ends - self.starts
        if not hasattr(self, "plain"):
            keep = np.frombuffer(self.raw, np.uint8).copy()
            keep[self.ends] = 32  # a word and one space are kept, nothing else
            mark = np.zeros(len(keep) + 1, np.int8)
            mark[self.starts] = 1
            mark[self.ends + 1] -= 1
            self.plain = keep[np.cumsum(mark[:-1], dtype=np.int8).astype(bool)]
            self.places = np.cumsum(sizes + 1) - sizes - 1
        a = self.places[at]
        n = self.places[at + m - 1] + sizes[at + m - 1] - a
        offsets = np.concatenate([[0], np.cumsum(n)])
        if offsets[-1] > 256 * len(at):
            data = b"".join(self.plain[i:i + k] for i, k in zip(a.tolist(), n.tolist()))
        else:
            data = self.plain[np.arange(offsets[-1]) + np.repeat(a - offsets[:-1], n)]
        found = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        return pc.binary_join_element_wise(self.names.take(pa.array(self.lang[at])), found, pa.scalar(b".", pa.large_binary()))


def table(code=None, lang=None, phrase=None, f=()) -> pa.RecordBatch:
    n = len(f)
    return pa.record_batch([pa.nulls(n, pa.int64()) if code is None else pa.array(code, pa.int64()), pa.nulls(n, pa.string()) if lang is None else pa.array(lang, pa.string()),
                            pa.nulls(n, pa.binary()) if phrase is None else pa.array(phrase, pa.binary()), pa.array(f, pa.int64())], ["code", "lang", "phrase", "f"])


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with their sums, and a place of each."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts, order[first]


def bucket_bits(df: DataFrame) -> int:
    """Some buckets for each partition of a shuffle."""
    return min(max((4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))).bit_length(), LEAST_BUCKETS), MOST_BUCKETS)


def rows(buckets: np.ndarray, **columns) -> pa.RecordBatch:
    """A row for each of the sorted buckets; a column is an array of numbers, or of binaries."""
    n = len(buckets)
    bounds = np.flatnonzero(np.diff(buckets, prepend=-1, append=-1))
    out = [pa.array(buckets[bounds[:-1]], pa.int32())]
    for name in ("codes", "sizes", "texts", "f"):
        x = columns.get(name)
        if x is None:
            out.append(pa.nulls(len(bounds) - 1, pa.binary()))
            continue
        at, data = bounds * getattr(x, "itemsize", 0), x
        if isinstance(x, pa.Array):
            _, offsets, data = x.buffers()
            at = np.frombuffer(offsets, np.int64)[x.offset:x.offset + n + 1][bounds]
            data, at = (data or pa.py_buffer(b""))[at[0]:at[-1]], at - at[0]
        out.append(pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)]))
    return pa.record_batch(out, ["bucket", "codes", "sizes", "texts", "f"])


def dealt_pairs(b: pa.RecordBatch, bits: int) -> Iterator[pa.RecordBatch]:
    code, f = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 3))
    code = (code.astype(U) * U(DEAL)) & U(CODES)
    order = np.argsort(code)
    code, rest = code[order], 2 * ID_BITS - bits
    if len(code):
        yield rows((code >> U(rest)).astype(np.int64), codes=(code & U((1 << rest) - 1)).astype(np.uint32), f=f[order].astype(np.int64))


class Texts:
    """Counts of phrases known by their text."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

    def add(self, words: Words, at: np.ndarray, m: int) -> None:
        h, f, first = summed(words.phrases(m, at), np.ones(len(at), np.int64))
        self.parts.append((h, f, words.texts(at[first], m)))

    def full(self) -> bool:
        over = lambda x: sum(len(p[0]) for p in self.parts) > KEEP // x or sum(p[2].nbytes for p in self.parts) > KEEP_BYTES // x
        return over(1) and (self.merge() or over(2))

    def merge(self) -> None:
        h, f, first = summed(*(np.concatenate(x) for x in list(zip(*self.parts))[:2]))
        self.parts = [(h, f, pa.concat_arrays([p[2] for p in self.parts]).take(pa.array(first)))]

    def dealt(self, bits: int) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self.merge()
            h, f, texts = self.parts.pop()
            if len(h):
                yield rows((h >> U(64 - bits)).astype(np.int64), sizes=pc.binary_length(texts).to_numpy().astype(np.int64), texts=texts, f=f)


def added_up(counted: DataFrame, m: int, least: int, bits: int, names=None) -> DataFrame:
    """(lang, phrase, f, h) of the phrases of m words that occur ``least`` times, from COUNTED, h being their hashes;
    ``names`` has the names of the ids. For m = 1 also the number of words of a language, with phrase and h null."""
    def run(t: pa.Table) -> pa.Table:
        langs, phrases, counts, totals = [], [], [], Counter()
        joined = lambda t, name, kind: np.frombuffer(b"".join(t[name].to_pylist()), kind)
        pairs, texts = t.filter(pc.is_valid(t["codes"])), t.filter(pc.is_valid(t["texts"]))
        if pairs.num_rows:
            code, f, _ = summed(joined(pairs, "codes", np.uint32), joined(pairs, "f", np.int64))
            code, f = code[f >= least].astype(U), f[f >= least]
            code = ((U(t["bucket"][0].as_py() << 2 * ID_BITS - bits) | code) * U(UNDEAL)) & U(CODES)
            known = names.value
            x, y = pa.array((code >> U(ID_BITS)).astype(np.int64)), pa.array((code & U((1 << ID_BITS) - 1)).astype(np.int64))
            langs += known["langs"].take(x).to_pylist()
            phrases += pc.binary_join_element_wise(known["phrases"].take(x), known["last"].take(y), pa.scalar(b" ", pa.binary())).to_pylist()
            counts.append(f)
        if texts.num_rows:
            offsets = np.concatenate([[0], np.cumsum(joined(texts, "sizes", np.int64))])
            keys = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(texts["texts"].to_pylist()))])
            found = pa.table({"key": keys, "f": joined(texts, "f", np.int64)}).group_by("key").aggregate([("f", "sum")])
            if m == 1:
                for key, n in zip(found["key"].to_pylist(), found["f_sum"].to_pylist()):
                    totals[key[:key.rfind(b".")]] += n
            found = found.filter(pc.greater_equal(found["f_sum"], least))
            for key in found["key"].to_pylist():
                lang, _, phrase = key.rpartition(b".")
                langs.append(lang.decode())
                phrases.append(phrase)
            counts.append(found["f_sum"].to_numpy())
        h = Words(langs, phrases).phrases(m, np.arange(len(phrases)) * m).view(np.int64)
        nothing = [None] * len(totals)
        return pa.table({"lang": pa.array(langs + [x.decode() for x in totals], pa.string()), "phrase": pa.array(phrases + nothing, pa.binary()),
                         "f": pa.array(np.concatenate([*counts, list(totals.values())]).astype(np.int64)), "h": pa.array(h.tolist() + nothing, pa.int64())})

    return counted.groupBy("bucket").applyInArrow(run, FOUND)


def word_counts(docs: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, f, h) of the frequent words of (lang, text), and the number of all words of each language."""
    bits = bucket_bits(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = Texts()
        for words in blocks(batches, 0):
            texts.add(words, np.arange(len(words.hashes)), 1)
            if texts.full():
                yield from texts.dealt(bits)
        yield from texts.dealt(bits)

    return added_up(docs.mapInArrow(run, COUNTED), 1, least, bits)


class Ids:
    """The frequent phrases of one length: ids by frequency for those of the table, and a bit
    filter of those beyond it (None if there are none)."""

    def __init__(self, langs: pa.Array, phrases: pa.Array, hashes: np.ndarray, beyond: np.ndarray | None):
        self.langs, self.phrases = langs.dictionary_encode(), phrases
        self.last = pa.array([p[p.rfind(b" ") + 1:] for p in phrases.to_pylist()], pa.binary())
        #: the hashes by id, and a hash table of the ids: the first free place of those from a hash's first bits on
        self.keys, self.beyond = hashes, beyond
        self.bits = max(len(hashes).bit_length() + 2, 4)
        self.slots = np.full(1 << self.bits, NONE, np.int32)
        left, slot = np.arange(len(hashes)), (hashes >> U(64 - self.bits)).astype(np.int64)
        while len(left):
            free = np.flatnonzero(self.slots[slot] == NONE)
            self.slots[slot[free]] = left[free]
            stay = self.slots[slot] != left
            left, slot = left[stay], slot[stay] + 1 & (1 << self.bits) - 1

    def names(self) -> dict:
        return {k: v for k, v in vars(self).items() if k in ("langs", "phrases", "last")}

    def tables(self) -> dict:
        return {k: v for k, v in vars(self).items() if k not in ("langs", "phrases", "last")}

    @classmethod
    def of(cls, values: dict) -> "Ids":
        out = cls.__new__(cls)
        out.__dict__ = values
        return out

    def find(self, h: np.ndarray) -> np.ndarray:
        """The ids of the phrases of these hashes."""
        out = np.full(len(h), NONE, np.int64)
        left, slot = np.arange(len(h)), (h >> U(64 - self.bits)).astype(np.int64)
        while len(left) and len(self.keys):
            found = self.slots[slot]
            same = (found >= 0) & (self.keys[found] == h[left])
            out[left[same]] = found[same]
            go = (found >= 0) & ~same
            left, slot = left[go], slot[go] + 1 & (1 << self.bits) - 1
        if self.beyond is not None:
            left = np.flatnonzero(out == NONE)
            place = (h[left] >> U(64 - (len(self.beyond) * 8).bit_length() + 1)).astype(np.int64)
            out[left[(self.beyond[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)]] = BEYOND
        return out


class Pairs:
    """Counts of pairs of ids: dense tiles by bincount, the others as sorted coordinates."""

    def __init__(self) -> None:
        self.dense: dict[int, np.ndarray] = {}
        self.lists: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        side = 1 << TILE_BITS
        tile = (x >> TILE_BITS) << ID_BITS | (y >> TILE_BITS)
        names, size = np.unique(tile, return_counts=True)
        rest = np.ones(len(x), bool)
        for t in names[np.argsort(-size, kind="stable")][:DENSE_TILES].tolist():
            own = tile == t
            if t not in self.dense:
                if own.sum() < DENSE_PAIRS or len(self.dense) >= DENSE_TILES:
                    continue
                self.dense[t] = np.zeros(side * side, np.int64)
            self.dense[t] += np.bincount((x[own] & side - 1) << TILE_BITS | y[own] & side - 1, minlength=side * side)
            rest &= ~own
        self.lists.append(np.unique(x[rest] << ID_BITS | y[rest], return_counts=True))

    def merged(self) -> int:
        """Make one list of all; its length."""
        self.lists = [summed(*(np.concatenate(x) for x in zip(*self.lists)))[:2]]
        return len(self.lists[0][0])

    def sparse(self) -> Iterator[pa.RecordBatch]:
        if self.lists:
            self.merged()
            yield table(self.lists[0][0], f=self.lists[0][1])
            self.lists.clear()

    def tiles(self) -> Iterator[pa.RecordBatch]:
        for t, counts in self.dense.items():
            i = np.flatnonzero(counts)
            x = (t >> ID_BITS) << TILE_BITS | i >> TILE_BITS
            y = (t & (1 << ID_BITS) - 1) << TILE_BITS | i & (1 << TILE_BITS) - 1
            yield table(x << ID_BITS | y, f=counts[i])
        self.dense.clear()


def phrase_counts(docs: DataFrame, parts: Ids, m: int, least: int) -> DataFrame:
    """(lang, phrase, f, h) of the phrases of m words that are frequent; ``parts`` has those of m - 1 words."""
    send = docs.sparkSession.sparkContext.broadcast  # plain values, which need no class of this package
    tables, names, bits = send(parts.tables()), send(parts.names()), bucket_bits(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, pairs, texts = Ids.of(tables.value), Pairs(), Texts()
        for words in blocks(batches, m - 1):
            x = ids.find(words.phrases(m - 1))
            x, y = x[:-1], x[1:]
            whole = words.whole(m)
            known = whole & (x >= 0) & (y >= 0)
            pairs.add(x[known], y[known])
            others = np.flatnonzero(whole & ~known & (x != NONE) & (y != NONE))
            if len(others):
                texts.add(words, others, m)
            if sum(len(c) for c, _ in pairs.lists) > KEEP and pairs.merged() > KEEP // 2:
                for b in pairs.sparse():
                    yield from dealt_pairs(b, bits)
            if texts.full():
                yield from texts.dealt(bits)
        for found in (pairs.sparse(), pairs.tiles()):
            for b in found:
                yield from dealt_pairs(b, bits)
        yield from texts.dealt(bits)

    return added_up(docs.mapInArrow(run, COUNTED), m, least, bits, names)


def hits(hashes: DataFrame, n: int) -> np.ndarray:
    """Packed bits, of which the n numbers of the column h set those named by their first bits."""
    bits = min(max((8 * n).bit_length(), LEAST_BITS), MOST_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for b in batches:
            place = np.unique(b.column(0).to_numpy(zero_copy_only=False).view(U) >> U(64 - bits)).astype(np.int64)
            for c in np.unique(place >> CHUNK_BITS).tolist():
                a, z = np.searchsorted(place, [c << CHUNK_BITS, c + 1 << CHUNK_BITS])
                found.setdefault(c, np.zeros(1 << CHUNK_BITS, bool))[place[a:z] & (1 << CHUNK_BITS) - 1] = True
        yield pa.record_batch([pa.array(list(found), pa.int32()), pa.array([np.packbits(x, bitorder="little").tobytes() for x in found.values()], pa.binary())], ["chunk", "bits"])

    out = np.zeros((1 << bits - CHUNK_BITS, 1 << CHUNK_BITS - 3), np.uint8)
    chunk = F.shiftrightunsigned("h", 64 - bits + CHUNK_BITS)
    for b in hashes.repartition(chunk).mapInArrow(run, "chunk int, bits binary").toArrow().to_batches():
        for c, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            out[c] |= np.frombuffer(x, np.uint8)
    return out.reshape(-1)


def ranked(found: DataFrame, m: int, size: int) -> Ids:
    """Ids of the most frequent phrases of m words in (lang, phrase, f, h): up to ``size`` of them, of
    equally frequent ones all or none."""
    short = F.length("phrase") + F.length(F.encode("lang", "utf-8")) <= m * WORD_BYTES
    have = {r["f"]: r["n"] for r in found.groupBy(F.when(short, F.col("f")).alias("f")).agg(F.count("*").alias("n")).collect()}
    rest, lowest, n = sum(have.values()), None, 0
    for f in sorted((f for f in have if f is not None), reverse=True):
        if n + have[f] > size:
            break
        lowest, n = f, n + have[f]
    own = short & (F.col("f") >= lowest) if n else F.lit(False)
    t = found.filter(own).select("lang", "phrase", "f", "h").toArrow().combine_chunks() if n else pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.binary()), "f": pa.array([], pa.int64()), "h": pa.array([], pa.int64())})
    t = t.take(pa.array(np.argsort(-t["f"].to_numpy(), kind="stable")))
    column = lambda name, kind: pa.concat_arrays([c.cast(kind) for c in t[name].chunks] or [pa.array([], kind)])
    return Ids(column("lang", pa.string()), column("phrase", pa.binary()), t["h"].to_numpy().view(U), hits(found.filter(~own).select("h"), rest - n) if rest > n else None)


def frequent_phrases(docs: DataFrame, lang_col: str, text_col: str, longest: int, least: int, word_ids: int, phrase_ids: int) -> tuple[DataFrame, DataFrame]:
    """(lang, n) and (lang, phrase, m, f): the words of each language, and all phrases of up to
    ``longest`` words that occur ``least`` times, phrases in UTF-8 bytes."""
    if max(word_ids, phrase_ids) > 1 << ID_BITS:
        raise ValueError(f"ids have {ID_BITS} bits")
    d = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    words = cut(word_counts(d, least))
    found = words.filter(F.col("phrase").isNotNull())
    tables = [found.withColumn("m", F.lit(1))]
    for m in range(2, longest + 1):
        found = cut(phrase_counts(d, ranked(found, m - 1, word_ids if m == 2 else phrase_ids), m, least))
        tables.append(found.withColumn("m", F.lit(m)))
    every = tables[0].select("lang", "phrase", "m", "f")
    for t in tables[1:]:
        every = every.unionByName(t.select("lang", "phrase", "m", "f"))
    return words.filter(F.col("phrase").isNull()).groupBy("lang").agg(F.sum("f").alias("n")), every


def exact(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST, least: int = LEAST, cover: int = COVER, top: int = TOP,
                 word_ids: int = WORD_IDS, phrase_ids: int = PHRASE_IDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A phrase of 2 to ``longest`` words that occurs a >= ``least`` times is a candidate. Of its
    cuts into two parts of counts l and r the one of the lowest floor(2000000 a / (l + r))
    counts, of equal ones the first. It is dropped if it stands inside a longer candidate that
    has ``cover`` percent of its occurrences. n is the number of words of the language.

    A null language is ``und``, as is one of that name; null and empty texts have no words.
    Rows that repeat count each time. Empty tables, and languages without a candidate, give no
    row. Only the two named columns are read. All arithmetic is on whole numbers that don't
    overflow. The result does not depend on ``word_ids`` and ``phrase_ids``, the sizes of the
    tables of ids.
    """
    n, every = frequent_phrases(docs, lang_col, text_col, longest, least, word_ids, phrase_ids)
    every = every.withColumn("phrase", F.decode("phrase", "utf-8"))
    counts = every.select("lang", "phrase", "f")
    c = every.filter("m >= 2").withColumnRenamed("f", "a").withColumn("w", F.split("phrase", " ", -1))
    part = lambda a, k: F.array_join(F.slice("w", a, k), " ")
    cuts = c.select("lang", "phrase", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("m") - F.col("k")).alias("right"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))
    spans = F.expr("flatten(transform(sequence(2, m - 1), x -> transform(sequence(1, m - x + 1), i -> array_join(slice(w, i, x), ' '))))")
    inner = c.filter("m > 2").select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("f")).groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    kept = best.join(inner, ["lang", "phrase"], "left").filter(F.col("f").isNull() | (exact(F.col("f")) * 100 < exact(F.col("a")) * cover))
    kept = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    for own in (["lang", "share"], ["lang"]):
        order = Window.partitionBy(*own).orderBy(F.desc("b.score"), F.desc("a"), F.asc("phrase"))
        kept = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return kept.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "b.l", "b.r", "n", "b.score")


def op12(spark, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
spans AS (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) v(m) WHERE len(ws) >= m),
f AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, m, count(*) AS f FROM spans GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1),
cuts AS (SELECT lang, phrase, a, ws, m, unnest(range(1, m)) AS k FROM c),
scored AS (SELECT u.lang, u.phrase, u.a, u.k, x.f AS l, y.f AS r, ((2000000::HUGEINT * u.a) // (x.f::HUGEINT + y.f))::BIGINT AS score
           FROM cuts u JOIN f x ON x.lang = u.lang AND x.phrase = array_to_string(u.ws[1:u.k], ' ')
                       JOIN f y ON y.lang = u.lang AND y.phrase = array_to_string(u.ws[u.k + 1:u.m], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_spans AS (SELECT lang, a, ws, m, x, unnest(range(1, m - x + 2)) AS i FROM c, (VALUES (2), (3)) v(x) WHERE x < m),
longer AS (SELECT lang, array_to_string(ws[i:i + x - 1], ' ') AS phrase, max(a) AS f FROM inner_spans GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase WHERE g.f IS NULL OR 100::HUGEINT * g.f < 80::HUGEINT * b.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept k JOIN total t ON t.lang = k.lang
QUALIFY row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""

ship_by_value(__name__)
