"""Packing token sequences into windows by Karmarkar-Karp differencing (operator 5).

A document's ids (and its end id) are cut into pieces of ``window`` ids and a rest. Full
pieces are windows of their own. Rests are packed in blocks: with k windows, every rest
starts a partial partition of k bins; the two partitions with the largest imbalance are
merged, the fullest bins of one onto the emptiest of the other, until one is left, whose
bins are near-equal. If a bin exceeds the window, the count k rises and the block is done
again, so no window overflows.

Scale: tokenising and packing are one pass over the partitions, without a shuffle: a
partition packs its own rests as soon as a block is full and holds no more than a batch of
texts, a block of rests and a bounded cache. Ids never leave the task: a piece is known by
its place and its checksum. Window ids are made of the partition and a counter, so a
task that is run again makes the same ones.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ..workers import ship_by_value
from . import alignment, kernels
from .common import read

WINDOW, END_ID, BLOCK = 2048, 1, 512
#: Distinct words whose ids a task remembers.
CACHE = 1_500_000
#: White space beyond ASCII, after which a space may belong to the same run.
OTHER_SPACE = re.compile(b"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def difference(sizes: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin of each item, sums) of k bins of near-equal sums by multiway differencing.

    A partial partition is its bins' sums, rising from 0, and the node in each bin: an item,
    or two nodes put together. Nodes get numbers; ``left`` and ``right`` have their parts.
    """
    n = len(sizes)
    left, right = np.full(n * (k + 1) + k, -1, np.int64), np.full(n * (k + 1) + k, -1, np.int64)
    heap, nodes = [], n
    for i, s in enumerate(sizes):
        sums, bins = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[-1], bins[-1] = s, i
        heap.append((-s, i, sums, bins))
    heapq.heapify(heap)
    turn = n
    while len(heap) > 1:
        _, _, s, x = heapq.heappop(heap)
        _, _, t, y = heapq.heappop(heap)
        y = y[::-1]
        both = np.flatnonzero((x >= 0) & (y >= 0))
        left[nodes:nodes + len(both)], right[nodes:nodes + len(both)] = x[both], y[both]
        bins = np.maximum(x, y)
        bins[both] = np.arange(nodes, nodes + len(both))
        nodes += len(both)
        sums = s + t[::-1]
        order = np.argsort(sums, kind="stable")
        sums, bins = sums[order], bins[order]
        heapq.heappush(heap, (int(sums[0] - sums[-1]), turn, sums - sums[0], bins))
        turn += 1
    of = np.full(nodes, -1, np.int64)
    of[heap[0][3][heap[0][3] >= 0]] = np.flatnonzero(heap[0][3] >= 0)
    for v in range(nodes - 1, n - 1, -1):  # a node's number is above its parts'
        of[left[v]] = of[right[v]] = of[v]
    return of[:n], np.bincount(of[:n], weights=sizes, minlength=k).astype(np.int64)


def pack(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """Bins of at most ``window``, each a list of places: as few as the sum allows, more
    while one is exceeded."""
    if not sizes:
        return []
    k = max(1, -(-sum(sizes) // window))
    while True:
        of, sums = difference(sizes, k)
        over = int(sums.max())
        if over <= window:
            bins: list[list[int]] = [[] for _ in range(k)]
            for i, b in enumerate(of.tolist()):
                bins[b].append(i)
            return [b for b in bins if b]
        k += max(1, k * (over - window) // (2 * window))


class Ids:
    """Token ids of texts, word by word, with a bounded memory of words seen.

    The tokenizer never joins what stands before white space with it, so a text's ids are
    those of its words, each with the white space before it. Texts with white space beyond
    ASCII, whose runs could span such a cut, are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.ranked = alignment.ranked(path, self.tokenizer, alignment.token_bytes(self.tokenizer))
        # a byte-level vocabulary writes each byte as one character
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.forget()

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.ranked:
            try:
                return [self.ranked.encode_ordinary(t) for t in texts]
            except Exception:  # its pattern gives up on very long runs of white space
                pass
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def flat(self, texts: list[str]) -> np.ndarray:
        return np.fromiter(itertools.chain.from_iterable(self.encode(texts)), np.uint32)

    def learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        """Remember the ids of new words. Words that begin with white space and don't end
        with it are encoded joined to long strings, whose ids are told apart by length."""
        plain = np.fromiter((w[0] in b" \t\n\v\f\r" and w[-1] not in b" \t\n\v\f\r" for w in words), bool, len(words))
        joined = [w for w, x in zip(words, plain) if x]
        ids = self.flat([b"".join(joined[i:i + 2000]).decode() for i in range(0, len(joined), 2000)])
        ends = np.cumsum(np.fromiter(map(len, joined), np.int64, len(joined)))
        parts = [np.diff(np.searchsorted(np.cumsum(self.bytes[ids]), ends, "right"), prepend=0)]
        rest = self.encode([w.decode() for w, x in zip(words, plain) if not x])
        parts.append(np.fromiter(map(len, rest), np.int64, len(rest)))
        keys = np.concatenate([keys[plain], keys[~plain]])
        size = np.concatenate(parts)
        new = np.concatenate([ids, np.fromiter(itertools.chain.from_iterable(rest), np.uint32)])
        order = np.argsort(np.concatenate([self.keys, keys]), kind="stable")
        sizes = np.concatenate([np.diff(self.at), size])
        begin = np.concatenate([self.at[:-1], self.at[-1] + np.cumsum(size) - size])
        self.pool = gather(np.concatenate([self.pool, new]), begin[order], sizes[order])
        self.keys = np.concatenate([self.keys, keys])[order]
        self.at = np.concatenate([[0], np.cumsum(sizes[order])])

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.searchsorted(self.keys, keys)
        return place, self.keys[np.minimum(place, len(self.keys) - 1)] == keys if len(self.keys) else np.zeros(len(keys), bool)

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at, self.pool = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def rows(self, raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) for every row of the buffer, in order."""
        texts = raw.tobytes()
        odd = set(np.searchsorted(offsets, [m.start() for m in OTHER_SPACE.finditer(texts)], "right") - 1)
        row, parts = 0, []
        for h, s, e in kernels.runs(raw, offsets, lower=False, lead=True):
            uniq, first, which = np.unique(h, return_index=True, return_inverse=True)
            place, known = self.look_up(uniq)
            if not known.all():
                if len(self.keys) + len(uniq) - known.sum() > CACHE:
                    self.forget()
                    known[:] = False
                new = np.flatnonzero(~known)
                self.learn(uniq[new], [texts[s[i]:e[i]] for i in first[new]])
                place, _ = self.look_up(uniq)
            sizes = np.diff(self.at)[place][which]
            ids = gather(self.pool, self.at[:-1][place][which], sizes)
            upto = np.concatenate([[0], np.cumsum(sizes)])
            # rows that end in this piece
            last = np.searchsorted(offsets, e[-1], "right") - 1
            cuts = upto[np.searchsorted(s, offsets[row + 1:last + 1])]
            begin = 0
            for c in cuts.tolist():
                yield row, self.whole(row, texts, offsets, parts + [ids[begin:c]], odd)
                row, parts, begin = row + 1, [], c
            if begin < len(ids):
                parts.append(ids[begin:])
        while row < len(offsets) - 1:
            yield row, self.whole(row, texts, offsets, parts, odd)
            row, parts = row + 1, []

    def whole(self, row, texts, offsets, parts, odd) -> np.ndarray:
        if row in odd:
            return np.array(self.encode([texts[offsets[row]:offsets[row + 1]].decode()])[0], np.uint32)
        return np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.zeros(0, np.uint32)


def gather(pool: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pool's stretches one after another."""
    at = np.cumsum(size) - size
    return pool[np.repeat(begin - at, size) + np.arange(int(size.sum()))]


def ids_of(path: str) -> Ids:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Ids(path)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   end_id: int = END_ID, block: int = BLOCK) -> DataFrame:
    """A row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length).

    A null or empty text is the end id alone. Rows are documents of their own where ids or
    rows repeat; their id may be null. An empty table gives an empty result. Only the two
    named columns are read. ``tokenizer``: path of a tokenizer file (the public byte-level
    vocabulary by default).
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    id_type = docs.select(id_col).dtypes[0][1]
    schema = f"{id_col} {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rests, counter = ids_of(tokenizer), [], TaskContext.get().partitionId() << 33
        for batch in kernels.slices(batches):
            names_of = batch.column(0)
            raw, offsets = kernels.utf8(batch.column(1))
            pieces: list[tuple] = []
            for row, x in ids.rows(raw, offsets):
                n = len(x) + 1
                x = np.append(x, np.uint32(end_id)).astype("<u4", copy=False)
                for a in range(0, n, window):
                    m = min(window, n - a)
                    piece = (row, a, m, zlib.crc32(x[a:a + m].tobytes()), n)
                    if m == window:
                        pieces.append((*piece, counter, 0, m))
                        counter += 1
                    else:
                        rests.append((names_of[row], *piece[1:]))
            if pieces:
                cols = list(zip(*pieces))
                yield pa.record_batch([names_of.take(pa.array(cols[0])), *[pa.array(c, pa.int64()) for c in cols[1:]]], names)
            while len(rests) >= block:
                yield packed(rests[:block], counter, batch.schema.field(0).type)
                counter += block
                rests = rests[block:]
            kind = batch.schema.field(0).type
        if rests:
            yield packed(rests, counter, kind)

    def packed(rests: list[tuple], counter: int, kind: pa.DataType) -> pa.RecordBatch:
        out = []
        for i, b in enumerate(pack([r[2] for r in rests], window)):
            at, whole = 0, sum(rests[j][2] for j in b)
            for j in b:
                out.append((*rests[j], counter + i, at, whole))
                at += rests[j][2]
        cols = list(zip(*out))
        return pa.record_batch([pa.array([x.as_py() for x in cols[0]], kind), *[pa.array(c, pa.int64()) for c in cols[1:]]], names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def op5(spark, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))


ship_by_value(__name__)
