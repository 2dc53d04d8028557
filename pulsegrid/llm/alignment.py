"""Cross-tokenizer alignment by an associative fragment monoid (operator 11).

A text is encoded by a byte-level tokenizer (A, of a space and the text) and by a tokenizer
of pieces (B, which adds the space). Byte offsets where tokens of both end cut the tokens into
groups. A byte range of a text has the tokens that start in it and yields a fragment:

* an open prefix: its tokens up to the first offset where both end (all, if there is none),
* closed groups,
* an open suffix: the tokens after the last such offset.

Two neighbouring fragments compose: the suffix of one and the prefix of the other make closed
groups, or stay open. Composition is associative, so the fragments of a long text, made by
different tasks, are reduced as a tree: ``FAN`` neighbours at once, round by round. Closed
groups are written out where they arise, with their place in the text, and don't travel
through the tree.

Tasks get a byte range with the whole words that it cuts: a text is taken apart at single
spaces that have no white space beside them, where the pattern of A and the pieces of B part
too (none has a space after another character). Ranges cut words, and with them tokens,
wherever their bytes end. All ranges of a batch are aligned at once in numpy.

Scale: texts of up to ``RANGE`` bytes are one range each and are worked on where they are read;
only ranges of longer ones are moved. Texts are encoded once: what is kept of them are numbers,
digests and the packed counts of their id pairs (a few bytes a pair), in a checkpoint. Counts
are added up in the task and then by Spark. Of the counts, the ``TABLE`` most frequent pairs
(16 bytes each) and the highest of each B id (as many as B's vocabulary has) are sent to the
tasks of the second pass; links of other pairs are joined with the table of counts. A text's
digest needs its groups in order: they pass through one task for a text, as a stream.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..workers import ship_by_value
from . import kernels
from .common import cut, read

RANGE, FAN, TABLE = 1 << 16, 8, 1 << 20
#: Bytes that are aligned at once (at least a range), and id pairs that a task holds.
AT_ONCE, KEEP = 1 << 19, 1 << 19
#: A single space between characters that are no white space: printable ASCII, or of first bytes
#: (C3 to DF, E0, E4 to F4) that no white space and not B's own sign for it begins with.
CUT = re.compile(rb"(?:(?<=[!-~])|(?<=[\xc3-\xdf].)|(?<=[\xe0\xe4-\xef]..)|(?<=[\xf0-\xf4]...)) (?=[!-~\xc3-\xe0\xe4-\xf4])", re.DOTALL)
ID_BITS = 17

#: Tokens of one side, each ``end << ID_BITS | id``, by end.
Tokens = list[int]
#: A group's links are codes ``a << ID_BITS | b``.
Group = tuple[str, list[int]]


class Fragment(NamedTuple):
    """``closed``: there is an offset where both end; if not, all tokens are in the head."""

    closed: bool
    head: tuple[Tokens, Tokens]
    tail: tuple[Tokens, Tokens]


EMPTY: tuple[Tokens, Tokens] = ([], [])


def align(a: Tokens, b: Tokens) -> tuple[list[Group], tuple[Tokens, Tokens]]:
    """The closed groups of tokens that start together, and what is open after them."""
    mask, groups, i, j, i0, j0, links = (1 << ID_BITS) - 1, [], 0, 0, 0, 0, []
    while i < len(a) and j < len(b):
        links.append((a[i] & mask) << ID_BITS | b[j] & mask)
        x, y = a[i] >> ID_BITS, b[j] >> ID_BITS
        i, j = i + (x <= y), j + (y <= x)
        if x == y:
            groups.append((",".join(str(t & mask) for t in a[i0:i]) + "|" + ",".join(str(t & mask) for t in b[j0:j]), links))
            i0, j0, links = i, j, []
    return groups, (a[i0:], b[j0:])


def fragment(a: Tokens, b: Tokens) -> tuple[Fragment, list[Group]]:
    """The fragment of tokens that need not start together, and its closed groups."""
    ends = {t >> ID_BITS for t in a}
    first = next((t >> ID_BITS for t in b if t >> ID_BITS in ends), None)
    if first is None:
        return Fragment(False, (a, b), EMPTY), []
    i, j = (sum(t >> ID_BITS <= first for t in side) for side in (a, b))
    groups, tail = align(a[i:], b[j:])
    return Fragment(True, (a[:i], b[:j]), tail), groups


def compose(f: Fragment, g: Fragment) -> tuple[Fragment, list[Group]]:
    """Two neighbouring fragments as one, and the groups that close between them."""
    if not f.closed:
        made, groups = fragment(f.head[0] + g.head[0], f.head[1] + g.head[1])
        return (Fragment(True, made.head, g.tail) if g.closed else made), groups
    groups, rest = align(f.tail[0] + g.head[0], f.tail[1] + g.head[1])
    return Fragment(True, f.head, g.tail if g.closed else rest), groups


# --- encoding


def byte_of() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable ones for
    themselves, the others in order for what comes after 255."""
    plain = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174]
    others = [x for x in range(256) if x not in plain]
    return {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(others)}


def token_bytes(tokenizer) -> dict[int, bytes]:
    """The bytes of each id of a byte-level tokenizer; special tokens are their own text."""
    of, special = byte_of(), {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    return {i: t.encode() if t in special else bytes(of[c] for c in t) for t, i in tokenizer.get_vocab().items()}


def ranked(path: str, tokenizer, of: dict[int, bytes]):
    """The encoding of a byte-level tokenizer file by ranks, which is the same and several times
    faster; None where ids are not in the order of the merges."""
    import public_tokenizers
    import tiktoken

    with open(path) as file:
        merges = json.load(file)["model"]["merges"]
    parts = [x if isinstance(x, list) else x.split(" ") for x in merges]
    if not all(tokenizer.token_to_id(x + y) == 256 + i for i, (x, y) in enumerate(parts)):
        return None
    ranks = {t: i for i, t in of.items() if i < 256 + len(parts)}
    return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoders:
    """Both tokenizers, the bytes of their tokens, and the texts of ids as groups are written:
    in one list, those of A and then of B, each before a comma and before what ends its side."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = token_bytes(self.a)
        self.ranked = ranked(a_path, self.a, self.a_bytes)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece of B has a space after another character: texts can't be cut there")
        n_a, n_b = max(self.a_bytes) + 1, len(pieces)
        if max(n_a, n_b) >> ID_BITS:
            raise ValueError(f"ids have {ID_BITS} bits")
        self.length = np.zeros(n_a, np.int64), np.array([len(x) for x in self.b_bytes])
        for i, t in self.a_bytes.items():
            self.length[0][i] = len(t)
        self.texts = [f"{i}{end}" for n, last in ((n_a, "|"), (n_b, ";")) for end in (",", last) for i in range(n)]

    def a_ids(self, text: str) -> list[int]:
        if self.ranked:
            try:
                return self.ranked.encode_ordinary(text)
            except Exception:  # its pattern gives up on very long runs of white space
                pass
        return self.a.encode(text, add_special_tokens=False).ids

    def ids(self, raw: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of a space and the text after it; None if the bytes are not those of both sides."""
        text = raw.decode()
        a, b = self.a_ids(text), self.b.encode(text[1:])
        for ids, of in ((a, self.a_bytes), (b, self.b_bytes)):
            if b"".join(map(of.__getitem__, ids)) != raw:
                return None
        return np.array(a, np.int64), np.array(b, np.int64)


class Unit(NamedTuple):
    """What a byte range yields: the tokens that start in it, its fragment, and its closed groups."""

    n_a: int
    n_b: int
    fragment: Fragment
    groups: str
    n_groups: int
    codes: np.ndarray
    n: np.ndarray


def units(encoders: Encoders, parts: list[tuple[bytes, int, int, int]]) -> Iterator[Unit | None]:
    """``aligned`` for any number of ranges, some at once."""
    some, held = [], 0
    for p in parts:
        some.append(p)
        held += len(p[0])
        if held >= AT_ONCE:
            yield from aligned(encoders, some)
            some, held = [], 0
    if some:
        yield from aligned(encoders, some)


def aligned(encoders: Encoders, parts: list[tuple[bytes, int, int, int]]) -> list[Unit | None]:
    """The ranges (bytes, base, skip, stop) of texts: of the tokens of ``bytes`` those that start
    at ``skip`` to ``stop``, at places of the text that are ``base`` more. None where the bytes
    of the tokens are others. All ranges are aligned at once.

    Where skip is 0 both sides start together, as a text does, and no prefix is open.
    """
    ids: tuple[list, list] = ([], [])
    ends: tuple[list, list] = ([], [])
    good, room = [], 1 + max((len(p[0]) for p in parts), default=0)
    for u, (raw, _, skip, stop) in enumerate(parts):
        found = encoders.ids(raw)
        good.append(found is not None)
        for side, x in enumerate(found or ()):
            end = np.cumsum(encoders.length[side][x])
            start = end - encoders.length[side][x]
            own = slice(*np.searchsorted(start, (skip, stop)))
            ids[side].append(x[own])
            ends[side].append(end[own] + u * room)  # ranges one after another
    x, y = (np.concatenate([np.zeros(0, np.int64), *side]) for side in ids)
    ex, ey = (np.concatenate([np.zeros(0, np.int64), *side]) for side in ends)
    both = np.intersect1d(ex, ey, assume_unique=True)
    starts = np.arange(len(parts)) * room
    first, last = np.searchsorted(both, starts, "right"), np.searchsorted(both, starts + room, "right") - 1
    closed = last >= first
    whole = np.array([p[2] == 0 for p in parts], bool)
    low = np.where(whole | ~closed, starts, both[np.minimum(first, len(both) - 1)] if len(both) else starts)
    high = np.where(closed, both[last] if len(both) else starts, starts)
    # tokens and common ends of the closed groups
    ux, uy, ub = ((e - 1) // room for e in (ex, ey, both))
    in_x, in_y, in_b = (ex > low[ux]) & (ex <= high[ux]), (ey > low[uy]) & (ey <= high[uy]), (both > low[ub]) & (both <= high[ub])
    cx, cy, cex, cey, cb = x[in_x], y[in_y], ex[in_x], ey[in_y], both[in_b]
    gx, gy = np.searchsorted(cb, cex), np.searchsorted(cb, cey)
    upto_x, upto_y = np.searchsorted(gx, np.arange(len(cb) + 1)), np.searchsorted(gy, np.arange(len(cb) + 1))
    # a group's texts: its tokens of A, then of B
    n_a, n_b = (len(side) for side in encoders.length)
    text = np.zeros(len(cx) + len(cy), np.int64)
    text[np.arange(len(cx)) + upto_y[gx]] = cx + n_a * (cex == cb[gx])
    text[np.arange(len(cy)) + upto_x[gy + 1]] = cy + 2 * n_a + n_b * (cey == cb[gy])
    tokens_at = np.searchsorted(cex, starts) + np.searchsorted(cey, starts)
    written = list(map(encoders.texts.__getitem__, text.tolist()))
    # a link for each offset where a token of either side ends
    offsets = np.sort(np.concatenate([cex, cey]), kind="stable")  # two sorted runs
    offsets = offsets[np.diff(offsets, prepend=-1) > 0]
    code = cx[np.searchsorted(cex, offsets)] << ID_BITS | cy[np.searchsorted(cey, offsets)]
    pair, n = np.unique((offsets - 1) // room << 2 * ID_BITS | code, return_counts=True)
    codes_at = np.searchsorted(pair, np.arange(len(parts) + 1) << 2 * ID_BITS)
    groups_at = np.searchsorted(cb, np.append(starts, len(parts) * room), "right")
    tokens_at = np.append(tokens_at, len(text))
    at = [np.searchsorted(e, np.append(starts, len(parts) * room), "right") for e in (ex, ey)]
    out: list[Unit | None] = []
    for u, (_, base, _, _) in enumerate(parts):
        if not good[u]:
            out.append(None)
            continue
        sides = [(e[a[u]:a[u + 1]], i[a[u]:a[u + 1]]) for e, i, a in zip((ex, ey), (x, y), at)]
        head, tail = (tuple(((e[m] - u * room + base) << ID_BITS | i[m]).tolist() for e, i in sides for m in [pick(e)])
                      for pick in (lambda e: e <= low[u] if closed[u] else e > 0, lambda e: (e > high[u]) & closed[u]))
        p = slice(codes_at[u], codes_at[u + 1])
        out.append(Unit(len(sides[0][0]), len(sides[1][0]), Fragment(bool(closed[u]), head, tail), "".join(written[tokens_at[u]:tokens_at[u + 1]])[:-1],
                        int(groups_at[u + 1] - groups_at[u]), pair[p] & (1 << 2 * ID_BITS) - 1, n[p]))
    return out


def ranges(text: bytes, size: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(number, base, skip, stop, bytes) of the byte ranges of a space and the text: about
    ``size`` bytes each, cut inside a word, with the words that they cut."""
    raw, k, start, skip = b" " + text, 0, 0, 0
    while True:
        m = CUT.search(raw, start + skip + size)
        if not m:
            yield k, start, skip, len(raw) - start, raw[start:]
            return
        after = CUT.search(raw, m.end())
        end = after.start() if after else len(raw)
        yield k, start, skip, (m.start() + end) // 2 - start, raw[start:end]
        k, start, skip = k + 1, m.start(), (m.start() + end) // 2 - m.start()


# --- Spark


def packed(codes: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted codes and their counts, by differences and byte by byte, so that few bytes are left."""
    x = np.stack([np.diff(codes, prepend=0), n.astype(np.int64)])
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    x = np.ascontiguousarray(x.T).view(np.int64).reshape(2, -1)
    return np.cumsum(x[0]), x[1]


def summed(codes: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    code, where = np.unique(np.concatenate([np.zeros(0, np.int64), *codes]), return_inverse=True)
    return code, np.bincount(where, weights=np.concatenate([np.zeros(0, np.int64), *n]), minlength=len(code)).astype(np.int64)


def pair_counts(links: DataFrame) -> DataFrame:
    """(code, n) of the packed column ``links``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> int:
            if held:
                held[:] = [summed(*map(list, zip(*held)))]
            return len(held[0][0]) if held else 0

        for b in kernels.slices(batches):
            held.extend(map(unpacked, filter(None, b.column(0).to_pylist())))
            if sum(len(c) for c, _ in held) > KEEP and merged() > KEEP // 2:
                yield pa.record_batch([pa.array(held[0][0]), pa.array(held[0][1])], ["code", "n"])
                held.clear()
        if merged():
            yield pa.record_batch([pa.array(held[0][0]), pa.array(held[0][1])], ["code", "n"])

    return links.select("links").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def valued(rows: DataFrame, counts) -> DataFrame:
    """(row, n_best, count_sum, rest, rest_n) of (row, links): sums over the links whose pair the
    table has, and the links of other pairs."""
    schema = StructType.fromDDL("row long, n_best long, count_sum long, rest array<long>, rest_n array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n, best = counts.value
        mask = (1 << ID_BITS) - 1
        for b in kernels.slices(batches, 256):
            links = [unpacked(x) if x else (np.zeros(0, np.int64),) * 2 for x in b.column(1).to_pylist()]
            code, k = (np.concatenate(side) for side in zip(*links))
            if len(codes):
                place = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                count = np.where(codes[place] == code, n[place], 0)
            else:
                count = np.zeros(len(code), np.int64)
            at = np.cumsum([0, *(len(c) for c, _ in links)])
            sums = [np.append(0, np.cumsum(v)) for v in (k * ((count > 0) & (count == best[code & mask])), k * count)]
            out = count == 0
            rest = [(code[p][out[p]], k[p][out[p]]) for p in map(slice, at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(s[at[1:]] - s[at[:-1]]) for s in sums], *[pa.array([r[i] for r in rest], pa.list_(pa.int64())) for i in (0, 1)]], names=schema.names)

    return rows.select("row", "links").mapInArrow(run, schema)


def short_rows(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """A row for each of (id, text), texts of one range each: numbers, digest and packed links."""
    schema = StructType([docs.schema["id"], *StructType.fromDDL("row long, n_a long, n_b long, n_groups long, n_links long, sha string, links binary").fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders, row = Encoders(*paths), -1 - (TaskContext.get().partitionId() << 33)
        for b in kernels.slices(batches, 256):
            texts = b.column(1).cast(pa.large_binary()).to_pylist()
            found = units(encoders, [(b" " + t, 0, 0, len(t) + 1) for t in texts if t])
            out = []
            for t in texts:
                row -= 1
                x = next(found) if t else None
                if x:
                    out.append((row, x.n_a, x.n_b, x.n_groups, int(x.n.sum()), hashlib.sha256(x.groups.encode()).hexdigest(), packed(x.codes, x.n)))
                else:
                    out.append((row, 0, 0, 0, 0, "", None))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, f.type) for c, f in zip(zip(*out), list(arrow)[1:])]], names=schema.names)

    return docs.select("id", "text").mapInArrow(run, schema)


SIDES = "head_a array<long>, head_b array<long>, tail_a array<long>, tail_b array<long>"
GROUPS = "key int, groups string, n_groups long, n_links long, links binary"


def between(key: int, groups: list[Group]) -> tuple:
    links = [x for g in groups for x in g[1]]
    return key, ";".join(g[0] for g in groups), len(groups), len(links), packed(*np.unique(np.array(links, np.int64), return_counts=True))


def leaves(docs: DataFrame, paths: tuple[str, str], size: int) -> DataFrame:
    """For each byte range of each of (id, text): its fragment and its closed groups."""
    cut_up = StructType([docs.schema["id"], *StructType.fromDDL("row long, k int, base long, skip long, stop long, bytes binary").fields])
    schema = StructType([docs.schema["id"], *StructType.fromDDL(f"row long, k int, good boolean, n_a long, n_b long, closed boolean, {SIDES}, {GROUPS}").fields])
    arrow = to_arrow_schema(schema)

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for b in kernels.slices(batches, 16):
            for i in range(b.num_rows):
                for r in ranges(b.column(1)[i].as_py().encode(), size):
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), pa.array([row]), pa.array([r[0]], pa.int32()), *[pa.array([x], pa.int64()) for x in r[1:4]], pa.array([r[4]], pa.binary())], names=cut_up.names)
                row += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = Encoders(*paths)
        for b in kernels.slices(batches, 16):
            rows, ks, *rest, raws = (b.column(i).to_pylist() for i in range(1, 7))
            out = []
            for row, k, x in zip(rows, ks, units(encoders, list(zip(raws, *rest)))):
                if x:
                    out.append((row, k, True, x.n_a, x.n_b, x.fragment.closed, *x.fragment.head, *x.fragment.tail, 2 * k + 1, x.groups, x.n_groups, int(x.n.sum()), packed(x.codes, x.n)))
                else:
                    out.append((row, k, False, 0, 0, False, [], [], [], [], 2 * k + 1, "", 0, 0, None))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, f.type) for c, f in zip(zip(*out), list(arrow)[1:])]], names=schema.names)

    return docs.select("id", "text").mapInArrow(divide, cut_up).repartition("row", "k").mapInArrow(run, schema)


def reduced(state: DataFrame, fan: int) -> DataFrame:
    """One round: each ``fan`` neighbouring fragments of (row, k, lo, closed, sides) as one, and
    (with closed null) the groups that close between them."""
    schema = StructType.fromDDL(f"row long, k int, lo int, closed boolean, {SIDES}, {GROUPS}")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = held = None
        for b in batches:
            out = []
            for row, k, lo, closed, ha, hb, ta, tb in zip(*(b.column(i).to_pylist() for i in range(8))):
                f = Fragment(closed, (ha, hb), (ta, tb))
                if name is not None and name[:2] == (row, k // fan):
                    held, groups = compose(held, f)
                    if groups:
                        out.append((row, None, None, None, None, None, None, None, *between(2 * lo, groups)))
                    continue
                if name is not None:
                    out.append((*name, held.closed, *held.head, *held.tail, *[None] * 5))
                name, held = (row, k // fan, lo), f
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], names=schema.names)
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*name, held.closed, *held.head, *held.tail, *[None] * 5), arrow)], names=schema.names)

    s = state.select("row", "k", "lo", "closed", "head_a", "head_b", "tail_a", "tail_b")
    return s.repartition("row", F.floor(F.col("k") / fan)).sortWithinPartitions("row", "k").mapInArrow(run, schema)


def long_parts(made: DataFrame, fan: int) -> DataFrame:
    """(row, key, groups, n_groups, n_links, links) of long texts: the closed groups of the ranges
    and, from the tree, of what stands between them; keys are in order of place."""
    columns = ["row", *[x.split()[0] for x in GROUPS.split(", ")]]
    parts, state = made.select(*columns), made.withColumn("lo", F.col("k"))
    most = made.agg(F.max("k")).first()[0] or 0
    while most:
        step = cut(reduced(state, fan))
        parts = parts.unionByName(step.filter("closed is null").select(*columns))
        state, most = step.filter("closed is not null"), most // fan
    return parts


def digests(parts: DataFrame) -> DataFrame:
    """(row, sha) of the groups of each row in order of key, read as a stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = h = None
        for b in batches:
            for r, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if r != row:
                    if h:
                        yield pa.record_batch([pa.array([row]), pa.array([h.hexdigest()])], ["row", "sha"])
                    row, h, lead = r, hashlib.sha256(), ""
                if text:
                    h.update((lead + text).encode())
                    lead = ";"
        if h:
            yield pa.record_batch([pa.array([row]), pa.array([h.hexdigest()])], ["row", "sha"])

    return parts.select("row", "key", "groups").repartition("row").sortWithinPartitions("row", "key").select("row", "groups").mapInArrow(run, "row long, sha string")


def align_documents(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", size: int = RANGE,
                    fan: int = FAN, table: int = TABLE) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per document.

    Null and empty texts, and texts whose tokens' bytes on either side are not those of a space
    and the text, have no tokens: zeros and an empty digest; none of their links is counted.
    Rows are documents of their own where ids or rows repeat; ids may be null. An empty table
    gives an empty result. Only the two named columns are read. ``a_path`` is a byte-level
    tokenizer file, ``b_path`` a model of pieces with byte fallback (the public ones by
    default). The result does not depend on ``size``, ``fan`` and ``table``: the bytes of a
    range, the fragments composed at once and the id pairs whose counts are sent to tasks.
    """
    if a_path is None or b_path is None:
        import public_tokenizers

        a_path = a_path or public_tokenizers.path("byte_bpe_50k.json")
        b_path = b_path or public_tokenizers.path("piece_bpe_32k.model")
    paths = (a_path, b_path)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    is_long = F.coalesce(F.octet_length("text") > size, F.lit(False))
    rows, made = cut(short_rows(d.filter(~is_long), paths)), cut(leaves(d.filter(is_long), paths, size))
    parts = long_parts(made, fan)
    bad = made.filter("not good").select("row").distinct()
    good = parts.join(bad, "row", "left_anti")
    linked = rows.select("row", "links").unionByName(good.select("row", "links"))

    pairs = cut(pair_counts(linked))
    b_id = F.col("code").bitwiseAND((1 << ID_BITS) - 1)
    tops = pairs.groupBy(b_id.alias("b")).agg(F.max("n").alias("best"))
    best = np.zeros(1 << ID_BITS, np.int64)
    for r in tops.collect():  # as many rows as B has ids at most
        best[r.b] = r.best
    top = pairs.orderBy(F.desc("n"), "code").limit(table).toPandas().sort_values("code")
    shared = d.sparkSession.sparkContext.broadcast((top["code"].to_numpy(np.int64), top["n"].to_numpy(np.int64), best))

    sums = valued(linked, shared)
    if len(top) == table:  # there may be pairs beyond the table
        sums = cut(sums)
        rest = sums.select("row", F.explode(F.arrays_zip("rest", "rest_n")).alias("x")).select("row", F.col("x.rest").alias("code"), F.col("x.rest_n").alias("k"))
        rest = rest.join(pairs, "code").join(tops, b_id == F.col("b"))
        more = rest.select("row", F.when(F.col("n") == F.col("best"), F.col("k")).otherwise(0).alias("n_best"), (F.col("k") * F.col("n")).alias("count_sum"))
        sums = sums.select("row", "n_best", "count_sum").unionByName(more)
    total = lambda t, *names: t.groupBy("row").agg(*[F.sum(c).alias(c) for c in names])
    of_long = total(good, "n_groups", "n_links").join(total(made, "n_a", "n_b"), "row").join(digests(parts), "row")
    long_rows = made.filter("k = 0").select("id", "row").join(of_long, "row", "left")
    names = ["n_a", "n_b", "n_groups", "n_links"]
    every = rows.select("id", "row", *names, "sha").unionByName(long_rows.select("id", "row", *names, "sha"))
    every = every.join(total(sums, "n_best", "count_sum"), "row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return every.select(F.col("id").alias(id_col), *map(zero, [*names, "n_best", "count_sum"]), F.coalesce("sha", F.lit("")).alias("groups_sha256"))


def op11(spark, sf_dir: str) -> DataFrame:
    return align_documents(read(spark, sf_dir, "documents"))


ship_by_value(__name__)
