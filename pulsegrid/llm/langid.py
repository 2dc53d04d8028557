"""Language identification by compression (operator 7).

For every language a raw-content zstandard dictionary is made of training text. A text is
compressed with each dictionary and the language with the fewest bytes wins; it is
rejected if the margin to the second is narrow. Texts are reduced to lower-case letters
first and compressed in blocks of ``BLOCK`` bytes, because beyond that a text's own content
outweighs the dictionary; the bytes of all blocks are added up, so the whole text counts.

Scale: training takes a bounded sample (``SAMPLE`` texts a language, ``EXCERPT`` characters
of each, ``DICTIONARY`` bytes): the least hash of each of ``SAMPLE`` hash buckets, found with
partial sums. The dictionaries are all that goes to the driver and out to the tasks.
Classifying is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..workers import ship_by_value
from . import kernels
from .common import read

SAMPLE, EXCERPT, DICTIONARY, BLOCK = 128, 2000, 1 << 16, 2048
#: Texts of fewer bytes are compressed four times over.
SHORT = 128
#: Rejected below this share of the second-best size.
MARGIN = 0.002
UNKNOWN = "und"
LETTER, OTHER = regex.compile(r"\p{L}"), regex.compile(r"[^\p{L}\p{M}]+")


def letters(text: str | None) -> bytes:
    """Lower-case words of letters and their marks with one space around each (empty without a letter)."""
    if not LETTER.search(text or ""):
        return b""
    return b" " + OTHER.sub(" ", text.lower()).strip().encode("utf-8", "replace") + b" "


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, bytes]]:
    """(language, dictionary) from the rows with text and language, the most frequent
    language first (it also wins ties); equal rows count once in the sample, and all sampled
    texts have the same share of a dictionary. Empty if there are no such rows."""
    t = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("text is not null and lang is not null")
    t = t.withColumn("h", F.xxhash64("text"))
    picked = t.groupBy("lang", F.pmod("h", F.lit(SAMPLE)).alias("bucket")).agg(F.min("h").alias("h"), F.count("*").alias("n"))
    # a stretch from anywhere in the text, as its hash says
    start = F.pmod("h", F.greatest(F.length("text") - EXCERPT + 1, F.lit(1))).cast("int") + 1
    excerpts = t.join(F.broadcast(picked), ["lang", "h"]).groupBy("lang", "h", "n").agg(F.min(F.substring("text", start, F.lit(EXCERPT))).alias("text"))
    by: dict[str, list] = {}
    for r in excerpts.orderBy("lang", "h").collect():  # SAMPLE short excerpts a language
        by.setdefault(r.lang, []).append(r)
    order = sorted(by, key=lambda x: (-sum(r.n for r in by[x]), x))
    return [(x, b"".join(letters(r.text)[:DICTIONARY // len(by[x])] for r in by[x])) for x in order]


class Classifier:
    def __init__(self, model: list[tuple[str, bytes]], margin: float = MARGIN):
        self.margin, self.names, self.by = margin, [x for x, _ in model], []
        p = zstandard.ZstdCompressionParameters.from_level(5, min_match=3, strategy=zstandard.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0)
        for _, content in model:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=p)
            self.by.append(zstandard.ZstdCompressor(dict_data=d, compression_params=p))

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """(language, margin as a share of the second-best size, rejected)"""
        b = letters(text)
        if not b or not self.by:
            return UNKNOWN, 0.0, True
        if len(b) < SHORT:  # a few bytes alone are stored as they are, whatever the dictionary
            b = b * 4
        blocks = [b[i:i + BLOCK] for i in range(0, len(b), BLOCK)]
        sizes = [sum(len(c.compress(x)) for x in blocks) for c in self.by]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        second = min((s for i, s in enumerate(sizes) if i != best), default=None)
        score = 1.0 if second is None else 1 - sizes[best] / second
        return self.names[best], score, score < self.margin


def identify(docs: DataFrame, model: list[tuple[str, bytes]], text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """The input with ``lang_pred``, ``score`` (0 to 1) and ``rejected`` added; input columns of
    these names are replaced.

    A null text, or one without a letter, is ``und`` with score 0 and rejected, as is every
    text if the model is empty. Ties go to the more frequent language and are rejected.
    Equal texts get equal results; an empty table gives an empty result.
    """
    own = ("lang_pred", "score", "rejected")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in own])
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(model, margin)
        for batch in kernels.slices(batches):
            found = [classify(t.as_py()) for t in batch.column(place)]
            cols = [pa.array([f[i] for f in found], k) for i, k in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, *own])

    schema = StructType([*docs.schema.fields, *StructType.fromDDL("lang_pred string, score double, rejected boolean").fields])
    return docs.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    """The rows with an id that are not held out."""
    return docs.filter(~held_out() & F.col("doc_id").isNotNull())


def op7(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit(learnable(docs)))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


ship_by_value(__name__)
