"""Language identification by compression: the language whose dictionary compresses a text best.

Each language has a zstandard raw-content dictionary made of training texts. A text is reduced to its
letters in lower case and cut into blocks that are compressed with every dictionary; the language with the
smallest sum wins. A prediction is rejected when the best two sums are closer than a margin. Every block of
the whole text is compressed. A short text is repeated first, since the coder stores a few bytes as they are.

Training reads the rows with a language outside the held-out fold. Per language it takes about
``sample_docs`` of them, chosen by a hash of the id, and keeps ``dictionary_bytes`` of their text. These two
bounds are the only ones; the number of languages is that of the table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

SAMPLE_DOCS = 64
FILL = 4  # times SAMPLE_DOCS, where texts are too short to fill a dictionary
DICTIONARY_BYTES = 65_536
BLOCK_BYTES = 2_048
SHORT_BYTES = 256
MARGIN = 0.003
UNKNOWN = "und"
# A search that finds four-byte matches; the fast levels only look for longer ones.
CODER = dict(strategy=zstandard.STRATEGY_GREEDY, min_match=4, window_log=18, hash_log=16, chain_log=16,
             search_log=4, write_checksum=False, write_content_size=False, write_dict_id=False)
NO_LETTERS = re.compile(r"[\W\d_]+")


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether the crc32 of the id as text falls into fold 0; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def letters(text: str) -> str:
    """Words of letters in lower case, one blank before, between and after them."""
    return f" {NO_LETTERS.sub(' ', text.lower()).strip()} "


def train_dictionaries(docs: DataFrame, sample_docs: int = SAMPLE_DOCS,
                       dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Dictionary content per language from the rows of ``docs`` outside the held-out fold.

    The rows are ranked by a hash of the id within their language, so the sample does not depend on the
    layout of the table. A long text gives a slice at a place that the hash chooses, so what texts begin with alike
    does not fill the dictionary; where ``sample_docs`` short texts leave it unfilled, up to ``FILL`` times as many are taken.
    """
    share = max(1, dictionary_bytes // sample_docs)
    places = F.greatest(F.lit(1), F.length("text") - share + 1)
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.rlike(
        F.coalesce("text", F.lit("")), F.lit(r"\p{L}")))
    rows = rows.select("lang", F.xxhash64("doc_id", F.lit("dictionary")).alias("h"), "doc_id",
                       F.substring("text", F.pmod(F.xxhash64("doc_id", F.lit("slice")), places).cast("int") + 1,
                                   F.lit(share)).alias("piece"))
    nth = F.row_number().over(W.partitionBy("lang").orderBy("h", "doc_id", "piece"))
    picked = rows.withColumn("nth", nth).where(F.col("nth") <= FILL * sample_docs)
    out: dict[str, list[bytes]] = {}
    for r in sorted(picked.select("lang", "nth", "piece").collect()):
        out.setdefault(r["lang"], []).append(letters(r["piece"]).encode())
    return {lang: b"".join(ps)[:dictionary_bytes] for lang, ps in sorted(out.items())}


class Compressors:
    """One compressor per language; built once per task."""

    def __init__(self, contents: dict[str, bytes], block_bytes: int = BLOCK_BYTES):
        self.langs = list(contents)
        self.block_bytes = block_bytes
        params = zstandard.ZstdCompressionParameters(**CODER)
        self.coders = []
        for body in contents.values():
            d = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.coders.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress)

    def sizes(self, text: str) -> list[int]:
        data, n = letters(text).encode("utf-8", "replace"), self.block_bytes
        if len(data) < SHORT_BYTES:
            data *= -(-SHORT_BYTES // len(data))
        blocks = [data[i:i + n] for i in range(0, len(data), n)]
        return [sum(len(code(b)) for b in blocks) for code in self.coders]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score in [0, 1] and margin. Ties go to the first language by name."""
        if text is None or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
        rest = [s for i, s in enumerate(sizes) if i != best]
        if not rest:
            return self.langs[best], 1.0, 1.0
        margin = (min(rest) - sizes[best]) / min(rest)
        return self.langs[best], 0.5 + 0.5 * min(1.0, margin / 0.2), margin


def predict_languages(docs: DataFrame, contents: dict[str, bytes], margin: float = MARGIN,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs(doc_id, text)`` plus lang_pred, score, margin and rejected, one row per input row.

    Only the text decides. Null texts and texts without a letter are ``und`` with score 0 and rejected; so is
    everything when nothing was learned. ``rejected`` marks a margin below ``margin``. Other columns of
    ``docs`` come through inside the struct ``doc``, whatever their names.
    """
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Compressors(contents, block_bytes)
        for batch in batches:
            doc = batch.column(0)
            found = [model.predict(t) for t in doc.field("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[2] for f in found], pa.float64()),
                 pa.array([f[0] == UNKNOWN or f[2] < margin for f in found], pa.bool_())],
                ["doc", "lang_pred", "score", "margin", "rejected"])

    own = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    added = T.StructType().add("lang_pred", "string").add("score", "double").add("margin", "double").add(
        "rejected", "boolean")
    return own.mapInArrow(code, T.StructType(own.schema.fields + added.fields))


def accepted(docs: DataFrame, **options) -> DataFrame:
    """The documents whose language is clear, with the columns of ``docs``; ``lang`` is the language found."""
    found = predict_languages(docs, train_dictionaries(docs), **options).where(~F.col("rejected"))
    return found.select(*[(F.col("lang_pred") if c == "lang" else F.col("doc").getField(c)).alias(c)
                          for c in docs.columns])
