"""Phrase collocations from sorted count streams.

A word occurrence stands for the phrases that start at it, so one row per position (up to three words, cut
at the end of its piece) carries all counts. Map tasks fold repeated rows; the rest is one external sort in
prefix order, where every phrase is followed by its extensions. One pass in lockstep over the
sorted rows closes languages, words, pairs and triples as their prefixes end and adds up their counts; only what
touches the border of a range is added up once more. Phrases below the least count go no further.

The stream of the remaining counts is kept in two orders. In prefix order the last word and the last pair
before a phrase are its left parts, in suffix order (words reversed) its right parts, and a triple meets the
two pairs that it extends. No count is looked up by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.operators.running import Running, running
from millrace.session import stage_table

# Fixed: what ends a piece and what parts words.
PIECE_ENDS, WORD_GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"

LEAST = 10
TOP = 2_000
KILL_PERCENT = 50
CHUNK_BYTES = 8 << 20
PIECE_ROWS = 250_000

POSITIONS = "key string, f long"
COUNTS = "key string, words int, f long, edge boolean"

_KIND = np.zeros(256, np.uint8)
_KIND[list(WORD_GAPS)] = 1
_KIND[list(PIECE_ENDS)] = 2
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32


def _strings(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [
        None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def _fold(columns: list[np.ndarray], sizes: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of small numbers and how often each occurs."""
    left = columns
    while sum(int(s).bit_length() for s in sizes) > 62:  # the last two columns become one
        pairs, low = np.unique(left[-2].astype(np.int64) * sizes[-1] + left[-1], return_inverse=True)
        left, sizes = [*left[:-2], low], [*sizes[:-2], len(pairs)]
    key = left[0].astype(np.int64)
    for column, size in zip(left[1:], sizes[1:]):
        key = key * size + column
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    return [c[first] for c in columns], counts


def count_positions(langs: pa.Array, texts: pa.Array) -> pa.Table:
    """``key, f`` for the phrases of up to three words at every word of a few texts; repeated ones folded.

    A key is the language, a line feed, and each word followed by a tab; neither occurs inside its parts.
    """
    sizes = pc.binary_length(texts).to_numpy()
    data = _SMALL[np.frombuffer(b"".join(texts.to_pylist()), np.uint8)]
    ends = np.cumsum(sizes)
    begins = np.zeros(len(data) + 1, bool)
    begins[ends - sizes] = True  # an empty text marks where the next one starts
    kind = _KIND[data]
    inside = kind == 0
    start = inside.copy()
    start[1:] &= ~inside[:-1] | begins[1:-1]
    at = np.flatnonzero(start)
    if not len(at):
        return pa.table({"key": pa.array([], pa.string()), "f": pa.array([], pa.int64())})
    # words without what stands between them, as one dictionary
    kept = np.cumsum(inside)
    dictionary = _strings(np.append(kept[at] - 1, kept[-1]), data[inside]).dictionary_encode()
    word = dictionary.indices.to_numpy()
    piece = np.cumsum((kind == 2) | begins[:-1], dtype=np.int32)[at]
    names = langs.dictionary_encode()
    lang = names.indices.to_numpy()[np.searchsorted(ends, at, side="right")]
    n = len(dictionary.dictionary)
    second, third = np.full(len(at), n), np.full(len(at), n)  # n: the piece has ended
    same = piece[1:] == piece[:-1]
    second[:-1][same] = word[1:][same]
    same = piece[2:] == piece[:-2]
    third[:-2][same] = word[2:][same]
    rows, counts = _fold([lang, word, second, third], [len(names.dictionary), n + 1, n + 1, n + 1])
    words = pa.concat_arrays([pc.binary_join_element_wise(dictionary.dictionary, pa.scalar(b"", pa.large_binary()),
                                                          pa.scalar(b"\t", pa.large_binary())),
                              pa.array([b""], pa.large_binary())])
    heads = pc.binary_join_element_wise(names.dictionary.cast(pa.large_binary()), pa.scalar(b"", pa.large_binary()),
                                        pa.scalar(b"\n", pa.large_binary()))
    parts = [heads.take(pa.array(rows[0]))] + [words.take(pa.array(r)) for r in rows[1:]]
    keys = pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.large_binary()))
    return pa.table({"key": keys.cast(pa.large_string()).cast(pa.string()), "f": pa.array(counts, pa.int64())})


def _pieces_of(text: bytes, limit: int) -> Iterator[bytes]:
    """A long text in parts that end where a piece ends."""
    at = 0
    while len(text) - at > limit:
        cut = max(text.rfind(bytes([b]), at, at + limit) for b in PIECE_ENDS)
        if cut < at:
            cut = min((i for i in (text.find(bytes([b]), at + limit) for b in PIECE_ENDS) if i >= 0), default=len(text) - 1)
        yield text[at:cut + 1]
        at = cut + 1
    yield text[at:]


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    langs, texts, held = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            for part in _pieces_of(text, CHUNK_BYTES):
                langs.append(lang)
                texts.append(part)
                held += len(part)
                if held >= CHUNK_BYTES:
                    yield from count_positions(pa.array(langs, pa.string()), pa.array(texts, pa.large_binary())).to_batches()
                    langs, texts, held = [], [], 0
    if texts:
        yield from count_positions(pa.array(langs, pa.string()), pa.array(texts, pa.large_binary())).to_batches()


class Level:
    """One prefix length of the sorted rows: the prefix that is open and its count so far."""

    def __init__(self, words: int, least: int):
        self.words, self.least, self.open, self.f, self.first = words, least, None, 0, True

    def _rows(self, keys: list, f: list, edge: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array(np.full(len(f), self.words, np.int32)), pa.array(f, pa.int64()),
             pa.array(edge, pa.bool_())], names=["key", "words", "f", "edge"])

    def add(self, prefixes: pa.Array, f: np.ndarray) -> pa.RecordBatch:
        """The prefixes that ended; those at the border of the range whatever their count."""
        if not len(f):
            return self._rows([], [], [])
        new = np.concatenate([[True], pc.not_equal(prefixes[1:], prefixes[:-1]).to_numpy(zero_copy_only=False)])
        at = np.flatnonzero(new)
        sums, names = np.add.reduceat(f, at), prefixes.take(pa.array(at))
        head = names[0].as_py()
        keys, counts, edges = [], [], []
        if self.open is not None and self.open != head:
            if self.first or self.f >= self.least:
                keys, counts, edges = [self.open], [self.f], [self.first]
            self.f, self.first = 0, False
        if len(at) == 1:
            self.open, self.f = head, self.f + int(sums[0])
            return self._rows(keys, counts, edges)
        sums[0] += self.f  # what was open goes on
        ended = sums[:-1]
        keep = ended >= self.least
        keep[0] |= self.first
        edge = np.zeros(len(ended), bool)
        edge[0] = self.first
        keys += names[:-1].filter(pa.array(keep)).to_pylist()
        self.open, self.f, self.first = names[len(at) - 1].as_py(), int(sums[-1]), False
        return self._rows(keys, counts + ended[keep].tolist(), edges + edge[keep].tolist())

    def close(self) -> pa.RecordBatch:
        return self._rows([] if self.open is None else [self.open], [] if self.open is None else [self.f],
                          [] if self.open is None else [True])


def _lockstep(least: int):
    """Counts of all prefixes of sorted ``key, f, p0, p1, p2`` rows."""
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = [Level(words, least) for words in range(4)]
        for batch in batches:
            f = batch.column(1).to_numpy()
            words = pc.count_substring(batch.column(0), "\t").to_numpy(zero_copy_only=False)
            for level, column in zip(levels, (2, 3, 4, 0)):
                prefixes, counts = batch.column(column), f
                if level.words > 1:  # rows that ended earlier are no phrase of this length
                    longer = words >= level.words
                    prefixes, counts = prefixes.filter(pa.array(longer)), f[longer]
                yield level.add(prefixes, counts)
        for level in levels:
            yield level.close()
    return walk


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``key, words, f`` of all languages (0 words) and of the phrases of 1 to 3 words that occur ``least`` times.

    Keys are prefixes as in ``count_positions``, without their last separator.
    """
    lang = F.coalesce("lang", F.lit("und"))
    for char, code in (("%", "%25"), ("\t", "%09"), ("\n", "%0A")):
        lang = F.replace(lang, F.lit(char), F.lit(code))
    rows = docs.select(lang.alias("lang"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_positions, POSITIONS)
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key")
    prefixes = ordered.select("key", "f", F.substring_index("key", "\n", 1).alias("p0"),
                              F.substring_index("key", "\t", 1).alias("p1"), F.substring_index("key", "\t", 2).alias("p2"))
    counted = stage_table(prefixes.mapInArrow(_lockstep(least), COUNTS), "phrases")
    whole = F.regexp_replace("key", r"\t\z", "")  # the longest prefix is the key itself
    met = counted.where("edge").groupBy(whole.alias("key"), "words").agg(F.sum("f").alias("f"))
    return counted.where("NOT edge").select(whole.alias("key"), "words", "f").union(
        met.where((F.col("f") >= least) | (F.col("words") == 0)))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers of up to 38 digits."""
    wide = lambda c: c.cast("decimal(15,0)")
    square = (wide(a) * wide(a)).cast("decimal(30,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", square.cast("decimal(38,0)"), (wide(left) * wide(right)).cast("decimal(30,0)"))


def _with_parts(counts: DataFrame, order: str, name: str, piece_rows: int) -> DataFrame:
    """The last word and the last pair before each phrase in ``order``: ``<name>_1``, ``<name>_2`` (order, key, f)."""
    here = F.struct(F.col(order).alias("o"), F.col("key").alias("key"), F.col("f").alias("f"))
    return running(counts, [], [order], [
        Running(f"{name}_1", "max", F.when(F.col("words") == 1, here)),
        Running(f"{name}_2", "max", F.when(F.col("words") == 2, here))], hot_rows=0, piece_rows=piece_rows)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, kill_percent: int = KILL_PERCENT,
                 piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The ``top`` phrases of two or three words per language of ``docs(text, lang)``.

    Returns lang, rank, phrase, a (its occurrences), l and r (of its parts at the lowest-scoring cut, the first of
    equal ones), n (all words of the language) and score. A phrase with fewer than ``least`` occurrences is no
    candidate; one inside a longer candidate with at least ``kill_percent`` of its occurrences is left out. Equal
    scores go by more occurrences, then by the phrase's bytes. Texts are read whole: null ones are empty, a null
    language is ``und``. Repeated rows count again; other columns are not read; an empty table gives no rows.
    """
    counts = stage_table(phrase_counts(docs, least), "counts")
    split = counts.where("words > 0").select(
        "key", "words", "f", F.substring_index("key", "\n", 1).alias("lang"),
        F.split(F.substring_index("key", "\n", -1), "\t").alias("w"))
    join = lambda w: F.concat("lang", F.lit("\n"), F.array_join(w, "\t"), F.lit("\t"))
    stream = split.select("key", "words", "f", join(F.col("w")).alias("prefix"), join(F.reverse("w")).alias("suffix"))
    parts = _with_parts(stream, "prefix", "l", piece_rows)
    parts = stage_table(_with_parts(parts, "suffix", "r", piece_rows).where("words > 1").select(
        "key", "words", F.col("f").alias("a"), F.col("l_1.f").alias("l1"), F.col("l_2").alias("l2"),
        F.col("r_1.f").alias("r1"), F.col("r_2").alias("r2")), "parts")
    # A pair's own entry is the last pair; a triple is cut before its last word or after its first.
    early = _score(F.col("a"), F.col("l1"), F.when(F.col("words") == 2, F.col("r1")).otherwise(F.col("r2.f")))
    late = F.when(F.col("words") == 3, _score(F.col("a"), F.col("l2.f"), F.col("r1")))
    scored = parts.select("*", early.alias("early"), late.alias("late"))
    second = F.coalesce(F.col("late") < F.col("early"), F.lit(False))
    left = F.when(second, F.col("l2.f")).otherwise(F.col("l1"))
    right = F.when(second | (F.col("words") == 2), F.col("r1")).otherwise(F.col("r2.f"))
    scored = scored.select("key", "words", "a", left.alias("l"), right.alias("r"),
                           F.least("early", "late").alias("score"))
    triples = parts.where("words = 3").select("a", F.explode(F.array("l2", "r2")).alias("pair"))
    inside = triples.where(100 * F.col("a") >= kill_percent * F.col("pair.f")).select(
        F.col("pair.key").alias("key")).distinct()
    kept = scored.join(inside.hint("merge"), "key", "left_anti")
    named = kept.select(F.substring_index("key", "\n", 1).alias("code"),
                        F.translate(F.substring_index("key", "\n", -1), "\t", " ").alias("phrase"), "a", "l", "r", "score")
    w = W.partitionBy("code").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = named.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    totals = counts.where("words = 0").select(F.col("key").alias("code"), F.col("f").alias("n"))
    lang = F.col("code")
    for char, code in (("\n", "%0A"), ("\t", "%09"), ("%", "%25")):
        lang = F.replace(lang, F.lit(code), F.lit(char))
    return best.join(totals, "code").select(lang.alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase",
                                            "a", "l", "r", "n", "score")
