"""Ranked lexical search over norm buckets.

A document is a vector with one coordinate per term, its integer impact; an item asks for the sum of the
impacts of its terms. Vectors are ordered by length and cut into buckets. An item skips a bucket when the
longest vector in it cannot reach the item's k-th score by Cauchy and Schwarz; whole ranges of short
vectors are left out by the same bound in the scan of the stored table. Inside a bucket the item's heaviest
coordinates give each vector a partial score and a bound on the rest; survivors are scored again in
integers over all terms. A bound never cuts a tie, so the ranking is exact.

Coordinates are scaled by the square root of the term's weight on both sides, which keeps every product and
makes the lengths of items and documents alike.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from millrace.operators.running import Running, running
from millrace.session import stage_table

# Fixed: what a term is, and the letters that are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The same rule on the bytes of UTF-8: all bytes of wider characters belong to a term, everything else parts terms.
TERM_BYTES = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b > 127 else 32 for b in range(256))

K = 50
BLOCK_TERMS = 400_000  # terms of the items that are searched together; what the driver and a task hold of them
BUCKET_DOCS = 4_096
BUCKET_ENTRIES = 1_000_000
LONG_SHARE = 1 / 32  # of the vectors, the longest ones, searched first for the thresholds
FOCUS = 0.5  # of an item's squared length, held by the coordinates that are looked at first
SLACK = 1 + 1e-9  # the bounds are doubles

VECTORS = "doc_id long, n long, terms array<int>, tfs array<long>"
IMPACTS = "doc_id long, norm double, terms array<int>, impacts array<long>"
HITS = "item long, doc_id long, score long"


def vocabulary_vectors(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """``docs(doc_id, text)`` as sparse vectors: how often each term of the vocabulary occurs, ``n`` terms in all.

    Documents without a term are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast({t.encode(): i for t, i in vocabulary.items()})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, sizes, ends, terms, tfs = [], [], [0], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                counts = Counter(text.translate(TERM_BYTES).split())
                if counts:
                    held = [(known[t], c) for t, c in counts.items() if t in known]
                    ids.append(doc_id)
                    sizes.append(counts.total())
                    terms += [t for t, _ in held]
                    tfs += [c for _, c in held]
                    ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))], names=["doc_id", "n", "terms", "tfs"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, VECTORS)


def _parts(batch: pa.RecordBatch, terms: int, values: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of each entry, terms and values of two list columns."""
    column = batch.column(terms)
    rows = np.repeat(np.arange(batch.num_rows), np.diff(column.offsets.to_numpy()))
    return rows, column.flatten().to_numpy(), batch.column(values).flatten().to_numpy()


def impact_table(vectors: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """Impacts ``w * (10^9 tf div (1000 tf + 20 m))`` and the scaled length of every vector, longest first.

    A stored table, range-partitioned by length; equal lengths are split by a hash, so copies spread.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(weights)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            rows, terms, tf = _parts(batch, 2, 3)
            n = batch.column(1).to_numpy()
            m = 100 - 50 + np.array([50 * int(x) * n_docs // n_terms for x in n], np.int64)
            part = (1_000_000_000 * tf) // (1000 * tf + 20 * m[rows])
            impact = w[terms] * part
            keep = impact > 0
            rows, terms, part, impact = rows[keep], terms[keep], part[keep], impact[keep]
            norm = np.sqrt(np.bincount(rows, impact.astype(np.float64) * part, batch.num_rows))
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=batch.num_rows))]), pa.int32())
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(norm), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(impact, pa.int64()))],
                names=["doc_id", "norm", "terms", "impacts"])
            yield out.filter(pa.array(norm > 0))

    weighed = vectors.mapInArrow(weigh, IMPACTS)
    spread = F.xxhash64("doc_id", "terms")
    ranged = weighed.repartitionByRange(F.desc("norm"), spread).sortWithinPartitions(F.desc("norm"))
    return stage_table(ranged, "impacts")


class Bucket:
    """Vectors of similar length, stored by coordinate."""

    def __init__(self, ids: np.ndarray, absent: np.ndarray, norms: np.ndarray, rows: np.ndarray, terms: np.ndarray,
                 impacts: np.ndarray, weights: np.ndarray):
        order = np.argsort(terms, kind="stable")
        self.ids, self.absent, self.squares, self.longest = ids, absent, norms ** 2, norms.max()
        self.rows, self.impacts = rows[order], impacts[order]
        self.terms, first = np.unique(terms[order], return_index=True)
        self.begin = np.append(first, len(terms))
        self.most = np.maximum.reduceat(self.impacts, first)
        w = weights[terms[order]].astype(np.float64)
        self.coordinate = self.impacts.astype(np.float64) ** 2 / w  # squared, scaled

    def entries(self, at: np.ndarray) -> np.ndarray:
        """Places of the entries of the coordinates ``at``."""
        size = self.begin[at + 1] - self.begin[at]
        before = np.cumsum(size) - size
        return np.repeat(self.begin[at] - before, size) + np.arange(int(size.sum()))

    def reach(self, terms: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose exact score is at least ``least`` (and above 0), with their scores."""
        none = np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        place = place[self.terms[place] == terms]
        w = weights[self.terms[place]].astype(np.float64)
        if not len(place) or self.longest * math.sqrt(w.sum()) * SLACK < least or self.most[place].sum() < least:
            return none, none
        heavy = np.argsort(-w, kind="stable")
        place, w = place[heavy], w[heavy]
        cut = int(np.searchsorted(np.cumsum(w), FOCUS * w.sum())) + 1
        near = self.entries(place[:cut])
        known = np.bincount(self.rows[near], self.impacts[near], len(self.ids))
        left = self.squares - np.bincount(self.rows[near], self.coordinate[near], len(self.ids))
        rest = np.minimum(np.sqrt(np.maximum(left, 0) * w[cut:].sum()), float(self.most[place[cut:]].sum()))
        alive = (known + rest) * SLACK >= least
        score = np.zeros(len(self.ids), np.int64)
        for entries in (near, self.entries(place[cut:])):
            entries = entries[alive[self.rows[entries]]]
            np.add.at(score, self.rows[entries], self.impacts[entries])
        found = np.flatnonzero(alive & (score >= max(least, 1)))
        return found, score[found]


def _scan(table: DataFrame, items: list[np.ndarray], weights: np.ndarray, least: np.ndarray, k: int) -> DataFrame:
    """The best ``k`` per item and task of ``table``, at least as good as ``least``."""
    shared = table.sparkSession.sparkContext.broadcast((items, weights, least))

    def buckets(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[Bucket]:
        held, docs, entries = [], 0, 0

        def close() -> Bucket:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            ids = whole.column(0)
            return Bucket(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
                          whole.column(1).to_numpy(), *_parts(whole, 2, 3), weights)

        for batch in batches:
            size = np.diff(batch.column(2).offsets.to_numpy())
            at = 0
            while at < batch.num_rows:
                fits = int(np.searchsorted(np.cumsum(size[at:]), BUCKET_ENTRIES - entries, side="right"))
                take = max(min(fits, BUCKET_DOCS - docs), 0 if docs else 1)
                if take:
                    held.append(batch.slice(at, take))
                    docs, entries, at = docs + take, entries + int(size[at:at + take].sum()), at + take
                if at < batch.num_rows:
                    yield close()
                    held, docs, entries = [], 0, 0
        if docs:
            yield close()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, least = shared.value
        least = least.copy()
        best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * len(items)
        for bucket in buckets(batches, weights):
            for i, terms in enumerate(items):
                found, score = bucket.reach(terms, weights, int(least[i]))
                if not len(found):
                    continue
                ids, absent, scores = (np.concatenate(p) for p in zip(
                    best[i], (bucket.ids[found], bucket.absent[found], score)))
                top = np.lexsort((ids, absent, -scores))[:k]
                best[i] = ids[top], absent[top], scores[top]
                if len(top) == k:
                    least[i] = max(least[i], scores[top[-1]])
        for i, (ids, absent, scores) in enumerate(best):
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), i)), pa.array(ids, mask=absent), pa.array(scores)],
                    names=["item", "doc_id", "score"])

    return table.mapInArrow(search, HITS)


def _best(hits: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, asked: list[list[str]], k: int) -> DataFrame | None:
    vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for terms in asked for t in terms))}
    vectors = stage_table(vocabulary_vectors(docs, vocabulary), "vectors")
    n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs or not vocabulary:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    for term, held in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
        df[term] = held
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    items = [np.array(sorted(vocabulary[t] for t in terms), np.int64) for terms in asked]
    table = impact_table(vectors, weights, n_docs, n_terms)
    cut = table.approxQuantile("norm", [1 - LONG_SHARE], 0.005)
    if not cut:
        return None
    least = np.ones(len(items), np.int64)
    long = stage_table(_best(_scan(table.where(F.col("norm") >= cut[0]), items, weights, least, k), k), "hits")
    for item, score in long.where(F.col("rank") == k).select("item", "score").toLocalIterator():
        least[item] = score
    lengths = np.sqrt([max(float(weights[t].sum()), 1e-300) for t in items])
    floor = float((least / lengths).min()) / SLACK  # no shorter vector reaches any item's k-th score
    rest = table.where((F.col("norm") < cut[0]) & (F.col("norm") >= floor))
    return _best(long.select("item", "doc_id", "score").union(_scan(rest, items, weights, least, k)), k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``k`` best of ``docs(doc_id, text)`` for each row of ``items(item_id, text)``: item_id, rank, doc_id, score.

    Terms are the runs of letters, digits and all characters beyond ASCII; only A-Z are lower-cased. A null or
    empty text has none: such a document is not counted, such an item has no hits. Whole texts of any length
    are read. Scores are integers; equal ones are ordered by ``doc_id``, a null id last. Repeated rows of
    documents are documents of their own, repeated items are answered each on its own. Other columns are
    not read. Empty tables give no rows. Items are searched in blocks of about ``block_terms`` terms; a block
    is what the driver and a task hold, and each block reads the documents once.
    """
    spark = docs.sparkSession
    words = F.array_distinct(F.regexp_extract_all(
        F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(TERM), 0))
    asked = stage_table(items.select(F.monotonically_increasing_id().alias("_row"), "item_id", words.alias("terms")),
                        "items")
    sized = running(asked.select("_row", F.size("terms").cast("long").alias("_n")), [], ["_row"],
                    [Running("_upto", "sum", F.col("_n"), before=True)])
    placed = stage_table(asked.join(sized.select("_row", F.floor(
        F.coalesce("_upto", F.lit(0)) / block_terms).alias("block")), "_row"), "blocks")
    out = spark.createDataFrame([], placed.select("item_id").schema).select(
        "item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    for (block,) in placed.select("block").distinct().sort("block").toLocalIterator():
        rows = placed.where(F.col("block") == block).sort("_row").collect()
        hits = _search_block(docs, [r["terms"] for r in rows], k)
        if hits is not None:
            names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)],
                                          f"item long, item_id {placed.schema['item_id'].dataType.simpleString()}")
            out = out.union(hits.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
