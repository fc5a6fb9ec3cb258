"""Ranked retrieval: keyword scores, nearest vectors, rank fusion."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.functions.jsonx import once
from millrace.functions.vectors import cosine, squared_distance
from millrace.operators.running import hinted, row_bytes
from millrace.session import scratch_dir, stage_table

# Constants of the keyword score, chosen here and stated in the README.
K1, B = 1.2, 0.75
RRF_K = 60
# Scores are compared after rounding, so the order of summation cannot change a ranking.
DIGITS = 9
QUERY_BLOCK = 512
CELL_FILE_ROWS = 500_000
CHUNK_BYTES = 4 << 20
BROADCAST_BYTES = 64 << 20
PIECE_PAIRS = 1_000_000


def top_k(scored: DataFrame, query: str, ident: str, score: str, k: int) -> DataFrame:
    """The ``k`` best rows per query with their rank; only ``k`` per query leave each task."""
    w = W.partitionBy(query).orderBy(F.col(score).desc(), F.col(ident))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def bm25_search(docs: DataFrame, queries: DataFrame, ident: str, tokens: str, query: str, terms: str,
                k: int) -> DataFrame:
    """BM25 ranking of ``docs`` for every query. ``tokens`` and ``terms`` are word arrays.

    Words no query asks for are dropped before anything is shuffled. The words asked for meet the
    documents in a map-side join, so a word found everywhere is not gathered in one task. Every
    document also counts one empty word, which carries the collection's size through the same
    shuffle: the texts are read and split once.

    The words found are dealt by document. While the questions fit a broadcast, their scores are then added up and cut
    to ``k`` in place, and the pieces are so many that one meets at most ``PIECE_PAIRS`` pairs of question and document.
    """
    asked = queries.select(query, F.explode(F.array_distinct(terms)).alias("term"))
    sizes = asked.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(query).alias("queries")).first()
    n_asked = sizes["rows"]
    pieces = []  # as many as the planner thinks right, where the questions do not fit
    if n_asked * (row_bytes(asked) + 32) <= BROADCAST_BYTES:
        pieces = [max(docs.sparkSession.sparkContext.defaultParallelism,
                      math.ceil(docs.count() * sizes["queries"] / PIECE_PAIRS))]
    words = hinted(queries.select(F.explode(F.concat(terms, F.array(F.lit("")))).alias("term")).distinct(), n_asked)
    split = once(docs.select(ident, tokens), "_t", F.concat(tokens, F.array(F.lit("")))).withColumn(
        "_len", F.size("_t") - 1)
    found = (
        split.select(ident, "_len", F.explode_outer("_t").alias("term"))
        .join(words, "term", "left_semi")
        .repartition(*pieces, ident)
        .groupBy(ident, "_len", "term").agg(F.count(F.lit(1)).alias("_tf"))
    )
    spread = found.groupBy("term").agg(
        F.sum(F.when(F.col("_tf") > 0, 1)).alias("_df"), F.sum("_len").alias("_total"))
    all_docs = F.col("term") == ""
    n_docs = spread.agg(F.max(F.when(all_docs, F.col("_df")))).scalar()
    mean_len = spread.agg(F.max(F.when(all_docs, F.col("_total") / F.col("_df")))).scalar()
    idf = F.log(1 + (n_docs - F.col("_df") + 0.5) / (F.col("_df") + 0.5))
    weights = spread.select("term", idf.alias("_idf"), mean_len.alias("_avg"))
    weighted = asked.join(weights, "term")
    part = F.col("_idf") * F.col("_tf") * (K1 + 1) / (
        F.col("_tf") + K1 * (1 - B + B * F.col("_len") / F.col("_avg")))
    scored = found.join(hinted(weighted, n_asked), "term").groupBy(query, ident).agg(
        F.round(F.sum(part), DIGITS).alias("score"))
    return top_k(scored, query, ident, "score", k)


def nearest(base: DataFrame, vector: str, probe: list[float], k: int, metric: str = "cosine",
            ident: str | None = None) -> DataFrame:
    """The ``k`` rows nearest to one vector, ties by ``ident``, without Python workers."""
    q = F.array(*[F.lit(float(x)) for x in probe])
    score = cosine(F.col(vector), q) if metric == "cosine" else -squared_distance(F.col(vector), q)
    ties = [F.col(ident)] if ident else []
    return base.withColumn("score", F.round(score, DIGITS)).orderBy(F.col("score").desc(), *ties).limit(k)


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    dims = np.diff(column.offsets.to_numpy())
    if len(dims) and (dims != dims[0]).any():
        raise ValueError("vectors differ in size")
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _scores(q: np.ndarray, x: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        size = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1)[None, :]
        s = np.divide(q @ x.T, size, out=np.zeros((len(q), len(x))), where=size > 0)
    elif metric == "l2":
        s = np.stack([-((x - v) ** 2).sum(axis=1) for v in q])
    else:
        raise ValueError(f"unknown metric {metric}")
    return np.round(s, DIGITS)


def _ids(column: pa.Array) -> np.ndarray:
    out = column.to_numpy(zero_copy_only=False)
    return out.astype(str) if out.dtype == object else out


def _id_type(df: DataFrame, column: str) -> str:
    return "string" if df.schema[column].dataType.simpleString() == "string" else "bigint"


def _hits_schema(base: DataFrame, ident: str, queries: DataFrame, query: str) -> str:
    return f"_q {_id_type(queries, query)}, _id {_id_type(base, ident)}, _s double"


def _typed_id(df: DataFrame, column: str) -> Column:
    return F.col(column).cast(_id_type(df, column)).alias(column)


def _ranked(parts: DataFrame, base: DataFrame, ident: str, queries: DataFrame, query: str, k: int) -> DataFrame:
    named = parts.select(F.col("_q").cast(queries.schema[query].dataType).alias(query),
                         F.col("_id").cast(base.schema[ident].dataType).alias(ident), F.col("_s").alias("score"))
    return top_k(named, query, ident, "score", k)


def _query_blocks(queries: DataFrame, query: str, vector: str, cell: Column | None = None
                  ) -> tuple[DataFrame, int, int]:
    """Queries gathered in rows of about ``QUERY_BLOCK`` (per cell): ``_cell, _block, _queries``; how many blocks, and
    how many rounds it takes to broadcast them with at most ``BROADCAST_BYTES`` at a time.

    Nothing passes through the driver but the count and the width.
    """
    cells = (F.lit(0) if cell is None else cell).alias("_cell")
    asked = queries.select(_typed_id(queries, query), F.transform(vector, lambda x: x.cast("double")).alias("_v"), cells)
    sizes = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_v")).alias("w")).first()
    blocks = max(1, math.ceil(sizes["n"] / QUERY_BLOCK))
    gathered = asked.groupBy(
        "_cell", F.pmod(F.xxhash64(query, "_v"), F.lit(blocks)).cast("int").alias("_block")).agg(
        F.collect_list(F.struct(F.col(query).alias("q"), F.col("_v").alias("v"))).alias("_queries"))
    rounds = max(1, math.ceil(sizes["n"] * (8 * (sizes["w"] or 0) + 32) / BROADCAST_BYTES))
    return gathered, blocks, min(rounds, blocks)


def _chunks(base: DataFrame, ident: str, vector: str, cell: Column | None = None) -> DataFrame:
    """Rows of ``base`` in batches: ``_cell, _ids, _x`` (vectors as one block of at most ``CHUNK_BYTES`` of doubles)."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, x = batch.column(2).to_numpy(), _matrix(batch.column(1))
            for c in np.unique(cells):
                every = np.flatnonzero(cells == c)
                step = max(1, CHUNK_BYTES // max(1, 8 * x.shape[1]))
                for at in (every[i:i + step] for i in range(0, len(every), step)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c], pa.int32()), pa.array([batch.column(0).take(pa.array(at)).to_pylist()],
                                                             pa.list_(batch.column(0).type)), pa.array([x[at].tobytes()])],
                        names=["_cell", "_ids", "_x"])

    rows = base.select(_typed_id(base, ident), vector, (F.lit(0) if cell is None else cell).cast("int").alias("_cell"))
    return rows.mapInArrow(pack, f"_cell int, _ids array<{_id_type(base, ident)}>, _x binary")


def _scored(met: DataFrame, base: DataFrame, ident: str, queries: DataFrame, query: str, k: int, metric: str) -> DataFrame:
    """The best ``k`` of every query over rows of ``_ids, _x, _queries``."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = _ids(batch.column(0)[i].values)
                x = np.frombuffer(batch.column(1)[i].as_buffer(), np.float64).reshape(len(ids), -1)
                asked = batch.column(2)[i].values
                s = _scores(_matrix(asked.field("v")), x, metric)
                names, owner, hits = asked.field("q").to_pylist(), [], []
                for j in range(len(s)):
                    keep = np.arange(len(ids))
                    if len(ids) > k:  # with all ties at the edge, which the ids decide
                        keep = np.flatnonzero(-s[j] <= np.partition(-s[j], k - 1)[k - 1])
                    best = keep[np.lexsort((ids[keep], -s[j][keep]))[:k]]
                    owner += [names[j]] * len(best)
                    hits.append(best)
                rows = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
                cols = np.concatenate(hits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner), pa.array(ids[cols].tolist()), pa.array(s[rows, cols], pa.float64())],
                    names=["_q", "_id", "_s"])

    parts = met.select("_ids", "_x", "_queries").mapInArrow(scan, _hits_schema(base, ident, queries, query))
    return _ranked(parts, base, ident, queries, query, k)


def vector_topk(base: DataFrame, queries: DataFrame, ident: str, vector: str, query: str, query_vector: str, k: int,
                metric: str = "cosine") -> DataFrame:
    """The exact ``k`` nearest rows of ``base`` for every query.

    Rows are multiplied in batches with blocks of queries; a batch hands on ``k`` rows per query. The vectors of
    ``base`` are never shuffled: the blocks are broadcast, as many at a time as ``BROADCAST_BYTES`` allows, and each
    round reads ``base`` once and stores its hits. Ids are whole numbers or texts.
    """
    gathered, blocks, rounds = _query_blocks(queries, query, query_vector)
    if rounds > 1:
        gathered = stage_table(gathered, "query_blocks")

    def hits(r: int) -> DataFrame:
        mine = F.sequence(F.lit(r), F.lit(blocks - 1), F.lit(rounds))
        chunks = _chunks(base, ident, vector).select("*", F.explode(mine).alias("_block"))
        asked = F.broadcast(gathered.where(F.pmod("_block", F.lit(rounds)) == r))
        return _scored(chunks.join(asked, "_block"), base, ident, queries, query, k, metric)

    if rounds == 1:
        return hits(0)
    return reduce(DataFrame.unionByName, [stage_table(hits(r), "hits") for r in range(rounds)])


class CellIndex:
    """Vectors stored by coarse cell; a search reads only the cells near the query."""

    def __init__(self, path: str, centres: np.ndarray, ident: str, vector: str, spark):
        self.path, self.centres, self.ident, self.vector, self.spark = path, centres, ident, vector, spark

    @classmethod
    def build(cls, base: DataFrame, ident: str, vector: str, cells: int = 256, seed: int = 7,
              iterations: int = 10) -> CellIndex:
        """Cluster all vectors by direction and write them by cell.

        Cells are written in pieces of bounded size, so a crowded cell is spread over many tasks.
        """
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        spark = base.sparkSession
        features = base.select(array_to_vector(F.col(vector)).alias("features"))
        model = KMeans(k=cells, seed=seed, maxIter=iterations, distanceMeasure="cosine").fit(
            features.where(F.exists(base[vector], lambda x: x != 0)))
        centres = np.array(model.clusterCenters())
        shared = spark.sparkContext.broadcast(centres)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    cell = _scores(shared.value, _matrix(batch.column(1)), "cosine").argmax(axis=0)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(1), pa.array(cell, pa.int32())], names=[ident, vector, "cell"])

        placed = base.select(_typed_id(base, ident), vector).mapInArrow(
            assign, f"{ident} {_id_type(base, ident)}, {vector} array<float>, cell int")
        path = scratch_dir(spark, "cells")
        placed.write.parquet(f"{path}/flat")
        flat = spark.read.parquet(f"{path}/flat")
        sizes = flat.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL_FILE_ROWS).cast("long").alias("_pieces"))
        total = sizes.agg(F.sum("_pieces")).first()[0] or 1
        flat.join(F.broadcast(sizes), "cell").withColumn("_piece", F.pmod(F.xxhash64(ident), F.col("_pieces"))).repartition(
            total, "cell", "_piece").drop("_piece", "_pieces").write.partitionBy("cell").parquet(f"{path}/by_cell")
        return cls(f"{path}/by_cell", centres, ident, vector, spark)

    def search(self, queries: DataFrame, query: str, query_vector: str, k: int, nprobe: int = 8,
               metric: str = "cosine") -> DataFrame:
        """Best ``k`` among the rows of the ``nprobe`` nearest cells; all cells give the exact answer.

        Only the files of cells that some query probes are read. While the probes are small they are broadcast
        and the vectors stay in place.
        """
        table = self.spark.read.parquet(self.path)
        centres, ident = self.centres, self.ident

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    order = np.argsort(-_scores(_matrix(batch.column(1)), centres, "cosine"), axis=1, kind="stable")
                    cells = pa.array(order[:, :nprobe].tolist(), pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=[query, query_vector, "_cells"])

        kind = queries.schema[query_vector].dataType.simpleString()
        routed = queries.select(_typed_id(queries, query), query_vector).mapInArrow(
            route, f"{query} {_id_type(queries, query)}, {query_vector} {kind}, _cells array<int>")
        probes = stage_table(routed.select(query, query_vector, F.explode("_cells").alias("_probe")), "probes")
        gathered, _, rounds = _query_blocks(probes, query, query_vector, F.col("_probe"))
        probed = [r[0] for r in probes.select("_probe").distinct().collect()]  # at most one number per cell
        chunks = _chunks(table.where(F.col("cell").isin(probed)), ident, self.vector, F.col("cell"))
        return _scored(chunks.join(F.broadcast(gathered) if rounds == 1 else gathered, "_cell"), table, ident, queries, query, k, metric)


def rrf_fuse(rankings: DataFrame, doc: str, system: str = "system", position: str = "position",
             by: list[str] | None = None, k: int = RRF_K) -> DataFrame:
    """Sum of ``1 / (k + rank)`` over systems; ``position`` counts from 0.

    A document listed twice by a system counts once, at its first place. Ties keep the order of
    first sight. A blank id is an error.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    keys = by or []
    blank = F.col(doc).isNull() | (F.trim(F.col(doc).cast("string")) == "")
    checked = rankings.withColumn(doc, F.when(
        blank, F.raise_error(F.lit("rrf_fuse: blank document id")).cast(rankings.schema[doc].dataType)
    ).otherwise(F.col(doc)))
    first = checked.groupBy(*keys, system, doc).agg(F.min(position).alias("_p"))
    return first.groupBy(*keys, doc).agg(
        F.round(F.sum(1.0 / (k + F.col("_p") + 1)), 12).alias("rrf_score"),
        F.min(F.struct(F.col(system).alias("s"), F.col("_p").alias("p"))).alias("_seen"),
    ).select(*keys, doc, "rrf_score", F.col("_seen.s").alias("first_system"), F.col("_seen.p").alias("first_position"))


def hybrid_search(chunks: DataFrame, queries: DataFrame, ident: str, vector: str, tokens: str, query: str,
                  query_vector: str, terms: str, k: int = 5, rrf_k: int = RRF_K,
                  rerank: Callable[[Column, Column], Column] = cosine) -> DataFrame:
    """Nearest vectors and keyword hits fused by rank, re-scored by ``rerank`` and cut to ``k``."""
    n = max(k * 10, 50)
    by_vector = vector_topk(chunks, queries, ident, vector, query, query_vector, n)
    by_word = bm25_search(chunks, queries, ident, tokens, query, terms, n)
    lists = [f.select(query, ident, F.lit(i).alias("system"), (F.col("rank") - 1).alias("position"))
             for i, f in enumerate((by_vector, by_word))]
    fused = rrf_fuse(lists[0].unionByName(lists[1]), ident, by=[query], k=rrf_k)
    w = W.partitionBy(query).orderBy(F.col("rrf_score").desc(), "first_system", "first_position")
    short = fused.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    # At most n candidates per query: the chunk side stays in place unless that is too many to ship.
    n_queries = queries.count()
    found = chunks.select(ident, vector).join(hinted(short, n_queries * n), ident)
    scored = found.join(hinted(queries.select(query, query_vector), n_queries), query).select(
        query, ident, F.col("rrf_score").alias("_rrf_score"),
        F.round(rerank(F.col(vector), F.col(query_vector)), DIGITS).alias("_rerank_score"))
    return top_k(scored, query, ident, "_rerank_score", k)


def rank_compare(hits: DataFrame, exact: DataFrame, query: str, ident: str, depth: int = 500) -> DataFrame:
    """Place of each hit in the exact ranking, counted from 1, or ``>depth``."""
    places = exact.where(F.col("rank") <= depth).select(query, ident, F.col("rank").alias("_place"))
    return hits.join(places, [query, ident], "left").withColumn(
        "exact_rank", F.coalesce(F.col("_place").cast("string"), F.lit(f">{depth}"))).drop("_place")


def candidate_pool(lists: list[DataFrame], query: str, ident: str, depth: int = 3) -> DataFrame:
    """Rows of the heads of several rankings, each id once; the first list that has it wins."""
    heads = None
    for i, one in enumerate(lists):
        head = one.where(F.col("rank") <= depth).select(query, ident, F.lit(i).alias("list"), "rank")
        heads = head if heads is None else heads.unionByName(head)
    return heads.groupBy(query, ident).agg(F.min(F.struct("list", "rank")).alias("_f")).select(
        query, ident, F.col("_f.list").alias("list"), F.col("_f.rank").alias("rank"))
