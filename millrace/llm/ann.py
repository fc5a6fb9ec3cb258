"""Approximate nearest neighbours by adaptive dimension scans over inverted lists.

Vectors are assigned to the nearest of some centroids and turned by a random rotation, after which any few
dimensions estimate the whole distance. A list is stored in chunks of rows; a chunk holds the rotated vectors
as column blocks and the original ones. A scan adds up partial distances block by block and drops a candidate
as soon as a hypothesis test says that its whole distance exceeds the current k-th best: the scaled partial
distance is beyond ``(1 + EPSILON / sqrt(dimensions seen))`` times the bound. Survivors are measured exactly on
the original vectors in double precision.

Only the fit reads a sample (at most about ``FIT_ROWS`` vectors and ``FIT_BYTES``): centroids, expected list
sizes and the share of lists to probe for ``RECALL``. Every vector is indexed. Lists are dealt in pieces, so a
vector that fills a third of the table is no task of its own. Lists form ``GROUPS``; a query goes once to each
group that has a list it probes, in a block with others, and blocks meet the chunks of the group in a shuffled
join. No side of it is broadcast: a few queries look small to the planner and are many times that for all groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from millrace.llm.sampling import in_sample
from millrace.session import stage_table

FIT_ROWS = 20_000
FIT_BYTES = 64 << 20
SLICE = 1_024
MAX_LISTS = 1_024
GROUPS = 64
CHUNK_ROWS = 1_024
QUERY_BLOCK = 512
BLOCK_DIMS = 16
EPSILON = 2.1
RECALL = 0.97
ROUNDS = 8
SPARSE = 8
BATCH_BYTES = 16 << 20
FOLD_ROWS = 500_000


def usable(vector: Column) -> Column:
    """Not null, not empty, not all zero, every component a finite number."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def usable_vectors(df: DataFrame, id_column: str, vector_column: str, *extra: Column) -> DataFrame:
    """(id, vector, extra) of the rows that take part: an id, a usable vector of the most frequent length (ties: longer)."""
    rows = df.where(F.col(id_column).isNotNull() & usable(F.col(vector_column))).select(
        F.col(id_column).alias("id"), F.col(vector_column).alias("vector"), *extra)
    top = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("vector") == (top["n"] if top else 0))


@dataclass(frozen=True)
class Fit:
    """Centroids, rotation, pieces per list and number of lists to probe."""

    centroids: np.ndarray
    rotation: np.ndarray
    pieces: np.ndarray
    probes: int

    def order(self, x: np.ndarray, keep: int) -> np.ndarray:
        """The nearest ``keep`` lists of each row of ``x``, nearest first."""
        d = (self.centroids ** 2).sum(1) - 2 * x @ self.centroids.T
        return d.argmin(1)[:, None] if keep == 1 else np.argsort(d, axis=1, kind="stable")[:, :keep]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a ** 2).sum(1)[:, None] - 2 * a @ b.T + (b ** 2).sum(1)


def _slices(n: int, rows: int) -> list[slice]:
    return [slice(i, i + rows) for i in range(0, n, rows)]


def fit(vectors: DataFrame, rows: int, k: int, seed: int = 11) -> Fit:
    """K-means on a sample chosen by a hash of the id; probes until the sample's own neighbours are found."""
    first = vectors.first()
    dims = len(first["vector"]) if first else 1
    want = max(1, min(FIT_ROWS, FIT_BYTES // (8 * dims)))
    share = min(1.0, want / max(rows, 1))
    sample = vectors.where(in_sample(F.xxhash64("id"), share)).orderBy("id").select("vector").toArrow()
    x = sample.column(0).combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, dims)
    x = x if len(x) else np.zeros((1, dims))
    rng = np.random.default_rng(seed)
    lists = max(1, min(MAX_LISTS, round(rows ** 0.5), len(x) // 4))
    c = x[rng.permutation(len(x))[:lists]].copy()
    for _ in range(ROUNDS):
        at = np.concatenate([_distances(x[s], c).argmin(1) for s in _slices(len(x), SLICE)])
        sums, counts = np.zeros_like(c), np.bincount(at, minlength=lists)
        np.add.at(sums, at, x)
        c[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    at = np.concatenate([_distances(x[s], c).argmin(1) for s in _slices(len(x), SLICE)])
    pieces = np.maximum(1, np.ceil(np.bincount(at, minlength=lists) / len(x) * rows / CHUNK_ROWS)).astype(int)
    rotation = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
    own = Fit(c, rotation, pieces, lists)
    # Neighbours within the sample lie farther off than in the whole table, so this errs towards more probes.
    test = rng.permutation(len(x))[:256]
    near = []
    for some in (test[s] for s in _slices(len(test), 32)):
        d = _distances(x[some], x)
        d[np.arange(len(some)), some] = np.inf
        near.append(np.argsort(d, 1)[:, :min(k, len(x) - 1)])
    near = np.concatenate(near)
    ranks = own.order(x[test], lists).argsort(1)
    needed = np.sort(np.take_along_axis(ranks, at[near], 1), axis=None)
    probes = int(needed[min(len(needed) - 1, int(RECALL * len(needed)))]) + 1 if len(needed) else lists
    return Fit(c, rotation, pieces, probes)


def _rows_of(batch: pa.RecordBatch, column: int, dims: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy().reshape(batch.num_rows, dims)


def build_index(vectors: DataFrame, model: Fit) -> DataFrame:
    """Chunks ``cell, n, ids, blocks, raw`` of all ``vectors(id, vector)`` in a written table."""
    dims = model.rotation.shape[0]
    double = "double" in vectors.schema["vector"].dataType.simpleString()
    kind = np.float64 if double else np.float32

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows_of(batch, 1, dims)
            cell = np.zeros(len(x), np.int64)
            for s in _slices(len(x), SLICE):
                cell[s] = model.order(x[s].astype(np.float64), 1)[:, 0]
            piece = batch.column(2).to_numpy() % model.pieces[cell]
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(piece), batch.column(0), batch.column(1)],
                                             ["cell", "piece", "id", "vector"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def chunk() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            raw = _rows_of(t, 3, dims)
            turned = (raw.astype(np.float64) @ model.rotation).astype(np.float32)
            blocks = [np.ascontiguousarray(turned[:, b:b + BLOCK_DIMS]).tobytes() for b in range(0, dims, BLOCK_DIMS)]
            out = [t.column(0)[0].as_py(), t.num_rows, t.column(2).to_numpy().astype(np.int64).tobytes(), blocks,
                   raw.astype(kind).tobytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(out, CHUNK)], schema=CHUNK)

        for batch in batches:  # sorted by cell; a chunk never mixes cells
            cells, at = batch.column(0).to_numpy(), 0
            while at < batch.num_rows:
                same = int(np.searchsorted(cells, cells[at], side="right"))
                if held and held[0].column(0)[0].as_py() != cells[at]:
                    yield chunk()
                    held = []
                stop = min(same, at + CHUNK_ROWS - sum(h.num_rows for h in held))
                held.append(batch.slice(at, stop - at))
                at = stop
                if sum(h.num_rows for h in held) == CHUNK_ROWS:
                    yield chunk()
                    held = []
        if held:
            yield chunk()

    hashed = vectors.select("id", "vector", F.pmod(F.xxhash64("id"), F.lit(1 << 30)).alias("h"))
    kinds = "array<double>" if double else "array<float>"
    dealt = hashed.mapInArrow(assign, f"cell long, piece long, id long, vector {kinds}").repartition("cell", "piece")
    return stage_table(dealt.sortWithinPartitions("cell", "piece", "id").mapInArrow(
        chunks, "cell long, n long, ids binary, blocks array<binary>, raw binary"), "lists")


CHUNK = pa.schema([("cell", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("blocks", pa.list_(pa.binary())),
                   ("raw", pa.binary())])


def _exact(queries: np.ndarray, raw: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Distances of the pairs of query ``row`` and vector ``at``."""
    out = np.empty(len(row))
    for s in _slices(len(row), 8 * SLICE):
        out[s] = np.sqrt(((raw[at[s]].astype(np.float64) - queries[row[s]]) ** 2).sum(1))
    return out


def _best(k: int, query: np.ndarray, d: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Positions of the ``k`` best of each query, by query, distance and id."""
    order = np.lexsort((ids, d, query))
    q = query[order]
    return order[np.arange(len(q)) - np.searchsorted(q, q) < k]


def adaptive_scans(queries: np.ndarray, turned: np.ndarray, own: np.ndarray, ids: np.ndarray,
                   blocks: list[np.ndarray], raw: np.ndarray, k: int,
                   within: np.ndarray | float = np.inf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``k`` of a chunk for each query, its own id left out: rows of queries, positions, exact distances.

    ``turned`` holds the rotated queries. A block of dimensions is added for all pairs at once, or for the pairs
    still alive if these are few. A little slack absorbs the single precision of the blocks. Of vectors farther off
    than ``within``, the distance of a query's k-th best so far, few are returned.
    """
    dims, n, seen = queries.shape[1], len(ids), blocks[0].shape[1]
    norm = (queries ** 2).sum(1)
    part = _distances(turned[:, :seen], blocks[0])
    others = np.full(len(own), n)
    for q in np.flatnonzero(np.isin(own, ids)):
        mine = ids == own[q]
        part[q, mine] = np.inf
        others[q] -= mine.sum()
    if n > k:
        # The best by the first block give the bound for the others.
        some = np.argpartition(part, k - 1, axis=1)[:, :k]
        d = _exact(queries, raw, np.repeat(np.arange(len(own)), k), some.ravel()).reshape(-1, k)
        bound = np.where(others > k, d.max(1) ** 2, np.inf)
        slack, pairs = 1e-5 * (norm + bound), None
        for block in blocks:
            if block is not blocks[0]:
                dealt = slice(seen, seen + block.shape[1])
                seen = dealt.stop
                if pairs is None:
                    part += _distances(turned[:, dealt], block)
                else:
                    row, at, p = pairs
                    p = p + ((block[at] - turned[row, dealt]) ** 2).sum(1)
            allowed = bound * (seen / dims) * (1 + (EPSILON / np.sqrt(seen) if seen < dims else 0)) ** 2 + slack
            if pairs is None:
                np.putmask(part, part > allowed[:, None], np.inf)
                alive = np.isfinite(part)
                if seen < dims and SPARSE * np.count_nonzero(alive) < alive.size:
                    pairs = *np.nonzero(alive), part[alive]
            else:
                held = p <= allowed[row]
                pairs = row[held], at[held], p[held]
        if pairs:
            part.fill(np.inf)
            part[pairs[0], pairs[1]] = pairs[2]
        # All dimensions are summed now: only what may be among the best is measured on the original vectors.
        last = np.partition(part, k - 1, axis=1)[:, k - 1].astype(np.float64)
        last = np.minimum(last, np.square(within))
        row, at = np.nonzero(np.isfinite(part) & (part <= (last + 1e-5 * (norm + last))[:, None]))
    else:
        row, at = np.nonzero(np.isfinite(part))
    d = _exact(queries, raw, row, at)
    best = _best(k, row, d, ids[at])
    return row[best], at[best], d[best]


def adaptive_scan(query: np.ndarray, turned: np.ndarray, own: int, ids: np.ndarray, blocks: list[np.ndarray],
                  raw: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``adaptive_scans`` of one query: positions and exact distances."""
    return adaptive_scans(query[None], turned[None], np.array([own]), ids, blocks, raw, k)[1:]


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Workers get about ``BATCH_BYTES`` at a time, where the session sets no other size."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(key, None) is None
    if own:
        spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        if own:
            spark.conf.unset(key)


def search(queries: DataFrame, index: DataFrame, model: Fit, k: int,
           probes: int | None = None) -> DataFrame:
    """The ``k`` nearest found of each query ``(id, vector)``: query_id, rank, id, score (Euclidean distance).

    The hits are written, so that the size of batches holds for this search alone.
    """
    dims, probes, block_rows, groups = model.rotation.shape[0], probes or model.probes, QUERY_BLOCK, GROUPS
    sizes = np.zeros(len(model.centroids), np.int64)
    for r in index.groupBy("cell").agg(F.sum("n").alias("n")).collect():  # a row per list
        sizes[r["cell"]] = r["n"]
    each = queries.groupBy("id").agg(F.min("vector").alias("vector"))
    kind = np.float64 if "double" in each.schema["vector"].dataType.simpleString() else np.float32

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every, own = _rows_of(batch, 1, dims), batch.column(0).to_numpy().astype(np.int64)
            for s in _slices(len(own), block_rows):
                order = model.order(every[s].astype(np.float64), len(sizes))
                held = np.cumsum(sizes[order], axis=1)
                # enough lists for the recall, and enough candidates for k answers besides the query itself
                count = np.maximum(probes, (held < k + 1).sum(1) + 1)
                taken = np.zeros(order.shape, bool)
                np.put_along_axis(taken, order, (np.arange(len(sizes)) < count[:, None]) & (sizes[order] > 0), 1)
                for g in range(min(groups, len(sizes))):
                    lists = taken[:, g::groups]
                    asks = np.flatnonzero(lists.any(1))
                    if len(asks):
                        packed = [x[asks].tobytes() for x in (own[s], every[s].astype(kind), lists)]
                        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip([g, *packed], BLOCK)],
                                                         schema=BLOCK)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, part, near = [], 0, None, {}

        def folded() -> list[np.ndarray]:
            q, i, d = (np.concatenate(x) for x in zip(*held))
            best = _best(k, q, d, i)
            return [q[best], i[best], d[best]]

        for batch in batches:
            for r in range(batch.num_rows):
                cell, *packed = (batch.column(c)[r] for c in range(batch.num_columns))
                cell, (own, vectors, lists, ids, raw) = cell.as_py(), (p.as_buffer() for p in packed[:-1])
                own, ids = np.frombuffer(own, np.int64), np.frombuffer(ids, np.int64)
                asks = np.flatnonzero(np.frombuffer(lists, bool).reshape(len(own), -1)[:, cell // groups])
                if not len(asks):
                    continue
                if part != cell % groups:
                    part, near = cell % groups, {}
                best = near.setdefault((own[0], len(own)), np.full((len(own), k), np.inf))  # distances so far
                blocks = [np.frombuffer(b.as_buffer(), np.float32).reshape(len(ids), -1) for b in packed[-1]]
                raw = np.frombuffer(raw, np.float32 if len(raw) == 4 * dims * len(ids) else np.float64)
                v = np.frombuffer(vectors, kind).reshape(len(own), dims)[asks].astype(np.float64)
                row, at, d = adaptive_scans(v, (v @ model.rotation).astype(np.float32), own[asks], ids, blocks,
                                            raw.reshape(len(ids), dims), k, best[asks].max(1))
                more = np.full((len(asks), k), np.inf)
                more[row, np.arange(len(row)) - np.searchsorted(row, row)] = d
                best[asks] = np.partition(np.concatenate([best[asks], more], 1), k - 1, axis=1)[:, :k]
                held.append([own[asks[row]], ids[at], d])
                rows += len(row)
                if rows > FOLD_ROWS:
                    held = [folded()]
                    rows = len(held[0][0])
                    if rows > FOLD_ROWS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["query_id", "id", "score"])
                        held, rows = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in folded()], ["query_id", "id", "score"])

    asked = each.mapInArrow(route, "part long, own binary, vectors binary, lists binary")
    stored = index.withColumn("part", F.col("cell") % groups)
    met = stored.hint("merge").join(asked, "part").select("cell", "own", "vectors", "lists", "ids", "raw", "blocks")
    found = met.mapInArrow(scan, "query_id long, id long, score double")
    nth = F.row_number().over(W.partitionBy("query_id").orderBy("score", "id"))
    hits = found.withColumn("rank", nth).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
    with _small_batches(index.sparkSession):
        return stage_table(hits, "hits")


BLOCK = pa.schema([("part", pa.int64()), ("own", pa.binary()), ("vectors", pa.binary()), ("lists", pa.binary())])


def nearest(vectors: DataFrame, queries: Column, k: int = 10, id_column: str = "vec_id",
            vector_column: str = "embedding") -> DataFrame:
    """For the rows of ``vectors`` where ``queries`` holds their ``k`` nearest others: query_id, rank, id, score.

    Unusable vectors (see ``usable_vectors``) take no part. Several rows of one id are candidates each;
    as a query such an id is asked once, with its smallest vector, and its own rows are no candidates. Ties
    go to the smaller id. Other columns are not read. Empty tables give no rows.
    """
    every = usable_vectors(vectors, id_column, vector_column, queries.alias("asked"))
    model = fit(every, every.count(), k)
    return search(every.where("asked"), build_index(every.select("id", "vector"), model), model, k)
