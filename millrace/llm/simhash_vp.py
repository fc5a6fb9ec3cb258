"""SimHash near-duplicates: exact pairs within a Hamming radius, found through vantage-point trees.

Distinct fingerprints are dealt to the leaves of a vantage-point tree: at each node by whether their Hamming
distance to the vantage point is at most a threshold. A fingerprint also visits the other side where the
triangle bound cannot exclude a partner, so every close pair meets in a leaf. The upper tree comes
from a bounded sample and only steers the dealing; a leaf too large for one task is dealt again by a tree of
its own. Inside a leaf a local tree prunes the same way and a
union-find keeps one spanning forest, so a dense group costs edges in proportion to its size. The edges of
all leaves go through ``connected_components``.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.llm.components import connected_components
from millrace.llm.sampling import in_sample
from millrace.session import stage_table

RADIUS = 2
SHINGLE_WORDS = 3
SEED = 42
LEAF_ROWS = 8_192
SAMPLE_ROWS = 16_384
GROUP_ROWS = 1 << 20  # rows of a leaf, visitors included, that one task searches
FAN_OUT, FAN_SAMPLE = 16, 1_024  # leaves an overfull leaf is dealt into, and the members that shape their tree
LOCAL_ROWS = 256
CHUNK = 65_536


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a UTF-8 text over word shingles, A to Z lower-cased; 0 without a word."""
    ws = (text or b"").lower().split()  # on bytes: ASCII letters, blanks 0x20 and 0x09 to 0x0D
    if not ws:
        return 0
    if len(ws) < words:
        return xxhash.xxh64_intdigest(b" ".join(ws), SEED)
    n, ones = len(ws) - words + 1, np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, n, CHUNK):
        part = ws[at:min(at + CHUNK, n) + words - 1]
        hashes = np.fromiter((digest(join(g), SEED) for g in zip(*(part[i:] for i in range(words)))), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits((2 * ones > n).astype(np.uint8), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, text_key (hash of the text), fp, one row per input row."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                                             ["doc_id", "text_key", "fp"])

    own = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(code, own.select("doc_id", "text_key").schema.add("fp", "long"))


def _split(values: np.ndarray) -> tuple[np.uint64, int] | None:
    """A vantage point and its threshold, or None when no threshold divides the values.

    Of a few candidates the one whose distances spread most: the fewer values sit at the threshold, the
    fewer visit both sides.
    """
    best = None
    for vp in values[:: max(1, len(values) // 8)][:8]:
        d = np.bitwise_count(values ^ vp).astype(np.int64)
        mu = int(np.median(d))
        mu = mu - 1 if mu == d.max() else mu
        if mu >= d.min() and (best is None or d.std() > best[0]):
            best = (d.std(), vp, mu)
    return best and best[1:]


def build_tree(sample: np.ndarray, leaves: int):
    """Nested ``(vantage point, threshold, inside, outside)``; a leaf is its number."""
    count = iter(range(1 << 62))

    def node(values: np.ndarray, want: int):
        cut = _split(values) if want > 1 and len(values) > 1 else None
        if cut is None:
            return next(count)
        inside = np.bitwise_count(values ^ cut[0]) <= cut[1]
        return (*cut, node(values[inside], want // 2), node(values[~inside], want - want // 2))

    return node(np.unique(sample), leaves)


def deal(tree, fps: np.ndarray, radius: int, put: Callable[[int, np.ndarray, np.ndarray], None]) -> None:
    """Call ``put(leaf, positions, at home)`` for every leaf that members or visitors reach."""
    todo = [(tree, np.arange(len(fps)), np.ones(len(fps), bool))]
    while todo:
        node, at, home = todo.pop()
        if not len(at):
            continue
        if isinstance(node, int):
            put(node, at, home)
            continue
        vp, mu, inner, outer = node
        d = np.bitwise_count(fps[at] ^ vp).astype(np.int64)
        near, far = d <= mu + radius, d > mu - radius
        todo += [(inner, at[near], (home & (d <= mu))[near]), (outer, at[far], (home & (d > mu))[far])]


def _close(members: np.ndarray, queries: np.ndarray, nodes: np.ndarray, radius: int,
           found: Callable[[int, np.ndarray], None]) -> None:
    """Call ``found(query, members)`` (positions in ``nodes``) for all within ``radius``, pruning by triangle bounds."""
    todo = [(members, queries)]
    while todo:
        m, q = todo.pop()
        if not len(m) or not len(q):
            continue
        values = nodes[m]
        cut = _split(values) if len(m) > LOCAL_ROWS else None
        if cut is None:
            step = max(1, 4_000_000 // len(m))
            for s in range(0, len(q), step):
                hit = np.bitwise_count(nodes[q[s:s + step], None] ^ values[None, :]) <= radius
                for row in np.flatnonzero(hit.any(1)):
                    found(int(q[s + row]), m[hit[row]])
            continue
        dm = np.bitwise_count(values ^ cut[0]).astype(np.int64)
        dq = np.bitwise_count(nodes[q] ^ cut[0]).astype(np.int64)
        inside = dm <= cut[1]
        todo += [(m[inside], q[dq <= cut[1] + radius]), (m[~inside], q[dq > cut[1] - radius])]


def forest(members: np.ndarray, visitors: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of all links between members, and between visitors and members."""
    nodes = np.concatenate([members, visitors])
    parent = np.arange(len(nodes))

    def roots(at: np.ndarray) -> np.ndarray:
        up = parent[at]
        while True:
            higher = parent[up]
            if (higher == up).all():
                return up
            up = higher

    def found(q: int, ms: np.ndarray) -> None:
        if len(ms) == 1 and ms[0] == q:
            return
        at = np.append(ms, q)
        top = roots(at)
        low = top.min()
        parent[top] = low
        parent[at] = low

    _close(np.arange(len(members)), np.arange(len(nodes)), nodes, radius, found)
    top = roots(np.arange(len(nodes)))
    moved = np.flatnonzero(top != np.arange(len(nodes)))
    return nodes[moved], nodes[top[moved]]


def _deal_again(rows: DataFrame, radius: int, leaf_rows: int) -> DataFrame:
    """``rows(leaf, fp, home, members)`` -> (leaf, fp, home) over smaller leaves, by a tree per leaf.

    A tree comes from at most ``FAN_SAMPLE`` members of its leaf and splits them, so every new leaf has fewer
    members. New leaves are named by a hash: two that share a name are searched together, which is also exact.
    """
    def shape(leaf: pd.DataFrame) -> pd.DataFrame:
        want = min(FAN_OUT, -(-int(leaf["members"].iloc[0]) // leaf_rows))
        tree = build_tree(leaf["fp"].to_numpy(np.int64).view(np.uint64), want)
        return pd.DataFrame({"leaf": leaf["leaf"].iloc[:1], "tree": [pickle.dumps(tree)]})

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, fps, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            names, first, place = np.unique(leaf, return_index=True, return_inverse=True)
            for k, name in enumerate(names):
                mine, out = np.flatnonzero(place == k), []
                deal(pickle.loads(batch.column(3)[int(first[k])].as_py()), fps[mine].view(np.uint64), radius,
                     lambda child, at, home: out.append((child, mine[at], home & own[mine[at]])))
                for child, at, home in out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), name)), pa.array(np.full(len(at), child)), pa.array(fps[at]),
                         pa.array(home)], ["leaf", "child", "fp", "home"])

    nth = F.row_number().over(W.partitionBy("leaf").orderBy(F.xxhash64("fp"), "fp"))
    sample = rows.where("home").withColumn("nth", nth).where(F.col("nth") <= FAN_SAMPLE)
    trees = stage_table(sample.groupBy("leaf").applyInPandas(shape, "leaf long, tree binary"), "trees")
    steered = rows.join(trees, "leaf").select("leaf", "fp", "home", "tree")
    return steered.mapInArrow(route, "leaf long, child long, fp long, home boolean").select(
        F.xxhash64("leaf", "child").alias("leaf"), "fp", "home")


def fitting_leaves(dealt: DataFrame, radius: int, leaf_rows: int = LEAF_ROWS,
                   group_rows: int = GROUP_ROWS) -> DataFrame:
    """``dealt(leaf, fp, home)`` -> the same rows in leaves of bounded size, with a piece number.

    A leaf of more than ``group_rows`` rows is dealt again while it has more than ``leaf_rows`` members. With
    fewer members its visitors are cut into pieces, and the members go to each piece.
    """
    ready = []
    while True:
        now = stage_table(dealt, "dealt")
        sizes = now.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"), F.count_if("home").alias("members"))
        over = stage_table(sizes.where(F.col("rows") > group_rows), "overfull")
        many = over.where(F.col("members") > leaf_rows)
        last = F.coalesce(F.ceil(F.col("rows") / group_rows), F.lit(1)) - 1
        piece = F.when(F.col("home"), F.sequence(F.lit(0).cast("long"), last)).otherwise(
            F.array(F.pmod(F.xxhash64("fp"), last + 1)))
        fits = now.join(many, "leaf", "left_anti").join(over, "leaf", "left")
        ready.append(fits.select("leaf", F.explode(piece).alias("piece"), "fp", "home"))
        if many.isEmpty():
            break
        dealt = _deal_again(now.join(many, "leaf").select("leaf", "fp", "home", "members"), radius, leaf_rows)
    whole = ready[0]
    for more in ready[1:]:
        whole = whole.unionByName(more)
    return whole


def linked_fingerprints(distinct: DataFrame, radius: int = RADIUS, leaf_rows: int = LEAF_ROWS,
                        sample_rows: int = SAMPLE_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``distinct(fp)`` -> (node, component) of every fingerprint with a partner within ``radius`` bits."""
    rows = distinct.count()
    # The sample (at most about sample_rows fingerprints) only shapes the tree; every fingerprint is dealt.
    share = min(1.0, sample_rows / max(rows, 1))
    sample = distinct.where(in_sample(F.xxhash64("fp"), share)).toPandas()["fp"]
    tree = build_tree(sample.to_numpy(np.int64).view(np.uint64), min(-(-rows // leaf_rows), max(1, len(sample) // 16)))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, out = batch.column(0).to_numpy(), []
            deal(tree, fps.view(np.uint64), radius, lambda leaf, at, home: out.append(
                pa.RecordBatch.from_arrays([pa.array(np.full(len(at), leaf)), pa.array(fps[at]), pa.array(home)],
                                           ["leaf", "fp", "home"])))
            yield from out

    def search(leaf: pd.DataFrame) -> pd.DataFrame:
        fps, home = leaf["fp"].to_numpy().view(np.uint64), leaf["home"].to_numpy()
        a, b = forest(fps[home], fps[~home], radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = distinct.mapInArrow(route, "leaf long, fp long, home boolean")
    if rows <= group_rows:  # then no leaf can be larger
        dealt = dealt.withColumn("piece", F.lit(0))
    else:
        dealt = fitting_leaves(dealt, radius, leaf_rows, group_rows)
    return connected_components(dealt.groupBy("leaf", "piece").applyInPandas(search, "a long, b long"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, words: int = SHINGLE_WORDS, **options) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, text_key, fp, component_id; one row per input row.

    ``component_id`` is the smallest id among the documents that links reach, the row's own included. Null
    and blank texts have fingerprint 0 and are linked like any other. Null ids count for no minimum. Other
    columns are not read. Repeated rows share a component. An empty table gives no rows.
    """
    marked = stage_table(fingerprints(docs, words), "simhash")
    distinct = stage_table(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fps")
    linked = stage_table(linked_fingerprints(distinct.select("fp"), radius, **options), "linked")
    placed = distinct.join(linked, distinct["fp"] == linked["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    smallest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    of_fp = placed.join(smallest, "component").select("fp", "component_id")
    return marked.join(of_fp, "fp").select("doc_id", "text_key", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The document with the smallest id of each near-duplicate group, with the columns of ``docs``.

    Exactly one row of a group stays: of repeated rows with that id, the one whose text has the smallest hash.
    """
    found = near_duplicates(docs, **options).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = found.groupBy("component_id").agg(F.min("text_key").alias("key"))
    own = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.xxhash64("text").alias("own_key"))
    kept = own.join(first, own["doc.doc_id"].eqNullSafe(first["component_id"]) & (own["own_key"] == first["key"]),
                    "left_semi")
    nth = F.row_number().over(W.partitionBy("doc.doc_id", "own_key").orderBy(F.lit(1)))
    return kept.withColumn("nth", nth).where(F.col("nth") == 1).select("doc.*")
