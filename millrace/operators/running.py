"""Running totals and maxima per key, in order, for keys of any size.

An ordinary window puts all rows of a key into one task. That is right for ordinary keys and wrong
for a key that holds a third of the table. ``running`` counts the keys first. Ordinary keys go
through a plain window. Rows of hot keys are range-partitioned by (key, order) into pieces of even
size, each piece is summed on its own, and the small table of piece totals supplies what came
before. Sums and maxima both compose this way, and ``last``, ``lag`` and ``row_number`` are special
cases of them: the newest row so far is the maximum of a struct that starts with the order columns.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import BooleanType, DataType, DatetimeType, NumericType, StringType, StructType

from millrace.session import cut_lineage

HOT_ROWS = 4_000_000
PIECE_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
# Bytes allowed for a value whose size the schema does not tell: texts, and everything with parts.
TEXT_BYTES, NESTED_BYTES = 128, 8192


@dataclass(frozen=True)
class Running:
    """One running aggregate: ``kind`` is ``sum`` or ``max``; ``before`` leaves out the current row."""

    name: str
    kind: str
    value: Column
    before: bool = False


@dataclass(frozen=True)
class HotKeys:
    """Keys with too many rows for one task (``keys`` is None when there are none)."""

    keys: DataFrame | None
    n_keys: int = 0
    n_rows: int = 0


NO_HOT_KEYS = HotKeys(None)


def row_bytes(df: DataFrame) -> int:
    """Width of a row by its schema."""
    def width(kind: DataType) -> int:
        if isinstance(kind, StructType):
            return sum(width(f.dataType) for f in kind)
        return 16 if isinstance(kind, (NumericType, DatetimeType, BooleanType)) else (
            TEXT_BYTES if isinstance(kind, StringType) else NESTED_BYTES)
    return 16 + width(df.schema)


def hinted(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast ``df`` only when its counted rows times their width are small; otherwise let the planner shuffle."""
    return F.broadcast(df) if rows * row_bytes(df) <= BROADCAST_BYTES else df


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that is shuffled even while it is small. Where joins repeat in rounds, the planner's
    broadcasts (10 MB packed, many times that unpacked) would pass through the driver in each of them."""
    return df.hint("merge")


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality over ``keys``."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def same_named(keys: list[str], left: str = "l", right: str = "r") -> Column:
    """Null-safe equality over ``keys`` of two aliased frames."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


def find_hot_keys(df: DataFrame, keys: list[str], hot_rows: int | None = None) -> HotKeys:
    """Keys of ``df`` with more than ``hot_rows`` rows. One job over the key columns only."""
    limit = HOT_ROWS if hot_rows is None else hot_rows
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    found = sizes.agg(F.count(F.lit(1)).alias("k"), F.sum("_n").alias("n")).first()
    if not found["k"]:
        return NO_HOT_KEYS
    return HotKeys(cut_lineage(sizes.select(*keys)), found["k"], found["n"])


def _over(agg: Running, value: Column, keys: list[str], order: list[str]) -> Column:
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1 if agg.before else 0)
    return (F.sum(value) if agg.kind == "sum" else F.max(value)).over(w)


def _windowed(df: DataFrame, keys: list[str], order: list[str], aggs: list[Running]) -> DataFrame:
    out = df
    for a in aggs:
        out = out.withColumn(a.name, _over(a, F.col("_v_" + a.name), keys, order))
    return out


def _in_pieces(df: DataFrame, keys: list[str], order: list[str], aggs: list[Running], hot: HotKeys,
               piece_rows: int) -> DataFrame:
    n = max(2, math.ceil(hot.n_rows / piece_rows))
    # The piece number is only known once the range bounds are drawn, so it is stored before use:
    # a lost executor must not renumber pieces that were already summed.
    pieces = cut_lineage(
        df.repartitionByRange(n, *keys, *order).withColumn("_piece", F.spark_partition_id())
    )
    totals = pieces.groupBy(*keys, "_piece").agg(*[
        (F.sum if a.kind == "sum" else F.max)("_v_" + a.name).alias("_t_" + a.name) for a in aggs
    ])
    w = W.partitionBy(*keys).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(
        *keys, "_piece",
        *[(F.sum if a.kind == "sum" else F.max)("_t_" + a.name).over(w).alias("_c_" + a.name) for a in aggs],
    )
    local = _windowed(pieces, keys + ["_piece"], order, aggs)
    joined = local.join(hinted(carry, n + hot.n_keys), same_keys(local, carry, keys + ["_piece"]), "left")
    cols = []
    for a in aggs:
        if a.kind == "sum":
            both = F.when(F.col(a.name).isNull(), F.col("_c_" + a.name)).otherwise(
                F.col(a.name) + F.coalesce("_c_" + a.name, F.lit(0)))
        else:
            both = F.greatest(F.col(a.name), F.col("_c_" + a.name))
        cols.append(both.alias(a.name))
    kept = [local[c] for c in local.columns if c not in {a.name for a in aggs} and c != "_piece"]
    return joined.select(*kept, *cols)


def running(df: DataFrame, keys: list[str], order: list[str], aggs: list[Running],
            hot: HotKeys | None = None, hot_rows: int | None = None,
            piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Add one column per entry of ``aggs``, computed over the rows of each key in ``order``.

    ``order`` must name columns that order the rows of a key completely. Pass ``hot`` to reuse an
    earlier count of the same keys, or ``NO_HOT_KEYS`` where the rows per key are bounded by
    construction. An empty ``keys`` treats the whole table as one key.
    """
    base = df.select("*", *[a.value.alias("_v_" + a.name) for a in aggs])
    ks = keys
    if not keys:
        base, ks = base.withColumn("_all", F.lit(0)), ["_all"]
    if hot is None:
        hot = find_hot_keys(base, ks, hot_rows)
    if hot.keys is None:
        out = _windowed(base, ks, order, aggs)
    else:
        few = hinted(hot.keys, hot.n_keys)
        cool = base.join(few, same_keys(base, hot.keys, ks), "left_anti")
        warm = base.join(few, same_keys(base, hot.keys, ks), "left_semi")
        out = _windowed(cool, ks, order, aggs).unionByName(
            _in_pieces(warm, ks, order, aggs, hot, piece_rows))
    return out.select(*df.columns, *[a.name for a in aggs])
