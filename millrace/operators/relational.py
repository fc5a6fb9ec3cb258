"""Joins, grouped totals, pivots and ranked selections."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import IntegralType

from millrace.operators.running import BROADCAST_BYTES, Running, find_hot_keys, row_bytes, running


def checked_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` if it has at most ``max_rows`` rows, by default as many as fit ``BROADCAST_BYTES``.

    The count stops one row past the bound.
    """
    max_rows = BROADCAST_BYTES // row_bytes(df) if max_rows is None else max_rows
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    The rank filter is pushed below the shuffle by the planner, so each task sends one row per key.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key; ``order`` ends with a column that breaks ties."""
    return latest_per_key(df, keys, [F.col(c).asc() for c in order])


def dedup_first_sql(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The same selection written as SQL over the frame."""
    text = (
        "SELECT * EXCEPT (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS _rn "
        "FROM {{rows}}) WHERE _rn = 1"
    ).format(keys=", ".join(f"`{k}`" for k in keys), order=", ".join(f"`{c}`" for c in order))
    return df.sparkSession.sql(text, rows=df)


def top_n_dense(df: DataFrame, group: str, amount: str, n: int, name: str = "dense_rank") -> DataFrame:
    """Rows whose amount is among the ``n`` largest distinct amounts of the group.

    Ranks are taken over the distinct amounts, of which only ``n`` per group leave each task; the
    rows meet their rank in a join, so a group with many ties is not sorted in one place.
    """
    w = W.partitionBy(group).orderBy(F.col(amount).desc())
    ranks = (
        df.select(group, amount).distinct()
        .withColumn(name, F.dense_rank().over(w)).where(F.col(name) <= n)
    )
    cond = F.col(f"d.{group}").eqNullSafe(F.col(f"k.{group}")) & F.col(f"d.{amount}").eqNullSafe(F.col(f"k.{amount}"))
    return df.alias("d").join(ranks.alias("k"), cond).select("d.*", F.col(f"k.{name}"))


def rank_variants(df: DataFrame, keys: list[str], amount: str, tie: str, hot_rows: int | None = None) -> DataFrame:
    """row_number, rank and dense_rank side by side, by falling amount (null last), for groups of any size."""
    hot = find_hot_keys(df, keys, hot_rows)
    value = F.col(amount)
    if isinstance(df.schema[amount].dataType, IntegralType):
        value = value.cast("decimal(20,0)")  # the smallest integer has no negative
    ordered = df.withColumn("_down", F.struct(value.isNull().alias("none"), F.coalesce(-value, F.lit(0)).alias("down")))
    order = ["_down", tie]
    step = running(ordered, keys, order, [
        Running("row_number", "sum", F.lit(1)),
        Running("_above", "max", F.col("_down"), before=True),
    ], hot=hot)
    fresh = F.col("_above").isNull() | (F.col("_down") > F.col("_above"))
    return running(step, keys, order, [
        Running("rank", "max", F.when(fresh, F.col("row_number"))),
        Running("dense_rank", "sum", F.when(fresh, 1).otherwise(0)),
    ], hot=hot).drop("_down", "_above")


def sum_by_country(transactions: DataFrame, users: DataFrame, user: str, amount: str, country: str,
                   arrival: str, unknown: str = "Unknown") -> DataFrame:
    """Total per country; a user's last row wins and unmatched purchases count as ``unknown``.

    Purchases are added up per user before the join, so a busy user is one row by then.
    """
    known = latest_per_key(users.select(user, country, arrival), [user], [F.col(arrival).desc()])
    spent = transactions.groupBy(user).agg(F.sum(amount).alias("_spent"))
    joined = spent.join(known.select(user, country), user, "left")
    return joined.groupBy(F.coalesce(country, F.lit(unknown)).alias(country)).agg(
        F.sum("_spent").alias("total_amount"))


def left_join_unknown(transactions: DataFrame, users: DataFrame, user: str, country: str, arrival: str,
                      unknown: str = "Unknown") -> DataFrame:
    """Every transaction with its user's country, or ``unknown``."""
    known = latest_per_key(users.select(user, country, arrival), [user], [F.col(arrival).desc()])
    return transactions.join(known.select(user, country), user, "left").withColumn(
        country, F.coalesce(country, F.lit(unknown)))


def small_side_left_join(facts: DataFrame, dims: DataFrame, on: str | list[str]) -> DataFrame:
    """Left join that keeps the fact side in place when the other side is counted and small."""
    return facts.join(checked_broadcast(dims), on, "left")


def pivot_sum(df: DataFrame, row: str, column: str, values: Sequence[str], amount: str) -> DataFrame:
    """Sum of ``amount`` per ``row`` and pivot value; missing cells are 0, a null row label stays null."""
    return df.groupBy(row).pivot(column, list(values)).agg(F.sum(amount)).fillna(0, subset=list(values))


def product_summary(df: DataFrame, product: str, amount: str, ident: str) -> DataFrame:
    """Total, number of identified rows and mean per product."""
    return df.groupBy(product).agg(
        F.sum(amount).alias("total_amount"), F.count(ident).alias("transaction_count"),
        F.avg(amount).alias("average_amount"))


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_streams(frames: Sequence[DataFrame], index: str = "stream_idx") -> DataFrame:
    """``union_sources`` with the position of the frame as a column."""
    return union_sources([f.withColumn(index, F.lit(i)) for i, f in enumerate(frames)])


def majority_vote(answers: DataFrame, question: str, agent: str, answer: str) -> DataFrame:
    """Most frequent answer per question; ties go to the answer given first in agent order."""
    votes = answers.where(F.col(answer).isNotNull()).groupBy(question, answer).agg(
        F.count(F.lit(1)).alias("votes"), F.min(agent).alias("_first"))
    won = latest_per_key(votes, [question], [F.col("votes").desc(), F.col("_first").asc()]).drop("_first")
    return answers.select(question).distinct().join(won, question, "left").select(
        question, F.coalesce(answer, F.lit("0")).alias(answer), F.coalesce("votes", F.lit(0)).alias("votes"))


def accuracy_report(df: DataFrame, config: str, predicted: str, truth: str) -> DataFrame:
    """Share of exact matches per configuration."""
    hit = F.coalesce(F.col(predicted) == F.col(truth), F.lit(False))
    return df.groupBy(config).agg(
        F.count(F.lit(1)).alias("answered"), F.sum(F.when(hit, 1).otherwise(0)).alias("correct"),
        F.avg(F.when(hit, 1.0).otherwise(0.0)).alias("accuracy"))


def order_totals(orders: DataFrame) -> DataFrame:
    """Revenue and number of orders: price times quantity per item, a tenth off for VIP in any case."""
    per_item = lambda i: (
        F.coalesce(i["price"].try_cast("double"), F.lit(0.0)) * F.coalesce(i["quantity"].try_cast("double"), F.lit(1.0)))
    items = F.coalesce(F.transform("items", per_item), F.array().cast("array<double>"))
    gross = F.aggregate(items, F.lit(0.0), lambda acc, v: acc + v)
    level = F.upper(F.coalesce(F.col("customer.membership"), F.lit("Guest")))
    net = F.when(level == "VIP", gross * 0.9).otherwise(gross)
    return orders.select(net.alias("_net")).agg(
        F.coalesce(F.sum("_net"), F.lit(0.0)).alias("total_revenue"), F.count(F.lit(1)).alias("processed_count"))
