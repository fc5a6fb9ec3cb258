"""Checks and roll-ups over stored texts that a model or a drifting producer wrote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.jsonx import field, heal_json_text, is_text, number, once, parsed, whole_number
from millrace.operators.quality import violations

# Fixed values of the contracts.
CURRENCIES = ["JPY", "USD", "EUR", "GBP"]
MEMBERSHIPS = ["VIP", "Regular", "Guest"]
SENTIMENTS = ["positive", "negative", "neutral"]
EMAIL = r"^[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}$"
ISO_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
PRICES_PER_1K = {"cheap": (0.00015, 0.0006), "expensive": (0.003, 0.015)}
CONFIDENCE_FLOOR = 0.7
FINAL_NUMBER_PATTERNS = [
    r"(?i)最終解答:\s*(-?\d+)",
    r"(?i)####\s*(-?\d+)",
    r"(?i)answer is\s*(-?\d+)",
    r"(?i)(-?\d+)\s*$",
]
CALL_PATTERN = r"CALL:\s*([a-zA-Z0-9_]+),\s*ARGS:\s*(\{.*\})"
FINAL_PATTERN = r"最終回答:\s*(.*)"


def _iso_time(text: Column) -> Column:
    return F.when(text.rlike(ISO_TIME), F.try_to_timestamp(text))


def tx_validate(df: DataFrame, text: str, heal: bool = True) -> DataFrame:
    """Typed transaction fields and the list of fields that break the contract.

    A text that is no JSON object has the single violation ``json``.
    """
    v = F.col("_v")
    source = heal_json_text(text) if heal else F.col(text)
    rows = once(df, "_v", parsed(source))
    amount, currency = number(field(v, "amount")), F.upper(field(v, "currency"))
    stamp = _iso_time(field(v, "timestamp"))
    failed = violations({
        "transaction_id": is_text(v, "transaction_id") & field(v, "transaction_id").startswith("tx_"),
        "user_id": is_text(v, "user_id") & field(v, "user_id").rlike(r"^usr_\d+$"),
        "amount": amount > 0,
        "currency": currency.isin(CURRENCIES),
        "timestamp": stamp.isNotNull(),
    })
    readable = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    checked = F.struct(
        field(v, "transaction_id").alias("transaction_id"), field(v, "user_id").alias("user_id"),
        amount.alias("amount"), currency.alias("currency"), stamp.alias("timestamp"),
        F.when(readable, failed).otherwise(F.array(F.lit("json"))).alias("violations"))
    return once(rows, "_c", checked).select(*df.columns, "_c.*")


def tx_validate_dlq(df: DataFrame, index: str, text: str, heal: bool = True) -> tuple[DataFrame, DataFrame]:
    """Accepted transactions, and (index, raw_data, error_reason) of the rest."""
    checked = tx_validate(df, text, heal)
    good = checked.where(F.size("violations") == 0).select(
        index, "transaction_id", "user_id", "amount", "currency", "timestamp")
    reason = F.array_join(F.transform("violations", lambda f: F.concat(f, F.lit(": invalid value"))), ", ")
    bad = checked.where(F.size("violations") > 0).select(
        F.col(index).alias("index"), F.col(text).alias("raw_data"), reason.alias("error_reason"))
    return good, bad


CUSTOMER = ("customer_id", "email", "membership")
ITEMS = "array<struct<item_id:variant,price:string,quantity:string,qty:string>>"


def streamed_transaction(df: DataFrame, text: str) -> DataFrame:
    """Transactions of a streamed model output: text ids and currency, a positive amount, nothing else.

    A text that is no JSON object has the single violation ``json``.
    """
    v = F.col("_v")
    rows = once(df, "_v", parsed(F.col(text)))
    amount = number(field(v, "amount"))
    failed = violations({
        "transaction_id": is_text(v, "transaction_id"), "user_id": is_text(v, "user_id"), "amount": amount > 0,
        "currency": is_text(v, "currency")})
    readable = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    checked = F.struct(
        field(v, "transaction_id").alias("transaction_id"), field(v, "user_id").alias("user_id"), amount.alias("amount"),
        field(v, "currency").alias("currency"),
        F.when(readable, failed).otherwise(F.array(F.lit("json"))).alias("violations"))
    return once(rows, "_c", checked).select(*df.columns, "_c.*")


def _text_of(variant: Column) -> Column:
    """The text of a JSON string; numbers and other kinds are null."""
    return F.when(F.schema_of_variant(variant) == "STRING", F.try_variant_get(variant, "$", "string"))


def _texts_at(df: DataFrame, v: str, name: str, places: dict[str, list[str]]) -> DataFrame:
    """``df`` with a struct ``name`` of texts, each from the first of its ``places`` that is there; null when that is no
    JSON string. The places are looked up once, although kind and text are both read."""
    first = F.struct(*[F.coalesce(*[F.try_variant_get(F.col(v), f"$.{p}", "variant") for p in at]).alias(n)
                       for n, at in places.items()])
    return once(once(df, "_first", first), name, F.struct(*[_text_of(F.col(f"_first.{n}")).alias(n) for n in places])).drop("_first")


def _items(v: Column, renamed: bool = False) -> Column:
    return F.transform(field(v, "items", ITEMS), lambda i: F.struct(
        _text_of(i["item_id"]).alias("item_id"), i["price"].alias("price"),
        (F.coalesce(i["quantity"], i["qty"]) if renamed else i["quantity"]).alias("quantity")))


def _costs(items: Column) -> Column:
    """Price times quantity of every item, null where an item breaks its contract."""
    def read(i: Column) -> Column:
        return F.struct(i["item_id"].isNotNull().alias("known"), number(i["price"]).alias("price"),
                        whole_number(i["quantity"]).alias("quantity"))

    def cost(i: Column) -> Column:
        return F.when(i["known"] & (i["price"] > 0) & (i["quantity"] > 0), i["price"] * i["quantity"])
    return F.transform(F.transform(items, read), cost)


def order_violations(o: Column, costs: Column) -> Column:
    """Fields of a nested order (all leaves as text) that break the contract."""
    items_ok = F.forall(costs, lambda c: c.isNotNull())
    expected = F.aggregate(costs, F.lit(0.0), lambda acc, c: acc + c)
    total = number(o["total_amount"])
    sum_ok = F.when(items_ok & (F.size(costs) > 0), F.abs(total - expected) <= 0.01).otherwise(F.lit(True))
    return violations({
        "order_id": o["order_id"].isNotNull(),
        "customer.customer_id": o["customer"]["customer_id"].isNotNull(),
        "customer.email": o["customer"]["email"].rlike(EMAIL),
        "customer.membership": o["customer"]["membership"].isin(MEMBERSHIPS),
        "items": items_ok,
        "total_amount": total.isNotNull() & sum_ok,
        "order_date": _iso_time(o["order_date"]).isNotNull(),
    })


def order_contract(df: DataFrame, text: str) -> DataFrame:
    """Parsed order and its violations, per JSON text."""
    places = {"order_id": ["order_id"]} | {n: [f"customer.{n}"] for n in CUSTOMER}
    return _judged(_ordered(df, text, "order", places, False), "order")


def _ordered(df: DataFrame, text: str, name: str, places: dict[str, list[str]], renamed: bool) -> DataFrame:
    """``df`` with the order of a JSON text in the contract's shape, texts taken from ``places``."""
    v = F.col("_v")
    found = _texts_at(once(df, "_v", parsed(text)), "_v", "_texts", places)
    order = F.struct(
        F.col("_texts.order_id").alias("order_id"), F.struct(*[F.col(f"_texts.{n}").alias(n) for n in CUSTOMER]).alias("customer"),
        _items(v, renamed).alias("items"), field(v, "total_amount").alias("total_amount"),
        field(v, "order_date").alias("order_date"))
    return once(found, name, order).drop("_v", "_texts")


def _judged(df: DataFrame, name: str) -> DataFrame:
    priced = once(df, "_costs", _costs(F.col(name)["items"]))
    return priced.withColumn("violations", order_violations(F.col(name), F.col("_costs"))).drop("_costs")


# Where each field may be found, best place first.
ALIASES = {
    "order_id": ["order_id", "ord_number"],
    "customer_id": ["customer.customer_id", "customer.cust_id", "cust_info.customer_id", "cust_info.cust_id", "customer_id"],
    "email": ["customer.email", "cust_info.email", "customer_email"],
    "membership": ["customer.membership", "cust_info.membership", "customer_membership"],
}


def drift_normalise(df: DataFrame, text: str, name: str = "order") -> DataFrame:
    """Orders with renamed or flattened fields, mapped back to the contract's shape by fixed aliases."""
    return _judged(_ordered(df, text, name, ALIASES, True), name)


def analysis_violations(v: Column) -> Column:
    """Fields of a parsed analysis answer that break the contract."""
    confidence = number(field(v, "confidence"))
    return violations({
        "sentiment": field(v, "sentiment").isin(SENTIMENTS),
        "confidence": confidence.between(0.0, 1.0),
        "reasoning": is_text(v, "reasoning") & (F.length(field(v, "reasoning")) >= 10),
    })


def token_cost(tier: Column, tokens_in: Column, tokens_out: Column) -> Column:
    """Dollar cost of one call from the price list per thousand tokens."""
    cost = F.lit(None).cast("double")
    for name, (price_in, price_out) in PRICES_PER_1K.items():
        cost = F.when(tier == name, tokens_in * F.lit(price_in / 1000) + tokens_out * F.lit(price_out / 1000)
                      ).otherwise(cost)
    return cost


def first_valid_wins(candidates: DataFrame, request: str, tier: str, output: str, tokens_in: str,
                     tokens_out: str, tiers: tuple[str, ...] = ("cheap", "expensive")) -> DataFrame:
    """Answer of the first tier that passes the contract; failed tiers still cost.

    One row per request: ``winner`` is null when every tier failed. One grouped pass, no window.
    """
    marked = once(candidates, "_v", parsed(output)).select(
        request, tier, output, F.size(analysis_violations(F.col("_v"))).alias("_bad"),
        token_cost(F.col(tier), F.col(tokens_in), F.col(tokens_out)).alias("_cost"))
    per_tier = []
    for i, t in enumerate(tiers):
        here = F.col(tier) == t
        per_tier += [
            F.max(F.when(here & (F.col("_bad") == 0), F.col(output))).alias(f"_o{i}"),
            F.sum(F.when(here, F.col("_cost"))).alias(f"_c{i}"),
        ]
    wide = marked.groupBy(request).agg(*per_tier)
    winner, spent = F.lit(None).cast("string"), None
    for i in reversed(range(len(tiers))):
        cost = F.coalesce(f"_c{i}", F.lit(0.0))
        spent = cost if spent is None else F.when(F.col(f"_o{i}").isNotNull(), cost).otherwise(cost + spent)
        winner = F.when(F.col(f"_o{i}").isNotNull(), tiers[i]).otherwise(winner)
    return wide.select(request, winner.alias("winner"),
                       F.coalesce(*[F.col(f"_o{i}") for i in range(len(tiers))]).alias("answer"),
                       spent.alias("cost"))


def cost_rollup(calls: DataFrame, tier: str, tokens_in: str, tokens_out: str) -> DataFrame:
    """Tokens and cost per tier."""
    return calls.groupBy(tier).agg(
        F.sum(tokens_in).alias("input_tokens"), F.sum(tokens_out).alias("output_tokens")).withColumn(
        "cost", token_cost(F.col(tier), F.col("input_tokens"), F.col("output_tokens")))


FALLBACK_ANSWER = "No reliable answer was found in the sources."


def answer_gate(df: DataFrame, text: str) -> DataFrame:
    """Accept an answer with enough confidence, no retry wish and a source; else the fallback text."""
    shape = "struct<answer:string,confidence:double,needs_retry:boolean,sources:array<string>>"
    a = F.col("_a")
    ok = F.coalesce(
        a["confidence"].between(CONFIDENCE_FLOOR, 1.0) & ~a["needs_retry"] & (F.size(a["sources"]) >= 1)
        & a["answer"].isNotNull(), F.lit(False))
    return once(df, "_a", F.from_json(text, shape)).withColumn(
        "status", F.when(ok, "accepted").otherwise("fallback")).withColumn(
        "answer", F.when(ok, a["answer"]).otherwise(FALLBACK_ANSWER)).drop("_a")


def tool_call_parse(df: DataFrame, text: str) -> DataFrame:
    """Tool call or final answer of a transcript turn; a call wins, broken arguments are an error."""
    t = F.col(text)
    name = F.nullif(F.regexp_extract(t, CALL_PATTERN, 1), F.lit(""))
    args = F.regexp_extract(t, CALL_PATTERN, 2)
    final = t.rlike(FINAL_PATTERN)
    broken = name.isNotNull() & parsed(args).isNull()
    kind = F.when(broken, "error").when(name.isNotNull(), "call").when(final, "final").otherwise("none")
    return df.select(
        "*", kind.alias("kind"), name.alias("tool"), F.when(name.isNotNull(), args).alias("args"),
        F.when(name.isNull() & final, F.trim(F.regexp_extract(t, FINAL_PATTERN, 1))).alias("final_answer"))


def final_number(text: Column | str) -> Column:
    """Last stated number of an answer, by fixed patterns in order, else the last number in the text."""
    t = F.col(text) if isinstance(text, str) else text
    tries = [F.nullif(F.regexp_extract(t, p, 1), F.lit("")) for p in FINAL_NUMBER_PATTERNS]
    every = F.regexp_extract_all(t, F.lit(r"(-?\d+)"), 1)
    return F.coalesce(*tries, F.get(every, F.size(every) - 1))


# Fixed texts of the release note layout.
NOTE_OVERVIEW = "## 📝 Overview"
NOTE_FEATURES = "## 🚀 New Features"
NOTE_FIXES = "## 🐛 Bug Fixes & Improvements"
NOTE_FOOTER = "*Generated via Ollama & MCP Release Notes Agent*"


def release_note_markdown(version: str, title: str, summary: str, features: str, fixes: str) -> Column:
    """Markdown of one release; an empty list leaves out its section."""
    def section(head: str, items: str) -> Column:
        lines = F.concat(F.array(F.lit(head)), F.transform(items, lambda i: F.concat(F.lit("- "), i)),
                         F.array(F.lit("")))
        return F.when(F.coalesce(F.size(items), F.lit(0)) > 0, lines).otherwise(F.array().cast("array<string>"))

    top = F.array(F.concat(F.lit("# Release Notes - "), version, F.lit(": "), title), F.lit(""),
                  F.lit(NOTE_OVERVIEW), F.col(summary), F.lit(""))
    return F.array_join(F.concat(top, section(NOTE_FEATURES, features), section(NOTE_FIXES, fixes),
                                 F.array(F.lit("---"), F.lit(NOTE_FOOTER))), "\n")


def release_note_rollup(notes: DataFrame, appended: str) -> DataFrame:
    """Every note with its Markdown and whether it is the one appended last."""
    last = notes.agg(F.max(appended)).scalar()
    made = notes.withColumn("markdown", release_note_markdown("version", "title", "summary", "features", "fixes"))
    return made.withColumn("is_latest", F.col(appended) == last)
