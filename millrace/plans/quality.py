"""Contracts over texts rendered from the tables with seeded faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.jsonpaths import json_flatten
from millrace.functions.jsonx import heal_json_text
from millrace.operators import model_outputs as mo, quality as q
from millrace.plans.registry import EVENTS_SQL, events, query
from millrace.sources.tables import TASK_BYTES, spread, table

ID = "event_id"


def cents():
    return F.round(F.col("value") * 100).cast("long")


CENTS = "CAST(round(value * 100) AS BIGINT)"


def pick(key, n, texts, default):
    """Text by ``key % n``; the positions not listed get ``default``."""
    key = F.col(key) if isinstance(key, str) else key
    out = default
    for i, t in texts.items():
        out = F.when(key % n == i, t).otherwise(out)
    return out


def obj(**fields):
    """JSON object text; each value is a column that already is JSON."""
    parts = []
    for i, (k, v) in enumerate(fields.items()):
        parts += [F.lit(("," if i else "{") + f'"{k}":'), v if not isinstance(v, str) else F.lit(v)]
    return F.concat(*parts, F.lit("}"))


def quoted(col):
    return F.concat(F.lit('"'), col.cast("string"), F.lit('"'))


@query("sensor_cleanse", f"""
SELECT event_id, 's' || user_id AS sensor_id,
       CASE WHEN event_id % 10 = 2 THEN 25.0::DOUBLE ELSE {CENTS} + 0.5::DOUBLE END AS temperature
FROM events WHERE event_id % 10 NOT IN (1, 3, 4, 5, 6)""")
def sensor_cleanse(spark, d):
    sensor = quoted(F.concat(F.lit("s"), "user_id"))
    good = obj(sensor_id=sensor, temperature=F.concat(cents().cast("string"), F.lit(".5")))
    text = pick(ID, 10, {
        1: obj(sensor_id=sensor), 2: obj(sensor_id=sensor, temperature='" 25.0 "'),
        3: obj(sensor_id=sensor, temperature='"NaN"'), 4: F.lit('{"sensor_id": broken'),
        5: obj(sensor_id=sensor, temperature='"inf"'), 6: obj(sensor_id=sensor, temperature='"25.0d"')}, good)
    return q.sensor_cleanse(events(spark, d).select(ID, text.alias("value")))


def _listed(df):
    return df.withColumn("violations", F.array_join("violations", ","))


@query("user_contract", """
SELECT c_custkey, CASE WHEN c_custkey % 5 = 3 THEN 'user_id,country' WHEN c_custkey % 5 = 1 THEN 'country'
                       WHEN c_custkey % 5 = 2 THEN 'user_id' ELSE '' END AS violations
FROM customer""")
def user_contract(spark, d):
    k = F.col("c_custkey")
    user, home = quoted(F.concat(F.lit("u"), k)), quoted(F.col("c_mktsegment"))
    text = pick(k, 5, {1: obj(user_id=user), 2: obj(user_id=k.cast("string"), country=home), 3: F.lit("not json")},
                obj(user_id=user, country=home))
    return _listed(q.user_contract(table(spark, d, "customer").select(k, text.alias("value")))).select(k, "violations")


@query("transaction_contract", """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 6 IN (1, 2, 3, 4) THEN -1 ELSE CAST(floor(o_totalprice) AS BIGINT) END AS amount,
       CASE WHEN o_orderkey % 6 IN (1, 2, 4) THEN 'amount' WHEN o_orderkey % 6 = 3 THEN 'user_id,amount' ELSE '' END AS violations
FROM orders""")
def transaction_contract(spark, d):
    k = F.col("o_orderkey")
    user, whole = quoted(F.concat(F.lit("u"), "o_custkey")), F.floor("o_totalprice").cast("string")
    text = pick(k, 6, {
        1: obj(user_id=user, amount=quoted(whole)), 2: obj(user_id=user, amount=F.concat(whole, F.lit(".5"))),
        3: F.lit('{"user_id": "u1", "amount"'), 4: obj(user_id=user, amount="true")}, obj(user_id=user, amount=whole))
    out = _listed(q.transaction_contract(spread(table(spark, d, "orders"), TASK_BYTES).select(k, text.alias("value"))))
    return out.select(k, F.coalesce("amount", F.lit(-1)).alias("amount"), "violations")


@query("hhmm_parse", f"""
SELECT event_id, CAST((sec // 3600) % 24 * 60 + (sec // 60) % 60 AS INTEGER) AS minute_of_day
FROM {EVENTS_SQL} WHERE event_id % 8 NOT IN (1, 2, 3, 4)""")
def hhmm_parse(spark, d):
    hour, minute = F.expr("sec div 3600 % 24"), F.expr("sec div 60 % 60")
    clock = F.format_string("%02d:%02d", hour, minute)
    text = pick(ID, 8, {1: F.lit("24:00"), 2: F.lit("12:60"), 3: F.concat(clock, F.lit(":00")), 4: F.lit("ab:10")}, clock)
    return q.hhmm_parse(events(spark, d).select(ID, text.alias("time")), "time").drop("time")


@query("userlog_contract", f"""
SELECT event_id, CASE WHEN event_id % 9 IN (1, 7) THEN -1 ELSE sec END AS stamp,
       CASE event_id % 9 WHEN 1 THEN 'timestamp' WHEN 2 THEN 'user_id' WHEN 3 THEN 'user_id' WHEN 4 THEN 'event_name'
                         WHEN 7 THEN 'timestamp,user_id,event_name' WHEN 8 THEN 'user_id' ELSE '' END AS violations
FROM {EVENTS_SQL}""")
def userlog_contract(spark, d):
    sec, user, name = F.col("sec").cast("string"), quoted(F.concat(F.lit("u"), "user_id")), quoted(F.col("event_type"))
    text = pick(ID, 9, {
        1: obj(timestamp='"soon"', user_id=user, event_name=name), 2: obj(timestamp=sec, user_id="null", event_name=name),
        3: obj(timestamp=sec, user_id='"  "', event_name=name), 4: obj(timestamp=sec, user_id=user),
        5: obj(timestamp=quoted(sec), user_id=user, event_name=name),
        6: obj(timestamp=F.concat(sec, F.lit(".75")), user_id=user, event_name=name), 7: F.lit("[broken"),
        8: obj(timestamp=sec, user_id=F.col("user_id").cast("string"), event_name=name)},
        obj(timestamp=sec, user_id=user, event_name=name))
    out = _listed(q.userlog_contract(events(spark, d).select(ID, "sec", text.alias("value"))))
    return out.select(ID, F.coalesce("timestamp", F.lit(-1)).alias("stamp"), "violations")


@query("serverlog_contract", f"""
SELECT event_id, CASE WHEN event_id % 5 IN (1, 2) THEN -1 ELSE sec END AS ts,
       CASE event_id % 5 WHEN 1 THEN 'ts' WHEN 2 THEN 'ts' WHEN 3 THEN 'val' ELSE '' END AS violations
FROM {EVENTS_SQL}""")
def serverlog_contract(spark, d):
    sec, val = F.col("sec").cast("string"), quoted(F.col("event_type"))
    text = pick(ID, 5, {1: obj(ts="null", val=val), 2: obj(ts='"12:00"', val=val), 3: obj(ts=sec, val="7")},
                obj(ts=sec, val=val))
    out = _listed(q.serverlog_contract(events(spark, d).select(ID, "sec", text.alias("value"))))
    return out.select(ID, F.coalesce("ts", F.lit(-1)).alias("ts"), "violations")


# Amounts with nulls and negatives, statuses with nulls and an unknown word.
MEDALLION_SQL = """
SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN -value ELSE value END AS amount,
       CASE event_type WHEN 'click' THEN 'success' WHEN 'view' THEN 'pending' WHEN 'error' THEN 'failed'
                       WHEN 'signup' THEN 'other' ELSE NULL END AS status FROM events
"""


def medallion_rows(spark, d):
    amount = F.when(F.col(ID) % 11 == 0, None).when(F.col(ID) % 13 == 0, -F.col("value")).otherwise(F.col("value"))
    kind = F.col("event_type")
    status = F.when(kind == "click", "success").when(kind == "view", "pending").when(kind == "error", "failed").when(
        kind == "signup", "other")
    return table(spark, d, "events").select(ID, amount.alias("amount"), status.alias("status"))


@query("medallion_split", f"""
WITH r AS ({MEDALLION_SQL}),
g AS (SELECT event_id, 'valid' AS bucket FROM r WHERE amount >= 0 AND status IN ('success', 'failed', 'pending')
      UNION ALL SELECT event_id, 'invalid' FROM r WHERE amount < 0 OR status NOT IN ('success', 'failed', 'pending'))
SELECT event_id, coalesce(bucket, 'unknown') AS bucket FROM r LEFT JOIN g USING (event_id)""")
def medallion_split(spark, d):
    return q.medallion_split(medallion_rows(spark, d))["marked"].select(ID, "bucket")


@query("coalesce_contact", f"""
SELECT c_custkey, CASE WHEN c_custkey % 4 IN (0, 1) THEN c_name || '@home.example' ELSE c_name || '@work.example' END AS contact_email
FROM customer WHERE c_custkey % 4 <> 3 AND c_custkey % 12 <> 4""")
def coalesce_contact(spark, d):
    k = F.col("c_custkey")
    home = F.when(k % 12 == 4, F.lit(q.UNKNOWN_EMAIL)).when(k % 4 <= 1, F.concat("c_name", F.lit("@home.example")))
    work = F.when(k % 4 == 2, F.concat("c_name", F.lit("@work.example")))
    rows = table(spark, d, "customer").select(k, home.alias("preferred"), work.alias("backup"))
    return q.coalesce_contact(rows, "preferred", "backup").select(k, "contact_email")


def _payloads(spark, d):
    tags = F.concat(F.lit("["), quoted(F.col("event_type")), F.lit(","), quoted(F.col("user_id") % 3), F.lit("]"))
    text = pick(ID, 5, {1: obj(tags=tags), 2: obj(device='"desktop"', tags="[]"), 3: F.lit(None).cast("string"),
                        4: obj(device='"desktop"', tags="null")}, obj(device='"mobile"', tags=tags))
    return table(spark, d, "events").select(ID, "event_type", "user_id", text.alias("payload"))


TAGS_SQL = """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'mobile' ELSE 'unknown' END AS device,
       CASE WHEN i = 0 THEN event_type ELSE CAST(user_id % 3 AS VARCHAR) END AS tag
FROM events, range(2) t(i) WHERE event_id % 5 IN (0, 1)
"""


@query("json_tags_explode", f"""{TAGS_SQL} UNION ALL
SELECT event_id, CASE event_id % 5 WHEN 3 THEN 'unknown' ELSE 'desktop' END, NULL FROM events WHERE event_id % 5 IN (2, 3, 4)""")
def json_tags_explode(spark, d):
    return q.json_tags_explode(_payloads(spark, d), "payload").select(ID, "device", "tag")


@query("explode_strict", TAGS_SQL)
def explode_strict(spark, d):
    return q.explode_strict(_payloads(spark, d), "payload").select(ID, "device", "tag")


@query("json_flatten", """
WITH o AS (SELECT o_orderkey AS row_id, o_orderpriority AS p, o_custkey AS c, o_orderstatus AS s FROM orders)
SELECT row_id, 'info.id' AS path, CAST(c AS VARCHAR) AS value, 'BIGINT' AS type FROM o
UNION ALL SELECT row_id, 'info.deep.status', s, 'STRING' FROM o
UNION ALL SELECT row_id, 'info.deep.none', NULL, 'VOID' FROM o
UNION ALL SELECT row_id, 'list.0', p, 'STRING' FROM o WHERE row_id % 3 <> 0
UNION ALL SELECT row_id, 'list.1.flag', 'true', 'BOOLEAN' FROM o WHERE row_id % 3 <> 0""")
def json_flatten_query(spark, d):
    k = F.col("o_orderkey")
    deep = obj(status=quoted(F.col("o_orderstatus")), none="null")
    many = F.concat(F.lit("["), quoted(F.col("o_orderpriority")), F.lit(',{"flag":true},{},[]]'))
    text = obj(info=obj(id=F.col("o_custkey").cast("string"), deep=deep), list=F.when(k % 3 == 0, "[]").otherwise(many))
    rows = spread(table(spark, d, "orders"), TASK_BYTES).select(k, text.alias("value"))
    return json_flatten(rows, "o_orderkey", "value")


# A stored model answer per event, wrapped or broken in eight ways.
def _answers(spark, d):
    whole, user = cents().cast("string"), quoted(F.concat(F.lit("usr_"), "user_id"))
    def tx(amount=whole, user_id=user, currency='"JPY"'):
        return obj(transaction_id=quoted(F.concat(F.lit("tx_"), ID)), user_id=user_id, amount=amount, currency=currency,
                   timestamp='"2026-06-25T15:00:00Z"')
    text = pick(ID, 8, {
        1: F.concat(F.lit("```json\n"), tx(), F.lit("\n```")),
        2: F.concat(F.lit("Here it is: "), tx(), F.lit(" hope this helps!")),
        3: F.regexp_replace(tx(currency='"gbp"'), r"\}$", ""),
        4: tx(amount=quoted(F.concat(whole, F.lit(".5"))), currency='"eur"'),
        5: tx(amount=F.concat(F.lit("-"), whole)), 6: tx(user_id='"guest_user"', currency='"XYZ"'),
        7: F.lit("I could not find any transaction.")}, tx())
    return spread(table(spark, d, "events"), TASK_BYTES).select(ID, text.alias("answer"))


@query("llm_json_heal", """
SELECT event_id, md5(CASE WHEN event_id % 8 = 7 THEN 'I could not find any transaction.' ELSE
  '{"transaction_id":"tx_' || event_id || '","user_id":"' || CASE event_id % 8 WHEN 6 THEN 'guest_user' ELSE 'usr_' || user_id END
  || '","amount":' || CASE event_id % 8 WHEN 4 THEN '"' || CAST(round(value * 100) AS BIGINT) || '.5"'
                                        WHEN 5 THEN '-' || CAST(round(value * 100) AS BIGINT)
                                        ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END
  || ',"currency":"' || CASE event_id % 8 WHEN 3 THEN 'gbp' WHEN 4 THEN 'eur' WHEN 6 THEN 'XYZ' ELSE 'JPY' END
  || '","timestamp":"2026-06-25T15:00:00Z"}' END) AS healed_md5
FROM events""")
def llm_json_heal(spark, d):
    return _answers(spark, d).select(ID, F.md5(heal_json_text("answer")).alias("healed_md5"))


# An answer is refused for its shape, or because its amount is not positive once rounded to cents.
TX_SQL = f"""
judged AS (SELECT *, {CENTS} AS c, event_id % 8 AS m FROM events),
verdict AS (SELECT *, CASE WHEN m = 7 THEN 'json' WHEN m = 6 AND c = 0 THEN 'user_id,amount,currency' WHEN m = 6 THEN 'user_id,currency'
                           WHEN m = 5 OR (m <> 4 AND c = 0) THEN 'amount' ELSE '' END AS failed_fields FROM judged)
"""


@query("tx_validate_dlq", f"""WITH {TX_SQL}
SELECT event_id, CASE WHEN failed_fields = '' THEN 'ok' ELSE 'dlq' END AS output, failed_fields,
       CASE WHEN failed_fields <> '' THEN '' WHEN m = 3 THEN 'GBP' WHEN m = 4 THEN 'EUR' ELSE 'JPY' END AS currency,
       CASE WHEN failed_fields <> '' THEN 0.0::DOUBLE WHEN m = 4 THEN c + 0.5::DOUBLE ELSE c::DOUBLE END AS amount
FROM verdict""")
def tx_validate_dlq(spark, d):
    good, bad = mo.tx_validate_dlq(_answers(spark, d), "event_id", "answer")
    fields = F.regexp_replace("error_reason", ": invalid value(, )?", ",")
    return good.select(ID, F.lit("ok").alias("output"), F.lit("").alias("failed_fields"), "currency", "amount").unionByName(
        bad.select(F.col("index").alias("event_id"), F.lit("dlq").alias("output"),
                   F.regexp_replace(fields, ",$", "").alias("failed_fields"), F.lit("").alias("currency"),
                   F.lit(0.0).alias("amount")))


# A nested order text per line item, clean or with one fault.
def _order_texts(spark, d):
    key, n = F.col("l_orderkey"), F.col("l_linenumber")
    qty, price = F.col("l_quantity").cast("long").cast("string"), F.floor("l_extendedprice").cast("string")
    total = (F.floor("l_extendedprice") * F.col("l_quantity").cast("long") + 5).cast("string")
    second = obj(item_id='"H"', price="2.5", quantity="2")
    def order(order_id="order_id", customer=None, price=price, quantity=qty, total=total, email='"mona@mail.example"',
              level='"VIP"', quantity_name="quantity", customer_name="customer", id_name="customer_id",
              key_text=quoted(key)):
        who = obj(**{id_name: quoted(F.concat(F.lit("C"), "l_suppkey")), "email": email, "membership": level})
        item = obj(**{"item_id": quoted(F.col("l_partkey")), "price": price, quantity_name: quantity})
        parts = {order_id: key_text}
        if customer is None:
            parts[customer_name] = who
        else:
            parts.update(customer)
        parts.update(items=F.concat(F.lit("["), item, F.lit(","), second, F.lit("]")), total_amount=total,
                     order_date='"2031-02-03T04:05:06Z"')
        return obj(**parts)
    text = pick(F.col("l_partkey"), 8, {
        7: order(key_text=key.cast("string")),
        1: order(price='"about 9"', quantity='"a pair"'),
        2: order(order_id="ord_number", customer_name="cust_info", id_name="cust_id", quantity_name="qty"),
        3: order(email='"mona at home"', level='"Friend"', price="-0.5"),
        4: order(customer={"customer_id": quoted(F.concat(F.lit("C"), "l_suppkey")),
                           "customer_email": '"mona@mail.example"', "customer_membership": '"Guest"'}),
        5: order(total="1.0"), 6: F.lit('{"order_id": ')}, order())
    return spread(table(spark, d, "lineitem"), TASK_BYTES).select("l_orderkey", "l_linenumber", "l_partkey", text.alias("value"))


ALL_FIELDS = "order_id,customer.customer_id,customer.email,customer.membership,items,total_amount,order_date"


@query("order_contract", f"""
SELECT l_orderkey, l_linenumber, l_partkey, CASE l_partkey % 8 WHEN 7 THEN 'order_id' WHEN 1 THEN 'items'
  WHEN 2 THEN 'order_id,customer.customer_id,customer.email,customer.membership,items'
  WHEN 3 THEN 'customer.email,customer.membership,items' WHEN 4 THEN 'customer.customer_id,customer.email,customer.membership'
  WHEN 5 THEN 'total_amount' WHEN 6 THEN '{ALL_FIELDS}' ELSE '' END AS violations FROM lineitem""")
def order_contract(spark, d):
    return _listed(mo.order_contract(_order_texts(spark, d), "value")).drop("value", "order")


@query("drift_normalise", f"""
SELECT l_orderkey, l_linenumber, l_partkey, CASE l_partkey % 8 WHEN 7 THEN 'order_id' WHEN 1 THEN 'items' WHEN 3 THEN 'customer.email,customer.membership,items'
  WHEN 5 THEN 'total_amount' WHEN 6 THEN '{ALL_FIELDS}' ELSE '' END AS violations,
  CASE WHEN l_partkey % 8 = 6 THEN '' ELSE 'C' || l_suppkey END AS customer_id FROM lineitem""")
def drift_normalise(spark, d):
    out = _listed(mo.drift_normalise(_order_texts(spark, d), "value"))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "violations",
                      F.coalesce("order.customer.customer_id", F.lit("")).alias("customer_id"))


@query("first_valid_wins", """
SELECT event_id, CASE WHEN event_id % 4 IN (1, 2) THEN 'expensive' WHEN event_id % 4 = 3 THEN 'none' ELSE 'cheap' END AS winner,
       round((120 * 0.00015::DOUBLE + 80 * 0.0006::DOUBLE) / 1000
             + CASE WHEN event_id % 4 = 0 THEN 0 ELSE ((200 + event_id % 50) * 0.003::DOUBLE + 120 * 0.015::DOUBLE) / 1000 END, 9) AS cost
FROM events""")
def first_valid_wins(spark, d):
    good = F.lit('{"sentiment": "neutral", "confidence": 0.6, "reasoning": "Does its job, no more than that."}')
    cheap = pick(ID, 4, {
        1: F.lit('{"sentiment": "delighted", "confidence": 1.2, "reasoning": "Quick"}'), 2: F.lit("No idea at all."),
        3: F.lit('{"sentiment": "neutral", "confidence": 0.6, "reasoning": "Fast"}')}, good)
    costly = pick(ID, 4, {3: F.lit("no answer")}, good)
    call = lambda tier, out, t_in, t_out: F.struct(
        F.lit(tier).alias("tier"), out.alias("output"), t_in.cast("long").alias("t_in"), F.lit(t_out).cast("long").alias("t_out"))
    calls = spread(table(spark, d, "events"), TASK_BYTES).select(ID, F.explode(F.array(
        call("cheap", cheap, F.lit(120), 80), call("expensive", costly, 200 + F.col(ID) % 50, 120))).alias("c")).select(ID, "c.*")
    out = mo.first_valid_wins(calls, "event_id", "tier", "output", "t_in", "t_out")
    return out.select(ID, F.coalesce("winner", F.lit("none")).alias("winner"), F.round("cost", 9).alias("cost"))


@query("answer_gate", f"""
SELECT doc_id, CASE WHEN doc_id % 7 IN (0, 5) THEN 'accepted' ELSE 'fallback' END AS status,
       CASE WHEN doc_id % 7 IN (0, 5) THEN 'answer ' || doc_id ELSE '{mo.FALLBACK_ANSWER}' END AS answer FROM documents""")
def answer_gate(spark, d):
    k = F.col("doc_id")
    def reply(confidence="0.9", retry="false", sources='["a"]'):
        return obj(answer=quoted(F.concat(F.lit("answer "), k)), confidence=confidence, needs_retry=retry, sources=sources)
    text = pick(k, 7, {6: reply(confidence="1.3"), 1: reply(confidence="0.69"), 2: reply(retry="true"), 3: reply(sources="[]"), 4: F.lit("no json"),
                       5: reply(confidence="0.7")}, reply())
    return mo.answer_gate(table(spark, d, "documents").select(k, text.alias("reply")), "reply").drop("reply")


@query("tool_call_parse", """
SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'call' WHEN 1 THEN 'final' WHEN 2 THEN 'error' ELSE 'none' END AS kind,
       CASE turn % 4 WHEN 0 THEN 'search_' || role WHEN 2 THEN 'search_' || role ELSE '' END AS tool,
       CASE turn % 4 WHEN 1 THEN 'done ' || conv_id ELSE '' END AS final_answer FROM conversations""")
def tool_call_parse(spark, d):
    n, head = F.col("turn"), F.concat(F.lit("考え: x\nCALL: search_"), "role")
    final = F.concat(F.lit("最終回答: done "), "conv_id", F.lit("  "))
    text = pick(n, 4, {
        0: F.concat(head, F.lit(', ARGS: {"q": "a"}\n'), final), 1: F.concat(F.lit("ok\n"), final),
        2: F.concat(head, F.lit(", ARGS: {q: }"))}, F.lit("still thinking"))
    out = mo.tool_call_parse(table(spark, d, "conversations").select("conv_id", n, text.alias("said")), "said")
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return out.select("conv_id", "turn", "kind", blank("tool"), blank("final_answer"))


@query("release_note_rollup", f"""
WITH n AS (SELECT p_partkey, 'v' || p_partkey AS version, p_name AS title, p_type AS summary, p_brand, p_size FROM part)
SELECT p_partkey, p_partkey = (SELECT max(p_partkey) FROM part) AS is_latest,
       md5('# Release Notes - ' || version || ': ' || title || chr(10) || chr(10) || '{mo.NOTE_OVERVIEW}' || chr(10) || summary || chr(10) || chr(10)
           || CASE WHEN p_partkey % 2 = 0 THEN '{mo.NOTE_FEATURES}' || chr(10) || '- ' || p_brand || chr(10) || '- size ' || p_size || chr(10) || chr(10) ELSE '' END
           || CASE WHEN p_partkey % 3 = 0 THEN '{mo.NOTE_FIXES}' || chr(10) || '- ' || title || chr(10) || chr(10) ELSE '' END
           || '---' || chr(10) || '{mo.NOTE_FOOTER}') AS markdown_md5 FROM n""")
def release_note_rollup(spark, d):
    k = F.col("p_partkey")
    none = F.array().cast("array<string>")
    notes = table(spark, d, "part").select(
        k, F.concat(F.lit("v"), k).alias("version"), F.col("p_name").alias("title"), F.col("p_type").alias("summary"),
        F.when(k % 2 == 0, F.array("p_brand", F.concat(F.lit("size "), "p_size"))).otherwise(none).alias("features"),
        F.when(k % 3 == 0, F.array("p_name")).alias("fixes"))
    return mo.release_note_rollup(notes, "p_partkey").select(k, "is_latest", F.md5("markdown").alias("markdown_md5"))
