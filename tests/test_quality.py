"""Contracts, JSON repair, sources and sinks on literal rows."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.jsonpaths import json_flatten, leaves
from millrace.functions.jsonx import heal_json_text, parsed
from millrace.operators import model_outputs as mo, quality as q
from millrace.sources import lines as ln, payloads as pay, tables as tab


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_sensors(spark, rows):
    values = {"roof": "-3.25", "cellar": '"11"', "gate": '"Infinity"', "well": '"warm"', "attic": "0", "shed": "null",
              "barn": "[7]"}
    texts = [f'{{"temperature": {v}, "sensor_id": "{k}"}}' for k, v in values.items()]
    texts += ['{"temperature": 4}', '{"sensor_id": "yard"}', '{"sensor_id": "pond", "temperature": 9', "[]"]
    assert sorted(rows(q.sensor_cleanse(lines(spark, texts)))) == [("attic", 0.0), ("cellar", 11.0), ("roof", -3.25)]


@pytest.mark.parametrize("text,readable", [
    ('{"a": 1}', True), (' {"a": 1} ', True), ('{"a": 1} x', False), ('{"a": 1}}', False), ('{"a": 1}]', False),
    ('{"a": 1}, {"a": 2}', False), ('{"a": 1}, "b": {"c": 2}', False), ("{'a': 1}", False), ("", False), ("{", False),
    ('{"a": 1},"\u2402end"', False), ('[{"a": 1}]', True), ("5", True), ('{"a": 1, "a": 2}', True)])
def test_only_whole_texts_are_json(spark, text, readable):
    got = lines(spark, [text]).select(parsed("value").cast("string")).first()[0]
    assert (got is not None) == readable
    if "a\": 2}" in text and readable:
        assert got == '{"a":2}'


def test_transactions_are_not_cast(spark):
    texts = ['{"user_id": "u1", "amount": 1000}', '{"user_id": "u1", "amount": "1000"}', '{"user_id": "u1", "amount": true}',
             '{"user_id": 7, "amount": 1}', '{"user_id": "u1"}', "{"]
    out = q.transaction_contract(lines(spark, texts)).collect()
    assert [r["violations"] for r in out] == [[], ["amount"], ["amount"], ["user_id"], ["amount"], ["user_id", "amount"]]


@pytest.mark.parametrize("text,minutes", [("10:15", 615), ("00:00", 0), ("23:59", 1439), ("24:00", None), ("12:60", None),
                                          ("1:2:3", None), ("ab:10", None), ("", None), ("9:05", 545)])
def test_hhmm(spark, text, minutes):
    assert lines(spark, [text]).select(q.hhmm_minutes("value")).first()[0] == minutes


def test_server_and_user_logs(spark):
    out = q.serverlog_contract(lines(spark, [
        '{"ts": 100, "val": "A"}', '{"ts": "101", "val": "A"}', '{"ts": 1.9, "val": "A"}', '{"ts": null, "val": "A"}',
        '{"ts": 1, "val": 5}', '{"ts": "x", "val": "A"}'])).collect()
    assert [(r["ts"], r["violations"]) for r in out] == [
        (100, []), (101, []), (1, []), (None, ["ts"]), (1, ["val"]), (None, ["ts"])]
    out = q.userlog_contract(lines(spark, [
        '{"timestamp": 5, "user_id": "a", "event_name": "x"}', '{"timestamp": 5, "user_id": null, "event_name": "x"}',
        '{"timestamp": 5, "user_id": " ", "event_name": "x"}', '{"timestamp": 5, "user_id": "a"}'])).collect()
    assert [r["violations"] for r in out] == [[], ["user_id"], ["user_id"], ["event_name"]]


def test_medallion_leaves_undecided_rows(spark):
    df = spark.createDataFrame([(5, "success"), (-1, "success"), (5, "odd"), (None, "failed"), (None, "odd"), (5, None)],
                               "amount int, status string")
    parts = q.medallion_split(df)
    assert [parts[b].count() for b in ("valid", "invalid", "unknown")] == [1, 3, 2]


LOGS = [(7, None, "desk@post.example", '{"device": "tv", "tags": ["jazz", "folk", "jazz"]}'),
        (8, "own@post.example", "desk@post.example", '{"tags": ["rain"]}'), (9, None, None, '{"device": "tv", "tags": ["x"]}'),
        (10, "a@post.example", None, '{"device": "radio", "tags": []}'), (11, None, "z@post.example", "no json")]


def test_contacts_and_tags(spark):
    df = spark.createDataFrame(LOGS, "log_id int, preferred_email string, backup_email string, raw_payload string")
    kept = q.coalesce_contact(df, "preferred_email", "backup_email")
    out = q.json_tags_explode(kept, "raw_payload").select("log_id", "device", "tag").collect()
    assert sorted(map(tuple, out), key=str) == sorted([
        (7, "tv", "jazz"), (7, "tv", "folk"), (7, "tv", "jazz"), (8, "unknown", "rain"), (10, "radio", None),
        (11, "unknown", None)], key=str)
    assert q.explode_strict(kept, "raw_payload").count() == 4


def payment(n, **changes):
    """A valid transaction text with ``changes``; None leaves a field out."""
    base = {"transaction_id": f"tx_k{n}", "user_id": f"usr_{40 + n}", "amount": n + 0.25, "currency": "EUR",
            "timestamp": f"2031-03-0{n % 9 + 1}T06:30:00Z"}
    return json.dumps({k: v for k, v in {**base, **changes}.items() if v is not None})


def test_transaction_texts(spark):
    texts = [payment(1), f"Sure!\n```json\n{payment(2)}\n```\nAnything {{else}}?", payment(3)[:-1], payment(4, amount="4.75", currency="jpy"),
             payment(5, amount=0), payment(6, user_id="usr_x"), payment(7, transaction_id="k7"), payment(8, currency="CHF"),
             payment(9, timestamp="soon"), payment(10, amount=None), "[1, 2]", "nothing here", payment(11) + payment(12)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    good, bad = mo.tx_validate_dlq(df, "i", "text")
    assert [(r["i"], r["currency"], r["amount"]) for r in good.orderBy("i").collect()] == [
        (0, "EUR", 1.25), (1, "EUR", 2.25), (2, "EUR", 3.25), (3, "JPY", 4.75)]
    assert [(r["index"], r["error_reason"].split(":")[0]) for r in bad.orderBy("index").collect()] == [
        (4, "amount"), (5, "user_id"), (6, "transaction_id"), (7, "currency"), (8, "timestamp"), (9, "amount"),
        (10, "json"), (11, "json"), (12, "json")]


def test_streamed_transactions_have_a_looser_contract(spark):
    texts = [payment(1, timestamp=None, currency="CHF", transaction_id="any", user_id="guest"), payment(2, user_id=5),
             payment(3, transaction_id=7), payment(4, currency=None), payment(5, amount=-1), "{"]
    got = mo.streamed_transaction(spark.createDataFrame(list(enumerate(texts)), "i int, value string"), "value").orderBy("i")
    assert [r["violations"] for r in got.collect()] == [[], ["user_id"], ["transaction_id"], ["currency"], ["amount"], ["json"]]


def test_answers_need_a_confidence_up_to_one(spark):
    def reply(confidence, **changes):
        return json.dumps({"answer": "a", "confidence": confidence, "needs_retry": False, "sources": ["s"], **changes})
    texts = [reply(0.7), reply(1.0), reply(1.01), reply(95), reply(0.69), reply(0.9, sources=[]), reply(0.9, needs_retry=True)]
    got = mo.answer_gate(spark.createDataFrame(list(enumerate(texts)), "i int, r string"), "r").orderBy("i").collect()
    assert [r["status"] for r in got] == ["accepted"] * 2 + ["fallback"] * 5


@pytest.mark.parametrize("text,healed", [
    ("  no braces ", "no braces"), ('} then {"a": 1', '{"a": 1}'), ('x {"a": {"b": 1}} y } z', '{"a": {"b": 1}} y }'),
    ("{", "{}"), ('```\n{"a": 1}\n```', '{"a": 1}'), ('{note} see ```json\n{"a": 1}\n``` {end}', '{"a": 1}'), ('{"a": "x\ny"} t', '{"a": "x\ny"}')])
def test_heal(spark, text, healed):
    assert lines(spark, [text]).select(heal_json_text("value")).first()[0] == healed


def order(**changes):
    base = {"order_id": "P7", "customer": {"customer_id": "K2", "email": "kim@shop.example", "membership": "Guest"},
            "items": [{"item_id": "cup", "price": 3.2, "quantity": 5}, {"item_id": "jug", "price": 8, "quantity": 1}],
            "total_amount": 24, "order_date": "2031-01-31T18:05:00Z"}
    base.update(changes)
    return json.dumps({k: v for k, v in base.items() if v is not None})


def who(**changes):
    return {"customer_id": "K2", "email": "kim@shop.example", "membership": "Guest", **changes}


CASES = {  # text, violations of the contract, violations after mapping the drifted names back
    "good": (order(), [], []),
    "no items": (order(items=[], total_amount=3), [], []),
    "numeric ids": (order(order_id=7, customer=who(customer_id=2)), ["order_id", "customer.customer_id"],
                    ["order_id", "customer.customer_id"]),
    "numeric item id": (order(items=[{"item_id": 4, "price": 24, "quantity": 1}]), ["items"], ["items"]),
    "free item": (order(items=[{"item_id": "pin", "price": 0, "quantity": 1}], total_amount=0), ["items"], ["items"]),
    "half an item": (order(items=[{"item_id": "pin", "price": 48, "quantity": 0.5}]), ["items"], ["items"]),
    "wrong sum": (order(total_amount=24.02), ["total_amount"], ["total_amount"]),
    "close sum": (order(total_amount=24.005), [], []),
    "address": (order(customer=who(email="kim@shop")), ["customer.email"], ["customer.email"]),
    "level": (order(customer=who(membership="Gold")), ["customer.membership"], ["customer.membership"]),
    "date": (order(order_date="31.01.2031"), ["order_date"], ["order_date"]),
    "renamed": (order(order_id=None, ord_number="P8", customer=None,
                      cust_info={"cust_id": "K3", "email": "lee@shop.example", "membership": "VIP"},
                      items=[{"item_id": "cup", "price": 12, "qty": 2}]),
                ["order_id", "customer.customer_id", "customer.email", "customer.membership", "items"], []),
    "flat": (order(customer=None, customer_id="K4", customer_email="sol@shop.example", customer_membership="Regular"),
             ["customer.customer_id", "customer.email", "customer.membership"], []),
}


@pytest.mark.parametrize("drift", [False, True])
def test_order_contract_and_drift(spark, drift):
    df = spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], "i string, text string")
    got = (mo.drift_normalise if drift else mo.order_contract)(df, "text").collect()
    assert {r["i"]: r["violations"] for r in got} == {k: v[1 + drift] for k, v in CASES.items()}


def test_first_valid_wins(spark):
    good = '{"sentiment": "neutral", "confidence": 0.6, "reasoning": "Does its job, no more than that."}'
    bad = '{"sentiment": "delighted", "confidence": 1.2, "reasoning": "Quick"}'
    data = [("love", "cheap", bad, 120, 80), ("love", "expensive", good, 250, 120), ("ok", "cheap", good, 120, 80),
            ("crash", "cheap", "plain text", 120, 80), ("crash", "expensive", good, 250, 120), ("lost", "cheap", bad, 120, 80)]
    df = spark.createDataFrame(data, "q string, tier string, out string, a long, b long")
    got = {r["q"]: (r["winner"], r["cost"]) for r in mo.first_valid_wins(df, "q", "tier", "out", "a", "b").collect()}
    low, high = 120 * 0.00015 / 1000 + 80 * 0.0006 / 1000, 250 * 0.003 / 1000 + 120 * 0.015 / 1000
    assert got["ok"] == ("cheap", pytest.approx(low))
    assert got["love"] == got["crash"] == ("expensive", pytest.approx(low + high))
    assert got["lost"] == (None, pytest.approx(low))


@pytest.mark.parametrize("text,number", [
    ("最終解答: 10 of 99", "10"), ("#### -3 then 5", "-3"), ("The Answer Is 29.", "29"), ("so it is 50  ", "50"),
    ("first 4 then 8 apples", "8"), ("none", None)])
def test_final_number(spark, text, number):
    assert lines(spark, [text]).select(mo.final_number("value")).first()[0] == number


def test_release_notes(spark):
    df = spark.createDataFrame([(1, "v1", "T", "S", ["f1", "f2"], []), (2, "v2", "U", "R", None, ["x"])],
                               "n int, version string, title string, summary string, features array<string>, fixes array<string>")
    out = mo.release_note_rollup(df, "n").orderBy("n").collect()
    assert out[0]["markdown"].startswith("# Release Notes - v1: T\n\n") and "- f2\n" in out[0]["markdown"]
    assert mo.NOTE_FIXES not in out[0]["markdown"] and mo.NOTE_FEATURES not in out[1]["markdown"]
    assert [r["is_latest"] for r in out] == [False, True]


def test_flatten(spark):
    doc = {"a": {"b": [1, {"c": "x"}, [], {}]}, "n": None, "t": True, "e": {}, "f": 1.5}
    out = json_flatten(spark.createDataFrame([(1, json.dumps(doc)), (2, '"root"'), (3, "{broken"), (4, "[]")],
                                             "id int, j string"), "id", "j")
    got = {(r["row_id"], r["path"]): r["value"] for r in out.collect()}
    assert got == {(1, "a.b.0"): "1", (1, "a.b.1.c"): "x", (1, "n"): None, (1, "t"): "true", (1, "f"): "1.5", (2, ""): "root"}


@pytest.mark.parametrize("depth", [1, 40, 1000, 20_000])
def test_flatten_any_depth(spark, depth):
    """Beside a flat row, brackets in strings, and input columns named like the output."""
    deep = "[" * depth + '"{[ \\" ]"' + "]" * depth
    df = spark.createDataFrame([("r1", deep), ("r2", '{"k": 5}'), ("r3", "{[")], "path string, v string")
    got = {(r["row_id"], r["path"]): r["value"] for r in json_flatten(df, "path", "v").collect()}
    assert got == {("r1", ".".join("0" * depth)): '{[ " ]', ("r2", "k"): "5"}


def test_flatten_plan_has_no_levels(spark):
    """One step over the texts, whatever they hold; nothing runs before the result is asked for."""
    sizes = set()
    for depth in (1, 500):
        df = spark.createDataFrame([(1, "[" * depth + "1" + "]" * depth)], "id int, j string")
        sizes.add(len(json_flatten(df, "id", "j")._jdf.queryExecution().executedPlan().toString().splitlines()))
    assert len(sizes) == 1


def walked(value, path=()):
    if isinstance(value, dict):
        return [x for k, v in value.items() for x in walked(v, (*path, k))]
    if isinstance(value, list):
        return [x for i, v in enumerate(value) for x in walked(v, (*path, str(i)))]
    return [(".".join(path), value)]


def test_leaves_equal_a_parser():
    """Random documents with odd keys, escapes and blanks; and texts that lost or gained a character."""
    rng = random.Random(11)

    def value(depth):
        kind = rng.random()
        if depth and kind < 0.3:
            return {rng.choice(["a", "b.c", "", 'q"', "\\", "日", "\n", "{", "k%d" % rng.randint(0, 9)]): value(depth - 1)
                    for _ in range(rng.randint(0, 4))}
        if depth and kind < 0.55:
            return [value(depth - 1) for _ in range(rng.randint(0, 4))]
        return rng.choice([None, True, False, 0, -1, 12345678901234567890, 1.5, -2e-7, "", "x", ']"[', "\u00e9\t", "}{"])

    for _ in range(400):
        doc = value(6)
        text = json.dumps(doc, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2]))
        assert [(p, json.loads(t)) for p, t in leaves(text)] == walked(doc)
        at = rng.randrange(len(text))
        hurt = rng.choice([text[:at] + text[at + 1:], text[:at] + rng.choice('{}[],:"1 x') + text[at:], text[:at]])
        try:
            doc = json.loads(hurt, strict=True, parse_constant=lambda c: 1 / 0)
        except (ValueError, ZeroDivisionError):
            assert leaves(hurt) is None, hurt
        else:
            assert [(p, json.loads(t)) for p, t in leaves(hurt)] == walked(doc), hurt


@pytest.mark.parametrize("text,found", [
    ('{"a": 1, "b": {"c": 2}, "a": {"d": 3}}', [("b.c", "2"), ("a.d", "3")]),
    ('{"a": {"x": 1, "y": [1, 2]}, "a": {}}', []), ('[{"a": 1, "a": 2}, 3]', [("0.a", "2"), ("1", "3")]),
    (' "s" ', [("", '"s"')]), ("", None), ("  ", None), ("1 2", None), ("[1,]", None), ("[,1]", None), ("{,}", None), ('{"a"}', None),
    ('{"a":}', None), ("[1 2]", None), ("01", None), ("1.", None), ("NaN", None), ("'a'", None), ("]", None), ("[}", None),
    ('{"a":1', None), ("9" * 1001, None), ('"\x01"', None), ("truex", None), ("[[]]", []), ("{}", []), (":", None),
])
def test_leaves(text, found):
    assert leaves(text) == found


def test_scans(spark, rows, tmp_path):
    path = str(tmp_path / "in")
    lines(spark, ['{"log": "[ERROR] a"}', "", '{"log": "fine"}', '{"log": "b", "t": "ERROR"}', '{"x": "ERROR"}',
                  "{ERROR broken"]).coalesce(1).write.text(path)
    read = ln.read_lines(spark, path)
    assert read.count() == 5
    assert sorted(r["log"] for r in ln.error_line_scan(read).collect()) == ["[ERROR] a", "b"]
    good, bad = ln.jsonl_scan_defensive(read, "log string")
    assert good.count() == 4 and [r["value"] for r in bad.collect()] == ["{ERROR broken"]


def test_payment_sums(spark, rows):
    texts, expected = [], {}
    for user, amount, status in [("ann", 3, "success"), ("bo", 4.5, "success"), ("ann", 10, "success"), ("ann", 99, "failed"),
                                 ("cy", 7, "no success"), (None, 5, "success"), ("bo", "8", "success"), ("bo", True, "success")]:
        texts.append(json.dumps({"status": status, "amount": amount, "user_id": user}))
        if status == "success" and type(amount) in (int, float):
            expected[user] = expected.get(user, 0) + amount
    texts += [t[:-1] for t in texts] + ['{"status": "success", "amount": 1}']
    assert dict(rows(ln.prefiltered_parse_agg(lines(spark, texts)))) == expected


def rolled(spark, df, path, bound):
    ln.rolled_file_sink(df, str(path), max_bytes=bound)
    files = [f for f in path.rglob("part-*") if not f.name.endswith(".crc")]
    return files, spark.read.option("recursiveFileLookup", True).json(str(path)).count()


def test_rolled_files_stay_below_the_bound(spark, tmp_path):
    df = spark.range(500).select("id", F.repeat(F.lit("x"), 50).alias("pad")).coalesce(1)
    files, count = rolled(spark, df, tmp_path / "out", 2000)
    assert count == 500 and all(os.path.getsize(f) <= 2000 for f in files)
    assert len(files) <= -(-sum(os.path.getsize(f) for f in files) // (2000 - 80))


def test_one_long_line_is_a_file_of_its_own(spark, tmp_path):
    df = spark.range(2000).select("id", F.repeat(F.lit("y"), F.when(F.col("id") == 700, 9000).otherwise(5)).alias("pad"))
    files, count = rolled(spark, df.coalesce(1), tmp_path / "out", 5000)
    assert count == 2000 and len(files) <= 17 and sum(os.path.getsize(f) > 5000 for f in files) == 1


def test_snapshots_by_partition(spark, tmp_path):
    df = spark.createDataFrame([("github", "Data Lake", "20260101_000000", 1)], "source string, query string, captured_at string, n int")
    tab.partitioned_snapshot_write(df, str(tmp_path / "raw"))
    assert (tmp_path / "raw/source=github/query=data_lake/captured_at=20260101_000000").is_dir()


PAGES = [(None, '{"records": [{"id": 31, "name": "oak", "score": 4}], "next_cursor": "n7"}'),
         ("n7", '{"records": [{"id": 12, "name": "elm"}, {"id": 13, "name": "fir", "score": 0}], "next_cursor": "n9"}'),
         ("n9", '{"records": "nothing", "next_cursor": "n2"}'), ("n2", '{"records": [{"id": 40, "score": -2}], "next_cursor": ""}')]


def test_pages(spark):
    out = pay.page_payload_ingest(spark.createDataFrame(PAGES, "cursor string, body string"), "cursor", "body").collect()
    assert sorted(((r["id"], r["score"]) for r in out), key=str) == [(12, None), (13, 0), (31, 4), (40, -2)]
    with pytest.raises(pay.MissingPage, match="n9"):
        pay.page_payload_ingest(spark.createDataFrame(PAGES[:2], "cursor string, body string"), "cursor", "body")


def test_meetings(spark):
    body = json.dumps({"issueID": "I1", "session": 217, "nameOfMeeting": "M", "date": "2026-03-12", "speechRecord": [
        {"speechID": "I1-1", "speechOrder": 1, "speaker": "A", "speech": "x"}, {"speechID": "I1-2", "speechOrder": 2, "speaker": "B", "speech": "y"}]})
    out = pay.meeting_explode(lines(spark, [body, '{"issueID": "I2", "speechRecord": []}', '{"issueID": "I3"}'])).collect()
    assert [(r["issue_id"], r["speech_id"], r["speech_order"], r["name_of_meeting"]) for r in out] == [
        ("I1", "I1-1", 1, "M"), ("I1", "I1-2", 2, "M")]


def test_generated_transactions_repeat(spark):
    ids = spark.range(1000).withColumnRenamed("id", "n")
    one = pay.synthetic_transactions(ids, "n")
    assert one.exceptAll(pay.synthetic_transactions(ids.repartition(7), "n")).isEmpty()
    shares = {r["status"]: r["count"] for r in one.groupBy("status").count().collect()}
    assert 700 < shares["success"] < 900 and shares["failed"] > shares["pending"]
    assert one.where("amount not between 1 and 5000 or product_id not between 1 and 500").isEmpty()
