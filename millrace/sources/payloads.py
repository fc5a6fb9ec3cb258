"""Landed API payloads: paged records, meetings with speeches, trend items of several sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.functions.jsonx import once
from millrace.operators.chains import follow
from millrace.operators.running import shuffled
from millrace.session import stage_table

FIRST = ""  # stands for the cursor of the first page, which has none
RECORDS = "array<struct<id:bigint,name:string,score:bigint>>"


class MissingPage(RuntimeError):
    """A page that another page points to never arrived."""


class BrokenChain(RuntimeError):
    """Pages that follow each other in a loop, that two pages announce, or that no chain reaches."""


def chain_places(pages: DataFrame) -> DataFrame:
    """``pages(page, next)`` -> page, place: how many pages come before it, 0 for the first.

    The first page is the one without a cursor, else the one that no page announces. Places are found by pointer
    doubling, so a chain of a million pages takes twenty rounds.
    """
    before = pages.where(F.col("next").isNotNull()).groupBy(F.col("next").alias("page")).agg(
        F.min("page").alias("up"), F.count(F.lit(1)).alias("n"))
    twice = before.where("n > 1").limit(1).collect()
    if twice:
        raise BrokenChain(f"page {twice[0]['page']} is announced by more than one page")
    found = stage_table(follow(before, "page", "up"), "places")
    loop = found.where(F.col("head").isNull()).limit(1).collect()
    if loop:
        raise BrokenChain(f"page {loop[0]['node']} lies on a loop or behind one")
    heads = pages.select("page").join(shuffled(before.select("page")), "page", "left_anti").limit(2).collect()
    if len(heads) > 1:
        first = sorted((r["page"] for r in heads), key=lambda p: (p != FIRST, p))
        raise BrokenChain(f"no chain that starts at the first page reaches page {first[1]}")
    return pages.select("page").join(
        shuffled(found.select(F.col("node").alias("page"), "distance")), "page", "left").select(
        "page", F.coalesce("distance", F.lit(0)).alias("place"))


def page_payload_ingest(pages: DataFrame, cursor: str, payload: str, record: str = RECORDS,
                        records_key: str = "records", next_key: str = "next_cursor",
                        dedup_on: str | None = None) -> DataFrame:
    """Records of all landed pages.

    ``cursor`` is the cursor a page was asked with (null for the first). A null or empty next cursor
    ends the chain. A page named by another one but not landed fails the batch, and so do a loop, a page that two
    pages announce, and a page that no chain from the first one reaches. A page landed twice counts once. A ``records``
    value that is no list gives no rows. Of records that share ``dedup_on`` the first by its page's place in
    the chain and its position stays; records without that field all stay.
    """
    read = pages.dropDuplicates([cursor]).select(
        F.coalesce(F.col(cursor).cast("string"), F.lit(FIRST)).alias("page"),
        F.get_json_object(payload, f"$.{next_key}").alias("_next"),
        F.from_json(F.get_json_object(payload, f"$.{records_key}"), record).alias("_records"))
    asked = read.where((F.col("_next").isNotNull()) & (F.col("_next") != "")).select(F.col("_next").alias("page"))
    lost = asked.join(shuffled(read.select("page")), "page", "left_anti").limit(1).collect()
    if lost:
        raise MissingPage(f"page {lost[0]['page']} was announced but never arrived")
    places = chain_places(read.select("page", F.when(F.col("_next") != "", F.col("_next")).alias("next")))
    rows = read.select("page", F.posexplode_outer("_records").alias("_pos", "r")).where(F.col("r").isNotNull())
    if dedup_on:
        known = F.col(f"r.{dedup_on}").isNotNull()
        nth = F.row_number().over(W.partitionBy(f"r.{dedup_on}").orderBy("place", "_pos"))
        first = rows.where(known).join(shuffled(places), "page").withColumn("_nth", nth).where(F.col("_nth") == 1)
        rows = rows.where(~known).select("page", "r").union(first.select("page", "r"))
    return rows.select(F.when(F.col("page") != FIRST, F.col("page")).alias("page"), "r.*")


# Source names and our column names of a meeting payload.
MEETING_FIELDS = {
    "issue_id": "issueID", "image_kind": "imageKind", "search_object": "searchObject", "session": "session",
    "name_of_house": "nameOfHouse", "name_of_meeting": "nameOfMeeting", "issue": "issue", "date": "date",
    "closing": "closing",
}
SPEECH_FIELDS = {
    "speech_id": "speechID", "speech_order": "speechOrder", "speaker": "speaker", "speaker_yomi": "speakerYomi",
    "speaker_group": "speakerGroup", "speaker_position": "speakerPosition", "speaker_role": "speakerRole",
    "speech": "speech",
}
LONG_FIELDS = {"searchObject", "session", "speechOrder"}


def _ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"{s}: {'bigint' if s in LONG_FIELDS else 'string'}" for s in fields.values())


def meeting_explode(payloads: DataFrame, text: str = "value") -> DataFrame:
    """One row per speech of each meeting payload, with our column names."""
    shape = f"struct<{_ddl(MEETING_FIELDS)}, speechRecord: array<struct<{_ddl(SPEECH_FIELDS)}>>>"
    meetings = once(payloads.select(text), "m", F.from_json(text, shape))
    return meetings.select("m", F.explode("m.speechRecord").alias("s")).select(
        *[F.col(f"m.{s}").alias(n) for n, s in MEETING_FIELDS.items()],
        *[F.col(f"s.{s}").alias(n) for n, s in SPEECH_FIELDS.items()])


# Where each source keeps the common fields.
TREND_FIELDS = {
    "github": {"external_id": "id", "name": "name", "url": "html_url", "score": "stargazers_count",
               "description": "description"},
    "reddit": {"external_id": "id", "name": "title", "url": "url", "score": "ups", "description": "selftext"},
}


def trend_normalise(items: DataFrame, source: str, captured_at: Column) -> DataFrame:
    """Items of one source in the common shape; the whole item is kept as JSON in ``raw_data``."""
    f = TREND_FIELDS[source]
    return items.select(
        F.lit(source).alias("source"), F.col(f["external_id"]).cast("string").alias("external_id"),
        F.col(f["name"]).alias("name"), F.col(f["url"]).alias("url"), F.col(f["score"]).cast("long").alias("score"),
        F.col(f["description"]).alias("description"), F.to_json(F.struct(*items.columns)).alias("raw_data"),
        captured_at.alias("captured_at"))


# Fixed values of the generated transactions.
USERS, PRODUCTS, MAX_AMOUNT = 1_000_000, 500, 5000
STATUS_STEPS = {"success": 80, "failed": 95, "pending": 100}


def synthetic_transactions(ids: DataFrame, ident: str, start: str = "2026-01-01T00:00:00") -> DataFrame:
    """One generated transaction per id, the same on every run and on every retry of a task.

    Every field draws from its own hash of the id, so fields do not depend on each other.
    """
    def draw(salt: int, n: int) -> Column:
        digest = F.md5(F.concat(F.col(ident).cast("string"), F.lit(f":{salt}")))
        return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % n

    step = draw(4, 100)
    status = F.when(step < STATUS_STEPS["success"], "success").when(step < STATUS_STEPS["failed"], "failed").otherwise(
        "pending")
    stamp = F.timestamp_add("SECOND", draw(5, 86400 * 180), F.to_timestamp_ntz(F.lit(start)))
    return ids.select(
        F.col(ident).alias("transaction_id"), (draw(1, USERS) + 1).alias("user_id"),
        (draw(2, PRODUCTS) + 1).alias("product_id"), (draw(3, MAX_AMOUNT) + 1).alias("amount"),
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), status.alias("status"))
