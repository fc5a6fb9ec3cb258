"""Contracts on incoming rows: what is accepted, what goes to the dead-letter output and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.jsonx import (
    field, is_integer, is_present, is_text, kind_of, number, once, parsed, whole_number)

UNKNOWN_EMAIL = "unknown@example.com"
UNKNOWN_DEVICE = "unknown"
TRANSACTION_STATUSES = ["success", "failed", "pending"]


def violations(checks: dict[str, Column]) -> Column:
    """Names of the failed checks, in the order given. A check that is null has failed."""
    names = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]
    return F.array_compact(F.array(*names))


def split_valid(df: DataFrame, violation: str = "violations") -> tuple[DataFrame, DataFrame]:
    """Rows without and with violations."""
    return df.where(F.size(violation) == 0).drop(violation), df.where(F.size(violation) > 0)


def sensor_cleanse(lines: DataFrame, text: str = "value") -> DataFrame:
    """Sensor id and finite temperature of each readable line; other lines are dropped."""
    v = F.col("_v")
    rows = once(lines, "_v", parsed(text)).where(is_present(v, "sensor_id") & is_present(v, "temperature"))
    reading = rows.withColumn("temperature", number(field(v, "temperature")))
    kept = [c for c in lines.columns if c != text]
    return reading.where(F.col("temperature").isNotNull()).select(
        *kept, field(v, "sensor_id").alias("sensor_id"), "temperature")


def user_contract(lines: DataFrame, text: str = "value") -> DataFrame:
    """``user_id`` and ``country`` must be JSON text."""
    v = F.col("_v")
    rows = once(lines, "_v", parsed(text))
    return rows.select(
        *lines.columns, field(v, "user_id").alias("user_id"), field(v, "country").alias("country"),
        violations({"user_id": is_text(v, "user_id"), "country": is_text(v, "country")}).alias("violations"))


def transaction_contract(lines: DataFrame, text: str = "value") -> DataFrame:
    """``user_id`` must be JSON text and ``amount`` a JSON integer; nothing is cast."""
    v = F.col("_v")
    rows = once(lines, "_v", parsed(text))
    return rows.select(
        *lines.columns, field(v, "user_id").alias("user_id"),
        F.when(is_integer(v, "amount"), field(v, "amount", "long")).alias("amount"),
        violations({"user_id": is_text(v, "user_id"), "amount": is_integer(v, "amount")}).alias("violations"))


def hhmm_minutes(text: Column | str) -> Column:
    """Minutes of the day of ``HH:MM``, null outside 00:00 to 23:59 or with another shape."""
    raw = F.col(text) if isinstance(text, str) else text
    parts = F.split(raw, ":", -1)
    hour, minute = whole_number(F.get(parts, 0)), whole_number(F.get(parts, 1))
    ok = (F.size(parts) == 2) & hour.between(0, 23) & minute.between(0, 59)
    return F.when(ok, (hour * 60 + minute).cast("int"))


def hhmm_parse(df: DataFrame, text: str, name: str = "minute_of_day") -> DataFrame:
    """Rows with a readable clock time, and its minute of the day."""
    return df.withColumn(name, hhmm_minutes(text)).where(F.col(name).isNotNull())


def _epoch(variant: Column, path: str) -> Column:
    """Whole seconds: integers and integer text as they are, fractions cut towards zero."""
    kind = kind_of(variant, path)
    real = (kind == "DOUBLE") | (kind == "FLOAT") | kind.startswith("DECIMAL")
    cut = field(variant, path, "double")
    return F.when(real, cut.try_cast("long")).otherwise(whole_number(field(variant, path)))


def userlog_contract(lines: DataFrame, text: str = "value") -> DataFrame:
    """timestamp, user_id and event_name present and not null, user not blank, timestamp a number."""
    v = F.col("_v")
    rows = once(lines, "_v", parsed(text))
    filled = lambda p: F.coalesce(kind_of(v, p) != "VOID", F.lit(False))
    stamp = _epoch(v, "timestamp")
    return rows.select(
        *lines.columns, stamp.alias("timestamp"), field(v, "user_id").alias("user_id"),
        field(v, "event_name").alias("event_name"),
        violations({
            "timestamp": filled("timestamp") & stamp.isNotNull(),
            "user_id": is_text(v, "user_id") & (F.trim(field(v, "user_id")) != ""),
            "event_name": filled("event_name"),
        }).alias("violations"))


def serverlog_contract(lines: DataFrame, text: str = "value") -> DataFrame:
    """``ts`` a number and ``val`` text, both not null."""
    v = F.col("_v")
    rows = once(lines, "_v", parsed(text))
    stamp = _epoch(v, "ts")
    return rows.select(
        *lines.columns, stamp.alias("ts"), field(v, "val").alias("val"),
        violations({"ts": stamp.isNotNull(), "val": is_text(v, "val")}).alias("violations"))


def medallion_bucket(amount: Column, status: Column, statuses: list[str] | None = None) -> Column:
    """``valid``, ``invalid`` or ``unknown`` (neither rule decides, because a value is null)."""
    known = status.isin(statuses or TRANSACTION_STATUSES)
    good = (amount >= 0) & known
    bad = (amount < 0) | ~known
    return F.when(good, "valid").when(bad, "invalid").otherwise("unknown")


def medallion_split(df: DataFrame, amount: str = "amount", status: str = "status") -> dict[str, DataFrame]:
    """The frame once with its bucket column, and one filtered frame per bucket."""
    marked = df.withColumn("bucket", medallion_bucket(F.col(amount), F.col(status)))
    return {"marked": marked, **{b: marked.where(F.col("bucket") == b).drop("bucket")
                                 for b in ("valid", "invalid", "unknown")}}


def coalesce_contact(df: DataFrame, preferred: str, backup: str, name: str = "contact_email") -> DataFrame:
    """First known address; rows that end up with the placeholder are dropped."""
    return df.withColumn(name, F.coalesce(preferred, backup, F.lit(UNKNOWN_EMAIL))).where(
        F.col(name) != UNKNOWN_EMAIL)


def _tags(df: DataFrame, payload: str) -> DataFrame:
    schema = "struct<device:string,tags:array<string>>"
    return once(df, "_p", F.from_json(payload, schema)).withColumn(
        "device", F.coalesce("_p.device", F.lit(UNKNOWN_DEVICE)))


def json_tags_explode(df: DataFrame, payload: str) -> DataFrame:
    """One row per tag of the payload; a row without tags stays once with a null tag."""
    return _tags(df, payload).withColumn("tag", F.explode_outer("_p.tags")).drop("_p", payload)


def explode_strict(df: DataFrame, payload: str) -> DataFrame:
    """One row per tag; rows without tags vanish."""
    return _tags(df, payload).withColumn("tag", F.explode("_p.tags")).drop("_p", payload)
