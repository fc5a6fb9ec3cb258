"""Column helpers for JSON text of uncertain quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: what counts as a finite decimal number in text.
NUMBER_TEXT = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is computed exactly once per row.

    A plain computed column is copied into every filter pushed below it, so a parse that six checks
    look at would run six times. The planner does not move conditions through a generator.
    """
    return df.withColumn("_once", value).select(*df.columns, F.explode_outer(F.array("_once")).alias(name))


# Fixed value: follows the text so that a parse which stops early is noticed.
END_MARK = "\u2402end"


def parsed(text: Column | str) -> Column:
    """VARIANT of a JSON text, null when it is broken or anything follows the JSON value.

    The built-in parser reads one value and ignores the rest of the text. Here the text is read as
    the first of two array items; only if the second is still the mark did the text end in time.
    """
    body = F.col(text) if isinstance(text, str) else text
    pair = F.try_parse_json(F.concat(F.lit("["), body, F.lit(f',"{END_MARK}"]')))
    whole = (F.try_variant_get(pair, "$[1]", "string") == END_MARK) & F.try_variant_get(pair, "$[2]", "variant").isNull()
    return F.when(whole, F.try_variant_get(pair, "$[0]", "variant"))


def field(variant: Column, path: str, kind: str = "string") -> Column:
    """Typed field of a VARIANT, null when missing or of another kind."""
    return F.try_variant_get(variant, f"$.{path}", kind)


def kind_of(variant: Column, path: str) -> Column:
    """Kind of a field: BIGINT, DOUBLE, DECIMAL(..), STRING, BOOLEAN, VOID (JSON null), or null when missing."""
    return F.schema_of_variant(F.try_variant_get(variant, f"$.{path}", "variant"))


def is_integer(variant: Column, path: str) -> Column:
    """True for a JSON integer; text and booleans do not count."""
    return F.coalesce(kind_of(variant, path) == "BIGINT", F.lit(False))


def is_text(variant: Column, path: str) -> Column:
    return F.coalesce(kind_of(variant, path) == "STRING", F.lit(False))


def is_present(variant: Column, path: str) -> Column:
    """The key is there, whatever its value; a JSON null counts as present."""
    return kind_of(variant, path).isNotNull()


def number(text: Column) -> Column:
    """Finite double of a plain decimal text, else null. ``NaN``, ``inf`` and type suffixes are refused."""
    value = F.when(text.rlike(NUMBER_TEXT), F.trim(text).try_cast("double"))
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def whole_number(text: Column) -> Column:
    """Long of an integer text, else null."""
    return F.when(text.rlike(INTEGER_TEXT), F.trim(text).try_cast("long"))


# A fenced block, wherever it stands in a text.
FENCED = r"(?s)```(?:json)?\s*\n(.*?)\n\s*```"
# First ``{`` to last ``}`` after it, with what surrounds them; and an object that is never closed.
AROUND_OBJECT = r"(?s)^[^{]*(\{.*\})[^}]*$"
OPEN_OBJECT = r"(?s)^[^{]*(\{[^}]*)$"
OUTER_SPACE = r"^\s+|\s+$"


def heal_json_text(text: Column | str) -> Column:
    """Strip a code fence and surrounding prose; close an object that was cut off."""
    whole = F.col(text) if isinstance(text, str) else text
    fenced = F.regexp_extract(whole, FENCED, 1)
    body = F.regexp_replace(F.when(fenced.contains("{"), fenced).otherwise(whole), OUTER_SPACE, "")
    body = F.regexp_replace(body, r"^```(?:json)?\n", "")
    body = F.regexp_replace(F.regexp_replace(body, r"\n```$", ""), OUTER_SPACE, "")
    return F.regexp_replace(trim_to_object(body), OPEN_OBJECT, "$1}")


def trim_to_object(line: Column | str) -> Column:
    """First ``{`` to last ``}`` of a line that has both in that order, else the line as it is."""
    return F.regexp_replace(line, AROUND_OBJECT, "$1")
