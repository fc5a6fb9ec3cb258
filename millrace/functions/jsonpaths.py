"""Leaves of JSON texts of any depth, found in one pass over each text."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Fixed: the parts of a JSON text.
PART = re.compile(
    r'[ \t\n\r]*+(?:(?P<sign>[{}\[\],:])|(?P<text>"(?:[^"\\\x00-\x1f]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+")'
    r'|(?P<word>-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?(?![0-9A-Za-z_.+-])|(?:true|false|null)(?![0-9A-Za-z_])))')
SPACE = " \t\n\r"
NUMBER_CHARS = 1000  # longer numbers are no numbers, as in Spark's own parser

Leaf = tuple[str, str]


def leaves(text: str) -> list[Leaf] | None:
    """``(path, JSON text)`` of every leaf in order, None for a broken text.

    The brackets that are open are kept on a stack, so any depth will do. Of a repeated key the last value counts:
    the leaves of the values before are taken back.
    """
    found: list[Leaf | None] = []
    path: list[str] = []  # step into each open bracket's current value
    kinds: list[str] = []  # "{" or "["
    seen: list[dict[str, tuple[int, int]] | int] = []  # keys with their leaves, or the next list position
    began: list[int] = []  # first leaf of the current value of each open bracket
    at, end = 0, len(text)
    want = "value"
    while True:
        part = PART.match(text, at)
        if part is None:
            break
        at = part.end()
        sign, string = part["sign"], part["text"]
        if want in ("value", "first") and (string or part["word"] or sign in ("{", "[")):
            if kinds and kinds[-1] == "[":
                path[-1] = str(seen[-1])
                seen[-1] += 1
            if sign:
                kinds.append(sign)
                path.append("")
                seen.append({} if sign == "{" else 0)
                began.append(len(found))
                want = "key or end" if sign == "{" else "first"
                continue
            if part["word"] and len(part["word"]) > NUMBER_CHARS:
                return None
            found.append((".".join(path), string or part["word"]))
        elif want in ("key", "key or end") and string:
            key = json.loads(string)
            key = key.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
            for i in range(*seen[-1].get(key, (0, 0))):
                found[i] = None
            path[-1], began[-1] = key, len(found)
            want = "colon"
            continue
        elif want == "colon" and sign == ":":
            want = "value"
            continue
        elif want == "more" and sign == ",":
            want = "key" if kinds[-1] == "{" else "value"
            continue
        elif (sign == "}" and kinds and kinds[-1] == "{" and want in ("key or end", "more")) or (
                sign == "]" and kinds and kinds[-1] == "[" and want in ("first", "more")):
            for stack in (kinds, path, seen, began):
                stack.pop()
        else:
            return None
        if not kinds:  # the outermost value has ended
            break
        if kinds[-1] == "{":
            seen[-1][path[-1]] = (began[-1], len(found))
        want = "more"
    if kinds or want == "value" and not found and at == 0 or text[at:].strip(SPACE):
        return None
    return [leaf for leaf in found if leaf is not None]


def json_flatten(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """One row per leaf of a JSON text: dotted ``path``, ``value`` as text and JSON ``type``.

    Each text is scanned once, whatever its depth; the plan has one step. List positions are path steps, empty
    containers leave no row, a JSON null is a leaf, of a repeated key the last value counts. A broken, empty or null
    text leaves no row. Leaves are read by Spark's own parser, so numbers keep its types.
    """
    kind = df.schema[row_id].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, paths, parts = [], [], []
            for i, body in enumerate(batch.column(1).to_pylist()):
                for path, part in leaves(body) or ():
                    rows.append(i)
                    paths.append(path)
                    parts.append(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(paths, pa.string()), pa.array(parts, pa.string())],
                names=["row_id", "path", "part"])

    rows = df.select(F.col(row_id).alias("row_id"), F.coalesce(text, F.lit("")).alias("text")).mapInArrow(
        scan, f"row_id {kind}, path string, part string")
    leaf = F.try_parse_json("part")
    named = F.schema_of_variant(leaf)
    return rows.select("row_id", "path", F.when(named != "VOID", leaf.cast("string")).alias("value"), named.alias("type"))
