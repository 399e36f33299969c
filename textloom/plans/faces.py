"""Queries over fonts, which are made here of the code points of the tables' texts."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import text as X
from textloom.operators import codepoints
from textloom.plans import fixtures as fx
from textloom.plans.registry import query
from textloom.sources import fonts


def runs(cps: list[int]) -> list[tuple[int, int]]:
    """First and last of each run of consecutive code points."""
    out: list[list[int]] = []
    for cp in sorted(cps):
        if out and cp == out[-1][1] + 1:
            out[-1][1] = cp
        else:
            out.append([cp, cp])
    return [tuple(r) for r in out]


def face(cps: list[int], at: int) -> bytes:
    """A face with nothing but a character map of format 12, to stand at a place in a file."""
    groups = runs(cps)
    table = struct.pack(">HHIII", 12, 0, 16 + 12 * len(groups), 0, len(groups)) + b"".join(struct.pack(">III", a, b, a + 1) for a, b in groups)
    cmap = struct.pack(">HHHHI", 0, 1, 3, 10, 12) + table
    return struct.pack(">IHHHH", 0x00010000, 1, 0, 0, 0) + struct.pack(">4sIII", b"cmap", 0, at + 28, len(cmap)) + cmap


def collection(parts: list[list[int]]) -> bytes:
    """A collection of a face for each part, and one face more that points beyond the file."""
    head = 12 + 4 * (len(parts) + 1)
    places, body = [], b""
    for cps in parts:
        places.append(head + len(body))
        body += face(cps, places[-1])
    return b"ttcf" + struct.pack(">HHI", 2, 0, len(parts) + 1) + struct.pack(f">{len(parts) + 1}I", *places, head + len(body) + 1000) + body


@F.pandas_udf(T.BinaryType())
def as_collection(low: pd.Series, high: pd.Series) -> pd.Series:
    """Collections of two faces, of ASCII and of other code points."""
    return pd.Series([collection([sorted(a), sorted(b)]) for a, b in zip(low, high, strict=True)])


CPS = """c AS (SELECT DISTINCT lang, unnest(regexp_split_to_array(text, '')) AS c FROM documents WHERE lang IS NOT NULL), v AS (SELECT lang, unicode(c) AS cp FROM c WHERE c <> '' AND NOT regexp_matches(c, '[\\p{C}\\p{Z}\\t\\n\\v\\f\\r]'))"""


@query(f"""WITH {CPS} SELECT 'missing' AS kind, lang, cp, 'U+' || CASE WHEN length(to_hex(cp)) < 4 THEN lpad(to_hex(cp), 4, '0') ELSE to_hex(cp) END AS label FROM v WHERE cp % 3 = 0
UNION ALL SELECT 'error', lang, 2, NULL FROM v GROUP BY lang""")
def font_coverage(spark, sf_dir):
    """A font for each language, without a third of its code points and with a broken third face; what the
    language's texts need and its font lacks."""
    d = fx.table(spark, sf_dir, "documents").filter("lang is not null").select(F.col("lang").alias("location"), F.lit(0).cast("long").alias("ord"), "text")
    used = codepoints.characters(d).select(F.col("location").alias("lang"), "cp").distinct()
    some = used.filter("cp % 3 > 0").groupBy("lang").agg(F.collect_set(F.when(F.col("cp") < 128, F.col("cp"))).alias("low"), F.collect_set(F.when(F.col("cp") >= 128, F.col("cp"))).alias("high"))  # a language's code points are few
    files = used.select("lang").distinct().join(some, "lang", "left").select(F.concat("lang", F.lit(".ttc")).alias("path"), as_collection(F.coalesce("low", F.array().cast("array<int>")), F.coalesce("high", F.array().cast("array<int>"))).alias("content"))
    name = F.regexp_extract("path", r"^(.*)\.ttc$", 1)
    mapped = fonts.font_table(files).select(name.alias("lang"), "cp")
    lacking = used.join(mapped, ["lang", "cp"], "left_anti").select(F.lit("missing").alias("kind"), "lang", "cp", X.codepoint_label(F.col("cp")).alias("label"))
    errors = fonts.font_errors(files).select(F.lit("error").alias("kind"), name.alias("lang"), F.col("face").alias("cp"), F.lit(None).cast("string").alias("label"))
    return lacking.unionAll(errors)
