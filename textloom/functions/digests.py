"""Digests over ordered records and canonical forms of JSON and text."""

from __future__ import annotations

import csv
import hashlib
import io
import json
from collections.abc import Callable
from pathlib import PurePath

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

DIGEST = r"^sha256:[0-9a-fA-F]{64}\z"


def sha256_of(c: Column) -> Column:
    """sha256: and the hex digest of a text's UTF-8."""
    return F.concat(F.lit("sha256:"), F.sha2(c.cast("binary"), 256))


def is_digest(c: Column) -> Column:
    return F.coalesce(c.rlike(DIGEST), F.lit(False))


def record_line(record_id: Column, content: Column) -> Column:
    return F.concat(F.coalesce(record_id, F.lit("")), F.lit("\0"), F.coalesce(content, F.lit("")), F.lit("\n"))


def ordered_digest(df: DataFrame, by: list[str], order: str, lines: Column, form: Callable[[str], str] | None = None, between: str = "") -> DataFrame:
    """by..., digest: over each group's lines put together in order, `between` between them.

    form changes each line first. Rows are dealt out by group and sorted, and hashed as they stream by in
    Arrow batches: no task holds a group's lines, however many. (A digest is of one sequence, so one task
    reads a group.) Rows of one place are taken in the order of their lines. Without groups there is one
    digest, of nothing if there are no rows.
    """
    rows = df.select(*by, F.col(order).alias("_order"), lines.alias("_line"))
    rows = (rows.repartition(*by) if by else rows.repartition(1)).sortWithinPartitions(*by, "_order", "_line")
    schema = df.select(*by).schema.add("digest", "string")
    types = [to_arrow_type(f.dataType) for f in schema.fields]

    def packed(done):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate(types)], names=schema.names)

    def run(batches):
        known, state, done = None, None, []
        for batch in batches:
            *keys, texts = (c.to_pylist() for c in batch.columns)
            if form is not None:
                texts = [form(t) for t in texts]
            keys = list(zip(*keys, strict=True)) if keys else [()] * len(texts)
            at = 0
            while at < len(texts):
                end = at + 1
                while end < len(texts) and keys[end] == keys[at]:
                    end += 1
                if state is None or keys[at] != known:
                    if state is not None:
                        done.append((*known, f"sha256:{state.hexdigest()}"))
                    known, state = keys[at], hashlib.sha256()
                else:
                    state.update(between.encode())
                for a in range(at, end, 1024):
                    state.update((between if a > at else "").encode() + between.join(texts[a : min(a + 1024, end)]).encode())
                at = end
            if len(done) >= 10_000:
                yield packed(done)
                done = []
        if state is not None:
            done.append((*known, f"sha256:{state.hexdigest()}"))
        yield packed(done)

    found = rows.select(*by, "_line").mapInArrow(run, schema)
    return found if by else found.agg(F.coalesce(F.max("digest"), F.lit(f"sha256:{hashlib.sha256().hexdigest()}")).alias("digest"))


def source_digest(df: DataFrame, by: list[str], strict: bool = True) -> DataFrame:
    """Digest of id and source_hash (or, strictly, the text where there is none) in order of ord."""
    content = F.coalesce("source_hash", "text") if strict else F.col("source_hash")
    return ordered_digest(df, by, "ord", record_line(F.col("id"), content))


def compact_json(value, drop_internal: bool = False) -> str:
    if drop_internal and isinstance(value, dict):
        value = {k: v for k, v in value.items() if not k.startswith("__")}
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def indented_json(value) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, indent=2) + "\n"


@F.pandas_udf(T.StringType())
def canonical_json(raw: pd.Series) -> pd.Series:
    """Compact JSON with sorted keys and no internal fields, of JSON texts."""
    return raw.map(lambda t: None if t is None else compact_json(json.loads(t), drop_internal=True))


def record_digest(df: DataFrame, by: list[str], raw: str = "raw") -> DataFrame:
    """Digest of whole records (JSON texts) in order of ord."""
    return ordered_digest(df, by, "ord", F.col(raw), form=lambda t: compact_json(json.loads(t), drop_internal=True) + "\n")


def canonical_text(c: Column) -> Column:
    """LF line ends and exactly one at the end."""
    return F.concat(F.regexp_replace(F.regexp_replace(c, "\r\n?", "\n"), r"\n+\z", ""), F.lit("\n"))


def canonical_tsv(content: str) -> str:
    """Cells of a tab-separated table put together again without quotes, LF line ends, one at the end."""
    rows = csv.reader(io.StringIO(content.removeprefix("\ufeff")), delimiter="\t")
    return "\n".join("\t".join(r) for r in rows).rstrip("\n") + "\n"


def relative_name(path: str, root: str, name_only: bool = False) -> str:
    """path below root with slashes; a path elsewhere by its name only, or as it is."""
    p, r = PurePath(path), PurePath(root)
    if p.is_relative_to(r):
        return p.relative_to(r).as_posix()
    return p.name if name_only else p.as_posix()


def snapshot_digest(name: str, content: str) -> str:
    """Of a decision file: canonical JSON, canonical JSON lines or LF-normalised text, by its suffix."""
    if name.endswith(".json"):
        form = compact_json(json.loads(content)) + "\n"
    elif name.endswith(".jsonl"):
        form = "".join(compact_json(json.loads(line)) + "\n" for line in content.splitlines() if line.strip())
    else:
        form = content.replace("\r\n", "\n").replace("\r", "\n").rstrip("\n") + "\n"
    return "sha256:" + hashlib.sha256(form.encode()).hexdigest()


def prefix_text(sections: list[tuple[str, str, str]]) -> tuple[str, str, dict[str, str]]:
    """The shared prefix of (title, kind, content) sections: its text, its content-addressed id and each section's digest."""
    parts, digests = [], {}
    for title, kind, content in sections:
        body = content.replace("\r\n", "\n").replace("\r", "\n").rstrip("\n") + "\n"
        digests[title] = "sha256:" + hashlib.sha256(body.encode()).hexdigest()
        parts.append(f"## {title}\n\n" + (body if kind == "text" else f"```{kind}\n{body}```\n"))
    text = "\n".join(parts)
    return text, hashlib.sha256(text.encode()).hexdigest()[:20], digests


def integrity_issues(recorded: DataFrame, contents: DataFrame) -> DataFrame:
    """name, issue: recorded (name, digest) sections that are missing from contents (name, content) or differ."""
    both = recorded.join(contents.select("name", sha256_of(canonical_text(F.col("content"))).alias("found")), "name", "left")
    return both.select("name", F.when(F.col("found").isNull(), "missing").when(F.col("found") != F.col("digest"), "digest mismatch").alias("issue")).filter("issue is not null")
