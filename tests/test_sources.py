"""Readers, sinks and fonts on files made here."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from textloom.operators import codepoints
from textloom.sources import fonts, readers, sinks

SCHEMA = "id string, text string"


def test_jsonl_policies(spark, tmp_path):
    good = tmp_path / "good.jsonl"
    good.write_bytes(b"\xef\xbb\xbf" + '{"id": "a", "text": "é"}\n\n{"id": "b", "text": "x"}\r\n'.encode())
    rows = readers.jsonl_strict(spark, str(good), SCHEMA).orderBy("ord").collect()
    assert [(r["id"], r["text"], r["line"]) for r in rows] == [("a", "é", 1), ("b", "x", 3)]
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"id": "a", "text": "x"}\nnot json\n{"id": "a", "text": "y"}\n')
    assert [r["_bad"] for r in readers.jsonl(spark, str(bad), SCHEMA).orderBy("ord").collect()] == [False, True, False]
    assert readers.jsonl_or_nothing(spark, str(bad), SCHEMA).count() == 0
    with pytest.raises(readers.SourceError, match=":2"):
        readers.jsonl_strict(spark, str(bad), SCHEMA)
    wide = tmp_path / "wide.jsonl"
    wide.write_bytes('{"id": "w", "text": "ü"}\n'.encode("utf-16"))
    assert readers.jsonl(spark, str(wide), SCHEMA).first()["text"] == "ü"


GOOD = {"id": "a", "text": "x", "source_hash": "sha256:" + "0a" * 32}


@pytest.mark.parametrize(("second", "problem"), [
    ("not json", "invalid JSON"), (json.dumps(GOOD) + " trailing", "invalid JSON"), (json.dumps(GOOD) + json.dumps(GOOD), "invalid JSON"), (json.dumps(GOOD) + "] x", "invalid JSON"), (json.dumps(GOOD) + ',"m"] x', "invalid JSON"), (json.dumps(GOOD) + ",", "invalid JSON"),
    ("7", "not an object"), ("[]", "not an object"), ('"s"', "not an object"), ("null", "not an object"), ("{}", "no string id"), (json.dumps(GOOD | {"id": 5}), "no string id"), (json.dumps(GOOD | {"id": ["q"]}), "no string id"), (json.dumps(GOOD | {"id": ""}), "no string id"),
    (json.dumps(GOOD | {"id": None}), "no string id"), (json.dumps(GOOD), "duplicate id"), (json.dumps(GOOD | {"text": 7}), "duplicate id"), (json.dumps(GOOD | {"id": "b", "text": 7}), "no string text"), (json.dumps(GOOD | {"id": "b", "text": None}), "no string text"),
    (json.dumps({"id": "b", "source_hash": GOOD["source_hash"]}), "no string text"), (json.dumps(GOOD | {"id": "b", "source_hash": "nope"}), "source_hash is no digest"), (json.dumps({"id": "b", "text": ""}), "source_hash is no digest"),
    (json.dumps(GOOD | {"id": "b", "source_hash": GOOD["source_hash"] + "\n"}), "source_hash is no digest"), (json.dumps(GOOD | {"id": "b", "source_hash": 5}), "source_hash is no digest"), (" " + json.dumps(GOOD | {"id": "b", "text": ""}) + " \t", None), ("\u3000", None),
])
def test_strict_lines(spark, tmp_path, second, problem):
    (tmp_path / "x.jsonl").write_text(json.dumps(GOOD) + "\n\n" + second + "\n", encoding="utf-8")
    read = lambda: readers.jsonl_strict(spark, str(tmp_path / "x.jsonl"), "id string, text string, source_hash string", hashed=True)
    if problem is None:
        assert read().columns == ["path", "line", "ord", "raw", "id", "text", "source_hash"]
    else:
        with pytest.raises(readers.SourceError, match=f":3: {problem}"):
            read()


def test_fields_by_type(spark, tmp_path):
    """A value of another type is never cast in silence."""
    rows = [{"s": "a", "n": 5, "d": 1.5, "t": ["x", 1, None], "b": [0]}, {"s": 5, "n": "5", "d": "1", "t": "x", "b": 0}, {"s": None, "n": True, "d": 2, "t": None, "b": ""}, {}, {"s": [], "n": 1.0, "d": False, "t": [], "b": 0.0, "route": 0}, {"b": -1, "route": "", "n": 10**30, "t": [[]]}]
    (tmp_path / "x.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    got = readers.jsonl(spark, str(tmp_path / "x.jsonl"), "s string, n long, d double, t array<string>, b boolean, route string").orderBy("ord").collect()
    assert [(r["s"], r["n"], r["d"], r["t"], r["b"], r["route"]) for r in got] == [
        ("a", 5, 1.5, ["x", None, None], True, None), (None, None, None, [None], False, None), (None, 1, 2.0, None, False, None), (None, None, None, None, False, None), (None, None, None, [], False, ""), (None, None, None, [None], True, ""),
    ]
    assert [r["_kinds"]["s"] for r in got] == ["string", "integer", "null", "missing", "array", "missing"] and [r["_kinds"]["n"] for r in got] == ["integer", "string", "boolean", "missing", "number", "number"]


def test_documents_and_tables(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"a": 1}')
    assert readers.json_document(spark, str(tmp_path / "d.json")) == {"a": 1} and readers.json_document(spark, str(tmp_path / "no.json"), default=[]) == []
    with pytest.raises(readers.SourceError):
        readers.json_document(spark, str(tmp_path / "no.json"), must=True)
    (tmp_path / "g.tsv").write_text('﻿source\ttarget\n"a\tb"\tc\nshort\n', encoding="utf-8")
    df = readers.tsv(spark, str(tmp_path / "g.tsv"), required=("source",))
    assert {tuple(r) for r in df.collect()} == {("a\tb", "c"), ("short", None)}
    (tmp_path / "s.tsv").write_text('a\tb\n1\t2\t3\n"x\ny"\t"t\tt"\t"3\n4"\t\n5\n6\t7\n', encoding="utf-8")
    assert [tuple(r) for r in readers.tsv(spark, str(tmp_path / "s.tsv"), surplus="more").collect()] == [("1", "2", ["3"]), ("x\ny", "t\tt", ["3\n4", ""]), ("5", None, None), ("6", "7", None)]
    (tmp_path / "project.json").write_text('{"source_locale": "ja"}')
    (tmp_path / "x/y").mkdir(parents=True)
    assert readers.nearest_config(str(tmp_path / "x/y")) == {"source_locale": "ja"}


def test_manifest(spark, tmp_path):
    (tmp_path / "t/B").mkdir(parents=True)
    (tmp_path / "t/a.txt").write_bytes(b"one")
    (tmp_path / "t/B/c.txt").write_bytes(b"")
    (tmp_path / "t/link").symlink_to(tmp_path / "t/a.txt")
    m = readers.manifest(spark, str(tmp_path / "t"))
    assert {r["path"]: r["size"] for r in m.collect()} == {"a.txt": 3, "B/c.txt": 0}
    assert readers.manifest_totals(m).first()["file_count"] == 2


def test_walk(spark):
    doc = json.dumps({"id": "r", "protected_tokens": ["<x>"], "items": [{"t": "a<x>"}, {"id": "k", "t": ["b", 1]}]})
    rows = readers.selected_fields(spark.createDataFrame([("p", doc)], "path string, text string"), {"t"}, {"k": ["b"]}).collect()
    assert {(r["location"], r["id"], r["text"], tuple(r["protected_tokens"])) for r in rows} == {("$#r.items[0]#r.t", "r", "a<x>", ("<x>",)), ("$#r.items[1]#k.t[0]", "k", "b", ("b",))}


def test_walk_lines(spark):
    doc = {"items": [{"t": "x", "more": {"t": ["y", 3, "z"]}}, {"id": "k", "t": "w"}], "t": "last"}
    lines = spark.createDataFrame([("p", 7, json.dumps(doc))], "path string, line int, raw string")
    got = [(r["location"], r["id"], r["text"]) for r in readers.selected_in_lines(lines, {"t"}).collect()]
    assert got == [("$:7.items[0].t", None, "x"), ("$:7.items[0].more.t[0]", None, "y"), ("$:7.items[0].more.t[2]", None, "z"), ("$:7.items[1]#k.t", "k", "w"), ("$:7.t", None, "last")]


def test_lines_of_splits(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\ufeff" + "".join(json.dumps({"id": f"a{i}", "text": "é" * (i % 90)}, ensure_ascii=False) + ("\r\n" if i % 7 else "\n\n") for i in range(900)), encoding="utf-8")
    (tmp_path / "B.jsonl").write_text('{"id": "b", "text": "x"}')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        split = readers.jsonl(spark, str(tmp_path), SCHEMA, split=True)
        assert split.select("path").rdd.getNumPartitions() >= 1
        got = [tuple(r) for r in split.orderBy("ord").select("line", "id", "text", "_bad").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [tuple(r) for r in readers.jsonl(spark, str(tmp_path), SCHEMA).orderBy("ord").select("line", "id", "text", "_bad").collect()] and len(got) == 901 and got[0][:2] == (1, "a0")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "é", 1), (1, "a", None)], "ord long, b string, a int")
    sinks.write_jsonl(df, str(tmp_path / "o"), canonical=True)
    assert (next((tmp_path / "o").glob("part-*"))).read_text() == '{"a":null,"b":"a"}\n{"a":1,"b":"é"}\n'
    f = str(tmp_path / "f")
    assert sinks.write_if_missing(spark, f, "x\n") and not sinks.write_if_missing(spark, f, "y")
    sinks.write_immutable(spark, f, "x\r\n")
    with pytest.raises(sinks.ImmutableError):
        sinks.write_immutable(spark, f, "z")
    sinks.replace_atomically(spark, f, "né\nw")
    assert sinks.read_text(spark, f) == (tmp_path / "f").read_text(encoding="utf-8") == "né\nw"
    sinks.replace_atomically(spark, f"file://{tmp_path}/new/deep", "")
    assert (tmp_path / "new/deep").read_text() == "" and [p.name for p in (tmp_path / "new").iterdir() if not p.name.endswith(".crc")] == ["deep"]


def tiny_font(groups, format_4=()):
    """A face with a cmap of format 12 groups (first, last, glyph) and format 4 segments (first, last, delta)."""
    twelve = struct.pack(">HHIII", 12, 0, 16 + 12 * len(groups), 0, len(groups)) + b"".join(struct.pack(">III", *g) for g in groups)
    segments = [*format_4, (0xFFFF, 0xFFFF, 1)]
    n = len(segments)
    four = struct.pack(">HHHHHHH", 4, 16 + 8 * n, 0, 2 * n, 0, 0, 0) + struct.pack(f">{n}H", *(s[1] for s in segments)) + b"\0\0" + struct.pack(f">{n}H", *(s[0] for s in segments)) + struct.pack(f">{n}H", *(s[2] for s in segments)) + b"\0\0" * n
    cmap = struct.pack(">HH", 0, 2) + struct.pack(">HHI", 3, 10, 20) + struct.pack(">HHI", 3, 1, 20 + len(twelve)) + twelve + four
    text = "Tiny".encode("utf-16-be")
    name = struct.pack(">HHH", 0, 1, 18) + struct.pack(">6H", 3, 1, 0x409, 4, len(text), 0) + text
    head = struct.pack(">IHHHH", 0x00010000, 2, 0, 0, 0)
    at = len(head) + 32
    return head + struct.pack(">4sIII", b"cmap", 0, at, len(cmap)) + struct.pack(">4sIII", b"name", 0, at + len(cmap), len(name)) + cmap + name


def test_fonts(spark, tmp_path):
    (tmp_path / "f.ttf").write_bytes(tiny_font([(0x1F600, 0x1F602, 5), (0x20, 0x22, 0)], [(65, 67, 10)]))
    rows = fonts.font_table(readers.files(spark, str(tmp_path))).collect()
    assert {r["cp"] for r in rows} == {0x1F600, 0x1F601, 0x1F602, 0x21, 0x22, 65, 66, 67} and rows[0]["name"] == "Tiny"
    with pytest.raises(fonts.FontError):
        fonts.character_map(b"\0\1\0\0" + b"\0" * 20, 0)
    (tmp_path / "bad.ttf").write_bytes(b"not a font at all, but long enough")
    odd = tiny_font([(5, 4, 1), (0x110000, 0x110005, 1), (0x10FFFE, 0x11FFFF, 1), (0x30, 0x31, 2)])
    assert fonts.character_map(odd, 0) == {0x10FFFE, 0x10FFFF, 0x30, 0x31}  # groups that can't be are passed over or clamped
    cut_off = struct.pack(">HHIII", 12, 0, 16 + 12, 0, 2) + struct.pack(">III", 65, 66, 1) + struct.pack(">III", 70, 71, 1)
    assert fonts.format_12_13(cut_off, 0, False) == {65, 66}
    files = readers.files(spark, str(tmp_path))
    assert [r["error"] is not None and r["path"].endswith("bad.ttf") for r in fonts.font_errors(files).collect()] == [True] and fonts.font_table(files).count() == len(rows)
    used = spark.createDataFrame([(65, 1), (90, 2)], "cp int, n long")
    cmap, few = fonts.font_table(files), spark.createDataFrame([(65, 1)], "cp int, n long")
    assert codepoints.coverage_report(few, cmap, few).first()["passed"] and not codepoints.coverage_report(few, cmap, few, fonts.font_errors(files)).first()["passed"]
    assert not codepoints.coverage_report(few.limit(0), cmap, few).first()["passed"]
    assert [r["cp"] for r in codepoints.uncovered(used, spark.createDataFrame(rows)).collect()] == [90]


def test_plain_lines_end_everywhere(spark, tmp_path):
    (tmp_path / "l.txt").write_text("a b\x85c\n", encoding="utf-8")
    assert readers.text_lines(spark, str(tmp_path / "l.txt"), unicode_ends=True).count() == 3 and readers.text_lines(spark, str(tmp_path / "l.txt")).agg(F.max("line")).first()[0] == 1


CODECS = ["utf-8", "utf-16", "utf-16-le", "utf-16-be", "cp932", "latin-1", "utf-32", None]


@pytest.mark.parametrize("codec", CODECS)
def test_lines_in_parts_are_those_of_whole_files(spark, tmp_path, codec):
    """Files of all codecs, cut at many places, also at bytes that look like LF in UTF-16."""
    ends = ["\n", "\r\n", "\r", "\n\n", "\x0b", "\x1e"]
    plain = "".join(f"line {i} " + "xyz"[: i % 4] * (i % 9) + ends[i % len(ends)] for i in range(90))
    odd = "".join(f"{i} 上下 ੁ　{'é' * (i % 5)} Ā" + ends[i % len(ends)] for i in range(30))
    texts = {"a": plain + "last", "B": plain}
    if codec != "cp932" and codec != "latin-1":
        texts |= {"c": odd}
    if codec in ("utf-8", "utf-16-le", "utf-16-be", None):  # others write a mark themselves
        texts |= {"d": "﻿" + plain.replace("y", " ")}
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_bytes(text.encode(codec or "utf-8"))
    if codec is None:
        (tmp_path / "e.txt").write_bytes(plain.encode("utf-16"))
        (tmp_path / "f.txt").write_bytes("﻿".encode("utf-16-be") + plain.encode("utf-16-be"))
    for most in ("83", "1024"):
        for wide_ends in (False, True):
            spark.conf.set("spark.sql.files.maxPartitionBytes", most + "b")
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            try:
                got = {(r["path"][-5:], r["line"]): r["value"] for r in readers.text_lines(spark, str(tmp_path), encoding=codec, unicode_ends=wide_ends).collect()}
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")
                spark.conf.unset("spark.sql.files.openCostInBytes")
            want = readers.text_lines(spark, str(tmp_path), encoding=codec, unicode_ends=wide_ends, split=False).collect()
            assert got == {(r["path"][-5:], r["line"]): r["value"].removeprefix("﻿") for r in want}


def test_lines_go_on_from_file_to_file(spark, tmp_path):
    for name, text in (("b+ü %20#", "1\n2\n\n"), ("A", "x\n"), ("c", "y")):
        (tmp_path / name).write_text(text)
    got = readers.file_order(readers.text_lines(spark, str(tmp_path), continued=True)).orderBy("ord").collect()
    assert [(r["line"], r["value"]) for r in got] == [(1, "x"), (2, "1"), (3, "2"), (4, ""), (5, "y")]
    assert readers.jsonl(spark, str(tmp_path), SCHEMA).count() == 4


def test_broken_bytes_are_an_error(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"a\xff\xfe\n")
    with pytest.raises(Exception, match="UTF-?8"):
        readers.text_lines(spark, str(tmp_path)).collect()
