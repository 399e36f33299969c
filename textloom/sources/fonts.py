"""Character maps of TrueType and OpenType files and collections, as a table of code points.

The layouts are those of the OpenType specification: a collection lists its faces' offsets, a face
lists its tables, and `cmap` lists subtables by platform and encoding in several formats.
"""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import DataFrame

COLUMNS = "path string, face int, name string, cp int, error string"


class FontError(ValueError):
    """Bytes that aren't a font with a Unicode character map."""


def read(layout: str, data: bytes, at: int) -> tuple:
    try:
        return struct.unpack_from(">" + layout, data, at)
    except struct.error as e:
        raise FontError("truncated font") from e


def faces(data: bytes) -> list[int]:
    if data[:4] != b"ttcf":
        return [0]
    (n,) = read("I", data, 8)
    if not 1 <= n <= 4096:
        raise FontError("implausible number of faces")
    return list(read(f"{n}I", data, 12))


def tables(data: bytes, face: int) -> dict[bytes, tuple[int, int]]:
    (n,) = read("H", data, face + 4)
    entries = (read("4sIII", data, face + 12 + 16 * i) for i in range(n))
    return {tag: (offset, size) for tag, _, offset, size in entries}


def format_4(data: bytes, at: int) -> set[int]:
    (doubled,) = read("H", data, at + 6)
    n = doubled // 2
    ends = read(f"{n}H", data, at + 14)
    starts = read(f"{n}H", data, at + 16 + 2 * n)
    deltas = read(f"{n}H", data, at + 16 + 4 * n)
    ranges_at = at + 16 + 6 * n
    offsets = read(f"{n}H", data, ranges_at)
    found = set()
    for i, (first, last, delta, offset) in enumerate(zip(starts, ends, deltas, offsets, strict=True)):
        for cp in range(first, min(last, 0xFFFE) + 1):
            glyph = cp
            if offset:
                at_glyph = ranges_at + 2 * i + offset + 2 * (cp - first)
                if at_glyph + 2 > len(data):
                    break  # places only grow from here
                (glyph,) = read("H", data, at_glyph)
                if glyph == 0:
                    continue
            if (glyph + delta) & 0xFFFF:
                found.add(cp)
    return found


def format_12_13(data: bytes, at: int, constant: bool) -> set[int]:
    size, _, n = read("III", data, at + 4)
    found: set[int] = set()
    end = min(len(data), at + size)
    for place in range(at + 16, min(at + 16 + 12 * n, end - 11), 12):  # groups beyond the table's end aren't there
        first, last, glyph = read("III", data, place)
        if first > last or first > 0x10FFFF:
            continue
        last = min(last, 0x10FFFF)
        if glyph:
            found.update(range(first, last + 1))
        elif not constant:
            found.update(range(first + 1, last + 1))
    return found


def character_map(data: bytes, face: int) -> set[int]:
    """The union of the face's Unicode subtables."""
    where = tables(data, face).get(b"cmap")
    if where is None:
        raise FontError("no cmap")
    (n,) = read("H", data, where[0] + 2)
    found, any_map = set(), False
    for i in range(n):
        platform, encoding, offset = read("HHI", data, where[0] + 4 + 8 * i)
        if platform == 0 or platform == 3 and encoding in (1, 10):
            at = where[0] + offset
            (kind,) = read("H", data, at)
            if kind == 4:
                found |= format_4(data, at)
            elif kind in (12, 13):
                found |= format_12_13(data, at, kind == 13)
            else:
                continue
            any_map = True
    if not any_map:
        raise FontError("no Unicode cmap")
    return found


def full_name(data: bytes, face: int) -> str:
    """The face's full name (or family name): Windows English first, then Unicode, Windows, any other."""
    where = tables(data, face).get(b"name")
    if where is None:
        return ""
    _, n, strings = read("HHH", data, where[0])
    best = (9, 9, "")
    for i in range(n):
        platform, encoding, language, name_id, size, offset = read("6H", data, where[0] + 6 + 12 * i)
        if name_id not in (1, 4):
            continue
        raw = data[where[0] + strings + offset :][:size]
        rank = 0 if platform == 3 and language == 0x409 else 1 if platform == 0 else 2 if platform == 3 else 3
        best = min(best, (rank, 0 if name_id == 4 else 1, raw.decode("utf-16-be" if platform in (0, 3) else "latin-1", "replace")))
    return best[2]


def face_list(path: str, data: bytes) -> list[tuple[int | None, str | None]]:
    """(face, None) for each face that the path asks for, or (None, error) if the file has none to give."""
    _, _, only = path.partition("::")
    try:
        n = len(faces(data))
        if only and int(only) not in range(n):
            raise FontError(f"no face {only}")
    except ValueError as e:
        return [(None, str(e))]
    return [(int(only), None)] if only else [(i, None) for i in range(n)]


def scan_fonts(binaries: DataFrame) -> DataFrame:
    """path, face, name, cp for each mapped code point of each face of files (path, content); a face that
    can't be read has one row with its error instead. A path may name one face as path::face.

    Faces are listed first and then dealt out, so that a collection's faces are read by as many tasks.
    """

    def listed(batches):
        for pdf in batches:
            rows = [(p, i, e, bytes(c)) for p, c in zip(pdf["path"], pdf["content"], strict=True) for i, e in face_list(p, bytes(c))]
            yield pd.DataFrame({"path": [r[0] for r in rows], "face": pd.array([r[1] for r in rows], dtype="Int32"), "error": [r[2] for r in rows], "content": [r[3] for r in rows]})

    def mapped(batches):
        for pdf in batches:
            for path, i, error, content in zip(pdf["path"], pdf["face"], pdf["error"], pdf["content"], strict=True):
                if error is None or pd.isna(error):
                    try:
                        data = bytes(content)
                        at = faces(data)[int(i)]
                        cps = sorted(character_map(data, at))
                        yield pd.DataFrame({"path": path, "face": pd.array([i] * len(cps), dtype="Int32"), "name": full_name(data, at), "cp": pd.array(cps, dtype="Int32"), "error": None})
                        continue
                    except ValueError as e:
                        error = str(e)
                yield pd.DataFrame({"path": [path], "face": pd.array([i], dtype="Int32"), "name": [None], "cp": pd.array([None], dtype="Int32"), "error": [error]})

    each = binaries.select("path", "content").mapInPandas(listed, "path string, face int, error string, content binary")
    return each.repartition("path", "face").mapInPandas(mapped, COLUMNS)


def font_table(binaries: DataFrame) -> DataFrame:
    """path, face, name, cp of the faces that can be read."""
    return scan_fonts(binaries).filter("error is null").drop("error")


def font_errors(binaries: DataFrame) -> DataFrame:
    """path, face, error of the files and faces that can't be read."""
    return scan_fonts(binaries).filter("error is not null").select("path", "face", "error")
