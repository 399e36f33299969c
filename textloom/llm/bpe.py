"""Byte-level BPE with a segment tree over byte positions.

The leaves hold the rank of the pair that starts at a live position (joined with the position, so
that the least leaf is the leftmost of the best rank); the root names the next merge. A merge
changes the leaves of the merged position, its left neighbour and the swallowed position, each a
walk of logarithmic length to the root. Short pieces are merged many at a time with one row of a
matrix as each piece's tree; long ones have a tree of their own.
"""

from __future__ import annotations

import base64
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, table, text_or_empty, tidy

NONE = np.int64(1) << 40


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a .tiktoken file by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * (1 + max(int(r) for _, r in pairs))
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class CharClasses:
    """Tells whether a character is a letter, a number, white space or none of them to tiktoken, whose
    Unicode tables are of another version than those of the regex package.

    A probing vocabulary joins "a", "1" or "!" with the first byte of what follows in the same piece.
    """

    KINDS = {"a": "\u00e9", "1": "\u0663", "!": "\u2603", "": "\u2003"}  # a character of each kind in all tables

    def __init__(self):
        import regex

        self.known: dict[str, str | None] = {}
        self.library = None
        self.patterns = {"a": regex.compile(r"\p{L}"), "1": regex.compile(r"\p{N}"), "!": regex.compile(r"[^\s\p{L}\p{N}]"), "": regex.compile(r"\s")}

    def kind(self, c: str) -> str:
        if self.library is None:
            import tiktoken

            joined = [a + bytes([b]) for a in (b"a", b"1", b"!") for b in range(0xC2, 0xF5)]
            ranks = {t: i for i, t in enumerate([bytes([b]) for b in range(256)] + joined)}
            self.library = tiktoken.Encoding("classes", pat_str=r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\s+", mergeable_ranks=ranks, special_tokens={})
        return next((a for a in ("a", "1", "!") if len(self.library.encode_ordinary(a + c)) == len(c.encode())), "")

    def stand_ins(self, text: str) -> dict[int, str]:
        """Characters of the text that the two tables put in different classes, each with one of the library's class."""
        new = set(text).difference(self.known)
        for c in new:
            kind = self.kind(c) if c > "\u02ff" else None
            self.known[c] = None if kind is None or self.patterns[kind].match(c) else self.KINDS[kind]
        return {ord(c): s for c in set(text) if (s := self.known[c])}


class Encoder:
    """Encodes pieces of text.

    Keeps the ids of up to max_known pieces; when there are more they become the old ones, from which
    pieces that come up again are taken, and the old ones before them are forgotten.
    """

    def __init__(self, tokens: list[bytes], pattern: str, max_known: int = 160_000):
        import regex

        self.tokens, self.max_known = tokens, max_known
        pattern = regex.compile(pattern)
        self.pieces, self.places = pattern.findall, pattern.finditer
        self.plain = regex.compile("[^\\x00-\\u02ff]").search
        self.classes = CharClasses()
        self.rank = {t: i for i, t in enumerate(tokens) if t}
        keys, ranks = [], []
        for t, r in self.rank.items():
            for i in range(1, len(t)):
                a, b = self.rank.get(t[:i]), self.rank.get(t[i:])
                if a is not None and b is not None:
                    keys.append(a << 24 | b)
                    ranks.append(r)
        order = np.argsort(keys)
        self.pair_keys = np.array(keys, dtype=np.int64)[order]
        self.pair_ranks = np.array(ranks, dtype=np.int64)[order]
        self.pair = dict(zip(self.pair_keys.tolist(), self.pair_ranks.tolist(), strict=True))
        self.of_byte = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int64)
        self.known: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def split(self, text: str) -> list[str]:
        """The matches of the pattern, with the library's notion of letters, numbers and white space."""
        if self.plain(text) is None:
            return self.pieces(text)
        odd = self.classes.stand_ins(text)
        return [text[m.start() : m.end()] for m in self.places(text.translate(odd))] if odd else self.pieces(text)

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 24 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (a >= 0) & (b >= 0), self.pair_ranks[at], NONE)

    def merge_many(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Pieces of at most width bytes (a power of two), each row a tree with the leaves from width on."""
        n, levels = len(pieces), width.bit_length() - 1
        size = np.array([len(p) for p in pieces])
        ids = np.full((n, width + 1), -1, dtype=np.int64)
        live = np.arange(width)[None, :] < size[:, None]
        ids[:, :width][live] = self.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        after = np.broadcast_to(np.minimum(np.arange(1, width + 2), width), (n, width + 1)).copy()
        after[np.arange(n), size - 1] = width
        before = np.broadcast_to(np.arange(-1, width), (n, width + 1)).copy()
        tree = np.full((n, 2 * width), NONE * width, dtype=np.int64)
        first = self.pair_rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width)
        tree[:, width:] = np.where(first < NONE, first * width + np.arange(width), NONE * width)
        for level in range(levels - 1, -1, -1):
            lo = 1 << level
            tree[:, lo : 2 * lo] = np.minimum(tree[:, 2 * lo : 4 * lo : 2], tree[:, 2 * lo + 1 : 4 * lo : 2])

        def put(rows, at, value):
            node = at + width
            tree[rows, node] = value
            for _ in range(levels):
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        while len(rows := np.flatnonzero(tree[:, 1] < NONE * width)):
            best = tree[rows, 1]
            at, rank = best % width, best // width
            gone = after[rows, at]
            then = after[rows, gone]
            ids[rows, at], ids[rows, gone] = rank, -1
            after[rows, at] = then
            before[rows, then] = at
            put(rows, gone, NONE * width)
            for left, right, ok in ((at, then, then < width), (p := before[rows, at], at, p >= 0)):
                r, le, ri = rows[ok], left[ok], right[ok]
                new = self.pair_rank(ids[r, le], ids[r, ri])
                put(r, le, np.where(new < NONE, new * width + le, NONE * width))
            ends = then >= width
            put(rows[ends], at[ends], NONE * width)
        flat, counts = ids[ids >= 0].tolist(), (ids >= 0).sum(axis=1).tolist()
        out, i = [], 0
        for c in counts:
            out.append(tuple(flat[i : i + c]))
            i += c
        return out

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """One piece of any length, in n log n steps."""
        n = len(piece)
        width = 1 << max(1, (n - 1).bit_length())
        none = (1 << 40) * width
        ids = self.of_byte[np.frombuffer(piece, dtype=np.uint8)].tolist()
        after, before, pair = list(range(1, n + 1)), list(range(-1, n - 1)), self.pair
        tree = [none] * (2 * width)
        for i in range(n - 1):
            r = pair.get(ids[i] << 24 | ids[i + 1])
            if r is not None:
                tree[width + i] = r * width + i
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(i, value):
            i += width
            tree[i] = value
            while i > 1:
                i >>= 1
                a, b = tree[2 * i], tree[2 * i + 1]
                v = a if a < b else b
                if tree[i] == v:
                    break
                tree[i] = v

        while tree[1] < none:
            rank, at = divmod(tree[1], width)
            gone = after[at]
            then = after[gone]
            ids[at], ids[gone] = rank, -1
            after[at] = then
            if then < n:
                before[then] = at
            put(gone, none)
            r = pair.get(rank << 24 | ids[then]) if then < n else None
            put(at, none if r is None else r * width + at)
            left = before[at]
            if left >= 0:
                r = pair.get(ids[left] << 24 | rank)
                put(left, none if r is None else r * width + left)
        return tuple(i for i in ids if i >= 0)

    def learn(self, pieces: set[str], group: int = 20_000) -> None:
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            b = p.encode()
            whole = self.rank.get(b)
            if whole is not None:
                self.known[p] = (whole,)
            elif len(b) > 64:
                self.known[p] = self.merge_long(b)
            else:
                by_width.setdefault(max(2, 1 << (len(b) - 1).bit_length()), []).append((p, b))
        for width, found in by_width.items():
            step = max(1, group * 8 // width)
            for i in range(0, len(found), step):
                part = found[i : i + step]
                self.known.update(zip((p for p, _ in part), self.merge_many([b for _, b in part], width), strict=True))

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        split = [self.split(t) for t in texts]
        wanted = set().union(*map(set, split)) if split else set()
        new = wanted - self.known.keys()
        if len(self.known) + len(new) > self.max_known and self.known:
            self.old, self.known = self.known, {}
            new = wanted
        again = new & self.old.keys()
        self.known.update((p, self.old[p]) for p in again)
        self.learn(new - again)
        get = self.known.__getitem__
        return [list(chain.from_iterable(map(get, pieces))) for pieces in split]


_encoders: dict = {}


def _encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(read_ranks(path), pattern)
    return _encoders[path, pattern]


def portions(texts: list[str], most: int = 1 << 19):
    """Slices of a list whose texts have about `most` characters together, longer texts alone."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids array<int>: the whole text's tokens, each match of pattern by itself.

    path names a .tiktoken rank file that every executor can open. A null text is empty and has no
    ids; doc_id may be null or repeated (each row is encoded); other columns are dropped; an empty
    table gives an empty one. A piece that is a token itself is taken whole; no special tokens.
    """

    @tidy
    def run(batches):
        coder = _encoder(path, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, stop in portions(texts):
                lists = coder.encode_batch(texts[start:stop])
                ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                flat = np.fromiter(chain.from_iterable(lists), dtype=np.int32, count=ends[-1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["doc_id", "ids"])
        coder.old = {}  # an idle worker shall hold little

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """Adds decoded (binary): the bytes of the ids, put together. Null ids decode to nothing."""

    @tidy
    def run(batches):
        tokens = pa.array(_tokens(path), type=pa.binary())
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            ids = ids.fill_null([]) if ids.null_count else ids
            taken = tokens.take(ids.flatten())
            at = np.frombuffer(taken.buffers()[1], dtype=np.int32)[taken.offset :]
            starts = ids.offsets.to_numpy() - ids.offsets[0].as_py()
            whole = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.array(at[starts].astype(np.int32)).buffers()[1], taken.buffers()[2]])
            yield pa.RecordBatch.from_arrays([*batch.columns, whole], names=[*batch.schema.names, "decoded"])

    schema = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes) + ", decoded binary"
    return encoded.mapInArrow(run, schema)


_token_lists: dict = {}


def _tokens(path: str) -> list[bytes]:
    if path not in _token_lists:
        _token_lists[path] = read_ranks(path)
    return _token_lists[path]


def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op8_byte_bpe(spark, sf_dir):
    path, pattern = vocabulary()
    got = decode_ids(encode_documents(table(spark, sf_dir, "documents"), path, pattern), path)
    return got.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
