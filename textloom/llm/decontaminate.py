"""Benchmark decontamination by CGK embeddings and bit sampling.

Item-sized windows start at every word (in scripts written without spaces at every character) where as
many of the item's character grams stand near their places as its edits must leave unchanged, so that
no passage within the tolerance is passed over. A window and the item are embedded by the same random walks (a character is written and, by a random
bit of step and character, passed or written again), which turns few edits into few unequal
positions; windows that agree with the item in the sampled positions of any of the repeats are
candidates. Candidates are confirmed by their exact edit distance, computed bit-parallel.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import portions
from .common import cut, small_batches, table, tidy
from .shingles import IS_SPACE, U

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
MATCHES = "array<struct<item_id:bigint,start:int,end:int,distance:int>>"


#: Blocks of scripts whose words aren't parted by spaces: from Thai to Tibetan, Burmese, Khmer, East Asian.
UNSPACED = np.array([[0x0E00, 0x0FFF], [0x1000, 0x109F], [0x1780, 0x17FF], [0x1950, 0x19DF], [0x1A20, 0x1AAF], [0x2E80, 0xA4CF], [0xAA60, 0xAADF], [0xF900, 0xFAFF], [0xFE30, 0xFE4F], [0xFF00, 0xFFEF], [0x16F00, 0x18DFF], [0x1AFF0, 0x1B2FF], [0x1F200, 0x1F2FF], [0x20000, 0x3FFFF]], dtype=np.uint32)


def unspaced(raw: np.ndarray) -> np.ndarray:
    """Which code points are of a script written without spaces."""
    out = np.zeros(len(raw), dtype=bool)
    high = np.flatnonzero(raw >= UNSPACED[0, 0])
    if len(high):
        block = np.searchsorted(UNSPACED[:, 0], raw[high], side="right") - 1
        out[high] = raw[high] <= UNSPACED[block, 1]
    return out


def normal(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all texts' characters in one row, A-Z lower-cased and one space around each word; the
    places where windows may start and one past the last; the texts' first such places and one past
    the last; for each character its place in the row of the texts as they are.

    Windows start at words, and at and after each character of scripts without spaces.
    """
    raw = np.frombuffer(" ".join(["", *texts, ""]).encode("utf-32-le"), dtype=np.uint32)
    starts = np.cumsum([1, *(len(t) + 1 for t in texts)])
    space = (raw < 256) & IS_SPACE[raw & 255]
    opens = space[:-1] & ~space[1:]
    dense = unspaced(raw)
    if dense.any():
        opens |= (dense[:-1] | dense[1:]) & ~space[1:]
    first = np.flatnonzero(opens) + 1
    bounds = np.searchsorted(first, starts)
    kept = np.ones(len(raw), dtype=bool)
    kept[1:] = ~(space[1:] & space[:-1])
    chars = np.where(space, np.uint32(32), raw + ((raw >= 65) & (raw <= 90)) * np.uint32(32))[kept]
    chars = (chars % 255 + 1).astype(np.uint8)
    begins = np.cumsum(kept)[first] - 1
    return chars, np.append(begins, len(chars)), bounds, np.flatnonzero(kept)


def grams(chars: np.ndarray, q: int) -> np.ndarray:
    """The q <= 8 codes from each place on as one number; none of fewer codes."""
    out, width = chars[: len(chars) if len(chars) >= q else 0].astype(U), 1
    while width < q:
        step = min(width, q - width)
        out = out[:-step] | out[step:] << U(8 * step)
        width += step
    return out


def unchanged(n: int, most: int) -> tuple[int, int]:
    """The longest grams of which some of a text's n - q + 1 outlast so many edits, and how many do.

    An edit changes the q grams over its place and no others.
    """
    return next(((q, n - q + 1 - most * q) for q in range(8, 1, -1) if n - q + 1 > most * q), (1, max(1, n - most)))


def bit_masks(text: str) -> dict[str, int]:
    """For each character the bits of its places in a pattern."""
    out: dict[str, int] = {}
    for i, c in enumerate(text):
        out[c] = out.get(c, 0) | 1 << i
    return out


def edit_distance(pattern_bits: dict, n: int, text: str, most: int, whole: bool = False) -> tuple[int, int]:
    """The least edit distance of a pattern of n characters to a prefix of text, and its length.

    Myers's bit vectors, one bit for each character of the pattern (its first n, if the masks have more).
    whole: only prefixes that end before a space or with the text.
    """
    full = (1 << n) - 1
    top = 1 << (n - 1)
    up, down, score = full, 0, n
    best = (n, 0)
    for j, c in enumerate(text, 1):
        eq = pattern_bits.get(c, 0) & full
        x = eq | down
        d = (((eq & up) + up) ^ up) | eq
        right, left = down | (full & ~(d | up)), up & d
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        right, left = (right << 1 | 1) & full, (left << 1) & full
        up, down = left | (full & ~(x | right)), right & x
        if score < best[0] and not (whole and j < len(text) and text[j] != " "):
            best = (score, j)
        elif score - (len(text) - j) > min(most, best[0]):
            break
    return best


class Items:
    """A block of benchmark items, indexed by character grams, with their embeddings."""

    def __init__(self, items: list[tuple[list[int], str]], tolerance: float, repeats: int, bits: int, seed: int = 11):
        self.repeats = repeats
        rng = np.random.default_rng(seed)
        rows = []
        for item_ids, text in items:
            words = WORD.findall((text or "").translate(FOLD))
            if words:
                rows.append((item_ids, " ".join(words)))
        self.ids = [r[0] for r in rows]
        self.texts = [r[1] for r in rows]
        # a single word must stand as a word, not at the head of a longer one
        self.whole = [" " not in t and not unspaced(np.array([ord(t[-1])], dtype=np.uint32))[0] for t in self.texts]
        self.most = [int(tolerance * len(t)) for t in self.texts]
        self.masks = [bit_masks(t) for t in self.texts]
        self.sizes = np.array([len(t) for t in self.texts], dtype=np.int64)
        longest = int(self.sizes.max(initial=0))
        self.walk = rng.integers(0, 2, size=(longest + 1, repeats, 256), dtype=np.int64)
        self.walk[:, :, 0] = 0
        self.walk = self.walk.reshape(len(self.walk), -1)
        spots = [rng.integers(0, len(t), size=(repeats, bits)) for t in self.texts]
        marks = [self.embedded(np.repeat(codes(t)[None, :], repeats, axis=0).ravel(), np.arange(repeats) * len(t), np.full(repeats, len(t)), np.arange(repeats), len(t)) for t in self.texts]
        self.spots = np.array(spots, dtype=np.int64).reshape(-1, repeats, bits)
        self.marks = np.array([np.take_along_axis(m, s, axis=1) for m, s in zip(marks, spots, strict=True)], dtype=np.uint8).reshape(-1, repeats, bits)
        # a gram's place in its item is kept to a block of as many characters as there may be edits
        self.edits = np.array(self.most, dtype=np.int64)
        self.block = np.maximum(1, self.edits)
        outlast = [unchanged(len(t), k) for t, k in zip(self.texts, self.most, strict=True)]
        self.least = np.array([least for _, least in outlast], dtype=np.int64)
        self.gap = longest + 3 * int(self.block.max(initial=0)) + 2
        self.index = []
        for q in sorted({q for q, _ in outlast}):
            keys, owners, places = [], [], []
            for i in (i for i, o in enumerate(outlast) if o[0] == q):
                g = grams(codes(self.texts[i]), q)
                at = np.arange(len(g)) // self.block[i] * self.block[i]
                order = np.lexsort((at, g))
                g, at = g[order], at[order]
                new = np.append(True, (g[1:] != g[:-1]) | (at[1:] != at[:-1]))
                keys.append(g[new])
                places.append(at[new])
                owners.append(np.full(int(new.sum()), i))
            keys, owners, places = np.concatenate(keys), np.concatenate(owners), np.concatenate(places)
            order = np.argsort(keys, kind="stable")
            known, first = np.unique(keys[order], return_index=True)
            shift = U(64 - min(26, max(20, 4 + len(known).bit_length())))
            seen = np.zeros(1 << (64 - int(shift)), dtype=bool)
            seen[spread(known, shift)] = True
            self.index.append((q, known, np.append(first, len(keys)), owners[order], places[order], shift, seen))

    def embedded(self, chars: np.ndarray, start: np.ndarray, size: np.ndarray, repeat: np.ndarray, steps: int) -> np.ndarray:
        """Walks for rows chars[start : start + size], each under its repeat's bits; 0 past the end.

        As many steps as characters: they pass about half of a row, in which the edits are no more.
        """
        out = np.zeros((steps, len(start)), dtype=np.uint8)
        at, end, own = start.astype(np.int64), start + size, repeat * 256
        for t in range(steps):
            c = chars.take(at, mode="clip") * (at < end)  # the walks never leave a 0
            out[t] = c
            at += self.walk[t].take(own + c)
        return out.T

    def candidates(self, chars: np.ndarray, begins: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Item and place of the windows in which enough of the item's grams stand near their places.

        An unchanged gram is moved by no more than the edits, so its place less its place in the item
        is within them of the window's start. Texts are held apart, so that no count spans two.
        """
        home = begins[bounds]
        places = begins[:-1] + np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) * self.gap + self.gap
        row = len(chars) + (len(bounds) + 1) * self.gap + self.gap
        items, words = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for q, known, first, owners, offsets, shift, seen in self.index:
            found = [np.zeros(0, dtype=np.int64)]
            for a in range(0, len(chars), 1 << 18):
                g = grams(chars[a : a + (1 << 18) + q - 1], q)
                hit = np.flatnonzero(seen[spread(g, shift)])
                which = np.minimum(np.searchsorted(known, g[hit]), len(known) - 1)
                true = known[which] == g[hit]
                hit, which = hit[true] + a, which[true]
                n = first[which + 1] - first[which]
                entry = np.repeat(first[which] - np.cumsum(n) + n, n) + np.arange(n.sum())
                place = hit + (np.searchsorted(home, hit, side="right") - 1) * self.gap + self.gap
                found.append(owners[entry] * row + np.repeat(place, n) - offsets[entry])
            found = np.sort(np.concatenate(found))
            owner = found // row
            last = np.arange(len(found)) + self.least[owner] - 1
            inside = np.minimum(last, len(found) - 1)
            k, b = self.edits[owner], self.block[owner]
            ok = np.flatnonzero((last < len(found)) & (found[inside] - found <= 2 * k + b - 1))
            owner, k, b = owner[ok], k[ok], b[ok]
            low = np.searchsorted(places, found[inside[ok]] - owner * row - k - b + 1)
            high = np.searchsorted(places, found[ok] - owner * row + k, side="right")
            same = owner[1:] == owner[:-1]
            low[1:] = np.where(same, np.maximum(low[1:], high[:-1]), low[1:])
            n = np.maximum(0, high - low)
            items.append(np.repeat(owner, n))
            words.append(np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum()))
        return np.concatenate(items), np.concatenate(words)

    def agreements(self, chars: np.ndarray, item: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """In how many repeats each window agrees with its item."""
        out = np.zeros(len(item), dtype=np.int64)
        size = np.minimum(self.sizes[item], end - start)
        most = max(1, min(2000, (1 << 25) // (self.repeats * int(self.sizes[item].max(initial=1)))))
        for a in range(0, len(item), most):
            i, n = item[a : a + most], len(item[a : a + most])
            every = np.repeat(np.arange(self.repeats), n)
            walked = self.embedded(chars, np.tile(start[a : a + most], self.repeats), np.tile(size[a : a + most], self.repeats), every, int(self.sizes[i].max()))
            rows = np.arange(self.repeats)[None, :] * n + np.arange(n)[:, None]
            out[a : a + most] = (walked[rows[:, :, None], self.spots[i]] == self.marks[i]).all(axis=2).sum(axis=1)
        return out

    def matches(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        chars, begins, bounds, places = normal(texts)
        out: list[list] = [[] for _ in texts]
        item, at = self.candidates(chars, begins, bounds)
        if not len(item):
            return out
        doc = np.searchsorted(bounds, at, side="right") - 1
        agrees = self.agreements(chars, item, begins[at], begins[bounds[doc + 1]] - 1)
        some = np.flatnonzero(agrees)
        some = some[np.lexsort((at[some], item[some], doc[some]))]
        offsets = np.cumsum([1, *(len(t) + 1 for t in texts)])
        now = -1
        for part in np.split(some, np.flatnonzero((np.diff(doc[some]) != 0) | (np.diff(item[some]) != 0)) + 1):
            if not len(part):
                continue
            d = int(doc[part[0]])
            if d != now:
                now, home = d, begins[bounds[d]]
                plain = " ".join(WORD.findall(texts[d].translate(FOLD)))
            for ids, s, e, distance in self.confirm(int(item[part[0]]), begins[at[part]] - home, agrees[part], plain):
                span = int(places[home + s] - offsets[d]), int(places[home + e - 1] - offsets[d]) + 1
                out[d] += [(i, *span, distance) for i in ids]
        return [sorted(set(m)) for m in out]

    def confirm(self, i, starts, agrees, text):
        """The best of overlapping windows, by distance and then place: item ids, start, end, distance."""
        n, most, whole = len(self.texts[i]), self.most[i], self.whole[i]
        taken: list[tuple[int, int]] = []
        hits = []
        for w in sorted(range(len(starts)), key=lambda w: (-agrees[w], starts[w])):
            s = int(starts[w])
            if any(a <= s < b for a, b in taken):
                continue
            part = n // 4
            if part > most and edit_distance(self.masks[i], part, text[s : s + part + most], most)[0] > most:
                continue  # a prefix of the item is no nearer than the whole
            distance, length = edit_distance(self.masks[i], n, text[s : s + n + most + whole], most, whole)
            if distance <= most and length:
                hits.append((distance, s, s + length))
                if distance == 0:
                    taken.append((s - n + 1, s + n))
        kept: list[tuple[int, int]] = []
        for distance, s, e in sorted(hits):
            if not any(s < b and a < e for a, b in kept):
                kept.append((s, e))
                yield self.ids[i], s, e, distance


def codes(text: str) -> np.ndarray:
    """Characters folded to 1 to 255."""
    return (np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32) % 255 + 1).astype(np.uint8)


def spread(keys: np.ndarray, shift: np.uint64) -> np.ndarray:
    """Places of grams in a table of 2 ** (64 - shift)."""
    return (keys * U(0x9E3779B97F4A7C15) >> shift).astype(np.int64)


def repeats_for(recall: float, bits: int, unequal: float) -> int:
    """Repeats that find a pair with that share of unequal positions with that chance."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - (1 - unequal) ** bits)))


def find_contamination(docs: DataFrame, benchmark: DataFrame, tolerance: float = 0.1, recall: float = 0.99, bits: int = 2, unequal: float = 0.5, block_bytes: int = 16 << 20) -> DataFrame:
    """docs with a column matches: for each row the benchmark passages in its whole text.

    An item matches where a word of the text starts a passage within an edit distance of tolerance
    times the item's length (both with A-Z lower-cased and white space runs as one space). In scripts
    written without spaces a passage may start at any character; an item of a single word in other
    scripts must end where a word ends. `repeats_for` gives the number of walks from recall, the bits
    sampled in each and the share of unequal positions up to which that recall shall hold. Of
    overlapping passages of one item the nearest is given: item_id, start and end in code points of
    the text, distance.

    Null, empty and blank texts match nothing, as do such items. Repeated rows and items are each
    reported, items of equal texts after one comparison. Other columns stay; a column called matches
    is replaced; an empty table on either side gives no matches. Items are shipped in blocks of at
    most block_bytes (one longer item alone), each matched in a pass of its own.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("matches")
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("item_id is not null and text is not null")
    items = cut(items.groupBy("text").agg(F.sort_array(F.collect_list("item_id")).alias("ids")))
    total = items.agg(F.sum(F.octet_length("text") + 8 * F.size("ids"))).first()[0] or 0
    n_blocks = max(1, -(-int(total) // block_bytes))
    repeats = repeats_for(recall, bits, unequal)
    column = docs.columns.index("text")
    out = docs.withColumn("matches", F.array().cast(MATCHES))
    schema = T.StructType([*docs.schema.fields, T.StructField("matches", out.schema["matches"].dataType)])
    for b in range(n_blocks):
        block = items.filter(F.pmod(F.xxhash64("text"), F.lit(n_blocks)) == b).orderBy(F.col("ids")[0], "text").collect()
        sent = spark.sparkContext.broadcast([(list(r["ids"]), r["text"]) for r in block])

        @tidy
        def run(batches, sent=sent):
            found = Items(sent.value, tolerance, repeats, bits)
            for batch in batches:
                texts = [t or "" for t in batch.column(column).to_pylist()]
                before = batch.column(len(batch.columns) - 1).to_pylist()
                for start, stop in portions(texts):
                    got = found.matches(texts[start:stop])
                    rows = [old + [dict(zip(("item_id", "start", "end", "distance"), m, strict=True)) for m in new] for old, new in zip(before[start:stop], got, strict=True)]
                    kind = batch.schema.field("matches").type
                    yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(start, stop - start) for i in range(len(batch.columns) - 1)), pa.array(rows, type=kind)], names=batch.schema.names)

        out = out.mapInArrow(run, schema)
    return out


def op2_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.item_id", "m.start", "m.end", "m.distance")
