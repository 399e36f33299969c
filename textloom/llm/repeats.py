"""Removal of repeated passages by sorted suffixes.

A byte goes if a string of `length` bytes that covers it also starts earlier. Only few suffixes need
sorting: of the grams inside a window of that length the one with the least hash is its anchor, so
equal windows have equal anchors at equal places, and a window can repeat only if its anchor's gram
does. Suffixes at repeated anchors (with what stands before them in the windows) are sorted into
runs, front-coded (each entry without the prefix it shares with the one before), dealt out by
splitters, and merged with loser trees that carry common prefix lengths and never compare those
bytes again. In merged order entries that share a gram are neighbours; windows are compared there.

Equal texts are one text; the runs keep one of equal entries; so copies, however many, cost what
their distinct contents cost. A gram that takes more than its share of a sample of entries doesn't go
to one merge: the digests of its windows are dealt out, after each run has kept the earliest of equal
ones. What a task has found goes to the texts' own tasks in one row for each, not in one for each text.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Callable
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, heavy_keys, join_heavy, shared_table, shuffle_parts, small_batches, table, text_or_empty, tidy, written
from .shingles import U, mix, powers

GRAM = 32
CHUNK = 1 << 19
POSITION = U((1 << 22) - 1)
PREFIX = 24  # bytes of a key that splitters and hot grams are told by; less than a gram


def anchors(segments: list[bytes], length: int):
    """For all segments together: segment, place, first and last window start, and hash of each anchor."""
    span = length - GRAM + 1  # grams in a window
    sizes = np.array([len(s) for s in segments], dtype=np.int64)
    starts = np.cumsum([0, *sizes])
    raw = np.frombuffer(b"".join(segments), dtype=np.uint8)
    n = len(raw) - length + 1
    none = tuple(np.zeros(0, dtype=np.int64) for _ in range(4)) + (np.zeros(0, dtype=U),)
    if n <= 0:
        return none
    power, inverse = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=U)
    np.cumsum((raw.astype(U) + U(1)) * power[: len(raw)], out=sums[1:])
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * inverse[: len(raw) - GRAM + 1])
    least = (grams & ~POSITION) | np.arange(len(grams), dtype=U)
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    spot = (least[:n] & POSITION).astype(np.int64)
    home = np.repeat(np.arange(len(segments)), sizes)[:n]
    ok = np.arange(n) + length <= starts[home + 1]
    at = np.flatnonzero(ok)
    if not len(at):
        return none
    spot, home = spot[at], home[at]
    first = np.flatnonzero(np.concatenate(([True], (spot[1:] != spot[:-1]) | (home[1:] != home[:-1]))))
    last = np.append(first[1:], len(at)) - 1
    base = starts[home[first]]
    return home[first], spot[first] - base, at[first] - base, at[last] - base, grams[spot[first]]


def segmented(texts: list[bytes], length: int):
    """Texts in segments of bounded size that overlap so that each window is in one: text, offset, bytes."""
    for i, t in enumerate(texts):
        for o in range(0, max(1, len(t) - length + 1), CHUNK):
            yield i, o, t[o : o + CHUNK + length - 1]


def text_anchors(texts: list[bytes], length: int):
    """text, place, first, last, hash, ordinal in its text, over groups of segments of bounded size."""
    parts, group, held = [], [], 0
    for s in segmented(texts, length):
        if group and held + len(s[2]) > 2 * CHUNK:
            parts.append((group, anchors([g[2] for g in group], length)))
            group, held = [], 0
        group.append(s)
        held += len(s[2])
    if group:
        parts.append((group, anchors([g[2] for g in group], length)))
    home = np.concatenate([np.array([g[0] for g in group], dtype=np.int64)[a[0]] for group, a in parts])
    offset = np.concatenate([np.array([g[1] for g in group], dtype=np.int64)[a[0]] for group, a in parts])
    place, lo, hi = (np.concatenate([a[i] for _, a in parts]) + offset for i in (1, 2, 3))
    first = np.searchsorted(home, np.arange(len(texts)))
    return home, place, lo, hi, np.concatenate([a[4] for _, a in parts]), np.arange(len(home)) - first[home]


def byte_portions(texts: list[bytes], most: int = 1 << 19):
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def ints(*arrays) -> bytes:
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


PART_BYTES, MOST_PARTS = 32 << 20, 100_000
PACKED = "part int, entries binary"
HELD = 1 << 20  # entries that a task keeps before it deals them out


def packed(parts: int, rid: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """Entries (rid and other whole numbers) in one row for each part that texts' rids fall in."""
    to = rid % parts
    order = np.argsort(to, kind="stable")
    ends = np.searchsorted(to[order], np.arange(parts + 1))
    full = np.flatnonzero(ends[1:] > ends[:-1])
    rows = [ints(*(c[order[ends[p] : ends[p + 1]]].astype(np.int64) for c in (rid, *columns))) for p in full]
    return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(rows, pa.binary())], names=["part", "entries"])


def by_text(dealt: DataFrame, parts: int, name: str, width: int) -> DataFrame:
    """rid and, in a column of that name, the bytes of its int64 rows, from packed entries of width columns."""

    @tidy
    def gather(batches):
        found = [np.frombuffer(e, dtype=np.int64).reshape(width, -1) for batch in batches for e in batch.column(1).to_pylist()]
        if not found:
            return
        rows = np.concatenate(found, axis=1)
        del found
        rows = rows[:, np.lexsort(rows[::-1])]
        at = np.flatnonzero(np.concatenate(([True], rows[0, 1:] != rows[0, :-1])))
        ends = np.append(at[1:], rows.shape[1])
        body = np.ascontiguousarray(rows[1:].T)
        for a in range(0, len(at), 4096):
            blobs = [body[x:y].tobytes() for x, y in zip(at[a : a + 4096].tolist(), ends[a : a + 4096].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(rows[0, at[a : a + 4096]], pa.int64()), pa.array(blobs, pa.binary())], names=["rid", name])

    return dealt.repartition(parts, "part").mapInArrow(gather, f"rid long, {name} binary")


def repeated_anchors(texts: DataFrame, length: int, parts: int) -> DataFrame:
    """rid, ordinals (int64 bytes): the anchors whose gram another anchor also has."""

    @tidy
    def scan(batches):
        for batch in batches:
            rids, raws = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for start, stop in byte_portions(raws):
                home, _, _, _, hashes, ordinal = text_anchors(raws[start:stop], length)
                if not len(home):
                    continue
                rid = rids[start:stop][home]
                values, first, inverse, n = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
                often = n[inverse] > 1
                # what repeats here is known here; one of its kind tells the others
                yield pa.RecordBatch.from_arrays([pa.array([int(rid[0] % parts)], pa.int32()), pa.array([ints(rid[often], ordinal[often].astype(np.int32))]), pa.array([b""]), pa.array([True])], names=["part", "entries", "hashes", "known"])
                part = (values >> U(32)).astype(np.int64) % parts
                order = np.lexsort((first, part))
                ends = np.searchsorted(part[order], np.arange(parts + 1))
                rows = [(p, order[a:b]) for p, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if b > a]
                # a gram that repeats here is marked by the ordinal -1
                mark = np.where(n > 1, -1, ordinal[first]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in rows], pa.int32()), pa.array([ints(rid[first[o]], mark[o]) for _, o in rows]), pa.array([ints(values[o]) for _, o in rows]), pa.array([False] * len(rows))],
                    names=["part", "entries", "hashes", "known"],
                )

    @tidy
    def meet(batches):
        rids, marks, hashes = [], [], []
        given, held = [], 0
        for batch in batches:
            for entries, hashed, known in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                n = len(entries) // 12
                rid, mark = np.frombuffer(entries, dtype=np.int64, count=n), np.frombuffer(entries, dtype=np.int32, offset=8 * n)
                if known:
                    given.append((rid, mark))
                    held += n
                else:
                    rids.append(rid)
                    marks.append(mark)
                    hashes.append(np.frombuffer(hashed, dtype=U))
            if held > HELD:
                yield packed(parts, *(np.concatenate(x) for x in zip(*given, strict=True)))
                given, held = [], 0
        if hashes:
            _, inverse, n = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
            rid, mark = np.concatenate(rids), np.concatenate(marks)
            again = (n[inverse] > 1) & (mark >= 0)
            given.append((rid[again], mark[again]))
        if given:
            yield packed(parts, *(np.concatenate(x) for x in zip(*given, strict=True)))

    dealt = texts.select("rid", "raw").mapInArrow(scan, "part int, entries binary, hashes binary, known boolean").repartition(parts, "part")
    return by_text(dealt.mapInArrow(meet, PACKED), parts, "ordinals", 2)


class Run:
    """Sorted entries with their common prefix lengths; key: right bytes, then left bytes backwards."""

    __slots__ = ("keys", "lcps", "right", "left", "doc", "rid", "place")

    FIELDS = (("lcps", np.uint8), ("right", np.uint8), ("left", np.uint8), ("doc", np.int64), ("rid", np.int64), ("place", np.int64))

    def packed(self, a: int, b: int) -> bytes:
        """Entries a to b, front-coded."""
        lcps = self.lcps[a:b].copy()
        lcps[0] = 0
        tails = [k[c:] for k, c in zip(self.keys[a:b], lcps.tolist(), strict=True)]
        body = b"".join(tails)
        return ints(np.array([b - a], dtype=np.int64), lcps, *(getattr(self, f)[a:b].astype(t) for f, t in self.FIELDS[1:])) + body

    @classmethod
    def unpacked(cls, blob: bytes) -> Run:
        run = cls()
        n = int(np.frombuffer(blob, dtype=np.int64, count=1)[0])
        at = 8
        for f, t in cls.FIELDS:
            setattr(run, f, np.frombuffer(blob, dtype=t, count=n, offset=at))
            at += n * np.dtype(t).itemsize
        run.keys, before = [], b""
        for c, size in zip(run.lcps.tolist(), (run.right.astype(int) + run.left).tolist(), strict=True):
            before = before[:c] + blob[at : at + size - c]
            at += size - c
            run.keys.append(before)
        return run


def sorted_run(texts: list[bytes], picks, rids, docs, length: int, hot: frozenset = frozenset()):
    """The run of the picked anchors of texts, (rid, start, end) of entries equal to earlier ones, and
    the entries whose key begins with one of hot, which stay out of the run."""
    home, place, lo, hi, _, ordinal = text_anchors(texts, length)
    key = home << 32 | ordinal
    wanted = np.concatenate([np.full(len(p), i, dtype=np.int64) << 32 | p for i, p in enumerate(picks)])
    at = np.flatnonzero(np.isin(key, wanted))
    rows = []
    for h, p, a, b in zip(home[at].tolist(), place[at].tolist(), lo[at].tolist(), hi[at].tolist(), strict=True):
        t = texts[h]
        rows.append((t[p : b + length] + t[a:p][::-1], b + length - p, docs[h], rids[h], p))
    rows.sort()
    kept, gone, busy = [], [], []
    last = None
    for r in rows:
        if last and last[0] == r[0] and last[1] == r[1]:
            gone.append((r[3], r[4] - (len(r[0]) - r[1]), r[4] + r[1]))
        else:
            (busy if hot and r[0][:PREFIX] in hot else kept).append(r)
            last = r
    run = Run()
    run.keys = [r[0] for r in kept]
    run.right = np.array([r[1] for r in kept], dtype=np.uint8)
    run.left = np.array([len(r[0]) - r[1] for r in kept], dtype=np.uint8)
    run.doc, run.rid, run.place = (np.array([r[i] for r in kept], dtype=np.int64) for i in (2, 3, 4))
    run.lcps = np.array([0, *map(common, run.keys[:-1], run.keys[1:])][: len(kept)], dtype=np.uint8)
    return run, gone, busy


def earliest_windows(entries: list, length: int):
    """Digests of the windows of entries (key, right, doc, rid, place), each with its earliest
    (doc, rid, start), and (rid, start, end) of the other windows."""
    first: dict[bytes, tuple[int, int, int]] = {}
    gone = []
    for key, right, doc, rid, place in entries:
        piece = key[right:][::-1] + key[:right]
        start = place - (len(key) - right)
        for i in range(len(piece) - length + 1):
            digest = blake2b(piece[i : i + length], digest_size=16).digest()
            own = (doc, rid, start + i)
            known = first.setdefault(digest, own)
            if known is not own:
                first[digest], late = (own, known) if own < known else (known, own)
                gone.append((late[1], late[2], late[2] + length))
    return first, gone


def later_windows(blobs: list[bytes], length: int) -> np.ndarray:
    """(rid, start, end) of the windows that aren't the earliest of their digest."""
    rows = np.concatenate([np.frombuffer(b, dtype=np.int64).reshape(5, -1) for b in blobs], axis=1)
    rows = rows[:, np.lexsort(rows[::-1])]  # two halves of the digest, doc, rid, start
    late = np.flatnonzero((rows[:2, 1:] == rows[:2, :-1]).all(axis=0)) + 1
    return np.stack([rows[3, late], rows[4, late], rows[4, late] + length], axis=1)


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, of which start bytes are known."""
    n = min(len(a), len(b))
    step = 16
    while start < n:
        end = min(start + step, n)
        if a[start:end] == b[start:end]:
            start = end
            step = 64
        else:
            x, y = int.from_bytes(a[start:end], "big"), int.from_bytes(b[start:end], "big")
            return start + (end - start) - ((x ^ y).bit_length() + 7) // 8
    return n


def merged(runs: list[Run]):
    """(key, lcp with the entry before, run, index) of all runs in order, by a loser tree.

    Every loser is kept with its common prefix length to the winner that beat it. The next match at
    that node is with an entry that follows the same winner: the longer common prefix wins, and only
    equal ones compare bytes, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    end = None
    heads = [(r.keys[0] if r.keys else end) for r in runs] + [end] * (k - len(runs))
    index = [0] * k
    lcps = [r.lcps.tolist() for r in runs]
    losers: list = [None] * k  # (run, lcp)

    def play(a, ca, b, cb):
        """Winner and its lcp, loser and its lcp to the winner; ca and cb are to the same last output."""
        ka, kb = heads[a], heads[b]
        if kb is end:
            return a, ca, b, 0
        if ka is end:
            return b, cb, a, 0
        if ca > cb:
            return a, ca, b, cb
        if cb > ca:
            return b, cb, a, ca
        c = common(ka, kb, ca)
        if ka[c:] <= kb[c:]:
            return a, ca, b, c
        return b, cb, a, c

    def build(node):
        if node >= k:
            return node - k, 0
        a, ca = build(2 * node)
        b, cb = build(2 * node + 1)
        w, cw, lo, cl = play(a, ca, b, cb)
        losers[node] = (lo, cl)
        return w, cw

    if not runs:
        return
    winner, lcp = build(1)
    while heads[winner] is not end:
        i = index[winner]
        yield heads[winner], lcp, winner, i
        i += 1
        index[winner] = i
        keys = runs[winner].keys
        if i < len(keys):
            heads[winner], lcp = keys[i], lcps[winner][i]
        else:
            heads[winner], lcp = end, 0
        node = (winner + k) >> 1
        while node:
            other, co = losers[node]
            winner, lcp, lo, cl = play(winner, lcp, other, co)
            losers[node] = (lo, cl)
            node >>= 1


def repeats_of(group: list, length: int, out: list) -> None:
    """Adds (rid, start, end) for windows in a group of entries with one gram that also start earlier.

    group: (key, right, left, doc, rid, place). A window with d bytes before the anchor is
    (d, those bytes and the others after); among equal ones all but the earliest go.
    """
    group.sort(key=lambda g: (g[3], g[4], g[5]))
    if len(group) == 2:
        (ka, ra, la, *_), (kb, rb, lb, _, rid, place) = group
        right = min(common(ka[:ra], kb[:rb]), length)
        left = common(ka[ra:], kb[rb:])
        if left + right >= length:
            out.append((rid, place - left, place + right))
        return
    seen: set = set()
    for key, right, left, _, rid, place in group:
        before = key[right:]
        first = last = None
        for d in range(length - right, left + 1):
            w = (d, before[:d], key[: length - d])
            if w not in seen:
                seen.add(w)
            elif last is not None and d == last + 1:
                last = d
            else:
                if last is not None:
                    out.append((rid, place - last, place - first + length))
                first = last = d
        if last is not None:
            out.append((rid, place - last, place - first + length))


def joined_spans(spans) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """rid, start and end of spans (rid, start, end), those that meet in one text joined."""
    a = np.asarray(spans, dtype=np.int64).reshape(-1, 3)
    a = a[np.lexsort((a[:, 2], a[:, 1], a[:, 0]))]
    if not len(a):
        return a[:, 0], a[:, 1], a[:, 2]
    new_text = np.concatenate(([True], a[1:, 0] != a[:-1, 0]))
    far = int(a[:, 2].max()) + 1
    shift = (np.cumsum(new_text) - 1) * far
    reach = np.maximum.accumulate(a[:, 2] + shift)
    new = np.concatenate(([True], a[1:, 1] + shift[1:] > reach[:-1])) | new_text
    at = np.flatnonzero(new)
    ends = reach[np.append(at[1:], len(a)) - 1] - shift[at]
    return a[at, 0], a[at, 1], ends


def repeated_spans(texts: DataFrame, picked: DataFrame, length: int, parts: int, sample: int = 2000, entries: int = 50_000, shares: float = 2.0, least: int = 20) -> DataFrame:
    """rid, spans (int64 bytes: start, end) to be removed from texts (rid, doc, raw).

    The prefixes of grams that hold more than `shares` parts' worth of the sampled entries (and at
    least `least` of them) are hot. There are at most parts / shares of them.
    """
    n = picked.count()
    rows = attached(texts, picked, "inner").select("rid", "doc", "raw", "ordinals")

    def unpack(batch):
        picks = [np.unique(np.frombuffer(p, dtype=np.int64)) for p in batch.column(3).to_pylist()]
        return batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), picks

    @tidy
    def keys(batches):
        for batch in batches:
            rids, docs, raws, picks = unpack(batch)
            if len(rids):
                run, _, _ = sorted_run(raws, picks, rids, docs, length)
                yield pa.RecordBatch.from_arrays([pa.array([k[:PREFIX] for k in run.keys[:: max(1, len(run.keys) // 500)]], pa.binary())], names=["key"])

    few = rows.filter(F.pmod(F.xxhash64("rid"), F.lit(max(1, n // sample))) == 0)
    seen = sorted(bytes(r[0]) for r in few.mapInArrow(keys, "key binary").collect())
    splitters = sorted({seen[len(seen) * i // parts] for i in range(1, parts)}) if seen else []
    hot = frozenset(k for k, n in Counter(seen).items() if n >= least and n * parts > shares * len(seen))

    @tidy
    def runs(batches):
        held: list = []
        turn = 0

        def flush():
            rids, docs, raws, picks = (sum((h[i] for h in held), []) for i in range(4))
            held.clear()
            run, gone, busy = sorted_run(raws, picks, rids, docs, length, hot)
            cuts = [0, *(bisect_left(run.keys, s) for s in splitters), len(run.keys)]
            got = [(p, run.packed(a, b), None, None) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            if busy:
                first, more = earliest_windows(busy, length)
                gone += more
                digests = np.frombuffer(b"".join(first), dtype=np.int64).reshape(-1, 2)
                places = np.array(list(first.values()), dtype=np.int64)
                to = digests[:, 0] % parts
                got += [(int(p), None, ints(*digests[to == p].T, *places[to == p].T), None) for p in np.unique(to)]
            if gone:
                got.append((turn % parts, None, None, ints(*joined_spans(gone))))
            return pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int32()), *(pa.array([g[i] for g in got], pa.binary()) for i in (1, 2, 3))], names=["part", "run", "windows", "spans"])

        size = 0
        for batch in batches:
            whole = unpack(batch)
            for start, stop in byte_portions(whole[2]):
                turn += int(whole[0][start])
                held.append(tuple(x[start:stop] for x in whole))
                size += sum(map(len, whole[3][start:stop]))
                if size >= entries:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    @tidy
    def merge(batches):
        by_part: dict[int, list] = {}
        windows: list[bytes] = []
        spans, held = [], 0
        for batch in batches:
            for p, run, w, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if run is not None:
                    by_part.setdefault(p, []).append(run)
                elif w is not None:
                    windows.append(w)
                else:
                    spans.append(np.frombuffer(own, dtype=np.int64).reshape(3, -1).T)
                    held += len(spans[-1])
                    if held > HELD:
                        yield packed(parts, *joined_spans(np.concatenate(spans)))
                        spans, held = [], 0
        if windows:
            spans.append(later_windows(windows, length))
        del windows
        while by_part:
            _, blobs = by_part.popitem()
            out: list = []
            group: list = []
            runs_in = [Run.unpacked(b) for b in blobs]
            del blobs
            fields = [tuple(getattr(r, f).tolist() for f in ("right", "left", "doc", "rid", "place")) for r in runs_in]
            for key, lcp, r, i in merged(runs_in):
                if lcp < GRAM:
                    if len(group) > 1:
                        repeats_of(group, length, out)
                    group = []
                group.append((key, *(f[i] for f in fields[r])))
            if len(group) > 1:
                repeats_of(group, length, out)
            if out:
                spans.append(np.array(out, dtype=np.int64))
        if spans:
            yield packed(parts, *joined_spans(np.concatenate(spans)))

    dealt = rows.mapInArrow(runs, "part int, run binary, windows binary, spans binary").repartition(parts, "part")
    return by_text(dealt.mapInArrow(merge, PACKED), parts, "spans", 3)


def attached(texts: DataFrame, side: DataFrame, how: str) -> DataFrame:
    """texts joined with a row's data (rid, ...) at their buckets, so that texts aren't shuffled."""
    keyed = side.join(texts.select("rid", "k1", "k2"), "rid").drop("rid")
    return texts.join(keyed.hint("shuffle_hash"), ["k1", "k2"], how)


def bucketed(texts: DataFrame, parts: int) -> DataFrame:
    """texts with rid, from a table in the shared folder in buckets of (k1, k2)."""
    return shared_table(texts.withColumn("rid", F.monotonically_increasing_id()), parts, "k1", "k2")


def remove_repeats(docs: DataFrame, length: int = 100, kept_as: Callable[[Column], Column] = lambda kept: kept) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary: the remaining bytes) for every row.

    Each byte of a text's UTF-8 goes that is covered by a string of `length` bytes which also starts
    earlier: in a row of smaller doc_id or before it in its own text; strings are judged on the
    input and don't cross rows. Null and short texts keep all. Of rows with one doc_id a row of
    equal text comes later; different texts come in an undefined but fixed order; a null doc_id
    comes first. Other columns are dropped; an empty table gives an empty one. length is at least
    the gram size 32 and at most 255. There is a part for each PART_BYTES of text (up to MOST_PARTS), and
    one for each shuffle partition at least. kept_as makes what is given as kept of the remaining bytes, before
    rows are put together, so that a digest of them doesn't shuffle the bytes.
    """
    small_batches(docs.sparkSession)
    raw = text_or_empty().cast("binary")
    held = docs.agg(F.sum(F.octet_length(raw).cast("long"))).first()[0] or 0
    # what a task merges or gathers follows the bytes of its part, so larger inputs get more parts, as far as there are buckets
    parts = max(2, shuffle_parts(docs.sparkSession), min(MOST_PARTS, -(-held // PART_BYTES)))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(raw).alias("k1"), F.xxhash64(F.lit(1), F.octet_length(raw), raw).alias("k2"), raw.alias("raw"))
    least = F.lit(-(1 << 63)).cast("long")
    texts = keyed.groupBy("k1", "k2").agg(F.min(F.coalesce("doc_id", least)).alias("doc"), F.first("raw").alias("raw"), F.count("*").alias("n_rows"))
    texts = bucketed(texts, parts)
    picked = written(repeated_anchors(texts, length, parts))
    spans = cut(repeated_spans(texts, picked, length, parts))

    @tidy
    def apply(batches):
        for batch in batches:
            sizes, removed, n_spans, kept = [], [], [], []
            for raw, blobs in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                sizes.append(len(raw))
                if not blobs:
                    removed.append(0)
                    n_spans.append(0)
                    kept.append(raw)
                    continue
                found = np.frombuffer(blobs, dtype=np.int64).reshape(-1, 2)
                edge = np.zeros(len(raw) + 1, dtype=np.int32)
                np.add.at(edge, found[:, 0], 1)
                np.add.at(edge, found[:, 1], -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(gone.sum()))
                n_spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                kept.append(np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(x, pa.int64()) for x in (sizes, removed, n_spans)), pa.array(kept, pa.binary())], names=["k1", "k2", "doc", "n_bytes", "n_removed", "n_spans", "kept"])

    done = attached(texts, spans, "left").select("k1", "k2", "doc", "raw", "spans").mapInArrow(apply, "k1 long, k2 long, doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    done = done.withColumn("kept", kept_as(F.col("kept")))
    rows = keyed.groupBy("doc_id", "k1", "k2").agg(F.count("*").alias("n"))
    rows = rows.select("doc_id", "k1", "k2", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
    rows = join_heavy(rows, done, ["k1", "k2"], heavy_keys(texts.select("k1", "k2", F.col("n_rows").alias("n")), ["k1", "k2"]), ["doc_id", "copy"])
    whole = ((F.col("copy") > 1) | (F.coalesce("doc_id", least) != F.col("doc"))) & (F.col("n_bytes") >= length)
    return rows.select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"), F.when(whole, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(whole, kept_as(F.lit(b""))).otherwise(F.col("kept")).alias("kept"),
    )


def op10_repeats(spark, sf_dir):
    out = remove_repeats(table(spark, sf_dir, "documents"), kept_as=lambda kept: F.sha2(kept, 256))
    return out.withColumnRenamed("kept", "kept_sha256")


ORACLE_OP10 = """
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
    SELECT doc_id, i, md5(substr(h, 2 * i - 1, 200)) AS s FROM (SELECT doc_id, h, unnest(range(1, length(h) // 2 - 98)) AS i FROM d WHERE length(h) >= 200)
), f AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w) WHERE k > 1
), g AS (
    SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 1 ELSE 0 END AS c FROM f
), spans AS (
    SELECT doc_id, min(i) AS a, max(i) + 99 AS b FROM (SELECT doc_id, i, sum(c) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g) GROUP BY doc_id, k
), kept AS (
    SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1 AS lo, a - 1 AS hi FROM spans
    UNION ALL SELECT d.doc_id, coalesce(max(b), 0) + 1, any_value(length(h) // 2) FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id
), t AS (
    SELECT k.doc_id, string_agg(substr(h, 2 * lo - 1, 2 * (hi - lo + 1)), '' ORDER BY lo) AS kept FROM kept k JOIN d USING (doc_id) WHERE hi >= lo GROUP BY k.doc_id
), c AS (
    SELECT doc_id, sum(b - a + 1) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id
)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(t.kept, ''))) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
