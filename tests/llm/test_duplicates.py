import hashlib
import random
import re

import numpy as np
import pytest

from textloom.llm import common, graph, neardup, repeats, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_set(text):
    w = WORD.findall((text or "").translate(FOLD))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_components(rows, percent):
    sets = {i: plain_set(t) for i, t in rows}
    comp = {i: i for i in sets}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                inter = len(sets[a] & sets[b])
                if 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
                    x, y = sorted((find(a), find(b)))
                    comp[y] = x
    return sets, {i: find(i) for i in ids}


def corpus(seed=2):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for group in range(30):
        base = [rng.choice(words) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.choice([1, 1, 2, 3, 30 if group == 5 else 4])):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((n, rng.choice([" ", "\n", "  "]).join(text).upper() if rng.random() < 0.2 else " ".join(text)))
            n += 1
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "one two"), (n + 4, "ONE two"), (n + 5, "a b c d e"), (n + 6, "É b c d e"), (n + 7, "é b c d e")]


def test_shingle_sets_equal_plain():
    texts = [t or "" for _, t in corpus()]
    found, plain = shingles.shingle_sets(texts), [plain_set(t) for t in texts]
    assert [len(s) for s in found] == [len(s) for s in plain]
    for i in range(0, len(texts), 7):
        for j in range(0, len(texts), 5):
            assert len(set(found[i].tolist()) & set(found[j].tolist())) == len(plain[i] & plain[j])


@pytest.mark.parametrize("whole", [4, 1])
def test_components_equal_brute_force(spark, whole, monkeypatch):
    rows = corpus()
    sets, want = plain_components(rows, 85)
    monkeypatch.setattr(neardup.forest, "__defaults__", (whole, 40))
    monkeypatch.setattr(neardup.rest_links, "__defaults__", (8,))
    monkeypatch.setattr(neardup.set_table, "__defaults__", (1_000_000 if whole > 1 else 0,))
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, component_id int, cls string").repartition(3)
    got = {r["doc_id"]: r for r in neardup.near_duplicates(df, percent=85).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (want[i] == i) for i, r in got.items())


def test_repeated_and_null_ids(spark):
    text = "one two three four five six"
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text), (3, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in neardup.near_duplicates(df).collect())
    assert got == [(0, 1, False), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_rows_without_ids_link_like_others(spark, monkeypatch):
    """A chain of near copies holds where its middle has no doc_id, and heavy classes are dealt out."""
    words = [f"w{i}" for i in range(60)]
    text = lambda *changed: " ".join(f"x{i}" if i in changed else w for i, w in enumerate(words))
    rows = [(1, text()), (None, text(59)), (2, text(59, 58)), (None, "alone " * 9), (None, None), (7, " ")] + [(20 + i, text()) for i in range(9)] + [(1, "quite another text of one doc_id")]
    monkeypatch.setattr(neardup, "heavy_keys", lambda counts, keys: common.heavy_keys(counts, keys, most=2))
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, row int").withColumnRenamed("row", "place")
    got = {r["place"]: r for r in neardup.near_duplicates(df, percent=85, carried=["place"]).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["component_id"] == 1 for i in (0, 1, 2, *range(6, 15))) and got[0]["kept"] and not got[1]["kept"] and got[1]["n_links"] >= 1
    assert (got[3]["component_id"], got[3]["kept"], got[3]["group"] is None) == (None, False, False)
    assert (got[4]["component_id"], got[4]["kept"], got[4]["group"]) == (None, False, None)
    assert (got[5]["component_id"], got[5]["kept"], got[5]["group"]) == (7, True, None)
    assert got[15]["component_id"] == 1 and got[15]["group"] != got[0]["group"]


def test_graph(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(5, 5)]
    comp = {x: x for e in edges for x in e}
    for _ in comp:
        for a, b in edges:
            comp[a] = comp[b] = min(comp[a], comp[b])
    table = spark.createDataFrame([*edges, (None, 3)], "a long, b long").repartition(3)
    for block in (1 << 19, 7, 1):  # in one block, and by rounds over contracted blocks
        assert {r["node"]: r["component"] for r in graph.components(table, block).collect()} == comp
    assert graph.components(table.limit(0)).count() == 0


def test_stars_of_long_paths():
    order = np.random.default_rng(4).permutation(5000)
    nodes, root = graph.stars(order[:-1], order[1:])
    assert len(nodes) == 5000 and not root.any()


def brute_force(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) in order of doc_id."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            if s in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((doc_id, len(raw), sum(gone), sum(bool(g) and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_equal_brute_force(spark, tmp_path):
    rng = random.Random(9)
    parts = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(20, 260))) for _ in range(25)] + ["a" * 150, "ab" * 120, "\0" * 130]
    rows = [(i, "".join(rng.choice(parts)[rng.randint(0, 40) :] for _ in range(rng.randint(0, 6)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, rows[3][1]), (203, rows[3][1]), (204, "x" * 99), (205, "x" * 99), (206, "y" * 100), (207, "y" * 100)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, raw int").repartition(5)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in repeats.op10_repeats(spark, str(tmp_path)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == brute_force(rows)


@pytest.mark.parametrize(("entries", "shares", "least"), [(50_000, 2.0, 20), (60, 0.5, 5), (60, 0.0, 1)])
def test_many_contexts_of_one_passage(spark, tmp_path, monkeypatch, entries, shares, least):
    """Hot grams: their windows are dealt out by digest, and nothing else changes."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(30, 60)))
    passage = "".join(rng.choice("klmnop ") for _ in range(70))
    contexts = [word() for _ in range(12)]
    rows = [(i, rng.choice(contexts) + passage + rng.choice(contexts) + word()) for i in range(160)] + [(300 + i, passage * 3) for i in range(5)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(repeats.repeated_spans, "__defaults__", (2000, entries, shares, least))
    monkeypatch.setattr(repeats, "HELD", 40)
    got = sorted(tuple(r) for r in repeats.op10_repeats(spark, str(tmp_path)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == brute_force(rows)


def test_spans_are_joined():
    rng = random.Random(3)
    spans = [(rng.randrange(4), a := rng.randrange(60), a + rng.randint(1, 9)) for _ in range(40)]
    cover = {(r, i) for r, a, b in spans for i in range(a, b)}
    rid, start, end = (x.tolist() for x in repeats.joined_spans(spans))
    assert {(r, i) for r, a, b in zip(rid, start, end, strict=True) for i in range(a, b)} == cover
    found = list(zip(rid, start, end, strict=True))
    assert all(x[0] != y[0] or x[2] < y[1] for x, y in zip(found, found[1:], strict=False))
    assert len(repeats.joined_spans([])[0]) == 0


def test_a_very_long_text_and_a_heavy_key(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    long = "".join(rng.choice("abcdefgh ") for _ in range(1_200_000))
    rows = [(1, long), (2, long[500_000:700_000] + "zz" + long[:150]), (3, long[-130:])] + [(10 + i, "m" * 50 + "copy " * 20) for i in range(40)]
    monkeypatch.setattr(repeats, "heavy_keys", lambda counts, keys: common.heavy_keys(counts, keys, most=7))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in repeats.op10_repeats(spark, str(tmp_path)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == brute_force(rows)


def test_segments_give_the_same_anchors(monkeypatch):
    rng = random.Random(4)
    long = "".join(rng.choice("abcd") for _ in range(2000)) + "a" * 400
    texts = [long.encode(), (long[500:900] + "z" + long[100:300]).encode(), b"short"]

    def of_windows():
        home, place, lo, hi, hashes, _ = repeats.text_anchors(texts, 100)
        return {(h, w): (p, x) for h, p, a, b, x in zip(*(v.tolist() for v in (home, place, lo, hi, hashes)), strict=True) for w in range(a, b + 1)}

    whole = of_windows()
    assert len(whole) == sum(max(0, len(t) - 99) for t in texts)
    monkeypatch.setattr(repeats, "CHUNK", 300)
    assert of_windows() == whole


def test_repeated_rows_and_empty_table(spark):
    t = "q" * 60 + "".join(map(str, range(60)))
    df = spark.createDataFrame([(1, t), (1, t), (None, t)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in repeats.remove_repeats(df).collect())
    assert got == [(0, 0), (1, len(t)), (1, len(t))]
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def test_loser_tree_merges_with_prefixes():
    rng = random.Random(6)
    runs = []
    for _ in range(7):
        keys = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 30)))
        run = repeats.Run()
        run.keys, run.lcps = keys, repeats.np.array([0, *map(repeats.common, keys[:-1], keys[1:])][: len(keys)], dtype=repeats.np.uint8)
        runs.append(run)
    out = list(repeats.merged(runs))
    assert [o[0] for o in out] == sorted(k for r in runs for k in r.keys)
    assert all(o[1] == repeats.common(p[0], o[0]) for p, o in zip(out[:-1], out[1:], strict=True))
