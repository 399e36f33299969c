import hashlib
import random
import re
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.llm import chat, common, sharding


def naive(sizes, capacity):
    """Best fit decreasing, one item at a time, ties to the earlier bin."""
    left, out = [], []
    for s in sorted(sizes, reverse=True):
        fits = [(r, b) for b, r in enumerate(left) if r >= s]
        if fits:
            b = min(fits)[1]
        else:
            left.append(max(capacity, s))
            b = len(left) - 1
        left[b] -= s
        out.append((s, b))
    return out, len(left)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=60), st.integers(5, 60))
def test_packing_equals_naive(sizes, capacity):
    hist = [(s, sizes.count(s)) for s in set(sizes)]
    packing = sharding.best_fit_decreasing(hist, capacity)
    want, bins = naive(sizes, capacity)
    assert packing.bins == bins
    seen: dict = {}
    for s, b in want:
        assert sharding.shard_of(packing, s, seen.setdefault(s, 0)) == b
        seen[s] += 1


def test_tree_stays_balanced():
    tree, keys = sharding.CapacityTree(), [(i * 7919 % 5000, i) for i in range(5000)]
    for k in keys:
        tree.insert(k)
    depth = lambda n: 0 if n is None else 1 + max(depth(n.left), depth(n.right))
    assert depth(tree.root) <= 26
    for k in keys[::2]:
        tree.remove(k)
    left = sorted(keys[1::2])
    assert depth(tree.root) <= 26 and all(tree.tightest(s) == next((k for k in left if k[0] >= s), None) for s in range(0, 5001, 97))


def test_shards(spark):
    rng = random.Random(0)
    rows = [(i, "x" * rng.randint(0, 300) + str(rng.randint(0, 30)), 1) for i in range(400)] + [(500, None, 1), (501, "", 1), (502, "é🎉", 1), (502, "é🎉", 1)] + [(600 + i, "copy" * 20, 1) for i in range(60)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string, size int"), n_shards=4).collect()
    assert len(got) == len(rows)
    texts = {i: t or "" for i, t, _ in rows}
    by_text, totals = {}, {}
    for r in got:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        by_text.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
        totals[r["shard"]] = totals.get(r["shard"], 0) + r["size"]
    assert all(len(s) == 1 for s in by_text.values()) and len(totals) == 4
    assert max(totals.values()) - min(totals.values()) < 0.2 * max(totals.values())
    for s in totals:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert max(sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string, size int"), capacity=10_000).groupBy("shard").agg(F.sum("size")).toPandas()["sum(size)"]) <= 10_000
    assert sharding.shard_documents(spark.createDataFrame([], "doc_id long, text string"), n_shards=4).count() == 0


def loads(packing, hist):
    out: dict = {}
    for s, n in hist:
        for rank in range(n):
            b = sharding.shard_of(packing, s, rank)
            out[b] = out.get(b, 0) + s
    return out


def test_large_groups_leave_the_other_bins_equal():
    rng = random.Random(4)
    small = {s: rng.randint(1, 5) for s in range(1, 60)}
    total = sum(s * n for s, n in small.items())
    for large in ([total // 2], [total // 9], [total, total // 2, total // 2], [total // 9] * 5):
        hist = sorted({**small, **{s: large.count(s) for s in large}}.items())
        got = loads(sharding.pack_into(hist, 16), hist)
        rest = sorted(got.values(), reverse=True)[len(large) :]
        assert sorted(got) == list(range(16)) and sorted(got.values(), reverse=True)[: len(large)] == sorted(large, reverse=True)
        assert max(rest) - min(rest) <= 0.05 * max(rest)
    assert sorted(loads(sharding.pack_into([(10, 17)], 16), [(10, 17)]).values()) == [10] * 15 + [20]
    mixed = [(500, 17), (1, 1500)]
    got = sorted(loads(sharding.pack_into(mixed, 16), mixed).values())
    assert len(got) == 16 and got[-1] == 1000 and got[-2] - got[0] <= 0.05 * got[-2]
    assert sharding.pack_into([(5, 1), (3, 1)], 16).bins == 2 and sharding.pack_into([], 16).bins == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=60), st.integers(1, 12))
def test_packing_places_every_group_once(sizes, n_bins):
    hist = [(s, sizes.count(s)) for s in set(sizes)]
    packing = sharding.pack_into(hist, n_bins)
    got = loads(packing, hist)
    assert sorted(got) == list(range(packing.bins)) and packing.bins <= n_bins and sum(got.values()) == sum(sizes)


def test_shards_with_a_third_in_one_group(spark):
    rng = random.Random(1)
    rows = [(i, "y" * rng.randint(20, 300) + str(i)) for i in range(1500)]
    third = sum(len(t) + 1 for _, t in rows) // 2
    rows += [(5000 + i, "copy" * 30) for i in range(third // 121)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), n_shards=16)
    totals = sorted(r["b"] for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect())
    assert got.count() == len(rows) and len(totals) == 16 and totals[-1] == third // 121 * 121
    assert totals[-2] - totals[0] < 0.05 * totals[-2]


@pytest.mark.parametrize("sizes", [100_000, 200])
def test_op9_rows(spark, tmp_path, sizes, monkeypatch):
    """The query's rows against what its contract says, also with sizes told apart to a coarse grain only."""
    rng = random.Random(3)
    rows = [(i, "z" * rng.randint(0, 400) + str(rng.randint(0, 900))) for i in range(3000)] + [(None, "n" * rng.randint(1, 9)) for _ in range(200)] + [(7, "again"), (7, "again"), (8000, None), (8001, "")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(sharding.shard_documents, "__defaults__", (16, None, None, 40, sizes))
    monkeypatch.setattr(sharding, "heavy_keys", lambda counts, keys: common.heavy_keys(counts, keys, most=20))
    got = sharding.op9_sharding(spark, str(tmp_path)).collect()
    measure = lambda t: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
    known = lambda i: -1 if i is None else i
    assert sorted((known(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted((known(i), *measure(t)) for i, t in rows)
    totals, slots, homes = {}, {}, {}
    for r in got:
        totals[r["shard"]] = totals.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        homes.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert sorted(totals) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(h) == 1 for h in homes.values())
    assert max(totals.values()) - min(totals.values()) <= (0.002 if sizes > 1000 else 0.02) * max(totals.values())
    capped = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), capacity=5000, sizes=sizes).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert max(r["b"] for r in capped) <= 5000


def test_sizes_are_bounded():
    for total in (1, 1000, 10**9, 10**14, 10**17):
        grain, large = sharding.grain_of(total)
        assert -(-large // grain) + total // large <= 2 * sharding.SIZES + 2
    assert sharding.grain_of(10**10 - 1)[0] == 1


def test_fewer_groups_than_shards(spark):
    got = sharding.shard_documents(spark.createDataFrame([(1, "aaa"), (2, "b"), (3, "b")], "doc_id long, text string"), n_shards=16).collect()
    at = {r["doc_id"]: (r["shard"], r["slot"]) for r in got}
    assert at[1][1] == 0 and {at[2][1], at[3][1]} == {0, 1} and at[2][0] == at[3][0] != at[1][0]


def chat_escaped(t):
    return re.sub(chat.CONTROLS, r"\\\1", t)


def back(windows):
    """conv_id: turns, targets and characters, put together from its windows."""
    out: dict = {}
    for r in sorted(chat.read_windows(windows).collect(), key=lambda r: r["first_turn"]):
        c = out.setdefault(r["conv_id"], {"turns": [], "targets": [], "formatted_chars": 0})
        assert len(c["turns"]) == r["first_turn"]
        c["turns"] += r["turns"]
        c["targets"] += r["targets"]
        c["formatted_chars"] += r["formatted_chars"]
    return out


@pytest.mark.parametrize("blocks", [64, 2])
def test_chat_windows(spark, blocks):
    rng = random.Random(3)
    alphabet = ["</s>", "<s>", "[INST]", "[/ROLE]", "\\", " ", "\n", "a", "🎉", "[ROLE] user [/ROLE] x </s>", "word "]
    rows, conv = [], {}
    for c in range(40):
        roles = (["system"] if c % 3 == 0 else []) + ["user", "assistant"] * rng.randint(1, 12)
        turns = [(r, None if rng.random() < 0.05 else "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 20)))) for r in roles]
        conv[c] = [(r, t or "") for r, t in turns]
        rows += [(c, i, r, t, "extra") for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    windows = chat.format_conversations(df, budget=120, history_budget=40, block_windows=blocks)
    got = back(windows)
    assert set(got) == set(conv)
    for c, turns in conv.items():
        assert [tuple(t) for t in got[c]["turns"]] == turns
        assert list(got[c]["targets"]) == [t for r, t in turns if r == "assistant"]
    cost = lambda t: -(-len(t.encode()) // 4) + 8
    parts = windows.collect()
    assert max(w["first_turn"] for w in parts) > 0
    for w in parts:
        turns = conv[w["conv_id"]]
        assert w["formatted"].startswith("<s>[ROLE] ") and (w["n_new"] == 1 or w["formatted"].count("\\") >= 0)
        new = w["n_new"] - (1 if w["first_turn"] == 0 and turns[0][0] == "system" else 0)
        start = sum(x["n_new"] for x in parts if x["conv_id"] == w["conv_id"] and x["first_turn"] < w["first_turn"])
        fresh = turns[start : start + w["n_new"]]
        if new > 1:  # a longer turn may stand alone
            system = cost(turns[0][1]) if turns[0][0] == "system" and w["first_turn"] else 0
            assert sum(cost(t) for _, t in fresh) + system <= 120
        if w["first_turn"]:
            n_sys = int(turns[0][0] == "system")
            assert w["formatted"].startswith("<s>[ROLE] system [/ROLE] ") or not n_sys
            assert n_sys <= w["n_repeated"] <= n_sys + 2
            near = [cost(t) for _, t in turns[n_sys:start][-2:]]
            most = max(j for j in range(len(near) + 1) if sum(near[len(near) - j :]) <= 40)
            assert w["n_repeated"] == n_sys + most
            again = "".join(f"[ROLE] {chat_escaped(r)} [/ROLE] {chat_escaped(t)} </s>" for r, t in turns[:n_sys] + turns[start - most : start])
            assert w["formatted"].startswith("<s>" + again)
    assert chat.read_windows(chat.format_conversations(df.limit(0))).count() == 0
    assert [tuple(r) for r in chat.format_conversations(df, budget=120, history_turns=0).filter("n_repeated > 1").limit(1).collect()] == []


def test_chat_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 0, None, None), (1, 0, None, None), (None, None, "user", "x")], "conv_id long, turn long, role string, text string")
    got = {i: [tuple(t) for t in r["turns"]] for i, r in back(chat.format_conversations(df)).items()}
    assert got == {1: [("", ""), ("", "")], None: [("user", "x")]}


def test_a_long_conversation_and_a_long_turn(spark, tmp_path):
    """Blocks keep rows small; the query's rows are those of its statement."""
    rng = random.Random(5)
    rows = [(1, i, "system" if i == 0 else rng.choice(["user", "assistant"]), "w" * rng.choice([3, 40, 900, 9000])) for i in range(1500)]
    rows += [(2, 0, "system", "s" * 600_000), (2, 1, "user", "hello </s>"), (2, 2, "assistant", "x" * 700_000), (2, 3, "user", "bye")] + [(3, i, "assistant", "a [INST]") for i in range(5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    windows = chat.format_conversations(df)
    assert windows.filter("conv_id = 1").agg(F.max(F.length("formatted"))).first()[0] < 30_000
    got = back(windows)
    assert [tuple(t) for t in got[1]["turns"]] == [r[2:] for r in rows if r[0] == 1] and len(got[3]["targets"]) == 5000
    want = duckdb.sql(chat.oracle_sql().replace("conversations", f"read_parquet('{tmp_path}/conversations.parquet/*.parquet')")).fetchall()
    assert sorted(map(tuple, chat.op7_chat_formatting(spark, str(tmp_path)).collect())) == sorted(want)


def test_op7_digests(spark, sf_dir):
    got = {r["conv_id"]: r for r in chat.op7_chat_formatting(spark, sf_dir).collect()}
    said = "</s>[INST] ok [/INST]"
    assert got[-1]["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert (got[-1]["n_turns"], got[-1]["loss_chars"], got[-1]["loss_sha256"]) == (2, len(said), hashlib.sha256(said.encode()).hexdigest())
