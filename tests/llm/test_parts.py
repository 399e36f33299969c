import random

from textloom.llm import repeats


def test_parts_follow_the_bytes(spark, monkeypatch):
    """More parts than shuffle partitions for the same texts give the same rows."""
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(300)) + passage[a : a + 250] for a in rng.choices(range(150), k=40)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = []
    made = repeats.bucketed
    monkeypatch.setattr(repeats, "bucketed", lambda t, parts: seen.append(parts) or made(t, parts))
    rows = lambda: sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in repeats.remove_repeats(docs).collect())
    want = rows()
    monkeypatch.setattr(repeats, "PART_BYTES", 1000)
    assert rows() == want and sum(r[2] for r in want) > 5000
    assert seen[0] == 4 and seen[1] > 15
