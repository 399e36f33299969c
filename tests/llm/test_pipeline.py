"""Each stage on a small table against a plain statement of what it must do."""

import corpus_pipeline as pipeline

from textloom.llm import common, decontaminate, pii
from textloom.llm.common import table

from test_duplicates import FOLD, WORD, plain_components
from test_search import plain_spans


def test_entry_module_lists_all():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    seen = {0: docs}
    for i, (_, stage) in enumerate(pipeline.STAGES):
        seen[i + 1] = pipeline.written(stage(spark, seen[i], sf))
        if i + 1 < len(pipeline.STAGES):
            assert seen[i + 1].columns == docs.columns
    counts = [seen[i].count() for i in range(6)]
    assert counts[0] > counts[1] > counts[2] > counts[3] == counts[4] == counts[5]
    labels = table(spark, sf, "labels")
    kept = seen[1].join(labels, "doc_id")
    assert kept.filter("quality = 0").count() == 0 and kept.count() >= 0.99 * labels.filter("quality = 1").count()
    assert seen[2].select("text").distinct().count() == counts[2]
    items = [r["text"] for r in table(spark, sf, "benchmark").collect()]
    texts = [r["text"] for r in seen[3].collect()]
    assert not any(i in t for i in items for t in texts)
    assert pii.find_pii(seen[4]).filter("size(base_spans) > 0").count() == 0
    before = {r["doc_id"]: r["text"] for r in seen[3].collect()}
    same = [r for r in seen[4].collect() if "[" not in r["text"]]
    assert same and all(before[r["doc_id"]] == r["text"] for r in same)
    last = {r["doc_id"]: r for r in seen[5].collect()}
    for r in seen[4].collect():
        assert last[r["doc_id"]]["n_bytes"] == len(r["text"].encode()) and last[r["doc_id"]]["n_tokens"] == len(last[r["doc_id"]]["ids"])
    assert pipeline.run(spark, sf).count() == counts[5]


ODD = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_on_nulls_and_empty(spark):
    sf = "/root/testdata/sf0.001"
    plain = "Plain words stand here, and the sentence goes on for a while."
    odd = spark.createDataFrame([(1, None, "en", "s", None), (2, "", None, None, 0), (None, "Some words to keep here, as nobody else says them.", "en", "s", 23), (3, plain, "en", "s", 23), (3, plain, "en", "s", 23)], ODD)
    kept = odd
    for _, stage in pipeline.STAGES[1:4]:
        kept = stage(spark, kept, sf)
        assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [(0, "Some words to keep here, as nobody else says them."), (1, ""), (2, ""), (3, plain)]
    last = {r["doc_id"]: r for r in pipeline.encode_tokens(spark, kept, sf).collect()}
    assert last[1]["n_tokens"] == last[2]["n_tokens"] == 0 and last[3]["n_bytes"] == len(plain)
    assert pipeline.keep_quality(spark, odd, sf).columns == odd.columns
    docs = odd.limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0


def test_one_row_of_each_group_stays(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    a, near, other = " ".join(words), " ".join([*words[:-1], "x"]), "another text that stands alone"
    rows = [(3, a, "en"), (3, a, "de"), (5, near, "en"), (5, other, "en"), (None, a, "en"), (None, "no id and no copy", "en"), (None, "no id and no copy", "en"), (8, "", "en"), (8, "", "en")] + [(9, "equal rows", "en")] * 6
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for most in (100_000, 3):
        monkeypatch.setattr(pipeline, "heavy_keys", lambda counts, keys, most=most: common.heavy_keys(counts, keys, most=most))
        kept = [tuple(r) for r in pipeline.drop_near_duplicates(spark, docs, "").collect()]
        assert len(kept) == 6 + 0 and sum(r[:2] == (3, a) for r in kept) == 1
        assert sorted((r[0] or 0, r[1]) for r in kept) == [(0, "no id and no copy"), (3, a), (5, other), (8, ""), (8, ""), (9, "equal rows")]


def test_pipeline_equals_plain_statements(spark, tmp_path):
    """run() on a small table against the stages said in plain Python."""
    import base64
    import shutil

    import tiktoken

    sf = "/root/testdata/sf0.001"
    for name in ("labels", "benchmark"):
        shutil.copy(f"{sf}/{name}.parquet", tmp_path / f"{name}.parquet")
    table(spark, sf, "documents").write.parquet(str(tmp_path / "documents.parquet"))
    docs, labels, bench = (table(spark, str(tmp_path), t) for t in ("documents", "labels", "benchmark"))
    rules = pipeline.quality.fit_quality(docs, labels)
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    scores = rules.score_rows(pipeline.quality.np.array([pipeline.quality.text_stats(t) for _, t in rows]))
    rows = [r for r, s in zip(rows, scores, strict=True) if s >= pipeline.KEEP_FROM]
    _, comp = plain_components(rows, 80)
    rows = [(i, t) for i, t in rows if comp[i] == i]
    items = [" ".join(WORD.findall(r["text"].translate(FOLD))) for r in bench.collect()]

    def stands_in(text):
        low = " ".join(WORD.findall(text.translate(FOLD)))
        starts = [0, *(i + 1 for i, c in enumerate(low) if c == " ")]
        # an edit touches at most 8 of the 8-grams, so no item within the distance is passed over
        near = [n for n in items if sum(n[i : i + 8] in low for i in range(len(n) - 7)) >= len(n) - 7 - 8 * (len(n) // 10)]
        return any(decontaminate.edit_distance(decontaminate.bit_masks(n), len(n), low[s : s + len(n) + len(n) // 10], len(n) // 10)[0] <= len(n) // 10 for n in near for s in starts)

    rows = [(i, t) for i, t in rows if not stands_in(t)]
    model = pii.fit_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    clean = {r["doc_id"]: r["text"] for r in pii.redact(pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"), model)).collect()}
    for i, t in rows:
        assert all(t[a:b] not in clean[i] for a, _, b in plain_spans(t))
    path, pattern = pipeline.bpe.vocabulary()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in pipeline.run(spark, str(tmp_path)).collect()}
    assert {i: list(r["ids"]) for i, r in got.items()} == {i: library.encode_ordinary(t) for i, t in clean.items()}
    assert all(r["n_tokens"] == len(r["ids"]) and r["n_bytes"] == len(clean[i].encode()) for i, r in got.items())
