"""Rules, folds, guards and gates on handmade rows, against plain restatements."""

import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import digests as D
from textloom.functions import text as X
from textloom.operators import automaton, codepoints, context, glossary, planning, review, stages, validate
from textloom.operators.ordered import with_group_numbers
from textloom.policy import Policy, japanese_chinese, locale_issues, multilingual
from textloom.streaming.status import latest_statuses

UNIT = "ord long, id string, text string, source_hash string, protected_tokens array<string>"


def codes(issues):
    return Counter((r["code"], r["id"]) for r in issues.collect())


def test_row_rules_each_code(spark):
    source = spark.createDataFrame([
        (1, "ok", "One <b> two <b>", None, ["<b>", "<b>"]), (2, "count", "a <x> b", None, ["<x>"]), (3, "order", "<1>a<2>", None, ["<1>", "<2>"]), (4, "lines", "a\nb", None, None), (5, "bad", "text", None, []),
        (6, "nfc", "word", None, []), (7, "same", "Hello there", None, []), (8, "kana", "こんにちは", None, []), (9, "ratio", "long enough text", None, []), (10, "empty", "x", None, []), (11, "hash", "x y", "sha256:1", []), (12, "gone", "x", None, []), (13, "punct", "...", None, []),
    ], UNIT)
    target = spark.createDataFrame([
        (1, "ok", "Un <b> deux <b>", "high", None), (2, "count", "a b", "high", None), (3, "order", "<2>a<1>", "high", None), (4, "lines", "a b", "high", None), (5, "bad", "tex�", "high", None), (6, "nfc", "téxt", "high", None),
        (7, "same", "Hello there", "high", None), (8, "kana", "こbonjour", "high", None), (9, "ratio", "l", "high", None), (10, "empty", "", "high", None), (11, "hash", "x z", "no", "sha256:2"), (13, "punct", "...", "high", None), (14, "more", "x", "high", None), (14, "more", "y", "high", None),
    ], "ord long, id string, translation string, confidence string, source_hash string")
    got = codes(validate.validate(source, target, multilingual("ja", "en")))
    want = [("protected-token-count", "count"), ("protected-token-order", "count"), ("protected-token-order", "order"), ("newline-count", "lines"), ("invalid-character", "bad"), ("unicode-normalization", "nfc"), ("source-unchanged", "same"),
            ("residual-source-script", "kana"), ("length-ratio", "ratio"), ("empty-translation", "empty"), ("source-hash", "hash"), ("confidence", "hash"), ("missing-ids", "gone"), ("extra-ids", "more"), ("duplicate-target-id", "more")]
    assert got == Counter(want)
    assert validate.verdict(validate.validate(source, target, japanese_chinese(), allow_subset=True)).first()["passed"] is False


def test_policies():
    assert multilingual("ja-JP", "zh-TW").ratios() == (0.12, 4.0) and multilingual("it", "pt").ratios() == (0.08, 8.0)
    assert multilingual("ja", "zh").residual() is not None and multilingual("zh", "ja").residual() is None and multilingual("en", "fr").residual() is None
    assert locale_issues("en", "EN") and locale_issues("", "fr") and not locale_issues("en-US", "fr")


texts = st.text(alphabet="ab<>{}é🎉\n ", max_size=30)


def test_token_functions_against_plain(spark):
    rng = random.Random(4)
    cases = [("".join(rng.choice("ab<é🎉") for _ in range(rng.randint(0, 12))), ["".join(rng.choice("ab<é") for _ in range(rng.randint(0, 2))) for _ in range(rng.randint(0, 4))]) for _ in range(300)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, t string, k array<string>")
    t, k = F.col("t"), F.col("k")
    got = df.select("i", X.miscounted(t, k).alias("m"), X.in_order(t, k).alias("o"), X.without_once(t, k).alias("w"), X.newlines(t).alias("n")).orderBy("i").collect()
    for r, (text, tokens) in zip(got, cases, strict=True):
        wrong = [x for x, n in Counter(tokens).items() if text.count(x) != n]
        at, fine = 0, True
        for x in tokens:
            at = text.find(x, at)
            if at < 0:
                fine = False
                break
            at += len(x)
        once = text
        for x in tokens:
            once = once.replace(x, "", 1) if x else once
        assert (sorted(r["m"]), r["o"], r["w"], r["n"]) == (sorted(wrong), fine, once, text.count("\n")), (text, tokens)


def plain_split(records, most):
    out, current, chars, forced = [], [], 0, False
    for n, natural in records:
        if most > 0 and current and chars + n > most:
            out.append((len(current), forced or not natural))
            current, chars, forced = [], 0, not natural
        current.append(n)
        chars += n
    return [*out, (len(current), forced or (most > 0 and chars > most))] if current else out


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.booleans()), min_size=1, max_size=25), st.integers(0, 20))
def test_greedy_parts(spark, records, most):
    df = spark.createDataFrame([(0, i, "x" * n, b) for i, (n, b) in enumerate(records)], "grp long, ord long, text string, boundary_before boolean")
    got = planning.greedy_parts(df, most).orderBy("ord").collect()
    sizes = Counter(r["part"] for r in got)
    forced = {r["part"]: r["forced"] for r in got}
    assert [(sizes[p], forced[p]) for p in sorted(sizes)] == plain_split(records, most)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.booleans()), min_size=1, max_size=30), st.integers(1, 20))
def test_chunks_cover_and_fit(spark, records, target):
    df = spark.createDataFrame([("j", i, f"e{i}", "x" * n, b, "s") for i, (n, b) in enumerate(records)], "job string, ord long, id string, text string, boundary_before boolean, scene_id string")
    got = planning.chunk_rows(df, "job", target).orderBy("ord").collect()
    assert [r["id"] for r in got] == [f"e{i}" for i in range(len(records))]
    assert [r["chunk"] for r in got] == sorted(r["chunk"] for r in got)
    size = Counter()
    for r, (n, _) in zip(got, records, strict=True):
        size[r["chunk"]] += n
    for r in got:
        alone = sum(x["chunk"] == r["chunk"] for x in got) == 1
        assert size[r["chunk"]] <= target or alone or r["forced"]
    cover = planning.coverage(df.select("job", "id"), planning.chunk_rows(df, "job", target).select("job", "id"), "job").first()
    assert cover["valid"] and cover["planned"] == len(records)


def test_islands_across_buckets(spark):
    rng = random.Random(1)
    keys = [rng.choice("ab") for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(keys)), "ord long, k string").repartition(5)
    got = [r["grp"] for r in with_group_numbers(df, F.col("k"), bucket=7).orderBy("ord").collect()]
    want, n = [], 0
    for i, k in enumerate(keys):
        n += bool(i) and k != keys[i - 1]
        want.append(n)
    assert got == want


def test_merge_group_joins_scenes_of_a_route(spark):
    df = spark.createDataFrame([(1, "r", "s1", "m"), (2, "r", "s2", "m"), (3, "q", "s2", "m"), (4, "q", "s3", None), (5, "q", "s2", None)], "ord long, route string, scene_id string, merge_group string")
    assert [r["grp"] for r in planning.scene_islands(df).orderBy("ord").collect()] == [0, 0, 1, 2, 3]


def test_glossary_modes_and_blocks(spark):
    terms = [("cat", "chat", "locked", "", "word", ""), ("c.t", "x", "preferred", "", "regex", ""), ("(", "x", "locked", "", "regex", ""), ("CAT", "y", "locked", "", "", "true"), ("cat", "z", "locked", "elsewhere", "", ""), ("", "bad", "forbidden", "", "", "")]
    g = spark.createDataFrame(terms, "source string, target string, status string, scope string, match_mode string, case_sensitive string")
    pairs = spark.createDataFrame([("1", ("a Cat sat",), ("un bad",)), ("2", ("concatenate",), ("x",))], "id string, s struct<text:string>, t struct<translation:string>")
    got = {(r["id"], r["code"], r["source"]) for r in glossary.term_issues(pairs, g, Policy("en", "fr")).collect()}
    assert got == {("1", "locked-term", "cat"), ("1", "preferred-term", "c.t"), ("1", "forbidden-term", "")}
    entries = glossary.entries_of(pairs)
    prepared = glossary.prepared(g, Policy("en", "fr"))
    one = {tuple(r) for r in glossary.term_hits(entries, prepared).collect()}
    assert one == {tuple(r) for r in glossary.term_hits(entries, prepared, block=2).collect()} and len(one) == 4


def test_glossary_patterns_and_folding(spark):
    """Patterns that aren't valid match nothing; substrings without case match by full case folding."""
    terms = [("(?P<x>a+)b(?P=x)", "z", "locked", "regex", ""), ("a{,2}", "z", "locked", "regex", ""), ("(?<!a*)q", "z", "locked", "regex", ""), ("straße", "rue", "locked", "", ""), ("ΌΔΌΣ", "rue", "locked", "", "no"), ("Straße", "rue", "locked", "", "yes")]
    g = spark.createDataFrame(terms, "source string, target string, status string, match_mode string, case_sensitive string")
    pairs = spark.createDataFrame([("1", ("xaabaay",), ("none",)), ("2", ("DIE STRASSE",), ("la RUE",)), ("3", ("die STRASSE, όδός",), ("none",))], "id string, s struct<text:string>, t struct<translation:string>")
    got = {(r["id"], r["source"]) for r in glossary.term_issues(pairs, g, Policy("de", "fr")).collect()}
    assert got == {("1", "(?P<x>a+)b(?P=x)"), ("3", "straße"), ("3", "ΌΔΌΣ"), ("1", "a{,2}"), ("2", "a{,2}"), ("3", "a{,2}")}
    assert [len(b) for b in automaton.blocks_of(["s" * 400_000] * 5, len)] == [2, 2, 1] and automaton.blocks_of([], len) == [[]]


def test_review_guards_on_drafts(spark):
    source = spark.createDataFrame([(1, "a", "x", "h1", []), (2, "b", "y\n<t>", "h2", ["<t>"]), (3, "c", "z", "h3", None)], UNIT)
    draft = spark.createDataFrame([(1, "a", None), (2, "b", "Y <t>"), (3, "c", "Z\0")], "ord long, id string, translation string")
    none = spark.createDataFrame([], "ord long, id string, reviewer_translation string, reason string, severity string")
    assert {(r["guard"], r["id"]) for r in review.delta_problems(source, draft, none).collect()} == {("draft-empty", "a"), ("draft-newlines", "b"), ("draft-invalid", "c")}
    bare = spark.createDataFrame([(1, "a", "A", "x")], "ord long, id string, reviewer_translation string, more string")
    found = {(r["guard"], r["id"]) for r in review.delta_problems(source, draft, bare).collect()}
    assert ("fields", "more,no reason,no severity") in found and {("reason", "a"), ("severity", "a")} <= found
    assert {r["guard"] for r in review.delta_problems(source.limit(0), draft.limit(0), none).collect()} == {"empty-job"}


def test_shadowing(spark):
    g = spark.createDataFrame([("sword", "lame", "locked", ""), ("holy sword", "épée", "locked", "")], "source string, target string, status string, scope string")
    pairs = spark.createDataFrame([("1", ("the holy sword",), ("l'épée",)), ("2", ("a sword",), ("une arme",))], "id string, s struct<text:string>, t struct<translation:string>")
    assert {(r["id"], r["source"]) for r in glossary.term_issues(pairs, g, Policy("en", "fr", term_modes=False)).collect()} == {("2", "sword")}


def test_review_guards_and_overlay(spark):
    source = spark.createDataFrame([(1, "a", "x", "h1", []), (2, "b", "y\n", "h2", ["\n"])], UNIT)
    draft = spark.createDataFrame([(1, "a", "A"), (2, "b", "B\n")], "ord long, id string, translation string")
    delta = lambda rows: spark.createDataFrame(rows, "ord long, id string, reviewer_translation string, reason string, severity string")
    good = delta([(1, "b", "BB\n", "why", "minor")])
    assert review.delta_problems(source, draft, good).count() == 0
    done = {r["id"]: (r["translation"], r["source_hash"]) for r in review.overlay(draft, good, source).collect()}
    assert done == {"a": ("A", "h1"), "b": ("BB\n", "h2")}
    again = review.overlay(review.overlay(draft, good, source), good, source)
    assert {r["id"]: r["translation"] for r in again.collect()} == {"a": "A", "b": "BB\n"}
    bad = delta([(1, "b", "BB", " ", "huge"), (2, "a", "", "r", "major"), (3, "zz", "q", "r", "minor")])
    guards = {(r["guard"], r["id"]) for r in review.delta_problems(source, draft, bad).collect()}
    assert {("reason", "b"), ("severity", "b"), ("newlines", "b"), ("tokens", "b"), ("empty", "a"), ("unknown-id", "zz"), ("delta-order", "a")} <= guards
    with pytest.raises(review.GuardError):
        review.guard(review.delta_problems(source, draft, bad), "review")


def test_review_report_digests(spark):
    sha = lambda t: "sha256:" + hashlib.sha256(t.encode()).hexdigest()
    source = spark.createDataFrame([(2, "b", "y", None, []), (1, "a", "x", "h1", [])], UNIT)
    records = "ord long, id string, translation string, raw string"
    draft = spark.createDataFrame([(2, "b", "B", '{"translation": "B", "id": "b", "__line": 2}'), (1, "a", "A", '{"id":"a","translation":"A"}')], records)
    delta = spark.createDataFrame([(1, "b", "minor", '{"id":"b","severity":"minor"}')], "ord long, id string, severity string, raw string")
    report = review.job_review_report("j", source, draft, delta)
    got = report.first().asDict()
    want = {
        "schema_version": 2, "job_id": "j", "reviewed_source_digest": sha("a\0h1\nb\0\n"), "reviewed_draft_digest": sha('{"id":"a","translation":"A"}\n{"id":"b","translation":"B"}\n'),
        "review_delta_digest": sha('{"id":"b","severity":"minor"}\n'), "reviewed_entry_count": 2, "coverage": "all-entries", "delta_count": 1, "major_count": 0, "minor_count": 1, "passed": True,
    }
    assert got == want and review.stale_fields({**want, "minor_count": 9}, report) == []
    assert review.stale_fields({**want, "reviewed_draft_digest": "old", "delta_count": 2}, report) == ["reviewed_draft_digest", "delta_count"]
    assert review.job_review_report("j", source, draft, delta.limit(0)).first()["review_delta_digest"] == sha("")


def test_token_arrays_with_nulls(spark):
    source = spark.createDataFrame([(1, "torn", "a <x> b", None, ["<x>", None]), (2, "none", "a", None, None)], UNIT)
    target = spark.createDataFrame([(1, "torn", "c d", "high"), (2, "none", "b", "high")], "ord long, id string, translation string, confidence string")
    assert codes(validate.validate(source, target, multilingual("ja", "en"))) == Counter([("protected-token-schema", "torn")])


def test_stage_machine(spark):
    assert stages.may_advance("initialized", "researched", []) == [] and stages.may_advance("initialized", "extracted", []) and stages.may_advance("initialized", "researched", ["initialized"])
    h = spark.createDataFrame([("ok", 0, "initialized", ["e"]), ("ok", 1, "researched", ["e"]), ("gap", 0, "researched", ["e"]), ("bare", 0, "initialized", [])], "project string, n int, stage string, evidence array<string>")
    assert {r["item"] for r in stages.history_problems(h).collect()} == {"gap", "bare"}
    jobs = spark.createDataFrame([("j1", "pending"), ("j2", "pending")], "job_id string, status string")
    changes = spark.createDataFrame([("j1", "pending", "assigned", "n"), ("j2", "assigned", "translated", None)], "job_id string, from_status string, to_status string, note string")
    assert {r["job_id"]: r["status"] for r in stages.set_status(jobs, changes).collect()} == {"j1": "assigned", "j2": "pending"}
    for odd in ((jobs.union(jobs), changes), (jobs, changes.union(changes)), (jobs.filter("job_id = 'j1'"), changes)):
        with pytest.raises(review.GuardError, match="job_id"):
            stages.set_status(*odd)
    there = spark.createDataFrame([("e",)], "path string")
    assert stages.missing_evidence(h, there).count() == 0 and stages.missing_evidence(h, there.limit(0)).count() == 3
    assert stages.failed_gates("researched", {"initialized": [], "researched": ["x"], "extracted": ["y"]}) == ["researched: x"] and stages.failed_gates("initialized", {}) == ["initialized: not evaluated"]
    rich = spark.createDataFrame([("u", "t", "engine", ["c"], None, "ja", "s", "a", "r", "s", "high"), ("v", "t", "canon", ["c"], "", "", "s", "a", "r", "s", "high")], "url string, title string, lane string, claims array<string>, source_language string, language string, source_type string, authority string, retrieved_at string, scope string, confidence string")
    assert {r["item"] for r in stages.research_problems(rich).collect() if r["problem"] == "incomplete description"} == {"v"}
    src = spark.createDataFrame([("u", "t", "unpack", ["c"]), ("u2", "", "jp-canon", ["c"])], "url string, title string, lane string, claims array<string>")
    assert {(r["item"], r["problem"]) for r in stages.research_problems(src, rich=False).collect()} == {("target-locale", "missing lane"), ("u2", "needs url, title, lane and claims")}
    assert stages.release_problems(jobs, 0, {"roundtrip": True}, {"build": 1}) != []


def test_plan_gate(spark):
    source = spark.createDataFrame([(1, "a", "s1", "f", "t", "sha256:" + "0" * 64), (2, "b", "s2", "f", "t", "sha256:" + "1" * 64)], "ord long, id string, scene_id string, file string, text string, source_hash string")
    digest = D.source_digest(source.withColumn("k", F.lit(1)), ["k"]).first()["digest"]
    cols = "job_id string, plan_approved boolean, bible_version long, source_digest string, context_notes string, entry_ids array<string>, scene_ids array<string>, source_files array<string>, predecessors array<string>, adjacent_entry_ids array<string>"
    edges = spark.createDataFrame([("s2", "s3")], "src string, dst string")
    good = spark.createDataFrame([("j", True, 1, digest, "n", ["a", "b"], ["s1", "s2"], ["f"], [], [])], cols)
    assert stages.plan_problems(good, source, edges, 1).count() == 0
    bad = spark.createDataFrame([("j", False, 2, "sha256:0", " ", ["a", "q"], ["s1"], [], ["no"], ["b"])], cols)
    found = {r["problem"] for r in stages.plan_problems(bad, source, edges, 1).collect()}
    assert found == {"not approved", "stale bible_version", "source_digest differs", "no context_notes", "source_files must be non-empty strings", "unknown predecessor", "adjacent id not connected", "coverage mismatch"}


def test_context(spark):
    entries = spark.createDataFrame([("j", 0, "Mia meets Bo", "Mia", "r")], "job_id string, pos int, text string, speaker string, route string")
    s = context.scene_of(entries)
    people = spark.createDataFrame([("Mia", ["M"]), ("Bo", []), ("Zed", ["Zeddy"])], "name string, aliases array<string>")
    chosen = context.select_characters(s, people)
    assert {r["name"] for r in chosen.collect()} == {"Mia", "Bo"}
    voices = spark.createDataFrame([("M", "{1}"), ("Zed", "{2}"), ("narrator", "{0}")], "name string, voice string")
    assert {r["name"] for r in context.select_voices(s, chosen, people, voices).collect()} == {"M", "narrator"}
    assert context.select_route(s, spark.createDataFrame([("q", "{}")], "route string, knowledge string")).first()["knowledge"] == "{}"


def test_codepoints_and_probe(spark):
    texts = spark.createDataFrame([(1, "a", "f1", "ab<x>\u0000 🎉", ["<x>"]), (2, "b", "f2", "a", None)], "ord long, id string, location string, text string, protected_tokens array<string>")
    seen = codepoints.visible_texts(texts)
    got = {r["cp"]: r["n"] for r in codepoints.histogram(seen).collect()}
    assert got == {97: 2, 98: 1, 0x1F389: 1} == {r["cp"]: r["n"] for r in codepoints.histogram(seen, exact=True).collect()}
    cmap = spark.createDataFrame([(97,), (98,)], "cp int")
    assert [r["label"] for r in codepoints.uncovered(codepoints.histogram(seen), cmap).collect()] == ["U+1F389"]
    assert codepoints.coverage_report(codepoints.histogram(seen), cmap, cmap).first()["passed"] is False
    use = spark.createDataFrame([(0, 0, None), (1000, 800, 1000), (1000, 700, 1000)], "input_tokens long, cached_input_tokens long, expected_prefix_tokens long")
    assert [r["verdict"] for r in codepoints.cache_verdicts(use).collect()] == ["observed-only", "pass", "fail"]


def test_digests():
    a, b = D.snapshot_digest("x.json", '{"b": 1, "a": 2}'), D.snapshot_digest("x.json", '{"a":2,"b":1}')
    assert a == b and D.snapshot_digest("x.txt", "a\r\n") == D.snapshot_digest("x.txt", "a")
    assert D.prefix_text([("t", "text", "x")])[1] == D.prefix_text([("t", "text", "x\n")])[1]
    assert D.canonical_tsv('a\t"b"\r\nc\td\n\n') == "a\tb\nc\td\n"
    assert (D.relative_name("/p/x/y", "/p"), D.relative_name("/q/y", "/p"), D.relative_name("/q/y", "/p", name_only=True)) == ("x/y", "/q/y", "y")
    assert D.compact_json({"__l": 1, "a": "é"}, drop_internal=True) == '{"a":"é"}'


def test_digest_ignores_partitioning(spark, sf_dir):
    from textloom.plans import fixtures as fx

    u = fx.units(spark, sf_dir)
    one = {(r["route"], r["digest"]) for r in D.source_digest(u.repartition(1), ["route"]).collect()}
    assert one == {(r["route"], r["digest"]) for r in D.source_digest(u.repartition(16), ["route"]).collect()}


def test_streamed_statuses(spark, tmp_path):
    rows = [("j1", "2024-01-01 00:00:00", 1, "pending"), ("j1", "2024-01-01 00:00:01", 2, "assigned"), ("j2", "2024-01-01 00:00:00", 3, "what")]
    df = spark.createDataFrame(rows, "job_id string, ts string, seq long, status string").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = latest_statuses(stream).writeStream.outputMode("complete").format("memory").queryName("latest").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert [tuple(r) for r in spark.table("latest").collect()] == [("j1", "assigned", 2)] == [tuple(r) for r in latest_statuses(df).collect()]


def test_gates_across_artifacts(spark):
    jobs = spark.createDataFrame([("a", "assigned", "d1", 1, ["x", "y"]), ("b", "reviewed", "d2", 1, ["z"]), ("c", "pending", "d3", 1, ["w"])], "job_id string, status string, source_digest string, bible_version long, entry_ids array<string>")
    bundles = spark.createDataFrame([("a", True, "d1", 1, "p", "s", True), ("b", True, "old", 2, "q", "t", False)], "job_id string, valid boolean, source_digest string, bible_version long, shared_prefix_id string, shared_prefix_sha256 string, coverage_valid boolean")
    found = {(r["item"], r["problem"]) for r in stages.translation_problems(jobs, bundles, "p", "s").collect()}
    assert found == {("b", p) for p in ("stale source_digest", "stale bible_version", "another shared prefix", "stale shared prefix", "invalid coverage")}
    assert {r["problem"] for r in stages.translation_problems(jobs.filter("job_id = 'c'"), bundles, "p", "s").collect()} == {"no active job"}
    drafts = spark.createDataFrame([("b", 1, "z", '{"translation": "Z", "id": "z", "notes": "n"}')], "job_id string, ord long, id string, raw string")
    digest = "sha256:" + hashlib.sha256(b'{"id":"z","notes":"n","translation":"Z"}\n').hexdigest()  # of whole records
    reports = spark.createDataFrame([("b", True, "all-entries", "d2", 1, digest)], "job_id string, passed boolean, coverage string, reviewed_source_digest string, reviewed_entry_count int, reviewed_draft_digest string")
    found = {(r["item"], r["problem"]) for r in stages.review_problems(jobs, reports, drafts).collect()}
    assert found == {("a", "not reviewed"), ("c", "not reviewed"), ("a", "no valid review report"), ("c", "no valid review report")}


def test_documents_sections_and_extraction(spark):
    docs = spark.createDataFrame([("world", "# World\n\nA long enough description."), ("honorifics", "# Only a heading\n```\n")], "name string, content string")
    assert {r["item"] for r in stages.document_problems(docs, ["world", "honorifics", "language-profile"]).collect()} == {"honorifics", "language-profile"}
    _, _, sections = D.prefix_text([("world", "text", "x\r\n"), ("terms", "tsv", "a\tb")])
    recorded = spark.createDataFrame(list(sections.items()), "name string, digest string")
    now = spark.createDataFrame([("world", "changed")], "name string, content string")
    assert {(r["name"], r["issue"]) for r in D.integrity_issues(recorded, now).collect()} == {("world", "digest mismatch"), ("terms", "missing")}
    assert D.integrity_issues(recorded, spark.createDataFrame([("world", "x"), ("terms", "a\tb\n")], "name string, content string")).count() == 0
    source = spark.createDataFrame([(1, "a", "t", "sha256:0", "f", None), (None, "a", None, "sha256:" + "a" * 64, "", ["x"])], "ord long, id string, text string, source_hash string, file string, protected_tokens array<string>")
    found = {r["problem"] for r in stages.extraction_problems(source, spark.createDataFrame([], "id string")).collect()}
    assert found == {"id not unique", "invalid source_hash", "no text", "no file", "no order", "protected_tokens must be strings", "no scene nodes"}


def test_early_gates(spark):
    good = {"game_name": "g", "source_locale": "ja", "target_locale": "en"}
    assert stages.initialization_problems(good) == [] and stages.initialization_problems({"game_name": "g"}, 2) == []
    assert stages.initialization_problems({**good, "game_name": ""}) == stages.initialization_problems(None) == ["initialized: game_name is missing"]
    assert stages.initialization_problems({"game_name": "g", "source_locale": ""}) == ["initialized: source_locale is missing", "initialized: target_locale is missing"]
    assert stages.initialization_problems({**good, "target_locale": "JA"}) == ["initialized: source_locale and target_locale must be different"]
    docs = spark.createDataFrame([("unpack-notes", "Unpacked with the usual tool.")], "name string, content string")
    rows = [(lane, "t", lane, ["c"]) for lane in stages.REQUIRED_LANES]
    sources = spark.createDataFrame(rows, "url string, title string, lane string, claims array<string>")
    assert stages.research_gate({"file_count": 3}, sources, docs, 1) == []
    assert stages.research_gate({"file_count": 0}, sources.filter("lane <> 'canon'"), docs.limit(0), 1) == ["researched: manifest describes no file", "researched: canon: missing lane", "researched: unpack-notes: no meaningful content"]
    assert stages.research_gate(None, None, docs) == ["researched: manifest describes no file", "researched: sources are invalid"]
    assert stages.roundtrip_problems({"passed": True}, {"input": 1, "unpacked": 2, "repacked": 1}) == []
    assert stages.roundtrip_problems({"passed": 1}, {"input": 1, "repacked": 0}) == ["roundtrip-proven: report must have passed", "roundtrip-proven: folder unpacked is empty", "roundtrip-proven: folder repacked is empty"]
    assert stages.inventory_problems({"engines": ["kirikiri"]}) == [] and all(stages.inventory_problems(x) == ["extracted: no engine inventory"] for x in (None, {}, {"engines": []}, {"engines": "x"}))


def test_bible_gate(spark):
    docs = spark.createDataFrame([(n, "A long enough description.") for n in ("world", "honorifics", "language-profile")], "name string, content string")
    examples = spark.createDataFrame([("s",)], "source string")
    terms = spark.createDataFrame([("x",) * 8], ", ".join(f"{f} string" for f in stages.GLOSSARY_FIELDS))
    good = [{"frozen": True, "version": 1}, docs, {"characters": [{"id": "a"}]}, {"narrator": {"tone": "dry"}}, {}, examples, terms]
    assert stages.bible_problems(*good) == []
    bad = [
        (0, {"frozen": True, "version": 0}, "must be frozen at version >= 1"), (0, {"version": 2}, "must be frozen at version >= 1"), (0, None, "must be frozen at version >= 1"),
        (1, docs.filter("name <> 'language-profile'"), "language-profile: no meaningful content"), (2, {"characters": []}, "no characters"), (2, {"characters": ["a"]}, "no characters"), (2, None, "no characters"),
        (3, {}, "no voice definitions"), (3, {"narrator": "dry"}, "no voice definitions"), (4, {"routes": []}, "route knowledge is invalid"), (4, None, "route knowledge is invalid"),
        (5, examples.limit(0), "no approved calibration examples"), (5, None, "no approved calibration examples"), (6, terms.limit(0), "no terminology rows"), (6, terms.drop("notes"), "glossary lacks required columns"),
    ]
    for at, value, text in bad:
        assert stages.bible_problems(*good[:at], value, *good[at + 1 :]) == [f"bible-frozen: {text}"]
    assert stages.bible_problems(None, docs.limit(0), None, None, None, None, None, 2)[-2:] == ["bible-frozen: honorifics: no meaningful content", "bible-frozen: world: no meaningful content"]


def test_record_digest_and_views(spark):
    raw = spark.createDataFrame([(1, '{"b": 1, "a": "é", "__line__": 3}'), (2, '{"a": 2}')], "ord long, raw string").withColumn("k", F.lit(0))
    other = spark.createDataFrame([(5, '{"a":"é","b":1}'), (9, '{"a": 2, "__line__": 9}')], "ord long, raw string").withColumn("k", F.lit(0))
    assert D.record_digest(raw, ["k"]).first()["digest"] == D.record_digest(other, ["k"]).first()["digest"]
    rows = spark.createDataFrame([(1, "a", None, "line", None)], "ord long, id string, kind string, type string, __line__ int")
    assert context.model_view(rows).first()["kind"] == "line" and context.without_internal(rows).columns == ["ord", "id", "kind", "type"]


def test_spaces_case_and_words(spark):
    df = spark.createDataFrame([("　 x \u001f",), ("ß",), ("",)], "t string")
    assert [r[0] for r in df.select(X.strip(F.col("t"))).collect()] == ["x", "ß", ""]
    assert [r[0] for r in df.select(X.casefolded("t")).collect()][1] == "ss"
    assert [r[0] for r in df.select(X.slug(F.col("t"))).collect()] == ["x", "ß", "scene"]
    assert codepoints.usage_problems(spark.createDataFrame([(1, 2, 0, 1), (2, 1, 0, 1), (1, 0, 0, 0)], "input_tokens long, cached_input_tokens long, output_tokens long, calls long")).count() == 2


def test_both_sides_meet_in_one_exchange(spark):
    """A whole validation reads each side once and deals rows out by id once."""
    import re

    source = spark.createDataFrame([(i, f"e{i}", f"text {i}") for i in range(50)], "ord long, id string, text string")
    draft = spark.createDataFrame([(i, f"e{i}", f"out {i}") for i in range(50)], "ord long, id string, translation string")
    issues = validate.validate(source, draft, Policy("en", "fr"))
    issues.collect()
    plan = issues._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert sum("Exchange hashpartitioning(_key" in line and "ReusedExchange" not in line for line in plan.splitlines()) == 1 and len(re.findall("Scan ExistingRDD", plan)) == 2


def test_structural_issues_of_every_kind(spark):
    source = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "a", "z"), (4, None, "n"), (5, "", "n"), (6, "c", "w"), (7, "a", "z")], "ord long, id string, text string")
    draft = spark.createDataFrame([(1, "b", "B"), (2, "a", "A1"), (3, "q", "Q"), (4, "q", "Q"), (5, None, "N"), (6, "a", "A2")], "ord long, id string, translation string")
    got = Counter((r["code"], r["id"]) for r in validate.structural_issues(validate.identified(source, draft)).collect())
    assert got == Counter({("duplicate-source-id", "a"): 2, ("source-id", None): 1, ("source-id", ""): 1, ("missing-ids", "c"): 1, ("extra-ids", "q"): 1, ("duplicate-target-id", "q"): 1, ("target-id", None): 1, ("duplicate-target-id", "a"): 1})
    pairs = {r["id"]: (r["ord"], r["s"]["text"], r["t"]["translation"]) for r in validate.matched(source, draft).collect()}
    assert pairs == {"a": (1, "z", "A2"), "b": (2, "y", "B")}
    assert "missing-ids" not in {r["code"] for r in validate.validate(source, draft, Policy("en", "fr"), allow_subset=True).collect()}
