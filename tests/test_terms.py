"""Terms against plain loops over all terms and texts."""

import random
import re

import pyarrow as pa
import pytest

from textloom.operators import automaton, context, glossary
from textloom.policy import Policy

FIELDS = "source string, target string, source_locale string, target_locale string, status string, scope string, match_mode string, case_sensitive string"
LETTERS = ["a", "b", "A", "B", "ß", "ss", "SS", "İ", "ı", "i", "I", "σ", "ς", "Σ", " ", " ", "_", "1", "é", "é", "é", "ǆ", "ﬁ", "fi"]


def plain_match(text, term, mode, cased):
    if not term:
        return False
    flags = 0 if cased else re.IGNORECASE
    if mode == "regex":
        try:
            return bool(re.search(term, text, flags))
        except re.error:
            return False
    if mode == "word":
        return bool(re.search(rf"(?<!\w){re.escape(term)}(?!\w)", text, flags))
    return term in text if cased else term.casefold() in text.casefold()


def plain_issues(rows, terms):
    out = []
    for key, src, text, places in rows:
        if not text:
            continue
        live = [t for t in terms if t[2].strip().casefold() in ("", "en") and t[3].strip().casefold() in ("", "fr") and (t[5].strip() in ("", "global") or t[5].strip() in places)]
        for s, d, _, _, status, _, mode, cased in live:
            s, d, status, mode, cased = s.strip(), d.strip(), status.strip().lower(), mode.strip().casefold(), cased.strip().casefold() in ("1", "true", "yes", "on")
            if status == "forbidden" and plain_match(text, d, mode, cased):
                out.append((key, "forbidden-term", s, d))
            if s and d and status in ("locked", "preferred") and plain_match(src, s, mode, cased) and not plain_match(text, d, mode, cased):
                longer = [(o[0].strip(), o[1].strip()) for o in live]
                if not any(len(x) > len(s) and s in x and x in src and y and y in text for x, y in longer):
                    out.append((key, f"{status}-term", s, d))
    return sorted(out)


@pytest.mark.parametrize(("seed", "block"), [(1, 1000), (2, 7), (3, 1000)])
def test_issues_equal_loops(spark, seed, block, monkeypatch):
    rng = random.Random(seed)
    some = lambda n: "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, n)))
    pattern = lambda: rng.choice(["a+", "(", "[ab]\\b", "(?<!a*)b", "i", "(?P<x>a)(?P=x)", "s{2}", ""])
    terms = []
    for _ in range(60):
        mode = rng.choice(["", "word", " Word ", "regex", "other"])
        pick = pattern if mode == "regex" else lambda: some(4)
        terms.append((f" {pick()}", pick(), rng.choice(["", "EN ", "ja"]), rng.choice(["", "fr", "de"]), rng.choice(["locked", " Preferred", "forbidden", "proposed"]), rng.choice(["", "", "global", "r1", "s2", "who"]), mode, rng.choice(["", "yes", "on", "y", "TRUE", "0"])))
    rows = [(f"e{i}", some(30), some(30), {rng.choice(["r1", "r2"]), rng.choice(["s1", "s2"]), rng.choice(["who", ""])} - {""}) for i in range(150)]
    entries = [(k, (s, next((p for p in where if p[0] == "r"), None), next((p for p in where if p[0] == "s"), None), "who" if "who" in where else None), (t,)) for k, s, t, where in rows]
    pairs = spark.createDataFrame(entries, "id string, s struct<text:string, route:string, scene_id:string, speaker:string>, t struct<translation:string>").repartition(3)
    monkeypatch.setattr(glossary.term_hits, "__defaults__", (block,))
    got = glossary.term_issues(pairs, spark.createDataFrame(terms, FIELDS), Policy("en", "fr"))
    assert sorted(tuple(r) for r in got.collect()) == plain_issues(rows, terms)


def test_words_in_texts(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(20)]
    texts = [(i, "".join(rng.choice("abc ") for _ in range(rng.randint(0, 12))), "x") for i in range(100)] + [(200, None, "x")]
    df, ws = spark.createDataFrame(texts, "k long, t string, word_count string"), spark.createDataFrame([(w,) for w in [*words, "", None]], "word string")
    want = sorted((i, x, w) for i, t, x in texts if t for w in set(words) if w in t)
    for most in (1000, 3):
        got = automaton.occurring(df, "t", ws, most)
        assert got.columns == ["k", "word_count", "word"] and sorted(tuple(r) for r in got.collect()) == want
    assert automaton.occurring(df, "t", ws.limit(0)).count() == 0


def test_too_large_a_glossary_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(automaton, "MOST_BYTES", 5)
    with pytest.raises(ValueError, match="glossary: 6 bytes"):
        glossary.prepared(spark.createDataFrame([("abc", "def")], "source string, target string"), Policy("en", "fr"))


def test_calibration_keeps_the_first_of_all(spark):
    """Each job gets the smallest places over its speakers and terms, however many a single term has."""
    rng = random.Random(6)
    examples = [(i, "".join(rng.choice("abcdef") for _ in range(6)), rng.choice(["p", "q", ""])) for i in range(200)]
    jobs = {"j1": (["a", "bc"], ["p"]), "j2": (["de"], []), "j3": ([], ["q", "zz"])}
    scenes = spark.createDataFrame([(j, s) for j, (_, s) in jobs.items()], "job_id string, speakers array<string>")
    terms = spark.createDataFrame([(j, t) for j, (ts, _) in jobs.items() for t in ts], "job_id string, source string")
    got = context.select_calibration(scenes, terms, spark.createDataFrame(examples, "ord long, source string, speaker string"), limit=9)
    want = {(j, i) for j, (ts, ss) in jobs.items() for i in [i for i, t, s in examples if s in ss or any(x in t for x in ts)][:9]}
    assert {tuple(r) for r in got.collect()} == want


def test_terms_in_texts_with_odd_letters():
    """Words with and without gaps, a mark that a pattern takes for iota, letters that fold to more of them."""
    rng = random.Random(7)
    letters = [*LETTERS, "ͅ", "ι", "ι", "Ⓐ", "ⓐ", "ẞ", "-"]
    some = lambda n: "".join(rng.choice(letters) for _ in range(rng.randint(1, n)))
    pattern = lambda: rng.choice(["{}(?!\\w)", "(?P<x>{})\\b", "(?<!x){}.", "a?{}", "(?i){}", "(?i:{})b", "{}|b", "({})+", "{}\\s*{}", "^{}", "(?:{}(?=b))"])
    terms = [(pattern().replace("{}", re.escape(some(2))) if mode == "regex" else some(3), mode, cased) for mode in ("word", "regex", "substring") for cased in (True, False) for _ in range(60)]
    side = glossary.Side([{"source": w, "mode": m, "cased": c} for w, m, c in terms], "source", range(len(terms)), set(range(0, len(terms), 2)))
    for text in (some(25) for _ in range(1500)):
        assert side.find(text, side.written(text)) == {n for n, t in enumerate(terms) if plain_match(text, *t)}
        assert {n for n in side.written(text) if n % 2 == 0} == {n for n, t in enumerate(terms) if n % 2 == 0 and t[0] in text}


def test_patterns_are_tried_where_their_letters_are():
    known = {"(?P<x>Word)(?!\\w)": ("Word", True), "\\bab(c)d": ("abcd", True), "a?bc": ("bc", False), "ab|cd": ("", False), "(?i)ab": ("", False), "(?<=x)yz+": ("y", True), "(": ("", False), "a{2}bcd": ("bcd", False)}
    assert {p: glossary.needed(p, True) for p in known} == known
    terms = [{"source": p, "mode": "regex", "cased": False} for p in known if known[p][0]]
    assert glossary.Side(terms, "source", range(len(terms))).patterns == []


def test_frequent_words_of_jobs_stay_where_the_jobs_are(spark):
    """No task gets all jobs that have a word: neither terms nor examples meet scenes by an exchange on the word."""
    scenes = spark.createDataFrame([(f"j{i}", "the end", ["p"]) for i in range(30)], "job_id string, scene_text string, speakers array<string>")
    names = spark.createDataFrame([("the", "p"), ("end", "")], "source string, target string")
    examples = spark.createDataFrame([(i, "the end", "p") for i in range(9)], "ord long, source string, speaker string")
    terms = context.select_terms(scenes, names)
    got = context.select_calibration(scenes, terms, examples, limit=3)
    assert sorted(tuple(r) for r in got.collect()) == sorted((f"j{i}", n) for i in range(30) for n in range(3))
    for df in (terms, got):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(word" not in plan and "hashpartitioning(target" not in plan and "SortMergeJoin" not in plan


def test_large_batches_are_taken_in_pieces():
    """What a worker makes of a batch doesn't grow with the batch: hits come out piece by piece."""
    pairs = [(str(i), "word " * 200, "wort " * 200) for i in range(3000)]
    columns = [pa.array(c) for c in zip(*pairs)] + [pa.nulls(3000, pa.string())] * 3
    batch = pa.RecordBatch.from_arrays(columns, names=["id", "src", "out", "route", "scene_id", "speaker"])
    terms = [{"source": "word", "target": "wort", "status": "locked", "scope": "", "mode": "substring", "cased": True}]
    got = list(glossary.block_hits(terms, True)([batch]))
    assert [k for b in got for k in b.column(0).to_pylist() if k] == [k for k, *_ in pairs for _ in range(2)]  # the hit, and the term as a rival
    assert len(got) >= 5 and max(b.num_rows for b in got) <= 1200


def test_long_rows_that_stand_together_are_no_large_piece():
    """Pieces are cut by their rows' own bytes: many short texts don't make a piece of the long ones large."""
    texts = ["x"] * 9000 + ["word " * 40_000] * 50 + [None, "é" * (3 << 20)] + ["x"] * 900
    columns = [pa.array(range(len(texts)), pa.int64()), pa.array(texts), pa.nulls(len(texts), pa.string()), pa.array([["a"]] * len(texts))]
    batch = pa.RecordBatch.from_arrays(columns, names=["n", "src", "out", "more"])
    for whole in (batch, batch.slice(7000, 2500), batch.slice(0, 0), batch.select(["n"])):
        got = list(automaton.pieces(whole))
        assert [k for b in got for k in b.column(0).to_pylist()] == whole.column(0).to_pylist()
        assert max((b.nbytes for b in got if b.num_rows > 1), default=0) <= 1.1 * (1 << 20)
        assert len(got) <= 20 + whole.nbytes // (1 << 19)


def test_long_words_are_forgotten():
    """The words that a worker knows are bounded by their letters, too."""
    side = glossary.Side([{"source": "end", "mode": "word", "cased": True}], "source", [0])
    for n in range(100):
        assert side.find(f"{n}{'x' * 300_000} end", set()) == {0}
        assert sum(map(len, side.seen)) <= 5_000_000
