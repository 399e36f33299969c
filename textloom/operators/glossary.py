"""Terms in texts: scope and locale filters, match modes, shadowing by longer terms, required translations.

A glossary goes along with tasks in blocks. Automata over a block's terms, as they are and folded, find
in one reading of a text the substrings that stand there; whole words are looked up among the text's own
words. Patterns and words with gaps are tried where the letters that they need were found, so only patterns
without such letters are tried on each text. Shadowing is tested only for the terms that were found.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Set
from functools import reduce
from re import _parser as re_parser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators.automaton import BLOCK_WORDS, Automaton, blocks_of, checked_rows, pieces
from textloom.policy import Policy

# What counts as yes in a glossary.
YES = ("1", "true", "yes", "on")
#: Letters whose folding depends on the language; a pattern without case takes them for one another.
DOTS = "İı"
#: What a whole word without gaps is among a text's letters. The one mark that isn't part of a word, but that a
#: pattern without case takes for a letter (iota).
RUN, IOTA = re.compile(r"\w+"), "\u0345"
#: So many words of texts, and so many letters of them, are kept with the terms that they are; then they are forgotten.
MOST_KNOWN, MOST_LETTERS = 100_000, 4_000_000
HITS = "id string, source string, target string, status string, found boolean, translated boolean, shadowed boolean, rivals array<string>"


def loosened(text: str) -> str:
    """Folded so that texts which match without case hold each other, also by the ways patterns have with i."""
    for letter in DOTS:
        text = text.replace(letter, "i")
    return text.casefold()


def compiled(pattern: str, cased: bool) -> re.Pattern | None:
    """None for what isn't a pattern; such a term matches nothing."""
    try:
        return re.compile(pattern, 0 if cased else re.IGNORECASE)
    except (re.error, OverflowError, RecursionError):
        return None


def prepared(glossary: DataFrame, policy: Policy) -> list[dict]:
    """The rows for the policy's locales as plain values, stripped and in lower case where that is meant."""
    have = glossary.columns
    names = [c for c in ("source", "target", "status", "scope", "match_mode", "case_sensitive", "source_locale", "target_locale") if c in have]
    locale = {"source_locale": policy.source_locale.casefold(), "target_locale": policy.target_locale.casefold()}
    out = []
    for row in checked_rows(glossary.select(*names), "glossary"):
        get = {name: (row[name] if name in names else "") or "" for name in ("source", "target", "status", "scope", "match_mode", "case_sensitive", *locale)}
        get = {name: str(value).strip(X.SPACES) for name, value in get.items()}
        if policy.filter_locales and any(get[side].casefold() not in ("", tag) for side, tag in locale.items()):
            continue
        mode = get["match_mode"].casefold() if policy.term_modes else "substring"
        cased = not policy.term_modes or get["case_sensitive"].casefold() in YES
        out.append({"source": get["source"], "target": get["target"], "status": get["status"].lower(), "scope": get["scope"], "mode": mode if mode in ("word", "regex") else "substring", "cased": cased})
    return out


def needed(pattern: str, cased: bool) -> tuple[str, bool]:
    """Letters that stand in whatever a pattern matches, together and in that order ("" where none are known),
    and whether a match begins with them."""
    best, run, first = ("", False), "", True
    try:
        parsed = re_parser.parse(pattern, 0 if cased else re.IGNORECASE)
        if parsed.state.flags & (re.ASCII | re.LOCALE | re.VERBOSE) or cased and parsed.state.flags & re.IGNORECASE:
            return "", False  # flags of its own
        todo = list(parsed)[::-1]
        while todo:
            kind, value = todo.pop()
            if kind is re_parser.LITERAL:
                run += chr(value)
            elif kind is re_parser.SUBPATTERN and not value[1] and not value[2]:
                todo += list(value[3])[::-1]
            elif kind not in (re_parser.AT, re_parser.ASSERT, re_parser.ASSERT_NOT):  # those take no letters
                run, first = "", False
            if len(run) > len(best[0]):
                best = run, first
    except (re.error, OverflowError, RecursionError):
        return "", False
    return best


class Side:
    """One column of terms, sources or targets, to be found in texts."""

    def __init__(self, terms: list[dict], name: str, wanted: Iterable[int], literal: Set[int] = frozenset()):
        """wanted: the numbers of the terms that find() looks for; literal: those of them that written() looks for, too."""
        self.terms, self.name = terms, name
        words = [(n, t, t[name]) for n in wanted if (t := terms[n])[name]]
        # substrings are settled by an automaton, words without gaps by looking up the text's words
        self.plain = {n for n, t, _ in words if t["mode"] == "substring" and t["cased"]}
        self.letters = Automaton((w, n) for n, t, w in words if n in self.plain or n in literal)
        self.folded = Automaton((w.casefold(), n) for n, t, w in words if t["mode"] == "substring" and not t["cased"])
        whole = {n for n, t, w in words if t["mode"] == "word" and RUN.fullmatch(w)}
        self.whole: dict[str, list[int]] = {}
        for n in whole:
            self.whole.setdefault(loosened(terms[n][name]), []).append(n)
        self.joined = [n for n in whole if not terms[n]["cased"]]
        self.seen: set[str] = set()
        self.letters_seen = 0
        self.are: dict[str, list[int]] = {}
        # the rest is tested where its letters are; patterns without such letters are tried on each text
        rest = [(n, t["cased"], *(needed(w, t["cased"]) if t["mode"] == "regex" else (w, True))) for n, t, w in words if t["mode"] != "substring" and n not in whole]
        self.patterns = [n for n, _, w, _ in rest if not w]
        self.maybe = Automaton((w, n) for n, cased, w, _ in rest if cased)
        self.maybe_folded = Automaton((loosened(w), n) for n, cased, w, _ in rest if not cased)
        self.begin = {n: w if cased else loosened(w) for n, cased, w, first in rest if first}
        self.word: dict[int, re.Pattern] = {}

    def pattern(self, n: int) -> re.Pattern | None:
        if n not in self.word:
            t = self.terms[n]
            self.word[n] = compiled(t[self.name] if t["mode"] == "regex" else rf"(?<!\w){re.escape(t[self.name])}(?!\w)", t["cased"])
        return self.word[n]

    def stands(self, n: int, text: str, low: str = "") -> bool:
        """Whether a term that is no substring matches: as a whole word or as a pattern.

        low is the text as the term's letters are looked for in it.
        """
        if (p := self.pattern(n)) is None:
            return False
        if n not in self.begin or len(low) != len(text):
            return p.search(text) is not None
        at = low.find(self.begin[n])
        while at >= 0 and not p.match(text, at):
            at = low.find(self.begin[n], at + 1)
        return at >= 0

    def words_of(self, text: str) -> set[int]:
        """The numbers of the words without gaps that stand in a text as a whole."""
        runs = set(RUN.findall(text))
        if new := list(runs - self.seen):
            if len(self.seen) > MOST_KNOWN or self.letters_seen > MOST_LETTERS:
                self.seen.clear()
                self.are.clear()
                self.letters_seen = 0
                new = list(runs)
            for run, low in zip(new, loosened("\n".join(new)).split("\n"), strict=True):
                if low in self.whole and (numbers := [n for n in self.whole[low] if self.pattern(n).fullmatch(run)]):
                    self.are[run] = numbers
            self.seen.update(new)
            self.letters_seen += sum(map(len, new))
        return {n for run in runs if run in self.are for n in self.are[run]}

    def written(self, text: str) -> set[int]:
        """The numbers of the literal terms, and of substrings with case, that stand in a text letter by letter."""
        return self.letters.found(text)

    def find(self, text: str, written: set[int]) -> set[int]:
        """The numbers of the wanted terms that match; written are those of the text.

        Substrings match by full case folding where case doesn't count, words and patterns letter by letter.
        """
        hits = (written & self.plain) | {n for n in self.patterns if self.stands(n, text)}
        if self.folded.machine is not None:
            hits |= self.folded.found(text.casefold())
        if self.whole:
            hits |= self.words_of(text)
            if IOTA in text:
                hits.update(n for n in self.joined if n not in hits and self.stands(n, text))
        if self.maybe.machine is not None:
            hits.update(n for n in self.maybe.found(text) if self.stands(n, text, text))
        if self.maybe_folded.machine is not None:
            low = loosened(text)
            hits.update(n for n in self.maybe_folded.found(low) if self.stands(n, text, low))
        return hits


def in_scope(term: dict, scopes: set[str]) -> bool:
    return term["scope"] in ("", "global") or term["scope"] in scopes


def block_hits(terms: list[dict], translations: bool):
    """What a pass over entries (id, src, out, route, scene_id, speaker) finds of a block of terms, in HITS.

    rivals are all sources of the block that can shadow others in the entry; entries that have some
    also get a row without a term for them. Without translations, terms are looked for in src only.
    """

    def run(batches):
        every = range(len(terms))
        rivalling = {n for n in every if terms[n]["source"] and terms[n]["target"]}  # shadowing goes by letters, whatever the mode
        sources, targets = Side(terms, "source", every, rivalling), Side(terms, "target", every)
        kept = [pa.array([t[name] for t in terms], pa.string()) for name in ("source", "target", "status")]
        for batch in (p for b in batches for p in pieces(b)):
            own, numbers, found, translated, shadowed, rivals = [], [], [], [], [], []
            for i, (src, out, *places) in enumerate(zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)):
                scopes = {p for p in places if p}
                written = sources.written(src)
                hits = live = {n for n in sources.find(src, written) if in_scope(terms[n], scopes)}
                there = targets.find(out, targets.written(out)) if translations else set()
                if there:
                    hits = live | {n for n in there if terms[n]["status"] == "forbidden" and in_scope(terms[n], scopes)}
                others = sorted({terms[n]["source"] for n in written & rivalling if in_scope(terms[n], scopes) and terms[n]["target"] in out})
                for n in sorted(hits):
                    numbers.append(n)
                    found.append(n in live)
                    translated.append(n in there)
                    source = terms[n]["source"]
                    shadowed.append(bool(others and source) and any(len(r) > len(source) and source in r for r in others))
                own += [i] * len(hits)
                rivals += [None] * len(hits)
                if others:
                    own.append(i)
                    rivals.append(others)
                    for column, value in ((numbers, None), (found, False), (translated, False), (shadowed, False)):
                        column.append(value)
            term = pa.array(numbers, pa.int64())
            columns = [batch.column(0).take(pa.array(own, pa.int64())), *(c.take(term) for c in kept), *(pa.array(c, pa.bool_()) for c in (found, translated, shadowed)), pa.array(rivals, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in HITS.split(", ")])

    return run


def term_hits(entries: DataFrame, terms: list[dict], block: int = BLOCK_WORDS, *, translations: bool = True) -> DataFrame:
    """id, source, target, status, found, translated, shadowed: each applicable term whose source stands in
    the entry (found), or which is forbidden and stands in its translation (translated).

    Without translations only terms that are found are given, and translated is left out.
    """
    rows = entries.select(F.col("id").cast("string").alias("id"), F.coalesce("src", F.lit("")).alias("src"), F.coalesce("out", F.lit("")).alias("out"), *(F.col(c).cast("string").alias(c) for c in ("route", "scene_id", "speaker")))
    blocks = blocks_of(terms, lambda t: len(t["source"].encode()) + len(t["target"].encode()), block)
    hits = reduce(DataFrame.unionAll, [rows.mapInArrow(block_hits(b, translations), HITS) for b in blocks])
    out = ["id", "source", "target", "status", "found", *(["translated"] if translations else []), "shadowed"]
    named = hits.filter(F.col("source").isNotNull())
    if len(blocks) == 1:
        return named.select(*out)
    # a longer term may be in another block: those that occur in an entry come together
    rivals = hits.filter(F.col("source").isNull()).groupBy("id").agg(F.flatten(F.collect_list("rivals")).alias("others"))
    longer = F.exists("others", lambda r: (F.length(r) > F.length("source")) & F.contains(r, F.col("source")))
    return named.join(rivals, "id", "left").withColumn("shadowed", (F.col("source") != "") & F.coalesce(longer, F.lit(False))).select(*out)


def entries_of(pairs: DataFrame) -> DataFrame:
    have = pairs.schema["s"].dataType.names
    get = lambda name: F.col(f"s.{name}").cast("string") if name in have else F.lit(None).cast("string")
    rows = pairs.select("id", F.coalesce(F.col("s.text"), F.lit("")).alias("src"), F.col("t.translation").alias("out"), get("route").alias("route"), get("scene_id").alias("scene_id"), get("speaker").alias("speaker"))
    return rows.filter(F.coalesce("out", F.lit("")) != "")


def term_issues(pairs: DataFrame, glossary: DataFrame, policy: Policy) -> DataFrame:
    """id, code, source, target: forbidden terms that appear; locked and preferred ones that don't."""
    hits = term_hits(entries_of(pairs), prepared(glossary, policy))
    due = F.col("found") & (F.col("target") != "") & ~F.col("shadowed") & ~F.col("translated")
    status = F.col("status")
    code = F.when((status == "forbidden") & F.col("translated"), "forbidden-term").when((status == "locked") & due, "locked-term").when((status == "preferred") & due, "preferred-term")
    return hits.select("id", code.alias("code"), "source", "target").filter("code is not null")


def shadowed_hits(pairs: DataFrame, glossary: DataFrame, policy: Policy) -> DataFrame:
    """id, source, shadowed: each term found in a source text."""
    return term_hits(entries_of(pairs), prepared(glossary, policy), translations=False).filter("found").select("id", "source", "shadowed")
