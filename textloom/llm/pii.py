"""Personal data by weak supervision, with DataFrame functions only.

Regular expressions propose candidate spans. Labelers vote on each: its strict format, a gazetteer
(top-level domains, issuer digits, country codes, network ranges, key names), the words before it and
its shape. The votes' patterns are counted over the whole corpus; expectation-maximisation over this
small table estimates each labeler's reliability. A logistic span classifier is trained on its
posteriors and compiled into a column expression; besides the votes it sees what no labeler looks at:
the signs beside the span, the words before and after it, its length, and its place in the text. Spans
of strict format always stay; candidates that the classifier accepts are added.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, table, text_or_empty

KINDS = ["email", "ip", "card", "phone", "secret"]
LABELERS = ["format", "gazetteer", "context", "shape"]
#: What the classifier sees besides the votes, and how many values each has.
FEATURES = {"sign_before": 6, "sign_after": 6, "word_before": 9, "word_after": 9, "length": 4, "place": 3}

# Matches are the plain patterns' leftmost ones. A match can begin only at the start of a run of its
# first class or where the match before ended, which \G and the look-behind say; possessive loops
# keep the matcher from recursing or turning back where it never helps.
LOCAL = r"[A-Za-z0-9._%+-]"
CANDIDATES = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "secret": r'(?<![A-Za-z0-9+/_-])(?:AKIA[0-9A-Z]{16}(?![0-9A-Za-z])|(?<=(?i:token|password|passwd|secret|key)["]? {0,2}[=:] {0,2}["\']?)[A-Za-z0-9+/_-]{8,}+)',
}
PHONE_HEAD = r"^\+[0-9](?:[ ().-]*[0-9]){9,14}(?![0-9])"
GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]", "phone": r"\+[0-9]", "secret": r"AKIA|(?i:token|password|passwd|secret|key)[\"]? {0,2}[=:]"}
CUES = {
    "email": "mail|contact|write|an:|de:|para:", "ip": "ip|host|server|addr|from", "card": "card|visa|carte|karte|tarjeta|credit|pay|iban", "phone": "phone|tel|call|fax|mobile|fon", "secret": "token|password|passwd|secret|key",
}


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(c: Column) -> Column:
    """Whether a string of digits passes the check; written for the few digits of a card."""
    n = F.length(c)
    at = lambda i: F.ascii(F.substr(c, n - i, F.lit(1))) - 48
    double = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + F.when(i % 2 == 1, double(at(i))).otherwise(at(i)))
    return total % 10 == 0


def strict(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}")
    if kind == "card":
        d = digits(m)
        return F.when(F.length(d).between(14, 19), luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(m)).between(10, 15)
    if kind == "secret":
        return m.rlike(r"^AKIA[0-9A-Z]{16}$|^[0-9a-f]{16,}$")
    return F.lit(True)


def vote(yes: Column, no: Column) -> Column:
    """1 for, -1 against, 0 to abstain."""
    return F.when(yes, 1).when(no, -1).otherwise(0)


def votes(kind: str, m: Column, before: Column, good: Column) -> list[Column]:
    d = digits(m)
    never = F.lit(False)
    gazetteer = {
        "email": vote(m.rlike(r"(?i)\.(?:com|org|net|edu|gov|io|info|eu|de|fr|es|it|uk|us)$"), m.rlike(r"\.[0-9]+$")),
        "ip": vote(m.rlike(r"^(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\."), m.rlike(r"^0+\.|^(?:22[4-9]|2[3-9][0-9]|[3-9][0-9]{2})\.")),
        "card": vote(d.rlike("^[3-6]"), d.rlike("^[01]")),
        "phone": vote(m.rlike(r"^\+(?:1|33|34|44|49|39|41|43)(?![0-9]{14})"), m.rlike(r"^\+0")),
        "secret": vote(F.lower(before).rlike("(?:token|password|passwd|secret|key)[\"]? {0,2}[=:] {0,2}[\"']?$"), never),
    }[kind]
    shape = {
        "email": vote(F.length(m).between(6, 80), F.length(m) > 254),
        "ip": vote(m.rlike(r"^[1-9][0-9]{0,2}(?:\.(?:0|[1-9][0-9]{0,2})){3}$"), m.rlike(r"(?:^|\.)0[0-9]|[0-9]{4}")),
        "card": vote(F.length(d).isin(15, 16), ~F.length(d).between(13, 19) | d.rlike(r"^([0-9])\1*$")),
        "phone": vote(F.length(d).between(10, 13) & m.rlike("[ ()-]"), ~F.length(d).between(8, 15)),
        "secret": vote(m.rlike("[0-9]") & m.rlike("[A-Za-z]") & (F.length(m) >= 16), ~m.rlike("[0-9]")),
    }[kind]
    return [F.when(good, 1).otherwise(-1), gazetteer, vote(F.lower(before).rlike(CUES[kind]), never), shape]


def sign(c: Column) -> Column:
    """0: the text's edge, 1: white space, 2: letter, 3: digit, 4: quote or bracket, 5: another sign."""
    return (
        F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike("[A-Za-z]|[^\\x00-\\x7f]"), 2).when(c.rlike("[0-9]"), 3).when(c.rlike("[\"'`()\\[\\]{}<>]"), 4).otherwise(5)
    )


def word(c: Column) -> Column:
    """One of 8 numbers for a word, 8 for none."""
    return F.when(c == "", 8).otherwise(F.pmod(F.xxhash64(F.lower(c)), F.lit(8))).cast("int")


def candidate(no: int, kind: str, x: Column) -> Column:
    """A candidate from its match m, the texts around it (p up to the match before, a to the next one), its
    place s, and the text's length n, which each match brings along, as counting it costs the whole text."""
    m, length = x["m"], x["n"]
    good = strict(kind, m)
    if kind == "phone":  # a match that runs on into other numbers is weighed by what may be a number's digits
        m = F.when(good, m).otherwise(F.coalesce(F.nullif(F.regexp_extract(m, PHONE_HEAD, 0), F.lit("")), m))
    before, after, size = F.right(x["p"], F.lit(24)), F.left(x["a"], F.lit(24)), F.length(m)
    features = [
        sign(F.right(before, F.lit(1))), sign(F.left(after, F.lit(1))), word(F.regexp_extract(before, "([A-Za-z]+)[^A-Za-z]*$", 1)), word(F.regexp_extract(after, "^[^A-Za-z]*([A-Za-z]+)", 1)),
        F.when(size < 8, 0).when(size < 16, 1).when(size < 32, 2).otherwise(3), F.when(x["s"] * 10 < length, 0).when((x["s"] + size) * 10 > length * 9, 2).otherwise(1),
    ]
    return F.struct(
        x["s"].alias("start"), F.lit(no).alias("kind_no"), (x["s"] + size).alias("end"), (good if kind != "secret" else F.lit(False)).alias("base"),
        F.array(*votes(kind, m, before, strict(kind, m) if kind == "phone" else good)).alias("votes"), F.array(*features).alias("features"),
    )


def match_starts(pairs: Column, step: int = 512) -> Column:
    """Where matches begin, from pairs of the text before each and the match itself: sums, by blocks, as
    an array grows by copying."""
    none = F.array().cast("array<int>")

    def within(acc, x):
        at = acc["at"] + F.length(x["p"])
        return F.struct((at + F.length(x["m"])).alias("at"), F.concat(acc["starts"], F.array(at)).alias("starts"))

    def block(acc, b):
        zero = F.struct(F.element_at(acc, -1)["at"].alias("at"), none.alias("starts"))
        return F.concat(acc, F.array(F.aggregate(F.slice(pairs, b * step + 1, F.lit(step)), zero, within)))

    first = F.array(F.struct(F.lit(0).alias("at"), none.alias("starts")))
    blocks = F.aggregate(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / step).cast("int")), first, block)
    return F.flatten(F.transform(blocks, lambda x: x["starts"]))


def with_candidates(docs: DataFrame, text: str, out: str) -> DataFrame:
    """Adds an array of candidates (start, kind_no, end, base, votes, features) in order of start and kind."""
    have = docs.columns
    found = docs
    for kind in KINDS:
        some = F.contains(F.col(text), F.lit(GUARDS[kind])) if kind == "email" else F.col(text).rlike(GUARDS[kind])
        found = found.withColumn(f"_some_{kind}", some)
    for kind in KINDS:
        none = F.array().cast("array<string>")
        found = found.withColumn(f"_m_{kind}", F.when(F.col(f"_some_{kind}"), F.regexp_extract_all(F.col(text), F.lit(CANDIDATES[kind]), F.lit(0))).otherwise(none))
    for kind in KINDS:
        m = F.col(f"_m_{kind}")
        found = found.withColumn(f"_p_{kind}", F.when(F.size(m) > 0, F.split(F.col(text), CANDIDATES[kind], -1)).otherwise(F.array().cast("array<string>")))
    for kind in KINDS:
        m, p = F.col(f"_m_{kind}"), F.col(f"_p_{kind}")
        pairs = F.arrays_zip(m.alias("m"), F.slice(p, 1, F.size(m)).alias("p"))
        found = found.withColumn(f"_s_{kind}", F.when(F.size(m) > 0, match_starts(pairs)).otherwise(F.array().cast("array<int>")))
    parts = []
    for no, kind in enumerate(KINDS):
        n, p = F.size(f"_m_{kind}"), F.col(f"_p_{kind}")
        zipped = F.arrays_zip(F.col(f"_m_{kind}").alias("m"), F.slice(p, 1, n).alias("p"), F.slice(p, 2, n).alias("a"), F.col(f"_s_{kind}").alias("s"), F.array_repeat(F.length(text), n).alias("n"))
        parts.append(F.transform(zipped, partial(candidate, no, kind)))
    return found.withColumn(out, F.array_sort(F.concat(*parts))).select(*have, out)


@dataclass
class SpanModel:
    """For each kind: the classifier's intercept, its weights for each labeler's vote for and against, and
    for each value of each feature; and the labelers' reliabilities."""

    weights: dict[str, tuple[float, list[tuple[float, float]], list[list[float]]]]
    reliability: dict[str, list[tuple[float, float]]]

    def score(self, kind: str, votes: tuple[int, ...], features: tuple[int, ...]) -> float:
        b, w, f = self.weights[kind]
        z = b + sum(x[0] if v > 0 else x[1] if v < 0 else 0.0 for x, v in zip(w, votes, strict=True)) + sum(x[v] for x, v in zip(f, features, strict=True))
        return 1 / (1 + math.exp(-z))

    def accepts(self, span: Column) -> Column:
        z = F.lit(-30.0)
        for no, kind in enumerate(KINDS):
            b, w, f = self.weights[kind]
            total = F.lit(float(b))
            for i, (yes, against) in enumerate(w):
                v = F.element_at(span["votes"], i + 1)
                total = total + F.when(v > 0, F.lit(float(yes))).when(v < 0, F.lit(float(against))).otherwise(F.lit(0.0))
            for i, each in enumerate(f):
                total = total + F.element_at(F.array(*(F.lit(float(x)) for x in each)), F.element_at(span["features"], i + 1) + 1)
            z = F.when(span["kind_no"] == no, total).otherwise(z)
        return z > 0


def expectation_maximisation(counts: dict[tuple[int, ...], int], rounds: int = 50) -> tuple[dict, list[tuple[float, float]]]:
    """The chance of being personal data for each vote pattern; and each labeler's chance of a right vote, for and against."""
    chance = {p: 1 / (1 + math.exp(-1.5 * sum(p))) for p in counts}
    n = len(LABELERS)
    for _ in range(rounds):
        prior = (1 + sum(c * chance[p] for p, c in counts.items())) / (2 + sum(counts.values()))
        table = {}
        for i, v, side in itertools.product(range(n), (-1, 0, 1), (0, 1)):
            weight = {p: c * (chance[p] if side else 1 - chance[p]) for p, c in counts.items()}
            # one pseudo-vote in ten takes the labeler at its word
            expected = 1.0 if v == 0 else 2.0 if (v > 0) == bool(side) else 0.5
            table[i, v, side] = (expected + sum(w for p, w in weight.items() if p[i] == v)) / (3.5 + sum(weight.values()))
        for p in counts:
            odds = math.log(prior / (1 - prior)) + sum(math.log(table[i, v, 1] / table[i, v, 0]) for i, v in enumerate(p))
            chance[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    right = [(table[i, 1, 1] / (table[i, 1, 1] + table[i, 1, 0]), table[i, -1, 0] / (table[i, -1, 0] + table[i, -1, 1])) for i in range(n)]
    return chance, right


def encoded(votes: tuple[int, ...], features: tuple[int, ...]) -> list[float]:
    """The classifier's inputs: for each labeler a vote for and a vote against, for each feature one of its values."""
    row = [float(v == side) for v in votes for side in (1, -1)]
    for value, n in zip(features, FEATURES.values(), strict=True):
        row += [float(value == i) for i in range(n)]
    return row


def train(counts: dict[tuple[str, tuple[int, ...]], int], seen: dict[tuple[str, tuple[int, ...], tuple[int, ...]], int], steps: int = 400, shrink: float = 0.003) -> SpanModel:
    """EM for each kind over its vote patterns, then a logistic classifier on the posteriors.

    counts: of (kind, votes), all of them; seen: of (kind, votes, features), those to fit on.
    """
    weights, reliability = {}, {}
    sizes = list(FEATURES.values())
    for kind in KINDS:
        own = {p: c for (k, p), c in counts.items() if k == kind}
        if not own:
            weights[kind] = (-1.0, [(1.0, -1.0)] * len(LABELERS), [[0.0] * n for n in sizes])
            reliability[kind] = [(0.5, 0.5)] * len(LABELERS)
            continue
        chance, reliability[kind] = expectation_maximisation(own)
        rows = sorted((p, f, c) for (k, p, f), c in seen.items() if k == kind)
        x = np.array([encoded(p, f) for p, f, _ in rows])
        y, c = np.array([chance[p] for p, _, _ in rows]), np.array([c for _, _, c in rows], dtype=float)
        c /= c.sum()
        b, w = 0.0, np.zeros(x.shape[1])
        rate = 4.0 / (float((c[:, None] * x**2).sum()) + 1)
        v, vb, t = w.copy(), b, 1.0
        for _ in range(steps):  # accelerated gradient steps
            wrong = (1 / (1 + np.exp(-(x @ v + vb))) - y) * c
            nw, nb, nt = v - rate * (x.T @ wrong + shrink * v), vb - rate * float(wrong.sum()), (1 + math.sqrt(1 + 4 * t * t)) / 2
            v, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
            w, b, t = nw, nb, nt
        n = 2 * len(LABELERS)
        ends = np.cumsum([n, *sizes])
        weights[kind] = (b, [(float(w[i]), float(w[i + 1])) for i in range(0, n, 2)], [w[i:j].tolist() for i, j in zip(ends[:-1], ends[1:], strict=True)])
    return SpanModel(weights, reliability)


def fit_spans(docs: DataFrame, most: int = 20_000) -> SpanModel:
    """Counts patterns over all of docs' texts.

    All counts of votes come back (at most 5 * 81), and of votes with features the `most` most
    frequent ones of each kind, on which the classifier is fitted.
    """
    spans = with_candidates(docs.select(text_or_empty().alias("text")), "text", "c").select(F.explode("c").alias("c"))
    patterns = cut(spans.groupBy("c.kind_no", "c.votes", "c.features").count())
    counts = {(KINDS[r[0]], tuple(r[1])): r[2] for r in patterns.groupBy("kind_no", "votes").agg(F.sum("count")).collect()}
    seen = {}
    for no, kind in enumerate(KINDS):
        for r in patterns.filter(F.col("kind_no") == no).orderBy(F.desc("count"), "votes", "features").limit(most).collect():
            seen[kind, tuple(r["votes"]), tuple(r["features"])] = r["count"]
    return train(counts, seen)


def find_pii(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """docs with base_spans and spans: arrays of (start, kind_no, end), in order, in code points.

    base_spans has the emails, ips, cards and phones of strict format; spans has them and what the
    classifier adds (candidates of weaker format and secrets such as keys and passwords). Null and
    empty texts have none. Repeated rows are each searched; other columns stay, but those called
    base_spans or spans are replaced; an empty table gives an empty one. Without a model one is fitted.
    """
    model = model or fit_spans(docs)
    docs = docs.drop("base_spans", "spans", "_text", "_c").withColumn("_text", text_or_empty())
    found = with_candidates(docs, "_text", "_c")
    plain = lambda c: F.struct(c["start"].alias("start"), c["kind_no"].alias("kind_no"), c["end"].alias("end"))
    found = found.withColumn("base_spans", F.transform(F.filter("_c", lambda c: c["base"]), plain))
    found = found.withColumn("spans", F.transform(F.filter("_c", lambda c: c["base"] | model.accepts(c)), plain))
    return found.drop("_text", "_c")


def redact(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Replaces every span in text by its kind in brackets; of overlapping spans the first names the place."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc, s):
        kept = F.substr(F.col(text), acc["at"] + 1, s["start"] - acc["at"])
        grown = F.concat(acc["parts"], F.array(kept, F.element_at(names, s["kind_no"] + 1)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], grown).otherwise(acc["parts"]).alias("parts"))

    done = F.aggregate(spans, zero, step, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substr(F.col(text), acc["at"] + 1, F.length(text))))
    return docs.withColumn(text, F.when(F.size(spans) > 0, done).otherwise(F.col(text)))


def listed(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind_no"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def is_kind(no: int, span: Column) -> Column:
    return span["kind_no"] == no


def op6_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs)
    counts = [F.size(F.filter("base_spans", partial(is_kind, no))).cast("long").alias(f"n_{kind}") for no, kind in enumerate(KINDS[:4])]
    return found.select("doc_id", *counts, F.sha2(listed("base_spans").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"))
