"""Quality classifier as a sparse rule ensemble.

Small trees are grown on random parts of a bounded labelled sample; every path from a root to a node
is a rule (a conjunction of bounds on text statistics); a lasso-penalised logistic regression keeps
few of them with weights; these are compiled into one Spark column expression over the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, table, text_or_empty

STATS = ["log_bytes", "word_len", "upper", "digits", "marks", "bangs", "bars", "stops", "space", "other", "repeats", "distinct", "line_dups"]


def text_stats(text: str) -> tuple:
    """The statistics of one whole text; shares are 0 for an empty one."""
    raw = text.encode()
    n = max(1, len(raw))
    count = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    total = lambda chars: int(count[list(chars)].sum())
    upper, lower, digits = int(count[65:91].sum()), int(count[97:123].sum()), int(count[48:58].sum())
    words, lines = text.split(), text.split("\n")
    ascii_marks = int(count[33:127].sum()) - upper - lower - digits
    stops = total(b".,;:'\"")
    return (
        float(np.log1p(len(raw))), len(raw) / max(1, len(words)), upper / max(1, upper + lower), digits / n, (ascii_marks - stops) / n, total(b"!?") / n, total(b"|") / n, stops / n,
        (total(b" \t\n\r")) / n, int(count[128:].sum()) / n, sum(map(eq, words, words[1:])) / max(1, len(words) - 1), len(set(words)) / max(1, len(words)),
        1 - len(set(lines)) / len(lines),
    )


@F.pandas_udf(T.StructType([T.StructField(s, T.DoubleType()) for s in STATS]))
def stats_udf(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_stats(t or "") for t in texts], columns=STATS)


@dataclass
class Rules:
    """rules: lists of (statistic, is_above, bound); weights go with them; mean: used where no rules are."""

    rules: list
    weights: list
    intercept: float

    def score_rows(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for rule, w in zip(self.rules, self.weights, strict=True):
            z += w * holds(rule, x)
        return 1 / (1 + np.exp(-z))

    def column(self, stats: str) -> Column:
        """The score over a struct column of the statistics."""
        z = F.lit(float(self.intercept))
        for rule, w in zip(self.rules, self.weights, strict=True):
            test = F.lit(True)
            for name, above, bound in rule:
                value = F.col(f"{stats}.{name}")
                test = test & ((value > float(bound)) if above else (value <= float(bound)))
            z = z + F.when(test, F.lit(float(w))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def holds(rule, x: np.ndarray) -> np.ndarray:
    ok = np.ones(len(x), dtype=bool)
    for name, above, bound in rule:
        v = x[:, STATS.index(name)]
        ok &= (v > bound) if above else (v <= bound)
    return ok


def grow(x, y, rng, depth: int, path=(), least: int = 10) -> list:
    """Paths to the nodes of one tree: best Gini split over some of the statistics at some bounds."""
    rules = [path] if path else []
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return rules
    best = (1e-9, None, None)
    base = y.mean() * (1 - y.mean())
    for j in rng.choice(x.shape[1], size=max(2, x.shape[1] // 2), replace=False):
        values = np.unique(x[:, j])
        if len(values) < 2:
            continue
        cuts = values if len(values) <= 65 else np.quantile(values, np.linspace(0, 1, 65))
        for bound in (cuts[:-1] + cuts[1:]) / 2:
            low = x[:, j] <= bound
            n = int(low.sum())
            if least <= n <= len(y) - least:
                a, b = y[low].mean(), y[~low].mean()
                gain = base - (n * a * (1 - a) + (len(y) - n) * b * (1 - b)) / len(y)
                if gain > best[0]:
                    best = (gain, j, bound)
    _, j, bound = best
    if j is None:
        return rules
    low = x[:, j] <= bound
    for part, above in ((low, False), (~low, True)):
        rules += grow(x[part], y[part], rng, depth - 1, (*path, (STATS[j], above, float(bound))), least)
    return rules


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient; the intercept isn't penalised."""
    n, p = z.shape
    step = 4.0 / (np.linalg.norm(z, 2) ** 2 / n + 1)
    w = np.zeros(p)
    b = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    v, c, t = w.copy(), b, 1.0
    for _ in range(steps):
        wrong = 1 / (1 + np.exp(-(z @ v + c))) - y
        nw = v - step * (z.T @ wrong) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * penalty, 0)
        nb = c - step * wrong.mean()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, b


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, part: int = 2000, penalty: float = 2e-3, seed: int = 7) -> Rules:
    """A rule ensemble for 0/1 labels. With no rows it scores 1/2; with one class, near that class."""
    if len(y) == 0 or y.min() == y.max():
        share = 0.5 if len(y) == 0 else (len(y) * y.mean() + 0.5) / (len(y) + 1)
        return Rules([], [], float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    found: dict = {}
    for _ in range(trees):
        pick = rng.choice(len(y), size=min(part, len(y)), replace=False)
        for rule in grow(x[pick], y[pick], rng, depth):
            mark = holds(rule, x)
            found.setdefault(np.packbits(mark).tobytes(), (rule, mark))
    kept = [(r, m) for r, m in found.values() if 0 < m.mean() < 1]
    if not kept:
        return fit_rules(x[:0], y[:0])
    z = np.stack([m for _, m in kept], axis=1).astype(float)
    w, b = lasso_logistic(z, y.astype(float), penalty)
    on = np.flatnonzero(np.abs(w) > 1e-6)
    return Rules([kept[i][0] for i in on], [float(w[i]) for i in on], float(b))


def held_out() -> Column:
    """Whether a row's labels are kept from learning; a row without a doc_id has none and isn't held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = 12_000) -> Rules:
    """Fits on at most `sample` labelled rows, the first by a hash of doc_id; never on held-out ones.

    Rows without a label or id are left out; of texts with one id and label, one counts."""
    small_batches(docs.sparkSession)
    marked = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", F.col("quality").cast("int").alias("y"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample)
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id").select("doc_id", "y", stats_udf("text").alias("s"))
    rows = rows.groupBy("doc_id", "y").agg(F.min("s").alias("s")).select("doc_id", "y", "s.*").toPandas().sort_values(["doc_id", "y"])
    return fit_rules(rows[STATS].to_numpy(dtype=float), rows["y"].to_numpy())


def score_documents(docs: DataFrame, rules: Rules, name: str = "score") -> DataFrame:
    """Adds a score column (0 to 1, higher for better) to every row of docs, whose other columns stay.

    Null and empty texts are scored by the statistics of an empty text. Repeated rows are each
    scored; equal texts get equal scores. Columns called _quality_stats or like the score's name are replaced.
    """
    small_batches(docs.sparkSession)
    return docs.withColumn("_quality_stats", stats_udf(text_or_empty())).withColumn(name, rules.column("_quality_stats")).drop("_quality_stats")


def op3_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs, rules).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
