"""Toxicity by a weighted lexicon, matched with Aho-Corasick in folded text."""

from __future__ import annotations

import bisect
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import PandasUDFType

from .common import frugal, materialise, map_ids
from .labelled import fold_of, labelled_sample

# Letters of other scripts that look like Latin ones, and common digit and sign substitutions.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "і": "i", "ї": "i", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ј": "j", "ԁ": "d", "ո": "n", "ս": "u",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɡ": "g", "ⅼ": "l", "ℓ": "l",
}
SUBSTITUTIONS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
ZERO_WIDTH = "­​‌‍⁠﻿"

PREFIXES = range(4, 9)
MAX_FIT_ROWS = 20_000
MIN_DOCS = 3
HELD_ENTRIES = 150_000
#: An entry needs a likelihood ratio that chance gives about one of 400,000 candidates (chi-squared with one degree of freedom:
#: a probability of 2.7e-6 at 22), and to be some 33 times as frequent in toxic documents (a log odds ratio of 3.5).
MIN_RATIO = 22.0
MIN_WEIGHT = 3.5


class _Fold(dict):
    """str.translate table, filled as characters turn up: folded letters stay, all else becomes a space."""

    def __missing__(self, code: int):
        c = chr(code)
        if c in ZERO_WIDTH:
            out = None
        else:
            low = c.lower()
            low = HOMOGLYPHS.get(low, SUBSTITUTIONS.get(low, low))
            if len(low) == 1 and 0xFF21 <= ord(c) <= 0xFF5A:  # full-width letters
                low = chr(ord(c) - 0xFEE0).lower()
            out = low if low.isalpha() else " "
        self[code] = out
        return out


_FOLD = _Fold()


def fold(text: str) -> str:
    """Text as matched: folded words, each between spaces."""
    return " " + " ".join(text.translate(_FOLD).split()) + " "


@dataclass
class Lexicon:
    """Entries as they are matched (" word " or " prefix") with weights, phrases that excuse hits inside them, and the calibration of the score."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    slope: float = 1.0
    offset: float = 0.0
    empty: bool = True

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for p in self.exceptions:
            a.add_word(fold(p), (len(fold(p)), None))
        for w, x in self.weights.items():
            a.add_word(w, (len(w), x))
        if len(a):
            a.make_automaton()
        return a

    def density(self, automaton, text: str) -> float:
        """Summed weights of hits over log2(2 + words): one for each place a hit starts, the largest; none inside an exception phrase."""
        if not len(automaton):
            return 0.0
        folded = fold(text)
        best: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        for end, (n, weight) in automaton.iter(folded):
            start = end - n + 1
            if weight is None:
                excused.append((start, end))
            elif weight > best.get(start, 0):
                best[start] = weight
        if not best:
            return 0.0
        if excused:  # spans in order, joined where they overlap; a hit is excused by the last one that begins before it
            spans = _joined(excused)
            begins = [a for a, _ in spans]
            best = {s: w for s, w in best.items() if not (i := bisect.bisect_right(begins, s)) or spans[i - 1][1] < s}
        return sum(best.values()) / math.log2(2 + folded.count(" "))

    def score(self, density: float) -> float:
        return 0.0 if self.empty else 1 / (1 + math.exp(-min(60.0, max(-60.0, self.slope * density + self.offset))))


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _candidates(folded: str) -> set[str]:
    words = set(folded.split())
    out = {f" {w} " for w in words if len(w) > 2}
    out.update(f" {w[:n]}" for w in words for n in PREFIXES if len(w) > n)
    return out


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Words and word beginnings that tell toxic documents: log odds ratios of those with a significant likelihood ratio."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Counter(), Counter()  # clean and toxic
        n = [0, 0]

        def flush() -> pd.DataFrame:
            keys = list(seen[0].keys() | seen[1].keys())
            out = pd.DataFrame({"entry": ["", *keys], "toxic": [n[1], *[seen[1][k] for k in keys]], "clean": [n[0], *[seen[0][k] for k in keys]]})
            for c in seen:
                c.clear()
            n[:] = 0, 0
            return out

        for pdf in parts:
            for t, y in zip(pdf["text"], pdf["label"]):
                n[y > 0] += 1
                seen[y > 0].update(_candidates(fold(t)))
                if len(seen[0]) + len(seen[1]) > HELD_ENTRIES:
                    yield flush()
        yield flush()

    counts = materialise(sample.mapInPandas(frugal(count), "entry string, toxic bigint, clean bigint").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(f"toxic >= {MIN_DOCS} or entry = ''"), "lexicon")
    totals = counts.where("entry = ''").first()
    if totals is None or not totals.toxic or not totals.clean:
        return {}
    nt, nc = totals.toxic, totals.clean
    t, c = F.col("toxic").cast("double"), F.col("clean").cast("double")
    rate = (t + c) / (nt + nc)
    term = lambda k, n: F.when(k > 0, k * F.log(k / (rate * n))).otherwise(0.0)
    ratio = 2 * (term(t, nt) + term(c, nc))
    weight = F.log((t + 0.5) / (nt + 1)) - F.log((c + 0.5) / (nc + 1))
    rows = (
        counts.where("entry <> ''").withColumn("ratio", ratio).withColumn("weight", weight)
        .where((F.col("ratio") >= MIN_RATIO) & (F.col("weight") >= MIN_WEIGHT))
        .orderBy(F.desc("ratio"), F.desc(F.length("entry")), "entry").collect()
    )
    kept: dict[str, tuple[float, int]] = {}
    begins: dict[str, int] = {}  # every beginning of a kept entry -> its documents
    for r in rows:
        e, stem = r.entry, r.entry.rstrip()
        if any(stem[:n] in kept and not stem[:n].endswith(" ") for n in range(2, len(stem))):
            continue  # a kept beginning covers it
        if e in begins and r.toxic <= 1.25 * begins[e]:
            continue  # the longer entry says as much and is surer
        kept[e] = (r.weight, r.toxic)
        for n in range(2, len(stem) + 1):
            begins[stem[:n]] = max(begins.get(stem[:n], 0), r.toxic)
    return {e: w for e, (w, _) in kept.items()}


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Ridge-penalised logistic regression on one feature, by Newton's method."""
    a = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    ridge = np.array([1e-3, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a[:, 0] * w[0] + w[1], -60, 60)))
        g0, g1 = ((p - y) * a[:, 0]).sum() + ridge[0] * w[0], (p - y).sum() + ridge[1] * w[1]
        v = p * (1 - p)
        h00, h01, h11 = (v * x * x).sum() + ridge[0], (v * x).sum(), v.sum() + ridge[1]
        det = h00 * h11 - h01 * h01
        if det <= 0:
            break
        step = np.array([h11 * g0 - h01 * g1, h00 * g1 - h01 * g0]) / det
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 5, held: int = 0, max_rows: int = MAX_FIT_ROWS, exceptions: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> Lexicon:
    """A lexicon learnt from at most max_rows labelled documents outside the held-out fold.

    All entries and phrases that pass are kept; their number is bounded by the sample's words.

    Phrases of two words around a hit that only clean documents hold (three of
    them at least) join the given exceptions.
    """
    sample = materialise(labelled_sample(docs, labels, label_col, max_rows, folds, held, id_col, text_col), "labelled")
    lex = Lexicon(weights=learn_lexicon(sample), exceptions=list(exceptions or []))
    if not lex.weights:
        return lex

    def measure(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = lex.automaton()
        for pdf in parts:
            yield pd.DataFrame({"density": [lex.density(a, t) for t in pdf["text"]], "label": pdf["label"]})

    def phrases(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = lex.automaton()
        for pdf in parts:
            for t, y in zip(pdf["text"], pdf["label"]):
                f = fold(t)
                found = set()
                for end, (n, _) in a.iter(f):
                    start = end - n + 1
                    before = f.rfind(" ", 0, start)
                    after = f.find(" ", start + 1)
                    if before >= 0 and after > 0:
                        found.add(f[before:after].strip())
                if found:
                    yield pd.DataFrame({"phrase": list(found), "toxic": int(y > 0)})

    grouped = sample.mapInPandas(frugal(phrases), "phrase string, toxic int").groupBy("phrase").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    lex.exceptions += [r.phrase for r in grouped.where("t = 0 and n >= 3").orderBy(F.desc("n"), "phrase").collect()]
    rows = sample.mapInPandas(frugal(measure), "density double, label int").collect()  # max_rows rows at most
    x, y = np.array([r.density for r in rows]), np.array([float(r.label > 0) for r in rows])
    lex.slope, lex.offset = _calibrate(x, y)
    lex.empty = False
    return lex


def score_column(lexicon: Lexicon):
    """A vectorised UDF: text -> score."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        a = lexicon.automaton()
        for texts in parts:
            yield pd.Series([lexicon.score(lexicon.density(a, t)) for t in texts], dtype="float64")

    return F.pandas_udf(frugal(run), T.DoubleType(), PandasUDFType.SCALAR_ITER)


def score(docs: DataFrame, lexicon: Lexicon, folds: int = 5, held: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, score, predicted), one row per row of docs.

    Only the text enters the score. Null and empty texts are scored like a text
    without hits; null ids are not held out; repeated rows are scored alike; an
    empty table gives no rows. A lexicon learnt from no labels scores 0.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = lexicon.automaton()
        for pdf in parts:
            yield pd.DataFrame({"id": pdf["id"], "fold": pdf["fold"], "score": [lexicon.score(lexicon.density(a, t)) for t in pdf["text"]]})

    own = docs.select(F.col(id_col).cast("bigint").alias("id"), fold_of(F.col(id_col).cast("bigint"), folds).alias("fold"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = map_ids(own, run, "id bigint, fold int, score double")
    return out.select(F.col("id").alias(id_col), (F.col("fold") == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
