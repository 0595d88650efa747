"""Quality grades by ordinal cumulative-link regression on hashed text."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, materialise, map_ids
from .labelled import fold_of, labelled_sample

BUCKETS = 1 << 16
MAX_FIT_ROWS = 5000
MAX_GRADES = 64
EPOCHS = 30
REMEMBERED = 500_000
RIDGE = 1e-6
_LETTERS = re.compile(r"[^\W\d_]+")


def shape(word: str) -> str:
    """Letters collapsed to X (upper), x (lower) or Xx (mixed), digits to 9, other signs kept: `THE,!!` is `X,!!`."""
    w = _LETTERS.sub(lambda m: "X" if m[0].isupper() and len(m[0]) > 1 else "x" if m[0].islower() else "Xx", word)
    return re.sub(r"\d+", "9", w)


def features(word: str) -> tuple[int, int, int]:
    """Hashed buckets of a word, of its shape and of its last letters."""
    s = shape(word)
    return tuple(zlib.crc32(x.encode()) % BUCKETS for x in (f"w{word.lower()}", f"s{s}", f"e{s[-1:]}{word[-3:].lower()}"))


@dataclass
class Grader:
    """Shared weights and ordered thresholds: P(grade > grades[k]) = logistic(x.w - thresholds[k])."""

    grades: list[int] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def tails(self, x: np.ndarray) -> np.ndarray:
        """len(x) x (grades - 1) tail probabilities."""
        return 1 / (1 + np.exp(-np.clip(x[:, None] - self.thresholds[None, :], -60, 60)))

    def scorer(self):
        weights = self.weights

        class Memo(dict):
            def __missing__(self, word):
                if len(self) >= REMEMBERED:
                    self.clear()
                self[word] = v = float(sum(weights[i] for i in features(word)))
                return v

        memo = Memo()

        def x(text: str) -> float:
            words = text.split()
            return sum(map(memo.__getitem__, words)) / len(words) if words else 0.0

        return x


def upper(theta: np.ndarray) -> np.ndarray:
    """Ordered thresholds from the first one and the logarithms of the steps."""
    return np.concatenate([theta[:1], theta[0] + np.cumsum(np.exp(theta[1:]))])


def gradient(w: np.ndarray, theta: np.ndarray, at: np.ndarray, value: np.ndarray, doc: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradients of the mean negative log likelihood by weights and thresholds' parameters, and the mean itself.

    Feature `at` of document `doc` has `value`; y: the documents' grades by number. P(grade = j) = P(grade >= j) - P(grade > j).
    """
    n, k = len(y), len(theta)
    x = np.bincount(doc, w[at] * value, minlength=n)
    th = np.concatenate([[-np.inf], upper(theta), [np.inf]])
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    lo, hi = sig(x - th[y]), sig(x - th[y + 1])
    p = np.maximum(lo - hi, 1e-12)
    dlo, dhi = lo * (1 - lo) / p, hi * (1 - hi) / p
    gth = np.zeros(k + 2)
    np.add.at(gth, y, dlo / n)
    np.add.at(gth, y + 1, -dhi / n)
    gth = gth[1:-1]
    gtheta = np.concatenate([[gth.sum()], [np.exp(theta[j]) * gth[j:].sum() for j in range(1, k)]])
    gw = np.bincount(at, (-(dlo - dhi) / n)[doc] * value, minlength=len(w)) + RIDGE * w
    return gw, gtheta, float(-np.log(p).mean() + RIDGE / 2 * (w @ w))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 5, held: int = 0, max_rows: int = MAX_FIT_ROWS, id_col: str = "doc_id", text_col: str = "text", max_grades: int = MAX_GRADES) -> Grader:
    """Maximum likelihood by Adam on at most max_rows labelled documents outside the held-out fold.

    A document's features are the mean of its words' hashed features over the
    whole text. Grades are the distinct labels in order; more than max_grades of them are an error.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for t, y in zip(pdf["text"], pdf["label"]):
                words = t.split()
                at, n = np.unique(np.array([i for w in words for i in features(w)], np.int64), return_counts=True)
                rows.append((y, at.astype("<i4").tobytes(), (n / max(1, len(words))).astype("<f4").tobytes()))
            yield pd.DataFrame(rows, columns=["label", "at", "value"])

    sample = labelled_sample(docs, labels, label_col, max_rows, folds, held, id_col, text_col)
    rows = materialise(sample.mapInPandas(frugal(run), "label int, at binary, value binary"), "graded").collect()  # max_rows rows at most
    grades = sorted({r.label for r in rows})
    if len(grades) > max_grades:
        raise ValueError(f"{len(grades)} grades; {max_grades} at most")
    if len(grades) < 2:
        return Grader(grades=grades)
    rows.sort(key=lambda r: zlib.crc32(r["at"]))
    at = [np.frombuffer(r["at"], "<i4") for r in rows]
    value = [np.frombuffer(r["value"], "<f4") for r in rows]
    y = np.array([grades.index(r.label) for r in rows])
    k = len(grades) - 1
    # thresholds start at the log odds of the grades' shares; later ones keep their order as steps of exp(gap)
    above = np.array([(y > j).mean() for j in range(k)])
    start = -np.log(np.clip(above, 1e-4, 1 - 1e-4) / np.clip(1 - above, 1e-4, 1))
    gaps = np.log(np.maximum(np.diff(start), 1e-2))
    w, theta = np.zeros(BUCKETS), np.concatenate([start[:1], gaps])
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(theta), np.zeros_like(theta)]
    rng, turn, size = np.random.RandomState(7), 0, 64
    for epoch in range(EPOCHS):
        rate = 0.3 * (1 - epoch / EPOCHS)
        order = rng.permutation(len(rows))
        for a in range(0, len(order), size):
            own = order[a : a + size]
            idx, val = np.concatenate([at[i] for i in own]), np.concatenate([value[i] for i in own])
            doc = np.repeat(np.arange(len(own)), [len(at[i]) for i in own])
            gw, gtheta, _ = gradient(w, theta, idx, val, doc, y[own])
            turn += 1
            for param, g, m, v in ((w, gw, moments[0], moments[1]), (theta, gtheta, moments[2], moments[3])):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                param -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-6)
    return Grader(grades=grades, weights=w.astype(np.float32), thresholds=upper(theta))


def grade(docs: DataFrame, grader: Grader, select_grade: int | None = None, select_tail: float = 0.5, folds: int = 5, held: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, expected_grade, tail_probability, kept), one row per row of docs.

    tail_probability is that of select_grade (the highest where None) or better;
    kept where it reaches select_tail. Only the text enters. Null and empty
    texts have no features and get the thresholds' own grade; null ids are not held out;
    repeated rows are graded alike; an empty table gives no rows. A grader that
    has seen fewer than two grades gives null grades and keeps every row.
    """
    grades = grader.grades
    want = select_grade if select_grade is not None else (grades[-1] if grades else 0)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x = grader.scorer()
        steps = np.diff(np.array(grades, float))
        at = next((i for i, g in enumerate(grades) if g >= want), len(grades))
        for pdf in parts:
            xs = np.array([x(t) for t in pdf["text"]])
            tails = grader.tails(xs) if len(grades) > 1 else None
            out = pd.DataFrame({"id": pdf["id"], "fold": pdf["fold"]})
            out["expected_grade"] = grades[0] + (tails * steps).sum(axis=1) if tails is not None else None
            out["tail_probability"] = (tails[:, at - 1] if 0 < at < len(grades) else np.full(len(xs), float(at == 0))) if tails is not None else None
            yield out

    own = docs.select(F.col(id_col).cast("bigint").alias("id"), fold_of(F.col(id_col).cast("bigint"), folds).alias("fold"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = map_ids(own, run, "id bigint, fold int, expected_grade double, tail_probability double")
    return out.select(F.col("id").alias(id_col), (F.col("fold") == held).alias("held_out"), "expected_grade", "tail_probability", F.coalesce(F.col("tail_probability") >= select_tail, F.lit(True)).alias("kept"))
