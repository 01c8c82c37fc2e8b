"""Severity of toxic text by cumulative-link ordinal regression on the words of a text.

P(grade <= k) = logistic(cut_k - w.x) for ordered cuts, with the same sparse weights w for every cut
and x telling which words occur. The weights are fitted with an L1 penalty, so that words without
clear evidence weigh nothing however long a text is, and are never negative: no amount of harmless
words outweighs a toxic one. The result is the expected grade.

The labels say toxic or not. Grades of toxic examples follow their number of telling words, those at
least LIFT times as frequent in toxic examples: 1 to 3 by thirds of the toxic examples.

Null text has no words. Documents without label train nothing; a null label counts as none, and of
repeated labels the larger one holds. Without examples of both kinds nothing is toxic. Repeated rows
each give their row. Only ids, texts and labels are used, so other columns cannot clash. An empty
table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remanente.llm.common import over_texts, packed, restored, texts, written

#: Examples of each kind to fit on, the first by a hash of their ids. Everything else covers all
#: documents.
EXAMPLES = 4000
#: Examples a word must occur in, steps of the fit, and the penalty of a word, in standard deviations
#: of the slope that a word without meaning would have.
LEAST, STEPS, PENALTY = 5, 150, 5.0
RIDGE = 1e-3
LIFT, GRADES = 8.0, 3
#: Bytes of the beginnings of words that count as features besides the words.
STEMS = (4, 5)

#: A-Z as a-z; every ASCII byte that is no letter as a blank.
_TO_WORDS = bytes(
    b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def word_set(text: str) -> set[bytes]:
    """Words, and the beginnings of longer words, which their inflections share."""
    words = set(text.encode().translate(_TO_WORDS).split())
    for size in STEMS:
        words |= {w[:size] + b"-" for w in words if len(w) >= size and w[-1] != 45}
    return words


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Ordinal:
    """Weights of words, and ordered cuts between grades 0, 1, ..."""

    weights: dict[bytes, float]
    cuts: np.ndarray
    #: Expected grade from which a text counts as toxic: what divides the examples best.
    limit: float = np.inf

    def of_words(self, words: set[bytes]) -> tuple[float, int]:
        """Expected grade, and the likeliest one."""
        if not len(self.cuts):
            return 0.0, 0
        score = sum(self.weights[w] for w in words & self.weights.keys())
        up_to = np.concatenate([[0.0], logistic(self.cuts - score), [1.0]])
        chances = np.diff(up_to)
        return float(chances @ np.arange(len(chances))), int(chances.argmax())

    def expected(self, text: str) -> tuple[float, int]:
        return self.of_words(word_set(text))


@dataclass
class Counted:
    """Examples as numbers: words that enough of them hold, and which example (row) holds which word
    (column of ``vocabulary``), by row, then column."""

    vocabulary: list[bytes]
    row: np.ndarray
    column: np.ndarray
    toxic: np.ndarray


def grades(found: Counted) -> np.ndarray:
    """0 for clean examples; toxic ones in about equal parts by their number of telling words."""
    toxic, m = found.toxic, len(found.vocabulary)
    seen = np.bincount(found.column, minlength=m)
    bad = np.bincount(found.column, toxic[found.row], minlength=m)
    n_clean, n_bad = max(1, int((~toxic).sum())), max(1, int(toxic.sum()))
    telling = (bad >= LEAST) & (bad / n_bad >= LIFT * (seen - bad + 0.5) / n_clean)
    told = np.bincount(found.row, telling[found.column], minlength=len(toxic))
    edges = np.unique(np.quantile(told[toxic], np.arange(1, GRADES) / GRADES))
    return np.where(toxic, 1 + np.searchsorted(edges, told, side="left"), 0)


def fit(found: Counted) -> Ordinal:
    """Weights and cuts of least penalised loss.

    Only words whose slope exceeds the penalty can gain weight; the fit starts with those at zero
    weights and is repeated with any that exceed it later.
    """
    toxic, row, column = found.toxic, found.row, found.column
    if not toxic.any() or toxic.all():
        return Ordinal({}, np.empty(0))
    grade = grades(found)
    n, m, levels = len(toxic), len(found.vocabulary), int(grade.max())
    below = np.array([(grade <= k).mean() for k in range(levels)])
    w, cuts = np.zeros(m), np.log(below / (1 - below))
    penalty = PENALTY * 0.5 * np.sqrt(np.bincount(column, minlength=m)) / n
    used = np.zeros(m, bool)
    for _ in range(5):
        score = np.bincount(row, w[column], minlength=n)
        slope, _ = slopes(score, cuts, grade)
        new = (-np.bincount(column, slope[row], minlength=m) / n > penalty) & ~used
        if not new.any():
            break
        used |= new
        keep = used[column]
        w, cuts = descend(row[keep], column[keep], grade, w, cuts, penalty)
    chosen = np.flatnonzero(w)
    place = np.full(m, -1)
    place[chosen] = np.arange(len(chosen))
    keep = place[column] >= 0
    x = np.zeros((n, len(chosen)))
    x[row[keep], place[column[keep]]] = 1
    w[chosen], cuts = refit(x, grade, w[chosen], cuts)
    model = Ordinal({found.vocabulary[i]: float(w[i]) for i in np.flatnonzero(w)}, cuts)
    up_to = logistic(cuts[None, :] - (x @ w[chosen])[:, None])
    edge = np.concatenate([np.zeros((n, 1)), up_to, np.ones((n, 1))], axis=1)
    model.limit = dividing(np.diff(edge, axis=1) @ np.arange(levels + 1), toxic)
    return model


def dividing(expected: np.ndarray, toxic: np.ndarray) -> float:
    """Middle of the gap that parts toxic from clean examples with the least share of errors."""
    values = np.unique(expected)
    middles = np.concatenate([(values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    missed = np.searchsorted(np.sort(expected[toxic]), middles) / toxic.sum()
    clean = np.sort(expected[~toxic])
    wrong = (len(clean) - np.searchsorted(clean, middles)) / len(clean)
    return float(middles[np.argmin(missed + wrong)])


def slopes(score: np.ndarray, cuts: np.ndarray, grade: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the loss by each example's score, and of the mean loss by each cut."""
    n, levels = len(score), len(cuts)
    up_to = logistic(cuts[None, :] - score[:, None])
    edge = np.concatenate([np.zeros((n, 1)), up_to, np.ones((n, 1))], axis=1)
    low, high = edge[np.arange(n), grade], edge[np.arange(n), grade + 1]
    width, density = np.maximum(high - low, 1e-9), up_to * (1 - up_to)
    pull = np.zeros(levels)
    for cut in range(levels):
        share = density[:, cut] / width
        pull[cut] = (share[grade == cut + 1].sum() - share[grade == cut].sum()) / n
    return 1 - low - high, pull


def descend(
    row: np.ndarray,
    column: np.ndarray,
    grade: np.ndarray,
    w: np.ndarray,
    cuts: np.ndarray,
    penalty: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Proximal gradient descent with momentum; each weight's step follows a bound of curvature."""
    n, m = len(grade), len(w)
    words = np.bincount(row, minlength=n) + 1.0
    step = n / (0.5 * np.bincount(column, words[row], minlength=m) + 1e-9)
    step[np.bincount(column, minlength=m) == 0] = 0
    ahead, last = w, w
    for k in range(STEPS):
        slope, pull = slopes(np.bincount(row, ahead[column], minlength=n), cuts, grade)
        moved = ahead - step * np.bincount(column, slope[row], minlength=m) / n
        last, w = w, np.maximum(moved - step * penalty, 0)
        ahead = w + k / (k + 3) * (w - last)
        cuts = np.sort(cuts - pull)
    return w, cuts


def refit(
    x: np.ndarray, grade: np.ndarray, w: np.ndarray, cuts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Newton steps for the few chosen words, whose weights the penalty has shrunk."""
    n = len(grade)
    for _ in range(12):
        for _ in range(20):
            _, pull = slopes(x @ w, cuts, grade)
            cuts = np.sort(cuts - pull)
        score = x @ w
        slope, _ = slopes(score, cuts, grade)
        up_to = logistic(cuts[None, :] - score[:, None])
        edge = np.concatenate([np.zeros((n, 1)), up_to, np.ones((n, 1))], axis=1)
        bend = edge * (1 - edge)
        weight = bend[np.arange(n), grade] + bend[np.arange(n), grade + 1]
        curve = (x * weight[:, None]).T @ x / n + RIDGE * np.eye(x.shape[1])
        move = np.linalg.solve(curve, x.T @ slope / n + RIDGE * w)
        w = np.maximum(w - move / max(1.0, np.abs(move).max(initial=0)), 0)
    return w, cuts


def examples(docs: DataFrame, labels: DataFrame, each: int = EXAMPLES) -> DataFrame:
    """words and toxic of at most ``each`` labelled documents of either kind."""
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    order = F.xxhash64("doc_id"), F.col("doc_id")
    chosen = None
    for kind in (F.col("toxic") > 0, F.col("toxic") <= 0):
        part = known.where(kind).orderBy(*order).limit(each)
        chosen = part if chosen is None else chosen.union(part)
    # At most 2 * each pairs of numbers.
    found = texts(docs).join(F.broadcast(chosen), "doc_id")

    def rows(batch: list[str]) -> dict[str, list]:
        return {"words": [sorted(word_set(t)) for t in batch]}

    return over_texts(found, rows, "words array<binary>").select("doc_id", "toxic", "words")


def counted(found: DataFrame) -> Counted:
    """Examples as numbers. Words are counted in Spark; the driver holds those that occur in LEAST
    examples once each, and one 32-bit number for each of their occurrences."""
    often = found.select(F.explode("words").alias("word")).groupBy("word").count()
    words = often.where(F.col("count") >= LEAST).select("word").toArrow()["word"].to_pylist()
    vocabulary = sorted(bytes(w) for w in words)
    number = {w: k for k, w in enumerate(vocabulary)}
    shared = found.sparkSession.sparkContext.broadcast(number)

    def rows(batch: list[list[bytes]]) -> dict[str, list]:
        known = shared.value
        return {"ids": [sorted(known[w] for w in words if w in known) for words in batch]}

    numbers = over_texts(found, rows, "ids array<int>", "words").toArrow().sort_by("doc_id")
    ids = numbers["ids"].combine_chunks()
    sizes = np.diff(ids.offsets.to_numpy())
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    toxic = numbers["toxic"].to_numpy().astype(float) > 0
    return Counted(vocabulary, row, ids.flatten().to_numpy(), toxic)


def train(docs: DataFrame, labels: DataFrame, each: int = EXAMPLES) -> Ordinal:
    return fit(counted(written(examples(docs, labels, each), "examples")))


def scored(docs: DataFrame, model: Ordinal) -> DataFrame:
    """All columns of ``docs``, and severity: expected grade, likeliest grade, toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batch: list[str]) -> dict[str, list]:
        found, limit = [shared.value.expected(t) for t in batch], shared.value.limit
        return {"severity": [{"expected": e, "grade": g, "toxic": e >= limit} for e, g in found]}

    adds = "severity struct<expected:double,grade:int,toxic:boolean>"
    return over_texts(docs, rows, adds, keep_text=True)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, expected_severity, grade, toxic."""
    found = scored(texts(docs), train(docs, labels))
    severity = F.col("severity")
    return found.select(
        "doc_id",
        severity["expected"].alias("expected_severity"),
        severity["grade"].alias("grade"),
        severity["toxic"].alias("toxic"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that are not toxic, with their columns."""
    found = scored(packed(docs), train(docs, labels))
    return restored(found.where(~F.col("severity")["toxic"]).select("row", "text"), docs)
