"""Toxicity by cumulative-link ordinal regression on sparse text features.

Severity grades 0..G are ordered; P(grade <= k) = sigmoid(threshold_k - w.x) with one weight vector for all thresholds.
The features of a text are its distinct lower-case words and the starts of those words (`STARTS` letters, which catch
compounds and inflections), each counted as present or not. The result is the expected severity, the sum over k of
P(grade > k), and the most likely grade.

The model is fitted on the driver on a bounded sample of labelled texts: the `SAMPLE` labelled ids of least seeded hash,
of whose texts at most `SAMPLE_BYTES` are used in that order (sizes are looked at first, texts beyond are not fetched). A feature is used if it stands in `LEAST` of
these texts or more and its presence depends on the grade (a G statistic of `SIGNAL` or more), so the model is sparse
and a long text doesn't add up chance. All documents are scored over their whole text, without a shuffle.

Cases: null and empty texts have no features and get the severity of the thresholds alone, which a fit on mostly clean
rows puts near 0, and are never rejected; labelled rows without a grade are not used for fitting; without any labelled
row every severity is 0, with only one grade it is that grade, and nothing is rejected; repeated rows are scored each;
other columns pass through `without_toxic` untouched, whatever their names; empty tables give no rows.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.shared import small_batches, text_of

SAMPLE, SAMPLE_BYTES, LEAST, STARTS, SIGNAL = 6000, 24 << 20, 4, (4, 5), 20.0
#: Strength of the quadratic penalty, steps of the fit, and its first step size.
PENALTY, STEPS, RATE = 1e-5, 800, 0.1
#: Documents of this expected severity or more are rejected if their words say so: they have to raise the odds of a grade above
#: 0 by e ** EVIDENCE or more over those of a text without features, which are high where the sample explains little.
REJECT, EVIDENCE = 0.05, 2.0

WORD = re.compile(r"\w+")


def features(text: str) -> set[str]:
    """Distinct words, and the starts of longer ones, marked with a hyphen."""
    words = set(WORD.findall(text.lower()))
    return words | {w[:n] + "-" for w in words for n in STARTS if len(w) > n}


@dataclass
class Model:
    """weights by feature; thresholds in ascending order, one less than there are grades from 0 on."""

    weights: dict[str, float]
    thresholds: np.ndarray

    def score(self, text: str) -> float:
        words = set(WORD.findall(text.lower()))
        get = self.weights.get
        total = sum(get(w, 0.0) for w in words)
        for n in STARTS:
            total += sum(get(s + "-", 0.0) for s in {w[:n] for w in words if len(w) > n})
        return total

    def grades(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k, by row."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -40, 40)))


def dependence(seen: Counter, share: Counter) -> float:
    """The G statistic of a feature's presence against the grades."""
    rows, present = share.total(), seen.total()
    out = 0.0
    for grade, n in share.items():
        for here, side in ((seen[grade], present), (n - seen[grade], rows - present)):
            if here:
                out += 2 * here * np.log(here * rows / (n * side))
    return out


def fit(texts: list[str], grades: list[int], least: int = LEAST, penalty: float = PENALTY, steps: int = STEPS, joint: bool = True) -> Model:
    """Maximum likelihood of the cumulative-link model: one weight vector and all thresholds together.

    The climb begins at the weights that part grade 0 from the rest. Without `joint` it stays there and fits the thresholds above alone.
    """
    top = max(grades, default=0)
    if top == 0 or min(grades) == top:
        return Model({}, np.full(top, 40.0 if top == 0 else -40.0))
    share = Counter(grades)
    seen = {g: Counter() for g in share}
    for text, g in zip(texts, grades, strict=True):
        seen[g].update(features(text))
    counted = ((f, Counter({g: seen[g][f] for g in share})) for f in set().union(*seen.values()))
    names = sorted(f for f, n in counted if n.total() >= least and dependence(n, share) >= SIGNAL)
    index = {f: i for i, f in enumerate(names)}
    pairs = [(i, index[f]) for i, text in enumerate(texts) for f in sorted(features(text) & index.keys())]
    row, column = np.array(pairs, np.int64).reshape(-1, 2).T
    grade = np.array(grades)
    w, cuts = ascend(row, column, np.minimum(grade, 1), len(names), np.zeros(len(names) + 1), penalty, steps, 0)
    if top > 1:
        start = np.concatenate([w, cuts, np.zeros(top - 1)])
        w, cuts = ascend(row, column, grade, len(names), start, penalty, steps, len(w) + 1 if not joint else 0)
    return Model({f: float(x) for f, x in zip(names, w, strict=True) if x}, cuts)


def ascend(
    row: np.ndarray, column: np.ndarray, grade: np.ndarray, n: int, start: np.ndarray, penalty: float, steps: int, fixed: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam with shrinking steps. start: n weights, the first threshold, the logs of the gaps after it.

    The first `fixed` of these stay. Thresholds made of gaps stay in order.
    """
    state, m, top = start.copy(), len(grade), len(start) - n
    first, second = np.zeros_like(state), np.zeros_like(state)

    def sigmoid(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def thresholds(raw: np.ndarray) -> np.ndarray:
        return np.concatenate([raw[:1], raw[0] + np.cumsum(np.exp(raw[1:]))])

    for step in range(1, steps + 1):
        w, raw = state[:n], state[n:]
        score = np.bincount(row, w[column], minlength=m)
        below = np.column_stack([np.zeros(m), sigmoid(thresholds(raw)[None, :] - score[:, None]), np.ones(m)])  # P(grade < k)
        high, low = below[np.arange(m), grade + 1], below[np.arange(m), grade]
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / p / m, low * (1 - low) / p / m  # slopes of the negative log likelihood
        d_cuts = np.zeros(top)
        np.add.at(d_cuts, grade[grade < top], -d_high[grade < top])
        np.add.at(d_cuts, grade[grade > 0] - 1, d_low[grade > 0])
        tail = np.cumsum(d_cuts[::-1])[::-1]
        d_weights = np.bincount(column, (d_high - d_low)[row], minlength=n)
        gradient = np.concatenate([d_weights, tail[:1], tail[1:] * np.exp(raw[1:])]) + penalty * state
        gradient[:fixed] = 0
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        state -= RATE / (1 + step / 200) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return state[:n], thresholds(state[n:])


def sample(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade", rows: int = SAMPLE, most: int = SAMPLE_BYTES
) -> tuple[list[str], list[int]]:
    """The bounded sample that the model is fitted on: texts and grades. Texts of over a sixteenth of `most` bytes are passed over.

    The labelled ids are chosen from the labels alone, so what meets the documents is bounded by `rows`.
    """
    known = labels.where(F.col(grade_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(grade_col).cast("int").alias("_grade"))
    chosen = known.withColumn("_h", F.xxhash64("_id", F.lit(9))).orderBy("_h", "_id").limit(rows)
    text = text_of(text_col)
    rest = docs.select(F.col(id_col).alias("id"), text.alias("text")).where(F.octet_length("text") <= most // 16)
    found = rest.join(F.broadcast(chosen), F.col("id") == F.col("_id")).select("text", "_grade", "_h", F.xxhash64("text").alias("_mark"))
    # sizes first, so that no texts are fetched beyond the bound
    sizes = found.select("_h", "_mark", F.octet_length("text").alias("size")).orderBy("_h", "_mark").limit(rows).collect()
    total = np.cumsum([r["size"] for r in sizes])
    n = int(np.count_nonzero(total <= most))
    if not n:
        return [], []
    last = sizes[n - 1]
    fits = found.where((F.col("_h") < last["_h"]) | ((F.col("_h") == last["_h"]) & (F.col("_mark") <= last["_mark"])))
    held = fits.orderBy("_h", "_mark").limit(n).select("text", "_grade").collect()  # at most `most` bytes
    return [r["text"] for r in held], [r["_grade"] for r in held]


def severity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """doc_id, score, expected severity, most likely grade, and whether the document is rejected. No shuffle."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, expected, grade, bad = scored(held.value, batch.column(1), reject)
            columns = [pa.array(scores), pa.array(expected), pa.array(grade, pa.int32()), pa.array(bad)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "score", "severity", "grade", "rejected"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(rows, f"doc_id {kind}, score double, severity double, grade int, rejected boolean")


def scored(model: Model, texts: pa.Array, reject: float) -> tuple[np.ndarray, ...]:
    """Scores, expected severities, most likely grades and rejections of texts."""
    values = texts.to_pylist()
    scores = np.array([model.score(t or "") for t in values], float)
    above = model.grades(scores)
    full = np.column_stack([np.ones(len(scores)), above, np.zeros(len(scores))])
    expected = above.sum(axis=1)
    return scores, expected, np.argmax(full[:, :-1] - full[:, 1:], axis=1), (expected >= reject) & (scores >= EVIDENCE)


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """The rows of `docs` below the severity that is rejected, with all their columns."""
    small_batches(docs.sparkSession)
    held, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~scored(held.value, batch.column(at).cast(pa.string()), reject)[-1]))

    return docs.mapInArrow(rows, docs.schema)
