"""Quality classifier: ordinal regression with a cumulative link on graded ratings.

Grades: 0 poor, 1 good but toxic, 2 good. One score s = w.x is shared by all grades and cut by
ordered thresholds: P(grade <= k) = sigmoid(t_k - s). x are hashed features of the whole
text: its distinct words with their beginnings, and a few properties (share of symbols, capitals, digits and
separators, repetition, length) by level. The expected grade and the tail probability
P(grade = 2) of every document are returned; documents whose tail probability reaches
``least_tail`` are kept.

The weights are learnt from a sample of at most ``sample`` labelled documents (those with the
smallest hash of their id), full texts, by penalised maximum likelihood (L-BFGS); a feature needs
``least_docs`` of them. The fit is small and runs on the driver; features and scores are
computed where the documents are.

Defined results: null and empty texts have their properties as only features. A label without
a document is ignored, a null label too; of several labels of one document the lowest grade
counts. Without any labels, or with labels of one grade only, the score is 0 and the thresholds
hold the share of the grades (no label: all even). Repeated rows are scored each. An empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm import textbytes as tb
from tillcast.llm.common import map_arrow, narrow

GRADES = 3
UPPER = tb.byte_class(range(0x41, 0x5B))
LETTER = tb.byte_class([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
DIGIT = tb.byte_class(range(0x30, 0x3A))
SYMBOL = tb.byte_class(b"#*$%&<>!@")
BAR = tb.byte_class(b"|\t=_")
STEMS = (4, 6)  # bytes
LEVELS = np.array([0.002, 0.005, 0.01, 0.02, 0.04, 0.07, 0.12, 0.2, 0.3, 0.45, 0.6, 0.8])


@dataclass(frozen=True)
class OrdinalModel:
    bits: int = 18
    sample: int = 10_000
    least_docs: int = 8
    rounds: int = 100
    decay: float = 1e-5
    least_tail: float = 0.6
    seed: int = 3


def feature_lists(texts: pa.Array, bits: int):
    """The distinct hashed features of every text."""
    mask = tb.U64((1 << bits) - 1)
    for lo, hi, data, off in tb.slices(texts):
        low = tb.LOWER[data]
        starts, ends, first = tb.word_bounds(data, off, tb.ALNUM_WORD)
        # a word, and its beginnings of each length: stems that unseen words share
        cuts = [np.minimum(starts + k, ends) for k in STEMS] + [ends]
        hashes = tb.span_hashes(low, np.tile(starts, len(cuts)), np.concatenate(cuts)).reshape(len(cuts), -1)
        words = hashes[-1]
        size = np.maximum(np.diff(off), 1)
        shares = [tb.row_sums(c[data], off) / size for c in (UPPER, DIGIT, SYMBOL, BAR, tb.byte_class(b"\n"), LETTER)]
        twin = np.r_[False, words[1:] == words[:-1]] if len(words) else np.zeros(0, bool)
        for i in range(hi - lo):
            own = words[first[i]:first[i + 1]]
            distinct = np.unique(own)
            n = max(len(own), 1)
            levels = [s[i] for s in shares] + [1 - len(distinct) / n, twin[first[i]:first[i + 1]].sum() / n]
            marks = [16 * j + int(np.searchsorted(LEVELS, v, "right")) for j, v in enumerate(levels)] + [16 * len(levels) + len(own).bit_length()]
            yield np.unique(np.r_[hashes[:, first[i]:first[i + 1]].ravel(), tb.mix64(np.array(marks, dtype=tb.U64) + tb.U64(1 << 40))] & mask).astype(np.int32)


@dataclass
class Fitted:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, GRADES - 1

    def score(self, feats: np.ndarray) -> float:
        """Known features count alike and to a length of 1."""
        known = self.weights[feats]
        return float(known.sum(dtype=np.float64) / np.sqrt(max(np.count_nonzero(known), 1)))

    def at_most(self, score: np.ndarray) -> np.ndarray:
        """P(grade <= k), a column for each k below the highest grade."""
        return _sigmoid(self.thresholds - score[:, None])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(feats: list[np.ndarray], grades: np.ndarray, p: OrdinalModel) -> Fitted:
    counts = (np.bincount(grades, minlength=GRADES) + 0.5).astype(float)
    share = np.clip(np.cumsum(counts)[:-1] / counts.sum(), 1e-3, 1 - 1e-3)
    base = np.log(share / (1 - share))
    w = np.zeros(1 << p.bits)
    if len(np.unique(grades)) < 2:
        return Fitted(w.astype(np.float32), base)
    flat = np.concatenate(feats)
    row = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    known = np.bincount(flat, minlength=len(w)) >= p.least_docs
    keep = known[flat]
    flat, row, n = flat[keep], row[keep], len(feats)
    place = np.cumsum(known) - 1
    flat, size = place[flat], int(known.sum())
    weight = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=n), 1))
    value = weight[row]
    onehot = np.zeros((n, GRADES + 1))
    onehot[np.arange(n), grades + 1] += 1
    onehot[np.arange(n), grades] -= 1

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean negative log-likelihood with its penalty; x: weights, first threshold, log gaps."""
        v, low, gaps = x[:size], x[size], np.exp(x[size + 1:])
        c = np.c_[np.zeros(n), _sigmoid(low + np.r_[0, np.cumsum(gaps)] - np.bincount(row, weights=v[flat] * value, minlength=n)[:, None]), np.ones(n)]
        prob = np.maximum((c * onehot).sum(axis=1), 1e-12)
        by_cut = c * (1 - c) * onehot / prob[:, None]
        cuts = by_cut[:, 1:-1].mean(axis=0)
        grad = np.r_[-np.bincount(flat, weights=by_cut.sum(axis=1)[row] * value, minlength=size) / n, cuts.sum(),
                     [cuts[k + 1:].sum() for k in range(GRADES - 2)] * gaps]
        return -np.log(prob).mean() + p.decay / 2 * v @ v, -grad + np.r_[p.decay * v, np.zeros(GRADES - 1)]

    x = minimise(loss, np.r_[np.zeros(size), base[0], np.log(np.maximum(np.diff(base), 1e-2))], p.rounds)
    w[known] = x[:size]
    return Fitted(w.astype(np.float32), x[size] + np.r_[0, np.cumsum(np.exp(x[size + 1:]))])


def minimise(loss, x: np.ndarray, rounds: int, memory: int = 10) -> np.ndarray:
    """Limited-memory BFGS with a halving line search."""
    value, grad = loss(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        step, alphas = -grad, []
        for s, y, r in reversed(past):
            alphas.append(r * (s @ step))
            step = step - alphas[-1] * y
        if past:
            s, y, r = past[-1]
            step = step * (s @ y) / (y @ y)
        for (s, y, r), alpha in zip(past, reversed(alphas)):
            step = step + (alpha - r * (y @ step)) * s
        slope, size = grad @ step, 1.0
        if slope >= 0:
            break
        while True:
            new, new_grad = loss(x + size * step)
            if new <= value + 1e-4 * size * slope:
                break
            size /= 2
            if size < 1e-8:
                return x
        s, y = size * step, new_grad - grad
        if s @ y > 1e-12:
            past = [*past[1 - memory:], (s, y, 1 / (s @ y))]
        done = value - new < 1e-7
        x, value, grad = x + s, new, new_grad
        if done:
            break
    return x


def graded(labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """(label_id, grade) of every labelled document."""
    grade = F.when(F.col(quality_col) == 0, 0).when(F.col(toxic_col) == 1, 1).when(F.col(toxic_col) == 0, 2)
    whole = labels.dropna(subset=[id_col, quality_col, toxic_col])
    return whole.select(F.col(id_col).alias("label_id"), grade.alias("grade")).where("grade is not null").groupBy("label_id").agg(
        F.min("grade").alias("grade"))


def training_rows(docs: DataFrame, labels: DataFrame, p: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[np.ndarray], np.ndarray]:
    """Features and grades of the sample: at most ``sample`` rows."""
    sample = graded(labels).orderBy(F.xxhash64(F.lit(p.seed), "label_id"), "label_id").limit(p.sample)
    rows = narrow(docs, row_id=id_col, text=text_col).join(F.broadcast(sample), F.col("row_id") == F.col("label_id"))
    rows = rows.groupBy("label_id", "grade").agg(F.min("text").alias("text"))
    schema = T.StructType([T.StructField("label_id", rows.schema["label_id"].dataType), T.StructField("grade", T.IntegerType()), T.StructField("feats", T.BinaryType())])

    def work(batch: pa.RecordBatch):
        yield {"label_id": batch.column("label_id"), "grade": batch.column("grade"), "feats": [f.tobytes() for f in feature_lists(batch.column("text"), p.bits)]}

    got = sorted(map_arrow(rows, work, schema).toLocalIterator(), key=lambda r: r.label_id)
    return [np.frombuffer(r.feats, dtype=np.int32) for r in got], np.array([r.grade for r in got], dtype=np.int64)


def train(docs: DataFrame, labels: DataFrame, p: OrdinalModel = OrdinalModel()) -> Fitted:
    return fit(*training_rows(docs, labels, p), p)


def score(docs: DataFrame, model: Fitted, p: OrdinalModel = OrdinalModel(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: the id, expected_grade, tail_probability, kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits weights
    schema = T.StructType([T.StructField("row_id", docs.schema[id_col].dataType), T.StructField("expected_grade", T.DoubleType()),
                           T.StructField("tail_probability", T.DoubleType()), T.StructField("kept", T.BooleanType())])

    def work(batch: pa.RecordBatch):
        m = shared.value
        s = np.array([m.score(f) for f in feature_lists(batch.column("text"), p.bits)])
        below = m.at_most(s)
        tail = 1 - below[:, -1]
        yield {"row_id": batch.column("row_id"), "expected_grade": (1 - below).sum(axis=1), "tail_probability": tail, "kept": tail >= p.least_tail}

    return map_arrow(narrow(docs, row_id=id_col, text=text_col), work, schema).withColumnRenamed("row_id", id_col)
