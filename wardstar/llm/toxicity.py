"""Toxic passages by maximum-scoring segments, calibrated by extreme values.

Words and their beginnings weigh their log-odds between toxic and clean labelled
documents under an informative Dirichlet prior; of a word and its beginnings the
most significant one counts. A linear scan finds every maximal segment of a text,
once for each label; its score is compared with the greatest score that chance gives
a text of that length, and a logistic curve over the significant ones gives the
probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from wardstar.llm.common import cut, emit, table, texts
from wardstar.llm.words import MARKED, Words

#: Labelled rows the model is fitted on, chosen by hash; and words it may hold.
SAMPLE_ROWS = 20_000
MODEL_WORDS = 20_000
#: Pseudo-counts of the prior, least and greatest significance asked of a word, and cost of any word.
PRIOR = 500.0
SIGNIFICANT = (3.0, 5.0)
DRIFT = 0.7
EULER = 0.5772156649015329


#: Bytes of the beginnings, so that endings do not hide a stem.
BEGINNINGS = (3, 4, 6)


class Law(NamedTuple):
    """The greatest segment score of n words by chance has the mean (log(k n) + Euler) / rate."""

    rate: float
    log_k: float = 0.0


class Model(NamedTuple):
    """Feature hashes (sorted) with weights and significance; the extreme-value law of toxic
    segments and that of clean ones; the logistic curve over the evidence."""

    words: np.ndarray
    weights: np.ndarray
    strength: np.ndarray
    law: Law
    clean_law: Law
    curve: tuple[float, ...]


class Segment(NamedTuple):
    """Words ``start`` up to ``stop`` of a document."""

    start: int
    stop: int
    score: float


def maximal_segments(scores: np.ndarray) -> list[Segment]:
    """Every maximal-scoring segment, left to right, in one linear scan.

    Runs of one sign move as a whole, so the scan's steps are runs of positive
    scores. A candidate is joined to the nearest one before it whose sum on the
    left is smaller, unless that one reached as high already.
    """
    positive = scores > 0
    if not positive.any():
        return []
    edge = np.diff(np.concatenate(([0], positive.view(np.int8), [0])))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    # Of each candidate: start, stop, sum before it, sum up to its end, and the
    # nearest earlier candidate with a smaller sum before it.
    stack: list[tuple[int, int, float, float, int]] = []
    for start, stop in zip(starts.tolist(), stops.tolist(), strict=True):
        left, right = float(sums[start]), float(sums[stop])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append((start, stop, left, right, j))
                break
            start, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [Segment(s, e, right - left) for s, e, left, right, _ in stack]


def features(words: Words) -> list[np.ndarray]:
    """For each word the hash of itself and those of its beginnings (0: none)."""
    return [words.hashes, *(words.prefixes(n) for n in BEGINNINGS)]


def word_scores(model: Model, words: Words) -> np.ndarray:
    """The log-odds of the most significant feature of each word, less the drift."""
    weight = np.zeros(len(words.hashes))
    strength = np.zeros(len(words.hashes))
    for hashes in features(words) if len(model.words) else []:
        at = np.minimum(np.searchsorted(model.words, hashes), len(model.words) - 1)
        better = (model.words[at] == hashes) & (model.strength[at] > strength)
        weight[better] = model.weights[at[better]]
        strength[better] = model.strength[at[better]]
    return weight - DRIFT


def clean_side(scores: np.ndarray) -> np.ndarray:
    """Of the scores of words, those for the other label."""
    return -scores - 2 * DRIFT


def significance(labelled: int) -> float:
    """What a word needs: few of so many chance deviations pass it, and few documents can reach it."""
    low, high = SIGNIFICANT
    return min(high, max(low, math.sqrt(2 * math.log(max(labelled, 1)))))


def normalized(law: Law, score: float, words: int) -> float:
    """A segment's score over what chance gives so many words; above 0 is significant."""
    return law.rate * score - law.log_k - math.log(max(words, 1))


def _side(law: Law, scores: np.ndarray) -> tuple[float, float]:
    """The greatest normalized score (from -10 on) and the log of the significant sum."""
    best, total = -10.0, 0.0
    for segment in maximal_segments(scores):
        value = normalized(law, segment.score, len(scores))
        best = max(best, value)
        total += max(value, 0.0)
    return best, math.log1p(total)


def evidence(model: Model, scores: np.ndarray) -> tuple[float, float, float, float]:
    """Greatest score and significant sum of the toxic segments, then of the clean ones."""
    return *_side(model.law, scores), *_side(model.clean_law, clean_side(scores))


def probability(model: Model, scores: np.ndarray) -> float:
    value = sum(a * x for a, x in zip(model.curve, (*evidence(model, scores), 1.0), strict=True))
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, value))))


def passages(model: Model, text: str) -> list[tuple[str, float]]:
    """The significant passages of a text with their normalized scores."""
    raw = text.encode()
    words = Words([raw], True, MARKED)
    out = []
    for s in maximal_segments(word_scores(model, words)):
        value = normalized(model.law, s.score, len(words.hashes))
        if value > 0:
            out.append((raw[words.starts[s.start] : words.ends[s.stop - 1]].decode(), value))
    return out


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from the documents that hold each feature, in ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1).

    Uses at most ``sample_rows`` labelled documents, the first by a hash of
    doc_id, and keeps at most MODEL_WORDS words, so what the driver holds is
    bounded. Null labels do not count; a document labelled twice has its largest
    label. Without documents of both labels no word weighs anything.
    """
    wanted = labels.where("label is not null and doc_id is not null")
    wanted = wanted.groupBy("doc_id").agg(F.max("label").alias("label"))
    # A limit by sorted hash is the sample's bound, not a bound on what is scored.
    wanted = wanted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = cut(docs.select("doc_id", "text").join(wanted, "doc_id"), "labelled")
    schema = pa.schema([("word", pa.int64()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in texts(batches):
            words = Words(found, True, MARKED)
            label = batch.column("label").to_numpy()
            for hashes in features(words):
                own = [
                    np.unique(hashes[first:last])
                    for first, last in zip(words.first[:-1], words.first[1:], strict=True)
                ]
                toxic = np.repeat(label == 1, [len(o) for o in own])
                distinct, place = np.unique(np.concatenate(own), return_inverse=True)
                n = np.bincount(place, minlength=len(distinct))
                t = np.bincount(place, toxic, len(distinct)).astype(np.int64)
                yield emit(schema, word=distinct.view(np.int64), toxic=t, clean=n - t)

    counts = rows.mapInArrow(count, "word long, toxic long, clean long")
    counts = cut(
        counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "word-counts",
    )
    sums = counts.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).first()
    kinds = 1 + len(BEGINNINGS)
    toxic_n, clean_n = (sums["t"] or 0) / kinds, (sums["c"] or 0) / kinds
    if not toxic_n or not clean_n:
        return Model(np.array([], np.uint64), np.array([]), np.array([]), Law(1.0), Law(1.0), (0, 0, 0, 0, -3))
    prior = F.lit(PRIOR / (toxic_n + clean_n)) * (F.col("toxic") + F.col("clean"))
    t, c = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(t / (toxic_n + PRIOR - t)) - F.log(c / (clean_n + PRIOR - c))
    share = F.lit(toxic_n / (toxic_n + clean_n))
    n = F.col("toxic") + F.col("clean")
    # The signed root of the likelihood ratio of the two counts against the shares.
    ratio = _times_log(F.col("toxic"), n * share) + _times_log(F.col("clean"), n * (1 - share))
    z = F.signum(odds) * F.sqrt(F.greatest(F.lit(0.0), 2 * ratio))
    p, q = c / (clean_n + PRIOR), t / (toxic_n + PRIOR)
    kept = (
        counts.select("word", odds.alias("odds"), z.alias("z"), p.alias("p"), q.alias("q"))
        .where((F.abs("z") >= significance(rows.count())) & (F.col("word") != 0))
        .orderBy(F.abs("z").desc(), "word")
        .limit(MODEL_WORDS)
        .collect()
    )
    words = np.array([r["word"] for r in kept], np.int64).view(np.uint64)
    order = np.argsort(words)
    weights = np.array([r["odds"] for r in kept])[order]
    strength = np.array([abs(r["z"]) for r in kept])[order]
    law, clean_law = (
        Law(_rate(sign * weights - DRIFT, np.array([r[chance] for r in kept])[order] / kinds))
        for sign, chance in ((1, "p"), (-1, "q"))
    )
    model = Model(words[order], weights, strength, law, clean_law, ())
    tops = _evidence(rows, model).collect()
    model = model._replace(
        law=_fitted_law(law, [(r["n"], r["best"]) for r in tops if r["label"] == 0]),
        clean_law=_fitted_law(clean_law, [(r["n"], r["clean_best"]) for r in tops if r["label"] != 0]),
    )
    found = _evidence(rows, model).collect()
    x = np.array([(r["best"], r["total"], r["clean_best"], r["clean_total"], 1.0) for r in found])
    return model._replace(curve=_curve(x, np.array([r["label"] for r in found], float)))


def _fitted_law(law: Law, tops: list[tuple[int, float]]) -> Law:
    """The law with the constant that texts of the other label show, from (words, greatest score)."""
    seen = [law.rate * top - math.log(n) - EULER for n, top in tops if n]
    return law._replace(log_k=max(-10.0, float(np.mean(seen))) if seen else 0.0)


def _times_log(seen, expected):
    return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)


def _rate(scores: np.ndarray, chance: np.ndarray) -> float:
    """The positive root of the mean of exp(rate * score) = 1 over clean words."""
    rest = max(0.0, 1.0 - chance.sum())

    def mean(rate: float) -> float:
        return float((chance * np.exp(rate * scores)).sum() + rest * math.exp(-rate * DRIFT))

    low, high = 1e-6, 1.0
    while mean(high) < 1 and high < 32:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return high


def _evidence(rows: DataFrame, model: Model) -> DataFrame:
    """Per labelled document: words, the evidence (without a curve only raw greatest scores), label."""
    names = ("best", "total", "clean_best", "clean_total")
    schema = pa.schema(
        [("n", pa.int64()), *[(name, pa.float64()) for name in names], ("label", pa.int64())]
    )
    raw = not model.curve and model.law.log_k == 0.0 and model.clean_law.log_k == 0.0

    def top(scores: np.ndarray) -> float:
        return max((s.score for s in maximal_segments(scores)), default=0.0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in texts(batches):
            words = Words(found, True, MARKED)
            scores = word_scores(model, words)
            out = []
            for first, last in zip(words.first[:-1], words.first[1:], strict=True):
                own = scores[first:last]
                out.append((top(own), 0.0, top(clean_side(own)), 0.0) if raw else evidence(model, own))
            labels = batch.column("label").to_numpy().astype(np.int64)
            columns = dict(zip(names, zip(*out, strict=True), strict=True))
            yield emit(schema, n=words.counts(), **columns, label=labels)

    return rows.mapInArrow(
        score, f"n long, {', '.join(f'{name} double' for name in names)}, label long"
    )


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic weights of the evidence and a constant.

    Evidence for a label never speaks against it: a column whose weight has the wrong
    sign is left out, so few documents cannot turn the order round.
    """
    used = x * 1.0
    while True:
        w = _logistic(used, y)
        wrong = [i for i, sign in enumerate((1, 1, -1, -1)) if w[i] * sign < 0]
        if not wrong:
            return tuple(w.tolist())
        used[:, max(wrong, key=lambda i: abs(w[i]))] = 0.0


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic weights by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``, the probability that a document is toxic.

    Only the text counts. Null and empty texts get the score of no evidence; all
    other columns come through, but for one named ``score``, which is replaced.
    """
    kept = docs.drop("score")
    result = StructType([*kept.schema.fields]).add("score", DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in texts(batches):
            words = Words(found, True, MARKED)
            scores = word_scores(model, words)
            values = [
                probability(model, scores[first:last])
                for first, last in zip(words.first[:-1], words.first[1:], strict=True)
            ]
            yield batch.append_column("score", pa.array(values, pa.float64()))

    return kept.mapInArrow(run, result)


def fold(key: str, parts: int) -> F.Column:
    """The crc32 of a key's text, modulo the number of parts."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of ``labels.toxic`` from the rows that are not held out."""
    kept = labels.where(fold("doc_id", 3) != 1)
    return fit(docs, kept.select("doc_id", F.col("toxic").alias("label")))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fitted(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
