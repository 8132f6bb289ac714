"""Toxicity by a factorization machine over hashed terms.

A text's terms are its lower-case words (letters only) and the first four and five bytes of
longer words, hashed into ``BUCKETS``; a term counts once. The machine scores

    b + sum_i w_i + 1/2 sum_f [(sum_i v_if x)^2 - sum_i v_if^2 x^2],  x = 1 / sqrt(terms),

so that pairs of terms (an insult and a group it is aimed at) weigh more or less together
than alone. It is fitted by proximal Adagrad on a bounded sample of labelled rows, with an L1
term that keeps uninformative words at zero; terms in fewer than ``MIN_DOCS`` sampled rows
have no weight. Scores are calibrated on rows left out of the fit in turn.

Scoring is one pass over the documents with no shuffle. Only the model, whose size is fixed
by ``BUCKETS`` and ``FACTORS``, is sent to the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks

BUCKETS = 1 << 18
FACTORS = 4
SAMPLE_ROWS = 6_000
MIN_DOCS = 4
EPOCHS = 20
FOLDS = 3
# The L1 term is this over the root of the number of rows: fewer rows, fewer words with a weight.
PENALTY = 0.035
# Where the sums of squared slopes start: a word seen once or twice moves little.
FIRST_SLOPE = 1e-3
THRESHOLD = 0.3

_LOWER = blocks.lower_ascii()
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[65:91] = True
_LETTER[128:] = True


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, terms: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of each row, which has the terms first[r] to first[r + 1]."""
        return 1 / (1 + np.exp(-np.clip(self._margin(terms, first), -30, 30)))

    def _margin(self, terms: np.ndarray, first: np.ndarray) -> np.ndarray:
        counts = np.diff(first)
        rows = np.repeat(np.arange(len(counts)), counts)
        linear = np.bincount(rows, self.weights[terms], len(counts))
        v = self.factors[terms]
        total = np.stack([np.bincount(rows, v[:, f], len(counts)) for f in range(v.shape[1])], 1)
        squares = np.bincount(rows, (v * v).sum(1), len(counts))
        return self.bias + linear + 0.5 * ((total**2).sum(1) - squares) / np.maximum(counts, 1)


def hashed_terms(column) -> tuple[np.ndarray, np.ndarray]:
    """Distinct term numbers of each text, and where each text's begin."""
    data, offsets = blocks.text_bytes(column)
    data = _LOWER[data]
    starts, ends, first = blocks.words(data, offsets, _LETTER)
    rows = np.repeat(np.arange(len(column)), np.diff(first))
    roll = blocks.rolling(2)
    sums = roll.sums(data)
    parts, owners = [roll.windows(sums, starts, ends)], [rows]
    for size in (4, 5):
        longer = ends - starts > size
        parts.append(roll.windows(sums, starts[longer], size) + np.uint64(size))
        owners.append(rows[longer])
    keys = (np.concatenate(owners).astype(np.uint64) << np.uint64(32)) | (np.concatenate(parts) % np.uint64(BUCKETS))
    keys.sort()
    keys = keys[blocks.first_in_group(keys)]
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.int32), np.searchsorted(keys >> np.uint64(32), np.arange(len(column) + 1))


def fit(terms: np.ndarray, first: np.ndarray, labels: np.ndarray, seed: int = 5) -> Machine:
    """Learns from rows of terms and 0/1 labels; with one class only, scores are its share.

    The margins of rows that a fit has not seen (each of ``FOLDS`` parts by the others) give the
    slope and offset that turn margins into probabilities. Both go into the machine itself.
    """
    model = _descend(terms, first, labels, seed)
    if labels.sum() < FOLDS or (1 - labels).sum() < FOLDS:
        return model
    part = np.empty(len(labels), np.int64)
    for y in (0, 1):
        same = np.random.default_rng(seed + y).permutation(np.flatnonzero(labels == y))
        part[same] = np.arange(len(same)) % FOLDS
    unseen = np.empty(len(labels))
    for f in range(FOLDS):
        learned = _descend(*_rows(terms, first, part != f), labels[part != f], seed)
        unseen[part == f] = learned._margin(*_rows(terms, first, part == f))
    slope, offset = calibration(unseen, labels)
    return Machine(slope * model.bias + offset, slope * model.weights, np.sqrt(slope) * model.factors)


def calibration(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over margins, by Newton steps.

    A weak prior draws them to 1 and 0, which they keep where there is little to learn from.
    """
    at, prior, pull = np.array([1.0, 0.0]), np.array([1.0, 0.0]), np.array([4.0, 0.4])
    wide = np.stack([margins, np.ones(len(margins))], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(wide @ at, -30, 30)))
        move = np.linalg.solve((wide * (p * (1 - p))[:, None]).T @ wide + np.diag(pull), wide.T @ (p - labels) + pull * (at - prior))
        at = at - np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-9:
            break
    return max(float(at[0]), 0.1), float(at[1])


def _rows(terms: np.ndarray, first: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.diff(first)
    return terms[np.repeat(chosen, counts)], np.concatenate([[0], np.cumsum(counts[chosen])])


def _descend(terms: np.ndarray, first: np.ndarray, labels: np.ndarray, seed: int) -> Machine:
    random = np.random.default_rng(seed)
    n = len(labels)
    share = (labels.sum() + 0.5) / (n + 1)
    bias, weights, factors = float(np.log(share / (1 - share))), np.zeros(BUCKETS), np.zeros((BUCKETS, FACTORS))
    if n == 0 or labels.min() == labels.max():
        return Machine(bias, weights, factors)
    known = np.flatnonzero(np.bincount(terms, minlength=BUCKETS) >= MIN_DOCS)
    number = np.full(BUCKETS, -1, np.int32)
    number[known] = np.arange(len(known))
    sizes = np.maximum(np.diff(first), 1)
    used = number[terms] >= 0
    first, terms = np.concatenate([[0], np.cumsum(used)])[first], number[terms[used]]
    w, v = np.zeros(len(known)), random.normal(0, 0.05, (len(known), FACTORS))
    seen_w, seen_v = np.full(w.shape, FIRST_SLOPE), np.full(v.shape, FIRST_SLOPE)
    flag, place = np.zeros(len(known), bool), np.zeros(len(known), np.int64)
    rate, l1, l2 = 0.15, PENALTY / np.sqrt(n), 1e-4
    lengths = np.diff(first)
    for _ in range(EPOCHS):
        order = random.permutation(n)
        for chosen in np.array_split(order, max(1, n // 64)):
            counts = lengths[chosen]
            at = np.repeat(first[chosen] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
            own = terms[at]
            rows = np.repeat(np.arange(len(chosen)), counts)
            full = sizes[chosen]
            near = v[own]
            total = np.stack([np.bincount(rows, near[:, f], len(chosen)) for f in range(FACTORS)], 1)
            margin = bias + np.bincount(rows, w[own], len(chosen))
            margin += 0.5 * ((total**2).sum(1) - np.bincount(rows, (near * near).sum(1), len(chosen))) / full
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]) / len(chosen)
            bias -= rate * error.sum()
            flag[own] = True
            touched = np.flatnonzero(flag)
            flag[touched] = False
            place[touched] = np.arange(len(touched))
            group = place[own]
            slope = np.bincount(group, error[rows], len(touched))
            seen_w[touched] += slope**2
            step = rate / np.sqrt(seen_w[touched])
            moved = w[touched] - step * slope
            w[touched] = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0)
            each = (error / full)[rows, None] * (total[rows] - near)
            slope_v = np.stack([np.bincount(group, each[:, f], len(touched)) for f in range(FACTORS)], 1) + l2 * v[touched]
            seen_v[touched] += slope_v**2
            v[touched] -= rate * 0.3 * slope_v / np.sqrt(seen_v[touched])
    weights[known], factors[known] = w, v
    return Machine(float(bias), weights, factors)


def train(docs: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> Machine:
    """A machine fitted to the rows with a label of 0 or 1, or to about ``rows`` of them.

    The sample is chosen by a hash of the id, and its hashed terms (not its texts) come to the
    driver, so the driver holds a bounded amount at any size of the input.
    """
    labelled = docs.where(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("k"), F.col(text).alias("t"), F.col(label).cast("int").alias("y"))
    kind = docs.schema[doc_id].dataType.simpleString()
    n = labelled.count()
    if n > rows:
        labelled = labelled.where(F.pmod(F.xxhash64("k", F.lit(17)), F.lit(1 << 50)) < rows * (1 << 50) // n)

    def collect_terms(batches):
        for batch in blocks.cut(batches, "t"):
            terms, first = hashed_terms(batch.column("t"))
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("y"), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(terms))], ["k", "y", "terms"])

    found = labelled.mapInArrow(collect_terms, f"k {kind}, y int, terms array<int>").toArrow().sort_by([("k", "ascending"), ("y", "ascending")]).combine_chunks()
    if found.num_rows == 0:
        return fit(np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0))
    lists = pa.concat_arrays(found.column("terms").chunks)
    first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
    return fit(lists.flatten().to_numpy(zero_copy_only=False), first, found.column("y").to_numpy().astype(float))


def score(docs: DataFrame, model: Machine, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row; a null or empty text scores the bias."""
    sent = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights.astype(np.float32), model.factors.astype(np.float32)))

    def work(batches):
        machine = Machine(*sent.value)
        for batch in blocks.cut(batches, "t"):
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(machine.scores(*hashed_terms(batch.column("t"))))], ["k", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t"))
    return rows.mapInArrow(work, f"k {kind}, score double").withColumnRenamed("k", doc_id)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def accepted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, doc_id, text, label))

    def work(batches):
        for batch in blocks.cut(batches, text):
            yield batch.filter(pa.array(sent.value.scores(*hashed_terms(batch.column(text))) < threshold))

    return docs.mapInArrow(work, docs.schema)


def trained(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> Machine:
    """A machine from the labelled rows that are not held out."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.max(label).cast("int").alias("y"))
    texts = docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t"))
    return train(texts.where(~held_out(F.col("k"))).join(known, F.col("k") == F.col("id")), "y", "k", "t")


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Labels are joined by id; an id with several different labels takes the highest. Rows
    without a usable label are scored and not learned from. Repeated ids are scored row by row.
    """
    model = trained(docs, labels, doc_id, text, label)
    texts = docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t"))
    scored = score(texts, model, "k", "t")
    return scored.select(F.col("k").alias(doc_id), held_out(F.col("k")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
