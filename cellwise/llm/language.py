"""Language identification by a string kernel, Nystroem landmarks and kernel ridge regression.

The kernel of two texts is the blended spectrum kernel with presence bits: for n = 1, 2, 3, 4
the number of n-grams of lower-case letters that occur in both, over the root of the product
of the numbers that occur in each, averaged over n. A word is read with a blank on either
side. n-grams of bytes are numbered by a hash into ``SPACE`` slots for each n.

Texts are mapped to their kernels with ``LANDMARKS`` training texts (Nystroem), and one ridge
regression per language is fitted to them. A block of texts is scored by two matrix products:
presence bits by the landmarks' normalised bits, and kernels by the weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks

SIZES = (1, 2, 3, 4)
SPACE = 1 << 13
LANDMARKS = 128
SAMPLE_ROWS = 3_000
RIDGE = 1e-3

_MAP = np.full(256, 32, np.uint8)
_MAP[97:123] = _MAP[65:91] = np.arange(97, 123)
_MAP[128:] = np.arange(128, 256)


def presence(column) -> np.ndarray:
    """A row of len(SIZES) * SPACE bits for each text: which n-grams occur."""
    data, offsets = blocks.text_bytes(column)
    bits = np.zeros((len(column), len(SIZES) * SPACE), bool)
    data = _MAP[data].astype(np.uint32)
    # Capital letters of two bytes (U+00C0 to U+00DE) are read as small ones.
    upper = np.flatnonzero((data[1:] >= 128) & (data[1:] < 0x9F) & (data[:-1] == 0xC3)) + 1
    data[upper] += 32
    for r in range(len(column)):
        own = data[offsets[r] : offsets[r + 1]]
        own = np.concatenate([[np.uint32(32)], own, [np.uint32(32)]])
        own = own[~((own == 32) & (np.concatenate([[0], own[:-1]]) == 32))]
        code = np.zeros(len(own), np.uint32)
        for i, n in enumerate(SIZES):
            if len(own) < n:
                break
            code = (code[: len(own) - n + 1] * np.uint32(0x9E3779B1)) ^ own[n - 1 :]
            code ^= code >> np.uint32(15)
            bits[r, i * SPACE + (code * np.uint32(0x85EBCA6B) >> np.uint32(19))] = True
    return bits


def _normal(bits: np.ndarray) -> np.ndarray:
    """Bits over the roots of their numbers, so that a product of rows is the kernel."""
    wide = bits.reshape(len(bits), len(SIZES), SPACE)
    norm = np.sqrt(np.maximum(wide.sum(2), 1) * len(SIZES))
    return (wide / norm[:, :, None]).reshape(bits.shape).astype(np.float32)


@dataclass
class Classifier:
    names: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def predict(self, column) -> tuple[list[str], np.ndarray]:
        """Names and scores in 0 to 1 of a column of texts."""
        if not self.names:
            return ["und"] * len(column), np.zeros(len(column))
        kernels = _normal(presence(column)) @ self.landmarks.T
        values = np.concatenate([kernels, np.ones((len(column), 1), np.float32)], 1) @ self.weights
        powers = np.exp(4 * (values - values.max(1, keepdims=True)))
        shares = powers / powers.sum(1, keepdims=True)
        best = shares.argmax(1)
        return [self.names[b] for b in best], shares[np.arange(len(best)), best].astype(float)


def fit(bits: np.ndarray, names: list[str], seed: int = 3) -> Classifier:
    """One-versus-rest ridge weights over landmark kernels; landmarks are dealt over the languages.

    ``bits`` holds a row of packed presence bits for each training text.
    """
    known = sorted(set(names))
    if not known:
        return Classifier([], np.zeros((0, 0)), np.zeros((0, 0)))
    random = np.random.default_rng(seed)
    order = random.permutation(len(names))
    turn = {name: 0 for name in known}
    ranks = []
    for i in order:
        ranks.append((turn[names[i]], i))
        turn[names[i]] += 1

    def normal(rows) -> np.ndarray:
        return _normal(np.unpackbits(bits[rows], axis=1).astype(bool))

    landmarks = normal([i for _, i in sorted(ranks)[:LANDMARKS]])
    kernels = np.concatenate([normal(slice(i, i + 64)) @ landmarks.T for i in range(0, len(names), 64)])
    wide = np.concatenate([kernels, np.ones((len(names), 1))], 1).astype(float)
    want = np.array([[1.0 if n == k else -1.0 for k in known] for n in names])
    # Every language weighs the same, however many rows it has.
    count = {k: names.count(k) for k in known}
    weight = np.array([1 / count[n] for n in names])[:, None]
    # The norm of a function over the landmarks is that of their own kernel: this is kernel ridge
    # regression in the span of the landmarks. A trace of the identity keeps equal landmarks solvable.
    norm = np.eye(wide.shape[1]) * 1e-6
    norm[:-1, :-1] += landmarks @ landmarks.T
    left = wide.T @ (wide * weight) + RIDGE * norm * len(known) / wide.shape[1]
    return Classifier(known, landmarks, np.linalg.solve(left, wide.T @ (want * weight)).astype(np.float32))


def held_out(doc_id: Column) -> Column:
    """Rows whose language is never learned from; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def train(docs: DataFrame, lang: str, doc_id: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> Classifier:
    """A classifier fitted to about ``rows`` rows with text and language, chosen by a hash of id and text.

    Whole texts are read where they lie. Only their presence bits, a fixed number a row, come to
    the driver, so what it holds is bounded however long the texts are.
    """
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).rlike("\\p{L}"))
    n = usable.count()
    if n > rows:
        usable = usable.where(F.pmod(F.xxhash64(F.col(doc_id), F.col(text), F.lit(29)), F.lit(1 << 62)) < (rows << 62) // n)

    def collect_bits(batches):
        for block in blocks.cut(batches, "t"):
            for at in range(0, block.num_rows, 256):
                batch = block.slice(at, 256)
                packed = [own.tobytes() for own in np.packbits(presence(batch.column("t")), axis=1)]
                yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("y"), pa.array(packed, pa.binary())], ["k", "y", "bits"])

    kind = docs.schema[doc_id].dataType.simpleString()
    chosen = usable.select(F.col(doc_id).alias("k"), F.col(text).alias("t"), F.col(lang).cast("string").alias("y"))
    found = chosen.mapInArrow(collect_bits, f"k {kind}, y string, bits binary").toArrow()
    found = found.sort_by([("k", "ascending"), ("bits", "ascending"), ("y", "ascending")])
    width = len(SIZES) * SPACE // 8
    bits = np.frombuffer(b"".join(found.column("bits").to_pylist()), np.uint8).reshape(-1, width)
    return fit(bits, found.column("y").to_pylist())


def identify(docs: DataFrame, model: Classifier, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row; ``und`` with score 0 where there is no letter."""
    sent = docs.sparkSession.sparkContext.broadcast((model.names, model.landmarks, model.weights))

    def work(batches):
        classifier = Classifier(*sent.value)
        for block in blocks.cut(batches, "t", 1 << 20):
            for at in range(0, block.num_rows, 256):
                batch = block.slice(at, 256)
                names, scores = classifier.predict(batch.column("t"))
                empty = ~np.array([t is not None and any(map(str.isalpha, t)) for t in batch.column("t").to_pylist()], bool)
                names = ["und" if e else n for n, e in zip(names, empty, strict=True)]
                scores[empty] = 0
                yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(names), pa.array(scores)], ["k", "lang_pred", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t"))
    return rows.mapInArrow(work, f"k {kind}, lang_pred string, score double").withColumnRenamed("k", doc_id)


def language(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row.

    Learned from rows that are not held out. Repeated ids are judged row by row. With no
    labelled row every prediction is ``und``.
    """
    seen = docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t"), F.col(lang).alias("y"))
    model = train(seen.where(~held_out(F.col("k"))), "y", "k", "t")
    found = identify(seen, model, "k", "t")
    return found.select(F.col("k").alias(doc_id), held_out(F.col("k")).alias("held_out"), "lang_pred", "score")
