"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Per-coordinate rates and an L1 term leave most weights at zero; the others travel as a
sorted array of (bucket, weight)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import map_arrow

#: Fitting takes at most this many labelled rows of each label, of texts of at most so many bytes.
TRAIN_ROWS, TRAIN_BYTES, EPOCHS = 2000, 40_000, 12
THRESHOLD, BITS, SKIP = 0.7, 20, 2
_MIX = np.uint64(0x9E3779B97F4A7C15)
_EDGE = b".,;:!?\"'()[]{}#*$%&|<>-_"


def buckets(text: str | None) -> np.ndarray:
    """Sorted distinct hashed buckets of the whole text's words, 2-grams and skip-grams
    (up to ``SKIP`` words between), lower-cased, without the punctuation around a word."""
    from xxhash import xxh64_intdigest

    ids: dict[bytes, int] = {}
    words = (text or "").lower().encode("utf-8").split()
    for w in words:
        if w not in ids:
            ids[w] = xxh64_intdigest(w.strip(_EDGE), 7)
    code = np.array([ids[w] for w in words], dtype=np.uint64)
    grams = [code]
    for gap in range(1, SKIP + 2):
        if len(code) > gap:
            grams.append(code[:-gap] * np.uint64(1_000_003) + code[gap:] + np.uint64(gap))
    return np.unique((np.concatenate(grams) * _MIX) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    index: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, spots: np.ndarray) -> float:
        at = np.searchsorted(self.index, spots)
        at[at == len(self.index)] = 0
        hit = self.index[at] == spots if len(self.index) else np.zeros(len(spots), bool)
        m = self.bias + float(self.weight[at[hit]].sum())
        return float(1 / (1 + np.exp(-min(60.0, max(-60.0, m)))))


def fit_rows(rows: list[np.ndarray], labels: list[int], alpha: float = 1.0, beta: float = 1.0,
             l1: float = 15.0, l2: float = 1.0, epochs: int = EPOCHS, toxic_weight: float = 3.0) -> Model:
    """FTRL-proximal over the rows in the given order, ``epochs`` times; toxic rows weigh
    ``toxic_weight``."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    zb = nb = bias = 0.0
    for _ in range(epochs):
        for spots, y in zip(rows, labels):
            zi, ni = z[spots], n[spots]
            w = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))
            bias = -zb / ((beta + nb ** 0.5) / alpha)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
            g = (p - y) * (toxic_weight if y else 1.0)
            n[spots] = ni + g * g
            z[spots] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            zb, nb = zb + g - ((nb + g * g) ** 0.5 - nb ** 0.5) / alpha * bias, nb + g * g
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    index = np.flatnonzero(w)
    return Model(index, w[index], float(-zb / ((beta + nb ** 0.5) / alpha)))


def fit(labelled: DataFrame, rows: int = TRAIN_ROWS, **options) -> Model:
    """Fit on a bounded sample of (doc_id, text, toxic): of each label the ``rows`` rows with
    the smallest hash of doc_id among texts of at most ``TRAIN_BYTES`` bytes, hashed on the
    executors. Without rows every text scores one half; rows without a label are left out."""
    use = labelled.where(f"text IS NOT NULL AND octet_length(text) <= {TRAIN_BYTES}")
    some = []
    for v in (0, 1):
        some += [(r.h, r.text, v) for r in use.where(F.col("toxic") == v).select(
            F.xxhash64("doc_id").alias("h"), "doc_id", "text").orderBy("h", "doc_id", "text").limit(rows).collect()]
    some.sort()
    return fit_rows([buckets(t) for _, t, _ in some], [v for *_, v in some], **options)


def score_toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 at ``threshold`` or more). Null and empty texts
    score by the bias alone; equal texts score alike; a null doc_id stays; an empty table
    gives no rows; extra columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 2**BITS weights

    def run(batches):
        import pyarrow as pa

        m = shared.value
        for b in batches:
            s = [m.score(buckets(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s, pa.float64()), pa.array([int(x >= threshold) for x in s], pa.int32())],
                ["doc_id", "score", "predicted"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run,
                     "doc_id long, score double, predicted int")
