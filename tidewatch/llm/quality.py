"""Quality rules: fixed base rules, and a calibrated logistic regression over hashed word
and character n-grams trained on labelled rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import map_arrow

#: Fitting takes at most this many labelled rows of each label, of texts of at most so many bytes.
TRAIN_ROWS, TRAIN_BYTES = 800, 20_000
MIN_WORDS, MAX_REPEAT, WINDOW, KEEP_AT = 20, 30, 8, 0.5
SYMBOLS = "#*$%&|<>"
BUCKETS = 1 << 14
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 20


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of the whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8").split()  # bytes split on \x20 \x09-\x0D alone
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            dup += line in seen
            seen.add(line)
    repeat = 0
    if n >= WINDOW:
        ids: dict[bytes, int] = {}
        code = np.array([ids.setdefault(w, len(ids)) for w in words])
        # numbers of the equal windows, by doubling: 2, 4, 8 words; exact, no hashing
        for step in (1, 2, 4):
            pairs = code[:-step] * np.int64(code.max() + 1) + code[step:]
            code = np.unique(pairs, return_inverse=True)[1].reshape(-1)
        often = np.bincount(code)[code] > 1
        edge = np.zeros(n + 1, dtype=np.int64)
        np.add.at(edge, np.flatnonzero(often), 1)
        np.add.at(edge, np.flatnonzero(often) + WINDOW, -1)
        repeat = int((np.cumsum(edge[:-1]) > 0).sum())
    return n, chars, sum(map(text.count, SYMBOLS)), dup, repeat


def _spots(code: np.ndarray) -> np.ndarray:
    return ((code * _MIX) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def features(text: str) -> np.ndarray:
    """Square roots of hashed counts of word 1- and 2-grams and character 1- to 4-grams,
    scaled to length one, over the whole text."""
    from zlib import crc32

    data = text.encode("utf-8")
    out = np.zeros(BUCKETS, dtype=np.float64)
    raw = np.frombuffer(data, dtype=np.uint8)
    for at in range(0, len(raw), _BLOCK):
        size = min(_BLOCK, len(raw) - at)
        part = raw[at:at + size + 3].astype(np.uint64)
        code = np.zeros(len(part), dtype=np.uint64)
        for n in range(1, min(4, len(part)) + 1):
            code = (code[:len(part) - n + 1] << np.uint64(8)) | part[n - 1:]
            out += np.bincount(_spots(code[:size] + np.uint64(n << 40)), minlength=BUCKETS)
    ids: dict[bytes, int] = {}
    for w in (words := data.split()):
        if w not in ids:
            ids[w] = crc32(w)
    code = np.array([ids[w] for w in words], dtype=np.uint64)
    out += np.bincount(_spots(code + np.uint64(1 << 50)), minlength=BUCKETS)
    if len(code) > 1:
        out += np.bincount(_spots(code[:-1] * np.uint64(1_000_003) + code[1:] + np.uint64(1 << 51)),
                           minlength=BUCKETS)
    out = np.sqrt(out)
    return (out / max(np.linalg.norm(out), 1e-9)).astype(np.float32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float  # Platt calibration
    shift: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -60, 60)))


def _logistic(x: np.ndarray, y: np.ndarray, l2: float, steps: int) -> tuple[np.ndarray, float]:
    """Class-balanced logistic regression by Nesterov's gradient method."""
    w, b, v, vb = np.zeros(x.shape[1], x.dtype), 0.0, np.zeros(x.shape[1], x.dtype), 0.0
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    rate = 1 / (0.25 * max((x ** 2).sum(axis=1).max(initial=1e-9) + 1, 1) + l2)
    for t in range(steps):
        g = share * (1 / (1 + np.exp(-np.clip(x @ v + vb, -60, 60))) - y)
        g = g.astype(x.dtype)
        nw, nb = v - x.dtype.type(rate) * (x.T @ g + x.dtype.type(l2) * v), vb - rate * float(g.sum())
        v, vb = nw + x.dtype.type(t / (t + 3)) * (nw - w), nb + t / (t + 3) * (nb - b)
        w, b = nw, nb
    return w, float(b)


def fit_rows(texts: list[str], labels: list[int]) -> Model | None:
    """Fit on three of four rows, calibrate on the fourth. None without both labels."""
    y = np.array(labels, dtype=np.float64)
    if len(set(labels)) < 2:
        return None
    x = np.array([features(t) for t in texts])
    held = np.arange(len(y)) % 4 == 3
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held[:] = False
    w, b = _logistic(x[~held], y[~held].astype(np.float32), 1e-5, 200)
    model = Model(w.astype(np.float32), float(b), 1.0, 0.0)
    if held.any():
        m = model.margin(x[held])
        scale = max(float(np.abs(m).std()), 1e-6)
        a, c = _logistic((m / scale)[:, None].astype(np.float64), y[held], 1e-3, 500)
        if a[0] > 0:
            model.slope, model.shift = float(a[0] / scale), float(c)
    return model


def fit(labelled: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on a bounded sample of (doc_id, text, label): of each label the ``rows`` rows with
    the smallest hash of doc_id among texts of at most ``TRAIN_BYTES`` bytes."""
    from itertools import zip_longest

    use = labelled.where(f"text IS NOT NULL AND octet_length(text) <= {TRAIN_BYTES}")
    by = [[(r.text, v) for r in use.where(F.col(label) == v).orderBy(
        F.xxhash64("doc_id"), "doc_id", "text").select("text").limit(rows).collect()] for v in (0, 1)]
    some = [r for pair in zip_longest(*by) for r in pair if r]
    return fit_rows([t for t, _ in some], [v for _, v in some])


def quality_rules(docs: DataFrame, model: Model | None, keep_at: float = KEEP_AT) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    score (the calibrated probability of good quality; null without a model). Null and
    empty texts count as no words and fail. Repeated rows get equal rows, a null doc_id
    stays; an empty table gives no rows; extra columns are ignored. Without a model (no rows of
    one label) the base rules alone decide."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights: a fixed size
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches):
        import pyarrow as pa

        m = shared.value
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            got = [measures(t) for t in texts]
            failed = [g[0] < MIN_WORDS or 100 * g[4] > MAX_REPEAT * g[0] for g in got]
            score = [None] * len(texts) if m is None else [
                float(m.probability(features(t)[None, :])[0]) for t in texts]
            kept = [not f and (s is None or s >= keep_at) for f, s in zip(failed, score)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in (zip(*got) if got else [[]] * 5)),
                 pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_()), pa.array(score, pa.float64())],
                ["doc_id", *names, "base_failed", "kept", "score"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run,
                     "doc_id long, " + ", ".join(f"{n} long" for n in names)
                     + ", base_failed boolean, kept boolean, score double")
