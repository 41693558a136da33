"""Language identification with a blended-spectrum presence kernel.

k(x, z) = |G(x) & G(z)| / sqrt(|G(x)| |G(z)|), G(x) the set of the byte n-grams (1 to
``max_n``) of the lower-cased text, hashed to ``buckets``. Nystroem landmarks are labelled
texts; the classifier is one-versus-rest kernel ridge regression on the landmark features.
Every text is scored whole: its presence vector against the landmarks' matrix, a batch of
texts at a time.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewatch.llm.common import cut, map_arrow

UNDETERMINED = "und"
#: Fitting uses at most this many labelled texts of a language and in all, of at most so many
#: bytes; this many landmarks, or four a language where that is more.
TRAIN_PER_LANGUAGE, TRAIN_ROWS, TRAIN_BYTES, LANDMARKS = 150, 3000, 20_000, 128
RANKERS = 64
_BLOCK = 1 << 20
_CODEC = np.uint64(0x9E3779B97F4A7C15)


def presence(text: str, max_n: int = 4, buckets: int = 1 << 16) -> np.ndarray:
    """Boolean vector of the hashed byte n-grams present in the whole text."""
    raw = np.frombuffer(text.lower().encode("utf-8"), dtype=np.uint8)
    out = np.zeros(buckets, dtype=bool)
    shift = np.uint64(64 - buckets.bit_length() + 1)
    for at in range(0, len(raw), _BLOCK):
        part = raw[at:at + _BLOCK + max_n - 1].astype(np.uint64)  # overlaps: no n-gram is lost
        code = np.zeros(len(part), dtype=np.uint64)
        for n in range(1, max_n + 1):
            if len(part) < n:
                break
            code = (code[:len(part) - n + 1] << np.uint64(8)) | part[n - 1:]
            out[((code + np.uint64(n << 40)) * _CODEC) >> shift] = True
    return out


@dataclass
class Model:
    languages: list[str]
    bits: np.ndarray  # landmark x bucket / 8: the presence vectors, packed
    weights: np.ndarray  # landmark x language
    max_n: int
    buckets: int

    @cached_property
    def landmarks(self) -> np.ndarray:
        """landmark x bucket, rows scaled by 1 / sqrt(|G(z)|); made where it is used."""
        marks = np.unpackbits(self.bits, axis=1, count=self.buckets).astype(np.float32)
        return marks / np.sqrt(np.maximum(marks.sum(axis=1, keepdims=True), 1))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "landmarks"}

    def kernel(self, grams: np.ndarray) -> np.ndarray:
        size = np.sqrt(np.maximum(grams.sum(axis=1), 1)).astype(np.float32)
        return (grams.astype(np.float32) @ self.landmarks.T) / size[:, None]

    def scores(self, grams: np.ndarray) -> np.ndarray:
        return self.kernel(grams) @ self.weights


def fit_rows(texts: list[str], langs: list[str], max_n: int = 4, buckets: int = 1 << 16,
             landmarks: int = LANDMARKS, ridge: float = 1e-3) -> Model:
    """Fit on local labelled rows, in the given order (landmarks are dealt over languages)."""
    names = sorted(set(langs))
    grams = np.array([presence(t, max_n, buckets) for t in texts]).reshape(len(texts), buckets)
    y = np.array([names.index(x) for x in langs], dtype=int)
    turn = sorted(range(len(y)), key=lambda i: (int((y[:i] == y[i]).sum()), y[i]))
    marks = np.packbits(grams[turn[:max(landmarks, 4 * len(names))]], axis=1)
    model = Model(names, marks, np.zeros((len(marks), len(names)), np.float32), max_n, buckets)
    if len(names):
        k = np.concatenate([model.kernel(grams[i:i + 64]) for i in range(0, len(grams), 64)]).astype(np.float64)
        kmm = k[turn[:len(marks)]]
        target = np.where(y[:, None] == np.arange(len(names))[None, :], 1.0, -1.0)
        a = k.T @ k + ridge * len(y) * kmm + 1e-8 * np.eye(len(kmm))
        model.weights = np.linalg.solve(a, k.T @ target).astype(np.float32)
    return model


def fit(labelled: DataFrame, per_language: int = TRAIN_PER_LANGUAGE, rows: int = TRAIN_ROWS,
        max_bytes: int = TRAIN_BYTES, **options) -> Model:
    """Fit on a bounded sample of (doc_id, text, lang): of each language the rows with the
    smallest hash of doc_id among those of at most ``max_bytes`` bytes, ``per_language`` of them
    but together no more than ``rows`` (one a language at least). Every language is learned. Ids
    and hashes alone are ranked; the texts are then read for the chosen ones. Equal rows count
    once."""
    usable = labelled.where(f"lang IS NOT NULL AND text IS NOT NULL AND octet_length(text) <= {max_bytes}")
    keys = usable.selectExpr("lang", "doc_id", "xxhash64(doc_id) AS h", "xxhash64(text) AS th").distinct()
    # ranked in RANKERS groups of input partitions first: a language's last ranking, one task, sees
    # RANKERS x per_language ids however many partitions there are
    place = F.row_number().over(W.partitionBy("lang").orderBy("h", "doc_id", "th"))
    ahead = F.row_number().over(W.partitionBy("lang", "part").orderBy("h", "doc_id", "th"))
    some = keys.withColumn("part", F.spark_partition_id() % RANKERS).withColumn("place", ahead).where(
        f"place <= {int(per_language)}").drop("part")
    chosen = cut(some.withColumn("place", place).where(f"place <= {int(per_language)}"), "chosen")
    languages = chosen.select("lang").distinct().count()
    each = max(1, min(per_language, rows // max(1, languages)))
    wanted = chosen.where(f"place <= {each}").selectExpr("lang AS _l", "doc_id AS _d", "th AS _t", "place AS _p")
    taken = usable.join(F.broadcast(wanted), F.expr("lang = _l AND doc_id <=> _d AND xxhash64(text) = _t")).select(
        "lang", "_p", "text").distinct().collect()  # at most ``rows`` texts, or one a language
    taken = sorted(taken, key=lambda r: (r["lang"], r["_p"], r["text"]))
    return fit_rows([r["text"] for r in taken], [r["lang"] for r in taken], **options)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of (doc_id, text). ``score`` is the winner's one-versus-rest
    value mapped from [-1, 1] to [0, 1]. Null texts, texts without a letter and an unfitted
    model give ``und`` with score 0; equal texts get equal rows; ties go to the language
    that sorts first."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # landmarks x buckets: a fixed size

    def run(batches):
        import pyarrow as pa

        m = shared.value
        for b in batches:
            texts = b.column(1).to_pylist()
            known = [i for i, t in enumerate(texts) if m.languages and t and any(map(str.isalpha, t))]
            lang, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            if known:
                s = m.scores(np.array([presence(texts[i], m.max_n, m.buckets) for i in known]))
                for i, row, best in zip(known, s, s.argmax(axis=1)):
                    lang[i], score[i] = m.languages[best], float(min(1.0, max(0.0, (row[best] + 1) / 2)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "lang_pred", "score"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run,
                     "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, min_score: float = 0.25) -> DataFrame:
    """The rows of ``docs`` whose text has a letter and a language at ``min_score`` or more
    (below a quarter every one-versus-rest value clearly says no). Null texts go; repeated
    rows, null ids and extra columns stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns

    def run(batches):
        import pyarrow as pa

        m = shared.value
        for b in batches:
            texts = b.column(columns.index("text")).to_pylist()
            known = [i for i, t in enumerate(texts) if m.languages and t and any(map(str.isalpha, t))]
            if known:
                s = m.scores(np.array([presence(texts[i], m.max_n, m.buckets) for i in known])).max(axis=1)
                keep = [i for i, x in zip(known, s) if (x + 1) / 2 >= min_score]
                if keep:
                    yield b.take(pa.array(keep))

    return map_arrow(docs, run, docs.schema)
