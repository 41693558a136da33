"""SimHash near duplicates through a segment-popcount embedding.

A 64-bit fingerprint is read as 32 segments of two bits. A segment's bit count (0..2) is
kept in unary (00, 01, 11), so the Manhattan distance of two count vectors is the number
of differing bits of the embedded words, and it never exceeds the Hamming distance of the
fingerprints. Of three differences at most one falls into one of the two halves, so the
grid join looks up every half's cell and the cells one step above it. Pairs that meet are
held to the Manhattan bound and then verified on the fingerprints.

Distinct fingerprints only are joined, so copies cost nothing beyond one aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import apart, cut, map_arrow
from tidewatch.llm.graph import components

BLOCK = 1 << 16


def fingerprint(text: str | None, width: int = 3) -> int:
    """Unsigned 64-bit SimHash of the ``width``-word shingles of the whole text."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z and \x20 \x09-\x0D only
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    width = min(width, n)
    lo = [0, *ends[:n - width].tolist()]
    hi = (ends[width - 1:] - 1).tolist()
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(lo), BLOCK):
        h = np.array([xxh64_intdigest(joined[s:e], 42)
                      for s, e in zip(lo[at:at + BLOCK], hi[at:at + BLOCK])], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(lo), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """All columns of ``docs`` but its last, ``text``, and fp (the 64 bits as a signed long)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            fp = np.array([fingerprint(t, width) for t in b.column(b.num_columns - 1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(fp.view(np.int64), pa.int64())], [*b.schema.names[:-1], "fp"])

    kept = ", ".join(f"{n} {t}" for n, t in docs.dtypes[:-1])
    return map_arrow(docs, run, f"{kept}, fp long")


_LOW = "6148914691236517205L"  # 0x5555555555555555
_UNARY = f"((fp | shiftrightunsigned(fp, 1)) & {_LOW}) | (shiftleft(fp & shiftrightunsigned(fp, 1) & {_LOW}, 1))"
_HALVES = ("explode(array(struct(0 AS half, t & 4294967295L AS cell), "
           "struct(1 AS half, shiftrightunsigned(t, 32) AS cell))) AS h")


def links(distinct_fp: DataFrame, max_bits: int = 3) -> DataFrame:
    """(u, v) pairs of different fingerprints at ``max_bits`` (1 to 3) or fewer bits."""
    if not 1 <= max_bits <= 3:
        raise ValueError("the two-half grid covers 1 to 3 bits")
    cells = distinct_fp.selectExpr("fp", f"{_UNARY} AS t").selectExpr("fp", "t", _HALVES) \
        .selectExpr("fp", "t", "h.half", "h.cell")
    # one step up in one segment: 00 -> 01 or 01 -> 11 sets one more bit of the unary word
    step = ("explode(concat(array(0L), filter(transform(sequence(0, 15), j -> CASE "
            "WHEN (shiftright(cell, 2 * j) & 3L) = 0 THEN shiftleft(1L, 2 * j) "
            "WHEN (shiftright(cell, 2 * j) & 3L) = 1 THEN shiftleft(2L, 2 * j) END), "
            "x -> x IS NOT NULL))) AS up")
    probes = cells.selectExpr("fp AS fp2", "t AS t2", "half", "cell", step) \
        .selectExpr("fp2", "t2", "half", "cell | up AS cell", "up")
    return cells.join(probes, ["half", "cell"]).where(
        f"fp <> fp2 AND (up <> 0 OR fp < fp2) AND bit_count(t ^ t2) <= {max_bits} "
        f"AND bit_count(fp ^ fp2) <= {max_bits}").selectExpr("fp AS u", "fp2 AS v")


def _named(docs: DataFrame, width: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of ``docs``, and fp, first_id, root of the distinct ones (``root``: the
    fingerprint that stands for the component)."""
    fps = cut(fingerprints(docs, width), "fp")
    least = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fpset")
    roots = components(links(least.select("fp"), max_bits))
    return fps, least.join(roots, least.fp == roots.node, "left").selectExpr(
        "fp", "first_id", "coalesce(root, fp) AS root")


def simhash_components(docs: DataFrame, width: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable over links).

    Null and wordless texts have fingerprint zero and link like any other; repeated rows
    and ids stay one row each; a null doc_id keeps its row and never names a component
    unless it holds no other id (then null). Extra columns are ignored; an empty table
    gives no rows.
    """
    fps, named = _named(docs.select(F.col("doc_id").cast("long"), "text"), width, max_bits)
    named = named.join(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "root")
    return fps.join(named.select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, width: int = 3, max_bits: int = 3) -> DataFrame:
    """Keep one row of every component, all columns: the least by (doc_id, hash of the text,
    hash of the row), a null doc_id last. Rows of other components stay, whatever their ids:
    several rows may share an id or have none. Of rows equal in every column one stays. Null
    and wordless texts are one component; an empty table gives no rows; extra columns pass
    through whatever their names."""
    return apart(docs, lambda d: _survivors(d, width, max_bits))


def _survivors(docs: DataFrame, width: int, max_bits: int) -> DataFrame:
    plain = ", ".join(f"`{c}`" for c, t in docs.dtypes if "map<" not in t and "variant" not in t)
    hashes = "xxhash64(text) AS _th", f"xxhash64({plain}) AS _rh"
    fps, named = _named(docs.selectExpr("cast(doc_id AS long) AS doc_id", *hashes, "text"), width, max_bits)
    keep = fps.join(named.select("fp", "root"), "fp").groupBy("root").agg(F.min(F.struct(
        F.expr("doc_id IS NULL AS n"), "doc_id", "_th", "_rh")).alias("k")).selectExpr(
        "k.doc_id AS _id", "k._th AS _t", "k._rh AS _r")
    rows = docs.selectExpr("*", *hashes).join(
        keep, F.expr("doc_id <=> _id AND _th = _t AND _rh = _r"), "left_semi")
    return rows.dropDuplicates(["doc_id", "_th", "_rh"]).select(*docs.columns)
