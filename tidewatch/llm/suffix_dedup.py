"""Removal of long byte strings that occur more than once, by column-wise construction.

Every window of ``LENGTH`` bytes has an anchor, its byte group of least hash (the first of
equal ones), so equal windows are anchored at the same place of themselves. The starts that
share an anchor are cut into segments of at most ``STEP`` starts at fixed distances from it;
all windows of a segment cover the same middle bytes, and the hash of these is the segment's
key. Strings that repeat therefore meet under one key and stand in the same column of the
key's collection. A first count of keys alone leaves those seen twice (through a filter of
bounded size, then exactly); equal segments are put together with their number.

The collection of a key is built column by column from the last to the first: each round
reads one symbol of every segment, sorts the order of the column before by it without
disturbing ties, which is the Burrows-Wheeler transform's step, and updates the common
prefixes of neighbours from the least prefix between them. Rounds read and write whole arrays
in sequence. As equal strings share a column, a round needs only the column before it, not
the columns already left behind. A start whose neighbour shares ``LENGTH`` bytes is repeated.

A key with very many different segments is dealt into parts of about ``PART``; a part then
passes on one digest of every different window it holds, and Spark finds those of several
parts, so no key's segments are gathered in one task.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import cut, map_arrow
from tidewatch.llm.hash_filter import hash_filter, holds
from tidewatch.session import checkpoint_path

LENGTH, GRAM, STEP = 400, 16, 64  # bytes of a string, of an anchor; starts of a segment at most
PART, _PIECE, _ROWS = 8192, 1 << 20, 16384  # segments of a part; bytes and segments handled at once
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_R = 0x9E3779B97F4A7C15 | 1
_SEGMENT = "key long, off int, m int, body_hash long"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


class Segments:
    """Segments of byte texts for one setting of the lengths."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM, step: int = STEP):
        if gram % 8 or not 8 <= gram <= length or not 1 <= step <= 64 or length - step + 1 < 8:
            raise ValueError("gram in eights up to length; step 1 to 64, at most length - 7")
        self.length, self.gram, self.step = length, gram, step
        # powers of an odd number and of its inverse, for sums of any range
        size = _PIECE + length + 1
        self.power = np.cumprod(np.r_[np.uint64(1), np.full(size, _R, dtype=np.uint64)])
        self.back = np.cumprod(np.r_[np.uint64(1), np.full(size, pow(_R, -1, 2 ** 64), dtype=np.uint64)])

    def find(self, raw: bytes, begin: np.ndarray, end: np.ndarray):
        """Of texts (or parts of them) that stand at begin..end of ``raw``: the places of first
        starts, places relative to the segment's first, numbers of starts, keys, body hashes."""
        length, gram, step = self.length, self.gram, self.step
        n, reach = len(raw), length - gram + 1
        empty = np.zeros(0, np.int64)
        if n < length:
            return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
        word = np.ndarray((n,), dtype="<u8", buffer=raw + bytes(8), strides=(1,)).astype(np.uint64)
        term = _mixed(word)
        group = term[:n - gram + 1]
        for i in range(8, gram, 8):
            group = _mixed(group * np.uint64(31) + term[i:n - gram + 1 + i])
        place = np.arange(len(group), dtype=np.uint64)
        order = (group & np.uint64(0xFFFFFFFF00000000)) | place
        # least of every ``reach`` neighbours from running minima of blocks, forward and backward
        blocks = np.full(-(-len(order) // reach) * reach, np.uint64(2 ** 64 - 1))
        blocks[:len(order)] = order
        blocks = blocks.reshape(-1, reach)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = n - length + 1
        anchor = (np.minimum(behind[:starts], ahead[reach - 1:reach - 1 + starts]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        s = np.arange(starts)
        text = np.searchsorted(begin, s, side="right") - 1
        valid = s + length <= end[text]
        q = (s - anchor + reach - 1) // step
        fresh = np.r_[True, (anchor[1:] != anchor[:-1]) | (q[1:] != q[:-1]) | (text[1:] != text[:-1])
                      | (valid[1:] != valid[:-1])]
        lo = np.flatnonzero(fresh)
        m = np.diff(np.r_[lo, starts])
        ok = valid[lo]
        lo, m = lo[ok], m[ok]
        base = anchor[lo] - (reach - 1) + q[lo] * step
        total = np.cumsum(np.r_[np.uint64(0), term * self.power[:n]])

        def digest(a, b, salt):  # of the bytes a..b, wherever they stand
            return _mixed((total[b - 7] - total[a]) * self.back[a] + salt)

        key = digest(base + step - 1, base + length, _mixed(q[lo].astype(np.uint64) + np.uint64(77)))
        return lo, lo - base, m, key, digest(lo, lo + m - 1 + length, (lo - base).astype(np.uint64))

    def of_texts(self, texts):
        """(number of the text, place, off, m, key, body hash) arrays for an iterable of (number,
        bytes), a bounded piece at a time."""
        held, size = [], 0

        def take():
            raw = b"".join(p for _, _, p in held)
            end = np.cumsum([len(p) for _, _, p in held])
            begin = end - np.array([len(p) for _, _, p in held])
            lo, off, m, key, body = self.find(raw, begin, end)
            at = np.searchsorted(begin, lo, side="right") - 1
            number = np.array([i for i, _, _ in held])[at]
            place = lo - begin[at] + np.array([x for _, x, _ in held], dtype=np.int64)[at]
            return number, place, off, m, key.view(np.int64), body.view(np.int64)

        for i, raw in texts:
            for x in range(0, len(raw) - self.length + 1, _PIECE // 2):
                part = raw[x:x + _PIECE // 2 + self.length - 1]  # overlaps: every start is in one part
                if size + len(part) > _PIECE:
                    yield take()
                    held, size = [], 0
                held.append((i, x, part))
                size += len(part)
        if held:
            yield take()


def build(group: np.ndarray, off: np.ndarray, m: np.ndarray, bodies: list[bytes], width: int, length: int):
    """Column-wise construction over segments whose ``group`` numbers do not fall. Yields, from
    the last column of starts to the first, (column, order, common): the segments in the order
    of their bytes from that column on, within groups, and the common bytes of each with the
    one before it (-1 where the group changes)."""
    rows = len(bodies)
    size = np.array([len(b) for b in bodies], dtype=np.int64)
    cells = np.full((rows, width), 256, dtype=np.int32)  # 256: no byte there
    flat = np.repeat(np.arange(rows) * width + off, size) + (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
    cells.ravel()[flat] = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    order = np.arange(rows)
    border = np.r_[True, group[1:] != group[:-1]]  # groups keep their places in every order
    number = np.cumsum(border) - 1
    common = np.where(border, -1, 0)
    columns = np.ascontiguousarray(cells.T)
    for c in range(width - 1, -1, -1):
        symbol = columns[c][order]
        turn = np.argsort(number * 512 + symbol, kind="stable")
        symbol = symbol[turn]
        same = ~border[1:] & (symbol[1:] == symbol[:-1])
        # of two with the same symbol, what lies between them in the order before
        first, last = turn[:-1][same] + 1, turn[1:][same] + 1
        spans = np.stack([first, last], axis=1).ravel()
        least = np.minimum.reduceat(np.r_[common, 0], spans)[::2] if len(spans) else spans
        common = np.where(border, -1, 0)
        common[1:][same] = least + 1
        order = order[turn]
        yield c, order, common


def repeated(keys: np.ndarray, parts: np.ndarray, off, m, bodies: list[bytes], split: np.ndarray, length: int, step: int):
    """(mask per segment of its repeated starts, [(segment, column, digest)] of every different
    window of the segments of ``split`` keys). Rows stand in order of (key, part)."""
    rows = len(bodies)
    mask = np.zeros(rows, dtype=np.uint64)
    windows = []
    if not rows:
        return mask, windows
    group = np.cumsum(np.r_[True, (keys[1:] != keys[:-1]) | (parts[1:] != parts[:-1])])
    for c, order, common in build(group, off, m, bodies, step + length - 1, length):
        if c >= step:
            continue
        like = common >= length  # as the one before
        hit = like | np.r_[like[1:], False]
        own = (off[order] <= c) & (c < off[order] + m[order])
        at = order[hit & own]
        mask[at] |= np.uint64(1) << (c - off[at]).astype(np.uint64)
        for r in order[own & ~like & split[order]].tolist():
            x = c - int(off[r])
            windows.append((r, c, hashlib.blake2b(bodies[r][x:x + length], digest_size=16).digest()))
    return mask, windows


def _texts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id with the hashes t1, t2 of its text; and the distinct texts with their copies, once
    in buckets of these hashes, so that the joins below move no text."""
    spark = docs.sparkSession
    text = "coalesce(text, '')"
    base = docs.selectExpr("cast(doc_id AS long) AS doc_id", f"xxhash64({text}) AS t1", f"xxhash64(1, {text}) AS t2",
                           f"{text} AS text")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"llm_texts_{uuid.uuid4().hex}"
    base.groupBy("t1", "t2").agg(F.count("*").alias("copies"), F.first("text").alias("text")).write.bucketBy(
        buckets, "t1", "t2").option("path", checkpoint_path(spark, name)).saveAsTable(name)
    return base.drop("text"), spark.table(name)


def _segments(texts: DataFrame, length: int, gram: int, step: int, wanted=None) -> DataFrame:
    """Keys alone with ``wanted`` None, or else the segments whose key the filter may hold."""

    def run(batches):
        import pyarrow as pa

        cutter = Segments(length, gram, step)
        for b in batches:
            t1, t2, copies = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            texts = enumerate(t.as_py() for t in b.column(3).cast("binary"))  # short ones have no part
            for number, place, off, m, key, body in cutter.of_texts(texts):
                if wanted is None:
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(copies[number])], ["key", "copies"])
                    continue
                ok = holds(wanted.value, key)
                of = number[ok]
                yield pa.RecordBatch.from_arrays([
                    pa.array(t1[of]), pa.array(t2[of]), pa.array(copies[of]), pa.array(place[ok]), pa.array(key[ok]),
                    pa.array(off[ok].astype(np.int32)), pa.array(m[ok].astype(np.int32)), pa.array(body[ok])],
                    ["t1", "t2", "copies", "place", "key", "off", "m", "body_hash"])

    return map_arrow(texts.select("t1", "t2", "copies", "text"), run, "key long, copies long" if wanted is None else
                     f"t1 long, t2 long, copies long, place long, {_SEGMENT}")


def _bodies(texts: DataFrame, need: DataFrame, length: int) -> DataFrame:
    """The bytes of the different segments of ``need``, each from one text that holds it."""
    by_text = need.groupBy("at.t1", "at.t2").agg(F.collect_list(
        F.struct("at.place", "key", "off", "m", "body_hash", "part", "parts")).alias("s"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for text, some in zip(b.column(0).cast("binary"), b.column(1)):
                raw, rows = text.as_py(), some.values
                place, m = (rows.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("place", "m"))
                for at in range(0, len(rows), 4096):
                    part = rows.slice(at, 4096)
                    body = [raw[p:p + k - 1 + length] for p, k in zip(place[at:at + 4096], m[at:at + 4096])]
                    yield pa.RecordBatch.from_arrays(
                        [part.field(n) for n in ("key", "part", "parts", "off", "m", "body_hash")]
                        + [pa.array(body, pa.binary())], ["key", "part", "parts", "off", "m", "body_hash", "body"])

    return map_arrow(texts.join(by_text, ["t1", "t2"]).select("text", "s"), run,
                     "key long, part long, parts long, off int, m int, body_hash long, body binary")


def _verdicts(bodies: DataFrame, length: int, step: int) -> DataFrame:
    """Segments with the mask of their repeated starts (col null), and the windows of dealt keys."""

    def run(batches):
        import pyarrow as pa

        names = ["key", "off", "m", "body_hash", "mask", "part", "col", "digest"]

        def take(t):
            t = t.combine_chunks()
            key, part, parts, off, m, body_hash = (t.column(i).to_numpy().astype(np.int64) for i in range(6))
            mask, windows = repeated(key, part, off, m, t.column(6).to_pylist(), parts > 1, length, step)
            ok = np.flatnonzero(mask)
            none = len(ok)
            r = np.array([w[0] for w in windows], dtype=np.int64)
            for at, last in ((ok, [pa.array(mask[ok].view(np.int64)), pa.nulls(none, pa.int64()), pa.nulls(none, pa.int32()),
                                   pa.nulls(none, pa.binary())]),
                             (r, [pa.nulls(len(r), pa.int64()), pa.array(part[r]),
                                  pa.array([w[1] for w in windows], pa.int32()), pa.array([w[2] for w in windows], pa.binary())])):
                yield pa.RecordBatch.from_arrays([
                    pa.array(key[at]), pa.array(off[at].astype(np.int32)), pa.array(m[at].astype(np.int32)),
                    pa.array(body_hash[at]), *last], names)

        held = None
        for b in batches:
            if not b.num_rows:
                continue
            own = pa.Table.from_batches([b])
            held = own if held is None else pa.concat_tables([held, own])
            if held.num_rows >= _ROWS:  # up to the last border between groups; a group is bounded
                key, part = (held.column(i).to_numpy() for i in (0, 1))
                borders = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1]))
                if len(borders):
                    yield from take(held.slice(0, int(borders[-1]) + 1))
                    held = held.slice(int(borders[-1]) + 1)
        if held is not None and held.num_rows:
            yield from take(held)

    return map_arrow(bodies.repartition("key", "part").sortWithinPartitions("key", "part"), run,
                     f"{_SEGMENT}, mask long, part long, col int, digest binary")


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, step: int = STEP, part: int = PART) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row of (doc_id, text): every byte
    covered by a string of ``length`` bytes that starts anywhere else as well is removed.

    Texts are UTF-8 bytes, null texts empty; strings never cross texts but may overlap within
    one. Texts shorter than ``length`` keep all. Repeated rows are copies of each other and lose
    all they have, from ``length`` bytes on; null and repeated ids stay one row each. An empty
    table gives no rows; extra columns are ignored. One text is held by one task."""
    identity = ["key", "off", "m", "body_hash"]
    base, texts = _texts(docs)
    twice = _segments(texts, length, gram, step).groupBy("key").agg(F.sum("copies").alias("n")).where("n > 1").select("key")
    twice = cut(twice, "keys")
    wanted = docs.sparkSession.sparkContext.broadcast(hash_filter(twice.select(F.col("key").alias("h"))))
    live = cut(_segments(texts, length, gram, step, wanted).join(twice, "key", "left_semi"), "segments")
    contents = cut(live.groupBy(*identity).agg(F.sum("copies").alias("n"), F.min(F.struct("t1", "t2", "place")).alias("at")),
                   "contents")
    # equal segments repeat whole; the others of a key that has several are to be compared
    several = contents.groupBy("key").agg(F.count("*").alias("k"), F.min("n").alias("least")).where("k > 1 AND least = 1")
    need = contents.join(several, "key").withColumn("parts", F.expr(f"1 + (k - 1) div {part}")).withColumn(
        "part", F.expr("pmod(body_hash, parts)"))
    verdicts = cut(_verdicts(_bodies(texts, need, length), length, step), "verdicts")
    windows = verdicts.where("col IS NOT NULL")
    across = windows.groupBy("key", "col", "digest").agg(F.min("part").alias("a"), F.max("part").alias("b")).where(
        "a < b").select("key", "col", "digest")
    found = verdicts.where("col IS NULL").select(*identity, "mask").union(
        windows.join(across, ["key", "col", "digest"], "left_semi").selectExpr(*identity, "shiftleft(1L, col - off) AS mask"))
    whole = contents.where("n > 1").selectExpr(*identity, "shiftrightunsigned(-1L, 64 - m) AS mask")
    # written, so that the join below can split a segment that very many texts hold
    masks = cut(whole.union(found).groupBy(*identity).agg(F.expr("bit_or(mask)").alias("mask")), "masks")
    spans = live.where("copies = 1").join(masks, identity).groupBy("t1", "t2").agg(
        F.collect_list(F.struct("place", "mask")).alias("s"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            for t1, t2, copies, text, some in zip(*(c.to_pylist() for c in b.columns[:3]), b.column(3).cast("binary"), b.column(4)):
                raw = text.as_py()
                n = len(raw)
                if copies > 1 or not some.is_valid:
                    gone = n if copies > 1 and n >= length else 0
                    out.append((t1, t2, n, gone, int(gone > 0), hashlib.sha256(b"" if gone else raw).hexdigest()))
                    continue
                place, mask = (some.values.field(i).to_numpy(zero_copy_only=False) for i in ("place", "mask"))
                bits = np.unpackbits(np.ascontiguousarray(mask).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                row, bit = np.nonzero(bits)
                step_at = np.zeros(n + 1, dtype=np.int32)
                start = place[row] + bit
                np.add.at(step_at, start, 1)
                np.add.at(step_at, start + length, -1)
                gone = np.cumsum(step_at)[:n] > 0
                kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
                out.append((t1, t2, n, int(gone.sum()), int((gone & ~np.r_[False, gone[:-1]]).sum()),
                            hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if i == 5 else pa.int64()) for i, c in enumerate(zip(*out) if out else [[]] * 6)],
                ["t1", "t2", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    done = cut(map_arrow(texts.join(spans, ["t1", "t2"], "left").select("t1", "t2", "copies", "text", "s"), run,
                         "t1 long, t2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"), "kept")
    return base.join(done, ["t1", "t2"]).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
