"""Hierarchical packing of tokenised documents into context windows of several sizes.

Tiers are powers of two up to ``window``. A document's full windows are cut off at once.
What remains is routed to the smallest tier that holds it; a tier's window takes one such
remainder and its gap is filled from the shorter tiers, longest that fits first, the last
filler cut to close the gap exactly. What cannot fill a window at the end of a task is cut
into windows of smaller tiers, so nothing is padded. Windows are dealt into step groups of
equal tokens, each tier on its own, in the order of their piece counts back and forth.

Tasks pack what they read, in batches of bounded size; a retried task makes the same
windows again.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_right, insort
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import map_arrow

WINDOW, BUFFER, GROUP = 2048, 4096, 16  # tokens, remainders held by a task, full windows a step group
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, tier long, step_group long")
LONG = 400  # characters of a word or of a gap
_ODD, _LONE = re.compile(r"[^\x00-\u024f]|\s{400}"), re.compile(r"(?<=\S)(?= \S)")


#: Fixed value: how a byte-level BPE of this kind cuts text before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _merger(path: str):
    """A tiktoken encoding of the vocabulary in a byte-level BPE file, or None if the file
    is of another kind (its merges do not follow the order of its ids, or it cuts otherwise)."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    vocab, extra = model["vocab"], {t["content"] for t in spec["added_tokens"]}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocab.get(a + b, -1) for a, b in pairs]
    if model["type"] != "BPE" or spec["normalizer"] or cut.get("type") != "ByteLevel" or not cut.get("use_regex") \
            or cut.get("add_prefix_space") or made != sorted(made) or -1 in made:
        return None
    # printable bytes stand for themselves, the others for the characters from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(c): c for c in plain}
    byte |= {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in set(plain))}
    ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in extra}
    return tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """ids of byte-level BPE text as little-endian unsigned 32-bit bytes. Latin text without
    very long words or gaps goes to tiktoken over the same file, which gives the same ids
    for a third of the time. In other text a space that stands before a non-space always
    begins a token, so it is cut there and the ids of the parts remembered (at most ``keep``
    of them; a matter of speed alone). Text that spells an added token goes whole to the
    tokenizer."""

    def __init__(self, path: str, end: int | None = 1, keep: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.merger = _merger(path)
        self.known: dict[str, bytes] = {}
        self.keep, self.end = keep, b"" if end is None else end.to_bytes(4, "little")

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if any(t in text for t in self.added):  # its spelling is one id, as the tokenizer has it
            return self._raw([text])[0] + self.end
        if self.merger and not _ODD.search(text) and max(map(len, text.split(" "))) <= LONG:
            return array("I", self.merger.encode_ordinary(text)).tobytes() + self.end
        # runs of white space belong together: only a lone space between others is a border
        parts = _LONE.split(text)
        if len(self.known) > self.keep:
            self.known.clear()
        if new := list({p for p in parts if p not in self.known}):
            self.known.update(zip(new, self._raw(new)))
        return b"".join(map(self.known.__getitem__, parts)) + self.end


@lru_cache(maxsize=2)
def encoder_of(path: str, end: int | None) -> Encoder:
    """One per Python worker, so that its tasks share the known parts."""
    return Encoder(path, end)


class _Task:
    """Packs the remainders of one task."""

    def __init__(self, window: int, part: int):
        self.window, self.part, self.number = window, part, 0
        self.rows: list[tuple] = []
        self.waiting: list[tuple[int, int, int | None, int, bytes, int]] = []  # size, order, doc, start, ids, doc_tokens
        self.order = 0
        self.groups: dict[int, tuple[int, int]] = {}
        self.group_no = 0

    def close(self, pieces: list[tuple], tier: int) -> None:
        seq, at = (self.part << 32) + self.number, 0
        self.number += 1
        group, used = self.groups.get(tier, (0, 0))
        if not used:
            group = (self.part << 32) + self.group_no
            self.group_no += 1
        used += 1
        self.groups[tier] = (group, 0 if used * tier >= GROUP * self.window else used)
        for size, _, doc, start, ids, total in pieces:
            self.rows.append((doc, start, size, zlib.crc32(ids), total, seq, at, tier, group))
            at += size

    def add(self, doc: int | None, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        while total - start >= self.window:
            self.close([(self.window, 0, doc, start, ids[4 * start:4 * (start + self.window)], total)], self.window)
            start += self.window
        if start < total:
            self.order += 1
            self.waiting.append((total - start, self.order, doc, start, ids[4 * start:], total))

    def flush(self, last: bool) -> None:
        """Pack what waits; unless ``last`` the shortest that close no window wait on."""
        pool = sorted(self.waiting)
        self.waiting = []
        done: list[tuple[list, int]] = []
        while pool:
            first = pool.pop()
            tier = 1 << (first[0] - 1).bit_length()
            pieces, gap = [first], tier - first[0]
            while gap and pool:
                at = bisect_right(pool, (gap, float("inf")))
                if at:
                    piece = pool.pop(at - 1)
                    pieces.append(piece)
                    gap -= piece[0]
                else:  # the shortest is cut
                    size, order, doc, start, ids, total = pool.pop(0)
                    pieces.append((gap, order, doc, start, ids[:4 * gap], total))
                    insort(pool, (size - gap, order, doc, start + gap, ids[4 * gap:], total))
                    gap = 0
            if not gap:
                done.append((pieces, tier))
            elif not last:
                self.waiting += pieces
            else:  # windows of the smaller tiers: the binary digits of the rest
                rest = sum(p[0] for p in pieces)
                while rest:
                    size, own = 1 << (rest.bit_length() - 1), []
                    rest -= size
                    while size:
                        n, order, doc, start, ids, total = pieces.pop(0)
                        own.append((min(n, size), order, doc, start, ids[:4 * min(n, size)], total))
                        if n > size:
                            pieces.insert(0, (n - size, order, doc, start + size, ids[4 * size:], total))
                        size -= own[-1][0]
                    done.append((own, sum(p[0] for p in own)))
        done.sort(key=lambda w: (w[1], len(w[0])))
        for i in range(0, len(done), 2 * GROUP):  # back and forth: few-piece windows meet many-piece ones
            some = done[i:i + 2 * GROUP]
            for pieces, tier in some[::2] + some[1::2][::-1]:
                self.close(pieces, tier)


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end: int | None = 1,
         buffer: int = BUFFER) -> DataFrame:
    """One row per piece of (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, tier (the window's size) and step_group. Null and empty texts are
    the ``end`` id alone (no rows if there is none). Repeated rows are packed each on its
    own; a null doc_id keeps its pieces. ``window`` is a power of two. An empty table gives
    no rows; extra columns are ignored."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        context = TaskContext.get()
        encoder, task = encoder_of(tokenizer_path, end), _Task(window, context.partitionId() if context else 0)
        names = [f.split()[0] for f in SCHEMA.split(", ")]

        def take():
            rows, task.rows = task.rows, []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * len(names))], names)

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                task.add(doc, encoder.encode(text.as_py()))
                if len(task.waiting) >= buffer:
                    task.flush(False)
                if len(task.rows) >= 20_000:
                    yield take()
        task.flush(True)
        yield take()

    if window & (window - 1) or window < 1:
        raise ValueError("window must be a power of two")
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, SCHEMA)
