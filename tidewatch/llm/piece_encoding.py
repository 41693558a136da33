"""SentencePiece encoding and decoding, by the model file's own type.

BPE files (``encode_as_model``): merges never cross a word mark, as no piece holds a mark
behind another character, so texts are merged word by word by the sentencepiece library, with
a memory of merged words, and giant texts are cut before word marks into chunks for separate
tasks. A giant text without marks stays one chunk.

Unigram files (``encode``, which reads any file's pieces and scores as a lattice): the
segmentation with the largest total score (ties go to the longest last piece), a character
without a piece is encoded as its bytes. Ordinary texts are solved word by word, too.

A giant text is cut into chunks of characters. State j at a border means that the last cut
lies j characters before it. A chunk's transfer matrix holds the best score from each entry
state to each exit state; the matrices combine associatively in the max-plus semiring, which
gives the best score of every state at every border. With these, each chunk finds the entry
state that each exit state leads back to; composing those maps from the right fixes all
borders, and every chunk is traced back on its own. Scores are those of the file, of 32 bits:
their sums in 64 bits are exact up to about 2^29, so the order of adding does not matter.
"""

from __future__ import annotations

import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import cut, map_arrow

MARK = "▁"
GIANT, CHUNK = 100_000, 32_768  # characters: texts above GIANT are chunked
NO = float("-inf")
BPE, UNIGRAM = 2, 1  # model types of the file format
_WORD = re.compile(f"{MARK}+[^{MARK}]*")
_BORDER = re.compile(f"(?<!{MARK}){MARK}")


class Pieces:
    """The pieces of a SentencePiece model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        self.kind = [2 if sp.is_byte(i) else 1 if sp.is_control(i) or sp.is_unknown(i) else 0 for i in range(n)]
        plain = [i for i in range(n) if not self.kind[i]]
        self.score = {self.text[i]: (sp.get_score(i), i) for i in plain}
        self.byte = {int(self.text[i][1:-1], 16): i for i in range(n) if self.kind[i] == 2}
        self.longest = max(map(len, self.score))
        self.unknown = min(s for s, _ in self.score.values()) - 10
        # every prefix of a piece, with the piece's score or none
        self.look = {p[:k]: None for p in self.score for k in range(1, len(p) + 1)}
        self.look |= {p: s for p, (s, _) in self.score.items()}
        self.by_word = not any(MARK in p.lstrip(MARK) for p in self.score)
        self.raw = [bytes([int(self.text[i][1:-1], 16)]) if k == 2 else b"" if k else self.text[i].encode("utf-8")
                    for i, k in enumerate(self.kind)]
        self.known: dict[str, bytes] = {}

    def edges(self, s: str, at: int) -> list[tuple[int, float]]:
        """(end, score) of the pieces that start at ``at``; one character always has an edge."""
        out, end = [], at + 1
        while end <= len(s) and (hit := self.look.get(s[at:end], NO)) != NO:
            if hit is not None:
                out.append((end, hit))
            end += 1
        if not out or out[0][0] != at + 1:
            out.append((at + 1, self.unknown))
        return out

    def ids(self, piece: str) -> list[int]:
        hit = self.score.get(piece)
        return [hit[1]] if hit else [self.byte.get(b, 0) for b in piece.encode("utf-8")]

    def forward(self, s: str, first: int, entry: dict[int, float]) -> tuple[list[float], list[int]]:
        """Best score and last cut of each place of ``s``. ``entry``: the scores of the cuts at
        or before ``first``; pieces of a cut before it end behind it."""
        best, back = [NO] * (len(s) + 1), [-1] * (len(s) + 1)
        for at, v in entry.items():
            best[at] = v
        for at in range(len(s)):
            v = best[at]
            if v == NO:
                continue
            for end, w in self.edges(s, at):
                if end > first and (v + w > best[end]):  # earlier starts come first: ties keep the longest
                    best[end], back[end] = v + w, at
        return best, back

    def trace(self, s: str, back: list[int], end: int, first: int) -> tuple[list[int], int]:
        cuts = [end]
        while cuts[-1] > first:
            cuts.append(back[cuts[-1]])
        cuts.reverse()
        return [i for a, b in zip(cuts, cuts[1:]) for i in self.ids(s[a:b])], cuts[0]

    def solve(self, s: str) -> list[int]:
        """``forward`` from one entry and ``trace`` in one, for words: every place is reached."""
        look, n, unknown = self.look.get, len(s), self.unknown
        best, back = [NO] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        for at in range(n):
            v, end = best[at], at + 1
            if (w := look(s[at:end], NO)) is None or w == NO:
                if v + unknown > best[end]:
                    best[end], back[end] = v + unknown, at
            while w != NO:
                if w is not None and v + w > best[end]:
                    best[end], back[end] = v + w, at
                end += 1
                if end > n:
                    break
                w = look(s[at:end], NO)
        out, end = [], n
        while end:
            piece = s[back[end]:end]
            end -= len(piece)
            if hit := self.score.get(piece):
                out.append(hit[1])
            else:
                out += self.ids(piece)[::-1]
        return out[::-1]

    def word(self, w: str) -> list[int]:
        """The ids of a word mark and ``w``."""
        return self.solve(MARK + w)

    def encode(self, text: str | None) -> bytes:
        """The ids as 32-bit integers in the machine's order."""
        if not text:
            return b""
        if not self.by_word:
            return array("i", self.solve(MARK + text.replace(" ", MARK))).tobytes()
        if len(self.known) > 300_000:  # memory for speed alone
            self.known.clear()
        if MARK in text or "  " in text or text[-1] == " " or text[0] == " ":
            # runs of marks stand before the word that follows
            words = [w[1:] for w in _WORD.findall(MARK + text.replace(" ", MARK))]
        else:
            words = text.split(" ")
        for w in {w for w in words if w not in self.known}:
            self.known[w] = array("i", self.word(w)).tobytes()
        return b"".join(map(self.known.__getitem__, words))

    def decode(self, ids) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")[1:]

    def matrix(self, s: str, first: int, width: int) -> np.ndarray:
        """Transfer matrix (entry state x exit state) of the chunk s[first:]."""
        best = np.full((len(s) + 1, width), NO)
        for i in range(min(width, first + 1)):
            best[first - i, i] = 0.0
        for at in range(len(s)):
            row = best[at]
            if at <= first or row.max() > NO:
                for end, w in self.edges(s, at):
                    if end > first:
                        np.maximum(best[end], row + w, out=best[end])
        out = np.full((width, width), NO)
        for j in range(min(width, len(s) - first)):
            out[:, j] = best[len(s) - j]
        return out


class Merges(Pieces):
    """The pieces of a BPE model file, applied by the library."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        super().__init__(path)
        self.library = SentencePieceProcessor(model_file=path)
        spec = _proto(path).normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not (
                spec.add_dummy_prefix and spec.escape_whitespaces):
            raise ValueError("only models that leave texts as they are, behind one word mark")

    def word(self, w: str) -> list[int]:
        return self.library.encode(w) if w else self.ids(MARK)

    def encode(self, text: str | None) -> bytes:
        if self.by_word or not text:
            return super().encode(text)
        return array("i", self.library.encode(text)).tobytes()

    def chunks(self, text: str, chunk: int) -> list[str]:
        """Pieces of ``text`` of ``chunk`` characters or more, cut before word marks: each
        without its first mark; the ids of the text are theirs in turn."""
        if not self.by_word:
            return [text]
        t, at, out = MARK + text.replace(" ", MARK), 0, []
        while hit := _BORDER.search(t, at + chunk):
            if hit.start() == len(t) - 1:  # a mark alone would be an empty text
                break
            out.append(t[at + 1:hit.start()])
            at = hit.start()
        return [*out, t[at + 1:]]


def _proto(path: str):
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    return proto


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One per Python worker, so that its tasks share the solved words."""
    return Pieces(path)


def _chunks(docs: DataFrame, width: int, giant: int, chunk: int) -> DataFrame:
    """doc (a hash of id and text), no, first, s: chunks with ``width - 1`` characters before."""
    size = f"ceil((length(text) + 1) / {chunk})"
    return docs.where(f"length(text) > {giant}").selectExpr(
        "doc_id", "xxhash64(doc_id, text) AS doc", "concat('▁', replace(text, ' ', '▁')) AS t",
        f"explode(sequence(0, cast({size} AS int) - 1)) AS no").dropDuplicates(["doc", "no"]).selectExpr(
        "doc", "no", f"least({width - 1}, no * {chunk}) AS first",
        f"substr(t, 1 + no * {chunk} - least({width - 1}, no * {chunk}), {chunk} + least({width - 1}, no * {chunk})) AS s",
        f"no = {size.replace('text', 't').replace(' + 1', '')} - 1 AS last")


def _whole(docs: DataFrame, make, model_path: str) -> DataFrame:
    """``docs`` with its last column, ``text``, replaced by ``ids``, a text at a time."""

    def run(batches):
        import pyarrow as pa

        p = make(model_path)
        for b in batches:
            ids = [p.encode(t) for t in b.column(b.num_columns - 1).to_pylist()]
            ends = np.cumsum([0] + [len(i) // 4 for i in ids]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.ListArray.from_arrays(
                pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))], [*b.schema.names[:-1], "ids"])

    kept = ", ".join(f"{n} {t}" for n, t in docs.dtypes[:-1])
    return map_arrow(docs, run, f"{kept}, ids array<int>")


def _joined(docs: DataFrame, done: DataFrame, giant: int) -> DataFrame:
    """doc_id, ids of the giant texts, from their chunks' (doc, no, ids)."""
    solved = done.groupBy("doc").agg(F.expr(
        "flatten(transform(array_sort(collect_list(struct(no, ids))), x -> x.ids)) AS ids"))
    return docs.where(f"length(text) > {giant}").selectExpr("doc_id", "xxhash64(doc_id, text) AS doc") \
        .join(solved, "doc").select("doc_id", "ids")


def encode_as_model(docs: DataFrame, model_path: str, giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """doc_id, ids of (doc_id, text) as the sentencepiece library gives them for the file:
    BPE merges or the unigram lattice. Nulls, repeated rows, extra columns: as in ``encode``."""
    kind = _proto(model_path).trainer_spec.model_type
    if kind == UNIGRAM:
        return encode(docs, model_path, giant, chunk)
    if kind != BPE:
        raise ValueError("a BPE or a unigram model")
    docs = docs.select(F.col("doc_id").cast("long"), "text")

    def split(batches):
        import pyarrow as pa

        p = merges(model_path)
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                for no, s in enumerate(p.chunks(text.as_py(), chunk)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc], pa.int64()), pa.array([no], pa.int32()), pa.array([s], pa.string())],
                        ["doc", "no", "text"])

    small = _whole(docs.where(f"text IS NULL OR length(text) <= {giant}"), merges, model_path)
    parts = map_arrow(docs.where(f"length(text) > {giant}").selectExpr("xxhash64(doc_id, text) AS doc", "text"),
                      split, "doc long, no int, text string").dropDuplicates(["doc", "no"])
    return small.union(_joined(docs, _whole(parts, merges, model_path), giant))


def encode(docs: DataFrame, model_path: str, giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """doc_id, ids of (doc_id, text), the file's pieces and scores read as a unigram lattice
    whatever its type (see ``encode_as_model``). Null and empty texts have no ids; a null doc_id stays;
    repeated rows get a row each; an empty table gives no rows; extra columns are ignored."""
    width = Pieces(model_path).longest
    if chunk < 2 * width or giant < chunk:
        raise ValueError("a chunk holds two pieces at least, a giant text a chunk")
    docs = docs.select(F.col("doc_id").cast("long"), "text")

    def transfer(batches):
        import pyarrow as pa

        p = pieces(model_path)
        for b in batches:
            for doc, no, first, s in zip(*(b.column(i).to_pylist() for i in range(4))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc], pa.int64()), pa.array([no], pa.int32()),
                     pa.array([p.matrix(s, first, width).ravel()], pa.list_(pa.float64()))], ["doc", "no", "m"])

    def scan(pdf):
        import pandas as pd

        pdf = pdf.sort_values("no")
        state, out = np.full(width, NO), []
        state[0] = 0.0
        for m in pdf["m"]:
            out.append(state)
            state = (state[:, None] + np.asarray(m).reshape(width, width)).max(axis=0)
        return pd.DataFrame({"doc": pdf["doc"], "no": pdf["no"], "f": out})

    def entered(row):
        return {row["first"] - i: v for i, v in enumerate(row["f"]) if v > NO and row["first"] >= i}

    def lead(batches):
        import pyarrow as pa

        p = pieces(model_path)
        for b in batches:
            for row in b.to_pylist():
                s, first = row["s"], row["first"]
                best, back = p.forward(s, first, entered(row))
                to = [first - p.trace(s, back, len(s) - j, first)[1] if len(s) - j > first and best[len(s) - j] > NO
                      else -1 for j in range(width)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc"]], pa.int64()), pa.array([row["no"]], pa.int32()),
                     pa.array([to], pa.list_(pa.int32()))], ["doc", "no", "to"])

    def settle(pdf):
        import pandas as pd

        pdf = pdf.sort_values("no", ascending=False)
        j, out = 0, []
        for to in pdf["to"]:
            out.append(j)
            j = int(to[j])
        return pd.DataFrame({"doc": pdf["doc"], "no": pdf["no"], "exit": out})

    def final(batches):
        import pyarrow as pa

        p = pieces(model_path)
        for b in batches:
            for row in b.to_pylist():
                s, first = row["s"], row["first"]
                _, back = p.forward(s, first, entered(row))
                ids, _ = p.trace(s, back, len(s) - row["exit"], first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc"]], pa.int64()), pa.array([row["no"]], pa.int32()),
                     pa.array([ids], pa.list_(pa.int32()))], ["doc", "no", "ids"])

    small = _whole(docs.where(f"text IS NULL OR length(text) <= {giant}"), pieces, model_path)
    parts = cut(_chunks(docs, width, giant, chunk).repartition("doc", "no"), "chunks")
    # a text's summaries are bounded: a row holds 2 GB at most, a matrix stands for a chunk
    entry = cut(map_arrow(parts.select("doc", "no", "first", "s"), transfer, "doc long, no int, m array<double>")
                .groupBy("doc").applyInPandas(scan, "doc long, no int, f array<double>"), "entry")
    ready = cut(parts.join(entry, ["doc", "no"]), "ready")
    exits = map_arrow(ready, lead, "doc long, no int, to array<int>").groupBy("doc").applyInPandas(
        settle, "doc long, no int, exit int")
    done = map_arrow(ready.join(exits, ["doc", "no"]), final, "doc long, no int, ids array<int>")
    return small.union(_joined(docs, done, giant))


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text of (doc_id, ids): the exact text that was encoded (null ids: empty)."""

    def run(batches):
        import pyarrow as pa

        p = pieces(model_path)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([p.decode(i or []) for i in b.column(1).to_pylist()], pa.string())],
                ["doc_id", "text"])

    return map_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def digest(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (little-endian unsigned 32-bit ids), text_crc32 (of the text
    decoded from them, UTF-8)."""

    def run(batches):
        import pyarrow as pa

        p = pieces(model_path)
        for b in batches:
            ids = [x.values.to_numpy().astype("<u4") if x.is_valid else np.zeros(0, "<u4") for x in b.column(1)]
            cols = [[len(i) for i in ids], [zlib.crc32(i.tobytes()) for i in ids],
                    [zlib.crc32(p.decode(i.tolist()).encode("utf-8")) for i in ids]]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols)],
                                             ["doc_id", "n_ids", "ids_crc32", "text_crc32"])

    return map_arrow(encoded.select("doc_id", "ids"), run,
                     "doc_id long, n_ids long, ids_crc32 long, text_crc32 long")
