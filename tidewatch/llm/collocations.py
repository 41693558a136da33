"""Phrase collocation mining over a prefix-free parse of the corpus.

Every piece of text (between marks of punctuation or line ends) is cut before its trigger
words, those whose hash is divisible by ``PERIOD``, and after ``LONGEST`` words without one.
A chunk also carries the first words of the next one, as many as a phrase may reach beyond
its first word. Equal passages give equal chunks wherever they stand, so the dictionary holds
each distinct chunk once, with the number of its parses. Phrases are counted inside the
distinct chunks, times that number, and only where they start before the overlap: each
occurrence belongs to exactly one chunk.

A first count, of hashed pairs alone, leaves a filter of bounded size: longer phrases and
pairs are written out only where every pair in them may be frequent.

Counting is pre-aggregated in the tasks and summed by Spark; no chunk, word or language is
gathered in one task but for its sums.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewatch.llm.common import cut, map_arrow
from tidewatch.llm.hash_filter import hash_filter, holds

PERIOD, LONGEST = 16, 96  # a trigger among so many words; words of a chunk at most
LEAST, WORDS, TOP, SALTS = 10, 3, 2000, 64
_FLUSH, _GATHER = 1 << 17, 1 << 19  # dictionary entries, and words, held by a task
#: The marks that end a piece, and what separates words.
_MARKS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_TABLE = bytes(10 if c in _MARKS else 32 if c in _BLANKS else c + 32 if 65 <= c <= 90 else c for c in range(256))


class _Triggers(dict):
    """word -> whether a chunk starts at it; a memory for speed alone."""

    def __missing__(self, word: bytes) -> bool:
        if len(self) > 500_000:
            self.clear()
        out = self[word] = zlib.crc32(word) % PERIOD == 0
        return out


def pieces(text: str | None) -> list[list[bytes]]:
    """The words of every piece that has one, A-Z lower-cased."""
    return [w for p in (text or "").encode("utf-8").translate(_TABLE).split(b"\n") if (w := p.split())]


def parse(words: list[bytes], trigger, reach: int) -> list[tuple[int, bytes]]:
    """(words of overlap, chunk) in order: chunks own the words before their overlap."""
    starts = [i for i, w in enumerate(words) if trigger[w]]
    n, out, at = len(words), [], 0
    for end in [*starts, n]:
        while at < end:
            stop = min(end, at + LONGEST)
            chunk = words[at:stop + reach]
            out.append((len(chunk) - (stop - at), b" ".join(chunk)))
            at = stop
    return out


def dictionary(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """lang, tail (words of overlap at the end), chunk, freq: every distinct chunk once."""
    reach = words - 1

    def run(batches):
        import pyarrow as pa

        trigger = _Triggers()
        held: dict[str, Counter] = {}

        def take():
            rows = [(lang, tail, chunk, n) for lang, c in held.items() for (tail, chunk), n in c.items()]
            held.clear()
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            return pa.RecordBatch.from_arrays([
                pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()),
                pa.array(columns[2], pa.string()), pa.array(columns[3], pa.int64())], ["lang", "tail", "chunk", "freq"])

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                own = held.setdefault(lang, Counter())
                for piece in pieces(text.as_py()):
                    own.update(parse(piece, trigger, reach))
                    if len(own) >= _FLUSH:
                        yield take()
                        own = held.setdefault(lang, Counter())
            if sum(map(len, held.values())) >= _FLUSH:
                yield take()
        yield take()

    chunks = map_arrow(docs.select(F.expr("coalesce(lang, 'und') AS lang"), "text"), run,
                       "lang string, tail int, chunk string, freq long")
    return chunks.groupBy("lang", "tail", "chunk").agg(F.sum("freq").alias("freq"))


def _added(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys' first places, their summed weights, and every place's key number."""
    order = np.argsort(key, kind="stable")
    fresh = np.r_[True, key[order][1:] != key[order][:-1]] if len(key) else np.zeros(0, bool)
    lo = np.flatnonzero(fresh)
    number = np.empty(len(key), dtype=np.int64)
    number[order] = np.cumsum(fresh) - 1
    return order[lo], np.add.reduceat(weight[order], lo) if len(lo) else weight[:0], number


class _Words:
    """The words of distinct chunks (Arrow columns) as numbers: ``code`` into ``vocab``, ``of``
    into ``names`` (languages), with each word's place, the end of its chunk, its weight and
    whether its chunk owns it."""

    def __init__(self, lang, tail, chunk, freq):
        import pyarrow.compute as pc

        split = pc.split_pattern(chunk, " ")
        flat, langs = split.flatten().dictionary_encode(), lang.dictionary_encode()
        size = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(size)), size)
        self.code, self.vocab = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), flat.dictionary
        self.of, self.names = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row], langs.dictionary
        self.end, self.at = np.cumsum(size)[row], np.arange(len(row))
        self.owned = self.at < self.end - tail.to_numpy(zero_copy_only=False)[row]
        self.weight = freq.to_numpy(zero_copy_only=False)[row]

    def pairs(self) -> np.ndarray:
        """Hash of the language, the word and the next word, at every place that has one."""
        from xxhash import xxh64_intdigest

        word = np.array([xxh64_intdigest(w) for w in self.vocab.cast("binary").to_pylist()], dtype=np.uint64)
        name = np.array([xxh64_intdigest(w) for w in self.names.cast("binary").to_pylist()], dtype=np.uint64)
        h = word[self.code]
        h = h * np.uint64(0x9E3779B97F4A7C15) ^ np.r_[h[1:], h[:1]] ^ name[self.of]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


def _gathered(batches, work):
    """``work`` on the columns of many small batches put together."""
    import pyarrow as pa

    held, size = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.column(2).nbytes // 8
        if size >= _GATHER:
            yield from work(_Words(*(c.chunk(0) for c in pa.Table.from_batches(held).combine_chunks().columns)))
            held, size = [], 0
    if held:
        yield from work(_Words(*(c.chunk(0) for c in pa.Table.from_batches(held).combine_chunks().columns)))


def frequent_pairs(chunks: DataFrame, least: int = LEAST) -> np.ndarray:
    """The filter, of bounded size, that holds the hash of every pair of words which occurs
    ``least`` times or more."""

    def run(batches):
        import pyarrow as pa

        def work(w: _Words):
            ok = np.flatnonzero(w.owned & (w.at + 2 <= w.end))
            h = w.pairs()[ok]
            first, count, _ = _added(h, w.weight[ok])
            yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(count)], ["h", "f"])

        return _gathered(batches, work)

    often = cut(map_arrow(chunks.select("lang", "tail", "chunk", "freq"), run, "h long, f long").groupBy("h").agg(
        F.sum("f").alias("f")).where(f"f >= {least}").select("h"), "pairs")
    return hash_filter(often)


def phrase_counts(chunks: DataFrame, least: int = LEAST, words: int = WORDS) -> DataFrame:
    """lang, length, phrase, f: the phrases that occur ``least`` times or more, and with length
    0 the number of words of the language. Phrases are told apart only where every pair of
    neighbours may occur so often itself."""
    shared = chunks.sparkSession.sparkContext.broadcast(frequent_pairs(chunks, least))

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        def work(w: _Words):
            def batch(lang, n, phrase, count):
                return pa.RecordBatch.from_arrays([lang, pa.array(np.full(len(count), n), pa.int32()), phrase,
                                                   pa.array(count, pa.int64())], ["lang", "length", "phrase", "f"])

            total = np.zeros(len(w.names), dtype=np.int64)
            np.add.at(total, w.of[w.owned], w.weight[w.owned])
            yield batch(w.names, 0, pa.nulls(len(total), pa.string()), total)
            often = holds(shared.value, w.pairs())
            prefix, keep = w.of, w.owned
            for n in range(1, words + 1):
                if n > 1:
                    keep = keep & np.roll(often, 2 - n)  # the pair that the n-th word closes
                ok = np.flatnonzero(keep & (w.at + n <= w.end))
                first, count, number = _added(prefix[ok] * len(w.vocab) + w.code[(ok + n - 1)], w.weight[ok])
                prefix = np.zeros(len(w.code), dtype=np.int64)
                prefix[ok] = number  # number of (language, words so far)
                begin = ok[first]
                phrase = pc.binary_join_element_wise(*[w.vocab.take(pa.array(w.code[begin + i])) for i in range(n)], " ")
                yield batch(w.names.take(pa.array(w.of[begin])), n, phrase, count)

        return _gathered(batches, work)

    counted = map_arrow(chunks.select("lang", "tail", "chunk", "freq"), run,
                        "lang string, length int, phrase string, f long")
    return counted.groupBy("lang", "length", "phrase").agg(F.sum("f").alias("f")).where(f"f >= {least} OR length = 0")


def collocations(docs: DataFrame, least: int = LEAST, words: int = WORDS, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best ``top`` phrases of 2 to ``words`` words
    of each language, by score, then a, both falling, then phrase.

    ``a`` counts a phrase; a cut after k words gives l and r, the counts of both parts, and
    floor(1000000 a a / (l r)), in decimals of 38 digits (exact up to 10^15 words); the lowest
    cut counts. A phrase goes if a longer one that holds it has at least half its count. Null
    texts count as empty, null languages as ``und``; empty texts and tables give no rows;
    repeated rows count each; doc_id and extra columns are not read."""
    counts = cut(phrase_counts(cut(dictionary(docs, words), "chunks"), least, words), "phrases")
    part = counts.where("length > 0").select("lang", "phrase", "f")
    many = counts.where("length > 1").selectExpr("lang", "length", "phrase", "f AS a", "split(phrase, ' ') AS w")
    cuts = many.selectExpr("lang", "length", "phrase", "a", "w", "explode(sequence(1, length - 1)) AS k").selectExpr(
        "lang", "length", "phrase", "a", "k", "array_join(slice(w, 1, k), ' ') AS x",
        "array_join(slice(w, k + 1, length), ' ') AS y")
    d = "cast({} AS decimal(15, 0))"
    scored = cuts.join(part.selectExpr("lang", "phrase AS x", "f AS l"), ["lang", "x"]) \
        .join(part.selectExpr("lang", "phrase AS y", "f AS r"), ["lang", "y"]).withColumn("score", F.expr(
            f"cast(({d.format('a')} * {d.format('a')} * cast(1000000 AS decimal(7, 0))) "
            f"div ({d.format('l')} * {d.format('r')}) AS long)"))
    lowest = scored.groupBy("lang", "length", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    inside = many.selectExpr("lang", "length", "a", "w", "explode(sequence(2, length - 1)) AS n").where("n < length") \
        .selectExpr("lang", "a", "w", "n", "explode(sequence(1, length - n + 1)) AS i").selectExpr(
        "lang", "array_join(slice(w, i, n), ' ') AS phrase", "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = lowest.join(inside, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 50 * a").selectExpr(
        "lang", "phrase", "a", "m.l", "m.r", "m.score", f"pmod(xxhash64(phrase), {SALTS}) AS salt")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))) \
        .where(f"rank <= {top}").withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))) \
        .where(f"rank <= {top}")
    total = counts.where("length = 0").selectExpr("lang", "f AS n")
    return best.join(total, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
