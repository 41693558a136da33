import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidewatch.llm import suffix_dedup as sd
from tidewatch.llm.hash_filter import hash_filter, holds

SCHEMA = "doc_id long, text string, t1 string, copies int, `key` string, place double"


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = [False] * len(r)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return out


def frame(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "x", 9, "k", 0.5) for i, t in zip(ids or range(len(texts)), texts)], SCHEMA)


def check(spark, texts, length, **options):
    got = sd.suffix_dedup(frame(spark, texts), length=length, **options).orderBy("doc_id").collect()
    want = brute(texts, length)
    assert [tuple(r)[1:] for r in got] == want
    return want


def words(rng, n, vocab=4000):
    return " ".join(f"w{rng.randrange(vocab)}é" for _ in range(n))


def test_windows_that_are_equal_share_key_and_column():
    rng = random.Random(4)
    cutter = sd.Segments(40, 16, 16)
    passage = words(rng, 30).encode()
    texts = [words(rng, rng.randrange(0, 40)).encode() + passage[rng.randrange(9):] + words(rng, 5).encode() for _ in range(12)]
    texts += [b"a" * 100, b"ab" * 70, b"\0" * 60, b"short"]
    at, starts = {}, 0
    for number, place, off, m, key, _ in cutter.of_texts(enumerate(texts)):
        for i, p, o, k, h in zip(number, place, off, m, key):
            for x in range(k):
                at.setdefault(texts[i][p + x:p + x + 40], set()).add((int(h), int(o + x)))
                starts += 1
    assert starts == sum(max(0, len(t) - 39) for t in texts)
    assert all(len(v) == 1 for v in at.values())


def test_build_gives_order_and_common_prefixes():
    rng = random.Random(6)
    bodies = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(6, 13))) for _ in range(60)]
    off = np.array([rng.randrange(0, 3) for _ in bodies])
    group = np.sort(np.array([rng.randrange(4) for _ in bodies]))
    width = 16
    cells = [[256] * o + list(b) + [256] * (width - o - len(b)) for o, b in zip(off, bodies)]
    for c, order, common in sd.build(group, off, None, bodies, width, 6):
        tail = [cells[r][c:] for r in order]
        assert [(group[r], cells[r][c:]) for r in order] == sorted((g, x[c:]) for g, x in zip(group, cells))
        for i in range(1, len(order)):
            n = next((k for k, (x, y) in enumerate(zip(tail[i - 1], tail[i])) if x != y), width - c)
            assert common[i] == (n if group[order[i]] == group[order[i - 1]] else -1)


@pytest.mark.parametrize("part", [8192, 3])
def test_suffix_dedup_equals_brute_force(spark, part):
    rng = random.Random(11)
    passages = [words(rng, 40, 300) for _ in range(4)]
    texts = [None, "", "short", "a" * 90, "a" * 39, "ab" * 60, "\0" * 50, "é" * 70, "same text " * 9, "same text " * 9]
    for i in range(60):
        body = [words(rng, rng.randrange(0, 30))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            cut = rng.randrange(0, 60)
            body += [p[cut:cut + rng.randrange(30, 200)], words(rng, rng.randrange(0, 6))]
        texts.append(" ".join(body))
    want = check(spark, texts, 40, gram=16, step=16, part=part)
    assert any(0 < w[1] < w[0] and w[2] > 1 for w in want) and any(w[1] == 0 for w in want[10:])


def test_production_lengths(spark):
    rng = random.Random(12)
    passage = words(rng, 120)
    texts = [words(rng, 80) + passage + words(rng, 40), words(rng, 10) + passage[3:-5], words(rng, 300),
             "x" * 399, "y" * 400, "y" * 400, "z" * 401, words(rng, 5) + passage[:399], passage[:400]]
    check(spark, texts, 400)


def test_repeated_and_null_ids_and_empty_table(spark):
    text = "only once " + "q" * 45
    out = sd.suffix_dedup(frame(spark, [text, text, "other"], [None, 5, 5]), length=40, step=16).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in out) == [(-1, len(text)), (5, 0), (5, len(text))]
    assert sd.suffix_dedup(frame(spark, [])).count() == 0


def test_pieces_of_a_long_text(spark, monkeypatch):
    rng = random.Random(13)
    text = words(rng, 6000)
    monkeypatch.setattr(sd, "_PIECE", 4096)
    whole = [(p + x, int(k), int(o + x)) for _, place, off, m, key, _ in sd.Segments(64, 16, 32).of_texts([(0, text.encode())])
             for p, o, n, k in zip(place, off, m, key) for x in range(n)]
    monkeypatch.setattr(sd, "_PIECE", 1 << 20)
    assert sorted(whole) == sorted(
        (p + x, int(k), int(o + x)) for _, place, off, m, key, _ in sd.Segments(64, 16, 32).of_texts([(0, text.encode())])
        for p, o, n, k in zip(place, off, m, key) for x in range(n))


def test_hash_filter_loses_nothing(spark):
    h = np.random.default_rng(1).integers(-2 ** 63, 2 ** 63 - 1, 5000)
    df = spark.createDataFrame([(int(x),) for x in h], "h long")
    for most in (27, 16):
        bits = hash_filter(df, most)
        assert holds(bits, h).all()
        assert holds(bits, np.random.default_rng(2).integers(-2 ** 63, 2 ** 63 - 1, 5000)).mean() < 0.2
    assert not holds(hash_filter(df.limit(0)), h).any()
