import random
import re
from collections import Counter

from tidewatch.llm import collocations as c

SCHEMA = "doc_id long, text string, lang string, f long, length string, _w int"


def brute(rows, least, top, words=3):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = f.setdefault(lang, Counter())
        low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = [x for x in re.split("[ \t]", piece) if x]
            n[lang] += len(w)
            for size in range(1, words + 1):
                own.update(" ".join(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, own in f.items():
        cand = {p: a for p, a in own.items() if " " in p and a >= least}
        longer = Counter()
        for p, a in cand.items():
            w = p.split(" ")
            for size in range(2, len(w)):
                for i in range(len(w) - size + 1):
                    q = " ".join(w[i:i + size])
                    longer[q] = max(longer[q], a)
        scored = []
        for p, a in cand.items():
            if 100 * longer[p] >= 50 * a and longer[p]:
                continue
            w = p.split(" ")
            score, _, x, y = min((10 ** 6 * a * a // (own[" ".join(w[:k])] * own[" ".join(w[k:])]), k,
                                  own[" ".join(w[:k])], own[" ".join(w[k:])]) for k in range(1, len(w)))
            scored.append((-score, -a, p.encode(), x, y))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s)
                for i, (s, a, p, x, y) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def corpus():
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(14)] + ["É", "Ünd", "A", "x\x1cy", "a\xa0b", "日本"]
    out = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(1, 120)):
            words.append(rng.choice(vocab[:rng.choice([3, 8, 20])]) + rng.choice(["", "", "", "", ".", ",", "\n", "\t"]))
        out.append((rng.choice(["en", "en", "de", None]), " ".join(words)))
    passage = "the quick brown fox jumps over the lazy dog " * 40  # longer than a chunk
    out += [("en", passage)] * 9 + [("de", "same " * 3000), ("xx", None), ("xx", ""), ("yy", " \t.\n!"), ("en", "one")]
    return out


def test_collocations_equal_brute_force(spark):
    rows = corpus()
    for least, top in ((10, 2000), (3, 25)):
        df = spark.createDataFrame([(None if i % 7 == 0 else i // 2, t, x, 1, "l", 2) for i, (x, t) in enumerate(rows)], SCHEMA)
        got = sorted(tuple(r) for r in c.collocations(df, least, 3, top).collect())
        assert got == brute(rows, least, top)


def test_each_phrase_belongs_to_one_chunk():
    rng = random.Random(2)
    for _ in range(30):
        words = [b"w%d" % rng.randrange(30) for _ in range(rng.randrange(1, 300))]
        chunks = c.parse(words, c._Triggers(), 2)
        assert [w for t, x in chunks for w in x.split()[:len(x.split()) - t]] == words
        assert all(len(x.split()) <= c.LONGEST + 2 for _, x in chunks)
        got = Counter()
        for tail, x in chunks:
            w = x.split()
            got.update(tuple(w[i:i + 3]) for i in range(len(w) - tail) if i + 3 <= len(w))
        assert got == Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))


def test_counts_beyond_64_bits(spark):
    big = 5 * 10 ** 9
    chunks = spark.createDataFrame([("en", 0, "a b", big), ("en", 0, "a c", 1)], "lang string, tail int, chunk string, freq long")
    got = {r.phrase: r.f for r in c.phrase_counts(chunks, 10).where("length > 0").collect()}
    assert got == {"a": big + 1, "b": big, "a b": big}
    row = spark.range(1).selectExpr(f"{big}L AS a", f"{big + 1}L AS l", f"{big}L AS r").selectExpr(
        "cast((cast(a AS decimal(15, 0)) * cast(a AS decimal(15, 0)) * cast(1000000 AS decimal(7, 0))) div "
        "(cast(l AS decimal(15, 0)) * cast(r AS decimal(15, 0))) AS long) AS score").first()
    assert row.score == 10 ** 6 * big * big // ((big + 1) * big)


def test_empty_table(spark):
    assert c.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
