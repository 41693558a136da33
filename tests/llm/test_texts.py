import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewatch.llm import bm25_search, license_scan, packing, pii, piece_encoding, queries

ODD = [None, "", "  lead", "two  spaces\n\n x", "tail ", "é x y<|endoftext|> z", "word " * 9000, "a\tb \n c"]


def test_pack_covers_every_id(docs):
    from tokenizers import Tokenizer
    path = queries.tokenizer("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    texts = ODD + [f"text {i} " * (i * 7 % 400) for i in range(80)]
    rows = packing.pack(docs(texts), path, buffer=16).collect()
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    for i, t in enumerate(texts):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(pieces[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for s in seqs.values():
        s.sort(key=lambda p: p.offset)
        total = sum(p.length for p in s)
        assert [p.offset for p in s] == list(np.cumsum([0, *[p.length for p in s[:-1]]]))
        assert total <= 2048 and total & (total - 1) == 0
    assert packing.pack(docs([]), path).count() == 0


def test_piece_encoding_equals_library(docs):
    """The library as a unigram model with the same pieces and scores."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2 as pb
    path = queries.tokenizer("piece_bpe_32k.model")
    proto = pb.ModelProto()
    proto.ParseFromString(open(path, "rb").read())
    proto.trainer_spec.model_type = 1
    sp = SentencePieceProcessor(model_proto=proto.SerializeToString())
    texts = ["Hello world, this is a test.", "straightforward representations", "Über die Straße", "x" * 40]
    p = piece_encoding.Pieces(path)
    for t in texts:
        own, lib = np.frombuffer(p.encode(t), np.int32).tolist(), sp.encode(t)
        score = lambda ids: sum(sp.get_score(i) for i in ids)
        assert score(own) == score(lib) and p.decode(own) == t


@pytest.mark.parametrize("by_word", [True, False])
def test_giant_texts_equal_whole_ones(docs, by_word):
    path = queries.tokenizer("piece_bpe_32k.model")
    texts = ODD + ["the representations of " * 60, "abcdefgh" * 300, "日本語" * 200, "____...." * 150, " " * 700]
    p = piece_encoding.Pieces(path)
    enc = piece_encoding.encode(docs(texts), path, giant=600, chunk=97)
    got = {r.doc_id: r.ids for r in enc.collect()}
    p.by_word = by_word
    for i, t in enumerate(texts):
        assert got[i] == np.frombuffer(p.encode(t), np.int32).tolist()
    back = {r.doc_id: r.text for r in piece_encoding.decode(enc, path).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}
    assert piece_encoding.encode(docs([]), path).count() == 0


def _bm25(texts, query, k):
    docs = [Counter(bm25_search.terms(t)) for t in texts]
    n, mean = len(docs), sum(sum(d.values()) for d in docs) / len(docs)
    out = []
    for i, d in enumerate(docs):
        s = 0.0
        for t in sorted(set(bm25_search.terms(query))):
            if t in d:
                df = sum(t in x for x in docs)
                s += bm25_search.idf(n, df) * d[t] * 2.2 / (d[t] + 1.2 * (0.25 + 0.75 * sum(d.values()) / mean))
        if any(t in d for t in bm25_search.terms(query)):
            out.append((-s, i))
    return [(i, -s) for s, i in sorted(out)[:k]]


def test_search_equals_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(bm25_search, "SHARD", 40)
    monkeypatch.setattr(bm25_search, "QUERY_BLOCK", 2)
    import random
    rng = random.Random(1)
    texts = [None, "", "w1 w2", "w1 w2"] + [" ".join(f"w{int(rng.paretovariate(0.6)) % 60}" for _ in range(
        rng.randrange(1, 60))) for _ in range(250)]
    asked = ["w1 w2 w3 w1", "w17 w33", "nothing", "W1 w5 w8 w40", ""]
    q = spark.createDataFrame(list(enumerate(asked)), "query_id long, text string")
    rows = bm25_search.search(docs(texts), q, k=7).orderBy("query_id", "rank").collect()
    for i, text in enumerate(asked):
        got = [(r.doc_id, r.score) for r in rows if r.query_id == i]
        want = _bm25(texts, text, 7)
        assert [d for d, _ in got] == [d for d, _ in want]
        assert np.allclose([s for _, s in got], [s for _, s in want])
    assert bm25_search.search(docs([]), q).count() == 0


def test_license_equals_exact_containment(docs):
    import random
    rng = random.Random(2)
    words = lambda n: " ".join(f"v{rng.randrange(500)}" for _ in range(n))
    texts = list(ODD)
    for i in range(120):
        name, t = rng.choice(license_scan.TEMPLATES)
        w = t.split()
        if rng.random() < 0.4:
            w[rng.randrange(len(w))] = "changed"
        texts.append(words(rng.randrange(60)) + " " + " ".join(w) + "\n" + words(rng.randrange(60)))
    clean = lambda t: re.sub(r"[\W_]+", " ", (t or "").lower()).split()
    sh = lambda t: [" ".join(clean(t)[i:i + 5]) for i in range(len(clean(t)) - 4)]
    want = set()
    for i, t in enumerate(texts):
        own = set(sh(t))
        for name, tt in license_scan.TEMPLATES:
            s = set(sh(tt))
            if len(s & own) / len(s) >= 0.8:
                want.add((i, name))
    got = {(r.doc_id, r.template_id) for r in license_scan.scan(docs(texts)).collect()}
    assert got == want and len(want) > 60
    assert license_scan.scan(docs([])).count() == 0


def test_pii(docs):
    text = ("card 4111111111111111 and 4111 1111 1111 1112, +1 (017) 555-7713 233.254.104.120 999.1.1.1 "
            "2024-02-29 2023-02-29 31.12.1999 user.34@mail7.example.com token = "
            "\"cf1d64a9a4cd9723e1f4eafc27395915e6868ffa\"$$$ 123.45 $1\\0")
    rows = pii.pseudonymise(docs([text, text.replace("card", "again"), None, "", "nothing 12-34"]), "k").orderBy(
        "doc_id").collect()
    out = rows[0].text
    assert rows[1].text == out.replace("card", "again", 1) and rows[2].text is None and rows[4].text == "nothing 12-34"
    assert re.sub("[0-9a-z]", "", out) == re.sub("[0-9a-z]", "", text) and len(out) <= len(text) + 8
    for gone in ("4111111111111111", "555-7713", "233.254.104.120", "2024-02-29", "31.12.1999", "user.34@", "cf1d64"):
        assert gone not in out
    for kept in ("999.1.1.1", "2023-02-29", "123.45", "@mail7.example.com", "+1 ("):
        assert kept in out

    def luhn(s):
        d = [int(c) for c in s if c.isdigit()][::-1]
        return sum(d[::2] + [x * 2 - 9 * (x > 4) for x in d[1::2]]) % 10 == 0
    cards = [p.value for p in rows[0].pii if p.kind == "card"]
    assert len(cards) == 1 and luhn(cards[0]) and "4111 1111 1111 1112" in out
    assert pii.pseudonymise(docs([]), "k").count() == 0


def test_pii_is_one_to_one(spark):
    df = spark.range(10_000).selectExpr("id AS doc_id", "date_format(date_add(date'1990-01-01', int(id)), 'yyyy-MM-dd') AS text")
    rows = pii.pseudonymise(df, "k").collect()
    assert len({r.text for r in rows}) == 10_000


def test_packing_ids_of_every_latin_character():
    """Both ways to the ids give those of the tokenizers library."""
    from tokenizers import Tokenizer
    path = queries.tokenizer("byte_bpe_50k.json")
    own, tok = packing.Encoder(path), Tokenizer.from_file(path)
    assert own.merger is not None
    for c in map(chr, range(0x260)):
        for t in (c, f"a {c}{c} b1{c}2 'll{c}", f"  {c}\n{c} x{c}", f"<|endoftext|>{c}", c * 401):
            assert own.encode(t) == np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes()


def test_bpe_file_gives_the_ids_of_the_library(docs):
    """The unchanged model file, word by word and in chunks cut at word marks."""
    from sentencepiece import SentencePieceProcessor
    path = queries.tokenizer("piece_bpe_32k.model")
    sp = SentencePieceProcessor(model_file=path)
    texts = ODD + ["straightforward representations", " a", "x ", "the representations of " * 60, "abcdefgh" * 300,
                   "日本語" * 200, "____...." * 150, " " * 700, "w " * 49, "ab  c   " * 200, "a▁b▁▁c " * 90]
    enc = piece_encoding.encode_as_model(docs(texts), path, giant=90, chunk=97)
    got = {r.doc_id: r.ids for r in enc.collect()}
    assert got == {i: sp.encode(t or "") for i, t in enumerate(texts)}
    assert len(piece_encoding.merges(path).chunks(texts[-1], 97)) > 4
    assert piece_encoding.encode_as_model(docs([]), path).count() == 0


def test_query_uses_the_type_of_the_file(spark):
    from sentencepiece import SentencePieceProcessor
    sf = "/root/testdata/sf0.001"
    sp = SentencePieceProcessor(model_file=queries.tokenizer("piece_bpe_32k.model"))
    got = Counter((r.doc_id, r.n_ids, r.ids_crc32) for r in queries.op4_sentencepiece(spark, sf).collect())
    ids = [(r.doc_id, np.array(sp.encode(r.text or ""), "<u4")) for r in
           spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got == Counter((d, len(i), zlib.crc32(i.tobytes())) for d, i in ids)


def test_unigram_scores_are_not_rounded(docs, tmp_path):
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    proto.ParseFromString(open(queries.tokenizer("piece_bpe_32k.model"), "rb").read())
    proto.trainer_spec.model_type = 1
    for i, p in enumerate(proto.pieces):
        p.score = -0.02 - (i * 7 % 97) / 250
    path = str(tmp_path / "unigram.model")
    open(path, "wb").write(proto.SerializeToString())
    sp = SentencePieceProcessor(model_file=path)
    texts = ["Hello world, this is a test.", "straightforward representations", "Über die Straße"] * 2
    got = {r.doc_id: r.ids for r in piece_encoding.encode_as_model(docs(texts), path).collect()}
    for i, t in enumerate(texts):
        score = lambda ids: sum(sp.get_score(j) for j in ids)
        assert abs(score(got[i]) - score(sp.encode(t))) < 1e-4


def test_numbers_without_a_luhn_check_stay(docs):
    bad = "4111 1111 1111 1112 4111111111111112 1704067200000 1234-5678-9012-3456"
    good = "4111111111111111 x 2024 4111 1111 1111 1111 and 5500 0000 0000 0004 4111-1111-1111-1111 7"
    rows = pii.pseudonymise(docs([bad, good, None]), "k", luhn=True).orderBy("doc_id").collect()
    assert rows[0].text == bad and {p.kind for p in rows[0].pii} == {None} and rows[2].text is None
    own = [p.value for p in rows[1].pii]
    assert [p.kind for p in rows[1].pii] == ["card"] * 4 and own[0] == own[1].replace(" ", "")
    assert rows[1].text == f"{own[0]} x 2024 {own[1]} and {own[2]} {own[3]} 7" and own[0] != "4111111111111111"
    assert own[3].replace("-", "") == own[0] and own[2] != "5500 0000 0000 0004"


def test_query_and_pipeline_validate_numbers(spark, docs, tmp_path):
    import corpus_pipeline
    df = docs(["id 4111111111111112 and 4111111111111111"])
    df.write.parquet(str(tmp_path / "documents.parquet"))
    row = queries.op5_pii(spark, str(tmp_path)).first()
    assert row.n_pii == 1 and "id 4111111111111112 and" in row.text
    assert corpus_pipeline.pseudonymise(spark, df, str(tmp_path)).first().text == row.text


def test_search_of_the_query_takes_every_twentieth_row(spark, monkeypatch):
    monkeypatch.setattr(bm25_search, "SHARD", 60)
    monkeypatch.setattr(bm25_search, "QUERY_BLOCK", 3)
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    got = defaultdict(list)
    for r in queries.op7_topk_search(spark, sf).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.doc_id, r.score))
    asked = [r for r in rows if r.doc_id % 20 == 0 and bm25_search.terms(r.text)]
    assert {q for q in got if q >= 0} == {r.doc_id for r in asked} and len(asked) > 5
    for r in asked[:4]:
        want = _bm25([x.text for x in rows], r.text, 10)
        assert [d for d, _ in got[r.doc_id]] == [rows[i].doc_id for i, _ in want]
        assert np.allclose([s for _, s in got[r.doc_id]], [s for _, s in want])


def test_every_given_text_has_the_ids_of_the_unchanged_tokenizer():
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer
    path = queries.tokenizer("byte_bpe_50k.json")
    own, tok = packing.Encoder(path), Tokenizer.from_file(path)
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    for t in [*texts, "hello <|endoftext|> x", "<|endoftext|>", "a  <|endoftext|>\n b"]:
        assert own.encode(t) == np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
