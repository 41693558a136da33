"""Extra columns may bear any name, the operators' own names too."""

import re
from pathlib import Path

import pytest

import corpus_pipeline as cp
from tidewatch.llm import line_dedup, pii, simhash_dedup

OPERATORS = {
    "line_dedup": (line_dedup, lambda d: line_dedup.line_dedup(d)),
    "simhash_dedup": (simhash_dedup, lambda d: simhash_dedup.near_dedup(d)),
    "pii": (pii, lambda d: pii.pseudonymise(d, "k")),
}
TEXTS = ["one line of text here\nid 4111111111111111", "one line of text here\nother", None, "", "alone in the corner of it"]


def names(module):
    """Every name that the module's SQL and column calls may use."""
    source = Path(module.__file__).read_text()
    found = set(re.findall(r"AS ([a-z_]\w*)|\"([a-z_]\w{0,12})\"|\b(_[a-z]\w*)\b", source))
    return sorted({n for t in found for n in t if n} - {"doc_id", "text", "pii", "n_lines", "n_equal", "n_near"}
                  | {"__column_0", "__column_3"})


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_names_change_nothing(spark, name):
    module, run = OPERATORS[name]
    extra = [n for i, n in enumerate(names(module)) if n.lower() not in {x.lower() for x in names(module)[:i]}]
    rows = [(1 if i < 2 else None if i == 2 else i, t, *[f"{n}{i}" for n in extra]) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in extra))
    plain = run(df.select("doc_id", "text", f"`{extra[0]}`"))
    full = run(df)
    assert full.columns[:2 + len(extra)] == df.columns
    own = [c for c in plain.columns if c not in extra]
    key = lambda r: str(r)
    assert sorted(full.select(*own, f"`{extra[0]}`").collect(), key=key) == sorted(
        plain.select(*own, f"`{extra[0]}`").collect(), key=key)
    for r in full.collect():
        i = r[extra[0]][len(extra[0]):]
        assert all(r[n] == f"{n}{i}" for n in extra)
    assert run(df.limit(0)).count() == 0


def test_stages_take_clashing_names(spark):
    extra = ["_h", "_p", "_l", "_e", "_n", "_d", "_t", "_th", "_id", "_r", "fp", "root", "pos", "pii", "n_near"]
    rows = [(i, f"this is an english text number {i} about the weather and the town", "en", "s", 1, *extra) for i in range(5)]
    docs = spark.createDataFrame(rows + rows[:2] + [(None, None, None, "s", 1, *extra)],
                                 "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"{n} string" for n in extra))
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert set(out.columns) >= {"doc_id", "text", "lang", "source", "n_chars"}, name
        assert out.count() <= docs.count()
    assert cp.pack(spark, docs, "").count() >= 8
