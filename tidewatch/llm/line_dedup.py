"""Near-duplicate lines by a deletion-neighbourhood join, in DataFrame operations only.

Lines are word sequences; two lines are near copies when one word replaced, inserted or
deleted turns one into the other (edit bound one) and both have ``min_words`` words.
Shorter lines match exactly only. A line goes if an equal or near line stands earlier,
by (doc_id, text hash, line number); lines without a word always stay.

A line's variants are all its one-word deletions, each a hashed key: the XOR of hashes of
(word, place). Equal variants at one place are lines one replacement apart; a variant
equal to a whole line is one deletion apart. Before the variants are made, lines that
share neither half with another line are left out: one edit leaves a half untouched, so
they cannot have a partner. Every group passes on only its earliest line, never its pairs,
and that line's words are compared with the candidate's before anything is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewatch.llm.common import apart, cut

_HAS_WORD = r"'[^\\x20\\x09-\\x0D]'"
_WORDS = r"filter(split(line, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"


def _lines(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("doc_id", "th", "posexplode(split(text, '\\n', -1)) AS (pos, line)") \
        .where(f"line RLIKE {_HAS_WORD}")


def line_marks(docs: DataFrame, min_words: int = 10) -> DataFrame:
    """doc_id, th (text hash), pos, near (boolean): of every set of equal lines the
    earliest, with near false, and again with near true if it goes as a near copy. Copies of
    a line are never gathered: a common line costs its partial minima only."""
    base = docs.selectExpr("doc_id", "xxhash64(text) AS th", "text")
    half = ("CASE WHEN size(w) >= {m} THEN array_distinct(flatten(transform("
            "array(size(w) div 2, (size(w) - 1) div 2), h -> array("
            "xxhash64(0, array_join(slice(w, 1, h), ' ')), "
            "xxhash64(1, array_join(slice(w, size(w) - h + 1, h), ' ')))))) END").format(m=min_words)
    occ = cut(_lines(base).withColumn("w", F.expr(_WORDS)).selectExpr(
        "doc_id", "th", "pos", "xxhash64(line) AS h1", "hash(line) AS h2", f"{half} AS halves"), "lines")
    first = occ.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "th", "pos")).alias("a")).selectExpr(
        "a.*", "false AS near")

    keys = occ.where("halves IS NOT NULL").groupBy("h1", "h2", "halves").agg(
        F.min(F.struct("doc_id", "th", "pos")).alias("a")).selectExpr("a", "explode(halves) AS k")
    shared = keys.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k")
    alive = keys.join(shared, "k", "left_semi").select("a.doc_id", "a.th", "a.pos").distinct()
    marks = alive.groupBy("doc_id", "th").agg(F.collect_set("pos").alias("at"))
    # the texts of the lines that may have a partner
    words = base.join(marks.withColumnRenamed("doc_id", "d").withColumnRenamed("th", "t"),
                      F.expr("doc_id <=> d AND th <=> t")).dropDuplicates(["doc_id", "th"]).selectExpr(
        "doc_id", "th", "at", "posexplode(split(text, '\\n', -1)) AS (pos, line)").where(
        "array_contains(at, pos)").withColumn("w", F.expr(_WORDS)).selectExpr("doc_id", "th", "pos", "w")
    words = cut(words.withColumn("id", F.expr("xxhash64(doc_id, th, pos)")), "words")

    by_line = W.partitionBy("id").orderBy("i")
    spread = words.selectExpr("id", "size(w) AS n", "posexplode(w) AS (i, x)").selectExpr(
        "id", "n", "i", "xxhash64(x, i) AS here", "xxhash64(x, i - 1) AS back")
    # running XORs: of the words before as they stand, of those after moved up by one
    run = spread.withColumn("p", F.expr("bit_xor(here)").over(by_line.rowsBetween(W.unboundedPreceding, 0))) \
        .withColumn("q", F.expr("bit_xor(back)").over(by_line.rowsBetween(W.unboundedPreceding, 0))) \
        .withColumn("all_q", F.last("q").over(by_line.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    # written once a word; each use below derives its keys from that
    variants = cut(run.selectExpr("id", "i", "(p ^ here) ^ (all_q ^ q) AS v", "CASE WHEN i = n - 1 THEN p END AS whole"),
                   "variants")
    keyed = variants.selectExpr("id", "explode(array(struct(v AS k, i AS place, false AS full), "
                                "struct(v AS k, -1 AS place, false AS full), "
                                "struct(whole AS k, -1 AS place, true AS full))) AS e").selectExpr("id", "e.*") \
        .where("k IS NOT NULL")
    order = words.selectExpr("id", "struct(doc_id, th, pos) AS a")
    many = keyed.groupBy("k", "place").agg(F.count("*").alias("n"), F.max("full").alias("has_full")) \
        .where("n > 1 AND (place >= 0 OR has_full)").select("k", "place")
    live = cut(keyed.join(many, ["k", "place"], "left_semi").join(order, "id"), "live")
    # replacement groups and, for deletions, the whole line against the longer ones
    least = live.groupBy("k", "place", "full").agg(F.min(F.struct("a", "id")).alias("m"))
    near = live.alias("l").join(least.alias("g"), F.expr(
        "l.k = g.k AND l.place = g.place AND ((l.place >= 0) OR (l.full <> g.full)) AND g.m.a < l.a")) \
        .selectExpr("l.id AS id", "g.m.id AS other", "l.a AS a").distinct()
    text = words.select("id", "w")
    pairs = near.join(text, "id").join(text.selectExpr("id AS other", "w AS w2"), "other")
    verified = pairs.withColumn("pre", F.expr(
        "coalesce(nullif(array_position(zip_with(w, w2, (x, y) -> coalesce(x <> y, true)), true), 0) - 1, "
        "size(w))")).where(
        "array_join(slice(w, int(pre) + 1 + int(size(w) >= size(w2)), size(w) + 1), ' ') = "
        "array_join(slice(w2, int(pre) + 1 + int(size(w2) >= size(w)), size(w2) + 1), ' ')")
    gone = verified.select("a.doc_id", "a.th", "a.pos").distinct().withColumn("near", F.lit(True))
    return first.union(gone)


def line_dedup(docs: DataFrame, min_words: int = 10) -> DataFrame:
    """All columns of ``docs`` with ``text`` reduced to its kept lines, plus ``n_lines``,
    ``n_equal`` and ``n_near`` (lines of the input, lines dropped as equal, as near).

    Null text stays null with zero lines; empty text stays empty. Rows equal in doc_id and
    text are one document at one place: each keeps the same lines. A null doc_id sorts
    first. An empty table gives no rows. Extra columns pass through whatever their names; columns
    of the three names are replaced.
    """
    return apart(docs.drop("n_lines", "n_equal", "n_near"), lambda d: _without_copies(d, min_words))


def _without_copies(docs: DataFrame, min_words: int) -> DataFrame:
    marks = cut(line_marks(docs.select("doc_id", "text"), min_words), "marks") \
        .groupBy(F.col("doc_id").alias("_d"), F.col("th").alias("_t")).agg(
        F.collect_set(F.expr("CASE WHEN NOT near THEN pos END")).alias("_f"),
        F.collect_set(F.expr("CASE WHEN near THEN pos END")).alias("_n"))
    joined = docs.join(marks, F.expr("doc_id <=> _d AND xxhash64(text) <=> _t"), "left")
    none = "cast(array() AS array<int>)"
    kept = joined.withColumn("_l", F.expr("split(text, '\\n', -1)")).withColumn("_e", F.expr(
        f"array_except(filter(sequence(0, size(_l) - 1), p -> _l[p] RLIKE {_HAS_WORD}), coalesce(_f, {none}))")) \
        .withColumn("_n", F.expr(f"coalesce(_n, {none})"))
    return kept.withColumn("text", F.expr(
        "CASE WHEN size(_e) + size(_n) > 0 THEN array_join(transform(array_except("
        "sequence(0, size(_l) - 1), array_union(_e, _n)), p -> _l[p]), '\\n') ELSE text END")) \
        .withColumn("n_lines", F.expr("CASE WHEN text IS NULL THEN 0 ELSE size(_l) END").cast("long")) \
        .withColumn("n_equal", F.expr("CASE WHEN _e IS NULL THEN 0 ELSE size(_e) END").cast("long")) \
        .withColumn("n_near", F.expr("size(_n)").cast("long")) \
        .select(*docs.columns, "n_lines", "n_equal", "n_near")
