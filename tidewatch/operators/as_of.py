"""As-of join: every row takes the record of a log that was in force at its place.

Rows and log share one order (``seq``, the order of arrival). The order is cut
into chunks of ``span`` places. Within a chunk a window carries the last record
forward; what was in force when a chunk began comes from the log alone, as one
record per chunk. Rows therefore move once, dealt evenly by chunk whatever the
devices, and no row is ever held against more than its own place in the order,
however dense the log is. The log is a configuration table; only it is sorted
as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPAN = 1 << 20


def as_of(rows: DataFrame, log: DataFrame, *, order: str = "seq", span: int = SPAN) -> DataFrame:
    """``rows`` with ``rec``: of the log (from_seq, rec) the record with the
    greatest ``from_seq`` not beyond the row's place, null before the first. A
    record holds for the rows at its own place too; of several records at one
    place the greatest counts; records without a place hold nowhere."""
    span = int(span)
    chunk = f"({{0}} - pmod({{0}}, {span}L)) div {span}L"
    log = log.where("from_seq IS NOT NULL").groupBy("from_seq").agg(F.max("rec").alias("rec"))
    names = rows.columns
    left = rows.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row")).selectExpr(
        "_row", f"_row.`{order}` AS _at")
    marks = log.selectExpr("from_seq AS _at", "rec AS _own")
    both = (left.selectExpr("_row", "_at", "NULL AS _own")
            .unionByName(marks.selectExpr("NULL AS _row", "_at", "_own"))
            .withColumn("_chunk", F.expr(chunk.format("_at"))))
    inside = both.selectExpr("_row", "_chunk", (
        "last(_own, true) OVER (PARTITION BY _chunk ORDER BY _at, _row IS NOT NULL "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _own")).where("_row IS NOT NULL")
    # the record that enters each chunk: that of the last change in an earlier one
    end = left.agg(F.expr(f"max({chunk.format('_at')})").alias("_last")).withColumn("_one", F.lit(1))
    entering = (marks.withColumn("_c", F.expr(chunk.format("_at")))
                .selectExpr("_own", "_c", "lead(_c) OVER (ORDER BY _at) AS _next", "1 AS _one")
                .join(F.broadcast(end), "_one")  # one row: a global aggregate
                .selectExpr("_own AS _in", "_c", "coalesce(_next, _last) AS _to").where("_to > _c")
                .selectExpr("_in", "explode(sequence(_c + 1, _to)) AS _chunk"))
    return inside.join(entering, "_chunk", "left").selectExpr(
        *[f"_row.`{c}` AS `{c}`" for c in names], "coalesce(_own, _in) AS rec")
