"""A recursive per-device fold, split across seq-range chunks of hot devices.

A recursive rule's state at a chunk border depends on everything before it,
so chunks cannot simply run independently. They run *speculatively*: every
chunk of a hot device is processed in parallel, its state first warmed on the
readings of the previous chunk's tail (the last ``warm`` seq values, copied
into the chunk and not emitted). The windows of these rules hold the last few
values only, so a warm-up that saw enough readings arrives in exactly the
state the true run has there.

Exactness is then checked, not assumed: each chunk reports the state it
started from (after the warm-up) and the state it ended in. A chunk is right
when its start state equals the end state of the previous chunk (by induction
from the first chunk, which starts from the empty state). Borders where this
fails are repaired in rounds: the chunks behind broken borders run again at
once, each from the end state its predecessor has now (of adjacent ones the
first, as the others depend on it). A chunk that ends as it
did before breaks nothing further; one that ends differently breaks the next
border, which is the next round's. The rounds stop when no border is broken.
Where that has not come after a few rounds, a device's chunks are taken in
blocks of 4, 16, 64, ...: the first broken border of a block goes on to the
block's end, through the broken ones behind it, and skips from a chunk that ends
as before to the next broken border. A block as long as the device leaves none
broken, so that a state that never settles costs what an unsplit fold costs a
round, in a logarithmic number of rounds, however many borders are broken.

The pass runs on Arrow batches (NaN readings stay NaN). Its output is
materialised once with ``checkpoint()`` in the shared
checkpoint folder, which both cuts the lineage and lets the check read it
without running the Python pass twice.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import ensure_checkpoint_dir, ship_package
from .device_pass import arrow_batch, batch_arrays
from .skew import MAX_BROADCAST_KEYS, HotSet

KEY = "device"
ORDER = "seq"

# Rounds that rerun one chunk behind each broken border; the blocks of later
# ones grow by a factor.
SINGLE_ROUNDS = 3
BLOCK_GROWTH = 4

# What the last call did: the rounds and the chunk runs of the repair (for
# tests and run reports).
LAST_RUN: dict = {}


def _state_text(state) -> str:
    return json.dumps(state, separators=(",", ":"))


def _state_from_text(text: str):
    return json.loads(text)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _chunk_pass(batches, fold, arrow_schema, to_state, from_state, keep=None):
    """Fold over (device, _from, _chunk, _mark, seq)-sorted batches. Emits the
    real rows (``_kind`` 0) and, per chunk, one summary row (``_kind`` 1) with
    the entry and exit states. Warm rows advance the state only. In a repair,
    every chunk opens with a mark row: those of broken borders hold the state
    their predecessor ended in, each holds the end state its chunk had before. A
    chunk that ends so again settles the run: what follows is skipped up to the
    next broken border, which starts from the state it holds."""
    at, border, state, entry, old, settled = None, None, None, None, None, False
    summaries: list[dict] = []
    names = arrow_schema.names
    view = getattr(fold, "verify_view", lambda st: st)
    opener = getattr(fold, "open_chunk", lambda st: st)
    extra = getattr(fold, "summary_extra", lambda st: {})
    restore = getattr(fold, "restore_state", lambda st: st)

    def close() -> bool:
        """Report the chunk; whether it ended as it did before."""
        # chunks that only received warm-up rows are not chunks of their own
        if at is None or entry is None:
            return False
        end = to_state(view(state))
        summaries.append({KEY: at[0], "_chunk": at[2], "_kind": 1, "_entry": entry, "_exit": end,
                          "_exit_full": to_state(state), **extra(state)})
        return end == old

    def summary_batch():
        cols = {c: [r.get(c) for r in summaries] for c in names}
        summaries.clear()
        return arrow_batch(cols, arrow_schema)

    for rb in batches:
        n = rb.num_rows
        if n == 0:
            continue
        arrays = batch_arrays(rb)
        dev, chunk, first = arrays[KEY], arrays["_chunk"], arrays["_from"]
        warm, mark = arrays["_warm"].astype(bool), arrays["_mark"].astype(bool)
        cut = np.flatnonzero((dev[1:] != dev[:-1]) | (chunk[1:] != chunk[:-1]) | (first[1:] != first[:-1])
                             | (warm[1:] != warm[:-1]) | (mark[1:] != mark[:-1])) + 1
        starts = np.concatenate(([0], cut)).tolist()
        ends = np.concatenate((cut, [n])).tolist()
        outs: dict[str, np.ndarray] = {}
        real = ~warm & ~mark
        for s, e in zip(starts, ends):
            g = (dev[s], int(first[s]), int(chunk[s]))
            given = arrays["_state"][s] if mark[s] else None
            if g != at:
                settled = close() or settled
                opens = g[:2] != border
                if opens:
                    border, state = g[:2], fold.init_state()
                if given is None or not (opens or settled):
                    given = None  # under way: the state at hand is the later one
                if opens or given is not None:
                    settled = False
                at, entry, old = g, None, None
            if settled:
                entry = None
                real[s:e] = False
                continue
            if mark[s]:
                if given is not None:
                    given = from_state(given)
                    # as a chunk reported it, or as it was kept from an earlier slice
                    state = fold.resume_state(**given) if isinstance(given, dict) else restore(given)
                old = arrays["_old"][s]
            if not warm[s] and entry is None:
                entry = to_state(view(state))
                state = opener(state)
            if mark[s]:
                continue
            result, state = fold.step({c: a[s:e] for c, a in arrays.items()}, state)
            if not warm[s]:
                for c, a in result.items():
                    if c not in outs:
                        outs[c] = np.zeros(n, dtype=a.dtype)
                    outs[c][s:e] = a
        merged = {**arrays, **outs}
        if keep is not None and outs:
            real = real & keep(merged)
        if outs and real.any():
            m = int(real.sum())
            cols = {c: merged[c][real] for c in names if c in merged}
            cols["_kind"] = np.zeros(m, dtype=np.int32)
            for c in names:
                if c not in cols:
                    cols[c] = [None] * m
            yield arrow_batch(cols, arrow_schema)
        if summaries:
            yield summary_batch()
    close()
    if summaries:
        yield summary_batch()


def _placeholder(field: T.StructField) -> str:
    """A value for a mark row; no nulls where numpy would change the type."""
    kind = field.dataType.simpleString()
    plain = isinstance(field.dataType, (T.NumericType, T.BooleanType))
    return f"CAST({'0' if plain else 'NULL'} AS {kind}) AS {field.name}"


def _broken_borders(summary: DataFrame, length: int) -> DataFrame:
    """(device, _chunk, _from, _state, _old): of every block of ``length`` chunks of
    a device the first one whose entry state differs from its predecessor's exit
    (of adjacent ones the first, the others wait for what it ends in), and what
    follows it in the block; ``_state``, the predecessor's, on the broken ones."""
    by = f"(PARTITION BY {KEY} ORDER BY _chunk)"
    return (summary.selectExpr(KEY, "_chunk", "_entry", "_exit AS _old", f"lag(_exit) OVER {by} AS _prev",
                               f"lag(_exit_full) OVER {by} AS _state",
                               f"(row_number() OVER {by} - 1) div {int(length)} AS _block")
            .selectExpr("*", "coalesce(_entry <> _prev, false) AS _broken")
            .selectExpr("*", f"_broken AND NOT lag(_broken, 1, false) OVER {by} AS _head")
            .selectExpr("*", f"min(CASE WHEN _head THEN _chunk END) OVER (PARTITION BY {KEY}, _block) AS _from")
            .where("_chunk >= _from")
            .selectExpr(KEY, "_chunk", "_from", "CASE WHEN _broken THEN _state END AS _state", "_old"))


def chunked_device_fold(df: DataFrame, fold, hot: HotSet, schema: T.StructType | None = None,
                        warm: int | None = None, to_state=_state_text,
                        from_state=_state_from_text, keep=None) -> DataFrame:
    """Exact result of ``device_fold(df, fold.init_state, fold.step)`` with
    hot devices split into chunks (see the module doc). The warm-up of each
    device is the seq length the hot set computed for it (about ``warm_rows``
    readings), or ``warm`` seq values when given.

    ``fold`` may carry part of its state across borders itself instead of
    having it verified (``verify_view``, ``open_chunk``, ``summary_extra``,
    ``carry_table``, ``carry_fix``, ``restore_state``; see ``CleaningFold``)."""
    return _chunked(df, fold, hot, schema, warm, to_state, from_state, keep)[0]


def chunked_fold_states(df: DataFrame, fold, hot: HotSet, schema: T.StructType | None = None,
                        prior: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The same for one slice of an unbounded input: each device's first chunk
    starts from its row of ``prior`` (device, state, starts; none: from the
    empty state), and (device, state, starts, last) after the slice come back
    as a second frame, one row a device of ``df``. Devices that are not in the
    slice are left out before the pass."""
    rows, summary = _chunked(df, fold, hot, schema, prior=prior)
    return rows, fold.end_states(summary)


def _flagged(df: DataFrame, hot: HotSet, warm_len: str) -> DataFrame:
    if not hot.any:
        return df.sparkSession.createDataFrame([], f"{KEY} string, _hot boolean, _warm_len bigint")
    return hot.devices.selectExpr(KEY, "true AS _hot", f"CAST({warm_len} AS BIGINT) AS _warm_len")


def _prior_marks(df: DataFrame, flagged: DataFrame, prior: DataFrame, span: int) -> DataFrame:
    """The mark row that opens each device's first chunk with its earlier state."""
    first = df.join(flagged, KEY).groupBy(KEY).agg(F.min(F.expr(f"{ORDER} div {span}")).alias("_first"))
    seen = prior.join(df.select(KEY).distinct(), KEY, "left_semi").join(first, KEY, "left")
    at = "CAST(coalesce(_first, 0) AS BIGINT)"
    return seen.selectExpr(*[KEY if f.name == KEY else _placeholder(f) for f in df.schema.fields],
                           f"{at} AS _chunk", "false AS _warm", f"{at} AS _from", "true AS _mark",
                           "concat('{\"state\":', state, ',\"starts\":', coalesce(to_json(starts), 'null'), '}') AS _state",
                           "CAST(NULL AS STRING) AS _old")


def _chunked(df: DataFrame, fold, hot: HotSet, schema: T.StructType | None = None,
             warm: int | None = None, to_state=_state_text, from_state=_state_from_text,
             keep=None, prior: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows, and the chunk summaries after the last repair."""
    out_schema = schema if schema is not None else df.schema
    span = int(hot.plan.span)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    carries = getattr(fold, "carries_starts", False)

    warm_len = str(int(warm)) if warm is not None else "warm"
    flagged = _flagged(df, hot, warm_len)
    flagged = F.broadcast(flagged) if hot.count <= MAX_BROADCAST_KEYS else flagged
    data = (df.join(flagged, KEY, "left")
            .selectExpr(*df.columns,
                        f"CAST(CASE WHEN _hot THEN {ORDER} div {span} ELSE 0 END AS BIGINT) AS _c0",
                        f"explode(CASE WHEN _hot AND {ORDER} % {span} >= {span} - _warm_len "
                        "THEN array(0, 1) ELSE array(0) END) AS _copy")
            .selectExpr(*df.columns, "_c0 + _copy AS _chunk", "_copy = 1 AS _warm"))

    pass_schema = _nullable(T.StructType(
        list(out_schema.fields)
        + (list(fold.carry_fields) if carries else [])
        + [T.StructField("_chunk", T.LongType()), T.StructField("_kind", T.IntegerType()),
           T.StructField("_entry", T.StringType()), T.StructField("_exit", T.StringType()),
           T.StructField("_exit_full", T.StringType())]
        + (list(fold.summary_fields) if carries else [])))
    arrow_schema = to_arrow_schema(pass_schema)

    def fn(batches):
        yield from _chunk_pass(batches, fold, arrow_schema, to_state, from_state, keep)

    order = (KEY, "_from", "_chunk")

    def run(rows: DataFrame, number: int) -> DataFrame:
        out = rows.repartition(KEY, "_from").sortWithinPartitions(*order, F.desc("_mark"), ORDER) \
            .mapInArrow(fn, pass_schema)
        return out.withColumn("_round", F.lit(number)).checkpoint(eager=True)

    plain = ("false AS _mark", "CAST(NULL AS STRING) AS _state", "CAST(NULL AS STRING) AS _old")
    opening = data.selectExpr("*", "_chunk AS _from", *plain)
    if prior is not None:
        opening = opening.unionByName(_prior_marks(df, flagged, prior, span))
    out = run(opening, 0)
    rows = out.where("_kind = 0")
    summary = out.where("_kind = 1")
    rounds = runs = 0
    while True:
        length = BLOCK_GROWTH ** max(0, rounds + 1 - SINGLE_ROUNDS)
        broken = _broken_borders(summary, length).persist()
        count = broken.count()
        if not count:
            broken.unpersist()
            break
        rounds += 1
        marks = broken.selectExpr(*[KEY if f.name == KEY else _placeholder(f) for f in df.schema.fields],
                                  "_chunk", "false AS _warm", "_from", "true AS _mark", "_state", "_old")
        wanted = broken.select(KEY, "_chunk", "_from")
        wanted = F.broadcast(wanted) if count <= MAX_BROADCAST_KEYS else wanted
        again = data.where("NOT _warm").join(wanted, [KEY, "_chunk"]).selectExpr(
            *data.columns, "_from", *plain)
        out = run(again.unionByName(marks), rounds)
        broken.unpersist()
        rows = rows.union(out.where("_kind = 0"))
        done = out.where("_kind = 1")
        runs += done.count()
        summary = (summary.join(done.select(KEY, "_chunk"), [KEY, "_chunk"], "left_anti").select(*done.columns)
                   .union(done).checkpoint(eager=True))
    LAST_RUN.clear()
    LAST_RUN.update(rounds=rounds, rerun=runs)

    if rounds:  # of a chunk that ran again the last run counts
        last = summary.where("_round > 0").select(KEY, "_chunk", F.col("_round").alias("_last"))
        last = F.broadcast(last) if runs <= MAX_BROADCAST_KEYS else last
        rows = rows.join(last, [KEY, "_chunk"], "left").where("_round = coalesce(_last, 0)")
    if carries:
        rows = fold.carry_fix(rows, fold.carry_table(summary))
    return rows.select(*out_schema.fieldNames()), summary
