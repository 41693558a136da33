"""One Arrow-batched Python pass over device-ordered partitions.

Recursive rules (the output feeds the state) cannot be window functions. They
run as: hash-partition on ``device`` (one exchange), sort within partitions on
(device, seq) (spills like any Spark sort), then ``mapInArrow`` walks the
Arrow batches carrying the state of the current device across batch borders
and resetting it at a device change. Memory stays constant however long a
device's history is; nothing is collected per group.

Arrow, not pandas, on the way back: pandas treats NaN as a missing value and
would turn a NaN reading into NULL, while here NaN is data. Columns go from
Arrow to numpy and back without any pandas step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from ..schema import MESSAGE_PLACE
from ..session import ship_package


def device_ordered(df: DataFrame, key: str = "device", order: str = "seq") -> DataFrame:
    """By key, then by the place a message came from (where the rows name it), then by offset."""
    place = [c for c in MESSAGE_PLACE if c in df.columns]
    return df.repartition(key).sortWithinPartitions(key, *place, order)


def batch_arrays(rb: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {name: col.to_numpy(zero_copy_only=False)
            for name, col in zip(rb.schema.names, rb.columns)}


def arrow_batch(arrays: dict, schema: pa.Schema) -> pa.RecordBatch:
    """numpy (or list) columns -> RecordBatch; NaN stays a value."""
    return pa.RecordBatch.from_arrays(
        [pa.array(arrays[f.name], type=f.type) for f in schema], schema=schema)


def _fold_batches(batches: Iterator[pa.RecordBatch], init_state: Callable, step: Callable,
                  key: str, arrow_schema: pa.Schema, keyed_init: bool = False,
                  keep: Callable | None = None) -> Iterator[pa.RecordBatch]:
    cur_key, state = None, None
    started = False
    for rb in batches:
        n = rb.num_rows
        if n == 0:
            continue
        arrays = batch_arrays(rb)
        keys = arrays[key]
        cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        starts = np.concatenate(([0], cut))
        ends = np.concatenate((cut, [n]))
        outs: dict[str, np.ndarray] = {}
        for s, e in zip(starts.tolist(), ends.tolist()):
            k = keys[s]
            if not started or k != cur_key:
                cur_key, started = k, True
                state = init_state(k) if keyed_init else init_state()
            result, state = step({c: a[s:e] for c, a in arrays.items()}, state)
            for c, a in result.items():
                if c not in outs:
                    outs[c] = np.empty(n, dtype=a.dtype)
                outs[c][s:e] = a
        yield from _emit(rb, arrays, outs, arrow_schema, keep)


def _emit(rb: pa.RecordBatch, arrays: dict, outs: dict, schema: pa.Schema,
          keep: Callable | None) -> Iterator[pa.RecordBatch]:
    """Changed columns are rebuilt from numpy; the others are the input's
    Arrow arrays, passed through without a copy."""
    mask = None
    if keep is not None:
        mask = keep({**arrays, **outs})
        if not mask.any():
            return
    cols = []
    for f in schema:
        if f.name in outs:
            values = outs[f.name] if mask is None else outs[f.name][mask]
            cols.append(pa.array(values, type=f.type))
        else:
            col = rb.column(rb.schema.get_field_index(f.name))
            cols.append(col if mask is None else col.filter(pa.array(mask)))
    yield pa.RecordBatch.from_arrays(cols, schema=schema)


def device_fold(df: DataFrame, init_state: Callable, step: Callable, schema=None,
                key: str = "device", order: str = "seq", keyed_init: bool = False,
                keep: Callable | None = None) -> DataFrame:
    """Run ``step(arrays_of_one_key_run, state) -> (changed_columns, state)``
    over ``df`` in (key, order) order. ``changed_columns`` maps column names
    of ``schema`` (default: ``df.schema``) to numpy arrays of the run's length.
    With ``keyed_init`` the initial state is ``init_state(key)``. ``keep``
    (columns -> row mask) drops rows inside the pass, before they are sent
    back to the JVM.
    """
    ship_package(df.sparkSession)
    out_schema = schema if schema is not None else df.schema
    arrow_schema = to_arrow_schema(out_schema)

    def fn(batches):
        yield from _fold_batches(batches, init_state, step, key, arrow_schema, keyed_init, keep)

    return device_ordered(df, key, order).mapInArrow(fn, out_schema)
