"""Combining by accumulators of the user's own: create, add, merge, extract.

Every task folds the values it reads into one accumulator per key before anything is shuffled, so what is shuffled is a
row per key and task, and a hot key costs no more than any other. Use ``group.combine_per_key`` for what Spark can
aggregate itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_STATE = "__state"


@dataclass(frozen=True)
class Accumulator:
    """``add`` takes the values of one key that came in one batch, nulls included, as an Arrow array. ``merge`` must be
    associative and commutative and ``create()`` neutral to it; states and results are Python values of the given types."""

    create: Callable[[], Any]
    add: Callable[[Any, pa.Array], Any]
    merge: Callable[[Any, Any], Any]
    extract: Callable[[Any], Any]
    state: T.DataType
    result: T.DataType


def _groups(batch: pa.RecordBatch, keys: Sequence[str]) -> Iterator[tuple[tuple, pa.Array]]:
    """Keys of a batch and the rows of each; nulls are a key like any other."""
    code = np.zeros(batch.num_rows, np.int64)
    for key in keys:
        coded = pc.dictionary_encode(batch.column(key), null_encoding="encode")
        code = code * len(coded.dictionary) + coded.indices.to_numpy()
        code = np.unique(code, return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    starts = np.flatnonzero(np.diff(code[order], prepend=-1))
    for lo, hi in zip(starts, [*starts[1:], len(order)]):
        at = int(order[lo])
        yield tuple(batch.column(key)[at].as_py() for key in keys), pa.array(order[lo:hi])


def _partial(acc: Accumulator, keys: list[str], value: str, schema: pa.Schema, most_keys: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Any] = {}

        def rows() -> pa.RecordBatch:
            made = [{**dict(zip(keys, key)), _STATE: state} for key, state in held.items()]
            held.clear()
            return pa.RecordBatch.from_pylist(made, schema)

        for batch in batches:
            values = batch.column(value)
            for key, at in _groups(batch, keys):
                held[key] = acc.add(held[key] if key in held else acc.create(), values.take(at))
            if len(held) > most_keys:
                yield rows()
        if held:
            yield rows()

    return run


def _merged(acc: Accumulator, keys: list[str], name: str, schema: pa.Schema):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        whole = reduce(acc.merge, table.column(_STATE).to_pylist(), acc.create())
        return pa.Table.from_pylist([{**dict(zip(keys, (k.as_py() for k in key))), name: acc.extract(whole)}], schema)

    return run


def combine_accumulated(
    df: DataFrame, keys: Sequence[str], value: str, acc: Accumulator, name: str, most_keys: int = 100_000
) -> DataFrame:
    """One row per key with ``extract`` of its accumulator, as column ``name``; no input, no output row.

    A task holds accumulators of at most ``most_keys`` keys (and one batch's more) before it passes them on. Without keys
    everything is one accumulator. Keys may be null; a value column of any type is handed over as it is.
    """
    keys = list(keys)
    fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
    between = T.StructType([*fields, T.StructField(_STATE, acc.state)])
    after = T.StructType([*fields, T.StructField(name, acc.result)])
    rows = df.select(*dict.fromkeys([*keys, value]))
    partials = rows.mapInArrow(_partial(acc, keys, value, to_arrow_schema(between), most_keys), between)
    return partials.groupBy(*keys).applyInArrow(_merged(acc, keys, name, to_arrow_schema(after)), after)
