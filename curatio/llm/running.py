"""Running sums over a whole table in a stated order.

Rows are range-partitioned and sorted; each task sums its own rows as they
stream by, and what a partition takes over from those before it is made from
one row a partition. No task sees more than its range, so one group (or the
whole table) may be of any size. Sums are of 64 bits and wrap around."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatio.llm.scratch import Scratch
from curatio.operators.util import ship_by_value

PART, ROW, FIRST = "__part", "__row", "__first"


def _long(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def running(df: DataFrame, order: list, sums: list[str], scratch: Scratch, name: str,
            group: str | None = None) -> DataFrame:
    """``df`` with ``<c>_before`` and ``<c>_upto`` for each column c of ``sums``
    (longs without nulls): its sum over the rows before, and up to, this one in
    ``order`` (column names or expressions), anew for each value of ``group``,
    which must come first in the order. Rows that tie in the whole order come
    in any order. ``df`` must give the same rows each time it is computed."""
    ship_by_value(__name__)
    order = [F.col(c) if not isinstance(c, Column) else c for c in order]
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = df.columns

    def local(batches):
        part, row, first, seen, total = TaskContext.get().partitionId(), 0, True, None, np.zeros(len(sums), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)             # rows that begin a group
            if group is not None:
                g = batch.column(group).to_numpy(zero_copy_only=False)
                new[1:] = g[1:] != g[:-1]
                new[0] = row > 0 and g[0] != seen
                seen = g[-1]
            begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            carried = ~np.logical_or.accumulate(new)         # still in the group of the batch before
            out = []
            for k, c in enumerate(sums):
                x = batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                s = np.concatenate([np.zeros(1, np.int64), np.cumsum(x)])
                base = np.where(carried, -total[k], s[begin])
                out += [pa.array(s[:-1] - base), pa.array(s[1:] - base)]
                total[k:k + 1] = s[-1:] - base[-1:]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *out, pa.array(np.full(n, part)), pa.array(np.arange(row, row + n)),
                 pa.array(carried & first)], names=[*batch.schema.names, *made, PART, ROW, FIRST])
            row += n
            first = first and bool(carried[-1])

    made = [f"{c}_{w}" for c in sums for w in ("before", "upto")]
    schema = T.StructType([*df.schema.fields, *map(_long, made), _long(PART), _long(ROW),
                           T.StructField(FIRST, T.BooleanType())])
    part = scratch.put(sorted_rows.mapInArrow(local, schema), f"{name}-local")
    tail = F.struct(*[F.col(f"{c}_upto").alias(c) for c in sums], F.col(FIRST).alias("whole"),
                    *([F.col(group).alias("g")] if group else []))
    head = F.min_by(F.col(group) if group else F.lit(0), ROW).alias("head")
    ends = part.groupBy(PART).agg(head, F.max_by(tail, ROW).alias("tail")).collect()      # a row a partition

    taken, last, carry = {}, None, [0] * len(sums)
    for e in sorted(ends, key=lambda e: e[PART]):
        if group is not None and e["head"] != last:
            carry = [0] * len(sums)
        taken[e[PART]] = carry
        own = [e["tail"][c] for c in sums]
        carry = [(a + b) % (1 << 64) for a, b in zip(own, carry)] if e["tail"]["whole"] else own
        last = e["tail"]["g"] if group else None
    parts = np.array(sorted(taken) or [0], np.int64)
    offset = np.array([[x % (1 << 64) for x in taken.get(p, [0] * len(sums))] for p in parts], np.uint64).view(np.int64)

    def whole(batches):
        for batch in batches:
            at = np.searchsorted(parts, batch.column(PART).to_numpy(zero_copy_only=False))
            first = batch.column(FIRST).to_numpy(zero_copy_only=False).astype(bool)
            cols = [batch.column(c) for c in kept]
            for k, c in enumerate(made):
                x = batch.column(c).to_numpy(zero_copy_only=False)
                cols.append(pa.array(x + np.where(first, offset[at, k // 2], 0)))
            yield pa.RecordBatch.from_arrays(cols, names=[*kept, *made])

    return part.mapInArrow(whole, T.StructType([*df.schema.fields, *map(_long, made)]))
