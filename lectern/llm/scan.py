"""Running places, sums and digests over groups of any size.

A group may hold most of the rows, so no window is laid over it: rows are ranged
and sorted, each task scans its own share as if nothing stood before it, and what
a group has gathered in earlier shares is added afterwards. Only one row a share
goes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import drop_tables, materialize

#: Odd bases of the two lanes of a running digest, a polynomial modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_NOTHING = object()
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(lane: int, n: int) -> np.ndarray:
    if len(_powers[lane]) < n:
        p = np.full(1 << (n - 1).bit_length(), BASES[lane], np.uint64)
        p[0] = 1
        _powers[lane] = np.multiply.accumulate(p)
    return _powers[lane]


def lanes_of(digests: pa.Array) -> list[np.ndarray]:
    """The first two 64-bit words of each digest of a binary column."""
    raw = np.frombuffer(b"".join(x[:16] for x in digests.to_pylist()), "<u8")
    return [raw[0::2], raw[1::2]]


def _local(batches: Iterator[pa.RecordBatch], group: str, total: str | None, chain: str | None) -> Iterator[pa.RecordBatch]:
    part, seq, last, index, before, sums = TaskContext.get().partitionId(), 0, _NOTHING, 0, 0, [0, 0]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = batch.column(group)
        code = keys.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new = np.empty(n, bool)
        new[0], new[1:] = last is _NOTHING or keys[0].as_py() != last, code[1:] != code[:-1]
        place = np.arange(n)
        start = np.maximum.accumulate(np.where(new, place, 0))
        open_ = slice(0, n if not new.any() else int(np.argmax(new)))  # rows of the group that the batch before ended in
        at = place - start
        at[open_] += index
        cols = [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(seq + place), pa.array(at)]
        index, seq, last = int(at[-1]) + 1, seq + n, keys[n - 1].as_py()
        if total:
            v = batch.column(total).to_numpy()
            c = np.cumsum(v) - v
            c = c - c[start]
            c[open_] += before
            before = int(c[-1] + v[-1])
            cols.append(pa.array(c))
        if chain:
            for k, x in enumerate(lanes_of(batch.column(chain))):
                term = x * _power(k, int(at.max()) + 1)[at]
                c = np.cumsum(term)
                c = c - (c - term)[start]
                c[open_] += np.uint64(sums[k])
                sums[k] = int(c[-1])
                cols += [pa.array(c.view(np.int64)), pa.array((c - term).view(np.int64))]
        yield cols


def running(rows: DataFrame, group: str, order: list[Column], total: str | None = None, chain: str | None = None) -> DataFrame:
    """``rows`` with ``index``, the row's place in its group from 0 on.

    ``total`` names a long column whose sum over the group's earlier rows becomes
    ``before``. ``chain`` names a binary column: ``a`` and ``b`` then digest the
    group's values up to this row, ``pa`` and ``pb`` those before it. ``order``
    must tell all rows of a group apart, so that shares can be cut anywhere.
    """
    extra = ["part int", "seq long", "index long"] + ["before long"] * bool(total) + ["a long", "pa long", "b long", "pb long"] * bool(chain)
    schema = T.StructType(rows.schema.fields + T.StructType.fromDDL(", ".join(extra)).fields)
    names = schema.names

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in _local(batches, group, total, chain):
            yield pa.RecordBatch.from_arrays(cols, names=names)

    keys = [F.col(group).asc_nulls_first(), *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    local = materialize(ranged.mapInArrow(scan, schema), "scanned")
    ends = F.struct(F.col(group).alias("g"), "index", *(["before", F.col(total).alias("v")] if total else []), *(["a", "b"] if chain else []))
    shares = local.groupBy("part").agg(F.min_by(F.struct(F.col(group).alias("g")), "seq").alias("first"), F.max_by(ends, "seq").alias("last")).orderBy("part").collect()
    carried, held = {}, None
    for s in shares:
        first, last = s["first"]["g"], s["last"]
        got = (last["index"] + 1, last["before"] + last["v"] if total else 0, last["a"] % (1 << 64) if chain else 0, last["b"] % (1 << 64) if chain else 0)
        if held and held[0] == first:
            carried[s["part"]] = held
            if last["g"] == first:
                n, v, *sums = held[1]
                moved = [(x + pow(BASES[k], n, 1 << 64) * got[2 + k]) % (1 << 64) for k, x in enumerate(sums)]
                got = (n + got[0], v + got[1], *moved)
        held = (last["g"], got)

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("part").to_numpy()
            for part in set(np.unique(parts).tolist()) & carried.keys():
                value, (n, v, *sums) = carried[part]
                keys = batch.column(group)
                same = pc.is_null(keys) if value is None else pc.fill_null(pc.equal(keys, pa.scalar(value, keys.type)), False)
                rows_ = np.flatnonzero((parts == part) & same.to_numpy(zero_copy_only=False))

                def put(name: str, of, batch: pa.RecordBatch, rows_: np.ndarray = rows_) -> pa.RecordBatch:
                    col = batch.column(name).to_numpy(zero_copy_only=False).copy()
                    col[rows_] = of(col[rows_])
                    return batch.set_column(batch.schema.get_field_index(name), name, pa.array(col))

                batch = put("index", lambda x, n=n: x + n, batch)
                if total:
                    batch = put("before", lambda x, v=v: x + v, batch)
                for k, name in enumerate("ab" if chain else ""):
                    power, first = np.uint64(pow(BASES[k], n, 1 << 64)), np.uint64(sums[k])
                    for c in (name, f"p{name}"):
                        batch = put(c, lambda x, power=power, first=first: (x.view(np.uint64) * power + first).view(np.int64), batch)
            yield batch

    out = local.mapInArrow(carry, schema) if carried else local
    return out.drop("part", "seq")
