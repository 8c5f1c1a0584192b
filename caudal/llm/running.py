"""Running sums within keys of any size: rows are dealt by range, so a key may span tasks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.common import mapped, stored


def _reset(values: np.ndarray, total: np.ndarray, starts: np.ndarray, lengths: np.ndarray, xor: bool, carry: int) -> np.ndarray:
    """Running values that begin anew at starts, the first of them with carry."""
    at = np.repeat(total[starts] ^ values[starts] if xor else total[starts] - values[starts], lengths)
    out = total ^ at if xor else total - at
    first = slice(0, lengths[0])
    out[first] = out[first] ^ carry if xor else out[first] + carry
    return out


def running(df: DataFrame, key: str, order: Sequence[str | Column], sums: Sequence[str] = (), xors: Sequence[str] = (), name: str = "running") -> DataFrame:
    """df with `<column>_upto` for the named BIGINT columns: sums, or exclusive-ors, up to and with the row, among the rows of its
    key in the given order. key is a BIGINT without NULL, and no two rows of a key are alike in the order. The result is stored.

    A key that a third of the rows has spans many tasks: each sums up its own part, and the parts before are added. Only the first
    and the last key of a task can span more, so the table of parts has at most two rows for each task.
    """
    upto = {c: f"{c}_upto" for c in (*sums, *xors)}

    def work(batches):
        part, last, carry = TaskContext.get().partitionId(), None, dict.fromkeys(upto, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(batch.schema.get_field_index(key)).to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            lengths = np.diff(np.append(starts, len(keys)))
            out = {n: batch.column(i) for i, n in enumerate(batch.schema.names)} | {"__part": np.full(len(keys), part, dtype=np.int32)}
            for c, to in upto.items():
                values = batch.column(batch.schema.get_field_index(c)).to_numpy()
                total = np.bitwise_xor.accumulate(values) if c in xors else np.cumsum(values)
                out[to] = _reset(values, total, starts, lengths, c in xors, carry[c] if keys[0] == last else 0)
                carry[c] = int(out[to][-1])
            last = keys[-1]
            yield out

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    dealt = df.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    local = stored(mapped(dealt, work, f"{types}, __part int, {', '.join(f'{to} bigint' for to in upto.values())}"), name)
    ends = local.groupBy("__part").agg(F.array_distinct(F.array(F.min(key), F.max(key))).alias("ends"))
    several = ends.select(F.explode("ends").alias(key)).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key)
    parts = local.join(F.broadcast(several), key).groupBy(key, "__part").agg(*[F.sum(c).alias(c) for c in sums], *[F.bit_xor(c).alias(c) for c in xors])
    before = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(key, "__part", *[F.coalesce((F.bit_xor if c in xors else F.sum)(c).over(before), F.lit(0)).alias(f"__{c}") for c in upto])
    joined = local.join(F.broadcast(offsets), [key, "__part"], "left")
    added = {to: F.coalesce(F.col(f"__{c}"), F.lit(0)).bitwiseXOR(F.col(to)) if c in xors else F.col(to) + F.coalesce(F.col(f"__{c}"), F.lit(0)) for c, to in upto.items()}
    return joined.withColumns(added).select(*df.columns, *upto.values())
