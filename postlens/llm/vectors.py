"""Vectors as rows of integers, for the operators that compute on whole batches of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Integers below this are exact as doubles.
EXACT = 1 << 53
#: Components are held within this many either way.
CLAMP = float(1 << 62)
#: A table whose vectors have more lengths than this is not one of embeddings.
LENGTHS = 256


def _integers(scale: float):
    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            values = lists.values.cast(pa.float64(), safe=False).fill_null(np.nan).to_numpy(zero_copy_only=False)
            at = lists.offsets.to_numpy().astype(np.int64)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            good = lists.is_valid().to_numpy(zero_copy_only=False) & (bad[at[1:]] == bad[at[:-1]])
            n, size = int(good.sum()), np.diff(at)[good]
            end = np.cumsum(size)
            mine = values[np.repeat(at[:-1][good] - (end - size), size) + np.arange(int(size.sum()))]
            data = np.clip(np.floor(mine * scale), -CLAMP, CLAMP).astype("<i8")
            most = np.zeros(n)
            some = np.flatnonzero(size)
            if len(some):
                most[some] = np.maximum.reduceat(np.abs(data.astype(np.float64)), (end - size)[some])
            vector = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(np.concatenate([[0], 8 * end]).astype(np.int64)), pa.py_buffer(data)])
            kept = batch.filter(pa.array(good)).drop_columns(["embedding"])
            for name, column in (("size", pa.array(size, pa.int32())), ("most", pa.array(most)), ("vector", vector.cast(pa.binary()))):
                kept = kept.append_column(name, column)
            yield kept

    return integers


def integer_rows(rows: DataFrame, scale: float) -> DataFrame:
    """``rows`` with ``size, most, vector`` in place of ``embedding``: the components' number, the greatest
    absolute one, and ``floor(scale * x)`` of each as little-endian longs (held within 2**62 either way).

    Rows whose vector is null or holds a null or a non-finite component are left out.
    """
    kinds = [(n, t) for n, t in rows.dtypes if n != "embedding"]
    schema = ", ".join(f"`{n}` {t}" for n, t in kinds) + ", size int, most double, vector binary"
    return rows.select(*[n for n, _ in kinds], F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(_integers(scale), schema)


def matrix(batch: pa.Table | pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch, all of one length, a row each."""
    return np.frombuffer(b"".join(batch.column("vector").to_pylist()), "<i8").reshape(batch.num_rows, -1)


def sizes(rows: DataFrame) -> list[tuple[int, int, float]]:
    """Length, rows and greatest absolute component of each length, in order; at most LENGTHS of them."""
    found = rows.groupBy("size").agg(F.count("*").alias("n"), F.max("most").alias("most")).orderBy("size").limit(LENGTHS + 1).collect()
    if len(found) > LENGTHS:
        raise ValueError(f"vectors of more than {LENGTHS} lengths")
    return [(r.size, r.n, r.most) for r in found]
