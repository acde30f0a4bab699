"""A filter of names that grows with their number up to a bound: all that are wanted pass, and few others."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from swipeledger.llm.common import mixed

#: Bits for each name, and how many of them it sets; the least and the most bits of a filter (16 MB), and of a part.
PER_NAME, TIMES = 16, 3
LEAST, MOST, PART = 1 << 19, 1 << 27, 1 << 19


def _places(names: np.ndarray, bits: int) -> np.ndarray:
    h = mixed(names.astype(np.int64).view(np.uint64))
    step = mixed(h) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([(h + np.uint64(k) * step) & np.uint64(bits - 1) for k in range(TIMES)]).astype(np.int64)


def bits_for(n: int) -> int:
    return min(max(LEAST, 1 << (PER_NAME * n - 1).bit_length() if n else LEAST), MOST)


def filter_of(names: DataFrame, n: int) -> np.ndarray:
    """The packed filter of the numbers in the one column of ``names``, about ``n`` of them. Tasks send the places that their names
    set, each part of the filter is put together in a task of its own, and the driver gets the parts: at most ``MOST`` bits.
    With more names than that is made for, more others pass."""
    bits = bits_for(n)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_places(batch.column(0).to_numpy(), bits))
            part, start = np.unique(at // PART, return_index=True)
            rows = [p.astype(np.uint32).tobytes() for p in np.split(at % PART, start[1:])] if len(part) else []
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(rows, pa.binary())], names=["part", "places"])

    def together(table: pa.Table) -> pa.Table:
        out = np.zeros(PART, bool)
        for chunk in table.column("places").to_pylist():
            out[np.frombuffer(chunk, np.uint32)] = True
        return pa.Table.from_arrays([table.column("part").slice(0, 1), pa.array([np.packbits(out).tobytes()], pa.binary())], names=["part", "bits"])

    parts = names.mapInArrow(places, "part long, places binary").groupBy("part").applyInArrow(together, "part long, bits binary")
    out = np.zeros((bits // PART, PART // 8), np.uint8)
    for row in parts.collect():
        out[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def passing(there: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which names the packed filter ``there`` lets pass."""
    out = np.ones(len(names), bool)
    for at in _places(names, 8 * len(there)):
        out &= (there[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return out
