"""A filter of fixed size that lets named rows pass where they are read: all that are wanted, and few others."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from swipeledger.llm.common import mixed

#: Bits of the filter, in parts, and how many each name sets.
BITS, PARTS, TIMES = 1 << 24, 256, 3


def _places(names: np.ndarray) -> np.ndarray:
    h = mixed(names.astype(np.int64).view(np.uint64))
    return np.stack([(h >> np.uint64(20 * k)) % np.uint64(BITS) for k in range(TIMES)]).astype(np.int64)


def wanted_bits(names: DataFrame) -> np.ndarray:
    """The packed filter of the numbers in the one column of ``names``. Tasks build their own and only
    bits meet, two megabytes however many names there are."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BITS, bool)
        for batch in batches:
            bits[_places(batch.column(0).to_numpy())] = True
        rows = [(k, np.packbits(x).tobytes()) for k, x in enumerate(bits.reshape(PARTS, -1)) if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.binary())], names=["part", "bits"])

    def either(table: pa.Table) -> pa.Table:
        bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in table.column("bits").to_pylist()])
        return pa.Table.from_arrays([table.column("part").slice(0, 1), pa.array([bits.tobytes()], pa.binary())], names=["part", "bits"])

    schema = "part long, bits binary"
    out = np.zeros((PARTS, BITS // PARTS // 8), np.uint8)
    for row in names.mapInArrow(places, schema).groupBy("part").applyInArrow(either, schema).collect():
        out[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def passing(there: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which names the unpacked filter ``there`` lets pass."""
    return there[_places(names)].all(0)
