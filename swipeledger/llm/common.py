"""What several operators of this subpackage share."""

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeledger.plans.shared_folder import new_folder

#: Words of a text: runs of anything but these six ASCII characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes that continue a character in UTF-8.
CONTINUATION = bytes(range(0x80, 0xC0))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again, so that what follows neither
    repeats its work nor depends on an executor that may be lost."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Returns to the system what earlier tasks of this Python worker, which stays for the tasks of other stages, have freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bytes_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 of each text; null is empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def n_code_points(data: bytes) -> int:
    return len(data.translate(None, CONTINUATION))


def in_slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``most_bytes`` of text (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def held_out_by(id_column: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % modulus == remainder


def most_frequent(counts: DataFrame, most: int) -> list[tuple]:
    """(word, n) of the most frequent of ``counts`` (word, n), ``most`` at most, in order. A histogram of counts tells from which
    count on there are so few, so no more than these come to the driver; words that are a little rarer stay out
    together. If the highest counts alone are more, there are none."""
    level = F.floor(8 * F.log2("n"))
    by_level = sorted(((r["level"], r["count"]) for r in counts.groupBy(level.alias("level")).count().collect()), reverse=True)
    least, held = None, 0
    for at, n in by_level:
        held += n
        if held > most:
            break
        least = at
    if least is None:
        return []
    found = counts.where(level >= least).toPandas()
    return sorted(zip(found["word"], found["n"].tolist()), key=lambda x: (-x[1], x[0]))


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit with probability a half."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _S33)) * _M1
        x = (x ^ (x >> _S33)) * _M2
        return x ^ (x >> _S33)


def uniform(seed: int, *parts: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that depend on the seed and the parts alone."""
    h = np.full(len(parts[0]), np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64))
    for part in parts:
        h = mixed(h ^ part.astype(np.uint64))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


_FACTOR = 0x9E3779B97F4A7C15 | 1
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out)


class WordHashes:
    """64-bit numbers of all words of a text at once: a word's bytes are the digits of a number to a large odd base, taken
    from running sums over the text, so there is no step per word in Python."""

    def __init__(self):
        self._up = self._down = np.zeros(0, np.uint64)

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The numbers, and where each word begins."""
        n = len(data)
        if n > len(self._up):
            self._up = _powers(_FACTOR, max(n, 1 << 16))
            self._down = _powers(pow(_FACTOR, -1, 2**64), max(n, 1 << 16))
        digits = np.frombuffer(data, np.uint8)
        space = np.ones(n + 2, bool)
        np.take(_SPACES, digits, out=space[1:-1])
        # Words begin and end by turns.
        change = np.flatnonzero(space[1:] != space[:-1])
        start, end = change[::2].copy(), change[1::2]
        sums = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            values = sums[1:]
            np.add(digits, np.uint64(1), out=values, dtype=np.uint64)
            values *= self._up[:n]
            np.cumsum(values, out=values)
            return mixed((sums[end] - sums[start]) * self._down[start]), start
