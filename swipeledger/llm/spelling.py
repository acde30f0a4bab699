"""Spelling variant grouping: words over a reduced alphabet meet in their one-edit neighbourhoods and are verified as they are written."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeledger.llm.common import mixed, stored
from swipeledger.llm.sized_filter import filter_of, passing

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Spelling:
    """``symbols``: letters of the reduced alphabet. ``shortest``: code points of a word at least. ``least``: how often it comes at
    least. ``times``: how many times as often as a word its form comes at least."""

    symbols: int = 8
    shortest: int = 7
    least: int = 2
    times: int = 10


def _cut(run: Column, doc_id: Column) -> Column:
    """The run, or without one letter where 31 divides the hash of the id and the run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = F.pmod(h, F.length(run).cast("long")).cast("int")
    shorter = F.concat(F.substring(run, 1, at), run.substr(at + 2, F.length(run)))
    return F.when(h % 31 == 0, shorter).otherwise(run)


def words(documents: DataFrame, spelling: Spelling = Spelling(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n): the words of all texts and how often they come. Runs of letters are lower-cased (A to Z only) and
    some lose a letter, by a hash of the document's id (null: empty text) and the run; of the results those that are long and common enough
    are words. Counts are added within each task first. Null and empty texts have no words; every row counts."""
    text = F.translate(F.coalesce(F.col(f"`{text_column}`"), F.lit("")), _UPPER, _LOWER)
    # Shorter runs cannot give a word.
    runs = F.filter(F.split(text, "[^a-zÀ-ÿ]+"), lambda run: F.length(run) >= spelling.shortest)
    found = documents.select(F.col(f"`{id_column}`").alias("id"), F.explode(runs).alias("run")).select(_cut(F.col("run"), F.col("id")).alias("word"))
    counted = found.where(F.length("word") >= spelling.shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= spelling.least)


class Reduced:
    """Words over the reduced alphabet, as numbers: a word's symbols are the digits of a number to a large odd base, so the
    numbers of its neighbours come from sums over its digits."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, symbols: int):
        self.symbols = symbols
        self.symbol = (mixed(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(symbols)).astype(np.uint64) + np.uint64(1)
        self.back = np.uint64(pow(self.BASE, -1, 2**64))

    def _digits(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        size = np.array([len(t) for t in texts], np.int64)
        start = np.cumsum(size) - size
        data = np.frombuffer("".join(texts).encode("utf-16-le", "surrogatepass"), np.uint16)
        word = np.repeat(np.arange(len(texts)), size)
        at = np.arange(len(data)) - start[word]
        with np.errstate(over="ignore"):
            power = np.full(max(int(size.max(initial=0)), 1), self.BASE, np.uint64)
            power[0] = 1
            power = np.cumprod(power)[at]
            digit = self.symbol[data]
            before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(digit * power)])
            return size, start, word, at, power, digit, before

    def own(self, texts: list[str]) -> np.ndarray:
        """The number of each word."""
        size, start, *_, before = self._digits(texts)
        with np.errstate(over="ignore"):
            return mixed(before[start + size] - before[start]).view(np.int64)

    def around(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(word, number): the word itself, with a symbol replaced by each higher one, and with a symbol left out. With these,
        any two words one edit apart meet: of two of one length, the one whose symbol is lower gives the other (or both are the same),
        and of two others the longer one gives the shorter, so nothing has to be put in."""
        size, start, word, at, power, digit, before = self._digits(texts)
        with np.errstate(over="ignore"):
            whole = before[start + size] - before[start]
            numbers, of = [whole], [np.arange(len(texts))]
            for more in range(1, self.symbols):
                some = np.flatnonzero(digit + np.uint64(more) <= np.uint64(self.symbols))
                numbers.append(whole[word[some]] + np.uint64(more) * power[some])
                of.append(word[some])
            # Of equal neighbours each gives the same word when left out.
            first = np.ones(len(digit), bool)
            first[1:] = (digit[1:] != digit[:-1]) | (at[1:] == 0)
            some = np.flatnonzero(first)
            left = before[some] - before[start[word[some]]]
            right = (before[(start + size)[word[some]]] - before[some + 1]) * self.back
            numbers.append(left + right)
            of.append(word[some])
            return np.concatenate(of), mixed(np.concatenate(numbers)).view(np.int64)


#: Code points of words whose neighbourhoods are made at once.
SLICE = 1 << 17


def _in_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[int]]]:
    for batch in batches:
        texts, counts, held = [], [], 0
        for text, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            texts.append(text)
            counts.append(n)
            held += len(text)
            if held > SLICE:
                yield texts, counts
                texts, counts, held = [], [], 0
        if texts:
            yield texts, counts


def near(vocabulary: DataFrame, spelling: Spelling = Spelling()) -> DataFrame:
    """(a, a_n, b, b_n): every two words of ``vocabulary`` (word, n; each word once) that differ by exactly one inserted, deleted or replaced code
    point, once, with their counts.

    Letters are hashed to few symbols. Words one edit apart are at most one edit apart over these, so the full one-edit neighbourhood of each
    reduced word is made and joined to the reduced vocabulary; candidates are verified as written. A filter of
    reduced words goes to every task, so that of the neighbours only those that are words go to the join."""
    reduced = Reduced(spelling.symbols)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, counts in _in_slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(reduced.own(texts)), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], names=["key", "b", "b_n"])

    keyed = stored(vocabulary.select("word", "n").mapInArrow(own, "key long, b string, b_n long"))
    there = filter_of(keyed.select("key"), keyed.count())

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, counts in _in_slices(batches):
            of, keys = reduced.around(texts)
            kept = np.flatnonzero(passing(there, keys))
            of = pa.array(of[kept])
            yield pa.RecordBatch.from_arrays([pa.array(keys[kept]), pa.array(texts, pa.string()).take(of), pa.array(counts, pa.int64()).take(of)], names=["key", "a", "a_n"])

    asked = keyed.select(F.col("b").alias("word"), F.col("b_n").alias("n")).mapInArrow(around, "key long, a string, a_n long")
    both = asked.join(keyed, "key").where((F.col("a") != F.col("b")) & (F.abs(F.length("a") - F.length("b")) <= 1))
    one, other = F.struct(F.col("a").alias("w"), F.col("a_n").alias("n")), F.struct(F.col("b").alias("w"), F.col("b_n").alias("n"))
    # Of two words of one reduced form, each finds the other.
    found = both.where(F.levenshtein("a", "b", 1) == 1).select(F.least(one, other).alias("x"), F.greatest(one, other).alias("y")).distinct()
    return found.select(F.col("x.w").alias("a"), F.col("x.n").alias("a_n"), F.col("y.w").alias("b"), F.col("y.n").alias("b_n"))


def forms(vocabulary: DataFrame, spelling: Spelling = Spelling()) -> DataFrame:
    """For each word of ``vocabulary`` (word, n): ``form``, the most common of the words near it (ties: the first in code-point order) if that
    comes ``times`` as often, else null; ``root``, where following forms ends; ``n``; ``n_near``, how many words are near; ``form_n``.

    A form comes several times as often as its word, so chains of forms are short and have no circles; roots are found by
    doubling the steps. Only links that pass the verification are shuffled; a word that very many words are near adds up in each task first.
    An empty vocabulary gives no rows; words with a null or repeated ones are not expected, as ``words`` gives none."""
    vocabulary = stored(vocabulary.select("word", "n"))
    links = stored(near(vocabulary, spelling))
    there = links.select(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    back = links.select(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    alone = vocabulary.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))))
    found = alone.unionByName(there).unionByName(back).groupBy("word", "n").agg(F.count("near").alias("n_near"), best.alias("best"))
    common = -F.col("best.less") >= spelling.times * F.col("n")
    found = stored(found.select("word", "n", "n_near", F.when(common, F.col("best.near")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n")))

    roots = stored(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = stored(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        roots = now.select("word", "root")
        if now.where("moved").isEmpty():
            break
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
