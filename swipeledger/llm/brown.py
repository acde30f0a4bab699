"""Class-based n-grams: exchange clustering puts words into classes; a text is scored by the transitions between
classes and the emission of words from them."""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeledger.llm.common import bytes_of, held_out_by, most_frequent, stored

#: What is taken from the count of a seen word; unseen words share it, assumed to be as many as the seen ones.
DISCOUNT = 0.5
#: What is added to every count of the base score.
ADDED = 0.1
ENDING = 3


@dataclass(frozen=True)
class Size:
    """``frequent``: words that are clustered one by one, to begin with. ``endings``: of all other words, those with one of as many
    common endings (three bytes) begin together, and the rest is one item; then each of these words moves to the class of its own that
    suits it. ``classes``: 256 at most. ``local``: words whose counts and classes every task gets; those of all others are joined."""

    frequent: int = 500
    endings: int = 120
    classes: int = 48
    sweeps: int = 8
    local: int = 150_000


def tokens_of(text: bytes) -> list[bytes]:
    return text.lower().split()


class Items:
    """The item that a word begins in: 0 is the end, then the frequent words, the endings, and all the rest."""

    def __init__(self, frequent: list[bytes], endings: list[bytes]):
        self.fixed = {w: i for i, w in enumerate(frequent, 1)}
        self.by_ending = {e: i for i, e in enumerate(endings, 1 + len(frequent))}
        self.rest = 1 + len(frequent) + len(endings)

    def __call__(self, word: bytes) -> int:
        return self.fixed.get(word) or self.by_ending.get(word[-ENDING:]) or self.rest


class Numbered(dict):
    """Words numbered from 1 on as they are first looked up."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 1
        return n


def whole(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Rows sorted by ``column`` in tables that divide the rows of no value."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(column)
        start = pc.index(key, key[-1]).as_py()
        if held and (start or held[-1].column(column)[-1] != key[-1]):
            yield pa.Table.from_batches([*held, batch.slice(0, start)])
            held = []
        elif start:
            yield pa.Table.from_batches([batch.slice(0, start)])
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def word_counts(documents: DataFrame, text_column: str = "text", remembered: int = 300_000) -> DataFrame:
    """(word, n) over all rows. Every task adds up its own words first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in bytes_of(batch.column(0)):
                seen.update(tokens_of(text))
                if len(seen) > remembered:
                    yield out(seen)
                    seen.clear()
        yield out(seen)

    def out(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    return documents.select(text_column).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _binaries(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """``data`` cut into parts of so many bytes."""
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def contexts(documents: DataFrame, items: Items, text_column: str = "text", most_tokens: int = 1_000_000, most_words: int = 300_000) -> DataFrame:
    """(word, n, places), of a word some rows: for each of ``n`` places of a word that is not fixed the items before and after it, two
    16-bit numbers. With a word of ``\\n`` and a number, which no text has, (pair, n): how often item ``pair // (rest + 1)`` is followed by item
    ``pair % (rest + 1)``; a text begins after an end."""
    base, n_fixed = items.rest + 1, len(items.fixed)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n_held = Numbered(), [], 0
        for batch in batches:
            for text in bytes_of(batch.column(0)):
                held.append(np.array([0, *map(number.__getitem__, tokens_of(text))], np.int64))
                n_held += len(held[-1])
                if n_held > most_tokens or len(number) > most_words:
                    yield out(number, held)
                    number, held, n_held = Numbered(), [], 0
        if held:
            yield out(number, held)

    def out(number: Numbered, held: list[np.ndarray]) -> pa.RecordBatch:
        ids = np.concatenate([*held, [0]])
        item = np.array([0, *map(items, number)])[ids]
        pairs, n_pairs = np.unique(item[:-1] * base + item[1:], return_counts=True)
        at = np.flatnonzero(item > n_fixed)
        at = at[np.argsort(ids[at], kind="stable")]
        words, n = np.unique(ids[at], return_counts=True)
        around = np.stack([item[at - 1], item[at + 1]], 1).astype("<u2")
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([pa.array(list(number), pa.binary()).take(pa.array(words - 1)), pa.array([b"\n%d" % p for p in pairs.tolist()], pa.binary())]).cast(pa.string()),
                pa.array(np.concatenate([n, n_pairs]), pa.int64()),
                _binaries(around, np.concatenate([4 * n, 0 * n_pairs])),
            ],
            names=["word", "n", "places"],
        )

    return documents.select(text_column).mapInArrow(count, "word string, n long, places binary")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """The class of each item. Item 0 is class 0, alone. Items begin in classes by frequency; then each in turn
    moves to the class in which the pair counts of classes are most likely, until none moves."""
    n = len(pairs)
    often = np.argsort(-pairs.sum(0), kind="stable")
    often = often[often != 0]
    of = np.zeros(n, np.int64)
    of[often] = 1 + np.arange(n - 1) % (classes - 1)
    member = np.zeros((n, classes))
    member[np.arange(n), of] = 1
    joint = member.T @ pairs @ member
    for _ in range(sweeps):
        moved = 0
        for i in often:
            a = of[i]
            own = pairs[i, i]
            member[i, a] = 0
            right, left = pairs[i] @ member, pairs[:, i] @ member
            joint[a] -= right
            joint[:, a] -= left
            joint[a, a] -= own
            rows, cols = joint.sum(1), joint.sum(0)
            gain = (_xlogx(joint + right) - _xlogx(joint)).sum(1) + (_xlogx(joint + left[:, None]) - _xlogx(joint)).sum(0)
            diagonal = np.diag(joint)
            gain -= _xlogx(diagonal + right) - 2 * _xlogx(diagonal) + _xlogx(diagonal + left)
            gain += _xlogx(diagonal + right + left + own) - _xlogx(diagonal)
            gain -= _xlogx(rows + right.sum() + own) - _xlogx(rows) + _xlogx(cols + left.sum() + own) - _xlogx(cols)
            gain[0] = -np.inf
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            moved += b != a
            of[i] = b
            member[i, b] = 1
            joint[b] += right
            joint[:, b] += left
            joint[b, b] += own
        if not moved:
            break
    return of


def log_moves(joint: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The log10 chance of each next class after a class, from how often classes follow one another, and the log10 of a class's tokens."""
    share = (joint.sum(0) + 1) / (joint.sum() + len(joint))
    return np.log10((joint + 10 * share) / (joint.sum(1, keepdims=True) + 10)), np.log10(np.maximum(joint.sum(0), 1))


def word_classes(places: DataFrame, of: np.ndarray, joint: np.ndarray) -> DataFrame:
    """(word, n, class) of every word of ``places`` (see ``contexts``): the class in which the classes around its places are most
    likely, as for a step of ``exchange``, which all words take at once. ``of``: the classes of items; ``joint``: how often
    they follow one another."""
    n_classes = len(joint)
    log_move, log_total = log_moves(joint)
    log_move, log_total = log_move.astype(np.float32), log_total.astype(np.float32)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole(batches, "word"):
            coded = table.column("word").combine_chunks().dictionary_encode()
            group, n = coded.indices.to_numpy(), table.column("n").to_numpy()
            around = np.frombuffer(b"".join(table.column("places").to_pylist()), "<u2").reshape(-1, 2)
            of_place = np.repeat(group, n)
            words = coded.dictionary
            total = np.bincount(group, weights=n, minlength=len(words)).astype(np.int64)
            found = np.zeros(len(words), np.int8)
            for begin in range(0, len(words), 4096):
                some = slice(*np.searchsorted(of_place, [begin, begin + 4096]))
                size = min(4096, len(words) - begin)
                cell = (of_place[some] - begin) * n_classes
                before, after = (np.bincount(cell + of[around[some, k]], minlength=size * n_classes).reshape(size, n_classes).astype(np.float32) for k in (0, 1))
                gain = before @ log_move + after @ log_move.T - total[begin : begin + size, None].astype(np.float32) * log_total
                gain[:, 0] = -np.inf
                found[begin : begin + size] = gain.argmax(1).astype(np.uint8).view(np.int8)
            yield pa.RecordBatch.from_arrays([words, pa.array(total), pa.array(found)], names=["word", "n", "class"])

    by_word = places.repartition("word").sortWithinPartitions("word")
    return by_word.mapInArrow(assign, "word string, n long, class tinyint")


@dataclass(frozen=True)
class Words:
    """What is learned of words. ``counts``: (word, n, class) of all training words that are not fixed, a stored table. ``local``: the most frequent words,
    ``local_n`` and ``local_class``: their counts and classes. ``items``, ``of``: the classes of words that training did not see."""

    items: Items
    of: np.ndarray
    local: list[bytes]
    local_n: np.ndarray
    local_class: np.ndarray
    counts: DataFrame
    classes: int
    n: int
    v: int
    ends: int


def learned(documents: DataFrame, size: Size = Size(), text_column: str = "text") -> Words:
    """Learns counts and classes of words from all rows. To the driver come the ``local`` most frequent words, the endings and the pair counts of
    at most ``frequent`` + ``endings`` + 2 items, from whose classes all other words then take theirs one by one; the table of all words stays in storage."""
    counts = stored(word_counts(documents, text_column))
    ends = documents.count()
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = most_frequent(counts, size.local)
    frequent = [w.encode() for w, _ in top[: size.frequent]]
    tail = counts.where(~F.col("word").isin([w.decode() for w in frequent])) if frequent else counts
    ending = F.substring(F.col("word").cast("binary"), -ENDING, ENDING)
    common = tail.where(F.octet_length("word") >= ENDING).groupBy(ending.alias("e")).agg(F.sum("n").alias("n"))
    endings = [bytes(r["e"]) for r in common.orderBy(F.desc("n"), "e").limit(size.endings).collect()]
    items = Items(frequent, endings)
    base = items.rest + 1
    found = stored(contexts(documents, items, text_column))
    is_pair = F.col("word").startswith("\n")
    moves = found.where(is_pair).groupBy(F.substring("word", 2, 20).cast("long").alias("pair")).agg(F.sum("n").alias("n")).toPandas()
    pairs = np.zeros(base * base)
    pairs[moves["pair"].to_numpy(np.int64)] = moves["n"].to_numpy()
    pairs = pairs.reshape(base, base)
    of = exchange(pairs, size.classes, size.sweeps)
    member = np.zeros((base, size.classes))
    member[np.arange(base), of] = 1
    classes = stored(word_classes(found.where(~is_pair), of, member.T @ pairs @ member))
    own = {w: of[i] for w, i in items.fixed.items()}
    if len(top) > len(frequent):
        near = classes.where(F.col("n") >= top[-1][1]).select("word", "class").toPandas()
        own |= zip((w.encode() for w in near["word"]), near["class"].to_numpy(np.int8).view(np.uint8).tolist())
    local = [w.encode() for w, _ in top]
    local_n, local_class = np.array([n for _, n in top], np.int64), np.array([own[w] for w in local], np.uint8)
    return Words(items, of.astype(np.uint8), local, local_n, local_class, classes, size.classes, total["n"] + ends, total["v"] + (ends > 0), ends)


SUMS = "n_tokens long, n_known long, base_part double, emitted double, classes binary"


def encoded(documents: DataFrame, words: Words, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``documents``, written: the id, ``n_tokens``, ``n_known``, ``base_part`` and ``emitted``, sums over its tokens and its end, and
    ``classes``, a byte for the class of each token after that of the end.

    Tasks know the frequent words; of each other place in a text a row goes to its word's count and class, and from there to its text. No word of those has more
    than one ``local``-th of all tokens, so no key is hot. A null or empty text is its end alone. Rows with equal or null ids
    stay apart. Other columns are left out."""
    chosen = documents.select(id_column, text_column)
    id_type = chosen.dtypes[0][1]
    local, local_n, local_class, items, of, ends = words.local, words.local_n, words.local_class, words.items, words.of, words.ends
    base_end, emitted_end = float(np.log10(ends + ADDED)), float(np.log10(max(ends - DISCOUNT, DISCOUNT)))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {w: i for i, w in enumerate(local)}
        base_of, emitted_of = np.log10(local_n + ADDED), np.log10(local_n - DISCOUNT)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts, rare, of_rare, at, n_tokens, sums, classes = [], [], [], [], [], [], []
            for i, text in enumerate(bytes_of(batch.column(1))):
                tokens = tokens_of(text)
                row += 1
                ids = np.array([known.get(w, -1) for w in tokens], np.int64)
                there = ids >= 0
                own = np.zeros(len(tokens) + 1, np.uint8)
                if len(local):
                    own[1:] = local_class[ids]
                places = np.flatnonzero(~there).tolist()
                others = [tokens[k] for k in places]
                own[1 + np.array(places, np.int64)] = of[[items(w) for w in others]]
                ids = ids[there]
                texts.append(row)
                rare += others
                of_rare += [row] * len(others)
                at += places
                n_tokens.append(len(tokens) + 1)
                sums.append((len(ids) + (ends > 0), base_of[ids].sum() + base_end, emitted_of[ids].sum() + emitted_end))
                classes.append(own)
            if not texts:
                continue
            n_known, base, emitted = zip(*sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.int64()), batch.column(0), pa.array([b"\n%d" % r for r in texts], pa.binary()).cast(pa.string()), pa.nulls(len(texts), pa.int32()),
                 pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(emitted, pa.float64()), _binaries(np.concatenate(classes), np.array(n_tokens))],
                names=names,
            )
            empty = [pa.nulls(len(rare), t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(of_rare, pa.int64()), pa.nulls(len(rare), batch.column(0).type), pa.array(rare, pa.binary()).cast(pa.string()), pa.array(at, pa.int32()), *empty], names=names
            )

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole(batches, "row"):
            rows = table.column("row").to_numpy()
            at = table.column("at").fill_null(-1).to_numpy()
            text = table.filter(pa.array(at < 0)).combine_chunks()
            lengths = text.column("n_tokens").to_numpy()
            starts = np.cumsum(lengths) - lengths
            classes = np.frombuffer(b"".join(text.column("classes").to_pylist()), np.uint8).copy()
            own = np.searchsorted(text.column("row").to_numpy(), rows)
            n = np.where(at < 0, 0, table.column("n").fill_null(0).to_numpy())
            seen, rare = n > 0, at >= 0
            classes[starts[own[seen]] + 1 + at[seen]] = table.column("class").fill_null(0).to_numpy()[seen].view(np.uint8)
            added = lambda where, values: np.bincount(own[where], weights=values, minlength=len(lengths))
            yield pa.RecordBatch.from_arrays(
                [text.column("id").combine_chunks() if text.num_rows else pa.nulls(0, table.column("id").type), pa.array(lengths),
                 pa.array(text.column("n_known").to_numpy() + added(seen, np.ones(seen.sum())).astype(np.int64)),
                 pa.array(text.column("base_part").to_numpy() + added(rare, np.log10(n[rare] + ADDED))),
                 pa.array(text.column("emitted").to_numpy() + added(rare, np.log10(np.where(n[rare] > 0, n[rare] - DISCOUNT, DISCOUNT)))),
                 _binaries(classes, lengths)],
                names=[id_column, "n_tokens", "n_known", "base_part", "emitted", "classes"],
            )

    names = ["row", "id", "word", "at", "n_tokens", "n_known", "base_part", "emitted", "classes"]
    parts = chosen.mapInArrow(sent, f"row long, id {id_type}, word string, at int, {SUMS}")
    joined = parts.join(words.counts, "word", "left").drop("word")
    return stored(joined.repartition("row").sortWithinPartitions("row").mapInArrow(together, f"`{id_column}` {id_type}, {SUMS}"))


def moves(texts: DataFrame, classes: int) -> np.ndarray:
    """How often a class follows another in ``texts`` (see ``encoded``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * classes, np.int64)
        for batch in batches:
            of = np.frombuffer(b"".join(batch.column(0).to_pylist()) + b"\0", np.uint8).astype(np.int64)
            total += np.bincount(of[:-1] * classes + of[1:], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["pair", "n"])

    joint = np.zeros(classes * classes)
    for row in texts.select("classes").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        joint[row["pair"]] = row["n"]
    return joint.reshape(classes, classes)


@dataclass(frozen=True)
class Model:
    """``joint``: how often a class follows another in the training rows."""

    words: Words
    joint: np.ndarray

    @property
    def n(self) -> int:
        return self.words.n

    @property
    def v(self) -> int:
        return self.words.v


def train(documents: DataFrame, size: Size = Size(), text_column: str = "text") -> Model:
    """Learns from all rows."""
    words = learned(documents, size, text_column)
    return Model(words, moves(encoded(documents.withColumn("_row", F.lit(0)), words, "_row", text_column), words.classes))


def score(documents: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``documents``: the id, ``n_tokens``, ``n_known``, ``base_score``, ``score`` (log10 probabilities of the text with its
    end, by single words and by the classes) and ``perplexity`` of the latter. See ``encoded`` for rows and columns."""
    return scored(encoded(documents, model.words, id_column, text_column), model)


def scored(texts: DataFrame, model: Model) -> DataFrame:
    """The scores of ``texts`` (see ``encoded``)."""
    log_move, log_total = log_moves(model.joint)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = np.frombuffer(b"".join(batch.column("classes").to_pylist()) + b"\0", np.uint8)
            lengths = batch.column("n_tokens").to_numpy()
            parts = log_move[of[:-1], of[1:]] - log_total[of[1:]]
            sums = np.add.reduceat(parts, np.cumsum(lengths) - lengths) if len(lengths) else np.zeros(0)
            columns = [c for c in batch.schema.names if c != "classes"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(sums)], names=[*columns, "moved"])

    id_column, id_type = texts.dtypes[0]
    summed = texts.mapInArrow(add, f"`{id_column}` {id_type}, {SUMS.removesuffix('classes binary')} moved double")
    all_log = float(np.log10(model.n + ADDED * (model.v + 1)))
    total = F.col("emitted") + F.col("moved")
    return summed.select(
        id_column, "n_tokens", "n_known", (F.col("base_part") - F.col("n_tokens") * all_log).alias("base_score"), total.alias("score"),
        F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"),
    )


def trained_on(id_column: Column) -> Column:
    """The rows to learn from: those that are not held out."""
    return ~held_out_by(id_column, 10, 0)
