"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles, banded and verified."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeledger.llm.common import WordHashes, bytes_of, in_slices, mixed, stored
from swipeledger.llm.graph import components
from swipeledger.llm.name_filter import passing, wanted_bits


@dataclass(frozen=True)
class Near:
    """``words`` per shingle. ``similarity``: the least weighted Jaccard similarity of near duplicates. ``bands`` of ``rows`` samples: a pair of
    that similarity shares a band with a chance of 1 - (1 - 0.8**4)**14, over 0.999. ``common``: the share of
    distinct texts from which on a shingle counts less; all rarer ones weigh the same. ``rounds``: how often
    a bucket's rest gets a new leader before its pairs are compared one by one."""

    words: int = 5
    similarity: float = 0.8
    bands: int = 14
    rows: int = 4
    common: float = 0.01
    rounds: int = 4


def shingles(text: bytes, n: int, number: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of a text (runs of ``n`` words, lower case) as 64-bit numbers, and how often each comes.
    A shorter text is one shingle, a text without words none."""
    ids, _ = number(text.lower())
    if not len(ids):
        return ids, np.zeros(0, np.int64)
    size = min(n, len(ids))
    rolled = np.zeros(len(ids) - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            rolled = rolled * _FACTOR + ids[k : k + len(rolled)]
    return np.unique(mixed(rolled), return_counts=True)


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def weights(names: np.ndarray, times: np.ndarray, common: dict[int, float]) -> np.ndarray:
    """TF-IDF: how often a shingle comes, times its weight in ``common`` or 1."""
    w = times.astype(np.float32)
    if common:
        keys = np.fromiter(common, np.uint64, len(common))
        order = np.argsort(keys)
        keys, idf = keys[order], np.fromiter(common.values(), np.float32, len(common))[order]
        at = np.minimum(np.searchsorted(keys, names), len(keys) - 1)
        w = np.where(keys[at] == names, w * idf[at], w)
    return w


def _gamma_quantiles(n: int) -> np.ndarray:
    """The quantiles of Gamma(2, 1) in the middles of ``n`` equal shares."""
    x = np.linspace(0, 30, 300_001)
    return np.interp((np.arange(n) + 0.5) / n, 1 - np.exp(-x) * (1 + x), x).astype(np.float32)


_R = _gamma_quantiles(4096)
_PER_R = (1 / _R).astype(np.float32)
_BITS20, _BITS12 = np.uint64((1 << 20) - 1), np.uint64((1 << 12) - 1)


def samples(names: np.ndarray, weight: np.ndarray, start: np.ndarray, count: int) -> np.ndarray:
    """``count`` consistent weighted samples of each text; its shingles are those from ``start`` on. Two texts have the same sample with
    a chance equal to their weighted Jaccard similarity. Of a shingle of weight S, with r and c drawn from Gamma(2, 1)
    and b from [0, 1): t = floor(ln S / r + b), y = exp(r (t - b)), and the least c / (y exp(r)) is taken. The 64
    bits that draw them: 20 and 20 for c = -ln(u v), 12 for a quantile of r, 12 for b."""
    log_w = np.log(weight)
    text = np.repeat(np.arange(len(start) - 1), np.diff(start))
    out = np.zeros((len(start) - 1, count), np.uint64)
    half, scale = np.float32(0.5), np.float32(2.0**-40)
    for k in range(count):
        h = mixed(names ^ np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 % 2**64))
        u = (h & _BITS20).astype(np.float32) + half
        v = ((h >> np.uint64(20)) & _BITS20).astype(np.float32) + half
        log_c = np.log(-np.log(u * v * scale))
        which = ((h >> np.uint64(40)) & _BITS12).astype(np.int64)
        b = (h >> np.uint64(52)).astype(np.float32) * np.float32(2.0**-12)
        t = np.floor(log_w * _PER_R[which] + b)
        key = log_c - _R[which] * (t - b + np.float32(1))
        least = np.minimum.reduceat(key, start[:-1])
        hit = np.flatnonzero(key == least[text])
        first = hit[np.searchsorted(text[hit], np.arange(len(start) - 1))]
        out[:, k] = mixed(names[first] + t[first].astype(np.int64).view(np.uint64))
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard: the sum of the lesser weights over the sum of the greater."""
    _, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    x, y = a[1].astype(np.float64), b[1].astype(np.float64)
    shared = np.minimum(x[at], y[bt]).sum()
    total = x.sum() + y.sum() - shared
    return shared / total if total else 0.0


SLICE = 1 << 21


#: Shingles are first counted together, by so many remainders of their numbers: a common shingle's remainder is common, too.
CELLS, PARTS = 1 << 20, 64


#: Groups of near copies are told by keys, each of so many shingles: two texts of similarity 0.8 share a key with a chance of 0.98.
KEYS, KEY_ROWS = 8, 4
_BINS = (np.arange(KEYS * KEY_ROWS, dtype=np.uint64) << np.uint64(65 - (KEYS * KEY_ROWS).bit_length()))


def group_keys(names: np.ndarray) -> np.ndarray:
    """``KEYS`` numbers of a text's sorted shingles. The range of all numbers has a bin for each row of each key, and the first shingle from the bin's
    beginning on stands for it; a bin past the last shingle takes the first."""
    first = names[np.searchsorted(names, _BINS) % len(names)].reshape(KEYS, KEY_ROWS)
    keys = np.arange(1, KEYS + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(KEY_ROWS):
            keys = mixed(keys * np.uint64(31) + first[:, k])
    return keys.view(np.int64)


def hot_groups(texts: DataFrame, near: Near) -> dict[int, bytes]:
    """The keys that two texts or more and over a quarter of a ``common`` share of all have, and the lowest text with each: 4 / ``common`` of each of the
    ``KEYS`` come to the driver at most. Edited copies in smaller groups make no shingle common."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = WordHashes()
        for batch in in_slices(batches, "text", SLICE):
            ids, keys = [], []
            for key, text in zip(batch.column("text_id").to_pylist(), bytes_of(batch.column("text"))):
                names = shingles(text, near.words, number)[0]
                if len(names):
                    ids.append(key)
                    keys.append(group_keys(names))
            flat = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
            offsets = pa.array(np.arange(0, KEYS * len(ids) + 1, KEYS), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.ListArray.from_arrays(offsets, flat)], names=["text_id", "keys"])

    found = stored(texts.mapInArrow(keyed, "text_id binary, keys array<long>"))
    least = max(2, int(np.floor(near.common / 4 * found.count())) + 1)
    each = found.select("text_id", F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n"), F.min("text_id").alias("text_id"))
    return {r["key"]: bytes(r["text_id"]) for r in each.where(F.col("n") >= least).collect()}


def common_shingles(texts: DataFrame, near: Near) -> dict[int, float]:
    """The weights of shingles that two texts or more and over a ``common`` share of all have: ln(1 / share) over ln(1 / common). ``texts``
    are distinct, so copies add nothing; nor do edited copies in large groups (``hot_groups``), of which the lowest text counts, or what is common to a group
    would weigh nothing in it. Texts without words do not count. Shingles whose remainder is too
    rare are left out first, all others are summed by name, and only those that are common come to the driver:
    at most 1 / ``common`` times the shingles of a mean text."""
    hot = hot_groups(texts, near)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, int]]:
        """The shingles of some texts, each as often as texts have it, and how many texts these are."""
        number, held, n_held = WordHashes(), [], 0
        for batch in in_slices(batches, "text", SLICE):
            for key, text in zip(batch.column("text_id").to_pylist(), bytes_of(batch.column("text"))):
                names = shingles(text, near.words, number)[0]
                if len(names) and all(hot.get(k, key) == key for k in group_keys(names).tolist()):
                    held.append(names)
                    n_held += len(names)
                if n_held > 2_000_000:
                    yield np.concatenate(held), len(held)
                    held, n_held = [], 0
        if held:
            yield np.concatenate(held), len(held)

    def by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, n_texts = np.zeros(CELLS, np.int64), 0
        for names, n in blocks(batches):
            cells += np.bincount((names % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
            n_texts += n
        parts = [p.tobytes() for p in cells.reshape(PARTS, -1)] if n_texts else []
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(parts)), -1], pa.int64()), pa.array([*parts, np.int64(n_texts).tobytes()], pa.binary())], names=["part", "n"])

    def added(table: pa.Table) -> pa.Table:
        n = np.sum([np.frombuffer(x, np.int64) for x in table.column("n").to_pylist()], axis=0)
        return pa.Table.from_arrays([table.column("part").slice(0, 1), pa.array([n.tobytes()], pa.binary())], names=["part", "n"])

    schema = "part long, n binary"
    n = {r["part"]: np.frombuffer(r["n"], np.int64) for r in texts.mapInArrow(by_cell, schema).groupBy("part").applyInArrow(added, schema).collect()}
    n_texts = int(n.pop(-1)[0]) if -1 in n else 0
    if not n_texts:
        return {}
    least = max(2, int(np.floor(near.common * n_texts)) + 1)
    open_cells = np.packbits(np.concatenate([n[k] for k in sorted(n)]) >= least)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = np.unpackbits(open_cells).astype(bool)
        for names, _ in blocks(batches):
            names, n = np.unique(names[there[names % np.uint64(CELLS)]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n, pa.int64())], names=["name", "n"])

    counted = texts.mapInArrow(count, "name long, n long").groupBy("name").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toPandas()
    share = dict(zip(counted["name"].to_numpy(np.int64).view(np.uint64).tolist(), (counted["n"] / n_texts).tolist()))
    return {name: float(np.log(1 / s + 0.01) / np.log(1 / near.common)) for name, s in share.items()}


def sketches(texts: DataFrame, near: Near, common: dict[int, float]) -> DataFrame:
    """(text_id, bands): a number for every band of each text with words."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = WordHashes()
        for batch in in_slices(batches, "text", 100_000):
            found = [shingles(t, near.words, number) for t in bytes_of(batch.column("text"))]
            at = [i for i, (names, _) in enumerate(found) if len(names)]
            if not at:
                continue
            names = np.concatenate([found[i][0] for i in at])
            weight = np.concatenate([weights(*found[i], common) for i in at])
            start = np.cumsum([0, *(len(found[i][0]) for i in at)])
            drawn = samples(names, weight, start, near.bands * near.rows).reshape(len(at), near.bands, near.rows)
            bands = np.zeros((len(at), near.bands), np.uint64) + np.arange(1, near.bands + 1, dtype=np.uint64)
            with np.errstate(over="ignore"):
                for k in range(near.rows):
                    bands = mixed(bands * np.uint64(31) + drawn[:, :, k])
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, near.bands), pa.int32()), pa.array(bands.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("text_id").take(pa.array(at, pa.int64())), flat], names=["text_id", "bands"])

    return texts.mapInArrow(sketch, "text_id binary, bands array<long>")


def _compared(pairs: DataFrame, texts: DataFrame, near: Near, common: dict[int, float]) -> DataFrame:
    """(a, b, similarity) of the pairs."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, known = WordHashes(), {}

        def weighted(key: bytes, text: bytes):
            if key not in known:
                if len(known) > 64:
                    known.clear()
                names, times = shingles(text, near.words, number)
                known[key] = names, weights(names, times, common)
            return known[key]

        for batch in batches:
            cols = [batch.column(c).cast(pa.binary()).to_pylist() for c in ("a", "b", "a_text", "b_text")]
            found = [similarity(weighted(a, x), weighted(b, y)) for a, b, x, y in zip(*cols)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], names=["a", "b", "similarity"])

    a = texts.select(F.col("text_id").alias("a"), F.col("text").alias("a_text"))
    b = texts.select(F.col("text_id").alias("b"), F.col("text").alias("b_text"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "a_text", "b_text").mapInArrow(compare, "a binary, b binary, similarity double")


def _pairwise(first: list[tuple], second: list[tuple], least: float) -> list[tuple[int, int, float]]:
    """(i, j, similarity) of the texts of the two lists with at least that similarity. The texts of ``second`` are looked up by
    shingle, so a text costs the shingles that it shares and not a comparison with each."""
    names = np.concatenate([n for n, _ in second])
    held = np.repeat(np.arange(len(second)), [len(n) for n, _ in second])
    weight = np.concatenate([w for _, w in second]).astype(np.float64)
    order = np.argsort(names, kind="stable")
    names, held, weight = names[order], held[order], weight[order]
    total = np.bincount(held, weights=weight, minlength=len(second))
    out = []
    for i, (mine, own) in enumerate(first):
        own = own.astype(np.float64)
        low, high = np.searchsorted(names, mine, "left"), np.searchsorted(names, mine, "right")
        count = high - low
        at = np.arange(count.sum()) + np.repeat(low - (np.cumsum(count) - count), count)
        shared = np.bincount(held[at], weights=np.minimum(weight[at], np.repeat(own, count)), minlength=len(second))
        alike = shared / np.maximum(own.sum() + total - shared, 1e-30)
        out += [(i, int(j), float(alike[j])) for j in np.flatnonzero(alike >= least)]
    return out


#: Texts of each side that are compared in one task.
BLOCK = 1000


def _links_between(sides: DataFrame, texts: DataFrame, near: Near, common: dict[int, float]) -> DataFrame:
    """(a, b) of near texts (``text_id``) on ``side`` 0 and 1 of a group ``key``. Large sides are dealt into blocks, and a task
    compares one block with one: a text is sent as often as the other side has blocks, and only links come out."""
    n = sides.groupBy("key").agg(*(F.ceil(F.sum((F.col("side") == s).cast("int")) / BLOCK).cast("int").alias(f"n{s}") for s in (0, 1)))
    n = n.where("n0 > 0 and n1 > 0")
    own = F.when(F.col("side") == 0, F.col("n0")).otherwise(F.col("n1"))
    other = F.when(F.col("side") == 0, F.col("n1")).otherwise(F.col("n0"))
    dealt = (
        sides.join(n, "key").withColumn("mine", F.pmod(F.xxhash64("text_id"), own)).withColumn("theirs", F.explode(F.sequence(F.lit(0), other - 1)))
        .withColumn("i", F.when(F.col("side") == 0, F.col("mine")).otherwise(F.col("theirs")))
        .withColumn("j", F.when(F.col("side") == 0, F.col("theirs")).otherwise(F.col("mine")))
        .select("key", "i", "j", "side", "text_id").join(texts, "text_id")
    )

    def compare(table):
        number = WordHashes()
        ids, side = table.column("text_id").to_pylist(), table.column("side").to_pylist()
        weighted = []
        for text in bytes_of(table.column("text")):
            names, times = shingles(text, near.words, number)
            weighted.append((names, weights(names, times, common)))
        sets = [[k for k, x in enumerate(side) if x == s] for s in (0, 1)]
        found = []
        if all(sets):
            pairs = _pairwise([weighted[k] for k in sets[0]], [weighted[k] for k in sets[1]], near.similarity - 1e-9)
            found = [(ids[sets[0][i]], ids[sets[1][j]]) for i, j, _ in pairs if ids[sets[0][i]] != ids[sets[1][j]]]
        return pa.Table.from_arrays([pa.array([max(p) for p in found], pa.binary()), pa.array([min(p) for p in found], pa.binary())], names=["a", "b"])

    return dealt.groupBy("key", "i", "j").applyInArrow(compare, "a binary, b binary").distinct()


def text_id(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _only(texts: DataFrame, names: DataFrame) -> DataFrame:
    """The distinct texts with these ids, picked by a filter of fixed size where they are read, then exactly."""
    wanted = wanted_bits(names.select(_number(F.col("text_id")).alias("name")))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = np.unpackbits(wanted).astype(bool)
        for batch in batches:
            yield batch.select(["text_id", "text"]).filter(pa.array(passing(there, batch.column("number").to_numpy())))

    picked = texts.withColumn("number", _number(F.col("text_id"))).mapInArrow(pick, "text_id binary, text string")
    return picked.join(names, "text_id", "left_semi")


def _number(key: Column) -> Column:
    return F.xxhash64(key)


def near_links(texts: DataFrame, near: Near = Near()) -> DataFrame:
    """(a, b): verified links between different texts (``text_id``, ``text``) that join each class of near duplicates.

    Texts with an equal band are a bucket. Each text of a bucket is compared with the bucket's leader, the one whose buckets are the largest; those
    that are not near it get a leader among themselves, ``rounds`` times, and what is left then is compared block by block. So
    a group of copies gives a pair per copy and not all pairs. A text that is not near its
    leader can still be near another text that is: only if their distances to the leader differ by no more than a link
    allows, for 1 - similarity is a metric. Such texts, if still in another class, are compared with those by blocks, too."""
    texts = stored(texts.groupBy("text_id").agg(F.first("text").alias("text")))
    common = common_shingles(texts, near)
    entries = stored(sketches(texts, near, common).select("text_id", F.explode("bands").alias("bucket")))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    left = entries.join(shared, "bucket")
    # What a group of copies was made from has the group's common bands; its edited copies lack some.
    central = left.groupBy("text_id").agg(F.sum("n").alias("centre"))
    left = stored(left.drop("n").join(central, "text_id"))
    involved = stored(_only(texts, left.select("text_id").distinct()))
    far = 1 - near.similarity + 1e-9
    compared, led, rest = [], [], None

    def compare(pairs: DataFrame) -> None:
        if compared:
            pairs = pairs.join(_all(compared), ["a", "b"], "left_anti")
        compared.append(stored(_compared(pairs, involved, near, common)))

    one, other = F.greatest("text_id", "other").alias("a"), F.least("text_id", "other").alias("b")
    for _ in range(near.rounds):
        leader = F.max(F.struct("centre", "text_id"))["text_id"]
        leaders = left.groupBy("bucket").agg(leader.alias("other"), F.count("*").alias("n")).where("n > 1").drop("n")
        members = stored(left.join(leaders, "bucket").where(F.col("text_id") != F.col("other")).select("*", one, other))
        if members.isEmpty():
            break
        compare(members.select("a", "b").distinct())
        placed = stored(members.join(_all(compared), ["a", "b"]).withColumn("distance", 1 - F.col("similarity")))
        led.append(placed.select("bucket", F.col("other").alias("leader"), "text_id", "distance"))
        left = placed.where(F.col("distance") > far).select("bucket", "text_id", "centre")
    else:
        groups = left.groupBy("bucket").count().where("count > 1").drop("count")
        both = left.join(groups, "bucket").select(F.col("bucket").alias("key"), "text_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
        rest = stored(_links_between(both, involved, near, common))
    if not compared:
        return involved.select(F.col("text_id").alias("a"), F.col("text_id").alias("b")).limit(0)
    links = _all(compared).where(1 - F.col("similarity") <= far).select("a", "b")
    links = stored((links if rest is None else links.unionByName(rest)).distinct())
    placed, classes = _all(led), components(links)
    of_text = classes.select(F.col("node").alias("text_id"), F.col("component").alias("text_class"))
    of_leader = classes.select(F.col("node").alias("leader"), F.col("component").alias("leader_class"))
    apart = ~F.coalesce("text_class", "text_id").eqNullSafe(F.coalesce("leader_class", "leader"))
    outside = placed.where((F.col("distance") > far) & (F.col("distance") <= 2 * far))
    outside = stored(outside.join(of_text, "text_id", "left").join(of_leader, "leader", "left").where(apart).select("bucket", "leader", "text_id", "distance"))
    # What lies nearer to the leader than this is too far from all that are left outside.
    nearest = outside.groupBy("bucket", "leader").agg((F.min("distance") - far).alias("least"))
    inside = placed.where(F.col("distance") <= far).join(nearest, ["bucket", "leader"]).where("distance >= least")
    key = F.xxhash64("bucket", "leader").alias("key")
    sides = outside.select(key, "text_id", F.lit(0).alias("side")).unionByName(inside.select(key, "text_id", F.lit(1).alias("side")))
    return stored(links.unionByName(_links_between(sides.distinct(), involved, near, common)).distinct())


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def classes(documents: DataFrame, near: Near = Near(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``documents``: ``id``, ``text_id`` (of the text) and ``class_id``, the lowest id of its class: all rows whose texts are equal, or joined by links between
    near texts.

    Null and empty texts, and those without words, are no copies of anything; each is its own class.
    Rows with one id and different texts may be in different classes; a null id never names a class unless all
    its rows have none. Other columns are left out."""
    placed, alone = _placed(documents, near, id_column, text_column)
    first = placed.groupBy("component").agg(F.min("id").alias("class_id"))
    return placed.join(first, "component").select("id", "text_id", "class_id").unionByName(alone.withColumn("class_id", F.col("id")))


def _placed(documents: DataFrame, near: Near, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """(id, text_id, component) of all rows with words, where ``component`` names the class by one of its texts; (id, text_id) of the others."""
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    rows = documents.select(F.col(f"`{id_column}`").alias("id"), text.alias("text"), text_id(text).alias("text_id"))
    has_words = F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")) > 0
    links = near_links(rows.select("text_id", "text"), near)
    joined = components(links).select(F.col("node").alias("text_id"), F.col("component"))
    named = stored(rows.select("id", "text_id", has_words.alias("has_words")))
    placed = named.where("has_words").drop("has_words").join(joined, "text_id", "left")
    return placed.withColumn("component", F.coalesce("component", "text_id")), named.where(~F.col("has_words")).select("id", "text_id")


def deduped(documents: DataFrame, near: Near = Near(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``documents`` with one row of each class, that of its lowest id (null last; of equal ids, of the lowest text hash; one of repeated rows).
    Classes are told apart by their texts, so ids may be null or repeated. Rows without words all stay."""
    found, _ = _placed(documents, near, id_column, text_column)
    least = F.struct(F.col("id").isNull().alias("none"), "id", "text_id")
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    no_words = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")) == 0
    kept = found.groupBy("component").agg(F.min(least).alias("kept")).select(F.col("kept.id").alias("_k_id"), F.col("kept.text_id").alias("_k_text"))
    keyed = documents.where(~no_words).withColumn("_text_id", text_id(F.col(f"`{text_column}`")))
    same = F.col(f"`{id_column}`").eqNullSafe(F.col("_k_id")) & (F.col("_text_id") == F.col("_k_text"))
    joined = keyed.join(kept, same).groupBy("_k_id", "_k_text").agg(F.first(F.struct(*[F.col(f"`{c}`") for c in documents.columns])).alias("row"))
    return joined.select("row.*").unionByName(documents.where(no_words))
