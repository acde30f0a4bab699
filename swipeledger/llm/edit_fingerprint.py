"""Document fingerprints by randomised edit embedding: a random walk over the characters, the same for all texts, turns
edit distance into Hamming distance; the fingerprint is a sample of the walk."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeledger.llm.common import mixed, stored
from swipeledger.llm.graph import components

#: A text of n characters walks 3 n steps at most, of which a grid of at most so many is sampled.
DIGITS = 512
#: The walk's coins repeat after so many steps.
PERIOD = 4096
_END = 256
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)
#: Walks side by side up to this number go on one by one.
FEW = 32


def _coins() -> np.ndarray:
    """By step and symbol, 1 if the walk goes on to the next character; at the end it stays."""
    h = mixed(np.arange(PERIOD * 256, dtype=np.uint64) + np.uint64(0x5EED))
    return np.concatenate([(h >> np.uint64(40) & np.uint64(1)).astype(np.uint8).reshape(PERIOD, 256), np.zeros((PERIOD, 1), np.uint8)], axis=1)


def _symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return ((points ^ points >> 8 ^ points >> 16) & 255).astype(np.uint16)


def level_of(n: int) -> int:
    """Every 2**level-th step of the walk of a text of n characters is sampled."""
    return max(0, (-(-3 * n // DIGITS) - 1).bit_length())


def fingerprints(texts: list[str]) -> list[str]:
    """The level, a point, and a hexadecimal digit for each sampled step: four bits of the character that the walk was at. Equal
    texts have equal fingerprints; the empty text has none. Where two texts agree, their walks do; after
    an edit, the walks meet again after a few steps by chance."""
    coins = _coins()
    parts = [_symbols(t) for t in texts]
    sizes = np.array([len(p) for p in parts], np.int64)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    out = ["" for _ in texts]
    if not len(order):
        return out
    track = np.concatenate([x for i in order for x in (parts[i], [_END])]).astype(np.uint16)
    ends = np.cumsum(sizes[order] + 1) - 1
    at = ends - sizes[order]
    levels = np.array([level_of(n) for n in sizes[order].tolist()], np.int64)
    digits = np.full((len(order), DIGITS + 1), _END, np.uint16)
    active = np.arange(len(order))
    step = 0
    while len(active) > FEW:
        # Longest first, so the levels fall; those that take a sample at a step are the last of the active ones.
        level, place, end = levels[active], at[active], ends[active]
        for step in range(step, step + 64):
            seen = track[place]
            zeros = (step & -step).bit_length() - 1 if step else 63
            first = int(np.searchsorted(-level, -zeros))
            if first < len(active):
                digits[active[first:], step >> level[first:]] = seen[first:]
            place += coins[step % PERIOD][seen]
        step += 1
        at[active] = place
        active = active[place < end]
    rows = [row.tobytes() for row in coins[:, :256]]
    for i in active.tolist():
        path = track[at[i] : ends[i]].tolist()
        every, shift, p, n, s = (1 << int(levels[i])) - 1, int(levels[i]), 0, len(path), step
        taken = digits[i]
        while p < n:
            symbol = path[p]
            if not s & every:
                taken[s >> shift] = symbol
            p += rows[s % PERIOD][symbol]
            s += 1
    nibble = np.r_[(mixed(np.arange(256, dtype=np.uint64)) >> np.uint64(20) & np.uint64(15)).astype(np.uint8), np.uint8(0)]
    hexes = _HEX[nibble[digits]]
    counts = (digits != _END).sum(1)
    for k, i in enumerate(order.tolist()):
        out[i] = f"{levels[k]}.{hexes[k, : counts[k]].tobytes().decode()}"
    return out


def likeness(a: str, b: str) -> float:
    """The share of equal digits, over the longer walk, on the coarser of the two grids. Two empty fingerprints are alike."""
    if not a or not b:
        return float(a == b)
    (j, x), (k, y) = ((int(level), np.frombuffer(digits.encode(), np.uint8)) for level, digits in (a.split("."), b.split(".")))
    x, y = x[:: 1 << max(0, k - j)], y[:: 1 << max(0, j - k)]
    n = min(len(x), len(y))
    return float((x[:n] == y[:n]).sum() / max(len(x), len(y)))


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as many first characters of the following one."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


COLUMNS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
#: Characters that are walked side by side in a task.
BLOCK = 8_000_000


def _rows(texts: list[str], following: list[str]) -> list[tuple]:
    """The columns of each text, given the following texts."""
    changed = [edited(t, f) for t, f in zip(texts, following)]
    last = [following[-1]] if following else []
    found = fingerprints([*texts, *last, *changed])
    n = len(texts)
    out = []
    for i, (text, change) in enumerate(zip(texts, changed)):
        own, nxt, new = found[i], found[i + 1], found[n + 1 + i]
        sha = hashlib.sha256(change.encode("utf-8", "surrogatepass")).hexdigest()
        out.append((len(text), sha, own, new, likeness(own, new), likeness(own, nxt)))
    return out


def fingerprinted(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``documents``: the id, ``n_chars``, ``edited_sha256`` (of the edited text), ``fingerprint``, ``edited_fingerprint``,
    and how alike (0 to 1) the fingerprint is to the edited text's (``near_edited``) and to the next document's (``near_next``).

    The next document is that with the next id (nulls last; equal ids in order of their texts' hashes); after the last comes the first. Texts
    are shuffled once, into ranges of ids. A task knows all next texts but that of its last document; these pairs, one
    for each task, are brought together afterwards.

    A null text counts as empty. The edited text of a text under four characters is the text itself. A single
    document is its own next. Other columns are left out."""
    spark = documents.sparkSession
    chosen = documents.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    order = [F.col("id").asc_nulls_last(), F.xxhash64("text").asc(), F.col("text").asc()]
    id_type = chosen.dtypes[0][1]
    names = ["id", *(c.split()[0] for c in COLUMNS.split(", "))]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, texts, size, first = TaskContext.get().partitionId(), [], [], 0, None
        id_kind = None
        for batch in batches:
            id_kind = batch.schema.field(0).type
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if first is None:
                    first = (i, t)
                ids.append(i)
                texts.append(t)
                size += len(t)
                if size > BLOCK and len(texts) > 1:
                    yield out(id_kind, ids[:-1], _rows(texts[:-1], texts[1:]))
                    ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
        if texts:
            if len(texts) > 1:
                yield out(id_kind, ids[:-1], _rows(texts[:-1], texts[1:]))
            yield out(id_kind, [ids[-1]], [(None,) * 6], part=part, first=first[1], last=texts[-1])

    def out(id_kind, ids, rows, part=None, first=None, last=None) -> pa.RecordBatch:
        cols = list(zip(*rows))
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        n = len(ids)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, id_kind), *(pa.array(c, k) for c, k in zip(cols, kinds)), pa.array([part] * n, pa.int64()), pa.array([first] * n, pa.string()), pa.array([last] * n, pa.string())],
            names=[*names, "part", "first", "last"],
        )

    schema = f"id {id_type}, {COLUMNS}, part long, first string, last string"
    # Ranges of ids alone: their bounds are sampled by the driver, which should see no texts.
    done = stored(chosen.repartitionByRange(order[0]).sortWithinPartitions(*order).mapInArrow(walk, schema))
    edges = done.where(F.col("part").isNotNull())
    # Which task follows which: one number per task.
    parts = sorted(r["part"] for r in edges.select("part").collect())
    if not parts:
        return done.select(F.col("id").alias(id_column), *names[1:])
    after = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part long, next_part long")
    firsts = edges.select(F.col("part").alias("next_part"), F.col("first").alias("following"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, last, following in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                yield out(batch.schema.field(0).type, [i.as_py()], _rows([last], [following])).select(names)

    pairs = edges.join(after, "part").join(firsts, "next_part").select("id", "last", "following")
    closed = pairs.mapInArrow(close, f"id {id_type}, {COLUMNS}")
    return done.where(F.col("part").isNull()).select(names).unionByName(closed).select(F.col("id").alias(id_column), *names[1:])


#: Bands of a fingerprint, digits in each, and the likeness of near texts.
BANDS, BAND_DIGITS, NEAR = 16, 8, 0.8


def bands_of(fingerprint: str) -> list[int]:
    """Numbers of the bands on the fingerprint's own grid and on the next coarser one, where texts of a little over
    another length have theirs. A band is a few digits in places that are the same for all fingerprints of a grid."""
    if not fingerprint:
        return []
    level, digits = fingerprint.split(".")
    out = []
    for k, row in ((int(level), digits), (int(level) + 1, digits[::2])):
        stride = max(1, DIGITS // 4 >> (k - int(level)))
        for band in range(BANDS):
            places = [int(p) for p in (mixed(np.arange(BAND_DIGITS, dtype=np.uint64) + np.uint64(band * 64 + 9)) % np.uint64(stride))]
            if max(places) < len(row):
                key = f"{k}.{band}." + "".join(row[p] for p in sorted(places))
                out.append(int.from_bytes(hashlib.blake2b(key.encode(), digest_size=8).digest(), "little", signed=True))
    return out


def near_classes(prints: DataFrame, near: float = NEAR, id_column: str = "doc_id") -> DataFrame:
    """(id, class_id) for the rows of ``prints`` (id, ``fingerprint``): texts with equal fingerprints, and those that share a band and whose
    fingerprints are alike by ``near``, belong to one class, named by its lowest id. In each band's bucket the texts
    are compared with its leader, and those that are not near it with a leader of their own, until none is left.
    Empty fingerprints are classes of their own."""
    rows = stored(prints.select(F.col(id_column).alias("id"), "fingerprint"))
    distinct = rows.where("fingerprint <> ''").groupBy("fingerprint").agg(F.count("*").alias("n"))

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(f, b) for f in batch.column(0).to_pylist() for b in set(bands_of(f))]
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in found], pa.string()), pa.array([b for _, b in found], pa.int64())], names=["fingerprint", "band"])

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [likeness(a, b) >= near for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.bool_())], names=[*batch.schema.names, "near"])

    left = stored(distinct.select("fingerprint").mapInArrow(band, "fingerprint string, band long"))
    links = None
    while True:
        leaders = left.groupBy("band").agg(F.min("fingerprint").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
        members = left.withColumnRenamed("fingerprint", "a").join(leaders, "band").where("a <> b").select("band", "a", "b")
        judged = stored(members.mapInArrow(alike, "band long, a string, b string, near boolean"))
        new = judged.where("near").select("a", "b").distinct()
        links = new if links is None else links.unionByName(new)
        left = judged.where(~F.col("near")).select(F.col("a").alias("fingerprint"), "band")
        if left.isEmpty():
            break
    found = components(links).select(F.col("node").alias("fingerprint"), "component")
    placed = rows.where("fingerprint <> ''").join(found, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    first = placed.groupBy("component").agg(F.min("id").alias("class_id"))
    alone = rows.where("fingerprint = ''").select("id", F.col("id").alias("class_id"))
    return placed.join(first, "component").select("id", "class_id").unionByName(alone).withColumnRenamed("id", id_column)
