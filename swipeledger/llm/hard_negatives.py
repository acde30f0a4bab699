"""Hard-negative mining: threshold joins over a norm-bounded inverted index, with thresholds lowered until all windows are full."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipeledger.llm.common import stored

#: Sums of products below this are exact in doubles.
EXACT = 2**53
_LEAST, _MOST = -(2**63), 2**63 - 1


@dataclass(frozen=True)
class Mining:
    """``positives`` rows of an anchor's label, and for each of them ``negatives`` rows of other labels whose score is ``low`` to ``high`` per cent
    of the positive's. ``same``, ``other``: the thresholds of the rounds, as shares of the anchor's squared norm and of a
    positive's score; a last round without threshold (for windows: at their lower end) makes every result whole.
    ``cells``: components of the rows that are worked on together. ``anchors``: anchors of a block."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    same: tuple[float, ...] = (0.5, 0.3)
    other: tuple[float, ...] = (0.75, 0.5)
    cells: int = 1 << 19
    anchors: int = 4096


#: Dimensions that enter the index together, and anchors that are scored together.
STEP, TOGETHER = 8, 128


class Index:
    """Rows by dimension: in ascending order of weight, and of each row only from the dimension on where what lies before could
    reach the threshold: for any two vectors, what the first dimensions add is at most the product of their norms there. ``lists[c]``: how many
    rows, in the order of the index, have the dimensions of step ``c``."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray, least: float):
        self.order = np.argsort((rows * rows).sum(0), kind="stable")
        width = rows.shape[1]
        self.cuts = np.minimum(np.arange(0, width + STEP, STEP), width)
        before, reach = self.norms(rows[:, self.order]), self.norms(anchors[:, self.order]).max(0)
        # The first cut, at 0, always omits nothing.
        omitted = (before * reach < least) & (least > 0)
        cut = np.where(omitted.any(1), omitted.shape[1] - 1 - np.argmax(omitted[:, ::-1], axis=1), 0)
        self.row = np.argsort(cut, kind="stable")
        self.cut = cut[self.row]
        self.rows = np.ascontiguousarray(rows[self.row][:, self.order])
        self.before = before[self.row, self.cut]
        self.lists = [int(np.searchsorted(self.cut, c, "right")) for c in range(len(self.cuts) - 1)]

    def norms(self, vectors: np.ndarray) -> np.ndarray:
        """The norms of each vector's dimensions before each cut."""
        squares = np.concatenate([np.zeros((len(vectors), 1)), np.cumsum(vectors * vectors, 1)], 1)
        return np.sqrt(squares[:, self.cuts])

    def above(self, anchors: np.ndarray, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each anchor, its number, the rows that score at least its ``least``, and their scores."""
        anchors = anchors[:, self.order]
        reach = self.norms(anchors)
        scores = np.zeros((len(anchors), len(self.rows)))
        for c, n in enumerate(self.lists):
            part = slice(self.cuts[c], self.cuts[c + 1])
            scores[:, :n] += anchors[:, part] @ self.rows[:n, part].T
        for i, partial in enumerate(scores):
            # A candidate can still reach the threshold; rounding of norms is left room for.
            room = reach[i, self.cut] * self.before
            found = np.flatnonzero(partial + room * (1 + 1e-9) + 1e-6 >= least[i])
            total = partial[found]
            rest = np.flatnonzero(self.cut[found] > 0)
            if len(rest):
                at = found[rest]
                begun = np.arange(len(self.order))[None, :] < self.cuts[self.cut[at]][:, None]
                total[rest] += (np.where(begun, self.rows[at], 0.0) * anchors[i]).sum(1)
            kept = total >= least[i]
            yield i, self.row[found[kept]], total[kept].astype(np.int64)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """The vectors as rows of doubles; shorter ones end in zeros."""
    column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    out = np.zeros((len(sizes), width), values.dtype)
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def _widest(column: pa.ChunkedArray) -> int:
    return int(np.diff(column.combine_chunks().offsets.to_numpy()).max(initial=0))


def _above(rows: np.ndarray, anchors: np.ndarray, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``Index.above`` of all anchors, some at a time; in whole numbers of any size where doubles are not exact."""
    largest = [np.abs(v.astype(np.float64)).max(initial=0) for v in (rows, anchors)]
    if largest[0] * largest[1] * rows.shape[1] >= EXACT:
        for i, anchor in enumerate(anchors.astype(object)):
            scores = np.array([min(max(s, _LEAST), _MOST) for s in rows.astype(object) @ anchor], np.int64)
            found = np.flatnonzero(scores >= least[i])
            yield i, found, scores[found]
        return
    rows, anchors = rows.astype(np.float64), anchors.astype(np.float64)
    index = Index(rows, anchors, float(least.min()))
    for start in range(0, len(anchors), TOGETHER):
        for i, found, scores in index.above(anchors[start : start + TOGETHER], least[start : start + TOGETHER]):
            yield start + i, found, scores


def _first(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` by score, then by id."""
    if len(scores) > 4 * most:
        edge = np.partition(scores, len(scores) - most)[len(scores) - most]
        some = np.flatnonzero(scores >= edge)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:most]]


ROW = "id long, key long, label int, vector array<long>"
_FOUND = "a_id long, a_key long, p_id long, p_key long, positive_score long, id long, key long, score long"
#: Stands for a null id, which comes last.
_NO_ID = _MOST


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().fill_null(_NO_ID).to_numpy()


def _each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _scan(asked: DataFrame, rows: DataFrame, blocks: int, mining: Mining) -> DataFrame:
    """One threshold join. ``asked``: anchors (a_id, a_key, a_label, a_vector), the ``least`` score to look at, and ``windows``, an array of (p_id,
    p_key, positive_score, least, most) of scores of other labels; with a null array, rows of the anchor's own label
    are asked for. Comes out: of each block of rows the first of each window that it has."""

    def match(key, left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.Table.from_pylist([], schema=_SCHEMA)
        if not len(left) or not len(right):
            return none
        width = max(_widest(left.column("vector")), _widest(right.column("a_vector")))
        ids, keys, labels = _ids(left.column("id")), left.column("key").to_numpy(), left.column("label").to_numpy()
        a_ids, a_keys, a_labels = _ids(right.column("a_id")), right.column("a_key").to_numpy(), right.column("a_label").to_numpy()
        least, windows = right.column("least").to_numpy(), right.column("windows").to_pylist()
        out: list[tuple] = []

        def add(anchor: int, window: dict | None, at: np.ndarray, scores: np.ndarray, most: int) -> None:
            first = _first(scores, ids[at], most)
            w = window or {"p_id": None, "p_key": None, "positive_score": None}
            for j, s in zip(at[first].tolist(), scores[first].tolist()):
                out.append((a_ids[anchor], a_keys[anchor], w["p_id"], w["p_key"], w["positive_score"], ids[j], keys[j], s))

        vectors, a_vectors = _matrix(left.column("vector"), width), _matrix(right.column("a_vector"), width)
        for i, found, scores in _above(vectors, a_vectors, least):
            if windows[i] is None:
                some = (labels[found] == a_labels[i]) & ((ids[found] != a_ids[i]) | (keys[found] != a_keys[i]))
                add(i, None, found[some], scores[some], mining.positives)
                continue
            others = labels[found] != a_labels[i]
            found, scores = found[others], scores[others]
            for window in windows[i]:
                some = (scores >= window["least"]) & (scores <= window["most"])
                add(i, window, found[some], scores[some], mining.negatives)
        if not out:
            return none
        columns = [pa.array(c, pa.int64()) for c in zip(*((*(None if v is None else int(v) for v in r),) for r in out))]
        columns[0], columns[5] = (pa.array([None if v == _NO_ID else v for v in c.to_pylist()], pa.int64()) for c in (columns[0], columns[5]))
        return pa.Table.from_arrays(columns, schema=_SCHEMA)

    many = max(1, -(-asked.count() // mining.anchors))
    block, part = F.pmod("key", F.lit(blocks)).alias("block"), F.pmod(F.xxhash64("a_key"), F.lit(many)).alias("part")
    left = rows.select("*", block, _each(many).alias("part")).groupBy("block", "part")
    right = asked.select("*", _each(blocks).alias("block"), part).groupBy("block", "part")
    return left.cogroup(right).applyInArrow(match, _FOUND)


_SCHEMA = pa.schema([(c.split()[0], pa.int64()) for c in _FOUND.split(", ")])


def _ranked(found: DataFrame, most: int, by: list[str]) -> DataFrame:
    """The first ``most`` of each group by score and id, with their ``rank``."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"), "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _rounds(asked: DataFrame, thresholds: list[Column], scan, by: list[str], most: int, done: Column) -> DataFrame:
    """One scan for each threshold, which is a column over ``asked``; what a round fills, or whose threshold makes ``done`` true, leaves
    the following ones."""
    whole = None
    for k, threshold in enumerate(thresholds):
        asked = asked.withColumn("least", threshold)
        found = stored(_ranked(scan(asked), most, by))
        last = k == len(thresholds) - 1
        full = found.where(F.col("rank") == most).select(*by)
        if not last:
            ended = asked.where(done).select(*by)
            full = stored(full.union(ended).distinct())
            condition = [found[c].eqNullSafe(full[c]) for c in by]
            found = found.join(full, condition, "left_semi")
        whole = found if whole is None else whole.unionByName(found)
        if not last:
            asked = stored(asked.join(full, [asked[c].eqNullSafe(full[c]) for c in by], "left_anti"))
            if asked.isEmpty():
                break
    return whole


def prepared(embeddings: DataFrame, scale: int = 256, shifted: int = 7, labels: int = 10) -> DataFrame:
    """The rows that take part, (id, key, label, vector) in whole numbers: each component x is ``floor(scale * x)``; where the id is divisible by
    ``shifted``, the label is the next one of ``labels``. ``key`` is a hash of the row."""
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.when(F.col("vec_id") % shifted == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * float(scale)).cast("long"))
    rows = embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), label.cast("int").alias("label"), vector.alias("vector")).distinct()
    return rows.select("id", F.xxhash64("id", "label", "vector").alias("key"), "label", "vector")


def mined(rows: DataFrame, anchors: Column, mining: Mining = Mining()) -> DataFrame:
    """The hard negatives of each anchor and positive: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score``. ``rows``: (id, key, label, vector) as ``prepared`` gives them; ``anchors``: which of them ask.

    A score is the inner product with the anchor; higher ones come first, ties by lower id. An anchor's positives are its
    first other rows of its label; its negatives, for each positive, the first rows of other labels whose score is within
    ``low`` to ``high`` per cent of the positive's (none, if that is below 0).

    Each round is a threshold join of the anchors that still ask with blocks of all rows. A block's rows are indexed by
    dimension; dimensions whose norms cannot reach the threshold are left out of the index; scores add up over the lists,
    what cannot reach the threshold with the norms that remain is dropped, and the others get their whole score. A window that
    a round does not fill is asked again with a lower threshold, down to none, so results are whole.
    Only the first of each window leave a block, so no anchor gathers more than that from each.

    Vectors may differ in length: shorter ones count as if they ended in zeros. Sums of products beyond 64 bits count as the largest number.
    Repeated rows count once; rows with one id but another label or vector are rows of their own, also as anchors.
    A null id takes part and comes last. Without rows or anchors the result is empty."""
    rows = stored(rows.select("id", "key", "label", "vector"))
    size = rows.agg(F.count("*").alias("n"), F.sum(F.size("vector")).alias("cells")).first()
    blocks = max(1, -(-max(size["cells"] or 0, size["n"]) // mining.cells))
    asked = rows.where(anchors).select(F.col("id").alias("a_id"), F.col("key").alias("a_key"), F.col("label").alias("a_label"), F.col("vector").alias("a_vector"))
    norm = F.aggregate("a_vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    no_windows = F.lit(None).cast("array<struct<p_id:long,p_key:long,positive_score:long,least:long,most:long>>")

    def bounded(share: float) -> Column:
        return F.least(norm * share, F.lit(2.0**62)).cast("long")

    def positives(asked: DataFrame) -> DataFrame:
        return _scan(asked.withColumn("windows", no_windows), rows, blocks, mining).drop("p_id", "p_key", "positive_score")

    thresholds = [*(bounded(s) for s in mining.same), F.lit(_LEAST).cast("long")]
    anchor = ["a_id", "a_key"]
    found = _rounds(asked, thresholds, positives, anchor, mining.positives, F.lit(False))
    p = F.col("positive_score")
    exact = p.cast("decimal(20,0)")
    window = found.select(*anchor, F.col("id").alias("p_id"), F.col("key").alias("p_key"), F.col("score").alias("positive_score"))
    window = window.where(p >= 0).select(
        "*", F.ceil(exact * mining.low / 100).cast("long").alias("lowest"), F.floor(exact * mining.high / 100).cast("long").alias("most")
    )

    def negatives(windows: DataFrame) -> DataFrame:
        one = F.struct("p_id", "p_key", "positive_score", F.greatest("least", "lowest").alias("least"), "most")
        by_anchor = windows.groupBy(*anchor).agg(F.collect_list(one).alias("windows"))
        by_anchor = by_anchor.withColumn("least", F.array_min(F.transform("windows", lambda w: w["least"])))
        whole = asked.join(by_anchor.withColumnsRenamed({"a_id": "_id", "a_key": "_key"}), F.col("a_id").eqNullSafe(F.col("_id")) & (F.col("a_key") == F.col("_key")))
        return _scan(whole.drop("_id", "_key"), rows, blocks, mining)

    shares = [F.greatest(F.floor(p.cast("double") * s).cast("long"), F.col("lowest")) for s in mining.other]
    by = [*anchor, "p_id", "p_key"]
    whole = _rounds(stored(window), [*shares, F.col("lowest")], negatives, by, mining.negatives, F.col("least") <= F.col("lowest"))
    return whole.select(
        F.col("a_id").alias("anchor_id"), F.col("p_id").alias("positive_id"), "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
