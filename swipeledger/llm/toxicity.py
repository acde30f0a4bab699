"""Toxicity: a linear-chain conditional random field tags toxic words; documents are scored by its marginals."""

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swipeledger.llm.common import bytes_of, held_out_by

EDGES = b".,;:!?#$%&*|\"'()[]{}<>-_"
THRESHOLD = 0.3
#: Tokens of one chain at most; a line is one chain or several.
CHAIN = 64
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Sample:
    """The bound of the training sample: ``rows`` labelled documents of each label at most, none of them longer than
    ``chars``; those whose ids have the lowest hashes."""

    rows: int = 2000
    chars: int = 20_000


#: Lengths in bytes of the word beginnings that are features.
STEMS = range(4, 11)


def plain(word: bytes) -> bytes:
    return word.strip(EDGES)


def features_of(word: bytes) -> list[bytes]:
    """The word itself, then its proper beginnings, longest first."""
    return [b"=" + word, *(word[:k] for k in reversed(STEMS) if k < len(word))]


class Lookup(dict):
    """Feature numbers of raw words, found once each: that of the word or its longest beginning, 0 if none is a feature."""

    def __init__(self, features: dict[bytes, int], remembered: int = 300_000):
        super().__init__()
        self.features, self.remembered = features, remembered

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.remembered:
            self.clear()
        found = next((self.features[f] for f in features_of(plain(word)) if f in self.features), 0)
        self[word] = found
        return found


def chains(text: bytes, lookup: Lookup) -> list[list[int]]:
    """The feature numbers of the words of each line, cut into chains."""
    out = []
    for line in text.split(b"\n"):
        ids = [lookup[w] for w in line.split()]
        out.extend(ids[i : i + CHAIN] for i in range(0, len(ids), CHAIN))
    return out


def feature_weights(texts: list[bytes], toxic: np.ndarray, steps: int = 200, l2: float = 2.0, least: int = 4) -> dict[bytes, float]:
    """Weights of words and beginnings in a logistic regression of the documents' labels on how often they occur, up to
    three times; 0 for those that are not at least five times as common in toxic documents, or not surely so. Features that always come together share their weight, so the words of one copied
    text stay low; of beginnings of the same documents only the longest is a feature."""
    documents = [Counter(filter(None, map(plain, text.split()))) for text in texts]
    seen: Counter = Counter()
    for words in documents:
        seen.update({f for w in words for f in features_of(w)})
    longer = {f[:-1]: n for f, n in sorted(((f, n) for f, n in seen.items() if f[:1] != b"="), key=lambda x: x[1])}
    kept = sorted(f for f, n in seen.items() if n >= least and (f[:1] == b"=" or longer.get(f, 0) < n))
    index = {f: i for i, f in enumerate(kept)}
    row, col, value = array("i"), array("i"), array("d")
    for r, words in enumerate(documents):
        times: Counter = Counter()
        for w, n in words.items():
            for f in features_of(w):
                if f in index:
                    times[index[f]] += n
        row.extend([r] * len(times))
        col.extend(times)
        value.extend(min(n, 3) / 3 for n in times.values())
    if not row:
        return {}
    row, col, value = np.array(row), np.array(col), np.array(value)
    weight = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum())) * len(toxic)
    w, m, v, bias = np.zeros(len(index)), np.zeros(len(index)), np.zeros(len(index)), 0.0
    for step in range(1, steps + 1):
        z = np.bincount(row, weights=w[col] * value, minlength=len(toxic)) + bias
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic)
        slope = (np.bincount(col, weights=error[row] * value, minlength=len(index)) + l2 * w) / len(toxic)
        bias -= 0.5 * error.mean()
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    there = np.bincount(col[toxic[row]], minlength=len(index)), np.bincount(col[~toxic[row]], minlength=len(index))
    n_toxic, n_clean = toxic.sum(), (~toxic).sum()
    lift = ((there[0] + 0.5) / (n_toxic + 1)) / ((there[1] + 0.5) / (n_clean + 1))
    share = (there[0] + there[1]) / len(toxic)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / max(1, n_toxic) + 1 / max(1, n_clean)))
    sure = (lift >= 5) & ((there[0] / max(1, n_toxic) - there[1] / max(1, n_clean)) / error >= 3.5)
    return {f: float(w[i]) if sure[i] else 0.0 for f, i in index.items()}


def padded(sequences: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences as the rows of one array, longest first, and their lengths in that order."""
    lengths = np.array([len(s) for s in sequences])
    table = np.zeros((len(sequences), lengths.max()), np.int64)
    for i, s in enumerate(sequences):
        table[i, : len(s)] = s
    return table, lengths


def marginals(ids: np.ndarray, lengths: np.ndarray, emit: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all chains at once: the chance that each token is toxic, and the expected
    number of each of the four transitions. ``emit``: by feature, the score of toxic against not;
    ``move``: the scores from label to label."""
    n, width = ids.shape
    score = np.exp(np.clip(emit[ids], -30, 30))
    step = np.exp(np.clip(move, -30, 30))
    inside = np.arange(width) < lengths[:, None]
    forward = np.empty((width, n, 2))
    at = np.stack([np.ones(n), score[:, 0]], 1)
    forward[0] = at / at.sum(1, keepdims=True)
    for t in range(1, width):
        at = forward[t - 1] @ step
        at[:, 1] *= score[:, t]
        at /= at.sum(1, keepdims=True)
        forward[t] = np.where(inside[:, t, None], at, forward[t - 1])
    chance = np.zeros((n, width))
    moves = np.zeros((2, 2))
    back = np.ones((n, 2))
    for t in range(width - 1, -1, -1):
        both = forward[t] * back
        both /= both.sum(1, keepdims=True)
        chance[:, t] = np.where(inside[:, t], both[:, 1], 0.0)
        if t:
            here = np.stack([back[:, 0], back[:, 1] * score[:, t]], 1)
            joint = forward[t - 1][:, :, None] * step * here[:, None, :]
            joint /= joint.sum((1, 2), keepdims=True)
            moves += joint[inside[:, t]].sum(0)
            before = here @ step.T
            before /= before.sum(1, keepdims=True)
            back = np.where(inside[:, t, None], before, back)
    return chance, moves


def train_crf(ids: np.ndarray, lengths: np.ndarray, gold: np.ndarray, n_features: int, steps: int = 80) -> tuple[np.ndarray, np.ndarray]:
    """Emission scores by feature and transition scores with the highest regularised likelihood."""
    inside = np.arange(ids.shape[1]) < lengths[:, None]
    want = np.bincount(ids[inside], weights=gold[inside], minlength=n_features)
    a, b = gold[:, :-1][inside[:, 1:]], gold[:, 1:][inside[:, 1:]]
    want_moves = np.bincount(2 * a + b, minlength=4).reshape(2, 2)
    emit, move = np.zeros(n_features), np.zeros((2, 2))
    theta = np.zeros(n_features + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    times = np.maximum(np.bincount(ids[inside], minlength=n_features), 1)
    for step in range(1, steps + 1):
        chance, moves = marginals(ids, lengths, emit, move)
        have = np.bincount(ids[inside], weights=chance[inside], minlength=n_features)
        slope = np.concatenate([(want - have) / times, ((want_moves - moves) / max(1, moves.sum())).ravel()])
        slope -= 1e-3 * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta += 0.25 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        emit, move = theta[:n_features], theta[n_features:].reshape(2, 2)
    return emit, move


@dataclass(frozen=True)
class Model:
    """``features``: numbers of the words and beginnings that can be toxic, from 1 on; 0 is any other word. ``rate``: the answer
    if there was nothing to learn from."""

    features: dict
    emit: np.ndarray
    move: np.ndarray
    scale: np.ndarray
    rate: float | None = None

    def expected(self, texts: list[bytes], lookup: Lookup) -> tuple[np.ndarray, list]:
        """The expected number of toxic words in each text, of those that have a feature, and (text, first word of
        the chain, chances) for the chains that have such words. Other words add nothing, or a
        long text would add up to something by its length alone."""
        total = np.zeros(len(texts))
        marked, origin = [], []
        for i, text in enumerate(texts):
            at = 0
            for chain in chains(text, lookup):
                if any(chain):
                    marked.append(chain)
                    origin.append((i, at))
                at += len(chain)
        found = []
        for first in range(0, len(marked), 4096):
            ids, lengths = padded(marked[first : first + 4096])
            chance = marginals(ids, lengths, self.emit, self.move)[0]
            for (i, at), numbers, row, n in zip(origin[first : first + 4096], ids, chance, lengths):
                total[i] += row[numbers > 0].sum()
                found.append((i, at, row[:n]))
        return total, found

    def scores(self, total: np.ndarray) -> np.ndarray:
        return np.full(len(total), self.rate) if self.rate is not None else 1 / (1 + np.exp(-shape(total) @ self.scale))


def shape(total: np.ndarray) -> np.ndarray:
    """What the document score is linear in, on the logistic scale: pieces of the expected number."""
    return np.stack([np.ones_like(total), np.clip(total, 0, 1), np.clip(total - 1, 0, 1), np.clip(total - 2, 0, 2), np.log1p(total)], 1)


def calibrated(total: np.ndarray, toxic: np.ndarray, weight: np.ndarray, steps: int = 25) -> np.ndarray:
    """Logistic regression of labels on ``shape`` by Newton's method; rising in every piece."""
    x, scale = shape(total), np.zeros(5)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ scale, -30, 30)))
        slope = x.T @ (weight * (toxic - p)) - 0.5 * np.r_[0, scale[1:]]
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([1e-6, 0.5, 0.5, 0.5, 0.5])
        scale = scale + np.clip(np.linalg.solve(curve, slope), -2, 2)
        scale[1:] = np.maximum(scale[1:], 0)
    return scale


def train(documents: DataFrame, labels: DataFrame, sample: Sample = Sample(), id_column: str = "doc_id", text_column: str = "text") -> Model:
    """Learns from the labelled rows that are not held out. Their label counts are of all rows; words and
    chains are learnt from the bounded ``sample``. A token counts as toxic if its document does and its word
    weighs in a regression of labels on words."""
    known = (
        labels.where(~held_out_by(F.col(id_column), 4, 2) & F.col("toxic").isNotNull() & F.col(id_column).isNotNull())
        .groupBy(F.col(id_column).alias("l_id")).agg((F.max("toxic") > 0).alias("toxic"))
    )
    counts = {bool(r["toxic"]): r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return Model({}, np.zeros(1), np.zeros((2, 2)), np.zeros(5), rate=float(True in counts))
    drawn = documents.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    drawn = drawn.where(F.length("text") <= sample.chars).join(known, F.col("id") == F.col("l_id"))
    order = [F.xxhash64("id"), "id", F.xxhash64("text")]
    ids = [drawn.where(F.col("toxic") == t).select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample.rows) for t in (True, False)]
    ids = ids[0].union(ids[1])
    rows = drawn.join(F.broadcast(ids), "id", "left_semi").orderBy(*order).limit(4 * sample.rows).select("text", "toxic").collect()
    texts = [r["text"].lower().encode() for r in rows]
    toxic = np.array([r["toxic"] for r in rows], bool)
    if toxic.all() or not toxic.any():
        return Model({}, np.zeros(1), np.zeros((2, 2)), np.zeros(5), rate=counts[True] / sum(counts.values()))
    weights = feature_weights(texts, toxic)
    least = 0.15 * max(weights.values(), default=0.0)
    chosen = sorted(f for f, x in weights.items() if x >= least > 0)
    features = {f: i for i, f in enumerate(chosen, 1)}
    lookup = Lookup(features)
    ids, gold, others = [], [], []
    for text, bad in zip(texts, toxic):
        for chain in chains(text, lookup):
            if any(chain):
                ids.append(chain)
                gold.append([int(bad and f > 0) for f in chain])
            elif len(others) < 2 * sample.rows:
                others.append(chain)
    ids, gold = ids + others, gold + [[0] * len(c) for c in others]
    if not ids:
        return Model({}, np.zeros(1), np.zeros((2, 2)), np.zeros(5), rate=counts[True] / sum(counts.values()))
    table, lengths = padded(ids)
    emit, move = train_crf(table, lengths, padded(gold)[0], len(features) + 1)
    model = Model(features, emit, move, np.zeros(5))
    total, _ = model.expected(texts, lookup)
    weight = np.where(toxic, counts[True] / toxic.sum(), counts[False] / (~toxic).sum())
    weight *= len(toxic) / weight.sum()
    return Model(features, emit, move, calibrated(total, toxic, weight))


SCORED = [
    T.StructField("score", T.DoubleType()),
    T.StructField("predicted", T.IntegerType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
]


def _spans(text: bytes, toxic: list[int]) -> list[dict]:
    """(start, end) in code points of the words with these places in the text."""
    wanted, out, at, last = set(toxic), [], 0, 0
    for k, word in enumerate(_WORD.finditer(text)):
        if k in wanted:
            at += len(text[last : word.start()].decode())
            size = len(word.group().decode())
            out.append({"start": at, "end": at + size})
            at, last = at + size, word.end()
    return out


def score(documents: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``documents`` with ``score``, the chance that the document is toxic, ``predicted`` (1 from a score of 0.3 on) and
    ``spans``, the places (start and end in code points) of words that are more likely toxic than not.

    Every row is scored by its whole text, in one pass without a shuffle. Null and empty texts have no toxic
    word and get the score of that. Columns of the input pass through; columns named like the new
    ones are replaced."""
    kept = documents.drop(*(f.name for f in SCORED))
    at = kept.columns.index(text_column)
    schema = T.StructType([*kept.schema.fields, *SCORED])
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(model.features)
        for batch in batches:
            texts = bytes_of(batch.column(at))
            total, found = model.expected([t.decode().lower().encode() for t in texts], lookup)
            scores = model.scores(total)
            toxic: dict[int, list[int]] = {}
            for i, first, chance in found:
                toxic.setdefault(i, []).extend((first + np.flatnonzero(chance >= 0.5)).tolist())
            spans = [_spans(t, toxic[i]) if toxic.get(i) else [] for i, t in enumerate(texts)]
            new = [pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32)), pa.array(spans, span_type)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=schema.names)

    return kept.mapInArrow(judge, schema)


def without_toxic(documents: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of ``documents`` that are not predicted toxic, with all their columns."""
    at = documents.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(model.features)
        for batch in batches:
            total, _ = model.expected([t.decode().lower().encode() for t in bytes_of(batch.column(at))], lookup)
            yield batch.filter(pa.array(model.scores(total) < THRESHOLD))

    return documents.mapInArrow(keep, documents.schema)
