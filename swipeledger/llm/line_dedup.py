"""Line dedup: an exact set-similarity join of all lines by prefix, position and length; later matches go."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeledger.llm.common import WordHashes, bytes_of, in_slices, mixed, most_frequent, stored
from swipeledger.llm.graph import components
from swipeledger.llm.sized_filter import filter_of, passing
from swipeledger.operators.skew import join_account

#: Bits of a word's number; the rest of 64 numbers the lines of a batch while they are sorted.
WORD_BITS = 44
_LOW = np.uint64((1 << WORD_BITS) - 1)
_SHIFT = np.uint64(WORD_BITS)
#: Words from this number on are frequent ones, by how frequent they are.
_FREQUENT = 1 << (WORD_BITS - 1)
#: What the index sends, and the same with the line's first place, which comes with its words.
INDEX = np.dtype([("word", "<i8"), ("line", "<i8"), ("size", "<i4"), ("pos", "<i4"), ("bits", "<u8", 2)])
RECORD = np.dtype([("word", "<i8"), ("line", "<i8"), ("doc", "<i8"), ("at", "<i4"), ("size", "<i4"), ("pos", "<i4"), ("bits", "<u8", 2)])


@dataclass(frozen=True)
class Join:
    """``similarity``: the least Jaccard similarity of two lines' word sets. ``ranked``: words whose rank every task gets.
    ``first``: lists in which no line has more before it that may match give pairs of lines; the others are gone through again.
    ``bucket``: records of the prefix index that are worked on together. ``block``: lines of one list that are compared with as many others at
    once, where a list is gone through again."""

    similarity: float = 0.8
    ranked: int = 60_000
    first: int = 4
    bucket: int = 120_000
    block: int = 20_000


class Numbers:
    """The numbers of words: by their rank if they are frequent, else by their hash and lower than all those, so that words in
    order of their numbers are in order of rarity. ``ranked``: the hashes of the frequent words, the rarest first."""

    def __init__(self, ranked: np.ndarray):
        self.hashes = WordHashes()
        self.by_rank = ranked
        # Ranks by the last bits of their hashes, in as many tables as share these bits at most.
        self.mask = np.uint64((1 << max(1, (16 * len(ranked)).bit_length())) - 1)
        self.tables, left = [], np.arange(len(ranked))
        while len(left):
            cell, some = np.unique(ranked[left] & self.mask, return_index=True)
            ranks = np.full(int(self.mask) + 1, -1, np.int32)
            ranks[cell.astype(np.int64)] = left[some]
            self.tables.append(ranks)
            left = np.delete(left, some)

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        hashes, start = self.hashes(data)
        found = hashes & np.uint64(_FREQUENT - 1)
        cell, out, left = (found & self.mask).astype(np.int64), found, None
        for ranks in self.tables:
            # Few words share a cell with others, and only those that no table has yet go on to the next.
            here = found if left is None else found[left]
            rank = ranks[cell if left is None else cell[left]]
            same = (rank >= 0) & (self.by_rank[rank] == here)
            if left is None:
                out = np.where(same, np.uint64(_FREQUENT) + rank.astype(np.uint64), found)
                left = np.flatnonzero(~same)
            else:
                out[left[same]] = np.uint64(_FREQUENT) + rank[same].astype(np.uint64)
                left = left[~same]
        return out, start

    def names(self, lines: "Lines") -> np.ndarray:
        """A number for each line's set of words, the same for any ranks."""
        if not len(lines.row):
            return np.zeros(0, np.int64)
        words = lines.words.astype(np.uint64)
        ranked = words >= _FREQUENT
        words[ranked] = self.by_rank[words[ranked] - np.uint64(_FREQUENT)]
        with np.errstate(over="ignore"):
            return mixed(np.add.reduceat(mixed(words), lines.start[:-1])).view(np.int64)


@dataclass
class Lines:
    """The lines with a word of some texts. ``row``, ``at``: the text and the line's place in it. ``words``: the numbers of
    each line's distinct words in ascending order, one line after the other from ``start`` on."""

    row: np.ndarray
    at: np.ndarray
    words: np.ndarray
    start: np.ndarray

    @property
    def size(self) -> np.ndarray:
        return np.diff(self.start)


def lines_of(texts: list[bytes], number: Numbers) -> Lines:
    data = b"\n".join(texts)
    ids, begin = number(data)
    if not len(ids):
        return Lines(*(np.zeros(0, np.int64),) * 3, np.zeros(1, np.int64))
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    first = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    line = np.repeat(np.arange(len(ends) + 1), np.diff(np.r_[0, np.searchsorted(begin, ends), len(begin)]))
    changes = np.r_[True, line[1:] != line[:-1]]
    new = np.flatnonzero(changes)
    of_word, n = line[new], np.cumsum(changes) - 1
    row = np.searchsorted(first, begin[new], "right") - 1
    at = of_word - np.searchsorted(ends, first)[row]
    words, parts = [], []
    # As many lines at once as the bits beside a word's number can count.
    for begin_line in range(0, len(of_word), MOST_LINES):
        some = slice(*np.searchsorted(n, [begin_line, begin_line + MOST_LINES]))
        keyed = np.sort(((n[some] - begin_line).astype(np.uint64) << _SHIFT) | ids[some])
        keyed = keyed[np.r_[True, keyed[1:] != keyed[:-1]]]
        words.append((keyed & _LOW).astype(np.int64))
        parts.append((keyed >> _SHIFT).astype(np.int64) + begin_line)
    words, parts = np.concatenate(words), np.concatenate(parts)
    return Lines(row.astype(np.int64), at.astype(np.int64), words, np.searchsorted(parts, np.arange(len(of_word) + 1)))


#: Texts of about as many bytes are worked on at once, and so many lines are numbered beside a word's number.
SLICE, MOST_LINES = 1 << 18, 1 << (64 - WORD_BITS)


def overlap(a, b, similarity: float):
    """How many words two sets of these sizes share at least if they are similar."""
    return np.ceil(similarity / (1 + similarity) * (a + b) - 1e-9).astype(np.int64)


def prefix_records(lines: Lines, names: np.ndarray, chosen: np.ndarray, again: np.ndarray, similarity: float) -> np.ndarray:
    """A record for each of the rarest words of the ``chosen`` lines: two similar sets share one of these; and one for the rarest word of those that come ``again``.
    ``bits`` are those that the words from this one on turn."""
    size = lines.size
    length = np.where(chosen, size - np.ceil(similarity * size - 1e-9).astype(np.int64) + 1, again)
    which = np.repeat(np.arange(len(size)), length)
    pos = np.arange(len(which)) - np.repeat(np.cumsum(length) - length, length)
    spread = mixed(lines.words.astype(np.uint64))
    bit = np.uint64(1) << (spread & np.uint64(63))
    half = (spread >> np.uint64(6)) & np.uint64(1)
    out = np.zeros(len(which), INDEX)
    out["word"], out["line"] = lines.words[lines.start[which] + pos], names[which]
    out["size"], out["pos"] = size[which], pos
    for h in (0, 1):
        turned = np.zeros(len(bit) + 1, np.uint64)
        np.bitwise_xor.accumulate(np.where(half == h, bit, np.uint64(0)), out=turned[1:])
        out["bits"][:, h] = turned[lines.start[which + 1]] ^ turned[lines.start[which] + pos]
    return out


#: Bits for a line's size beside its word while records are sorted, and the longest lists of which every pair meets the filters at once.
SIZE_BITS, LOOKED = 64 - WORD_BITS, 4_000


def likely_pairs(records: np.ndarray, similarity: float, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two names of lines that share a word of the index and may be similar, with that word, of all lists in which no line has more than
    ``first`` before it that pass the filters; the records of the other lists, which have none here, without those that no filter lets pass with any; and the names that came more
    than once. Of lists with more than ``LOOKED`` records all are returned once a line has more: they are not looked at to their end here.

    The filters lose no similar pair in the list of the first word that both have, where it counts: sizes; what the words after the shared one can add; and the bits, of which each
    word from the shared one on turns one, so that two sets differ there by as many words at least as bits. The words before it are in one of the sets only."""
    word, line = (np.ascontiguousarray(records[c]) for c in ("word", "line"))
    # The same set from several tasks is one record. Lists are in order of sizes, so that those a line may match stand right before it.
    order = np.argsort(mixed(word.view(np.uint64)) ^ line.view(np.uint64))
    same = np.zeros(len(records), bool)
    same[1:] = (word[order][1:] == word[order][:-1]) & (line[order][1:] == line[order][:-1])
    copied = np.unique(line[order[same]])
    records = records[order[~same]]
    size = records["size"].astype(np.int64)
    key = (records["word"].view(np.uint64) << np.uint64(SIZE_BITS)) | np.minimum(size, (1 << SIZE_BITS) - 1).astype(np.uint64)
    order = np.argsort(key)
    word = records["word"][order]
    # Words that one record alone has give no pair.
    alike = word[1:] == word[:-1]
    order = order[np.r_[False, alike] | np.r_[alike, False]] if len(word) > 1 else order[:0]
    records, size, key = records[order], size[order], key[order]
    begins = np.ones(len(records), bool)
    begins[1:] = records["word"][1:] != records["word"][:-1]
    head = np.maximum.accumulate(np.where(begins, np.arange(len(records)), 0))
    least = np.minimum(np.ceil(similarity * size - 1e-9).astype(np.int64), (1 << SIZE_BITS) - 1).astype(np.uint64)
    place = np.arange(len(records))
    place -= np.searchsorted(key, (records["word"].view(np.uint64) << np.uint64(SIZE_BITS)) | least)
    pos, bits = records["pos"].astype(np.int64), np.ascontiguousarray(records["bits"])
    found, near = np.zeros(len(records), np.int64), np.zeros(len(records), bool)
    long = np.zeros(len(records) + 1, bool)  # by the first record of a list
    whole = np.bincount(head, minlength=len(records) + 1) <= LOOKED  # lists that are looked at to their end
    open_ = np.flatnonzero(place > 0)
    ones, others, step = [], [], 1
    while len(open_):
        other = open_ - step
        a, b = size[open_], size[other]
        need = overlap(a, b, similarity)
        some = np.flatnonzero(np.minimum(a - pos[open_], b - pos[other]) >= need)
        x, y = open_[some], other[some]
        passed = np.bitwise_count(bits[x] ^ bits[y]).sum(1) <= (a + b - 2 * need)[some] - pos[x] - pos[y]
        x, y = x[passed], y[passed]
        near[x] = near[y] = True
        found[x] += 1
        long[head[x[found[x] > first]]] = True
        kept = ~long[head[x]]
        ones.append(x[kept])
        others.append(y[kept])
        step += 1
        open_ = open_[(place[open_] >= step) & (whole | ~long)[head[open_]]]
    x, y = (np.concatenate([np.zeros(0, np.int64), *c]) for c in (ones, others))
    short = ~long[head[x]]
    x, y = x[short], y[short]
    return records["line"][x], records["line"][y], records["word"][x], records[long[head] & (near | ~whole[head])], copied


def joined_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label``, by which items are in groups named by their least, with the groups of each ``a`` and ``b`` put together."""
    while True:
        a, b = label[a], label[b]
        apart = a != b
        if not apart.any():
            return label
        a, b = a[apart], b[apart]
        to = np.arange(len(label))
        np.minimum.at(to, np.maximum(a, b), np.minimum(a, b))
        label = to[label]
        while (label != label[label]).any():
            label = label[label]


#: Pairs that are held until they are added to the sums of their lines; pairs, marks of words and words that are looked at together.
HELD, PAIRS, MARKS, WORDS = 500_000, 50_000, 1 << 21, 1_000_000


def _spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All places of the spans that begin at ``start``, one span after the other."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


def _split(length: np.ndarray, most: int) -> Iterator[slice]:
    """Items that follow each other, of at most about ``most`` in length together."""
    part = np.cumsum(length) // most
    edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(length)]
    return (slice(a, b) for a, b in zip(edges, edges[1:]) if b > a)


def links_in(records: np.ndarray, words: list[np.ndarray], inner: int, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one word's list, all lines that are similar to others of it: the name, how many they are, the least name of the earlier ones (its own if there is none), and the name
    of one that similar lines connect it with. Those before ``inner`` are compared with those from there on; with one another if that is 0. ``words``: the lines' sets in
    ascending order. A pair counts in the list of the first word that both have, and only there, so it counts once."""
    name, n_lines = records["line"], len(records)
    size, pos, bits = records["size"].astype(np.int64), records["pos"].astype(np.int64), np.ascontiguousarray(records["bits"])
    flat = np.concatenate(words)
    known, flat = np.unique(flat, return_inverse=True)
    before_word = np.searchsorted(known, records["word"][0])
    lengths = np.array([len(w) for w in words])
    start = np.cumsum(lengths) - lengths
    order = np.argsort(size, kind="stable")
    left, right = (order[order < inner], order[order >= inner]) if inner else (order, order)
    place = np.empty(n_lines, np.int64)
    place[np.lexsort((name, records["at"], records["doc"]))] = np.arange(n_lines)
    n, match, label = np.zeros(n_lines, np.int64), name.copy(), np.arange(n_lines)
    matched = np.zeros(n_lines, bool)
    held, n_held = [], 0

    def add() -> np.ndarray:
        x, y = (np.concatenate(c) for c in zip(*held))
        after, before = np.where(place[y] < place[x], x, y), np.where(place[y] < place[x], y, x)
        n[:] += np.bincount(x, minlength=n_lines) + np.bincount(y, minlength=n_lines)
        fresh = np.unique(after)
        match[fresh[~matched[fresh]]] = np.iinfo(np.int64).max
        matched[fresh] = True
        np.minimum.at(match, after, name[before])
        return joined_labels(label, x, y)

    # Of similar sets neither has less than its share of the other's size; each pair is met once.
    ordered = size[right]
    least = np.searchsorted(ordered, np.ceil(similarity * size[left] - 1e-9))
    most = np.searchsorted(ordered, np.floor(size[left] / similarity + 1e-9), "right")
    # As many lines at once as have about so many pairs before the filters, one at least.
    until = np.cumsum(np.maximum(most - least, 1))
    begin = 0
    while begin < len(left):
        end = max(begin + 1, int(np.searchsorted(until, (until[begin - 1] if begin else 0) + PAIRS, "right")))
        end = min(end, begin + max(1, MARKS // len(known)))
        times = most[begin:end] - least[begin:end]
        row = np.repeat(np.arange(end - begin), times)
        y = right[np.arange(len(row)) + np.repeat(least[begin:end] - np.cumsum(times) + times, times)]
        own = left[begin:end]
        begin = end
        x = own[row]
        need = overlap(size[x], size[y], similarity)
        some = (name[y] != name[x]) & ((inner > 0) | (place[y] < place[x])) & (np.minimum(size[x] - pos[x], size[y] - pos[y]) >= need)
        row, x, y, need = row[some], x[some], y[some], need[some]
        some = np.bitwise_count(bits[x] ^ bits[y]).sum(1) <= size[x] + size[y] - 2 * need - pos[x] - pos[y]
        row, x, y, need = row[some], x[some], y[some], need[some]
        if not len(y):
            continue
        mark = np.zeros((len(own), len(known)), np.int64)
        each = _spans(start[own], lengths[own])
        mark[np.repeat(np.arange(len(own)), lengths[own]), flat[each]] = np.where(flat[each] < before_word, 1 << 40, 1)
        for some in _split(lengths[y], WORDS):
            ends = np.cumsum(lengths[y[some]])
            theirs = flat[_spans(start[y[some]], lengths[y[some]])]
            # A word that both have before this list's is as much as makes any sum too large.
            shared = np.add.reduceat(mark[np.repeat(row[some], lengths[y[some]]), theirs], ends - lengths[y[some]])
            similar = (shared >= need[some]) & (shared < 1 << 40)
            if similar.any():
                held.append((x[some][similar], y[some][similar]))
                n_held += len(held[-1][0])
                if n_held > HELD:
                    label = add()
                    held, n_held = [], 0
    if held:
        label = add()
    some = np.flatnonzero(n)
    return name[some], n[some], match[some], name[label[some]]


def _word_counts(documents: DataFrame) -> DataFrame:
    """(word, n): the hashes of words and how often they come, of those that a block of a task has twice or more, and at null how many all are. They are for
    the order of words only, and any order is right."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, n_held = WordHashes(), [], 0
        for batch in in_slices(batches, "text", SLICE):
            held.append(hashes(b"\n".join(bytes_of(batch.column("text"))))[0] & np.uint64(_FREQUENT - 1))
            n_held += len(held[-1])
            if n_held > 2_000_000:
                yield out(held)
                held, n_held = [], 0
        if held:
            yield out(held)

    def out(held: list[np.ndarray]) -> pa.RecordBatch:
        words, n = np.unique(np.concatenate(held), return_counts=True)
        total, words, n = n.sum(), words[n > 1].view(np.int64), n[n > 1]
        return pa.RecordBatch.from_arrays([pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(words)]), pa.array(np.r_[total, n])], names=["word", "n"])

    return documents.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


PLACE = np.dtype([("line", "<i8"), ("doc", "<i8"), ("text", "<i8"), ("at", "<i4")])
FOUND = "later long, earlier long, word long, records binary, copied long, places binary"


def planes(rows: np.ndarray) -> bytes:
    """The rows, all first bytes, then all second ones and so on: what is equal in most rows packs well so."""
    return np.ascontiguousarray(np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1).T).tobytes()


def rows_of(data: list[bytes], kind: np.dtype) -> np.ndarray:
    """The rows of several ``planes``."""
    parts = [np.ascontiguousarray(np.frombuffer(d, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel() for d in data]
    return np.concatenate([np.zeros(0, kind), *parts])


def _matched(documents: DataFrame, ranks: np.ndarray, join: Join, buckets: int) -> DataFrame:
    """One pass over the texts. Tasks send two kinds of records, packed by bucket: the prefix index by word, and all lines' places by text.
    A bucket of words gives two lines with the ``word`` of their list, of lists in which a line had more each of the ``records`` with its word and its
    line, as ``earlier``, and the lines that are ``copied``: those that come twice or more. Places only pass through, packed, all of a text together."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, seen, held, places, n_held = Numbers(ranks), {}, [], [], 0
        for batch in in_slices(batches, "text", SLICE):
            lines = lines_of(bytes_of(batch.column("text")), number)
            names = number.names(lines)
            place = np.zeros(len(names), PLACE)
            place["line"], place["at"] = names, lines.at
            place["doc"] = batch.column("id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)[lines.row]
            place["text"] = batch.column("text_id").to_numpy()[lines.row]
            # A text without lines has one place, before the first.
            bare = np.ones(len(batch), bool)
            bare[lines.row] = False
            none = np.zeros(int(bare.sum()), PLACE)
            none["doc"] = batch.column("id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)[bare]
            none["text"], none["at"] = batch.column("text_id").to_numpy()[bare], -1
            places += [place, none]
            # Of a task's copies the first counts, and the second tells that there are some.
            times = np.zeros(len(names), np.int8)
            for i, name in enumerate(names.tolist()):
                times[i] = seen[name] = min(seen.get(name, 0) + 1, 3)
            if len(seen) > 80_000:
                seen.clear()
            held.append(prefix_records(lines, names, times == 1, times == 2, join.similarity))
            n_held += len(held[-1])
            if n_held > 200_000:
                yield packed(np.concatenate(held), np.concatenate(places))
                held, places, n_held = [], [], 0
        if held:
            yield packed(np.concatenate(held), np.concatenate(places))

    def packed(records: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
        numbers, parts = [], []
        places = once(places)
        records = records[np.argsort(records["word"])]
        by_word = 1 + (mixed(records["word"].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        by_text = -1 - (mixed((places["doc"] ^ places["text"]).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        for rows, bucket in ((records, by_word), (places, by_text)):
            order = np.argsort(bucket, kind="stable")
            there, start = np.unique(bucket[order], return_index=True)
            numbers += there.tolist()
            parts += [planes(p) for p in np.split(rows[order], start[1:])] if len(there) else []
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(parts, pa.binary())], names=["bucket", "records"])

    def match(key, table):
        data = table.column("records").to_pylist()
        if key[0].as_py() > 0:
            return pairs_of(rows_of(data, INDEX), join, join.first)
        return filled(1, {"places": [planes(once(rows_of(data, PLACE)))]})

    return stored(documents.mapInArrow(index, "bucket long, records binary").groupBy("bucket").applyInArrow(match, FOUND))


_NO_ID = np.iinfo(np.int64).max


def once(places: np.ndarray) -> np.ndarray:
    """Without repeats: rows with the same id and text are one document."""
    return places[np.unique(mixed(mixed(places["doc"].view(np.uint64)) ^ places["text"].view(np.uint64)) ^ places["at"].astype(np.uint64), return_index=True)[1]]


def filled(n: int, columns: dict) -> pa.Table:
    """A table of ``FOUND`` with these columns; the others are null."""
    out = []
    for column in FOUND.split(", "):
        name, kind = column.split()
        kind = pa.binary() if kind == "binary" else pa.int64()
        out.append(pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind))
    return pa.Table.from_arrays(out, names=[c.split()[0] for c in FOUND.split(", ")])


def pairs_of(records: np.ndarray, join: Join, first: int) -> pa.Table:
    later, earlier, word, lists, copied = likely_pairs(records, join.similarity, first)
    data, size = np.ascontiguousarray(lists).tobytes(), lists.dtype.itemsize
    each = [data[i : i + size] for i in range(0, len(data), size)]
    listed = filled(len(lists), {"records": each, "word": lists["word"], "earlier": lists["line"]})
    return pa.concat_tables([filled(len(later), {"later": later, "earlier": earlier, "word": word}), listed, filled(len(copied), {"copied": copied})])


def _opened(places: DataFrame, losing: DataFrame) -> DataFrame:
    """Of the packed ``places`` a row for each document, with ``n_lines``, and one for each place, with ``line`` and ``at``, of the lines named in the one column of ``losing``, and
    of few others: a filter of them goes to every task."""
    losing = stored(losing)
    wanted = filter_of(losing, losing.count())

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("places").to_pylist():
                rows = rows_of([data], PLACE)
                rows = rows[np.lexsort((rows["text"], rows["doc"]))]
                new = np.flatnonzero(np.r_[True, (rows["doc"][1:] != rows["doc"][:-1]) | (rows["text"][1:] != rows["text"][:-1])])
                yield out(rows[new], np.add.reduceat(rows["at"] >= 0, new, dtype=np.int64))
                yield out(rows[passing(wanted, np.ascontiguousarray(rows["line"])) & (rows["at"] >= 0)])

    def out(rows: np.ndarray, n_lines: np.ndarray | None = None) -> pa.RecordBatch:
        none = pa.nulls(len(rows), pa.int64())
        columns = {"id": pa.array(rows["doc"], mask=rows["doc"] == _NO_ID), "text_id": pa.array(rows["text"])}
        columns["n_lines"] = none if n_lines is None else pa.array(n_lines, pa.int64())
        columns |= {"line": none, "at": none} if n_lines is not None else {"line": pa.array(rows["line"]), "at": pa.array(rows["at"].astype(np.int64))}
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return stored(places.mapInArrow(opened, "id long, text_id long, n_lines long, line long, at long"))


def _linked(lists: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """(line, n, match, link) of the lines that are similar to others in a list of ``lists`` (word, line, record), of a line some rows: with how many, the least name of the earlier
    ones (null if there is none), and the name of a line of the same class. ``sets``: (line, words, id, at). Pairs are added up where they are found. Long lists are cut into blocks,
    and every two blocks are compared in a task of their own."""
    found = lists.join(sets, "line").withColumn("h", F.xxhash64("line"))
    sizes = lists.groupBy("word").agg(F.ceil(F.count("*") / join.block).cast("int").alias("blocks"))
    dealt = found.join(sizes, "word").withColumn("own", F.pmod("h", "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("word", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "record", "words", "id", "at")

    def match(key, table):
        own = table.column("own").to_numpy()
        order = np.argsort(own, kind="stable")
        i, j = key[1].as_py(), key[2].as_py()
        inner = 0 if i == j else int((own == i).sum())
        if len(own) < 2 or i != j and inner in (0, len(own)):
            line = n = match = link = np.zeros(0, np.int64)
        else:
            there = np.frombuffer(b"".join(table.column("record").to_pylist()), INDEX)
            records = np.zeros(len(there), RECORD)
            for column in INDEX.names:
                records[column] = there[column]
            records["doc"], records["at"] = table.column("id").to_numpy(), table.column("at").to_numpy()
            words = table.column("words").to_pylist()
            line, n, match, link = links_in(records[order], [np.frombuffer(words[k], np.int64) for k in order.tolist()], inner, join.similarity)
        return pa.Table.from_arrays([pa.array(line), pa.array(n), pa.array(match, mask=match == line), pa.array(link)], names=["line", "n", "match", "link"])

    return dealt.groupBy("word", "i", "j").applyInArrow(match, "line long, n long, match long, link long")


def _word_sets(documents: DataFrame, names: DataFrame, ranks: np.ndarray) -> DataFrame:
    """(line, words, id, at) of the lines with these names, and of few others: a filter of them goes to every task. ``id`` and ``at`` are those of the line's first
    place; a null id is ``_NO_ID`` here."""
    names = stored(names)
    wanted = filter_of(names, names.count())

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, seen = Numbers(ranks), {}
        for batch in in_slices(batches, "text", SLICE):
            lines = lines_of(bytes_of(batch.column("text")), number)
            names = number.names(lines)
            ids = batch.column("id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)[lines.row]
            some, kept = np.flatnonzero(passing(wanted, names)), []
            # Of a task's copies only the first counts, and an earlier one that comes later.
            for i, name, place in zip(some.tolist(), names[some].tolist(), zip(ids[some].tolist(), lines.at[some].tolist())):
                known = seen.get(name)
                if known is None or place < known:
                    seen[name] = place
                    kept.append(i)
            if len(seen) > 100_000:
                seen.clear()
            words = [lines.words[lines.start[i] : lines.start[i + 1]].tobytes() for i in kept]
            yield pa.RecordBatch.from_arrays([pa.array(names[kept], pa.int64()), pa.array(words, pa.binary()), pa.array(ids[kept], pa.int64()), pa.array(lines.at[kept], pa.int64())], names=["line", "words", "id", "at"])

    found = documents.select("text", "id").mapInArrow(sets, "line long, words binary, id long, at long")
    return found.groupBy("line").agg(F.first("words").alias("words"), F.min(F.struct("id", "at")).alias("place")).select("line", "words", "place.id", "place.at")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(later, earlier) of the ``pairs`` (later, earlier, word), in either order, whose word sets have the similarity and whose first common word this is, so each comes once."""
    a, b = (sets.select(F.col("line").alias(to), F.struct("words", "id", "at").alias(x)) for to, x in (("later", "a"), ("earlier", "b")))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in range(0, len(batch), 4096):
                yield similar(batch.slice(some, 4096))

    def similar(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = len(batch)
        one, other, word = (batch.column(c).to_numpy() for c in ("later", "earlier", "word"))
        texts = batch.column("a").to_pylist() + batch.column("b").to_pylist()
        size = np.array([len(t) // 8 for t in texts], np.int64).reshape(2, n).sum(0)
        # The words of both sides by pair: those that come twice are shared.
        of = np.tile(np.arange(n, dtype=np.uint64), 2)
        keyed = np.sort(np.frombuffer(b"".join(texts), np.uint64) | (np.repeat(of, [len(t) // 8 for t in texts]) << _SHIFT))
        keyed = keyed[1:][keyed[1:] == keyed[:-1]]
        pair, start, shared = np.unique(keyed >> _SHIFT, return_index=True, return_counts=True)
        pair = pair.astype(np.int64)
        keep = ((keyed[start] & _LOW).astype(np.int64) == word[pair]) & (shared >= similarity * (size[pair] - shared) - 1e-9)
        pair = pair[keep]
        # Earlier is a lower place, then a lower name.
        a_id, a_at, b_id, b_at = (batch.column(c).to_numpy()[pair] for c in ("a_id", "a_at", "b_id", "b_at"))
        one, other = one[pair], other[pair]
        later = np.where(a_id != b_id, a_id > b_id, np.where(a_at != b_at, a_at > b_at, one > other))
        return pa.RecordBatch.from_arrays([pa.array(np.where(later, one, other)), pa.array(np.where(later, other, one))], names=["later", "earlier"])

    both = pairs.join(a, "later").join(b, "earlier")
    both = both.select("later", "earlier", "word", "a.words", "b.words", "a.id", "a.at", "b.id", "b.at").toDF("later", "earlier", "word", "a", "b", "a_id", "a_at", "b_id", "b_at")
    return both.mapInArrow(check, "later long, earlier long")


def _classes(matched: DataFrame) -> DataFrame:
    """(line, component) of all lines that are similar to any."""
    return components(matched.select(F.col("later").alias("a"), F.col("earlier").alias("b"))).withColumnRenamed("node", "line")


def removed_lines(
    documents: DataFrame, join: Join = Join(), id_column: str = "doc_id", text_column: str = "text", every_link: bool = False
) -> DataFrame:
    """One row per distinct document (id and text): ``id``, ``text_id`` (a hash of the text), ``n_lines`` (lines with a word), ``removed``, the numbers
    of the lines that go, and ``links``, for each of those (number, name of its set, name of an earlier set it matches; the
    same name if it is a copy; name of its class).

    A line is the set of its words. It goes if an earlier line has the same set, or one with at least the
    ``similarity`` (size of what they share over size of what they have together). Earlier means a lower id (whole
    numbers, null last), then a lower line number; whether the earlier line itself goes does not matter.

    Copies are gathered first, with their first place. Each distinct set is indexed by its rarest
    words, as many as a similar set must share one of. In a word's list each set is compared with the smaller
    ones, and the pairs that pass the filters are verified. Sets that pass them in lists in which one had more than ``first`` others are gone through once more, and
    their pairs are verified, counted and connected where they are found: a group of near copies gives a row for each line and not for each pair.
    Every similar pair of different sets is met, once, in the list of the first word that both have. A class holds all
    sets that similar ones connect, whatever their number. It is named by one of its sets; a set that is similar to
    no other is its own.

    With ``every_link``, ``links`` have a
    fifth value, with how many other sets the line's set is similar, and ``n_links`` is the sum of these numbers over the document's lines, also those that stay.

    Lines without a word are not counted and stay. Null and empty texts have no lines. Rows with the same id and
    text are one document here. Order of words and repeats in a line do not matter."""
    chosen = documents.select(
        F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    ).withColumn("text_id", F.xxhash64("text"))
    counted = stored(_word_counts(chosen))
    words = counted.where(F.col("word").isNull()).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    top = most_frequent(counted.where(F.col("word").isNotNull()), join.ranked)
    ranks = np.array([w for w, _ in reversed(top)], np.uint64)
    buckets = max(1, int((1.2 - join.similarity) * words) // join.bucket)

    found = _matched(chosen, ranks, join, buckets)
    pairs = found.where(F.col("later").isNotNull()).select("later", "earlier", "word")
    lists = found.where(F.col("records").isNotNull()).select("word", F.col("earlier").alias("line"), F.col("records").alias("record"))
    names = pairs.select(F.col("later").alias("name")).union(pairs.select("earlier")).union(lists.select("line")).distinct()
    words = stored(_word_sets(chosen, names, ranks))
    matched = stored(_verified(pairs, words, join.similarity))
    linked = stored(_linked(lists, words, join))
    classes = _classes(matched.unionByName(linked.select(F.col("line").alias("later"), F.col("link").alias("earlier"))))
    match = matched.select(F.col("later").alias("line"), F.lit(1).alias("n"), F.col("earlier").alias("match")).union(linked.select("line", "n", "match"))
    match = match.union(matched.select("earlier", F.lit(1), F.lit(None).cast("long")))
    match = match.groupBy("line").agg(F.sum("n").alias("n"), F.min("match").alias("match")).join(classes, "line", "left")
    match = stored(match.select("line", "match", F.col("component").alias("class"), "n"))
    # Only sets that have copies or a match can lose lines.
    copied = found.where(F.col("copied").isNotNull()).select("copied")
    opened = _opened(found.where(F.col("places").isNotNull()).select("places"), match.select("line").union(copied).distinct())
    lines = opened.where(F.col("line").isNotNull()).select("line", "id", "text_id", "at")
    place = F.struct(F.coalesce(F.col("id"), F.lit(_NO_ID)).alias("id"), "at", "text_id")
    sets = lines.groupBy("line").agg(F.min(place).alias("first"), F.count("*").alias("copies")).join(match, "line", "left")
    more = [F.coalesce("n", F.lit(0)).cast("long").alias("n_links")] if every_link else []
    has_link = F.col("n").isNotNull() if every_link else F.col("match").isNotNull()
    losing = sets.where((F.col("copies") > 1) | has_link).select("line", "first", "match", F.coalesce("class", "line").alias("class"), *more)
    decided = join_account(lines, losing, ["line"], "left").withColumn(
        "match", F.coalesce("match", F.when(F.col("first") != place, F.col("line")))
    )
    link = F.struct("at", "line", "match", "class", *(["n_links"] if every_link else []))
    link = F.when(F.col("match").isNotNull(), link).alias("link")
    own = [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")] if every_link else []
    # Lines that neither go nor have links add nothing.
    of_lines = decided.select("id", "text_id", F.lit(0).cast("long").alias("n_lines"), link, *own).where(F.expr("link IS NOT NULL" + " OR n_links > 0" * every_link))
    n_links = [F.lit(0).cast("long").alias("n_links")] if every_link else []
    of_documents = opened.where(F.col("n_lines").isNotNull()).select("id", "text_id", "n_lines", F.lit(None).cast(of_lines.schema["link"].dataType).alias("link"), *n_links)
    total = [F.sum("n_links").alias("n_links")] if every_link else []
    by_document = of_documents.union(of_lines).groupBy("id", "text_id").agg(F.sum("n_lines").alias("n_lines"), F.sort_array(F.collect_list("link")).alias("links"), *total)
    last = ["n_links"] if every_link else []
    return by_document.select("id", "text_id", "n_lines", F.transform("links", lambda x: x["at"]).alias("removed"), "links", *last)


def deduped(
    documents: DataFrame, join: Join = Join(), id_column: str = "doc_id", text_column: str = "text", least_left: float = 0.0
) -> DataFrame:
    """``documents`` without the lines that ``removed_lines`` names; rows whose text had words and loses all of its lines go, and rows that keep
    less than ``least_left`` of their characters: what is left of a copy with few edited lines is scraps.
    All columns and all other rows stay, also null texts and repeated rows."""
    gone = removed_lines(documents, join, id_column, text_column).where(F.size("removed") > 0)
    gone = gone.select(F.col("id").alias("_g_id"), F.col("text_id").alias("_g_text"), F.col("removed").alias("_g_removed"), (F.size("removed") == F.col("n_lines")).alias("_g_all"))
    text = F.col(f"`{text_column}`")
    same = F.col(f"`{id_column}`").cast("long").eqNullSafe(F.col("_g_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("_g_text"))
    left = F.array_join(F.filter(F.split(text, "\n", -1), lambda line, i: ~F.array_contains(F.col("_g_removed"), i.cast("long"))), "\n")
    scraps = F.col("_g_removed").isNotNull() & (F.length(left) < least_left * F.length(text))
    joined = documents.join(gone, same, "left").where(~F.coalesce("_g_all", F.lit(False)) & ~F.coalesce(scraps, F.lit(False)))
    return joined.withColumn(text_column, F.when(F.col("_g_removed").isNull(), text).otherwise(left)).select(documents.columns)
