"""Packing of tokenised documents into sequences: best fit, then a local search that swaps."""

import json
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeledger.llm.common import give_back, stored

#: Fixed value: how the byte-level vocabulary cuts a text before its merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_ID = 0
#: How many words and their ids a task remembers.
REMEMBERED = 400_000
PIECES = "piece int, start long, length long, ids_crc32 long, salt long"


def vocabulary(path: str) -> dict[bytes, int]:
    """The tokens of a byte-level vocabulary file as bytes. In the file, bytes that do not
    print stand as the characters from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(prints)]
    byte_of = {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}
    with open(path, encoding="utf-8") as file:
        entries = json.load(file)["model"]["vocab"]
    return {bytes(byte_of[c] for c in token): i for token, i in entries.items() if all(c in byte_of for c in token)}


def added_tokens(path: str) -> dict[str, int]:
    """The tokens that the file adds to its vocabulary, whose names stand for their ids wherever they come in a text."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens") or []
    if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that depend on what is around them")
    return {t["content"]: t["id"] for t in added}


def encoder(path: str, remembered: int = REMEMBERED, added: bool = False) -> Callable[[str], list[bytes]]:
    """A function from a text to its ids, as runs of little-endian 32-bit numbers. A single space before
    something that is no white space always begins a new token, so the parts between such spaces are
    encoded one by one and remembered, ``remembered`` at most. With ``added``, names of added tokens in a text are those
    tokens, as for ``tokenizers``, and what is between them is encoded by itself; else they are plain text."""
    ranks = vocabulary(path)
    special = next((t for t, i in ranks.items() if t == b"<|endoftext|>"), None)
    if special is not None:
        del ranks[special]
    encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    other_spaces = re.compile(r" (?:\s|\Z)")
    known: dict[str, bytes] = {}
    packed = lambda text: np.array(encode(text), "<u4").tobytes()

    def encoded(text: str) -> list[bytes]:
        if other_spaces.search(text):
            return [packed(text)]
        if len(known) > remembered:
            known.clear()
        first, *rest = text.split(" ")
        found = [packed(first)]
        add, get = found.append, known.get
        for word in rest:
            ids = get(word)
            if ids is None:
                ids = known[word] = packed(" " + word)
            add(ids)
        return found

    ids_of = {name: np.array([i], "<u4").tobytes() for name, i in added_tokens(path).items()} if added else {}
    if not ids_of:
        return encoded
    names = re.compile("(" + "|".join(re.escape(t) for t in sorted(ids_of, key=len, reverse=True)) + ")")

    def encoded_with_added(text: str) -> list[bytes]:
        parts = names.split(text)
        if len(parts) == 1:
            return encoded(text)
        return [ids for k, part in enumerate(parts) for ids in ([ids_of[part]] if k % 2 else encoded(part))]

    return encoded_with_added


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: all of ``size``, but the first may be shorter."""
    first = n % size or size
    return [(0, first), *((at, size) for at in range(first, n, size))]


def tokenised(documents: DataFrame, tokenizer: str, size: int, id_column: str = "doc_id", text_column: str = "text", added: bool = False, remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece of every document: the id, ``piece``, ``start``, ``length``, ``ids_crc32``
    and ``salt``, a number that spreads pieces evenly, also those of repeated rows."""
    chosen = documents.select(id_column, text_column)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        encoded = encoder(tokenizer, remembered, added)
        end, row = np.array([END_ID], "<u4").tobytes(), 0
        for batch in batches:
            taken, found = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = b"".join([*encoded(text or ""), end])
                row += 1
                for k, (start, length) in enumerate(cut(len(ids) // 4, size)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    taken.append(i)
                    found.append((k, start, length, crc, crc << 20 ^ row * 0x9E3779B1))
            ks, starts, lengths, crcs, salts = zip(*found) if found else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(taken, pa.int64())), pa.array(ks, pa.int32()), *(pa.array(x, pa.int64()) for x in (starts, lengths, crcs, salts))],
                names=[id_column, "piece", "start", "length", "ids_crc32", "salt"],
            )

    return chosen.mapInArrow(pieces, f"`{id_column}` {chosen.dtypes[0][1]}, {PIECES}")


def best_fit(lengths: np.ndarray, size: int) -> np.ndarray:
    """The bin of each item: longest first, each into the fullest bin that has room."""
    by_room: list[list[int]] = [[] for _ in range(size + 1)]  # bins by their free tokens
    rooms = 0  # a bit for every amount of free tokens that some bin has
    where = np.zeros(len(lengths), np.int64)
    n_bins = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = rooms >> length
        if fitting:
            room = length + ((fitting & -fitting).bit_length() - 1)
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b, n_bins = size, n_bins, n_bins + 1
        where[i] = b
        left = room - length
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return where


def swapped(lengths: np.ndarray, where: np.ndarray, size: int) -> np.ndarray:
    """Local search over the bins with room: from the emptiest bin on, an item moves to a fuller bin,
    or one or two items are exchanged for one shorter item of a fuller bin. Every step moves tokens
    from an emptier to a fuller bin, so the sum of squared fills grows; it ends when no bin empties."""
    where = where.copy()
    fill = np.bincount(where, weights=lengths).astype(np.int64)
    items = np.flatnonzero(fill[where] < size)
    if not len(items):
        return where
    length, bin_of = lengths[items].astype(np.int64), where[items]
    emptied = True
    while emptied:
        emptied = False
        for b in sorted(np.unique(bin_of).tolist(), key=lambda x: (fill[x], x)):
            moved = True
            while moved and fill[b]:
                moved = False
                mine = np.flatnonzero(bin_of == b)
                # Items of one length are alike, and there are few lengths: their sum is at most ``size``.
                alike: dict[int, list[int]] = {}
                for i in mine:
                    alike.setdefault(int(length[i]), []).append(i)
                singles = [(n, (g[0],)) for n, g in alike.items()]
                pairs = {2 * n: (g[0], g[1]) for n, g in alike.items() if len(g) > 1}
                pairs |= {n + m: (alike[n][0], alike[m][0]) for n, m in combinations(alike, 2)}
                fuller = np.flatnonzero((fill >= fill[b]) & (fill < size))
                fuller = fuller[fuller != b]
                theirs = np.flatnonzero((bin_of != b) & (fill[bin_of] >= fill[b]) & (fill[bin_of] < size))
                for total, group in sorted(singles, reverse=True):
                    rooms = size - fill[fuller]
                    fits = np.flatnonzero(rooms >= total)
                    if len(fits):
                        to = int(fuller[fits[np.argmin(rooms[fits])]])
                        bin_of[list(group)] = to
                        fill[to] += total
                        fill[b] -= total
                        moved = True
                        break
                if moved or not len(theirs):
                    continue
                room = size - fill[bin_of[theirs]]
                for total, group in sorted(singles, reverse=True) + sorted(pairs.items(), reverse=True):
                    gain = total - length[theirs]
                    gain = np.where((gain > 0) & (gain <= room), gain, 0)
                    best = int(np.argmax(gain))
                    if gain[best]:
                        other = theirs[best]
                        to = int(bin_of[other])
                        bin_of[list(group)] = to
                        bin_of[other] = b
                        fill[to] += gain[best]
                        fill[b] -= gain[best]
                        moved = True
                        break
            emptied |= fill[b] == 0
    where[items] = bin_of
    return where


def packed(documents: DataFrame, tokenizer: str, size: int = 2048, block_items: int = 8192, id_column: str = "doc_id", text_column: str = "text", added: bool = False, remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece of every document: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id`` and ``offset``, the place in its sequence. Sequences have at most ``size`` tokens.

    Documents are tokenised where they are read; only the pieces' numbers travel. Pieces are dealt
    into blocks of about ``block_items`` at random, each block is packed by itself (best fit, then swaps),
    and the pieces of all bins that stay under 98 % full are dealt and packed once more together.

    With ``added``, names of the file's added tokens in a text are those tokens, else plain text. A null or empty text is the end mark alone; repeated rows are documents of their own; a text of
    any length is cut, never shortened. Columns beyond the id and the text are left out. An
    empty table gives an empty result."""
    spark = documents.sparkSession
    pieces = stored(tokenised(documents, tokenizer, size, id_column, text_column, added, remembered))
    id_type = pieces.dtypes[0][1]
    schema = f"`{id_column}` {id_type}, {PIECES}, sequence_id long, offset long, fill long"

    def dealt(items: DataFrame, level: int) -> DataFrame:
        blocks = max(1, -(-items.count() // block_items))
        block = F.pmod(F.xxhash64("salt", "piece", F.lit(level)), F.lit(blocks))
        return items.withColumn("block", block).groupBy("block").applyInPandas(pack(level), schema)

    def pack(level: int):
        def pack_block(key, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["length", "salt", "piece"], ascending=[False, True, True], ignore_index=True)
            lengths = rows["length"].to_numpy(np.int64)
            where = swapped(lengths, best_fit(lengths, size), size)
            order = np.argsort(where, kind="stable")
            rows, where, lengths = rows.iloc[order].drop(columns="block"), where[order], lengths[order]
            ends = np.cumsum(lengths)
            first = np.searchsorted(where, where, side="left")
            rows["sequence_id"] = (((level << 38) + int(key[0])) << 24) + where
            rows["offset"] = ends - lengths - (ends[first] - lengths[first])
            rows["fill"] = np.bincount(where, weights=lengths).astype(np.int64)[where]
            return rows

        return pack_block

    first = stored(dealt(pieces, 0))
    full = F.col("fill") >= int(0.98 * size)
    again = dealt(first.where(~full).select(pieces.columns), 1)
    return first.where(full).unionByName(again).select(id_column, "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
