"""Quality rules, line first: every line is judged by itself, lines that fail are removed,
and a document that loses too much of its text is rejected."""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from swipeledger.llm.common import CONTINUATION, bytes_of

# How a line of prose ends, and phrases of page furniture.
ENDINGS = (".", "!", "?", "…", '"', "'", "”", "’", "»", ")", "]", ":", ";", "。")
PHRASES = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service",
    "released under the", "licensed under", "javascript", "lorem ipsum", "click here", "read more",
    "sign up", "log in", "subscribe to", "share this", "skip to content", "back to top",
)
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"


@dataclass(frozen=True)
class LineRules:
    """``symbol_share``: a line fails with more symbols than this per word. ``separators``: a line
    with as many ``|`` or ``>`` standing alone is navigation. ``shout_share``: the share of words
    ending in ``!!``. ``repeat_words``, ``distinct_share``: a line with as many words and a lower
    share of distinct ones is filler. ``keep_share``: the share of word characters that must
    be left for a document to be kept."""

    symbol_share: float = 0.1
    separators: int = 2
    shout_share: float = 0.3
    capitals: int = 10
    repeat_words: int = 10
    distinct_share: float = 0.3
    keep_share: float = 0.7


_ENDINGS = tuple(e.encode() for e in ENDINGS)
_PHRASE = re.compile("|".join(map(re.escape, PHRASES)).encode())
_SMALL, _CAPITAL = bytes(range(97, 123)), bytes(range(65, 91))


def line_fails(line: bytes, words: list[bytes], rules: LineRules) -> bool:
    n = len(words)
    if not words[-1].endswith(_ENDINGS):
        return True
    if len(line) - len(line.translate(None, SYMBOLS)) > rules.symbol_share * n:
        return True
    if words.count(b"|") + words.count(b">") >= rules.separators:
        return True
    if line.count(b"!!") > rules.shout_share * n:
        return True
    if len(line.translate(None, _SMALL)) == len(line) and len(line) - len(line.translate(None, _CAPITAL)) >= rules.capitals:
        return True
    if n >= rules.repeat_words and len(set(words)) < rules.distinct_share * n:
        return True
    return _PHRASE.search(line.lower()) is not None


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a three-word window that the text has twice or more."""
    if len(words) < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    pair = ids[:-1] * len(index) + ids[1:]
    if len(index) >= 2**20:
        pair = np.unique(pair, return_inverse=True)[1]
    _, which, times = np.unique(pair[:-1] * len(index) + ids[2:], return_inverse=True, return_counts=True)
    again = times[which] > 1
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[shift : shift + len(again)] |= again
    return int(inside.sum())


def judged(text: bytes, rules: LineRules) -> tuple:
    """(cleaned text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines with a word,
    lines removed, word characters left)."""
    words = text.split()
    seen: set[bytes] = set()
    kept, dups, n_lines, removed, left = [], 0, 0, 0, 0
    for line in text.split(b"\n"):
        in_line = line.split()
        if not in_line:
            kept.append(line)
            continue
        n_lines += 1
        again = line in seen
        dups += again
        seen.add(line)
        if again or line_fails(line, in_line, rules):
            removed += 1
        else:
            kept.append(line)
            left += len(line.translate(None, CONTINUATION + SPACES))
    return (
        b"\n".join(kept), len(words), len(text.translate(None, CONTINUATION + SPACES)),
        len(text) - len(text.translate(None, SYMBOLS)), dups, repeated_words(words), n_lines, removed, left,
    )


COLUMNS = (
    "cleaned_text string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " n_lines long, n_removed_lines long, chars_left long, base_failed boolean, kept boolean"
)


def quality(documents: DataFrame, rules: LineRules = LineRules(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``documents``: the id, the text without the lines that fail, the counts
    over the whole text, and the verdict ``kept``. One pass over the rows, no shuffle.

    A line fails if it does not end as prose does, if it is navigation, symbols, shouting, filler
    or boilerplate, or if it repeats an earlier line of its document. Lines without a word
    stay and count for nothing.

    Null text counts as empty; a text without words fails the base rules (fewer than 50
    words). Null ids and repeated rows are judged like any other. Columns of the input other
    than the id and the text are left out, so none can clash."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judged(t, rules) for t in bytes_of(batch.column(1))]
            cols = list(zip(*found)) or [()] * 9
            n_words, chars, repeats, left = (np.array(cols[i], np.int64) for i in (1, 2, 5, 8))
            failed = (n_words < 50) | (100 * repeats > 50 * n_words)
            kept = ~failed & (100 * left >= round(100 * rules.keep_share) * chars)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.binary()).cast(pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:]), pa.array(failed), pa.array(kept)],
                names=names,
            )

    chosen = documents.select(id_column, text_column)
    names = [id_column, *(c.split()[0] for c in COLUMNS.split(", "))]
    return chosen.mapInArrow(judge, f"`{id_column}` {chosen.dtypes[0][1]}, {COLUMNS}")
