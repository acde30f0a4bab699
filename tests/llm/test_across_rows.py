"""Operators that compare or balance rows: fingerprints, near copies, lines, n-grams, mixing, and the pipeline."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from awkward import TEXTS, awkward, documents, prose
from pyspark.sql import functions as F

import corpus_pipeline
from swipeledger.llm import brown, edit_fingerprint, graph, line_dedup, mixing, weighted_minhash


def test_fingerprints(spark):
    df = documents(spark, *TEXTS, *[prose(i, 200) for i in range(100, 140)])
    out = {r.doc_id: r for r in edit_fingerprint.fingerprinted(df.repartition(4)).collect()}
    texts = [r.text or "" for r in df.orderBy("doc_id").collect()]
    for i, text in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        r = out[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert [r.fingerprint, r.edited_fingerprint] == edit_fingerprint.fingerprints([text, changed])
        assert r.near_edited == edit_fingerprint.likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == edit_fingerprint.likeness(r.fingerprint, out[(i + 1) % len(texts)].fingerprint)
        if len(text) > 300 and text != following:
            assert r.near_edited > 0.6 > r.near_next or len(set(text)) < 3
    rows = edit_fingerprint.fingerprinted(awkward(spark))
    assert rows.count() == awkward(spark).count()
    assert edit_fingerprint.fingerprinted(df.limit(0)).count() == 0
    one = edit_fingerprint.fingerprinted(documents(spark, "a single document")).first()
    assert one.near_next == 1.0


def walk(text: str) -> list[int]:
    coins, out, p, step = edit_fingerprint._coins(), [], 0, 0
    symbols = edit_fingerprint._symbols(text)
    while p < len(symbols):
        out.append(int(symbols[p]))
        p += int(coins[step % edit_fingerprint.PERIOD][symbols[p]])
        step += 1
    return out


def test_fingerprint_is_a_sample_of_the_plain_walk():
    texts = [prose(i, n) for i, n in enumerate([1, 2, 30, 200, 900, *[40] * 50])]
    hexes = [edit_fingerprint._HEX[n] for n in (edit_fingerprint.mixed(np.arange(256, dtype=np.uint64)) >> np.uint64(20) & np.uint64(15)).astype(int)]
    for text, found in zip(texts, edit_fingerprint.fingerprints(texts)):
        level, digits = found.split(".")
        assert digits == "".join(chr(hexes[s]) for s in walk(text)[:: 1 << int(level)])


def test_edits_stay_near_and_others_do_not(spark):
    base = prose(5, 400)
    choose = random.Random(4)
    copies = [base]
    for _ in range(8):
        text = list(base)
        for _ in range(2):
            text[choose.randrange(len(text))] = choose.choice(["x", "yz"])
        copies.append("".join(text))
    df = documents(spark, *copies, *[prose(i, 400) for i in range(50, 60)], None)
    found = {r.doc_id: r.class_id for r in edit_fingerprint.near_classes(edit_fingerprint.fingerprinted(df), near=0.6).collect()}
    # A walk may take long to meet again after an edit, so not every copy is near.
    assert sum(found[i] == 0 for i in range(9)) >= 6 and all(found[i] == i for i in range(9, 20))


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (10, 11), (11, 12), (7, 7), (20, 21)] + [(30, i) for i in range(31, 60)], "a int, b int")
    found = {r.node: r.component for r in graph.components(links).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 1, 10: 10, 11: 10, 12: 10, 20: 20, 21: 20} | {i: 30 for i in range(30, 60)}
    assert graph.components(links.limit(0)).count() == 0


def near_copies():
    choose, texts = random.Random(9), []
    for k in range(12):
        base = prose(1000 + k, 150).split(" ")
        for _ in range(6):
            text = list(base)
            for _ in range(choose.randint(0, 4)):
                text[choose.randrange(len(text))] = f"edit{choose.randrange(99)}"
            texts.append(" ".join(text))
    return texts + [prose(i, 50) for i in range(30)] + ["", None, "tiny", "tiny", "two words"]


def test_near_classes_by_brute_force(spark):
    texts = near_copies()
    near = weighted_minhash.Near(common=0.5)
    out = {r.id: r.class_id for r in weighted_minhash.classes(documents(spark, *texts), near).collect()}
    number = weighted_minhash.WordHashes()
    sets = [weighted_minhash.shingles((t or "").encode(), 5, number) for t in texts]
    sets = [(n, w.astype(np.float32)) for n, w in sets]
    of = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i][0]) and weighted_minhash.similarity(sets[i], sets[j]) >= 0.8:
                a, b = of[i], of[j]
                of = [min(a, b) if c in (a, b) else c for c in of]
    assert out == dict(enumerate(of))


def classes_by_hand(texts, near):
    """Of distinct texts' shingles, how many texts have them; weighted Jaccard of all pairs; the lowest place of each class."""
    number = weighted_minhash.WordHashes()
    found = {t: weighted_minhash.shingles(t.encode(), near.words, number) for t in texts}
    n = Counter(name for names, _ in found.values() for name in names.tolist())
    share = {name: k / len(found) for name, k in n.items() if k > 1 and k / len(found) > near.common}
    idf = {name: math.log(1 / s + 0.01) / math.log(1 / near.common) for name, s in share.items()}
    sets = {t: {name: k * idf.get(name, 1) for name, k in zip(names.tolist(), times.tolist())} for t, (names, times) in found.items()}
    of, distinct = {t: texts.index(t) for t in sets}, list(sets)
    for i, x in enumerate(distinct):
        for y in distinct[:i]:
            both = sum(min(w, sets[y][s]) for s, w in sets[x].items() if s in sets[y])
            if both and both / (sum(sets[x].values()) + sum(sets[y].values()) - both) >= near.similarity:
                a, b = sorted((of[x], of[y]))
                of = {t: a if c == b else c for t, c in of.items()}
    return [of[t] for t in texts]


def test_a_group_of_edited_copies_is_one_class_whatever_its_share(spark):
    """A third of the texts are copies of one with another line each, two of which have a plain Jaccard similarity over 0.8."""
    base = prose(1, 400, 20).split("\n")
    copies = ["\n".join([*base[: i % 20], prose(5000 + i, 20, 20), *base[i % 20 + 1 :]]) for i in range(80)]
    others = [prose(9000 + i, 120) for i in range(160)]
    found = weighted_minhash.classes(documents(spark, "\n".join(base), *copies, *others)).collect()
    assert {r.class_id for r in found if r.id <= 80} == {0}
    assert all(r.class_id == r.id for r in found if r.id > 80)


def test_near_classes_with_a_third_of_copies_by_brute_force(spark):
    hot = prose(700, 104).split(" ")
    near = hot.copy()
    near[50] = "edited"
    further = hot.copy()
    further[30] = further[70] = "edited"
    footer = prose(701, 30)
    texts = [" ".join(hot)] * 130 + [" ".join(near), " ".join(further)] + [prose(2000 + i, 60) + (" " + footer if i < 20 else "") for i in range(250)]
    out = {r.id: r.class_id for r in weighted_minhash.classes(documents(spark, *texts).repartition(40)).collect()}
    assert out == dict(enumerate(classes_by_hand(texts, weighted_minhash.Near()))) and out[130] == out[131] == 0


def test_common_shingles_do_not_depend_on_partitions(spark):
    footer = prose(702, 12, 99)
    texts = [prose(3000 + i, 30) + (" " + footer if i % 50 == 0 else "") for i in range(200)]
    df = documents(spark, *texts).withColumn("text_id", weighted_minhash.text_id(F.col("text")))
    found = [weighted_minhash.common_shingles(df.repartitionByRange(n, "doc_id"), weighted_minhash.Near()) for n in (1, 60)]
    assert found[0] == found[1] and len(found[0]) == 8


def test_samples_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(0)
    names = rng.integers(1, 2**63, 300).astype(np.uint64)
    a, b = rng.uniform(0.2, 4, 300).astype(np.float32), None
    b = np.where(rng.random(300) < 0.7, a, rng.uniform(0.2, 4, 300)).astype(np.float32)
    drawn = [weighted_minhash.samples(names, w, np.array([0, 300]), 2000) for w in (a, b)]
    alike = (drawn[0] == drawn[1]).mean()
    assert abs(alike - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def test_links_between_blocks_by_brute_force(spark, monkeypatch):
    texts = near_copies()[:72]
    df = documents(spark, *texts).withColumn("text_id", weighted_minhash.text_id(F.col("text"))).dropDuplicates(["text_id"]).select("text_id", "text")
    sides = df.select(F.lit(1).cast("long").alias("key"), "text_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    monkeypatch.setattr(weighted_minhash, "BLOCK", 10)
    found = {(bytes(r.a), bytes(r.b)) for r in weighted_minhash._links_between(sides, df, weighted_minhash.Near(), {}).collect()}
    number = weighted_minhash.WordHashes()
    sets = {bytes(r.text_id): weighted_minhash.shingles(r.text.encode(), 5, number) for r in df.collect()}
    assert found == {(x, y) for x in sets for y in sets if x > y and weighted_minhash.similarity(sets[x], sets[y]) >= 0.8}


def test_near_dedup_of_awkward_rows(spark):
    df = awkward(spark)
    out = weighted_minhash.deduped(df)
    assert out.columns == df.columns
    texts = [r.text for r in out.collect()]
    assert sum(t == TEXTS[5] for t in texts) == 1 and sum(not (t or "").strip(" \n\t") for t in texts) == 3
    assert weighted_minhash.deduped(df.limit(0)).count() == 0


def test_near_dedup_keeps_a_row_of_each_class_whatever_the_ids(spark):
    text = [prose(300 + i, 60) for i in range(8)]
    # Null ids, an id with two texts, and ids shared with rows without words (whose hashes may be lower).
    rows = [(None, text[0]), (None, text[1]), (None, text[1]), (None, ""), (9, text[2]), (9, text[3]), (10, text[3])]
    rows += [(i, t) for i, t in enumerate(text[4:], 20)] + [(i, " " * (1 + k)) for i in range(20, 24) for k in range(6)]
    out = [tuple(r) for r in weighted_minhash.deduped(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    kept = {(None, text[0]), (None, text[1]), (9, text[2]), (9, text[3]), *enumerate(text[4:], 20)}
    assert sorted(map(str, out)) == sorted(map(str, [*kept, *(r for r in rows if not r[1].strip())]))


@pytest.mark.parametrize(("first", "ranked"), [(4, 40), (1, 10_000)])
def test_lines_by_brute_force(spark, first, ranked):
    choose = random.Random(first)
    words = [f"w{i}" for i in range(200)]
    base = [[choose.choice(words) for _ in range(choose.choice([1, 3, 8, 20, 30]))] for _ in range(25)]
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(choose.randint(0, 6)):
            line = list(choose.choice(base))
            for _ in range(choose.choice([0, 0, 1, 2, 3])):
                line[choose.randrange(len(line))] = choose.choice(words)
            lines.append(" ".join(line))
        texts.append("\n".join(lines))
    out = line_dedup.removed_lines(documents(spark, *texts, None).repartition(3), line_dedup.Join(first=first, ranked=ranked, bucket=300))
    found = {r.id: list(r.removed) for r in out.collect()}
    earlier, expected = [], {}
    for i, text in enumerate([*texts, ""]):
        expected[i] = []
        for k, line in enumerate(text.split("\n")):
            own = set(line.split())
            if own:
                if any(len(own & x) >= 0.8 * len(own | x) - 1e-9 for x in earlier):
                    expected[i].append(k)
                earlier.append(own)
    assert found == expected


@pytest.mark.parametrize(("first", "block"), [(1, 7), (4, 20_000)])
def test_classes_of_lines_by_brute_force(spark, first, block):
    """Groups of lines that are all similar, chains of similar lines, and lines that share much less."""
    choose = random.Random(first)
    texts = []
    for g in range(6):
        base = [f"w{g}x{k}" for k in range(12)]
        group = [base[:k] + base[k + 1 :] for k in range(12)] + [base, [*base, "more"], [*base[:10], "even"]]
        chain = [[f"c{g}x{k}" for k in range(s, s + 18)] for s in range(0, 20)]
        texts += [" ".join(x) for x in group + chain]
    texts += [" ".join(choose.choice("abcdefgh") * 3 for _ in range(9)) for _ in range(60)]
    choose.shuffle(texts)
    out = line_dedup.removed_lines(documents(spark, *texts).repartition(3), line_dedup.Join(first=first, ranked=40, bucket=300, block=block))
    sets = [frozenset(t.split()) for t in texts]

    def similar(a, b):
        return len(a & b) >= 0.8 * len(a | b) - 1e-9

    of = {}
    for x in dict.fromkeys(sets):
        joined = {c for y, c in of.items() if similar(x, y)}
        of[x] = x
        for y, c in of.items():
            if c in joined:
                of[y] = x
    found = {r.id: r.links[0] for r in out.collect() if r.links}
    assert set(found) == {i for i, x in enumerate(sets) if any(similar(x, y) for y in sets[:i])}
    names = {}
    for i, link in found.items():
        names.setdefault(of[sets[i]], set()).add(link["class"])
    assert all(len(n) == 1 for n in names.values())
    assert len({next(iter(n)) for n in names.values()}) == len(names)


def test_near_copies_leave_no_scraps(spark):
    """Groups of copies with one edited line each, beside other texts."""
    choose = random.Random(9)
    texts, group = [prose(500 + i, 200) for i in range(40)], [None] * 40
    for g, size in enumerate((3, 20, 40)):
        lines = prose(900 + g, 240).split("\n")
        for k in range(size):
            at = choose.randrange(1, len(lines))
            texts.append("\n".join([*lines[:at], prose(7000 + 100 * g + k, 12), *lines[at + 1 :]]))
            group.append(g)
    docs = documents(spark, *texts)
    kept = corpus_pipeline.drop_near_copies(spark, corpus_pipeline.drop_repeated_lines(spark, docs, ""), "")
    left = Counter(group[r.doc_id] for r in kept.select("doc_id").collect())
    assert left == {None: 40, 0: 1, 1: 1, 2: 1}


def test_a_text_with_very_many_lines(spark):
    text = "\n".join(["a"] * (2**20 + 5) + ["b c"])
    out = line_dedup.removed_lines(documents(spark, text, "b c\na b")).collect()
    assert {r.id: (r.n_lines, len(r.removed)) for r in out} == {0: (2**20 + 6, 2**20 + 4), 1: (2, 1)}


@pytest.mark.parametrize("block", [20_000, 7])
def test_every_link_of_similar_lines_is_counted(spark, block):
    words = [f"word{i}" for i in range(20)]
    # Each without another word: 18 of 20 words shared, so all are similar to all.
    texts = ["\n".join(" ".join(words[:i] + words[i + 1 :]) for i in range(k, 20, 2)) + f"\nalone{k}" for k in (0, 1)]
    found = line_dedup.removed_lines(documents(spark, *texts), line_dedup.Join(first=2, block=block), every_link=True).collect()
    assert sum(r.n_links for r in found) == 20 * 19
    links = [x for r in found for x in r.links]
    assert len(links) == 19 and {x.n_links for x in links} == {19} and len({x["class"] for x in links}) == 1


@pytest.mark.parametrize(("first", "block", "ranked"), [(1, 7, 40), (4, 20_000, 10_000)])
def test_links_by_brute_force(spark, first, block, ranked):
    """Lines that share several rare words are linked once, whichever lists they meet in."""
    choose = random.Random(first)
    base = [[f"w{choose.randrange(80)}" for _ in range(choose.choice([2, 6, 12, 25]))] for _ in range(12)]
    texts = ["\n".join(" ".join([*line[: -choose.randint(1, 2)], *choose.choice([[], ["x"], [f"y{choose.randrange(9)}"]])]) for line in choose.choices(base, k=5)) for _ in range(60)]
    out = line_dedup.removed_lines(documents(spark, *texts).repartition(3), line_dedup.Join(first=first, ranked=ranked, bucket=300, block=block), every_link=True)
    sets = [[frozenset(line.split()) for line in t.split("\n") if line.split()] for t in texts]
    different = {x for t in sets for x in t}
    links = {x: sum(x != y and len(x & y) >= 0.8 * len(x | y) - 1e-9 for y in different) for x in different}
    assert sum(links.values()) > 100
    assert {r.id: r.n_links for r in out.collect()} == {i: sum(links[x] for x in t) for i, t in enumerate(sets)}


def test_a_group_of_similar_lines_gives_rows_for_lines_and_not_for_pairs(spark):
    records = np.zeros(60, line_dedup.RECORD)
    words = [np.array([5, *range(100, 120), 1000 + i]) for i in range(60)]
    records["word"], records["line"], records["doc"], records["size"] = 5, np.arange(60) + 7, np.arange(60), 22
    line, n, match, link = line_dedup.links_in(records, words, 0, 0.8)
    assert line.tolist() == list(range(7, 67)) and set(n.tolist()) == {59} and set(match.tolist()) == {7} and set(link.tolist()) == {7}
    pairs = line_dedup.pairs_of(records, line_dedup.Join(), 4)
    assert len(pairs) == 60 and pairs.column("later").null_count == 60


def index_of(sets, chosen=None):
    """The prefix index of these sets of numbers, each a line named by its place."""
    sizes = [len(x) for x in sets]
    words = np.concatenate([np.sort(np.array(list(x), np.int64)) for x in sets])
    lines = line_dedup.Lines(np.arange(len(sets)), np.zeros(len(sets), np.int64), words, np.cumsum([0, *sizes]))
    chosen = np.ones(len(sets), bool) if chosen is None else chosen
    return line_dedup.prefix_records(lines, np.arange(len(sets)), chosen, ~chosen, 0.8)


def sets_with_groups(choose, n, size):
    sets = []
    for _ in range(n // 3):
        base = choose.sample(range(400), size)
        sets += [frozenset(base), frozenset([*base[1:], *[500 + choose.randrange(9)] * (size > 9)]), frozenset(choose.sample(range(400), size))]
    return list(dict.fromkeys(sets))


@pytest.mark.parametrize(("size", "looked"), [(6, 4000), (20, 4000), (150, 4000), (20, 5)])
def test_the_index_loses_no_similar_pair(monkeypatch, size, looked):
    monkeypatch.setattr(line_dedup, "LOOKED", looked)
    sets = sets_with_groups(random.Random(size), 150, size)
    similar = {(i, j) for j, x in enumerate(sets) for i in range(j) if len(x & sets[i]) >= 0.8 * len(x | sets[i]) - 1e-9}
    assert similar
    one, other, word, lists, copied = line_dedup.likely_pairs(index_of(sets), 0.8, 1)
    assert not len(copied)
    met = {(min(p), max(p), w) for *p, w in zip(one.tolist(), other.tolist(), word.tolist())}
    listed = set(zip(lists["line"].tolist(), lists["word"].tolist()))
    for i, j in similar:
        first = min(sets[i] & sets[j])
        assert (i, j, first) in met or {(i, first), (j, first)} <= listed


def test_only_records_that_may_match_go_through_a_long_list_again(monkeypatch):
    """Most of a frequent word's list has nothing to do with the group that makes it long."""
    choose = random.Random(3)
    group = [frozenset([1, *range(10, 40), 900 + i]) for i in range(10)]
    others = [frozenset([1, *choose.sample(range(1000, 9000), 31)]) for _ in range(200)]
    records = np.zeros(210, line_dedup.RECORD)
    index = index_of(group + others)
    index = index[index["word"] == 1]
    for column in ("word", "line", "size", "pos", "bits"):
        records[column] = index[column]
    found = line_dedup.pairs_of(records, line_dedup.Join(), 4)
    assert sorted(found.column("earlier").drop_null().to_pylist()) == list(range(10))
    monkeypatch.setattr(line_dedup, "LOOKED", 100)
    found = line_dedup.pairs_of(records, line_dedup.Join(), 4)
    assert sorted(found.column("earlier").drop_null().to_pylist()) == list(range(210))


def test_a_record_of_the_index_is_sent_in_forty_bytes_and_those_that_are_zero_together():
    records = index_of(sets_with_groups(random.Random(1), 300, 30))
    data = line_dedup.planes(records)
    assert len(data) == 40 * len(records) and b"\0" * (3 * len(records)) in data
    parts = [line_dedup.planes(x) for x in (records[:7], records[7:])]
    assert line_dedup.rows_of(parts, records.dtype).tobytes() == records.tobytes()
    assert len(line_dedup.rows_of([], records.dtype)) == 0


def test_copies_are_told_by_their_rarest_word():
    sets = sets_with_groups(random.Random(2), 30, 12)
    again = np.arange(len(sets)) % 4 > 0
    index = index_of(sets)
    second = index_of(sets, ~again)
    second = second[again[second["line"]]]
    assert (second["pos"] == 0).all() and second["line"].tolist() == np.flatnonzero(again).tolist()
    assert line_dedup.likely_pairs(np.concatenate([index, second]), 0.8, 4)[4].tolist() == np.flatnonzero(again).tolist()
    assert not len(line_dedup.likely_pairs(index, 0.8, 4)[4])


@pytest.mark.parametrize("inner", [0, 30])
def test_lists_in_blocks_of_any_size(monkeypatch, inner):
    sets = [x | {-1} for x in sets_with_groups(random.Random(5), 90, 10)]
    sets += [x - {min(x - {-1})} | {700} for x in sets]
    words = [np.sort(np.array(list(x), np.int64)) for x in sets]
    index = index_of(sets)
    index = index[index["word"] == -1]
    records = np.zeros(len(sets), line_dedup.RECORD)
    for column in index.dtype.names:
        records[column] = index[column]
    records["doc"] = np.random.default_rng(1).permutation(len(sets))
    whole = [x.tolist() for x in line_dedup.links_in(records, words, inner, 0.8)]
    n = [sum(j != i and (not inner or (i < inner) != (j < inner)) and len(x & y) >= 0.8 * len(x | y) - 1e-9 for j, y in enumerate(sets)) for i, x in enumerate(sets)]
    assert dict(zip(*whole[:2])) == {i: k for i, k in enumerate(n) if k} and sum(n) > 50
    for name, value in (("PAIRS", 3), ("MARKS", 1), ("WORDS", 15), ("HELD", 2)):
        monkeypatch.setattr(line_dedup, name, value)
    assert [x.tolist() for x in line_dedup.links_in(records, words, inner, 0.8)] == whole


def test_line_dedup_of_null_ids_and_bare_texts(spark):
    words = [f"word{i}" for i in range(12)]
    rows = [(None, "x y\n\n" + " ".join(words[1:])), (7, " ".join(words)), (7, " ".join(words)), (None, " ".join(words[:-1])), (2, " \t\n"), (2, None), (None, ""), (None, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = line_dedup.removed_lines(df, every_link=True).collect()
    got = sorted((r.id if r.id is not None else 99, r.n_lines, list(r.removed), r.n_links) for r in out)
    # Null ids come last; of copies in the same place of two texts without an id, one goes.
    copy, whole = got[4][2], got[6][2]
    assert got == [(2, 0, [], 0), (2, 0, [], 0), (7, 1, [], 2), (99, 0, [], 0), (99, 1, copy, 0), (99, 1, [0], 2), (99, 2, whole, 2)]
    assert (copy, whole) in (([0], [2]), ([], [0, 2]))


def test_line_dedup_of_awkward_rows(spark):
    df = awkward(spark)
    out = line_dedup.deduped(df)
    assert out.columns == df.columns
    texts = [r.text for r in out.orderBy("doc_id").collect()]
    assert "same line.\nother line." in texts and None in texts and "" in texts and texts.count(TEXTS[5]) == 2
    assert line_dedup.deduped(df.limit(0)).count() == 0


def test_class_ngrams(spark):
    texts = [*TEXTS, *[prose(i % 7, 90) for i in range(60)]]
    df = documents(spark, *texts)
    trained = df.where(brown.trained_on(F.col("doc_id")))
    model = brown.train(trained, brown.Size(frequent=30, endings=10, classes=8, local=50))
    out = {r.doc_id: r for r in brown.score(df, model).collect()}
    tokens = [[*(t or "").lower().encode().split(), None] for t in texts]
    seen = Counter(w for i, ws in enumerate(tokens) for w in ws if zlib.crc32(str(i).encode()) % 10)
    n, v = sum(seen.values()), len(seen)
    assert model.n == n and model.v == v
    for i, words in enumerate(tokens):
        assert (out[i].n_tokens, out[i].n_known) == (len(words), sum(seen[w] > 0 for w in words))
        assert math.isclose(out[i].base_score, sum(math.log10((seen[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words))
    held = [i for i in range(12, 72) if not zlib.crc32(str(i).encode()) % 10]
    assert sum(out[i].score for i in held) > sum(out[i].base_score for i in held)
    assert brown.score(awkward(spark), model).count() == awkward(spark).count()
    empty = brown.train(df.limit(0))
    assert brown.score(df, empty).count() == df.count()


def test_words_that_are_not_frequent_have_classes_by_their_places(spark):
    """Two kinds of words of one ending, none frequent, of which training has each in the places of other, frequent words."""
    choose = random.Random(4)
    kinds = [[*often, *(f"{often[0]}{i}abc" for i in range(50))] for often in (["man"] * 20 + ["car"] * 20, ["go"] * 20 + ["sit"] * 20)]
    texts = [" ".join(f"the {choose.choice(kinds[0])} to {choose.choice(kinds[1])}" for _ in range(8)) for _ in range(120)]
    model = brown.train(documents(spark, *texts).repartition(3), brown.Size(frequent=6, endings=1, classes=6, local=10))
    as_trained = ["the man7abc to go9abc the man30abc to go4abc", "the go9abc to man7abc the go4abc to man30abc"]
    right, wrong = (r.score for r in brown.score(documents(spark, *as_trained), model).orderBy("doc_id").collect())
    assert right > wrong + 3


def test_exchange_never_lowers_the_likelihood():
    rng = np.random.default_rng(1)
    pairs = rng.poisson(0.3, (40, 40)) + np.kron(np.eye(4), rng.poisson(3, (10, 10)))

    def likelihood(of):
        member = np.eye(of.max() + 1)[of]
        joint = member.T @ pairs @ member
        return brown._xlogx(joint).sum() - brown._xlogx(joint.sum(0)).sum() - brown._xlogx(joint.sum(1)).sum()

    scores = [likelihood(brown.exchange(pairs, 6, sweeps)) for sweeps in range(5)]
    assert scores == sorted(scores) and scores[-1] > scores[0]


def mixed_by_hand(sizes):
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    target, open_, rest = {}, set(sizes), sum(sizes.values())
    while True:
        level = rest / sum(weights[s] for s in open_) if open_ else 0
        full = {s for s in open_ if weights[s] * level > 3 * sizes[s]}
        if not full:
            return target | {s: weights[s] * level for s in open_}
        for s in full:
            target[s] = 3 * sizes[s]
            rest -= target[s]
        open_ -= full


def test_mix(spark):
    choose = random.Random(2)
    rows = [(i, " ".join("w" * 1 for _ in range(choose.randint(0, 300))), choose.choice(["a", "b", "b", "b", "c", None])) for i in range(900)]
    rows += [(5000 + i, "tiny text", "d") for i in range(3)] + [(1, None, "e"), (2, "", "e")] + [(7, "same row here", "b")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("share", F.lit("x"))
    out = mixing.mixed_sizes(df.repartition(3)).collect()
    assert len(out) == len(rows)
    size, source = Counter(), {}
    for i, text, s in rows:
        size[s] += len((text or "").split())
    targets = mixed_by_hand(dict(size))
    assert all(0 <= r.taken <= 3 * r.size for r in out)
    taken, aimed = Counter(), {}
    for r in out:
        taken[r.target] += r.taken
    for s, t in targets.items():
        got = [k for k in taken if math.isclose(k, t, rel_tol=1e-9, abs_tol=1e-9)]
        alike = sum(math.isclose(x, t, rel_tol=1e-9, abs_tol=1e-9) for x in targets.values())
        assert got and abs(taken[got[0]] - alike * t) <= max(5, 0.02 * t)
    assert sorted(map(str, out)) == sorted(map(str, mixing.mixed_sizes(df.repartition(5)).collect()))
    copies = mixing.mixed(df)
    assert copies.columns == df.columns
    words = copies.agg(F.sum(F.size(F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda w: w != "")))).first()[0]
    assert abs(words - sum(targets.values())) <= 0.01 * words
    assert mixing.mixed_sizes(df.limit(0)).count() == 0 and mixing.mixed(df.limit(0)).count() == 0


def test_pivot_keeps_expectations():
    share, size = [0.2, 0.5, 0.7, 0.9, 0.35], [10, 20, 15, 40, 30]
    rng = np.random.default_rng(3)
    total = np.zeros(5)
    for _ in range(8000):
        out, held = mixing.pivot(share, size, rng.random(5).tolist())
        assert math.isclose(sum(p * n for p, n in zip(out, size)), sum(p * n for p, n in zip(share, size)))
        assert all(p in (0, 1) or i == held for i, p in enumerate(out))
        total += out
    assert np.allclose(total / 8000, share, atol=0.025)


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    before = docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "source mix", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf))
        assert docs.columns == before.columns
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.where("piece = 0").count() == docs.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    assert packed.agg(F.countDistinct("sequence_id")).first()[0] <= packed.agg(F.ceil(F.sum("length") / 2048)).first()[0] + 2
