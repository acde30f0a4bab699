"""Operators that judge each row by itself: quality, toxicity, packing's tokens, dialogues, pages."""

import html
import random
import tracemalloc
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tokenizers
from awkward import TEXTS, awkward, documents, prose
from pyspark.sql import functions as F

import corpus_pipeline
from swipeledger.llm import chat, main_text, oracle, packing, quality, toxicity
from swipeledger.llm.common import WordHashes
from swipeledger.llm.queries import QUERIES, TOKENIZER

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(oracle.ORACLE))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    expected = duck.sql(oracle.ORACLE[name]).project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert sorted(map(tuple, df.select(columns).collect()), key=str) == sorted(expected, key=str)


def test_quality_of_awkward_rows(spark):
    df = awkward(spark)
    out = quality.quality(df).collect()
    assert len(out) == df.count()
    by_text = {r.doc_id: r for r in out if r.doc_id not in (5, 9)}
    assert (by_text[0].n_words, by_text[0].kept, by_text[1].word_chars) == (0, False, 0)
    assert (by_text[8].n_dup_lines, by_text[8].cleaned_text) == (1, "same line.\nother line.")
    assert by_text[10].n_words == len(TEXTS[10].encode().split()) == 6
    assert by_text[7].kept and by_text[7].cleaned_text == TEXTS[7]
    assert quality.quality(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "line",
    ["no end", "Home | News | About.", "a## b%% c.", "YES!! NO!! SO!!", "ALL CAPITAL LETTERS.", "go go go go go go go go go go go.", "All Rights Reserved."],
)
def test_lines_that_fail(line):
    assert quality.line_fails(line.encode(), line.encode().split(), quality.LineRules())
    assert not quality.line_fails(b"A plain line, as it is.", b"A plain line, as it is.".split(), quality.LineRules())


def test_repeated_words_by_brute_force():
    choose = random.Random(3)
    for _ in range(200):
        words = [choose.choice([b"a", b"b", b"c"]) for _ in range(choose.randint(0, 14))]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
        assert quality.repeated_words(words) == len(inside)


def labelled(spark, n=240):
    bad = ["zorgle", "frimpish", "zorgled"]
    texts, toxic = [], []
    for i in range(n):
        words = prose(i, 60).split(" ")
        if i % 4 == 0:
            for k in range(3):
                words[5 + 9 * k] = random.Random(i + k).choice(bad)
        texts.append(" ".join(words))
        toxic.append(int(i % 4 == 0))
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    return documents(spark, *texts), labels


def test_toxicity_on_held_out_rows(spark):
    df, labels = labelled(spark)
    model = toxicity.train(df, labels)
    out = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    held = [i for i in out if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(out[i].predicted == int(i % 4 == 0) for i in held)
    text = {r.doc_id: r.text for r in df.collect()}
    assert {text[0][s.start : s.end].strip(".,")[:6] for s in out[0].spans} <= {"zorgle", "frimpi"} and out[0].spans
    assert toxicity.without_toxic(df, model).columns == df.columns
    assert toxicity.without_toxic(df, model).count() == sum(r.predicted == 0 for r in out.values())
    again = toxicity.score(awkward(spark), model).collect()
    assert len(again) == awkward(spark).count() and all(0 <= r.score <= 1 for r in again)
    assert toxicity.score(df.limit(0), model).count() == 0


@pytest.mark.parametrize("toxic", [0, 1, None])
def test_toxicity_without_two_labels(spark, toxic):
    labels = spark.createDataFrame([(i, toxic) for i in range(20)], "doc_id long, toxic int")
    model = toxicity.train(documents(spark, "a b c", None), labels)
    assert {r.score for r in toxicity.score(documents(spark, "a b c", None), model).collect()} == {float(toxic or 0)}


def test_marginals_by_brute_force():
    rng = np.random.default_rng(2)
    emit, move = rng.normal(size=4), rng.normal(size=(2, 2))
    ids = rng.integers(0, 4, (5, 6))
    lengths = np.array([6, 4, 1, 3, 6])
    chance, _ = toxicity.marginals(ids, lengths, emit, move)
    for row, n, got in zip(ids, lengths, chance):
        weight, total = np.zeros(n), 0.0
        for code in range(2**n):
            tags = [code >> k & 1 for k in range(n)]
            w = np.exp(sum(emit[f] for f, t in zip(row, tags) if t) + sum(move[a, b] for a, b in zip(tags, tags[1:])))
            total += w
            weight += w * np.array(tags)
        assert np.allclose(got[:n], weight / total)


def test_pieces_are_those_of_the_tokenizer(spark):
    texts = [*TEXTS, "  two  spaces \n\n end \n", "don't we'll <|endoftext|> 1234 ünï", " lead", "tail ", "\t　x  y"]
    real = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    real.encode_special_tokens = True
    out = packing.packed(documents(spark, *texts), TOKENIZER, size=64, block_items=40).collect()
    for i, text in enumerate(texts):
        ids = [*real.encode(text or "", add_special_tokens=False).ids, 0]
        pieces = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in out if r.doc_id == i)
        expected = packing.cut(len(ids), 64)
        assert [(p, s, n) for p, s, n, _ in pieces] == [(k, s, n) for k, (s, n) in enumerate(expected)]
        assert all(c == zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()) for _, s, n, c in pieces)
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        assert sum(n for _, n in parts) <= 64
        assert sorted(s for s, _ in parts) == [sum(n for s2, n in parts if s2 < s) for s in sorted(s for s, _ in parts)]
    assert len(bins) <= -(-sum(r.length for r in out) // 64) + 1
    assert packing.packed(awkward(spark).limit(0), TOKENIZER).count() == 0
    assert packing.packed(awkward(spark), TOKENIZER).where("piece = 0").count() == awkward(spark).count()


def test_added_tokens_are_those_of_the_tokenizer(spark, tmp_path):
    texts = [*TEXTS, "a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|>\n\n<|endoftext|><|endoftext|> y", "<|endoftext| >"]
    documents(spark, *texts).write.parquet(str(tmp_path / "documents.parquet"))
    real = tokenizers.Tokenizer.from_file(TOKENIZER)
    for out in (QUERIES["op10_packed"](spark, str(tmp_path)), corpus_pipeline.pack(spark, documents(spark, *texts), SF)):
        found = {(r.doc_id, r.start): (r.length, r.ids_crc32) for r in out.collect()}
        for i, text in enumerate(texts):
            ids = [*real.encode(text or "", add_special_tokens=False).ids, 0]
            for s, n in packing.cut(len(ids), 2048):
                assert found.pop((i, s)) == (n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()))
        assert not found


def test_swaps_look_at_all_items_of_a_bin():
    lengths, where = np.array([*[2] * 32, 5, 7, 188, 11]), np.array([0] * 34 + [1, 1])
    assert sorted(np.bincount(packing.swapped(lengths, where, 200), weights=lengths)) == [75, 200]


def test_swaps_empty_bins():
    lengths, where = np.array([8, 5, 2, 4, 1]), np.array([0, 1, 1, 2, 2])
    after = packing.swapped(lengths, where, 10)
    assert len(set(after)) == 2 and max(np.bincount(after, weights=lengths)) <= 10


def test_perspectives(spark):
    turns = [(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi Bob"), (1, 2, "bob", "Hi Ann"), (1, 3, "ann", None), (2, 0, "system", "alone"),
             (None, None, None, "lost"), (1, 2, "bob", "Hi Ann")]
    df = spark.createDataFrame([(*t, "x", 1) for t in turns], "conv_id long, turn long, role string, text string, seq string, me int")
    for size in (256, 2):
        out = chat.perspectives(df, size).collect()
        told = {}
        for r in sorted(out, key=lambda r: (str(r.conv_id), r.speaker, r.part)):
            whole, spans = told.setdefault((r.conv_id, r.speaker), ("", []))
            assert r.start == len(whole)
            told[r.conv_id, r.speaker] = whole + r.dialogue, spans + [r.dialogue[s.start : s.end] for s in r.masks]
        assert set(told) == {(1, "ann"), (1, "bob"), (None, "unknown")}
        assert told[1, "ann"][1] == ["Hi Bob<|im_end|>\n", "<|im_end|>\n"]
        assert told[1, "bob"] == (
            "<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>user name=ann\nHi Bob<|im_end|>\n"
            + "<|im_start|>assistant\nHi Ann<|im_end|>\n" * 2 + "<|im_start|>user name=ann\n<|im_end|>\n",
            ["Hi Ann<|im_end|>\n"] * 2,
        )
    assert chat.perspectives(df.limit(0)).count() == 0


def page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{body}</body></html>"


def test_articles(spark):
    article = "<article><h1>Head &amp; line</h1><p><b>Bold</b>ly  said,<br>then\nthis &lt;b&gt;.<p>Unclosed<aside>side</aside><div class='share-bar'>share</div><div>kept</div></article>"
    around = "<header>top</header><nav><ul><li><a href='/'>Home</a></ul></nav><!-- x <p>no</p> --><div class=\"ad big\">Buy"
    pages = [
        (1, "http://a.example/1", page(around + article + "<section id=comments><p>reader</p></section><footer>&copy;</footer>")),
        (2, "http://a.example/2", None), (3, None, ""), (4, "no url", "just text"), (1, "http://a.example/1", page(article[:70])),
    ]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, text string")
    out = main_text.main_texts(df).collect()
    got = sorted((r.page_id, r.text) for r in out)
    assert got[:2] == [(1, "Head & line Boldly said, then this <b>. Unclosed kept"), (1, "Head & line Boldly said, then")] or got[1][1].startswith("Head & line Boldly")
    assert got[2:] == [(2, ""), (3, ""), (4, "just text")]
    assert all(r.n_chars == len(r.text) for r in out)
    assert main_text.main_texts(df.limit(0)).count() == 0


def test_runs_that_other_pages_have_go_where_no_article_is_named(spark):
    shared = "This very long notice stands on each and every single page of the host here."
    pages = [(i, f"http://b.example/{i}", page(f"<div><p>{shared}</p></div><p>{prose(i, 40, 40)}</p>")) for i in range(6)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    for r in main_text.main_texts(df).collect():
        assert r.text == prose(r.page_id, 40, 40) and r.n_repeated >= len(shared.split())


@pytest.mark.parametrize("name", ["has-sidebar", "no-sidebar", "menu", "comments"])
def test_a_name_for_the_whole_page_is_not_furniture(name):
    parts = "<nav>Home</nav><div class='sidebar'>aside</div>"
    for body in (f"<body class='{name}'>{parts}<p>{prose(1, 60, 60)}</p></body>", f"<body><div id='{name}'>{parts}<div><p>{prose(1, 60, 60)}</p></div></div></body>"):
        assert [b.text for b in main_text.blocks_of(f"<html>{body}</html>") if b.kind >= 0] == [prose(1, 60, 60)]
    inside = f"<body><div class='{name}'><article><p>{prose(1, 60, 60)}</p></article></div></body>"
    assert [(b.text, b.kind) for b in main_text.blocks_of(inside)] == [(prose(1, 60, 60), 1)]


def test_equal_pages_do_not_cover_each_other(spark):
    notice = "This very long notice stands on each and every single page of the host here."
    bodies = [page(f"<div><p>{notice}</p></div><p>{prose(k, 40, 40)}</p>") for k in (1, 1, 1, 2)]
    df = spark.createDataFrame([(i, f"http://c.example/{i}", h) for i, h in enumerate(bodies)], "page_id long, url string, html string")
    out = {r.page_id: r.text for r in main_text.main_texts(df, main_text.Rules(host_pages=2)).collect()}
    assert out == {0: prose(1, 40, 40), 1: prose(1, 40, 40), 2: prose(1, 40, 40), 3: prose(2, 40, 40)}


def test_blocks_that_most_pages_repeat_are_no_part_of_the_article(spark):
    notice = "This very long notice stands on each and every single page of the host here."
    body = lambda i, more: page(f"<article><p>{prose(i, 40, 40)}</p>{more}</article>")
    quote = "A passage that two of the pages quote word by word is a part of both articles."
    pages = [(i, "http://d.example/x", body(i, f"<p>{notice}</p>" + (f"<p>{quote}</p>" if i < 2 else ""))) for i in range(7)]
    # Pages that differ in markup only share their whole article, which stays.
    pages += [(100 + i, "http://e.example/x", f"<i id='{i}'></i>" + body(50, f"<p>{notice}</p>")) for i in range(6)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    expected = {i: prose(i, 40, 40) + (f" {quote}" if i < 2 else "") for i in range(7)} | {100 + i: f"{prose(50, 40, 40)} {notice}" for i in range(6)}
    for n in (1, 30):
        for rules in (main_text.Rules(), main_text.Rules(host_pages=7)):
            assert {r.page_id: r.text for r in main_text.main_texts(df.repartition(n), rules).collect()} == expected


def test_repeated_by_brute_force():
    choose = random.Random(1)
    for run in (1, 2, 3, 5, 8):
        tokens = np.array([choose.randint(0, 2) for _ in range(60)])
        pages = np.repeat(np.arange(4), 15)
        expected = np.zeros(60, bool)
        windows = [(tuple(tokens[i : i + run]), pages[i], i) for i in range(60 - run + 1) if pages[i] == pages[i + run - 1]]
        for w, p, i in windows:
            if any(w == x and p != q for x, q, _ in windows):
                expected[i : i + run] = True
        assert (main_text.repeated(tokens, pages, run) == expected).all()


def test_decoding():
    blocks = main_text.blocks_of("<p>a&nbsp;&amp;&#65;&unknown; b</p>")
    assert [b.text for b in blocks] == [" ".join(html.unescape("a&nbsp;&amp;&#65;&unknown; b").split())]


def test_spread_of_a_hot_host_keeps_rows(spark):
    df = spark.range(300).select(F.col("id").alias("page_id"), F.lit("http://hot.example/x").alias("url"), F.lit(page("<article><p>same</p></article>")).alias("html"))
    out = main_text.main_texts(df, main_text.Rules(host_pages=50))
    assert out.where("text = 'same'").count() == 300


def test_word_hashes_are_those_of_the_words():
    hashes, seen = WordHashes(), {}
    for text in [*TEXTS, " lead", "tail\n", "a b a\tb\x0b\x0ca"]:
        data = (text or "").encode()
        found, start = hashes(data)
        words = data.split()
        assert [data[s : s + len(w)] for s, w in zip(start, words)] == words and len(found) == len(words)
        for w, h in zip(words, found.tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_the_encoder_of_the_pipeline_holds_few_words():
    encode = packing.encoder(TOKENIZER, corpus_pipeline.REMEMBERED)
    tracemalloc.start()
    for k in range(500):
        encode(" ".join(f"{k}w{i}" for i in range(500)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20_000_000
