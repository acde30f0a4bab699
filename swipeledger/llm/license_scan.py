"""License scans: word k-grams of texts joined to places in templates; offset diagonals vote, neighbours merge, spans are verified."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from swipeledger.llm.common import stored

#: What stands between words, which are runs of digits, letters and everything beyond ASCII.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The one character beyond ASCII whose lower case is an ASCII letter, and a letter that stays what it is.
_KELVIN, _KRA = "\u212a", "\u0138"


@dataclass(frozen=True)
class Template:
    """``label``: what a found text counts as. ``phrase``: it stands word by word; else a share of its words does. ``base``: its places
    are counted."""

    label: str
    text: str
    phrase: bool = True
    base: bool = False


# The phrases that are counted, and the labels they give.
BASE = [
    Template("gpl", "gnu general public license", base=True),
    Template("apache", "apache license", base=True),
    Template("cc-by", "cc by", base=True),
    Template("mit", "mit license", base=True),
]

# Statements of further licenses, and opening passages of public license texts.
FURTHER = [
    Template("agpl", "gnu affero general public license"),
    Template("lgpl", "gnu lesser general public license"),
    Template("gpl", "gnu gpl"),
    Template("apache", "apache software license"),
    Template("apache", "www apache org licenses license 2 0"),
    Template("bsd", "bsd license"),
    Template("bsd", "bsd 2 clause"),
    Template("bsd", "bsd 3 clause"),
    Template("isc", "isc license"),
    Template("mpl", "mozilla public license"),
    Template("epl", "eclipse public license"),
    Template("cc0", "cc0 1 0"),
    Template("cc0", "creative commons zero"),
    Template("cc-by", "creative commons attribution"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the "
        "software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software",
        phrase=False,
    ),
    Template(
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may "
        "obtain a copy of the license at http www apache org licenses license 2 0",
        phrase=False,
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version 3 of the license or at your option any later version",
        phrase=False,
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer",
        phrase=False,
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
        "the above copyright notice and this permission notice appear in all copies",
        phrase=False,
    ),
    Template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with "
        "this file you can obtain one at",
        phrase=False,
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or "
        "distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by "
        "any means",
        phrase=False,
    ),
]


@dataclass(frozen=True)
class Scan:
    """``short``, ``long``: words of a k-gram, of phrases and of other templates. ``drift``: diagonals that are at most so many words
    apart belong together. ``least``: the share of a template's words that a span has, in order. ``longest``: the most words of
    a span, as a multiple of its template's."""

    short: int = 2
    long: int = 4
    drift: int = 4
    least: float = 0.6
    longest: float = 1.5


#: As many words of templates are sent to all tasks at most; a larger set is joined as Spark chooses.
BROADCAST_GRAMS = 50_000


def words(text: Column) -> Column:
    """The words of a text, lower-cased. Letters beyond ASCII may come out in either case: no template has one.
    Texts are split, as Spark's search for all matches copies the text for each."""
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(_KELVIN), F.lit(_KRA)))
    return F.array_remove(F.split(lowered, BETWEEN), "")


def _gram(words: Column, at: Column, k: int) -> list[Column]:
    return [F.get(words, at + j) for j in range(k)]


def _rolling(words: Column, k: int, known: list[int] | None) -> Column:
    """(at, hash, gram) of each ``k`` words. What begins in the last words has fewer, as no template's; ``known`` are the only hashes that
    come out."""
    places = F.sequence(F.lit(0), F.size(words))
    if known is not None:
        places = F.filter(places, lambda i: F.xxhash64(*_gram(words, i, k)).isin(known))
    return F.transform(
        places, lambda i: F.struct(i.alias("at"), F.xxhash64(*_gram(words, i, k)).alias("hash"), F.concat_ws(" ", *_gram(words, i, k)).alias("gram"))
    )


def template_grams(spark: SparkSession, templates: list[Template], scan: Scan = Scan()) -> DataFrame:
    """(hash, gram, template, label, phrase, base, size, k, place): the k-grams of all templates with their places."""
    names = ("template", "label", "phrase", "base", "text")
    rows = ((n, t.label, t.phrase, t.base, t.text) for n, t in enumerate(templates))
    listed = F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in zip(names, row))) for row in rows))
    df = spark.range(1).select(F.inline(listed)).withColumn("words", words(F.col("text"))).withColumn("size", F.size("words"))
    out = None
    for k, some in ((scan.short, F.col("phrase")), (scan.long, ~F.col("phrase"))):
        part = df.where(some).select("*", F.inline(_rolling(F.col("words"), k, None)), F.lit(k).alias("k")).where(F.col("at") <= F.col("size") - k)
        part = part.select("hash", "gram", "template", "label", "phrase", "base", "size", "k", F.col("at").alias("place"))
        out = part if out is None else out.union(part)
    return out


#: A document is its id and its text.
_KEY = ["_id", "_text_id"]


def _keyed(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    return documents.select(F.col(f"`{id_column}`").alias("_id"), F.xxhash64(text).alias("_text_id"), text.alias("_text"))


def license_spans(
    documents: DataFrame, templates: list[Template] = [*BASE, *FURTHER], scan: Scan = Scan(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """A row per place of a license in a document: ``_id``, ``_text_id`` (a hash of the text), ``template``, ``label``, ``base``, ``first`` and
    ``end`` (words, from 0, the end not included) and ``share``, that of the template's words that stand there in order.

    All rolling k-grams of a text are joined, by hash, to their places in the templates, and compared word by word. A pair votes for
    the diagonal on which both lie, the offset of the text against the template. Votes of a diagonal are counted, diagonals at most ``drift`` words
    apart are merged, as words that are left out or put in shift the rest, and a span counts if it has ``least`` of its
    template's words within ``longest`` times its length; of a phrase it has all, word by word.

    The templates' hashes, a list of known length, are looked up where a text is read, so that rows are made of k-grams that some template has. Votes are sets of places in a template, combined within each task first, so a row that is repeated
    very often does not gather. Null and empty texts, and those without words, have no spans. Rows with the same id
    and text are one document here. Other columns do not matter."""
    spark = documents.sparkSession
    grams, known = template_grams(spark, templates, scan), dict.fromkeys((scan.short, scan.long))
    if sum(len(t.text.split()) for t in templates) <= BROADCAST_GRAMS:
        for k in known:
            known[k] = [r["hash"] for r in grams.where(F.col("k") == k).select("hash").distinct().collect()]
        grams = F.broadcast(grams)
    read = _keyed(documents, id_column, text_column).select(*_KEY, words(F.col("_text")).alias("_words"))
    rolled = read.select(*_KEY, F.inline(F.concat(*(_rolling(F.col("_words"), k, some) for k, some in known.items()))))
    template = ["template", "label", "phrase", "base", "size", "k"]
    hits = rolled.join(grams, ["hash", "gram"])
    diagonals = hits.groupBy(*_KEY, *template, (F.col("at") - F.col("place")).alias("diagonal")).agg(F.collect_set("place").alias("places"))
    reached = F.when(F.col("phrase"), 0).otherwise(scan.drift)
    along = Window.partitionBy(*_KEY, "template").orderBy("diagonal")
    begins = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > reached, F.lit(True))
    merged = diagonals.withColumn("_begins", begins.cast("int")).withColumn("_group", F.sum("_begins").over(along))
    spans = merged.groupBy(*_KEY, *template, "_group").agg(
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        F.min(F.col("diagonal") + F.array_min("places")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("places") + F.col("k")).alias("end"),
    )
    covered = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("k") - 1))))
    share, length = F.size(covered) / F.col("size"), F.col("end") - F.col("first")
    whole = (share == 1) & (length == F.col("size"))
    verified = F.when(F.col("phrase"), whole).otherwise((share >= scan.least) & (length <= scan.longest * F.col("size")))
    spans = spans.withColumn("share", share).where(verified)
    return spans.select(*_KEY, "template", "label", "base", F.col("first").cast("long"), F.col("end").cast("long"), "share")


def scanned(
    documents: DataFrame, templates: list[Template] = [*BASE, *FURTHER], scan: Scan = Scan(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``documents``: the id, ``n_words``, ``n_base`` (places of base phrases), ``first_word`` and ``last_word`` (the smallest and largest
    word at which one starts, else null), ``base_labels`` and ``labels`` (of base phrases, and of all templates; distinct, sorted, joined by commas, empty if there
    are none), ``score`` (the largest share of a template that was found, else 0) and ``n_spans``.

    A null text counts as empty; rows with the same id and text get the same values."""
    spans = license_spans(documents, templates, scan, id_column, text_column)
    base = F.col("base")

    def joined(labels: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(labels)), ",")

    found = stored(
        spans.groupBy(*_KEY).agg(
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, F.col("first"))).alias("first_word"),
            F.max(F.when(base, F.col("first"))).alias("last_word"),
            joined(F.when(base, F.col("label"))).alias("base_labels"),
            joined(F.col("label")).alias("labels"),
            F.max("share").alias("score"),
            F.count("*").alias("n_spans"),
        )
    )
    read = _keyed(documents, id_column, text_column).select(*_KEY, F.size(words(F.col("_text"))).cast("long").alias("n_words"))
    found = found.withColumnsRenamed({"_id": "_f_id", "_text_id": "_f_text_id"})
    same = F.col("_id").eqNullSafe(F.col("_f_id")) & (F.col("_text_id") == F.col("_f_text_id"))
    zero, none = F.lit(0).cast("long"), F.lit("")
    return read.join(found, same, "left").select(
        F.col("_id").alias(id_column), "n_words", F.coalesce("n_base", zero).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("n_spans", zero).alias("n_spans"),
    )
