"""The operators as queries over the driver's tables."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeledger.llm import brown, chat, edit_fingerprint, hard_negatives, license_scan, line_dedup, main_text, mixing, packing, quality, spelling, toxicity, weighted_minhash
from swipeledger.llm.common import held_out_by, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op2_line_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents")).drop("cleaned_text")


@query
def op7_perspectives(spark, sf_dir):
    seen = chat.perspectives(table(spark, sf_dir, "conversations"))
    spans = F.transform("masks", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string")))
    return seen.withColumn("masks", F.array_join(spans, " "))


@query
def op10_packed(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"), TOKENIZER, added=True)


@query
def op5_pivotal_mix(spark, sf_dir):
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


@query
def op8_toxic_spans(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents, model).select("doc_id", held_out_by(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted", "spans")


@query
def op6_class_ngrams(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    # Every text is encoded once, for the model's moves and for its score.
    words = brown.learned(documents.where(brown.trained_on(F.col("doc_id"))))
    texts = brown.encoded(documents, words)
    model = brown.Model(words, brown.moves(texts.where(brown.trained_on(F.col("doc_id"))), words.classes))
    held_out = (~brown.trained_on(F.col("doc_id"))).alias("held_out")
    return brown.scored(texts, model).select("doc_id", held_out, "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")


@query
def op9_line_dedup(spark, sf_dir):
    removed = line_dedup.removed_lines(table(spark, sf_dir, "documents"), every_link=True)
    return removed.select(F.col("id").alias("doc_id"), "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed", "links", "n_links")


@query
def op3_weighted_minhash(spark, sf_dir):
    found = weighted_minhash.classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id")


@query
def op4_host_runs(spark, sf_dir):
    return main_text.main_texts(table(spark, sf_dir, "pages"))


@query
def op1_edit_fingerprint(spark, sf_dir):
    return edit_fingerprint.fingerprinted(table(spark, sf_dir, "documents"))


@query
def op11_hard_negatives(spark, sf_dir):
    rows = hard_negatives.prepared(table(spark, sf_dir, "embeddings"))
    return hard_negatives.mined(rows, F.col("id") % 100 == 0)


@query
def op12_license_scan(spark, sf_dir):
    return license_scan.scanned(table(spark, sf_dir, "documents"))


@query
def op13_spelling(spark, sf_dir):
    return spelling.forms(spelling.words(table(spark, sf_dir, "documents")))
