"""The operators as filters over tables of documents.

Every function takes documents (``doc_id``, ``text`` and whatever other columns)
and returns documents with the same columns. Columns that a step adds carry a
prefix that tables don't use, so names never clash.
"""

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bin_slack, compression_bands, covering_simhash, language_id, suffix_dedup
from tidemark.llm.runtime import stored

LEAST_SCORE = 0.5
# In a pipeline one worker serves all steps, so each may remember less.
LANGUAGES = language_id.Settings(kept_words=80_000)
PACKING = bin_slack.Settings(kept=100_000)


def keep_known_language(docs: DataFrame) -> DataFrame:
    """Documents whose language is predicted with a score of at least ``LEAST_SCORE``.

    Learned from the documents' own ``lang`` where it isn't null; if none has one,
    nothing can be learned and nothing is kept. Null texts and texts without a
    letter go.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key")
    model = language_id.fit(docs.select(key, "lang", "text"), public_tokenizers.path("piece_bpe_32k.model"), LANGUAGES)
    guess = language_id.predict(docs.sparkSession, model, "text")
    judged = docs.withColumn("__guess", guess)
    known = (F.col("__guess.lang") != language_id.UNDECIDED) & (F.col("__guess.score") >= LEAST_SCORE)
    return judged.where(known).drop("__guess")


def keep_good_quality(docs: DataFrame) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    judged = docs.withColumn("__bands", compression_bands.compression_bands("text"))
    return judged.where("__bands.kept").drop("__bands")


def keep_one_of_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each SimHash component: that with the least ``doc_id``.

    Of rows that share it, the one with the least hash of its text; of equal rows,
    any one. A null ``doc_id`` is kept only if its component has no other.
    """
    id_key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id")
    text_key = F.xxhash64(F.coalesce("text", F.lit(""))).alias("__text")
    prints = stored(
        docs.select("doc_id", id_key, text_key, covering_simhash.simhash("text").alias("print")),
        "document-fingerprints",
    )
    groups = covering_simhash.near_duplicates(prints.select(F.col("doc_id").alias("id"), "print"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__text")
    winners = (
        prints.join(groups.select("print", "root"), "print")
        .groupBy("root")
        .agg(F.min_by(F.struct("__id", "__text"), order).alias("w"))
        .select("w.*")
        .distinct()
    )
    kept = docs.withColumns({"__id": id_key, "__text": text_key}).join(winners, ["__id", "__text"])
    return kept.dropDuplicates(["__id", "__text"]).select(*docs.columns)


def remove_repeated_strings(docs: DataFrame) -> DataFrame:
    """Documents without the bytes of repeated strings, in ``text`` (and ``n_chars``).

    Every document stays, if need be with an empty text: what is cut is text, not
    documents. Where a cut falls inside a character the rest of that character goes
    too. Texts without a repeat are left as they are, nulls included.
    """
    settings = suffix_dedup.Settings()
    cut = suffix_dedup.without_repeats(docs, "text", settings).select("k1", "k2", _whole_characters("kept").alias("__kept"))
    keyed = docs.withColumns(dict(zip(("__k1", "__k2"), suffix_dedup.text_keys("text"))))
    copies = keyed.groupBy("__k1", "__k2").agg(F.count("*").alias("__copies"))
    renamed = cut.withColumnsRenamed({"k1": "__k1", "k2": "__k2"})
    changed = stored(copies.join(renamed, ["__k1", "__k2"], "left").where("__copies > 1 or __kept is not null"), "cut-texts")
    whole = (F.col("__copies") > 1) & (F.octet_length("text") >= settings.length)
    joined = keyed.join(changed, ["__k1", "__k2"], "left")
    joined = joined.withColumn("text", F.when(whole, "").otherwise(F.coalesce("__kept", "text")))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        joined = joined.withColumn("n_chars", F.when(whole | F.col("__kept").isNotNull(), length).otherwise(F.col("n_chars")))
    return joined.select(*docs.columns)


def _whole_characters(column: str):
    def decode(parts: pa.Array) -> pa.Array:
        return pa.array([p.as_py().decode("utf-8", "ignore") for p in parts], pa.string())

    return F.arrow_udf(decode, "string").asNondeterministic()(F.col(column))


def pack_sequences(docs: DataFrame) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return bin_slack.pack(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"), PACKING)
