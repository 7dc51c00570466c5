"""The registered queries of this subpackage and, where it can say them, their SQL."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bin_slack, chunked_bpe, collocations, compression_bands, conversation_repair, covering_simhash, following, html_extraction, language_id, minhash, scaled_sketch, suffix_dedup, tool_calls, warc
from tidemark.llm.runtime import prepare, stored, table, utf8

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORDS = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"
RANKS = "byte_bpe_multi_50k.tiktoken"


def query(name: str, source: str, sql: str | None = None):
    """Register ``build(rows of the source table)``."""

    def register(build):
        QUERIES[name] = lambda spark, sf_dir: build(table(prepare(spark), sf_dir, source))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_compression_bands", "documents")
def op1(documents: DataFrame) -> DataFrame:
    judged = documents.select("doc_id", compression_bands.compression_bands("text").alias("result"))
    return judged.select("doc_id", "result.*")


@query("op2_bin_slack", "documents")
def op2(documents: DataFrame) -> DataFrame:
    return bin_slack.pack(documents, "doc_id", "text", public_tokenizers.path(WORDS))


@query("op3_language_id", "documents")
def op3(documents: DataFrame) -> DataFrame:
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    docs = documents.select("doc_id", "text", "lang", key.alias("key"), (F.crc32(key) % 5 == 0).alias("held_out"))
    model = language_id.fit(docs.where("not held_out").select("key", "lang", "text"), public_tokenizers.path(PIECES))
    guess = language_id.predict(documents.sparkSession, model, "text")
    return docs.select("doc_id", "held_out", guess.alias("guess")).select(
        "doc_id", "held_out", F.col("guess.lang").alias("lang_pred"), "guess.score"
    )


@query("op4_covering_simhash", "documents")
def op4(documents: DataFrame) -> DataFrame:
    prints = stored(
        documents.select("doc_id", covering_simhash.simhash("text").alias("print")), "document-fingerprints"
    )
    groups = covering_simhash.near_duplicates(prints.select(F.col("doc_id").alias("id"), "print"))
    fingerprint = covering_simhash.as_hex("print").alias("fingerprint")
    return prints.join(groups, "print").select("doc_id", fingerprint, "component_id")


@query("op5_scaled_sketch", "documents")
def op5(documents: DataFrame) -> DataFrame:
    pairs = following.with_next(documents, scaled_sketch.sketch("text"))
    kept = F.col("n_chars") - F.floor(F.col("n_chars") / 4)
    edited = (
        pairs.withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("edited", F.concat(F.substring("text", F.lit(1), kept.cast("int")), "next_start"))
        .select("doc_id", "n_chars", "mark", "next_mark", "edited", scaled_sketch.sketch("edited").alias("edited_mark"))
    )
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        scaled_sketch.as_text(F.col("mark")).alias("fingerprint"),
        scaled_sketch.as_text(F.col("edited_mark")).alias("edited_fingerprint"),
        scaled_sketch.containment(F.col("mark"), F.col("edited_mark")).alias("near_edited"),
        scaled_sketch.containment(F.col("mark"), F.col("next_mark")).alias("near_next"),
    )


@query("op6_suffix_dedup", "documents")
def op6(documents: DataFrame) -> DataFrame:
    settings = suffix_dedup.Settings()
    text = utf8("text")
    docs = documents.select(
        "doc_id",
        *suffix_dedup.text_keys("text"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text, 256).alias("whole_sha256"),
    )
    cut = suffix_dedup.without_repeats(documents, "text", settings).select(
        "k1", "k2",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]).alias("removed"),
        F.size("spans").cast("long").alias("runs"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    copies = docs.groupBy("k1", "k2").agg(F.count("*").alias("copies"))
    texts = stored(copies.join(cut, ["k1", "k2"], "left"), "cut-texts")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= settings.length)
    return docs.join(texts, ["k1", "k2"]).select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("runs", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit("").cast("binary"), 256))
        .otherwise(F.coalesce("kept_sha256", "whole_sha256"))
        .alias("kept_sha256"),
    )


@query("op7_chunked_bpe", "documents")
def op7(documents: DataFrame) -> DataFrame:
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    encoded = chunked_bpe.encode(documents, "doc_id", "text", path, pattern)
    decoded = encoded.select("doc_id", "ids", chunked_bpe.decode("ids", path, pattern).alias("bytes"))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


SHA1 = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as digest from pages),
q as (select *, octet_length(encode(html)) as n, max(page_id) over (partition by digest) as first from p)
select page_id, n::bigint as payload_bytes, digest as payload_digest,
  case when n >= 1000 and page_id is distinct from first then 'revisit' else 'response' end as record_type,
  case when n >= 1000 and page_id is distinct from first then first end as refers_to
from q
"""


@query("op8_warc_transactions", "pages", SHA1)
def op8(pages: DataFrame) -> DataFrame:
    folder = warc.write_captures(pages)
    records = warc.described(warc.read_records(pages.sparkSession, folder))
    return warc.resolved(warc.assemble(warc.without_pages(records)))


TOOLS = {
    "answer": {"properties": {"text": "string", "chars": "integer"}, "required": ("text", "chars")},
    "instruct": {"properties": {"text": "string", "chars": "integer"}, "required": ("text",)},
}

LINKS = """
with m as (select conv_id as conv, turn, role, text, count(*) as n from conversations group by all),
c as (
  select conv, concat(conv, '-', turn) as call_id, turn as position, text, n,
    case role when 'user' then 'answer' else 'instruct' end as name,
    case when text is null then '{"chars":0}' else json_object('chars', length(text), 'text', text)::varchar end as args
  from m where role is distinct from 'assistant'
),
k as (select *, row_number() over (partition by conv, call_id order by position, name, args) as nth from c),
r as (select conv, concat(conv, '-', turn - 1) as call_id, turn as result_position, text as content, n from m where role = 'assistant'),
parts as (
  select r.conv, r.call_id, k.position, r.result_position, k.name, r.content, k.args, r.n,
    case when k.conv is null then 'orphan' else 'linked' end as status
  from r left join k on k.conv = r.conv and k.call_id = r.call_id and k.nth = 1
  union all
  select conv, call_id, position, null, name, null, args, n, 'unanswered' from k
  where nth = 1 and not exists (select 1 from r where r.conv = k.conv and r.call_id = k.call_id)
  union all
  select conv, call_id, position, null, name, null, args, n, 'duplicate' from k where nth > 1
)
select conv, call_id, position, result_position, name, status, n as copies,
  case when status in ('linked', 'unanswered') then 0 end::integer as stage,
  case when status <> 'orphan' then case when args like '{"chars":0}' and name = 'answer' then 'text: missing' else '' end end as errors,
  concat('{"arguments":', coalesce(args, 'null'), ',"id":', to_json(call_id), ',"name":', coalesce(to_json(name)::varchar, 'null'),
    ',"result":', coalesce(to_json(content)::varchar, 'null'), '}') as json
from parts
"""


@query("op9_tool_calls", "conversations", LINKS)
def op9(conversations: DataFrame) -> DataFrame:
    """User and system turns are calls, assistant turns the result of the turn
    before; a user turn waits for the call two turns back."""

    def call_id(back: int):
        return F.concat(F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - back).cast("string"))

    turns = conversations.select("conv_id", "turn", "role", "text", F.col("conv_id").alias("conv"))
    reply = F.coalesce(F.col("role") == "assistant", F.lit(False))
    arguments = F.struct(F.coalesce(F.length("text"), F.lit(0)).alias("chars"), "text")
    calls = turns.where(~reply).select(
        "conv",
        call_id(0).alias("call_id"),
        F.col("turn").alias("position"),
        F.when(F.col("role") == "user", "answer").otherwise("instruct").alias("name"),
        F.to_json(arguments).alias("arguments"),
        F.when(F.col("role") == "user", F.array(call_id(2))).otherwise(F.array().cast("array<string>")).alias("after"),
    )
    results = turns.where(reply).select(
        "conv", call_id(1).alias("call_id"), F.col("turn").alias("position"), F.col("text").alias("content")
    )
    return tool_calls.linked(calls, results, TOOLS)


@query("op10_html_extraction", "pages")
def op10(pages: DataFrame) -> DataFrame:
    trees = html_extraction.fit(pages)
    text = html_extraction.extract(pages.sparkSession, trees, "html").alias("text")
    return pages.select("page_id", "url", text).withColumn("n_chars", F.length("text").cast("long"))


@query("op11_collocations", "documents")
def op11(documents: DataFrame) -> DataFrame:
    settings = collocations.Settings()
    phrases = stored(collocations.frequent_phrases(documents, settings), "spelled-phrases")
    return collocations.collocations(phrases, settings)


@query("op12_minhash", "documents")
def op12(documents: DataFrame) -> DataFrame:
    found = minhash.near_duplicates(documents.select(F.col("doc_id").alias("id"), "text"))
    kept = F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", kept)


@query("op13_conversation_repair", "conversations")
def op13(conversations: DataFrame) -> DataFrame:
    """Rows are damaged by the checksum of their place: 0 goes, 1 loses its text, 2 its
    sentence ends, 3 comes twice, 4 is said by the user. Nulls count as one space."""

    def plain(column: str):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text"))
    turns = conversations.select(
        F.col("conv_id").alias("conv"),
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(plain("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(kind == 0, F.array()).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    )
    convs = conversations.select(F.col("conv_id").alias("conv"))
    return conversation_repair.summaries(turns, convs).withColumnRenamed("conv", "conv_id")
