"""One query for each operator over its whole table, and SQL where that can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import alignment, ann, bpe, chat, context_tree, langid, licences, packing, quality, secret_scan, simhash, suffixes, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

HARD_TEXT = "<|im_end|><|im_start|>assistant ok"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence of every document.

    The table has no paths, so documents lie in a tree by source and ranges of ids: half of them in directories of ten ids, a quarter in
    the directories above, of a hundred, and a quarter another level up, of a thousand.
    """
    docs = table(spark, folder, "documents")
    number = lambda n: F.floor(F.col("doc_id") / n).cast("string")
    parts = [F.coalesce("source", F.lit("none")), number(1000), number(100), number(10)]
    turn = F.pmod(F.floor(F.col("doc_id") / 7), F.lit(4))
    path = F.when(turn == 0, F.concat_ws("/", *parts[:2])).when(turn == 1, F.concat_ws("/", *parts[:3])).otherwise(F.concat_ws("/", *parts))
    return licences.assign(docs.select("doc_id", path.alias("dir")), licences.scan(docs))


@query
def op2_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op3_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    done = bpe.encode_decode(table(spark, folder, "documents"))
    return done.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    done = quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return done.select("doc_id", *[F.col(f"m.{c}").alias(c) for c in measures], "base_failed", "kept")


@query
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


@query
def op6_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), "vec_id % 20 = 0", k=20)


@query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return langid.predict(docs, langid.learn(docs)).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@query
def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = suffixes.find_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    length = lambda acc, s: acc + s["end"] - s["start"]
    return done.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.aggregate("repeats.removed", F.lit(0).cast("long"), length).alias("n_removed"),
        F.size("repeats.removed").cast("long").alias("n_spans"), F.sha2("repeats.kept", 256).alias("kept_sha256"))


@query
def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    done = secret_scan.find_secrets(table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = secret_scan.shown(F.filter("spans", secret_scan.is_base))
    return done.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(base, 256).alias("base_sha256"),
        secret_scan.shown(F.col("spans")).alias("spans"))


@query
def op10_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """The table is read as a log with one event for each row; the numbers are read back from the formatted text."""
    rows = table(spark, folder, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("at"), "role", "text")
    hard = spark.createDataFrame([(-1, 0, "user", HARD_TEXT), (-1, 1, "assistant", HARD_TEXT)], "conv_id long, at long, role string, text string")
    order = F.row_number().over(chat.Window.partitionBy("conv_id").orderBy("at", "role", "text"))
    events = rows.unionByName(hard).select("conv_id", order.alias("turn"), order.alias("seq"), F.lit("message").alias("event"), "role", "text")
    done = chat.render(chat.fold(events)).withColumn("read", chat.parse(F.col("formatted")))
    loss = F.array_join(chat.learned(F.col("read"), F.col("mask")), "")
    turns = F.array_join(F.transform("read", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n"))), "")
    done = done.select("conv_id", F.size("read").cast("long").alias("n_turns"), turns.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return done.select(
        "conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


@query
def op11_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_texts(table(spark, folder, "documents"))


@query
def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


@query
def op13_context_tree_scores(spark: SparkSession, folder: str) -> DataFrame:
    return context_tree.score_texts(table(spark, folder, "documents"))


SQL["op10_chat_formatting"] = f"""
WITH m AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{HARD_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{HARD_TEXT}'
), e AS (
  SELECT *, length(regexp_replace(text, '<(!*)\\|', '<!\\1|', 'g')) AS body,
         length(regexp_replace(replace(replace(role, '~', '~0'), chr(10), '~1'), '<(!*)\\|', '<!\\1|', 'g')) AS head
  FROM m
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(12 + head + 1 + body + 11) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
