"""Registered queries of the text operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytrace.llm import (
    alignment, chat, decontaminate, exactdedup, langid, lm, packing, quality, simhash, syncmers,
    tokencount, toxicity, whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.scores(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.evaluated(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted", "toxic_tokens", "spans")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(_table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.counts(_table(spark, sf_dir, "documents"))


#: A conversation whose texts are full of control strings.
HOSTILE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = "conv_id bigint, turn bigint, role string, text string"
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(HOSTILE, fields)).select(
        "conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))
    return chat.digests(chat.format_turns(turns))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.evaluated(_table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score", "margin", "accepted")


def op8_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compared(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"),
                               _table(spark, sf_dir, "benchmark"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(_table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.groups(_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.counted(_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(_table(spark, sf_dir, "embeddings"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_toxicity": op2_toxicity,
        "op3_packing": op3_packing,
        "op4_lm": op4_lm,
        "op5_token_counts": op5_token_counts,
        "op6_chat": op6_chat,
        "op7_langid": op7_langid,
        "op8_syncmers": op8_syncmers,
        "op9_decontamination": op9_decontamination,
        "op10_simhash": op10_simhash,
        "op11_exact_dedup": op11_exact_dedup,
        "op12_alignment": op12_alignment,
        "op13_whitening": op13_whitening,
    }


#: Length of a formatted turn: control strings, and one sign more for each that is escaped.
_ESCAPED = r"length({0}) + length(regexp_replace({0}, '[^\\<\[]', '', 'g'))"

#: Turns of one number come in order of role and formatted text; nulls are first.
_IN_ORDER = (r"order by turn nulls first, given nulls first, "
             r"regexp_replace(text, '([\\<\[])', '\1\\', 'g') || '[/INST]</s>'")

OP6_SQL = rf"""
with turns as (
    select conv_id, turn, role as given, coalesce(role, '') as role, coalesce(text, '') as text
    from (select conv_id, turn, role, text from conversations
          union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'),
                           (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' {_IN_ORDER})) as turns_sha256,
    sum(if(role = 'assistant', length(text), 0))::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' {_IN_ORDER}) filter (role = 'assistant'), ''))
        as loss_sha256,
    sum(length('<s>[INST][/INST]</s>') + 1 + {_ESCAPED.format('role')}
        + {_ESCAPED.format('text')})::bigint as formatted_chars
from turns group by conv_id
"""

OP11_SQL = r"""
with texts as (
    select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
        as text_sha256
    from documents
)
select doc_id, min(doc_id) over of_text as keep_id, count(*) over of_text as group_size,
    row_number() over (partition by text_sha256 order by doc_id nulls last) = 1 as kept,
    text_sha256
from texts window of_text as (partition by text_sha256)
"""


def statements() -> dict[str, str]:
    return {"op6_chat": OP6_SQL, "op11_exact_dedup": OP11_SQL}
