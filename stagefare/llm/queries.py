"""One query per operator, with production parameters over the whole given table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op1_pii, op2_toxicity, op3_decontaminate, op4_repeats, op5_language, op6_packing, op7_store, op8_embeddings, op9_jaccard, op10_chat, op11_weighting, op12_alignment, op13_whitening
from .tables import read

# The conversation that the check adds: control strings inside texts.
_TRICKY = "\\### Assistant: </turn> ok"


def op1_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_pii.find(read(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_toxicity.rate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_language.identify(read(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_embeddings.cluster(read(spark, sf_dir, "embeddings"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_repeats.remove_repeats(read(spark, sf_dir, "documents"), with_text=False).drop("kept")


def op6_packing_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_packing.pack(read(spark, sf_dir, "documents"), with_ids=False).drop("ids")


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_store.round_trip(read(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_jaccard.cluster(read(spark, sf_dir, "documents"), op9_jaccard.Rule(words=3, percent=90))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_TRICKY).alias("text"),
    )
    chats = op10_chat.format_chats(given.unionByName(extra))
    return op10_chat.digests(op10_chat.read_back(chats))


def op11_context_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_weighting.score(read(spark, sf_dir, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_alignment.count_links(read(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_boosting": op1_pii_boosting,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op2_toxicity_fm": op2_toxicity_fm,
    "op5_language_id": op5_language_id,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op6_packing_tiers": op6_packing_tiers,
    "op7_token_store": op7_token_store,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_context_weighting": op11_context_weighting,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_embedding_whitening": op13_embedding_whitening,
}

# Words of a text with their places, as SQL; A-Z may be lowered first.
_WORDS = r"""docs as (select doc_id, regexp_extract_all({text}, '[^\x20\x09-\x0D]+') as w from documents),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from docs)"""
_WORD_LIST = _WORDS.format(text="coalesce(text, '')")
_LOWERED = _WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


def _in_a_row(n: int) -> str:
    """The words from one on that lie within ``n``, joined; null where a text ends before."""
    return " || ' ' || ".join(["word", *(f"lead(word, {k}) over o" for k in range(1, n))])


# Least vertex that each end of ``links(a, b)`` reaches.
_REACHED = """reached as (
  select a, b from (select a, b from links union all select b, a from links)
  union select r.a, l.b from reached r join (select a, b from links union all select b, a from links) l on r.b = l.a
), least as (select a, min(b) as low from reached group by a)"""

ORACLES: dict[str, str] = {
    "op4_substring_dedup": f"""
with {_WORD_LIST},
windows as (select doc_id, p, {_in_a_row(13)} as win from words window o as (partition by doc_id order by p)),
owned as (select win, min(doc_id) as owner from windows where win is not null group by win),
gone as (
  select distinct doc_id, p + k as p from windows join owned using (win) cross join range(13) t(k) where owner < doc_id
),
kept as (select doc_id, count(*) as n, string_agg(word, ' ' order by p) as text from words anti join gone using (doc_id, p) group by doc_id)
select doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(text, '')) as kept_sha256
from docs left join kept using (doc_id)
""",
    "op8_embedding_dedup": f"""
with recursive usable as (
  select vec_id, label, cast(embedding as double[]) as v from embeddings
  where label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select x.vec_id as a, y.vec_id as b from usable x join usable y on x.label = y.label and x.vec_id < y.vec_id and len(x.v) = len(y.v)
  where list_cosine_similarity(x.v, y.v) >= 0.98
), {_REACHED},
counted as (select a, count(*) as n from (select a from links union all select b from links) group by a)
select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(low, vec_id)) as component_id, vec_id <= coalesce(low, vec_id) as kept
from embeddings left join counted on vec_id = counted.a left join least on vec_id = least.a
""",
    "op9_jaccard_join": f"""
with recursive {_LOWERED},
shingles as (
  select distinct doc_id, s from (select doc_id, {_in_a_row(3)} as s from words window o as (partition by doc_id order by p)) where s is not null
  union all select doc_id, array_to_string(w, ' ') from docs where len(w) between 1 and 2
), sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select x.doc_id as a, y.doc_id as b, count(*) as n from shingles x join shingles y on x.s = y.s and x.doc_id < y.doc_id group by all
), links as (
  select a, b from shared join sizes x on a = x.doc_id join sizes y on b = y.doc_id where 100 * shared.n >= 90 * (x.n + y.n - shared.n)
), {_REACHED}
select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, coalesce(low, doc_id)) as component_id
from docs left join sizes using (doc_id) left join least on doc_id = least.a
""",
    "op10_chat_formatting": r"""
with given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), placed as (
  select *, row_number() over (partition by conv_id order by turn, role, text) as k,
    replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t') as inside,
    replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), ':', '\c') as head
  from given
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by k), '')) as loss_sha256,
  cast(sum(4 + length(head) + 2 + length(inside) + 9) as bigint) as formatted_chars
from placed group by conv_id
""",
}
