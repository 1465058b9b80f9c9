"""One query for each numbered operator, over whole tables, with the SQL that states the same where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edispark.llm import chat, html_text, licenses, lm, mixing, neardup, packing, rules, token_files, topk
from edispark.llm.common import table
from edispark.shipping import ship


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of 2,048 words with at most four pieces of one source and no two copies."""
    return packing.packed(table(spark, sf_dir, "documents"), capacity=2048, source_quota=4)


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text is one text part; conversation -1 holds control strings in both its turns."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))], turns.schema)
    turns = turns.unionByName(own)
    return chat.read_back(chat.formatted_turns(turns, chat.text_parts(F.col("text"))))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.tokenized(table(spark, sf_dir, "documents"), token_files.vocabulary_path("byte_bpe_50k.json"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = rules.ledger(table(spark, sf_dir, "documents"))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.passes(rules.BASE)).alias("base_failed"), rules.passes(rules.STANDARD).alias("kept"), "failed_bits",
    )


def rules_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the standard policy fails, alone or with others, and what the policy keeps without it."""
    return rules.ablation(rules.ledger(table(spark, sf_dir, "documents")), rules.STANDARD)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine tenths of the largest entropy or four passes at most, at the corpus's own number of tokens."""
    shown = mixing.mixed(table(spark, sf_dir, "documents"), mixing.Goal(entropy=0.9, repeats=4.0))
    return shown.select(
        F.col("_row.doc_id").alias("doc_id"), F.col("_s").alias("source"), F.col("_n").alias("n_tokens"), F.col("_pass").alias("pass"),
        F.col("_block").alias("block"), F.col("_weight").alias("weight"), F.col("_mix_key").alias("mix_key"),
    )


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's id and its class, named by the class's least id."""
    return neardup.classes(table(spark, sf_dir, "documents"))


QUERIES = {
    "op3_license_scan": op3_license_scan,
    "op5_main_text": op5_main_text,
    "op2_lm_scores": op2_lm_scores,
    "op1_best_fit_packing": op1_best_fit_packing,
    "op10_near_duplicates": op10_near_duplicates,
    "op4_chat_format": op4_chat_format,
    "op9_top_k": op9_top_k,
    "op6_token_files": op6_token_files,
    "op8_mix_sources": op8_mix_sources,
    "op7_quality_rules": op7_quality_rules,
    "rules_ablation": rules_ablation,
}

_WORD = r"[^\x20\x09-\x0D]+"
_LEDGER = rf"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '{_WORD}') as words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as lines from d),
win as (select rid, len(words) as n, generate_subscripts(words, 1) as i, words from w),
tri as (select rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as t from win where i <= n - 2),
rep as (select rid, i from tri qualify count(*) over (partition by rid, t) > 1),
cov as (select rid, count(distinct p) as n_repeat_words from (select rid, unnest([i, i + 1, i + 2]) as p from rep) group by rid),
m as (select w.doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
        len(lines)::bigint as n_lines from w left join cov using (rid)),
b as (select *, (case when n_words < 50 then 1 else 0 end
        + case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end
        + case when 10 * n_symbols > 3 * n_words then 4 else 0 end
        + case when n_lines >= 4 and 100 * n_dup_lines > 30 * n_lines then 8 else 0 end
        + case when word_chars < 2 * n_words then 16 else 0 end
        + case when word_chars > 20 * n_words then 32 else 0 end)::bigint as failed_bits from m)"""
ORACLE_SQL = {
    "op4_chat_format": r"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e as (select *, regexp_replace(text, '(<|\[)(\\*)(\|turn\|>|\|text\|>|\|end\|>|\|image\|>|\|audio\|>|\|document\|>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|startoftext\|>|INST\]|/INST\]|SYS>|/SYS>|s>|/s>|unk>)', '\1\2\\\3', 'g') as out from t)
select conv_id::bigint as conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length('<|turn|>') + length(role) + length('<|text|>') + length(out) + length('<|end|>'))::bigint as formatted_chars
from e group by conv_id""",
    "op9_top_k": """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as c from embeddings
           where embedding is not null and len(embedding) > 0 and vec_id is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
q as (select * from v where vec_id % 50 = 0),
s as (select q.vec_id as query_id, v.vec_id, list_sum(list_transform(range(1, len(q.c) + 1), lambda i: q.c[i] * v.c[i]))::bigint as score
      from q join v on q.vec_id <> v.vec_id)
select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score
from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= 5""",
    "op7_quality_rules": _LEDGER + """
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed_bits & 3) <> 0 as base_failed, failed_bits = 0 as kept, failed_bits from b""",
    "rules_ablation": _LEDGER + """,
r as (select * from (values (0, 'few_words'), (1, 'repeated_windows'), (2, 'symbols'), (3, 'repeated_lines'), (4, 'short_words'), (5, 'long_words')) t(bit, rule))
select bit::int as bit, rule, count(*) filter (where failed_bits & (1 << bit) <> 0)::bigint as fails, count(*) filter (where failed_bits = (1 << bit))::bigint as fails_alone,
  count(*) filter (where failed_bits = 0 or failed_bits = (1 << bit))::bigint as kept_without
from b cross join r group by bit, rule""",
}
