"""Registered queries of the operators: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from panelforge.llm import (exact_dedup, html_main, line_dedup, lm_scoring, mixing, ngram_join, packing, pii, quality_rules, token_alignment,
                            token_counts, warc_zip, whitening)
from panelforge.llm.common import table
from panelforge.llm.production import MIX_WEIGHTS, mixing_tree

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return keep


@query("op1_lm_scoring")
def op1(spark, sf_dir):
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op2_exact_dedup", oracle="""
with d as (
  select doc_id, length(coalesce(text, '')) as n,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') as norm from documents),
g as (select *, count(*) over (partition by norm) as group_size,
             first_value(doc_id) over (partition by norm order by n desc, doc_id) as keep_id from d)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from g
""")
def op2(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("fingerprint")


@query("op3_token_counts")
def op3(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op4_quality_rules")
def op4(spark, sf_dir):
    entries = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")))
    return entries.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed", "policy")


@query("op5_ngram_join")
def op5(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).drop("tkey")


@query("op6_warc")
def op6(spark, sf_dir):
    return warc_zip.archive_pages(table(spark, sf_dir, "pages")).drop("url")


@query("op7_packing")
def op7(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_mixing")
def op8(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), mixing_tree(), 0.5, MIX_WEIGHTS, max_epochs=2).drop("tk")


@query("op9_html_main")
def op9(spark, sf_dir):
    return html_main.main_text(table(spark, sf_dir, "pages"))


@query("op10_line_dedup")
def op10(spark, sf_dir):
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


@query("op11_pii")
def op11(spark, sf_dir):
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "n_added")


@query("op12_token_alignment")
def op12(spark, sf_dir):
    return token_alignment.token_alignment(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
        ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern=public_tokenizers.PATTERN)


@query("op13_whitening")
def op13(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)
