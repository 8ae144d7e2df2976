"""The registered queries of the operators: name to (query, DuckDB form or None)."""

from __future__ import annotations

from pyspark.sql import functions as F

from narrata.llm import chat, fair_mix, hard_negatives, host_rules, language, lexical_search, line_dedup
from narrata.llm import near_dup, packing, pii, simhash, token_counts, warc
from narrata.llm.common import read_table
from narrata.llm.sql import HARD_NEGATIVES_SQL, HOST_RULES_SQL, LEXICAL_SEARCH_SQL, MIX_SQL

#: The vocabulary for packing and counts.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc_derivatives(spark, sf_dir):
    return warc.page_derivatives(read_table(spark, sf_dir, "pages"))


def op2_simhash(spark, sf_dir):
    return simhash.with_near_counts(simhash.edited_fingerprints(read_table(spark, sf_dir, "documents")))


def op3_mix(spark, sf_dir):
    return fair_mix.mix(read_table(spark, sf_dir, "documents"))


def op4_host_rules(spark, sf_dir):
    return host_rules.judge(read_table(spark, sf_dir, "documents"))


def op5_pii(spark, sf_dir):
    return pii.personal_data(read_table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_chat_format(spark, sf_dir):
    return chat.chat_digests(chat.with_probe(read_table(spark, sf_dir, "conversations")))


def op8_language_id(spark, sf_dir):
    return language.identify(read_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents")
    return line_dedup.deduplicated(documents).select("doc_id", "text", "removed_lines", "removed_partners")


def op10_minhash_near_dup(spark, sf_dir):
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"), width=2)


def op11_lexical_search(spark, sf_dir):
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_token_counts(spark, sf_dir):
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op13_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    embeddings = read_table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.mine(embeddings, F.col("vec_id") % 100 == 0)


CHECKS = {
    "op1_warc_derivatives": (op1_warc_derivatives, None),
    "op2_simhash": (op2_simhash, None),
    "op3_mix": (op3_mix, MIX_SQL),
    "op4_host_rules": (op4_host_rules, HOST_RULES_SQL),
    "op5_pii": (op5_pii, None),
    "op6_best_fit_packing": (op6_best_fit_packing, None),
    "op7_chat_format": (op7_chat_format, None),
    "op8_language_id": (op8_language_id, None),
    "op9_line_dedup": (op9_line_dedup, None),
    "op10_minhash_near_dup": (op10_minhash_near_dup, None),
    "op11_lexical_search": (op11_lexical_search, LEXICAL_SEARCH_SQL),
    "op12_token_counts": (op12_token_counts, None),
    "op13_hard_negatives": (op13_hard_negatives, HARD_NEGATIVES_SQL),
}
