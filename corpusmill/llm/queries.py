"""Registered queries of the operators and their DuckDB statements, where SQL can express one."""

from __future__ import annotations

from corpusmill.llm import bpe, conversations, decontaminate, packing, pii, quality, rules, simhash, spelling, substrings, tokencount, toxicity, urlfilter
from corpusmill.llm.common import read_table


def op1_decontaminate(spark, sf_dir):
    return decontaminate.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_quality(spark, sf_dir):
    return quality.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_simhash(spark, sf_dir):
    return simhash.report(read_table(spark, sf_dir, "documents"))


def op4_pii(spark, sf_dir):
    return pii.report(read_table(spark, sf_dir, "documents"))


def op5_toxicity(spark, sf_dir):
    return toxicity.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_repeated_substrings(spark, sf_dir):
    return substrings.report(read_table(spark, sf_dir, "documents"))


def op7_token_counts(spark, sf_dir):
    return tokencount.report(read_table(spark, sf_dir, "documents"))


def op8_url_filter(spark, sf_dir):
    return urlfilter.report(read_table(spark, sf_dir, "pages"))


def op9_quality_rules(spark, sf_dir):
    return rules.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_bpe(spark, sf_dir):
    return bpe.report(read_table(spark, sf_dir, "documents"))


def op11_repair(spark, sf_dir):
    return conversations.report(read_table(spark, sf_dir, "conversations"))


def op12_packing(spark, sf_dir):
    return packing.report(read_table(spark, sf_dir, "documents"))


def op13_spelling(spark, sf_dir):
    return spelling.report(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_quality, op3_simhash, op4_pii, op5_toxicity, op6_repeated_substrings,
                                    op7_token_counts, op8_url_filter, op9_quality_rules, op10_bpe, op11_repair,
                                    op12_packing, op13_spelling)}

ORACLE_SQL = {"op1_decontaminate": decontaminate.ORACLE_SQL, "op8_url_filter": urlfilter.ORACLE_SQL}
