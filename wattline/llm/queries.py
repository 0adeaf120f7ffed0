"""The registered queries of the operators: name -> (query, SQL or None)."""

from __future__ import annotations

import corpus_pipeline
from wattline.llm import chat, collocations, contamination, lines, merkle, mixing, neardup, packing, pii, quality, sharding, structure, toxicity
from wattline.llm.common import table


def op1_mixing(spark, sf_dir):
    return mixing.report(table(spark, sf_dir, "documents"))


def op2_quality(spark, sf_dir):
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_near_duplicates(spark, sf_dir):
    return neardup.report(table(spark, sf_dir, "documents"))


def op4_toxicity(spark, sf_dir):
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_chat(spark, sf_dir):
    return chat.report(table(spark, sf_dir, "conversations"))


def op6_pii(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark, sf_dir):
    return lines.report(table(spark, sf_dir, "documents"))


def op8_fingerprints(spark, sf_dir):
    return merkle.report(table(spark, sf_dir, "documents"))


def op9_sharding(spark, sf_dir):
    return sharding.report(table(spark, sf_dir, "documents"))


def op10_decontamination(spark, sf_dir):
    return contamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_structure(spark, sf_dir):
    return structure.report(table(spark, sf_dir, "conversations"))


def op12_collocations(spark, sf_dir):
    return collocations.report(table(spark, sf_dir, "documents"))


def op13_packing(spark, sf_dir):
    return packing.report(table(spark, sf_dir, "documents"))


def registered():
    return {
        "op1_mixing": (op1_mixing, mixing.REPORT_SQL),
        "op2_quality": (op2_quality, None),
        "op3_near_duplicates": (op3_near_duplicates, neardup.REPORT_SQL),
        "op4_toxicity": (op4_toxicity, None),
        "op5_chat": (op5_chat, chat.REPORT_SQL),
        "op6_pii": (op6_pii, None),
        "op7_line_dedup": (op7_line_dedup, lines.REPORT_SQL),
        "op8_fingerprints": (op8_fingerprints, merkle.REPORT_SQL),
        "op9_sharding": (op9_sharding, sharding.REPORT_SQL),
        "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
        "op10_decontamination": (op10_decontamination, contamination.REPORT_SQL),
        "op11_structure": (op11_structure, structure.REPORT_SQL),
        "op12_collocations": (op12_collocations, collocations.REPORT_SQL),
        "op13_packing": (op13_packing, None),
    }
