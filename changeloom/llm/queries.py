"""The registered queries of this package: one per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from changeloom.llm import collocations, contamination, exact, lines, lm, mixing, near, packing, pages, pii, repair, tokens, toxicity
from changeloom.llm.tables import read


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup(read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(read(spark, sf_dir, "pages"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.dedup(read(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(read(spark, sf_dir, "documents")).drop("_doc", "_doc2")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("_doc", "_doc2")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find(read(spark, sf_dir, "documents")))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(read(spark, sf_dir, "conversations"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("ids")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fuzzy_lines": op1,
    "op2_main_text": op2,
    "op3_mix_sources": op3,
    "op4_count_tokens": op4,
    "op5_toxicity": op5,
    "op6_exact_dedup": op6,
    "op7_near_duplicates": op7,
    "op8_decontaminate": op8,
    "op9_lattice_score": op9,
    "op10_personal_data": op10,
    "op11_collocations": op11,
    "op12_repair_conversations": op12,
    "op13_pack_along_curve": op13,
}
