"""Queries of the corpus operators over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.llm import alignment, language, personal_data, secrets, toxicity
from docfold.llm.common import table
from docfold.llm.decontaminate import find_overlaps, overlap_digest
from docfold.llm.exact_fit import pack_whole
from docfold.llm.fingerprints import compare_with_edits, lexicon
from docfold.llm.line_dedup import delete_repeated_lines
from docfold.llm.near_duplicates import near_duplicate_groups
from docfold.llm.packing import pack, with_checksums
from docfold.llm.periodic_runs import periodic_runs, runs_digest, with_planted_repeats
from docfold.llm.wavelet import read_shards, shard_documents, write_shards


def op1_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.scan(table(spark, sf_dir, "documents")))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents"))


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = toxicity.fold(docs, 4) == 2
    model = language.train(docs.where(~held_out))
    found = language.predict(docs, model)
    return found.select("doc_id", (toxicity.fold(found, 4) == 2).alias("held_out"), "lang_pred", "score", F.to_json("mixture").alias("mixture"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    classifier = toxicity.train(docs, labels.where(toxicity.fold(labels, 5) != 0))
    found = toxicity.score(docs.select("doc_id", "text"), classifier)
    score = F.col("toxicity")
    return found.select("doc_id", (toxicity.fold(found, 5) == 0).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = delete_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc.doc_id", "n_lines", "n_deleted", F.sha2("text", 256).alias("text_sha256"))


def op6_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_shards(spark, write_shards(table(spark, sf_dir, "documents"), end_id=2)))


def op7_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return compare_with_edits(docs, lexicon(docs))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_digest(find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_digest(personal_data.scan(table(spark, sf_dir, "documents")))


def op10_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_checksums(pack(table(spark, sf_dir, "documents"), end_id=1))


def op11_exact_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_whole(table(spark, sf_dir, "documents"), end_id=0).drop("ids")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))[0]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_digest(periodic_runs(with_planted_repeats(table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_ownership": op1_secret_ownership,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_language_mixture": op3_language_mixture,
    "op4_toxicity": op4_toxicity,
    "op5_line_dedup": op5_line_dedup,
    "op6_wavelet_shards": op6_wavelet_shards,
    "op7_imatch_fingerprints": op7_imatch_fingerprints,
    "op8_decontamination": op8_decontamination,
    "op9_personal_data": op9_personal_data,
    "op10_curve_packing": op10_curve_packing,
    "op11_exact_fit": op11_exact_fit,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {}
