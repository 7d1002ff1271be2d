"""The queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.text import bind
from feedloom.llm import metric_join, ownership, periodic, pseudo_likelihood, quality_crf, setsketch, suffix_dedup, templates, toxicity, vgram
from feedloom.llm.bitplane import read_token_files, write_token_files
from feedloom.llm.common import held_out, ship_package, table
from feedloom.llm.onebit import nearest
from feedloom.llm.packing import pack


def _learnable(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """Labels that a fit may use: ids whose crc32 leaves a remainder."""
    return table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))).select("doc_id", F.col(label).alias("label"))


def _judged(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op1_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = quality_crf.fit(docs, _learnable(spark, sf_dir, "quality"))
    return _judged(quality_crf.score(docs, chain), 0.3)


def op10_toxic_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _learnable(spark, sf_dir, "toxic"))
    return _judged(toxicity.score(docs, model), 0.5)


def op2_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = templates.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "covered", "n_windows", "coverage", "reworded")


def op3_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op4_induced_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.removal(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_jaccard_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = metric_join.join(table(spark, sf_dir, "documents"))
    return members.select("doc_id", "n_shingles", "component_id")


def op6_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pseudo_likelihood.tokenised(table(spark, sf_dir, "documents"))
    return pseudo_likelihood.score(rows, pseudo_likelihood.train(rows))


def op7_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(table(spark, sf_dir, "documents")))


def op8_one_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op9_secret_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ownership.digest_of(ownership.scan(table(spark, sf_dir, "documents")))


def op11_variable_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = vgram.vocabulary(table(spark, sf_dir, "documents"), slips=199)
    return vgram.group_variants(words).select("word", "n", "n_near", "form", "form_n", "root")


def _made_periodic(doc_id: Column, text: Column) -> Column:
    """The contract's text: of ids whose crc32 ends in 0, the words from some place on repeat with some period."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def periodic_words(words: Column) -> Column:
        n = F.size(words)
        at = (g % n).cast("int")
        period = (1 + F.floor((n - at) / (3 + g % 8))).cast("int")
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i < at, i).otherwise(at + (i - at) % period)))

    joined = bind(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), lambda words: F.when(F.size(words) > 0, F.array_join(periodic_words(words), " ")).otherwise(F.lit("")))
    return F.when(h % 10 == 0, joined).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", _made_periodic(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic.periodic_runs(docs)
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, x: F.when(x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best))
    lines = F.array_join(F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n"))), "")
    digests = F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), *digests)
    measures = F.col("best.start"), F.col("best.length"), F.col("best.period"), F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli")
    return found.select("doc_id", "n_runs", *measures, "runs_sha256", "collapsed_sha256")


def op13_setsketch_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = setsketch.near_copies(table(spark, sf_dir, "documents"))
    return members.select("doc_id", "n_shingles", "component_id", "kept")


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: _shipped(query)
    for query in (
        op1_quality_crf,
        op2_template_leaks,
        op3_mixture_packing,
        op4_induced_suffixes,
        op5_jaccard_regions,
        op6_pseudo_likelihood,
        op7_bit_planes,
        op8_one_bit_codes,
        op9_secret_owners,
        op10_toxic_lexicon,
        op11_variable_grams,
        op12_periodic_runs,
        op13_setsketch_copies,
    )
}
