"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowsluice.llm import oracles
from rowsluice.llm.align import TokenAligner
from rowsluice.llm.common import documents, piece_model_path, tokenizer_path
from rowsluice.llm.decontaminate import Decontaminator
from rowsluice.llm.jaccard import JaccardJoin
from rowsluice.llm.licenses import LicenseScanner
from rowsluice.llm.merkle import MerkleManifest, folded, proof
from rowsluice.llm.packing import Packer
from rowsluice.llm.pieces import PieceTokenizer
from rowsluice.llm.pii import KINDS, ContextExtractor, listed
from rowsluice.llm.quality import COUNTS, LineFrequency
from rowsluice.llm.simple8b import TokenFiles
from rowsluice.llm.suffix_arrays import FactorDedup
from rowsluice.llm.suffix_trees import SubstringDedup
from rowsluice.llm.toxicity import ToxicityModel, held_out

AZ_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ContextExtractor().extracted(documents(spark, sf_dir))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return Decontaminator().judged(documents(spark, sf_dir), benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SubstringDedup().digested(documents(spark, sf_dir))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return JaccardJoin().joined(documents(spark, sf_dir))


def op5_factor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FactorDedup(keep_first=False).digested(documents(spark, sf_dir))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Packer(tokenizer_path()).packed(documents(spark, sf_dir))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LicenseScanner().scanned(documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, model = documents(spark, sf_dir), ToxicityModel()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out())
    scored = model.score(docs, model.fit(docs, labels))
    predicted = (F.col("score") >= model.threshold).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # its SQL lets a rejected document be the first with a line
    judged = LineFrequency(first_passing=False).judged(documents(spark, sf_dir))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", F.col("n_removed").alias("n_line_words"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TokenFiles(tokenizer_path()).round_trip(documents(spark, sf_dir))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # where 3 divides the id's checksum, the text is changed to lower case behind the manifest's back
    lower = F.translate("text", AZ_UPPER, AZ_UPPER.lower())
    is_tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tree = MerkleManifest()
    found = tree.proved(documents(spark, sf_dir), tampered=F.when(is_tampered, tree.leaf(text=lower)))
    refolded = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), refolded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TokenAligner(tokenizer_path(), piece_model_path()).aligned(documents(spark, sf_dir))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PieceTokenizer(piece_model_path()).digested(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (op1_pii, op2_decontaminate, op3_substring_dedup, op4_jaccard_join, op5_factor_dedup, op6_best_fit_packing, op7_license_scan, op8_toxicity, op9_quality_rules, op10_token_files, op11_merkle_manifest, op12_token_alignment, op13_sentencepiece)
}
ORACLES = {"op2_decontaminate": oracles.DECONTAMINATE, "op9_quality_rules": oracles.QUALITY, "op11_merkle_manifest": oracles.MERKLE}
