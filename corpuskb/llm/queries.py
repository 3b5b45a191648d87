"""The queries of the llm operators over the driver's tables: thin wrappers that give each contract's columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpuskb.llm import align, balance, bpe, chat, minhash, mixing, packing, periodic, pii, quality, repeats, rules, winnow
from corpuskb.llm.store import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BPE ids of every document by the streaming transducer, decoded again; no SQL can express it."""
    return bpe.encode_decode(table(spark, sf_dir, "documents"), VOCABULARY)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document: five-word shingles, similarity 0.8 or more."""
    return minhash.classes(table(spark, sf_dir, "documents"))


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that start elsewhere too; no SQL can express it at this size."""
    return repeats.digests(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics of every document and the isolation forest's verdict."""
    docs = table(spark, sf_dir, "documents")
    return rules.judge(docs, rules.fit(docs, table(spark, sf_dir, "labels")))


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowing fingerprints of every document and of its edited text."""
    return winnow.compare(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens in windows of 2048, one row per piece."""
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY, 2048, 1)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted, encoded with loss masks and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], rows.schema)
    return chat.digests(chat.format_conversations(rows.unionByName(extra), VOCABULARY))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: the base patterns' spans and those that the tagger adds."""
    return pii.digests(pii.find(table(spark, sf_dir, "documents"), pii.trained()))


def op9_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and mixed-context scores of every document."""
    return mixing.score(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under the weak-label model fitted on the corpus."""
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of tokens of two vocabularies in every document, and what its linked pairs weigh in the corpus."""
    return align.summarize(table(spark, sf_dir, "documents"), VOCABULARY, PIECES)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, some given a periodic tail first."""
    return periodic.digests(periodic.find(periodic.planted(table(spark, sf_dir, "documents"))))


def op13_entropy_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all documents takes of each, sources weighing 1, 2, 3, repeating."""
    return balance.mix(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_minhash": op2_minhash,
    "op3_suffix_array": op3_suffix_array,
    "op4_quality_rules": op4_quality_rules,
    "op5_winnowing": op5_winnowing,
    "op6_packing": op6_packing,
    "op7_chat": op7_chat,
    "op8_pii": op8_pii,
    "op9_context_mixing": op9_context_mixing,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_align": op11_align,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_entropy_balance": op13_entropy_balance,
}

ORACLE_SQL: dict[str, str] = {}
