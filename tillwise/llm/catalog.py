"""One query per operator over its whole intended table. The queries derive
the columns of their contracts from the operators' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare
from . import align, ann, chat, language_id, merges, mixing, oracle, packing, quality_model, quality_rules, runs, secret_scan, simhash, textio, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(textio.bounded_batches(prepare(spark)), sf_dir)
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_prefix_target_chat")
def op1(spark, sf_dir):
    """All conversations and one of control strings, formatted and read back."""
    text = "</s>[INST] ok [/INST]"
    turns = textio.read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return chat.digests(chat.examples(turns.unionByName(extra)))


@query("op2_minimum_slack_packing")
def op2(spark, sf_dir):
    """All documents, tokenised and packed into sequences of 1024 ids."""
    return packing.pack_documents(textio.read_table(spark, sf_dir, "documents"), tokenizer_path())


@query("op3_entropy_secrets")
def op3(spark, sf_dir):
    """Secrets of every document: base counts and digest, all spans."""
    return secret_scan.scan_documents(textio.read_table(spark, sf_dir, "documents"))


@query("op4_risk_controlled_rules")
def op4(spark, sf_dir):
    """Measures and verdict of every document."""
    return quality_rules.judge(textio.read_table(spark, sf_dir, "documents"), textio.read_table(spark, sf_dir, "labels"))


@query("op5_subword_quality")
def op5(spark, sf_dir):
    """Quality of every document; labels of remainder 2 are held out."""
    docs = textio.read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(textio.id_crc_mod("doc_id", 4) == 2, F.lit(False))
    model = quality_model.fit(quality_model.labelled(docs, textio.read_table(spark, sf_dir, "labels"), "quality", ~held_out))
    scored = quality_model.score(docs.select("doc_id", "text", held_out.alias("held_out")), model, ("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query("op6_toxicity_chain")
def op6(spark, sf_dir):
    """Toxicity of every document: probability per category, verdict."""
    docs = textio.read_table(spark, sf_dir, "documents")
    chain = toxicity.fit(docs, textio.read_table(spark, sf_dir, "labels"))
    return toxicity.predict(docs, chain)


@query("op7_kmeans_tree_search")
def op7(spark, sf_dir):
    """Nearest neighbours of every hundredth vector among all vectors."""
    rows = textio.read_table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.filter(F.col("vec_id") % 100 == 0))


@query("op8_segment_popcount_simhash")
def op8(spark, sf_dir):
    """Near duplicates of all documents: fingerprint and component."""
    found = simhash.near_duplicates(textio.read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


@query("op9_curriculum_mixing")
def op9(spark, sf_dir):
    """The mix of all documents, sorted by training position."""
    mixed = mixing.in_training_order(mixing.mix(textio.read_table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.size("copies").alias("n_copies"), "position")


@query("op10_naive_bayes_language")
def op10(spark, sf_dir):
    """Language of every document; remainder 1 is held out."""
    docs = textio.read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(textio.id_crc_mod("doc_id", 3) == 1, F.lit(False))
    model = language_id.fit(docs.filter(~held_out).filter("doc_id IS NOT NULL"))
    return language_id.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model, ("doc_id", "held_out"))


@query("op11_merge_backtracking")
def op11(spark, sf_dir):
    """All documents encoded with the piece vocabulary, an end id behind, and decoded."""
    model = tokenizer_path("piece_bpe_32k.model")
    return merges.digests(merges.encode(textio.read_table(spark, sf_dir, "documents"), model, end_id=2), model)


@query("op12_tokenizer_spans")
def op12(spark, sf_dir):
    """Tokens of both vocabularies of all documents, grouped and linked by bytes."""
    docs = textio.read_table(spark, sf_dir, "documents")
    return align.digests(align.align_and_score(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"), hash_groups=True))


@query("op13_periodic_runs")
def op13(spark, sf_dir):
    """Runs in the words of all documents, of every tenth with a repeated tail."""
    return runs.digests(runs.runs(runs.with_repeated_tails(textio.read_table(spark, sf_dir, "documents"))))


ORACLE_SQL |= {"op1_prefix_target_chat": oracle.OP1, "op4_risk_controlled_rules": oracle.op4(),
               "op9_curriculum_mixing": oracle.op9()}
