"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketline.llm import (
    decontaminate, fill_middle, hyper_minhash, line_frequency, masked_lm, packing, pii_bootstrap, repetition, rule_ensemble, signature_tree, token_alignment,
    url_filter, warc)
from docketline.llm.common import prepare, read_table
from docketline.llm.oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file() -> str:
    """The tokenizer file's text, read on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


def piece_model() -> bytes:
    """The SentencePiece model, read on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def op1_warc_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record a page, written, normalised and read back."""
    import pyarrow as pa

    prepare(spark)
    index = warc.archive_pages(read_table(spark, sf_dir, "pages"))

    def facts(fields: dict[str, str], payload: bytes) -> tuple:
        ref = fields.get("warc-refers-to")
        number = [None if x is None or x.strip("<>").endswith(":null") else int(x.strip("<>").rpartition(":")[2])
                  for x in (fields["warc-record-id"], ref)]
        whole = fields["warc-type"] == "response"
        return (number[0], len(payload) if whole else None,
                warc.digest(payload) if whole else fields["warc-payload-digest"].removeprefix("sha1:"),
                fields["warc-type"], number[1])

    names = ["page_id", "own_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    read = warc.read_records(index, facts, pa.schema(list(zip(names, kinds))),
                             "page_id long, own_bytes long, payload_digest string, record_type string, refers_to long")
    read = warc.materialize(read, "warc-read")
    # a revisit has no payload of its own: its length is the response's
    sizes = (read.where(F.col("record_type") == "response").groupBy("page_id", "payload_digest")
             .agg(F.max("own_bytes").alias("size")).withColumnsRenamed({"page_id": "s_id", "payload_digest": "s_digest"}))
    out = read.join(sizes, (read["refers_to"] == sizes["s_id"]) & (read["payload_digest"] == sizes["s_digest"]), "left")
    return out.select("page_id", F.coalesce("own_bytes", "size").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document by the rule ensemble learnt from the labels."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return rule_ensemble.score_table(docs, read_table(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document against the benchmark."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    s = F.col("scan")
    return decontaminate.scan(docs, read_table(spark, sf_dir, "benchmark"), out="scan").select(
        "doc_id", s["n_words"].alias("n_words"), s["n_hit"].alias("n_hit"),
        F.size(s["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(s["items"], ",").cast("binary"), 256).alias("items_sha256"), (s["n_hit"] > 0).alias("contaminated"))


def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that are boilerplate on their source."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_frequency.drop_boilerplate(docs, "source", counts=("n_lines", "n_dropped"))


def op6_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition coverage and verdict of every document."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    m = F.col("m")
    return docs.select("doc_id", repetition.measures(F.col("text")).alias("m")).select(
        "doc_id", *[m[k].alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        repetition.base_failed(m).alias("base_failed"), (~repetition.base_failed(m) & repetition.verdict(m)).alias("kept"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    prepare(spark)
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, out="j").select("page_id", "j.host", "j.path", "j.rule", "j.verdict")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    prepare(spark)
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_file())


def op3_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihood of every document."""
    prepare(spark)
    return masked_lm.score(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_signature_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    prepare(spark)
    found = signature_tree.link_components(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op10_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base spans and discovered ones."""
    prepare(spark)
    found = pii_bootstrap.extract(read_table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii_bootstrap.KINDS]
    return found.select(F.col("id").alias("doc_id"), *counts,
                        F.sha2(pii_bootstrap.span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        pii_bootstrap.span_text(F.col("spans")).alias("spans"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of every document's tokens under two tokenizers."""
    prepare(spark)
    found = token_alignment.align(read_table(spark, sf_dir, "documents"), tokenizer_file(), piece_model())
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    found = token_alignment.write(found.withColumn("groups_sha256", digest).drop("groups"))
    scored = token_alignment.score(found, token_alignment.link_table(found))
    return scored.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_hyper_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and near-duplicate group of every document, and whether it stays."""
    prepare(spark)
    found = hyper_minhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                        F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and cuts of every document, checksums of its output and of the text rebuilt from it."""
    prepare(spark)
    f = F.col("fim")
    return fill_middle.transform(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", *[f[k].alias(k) for k in ("n", "form", "prefix_chars", "middle_chars")],
        F.sha2(f["output"].cast("binary"), 256).alias("output_sha256"),
        F.sha2(fill_middle.restore(f["output"], f["form"]).cast("binary"), 256).alias("restored_sha256"))


QUERIES: dict[str, Query] = {
    "op1_warc_normalise": op1_warc_normalise,
    "op2_quality_rules": op2_quality_rules,
    "op3_masked_lm": op3_masked_lm,
    "op4_decontaminate": op4_decontaminate,
    "op5_line_frequency": op5_line_frequency,
    "op6_repetition": op6_repetition,
    "op7_url_filter": op7_url_filter,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_signature_tree": op9_signature_tree,
    "op10_pii_bootstrap": op10_pii_bootstrap,
    "op11_token_alignment": op11_token_alignment,
    "op12_hyper_minhash": op12_hyper_minhash,
    "op13_fill_middle": op13_fill_middle,
}

__all__ = ["ORACLE", "QUERIES", "tokenizer_file"]
