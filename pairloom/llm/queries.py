"""The registered queries of the subpackage: each operator over its whole table, as digest columns."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.llm import (archives, decontaminate, egojoin, jaccard, langid, mixing, oracles, orctokens, packing, quality, runs, spelling,
                          substrings, tokencount)
from pairloom.llm.ship import prepare
from pairloom.session import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op3_arc_to_warc": oracles.OP3, "op6_substring_dedup": oracles.OP6, "op7_benchmark_decontamination": oracles.OP7,
    "op8_ngram_jaccard_join": oracles.OP8, "op9_embedding_near_dedup": oracles.OP9,
    "op11_sainte_lague_mix": oracles.OP11,
}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in its sequence."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "bucket")


@query
def op5_orc_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as the ORC files give it back."""
    path = new_folder(spark, "orc-ids")
    orctokens.write_token_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    stored = orctokens.read_token_ids(spark, path)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            flat = np.asarray(lists.flatten()).astype("<u4")
            edges = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))]).tolist()
            crcs = [zlib.crc32(flat[a:b]) for a, b in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crcs, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = stored.schema["doc_id"].dataType.simpleString()
    return stored.mapInArrow(digest, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


@query
def op10_merged_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op3_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through ARC files of both versions into WARC files and back."""
    arc, warc = new_folder(spark, "arc"), new_folder(spark, "warc")
    archives.write_arc(table(spark, sf_dir, "pages"), arc)
    archives.convert(spark, arc, warc)
    return archives.read_warc(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and occurring items of every document."""
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words kept of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = substrings.remove_repeats(docs)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def held_out():
    """Rows whose labels nothing may learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_quality(spark: SparkSession, sf_dir: str) -> quality.Model:
    """The quality model of the labelled documents that are not held out."""
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    return quality.fit(table(spark, sf_dir, "documents"), labels, label_col="quality")


@query
def op1_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, fit_quality(spark, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; beyond the calibrated limit it is marked, not hidden."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(~held_out()), F.col("text"), F.col("lang"))
    named = langid.identify(docs.select("doc_id", "text"), model, reject=False)
    return named.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "entropy", "rejected")


@query
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity component of every document: four-word shingles, 0.85."""
    found = jaccard.similarity_classes(table(spark, sf_dir, "documents"), k=4, percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query
def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector: cosine of 0.95 or more."""
    return egojoin.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op11_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    found = mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), repeats=3)
    return found.select("doc_id", "size", "source_size", "target", "taken", "source")


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word of six characters and five occurrences."""
    words = spelling.count_runs(table(spark, sf_dir, "documents"), least_length=6, slip_every=199)
    return spelling.spelling_variants(words.filter("n >= 5"), ratio=5)


def with_loops(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the texts, chosen by id, go round a few of their own words from some place on."""
    prepare(docs.sparkSession, 8)

    def looped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = zlib.crc32(str(ident).encode()) if ident is not None else 1
                own = text.encode().split() if text is not None and h % 10 == 0 else []
                if own:
                    g, n = h // 10, len(own)
                    start = g % n
                    period = 1 + (n - start) // (3 + g % 8)
                    loop = own[start:start + period]
                    own[start:] = [loop[i % period] for i in range(n - start)]
                    text = b" ".join(own).decode()
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(looped, f"doc_id {kind}, text string")


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, some of which were made to repeat themselves."""
    found = runs.collapse_runs(with_loops(table(spark, sf_dir, "documents")))
    ranked = lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    first = F.array_min(F.transform("runs", ranked))
    length, period = -first["less"], first["period"]
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), first["start"].alias("start"), length.alias("length"), period.alias("period"),
        F.call_function("div", 1000 * length, period).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
