"""The registered queries of the subpackage: each applies one operator with production parameters to its whole table."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.llm import article, bpe, collide, cotrain, divergence, merkle, mixing, parity, passages, pii, planes, rules, suffixes
from vigilake.session import configure, run_dir

WORD_BPE = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")  # texts are long rows
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=2)
def library_encoder(path: str) -> bpe.Encoder:
    """Texts cut and normalised as in `bpe`; the merges of each word are the tokenizers library's."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path).model
    return bpe.Encoder(path, merge=lambda word: [t.id for t in model.tokenize(word)])


def op1_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_BPE)
    folder = run_dir(spark, "planes")
    ordered = planes.in_order(table(spark, sf_dir, "documents"))
    planes.write_ids(ordered, folder, encode=lambda texts: library_encoder(path).array(texts), end=2)
    return planes.read_ids(spark, folder, {"ids_crc32": ("long", planes.crc32)})


def op10_rank_array_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_BPE)

    # the digests are taken where the ids and the decoded text are, so neither crosses to the JVM
    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pa.Array) -> pa.Array:
        ids = bpe.encoder(path).array(texts)
        decoded = bpe.decode_array(ids, path)
        numbers = pc.binary_join(ids.cast(pa.list_(pa.string())), " ")
        hashed = [pa.array([hashlib.sha256(x.as_py().encode()).hexdigest() for x in column]) for column in (numbers, decoded)]
        return pa.StructArray.from_arrays([pc.list_value_length(ids).cast(pa.int64()), *hashed], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return table(spark, sf_dir, "documents").select("doc_id", digests("text").alias("d")).select("doc_id", "d.*")


def op2_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    of = [F.expr(f"size(filter(base, x -> x.kind = {i}))").cast("long").alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *of, F.sha2(pii.spelled(F.col("base")), 256).alias("base_sha256"), pii.spelled(F.col("spans")).alias("spans"))


def op3_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collide.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0).withColumn("rank", F.col("rank").cast("int"))


def op4_lyndon_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeats(table(spark, sf_dir, "documents"), width=50)


MIX_LEVELS = ["domain", "lang", "source"]
MIX_WEIGHTS = {"domain": {"domain0": 4, "domain1": 3, "domain2": 2}, "lang": {"en": 5, "de": 2, "fr": 2}}


def with_domain(docs: DataFrame) -> DataFrame:
    """The synthetic sources have no domain; their number modulo four names one, anything else is `other`."""
    number = F.regexp_extract("source", "^src([0-9]{1,9})$", 1).try_cast("long")
    return docs.withColumn("domain", F.when(number.isNull(), "other").otherwise(F.concat(F.lit("domain"), (number % 4).cast("string"))))


DOMAIN_SQL = (
    "SELECT doc_id, lang, source, text, CASE WHEN regexp_matches(coalesce(source, ''), '^src[0-9]{1,9}$') "
    "THEN 'domain' || (substr(source, 4)::BIGINT % 4) ELSE 'other' END AS domain FROM documents"
)


def op5_hierarchical_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_domain(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
    return mixing.mix(docs, MIX_LEVELS, MIX_WEIGHTS, percent=60, max_epochs=2)


def op6_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.join(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


def op7_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.controlled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_best_region_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = article.main_text(pages, article.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeats(table(spark, sf_dir, "documents"), width=50)


def op12_perfect_hash_recount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), least=3, top=200)


MANIFEST_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def op13_nested_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    altered = F.when(merkle.picked(), merkle.leaf_of(MANIFEST_COLUMNS, {"text": merkle.lowered()}))
    found = merkle.manifest(docs, MANIFEST_COLUMNS, altered=altered)
    tested = found.withColumn("folded_root", merkle.folded(F.coalesce("altered", "leaf")))
    return tested.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


QUERIES = {
    "op1_bit_planes": (op1_bit_planes, None),
    "op2_contextual_pii": (op2_contextual_pii, None),
    "op3_collision_counting": (op3_collision_counting, None),
    "op4_lyndon_groups": (op4_lyndon_groups, None),
    "op5_hierarchical_budget": (op5_hierarchical_budget, mixing.sql(DOMAIN_SQL, MIX_LEVELS, MIX_WEIGHTS)),
    "op6_parity_sketch_join": (op6_parity_sketch_join, None),
    "op7_cotrained_quality": (op7_cotrained_quality, None),
    "op8_risk_controlled_rules": (op8_risk_controlled_rules, rules.sql()),
    "op9_best_region_text": (op9_best_region_text, None),
    "op10_rank_array_bpe": (op10_rank_array_bpe, None),
    "op11_seed_extend": (op11_seed_extend, None),
    "op12_perfect_hash_recount": (op12_perfect_hash_recount, divergence.sql(3, 200)),
    "op13_nested_rollup": (op13_nested_rollup, merkle.sql(MANIFEST_COLUMNS)),
}
