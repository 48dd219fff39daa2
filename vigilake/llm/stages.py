"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns a DataFrame.

All but the last return the columns they are given, whatever their names. What leaves a stage is told by a
bitmap first, so that the texts that stay are not shuffled.
"""

from __future__ import annotations

import hashlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.llm import bpe, cotrain, mixing, parity, pii
from vigilake.llm.queries import MIX_LEVELS, MIX_WEIGHTS, WORD_BPE, table, with_domain
from vigilake.plans.sieve import hashed, maybe_among
from vigilake.session import materialise


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return cotrain.accepted(docs, table(spark, sf_dir, "labels"))


def among(docs: DataFrame, marks: DataFrame, columns: list) -> tuple[DataFrame, DataFrame]:
    """(rows that cannot be in `marks`, the others), told by a bitmap of the marks' keys: only the others go through a join."""
    held = maybe_among(marks, F.col("key"), marks.count())
    return docs.filter(~held(hashed(*columns))), docs.filter(held(hashed(*columns)))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the row of the smallest id stays.

    Groups are of texts, whatever their ids: different texts of one id are no copies and all stay, copies without
    an id go like others (an id comes before none). Of equal texts of one id the least row stays. Texts without
    words are no copies of each other.
    """
    rows, _, grouped = parity.linked(docs, 5, parity.Bands(80), nulls=True)
    own = rows.filter("node IS NOT NULL").join(grouped, "node", "left").select("doc_id", "row", F.coalesce("component", "node").alias("c"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    first = own.groupBy("c").agg(F.min(order).alias("f"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # of a group's rows all but the first go; of the first's own id and text there may be several rows
    told = own.join(first, "c").withColumn("keep", order == F.col("f")).groupBy("doc_id", "row").agg(F.max("keep").alias("keep"), F.count(F.lit(1)).alias("n"))
    text = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    marks = materialise(told.filter("NOT keep OR n > 1").select("doc_id", "row", "keep", hashed("doc_id", "row").alias("key")), "marks")
    free, near = among(docs, marks, [F.col("doc_id").cast("long"), text])
    x, y = near.select(F.struct(*docs.columns).alias("whole"), F.col("doc_id").cast("long").alias("_id"), text.alias("_row")), marks.select(F.col("doc_id").alias("_of"), F.col("row").alias("_text"), "keep")
    met = x.join(y, F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_row") == F.col("_text")), "left").filter("keep IS NULL OR keep")
    again = met.filter("keep").groupBy("_id", "_row").agg(F.min("whole").alias("whole"))
    return free.unionByName(met.filter("keep IS NULL").select("whole.*")).unionByName(again.select("whole.*"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind; `n_chars` follows the text."""
    clean = pii.redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Four fifths of the tokens by the weights of domain, language and source; a document stays whole, and once."""
    taken = mixing.mix(with_domain(docs), MIX_LEVELS, MIX_WEIGHTS, percent=80, max_epochs=1)
    rest = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().join(taken.select("doc_id").distinct().withColumnRenamed("doc_id", "t"), F.col("doc_id").eqNullSafe(F.col("t")), "left_anti")
    marks = materialise(rest.select("doc_id", hashed("doc_id").alias("key")), "left")
    free, near = among(docs, marks, [F.col("doc_id").cast("long")])
    whole = near.select(F.struct(*docs.columns).alias("whole"), F.col("doc_id").cast("long").alias("_id"))
    kept = whole.join(marks.select(F.col("doc_id").alias("_of")), F.col("_id").eqNullSafe(F.col("_of")), "left_anti")
    return free.unionByName(kept.select("whole.*"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of all texts, their number and the digest of their decoding join the document's columns."""
    path = public_tokenizers.path(WORD_BPE)

    @F.arrow_udf("ids array<int>, decoded_sha256 string")
    def coded(texts: pa.Array) -> pa.Array:
        ids = bpe.encoder(path).array(texts)
        digests = [hashlib.sha256(t.as_py().encode()).hexdigest() for t in bpe.decode_array(ids, path)]
        return pa.StructArray.from_arrays([ids, pa.array(digests, pa.string())], ["ids", "decoded_sha256"])

    # columns of these names, in any case, give way
    own = [c for c in docs.columns if c.lower() not in ("ids", "decoded_sha256", "n_tokens")]
    both = docs.select(F.struct(*own).alias("whole"), coded("text").alias("coded"))
    return both.select("whole.*", "coded.*", F.size("coded.ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_near_copies),
    ("personal data", without_personal_data),
    ("mixing sources to target weights", mixed),
    ("BPE encoding and decoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on what its predecessor kept, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"stage{i}")
    return docs
