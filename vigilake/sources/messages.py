"""Raw messages: envelopes, streams, files, and the platform's own heartbeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.functions.jsonfn import jtext, jv
from vigilake.sources.rules import HEARTBEAT_SOURCE

CLOUDTRAIL_FILE = r"(?i)\d+_cloudtrail_.+.json.gz$"
NO_DATA = "No data in Pub/Sub message"  # fixed value


def as_raw_log(line: Column) -> Column:
    """A line of text as a message of its own."""
    return F.to_json(F.struct(line.alias("raw_log")))


def decode_envelope(raw: DataFrame, col: str = "value") -> DataFrame:
    """Unwrap push envelopes `{"message": {"data": base64}}`.

    Adds `text` (a JSON object) and `problem` (NULL, or why the row belongs in quarantine). Data that is
    no JSON becomes `{"raw_log": ...}`.
    """
    env = F.try_parse_json(F.col(col).cast("string"))
    message = F.try_variant_get(env, "$.message", "variant")
    data = jv(message, ["data"])
    binary = F.try_to_binary(data, F.lit("base64"))
    plain = F.trim(F.when(F.is_valid_utf8(binary.cast("string")), binary.cast("string")))
    doc = F.try_parse_json(plain)
    text = (
        F.when(message.isNull(), F.lit(None))
        .when(data.isNull(), as_raw_log(F.lit(NO_DATA)))
        .when(doc.isNull(), as_raw_log(plain))
        .otherwise(plain)
    )
    problem = (
        F.when(message.isNull(), "invalid envelope")
        .when(data.isNotNull() & plain.isNull(), "undecodable data")
        .when(doc.isNotNull() & ~plain.rlike(r"^\s*\{"), "not a JSON object")
    )
    return raw.withColumns({"text": text, "problem": problem})


def split_quarantine(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, refused) rows of `decode_envelope`."""
    return decoded.filter(F.col("problem").isNull()), decoded.filter(F.col("problem").isNotNull())


def cloudtrail_files(df: DataFrame, path: Column | str | None = None) -> DataFrame:
    """Rows read from CloudTrail log files, told by file name."""
    name = F.col("_metadata.file_path") if path is None else (F.col(path) if isinstance(path, str) else path)
    return df.filter(name.rlike(CLOUDTRAIL_FILE))


def read_event_stream(spark: SparkSession, fmt: str = "text", path: str | None = None, **options: str) -> DataFrame:
    """Continuous raw messages: files that appear in a folder, or a Kafka topic (`fmt='kafka'`)."""
    reader = spark.readStream.format(fmt).options(**options)
    df = reader.load(path) if path else reader.load()
    return df.withColumn("value", F.col("value").cast("string"))


def heartbeat_events(
    spark: SparkSession, published: int, failed: int, rules_loaded: int, source: str = HEARTBEAT_SOURCE
) -> DataFrame:
    """The canary of one detection tick as a raw message; it takes the ordinary way through ingest."""
    row = spark.range(1)
    lit = {"published": published, "failed": failed, "rules_loaded": rules_loaded}
    details = F.struct(
        F.lit("detection").alias("service"), F.lit("cron").alias("heartbeat"), *[F.lit(v).alias(k) for k, v in lit.items()]
    )
    body = F.struct(
        F.lit(source).alias("source"), F.lit("deadman").alias("category"), F.lit("INFO").alias("severity"),
        F.lit(f"detection heartbeat: {published} published, {failed} failed, {rules_loaded} rules loaded").alias("summary"),
        F.array(F.lit("heartbeat"), F.lit("detection")).alias("tags"), details.alias("details"),
    )
    return row.select(F.to_json(body).alias("value"))


__all__ = [
    "decode_envelope", "split_quarantine", "cloudtrail_files", "read_event_stream", "heartbeat_events", "jtext",
]
