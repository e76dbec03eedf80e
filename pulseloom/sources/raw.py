"""Raw messages: ``(msg_id bigint, received_ts timestamp, payload string)``.

The same reader serves batch and streaming; only ``spark.read`` versus
``spark.readStream`` differs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

RAW_SCHEMA = "msg_id bigint, received_ts timestamp, payload string"

# Fixed value: broker topics are UWB/<gateway>_<type>.
_TOPIC = r"^UWB/(.+)_([^_]+)$"


def _kafka_id() -> Column:
    # offsets count per topic and partition, so all three name a record
    return F.xxhash64("topic", "partition", "offset")


def read_raw(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
             streaming: bool = False, **options: str) -> DataFrame:
    """Messages from a folder (``parquet``, ``json``, ``text``) or from ``kafka``.

    Text files hold one JSON message per line, and their modification time is the
    arrival time; equal lines of one file share an id. Kafka values are UTF-8 bytes and carry their own record time;
    it needs the connector package on the class path.
    """
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        return reader.format("kafka").options(**options).load().select(
            _kafka_id().alias("msg_id"),
            F.col("timestamp").alias("received_ts"),
            F.col("value").cast("string").alias("payload"),
            "topic",
        )
    if fmt == "text":
        lines = reader.format("text").options(**options).load(path)
        return lines.select(
            F.xxhash64("_metadata.file_path", "value").alias("msg_id"),
            F.col("_metadata.file_modification_time").alias("received_ts"),
            F.col("value").alias("payload"),
        )
    return reader.format(fmt).schema(RAW_SCHEMA).options(**options).load(path)


def decodable(raw: DataFrame, column: str = "payload") -> DataFrame:
    """Messages whose bytes are UTF-8, with the text in place of the bytes; a null stays null."""
    text = F.col(column).cast("string")
    return raw.withColumn(column, text).filter(F.col(column).isNull() | F.is_valid_utf8(column))


def undecodable(raw: DataFrame, column: str = "payload") -> DataFrame:
    """Dead letters of the other messages: their bytes in base64, which text can carry."""
    bad = raw.filter(~F.is_valid_utf8(F.col(column).cast("string")))
    text = F.translate(F.base64(F.col(column).cast("binary")), "\r\n", "")  # in one line
    return bad.select("msg_id", "received_ts", text.alias("payload_base64"),
                      F.lit("invalid").alias("route"), F.array(F.lit("invalid_utf8")).alias("reasons"))


def decode(raw: DataFrame, column: str = "payload") -> DataFrame:
    """Binary payloads to text."""
    return raw.withColumn(column, F.col(column).cast("string"))


def split_topic(messages: DataFrame, topic: str = "topic") -> DataFrame:
    """Add ``topic_gateway`` and ``topic_kind``; both empty when the name does not match."""
    return messages.withColumns({
        "topic_gateway": F.regexp_extract(topic, _TOPIC, 1),
        "topic_kind": F.regexp_extract(topic, _TOPIC, 2),
    })


def stamped_payload(received: Column, payload: Column) -> Column:
    """Payload object with the arrival time appended as ``receivedAt``."""
    stamp = F.date_format(received, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    body = F.regexp_extract(F.trim(payload), r"^(?s)\{(.*)\}$", 1)
    return F.concat(F.lit("{"), body, F.when(F.trim(body) != "", ",").otherwise(""),
                    F.lit('"receivedAt":"'), stamp, F.lit('"}'))
