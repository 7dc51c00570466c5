"""The payment event stream: source factory and parsing."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import PAYMENT_EVENT

# Connection settings of the event topic.
KAFKA_OPTIONS = {
    "failOnDataLoss": "false",
    "kafka.session.timeout.ms": "30000",
    "kafka.metadata.max.age.ms": "5000",
    "kafka.request.timeout.ms": "60000",
    "kafka.connections.max.idle.ms": "540000",
    "kafka.reconnect.backoff.ms": "50",
    "kafka.reconnect.backoff.max.ms": "1000",
}


def kafka_options(
    servers: str,
    topic: str = "paymentevents",
    starting_offsets: str = "earliest",
    group: str | None = None,
    most_per_trigger: int = 1_000_000,
    **more,
) -> dict[str, str]:
    """Options of a Kafka source; ``starting_offsets`` is ``earliest`` or ``latest``.

    ``most_per_trigger`` bounds the messages of a micro-batch; else the first one
    from ``earliest`` would be the whole topic.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": str(most_per_trigger),
        **KAFKA_OPTIONS,
    }
    if group:
        options["kafka.group.id"] = group
    options.update(more)
    return options


def open_stream(spark: SparkSession, kind: str, options: dict[str, str], schema: T.StructType | None = None) -> DataFrame:
    """Streaming source of any kind: ``kafka`` needs its connector on the class path,
    file kinds (``parquet``, ``json``, ``text``) take ``path`` among the options and a schema."""
    reader = spark.readStream.format(kind).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load()


def parse_payment_events(messages: DataFrame, schema: T.StructType = PAYMENT_EVENT) -> DataFrame:
    """Typed events from messages with a ``value``; a message that is not JSON gives a row of nulls."""
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("data")).select("data.*")


def parse_or_keep(messages: DataFrame, schema: T.StructType = PAYMENT_EVENT) -> DataFrame:
    """Typed events with ``raw``, the text of the message, and ``parsed``.

    A message that is not JSON of the schema, empty or null is not parsed; then all
    fields are null, so no half of a broken message passes for an event.
    """
    corrupt = "_unparsed"
    text = F.col("value").cast("string")
    data = F.from_json(text, T.StructType([*schema, T.StructField(corrupt, T.StringType())]), {"columnNameOfCorruptRecord": corrupt})
    read = messages.select(text.alias("raw"), data.alias("data"))
    parsed = F.col("data").isNotNull() & F.col(f"data.{corrupt}").isNull() & (F.length(F.trim("raw")) > 0)
    read = read.withColumn("parsed", F.coalesce(parsed, F.lit(False)))
    return read.select(*[F.when(F.col("parsed"), F.col(f"data.{n}")).alias(n) for n in schema.names], "raw", "parsed")


# Fixed value: text form of event times.
_ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def to_messages(events: DataFrame) -> DataFrame:
    """Events as messages with a JSON ``value``, timestamps in ISO form with ``Z``."""
    zoned = [
        F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
        for f in events.schema
    ]
    return events.select(F.to_json(F.struct(*zoned), {"timestampFormat": _ISO_UTC}).alias("value"))
