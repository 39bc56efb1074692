"""Publishing events as JSON messages (the producer's sink side).

``publish_files`` writes one JSON text per line into a landing folder (what
the file-stream ingest reads); ``publish_kafka`` writes the same text as the
message value to a topic, keyed by user so one user's events stay ordered
within a partition. Landing files are gzip text, a tenth of the plain size, which Spark's
text source reads as it reads plain ones; since a gzip file is one task's, they are
bounded by rows. Rows with a NULL event id go out like all others; ingest
puts them into quarantine. Kafka needs the spark-sql-kafka connector on the
classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import shuffles_dropped
from ledgerline.sources.json_events import encode_events
from ledgerline.sources.schemas import Feed


FILE_MESSAGES = 1_000_000


def publish_files(df: DataFrame, feed: Feed, path: str, mode: str = "append") -> None:
    writer = encode_events(df, feed).write.mode(mode).option("maxRecordsPerFile", FILE_MESSAGES)
    with shuffles_dropped(df.sparkSession):
        writer.option("compression", "gzip").text(path)


def kafka_options(feed: Feed, bootstrap_servers: str, topic: str | None = None) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic or feed.topic}


def publish_kafka(df: DataFrame, feed: Feed, bootstrap_servers: str, topic: str | None = None) -> None:
    msgs = encode_events(df, feed,
                         keep=[F.col("user_id").cast("string").alias("key")])
    msgs.write.format("kafka").options(**kafka_options(feed, bootstrap_servers, topic)).save()
