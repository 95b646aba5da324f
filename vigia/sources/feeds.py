"""RSS feed documents → one row per item.

``from_xml`` parses each feed document (malformed input gives null, not a failed job) and
``posexplode`` numbers the items in document order. For feed files on storage use
``spark.read.format("xml").option("rowTag", "item")`` instead — same item schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import POLICIES, apply_policy

FEED_SCHEMA = "channel struct<item: array<struct<title: string, link: string, pubDate: string>>>"


def feed_items(feeds: DataFrame, xml_col: str = "xml", keep: list[str] | None = None) -> DataFrame:
    keep = keep or []
    parsed = feeds.select(*keep, F.from_xml(F.col(xml_col), FEED_SCHEMA).alias("_f"))
    items = parsed.select(*keep, F.posexplode(F.col("_f.channel.item")).alias("item_pos", "it"))
    return items.select(*keep, "item_pos", F.col("it.title").alias("titulo"), F.col("it.link").alias("url"),
                        F.col("it.pubDate").alias("pub_date"))


def with_feed_date(items: DataFrame, source: str = "peru") -> DataFrame:
    """UTC `dd-MM-yyyy HH:mm:ss`; absent or unparsable → 'Sin Fecha'."""
    ts, fecha, _ = apply_policy(F.nullif(F.trim(F.col("pub_date")), F.lit("")), POLICIES[source])
    return items.withColumn("fecha_ts", ts).withColumn("fecha", fecha)
