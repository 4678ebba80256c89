"""Contiguous byte-balanced shards by global prefix sums.

Rows are put in the order of (md5 of the text, id), range-partitioned; each partition's bytes and rows are
summed, the sums of the partitions before it give every row its place in the whole, and the order is cut
where the running bytes pass equal targets: a row belongs to the shard in which its first byte falls. Only sizes and
digests move, never a text. Equal texts are neighbours in that order, so a cut divides one group of them at most.

A null text has no bytes, the digest of no text and crc 0; every row has 8 bytes besides. Repeated rows each get a
slot. An empty table gives no row. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.session import cut

SHARDS = 24
ROW_BYTES = 8


def byte_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """A row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    kind = docs.schema["doc_id"].dataType
    rows = cut(
        docs.select(
            "doc_id",
            F.coalesce(F.md5("text"), F.lit("")).alias("key"),
            (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
            F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
        )
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(rows.repartitionByRange(parts, "key", "doc_id").withColumn("pid", F.spark_partition_id()))
    sums = placed.groupBy("pid").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    # One row a partition: their number follows the cluster's setting, not a key.
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    shift = cut(
        sums.select("pid", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("b0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("r0"))
    )
    total = sums.agg(F.sum("bytes").alias("t")).first().t or 1
    inside = Window.partitionBy("pid").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    at = placed.withColumns({"b": F.coalesce(F.sum("size").over(inside), F.lit(0)), "r": F.count("*").over(inside)})
    at = at.join(F.broadcast(shift), "pid").select("doc_id", "key", "size", "text_crc32", (F.col("b") + F.col("b0")).alias("b"), (F.col("r") + F.col("r0")).alias("r"))

    def shard(position: str) -> Column:
        return F.expr(f"cast(({position} * {shards}) div {total} as int)")

    dealt = at.withColumn("shard", shard("b"))
    first = dealt.groupBy("shard").agg(F.min("r").alias("r1"))
    return dealt.join(F.broadcast(first), "shard").select(
        F.col("doc_id").cast(kind),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("r") - F.col("r1")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: CRC-32 by half bytes, over slices of a text's hexadecimal digits (the low digit of each byte first).
_CRC = """
half AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 1, 2, 3, 4], lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(16)) AS i))),
steps AS (SELECT 1::BIGINT AS i, key, h, 4294967295::BIGINT AS c FROM (SELECT DISTINCT key, hex(encode(text)) AS h FROM d WHERE text IS NOT NULL)
UNION ALL SELECT i + 2000, key, h, list_reduce([c] || list_transform(range(i, least(i + 2000, len(h) + 1)), lambda p: ascii(substr(h, CASE WHEN p % 2 = 1 THEN p + 1 ELSE p - 1 END, 1))::BIGINT),
  lambda c, x: xor(c >> 4, t[(xor(c, x - CASE WHEN x > 57 THEN 55 ELSE 48 END) & 15) + 1])) FROM steps, half WHERE i <= len(h)),
crcs AS (SELECT key, xor(max_by(c, i), 4294967295)::BIGINT AS crc FROM steps GROUP BY key)"""

ORACLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, text, coalesce(md5(text), '') AS key, coalesce(strlen(text), 0)::BIGINT + {ROW_BYTES} AS size FROM documents), {_CRC},
p AS (SELECT doc_id, key, size, (sum(size) OVER (ORDER BY key, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS b, (sum(size) OVER ())::BIGINT AS total FROM d),
s AS (SELECT doc_id, key, size, b, (b * {SHARDS} // total)::INTEGER AS shard FROM p)
SELECT doc_id, size, coalesce(crc, 0)::BIGINT AS text_crc32, 'bytes' AS law, shard, (row_number() OVER (PARTITION BY shard ORDER BY b) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard FROM s LEFT JOIN crcs USING (key)
"""
