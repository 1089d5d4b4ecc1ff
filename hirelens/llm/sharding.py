"""Two-pass external shuffle into shards.

Pass one scatters the records: a document's shard is the one with the highest seeded hash of doc_id
and shard number (law ``key``: one more shard takes rows only into itself), and a second seeded hash
of id and text picks one of the shard's buckets, of which there are as many as keep a bucket in
memory. Pass two orders each bucket by content, so that a repeated task sees the same input, shuffles
it by Fisher-Yates with a seed of its own, and writes it. A record's slot is its place in the bucket
after all buckets before it.

Defined results: a null text counts as empty, with one byte of size; a null doc_id is a key like any
other. Rows that are equal in all columns are counted, and numbered by their count, so the copies of a
row go to different buckets however many there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm import tools
from hirelens.session import fresh_folder


def numbered(docs: DataFrame) -> DataFrame:
    """docs with ``__copy``: 1, 2, ... among rows that repeat doc_id and text and are equal.

    Only rows that may repeat others (a bitmap of fixed size tells) are grouped; equal rows meet in
    their tasks first, and numbers come from the count, so a repeated task gives the same numbers.
    """
    slot = F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")))
    repeated = tools.staged(docs.select(slot.alias("slot")).groupBy("slot").count().filter("count > 1").select("slot"), "repeated")
    if repeated.isEmpty():
        return docs.withColumn("__copy", F.lit(1).cast("long"))
    bits = docs.sparkSession.sparkContext.broadcast(tools.bitmap(repeated, hashed=True))

    def where(member: bool):
        def run(batches):
            for batch in batches:
                yield batch.filter(pa.array(tools.in_bitmap(bits.value, batch["__slot"].to_numpy()) == member))

        marked = docs.withColumn("__slot", slot)
        return marked.mapInArrow(run, marked.schema).drop("__slot")

    maps = [c for c, kind in docs.dtypes if kind.startswith("map<")]
    plain = where(True).withColumns({c: F.map_entries(c) for c in maps})
    counted = plain.groupBy(*plain.columns).agg(F.count("*").alias("__n"))
    counted = counted.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__n"))).drop("__n")
    return where(False).withColumn("__copy", F.lit(1).cast("long")).unionByName(counted.withColumns({c: F.map_from_entries(c) for c in maps}))


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """Highest random weight: the shard depends on the key and the number of shards only."""
    weights = [F.struct(F.xxhash64(key, F.lit(seed), F.lit(j)).alias("weight"), F.lit(j).alias("shard")) for j in range(shards)]
    return F.greatest(*weights)["shard"] if shards > 1 else F.lit(0)


def scattered(docs: DataFrame, shards: int, bucket_bytes: int, seed: int) -> DataFrame:
    """docs with __size, __crc, __shard, __grown and __bucket."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = docs.withColumn("__size", (F.octet_length(text) + 1).cast("long"))
    if "__copy" not in docs.columns:
        sized = sized.withColumn("__copy", F.lit(1).cast("long"))
    total = sized.agg(F.sum("__size")).first()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    key = F.col("doc_id").cast("long")
    return sized.withColumns({
        "__crc": F.crc32(text.cast("binary")),
        "__shard": shard_of(key, shards, seed),
        "__grown": shard_of(key, shards + 1, seed),
        "__bucket": F.pmod(F.xxhash64(key, text, "__copy", F.lit(seed + 1)), F.lit(buckets)).cast("int"),
    })


def gathered(records: DataFrame) -> DataFrame:
    """records with each bucket in one partition, dealt by rows: hashes of a few buckets would put many into one task."""
    return records.repartitionByRange("__shard", "__bucket")


def shuffled(docs: DataFrame, path: str, shards: int = 16, bucket_bytes: int = 16 << 20, seed: int = 20240917) -> DataFrame:
    """Write docs, shuffled, below ``path`` in one folder for each shard; return them with their slots.

    Files hold the columns of docs and __copy, __size, __crc, __grown, __bucket and __at, the place in
    the bucket. The result is the written table with ``slot``, ordered by nothing.
    """
    spark = docs.sparkSession
    records = scattered(numbered(docs), shards, bucket_bytes, seed)
    schema = records.withColumn("__at", F.lit(0).cast("long")).schema

    def fisher_yates(table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table, [("doc_id", "ascending"), ("__crc", "ascending"), ("text", "ascending"), ("__copy", "ascending")]).to_numpy().copy()
        shard, bucket = table["__shard"][0].as_py(), table["__bucket"][0].as_py()
        np.random.Generator(np.random.PCG64([seed, shard, bucket])).shuffle(order)
        return table.take(pa.array(order)).append_column("__at", pa.array(np.arange(len(order))))

    done = gathered(records).groupBy("__shard", "__bucket").applyInArrow(fisher_yates, schema)
    done.sortWithinPartitions("__shard", "__bucket", "__at").write.partitionBy("__shard").parquet(path)
    written = spark.read.schema(schema).parquet(path)
    before = Window.partitionBy("__shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = written.groupBy("__shard", "__bucket").count()
    offsets = counts.select("__shard", "__bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    return written.join(offsets, ["__shard", "__bucket"]).withColumn("slot", F.col("__before") + F.col("__at")).drop("__before")


def report(docs: DataFrame, shards: int = 16) -> DataFrame:
    done = shuffled(docs.select("doc_id", "text"), fresh_folder(docs.sparkSession, "shards"), shards)
    return done.select(
        "doc_id", F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.lit("key").alias("law"), F.col("__shard").cast("int").alias("shard"), "slot", F.col("__grown").cast("int").alias("grown_shard")
    )
