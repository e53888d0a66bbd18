"""References to records that do not exist: orphans by table and period.

Every reference is first held against a Bloom filter of all parent keys. A key the filter does not know is a definite
orphan and needs no further step. Up to MAX_FILTER_BITS the filter is broadcast; for more keys it is cut into buckets of
key hashes, each with a filter of the same density, which travel to the references of their bucket, so the share that is
proved does not fall as parents grow. The others are verified exactly against the time line of their parents: running
counts of begun and ended parents per key and hour, joined by (key, hour), so a hot key is spread over its hours, and
adaptive execution splits a hot hour, whose parents are one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.runtime import cut, table

#: Largest Bloom filter that is broadcast, in bits (8 MB), and the size of a bucket's filter beyond it (1 MB).
MAX_FILTER_BITS, BUCKET_BITS = 1 << 26, 1 << 23
#: Bits a key; with five hashes about one unknown key in 300 passes.
BITS, HASHES = 12, 5
#: References one task holds against a bucket's filter; a bucket with more is salted.
BUCKET_ROWS = 1 << 20
KEY = ["target", "scope", "ref_key"]


def trimmed(c: str | Column) -> Column:
    """Without leading and trailing spaces and tabs."""
    return F.regexp_replace(c, r"^[ \t]+|[ \t]+$", "")


def key_hash() -> Column:
    return F.xxhash64(*[F.col(k) for k in KEY])


def spots(h: Column, bits: int | Column) -> Column:
    """The bits of a key's hash in a filter."""
    low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    return F.array(*[F.pmod(low + high * F.lit(i), F.lit(bits)) for i in range(HASHES)])


def words_of(hashes: DataFrame, bits: int | Column, *bucket: str) -> DataFrame:
    """Filters as 64-bit words, built by a map-side combined aggregation: (bucket, word, mask)."""
    return (
        hashes.select(*bucket, F.explode(spots(F.col("h"), bits)).alias("spot"))
        .groupBy(*bucket, F.shiftright("spot", 6).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(spot & 63))")).alias("mask"))
    )


def known_in(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether a filter may hold each hash."""
    bits = np.uint64(len(words) * 64)
    v = h.astype(np.int64).view(np.uint64)
    low, high = v & np.uint64(0xFFFFFFFF), (v >> np.uint64(32)) | np.uint64(1)
    known = np.ones(len(v), dtype=bool)
    for i in range(HASHES):
        spot = (low + high * np.uint64(i)) % bits
        known &= (words[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
    return known


def filter_bits(keys: int) -> int:
    """Bits for so many distinct keys, a power of two."""
    return max(1 << 10, 1 << (BITS * keys - 1).bit_length())


def marked_by_one_filter(refs: DataFrame, hashes: DataFrame, bits: int) -> DataFrame:
    """Adds _may by a broadcast filter of at most MAX_FILTER_BITS."""
    words = words_of(hashes, bits).toPandas()
    filled = np.zeros(bits // 64, dtype=np.uint64)
    filled[words["word"].to_numpy(dtype=np.int64)] = words["mask"].to_numpy(dtype=np.int64).view(np.uint64)
    shared = refs.sparkSession.sparkContext.broadcast(filled)

    @F.pandas_udf("boolean")
    def probe(h: pd.Series) -> pd.Series:
        return pd.Series(known_in(shared.value, h.to_numpy()))

    return refs.withColumn("_may", probe(key_hash()))


def marked_by_buckets(refs: DataFrame, hashes: DataFrame, bits: int) -> DataFrame:
    """Adds _may by filters of BUCKET_BITS, one for each bucket of key hashes.

    Filters and references of a bucket meet in the same tasks, the filter's words first, so a task holds one filter and
    streams its references. A bucket with very many references, as of a hot key, goes to several tasks, each with a copy;
    which one a reference goes to depends on the reference alone, so a task that is run again gets the same ones."""
    n = -(-bits // BUCKET_BITS)
    bucket = lambda h: F.pmod(F.xxhash64(h), F.lit(n)).cast("int")
    hashed = refs.withColumn("_h", key_hash()).withColumn("_bucket", bucket(F.col("_h")))
    # as many rows as there are filters, each of which stands for more than 100,000 keys
    salts = F.broadcast(hashed.groupBy("_bucket").agg(F.ceil(F.count(F.lit(1)) / BUCKET_ROWS).cast("int").alias("_salts")))
    row = F.struct(*refs.columns)
    there = hashed.join(salts, "_bucket").select("_bucket", F.pmod(F.xxhash64(F.lit(17), *refs.columns), "_salts").cast("int").alias("_salt"), F.lit(None).cast("int").alias("_word"), F.col("_h").alias("_bits"), row.alias("_row"))
    words = words_of(hashes.withColumn("_bucket", bucket(F.col("h"))), BUCKET_BITS, "_bucket").join(salts, "_bucket")
    words = words.select("_bucket", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"), F.col("word").alias("_word"), F.col("mask").alias("_bits"), F.lit(None).cast(there.schema["_row"].dataType).alias("_row"))
    met = words.unionByName(there).repartition("_bucket", "_salt").sortWithinPartitions("_bucket", "_salt", F.col("_word").isNull())
    size = BUCKET_BITS // 64

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            place = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("_bucket", "_salt")], axis=1)
            edges = np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *edges], [*edges, len(place)]):
                if end == start:
                    continue
                if tuple(place[start]) != at:
                    at, held = tuple(place[start]), np.zeros(size, dtype=np.uint64)
                part = batch.slice(start, end - start)
                own = part.column("_word").is_valid()
                words = part.filter(own)
                held[words.column("_word").to_numpy()] = words.column("_bits").to_numpy().view(np.uint64)
                rest = part.filter(pc.invert(own))
                if rest.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(known_in(held, rest.column("_bits").to_numpy())), rest.column("_row")], names=["_may", "_row"])

    out = T.StructType([T.StructField("_may", T.BooleanType()), T.StructField("_row", there.schema["_row"].dataType)])
    return met.mapInArrow(probe, out).select("_row.*", "_may")


def may_exist(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """Adds _may: false where a Bloom filter proves that no parent has the key."""
    hashes = cut(parents.select(key_hash().alias("h")).distinct(), "keys")
    bits = filter_bits(hashes.count())
    return (marked_by_one_filter if bits <= MAX_FILTER_BITS else marked_by_buckets)(refs, hashes, bits)


def time_lines(references: DataFrame, parents: DataFrame) -> DataFrame:
    """(key, _hour, _before, _events) for each hour of a key in which references or parents' borders lie: the parents there
    at its beginning, and what begins (+) and ends (-) in it, by instant."""
    begun = parents.select(*KEY, F.col("begins").alias("t"), F.lit(1).alias("_delta"))
    ended = parents.where("ends is not null").select(*KEY, F.col("ends").alias("t"), F.lit(-1).alias("_delta"))
    # many parents of one instant are one event
    events = begun.unionByName(ended).groupBy(*KEY, "t").agg(F.sum("_delta").alias("_delta"))
    asked = references.select(*KEY, "t", F.lit(None).cast("bigint").alias("_delta"))
    event = F.when(F.col("_delta").isNotNull(), F.struct("t", "_delta"))
    hours = events.unionByName(asked).groupBy(*KEY, hour_of("t").alias("_hour")).agg(F.coalesce(F.sum("_delta"), F.lit(0)).alias("_net"), F.collect_list(event).alias("_events"))
    per_key = Window.partitionBy(*KEY).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    return hours.select(*KEY, "_hour", F.coalesce(F.sum("_net").over(per_key), F.lit(0)).alias("_before"), "_events")


def hour_of(t: str) -> Column:
    return F.date_trunc("hour", t)


def find_orphans(references: DataFrame, parents: DataFrame) -> DataFrame:
    """References without a parent at their time, with all their columns and proved (by the filter alone).

    references: target, scope, ref_key, t and further columns; parents: target, scope, ref_key, begins, ends.
    A parent exists at t if begins <= t and (ends is null or ends > t). References with a null key or a null t are no
    references and are left out; a null scope matches no parent. Parents with a null key, scope or begin, or that end
    before they begin, exist at no time. Repeated references are all returned; repeated parents count once or more with
    the same result. Empty inputs give an empty result, or all references.
    """
    refs = references.where("ref_key is not null and t is not null")
    live = parents.select(*KEY, "begins", "ends").where("ref_key is not null and scope is not null and begins is not null and (ends is null or ends > begins)")
    unscoped = refs.where("scope is null").withColumn("proved", F.lit(False))
    marked = may_exist(refs.where("scope is not null"), live)
    definite = marked.where("not _may").withColumn("proved", F.lit(True)).drop("_may")
    open_ = marked.where("_may").drop("_may").withColumn("_hour", hour_of("t"))
    here = F.aggregate(F.filter("_events", lambda e: e["t"] <= F.col("t")), F.lit(0).cast("bigint"), lambda n, e: n + e["_delta"])
    verified = open_.join(time_lines(open_, live), [*KEY, "_hour"]).where(F.col("_before") + here <= 0).drop("_hour", "_before", "_events").withColumn("proved", F.lit(False))
    return definite.unionByName(unscoped).unionByName(verified)


def catalog_references(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The three references of the catalog records and their targets, in the form find_orphans takes."""
    attributes, products, issues = (table(spark, sf_dir, n) for n in ("retry_attributes", "retry_products", "review_issues"))
    none = F.lit("")

    def refs(df, name, record_id, target, scope, key, t):
        k = trimmed(key)
        return df.select(
            F.lit(target).alias("target"), scope.alias("scope"), F.when(k != "", k).alias("ref_key"), F.col(t).alias("t"),
            F.lit(name).alias("source_table"), F.col(record_id).cast("long").alias("record_id"),
        )

    references = (
        refs(attributes, "retry_attributes", "attr_id", "product", F.col("doc_stem"), "entity", "extracted_at")
        .unionByName(refs(products, "retry_products", "product_id", "item", none, "sku", "extracted_at"))
        .unionByName(refs(issues, "review_issues", "issue_id", "code", none, "code", "raised_at"))
    )

    def targets(df, target, scope, key, begins, ends):
        return df.select(F.lit(target).alias("target"), scope.alias("scope"), key.alias("ref_key"), F.col(begins).alias("begins"), F.col(ends).alias("ends"))

    own = trimmed("sku")
    parents = (
        targets(products, "product", F.col("doc_stem"), F.when(own != "", own).otherwise(F.col("name")), "extracted_at", "retracted_at")
        .unionByName(targets(table(spark, sf_dir, "catalog_items"), "item", none, F.col("sku"), "created_at", "deleted_at"))
        .unionByName(targets(table(spark, sf_dir, "issue_codes"), "code", none, F.col("code"), "created_at", "deleted_at"))
    )
    return references, parents


def orphan_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_table, period, record_id), each record once however often it was delivered."""
    return find_orphans(*catalog_references(spark, sf_dir)).select("source_table", F.date_format("t", "yyyy-MM").alias("period"), "record_id").distinct()


def orphan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_records(spark, sf_dir).groupBy("source_table", "period").agg(F.count(F.lit(1)).alias("orphans"))


def orphan_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_table, orphans, proved): how many orphans of each table the filter alone proves."""
    found = find_orphans(*catalog_references(spark, sf_dir)).select("source_table", "record_id", "proved").distinct()
    return found.groupBy("source_table").agg(F.count(F.lit(1)).alias("orphans"), F.sum(F.col("proved").cast("bigint")).alias("proved"))
