"""Importance resampling towards a target distribution with Arrow kernels.

Texts are lower-cased (A-Z), split into words and flattened by Arrow kernels; the words of a
block are dictionary-encoded once. A word's place in the dictionary stands for it: runs of
words are pairs of (run without its last word, last word), again dictionary-encoded, so the CRC
that names a feature's bucket is worked out for distinct runs only, and carried on from the
shorter run. What repeats is a ``take`` of the distinct runs' values and a sum by segments.

A bucket's gain is the logarithm of its (add-one) share in the target over its share in the
documents. A document's weight is the sum of its features' gains; Gumbel noise from a hash of
its id turns the highest weights into a draw without replacement.

Two passes over the documents: one adds up the buckets (an array of fixed size for each task,
summed by Spark), the other weighs with the gains, which are as many numbers as buckets.
Ranks come from a range partitioning by score; rows are numbered in their ranges, and the
rows of the ranges before are added.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.blocks import byte_blocks
from logtide.llm.common import stored, text_of, with_python

#: Bytes between words, after lower-casing: ASCII that is neither digit nor lower-case letter.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
#: Words in the longest run that is a feature, and words that a document needs to be drawn.
ORDER, MIN_WORDS = 1, 20
PERCENT, SEED = 10, 2024


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words, bounds): text i has the words bounds[i]:bounds[i + 1]."""
    split = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=GAP)
    flat = pc.list_flatten(split)
    some = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])
    return flat.filter(some), before[bounds]


def runs(texts: pa.Array, order: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """(bounds of the texts' words, for each length of 1 to ``order`` words: CRCs of distinct runs,
    for each run its distinct one, and the index of each text's first run)."""
    words, bounds = words_of(texts)
    coded = words.dictionary_encode()
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    crc = np.fromiter(map(zlib.crc32, names), np.int64, len(names))
    place, run, out = np.arange(len(word)), word, [(crc, word, bounds)]
    left = np.repeat(bounds[1:], np.diff(bounds)) - place  # words from this one to the text's end
    for k in range(2, order + 1):
        longer = left[place] >= k
        place, head = place[longer], run[longer]
        pairs = pa.array(head * max(1, len(names)) + word[place + k - 1]).dictionary_encode()
        run = pairs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        first, last = np.divmod(pairs.dictionary.to_numpy(zero_copy_only=False), max(1, len(names)))
        crc = np.fromiter((zlib.crc32(b" " + names[w], c) for c, w in zip(crc[first].tolist(), last.tolist(), strict=True)),
                          np.int64, len(first))
        out.append((crc, run, np.searchsorted(place, bounds)))
    return bounds, out


def _count(order: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for block in byte_blocks(batch):
                for crc, each, _ in runs(block.column("text"), order)[1]:
                    times = np.bincount(each, minlength=len(crc))
                    np.add.at(total, crc % buckets, times)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts (column ``text``) in each bucket; one number for each bucket reaches the driver."""
    found = texts.mapInArrow(_count(order, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in found.collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each of B buckets, in doubles."""
    b, all_s, all_t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(t + 1) * (all_s + b) / (float(s + 1) * (all_t + b))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _weigh(order: int, gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in byte_blocks(batch):
                bounds, found = runs(block.column("text"), order)
                weight, features = np.zeros(block.num_rows, np.int64), np.zeros(block.num_rows, np.int64)
                for crc, each, first in found:
                    sums = np.concatenate([[0], np.cumsum(gain[crc % len(gain)].take(each))])
                    weight += np.diff(sums[first])
                    features += np.diff(first)
                yield pa.RecordBatch.from_arrays([block.column("id"), pa.array(np.diff(bounds)), pa.array(features), pa.array(weight)],
                                                 ["id", "n_words", "n_features", "weight"])

    return run


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of this task with the task's number and their place in it, from 1."""
    part, done = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(done + 1, done + n + 1))],
                                         [*batch.schema.names, "part", "place"])
        done += n


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... in the given order, which must tell all rows apart.

    Rows are dealt by ranges of the order and numbered range by range; across ranges only one
    row for each range is added up.
    """
    spark = rows.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    numbered = stored(dealt.mapInArrow(_number, f"{schema}, part int, place long"), "ranges")
    sums = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # one row for each range
    out = numbered.join(F.broadcast(before), "part")
    return out.select(*rows.columns, (F.col("before") + F.col("place")).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             order: int = ORDER, buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT,
             seed: int = SEED) -> DataFrame:
    """One row per input row: id, n_words, n_features, weight, score, rank.

    Of the N rows with ``min_words`` words or more, the floor(``percent`` * N / 100) with the highest scores are
    drawn; they have ranks 1, 2, 3... by score, ties to the smaller id, and all others none.

    Defined cases: a null text counts as empty and has no features and weight 0; null ids are hashed as
    an empty id and come after all others among ties; repeated rows are rows of their own and may each be
    drawn; texts are read whole; an empty target gives every bucket the same add-one share; an empty
    table gives no rows; further columns are not looked at.
    """
    spark = docs.sparkSession
    with_python(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    gain = gains(bucket_counts(rows.select("text"), order, buckets),
                 bucket_counts(target.select(text_of(target_col).alias("text")), order, buckets))
    weighed = rows.mapInArrow(_weigh(order, gain), "id long, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    # Rows alike in all that is returned may take their ranks in any order; the number only parts them.
    weighed = stored(weighed.withColumn("score", F.col("weight") + noise).withColumn("row", F.monotonically_increasing_id()), "weights")
    enough = weighed.where(F.col("n_words") >= min_words)
    drawn = enough.count() * percent // 100
    placed = ranked(enough, F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features"), F.col("row"))
    placed = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    out = placed.unionByName(weighed.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", "rank")
