"""Exact deduplication through an extendible-hash index kept in shared files.

Every text is normalised (each run of separators becomes one space) and hashed to
a 64-bit key. The index is an extendible hash: a directory of buckets, each named
by a prefix of the key. Building starts from one bucket per ``2**start`` prefixes
and doubles the directory while a bucket holds more than ``capacity`` keys: only
overfull buckets split, by one more key bit, until they fit or no bit is left (keys
that are equal in all bits chain inside their bucket). Owner tasks then each write
one contiguous key range, whole buckets sorted by key. Texts that share a key form
a chain; its links are told apart by their bytes, never by the key alone.

How it stays bounded:
* a text copied millions of times is combined before the shuffle: grouping by
  (key, text) sends at most one row per task and distinct text;
* the directory has one row per bucket and is joined, not broadcast by hand;
* documents find their link by an equi-join on (key, digest); adaptive execution
  splits a hot key, since no aggregate or window needs its rows together.

Only DataFrame functions run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.common import stored, text_of, unused

KEY_BITS = 64
#: Keys per bucket before it splits.
CAPACITY = 4096


def normalised(text: Column) -> Column:
    """Each run of separators as one space. Lone spaces, nearly all runs, are left alone."""
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def _prefix(key: Column | str, depth: int) -> Column:
    """The first ``depth`` bits of a 64-bit key as a non-negative number."""
    c = F.col(key) if isinstance(key, str) else key
    return F.lit(0).cast("long") if depth == 0 else F.shiftrightunsigned(c, KEY_BITS - depth)


def _keyed(docs: DataFrame, id_col: str, text_col: str, key_bits: int) -> DataFrame:
    """(id, text, key): normalised text and its key; fewer ``key_bits`` make chains (for tests)."""
    norm = docs.select(F.col(id_col).alias("id"), normalised(text_of(text_col)).alias("norm"))
    key = F.xxhash64("norm")
    if key_bits < KEY_BITS:
        key = F.shiftleft(_prefix(key, key_bits), KEY_BITS - key_bits) if key_bits else F.lit(0).cast("long")
    return norm.withColumn("key", key)


def build_directory(keys: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Directory of buckets (depth, prefix, n_keys) for a stored table of distinct keys.

    Starts at the depth at which evenly spread keys would half fill the buckets, then
    doubles: each round counts only the keys of the buckets that were overfull.
    """
    total = keys.count()
    depth = max(0, (2 * total // max(1, capacity)).bit_length())
    depth = min(depth, KEY_BITS)
    left, parts = keys, []
    while True:
        counts = stored(left.groupBy(_prefix("key", depth).alias("prefix")).agg(F.count(F.lit(1)).alias("n_keys"))
                        .select(F.lit(depth).alias("depth"), "prefix", "n_keys"), "directory")
        over = F.col("n_keys") > capacity
        last = depth == KEY_BITS
        parts.append(counts if last else counts.where(~over))
        if last or counts.where(over).isEmpty():
            break
        left = left.withColumn("prefix", _prefix("key", depth)).join(
            counts.where(over).select("prefix"), "prefix", "left_semi").select("key")
        depth += 1
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _bucket_of(keys: DataFrame, directory: DataFrame) -> DataFrame:
    """Bucket (depth, prefix) of every row: one equi-join on the prefixes at the depths in use."""
    depths = sorted(r[0] for r in directory.select("depth").distinct().collect()) or [0]  # at most 65 values
    tries = keys.withColumn("try", F.explode(F.array(*[
        F.struct(F.lit(d).alias("depth"), _prefix("key", d).alias("prefix")) for d in depths])))
    tries = tries.select("*", F.col("try.depth").alias("depth"), F.col("try.prefix").alias("prefix")).drop("try")
    return tries.join(directory.select("depth", "prefix"), ["depth", "prefix"])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                key_bits: int = KEY_BITS) -> tuple[DataFrame, DataFrame]:
    """(index, directory), both in shared files.

    Index rows, one per distinct text: depth, prefix (its bucket), key, link (place in
    the key's chain), text_sha256, keep_id (smallest id), group_size. Files hold
    contiguous key ranges, sorted, so that one owner task reads or rewrites a bucket alone.
    """
    keyed = _keyed(docs, id_col, text_col, key_bits)
    # Grouping on the text itself compares bytes within a key's chain.
    links = stored(keyed.groupBy("key", "norm").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
                   .select("key", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size"), "links")
    keys = links.select("key").distinct()
    directory = stored(build_directory(keys, capacity), "directory")
    placed = _bucket_of(links, directory)
    chain = Window.partitionBy("key").orderBy(F.col("keep_id").asc_nulls_first(), "text_sha256")
    owned = placed.withColumn("link", F.row_number().over(chain)).repartitionByRange("key").sortWithinPartitions("key", "link")
    return stored(owned, "index"), directory


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                key_bits: int = KEY_BITS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, bucket_depth, chain_link.

    Defined cases: a null text counts as empty; all empty texts are one group; texts
    are compared whole, whatever their length; a null id sorts after every other id; of rows
    repeated with the same id and text exactly one is kept; an empty table gives no
    rows; further columns of the input, whatever their names, are not looked at.
    """
    index, _ = build_index(docs, id_col, text_col, capacity, key_bits)
    rows = _keyed(docs, id_col, text_col, key_bits).select("id", "key", F.sha2("norm", 256).alias("text_sha256"))
    # Rows of one id and text are repeats; numbered before the join, which then may split a hot key.
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("id", "key", "text_sha256").orderBy(F.lit(1))))
    found = rows.join(index.select("key", "text_sha256", "keep_id", "group_size", "depth", "link"), ["key", "text_sha256"])
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("place") == 1)
    out = found.withColumn("kept", kept)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256",
                      F.col("depth").alias("bucket_depth"), F.col("link").alias("chain_link"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; one row where the same id and text repeat."""
    kept = exact_dedup(docs, id_col, text_col).where("kept").select(
        F.col(id_col).alias("_keep"), F.col("text_sha256").alias("_sha"))
    mark = unused(docs, "_sha")
    rows = docs.withColumn(mark, F.sha2(normalised(text_of(text_col)), 256))
    same = rows.join(kept, rows[mark].eqNullSafe(kept["_sha"]) & rows[id_col].eqNullSafe(kept["_keep"]), "left_semi")
    return same.dropDuplicates([id_col, mark]).drop(mark)
