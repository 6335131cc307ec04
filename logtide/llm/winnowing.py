"""Document fingerprints by winnowing.

A text is lower-cased (A-Z) and its separators are dropped. Every run of ``k`` bytes is hashed by
a rolling polynomial; in each window of ``w`` neighbouring hashes the smallest is chosen,
of equal ones the rightmost, and kept with the place (code point) of the original text
where its run starts. Any two texts that share ``k + w - 1`` bytes share a whole window and with
it a chosen hash; runs shorter than ``k`` never match.

A fingerprint is the hex form of its (hash, place) entries: 5 bytes of hash and 4 bytes of
place each, little-endian. Likeness is the Jaccard likeness of the distinct hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from logtide.llm.bytes_np import LOWER, SPAN, gram_hashes
from logtide.llm.common import text_of, with_python

#: Bytes in a run and hashes in a window: shared passages of 19 bytes are always seen.
K, W = 8, 12
_PLACE = np.uint64((1 << 24) - 1)
_KEEP = np.array([b not in (9, 10, 11, 12, 13, 32) for b in range(256)])
BLOCK_ROWS = 256


def _window_minima(keys: np.ndarray, w: int) -> np.ndarray:
    """Smallest key of each run of ``w`` keys (of all keys if there are fewer)."""
    w = min(w, len(keys))
    size = 1
    while size * 2 <= w:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return np.minimum(keys[:len(keys) - (w - size)], keys[w - size:]) if size < w else keys


def fingerprint(raw: bytes, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) chosen from one text in UTF-8, in the order of places."""
    data = np.frombuffer(raw, np.uint8)
    where = np.flatnonzero(_KEEP[data])
    if not len(where):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = gram_hashes(LOWER[data[where]], k) >> np.uint64(24)  # 40 bits
    chosen = []
    windows = max(1, len(hashes) - w + 1)
    for a in range(0, windows, SPAN):
        part = hashes[a:min(windows, a + SPAN) + w - 1]
        # Places count down in the low bits, so that the rightmost of equal hashes is smallest.
        keys = (part << np.uint64(24)) | (_PLACE - np.arange(len(part), dtype=np.uint64))
        least = _window_minima(keys, w)
        least = least[np.append(True, least[1:] != least[:-1])]
        chosen.append(a + (_PLACE - (least & _PLACE)).astype(np.int64))
    at = np.concatenate(chosen)
    at = at[np.append(True, at[1:] != at[:-1])]
    points = np.cumsum((data & 0xC0) != 0x80) - 1
    return hashes[at], points[where[at]]


def as_text(print_: tuple[np.ndarray, np.ndarray]) -> str:
    hashes, places = print_
    out = np.zeros((len(hashes), 9), np.uint8)
    out[:, :5] = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    out[:, 5:] = places.astype("<u4").view(np.uint8).reshape(-1, 4)
    return out.tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sets of distinct hashes; two empty sets are alike."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _neighbours(k: int, w: int):
    """Rows sorted by (part, tail, order): prints of each text, of its edited text and of the next text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (part, id, text, print, distinct hashes): waits for its successor
        ended = None  # part whose tail has been seen

        def prints(text: str):
            p = fingerprint(text.encode("utf-8", "surrogatepass"), k, w)
            return p, np.unique(p[0])

        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                out: dict[str, list] = {c: [] for c in COLUMNS}
                for part, tail, i, text in zip(*(batch.column(c).to_pylist() for c in ("part", "tail", "id", "text")), strict=True):
                    if part == ended:
                        continue
                    p, own = prints(text)
                    if held is not None:
                        _, hid, ht, hp, hown = held
                        n = len(ht)
                        edited = ht[:n - n // 2] + text[:n // 2]
                        ep, eown = prints(edited)
                        for c, v in zip(COLUMNS, (hid, n, hashlib.sha256(edited.encode()).hexdigest(), as_text(hp), as_text(ep),
                                                  likeness(hown, eown), likeness(hown, own)), strict=True):
                            out[c].append(v)
                    if tail:
                        held, ended = None, part
                    else:
                        held = (part, i, text, p, own)
                yield pa.RecordBatch.from_pydict({c: pa.array(out[c], t) for c, t in COLUMNS.items()})

    return run


COLUMNS = {"id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
           "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}


def fingerprint_chain(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W) -> DataFrame:
    """One row per input row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last floor(n / 2) code points replaced by as many first ones
    (or all) of the next text in descending id, the first text after the last.

    The table is dealt by ranges of ids; the first row of each range also goes to the range
    before, so every task sees the successor of its last row and texts are shuffled once.

    Defined cases: a null text counts as empty, with an empty fingerprint; null ids come last; rows of one
    id follow in the order of their texts' hashes; a single row is its own successor; texts are
    read whole; an empty table gives no rows; further columns are not looked at.
    """
    spark = docs.sparkSession
    with_python(spark)
    tasks = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    # Bounds of the ranges: a few numbers for each task.
    marks = 4 * tasks
    cuts = sorted(set(rows.stat.approxQuantile("id", [i / marks for i in range(1, marks)], 0.25 / marks)), reverse=True)
    bounds = F.array(*[F.lit(int(c)).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    part = F.when(F.col("id").isNull(), F.lit(len(cuts))).otherwise(F.size(F.filter(bounds, lambda b: b > F.col("id"))))
    rows = rows.withColumn("part", part)
    heads = rows.groupBy("part").agg(F.max("id").alias("head"))
    after = Window.orderBy("part")  # one row for each range
    everything = after.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select(F.col("part").alias("before"), F.coalesce(
        F.lead(F.struct("head")).over(after), F.first(F.struct("head")).over(everything)).alias("x")).select("before", "x.head")
    tails = rows.join(F.broadcast(heads), F.col("id").eqNullSafe(F.col("head"))).select(
        "id", "text", F.col("before").alias("part"), F.lit(True).alias("tail"))
    dealt = rows.select("id", "text", "part", F.lit(False).alias("tail")).unionByName(tails).repartition(tasks, "part")
    dealt = dealt.sortWithinPartitions("part", "tail", F.col("id").desc_nulls_last(), F.xxhash64("text"))
    out = dealt.mapInArrow(_neighbours(k, w), "id long, n_chars long, edited_sha256 string, fingerprint string, "
                                              "edited_fingerprint string, near_edited double, near_next double")
    return out.withColumnRenamed("id", id_col)
