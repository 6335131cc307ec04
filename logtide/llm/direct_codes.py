"""Token-id files of directly addressable codes (DACs).

An id is cut into 8-bit chunks, lowest first. Level 0 holds the first chunk of every id, level 1 the
second chunk of those that have one, and so on. A continuation bitmap at each level
says which ids go on, and a rank directory (ones before each block of 512 bits) finds an
id's place in the next level, so any id is read with one probe per level: nothing is
decoded in blocks.

A file segment is one self-contained value, all numbers little-endian:

    "DACS" | documents d, ids n, levels k: 3 x uint64 | doc_id: d x int64
    | document starts: (d + 1) x uint64 | k times: ids m: uint64, chunks: m x uint8,
      bitmap: ceil(m / 8) bytes, lowest bit first, rank directory: ceil(m / 512) x uint32

Spark's writers store the segments in rows (part, segment, ids before it in its part, payload) of
Parquet files, since that is what every file store Spark reaches can hold; doc_id ranges ascend
with the part, and within it with the segment.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.blocks import byte_blocks, giving_back
from logtide.llm.bpe_pieces import Cutter, packed, pre_tokens
from logtide.llm.common import stored, text_of, with_python

MAGIC, BLOCK = b"DACS", 512
#: A segment closes when it holds this many ids; a document is never cut.
SEGMENT_IDS = 1 << 19
#: Bytes of text encoded at once, and runs of marks kept with their ids.
BLOCK_BYTES, MOST_MARKS = 4 << 20, 10_000
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


def pack(doc_ids: list[int], counts: list[int], ids: np.ndarray) -> bytes:
    """A segment of documents with ``counts`` ids each."""
    out = [struct.pack("<QQ", len(doc_ids), len(ids)), b"", np.array(doc_ids, "<i8").tobytes(),
           np.cumsum([0, *counts]).astype("<u8").tobytes()]
    levels, rest = 0, ids.astype(np.uint32)
    while levels == 0 or len(rest):
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        ones = np.concatenate([_ONES[bits], np.zeros(-len(bits) % (BLOCK // 8), np.uint8)]).reshape(-1, BLOCK // 8).sum(1, dtype=np.uint32)
        ranks = (np.cumsum(ones) - ones).astype("<u4")
        out += [struct.pack("<Q", len(rest)), (rest & 255).astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()]
        rest = rest[more] >> 8
        levels += 1
    out[1] = struct.pack("<Q", levels)
    return MAGIC + b"".join(out)


class Segment:
    """Reader of one segment's payload."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        docs, self.n, levels = struct.unpack_from("<QQQ", payload, 4)
        at = 28
        self.doc_ids = np.frombuffer(payload, "<i8", docs, at)
        self.starts = np.frombuffer(payload, "<u8", docs + 1, at + 8 * docs).astype(np.int64)
        at += 16 * docs + 8
        self.levels = []
        for _ in range(levels):
            m, = struct.unpack_from("<Q", payload, at)
            at += 8
            wide, blocks = -(-m // 8), -(-m // BLOCK)
            self.levels.append((np.frombuffer(payload, np.uint8, m, at), np.frombuffer(payload, np.uint8, wide, at + m),
                                np.frombuffer(payload, "<u4", blocks, at + m + wide)))
            at += m + wide + 4 * blocks

    def token(self, i: int) -> int:
        """The id at place ``i``: one probe per level."""
        out = 0
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            out |= int(chunks[i]) << (8 * level)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            first = i // BLOCK * (BLOCK // 8)
            i = int(ranks[i // BLOCK]) + int(_ONES[bits[first:i >> 3]].sum()) + bin(int(bits[i >> 3]) & (1 << (i & 7)) - 1).count("1")
        return out

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to ``stop``: each level is read from the rank of the first id that goes on."""
        out = np.zeros(max(0, stop - start), np.uint32)
        where = np.arange(len(out))
        a, b = start, stop
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            if a >= b:
                break
            out[where] |= chunks[a:b].astype(np.uint32) << np.uint32(8 * level)
            more = np.unpackbits(bits[a >> 3:(b + 7) >> 3], bitorder="little")[a & 7:(a & 7) + b - a].astype(bool)
            where = where[more]
            if not len(where):
                break
            first = a // BLOCK * (BLOCK // 8)
            a = int(ranks[a // BLOCK]) + int(_ONES[bits[first:a >> 3]].sum()) + bin(int(bits[a >> 3]) & (1 << (a & 7)) - 1).count("1")
            b = a + len(where)
        return out


@lru_cache(maxsize=2)
def _cutter(path: str) -> Cutter:
    # Spark has one Python worker for each core; the library's own threads would only add to them.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    model, marked = tokenizer.model, {"": []}
    plain = not any(pre_tokens(t.content) for t in tokenizer.get_added_tokens_decoder().values())

    def tokens(word: str) -> list[int]:
        return [t.id for t in model.tokenize(word)]

    def encode(pieces: list[str]) -> list[bytes]:
        out = []
        for piece in pieces:
            two = plain and pre_tokens(piece)
            if two:  # pre-tokens go to the library's model as they are
                word, marks = two
                end = marked.get(marks)
                if end is None:
                    end = tokens(marks)
                    if len(marks) <= 3 and len(marked) < MOST_MARKS:
                        marked[marks] = end
                out.append(packed(tokens(word) + end))
            else:
                out.append(packed(tokenizer.encode(piece, add_special_tokens=False).ids))
        return out

    return Cutter(encode, {})


def _write(path: str, end_id: int, segment_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, part = _cutter(path), TaskContext.get().partitionId()
        docs, parts, number, before, held = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            payload = pack(docs, [len(p) for p in parts], ids)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "segment": pa.array([number], pa.int32()), "n_docs": pa.array([len(docs)], pa.int64()),
                "before": pa.array([before], pa.int64()), "n_ids": pa.array([len(ids)], pa.int64()), "payload": pa.array([payload], pa.binary())})

        for batch in batches:
            for rows in byte_blocks(batch, "text", BLOCK_BYTES):
                ids, bounds = cutter.encode(rows.column("text"))
                ids = np.insert(ids, bounds[1:], np.uint32(end_id))
                bounds = (bounds + np.arange(len(bounds))).tolist()
                for doc, a, b in zip(rows.column("id").to_pylist(), bounds[:-1], bounds[1:], strict=True):
                    docs.append(doc)
                    parts.append(ids[a:b])
                    held += b - a
                    if held >= segment_ids:
                        yield close()
                        docs, parts, number, before, held = [], [], number + 1, before + held, 0
        if docs:
            yield close()

    return giving_back(run)


def write_ids(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
              segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Encodes every text with the tokenizer at ``path``, appends ``end_id``, writes segments in ascending
    id order to the shared folder, and returns them with ``start``, the ids in all parts before.

    A null text counts as empty and has the end id alone; documents without an id are left out, as they
    have no place in the order; rows of one id follow each other by their text's hash; texts
    are encoded whole; an empty table gives no segments; further columns are not looked at.
    """
    spark = docs.sparkSession
    with_python(spark)
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartitionByRange(parts, "id").sortWithinPartitions("id", F.xxhash64("text"))
    written = stored(rows.mapInArrow(_write(path, end_id, segment_ids),
                                     "part int, segment int, n_docs long, before long, n_ids long, payload binary"), "token-ids")
    # One row per part: as many as there were tasks.
    sums = written.groupBy("part").agg(F.sum("n_ids").alias("n"))
    starts = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))
    return written.join(starts, "part").withColumn("start", F.col("start") + F.col("before"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, payload in zip(batch.column("start").to_pylist(), batch.column("payload"), strict=True):
            seg = Segment(payload.as_py())
            ids = seg.slice(0, seg.n).astype("<u4")
            raw = memoryview(ids.tobytes())
            s = seg.starts
            sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(s[:-1].tolist(), s[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(seg.doc_ids), pa.array(s[:-1] + start), pa.array(np.diff(s)), pa.array(sums, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(s, pa.int32()), pa.array(ids.astype(np.int32)))],
                ["id", "start", "n_tokens", "ids_crc32", "ids"])


def read_ids(segments: DataFrame, id_col: str = "doc_id", ids: bool = True) -> DataFrame:
    """(id, start, n_tokens, ids_crc32, ids) of every document, read from the segments."""
    with_python(segments.sparkSession)
    schema = "id long, start long, n_tokens long, ids_crc32 long, ids array<int>"
    run = _read if ids else _without_ids
    out = segments.select("start", "payload").mapInArrow(run, schema if ids else schema.rpartition(",")[0])
    return out.withColumnRenamed("id", id_col)


def _without_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _read(batches):
        yield batch.select(["id", "start", "n_tokens", "ids_crc32"])


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, payload, places in zip(*(batch.column(c).to_pylist() for c in ("start", "payload", "places")), strict=True):
            seg = Segment(payload)
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array([seg.token(p - start) for p in places], pa.int64())],
                                             ["place", "token"])


def tokens_at(segments: DataFrame, places: DataFrame, block: int = SEGMENT_IDS) -> DataFrame:
    """(place, token) for places (``place``: number of ids before it in the whole file), without decoding.

    Segments and places meet on blocks of places, since a segment may overlap several blocks.
    """
    with_python(segments.sparkSession)
    s = segments.select("start", "n_ids", "payload")
    spans = s.select("start", "n_ids", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("n_ids") - 1) / block))).alias("b"))
    found = places.select("place", F.floor(F.col("place") / block).alias("b")).join(spans, "b").where("place >= start AND place < start + n_ids")
    found = found.groupBy("start").agg(F.collect_set("place").alias("places"))  # at most the ids of one segment
    return found.join(s, "start").select("start", "payload", "places").mapInArrow(_probe, "place long, token long")
