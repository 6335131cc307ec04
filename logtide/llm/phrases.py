"""Phrase collocations mined level by level with sharded double-array tries.

Texts are cut once to blocks of numbered words (stored; each block has its own dictionary, so
that lookups are made once for a block's distinct words). A word is known by a 64-bit hash of its
language and bytes. Then, for phrases of 2, 3, ... words:

1. *Candidates, Apriori-safe.* A phrase can only be frequent if its first and its last words but one are
   (level 2: if both words are). Of such places, the hashes of the phrases are counted in
   2**26 buckets, summed over all blocks; a phrase in a bucket that falls short is no candidate. Sets of
   frequent words, phrases and buckets reach the tasks as bitmaps of fixed size: a false hit
   costs a candidate too many, never one too few.
2. *Exact counts.* Candidates are dealt by hash to shards of about ``TRIE_PHRASES`` places, in one pass over the blocks: a
   task combines those of some blocks and sends each with its count. A shard's candidates, chosen once more by
   buckets of its own, are built into a trie; numpy advances the states of all that was dealt to it at once, word by
   word, and adds up the counts of the accepting ones. More candidates mean more shards, neither more passes nor
   larger tries, and no trie leaves its task.

Blocks reach the tasks in Arrow batches of ``BATCH_BYTES``, so that memory follows neither the blocks of a task nor the text.
A phrase's parts are shorter frequent phrases, so their counts are joined from the levels below.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.blocks import byte_blocks, giving_back
from logtide.llm.bytes_np import LOWER, mix, span_hashes, text_bytes, word_bounds
from logtide.llm.common import arrow_bytes, stored, text_of, with_python
from logtide.llm.double_array import Trie

#: Bytes that end a piece, and bytes between words (those and the blanks).
ENDS = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))
GAPS = ENDS | np.isin(np.arange(256), list(b" \t"))
MAX_WORDS, MIN_COUNT = 3, 10
#: A candidate goes where a longer one that holds it occurs this percentage of its times.
COVERED = 50
TOP = 2000
#: Language of texts that have none.
NO_LANGUAGE = "und"
#: Size of the bitmaps (bits, as a power of two), and places in the text for each trie (so phrases in it at most, on average).
BUCKET_BITS = 26
TRIE_PHRASES = 250_000
#: Words that are looked up in the texts by a broadcast list; more are joined.
MAX_SPELLED = 1_000_000
#: Parts of a language's phrases that are ranked by themselves first.
RANKED = 64
#: Bytes of text in a block.
CUT_BYTES = 1 << 20
#: Bytes of an Arrow batch of blocks; the last block in it may go beyond.
BATCH_BYTES = 4 << 20
#: Phrase hashes whose buckets a task counts at once.
COUNTED = 1 << 22
#: Candidates, each once for a block, that a task combines before it deals them.
DEALT = 1 << 20
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BLOCKS = "langs array<long>, symbols array<long>, counts array<long>, low binary, high binary"


def _words(batch: pa.RecordBatch) -> Iterator[tuple]:
    """For blocks of texts (lang, text) that have words: (bytes, words' starts and ends, texts' first words, languages, symbols)."""
    for block in byte_blocks(batch, most=CUT_BYTES):
        data, offsets = text_bytes(block.column("text"))
        data = LOWER[data]
        starts, ends, first = word_bounds(data, offsets, GAPS)
        if len(starts):
            lang = np.repeat(block.column("lang").to_numpy(), np.diff(first))
            yield data, starts, ends, first, lang, mix(span_hashes(data, starts, ends) + mix(lang.astype(np.uint64) + _GOLD))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (lang, text) to blocks: the distinct words' symbols, most frequent first, with their languages and
    counts, and all words in order as places in that list, in two halves of 16 bits (no upper half for
    short lists); the list's length stands between pieces."""
    for batch in batches:
        for data, starts, _, first, lang, symbol in _words(batch):
            distinct, at, which, n = np.unique(symbol, return_index=True, return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order))
            # A piece ends with its text, or at an ending byte between this word and the next.
            ended = np.searchsorted(np.flatnonzero(ENDS[data]), starts)
            apart = ended[1:] != ended[:-1]
            apart[first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(starts))] - 1] = True
            row = np.full(len(starts) + int(apart.sum()), len(order), np.uint32)
            row[np.arange(len(starts)) + np.concatenate([[0], np.cumsum(apart)])] = place[which]
            longs = lambda x: pa.array([x], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [longs(lang[at[order]]), longs(distinct[order].view(np.int64)), longs(n[order]),
                 pa.array([row.astype("<u2").tobytes()], pa.binary()),
                 pa.array([(row >> np.uint32(16)).astype("<u2").tobytes() if len(order) >> 16 else b""], pa.binary())],
                ["langs", "symbols", "counts", "low", "high"])


def _spell(wanted):
    """Texts (lang, text) to (s1, word) of the wanted symbols (sorted; all where None), once for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, starts, ends, _, _, symbol in _words(batch):
                distinct, at = np.unique(symbol, return_index=True)
                if wanted is not None:
                    some = np.isin(distinct, wanted.value, assume_unique=True)
                    distinct, at = distinct[some], at[some]
                raw = data.tobytes()
                words = [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(words, pa.string())], ["s1", "word"])

    return giving_back(run)


def _rows(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.xxhash64(F.coalesce(lang_col, F.lit(NO_LANGUAGE))).alias("lang"), text_of(text_col).alias("text"))


def blocks_of(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return stored(_rows(docs, text_col, lang_col).mapInArrow(giving_back(_cut), _BLOCKS), "blocks")


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distinct symbols, places) of each block of (symbols, low, high)."""
    for symbols, low, high in zip(batch.column("symbols"), batch.column("low"), batch.column("high"), strict=True):
        row = np.frombuffer(low.as_py(), "<u2").astype(np.int64)
        if high := high.as_py():
            row |= np.frombuffer(high, "<u2").astype(np.int64) << 16
        yield symbols.values.to_numpy(zero_copy_only=False).view(np.uint64), row


def _joined(heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """Names of phrases from the names of what is before the last word and of the last word."""
    return mix(heads * _GOLD + tails + np.uint64(1))


def _hit(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    bucket = names & np.uint64(len(bits) * 64 - 1)
    return (bits[(bucket >> np.uint64(6)).astype(np.int64)] >> (bucket & np.uint64(63))) & np.uint64(1) != 0


def _places(symbols: np.ndarray, row: np.ndarray, words: np.ndarray, shorter: np.ndarray | None, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where phrases of ``size`` words may be frequent, and their names."""
    known = np.append(_hit(words, symbols), False)[row]
    names = np.append(symbols, np.uint64(0))
    at = np.flatnonzero(known)
    name = names[row[at]]
    for k in range(2, size + 1):
        goes = (at < len(row) - k + 1) & known[np.minimum(at + k - 1, len(row) - 1)]
        at, name = at[goes], name[goes]
        longer = _joined(name, names[row[at + k - 1]])
        if k == size - 1:  # both the phrase but its last word and the one but its first must be frequent
            good = np.zeros(len(row) + 1, bool)
            good[at[_hit(shorter, longer)]] = True
            both = good[at] & good[at + 1]
            at, longer = at[both], longer[both]
        name = longer
    return at, name


#: Buckets whose counts travel together.
TOGETHER = 1 << 12


def _buckets(words, shorter, size: int, bits: int):
    """Counts of phrase hashes in buckets, a row for each run of buckets: (part, places of 2 bytes, counts of 1).

    A bucket's count in a row stops at 255, as one that is larger is over every allowed minimum.
    """

    def counted(names: list[np.ndarray]) -> pa.RecordBatch:
        bucket, n = np.unique(np.concatenate(names), return_counts=True)
        part = bucket // TOGETHER
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
        ends = np.append(starts, len(part)).astype(np.int64)
        places, counts = (bucket % TOGETHER).astype("<u2").tobytes(), np.minimum(n, 255).astype(np.uint8).tobytes()
        return pa.RecordBatch.from_arrays([pa.array(part[starts]), _cuts(places, 2 * ends), _cuts(counts, ends)], ["part", "places", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held = [], 0
        for batch in batches:
            for symbols, row in _opened(batch):
                found = _places(symbols, row, words.value, shorter and shorter.value, size)[1]
                names.append((found & np.uint64((1 << bits) - 1)).astype(np.int32))
                held += len(found)
                if held >= COUNTED:
                    yield counted(names)
                    names, held = [], 0
        if names:
            yield counted(names)

    return giving_back(run)


def _cuts(data: bytes, ends: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)]).cast(pa.binary())


def _heavy(min_count: int):
    """Buckets of sorted rows (part, places, counts) that reach the minimum; one run of buckets is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = None, np.zeros(TOGETHER, np.int64)

        def reached() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total >= min_count) + np.int64(part or 0) * TOGETHER)], ["name"])

        for batch in batches:
            for p, places, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "places", "counts")), strict=True):
                if p != part:
                    yield reached()
                    part, total = p, np.zeros(TOGETHER, np.int64)
                total[np.frombuffer(places, "<u2")] += np.frombuffer(counts, np.uint8)
        yield reached()

    return giving_back(run)


def _combined(phrases: np.ndarray, name: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal phrases (rows of symbols) that follow each other by name as one, with the sum of their counts; names ascend."""
    order = np.argsort(name)
    phrases, name = phrases[order], name[order]
    first = np.flatnonzero(np.concatenate([[True], (phrases[1:] != phrases[:-1]).any(axis=1)])) if len(name) else order
    return phrases[first], name[first], np.add.reduceat(n[order], first) if len(name) else n


def _candidates(words, shorter, heavy, size: int, shards: int):
    """Candidates with their counts in some blocks, dealt to shards by their names: (shard, phrases of 8 bytes a symbol, counts of 4)."""

    def dealt(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        phrases, name, n = _combined(*map(np.concatenate, zip(*found, strict=True)))
        for a in range(0, len(name), DEALT):
            shard = (((name[a:a + DEALT] >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int32)  # ascends with the names
            starts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
            ends = np.append(starts, len(shard)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[starts]), _cuts(phrases[a:a + DEALT].astype("<u8").tobytes(), 8 * size * ends),
                 _cuts(n[a:a + DEALT].astype("<u4").tobytes(), 4 * ends)], ["shard", "phrases", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            for symbols, row in _opened(batch):
                at, name = _places(symbols, row, words.value, shorter and shorter.value, size)
                some = _hit(heavy.value, name)
                at, name = at[some], name[some]
                found.append(_combined(np.column_stack([symbols[row[at + k]] for k in range(size)]), name, np.ones(len(at), np.int64)))
                held += len(found[-1][1])
                if held >= DEALT:
                    yield from dealt(found)
                    found, held = [], 0
        if held:
            yield from dealt(found)

    return giving_back(run)


def _counted(phrases: np.ndarray, n: np.ndarray, min_count: int) -> pa.RecordBatch:
    """A shard's phrases that occur ``min_count`` times or more, from all its phrases and their counts in
    parts of the text: (s1, s2, ..., name, n)."""
    size = phrases.shape[1]
    # The shard is whole, so its own buckets (eight or more a row) choose among its candidates once more.
    bucket = (mix(reduce(_joined, phrases.T)) & np.uint64((8 << len(n).bit_length()) - 1)).astype(np.int64)
    some = (np.bincount(bucket, n) >= min_count)[bucket]
    phrases, n = phrases[some], n[some]
    symbols, local = np.unique(phrases, return_inverse=True)
    local = local.reshape(phrases.shape).astype(np.int32)
    paths = local[np.lexsort(local.T[::-1])]
    paths = paths[np.concatenate([[True], (paths[1:] != paths[:-1]).any(axis=1)])] if len(paths) else paths
    total = Trie(paths, len(symbols)).count(local.ravel(), size, len(paths), np.arange(0, local.size, size), n)
    often = total >= min_count
    parts = [symbols[paths[often, k]] for k in range(size)]
    return pa.RecordBatch.from_arrays(
        [*[pa.array(p.view(np.int64)) for p in parts], pa.array(reduce(_joined, parts).view(np.int64)), pa.array(total[often])],
        [*[f"s{k + 1}" for k in range(size)], "name", "n"])


def _walk(size: int, min_count: int):
    """Sorted rows (shard, phrases, counts) to the phrases that reach the minimum, by a trie for each shard; one shard is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []

        def counted() -> pa.RecordBatch:
            phrases, counts = (np.frombuffer(b"".join(x), kind) for x, kind in zip(zip(*held, strict=True), ("<u8", "<u4"), strict=True))
            return _counted(phrases.reshape(-1, size), counts.astype(np.int64), min_count)

        for batch in batches:
            for s, phrases, counts in zip(*(batch.column(c).to_pylist() for c in ("shard", "phrases", "counts")), strict=True):
                if s != shard and held:
                    yield counted()
                    held = []
                shard = s
                held.append((phrases, counts))
        if held:
            yield counted()

    return giving_back(run)


def bitmap(names: DataFrame, bits: int) -> np.ndarray:
    """Set bits of a column ``name``: 2**bits bits whatever the number of rows, so that it may reach the driver."""
    bucket = F.col("name").bitwiseAND((1 << bits) - 1)
    flag = F.expr("shiftleft(1L, CAST(bucket & 63 AS INT))")
    rows = names.select(bucket.alias("bucket")).groupBy(F.shiftright("bucket", 6).alias("at")).agg(F.bit_or(flag).alias("flags"))
    found = rows.toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found.column("at").to_numpy()] = found.column("flags").to_numpy().view(np.uint64)
    return out


def frequent_phrases(blocks: DataFrame, words: DataFrame, size: int, shorter: DataFrame | None, min_count: int,
                     bits: int = BUCKET_BITS, trie_phrases: int = TRIE_PHRASES) -> DataFrame:
    """(s1, ..., name, n) of the phrases of ``size`` words that occur ``min_count`` times or more; ``words`` and
    ``shorter`` hold the frequent ones (``name``) of one word and of size - 1 words."""
    sc = blocks.sparkSession.sparkContext
    typed = ", ".join(f"s{k + 1} long" for k in range(size))
    packed = blocks.select("symbols", "low", "high")
    word_bits = sc.broadcast(bitmap(words, bits))
    shorter_bits = sc.broadcast(bitmap(shorter, bits)) if size > 2 else None
    buckets = packed.mapInArrow(_buckets(word_bits, shorter_bits, size, bits), "part int, places binary, counts binary")
    buckets = buckets.repartition("part").sortWithinPartitions("part").mapInArrow(_heavy(min(min_count, 255)), "name long")
    heavy = sc.broadcast(bitmap(buckets, bits))
    # Places of phrases that begin with a frequent word: a shard has ``trie_phrases`` of them on average at most, and so no more candidates.
    places = words.agg(F.sum("n")).first()[0] or 0
    found = packed.mapInArrow(_candidates(word_bits, shorter_bits, heavy, size, max(1, -(-places // trie_phrases))),
                              "shard int, phrases binary, counts binary")
    return found.repartition("shard").sortWithinPartitions("shard").mapInArrow(_walk(size, min_count), f"{typed}, name long, n long")


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
         covered: int = COVERED, top: int = TOP, bits: int = BUCKET_BITS, trie_phrases: int = TRIE_PHRASES) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Phrases are runs of 2 to ``max_words`` words inside a piece that occur ``min_count`` times or more (a). Cut after
    its first k words a phrase has counts l and r of its parts and the score floor(10**6 * a * a / (l * r)); its lowest
    score counts, ties to the smallest k. A phrase inside a longer one that occurs in ``covered`` percent of its
    times or more is left out. n: words of the language. Order: score, a (both descending), phrase by bytes.

    Defined cases: a null text counts as empty; a null language is ``und``; empty and blank texts have no
    words; texts are read whole; repeated rows count again; a language without phrases, and an empty
    table, give no rows; further columns are not looked at; ids play no part. Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    with_python(spark)
    blocks = blocks_of(docs, text_col, lang_col)
    each = blocks.select(F.explode(F.arrays_zip("symbols", "langs", "counts")).alias("x"))
    words = stored(each.groupBy(F.col("x.symbols").alias("s1")).agg(F.min("x.langs").alias("lang_key"), F.sum("x.counts").alias("n")), "words")
    levels = {1: stored(words.where(F.col("n") >= min_count).withColumn("name", F.col("s1")), "phrases-1")}
    for size in range(2, max_words + 1):
        with arrow_bytes(spark, BATCH_BYTES):
            levels[size] = stored(frequent_phrases(blocks, levels[1], size, levels[size - 1], min_count, bits, trie_phrases), f"phrases-{size}")

    lang_of = levels[1].select("s1", "lang_key")
    scored = []
    for size in range(2, max_words + 1):
        rows = levels[size].withColumnRenamed("n", "a")
        for k in range(1, size):
            for side, first, last in (("l", 1, k), ("r", k + 1, size)):
                there = levels[last - first + 1]
                keys = [f"s{j}" for j in range(first, last + 1)]
                there = there.select(*[F.col(f"s{j + 1}").alias(c) for j, c in enumerate(keys)], F.col("n").alias(f"{side}{k}"))
                rows = rows.join(there, keys)
        # Whole numbers of 38 digits: exact for counts of up to 15 digits.
        cuts = [F.struct(F.expr(f"(CAST(a AS decimal(15,0)) * CAST(a AS decimal(15,0)) * CAST(1000000 AS decimal(7,0)))"
                                f" div (CAST(l{k} AS decimal(15,0)) * CAST(r{k} AS decimal(15,0)))").alias("score"),
                         F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, size)]
        rows = rows.withColumn("cut", F.least(*cuts) if len(cuts) > 1 else cuts[0])
        covers = None
        for longer in range(size + 1, max_words + 1):
            for first in range(1, longer - size + 2):
                one = levels[longer].select(*[F.col(f"s{first + j}").alias(f"s{j + 1}") for j in range(size)], F.col("n").alias("most"))
                covers = one if covers is None else covers.unionByName(one)
        keys = [f"s{j + 1}" for j in range(size)]
        if covers is not None:
            rows = rows.join(covers.groupBy(*keys).agg(F.max("most").alias("most")), keys, "left")
            rows = rows.where((F.col("most").isNull()) | (100 * F.col("most") < covered * F.col("a")))
        rows = rows.join(lang_of, "s1")
        scored.append(rows.select("lang_key", F.array(*keys).alias("symbols"), "a", "cut.l", "cut.r", "cut.score"))
    scored = stored(reduce(DataFrame.unionByName, scored), "scored")

    # Words are spelled out for phrases that can still be among the first; ties in both numbers stay.
    # What is not among the first of a part of its language's is not among the first of all, so no task ranks all of a language.
    best = scored
    for keys in (["lang_key", F.pmod(F.xxhash64("symbols"), F.lit(RANKED))], ["lang_key"]):
        near = F.rank().over(Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("a").desc()))
        best = best.withColumn("near", near).where(F.col("near") <= top).drop("near")
    best = stored(best.withColumn("row", F.monotonically_increasing_id()), "best")
    used = best.select("row", F.posexplode("symbols").alias("at", "s1"))
    few = None
    if best.count() * max_words <= MAX_SPELLED:
        few = spark.sparkContext.broadcast(np.sort(used.select("s1").distinct().toArrow().column("s1").to_numpy().view(np.uint64)))
    spelled = _rows(docs, text_col, lang_col).mapInArrow(_spell(few), "s1 long, word string")
    if few is None:
        spelled = spelled.join(used.select("s1").distinct(), "s1", "left_semi")
    spelled = spelled.groupBy("s1").agg(F.min("word").alias("word"))
    text = used.join(spelled, "s1").groupBy("row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    langs = docs.select(F.coalesce(lang_col, F.lit(NO_LANGUAGE)).alias("lang")).distinct().withColumn("lang_key", F.xxhash64("lang"))
    totals = words.groupBy("lang_key").agg(F.sum("n").alias("n"))
    out = best.join(text, "row").join(langs, "lang_key").join(totals, "lang_key")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    out = out.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
