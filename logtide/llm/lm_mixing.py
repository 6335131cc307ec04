"""Language-model scores by logistic mixing of context predictors over bits.

A text is predicted bit by bit: eight decisions for each byte, and an end byte 0xFF that no
UTF-8 text holds. Five predictors know the last 0 to 4 bytes, hashed with the byte so far into
one 40-bit code (four bytes fit without collision), and estimate the next bit from how often it was 0
or 1 there in the training texts, with the estimate of the next shorter context as prior. Their estimates
meet in the logistic domain: a gate, chosen by the bit's place and by how often the longest contexts
were seen, picks a set of weights, and the weighted sum of the stretched estimates is the mixed
prediction. An adaptive probability map, indexed by the bits of the byte so far and by the mixed prediction, refines it.
All of this depends on earlier bits only, so the probabilities of all texts sum to one.

What is learned, and how it spreads over a cluster:

1. *Counts.* Every block of documents is cut into its distinct codes and words with their counts in
   training documents; Spark sums them over the corpus. The tables grow with the corpus and
   never leave Spark, but for the contexts of up to two bytes (2**24 numbers at most).
2. *Weights.* Codes are dealt to shards by the last three bytes of their context, so a shard holds all counts of
   its contexts of three and four bytes. Each shard runs online gradient steps over its codes, weighted
   by their counts and predicted as if the occurrence at hand had not been counted; the
   weights of all shards are averaged, and the next round starts from there. Shards follow from the
   codes alone, whatever tasks they fall to, so the model doesn't depend on the cluster's settings.
3. *Refinement.* The probability map is filled in the same way, from the mixed predictions.
4. *Scores.* Each distinct code is scored once; blocks get back the scores of their codes and
   the counts of their words by an equi-join and add them up for each document.

The same pass gives the baseline: words with add-one smoothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.bytes_np import text_bytes, word_hashes
from logtide.llm.common import stored, text_of, with_python

#: Text in a block of documents, and codes in a shard of the model (both set how many there are).
BLOCK_BYTES, SHARD_CODES = 20 << 20, 400_000
#: The least number of shards, so that small corpora spread too.
LEAST_SHARDS = 16
#: Bytes of text whose codes are held at once; places in it fit into 24 bits.
SPAN = 1 << 20
ORDERS, END = 5, 255
#: Key of the end of a text among the words; words have negative keys, codes are not negative.
END_KEY = -(1 << 63)
ROUNDS, RATE, FORGET, PRIOR = 2, 3.0, 0.995, 1.0
CELLS, LIMIT = 33, 8.0
#: A gate for each place in the byte and how often (from these counts on) the contexts of four and three bytes were seen.
OFTEN_LONG, OFTEN_SHORT = (1, 2, 3, 5, 9, 17, 65, 257), (1, 3, 9, 33, 257)
GATES = 8 * (len(OFTEN_LONG) + 1) * (len(OFTEN_SHORT) + 1)


# ------------------------------------------------------------------- bytes of a batch

def _slices(rows: pa.RecordBatch | pa.Table) -> Iterator[pa.RecordBatch | pa.Table]:
    """Runs of rows with up to four spans of text, or single rows with more."""
    at, held = 0, 0
    sizes = pc.fill_null(pc.binary_length(rows.column("text")), 0).to_pylist()
    for i, size in enumerate(sizes):
        if i > at and held + size > 4 * SPAN:
            yield rows.slice(at, i - at)
            at, held = i, 0
        held += size
    if at < len(sizes):
        yield rows.slice(at)


def _framed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, starts): four end bytes before each text and one after it, texts one after another."""
    n = len(offsets) - 1
    out = np.full(len(data) + 5 * n, END, np.uint8)
    starts = offsets + 5 * np.arange(n + 1)
    for at, a, b in zip(starts[:-1].tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        out[at + 4:at + 4 + b - a] = data[a:b]
    return out, starts


def _codes(framed: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, places) of each span: the (context, byte) code of every byte and end, sorted by code."""
    for a in range(4, len(framed), SPAN):
        b = min(len(framed), a + SPAN)
        part = framed[a - 4:b].astype(np.uint64)
        code = part[4:]
        for j in range(1, 5):
            code = code | part[4 - j:len(part) - j] << np.uint64(8 * j)
        place = np.arange(a, b)
        real = np.ones(b - a, bool)
        for j in range(4):  # not the four bytes before a text
            lead = starts[:-1] + j - a
            real[lead[(lead >= 0) & (lead < b - a)]] = False
        packed = np.sort((code[real] << np.uint64(24)) | (place[real] - a).astype(np.uint64))
        yield (packed >> np.uint64(24)).astype(np.int64), (packed & np.uint64((1 << 24) - 1)).astype(np.int64) + a


def _word_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all words (negative, never END_KEY) and the first word of each text."""
    h, first = word_hashes(data, offsets)
    return ((h | np.uint64(1 << 63)) | np.uint64(1)).view(np.int64), first


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    at = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    return k[at], np.add.reduceat(c, at) if len(at) else c


# ------------------------------------------------------------------------ 1 counts

def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, key, n): distinct keys of each block with their counts in its training texts."""
    now, keys, counts, held = None, [], [], 0

    def close() -> pa.RecordBatch:
        k, c = _summed(keys, counts)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(k), now, np.int64)), pa.array(k), pa.array(c)], ["block", "key", "n"])

    for whole in batches:
        block = whole.column("block").to_numpy()
        cuts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        for a, b in zip(cuts, np.append(cuts[1:], len(block)), strict=True):
            if keys and (block[a] != now or held > 2 * BLOCK_BYTES):
                yield close()
                keys, counts, held = [], [], 0
            now = int(block[a])
            for rows in _slices(whole.slice(a, b - a)):
                train = rows.column("train").to_numpy(zero_copy_only=False).astype(np.int64)
                data, offsets = text_bytes(rows.column("text"))
                framed, starts = _framed(data, offsets)
                for code, place in _codes(framed, starts):
                    at = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
                    if len(at):
                        own = train[np.searchsorted(starts, place, "right") - 1]
                        keys.append(code[at])
                        counts.append(np.add.reduceat(own, at))
                words, first = _word_keys(data, offsets)
                own = np.repeat(train, np.diff(first))
                k, c = _summed([words, np.full(1, END_KEY)], [own, np.full(1, train.sum())])
                keys.append(k)
                counts.append(c)
                held += len(data)
                if len(keys) > 32:
                    k, c = _summed(keys, counts)
                    keys, counts = [k], [c]
    if keys:
        yield close()


# ------------------------------------------------------------- 2, 3 mixing and refining

def _stretch(p: np.ndarray) -> np.ndarray:
    return np.log(p / (1 - p))


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -16, 16)))


class Contexts:
    """Counts of contexts: for each order the sorted codes (context, byte) with running sums."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, low: tuple[np.ndarray, np.ndarray]):
        """``codes`` hold whole contexts of three and four bytes, ``low`` those of up to two."""
        self.tables = []
        for order in range(ORDERS):
            k, c = (codes, counts) if order > 2 else low
            k, c = _summed([k & np.int64((1 << 8 * (order + 1)) - 1)], [c])
            self.tables.append((k, np.append(0, np.cumsum(c))))

    def totals(self, codes: np.ndarray) -> np.ndarray:
        """(orders, 9, codes): how often each context was followed by the first 0 to 8 bits of the byte."""
        out = np.empty((ORDERS, 9, len(codes)))
        for order, (keys, sums) in enumerate(self.tables):
            own = codes & np.int64((1 << 8 * (order + 1)) - 1)
            for bits in range(9):
                rest = np.int64(8 - bits)
                low = own >> rest << rest
                high = low + (np.int64(1) << rest)
                out[order, bits] = sums[np.searchsorted(keys, high)] - sums[np.searchsorted(keys, low)]
        return out


def _inputs(totals: np.ndarray, byte: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(stretched estimates, gate, node, bit value) of one bit of each byte."""
    seen, same = totals[:, bit], totals[:, bit + 1]
    value = (byte >> (7 - bit)) & 1
    ones = np.where(value == 1, same, seen - same)
    x, p = np.ones((ORDERS + 1, len(byte))), 0.5
    for order in range(ORDERS):
        p = np.clip((ones[order] + PRIOR * p) / (seen[order] + PRIOR), 1e-5, 1 - 1e-5)
        x[order] = _stretch(p)
    gate = bit * (len(OFTEN_LONG) + 1) + np.digitize(seen[ORDERS - 1], OFTEN_LONG)
    gate = gate * (len(OFTEN_SHORT) + 1) + np.digitize(seen[ORDERS - 2], OFTEN_SHORT)
    node = (1 << bit) | (byte >> (8 - bit))
    return x, gate, node, value


def _cell(logit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell below a logit in the probability map, and how far it lies towards the next."""
    x = (np.clip(logit, -LIMIT, LIMIT) + LIMIT) / (2 * LIMIT) * (CELLS - 1)
    low = np.minimum(x.astype(np.int64), CELLS - 2)
    return low, x - low


def start_weights() -> np.ndarray:
    w = np.zeros((GATES, ORDERS + 1))
    w[:, ORDERS - 1] = 1.0  # the longest context's estimate, as it is
    return w


def _partition(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """All (code, n) of a shard, sorted by code: about SHARD_CODES of them."""
    parts = [(b.column("key").to_numpy(), b.column("n").to_numpy()) for b in batches]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    k, c = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(k, kind="stable")
    return k[order], c[order]


def _learn(shipped, refine: bool):
    """Online steps over a shard's codes; gives (slot, value, mass) to be summed over shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, weights = shipped.value
        codes, counts = _partition(batches)
        model = Contexts(codes, counts, low)
        own = counts > 0
        codes, counts = codes[own], counts[own].astype(np.float64)
        order = np.argsort((codes * np.int64(-7046029254386353131)) & np.int64((1 << 62) - 1), kind="stable")
        weights = weights.copy()
        value, mass = np.zeros(weights.size), np.zeros(weights.size)
        hits, seen = np.zeros(256 * CELLS), np.zeros(256 * CELLS)
        curve = np.full(weights.shape, 10.0)
        for a in range(0, len(codes), 2048):
            at = order[a:a + 2048]
            byte, n = codes[at] & 255, counts[at]
            totals = np.maximum(model.totals(codes[at]) - 1.0, 0.0)  # without the occurrence at hand
            for bit in range(8):
                x, gate, node, y = _inputs(totals, byte, bit)
                logit = (weights[gate].T * x).sum(0)
                if refine:
                    c, part = _cell(logit)
                    for cell, share in ((c, 1 - part), (c + 1, part)):
                        np.add.at(hits, node * CELLS + cell, n * share * y)
                        np.add.at(seen, node * CELLS + cell, n * share)
                    continue
                p = _squash(logit)
                # Steps along each weight, scaled by recent curvature; the row sum bounds that of all together.
                reach = np.abs(x).sum(0)
                for k in range(ORDERS + 1):
                    pull = np.bincount(gate, n * (y - p) * x[k], GATES)
                    bend = np.bincount(gate, n * np.maximum(p * (1 - p), 0.01) * np.abs(x[k]) * reach, GATES)
                    curve[:, k] = FORGET * curve[:, k] + bend
                    weights[:, k] += RATE * pull / curve[:, k]
                mass.reshape(weights.shape)[:] += np.bincount(gate, n, GATES)[:, None]
        if refine:
            value, mass = hits, seen
        else:
            value = weights.ravel() * mass
        slot = np.flatnonzero(mass)
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(value[slot]), pa.array(mass[slot])], ["slot", "value", "mass"])

    return run


def _score(shipped):
    """(key, value): log10 probability of each code's byte after its context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, weights, refined = shipped.value
        codes, counts = _partition(batches)
        model = Contexts(codes, counts, low)
        for a in range(0, len(codes), 1 << 15):
            part = codes[a:a + (1 << 15)]
            totals, total = model.totals(part), np.zeros(len(part))
            for bit in range(8):
                x, gate, node, y = _inputs(totals, part & 255, bit)
                logit = (weights[gate].T * x).sum(0)
                c, share = _cell(logit)
                better = refined[node, c] * (1 - share) + refined[node, c + 1] * share
                p = np.clip(_squash((logit + better) / 2), 1e-6, 1 - 1e-6)
                total += np.log10(np.where(y == 1, p, 1 - p))
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total)], ["key", "value"])

    return run


def _each_shard(run):
    """``run`` (batches to batches) for one shard's table."""

    def task(shard: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(run(iter(shard.to_batches()))))

    return task


def train(codes: DataFrame, rounds: int = ROUNDS):
    """(lookup for ``_score``, codes grouped by shard) from all codes (key, n) of the corpus."""
    spark = codes.sparkSession
    low = np.array([(r["k"], r["n"]) for r in codes.where("n > 0").groupBy((F.col("key").bitwiseAND(0xFFFFFF)).alias("k"))
                    .agg(F.sum("n").alias("n")).toLocalIterator()], np.int64).reshape(-1, 2)  # 2**24 rows at most
    low = (low[:, 0].copy(), low[:, 1].copy())
    shards = max(LEAST_SHARDS, -(-codes.count() // SHARD_CODES))
    context = F.shiftright("key", 8).bitwiseAND(0xFFFFFF)
    dealt = codes.select("key", "n", F.pmod(F.xxhash64(context), F.lit(shards)).alias("shard"))
    # Twice as many tasks as shards, so that few tasks get several shards.
    dealt = dealt.repartition(2 * shards, "shard").groupBy("shard")
    weights = start_weights()

    def gathered(refine: bool) -> list:
        shipped = spark.sparkContext.broadcast((low, weights))
        sums = dealt.applyInArrow(_each_shard(_learn(shipped, refine)), "slot int, value double, mass double")
        return sums.groupBy("slot").agg(F.sum("value").alias("value"), F.sum("mass").alias("mass")).collect()  # GATES or CELLS rows

    for _ in range(rounds):
        for r in gathered(False):
            weights.flat[r["slot"]] = r["value"] / r["mass"]
    centre = np.linspace(-LIMIT, LIMIT, CELLS)
    hits, seen = np.tile(_squash(centre) * 20.0, (256, 1)), np.full((256, CELLS), 20.0)
    for r in gathered(True):
        hits.flat[r["slot"]] += r["value"]
        seen.flat[r["slot"]] += r["mass"]
    refined = _stretch(np.clip(hits / seen, 1e-5, 1 - 1e-5))
    return spark.sparkContext.broadcast((low, weights, refined)), dealt


# ------------------------------------------------------------------------ 4 scores

def _blocked(docs: DataFrame, id_col: str, text_col: str, train: Column) -> DataFrame:
    """(id, text, train, block): documents in blocks of about BLOCK_BYTES.

    Blocks are runs of rows of a file, so that cutting them takes no shuffle; rows that don't
    come straight from files are dealt by a hash of their id and text.
    """
    n, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(text_col))).first()
    columns = [F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"), train.alias("train")]
    try:
        per = max(1, n * BLOCK_BYTES // max(1, size or 1))
        return docs.select(*columns, F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / per)).alias("block"))
    except AnalysisException:  # no file behind the rows
        blocks = max(1, -(-(size or 0) // BLOCK_BYTES))
        rows = docs.select(*columns).withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
        return rows.repartition(max(1, blocks), "block").sortWithinPartitions("block")


def _total(all_train: int, distinct: int):
    unit = float(np.log10(all_train + distinct + 1.0))

    def run(key: tuple, docs: pa.Table, found: pa.Table) -> pa.Table:
        del key
        keys, values = found.column("key").to_numpy(), found.column("value").to_numpy()
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
        out = {c: [] for c in ("n_tokens", "n_known", "base_score", "score", "n_bytes")}
        for rows in _slices(docs):
            data, offsets = text_bytes(rows.column("text"))
            n = len(offsets) - 1
            framed, starts = _framed(data, offsets)
            score = np.zeros(n)
            for code, place in _codes(framed, starts):
                first = np.append(True, code[1:] != code[:-1]) if len(code) else np.zeros(0, bool)
                each = values[np.searchsorted(keys, code[first])]
                score += np.bincount(np.searchsorted(starts, place, "right") - 1, each[np.cumsum(first) - 1], n)
            words, bounds = _word_keys(data, offsets)
            words = np.insert(words, bounds[1:], END_KEY)
            bounds = bounds + np.arange(n + 1)
            c = values[np.searchsorted(keys, words)]
            tokens = np.diff(bounds)
            out["n_tokens"].append(tokens)
            out["n_known"].append(np.diff(np.append(0, np.cumsum(c > 0))[bounds]))
            out["base_score"].append(np.array([np.log10(c[a:b] + 1.0).sum() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]) - tokens * unit)
            out["score"].append(score)
            out["n_bytes"].append(np.diff(offsets))
        got = {k: np.concatenate(v) for k, v in out.items()}
        return pa.table({"id": docs.column("id"), "held_out": pa.array([not x for x in docs.column("train").to_pylist()]),
                         "n_tokens": pa.array(got["n_tokens"].astype(np.int64)), "n_known": pa.array(got["n_known"].astype(np.int64)),
                         "train_tokens": pa.array(np.full(docs.num_rows, all_train, np.int64)), "base_score": pa.array(got["base_score"]),
                         "score": pa.array(got["score"]), "n_bytes": pa.array(got["n_bytes"].astype(np.int64))})

    return run


SCHEMA = ("id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
          "n_bytes long")


def score(docs: DataFrame, train_rows: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.

    ``train_rows`` says which rows the model learns from. ``score`` is the log10 probability of
    the text and its end; ``bits_per_byte`` spreads it over the bytes and the end.

    Defined cases: a null text counts as empty (its end is still scored); texts are scored whole,
    whatever their length; repeated rows get equal rows; null ids are carried along; without training
    rows every bit has the estimates of empty contexts; an empty table gives no rows;
    further columns are not looked at. Words are told apart by 62-bit hashes: with n distinct
    words, two share one with a probability of n**2 / 2**63.
    """
    with_python(docs.sparkSession)
    rows = _blocked(docs, id_col, text_col, F.coalesce(train_rows, F.lit(False)))
    features = stored(rows.select("block", "train", "text").mapInArrow(_features, "block long, key long, n long"), "features")
    counts = stored(features.groupBy("key").agg(F.sum("n").alias("n")), "counts")
    words = counts.where("key < 0")
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    shipped, dealt = train(counts.where("key >= 0"))
    scored = stored(dealt.applyInArrow(_each_shard(_score(shipped)), "key long, value double"), "code-scores")
    values = words.select("key", F.col("n").cast("double").alias("value")).unionByName(scored)
    found = features.join(values, "key").select("block", "key", "value")
    out = rows.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_total(int(n), int(v)), SCHEMA)
    per_byte = -F.col("score") * F.lit(float(np.log2(10))) / (F.col("n_bytes") + 1)
    return out.withColumn("bits_per_byte", per_byte).withColumnRenamed("id", id_col)
