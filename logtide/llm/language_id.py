"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its subwords (byte 2-, 3- and 4-grams inside words,
word ends included, hashed into ``2**BITS`` buckets); a linear softmax reads the
language off the average. Embeddings and softmax are trained together by stochastic
gradient descent in numpy on a bounded sample of labelled rows: about
``per_language`` rows of each language, chosen by a hash. The sample is parted into ``FOLDS`` folds;
each fold is scored by a model that the others trained, in a task of its own; the driver gets models
and scores, never the sample. These scores of the whole sample set the
softmax temperature and the rejection level, the confidence below which a share ``alpha`` of rightly
predicted texts falls (the least of them where they are fewer than 1 / ``alpha``, so that the level
is on at every sample size). The mean of the folds' models predicts.

Prediction is one pass over the table without a shuffle. As average and softmax are both
linear up to the logits, the model ships as one (bucket x language) table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.blocks import give_back, giving_back
from logtide.llm.bytes_np import LOWER, text_bytes
from logtide.llm.common import text_of, with_python, unused

BITS, DIM = 16, 16
#: Bound of the training sample: rows per language (expected; rows are drawn by a hash).
PER_LANGUAGE = 1500
EPOCHS, RATE, ALPHA = 6, 0.5, 0.01
#: Parts of the sample; each is scored by a model that the others trained.
FOLDS = 3
UNKNOWN = "und"
#: Bytes of text whose subwords are held at once.
SPAN = 1 << 19
#: Type of a bucket's number in the sample.
BUCKET = np.min_scalar_type((1 << BITS) - 1)

_LETTER = LOWER.copy()
for _b in range(128):
    if not chr(_b).isalpha():
        _LETTER[_b] = 32


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (buckets, languages): logits that one subword adds to the average
    bias: np.ndarray
    temperature: float
    reject_below: float


def _folded(data: np.ndarray) -> np.ndarray:
    """Letters lower-cased (ASCII and the Latin-1 letters of two bytes), all else a space."""
    out = _LETTER[data]
    high = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == 0xC3) & (data[1:] != 0x97)) + 1
    out[high] += 32
    return out


def _subwords(text: np.ndarray) -> Iterator[np.ndarray]:
    """Bucket of the 2-, 3- and 4-gram that starts at each byte; bucket 0 where there is none."""
    t = np.concatenate([text, np.full(3, 32, np.uint8)]).astype(np.uint32)
    gap = t == 32
    n = len(text)
    code = t[:n] | t[1:n + 1] << np.uint32(8)
    valid = ~(gap[:n] & gap[1:n + 1])
    inner = np.zeros(n, bool)
    for k in (2, 3, 4):
        if k > 2:
            inner = inner | gap[k - 2:n + k - 2]
            code = code | t[k - 1:n + k - 1] << np.uint32(8 * (k - 1))
            valid = ~inner
        h = (code ^ np.uint32(k * 0x01000193)) * np.uint32(0x9E3779B1)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77)
        yield np.where(valid, (h >> np.uint32(32 - BITS)) | np.uint32(1), np.uint32(0)).astype(np.int32)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subwords of whole texts and their shares, packed: at most one entry per bucket."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        data = _folded(data) if len(data) else data
        packed, counts = [], []
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            total = np.zeros(1 << BITS, np.int64)
            for s in range(a, b, SPAN):
                # Three bytes beyond the span complete its last subwords.
                part = data[s:min(b, s + SPAN + 3)]
                for h in _subwords(part):
                    total += np.bincount(h[:SPAN], minlength=1 << BITS)
            total[0] = 0
            at = np.flatnonzero(total)
            packed.append(at.astype(BUCKET).tobytes())
            counts.append((total[at] / max(1, total.sum())).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("lang"), pa.array(packed, pa.binary()), pa.array(counts, pa.binary())],
            ["id", "lang", "subwords", "shares"])


def labelled_sample(labelled: DataFrame, per_language: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(id, lang, subwords, shares) of about ``per_language`` rows of each language; texts without a subword are left out."""
    rows = labelled.where(F.col(lang_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), text_of(text_col).alias("text"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = rows.where("false")
    if counts:
        share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, per_language / n))])
        draw = F.pmod(F.xxhash64(F.col("id"), F.lit("language sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
        picked = rows.where(draw < F.element_at(share, F.col("lang")))
    return picked.mapInArrow(giving_back(_features), "id long, lang string, subwords binary, shares binary").where(F.length("subwords") > 0)


def _fit(rows: list, c: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(logits that a subword adds, bias) of embeddings and softmax trained together by SGD."""
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (1 << BITS, DIM))
    out = rng.normal(0, 0.1, (DIM, c))
    bias = np.zeros(c)
    weight = np.array([len(rows) / (c * max(1, sum(r[2] == i for r in rows))) for i in range(c)])
    steps, done = max(1, EPOCHS * len(rows)), 0
    for _ in range(EPOCHS):
        for j in rng.permutation(len(rows)):
            at, share, y = rows[j]
            rate = RATE * (1 - done / steps)
            done += 1
            avg = share @ emb[at]
            z = avg @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            p *= min(5.0, weight[y])
            pull = out @ p
            out -= rate * np.outer(avg, p)
            bias -= 0.1 * rate * p
            # A subword's share of a text is small; the square root keeps rare ones learning.
            emb[at] -= rate * np.outer(np.sqrt(share), pull)
    return emb @ out, bias


def _fit_fold(copies: pa.Table) -> pa.Table:
    """One row: the model that a fold's complement trains, and its logits of the fold's rows. ``copies``: the whole
    sample, put in hash order here, so that every fold's task parts it alike."""
    try:
        fold = copies.column("fold")[0].as_py()
        ids, langs = [i or 0 for i in copies.column("id").to_pylist()], copies.column("lang").to_pylist()
        subwords, shares = ([np.frombuffer(x.as_buffer(), kind) for x in copies.column(name)]
                            for name, kind in (("subwords", BUCKET), ("shares", np.float32)))
        key = lambda j: (ids[j] * 2654435761 % (1 << 32), ids[j], langs[j], len(subwords[j]), zlib.crc32(shares[j], zlib.crc32(subwords[j])))
        languages = sorted(set(langs))
        index = {x: i for i, x in enumerate(languages)}
        rows = [(subwords[j], shares[j], index[langs[j]]) for j in sorted(range(len(ids)), key=key)]
        part, offset = _fit([r for i, r in enumerate(rows) if i % FOLDS != fold], len(languages), 7 + fold)
        own = rows[fold::FOLDS]
        logits = np.array([share @ part[at] + offset for at, share, _ in own])
        truth = np.array([y for *_, y in own], np.int64)
        return pa.table({"fold": pa.array([fold], pa.int32()), "languages": pa.array([languages], pa.list_(pa.string())),
                         **{name: pa.array([x.tobytes()], pa.binary()) for name, x in (("part", part), ("bias", offset), ("logits", logits), ("truth", truth))}})
    finally:
        give_back()


def train(sample: DataFrame, alpha: float = ALPHA) -> Model:
    """Fit one model for each fold's complement, calibrate on their out-of-fold scores, ship their mean.

    A task fits a fold; the driver gets (buckets x languages) logits of each and (rows x languages) scores.
    """
    copies = sample.withColumn("fold", F.explode(F.array(*map(F.lit, range(FOLDS)))))
    fits = copies.groupBy("fold").applyInArrow(
        _fit_fold, "fold int, languages array<string>, part binary, bias binary, logits binary, truth binary").collect()
    languages = fits[0]["languages"] if fits else []
    c = len(languages)
    numbers = {r["fold"]: {x: np.frombuffer(r[x]).reshape(-1, c) for x in ("part", "bias", "logits")} for r in fits}
    truths = {r["fold"]: np.frombuffer(r["truth"], np.int64) for r in fits}
    table, bias = np.zeros((1 << BITS, c)), np.zeros(c)
    truth = np.zeros(sum(map(len, truths.values())), int)
    logits = np.zeros((len(truth), c))
    for fold in sorted(numbers):
        table += numbers[fold]["part"] / FOLDS
        bias += numbers[fold]["bias"][0] / FOLDS
        logits[fold::FOLDS] = numbers[fold]["logits"]
        truth[fold::FOLDS] = truths[fold]
    table[0] = 0

    def confidence(t: float) -> np.ndarray:
        z = logits / t
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    best, level = 1.0, 0.0
    if len(truth):
        loss = lambda t: -np.log(np.maximum(confidence(t)[np.arange(len(truth)), truth], 1e-12)).mean()
        best = float(min(np.geomspace(0.25, 8, 41), key=loss))
        p = confidence(best)
        right = p.argmax(1) == truth
        # The k-th smallest confidence of n right predictions rejects a share of about alpha; too few of them
        # to support that share reject what is less sure than all of them.
        sure = np.sort(p.max(1)[right])
        level = float(sure[max(1, int(alpha * (len(sure) + 1))) - 1]) if len(sure) else 0.0
    return Model(languages, table.astype(np.float32), bias, best, level)


def _predict(model_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = model_of.value
        c = len(model.languages)
        span = max(1 << 14, SPAN // max(1, c // 4))
        for batch in batches:
            column = batch.column("text")
            data, offsets = text_bytes(column)
            n = len(offsets) - 1
            sums, seen = np.zeros((n, c)), np.zeros(n)
            folded = _folded(data) if len(data) else data
            # Whole texts one after another; a subword never crosses a text's end.
            for a in range(0, len(data), span):
                b = min(len(data), a + span)
                part = folded[a:min(len(data), b + 3)].copy()
                lo, hi = np.searchsorted(offsets, [a, b - 1], "right") - 1
                cuts = np.maximum(offsets[lo:hi + 1], a) - a
                own = np.arange(lo, hi + 1)
                keep = np.diff(np.append(cuts, b - a)) > 0
                cuts, own = cuts[keep], own[keep]
                ends = offsets[1:][(offsets[1:] > a) & (offsets[1:] < a + len(part))] - a
                for k, h in enumerate(_subwords(part), 2):
                    h = h[:b - a].copy()
                    for back in range(1, k):  # subwords that would reach into the next text
                        h[(ends - back)[(ends >= back) & (ends - back < len(h))]] = 0
                    got = model.table[h]
                    sums[own] += np.add.reduceat(got, cuts, axis=0, dtype=np.float64)
                    seen[own] += np.add.reduceat(h > 0, cuts, dtype=np.int64)
            z = (sums / np.maximum(seen, 1)[:, None] + model.bias) / model.temperature if c else sums
            lang, score = [UNKNOWN] * n, np.zeros(n)
            if c:
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                best = p.argmax(1)
                for i in range(n):
                    raw = data[offsets[i]:offsets[i + 1]]
                    if not len(raw):
                        continue
                    letter = bool(((_LETTER[raw] != 32) & (raw < 128)).any())
                    if letter or any(map(str.isalpha, column[i].as_py() or "")):
                        lang[i], score[i] = model.languages[best[i]], p[i, best[i]]
            known = np.array([x != UNKNOWN for x in lang], bool) if n else np.zeros(0, bool)
            rejected = ~known | (score < model.reject_below)
            keep = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in keep), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                [*keep, "lang_pred", "score", "rejected"])

    return giving_back(run)


def identify(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             per_language: int = PER_LANGUAGE, alpha: float = ALPHA) -> DataFrame:
    """One row per row of ``docs``: id, text_hash, lang_pred, score, rejected; learned from ``labelled``.

    ``lang_pred`` is a learned language, or ``und`` (score 0, rejected) for a text that is
    null or has no letter, and for all texts where no row carries a language. ``rejected``:
    ``und`` or a calibrated confidence under the rejection level. Predictions read the text
    alone. Repeated rows get equal predictions; an empty table gives no rows; null
    ids are carried along; texts are read whole; further columns are not looked at.
    """
    spark = docs.sparkSession
    with_python(spark)
    model = train(labelled_sample(labelled, per_language, id_col, text_col, lang_col), alpha)
    shipped = spark.sparkContext.broadcast(model)  # 2**16 rows x languages, fixed by parameters
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(_predict(shipped), "id long, text_hash long, lang_pred string, score double, rejected boolean")
    return found.withColumnRenamed("id", id_col)


def accepted(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents whose language is not rejected, with all their columns."""
    bad = identify(docs, labelled, id_col, text_col, **options).where("rejected").select(
        F.col(id_col).alias("_id"), F.col("text_hash").alias("_th")).distinct()
    mark = unused(docs, "_th")
    rows = docs.withColumn(mark, F.xxhash64(text_of(text_col)))
    return rows.join(bad, rows[id_col].eqNullSafe(bad["_id"]) & (rows[mark] == bad["_th"]), "left_anti").drop(mark)
