"""Toxicity categories by a chain of linear classifiers.

Categories are predicted one after another. Each model is a logistic regression over the words that
are present in a text (cut at anything but letters and digits, A-Z lower-cased) and over the
log-odds of all categories before it in the chain. Models later in the chain are trained
on out-of-fold predictions of the earlier ones, as a model's predictions for its own
training rows would be too sure.

Training reads a bounded sample of labelled rows, drawn by a hash and stratified by the
combination of categories, and keeps a bounded vocabulary of word hashes. Prediction is one
pass over the table without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.llm.bytes_np import NOT_ALNUM, text_bytes, word_hashes
from logtide.llm.common import text_of, with_python

#: Training rows for each combination of categories (expected), and words of the vocabulary.
PER_COMBINATION, VOCABULARY, LEAST_DOCS = 2500, 100_000, 3
FOLDS, EPOCHS, RATE, DECAY, LEAST_CUT = 3, 6, 0.3, 1e-4, 0.3
BLOCK_ROWS = 256


@dataclass
class Linear:
    words: np.ndarray  # weight of each vocabulary word
    chain: np.ndarray  # weight of the log-odds of each earlier category
    bias: float
    cut: float = 0.5


@dataclass
class Chain:
    categories: list[str]
    vocabulary: np.ndarray  # sorted word hashes
    models: list[Linear] = field(default_factory=list)


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct word hashes of whole texts, packed."""
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK_ROWS):
            batch = whole.slice(at, BLOCK_ROWS)
            words, first = word_hashes(*text_bytes(batch.column("text")), NOT_ALNUM)
            packed = [np.unique(words[a:b]).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), pa.array(packed, pa.binary())], ["id", "y", "words"])


def labelled_sample(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str, text_col: str, per_combination: int) -> list:
    """About ``per_combination`` rows of each combination of categories, in hash order.

    ``labels``: (id, one 0/1 column for each category); rows with a null are left out, of
    several rows of an id the largest values count.
    """
    y = labels.groupBy("id").agg(*[F.max(F.col(c).cast("int")).alias(c) for c in categories]).dropna()
    y = y.select("id", F.concat(*[F.col(c).cast("string") for c in categories]).alias("y"))
    totals = {r["y"]: r["n"] for r in y.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # 2**categories at most
    if not totals:
        return []
    share = F.create_map(*[F.lit(x) for k, n in sorted(totals.items()) for x in (k, min(1.0, per_combination / n))])
    draw = F.pmod(F.xxhash64("id", F.lit("toxicity sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = y.where(draw < F.element_at(share, F.col("y")))
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    # The sample holds about per_combination rows for each of at most 2**categories combinations.
    rows = rows.join(F.broadcast(picked), "id").select(F.col("id").cast("long").alias("id"), "y", "text")
    got = rows.mapInArrow(_presence, "id long, y string, words binary").collect()
    return sorted(got, key=lambda r: ((r["id"] or 0) * 2654435761 % (1 << 32), r["id"] or 0, bytes(r["words"])))


def _fit(rows: list[np.ndarray], earlier: np.ndarray, y: np.ndarray, size: int) -> Linear:
    """Logistic regression by adaptive gradient steps over single rows."""
    w, g = np.zeros(size), np.full(size, 1e-2)
    c, gc = np.zeros(earlier.shape[1]), np.full(earlier.shape[1], 1e-2)
    rate = y.mean() if len(y) else 0.0
    b, gb = float(np.log((rate + 1e-3) / (1 - rate + 1e-3))), 1.0
    rng = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at = rows[i]
            z = w[at].sum() + earlier[i] @ c + b
            e = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - y[i]
            grad = e + DECAY * w[at]
            g[at] += e * e
            w[at] -= RATE * grad / np.sqrt(g[at] + len(at))
            gradc = e * earlier[i] + DECAY * c
            gc += gradc ** 2
            c -= RATE * gradc / np.sqrt(gc + 1.0)
            gb += e * e
            b -= RATE * e / np.sqrt(gb)
    return Linear(w, c, b)


def _odds(model: Linear, rows: list[np.ndarray], earlier: np.ndarray) -> np.ndarray:
    return np.array([model.words[at].sum() for at in rows]) + earlier @ model.chain + model.bias if rows else np.zeros(0)


def _best_cut(odds: np.ndarray, y: np.ndarray) -> float:
    """Probability from which a category is set: the best F1 of out-of-fold predictions, ``LEAST_CUT`` at least."""
    order = np.argsort(-odds)
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + max(1.0, y.sum()))
    if not y.sum():
        return 1.0
    k = int(f1.argmax())
    low = odds[order[k + 1]] if k + 1 < len(y) else odds[order[k]] - 1.0
    z = np.clip((odds[order[k]] + low) / 2, -6, 6)
    return max(LEAST_CUT, float(1 / (1 + np.exp(-z))))


def train(sample: list, categories: list[str], vocabulary: int = VOCABULARY, folds: int = FOLDS) -> Chain:
    """The chain fitted on a labelled sample."""
    bags = [np.frombuffer(bytes(r["words"]), np.uint64) for r in sample]
    seen, counts = np.unique(np.concatenate(bags), return_counts=True) if bags else (np.zeros(0, np.uint64), np.zeros(0, int))
    order = np.lexsort((seen, -counts))[:vocabulary]
    known = np.sort(seen[order][counts[order] >= LEAST_DOCS])
    chain = Chain(categories, known)
    rows = [_places(known, x) for x in bags]
    fold = np.arange(len(rows)) % folds
    earlier = np.zeros((len(rows), 0))
    for j in range(len(categories)):
        y = np.array([float(r["y"][j]) for r in sample])
        chain.models.append(_fit(rows, earlier, y, len(known)))
        out = np.zeros(len(rows))
        for f in range(folds):
            inside, outside = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            m = _fit([rows[i] for i in inside], earlier[inside], y[inside], len(known))
            out[outside] = _odds(m, [rows[i] for i in outside], earlier[outside])
        chain.models[-1].cut = _best_cut(out, y) if len(y) else 1.0
        earlier = np.column_stack([earlier, np.clip(out, -10, 10)])
    return chain


def _places(vocabulary: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Places in the vocabulary of distinct words."""
    if not len(vocabulary) or not len(words):
        return np.zeros(0, np.int64)
    at = np.searchsorted(vocabulary, words)
    at[at == len(vocabulary)] = 0
    return at[vocabulary[at] == words]


def _predict(shipped):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain: Chain = shipped.value
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(start, BLOCK_ROWS)
                words, first = word_hashes(*text_bytes(batch.column("text")), NOT_ALNUM)
                rows = [np.unique(_places(chain.vocabulary, words[a:b])) for a, b in zip(first[:-1], first[1:], strict=True)]
                earlier = np.zeros((len(rows), 0))
                columns, names = [batch.column("id")], ["id"]
                for name, model in zip(chain.categories, chain.models, strict=True):
                    z = np.clip(_odds(model, rows, earlier), -30, 30)
                    p = 1 / (1 + np.exp(-z))
                    columns += [pa.array(p), pa.array(p >= model.cut)]
                    names += [f"p_{name}", name]
                    earlier = np.column_stack([earlier, np.clip(z, -10, 10)])
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def classify(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text_col: str = "text",
             per_combination: int = PER_COMBINATION) -> DataFrame:
    """One row per input row: id, and for each category its probability ``p_<name>`` and decision ``<name>``.

    Defined cases: a null text counts as empty and has no words; without labelled rows all probabilities
    are those of an untrained model and no category is set; repeated rows get equal rows; null ids
    are carried along; texts are read whole; an empty table gives no rows; further columns
    of the inputs are not looked at.
    """
    spark = docs.sparkSession
    with_python(spark)
    sample = labelled_sample(docs, labels, categories, id_col, text_col, per_combination)
    shipped = spark.sparkContext.broadcast(train(sample, categories))  # VOCABULARY x categories weights at most
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    fields = [T.StructField("id", T.LongType())]
    for c in categories:
        fields += [T.StructField(f"p_{c}", T.DoubleType()), T.StructField(c, T.BooleanType())]
    return rows.mapInArrow(_predict(shipped), T.StructType(fields)).withColumnRenamed("id", id_col)
