"""Importance resampling, phrase mining and the n-gram join against brute force; double-array tries; stored tables."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logtide.llm import exact_dedup, importance, language_id, near_dedup, ngram_join, phrases, queries, soft_mixing
from logtide.llm.double_array import Trie
from logtide.session import KEEP_RUNS, shared_dir
from odd_texts import prose

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# ------------------------------------------------------------------ 11

def plain_resample(docs, target, order=1, buckets=10_000, min_words=20, percent=10, seed=2024):
    def feats(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, order + 1) for i in range(len(w) - k + 1)]

    each = [(i, *feats(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in each for b in f), Counter(b for x in target for b in feats(x)[1])
    all_s, all_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, n, f in each:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        out.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    enough = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0], r[2]))
    drawn = {k: r for k, r in enumerate(enough[:len(enough) * percent // 100], 1)}
    ranked = Counter((*r, k) for k, r in drawn.items())
    left = Counter(out) - Counter(drawn.values())
    for r, n in left.items():
        ranked[(*r, None)] += n
    return ranked


@pytest.mark.parametrize("order", [1, 3])
def test_resampling_equals_plain_python(spark, odd_docs, order):
    target = [None, "", "again ONE two %% 34", "the wh oulding the", "12"]
    rows = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(odd_docs, rows, order=order, buckets=97, percent=40)
    want = plain_resample(rows_of(odd_docs, "doc_id", "text"), target, order=order, buckets=97, percent=40)
    assert Counter(rows_of(got, "doc_id", "n_words", "n_features", "weight", "score", "rank")) == want


def test_resampling_of_and_towards_nothing(spark, odd_docs, no_docs):
    assert importance.resample(no_docs, odd_docs).count() == 0
    got = importance.resample(odd_docs, no_docs, percent=100)
    assert got.where("rank IS NOT NULL").count() == got.where("n_words >= 20").count() > 0


# ------------------------------------------------------------------ 12

def test_double_array_counts_paths():
    rnd = np.random.default_rng(3)
    for n, symbols, size in ((0, 5, 2), (1, 1, 2), (400, 30, 2), (3000, 200, 3)):
        paths = np.unique((symbols * rnd.random((n, size)) ** 3).astype(np.int32), axis=0)
        rnd.shuffle(paths)
        text = (symbols * rnd.random(5000) ** 3).astype(np.int32)
        text[rnd.random(5000) < 0.1] = -1
        seen = Counter(zip(*[text[k:len(text) - size + 1 + k].tolist() for k in range(size)], strict=True))
        assert Trie(paths, symbols).count(text, size, len(paths)).tolist() == [seen[tuple(p)] for p in paths.tolist()]
    assert Trie(np.zeros((1, 3), np.int32), 1).count(np.zeros(2, np.int32), 3, 1).tolist() == [0]


def plain_phrases(rows, max_words=3, min_count=10, covered=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        inside = defaultdict(int)
        for p, a in cands.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        found = []
        for p, a in cands.items():
            if inside[p] and 100 * inside[p] >= covered * a:
                continue
            s, _, l, r = min((10 ** 6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((s, a, " ".join(p), l, r))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, k, p, a, l, r, n[lang], s) for k, (s, a, p, l, r) in enumerate(found[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("max_words,trie", [(3, 20), (4, 10 ** 6), (2, 5)])
def test_phrases_equal_plain_python(spark, max_words, trie):
    rnd = random.Random(9)
    words = ["Aa", "b", "c-d", "é", "ß", "e*", "f", "g"]
    rows = [(" ".join(rnd.choice(words) + rnd.choice(["", "", "", ".", ",\n", "\t"]) for _ in range(rnd.randint(0, 60))), rnd.choice(["en", "de", None]))
            for _ in range(80)] + [(None, "en"), ("", None), (" \n ", "fr"), ("x y z " * 500, "fr"), ("x y z " * 500, "fr")]
    docs = spark.createDataFrame([(t, lg, 1, "n") for t, lg in rows], "text string, lang string, n int, word string").repartition(3)
    got = phrases.mine(docs, max_words=max_words, min_count=4, covered=40, top=25, bits=12, trie_phrases=trie)
    assert sorted(rows_of(got, "lang", "rank", "phrase", "a", "l", "r", "n", "score")) == plain_phrases(rows, max_words, 4, 40, 25)


def test_phrases_take_blocks_in_batches_of_bounded_bytes(spark, tmp_path, monkeypatch):
    seen = {}

    def watch(name):
        task = getattr(phrases, name)

        def watched(*args):
            run = task(*args)

            def noting(batches):
                def noted():
                    for batch in batches:
                        (tmp_path / f"{name}-{batch.num_rows}").touch()
                        yield batch

                return run(noted())

            return noting

        monkeypatch.setattr(phrases, name, watched)

    for name in ("_buckets", "_candidates", "_walk"):
        watch(name)
    monkeypatch.setattr(phrases, "BATCH_BYTES", 1000, raising=False)
    rnd = random.Random(4)
    rows = [(" ".join(rnd.choice("abcdefghij") for _ in range(900)), "en") for _ in range(40)]
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    got = phrases.mine(spark.createDataFrame(rows, "text string, lang string").repartition(40))
    for path in tmp_path.iterdir():
        name, n = path.name.split("-")
        seen.setdefault(name, set()).add(int(n))
    # A block has more than 1000 bytes, so it is a batch of its own however many blocks a task has.
    assert seen == {"_buckets": {1}, "_candidates": {1}, "_walk": {1}}
    assert spark.conf.get(key) == before
    assert sorted(rows_of(got, "lang", "rank", "phrase", "a", "l", "r", "n", "score")) == plain_phrases(rows)


def test_phrase_buckets_are_counted_in_bounded_steps(monkeypatch):
    rnd = np.random.default_rng(7)
    every = type("Value", (), {"value": np.full(1, np.uint64(2 ** 64 - 1))})()
    batches = [pa.record_batch({"symbols": [rnd.integers(0, 2 ** 62, 50).tolist()], "low": [rnd.integers(0, 51, 400).astype("<u2").tobytes()], "high": [b""]})
               for _ in range(9)]

    def counts():
        out, rows = Counter(), list(phrases._buckets(every, None, 2, 16)(iter(batches)))
        for row in pa.Table.from_batches(rows).to_pylist():
            for at, n in zip(np.frombuffer(row["places"], "<u2").tolist(), row["counts"], strict=True):
                out[row["part"] * phrases.TOGETHER + at] += n
        return len(rows), out

    whole = counts()
    monkeypatch.setattr(phrases, "COUNTED", 700, raising=False)
    steps = counts()
    assert whole[0] == 1 and steps[0] > 3 and steps[1] == whole[1] and whole[1].total() > 3000


def test_double_array_counts_given_places_many_times():
    paths = np.array([[0, 1], [1, 1], [2, 0]], np.int32)
    text = np.array([0, 1, 1, 1, 2, 2, -1, 0, 0, 1], np.int32)
    assert Trie(paths, 3).count(text, 2, 3, np.arange(0, 10, 2), np.array([5, 7, 11, 13, 2 ** 40])).tolist() == [5 + 2 ** 40, 7, 0]


def test_phrases_of_many_tries_take_one_pass_over_the_blocks(spark, monkeypatch):
    passes = Counter()
    for name in ("_buckets", "_candidates", "_walk"):
        monkeypatch.setattr(phrases, name, lambda *args, name=name, task=getattr(phrases, name): passes.update([name]) or task(*args))
    rnd = random.Random(6)
    rows = [(" ".join(rnd.choice("abcdefghij") for _ in range(200)), rnd.choice(["en", "de"])) for _ in range(30)]
    got = phrases.mine(spark.createDataFrame(rows, "text string, lang string").repartition(5), min_count=5, bits=12, trie_phrases=40)
    assert sorted(rows_of(got, "lang", "rank", "phrase", "a", "l", "r", "n", "score")) == plain_phrases(rows, min_count=5)
    # 6000 places are 150 tries a level.
    assert passes == {"_buckets": 2, "_candidates": 2, "_walk": 2}


def test_phrases_are_dealt_combined_and_counted_by_shard(monkeypatch):
    rnd = np.random.default_rng(8)
    every = type("Value", (), {"value": np.full(1, np.uint64(2 ** 64 - 1))})()
    symbols = rnd.integers(0, 2 ** 62, 60)
    batches, want = [], Counter()
    for _ in range(9):
        own, row = rnd.permutation(symbols)[:50], (51 * rnd.random(500) ** 2).astype(np.int64)
        batches.append(pa.record_batch({"symbols": [own.tolist()], "low": [row.astype("<u2").tobytes()], "high": [b""]}))
        want.update((int(own[a]), int(own[b])) for a, b in zip(row[:-1], row[1:], strict=True) if max(a, b) < 50)
    monkeypatch.setattr(phrases, "DEALT", 700, raising=False)
    dealt = pa.Table.from_batches(list(phrases._candidates(every, None, every, 2, 8)(iter(batches))))
    assert set(dealt["shard"].to_pylist()) == set(range(8)) and dealt.num_rows > 16
    sent = sum(len(x) // 16 for x in dealt["phrases"].to_pylist())
    assert len(want) < sent < want.total()
    counted = phrases._walk(2, 5)(iter(dealt.sort_by("shard").to_batches(max_chunksize=3)))
    rows = [r for b in counted for r in b.to_pylist()]
    assert Counter({(r["s1"], r["s2"]): r["n"] for r in rows}) == Counter({p: n for p, n in want.items() if n >= 5})
    assert len(rows) == sum(n >= 5 for n in want.values())


@pytest.mark.parametrize("top", [1, 7])
def test_phrases_ranked_by_parts_keep_ties(spark, top):
    rows = [(". ".join(["q" + w + " z" + w for w in "abcdefghijklmnopqrst"] * k), lang) for k, lang in ((10, "en"), (12, "de"), (2, "en"))]
    got = phrases.mine(spark.createDataFrame(rows, "text string, lang string"), top=top)
    assert sorted(rows_of(got, "lang", "rank", "phrase", "a", "l", "r", "n", "score")) == plain_phrases(rows, top=top)


def test_phrases_of_odd_and_no_texts(odd_docs, no_docs):
    assert phrases.mine(no_docs).count() == 0
    got = phrases.mine(odd_docs)
    assert sorted(rows_of(got, "lang", "rank", "phrase", "a", "l", "r", "n", "score")) == plain_phrases(rows_of(odd_docs, "text", "lang"))


# ------------------------------------------------------------------ 13

def plain_components(rows, width=5, percent=80):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
        sets.append({tuple(w)} if 0 < len(w) < width else {tuple(w[i:i + width]) for i in range(len(w) - width + 1)})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return Counter((doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows))


def family(rnd, base, copies, edits):
    """Variants of a text, each with some words replaced, dropped or added."""
    out = []
    for _ in range(copies):
        w = base.split()
        for _ in range(rnd.randint(0, edits)):
            i = rnd.randrange(len(w))
            w[i:i + 1] = rnd.choice([[f"new{rnd.random()}"], [], [w[i], "more"]])
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed,percent", [(1, 80), (2, 80), (3, 60)])
def test_join_components_equal_all_pairs(spark, seed, percent):
    rnd = random.Random(seed)
    shared = prose(rnd, "en", 40)
    texts = [prose(rnd, "de", rnd.randint(3, 60)) for _ in range(40)]
    texts += [f"{shared} {prose(rnd, 'fr', rnd.randint(2, 12))}" for _ in range(40)]  # a passage that many share
    for _ in range(4):
        texts += family(rnd, prose(rnd, "en", rnd.randint(30, 150)), 25, 5)
    texts += [texts[0]] * 5 + ["", " ", "one two", "One  two"]
    rows = list(enumerate(rnd.sample(texts, len(texts))))
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), percent=percent)
    assert Counter(rows_of(got, "doc_id", "n_shingles", "component_id")) == plain_components(rows, percent=percent)


def test_join_of_odd_and_no_texts(odd_docs, no_docs):
    assert ngram_join.jaccard_components(no_docs).count() == 0
    got = ngram_join.jaccard_components(odd_docs)
    assert Counter(rows_of(got, "doc_id", "n_shingles", "component_id")) == plain_components(rows_of(odd_docs, "doc_id", "text"))


# --------------------------------------------------- stored tables, clashing names

def test_repeated_queries_leave_no_growing_set_of_folders(spark, sf001):
    sizes = []
    for _ in range(KEEP_RUNS + 2):
        queries.QUERIES["op4_exact_dedup"](spark, sf001)
        sizes.append(len(os.listdir(shared_dir(spark))))
    assert sizes[-1] == sizes[-2]


def test_stage_helpers_keep_columns_of_any_name(spark, sf001):
    docs = spark.createDataFrame([(i, f"the quick brown fox jumps over {i // 2} dogs", "en", f"s{i}", i) for i in range(20)],
                                 "doc_id long, text string, lang string, _sha string, _th long")
    labels = docs.select(F.col("doc_id").alias("id"), F.lit("good").alias("domain"))
    for kept in (exact_dedup.keep_first(docs), near_dedup.keep_one(docs), language_id.accepted(docs, docs.limit(0)),
                 soft_mixing.keep_mixed(docs, labels, {"good": 1.0})):
        rows = kept.collect()
        assert kept.columns == docs.columns and all(r["_sha"] == f"s{r.doc_id}" and r["_th"] == r.doc_id for r in rows)
