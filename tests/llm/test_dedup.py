"""Exact dedup (extendible hash) and near dedup (BagMinHash) against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from logtide.llm import exact_dedup, near_dedup
from logtide.llm.bytes_np import mix



def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def check_exact(df, got):
    rows = [(r.doc_id, norm(r.text)) for r in df.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    want = Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(t.encode()).hexdigest()
        for k, i in enumerate(sorted(ids, key=lambda x: (x is None, x))):
            want[i, keep, len(ids), k == 0, sha] += 1
    assert Counter(tuple(r) for r in got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == want


def test_exact_groups(odd_docs):
    check_exact(odd_docs, exact_dedup.exact_dedup(odd_docs))


def test_exact_chains_when_keys_collide(odd_docs):
    """Two key bits: nearly all texts share keys, and buckets can't split further."""
    got = exact_dedup.exact_dedup(odd_docs, capacity=2, key_bits=2)
    check_exact(odd_docs, got)
    assert got.agg(F.max("chain_link")).first()[0] > 3


def test_directory_doubles_until_buckets_fit(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("key"))
    hot = spark.range(500).select((F.col("id") + (1 << 60)).alias("key"))  # share their first 50 bits and more
    d = exact_dedup.build_directory(keys.union(hot), capacity=64)
    assert d.agg(F.sum("n_keys")).first()[0] == 3500
    assert d.agg(F.max("n_keys")).first()[0] <= 64 and d.agg(F.max("depth")).first()[0] > 50


def test_exact_empty_table_and_kept_rows(odd_docs, no_docs):
    assert exact_dedup.exact_dedup(no_docs).count() == 0
    kept = exact_dedup.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert Counter(norm(r.text) for r in kept.collect()) == Counter({norm(r.text) for r in odd_docs.collect()})


def bag(text):
    w = (text or "").encode().lower().split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def likeness(a, b):
    least = sum((a & b).values())
    return least / (sum(a.values()) + sum(b.values()) - least)


def brute_groups(rows):
    bags = [bag(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            alike = bags[i] == bags[j] or bags[i] and bags[j] and likeness(bags[i], bags[j]) >= 0.8
            if alike:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i])
    return groups


def test_near_groups_match_brute_force(spark, odd_docs):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    for g in range(6):  # groups around the limit: 0 to 6 words of 90 replaced, and chains of edits
        text = rnd.choices(words, k=90)
        for k in range(14):
            copy = list(text)
            for _ in range(k % 7):
                copy[rnd.randrange(90)] = f"new{rnd.randrange(10 ** 6)}"
            if k % 3 == 0:
                text = copy
            rows.append((1000 + 100 * g + k, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_dedup.near_dedup(df).collect()
    assert len(got) == len(rows)
    want = Counter()
    for group in brute_groups(rows).values():
        ids = [i for i, _ in group if i is not None]
        low = min(ids) if ids else None  # a null id sorts last
        for i, _ in group:
            want[i, low, len(group)] += 1
    mine = Counter((r.doc_id, r.class_id, r.group_size) for r in got)
    assert mine == want
    assert sum(r.kept for r in got) == len(brute_groups(rows))


def test_near_empty_table(no_docs):
    assert near_dedup.near_dedup(no_docs).count() == 0


def test_bagminhash_estimates_weighted_likeness():
    rng = np.random.default_rng(0)
    m, errors = 130, []
    for _ in range(60):
        e = mix(rng.integers(1, 2 ** 63, 60, dtype=np.int64).astype(np.uint64))
        a, b = rng.integers(1, 40, 60), rng.integers(1, 40, 60)
        b[rng.random(60) < 0.5] = 0
        keep = b > 0
        sa, sb = near_dedup.bag_minhash(e, a, m), near_dedup.bag_minhash(e[keep], b[keep], m)
        errors.append((sa == sb).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07


def test_components_follow_long_chains(spark):
    links = [(i, i + 1) for i in range(60) if i % 20 != 19] + [(500, 400), (400, 450), (7, 7)]
    got = {r.id: r.root for r in near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: i // 20 * 20 for i in range(60)}, 400: 400, 450: 400, 500: 400}
