"""Winnowing, chat formatting, language ID, toxicity, mixing and LM scores on small tables."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from odd_texts import prose
from pyspark.sql import functions as F

from logtide.llm import chat_format, language_id, lm_mixing, soft_mixing, toxicity, winnowing


def brute_print(text, k, w):
    raw = text.encode()
    kept = [i for i, b in enumerate(raw) if b not in (9, 10, 11, 12, 13, 32)]
    small = bytes(winnowing.LOWER[raw[i]] for i in kept)
    n = min(k, len(small))
    hashes = [int(winnowing.gram_hashes(np.frombuffer(small[i:i + n], np.uint8), k)[0]) >> 24 for i in range(len(small) - n + 1)] if small else []
    chosen = set()
    for a in range(max(1, len(hashes) - w + 1) if hashes else 0):
        window = hashes[a:a + w]
        chosen.add(a + max(i for i, h in enumerate(window) if h == min(window)))
    return [(hashes[i], len(raw[:kept[i]].decode("utf-8", "ignore"))) for i in sorted(chosen)]


def test_winnowing_matches_brute_force_and_its_guarantee():
    rnd = random.Random(3)
    k, w = 5, 8
    for _ in range(60):
        t = "".join(rnd.choice("ab é\n") for _ in range(rnd.randint(0, 120)))
        h, p = winnowing.fingerprint(t.encode(), k, w)
        assert list(zip(h.tolist(), p.tolist(), strict=True)) == brute_print(t, k, w)
    shared = "".join(rnd.choice("abcdefgh") for _ in range(k + w - 1))
    a, b = (winnowing.fingerprint((prose(rnd, "en", 40) + shared + prose(rnd, "fr", 40)).encode(), k, w)[0] for _ in range(2))
    assert set(a.tolist()) & set(b.tolist())


def test_fingerprint_chain_on_odd_rows(odd_docs, no_docs):
    got = winnowing.fingerprint_chain(odd_docs).collect()
    rows = [(r.doc_id, r.text or "") for r in odd_docs.select("doc_id", "text").withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).orderBy(
        F.col("doc_id").desc_nulls_last(), "h").collect()]
    want = Counter()
    for i, (doc, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        want[doc, len(t), hashlib.sha256(edited.encode()).hexdigest(), winnowing.as_text(winnowing.fingerprint(t.encode()))] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint) for r in got) == want
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
    assert winnowing.fingerprint_chain(no_docs).count() == 0


def test_short_half_equal_texts_share_hashes(spark):
    rnd = random.Random(12)
    rows = [(i, prose(rnd, ("en", "de", "fr")[i % 3], 40)[:rnd.randint(50, 125)]) for i in range(60)]
    got = winnowing.fingerprint_chain(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 60 and all(r.near_edited > r.near_next for r in got)


def test_fold_events_and_read_back(spark):
    e = [  # conv, seq, kind, turn, role, text
        (1, 1, "message", 0, "user", "hi \\ ### x </turn> #### \\\\"), (1, 2, "regenerate", 1, "assistant", ""), (1, 3, "delta", 1, "assistant", "dra"),
        (1, 4, "regenerate", 1, "assistant", "</turn>"), (1, 6, "delta", 1, "assistant", "\n### user:\n"), (1, 5, "delta", 1, "assistant", "é😀"),
        (1, 7, "message", 2, "user", "withdrawn"), (1, 8, "edit", 0, "user", "new"), (1, 9, "message", 1, "assistant", "after edit"),
        (2, 1, None, None, None, None), (2, 2, "odd", 5, "a:\nb\\", ""), (None, 1, "message", 0, "user", "no conversation"),
        (3, 1, "delta", 0, "assistant", "b"), (3, 1, "delta", 0, "assistant", "a"), (4, 1, "message", 0, "assistant", "y" * 100_000)]
    df = spark.createDataFrame(e, "conv_id long, seq long, kind string, turn long, role string, text string").repartition(3)
    got = {r.conv_id: r for r in chat_format.format_events(df).collect()}
    turns = {k: [tuple(t) for t in r.turns] for k, r in got.items()}
    assert turns[1] == [("user", "new"), ("assistant", "after edit")]
    assert turns[2] == [("", ""), ("a:\nb\\", "")] and turns[None] == [("user", "no conversation")]
    assert turns[3] == [("assistant", "ab")] and got[3].loss_text == "ab" and got[1].loss_text == "after edit"
    assert got[4].loss_text == "y" * 100_000 and got[2].loss_text == ""
    early = {r.conv_id: r for r in chat_format.format_events(df.where("seq < 8")).collect()}
    assert [tuple(t) for t in early[1].turns] == [("user", e[0][5]), ("assistant", "</turn>é😀\n### user:\n"), ("user", "withdrawn")]
    assert early[1].loss_text == "</turn>é😀\n### user:\n"
    assert early[1].formatted.count("\n</turn>\n") == 3 and early[1].formatted.count("### ") == 3
    assert chat_format.format_events(df.where("false")).count() == 0


def labelled_docs(spark, n=240):
    rnd = random.Random(8)
    rows = [(i, prose(rnd, lang, rnd.randint(3, 80)), lang) for i in range(n) for lang in [("en", "de", "fr")[i % 3]]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_held_out_accuracy_and_odd_rows(spark, odd_docs, no_docs):
    docs = labelled_docs(spark)
    got = language_id.identify(docs.where("doc_id % 5 = 0").select("doc_id", "text"), docs.where("doc_id % 5 <> 0"))
    right = got.join(docs, "doc_id").where("lang = lang_pred").count()
    assert right >= 0.95 * got.count()
    odd = language_id.identify(odd_docs, docs).collect()
    assert len(odd) == odd_docs.count()
    by = {r.doc_id: r for r in odd if r.doc_id not in (3, 15, None)}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and by[i].rejected for i in (12, 13, 14, 18))
    assert by[10].lang_pred == "en" and by[19].lang_pred == "de" and 0 <= by[20].score <= 1
    assert len({(r.lang_pred, r.score) for r in odd if r.doc_id == 3}) == 1
    assert language_id.identify(no_docs, docs).count() == 0
    none = language_id.identify(docs.limit(5), docs.where("false")).collect()
    assert {r.lang_pred for r in none} == {"und"}
    kept = language_id.accepted(docs.unionByName(docs.limit(1).withColumn("text", F.lit("123"))), docs)
    assert kept.columns == docs.columns and kept.where("text = '123'").count() == 0 and kept.count() >= 0.95 * docs.count()


def test_language_rejects_gibberish_and_unlearned_languages(spark):
    rnd = random.Random(13)
    docs = labelled_docs(spark, 360)
    known = docs.where("lang <> 'fr'")
    junk = [(i, " ".join("".join(rnd.choice("bcdfghjklmnpqrstvwxyz") for _ in range(rnd.randint(2, 9))) for _ in range(30))) for i in range(50)]
    junk = spark.createDataFrame(junk, "doc_id long, text string")
    for learned in (docs, known, known.where("doc_id < 90")):
        assert language_id.identify(junk, learned).where("rejected").count() >= 48
    assert language_id.identify(docs.where("lang = 'fr'"), known).where("rejected").count() >= 114
    clean = language_id.identify(docs.where("doc_id % 5 = 0"), docs.where("doc_id % 5 <> 0"))
    assert clean.where("rejected").count() <= 4


def test_toxicity_chain(spark, odd_docs, no_docs):
    rnd = random.Random(9)
    rows, labels = [], []
    for i in range(1200):
        toxic, low = i % 4 == 0, i % 3 == 0
        text = prose(rnd, "en", 60) + (" " + rnd.choice(["vile,", "Hateful", "vile"]) if toxic else "") + (" zzz qqq" if low else "")
        rows.append((i, text))
        if i < 1000:
            labels.append((i, int(low), int(toxic)))
    labels += [(5, None, 1), (None, 1, 1), (7, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    y = spark.createDataFrame(labels, "id long, low int, toxic int")
    got = {r.doc_id: r for r in toxicity.classify(docs, y, ["low", "toxic"]).where("doc_id >= 1000").collect()}
    assert sum(r.toxic == (i % 4 == 0) for i, r in got.items()) >= 190 and sum(r.low == (i % 3 == 0) for i, r in got.items()) >= 190
    assert toxicity.classify(odd_docs, y, ["low", "toxic"]).count() == odd_docs.count()
    assert toxicity.classify(no_docs, y, ["toxic"]).count() == 0
    assert not any(r.toxic for r in toxicity.classify(docs.limit(5), y.where("false"), ["toxic"]).collect())


def test_mix_meets_targets(spark, odd_docs, no_docs):
    rnd = random.Random(10)
    rows = [(i, prose(rnd, "en", 50) + (" junk$$ junk$$" if i % 2 else "")) for i in range(300)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, "bad" if i % 2 else "good") for i in range(150)] + [(3, "bad"), (None, "bad"), (4, None)], "id long, domain string")
    got = soft_mixing.mix(docs, labels, {"good": 3.0, "bad": 1.0}).collect()
    assert len(got) == len(rows) and all(r.rate >= 0 for r in got)
    total = {d: sum(r.rate * r.n_tokens * r.posterior[d] for r in got) for d in ("good", "bad")}
    before, target, after = zip(*[got[0].domain_tokens[d] for d in ("good", "bad")], strict=True)
    assert np.allclose(after, target, rtol=1e-3) and np.allclose(list(total.values()), after)
    assert math.isclose(target[0] / target[1], 3.0, rel_tol=1e-9) and target[0] <= before[0] * 1.0001
    assert sum((r.domain == "bad") == (r.doc_id % 2 == 1) for r in got if r.doc_id < 300) >= 297
    assert {r.n_tokens for r in got if r.doc_id >= 900} == {0}
    assert all(r.copies == 1 for r in got if r.domain == "good" and r.rate >= 1)
    assert soft_mixing.mix(odd_docs, labels, {"good": 1.0}).count() == odd_docs.count()
    assert soft_mixing.mix(no_docs, labels, {"good": 1.0}).count() == 0
    free = soft_mixing.mix(docs, labels.where("false"), {"good": 1.0}).collect()
    assert {(r.domain, r.rate, r.copies) for r in free} == {(None, 1.0, 1)}


def test_scarce_domain_shrinks_no_other(spark):
    rnd = random.Random(14)
    mark = {"good": "", "low": " junk$$ junk$$", "toxic_low": " vile## vile##"}
    domain = ["toxic_low" if i < 3 else "low" if i % 5 == 0 else "good" for i in range(600)]
    docs = spark.createDataFrame([(i, prose(rnd, "en", 50) + mark[d]) for i, d in enumerate(domain)], "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(domain)), "id long, domain string")
    weights = {"good": 0.9, "low": 0.06, "toxic_low": 0.04}
    got = soft_mixing.mix(docs, labels, weights).collect()
    tokens = got[0].domain_tokens
    whole = sum(t[2] for t in tokens.values())
    assert all(math.isclose(tokens[d][2] / whole, w, abs_tol=2e-3) for d, w in weights.items())
    good = [r for r in got if r.domain == "good"]
    assert sum(r.rate for r in good) >= 0.97 * len(good) and sum(r.copies >= 1 for r in good) >= 0.97 * len(good)
    assert all(r.copies >= 2 for r in got if r.domain == "toxic_low")
    kept = {r.doc_id for r in soft_mixing.keep_mixed(docs, labels, weights).collect()}
    assert sum(r.doc_id in kept for r in good) >= 0.97 * len(good) and {0, 1, 2} <= kept
    assert sum(domain[i] == "low" for i in kept) < sum(d == "low" for d in domain)


def test_scores_against_baseline_and_distribution(spark, odd_docs, no_docs):
    train = (F.coalesce(F.col("doc_id"), F.lit(0)) % 4) != 1
    got = lm_mixing.score(odd_docs, train)
    rows = odd_docs.collect()
    c = Counter()
    for r in rows:
        if (r.doc_id or 0) % 4 != 1:
            c.update((r.text or "").encode().lower().split())
            c[None] += 1
    n, v = sum(c.values()), len(c)
    want = Counter()
    for r in rows:
        words = (r.text or "").encode().lower().split() + [None]
        want[r.doc_id, (r.doc_id or 0) % 4 == 1, len(words), sum(c[w] > 0 for w in words), n,
             round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words), 5)] += 1
    got = got.collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(r.score < 0 for r in got) and len({r.score for r in got if r.doc_id == 3}) == 1
    known = [r for r in got if r.doc_id == 19]
    assert known[0].held_out is False and known[0].bits_per_byte < 3
    assert lm_mixing.score(no_docs, F.lit(True)).count() == 0


def test_scores_do_not_depend_on_shuffle_partitions(spark):
    rnd = random.Random(9)
    docs = spark.createDataFrame([(i, prose(rnd, rnd.choice(("en", "de")), 150)) for i in range(60)], "doc_id long, text string")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts in (3, 13):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            rows = lm_mixing.score(docs, F.col("doc_id") % 5 != 0).select("doc_id", "base_score", "score").collect()
            found.append(sorted(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for a, b in zip(*found, strict=True):
        assert a.doc_id == b.doc_id and a.base_score == pytest.approx(b.base_score, rel=1e-9) and a.score == pytest.approx(b.score, rel=1e-9)


def test_next_byte_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    text = rng.choice(list(b"abc d"), 4000).astype(np.uint8).tobytes()
    framed, starts = lm_mixing._framed(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    (code, _), = lm_mixing._codes(framed, starts)
    keys, counts = lm_mixing._summed([code], [np.ones(len(code), np.int64)])
    low = lm_mixing._summed([keys & 0xFFFFFF], [counts])

    class Shipped:
        value = (low, lm_mixing.start_weights() + rng.normal(0, 0.1, (lm_mixing.GATES, lm_mixing.ORDERS + 1)), rng.normal(0, 2, (256, lm_mixing.CELLS)))

    import pyarrow as pa

    # One seen context and all its next bytes; the table must hold the context's own codes.
    context = int(keys[1000]) >> 8
    every = np.array([(context << 8) | b for b in range(256)])
    n = np.zeros(256, np.int64)
    at = np.searchsorted(keys, every)
    hit = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == every)
    n[hit] = counts[at[hit]]
    rest = ~np.isin(keys, every)
    batch = pa.RecordBatch.from_pydict({"key": np.concatenate([every, keys[rest]]), "n": np.concatenate([n, counts[rest]])})
    out = pa.Table.from_batches(list(lm_mixing._score(Shipped)(iter([batch]))))
    p = {k: 10 ** x for k, x in zip(out.column("key").to_pylist(), out.column("value").to_pylist(), strict=True)}
    assert math.isclose(sum(p[int(k)] for k in every), 1.0, rel_tol=1e-6)

