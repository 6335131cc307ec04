"""The corpus pipeline stage by stage against plain Python, and the queries that have SQL."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from logtide.llm import language_id, queries, soft_mixing
from logtide.llm.common import documents, stored
from test_dedup import bag, likeness, norm


def test_every_stage(spark, sf001):
    docs = documents(spark, sf001)
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stored(stage(spark, docs, sf001), f"test-{name}")
        rows = out.collect()
        left[name] = {r.doc_id for r in rows}
        assert len(rows) == len(left[name])
        if name != "bpe":
            assert out.columns == columns and all(tuple(r) == tuple(before[r.doc_id]) for r in rows)
        if name == "language_id":
            found = language_id.identify(docs, queries.language_training_rows(docs)).collect()
            assert left[name] == {r.doc_id for r in found if not r.rejected} and len(rows) >= 0.97 * len(before)
        elif name == "exact_dedup":
            first = {}
            for i in sorted(before):
                first.setdefault(norm(before[i].text), i)
            assert left[name] == set(first.values())
        elif name == "near_dedup":
            ids = sorted(before)
            bags = {i: bag(before[i].text) for i in ids}
            root = {i: i for i in ids}

            def find(x, root=root):
                while root[x] != x:
                    x = root[x]
                return x

            for k, i in enumerate(ids):
                for j in ids[:k]:
                    if bags[i] and bags[j] and likeness(bags[i], bags[j]) >= 0.8:
                        a, b = sorted((find(i), find(j)))
                        root[b] = a
            assert left[name] == {find(i) for i in ids}
        elif name == "mixing":
            mixed = soft_mixing.mix(docs, queries.label_domains(spark, sf001), queries.TARGET_WEIGHTS).collect()
            assert left[name] == {r.doc_id for r in mixed if r.copies >= 1}
            good = [r for r in mixed if r.domain == "good"]
            assert sum(r.doc_id in left[name] for r in good) >= 0.97 * len(good)
        else:
            library = Tokenizer.from_file(queries.tokenizer_path())
            assert left[name] == set(before)
            for r in rows:
                text = before[r.doc_id].text or ""
                ids = library.encode(text, add_special_tokens=False).ids
                assert list(r.ids) == ids and r.n_tokens == len(ids)
                assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
                assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        docs = out


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, sf001, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf001}/{t}.parquet')")
    got = queries.QUERIES[name](spark, sf001)
    want = con.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert Counter(tuple(r) for r in got.select(*names).collect()) == Counter(want.fetchall())


def test_native_operators_run_no_python(spark, sf001):
    plans = defaultdict(str)
    for name in ("op3_soft_mixing", "op4_exact_dedup", "op8_chat_format"):
        plans[name] = queries.QUERIES[name](spark, sf001)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plans[name])
