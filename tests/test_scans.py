"""Distributed prefix max and as-of lookup against brute force (tiny chunks)."""

import random

from logtide.operators.scans import asof_lookup, prefix_max


def test_prefix_max_small_chunks(spark):
    rnd = random.Random(7)
    vals = [(b, rnd.randint(-50, 100)) for b in range(0, 40, 1) if rnd.random() < 0.8]
    df = spark.createDataFrame(vals, "b long, v long")
    got = {r.b: (r.incl, r.excl) for r in prefix_max(df, "b", "v", inclusive_col="incl", exclusive_col="excl",
                                                     chunk=3).collect()}
    run = None
    for b, v in vals:
        before = run
        run = v if run is None else max(run, v)
        assert got[b] == (run, before)


def test_asof_lookup_both_directions(spark):
    rnd = random.Random(11)
    events = sorted({rnd.randint(0, 200) for _ in range(25)})
    ev = [(t, i) for i, t in enumerate(events)]  # value increases with key
    points = [rnd.randint(-20, 230) for _ in range(60)]
    edf = spark.createDataFrame(ev, "t long, v long")
    pdf = spark.createDataFrame([(p,) for p in points], "p long")
    fwd = {r.p: r.out for r in asof_lookup(pdf, "p", edf, "t", "v", "out", forward=True, chunk=17).collect()}
    bwd = {r.p: r.out for r in asof_lookup(pdf, "p", edf, "t", "v", "out", forward=False, chunk=17).collect()}
    for p in points:
        after = [v for t, v in ev if t >= p]
        before = [v for t, v in ev if t <= p]
        assert fwd[p] == (after[0] if after else None)
        assert bwd[p] == (before[-1] if before else None)
