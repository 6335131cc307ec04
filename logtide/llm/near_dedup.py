"""MinHash near-duplicates on word shingles with BagMinHash signatures.

A text is the multiset of its runs of five words (A-Z lower-cased). Two texts are linked
when their weighted Jaccard likeness (sum of the smaller counts over sum of the
larger) is 0.8 or more; groups are what links connect.

Signatures. BagMinHash draws, for every shingle and every unit of its weight, a
Poisson process of points; each point falls on one of ``m`` registers, and a register keeps
its smallest point. Weights are counts, so the unit levels are the natural
discretisation; they are visited as a hierarchy of dyadic intervals [0,1), [1,2), [2,4),
[4,8), ...: one process of rate 2**j stands for all units of an interval, each of its points
is handed down to a unit by its hash, and counts only if that unit lies below the
weight. A weight w costs log2(w) processes, and texts share exactly the points under the
smaller weight, so the share of equal registers is an unbiased estimate of the likeness.
Points are drawn up to the time at which all registers are filled; if one stays empty, the
time doubles and drawing goes on. All draws are hashes, so equal multisets agree.

Links. Texts with equal multisets are one class and go on as one representative. Bands
of ``r`` registers put representatives into buckets. No bucket is expanded into all its
pairs. What a text can share is bounded by its weight without the shingles that no other
candidate has; members that fall short of the bucket's lightest member drop out. The member
with the least weight of its own is the pivot, and every member is compared with it exactly.
Two further members may be linked although the pivot links neither; they are compared if

* the pivots' links leave them in different groups (else a link would change nothing),
* their distances to the pivot differ by 0.2 or less, as 1 - likeness is a metric; members are
  dealt into rings of that width, and only neighbouring rings meet,
* the weight they share with the pivot, and what they can share beside it, is enough, and
* signatures put them at ``estimate_floor`` or more (the standard error is 0.035 at 0.8).

Groups come from alternating large-star and small-star steps, whose tables live in the
shared folder; nothing is collected to the driver but row counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.blocks import byte_blocks, giving_back
from logtide.llm.bytes_np import mix, shingles, text_bytes, word_hashes
from logtide.llm.common import stored, text_of, with_python, unused

#: Words in a shingle, and the likeness from which two texts are near-duplicates.
WIDTH, LIKENESS = 5, 0.8
#: Bands and registers per band: a pair at likeness 0.8 shares no band with probability 0.00003.
BANDS, ROWS = 26, 5
ESTIMATE_FLOOR = 0.6
#: Bytes of text handled by one call in the signature tasks.
BLOCK_BYTES = 1 << 20

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53


def bag_minhash(elements: np.ndarray, weights: np.ndarray, m: int) -> np.ndarray:
    """Signature (m hashes) of a non-empty multiset: distinct element hashes with counts."""
    # Dyadic intervals [0,1), [1,2), [2,4), ... that reach under each weight.
    seeds, lows, rates, tops = [elements], [np.zeros(len(elements))], [np.ones(len(elements))], [weights]
    low = 1
    more = weights > low
    while more.any():
        e = elements[more]
        seeds.append(mix(e + np.array([low], np.uint64) * _GOLD))
        lows.append(np.full(len(e), float(low)))
        rates.append(np.full(len(e), float(low)))
        tops.append(weights[more])
        low *= 2
        more = weights > low
    seed, base, rate, top = map(np.concatenate, (seeds, lows, rates, tops))
    stop = m * (np.log(m) + 3.0) / float(weights.sum())
    while True:
        times, points = [], []
        s, lo, ra, to, x = seed, base, rate, top, np.zeros(len(seed))
        done = 0
        while len(s):
            mean = float((stop * ra).max())
            draws = 1 if mean < 1.0 and done == 0 else int(mean + 4.0 * np.sqrt(mean)) + 4
            draws = min(draws, max(1, 400_000 // len(s)))
            h = mix(s[:, None] + np.arange(done + 1, done + draws + 1, dtype=np.uint64)[None, :] * _GOLD)
            t = x[:, None] + np.cumsum(-np.log(_unit(h)) / ra[:, None], axis=1)
            hit = t <= stop
            # A point goes to one unit of its interval and counts below the weight only.
            unit = lo[:, None] + np.floor(np.where(lo[:, None] > 0, _unit(mix(h ^ _GOLD)) * ra[:, None] * (1 - 2.0 ** -53), 0.0))
            live = hit & (unit < to[:, None])
            times.append(t[live])
            points.append(h[live])
            go = hit[:, -1]
            s, lo, ra, to, x = s[go], lo[go], ra[go], to[go], t[go, -1]
            done += draws
        t, h = np.concatenate(times), np.concatenate(points)
        register = (mix(h + _GOLD) >> np.uint64(33)) % np.uint64(m)
        order = np.argsort(-t, kind="stable")
        out, full = np.zeros(m, np.uint64), np.zeros(m, bool)
        where = register[order].astype(np.int64)
        out[where] = h[order]
        full[where] = True
        if full.all():
            return out
        stop *= 2


def multiset(words: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of one text's word hashes, and how often each occurs."""
    return np.unique(shingles(words, width), return_counts=True)


def _signatures(bands: int, rows: int, width: int):
    m = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for whole in batches:
            for batch in byte_blocks(whole, "text", BLOCK_BYTES):
                words, first = word_hashes(*text_bytes(batch.column("text")))
                same, sizes, buckets, minis = [], [], [], []
                for a, b in zip(first[:-1], first[1:], strict=True):
                    e, n = multiset(words[a:b], width)
                    w = n.astype(np.uint64)
                    same.append(f"{int((mix(e) * w).sum(dtype=np.uint64)):016x}{int((mix(e ^ _GOLD) * w).sum(dtype=np.uint64)):016x}{int(n.sum()):x}")
                    sizes.append(int(n.sum()))
                    if not len(e):
                        buckets.append([])
                        minis.append(b"")
                        continue
                    sig = bag_minhash(e, n, m)
                    key = names.copy()
                    for j in range(rows):
                        key = mix(key + sig[j::rows])
                    buckets.append(key.astype(np.int64))
                    minis.append((sig >> np.uint64(48)).astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("th"), pa.array(same, pa.string()), pa.array(sizes, pa.int64()), pa.array(buckets, pa.list_(pa.int64())),
                     pa.array(minis, pa.binary())], ["id", "th", "same", "n", "buckets", "mini"])

    return giving_back(run)


def _compare(width: int):
    """Exact likeness of pairs (a, b, text_a, text_b); rows with equal a follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None

        def bag(text: str | None):
            words, _ = word_hashes(*text_bytes(pa.array([text], pa.string())))
            return multiset(words, width)

        for batch in batches:
            ids, ta, tb = batch.column("a").to_pylist(), batch.column("text_a"), batch.column("text_b")
            out = np.zeros(batch.num_rows)
            for i, a in enumerate(ids):
                if left is None or a != last:
                    last, left = a, bag(ta[i].as_py())
                e, n = bag(tb[i].as_py())
                at = np.searchsorted(left[0], e)
                at[at == len(left[0])] = 0
                both = left[0][at] == e
                least = float(np.minimum(n[both], left[1][at[both]]).sum())
                out[i] = least / (float(n.sum()) + float(left[1].sum()) - least)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out)], ["a", "b", "likeness"])

    return giving_back(run)


def likeness(pairs: DataFrame, texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """(a, b, likeness) for distinct pairs of ids of a table of texts (id, text); texts
    meet only in their pairs, sorted so that a text with many partners is read once."""
    rows = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    rows = rows.select("a", "b", "text_a", "text_b").sortWithinPartitions("a")
    return rows.mapInArrow(_compare(width), "a long, b long, likeness double")


def _rare(width: int):
    """Shingles of texts (id, text): (shingle, texts that have it in this batch, a text, its count there)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_blocks(whole, "text", BLOCK_BYTES):
                words, first = word_hashes(*text_bytes(batch.column("text")))
                bags = [multiset(words[a:b], width) for a, b in zip(first[:-1], first[1:], strict=True)]
                e = np.concatenate([x for x, _ in bags]) if bags else np.zeros(0, np.uint64)
                n = np.concatenate([x for _, x in bags]) if bags else np.zeros(0, np.int64)
                owner = np.repeat(batch.column("id").to_numpy(), [len(x) for x, _ in bags])
                keys, where, texts = np.unique(e, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(texts), pa.array(owner[where]), pa.array(n[where])],
                                                 ["shingle", "texts", "id", "n"])

    return giving_back(run)


def own_weight(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """(id, own): the weight of shingles that no other text of the table (id, text) has."""
    seen = texts.select("id", "text").mapInArrow(_rare(width), "shingle long, texts long, id long, n long")
    alone = seen.groupBy("shingle").agg(F.sum("texts").alias("texts"), F.min("id").alias("id"), F.min("n").alias("n")).where("texts = 1")
    return alone.groupBy("id").agg(F.sum("n").alias("own"))


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in the links (a, b): the smallest id that links connect it to.

    Alternates large-star and small-star (Kiveris et al. 2014): rounds grow with the logarithm
    of the number of ids, and each round is two grouped joins over a table in the shared folder.
    """
    both = lambda d: d.select("a", "b").unionByName(d.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        # Large star: each larger neighbour points to the smallest id around.
        near = both(edges)
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = near.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large.where("a <> b"), "large-star")
        # Small star: each smaller neighbour, and the id itself, points to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                                                 F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("x"))
        edges = stored(small.select("x.*").where("a <> b").distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if before == now:
            break
        before = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())


def _of_heads(rows: DataFrame, classes: DataFrame, *columns: str) -> DataFrame:
    """(rep, columns) of the rows that stand for the classes."""
    r, c = rows.alias("r"), classes.select("id", "th", "rep").alias("c")
    return r.join(c, F.expr("r.id <=> c.id AND r.th = c.th")).select("c.rep", *[f"r.{x}" for x in columns])


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
               threshold: float = LIKENESS, bands: int = BANDS, rows: int = ROWS,
               estimate_floor: float = ESTIMATE_FLOOR) -> DataFrame:
    """One row per input row: id, class_id (smallest id of its group), group_size, n_links, kept.

    ``n_links``: links to texts with another multiset that hold the row's class in its group.
    ``kept``: the row with its group's smallest id, one row of them where ids repeat.

    Defined cases: a null text counts as empty; texts without a word are one group; a text of
    fewer than five words is one shingle of all its words; texts are read whole; rows that
    repeat an id with other text are told apart by their text's multiset; null ids are
    one id after all others; an empty table gives no rows; further columns are not looked at.
    """
    with_python(docs.sparkSession)
    m = bands * rows
    # Rows are named by id and text hash: ids may repeat with other texts.
    rows_in = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).withColumn(
        "th", F.xxhash64("text"))
    signed = stored(rows_in.mapInArrow(_signatures(bands, rows, width),
                                       "id long, th long, same string, n long, buckets array<long>, mini binary"), "signatures")
    classes = stored(signed.groupBy("same").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("head"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"))
                     .select("same", F.xxhash64("same").alias("rep"), "head.id", "head.th", "n", "copies"), "classes")
    one = stored(_of_heads(signed, classes, "buckets", "mini").dropDuplicates(["rep"]), "representatives")
    member = one.select("rep", F.explode("buckets").alias("bucket"))
    shared = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    member = stored(member.join(shared, "bucket"), "buckets")
    # Texts of all members of shared buckets: every pair is among them.
    seen = classes.join(member.select("rep").distinct(), "rep", "left_semi")
    texts = stored(_of_heads(rows_in, seen, "text").withColumnRenamed("rep", "id").dropDuplicates(["id"]), "texts")

    # ``most``: weight that a text can share with any other. A pair needs ``part`` of both weights.
    part, slack = threshold / (1.0 + threshold), 1e-6
    own = own_weight(texts, width).withColumnRenamed("id", "rep")
    sized = seen.select("rep", "n").join(own, "rep", "left").select("rep", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("most"))
    member = stored(member.join(sized, "rep"), "members")
    least = member.groupBy("bucket").agg(F.min("n").alias("least"))
    member = member.join(least, "bucket").where(F.col("most") >= part * (F.col("n") + F.col("least")) - slack).drop("least")
    # The pivot is the member with the least weight of its own: the likeliest centre of its group.
    pivots = member.groupBy("bucket").agg(F.min(F.struct((F.col("n") - F.col("most")).alias("own"), "rep", "n")).alias("p"),
                                          F.count(F.lit(1)).alias("k")).where("k > 1")
    member = stored(member.join(pivots.select("bucket", F.col("p.rep").alias("pivot"), F.col("p.n").alias("pivot_n")), "bucket")
                    .where("rep <> pivot"), "stars")
    star = member.select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    first = stored(likeness(star, texts, width), "star")
    linked = first.where(F.col("likeness") >= threshold).select("a", "b")

    # Members of a bucket that the pivots leave in different groups may still be linked.
    groups = stored(components(linked), "star-groups").withColumnRenamed("id", "rep")
    reach = 1.0 - threshold
    far = member.join(first.select(F.col("a").alias("pivot"), F.col("b").alias("rep"), "likeness"), ["pivot", "rep"])
    far = far.join(groups, "rep", "left").withColumn("group", F.coalesce("root", "rep"))
    both = F.col("likeness") * (F.col("n") + F.col("pivot_n")) / (1 + F.col("likeness"))  # weight shared with the pivot
    bands_of = one.select("rep", F.transform("buckets", lambda x: x.bitwiseAND(0x7FFFFFFF).cast("int")).alias("bands"))
    far = far.withColumn("both", both).withColumn("rest", F.greatest(F.lit(0.0), F.col("most") - F.col("both")))
    far = far.withColumn("d", 1 - F.col("likeness")).withColumn("ring", F.floor(F.col("d") / reach)).withColumn("loose", F.col("likeness") < threshold)
    far = stored(far.join(bands_of, "rep").select("bucket", "rep", "n", "d", "ring", "loose", "group", "both", "rest", "bands"), "rings")
    x, y = far.alias("x"), far.where("loose").withColumn("near", F.explode(F.array(F.col("ring"), F.col("ring") - 1))).alias("y")
    may = F.expr(f"x.group <> y.group AND abs(x.d - y.d) <= {reach} + 1e-9 AND (y.ring > x.ring OR NOT x.loose OR y.rep > x.rep) "
                 f"AND least(x.both, y.both) + least(x.rest, y.rest) >= {part} * (x.n + y.n) - {slack} "
                 # Pairs that share several buckets are taken in the first.
                 "AND array_position(zip_with(x.bands, y.bands, (a, b) -> a = b), true) = array_position(x.bands, cast(x.bucket & 2147483647 as int))")
    pairs = x.join(y, F.expr("x.bucket = y.bucket AND x.ring = y.near") & may).select(
        F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()
    minis = one.select("rep", "mini")
    pairs = pairs.join(minis.select(F.col("rep").alias("a"), F.col("mini").alias("ma")), "a").join(
        minis.select(F.col("rep").alias("b"), F.col("mini").alias("mb")), "b")
    hexes = lambda c: F.expr(f"transform(sequence(0, {m - 1}), i -> substring({c}, 2 * i + 1, 2))")
    equal = F.aggregate(F.zip_with(hexes("ma"), hexes("mb"), lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    pairs = stored(pairs.where(equal / F.lit(float(m)) >= estimate_floor).select("a", "b"), "ring-pairs")
    second = likeness(pairs, texts, width)
    links = stored(linked.unionByName(second.where(F.col("likeness") >= threshold).select("a", "b")), "links")

    roots = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
    named = classes.join(roots.withColumnRenamed("id", "rep"), "rep", "left").join(degree, "rep", "left")
    named = named.withColumn("root", F.coalesce("root", "rep"))
    groups = named.groupBy("root").agg(F.min("id").alias("class_id"), F.sum("copies").alias("group_size"))
    named = named.join(groups, "root").select("same", "root", "class_id", "group_size", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = signed.select("id", "th", "same").join(named, "same")
    place = F.row_number().over(Window.partitionBy("root", "id").orderBy("th"))
    kept = F.col("id").eqNullSafe(F.col("class_id")) & (place == 1)
    return out.select(F.col("id").alias(id_col), "class_id", "group_size", "n_links", kept.alias("kept"),
                      F.col("th").alias("text_hash"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, one of each group, with all their columns."""
    kept = near_dedup(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("_keep"), F.col("text_hash").alias("_th"))
    mark = unused(docs, "_th")
    rows = docs.withColumn(mark, F.xxhash64(text_of(text_col)))
    stay = rows.join(kept, rows[mark].eqNullSafe(kept["_th"]) & rows[id_col].eqNullSafe(kept["_keep"]), "left_semi")
    return stay.dropDuplicates([id_col, mark]).drop(mark)
