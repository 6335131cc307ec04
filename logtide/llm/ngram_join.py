"""Jaccard self-join on sets of word runs by a grouped prefix join, and the components of its links.

A text's set holds its distinct runs of five words (shorter texts: one run of all words), as
64-bit hashes in ascending order. Two texts are linked when 100 * shared >= 80 * united; the
join is exact: every pair that could be linked is compared, or is known to be in one component.

1. *Classes.* Texts with equal sets are one class and take part once.
2. *Runs of one class alone.* Who is linked shares all but ``slack = floor(n * 20 / 100)`` of its n runs.
   A class with more runs that no other class has can't be linked. They are counted in two steps, on a
   quarter of the runs' hash space for all texts, and on the rest for the classes that are left; a part
   can only undercount what all of it holds, so nothing that is linked drops out.
3. *Groups.* Two linked sets share a run among their first ``slack + 1`` (their prefixes) in any order that is
   the same for all; here the rarest come first. Classes with identical prefixes and sizes are collapsed into one group; groups, not classes, stand in the inverted
   lists of prefix runs, and pairs of groups are filtered by size and by the place of the shared run.
4. *Members.* Pairs of groups are expanded and their members compared exactly, in two steps, so that a
   list is never expanded into all its pairs: first the list's pivot (the group whose prefix stands in the
   longest lists) against all others, whose links give components; then only members that the pivots
   left in different components, since a link inside a component changes nothing.
5. *Components* by alternating stars, of the first links, then of what the second ones join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.blocks import byte_blocks
from logtide.llm.bytes_np import mix, shingles, text_bytes, word_hashes
from logtide.llm.common import stored, text_of, with_python
from logtide.llm.near_dedup import components
from logtide.operators.joins import join_dimension

#: Words in a run, and the percentage of the united runs that linked texts share.
WIDTH, PERCENT = 5, 80
#: The first count looks at runs whose hash is a multiple of this.
PART = 4
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _each_set(block: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    """The distinct runs of every text of the block, ascending as signed numbers."""
    words, first = word_hashes(*text_bytes(block.column("text")))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield np.unique(shingles(words[a:b], width).view(np.int64))


def _names(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit names of a set; equal sets have equal names."""
    u = s.view(np.uint64)
    return tuple(int(mix(x).sum(dtype=np.uint64).view(np.int64)) for x in (u, u ^ _GOLD))


def _describe(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in byte_blocks(batch):
                rows = [(len(s), *_names(s)) for s in _each_set(block, width)]
                n, a, b = (pa.array(list(x), pa.int64()) for x in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([block.column("id"), block.column("th"), n, a, b], ["id", "th", "n", "a", "b"])

    return run


def _some_runs(width: int, part: int):
    """(run, name of its set) for runs whose hash is a multiple of ``part``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in byte_blocks(batch):
                found, names = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for s in _each_set(block, width):
                    found.append(s[s % part == 0])
                    names.append(np.full(len(found[-1]), _names(s)[0]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(np.concatenate(names))], ["run", "owner"])

    return run


def _all_runs(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in byte_blocks(batch):
                sets = list(_each_set(block, width))
                at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([block.column("rep"), runs], ["rep", "runs"])

    return run


def _alone(runs: DataFrame) -> DataFrame:
    """(owner, alone): for rows (run, owner), how many runs only this owner has."""
    owners = runs.groupBy("run").agg(F.min("owner").alias("owner"), F.max("owner").alias("other"))
    return owners.where("owner = other").groupBy("owner").agg(F.count(F.lit(1)).alias("alone"))


def _slack(n: str, percent: int) -> Column:
    """Runs that a set of n may have beside those that it shares with a linked one."""
    return F.expr(f"({n} * {100 - percent}) div 100")


def _enough(shared: str, n: str, percent: int) -> str:
    """Whether sets that have ``n`` runs, added up, and share so many are linked."""
    return f"{100 + percent} * ({shared}) >= {percent} * ({n})"


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of sets (rep, n, runs) with ``shared`` and ``united``, the numbers of their runs."""
    side = lambda c: sets.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("runs").alias(f"runs_{c}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").withColumn("shared", F.size(F.array_intersect("runs_a", "runs_b")).cast("long"))
    return both.select("a", "b", "shared", (F.col("n_a") + F.col("n_b") - F.col("shared")).alias("united"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                       percent: int = PERCENT, part: int = PART) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id reachable by links, itself included), copies
    (rows with an equal set).

    Defined cases: a null text counts as empty; texts without a word have an empty set and are linked with
    nothing, not even with each other; a text of fewer than five words is one run of all its words; repeated
    rows and rows that repeat an id are rows of their own, linked through their texts; null ids come after all
    others, so a component has a null id only if all its rows do; texts are read whole; an empty table
    gives no rows; further columns are not looked at.
    """
    with_python(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).withColumn("th", F.xxhash64("text"))
    described = stored(rows.mapInArrow(_describe(width), "id long, th long, n long, a long, b long"), "sets")
    classes = described.where("n > 0").groupBy("n", "a", "b").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("head"), F.count(F.lit(1)).alias("copies"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("rep"), "n", "a", "b", "head.id", "head.th", "copies"), "classes")

    # Runs that one class alone has, first in a part of the hash space.
    alone = _alone(rows.select("text").mapInArrow(_some_runs(width, part), "run long, owner long")).withColumnRenamed("owner", "a")
    named = classes.groupBy("a").agg(F.count(F.lit(1)).alias("classes"))  # should two classes share a name, both stay
    left = classes.join(alone, "a", "left").join(named, "a").where(
        (F.coalesce("alone", F.lit(0)) <= _slack("n", percent)) | (F.col("classes") > 1))
    left = stored(left.select("rep", "n", "id", "th", F.when(F.col("classes") == 1, F.coalesce("alone", F.lit(0))).otherwise(F.lit(0)).alias("alone")), "candidates")
    heads = left.select("rep", F.col("id").alias("head_id"), F.col("th").alias("head_th"))
    texts = join_dimension(rows, heads, rows["id"].eqNullSafe(heads["head_id"]) & (rows["th"] == heads["head_th"]), "inner")
    runs = texts.select("rep", "text").dropDuplicates(["rep"]).mapInArrow(_all_runs(width), "rep long, runs array<long>")
    runs = stored(runs, "runs")
    rest = runs.select(F.explode("runs").alias("run"), F.col("rep").alias("owner")).where(F.col("run") % part != 0)
    more = _alone(rest).select(F.col("owner").alias("rep"), F.col("alone").alias("more"))
    sized = left.select("rep", "n", "alone").join(more, "rep", "left").withColumn("own", F.col("alone") + F.coalesce("more", F.lit(0)))
    sized = sized.where(F.col("own") <= _slack("n", percent)).select("rep", "n", "own")
    sets = stored(runs.join(sized.select("rep", "n"), "rep"), "sets-left")

    # Rare runs come first, so that what many sets share stands in few prefixes. Runs of one set alone come before
    # them: they lead to nobody, and only the others of a prefix are kept, at their places.
    each = sets.select("rep", "n", F.explode("runs").alias("run"))
    often = stored(each.groupBy("run").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared-runs")
    order = each.join(often, "run").groupBy("rep", "n").agg(F.array_sort(F.collect_list(F.struct("df", "run"))).alias("order"))
    order = order.withColumn("own", F.col("n") - F.size("order")).where(F.col("own") <= _slack("n", percent))
    prefix = F.slice(F.col("order.run"), F.lit(1), (_slack("n", percent) + 1 - F.col("own")).cast("int"))
    order = order.select("rep", "n", "own", prefix.alias("prefix"))
    order = stored(order.withColumn("p", F.xxhash64("prefix")).withColumn("q", F.xxhash64(F.lit(1), "prefix")), "prefixes")

    # Groups of identical prefixes and sizes, and the inverted lists that they share.
    alike = ["n", "own", "p", "q"]
    groups = order.groupBy(*alike).agg(F.min("rep").alias("head"), F.count(F.lit(1)).alias("members"))
    groups = stored(groups.select(F.monotonically_increasing_id().alias("gid"), *alike, "head", "members"), "groups")
    members = stored(order.drop("prefix").join(groups.select("gid", *alike), alike).select("rep", "gid", "n", "own"), "members")
    posted = groups.join(order.select(F.col("rep").alias("head"), "prefix"), "head").select(
        "gid", "n", "own", "head", "members", F.posexplode("prefix").alias("at", "run")).withColumn("at", F.col("own") + F.col("at"))
    posted = stored(posted, "postings")
    # A list's pivot is the group whose prefix runs stand in the longest lists: the likeliest centre of its like.
    sizes = posted.groupBy("run").agg(F.sum("members").alias("k")).where("k > 1")
    posted = stored(posted.join(sizes, "run").select("run", "gid", "n", "at", "head", "k"), "shared-postings")
    centres = posted.groupBy("gid").agg((F.sum("k") / F.first(_slack("n", percent) + 1)).alias("centre"))
    posted = posted.join(centres, "gid")
    lists = posted.groupBy("run").agg(F.max(F.struct("centre", "head", "n", "at")).alias("pivot"))
    lists = stored(lists.select("run", F.col("pivot.head").alias("pivot"), F.col("pivot.n").alias("pivot_n"), F.col("pivot.at").alias("pivot_at")), "lists")
    posted = stored(posted.join(lists, "run").select("run", "gid", "n", "at", "pivot", "pivot_n", "pivot_at"), "pivot-postings")

    # First the pivots against the members of all groups in their lists.
    may = _enough("least(n - at, pivot_n - pivot_at)", "n + pivot_n", percent)
    stars = posted.where(may).select("pivot", "gid").distinct().join(members.select("rep", "gid"), "gid").where("rep <> pivot")
    stars = stored(compared(stars.select(F.col("pivot").alias("a"), F.col("rep").alias("b")), sets), "stars")
    linked = f"100 * shared >= {percent} * united"
    roots = stored(components(stars.where(linked).select("a", "b")), "star-roots").withColumnRenamed("id", "rep")
    placed = stored(members.join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep")), "placed")

    # Then members whose components differ; a list whose members are all in one has none. What two sets share is
    # bounded by what each shares with the list's pivot, and what each has beside that and its own runs.
    parts = placed.groupBy("gid", "root").agg(F.count(F.lit(1)).alias("members"), F.first("own").alias("own"))
    known = stars.select(F.col("a").alias("pivot"), F.col("b").alias("rep"), "shared").unionByName(
        lists.select("pivot", F.col("pivot").alias("rep"), F.col("pivot_n").alias("shared")).distinct())
    known = known.join(placed, "rep").groupBy("pivot", "gid", "root").agg(
        F.count(F.lit(1)).alias("known"), F.max("shared").alias("both"), F.max(F.expr("n - own - shared")).alias("rest"))
    spots = posted.join(parts, "gid").join(placed.select(F.col("rep").alias("pivot"), F.col("root").alias("centre")), "pivot")
    spots = stored(spots.select("run", "pivot", "gid", "root", "n", "at", "own", "members", (F.col("root") != F.col("centre")).alias("loose")), "spots")
    torn = stored(spots.groupBy("run").agg(F.max("loose").alias("torn"), F.min("n").alias("least")).where("torn").drop("torn"), "torn-lists")
    # The first run that two sets share leaves them what follows it. Places too far back, even beside the list's
    # smallest set, are no such first run.
    spots = stored(spots.join(torn, "run").where(_enough("n - at", "n + least", percent)).drop("least"), "torn-spots")
    firsts = spots.groupBy("gid", "root").agg(F.array_sort(F.collect_list(F.struct("at", "run"))).alias("runs")).select("gid", "root", "runs.run")
    spots = spots.join(firsts.withColumnRenamed("run", "runs"), ["gid", "root"]).join(known, ["pivot", "gid", "root"], "left")
    whole = F.coalesce(F.col("known") == F.col("members"), F.lit(False))
    spots = spots.select("run", "gid", "root", "n", "at", "own", "loose", "runs", F.when(whole, F.col("both")).otherwise(F.expr("n - own")).alias("both"),
                         F.when(whole, F.greatest("rest", F.lit(0))).otherwise(F.expr("n - own")).alias("rest"))
    spots = stored(spots, "bounded-spots")
    x, y = spots.where("loose").alias("x"), spots.alias("y")
    bound = _enough("least(x.n - x.at, y.n - y.at, least(x.both, y.both) + least(x.rest, y.rest))", "x.n + y.n", percent)
    pairs = x.join(y, F.expr("x.run = y.run") & F.expr(
        f"x.root <> y.root AND (NOT y.loose OR x.root < y.root) AND {bound} AND element_at(array_intersect(x.runs, y.runs), 1) = x.run")).select(
        F.col("x.gid").alias("gid_x"), F.col("x.root").alias("root_x"), F.col("y.gid").alias("gid_y"), F.col("y.root").alias("root_y")).distinct()
    pairs = stored(pairs, "group-pairs")
    item = lambda c, rep: placed.select(F.col("gid").alias(f"gid_{c}"), F.col("root").alias(f"root_{c}"), F.col("rep").alias(rep))
    pairs = stored(pairs.join(item("x", "a"), ["gid_x", "root_x"]).join(item("y", "b"), ["gid_y", "root_y"]).select("a", "b"), "pairs")
    second = compared(pairs, sets).where(linked).select("a", "b")
    root_of = placed.select("rep", "root")
    joined = second.join(root_of.select(F.col("rep").alias("a"), F.col("root").alias("ra")), "a").join(
        root_of.select(F.col("rep").alias("b"), F.col("root").alias("rb")), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    again = components(stored(joined, "joined-roots")).select(F.col("id").alias("root"), F.col("root").alias("top"))

    tops = placed.select("rep", "root").join(again, "root", "left").select("rep", F.coalesce("top", "root").alias("top"))
    found = classes.join(tops, "rep", "left").withColumn("top", F.coalesce("top", "rep"))
    least = found.groupBy("top").agg(F.min("id").alias("component_id"))
    found = stored(found.join(least, "top").select("n", "a", "b", "component_id", "copies"), "components")
    linked = described.where("n > 0").join(found, ["n", "a", "b"]).select("id", F.col("n").alias("n_shingles"), "component_id", "copies")
    none = described.where("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(1).cast("long").alias("copies"))
    return linked.unionByName(none).withColumnRenamed("id", id_col)
