"""Mixing documents to target domain weights through soft domain membership.

1. A table of labelled documents trains a classifier of domains: Bernoulli naive Bayes over the
   presence of words (lower-cased), of word skeletons (what is left of a word without its letters
   and digits) and of a shape (how many of the words differ, in eighths). A word joins the
   vocabulary if it is ``LIFT`` times as frequent in one domain as in the others. The training
   sample and the vocabulary are bounded by parameters.
2. Every document gets a posterior probability p[d] of each domain, and its tokens
   count towards all domains in these shares.
3. Projected gradient descent fits document rates r >= 0 by least squares,
   minimising the sum over domains of ((S_d - T_d) / s_d)^2, with S_d = sum of r * tokens * p[d] and
   T_d the target. Steps are scaled by 1 / tokens, so a document's rate depends on its
   posterior alone and documents with equal posteriors are added up before the first
   step. A step is one small distributed aggregate; the driver holds one number per domain.

A rate is the expected number of copies. The domain of the largest weight (of equal ones, the one with
the most tokens) is kept whole and sets the total; domains with more than their share shrink, and
scarce ones are repeated (rates above 1) or, without ``repeat``, stay as they are and fall short. A
domain that is no document's likeliest is never repeated: its tokens are traces in others' documents.

Only DataFrame functions run here.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.common import stored, text_of, unused

#: Training sample: labelled documents of each domain (expected; drawn by a hash).
PER_DOMAIN = 2000
#: Vocabulary: words kept for each domain.
WORDS_PER_DOMAIN = 100
MAX_STEPS, TOLERANCE = 60, 1e-4
LIFT = 4.0
# Marks of skeletons and shapes; no word holds them, words are cut at control characters.
_SKELETON, _SHAPE = "\x01", "\x02"


def features(text: Column) -> tuple[Column, Column]:
    """(words, skeletons) of a text, as arrays with repeats and possibly empty entries."""
    gaps = r"[\x00-\x20]+"
    words = F.split(F.lower(text), gaps)
    return words, F.split(F.regexp_replace(text, r"[\p{L}\p{N}]+", ""), gaps)


def shape(words: str) -> Column:
    """Share of distinct entries among a text's words, in eighths."""
    share = F.floor(F.lit(8.0) * F.size(F.array_distinct(words)) / F.greatest(F.lit(1), F.size(words)))
    return F.concat(F.lit(_SHAPE), share.cast("string"))


def domain_posteriors_model(docs: DataFrame, labelled: DataFrame, id_col: str, text_col: str,
                            per_domain: int = PER_DOMAIN, words_per_domain: int = WORDS_PER_DOMAIN) -> dict:
    """Naive Bayes parameters: domains, base logits, vocabulary and the logits a present word adds.

    ``labelled``: (id, domain). Bounded by (domains x words_per_domain) words.
    """
    label = labelled.where("domain IS NOT NULL AND id IS NOT NULL").groupBy("id").agg(F.min("domain").alias("domain"))
    totals = {r["domain"]: r["n"] for r in label.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    domains = sorted(totals)
    if not domains:
        return {"domains": [], "base": [], "words": [], "adds": []}
    share = F.create_map(*[F.lit(x) for d in domains for x in (d, min(1.0, per_domain / totals[d]))])
    draw = F.pmod(F.xxhash64("id", F.lit("domain sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = label.where(draw < F.element_at(share, F.col("domain")))
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.join(F.broadcast(picked), "id")  # about per_domain rows of each domain
    words, bones = features(F.col("text"))
    rows = rows.select("domain", words.alias("words"), bones.alias("bones"))
    tagged = F.array_distinct(F.concat("words", F.transform("bones", lambda b: F.concat(F.lit(_SKELETON), b)), F.array(shape("words"))))
    seen = stored(rows.select("domain", F.filter(tagged, lambda w: ~w.isin("", _SKELETON)).alias("ws")), "labelled-words")
    sizes = {r["domain"]: r["n"] for r in seen.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    domains = sorted(sizes)
    if not domains:
        return {"domains": [], "base": [], "words": [], "adds": []}
    n_all = sum(sizes.values())
    size = F.create_map(*[F.lit(x) for d in domains for x in (d, float(sizes[d]))])
    per = seen.select("domain", F.explode("ws").alias("w")).groupBy("w", "domain").agg(F.count(F.lit(1)).alias("n"))
    every = per.groupBy("w").agg(F.sum("n").alias("all"), F.map_from_entries(F.collect_list(F.struct("domain", "n"))).alias("by"))
    inside = (F.col("n") + 0.1) / (F.element_at(size, F.col("domain")) + 0.2)
    outside = (F.col("all") - F.col("n") + 0.1) / (F.lit(float(n_all)) - F.element_at(size, F.col("domain")) + 0.2)
    gain = inside * F.log(inside / outside)
    # The most telling words of each domain. One row for each word and domain of a bounded sample.
    ranked = every.select("w", "all", F.explode("by").alias("domain", "n")).withColumn("gain", gain).where(F.col("n") >= 2).where(inside >= LIFT * outside)
    place = F.row_number().over(Window.partitionBy("domain").orderBy(F.desc("gain"), "w"))
    chosen = ranked.withColumn("place", place).where(F.col("place") <= words_per_domain).select("w").distinct()
    counts: dict[str, dict[str, int]] = {}
    for r in per.join(chosen, "w").collect():  # domains x domains x words_per_domain rows at most
        counts.setdefault(r["w"], {})[r["domain"]] = r["n"]
    vocabulary = sorted(counts)
    prob = {w: [(counts[w].get(d, 0) + 0.05) / (sizes[d] + 0.1) for d in domains] for w in vocabulary}
    whole = sum(totals[d] for d in domains)
    base = [math.log(totals[d] / whole) + sum(math.log1p(-prob[w][i]) for w in vocabulary) for i, d in enumerate(domains)]
    adds = [[math.log(p) - math.log1p(-p) for p in prob[w]] for w in vocabulary]
    return {"domains": domains, "base": base, "words": vocabulary, "adds": adds}


def posteriors(docs: DataFrame, model: dict, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, n_tokens, p): tokens are words; p is aligned with the model's domains."""
    words, bones = features(F.col("text"))
    plain = [w for w in model["words"] if w[0] not in (_SKELETON, _SHAPE)]
    marked = [w[1:] for w in model["words"] if w.startswith(_SKELETON)]
    hit = F.array_distinct(F.filter("words", lambda w: w.isin(plain))) if plain else F.array().cast("array<string>")
    bone = F.array_distinct(F.filter("bones", lambda w: w.isin(marked))) if marked else F.array().cast("array<string>")
    if model["domains"]:
        adds = F.map_from_arrays(F.array(*[F.lit(w) for w in model["words"]]) if model["words"] else F.array(F.lit("")),
                                 F.array(*[F.array(*map(F.lit, a)) for a in model["adds"]]) if model["words"]
                                 else F.array(F.array(*[F.lit(0.0) for _ in model["domains"]])))
        logits = F.aggregate("hits", F.array(*map(F.lit, model["base"])),
                             lambda acc, w: F.zip_with(acc, F.element_at(adds, w), lambda x, y: x + y))
        shifted = F.transform("z", lambda x: F.exp(x - F.array_max("z")))
        total = F.aggregate("e", F.lit(0.0), lambda s, x: s + x)
        p = F.transform("e", lambda x: x / F.col("total"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash"), text_of(text_col).alias("text"))
    rows = rows.select("id", "text_hash", words.alias("words"), bones.alias("bones"))
    rows = rows.select("id", "text_hash", (F.size("words") - F.size(F.filter("words", lambda w: w == ""))).cast("long").alias("n_tokens"),
                       F.concat(hit, F.transform(bone, lambda b: F.concat(F.lit(_SKELETON), b)),
                                F.filter(F.array(shape("words")), lambda x: x.isin([w for w in model["words"] if w[0] == _SHAPE] or [""]))).alias("hits"))
    if not model["domains"]:
        return rows.select("id", "text_hash", "n_tokens", F.array().cast("array<double>").alias("p"))
    return (rows.withColumn("z", logits).withColumn("e", shifted).withColumn("total", total)
            .select("id", "text_hash", "n_tokens", p.alias("p")))


def rate(p: Column, steps: list[list[float]]) -> Column:
    """Rate of a posterior after projected steps, each a pull per domain."""
    if not steps:
        return F.lit(1.0)
    pulls = F.array(*[F.array(*map(F.lit, s)) for s in steps])
    return F.aggregate(pulls, F.lit(1.0), lambda r, s: F.greatest(
        F.lit(0.0), r - F.aggregate(F.zip_with(p, s, lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x)))


def fit_rates(members: DataFrame, domains: list[str], targets: dict[str, float], max_steps: int = MAX_STEPS,
              tolerance: float = TOLERANCE, repeat: bool = True) -> tuple[list[list[float]], dict[str, tuple[float, float, float]]]:
    """(steps, {domain: (tokens before, target tokens, tokens after)}) for (n_tokens, p).

    ``targets``: weight of each domain; others get 0. Domains without tokens are left out. Without
    ``repeat`` no target is above what its domain has.
    """
    k = len(domains)
    groups = stored(members.where("n_tokens > 0").groupBy("p").agg(F.sum("n_tokens").cast("double").alias("n")), "posteriors")
    if not k or groups.isEmpty():
        return [], {d: (0.0, 0.0, 0.0) for d in domains}
    cell = lambda i: F.col("p")[i]
    first = groups.agg(*[F.sum(F.col("n") * cell(i)).alias(f"s{i}") for i in range(k)],
                       *[F.max(cell(i) == F.array_max("p")).alias(f"b{i}") for i in range(k)],
                       *[F.sum(F.col("n") * cell(i) * cell(j)).alias(f"g{i}_{j}") for i in range(k) for j in range(k)]).first()
    have = [first[f"s{i}"] for i in range(k)]
    want = [max(0.0, float(targets.get(d, 0.0))) if have[i] > 0 else 0.0 for i, d in enumerate(domains)]
    norm = sum(want)
    if norm <= 0:
        return [], {d: (have[i], have[i], have[i]) for i, d in enumerate(domains)}
    largest = max(range(k), key=lambda i: (want[i], have[i]))
    total = have[largest] / (want[largest] / norm)
    goal = [total * w / norm if repeat and first[f"b{i}"] else min(have[i], total * w / norm) for i, w in enumerate(want)]
    scale = [math.sqrt(first[f"g{i}_{i}"]) or 1.0 for i in range(k)]
    # Gershgorin bound of the scaled Gram matrix: a step of its inverse never overshoots.
    bound = max(sum(first[f"g{i}_{j}"] / (scale[i] * scale[j]) for j in range(k)) for i in range(k)) or 1.0
    steps, now = [], have
    while len(steps) < max_steps and any(abs(s - t) > tolerance * total for s, t in zip(now, goal, strict=True)):
        steps.append([(now[i] - goal[i]) / (scale[i] ** 2 * bound) for i in range(k)])
        r = groups.select("p", (F.col("n") * rate(F.col("p"), steps)).alias("n"))
        got = r.agg(*[F.sum(F.col("n") * cell(i)).alias(f"s{i}") for i in range(k)]).first()
        now = [got[f"s{i}"] for i in range(k)]
    return steps, {d: (have[i], goal[i], now[i]) for i, d in enumerate(domains)}


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
        per_domain: int = PER_DOMAIN, words_per_domain: int = WORDS_PER_DOMAIN, repeat: bool = True) -> DataFrame:
    """One row per input row: id, domain (likeliest), posterior (map), n_tokens, rate, copies,
    domain_tokens (map of each domain to its tokens before, its target and its tokens after).

    ``labelled``: (id, domain). ``copies``: the rate rounded down or up by a hash of id and text, so that its
    expectation is the rate. Defined cases: a null text counts as empty and has no tokens;
    without a labelled document there are no domains (null) and all rates are 1; of several
    labels of an id the smallest counts; repeated rows get equal rows; an empty table gives no
    rows; further columns of the inputs are not looked at.
    """
    model = domain_posteriors_model(docs, labelled, id_col, text_col, per_domain, words_per_domain)
    members = stored(posteriors(docs, model, id_col, text_col), "members")
    steps, totals = fit_rates(members, model["domains"], targets, repeat=repeat)
    names = F.array(*map(F.lit, model["domains"])) if model["domains"] else F.array().cast("array<string>")
    out = members.withColumn("rate", rate(F.col("p"), steps))
    draw = F.pmod(F.xxhash64("id", "text_hash", F.lit("copies")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    best = F.element_at(names, F.array_position("p", F.array_max("p")).cast("int")) if model["domains"] else F.lit(None).cast("string")
    tokens = F.create_map(*[x for d, t in totals.items() for x in (F.lit(d), F.array(*map(F.lit, t)))]) if totals else \
        F.create_map().cast("map<string,array<double>>")
    return out.select(F.col("id").alias(id_col), "text_hash", best.alias("domain"), F.map_from_arrays(names, "p").alias("posterior"),
                      "n_tokens", "rate", F.floor(F.col("rate") + draw).cast("int").alias("copies"), tokens.alias("domain_tokens"))


def keep_mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
               **options) -> DataFrame:
    """The documents that the mix takes, with all their columns; as none is repeated, scarce domains fall short."""
    out = mix(docs, labelled, targets, id_col, text_col, repeat=False, **options).where("copies < 1").select(
        F.col(id_col).alias("_id"), F.col("text_hash").alias("_th")).distinct()
    mark = unused(docs, "_th")
    rows = docs.withColumn(mark, F.xxhash64(text_of(text_col)))
    return rows.join(out, rows[id_col].eqNullSafe(out["_id"]) & (rows[mark] == out["_th"]), "left_anti").drop(mark)
