"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express them.

Each query applies its operator to its whole table and derives the columns that its
consumers compare from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logtide.llm import bpe_dp, chat_format, direct_codes, exact_dedup, importance, language_id, lm_mixing, near_dedup, ngram_join, phrases, soft_mixing, toxicity, winnowing
from logtide.llm.common import documents, fold_ratio
from logtide.session import query_run
from logtide.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame] | None = None, *, oracle: str | None = None):
    def add(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with query_run(spark, f.__name__):
                return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if oracle is not None:
            ORACLES[f.__name__] = oracle.strip()
        return f

    return add(fn) if fn is not None else add


# ------------------------------------------------------------------ 4 exact dedup

@register(oracle=r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, text_sha256,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept
FROM n WINDOW g AS (PARTITION BY text_sha256)""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of all documents through the extendible-hash index."""
    found = exact_dedup.exact_dedup(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


# ---------------------------------------------------------------- 8 chat formatting

#: Code points in one streamed piece of an assistant's text.
PIECE = 256
_TRAP = "\\### Assistant: </turn> ok"


def conversation_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as an event log, with conversation -7 added.

    Rows become turns in the order of (turn, role, text). What assistants say
    arrives as a stream: an event that starts the turn, then pieces of it; other
    rows are whole messages.
    """
    rows = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    trap = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"),
                 F.lit(_TRAP).alias("text")) for i, r in enumerate(("user", "assistant"))])).alias("x")).select("x.*")
    rows = rows.unionByName(trap).withColumn("text", F.coalesce("text", F.lit("")))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), "text")
    rows = rows.withColumn("n", F.row_number().over(order).cast("long"))
    streamed = F.col("role") == "assistant"
    pieces = F.transform(F.sequence(F.lit(0), F.floor(F.length("text") / PIECE).cast("int")),
                         lambda i: F.substr(F.col("text"), i * PIECE + 1, F.lit(PIECE)))
    said = F.when(streamed, F.concat(F.array(F.lit("")), pieces)).otherwise(F.array("text"))
    e = rows.select("conv_id", "n", "role", F.posexplode(said).alias("i", "text"))
    kind = F.when(F.col("i") > 0, "delta").when(F.col("role") == "assistant", "regenerate").otherwise("message")
    return e.select("conv_id", F.struct("n", "i").alias("seq"), kind.alias("kind"), F.col("n").alias("turn"), "role", "text")


@register(oracle=r"""
WITH rows0 AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
-- Backslashes added to a text: one for each backslash, each # after a #, each </turn>.
r AS (
  SELECT *, length(text) - length(replace(text, '\', '')) + (length(text) - length(replace(text, '</turn>', ''))) // 7
            + length(text) - length(replace(text, '#', '')) - len(regexp_extract_all(text, '#+')) AS extra,
         length(role) - length(replace(role, '\', '')) + (length(role) - length(replace(role, '</turn>', ''))) // 7
            + length(role) - length(replace(role, '#', '')) - len(regexp_extract_all(role, '#+'))
            + length(role) - length(replace(role, ':', '')) + length(role) - length(replace(role, chr(10), '')) AS role_extra
  FROM rows0)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + length(role) + role_extra + 2 + length(text) + extra + 9) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id""")
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations folded from events, rendered with a loss mask and read back."""
    back = chat_format.format_events(conversation_events(spark, sf_dir))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select("conv_id", "n_turns", F.sha2(F.concat_ws("", said), 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


# ------------------------------------------------------------------ 10 near dedup

@register
def op10_bagminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    found = near_dedup.near_dedup(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "class_id", "group_size", "n_links", "kept")


# -------------------------------------------------------------------- 6 language ID

#: Documents whose crc32 leaves this remainder are held out of training.
LANGUAGE_FOLDS, LANGUAGE_HELD = 5, 0


def language_training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(fold_ratio("doc_id", LANGUAGE_FOLDS) != LANGUAGE_HELD)


@register
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the labelled documents that aren't held out."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    found = language_id.identify(docs.select("doc_id", "text"), language_training_rows(docs))
    return found.select("doc_id", (fold_ratio("doc_id", LANGUAGE_FOLDS) == LANGUAGE_HELD).alias("held_out"),
                        "lang_pred", "score", "rejected")


# ------------------------------------------------------ 3 mixing to target weights

#: Share of the tokens that each domain of the labels table should make up.
TARGET_WEIGHTS = {"good": 0.90, "low": 0.06, "toxic": 0.03, "toxic_low": 0.01}


def label_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, domain) of the labels table."""
    toxic, low = F.col("toxic") == 1, F.col("quality") == 0
    domain = F.when(toxic & low, "toxic_low").when(toxic, "toxic").when(low, "low").otherwise("good")
    rows = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic").where("quality IS NOT NULL AND toxic IS NOT NULL")
    return rows.select(F.col("doc_id").alias("id"), domain.alias("domain"))


@register
def op3_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document rates that bring the expected tokens of the label domains to their target weights."""
    out = soft_mixing.mix(documents(spark, sf_dir, "doc_id", "text"), label_domains(spark, sf_dir), TARGET_WEIGHTS)
    tokens = F.col("domain_tokens")[F.col("domain")]
    return out.select("doc_id", "domain", "n_tokens", "rate", "copies", *[
        F.coalesce(F.col("posterior")[d], F.lit(0.0)).alias(f"p_{d}") for d in TARGET_WEIGHTS],
        tokens[0].alias("domain_tokens_before"), tokens[1].alias("domain_tokens_target"), tokens[2].alias("domain_tokens_after"))


# ------------------------------------------------------- 2 token ids, 9 BPE by prefixes

END_ID = 2


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register
def op2_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents written as directly addressable codes and read back."""
    files = direct_codes.write_ids(documents(spark, sf_dir, "doc_id", "text"), tokenizer_path(), END_ID)
    return direct_codes.read_ids(files, ids=False)


@register
def op9_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by prefix dynamic programming, and decoded again."""
    return bpe_digests(bpe_dp.decode(bpe_dp.encode(documents(spark, sf_dir, "doc_id", "text"), tokenizer_path()), tokenizer_path()))


def bpe_digests(decoded: DataFrame) -> DataFrame:
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


# ------------------------------------------------------------------ 7 fingerprints

@register
def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowing fingerprints of all documents and their edited texts."""
    return winnowing.fingerprint_chain(documents(spark, sf_dir, "doc_id", "text"))


# ---------------------------------------------------------------------- 5 toxicity

#: Order of the chain: what is poorly written, what is toxic, what is both.
CATEGORIES = ["low_quality", "toxic", "toxic_low_quality"]


@register
def op5_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category probabilities and decisions of all documents, learned from the labels table."""
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic").select(
        F.col("doc_id").alias("id"), (F.col("quality") == 0).alias("low_quality"), (F.col("toxic") == 1).alias("toxic"),
        ((F.col("quality") == 0) & (F.col("toxic") == 1)).alias("toxic_low_quality"))
    return toxicity.classify(documents(spark, sf_dir, "doc_id", "text"), labels, CATEGORIES)


# -------------------------------------------------------------------- 1 LM scoring

#: Documents whose crc32 leaves this remainder are held out.
SCORING_FOLDS, SCORING_HELD = 7, 2


@register
def op1_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of all documents under the word baseline and the mixing model."""
    docs = documents(spark, sf_dir)
    found = lm_mixing.score(docs, fold_ratio("doc_id", SCORING_FOLDS) != SCORING_HELD)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")


# ------------------------------------------- 11 importance resampling to a target

@register(oracle=r"""
WITH words AS (SELECT 'd' AS side, doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
  UNION ALL SELECT 'b', NULL, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
counted AS MATERIALIZED (SELECT side, id, w, count(*) AS n FROM words GROUP BY ALL),
-- crc32, a bit at a time: the bits of every byte from the lowest.
crc AS MATERIALIZED (
  SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bits),
                                        lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) % 10000 AS bucket
  FROM (SELECT w, list_transform(range(8 * strlen(w)), lambda i:
               ((('0x' || substr(hex(encode(w)), 2 * (i // 8)::INT + 1, 2))::BIGINT >> (i % 8)) & 1)::BIGINT) AS bits
        FROM (SELECT DISTINCT w FROM counted))),
b AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
      FROM counted JOIN crc USING (w) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM b) + 10000)::DOUBLE
                                     / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM b) + 10000)::DOUBLE)))::BIGINT AS gain FROM b),
f AS (SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
      FROM counted JOIN crc USING (w) JOIN g USING (bucket) WHERE side = 'd' GROUP BY id),
x AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h
      FROM documents LEFT JOIN f ON id = doc_id),
y AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM x),
z AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
             10 * count(*) OVER (PARTITION BY n_features >= 20) // 100 AS drawn FROM y)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank FROM z""")
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed by bucketed words against the benchmark texts, a tenth of them drawn."""
    found = importance.resample(documents(spark, sf_dir, "doc_id", "text"), read_table(spark, sf_dir, "benchmark", "text"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


# ------------------------------------------------------- 12 phrase collocations

@register(oracle=r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
g AS (SELECT lang, unnest(w) AS p, 1 AS size FROM w
      UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' '))), 2 FROM w
      UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))), 3 FROM w),
f AS MATERIALIZED (SELECT lang, p, size, count(*)::HUGEINT AS a FROM g GROUP BY ALL),
c AS MATERIALIZED (SELECT lang, p, size, a, string_split(p, ' ') AS s FROM f WHERE size > 1 AND a >= 10),
cuts AS (SELECT c.lang, c.p, c.size, c.a, k, array_to_string(s[1:k], ' ') AS head, array_to_string(s[k + 1:], ' ') AS tail
         FROM c, (VALUES (1), (2)) AS t(k) WHERE k < c.size),
scored AS (SELECT cuts.lang, cuts.p, cuts.size, cuts.a, k, x.a AS l, y.a AS r, 1000000 * cuts.a * cuts.a // (x.a * y.a) AS score
           FROM cuts JOIN f x ON x.lang = cuts.lang AND x.p = head AND x.size = k
                JOIN f y ON y.lang = cuts.lang AND y.p = tail AND y.size = cuts.size - k),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inside AS (SELECT lang, array_to_string(s[1:2], ' ') AS p, a FROM c WHERE size = 3
           UNION ALL SELECT lang, array_to_string(s[2:3], ' '), a FROM c WHERE size = 3),
kept AS (SELECT * FROM lowest o WHERE NOT EXISTS (
           SELECT 1 FROM inside i WHERE o.size = 2 AND i.lang = o.lang AND i.p = o.p AND 100 * i.a >= 50 * o.a)),
n AS (SELECT lang, count(*) AS n FROM (SELECT lang, unnest(w) FROM w) GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(p)) AS rank, p AS phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000""")
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of two and three words of each language of all documents."""
    return phrases.mine(documents(spark, sf_dir, "text", "lang"))


# ------------------------------------------------------------ 13 n-gram Jaccard join

@register(oracle=r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words WHERE len(w) > 0),
same AS MATERIALIZED (SELECT min(doc_id) AS rep, md5(array_to_string(list_sort(s), chr(10))) AS h, len(first(s)) AS n, first(s ORDER BY doc_id) AS s, list(doc_id) AS ids
         FROM shingles GROUP BY h),
each AS MATERIALIZED (SELECT rep, n, hash(unnest(s)) AS x FROM same),
pairs AS MATERIALIZED (
  SELECT a.rep AS a, b.rep AS b FROM each a JOIN each b ON a.x = b.x AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT rep AS a, rep AS b FROM same UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a),
named AS (SELECT unnest(ids) AS doc_id, n, component_id FROM same JOIN least USING (rep))
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN named USING (doc_id)""")
def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under links of shared five-word runs."""
    return ngram_join.jaccard_components(documents(spark, sf_dir, "doc_id", "text")).select("doc_id", "n_shingles", "component_id")
