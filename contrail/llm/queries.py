"""Registered queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import alignment, chat, collocations, decontaminate, digest, language_model, mixing, packing, pii, quality, sharding, simhash, toxicity
from contrail.llm.common import crc_fold, table

VOCABULARY = "byte_bpe_50k.json"
QUALITY_THRESHOLD = 0.3


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    sample = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{said}'), (-7L, 1L, 'assistant', '{said}') AS t(conv_id, turn, role, text)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(sample)
    out = chat.format_chat(rows.withColumn("parts", chat.text_part(F.col("text"))))
    turns = F.transform(chat.read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = out.withColumn("raw", F.col("formatted").cast("binary")).withColumn("loss", chat.under_loss(F.col("raw"), F.col("loss_spans")))
    return loss.select("conv_id", "n_turns", F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_path(), sequence=1024, added_tokens=True)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out, n = toxicity.scored(docs, toxicity.train(docs, labels), keep=["doc_id"])
    score = F.col(n["toxic_score"])
    return out.select("doc_id", (crc_fold("doc_id") == 0).alias("held_out"), F.col(n["severity"]).alias("severity"), score.alias("score"),
                      (score >= 0.5).cast("int").alias("predicted"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out, score = quality.scored(docs, quality.train(docs, labels), keep=["doc_id"])
    return out.select("doc_id", (crc_fold("doc_id") == 0).alias("held_out"), F.col(score).alias("score"),
                      (F.col(score) >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scores(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, n = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                                window=13, keep=["doc_id"])
    hit, words = F.col(n["n_hit"]), F.col(n["n_words"])
    return found.select("doc_id", words.alias("n_words"), hit.alias("n_hit"), F.size(n["items"]).cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.col(n["items"]), ","), 256).alias("items_sha256"),
                        ((hit > 0) & (20 * hit >= words)).alias("contaminated"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=8).select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.edited_likeness(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked, n = pii.personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, spans = F.col(n["base"]), F.col(n["spans"])
    counts = [pii.count_of(base, k).alias(f"n_{k}") for k in pii.KINDS]
    return marked.select("doc_id", *counts, F.sha2(pii.written(base), 256).alias("base_sha256"), pii.written(spans).alias("spans"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rows = mixing.mix(table(spark, sf_dir, "documents"), shards=8)
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(table(spark, sf_dir, "documents"), least=10, inside=50)
    return collocations.ranked(found, 2000).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = alignment.align(table(spark, sf_dir, "documents"), vocabulary_path(), vocabulary_path("piece_bpe_32k.model"))
    return rows.withColumnRenamed("groups", "groups_sha256").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {f.__name__: f for f in (op1_simhash, op2_chat_format, op3_packing, op4_toxicity, op5_quality, op6_language_model, op7_decontaminate, op8_sharding,
                                   op9_digest, op10_pii, op11_mixing, op12_collocations, op13_alignment)}

OP7_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(13, len(w)) AS m, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM win),
grams AS (SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS s
          FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)),
hits AS (SELECT doc_id, i, grams.m, item FROM grams JOIN win ON grams.m = win.m AND grams.s = win.s),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id),
met AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(met.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN met USING (doc_id)
"""



def _escaped(col: str) -> str:
    sql = f"replace(coalesce({col}, ''), '\\', '\\\\')"
    for c in chat.Template().controls:
        sql = f"replace({sql}, '{c}', '{c[0]}\\{c[1:]}')"
    return sql


_MARKS = sum(len(x) for x in (chat.Template().turn, chat.Template().body, chat.Template().end))
OP2_SQL = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) AS v(conv_id, turn, role, text))
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({_MARKS} + length({_escaped('role')}) + length({_escaped('text')})) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

OP12_SQL = r"""
WITH p AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w
           FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
f AS (SELECT lang, k, phrase, count(*) AS f
      FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
            FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3)) AS ks(k) WHERE len(w) >= k))
      GROUP BY lang, k, phrase),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
halves AS (SELECT c.lang, c.phrase, c.k, c.a, cut, array_to_string(w[1:cut], ' ') AS first, array_to_string(w[cut + 1:], ' ') AS rest
           FROM c, (VALUES (1), (2)) AS cuts(cut) WHERE cut < c.k),
cuts AS (SELECT h.lang, h.phrase, h.k, h.a, l.f AS l, r.f AS r, (1000000::HUGEINT * h.a * h.a) // (l.f::HUGEINT * r.f) AS score,
                row_number() OVER (PARTITION BY h.lang, h.phrase ORDER BY (1000000::HUGEINT * h.a * h.a) // (l.f::HUGEINT * r.f), cut) AS best
         FROM halves h JOIN f l ON l.lang = h.lang AND l.phrase = h.first JOIN f r ON r.lang = h.lang AND r.phrase = h.rest),
longer AS (SELECT lang, part, max(a) AS a FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM c WHERE k = 3)
           GROUP BY lang, part),
kept AS (SELECT cuts.* FROM cuts LEFT JOIN longer ON cuts.lang = longer.lang AND cuts.phrase = longer.part
         WHERE best = 1 AND NOT (cuts.k = 2 AND longer.a IS NOT NULL AND 100 * longer.a >= 50 * cuts.a)),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM placed JOIN n USING (lang) WHERE rank <= 2000
"""

ORACLE = {"op2_chat_format": OP2_SQL, "op7_decontaminate": OP7_SQL, "op12_collocations": OP12_SQL}
