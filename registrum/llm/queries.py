"""The registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registrum.llm import (
    dart_minhash,
    forced_bpe,
    hard_negatives,
    packing,
    pivot_search,
    ppm,
    preference,
    token_alignment,
    toxicity,
    unit_dedup,
    url_trust,
    warc,
    weighted_fingerprint,
)
from registrum.session import write_and_reread

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def op8_index_merge(spark: SparkSession, folder: str) -> DataFrame:
    captures = warc.capture_index(table(spark, folder, "pages", "page_id", "url", "html"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to FROM f
"""


def op9_naive_bayes_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    labels = table(spark, folder, "labels", "doc_id", "toxic")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    model = toxicity.fit(docs, labels.where(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op10_forced_boundary_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    ids = forced_bpe.encode(docs, WORD_BPE).select("doc_id", "ids")
    both = forced_bpe.decode(ids, WORD_BPE)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_common_prefix_preference(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs from conversations, each with all its turns as chosen. Rejected is the same with one
    answer, the assistant turn at place conv_id modulo the number of answers, replaced by the last
    answer of its neighbour (2n and 2n + 1 swap theirs), so pairs part at any turn. A conversation
    without an answer is rejected without its last turn; one whose neighbour has none lacks that answer."""
    turns = table(spark, folder, "conversations", "conv_id", "turn", "role", "text").dropDuplicates()
    chosen = turns.where("conv_id is not null").fillna({"turn": preference.LAST})
    answers = chosen.where("role = 'assistant'").groupBy("conv_id", "turn").agg(F.max("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1
    counts = answers.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.max_by("text", "turn").alias("final"))
    counts = write_and_reread(counts, "answers")
    own = answers.withColumn("at", place).join(counts, "conv_id").where(F.col("at") == F.pmod("conv_id", "n"))
    swapped = own.select("conv_id", "turn")
    last = chosen.groupBy("conv_id").agg(F.max("turn").alias("turn")).join(counts, "conv_id", "left_anti")
    replaced = write_and_reread(swapped.unionByName(last), "replaced-turns")
    offered = counts.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("final").alias("text"))
    new = swapped.join(offered, "conv_id").select("conv_id", "turn", F.lit("assistant").alias("role"), "text")
    rejected = chosen.join(replaced, ["conv_id", "turn"], "left_anti").unionByName(new)
    found = preference.segments(chosen, rejected)
    name = F.concat_ws(":", "part", F.col("turn").cast("string"), F.col("trained").cast("string"), "rendered")
    digest = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long")

    def chars(condition: str, alias: str):
        return F.coalesce(F.sum(F.when(F.expr(condition), F.length("rendered"))), F.lit(0)).cast("long").alias(alias)

    return found.groupBy(F.col("pair").alias("conv_id")).agg(
        F.count_if(F.col("part") == "prompt").alias("prompt_turns"),
        chars("part = 'prompt'", "prompt_chars"),
        chars("part = 'chosen'", "chosen_chars"),
        chars("part = 'rejected'", "rejected_chars"),
        chars("part = 'chosen' and trained", "chosen_trained_chars"),
        chars("part = 'rejected' and trained", "rejected_trained_chars"),
        F.sum(digest).cast("long").alias("digest"),
    )


OP1_SQL = """
WITH c AS (SELECT DISTINCT conv_id, coalesce(turn, 9223372036854775807) AS turn, coalesce(role, '') AS role,
      coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
a AS (SELECT conv_id, turn, max(text) AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place,
      count(*) OVER (PARTITION BY conv_id) AS n FROM c WHERE role = 'assistant' GROUP BY 1, 2),
x AS (SELECT conv_id, turn FROM a WHERE place = conv_id % n),
f AS (SELECT conv_id, arg_max(text, turn) AS text FROM a GROUP BY 1),
w AS (SELECT * FROM x UNION ALL SELECT conv_id, max(turn) FROM c WHERE conv_id NOT IN (SELECT conv_id FROM x) GROUP BY 1),
r AS (SELECT * FROM c WHERE (conv_id, turn) NOT IN (SELECT (conv_id, turn) FROM w) UNION
      SELECT x.conv_id, x.turn, 'assistant', f.text FROM x JOIN f ON f.conv_id = xor(x.conv_id, 1)),
d AS (SELECT conv_id, min(turn) AS e FROM ((SELECT * FROM c EXCEPT SELECT * FROM r) UNION
      (SELECT * FROM r EXCEPT SELECT * FROM c)) GROUP BY 1),
s AS (SELECT c.*, 'prompt' AS part FROM c LEFT JOIN d USING (conv_id) WHERE e IS NULL OR turn < e UNION ALL
      SELECT c.*, 'chosen' FROM c JOIN d USING (conv_id) WHERE turn >= e UNION ALL
      SELECT r.*, 'rejected' FROM r JOIN d USING (conv_id) WHERE turn >= e),
g AS (SELECT conv_id, part, turn, part <> 'prompt' AND role = 'assistant' AS trained,
      '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered FROM s)
SELECT conv_id, count(*) FILTER (part = 'prompt') AS prompt_turns,
  CAST(coalesce(sum(length(rendered)) FILTER (part = 'prompt'), 0) AS BIGINT) AS prompt_chars,
  CAST(coalesce(sum(length(rendered)) FILTER (part = 'chosen'), 0) AS BIGINT) AS chosen_chars,
  CAST(coalesce(sum(length(rendered)) FILTER (part = 'rejected'), 0) AS BIGINT) AS rejected_chars,
  CAST(coalesce(sum(length(rendered)) FILTER (part = 'chosen' AND trained), 0) AS BIGINT) AS chosen_trained_chars,
  CAST(coalesce(sum(length(rendered)) FILTER (part = 'rejected' AND trained), 0) AS BIGINT) AS rejected_trained_chars,
  CAST(sum(CAST('0x' || substr(md5(concat_ws(':', part, turn, trained, rendered)), 1, 8) AS BIGINT)) AS BIGINT) AS digest
FROM g GROUP BY conv_id
"""

URL_RULES = [
    url_trust.Rule("block", "net", "/"),
    url_trust.Rule("allow", "example.net", "/en/"),
    url_trust.Rule("block", "example.com", "/de/"),
    url_trust.Rule("allow", "org", "/fr/"),
]


def op2_link_trust(spark: SparkSession, folder: str) -> DataFrame:
    return url_trust.judge(table(spark, folder, "pages", "page_id", "url", "html"), URL_RULES)


def op3_weighted_sampling(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    blocks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return weighted_fingerprint.with_edits(docs, blocks)


def op4_dart_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return dart_minhash.classes(table(spark, folder, "documents", "doc_id", "text"))


def op5_pivot_search(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_search.top_k(table(spark, folder, "embeddings", "vec_id", "embedding"))


OP5_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e::DOUBLE[], c.e::DOUBLE[]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def op6_repeated_units(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with its repeated passages cut out, and where they stood."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    return unit_dedup.remove_repeats(docs).select(
        "doc_id",
        "text",
        F.length("text").cast("long").alias("kept_chars"),
        F.size("removed").alias("n_removed"),
        "removed",
    )


def op7_concatenate_and_cut(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    cut = packing.pieces(packing.encode_partitions(docs, WORD_BPE, end_id=2))
    return cut.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op11_perfect_hash_alignment(spark: SparkSession, folder: str) -> DataFrame:
    # The ranks are byte_bpe_50k.json's vocabulary in the form the fast encoder reads.
    files = token_alignment.Vocabularies(
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    return token_alignment.link_counts(table(spark, folder, "documents", "doc_id", "text"), files)


def op12_partial_matching(spark: SparkSession, folder: str) -> DataFrame:
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    slices = ppm.sliced(table(spark, folder, "documents", "doc_id", "text"), remainder != 1)
    model = ppm.fit(slices, max(64, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return ppm.score(slices, model).select(
        "doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op13_inverted_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    """Rows divisible by 7 carry a wrong label on purpose."""
    rows = table(spark, folder, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows, moved)


OP13_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS anchor_id, c.vec_id, c.label = q.label AS same,
  CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
  s.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score WHERE p.place <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 10
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_common_prefix_preference": op1_common_prefix_preference,
    "op2_link_trust": op2_link_trust,
    "op3_weighted_sampling": op3_weighted_sampling,
    "op4_dart_minhash": op4_dart_minhash,
    "op5_pivot_search": op5_pivot_search,
    "op6_repeated_units": op6_repeated_units,
    "op7_concatenate_and_cut": op7_concatenate_and_cut,
    "op8_index_merge": op8_index_merge,
    "op9_naive_bayes_ngrams": op9_naive_bayes_ngrams,
    "op10_forced_boundary_bpe": op10_forced_boundary_bpe,
    "op11_perfect_hash_alignment": op11_perfect_hash_alignment,
    "op12_partial_matching": op12_partial_matching,
    "op13_inverted_multi_index": op13_inverted_multi_index,
}
ORACLES: dict[str, str] = {
    "op1_common_prefix_preference": OP1_SQL,
    "op5_pivot_search": OP5_SQL,
    "op8_index_merge": OP8_SQL,
    "op13_inverted_multi_index": OP13_SQL,
}
