"""The registered queries of this subpackage, each an operator applied to its whole table, and their SQL."""

from pyspark.sql import functions as F

from . import (annsearch, blocks, chunks, divergence, filteraudit, grammar, jaccard, nndescent, packing, pii, secrets,
               shuffling, toxicity)
from .common import Scratch
from .tokens import default_path


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_markov_secrets(spark, sf_dir):
    """Secrets of all documents by base rules and by models trained on samples that those rules label."""
    docs = documents(spark, sf_dir)
    samples = Scratch(spark, "op1").save(secrets.labelled_runs(docs), "samples")
    return secrets.scan(docs, secrets.train(samples))


def op2_repair_tokens(spark, sf_dir):
    """Token ids of all documents, written as Re-Pair shards and read back."""
    shards = grammar.encode_shards(documents(spark, sf_dir), default_path("byte_bpe_50k.json"), end_id=0, base=50257)
    written = Scratch(spark, "op2").save(shards, "shards")
    return grammar.read_documents(written).drop("shard")


def op3_bilstm_pii(spark, sf_dir):
    """Personal data of all documents by base rules and by a network trained on spans that those rules label."""
    docs = documents(spark, sf_dir)
    windows = Scratch(spark, "op3").save(pii.labelled_windows(docs), "windows")
    return pii.scan(docs, pii.train(windows))


def op4_nn_descent(spark, sf_dir):
    """Links, components and kept rows of all embeddings with equal labels, at a cosine of 0.93."""
    return nndescent.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.93)[0]


def op5_external_shuffle(spark, sf_dir):
    """All documents in 40 shards whose counts differ by one at most."""
    shuffled = shuffling.external_shuffle(documents(spark, sf_dir), shards=40)
    text = F.coalesce("record.text", F.lit(""))
    return shuffled.select(
        "record.doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "bucket")


def op6_segment_jaccard(spark, sf_dir):
    """Classes of documents whose 4-word shingle sets link at a Jaccard similarity of 0.85."""
    return jaccard.jaccard_join(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op7_chunked_bpe(spark, sf_dir):
    """Ids of all documents by content-defined chunks, and their decoded texts."""
    return chunks.encode_chunked(documents(spark, sf_dir), default_path("byte_bpe_50k.json"))


def op8_block_naming(spark, sf_dir):
    """Equal texts by names of their blocks; the largest doc_id of each group stays."""
    scratch = Scratch(spark, "op8")
    return blocks.duplicates(blocks.name_documents(documents(spark, sf_dir), scratch=scratch), scratch).drop("row")


OP8_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(norm) AS text_sha256
FROM d WINDOW g AS (PARTITION BY norm)
"""


def op9_chained_toxicity(spark, sf_dir):
    """Probabilities of the toxicity categories and the verdict for all documents."""
    docs = documents(spark, sf_dir)
    scorer = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.flag(docs, scorer)


def op10_tiered_packing(spark, sf_dir):
    """All documents in sequences of 512 to 4096 tokens."""
    return packing.pack(documents(spark, sf_dir), default_path("word_bpe_49k.json"), end_id=2)


def op11_graph_search(spark, sf_dir):
    """The 20 nearest others of each vector whose id is divisible by 20, among all embeddings, and the audited recall."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found, recall = annsearch.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)
    return found.withColumn("recall", F.lit(recall))


def op12_survival_words(spark, sf_dir):
    """What five filters do to all documents in each of their orders, by lang."""
    return filteraudit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
m AS (SELECT part, doc_id,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS f(name, bit)),
o AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order,
    [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a JOIN f b ON b.bit <> a.bit JOIN f c ON c.bit NOT IN (a.bit, b.bit)
  JOIN f d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN f e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before
  FROM o, (SELECT unnest(range(1, 6))::INTEGER AS step)),
r AS (SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r
"""


def op13_source_divergence(spark, sf_dir):
    """How far the sources of each lang differ in their words, over all documents."""
    return divergence.audit(documents(spark, sf_dir))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
    coalesce(source, '') AS source FROM documents),
t AS (SELECT row, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
c AS (SELECT lang, source, term, count(*) AS cnt FROM t SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v, sum(total)::HUGEINT AS n FROM k GROUP BY lang),
g AS (SELECT lang, source, coalesce(v, 0) AS v, coalesce(v.n, 0) AS lang_n, coalesce(s.n, 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang)
  LEFT JOIN (SELECT lang, source, sum(cnt) AS n FROM c GROUP BY lang, source) s USING (lang, source)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.cnt, 0) AS cnt,
    1 + (1000000000::HUGEINT * (coalesce(c.cnt, 0) + 2)) // (g.n + 2 * g.v) AS p,
    1 + (1000000000::HUGEINT * (k.total + 2)) // (g.lang_n + 2 * g.v) AS q
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item,
    sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY x.lang, x.source, y.source
  UNION ALL
  SELECT x.lang, x.source, 'pair', y.source, 0 FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source WHERE x.v = 0),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM p WHERE cnt > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM (FROM pairs UNION ALL FROM terms)
QUALIFY part = 'pair' OR rank <= 10
"""

ALL = (op1_markov_secrets, op2_repair_tokens, op3_bilstm_pii, op4_nn_descent, op5_external_shuffle, op6_segment_jaccard,
       op7_chunked_bpe, op8_block_naming, op9_chained_toxicity, op10_tiered_packing, op11_graph_search,
       op12_survival_words, op13_source_divergence)


def queries():
    return {query.__name__: query for query in ALL}


def oracles():
    return {"op8_block_naming": OP8_SQL, "op12_survival_words": OP12_SQL, "op13_source_divergence": OP13_SQL}
