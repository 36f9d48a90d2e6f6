"""A corpus made ready for training, stage by stage; every stage is written and read again as the next one's documents.

Every row is a document of its own, whatever its doc_id: of equal or nearly equal texts one row stays, also where ids repeat or
are null, and a text that nothing equals stays whoever shares its id. An empty table passes through all stages as one.
"""

from gridflow.llm import blocks, jaccard, packing, secrets, toxicity
from gridflow.llm.common import ROW, Scratch, with_rows, without
from gridflow.llm.tokens import default_path

#: Words of a shingle and the percent of near copies; op6 has its own.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def drop_toxic(spark, docs, sf_dir):
    """Documents that the classifier chain, trained on the labels, does not call toxic."""
    scorer = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, scorer)


def drop_copies(spark, docs, sf_dir):
    """Of equal texts (A-Z lower-cased), the row with the largest doc_id."""
    scratch = Scratch(spark, "copies")
    docs = with_rows(docs, scratch)
    found = blocks.duplicates(blocks.name_documents(docs, scratch=scratch, row=ROW), scratch)
    return without(docs, scratch.save(found.where("not kept").select("row"), "gone"))


def drop_near_copies(spark, docs, sf_dir):
    """One row, that with the smallest doc_id, of each class linked by a Jaccard similarity of 0.8 on shingles of five words."""
    scratch = Scratch(spark, "near-copies")
    docs = with_rows(docs, scratch)
    found = jaccard.jaccard_join(docs, scratch, NEAR_WORDS, NEAR_PERCENT, row=ROW)
    return without(docs, scratch.save(found.where("not kept").select("row"), "gone"))


def mask_secrets(spark, docs, sf_dir):
    """All documents, with the secrets in their texts masked."""
    samples = Scratch(spark, "secrets").save(secrets.labelled_runs(docs), "samples")
    return secrets.mask(docs, secrets.train(samples))


def pack_sequences(spark, docs, sf_dir):
    """Sequences of 512 to 4096 tokens; one row per piece, with its ids."""
    return packing.pack(docs, default_path("word_bpe_49k.json"), end_id=2, with_ids=True)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("near dedup", drop_near_copies),
          ("secrets", mask_secrets), ("packing", pack_sequences)]

#: Learned models and a tokenizer decide, which SQL cannot express; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over documents; each result is written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
