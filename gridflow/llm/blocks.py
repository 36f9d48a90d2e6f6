"""Exact dedup by deterministic block naming: fixed-size blocks are sorted into integer names, then adjacent names are
named in pairs, again and again, until each document has one name that no other text can have."""

from pyspark.sql import functions as F

from .common import Scratch

#: Bytes of a block.
BLOCK = 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands for the missing right half of an odd last name.
NONE = -(1 << 63)


def normalised(docs, *kept):
    """The text with A-Z lower-cased, null as empty, and the columns `kept`. The one-row generator keeps it from being computed anew for every
    block, as it would be if the optimizer merged the projections."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(lowered_by_letters(text))
    return docs.select(*kept, F.explode(F.array(lowered)).alias("norm"))


def lowered_by_letters(text):
    return F.translate(text, UPPER, LOWER)


def block_hash(block):
    """A block's hash, which only decides where blocks meet: equal hashes of different blocks are told apart."""
    return F.xxhash64(block)


def blocks_of(norm, block):
    """The blocks of a normalised text as an array; an empty text is one empty block."""
    count = F.greatest(F.lit(1), F.ceil(F.octet_length(norm) / block)).cast("int")
    raw = norm.cast("binary")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(raw, i * block + 1, F.lit(block)))


def numbered(distinct, *keys):
    """Integer names of distinct rows: their place in the sorted rows of their partition."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def name_documents(docs, block=BLOCK, hash_of=block_hash, scratch=None, row=None):
    """One row per document: (row, doc_id, n, name, text_sha256); texts are equal exactly if n and name are.

    Null text counts as empty; repeated and null doc_ids keep their own rows (row tells them apart; it is the column of
    that name, a long that no two rows share, or a number given here); other columns are ignored; an empty table gives no rows.

    Texts are shuffled once, to make blocks distinct before they are sorted and named, so a block that a third of all
    documents hold counts once per task. From then on only integers move. A name belongs to a hash of the block; hashes
    that several blocks share, if any, are named apart by the blocks themselves. Each later level halves the rows and
    names distinct pairs the same way; joins back to hot names are ones that adaptive execution splits.
    """
    scratch = scratch or Scratch(docs.sparkSession, "blocks")
    norm = normalised(docs, *[c for c in ("doc_id", row) if c])
    pieces = norm.select(F.explode(blocks_of(F.col("norm"), block)).alias("block")).withColumn("h", hash_of("block"))
    names = scratch.save(numbered(pieces.select("h", "block").distinct(), "h", "block").drop("block"), "names")
    shared = scratch.save(names.groupBy("h").count().where("count > 1").select("h"), "shared")
    numbered_docs = norm.select((F.col(row) if row else F.monotonically_increasing_id()).alias("row"), "doc_id", "norm")
    collide = not shared.isEmpty()
    if collide:
        numbered_docs = scratch.save(numbered_docs, "numbered")
    hashes = F.transform(blocks_of(F.col("norm"), block), lambda b: hash_of(b)).alias("hashes")
    base = scratch.save(numbered_docs.select("row", "doc_id", F.sha2("norm", 256).alias("text_sha256"), hashes), "documents")
    identity = base.select("row", "doc_id", "text_sha256", F.size("hashes").alias("n"))
    level = base.select("row", F.size("hashes").alias("n"), F.posexplode("hashes").alias("pos", "h"))
    if collide:
        level = told_apart(numbered_docs, names, shared, level, block, hash_of, scratch)
    else:
        level = level.join(names, "h").select("row", "n", "pos", "name")
    level = scratch.save(level, "level")

    finished, longest = [], level.agg(F.max("n")).first()[0] or 0
    while True:
        finished.append(level.where("n = 1").select("row", "name"))
        if longest <= 1:
            break
        half = (F.col("pos") / 2).cast("int")
        even = F.col("pos") % 2 == 0
        pairs = scratch.save(level.where("n > 1").groupBy("row", half.alias("pos")).agg(
            F.ceil(F.first("n") / 2).cast("int").alias("n"), F.max(F.when(even, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(NONE)).alias("right")), "pairs")
        names = scratch.save(numbered(pairs.select("left", "right").distinct(), "left", "right"), "names")
        level = scratch.save(pairs.join(names, ["left", "right"]).select("row", "n", "pos", "name"), "level")
        longest = -(-longest // 2)
    whole = finished[0]
    for one in finished[1:]:
        whole = whole.union(one)
    return scratch.save(identity.join(whole, "row"), "identities")


def told_apart(numbered_docs, names, shared, level, block, hash_of, scratch):
    """The first level where blocks share a hash: those blocks are named by their content, below zero."""
    own = numbered_docs.select("row", F.posexplode(blocks_of(F.col("norm"), block)).alias("pos", "block"))
    own = scratch.save(own.withColumn("h", hash_of("block")).join(shared, "h", "left_semi"), "colliding")
    apart = numbered(own.select("block").distinct(), "block").withColumn("name", -1 - F.col("name"))
    apart = scratch.save(apart, "apart")
    by_block = own.join(apart, "block").select("row", "pos", "name")
    plain = level.join(names.join(shared, "h", "left_anti"), "h").select("row", "n", "pos", "name")
    sizes = level.select("row", "n").distinct()
    return plain.union(by_block.join(sizes, "row").select("row", "n", "pos", "name"))


def duplicates(identities, scratch=None):
    """Groups of equal texts: (doc_id, keep_id, group_size, kept, text_sha256), one row per document.

    The row with the largest doc_id stays; among rows that also share it, the last one read; a null doc_id only where
    all are null.
    """
    scratch = scratch or Scratch(identities.sparkSession, "blocks")
    groups = identities.groupBy("n", "name").agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size"))
    several = scratch.save(groups.where("group_size > 1"), "groups")
    joined = identities.join(several, ["n", "name"], "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (alone | (F.col("row") == F.col("keep.row"))).alias("kept"), "text_sha256", "row")
