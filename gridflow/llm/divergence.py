"""Source divergence audit: how differently the sources of a language use its words. Words are counted by pointers to
their first bytes, sorted over the raw Arrow buffers; equal runs give document frequencies and source counts."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import Scratch, ready, rows_out, texts_of

#: Documents of its lang that a term must occur in, and ranks of the part `term`.
LEAST_DOCS, TERM_RANKS = 10, 10
#: Bytes of text that are sorted at once (a longer document is sorted alone), and bytes compared at once.
SHARD_BYTES, SLICE = 16 << 20, 8
#: Counts of a block of terms that one task compares, numbers it holds at once, and sources of a block of results.
BLOCK_COUNTS, HELD, SOURCES = 1 << 16, 1 << 20, 64
#: Parts into which a lang's terms are dealt to learn how many blocks it has.
SALTS = 64
#: Shares are counted in billionths, after two are added to each count.
UNIT, ADDED = 10 ** 9, 2

LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[ord("A"):ord("Z") + 1] += 32
#: For 0 to 8 bytes of a slice: a mask that blanks what is behind them.
LEADING = np.array([(1 << 64) - (1 << 8 * (SLICE - n)) for n in range(SLICE + 1)], np.uint64)
IN_TERM = np.zeros(256, bool)
IN_TERM[ord("A"):ord("Z") + 1] = IN_TERM[ord("a"):ord("z") + 1] = IN_TERM[128:] = True


def pointers(raw, offsets):
    """(starts, lengths, documents) of the terms of texts that lie one behind the other in a buffer of bytes."""
    inside = IN_TERM[raw]
    border = np.zeros(len(raw) + 1, bool)
    border[offsets] = True
    starts = np.flatnonzero(inside & (border[:-1] | ~np.append(False, inside[:-1])))
    ends = np.flatnonzero(inside & (border[1:] | ~np.append(inside[1:], False)))
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends + 1 - starts, np.repeat(np.arange(len(counts)), counts)


def sort_pointers(raw, starts, lengths):
    """(order, heads): the pointers in the order of their terms, equal ones as they came, and whether each is the first of
    its term.

    A multikey quicksort, eight bytes as one key: pointers that agree so far are sorted by the next slice, and
    only the groups that it leaves with several longer terms go on to the slice after it.
    """
    padded = np.append(raw, np.zeros(SLICE, np.uint8))
    slices = np.ndarray(len(padded) - SLICE + 1, ">u8", padded, 0, (1,))
    order, heads = np.arange(len(starts)), np.zeros(len(starts), bool)
    heads[:1] = True
    places, depth = order.copy(), 0
    while len(places):
        own = order[places]
        left = np.clip(lengths[own] - depth, 0, SLICE)
        key = slices[np.minimum(starts[own] + depth, len(raw))].astype(np.uint64) & LEADING[left]
        group = np.cumsum(heads[places])
        by = np.argsort(key, kind="stable") if depth == 0 else np.lexsort((key, group))
        order[places] = own[by]
        key = key[by]
        heads[places] |= np.append(True, (key[1:] != key[:-1]) | (group[1:] != group[:-1]))
        depth += SLICE
        group = np.cumsum(heads[places])
        longer = np.bincount(group, weights=lengths[order[places]] > depth)
        places = places[((np.bincount(group) > 1) & (longer > 0))[group]]
    return order, heads


def count_shard(raw, offsets, group):
    """(term, group, count, docs) of each term in each group of texts: a list of terms, and for each entry the number of its
    term, its group, how often it occurs and in how many texts. The texts lie in the order of their groups."""
    raw = LOWERED[raw]
    starts, lengths, docs = pointers(raw, offsets)
    order, heads = sort_pointers(raw, starts, lengths)
    docs = docs[order]
    groups = group[docs]
    new_group = heads | np.append(True, groups[1:] != groups[:-1])[:len(heads)]
    new_doc = heads | np.append(True, docs[1:] != docs[:-1])[:len(heads)]
    runs = np.flatnonzero(new_group)
    counts = np.diff(np.append(runs, len(order)))
    in_docs = np.add.reduceat(new_doc.astype(np.int64), runs) if len(runs) else runs
    firsts = order[heads]
    whole = raw.tobytes()
    terms = [whole[s:s + n].decode() for s, n in zip(starts[firsts].tolist(), lengths[firsts].tolist())]
    return terms, (np.cumsum(heads) - 1)[runs], groups[runs], counts, in_docs


def source_counts(docs):
    """(lang, source, term, count, docs): partial counts, one row per term, group and shard of texts."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("count", pa.int64()),
                        ("docs", pa.int64())])

    def counted(table):
        keys = pa.StructArray.from_arrays([table["lang"].combine_chunks(), table["source"].combine_chunks()], ["lang", "source"])
        langs, sources = (keys.field(i).dictionary_encode() for i in (0, 1))
        code = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
        by_group = np.argsort(code, kind="stable")
        text = table["text"].cast(pa.large_string()).combine_chunks().take(pa.array(by_group))
        if isinstance(text, pa.ChunkedArray):
            text = text.combine_chunks()
        _, offsets, data = text.buffers()
        offsets = np.frombuffer(offsets, np.int64)[text.offset:text.offset + len(text) + 1]
        raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
        terms, term, group, count, in_docs = count_shard(raw, offsets - offsets[0], code[by_group])
        lang, source = np.divmod(group, max(1, len(sources.dictionary)))
        return rows_out(schema, [langs.dictionary.take(pa.array(lang)), sources.dictionary.take(pa.array(source)),
                                 pa.array(terms, pa.string()).take(pa.array(term)), count, in_docs])

    def shards(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch["text"].nbytes
            if size >= SHARD_BYTES:
                yield counted(pa.Table.from_batches(held))
                held, size = [], 0
        if held:
            yield counted(pa.Table.from_batches(held))

    return docs.mapInArrow(shards, "lang string, source string, term string, count long, docs long")


def share(count, total):
    """1 + floor(10^9 (count + 2) / total), of columns; exact for all longs."""
    return F.expr(f"1 + cast(cast({count} as decimal(20, 0)) + {ADDED} as decimal(21, 0)) * {UNIT} div "
                  f"cast({total} as decimal(20, 0))")


def shares(counts, totals):
    """The same of arrays of longs. No product exceeds a long below 9 * 10^15 occurrences: a thousand at a time."""
    out, rest = np.zeros(np.broadcast_shapes(counts.shape, totals.shape), np.int64), counts + ADDED
    for _ in range(3):
        whole, rest = np.divmod(rest * 1000, totals)
        out = out * 1000 + whole
    return out + 1


def distance(p, q):
    """floor((p - q)^2 / (p + q)); shares stay below 2^31, so it is exact in longs."""
    return (p - q) ** 2 // (p + q)


def kept_terms(counts, scratch):
    """(lang, term, total, counts): the terms in enough documents of a lang; counts holds (source, count).

    A term's rows are first reduced by source, then few enough to lie in one row: one entry per source of the lang.
    """
    summed = counts.groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    kept = summed.groupBy("lang", "term").agg(F.sum("count").alias("total"), F.sum("docs").alias("docs"),
                                              F.collect_list(F.struct("source", "count")).alias("counts"))
    return scratch.save(kept.where(F.col("docs") >= LEAST_DOCS).drop("docs"), "kept")


def pair_values(kept, langs):
    """(lang, source, item, value): the distances of each source to each other source of its lang, summed over all terms.

    The terms of a lang are dealt to blocks of about as many counts, and each block is compared with the lang's sources in
    one task, which holds few of its terms and a few of its sources at a time.
    """
    sizes = kept.groupBy("lang").agg(F.ceil(F.sum(F.size("counts")) / BLOCK_COUNTS).alias("blocks"))
    salted = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    told = kept.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")).join(salted, ["lang", "salt"])
    blocks = told.groupBy("lang", F.pmod(F.xxhash64("term"), "blocks").alias("block")).agg(
        F.collect_list("counts").alias("terms"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1)).alias("block")
    dealt = langs.join(sizes, "lang", "left").select("lang", "v", "sources", each)
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def compared(batches):
        for batch in batches:
            for lang, v, sources, terms in zip(batch["lang"].to_pylist(), batch["v"].to_pylist(),
                                               batch["sources"].to_pylist(), batch["terms"]):
                names = [s["source"] for s in sources]
                at = {name: i for i, name in enumerate(names)}
                totals = np.array([s["n"] for s in sources], np.int64) + ADDED * v
                per_term = terms.values if terms.is_valid else pa.array([], pa.list_(pa.struct(
                    [("source", pa.string()), ("count", pa.int64())])))
                step = max(1, HELD // len(names))
                for low in range(0, len(names), SOURCES):
                    rows = range(low, min(low + SOURCES, len(names)))
                    sums = np.zeros((len(rows), len(names)), np.int64)
                    for first in range(0, len(per_term), step):
                        some = per_term.slice(first, step)
                        counts = np.zeros((len(names), len(some)), np.int64)
                        entries = some.flatten()
                        term = np.repeat(np.arange(len(some)), some.value_lengths().to_numpy())
                        place = np.fromiter(map(at.__getitem__, entries.field("source").to_pylist()), np.int64, len(entries))
                        counts[place, term] = entries.field("count").to_numpy()
                        p = shares(counts, totals[:, None])
                        for i, row in enumerate(rows):
                            sums[i] += distance(p[row], p).sum(1)
                    for i, row in enumerate(rows):
                        others = [k for k in range(len(names)) if k != row]
                        yield rows_out(schema, [[lang] * len(others), [names[row]] * len(others),
                                                [names[k] for k in others], sums[i][others]])

    joined = dealt.join(blocks, ["lang", "block"], "left").select("lang", "v", "sources", "terms")
    values = joined.mapInArrow(compared, "lang string, source string, item string, value long")
    return values.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_values(kept, langs, groups):
    """(lang, source, item, value): the terms that a source uses more than its lang does, and their distances."""
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    kept = kept.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int"))
    told = kept.join(langs.select("lang", "v", "n", salt), ["lang", "salt"]).select(
        "lang", "v", "term", share("total", "n + 2 * v").alias("q"), F.explode("counts").alias("e"))
    told = told.select("lang", "v", F.col("term").alias("item"), "q", "e.source", "e.count").join(
        groups.withColumnRenamed("n", "own"), ["lang", "source"])
    told = told.withColumn("p", share("count", "own + 2 * v")).where("count > 0 and p > q")
    return told.select("lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))


def ranked(values, part, most=None):
    """Values with their ranks in each group, the largest first, equal ones by item; up to a rank, if one is given."""
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = values.withColumn("rank", F.row_number().over(by_value))
    if most:
        out = out.where(F.col("rank") <= most)
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs, scratch=None):
    """How far the sources of each lang differ in their words: (lang, source, part, item, value, rank).

    Terms are the longest runs of letters a-z and of characters beyond ASCII, A-Z lower-cased. A lang keeps those in
    at least 10 of its documents. A group of documents of one lang and source, and the whole lang, give each kept term a
    share in billionths, with 2 added to each count. Part `pair` has one row per group and other source of its lang: the
    squared difference of their shares over their sum, floored, summed over all kept terms (0 if none is kept). Part
    `term` has the up to 10 terms of a group that exceed their share in the lang by the most, in the same measure. Ranks
    start at 1 per group and part, the largest value first, equal ones in the order of the items' bytes.

    Null text, lang and source count as empty; every row is a document, so repeated rows and null doc_ids count; groups
    without terms have rows in `pair`; a lang with one source has none there; other columns are ignored; an empty table
    gives no rows. All sums are integers and independent of how the rows are dealt out.

    Words are counted in shards of texts inside the tasks that read them; only distinct terms of a shard and group move, and
    are reduced once more before they do. What lies in one row grows with the sources of a lang, never with its documents.
    """
    ready(docs.sparkSession)
    scratch = scratch or Scratch(docs.sparkSession, "divergence")
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    texts = texts_of(docs, empty("lang"), empty("source"))
    kept = kept_terms(source_counts(texts), scratch)
    used = kept.select("lang", F.explode("counts").alias("e")).groupBy("lang", F.col("e.source").alias("source")).agg(
        F.sum("e.count").alias("n"))
    groups = texts.select("lang", "source").distinct().join(used, ["lang", "source"], "left")
    groups = scratch.save(groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n")), "groups")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    langs = groups.groupBy("lang").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("source", "n")))
                                       .alias("sources")).join(sizes, "lang", "left")
    langs = scratch.save(langs.withColumn("v", F.coalesce("v", F.lit(0))), "langs")
    pairs = ranked(pair_values(kept, langs), "pair")
    return pairs.union(ranked(term_values(kept, langs, groups), "term", TERM_RANKS))
