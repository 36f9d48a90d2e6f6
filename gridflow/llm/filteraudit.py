"""Filter interaction audit: each document becomes a 32-bit word that tells which of the 32 subsets of five filters it
survives, and carry-save positional popcounts add these words up, by part and label."""

import hashlib
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import Scratch, ready, rows_out, texts_of

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
#: Fewest words, and the most percent of repeated words and of capitals; characters that no text may hold.
LEAST_WORDS, MOST_REPEATED, MOST_CAPITALS, MARKS = 200, 50, 3, b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
#: Words and parts that a task gathers before it adds them up.
HELD_WORDS, HELD_PARTS = 1 << 18, 1024


def failures(text):
    """Bits of the filters A to D that a text fails; words are what ASCII white space parts."""
    raw = text.encode()
    words = raw.split()
    short = len(words) < LEAST_WORDS
    repeated = 100 * len(set(words)) < (100 - MOST_REPEATED) * len(words)
    capitals = 100 * (len(raw) - len(raw.translate(None, CAPITALS))) > MOST_CAPITALS * len(text)
    marked = len(raw.translate(None, MARKS)) < len(raw)
    return short | repeated << 1 | capitals << 2 | marked << 3


def survival_words():
    """The word of each set of failed filters: bit S is set if a document that fails these survives the filters in S."""
    subset = np.arange(SUBSETS, dtype=np.uint32)
    survives = (subset[:, None] & subset[None, :]) == 0
    return (survives.astype(np.uint32) << subset[None, :]).sum(1, dtype=np.uint32)


def positional_counts(words):
    """In how many of the words each of the 32 bits is set.

    Carry-save adders turn three words into their sums and their carries, bit by bit, until one word is left for each
    power of two.
    """
    counts, power = np.zeros(SUBSETS, np.int64), 0
    column = np.asarray(words, np.uint32)
    while len(column):
        carries = []
        while len(column) > 2:
            third = len(column) // 3
            a, b, c = column[:third], column[third:2 * third], column[2 * third:3 * third]
            odd = a ^ b
            carries.append(a & b | odd & c)
            column = np.concatenate([odd ^ c, column[3 * third:]])
        if len(column) == 2:
            carries.append(column[:1] & column[1:])
            column = column[:1] ^ column[1:]
        counts += (column[0].astype(np.int64) >> np.arange(SUBSETS) & 1) << power
        column = np.concatenate(carries) if carries else column[:0]
        power += 1
    return counts


def failed_filters(docs, scratch):
    """(doc_id, part, failed): the bits of the filters that each row of documents fails.

    A to D are judged in the tasks that read the texts. For E only digests of the texts (SHA-256) move: they are reduced
    to the smallest doc_id of each digest before they are shuffled, and only digests of several rows are joined back, by a
    join whose hot digests adaptive execution splits.
    """

    def judged(batches):
        for batch in batches:
            texts = batch["text"].to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["part"], pa.array([failures(t) for t in texts], pa.int32()),
                 pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary())],
                names=["doc_id", "part", "failed", "digest"])

    part = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")
    rows = scratch.save(texts_of(docs, "doc_id", part).mapInArrow(
        judged, "doc_id long, part string, failed int, digest binary"), "judged")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    first = scratch.save(first.where("rows > 1 and first is not null").select("digest", "first"), "first")
    repeated = F.when(F.col("doc_id") > F.col("first"), SUBSETS // 2).otherwise(0)
    return rows.join(first, "digest", "left").select("doc_id", "part", (F.col("failed") + repeated).alias("failed"))


def subset_survivors(failed, labels):
    """(part, subset, n, good, toxic): how many rows of each part survive each subset of filters, in all, and of those
    that a label calls good and toxic. A document with several labels is what any of them says."""
    told = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    no = F.lit(False)
    rows = failed.join(told, "doc_id", "left").select("part", "failed", F.coalesce("good", no).alias("good"),
                                                      F.coalesce("toxic", no).alias("toxic"))
    schema = pa.schema([("part", pa.string()), ("subset", pa.int32()), ("n", pa.int64()), ("good", pa.int64()),
                        ("toxic", pa.int64())])

    def added(batches):
        table, held, rows_held = survival_words(), {}, 0

        def told_counts():
            columns = [[], [], [], [], []]
            for part, pieces in held.items():
                words, good, toxic = (np.concatenate(c) for c in zip(*pieces))
                columns[0] += [part] * SUBSETS
                columns[1] += range(SUBSETS)
                for column, counted in zip(columns[2:], (words, words[good], words[toxic])):
                    column += positional_counts(counted).tolist()
            return rows_out(schema, columns)

        for batch in batches:
            names = batch["part"].dictionary_encode()
            codes = names.indices.to_numpy()
            words = table[batch["failed"].to_numpy()]
            good, toxic = (batch[c].to_numpy(zero_copy_only=False) for c in ("good", "toxic"))
            for code, part in enumerate(names.dictionary.to_pylist()):
                own = codes == code
                held.setdefault(part, []).append((words[own], good[own], toxic[own]))
            rows_held += len(batch)
            if rows_held >= HELD_WORDS or len(held) >= HELD_PARTS:
                yield told_counts()
                held, rows_held = {}, 0
        if held:
            yield told_counts()

    counts = rows.mapInArrow(added, "part string, subset int, n long, good long, toxic long")
    return counts.groupBy("part", "subset").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))


def interactions(survivors):
    """One row per part, order of the filters and step, from the survivors of each subset (see `audit`)."""
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    schema = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())]
                       + [(c, pa.int64()) for c in names])
    orders = ["".join(p) for p in permutations(FILTERS)]
    at = np.array([[FILTERS.index(c) for c in order] for order in orders])
    behind = np.cumsum(1 << at, axis=1).ravel()
    own = (1 << at).ravel()
    before = behind - own
    whole = SUBSETS - 1

    def spread(batches):
        for batch in batches:
            columns = [[] for _ in schema]
            for part, counts in zip(batch["part"].to_pylist(), batch["counts"].to_pylist()):
                n, good, toxic = (np.array([c[k] for c in counts]) for k in ("n", "good", "toxic"))
                removed = n[before] - n[behind]
                # An order in which the filter comes after exactly the filters in S is one of |S|! (4 - |S|)!.
                by_filter = {}
                for bit in set(own.tolist()):
                    by_filter[bit] = sum(
                        factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count()) * int(n[s] - n[s | bit])
                        for s in range(SUBSETS) if not s & bit)
                columns[0] += [part] * len(own)
                columns[1] += np.repeat(orders, len(FILTERS)).tolist()
                columns[2] += np.tile(np.arange(1, len(FILTERS) + 1), len(orders)).tolist()
                values = (n[behind], removed, n[0] - n[own] - removed, n[whole - own] - n[whole],
                          good[before] - good[behind], toxic[before] - toxic[behind],
                          np.array([by_filter[b] for b in own.tolist()]))
                for column, value in zip(columns[3:], values):
                    column += value.tolist()
            yield rows_out(schema, columns)

    entry = F.struct("subset", "n", "good", "toxic")
    parts = survivors.groupBy("part").agg(F.sort_array(F.collect_list(entry)).alias("counts"))
    return parts.mapInArrow(spread, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in names))


def audit(docs, labels, scratch=None):
    """What each of five filters does in each of their 120 orders, for each part of documents (its lang).

    One row per part, filter_order and step (1 to 5), zeros included: how many documents are kept after the step, removed
    by its filter there, redundant (they fail it, but were removed before), and fail it alone (unique_fails); good_lost and
    toxic_lost, the removed ones that labels call so; and shapley, what the filter removes summed over all orders.

    A: under 200 words. B: fewer than half of the words are distinct. C: more than 3 percent of the characters are A-Z.
    D: a character of #$%&*|. E: some row with a smaller doc_id has the same text. Null texts and langs count as empty;
    an empty text fails A only (and E). A row without a doc_id has no label, never fails E, and is no smaller one for others; rows that
    share doc_id and text do not fail E by each other, and each counts; other columns are ignored; an empty table gives no
    rows, as it has no parts.

    All figures follow from the survivors of the 32 subsets, which every task adds up before they are shuffled.
    """
    ready(docs.sparkSession)
    scratch = scratch or Scratch(docs.sparkSession, "filter-audit")
    return interactions(subset_survivors(failed_filters(docs, scratch), labels))
