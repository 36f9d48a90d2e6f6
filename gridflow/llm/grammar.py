"""Re-Pair token files: per shard, frequent id pairs are replaced again and again by nonterminals; rules and expansion
lengths are stored, so any stretch of a document can be decoded alone."""

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import ready, rows_out, texts_of
from .tokens import encoder

#: Tokens of a shard, at which it is closed; a pair becomes a rule if it is found this often.
SHARD_TOKENS, LEAST_COUNT = 2_000_000, 32
#: Pairs are counted in so many bins, as a power of two, before those of the full bins are counted one by one.
BIN_BITS = 18
#: Pieces that a worker remembers, some 170 bytes each: tasks that run one after the other share most of their words.
PIECES = 1_600_000
MAGIC = b"REPAIR01"
HEAD = struct.Struct("<8s5Q")
SHARDS = pa.schema([("shard", pa.int64()), ("part", pa.int32()), ("n_docs", pa.int32()), ("n_tokens", pa.int64()),
                    ("payload", pa.binary())])
READ = pa.schema([("shard", pa.int64()), ("doc_id", pa.int64()), ("in_shard", pa.int64()), ("n_tokens", pa.int64()),
                  ("ids_crc32", pa.int64())])


def distinct(values, bins, place_of):
    """What np.unique gives with inverse and counts, by a sort of the values alone: a value's bin tells which it is, but for
    those that share one with another."""
    ordered = np.sort(values)
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    found, counts = ordered[first], np.diff(np.append(first, len(ordered)))
    owner = np.zeros((1 << BIN_BITS) + 1, np.int64)
    owner[place_of(found)] = np.arange(len(found))
    which = owner[bins]
    others = np.flatnonzero(found[which] != values)
    which[others] = np.searchsorted(found, values[others])
    return found, which, counts


def replace_pairs(symbols, starts, base, least=LEAST_COUNT, saved=0):
    """Re-Pair of a sequence of ids below `base`; `starts` marks the first id of each document, which no pair crosses.

    In each round, all pairs within a sixteenth of the most frequent are replaced, the more frequent first where two
    overlap, and in a run of one id every other one. Pairs that cannot be replaced, as their places go to others, are
    left out until the symbols change. It ends when no other pair is left that occurs `least` times,
    or, if asked to, when a round saves less than the share `saved` of the symbols.
    Returns the remaining symbols, their marks, and the rules' left and right sides; rule i is symbol base + i.
    """
    symbols, starts, bin_count = symbols.astype(np.uint32), starts.copy(), (1 << BIN_BITS) + 1
    left, right, shift = [], [], np.uint64(64 - BIN_BITS)
    barred, held = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    place_of = lambda pairs: ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int32)
    pairs_at = lambda at: (symbols[at].astype(np.uint64) << np.uint64(32)) | symbols[at + 1]

    def bins_at(at):
        """The bins of the pairs that begin at these places; the last bin is for those that a document's start parts."""
        bins = place_of(pairs_at(at))
        bins[starts[at + 1]] = bin_count - 1
        return bins

    bins = bins_at(np.arange(len(symbols) - 1))
    sums = np.bincount(bins, minlength=bin_count)
    sums[-1], near = 0, None
    while len(symbols) > 1:
        least_now = max(least, int(sums.max()) // 16)
        full = sums >= least_now
        at = np.flatnonzero(full.take(bins)) if near is None else near[full.take(bins.take(near))]
        if least_now == least and not len(barred):
            near = at
        pairs = pairs_at(at)
        if len(barred):
            others = ~np.isin(pairs, barred)
            at, pairs = at[others], pairs[others]
        if not len(at):
            break
        found, which, counts = distinct(pairs, bins[at], place_of)
        if counts.max() < least_now and least_now > least:
            least_now = max(least, int(counts.max()) // 2)
        own = np.where(counts >= least_now, counts * len(found) + np.arange(len(found)), 0)[which]
        beside = np.diff(at) == 1
        before, behind = np.append(0, np.where(beside, own[:-1], 0)), np.append(np.where(beside, own[1:], 0), 0)
        place = np.arange(len(at))
        first = np.maximum.accumulate(np.where(own != before, place, 0))
        even = (place - first + (before[first] > own)) % 2 == 0
        keep = (own > 0) & even & (own >= behind)
        made = np.bincount(which[keep], minlength=len(found))
        rules = np.flatnonzero(made >= max(2, least // 2))
        if not len(rules):
            tried = counts >= least_now
            tried = tried if tried.any() else np.ones(len(found), bool)
            barred, held = np.append(barred, found[tried]), np.append(held, counts[tried])
            np.subtract.at(sums, place_of(found[tried]), counts[tried])
            continue
        np.add.at(sums, place_of(barred), held)
        barred, held = barred[:0], held[:0]
        name = np.zeros(len(found), np.uint32)
        name[rules] = base + sum(map(len, left)) + np.arange(len(rules))
        keep &= name[which] > 0
        at, size = at[keep], len(symbols)
        # Only the pairs around replaced places change, so only they are taken from the counts and counted again.
        around = np.zeros(len(bins), bool)
        around[at] = around[np.maximum(at - 1, 0)] = around[np.minimum(at + 1, len(bins) - 1)] = True
        sums -= np.bincount(bins[around], minlength=bin_count)
        symbols[at] = name[which[keep]]
        stays = np.ones(size, bool)
        stays[at + 1] = False
        if near is not None:
            near = near[stays[near]]
            near = near - np.searchsorted(at, near)
        symbols, starts, bins = symbols[stays], starts[stays], bins[stays[:-1]]
        bins, at = bins[:len(symbols) - 1], at - np.arange(len(at))
        around = np.zeros(len(symbols), bool)
        around[at] = around[np.maximum(at - 1, 0)] = True
        at = np.flatnonzero(around[:-1])
        bins[at] = bins_at(at)
        sums += np.bincount(bins[at], minlength=bin_count)
        sums[-1] = 0
        if near is not None:
            # Other pairs only become fewer, so those found often enough are where they were before, or around a new symbol.
            near = np.sort(np.append(near[near < len(bins)], at), kind="stable")
            near = near[np.append(True, near[1:] != near[:-1])[:len(near)]]
        left.append((found[rules] >> np.uint64(32)).astype(np.uint32))
        right.append((found[rules] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        if size - len(symbols) < saved * size:
            break
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.uint32)
    return symbols, starts, join(left), join(right)


def expansions(left, right, base):
    """(flat, first, length): what each rule stands for, laid end to end; rules only use earlier ones."""
    whole = []
    for a, b in zip(left.tolist(), right.tolist()):
        whole.append((whole[a - base] if a >= base else (a,)) + (whole[b - base] if b >= base else (b,)))
    length = np.array([len(w) for w in whole], np.int64)
    flat = np.fromiter((i for w in whole for i in w), np.uint32, int(length.sum()))
    return flat, np.cumsum(length) - length, length


def expand(symbols, rules, base):
    """The ids that a stretch of symbols stands for, given the rules' expansions."""
    flat, first, length = rules
    rule = np.flatnonzero(symbols >= base)
    used = symbols[rule].astype(np.int64) - base
    sizes = np.ones(len(symbols), np.int32)
    sizes[rule] = length[used]
    out = np.repeat(symbols.astype(np.uint32), sizes)
    begin = (np.cumsum(sizes, dtype=np.int64) - sizes)[rule]
    n = length[used]
    ahead = np.cumsum(n) - n
    at = np.arange(int(n.sum())) - np.repeat(ahead, n)
    out[np.repeat(begin, n) + at] = flat[np.repeat(first[used], n) + at]
    return out


def write_shard(doc_ids, ids, base):
    """The bytes of one shard: head, documents (known, doc_id, ids, symbols), rules with lengths, symbols."""
    lengths = np.array([len(b) // 4 for b in ids], np.uint32)
    flat = np.frombuffer(b"".join(ids), "<u4")
    starts = np.zeros(len(flat), bool)
    begin = np.cumsum(lengths) - lengths
    starts[begin] = True
    symbols, starts, left, right = replace_pairs(flat, starts, base)
    per_doc = np.diff(np.append(np.flatnonzero(starts), len(symbols))).astype(np.uint32)
    short = base + len(left) <= 0xFFFF
    known = np.array([d is not None for d in doc_ids], np.uint8)
    names = np.array([d or 0 for d in doc_ids], np.int64)
    head = HEAD.pack(MAGIC, base, len(ids), len(left), len(symbols), 2 if short else 4)
    return head + b"".join(a.tobytes() for a in (known, names, lengths, per_doc, left, right,
                                                 expansions(left, right, base)[2].astype(np.uint32),
                                                 symbols.astype("<u2" if short else "<u4")))


class Shard:
    """One shard read back: doc_ids, lengths, and the ids of any stretch of any document."""

    def __init__(self, payload):
        magic, self.base, docs, rules, symbols, width = HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = HEAD.size

        def take(kind, n):
            nonlocal at
            got = np.frombuffer(payload, kind, n, at)
            at += got.nbytes
            return got

        known, names = take("u1", docs), take("<i8", docs)
        self.doc_ids = [int(d) if k else None for k, d in zip(known, names)]
        self.lengths, self.per_doc = take("<u4", docs), take("<u4", docs)
        self.left, self.right, self.rule_lengths = (take("<u4", rules) for _ in range(3))
        self.symbols = take(f"<u{width}", symbols)
        self.first = np.cumsum(self.per_doc, dtype=np.int64) - self.per_doc
        self.rules = expansions(self.left, self.right, self.base)

    def ids(self, doc, start=0, length=None):
        """Ids start to start + length of a document, expanding only the symbols that cover them."""
        own = self.symbols[self.first[doc]:self.first[doc] + self.per_doc[doc]].astype(np.int64)
        length = int(self.lengths[doc]) - start if length is None else length
        sizes = np.ones(len(own), np.int64)
        rule = own >= self.base
        sizes[rule] = self.rule_lengths[own[rule] - self.base]
        ends = np.cumsum(sizes)
        a = int(np.searchsorted(ends, start, "right"))
        b = int(np.searchsorted(ends, start + length, "left")) + 1
        skip = start - (int(ends[a - 1]) if a else 0)
        return expand(own[a:b], self.rules, self.base)[skip:skip + length]

    def all_ids(self):
        return expand(self.symbols, self.rules, self.base)


def encode_shards(docs, tokenizer, end_id, base):
    """Token shards of all documents in ascending doc_id order: (shard, part, n_docs, n_tokens, payload).

    Null text counts as empty (its document is just the end id); null doc_ids come first and stay null; equal doc_ids
    are ordered by a hash of their text and keep their own rows; other columns are ignored. The only shuffle is the
    range partitioning by doc_id. A shard is closed at 2 million tokens, so memory is bounded whatever the partition.
    """
    end = end_id.to_bytes(4, "little")

    def shards(batches):
        codes, part, made = encoder(tokenizer, drops_space=False, limit=PIECES), TaskContext.get().partitionId(), 0
        doc_ids, ids, tokens = [], [], 0

        def closed():
            return rows_out(SHARDS, [[(part << 32) + made], [part], [len(ids)], [tokens],
                                     [write_shard(doc_ids, ids, base)]])

        for batch in batches:
            for doc_id, own in zip(batch["doc_id"].to_pylist(), codes.encode(batch["text"].to_pylist())):
                doc_ids.append(doc_id)
                ids.append(own + end)
                tokens += len(own) // 4 + 1
                if tokens >= SHARD_TOKENS:
                    yield closed()
                    made, doc_ids, ids, tokens = made + 1, [], [], 0
        if ids:
            yield closed()

    ready(docs.sparkSession)
    keyed = texts_of(docs, "doc_id").withColumn("tie", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return ordered.select("doc_id", "text").mapInArrow(
        shards, "shard long, part int, n_docs int, n_tokens long, payload binary")


def read_documents(shards):
    """Every document of written shards, decoded: (doc_id, start, n_tokens, ids_crc32); start counts all ids before."""

    def decoded(batches):
        for batch in batches:
            for shard, payload in zip(batch["shard"].to_pylist(), batch["payload"]):
                own = Shard(payload.as_buffer())
                raw = memoryview(own.all_ids().astype("<u4").tobytes())
                ends = np.cumsum(own.lengths, dtype=np.int64)
                begin = ends - own.lengths
                sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begin.tolist(), ends.tolist())]
                yield rows_out(READ, [[shard] * len(sums), own.doc_ids, begin, own.lengths.astype(np.int64), sums])

    ready(shards.sparkSession)
    documents = shards.select("shard", "payload").mapInArrow(
        decoded, "shard long, doc_id long, in_shard long, n_tokens long, ids_crc32 long")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sizes = shards.select("part", "shard", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before(Window.orderBy("part"))), F.lit(0)).alias("ahead"))
    inside = F.coalesce(F.sum("n_tokens").over(before(Window.partitionBy("part").orderBy("shard"))), F.lit(0))
    at = sizes.withColumn("inside", inside).join(parts, "part").select("shard", (F.col("ahead") + F.col("inside"))
                                                                      .alias("ahead"))
    return documents.join(at, "shard").select(
        "doc_id", (F.col("ahead") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32", "shard")
