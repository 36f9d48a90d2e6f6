"""Exact Jaccard join of shingle sets by universe partitioning: shingles are hashed into segments by size band, segment
contents and one-deletion neighbourhoods are indexed, each record probes its cheapest ones, and pairs are verified.

Why nothing is lost. Two sets of n and n' >= n shingles that link differ in at most h(n) shingles. The shingles of both
are cut into the same segments, so of any h(n) + 1 segments one has equal content; a segment probed with its one-deletion
neighbourhood counts twice, as it also finds a difference of one. The smaller record's probes all lie in its first
K(n) segments, and the larger one indexes at least those. Which of them it probes is free, so it takes the cheapest: a
content that no other record has costs nothing.
"""

from bisect import bisect_right
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import functions as F

from .common import Scratch, components, ready, rows_out, texts_of
from .tokens import forget

#: Words of a shingle, and the percent at which two documents link (100 * intersection >= percent * union), where the
#: caller does not say.
WORDS, PERCENT = 4, 85
#: Segments beyond the least number, as a factor and a sum, which give a record some choice.
SPARE, MORE = 1.15, 2
#: The first segments, which are also indexed by one-deletion neighbourhoods.
WIDE = 2
#: Candidates up to which their ids are broadcast.
BROADCAST_IDS = 1_000_000
#: The records of a key are compared in blocks: so many that ask and that are asked.
ASKING, ASKED = 256, 512
#: Records of a group of candidates that one block of the exact comparison holds, and their shingles.
HOT, HOT_SHINGLES = 512, 1 << 19
#: Bits of a record's parity word, in all and per shingle in which linked sets may differ. Counts of few shingles scatter more, so
#: their words are longer for it.
PARITY_BITS, PARITY_EACH = 256, 4
U = np.uint64


S27, S30, S31, M1, M2 = U(27), U(30), U(31), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mix(x):
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> S30)
    x *= M1
    x ^= x >> S27
    x *= M2
    x ^= x >> S31
    return x


class Shingler:
    """Texts to sorted distinct shingle hashes."""

    def __init__(self, words=WORDS):
        self.words = words

    def hashes(self, text):
        """A-Z are lower-cased and white space is ASCII; with too few words the whole sequence is one shingle."""
        words = text.encode().lower().split()
        w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U, len(words))
        size = min(self.words, len(w))
        if not size:
            return w
        total, factor = np.full(len(w) - size + 1, size, U), 0x9E3779B97F4A7C15
        for i in range(size):
            total += w[i:len(w) - size + 1 + i] * U(factor)
            factor = factor * 0xD1342543DE82EF95 % (1 << 64)
        total = mix(total)
        total.sort()
        fresh = np.ones(len(total), bool)
        np.not_equal(total[1:], total[:-1], out=fresh[1:])
        return total[fresh]


def digest(shingles):
    """Two signed longs that stand for a set."""
    both = xxhash.xxh3_128_digest(shingles.tobytes())
    return np.frombuffer(both, "<i8").tolist()


def most_different(n, percent=PERCENT):
    """h(n): in how many shingles a set of n and a linked one of at least n can differ."""
    return (100 - percent) * (n + 100 * n // percent) // (100 + percent)


def segments(n, percent=PERCENT):
    """Segments that give a set of n shingles its choice; for the largest size of a band, the band's segments."""
    return int(SPARE * (most_different(n, percent) + 1)) + MORE


def shared_least(n, percent=PERCENT):
    """The same as a column: of its segments, how many a set of n shingles shares with a linked larger one at least."""
    most = F.floor((100 - percent) * (n + F.floor(100 * n / percent)) / (100 + percent))
    return F.floor(SPARE * (most + 1)) + MORE - most


@cache
def limits(percent=PERCENT):
    """The smallest size of each band: so that a linked set lies in the same band or a neighbouring one."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(100 * out[-1] // percent + 1)
    return out


def bands(n, percent=PERCENT):
    """The band of a size, and the next if a linked larger set can lie in it."""
    own = bisect_right(limits(percent), n) - 1
    return [own, own + 1] if 100 * n // percent >= limits(percent)[own + 1] else [own]


def largest(band, percent=PERCENT):
    return limits(percent)[band + 1] - 1


def keys(shingles, band, percent=PERCENT):
    """Index keys of a set in a band: one per segment of its first K(n), and the neighbourhoods of the wide ones."""
    count, upto = segments(largest(band, percent), percent), segments(len(shingles), percent)
    spread = mix(shingles + U(band + 1))
    place = ((spread >> U(33)) % U(count)).astype(np.int64)
    inside = place < upto
    place, spread = place[inside], spread[inside]
    order = np.argsort(place.astype(np.uint16) if upto < 1 << 16 else place, kind="stable")
    place, spread = place[order], spread[order]
    value = np.zeros(upto, U)
    if len(place):
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        value[place[first]] = np.add.reduceat(spread, first)
    name = mix((U(band) << U(32)) + np.arange(upto, dtype=U) + U(1))
    own = mix(value ^ name)
    near = [mix((value[i] - spread[place == i]) ^ name[i]) for i in range(min(WIDE, upto))]
    return own.view(np.int64), [x.view(np.int64) for x in near] + [np.zeros(0, np.int64)] * (WIDE - len(near))


def parity(shingles, band, percent=PERCENT):
    """The parity word of a set in a band: one bit per cell, set if an odd number of the set's shingles fall into it. Words of
    two sets differ in no more bits than the sets differ in shingles."""
    words = -(-(PARITY_BITS + PARITY_EACH * most_different(largest(band, percent), percent)) // 64)
    cells = (mix(shingles ^ U(0x5851F42D4C957F2D + band)) >> U(11)) % U(64 * words)
    return np.packbits(np.bincount(cells.astype(np.int64), minlength=64 * words) & 1, bitorder="little").tobytes()


def lists(values, kind):
    """An Arrow list column of numpy arrays."""
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def sketch(docs, words, percent, row=None):
    """One row per document, and a second, not `main`, per document that a second band concerns:
    (row, main, doc_id, n, d1, d2, bits, own, wide0, wide1). Sets that can only link with equal ones have no keys. `row` is
    a column of docs that tells rows apart, or they are numbered here."""

    def sketched(batches):
        forget()
        shingler, part, made = Shingler(words), TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            rows, own, wide = [], [], [[], []]
            named = batch[row].to_pylist() if row else range(part + made, part + made + len(batch))
            for number, doc_id, text in zip(named, batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                s = shingler.hashes(text)
                d1, d2 = digest(s)
                of = bands(len(s), percent) if len(s) and most_different(len(s), percent) else [None]
                for i, band in enumerate(of):
                    empty = np.zeros(0, np.int64)
                    k, near = (empty, [empty] * WIDE) if band is None else keys(s, band, percent)
                    bits = None if band is None else parity(s, band, percent)
                    rows.append((number, i == 0, doc_id, len(s), d1, d2, bits))
                    own.append(k)
                    for column, x in zip(wide, near):
                        column.append(x)
            made += len(batch)
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(kinds), kinds)]
            names = ["row", "main", "doc_id", "n", "d1", "d2", "bits", "own", "wide0", "wide1"]
            yield pa.RecordBatch.from_arrays(columns + [lists(c, pa.int64()) for c in (own, *wide)], names=names)

    longs = "array<long>"
    return texts_of(docs, "doc_id", *([row] if row else [])).mapInArrow(
        sketched, f"row long, main boolean, doc_id long, n int, d1 long, d2 long, bits binary, own {longs}, wide0 {longs}, "
                  f"wide1 {longs}")


def record():
    """A row's number in one of its bands."""
    return (F.col("row") * 2 + F.col("main").cast("int")).alias("record")


def entries(sketches):
    """The index entries of all records: (record, key, slot); slots from 0 are segments, -1 and -2 neighbourhoods."""
    own = F.transform("own", lambda key, i: F.struct(key.alias("key"), i.alias("slot")))
    near = [F.transform(f"wide{w}", lambda key: F.struct(key.alias("key"), F.lit(-1 - w).alias("slot")))  # noqa: B023
            for w in range(WIDE)]
    return sketches.select(record(), F.inline(F.concat(own, *near)))


def choose_probes(listed, percent):
    """(record, key) to probe: for each record (record, n, entries of shared keys), its cheapest allocation."""

    def chosen(batches):
        for batch in batches:
            out_record, out_key = [], []
            for record, n, found in zip(*(batch[c].to_pylist() for c in ("record", "n", "found"))):
                own = sorted((e["cnt"], e["slot"], e["key"]) for e in found if e["slot"] >= 0)
                upto = segments(n, percent)
                left = most_different(n, percent) + 1 - (upto - len(own))
                if left <= 0:
                    continue
                cost_of = {slot: cnt for cnt, slot, _ in own}
                choices = [(cnt, 0, [key]) for cnt, _, key in own]
                for w in range(WIDE):
                    near = [e for e in found if e["slot"] == -1 - w]
                    cost = sum(e["cnt"] for e in near)
                    choices.append((max(cost, cost_of.get(w, 0)), 1, [e["key"] for e in near]))
                for _, _, probes in sorted(choices, key=lambda c: c[:2])[:left]:
                    out_record += [record] * len(probes)
                    out_key += probes
            yield pa.RecordBatch.from_arrays([pa.array(out_record, pa.int64()), pa.array(out_key, pa.int64())],
                                             names=["record", "key"])

    return listed.mapInArrow(chosen, "record long, key long")


def sets_of(docs, reps, classes, scratch, words):
    """(rep, shingles) of the classes that a table names in its column rep. Only their texts are shingled again."""
    ids = scratch.save(reps.distinct().join(classes, "rep").select("rep", "doc_id", "d1", "d2"), "candidates")
    wanted = ids.select(F.col("doc_id").alias("wanted")).distinct()
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)

    def shingled(batches):
        shingler = Shingler(words)
        for batch in batches:
            sets = [shingler.hashes(t) for t in batch["text"].to_pylist()]
            both = [digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in both], pa.int64()), pa.array([d[1] for d in both], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=["d1", "d2", "shingles"])

    texts = texts_of(docs, "doc_id").join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    sets = texts.select("text").mapInArrow(shingled, "d1 long, d2 long, shingles binary")
    found = sets.join(ids, ["d1", "d2"]).select("rep", "shingles").dropDuplicates(["rep"])
    return scratch.save(found, "sets")


def verify(docs, pairs, classes, scratch, words, percent):
    """Those of the pairs (a, b) of classes whose sets link."""
    sets = sets_of(docs, pairs.select(F.col("a").alias("rep")).union(pairs.select("b")), classes, scratch, words)

    def linked(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch["left"], batch["right"]):
                x, y = (np.frombuffer(v.as_buffer(), U) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    lefts = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("left"))
    rights = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("right"))
    links = pairs.join(lefts, "a").join(rights, "b").select("a", "b", "left", "right").mapInArrow(linked, "a long, b long")
    links = scratch.save(links.distinct(), "links")
    scratch.drop(sets)
    return links


def nearest_forest(x, y, apart):
    """Which of the candidate pairs (x, y) a minimum spanning forest holds: every record with its nearest, and all that hang
    together by candidates still do."""
    names, ends = np.unique(np.concatenate([x, y]), return_inverse=True)
    above, kept = list(range(len(names))), []

    def root(node):
        while above[node] != node:
            above[node] = node = above[above[node]]
        return node

    ends = ends.reshape(2, -1).tolist()
    for k in np.argsort(apart, kind="stable").tolist():
        p, q = root(ends[0][k]), root(ends[1][k])
        if p != q:
            above[p] = q
            kept.append(k)
    return kept


def candidates(members, askers, marks, percent):
    """(a, b): of the rows of different components that share a key and whose parity words differ in no more places than
    linked sets may differ in shingles, so many pairs that every two of them hang together.

    Askers and members of a key are cut into blocks, and each pair of blocks is compared in one task, so that no key is too
    large for it. A block yields a spanning forest of its pairs, the nearest first, so fewer pairs than it has records.
    """
    count = lambda t, n: t.groupBy("key").agg(F.ceil(F.count("*") / n))
    sizes = count(members, ASKED).toDF("key", "to").join(count(askers, ASKING).toDF("key", "of"), "key")
    number = lambda n: F.pmod(F.xxhash64("record"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    item = ["row", "part", "n", "bits"]
    told = lambda t: t.join(sizes, "key").join(marks, "record")
    asking = told(askers).select("key", *item, F.lit(True).alias("asks"), number("of").alias("x"), every("to").alias("y"))
    asked = told(members).select("key", *item, F.lit(False).alias("asks"), number("to").alias("y"), every("of").alias("x"))
    blocks = asking.unionByName(asked).groupBy("key", "x", "y").agg(F.collect_list(F.struct("asks", *item)).alias("members"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def paired(batches):
        for batch in batches:
            out = [np.zeros((2, 0), np.int64)]
            for own in batch["members"]:
                own = own.values
                asks, row, part, n = (own.field(c).to_numpy(zero_copy_only=False) for c in ("asks", "row", "part", "n"))
                asks, n = asks.astype(bool), n.astype(np.int64)
                words = np.frombuffer(b"".join(own.field("bits").to_pylist()), U).reshape(len(own), -1)
                others, met = np.flatnonzero(~asks), [np.zeros((3, 0), np.int64)]
                for i in np.flatnonzero(asks):
                    at = others[part[others] != part[i]]
                    apart = np.bitwise_count(words[at] ^ words[i]).sum(1, dtype=np.int64)
                    near = apart <= (100 - percent) * (n[at] + n[i]) // (100 + percent)
                    if near.any():
                        at = at[near]
                        met.append(np.stack([np.minimum(row[at], row[i]), np.maximum(row[at], row[i]), apart[near]]))
                met = np.concatenate(met, axis=1)
                out.append(met[:2, nearest_forest(*met)])
            yield rows_out(schema, list(np.concatenate(out, axis=1)))

    return blocks.select("members").mapInArrow(paired, "a long, b long")


def links_of_groups(docs, met, grouped, classes, scratch, words, percent):
    """Links (a, b) that join all components (`grouped`: node, component) between which there are links, of the rows that hang
    together by candidates `met`: such a group of several components is compared whole, by its sets.

    A group is cut into blocks of bounded size, and each pair of blocks is compared in one task, which yields only links
    that join two components, fewer than it has records.
    """
    group = components(scratch, met).select(F.col("node").alias("rep"), F.col("component").alias("group"))
    at = group.join(grouped.withColumnRenamed("node", "rep"), "rep", "left").join(classes.select("rep", "n"), "rep")
    at = scratch.save(at.select("rep", "group", "n", F.coalesce("component", "rep").alias("part")), "grouped")
    sizes = at.groupBy("group").agg(
        F.min("part").alias("p"), F.max("part").alias("q"),
        F.greatest(F.ceil(F.count("*") / HOT), F.ceil(F.sum("n") / HOT_SHINGLES)).alias("blocks")).where("p <> q")
    apart = scratch.save(at.join(sizes.select("group", "blocks"), "group"), "open")
    sets = sets_of(docs, apart.select("rep"), classes, scratch, words)
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).alias("own")
    placed = apart.select("rep", "group", "part", own, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("to"))
    blocks = placed.join(sets, "rep").groupBy("group", F.least("own", "to").alias("x"), F.greatest("own", "to").alias("y")).agg(
        F.collect_list(F.struct("rep", "part", (F.col("own") < F.col("to")).alias("left"),
                                (F.col("own") > F.col("to")).alias("right"), "shingles")).alias("members"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compared(batches):
        for batch in batches:
            out = []
            for own in batch["members"]:
                own = own.values
                row, part, left, right = (own.field(c).to_numpy(zero_copy_only=False) for c in ("rep", "part", "left", "right"))
                part, sets = part.copy(), [np.frombuffer(v.as_buffer(), U) for v in own.field("shingles")]
                n = np.array([len(s) for s in sets])
                starts = np.cumsum(n) - n
                names, which = np.unique(np.concatenate(sets), return_inverse=True)
                for i in np.flatnonzero(~right.astype(bool)):
                    others = right.astype(bool) if left[i] else np.arange(len(row)) > i
                    if not (others & (part != part[i])).any():
                        continue
                    own_names = np.zeros(len(names), np.int32)
                    own_names[which[starts[i]:starts[i] + n[i]]] = 1
                    both = np.add.reduceat(own_names[which], starts)
                    linked = others & (100 * both >= percent * (n + n[i] - both))
                    for j in np.flatnonzero(linked).tolist():
                        if part[j] != part[i]:
                            out.append((row[i], row[j]))
                            part[part == part[j]] = part[i]
            yield rows_out(schema, list(np.array(out, np.int64).reshape(-1, 2).T))

    return scratch.save(blocks.select("members").mapInArrow(compared, "a long, b long"), "links")


def jaccard_join(docs, scratch=None, words=WORDS, percent=PERCENT, row=None):
    """Classes of linked documents: (row, doc_id, n_shingles, component_id, kept), one row per document. Documents link
    when their sets of shingles of so many words have a Jaccard similarity of so many percent or more.

    component_id is the smallest doc_id reachable by links, kept marks the first row that has it. Null and empty texts,
    and texts of white space, have no shingles and link with nothing; equal sets of one shingle or more always link;
    repeated and null doc_ids keep their own rows (`row` names a column of longs within 2^61 that tells them apart, else rows are
    numbered); other columns are ignored; an empty table gives no rows. Shingles are told apart by 64-bit hashes, equal
    sets by 128-bit ones.

    Equal sets are one class throughout. Index entries move twice as integers: to be counted, and to meet the keys that
    at least two classes have, a small rest. Groups of near copies are not joined all with all. First each record that has
    anything to probe is compared with the best connected record that it shares many keys with, which leaves components.
    Records of different components that meet by a probe are compared by their parity words, in blocks, and of those pairs
    that these allow a spanning forest per block is verified. Records that hang together by such pairs and still lie in
    different components are compared by their sets, in blocks. So pairs are no more than records of blocks and no link
    between components is lost.
    """
    spark = docs.sparkSession
    ready(spark)
    scratch = scratch or Scratch(spark, "jaccard")
    sketches = scratch.save(sketch(docs, words, percent, row), "sketches")
    main = sketches.where("main").select("row", "doc_id", "n", "d1", "d2")
    classes = scratch.save(main.where("n > 0").groupBy("d1", "d2", "n").agg(
        F.min(F.struct("row", "doc_id")).alias("first"), F.count("*").alias("rows"))
        .select("d1", "d2", "n", F.col("first.row").alias("rep"), F.col("first.doc_id").alias("doc_id"), "rows"), "classes")
    copied = scratch.save(classes.where("rows > 1").select("d1", "d2", "rep"), "copied")
    members = scratch.save(main.join(copied, ["d1", "d2"], "left").select(
        "row", "doc_id", "n", F.when(F.col("n") > 0, F.coalesce("rep", "row")).otherwise(F.col("row")).alias("rep")), "members")
    scratch.drop(copied)
    spare = scratch.save(members.where("row <> rep").select("row"), "spare")
    if spare.count() <= BROADCAST_IDS:
        spare = F.broadcast(spare)
    single = sketches.where("bits is not null").join(spare, "row", "left_anti")

    shared = scratch.save(entries(single).groupBy("key").agg(F.count("*").alias("cnt")).where("cnt > 1"), "shared")
    index = scratch.save(entries(single).join(shared, "key").select("key", "record", "slot", "cnt"), "index")
    scratch.drop(shared)
    marks = single.select(record(), "n", "bits").join(index.select("record").distinct(), "record")
    marks = scratch.save(marks, "marks")
    scratch.drop(sketches)
    row_of = F.shiftright("record", 1).alias("row")
    listed = index.groupBy("record").agg(F.sum("cnt").alias("degree"), F.collect_list(F.struct("cnt", "slot", "key")).alias("found"))
    listed = scratch.save(listed.join(marks.select("record", "n"), "record"), "listed")
    probes = scratch.save(choose_probes(listed.select("record", "n", "found"), percent).distinct(), "probes")

    degrees = listed.groupBy(row_of).agg(F.sum("degree").alias("degree"))
    keyed = index.where("slot >= 0").select("key", row_of)
    centers = keyed.join(degrees, "row").groupBy("key").agg(F.max(F.struct("degree", "row"))["row"].alias("center"))
    centers = scratch.save(centers, "centers")
    probing = probes.select("record").distinct().join(marks.select("record", "n"), "record").select(
        row_of, (shared_least(F.col("n"), percent) / 2).alias("least")).distinct()
    tried = keyed.join(scratch.save(probing, "probing"), "row").join(centers, "key").where("row <> center")
    tried = tried.groupBy("row", "center").agg(F.count("*").alias("times"), F.first("least").alias("least"))
    favourite = tried.where("times >= least").groupBy("row").agg(F.max(F.struct("times", "center"))["center"].alias("center"))
    near = scratch.save(favourite.select(F.least("row", "center").alias("a"), F.greatest("row", "center").alias("b"))
                        .distinct(), "near")
    scratch.drop(listed, centers)
    links = verify(docs, near, classes, scratch, words, percent)
    grouped = components(scratch, links)

    at = index.select("key", "record", row_of).distinct().join(grouped.withColumnRenamed("node", "row"), "row", "left")
    at = scratch.save(at.select("key", "record", "row", F.coalesce("component", "row").alias("part")), "parts")
    scratch.drop(index)
    mixed = scratch.save(at.groupBy("key").agg(F.min("part").alias("x"), F.max("part").alias("y"))
                         .where("x <> y").select("key"), "mixed")
    inside = scratch.save(at.join(mixed, "key"), "inside")
    asked = scratch.save(probes.join(inside, ["key", "record"]), "asked")
    met = scratch.save(candidates(inside, asked, marks, percent).distinct(), "met")
    scratch.drop(at, mixed, inside, asked, probes, marks)
    rest = scratch.save(met.join(near, ["a", "b"], "left_anti"), "rest")
    links = scratch.save(links.union(verify(docs, rest, classes, scratch, words, percent)), "links")
    last = links_of_groups(docs, met, components(scratch, links), classes, scratch, words, percent)
    grouped = components(scratch, links.union(last))
    scratch.drop(met, rest)

    own = members.join(grouped.withColumnRenamed("node", "rep"), "rep", "left")
    own = scratch.save(own.select("row", "doc_id", "n", F.coalesce("component", "rep").alias("root")), "roots")
    groups = own.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"),
                                     F.count("*").alias("rows"))
    several = scratch.save(groups.where("rows > 1").select("root", "first"), "groups")
    joined = own.join(several, "root", "left")
    alone = F.col("first").isNull()
    return joined.select(
        "row", "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        (alone | (F.col("row") == F.col("first.row"))).alias("kept"))
