"""Nearest vectors by inner product: nodes are dealt to shards of bounded size, NN-descent builds a neighbour graph of each,
and every query walks all shards greedily. A shard is built, and walked by a bounded number of queries, inside one task, so
neither candidates nor steps move between tasks. Recall is measured by brute force, and the walk widened until it is
reached."""

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ready, rows_out

#: Neighbours kept of each vector, the best of them that queries follow, and rounds of refinement.
NEIGHBOURS, FOLLOWED, ROUNDS = 32, 24, 2
#: Random projections that start the graph, the vectors of one of their buckets, and the most bits of a bucket's name.
PROJECTIONS, BUCKET, BITS = 12, 256, 24
#: Vectors that a task compares with each other in a list of neighbours, and how many others each is offered there.
LIST, OFFERS = 64, 6
#: Places that a query remembers, those it expands per step, sampled entries to the graph, and the best it starts from.
BEAM, EXPANDED, ENTRIES, STARTS = 240, 64, 256, 8
#: Nodes of a shard and bytes of their codes, at most, and queries that walk a shard in one task.
SHARD, SHARD_BYTES, QUERIES = 32_768, 8 << 20, 4096
#: Products of lists that are held at once, and edges that go into a graph at once.
PRODUCTS, MERGED = 1 << 18, 1 << 20
#: Partitions over which shards to be built or walked are dealt: so many for each, and at least.
SPREAD, LEAST_SPREAD = 8, 64
#: Nodes of a query whose exact product is computed, at least.
RESCORED = 64
#: Queries audited, the recall asked for, and how often the beam may double before all vectors are compared.
AUDITED, LEAST_RECALL, WIDENINGS = 128, 0.93, 3
#: Vectors of a block where all are compared.
BLOCK = 2048
CODED = "code binary, scale double"


@dataclass
class Index:
    """nodes (id, dim, embedding, copies, vec_id, code, scale): one per distinct vector; rows (vec_id, id): the rows that
    hold them; links (dim, part, id, code, scale, near): of each node, its shard and the neighbours to follow there."""

    nodes: DataFrame
    rows: DataFrame
    links: DataFrame


def usable(vectors, name):
    """Rows with an id and a vector that is not null, empty or zero and has only finite components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col(name).isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    return vectors.select(name, "embedding").where(F.coalesce(good, F.lit(False)))


def matrix(column):
    """The vectors of an Arrow list column of equal lengths, in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def codes(column):
    """The rows of bytes of an Arrow binary column of equal lengths."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.int8).reshape(len(column), -1)


def quantised(x):
    """Each vector as bytes and the number to multiply them by."""
    scale = np.maximum(np.abs(x).max(1), 127 * np.finfo(np.float64).tiny) / 127
    return np.rint(x / scale[:, None]).astype(np.int8), scale


def by_length(column):
    """Places of the rows of a list or binary column, by their lengths."""
    lengths = (column.value_lengths() if hasattr(column, "value_lengths") else pa.compute.binary_length(column)).to_numpy()
    return [(int(n), np.flatnonzero(lengths == n)) for n in np.unique(lengths)]


def with_codes(frame, *kept):
    """A frame's columns and its embeddings' codes."""

    def coded(batches):
        for batch in batches:
            code, scale = [None] * len(batch), np.zeros(len(batch))
            for _, at in by_length(batch["embedding"]):
                small, own = quantised(matrix(batch["embedding"].take(pa.array(at))))
                scale[at] = own
                for i, row in zip(at.tolist(), small):
                    code[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(code, pa.binary()), pa.array(scale)],
                                             names=[*kept, "code", "scale"])

    types = ", ".join(f"{c} {frame.schema[c].dataType.simpleString()}" for c in kept)
    return frame.select(*kept).mapInArrow(coded, f"{types}, {CODED}")


def nodes_of(vectors, scratch):
    """The nodes and rows of an index."""
    rows = usable(vectors, "vec_id").distinct()
    groups = rows.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    groups = groups.select(F.monotonically_increasing_id().alias("id"), F.size("embedding").alias("dim"), "embedding",
                           "copies", "vec_id")
    plain = scratch.save(groups, "distinct")
    nodes = scratch.save(with_codes(plain, "id", "dim", "embedding", "copies", "vec_id"), "nodes")
    own = rows.join(nodes.where("copies > 1").select("embedding", "id"), "embedding").select("vec_id", "id")
    own = scratch.save(own.union(nodes.where("copies = 1").select("vec_id", "id")), "rows")
    scratch.drop(plain)
    return nodes, own


def best(edges, key, other, most):
    """The best distinct others of each key: (key, found), found sorted by falling `sim`. What every task holds beyond them
    is dropped before the rest moves."""
    place = F.dense_rank().over(Window.partitionBy(key).orderBy(F.desc("sim"), other))
    few = edges.withColumn("place", place).where(F.col("place") <= most)
    return few.groupBy(key).agg(F.sort_array(F.collect_set(F.struct("sim", other)), asc=False).alias("found"))


def shards(nodes):
    """Nodes with the shard (dim, part) that each is dealt to by a hash, and how many shards there are."""
    most = F.greatest(F.lit(1), F.least(F.lit(SHARD), F.floor(F.lit(SHARD_BYTES) / F.col("dim"))))
    parts = nodes.groupBy("dim").agg(F.count("*").alias("n")).select("dim", F.ceil(F.col("n") / most).alias("parts"))
    count = parts.agg(F.coalesce(F.sum("parts"), F.lit(0))).first()[0]
    dealt = nodes.join(F.broadcast(parts), "dim").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    return dealt.drop("parts"), count


def cut(keys, most, rng):
    """Places with equal keys, in lists of at most `most` however hot a key is: (places, where each list starts, and the end)."""
    order = np.lexsort((rng.random(len(keys)), keys))
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    size = np.diff(np.append(first, len(keys)))
    place = np.arange(len(keys)) - np.repeat(first, size)
    piece = place * np.repeat(-(-size // most), size) // np.repeat(size, size)
    new = np.append(True, (keys[1:] != keys[:-1]) | (piece[1:] != piece[:-1]))
    return order, np.append(np.flatnonzero(new), len(keys))


def offers(x, scale, floor, members, bounds):
    """Compare all vectors of each list with each other: (a, b, sim) of each one's best others above its floor, block by block."""
    sizes = np.diff(bounds)
    lists, at = np.argsort(-sizes, kind="stable"), 0
    lists = lists[:np.count_nonzero(sizes > 1)]
    while at < len(lists):
        longest = sizes[lists[at]]
        some = lists[at:at + max(1, PRODUCTS // (longest * longest))]
        at += len(some)
        place = np.arange(longest)
        there = place < sizes[some, None]
        ids = members[np.where(there, bounds[some, None] + place, 0)]
        own = x[ids]
        weight = np.where(there, scale[ids], 0)
        sims = (own @ own.transpose(0, 2, 1)) * weight[:, :, None] * weight[:, None, :]
        sims[np.broadcast_to(~there[:, None, :], sims.shape)] = -np.inf
        sims[:, place, place] = -np.inf
        take = min(OFFERS, longest - 1)
        top = np.argpartition(sims, longest - take, axis=2)[:, :, longest - take:]
        sim = np.take_along_axis(sims, top, 2)
        good = there[:, :, None] & (sim > floor[ids][:, :, None])
        b = np.take_along_axis(np.broadcast_to(ids[:, None, :], sims.shape), top, 2)
        yield np.broadcast_to(ids[:, :, None], top.shape)[good], b[good], sim[good]


class Graph:
    """The best distinct others of each vector of a shard, by falling similarity: near (-1 where there are fewer) and sims."""

    def __init__(self, x, scale):
        self.x, self.scale = x, scale
        self.near = np.full((len(x), NEIGHBOURS), -1, np.int32)
        self.sims = np.full((len(x), NEIGHBOURS), -np.inf)

    def take(self, members, bounds):
        """Compare all vectors of each list and keep the best; what is no better than a vector's last is dropped at once."""
        held, count = [], 0
        for found in offers(self.x, self.scale, self.sims[:, -1], members, bounds):
            held.append(found)
            count += len(found[0])
            if count >= MERGED:
                self._merge(*map(np.concatenate, zip(*held)))
                held, count = [], 0
        if count:
            self._merge(*map(np.concatenate, zip(*held)))

    def _merge(self, a, b, sim):
        n = len(self.near)
        touched = np.zeros(n, bool)
        touched[a] = True
        rows, places = np.nonzero((self.near >= 0) & touched[:, None])
        key = np.append(a, rows) * np.int64(n) + np.append(b, self.near[rows, places])
        key, first = np.unique(key, return_index=True)
        a, b, sim = key // n, key % n, np.append(sim, self.sims[rows, places])[first]
        order = np.lexsort((-sim, a))
        a, b, sim = a[order], b[order], sim[order]
        starts = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        place = np.arange(len(a)) - np.repeat(starts, np.diff(np.append(starts, len(a))))
        best = place < NEIGHBOURS
        self.near[touched], self.sims[touched] = -1, -np.inf
        self.near[a[best], place[best]], self.sims[a[best], place[best]] = b[best], sim[best]

    def both_ways(self, most):
        """(a, b), sorted, of the `most` best neighbours in both directions."""
        n = len(self.near)
        a, place = np.nonzero(self.near[:, :most] >= 0)
        b = self.near[a, place].astype(np.int64)
        key = np.unique(np.append(a * n + b, b * n + a))
        return key // n, key % n


def started(graph, bucket, rng):
    """Neighbours among vectors that random projections, less the mean, put into the same bucket."""
    x, dim = graph.x * graph.scale[:, None], graph.x.shape[1]
    x -= x.mean(0)
    bits = min(BITS, max(0, math.ceil(math.log2(len(x) / bucket))))
    for _ in range(PROJECTIONS):
        sides = x @ rng.normal(size=(dim, bits)) > 0
        graph.take(*cut(sides @ (1 << np.arange(bits)), bucket, rng))


def refined(graph, rng):
    """One round of NN-descent: the neighbours of each vector, in both directions, are compared with each other. Lists of
    hubs are cut into parts."""
    a, b = graph.both_ways(NEIGHBOURS)
    order, bounds = cut(a, LIST, rng)
    graph.take(b[order], bounds)


def linked(x, scale, bucket, seed=0):
    """The neighbours that queries follow from each vector of a shard: (where those of each start, and the end, neighbours)."""
    graph, rng = Graph(x, scale), np.random.default_rng([seed, *x.shape])
    if len(x) > 1:
        started(graph, bucket, rng)
        for _ in range(ROUNDS):
            refined(graph, rng)
    a, b = graph.both_ways(FOLLOWED)
    return np.searchsorted(a, np.arange(len(x) + 1)), b


def build(vectors, scratch):
    """The index of all usable vectors (vec_id, embedding)."""
    nodes, rows = nodes_of(vectors, scratch)
    members, count = shards(nodes.select("dim", "id", "code", "scale"))

    def built(table):
        table = table.sort_by("id")
        ids, scale = table["id"].to_numpy(), table["scale"].to_numpy()
        starts, near = linked(codes(table["code"]).astype(np.float32), scale, BUCKET)
        near = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids[near], pa.int64()))
        return table.select(["dim", "part", "id", "code", "scale"]).append_column("near", near)

    links = spread(members, count, "dim", "part").groupBy("dim", "part").applyInArrow(
        built, "dim int, part long, id long, code binary, scale double, near array<long>")
    return Index(nodes, rows, scratch.save(links, "links"))


def spread(frame, groups, *keys):
    """A frame dealt by keys that have so many groups, few of which meet in a task: each is long work on few bytes, which
    adaptive execution would put together."""
    return frame.repartition(max(LEAST_SPREAD, SPREAD * groups), *keys)


class Walk:
    """Greedy search in a shard: a query expands its best places that are not yet expanded, until it has none left. Vectors stay
    bytes, so that a shard fits in the caches."""

    def __init__(self, x, scale, starts, near, beam, expanded):
        self.x, self.scale, self.starts, self.ends, self.near = x, scale, starts[:-1], starts[1:], near
        self.beam, self.expanded = beam, expanded
        rng = np.random.default_rng([0, *x.shape])
        self.entries = np.sort(rng.choice(len(x), min(ENTRIES, len(x)), replace=False))
        self.seen, self.turn = np.zeros(len(x), bool), np.zeros(len(x), np.int32)

    def products(self, ids, query):
        return (self.x.take(ids, 0).astype(np.float32) @ query) * self.scale.take(ids)

    def unseen(self, a):
        """The neighbours of places that the query has not met yet, each once."""
        first = self.starts.take(a)
        count = self.ends.take(a) - first
        ends = np.cumsum(count)
        new = self.near.take(np.arange(ends[-1]) + np.repeat(first - ends + count, count))
        new = new[~self.seen.take(new)]
        number = np.arange(len(new), dtype=np.int32)
        self.turn[new] = number
        new = new[self.turn.take(new) == number]
        self.seen[new] = True
        return new

    def best(self, query, own=None):
        """(ids, sims) of the best places of a query, from the best of a sample and the node that has its own vector."""
        sims = self.products(self.entries, query)
        ids = self.entries[np.argsort(-sims, kind="stable")[:STARTS]]
        if own is not None and own not in ids:
            ids = np.append(ids, own)
        sims = self.products(ids, query)
        order = np.argsort(-sims, kind="stable")
        ids, sims, done = ids[order], sims[order], np.zeros(len(ids), bool)
        self.seen[:] = False
        self.seen[ids] = True
        while len(fresh := np.flatnonzero(~done)[:self.expanded]):
            done[fresh] = True
            new = self.unseen(ids[fresh])
            found = self.products(new, query)
            if len(ids) >= self.beam:
                good = found > sims[-1]
                new, found = new[good], found[good]
            sims = np.append(sims, found)
            order = np.argsort(-sims, kind="stable")[:self.beam]
            ids, sims, done = np.append(ids, new)[order], sims[order], np.append(done, np.zeros(len(new), bool))[order]
        return ids, sims


def walked(index, asked, beam, most):
    """(query, id): the best `most` nodes of those that the walks of a query through all shards of its length end with. A task
    has one shard and a bounded number of queries."""
    parts = index.links.groupBy("dim").agg((F.max("part") + 1).alias("parts"))
    blocks = asked.groupBy("dim").agg(F.ceil(F.count("*") / QUERIES).alias("blocks"))
    shape = parts.join(blocks, "dim")
    count = shape.agg(F.coalesce(F.sum(F.col("parts") * F.col("blocks")), F.lit(0))).first()[0]
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    keys = ["dim", "part", "block"]
    left = index.links.join(F.broadcast(shape), "dim").select("dim", "part", every("blocks").alias("block"), "id", "code",
                                                             "scale", "near")
    right = asked.join(F.broadcast(shape), "dim").select(
        "dim", every("parts").alias("part"), F.pmod(F.xxhash64("query"), F.col("blocks")).alias("block"), "query", "code",
        "scale", "node")

    def found(shard, queries):
        shard, names, offsets, ids, sims = shard.sort_by("id"), [], [0], [], []
        if len(shard) and len(queries):
            own, near = shard["id"].to_numpy(), shard["near"].combine_chunks()
            starts = np.append(0, np.cumsum(near.value_lengths().to_numpy()))
            walk = Walk(codes(shard["code"]), shard["scale"].to_numpy(), starts,
                        np.searchsorted(own, near.flatten().to_numpy()).astype(np.int32), beam, EXPANDED)
            asks = codes(queries["code"]).astype(np.float32)
            for at, (name, scale, node) in enumerate(zip(*(queries[c].to_pylist() for c in ("query", "scale", "node")))):
                place = None if node is None else int(np.searchsorted(own, node))
                there = place is not None and place < len(own) and own[place] == node
                few, products = walk.best(asks[at], place if there else None)
                names.append(name)
                ids.append(own[few[:most]])
                sims.append(products[:most] * scale)
                offsets.append(offsets[-1] + len(ids[-1]))
        places = pa.StructArray.from_arrays([pa.array(np.concatenate([np.zeros(0), *sims])),
                                             pa.array(np.concatenate([np.zeros(0, np.int64), *ids]))], ["sim", "id"])
        return pa.table({"query": pa.array(names, pa.int64()),
                         "places": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), places)})

    ends = spread(left, count, *keys).groupBy(*keys).cogroup(spread(right, count, *keys).groupBy(*keys)).applyInArrow(
        found, "query long, places array<struct<sim: double, id: long>>")
    ends = ends.groupBy("query").agg(F.flatten(F.collect_list("places")).alias("places"))
    return ends.select("query", F.explode(F.slice(F.sort_array("places", asc=False), 1, most)).alias("e")).select("query", "e.id")


def exact_products(pairs, asked, nodes):
    """(query, id, score): the inner product of pairs in double precision, correctly rounded where components are floats."""
    schema = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])

    def products(batches):
        for batch in batches:
            score = np.zeros(len(batch))
            for _, at in by_length(batch["x"]):
                own = pa.array(at)
                x, y = matrix(batch["x"].take(own)), matrix(batch["y"].take(own))
                score[at] = [math.fsum(row) for row in (x * y).tolist()]
            yield rows_out(schema, [batch["query"], batch["id"], score])

    full = pairs.join(asked.select("query", F.col("embedding").alias("x")), "query").join(
        nodes.select("id", F.col("embedding").alias("y")), "id")
    return full.select("query", "id", "x", "y").mapInArrow(products, "query long, id long, score double")


def nearest_rows(scores, index, k):
    """(query, nearest): the k + 1 nearest rows of each query, as (score, vec_id), ties by smaller vec_id. Of a node, only
    its k + 1 smallest vec_ids can be among them."""
    by_id = Window.partitionBy("id").orderBy("vec_id")
    several = index.rows.join(index.nodes.where("copies > 1").select("id"), "id")
    several = several.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= k + 1)
    several = several.groupBy("id").agg(F.collect_list("vec_id").alias("vec_ids"))
    one = index.nodes.where("copies = 1").select("id", F.array("vec_id").alias("vec_ids"))
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    rows = scores.join(one.union(several), "id").select("query", "score", F.explode("vec_ids").alias("vec_id"))
    rows = rows.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= k + 1)
    return rows.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "score", "vec_id"))).alias("nearest"))


def true_scores(audited, index, k):
    """{query: the k + 1 best scores} of a bounded set of queries (rows with query and embedding), by brute force."""
    by_dim = {}
    for row in audited:
        by_dim.setdefault(len(row["embedding"]), []).append(row)
    asked = {n: ([r["query"] for r in own], np.array([r["embedding"] for r in own], np.float64)) for n, own in by_dim.items()}

    def compared(batches):
        tops = {}
        for batch in batches:
            for dim, at in by_length(batch["embedding"]):
                if dim not in asked:
                    continue
                own = pa.array(at)
                names, x = asked[dim]
                times = np.minimum(batch["copies"].take(own).to_numpy(), k + 1)
                sims = np.repeat(x @ matrix(batch["embedding"].take(own)).T, times, axis=1)
                for name, row in zip(names, sims):
                    tops[name] = np.sort(np.append(tops.get(name, np.zeros(0)), row))[-k - 1:]
        names = [n for n, top in tops.items() for _ in top]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(
            np.concatenate([*tops.values()]) if tops else np.zeros(0))], names=["query", "score"])

    scores = index.nodes.select("embedding", "copies").mapInArrow(compared, "query long, score double")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    found = {}
    for row in scores.withColumn("place", place).where(F.col("place") <= k + 1).collect():
        found.setdefault(row["query"], []).append(row["score"])
    return {query: sorted(own, reverse=True) for query, own in found.items()}


def recall_of(nearest, asked, index, k):
    """The share of the k + 1 best rows that at most `AUDITED` queries, the first by a hash, have found."""
    audited = asked.orderBy(F.xxhash64("query"), "query").limit(AUDITED).select("query", "embedding").collect()
    true = true_scores(audited, index, k)
    few = index.nodes.sparkSession.createDataFrame([(q,) for q in true], "query long")
    found = {r["query"]: [e["score"] for e in r["nearest"]]
             for r in nearest.join(F.broadcast(few), "query", "left_semi").collect()}
    shares = []
    for query, scores in true.items():
        least = scores[-1] - 1e-9 * abs(scores[-1])
        shares.append(sum(s >= least for s in found.get(query, [])) / len(scores))
    return float(np.mean(shares)) if shares else 1.0


def compared_all(asked, nodes, k):
    """(query, id) of the k + 1 nearest nodes of each query, by comparing all: queries and nodes are cut into blocks, and
    each pair of blocks is compared in one task."""
    size = lambda t: max(1, -(-t.count() // BLOCK))
    xs, ys = size(asked), size(nodes)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    item = lambda c, q: F.struct(F.lit(q).alias("asks"), F.col(c).alias("id"), F.col("embedding").cast("array<double>")
                                 .alias("x"))
    left = asked.select(F.pmod(F.xxhash64("query"), F.lit(xs)).alias("i"), every(ys).alias("j"),
                        F.size("embedding").alias("dim"), item("query", True).alias("member"))
    right = nodes.select(every(xs).alias("i"), F.pmod(F.xxhash64("id"), F.lit(ys)).alias("j"), "dim",
                         item("id", False).alias("member"))
    blocks = left.union(right).groupBy("dim", "i", "j").agg(F.collect_list("member").alias("members"))
    schema = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("sim", pa.float64())])

    def compared(batches):
        for batch in batches:
            for i in range(len(batch)):
                own = batch["members"][i].values
                asks = own.field("asks").to_numpy(zero_copy_only=False)
                ids, x = own.field("id").to_numpy(), matrix(own.field("x"))
                if asks.all() or not asks.any():
                    continue
                sims = x[asks] @ x[~asks].T
                take = min(k + 1, sims.shape[1])
                top = np.argpartition(-sims, take - 1, axis=1)[:, :take]
                yield rows_out(schema, [np.repeat(ids[asks], take), ids[~asks][top.ravel()],
                                        np.take_along_axis(sims, top, 1).ravel()])

    found = best(blocks.select("members").mapInArrow(compared, "query long, id long, sim double"), "query", "id", k + 1)
    return found.select("query", F.explode("found").alias("e")).select("query", "e.id")


def search(index, queries, k, scratch, others_only=False):
    """The k nearest rows of an index to each query (query_id, embedding): (query_id, rank, vec_id, score), and the recall.

    `others_only`: rows named like the query are no answers. Queries with equal vectors are one walk.
    """
    rows = scratch.save(usable(queries, "query_id"), "queries")
    asked = scratch.save(rows.select("embedding").distinct().select(F.monotonically_increasing_id().alias("query"), "embedding"),
                         "asked")
    asked = with_codes(asked, "query", "embedding").join(index.nodes.select("embedding", F.col("id").alias("node")),
                                                         "embedding", "left")
    asked = scratch.save(asked.withColumn("dim", F.size("embedding")), "asked")
    rescored, beam = max(2 * (k + 1), RESCORED), BEAM
    for widening in range(WIDENINGS + 1):
        pairs = walked(index, asked, beam, rescored)
        nearest = scratch.save(nearest_rows(exact_products(pairs, asked, index.nodes), index, k), "nearest")
        recall = recall_of(nearest, asked, index, k)
        if recall >= LEAST_RECALL or widening == WIDENINGS:
            break
        scratch.drop(nearest)
        beam, rescored = 2 * beam, 2 * rescored
    if recall < LEAST_RECALL:
        pairs = compared_all(asked, index.nodes, k)
        nearest = scratch.save(nearest_rows(exact_products(pairs, asked, index.nodes), index, k), "nearest")
        recall = 1.0
    told = rows.join(asked.select("embedding", "query"), "embedding").select("query_id", "query").distinct()
    answers = F.col("nearest")
    if others_only:
        answers = F.filter("nearest", lambda e: e["vec_id"] != F.col("query_id"))
    out = told.join(nearest, "query").select("query_id", F.posexplode(F.slice(answers, 1, k)).alias("at", "e"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), "e.vec_id", "e.score"), recall


def nearest(vectors, asking, k, scratch=None):
    """The k nearest others of the rows that the column `asking` picks: (query_id, rank, vec_id, score), and the recall.

    Nearness is the inner product in double precision, the largest first, ties to the smaller vec_id; ranks start at 1.
    Vectors that are null, empty, zero, or have a null or non-finite component, and rows without a vec_id, take no part;
    vectors of different lengths never meet; equal rows count once; rows that share a vec_id but not the vector are rows of
    their own, queries too, but never an answer to their own vec_id; other columns are ignored; an empty table gives no
    rows, and a query with fewer than k others has them all where the walk reaches them.

    Equal vectors are one node, in the graph and as a query. Nodes are dealt to shards by a hash; each shard has its graph, and
    a query walks all of them. Nodes are compared by vectors rounded to bytes; answers are scored by the vectors themselves. At most 128 queries are audited by brute force; where their
    recall stays below 0.93 with the widest beam, all queries are compared with all nodes in blocks, and nothing is lost.
    """
    ready(vectors.sparkSession)
    scratch = scratch or Scratch(vectors.sparkSession, "nearest")
    index = build(vectors, scratch)
    queries = vectors.where(asking).select(F.col("vec_id").alias("query_id"), "embedding")
    return search(index, queries, k, scratch, others_only=True)
