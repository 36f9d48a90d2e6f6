"""Near-duplicate vectors by NN-descent: a neighbour graph is refined through neighbours of neighbours, lists that are full of
links are enlarged to their whole component, recall is audited, and the links above the threshold stay. Where the audit is
never content, all vectors are compared."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from .common import Scratch, components, ready

#: Neighbours kept of each vector, random projections that start the graph, and rounds of refinement.
NEIGHBOURS, PROJECTIONS, ROUNDS = 8, 8, 2
#: Vectors that a task compares with each other at once: in a start bucket, in a list, in a block of a component.
BUCKET, LIST, BLOCK = 48, 32, 192
#: Vectors without, with few and with more links found whose links are counted by brute force, and the recall asked for.
AUDITED, LEAST_RECALL = {"none": 1024, "few": 512, "many": 512}, 0.97
#: How often a small table's search may be widened; bytes and vectors that a pass of the comparison of all holds at once.
WIDENINGS, PASS_BYTES, PASS_VECTORS = 3, 8 << 20, 16_384
BITS = 24
#: Sums of labels' vectors that a task holds.
SUMS = 2048
EDGES = "a long, b long, sim double"


def unit(column):
    """The vectors of an Arrow list column as rows of unit length in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nodes_of(vectors, scratch):
    """(all rows, nodes): a node stands for all equal vectors of a label; id is the first row's number.

    Rows without a label, and vectors that are null, empty, zero, or hold a null or non-finite component, are no nodes.
    """
    rows = scratch.save(vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "embedding"), "rows")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    good = rows.where(F.coalesce(usable, F.lit(False)))
    nodes = good.groupBy("label", "embedding").agg(F.min("row").alias("id"), F.count("*").alias("copies"))
    nodes = nodes.withColumn("dim", F.size("embedding"))
    return rows, good, scratch.save(nodes, "nodes")


def best_edges(ids, sims, most, floors=None):
    """For each row, its `most` best others, those above its floor only."""
    np.fill_diagonal(sims, -2)
    take = min(most, len(ids) - 1)
    if take < 1:
        return [], [], []
    top = np.argpartition(-sims, take - 1, axis=1)[:, :take]
    a = np.repeat(ids, take)
    sim = np.take_along_axis(sims, top, 1).ravel()
    good = sim > -2 if floors is None else sim > np.repeat(floors, take)
    return a[good], ids[top.ravel()][good], sim[good]


def local_join(blocks, most):
    """Compare all vectors of each block (members: id, embedding, floor) and emit each one's best edges."""

    def joined(batches):
        for batch in batches:
            out = [[], [], []]
            members = batch["members"]
            for i in range(len(batch)):
                own = members[i].values
                ids = own.field("id").to_numpy(zero_copy_only=False)
                x = unit(own.field("embedding"))
                floors = own.field("floor").to_numpy(zero_copy_only=False)
                for column, found in zip(out, best_edges(ids, x @ x.T, most, floors)):
                    column.append(found)
            columns = [np.concatenate(c) if c else np.zeros(0) for c in out]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0].astype(np.int64)), pa.array(columns[1].astype(np.int64)),
                                              pa.array(columns[2].astype(np.float64))], names=["a", "b", "sim"])

    return blocks.select("members").mapInArrow(joined, EDGES)


def dealt(rows, keys, most, by):
    """Rows with a part number, so that no (keys, part) has many more than `most` rows, however hot the keys are."""
    sizes = rows.groupBy(*keys).count().withColumn("parts", F.ceil(F.col("count") / most)).drop("count")
    return rows.join(sizes, keys).withColumn("part", F.pmod(F.xxhash64(*by), F.col("parts")))


def start_stats(nodes, scratch):
    """(label, dim, center, bits): the mean of a label's unit vectors, and the bits of its buckets, as many as leave about
    `BUCKET` vectors in each."""
    kind = nodes.schema["label"].dataType

    def summed(batches):
        sums, types = {}, None

        def told():
            keys = list(sums)
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], types), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([sums[k] for k in keys], pa.list_(pa.float64()))], names=["label", "dim", "total"])

        for batch in batches:
            types, groups = batch["label"].type, {}
            for i, key in enumerate(zip(batch["label"].to_pylist(), batch["dim"].to_pylist())):
                groups.setdefault(key, []).append(i)
            for key, at in groups.items():
                sums[key] = sums.get(key, 0) + unit(batch["embedding"].take(pa.array(at))).sum(0)
            if len(sums) > SUMS:
                yield told()
                sums.clear()
        if sums:
            yield told()

    schema = StructType([StructField("label", kind), StructField("dim", IntegerType()),
                         StructField("total", ArrayType(DoubleType()))])
    totals = nodes.select("label", "dim", "embedding").mapInArrow(summed, schema)
    totals = totals.select("label", "dim", F.posexplode("total").alias("pos", "x")).groupBy("label", "dim", "pos").agg(
        F.sum("x").alias("x"))
    sizes = nodes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    centers = totals.groupBy("label", "dim").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("xs"))
    bits = F.least(F.lit(BITS), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / BUCKET)))).cast("int")
    return scratch.save(centers.join(sizes, ["label", "dim"]).select(
        "label", "dim", F.transform("xs", lambda e: e["x"] / F.col("n")).alias("center"), bits.alias("bits")), "stats")


def start_edges(nodes, stats, seed, scratch):
    """Edges among vectors that random projections put on the same sides of their label's mean, which would else put
    vectors with much in common on one side altogether."""

    def coded(batches):
        for batch in batches:
            x_of, center_of = batch["embedding"], batch["center"]
            dims = np.array([len(v) for v in x_of])
            codes = np.zeros((len(batch), PROJECTIONS), np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                own = pa.array(at)
                x = unit(x_of.take(own)) - center_of.take(own).flatten().to_numpy().reshape(len(at), -1)
                planes = np.random.default_rng([seed, dim]).normal(size=(dim, PROJECTIONS * BITS))
                bits = (x @ planes > 0).reshape(len(at), PROJECTIONS, BITS)
                codes[at] = bits @ (1 << np.arange(BITS)[::-1])
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(list(codes), pa.list_(pa.int64()))], names=["id", "codes"])

    told = nodes.join(stats.select("label", "dim", "center"), ["label", "dim"])
    codes = scratch.save(told.select("id", "embedding", "center").mapInArrow(coded, "id long, codes array<long>"), "codes")
    bits = stats.select("label", "dim", "bits")
    placed = nodes.select("id", "label", "dim").join(bits, ["label", "dim"]).join(codes, "id")
    placed = placed.select("id", "label", "dim", "bits", F.posexplode("codes").alias("projection", "code"))
    placed = placed.withColumn("code", F.expr(f"code div cast(pow(2, {BITS} - bits) as long)"))
    keys = ["label", "dim", "projection", "code"]
    placed = scratch.save(placed.select("id", *keys), "placed")
    placed = dealt(placed, keys, BUCKET, ["id", "projection"])
    full = placed.join(nodes.select("id", "embedding"), "id")
    blocks = full.groupBy(*keys, "part").agg(F.collect_list(F.struct("id", "embedding", F.lit(-2.0).alias("floor")))
                                             .alias("members"))
    return local_join(blocks, NEIGHBOURS)


def best_lists(edges, most):
    """The best distinct neighbours of each vector: (a, found), found sorted by falling similarity."""
    found = F.sort_array(F.collect_set(F.struct("sim", "b")), asc=False)
    return edges.groupBy("a").agg(F.slice(found, 1, most).alias("found"))


def refine(nodes, graph, scratch):
    """One round: the neighbours of each vector, in both directions, are compared with each other."""
    forward = graph.select("a", F.explode("found").alias("e")).select("a", F.col("e.b").alias("b"))
    both = scratch.save(forward.union(forward.select("b", "a")).distinct(), "both")
    floors = graph.select(F.col("a").alias("id"), F.when(F.size("found") >= NEIGHBOURS, F.col("found")[F.size("found") - 1]["sim"])
                          .otherwise(F.lit(-2.0)).alias("floor"))
    known = nodes.select("id", "embedding").join(floors, "id")
    lists = dealt(both, ["a"], LIST, ["b"]).join(known, F.col("b") == F.col("id"))
    blocks = lists.groupBy("a", "part").agg(F.collect_list(F.struct("id", "embedding", "floor")).alias("members"))
    old = graph.select("a", F.explode("found").alias("e")).select("a", F.col("e.b").alias("b"), F.col("e.sim").alias("sim"))
    merged = local_join(blocks, NEIGHBOURS).union(old)
    return scratch.save(best_lists(merged, NEIGHBOURS), "graph")


def component_links(nodes, grouped, threshold):
    """Links of each vector inside its component, all of them: the component's vectors are cut into blocks, and each pair
    of blocks is compared in one task. This is what full lists are enlarged to; only counts leave a task."""
    sizes = grouped.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    member = grouped.withColumnRenamed("node", "id").join(sizes, "component").join(
        nodes.select("id", "embedding", "copies"), "id")
    member = member.withColumn("own", F.pmod(F.xxhash64("id"), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    paired = member.select("component", "id", "embedding", "copies", "own", other.alias("other"))
    pairs = paired.groupBy("component", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")).agg(
        F.collect_list(F.struct("id", "embedding", "copies", "own")).alias("members"))

    def counted(batches):
        for batch in batches:
            ids, sums = [], []
            for x, y, own in zip(batch["x"].to_pylist(), batch["y"].to_pylist(), batch["members"]):
                own = own.values
                side = own.field("own").to_numpy(zero_copy_only=False)
                copies = own.field("copies").to_numpy(zero_copy_only=False)
                number = own.field("id").to_numpy(zero_copy_only=False)
                vectors = unit(own.field("embedding"))
                near = (vectors @ vectors.T >= threshold) & (number[:, None] != number[None, :])
                if x != y:
                    near &= side[:, None] != side[None, :]
                ids.append(number)
                sums.append(near @ copies)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int64), pa.int64()),
                                              pa.array(np.concatenate(sums) if sums else np.zeros(0, np.int64), pa.int64())],
                                             names=["id", "links"])

    links = pairs.select("x", "y", "members").mapInArrow(counted, "id long, links long")
    return links.groupBy("id").agg(F.sum("links").alias("links"))


def by_label(rows, *more):
    """The vectors of rows, by (label, dim): a list of their ids (and of each of `more`), and the unit vectors."""
    groups = {}
    for row in rows:
        groups.setdefault((row["label"], row["dim"]), []).append(row)
    return {key: (*([r[c] for r in own] for c in ("id", *more)), unit(pa.array([r["embedding"] for r in own])))
            for key, own in groups.items()}


def met(batch, asked):
    """Those of the groups of `asked` that a batch has vectors of: (group, where they are in the batch, cosines)."""
    groups = {}
    for i, key in enumerate(zip(batch["label"].to_pylist(), batch["dim"].to_pylist())):
        if key in asked:
            groups.setdefault(key, []).append(i)
    for key, at in groups.items():
        at = pa.array(at)
        yield asked[key], at, asked[key][-1] @ unit(batch["embedding"].take(at)).T


def audit(nodes, links, threshold, scratch):
    """The mean share of its links that was found of a node that has any; the lower one of those of nodes with up to
    `NEIGHBOURS` distinct links and of those with more, so that large groups do not hide what small ones lost.

    At most `AUDITED` nodes of each kind (with no, few and more links found), the first by a hash, are compared with all
    others by brute force, and stand for their kind.
    """
    kind = F.when(F.coalesce("links", F.lit(0)) == 0, "none").when(F.col("links") <= NEIGHBOURS, "few").otherwise("many")
    kinds = scratch.save(nodes.select("id").join(links, "id", "left").select(
        "id", F.coalesce("links", F.lit(0)).alias("links"), kind.alias("kind")), "kinds")
    sizes = {r["kind"]: r["count"] for r in kinds.groupBy("kind").count().collect()}
    ids = {}
    for name in sizes:
        drawn = kinds.where(F.col("kind") == name).orderBy(F.xxhash64("id"), "id").limit(AUDITED[name]).collect()
        ids |= {r["id"]: (r["links"], sizes[name] / len(drawn)) for r in drawn}
    chosen = nodes.sparkSession.createDataFrame([(i,) for i in ids], "id long")
    asked = by_label(nodes.join(F.broadcast(chosen), "id", "left_semi").collect())

    def counted(batches):
        sums = {}
        for batch in batches:
            for (names, _), at, cosines in met(batch, asked):
                ids = batch["id"].take(at).to_numpy()
                near = (cosines >= threshold) & (np.array(names)[:, None] != ids[None, :])
                copies = batch["copies"].take(at).to_numpy()
                for name, n, distinct in zip(names, (near @ copies).tolist(), near.sum(1).tolist()):
                    if distinct:
                        before = sums.get(name, (0, 0))
                        sums[name] = before[0] + n, before[1] + distinct
        actual, distinct = ([s[i] for s in sums.values()] for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (list(sums), actual, distinct)],
                                         names=["id", "actual", "others"])

    true = nodes.select("id", "label", "dim", "embedding", "copies").mapInArrow(counted, "id long, actual long, others long")
    true = true.groupBy("id").agg(F.sum("actual").alias("actual"), F.sum("others").alias("others")).collect()
    shares = []
    for chosen in ([r for r in true if r["others"] <= NEIGHBOURS], [r for r in true if r["others"] > NEIGHBOURS]):
        weights = [ids[r["id"]][1] for r in chosen]
        found = [min(ids[r["id"]][0] / r["actual"], 1) for r in chosen]
        shares.append(float(np.average(found, weights=weights)) if chosen else 1.0)
    return min(shares)


def lost_links(nodes, grouped, threshold, passes, scratch):
    """Links (a, b) between components, named by them, that joining all vectors with all others finds: in each pass, a
    part of the vectors is sent to all tasks. Links inside components are counted anyway and left out."""
    part = F.pmod(F.xxhash64("id"), F.lit(passes))
    told = scratch.save(nodes.join(grouped.withColumnRenamed("node", "id"), "id", "left").select(
        "id", "label", "dim", "embedding", F.coalesce("component", "id").alias("component"), part.alias("part")), "told")
    context, found = nodes.sparkSession.sparkContext, []
    for number in range(passes):
        asked = context.broadcast(by_label(told.where(F.col("part") == number).collect(), "component"))

        def crossing(batches, asked=asked):
            for batch in batches:
                pairs = [np.zeros((0, 2), np.int64)]
                for (_, own, _), at, cosines in met(batch, asked.value):
                    own, other = np.array(own), batch["component"].take(at).to_numpy()
                    x, y = np.nonzero(cosines >= threshold)
                    x, y = own[x], other[y]
                    pairs.append(np.column_stack([x, y])[x < y])
                pairs = np.unique(np.concatenate(pairs), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        links = told.select("label", "dim", "embedding", "component").mapInArrow(crossing, "a long, b long")
        found.append(scratch.save(links.distinct(), "lost"))
        asked.destroy()
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return links


def near_vectors(vectors, threshold=0.93, scratch=None):
    """Links of vectors with equal labels and a cosine of at least the threshold: (vec_id, n_links, component_id, kept).

    One row per row of vectors. component_id is the smallest vec_id reachable by links. Vectors that are null, empty,
    zero, or have a null or non-finite component or no label link with nothing; vectors of different lengths do not link;
    repeated and null vec_ids keep their own rows (a null one is never a component's name unless all are null); other
    columns are ignored; an empty table gives no rows.

    Equal vectors are one node. The graph starts from random projections, whose hot buckets are cut into parts, and is
    refined twice. Hubs' lists are cut the same way. Where lists are full of links, and wherever links exist at all, all
    pairs inside a component are counted in blocks. The audit widens the start, with further projections, until recall is
    reached. Where that takes more widenings than a comparison of all vectors takes passes, that is made, and nothing is
    lost. Returns the rows and the audited recall (1 after a comparison of all).
    """
    ready(vectors.sparkSession)
    scratch = scratch or Scratch(vectors.sparkSession, "vectors")
    rows, good, nodes = nodes_of(vectors, scratch)
    stats = start_stats(nodes, scratch)
    size = nodes.agg(F.count("*").alias("n"), F.coalesce(F.sum("dim"), F.lit(0)).alias("numbers")).first()
    passes = max(1, -(-size["n"] // PASS_VECTORS), -(-8 * size["numbers"] // PASS_BYTES))
    graph, recall = None, 0.0
    for seed in range(max(WIDENINGS, passes)):
        edges = start_edges(nodes, stats, seed, scratch)
        if graph is not None:
            edges = edges.union(graph.select("a", F.explode("found").alias("e")).select(
                "a", F.col("e.b").alias("b"), F.col("e.sim").alias("sim")))
        graph = scratch.save(best_lists(edges, NEIGHBOURS), "graph")
        for _ in range(ROUNDS):
            graph = refine(nodes, graph, scratch)
        links = graph.select("a", F.explode("found").alias("e")).where(F.col("e.sim") >= threshold)
        links = links.select("a", F.col("e.b").alias("b"))
        grouped = components(scratch, links)
        counts = scratch.save(component_links(nodes, grouped, threshold), "counts")
        recall = audit(nodes, counts, threshold, scratch)
        if recall >= LEAST_RECALL:
            break
    else:
        grouped = components(scratch, links.union(lost_links(nodes, grouped, threshold, passes, scratch)))
        counts, recall = scratch.save(component_links(nodes, grouped, threshold), "counts"), 1.0

    ids = scratch.save(nodes.join(counts, "id", "left").join(grouped.withColumnRenamed("node", "id"), "id", "left").select(
        "label", "embedding", "id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "id").alias("root")).where("n_links > 0"), "ids")
    linked = good.join(ids, ["label", "embedding"]).select("row", "n_links", "root")
    all_rows = rows.select("row", "vec_id").join(scratch.save(linked, "linked"), "row", "left").select(
        "row", "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "row").alias("root"))
    all_rows = scratch.save(all_rows, "all")
    groups = all_rows.where("n_links > 0").groupBy("root").agg(F.min("vec_id").alias("component_id"))
    out = all_rows.join(scratch.save(groups, "groups"), "root", "left").select(
        "vec_id", F.col("n_links").cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))), recall
