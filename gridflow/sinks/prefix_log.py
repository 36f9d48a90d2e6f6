"""The order log with running totals that can be changed in its middle: a late order or a corrected one rewrites its bucket and
the few tree nodes above it, and all totals behind it are right again.

Rows lie in buckets of consecutive numbers, with totals inside the bucket only. A tree holds the totals of buckets, of groups of
buckets, and so on; what precedes a bucket is the sum of its elder siblings on the way up, one small file a level. Buckets and nodes
are never changed: a write makes new ones along its paths and commits a new root in the manifest, so a reader sees the log
before it or after it. The nodes that a write makes lie beside each other in pack files of bounded size, as many buckets may mean
many nodes; a pack goes when the last of its nodes is replaced.
"""

import json
import uuid
from decimal import Context, Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..functions import average
from ..operators.orders import is_accepted, total_type
from ..operators.running import BUCKET_BITS
from .manifest import Manifest

#: Children of a node, as a power of two.
FAN_BITS = 8
#: Children in the nodes of one pack file, if it holds more than one node, and packs that are kept in memory.
PACK_CHILDREN, PACKS_KEPT = 1024, 16
#: Leaves up to which their offsets are broadcast.
BROADCAST_LEAVES = 100_000
MEASURES = ("orders", "rejects", "total")
#: Sums of prices are added with more digits than any of Spark's numbers has.
EXACT = Context(prec=100)
NOTHING = (0, 0, Decimal(0))


class ConcurrentWrite(RuntimeError):
    """Another writer committed first; nothing of this write counts."""


class PrefixLog:
    def __init__(self, spark, root, bits=BUCKET_BITS, fan=FAN_BITS):
        self.spark, self.root, self.bits, self.fan = spark, root, bits, fan
        self.manifest = Manifest(spark, root)
        self._pack, self._packs = None, {}

    # --- writing ---------------------------------------------------------------------------

    def write(self, resolved):
        """Insert resolved orders (see `resolve`), numbered from 0 on; a `seq` that is there already is replaced. Returns the buckets written.

        Only the buckets that the rows fall into are read and written; they are the one thing that reaches the driver.
        """
        name, root = self._root()
        touched = sorted(r[0] for r in resolved.select(self._bucket()).distinct().collect())
        if not touched:
            return []
        if touched[0] < 0:
            raise ValueError("numbers below zero")
        nodes = {}
        old = {b: child for b, child in ((b, self._leaf(root, b, nodes)) for b in touched) if child}
        rows = resolved.drop("_permanent").withColumn("_bucket", self._bucket())
        if old:
            kept = self._read([c["name"] for c in old.values()]).join(resolved.select("seq"), "seq", "left_anti")
            rows = rows.unionByName(kept.drop(*[f"_{m}" for m in MEASURES]).withColumn("_bucket", self._bucket()))
        inside = Window.partitionBy("_bucket").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        value = rows.schema["price_value"].dataType
        counted = {"orders": F.when(is_accepted(), 1).otherwise(0), "rejects": F.when(is_accepted(), 0).otherwise(1),
                   "total": F.when(is_accepted(), F.col("price_value")).otherwise(F.lit(0).cast(value))}
        rows = rows.withColumns({f"_{m}": F.sum(c).over(inside) for m, c in counted.items()})
        rows = rows.withColumn("_total", F.col("_total").cast(total_type(value)))
        folder = uuid.uuid4().hex
        rows.write.partitionBy("_bucket").parquet(f"{self.root}/rows/{folder}")
        written = self.spark.read.schema(T.StructType(rows.schema.fields)).parquet(f"{self.root}/rows/{folder}")
        ends = written.groupBy("_bucket").agg(
            F.max("_orders"), F.max("_rejects"), F.max_by("_total", "seq"), F.max("seq"), F.count(F.lit(1))).collect()
        leaves = {r[0]: {"name": f"{folder}/_bucket={r[0]}", "orders": r[1], "rejects": r[2], "total": str(r[3]),
                         "last": r[4], "rows": r[5]} for r in ends}
        garbage = [f"rows/{c['name']}" for c in old.values()]
        self._pack = None  # of a write that failed
        replaced, packs = [], dict(root.get("packs", {}) if root else {})
        fresh = self._grown(root, leaves, nodes, replaced, packs)
        for pack in (n.partition("#")[0] for n in replaced):
            packs[pack] = packs.get(pack, 1) - 1
            if not packs[pack]:
                garbage.append(f"nodes/{pack}.json")
                del packs[pack]
        fresh |= {"packs": packs}
        fresh |= {"schema": json.loads(T.StructType([f for f in rows.schema.fields if f.name != "_bucket"]).json()), "garbage": garbage}
        self._commit(name, fresh)
        return touched

    def _bucket(self):
        return F.shiftright(F.col("seq").cast("long"), self.bits).alias("_bucket")

    def _grown(self, root, leaves, nodes, replaced, packs):
        """The new root above the new leaves; its level grows until one node covers all buckets. Names the nodes that it replaced
        and counts the new ones of each pack."""
        level, top = (root["level"], root["top"]) if root else (0, None)
        changed, height = leaves, 0
        while True:
            known, below = {}, {}
            for i in sorted(changed):
                below.setdefault(i >> self.fan, {})[str(i)] = changed[i]
            for index, fresh in below.items():
                before = nodes.get((height, index)) if height <= level else None
                if before is None and root and height <= level:
                    before = self._node_at(root, height, index, nodes)
                children = dict(before["children"]) if before else {}
                children |= fresh
                if before:
                    replaced.append(before["name"])
                known[index] = self._make(height, index, children)
                pack = known[index]["name"].partition("#")[0]
                packs[pack] = packs.get(pack, 0) + 1
            covers = set(known) | ({int(top["index"])} if root and height == level else set())
            if height >= level and len(covers) == 1:
                self._store()
                return {"level": height, "top": known[next(iter(known))]}
            if root and height == level and int(top["index"]) not in known:
                known[int(top["index"])] = top  # the old tree becomes a part of the new one
            changed, height = known, height + 1

    def _make(self, level, index, children):
        """Put a node into the pack at hand and return what its parent keeps of it."""
        if self._pack and sum(len(n["children"]) for n in self._pack[1]) + len(children) > PACK_CHILDREN:
            self._store()
        pack, held = self._pack = self._pack or (uuid.uuid4().hex, [])
        held.append({"level": level, "children": children})
        name = f"{pack}#{len(held) - 1}"
        own = children.values()
        orders, rejects, total = _sums(own)
        return {"name": name, "index": index, "orders": orders, "rejects": rejects, "total": str(total),
                "last": max(c["last"] for c in own), "rows": sum(c["rows"] for c in own)}

    def _store(self):
        """Write the pack at hand; nothing names it before the root that is committed after it."""
        if self._pack:
            pack, held = self._pack
            storage.create_once(self.spark, f"{self.root}/nodes/{pack}.json", json.dumps(held))
        self._pack = None

    def _commit(self, old, root):
        name = f"root-{uuid.uuid4().hex}"
        storage.create_once(self.spark, f"{self.root}/nodes/{name}.json", json.dumps(root))
        if not self.manifest.replace(old, name):
            raise ConcurrentWrite(old)

    def sweep(self):
        """Delete what later writes replaced, once every named reader of the manifest has passed it."""
        names = [*self.manifest.state()["gone"], *self.manifest.live()]
        file = lambda name: f"{self.root}/nodes/{name}.json"
        # What a root replaced was in use until then, so it goes with the root before it.
        replaced = {old: json.loads(storage.read_file(self.spark, file(new)))["garbage"] for old, new in zip(names, names[1:])}
        done = self.manifest.sweep(file)
        for path in (path for old in done for path in replaced[old]):
            storage.remove(self.spark, f"{self.root}/{path}")
        return done

    # --- the tree --------------------------------------------------------------------------

    def _root(self):
        live = self.manifest.live()
        return (live[-1], json.loads(storage.read_file(self.spark, f"{self.root}/nodes/{live[-1]}.json"))) if live else (None, None)

    def _load(self, summary):
        pack, _, place = summary["name"].partition("#")
        held = self._packs.pop(pack, None) or json.loads(storage.read_file(self.spark, f"{self.root}/nodes/{pack}.json"))
        self._packs[pack] = held  # the last ones used stay; a pack never changes
        if len(self._packs) > PACKS_KEPT:
            del self._packs[next(iter(self._packs))]
        node = held[int(place)] if place else held  # without a place, a log from before there were packs
        return {**node, "name": summary["name"]}

    def _path(self, root, bucket, nodes):
        """(index of the child, node) on the way down to a bucket; ends early where nothing is stored."""
        summary = root["top"] if root and bucket >> (self.fan * (root["level"] + 1)) == root["top"]["index"] else None
        level = root["level"] if root else 0
        while summary:
            node = nodes.setdefault((level, summary["index"]), None) or self._load(summary)
            nodes[level, summary["index"]] = node
            child = bucket >> (self.fan * level)
            yield child, node
            summary = node["children"].get(str(child)) if level else None
            level -= 1

    def _leaf(self, root, bucket, nodes):
        found = list(self._path(root, bucket, nodes))
        return found[-1][1]["children"].get(str(bucket)) if found and found[-1][1]["level"] == 0 else None

    def _node_at(self, root, level, index, nodes):
        for _, node in self._path(root, index << (self.fan * (level + 1)), nodes):
            if node["level"] == level:
                return node
        return None

    def before(self, seq):
        """(orders, rejects, total) of all rows in earlier buckets than that of `seq`; reads one node a level."""
        _, root = self._root()
        bucket, sums = seq >> self.bits, NOTHING
        if root and bucket >> (self.fan * (root["level"] + 1)) > root["top"]["index"]:
            return _sums([root["top"]])
        for child, node in self._path(root, bucket, {}):
            own = _sums([c for i, c in node["children"].items() if int(i) < child])
            sums = _plus(sums, own)
        return sums

    def end(self):
        """The totals and the last number of the whole log, from its root alone."""
        _, root = self._root()
        if not root:
            return {"seq": None, "prior_orders": 0, "prior_rejects": 0, "prior_total": 0}
        orders, rejects, total = _sums([root["top"]])
        return {"seq": root["top"]["last"], "prior_orders": orders, "prior_rejects": rejects, "prior_total": total}

    # --- reading ---------------------------------------------------------------------------

    def _read(self, folders, schema=None):
        schema = schema or T.StructType.fromJson(self._root()[1]["schema"])
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/rows/{f}" for f in folders])

    def read(self, first=None, last=None):
        """The rows from number `first` to `last` with `total_orders`, `total_rejects`, `cumulative_price`, `running_avg`.

        Only the buckets of that stretch are read, and the nodes above them.
        """
        _, root = self._root()
        if not root:
            raise ValueError("an empty log has no columns")
        low = None if first is None else first >> self.bits
        high = None if last is None else last >> self.bits
        leaves = list(self._leaves(root["level"], self._load(root["top"]), low, high, NOTHING))
        schema = T.StructType.fromJson(root["schema"])
        rows = self._read([c["name"] for _, c, _ in leaves], schema) if leaves else self.spark.createDataFrame([], schema)
        kind = schema["_total"].dataType
        offsets = self.spark.createDataFrame(
            [(b, o, r, t if isinstance(kind, T.DecimalType) else float(t)) for b, _, (o, r, t) in leaves],
            T.StructType([T.StructField("_bucket", T.LongType()), T.StructField("_o", T.LongType()),
                          T.StructField("_r", T.LongType()), T.StructField("_t", kind)]))
        offsets = F.broadcast(offsets) if len(leaves) <= BROADCAST_LEAVES else offsets
        joined = rows.withColumn("_bucket", self._bucket()).join(offsets, "_bucket")
        if first is not None:
            joined = joined.where(F.col("seq") >= first)
        if last is not None:
            joined = joined.where(F.col("seq") <= last)
        out = joined.withColumns({"total_orders": F.col("_orders") + F.col("_o"), "total_rejects": F.col("_rejects") + F.col("_r"),
                                  "cumulative_price": (F.col("_total") + F.col("_t")).cast(kind)})
        out = out.withColumn("running_avg", average(F.col("cumulative_price"), F.col("total_orders")))
        return out.drop("_bucket", "_o", "_r", "_t", *[f"_{m}" for m in MEASURES])

    def _leaves(self, level, node, low, high, sums):
        """(bucket, leaf, totals before it) of the buckets from `low` to `high`."""
        for index, child in sorted((int(i), c) for i, c in node["children"].items()):
            shift = self.fan * level
            if high is not None and index > high >> shift:
                return
            if low is None or index >= low >> shift:
                if level:
                    yield from self._leaves(level - 1, self._load(child), low, high, sums)
                else:
                    yield index, child, sums
            sums = _plus(sums, _sums([child]))


def _plus(x, y):
    return x[0] + y[0], x[1] + y[1], EXACT.add(x[2], y[2])


def _sums(children):
    sums = NOTHING
    for child in children:
        sums = _plus(sums, (child["orders"], child["rejects"], Decimal(child["total"])))
    return sums
