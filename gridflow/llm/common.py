"""Written intermediate tables, bounded Arrow batches, and connected components."""

import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

from gridflow.session import run_dir
from gridflow.storage import remove

#: Rows of an Arrow batch sent to Python; texts may be long, so far fewer than Spark's default.
BATCH_ROWS = 512


def ready(spark, rows=BATCH_ROWS):
    """Make a session fit for the Python parts: batches so small that long texts fit in a worker, and the code there."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))
    context = spark.sparkContext
    if getattr(context, "_gridflow_shipped", None) is None:
        package = Path(__file__).resolve().parent.parent
        bundle = Path(tempfile.mkdtemp(prefix="gridflow-code-")) / "gridflow.zip"
        with zipfile.ZipFile(bundle, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(bundle))
        context._gridflow_shipped = bundle


#: Lets Spark delete a job's shuffle files as soon as the job has ended.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables below the shared folder, by which jobs cut their lineage and survive lost executors."""

    def __init__(self, spark, label):
        self.spark, self.folder, self.made = spark, run_dir(spark, label), 0

    def save(self, frame, name):
        """Write a frame and read it back; a name may be used again. What the job shuffled is deleted once it is written,
        rather than whenever the driver collects its garbage."""
        self.made += 1
        path = f"{self.folder}/{self.made:04d}-{name}"
        before = self.spark.conf.get(RELEASE, None)
        self.spark.conf.set(RELEASE, "true")
        try:
            frame.write.parquet(path)
        finally:
            self.spark.conf.unset(RELEASE) if before is None else self.spark.conf.set(RELEASE, before)
        table = self.spark.read.schema(frame.schema).parquet(path)
        table.scratch_path = path
        return table

    def drop(self, *tables):
        """Delete tables that no later step reads."""
        for table in tables:
            remove(self.spark, table.scratch_path)


def texts_of(frame, *columns):
    """The named columns, text with null as empty; clashing and extra columns are left behind."""
    return frame.select(*columns, F.coalesce("text", F.lit("")).alias("text"))


#: Ids up to which a set of them is broadcast; beyond, both sides are shuffled.
BROADCAST_IDS = 1_000_000


#: The column by which stages know rows apart.
ROW = "_row"


def with_rows(docs, scratch):
    """docs with a long `ROW` that no two rows share: the doc_id where all differ and none is null, else a number, for which
    the table is written once more, since a number given twice could differ."""
    doc_id = F.col("doc_id").cast("long")
    told = docs.select(doc_id.alias("doc_id")).agg(
        F.count("*").alias("rows"), F.count_distinct("doc_id").alias("ids"), F.min("doc_id").alias("low"),
        F.max("doc_id").alias("high")).first()
    if told["rows"] == told["ids"] and (told["low"] or 0) > -1 << 61 and (told["high"] or 0) < 1 << 61:
        return docs.withColumn(ROW, doc_id)
    return scratch.save(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def without(docs, gone):
    """docs, which `with_rows` gave, without the rows that `gone` (a written table with a column `row`) names, and without
    their `ROW`."""
    rows = gone.select(F.col("row").alias(ROW))
    if rows.count() <= BROADCAST_IDS:
        rows = F.broadcast(rows)
    return docs.join(rows, ROW, "left_anti").drop(ROW).select([c for c in docs.columns if c != ROW])


def rows_out(schema, columns):
    """A record batch of the given Arrow schema from a list of columns."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema)


def components(scratch, edges):
    """The connected components of links (a, b) between longs, as (node, component); component is the smallest node.

    Randomised contraction: in each round every node moves to whichever of itself and its neighbours has the smallest
    seeded hash, and links are mapped along. A round is a partially aggregated minimum and two joins that adaptive
    execution can split, so a node with very many links does not burden one task. The rounds needed grow with the
    logarithm of the longest path. Only the yes/no whether links are left reaches the driver.
    """
    both = edges.where("a <> b").select("a", "b")
    links = scratch.save(both.union(both.select("b", "a")).distinct(), "links")
    moves, turn = [], 0
    while not links.isEmpty():
        turn += 1
        rank = lambda c: F.xxhash64(F.lit(turn), c)
        best = links.groupBy("a").agg(F.min(F.struct(rank("b").alias("h"), F.col("b"))).alias("m"))
        move = scratch.save(best.select("a", F.when(F.col("m.h") < rank("a"), F.col("m.b")).otherwise(F.col("a"))
                                        .alias("to")), "move")
        left = links.join(move, "a").select(F.col("to").alias("x"), F.col("b").alias("y"))
        right = move.select(F.col("a").alias("y"), F.col("to").alias("z"))
        mapped = left.join(right, "y").where("x <> z").select(F.col("x").alias("a"), F.col("z").alias("b")).distinct()
        fresh = scratch.save(mapped, "links")
        scratch.drop(links)
        links = fresh
        moves.append(move)
    scratch.drop(links)
    if not moves:
        return scratch.spark.createDataFrame([], "node long, component long")
    at = moves[0].select(F.col("a").alias("node"), F.col("to").alias("root"))
    for move in moves[1:]:
        step = move.select(F.col("a").alias("root"), "to")
        at = at.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    at = scratch.save(at, "roots")
    scratch.drop(*moves)
    smallest = at.groupBy("root").agg(F.min("node").alias("component"))
    found = scratch.save(at.join(scratch.save(smallest, "smallest"), "root").select("node", "component"), "components")
    scratch.drop(at)
    return found
