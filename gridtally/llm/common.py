"""What several operators share: tables, checkpoints, words, connected components."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: A word is a run of anything but ASCII white space.
SPACE = "[\\x20\\x09-\\x0D]+"
WORD = re.compile("[^\x20\x09-\x0d]+")


#: Rows that Python workers get at a time, unless the session says otherwise: whole texts, so that Spark's default is too many.
ROWS_AT_A_TIME = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per session, so that their Python finds it without an installation.

    Where the session has Spark's default number of rows for a batch, it is lowered to ROWS_AT_A_TIME.
    """
    context = spark.sparkContext
    if spark.conf.get(_ROWS) == "10000":
        spark.conf.set(_ROWS, str(ROWS_AT_A_TIME))
    if not any("gridtally-code" in str(f) for f in context._python_includes):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="gridtally-"), "gridtally-code")
        context.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, or one below the warehouse, which is shared as well."""
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder and read back from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


#: Rows of a few short columns that are worth a partition of their own.
ROWS_OF_PARTITION = 20_000


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has at most ``rows`` rows, in no more partitions than these need.

    Tasks, files and what is logged of them then follow the rows, not the number of shuffle partitions.
    """
    return df.coalesce(max(1, -(-rows // ROWS_OF_PARTITION)))


def stored(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """``df`` as a Parquet table below the shared folder, which is compressed, unlike a checkpoint."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def id_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def contracted(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (a, b); a component is named by one of its nodes.

    Every node points to its least neighbour, and to where that points; nodes of one target become one, edges inside it go, and the
    rest is done again until no edge is left.  Names should be in random order (hashes): then each round leaves a part of the nodes
    however long the paths are.  Empty edges give no rows.
    """
    kind = edges.schema["a"].dataType
    way = lambda src, dst: F.struct(F.col(src).alias("src"), F.col(dst).alias("dst"))
    both = checkpoint(edges.select(F.inline(F.array(way("a", "b"), way("b", "a")))).where("src <> dst").distinct())
    rounds, sizes = [], []
    while n := both.count():  # every node stands in a row of its own at least, so that labels are no more
        sizes.append(n)
        both = gathered(both, n)
        nearest = checkpoint(gathered(both.groupBy("src").agg(F.min("dst").alias("low"))
                                      .select(F.col("src").alias("node"), F.least("src", "low").alias("near")), n))
        further = nearest.select(F.col("node").alias("near"), F.col("near").alias("component"))
        rounds.append(checkpoint(gathered(nearest.join(further, "near").select("node", "component"), n)))
        of = lambda side: rounds[-1].select(F.col("node").alias(side), F.col("component").alias(f"{side}_"))
        both = checkpoint(gathered(both.join(of("src"), "src").join(of("dst"), "dst").where("src_ <> dst_")
                                   .select(F.col("src_").alias("src"), F.col("dst_").alias("dst")).distinct(), n))
    if not rounds:
        return edges.sparkSession.createDataFrame([], StructType([StructField(c, kind) for c in ("node", "component")]))
    labels = rounds.pop()
    while rounds:
        above = labels.select(F.col("node").alias("component"), F.col("component").alias("above"))
        labels = rounds.pop().join(above, "component", "left").select("node", F.coalesce("above", "component").alias("component"))
    return checkpoint(gathered(labels, sizes[0]))


def further_contracted(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (node, component) after more ``edges`` (a, b), whose nodes may be new."""
    of = lambda side: labels.select(F.col("node").alias(side), F.col("component").alias(f"{side}_"))
    joining = contracted(edges.join(of("a"), "a", "left").join(of("b"), "b", "left")
                         .select(F.coalesce("a_", "a").alias("a"), F.coalesce("b_", "b").alias("b")))
    if joining.isEmpty():
        return labels
    above = joining.select(F.col("node").alias("component"), F.col("component").alias("above"))
    old = labels.join(above, "component", "left").select("node", F.coalesce("above", "component").alias("component"))
    return checkpoint(gathered(old.unionByName(joining.join(labels, "node", "left_anti")), labels.count() + joining.count()))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (a, b); a component is named by its least node.

    Labels fall to the least label next door, then to the label of the label,
    until nothing changes; the second step halves the way to the least node
    each time.  All steps are joins of plain exchanges, so that a node with very
    many links is split by the adaptive skew join.  Empty edges give no rows.
    """
    both = checkpoint(
        edges.select(F.col("a").alias("src"), F.col("b").alias("dst"))
        .union(edges.select(F.col("b").alias("src"), F.col("a").alias("dst")))
        .where("src <> dst").distinct())
    labels = checkpoint(both.groupBy("src").agg(F.min("dst").alias("low"))
                        .select(F.col("src").alias("node"), F.least("src", "low").alias("component")))
    while True:
        beside = (both.join(labels.withColumnRenamed("node", "dst"), "dst")
                  .groupBy("src").agg(F.min("component").alias("low"))
                  .withColumnRenamed("src", "node"))
        lower = checkpoint(labels.join(beside, "node").select(
            "node", F.least("component", "low").alias("component"),
            (F.col("low") < F.col("component")).alias("moved")))
        jump = lower.select(F.col("node").alias("component"), F.col("component").alias("further"))
        after = checkpoint(lower.join(jump, "component").select("node", F.col("further").alias("component"), (
            F.col("moved") | (F.col("further") < F.col("component"))).alias("moved")))
        labels = after.select("node", "component")
        if after.where("moved").isEmpty():
            return labels
