"""Merkle manifest of a dataset: a tree per source, and a tree over the sources.

A row is a leaf.  Leaves are numbered per source by a range partition, whose partitions are counted; the number of a row
is its place in the partition plus what stands in the partitions before, so that no source meets in one task.  On every level the
slot-zero nodes name the places of their siblings (slot offsets; for two children the place with its last bit flipped), one
equijoin by place finds them, and the slot-zero row, which now holds the whole run, emits the parent.  Going down again, each run
hands its members the digests left and right of them and the path of the run, which is the inclusion proof of a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.common import checkpoint

ARITY = 16
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The letters that tampering changes.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A field as it enters the leaf: ``-`` for null, or its number of UTF-8 bytes, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """Digest of a row's fields, some of them replaced."""
    return digest(*[field(changed.get(name, F.col(name))) for name in FIELDS])


def _joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def numbered(rows: DataFrame, tree: str, order: list[str], partitions: int | None = None) -> DataFrame:
    """``rows`` with ``idx``, the place in their tree from 0, and ``n``, the tree's number of rows; equal rows in any order.

    ``rows`` must give the same rows each time (read them from a checkpoint).  The sorted rows are written once; then one
    row per partition and tree is counted, however large a tree is.
    """
    keys = [tree, *order, "_tie"]
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = checkpoint(
        rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id()).drop("_tie"))
    part = F.shiftright("_at", 33).alias("_part")  # where the id holds the number of its partition
    runs = placed.groupBy(part, tree).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    # A row per partition that a tree reaches into, however many rows it has there.
    of_tree = Window.partitionBy(tree)
    before = F.sum("_rows").over(of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    bases = runs.select(tree, F.col("_part").alias("_of"), F.sum("_rows").over(of_tree).alias("n"),
                        (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_base"))
    own = placed.withColumn("_of", F.shiftright("_at", 33))
    return own.join(bases, [tree, "_of"]).withColumn("idx", F.col("_at") + F.col("_base")).drop("_at", "_of", "_base")


def level(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """The runs of one level of nodes (tree, idx, n, member): (tree, idx of the parent, n of the level above, members).

    ``member`` is a struct whose field ``digest`` counts; ``members`` are those of a run in order.
    """
    zero = nodes.where(F.col("idx") % arity == 0)
    first = F.col("idx").alias("_run")
    if arity == 2:
        places = F.array(F.col("idx"), F.col("idx").bitwiseXOR(F.lit(1)))
    else:
        places = F.sequence(F.col("idx"), F.least(F.col("idx") + (arity - 1), F.col("n") - 1))
    wanted = zero.select("tree", first, F.explode(places).alias("idx"))
    found = wanted.join(nodes, ["tree", "idx"])
    return (
        found.groupBy("tree", F.floor(F.col("_run") / arity).alias("idx"))
        .agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("idx", "member"))).alias("members"))
        .select("tree", "idx", F.ceil(F.col("n") / arity).alias("n"), F.col("members.member").alias("members"))
    )


def _parents(runs: DataFrame) -> DataFrame:
    up = F.struct(digest(_joined(F.col("members.digest"))).alias("digest"))
    return runs.select("tree", "idx", "n", up.alias("member"))


def grown(nodes: DataFrame, arity: int = ARITY) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level, lowest first, and (tree, digest) of each tree's last node.

    A tree of one node has no run.  The number of levels is the logarithm of the largest tree; the rows of a level are
    written before the next one, a level above has a sixteenth of them.
    """
    levels, tops = [], nodes.where("n = 1").select("tree", F.col("member.digest").alias("digest"))
    going = nodes.where("n > 1")
    while True:
        runs = checkpoint(level(going, arity))
        if runs.isEmpty():
            return levels, tops
        levels.append(runs)
        parents = _parents(runs)
        tops = tops.unionByName(parents.where("n = 1").select("tree", F.col("member.digest").alias("digest")))
        going = parents.where("n > 1")


def with_paths(nodes: DataFrame, levels: list[DataFrame], tops: DataFrame, arity: int = ARITY) -> DataFrame:
    """(tree, idx, member, path, ...) of all lowest nodes; ``path`` has the digests left and right on each level, lowest first.

    ``tops`` has (tree, path, ...): the path that goes on above each tree's last node, and what else all of the tree's nodes
    get.  It is joined where the tree has one row and handed down from there, so that a large tree is no hot key.
    """
    kept = [c for c in tops.columns if c not in ("tree", "path")]
    lone = nodes.where("n = 1").join(tops, "tree").select("tree", "idx", "member", "path", *kept)
    above = None
    for runs in reversed(levels):
        known = runs.where("n = 1").join(tops, "tree").select("tree", "idx", "members", "path", *kept)
        if above is not None:
            below = runs.where("n > 1").join(above.drop("member"), ["tree", "idx"])
            known = known.unionByName(below.select("tree", "idx", "members", "path", *kept))
        each = known.withColumnRenamed("idx", "_run").select("*", F.posexplode("members").alias("_slot", "member"))
        digests = F.col("members.digest")
        step = F.struct(_joined(F.slice(digests, F.lit(1), F.col("_slot"))).alias("left"),
                        _joined(F.slice(digests, F.col("_slot") + 2, F.lit(arity))).alias("right"))
        above = each.select("tree", (F.col("_run") * arity + F.col("_slot")).alias("idx"), "member",
                            F.concat(F.array(step), "path").alias("path"), *kept)
    return lone if above is None else lone.unionByName(above)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, start, lambda acc, step: digest(step["left"], acc, step["right"]))


def manifest(docs: DataFrame, tampered: Column | None = None, arity: int = ARITY, partitions: int | None = None) -> DataFrame:
    """One row per document: (doc_id, leaf, subroot, root, path, folded_root, verified).

    ``tampered`` is a boolean column that names rows whose text is lower-cased (A-Z) before it is checked against the
    manifest; the digests themselves are always of the rows as they are.  ``path`` are the digests left and right of the
    row's own on each level; ``folded_root`` is what the checked row and that path give.

    Leaves of a source ascend by doc_id (null first, rows of one id by their digest).  A null source is a source of its own,
    before all others; sources ascend bytewise.  Null and empty texts are leaves like others and differ.  Repeated rows are
    leaves each.  An empty table gives no row.  Columns beyond the five fields are not read.
    """
    checked = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    now = leaf(text=F.translate(F.col("text"), UPPER, LOWER))
    leaves = checkpoint(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),
        leaf().alias("digest"), F.when(checked, now).alias("now")))
    placed = numbered(leaves, "tree", ["doc_id", "digest"], partitions)
    nodes = checkpoint(placed.select("tree", "idx", "n", F.struct("digest", "doc_id", "now").alias("member")))
    levels, subroots = grown(nodes, arity)
    sources = checkpoint(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"))
    tops = checkpoint(numbered(sources, "tree", ["name"], partitions)
                      .select("tree", "idx", "n", F.struct("digest", "name").alias("member")))
    top_levels, root = grown(tops, arity)
    end = tops.where("idx = 0").select("tree", F.expr(f"CAST(array() AS {_PATH})").alias("path"))
    of_sources = with_paths(tops, top_levels, end, arity).select(
        F.col("member.name").alias("tree"), F.col("member.digest").alias("subroot"), "path")
    rows = with_paths(nodes, levels, checkpoint(of_sources), arity).select(
        F.col("member.doc_id").alias("doc_id"), F.col("member.digest").alias("leaf"), "subroot",
        F.coalesce("member.now", "member.digest").alias("_checked"), "path")
    # One row at most, read as a scalar subquery: neither joined nor collected.
    rows = rows.withColumn("root", root.select("digest").scalar()).withColumn("folded_root", folded(F.col("_checked"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", "path", "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


def proof_digest(path: Column) -> Column:
    """Digest of a path's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)
