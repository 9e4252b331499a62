"""Near duplicates by order MinHash.

A sketch keeps the few least of a text's occurrence-labelled k-mers in the order
of the text, so that equal sketches tell of common words in a common order.
Texts that share one of several sketches are aligned within a band, and those
similar enough are linked.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import checkpoint, contracted, fresh, further_contracted, gathered, ship, text_or_empty
from gridtally.llm.wordhash import Words, batches, mix, numbers, runs

#: Words of a k-mer, k-mers of a sketch, sketches of a document.
K, LENGTH, SKETCHES = 5, 3, 20
#: Smallest hashes looked at for a sketch, on average; a document with fewer than LENGTH of them is looked at whole.
EXPECTED = 24
#: Bytes of texts hashed at a time; some 30 times as many are held meanwhile.
BATCH = 1 << 19


def labelled(words: Words, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): occurrence-labelled k-mers of all texts in text order, ``first`` as in Words.

    The n-th occurrence of a k-mer in a text differs from the others.  A text of fewer than k words is one k-mer.
    """
    n = words.counts()
    shorter = (n > 0) & (n < k)
    count = np.where(shorter, 1, np.maximum(n - k + 1, 0))
    first = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(n)), count)
    at = np.arange(first[-1]) - first[doc] + words.first[doc]
    h = np.zeros(len(at), dtype=np.uint64)
    whole = ~shorter[doc]
    h[whole] = words.windows(at[whole], k)
    for d in np.flatnonzero(shorter):
        h[first[d]] = words.windows(words.first[d:d + 1], int(n[d]))[0]
    order = np.lexsort((np.arange(len(h)), h, doc))
    key = h[order] ^ mix(doc[order].astype(np.uint64))
    begin, length = runs(key)
    label = np.empty(len(h), dtype=np.uint64)
    label[order] = np.arange(len(h)) - np.repeat(begin, length)
    return mix(h + label * np.uint64(0x9E3779B97F4A7C15)), first


def sketches(h: np.ndarray, first: np.ndarray, length: int = LENGTH, number: int = SKETCHES) -> np.ndarray:
    """A row of ``number`` keys per text: each of the ``length`` k-mers with the least hashes, in text order."""
    n = np.diff(first)
    texts = np.flatnonzero(n)
    out = np.zeros((len(n), number), dtype=np.uint64)
    most = np.uint64(2**64 - 1)
    limit = np.where(n > EXPECTED, (2.0**64 * EXPECTED / np.maximum(n, 1)).clip(max=2.0**63.99), 0).astype(np.uint64)
    limit[n <= EXPECTED] = most
    limits = np.repeat(limit, n)
    doc = np.repeat(np.arange(len(n)), n)
    want = np.minimum(n, length)
    for m, c in enumerate(numbers(number, 23)):
        x = h * c
        near = np.flatnonzero(x <= limits)
        few = texts[np.bincount(doc[near], minlength=len(n))[texts] < want[texts]]
        if len(few):
            near = np.sort(np.concatenate([near[~np.isin(doc[near], few)], *[np.arange(first[d], first[d + 1]) for d in few]]))
        order = near[np.lexsort((x[near], doc[near]))]
        begin, count = runs(doc[order])
        rank = np.arange(len(order)) - np.repeat(begin, count)
        least = np.sort(order[rank < length])  # in text order again
        begin, count = runs(doc[least])
        place = (np.arange(len(least)) - np.repeat(begin, count)).astype(np.int64)
        out[texts, m] = mix(np.add.reduceat(h[least] * numbers(length, 29)[place], begin) + np.uint64(m)) if len(begin) else 0
    return out


def text_keys(words: Words) -> list[bytes]:
    """128 bits per text; texts with the same words in the same order share them."""
    n = words.counts()
    place = np.arange(len(words.hashes)) - np.repeat(words.first[:-1], n)
    out = np.zeros((len(n), 2), dtype=np.uint64)
    some = np.flatnonzero(n)
    for k, seed in enumerate((31, 37)):
        factors = mix((place.astype(np.uint64) + np.uint64(1)) * numbers(1, seed)[0]) | np.uint64(1)
        if len(some):
            out[some, k] = mix(np.add.reduceat(words.hashes * factors, words.first[:-1][some]))
    return [row.tobytes() for row in out]


#: Buckets of a text in which it is compared with the least one before anything else.
FIRST_BUCKETS = 3
#: Rows of blocks, of about 1.5 KB, that one task holds at a time.
ROWS_OF_BLOCKS = 20_000
#: Stands for a null doc_id where rows are matched.
NO_ID = 2**63 - 1
#: Bins of a profile, the sketch by which pairs are weighed before their texts are fetched.
PROFILE_BITS = 10
PROFILE = 1 << PROFILE_BITS


def profile(h: np.ndarray) -> bytes:
    """A byte of the least hash in each of PROFILE ranges of hashes; 0 where a range is empty.

    Of the ranges that are not empty in both, the share of equal bytes estimates the Jaccard similarity.  Few k-mers
    hardly ever share a range, so that short texts are compared almost exactly.
    """
    out = np.zeros(PROFILE, dtype=np.uint8)
    ordered = np.sort(h)
    place = ordered >> np.uint64(64 - PROFILE_BITS)
    first, _ = runs(place)
    out[place[first].astype(np.int64)] = 1 + (mix(ordered[first]) % np.uint64(255)).astype(np.uint8)
    return out.tobytes()


def similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """Aligned k-mers over all k-mers of both texts, or a number below ``least`` where it can't reach that.

    The alignment is the longest chain of equal occurrence-labelled k-mers in the order of both texts.  Only pairs
    in a band about the diagonal count: a chain long enough leaves no room for a larger shift.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    total = len(a) + len(b)
    order = np.argsort(a, kind="stable")
    spot = np.minimum(np.searchsorted(a, b, sorter=order), len(a) - 1)
    in_a = order[spot]
    in_b = np.flatnonzero(a[in_a] == b)
    in_a = in_a[in_b]
    need = int(np.ceil(least / (1 + least) * total - 1e-9))
    if len(in_a) < need:
        return len(in_a) / (total - len(in_a))
    inside = np.abs(in_a - in_b) <= total - 2 * need
    chain: list[int] = []
    rising = in_a[inside]
    if (np.diff(rising) > 0).all():
        length = len(rising)
    else:
        for x in rising.tolist():
            at = bisect_left(chain, x)
            chain[at:at + 1] = [x]
        length = len(chain)
    return length / (total - length)


@dataclass(frozen=True)
class Near:
    """``similarity`` links two texts; ``margin`` is how far below it a profile may lie and the pair is still verified.

    The standard error of a profile is 0.0125 at 0.8 and less for short texts, so that a margin of 0.05 is four of them.
    Buckets of more than ``block`` texts are compared block by block.
    """

    similarity: float = 0.8
    margin: float = 0.05
    block: int = 1024


def _sketch(frames: Iterator) -> Iterator:
    for f in frames:
        texts = [t.encode().lower() for t in f["text"]]
        for s in batches([len(t) for t in texts], BATCH):
            words = Words(texts[s])
            h, first = labelled(words)
            keys = sketches(h, first).view(np.int64)
            yield pd.DataFrame({"doc_id": f["doc_id"].iloc[s], "text_hash": f["text_hash"].iloc[s], "node": text_keys(words),
                                "keys": list(keys), "n": np.diff(first)})


def _pack(frames: Iterator) -> Iterator:
    """Compressed words and a profile of each text."""
    for f in frames:
        texts = [t.encode().lower() for t in f["text"]]
        for s in batches([len(t) for t in texts], BATCH):
            h, first = labelled(Words(texts[s]))
            yield pd.DataFrame({"node": f["node"].iloc[s], "keys": f["keys"].iloc[s], "packed": [zlib.compress(t, 1) for t in texts[s]],
                                "profile": [profile(h[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]})


def _verify(least: float):
    def run(frames: Iterator) -> Iterator:
        for f in frames:
            for s in batches([3 * (len(x) + len(y)) for x, y in zip(f["left"], f["right"], strict=True)], BATCH):
                part = f.iloc[s]
                n = len(part)
                h, first = labelled(Words([zlib.decompress(x) for side in ("left", "right") for x in part[side]]))
                of = [h[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pd.DataFrame({"a": part["a"], "b": part["b"], "similarity": [
                    similarity(of[i], of[n + i], least) for i in range(n)]})
    return run


def _likely(rule: Near, best: bool = False):
    """Pairs of some blocks of buckets: different components, profiles near enough.  ``best`` gives the nearest one of each text only."""
    least = rule.similarity - rule.margin

    def ones(flags: np.ndarray) -> np.ndarray:
        """Number of true values in each row; PROFILE / 8 bytes are added at a time, which stay below 256."""
        return flags.view(np.uint64).sum(axis=1).view(np.uint8).reshape(-1, 8).sum(axis=1, dtype=np.int64)

    def of_block(nodes, parts, profiles, keys, key, mine, theirs):
        here, there = np.flatnonzero(mine), np.flatnonzero(theirs)
        beside = np.ascontiguousarray(profiles[there])
        known = beside != 0
        held = ones(known)
        for i in here:
            own = profiles[i]
            filled = own != 0
            equal, both = ones((beside == own) & filled), ones(known & filled)
            either = held + np.count_nonzero(filled) - both
            near = np.flatnonzero((equal >= least * either) & (parts[there] != parts[i]))
            if not len(near):
                continue
            if best:
                named = there[near[[np.argmax(equal[near] / either[near])]]]
                yield from ((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])) for j in named)
            else:
                # A pair shares many buckets; it is named in that of its first common sketch.
                near = there[near]
                common = keys[near] == keys[i]
                named = near[keys[i][common.argmax(axis=1)] == key]
                yield from ((nodes[i], nodes[j]) for j in named if nodes[i] < nodes[j])

    def run(frame):
        frame = frame.sort_values("block", kind="stable")
        nodes, parts = frame["node"].to_numpy(object), frame["component"].to_numpy(object)
        profiles = np.frombuffer(b"".join(frame["profile"]), dtype=np.uint8).reshape(-1, PROFILE)
        own, row, column, key = (frame[c].to_numpy() for c in ("own", "row_block", "column_block", "key"))
        keys = np.stack(frame["keys"].to_list())
        out = set()
        for f, n in zip(*runs(frame["block"].to_numpy()), strict=True):
            s = slice(f, f + n)
            mine, theirs = own[s] == row[s], own[s] == column[s]
            out.update(of_block(nodes[s], parts[s], profiles[s], keys[s], key[f], mine, theirs))
            if row[f] != column[f]:  # a pair is named from its lesser node, whichever block that is in
                out.update(of_block(nodes[s], parts[s], profiles[s], keys[s], key[f], theirs, mine))
        return pd.DataFrame(sorted(out), columns=["a", "b"])
    return run


def near_classes(docs: DataFrame, rule: Near = Near()) -> DataFrame:
    """One row per document: (doc_id, text_hash, class_id, n_texts, copies, kept).

    Texts are compared by their words, ASCII lower-cased; two are linked if an alignment of their occurrence-labelled
    5-word k-mers holds ``rule.similarity`` of all k-mers of both.  Linked texts form classes, named by the
    least doc_id among their documents; ``kept`` is true for documents of that id.  ``copies`` counts the documents with the same words,
    ``n_texts`` the different texts of the class, ``text_hash`` is xxhash64 of the text.

    Candidates share one of 20 sketches, which a pair at 0.8 misses once in a million.  Documents with the same words are one
    text; a group of near copies is joined through a star in each of a few buckets of a text, then through the nearest texts of
    other components, and what then is still apart is compared block by block, by profiles first.  So the number of
    verified pairs follows the links, not the square of a group.

    Null and empty texts, and texts of white space, are copies of one another.  Texts of fewer than five words match
    whole.  Repeated rows are copies.  A null doc_id never names a class that has another.  Other columns are not
    read; an empty table gives no row.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).withColumn(
        "text_hash", F.xxhash64("text"))
    seen = checkpoint(rows.mapInPandas(
        _sketch, "doc_id bigint, text_hash bigint, node binary, keys array<bigint>, n int"))
    texts = checkpoint(seen.where("n > 0").groupBy("node").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.any_value("keys").alias("keys")))
    keyed = texts.select("node", F.posexplode("keys").alias("at", "key"))
    shared = checkpoint(keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high"))
    members = checkpoint(keyed.join(shared, "key"))
    n_members = members.count()
    members = gathered(members, n_members)
    firsts = members.select("node").distinct().join(texts, "node").select(
        "node", "keys", F.col("first.doc_id").alias("id"), F.col("first.text_hash").alias("hash"))
    packed = checkpoint(
        rows.join(firsts, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")))
        .dropDuplicates(["node"]).select("node", "keys", "text")
        .mapInPandas(_pack, "node binary, keys array<bigint>, packed binary, profile binary"))

    def verified(pairs: DataFrame) -> DataFrame:
        left = packed.select(F.col("node").alias("a"), F.col("packed").alias("left"))
        right = packed.select(F.col("node").alias("b"), F.col("packed").alias("right"))
        out = checkpoint(pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInPandas(
            _verify(rule.similarity), "a binary, b binary, similarity double"))
        return gathered(out, out.count())

    def star(rows: DataFrame, column: str) -> DataFrame:
        return rows.where(F.col("node") != F.col(column)).select(
            F.least("node", column).alias("a"), F.greatest("node", column).alias("b"))

    def links_of(tested: DataFrame) -> DataFrame:
        return tested.where(F.col("similarity") >= rule.similarity).select("a", "b")

    # A few buckets of a text connect most of a group that is alike throughout.  What then is still apart is compared by profiles,
    # block by block: first the nearest text of another component is tried, which connects copies with what they
    # were made from, and then all pairs that are left.
    tested = verified(star(members.where(F.col("at") < FIRST_BUCKETS), "low").distinct())
    labels = contracted(links_of(tested))
    tested = tested.select("a", "b")
    for best in (True, False):
        apart = checkpoint(_apart(members, n_members, labels, rule))
        # Blocks are dealt out by their hash, many small ones in a call, and as many calls as the rows need.
        n_apart = apart.count()
        parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_apart // ROWS_OF_BLOCKS))
        dealt = gathered(apart, n_apart).join(packed.select("node", "keys", "profile"), "node").withColumn(
            "block", F.xxhash64("key", "row_block", "column_block")).withColumn("part", F.pmod(F.hash("block"), F.lit(parts)))
        likely = dealt.groupBy("part").applyInPandas(_likely(rule, best), "a binary, b binary").distinct()
        more = verified(likely.join(tested, ["a", "b"], "left_anti"))
        if more.isEmpty():
            continue
        tested = tested.union(more.select("a", "b"))
        labels = further_contracted(labels, links_of(more))

    classed = checkpoint(
        seen.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
        .join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")))
    names = checkpoint(classed.groupBy("component").agg(F.min("least").alias("class_id"), F.count("*").alias("n_texts")))
    named = checkpoint(classed.join(names, "component").select("node", "class_id", "n_texts", "copies"))
    return seen.select("doc_id", "text_hash", "node").join(named, "node").select(
        "doc_id", "text_hash", "class_id", "n_texts", "copies",
        F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def _with_component(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, key, component): what no link has reached is a component of its own."""
    return members.select("key", "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _apart(members: DataFrame, rows: int, labels: DataFrame, rule: Near) -> DataFrame:
    """(key, node, component, own, row_block, column_block): buckets with texts of several components, by blocks.

    ``rows`` is the number of members.
    """
    known = checkpoint(gathered(_with_component(members, labels), rows))
    mixed = checkpoint(known.groupBy("key").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("size"))
        .where("least < most").select("key", F.ceil(F.col("size") / rule.block).cast("int").alias("blocks")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        known.join(mixed, "key")
        .withColumn("own", F.pmod(F.hash("node"), F.col("blocks")))
        .withColumn("other", other)
        .select("key", "node", "component", "own", F.least("own", "other").alias("row_block"),
                F.greatest("own", "other").alias("column_block")))


def keep_one(docs: DataFrame, rule: Near = Near()) -> DataFrame:
    """One document of each class, with the columns of ``docs``: that of the least id; repeated rows once."""
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))
    names = fresh(docs, "_id", "_hash")
    kept = near_classes(docs, rule).where("kept").select(key.alias(names[0]), F.col("text_hash").alias(names[1])).distinct()
    keyed = docs.withColumns(dict(zip(names, (key, F.xxhash64(text_or_empty())), strict=True)))
    # One shuffle of the texts: the repeated rows fall where the join has put them.
    return keyed.join(kept, names, "left_semi").dropDuplicates(names).select(*docs.columns)
