"""Benchmark decontamination with spaced seeds.

A seed reads the words at the fixed offsets of a mask and ignores those between
them.  Seeds of the test items are joined with seeds of the documents; around
each hit the words are compared on the hit's diagonal, and a window of 13 words
of which 11 agree counts as an overlap.  The two masks are such that any window
with two substituted words still holds a whole seed of one of them, so that no
overlap of that kind is missed.  Built-in functions only.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import text_or_empty, words_of

WINDOW, AGREE = 13, 11
#: Found by search over all masks of weight 6; the tests check that they are lossless for WINDOW and AGREE.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
SPAN = 1 + max(m[-1] for m in MASKS)
#: Seeds with their neighbourhoods are broadcast up to this many, joined by shuffle beyond.
MAX_BROADCAST_SEEDS = 100_000
PUNCTUATION = ".,;:!?\"'()[]"


def normal_words(text: Column) -> Column:
    """Lower-cased words without punctuation."""
    return words_of(F.translate(F.lower(text), PUNCTUATION, ""))


def _starts(words: Column, span: int) -> Column:
    return F.when(F.size(words) >= span, F.sequence(F.lit(0), F.size(words) - span)).otherwise(
        F.array().cast("array<int>"))


def _seed(words: Column, at: Column, mask: tuple[int, ...]) -> Column:
    return F.xxhash64(F.lit(mask[-1]), *[F.get(words, at + o) for o in mask])


def _seeds(words: Column, at: Column) -> Column:
    """The seeds that begin at a place; null where a mask reaches beyond the last word."""
    return F.array(*[F.when(at + (m[-1] + 1) <= F.size(words), _seed(words, at, m)) for m in MASKS])


def _around(words: Column, at: Column) -> Column:
    """Up to WINDOW words on each side of a place, and how many of them stand before it."""
    low = F.greatest(at - WINDOW, F.lit(0))
    return F.struct((at - low).alias("before"), F.slice(words, low + 1, at - low + SPAN + WINDOW).alias("words"))


def overlaps(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
             text: str = "text") -> DataFrame:
    """One row per overlapping document and item: (doc_id, item_id, agreeing, start, end, text_key).

    ``agreeing`` is the most words that agree in one window, ``start`` and ``end`` (exclusive) the document's words
    from the first to the last overlapping window.  ``text_key`` tells documents of the same id apart.  An item of fewer than 13 words
    overlaps where all its words stand in a row; an item without words never does.  Null texts have no words.
    Repeated rows give one row, empty tables none; other columns are not read.
    """
    left = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_or_empty(text)).alias("text_key"),
                       normal_words(text_or_empty(text)).alias("dw"))
    right = items.select(F.col(item_id).alias("item_id"), normal_words(text_or_empty(text)).alias("iw")).distinct()

    at = F.col("j")
    seeds = (
        right.where(F.size("iw") >= WINDOW).select("item_id", "iw", F.explode(_starts(F.col("iw"), SPAN - 1)).alias("j"))
        .select("item_id", F.explode(_seeds(F.col("iw"), at)).alias("seed"), _around(F.col("iw"), at).alias("item"))
        .where("seed is not null")
    )
    place = F.col("i")
    starts = (
        left.select("doc_id", "text_key", "dw", F.explode(_starts(F.col("dw"), SPAN - 1)).alias("i"))
        .withColumn("seed", F.explode(_seeds(F.col("dw"), place)))
        .where("seed is not null")
    )
    own = F.col("doc_id"), F.col("text_key"), F.col("i"), _around(F.col("dw"), place).alias("doc")
    if seeds.count() <= MAX_BROADCAST_SEEDS:  # the words beside a place are cut out where it is hit
        hits = starts.join(F.broadcast(seeds), "seed").select(*own, "item_id", "item")
    else:  # a place is shuffled with the words beside it, not with all of its document
        hits = starts.select(*own, "seed").join(seeds, "seed").drop("seed")
    # Both sides from the same diagonal: as many words before the hit as both have.
    before = F.least("item.before", "doc.before")
    agree = F.zip_with(
        F.slice("doc.words", F.col("doc.before") - before + 1, F.lit(2 * WINDOW + SPAN)),
        F.slice("item.words", F.col("item.before") - before + 1, F.lit(2 * WINDOW + SPAN)),
        lambda a, b: F.when(a == b, 1).otherwise(0))  # beyond the shorter side: null, so 0
    windows = F.transform(
        _starts(F.col("agree"), WINDOW),
        lambda s: F.struct(F.aggregate(F.slice("agree", s + 1, WINDOW), F.lit(0), lambda x, y: x + y).alias("n"),
                           (F.col("i") - F.col("before") + s).alias("at")))
    found = (
        hits.withColumns({"before": before, "agree": agree})
        .withColumn("good", F.filter(windows, lambda w: w["n"] >= AGREE))
        # Hits without an overlap go after the aggregation: tested before, the comparison would move into the join,
        # which then is no longer compiled with the explosion below it and holds a document's words once per place.
        .groupBy("doc_id", "text_key", "item_id")
        .agg(F.max(F.array_max("good")["n"]).alias("agreeing"),
             F.min(F.array_min(F.transform("good", lambda w: w["at"]))).alias("start"),
             (F.max(F.array_max(F.transform("good", lambda w: w["at"]))) + WINDOW).alias("end"))
        .where("agreeing is not null")
    )
    return found.unionByName(_short(left, right)).select("doc_id", "item_id", "agreeing", "start", "end", "text_key")


def _short(left: DataFrame, right: DataFrame) -> DataFrame:
    """Items of fewer than WINDOW words, found whole, in one pass over the documents for all lengths that occur."""
    short = right.where((F.size("iw") > 0) & (F.size("iw") < WINDOW)).withColumn("n", F.size("iw"))
    lengths = [r["n"] for r in short.select("n").distinct().orderBy("n").collect()]  # WINDOW - 1 at most
    own = short.select("item_id", "n", F.array_join("iw", " ").alias("words"))
    places = F.flatten(F.transform(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: F.transform(
        _starts(F.col("dw"), n), lambda i: F.struct(n.alias("n"), i.alias("i")))))
    return (left.select("doc_id", "text_key", "dw", F.explode(places).alias("p"))
            .select("doc_id", "text_key", "p.n", "p.i", F.array_join(F.slice("dw", F.col("p.i") + 1, F.col("p.n")), " ").alias("words"))
            .join(own, ["n", "words"])
            .groupBy("doc_id", "text_key", "item_id", "n").agg(F.min("i").alias("start"), (F.max("i") + F.col("n")).alias("end"))
            .select("doc_id", "text_key", "item_id", F.col("n").alias("agreeing"), "start", "end"))


def remove_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text overlaps an item; all columns kept, null ids compared as equal."""
    bad = overlaps(docs, items).select("doc_id", "text_key").distinct()
    same = (F.col("d.doc_id").eqNullSafe(F.col("b.doc_id"))) & (
        F.xxhash64(F.coalesce(F.col("d.text"), F.lit(""))) == F.col("b.text_key"))
    return docs.alias("d").join(bad.alias("b"), same, "left_anti")
