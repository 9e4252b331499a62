"""Removal of repeated passages, with difference-cover anchors.

Any two places of a text pair have a common shift below PERIOD that brings both
to cover positions.  So two equal windows of WINDOW words share an anchor, a
run of ANCHOR words that begins at a cover position in both.  Only anchors
travel at first; windows around anchors that occur more than once are then
hashed whole, and all but the first of equal windows are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import ship, text_or_empty

WINDOW = 20
PERIOD, COVER = 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
#: Sorts after every document that has an id.
NO_ID = 2**63 - 1
#: Bytes of texts for which there is a bucket: some 800,000 anchors.
BYTES_PER_BUCKET = 1 << 24
_PARTS = "bucket int, kind int, h binary, doc binary, at binary, tag binary"
_FLAGS = "doc bigint, tag int, at int"


def _rows(h, doc, at, tag, buckets: int, kind: int) -> Iterator[tuple]:
    """One row per bucket of hashes, its entries sorted by hash; entries without a hash go by their row."""
    import numpy as np

    from gridtally.llm.wordhash import mix, planes, runs

    key = h if kind == 0 else mix(doc.view(np.uint64) ^ mix(tag.astype(np.uint64)))
    bucket = (key % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((at, doc, h, bucket)) if kind == 0 else np.lexsort((at, doc, bucket))
    first, count = runs(bucket[order])
    for f, n in zip(first, count, strict=True):
        own = order[f:f + n]
        yield (int(bucket[own[0]]), kind, planes(h[own]) if kind == 0 else b"", planes(doc[own]),
               planes(at[own]), planes(tag[own]))


def _frame(rows: list[tuple]):
    import pandas as pd

    return pd.DataFrame(rows, columns=["bucket", "kind", "h", "doc", "at", "tag"])


def _split(h, doc, at, tag, all_repeats: bool):
    """(sent on, already known) as index arrays; one entry of each hash is sent on.

    Of equal hashes the first by (doc, at) is sent.  The others are known to be repeated, and with ``all_repeats`` the
    first is so too.  Entries at the same (doc, at) are the same for this purpose.
    """
    import numpy as np

    from gridtally.llm.wordhash import runs

    order = np.lexsort((tag, at, doc, h))
    first, count = runs(h[order])
    lead = np.repeat(order[first], count)
    later = (doc[order] != doc[lead]) | (at[order] != at[lead])
    known = order[later]
    if all_repeats:
        known = order[np.repeat(count, count) > 1]
    else:  # rows that share id and place with the first are sent as well: they are removed with it or not at all
        return np.concatenate([order[first], order[~later & (np.arange(len(order)) != np.repeat(first, count))]]), known
    return order[first], known


def _anchors(buckets: int):
    """Anchors of each batch: one of each hash is sent on, repeated ones are known at once."""
    def run(frames: Iterator) -> Iterator:
        import numpy as np

        from gridtally.llm.wordhash import Words, batches

        for f in frames:
            docs, texts = f["doc"].to_numpy(np.int64), [t.encode() for t in f["text"]]
            tags = f["tag"].to_numpy(np.int32)
            for s in batches([len(t) for t in texts]):
                words = Words(texts[s])
                counts = words.counts()
                place = np.arange(len(words.hashes)) - np.repeat(words.first[:-1], counts)
                left = np.repeat(counts, counts) - place
                at = np.flatnonzero(np.isin(place % PERIOD, COVER) & (left >= ANCHOR) & (np.repeat(counts, counts) >= WINDOW))
                doc, tag = np.repeat(docs[s], counts)[at], np.repeat(tags[s], counts)[at]
                h, place = words.windows(at, ANCHOR), place[at].astype(np.int32)
                sent, known = _split(h, doc, place, tag, True)
                yield _frame([*_rows(h[sent], doc[sent], place[sent], tag[sent], buckets, 0),
                              *_rows(h[known], doc[known], place[known], tag[known], buckets, 1)])
    return run


def _flag(all_repeats: bool):
    """Of one bucket: what is known already, and what turns out repeated across batches."""
    def run(frame):
        import numpy as np
        import pandas as pd

        from gridtally.llm.wordhash import unplanes

        def column(part, name, dtype):
            return np.concatenate([np.zeros(0, dtype=dtype), *[unplanes(b, dtype) for b in part[name]]])

        new, old = frame[frame["kind"] == 0], frame[frame["kind"] == 1]
        h, doc, at, tag = (column(new, n, d) for n, d in (("h", "<u8"), ("doc", "<i8"), ("at", "<i4"), ("tag", "<i4")))
        _, known = _split(h, doc, at, tag, all_repeats)
        out = [np.concatenate([x[known], column(old, n, x.dtype)]) for x, n in ((doc, "doc"), (tag, "tag"), (at, "at"))]
        return pd.DataFrame(dict(zip(("doc", "tag", "at"), out, strict=True)))
    return run


def _candidates(buckets: int):
    """Windows of WINDOW words around repeated anchors."""
    def run(frames: Iterator) -> Iterator:
        import numpy as np

        from gridtally.llm.wordhash import Words, batches

        for f in frames:
            docs, texts = f["doc"].to_numpy(np.int64), [t.encode() for t in f["text"]]
            tags = f["tag"].to_numpy(np.int32)
            for s in batches([len(t) for t in texts]):
                words = Words(texts[s])
                marked = np.zeros(len(words.hashes) + 1, dtype=np.int32)
                for d, places in enumerate(f["anchors"].iloc[s]):
                    begin, n = words.first[d], words.first[d + 1] - words.first[d]
                    p = np.asarray(places)
                    p = p[p + ANCHOR <= n]  # those of another text with this id and tag may reach beyond
                    np.add.at(marked, begin + np.maximum(p - PERIOD + 1, 0), 1)
                    np.add.at(marked, begin + p + 1, -1)
                counts = words.counts()
                place = np.arange(len(words.hashes)) - np.repeat(words.first[:-1], counts)
                at = np.flatnonzero((np.cumsum(marked[:-1]) > 0) & (np.repeat(counts, counts) - place >= WINDOW))
                doc, tag = np.repeat(docs[s], counts)[at], np.repeat(tags[s], counts)[at]
                h, place = words.windows(at, WINDOW), place[at].astype(np.int32)
                sent, known = _split(h, doc, place, tag, False)
                yield _frame([*_rows(h[sent], doc[sent], place[sent], tag[sent], buckets, 0),
                              *_rows(h[known], doc[known], place[known], tag[known], buckets, 1)])
    return run


def _cut(frames: Iterator) -> Iterator:
    """Texts without the words that their repeated windows cover."""
    import numpy as np

    for f in frames:
        kept, words_of, gone, spans = [], [], [], []
        for text, starts in zip(f["text"], f["starts"], strict=True):
            text = text.encode()
            words = text.split()
            covered = np.zeros(len(words) + 1, dtype=np.int32)
            if starts is not None:
                p = np.asarray(starts)
                p = p[p + WINDOW <= len(words)]
                np.add.at(covered, p, 1)
                np.add.at(covered, p + WINDOW, -1)
            covered = np.cumsum(covered) > 0
            edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0))
            ranges = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
            rest, at = [], 0
            for a, b in ranges:
                rest += words[at:a]
                at = b
            rest += words[at:]
            kept.append(b" ".join(rest).decode())
            words_of.append(len(words))
            gone.append(len(words) - len(rest))
            spans.append([{"start": a, "end": b} for a, b in ranges])
        f["text"], f["n_words"], f["n_removed"], f["removed"] = kept, words_of, gone, spans
        yield f[["doc", "text", "n_words", "n_removed", "removed"]]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text, n_words, n_removed, removed): texts without passages that stand earlier as well.

    A window of 20 consecutive words is repeated if the same words also begin at a smaller (doc_id, place); every word
    that a repeated window covers goes.  ``text`` has the kept words joined by single spaces, ``removed`` the ranges
    (start, end) of removed words.  Words are compared by 64-bit hashes of whole windows.

    Null and empty texts have no words; documents of fewer than 20 words lose none.  Null ids come last and count as
    one id.  Repeated rows are kept; rows of one id and equal place don't remove each other, so that exact repeats of
    a row have equal results.  Other columns are not read; an empty table gives no row.
    """
    spark = docs.sparkSession
    ship(spark)
    # A tag tells rows of one id apart, and spreads those without an id.
    text = text_or_empty()
    tag = (F.crc32(text.cast("binary")) - F.lit(2**31)).cast("int").alias("tag")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc"), tag, text.alias("text"))
    # A bucket is held whole by a task, so their number follows the texts.
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BYTES_PER_BUCKET))

    def flagged(parts: DataFrame, all_repeats: bool) -> DataFrame:
        return parts.groupBy("bucket").applyInPandas(_flag(all_repeats), _FLAGS)

    # Both joins below read the same columns by the same key, so that the texts are shuffled once.
    anchors = flagged(rows.mapInPandas(_anchors(buckets), _PARTS), True)
    anchors = anchors.groupBy("doc", "tag").agg(F.collect_set("at").alias("anchors"))
    near = rows.join(anchors, ["doc", "tag"])
    windows = flagged(near.mapInPandas(_candidates(buckets), _PARTS), False)
    windows = windows.groupBy("doc", "tag").agg(F.collect_list("at").alias("starts"))
    whole = rows.join(windows, ["doc", "tag"], "left").select("doc", "text", "starts")
    done = whole.mapInPandas(
        _cut, "doc bigint, text string, n_words bigint, n_removed bigint, removed array<struct<start:int,end:int>>")
    return done.select(F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), "text", "n_words", "n_removed", "removed")
