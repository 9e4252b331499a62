"""Alignment of two tokenizers' tokens over the same bytes, by pointer jumping.

Both tokenise the same bytes.  Every token points to the token of the other side that reaches farthest right of those it
overlaps, which is the one with its last byte, or to itself where none reaches on.  All tokens of a batch of texts are taken
together: the successors are doubled until they stand still, on the last token of each overlapping component, which names its group.
Groups end where tokens of both sides end, and there the two last tokens are linked.

How often a pair of ids is linked in all texts is counted in Spark.  Of two tokens that end together one's bytes end the
other's, so that the vocabularies alone bound the number of pairs: PairNumbers lists them, some 10 for each entry of a vocabulary.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import ship, stored, text_or_empty
from gridtally.llm.pieces import BATCH_CHARS, by_chars, default_model, int_lists, pieces
from gridtally.llm.tokens import default_vocabulary, encoder


def _byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: printable Latin ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairNumbers:
    """The pairs of a byte-level token and a piece of which one's bytes end the other's, numbered from 0."""

    def __init__(self, a: list[bytes], b: list[bytes]):
        import numpy as np

        def ending(long: list[bytes], short: list[bytes]) -> Iterator[tuple[int, int]]:
            ids: dict[bytes, list[int]] = {}
            for i, t in enumerate(short):
                ids.setdefault(t, []).append(i)
            for i, t in enumerate(long):
                for start in range(len(t)):
                    for j in ids.get(t[start:], ()):
                        yield i, j

        pairs = {*ending(a, b), *((i, j) for j, i in ending(b, a))}
        self.width = len(b)
        self.keys = np.array(sorted(i * self.width + j for i, j in pairs), dtype=np.int64)

    def of(self, a, b):
        """The numbers of pairs of ids."""
        import numpy as np

        return np.searchsorted(self.keys, a.astype(np.int64) * self.width + b).astype(np.int32)

    def b_ids(self):
        return self.keys % self.width


def terminals(a_ends, b_ends):
    """(component of each token of A, of each token of B, place in A and in B of each component's last tokens).

    The ends ascend and both sides end at the same byte.  A component is named by the place in B of its last token.
    """
    import numpy as np

    n = len(a_ends)
    over = np.searchsorted(b_ends, a_ends)  # the token of B with the last byte of each token of A
    under = np.searchsorted(a_ends, b_ends)
    goes_on = a_ends[under] > b_ends
    here = np.arange(n, n + len(b_ends))
    successor = np.concatenate([n + over, np.where(goes_on, under, here)])
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            break
        successor = further
    last = np.flatnonzero(~goes_on)
    return successor[:n] - n, successor[n:] - n, under[last], last


class Aligner:
    """Both tokenizers, with the bytes of their tokens."""

    def __init__(self, vocabulary: str, model: str):
        import numpy as np

        self.byte_level, self.pieces = encoder(vocabulary, plain=True), pieces(model)
        letters = _byte_letters()
        entries = self.byte_level.tokenizer.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(entries.values(), default=-1) + 1)
        for text, i in entries.items():
            self.a_bytes[i] = bytes(letters[c] for c in text) if all(c in letters for c in text) else text.encode()
        self.b_bytes = self.pieces.surfaces
        self.pairs = PairNumbers(self.a_bytes, self.b_bytes)
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in side]) for side in (self.a_bytes, self.b_bytes))
        self.a_table, self.b_table = (np.array(side, dtype=object) for side in (self.a_bytes, self.b_bytes))
        # An id and what follows it: within a group, and at its end.
        self.a_names = np.array([f"{i}," for i in range(len(self.a_bytes))] + [f"{i}|" for i in range(len(self.a_bytes))], dtype=object)
        self.b_names = np.array([f"{i}," for i in range(len(self.b_bytes))] + [f"{i};" for i in range(len(self.b_bytes))], dtype=object)

    def tokens(self, texts: list[str]):
        """(ids of A, ids of B) of each text; empty ones where the tokens don't give its bytes."""
        import numpy as np

        none = np.zeros(0, np.int64)
        a_all = self.byte_level.many([" " + t if t else "" for t in texts])
        b_all = self.pieces.encode([self.pieces.normalise(t)[0] for t in texts])
        out = []
        for text, a, b in zip(texts, a_all, b_all, strict=True):
            a, b = (np.frombuffer(x, "<u4").astype(np.int64) for x in (a, b))
            whole = (" " + text).encode() if text else b""
            same = b"".join(self.a_table[a]) == whole and b"".join(self.b_table[b]) == whole
            out.append((a, b) if same else (none, none))
        return out

    def align(self, texts: list[str]):
        """For each text: numbers of tokens and groups, groups as text, distinct numbers of linked pairs and how often each."""
        import numpy as np

        sides = self.tokens(texts)
        n_a, n_b = (np.array([len(s[k]) for s in sides]) for k in (0, 1))
        a, b = (np.concatenate([s[k] for s in sides]) if sides else np.zeros(0, np.int64) for k in (0, 1))
        # All texts stand one after the other; both sides end together at the end of each, so that no group spans two.
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        a_group, b_group, a_last, b_last = terminals(a_ends, b_ends)

        # Groups as text: the tokens of a group stand before those of later ones, A before B.
        a_ends_group, b_ends_group = (np.zeros(len(x), np.int64) for x in (a, b))
        a_ends_group[a_last], b_ends_group[b_last] = 1, 1
        words = np.empty(len(a) + len(b), dtype=object)
        words[np.arange(len(a)) + np.searchsorted(b_group, a_group)] = self.a_names[a + a_ends_group * len(self.a_bytes)]
        words[np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")] = self.b_names[b + b_ends_group * len(self.b_bytes)]
        words, bounds = words.tolist(), np.cumsum([0, *(n_a + n_b)])
        groups = ["".join(words[s:e])[:-1] for s, e in zip(bounds[:-1], bounds[1:], strict=True)]

        text_of = np.repeat(np.arange(len(texts)), n_b)[b_last]
        linked = self.pairs.of(a[a_last], b[b_last])
        keys, times = np.unique(text_of * len(self.pairs.keys) + linked, return_counts=True)
        cuts = np.searchsorted(keys, np.arange(1, len(texts)) * len(self.pairs.keys))
        return (n_a, n_b, np.bincount(text_of, minlength=len(texts)), groups,
                np.split(keys % len(self.pairs.keys), cuts), np.split(times, cuts))


@functools.lru_cache(maxsize=1)
def aligner(vocabulary: str, model: str) -> Aligner:
    """One aligner per worker process."""
    return Aligner(vocabulary, model)


def align(docs: DataFrame, vocabulary: str | None = None, model: str | None = None) -> DataFrame:
    """One row per document: (doc_id, n_a, n_b, n_groups, groups, pairs, times).

    A is the byte-level vocabulary over a space and the text, B the model over the text, both without special tokens.
    ``groups`` is ``a1,a2|b1;a3|b2,b3``: the ids of each group in order.  ``pairs`` are the numbers (PairNumbers) of the pairs of
    ids whose tokens end together, each once, and ``times`` how often.

    Null and empty texts, and those whose tokens don't give back their bytes (a text with the model's own blank U+2581), have no
    tokens: zeros, an empty text and empty arrays.  Repeated rows are aligned each, null ids kept; an empty table gives no row.
    Other columns are not read.
    """
    ship(docs.sparkSession)
    paths = vocabulary or default_vocabulary(), model or default_model()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in (part for whole in batches for part in by_chars(whole, limit=BATCH_CHARS // 4)):
            n_a, n_b, n_groups, groups, pairs, times = aligner(*paths).align(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(n, pa.int64()) for n in (n_a, n_b, n_groups)), pa.array(groups, pa.string()),
                 int_lists(pairs), int_lists(times)],
                names=["doc_id", "n_a", "n_b", "n_groups", "groups", "pairs", "times"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups string, pairs array<int>, times array<int>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): how many links in all texts have each pair of ids.  A row per pair at most, whatever the number of texts."""
    links = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    return links.groupBy(F.col("link.pairs").alias("pair")).agg(F.sum("link.times").alias("n"))


def with_counts(aligned: DataFrame, vocabulary: str | None = None, model: str | None = None) -> DataFrame:
    """``aligned`` with n_links, n_best (links whose count is the highest of their piece) and count_sum, instead of the pairs.

    ``aligned`` is read twice: keep it as a table before.  The counts, one number for each pair that the vocabularies allow,
    go to all tasks.
    """
    import numpy as np

    spark = aligned.sparkSession
    ship(spark)
    own = Aligner(vocabulary or default_vocabulary(), model or default_model())
    found = pair_counts(aligned).toArrow()  # at most len(own.pairs.keys) rows
    counts = np.zeros(len(own.pairs.keys), np.int64)
    counts[found["pair"].to_numpy()] = found["n"].to_numpy()
    highest = np.zeros(len(own.b_bytes), np.int64)
    np.maximum.at(highest, own.pairs.b_ids(), counts)
    sent = spark.sparkContext.broadcast((counts, counts == highest[own.pairs.b_ids()]))
    kept = [f for f in aligned.schema if f.name not in ("pairs", "times")]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts, best = sent.value
        for batch in batches:
            lists = batch["pairs"]
            pair, times = lists.flatten().to_numpy(zero_copy_only=False), batch["times"].flatten().to_numpy(zero_copy_only=False)
            at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            sums = [np.diff(np.append(0, np.cumsum(x))[at]) for x in (times, times * best[pair], times * counts[pair])]
            yield pa.RecordBatch.from_arrays([*(batch[f.name] for f in kept), *(pa.array(s, pa.int64()) for s in sums)],
                                             names=[*(f.name for f in kept), "n_links", "n_best", "count_sum"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return aligned.mapInArrow(run, f"{fields}, n_links bigint, n_best bigint, count_sum bigint")


def aligned_documents(docs: DataFrame, vocabulary: str | None = None, model: str | None = None) -> DataFrame:
    """One row per document: (doc_id, n_a, n_b, n_groups, groups_sha256, n_links, n_best, count_sum).

    The alignments are written once, the groups as their digest (an empty one without tokens); then the pairs are counted and read against.
    Odd inputs as in ``align``.
    """
    aligned = stored(align(docs, vocabulary, model).withColumn(
        "groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups"))
    return with_counts(aligned, vocabulary, model)
