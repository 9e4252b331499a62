"""Quality classifier: a factorisation machine over words, structure and metadata.

Score of a text with features x: sigmoid(w0 + sum w_i x_i + sum of <v_i, v_j> x_i x_j over pairs).  The pairs
need no loop: for each of the few dimensions of v, half of the square of the
sum less the sum of the squares gives them all in time linear in the features.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import ship, text_or_empty


@dataclass(frozen=True)
class Training:
    """``rows`` bounds the labelled texts that are fitted on; all others only take part in scoring."""

    rows: int = 4000
    buckets: int = 1 << 14
    rank: int = 4
    rounds: int = 60
    rate: float = 0.05
    penalty: float = 1e-4
    seed: int = 7


STRUCTURE = ("empty", "length", "mean_word", "long_words", "distinct", "repeated_neighbours", "upper", "digits", "punctuation",
             "symbols", "lines", "repeated_lines", "mean_line", "stops")
METADATA = ("chars_given", "chars_differ")
#: Parts of a structure value: its feature has the place of the part it falls in, and so needs no scaling.
PARTS = 12
#: Rows of the sample whose features and gradients are held at a time.
BLOCK = 256
_PUNCTUATION, _SYMBOLS = b".,;:!?'\"()-", b"#$%&*+/<=>@[\\]^_`{|}~"


def _structure(text: str, words: list[str]) -> list[float]:
    """Values of STRUCTURE, each between 0 and 1."""
    n, chars = len(words), len(text)
    if not n:
        return [1.0] + [0.0] * (len(STRUCTURE) - 1)
    lines = [line for line in text.split("\n") if line.strip()]
    raw = text.encode()
    held = lambda some: len(raw) - len(raw.translate(None, some))
    level = lambda x, most: min(np.log1p(x) / np.log1p(most), 1.0)
    return [
        0.0, level(n, 20_000), min(sum(map(len, words)) / n / 20, 1.0), sum(len(w) > 12 for w in words) / n,
        len(set(words)) / n, sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        sum(map(str.isupper, words)) / n, sum(map(str.isdigit, words)) / n,
        min(held(_PUNCTUATION) / n / 2, 1.0), min(held(_SYMBOLS) / n / 2, 1.0),
        level(len(lines), 1000), 1 - len(set(lines)) / max(len(lines), 1), level(chars / max(len(lines), 1), 5000),
        sum(line.rstrip().endswith((".", "!", "?")) for line in lines) / max(len(lines), 1)]


def features(text: str, n_chars: float | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values) of one text: hashed words by their share, then structure and metadata by parts."""
    words = text.split()
    counts = Counter(words)
    own = Counter()
    for w, c in counts.items():
        own[zlib.crc32(w.lower().encode()) % buckets] += c
    values = np.sqrt(np.fromiter(own.values(), dtype=np.float64, count=len(own)) / max(len(words), 1))
    known = n_chars is not None and n_chars == n_chars
    meta = [float(known), min(abs((n_chars or 0) - len(text)) / (len(text) + 1), 1.0) if known else 0.0]
    parts = [buckets + k * PARTS + min(int(v * PARTS), PARTS - 1) for k, v in enumerate(_structure(text, words) + meta)]
    index = np.concatenate([np.fromiter(own.keys(), dtype=np.int64, count=len(own)), np.array(parts, dtype=np.int64)])
    return index, np.concatenate([values, np.full(len(parts), 0.25)])


class Machine:
    """Weights of a factorisation machine, and the scores and gradients of rows of features in one long array."""

    def __init__(self, size: int, rank: int, seed: int):
        rng = np.random.default_rng(seed)
        self.bias, self.linear = 0.0, np.zeros(size)
        self.factors = rng.normal(0, 0.05, (size, rank))

    def logits(self, index: np.ndarray, value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(score before the sigmoid, sums over the features of each row); rows begin at ``first`` and are not empty."""
        scaled = self.factors[index] * value[:, None]
        sums = np.add.reduceat(scaled, first, axis=0)
        squares = np.add.reduceat((scaled * scaled).sum(axis=1), first)
        pairs = 0.5 * ((sums * sums).sum(axis=1) - squares)
        return self.bias + np.add.reduceat(self.linear[index] * value, first) + pairs, sums

    def fit(self, index, value, first, label, rule: Training) -> None:
        """Adam over the whole sample, of which each step goes through BLOCK rows at a time; both classes weigh the same."""
        ends = np.append(first, len(index))
        weight = np.where(label == 1, 0.5 / max((label == 1).sum(), 1), 0.5 / max((label == 0).sum(), 1))
        state = [(np.zeros_like(x), np.zeros_like(x)) for x in (np.zeros(1), self.linear, self.factors)]
        for step in range(1, rule.rounds + 1):
            errors, linear, factors = [], np.zeros_like(self.linear), np.zeros(self.factors.shape[::-1])
            for b in range(0, len(first), BLOCK):
                of = slice(b, b + BLOCK)
                here = slice(first[b], ends[min(b + BLOCK, len(first))])
                i, v = index[here].astype(np.int64), value[here].astype(np.float64)
                z, sums = self.logits(i, v, first[of] - first[b])
                errors.append((1 / (1 + np.exp(-z)) - label[of]) * weight[of])
                rows = np.repeat(np.arange(len(z)), np.diff(ends[b:b + BLOCK + 1]))
                e = errors[-1][rows] * v
                inner = e[:, None] * (sums[rows] - self.factors[i] * v[:, None])
                np.add.at(linear, i, e)
                for k, slope in enumerate(factors):
                    np.add.at(slope, i, inner[:, k])
            slopes = [np.array([np.concatenate(errors).sum()]), linear + rule.penalty * self.linear,
                      factors.T + rule.penalty * self.factors]
            moves = []
            for g, (m, v) in zip(slopes, state, strict=True):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                moves.append(rule.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8))
            self.bias -= float(moves[0][0])
            self.linear -= moves[1]
            self.factors -= moves[2]


def _featurise(buckets: int):
    def run(frames: Iterator) -> Iterator:
        for f in frames:
            pairs = [features(t, n, buckets) for t, n in zip(f["text"], f["n_chars"], strict=True)]
            yield pd.DataFrame({"label": f["label"], "order": f["order"], "index": [p[0].astype(np.int32).tobytes() for p in pairs],
                                "value": [p[1].astype(np.float32).tobytes() for p in pairs]})
    return run


def _with_metadata(docs: DataFrame) -> DataFrame:
    """(doc_id, text, n_chars), whatever else there is."""
    given = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select("doc_id", text_or_empty().alias("text"), given.alias("n_chars"))


def fit(docs: DataFrame, labels: DataFrame, rule: Training = Training()) -> Machine:
    """A machine from the labelled documents, or from at most ``rule.rows`` of them that a hash of the id picks.

    ``labels`` has doc_id and quality (1 good, 0 bad).  Rows without a label of 0 or 1 and documents with both
    are left out; of rows with one id the least text counts.  Without any labelled row all scores are 0.5.
    """
    ship(docs.sparkSession)
    clear = (labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id")
             .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
             .where("low = high").select(F.col("doc_id").alias("_id"), F.col("low").alias("label")))
    # Ids alone first: the texts of the chosen rows are then fetched by a broadcast of at most rule.rows ids.
    known = docs.select("doc_id").join(clear, F.col("doc_id") == F.col("_id")).select("_id", "label").distinct()
    count = known.count()
    place = F.pmod(F.xxhash64("_id"), F.lit(1 << 32))
    if count > rule.rows:  # so large a share of all hashes that rule.rows is hardly ever passed; the limit makes sure
        known = known.where(place < int(0.95 * rule.rows / count * (1 << 32)))
    chosen = known.orderBy(place, "_id").limit(rule.rows)
    sample = (
        _with_metadata(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
        .groupBy("_id").agg(F.min(F.struct("text", "n_chars", "label")).alias("r"))
        .select("r.*", F.xxhash64("_id").alias("order"))
    )
    rows = sample.mapInPandas(
        _featurise(rule.buckets), "label int, order bigint, index binary, value binary").collect()
    machine = Machine(rule.buckets + PARTS * (len(STRUCTURE) + len(METADATA)), rule.rank, rule.seed)
    if rows:
        rows.sort(key=lambda r: r["order"])
        index = np.frombuffer(b"".join(r["index"] for r in rows), dtype=np.int32)
        value = np.frombuffer(b"".join(r["value"] for r in rows), dtype=np.float32)
        first = np.cumsum([0] + [len(r["index"]) // index.itemsize for r in rows[:-1]])
        machine.fit(index, value, first, np.array([r["label"] for r in rows], dtype=np.float64), rule)
    return machine


def score(docs: DataFrame, machine: Machine, buckets: int = Training.buckets) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if the score is 0.5 or more).

    Only text and n_chars are read; null texts count as empty, and empty ones are scored.  Repeated rows are scored
    alike, an empty table gives an empty result, columns of these names are replaced, others kept.
    """
    spark = docs.sparkSession
    ship(spark)
    weights = spark.sparkContext.broadcast(machine)
    docs = docs.drop("score", "predicted")
    keep = docs.columns

    @F.pandas_udf("double")
    def scored(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, given in frames:
            out = []
            for t, n in zip(texts, given, strict=True):
                index, value = features(t, n, buckets)
                z = float(weights.value.logits(index, value, np.array([0]))[0][0])
                out.append(1 / (1 + np.exp(-np.clip(z, -500, 500))))
            yield pd.Series(out, dtype=np.float64)

    given = F.col("n_chars").cast("double") if "n_chars" in keep else F.lit(None).cast("double")
    out = docs.withColumn("score", scored(text_or_empty(), given))
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def classify(docs: DataFrame, labels: DataFrame, learn_from=None, rule: Training = Training()) -> DataFrame:
    """``fit`` on the documents for which the column ``learn_from`` holds (default: all), then ``score`` of all."""
    machine = fit(docs if learn_from is None else docs.where(learn_from), labels, rule)
    return score(docs, machine, rule.buckets)
