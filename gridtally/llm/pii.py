"""Personal data: patterns, and terms that give protected entities away.

The patterns find emails, IP addresses, card and phone numbers; each distinct
value is a protected entity.  Words that stand near an entity are weighed by
how strongly they reveal it: the pointwise mutual information of word and
entity over the corpus, against the information content of the entity itself.
A word above the first threshold is generalised, above the second removed,
wherever it stands.  Built-in functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import SPACE, checkpoint, fresh, text_or_empty, words_of

# The patterns.  They match what the plain forms beside them match; possessive quantifiers and the
# look-behind only keep long runs from being tried again and again.
#: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
#: [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: [0-9]([\x20-]?[0-9])+
CARD = r"[0-9](?:[\x20-]?[0-9])++"
#: \+[0-9][\x20().0-9-]+[0-9]
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term")
#: A text without this has no match of the kind.
HINTS = {"email": "@", "ip": r"[0-9][.][0-9]++[.][0-9]++[.][0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"[+][0-9]"}


@dataclass(frozen=True)
class Disclosure:
    """When a word counts as giving an entity away.

    ``generalise`` and ``remove`` are shares of the entity's information content that the word must carry; ``reach`` is
    how many characters on each side of an entity are its surroundings.
    """

    generalise: float = 0.85
    remove: float = 0.95
    reach: int = 80


#: Terms, and terms of documents, are broadcast up to so many rows, joined by shuffle beyond.
MAX_BROADCAST_TERMS = 100_000
_EDGES = ".,;:!?\"'()[]{}<>*_`~|/\\%&$#@+=-0123456789"


def _hint(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_BROADCAST_TERMS else df


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    digit = lambda i: F.substring(digits, i, F.lit(1)).cast("int")
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + F.when(
        (n - i) % 2 == 1, doubled(digit(i))).otherwise(digit(i)))
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, "[.]"), lambda p: p.rlike("^0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])?$"))
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _placed(text: Column, pattern: Column, valid) -> Column:
    """Array of (start, end, value) of the valid matches; places count code points, the end is exclusive.

    The pieces between the matches and the matches themselves add up to the places.
    """
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, pattern, -1)
    lengths = F.zip_with(between, found, lambda b, m: F.struct(F.length(b).alias("b"), F.length(m).alias("m")))
    numbered = F.filter(F.transform(found, lambda m, i: F.struct(i.alias("i"), m.alias("m"))), lambda x: valid(x["m"]))

    def place(x):
        before = F.aggregate(F.slice(lengths, 1, x["i"]), F.lit(0), lambda acc, y: acc + y["b"] + y["m"])
        start = before + F.get(lengths, x["i"])["b"]
        return F.struct(start.alias("start"), (start + F.length(x["m"])).alias("end"), x["m"].alias("value"))

    return F.transform(numbered, place)


SPANS = "array<struct<start:int,end:int,value:string>>"


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with an array column per kind, ``email``, ``ip``, ``card`` and ``phone``: (start, end, value)."""
    nothing = F.array().cast(SPANS)
    t = text_or_empty(text)
    for kind, pattern in (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)):
        hint = t.contains("@") if kind == "email" else t.rlike(HINTS[kind])
        spans = F.when(hint, _placed(t, F.lit(pattern), lambda m, k=kind: _valid(k, m))).otherwise(nothing)
        docs = docs.withColumn(kind, spans.cast(SPANS))
    return docs


def _of_all(kinds: tuple[str, ...], f) -> Column:
    """f(kind, span) of all spans, by kind in this order."""
    def of_one(kind):
        return F.transform(F.col(kind), lambda s: f(kind, s))
    return F.flatten(F.array(*map(of_one, kinds)))


def bare(word: Column) -> Column:
    """A word without digits and punctuation at its ends."""
    return F.btrim(word, F.lit(_EDGES))


def clean_words(text: Column) -> Column:
    """Distinct words of letters, lower-cased, without digits and punctuation at their ends, three letters or more."""
    return F.array_distinct(F.filter(F.transform(words_of(F.lower(text)), bare), lambda w: w.rlike(r"^\p{L}{3,}+$")))


def _distinct_terms(text: Column) -> Column:
    """Array of the different words of a text, lower-cased, without digits and punctuation at their ends."""
    return F.array_distinct(F.transform(F.array_distinct(F.split(F.lower(text), SPACE)), bare))


def _frequency(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n_t): the number of rows in which each of the distinct ``terms`` stands.  Counted before it is shuffled."""
    words = docs.select(F.explode(_distinct_terms(text_or_empty())).alias("term"))
    rows = terms.count()
    if rows <= MAX_BROADCAST_TERMS:
        words = words.join(F.broadcast(terms), "term")
    counted = words.groupBy("term").agg(F.count("*").alias("n_t"))
    return counted if rows <= MAX_BROADCAST_TERMS else counted.join(terms, "term")


def _holding(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, text_hash, term): the documents in which each of the distinct ``terms`` stands."""
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(_distinct_terms(text_or_empty())).alias("term"))
    return words.join(_hint(terms, terms.count()), "term").select("doc_id", "text_hash", "term").distinct()


def _mentions(docs: DataFrame, rule: Disclosure) -> DataFrame:
    """A row per row of ``docs`` and entity: the words around its mentions, and a key of these surroundings."""
    t, reach = text_or_empty(), rule.reach
    found = _of_all(KINDS[:4], lambda k, s: F.struct(
        F.lit(k).alias("kind"), F.lower(s["value"]).alias("value"), s["start"].alias("start"), s["end"].alias("end")))
    some = docs.where(F.size(F.col("email")) + F.size(F.col("ip")) + F.size(F.col("card")) + F.size(F.col("phone")) > 0)
    low = F.greatest(F.col("m.start") - reach, F.lit(0))
    left = F.substring(F.col("t"), low + 1, F.col("m.start") - low)
    right = F.substring(F.col("t"), F.col("m.end") + 1, F.lit(reach))
    whole_left = F.when(low > 0, F.regexp_replace(left, r"^[^\x20\x09-\x0D]*+", "")).otherwise(left)
    whole_right = F.when(F.length(right) == reach, F.regexp_replace(right, r"[^\x20\x09-\x0D]*+$", "")).otherwise(right)
    return (
        some.select(F.monotonically_increasing_id().alias("row"), t.alias("t"), found.alias("found"))
        .select("row", "t", F.explode("found").alias("m"))
        .select("row", F.struct("m.kind", "m.value").alias("entity"),
                clean_words(F.concat(whole_left, F.lit(" "), whole_right)).alias("near"))
        .groupBy("row", "entity").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near"))
        .withColumn("context", F.xxhash64("near"))
    )


def disclosing_terms(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """(term, share, kinds): words that reveal a protected entity, the largest share of its information they carry.

    ``docs`` has the columns of ``base_spans``; repeated rows count each.  With N documents, n(e) that mention the entity, n(t) that hold the
    word and n(e, t) where it stands beside the entity, the share is log(N p / n(e)) / log(N / n(e)).  p is how often
    the word tells the entity when one surrounding, with all its copies, is left out to be told by the others: of c
    different surroundings, p = (n(e,t) - n(e,t)/c) / (n(t) - n(e,t)/c).  Two are enough if the word stands nowhere
    else; of a single one nothing is left, p is 0 and the word discloses nothing.
    """
    mentions = checkpoint(_mentions(docs, rule))  # read twice below; the patterns are dear
    per_entity = mentions.groupBy("entity").agg(F.count("*").alias("n_e"))
    pairs = (
        mentions.select("entity", "context", F.explode("near").alias("term"))
        .groupBy("entity", "term", "context").agg(F.count("*").alias("n"))
        .groupBy("entity", "term").agg(F.sum("n").alias("n_et"), F.count("*").alias("contexts"))
        .where(F.col("contexts") > 1)  # p is 0 otherwise
        .join(per_entity, "entity")
    )
    pairs = checkpoint(pairs)
    if pairs.isEmpty():  # p is 0 for all: the counts over all words would be of nothing
        return docs.sparkSession.createDataFrame([], "term string, share double")
    frequency = _frequency(docs, checkpoint(pairs.select("term").distinct()))
    size = F.lit(float(docs.count()))
    left_out = F.col("n_et") / F.col("contexts")
    p = (F.col("n_et") - left_out) / (F.greatest("n_t", "n_et") - left_out)
    carried = F.ln(size * p / F.col("n_e"))
    whole = F.ln(size / F.col("n_e"))
    return (
        pairs.join(frequency, "term")
        .where(F.col("n_e") < size)
        .select("term", (carried / whole).alias("share"))
        .groupBy("term").agg(F.max("share").alias("share"))
        .where(F.col("share") >= rule.generalise)
    )


def find_private(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """``docs`` with the arrays ``email``, ``ip``, ``card``, ``phone`` and ``term`` of (start, end, value).

    The four patterns are matched leftmost and without overlap within a kind, whatever other kinds find.  ``term``
    has the words that disclose an entity; its value is ``remove`` or ``generalise``.

    Null and empty texts have empty arrays.  Repeated rows are kept and judged alike; an empty table gives an empty
    result.  Columns of the input named like a result are replaced, others kept.
    """
    docs = docs.drop(*KINDS)
    based = base_spans(docs)
    terms = checkpoint(disclosing_terms(based, rule))
    if terms.isEmpty():
        return based.withColumn("term", F.array().cast(SPANS))
    names = fresh(based, "_id", "_hash", "_held")
    of_id, of_hash, held_terms = names
    held = checkpoint(
        _holding(docs, terms.select("term")).join(terms, "term")
        .groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("term", "share"))).alias(held_terms))
        .withColumnsRenamed({"doc_id": of_id, "text_hash": of_hash}))
    same = F.col("doc_id").eqNullSafe(F.col(of_id)) & (F.xxhash64("text") == F.col(of_hash))
    joined = based.join(_hint(held, held.agg(F.sum(F.size(held_terms))).first()[0] or 0), same, "left")
    quoted = F.transform(held_terms, lambda h: F.concat(F.lit("\\Q"), h["term"], F.lit("\\E")))
    pattern = F.concat(F.lit("(?<!\\p{L})(?iu:"), F.array_join(quoted, "|"), F.lit(")(?!\\p{L})"))
    share = lambda v: F.get(F.filter(held_terms, lambda h: h["term"] == F.lower(v)), F.lit(0))["share"]
    spans = F.transform(_placed(text_or_empty(), pattern, lambda m: F.lit(True)), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"),
        F.when(share(s["value"]) >= rule.remove, "remove").otherwise("generalise").alias("value")))
    return joined.withColumn("term", F.when(F.col(held_terms).isNotNull(), spans).otherwise(F.array()).cast(SPANS)).drop(*names)


def span_text(*kinds: str) -> Column:
    """kind:start:end of all spans, by kind as listed, then start, joined by commas."""
    return F.array_join(_of_all(kinds, lambda k, s: F.concat(F.lit(k + ":"), s["start"], F.lit(":"), s["end"])), ",")


def sanitise(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """``docs`` with cleaned texts: ``[EMAIL]`` and the like for the patterns, ``[TERM]`` or nothing for words.

    Overlapping spans become one, named by the first of them.  ``n_chars``, where present, is counted anew in
    changed texts.  Nulls stay null, and so do texts without a finding; the columns stay those of the input.
    """
    own = docs.columns
    clash = [c for c in own if c.lower() in KINDS]
    aside = dict(zip(clash, fresh(docs, *[f"_own_{c}" for c in clash]), strict=True))
    marked = find_private(docs.withColumnsRenamed(aside), rule)
    all_spans, new_text = fresh(marked, "_spans", "_new")
    label = lambda k, s: F.when(s["value"] == "remove", "").otherwise(f"[{k.upper()}]") if k == "term" else F.lit(f"[{k.upper()}]")
    spans = F.sort_array(_of_all(KINDS, lambda k, s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), label(k, s).alias("label"))))
    t = F.col("text")
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda acc, s: F.when(s["end"] <= acc["at"], acc).when(
        s["start"] < acc["at"], F.struct(acc["out"].alias("out"), s["end"].alias("at"))).otherwise(
        F.struct(F.concat(acc["out"], F.substring(t, acc["at"] + 1, s["start"] - acc["at"]), s["label"]).alias("out"),
                 s["end"].alias("at")))
    last = lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.length(t)))
    changed = F.size(all_spans) > 0
    out = marked.withColumn(all_spans, spans).withColumn(
        new_text, F.when(changed, F.aggregate(all_spans, zero, step, last)).otherwise(t))
    result = {"text": F.col(new_text)}
    if "n_chars" in own:
        result["n_chars"] = F.when(changed, F.length(new_text).cast("bigint")).otherwise(F.col("n_chars"))
    out = out.withColumns(result).drop(all_spans, new_text, *KINDS)
    return out.withColumnsRenamed({v: k for k, v in aside.items()}).select(*own)
