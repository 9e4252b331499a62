"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.llm import (
    alignment,
    chat,
    context_mixing,
    decontamination,
    merkle,
    multi_index,
    order_minhash,
    packing,
    pieces,
    pii,
    quality,
    substring_dedup,
    url_filters,
)
from gridtally.llm.common import id_bucket, table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learnt from the labelled ones outside the held-out third."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(id_bucket(F.col("doc_id"), 3) == 1, F.lit(False))
    scored = quality.classify(docs.select("doc_id", "text", "n_chars"), labels, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL against the site rules and the pattern rules."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict", "pattern")


def _best_sql(kind: str, field: str) -> str:
    """CASE over the rules, best first: the longest host and path rule, the first pattern by name."""
    rules = [r for r in url_filters.SITE_RULES + url_filters.PATTERN_RULES if r.kind == kind]
    rules.sort(key=lambda r: (-len(r.name) if kind == "prefix" else 0, r.name))
    subject = "host || path" if kind == "prefix" else "low"
    tests = " ".join(f"WHEN regexp_matches({subject}, '{r.regex}') THEN '{getattr(r, field)}'" for r in rules)
    return f"CASE {tests} END"


OP2_SQL = f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(url, ''), '{url_filters.UPPER}', '{url_filters.LOWER}') AS low,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   '{url_filters.UPPER}', '{url_filters.LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages)
SELECT page_id, host, path, {_best_sql("prefix", "name")} AS rule, {_best_sql("pattern", "name")} AS pattern,
       coalesce({_best_sql("prefix", "verdict")}, {_best_sql("pattern", "verdict")}, 'allow') AS verdict
FROM parts
"""


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows that stand earlier as well."""
    done = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


#: Fixed value: the conversation that the chat query adds.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted; the columns are read back from the windows."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], "conv_id bigint, turn bigint, role string, text string")
    windows = chat.format_conversations(turns.unionByName(added))

    def read(frames: Iterator) -> Iterator:
        for f in frames:
            back = [chat.read_window(t, [(m["start"], m["end"]) for m in mask], n)
                    for t, mask, n in zip(f["text"], f["mask"], f["repeated"], strict=True)]
            f["n"] = [len(turns) for turns, _ in back]
            f["turns"] = ["".join(f"{role}\n{text}\n" for role, text in turns) for turns, _ in back]
            f["targets"] = [loss for _, loss in back]
            f["chars"] = f["text"].str.len()
            yield f[["conv_id", "block", "window", "n", "turns", "targets", "chars"]]

    parts = windows.mapInPandas(
        read, "conv_id bigint, block bigint, window int, n bigint, turns string, targets string, chars bigint")
    whole = parts.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows"),
        F.sort_array(F.collect_list(F.struct("block", "window", "turns", "targets"))).alias("w"))
    joined = whole.withColumns({"turns": F.array_join("w.turns", ""), "targets": F.array_join("w.targets", "")})
    return joined.select(
        "conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"),
        F.length("targets").cast("bigint").alias("loss_chars"), F.sha2("targets", 256).alias("loss_sha256"),
        "formatted_chars", "n_windows")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and places of the patterns, and of the words that disclose them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_private(docs)
    base = pii.KINDS[:4]
    return found.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in base],
        F.sha2(pii.span_text(*base), 256).alias("base_sha256"), pii.span_text(*pii.KINDS).alias("spans"),
        F.size("term").cast("bigint").alias("n_term"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near copies."""
    return order_minhash.near_classes(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text_hash")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item, one row for each of both."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.overlaps(docs, items).drop("text_key")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of 2048 ids."""
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings with their near duplicates at a cosine of 0.95."""
    return multi_index.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log probability under the model of nine tenths of them, beside that of single words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_bucket(F.col("doc_id"), 10) == 0, F.lit(False))
    model, words = context_mixing.train(docs.where(~held_out))
    return context_mixing.score(docs, model, words, trained=~held_out).withColumn("held_out", held_out)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with places in its text, and decoded again; ``covered_bytes`` are those that pieces stand for."""
    done = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"),
                         outputs=("n_tokens", "ids_bytes", "decoded", "covered_bytes"))
    return done.select("doc_id", "n_tokens", F.sha2("ids_bytes", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"), "covered_bytes")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the manifest, checked against it; the text of every fifth one, by its id, was changed."""
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    done = merkle.manifest(docs, tampered=id_bucket(F.col("doc_id"), 5) == 0)
    return done.withColumn("proof_sha256", merkle.proof_digest(F.col("path"))).drop("path")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens of two vocabularies in groups that end together, and how often their links occur anywhere."""
    return alignment.aligned_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_classifier, op2_url_filters, op3_substring_dedup, op4_chat_formatting, op5_pii,
        op6_minhash_near_dedup, op7_decontamination, op8_best_fit_packing, op9_embedding_near_dedup, op10_lm_scoring,
        op11_sentencepiece, op12_merkle_manifest, op13_tokenizer_alignment)}

def _merkle_sql(levels: int) -> str:
    """The manifest level by level: lists of digests per run, each leaf folded with its own run's list."""
    fields = ", ".join(
        f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in merkle.FIELDS)
    lowered = fields.replace("CAST(text AS VARCHAR)", f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')")
    steps = []

    def grow(name: str, nodes: str) -> None:
        """CTEs ``{name}0`` to ``{name}{levels}`` (tree, idx, n, d) and the runs ``{name}r{k}`` (tree, idx, n, ds) of level k."""
        steps.append(f"{name}0 AS ({nodes})")
        for k in range(levels):
            steps.append(f"{name}r{k} AS (SELECT tree, idx // {merkle.ARITY} AS idx, n, list(d ORDER BY idx) AS ds "
                         f"FROM {name}{k} WHERE n > 1 GROUP BY tree, idx // {merkle.ARITY}, n)")
            steps.append(f"{name}{k + 1} AS (SELECT tree, idx, (n + {merkle.ARITY - 1}) // {merkle.ARITY} AS n, "
                         f"sha256(array_to_string(ds, '')) AS d FROM {name}r{k} UNION ALL SELECT * FROM {name}{k} WHERE n = 1)")

    def fold(name: str, first: str, leaf_tree: str) -> str:
        """CTEs that fold rows of ``first`` (tree, idx, f, proof, ...) through the runs of ``name``."""
        before = first
        for k in range(levels):
            steps.append(f"""{name}f{k} AS (
              SELECT a.* EXCLUDE (idx, f, proof), CASE WHEN r.ds IS NULL THEN a.idx ELSE a.idx // {merkle.ARITY} END AS idx,
                CASE WHEN r.ds IS NULL THEN a.f ELSE sha256(array_to_string(
                  list_transform(r.ds, lambda d, i: CASE WHEN i = a.idx % {merkle.ARITY} + 1 THEN a.f ELSE d END), '')) END AS f,
                CASE WHEN r.ds IS NULL THEN a.proof ELSE a.proof || array_to_string(
                  list_transform(r.ds, lambda d, i: CASE WHEN i = a.idx % {merkle.ARITY} + 1 THEN '' ELSE d END), '') END AS proof
              FROM {before} a LEFT JOIN {name}r{k} r ON r.tree = a.{leaf_tree} AND r.idx = a.idx // {merkle.ARITY})""")
            before = f"{name}f{k}"
        return before

    crc = ("xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, strlen(t) + 1), lambda i: ascii(t[i])::BIGINT), "
           "lambda c, b: list_reduce([xor(c, b)] || list_transform(range(8), lambda z: z::BIGINT), "
           "lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)")
    steps.append(f"""leaves AS (
      SELECT doc_id, coalesce('=' || source, '') AS tree, sha256(concat({fields})) AS leaf,
             CASE WHEN {crc} % 5 = 0 THEN sha256(concat({lowered})) END AS now
      FROM (SELECT *, CAST(doc_id AS VARCHAR) AS t FROM documents))""")
    steps.append("""placed AS (
      SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
             count(*) OVER (PARTITION BY tree) AS n FROM leaves)""")
    grow("s", "SELECT tree, idx, n, leaf AS d FROM placed")
    grow("t", f"""SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n, d, tree AS name
                  FROM s{levels}""".replace(", tree AS name", ""))
    steps.append(f"top AS (SELECT tree AS name, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM s{levels})")
    steps.append("start AS (SELECT doc_id, leaf, tree, idx, coalesce(now, leaf) AS f, '' AS proof FROM placed)")
    low = fold("s", "start", "tree")
    steps.append(f"""rise AS (SELECT a.doc_id, a.leaf, '' AS tree, top.subroot, top.place AS idx, a.f, a.proof
                             FROM {low} a JOIN top ON top.name = a.tree)""")
    high = fold("t", "rise", "tree")
    return f"""WITH {", ".join(steps)}
      SELECT doc_id, leaf, subroot, (SELECT d FROM t{levels}) AS root, sha256(proof) AS proof_sha256,
             f AS folded_root, f = (SELECT d FROM t{levels}) AS verified FROM {high}"""


#: Four levels: sources of 65,536 documents at most, which the scales with SQL checks don't exceed.
ORACLES = {"op2_url_filters": OP2_SQL, "op12_merkle_manifest": _merkle_sql(4)}
