"""URLs, conversations, vectors and the pipeline against plain versions, and their odd inputs."""

import random
import re

import numpy as np
import pytest
from brute import classes, overlap_items, private_spans, sha
from compare import duck, same
from pyspark.sql import functions as F

import corpus_pipeline
from gridtally.llm import chat, decontamination, multi_index, order_minhash, pii, quality, queries, url_filters

SF = "/root/testdata/sf0.001"


# URL filters

def test_urls_against_sql(shared):
    assert same(queries.op2_url_filters(shared, SF), duck(SF), queries.ORACLES["op2_url_filters"]) is None


def judge(shared, urls, **options):
    pages = shared.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string")
    return {r["url"]: r for r in url_filters.judge_urls(pages, **options).collect()}


def test_site_rules(shared):
    got = judge(shared, [
        "http://a.ORG/x", "http://org/", "http://xorg/", "https://www.example.org/es/1", "https://example.org/es", "//example.org/es/",
        "http://example.org/en/1", "http://m.example.org/en/19?x", "http://example.org/en/2", "http://b.com/fr/", "http://b.com/de/#top",
        "http://b.com/en/", "http://org", "x://a://org/", "http://casino.example.net/", "http://a.org/login", "ÀB://É.Org/?q",
        None, "", "http://", "http://a.org:80/", "mailto:a@b.org"])
    rule = {u: r["rule"] for u, r in got.items()}
    assert rule["http://a.ORG/x"] == rule["http://org/"] == rule["https://example.org/es"] == rule["http://example.org/en/2"] == "org/"
    assert rule["https://www.example.org/es/1"] == "example.org/es/" and rule["http://m.example.org/en/19?x"] == "example.org/en/1"
    assert rule["http://b.com/fr/"] == "com/fr/" and rule["http://b.com/de/#top"] == "com/de/"
    for u in ("http://xorg/", "//example.org/es/", "http://b.com/en/", "http://org", "x://a://org/", None, "", "http://",
              "http://a.org:80/", "mailto:a@b.org"):
        assert rule[u] is None, u
    assert got["http://casino.example.net/"]["verdict"] == "block" and got["http://a.org/login"]["verdict"] == "allow"
    assert (got["x://a://org/"]["host"], got["x://a://org/"]["path"]) == ("a:", "//org/")
    assert [got["ÀB://É.Org/?q"][c] for c in ("host", "path", "rule")] == ["É.org", "/", "org/"]
    assert [got[None][c] for c in ("host", "path", "verdict")] == ["", "", "allow"]


def test_rules_are_filed_under_their_rarest_literal(shared):
    pages = shared.createDataFrame([(i, f"http://site{i}.com/shop/item") for i in range(20)] + [(99, "http://x.net/zebra/item")],
                                   "page_id bigint, url string")
    rule = url_filters.Rule("odd", "block", "/zebra/item$", ("item", "zebra"))
    assert url_filters.rarest_literals(pages, [rule]) == {"item": 21, "zebra": 1}
    got = url_filters.judge_urls(pages, [rule], default="keep").groupBy("verdict").count().collect()
    assert {r["verdict"]: r["count"] for r in got} == {"block": 1, "keep": 20}


def test_url_odd_rows(shared):
    pages = shared.createDataFrame([(1, "http://a.org/", "x"), (1, "http://a.org/", "x"), (None, None, None)],
                                   "page_id bigint, url string, verdict string")
    rows = url_filters.judge_urls(pages).collect()
    assert sorted((r["page_id"] or 0, r["verdict"]) for r in rows) == [(0, "allow"), (1, "allow"), (1, "allow")]
    assert url_filters.judge_urls(pages.limit(0)).collect() == []
    assert url_filters.judge_urls(pages.select("url"), rules=()).count() == 3
    long = shared.createDataFrame([(1, "http://a.org/" + "a/" * 20_000)], "page_id bigint, url string")
    assert url_filters.judge_urls(long).first()["rule"] == "org/"


# Chat formatting

@pytest.mark.parametrize("text", [
    "", "plain", "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\nx", "<\\|im_end|>", "<\\\\|im_end|>\\", "[[INST]<<SYS>>", "<s><\\s><<s>",
    "\\", "a\nb<|im_start|>", "<<\\</SYS>>"])
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and chat.unescape_role(chat.escape_role(text)) == text
    assert not re.search(r"<\|im_(start|end)\|>|</?s>|\[/?INST\]", chat.escape(text))
    assert "\n" not in chat.escape_role(text)
    turns, _ = chat.read_window(chat.render(text, text) + chat.render("user", "x"), [], 0)
    assert turns == [(text, text), ("user", "x")]


def test_escapes_of_random_texts():
    rng = random.Random(3)
    parts = ["<", "|", "im_end", "|>", "\\", "[", "INST]", "/INST]", "s>", "/s>", "</SYS>>", "\n", "a", "<|im_start|>"]
    for _ in range(3000):
        t = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        assert chat.unescape(chat.escape(t)) == t
        assert chat.read_window(chat.render("r" + t, t), [], 0)[0] == [("r" + t, t)]


def digests(rows):
    """conv -> what the query must give; rows: (conv, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
        loss = "".join(t or "" for _, role, t in own if role == "assistant")
        out[conv] = (len(own), sha("".join(f"{role or ''}\n{t or ''}\n" for _, role, t in own)), len(loss), sha(loss))
    return out


def test_conversations_read_back(shared):
    rows = [tuple(r) for r in shared.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", queries.CONTROL_TEXT), (-7, 1, "assistant", queries.CONTROL_TEXT)]
    got = {r["conv_id"]: tuple(r[c] for c in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256"))
           for r in queries.op4_chat_formatting(shared, SF).collect()}
    assert got == digests(rows)


def test_windows_of_long_and_odd_conversations(shared):
    rng = random.Random(1)
    rows = [(1, t, ["user", "assistant"][t % 2], " ".join(rng.choices(["word", "an", "<|im_end|>"], k=rng.randint(0, 40)))) for t in range(1, 160)]
    rows += [(1, 0, "system", "be brief")]
    rows += [(2, 0, "system", "alone")]
    rows += [(3, 5, "assistant", None), (3, None, "user", "x"), (3, 5, "assistant", None), (3, 5, None, "tie")]
    rows += [(None, 1, "user", "no conversation"), (4, 2000, "assistant", "far " * 700), (4, 1, "user", "q"), (4, 3000, "system", "late")]
    turns = shared.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, window string")
    budget = chat.Budget(window=200, history=50, least=60, block=2)
    windows = chat.format_conversations(turns, budget).orderBy("conv_id", "block", "window").collect()
    assert max(w["tokens"] for w in windows if w["conv_id"] == 1) <= 200 + 100
    got = {}
    for w in windows:
        new, loss = chat.read_window(w["text"], [(m["start"], m["end"]) for m in w["mask"]], w["repeated"])
        have = got.setdefault(w["conv_id"], ([], []))
        have[0].extend(new)
        have[1].append(loss)
        if w["conv_id"] == 1:
            assert w["text"].startswith(chat.render("system", "be brief"))
    want = digests(rows)
    for conv, (new, loss) in got.items():
        assert (len(new), sha("".join(f"{r}\n{t}\n" for r, t in new)), len("".join(loss)), sha("".join(loss))) == want[conv], conv
    assert got.keys() == want.keys() and sum(w["repeated"] > 1 for w in windows) > 3
    assert chat.format_conversations(turns.limit(0)).collect() == []


# Vectors

def plain_links(rows, least=0.95):
    fine = {i: np.array(v, dtype=float) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for a, x in fine.items():
        for b, y in fine.items():
            if a < b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                out.append((a, b))
    return out


def near(shared, rows, rule=multi_index.Grid()):
    df = shared.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<float>, n_links string")
    return multi_index.near_vectors(df, rule).collect()


def test_vectors_against_plain_version(shared):
    rng = np.random.default_rng(0)
    centers = rng.normal(size=(40, 16))
    rows = [(i, (centers[i % 40] + rng.normal(scale=[0.05, 0.12, 0.3][i % 3], size=16)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)]  # equal vectors
    links = plain_links(rows)
    got = near(shared, rows, multi_index.Grid(block=32))
    degree = {i: sum(i in p for p in links) for i, _ in rows}
    found = sum(r["n_links"] for r in got)
    assert all(r["n_links"] <= degree[r["vec_id"]] for r in got) and found >= 0.97 * 2 * len(links) > 0
    if found == 2 * len(links):
        assert {r["vec_id"]: r["component_id"] for r in got} == classes([i for i, _ in rows], links)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_nearest_cells_are_those_of_least_sum():
    rng = np.random.default_rng(1)
    index = multi_index.Index(rng.normal(size=(7, 3)), rng.normal(size=(6, 3)))
    x = rng.normal(size=(20, 6))
    a, b = index.distances(x)
    sums = (a[:, :, None] + b[:, None, :]).reshape(20, -1)
    for visits in (1, 2, 5, 13, 42, 99):
        cells = index.nearest_cells(x, visits)
        want = np.sort(sums, axis=1)[:, :visits]
        assert np.allclose(np.take_along_axis(sums, cells, 1), want)
        assert (cells[:, 0] == index.own_cells(x)).all()
    assert index.ranks(x[0], index.nearest_cells(x[:1], 42)[0]).tolist() == list(range(1, 43))


def test_forest_connects_what_the_links_connect():
    rng = np.random.default_rng(2)
    for _ in range(50):
        link = rng.random((8, 9)) < 0.15
        nodes = [("r", i) for i in range(8)] + [("c", j) for j in range(9)]
        edges = [(("r", i), ("c", j)) for i, j in np.argwhere(link)]
        forest = [(("r", i), ("c", j)) for i, j in multi_index._forest(link)]
        assert classes(nodes, edges) == classes(nodes, forest) and all(link[i, j] for (_, i), (_, j) in forest)


def unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


@pytest.mark.parametrize("copies", [0, 400])
def test_rare_pairs_are_found_with_and_without_a_tight_group(shared, copies):
    """Pairs just above the threshold, so few that the sampled vectors have hardly a link, or one group has them all."""
    rng = np.random.default_rng(6)
    x = unit(rng.normal(size=(8000, 64)))
    aside = rng.normal(size=(100, 64))
    aside = unit(aside - (aside * x[:100]).sum(1)[:, None] * x[:100])
    pairs = 0.955 * x[:100] + np.sqrt(1 - 0.955**2) * aside
    group = unit(x[-1] + rng.normal(scale=0.001, size=(copies, 64)))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, group]))] + [(20_000 + i, v.tolist()) for i, v in enumerate(pairs)]
    got = {r["vec_id"]: r["n_links"] for r in near(shared, rows, multi_index.Grid(queries=128))}
    assert sum(got[20_000 + i] == 1 for i in range(100)) >= 98


def test_vector_odd_rows(shared):
    big = [3e38] * 8
    rows = [(1, None), (2, []), (3, [0.0] * 4), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]),
            (8, [2.0, 4.0]), (9, [1.0, 2.0, 0.0]), (10, big), (11, [x / 2 for x in big]), (12, [-0.0, 1e-30]), (13, [0.0, 1e-38]), (14, [1.0])]
    got = near(shared, rows)
    assert len(got) == len(rows)
    links = {}
    for r in got:
        links.setdefault(r["vec_id"], []).append((r["n_links"], r["component_id"], r["kept"]))
    assert links[7] == [(2, 7, True)] * 2 and links[8] == [(2, 7, False)]
    assert links[10] == [(1, 10, True)] and links[11] == [(1, 10, False)] and links[12] == [(1, 12, True)] and links[13] == [(1, 12, False)]
    for i in (1, 2, 3, 4, 5, 6, 9, 14):
        assert links[i] == [(0, i, True)]
    assert near(shared, []) == []


# Pipeline

def test_pipeline_stages(shared, tmp_path):
    docs = shared.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in shared.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [r["text"] for r in shared.read.parquet(f"{SF}/benchmark.parquet").collect()]
    words = lambda t: t.lower().translate(str.maketrans("", "", decontamination.PUNCTUATION)).split()
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(shared, seen[-1], SF).write.parquet(str(tmp_path / str(k)))
        seen.append(shared.read.parquet(str(tmp_path / str(k))))
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in seen]
    assert all(d.columns == docs.columns for d in seen[:5])
    assert [i for i, q in labels.items() if q == 1 and i not in ids[1]] == [] and [i for i, q in labels.items() if q == 0 and i in ids[1]] == []
    assert ids[2] < ids[1] and seen[2].select("text").distinct().count() == seen[2].count()
    texts = {r["doc_id"]: r["text"] for r in seen[2].collect()}
    assert {i for i, t in texts.items() if any(overlap_items(words(t), words(x)) for x in items)} == ids[2] - ids[3]
    assert ids[4] == ids[3] == ids[5]
    for r in seen[4].collect():
        assert private_spans(r["text"]) == "" and r["n_chars"] == len(r["text"])
        assert bool(private_spans(texts[r["doc_id"]])) == (r["text"] != texts[r["doc_id"]])
    packed = seen[5].groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert packed.where("n > 2048 OR n <> end").isEmpty()


def test_pipeline_without_documents(shared, tmp_path):
    docs = shared.read.parquet(f"{SF}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(shared, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = shared.read.parquet(str(tmp_path / str(k)))
    assert docs.count() == 0


# Columns of the input

def clashing(documents, rows, names):
    """Documents with further columns, each with a value of its own."""
    df = documents(rows)
    return df.withColumns({n: F.lit(f"own {n}") for n in names})


CLASHES = ["_id", "_hash", "_held", "label", "_name", "_row", "_token", "_kind", "_regex", "_rank", "_in", "node", "key", "keys",
           "component", "term", "email", "_spans", "_new", "_own_email"]


def own_values(rows):
    return all(r[n] == f"own {n}" for r in rows for n in CLASHES)


def test_columns_of_any_name_are_kept(shared, documents):
    words = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(words[i % 3:])) for i in range(6)] + [(9, "mail me at a@b.cd"), (10, None)]
    docs = clashing(documents, rows, CLASHES)
    labels = shared.createDataFrame([(i, i % 2) for i in range(6)], "doc_id bigint, quality int")
    scored = quality.classify(docs, labels)
    assert scored.columns == [*docs.columns, "score", "predicted"] and own_values(scored.collect())
    kept = order_minhash.keep_one(docs)
    assert kept.columns == docs.columns and own_values(kept.collect()) and kept.count() < len(rows)
    assert own_values(decontamination.remove_contaminated(docs, documents([(1, rows[0][1])]).withColumnRenamed("doc_id", "item_id")).collect())
    done = pii.sanitise(docs)
    assert done.columns == docs.columns and own_values(done.collect())
    assert {r["doc_id"]: r["text"] for r in done.collect()}[9] == "mail me at [EMAIL]"
    pages = docs.select("doc_id", F.lit("http://a.org/x").alias("url"), *CLASHES)
    judged = url_filters.judge_urls(pages)
    assert judged.columns == [*pages.columns, "host", "path", "rule", "pattern", "verdict"] and own_values(judged.collect())


def test_terms_with_columns_of_any_name(documents):
    """As above where a word discloses an entity, so that documents are joined with their words."""
    filler = [f"x{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}" for i in range(60)]
    rows = [(i, " ".join(filler[i:i + 12])) for i in range(40)]
    rows += [(100, "one two Quibbelor mail zz@corp.example three"), (101, "four five Quibbelor write zz@corp.example six")]
    docs = clashing(documents, rows, CLASHES)
    found = pii.find_private(docs.drop("term", "email"))
    marked = {r["doc_id"]: len(r["term"]) for r in found.collect()}
    assert marked[100] == marked[101] == 1
    assert all(r["_id"] == "own _id" and r["_held"] == "own _held" for r in found.collect())


def test_contracted_components(shared):
    """Chains, stars and rings against a plain search; names may be any node of the component."""
    from gridtally.llm.common import contracted, further_contracted

    rng = random.Random(4)
    names = [f"{rng.random():.12f}" for _ in range(400)]
    edges = [(names[i], names[i + 1]) for i in range(150)] + [(names[200], names[i]) for i in range(201, 260)]
    edges += [(names[i], names[300 + (i + 1) % 20]) for i in range(300, 320)] + [(names[399], names[399])]

    def plainly(some):
        parent = {n: n for e in some for n in e}

        def root(n):
            while parent[n] != n:
                n = parent[n]
            return n
        for a, b in some:
            parent[root(a)] = root(b)
        groups = {}
        for n in parent:
            groups.setdefault(root(n), set()).add(n)
        return {frozenset(g) for g in groups.values() if len(g) > 1}

    def grouped(labels):
        groups = {}
        for r in labels.collect():
            groups.setdefault(r["component"], set()).add(r["node"])
        assert all(name in g for name, g in groups.items())
        return {frozenset(g) for g in groups.values()}

    frame = lambda some: shared.createDataFrame(some, "a string, b string")
    labels = contracted(frame(edges))
    assert grouped(labels) == plainly(edges)
    more = [(names[0], names[200]), (names[5], names[399]), (names[398], names[397]), (names[1], names[2])]
    assert grouped(further_contracted(labels, frame(more))) == plainly(edges + more)
    assert contracted(frame(edges).limit(0)).collect() == []
    assert grouped(further_contracted(labels, frame(edges).limit(0))) == plainly(edges)


@pytest.fixture
def many_partitions(shared):
    """As many partitions of each shuffle as the check_h run of the check tool has, which adaptive plans don't join."""
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: shared.conf.get(k) for k in conf}
    for k, v in conf.items():
        shared.conf.set(k, v)
    yield shared
    for k, v in before.items():
        shared.conf.set(k, v)


def test_few_edges_take_few_partitions(many_partitions):
    from gridtally.llm.common import ROWS_OF_PARTITION, contracted, further_contracted, gathered

    edges = many_partitions.createDataFrame([("a", f"b{i}") for i in range(20)] + [("c", "d")], "a string, b string")
    labels = contracted(edges)
    assert labels.count() == 23 and labels.rdd.getNumPartitions() == 1
    labels = further_contracted(labels, many_partitions.createDataFrame([("a", "x"), ("y", "z")], "a string, b string"))
    assert labels.count() == 26 and labels.rdd.getNumPartitions() == 1
    many = many_partitions.range(0, 10, 1, 64)
    assert gathered(many, 3 * ROWS_OF_PARTITION + 1).rdd.getNumPartitions() == 4
    assert gathered(many, 0).rdd.getNumPartitions() == 1
    assert gathered(many, 10**9).rdd.getNumPartitions() == 64


def test_near_classes_files_follow_the_rows(many_partitions):
    """A small table leaves few files, whatever the number of shuffle partitions."""
    from pathlib import Path
    from urllib.parse import urlparse

    from gridtally.llm import order_minhash

    rng = random.Random(6)
    base = [" ".join(rng.choices("abcdefghijklmnop", k=60)) for _ in range(5)]
    rows = [(i, f"{base[i % 5]} end {i // 5}") for i in range(40)]
    folder = Path(urlparse(many_partitions.sparkContext.getCheckpointDir()).path)
    files = lambda: sum(1 for _ in folder.rglob("part-*"))
    before = files()
    got = order_minhash.near_classes(many_partitions.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: i % 5 for i in range(40)}
    assert files() - before < 800
