"""Operators on documents against plain versions, and the odd inputs each of them must bear."""

import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest
from brute import classes, kmers, overlap_items, private_spans, removed, sha, similar, unigram
from pyspark.sql import functions as F

from gridtally.llm import context_mixing, decontamination, order_minhash, packing, pii, quality, queries, substring_dedup
from gridtally.llm.common import components
from gridtally.llm.tokens import Encoder, default_vocabulary

SF = "/root/testdata/sf0.001"
VOCABULARY = ["".join(random.Random(i).choices("abcdefghijklm", k=6)) for i in range(400)]


def prose(seed, n):
    return random.Random(seed).choices(VOCABULARY, k=n)


def text(seed, n):
    return " ".join(prose(seed, n))


def edited(words, n, seed):
    rng, words = random.Random(seed), list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"other{seed}x{i}"
    return words


ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "a"), (5, "x" * 30_000), (6, text(6, 30)), (6, text(6, 30)), (None, text(7, 30)),
       (8, "é \U0001f600 \x00 \x1c ß"), (9, "1 2 3 " * 3000)]


def test_components_of_a_chain_a_star_and_nothing(shared):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000 + i, 500) for i in range(200)]
    edges = shared.createDataFrame([*chain, *star, (7, 7), (3, 2)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {500: 500} | {1000 + i: 500 for i in range(200)}
    assert components(edges.limit(0)).collect() == []


# Substring dedup

def repeats(docs):
    return [r.asDict() for r in substring_dedup.remove_repeats(docs).collect()]


def test_cover_meets_every_shift():
    cover, period = substring_dedup.COVER, substring_dedup.PERIOD
    for shift in range(period):
        assert any((c + shift) % period in cover for c in cover)


def test_repeats_against_plain_version(sample):
    rows = [(r["doc_id"], r["text"]) for r in sample.collect()]
    want = removed(rows)
    got = queries.op3_substring_dedup(sample.sparkSession, SF).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == want


@pytest.mark.parametrize("seed", range(3))
def test_planted_repeats(documents, seed):
    rng = random.Random(seed)
    passage = prose(seed, 60)
    rows = []
    for i in range(40):
        words = prose(1000 * seed + i, rng.randint(0, 80))
        at, n = rng.randint(0, len(words)), rng.randint(15, 60)
        begin = rng.randint(0, 60 - n)
        rows.append((i, " ".join(words[:at] + passage[begin:begin + n] + words[at:])))
    rows += [(100 + i, rows[0][1]) for i in range(30)]  # exact copies
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], sha(r["text"])) for r in repeats(documents(rows).repartition(5))}
    assert got == removed(rows)


def test_repeats_odd_rows(documents, shared):
    got = repeats(documents(ODD))
    assert len(got) == len(ODD)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["n_words"] == by_id[2]["n_words"] == by_id[3]["n_words"] == 0 and by_id[3]["text"] == ""
    assert by_id[9]["n_words"] == 9000 and by_id[9]["n_removed"] == 8997  # a period of three words
    assert [r["n_removed"] for r in got if r["doc_id"] == 6] == [0, 0]  # rows of one id don't remove each other
    assert repeats(documents([])) == []
    # One id, two texts: the later words of the one may not be cut from the other.
    two = documents([(1, text(1, 40)), (2, text(1, 40)), (2, text(2, 40))])
    assert sorted((r["doc_id"], r["n_removed"]) for r in repeats(two)) == [(1, 0), (2, 0), (2, 40)]


def test_rows_without_an_id_spread_by_text(documents):
    """Passages at other places go from all but the first; the rows are dealt out by their texts."""
    passage = text(5, 25)
    rows = [(None, " ".join(f"own{i}x{j}" for j in range(i % 7 + 1)) + " " + passage) for i in range(60)] + [(3, passage)]
    done = substring_dedup.remove_repeats(documents(rows))
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc" in plan and not re.search(r"hashpartitioning\(doc#\d+L?, \d", plan)
    got = done.collect()
    assert sorted({(r["doc_id"] is None, r["n_removed"]) for r in got}) == [(False, 0), (True, 25)] and len(got) == 61


def test_repeated_ranges(documents):
    rows = [(1, text(1, 50)), (2, "new words " + text(1, 30) + " at the end")]
    second = next(r for r in repeats(documents(rows)) if r["doc_id"] == 2)
    assert second["text"] == "new words at the end" and [tuple(s) for s in second["removed"]] == [(2, 32)]


# Order MinHash

def test_similarity_is_the_longest_chain():
    for seed in range(30):
        rng = random.Random(seed)
        a = rng.choices("abcde", k=rng.randint(5, 60))
        b = edited(a, rng.randint(0, 3), seed)
        if seed % 3 == 0:
            del b[1:3]
        if seed % 4 == 0:
            b = b[10:] + b[:10]
        h = [order_minhash.labelled(order_minhash.Words([" ".join(x).encode()]))[0] for x in (a, b)]
        want = similar(" ".join(a), " ".join(b))
        assert order_minhash.similarity(*h, 0.3) == pytest.approx(want) or want < 0.3
        assert len(h[0]) == len(kmers(" ".join(a)))


def near(docs):
    return {r["doc_id"]: r for r in order_minhash.near_classes(docs).collect()}


def test_near_classes_against_plain_version(documents):
    rows, base = [], [prose(s, 120) for s in range(6)]
    for i in range(90):
        rows.append((i, " ".join(edited(base[i % 6], [0, 1, 2, 3, 5, 9][i % 5], i))))
    pairs = [(a, b) for a, x in rows for b, y in rows if a < b and similar(x, y) >= 0.8]
    got = near(documents(rows))
    assert {i: r["class_id"] for i, r in got.items()} == classes([i for i, _ in rows], pairs)
    assert all(r["kept"] == (i == r["class_id"]) for i, r in got.items())


def test_large_group_of_near_copies_is_one_class(documents):
    base = prose(1, 200)
    rows = [(0, " ".join(base)), *[(i, " ".join(edited(base, 2, i))) for i in range(1, 300)], (999, text(5, 200))]
    got = near(documents(rows))
    assert {r["class_id"] for i, r in got.items() if i < 300} == {0} and got[999]["class_id"] == 999


def test_blocks_of_a_bucket_see_all_pairs(documents):
    rows = [(i, " ".join(edited(prose(1, 100), 4, i))) for i in range(25)]
    rows += [(100 + i, " ".join(edited(rows[i][1].split(), 1, 100 + i))) for i in range(25)]
    rule = order_minhash.Near(block=4)
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_classes(documents(rows), rule).collect()}
    pairs = [(a, b) for a, x in rows for b, y in rows if a < b and similar(x, y) >= 0.8]
    assert got == classes([i for i, _ in rows], pairs)


def test_near_classes_odd_rows(documents):
    docs = documents(ODD)
    got = order_minhash.near_classes(docs).collect()
    assert len(got) == len(ODD)
    assert {r["class_id"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}  # no words: copies
    assert [r["copies"] for r in got if r["doc_id"] == 6] == [2, 2]
    kept = order_minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [
        (False, 1), (False, 4), (False, 5), (False, 6), (False, 8), (False, 9), (True, 0)]
    assert near(documents([])) == {}
    clash = docs.withColumnsRenamed({"lang": "class_id", "source": "kept"})
    assert order_minhash.keep_one(clash).columns == clash.columns


# Decontamination

def test_masks_find_every_window_with_two_substitutions():
    window = decontamination.WINDOW
    for a in range(window):
        for b in range(a, window):
            assert any(not {a, b} & {s + o for o in mask} for mask in decontamination.MASKS
                       for s in range(window - mask[-1]))


def test_overlaps_against_plain_version(shared, sample):
    items = shared.read.parquet(f"{SF}/benchmark.parquet")
    strip = str.maketrans("", "", decontamination.PUNCTUATION)
    words = lambda t: (t or "").lower().translate(strip).split()
    want = {(d["doc_id"], i["item_id"]) for d in sample.collect() for i in items.collect()
            if overlap_items(words(d["text"]), words(i["text"]))}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op7_decontamination(shared, SF).collect()}
    assert got == want and want


def test_substituted_passages(shared, documents):
    item = prose(1, 40)
    items = shared.createDataFrame([(7, " ".join(item)), (8, "short one here"), (9, None), (10, "")], "item_id bigint, text string")
    rows = [(1, text(2, 50) + " " + " ".join(item) + " " + text(3, 9)),
            (2, " ".join(["x", *item[4:17], "y"])), (3, " ".join(["x", *item[4:16], "y"])),
            (4, " ".join(edited(item[10:23], 2, 1))), (5, " ".join(edited(item[10:23], 3, 1))),
            (6, "This: SHORT one, here!"), (7, text(9, 300)), (8, None), (8, "")]
    docs = documents(rows).withColumnsRenamed({"lang": "item_id"})
    got = {(r["doc_id"], r["item_id"], r["agreeing"]) for r in decontamination.overlaps(docs, items).collect()}
    assert got == {(1, 7, 13), (2, 7, 13), (3, 7, 12), (4, 7, 11), (6, 8, 3)}
    clean = decontamination.remove_contaminated(docs, items)
    assert clean.columns == docs.columns and sorted(r["doc_id"] for r in clean.collect()) == [5, 7, 8, 8]
    assert decontamination.overlaps(documents([]), items).collect() == []
    assert decontamination.overlaps(docs, items.limit(0)).collect() == []


def test_shuffled_seeds_give_the_same(shared, sample, monkeypatch):
    items = shared.read.parquet(f"{SF}/benchmark.parquet")
    before = sorted(decontamination.overlaps(sample, items).collect())
    monkeypatch.setattr(decontamination, "MAX_BROADCAST_SEEDS", 0)
    assert sorted(decontamination.overlaps(sample, items).collect()) == before


def test_decontamination_odd_rows(shared, documents):
    items = shared.createDataFrame([(1, text(6, 30))], "item_id bigint, text string")
    got = decontamination.overlaps(documents(ODD), items).collect()
    assert [(r["doc_id"], r["item_id"]) for r in got] == [(6, 1)]


# Personal data

TRICKY = [
    "a@b.c_d@e.f x@y x@y.z.w, 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "+1 (386) 555-3733 +12345678 +1 2 3 4 5 6 7 8 9 +123456789012345678", "é\U0001f600a@b.cd " * 3, "1 " * 500 + "a" * 500,
    "..@..", "x%+-@a-.-b..c", "4" * 40, "+4111111111111111", ".a@b.c.", "0 0 0 0 0 0 0 0 0 0 0 0 0", "", " \n", "10.0.0.1.", "٣@b.c ١.٢.٣.٤"]


def spans(docs):
    return {r["doc_id"]: r["s"] for r in pii.find_private(docs).withColumn("s", pii.span_text(*pii.KINDS)).collect()}


def test_base_spans_against_plain_version(documents, sample):
    rng = random.Random(5)
    rows = list(enumerate(TRICKY))
    rows += [(100 + i, "".join(rng.choices("ab1239.@+-_% ()é\n", k=rng.randint(0, 80)))) for i in range(400)]
    assert spans(documents(rows)) == {i: private_spans(t) for i, t in rows}
    rows = {r["doc_id"]: private_spans(r["text"]) for r in sample.collect()}
    got = queries.op5_pii(sample.sparkSession, SF).collect()
    assert {r["doc_id"]: (r["spans"], r["base_sha256"]) for r in got} == {i: (s, sha(s)) for i, s in rows.items()}


def telling(n=12):
    """An address whose owner's nickname always stands beside it, in different surroundings."""
    rows = [(i, f"{text(i, 12)} write to Zorblax, mail zb@corp.example and {text(50 + i, 12)}") for i in range(n)]
    rows += [(100 + i, text(200 + i, 40) + " write to") for i in range(300)]
    return [*rows, (900, "What did ZORBLAX do?")]


def test_terms_that_disclose_an_entity(documents):
    got = spans(documents(telling()))
    t = dict(telling())
    for i in (0, 5, 900):
        at = t[i].lower().index("zorblax")
        assert f"term:{at}:{at + 7}" in got[i]
    assert not any("term" in got[i] for i in got if 100 <= i < 400)
    # Many copies of one text are one surrounding, and disclose nothing.
    assert not any("term" in s for s in spans(documents([(i, t[0]) for i in range(12)] + telling()[12:])).values())


def test_two_surroundings_disclose_and_one_does_not(documents):
    rows = [(i, text(300 + i, 40) + " write to") for i in range(300)]
    rows += [(900 + i, f"{text(700 + i, 15)} write to Quibbelor, call +1 (386) 555-3733 or {text(800 + i, 15)}") for i in range(2)]
    rows += [(950, f"{text(750, 15)} write to Wimblent, call +1 (386) 555-4844 or {text(850, 15)}")]
    rows += [(960 + i, f"{text(760 + i, 15)} ask Ostrafel, mail of@corp.example {text(860 + i, 15)}") for i in range(2)]
    rows += [(970 + i, f"{text(770 + i, 15)} Ostrafel") for i in range(40)]  # mostly elsewhere
    got, t = spans(documents(rows)), dict(rows)

    def marked(i, word):
        at = t[i].index(word)
        return f"term:{at}:{at + len(word)}" in got[i]
    assert marked(900, "Quibbelor") and marked(901, "Quibbelor") and not marked(900, "write")
    assert not marked(950, "Wimblent") and not marked(960, "Ostrafel") and not marked(975, "Ostrafel")


def test_sanitised_texts(documents):
    rows = [(1, "mail zb@corp.example now 4111 1111 1111 1111"), (2, "call +1 (386) 555-3733!"), (3, None), (4, "nothing"), (4, "nothing")]
    docs = documents(rows).withColumnsRenamed({"lang": "email", "source": "term"})
    done = pii.sanitise(docs)
    assert done.columns == docs.columns
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in done.collect()}
    assert got == {1: ("mail [EMAIL] now [CARD]", 23), 2: ("call [PHONE]!", 13), 3: (None, None), 4: ("nothing", 7)}
    assert done.count() == 5
    told = {r["doc_id"]: r["text"] for r in pii.sanitise(documents(telling())).collect()}
    assert "zorblax" not in told[900].lower() and "zb@corp" not in told[3] and "write to" in told[3]


def test_overlapping_spans_become_one(documents):
    row = "see +4111111111111111 or 1.2.3.4@b.c"
    assert pii.sanitise(documents([(1, row)])).first()["text"] == "see +[CARD] or [IP]"
    found = spans(documents([(1, row)]))[1]
    assert found == private_spans(row)


def test_private_data_odd_rows(documents):
    assert spans(documents(ODD[:5])) == {i: "" for i in range(1, 6)}
    assert spans(documents([])) == {}
    assert pii.sanitise(documents(ODD)).count() == len(ODD)


def test_disclosure_by_shuffle_joins(documents, monkeypatch):
    docs = documents(telling())
    before = spans(docs)
    monkeypatch.setattr(pii, "MAX_BROADCAST_TERMS", 0)
    assert spans(docs) == before


# Packing

def test_cached_pieces_give_the_ids_of_whole_texts(sample):
    encoder = Encoder(default_vocabulary())
    texts = [r["text"] for r in sample.collect()] + [
        "", " ", "  ", " a", "a ", "a  b", "a \nb", "a\n b c", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>c ",
        "don't it 's", "é  x", "x  y z", "a\tb c", "x\x1cy z \x1c", "\r\n a b", "1 234 5,6", "\U0001f600 \U0001f600 a", "a <| b"]
    for _ in range(2):
        for t, ids in zip(texts, encoder.many(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    bins = packing.BestFit(10, open_bins=2)
    assert [bins.add(n) for n in (6, 7, 3, 2)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    assert bins.still_open() == {0: 8}
    bins = packing.BestFit(10, open_bins=2)
    for n in (6, 7, 8):
        bins.add(n)
    assert bins.still_open() == {0: 6, 2: 8} or bins.still_open() == {0: 6, 1: 7}


def packed_well(rows, docs, capacity):
    encoder = Encoder(default_vocabulary())
    want = sorted((-1 if i is None else i, len(encoder.many([t or ""])[0]) // 4 + 1) for i, t in docs)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((-1 if r["doc_id"] is None else r["doc_id"]), []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted((i, n) for i, n in want) == sorted(
        (i, n) for i, pieces in by_doc.items() for n in [sum(p["length"] for p in pieces)]) or len({i for i, _ in want}) < len(want)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), sum(n for _, n in want)


def test_packing(shared, sample):
    docs = [(r["doc_id"], r["text"]) for r in sample.collect()]
    rows = packing.pack(sample.repartition(7), keep_ids=True).collect()
    sequences, tokens = packed_well(rows, docs, 2048)
    assert sequences <= tokens / 2048 * 1.03 + 1
    texts, encoder = dict(docs), Encoder(default_vocabulary())
    for r in rows:
        ids = np.append(np.frombuffer(encoder.many([texts[r["doc_id"]]])[0], "<u4"), 0).astype("<u4")
        own = ids[r["start"]:r["start"] + r["length"]]
        assert r["ids"] == own.tolist() and r["ids_crc32"] == zlib.crc32(own.tobytes())
        assert r["length"] == 2048 or r["piece"] == 0
        assert len(ids) > 2048 or r["length"] == len(ids)


def test_packing_odd_rows(documents):
    rows = packing.pack(documents(ODD), capacity=64).collect()
    packed_well(rows, ODD, 64)
    assert [(r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] in (1, 2)] == [(1, zlib.crc32(bytes(4)))] * 2
    assert sum(r["piece"] == 0 for r in rows) == len(ODD)
    assert packing.pack(documents([])).collect() == []


# Quality

def test_sum_of_squares_identity():
    machine = quality.Machine(30, 3, seed=1)
    machine.linear[:] = np.arange(30) / 10
    index, value = np.array([1, 4, 9, 20]), np.array([0.5, 1.0, 2.0, 0.1])
    pairs = sum(machine.factors[index[i]] @ machine.factors[index[j]] * value[i] * value[j] for i in range(4) for j in range(i))
    want = (machine.linear[index] * value).sum() + pairs
    assert machine.logits(index, value, np.array([0]))[0][0] == pytest.approx(want)


def test_gradient_by_differences():
    rng = np.random.default_rng(0)
    index, value, first = rng.integers(0, 6, 12), rng.random(12), np.array([0, 5, 8])
    label = np.array([1.0, 0.0, 1.0])

    def loss(m):
        z = m.logits(index, value, first)[0]
        return (np.array([0.25, 0.5, 0.25]) * np.log1p(np.exp(np.where(label == 1, -z, z)))).sum()
    machine = quality.Machine(6, 2, seed=2)
    before = loss(machine)
    machine.fit(index, value, first, label, quality.Training(rounds=40))
    assert loss(machine) < 0.5 * before


def test_fit_holds_a_block_of_the_sample_at_a_time():
    import tracemalloc

    rng = np.random.default_rng(3)
    first, label = np.arange(0, 400_000, 200), rng.integers(0, 2, 2000).astype(float)
    index, value = rng.integers(0, 1000, 400_000).astype(np.int32), rng.random(400_000).astype(np.float32)
    machine = quality.Machine(1000, 4, seed=3)
    tracemalloc.start()
    try:
        machine.fit(index, value, first, label, quality.Training(rounds=2))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 16e6  # all at once: 59 MB


def test_workers_of_the_pipeline_hold_little():
    import tracemalloc

    import pandas as pd

    rng = np.random.default_rng(4)
    texts = [" ".join(map(str, rng.integers(0, 10**9, 400))) for _ in range(1000)]
    frame = pd.DataFrame({"doc_id": range(1000), "text_hash": range(1000), "text": texts})
    list(order_minhash._sketch(iter([frame[:10]])))  # what is imported and kept for good
    tracemalloc.start()
    try:
        rows = sum(len(f) for f in order_minhash._sketch(iter([frame])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 1000 and peak < 32e6  # 4 MB of texts at a time: 114 MB

    encoder = Encoder(default_vocabulary())
    tracemalloc.start()
    try:
        for i in range(0, 900_000, 50_000):
            encoder.many([" ".join(f"w{n}" for n in range(i, i + 50_000))])
        kept = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert kept < 60e6  # with 800,000 words: over 100 MB
    text = " ".join(f"w{n}" for n in range(899_000, 900_000))
    assert encoder.many([text])[0] == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@pytest.fixture(scope="module")
def judged(shared):
    rows = queries.op1_quality_classifier(shared, "/root/testdata/sf0.01").toPandas()
    return rows.merge(shared.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas(), on="doc_id")


def test_held_out_accuracy(judged, shared):
    held = judged[judged["held_out"]]
    assert len(held) > 50 and (held["predicted"] == held["quality"]).mean() >= 0.97
    assert (judged["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in judged["doc_id"]]).all()
    assert ((judged["score"] >= 0.5) == (judged["predicted"] == 1)).all()


def test_labels_of_the_held_out_third_are_not_read(shared, tmp_path):
    documents = shared.read.parquet(f"{SF}/documents.parquet")
    labels = shared.read.parquet("/root/testdata/sf0.001/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    rule = quality.Training(rounds=5)
    one = quality.classify(documents, labels, ~held, rule).select("doc_id", "score").collect()
    other = quality.classify(documents, labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))),
                             ~held, rule).select("doc_id", "score").collect()
    assert sorted(one) == sorted(other)


def test_quality_odd_rows(shared, documents):
    docs = documents(ODD).withColumnsRenamed({"lang": "score", "source": "order"})
    labels = shared.createDataFrame([(6, 1), (4, 0), (4, 1), (None, 1), (9, None), (9, 5), (8, 0), (8, 0)], "doc_id bigint, quality int")
    rows = quality.classify(docs, labels, rule=quality.Training(rounds=5)).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    none = quality.classify(docs, labels.limit(0)).collect()
    assert all(abs(r["score"] - 0.5) < 0.05 for r in none)
    assert quality.classify(documents([]), labels).collect() == []
    without = quality.classify(docs.select("doc_id", "text"), labels, rule=quality.Training(rounds=2))
    assert without.count() == len(ODD)


# LM scores

def test_base_scores_and_counts(shared, sample):
    docs = {r["doc_id"]: r["text"] or "" for r in sample.collect()}
    want = unigram(docs, [i for i in docs if zlib.crc32(str(i).encode()) % 10])
    got = {r["doc_id"]: r for r in queries.op10_lm_scoring(shared, SF).collect()}
    for i, (n, known, total, base) in want.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total) and r["base_score"] == pytest.approx(base, abs=1e-6)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 10 == 0)
        assert r["bits_per_byte"] == pytest.approx(-r["score"] / np.log10(2) / (len(docs[i].encode()) + 1))


def test_rare_words_come_by_a_join(shared, sample, monkeypatch):
    before = {r["doc_id"]: r for r in queries.op10_lm_scoring(shared, SF).collect()}
    monkeypatch.setattr(context_mixing, "HEAVY", 1000)
    for r in queries.op10_lm_scoring(shared, SF).collect():
        assert r["base_score"] == pytest.approx(before[r["doc_id"]]["base_score"], abs=1e-6)
        assert r["n_known"] == before[r["doc_id"]]["n_known"]


def plain_mixing(model, raw):
    """log2 probability decision by decision, with weights moved after each STEP symbols."""
    m, code = model.mixer, model.code
    symbols = context_mixing.Symbols([raw])
    weights = [np.full(m.gates, w) for w in m.start]
    total, half = 0.0, m.gates // 2
    for begin in range(0, len(symbols), context_mixing.STEP):
        moves = [np.zeros(m.gates) for _ in m.start]
        for p in range(begin, min(begin + context_mixing.STEP, len(symbols))):
            s = symbols.symbol[p]
            for d in range(code.length[s]):
                k = code.start[s] + d
                x = [t[c[p] ^ code.node[k]] / m.scale for t, c in zip(model.tables, symbols.contexts, strict=True)]
                gate = min(d, half - 1) + half * (x[-1] != 0)
                z = np.clip(sum(a * w[gate] for a, w in zip(x, weights, strict=True)), -m.widest, m.widest)
                q = 1 / (1 + np.exp(-z))
                total += np.log2(q if code.bit[k] else 1 - q)
                for a, move in zip(x, moves, strict=True):
                    move[gate] += m.rate * (code.bit[k] - q) * a
        weights = [np.clip(w + v, 0, 2) for w, v in zip(weights, moves, strict=True)]
    return total


def test_mixing_against_plain_version_and_batches(shared, documents):
    rows = [(i, text(i, 120)) for i in range(40)]
    model, _ = context_mixing.train(documents(rows))
    texts = [text(3, 120).encode(), b"", text(77, 400).encode(), "é abc \x00".encode(), b"word " * 50]
    together = context_mixing.mixed_log2(model, texts)
    for raw, got in zip(texts, together, strict=True):
        assert got == pytest.approx(plain_mixing(model, raw), rel=1e-3)
        assert got == pytest.approx(context_mixing.mixed_log2(model, [raw])[0], rel=1e-4)
    per_byte = lambda i: -together[i] / len(texts[i])
    assert per_byte(0) < 2.5 and per_byte(2) < 3


def test_probabilities_of_all_symbols_add_up_to_one(shared, documents):
    model, _ = context_mixing.train(documents([(1, "abc abd abe"), (2, "bcd")]))
    code = model.code
    assert sum(2.0 ** -int(n) for n in code.length) == 1.0
    first = sum(2.0 ** plain_mixing_first(model, s) for s in range(257))
    assert first == pytest.approx(1.0)


def plain_mixing_first(model, s):
    """log2 probability of a symbol as the first one."""
    m, code = model.mixer, model.code
    contexts = [c[0] for c in context_mixing.Symbols([b"x"]).contexts]
    out, half = 0.0, m.gates // 2
    for d in range(code.length[s]):
        k = code.start[s] + d
        x = [t[c ^ code.node[k]] / m.scale for t, c in zip(model.tables, contexts, strict=True)]
        z = sum(a * w for a, w in zip(x, m.start, strict=True))
        out += np.log2(1 / (1 + np.exp(-z if code.bit[k] else z)))
    return out


def test_scores_of_odd_rows(documents):
    docs = documents(ODD).withColumnsRenamed({"lang": "n_tokens"})
    model, words = context_mixing.train(docs)
    rows = context_mixing.score(docs, model, words).collect()
    assert len(rows) == len(ODD) and all(r["score"] < 0 and r["n_tokens"] >= 1 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    none, words = context_mixing.train(documents([]))
    unknown = context_mixing.score(docs, none, words).collect()
    assert {r["n_known"] for r in unknown} == {0} and {r["train_tokens"] for r in unknown} == {0}
    assert context_mixing.score(documents([]), model, words).collect() == []


def test_contexts_are_counted_exactly_however_many_there_are(shared, documents, monkeypatch):
    """A fixed table would take some of these contexts for others; none may, and chunks give what the whole model gives."""
    rng = random.Random(8)
    rows = [(i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(400))) for i in range(120)]
    docs = documents(rows)
    model, words = context_mixing.train(docs)
    raw = [t.encode() for _, t in rows]
    symbols = context_mixing.Symbols(raw)
    assert model.counts.select("context").distinct().count() == len(np.unique(np.concatenate(symbols.contexts))) > 400_000
    other = context_mixing.Symbols(["".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=200_000)).encode()])
    assert (model.tables[2].places(symbols.contexts[2]) > 0).all() and (model.tables[2].places(other.contexts[2][20:]) == 0).all()
    monkeypatch.setattr(context_mixing, "CHUNK", 20_000)
    got = {r["doc_id"]: r["bits_per_byte"] for r in context_mixing.score(docs, model, words).collect()}
    for (i, _), t, want in zip(rows, raw, -context_mixing.mixed_log2(model, raw), strict=True):
        assert got[i] == pytest.approx(want / (len(t) + 1), rel=1e-4)


def test_a_chunk_goes_on_over_frames_and_is_scored_in_parts(documents, monkeypatch):
    """Rows come 1000 at a time; contexts are sent once for a chunk, so that small ones would send and be answered far more."""
    rows = [(i, text(i % 700, 12)) for i in range(2500)]
    docs, tables = documents(rows).coalesce(1), []
    keep = context_mixing.stored
    monkeypatch.setattr(context_mixing, "stored", lambda df, *a: tables.append(keep(df, *a)) or tables[-1])
    model, words = context_mixing.train(docs)
    got = {r["doc_id"]: r["bits_per_byte"] for r in context_mixing.score(docs, model, words, trained=F.lit(True)).collect()}
    assert [t.where("_blob is not null").count() for t in tables if "_blob" in t.columns] == [1]
    raw = [t.encode() for _, t in rows[:700]]
    for (i, t), want in zip(rows, -context_mixing.mixed_log2(model, raw), strict=False):
        assert got[i] == pytest.approx(want / (len(t) + 1), rel=1e-4)

    learned = np.arange(len(raw)) % 10 > 0
    whole = context_mixing._pairs(raw, learned)
    monkeypatch.setattr(context_mixing, "PIECE", 5000)
    for a, b in zip(whole, context_mixing._pairs(raw, learned), strict=True):
        assert (a == b).all()
    pairs, n = context_mixing._pairs(raw, np.ones(len(raw), dtype=bool))
    length = np.unique(pairs & ~context_mixing._SYMBOL, return_counts=True)[1]
    monkeypatch.setattr(context_mixing, "MOST_CONTEXTS", len(length) // 4)
    parts = context_mixing._mixed_chunk(model, raw, length, pairs & context_mixing._SYMBOL, n)
    tables = [context_mixing.Table(model.code, model.mixer, pairs, n)] * context_mixing.PREDICTORS
    assert parts == pytest.approx(context_mixing.mixed_log2(model, raw, tables), rel=1e-4)


def test_a_chunk_holds_few_contexts_at_a_time(documents, monkeypatch):
    """Two workers and an executor share 3000 MB: 256 bytes for each of a million contexts, beside the answers, were too much."""
    rng = random.Random(3)
    fresh = lambda: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(200)).encode()
    model, _ = context_mixing.train(documents([(i, text(i, 30)) for i in range(20)]))

    def scored(raw):
        """Scores of these texts as a chunk of their own, and the most megabytes taken meanwhile."""
        pairs, n = context_mixing._pairs(raw, np.ones(len(raw), dtype=bool))
        length = np.unique(pairs & ~context_mixing._SYMBOL, return_counts=True)[1].astype(np.uint16)
        tracemalloc.start()
        try:
            got = context_mixing._mixed_chunk(model, raw, length, (pairs & context_mixing._SYMBOL).astype(np.uint16), n)
            peak = tracemalloc.get_traced_memory()[1] / 1e6
        finally:
            tracemalloc.stop()
        return got, [context_mixing.Table(model.code, model.mixer, pairs, n)] * 3, peak

    raw = [fresh() for _ in range(500)]
    got, tables, peak = scored(raw)
    assert got == pytest.approx(context_mixing.mixed_log2(model, raw, tables), rel=1e-4)
    assert len(tables[0].contexts) > 1_000_000 and peak < 200
    # All new contexts in a few of the texts: parts of as many bytes would not have as many contexts.
    raw = [fresh() for _ in range(40)] + [raw[0]] * 200
    sizes, table = [], context_mixing.Table
    monkeypatch.setattr(context_mixing, "MOST_CONTEXTS", 20_000)
    monkeypatch.setattr(context_mixing, "Table", lambda *a: sizes.append(len((t := table(*a)).contexts)) or t)
    got, tables, _ = scored(raw)
    assert got == pytest.approx(context_mixing.mixed_log2(model, raw, tables), rel=1e-4)
    assert sizes.pop() > 80_000 and max(sizes) <= 2 * 20_000 + 1
