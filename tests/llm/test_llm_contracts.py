"""The registered queries and the operators on odd input, against the plain versions."""

import os
import random

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.llm import (
    decontaminate, langid, language_model, mixing, quality, queries, simhash, suffixes, texts, tokens,
    toxicity, url_filter,
)
from quire.llm.shared import stored

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
# Operators must not mind what else a table holds.
EXTRA = ["row", "hit", "m", "size", "words", "copies", "key", "parts", "score", "kept", "id", "fp"]


def text_of(seed, n):
    draw = random.Random(seed)
    parts = "lo rem ip sum dolor sit amet, Çon. se ct|et ur".split()
    return " ".join(draw.choice(parts) + str(draw.randrange(50)) for _ in range(n))


LONG = text_of(1, 30_000)
PASSAGE = text_of(2, 90)
ODD = [
    (1, PASSAGE, "en", "b", 5), (2, "Intro. " + PASSAGE + " end", "en", "b", None),
    (3, PASSAGE.replace("lo", "LO", 1), None, None, 0), (None, None, None, None, None),
    (None, "only text without an id " * 9, "en", "a", 1), (4, "", "en", "a", 0),
    (5, " \n\t ", "fr", "a", 4), (6, LONG, "fr", "c", len(LONG)), (7, LONG + " tail", "fr", "c", 1),
    (8, "Word", "", "", 4), (9, "x" * 700, "de", "d", 700), (10, "a\nb\na\nb c\nb c\n" * 5, "de", "d", 9),
    (11, PASSAGE, "en", "b", 5), (11, PASSAGE, "en", "b", 5), (12, "é" * 300 + " ñ" * 40, "es", "d", 3),
    *[(100 + i, text_of(i, 5 + 7 * i), "en", f"s{i % 5}", i) for i in range(20)],
]
DDL = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
BENCH = [(1, " ".join(PASSAGE.split()[3:20])), (2, "word"), (3, None), (4, " ... "), (4, "x9 y9"), (None, "b c")]
LABELS = [(1, 1, 0), (1, 1, 0), (None, 0, 1), (6, None, None), *[(100 + i, i % 2, i % 3 // 2) for i in range(20)]]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ODD, DDL)
    return docs.select("*", *[F.lit("x").alias(c) for c in EXTRA]).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(BENCH, "item_id LONG, text STRING")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id LONG, quality INT, toxic INT")


@pytest.fixture(scope="module")
def known(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("driver tables not present")
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    return [(r["doc_id"], r["text"], r["source"]) for r in rows]


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


TEXTS = [(d, t) for d, t, *_ in ODD]


# 1. Language model
def rounded(df):
    return order(
        (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
        for r in df.collect()
    )


def test_lm_odd(odd, none):
    got = language_model.report(odd)
    assert rounded(got) == order(plain.op1(TEXTS))
    assert language_model.report(none).count() == 0


def test_lm_beats_its_base_on_held_out_texts(spark, known):
    rows = queries.op1_language_model(spark, FOLDER).collect()
    want = plain.op1([(d, t) for d, t, _ in known])
    assert order((*r[:5], round(r["base_score"], 6)) for r in rows) == order(want)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 100


def test_lm_is_a_distribution(spark):
    docs = spark.createDataFrame([(i, "a b c d a b") for i in range(40)], "doc_id LONG, text STRING")
    model, counts = language_model.fit(docs)
    rare = [r for r in counts.collect()]
    t = language_model.Tokens(
        np.array([r["token"] for r in rare], np.int64).view(np.uint64),
        np.array([r["ending"] for r in rare], np.int64), np.array([0, len(rare)]),
    )
    _, _, rows = language_model.looked_up(model, t)
    assert np.allclose(language_model.shares(model, model.weights, rows).sum(1), 1, atol=1e-4)


# 2. Suffixes
def five(df):
    return order(df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


def test_suffix_odd(odd, none, known, spark, monkeypatch):
    assert five(suffixes.dedup(odd)) == order(plain.op2(TEXTS))
    assert suffixes.dedup(none).count() == 0
    # Cores with many spans are counted over the cluster, with the same result.
    docs = [(i, text_of(900 + i, 30) + " " + PASSAGE[i:] + text_of(i, 30)) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id LONG, text STRING")
    want = order(plain.op2(docs))
    assert five(suffixes.dedup(df)) == want
    monkeypatch.setattr(suffixes, "SPANS", 3)
    assert five(suffixes.dedup(df, batches=7)) == want


def test_suffix_query(spark, known):
    got = five(queries.op2_suffix_dedup(spark, FOLDER))
    assert got == order(plain.op2([(d, t) for d, t, _ in known]))


def test_suffix_levels_grow_geometrically(spark):
    family, sizes = suffixes.Family(), []
    for b in range(7):
        rows = [(text_of(1000 + 10 * b + i, 60),) for i in range(3)]
        family.add(spark.createDataFrame(rows, "text STRING"))
        sizes.append([rank for rank, _ in family.levels])
    assert sizes == [[0], [1], [1, 0], [2], [2, 0], [2, 1], [2, 1, 0]]


# 3. Decontamination
def test_decontamination_odd(odd, none, bench):
    got = order(decontaminate.report(odd, bench).collect())
    named = [(i if i is not None else "", t) for i, t in BENCH]
    assert got == order(plain.op3(TEXTS, named))
    assert order(decontaminate.report(odd, bench, block=2).collect()) == got
    clean = decontaminate.clean(odd, bench)
    assert clean.columns == odd.columns
    assert order((r["doc_id"],) for r in clean.collect()) == order((r[0],) for r in got if not r[5])
    assert clean.count() == decontaminate.clean(odd, bench, block=2).count()
    assert decontaminate.report(none, bench).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.report(odd, bench.limit(0)).collect())


def test_decontamination_proximity(spark):
    docs = spark.createDataFrame([(1, "one two big three four"), (2, "four three two one")], "doc_id LONG, text STRING")
    item = spark.createDataFrame([(7, "one two three four")], "item_id LONG, text STRING")
    near = {s: {r["doc_id"] for r in decontaminate.report(docs, item, slop=s).collect() if r["contaminated"]}
            for s in (0, 1)}
    assert near == {0: set(), 1: {1}}


def test_decontamination_query(spark, known):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    got = order(queries.op3_decontaminate(spark, FOLDER).collect())
    assert got == order(plain.op3([(d, t) for d, t, _ in known], items))


# 4. Mixing
def test_mixing_odd(odd, none):
    rows = [r for r in ODD if r[0] is not None and r[0] != 11]
    want = plain.op4([(d, t, s) for d, t, _, s, _ in rows])
    only = odd.where("doc_id is not null and doc_id <> 11")
    got = mixing.mix(only).collect()
    assert len(got) == len(rows)
    for r in got:
        size, source_size, target, _ = want[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size, source_size)
        assert r["target"] == pytest.approx(target)
        assert r["taken"] <= 3 * size and (not size or r["taken"] % size == 0)
    assert order(got) == order(mixing.mix(only).collect())
    assert mixing.mix(odd).count() == odd.count()
    assert mixing.mix(none).count() == 0


def test_mixing_meets_targets(spark):
    rows = [(i, text_of(i, 5 + i % 40), ["a", "b", "c", None][i % 7 % 4]) for i in range(2000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING"))
    for r in got.groupBy("source", "target").agg(F.sum("taken").alias("taken")).collect():
        assert abs(r["taken"] - r["target"]) <= 50
    drawn = mixing.draw(spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING"))
    words = drawn.select(F.sum(mixing.words_in(F.col("text")))).first()[0]
    assert words == got.agg(F.sum("taken")).first()[0]


# 5. Toxicity
def test_toxicity_odd(odd, none, labels):
    got = toxicity.report(odd, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert toxicity.report(none, labels).count() == 0
    assert toxicity.report(odd, labels.limit(0)).count() == len(ODD)


def test_toxicity_learns_and_ignores_held_out_labels(spark):
    rows, marks = [], []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, text_of(i, 30) + (f" scummy {text_of(7 * i, 3)}" if bad else "")))
        marks.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    got = toxicity.report(docs, spark.createDataFrame(marks, "doc_id LONG, toxic INT")).collect()
    right = [r["predicted"] == (r["doc_id"] % 4 == 0) for r in got if r["held_out"]]
    assert len(right) > 50 and np.mean(right) > 0.95
    flipped = [(i, 1 - t if plain.rest(i, 5) == 0 else t) for i, t in marks]
    again = toxicity.report(docs, spark.createDataFrame(flipped, "doc_id LONG, toxic INT")).collect()
    assert order((r["doc_id"], r["score"]) for r in got) == order((r["doc_id"], r["score"]) for r in again)


def test_nearest_is_exact(spark):
    rows = [(i, text_of(i, 20) + (" foul awful" if i % 3 == 0 else "")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id LONG, toxic INT")
    index = toxicity.fit(docs, marks)
    draw = np.random.default_rng(0)
    for _ in range(20):
        term = np.sort(draw.choice(len(index.term), min(4, len(index.term)), replace=False))
        weight = np.full(len(term), len(term) ** -0.5)
        every, n_blocks = np.zeros(index.n_docs), index.best.shape[1]
        for t, w in zip(term, weight):
            lo, hi = index.post_at[t * n_blocks], index.post_at[(t + 1) * n_blocks]
            np.add.at(every, index.example[lo:hi], w * index.weight[lo:hi])
        _, score = toxicity.nearest(index, term, weight, k=5)
        top = -np.sort(-every[every > 0])[:5]
        assert np.allclose(score, top)


def test_toxicity_evidence_names_documents_and_votes_leave_themselves_out(spark):
    rows = [(1000 + i, text_of(i, 12) + (f" vile foul {text_of(9 * i, 2)}" if i % 3 == 0 else "")) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    marks = spark.createDataFrame([(1000 + i, int(i % 3 == 0)) for i in range(120)], "doc_id LONG, toxic INT")
    index = toxicity.fit(docs, marks)
    for r in toxicity.scored(docs, index).collect():
        for e in r["tox"]["evidence"]:
            assert plain.rest(e["doc_id"], 5) != 0 and e["toxic"] == ((e["doc_id"] - 1000) % 3 == 0)
    # Each example's vote is that of an index without it, as no two texts are equal.
    votes = toxicity.own_votes(toxicity.examples_of(docs, marks), index)
    by_id = dict(rows)
    for n, i in list(enumerate(index.ids))[::7]:
        chunk = next(texts.chunks(pa.array([by_id[i]])))
        text, term, tf = toxicity.bags(index.term, chunk)
        weight = toxicity.weighed(tf, index.idf[term])
        found, score = toxicity.nearest(index, term, weight / max(np.sqrt((weight ** 2).sum()), 1e-12), k=toxicity.K + 1)
        keep = found != n
        want = toxicity.vote(index, found[keep][: toxicity.K], score[keep][: toxicity.K])
        assert np.isnan(want) == np.isnan(votes[n]) and (np.isnan(want) or abs(want - votes[n]) < 1e-9)


def test_equal_shards_of_several_window_blocks_stay_apart(spark, bench):
    docs = spark.createDataFrame([(1, PASSAGE), (2, "word"), (3, None)], "doc_id LONG, text STRING").coalesce(1)
    twice = docs.union(docs).union(docs)
    one = order(decontaminate.report(twice, bench).collect())
    assert len(one) == 9
    for block in (1, 2, 3):
        assert order(decontaminate.report(twice, bench, block=block).collect()) == one


# 6. Quality
def test_quality_odd(odd, none, labels):
    rows = stored(quality.measured(odd), "odd")
    got = order(tuple(r)[:7] for r in quality.judged(rows, labels).collect())
    assert got == order((d, *plain.op6(t)) for d, t in TEXTS)
    kept = quality.keep(odd, rows, labels)
    assert kept.columns == odd.columns
    assert kept.count() == quality.judged(rows, labels).where("kept").count()
    assert quality.judged(stored(quality.measured(none), "none"), labels).count() == 0


def test_quality_query(spark, known):
    got = order(tuple(r)[:7] for r in queries.op6_quality(spark, FOLDER).collect())
    assert got == order((d, *plain.op6(t)) for d, t, _ in known)


def test_quality_bounds():
    from math import comb
    for n, rate, level in ((50, 0.1, 0.05), (400, 0.02, 0.01), (10, 0.1, 0.001), (0, 0.1, 0.05)):
        k = quality.fewest_errors(n, rate, level)
        below = [sum(comb(n, j) * rate**j * (1 - rate)**(n - j) for j in range(m + 1)) for m in range(n + 1)]
        assert k == sum(b <= level for b in below) - 1


def test_quality_cutoffs_hold_their_promise(spark):
    rows, marks = [], []
    for i in range(3000):
        bad = i % 5 == 0
        rows.append((i, text_of(i, 40) + ("".join(f" {j}##$$" for j in range(20)) if bad else ""), "en"))
        marks.append((i, 0 if bad else 1))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING")
    labels = spark.createDataFrame(marks, "doc_id LONG, quality INT")
    out = quality.judged(stored(quality.measured(docs), "bounds"), labels).where("not base_failed").collect()
    lost = np.mean([not r["kept"] for r in out if r["doc_id"] % 5])
    caught = np.mean([not r["kept"] for r in out if r["doc_id"] % 5 == 0])
    assert lost <= quality.ALPHA and caught > 0.9


def test_quality_strata_are_judged_by_their_own_labels(spark):
    def noisy(i):
        return text_of(i, 40) + "".join(f" {j}##$$" for j in range(20))

    # In null and in "l00" noise is bad; in 70 more languages labels are too few for a proof.
    rows = [(i, noisy(i) if i % 3 == 0 else text_of(i, 40), [None, "l00"][i % 2], int(i % 3 > 0)) for i in range(6000)]
    rows += [(6000 + i, noisy(i), f"l{i % 70 + 1:02}", 1) for i in range(140)]
    rows += [(7000 + i, noisy(i), "unlabelled", None) for i in range(20)]
    rows += [(8000 + i, noisy(i), "", None) for i in range(20)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id LONG, text STRING, lang STRING")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id LONG, quality INT")
    out = quality.judged(stored(quality.measured(docs), "strata"), labels).where("not base_failed").collect()
    kept = {r["doc_id"]: r["kept"] for r in out}
    assert all(k for d, k in kept.items() if d >= 6000)
    for of in (0, 1):
        assert np.mean([k for d, k in kept.items() if d < 6000 and d % 2 == of and d % 3]) >= 0.95
        assert np.mean([k for d, k in kept.items() if d < 6000 and d % 2 == of and d % 3 == 0]) < 0.1


# 7. SimHash
def test_simhash_odd(odd, none):
    assert order(simhash.report(odd).collect()) == order(plain.op7(TEXTS))
    assert simhash.report(none).count() == 0
    heads = set(plain.alike(TEXTS))
    stay = simhash.representatives(odd)
    assert stay.columns == odd.columns
    assert order((r["doc_id"],) for r in stay.collect()) == order((h,) for h in heads)


def test_simhash_keeps_a_row_of_each_group(spark):
    rows = [
        (None, text_of(500, 40)), (None, text_of(501, 40)), (None, text_of(501, 40)),  # no ids
        (7, text_of(502, 40)), (7, text_of(503, 40)), (7, text_of(503, 40)),           # one id
        (None, text_of(504, 40)), (9, text_of(504, 40)), (8, text_of(504, 40)),
    ]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    want = [rows[0], rows[1], rows[3], rows[4], rows[8]]
    assert order(simhash.representatives(docs).collect()) == order(want)


def edited(text, every, seed):
    """The text with one word in ``every`` replaced, at drawn places."""
    words, draw = text.split(" "), random.Random(seed)
    for i in draw.sample(range(len(words)), len(words) // every):
        words[i] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


def test_near_copies_are_found_and_verified(spark):
    rows = []
    for i in range(400):
        base = text_of(5000 + i, 100 + i)
        rows += [(2 * i, base), (2 * i + 1, edited(base, [40, 60, 25, 15][i % 4], i))]
    sets = {d: plain.shingles(t) for d, t in rows}
    like = {d for d in range(1, 800, 2) if plain.jaccard(sets[d], sets[d - 1]) >= 0.8}
    assert 100 < len(like) < 300
    stay = {r["doc_id"] for r in simhash.representatives(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()}
    gone = set(sets) - stay
    # Whatever goes is a near copy by the texts' own shingles, and most near copies go.
    assert gone <= like and len(gone) >= 0.9 * len(like)


def test_large_groups_of_near_copies(spark, monkeypatch):
    # Lists far beyond LIST are linked through their leaders.
    monkeypatch.setattr(simhash, "LIST", 40)
    monkeypatch.setattr(simhash, "SHORT", 8)
    base = text_of(77, 400)
    rows = [(i, edited(base, 200, i)) for i in range(600)] + [(1000 + i, text_of(900 + i, 60)) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    stay = simhash.representatives(docs)
    assert order((r["doc_id"],) for r in stay.collect()) == order((d,) for d in [0, *range(1000, 1050)])


def test_candidates_are_all_that_share_positional_bytes(spark, monkeypatch):
    # However crowded a list is, every pair at the minimum is verified or already in one group.
    monkeypatch.setattr(simhash, "LIST", 40)
    monkeypatch.setattr(simhash, "SHORT", 8)
    monkeypatch.setattr(simhash, "LINKS", 0)
    # Pairs of pages from one template, each pair alike, the pages of different pairs not quite.
    base, rows = text_of(31, 400).split(" "), []
    for i in range(150):
        words, draw = base.copy(), random.Random(i)
        for at in draw.sample(range(400), 18):
            words[at] = f"page{i}x{at}"
        rows.append((2 * i, " ".join(words)))
        for at in draw.sample(range(400), 4):
            words[at] = f"copy{i}x{at}"
        rows.append((2 * i + 1, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    sketched = {r["doc_id"]: np.array(r["s"], np.int64) for r in docs.select("doc_id", simhash.sketches("text").alias("s")).collect()}
    prints = np.array([sketched[d][1:] for d, _ in rows]).view(np.uint64)
    parts = np.ascontiguousarray(prints[:, 1:]).view(np.uint8).reshape(len(rows), simhash.WIDE, 8)
    sets, group, candidates = [plain.shingles(t) for _, t in rows], list(range(len(rows))), 0
    for i in range(len(rows)):
        for j in range(i):
            tally = (parts[i] == parts[j]).sum(1).max()
            if tally >= simhash.MINIMUM and int(prints[i, 0] ^ prints[j, 0]).bit_count() <= simhash.RADIUS:
                candidates += 1
                if plain.jaccard(sets[i], sets[j]) >= 0.8 and group[i] != group[j]:
                    group = [group[j] if g == group[i] else g for g in group]
    assert candidates > 3000 and len(set(group)) > 50
    want = [min(d for (d, _), g in zip(rows, group) if g == head) for head in set(group)]
    assert order((r["doc_id"],) for r in simhash.representatives(docs).collect()) == order((d,) for d in want)


@pytest.mark.parametrize("links", [0, 4])
def test_pages_of_one_template_are_not_verified_in_all_pairs(spark, monkeypatch, links):
    # Pages that are not quite alike, each with a copy: nearly all of their 44,850 pairs are candidates.
    monkeypatch.setattr(simhash, "LINKS", links)
    base, rows = text_of(32, 400).split(" "), []
    for i in range(150):
        words, draw = base.copy(), random.Random(i)
        for at in draw.sample(range(400), 10):
            words[at] = f"page{i}x{at}"
        rows.append((2 * i, " ".join(words)))
        for at in draw.sample(range(400), 2):
            words[at] = f"copy{i}x{at}"
        rows.append((2 * i + 1, " ".join(words)))
    verified, alike = [], simhash.alike
    monkeypatch.setattr(simhash, "alike", lambda pairs, sets: verified.append(pairs.count()) or alike(pairs, sets))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    stay = simhash.representatives(docs)
    assert order((r["doc_id"],) for r in stay.collect()) == order((2 * i,) for i in range(150))
    assert 150 <= sum(verified) <= 5 * len(rows)


def test_parities_rule_out_no_pair_that_is_alike(spark):
    rows = []
    for i, n in enumerate([5, 6, 20, 67, 68, 69, 120, 133, 200, 260, 900] * 4):
        base = text_of(7000 + i, n)
        rows += [base, edited(base, 60, i), edited(base, 45, i + 1), edited(base, 20, i + 2), " ".join(base.split(" ")[: -n // 5])]
    rows += ["", None, "one"]
    docs = spark.createDataFrame(list(enumerate(rows)), "id LONG, text STRING")
    got = dict(docs.select("id", simhash.parities("text")).collect())
    marks = np.empty(len(rows), object)
    marks[:] = [np.array(got[i], np.int64) for i in range(len(rows))]
    sets = [plain.shingles(t) for t in rows]
    assert [m[0] for m in marks] == [len(s) for s in sets]
    a, b = np.triu_indices(len(rows), 1)
    differ, like = simhash.possible(marks)(a, b), 0
    for x, y, d in zip(a, b, differ):
        assert d <= len(sets[x] ^ sets[y])
        if (sets[x] or sets[y]) and plain.jaccard(sets[x], sets[y]) >= 0.8:
            like += 1
            assert d >= 0
    assert like > 60 and (differ < 0).mean() > 0.9


def test_spanning_forest_connects_at_every_radius():
    draw = random.Random(5)
    prints = [0]
    while len(prints) < 60:
        x = draw.choice(prints)
        for b in draw.sample(range(64), draw.randrange(1, 20)):
            x ^= 1 << b
        prints.append(x)
    f = np.array(prints, np.uint64)
    a, b = simhash.spanning(f)
    for radius in (3, 8, simhash.RADIUS):
        group = list(range(len(f)))
        for x, y in zip(a.tolist(), b.tolist()):
            if (prints[x] ^ prints[y]).bit_count() <= radius:
                group = [group[x] if g == group[y] else g for g in group]
        want = plain.components(prints, list(range(len(f))), radius)
        assert len(set(group)) == len(set(want))
        assert len({(g, w) for g, w in zip(group, want)}) == len(set(want))


def test_simhash_query(spark, known):
    got = order(queries.op7_simhash(spark, FOLDER).collect())
    assert got == order(plain.op7([(d, t) for d, t, _ in known]))


def test_simhash_long_lists_are_dealt_anew(spark, monkeypatch):
    draw = random.Random(3)
    prints = {0}
    for _ in range(150):
        x = 0
        for b in draw.sample(range(64), draw.randrange(1, 6)):
            x ^= 1 << b
        prints.add(x)
    prints |= {draw.getrandbits(64) for _ in range(50)}
    prints = sorted(prints)
    monkeypatch.setattr(simhash, "LIST", 40)
    fps = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp LONG")
    pairs = [(r["a"], r["b"]) for r in simhash.links(fps).collect()]
    parent = {simhash.signed(p): simhash.signed(p) for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
        parent[find(a)] = find(b)
    want = plain.components(prints, list(range(len(prints))))
    assert len(set(want)) == len({find(x) for x in parent})


# 8. Tokens
def decoded(rows):
    enc = tokens.encoder(tokens.VOCABULARY)
    record = np.concatenate([tokens.read(bytes(r["data"])) for r in rows])
    parts = {}
    for head, ids in zip(record["head"], record["ids"]):
        parts.setdefault(int(head["doc_id"]), []).append((int(head["part"]), ids[: head["used"]]))
    return record, {
        d: enc.decode([i for _, x in sorted(p, key=lambda q: q[0]) for i in x.tolist() if i != tokens.END])
        for d, p in parts.items()
    }


def test_tokens_round_trip(odd, none):
    only = odd.where("doc_id <> 11 or doc_id is null").where("doc_id is not null or text is null")
    rows = tokens.shards(only, per_shard=16).orderBy("shard").collect()
    record, texts_ = decoded(rows)
    assert texts_ == {tokens.NO_ID if d is None else d: t or "" for d, t in TEXTS
                      if d not in (11, None) or t is None}
    assert [r["first_slot"] for r in rows] == [16 * r["shard"] for r in rows]
    assert [r["sequences"] for r in rows[:-1]] == [16] * (len(rows) - 1)
    assert sum(r["tokens"] for r in rows) == int(record["head"]["used"].sum())
    assert tokens.shards(odd).agg(F.sum("sequences")).first()[0] > len(record)
    assert tokens.shards(none).count() == 0


def test_tokens_are_those_of_the_public_tokenizer():
    public = pytest.importorskip("public_tokenizers")
    import tiktoken
    own = tokens.encoder(tokens.VOCABULARY)
    other = tiktoken.Encoding("p", pat_str=public.PATTERN, mergeable_ranks=own._mergeable_ranks, special_tokens={})
    for t in [LONG[:5000], PASSAGE, "a  b\n\n c\u00a0d 's I'll 12x\t\n", "", " ", "é ñ  "]:
        assert own.encode_ordinary(t) == other.encode_ordinary(t)


def test_permutation():
    for total in (1, 2, 5, 64, 1000, 4097):
        out = tokens.permuted(np.arange(total), total)
        assert sorted(out.tolist()) == list(range(total))
    assert tokens.permuted(np.arange(1000), 1000).tolist() != tokens.permuted(np.arange(1000), 1000, 5).tolist()


def test_tokens_saved_and_read_by_slot(spark, odd, tmp_path):
    made = stored(tokens.shards(odd, per_shard=16), "shards")
    manifest = tokens.save(made, f"file://{tmp_path}").orderBy("shard").collect()
    rows = made.orderBy("shard").collect()
    for r, m in zip(rows, manifest):
        data = (tmp_path / tokens.name_of(m["shard"])).read_bytes()
        assert data == bytes(r["data"]) and len(data) == m["stride"] * m["sequences"]
    slot, stride = 21, manifest[0]["stride"]
    with open(tmp_path / tokens.name_of(slot // 16), "rb") as f:
        f.seek(slot % 16 * stride)
        assert f.read(stride) == bytes(rows[1]["data"])[5 * stride: 6 * stride]


# 9. Language
def test_language(spark, none):
    words = {"en": "the and of with this that ", "fr": "les une dans pour avec est ", "de": "und der die nicht ein mit "}
    docs = spark.createDataFrame(
        [(i, w * 20, lang) for i in range(3) for lang, w in words.items()] + [(99, None, None), (98, "", "en")],
        "doc_id LONG, text STRING, lang STRING",
    )
    page = "<html lang='{}'><script>var les=1</script><body><p>{}</p></body></html>"
    rows = [(i, f"http://{lang}.example.{lang}/x", page.format(lang, w * 5), "x") for i, (lang, w) in
            enumerate([*words.items()] * 4)]
    rows += [
        (50, "http://fr.example.fr/y", page.format("en", words["fr"] * 5), "x"),  # wrong declaration
        (51, "http://de.example.de/y", "<html><p>mmm</p></html>", "x"),            # host tells
        (52, None, None, "x"), (None, "no address", "", "x"), (50, "http://fr.example.fr/y", page.format("en", words["fr"] * 5), "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING, q STRING")
    got = langid.identify(pages, docs).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert [by[i]["lang"] for i in range(12)] == [*words] * 4
    assert by[50]["lang"] == "fr" and by[50]["declared"] == "en" and by[51]["lang"] == "de"
    assert by[52]["host"] == "" and all(0 < r["probability"] <= 1 for r in got)
    assert langid.identify(pages.limit(0), docs).count() == 0
    assert [r["lang"] for r in langid.identify(pages, none).collect()] == [None] * len(rows)


def test_all_declared_languages(spark, monkeypatch):
    # Each has words of its own; beyond the first 128, too, whatever the block.
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{i:03}": f"{letters[i % 26] * 3}{letters[i // 26] * 2}q " for i in range(140)}
    docs = spark.createDataFrame(
        [(w * 30, lang) for i, (lang, w) in enumerate(words.items()) for _ in range(1 + (i < 128))], "text STRING, lang STRING"
    )
    page = "<html lang='{}'><p>{}</p></html>"
    rows = [(i, f"http://h{i % 9}.example.{lang}/", page.format(["xx", lang][i % 2], w * 9)) for i, (lang, w) in
            enumerate(words.items())]
    pages = spark.createDataFrame(rows + [(200, None, None)], "page_id LONG, url STRING, html STRING")
    got = {r["page_id"]: r for r in langid.identify(pages, docs).collect()}
    assert [got[i]["lang"] for i in range(140)] == [got[i]["text_lang"] for i in range(140)] == [*words]
    for size in (20, 200):
        monkeypatch.setattr(langid, "BLOCK", size)
        again = {r["page_id"]: r for r in langid.identify(pages, docs).collect()}
        assert len(again) == 141
        for i, r in again.items():
            assert r["lang"] == got[i]["lang"] or i == 200
            assert abs(r["probability"] - got[i]["probability"]) < 1e-9 and r["declared"] == got[i]["declared"]


def test_declared_language_after_a_long_comment():
    page = "<!--" + " note" * 2000 + "-->" + "\n" * 300 + "<html class='x' lang='fr-CA'><p>mot</p></html>"
    assert langid.read_page(page)[0] == "fr"
    assert langid.read_page("<html><p lang=de>" + page)[0] == "fr"


def test_language_query(spark, known):
    rows = queries.op9_language(spark, FOLDER).collect()
    told = [r for r in rows if r["declared"]]
    assert np.mean([r["lang"] == r["declared"] for r in told]) > 0.9


def test_visible_text_takes_linear_time_and_equals_the_plain_rule():
    import re
    import time
    rule = re.compile(r"<!--.*?-->|<(script|style|nav|head|noscript)\b.*?</\1\s*>|<[^>]*>", re.S | re.I)
    bits = ["<script", "<script>", "</script>", "</SCRIPT >", "<!--", "-->", "<nav a='1'>", "</nav>", "<p>", "text",
            "<", ">", "<head>", "</head\n>", "<header>", "<style/>", "</style", "--->", "<!-->", "<noscript>", "</noscript>"]
    draw = random.Random(1)
    for _ in range(5000):
        html = "".join(draw.choice(bits) for _ in range(draw.randrange(14)))
        assert langid.visible(html) == rule.sub(" ", html)
    for unit in ("<script ", "<nav>", "<!--", "<", "<p ", "</script", "<script></script", "<html lang"):
        began = time.time()
        langid.read_page(unit * (1_000_000 // len(unit)))
        assert time.time() - began < 2, unit


# 10. URLs
URLS = [
    "http://www.Example.COM/en/x?q#f", "https://a.example.com/en/", "https://example.com/en", "x://com", "com://net",
    None, "", "no scheme", "http://a.net/es/1", "http://a.net/es", "http://net/fr/", "ftp://b.org/path#x",
    "http://notexample.com/en/1", "http://a.b://c/d", "http://?x", "http://example.com?/en/", "http://ÄÖ.com/Z",
]


def test_urls(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate([*URLS, URLS[0]])]
    pages = spark.createDataFrame(rows, "page_id LONG, url STRING, host STRING, verdict STRING")
    got = {r["page_id"]: r for r in url_filter.judge(pages, queries.RULES).collect()}
    for i, u, *_ in rows:
        host, path, rule, verdict = plain.op10(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == verdict if rule else got[i]["verdict"] in ("allow", "block")
    assert url_filter.judge(pages.limit(0), queries.RULES).count() == 0


def test_urls_learn_from_a_table(spark):
    rows = [(f"{w}{i}.org", f"/{w}/{i}", int(w == "spam")) for i in range(60) for w in ("spam", "fine")]
    labelled = spark.createDataFrame(rows, "host STRING, path STRING, label INT")
    pages = spark.createDataFrame(
        [(i, f"http://{w}{i + 100}.org/{w}/x") for i in range(20) for w in ("spam", "fine")], "page_id LONG, url STRING"
    )
    got = url_filter.judge(pages, (), labelled).collect()
    assert all((r["verdict"] == "block") == ("spam" in r["url"]) for r in got)


def test_urls_need_no_python(spark, known):
    plan = queries.op10_url_filter(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    plan = queries.op4_mix(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# The pipeline
def test_pipeline(spark, known):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    texts_ = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = set(texts_)
    for name, stage in pipeline.STAGES[:-1]:
        before = docs
        docs = stored(stage(spark, docs, FOLDER), "test")
        assert docs.columns == columns, name
        rows = docs.collect()
        assert {r["doc_id"] for r in rows} <= ids and all(texts_[r["doc_id"]] == r["text"] for r in rows)
        ids = {r["doc_id"] for r in rows}
        if name == "quality rules":
            assert all(not plain.op6(r["text"])[-1] for r in rows)
        if name == "simhash near-dedup":
            given = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert sorted(ids) == sorted(set(plain.alike(given))) and len(rows) == len(ids)
        if name == "benchmark decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
            given = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert ids == {d for d, *_, bad in plain.op3(given, items) if not bad}
        if name == "mixing sources":
            took = {r["doc_id"]: r["taken"] for r in mixing.mix(before).collect()}
            words = {}
            for r in rows:
                words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(plain.WORD.findall(plain.raw(r["text"])))
            assert words == {d: t for d, t in took.items() if t}
    out = pipeline.STAGES[-1][1](spark, docs, FOLDER).orderBy("shard").collect()
    record, _ = decoded(out)
    assert int((record["head"]["part"] == 0).sum()) == docs.count()


def test_pipeline_of_nothing(spark, none, tmp_path):
    import corpus_pipeline as pipeline

    spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id LONG, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    none.write.parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
