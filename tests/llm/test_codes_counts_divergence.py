"""Vector codes, divergence of sources and token counts against plain versions and odd input."""

import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.llm import divergence, texts, token_counts, vector_codes

FILE = "/opt/tokenizers/byte_bpe_50k.json"
FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
EXTRA = ["row", "code", "error", "tokens", "width", "ints", "n", "p", "q", "term", "docs", "block"]


def extra(df):
    return df.select("*", *[F.lit("x").alias(c) for c in EXTRA])


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# 11. Vector codes
def plain_codes(rows, parts=8, entries=16, rounds=6):
    good = [
        (i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not good:
        return []
    width = len(good[0][1]) // parts
    as_bytes = lambda v: np.array(v, "<i4").tobytes()
    first = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, as_bytes(r[1])))[:entries]
    cut = lambda v: [tuple(v[p * width:(p + 1) * width]) for p in range(parts)]
    books = [[cut(r[1])[p] for r in first] for p in range(parts)]
    best = lambda p, x: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        met = defaultdict(list)
        for _, v, _ in good:
            for p, x in enumerate(cut(v)):
                met[p, best(p, x)[1]].append(x)
        for (p, k), xs in met.items():
            books[p][k] = tuple(sum(c) // len(xs) for c in zip(*xs))
    flat = ",".join(str(x) for b in books for e in b for x in e)
    sha = hashlib.sha256(flat.encode()).hexdigest()
    out, totals = [], Counter()
    for i, v, label in good:
        near = [best(p, x) for p, x in enumerate(cut(v))]
        error = sum(d for d, _ in near)
        totals[label] += error
        out.append((i, "".join(f"{k:02x}" for _, k in near), error, label))
    return [(i, code, error, totals[label], sha) for i, code, error, label in out]


def codes(df):
    return order(
        df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    )


DDL = "vec_id LONG, embedding ARRAY<FLOAT>, label INT"


def test_codes_odd(spark):
    draw = random.Random(3)
    some = [[draw.choice([-0.5, 0.25, 0.0, draw.gauss(0, 1)]) for _ in range(16)] for _ in range(60)]
    rows = [(i, v, i % 3) for i, v in enumerate(some)]
    rows += [(7, some[3], None), (7, some[3], None), (None, some[5], None), (99, None, 1)]
    rows += [(100, [None, *some[0][1:]], 1), (101, [float("nan"), *some[0][1:]], 1)]
    rows += [(102, [float("inf"), *some[0][1:]], 2), *[(200 + i, some[9], 2) for i in range(40)]]
    df = spark.createDataFrame(rows, DDL).repartition(5)
    assert codes(vector_codes.report(extra(df))) == order(plain_codes(rows))
    assert vector_codes.report(spark.createDataFrame([], DDL)).count() == 0
    few = rows[:5] + rows[-1:]
    assert codes(vector_codes.report(spark.createDataFrame(few, DDL))) == order(plain_codes(few))


def test_codes_keep_rows_of_other_lengths_without_a_code(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "FEW_LABELS", 0)
    rows = [(i, [float(i)] * 8, None) for i in range(4)] + [(9, [1.0] * 7, 1), (8, [], 1), (7, [2.0] * 16, 1)]
    got = {r["vec_id"]: r for r in vector_codes.report(spark.createDataFrame(rows, DDL)).collect()}
    assert len(got) == 7 and all(got[i]["code"] is None and got[i]["error"] is None for i in (7, 8, 9))
    assert codes(vector_codes.report(spark.createDataFrame(rows[:4], DDL))) == order(plain_codes(rows[:4]))
    assert got[3]["code"] == "03" * 8 and got[0]["label_error"] == 0
    none = vector_codes.report(spark.createDataFrame(rows[4:6], DDL)).collect()
    assert [r["code"] for r in none] == [None, None]


def test_codes_of_the_driver_table(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("driver tables not present")
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    want = plain_codes([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])
    assert codes(vector_codes.report(df)) == order(want)


def test_large_components_fail_and_are_named(spark):
    rows = [(1, [1e9] * 8, 1)]
    with pytest.raises(Exception, match="too large for 64-bit squares"):
        vector_codes.report(spark.createDataFrame(rows, DDL)).collect()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60), st.integers(1, 4), st.integers(1, 400), st.integers(0, 10_000))
def test_tree_search_is_exact(entries, positions, reach, seed):
    draw = np.random.default_rng(seed)
    book = draw.integers(-reach, reach, (entries, positions))
    queries = draw.integers(-reach, reach, (200, positions))
    got = vector_codes.nearest(vector_codes.tree(book), book, queries)
    square = ((queries[:, None] - book) ** 2).sum(2)
    assert (got.entry == square.argmin(1)).all() and (got.square == square.min(1)).all()


def test_tree_search_skips_subtrees_and_keeps_great_distances_exact():
    draw = np.random.default_rng(1)
    book = draw.integers(-1000, 1000, (16, 8)) + draw.integers(-9, 9, (16, 1)) * (1 << 24)
    queries = draw.integers(-1000, 1000, (500, 8)) + draw.integers(-9, 9, (500, 1)) * (1 << 24)
    got = vector_codes.nearest(vector_codes.tree(book), book, queries)
    square = ((queries[:, None] - book) ** 2).sum(2)
    assert (got.entry == square.argmin(1)).all() and (got.square == square.min(1)).all()
    assert got.computed < 0.8 * 500 * 16


# 12. Divergence
TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_divergence(rows, top=200):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = [tuple(x or "" for x in r) for r in rows]
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        words = [w.translate(lower) for w in TERM.findall(text)]
        count[lang, source].update(words)
        docs[lang].update(set(words))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= 3]
        all_of = Counter()
        for s in sources:
            all_of.update(count[lang, s])

        def shares(c):
            whole = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // whole for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(all_of)
        for s in sources:
            pair = [
                (h, sum((p[s][t] - p[h][t]) ** 2 // p[h][t] for t in kept)) for h in sources if h != s
            ]
            term = [
                (t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept
                if count[lang, s][t] and p[s][t] > q[t]
            ]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(found[:most])]
    return out


def corpus(seed, n=120):
    draw = random.Random(seed)
    words = [f"{a}{b}" for a in ("Ab", "É", "z", "ñ", "q-r", "x1y") for b in ("", "o", "UU", "字")]
    rows = [
        (draw.choice(["en", "fr", None, ""]), draw.choice([f"s{i}" for i in range(9)] + [None, ""]),
         " ".join(draw.choice(words) for _ in range(draw.randrange(40))))
        for _ in range(n)
    ]
    rows += [("xx", "only", "One two"), ("yy", "a", None), ("yy", "b", ""), ("yy", "c", "... 12")]
    return rows + rows[:7] + [("en", "hot", "Ab z " * 3000)] * 2


TEXTS_DDL = "lang STRING, source STRING, text STRING"


def test_divergence_odd(spark, monkeypatch):
    rows = corpus(1)
    df = extra(spark.createDataFrame(rows, TEXTS_DDL).repartition(4))
    want = order(plain_divergence(rows))
    assert order(divergence.report(df).collect()) == want
    assert divergence.report(spark.createDataFrame([], TEXTS_DDL)).count() == 0
    # Many small blocks of groups and terms, long texts cut, few ranks.
    monkeypatch.setattr(divergence, "BATCH", 400)
    shares = divergence.Shares(df, groups=2, terms=3)
    assert shares.groups.agg(F.max("n_blocks"), F.max("c_blocks")).first()[0] > 3
    got = divergence.ranked(divergence.divergences(shares), "pair").collect()
    assert order(got) == [r for r in want if r[2] == "pair"]
    few = divergence.report(df, top=2).where("part = 'term'").collect()
    assert order(few) == order(r for r in plain_divergence(rows, 2) if r[2] == "term")


def test_shares_are_exact_for_great_counts(spark):
    big = [(0, 1), (6, 7), (10 ** 15 - 1, 10 ** 15), (123456789012345, 9 * 10 ** 15 - 1), (2, 3)]
    df = spark.createDataFrame(big, "n LONG, whole LONG")
    got = [r[0] for r in df.select(divergence.share(F.col("n"), F.col("whole"))).collect()]
    assert got == [1 + 10 ** 9 * (n + 1) // w for n, w in big]


def test_only_slices_meet_in_a_task(spark):
    shares = divergence.Shares(spark.createDataFrame(corpus(2), TEXTS_DDL), groups=3, terms=4)
    rows = divergence.cells(shares).where("lang = 'en' and term is not null")
    sizes = rows.groupBy("a", "b", "c").agg(F.countDistinct("term").alias("t")).collect()
    kept = shares.rows.where("lang = 'en'").select("term").distinct().count()
    assert len(sizes) > 6 and max(r["t"] for r in sizes) < kept


# 13. Token counts
@pytest.fixture(scope="module")
def file():
    pytest.importorskip("tokenizers")
    if not os.path.exists(FILE):
        pytest.skip("no tokenizer file")
    return token_counts.read_file(FILE)


@pytest.fixture(scope="module")
def counter(file):
    of = token_counts.rules(file)
    return token_counts.Counter(of, token_counts.table(token_counts.NONE, of))


def library_counts(file, strings):
    encoded = token_counts.library(file).encode_batch(
        [s or "" for s in strings], add_special_tokens=False
    )
    return [len(e.ids) for e in encoded]


PIECES = st.one_of(
    st.sampled_from(["'s", "'ll", "'v", " 're", "''t", "<|endoftext|>", "<|endof", "text|>", "  ", "\n\n",
                     "\t ", " ", "　x", " ", "12", "٣", "é", "中文", "🙂", "a", "I'm", " '", "\x85"]),
    st.text(max_size=6),
)


@settings(max_examples=200, deadline=None, suppress_health_check=list(__import__("hypothesis").HealthCheck))
@given(st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=1, max_size=12))
def test_counts_are_the_librarys(file, counter, strings):
    n_bytes, n_tokens = counter.counts(pa.array(strings, pa.string()))
    assert n_tokens.tolist() == library_counts(file, strings)
    assert n_bytes.tolist() == [len(s.encode()) for s in strings]


def test_counts_odd(spark, file, monkeypatch):
    draw = random.Random(5)
    long = " ".join(draw.choice(["naïve", "it's", "x\n y", "1234", "Ünï"]) for _ in range(9000))
    strings = [None, "", " ", "plain words and more words", long, "y" * 5000, "a" * 511, "one", "one",
               "cut <|endoftext|> here", " \n" * 300, "<|endof", "text|>"]
    docs = spark.createDataFrame([(i if i else None, s) for i, s in enumerate(strings)], "doc_id LONG, text STRING")
    want = order(
        (i if i else None, len((s or "").encode()), n, n > 512)
        for i, (s, n) in enumerate(zip(strings, library_counts(file, strings)))
    )
    got = token_counts.report(extra(docs).repartition(3), file)
    assert order(got.collect()) == want
    assert token_counts.report(docs.limit(0), file).count() == 0
    # Small chunks, so long texts are cut; few counters, summaries merged in levels, a cache that overflows.
    monkeypatch.setattr(texts, "CHUNK", 700)
    for name, value in (("FREQUENT", 3), ("FAN", 2), ("CACHE", 2)):
        monkeypatch.setattr(token_counts, name, value)
    assert order(token_counts.report(docs.repartition(7), file).collect()) == want


def test_frequent_pre_tokens_stay_in_merged_summaries():
    draw = random.Random(7)
    words = [draw.choice(["a", "b", "c"]) if draw.random() < .6 else f"w{draw.randrange(500)}" for _ in range(8000)]
    def one(part):
        low = np.array([int.from_bytes(w.encode(), "little") for w in part], np.uint64)
        return token_counts.Summary(low, low * np.uint64(0), np.ones(len(low), np.int64))
    parts = [token_counts.combined([one(words[i:i + 400])], 20) for i in range(0, 8000, 400)]
    whole = token_counts.combined(parts, 20)
    real = Counter(words)
    found = {int(x).to_bytes(8, "little").rstrip(b"\0").decode(): n for x, n in zip(whole.low.tolist(), whole.count.tolist())}
    assert {"a", "b", "c"} <= set(found)
    assert all(real[w] - 8000 // 21 <= n <= real[w] for w, n in found.items())


def test_the_table_saves_the_encoder_work(file):
    of = token_counts.rules(file)
    column = pa.array(["the cat and the dog " * 50])
    got = token_counts.found(*next(token_counts.pieces(column))[1:], of)
    ones = token_counts.Summary(got.low, got.high, np.ones(len(got.low), np.int64))
    known = token_counts.Counter(of, token_counts.table(token_counts.combined([ones]), of))
    blank = token_counts.Counter(of, token_counts.table(token_counts.NONE, of))
    assert known.counts(column)[1].tolist() == blank.counts(column)[1].tolist()
    assert known.encoded == 0 and blank.encoded == 6


def test_other_tokenizers_are_refused(file):
    with pytest.raises(ValueError):
        token_counts.rules(file.replace('"add_prefix_space":false', '"add_prefix_space":true', 1)
                           if '"add_prefix_space":false' in file
                           else file.replace('"add_prefix_space": false', '"add_prefix_space": true', 1))
