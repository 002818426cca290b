"""Bucketed tables: what a change touches, what a failed job leaves, and the jobs and streams on them."""

import json
import os

import pytest
from pyspark.sql import functions as F

from quire import schemas
from quire.operators import articles, keyed
from quire.plans import jobs
from quire.sources import buckets, responses, tables
from quire.streaming import jobs as streams

KINDS = {
    "parents": buckets.Kind("doi STRING, n INT"),
    "children": buckets.Kind("doi STRING, name STRING"),
}


def files(root):
    """Every data file below a folder with its time of change."""
    return {
        os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns
        for d, _, names in os.walk(root) for n in names if n.endswith(".parquet")
    }


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    parents = spark.range(300).select(
        F.col("id").cast("string").alias("doi"), F.col("id").cast("int").alias("n")
    )
    children = parents.select("doi", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("name"))
    none = spark.createDataFrame([(None, 1)], KINDS["parents"].ddl)
    first = buckets.Store.open(spark, str(tmp_path), KINDS, 16)
    return first.commit({"parents": parents.unionByName(none), "children": children})


def test_a_change_writes_only_the_buckets_of_its_keys(spark, store, tmp_path):
    before = files(tmp_path)
    new = spark.createDataFrame([("7", -7), ("1000", -1)], "doi STRING, n INT")
    only = store.buckets_of(new, "parents")
    assert 1 <= len(only) <= 2
    changed = keyed.upsert(store.read("parents", only), new, ["doi"])
    after = store.commit({"parents": changed}, only)
    written = set(files(tmp_path)) - set(before)
    assert {n: t for n, t in files(tmp_path).items() if n in before} == before
    assert {n.split("bucket=")[1].split("/")[0] for n in written} == {str(b) for b in only}
    assert rows(after.read("parents")) == rows(keyed.upsert(store.read("parents"), new, ["doi"]))
    assert after.state["tables"]["children"] == store.state["tables"]["children"]
    again = buckets.Store.open(spark, str(tmp_path), KINDS)
    assert again.state == after.state and rows(again.read("children")) == rows(store.read("children"))


def test_reads_open_only_the_wanted_folders(store):
    some = store.read("parents", [3, 5]).inputFiles()
    assert some and all("bucket=3/" in f or "bucket=5/" in f for f in some)
    assert rows(store.read("parents", [])) == []


def test_a_failed_job_is_invisible_and_its_repeat_works(spark, store, tmp_path):
    bad = F.when(F.col("n") >= 0, F.raise_error(F.lit("lost"))).otherwise(F.col("n"))
    whole = rows(store.read("parents"))
    with pytest.raises(Exception, match="lost"):
        store.commit({
            "children": store.read("children").limit(1),
            "parents": store.read("parents").withColumn("n", bad.cast("int")),
        })
    now = buckets.Store.open(spark, str(tmp_path), KINDS)
    assert now.state == store.state and rows(now.read("parents")) == whole
    assert now.read("children").count() == 600
    assert now.commit({"children": now.read("children").limit(1)}).read("children").count() == 1


def test_the_second_of_two_jobs_from_one_manifest_fails(store):
    store.commit({"children": store.read("children")})
    with pytest.raises(Exception, match="already exists"):
        store.commit({"parents": store.read("parents")})


def test_rows_of_other_buckets_are_refused(store):
    only = store.buckets_of(store.read("parents").where("doi = '7'"), "parents")
    with pytest.raises(ValueError, match="outside the buckets"):
        store.commit({"parents": store.read("parents")}, only)


def test_emptied_buckets_null_keys_and_new_bucket_counts(spark, store, tmp_path):
    null_bucket = store.buckets_of(spark.createDataFrame([(None,)], "doi STRING"), "parents")
    assert store.read("parents", null_bucket).where("doi is null").count() == 1
    emptied = store.commit({"parents": store.read("parents", null_bucket).limit(0)}, null_bucket)
    assert emptied.read("parents", null_bucket).count() == 0
    assert emptied.read("parents").count() == 301 - store.read("parents", null_bucket).count()
    wider = emptied.rebucketed(40)
    assert wider.state["buckets"] == 40
    assert rows(wider.read("parents")) == rows(emptied.read("parents"))
    assert wider.read("children", wider.buckets_of(
        spark.createDataFrame([("7",)], "doi STRING"), "children")).where("doi = '7'").count() == 2


def test_a_hot_key_is_split_over_tasks(spark, tmp_path):
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(30_000).select(F.lit("hot").alias("doi"), F.sha2(F.col("id").cast("string"), 256).alias("name"))
        store = buckets.Store.open(spark, str(tmp_path), KINDS, 4).commit({"children": hot})
        assert len(files(tmp_path)) > 3 and store.read("children").count() == 30_000
    finally:
        for k in conf:
            spark.conf.unset(k)


def page(*items):
    return json.dumps({"message": {"items": list(items)}})


def item(doi, title):
    return {"DOI": doi, "title": [title], "author": [{"given": "A", "family": title}],
            "published": {"date-parts": [[2001, 2]]}, "type": "journal-article"}


def titles(spark, root):
    cat = tables.load_catalogue(spark, root)
    return {r["doi"]: (r["title"], r["family"]) for r in
            cat.articles.join(cat.authors, "doi").collect()}


def test_merging_streams_reads_new_parts_and_touched_buckets_only(spark, tmp_path):
    landed = tmp_path / "pages" / "journal=JOP"
    landed.mkdir(parents=True)
    out, check, root = (str(tmp_path / n) for n in ("flat", "check", "db"))

    def land(name, *pages, at):
        (landed / name).write_text("\n".join(pages))
        os.utime(landed / name, (at, at))
        streams.flatten_stream(
            streams.page_stream(spark, str(tmp_path / "pages")), out, check
        ).awaitTermination()

    many = [item(f"10.1/{i}", f"first {i}") for i in range(200)]
    land("a.json", page(*many), at=1_700_000_000)
    assert jobs.merge_landed(spark, root, out) == 1
    assert len(titles(spark, root)) == 200
    first = tables.catalogue_store(spark, root)

    land("c.json", page(item("10.1/3", "third")), at=1_700_000_900)
    assert jobs.merge_landed(spark, root, out) == 1
    # A page that landed before the last one, but was streamed after it, loses.
    land("b.json", page(item("10.1/3", "second"), item("10.1/new", "new")), at=1_700_000_500)
    new, _ = streams.unapplied(spark, out, tables.catalogue_store(spark, root).ledger[out])
    assert len(new) == 1 and all("batch=2" in f for f in streams.read_parts(spark, out, new).inputFiles())
    assert jobs.merge_landed(spark, root, out) == 1
    got = titles(spark, root)
    assert got["10.1/3"] == ("third", "third") and got["10.1/new"] == ("new", "new")
    assert got["10.1/7"] == ("first 7", "first 7") and len(got) == 201

    whole = streams.merge_flattened(articles.empty(spark), spark, out)
    assert {r["doi"]: r["title"] for r in whole.articles.collect()} == {d: t for d, (t, _) in got.items()}
    last = tables.catalogue_store(spark, root)
    kept = [b for b, f in last.state["tables"]["articles"].items()
            if first.state["tables"]["articles"].get(b) == f]
    assert len(kept) >= len(first.state["tables"]["articles"]) - 3
    assert jobs.merge_landed(spark, root, out) == 0
    assert tables.catalogue_store(spark, root).state == last.state


def test_older_snapshots_are_taken_in_by_the_first_change(spark, tmp_path):
    root = str(tmp_path / "db")
    old = spark.createDataFrame(
        [("10.1/a", "J", "T", 2000, 1, None, None, None, None)], schemas.ARTICLE)
    tables.write_table(old, f"{root}/articles")
    answers = tmp_path / "answers"
    answers.mkdir()
    lines = ['{"dois": ["10.1/a", "10.1/b"], "items": [{"abstract": "Found"}, null]}',
             '{"dois": ["10.1/a"], "items": [{"abs', '{"dois": "10.1/a"}', '{"items": []}', "", "[]"]
    (answers / "x.json").write_text("\n".join(lines))
    assert tuple(jobs.supplement(spark, root, str(answers)).first()) == (1, 1)
    assert tables.load_catalogue(spark, root).articles.first()["abstract"] == "Found"
    bad = tables.read_table(spark, f"{root}/rejected_abstracts", "line_text STRING, reason STRING")
    assert rows(bad) == rows(spark.createDataFrame([
        (lines[1], "unreadable line"), (lines[2], "unreadable line"), (lines[3], "no dois"),
        (lines[5], "unreadable line")], "line_text STRING, reason STRING"))


@pytest.mark.parametrize("reader", [
    responses.read_dataverse, responses.read_zenodo, responses.read_references])
def test_response_lines_are_good_or_rejected(spark, tmp_path, reader):
    lines = ['{"doi": "10.1/a", "status": 200, "attempt": 3, "body": {}}', '{"doi": "10.1/b", "sta',
             '{"status": 200}', '{"doi": "10.1/c", "status": "many"}', "  "]
    (tmp_path / "r.json").write_text("\n".join(lines))
    got = reader(spark, str(tmp_path)).cache()
    assert [r["doi"] for r in responses.good(got).collect()] == ["10.1/a"]
    assert {r["line_text"]: r["reason"] for r in responses.rejects(got).collect()} == {
        lines[1]: "unreadable line", lines[2]: "no doi", lines[3]: "unreadable line"}
    assert "reason" not in responses.good(got).columns


def test_issue_batches_read_only_the_buckets_of_their_keys(spark, tmp_path):
    body = "### DOI\n\n{}\n"
    ddl = f"{schemas.ISSUE}, pos BIGINT"
    source, log, check = tmp_path / "issues", str(tmp_path / "log"), str(tmp_path / "check")
    source.mkdir()

    def land(name, forms):
        (source / name).write_text("\n".join(json.dumps(
            {"issue_id": i, "type": "correction", "body": body.format(d), "pos": p}) for i, d, p in forms))
        streams.issue_stream(spark.readStream.schema(ddl).json(str(source)), log, check).awaitTermination()

    land("a.json", [(str(i), f"10.1/{i}", i) for i in range(100)])
    first = streams.memory_of(spark, log)
    assert first.read("keys").count() == 200
    land("b.json", [("5", "10.1/other", 200), (None, "10.1/other", 201), (None, "10.1/7", 202), ("new", "10.1/7", 203)])
    assert sorted(r["pos"] for r in streams.read_log(spark, log).collect() if r["pos"] >= 100) == [201, 203]
    last = streams.memory_of(spark, log)
    held, now = first.state["tables"]["keys"], last.state["tables"]["keys"]
    assert sum(now[b] != f for b, f in held.items()) <= 4 < len(held)
    # A log without a memory is read once; the run goes on as before.
    other = str(tmp_path / "copy")
    streams.read_log(spark, log).write.parquet(f"{other}/run=old/batch=0")
    stream = spark.readStream.schema(ddl).json(str(source))
    streams.issue_stream(stream, other, str(tmp_path / "check2")).awaitTermination()
    assert streams.read_log(spark, other).count() == streams.read_log(spark, log).count()


def test_unknown_names_of_replies_are_reported(spark, geo):
    from quire.operators import classify

    raw = [("10.1/a", '{"countries": ["France", "Narnia", "fra", "Narnia", ""], "regions": ["Caribbean", "Moon"]}'),
           ("10.1/b", '{"countries": ["Russia", "USSR ghost"], "regions": null}'), ("10.1/c", "broken")]
    replies = spark.createDataFrame(raw, "doi STRING, raw STRING")
    got = classify.unknown_names(replies, geo)
    assert rows(got) == [("10.1/a", "country", "Narnia"), ("10.1/a", "region", "Moon"),
                         ("10.1/b", "country", "USSR ghost")]
