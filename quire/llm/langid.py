"""Language ID of pages by Bayesian evidence fusion.

Four pieces of evidence add up as logarithms, for every language:

* text: byte-trigram likelihoods, learnt from all documents with a declared language. Trigrams
  overlap, so a text counts as at most TRIGRAMS independent ones.
* markup: P(declared language | language).
* address suffix: P(suffix | language).
* host: P(language | host), smoothed towards its domain, which is smoothed towards all pages.

The last three come from grouped sums of the pages' text posteriors; what a page itself added
to its host is taken out again before the host tells something about the page.

Every declared language counts. Trigram counts are a table; its languages are scored, and the
posteriors summed, in blocks of BLOCK, which bounds what a task holds. Only a page's array of posteriors
and the list of names grow with the number of languages.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import texts
from quire.llm.shared import stored

BUCKETS = 8192
#: Languages whose likelihoods a task holds, and whose posteriors one aggregation sums.
BLOCK = 128
TRIGRAMS = 40.0
#: Pages that a host needs to count as much as its domain, and a domain as much as all pages.
STRENGTH = 5.0
#: Blocks scored in one stage, each by a Python worker of its own.
CHAINED = 4
#: Suffixes are held by hash, so that their table has a fixed size.
SUFFIXES = 4096


def trigrams(chunk: texts.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each trigram that lies in one text, and the text of each."""
    data = texts.LOWER[chunk.data].astype(np.uint32)
    if len(data) < 3:
        none = np.zeros(0, np.int64)
        return none, none
    code = data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]
    bucket = (code * np.uint32(2654435761)) >> np.uint32(32 - 13)
    of = np.repeat(np.arange(len(chunk)), chunk.ends - chunk.starts)
    inside = of[:-2] == of[2:]
    return bucket[inside].astype(np.int64), of[:-2][inside]


def languages(docs: DataFrame, column: str = "lang") -> list[str]:
    """All declared languages by name."""
    return sorted(r[0] for r in docs.where(F.col(column).isNotNull()).select(column).distinct().collect())


def tallies(docs: DataFrame, known: list[str], column: str = "lang") -> DataFrame:
    """Stored (cell, n): occurrences of each trigram bucket in each language, over all documents.

    A cell is the language's place in ``known`` times BUCKETS, plus the bucket.
    """
    place, held = {name: i for i, name in enumerate(known)}, BLOCK

    def summed_up(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
        cells = [(lang * BUCKETS, np.flatnonzero(n), n) for lang, n in sums.items()]
        none = [np.zeros(0, np.int64)]
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate(none + [base + at for base, at, _ in cells])),
            pa.array(np.concatenate(none + [n[at] for _, at, n in cells])),
        ], ["cell", "n"])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            lang = np.array([place.get(x, -1) for x in batch.column("lang").to_pylist()], np.int64)
            for chunk in texts.chunks(batch.column("text")):
                bucket, of = trigrams(chunk)
                of = lang[chunk.first + of]
                bucket, of = bucket[of >= 0], of[of >= 0]
                here = np.unique(lang[chunk.first: chunk.first + len(chunk)])
                here = here[here >= 0]
                for at in range(0, len(here), held):
                    some = here[at: at + held]
                    if len(sums.keys() | set(some.tolist())) > held:
                        yield summed_up(sums)
                        sums = {}
                    mine = (of >= some[0]) & (of <= some[-1])
                    cell = np.searchsorted(some, of[mine]) * BUCKETS + bucket[mine]
                    found = np.bincount(cell, minlength=len(some) * BUCKETS).reshape(-1, BUCKETS)
                    for i, n in zip(some.tolist(), found):
                        sums[i] = sums[i] + n if i in sums else n.copy()
        yield summed_up(sums)

    rows = docs.select(F.col(column).alias("lang"), "text").mapInArrow(tally, "cell LONG, n LONG")
    return stored(rows.groupBy("cell").agg(F.sum("n").alias("n")), "trigrams")


def likelihoods(tallied: DataFrame, first: int, n: int) -> np.ndarray:
    """Log probability of each trigram bucket (rows) in each of n languages from the ``first``."""
    counts = np.zeros(n * BUCKETS)
    # At most BLOCK * BUCKETS rows.
    mine = (F.col("cell") >= first * BUCKETS) & (F.col("cell") < (first + n) * BUCKETS)
    found = tallied.where(mine).toPandas()
    counts[found["cell"].to_numpy(np.int64) - first * BUCKETS] = found["n"].to_numpy(float)
    counts = counts.reshape(n, BUCKETS).T + 0.5
    return np.log(counts / counts.sum(0))


#: Elements whose content isn't shown.
HIDDEN = ("script", "style", "nav", "head", "noscript")
OPENING = re.compile(r"<(" + "|".join(HIDDEN) + r")\b", re.I)
CLOSING = re.compile(r"</(" + "|".join(HIDDEN) + r")\s*+>", re.I)
#: Tags are read one after the other and without going back, so that a page takes linear time.
HTML_TAG = re.compile(r"<html\b[^>]*", re.I)
DECLARED = re.compile(r"""\blang\s*+=\s*+(?:["']\s*+)?([A-Za-z]+)""", re.I)


def visible(html: str) -> str:
    """The page with a blank for every comment, hidden element and tag.

    What is never closed is only a tag, or text where not even that ends. Ends are found once for the
    whole page and then looked up, so a page takes linear time however many things it leaves open.
    """
    closed: dict[str, list[int]] = {name: [] for name in HIDDEN}
    for m in CLOSING.finditer(html):
        closed[m[1].lower()].append(m.start())
    last_end, last_comment = html.rfind(">"), html.rfind("-->")
    out, shown, at = [], 0, html.find("<")
    while 0 <= at < last_end:
        to = -1
        if at + 4 <= last_comment and html.startswith("<!--", at):
            to = html.index("-->", at + 4) + 3
        elif m := OPENING.match(html, at):
            ends = closed[m[1].lower()]
            place = bisect_left(ends, m.end())
            if place < len(ends):
                to = html.index(">", ends[place]) + 1
        if to < 0:
            to = html.index(">", at + 1) + 1
        out.append(html[shown:at])
        shown = to
        at = html.find("<", to)
    out.append(html[shown:])
    return " ".join(out)


def read_page(html: str | None) -> tuple[str | None, str]:
    """Declared language (primary subtag, lower case) and visible text of a page.

    The first ``<html>`` tag with a language declares it, wherever it stands.
    """
    if not html:
        return None, ""
    told = next(filter(None, (DECLARED.search(tag[0]) for tag in HTML_TAG.finditer(html))), None)
    return told and told[1].lower(), visible(html)


def shares(scores: np.ndarray) -> np.ndarray:
    """Posteriors of rows of log likelihoods."""
    q = np.exp(scores - scores.max(1, keepdims=True))
    return q / q.sum(1, keepdims=True)


def evidence(pages: DataFrame, known: list[str], tallied: DataFrame) -> DataFrame:
    """(page_id, host, declared, q): text posteriors ``q`` in the order of ``known``.

    The first block's tasks read the pages, every block's append its languages' scores, and the last
    block's turn them into posteriors.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    after = F.expr("substring(url, instr(url, '://') + 3)")
    host = F.lower(F.regexp_extract(F.when(F.instr("url", "://") > 0, after).otherwise(""), r"^([^/?#:]*)", 1))
    rows = pages.select("page_id", F.coalesce(host, F.lit("")).alias("host"), "html")

    def scored(model, begins: bool, ends: bool):
        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            per_bucket, n_lang = model.value, model.value.shape[1]
            for batch in batches:
                for at in range(0, len(batch), 512):
                    part = batch.slice(at, 512)
                    if begins:
                        told = [read_page(h) for h in part.column("html").to_pylist()]
                        declared = pa.array([d for d, _ in told], pa.string())
                        shown = pa.array([t for _, t in told], pa.large_string())
                    else:
                        declared, shown = part.column("declared"), part.column("text")
                    scores = []
                    for chunk in texts.chunks(shown):
                        bucket, of = trigrams(chunk)
                        n = np.bincount(of, minlength=len(chunk))
                        sums = np.stack([
                            np.bincount(of, per_bucket[bucket, j], len(chunk)) for j in range(n_lang)
                        ], 1)
                        scores.append(sums * (np.minimum(n, TRIGRAMS) / np.maximum(n, 1))[:, None])
                    s = np.concatenate(scores)
                    if not begins:
                        s = np.hstack([np.asarray(part.column("q").flatten()).reshape(len(part), -1), s])
                    if ends:
                        s = shares(s)
                    at_row = pa.array(np.arange(len(part) + 1) * s.shape[1], pa.int32())
                    columns = {
                        "page_id": part.column("page_id"), "host": part.column("host"), "declared": declared,
                        "q": pa.ListArray.from_arrays(at_row, pa.array(s.ravel())),
                    }
                    if not ends:
                        columns["text"] = shown.cast(pa.string())
                    yield pa.RecordBatch.from_pydict(columns)

        return score

    shape = f"page_id {kind}, host STRING, declared STRING, q ARRAY<DOUBLE>"
    for first in range(0, len(known), BLOCK):
        n = min(BLOCK, len(known) - first)
        model = pages.sparkSession.sparkContext.broadcast(likelihoods(tallied, first, n))
        last = first + n == len(known)
        rows = rows.mapInArrow(scored(model, first == 0, last), shape if last else f"{shape}, text STRING")
        if not last and first // BLOCK % CHAINED == CHAINED - 1:
            rows = stored(rows, "scores")
    return rows


def totals(rows: DataFrame, by: list[str], q: str, n: int, name: str) -> DataFrame:
    """``by`` and the sums ``name`` of the arrays ``q`` of n posteriors."""
    def sums(column: str, size: int) -> Column:
        return F.array(*[F.sum(F.get(column, F.lit(j))) for j in range(size)])

    if n <= BLOCK:
        return rows.groupBy(*by).agg(sums(q, n).alias(name))
    cut = F.array(*[F.slice(q, at + 1, BLOCK) for at in range(0, n, BLOCK)])
    parts = rows.select(*by, F.posexplode(cut).alias("block", "part"))
    blocks = parts.groupBy(*by, "block").agg(sums("part", BLOCK).alias("sums"))
    # As many elements as there are blocks of languages.
    whole = F.array_sort(F.collect_list(F.struct("block", "sums")))
    return blocks.groupBy(*by).agg(whole.alias("blocks")).select(
        *by, F.slice(F.flatten(F.col("blocks.sums")), 1, n).alias(name)
    )


def summed(array: Column | str) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda a, x: a + x)


def log_given(counts: str, every: str) -> Column:
    """log P(value | language) up to a constant, from a value's sums and all pages' sums."""
    return F.zip_with(counts, every, lambda a, b: F.log((a + 0.5) / (b + 1.0)))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """Per page: page_id, host, declared, lang, probability, text_lang.

    Null or empty html has no text evidence and no declaration; a null or malformed url has the
    empty host. If no document declares a language, lang is null. Ties go to the language
    that is first by name. Repeated rows are judged each; other columns don't matter.
    """
    known = languages(docs)
    if not known:
        return pages.select(
            "page_id", F.lit("").alias("host"), F.lit(None).cast("string").alias("declared"),
            F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"),
            F.lit(None).cast("string").alias("text_lang"),
        )
    n = len(known)
    rows = stored(evidence(pages, known, tallies(docs, known)), "langid")
    names = F.array(*[F.lit(x) for x in known])
    mark = F.when(F.col("declared").isin(known), F.col("declared")).when(
        F.col("declared").isNotNull(), "other"
    ).otherwise("none")
    domain = F.regexp_extract("host", r"([^.]*\.[^.]*)$", 1)
    suffix = F.regexp_extract("host", r"([^.]*)$", 1)
    rows = rows.withColumns({
        "mark": mark, "domain": F.when(domain == "", F.col("host")).otherwise(domain),
        "ending": F.pmod(F.xxhash64(suffix), F.lit(SUFFIXES)),
    })
    hosts = stored(totals(rows, ["host", "domain"], "q", n, "host_n"), "hosts")
    domains = totals(hosts, ["domain"], "host_n", n, "domain_n")
    hosts = hosts.join(domains.withColumnRenamed("domain", "d"), F.col("domain") == F.col("d"))
    hosts = hosts.select(F.col("host").alias("h"), "host_n", "domain_n")
    marks = totals(rows, ["mark"], "q", n, "mark_n")
    endings = totals(rows, ["ending"], "q", n, "ending_n").withColumnRenamed("ending", "e")
    # One row, as many rows as languages and two, at most SUFFIXES rows.
    every = totals(rows, [], "q", n, "all_n")
    marks = marks.withColumnRenamed("mark", "m")
    if n <= BLOCK:
        marks, endings = F.broadcast(marks), F.broadcast(endings)
    near = rows.join(marks, F.col("mark") == F.col("m")).join(
        endings, F.col("ending") == F.col("e")
    ).join(hosts, F.col("host") == F.col("h")).withColumn("all_n", every.scalar())

    def without(column: str) -> Column:
        return F.zip_with(column, "q", lambda a, b: F.greatest(a - b, F.lit(0.0)))

    def smoothed(own: str, above: Column | str) -> Column:
        size = summed(own)
        return F.zip_with(own, above, lambda a, p: (a + STRENGTH * p) / (size + STRENGTH))

    near = near.withColumns({
        "host_n": without("host_n"), "domain_n": without("domain_n"),
        "p_all": F.transform("all_n", lambda a: (a + 1.0) / (summed("all_n") + n)),
    })
    near = near.withColumn("p_domain", smoothed("domain_n", "p_all"))
    near = near.withColumn("p_host", smoothed("host_n", "p_domain"))
    logs = [
        F.transform("q", lambda x: F.log(F.greatest(x, F.lit(1e-300)))),
        F.transform("p_host", lambda x: F.log(x)),
        log_given("mark_n", "all_n"), log_given("ending_n", "all_n"),
    ]
    fused = logs[0]
    for more in logs[1:]:
        fused = F.zip_with(fused, more, lambda a, b: a + b)
    near = near.withColumn("fused", fused)
    best = F.array_position("fused", F.array_max("fused")).cast("int")
    share = F.transform("fused", lambda x: F.exp(x - F.array_max("fused")))
    text_best = F.array_position("q", F.array_max("q")).cast("int")
    return near.select(
        "page_id", "host", "declared", F.get(names, best - 1).alias("lang"),
        (1 / summed(share)).alias("probability"), F.get(names, text_best - 1).alias("text_lang"),
    )
