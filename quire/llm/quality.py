"""Quality rules with risk-controlled thresholds.

Every rule rejects a document whose statistic exceeds a cutoff. Labelled documents decide the
cutoffs, for each stratum of documents on its own: a cutoff may be used if an exact binomial
test shows that it rejects less than its share of the good documents. A stratum is every value that
has labelled documents, null too; one without a proof, or without labels, rejects nothing. The
level is divided by the number of strata and rules; the cutoffs of one rule are tested from lenient to strict up to
the first failure, which needs no further correction. Of those that pass, the one is used that
tells bad from good documents best. So, with probability 1 - DELTA, no stratum loses more than
ALPHA of its good documents to all rules together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.llm import texts
from quire.llm.shared import stored

#: Largest share of good documents that may be rejected in a stratum, and the error level.
ALPHA, DELTA = 0.05, 0.05
#: A good document lost weighs as much as so many bad ones caught, by shares.
DEAR = 5
#: Cutoffs are multiples of one step, up to STEPS of them.
STEPS = 200

#: Statistics of rules and the step of their cutoffs.
RULES = {
    "symbols": 0.005, "upper": 0.005, "marks": 0.005, "repeats": 0.005, "dup_lines": 0.005,
    "long_words": 0.1, "short_words": 0.005, "lines": 0.005, "digits": 0.005,
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHAPE = ", ".join([*(f"{c} LONG" for c in COUNTS), *(f"{r} DOUBLE" for r in RULES)])

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
UPPER = texts.table((65, 90))
MARK = np.zeros(256, bool)
MARK[list(b"!?;:=_~^@\\{}[]/+")] = True
DIGIT = texts.table((48, 57))
POINT = ~texts.table((0x80, 0xBF))  # first byte of a code point
NOT_LINE_END = ~texts.table((10, 10))
WINDOW = 8


def _salted(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    return texts.mix(keys + texts.mix(owner.astype(np.uint64) + np.uint64(1)))


def measure(chunk: texts.Chunk) -> dict[str, np.ndarray]:
    """Counts and rule statistics of the texts of a chunk."""
    data, n = chunk.data, len(chunk)
    lo, hi, at = chunk.words()
    n_words = np.diff(at)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum(POINT[data] & texts.WORD[data], out=points[1:])
    chars = points[chunk.ends] - points[chunk.starts]
    sums = texts.prefix(texts.BYTE[data])

    # Lines with a word; a line end belongs to no line, so line bounds split like word bounds.
    line_lo, line_hi, line_at = chunk.words(NOT_LINE_END)
    has_word = np.searchsorted(lo, line_hi) > np.searchsorted(lo, line_lo)
    line_of = np.repeat(np.arange(n), np.diff(line_at))[has_word]
    lines = _salted(texts.ranged(sums, line_lo[has_word], line_hi[has_word]), line_of)
    _, first = np.unique(lines, return_index=True)
    n_lines = np.bincount(line_of, minlength=n)
    n_dup = n_lines - np.bincount(line_of[first], minlength=n)

    # Words in windows that occur twice in the text.
    words = texts.ranged(sums, lo, hi)
    word_sums = texts.prefix(words)
    word_of = np.repeat(np.arange(n), n_words)
    place = np.arange(len(lo))
    begin = place[place + WINDOW <= at[1:][word_of]] if len(lo) else place
    keys = _salted(texts.ranged(word_sums, begin, begin + WINDOW), word_of[begin])
    twice = begin[texts.repeated(keys)]
    n_repeat = texts.counts(at, texts.covered(twice, WINDOW, len(lo)))

    safe_chars, safe_words = np.maximum(chars, 1), np.maximum(n_words, 1)
    mean = chars / safe_words
    n_symbols = chunk.per_text(SYMBOL[data])
    return {
        "n_words": n_words, "word_chars": chars, "n_symbols": n_symbols,
        "n_dup_lines": n_dup, "n_repeat_words": n_repeat,
        "symbols": n_symbols / safe_chars,
        "upper": chunk.per_text(UPPER[data]) / safe_chars,
        "marks": chunk.per_text(MARK[data]) / safe_chars,
        "repeats": n_repeat / safe_words,
        "dup_lines": n_dup / np.maximum(n_lines, 1),
        "long_words": mean, "short_words": 1 / np.maximum(mean, 1),
        "lines": n_lines / safe_words,
        "digits": chunk.per_text(DIGIT[data]) / safe_chars,
    }


def measures(column: pa.Array) -> pa.StructArray:
    parts = [measure(c) for c in texts.chunks(column)]
    names = [*COUNTS, *RULES]
    kinds = [pa.int64()] * len(COUNTS) + [pa.float64()] * len(RULES)
    arrays = [
        pa.array(np.concatenate([p[k] for p in parts]) if parts else [], t)
        for k, t in zip(names, kinds)
    ]
    return pa.StructArray.from_arrays(arrays, names)


def statistics(text: str) -> Column:
    """Counts and rule statistics of a text column, as a struct."""
    @F.arrow_udf(StructType.fromDDL(SHAPE))
    def measured_parts(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in column:
            yield measures(part)

    # So the optimizer doesn't repeat it in filters.
    return measured_parts.asNondeterministic()(text)


def base_failed(m: str = "m") -> Column:
    """Fewer than 20 words, or more than 30 % of them in repeated windows."""
    return (F.col(f"{m}.n_words") < 20) | (
        100 * F.col(f"{m}.n_repeat_words") > 30 * F.col(f"{m}.n_words")
    )


def fewest_errors(n: int, rate: float, level: float) -> int:
    """Largest k with P(Binomial(n, rate) <= k) <= level; -1 if even 0 errors prove nothing."""
    total, k = 0.0, -1
    while k + 1 <= n:
        j = k + 1
        total += math.exp(
            math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1)
            + j * math.log(rate) + (n - j) * math.log1p(-rate)
        )
        if total > level:
            break
        k = j
    return k


def proven(bins: list[dict], level: float) -> int | None:
    """Bin of the best cutoff of a rule in a stratum from its counts (good, bin, n), if one is proven."""
    bad, good = np.zeros((2, STEPS + 1), np.int64)
    for x in bins:
        (good if x["good"] else bad)[x["bin"]] += x["n"]
    n = int(good.sum())
    most = fewest_errors(n, ALPHA / len(RULES), level)
    # Rejected by cutoff c * step: the documents in bins above c.
    lost = n - np.cumsum(good)
    caught = bad.sum() - np.cumsum(bad)
    worth = caught / max(1, bad.sum()) - DEAR * lost / max(1, n)
    # Losses fall with the cutoff, so those that pass are the ones before the first failure.
    passed = np.flatnonzero((lost[:-1] <= most) & (worth[:-1] > 0))
    # Of equal ones the most lenient.
    return int(passed[::-1][np.argmax(worth[passed[::-1]])]) if len(passed) else None


def fit(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """(of, cutoffs): the bin of each rule's cutoff for every stratum that has a proven one.

    Takes rows (doc_id, stratum, m) and labels (doc_id, quality). All labelled documents that pass
    the base rules count, as counts by stratum, rule and bin, of which the tests read those of one
    stratum and rule at a time; only the number of strata reaches the driver. Null ids match no
    label; repeated labels count once. A rule without proof has a null cutoff.
    """
    told = labels.where("quality is not null").select(
        F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("good")
    ).distinct()
    rows = measured.where(~base_failed()).join(told, F.col("doc_id") == F.col("id"))
    bins = F.array(*[
        F.struct(
            F.lit(rule).alias("rule"),
            F.least(F.ceil(F.col(f"m.{rule}") / step), F.lit(STEPS)).cast("int").alias("bin"),
        ) for rule, step in RULES.items()
    ])
    found = stored(
        rows.select("stratum", "good", F.explode(bins).alias("x")).groupBy(
            "stratum", "good", "x.rule", "x.bin"
        ).agg(F.count("*").alias("n")),
        "bins",
    )
    strata = found.select("stratum").distinct().count()
    level = DELTA / (max(1, strata) * len(RULES))
    kind = found.schema["stratum"].dataType.simpleString()

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [proven(x, level) for x in batch.column("bins").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("stratum"), batch.column("rule"), pa.array(best, pa.int32())],
                ["of", "rule", "best"],
            )

    each = found.groupBy("stratum", "rule").agg(
        F.collect_list(F.struct("good", "bin", "n")).alias("bins")
    )
    best = each.mapInArrow(prove, f"of {kind}, rule STRING, best INT").where("best is not null")
    return best.groupBy("of").agg(F.struct(*[
        F.max(F.when(F.col("rule") == rule, F.col("best"))).alias(rule) for rule in RULES
    ]).alias("cutoffs"))


def with_cutoffs(rows: DataFrame, stratum: str, cutoffs: DataFrame) -> DataFrame:
    """Rows with the cutoffs of their stratum, null where none is proven."""
    # A proof takes 900 good labelled documents, so the table is at most a 900th of the labels.
    return rows.join(F.broadcast(cutoffs), F.col(stratum).eqNullSafe(F.col("of")), "left")


def passes(m: str = "m") -> Column:
    """Whether no rule of the row's stratum rejects it."""
    rejected = F.lit(False)
    for rule, step in RULES.items():
        level = F.least(F.ceil(F.col(f"{m}.{rule}") / step), F.lit(STEPS))
        rejected = rejected | F.coalesce(level > F.col(f"cutoffs.{rule}"), F.lit(False))
    return ~rejected


def measured(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """(doc_id, stratum, m) of all rows of ``docs``."""
    return docs.select("doc_id", F.col(stratum).alias("stratum"), statistics("text").alias("m"))


def judged(measured_rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, counts, base_failed, kept) for stored output of ``measured``.

    A null or empty text has no words and so fails the base rules; an empty table gives no rows.
    """
    failed = base_failed()
    rows = with_cutoffs(measured_rows, "stratum", fit(measured_rows, labels))
    return rows.select(
        "doc_id", *[f"m.{c}" for c in COUNTS], failed.alias("base_failed"),
        (~failed & passes()).alias("kept"),
    )


def keep(docs: DataFrame, measured_rows: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The documents that no rule rejects, with all columns they came with."""
    cutoffs = fit(measured_rows, labels)
    rows = docs.select(F.struct("*").alias("row"), statistics("text").alias("m"))
    rows = with_cutoffs(rows.where(~base_failed()), f"row.{stratum}", cutoffs)
    return rows.where(passes()).select("row.*")
