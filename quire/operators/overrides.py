"""Human corrections and additions: an append-only log folded onto the catalogue.

A log entry is raw JSON (``list, pos, issue, doi, raw``) because a missing key and an
explicit null mean different things. ``raw`` is read as VARIANT; every field is one
``max_by`` in a single grouped aggregation, so a DOI corrected any number of times costs
one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire import schemas, vocab
from quire.functions import replies, text
from quire.functions.text import once
from quire.operators import keyed
from quire.operators.articles import Catalogue

CORRECTIONS, ADDITIONS = "corrections", "additions"
CLASS_FIELDS = [
    "is_hpe", "period_start", "period_end", "regions", "countries", "replication_url"
]
ARTICLE_FIELDS = ["title", "year", "abstract"]
FIELDS = CLASS_FIELDS + ARTICLE_FIELDS
REQUIRED = ["doi", "title", "replication_url"]
PEOPLE = "array<struct<sequence:int,given:string,family:string>>"


def text_value(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def list_value(value: Column) -> Column:
    return F.when(replies.is_list(value), F.try_variant_get(value, "$", "array<string>"))


def people_value(value: Column) -> Column:
    """JSON author list as rows with their position."""
    people = F.try_variant_get(value, "$", "array<struct<given:string,family:string>>")
    return F.when(replies.is_list(value), F.transform(people, lambda p, i: F.struct(
        i.cast("int").alias("sequence"), p["given"].alias("given"), p["family"].alias("family"),
    )))


def typed(name: str, value: Column) -> Column:
    if name == "is_hpe":
        return replies.truthy(value)
    if name in ("period_start", "period_end", "year"):
        return F.try_variant_get(value, "$", "int")
    if name in ("regions", "countries"):
        return list_value(value)
    return text_value(value)


def at(name: str) -> Column:
    """Member of the parsed entry: absent keys are SQL null, explicit nulls are not."""
    return replies.field(F.col("entry"), name)


def has(name: str) -> Column:
    return at(name).isNotNull()


def read_entries(log: DataFrame) -> DataFrame:
    """Parse the log: ``entry`` as VARIANT, and a reject ``reason``."""
    def unreadable(name: str) -> Column:
        bad = typed(name, at(name)).isNull()
        if name not in ("regions", "countries"):
            bad = bad & (replies.kind(at(name)) != "VOID")
        return F.when(has(name) & bad, F.lit(name))

    broken = F.array_compact(F.array(*[unreadable(n) for n in FIELDS if n != "is_hpe"]))
    missing = F.array_compact(F.array(*[F.when(~has(n), F.lit(n)) for n in REQUIRED]))
    reason = (
        F.when(~replies.is_object(F.col("entry")), F.lit("not a JSON object"))
        .when(F.coalesce(F.col("doi"), F.lit("")) == "", F.lit("missing doi"))
        .when(F.col("list") == ADDITIONS, listing("missing required fields: ", missing))
    )
    reason = F.coalesce(reason, listing("unreadable: ", broken))
    return once(once(log, "entry", F.try_parse_json("raw")), "reason", reason)


def listing(label: str, found: Column) -> Column:
    """``label`` and the names found, null when there are none."""
    return text.let(found, lambda names: F.when(
        F.size(names) > 0, F.concat(F.lit(label), F.array_join(names, ", "))
    ))


def usable(entries: DataFrame, which: str) -> DataFrame:
    return entries.where((F.col("list") == which) & F.col("reason").isNull())


def changes_something() -> Column:
    """Whether a correction has a known field, or a non-empty author list."""
    change = F.coalesce(F.size(people_value(at("authors"))), F.lit(0)) > 0
    for name in FIELDS:
        change = change | has(name)
    return change


def fold_corrections(corrections: DataFrame) -> DataFrame:
    """One row per DOI: for each field a ``struct<value>`` from the last entry that has the
    key, or null when none does."""
    def last(name: str) -> Column:
        value = F.struct(typed(name, at(name)).alias("value"))
        return F.max_by(value, F.when(has(name), F.col("pos"))).alias(name)

    people = people_value(at("authors"))
    return corrections.groupBy("doi").agg(
        *[last(f) for f in FIELDS],
        F.max_by(people, F.when(F.size(people) > 0, F.col("pos"))).alias("authors"),
    )


def corrected(df: DataFrame, fold: DataFrame, fields: list[str]) -> DataFrame:
    changes = fold.select("doi", F.struct(*fields).alias("_fix"))
    joined = df.join(changes, "doi", "left")
    for f in fields:
        fix = F.col("_fix")[f]
        joined = joined.withColumn(f, F.when(fix.isNotNull(), fix["value"]).otherwise(F.col(f)))
    return joined.select(*df.columns)


def apply_corrections(cat: Catalogue, entries: DataFrame) -> Catalogue:
    """Fold the corrections of classified DOIs onto the three tables.

    Folding comes before the look-up: it leaves one row per DOI, however often corrected.
    """
    fold = keyed.keep_keys(
        fold_corrections(usable(entries, CORRECTIONS)), cat.classifications, ["doi"]
    )
    people = fold.where(F.col("authors").isNotNull())
    rows = people.select("doi", F.inline("authors"))
    return Catalogue(
        corrected(cat.articles, fold, ARTICLE_FIELDS),
        keyed.replace_children(cat.authors, rows, people.select("doi"), "doi"),
        corrected(cat.classifications, fold, CLASS_FIELDS),
    )


def addition_rows(entries: DataFrame) -> DataFrame:
    """Usable additions as one typed row each, defaults filled in, nested ``authors``."""
    none = F.array().cast("array<string>")
    journal = text_value(at("journal"))
    return usable(entries, ADDITIONS).select(
        "doi", "pos",
        F.when(journal != "", journal).otherwise(F.lit(vocab.MISSING_JOURNAL)).alias("journal"),
        *[typed(f, at(f)).alias(f) for f in
          ("title", "year", "abstract", "period_start", "period_end", "replication_url")],
        F.when(has("is_hpe"), replies.truthy(at("is_hpe"))).otherwise(F.lit(True)).alias("is_hpe"),
        *[F.coalesce(list_value(at(f)), none).alias(f) for f in ("regions", "countries")],
        people_value(at("authors")).alias("authors"),
    )


def apply_additions(
    cat: Catalogue, entries: DataFrame, stamp: Column | None = None, cascade: bool = False
) -> Catalogue:
    """Insert or wholly replace the added articles; the last addition per DOI wins.

    An addition with an author list replaces the authors. Without one, old authors stay,
    or go when ``cascade`` is set.
    """
    rows = addition_rows(entries)
    last = keyed.latest(rows, ["doi"], [F.col("pos")])
    people = last if cascade else rows.where(F.col("authors").isNotNull()).groupBy("doi").agg(
        F.max_by("authors", "pos").alias("authors")
    )
    blank = {c: F.lit(None).cast("string") for c in ("volume", "issue", "pages")}
    articles = last.withColumns({**blank, "month": F.lit(None).cast("int")})
    classes = last.withColumns({
        "backend": F.lit(vocab.MANUAL_BACKEND), "model": F.lit(vocab.MANUAL_MODEL),
        "classified_at": F.current_timestamp() if stamp is None else stamp,
    })
    return Catalogue(
        keyed.upsert(cat.articles, articles.select(*cat.articles.columns), ["doi"]),
        keyed.replace_children(
            cat.authors, people.select("doi", F.inline("authors")), people.select("doi"), "doi"
        ),
        keyed.upsert(
            cat.classifications, classes.select(*cat.classifications.columns), ["doi"]
        ),
    )


def apply_overrides(
    cat: Catalogue, log: DataFrame, stamp: Column | None = None, cascade: bool = False,
    entries: DataFrame | None = None,
) -> Catalogue:
    """All corrections first, then all additions.

    Each of the three tables reads the parsed log. Who has stored the rows of
    :func:`read_entries` gives them as ``entries``, and nothing is parsed again.
    """
    entries = read_entries(log) if entries is None else entries
    return apply_additions(apply_corrections(cat, entries), entries, stamp, cascade)


def override_stats(
    cat: Catalogue, log: DataFrame, entries: DataFrame | None = None
) -> DataFrame:
    """One row: corrections and additions applied, corrections of unknown DOIs, rejects.

    One pass over the log and one join with the classified DOIs.
    """
    entries = read_entries(log) if entries is None else entries
    known = cat.classifications.select(F.col("doi").alias("_known")).distinct()
    good = F.col("reason").isNull()
    fix = good & (F.col("list") == CORRECTIONS)
    told = entries.join(known, F.col("doi") == F.col("_known"), "left").select(
        (fix & F.col("_known").isNotNull() & changes_something()).alias("applied"),
        (good & (F.col("list") == ADDITIONS)).alias("added"),
        (fix & F.col("_known").isNull()).alias("unknown"), (~good).alias("bad"),
    )
    return told.agg(
        F.count_if("applied").alias("corrections"), F.count_if("added").alias("additions"),
        F.count_if("unknown").alias("unknown_dois"), F.count_if("bad").alias("rejected"),
    )


def append_entries(log: DataFrame, new: DataFrame) -> DataFrame:
    """Entries of ``new`` that the log does not hold yet, each list on its own.

    An issue is applied once. Without an issue number the DOI guards instead, and an entry
    with neither is always appended. ``new`` counts as appended one by one in ``pos`` order.
    """
    columns = schemas.names(schemas.LOG_ENTRY)
    new = new.select(*columns)
    has_issue = F.coalesce(F.col("issue") != "", F.lit(False))
    has_doi = F.coalesce(F.col("doi") != "", F.lit(False))

    def first(df: DataFrame, key: str) -> DataFrame:
        rest = [c for c in columns if c not in ("list", key)]
        return df.groupBy("list", key).agg(
            F.min_by(F.struct(*rest), "pos").alias("_first")
        ).select("list", key, "_first.*").select(*columns)

    by_issue = keyed.drop_keys(
        first(new.where(has_issue), "issue"),
        log.where(has_issue).select("list", "issue").distinct(), ["list", "issue"],
    )
    seen = log.where(has_doi).select("list", "doi").distinct()
    earlier = by_issue.where(has_doi).groupBy("list", "doi").agg(F.min("pos").alias("_before"))
    by_doi = (
        keyed.drop_keys(first(new.where(~has_issue & has_doi), "doi"), seen, ["list", "doi"])
        .join(earlier, ["list", "doi"], "left")
        .where(F.col("_before").isNull() | (F.col("_before") > F.col("pos")))
    )
    return by_issue.select(*columns).unionByName(by_doi.select(*columns)).unionByName(
        new.where(~has_issue & ~has_doi)
    )
