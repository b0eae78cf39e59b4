"""Load or refresh the CIF side from a directory of component files.

Two passes over the text: a cheap one for every file (dates, status, parse errors) and
a full one for the files that are new or newer than what is stored.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from compdict import schema
from compdict.checkpoints import cut
from compdict.operators import merge, quality, status
from compdict.sources import cif, store


# a time after every file: no file is opened
_NEVER = datetime.datetime(9999, 1, 1)


@dataclass
class Loaded:
    tables: dict[str, DataFrame]
    components: DataFrame
    rejects: DataFrame
    gone: DataFrame
    stats: DataFrame
    new: dict[str, DataFrame] | None = None  # rows of the replaced components only
    changed: DataFrame | None = None  # their keys, ``_key`` upper case


def probe(spark: SparkSession, directory: str, known=None, docs: DataFrame | None = None, since=None) -> tuple[DataFrame, DataFrame]:
    """First pass: ``(headers, rejects)`` of every file below a directory, or of ``docs`` only.

    ``headers`` is ``(doc, id, block, created, modified, obsolete, compound, error, status)``;
    a file that yields nothing at all is there too, as failed.  ``since`` leaves files modified
    before it unopened; ``docs`` must all be modified then or later.
    """
    lines = cif.scan_lines(spark, directory, since)
    files = cif.scan_files(spark, directory)
    if docs is not None:
        lines = lines.join(docs, "doc", "left_semi")
        files = files.join(docs, "doc", "left_semi")
    segs = cif.segments(cif.units(lines))
    facts = cut(cif.document_facts(segs, known or cif.known_columns()))
    extra = cut(
        cif.unclosed_text(lines).withColumn("reason", F.lit("unclosed text field")).unionByName(
            files.join(facts, "doc", "left_anti").select("doc", F.lit("empty file").alias("reason"))
        )
    )
    headers = files.select("doc", "id").join(status.header(facts, extra), "doc", "left").select(
        "doc", "id", "block", "created", "modified",
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("obsolete", "compound")],
        F.coalesce("error", F.lit(True)).alias("error"),
    )
    headers = headers.withColumn("status", status.status(F.col("error"), F.col("compound"), F.col("obsolete")))
    return headers, facts.select("doc", F.explode("reasons").alias("reason")).unionByName(extra)


def load_directory(
    spark: SparkSession,
    directory: str,
    stored: dict[str, DataFrame] | None = None,
    tables=schema.LOADED,
    max_gone_fraction: float = 0.5,
    probed: tuple[DataFrame, DataFrame] | None = None,
) -> Loaded:
    """Replace what changed, remove what is gone, keep the rest; one bad file harms no other.

    A component that fails in either pass keeps its stored rows and is not gone; so does one
    whose new rows break a key, not-null or reference rule (``quality.constraint_closure``).  ``probed``
    gives the first pass's ``(headers, rejects)`` when they are known already; then only the
    files of components to be parsed are opened.
    """
    stored = stored or schema.empty_tables(spark, {t: schema.CIF[t] for t in tables})
    known = cif.known_columns(tables)
    headers, problems = probed or probe(spark, directory, known)
    have = stored["chem_comp"].select(
        "id", F.col("pdbx_initial_date").alias("created"), F.col("pdbx_modified_date").alias("modified")
    )
    compared = cut(status.compare_with_stored(headers, have))
    wanted = compared.filter("status = 'current' AND change <> 'unchanged'").select("doc", F.col("id").alias("stem"))

    since = None
    if probed is not None:
        # only files of wanted components are opened: the oldest of them bounds the listing
        since = wanted.join(cif.scan_files(spark, directory).select("doc", "mtime"), "doc").agg(F.min("mtime")).first()[0]
        since = since or _NEVER
    lines = cif.scan_lines(spark, directory, since).join(wanted, "doc", "left_semi")
    rows = cut(cif.category_rows(cif.segments(cif.units(lines)), known))
    text = {t: cif.table_text(rows, t) for t in tables}
    bad_casts = [
        quality.cast_rejects(text[t], quality.non_text(schema.CIF[t]), ["doc"])
        .select("doc", F.concat(F.lit(f"bad value {t}."), F.col("column")).alias("reason"))
        for t in tables
        if quality.non_text(schema.CIF[t])
    ]
    no_parent = wanted.join(
        text["chem_comp"].filter("id IS NOT NULL"), "doc", "left_anti"
    ).select("doc", F.lit("no component row").alias("reason"))
    late = no_parent
    # rows of another component than the file is named for; a null key is no component
    strangers = [
        text[t].join(wanted, "doc").filter(F.upper(schema.parent_key(t)) != F.upper("stem"))
        .select("doc", F.lit(f"other component in {t}").alias("reason"))
        for t in tables
    ]
    for df in bad_casts + strangers:
        late = late.unionByName(df)
    rejects = cut(problems.unionByName(late).distinct())

    # a component is named by its file; of two files of one name the last path wins
    good = (
        wanted.join(rejects.select("doc").distinct(), "doc", "left_anti")
        .groupBy("stem").agg(F.max("doc").alias("doc"))
    )
    good = cut(good)
    typed = {t: quality.typed_table(text[t].join(good, "doc", "left_semi"), schema.CIF[t]) for t in tables}
    # a component whose new rows break a key, not-null or reference rule keeps its stored version
    broken, _ = quality.constraint_closure(
        typed, {t: schema.parent_key(t) for t in tables}, schema.UNIQUE, schema.NOT_NULL, schema.REFERENCES
    )
    refused = good.join(broken, F.upper("stem") == F.col("comp")).select("doc", F.concat(F.lit("constraint: "), "reason").alias("reason"))
    rejects = cut(rejects.unionByName(refused))
    good = cut(good.join(broken.select("comp").distinct(), F.upper("stem") == F.col("comp"), "left_anti"))
    changed = good.select(F.upper("stem").alias("_key"))
    out, fresh = {}, {}
    for t in tables:
        key = schema.parent_key(t)
        new = fresh[t] = merge.only_in(typed[t], changed, key, any_case=True)
        kept = merge.not_in(stored[t], changed, key, any_case=True) if t in stored else None
        out[t] = new if kept is None else kept.unionByName(new)

    # withdrawn and compound components leave; failed ones keep their stored version
    present = compared.filter("status IN ('current', 'failed')")
    gone = cut(merge.gone_keys(stored["chem_comp"], present, "id", "id"))
    merge.guard_gone(gone, stored["chem_comp"], "id", max_gone_fraction)
    out = merge.remove_components(out, gone, {t: schema.parent_key(t) for t in tables})

    failed_late = rejects.select("doc").distinct().withColumn("late", F.lit(True))
    final = compared.join(failed_late, "doc", "left").withColumn(
        "status",
        F.when(F.col("late") & (F.col("status") == "current") & (F.col("change") != "unchanged"), "failed")
        .otherwise(F.col("status")),
    ).drop("late")
    return Loaded(out, final, rejects, gone, status.load_stats(final, gone), fresh, changed)


def load_into_store(spark: SparkSession, directory: str, root: str, tables=schema.LOADED, max_gone_fraction: float = 0.5) -> Loaded:
    """One load round on the bucketed store below ``root``: only files that differ are opened,
    only the buckets of changed or gone components are rewritten.

    Beside the tables the store keeps a file manifest, ``(doc, size, mtime)`` with the first
    pass's header and reasons of every file.  A round lists the directory (names, sizes and
    times, no content), takes the header of every file whose size and time are as stored from
    the manifest, and opens only the others: files older than the oldest of them are left out
    when Spark lists the files.  The tables are committed first, then the manifest, so a round
    that stops between the two opens those files again next time.
    """
    files_root = f"{root}/files"
    if store.current_version(spark, root) == 0:
        empty = schema.empty_tables(spark, {t: schema.CIF[t] for t in tables})
        store.create(spark, root, {t: (empty[t], schema.parent_key(t)) for t in tables})
    stored = {t: store.read_table(spark, root, t) for t in tables}
    known = cif.known_columns(tables)
    listing = cut(cif.scan_files(spark, directory))
    if store.current_version(spark, files_root) == 0:
        kept = None
        changed = listing.select("doc")
    else:
        manifest = store.read_table(spark, files_root, "files")
        kept = manifest.join(listing.select("doc", "size", "mtime"), ["doc", "size", "mtime"], "left_semi")
        changed = listing.select("doc").join(kept.select("doc"), "doc", "left_anti")
    changed = cut(changed)
    since = listing.join(changed, "doc", "left_semi").agg(F.min("mtime")).first()[0] or _NEVER
    headers, problems = probe(spark, directory, known, changed, since)
    columns = headers.columns
    if kept is not None:
        headers = headers.unionByName(kept.select(*columns))
        problems = problems.unionByName(kept.select("doc", F.explode("reasons").alias("reason")))
    headers, problems = cut(headers), cut(problems)
    run = load_directory(spark, directory, stored, tables, max_gone_fraction, (headers, problems))
    store.apply_round(spark, root, run.new, run.changed.unionByName(run.gone.select("_key")))

    reasons = problems.groupBy("doc").agg(F.array_sort(F.collect_list("reason")).alias("reasons"))
    fresh = (
        listing.select("doc", "size", "mtime").join(changed, "doc", "left_semi")
        .join(headers, "doc", "left").join(reasons, "doc", "left")
        .withColumn("reasons", F.coalesce("reasons", F.array().cast("array<string>")))
    )
    if kept is None:
        store.create(spark, files_root, {"files": (fresh, "doc")})
    else:
        gone_files = manifest.select("doc").join(listing.select("doc"), "doc", "left_anti")
        store.apply_round(spark, files_root, {"files": fresh}, changed.unionByName(gone_files).select(F.col("doc").alias("_key")))
    return run

