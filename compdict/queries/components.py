"""Status, changes, merging and removal of components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import uuid

from compdict.checkpoints import cut, shared_folder
from compdict.operators import merge, status
from compdict.queries.registry import Roles, query
from compdict.sources import store

_STATUS = """CASE WHEN error THEN 'failed' WHEN subcomponents IS NOT NULL THEN 'compound'
  WHEN replaced_by IS NOT NULL OR upper(trim(release_status)) IN ('OBS', 'WDRN') THEN 'obsolete' ELSE 'current' END"""

_DIFF = f"""diff AS (SELECT s.id, s.created, s.modified, {_STATUS} AS status,
  CASE WHEN o.id IS NULL THEN 'new'
    WHEN s.modified IS NOT NULL THEN CASE WHEN o.modified IS NULL OR s.modified > o.modified THEN 'updated' ELSE 'unchanged' END
    WHEN s.created IS NOT NULL THEN CASE WHEN o.created IS NULL OR s.created > o.created THEN 'updated' ELSE 'unchanged' END
    ELSE 'unchanged' END AS change
  FROM scanned s LEFT JOIN stored o ON upper(o.id) = upper(s.id))"""
_CHANGED = "SELECT upper(id) FROM diff WHERE status = 'current' AND change <> 'unchanged'"
_GONE = """SELECT upper(id) FROM stored
  WHERE upper(id) NOT IN (SELECT upper(id) FROM diff WHERE status IN ('current', 'failed'))"""


def classified(r: Roles) -> DataFrame:
    s = r.scanned
    return s.select(
        "id", "created", "modified",
        status.status(
            F.col("error"), status.is_compound("subcomponents"), status.is_obsolete("replaced_by", "release_status")
        ).alias("status"),
    )


def diff(r: Roles) -> DataFrame:
    return status.compare_with_stored(classified(r), r.stored)


def changed(r: Roles) -> DataFrame:
    rows = diff(r).filter("status = 'current' AND change <> 'unchanged'")
    return rows.select(F.upper("id").alias("_key")).distinct()


def gone(r: Roles) -> DataFrame:
    present = classified(r).filter("status IN ('current', 'failed')")
    return merge.gone_keys(r.stored, present, "id", "id")


@query("status_classify", f"SELECT id, created, modified, {_STATUS} AS status FROM scanned")
def status_classify(r: Roles) -> DataFrame:
    return classified(r)


@query("incremental_diff", f"WITH {_DIFF} SELECT id, created, modified, status, change FROM diff")
def incremental_diff(r: Roles) -> DataFrame:
    return diff(r)


@query("load_stats", f"""
WITH {_DIFF}
SELECT count(*) AS total,
  count(*) FILTER (status = 'current' AND change = 'new') AS "new",
  count(*) FILTER (status = 'current' AND change = 'updated') AS updated,
  count(*) FILTER (status = 'current' AND change = 'unchanged') AS unchanged,
  count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'compound') AS compound,
  count(*) FILTER (status = 'obsolete') AS obsolete, (SELECT count(*) FROM ({_GONE}) g) AS gone
FROM diff
""")
def load_stats(r: Roles) -> DataFrame:
    return status.load_stats(diff(r), gone(r))


@query("component_replace", f"""
WITH {_DIFF}
SELECT comp_id, ordinal, atom_id FROM stored_atom WHERE upper(comp_id) NOT IN ({_CHANGED})
UNION ALL
SELECT comp_id, ordinal, atom_id FROM scanned_atom WHERE upper(comp_id) IN ({_CHANGED})
""")
def component_replace(r: Roles) -> DataFrame:
    return merge.replace_components(r.stored_atom, r.scanned_atom, changed(r), "comp_id")


@query("obsolete_ids", f"WITH {_DIFF} SELECT upper(id) AS id FROM stored WHERE upper(id) IN ({_GONE})")
def obsolete_ids(r: Roles) -> DataFrame:
    return gone(r).select(F.col("_key").alias("id"))


@query("remove_gone", f"""
WITH {_DIFF}
SELECT 'parent' AS side, id AS comp_id, count(*) AS n FROM stored WHERE upper(id) NOT IN ({_GONE}) GROUP BY id
UNION ALL
SELECT 'child', comp_id, count(*) FROM stored_atom WHERE upper(comp_id) NOT IN ({_GONE}) GROUP BY comp_id
""")
def remove_gone(r: Roles) -> DataFrame:
    keys = cut(gone(r))  # used three times
    merge.guard_gone(keys, r.stored, "id", 0.9)
    left = merge.remove_components(
        {"parent": r.stored, "child": r.stored_atom}, keys, {"parent": "id", "child": "comp_id"}
    )
    parent = left["parent"].groupBy(F.col("id").alias("comp_id")).count()
    child = left["child"].groupBy("comp_id").count()
    return (
        parent.select(F.lit("parent").alias("side"), "comp_id", F.col("count").alias("n"))
        .unionByName(child.select(F.lit("child").alias("side"), "comp_id", F.col("count").alias("n")))
    )


@query("cascade_delete", """
SELECT comp_id, ordinal, atom_id FROM stored_atom
WHERE comp_id IN (SELECT 'c' || CAST(o_orderkey AS STRING) FROM orders WHERE o_orderstatus <> 'O')
""")
def cascade_delete(r: Roles) -> DataFrame:
    parents = r.orders.filter("o_orderstatus <> 'O'").select(
        F.concat(F.lit("c"), F.col("o_orderkey").cast("string")).alias("id")
    )
    return merge.cascade(r.stored_atom, parents, "comp_id", "id")


@query("new_only_insert", """
SELECT comp_id, atom_id, pdbx_ordinal FROM atom
WHERE comp_id NOT IN (SELECT DISTINCT CAST(l_orderkey AS STRING) FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag = 'N')
""")
def new_only_insert(r: Roles) -> DataFrame:
    held = r.lineitem.filter("l_linestatus = 'F' AND l_returnflag = 'N'").select(
        F.col("l_orderkey").cast("string").alias("Comp_ID")
    )
    return merge.new_only(r.atom, held, "comp_id", "Comp_ID").select("comp_id", "atom_id", "pdbx_ordinal")


_REFRESH = """SELECT c.id, coalesce(c.pdbx_modified_date, DATE '1970-01-01') AS upstream_modified,
  CASE WHEN l.id IS NOT NULL THEN coalesce(l.modified, DATE '1970-01-01') END AS local_modified,
  CASE WHEN l.id IS NULL THEN 'NEW'
    WHEN coalesce(c.pdbx_initial_date, DATE '1970-01-01') > coalesce(l.modified, DATE '1970-01-01')
      OR coalesce(c.pdbx_modified_date, DATE '1970-01-01') > coalesce(l.modified, DATE '1970-01-01')
    THEN CASE WHEN coalesce(l.created, DATE '1970-01-01') = coalesce(l.modified, DATE '1970-01-01')
      THEN 'REPLACE' ELSE 'CONFLICT' END
    ELSE 'UNCHANGED' END AS action
FROM component c LEFT JOIN local l ON l.id = c.id
WHERE c.pdbx_replaced_by IS NULL AND c.pdbx_subcomponent_list IS NULL"""


def refreshed(r: Roles) -> DataFrame:
    upstream = r.component.filter("pdbx_replaced_by IS NULL AND pdbx_subcomponent_list IS NULL").select(
        "id", F.col("pdbx_initial_date").alias("created"), F.col("pdbx_modified_date").alias("modified")
    )
    return merge.refresh_action(upstream, r.local)


@query("refresh_conflict", _REFRESH)
def refresh_conflict(r: Roles) -> DataFrame:
    return refreshed(r).orderBy("id")


@query("refresh_stats", f"""
SELECT count(*) AS total, count(*) FILTER (action = 'NEW') AS "new",
  count(*) FILTER (action IN ('REPLACE', 'CONFLICT')) AS updated, count(*) FILTER (action = 'CONFLICT') AS conflicts
FROM ({_REFRESH}) x
""")
def refresh_stats(r: Roles) -> DataFrame:
    return merge.refresh_stats(refreshed(r))


@query("load_round", f"""
WITH {_DIFF}
SELECT 'parent' AS side, id AS comp_id, CAST(NULL AS INTEGER) AS ordinal, CAST(NULL AS VARCHAR) AS atom_id
FROM stored WHERE upper(id) NOT IN ({_CHANGED}) AND upper(id) NOT IN ({_GONE})
UNION ALL
SELECT 'parent', id, NULL, NULL FROM scanned WHERE upper(id) IN ({_CHANGED})
UNION ALL
SELECT 'atom', comp_id, ordinal, atom_id FROM stored_atom WHERE upper(comp_id) NOT IN ({_CHANGED}) AND upper(comp_id) NOT IN ({_GONE})
UNION ALL
SELECT 'atom', comp_id, ordinal, atom_id FROM scanned_atom WHERE upper(comp_id) IN ({_CHANGED})
""")
def load_round(r: Roles) -> DataFrame:
    """A load round on the bucketed store: stored rows written as a version, changed components
    replaced and gone ones removed by rewriting only their buckets, the next version read back."""
    spark = r.spark
    root = f"{shared_folder(spark)}/store-{uuid.uuid4()}"
    store.create(spark, root, {"parent": (r.stored.select("id", "created", "modified"), "id"), "atom": (r.stored_atom, "comp_id")})
    new, left = cut(changed(r)), cut(gone(r).select("_key"))
    replaced = {
        "parent": r.scanned.join(new, F.upper("id") == F.col("_key"), "left_semi").select("id", "created", "modified"),
        "atom": r.scanned_atom.join(new, F.upper("comp_id") == F.col("_key"), "left_semi"),
    }
    store.apply_round(spark, root, replaced, new.unionByName(left))
    parent = store.read_table(spark, root, "parent").select(
        F.lit("parent").alias("side"), F.col("id").alias("comp_id"), F.lit(None).cast("int").alias("ordinal"),
        F.lit(None).cast("string").alias("atom_id"),
    )
    atom = store.read_table(spark, root, "atom").select(F.lit("atom").alias("side"), "comp_id", "ordinal", "atom_id")
    return parent.unionByName(atom)
