"""Removal and refresh of components on the STAR side."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from compdict import schema
from compdict.checkpoints import cut
from compdict.operators import derive, ids, merge
from compdict.plans import convert

BY_COMPONENT = {
    "Chem_comp": "ID", **{table: "Comp_ID" for table in convert.CHILDREN},
    "Entity": "Nonpolymer_comp_ID", "Entity_comp_index": "Comp_ID",
}
BY_ENTITY = ("Entity_common_name", "Entity_systematic_name")


# The removal graph: the STAR side's references, every component table by its component key,
# and the name tables by the saveframe of their entity.
REMOVAL = (
    [r for r in schema.REFERENCES if r[0][0].isupper()]
    + [(table, (key,), "Chem_comp", ("ID",)) for table, key in BY_COMPONENT.items() if table != "Chem_comp"]
    + [(table, ("Sf_ID",), "Entity", ("Sf_ID",)) for table in BY_ENTITY]
)


def remove_components(star: dict[str, DataFrame], gone: DataFrame) -> dict[str, DataFrame]:
    """All given STAR tables without the components in ``gone._key`` (upper case) and what hangs on them.

    The rows leave along ``REMOVAL``, level by level (``merge.remove_along``): component rows,
    then rows that refer to removed rows, such as bonds of removed atoms and names of removed
    entities.
    """
    return merge.remove_along(star, REMOVAL, "Chem_comp", "ID", gone)


@dataclass
class Refreshed:
    tables: dict[str, DataFrame]
    rejects: DataFrame
    orphans: DataFrame
    conflicts: DataFrame


def apply_refresh(
    cif: dict[str, DataFrame],
    star: dict[str, DataFrame],
    actions: DataFrame,
    as_of: date,
    aromatic: derive.Fact | None = None,
    framecode_prefix: str = "chem_comp",
) -> Refreshed:
    """Carry out the NEW and REPLACE rows of ``merge.refresh_action`` (key ``id``).

    A replaced component keeps its saveframe ID; new ones get numbers above every number given
    before this refresh, so a removed component's number is not given again by it.

    Their stored rows leave all STAR tables, the CIF-side rows are mapped anew, blanks and
    flags are normalised and derived values set.  A conflict touches nothing and is only
    reported; a component no longer eligible is left to removal.  Entities of replaced
    components leave and are built by ``entity.build_entities`` as for new ones.
    """
    wanted = actions.filter(F.col("action").isin("NEW", "REPLACE"))
    taken = cut(merge.keys_of(
        convert.eligible(cif["chem_comp"]).join(wanted.select("id"), "id", "left_semi").select(F.upper("id").alias("id")), "id"
    ))
    upstream = {
        table: merge.only_in(cif[table], taken, schema.parent_key(table), any_case=True)
        for table in ("chem_comp", *convert.CHILDREN.values())
    }
    base = remove_components(star, taken)
    # IDs are taken above every number given so far, also those of the removed rows
    least = ids.next_id((star["Chem_comp"], "Sf_ID"), (star["Entity"], "Sf_ID"))
    done = convert.convert(upstream, base, as_of, aromatic, framecode_prefix, least)
    # a replaced component keeps its saveframe ID, in its rows and its children's
    kept_ids = star["Chem_comp"].join(taken, F.upper("ID") == F.col("_key"), "left_semi").select(
        F.upper("ID").alias("_kept"), F.col("Sf_ID").alias("_old_sf")
    )
    old, new = {}, {}
    for table, df in done.tables.items():
        key = BY_COMPONENT[table]
        # rows of components not refreshed come as stored: the fills of ``convert`` reach new rows only
        old[table] = base[table]
        fresh = convert.normalise_copy(merge.only_in(df, taken, key, any_case=True))
        if "Sf_ID" in fresh.columns:
            fresh = fresh.join(kept_ids, F.upper(key) == F.col("_kept"), "left").withColumn(
                "Sf_ID", F.coalesce("_old_sf", "Sf_ID")
            ).drop("_kept", "_old_sf")
        new[table] = fresh
    new["Chem_comp"] = convert.recompute(new["Chem_comp"], new["Chem_comp_atom"], new["Chem_comp_bond"], as_of, aromatic)
    tables = remove_components({t: df for t, df in star.items() if t.startswith("Entity")}, taken)
    tables |= {table: old[table].unionByName(new[table].select(*old[table].columns)) for table in old}
    return Refreshed(tables, done.rejects, done.orphans, actions.filter("action = 'CONFLICT'"))
