"""Entity rows: one entity per component, with its names and its index row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from compdict import schema
from compdict.operators import ids, merge

# --- fixed values ------------------------------------------------------------
NAME_TYPE = "BMRB"
CODE_SYSTEM = "Three letter code"
ENTITY_PREFIX = "entity_"
LABEL_PREFIX = "chem_comp_"


def map_entity(components: DataFrame) -> DataFrame:
    """One non-polymer entity per component, without IDs from the sequence."""
    frame = F.concat(F.lit(ENTITY_PREFIX), F.col("ID"))
    out = components.select(
        F.lit("entity").alias("Sf_category"),
        frame.alias("Sf_framecode"),
        F.lit(schema.NO_ACCESSION).alias("Entry_ID"),
        F.lit(1).alias("ID"),
        "BMRB_code",
        F.coalesce(F.col("Name"), frame).alias("Name"),
        F.when(F.upper("Name") == "WATER", "water").otherwise("non-polymer").alias("Type"),
        F.lit(1).alias("Number_of_nonpolymer_components"),
        F.col("ID").alias("Nonpolymer_comp_ID"),
        F.concat(F.lit(LABEL_PREFIX), F.col("ID")).alias("Nonpolymer_comp_label"),
        "Paramagnetic",
        "Formula_weight",
    )
    return merge.complete(out, schema.STAR["Entity"])


def linked(components: DataFrame, entities: DataFrame) -> DataFrame:
    """Components with the saveframe and entity ID of their entity; joined once for all four outputs."""
    e = entities.select(
        F.col("Nonpolymer_comp_ID").alias("_comp"), F.col("Sf_ID").alias("e_sf"), F.col("ID").alias("e_id")
    )
    return components.select("ID", "Name", "Three_letter_code").join(e, F.col("ID") == F.col("_comp")).drop("_comp")


def common_name(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "Name", F.lit(NAME_TYPE).alias("Type"), F.col("e_sf").alias("Sf_ID"), F.lit(schema.NO_ACCESSION).alias("Entry_ID")
    )


def systematic_name(pairs: DataFrame) -> DataFrame:
    """Two rows per entity: its name, and its three-letter code or else its ID."""
    names = F.array(
        F.struct(F.col("Name").alias("Name"), F.lit(NAME_TYPE).alias("Naming_system")),
        F.struct(F.coalesce("Three_letter_code", "ID").alias("Name"), F.lit(CODE_SYSTEM).alias("Naming_system")),
    )
    return pairs.select(F.explode(names).alias("n"), "e_sf").select(
        "n.Name", "n.Naming_system", F.col("e_sf").alias("Sf_ID"), F.lit(schema.NO_ACCESSION).alias("Entry_ID")
    )


def comp_index(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.lit(1).alias("ID"),
        F.lit("1").alias("Auth_seq_ID"),
        F.col("e_id").alias("Entity_ID"),
        F.col("ID").alias("Comp_ID"),
        F.concat(F.lit(LABEL_PREFIX), F.col("ID")).alias("Comp_label"),
        F.col("e_sf").alias("Sf_ID"),
        F.lit(schema.NO_ACCESSION).alias("Entry_ID"),
    )


def build_entities(components: DataFrame, existing: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four entity tables for all components; entities already there keep their saveframe IDs."""
    if existing is None:
        existing = components.sparkSession.createDataFrame([], schema.STAR["Entity"])
    fresh = map_entity(merge.new_only(components, existing, "ID", "Nonpolymer_comp_ID"))
    first = ids.next_id((components, "Sf_ID"), (existing, "Sf_ID"))
    entities = existing.unionByName(
        ids.surrogate_ids(fresh, "Nonpolymer_comp_ID", "Sf_ID", first, hashed=True).select(*existing.columns)
    )
    pairs = linked(components, merge.hashed(entities, "Nonpolymer_comp_ID"))
    parts = {
        "Entity_common_name": common_name(pairs),
        "Entity_systematic_name": systematic_name(pairs),
        "Entity_comp_index": comp_index(pairs),
    }
    out = {"Entity": entities}
    for table, df in parts.items():
        out[table] = merge.apply_defaults(merge.complete(df, schema.STAR[table]), schema.DEFAULTS[table])
    return out
