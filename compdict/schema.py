"""Table layouts, keys and defaults of the two sides of the dictionary.

The *CIF side* holds what the source files say, the *STAR side* what is
published.  A column is text unless marked ``:int`` or ``:date``; coordinates,
weights and angles stay text so that no digit is lost.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"": T.StringType(), "int": T.IntegerType(), "date": T.DateType()}


def _struct(spec: str) -> T.StructType:
    fields = []
    for word in spec.split():
        name, _, kind = word.partition(":")
        fields.append(T.StructField(name, _TYPES[kind], True))
    return T.StructType(fields)


# --- fixed values: CIF-side tables, columns in lower case -------------------
_CIF = {
    "chem_comp": """
        formula formula_weight id model_details model_erf model_source mon_nstd_class mon_nstd_details
        mon_nstd_flag mon_nstd_parent mon_nstd_parent_comp_id name number_atoms_all:int number_atoms_nh:int
        one_letter_code pdbx_ambiguous_flag pdbx_component_no pdbx_formal_charge
        pdbx_ideal_coordinates_details pdbx_ideal_coordinates_missing_flag pdbx_initial_date:date
        pdbx_model_coordinates_db_code pdbx_model_coordinates_details pdbx_model_coordinates_missing_flag
        pdbx_modification_details pdbx_modified_date:date pdbx_processing_site pdbx_release_status
        pdbx_replaced_by pdbx_replaces pdbx_subcomponent_list pdbx_synonyms pdbx_type three_letter_code type""",
    "chem_comp_atom": """
        alt_atom_id atom_id charge comp_id model_cartn_x model_cartn_x_esd model_cartn_y model_cartn_y_esd
        model_cartn_z model_cartn_z_esd partial_charge pdbx_align pdbx_alt_atom_id pdbx_stnd_atom_id
        pdbx_alt_comp_id pdbx_aromatic_flag pdbx_component_atom_id pdbx_component_comp_id
        pdbx_leaving_atom_flag pdbx_model_cartn_x_ideal pdbx_model_cartn_y_ideal pdbx_model_cartn_z_ideal
        pdbx_ordinal:int pdbx_stereo_config substruct_code type_symbol""",
    "chem_comp_angle": """
        atom_id_1 atom_id_2 atom_id_3 comp_id value_angle value_angle_esd value_dist value_dist_esd""",
    "chem_comp_bond": """
        atom_id_1 atom_id_2 comp_id pdbx_aromatic_flag pdbx_ordinal:int pdbx_stereo_config value_dist
        value_dist_esd value_order""",
    "chem_comp_chir": """
        atom_config atom_id comp_id id number_atoms_all:int number_atoms_nh:int volume_flag volume_three
        volume_three_esd""",
    "chem_comp_chir_atom": "atom_id chir_id comp_id dev",
    "chem_comp_plane": "comp_id id number_atoms_all:int number_atoms_nh:int",
    "chem_comp_plane_atom": "atom_id comp_id dist_esd plane_id",
    "chem_comp_tor": "atom_id_1 atom_id_2 atom_id_3 atom_id_4 comp_id id",
    "chem_comp_tor_value": "angle angle_esd comp_id dist dist_esd tor_id",
    "pdbx_chem_comp_atom_edit": "atom_id comp_id edit_atom_id edit_atom_value edit_op ordinal:int",
    "pdbx_chem_comp_atom_feature": "atom_id comp_id feature_type",
    "pdbx_chem_comp_audit": "action_type annotator comp_id date:date details processing_site",
    "pdbx_chem_comp_bond_edit": "atom_id_1 atom_id_2 comp_id edit_bond_value edit_op ordinal:int",
    "pdbx_chem_comp_descriptor": "comp_id descriptor ordinal:int program program_version type",
    "pdbx_chem_comp_feature": "comp_id source support type value",
    "pdbx_chem_comp_identifier": "comp_id identifier ordinal:int program program_version type",
    "pdbx_chem_comp_import": "comp_id",
    "pdbx_chem_comp_synonyms": "ordinal:int comp_id name provenance type",
}

# --- fixed values: STAR-side tables, names case-kept ------------------------
_STAR = {
    "Chem_comp": """
        Sf_category Sf_framecode Entry_ID Sf_ID:int ID Provenance Name Type BMRB_code PDB_code Ambiguous_flag
        Initial_date:date Modified_date:date Release_status Replaced_by Replaces One_letter_code
        Three_letter_code Number_atoms_all:int Number_atoms_nh:int Atom_nomenclature_source PubChem_code
        Subcomponent_list InChI_code Mon_nstd_flag Mon_nstd_class Mon_nstd_details Mon_nstd_parent
        Mon_nstd_parent_comp_ID Std_deriv_one_letter_code Std_deriv_three_letter_code Std_deriv_BMRB_code
        Std_deriv_PDB_code Std_deriv_chem_comp_name Synonyms Formal_charge Paramagnetic Aromatic Formula
        Formula_weight Formula_mono_iso_wt_nat Formula_mono_iso_wt_13C Formula_mono_iso_wt_13C_15N
        Image_file_name Image_file_format Topo_file_name Topo_file_format Struct_file_name Struct_file_format
        Stereochem_param_file_name Stereochem_param_file_format Model_details Model_erf Model_source
        Model_coordinates_details Model_coordinates_missing_flag Ideal_coordinates_details
        Ideal_coordinates_missing_flag Model_coordinates_db_code Processing_site Vendor Vendor_product_code
        Details DB_query_date:date DB_last_query_revised_last_date:date""",
    "Chem_comp_atom": """
        Atom_ID BMRB_code PDB_atom_ID Alt_atom_ID Auth_atom_ID Type_symbol Isotope_number:int Chirality
        Stereo_config Charge Partial_charge Oxidation_number Unpaired_electron_number:int Align:int
        Aromatic_flag Leaving_atom_flag Substruct_code Ionizable Drawing_2D_coord_x Drawing_2D_coord_y
        Model_Cartn_x Model_Cartn_x_esd Model_Cartn_y Model_Cartn_y_esd Model_Cartn_z Model_Cartn_z_esd
        Model_Cartn_x_ideal Model_Cartn_y_ideal Model_Cartn_z_ideal PDBX_ordinal:int Details Sf_ID:int
        Entry_ID Comp_ID""",
    "Chem_comp_bond": """
        ID:int Type Value_order Atom_ID_1 Atom_ID_2 Aromatic_flag Stereo_config Ordinal:int Details Sf_ID:int
        Entry_ID Comp_ID""",
    "Chem_comp_angle": "ID:int Atom_ID_1 Atom_ID_2 Atom_ID_3 Details Sf_ID:int Entry_ID Comp_ID",
    "Chem_comp_tor": "ID:int Atom_ID_1 Atom_ID_2 Atom_ID_3 Atom_ID_4 Details Sf_ID:int Entry_ID Comp_ID",
    "Chem_comp_descriptor": "Descriptor Type Program Program_version Sf_ID:int Entry_ID Comp_ID",
    "Chem_comp_identifier": "Identifier Type Program Program_version Sf_ID:int Entry_ID Comp_ID",
    "PDBX_chem_comp_feature": "Type Value Source Support Sf_ID:int Entry_ID Comp_ID",
    "Entity": """
        Sf_category Sf_framecode Entry_ID Sf_ID:int ID:int BMRB_code Name Type Polymer_common_type Polymer_type
        Polymer_type_details Polymer_strand_ID Polymer_seq_one_letter_code_can Polymer_seq_one_letter_code
        Target_identifier Polymer_author_defined_seq Polymer_author_seq_details
        Ambiguous_conformational_states Ambiguous_chem_comp_sites Nstd_monomer Nstd_chirality Nstd_linkage
        Nonpolymer_comp_ID Nonpolymer_comp_label Number_of_monomers:int Number_of_nonpolymer_components:int
        Paramagnetic Thiol_state Src_method Parent_entity_ID:int Fragment Mutation EC_number
        Calc_isoelectric_point Formula_weight Formula_weight_exptl Formula_weight_exptl_meth Details
        DB_query_date:date DB_query_revised_last_date:date""",
    "Entity_comp_index": "ID:int Auth_seq_ID Comp_ID Comp_label Sf_ID:int Entry_ID Entity_ID:int",
    "Entity_common_name": "Name Type Sf_ID:int Entry_ID Entity_ID:int",
    "Entity_systematic_name": "Name Naming_system Sf_ID:int Entry_ID Entity_ID:int",
}

CIF = {name: _struct(spec) for name, spec in _CIF.items()}
STAR = {name: _struct(spec) for name, spec in _STAR.items()}

# The synonyms table has a layout but takes no part in a load unless asked for.
LOADED = tuple(name for name in CIF if name != "pdbx_chem_comp_synonyms")


def parent_key(table: str) -> str:
    """Name of the column that holds the component ID in a CIF-side table."""
    return "id" if table == "chem_comp" else "comp_id"


# --- fixed values: unique keys ----------------------------------------------
UNIQUE = {
    "chem_comp": [("id",)],
    "chem_comp_atom": [("comp_id", "atom_id")],
    "chem_comp_chir": [("comp_id", "atom_id", "id")],
    "chem_comp_plane": [("comp_id", "id")],
    "chem_comp_tor": [("comp_id", "id")],
    "Chem_comp": [("ID",)],
    "Chem_comp_atom": [("Comp_ID", "Atom_ID")],
    "Chem_comp_bond": [("Comp_ID", "ID"), ("Comp_ID", "Atom_ID_1", "Atom_ID_2")],
    "Chem_comp_angle": [("Comp_ID", "ID"), ("Comp_ID", "Atom_ID_1", "Atom_ID_2", "Atom_ID_3")],
    "Chem_comp_tor": [("Comp_ID", "ID"), ("Comp_ID", "Atom_ID_1", "Atom_ID_2", "Atom_ID_3", "Atom_ID_4")],
    "PDBX_chem_comp_feature": [("Comp_ID", "Type", "Value")],
    "Entity": [("Nonpolymer_comp_ID",)],
}

# --- fixed values: columns that must not be null ----------------------------
NOT_NULL = {
    "chem_comp": ("id",),
    "Chem_comp": ("Sf_category", "Entry_ID", "ID"),
    "Chem_comp_atom": ("Atom_ID", "Entry_ID", "Comp_ID"),
    "Chem_comp_bond": ("ID", "Entry_ID", "Comp_ID"),
    "Chem_comp_angle": ("ID", "Entry_ID", "Comp_ID"),
    "Chem_comp_tor": ("ID", "Entry_ID", "Comp_ID"),
    "Chem_comp_descriptor": ("Descriptor", "Type", "Entry_ID", "Comp_ID"),
    "Chem_comp_identifier": ("Identifier", "Type", "Entry_ID", "Comp_ID"),
    "PDBX_chem_comp_feature": ("Type", "Value", "Entry_ID", "Comp_ID"),
    "Entity": ("Sf_category", "Entry_ID", "ID", "Nonpolymer_comp_ID"),
    "Entity_comp_index": ("ID", "Comp_ID", "Entry_ID", "Entity_ID"),
    "Entity_common_name": ("Name", "Entry_ID", "Entity_ID"),
    "Entity_systematic_name": ("Name", "Entry_ID", "Entity_ID"),
}

# --- fixed values: column defaults ------------------------------------------
NO_ACCESSION = "NEED_ACC_NO"
DEFAULTS = {
    name: {"Entry_ID": NO_ACCESSION} for name in STAR
}
DEFAULTS["Chem_comp_bond"]["Entry_ID"] = "NO_ACC_NUM"
DEFAULTS["Chem_comp"]["Sf_category"] = "chem_comp"
DEFAULTS["Entity"].update(Sf_category="entity", ID=1, Number_of_nonpolymer_components=1)
DEFAULTS["Entity_comp_index"]["ID"] = 1
DEFAULTS["Entity_common_name"]["Entity_ID"] = 1
DEFAULTS["Entity_systematic_name"]["Entity_ID"] = 1


def _refs(child: str, comp: str, columns, parent: str, parent_columns):
    return [(child, (comp, c), parent, parent_columns) for c in columns]


# References as (child, child columns, parent, parent columns).  A chirality
# neighbour refers to its centre by (comp_id, chir_id) only.
REFERENCES = (
    [
        (t, ("comp_id",), "chem_comp", ("id",))
        for t in (
            "chem_comp_atom", "chem_comp_plane", "pdbx_chem_comp_audit", "pdbx_chem_comp_descriptor",
            "pdbx_chem_comp_feature", "pdbx_chem_comp_identifier", "pdbx_chem_comp_import",
            "pdbx_chem_comp_synonyms",
        )
    ]
    + [
        ref
        for t, cols in (
            ("chem_comp_angle", ("atom_id_1", "atom_id_2", "atom_id_3")),
            ("chem_comp_bond", ("atom_id_1", "atom_id_2")),
            ("chem_comp_chir", ("atom_id",)),
            ("chem_comp_plane_atom", ("atom_id",)),
            ("chem_comp_tor", ("atom_id_1", "atom_id_2", "atom_id_3", "atom_id_4")),
            ("pdbx_chem_comp_atom_edit", ("atom_id",)),
            ("pdbx_chem_comp_atom_feature", ("atom_id",)),
            ("pdbx_chem_comp_bond_edit", ("atom_id_1", "atom_id_2")),
        )
        for ref in _refs(t, "comp_id", cols, "chem_comp_atom", ("comp_id", "atom_id"))
    ]
    + [
        ("chem_comp_chir_atom", ("comp_id", "chir_id"), "chem_comp_chir", ("comp_id", "id")),
        ("chem_comp_plane_atom", ("comp_id", "plane_id"), "chem_comp_plane", ("comp_id", "id")),
        ("chem_comp_tor_value", ("comp_id", "tor_id"), "chem_comp_tor", ("comp_id", "id")),
    ]
    + [
        (t, ("Comp_ID",), "Chem_comp", ("ID",))
        for t in (
            "Chem_comp_atom", "Chem_comp_bond", "Chem_comp_angle", "Chem_comp_tor", "Chem_comp_descriptor",
            "Chem_comp_identifier", "PDBX_chem_comp_feature",
        )
    ]
    + [
        ref
        for t, n in (("Chem_comp_bond", 2), ("Chem_comp_angle", 3), ("Chem_comp_tor", 4))
        for ref in _refs(
            t, "Comp_ID", [f"Atom_ID_{i + 1}" for i in range(n)], "Chem_comp_atom", ("Comp_ID", "Atom_ID")
        )
    ]
    + [
        ("Entity", ("Nonpolymer_comp_ID",), "Chem_comp", ("ID",)),
        ("Entity_comp_index", ("Comp_ID",), "Entity", ("Nonpolymer_comp_ID",)),
    ]
)


def empty_tables(spark, layouts: dict[str, T.StructType]):
    """Recreate a side: one empty DataFrame per table of the layout."""
    return {name: spark.createDataFrame([], layout) for name, layout in layouts.items()}
