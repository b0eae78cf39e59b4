"""CIF text: the driver tables are written as CIF lines and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from compdict import schema
from compdict.functions import clean
from compdict.operators import quality, status
from compdict.queries.registry import Roles, query
from compdict.sources import cif

# Data lines get a number that spreads evenly over this range, behind the header lines.
_SPREAD = 1 << 40


def quoted(c: Column) -> Column:
    """A text that holds no line break as one CIF value."""
    c = c.cast("string")
    plain = c.rlike(r"^[A-Za-z0-9+-][^\s]*$") & ~(c.contains("_") & c.rlike(r"(?i)^(data_|save_|loop_|stop_|global_)"))
    return F.when(c.isNull(), "?").when(plain, c).otherwise(F.concat(F.lit('"'), c, F.lit('"')))


def by_document(df: DataFrame, doc: Column) -> DataFrame:
    """Bring the rows of a document together before they grow to text.

    The number of partitions is given, as the rows are small here and would be packed
    into few tasks.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn("doc", doc).repartition(n, "doc")


def header(df: DataFrame, doc: Column, lines: list[Column]) -> DataFrame:
    return by_document(df, doc).select("doc", F.posexplode(F.array(*lines)).alias("line_no", "line")).select(
        "doc", F.col("line_no").cast("long").alias("line_no"), "line"
    )


def body(df: DataFrame, doc: Column, cells: list[Column], hash_of: list[str]) -> DataFrame:
    return by_document(df, doc).select(
        "doc",
        (F.pmod(F.xxhash64(*hash_of), F.lit(_SPREAD)) + 1000).alias("line_no"),
        F.concat_ws(" ", *cells).alias("line"),
    )


def key(c: str) -> Column:
    return F.col(c).cast("string")


def text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


_ATOM_COLUMNS = ("comp_id", "atom_id", "type_symbol", "charge", "pdbx_align", "pdbx_stereo_config", "pdbx_ordinal")


def order_documents(r: Roles) -> DataFrame:
    """One document per order: a component with one atom per line item."""
    atoms = r.atom.select(*_ATOM_COLUMNS)
    head = header(r.component, text("c", F.col("id")), [
        text("data_", F.col("id")),
        F.lit("#"),
        text("_chem_comp.id    ", F.col("id")),
        text("_chem_comp.name  ", quoted(F.col("name"))),
        text("_chem_comp.pdbx_modified_date ", quoted(F.col("pdbx_modified_date"))),
        F.lit("loop_"),
        *[F.lit(f"_chem_comp_atom.{c}") for c in _ATOM_COLUMNS],
    ])
    rows = body(atoms, text("c", F.col("comp_id")), [quoted(F.col(c)) for c in _ATOM_COLUMNS], list(_ATOM_COLUMNS))
    counted = atoms.select(text("c", F.col("comp_id")).alias("doc"))
    return cif.in_parts(head.unionByName(rows), counted=counted)


def order_segments(r: Roles, lines: DataFrame | None = None) -> DataFrame:
    return cif.segments(cif.units(order_documents(r) if lines is None else lines))


@query("cif_roundtrip", "SELECT " + ", ".join(_ATOM_COLUMNS) + " FROM atom")
def cif_roundtrip(r: Roles) -> DataFrame:
    rows = cif.category_rows(order_segments(r), {"chem_comp_atom": _ATOM_COLUMNS})
    layout = T.StructType([f for f in schema.CIF["chem_comp_atom"].fields if f.name in _ATOM_COLUMNS])
    return quality.typed_table(cif.table_text(rows, "chem_comp_atom", _ATOM_COLUMNS), layout)


@query("cif_atom_counts", """
SELECT id, (SELECT count(*) FROM atom WHERE comp_id = id) AS n_atoms FROM component
""")
def cif_atom_counts(r: Roles) -> DataFrame:
    rows = cif.category_rows(order_segments(r), {"chem_comp": ("id",), "chem_comp_atom": ("comp_id",)})
    is_atom = F.col("category") == "chem_comp_atom"
    return rows.groupBy("doc").agg(
        F.max(F.when(~is_atom, cif.value_of("chem_comp.id"))).alias("id"), F.count(F.when(is_atom, 1)).alias("n_atoms")
    ).drop("doc")


@query("cif_cells", """
SELECT 'c' || id AS doc, 'chem_comp.name' AS tag, coalesce(name, '?') AS val FROM component
UNION ALL SELECT 'c' || comp_id, 'chem_comp_atom.atom_id', atom_id FROM atom
""")
def cif_cells(r: Roles) -> DataFrame:
    return cif.cells(order_segments(r), ["chem_comp.name", "chem_comp_atom.atom_id"]).select("doc", "tag", "val")


@query("cif_text_field", """
SELECT 'V' || CAST(conv_id AS STRING) AS comp_id, CAST(turn AS INT) AS ordinal, role AS type,
  ' ' || replace(text, chr(10), chr(10) || ' ') AS identifier
FROM conversations
""")
def cif_text_field(r: Roles) -> DataFrame:
    """Whole texts as multi-line fields inside loop rows; lines are indented so none starts a field."""
    columns = ("comp_id", "ordinal", "type", "identifier")
    turns = r.table("conversations")
    doc = text("v", key("conv_id"))
    head = header(turns.select("conv_id").distinct(), doc, [
        text("data_v", key("conv_id")), text("_chem_comp.id v", key("conv_id")), F.lit("loop_"),
        *[F.lit(f"_pdbx_chem_comp_identifier.{c}") for c in columns],
    ])
    # every turn takes a block of line numbers: the opening line, its text lines, the closing line
    block = F.lit(1 << 20)
    opening = F.concat_ws(" ", text("v", key("conv_id")), key("turn"), quoted(F.col("role")))
    pieces = F.concat(F.array(opening), F.split("text", "\n"))
    last = F.size(pieces) - 1
    lines = turns.select(
        doc.alias("doc"),
        (1000 + F.col("turn") * block).alias("base"),
        F.posexplode(F.concat(pieces, F.array(F.lit("")))).alias("k", "piece"),
        last.alias("last"),
    ).select(
        "doc",
        (F.col("base") + F.col("k")).alias("line_no"),
        F.when(F.col("k") == 0, F.col("piece"))
        .when(F.col("k") == 1, F.concat(F.lit("; "), F.col("piece")))
        .when(F.col("k") > F.col("last"), ";")
        .otherwise(F.concat(F.lit(" "), F.col("piece"))).alias("line"),
    )
    segs = order_segments(r, cif.in_parts(head.unionByName(lines)))
    rows = cif.category_rows(segs, {"pdbx_chem_comp_identifier": columns})
    found = cif.table_text(rows, "pdbx_chem_comp_identifier", columns)
    return found.withColumn("ordinal", clean.typed("ordinal", T.IntegerType())).select(*columns)


_PATH = """regexp_replace(url, '^https?://[^/]*/', '')"""
_PATH_SQL = (
    f"CASE WHEN page_id % 9 = 0 THEN 'FULL/' WHEN page_id % 9 = 1 THEN 'a/REMOVED/b/' WHEN page_id % 9 = 2 THEN 'FULLER/'"
    f" ELSE '' END || {_PATH} || CASE WHEN page_id % 5 = 0 THEN '.CIF' WHEN page_id % 5 = 1 THEN '/.cif' ELSE '.cif' END"
)


@query("cif_scan_filter", f"""
SELECT page_id, path, upper(regexp_extract(path, '([^/]+)[.]cif$', 1)) AS id
FROM (SELECT page_id, {_PATH_SQL} AS path FROM pages) x
WHERE path LIKE '%_.cif' AND path NOT LIKE '%/.cif'
  AND NOT list_contains(string_split(path, '/')[1:-2], 'FULL')
  AND NOT list_contains(string_split(path, '/')[1:-2], 'REMOVED')
""")
def cif_scan_filter(r: Roles) -> DataFrame:
    paths = r.pages.select("page_id", F.expr(_PATH_SQL).alias("path"))
    return paths.filter(cif.wanted_path(F.col("path"))).withColumn("id", cif.component_id(F.col("path")))


@query("cif_category_route", """
SELECT category, count(*) AS n FROM (
  SELECT 'chem_comp' AS category FROM orders
  UNION ALL SELECT CASE WHEN l_linestatus = 'F' THEN 'chem_comp_atom' ELSE 'chem_comp_bond' END FROM lineitem
) x GROUP BY category
""")
def cif_category_route(r: Roles) -> DataFrame:
    """Atoms, bonds, a free-tag category and an unknown one in every document."""
    head = header(r.component, F.col("id"), [
        text("data_", F.col("id")), text("_chem_comp.id ", F.col("id")), F.lit("_not_known.a 1"),
        F.lit("loop_"), F.lit("_also_unknown.a"), F.lit("_also_unknown.b"), F.lit("1 2 3 4"),
        text("_chem_comp.one_letter_code ", F.col("one_letter_code")),
    ])
    # loops of one row each, so that line items of both kinds may come in any order
    atom = F.array(F.lit("loop_"), F.lit("_chem_comp_atom.comp_id _chem_comp_atom.atom_id"))
    bond = F.array(F.lit("loop_"), F.lit("_chem_comp_bond.comp_id _chem_comp_bond.atom_id_1"))
    items = r.lineitem.select(
        key("l_orderkey").alias("doc"),
        F.xxhash64("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_shipdate").alias("h"),
        F.concat(
            F.when(F.col("l_linestatus") == "F", atom).otherwise(bond),
            F.array(F.concat_ws(" ", key("l_orderkey"), key("l_partkey"))),
        ).alias("lines"),
    )
    rows = items.select("doc", "h", F.posexplode("lines").alias("k", "line")).select(
        "doc", (1000 + F.pmod("h", F.lit(_SPREAD)) * 4 + F.col("k")).alias("line_no"), "line"
    )
    segs = order_segments(r, cif.in_parts(head.unionByName(rows)))
    return cif.category_rows(segs).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("cif_missing_columns", """
SELECT id, name, CAST(NULL AS STRING) AS formula, CAST(NULL AS INTEGER) AS number_atoms_all,
  pdbx_modified_date, CAST(NULL AS DATE) AS pdbx_initial_date
FROM component
""")
def cif_missing_columns(r: Roles) -> DataFrame:
    columns = ["id", "name", "formula", "number_atoms_all", "pdbx_modified_date", "pdbx_initial_date"]
    rows = cif.category_rows(order_segments(r), cif.known_columns(("chem_comp",)))
    return quality.typed_table(cif.table_text(rows, "chem_comp"), schema.CIF["chem_comp"]).select(*columns)


def faulty_documents(r: Roles) -> DataFrame:
    """One document per order; seven of ten have a fault, a different one each."""
    k = F.col("o_orderkey") % 10
    name = key("o_orderkey")

    def variant(usual: str | Column, *cases: tuple[int, str]) -> Column:
        out = F.lit(usual) if isinstance(usual, str) else usual
        for n, line in cases:
            out = F.when(k == n, line).otherwise(out)
        return out

    return header(r.orders, text("c", name), [
        variant("# a component", (5, "stray")),
        text("data_", name),
        text("_chem_comp.id ", name),
        variant('_chem_comp.name "a b"', (2, "_chem_comp.name 'a"), (3, "_chem_comp.name a b"), (7, "_name a")),
        variant("#", (4, "data_again"), (8, "_chem_comp.colour red")),
        F.lit("loop_"),
        F.lit("_chem_comp_bond.comp_id _chem_comp_bond.atom_id_1"),
        F.lit("_chem_comp_bond.atom_id_2 # the second"),
        text(name, F.lit(" A1 A2")),
        variant(text(name, F.lit(" A2 'A'3'")), (1, "x A2")),
        variant("#", (6, ";never closed")),
    ])


@query("cif_ragged_rejects", """
SELECT 'c' || CAST(o_orderkey AS STRING) AS doc,
  CASE o_orderkey % 10 WHEN 2 THEN 'unclosed quote' WHEN 5 THEN 'text before data block'
    WHEN 6 THEN 'unclosed text field' WHEN 7 THEN 'tag without category' ELSE 'ragged' END AS reason
FROM orders WHERE o_orderkey % 10 IN (1, 2, 3, 5, 6, 7)
UNION ALL SELECT 'c' || CAST(o_orderkey AS STRING), 'ragged' FROM orders WHERE o_orderkey % 10 IN (5, 6)
""")
def cif_ragged_rejects(r: Roles) -> DataFrame:
    lines = faulty_documents(r)
    return cif.rejects(lines, order_segments(r, lines)).filter(F.col("reason") != "second data block")


@query("cif_block_rejects", """
SELECT 'c' || CAST(o_orderkey AS STRING) AS doc, CAST(o_orderkey AS STRING) AS block
FROM orders WHERE o_orderkey % 10 = 4
""")
def cif_block_rejects(r: Roles) -> DataFrame:
    problems = cif.document_facts(order_segments(r, faulty_documents(r)))
    return problems.filter(F.array_contains("reasons", "second data block")).select("doc", "block")


@query("unknown_columns", """
SELECT 'c' || CAST(o_orderkey AS STRING) AS doc, 'chem_comp' AS category, 'colour' AS "column"
FROM orders WHERE o_orderkey % 10 = 8
""")
def unknown_columns(r: Roles) -> DataFrame:
    return cif.unknown_columns(order_segments(r, faulty_documents(r)))


@query("key_mismatch", """
SELECT 'c' || CAST(o_orderkey AS STRING) AS doc, 'C' || CAST(o_orderkey AS STRING) AS expected,
  CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE 'C' END || CAST(o_custkey AS STRING) AS id
FROM orders WHERE o_orderstatus = 'P' OR o_orderkey <> o_custkey
""")
def key_mismatch(r: Roles) -> DataFrame:
    lines = header(r.orders, text("c", key("o_orderkey")), [
        text("data_", key("o_orderkey")),
        text("_chem_comp.id ", F.when(F.col("o_orderstatus") == "P", "x").otherwise("c"), key("o_custkey")),
    ])
    rows = cif.category_rows(order_segments(r, lines), {"chem_comp": ("id",)})
    return cif.key_mismatch(rows, F.upper("doc"))


_RAW_DATE = """CASE o_orderkey % 7 WHEN 0 THEN '?' WHEN 1 THEN '2011-5-3' WHEN 2 THEN '2011-13-45' WHEN 3 THEN 'n/a'
  WHEN 4 THEN '"."' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END"""


@query("header_probe", f"""
WITH raw AS (SELECT o_orderkey, o_orderstatus, {_RAW_DATE} AS d, pdbx_initial_date AS i, pdbx_release_status AS s,
    pdbx_replaced_by AS r, pdbx_subcomponent_list AS c
  FROM orders JOIN component ON id = CAST(o_orderkey AS STRING)),
dated AS (SELECT *, CASE WHEN regexp_full_match(d, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN TRY_CAST(d AS DATE) END AS m FROM raw)
SELECT 'c' || CAST(o_orderkey AS STRING) AS doc, CAST(o_orderkey AS STRING) AS block, i AS created, m AS modified,
  (r IS NOT NULL OR upper(trim(s)) IN ('OBS', 'WDRN')) AS obsolete, (c IS NOT NULL) AS compound,
  (o_orderstatus <> 'O' AND i IS NULL AND m IS NULL) AS error
FROM dated
""")
def header_probe(r: Roles) -> DataFrame:
    """Header of every document; those of two statuses have atoms, the third has none."""
    c = r.component.withColumnRenamed("id", "cid").join(
        r.orders.select(key("o_orderkey").alias("cid"), F.expr(_RAW_DATE).alias("raw"), "o_orderstatus"), "cid"
    )
    has_atoms = F.col("o_orderstatus") != "O"
    lines = header(c, text("c", F.col("cid")), [
        text("data_", F.col("cid")),
        text("_chem_comp.id ", F.col("cid")),
        F.lit("loop_"), F.when(has_atoms, "_chem_comp_atom.comp_id").otherwise("_chem_comp_bond.comp_id"), F.col("cid"),
        text("_chem_comp.pdbx_initial_date ", quoted(F.col("pdbx_initial_date"))),
        text("_chem_comp.pdbx_modified_date ", F.col("raw")),
        text("_chem_comp.pdbx_release_status ", quoted(F.col("pdbx_release_status"))),
        text("_chem_comp.pdbx_replaced_by ", quoted(F.col("pdbx_replaced_by"))),
        text("_chem_comp.pdbx_subcomponent_list ", quoted(F.col("pdbx_subcomponent_list"))),
    ])
    segs = order_segments(r, lines)
    return status.header(cif.document_facts(segs))
