"""Null tokens, dates, casts, flags, defaults and dictionary types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from compdict import schema
from compdict.functions import clean
from compdict.operators import merge, quality
from compdict.plans import convert
from compdict.queries.registry import Roles, query

_TOKEN = """CASE o_orderkey % 6 WHEN 0 THEN '.' WHEN 1 THEN '?' WHEN 2 THEN chr(9) || ' ? ' WHEN 3 THEN ''
  WHEN 4 THEN ' ' || o_orderpriority || ' ' ELSE o_orderpriority END"""


@query("null_tokens", f"""
SELECT o_orderkey, CASE WHEN v NOT IN ('.', '?') THEN v END AS exact,
  CASE WHEN regexp_replace(v, '^\\s+|\\s+$', '', 'g') NOT IN ('', '.', '?')
    THEN regexp_replace(v, '^\\s+|\\s+$', '', 'g') END AS stripped
FROM (SELECT o_orderkey, {_TOKEN} AS v FROM orders) x
""")
def null_tokens(r: Roles) -> DataFrame:
    raw = r.orders.select("o_orderkey", F.expr(_TOKEN).alias("v"))
    return raw.select("o_orderkey", clean.null_token("v").alias("exact"), clean.blank_to_null("v").alias("stripped"))


_DATE = """CASE o_orderkey % 8 WHEN 0 THEN '2011-5-3' WHEN 1 THEN '2011-13-45' WHEN 2 THEN 'n/a' WHEN 3 THEN NULL
  WHEN 4 THEN ' 2011-05-31' WHEN 5 THEN '2011-02-30' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END"""


@query("date_parse", f"""
SELECT o_orderkey, d, CASE WHEN v IS NULL THEN NULL WHEN d IS NULL THEN 'invalid'
  WHEN NOT regexp_full_match(v, '\\d{{4}}-\\d\\d-\\d\\d') THEN 'short' END AS problem
FROM (SELECT o_orderkey, v, CASE WHEN regexp_full_match(v, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN TRY_CAST(v AS DATE) END AS d
  FROM (SELECT o_orderkey, {_DATE} AS v FROM orders) y) x
""")
def date_parse(r: Roles) -> DataFrame:
    raw = r.orders.select("o_orderkey", F.expr(_DATE).alias("v"))
    return raw.select("o_orderkey", clean.parse_date("v").alias("d"), clean.date_problem("v").alias("problem"))


_NUMBER = """CASE l_linenumber WHEN 1 THEN '12.5' WHEN 2 THEN 'x' WHEN 3 THEN '99999999999' WHEN 4 THEN NULL
  ELSE CAST(l_partkey AS STRING) END"""
_MIXED = f"SELECT l_orderkey, l_partkey, {_NUMBER} AS number, CASE WHEN l_linestatus = 'F' THEN 'soon' ELSE '1999-07-08' END AS day FROM lineitem"


@query("cast_or_reject", f"""
WITH raw AS ({_MIXED})
SELECT l_orderkey, l_partkey, 'number' AS "column", number AS value FROM raw
WHERE number IN ('12.5', 'x', '99999999999')
UNION ALL SELECT l_orderkey, l_partkey, 'day', day FROM raw WHERE day = 'soon'
""")
def cast_or_reject(r: Roles) -> DataFrame:
    raw = r.lineitem.select(
        "l_orderkey", "l_partkey", F.expr(_NUMBER).alias("number"),
        F.when(F.col("l_linestatus") == "F", "soon").otherwise("1999-07-08").alias("day"),
    )
    return quality.cast_rejects(raw, {"number": T.IntegerType(), "day": T.DateType()}, ["l_orderkey", "l_partkey"])


@query("typed_schema", """
SELECT CASE WHEN l_linenumber <= 3 THEN NULL ELSE CAST(l_linenumber AS INTEGER) END AS ordinal,
  CAST(l_orderkey AS STRING) AS comp_id, CAST(l_partkey AS STRING) AS name, CAST(NULL AS STRING) AS provenance,
  l_returnflag AS type
FROM lineitem
""")
def typed_schema(r: Roles) -> DataFrame:
    """Text columns, some of them unfit, under the fixed layout of a table."""
    n = F.col("l_linenumber")
    text = r.lineitem.select(
        F.when(n == 1, "1.5").when(n == 2, "two").when(n > 3, n.cast("string")).alias("ordinal"),
        F.col("l_orderkey").cast("string").alias("comp_id"), F.col("l_partkey").cast("string").alias("name"),
        F.lit(None).cast("string").alias("provenance"), F.col("l_returnflag").alias("type"),
    )
    return quality.typed_table(text, schema.CIF["pdbx_chem_comp_synonyms"])


@query("apply_defaults", """
SELECT CAST(o_orderkey AS STRING) AS "Nonpolymer_comp_ID", 'entity' AS "Sf_category",
  CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'NEED_ACC_NO' END AS "Entry_ID",
  CASE WHEN o_orderstatus = 'P' THEN CAST(o_custkey AS INTEGER) ELSE 1 END AS "ID",
  1 AS "Number_of_nonpolymer_components"
FROM orders
""")
def apply_defaults(r: Roles) -> DataFrame:
    given = r.orders.select(
        F.col("o_orderkey").cast("string").alias("Nonpolymer_comp_ID"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("Entry_ID"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_custkey").cast("int")).alias("ID"),
    )
    full = merge.apply_defaults(merge.complete(given, schema.STAR["Entity"]), schema.DEFAULTS["Entity"])
    return full.select("Nonpolymer_comp_ID", "Sf_category", "Entry_ID", "ID", "Number_of_nonpolymer_components")


_FLAGS = ("pdbx_ambiguous_flag", "mon_nstd_flag", "pdbx_model_coordinates_missing_flag", "pdbx_ideal_coordinates_missing_flag")


@query("flag_yes_no", "SELECT id, " + ", ".join(
    f"CASE WHEN upper({c}) = 'Y' THEN 'yes' ELSE 'no' END AS {c}" for c in _FLAGS) + " FROM component")
def flag_yes_no(r: Roles) -> DataFrame:
    return r.component.select("id", *[clean.yes_no(c).alias(c) for c in _FLAGS])


_STRIPPED = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
_BLANK = "CASE WHEN " + _STRIPPED + " NOT IN ('', '.', '?') THEN " + _STRIPPED + " END"


@query("flag_normalise", f"""
SELECT id, {_BLANK.format('pdbx_synonyms')} AS pdbx_synonyms, {_BLANK.format('pdbx_release_status')} AS pdbx_release_status,
  CASE WHEN upper(pdbx_ambiguous_flag) = 'Y' THEN 'yes' WHEN upper(pdbx_ambiguous_flag) = 'N' THEN 'no'
    ELSE pdbx_ambiguous_flag END AS pdbx_ambiguous_flag, number_atoms_all
FROM component
""")
def flag_normalise(r: Roles) -> DataFrame:
    return convert.normalise_copy(
        r.component.select("id", "pdbx_synonyms", "pdbx_release_status", "pdbx_ambiguous_flag", "number_atoms_all")
    )


_DICTIONARY = """SELECT p_brand AS tagcategory, p_name AS tagfield, CAST(p_partkey * 7 % 1000 AS INT) AS dictionaryseq,
  p_type AS originalcategory,
  CASE p_size % 9 WHEN 0 THEN 'VARCHAR(80)' WHEN 1 THEN 'Integer' WHEN 2 THEN 'DATETIME year to day' WHEN 3 THEN 'float'
    WHEN 4 THEN 'boolean' WHEN 5 THEN 'CHAR(3)' WHEN 6 THEN 'text' WHEN 7 THEN 'floating' ELSE 'blob' END AS dbtype
FROM {part}"""


def dictionary(r: Roles) -> DataFrame:
    return r.spark.sql(_DICTIONARY, part=r.part)


@query("category_order", f"""
SELECT tagcategory, min(dictionaryseq) AS first_seq FROM ({_DICTIONARY.format(part='part')}) d
WHERE originalcategory IN ('ECONOMY') GROUP BY tagcategory
""")
def category_order(r: Roles) -> DataFrame:
    return quality.category_order(dictionary(r), "tagcategory", "dictionaryseq", F.col("originalcategory").isin("ECONOMY"))


@query("dictionary_types", f"""
SELECT tagcategory, tagfield, dictionaryseq,
  CASE WHEN lower(dbtype) = 'float' THEN 'text' WHEN lower(dbtype) LIKE 'date%' THEN 'date'
    WHEN lower(dbtype) LIKE 'int%' THEN 'integer' ELSE 'text' END AS column_type,
  dbtype NOT IN ('floating', 'blob') AS known
FROM ({_DICTIONARY.format(part='part')}) d
""")
def dictionary_types(r: Roles) -> DataFrame:
    return dictionary(r).select(
        "tagcategory", "tagfield", "dictionaryseq",
        clean.column_type("dbtype").alias("column_type"), clean.is_known_type("dbtype").alias("known"),
    )
