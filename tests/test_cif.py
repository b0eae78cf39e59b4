"""Lexical cases, document cuts and rejects of the CIF reader."""

import re

import pytest
from pyspark.sql import functions as F

from compdict.sources import cif

GOOD = """data_xy
# a comment
_chem_comp.id   xy
_chem_comp.name "it's a name"
_chem_comp.formula 'C3 'H7''
_chem_comp.type first
_unknown.thing 1
_chem_comp.Type a"b#c   # trailing
_chem_comp.pdbx_synonyms '?'
_chem_comp.model_details .
_chem_comp.model_source
;line one
 line two
#not a comment
;
save_frame
LOOP_
_chem_comp_atom.comp_id
_chem_comp_atom.atom_id _chem_comp_atom.model_Cartn_x
xy "O5'" 1.50
xy 'H5''' -0.250 xy C
  2
xy
;multi
value
; 3 xy D 4
loop_
_pdbx_chem_comp_audit.comp_id
_pdbx_chem_comp_audit.details
xy
;last
;
"""


def frame(spark, docs, ending="\n"):
    rows = [(d, i, line) for d, text in docs.items() for i, line in enumerate(text.split(ending))]
    return spark.createDataFrame(rows, "doc string, line_no long, line string")


def parse(lines, **kw):
    segs = cif.segments(cif.units(lines, **kw))
    return segs, cif.category_rows(segs)


def table(rows, name, columns):
    return sorted(tuple(r)[1:] for r in cif.table_text(rows, name, columns).collect())


def check_good(rows):
    columns = ["id", "name", "formula", "type", "pdbx_synonyms", "model_details", "model_source", "model_erf"]
    assert table(rows, "chem_comp", columns) == [
        ("XY", "it's a name", "C3 'H7'", 'a"b#c', None, None, "line one\n line two\n#not a comment", None)
    ]
    assert table(rows, "chem_comp_atom", ["comp_id", "atom_id", "model_cartn_x"]) == [
        ("XY", "C", "2"), ("XY", "D", "4"), ("XY", "H5''", "-0.250"), ("XY", "O5'", "1.50"), ("XY", "multi\nvalue", "3"),
    ]
    assert table(rows, "pdbx_chem_comp_audit", ["comp_id", "details"]) == [("XY", "last")]


def test_good_document(spark):
    segs, rows = parse(frame(spark, {"d": GOOD}))
    check_good(rows)
    assert cif.document_facts(segs).first()["reasons"] == []
    assert {r.category for r in rows.select("category").distinct().collect()} == {
        "chem_comp", "chem_comp_atom", "pdbx_chem_comp_audit"
    }


@pytest.mark.parametrize("max_lines", [1, 2, 3, 5, 11])
def test_cut_document_gives_the_same(spark, max_lines):
    lines = cif.in_parts(frame(spark, {"d": GOOD, "e": "data_e\n_chem_comp.id e\n"}), max_lines)
    assert "part" in lines.columns and lines.filter("doc = 'd'").agg(F.countDistinct("part")).first()[0] > 1
    segs, rows = parse(lines)
    check_good(rows.filter("doc = 'd'"))
    assert [r.reasons for r in cif.document_facts(segs).collect()] == [[], []]
    assert table(rows.filter("doc = 'e'"), "chem_comp", ["id"]) == [("E",)]


def test_quoted_null_is_text_on_request(spark):
    text = "data_a\n_chem_comp.id a\n_chem_comp.name '?'\n_chem_comp.type ?\n"
    kept = cif.units(frame(spark, {"a": text}), quoted_null=False).filter("kind = 'val'")
    assert sorted((r.vals for r in kept.collect()), key=str) == [["?"], ["a"], [None]]


BAD = {
    "ragged": "data_a\nloop_\n_chem_comp_bond.comp_id\n_chem_comp_bond.atom_id_1\na b\na\n",
    "ragged tag": "data_a\n_chem_comp.id\n_chem_comp.name b\n",
    "unclosed quote": "data_a\n_chem_comp.name 'open\n",
    "unclosed text field": "data_a\n_chem_comp.name\n;open\n",
    "second data block": "data_a\n_chem_comp.id a\ndata_b\n_chem_comp.id b\n",
    "text before data block": "_chem_comp.id a\ndata_a\n",
    "no data block": "_chem_comp.id a\n",
    "tag without category": "data_a\n_name a\n",
    "mixed loop": "data_a\nloop_\n_chem_comp_bond.comp_id\n_chem_comp_atom.comp_id\na b\n",
    "repeated loop tag": "data_a\nloop_\n_chem_comp_bond.comp_id\n_chem_comp_bond.Comp_ID\na b\n",
    "reserved word": "data_a\n_chem_comp.id a\nstop_\n",
}


def test_rejects(spark):
    lines = frame(spark, {**BAD, "good": GOOD})
    segs, _ = parse(lines)
    found = {}
    for r in cif.rejects(lines, segs).collect():
        found.setdefault(r.doc, set()).add(r.reason)
    assert "good" not in found and set(found) == set(BAD)
    for name in BAD:
        assert name.replace("ragged tag", "ragged") in found[name], name


def test_header_is_free_of_order(spark):
    docs = {
        "a": "data_a\nloop_\n_chem_comp_atom.comp_id\na\n_chem_comp.pdbx_modified_date 2011-5-3\n",
        "b": "data_b\n_chem_comp.pdbx_release_status ' wdrn '\n_chem_comp.pdbx_replaced_by ?\n",
        "c": "data_c\n_chem_comp.pdbx_release_status OBS\n_chem_comp.pdbx_release_status REL\n_chem_comp.pdbx_subcomponent_list 'A B'\n",
        "d": "data_d\nloop_\n_chem_comp.id\n_chem_comp.pdbx_modified_date\n_chem_comp.pdbx_replaced_by\nd 2012-01-01 X\n",
        "e": "data_e\n_chem_comp.pdbx_initial_date\n;2011-05-31\n;\n_chem_comp.pdbx_modified_date\n;2011-05-31\nor so\n;\n",
    }
    segs, _ = parse(frame(spark, docs))
    facts = cif.document_facts(segs).select("doc", *cif.HEADER)
    got = {r.doc: tuple(r)[1:] for r in facts.collect()}
    assert got["a"] == (None, "2011-5-3", None, None, None)
    assert got["b"] == (None, None, None, "wdrn", None)
    assert got["d"] == (None, "2012-01-01", "X", None, None)
    assert got["e"] == ("2011-05-31", "2011-05-31\nor so", None, None, None)
    assert got["c"] == (None, None, None, "OBS", "A B")


def test_scan(spark, tmp_path):
    for name in ("a.cif", "sub/b c.cif", "sub/FULL/c.cif", "REMOVED/d.cif", "FULLER/e.cif", "f.CIF", "g.txt"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(GOOD.replace("\n", "\r\n").encode())
    files = {(r.doc, r.id) for r in cif.scan_files(spark, str(tmp_path)).collect()}
    assert files == {("a.cif", "A"), ("sub/b c.cif", "B C"), ("FULLER/e.cif", "E")}
    lines = cif.scan_lines(spark, str(tmp_path))
    assert {r.part for r in lines.select("part").distinct().collect()} == {0}
    _, rows = parse(lines)
    for doc, _ in files:
        check_good(rows.filter(F.col("doc") == doc))
    with pytest.raises(NotADirectoryError):
        cif.scan_lines(spark, str(tmp_path / "a.cif"))


def test_large_file_is_cut_at_splits(spark, tmp_path):
    (tmp_path / "a.cif").write_text(GOOD)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "70")
        lines = cif.scan_lines(spark, str(tmp_path))
        assert lines.select("part").distinct().count() > 3
        check_good(parse(lines)[1])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _operators(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [m.group(1) for m in re.finditer(r"^[\s:+\-*!|]*([A-Z]\w+)", plan, re.M)]


def test_one_plan_for_any_file_size(spark, tmp_path):
    """A large file changes no operator, scan or shuffle of the plan; the text is read by one job."""
    settings = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.files.maxPartitionBytes")}
    sc = spark.sparkContext
    found = {}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for kind, split in (("small", "128m"), ("large", "70")):
            folder = tmp_path / kind
            folder.mkdir()
            for i in range(3):
                (folder / f"c{i}.cif").write_text(GOOD.replace("xy", f"x{i}"))
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            sc.setJobGroup(kind, kind)
            rows = cif.category_rows(cif.segments(cif.units(cif.scan_lines(spark, str(folder)))))
            got = table(rows, "chem_comp_atom", ["comp_id", "atom_id", "model_cartn_x"])
            found[kind] = (_operators(rows), len(sc.statusTracker().getJobIdsForGroup(kind)), got)
            if kind == "large":
                assert cif.scan_lines(spark, str(folder)).filter("part > 0").count() > 0
    finally:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sc.setJobGroup(None, None)
    small, large = found["small"], found["large"]
    assert small[0] == large[0] and not any("Scan" in op and "text" in op for op in small[0])
    assert small[1] == large[1]
    assert small[2] == large[2] and len(small[2]) == 15


def test_only_cut_documents_are_written(spark, monkeypatch):
    """Units of documents in one piece stay in their plan; only those of cut ones are checkpointed."""
    written, plain = [], cif.checkpoint_cut

    def counted(df):
        made = plain(df)
        written.append(made.count() if "kind" in df.columns else 0)
        return made

    monkeypatch.setattr(cif, "checkpoint_cut", counted)
    texts = {"d": GOOD, "e": GOOD.replace("xy", "e")}
    whole = cif.segments(cif.units(frame(spark, texts)))
    assert sum(written) == 0 and whole.count() > 0
    parts = cif.segments(cif.units(cif.in_parts(frame(spark, texts), 3)))
    assert sum(written) > 0 and parts.filter("kind = 'val'").count() == whole.filter("kind = 'val'").count()


def test_facts_take_one_aggregation_a_document(spark):
    """Documents in one piece are grouped by document only, never by segment."""
    segs = cif.segments(cif.units(frame(spark, {"a": "data_a\n_chem_comp.id a\nloop_\n_chem_comp_atom.comp_id\na\n"})))
    plan = cif.document_facts(segs.filter("NOT is_cut"))._jdf.queryExecution().optimizedPlan().toString()
    keys = [line.split("Aggregate [", 1)[1].split("]")[0] for line in plan.splitlines() if "Aggregate [" in line]
    assert keys and all(re.fullmatch(r"doc#\d+L?", k) for k in keys)


def test_facts_of_odd_headers(spark):
    """Repeated header tags, tags without values, text fields and header columns of loops, whole and in parts."""
    texts = {
        "twice": "data_a\n_chem_comp.pdbx_replaced_by B\n_chem_comp.pdbx_replaced_by ?\n_chem_comp.pdbx_modified_date 2011-01-02\n_chem_comp.pdbx_modified_date ?\n",
        "empty": "data_a\n_chem_comp.pdbx_modified_date 2011-01-02\n_chem_comp.pdbx_modified_date\n",
        "text": "data_a\n_chem_comp.pdbx_subcomponent_list\n;A\nB\n;\n_chem_comp.id a\n",
        "loop": "data_a\nloop_\n_chem_comp.id\n_chem_comp.pdbx_release_status\n_chem_comp.pdbx_initial_date\na OBS 2011-01-02\nb REL 2011-01-03\n",
        "states": "data_a\n_chem_comp.pdbx_release_status OBS\n_chem_comp.pdbx_release_status REL\n",
    }
    found = {r.doc: r for r in cif.document_facts(cif.segments(cif.units(frame(spark, texts)))).collect()}
    parts = {r.doc: r for r in cif.document_facts(cif.segments(cif.units(cif.in_parts(frame(spark, texts), 2)))).collect()}
    assert found == parts
    assert (found["twice"].replaced_by, found["twice"].modified) == ("B", None)
    assert (found["empty"].modified, found["empty"].reasons) == (None, ["ragged"])
    assert found["text"].subcomponents == "A\nB"
    assert (found["loop"].release_status, found["loop"].initial) == ("REL", "2011-01-03")
    assert found["states"].release_status == "OBS"
