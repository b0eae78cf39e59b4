"""CIF text as Spark tables: scan, units, segments, rows, rejects, header.

The unit of input is a *line*, not a file: ``(doc, part, line_no, line)``, where ``doc``
names the document (one component), ``part`` is 0 for a document in one piece, else the
number of the piece, growing along the document, and ``line_no`` orders the lines of a part.

Files larger than a scan split arrive cut at the split borders, and a table cuts its large
documents with ``in_parts``.  The plan is the same whatever the sizes, with one scan of the
text for documents in one piece and one for the parts of cut ones: all windows run per document
or per ``(doc, part)``, so one huge document is spread over its parts.  Documents in one piece go
from the lines to the rows in the partitions of one shuffle, and nothing of them is written.  A
part of a cut document is lexed from both states it may begin in (inside a text field or not);
its units are written once; what a part must know of the earlier ones (its true entry state,
which segment goes on, how many values came before) comes from summaries of at most two rows per
part, combined in part order and broadcast.

Loop rows that sit on one line, which is nearly all of them, stay arrays from the
line to the table row.  Only values that run over lines are split into cells and
put together again.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from compdict import schema
from compdict.checkpoints import cut as checkpoint_cut
from compdict.functions import clean

# --- fixed values: lexical rules of the format ------------------------------
SKIPPED_FOLDERS = ("FULL", "REMOVED")
TOKEN = (
    r"""'[^'\n]*+(?:'(?=\S)[^'\n]*+)*+'(?=\s|\z)"""
    r"""|"[^"\n]*+(?:"(?=\S)[^"\n]*+)*+"(?=\s|\z)"""
    r"""|#[^\n]*|\S+"""
)
NOT_ALL_VALUES = r"(?i)(?:^|\s)(?:_|#|loop_|data_|save_|stop_|global_)"
HAS_QUOTE = r"""(?:^|\s)['"]"""

VALUE_KINDS = ("val", "text", "cont")
PLACE = ("line_no", "u")
# What segments know of themselves in documents in one piece; null in cut ones.
OF_SEGMENT = ("head", "seg_n", "seg_data", "value_end")


def _is_cut(df: DataFrame) -> bool:
    return "part" in df.columns


def _piece(df: DataFrame) -> list[str]:
    """The key of what one task may hold: a document or a part of one."""
    return ["doc", "part"] if _is_cut(df) else ["doc"]


# ---------------------------------------------------------------- scanning

def _directory(spark: SparkSession, directory: str) -> str:
    """Absolute path of a directory; fails when it is not one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
        raise NotADirectoryError(directory)
    return fs.makeQualified(path).toUri().getPath().rstrip("/")


def below(path: Column, base: str) -> Column:
    """The part of a file URL below a base directory, percent signs decoded."""
    plain = F.url_decode(F.replace(F.regexp_replace(path, "^[A-Za-z0-9+.-]+:(//[^/]*)?", ""), F.lit("+"), F.lit("%2B")))
    return F.substr(plain, F.lit(len(base) + 2))


def wanted_path(relative: Column, skip=SKIPPED_FOLDERS, extension: str = "cif") -> Column:
    """Right extension and no skipped folder at any depth below the base."""
    folders = "|".join(skip)
    return relative.rlike(rf"[^/]\.{extension}$") & ~relative.rlike(rf"(^|/)({folders})/")


def component_id(path: Column, extension: str = "cif") -> Column:
    """Upper-cased file stem."""
    return F.upper(F.regexp_extract(path, rf"([^/]+)\.{extension}$", 1))


def scan_files(spark: SparkSession, directory: str) -> DataFrame:
    """``(doc, id, size, mtime)`` of every wanted file; reads the listing only, no content.

    Spark plans no scan of a file of zero bytes; such files come from the names of its index.
    """
    base = _directory(spark, directory)
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.cif")
        .load(directory)
    )
    sized = found.select(
        below(F.col("_metadata.file_path"), base).alias("doc"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime")
    )
    names = spark.createDataFrame([(f,) for f in found.inputFiles()], "path string")
    empty = (
        names.select(below(F.col("path"), base).alias("doc")).join(sized.select("doc"), "doc", "left_anti")
        .withColumn("size", F.lit(0).cast("bigint")).withColumn("mtime", F.lit(None).cast("timestamp"))
    )
    return (
        sized.unionByName(empty)
        .filter(wanted_path(F.col("doc")))
        .withColumn("id", component_id(F.col("doc")))
    )


def _bytes(spark: SparkSession, setting: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(setting))


def scan_lines(spark: SparkSession, directory: str, since=None) -> DataFrame:
    """Lines of every wanted file below a directory: ``(doc, part, line_no, line)``.

    ``part`` is 0 for a file within one scan split, else each split of the file is a part,
    numbered by where it starts.  ``line_no`` grows within a split, which is all the order
    that is needed.  There is one plan whatever the file sizes: nothing is looked at first.
    With ``since`` (a time) only files modified then or later are opened: Spark leaves the
    others out when it lists the files.
    """
    base = _directory(spark, directory)
    meta = F.col("_metadata")
    raw = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.cif")
        .text(directory)
        .select(
            "value",
            meta["file_path"].alias("path"),
            meta["file_size"].alias("size"),
            meta["file_block_start"].alias("start"),
            meta["file_block_length"].alias("length"),
        )
        .filter(wanted_path(below(F.col("path"), base)))
    )
    if since is not None:
        raw = raw.filter(F.col("_metadata.file_modification_time") >= F.lit(since))
    part = F.when(F.col("size") > F.col("length"), F.col("start") + 1).otherwise(0).cast("long").alias("part")
    return raw.select(
        below(F.col("path"), base).alias("doc"),
        part,
        F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("line"),
    )


def in_parts(lines: DataFrame, max_lines: int = 2_000_000, counted: DataFrame | None = None) -> DataFrame:
    """Cut documents above ``max_lines`` lines into parts; ``part`` is 0 for all others.

    A part of a cut document is a range of ``max_lines`` line numbers (``line_no div max_lines +
    1``), so it holds at most ``max_lines`` lines and the parts follow the document's order.  One
    aggregation counts the lines of every document (``counted`` may name a cheaper frame with
    one ``doc`` per line); only documents above the limit come out of it, one row each, written
    once and broadcast: there are at most (lines / ``max_lines``) of them.  The lines of the others
    are one side (``is_cut`` false), those of cut documents the other, each by a join that Spark
    can do before the rows grow to lines; the plan is the same whether a document is cut or not.
    """
    too_large = checkpoint_cut(
        (lines if counted is None else counted).groupBy("doc").agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > max_lines).select("doc")
    )

    def side(how: str, part: Column, is_cut: bool) -> DataFrame:
        return lines.join(F.broadcast(too_large), "doc", how).select(
            *lines.columns, part.cast("long").alias("part"), F.lit(is_cut).alias("is_cut")
        )

    return side("left_anti", F.lit(0), False).unionByName(side("left_semi", F.floor(F.col("line_no") / max_lines) + 1, True))


# ------------------------------------------------------------------- units

def _unquote(token: Column) -> Column:
    first = F.substring(token, 1, 1)
    closed = first.isin("'", '"') & (F.length(token) > 1) & token.endswith(first)
    return F.when(closed, F.substring(token, F.lit(2), F.length(token) - 2)).otherwise(token)


def _broken(token: Column) -> Column:
    first = F.substring(token, 1, 1)
    return first.isin("'", '"') & ((F.length(token) < 2) | ~token.endswith(first))


def _kind(token: Column) -> Column:
    low = F.lower(token)
    return (
        F.when(token.startswith("_"), "tag")
        # all words of the format hold a low line, hardly any value does
        .when(~token.contains("_"), "val")
        .when(low == "loop_", "loop")
        .when(low.startswith("data_"), "data")
        .when(low.isin("stop_", "global_"), "reserved")
        .otherwise("val")
    )


def units(lines: DataFrame, quoted_null: bool = True) -> DataFrame:
    """Split lines into units ``(doc, part, entry, semis, line_no, u, kind, vals, broken, is_cut)``.

    The lines of a cut document's part are split twice: as if the part began outside a
    text field (``entry`` 0) and inside one (1); ``semis`` is the number of lines starting
    with ``;`` in the part.  ``segments`` keeps the split that the parts before imply.
    Documents in one piece and cut ones (``is_cut``) are two sides of a union, each known by
    a literal, so that what works on one side plans nothing for the other.

    ``kind`` is data, loop, tag, val, text (first line of a text field), cont
    (a further line of it) or reserved.  A line of nothing but values is one unit.
    With ``quoted_null`` a quoted null token is NULL like a bare one; without, it is
    text and bare null tokens become NULL here.
    """
    if not _is_cut(lines):
        lines = lines.withColumn("part", F.lit(0).cast("long"))
    if "is_cut" not in lines.columns:
        lines = lines.withColumn("is_cut", F.col("part") > 0)
    return _lexed(lines, False, quoted_null).unionByName(_lexed(lines, True, quoted_null))


def _lexed(lines: DataFrame, is_cut: bool, quoted_null: bool) -> DataFrame:
    """Units of one side of the lines."""
    lines = lines.filter(F.col("is_cut") if is_cut else ~F.col("is_cut"))
    semi = F.col("line").startswith(";")
    piece = ["doc", "part"] if is_cut else ["doc"]
    before = Window.partitionBy(*piece).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.withColumn("semi", F.coalesce(F.sum(semi.cast("long")).over(before), F.lit(0)))
    if is_cut:
        # a part is lexed from both start states; segments keeps the true one
        placed = placed.withColumn("semis", F.sum(semi.cast("long")).over(Window.partitionBy(*piece))).select(
            "*", F.explode(F.array(F.lit(0), F.lit(1))).alias("entry")
        )
    else:
        placed = placed.drop("part").select("*", F.lit(0).cast("long").alias("part"), F.lit(0).alias("entry"), F.lit(None).cast("long").alias("semis"))
    placed = placed.withColumn("inside", (F.col("semi") + F.col("entry")) % 2 == 1)
    piece = ["doc", "part"]
    piece = [*piece, "entry", "semis"]
    rest = F.substring("line", 2, 1 << 30)
    body = F.when(semi & F.col("inside"), rest).when(~semi & ~F.col("inside"), F.col("line"))
    text = (
        F.when(semi & ~F.col("inside"), F.struct(F.lit("text").alias("kind"), F.array(rest).alias("vals")))
        .when(~semi & F.col("inside"), F.struct(F.lit("cont").alias("kind"), F.array("line").alias("vals")))
    )

    def value(t: Column) -> Column:
        if quoted_null:
            return _unquote(t)
        return F.when(~t.isin(*clean.NULL_TOKENS), _unquote(t))

    # most lines hold no quote and no comment, so they are told apart without a pattern
    raw = F.col("body")
    marks = raw.contains("'") | raw.contains('"')
    quoted = marks & raw.rlike(HAS_QUOTE)
    words = F.array_remove(F.split(raw, " "), "")
    other = [raw.contains(c) for c in ("#", "\t", "\x0b", "\f", "\r")]
    tokens = F.when(reduce(or_, other, marks), F.regexp_extract_all(raw, F.lit(TOKEN), F.lit(0))).otherwise(words)
    mixed = (raw.contains("_") | raw.contains("#")) & (raw.startswith("_") | raw.rlike(NOT_ALL_VALUES))
    plain = F.transform("tokens", value) if not quoted_null else F.when(
        F.col("quoted"), F.transform("tokens", value)
    ).otherwise(F.col("tokens"))

    def dropped(t: Column) -> Column:
        return t.startswith("#") | (~t.startswith("_") & t.contains("_") & F.lower(t).startswith("save_"))

    def unit(t: Column) -> Column:
        # only values may be quoted or null tokens, so the others stay as they are
        return F.struct(_kind(t).alias("kind"), F.array(value(t)).alias("vals"))

    first, second = F.get("tokens", F.lit(0)), F.get("tokens", F.lit(1))
    single = F.transform(F.filter("tokens", lambda t: ~dropped(t)), unit)
    parsed = (
        F.when(F.col("text").isNotNull(), F.array("text"))
        .when(F.col("mixed") & (F.size("tokens") == 1) & ~dropped(first), F.array(unit(first)))
        .when(F.col("mixed") & (F.size("tokens") == 2) & ~dropped(first) & ~dropped(second), F.array(unit(first), unit(second)))
        .when(F.col("mixed"), single)
        .when(F.size("tokens") > 0, F.array(F.struct(F.lit("val").alias("kind"), plain.alias("vals"))))
    )
    return (
        placed.select(*piece, "line_no", body.alias("body"), text.alias("text"))
        .select(
            *piece, "line_no", "text", tokens.alias("tokens"), quoted.alias("quoted"),
            mixed.alias("mixed"),
        )
        .select(
            *piece, "line_no",
            F.when(F.col("quoted"), F.exists("tokens", _broken)).otherwise(False).alias("broken"),
            parsed.alias("parsed"),
        )
        # outer, as an inner one would be given a filter that works all of this out twice
        .select(*piece, "line_no", "broken", F.posexplode_outer("parsed").alias("u", "unit"))
        .filter("unit IS NOT NULL")
        .select(*piece, "line_no", "u", "unit.kind", "unit.vals", "broken", F.lit(is_cut).alias("is_cut"))
    )


# ---------------------------------------------------------------- segments

def _tag(token: Column) -> Column:
    """``category.column`` of a tag: leading underscores off, the column in lower case."""
    bare = F.ltrim(token, F.lit("_"))
    return F.concat_ws(".", F.substring_index(bare, ".", 1), F.lower(F.split_part(bare, F.lit("."), F.lit(2))))


def _continued(pieces: DataFrame) -> DataFrame:
    """Where a segment goes on from an earlier part of a cut document.

    One row per continued part: the segment's home ``(spart, sseg)``, the number of
    its values before this part, and its tags over all parts.
    """
    here = Window.partitionBy("doc", "part")
    ends = (
        pieces.filter("part > 0")
        .groupBy("doc", "part", "seg")
        .agg(
            F.sum("n").alias("n"),
            F.array_sort(
                F.collect_list(F.when(F.col("kind") == "tag", F.struct(*PLACE, _tag(F.col("vals")[0]).alias("tag"))))
            ).alias("placed"),
            F.bool_or(F.col("kind") == "loop").alias("loop"),
            F.min_by("kind", F.struct(*PLACE)).alias("first"),
            F.max_by("kind", F.struct(*PLACE)).alias("last"),
        )
        .withColumn("top", F.max("seg").over(here))
        .filter("seg = 0 OR seg = top")
    )
    order = Window.partitionBy("doc").orderBy("part", "seg")
    ended = F.coalesce(F.lag("last").over(order).isin("data", *VALUE_KINDS), F.lit(True))
    fresh = (F.col("seg") > 0) | ((F.col("first") == "tag") & ended)
    home = F.last(F.when(F.col("fresh"), F.struct("part", "seg")), ignorenulls=True)
    chain = Window.partitionBy("doc", "home").orderBy("part")
    return (
        ends.withColumn("fresh", fresh)
        .withColumn("home", F.coalesce(home.over(order), F.struct("part", "seg")))
        .select(
            "doc", "part", "seg", "fresh",
            F.col("home.part").alias("spart"), F.col("home.seg").alias("sseg"),
            F.sum("n").over(chain.rowsBetween(Window.unboundedPreceding, -1)).alias("done"),
            F.transform(
                F.flatten(
                    F.collect_list("placed").over(
                        chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
                    )
                ),
                lambda p: p.tag,
            ).alias("all_tags"),
            F.bool_or("loop").over(Window.partitionBy("doc", "home")).alias("in_loop"),
        )
        .filter("NOT fresh AND (part <> spart OR seg <> sseg)")
        .drop("fresh")
    )


def _entries(local: DataFrame) -> DataFrame:
    """``(doc, part, _true)``: the text-field state each part after the first begins in.

    A part's effect on the state is the parity of its lines that start with ``;``; the
    effects of the parts before are summed in part order, one small row per part.  Every
    such line gives a unit under at least one entry state, so ``semis`` is seen.
    """
    per_part = local.filter("part > 0").groupBy("doc", "part").agg(F.max("semis").alias("_semis"))
    earlier = Window.partitionBy("doc").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select("doc", "part", (F.coalesce(F.sum("_semis").over(earlier), F.lit(0)) % 2).alias("_true"))


def segments(unit_rows: DataFrame) -> DataFrame:
    """Give every unit its segment: one free tag with its value, or one loop.

    Adds ``spart, sseg`` (identity of the segment within the document), ``loop``,
    ``tags`` (as ``category.column``) and ``i``, the index of the unit's first value
    within the segment; for documents in one piece also ``OF_SEGMENT`` (see ``_numbered``).

    One plan for any input.  Documents in one piece are segmented in the partitions their units
    were made in, and nothing of them is written.  Cut ones are segmented by part (and entry
    state), written once, and what a part must know of the parts before it (its entry state, the
    segment it goes on with, values before it) comes from summaries of at most two rows a part,
    combined in part order and broadcast: there is one row per scan split of a cut document at most.
    """
    shape = ["doc", "part", *PLACE, "kind", "vals", "n", "broken"]
    whole = _numbered(unit_rows.filter("NOT is_cut"), ["doc"]).select(
        *shape, F.col("part").alias("spart"), F.col("seg").alias("sseg"), F.col("own_loop").alias("loop"),
        F.col("own_tags").alias("tags"), _index(F.col("done_here")), F.lit(False).alias("is_cut"), *OF_SEGMENT,
    )
    local = checkpoint_cut(_numbered(unit_rows.filter("is_cut"), ["doc", "part", "entry"]).drop(*OF_SEGMENT))
    local = (
        local.join(F.broadcast(_entries(local)), ["doc", "part"], "left")
        .filter(F.col("entry") == F.coalesce("_true", F.lit(0)))
        .drop("_true", "entry", "semis")
    )
    return whole.unionByName(local.join(F.broadcast(_continued(local)), ["doc", "part", "seg"], "left").select(
        *shape,
        F.coalesce("spart", "part").alias("spart"),
        F.coalesce(F.col("sseg"), F.col("seg")).alias("sseg"),
        F.coalesce("in_loop", "own_loop").alias("loop"),
        F.coalesce("all_tags", "own_tags").alias("tags"),
        _index(F.col("done_here") + F.coalesce("done", F.lit(0))),
        F.lit(True).alias("is_cut"),
    ), allowMissingColumns=True)


def _numbered(unit_rows: DataFrame, piece: list[str]) -> DataFrame:
    """Units with the segment of their piece ``seg``, its tags and kind, and the values before them in it.

    For the facts of documents: ``head`` marks one first unit of a segment, ``seg_n`` is the number
    of its values, ``seg_data`` whether it opens a block, ``value_end`` the place of its last value.
    """
    order = Window.partitionBy(*piece).orderBy(*PLACE)
    closed = F.lag("kind").over(order).isin("data", *VALUE_KINDS)
    starts = F.col("kind").isin("data", "loop") | ((F.col("kind") == "tag") & F.coalesce(closed, F.lit(False)))
    n = F.when(F.col("kind").isin("val", "text"), F.size("vals")).otherwise(0)
    pieces = (
        unit_rows.withColumn("start", starts.cast("int"))
        .withColumn("seg", F.sum("start").over(order))
        .withColumn("n", n)
        .drop("start")
    )
    inside = Window.partitionBy(*piece, "seg").orderBy(*PLACE)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    # one select, so that one window step does all; what a query does not use is left out of it
    return pieces.withColumn("tag", F.when(F.col("kind") == "tag", _tag(F.col("vals")[0]))).select(
        "*",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("done_here"),
        F.collect_list("tag").over(whole).alias("own_tags"),
        (F.first("kind").over(whole) == "loop").alias("own_loop"),
        (F.count(F.lit(1)).over(earlier) == 0).alias("head"),
        F.sum("n").over(whole).alias("seg_n"),
        F.max(F.col("kind") == "data").over(whole).alias("seg_data"),
        F.max(F.when(F.col("kind").isin(*VALUE_KINDS), F.struct(*PLACE))).over(whole).alias("value_end"),
    ).drop("tag")


def _index(done: Column) -> Column:
    """Index of a unit's first value; a further line of a text field belongs to the value before."""
    return F.when(F.col("kind") == "cont", done - 1).otherwise(done).alias("i")


# -------------------------------------------------------------------- rows

_SEGMENT = ["doc", "spart", "sseg"]


def _category(tag: Column) -> Column:
    return F.substring_index(tag, ".", 1)


def _by_row(values: DataFrame) -> DataFrame:
    """Cut value units at table-row borders: ``row``, the index ``i`` of the first value, ``vals``.

    ``i`` counts from the start of the segment.  Nearly every unit lies within one row.
    """
    others = [c for c in values.columns if c not in ("i", "vals", "n", "broken")]
    cut = values.withColumn("width", F.size("tags")).select(
        "*", F.explode(F.sequence(F.expr("i div width"), F.expr("(i + greatest(n, 1) - 1) div width"))).alias("row")
    )
    low = F.greatest(F.col("i"), F.col("row") * F.col("width"))
    high = F.least((F.col("row") + 1) * F.col("width"), F.col("i") + F.col("n"))
    inside = (low == F.col("i")) & (F.size("vals") == high - low)
    return cut.select(
        *others, "row", low.alias("i"),
        F.when(inside | (F.col("kind") != "val"), F.col("vals"))
        .otherwise(F.slice("vals", (low - F.col("i") + 1).cast("int"), (high - low).cast("int"))).alias("vals"),
    )


def _joined(cells: Column) -> Column:
    """The value of a cell from its pieces: one piece as it is, lines of a text field joined."""
    return F.when(F.size(cells) == 1, cells[0]["v"]).otherwise(F.array_join(F.transform(cells, lambda c: c["v"]), "\n"))


def _gathered(values: DataFrame, merge_free: bool) -> DataFrame:
    """Rows of uncut documents: ``(doc, category, spart, sseg, row, loop, tags, vals)``.

    Works within the partitions of the segment step, without another shuffle.  A group
    is one table row; with ``merge_free`` all free tags of a category are one group,
    and a repeated tag keeps its last value.
    """
    category = _category(F.col("tags")[0])
    apart = F.col("loop") if merge_free else F.lit(True)
    groups = (
        _by_row(values)
        .withColumn("category", category)
        .withColumn("gseg", F.when(apart, F.col("sseg")))
        .withColumn("grow", F.when(apart, F.col("row")))
        .groupBy(*_piece(values), "category", "loop", "gseg", "grow")
        .agg(
            F.array_sort(F.collect_list(F.struct(
                *PLACE, "i", "vals", "sseg", F.when(~apart, F.col("tags")[0]).alias("tag"),
            ))).alias("bits"),
            F.any_value(F.when(apart, F.col("tags"))).alias("header"),
            F.bool_or(F.col("kind") != "val").alias("text"),
        )
    )
    flat = F.flatten(F.transform("bits", lambda b: F.transform(b.vals, lambda v, k: F.struct(
        (b.i + k).alias("i"), b.sseg.alias("sseg"), v.alias("v"), b.tag.alias("tag")))))
    width = F.size("header")
    each = F.sequence(F.lit(0), width - 1)
    by_place = F.transform(each, lambda j: _joined(F.filter("flat", lambda c: c.i % width == j)))

    def latest(tag: Column) -> Column:
        here = F.filter("flat", lambda c: c.tag == tag)
        return _joined(F.filter(here, lambda c: c.sseg == F.element_at(here, -1)["sseg"]))

    seen = F.transform("bits", lambda b: b.tag)
    once = F.size(F.array_distinct(seen)) == F.size("bits")
    plain = ~F.col("text") & F.when(F.col("header").isNull(), once).otherwise(True)
    return groups.select(
        "doc", "category", "loop",
        F.lit(0).cast("long").alias("spart"), F.col("gseg").alias("sseg"), F.col("grow").alias("row"),
        F.coalesce("header", F.array_distinct(seen)).alias("tags"),
        "bits", "header", plain.alias("plain"), F.when(~plain, flat).alias("flat"),
    ).select(
        "doc", "category", "loop", "spart", "sseg", "row", "tags",
        F.when(F.col("plain") & (F.size("bits") == 1), F.col("bits")[0]["vals"])
        .when(F.col("plain"), F.flatten(F.transform("bits", lambda b: b.vals)))
        .when(F.col("header").isNotNull(), by_place)
        .otherwise(F.transform("tags", latest))
        .alias("vals"),
    )


def _gathered_over_parts(values: DataFrame) -> DataFrame:
    """Rows of cut documents, shuffled by row; same columns as for uncut ones."""
    width = F.size("tags")
    pieces = _by_row(values)
    aligned = (F.col("kind") == "val") & (F.size("vals") == width)
    category = _category(F.col("tags")[0]).alias("category")
    straight = pieces.filter(aligned).select("doc", category, "loop", "spart", "sseg", "row", "tags", "vals")
    # one group is one cell, so it is as large as one value
    bent = (
        pieces.filter(~aligned)
        .select("doc", "spart", "sseg", "loop", "tags", "row", "part", *PLACE, "i", F.posexplode("vals").alias("k", "v"))
        .groupBy(*_SEGMENT, "row", (F.col("i") + F.col("k")).alias("i"))
        .agg(
            F.any_value("loop").alias("loop"),
            F.any_value("tags").alias("tags"),
            F.array_sort(F.collect_list(F.struct("part", *PLACE, "v"))).alias("bits"),
        )
        .withColumn("v", _joined(F.col("bits")))
        # one group is one table row, so it is as wide as its loop header
        .groupBy(*_SEGMENT, "row")
        .agg(
            F.any_value("loop").alias("loop"),
            F.any_value("tags").alias("tags"),
            F.array_sort(F.collect_list(F.struct("i", "v"))).alias("cells"),
        )
        .select("doc", category, "loop", "spart", "sseg", "row", "tags", F.transform("cells", lambda c: c.v).alias("vals"))
    )
    return straight.unionByName(bent)


def _values(segs: DataFrame) -> DataFrame:
    return segs.filter(F.col("kind").isin(*VALUE_KINDS) & (F.size("tags") > 0))


def segment_rows(segs: DataFrame) -> DataFrame:
    """``(doc, category, loop, spart, sseg, row, tags, vals)``, ``vals`` in tag order; free tags apart."""
    values = _values(segs)
    return _gathered(values.filter("NOT is_cut"), False).unionByName(
        _gathered_over_parts(values.filter("is_cut"))
    )


def known_columns(tables=schema.LOADED) -> dict[str, tuple[str, ...]]:
    return {t: tuple(schema.CIF[t].names) for t in tables}


def _is_known(tag: Column, known: dict) -> Column:
    return tag.isin(*[f"{t}.{c}" for t, cols in known.items() for c in cols])


def category_rows(segs: DataFrame, known: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """``(doc, category, tags, vals)``: one row per table row, as two arrays side by side.

    Unknown categories are dropped.  Free tags of one category make one row in which
    a repeated tag keeps its last value.
    """
    known = known or known_columns()
    values = _values(segs).filter(_category(F.col("tags")[0]).isin(*known))
    shape = ["doc", "category", "tags", "vals"]
    rows = _gathered(values.filter("NOT is_cut"), True).select(*shape)
    for more in _large_rows(values.filter("is_cut"), known):
        rows = rows.unionByName(more.select(*shape))
    return rows


def _large_rows(values: DataFrame, known: dict) -> list[DataFrame]:
    """Loop rows and merged free tags of cut documents."""
    large = _gathered_over_parts(values)
    # free tags of a cut document: the last value of each, combined before the shuffle
    merged = (
        large.filter(~F.col("loop"))
        .select("doc", "category", F.struct("spart", "sseg").alias("at"), F.col("tags")[0].alias("tag"), F.col("vals")[0].alias("val"))
        .filter(_is_known(F.col("tag"), known))
        .groupBy("doc", "category", "tag")
        .agg(F.max_by(F.struct("val"), "at")["val"].alias("val"))
        .groupBy("doc", "category")
        .agg(F.collect_list(F.struct("tag", "val")).alias("cells"))
        .select("doc", "category", F.transform("cells", lambda c: c.tag).alias("tags"), F.transform("cells", lambda c: c.val).alias("vals"))
    )
    return [large.filter("loop"), merged]


def value_of(tag: str) -> Column:
    """The value a row of ``category_rows`` has for ``category.column``, NULL when it has none."""
    return F.get("vals", F.array_position("tags", tag).cast("int") - 1)


def table_text(rows: DataFrame, table: str, columns=None) -> DataFrame:
    """``(doc, columns...)`` of one category as text; columns a document lacks are NULL.

    Null tokens become NULL and component IDs upper case.
    """
    columns = columns or schema.CIF[table].names
    ids = {"comp_id"} | ({"id"} if table == "chem_comp" else set())
    out = []
    for c in columns:
        v = clean.null_token(value_of(f"{table}.{c}"))
        out.append((F.upper(v) if c in ids else v).alias(c))
    return rows.filter(F.col("category") == table).select("doc", *out)


def cells(segs: DataFrame, tags=None) -> DataFrame:
    """``(doc, spart, sseg, row, tag, val)``; with ``tags`` only segments that hold one of them."""
    if tags is not None:
        wanted = F.array(*[F.lit(t) for t in tags])
        segs = segs.filter(F.arrays_overlap("tags", wanted))
    out = segment_rows(segs).select(
        *_SEGMENT, "row", F.posexplode("vals").alias("j", "val"), "tags"
    ).select(*_SEGMENT, "row", F.get("tags", F.col("j")).alias("tag"), "val")
    return out if tags is None else out.filter(F.col("tag").isin(*tags))


# ----------------------------------------------------- document facts, rejects

# --- fixed values: the tags a header is made of -----------------------------
HEADER = {
    "initial": "chem_comp.pdbx_initial_date",
    "modified": "chem_comp.pdbx_modified_date",
    "replaced_by": "chem_comp.pdbx_replaced_by",
    "release_status": "chem_comp.pdbx_release_status",
    "subcomponents": "chem_comp.pdbx_subcomponent_list",
}
WITHDRAWN = ("OBS", "WDRN")


def _in_loop(tag: str) -> Column:
    """The last value a unit of a loop has for a tag."""
    width, size = F.size("tags"), F.size("vals")
    ahead = (F.array_position("tags", tag) - 1 - F.col("i") % width + width) % width
    at = ahead + F.floor((size - 1 - ahead) / width) * width
    return F.when(ahead < size, F.get("vals", at.cast("int")))


def _is_withdrawn(value: Column) -> Column:
    return F.coalesce(F.upper(value).isin(*WITHDRAWN), F.lit(False))


def document_facts(segs: DataFrame, known: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """One row per document, from one pass over its segments.

    ``(doc, block, has_atoms, initial, modified, replaced_by, release_status,
    subcomponents, reasons)``; the header values are raw text, ``reasons`` lists the
    parse errors.  With ``known`` a column unknown to its category is an error too.
    A repeated date keeps the last value; the other three count once they were set,
    so a later null does not undo them.  Every aggregate is combined before a shuffle
    and has a state of fixed size, but for the lines of one value.  Documents in one piece
    are aggregated in the partitions of the segment step.
    """
    return _facts(segs.filter("NOT is_cut"), known).unionByName(_facts_over_parts(segs.filter("is_cut"), known))


def _reasons(agg: dict[str, Column], known: dict[str, tuple[str, ...]] | None) -> Column:
    """Names of the parse errors a document has, from one aggregate each."""
    def reason(cond: Column, name: str) -> Column:
        return F.when(F.coalesce(cond, F.lit(False)), name)

    return F.array_compact(F.array(
        reason(agg["ragged"], "ragged"),
        reason(agg["broken"], "unclosed quote"),
        reason(agg["reserved"], "reserved word"),
        reason(agg["dotless"], "tag without category"),
        reason(agg["mixed"], "mixed loop"),
        reason(agg["repeated"], "repeated loop tag"),
        reason(agg["blocks"] == 0, "no data block"),
        reason(agg["blocks"] > 1, "second data block"),
        reason(agg["place"] < agg["block"]["place"], "text before data block"),
        *([] if known is None else [F.concat(F.lit("unknown column "), agg["unknown"])]),
    )).alias("reasons")


def _is_ragged(width: Column, n: Column, has_block: Column) -> Column:
    """The values of a segment do not fill the rows of its header."""
    return (
        F.when(has_block, n > 0)
        .when(F.col("loop"), (width == 0) | (n % F.greatest(width, F.lit(1)) != 0))
        .otherwise((width != 1) | (n != 1))
    )


def _of_tag(tag: str) -> Column:
    return F.filter("bits", lambda b: b.tag == tag)


def _facts(segs: DataFrame, known: dict[str, tuple[str, ...]] | None) -> DataFrame:
    """Facts of documents in one piece, by one aggregation per document.

    The window step has told what a segment is as a whole, so only a unit of each segment and those
    that bear a fact go into it: a document's group holds a few fixed values and its header values.
    """
    is_tag, is_data = F.col("kind") == "tag", F.col("kind") == "data"
    is_value = F.col("kind").isin(*VALUE_KINDS)
    first, width = F.get("tags", F.lit(0)), F.size("tags")
    name = F.when(is_tag, _tag(F.col("vals")[0]))

    def bit(tag: Column, v: Column) -> Column:
        return F.struct(F.col("sseg").alias("seg"), *PLACE, tag.alias("tag"), v.alias("v"), F.col("loop"))

    # the values of a free header tag; of a header column of a loop its last one
    own = ~F.col("loop") & first.isin(*HEADER.values())
    no_value = F.lit(None).cast("string")
    bits = (
        F.when(own & is_value, F.array(bit(first, F.col("vals")[0])))
        .when(own & F.col("head") & (F.col("seg_n") == 0), F.array(bit(first, no_value)))
        .when(
            F.col("loop") & is_value & first.startswith("chem_comp.") & (F.struct(*PLACE) == F.col("value_end"))
            & F.arrays_overlap("tags", F.array(*[F.lit(t) for t in HEADER.values()])),
            F.filter(F.array(*[F.when(F.array_contains("tags", t), bit(F.lit(t), _in_loop(t))) for t in HEADER.values()]), lambda b: b.isNotNull()),
        )
    )
    loop = F.col("head") & F.col("loop") & (F.col("seg_n") > 0)
    unknown = F.lit(False) if known is None else is_tag & _category(F.col("name")).isin(*known) & ~_is_known(F.col("name"), known)
    seen = segs.withColumn("name", name).select(
        "doc", *PLACE, "kind", "broken", "name", "head", bits.alias("bits"),
        F.when(is_data, F.upper(F.col("vals")[0])).alias("block"),
        (is_tag & ~F.col("vals")[0].contains(".")).alias("dotless"),
        (is_tag & F.col("name").startswith("chem_comp_atom.") & (F.col("seg_n") > 0)).alias("atoms"),
        F.when(F.col("head"), _is_ragged(width, F.col("seg_n"), F.col("seg_data"))).alias("ragged"),
        F.when(loop, F.size(F.array_distinct("tags")) < width).alias("repeated"),
        F.when(loop, F.size(F.array_distinct(F.transform("tags", _category))) > 1).alias("mixed"),
        unknown.alias("unknown"),
    ).filter("head OR block IS NOT NULL OR bits IS NOT NULL OR broken OR dotless OR atoms OR unknown OR kind = 'reserved'")
    place = F.struct(*PLACE)
    found = seen.groupBy("doc").agg(
        F.bool_or("ragged").alias("ragged"), F.bool_or("broken").alias("broken"),
        F.bool_or(F.col("kind") == "reserved").alias("reserved"), F.bool_or("dotless").alias("dotless"),
        F.bool_or("mixed").alias("mixed"), F.bool_or("repeated").alias("repeated"),
        F.bool_or("atoms").alias("has_atoms"),
        F.count("block").alias("blocks"),
        F.min(F.when(F.col("block").isNotNull(), F.struct(place.alias("place"), F.col("block").alias("name")))).alias("block"),
        F.min(place).alias("place"),
        F.array_sort(F.flatten(F.collect_list("bits"))).alias("bits"),
        *([] if known is None else [F.min(F.when(F.col("unknown"), F.col("name"))).alias("unknown")]),
    )
    found = found.select("*", *[_of_tag(t).alias(f"_{n}") for n, t in HEADER.items()])

    def value(of: str, seg: Column) -> Column:
        """The value a segment gives; rows of a loop's last place differ only where lines share a place."""
        here = F.filter(of, lambda b: b.seg == seg)
        text = F.array_join(F.transform(here, lambda b: b.v), "\n")
        several = F.when(F.element_at(here, -1)["loop"], F.element_at(here, -1)["v"]).otherwise(text)
        return clean.blank_to_null(F.when(F.size(here) == 1, here[0]["v"]).otherwise(several))

    def last(name: str) -> Column:
        of = f"_{name}"
        return F.when(F.size(of) > 0, value(of, F.element_at(of, -1)["seg"])).alias(name)

    def ever(name: str, mark=None) -> Column:
        of = f"_{name}"
        values = F.transform(F.array_distinct(F.transform(of, lambda b: b.seg)), lambda seg: value(of, seg))
        if mark is None:
            return F.array_max(values).alias(name)
        return F.array_max(F.transform(values, lambda v: F.struct(mark(v).alias("m"), v.alias("v"))))["v"].alias(name)

    agg = {c: F.col(c) for c in found.columns}
    return found.select(
        "doc", F.substr(F.col("block")["name"], F.lit(6)).alias("block"), "has_atoms",
        last("initial"), last("modified"),
        ever("replaced_by"), ever("release_status", _is_withdrawn), ever("subcomponents"),
        _reasons(agg, known),
    )


def _facts_over_parts(segs: DataFrame, known: dict[str, tuple[str, ...]] | None) -> DataFrame:
    """Facts of cut documents: per segment, then per document."""
    is_tag, is_data = F.col("kind") == "tag", F.col("kind") == "data"
    place = F.struct(*_piece(segs)[1:], *PLACE)
    opening = F.col("loop") & (F.col("i") == 0) & (F.col("n") > 0)
    headers = F.size("tags")
    is_value = F.col("kind").isin(*VALUE_KINDS)
    first = F.get("tags", F.lit(0))
    wanted = first.isin(*HEADER.values())
    free = ~F.col("loop") & is_value & wanted
    looped = F.col("loop") & is_value & first.startswith("chem_comp.")
    extra = [
        F.max(F.when(~F.col("loop") & wanted, first)).alias("tag"),
        F.array_sort(F.collect_list(F.when(free, F.struct(place.alias("place"), F.col("vals")[0].alias("v"))))).alias("bits"),
        *[
            F.max(F.when(looped & F.array_contains("tags", t), F.struct(place.alias("p"), _in_loop(t).alias("v")))).alias(f"in_{n}")
            for n, t in HEADER.items()
        ],
    ]
    if known is not None:
        name = _tag(F.col("vals")[0])
        extra.append(F.min(F.when(
            is_tag & _category(name).isin(*known) & ~_is_known(name, known), name
        )).alias("unknown"))
    per_segment = segs.groupBy(*_SEGMENT).agg(
        F.bool_or("loop").alias("loop"),
        F.max(headers).alias("width"),
        F.sum("n").alias("n"),
        F.bool_or(opening & (F.size(F.array_distinct("tags")) < headers)).alias("repeated"),
        F.bool_or(opening & (F.size(F.array_distinct(F.transform("tags", _category))) > 1)).alias("mixed"),
        F.bool_or(is_tag & _tag(F.col("vals")[0]).startswith("chem_comp_atom.")).alias("atoms"),
        F.bool_or(is_tag & ~F.col("vals")[0].contains(".")).alias("dotless"),
        F.bool_or("broken").alias("broken"),
        F.bool_or(F.col("kind") == "reserved").alias("reserved"),
        F.count(F.when(is_data, 1)).alias("blocks"),
        F.min(F.when(is_data, F.struct(place.alias("place"), F.upper(F.col("vals")[0]).alias("name")))).alias("block"),
        F.min(place).alias("place"),
        *extra,
    )
    ragged = _is_ragged(F.col("width"), F.col("n"), F.col("blocks") > 0)

    def header(name: str) -> Column:
        own = F.when(F.col("tag") == HEADER[name], F.struct(_joined(F.col("bits")).alias("v")))
        return F.coalesce(F.when(F.col(f"in_{name}").isNotNull(), F.struct(F.col(f"in_{name}.v").alias("v"))), own)

    def last(name: str) -> Column:
        at = F.when(header(name).isNotNull(), F.col("place"))
        return F.max_by(F.struct(clean.blank_to_null(header(name)["v"]).alias("v")), at)["v"].alias(name)

    def ever(name: str, mark=None) -> Column:
        value = clean.blank_to_null(header(name)["v"])
        if mark is None:
            return F.max(value).alias(name)
        return F.max(F.struct(mark(value).alias("m"), value.alias("v")))["v"].alias(name)

    return per_segment.groupBy("doc").agg(
        F.substr(F.min("block")["name"], F.lit(6)).alias("block"),
        F.bool_or(F.col("atoms") & (F.col("n") > 0)).alias("has_atoms"),
        last("initial"), last("modified"),
        ever("replaced_by"), ever("release_status", _is_withdrawn), ever("subcomponents"),
        _reasons({
            "ragged": F.bool_or(ragged), **{n: F.bool_or(n) for n in ("broken", "reserved", "dotless", "mixed", "repeated")},
            "blocks": F.sum("blocks"), "place": F.min("place"), "block": F.min("block"),
            **({} if known is None else {"unknown": F.min("unknown")}),
        }, known),
    )


def unclosed_text(lines: DataFrame) -> DataFrame:
    """``doc`` of documents that end inside a text field."""
    semi = F.col("line").startswith(";").cast("long")
    return lines.groupBy("doc").agg((F.sum(semi) % 2).alias("odd")).filter("odd = 1").select("doc")


def rejects(lines: DataFrame, segs: DataFrame) -> DataFrame:
    """``(doc, reason)`` of every document that does not parse."""
    return (
        document_facts(segs)
        .select("doc", F.explode("reasons").alias("reason"))
        .unionByName(unclosed_text(lines).withColumn("reason", F.lit("unclosed text field")))
    )


def unknown_columns(segs: DataFrame, known: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """``(doc, category, column)`` of columns a known category does not have."""
    known = known or known_columns()
    return (
        segs.filter("kind = 'tag'")
        .select("doc", _tag(F.col("vals")[0]).alias("tag"))
        .filter(_category(F.col("tag")).isin(*known) & ~_is_known(F.col("tag"), known))
        .select("doc", _category(F.col("tag")).alias("category"), F.split_part("tag", F.lit("."), F.lit(2)).alias("column"))
        .distinct()
    )


def key_mismatch(rows: DataFrame, doc_id: Column) -> DataFrame:
    """``(doc, expected, id)`` where the file stem is not the component ID in the text."""
    found = table_text(rows, "chem_comp", ["id"])
    return found.select("doc", doc_id.alias("expected"), "id").filter(~F.col("expected").eqNullSafe(F.col("id")))
