"""Publishing the STAR side: table dumps and saveframe text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from compdict.functions import clean


def public_dump(df: DataFrame, path: str, key: str, columns=None, buckets: int = 64, fmt: str = "parquet") -> None:
    """Write the public columns of a table, one folder per key bucket.

    The rebalance hint sizes the files and splits the bucket of a hot key.
    """
    columns = columns or df.columns
    bucketed = df.select(*columns).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    writer = bucketed.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def _lines(df: DataFrame, comp: str, section: int, ordinal, lines) -> DataFrame:
    """Rows ``(comp_id, section, ordinal, sub, line)`` from an array of lines per input row."""
    return df.select(
        F.col(comp).alias("comp_id"), F.lit(section).alias("section"), ordinal.cast("long").alias("ordinal"),
        F.posexplode(lines).alias("sub", "line"),
    )


def saveframe_lines(
    parents: DataFrame,
    key: str,
    framecode: str,
    prefix: str,
    loops: dict[str, tuple[DataFrame, str, str]] | None = None,
    tags: list[str] | None = None,
) -> DataFrame:
    """Saveframe text, a line per row: ``(comp_id, section, ordinal, sub, line)``.

    The four first columns order the lines.  ``loops`` maps a loop's tag prefix to
    ``(child table, component column, ordinal column)``.  A component is never gathered
    into one value, so its number of child rows does not matter.
    """
    tags = tags or parents.columns
    head = F.array(
        F.concat(F.lit("save_"), F.col(framecode)),
        *[F.concat(F.lit(f"   _{prefix}.{t}  "), clean.star_value(t)) for t in tags],
    )
    out = _lines(parents.filter(F.col(framecode).isNotNull()), key, 0, F.lit(0), head)
    section = 0
    for name, (child, comp, ordinal) in (loops or {}).items():
        section += 1
        cols = [c for c in child.columns if c != comp]
        start = F.array(F.lit("   loop_"), *[F.lit(f"      _{name}.{c}") for c in cols])
        row = F.array(F.concat(F.lit("     "), F.concat_ws(" ", *[clean.star_value(c) for c in cols])))
        have = child.select(F.col(comp).alias("_c")).distinct()
        out = (
            out.unionByName(_lines(have, "_c", section * 3 - 2, F.lit(0), start))
            .unionByName(_lines(child, comp, section * 3 - 1, F.col(ordinal), row))
            .unionByName(_lines(have, "_c", section * 3, F.lit(0), F.array(F.lit("   stop_"))))
        )
    end = _lines(parents.filter(F.col(framecode).isNotNull()), key, section * 3 + 1, F.lit(0), F.array(F.lit("save_")))
    return out.unionByName(end)


def write_saveframes(lines: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write saveframe text; the files, in name order, hold the components in key order."""
    n = partitions or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["comp_id", "section", "ordinal", "sub", "line"]
    lines.repartitionByRange(n, *order).sortWithinPartitions(*order).select("line").write.mode("overwrite").text(path)
