"""Discovery of input files and selection rules, as filters over path tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import base_name, suffix


def read_files(spark: SparkSession, path: str, glob: str = "*.docx", recursive: bool = False) -> DataFrame:
    """Binary files under a folder: path, modificationTime, length, content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(path)


def is_source_document(path: Column) -> Column:
    """A .docx file that is no output of a run and no lock file."""
    name = base_name(path)
    return (suffix(path) == ".docx") & ~name.endswith(".filtered.docx") & ~name.startswith("~$")


def is_concat_input(path: Column) -> Column:
    return suffix(path).isin(".docx", ".doc")


def first_of_each(paths: DataFrame, path: str = "path", order: str = "ord") -> DataFrame:
    """Distinct paths in the order of their first occurrence."""
    return paths.groupBy(path).agg(F.min(order).alias(order)).orderBy(order)


def read_audits(spark: SparkSession, path: str) -> DataFrame:
    """Audit reports, one JSON document a file, without the combined one."""
    return spark.read.option("multiLine", "true").option("pathGlobFilter", "*.audit.json").json(path).where(~F.input_file_name().contains("combined"))


def write_report(report: DataFrame, path: str, overwrite: bool = False) -> None:
    """One JSON object per line; refuses to replace what is there unless told to."""
    report.write.mode("overwrite" if overwrite else "errorifexists").json(path)


def report_markdown(counts: DataFrame, title: str, order: str) -> DataFrame:
    """One row (text): a table of the columns of ``counts``, which is a roll-up of few rows, in Markdown."""
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in counts.columns)), F.lit(" |"))
    head = f"# {title}\n\n| {' | '.join(counts.columns)} |\n|{'---|' * len(counts.columns)}\n"
    lines = counts.agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), cells.alias("line")))).alias("l"))
    return lines.select(F.concat(F.lit(head), F.array_join(F.transform("l", lambda x: x["line"]), "\n"), F.lit("\n")).alias("text"))
