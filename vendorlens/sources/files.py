"""CSV sources and sinks."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .schemas import RAW_SCHEMAS, column_types
from .shared import entries
from .tables import save_table

# Texts that count as missing in a CSV field.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Quotes inside a quoted field are doubled, as CSV writers do by default.
# Blanks around a text belong to it; the writer would drop them otherwise.
# A row with more or fewer fields than the header fails the read instead of losing values.
CSV_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"', "mode": "FAILFAST",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def table_name_of(path: str) -> str:
    """``/data/sales.csv`` -> ``sales``."""
    return os.path.splitext(os.path.basename(path.rstrip("/")))[0]


def table_name_column(path_column: Column) -> Column:
    """The same rule on a column of paths (``input_file_name()`` of a scan over many files)."""
    return F.regexp_replace(F.element_at(F.split(path_column, "/"), -1), r"\.[^.]*$", "")


def read_landing(spark: SparkSession, path: str, lines_in_quotes: bool = False, **options: str) -> DataFrame:
    """Every column as text, named by the header line.

    With ``lines_in_quotes`` a quoted field may hold line breaks; a file is then read by one
    task. Without it files are split, and such a field fails the read as a short row.
    """
    several = {"multiLine": "true"} if lines_in_quotes else {}
    return spark.read.options(**{**CSV_OPTIONS, **several, **options}).csv(path)


# Types from narrow to wide, with a pattern for what their values look like; a column of none of them is text.
LATTICE = (
    ("boolean", r"(?i)^(true|false)$"),
    ("int", r"^[+-]?[0-9]{1,10}$"),
    ("bigint", r"^[+-]?[0-9]{1,18}$"),
    ("double", r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("timestamp", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?$"),
)


def inferred_types(texts: DataFrame) -> dict[str, str]:
    """The narrowest type of `LATTICE` that holds all values of each text column, in one pass over all parts.

    A task keeps, for each column and type, whether all its values fit; parts that disagree meet in the
    narrowest type above both. Missing marks fit every type; a column without values is text.
    """
    fits = []
    for place, name in enumerate(texts.columns):
        value = F.col(f"`{name}`")
        there = value.isNotNull() & ~value.isin(*MISSING)
        for kind, pattern in LATTICE:
            fit = value.rlike(pattern) & (value.try_cast(kind).isNotNull())
            fits.append(F.coalesce(F.min(F.when(there, F.coalesce(fit, F.lit(False)))), F.lit(False)).alias(f"{place}_{kind}"))
    found = texts.agg(*fits).first() if fits else {}
    return {
        name: next((kind for kind, _ in LATTICE if found[f"{place}_{kind}"]), "string") for place, name in enumerate(texts.columns)
    }


def read_inferred(spark: SparkSession, path: str, lines_in_quotes: bool = False) -> DataFrame:
    """A CSV file or folder of parts, typed by all its values: for discovery, as it reads the text twice."""
    texts = read_landing(spark, path, lines_in_quotes)
    return typed(texts, ", ".join(f"{name} {kind}" for name, kind in inferred_types(texts).items()))


def typed(df: DataFrame, ddl: str) -> DataFrame:
    """Text columns to the types of ``ddl``: missing marks become NULL, bad text raises.

    Columns outside ``ddl`` stay as text after the declared ones.
    """
    def value(name: str) -> Column:
        return F.when(~F.col(name).isin(*MISSING), F.col(name))

    kinds = column_types(ddl)
    extra = [c for c in df.columns if c not in kinds]
    return df.select(
        [value(c).cast(t).alias(c) for c, t in kinds.items()]
        + [value(c).alias(c) for c in extra]
    )


def read_table_file(spark: SparkSession, path: str, lines_in_quotes: bool = False) -> DataFrame:
    """A CSV file or folder as the raw table it is named after; unknown tables get inferred types."""
    ddl = RAW_SCHEMAS.get(table_name_of(path))
    if ddl is None:
        return read_inferred(spark, path, lines_in_quotes)
    return typed(read_landing(spark, path, lines_in_quotes), ddl)


def csv_tables(spark: SparkSession, directory: str) -> list[str]:
    """The ``*.csv`` files of a folder and its sub-folders (of part files), by table name.

    Works on any file system Spark reads; the list has an entry per table.
    """
    found = {}
    for path, folder, *_ in entries(spark, directory):
        base = path.rstrip("/").rsplit("/", 1)[-1]
        if (folder and not base.startswith((".", "_"))) or (not folder and base.endswith(".csv")):
            if table_name_of(path) in found:
                raise ValueError(f"two inputs for table {table_name_of(path)}")
            found[table_name_of(path)] = path
    return [found[name] for name in sorted(found)]


def ingest_directory(
    spark: SparkSession,
    directory: str,
    database: str,
    mode: str = "overwrite",
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    lines_in_quotes: bool = False,
) -> list[str]:
    """Load each CSV file, or folder of CSV parts, into the table named after it.

    ``overwrite`` makes a second run give the same tables; ``append`` adds to them.
    """
    names = []
    for path in csv_tables(spark, directory):
        name = table_name_of(path)
        rows = read_table_file(spark, path, lines_in_quotes)
        save_table(prepare(rows), f"{database}.{name}", mode, guard=rows)
        names.append(name)
    return names


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder of CSV part files with a header line each."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)
