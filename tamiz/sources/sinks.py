"""CSV sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM = "\ufeff"


def flat(df: DataFrame) -> DataFrame:
    """CSV has no lists: array columns become text joined by " | "."""
    return df.select(
        *[
            F.array_join(f.name, " | ").alias(f.name)
            if isinstance(f.dataType, T.ArrayType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def write_csv(
    df: DataFrame, path: str, bom: bool = True, single: bool = False, mode: str = "errorifexists",
    folders: tuple[str, ...] = (),
) -> None:
    """Header, no index, quotes doubled, blanks written as empty fields.

    Every part file starts with a byte order mark. `single` gathers the rows
    in one task and is meant for reports, whose size does not follow the data.
    `folders` names columns by whose values the files are put in folders.
    """
    out = flat(df)
    if bom:
        out = out.withColumnRenamed(out.columns[0], BOM + out.columns[0])
    if single:
        out = out.coalesce(1)
    (
        out.write.mode(mode)
        .partitionBy(*folders)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
