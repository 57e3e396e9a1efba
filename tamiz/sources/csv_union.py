"""Union of many CSV files with the same header, with guards and row lineage.

Files are UTF-8 with or without a byte order mark. Every column is text, and
a blank field is "". Work is split by Spark's file splits: a huge file without
line breaks inside quotes is read by as many tasks as it has splits.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.text import all_blank
from tamiz.operators.profile import metric_rows

GLOB = "*.csv"
LINEAGE = ("archivo_origen", "fila_origen")
# The table of splits is broadcast up to this many rows (some 100 bytes each).
BROADCAST_SPLITS = 1_000_000


def _file_name() -> Column:
    """Name of the scanned file; the scan gives it percent-encoded."""
    return F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))


Paths = str | list[str]


def _files(spark: SparkSession, path: Paths, glob: str = GLOB) -> DataFrame:
    # Listing only: the content column is never read.
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(path)
        .select(F.col("_metadata.file_path").alias("path"), "length")
    )


def check_files(spark: SparkSession, path: str, expected: int | None = None) -> str:
    """File-count guard; returns the first file in name order."""
    files = _files(spark, path)
    # The driver's own listing; a scan passes over files of no bytes.
    listed = len(files.inputFiles())
    if expected is not None and listed != expected:
        raise ValueError(f"Se esperaban {expected} archivos CSV y se encontraron {listed}.")
    if listed == 0:
        raise FileNotFoundError(f"No hay archivos CSV en {path}.")
    found = files.agg(F.count("*").alias("n"), F.min("path").alias("first")).first()
    if found["n"] < listed:
        raise ValueError(f"{listed - found['n']} archivos no contienen encabezado.")
    return unquote(found["first"])


def _reader(spark: SparkSession, columns: list[str], multiline: bool, glob: str = GLOB):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("pathGlobFilter", glob)
        # Width is checked on whole records, whatever columns a query uses.
        .option("columnPruning", False)
    )


def read_header(spark: SparkSession, file: str) -> list[str]:
    return (
        spark.read.option("header", True).option("escape", '"').option("multiLine", True)
        .csv(file)
        .columns
    )


def _lines(spark: SparkSession, path: Paths, glob: str = GLOB) -> DataFrame:
    return (
        spark.read.option("pathGlobFilter", glob)
        .option("lineSep", "\n")
        .text(path)
        .select(
            "value",
            _file_name().alias("archivo"),
            F.col("_metadata.file_path").alias("ruta"),
            F.col("_metadata.file_block_start").alias("bloque"),
            F.monotonically_increasing_id().alias("posicion"),
        )
    )


def files_beyond_lines(spark: SparkSession, path: Paths, glob: str = GLOB) -> DataFrame:
    """Files that reading line by line could get wrong.

    If every line has an even number of quotes, every line starts outside
    quotes, so no record continues on the next line. A line of blanks is a
    record, and the reader of lines would skip it.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    skipped = ~F.col("value").isin("", "\r") & F.col("value").rlike("\\A[\\x00-\\x20]+\\z")
    return _lines(spark, path, glob).where((quotes % 2 == 1) | skipped).select("ruta").distinct()


def header_report(spark: SparkSession, path: str) -> DataFrame:
    """(archivo, columnas, esquema_consistente) per file, flag only.

    The first line of each file is found by a map-side minimum; headers with
    line breaks inside quotes are out of scope here.
    """
    lines = _lines(spark, path)
    first = (
        lines.where("bloque = 0")
        .groupBy("archivo", "ruta")
        .agg(F.min_by("value", "posicion").alias("linea"))
    )
    text = F.regexp_replace("linea", "\\A\ufeff|\r\\z", "")
    names = F.transform(
        F.regexp_extract_all(text, F.lit('(?:\\A|,)("(?:[^"]|"")*"|[^,]*)'), F.lit(1)),
        lambda n: F.when(
            n.startswith('"'),
            F.replace(F.substring(n, F.lit(2), F.length(n) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(n),
    )
    headers = first.select("archivo", "ruta", names.alias("columnas"))
    reference = headers.agg(F.min_by("columnas", "ruta").alias("c")).scalar()
    return headers.withColumn("esquema_consistente", F.col("columnas") == reference)


def number_records(df: DataFrame) -> DataFrame:
    """Adds file name and record number (first record = 2) to a file scan.

    ``monotonically_increasing_id`` counts within a task. Counting the records
    of each split turns that into a position in the file: position in the
    split plus the records of the splits before it. Only the small table of
    splits is shuffled and windowed, never the records, and a file of any size
    is numbered by all of its tasks.
    """
    columns = df.columns
    placed = df.select(
        *columns,
        _file_name().alias(LINEAGE[0]),
        F.col("_metadata.file_path").alias("_ruta"),
        F.col("_metadata.file_block_start").alias("_bloque"),
        F.monotonically_increasing_id().alias("_posicion"),
    )
    splits = placed.groupBy("_ruta", "_bloque").agg(
        F.min("_posicion").alias("_primera"), F.count("*").alias("_n")
    )
    before = Window.partitionBy("_ruta").orderBy("_bloque").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = splits.select(
        "_ruta",
        "_bloque",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 2 - F.col("_primera")).alias("_salto"),
    )
    # A partition holds at most one split's worth of bytes, so there are no more
    # splits than files and partitions together; both are known from the plan.
    # Beyond the limit the join shuffles by split, whose size is bounded too.
    if len(df.inputFiles()) + df.rdd.getNumPartitions() <= BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    numbered = placed.join(offsets, ["_ruta", "_bloque"])
    return numbered.select(
        *columns, LINEAGE[0], (F.col("_posicion") + F.col("_salto")).alias(LINEAGE[1])
    )


def _by_reading(spark: SparkSession, path: Paths, load, multiline: bool | None, glob: str) -> DataFrame:
    """`load(paths, whole)` of the files that are read by split and of those that are read whole."""
    if multiline is not None:
        return load(path, multiline)
    # File names only: the listing that the driver holds for any scan.
    # The path column of a scan is a URI, and a reader wants it decoded.
    whole = {unquote(r["ruta"]) for r in files_beyond_lines(spark, path, glob).collect()}
    if not whole:
        return load(path, False)
    plain = {unquote(r["path"]) for r in _files(spark, path, glob).collect()} - whole
    parts = [load(sorted(plain), False)] if plain else []
    return reduce(DataFrame.unionByName, [*parts, load(sorted(whole), True)])


def _load(
    spark: SparkSession,
    path: Paths,
    names: list[str],
    multiline: bool | None,
    lineage: bool,
    glob: str = GLOB,
) -> DataFrame:
    """Records of files with the given header; see `read_union`."""

    def load(target: Paths, whole: bool) -> DataFrame:
        reader = _reader(spark, names, whole, glob)
        reader = reader.option("enforceSchema", False).option("mode", "FAILFAST")
        frame = reader.csv(target).na.fill("")
        return number_records(frame) if lineage else frame

    return _by_reading(spark, path, load, multiline, glob)


def read_union(
    spark: SparkSession,
    path: Paths,
    columns: list[str] | None = None,
    expected_files: int | None = None,
    multiline: bool | None = None,
    lineage: bool = True,
) -> DataFrame:
    """All records of all files, unchanged, with their origin.

    Raises when the number of files differs, a file has no header, a header
    differs from the first one in names or order (letter case included when
    the session is case sensitive), or a record has another width.

    `multiline`: None finds out by looking at every line, one more pass over
    the bytes that True or False saves when the answer is known. Files whose
    every line is a record are read by split. Any other file is read by one
    task, whatever its size, since where a quote opens depends on all before
    it. Both ways give the same records.
    """
    first = check_files(spark, path, expected_files)
    names = columns or read_header(spark, first)
    return _load(spark, path, names, multiline, lineage)


def read_by_name(
    spark: SparkSession,
    path: str,
    multiline: bool | None = None,
    lineage: bool = True,
) -> DataFrame:
    """Union by column name; differing headers are allowed.

    Files with the same header are read together, as in `read_union`. A column
    that a file lacks is null in its records; a record that is wider or
    narrower than its header raises.
    """
    check_files(spark, path)
    groups = (
        header_report(spark, path)
        .groupBy("columnas")
        .agg(F.sort_array(F.collect_list("ruta")).alias("rutas"))
        .collect()
    )
    parts = [
        _load(spark, [unquote(r) for r in group["rutas"]], group["columnas"], multiline, lineage)
        for group in sorted(groups, key=lambda g: g["rutas"][0])
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def malformed_records(
    spark: SparkSession, path: str, columns: list[str], multiline: bool | None = None, glob: str = GLOB
) -> DataFrame:
    """Records wider or narrower than the header, with file name and the cells
    that could be read (S6, report). `multiline` as in `read_union`: files whose
    every line is a record are read by split."""
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in [*columns, "_corrupt_record"]]
    )

    def load(target: Paths, whole: bool) -> DataFrame:
        return (
            _reader(spark, columns, whole, glob)
            .schema(schema)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .csv(target)
            .select(_file_name().alias("archivo"), *columns, "_corrupt_record")
            .where(F.col("_corrupt_record").isNotNull())
        )

    return _by_reading(spark, path, load, multiline, glob)


def load_text(
    spark: SparkSession,
    path: str,
    required: list[str] | None = None,
    multiline: bool | None = None,
) -> DataFrame:
    """All-text loader; blanks stay "", texts such as NA stay literal.

    `path` is one file or one folder of part files with the same header.
    `required` columns that are absent raise ValueError, a missing path
    FileNotFoundError; a record of another width raises when it is read.
    """
    try:
        columns = read_header(spark, path)
    except AnalysisException as error:
        raise FileNotFoundError(f"No existe {path}.") from error
    absent = [c for c in required or [] if c not in columns]
    if absent:
        raise ValueError("Faltan variables requeridas: " + ", ".join(absent))
    return _load(spark, path, columns, multiline, False, glob="*")


def file_profile(df: DataFrame) -> DataFrame:
    """Records and source variables per file."""
    variables = len([c for c in df.columns if c not in LINEAGE])
    return (
        df.groupBy(F.col(LINEAGE[0]).alias("archivo"))
        .agg(F.count("*").alias("registros"))
        .withColumn("variables", F.lit(variables).cast("long"))
    )


def ingest_summary(df: DataFrame) -> DataFrame:
    """Files, variables, raw, informative and blank records."""
    source = [c for c in df.columns if c not in LINEAGE]
    blank = all_blank([F.col(c) for c in source])
    return metric_rows(
        df,
        [
            ("Archivos unidos", F.count_distinct(LINEAGE[0])),
            ("Variables originales", F.lit(len(source))),
            ("Columnas de trazabilidad", F.lit(len(LINEAGE))),
            ("Registros crudos generados", F.count("*")),
            ("Registros con información", F.count_if(~blank)),
            ("Filas completamente vacías conservadas", F.count_if(blank)),
        ],
        "metrica",
        "valor",
    )
