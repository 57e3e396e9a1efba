"""CSV union: guards, lineage, round trips, sinks."""

import csv
import io

import pytest
from pyspark.sql import functions as F

from tamiz import api
from tamiz.__main__ import main
from tamiz.plans import reports
from tamiz.sources import csv_union as U
from tamiz.sources.sinks import write_csv


def put(folder, name, text, bom=True):
    data = text.replace("\n", "\r\n") if "\r" not in text else text
    (folder / name).write_bytes((b"\xef\xbb\xbf" if bom else b"") + data.encode())


def listed(df):
    return sorted(tuple(r) for r in df.collect())


def test_good_files_with_blank_lines_commas_and_quoted_breaks(spark, tmp_path):
    put(tmp_path, "a.csv", 'X,Y\n01,NA\n\n,\n" p ","di""jo"\n')
    put(tmp_path, "b.csv", 'X,Y\r\n"uno\r\ndos",2\r\n3,\r\n', bom=False)
    df = U.read_union(spark, str(tmp_path), expected_files=2)
    got = [(x.replace("\r\n", "\n"), *rest) for x, *rest in listed(df)]
    assert got == [
        ("", "", "a.csv", 3),
        (" p ", 'di"jo', "a.csv", 4),
        ("01", "NA", "a.csv", 2),
        ("3", "", "b.csv", 3),
        ("uno\ndos", "2", "b.csv", 2),
    ]
    assert dict(df.dtypes)["fila_origen"] == "bigint"


def by_csv_module(folder):
    """Cells, file and record number as Python reads them; a line of no characters is no record."""
    rows = []
    for path in folder.glob("*.csv"):
        with path.open(encoding="utf-8-sig", newline="") as file:
            records = [r for r in csv.reader(file) if r]
        rows += [(*r, path.name, n) for n, r in enumerate(records[1:], 2)]
    return sorted(tuple(x.replace("\r\n", "\n") if isinstance(x, str) else x for x in r) for r in rows)


def broken_record(i):
    if i % 7 == 0:
        return f'"{i}","uno\n\ndos, ""x"" {i}\n"\n'
    return f'{i},""\n\n' if i % 5 == 0 else f'{i},"a, ""{i}"""\n'


@pytest.mark.parametrize("split_bytes", ["8", "300", "1000000"])
@pytest.mark.parametrize(
    "text",
    [
        "K,V\n" + "".join(broken_record(i) for i in range(200)),
        'X,Y\n1,5" pipe\n2,b\n3,c\n4,6" d\n5,e\n',
        'X,Y\n1,"5"" pipe"\n\n2,b\n , \n',
        "X\n1\n   \n2\n\n \t\n",
    ],
)
def test_records_equal_the_csv_module(spark, tmp_path, text, split_bytes):
    put(tmp_path, "a.csv", text)
    put(tmp_path, "b.csv", text.split("\n")[0] + "\n" + ",".join("12"[: text.split("\n")[0].count(",") + 1]) + "\n", bom=False)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        want = by_csv_module(tmp_path)
        for read in (U.read_union, U.read_by_name):
            got = [tuple(x.replace("\r\n", "\n") if isinstance(x, str) else x for x in r) for r in listed(read(spark, str(tmp_path)))]
            assert sorted(got) == want
        assert sorted(r[:-2] for r in want) == sorted(
            tuple(x.replace("\r\n", "\n") for x in r) for r in listed(U.load_text(spark, str(tmp_path)))
        )
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("second", ['Y,X\n"1\n",2\n', 'X,Y\n"1\n"\n', 'X,Y\n"1\n",2,3\n', "X,Y\n1,2\n   \n"])
def test_files_read_whole_are_checked_too(spark, tmp_path, second):
    put(tmp_path, "a.csv", "X,Y\n1,2\n")
    put(tmp_path, "b.csv", second)
    with pytest.raises(Exception, match="b.csv|CSV|Malformed|MALFORMED"):
        U.read_union(spark, str(tmp_path)).select("X").collect()


@pytest.mark.parametrize("text", ["X,Y\n1,2,3\n", "X,Y\n1\n"])
def test_no_loader_cuts_or_pads_records(spark, tmp_path, text):
    put(tmp_path, "a.csv", text)
    for read in (U.load_text, U.read_by_name):
        with pytest.raises(Exception, match="a.csv|CSV|Malformed|MALFORMED"):
            read(spark, str(tmp_path)).collect()


def test_file_names_with_spaces_and_accents(spark, tmp_path):
    put(tmp_path, "a ñ%20.csv", 'X,Y\n"1\n",2\n')
    put(tmp_path, "b c.csv", "X,Y\n3,4\n")
    got = listed(U.read_union(spark, str(tmp_path)))
    assert [r[2:] for r in got] == [("a ñ%20.csv", 2), ("b c.csv", 2)]
    assert U.read_by_name(spark, str(tmp_path)).count() == 2


def test_files_that_lines_get_wrong_are_found(spark, tmp_path):
    put(tmp_path, "a.csv", 'X,Y\n"1 ""a""",2\n\n')
    put(tmp_path, "b.csv", 'X,Y\n"1\n",2\n')
    put(tmp_path, "c.csv", "X,Y\n1,2\n  \n")
    found = [r.ruta for r in U.files_beyond_lines(spark, str(tmp_path)).collect()]
    assert sorted(x[-5:] for x in found) == ["b.csv", "c.csv"]


def test_header_only_file_gives_no_rows(spark, tmp_path):
    put(tmp_path, "a.csv", "X,Y\n")
    put(tmp_path, "b.csv", "X,Y\n1,2\n")
    assert listed(U.read_union(spark, str(tmp_path))) == [("1", "2", "b.csv", 2)]


@pytest.mark.parametrize("second", ["Y,X\n1,2\n", "X,Z\n1,2\n", "X,Y\n1\n", "X,Y\n1,2,3\n"])
def test_other_header_or_width_raises(spark, tmp_path, second):
    put(tmp_path, "a.csv", "X,Y\n1,2\n")
    put(tmp_path, "b.csv", second)
    with pytest.raises(Exception, match="b.csv|CSV|Malformed"):
        # Also when the query needs one column only.
        U.read_union(spark, str(tmp_path)).select("X").collect()


def test_file_count_and_missing_header_raise(spark, tmp_path):
    put(tmp_path, "a.csv", "X,Y\n1,2\n")
    with pytest.raises(ValueError, match="23"):
        U.read_union(spark, str(tmp_path), expected_files=23)
    (tmp_path / "b.csv").write_bytes(b"")
    with pytest.raises(ValueError, match="encabezado"):
        U.read_union(spark, str(tmp_path))


def test_record_numbers_over_many_splits(spark, tmp_path):
    names = {"x.csv": 5000, "y.csv": 3000}
    for name, n in names.items():
        put(tmp_path, name, "K,V\n" + "".join(f"{i},{'v' * (i % 40)}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = U.read_union(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 4
        wrong = df.where(F.col("fila_origen") != F.col("K").cast("long") + 2)
        assert wrong.count() == 0 and df.count() == sum(names.values())
        assert df.where("archivo_origen = 'y.csv' AND K = '2999'").first().fila_origen == 3001
        assert df.select("archivo_origen", "fila_origen").distinct().count() == 8000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_union_by_name_and_header_report(spark, tmp_path):
    put(tmp_path, "a.csv", 'X,"Y, z"\n1,2\n')
    put(tmp_path, "b.csv", '"Y, z",X,W\n3,4,5\n')
    report = {r.archivo: (r.columnas, r.esquema_consistente)
              for r in U.header_report(spark, str(tmp_path)).collect()}
    assert report == {"a.csv": (["X", "Y, z"], True), "b.csv": (["Y, z", "X", "W"], False)}
    df = U.read_by_name(spark, str(tmp_path)).select("X", "`Y, z`", "W", "archivo_origen", "fila_origen")
    assert sorted(map(tuple, df.collect())) == [
        ("1", "2", None, "a.csv", 2), ("4", "3", "5", "b.csv", 2),
    ]


def test_malformed_records_are_reported(spark, tmp_path):
    put(tmp_path, "a.csv", "X,Y\n1,2\n3\n4,5,6\n")
    got = U.malformed_records(spark, str(tmp_path), ["X", "Y"]).collect()
    assert sorted(r._corrupt_record.strip() for r in got) == ["3", "4,5,6"]


def test_loader_checks(spark, tmp_path):
    put(tmp_path, "a.csv", "X,Y\n007,\n")
    assert listed(U.load_text(spark, str(tmp_path / "a.csv"), ["X"])) == [("007", "")]
    with pytest.raises(ValueError, match="Z"):
        U.load_text(spark, str(tmp_path / "a.csv"), ["X", "Z"])
    put(tmp_path, "datos.txt", 'X,Y\n"1\n2",3\n')
    got = U.load_text(spark, str(tmp_path / "datos.txt"))
    assert [(r.X.replace("\r", ""), r.Y) for r in got.collect()] == [("1\n2", "3")]
    with pytest.raises(FileNotFoundError):
        U.load_text(spark, str(tmp_path / "none.csv"))


def test_csv_sink_round_trip(spark, tmp_path):
    data = [('a "b", c', "", ["1", "2"]), ("x\ny", " z ", []), ("", "NA", ["3"])]
    df = spark.createDataFrame(data, "X string, Y string, L array<string>")
    write_csv(df, str(tmp_path / "out"), single=True)
    part = next((tmp_path / "out").glob("part-*.csv"))
    raw = part.read_bytes()
    assert raw.startswith(b"\xef\xbb\xbfX,Y,L")
    back = list(csv.reader(io.StringIO(raw.decode("utf-8-sig"), newline="")))
    assert sorted(back[1:]) == sorted([['a "b", c', "", "1 | 2"], ["x\ny", " z ", ""], ["", "NA", "3"]])
    again = U.load_text(spark, str(tmp_path / "out"))
    assert listed(again) == sorted(tuple(r) for r in back[1:])


def test_report_bundle(spark, messy, tmp_path):
    target = tmp_path / "reports" / "nuevo"
    written = reports.generar_reportes(messy, str(target))
    assert len(written) == 7
    for path in written:
        table = U.load_text(spark, path)
        assert table.count() > 0 and not table.columns[0].startswith("﻿")


def test_ingest_summary(spark, tmp_path):
    put(tmp_path, "a.csv", "X,Y\n1,2\n , \n")
    put(tmp_path, "b.csv", "X,Y\n,\n")
    df = U.read_union(spark, str(tmp_path))
    got = {r.metrica: r.valor for r in U.ingest_summary(df).collect()}
    assert got["Archivos unidos"] == 2 and got["Filas completamente vacías conservadas"] == 2
    assert listed(U.file_profile(df)) == [("a.csv", 2, 2), ("b.csv", 1, 2)]


def test_jobs_from_raw_files_to_reports(spark, messy, tmp_path, capsys):
    raw = tmp_path / "raw"
    write_csv(messy.drop(*U.LINEAGE).coalesce(2), str(raw))
    main(["union", str(raw), str(tmp_path / "out"), "--files", "2"])
    assert f"Registros crudos generados: {messy.count():,}" in capsys.readouterr().out
    union = api.cargar_datos(spark, str(tmp_path / "out"))
    assert union.drop(*U.LINEAGE).exceptAll(messy.drop(*U.LINEAGE)).count() == 0
    assert union.select(*U.LINEAGE).distinct().count() == messy.count()
    main(["reports", str(tmp_path / "out"), str(tmp_path / "reports")])
    assert len(capsys.readouterr().out.split()) == 7
    with pytest.raises(ValueError, match="requeridas"):
        api.cargar_datos(spark, str(tmp_path / "reports" / "diagnostico_codigo"))
