"""Two jobs for spark-submit or `python -m tamiz`.

    union RAW OUT [--files N]   union the CSV files of RAW into OUT
    reports DATA OUT            write the geographic reports of DATA below OUT
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tamiz import api
from tamiz.sources.csv_union import ingest_summary
from tamiz.sources.sinks import write_csv


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tamiz", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    union = jobs.add_parser("union")
    union.add_argument("raw")
    union.add_argument("out")
    union.add_argument("--files", type=int)
    reports = jobs.add_parser("reports")
    reports.add_argument("data")
    reports.add_argument("out")
    args = parser.parse_args(arguments)

    spark = SparkSession.builder.appName(f"tamiz {args.job}").getOrCreate()
    if args.job == "union":
        data = api.unir_csv(spark, args.raw, args.files)
        write_csv(data, args.out)
        for row in ingest_summary(data).collect():
            print(f"{row.metrica}: {row.valor:,}")
    else:
        for path in api.generar_reportes(api.cargar_datos(spark, args.data), args.out):
            print(path)


if __name__ == "__main__":
    main()
