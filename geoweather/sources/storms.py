"""Storm-event detail files: CSV with header, quoted narratives spanning lines.

Columns are taken by header name, all as strings (no type sniffing); typing and
row rejection happen in ``operators.storms``.  ``multiLine`` plus ``escape='"'``
are both required for quoted newlines and doubled quotes inside narratives.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweather.functions.files import storm_file_year
from geoweather.schemas import STORM_EVENTS
from geoweather.sources.listing import STORM_GLOB, first_lines, list_files, plain_path, readable_paths


CORRUPT = "_corrupt_record"


def csv_options() -> dict[str, str]:
    return {"header": "true", "multiLine": "true", "escape": '"', "inferSchema": "false", "mode": "PERMISSIVE"}


def header_groups(spark: SparkSession, paths) -> dict[tuple[str, ...], list[str]]:
    """Files by their header: column names in order -> paths, found in one job over all files.

    A file without a line has no rows and is in no group; if it has none because it is damaged, that is an error.
    """
    paths = list(paths)
    groups: dict[tuple[str, ...], list[str]] = {}
    if paths:
        found = sorted(first_lines(spark, paths).collect())  # one row a file
        seen = {plain_path(r.path) for r in found}
        silent = [p for p in paths if plain_path(p) not in seen]
        if silent and (bad := readable_paths(spark, silent)[1]):
            raise OSError(f"FAILED_READ_FILE: {', '.join(bad)}")
        for r in found:
            names = next(csv.reader([r.line.lstrip("\ufeff")]), [])
            groups.setdefault(tuple(n.strip() for n in names), []).append(r.path)
    return groups


def read_storm_files(spark: SparkSession, paths) -> DataFrame:
    """All-string staging rows plus ``_corrupt_record``, ``source_file`` and its ``file_year``.

    Each group of files with the same header is read by its own column names, so files may
    order or omit columns.  A row with too few or too many fields keeps its text in
    ``_corrupt_record`` (null for good rows).  ``paths`` is a list of files, or a folder of them.
    """
    if isinstance(paths, str):
        paths = [r.path for r in list_files(spark, paths, STORM_GLOB).collect()]
    known = [f.name for f in STORM_EVENTS.fields]
    name = F.col("_metadata.file_name")
    parts = []
    for header, files in (header_groups(spark, paths) or {tuple(known): []}).items():
        schema = ", ".join(f"`{c}` STRING" for c in (*header, CORRUPT))
        if not files:
            parts.append(spark.createDataFrame([], schema + ", source_file STRING, file_year INT"))
            continue
        rows = spark.read.schema(schema).options(**csv_options()).option("columnNameOfCorruptRecord", CORRUPT).csv(files)
        parts.append(rows.select(*[F.col(c) for c in header if c in known], CORRUPT, name.alias("source_file"), storm_file_year(name).alias("file_year")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
