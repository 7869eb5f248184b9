"""Raw CSV source: files directly under one prefix, one header row each.

Spark's CSV reader takes the header of one file and maps every other file
by position, so a file with reordered or extra columns would silently swap
values. This reader instead:

1. lists ``<prefix>/*.csv`` through Spark's file index (``binaryFile`` with
   the ``content`` column pruned, so no file body is read);
2. reads only the first line of each file on the executors
   (``mapInPandas`` with ``pyarrow.fs``, a few KiB per file);
3. groups files by identical header and reads each group with an explicit
   all-string schema (no ``inferSchema`` pass, no type drift between runs:
   numbers are typed later by role);
4. normalises each group's names, notes which of them play the roles
   (``header_roles``) and unions the groups by name.

Only the distinct headers and the file list (which the driver's file index
holds anyway) reach the driver; rows never do.
"""

from __future__ import annotations

import csv
import json
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierlake.functions.columns import header_roles, unique_normalized_names

# The header reader runs in Python workers; ship its few helpers by value so
# tasks do not depend on this package being installed on every executor.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE_COLUMN = "source_file_name"
ROLES_COLUMN = "header_roles"  # JSON: which column of the row's own header plays which role
_HEAD_BYTES = 64 * 1024


def csv_glob(raw_uri: str) -> str:
    return raw_uri.rstrip("/") + "/*.csv"


def _arrow_path(uri: str) -> str:
    if uri.startswith("s3a://") or uri.startswith("s3n://"):
        return "s3://" + uri[6:]
    return uri


def read_first_line(uri: str) -> str:
    """First line of a file that is not blank, as Spark's reader takes it (UTF-8, BOM and line break
    removed); empty for a file without one."""
    from pyarrow import fs as pafs

    filesystem, path = pafs.FileSystem.from_uri(_arrow_path(uri))
    buf = b""
    with filesystem.open_input_stream(path) as stream:
        while True:
            chunk = stream.read(_HEAD_BYTES)
            buf += chunk
            lines = buf.removeprefix(b"\xef\xbb\xbf").split(b"\n")
            whole = lines if not chunk else lines[:-1]
            for line in whole:
                if line.strip():
                    return line.rstrip(b"\r").decode("utf-8", errors="replace")
            if not chunk:
                return ""
            buf = lines[-1]


def _first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"path": pdf["path"], "header": [read_first_line(p) for p in pdf["path"]]})


def file_headers(spark: SparkSession, raw_uri: str) -> DataFrame:
    """``path, header`` for every ``*.csv`` directly under ``raw_uri``."""
    files = spark.read.format("binaryFile").load(csv_glob(raw_uri)).select("path")
    return files.mapInPandas(_first_lines, "path string, header string")


def parse_header(line: str, sep: str = ",") -> list[str]:
    return next(csv.reader([line], delimiter=sep)) if line else []


def read_raw_csv(spark: SparkSession, raw_uri: str, sep: str = ",") -> DataFrame:
    """All raw files as one all-string DataFrame with normalised column names
    and ``source_file_name`` (full file URI)."""
    # (path, header) per file: the same list the driver's file index holds to
    # plan any scan of these files; grouped here, not in one task.
    by_header: dict[str, list[str]] = {}
    for r in file_headers(spark, raw_uri).collect():
        by_header.setdefault(r["header"], []).append(r["path"])
    groups = sorted(((h, sorted(p)) for h, p in by_header.items()), key=lambda g: g[1][0])
    parts: list[DataFrame] = []
    for header, paths in groups:
        names = parse_header(header, sep)
        if not names:  # empty and blank files have no row to lose
            continue
        schema = StructType([StructField(f"_c{i}", StringType()) for i in range(len(names))])
        df = (
            spark.read.schema(schema)
            .option("header", True)
            .option("sep", sep)
            .option("mode", "PERMISSIVE")
            .csv(paths)
        )
        normalized = unique_normalized_names(names)
        cols = [F.col(f"_c{i}").alias(n) for i, n in enumerate(normalized) if n != FILE_COLUMN]
        roles = json.dumps(header_roles([n for n in normalized if n != FILE_COLUMN]))
        parts.append(df.select(*(c for c, n in zip(cols, (n for n in normalized if n != FILE_COLUMN)) if n != ROLES_COLUMN),
                               F.lit(roles).alias(ROLES_COLUMN), F.col("_metadata.file_path").alias(FILE_COLUMN)))
    if not parts:
        raise ValueError(f"{csv_glob(raw_uri)} has no file with a header line")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
