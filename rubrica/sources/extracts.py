"""Scan of report extracts: many files, one DataFrame, all text.

An extract is one CSV or parquet file (``layout="file"``, the report name is the
file name) or, where a report is too large for one file, a folder
``source_file=<report name>/`` of part files (``layout="folder"``).
"""

from __future__ import annotations

import csv
import io
import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException as SparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import cast_metrics, tidy_text
from ..functions.text import clean_names
from ..functions.types import widest_schema
from ..operators.columns import name_range
from ..schema import CLASSIFIER, METRICS, MONEY, REQUIRED_COLUMNS, ROW_ORDER, SOURCE_FILE, UNIT_KEY
from .sinks import written

REJECT_SCHEMA = "source_file string, path string, missing array<string>"
#: Holds a CSV line whose cells do not fit the header.
MALFORMED = "__malformed"
#: Bytes in which the header of a CSV file has to end.
HEADER_BYTES = 1 << 20


@dataclass(frozen=True)
class Extracts:
    """Rows of all usable files, one line per file that cannot be used, usable reports, and metrics.

    ``metrics`` are the columns that stand between the first and the last known metric
    in any header, both included, less ``*percent``: the known ones first, in their order.
    """

    rows: DataFrame
    rejects: DataFrame
    reports: tuple[str, ...]
    metrics: tuple[str, ...] = METRICS


def file_pattern(extension: str) -> str:
    """Glob for an extension in any case: ``csv`` -> ``*.[cC][sS][vV]``."""
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension)


def literal_path(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def list_files(spark: SparkSession, path: str, extension: str, layout: str = "file") -> list[str]:
    """Paths of the files with this extension directly under ``path``, or in its report folders.

    Only the listing is read, no content, and files of zero bytes are in it.  It
    holds one entry per file, as the file index of the scan itself does.  The glob
    names the files themselves, so other subfolders are not entered, whatever they are called.
    """
    below = file_pattern(extension) if layout == "file" else f"{SOURCE_FILE}=*/{file_pattern(extension)}"
    try:
        files = spark.read.format("binaryFile").load(f"{literal_path(path.rstrip('/'))}/{below}").inputFiles()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(unquote(f) for f in files)


def read_extracts(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    *,
    layout: str = "file",
    sep: str = ",",
    infer_types: bool = False,
    required=REQUIRED_COLUMNS,
    multi_line: bool = False,
    malformed: str = "reject",
    header_threads: int = 16,
) -> Extracts:
    """Read every extract under ``path`` with clean names and without ``*percent``.

    Files are grouped by header, one scan per distinct header, and put together
    by name; a column that a file lacks is NULL.  A file without a required
    column, an empty one, or one that cannot be read lands in ``rejects`` with the
    reason, its report is left out as a whole, and the other reports go on.

    ``infer_types`` keeps types instead of text: those that Spark finds per group of
    files, widened per column until all groups fit, to text if need be.  Cells of a
    column that ends up as text are read as they stand.

    A CSV line whose cells do not fit the header, as when a cell holds a line
    break, never becomes a row.  With ``malformed="reject"`` the files are read once, into
    the scratch folder, where such lines are marked; the reports that hold one are left out, and
    ``rows`` reads that copy.  ``"raise"`` makes no copy and fails when the line is read.
    ``multi_line=True`` reads cells and header cells with line breaks, one task per file.

    A CSV header is the first line of its file, read through the file system by
    ``header_threads`` threads, as parquet footers are; the bytes behind it stay unread.
    ``row_order`` is the place of a row in its file.  Parquet numbers its rows.  In CSV it is the start of
    the split and the running number within the split: one task reads one split
    from front to back, so the pair follows the file however many splits there are.
    """
    if layout not in ("file", "folder"):
        raise ValueError("layout must be 'file' or 'folder'")
    if malformed not in ("reject", "raise"):
        raise ValueError("malformed must be 'reject' or 'raise'")
    files = list_files(spark, path, fmt, layout)
    header_of = partial(_csv_header, spark, sep=sep, multi_line=multi_line) if fmt == "csv" else partial(_parquet_header, spark)
    with ThreadPoolExecutor(header_threads) as pool:
        headers = dict(zip(files, pool.map(header_of, files)))

    reasons, groups = {}, defaultdict(list)
    for file in files:
        header = headers[file]
        known = set(clean_names([n for n, _ in header])) if isinstance(header, list) else ()
        missing = [c for c in required if c not in known] if isinstance(header, list) else [header]
        if missing:
            reasons[file] = missing
        else:
            groups[tuple(header)].append(file)

    # Half a report has wrong totals: one bad part rejects the others.
    spoilt = {_report_name(f, layout) for f in reasons}
    kept = {h: [f for f in members if _report_name(f, layout) not in spoilt] for h, members in groups.items()}
    kept = {h: members for h, members in kept.items() if members}
    names = {h: clean_names([n for n, _ in h]) for h in kept}
    metrics = _metrics(names.values())
    if not kept:
        empty = ", ".join(f"{c} string" for c in (*UNIT_KEY, CLASSIFIER, *metrics))
        empty = f"{SOURCE_FILE} string, {ROW_ORDER} struct<part: string, block: long, seq: long>, {empty}"
        return Extracts(spark.createDataFrame([], empty), _rejects(spark, reasons, layout), (), metrics)

    scan = partial(_scan, spark, path, fmt=fmt, layout=layout, sep=sep, multi_line=multi_line)
    kinds = dict.fromkeys(kept)
    if infer_types:
        found = [_inferred(spark, h, kept[h], names[h], fmt=fmt, sep=sep, multi_line=multi_line) for h in kept]
        widest = widest_schema(found)
        kinds = {h: [widest[n] for n in names[h]] for h in kept}
    parts = [_cells(scan(kept[h], names[h], kinds[h]), names[h], kinds[h], fmt, layout, malformed) for h in kept]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if fmt == "csv" and malformed == "reject":
        rows = written(rows, "extracts")
        found = rows.where(F.col(MALFORMED).isNotNull()).select(SOURCE_FILE, MALFORMED).distinct().collect()
        bad = spark.createDataFrame({(r[SOURCE_FILE],) for r in found}, f"{SOURCE_FILE} string")
        reasons |= {unquote(r[MALFORMED]): ["malformed line"] for r in found}
        # No more names than files, and the listing of those is here already.
        rows = (rows.join(F.broadcast(bad), SOURCE_FILE, "left_anti") if found else rows).drop(MALFORMED)
    spoilt = {_report_name(f, layout) for f in reasons}
    reports = {_report_name(f, layout) for members in kept.values() for f in members} - spoilt
    return Extracts(rows, _rejects(spark, reasons, layout), tuple(sorted(reports)), metrics)


def _rejects(spark, reasons, layout) -> DataFrame:
    return spark.createDataFrame([(_report_name(f, layout), f, r) for f, r in reasons.items()], REJECT_SCHEMA)


def _metrics(headers) -> tuple[str, ...]:
    """The columns in the metric range of any header."""
    held = {}
    for names in headers:
        whole = METRICS[0] in names and METRICS[-1] in names
        held |= dict.fromkeys(name_range(names, METRICS[0], METRICS[-1]) if whole else [m for m in METRICS if m in names])
    others = (SOURCE_FILE, CLASSIFIER, *UNIT_KEY, *METRICS)
    return (*METRICS, *[n for n in held if n not in others and not n.endswith("percent")])


def _parquet_header(spark, file) -> list[tuple[str, str]] | str:
    """Names and types of the columns of a file, or why it cannot be read."""
    try:
        return spark.read.parquet(literal_path(file)).dtypes
    except (AnalysisException, Py4JJavaError, SparkException) as e:
        return f"unreadable: {type(e).__name__}"


def _csv_header(spark, file, *, sep, multi_line) -> list[tuple[str, str]] | str:
    """The header cells of a file, all of them text, or why there are none."""
    try:
        text = _first_record(spark, file, multi_line)
    except Py4JJavaError as e:
        return f"unreadable: {type(e).__name__}"
    if text is None:
        return "empty file"
    if text.count('"') % 2:
        return "header of several lines"
    return [(name, "string") for name in next(csv.reader(io.StringIO(text.lstrip("\ufeff"), newline=""), delimiter=sep), [])]


def _first_record(spark, file, multi_line) -> str | None:
    """The first line, with ``multi_line`` as many as its quotes need; None without one."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).open(path)
    try:
        head = jvm.org.apache.commons.io.input.BoundedInputStream(stream, HEADER_BYTES)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(head, "UTF-8"))
        text = line = reader.readLine()
        while multi_line and line is not None and text.count('"') % 2:
            line = reader.readLine()
            text += "" if line is None else "\n" + line
        return text
    finally:
        stream.close()


def _report_name(file: str, layout: str) -> str:
    parts = file.split("/")
    return parts[-1] if layout == "file" else unquote(parts[-2].removeprefix(f"{SOURCE_FILE}="))


def _csv_options(sep, multi_line) -> dict:
    return {"header": True, "sep": sep, "escape": '"', "enforceSchema": True, "multiLine": multi_line}


def _inferred(spark, header, files, names, *, fmt, sep, multi_line) -> dict[str, T.DataType]:
    """The types of the columns of files with one header."""
    if fmt != "csv":
        types = T.StructType.fromDDL(", ".join(f"c{i} {kind}" for i, (_, kind) in enumerate(header)))
    else:
        types = spark.read.options(**_csv_options(sep, multi_line), inferSchema=True).csv([literal_path(f) for f in files]).schema
    return {n: f.dataType for n, f in zip(names, types)}


def _scan(spark, root, files, names, kinds, *, fmt, layout, sep, multi_line) -> DataFrame:
    """The files of one header with clean names; CSV has its lines that do not fit in MALFORMED."""
    paths = [literal_path(f) for f in files]
    reader = spark.read.option("basePath", root) if layout == "folder" else spark.read
    if fmt != "csv":
        df = reader.format(fmt).load(paths)
        return df.withColumnsRenamed(dict(zip(df.columns, names)))
    schema = T.StructType([T.StructField(n, k) for n, k in zip([*names, MALFORMED], [*(kinds or [T.StringType()] * len(names)), T.StringType()])])
    # Without the pruning whole lines are parsed, whatever is selected, so that lines that do not fit are seen.
    options = {**_csv_options(sep, multi_line), "columnPruning": False, "columnNameOfCorruptRecord": MALFORMED}
    return reader.options(**options).schema(schema).csv(paths)


def _cells(scan: DataFrame, names, kinds, fmt, layout, malformed) -> DataFrame:
    """Report name, place in the file and cells; with ``malformed="reject"`` the paths of the lines that do not fit."""
    if fmt == "csv":
        block, seq = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    else:
        block, seq = F.lit(0).cast("long"), F.col("_metadata.row_index")
    order = F.struct(F.col("_metadata.file_name").alias("part"), block.alias("block"), seq.alias("seq"))
    # File names come percent-encoded; a plus sign is itself there.
    decoded = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    report = decoded if layout == "file" else F.col(SOURCE_FILE)
    kind_of = dict(zip(names, kinds or [T.StringType()] * len(names)))
    cells = [
        F.col(n) if fmt == "csv" else F.col(n).cast(kind_of[n]).alias(n)
        for n in names if not n.endswith("percent") and n != SOURCE_FILE
    ]
    if fmt == "csv" and malformed == "raise":
        found = F.raise_error(F.concat(F.lit("malformed line in "), decoded)).cast("boolean")
        scan = scan.where(F.when(F.col(MALFORMED).isNull(), F.lit(True)).otherwise(found))
    elif fmt == "csv":
        cells.append(F.when(F.col(MALFORMED).isNotNull(), F.col("_metadata.file_path")).alias(MALFORMED))
    return scan.select(report.alias(SOURCE_FILE), order.alias(ROW_ORDER), *cells)


def type_extract(raw: DataFrame, metrics=METRICS, metric_type: str = MONEY) -> DataFrame:
    """Text cells -> trimmed keys and numeric metrics; columns a file set lacks are NULL.

    ``metric_type=schema.EXACT`` makes totals independent of the order in which
    tasks add them up.
    """
    absent = [c for c in (*UNIT_KEY, CLASSIFIER, *metrics) if c not in raw.columns]
    if absent:
        raw = raw.withColumns({c: F.lit(None).cast("string") for c in absent})
    text = [c for c, t in raw.dtypes if t == "string" and c not in (SOURCE_FILE, *metrics)]
    return cast_metrics(tidy_text(raw, text), metrics, metric_type)
