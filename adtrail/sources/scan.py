"""Raw files of a source, accepted or rejected one by one (SRC1-SRC8).

A source is one file or a folder of files. Each file gets a status:

* ``ok``               its rows are part of the source;
* ``empty``            no content (CSV), no record (JSON);
* ``missing_columns``  a required column is absent;
* ``malformed``        it does not parse.

Only ``ok`` files are read, so a bad file never adds rows of NULLs.

CSV: the header line of every file is read (the first lines only, a few files at a
time; the driver lists the files in any case), files are grouped by header, and each group
is read with its own all-text schema, so columns go by name whatever their
order. The groups are unioned by name. No data row is read to plan this.

JSON: all files are read with one explicit all-text schema, so nothing is
inferred. One aggregate by file counts records, corrupt
records and the non-NULL values of each required column; a column without any
value in a file counts as absent. ``check_files=False`` skips that pass: then
corrupt records are left out one by one and files are not judged.

A file of one array is read by lines, so that many tasks share it, when each line
is one whole object, with brackets and commas before or behind it. The pass above sees that on
every line; any other file (objects over several lines, several on a line) is parsed as a whole, by one task.
"""

from __future__ import annotations

import csv
import logging
import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail import schemas as S

log = logging.getLogger(__name__)

OK, EMPTY, MISSING, MALFORMED = "ok", "empty", "missing_columns", "malformed"
CORRUPT = "_corrupt_record"
FILE = "_source_file"
HEADER_READERS = 16

# what a line of an array file has, as bits; ODD: the file is to be parsed as a whole; BROKEN: no object, no bracket
OPEN, LEAD, OBJECT, TRAIL, CLOSE, BROKEN, ODD = 1, 2, 4, 8, 16, 32, 64
END = "_end_of_line"

STATUS_SCHEMA = "source string, file string, status string, missing string, records bigint, corrupt_records bigint"


@dataclass
class SourceScan:
    """Rows of the accepted files, all text (None: no file is accepted), and
    the status of every file. ``found`` is False when the path does not exist."""

    source: str
    rows: DataFrame | None = None
    statuses: list[tuple] = field(default_factory=list)
    found: bool = True

    def files(self, status: str) -> list[str]:
        return [s[1] for s in self.statuses if s[2] == status]

    def only_empty(self) -> bool:
        return self.found and len(self.files(EMPTY)) == len(self.statuses)

    def report(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.statuses, STATUS_SCHEMA)


def is_missing_path(err: AnalysisException) -> bool:
    cond = getattr(err, "getCondition", None) or getattr(err, "getErrorClass", None)
    name = cond() if cond else None
    return name == "PATH_NOT_FOUND" or "Path does not exist" in str(err)


def plain_path(uri: str) -> str:
    """A listed file's URI as the path that readers and listings agree on."""
    return re.sub(r"^([a-zA-Z][a-zA-Z0-9+.-]*):///", r"\1:/", unquote(uri))


def as_glob(paths: Iterable[str]) -> list[str]:
    """Paths for a reader, which takes them as patterns."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]


def list_files(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> list[str] | None:
    """Files under the paths, from Spark's listing (no job reads them); None when a path is missing."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    try:
        found = reader.load(paths if isinstance(paths, str) else as_glob(paths)).inputFiles()
        return sorted(map(plain_path, found))
    except AnalysisException as err:
        if is_missing_path(err):
            return None
        raise


def header_line(spark: SparkSession, path: str) -> str | None:
    """First line of a file that is not blank, through Hadoop's file systems and codecs."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        content = codec.createInputStream(stream) if codec is not None else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(content, "UTF-8"))
        line = reader.readLine()
        while line is not None and not line.strip("﻿ \t\r"):
            line = reader.readLine()
        return None if line is None else line.lstrip("﻿")
    finally:
        stream.close()


def header_names(line: str) -> tuple[str, ...]:
    """Column names of a header line; a repeated name (in any case) gets a number."""
    seen: dict[str, int] = {}
    names = []
    for name in next(csv.reader([line])):
        n = seen[name.lower()] = seen.get(name.lower(), 0) + 1
        names.append(name if n == 1 else f"{name}__{n}")
    return tuple(names)


def text_struct(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def scan_csv(spark: SparkSession, source: str, paths: str | Sequence[str], glob: str | None = None,
             multiline: bool = False) -> SourceScan:
    """CSV files with a header line, by header (see the module text)."""
    files = list_files(spark, paths, glob)
    if files is None:
        return SourceScan(source, found=False)
    required, statuses = S.REQUIRED_COLUMNS[source], []
    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        for path, line in zip(files, pool.map(lambda f: header_line(spark, f), files)):
            names = header_names(line) if line is not None else ()
            missing = [c for c in required if c not in names]
            status = EMPTY if line is None else MISSING if missing else OK
            statuses.append((source, path, status, ",".join(missing) if status == MISSING else None, None, None))
            if status == OK:
                groups.setdefault(names, []).append(path)
    parts = [spark.read.schema(text_struct(names)).option("header", True).option("quote", '"').option("escape", '"')
             .option("multiLine", multiline).option("mode", "PERMISSIVE").csv(as_glob(group))
             for names, group in sorted(groups.items())]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None
    return SourceScan(source, rows, statuses)


def scan_json(spark: SparkSession, source: str, paths: str | Sequence[str], glob: str | None = None,
              json_lines: bool = False, check_files: bool = True) -> SourceScan:
    """JSON files: an array of objects each, or JSON Lines (see the module text)."""
    files = list_files(spark, paths, glob)
    if files is None:
        return SourceScan(source, found=False)
    required = S.REQUIRED_COLUMNS[source]
    if not check_files:
        return SourceScan(source, parsed_rows(spark, files, required, json_lines), [(source, f, OK, None, None, None) for f in files])
    by_line: list[str] = []
    found: dict[str, dict] = {}
    if json_lines:
        found = {plain_path(r[FILE]): r.asDict() for r in file_counts(read_json(spark, files, [*required, CORRUPT], json_lines), required).collect()} if files else {}
    elif files:
        lines: dict[str, list] = {}
        for r in line_counts(spark, files, required).collect():
            lines.setdefault(plain_path(r[FILE]), []).append(r)
        for path, kinds in lines.items():
            counts = array_counts(kinds, required)
            if counts is not None:
                found[path] = counts
                by_line.append(path)
        # files without any text are in neither
        whole = [f for f in files if f in lines and f not in found]
        if whole:
            found.update({plain_path(r[FILE]): r.asDict() for r in whole_counts(spark, whole, required).collect()})
    statuses = [(source, f, *judge(found.get(f), required)) for f in files]
    good = [s[1] for s in statuses if s[2] == OK]
    split = sorted(set(good) & set(by_line))
    rest = [f for f in good if f not in set(split)]
    parts = [line_rows(spark, split, required)] if split else []
    parts += [parsed_rows(spark, rest, required, json_lines)] if rest else []
    return SourceScan(source, reduce(DataFrame.unionByName, parts) if parts else None, statuses)


def read_json(spark: SparkSession, files: list[str], columns: Sequence[str], json_lines: bool, mode: str = "PERMISSIVE") -> DataFrame:
    return (spark.read.schema(text_struct(columns)).option("multiLine", not json_lines).option("mode", mode)
            .option("columnNameOfCorruptRecord", CORRUPT).json(as_glob(files)))


def parsed_rows(spark: SparkSession, files: list[str], required: Sequence[str], json_lines: bool) -> DataFrame | None:
    """Rows of the files without corrupt records."""
    if not files:
        return None
    if not json_lines:  # the corrupt record column would hold the whole text of a cut file
        return read_json(spark, files, required, json_lines, "DROPMALFORMED")
    # the second test is always true: Spark refuses to read the corrupt record column alone, as a plain count would
    parsed = F.col(CORRUPT).isNull() & (F.coalesce(F.length(required[0]), F.lit(0)) >= 0)
    return read_json(spark, files, [*required, CORRUPT], json_lines).where(parsed).drop(CORRUPT)


def _counts(required: Sequence[str]) -> list:
    return [F.count(c).alias(c) for c in required]


def file_counts(rows: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per file: records, corrupt records, non-NULL values per required column."""
    return rows.groupBy(F.col("_metadata.file_path").alias(FILE)).agg(
        F.count(F.lit(1)).alias("_records"), F.count(CORRUPT).alias("_corrupt"), *_counts(required))


def whole_counts(spark: SparkSession, files: list[str], required: Sequence[str]) -> DataFrame:
    """The same for files parsed as a whole. Corrupt are the records that are missing
    when malformed files are dropped, so no file's whole text is held as a record."""
    def read(mode: str, sign: int) -> DataFrame:
        return (read_json(spark, files, required, False, mode).groupBy(F.col("_metadata.file_path").alias(FILE))
                .agg(F.count(F.lit(1)).alias("n"), *_counts(required)).withColumn("sign", F.lit(sign)))

    both = read("PERMISSIVE", 1).unionByName(read("DROPMALFORMED", -1))
    return both.groupBy(FILE).agg(
        F.max(F.when(F.col("sign") == 1, F.col("n"))).alias("_records"), F.sum(F.col("sign") * F.col("n")).alias("_corrupt"),
        *[F.max(F.when(F.col("sign") == 1, F.col(c))).alias(c) for c in required])


def array_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """The lines of array files that are not blank, and the brackets and commas taken off around an object."""
    def like(name: str, test: str, cut: str, rest: str) -> list:
        return [f"{test} AS {name}", f"CASE WHEN {test} THEN {cut} ELSE {rest} END AS body"]

    blank = "' \\t\\r\\n'"
    first = lambda c: (f"startswith(body, '{c}')", f"ltrim({blank}, substr(body, 2))", "body")
    last = lambda c: (f"endswith(body, '{c}')", f"rtrim({blank}, left(body, length(body) - 1))", "body")
    df = (spark.read.text(as_glob(files))
          .select("value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("block"),
                  F.monotonically_increasing_id().alias("line"), F.expr(f"trim(BOTH {blank} FROM value)").alias("body")).where("body <> ''"))
    held = ["value", FILE, "block", "line"]
    for name, step in (("open", first("[")), ("close", last("]")), ("lead", first(",")), ("trail", last(","))):
        df = df.selectExpr(*held, *like(name, *step))
        held.append(name)
    return df.select(*held, "body")


def quoted_numbers(body: str) -> Column:
    """A JSON object's text with its numbers as strings, so that a parse as text gives them as they stand
    (``1.50``, not ``1.5``). Valid JSON has no control characters: they stand in for escapes and new quotes."""
    plain = F.replace(F.replace(body, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    marked = F.regexp_replace(plain, r'("[^"]*+")|(-?[0-9][0-9.eE+-]*+)', "$1\x03$2\x03")
    quoted = F.replace(F.replace(marked, F.lit("\x03\x03"), F.lit("")), F.lit("\x03"), F.lit('"'))
    return F.replace(F.replace(quoted, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))


def line_counts(spark: SparkSession, files: list[str], required: Sequence[str]) -> DataFrame:
    """The kinds of lines in every block of the files: how many, the first and last, and
    the non-NULL values of each required column."""
    lines = array_lines(spark, files)
    # a last element of our own tells that the line's text neither ends the array nor breaks it
    item = T.ArrayType(text_struct([*required, END]))
    parsed = lines.withColumn("items", F.from_json(F.concat(F.lit("["), F.col("body"), F.lit(f',{{"{END}":""}}]')), item)) \
        .withColumn("row", F.try_element_at("items", F.lit(1)))
    one = F.col("body").startswith("{") & (F.size("items") == 2) & F.col("row").isNotNull() & F.col("row").getField(END).isNull() \
        & F.try_element_at("items", F.lit(2)).getField(END).isNotNull()
    # forms whose text ``line_rows`` would not give as the file has it: single quotes, NaN and the like, bytes that
    # are not UTF-8, objects or arrays in a required column
    exact = F.is_valid_utf8("value") & ~F.col("body").rlike(r"[{,:\[]\s*'|[:,\[]\s*[-+]?(NaN|Inf|INF)")
    for c in required:
        exact &= ~F.coalesce(F.col("row").getField(c).rlike(r"^[{\[]"), F.lit(False))
    bracket = F.col("body") == ""
    sound = F.coalesce(one, F.lit(False)) & exact
    plain_bracket = bracket & (F.col("open") | F.col("close")) & ~F.col("lead") & ~F.col("trail")
    bit = lambda name, value: F.when(F.col(name), value).otherwise(0)
    kind = F.when(sound | plain_bracket, bit("open", OPEN) + bit("lead", LEAD) + F.when(bracket, 0).otherwise(OBJECT)
                  + bit("trail", TRAIL) + bit("close", CLOSE)) \
        .when(F.col("value").contains("]"), ODD).otherwise(BROKEN)
    return parsed.select(FILE, "block", "line", kind.alias("kind"), "row.*").groupBy(FILE, "block", "kind").agg(
        F.count(F.lit(1)).alias("lines"), F.min("line").alias("first"), F.max("line").alias("last"), *_counts(required))


def array_counts(kinds: Sequence, required: Sequence[str]) -> dict | None:
    """Counts of an array file by its kinds of lines; None when only a parse of the whole file can tell."""
    def number(bits: int) -> int:
        return sum(k["lines"] for k in kinds if k["kind"] & bits)

    def at(end, which: str, bits: int):
        return end((k for k in kinds if k["kind"] & bits), key=lambda k: (k["block"], k[which]), default=None)

    every = (1 << 7) - 1
    head, tail = at(min, "first", every), at(max, "last", every)
    objects, broken = number(OBJECT), number(BROKEN)
    if number(ODD) or number(OPEN) != 1 or not head["kind"] & OPEN or not objects:
        return None
    first, last = at(min, "first", OBJECT), at(max, "last", OBJECT)
    closed = number(CLOSE) == 1 and bool(tail["kind"] & CLOSE) and not broken
    if not closed and (number(CLOSE) or broken > 1 or (broken and not tail["kind"] & BROKEN)):
        return None
    leads, trails = number(LEAD), number(TRAIL)
    if not (leads == objects - 1 and not trails and not first["kind"] & LEAD) and \
            not (trails == objects - 1 and not leads and not last["kind"] & TRAIL) and \
            not (not closed and trails == objects and not leads):
        return None
    counts = {c: sum(k[c] for k in kinds if k["kind"] & OBJECT) for c in required}
    return {"_records": objects, "_corrupt": 0 if closed else 1, **counts}


def line_rows(spark: SparkSession, files: list[str], required: Sequence[str]) -> DataFrame:
    """Rows of array files of which each line is one object."""
    rows = array_lines(spark, files).where("body <> ''")
    return rows.select(F.from_json(quoted_numbers("body"), text_struct(required)).alias("row")).select("row.*")


def judge(counts, required: Sequence[str]) -> tuple[str, str | None, int, int]:
    """Status, missing columns, records and corrupt records of a JSON file."""
    if counts is None:
        return EMPTY, None, 0, 0
    missing = [c for c in required if counts[c] == 0]
    if counts["_corrupt"]:
        return MALFORMED, None, counts["_records"], counts["_corrupt"]
    if missing:
        return MISSING, ",".join(missing), counts["_records"], 0
    return OK, None, counts["_records"], 0


def scan_source(spark: SparkSession, source: str, paths: str | Sequence[str], glob: str | None = None,
                multiline: bool = False, json_lines: bool = False, check_files: bool = True) -> SourceScan:
    """Facebook exports are JSON, the others CSV."""
    if source == S.FACEBOOK_ADS:
        scan = scan_json(spark, source, paths, glob, json_lines, check_files)
    else:
        scan = scan_csv(spark, source, paths, glob, multiline)
    for _, path, status, missing, _, corrupt in scan.statuses:
        if status in (MISSING, MALFORMED):
            log.error("%s: %s rejected, %s %s", source, path, status, missing or f"({corrupt} corrupt records)")
    return scan
