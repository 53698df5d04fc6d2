"""Readers. Explicit schemas only; a missing column fails on the driver before any job runs."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.functions import paths
from gleanwork.functions.labels import RESPONSE
from gleanwork.functions.text import strip
from gleanwork.operators.ordering import dense_index, first_rows

# Column lists of the population, candidate and licence files.
POPULATION_COLUMNS = ("name", "lastCommitSHA", "lastCommit", "defaultBranch", "license")
CANDIDATE_COLUMNS = (
    "name", "lastCommitSHA", "markdown_path", "blob_sha", "content_sha256", "size_bytes", "markdown_url",
    "matched_filename_terms", "matched_content_terms", "agent_evidence",
)
EVIDENCE_COLUMNS = ("name", "lastCommitSHA", "guideline_path")

ATTEMPT = (
    "custom_id string, input_index bigint, name string, lastCommitSHA string, markdown_path string, "
    "blob_sha string, size_bytes bigint, markdown_url string, matched_filename_terms string, "
    "matched_content_terms string, status string, model_label string, model_reason string, quote string, "
    "confidence int, reason string, attempt_count int, model_attempt_count int, retrieval_attempt_count int, "
    "retry_exhausted boolean, input_tokens bigint, uncached_input_tokens bigint, cached_input_tokens bigint, "
    "cache_write_input_tokens bigint, output_tokens bigint, total_tokens bigint, cost_usd decimal(18,9), "
    "elapsed_seconds double, provider_result string, seq bigint"
)
REPORT_COLUMNS = tuple(
    name for name in (field.split()[0] for field in ATTEMPT.split(", ")) if name not in ("provider_result", "seq")
)
REQUEST = (
    "custom_id string, method string, url string, body struct<model:string, instructions:string, input:string, "
    "reasoning:struct<effort:string>, max_output_tokens:int>"
)
REQUEST_INPUT = "repository string, revision string, path string, content string"
ENTRY = "repository string, revision string, path string, sha string, size bigint, mode string"


def report_columns(df: DataFrame, columns: Sequence[str] = REPORT_COLUMNS) -> DataFrame:
    """The wanted columns of an attempt log in the order of the report; raw results never reach it."""
    return df.select(*(c for c in REPORT_COLUMNS if c in columns))


def require_columns(df: DataFrame, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """Fail when columns are missing, or when the list must match exactly, order included."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    if exact and tuple(df.columns) != tuple(columns):
        raise ValueError(f"columns must be {', '.join(columns)}")
    return df


def list_files(spark: SparkSession, folder: str, ending: str) -> list[str]:
    """Paths of the files in a folder, in name order."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [status.getPath() for status in fs.listStatus(path) if status.isFile()]
    return sorted(p.toString() for p in found if p.getName().endswith(ending))


def _first_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first record of every file whose first line is among these: ``path, record``."""
    records: dict[str, str] = {}
    for batch in batches:
        files, starts = batch.column("file"), batch.column("start").to_numpy()
        # Lines of one file lie together, so only the ends of its stretch are looked at.
        for name in files.unique().to_pylist():
            stretch = pc.indices_nonzero(pc.equal(files, name)).to_numpy()
            for k in stretch:
                if starts[k] or (name in records and not records[name].count('"') % 2):
                    break
                # A quoted name may hold line breaks.
                line = batch.column("value")[int(k)].as_py()
                records[name] = f"{records[name]}\n{line}" if name in records else line
    yield pa.RecordBatch.from_pydict({"path": list(records), "record": list(records.values())}, pa.schema([("path", pa.string()), ("record", pa.string())]))


def _plain_path(column: str) -> Column:
    """A file path of the scan, which comes as an encoded URI, as readers take it."""
    return F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))


def csv_headers(spark: SparkSession, path: str, ending: str = "") -> dict[tuple[str, ...], list[str]]:
    """Distinct headers of the CSV files at ``path``, a file or a folder, each with its files in name order.

    One scan of the lines by tasks; the driver opens no file and is sent one row per distinct header
    with the names of its files. Empty files have no header and are left out.
    """
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", f"*{ending}").text(path)
    parts = lines.select("value", _plain_path("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    first = parts.mapInArrow(_first_records, "path string, record string").groupBy("record").agg(F.sort_array(F.collect_list("path")).alias("files"))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(first.collect(), key=lambda r: r["files"][0]):
        header = next(csv.reader([row["record"].removeprefix("\ufeff").replace("\r", "")]), [])
        by_header.setdefault(tuple(header), []).extend(row["files"])
    return by_header


def _text_columns(spark: SparkSession, files: Sequence[str], header: Sequence[str]) -> DataFrame:
    """Text columns of CSV files with one header, and ``file_name``; blanks are ``""``."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    options = {"header": True, "multiLine": True, "escape": '"', "maxCharsPerColumn": -1}
    df = spark.read.schema(schema).options(**options).csv(list(files))
    return df.fillna("").select(*header, "_metadata.file_name")


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Text columns of one CSV, quoted newlines and fields of any length included; blanks are ``""``.

    ``path`` is a file or a folder of part files, as Spark writes them. The parts may order their
    columns differently, but each must have those wanted: by default, those of the first part.
    A folder without parts has nothing to read columns from, so ``columns`` must name them.
    """
    by_header = csv_headers(spark, path)
    if not by_header and columns is None:
        raise ValueError(f"no CSV files in {path}")
    wanted = list(columns or next(iter(by_header)))
    merged = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in (*wanted, "file_name")]))
    for header, files in by_header.items():
        merged = merged.unionByName(require_columns(_text_columns(spark, files, header), wanted).select(*wanted, "file_name"))
    return merged


def load_population(spark: SparkSession, folder: str) -> DataFrame:
    """All CSV files of a folder in name order, with ``source_file`` and a dense ``input_index``.

    Files with one header are one scan, so the plan grows with the headers, not with the files.
    A quoted CSV is a single split, so the running id of a scan grows along each file.
    """
    by_header = csv_headers(spark, folder, ".csv")
    if sum(map(len, by_header.values())) < len(list_files(spark, folder, ".csv")):
        raise ValueError("missing required columns: an empty file")
    if not by_header:
        raise ValueError(f"no population files in {folder}")
    merged = None
    for header, files in by_header.items():
        rows = require_columns(_text_columns(spark, files, header), POPULATION_COLUMNS)
        part = rows.withColumnRenamed("file_name", "source_file").withColumn("__line", F.monotonically_increasing_id())
        merged = part if merged is None else merged.unionByName(part, allowMissingColumns=True)
    return index_population(merged.fillna(""), ["source_file", "__line"]).drop("__line")


def index_population(rows: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Dense ``input_index`` in the given order."""
    return dense_index(rows, order, "input_index")


def extra_fields(df: DataFrame, known: Sequence[str] = POPULATION_COLUMNS) -> DataFrame:
    """Known columns plus a ``fields`` map of everything else."""
    extras = [c for c in df.columns if c not in known]
    pairs = [part for c in extras for part in (F.lit(c), F.col(c).cast("string"))]
    fields = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return df.select(*known, fields.alias("fields"))


def exclusion_names(*sources: DataFrame) -> DataFrame:
    """Union of exclusion lists keyed by ``name`` or ``repository``, trimmed, blanks dropped."""
    merged = None
    for source in sources:
        key = next((c for c in ("name", "repository") if c in source.columns), None)
        if key is None:
            raise ValueError("an exclusion list needs a name or repository column")
        part = source.select(strip(key).alias("name")).where(F.col("name") != "")
        merged = part if merged is None else merged.unionByName(part)
    return merged.distinct()


def scan_file_tree(spark: SparkSession, folder: str, suffix: str = ".md") -> DataFrame:
    """Regular files below a folder with one suffix: path relative to it, size and decoded content.

    Malformed bytes decode to replacement characters.
    """
    root = folder.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    relative = F.regexp_replace(F.col("path"), F.lit(f"^.*?{_quoted(root)}/"), F.lit(""))
    # The path test comes first, so bodies of other files are never read.
    return files.where(F.lower(paths.suffix("path")) == suffix).select(
        relative.alias("path"),
        F.col("length").alias("size"),
        F.make_valid_utf8(F.col("content").cast("string")).alias("content"),
    )


def _quoted(text: str) -> str:
    return "\\Q" + text.removeprefix("file://").removeprefix("file:") + "\\E"


def blob_entries(entries: DataFrame) -> DataFrame:
    """File entries without symbolic links and, when typed, without anything but blobs."""
    kept = entries.where(paths.is_regular("mode"))
    return kept.where(F.col("type") == "blob") if "type" in entries.columns else kept


def load_candidates(rows: DataFrame) -> DataFrame:
    """First row per (name, revision, path) in input order, text trimmed, terms as arrays.

    Pair with :func:`gleanwork.operators.gates.conflicting_candidates`.
    """
    require_columns(rows, ("name", "lastCommitSHA", "markdown_path", "blob_sha", "input_index"))
    trimmed = rows
    for column in ("name", "lastCommitSHA", "markdown_path", "blob_sha", "markdown_url"):
        if column in rows.columns:
            trimmed = trimmed.withColumn(column, strip(column))
    return first_rows(trimmed, ["name", "lastCommitSHA", "markdown_path"], ["input_index"])


def read_attempts(spark: SparkSession, path: str, schema: str = ATTEMPT) -> DataFrame:
    """Attempt log lines with their parse state in ``_corrupt_record``, their file and place in it.

    The log may be one folder of files or one folder per batch, as ``append_attempts`` writes it.
    """
    return (
        spark.read.option("recursiveFileLookup", True)
        .schema(f"{schema}, _corrupt_record string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
        .withColumn("source_file", F.col("_metadata.file_path"))
        .withColumn("line", F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")))
    )


def split_torn(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sound attempts, and corrupt lines that are *not* the torn tail of their file.

    ``lines`` carries ``_corrupt_record, source_file, line``. The second result must be empty.
    """
    last = lines.groupBy("source_file").agg(F.max("line").alias("__last"))
    bad = lines.where(F.col("_corrupt_record").isNotNull())
    inner = bad.join(last, "source_file").where(F.col("line") < F.col("__last")).drop("__last")
    sound = lines.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record", "source_file", "line")
    return sound, inner


def parse_requests(lines: DataFrame, column: str = "value") -> DataFrame:
    """Prepared requests with their inner input document unwrapped."""
    request = F.from_json(column, REQUEST)
    parsed = lines.where(strip(column) != "").select(request.alias("r"))
    return parsed.select(
        "r.custom_id",
        "r.method",
        "r.url",
        F.col("r.body.model").alias("model"),
        F.col("r.body.reasoning.effort").alias("effort"),
        F.col("r.body.max_output_tokens").alias("max_output_tokens"),
        F.from_json("r.body.input", REQUEST_INPUT).alias("input"),
    ).select("*", "input.*").drop("input")


def parse_responses(lines: DataFrame, column: str = "value") -> DataFrame:
    """Response or error lines as ``custom_id, error, response``."""
    return lines.where(strip(column) != "").select(F.from_json(column, RESPONSE).alias("r")).select("r.*")


def upgrade_checklist(rows: DataFrame) -> DataFrame:
    """Current or legacy checklist: a missing ``duplicate_of`` becomes blank."""
    require_columns(rows, ("repository", "file", "github_url", "human_decision"))
    return rows if "duplicate_of" in rows.columns else rows.withColumn("duplicate_of", F.lit(""))
