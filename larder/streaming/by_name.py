"""Incremental CSV ingest that takes fields by each file's own header.

A file stream finds the new files; each micro-batch reads them in groups of equal
headers, so a field goes to the column its file names it by, in whatever order the
file has its columns. What has no column is kept in ``_rescued_data``. Types are
declared, or inferred from the first batch and stored beside the stream's checkpoint,
so that a restart and every later batch use the same ones.
"""

from __future__ import annotations

import csv
import json
import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .infer import infer_types, schema_of

RESCUE_COL = "_rescued_data"
BATCH_COL = "ingest_batch"
_RECORD = "__record"
_SURPLUS = 16  # fields beyond the header that are rescued one by one; beyond them the whole record is
_FILES = "path string, modificationTime timestamp, length long, content binary"


def stream_source(spark: SparkSession, path: str) -> tuple[str, str | None]:
    """(folder, glob) for a path: a folder as it is, a single file as its folder and its name."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getFileStatus(where).isFile():
        return where.getParent().toString(), where.getName()
    return path, None


# ---------------------------------------------------------------------- headers

def read_header(spark: SparkSession, path: str, sep: str = ",", quote: str = '"') -> tuple[str, ...] | None:
    """The names in a file's first record; None for a file without one."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(where)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        record = lines.readLine()
        while record is not None and not record.strip():
            record = lines.readLine()
        while record is not None and record.count(quote) % 2:  # a quoted name goes on in the next line
            more = lines.readLine()
            if more is None:
                break
            record += "\n" + more
    finally:
        lines.close()
    if record is None:
        return None
    return tuple(n.strip() for n in next(csv.reader([record.lstrip("\ufeff")], delimiter=sep, quotechar=quote)))


def files_by_header(spark: SparkSession, paths: Sequence[str], sep: str = ",", quote: str = '"') -> dict[tuple[str, ...], list[str]]:
    """Files grouped by header. Only first records are read here, several files at a time; empty files are left out."""
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda p: read_header(spark, p, sep, quote), paths))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in zip(paths, headers):
        if header is not None:
            groups.setdefault(header, []).append(path)
    return groups


def field_names(header: Sequence[str]) -> list[str]:
    """A name for each field: blank ones by position, repeated ones by number (``id``, ``id_2``)."""
    names: list[str] = []
    for i, n in enumerate(header):
        name, k = n or f"_c{i}", 1
        while name in names:
            k += 1
            name = f"{n or f'_c{i}'}_{k}"
        names.append(name)
    return names


def _exact(path: str) -> str:
    """A path that the reader doesn't take for a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_group(spark: SparkSession, header: Sequence[str], paths: Sequence[str], options: Mapping[str, str] | None = None) -> DataFrame:
    """Files of one header as text columns ``_0``, ``_1``, ..., the raw record of malformed rows, and the file's name."""
    fields = [StructField(f"_{i}", StringType()) for i in range(len(header))]
    reader = spark.read.schema(StructType([*fields, StructField(_RECORD, StringType())])).options(**(options or {}))
    return (reader.option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _RECORD).csv([_exact(p) for p in paths])
            .withColumn("__file", F.col("_metadata.file_name")))


# ------------------------------------------------------------------------ fields

def _entry(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("key"), value.cast("string").alias("value"))


def by_name(rows: DataFrame, header: Sequence[str], schema: StructType, options: Mapping[str, str] | None = None) -> DataFrame:
    """Rows of ``read_group`` in the columns of ``schema``, the rest in ``_rescued_data``.

    ``_rescued_data`` is a JSON object, NULL where nothing was rescued. It holds under
    its name each field that the schema doesn't have or that isn't written as its
    type; under ``_c<position>`` fields beyond the header (all of the record as ``_record``
    where they are very many); as null the columns that the file doesn't have; as
    ``_record`` a record with fewer fields than its header. Names are compared exactly.
    """
    names = field_names(header)
    at = {n: i for i, n in enumerate(names)}
    text = lambda n: F.col(f"_{at[n]}")
    parsed = {f.name: text(f.name).try_cast(f.dataType) if f.name in at else F.lit(None).cast(f.dataType) for f in schema.fields}
    wide = ", ".join(f"_c{i} string" for i in range(len(header) + _SURPLUS + 1))
    kept = {k: str(v) for k, v in (options or {}).items() if k in ("sep", "delimiter", "quote", "escape", "ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace")}
    beyond = rows.withColumn("__all", F.when(F.col(_RECORD).isNotNull(), F.from_csv(F.col(_RECORD), wide, kept)))
    extra = [F.col(f"__all._c{i}") for i in range(len(header), len(header) + _SURPLUS + 1)]
    surplus = F.coalesce(*extra).isNotNull()
    whole = F.col(_RECORD).isNotNull() & (~surplus | extra[-1].isNotNull())
    entries = [F.when(text(f.name).isNotNull() & parsed[f.name].isNull(), _entry(f.name, text(f.name))) if f.name in at
               else _entry(f.name, F.lit(None)) for f in schema.fields]
    known = set(schema.names)
    entries += [F.when(text(n).isNotNull(), _entry(n, text(n))) for n in names if n not in known]
    entries += [F.when(c.isNotNull() & ~whole, _entry(f"_c{len(header) + i}", c)) for i, c in enumerate(extra)]
    entries.append(F.when(whole, _entry("_record", F.col(_RECORD))))
    held = F.map_from_entries(F.array_compact(F.array(*entries)))
    rescued = F.when(F.size(held) > 0, F.to_json(held, {"ignoreNullFields": "false"}))
    return beyond.select(*[parsed[f.name].alias(f.name) for f in schema.fields], F.col("__file").alias("source_file"), rescued.alias(RESCUE_COL))


# ------------------------------------------------------------------------ stream

def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema stored at ``path``, or None. It is there once its writer has committed."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        return None
    return StructType.fromJson(json.loads(spark.read.text(path, wholetext=True).first()[0]))


def store_schema(spark: SparkSession, schema: StructType, path: str) -> None:
    spark.range(1).select(F.lit(schema.json())).coalesce(1).write.mode("overwrite").text(path)


def ingest_csv(spark: SparkSession, source: str, target: str, checkpoint: str, schema: StructType | None = None,
               options: Mapping[str, str] | None = None, glob: str | None = None, files_at_once: int = 1000,
               rescue: bool = True, with_file_name: bool = False) -> DataFrame:
    """Append every not-yet-seen CSV file under ``source`` to the parquet table at ``target``; return the table.

    Without ``schema`` its types are inferred from the first batch (all columns of all its
    files, in order of appearance) and stored at ``checkpoint``-schema; later runs read
    them there. A micro-batch takes up to ``files_at_once`` files and writes its own
    partition ``ingest_batch=<n>``, replaced as a whole if the batch is run again
    after a failure: every file's rows are in the table exactly once.
    """
    options = dict(options or {})
    sep, quote = options.get("sep", options.get("delimiter", ",")), options.get("quote", '"')
    schema_path = f"{checkpoint.rstrip('/')}-schema"
    folder, name = stream_source(spark, source)
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", files_at_once)
    if glob or name:
        reader = reader.option("pathGlobFilter", glob or name)

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        paths = sorted(r.path for r in batch.select("path").collect())  # names of at most files_at_once files
        groups = files_by_header(session, paths, sep, quote)
        if not groups:
            return
        read = {h: read_group(session, h, files, options) for h, files in groups.items()}
        types = schema or stored_schema(session, schema_path)
        if types is None:
            types = infer_schema(read)
            store_schema(session, types, schema_path)
        out = None
        for header, rows in read.items():
            part = by_name(rows, header, types, options)
            out = part if out is None else out.unionByName(part)
        drop = [c for c, keep in (("source_file", with_file_name), (RESCUE_COL, rescue)) if not keep]
        out.drop(*drop).write.mode("overwrite").option("compression", "zstd").parquet(f"{target.rstrip('/')}/{BATCH_COL}={number}")

    query = (reader.load(folder).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return read_ingested(spark, target)


def infer_schema(groups: Mapping[tuple[str, ...], DataFrame]) -> StructType:
    """Types over the files of all headers: one aggregate over their rows, columns matched by name."""
    order: list[str] = []
    for header in groups:
        order += [n for n in field_names(header) if n not in order]
    place = {n: f"_{i}" for i, n in enumerate(order)}
    rows = None
    for header, part in groups.items():
        at = {n: i for i, n in enumerate(field_names(header))}
        part = part.select(*[(F.col(f"_{at[n]}") if n in at else F.lit(None).cast("string")).alias(place[n]) for n in order])
        rows = part if rows is None else rows.unionByName(part)
    found = infer_types(rows)
    return schema_of({n: found[place[n]] for n in order})


def read_ingested(spark: SparkSession, target: str, batch: int | None = None) -> DataFrame:
    """The ingested table, or one micro-batch of it."""
    if batch is not None:
        return spark.read.parquet(f"{target.rstrip('/')}/{BATCH_COL}={batch}")
    return spark.read.parquet(target).drop(BATCH_COL)
