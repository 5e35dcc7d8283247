"""Readers and input contracts. Any Hadoop-compatible path (local, HDFS, object store)."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import kept

#: Threads of the driver that read the first lines of CSV files.
HEADER_THREADS = 16


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
             infer: bool = False, multi_line: bool = False, required: Sequence[str] = ()) -> DataFrame:
    """CSV files with a header and doubled quotes, columns matched by name in every file.

    Without ``schema`` every column is a string unless ``infer=True`` (inference costs an extra full pass
    over the input; a column whose types differ between files is the wider number, else a string). With
    ``schema`` the result has its columns, whatever order a file has them in; others are not read. A column
    that a file lacks is NULL there, or a ``KeyError`` if it is ``required``.

    Spark matches the columns of a CSV scan by position and takes the names from one file. So files are
    grouped by their header line and each distinct header is a scan of its own, united by name: files of one
    header, the usual case, are one scan of ``path`` as it stands.

    ``multi_line`` reads quoted values that hold line breaks (free-text notes). A file is
    then one task, so it is meant for incident files; activity files are read without it.
    """
    reader = lambda: spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    groups = _header_groups(spark, path)
    scans = [path] if len(groups) <= 1 else [[_literal(spark, f) for f in g] for g in groups]
    names = [reader().csv(s).columns for s in scans]
    for own, files in zip(names, groups):
        for c in required:
            if c not in own:
                raise KeyError(f"expected column {c!r} not found in {files[0]}")
    if schema is not None:
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    elif not infer:
        return _united([reader().csv(s) for s in scans])
    elif len(scans) == 1:
        return reader().option("inferSchema", True).csv(path)
    else:
        schema = _widened([reader().option("inferSchema", True).csv(s).schema for s in scans])
    return _united([_scan_by_name(reader(), s, own, schema) for s, own in zip(scans, names)])


def _literal(spark: SparkSession, uri: str) -> str:
    """A listed file as a path that is read back as it is, glob characters included."""
    jvm = spark.sparkContext._jvm
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString())


def _header_line(spark: SparkSession, uri: str) -> str:
    """First record of a CSV file that is not blank, as text (an open quote goes on to the next line)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
            codec.createInputStream(stream) if codec is not None else stream, "UTF-8"))
        text = lines.readLine()
        while text is not None and not text.strip("\ufeff \t\r"):
            text = lines.readLine()
        while text is not None and text.count('"') % 2 and (more := lines.readLine()) is not None:
            text += "\n" + more
        return (text or "").lstrip("\ufeff")
    finally:
        stream.close()


def _header_groups(spark: SparkSession, path: str | Sequence[str]) -> list[list[str]]:
    """The files under ``path`` by distinct header line; files without any line are in none. Only the first
    lines are read, by a few threads of the driver."""
    files = sorted(spark.read.text(path).inputFiles())
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        for f, line in zip(files, pool.map(lambda f: _header_line(spark, f), files)):
            if line:
                groups.setdefault(line, []).append(f)
    return list(groups.values())


def _scan_by_name(reader: DataFrameReader, files: str | Sequence[str], names: Sequence[str], schema: T.StructType) -> DataFrame:
    """One scan of files whose header is ``names``, with the columns of ``schema``."""
    kinds = {f.name: f.dataType for f in schema.fields}
    df = reader.schema(T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])).csv(files)
    return df.select(*[F.col("`" + c.replace("`", "``") + "`") if c in names else F.lit(None).cast(kind).alias(c)
                       for c, kind in kinds.items()])


def _united(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _widened(schemas: Sequence[T.StructType]) -> T.StructType:
    """The columns of all schemas in order of appearance; types that differ become the wider number, else text."""
    kinds: dict[str, T.DataType] = {}
    for f in (f for s in schemas for f in s.fields):
        have = kinds.setdefault(f.name, f.dataType)
        if have != f.dataType:
            both = {type(have), type(f.dataType)}
            kinds[f.name] = (T.LongType() if both <= {T.IntegerType, T.LongType}
                             else T.DoubleType() if both <= {T.IntegerType, T.LongType, T.DoubleType} else T.StringType())
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def _is_missing_path(e: AnalysisException) -> bool:
    cond = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    name = cond() if cond else None
    return name == "PATH_NOT_FOUND" or "Path does not exist" in str(e)


def require_path(spark: SparkSession, path: str, reader: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """Open ``path`` with ``reader`` (CSV with header by default); a missing path
    raises ``FileNotFoundError``."""
    reader = reader or (lambda p: read_csv(spark, p))
    try:
        return reader(path)
    except AnalysisException as e:
        if _is_missing_path(e):
            raise FileNotFoundError(path) from e
        raise


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Raise ``KeyError`` naming the first required column that is absent."""
    for c in cols:
        if c not in df.columns:
            raise KeyError(f"expected column {c!r} not found")
    return df


def read_clean_or_raw(spark: SparkSession, clean_path: str, raw_path: str,
                      clean: Callable[[DataFrame], DataFrame] | None = None, multi_line: bool = True) -> DataFrame:
    """The cleaned incidents if they exist, else the raw file run through the minimal clean.
    Notes may hold line breaks, unless ``multi_line`` is off."""
    try:
        return read_csv(spark, clean_path, multi_line=multi_line)
    except AnalysisException as e:
        if not _is_missing_path(e):
            raise
    from ..plans.jobs import clean_incidents
    raw = require_path(spark, raw_path, lambda p: read_csv(spark, p, multi_line=multi_line))
    return (clean or clean_incidents)(raw)


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Cast every DECIMAL column to DOUBLE (other columns unchanged)."""
    if not any(isinstance(f.dataType, T.DecimalType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


# Attribute type tags of a typed item export (text, number, boolean; then
# the sets, list, map and binary).
SCALAR_TAGS = ("S", "N", "BOOL")
OTHER_TAGS = ("SS", "NS", "BS", "L", "M", "B")


def _attribute(ref: Column, kind: T.DataType) -> Column:
    """One item attribute: a number as DOUBLE straight from its text, a boolean as BOOLEAN,
    anything else, or a mix of types, as text (sets, lists and maps as JSON)."""
    fields = {t.name: t.dataType for t in kind.fields} if isinstance(kind, T.StructType) else {}
    tags = [t for t in (*SCALAR_TAGS, *OTHER_TAGS) if t in fields]
    if tags == ["N"]:
        return ref.getField("N").cast("string").try_cast("double")
    if tags == ["BOOL"]:
        return ref.getField("BOOL").cast("boolean")
    if isinstance(kind, T.VariantType):
        return _plain(ref, kind)
    if not tags:
        return F.lit(None).cast("string")
    nested = lambda t: isinstance(fields[t], (T.StructType, T.ArrayType, T.MapType))
    return F.coalesce(*[F.to_json(ref.getField(t)) if nested(t) else _plain(ref.getField(t), fields[t]).cast("string") for t in tags])


def _columns_of(found: str) -> str:
    """The struct type of a variant schema. Decimals are read as DOUBLE, what is always null as text; a mix
    of types stays VARIANT. Names are quoted where they need it and are left as they are."""
    parts = re.split(r"(`(?:[^`]|``)*`)", found)
    for i in range(0, len(parts), 2):
        parts[i] = re.sub(r"\bOBJECT<", "STRUCT<", parts[i])
        parts[i] = re.sub(r"\bDECIMAL\(\d+, ?\d+\)", "DOUBLE", parts[i])
        parts[i] = re.sub(r"\bVOID(?=[,>])", "STRING", parts[i])
    return "".join(parts)


def _plain(c: Column, kind: T.DataType) -> Column:
    """A mix of types as text: strings as they are, anything else as JSON."""
    if not isinstance(kind, T.VariantType):
        return c
    return (F.when(F.is_variant_null(c), F.lit(None)).when(F.schema_of_variant(c) == "STRING", F.try_variant_get(c, "$", "string"))
            .otherwise(F.to_json(c)))


def read_items(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Full scan of an item-table export (JSON lines) as a flat DataFrame.

    Two layouts are accepted: plain objects per line, or typed items
    ``{"Item": {"attr": {"S": "text"} | {"N": "1.5"} | {"BOOL": true} | {"NULL": true}}}``.
    Columns are the union of attributes over all items; an absent attribute is NULL.
    Numbers become DOUBLE, sets, lists and maps JSON text, a mix of types text. The whole export is read (no
    single-page truncation); a line that is not JSON is an error.

    The JSON is parsed once: each line is a VARIANT, kept in the shared checkpoint folder until the driver ends. The
    union of attributes is a partial aggregate over it, and the columns are read from it. With ``schema`` there
    is nothing to find out, and the export is read as it stands.
    """
    if schema is not None:
        df = spark.read.schema(schema).json(path)
    else:
        lines = spark.read.option("singleVariantColumn", "item").option("mode", "FAILFAST").json(path)
        items = kept(lines.where("item IS NOT NULL"), "items")
        found = items.agg(F.schema_of_variant_agg("item")).first()[0]
        if not found.startswith("OBJECT<") or found == "OBJECT<>":
            if found not in ("VOID", "OBJECT<>"):
                raise ValueError(f"items must be JSON objects, not {found}")
            return spark.createDataFrame([], T.StructType([]))
        df = items.select(F.variant_get("item", "$", _columns_of(found)).alias("_r")).select("_r.*")
    if df.columns == ["Item"] and isinstance(df.schema["Item"].dataType, T.StructType):
        item = F.col("Item")
        cols = [_attribute(item.getField(f.name), f.dataType).alias(f.name) for f in df.schema["Item"].dataType.fields]
        df = df.select(*cols)
    else:
        df = df.select(*[_plain(F.col("`" + f.name.replace("`", "``") + "`"), f.dataType).alias(f.name) for f in df.schema.fields])
    return decimals_to_double(df)
