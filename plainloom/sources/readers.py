"""Readers: delimited text, snapshot directories, lines, nested JSON, image catalogues.

Schemas are stated by the caller: inferring one reads the data an extra time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plainloom.functions.columns import nan_to_null
from plainloom.functions.dates import file_time
from plainloom.session import stage

CORRUPT = "_corrupt_record"


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _csv(spark: SparkSession, schema: T.StructType, header: bool, sep: str, encoding: str):
    return spark.read.schema(schema).option("header", header).option("sep", sep).option("encoding", encoding)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    header: bool = True,
    sep: str = ",",
    encoding: str = "UTF-8",
    drop_malformed: bool = False,
) -> DataFrame:
    """One file, a list of files or a glob as one table (many yearly files included). NaN is read as null."""
    if drop_malformed:
        return read_csv_with_rejects(spark, path, schema, header, sep, encoding)[0]
    rows = _csv(spark, _schema(schema), header, sep, encoding).csv(path if isinstance(path, str) else list(path))
    return _without_nan(rows)


def _without_nan(rows: DataFrame) -> DataFrame:
    floats = [f.name for f in rows.schema if f.dataType.typeName() in ("double", "float")]
    return rows.withColumns({c: nan_to_null(F.col(f"`{c}`")) for c in floats}) if floats else rows


def read_tsv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, header: bool = False) -> DataFrame:
    return read_csv(spark, path, schema, header, sep="\t")


def read_csv_with_rejects(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    header: bool = True,
    sep: str = ",",
    encoding: str = "UTF-8",
) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed lines as text), so that skipped lines can be counted.

    Parsed once with all columns and staged. Over the raw file, which lines count
    as malformed would depend on the columns a query happens to read.
    """
    marked = T.StructType([*_schema(schema).fields, T.StructField(CORRUPT, T.StringType())])
    reader = _csv(spark, marked, header, sep, encoding).option("columnNameOfCorruptRecord", CORRUPT)
    parsed = stage(reader.csv(path if isinstance(path, str) else list(path)))
    good = _without_nan(parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT))
    return good, parsed.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def infer_csv(spark: SparkSession, path: str, header: bool = True, sep: str = ",") -> DataFrame:
    """Schema by inference, for profiling an unknown file."""
    return spark.read.option("header", header).option("sep", sep).option("inferSchema", True).csv(path)


def read_promoted(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, sep: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """Files whose first row names their columns, each in its own order, as one table.

    Every file's first row is found by its place (the first row of the block that starts
    at byte 0), so no file is opened by the driver and files need not agree. Columns that
    a file lacks are null, others are left out, and so are values that do not parse.
    """
    wanted = _schema(schema)
    paths = path if isinstance(path, str) else list(path)
    raw = spark.read.option("sep", sep).option("encoding", encoding).option("header", False).csv(paths)
    cells = F.array(*[F.col(f"`{c}`") for c in raw.columns]).alias("cells")
    where = F.struct("_metadata.file_block_start", F.monotonically_increasing_id().alias("row")).alias("at")
    # Written once: a row keeps its place whatever is read later.
    rows = stage(raw.select(F.col("_metadata.file_path").alias("file"), where, cells))
    heads = rows.groupBy("file").agg(F.min("at").alias("head"), F.min_by("cells", "at").alias("names"))
    placed = rows.join(stage(heads), "file").where("at <> head")
    values = [
        F.get("cells", F.array_position("names", f.name).cast("int") - 1).try_cast(f.dataType).alias(f.name) for f in wanted
    ]
    return placed.select(*values)


def read_snapshots(
    spark: SparkSession, path: str, channels: Sequence[str], header: bool = False, stamp: str = "file"
) -> DataFrame:
    """Directory of sensor files, one per time, as one scan: (file_ts, channels...).

    Files carry no header by default: reading one would drop the first sample. The time
    stands in the name of the ``file`` or of its ``folder``.
    """
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in channels])
    rows = _csv(spark, schema, header, "\t", "UTF-8").csv(path)
    folder = F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1)
    name = F.col("_metadata.file_name") if stamp == "file" else folder
    return _without_nan(rows.select(file_time(name).alias("file_ts"), *channels))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value) per line of a text file."""
    return spark.read.text(path)


INTENTS = T.StructType(
    [
        T.StructField(
            "intents",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("tag", T.StringType()),
                        T.StructField("patterns", T.ArrayType(T.StringType())),
                        T.StructField("responses", T.ArrayType(T.StringType())),
                        T.StructField("context_set", T.StringType()),
                    ]
                )
            ),
        )
    ]
)


def read_intents(spark: SparkSession, path: str) -> DataFrame:
    """One row per intent of a nested JSON document."""
    document = spark.read.schema(INTENTS).option("multiLine", True).json(path)
    return document.select(F.explode("intents").alias("i")).select("i.*")


def read_images(spark: SparkSession, path: str, labels: Mapping[str, str] | None = None) -> DataFrame:
    """(path, file_name, label, bytes) of an image directory; the label is the parent folder.

    The content column is never selected, so the files are listed, not read.
    """
    folder = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    if labels:
        pairs = [F.lit(x) for kv in labels.items() for x in kv]
        folder = F.coalesce(F.try_element_at(F.create_map(*pairs), folder), folder)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        "path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), folder.alias("label"), F.col("length").alias("bytes")
    )


def drop_index_column(df: DataFrame, names: Sequence[str] = ("_c0", "Unnamed: 0", "")) -> DataFrame:
    """Drop the unnamed row-index column a table written with its index carries."""
    return df.select([c for c in df.columns if c not in names])


def rename_index_column(df: DataFrame, name: str, names: Sequence[str] = ("_c0", "Unnamed: 0", "")) -> DataFrame:
    return df.toDF(*[name if c in names else c for c in df.columns])
