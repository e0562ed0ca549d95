"""Readers and writers.

Everything is a Spark data source: splittable text/CSV reads with declared schemas, and
writes committed by Spark's output committer. Parquet is the format between stages;
CSV / TSV / FASTA are import and export edges. Missing values are the text ``NA`` on both
sides of every CSV/TSV edge.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barcodeforge.functions.nulls import join_null_safe
from barcodeforge.operators.partitioning import materialize

NA = "NA"

CHECKLIST_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                                 ("family", "species_final", "species_synonym", "source", "country")])
PRIMER_SCHEMA = T.StructType([
    T.StructField("primer", T.StringType()), T.StructField("gene", T.StringType()),
    T.StructField("forward_sequence", T.StringType()), T.StructField("reverse_sequence", T.StringType()),
    T.StructField("length", T.IntegerType())])
BOLD_COLUMNS = ("processid", "species", "subspecies", "nuc")
AUTHORITY_SCHEMA = T.StructType([
    T.StructField("submitted_name", T.StringType()), T.StructField("data_source", T.IntegerType()),
    T.StructField("match_type", T.StringType()), T.StructField("current_record_id", T.StringType()),
    T.StructField("current_name", T.StringType()), T.StructField("current_canonical_simple", T.StringType()),
    T.StructField("taxonomic_status", T.StringType())])


_SHORT = "_short_row"


def _read_delimited(spark: SparkSession, path: str | Sequence[str], sep: str, schema: T.StructType | None,
                    quote: str | None = None, glob: str | None = None, file_col: str | None = None,
                    partition_col: str | None = None) -> DataFrame:
    """Delimited text with a header. Columns are found by the header's names, in any order; with
    a ``schema`` its columns are taken and cast, others are left out, and a missing one is an
    error. All files of one read must have the same header.

    ``NA`` is missing, and so is what a short row lacks; a blank cell is an empty text (in a
    column that is not text, missing). The CSV source reads blank and absent cells alike, so
    short rows are told by the record that it keeps of them.
    """
    def reader():
        r = spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE").option("columnPruning", False)
        r = r.option("escape", '"') if quote is None else r.option("quote", quote)
        return r.option("pathGlobFilter", glob) if glob else r

    paths = path if isinstance(path, str) else list(path)
    names = [c for c in reader().csv(paths).columns if c != partition_col]
    texts = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _SHORT, *filter(None, [partition_col])]])
    # enforceSchema off: a file whose header differs fails instead of being read by position
    df = reader().schema(texts).option("enforceSchema", False).option("columnNameOfCorruptRecord", _SHORT).csv(paths)
    record = F.col(_SHORT) if quote == "" else F.regexp_replace(_SHORT, '"([^"]|"")*"', "")
    cells = F.when(F.col(_SHORT).isNotNull(), F.size(F.split(record, F.lit(re.escape(sep)))))

    def cell(k: int, name: str):
        there = cells.isNull() | (cells > k)
        text = F.when(there, F.coalesce(F.col(f"`{name}`"), F.lit("")))
        return F.when(text != NA, text).alias(name)

    more = [F.col("_metadata.file_path").alias(file_col)] if file_col else []
    more += [F.col(f"`{partition_col}`")] if partition_col else []
    df = df.select(*[cell(k, c) for k, c in enumerate(names)], *more)
    if schema is None:
        return df
    fields = [f for f in schema if f.name != partition_col]
    missing = [f.name for f in fields if f.name not in names]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header ({', '.join(names)})")

    def typed(f: T.StructField):
        text = F.col(f"`{f.name}`")
        if not isinstance(f.dataType, T.StringType):
            text = F.when(F.trim(text) != "", text).cast(f.dataType)
        return text.alias(f.name)

    return df.select(*[typed(f) for f in fields], *filter(None, [file_col, partition_col]))


def _decoded(text, twice: bool = False):
    """A path as it was before it became a URL; ``twice`` also undoes the escapes of a partition folder."""
    plain = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return _decoded(plain) if twice else plain


# --- sources -------------------------------------------------------------------------------

def read_checklist(spark: SparkSession, path: str, schema: T.StructType = CHECKLIST_SCHEMA) -> DataFrame:
    """Species checklist, tab separated with a header."""
    return _read_delimited(spark, path, "\t", schema)


def read_table_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",") -> DataFrame:
    """CSV with a header, ``NA`` read as missing, a blank cell of a text column as an empty text."""
    return _read_delimited(spark, path, sep, schema)


def read_bold(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """S3: second-source export: TSV, quoting off (a ``"`` stays text), short rows padded with
    NULLs, a blank cell kept as an empty text. Without a schema every column is a string."""
    return _read_delimited(spark, path, "\t", schema, quote="")


def read_primers(spark: SparkSession, path: str) -> DataFrame:
    """Primer metadata (primer, gene, forward_sequence, reverse_sequence, length)."""
    return _read_delimited(spark, path, "\t", PRIMER_SCHEMA)


def read_fasta(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """FASTA -> (header, sequence). Records are split on ``\\n>`` by the text source, so
    files are split across tasks; multi-line bodies are joined, CR and white space dropped.
    """
    r = spark.read.option("lineSep", "\n>")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return fasta_records(r.text(path if isinstance(path, str) else list(path)))


def fasta_records(raw: DataFrame, *more: str) -> DataFrame:
    """(header, sequence, *more) from text rows ``value`` that were split on ``\\n>``."""
    v = F.regexp_replace(F.col("value"), r"^\s*>", "")
    parts = F.split(v, "\n", 2)
    header = F.regexp_replace(F.element_at(parts, 1), r"\r$", "")
    body = F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))
    return (raw.select(header.alias("header"), F.regexp_replace(body, r"\s+", "").alias("sequence"), *more)
            .filter(F.col("header") != ""))


def read_partitioned(spark: SparkSession, path: str | Sequence[str], id_col: str = "path",
                     sep: str = ",", schema: T.StructType | None = None, glob: str | None = None,
                     name_col: str | None = None, name_pattern: str = r"([^/]+?)(?:\.[^./]*)?$") -> DataFrame:
    """Many CSV files read as one table with the source file in ``id_col`` and, if
    ``name_col`` is given, the part of its path that the first group of ``name_pattern`` takes
    (the file name without its last extension), such as a primer's name. Both are as the file
    system writes them, without the escapes of a URL."""
    df = _read_delimited(spark, path, sep, schema, glob=glob, file_col=id_col)
    if name_col:
        # the name is cut out before it is decoded, since a decoded name may hold a slash
        df = df.withColumn(name_col, _decoded(F.regexp_extract(id_col, name_pattern, 1)))
    return df.withColumn(id_col, _decoded(F.col(id_col)))


def read_per_primer(spark: SparkSession, path: str, schema: T.StructType | None = None, key: str = "primer_name",
                    fmt: str = "csv") -> DataFrame:
    """What :func:`write_per_primer` wrote, as one table. The primer's name is the folder's, read by
    Spark as a partition column, so it is the one that was written, whatever characters it has;
    the folder of no name is NULL. CSV and Parquet have the columns of their files; FASTA has
    ``accession`` and ``sequence``."""
    if fmt == "csv":
        return _read_delimited(spark, path, ",", schema, partition_col=key)
    if fmt == "fasta":
        texts = T.StructType([T.StructField("value", T.StringType()), T.StructField(key, T.StringType())])
        raw = spark.read.schema(texts).option("lineSep", "\n>").text(path)
        return fasta_records(raw, key).withColumnRenamed("header", "accession")
    columns = [f for f in spark.read.format(fmt).load(path).schema if f.name != key]
    return spark.read.format(fmt).schema(T.StructType([*columns, T.StructField(key, T.StringType())])).load(path)


def read_taxonomy(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The taxonomy dump as Parquet tables ``names``, ``nodes``, ``accession_taxa``."""
    root = root.rstrip("/")
    return (spark.read.parquet(f"{root}/names"), spark.read.parquet(f"{root}/nodes"),
            spark.read.parquet(f"{root}/accession_taxa"))


def read_name_authority(spark: SparkSession, path: str, data_source: int | None = None,
                        fmt: str = "parquet") -> DataFrame:
    """Name-verification snapshot, optionally one data source (3, 4 or 11)."""
    df = spark.read.parquet(path) if fmt == "parquet" else _read_delimited(spark, path, ",", AUTHORITY_SCHEMA)
    return df if data_source is None else df.filter(F.col("data_source") == data_source)


# --- sinks ---------------------------------------------------------------------------------

def _writer(df: DataFrame, mode: str, partition_by: Sequence[str] | None):
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", sep: str = ",",
              partition_by: Sequence[str] | None = None, quoted: bool = True) -> None:
    """K1 / K2: delimited text with a header, NULL written as ``NA``. Without quoting, cells are
    written as they are: none may hold the separator or a line end."""
    w = (_writer(df, mode, partition_by).option("header", True).option("sep", sep).option("nullValue", NA)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    w = w.option("escape", '"') if quoted else w.option("quote", "").option("emptyValue", "")
    w.csv(path)


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] | None = None,
              quoted: bool = True) -> None:
    write_csv(df, path, mode, "\t", partition_by, quoted)


def write_lines(df: DataFrame, col: str, path: str, mode: str = "errorifexists") -> None:
    """K3: one column, one value per line, no header, no quotes."""
    df.select(F.col(col).cast("string")).write.mode(mode).text(path)


def fasta_record(header: str = "header", sequence: str = "sequence", width: int | None = None):
    """Column ``>header\nsequence``; ``width`` wraps the body. A missing header is ``NA``, a missing
    sequence an empty body, so that no record is lost."""
    body = F.coalesce(F.col(sequence), F.lit(""))
    if width:
        body = F.regexp_replace(F.regexp_replace(body, f"(.{{{width}}})", "$1\n"), "\n$", "")
    return F.concat(F.lit(">"), F.coalesce(F.col(header), F.lit(NA)), F.lit("\n"), body).alias("value")


def write_fasta(df: DataFrame, path: str, header: str = "header", sequence: str = "sequence",
                width: int | None = None, mode: str = "errorifexists",
                partition_by: Sequence[str] | None = None) -> None:
    """K4 (and K5 with ``partition_by``): FASTA text files."""
    cols = list(partition_by or [])
    recs = df.select(*cols, fasta_record(header, sequence, width))
    _writer(recs, mode, cols).text(path)


FILE_ROWS = 1_000_000  # rows of one file of a primer


def _planned(df: DataFrame, key: str, file_rows: int) -> DataFrame:
    """``df`` dealt so that each value of ``key`` fills as many tasks as it has files: one for every
    ``file_rows`` rows, counted before. So there are at most ``rows / file_rows`` files and one
    for each value, however many tasks had rows of it, and a value with most rows is many tasks."""
    df = materialize(df)
    files = df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / file_rows).cast("int").alias("_files"))
    total = files.agg(F.sum("_files")).first()[0] or 1
    dealt = join_null_safe(df, files, [key], how="left").withColumn("_file", F.floor(F.rand(17) * F.col("_files")))
    return dealt.repartition(int(total), key, "_file").drop("_file", "_files")


def write_per_primer(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists",
                     key: str = "primer_name", file_rows: int = FILE_ROWS) -> None:
    """K5: one directory per primer (``primer_name=<name>``); primers without rows get none. Files
    have about ``file_rows`` rows."""
    df = _planned(df, key, file_rows)
    if fmt == "csv":
        write_csv(df, path, mode, partition_by=[key])
    elif fmt == "fasta":
        write_fasta(df.select(key, F.col("accession").alias("header"), "sequence"), path, mode=mode, partition_by=[key])
    else:
        _writer(df, mode, [key]).format(fmt).save(path)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] | None = None) -> None:
    """Stage boundary: Parquet. Never overwrite a path the same job reads; write a new one."""
    _writer(df, mode, partition_by).parquet(path)
