"""Readers and writers: JSON lines, tables of files, CSV, sharded Parquet, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str, strict: bool = False) -> DataFrame:
    """One record a line, blank lines skipped. Strict: a bad line fails the job; else it is dropped. ``source`` files are known by _metadata."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def count_bad_lines(spark: SparkSession, path: str, schema: str) -> int:
    """Lines that read_json_lines would drop."""
    wide = spark.read.schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return wide.select("*").where(F.col("_corrupt").isNotNull()).select("_corrupt", F.lit(1)).count()


def with_parent(df: DataFrame, name: str = "source") -> DataFrame:
    """The directory of each row's file as a column."""
    return df.withColumn(name, F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1))


def list_files(spark: SparkSession, path: str, ending: str, recursive: bool = True) -> DataFrame:
    """(path, bytes) of files with an ending of any case, without reading them."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    return df.select("path", F.col("length").alias("bytes")).where(F.lower("path").endswith(ending.lower()))


def read_texts(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """(path, text) of whole files; bytes that are not UTF-8 become replacement characters."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    t = F.make_valid_utf8(F.decode("content", "UTF-8"))
    return raw.select("path", (F.substring(t, 1, most) if most else t).alias("text"))


def read_csv(spark: SparkSession, path: str, *name_columns: str) -> DataFrame:
    """With header; ``name`` is the first of the given columns that is there and not null."""
    df = spark.read.option("header", "true").option("escape", '"').option("multiLine", "true").csv(path)
    have = [F.col(c) for c in name_columns if c in df.columns]
    return df.withColumn("name", F.coalesce(*have)) if have else df


def read_json_map(spark: SparkSession, path: str, value: str, field: str | None = None) -> DataFrame:
    """(key, value.*) of a JSON file that is, or has in a field, a map of records."""
    text = spark.read.option("wholetext", "true").text(path)
    m = F.from_json("value", f"map<string,{value}>") if field is None else F.from_json("value", f"struct<`{field}`:map<string,{value}>>")[field]
    return text.select(F.explode(m).alias("key", "v")).select("key", "v.*")


def read_table_back(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet export with nulls as empty strings."""
    return spark.read.parquet(path).na.fill("")


def write_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_snapshot(df: DataFrame, path: str, keys: list[str], overwrite: bool = False) -> None:
    """Sorted by key; refuses a path that exists unless told to overwrite."""
    df.orderBy(*keys).write.mode("overwrite" if overwrite else "errorifexists").json(path)


def write_by_class(df: DataFrame, path: str, *classes: str) -> None:
    df.write.mode("overwrite").partitionBy(*classes).parquet(path)


def write_csv(df: DataFrame, path: str, quote_all: bool = True) -> None:
    df.write.mode("overwrite").option("header", "true").option("quoteAll", str(quote_all).lower()).option("escape", '"').csv(path)


def write_shards(df: DataFrame, path: str, rows: int = 250_000) -> None:
    """zstd Parquet of at most so many rows a file."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).option("compression", "zstd").parquet(path)


def corpus_text(pages: DataFrame) -> DataFrame:
    """(doc_id, text): a document's pages in order, form feeds between them."""
    ordered = F.array_sort(F.collect_list(F.struct("page", "text")))
    return pages.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n\f\n").alias("text"))


def summary_json(df: DataFrame, by: str) -> DataFrame:
    """(by, json): each group's columns as one JSON text."""
    rest = [c for c in df.columns if c != by]
    return df.select(by, F.to_json(F.struct(*rest)).alias("json"))


def move_plan(files: DataFrame, class_col: str, root: str) -> DataFrame:
    """(src, dst): where files of each class would go; nothing is moved."""
    return files.select(F.col("path").alias("src"), F.concat(F.lit(root.rstrip("/") + "/"), F.col(class_col), F.lit("/"), F.regexp_extract("path", r"([^/]+)$", 1)).alias("dst"))


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """Files of one JSON array each, with ``origin``: what stands before the first underscore of the file's name."""
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1)
    return spark.read.option("multiLine", "true").json(path).select("*", F.substring_index(name, "_", 1).alias("origin"))


def markdown(df: DataFrame, most: int = 1000) -> str:
    """A small aggregate as a table for a report; made on the driver. More than ``most`` rows are an error, not cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows])
