"""Readers and writers of document files, sidecars, truths and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EQUATION = "struct<equation_id:string,page_number:int,label:string,equation_number:string,latex:string,confidence:double,category:string,is_inline:boolean>"
CONTEXT = f"equations array<{EQUATION}>, pages array<struct<page_number:int,status:string>>"


def documents(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, length, fingerprint, content) of every file below a folder; a file that can't be read fails alone, not the job."""
    t = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("ignoreCorruptFiles", True).load(folder)
    return t.select("path", "length", F.sha2("content", 256).alias("fingerprint"), "content")


def sidecars(spark: SparkSession, path: str) -> DataFrame:
    """Equations of sidecar files, wrapped in a context or bare; unknown fields are dropped, missing ones null."""
    schema = f"fingerprint string, context struct<equations:array<{EQUATION}>>, equations array<{EQUATION}>"
    t = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("file", F.input_file_name())
    return t.select("file", "fingerprint", F.explode(F.coalesce("context.equations", "equations")).alias("e")).select("file", "fingerprint", "e.*")


def ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """Numbers of truth files: a JSON object or list, or one a line with # comments."""
    t = spark.read.option("wholetext", True).text(path).withColumn("file", F.input_file_name())
    value = F.trim("value")
    listed = F.from_json(value, "array<string>")
    inside = F.from_json(value, "struct<equation_numbers:array<string>>")["equation_numbers"]
    lines = F.filter(F.transform(F.split("value", "\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.startswith("#"))
    numbers = F.when(value.startswith("["), listed).when(value.startswith("{"), inside).otherwise(lines)
    return t.select("file", F.explode(numbers).alias("number"))


def write_csv(df: DataFrame, path: str) -> None:
    """Arrays joined by a bar, one header a file."""
    cols = [F.array_join(c, "|").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def markdown(equations: DataFrame, doc: str = "doc_id", order: str = "seq") -> DataFrame:
    """(doc, markdown): equations of each document in reading order."""
    line = F.concat(F.lit("- **"), F.coalesce(F.nullif("label_raw", F.lit("")), F.col("equation_id")), F.lit("** `"), F.col("latex"), F.lit("`"))
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("line"))))
    return equations.groupBy(doc).agg(F.array_join(F.transform(rows, lambda x: x["line"]), "\n").alias("markdown"))


def append_failures(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def failures(spark: SparkSession, path: str, below: int = 3) -> DataFrame:
    """Failures that may still be retried, by book, stage and page."""
    schema = "pipeline_run_id string, book_id string, page_no int, stage string, error_type string, error_msg string, retry_count int, timestamp timestamp"
    return spark.read.schema(schema).json(path).where(F.col("retry_count") < below).orderBy("book_id", "stage", "page_no")
