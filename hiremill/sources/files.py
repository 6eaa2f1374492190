"""Scans of raw files: saved pages, HTML, JSON records, résumés, rate limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremill.functions.labels import RESUME_CHARS
from hiremill.functions.text import normalize_newlines
from hiremill.schemas import LISTING_FIELDS, RATE_LIMITS


def file_stem(path: Column) -> Column:
    """File name without folder and last extension."""
    return F.regexp_replace(F.url_decode(F.replace(F.substring_index(path, "/", -1), F.lit("+"), F.lit("%2B"))), r"\.[^.]*$", "")


def _binary(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(file_stem(F.col("path")).alias("doc_key"), "content")


def scan_mhtml(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_key, content)`` of every ``*.mhtml`` file directly in ``folder``."""
    return _binary(spark, folder, "*.mhtml")


def scan_html(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_key, html, error_kind, error)`` of every ``*.html`` file.

    Text is strict UTF-8 with line ends as in text mode. A file that is not
    UTF-8 keeps its row, with an error in place of the text.
    """
    files = _binary(spark, folder, "*.html").withColumn("text", F.col("content").cast("string"))
    ok = F.is_valid_utf8("text")
    return files.select(
        "doc_key",
        F.when(ok, normalize_newlines("text")).alias("html"),
        F.when(~ok, "encoding").alias("error_kind"),
        F.when(~ok, "not valid UTF-8").alias("error"),
    )


def parse_records(df: DataFrame, text: str = "value") -> DataFrame:
    """JSON text to listing columns plus ``load_error``.

    A record fails when the text as a whole is no JSON object (also with text
    behind it or a raw control character in a string), lacks one of the four keys,
    or has an object or array as the value of one. A key whose value is JSON null
    is present and reads NULL. All four fields of a failed record are NULL.
    """
    schema = ", ".join(f"{name} string" for name in LISTING_FIELDS)
    strict = {"allowSingleQuotes": "false"}
    body = F.from_json(text, schema, strict)
    keys = F.json_object_keys(text)
    # The parser stops behind a value; as the only item of a list and of an object the whole text must be one.
    as_item = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<map<string,string>>", strict)
    as_value = F.from_json(F.concat(F.lit('{"item":'), text, F.lit("}")), "item map<string,string>", strict)
    whole = (F.size(as_item) == 1) & as_value["item"].isNotNull() & keys.isNotNull()
    missing = [F.when(~F.array_contains(keys, name), F.lit(f"missing {name}")) for name in LISTING_FIELDS]
    variant = F.try_parse_json(text)
    nested = [
        F.when(F.schema_of_variant(F.variant_get(variant, f"$.{name}", "variant")).rlike("^(OBJECT|ARRAY)"), F.lit(f"nested {name}"))
        for name in LISTING_FIELDS
    ]
    error = F.when(~F.coalesce(whole, F.lit(False)), "not a JSON object").otherwise(F.coalesce(*missing, *nested))
    fields = [F.when(F.col("load_error").isNull(), F.col(f"_body.{name}")).alias(name) for name in LISTING_FIELDS]
    return df.withColumn("_body", body).withColumn("load_error", error).select(
        *[c for c in df.columns if c != text], *fields, "load_error"
    )


def scan_records(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_key, source_id, job_title, company, description, load_error)`` of ``*.json`` files."""
    files = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True)
    return parse_records(files.select(file_stem(F.col("_metadata.file_path")).alias("doc_key"), "value"))


def scan_resumes(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """``(resume_id, text)``: each résumé file as a whole, line ends normalised."""
    files = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
    return files.select(
        file_stem(F.col("_metadata.file_path")).alias("resume_id"), normalize_newlines("value").alias("text")
    )


def clip_resume(c: Column | str, chars: int = RESUME_CHARS) -> Column:
    """Line ends normalised, then the first ``chars`` code points: what a model is shown of a résumé."""
    return F.substring(normalize_newlines(c), 1, chars)


def scan_rate_limits(spark: SparkSession, path: str) -> DataFrame:
    """``(model, rpm, tpm, rpd)`` from a space-separated file."""
    return spark.read.csv(path, sep=" ", schema=RATE_LIMITS)
