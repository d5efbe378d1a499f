"""Content manifests of file trees and deterministic samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestry.catalog import DOCUMENT_TYPES, REGISTRIES, SPLITS
from attestry.schemas import MANIFEST

# Content type by file extension; everything else is an octet stream.
CONTENT_TYPES = {
    "pdf": "application/pdf",
    "txt": "text/plain",
    "md": "text/markdown",
    "html": "text/html",
    "htm": "text/html",
    "csv": "text/csv",
    "xml": "text/xml",
    "json": "application/json",
    "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "xls": "application/vnd.ms-excel",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "zip": "application/zip",
    "png": "image/png",
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "tiff": "image/tiff",
    "tif": "image/tiff",
}
DEFAULT_CONTENT_TYPE = "application/octet-stream"


def content_type(path: Column) -> Column:
    extension = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    known = F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])
    return F.coalesce(F.element_at(known, extension), F.lit(DEFAULT_CONTENT_TYPE))


def file_manifest(
    spark: SparkSession,
    root: str,
    registry: str | None = None,
    project_id: str | None = None,
    document_type: str | None = None,
    declared_version: str | None = None,
) -> DataFrame:
    """One row per file below ``root``, but for hidden ones, with its size, hash and content type.

    Files are hashed where they are read. Spark's own listing leaves out names that start with an
    underscore; where such files matter, list and read them another way and use ``describe_files``.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "content")
    )
    base = root.rstrip("/")
    below = F.regexp_replace(F.col("path"), "^(?:[a-z0-9]+:/*)?", "/")
    relative = F.expr(f"substring(_below, instr(_below, '{base}/') + {len(base) + 1})")
    named = files.withColumn("_below", below).select(relative.alias("relative_path"), "content")
    return describe_files(named, registry, project_id, document_type, declared_version)


def describe_files(
    files: DataFrame,
    registry: str | None = None,
    project_id: str | None = None,
    document_type: str | None = None,
    declared_version: str | None = None,
) -> DataFrame:
    """The manifest of (relative_path, content) rows; paths with a part that starts with a dot go.

    The project is the first path segment of a file that does not lie directly in the root, unless
    one is given. Names that start with an underscore are files like any other.
    """
    segments = F.split("relative_path", "/")
    return files.where(~F.col("relative_path").rlike(r"(^|/)\.")).select(
        "relative_path",
        F.octet_length("content").cast("long").alias("size_bytes"),
        F.sha2("content", 256).alias("sha256"),
        content_type(F.col("relative_path")).alias("content_type"),
        F.lit(registry).cast("string").alias("registry"),
        F.lit(project_id).cast("string").alias("project_id")
        if project_id is not None
        else F.when(F.size(segments) > 1, F.get(segments, F.lit(0))).alias("project_id"),
        F.lit(document_type).cast("string").alias("document_type"),
        F.lit(None).cast("string").alias("source_url"),
        F.lit(declared_version).cast("string").alias("declared_version"),
        F.lit(None).cast("string").alias("sample_split"),
    )


def _row_rules() -> Column:
    """The rules that a manifest row breaks."""
    optional = {
        "registry_unknown": ("registry", REGISTRIES),
        "document_type_unknown": ("document_type", DOCUMENT_TYPES),
        "split_unknown": ("sample_split", SPLITS),
    }
    rules = {
        "path_empty": F.coalesce(F.length("relative_path") == 0, F.lit(True)),
        "size_not_positive": F.coalesce(F.col("size_bytes") <= 0, F.lit(True)),
        "sha256_invalid": ~F.coalesce(F.col("sha256").rlike(r"^[0-9a-f]{64}\z"), F.lit(False)),
        "content_type_empty": F.coalesce(F.length("content_type") == 0, F.lit(True)),
        "url_not_absolute": ~F.coalesce(F.col("source_url").rlike("^https?://[^/]+"), F.lit(True)),
        **{rule: ~F.coalesce(F.col(name).isin(*known), F.lit(True)) for rule, (name, known) in optional.items()},
    }
    return F.array_compact(F.array(*[F.when(bad, rule) for rule, bad in rules.items()]))


def manifest_violations(manifest: DataFrame) -> DataFrame:
    """Rows a manifest may not hold; an empty file is reported here instead of failing the job."""
    return manifest.select("relative_path", F.explode(_row_rules()).alias("rule"))


HEADER = "row_count bigint, total_bytes bigint, root_label string, generated_at string"


def parse_manifest_lines(lines: DataFrame) -> DataFrame:
    """JSON lines (``value``) as columns of rows and header, with ``kind``: row, header or broken.

    Blank lines go. A line that is no JSON object of the two layouts is kept whole and marked broken.
    """
    layout = f"{MANIFEST}, {HEADER}, _corrupt_record string"
    parsed = F.from_json(
        "value", layout, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    )
    broken = F.col("_corrupt_record").isNotNull() | ~F.coalesce(
        F.expr("try_parse_json(value) IS NOT NULL AND schema_of_variant(try_parse_json(value)) LIKE 'OBJECT%'"), F.lit(False)
    )
    return (
        lines.where(F.trim("value") != "").select("value", parsed.alias("p")).select("value", "p.*")
        .withColumn(
            "kind",
            F.when(broken, "broken").when(F.col("row_count").isNotNull() & F.col("relative_path").isNull(), "header")
            .otherwise("row"),
        )
        .drop("_corrupt_record")
    )


def manifest_line_violations(lines: DataFrame) -> DataFrame:
    """What is wrong with a manifest's lines: line (its sha256), rule.

    Broken lines; row rules; a path on several lines; and the header, which must stand once and name
    the number of rows and their bytes (rule on the empty line hash where there is none).
    """
    parsed = parse_manifest_lines(lines)
    line = F.sha2("value", 256).alias("line")
    broken = parsed.where("kind = 'broken'").select(line, F.lit("line_broken").alias("rule"))
    rows = parsed.where("kind = 'row'")
    ruled = rows.select(line, F.explode(_row_rules()).alias("rule"))
    several = rows.groupBy("relative_path").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    repeated = rows.join(several, "relative_path", "left_semi").select(line, F.lit("path_repeated").alias("rule"))
    totals = parsed.agg(
        F.count_if(F.col("kind") == "header").alias("_headers"),
        F.count_if(F.col("kind") == "row").alias("_rows"),
        F.coalesce(F.sum(F.when(F.col("kind") == "row", F.col("size_bytes"))), F.lit(0)).alias("_bytes"),
    )
    one = F.lit(1).alias("_one")
    headers = parsed.where("kind = 'header'").select("*", one).join(totals.select("*", one), "_one")
    wrong = F.array_compact(
        F.array(
            F.when(F.col("_headers") > 1, "header_repeated"),
            F.when(F.col("row_count") != F.col("_rows"), "row_count_differs"),
            F.when(~F.col("total_bytes").eqNullSafe(F.col("_bytes")), "total_bytes_differ"),
        )
    )
    lost = totals.where("_headers = 0").select(
        F.sha2(F.lit(""), 256).alias("line"), F.lit("header_missing").alias("rule")
    )
    return (
        broken.unionByName(ruled).unionByName(repeated)
        .unionByName(headers.select(line, F.explode(wrong).alias("rule"))).unionByName(lost)
    )


def manifest_header(manifest: DataFrame) -> DataFrame:
    return manifest.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"),
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    """JSON lines, as many files as there are partitions."""
    manifest.write.mode("errorifexists").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of JSON lines; header, blank and broken lines are left out.

    ``manifest_line_violations(spark.read.text(path))`` names what is wrong with the lines.
    """
    names = [field.split(" ")[0] for field in MANIFEST.split(", ")]
    return parse_manifest_lines(spark.read.text(path)).where("kind = 'row'").select(*names)


def sample_rank(seed: int, path: Column | str) -> Column:
    """First eight bytes of sha256(seed:path) as hex, which sorts like the unsigned number."""
    text = F.concat(F.lit(f"{seed}:"), path if isinstance(path, Column) else F.col(path))
    return F.substring(F.sha2(text, 256), 1, 16)


def sample_manifest(
    manifest: DataFrame, development: int, validation: int, test: int, seed: int = 0
) -> DataFrame:
    """The rows with the smallest ranks, split in order; too few rows is an error.

    Top-k keeps the k best rows per partition before one task merges them, and only the k sampled
    rows are numbered.
    """
    counts = {"development": development, "validation": validation, "test": test}
    if any(n < 0 for n in counts.values()) or not sum(counts.values()):
        raise ValueError("sample counts must be non-negative and at least one must be positive")
    total = sum(counts.values())
    ranked = manifest.withColumn("_rank", sample_rank(seed, "relative_path"))
    chosen = ranked.orderBy("_rank", "relative_path").limit(total)
    # Both windows see only the sampled rows.
    everything = Window.orderBy("_rank", "relative_path")
    found = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    shortage = F.raise_error(
        F.concat(F.lit("manifest has "), found, F.lit(f" rows but {total} samples were requested"))
    )
    split = (
        F.when(found < total, shortage.cast("string"))
        .when(F.row_number().over(everything) <= development, "development")
        .when(F.row_number().over(everything) <= development + validation, "validation")
        .otherwise("test")
    )
    return chosen.withColumn("sample_split", split).drop("_rank")
