"""JSON-lines and other line sources with explicit schemas; malformed rows are kept apart, not lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CORRUPT = "_corrupt"


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object a line (also gzipped); lines that don't parse have only _corrupt."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("row")).select("row.*")


def array_lines(spark: SparkSession, path: str, schema: T.StructType, wanted: Column | None = None) -> DataFrame:
    """A JSON array written one object a line: brackets and trailing commas are ignored. wanted filters the raw lines
    (column value) before they are parsed."""
    lines = spark.read.text(path).where(F.trim("value").startswith("{"))
    if wanted is not None:
        lines = lines.where(wanted)
    parsed = F.from_json(F.regexp_replace(F.trim("value"), r",$", ""), schema, {"mode": "PERMISSIVE"})
    return lines.select(parsed.alias("row")).where("row is not null").select("row.*")


def one_of(spark: SparkSession, first: str, second: str, schema: T.StructType, key: str) -> DataFrame:
    """Rows of the first folder, and those of the second whose key the first lacks."""
    a, b = spark.read.schema(schema).json(first), spark.read.schema(schema).json(second)
    return a.unionByName(b.join(a.select(key), key, "left_anti"))


def by_file(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON documents of a folder, with the file's stem as column stem."""
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("stem", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)\.[^.]*$", 1))


def embedded(body: Column, marker: str, schema: str) -> Column:
    """The JSON value that follows a script's marker (a pattern) as a struct, whatever comes after it.

    The value ends where its brackets close; brackets, braces and semicolons inside strings don't count, nor do line ends.
    Null if there is no marker or the value is cut short.
    """
    rest = F.regexp_extract(body, rf"(?s)(?:{marker})\s*([{{\[].*)", 1)
    tokens = F.regexp_extract_all(rest, F.lit(r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}\[\]]|[^"{}\[\]]++|"'), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(0).alias("end"))

    def step(acc: Column, t: Column) -> Column:
        depth = acc["depth"] + F.when(t.isin("{", "["), 1).when(t.isin("}", "]"), -1).otherwise(0)
        n = acc["n"] + F.length(t)
        return F.when(acc["end"] > 0, acc).otherwise(F.struct(depth.alias("depth"), n.alias("n"), F.when(depth == 0, n).otherwise(0).alias("end")))

    end = F.aggregate(tokens, start, step)["end"]
    return F.when(end > 0, F.from_json(F.left(rest, end), schema))


def _unescaped(text: Column) -> Column:
    """Text of XML with the five entities that it names."""
    for entity, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def sitemap(xml: Column) -> Column:
    """The locations of a sitemap, each with its own last change (null if it tells none), whatever the namespace prefix."""
    one = lambda x, tag: F.nullif(_unescaped(F.regexp_extract(x, rf"<(?:\w+:)?{tag}>\s*([^<]*?)\s*</", 1)), F.lit(""))
    each = F.regexp_extract_all(xml, F.lit(r"(?s)<(?:\w+:)?(?:url|sitemap)>(.*?)</(?:\w+:)?(?:url|sitemap)>"), F.lit(1))
    return F.filter(F.transform(each, lambda x: F.struct(one(x, "loc").alias("loc"), one(x, "lastmod").alias("lastmod"))), lambda x: x["loc"].isNotNull())


def canonical(url: Column) -> Column:
    """A URL without scheme, www or m subdomain, query, fragment and trailing slash, in lower case."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(url), r"[?#].*$", ""), r"^[a-z]+://(?:www\.|m\.)?", ""), r"/+$", "")


def indirect(spark: SparkSession, manifest: str) -> str:
    """The address that a manifest (one JSON object) gives: of the line file, else of the plain file. None is an error."""
    found = spark.read.schema("jsonl_download_uri string, download_uri string").option("multiLine", True).json(manifest).first()
    at = found and (found["jsonl_download_uri"] or found["download_uri"])
    if not at:
        raise ValueError(f"{manifest} gives no address")
    return at


def id_map(spark: SparkSession, path: str) -> DataFrame:
    """(id, other) of a tab-separated file without a heading; lines with fewer fields are left out."""
    return spark.read.schema("id string, other string").option("sep", "\t").csv(path).where("id is not null and other is not null")


def folder(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(path, document) of the files of a folder, one JSON document each; files that do not decode are left out."""
    text = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
    return text.select(F.col("_metadata.file_path").alias("path"), F.from_json("value", schema).alias("document")).where(F.get_json_object("value", "$").isNotNull() & F.col("document").isNotNull())
