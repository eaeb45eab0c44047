"""Catalog, eligibility, previews, sealed products and text pages over cards made of parts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gleaner.operators import printings
from gleaner.plans.registry import query
from gleaner.session import shared_folder, table
from gleaner.sources import jsonlines

TODAY = "2024-01-30"

#: Cards made of parts: every fifth is double-faced, some are tokens, digital, oversized, foil only, nameless or without an id.
CARDS = """cards AS (
  SELECT p_partkey AS pos, CASE WHEN p_partkey % 29 <> 0 THEN 'c' || p_partkey END AS id, CASE WHEN p_partkey % 23 = 0 THEN '' ELSE p_name || CASE WHEN p_size % 5 = 1 THEN ' // ' || lower(p_type) ELSE '' END END AS name,
    CASE p_size % 9 WHEN 0 THEN 'token' WHEN 2 THEN 'emblem' WHEN 4 THEN NULL ELSE 'normal' END AS layout, CASE WHEN p_size % 5 <> 1 THEN 'o' || p_partkey % 64 END AS oracle_id,
    CASE WHEN p_size % 5 <> 1 THEN ['Creature', 'Basic Land', 'Landfall Sorcery', 'Instant'][CAST(p_partkey % 4 AS INTEGER) + 1] END AS type_line, CASE p_size % 3 WHEN 0 THEN ['G', 'W'] WHEN 1 THEN CAST([] AS VARCHAR[]) END AS color_identity,
    CASE WHEN p_size % 4 = 0 THEN CAST(p_size AS VARCHAR) || '.5' WHEN p_size % 4 = 1 THEN 'n/a' END AS usd, CASE WHEN p_size % 2 = 1 THEN CAST(p_size + 1 AS VARCHAR) || '.25' END AS usd_foil, CAST(NULL AS VARCHAR) AS usd_etched, p_size % 7 AS cmc,
    CASE WHEN p_size % 5 <> 1 THEN '{' || p_size || '}' ELSE '' END AS mana_cost, CASE WHEN p_size % 5 <> 1 AND p_size % 6 > 0 THEN 'It’s ' || p_type END AS oracle_text,
    CASE WHEN p_size % 5 = 1 THEN [{'oracle_id': 'f' || p_partkey % 64, 'name': p_name, 'type_line': 'Sorcery // Land', 'mana_cost': '{R}', 'oracle_text': 'front', 'flavor': ' old  ' || p_brand}, {'oracle_id': NULL, 'name': '', 'type_line': 'Land', 'mana_cost': '', 'oracle_text': 'back', 'flavor': CASE WHEN p_size % 2 = 0 THEN 'back ' || p_size ELSE '' END}] END AS faces,
    CASE WHEN p_partkey % 7 > 0 THEN ['paper', 'mtgo'] WHEN p_partkey % 14 = 0 THEN ['mtgo'] END AS games, CASE WHEN p_partkey % 5 = 0 THEN ['foil'] ELSE ['nonfoil', 'foil'] END AS finishes, CASE WHEN p_partkey % 3 = 0 THEN p_partkey % 31 = 0 END AS oversized,
    p_partkey % 37 = 0 AS digital, CASE p_size % 11 WHEN 0 THEN 'funny' WHEN 1 THEN 'memorabilia' WHEN 2 THEN NULL ELSE 'core' END AS set_type, p_type AS "set", replace(p_brand, 'Brand#', '') || CASE WHEN p_size % 2 = 0 THEN 'a' ELSE '' END AS number,
    CASE p_partkey % 10 WHEN 0 THEN 'de' WHEN 1 THEN NULL ELSE 'en' END AS lang, CASE WHEN p_size % 4 > 0 THEN 'said ' || p_brand END AS flavor, DATE '2024-01-30' + CAST(p_size - 25 AS INTEGER) AS released, DATE '2024-01-30' - CAST(p_partkey % 40 AS INTEGER) AS first_seen,
    CASE WHEN p_partkey % 3 > 0 THEN DATE '2024-01-30' - CAST(p_partkey % 5 AS INTEGER) END AS previewed, CASE WHEN p_partkey % 4 > 0 THEN p_partkey % 2 = 0 END AS reprint
  FROM part
)"""


def _cards(spark: SparkSession, d: str) -> DataFrame:
    k, size, text = F.col("p_partkey"), F.col("p_size"), lambda c: c.cast("string")
    double, today = size % 5 == 1, F.lit(TODAY).cast("date")
    none = F.lit(None).cast("string")
    face = lambda **c: F.struct(*(v.alias(n) for n, v in c.items()))
    faces = F.array(
        face(oracle_id=F.concat(F.lit("f"), text(k % 64)), name=F.col("p_name"), type_line=F.lit("Sorcery // Land"), mana_cost=F.lit("{R}"), oracle_text=F.lit("front"), flavor=F.concat(F.lit(" old  "), "p_brand")),
        face(oracle_id=none, name=F.lit(""), type_line=F.lit("Land"), mana_cost=F.lit(""), oracle_text=F.lit("back"), flavor=F.when(size % 2 == 0, F.concat(F.lit("back "), text(size))).otherwise("")),
    )
    columns = {
        "pos": k,
        "id": F.when(k % 29 != 0, F.concat(F.lit("c"), text(k))),
        "name": F.when(k % 23 == 0, "").otherwise(F.concat("p_name", F.when(double, F.concat(F.lit(" // "), F.lower("p_type"))).otherwise(""))),
        "layout": F.when(size % 9 == 0, "token").when(size % 9 == 2, "emblem").when(size % 9 != 4, "normal"),
        "oracle_id": F.when(~double, F.concat(F.lit("o"), text(k % 64))),
        "type_line": F.when(~double, F.element_at(F.array(*map(F.lit, ["Creature", "Basic Land", "Landfall Sorcery", "Instant"])), (k % 4 + 1).cast("int"))),
        "color_identity": F.when(size % 3 == 0, F.array(F.lit("G"), F.lit("W"))).when(size % 3 == 1, F.array().cast("array<string>")),
        "usd": F.when(size % 4 == 0, F.concat(text(size), F.lit(".5"))).when(size % 4 == 1, "n/a"),
        "usd_foil": F.when(size % 2 == 1, F.concat(text(size + 1), F.lit(".25"))),
        "usd_etched": none,
        "cmc": size % 7,
        "mana_cost": F.when(~double, F.concat(F.lit("{"), text(size), F.lit("}"))).otherwise(""),
        "oracle_text": F.when(~double & (size % 6 > 0), F.concat(F.lit("It’s "), "p_type")),
        "faces": F.when(double, faces),
        "games": F.when(k % 7 > 0, F.array(F.lit("paper"), F.lit("mtgo"))).when(k % 14 == 0, F.array(F.lit("mtgo"))),
        "finishes": F.when(k % 5 == 0, F.array(F.lit("foil"))).otherwise(F.array(F.lit("nonfoil"), F.lit("foil"))),
        "oversized": F.when(k % 3 == 0, k % 31 == 0),
        "digital": k % 37 == 0,
        "set_type": F.when(size % 11 == 0, "funny").when(size % 11 == 1, "memorabilia").when(size % 11 != 2, "core"),
        "set": F.col("p_type"),
        "number": F.concat(F.replace("p_brand", F.lit("Brand#"), F.lit("")), F.when(size % 2 == 0, "a").otherwise("")),
        "lang": F.when(k % 10 == 0, "de").when(k % 10 != 1, "en"),
        "flavor": F.when(size % 4 > 0, F.concat(F.lit("said "), "p_brand")),
        "released": F.date_add(today, (size - 25).cast("int")),
        "first_seen": F.date_sub(today, (k % 40).cast("int")),
        "previewed": F.when(k % 3 > 0, F.date_sub(today, (k % 5).cast("int"))),
        "reprint": F.when(k % 4 > 0, k % 2 == 0),
    }
    return table(spark, d, "part").select(*(c.alias(n) for n, c in columns.items()))


_NO_CARD = "coalesce(layout, '') NOT IN ('token', 'double_faced_token', 'art_series', 'emblem', 'vanguard', 'scheme', 'planar')"


@query(
    "card_catalog",
    f"""
WITH {CARDS}, c AS (SELECT *, trim(regexp_replace(lower(trim(split_part(name, '//', 1))), '[^a-z0-9]+', '-', 'g'), '-') AS slug, trim(split_part(coalesce(nullif(type_line, ''), faces[1].type_line, ''), '//', 1)) AS front FROM cards WHERE {_NO_CARD} AND name <> ''),
f AS (SELECT * FROM c WHERE slug <> '' QUALIFY row_number() OVER (PARTITION BY slug ORDER BY pos) = 1)
SELECT slug, name, coalesce(oracle_id, faces[1].oracle_id) AS oracle_id, front AS type_line, coalesce(layout, '') AS layout, id AS printing_id, CASE WHEN color_identity IS NULL THEN '?' ELSE array_to_string(list_filter(['W', 'U', 'B', 'R', 'G'], lambda x: list_contains(color_identity, x)), '') END AS colors,
  regexp_matches(front, '\\bLand\\b') AS land, coalesce(TRY_CAST(usd AS DOUBLE), TRY_CAST(usd_foil AS DOUBLE)) AS price, cmc AS mana_value, coalesce(nullif(mana_cost, ''), faces[1].mana_cost) AS mana_cost,
  nullif(replace(array_to_string(list_filter([oracle_text, faces[1].oracle_text, faces[2].oracle_text], lambda x: coalesce(x, '') <> ''), chr(10)), '’', ''''), '') AS oracle_text FROM f
""",
)
def card_catalog(spark: SparkSession, d: str) -> DataFrame:
    """The catalog: layouts skipped, first card of a slug wins, and the columns derived from card and faces."""
    out = printings.catalog(_cards(spark, d))
    return out.withColumn("colors", F.coalesce(F.array_join("color_identity", ""), F.lit("?"))).drop("color_identity")


@query(
    "priced_printings",
    f"""WITH {CARDS} SELECT id, coalesce(oracle_id, faces[1].oracle_id) AS card FROM cards WHERE list_contains(games, 'paper') AND NOT coalesce(oversized, false) AND {_NO_CARD} AND coalesce(set_type, '') NOT IN ('memorabilia', 'token', 'minigame', 'funny') AND list_contains(finishes, 'nonfoil') AND name <> '' AND id IS NOT NULL AND coalesce(oracle_id, faces[1].oracle_id) IS NOT NULL""",
)
def priced_printings(spark: SparkSession, d: str) -> DataFrame:
    """printings whose price counts."""
    return printings.priced(_cards(spark, d)).select("id", printings.oracle().alias("card"))


_PREVIEW = f"{_NO_CARD} AND coalesce(set_type, '') NOT IN ('token', 'memorabilia', 'minigame') AND NOT digital AND NOT coalesce(oversized, false) AND name <> '' AND id IS NOT NULL"


@query(
    "listed_previews",
    f"""WITH {CARDS} SELECT id, first_seen, released FROM cards WHERE {_PREVIEW} AND released > DATE '{TODAY}' AND first_seen >= DATE '{TODAY}' - 14""",
)
def listed_previews(spark: SparkSession, d: str) -> DataFrame:
    """Eligible printings first seen within two weeks and released strictly after today."""
    return printings.previews(printings.previewable(_cards(spark, d)), F.lit(TODAY).cast("date"), 14).select("id", "first_seen", "released")


@query(
    "next_preview",
    f"""WITH {CARDS} SELECT id, "set" FROM cards WHERE {_PREVIEW} AND released > DATE '{TODAY}' ORDER BY coalesce(reprint, false), previewed DESC NULLS LAST, "set", CAST(regexp_extract(number, '\\d+') AS INTEGER), number, id LIMIT 1""",
)
def next_preview(spark: SparkSession, d: str) -> DataFrame:
    """The one upcoming printing to show: first printings, then the latest previewed, then set and number."""
    return printings.next_preview(printings.previewable(_cards(spark, d)), F.lit(TODAY).cast("date")).select("id", "set")


_PRODUCTS = """prods AS (
  SELECT p_partkey AS product, CASE WHEN p_partkey % 19 = 0 THEN p_name || ' (German)' ELSE p_name END AS name, CASE WHEN p_partkey % 13 > 0 THEN 'u' || p_partkey END AS url, 'http://i/' || p_size || '_200w.jpg' AS image, p_size % 6 AS images,
    CASE p_size % 4 WHEN 0 THEN ['Number'] WHEN 1 THEN ['Text'] WHEN 2 THEN CAST([] AS VARCHAR[]) END AS details FROM part
), pr AS (SELECT l_partkey AS product, CASE WHEN l_linenumber % 3 = 0 THEN 'Normal' ELSE 'Foil' END AS sub_type, CASE WHEN l_linenumber % 4 > 0 THEN l_extendedprice END AS market, CASE WHEN l_linenumber % 2 > 0 THEN l_quantity END AS mid, l_orderkey * 10 + l_linenumber AS pos FROM lineitem WHERE l_linenumber > 0)"""


@query(
    "sealed_products",
    f"""
WITH {_PRODUCTS}, b AS (SELECT product, round(coalesce(market, mid), 2) AS price FROM pr WHERE coalesce(market, mid) IS NOT NULL QUALIFY row_number() OVER (PARTITION BY product ORDER BY CASE WHEN sub_type = 'Normal' THEN 0 ELSE 1 END, pos, coalesce(market, mid)) = 1)
SELECT product, name, regexp_replace(image, '_\\d+w', '_400w') AS image, price FROM prods LEFT JOIN b USING (product) WHERE url IS NOT NULL AND images > 0 AND NOT coalesce(list_contains(details, 'Number') OR list_contains(details, 'Rarity'), false) AND NOT contains(name, '(German)')
""",
)
def sealed_products(spark: SparkSession, d: str) -> DataFrame:
    """Sealed products, pictured and linked, in this language, with the price of the normal printing first."""
    k, size, n = F.col("p_partkey"), F.col("p_size"), F.col("l_linenumber")
    details = F.when(size % 4 == 0, F.array(F.lit("Number"))).when(size % 4 == 1, F.array(F.lit("Text"))).when(size % 4 == 2, F.array().cast("array<string>"))
    products = table(spark, d, "part").select(
        k.alias("product"), F.when(k % 19 == 0, F.concat("p_name", F.lit(" (German)"))).otherwise(F.col("p_name")).alias("name"), F.when(k % 13 > 0, F.concat(F.lit("u"), k.cast("string"))).alias("url"),
        F.concat(F.lit("http://i/"), size.cast("string"), F.lit("_200w.jpg")).alias("image"), (size % 6).alias("images"), details.alias("details"),
    )
    rows = table(spark, d, "lineitem").select(F.col("l_partkey").alias("product"), F.when(n % 3 == 0, "Normal").otherwise("Foil").alias("sub_type"), F.when(n % 4 > 0, F.col("l_extendedprice")).alias("market"), F.when(n % 2 > 0, F.col("l_quantity")).alias("mid"), F.struct(F.col("l_orderkey") * 10 + n, F.coalesce(F.when(n % 4 > 0, F.col("l_extendedprice")), F.col("l_quantity"))).alias("pos"))
    return printings.sealed(products, printings.market_prices(rows), ["German", "French"]).select("product", "name", "image", "price")


@query(
    "sets_on_sale",
    """WITH s AS (SELECT p_brand AS brand, max(p_size) AS size, count(*) AS n FROM part GROUP BY 1) SELECT lower(brand) AS code, brand || ' set' AS name, CASE WHEN size % 3 = 0 THEN '2024-01-30' ELSE '20' || (size - 26) || '-05-01' END AS released FROM s WHERE size % 7 > 0 AND n % 5 > 0 AND CASE WHEN size % 3 = 0 THEN '2024-01-30' ELSE '20' || (size - 26) || '-05-01' END >= '2022-01-01'""",
)
def sets_on_sale(spark: SparkSession, d: str) -> DataFrame:
    """Paper sets released since a first day; one without a date counts as today's."""
    size = F.col("size")
    s = table(spark, d, "part").groupBy("p_brand").agg(F.max("p_size").alias("size"), F.count(F.lit(1)).alias("n"))
    sets = s.select(F.col("p_brand").alias("code"), F.concat("p_brand", F.lit(" set")).alias("name"), (size % 7 == 0).alias("digital"), F.when(F.col("n") % 5 == 0, "alchemy").alias("set_type"), F.when(size % 3 > 0, F.concat(F.lit("20"), (size - 26).cast("string"), F.lit("-05-01"))).alias("released_at"))
    return printings.sets_on_sale(sets, F.lit(TODAY), "2022-01-01")


@query(
    "flavor_pages",
    f"""
WITH {CARDS}, e AS (SELECT "set", pos, number, name, CASE WHEN faces IS NULL THEN [{{'name': name, 'flavor': flavor}}] ELSE [{{'name': faces[1].name, 'flavor': faces[1].flavor}}, {{'name': faces[2].name, 'flavor': faces[2].flavor}}] END AS fs FROM cards WHERE coalesce(lang, 'en') = 'en' AND coalesce(layout, '') NOT IN ('art_series', 'token', 'double_faced_token', 'emblem')),
x AS (SELECT "set", pos, number, name, i, coalesce(nullif(fs[i].name, ''), name) AS card, trim(fs[i].flavor) AS flavor FROM (SELECT *, unnest(range(1, len(fs) + 1)) AS i FROM e)),
f AS (SELECT * FROM x WHERE flavor <> '' QUALIFY row_number() OVER (PARTITION BY "set", flavor ORDER BY pos, i) = 1)
SELECT "set", row_number() OVER (PARTITION BY "set" ORDER BY coalesce(TRY_CAST(regexp_extract(number, '^\\d+') AS INTEGER), 1000000), number, pos, i) AS position, card, regexp_replace(flavor, '\\s+', ' ', 'g') AS text FROM f
""",
)
def flavor_pages(spark: SparkSession, d: str) -> DataFrame:
    """Each set's distinct flavour texts in collector order."""
    return printings.text_pages(_cards(spark, d)).withColumn("position", F.col("position").cast("bigint"))


@query(
    "product_names",
    """SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN array_to_string([upper(left(w, 1)) || lower(substr(w, 2)) FOR w IN string_split(replace(p_name, ' ', '-'), '-')], ' ') || ' Booster' WHEN p_size % 3 = 0 THEN p_type ELSE p_name END AS name FROM part""",
)
def product_names(spark: SparkSession, d: str) -> DataFrame:
    """Product names without the set's in front, or made of their keys."""
    size = F.col("p_size")
    full = F.when(size % 7 == 0, F.lit(None)).when(size % 3 == 0, F.concat("p_brand", F.lit(" "), "p_type")).otherwise(F.col("p_name"))
    set_name = F.when(size % 2 == 0, F.col("p_brand")).otherwise(F.when(size % 3 == 0, F.col("p_brand")).otherwise(F.col("p_name")))
    return table(spark, d, "part").select("p_partkey", printings.product_name(full, F.replace("p_name", F.lit(" "), F.lit("-")), set_name).alias("name"))


@query(
    "booster_stubs",
    """SELECT DISTINCT l_returnflag AS "set", l_partkey AS card, p_name AS name FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size % 4 > 0""",
)
def booster_stubs(spark: SparkSession, d: str) -> DataFrame:
    """The stubs that a set's sheets name."""
    sheets = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("set"), F.col("l_partkey").alias("card"))
    stubs = table(spark, d, "part").where("p_size % 4 > 0").select(F.col("p_partkey").alias("card"), F.col("p_name").alias("name"))
    return printings.booster_cards(sheets, stubs)


@query(
    "indirect_source",
    """SELECT p_partkey AS id, p_name AS name FROM part""",
)
def indirect_source(spark: SparkSession, d: str) -> DataFrame:
    """The data behind a manifest's address: the line file's if it names one, else the other's."""
    at = f"{shared_folder(spark)}/indirect/{uuid.uuid4().hex}"
    table(spark, d, "part").select(F.to_json(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))).alias("value")).write.text(f"{at}/data")
    spark.range(1).select(F.to_json(F.struct(F.lit("").alias("jsonl_download_uri"), F.lit(f"{at}/data").alias("download_uri"))).alias("value")).write.text(f"{at}/manifest")
    return jsonlines.json_lines(spark, jsonlines.indirect(spark, f"{at}/manifest"), T.StructType.fromDDL("id long, name string")).drop(jsonlines.CORRUPT)


@query(
    "id_map_file",
    """SELECT p_partkey, 'x' || p_partkey AS other FROM part WHERE p_size % 3 > 0""",
)
def id_map_file(spark: SparkSession, d: str) -> DataFrame:
    """Ids of another source from a tab-separated side file without a heading; short lines are left out."""
    at = f"{shared_folder(spark)}/ids/{uuid.uuid4().hex}"
    k = F.col("p_partkey").cast("string")
    table(spark, d, "part").select(F.when(F.col("p_size") % 3 > 0, F.concat(k, F.lit("\tx"), k)).otherwise(k).alias("value")).write.text(at)
    return table(spark, d, "part").select("p_partkey").join(jsonlines.id_map(spark, at).select(F.col("id").cast("bigint").alias("p_partkey"), "other"), "p_partkey")


@query(
    "set_files",
    """SELECT p_brand AS stem, count(*) AS cards FROM part WHERE p_brand NOT LIKE '%3' GROUP BY 1""",
)
def set_files(spark: SparkSession, d: str) -> DataFrame:
    """A folder of documents, one a file; a file that does not decode is left out, not fatal."""
    at = f"{shared_folder(spark)}/sets/{uuid.uuid4().hex}"
    body = F.to_json(F.struct(F.struct(F.collect_list(F.struct(F.col("p_name").alias("name"))).alias("cards")).alias("data")))
    files = table(spark, d, "part").groupBy("p_brand").agg(body.alias("value")).withColumn("value", F.when(F.col("p_brand").endswith("3"), "{not json").otherwise(F.col("value")))
    files.write.partitionBy("p_brand").text(at)
    rows = jsonlines.folder(spark, at, "struct<data:struct<cards:array<struct<name:string>>>>")
    return rows.select(F.url_decode(F.url_decode(F.regexp_extract("path", r"p_brand=([^/]+)/", 1))).alias("stem"), F.size("document.data.cards").cast("bigint").alias("cards"))


@query("either_source", """SELECT p_partkey AS id, CASE WHEN p_size % 3 > 0 THEN 'local' ELSE 'remote' END AS origin FROM part WHERE p_size % 3 > 0 OR p_size % 2 = 0""")
def either_source(spark: SparkSession, d: str) -> DataFrame:
    """The local folder's rows, and the other's for the keys that it lacks."""
    at = f"{shared_folder(spark)}/either/{uuid.uuid4().hex}"
    part, key = table(spark, d, "part"), F.col("p_partkey").alias("id")
    part.where("p_size % 3 > 0").select(key, F.lit("local").alias("origin")).write.json(f"{at}/local")
    part.where("p_size % 2 = 0").select(key, F.lit("remote").alias("origin")).write.json(f"{at}/remote")
    return jsonlines.one_of(spark, f"{at}/local", f"{at}/remote", T.StructType.fromDDL("id long, origin string"), "id")


@query("files_by_stem", """SELECT DISTINCT p_brand AS folder, count(*) AS n FROM part GROUP BY 1""")
def files_by_stem(spark: SparkSession, d: str) -> DataFrame:
    """Documents of a folder by the folder and stem they lie under."""
    at = f"{shared_folder(spark)}/stems/{uuid.uuid4().hex}"
    part = table(spark, d, "part").groupBy(F.replace("p_brand", F.lit("#"), F.lit("-")).alias("folder")).agg(F.to_json(F.struct(F.count(F.lit(1)).alias("n"))).alias("value"))
    part.write.partitionBy("folder").text(at)
    rows = jsonlines.by_file(spark, at, T.StructType.fromDDL("n long")).where("stem like 'part-%'")
    return rows.select(F.replace("folder", F.lit("-"), F.lit("#")).alias("folder"), "n")
