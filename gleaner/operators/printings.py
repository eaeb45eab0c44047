"""Printings: the catalog of cards, who is eligible for prices and previews, sealed products, and text pages of sets.

A card row has its fields as columns, its faces as an array of structs, and column pos, its place in the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.functions import text as tx
from gleaner.operators.priority import first_per_key

#: Layouts that are no cards to look up, and kinds of sets left out of prices, previews and products.
SKIPPED_LAYOUTS = ["token", "double_faced_token", "art_series", "emblem", "vanguard", "scheme", "planar"]
SKIPPED_FOR_PRICES = ["memorabilia", "token", "minigame", "funny"]
SKIPPED_FOR_PREVIEWS = ["token", "memorabilia", "minigame"]
SKIPPED_FOR_PRODUCTS = ["token", "memorabilia", "minigame", "vanguard", "alchemy"]
SKIPPED_FOR_TEXT = ["art_series", "token", "double_faced_token", "emblem"]
WHEEL = ["W", "U", "B", "R", "G"]


def _filled(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def not_in(c: Column, values: list[str]) -> Column:
    """c is none of the values; null is none of them."""
    return ~F.coalesce(c.isin(*values), F.lit(False))


def oracle(card: str = "oracle_id", faces: str = "faces") -> Column:
    """A card's own id, else its first face's."""
    return F.coalesce(F.nullif(F.col(card), F.lit("")), F.get(faces, 0)["oracle_id"])


def price(*kinds: Column) -> Column:
    """The first of the prices (texts) that is a number."""
    return F.coalesce(*(k.try_cast("double") for k in kinds))


def catalog(cards: DataFrame) -> DataFrame:
    """One row per slug, from the first card of the file that has it: tokens and nameless cards are left out.

    Columns of cards: id, name, layout, oracle_id, type_line, color_identity, usd, usd_foil, usd_etched, cmc, mana_cost,
    oracle_text, faces (oracle_id, type_line, mana_cost, oracle_text) and pos.
    """
    face = F.get("faces", 0)
    kind = F.trim(F.split_part(F.coalesce(F.nullif(F.col("type_line"), F.lit("")), face["type_line"], F.lit("")), F.lit("//"), F.lit(1)))
    said = F.concat(F.array("oracle_text"), F.coalesce(F.transform("faces", lambda f: f["oracle_text"]), F.array().cast("array<string>")))
    body = F.replace(F.array_join(F.filter(said, lambda t: _filled(t)), "\n"), F.lit("’"), F.lit("'"))
    letters = F.filter(F.array(*map(F.lit, WHEEL)), lambda c: F.array_contains("color_identity", c))
    rows = cards.where(not_in(F.col("layout"), SKIPPED_LAYOUTS) & _filled(F.col("name"))).select(
        tx.slug(F.col("name")).alias("slug"),
        "pos",
        "name",
        oracle().alias("oracle_id"),
        kind.alias("type_line"),
        F.coalesce("layout", F.lit("")).alias("layout"),
        F.col("id").alias("printing_id"),
        F.when(F.col("color_identity").isNotNull(), letters).alias("color_identity"),
        kind.rlike(r"\bLand\b").alias("land"),
        price(F.col("usd"), F.col("usd_foil"), F.col("usd_etched")).alias("price"),
        F.col("cmc").alias("mana_value"),
        F.coalesce(F.nullif(F.col("mana_cost"), F.lit("")), face["mana_cost"]).alias("mana_cost"),
        F.nullif(body, F.lit("")).alias("oracle_text"),
    )
    return first_per_key(rows.where("slug <> ''"), ["slug"], [F.col("pos")]).drop("pos")


def priced(cards: DataFrame) -> DataFrame:
    """Printings whose price counts: paper, of usual size, not foil only, real cards of real sets, with ids."""
    held = F.coalesce(F.array_contains("games", "paper"), F.lit(False)) & F.coalesce(F.array_contains("finishes", "nonfoil"), F.lit(False)) & ~F.coalesce("oversized", F.lit(False))
    return cards.where(held & not_in(F.col("layout"), SKIPPED_LAYOUTS) & not_in(F.col("set_type"), SKIPPED_FOR_PRICES) & _filled(F.col("name")) & _filled(F.col("id")) & _filled(oracle()))


def previewable(cards: DataFrame) -> DataFrame:
    """Printings that can be previews: not digital or oversized, real cards of real sets, with name and id."""
    off = F.coalesce("digital", F.lit(False)) | F.coalesce("oversized", F.lit(False))
    return cards.where(~off & not_in(F.col("layout"), SKIPPED_LAYOUTS) & not_in(F.col("set_type"), SKIPPED_FOR_PREVIEWS) & _filled(F.col("name")) & _filled(F.col("id")))


def _preview_order() -> list[Column]:
    """The latest previewed first (those without a date last), then set, collector number and id."""
    return [F.coalesce(-F.unix_date("previewed"), F.lit(0)), F.coalesce("set", F.lit("")), tx.natural(F.coalesce("number", F.lit(""))), F.col("id")]


def next_preview(tracked: DataFrame, today: Column) -> DataFrame:
    """The one printing to preview, of those released strictly after today: a first printing before a reprint, then in order."""
    order = F.struct(F.coalesce("reprint", F.lit(False)), *_preview_order())
    best = tracked.where(F.col("released") > today).agg(F.min_by(F.struct(*tracked.columns), order).alias("x"))
    return best.where("x is not null").select("x.*")


def previews(tracked: DataFrame, today: Column, days: int) -> DataFrame:
    """Tracked printings first seen within days and released strictly after today, newest seen first, then in order."""
    listed = tracked.where((F.col("released") > today) & (F.col("first_seen") >= F.date_sub(today, days)))
    return listed.orderBy(F.desc("first_seen"), *_preview_order())


def sets_on_sale(sets: DataFrame, today: Column, first: str) -> DataFrame:
    """Paper sets released since first, or without a date (then today's): code in lower case, name, released."""
    released = F.coalesce(F.nullif("released_at", F.lit("")), today)
    kept = _filled(F.col("code")) & _filled(F.col("name")) & ~F.coalesce("digital", F.lit(False)) & not_in(F.col("set_type"), SKIPPED_FOR_PRODUCTS) & (released >= first)
    return sets.where(kept).select(F.lower("code").alias("code"), "name", released.alias("released"))


def market_prices(prices: DataFrame) -> DataFrame:
    """Per product: the market price, else the mid price, of the normal printing if it has one, else of the first listed."""
    rows = prices.select("product", F.coalesce("market", "mid").alias("price"), F.when(F.col("sub_type") == "Normal", 0).otherwise(1).alias("rank"), "pos").where("product is not null and price is not null")
    return first_per_key(rows, ["product"], [F.col("rank"), F.col("pos")]).select("product", F.round("price", 2).alias("price"))


def sealed(products: DataFrame, prices: DataFrame, languages: list[str]) -> DataFrame:
    """Products that are sealed (no Number or Rarity among their details), pictured, linked and not in another language."""
    single = F.coalesce(F.exists("details", lambda d: d.isin("Number", "Rarity")), F.lit(False))
    foreign = F.col("name").rlike(r"(?i)\((?:" + "|".join(languages) + r")\)")
    kept = products.where(_filled(F.col("name")) & _filled(F.col("url")) & _filled(F.col("image")) & (F.coalesce("images", F.lit(0)) > 0) & ~single & ~foreign)
    return kept.join(prices, "product", "left").withColumn("image", F.regexp_replace("image", r"_\d+w(\.[A-Za-z]+)$", "_400w$1"))


def text_pages(cards: DataFrame) -> DataFrame:
    """The distinct flavour texts of each English set with the position in collector order: set, position, card, text.

    Of equal texts in a set the first of the file stays. Cards without faces are their own face.
    """
    own = F.array(F.struct(F.col("name").alias("name"), F.col("flavor").alias("flavor")))
    faces = F.when(F.size("faces") > 0, F.transform("faces", lambda f: F.struct(f["name"].alias("name"), f["flavor"].alias("flavor")))).otherwise(own)
    english = cards.where((F.coalesce("lang", F.lit("en")) == "en") & not_in(F.col("layout"), SKIPPED_FOR_TEXT))
    x = english.select("set", "pos", "number", "name", F.posexplode(faces).alias("face", "f")).select("set", "pos", "face", "number", F.coalesce(F.nullif(F.col("f.name"), F.lit("")), F.col("name")).alias("card"), F.trim("f.flavor").alias("flavor")).where("flavor <> ''")
    first = first_per_key(x, ["set", "flavor"], [F.col("pos"), F.col("face")])
    digits = F.regexp_extract("number", r"^(\d+)", 1).try_cast("int")
    w = Window.partitionBy("set").orderBy(F.coalesce(digits, F.lit(10**6)), "number", "pos", "face")
    return first.select("set", F.row_number().over(w).alias("position"), "card", F.regexp_replace("flavor", r"\s+", " ").alias("text"))


def product_name(full: Column, key: Column, set_name: Column) -> Column:
    """A product's name without the set's in front; without a name, its key's words and "Booster"."""
    made = F.concat(F.initcap(F.replace(key, F.lit("-"), F.lit(" "))), F.lit(" Booster"))
    short = F.when(F.startswith(full, set_name) & (F.length(full) > F.length(set_name)), F.trim(F.substr(full, F.length(set_name) + 1)))
    return F.when(full.isNull(), made).otherwise(F.coalesce(short, full))


def booster_cards(sheets: DataFrame, stubs: DataFrame) -> DataFrame:
    """Each set's booster file: the stubs of the cards that any of its sheets names, whichever set they are filed under.

    sheets: set, card (repeats allowed); stubs: card and its columns. Cards without a stub are left out.
    """
    return sheets.select("set", "card").distinct().join(stubs, "card")
