"""Entities of a story index: fixes kept by hand, cards matched to whom they show, and the planes they are tied to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.functions import text as tx
from gleaner.operators.matching import confident
from gleaner.operators.priority import top_per_group

#: Types of entities that are characters.
CHARACTERS = ["character", "creature", "deity"]


def folded(name: Column) -> Column:
    """A name as the index compares it: without marks, in lower case, other signs than ' and - as spaces."""
    plain = F.replace(F.lower(tx.unmarked(name)), F.lit("’"), F.lit("'"))
    return F.trim(F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9' -]+", " "), r"\s+", " "))


def agrees(a: Column, b: Column) -> Column:
    """Whether two folded names share their words: one is the other's beginning, or the second stands whole in the first."""
    p, q = F.split(a, " "), F.split(b, " ")
    n = F.least(F.size(p), F.size(q))
    starts = F.slice(p, 1, n) == F.slice(q, 1, n)
    inside = F.exists(F.sequence(F.lit(1), F.greatest(F.size(p) - F.size(q) + 1, F.lit(1))), lambda i: F.slice(p, i, F.size(q)) == q)
    return (a != "") & (b != "") & (starts | inside)


def matched(cards: DataFrame, entities: DataFrame, names: DataFrame) -> DataFrame:
    """(card, position, id): the entities that each card shows, by its types. cards: card, type_line, names (its faces').

    A plane card names its plane and a place on it; a planeswalker the character before the comma, else the one its type
    names; a legendary creature its whole name or the part before the comma, whichever is known better; a land a place; a
    legendary artifact an artifact. A name counts if its best known entity of a right type has enough pages and twice those
    of the next. names: folded, id; entities: id, type, pages, name.
    """
    front = F.split_part("type_line", F.lit("//"), F.lit(1))
    has = lambda w: F.contains(front, F.lit(w))
    sub = F.trim(F.regexp_extract(front, "—(.*)$", 1))
    first = F.get("names", 0)
    short = lambda n: F.trim(F.split_part(n, F.lit(","), F.lit(1)))
    kind = F.when(front.rlike("^Plane[ —]"), "plane").when(has("Planeswalker"), "walker").when(has("Legendary") & has("Creature"), "legend")
    kind = kind.when(has("Land"), "land").when(has("Legendary") & has("Artifact"), "artifact")

    def asks(*slots: tuple[str, Column, list[str], int]) -> Column:
        return F.array(*(F.struct(F.lit(0).alias("face"), F.lit(s).alias("slot"), n.alias("asked"), F.array(*map(F.lit, t)).alias("types"), F.lit(k).alias("least")) for s, n, t, k in slots))

    def of_faces(make) -> Column:
        return F.flatten(F.transform("names", lambda n, i: F.transform(make(n), lambda q: q.withField("face", i))))

    asked = (
        F.when(F.col("kind") == "plane", asks(("a", sub, ["plane"], 1), ("b", first, ["location", "plane"], 1)))
        .when(F.col("kind") == "walker", asks(("a", short(first), CHARACTERS, 3), ("b", sub, CHARACTERS, 3)))
        .when(F.col("kind") == "legend", of_faces(lambda n: asks(("a", n, CHARACTERS, 2), ("b", F.when(short(n) != n, short(n)), CHARACTERS, 3))))
        .when(F.col("kind") == "land", of_faces(lambda n: asks(("a", n, ["location", "plane"], 2))))
        .when(F.col("kind") == "artifact", of_faces(lambda n: asks(("a", n, ["artifact"], 2))))
    )
    x = cards.withColumn("kind", kind).where("kind is not null").select("card", "kind", F.explode(asked).alias("q")).select("card", "kind", "q.*").where("asked is not null")
    x = x.withColumn("folded", folded(F.col("asked")))
    # What a name means among entities of these types is the same for all cards that ask.
    asked_for = x.select("folded", "types").distinct()
    known = asked_for.join(names, "folded").join(entities.select("id", "type", "pages", folded(F.col("name")).alias("_own")), "id")
    known = known.where(F.array_contains("types", F.col("type")) & agrees(F.col("folded"), F.col("_own"))).withColumn("key", F.struct("folded", "types"))
    best = x.join(confident(known, "key", "pages", "id", 0, 2).select("key.*", "id", "pages"), ["folded", "types"]).where("pages >= least")
    by = best.groupBy("card", "kind", "face").agg(*(F.max(F.when(F.col("slot") == s, F.struct("id", "pages"))).alias(s) for s in "ab"))
    better = F.when(F.coalesce(F.col("b.pages") > F.col("a.pages"), F.lit(False)), F.col("b.id")).otherwise(F.coalesce("a.id", "b.id"))
    ids = F.when(F.col("kind") == "plane", F.array("a.id", "b.id")).when(F.col("kind") == "legend", F.array(better)).otherwise(F.array(F.coalesce("a.id", "b.id")))
    each = by.select("card", "face", F.posexplode(ids).alias("slot", "id")).where("id is not null")
    listed = each.groupBy("card").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("face", "slot", "id"))), lambda y: y["id"])).alias("ids"))
    return listed.select("card", F.posexplode("ids").alias("position", "id"))


def planes(entities: DataFrame, mentions: DataFrame, k: int = 5) -> DataFrame:
    """(id, rank, plane): the planes that each entity is tied to most; a plane is its own. mentions: id, pos, other, weight
    (one for each event's place and participant, three for where it is said to be); of equals the one met first."""
    of = entities.where("type = 'plane'").select(F.col("id").alias("other"), F.col("name").alias("plane"))
    own = entities.where("type = 'plane'").select("id", F.lit(1).alias("rank"), F.col("name").alias("plane"))
    met = mentions.join(of, "other").join(entities.where("type <> 'plane'").select("id"), "id").groupBy("id", "plane").agg(F.sum("weight").alias("n"), F.min("pos").alias("seen"))
    return own.union(top_per_group(met, ["id"], [F.desc("n"), F.col("seen"), F.col("plane")], k).select("id", "rank", "plane"))


def fixed(named: DataFrame, splits: DataFrame, drops: DataFrame, generic: DataFrame) -> DataFrame:
    """Entities of pages (page, name, aliases) after the rules kept by hand: a name that means someone else on a page gets its
    own name there (splits: page, name, as); aliases an entity never has (drops: name, alias) and phrases that are no names
    (generic: name) go, and so do aliases that a split has taken."""
    rename = splits.select("page", folded(F.col("name")).alias("_f"), F.col("as").alias("_as"))
    x = named.withColumn("_f", folded(F.col("name"))).join(rename, ["page", "_f"], "left").withColumn("_new", F.coalesce("_as", "name"))
    x = x.withColumn("_id", F.struct("page", "name", "_new", "_f"))
    each = x.select("_id", F.posexplode_outer("aliases").alias("_i", "_alias")).withColumn("_a", folded(F.col("_alias"))).withColumn("page", F.col("_id.page"))
    gone = drops.select(folded(F.col("name")).alias("_f"), folded(F.col("alias")).alias("_a")).distinct()
    by = lambda c: each.select("_id", "_a", folded(F.col(f"_id.{c}")).alias("_f")).join(gone, ["_f", "_a"], "left_semi").select("_id", "_a")
    taken = each.join(rename.select("page", F.col("_f").alias("_a")), ["page", "_a"], "left_semi").select("_id", "_a")
    plain = each.join(generic.select(folded(F.col("name")).alias("_a")), "_a", "left_semi").select("_id", "_a")
    away = reduce(lambda p, q: p.union(q), (by("name"), by("_new"), taken, plain)).distinct().withColumn("_away", F.lit(True))
    left = each.join(away, ["_id", "_a"], "left")
    kept = F.transform(F.array_sort(F.collect_list(F.when(F.col("_alias").isNotNull() & F.col("_away").isNull(), F.struct("_i", "_alias")))), lambda y: y["_alias"])
    return left.groupBy("_id").agg(kept.alias("aliases")).select("_id.page", F.col("_id.name").alias("was"), F.col("_id._new").alias("name"), "aliases")
