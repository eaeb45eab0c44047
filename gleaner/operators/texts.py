"""Texts: deck lists, line trees, evidence checks, retrieval and spotting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.functions import text as tx
from gleaner.operators.priority import top_per_group
from gleaner.session import spread, written


def deck_lines(texts: DataFrame, key: str, text: str) -> DataFrame:
    """'N name' lines of each text: key, board, name, quantity, problem. A blank line or 'Sideboard' after the first card
    starts the side board; any other line is a problem row."""
    lines = texts.select(key, F.posexplode(F.split(text, "\r\n|\r|\n")).alias("pos", "line")).withColumn("line", F.trim("line"))
    card, brk = F.col("line").rlike(r"^\d+ \S"), F.lower("line").isin("", "sideboard", "sideboard:")
    w = Window.partitionBy(key).orderBy("pos")
    lines = lines.withColumn("_card", card).withColumn("_seen", F.sum(card.cast("int")).over(w))
    lines = lines.withColumn("_side", F.sum((brk & (F.col("_seen") > 0)).cast("int")).over(w))
    kept = lines.where(~brk)
    return kept.select(
        key,
        "pos",
        F.when(F.col("_side") > 0, "side").otherwise("main").alias("board"),
        F.when(F.col("_card"), F.regexp_extract("line", r"^\d+ (.*)$", 1)).alias("name"),
        F.when(F.col("_card"), F.regexp_extract("line", r"^(\d+) ", 1).try_cast("bigint")).alias("quantity"),
        F.when(~F.col("_card"), F.lit("unknown line")).alias("problem"),
    )


def line_tree(lines: DataFrame, key: str, pos: str, line: str, levels: dict[str, str]) -> DataFrame:
    """lines with a column per level (name: pattern of its heading): the last heading at or before the line. A heading
    clears the levels below it."""
    w = Window.partitionBy(key).orderBy(pos)
    out, above = lines, None
    for name, pattern in levels.items():
        starts = F.when(F.col(line).rlike(pattern), F.col(pos))
        at = F.last(starts, ignorenulls=True).over(w)
        out = out.withColumn(f"_{name}", at)
        valid = F.col(f"_{name}").isNotNull() if above is None else F.col(f"_{name}") >= F.coalesce(F.col(f"_{above}"), F.lit(-1))
        heading = F.last(F.when(F.col(line).rlike(pattern), F.col(line)), ignorenulls=True).over(w)
        out = out.withColumn(name, F.when(valid, heading))
        above = name
    return out.drop(*(f"_{n}" for n in levels))


def retrieved(facts: DataFrame, text: str, kind: str, terms: list[str], bonus: dict[str, int], k: int, order: list[Column]) -> DataFrame:
    """The k best facts of each kind: three points a stem that occurs plus the kind's bonus; facts without a hit are out."""
    stems = tx.stems(F.col(text), [])
    hits = F.size(F.array_intersect(stems, F.array(*map(F.lit, terms))))
    extra = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in bonus.items() for x in kv)), F.col(kind)), F.lit(0)) if bonus else F.lit(0)
    scored = facts.withColumn("hits", hits).where("hits > 0").withColumn("score", 3 * F.col("hits") + extra)
    return top_per_group(scored, [kind], [F.desc("score"), *order], k)


def spotted(texts: DataFrame, names: DataFrame, key: str, text: str, name: str, longest: int = 6, most: int = 1_000_000) -> DataFrame:
    """Names that occur in each text as whole words, longest first: a word belongs to one name only.

    Phrases of one to `longest` words are joined to names by equality; overlaps are settled from the longest on, and of
    equals from the first on, within each stretch of hits that touch each other, so a long text is no long fold. Texts are dealt by key,
    about 50,000 a task, before phrases are made of them; up to `most` names come to them there, and with more the phrases meet names by a shuffle.
    """
    ws = F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")
    starts = lambda n: F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: i + n <= F.size("w"))
    phrase = lambda i, n: F.struct(i.alias("at"), n.alias("n"), F.array_join(F.slice("w", i + 1, n), " ").alias("phrase"))
    grams = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda n: F.transform(starts(n), lambda i: phrase(i, n))))
    n = texts.count()
    dealt = spread(texts.select(key, text), n, key, each=50_000)
    phrases = dealt.select(key, ws.alias("w")).where(F.size("w") > 0).select(key, F.explode(grams).alias("g")).select(key, "g.*")
    known = written(names.select(F.lower(name).alias("phrase"), F.col(name)).distinct())
    found = phrases.join(F.broadcast(known), "phrase") if known.count() <= most else spread(phrases.join(known, "phrase"), n, key, each=50_000)
    before = Window.partitionBy(key).orderBy("at", F.desc("n"), name).rowsBetween(Window.unboundedPreceding, -1)
    apart = F.when(F.max(F.col("at") + F.col("n")).over(before) > F.col("at"), 0).otherwise(1)
    stretches = found.withColumn("_new", apart).withColumn("_s", F.sum("_new").over(Window.partitionBy(key).orderBy("at", F.desc("n"), name).rowsBetween(Window.unboundedPreceding, 0)))
    spans = stretches.groupBy(key, "_s").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "at", "n", name))).alias("s"))
    none = F.expr(f"cast(array() as array<struct<o:int,at:int,n:int,{name}:string>>)")
    free = lambda acc, x: ~F.exists(acc, lambda y: (y["at"] < x["at"] + x["n"]) & (x["at"] < y["at"] + y["n"]))
    chosen = F.aggregate("s", none, lambda acc, x: F.when(free(acc, x), F.array_append(acc, x)).otherwise(acc))
    return spans.select(key, F.explode(chosen).alias("x")).select(key, F.col("x.at").alias("at"), F.col(f"x.{name}").alias(name))


def longest_prefix(rows: DataFrame, names: DataFrame, text: str, name: str) -> DataFrame:
    """The longest name that each text starts with (null if none): equal on the heads of the text that are as long as a
    name, not by comparing all."""
    known = names.select(name).where(F.length(name) > 0).distinct()
    lengths = known.agg(F.array_sort(F.collect_set(F.length(name)))).scalar()
    heads = rows.select(F.col(text).alias("_t")).distinct().select("_t", F.explode(lengths).alias("_n")).where("_n <= length(_t)").select("_t", F.left("_t", F.col("_n")).alias(name))
    best = heads.join(known, name).groupBy("_t").agg(F.max_by(name, F.length(name)).alias(name))
    return rows.join(best, rows[text] == best["_t"], "left").drop("_t")


def key_values(json: Column, key: str) -> Column:
    """The string and number values of a key at any depth of a JSON text, in order, without repeats.

    One pattern cuts the text into strings with their escapes, numbers, words and signs; a value is what follows the key's
    string and a colon. Null for a null text.
    """
    tokens = F.regexp_extract_all(json, F.lit(r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|-?[0-9][0-9.eE+-]*+|[a-z]++|[{}\[\],:]'), F.lit(0))
    plain = F.transform(tokens, lambda t: F.when(t.startswith('"'), F.get(F.from_json(F.concat(F.lit("["), t, F.lit("]")), "array<string>"), 0)))

    def values(x: Column) -> Column:
        at = lambda i: F.get(x["t"], i)
        told = lambda i: (at(i) == ":") & (F.get(x["s"], i - 1) == key)
        found = F.transform(x["t"], lambda t, i: F.when((i >= 2) & told(i - 1), F.when(t.startswith('"'), F.get(x["s"], i)).when(t.rlike("^[-0-9]"), t)))
        return F.array_distinct(F.filter(found, lambda v: v.isNotNull()))

    both = F.struct(tokens.alias("t"), plain.alias("s"))
    return F.when(json.isNotNull(), F.transform(F.array(both), values)[0])
