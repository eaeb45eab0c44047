"""Checks of written claims against their sources: quotes in paragraphs, names, citations, answers with labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.functions import text as tx
from gleaner.operators.priority import first_per_key

#: Typographic signs and the plain ones they are compared as, and what a quote's ends may lose.
SIGNS = ("‘’“”—–", "''\"\"--")
ENDS = " .,;:!?\"'"
#: Letters, digits and marks of a word, in any script.
WORD = r"[\p{L}\p{N}\p{M}_]"


def folded(x: Column) -> Column:
    """Text as quotes are compared: one form of each character, plain signs, single spaces, lower case."""
    plain = F.replace(F.translate(tx.nfkc(x), *SIGNS), F.lit("…"), F.lit("..."))
    return F.lower(F.trim(F.regexp_replace(plain, r"(?U)\s+", " ")))


def on_words(text: Column, needle: Column) -> Column:
    """Whether needle is in text with no word going on at either end. Only texts that contain it meet the pattern."""
    literal = F.concat(F.lit(rf"(?<!{WORD})\Q"), F.replace(needle, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit(rf"\E(?!{WORD})"))
    return F.when(F.contains(text, needle), F.rlike(text, literal)).otherwise(F.lit(False))


def located(claims: DataFrame, paragraphs: DataFrame, page: str, claim: str, quote: str, hint: str, least: int = 8) -> DataFrame:
    """claims with the paragraph (its index) that holds the quote word for word: the one hinted at, else the first; null if
    none does or the quote is shorter than least. paragraphs: page, index, text; claim is unique."""
    q = F.trim(folded(F.col(quote)), F.lit(ENDS))
    x = claims.select(claim, page, F.col(hint).alias("_h"), q.alias("_q")).where(F.length("_q") >= least)
    held = x.join(paragraphs.select(page, "index", folded(F.col("text")).alias("_t")), page).where(on_words(F.col("_t"), F.col("_q")))
    best = first_per_key(held.select(claim, "index", "_h"), [claim], [~F.col("index").eqNullSafe(F.col("_h")), F.col("index")])
    return claims.join(best.select(claim, F.col("index").alias("paragraph")), claim, "left")


def known_names(entities: DataFrame, page: str) -> DataFrame:
    """(page, folded, name): every name and alias of a page's entities (page, pos, name, aliases). A name is its own; of
    aliases that several entities have, the first's counts."""
    e = entities.withColumn("name", F.trim("name")).where("name <> ''")
    own = e.select(page, folded(F.col("name")).alias("folded"), F.lit(0).alias("rank"), "pos", "name")
    other = e.select(page, "pos", "name", F.explode("aliases").alias("a")).select(page, folded(F.col("a")).alias("folded"), F.lit(1).alias("rank"), "pos", "name")
    return first_per_key(own.union(other).where("folded <> ''"), [page, "folded"], [F.col("rank"), F.col("pos")]).select(page, "folded", "name")


def with_known(claims: DataFrame, names: DataFrame, page: str, claim: str, listed: str) -> DataFrame:
    """claims with the known names of array column listed, in order and without repeats (known), and how many are unknown."""
    x = claims.select(claim, page, F.posexplode(listed).alias("_i", "_n")).select(claim, page, "_i", folded(F.col("_n")).alias("folded"))
    got = x.join(names, [page, "folded"], "left").groupBy(claim).agg(F.array_sort(F.collect_list(F.struct("_i", "name"))).alias("_k"), F.count_if(F.col("name").isNull()).alias("unknown"))
    known = F.array_distinct(F.filter(F.transform("_k", lambda k: k["name"]), lambda n: n.isNotNull()))
    return claims.join(got.select(claim, known.alias("known"), "unknown"), claim, "left")


def checked_events(events: DataFrame, paragraphs: DataFrame, names: DataFrame, page: str, event: str) -> DataFrame:
    """events (quote, hint, participants) with paragraph, known participants, and the reason why one does not count."""
    x = with_known(located(events, paragraphs, page, event, "quote", "hint"), names, page, event, "participants")
    reason = F.when(F.col("paragraph").isNull(), "quote not in page").when(F.col("unknown").isNull() | (F.col("unknown") > 0), "unlisted participant")
    return x.withColumn("reason", reason)


def cited(sentences: DataFrame, facts: DataFrame, scope: str, sentence: str) -> DataFrame:
    """sentences (scope, text, cites) with their trimmed cites, how many are unknown, and the links and quotes of the known
    ones in order. facts: scope, fact, link, quote."""
    clean = F.filter(F.transform("cites", lambda c: F.trim(c)), lambda c: c != "")
    x = sentences.withColumn("cites", F.coalesce(clean, F.array().cast("array<string>"))).withColumn("text", F.trim(F.coalesce("text", F.lit(""))))
    each = x.select(sentence, scope, F.posexplode("cites").alias("_i", "fact")).join(facts, [scope, "fact"], "left")
    got = each.groupBy(sentence).agg(F.array_sort(F.collect_list(F.struct("_i", "link", "quote"))).alias("_f"), F.count_if(F.col("link").isNull()).alias("unknown"))
    part = lambda c: F.filter(F.transform("_f", lambda f: f[c]), lambda v: v.isNotNull()).alias(f"{c}s")
    return x.join(got.select(sentence, part("link"), part("quote"), "unknown"), sentence, "left")


def unbacked(x: DataFrame) -> Column:
    """Whether a sentence of cited() has no text, no cite or an unknown one."""
    return (F.col("text") == "") | (F.size("cites") == 0) | (F.coalesce("unknown", F.lit(0)) > 0)


def checked_sentences(sentences: DataFrame, facts: DataFrame, cards: DataFrame, scope: str, sentence: str, pos: str, most: int) -> DataFrame:
    """sentences with the reason why one does not count: beyond the most, cites, a quote that no cited fact has, or a card in
    double brackets that cards (name) does not list."""
    x = cited(sentences, facts, scope, sentence)
    inside = F.transform(F.regexp_extract_all("text", F.lit("\"([^\"]+)\"|“([^”]+)”"), F.lit(0)), lambda q: F.lower(F.trim(F.substr(q, F.lit(2), F.length(q) - 2), F.lit(" .,!?"))))
    sources = F.lower(F.array_join(F.coalesce("quotes", F.array().cast("array<string>")), " "))
    named = x.select(sentence, F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\[\[([^\[\]]*)\]\]"), F.lit(1)))).alias("name"))
    wrong = named.join(cards.select("name"), "name", "left_anti").select(sentence).distinct().withColumn("_card", F.lit(True))
    x = x.withColumn("_quotes", inside).withColumn("_sources", sources).join(wrong, sentence, "left")
    reason = F.when(F.col(pos) >= most, "too long").when(unbacked(x), "cites").when(~F.forall("_quotes", lambda q: F.contains("_sources", q)), "quote").when(F.col("_card"), "card")
    return x.withColumn("reason", reason).drop("_quotes", "_sources", "_card")


#: A sentence of an answer: its text, its labels, and the sign after them.
_CITED = r"([^\[]*?[^\s\[][^\[]*?)((?:\s*+\[F\d++\])++)\s*([.!?…]?)(?=\s|$)"


def answer_sentences(answers: DataFrame, key: str, text: str, labels: str) -> DataFrame:
    """The sentences of each answer that end with labels it was given (array column labels): key, block, position, sentence,
    cites; and a row per block with what was dropped: sentences without labels, with unknown ones, and a rest."""
    blocks = answers.select(key, F.col(labels).alias("_known"), F.posexplode(F.split(text, r"\n\s*\n")).alias("block", "_b"))
    group = lambda n: F.regexp_extract_all("_b", F.lit(_CITED), F.lit(n))
    found = F.arrays_zip(group(1).alias("said"), group(2).alias("ids"), group(3).alias("sign"))
    pieces = lambda m: F.split(F.trim(m["said"]), r"(?<=[.!?…]|[.!?…][\"”’'])\s+")
    cites = lambda m: F.array_distinct(F.regexp_extract_all(m["ids"], F.lit(r"F\d+"), F.lit(0)))
    made = F.transform(found, lambda m: F.struct(F.trim(F.concat(F.element_at(pieces(m), -1), m["sign"])).alias("sentence"), cites(m).alias("cites"), (F.size(pieces(m)) - 1).alias("loose")))
    x = blocks.select(key, "block", "_known", made.alias("_m"), (F.trim(F.element_at(F.split("_b", _CITED, -1), -1), F.lit(" \n\t")) != "").cast("int").alias("_rest"))
    fits = F.filter("_m", lambda m: F.forall(m["cites"], lambda c: F.array_contains("_known", c)))
    loose = F.aggregate("_m", F.lit(0), lambda n, m: n + m["loose"])
    return x.select(key, "block", fits.alias("sentences"), (loose + F.size("_m") - F.size(fits) + F.col("_rest")).alias("dropped"))
