"""Claims, citations and answers checked against texts made of documents and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.functions import text as tx
from gleaner.operators import checks
from gleaner.plans.registry import query
from gleaner.session import table

#: Quotes of five kinds: three words with signs around them, too short, absent, cut inside words, and in capitals.
_CLAIMS = """para AS (SELECT doc_id, i - 1 AS idx, s[i] AS text FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents))),
folded AS (SELECT doc_id, idx, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS t FROM para),
one AS (SELECT doc_id, idx, string_split(text, ' ') AS w, text FROM para WHERE idx = doc_id % 3),
claim AS (SELECT doc_id, doc_id % 2 AS hint, CASE doc_id % 5 WHEN 0 THEN '“' || coalesce(w[2], '') || ' ' || coalesce(w[3], '') || ' ' || coalesce(w[4], '') || '…, ' WHEN 1 THEN 'of' WHEN 2 THEN 'never said anywhere' WHEN 3 THEN substr(text, 3, 12) ELSE upper(coalesce(w[1], '') || '  ' || coalesce(w[2], '')) END AS quote FROM one),
needle AS (SELECT doc_id, hint, trim(replace(replace(lower(trim(regexp_replace(quote, '\\s+', ' ', 'g'))), '“', '"'), '…', '...'), ' .,;:!?"''') AS q FROM claim)"""
_HELD = r"contains(t, q) AND regexp_matches(t, '(^|[^\p{L}\p{N}\p{M}_])' || regexp_escape(q) || '($|[^\p{L}\p{N}\p{M}_])')"


def _paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("index", "text"))


def _claims(spark: SparkSession, d: str) -> DataFrame:
    k, w = F.col("doc_id"), lambda n: F.coalesce(F.get(F.split("text", " ", -1), n - 1), F.lit(""))
    quote = F.when(k % 5 == 0, F.concat(F.lit("“"), w(2), F.lit(" "), w(3), F.lit(" "), w(4), F.lit("…, "))).when(k % 5 == 1, "of").when(k % 5 == 2, "never said anywhere")
    quote = quote.when(k % 5 == 3, F.substring("text", 3, 12)).otherwise(tx.upper_simple(F.concat(w(1), F.lit("  "), w(2))))
    return _paragraphs(spark, d).where(F.col("index") == k % 3).select("doc_id", (k % 2).cast("int").alias("hint"), quote.alias("quote"))


@query(
    "located_quotes",
    f"""WITH {_CLAIMS}, f AS (SELECT n.doc_id, arg_min(idx, (idx <> hint, idx)) AS paragraph FROM needle n JOIN folded f ON f.doc_id = n.doc_id AND {_HELD} WHERE length(q) >= 8 GROUP BY 1) SELECT n.doc_id, CAST(paragraph AS INTEGER) AS paragraph FROM needle n LEFT JOIN f USING (doc_id)""",
)
def located_quotes(spark: SparkSession, d: str) -> DataFrame:
    """The paragraph that holds a quote between word boundaries, the hinted one first."""
    return checks.located(_claims(spark, d), _paragraphs(spark, d), "doc_id", "doc_id", "quote", "hint").select("doc_id", "paragraph")


@query(
    "evidence_reasons",
    f"""WITH {_CLAIMS}, f AS (SELECT DISTINCT n.doc_id FROM needle n JOIN folded f ON f.doc_id = n.doc_id AND {_HELD}) SELECT n.doc_id, CASE WHEN length(q) < 8 THEN 'too short' WHEN f.doc_id IS NULL THEN 'not in the source' END AS reason FROM needle n LEFT JOIN f USING (doc_id)""",
)
def evidence_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Why a quote does not count; null if it holds."""
    x = checks.located(_claims(spark, d), _paragraphs(spark, d), "doc_id", "doc_id", "quote", "hint")
    short = F.length(F.trim(checks.folded(F.col("quote")), F.lit(checks.ENDS))) < 8
    return x.select("doc_id", F.when(short, "too short").when(F.col("paragraph").isNull(), "not in the source").alias("reason"))


@query(
    "checked_events",
    f"""
WITH {_CLAIMS}, f AS (SELECT n.doc_id, arg_min(idx, (idx <> hint, idx)) AS paragraph FROM needle n JOIN folded f ON f.doc_id = n.doc_id AND {_HELD} WHERE length(q) >= 8 GROUP BY 1)
SELECT n.doc_id, CASE WHEN paragraph IS NULL THEN 'quote not in page' WHEN n.doc_id % 4 = 0 OR n.doc_id % 4 = 3 THEN 'unlisted participant' END AS reason,
  CASE n.doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'Ana of ' || lang WHEN 2 THEN 'Bo,Ana of ' || lang ELSE 'Bo' END AS known FROM needle n JOIN documents USING (doc_id) LEFT JOIN f ON f.doc_id = n.doc_id
""",
)
def checked_events(spark: SparkSession, d: str) -> DataFrame:
    """events whose quote is in the page and whose participants are all listed, by name or alias."""
    docs, k = table(spark, d, "documents"), F.col("doc_id")
    ana = F.concat(F.lit("Ana of "), "lang")
    entities = docs.select("doc_id", F.explode(F.array(F.struct(F.lit(0).alias("pos"), ana.alias("name"), F.array(F.lit("Annie"), F.lit("Bo")).alias("aliases")), F.struct(F.lit(1).alias("pos"), F.lit(" Bo ").alias("name"), F.array(F.lit("Annie")).alias("aliases")))).alias("e")).select("doc_id", "e.*")
    people = F.when(k % 4 == 0, F.array().cast("array<string>")).when(k % 4 == 1, F.array(F.lit("ANNIE"), F.concat(F.lit("ana  of "), "lang"))).when(k % 4 == 2, F.array(F.lit("bo"), F.lit("Annie"))).otherwise(F.array(F.lit("Bo"), F.lit("Nobody")))
    events = _claims(spark, d).join(docs.select("doc_id", people.alias("participants")), "doc_id")
    out = checks.checked_events(events, _paragraphs(spark, d), checks.known_names(entities, "doc_id"), "doc_id", "doc_id")
    return out.select("doc_id", "reason", F.coalesce(F.array_join("known", ","), F.lit("")).alias("known"))


_SENTENCES = """sent AS (
  SELECT p_partkey AS id, p_brand AS scope, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS pos, p_size % 6 AS kind, p_name, p_type FROM part
)"""


def _sentences(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sentences of six kinds: backed, without cites, an unknown cite, a false quote, a true one with signs, an unknown card."""
    from pyspark.sql import Window

    part = table(spark, d, "part")
    pos = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")) - 1
    name, kind = F.col("p_name"), F.col("p_size") % 6
    text = F.when(kind == 3, F.concat(F.lit('It was "never '), name, F.lit('".'))).when(kind == 4, F.concat(F.lit("It was “"), F.initcap(name), F.lit(".” "))).when(kind == 5, F.concat(F.lit("See [[Old "), name, F.lit("]]."))).otherwise(F.concat(name, F.lit(" [[Plate]]")))
    own = F.concat(F.lit("e"), F.col("p_partkey").cast("string"))
    cites = F.when(kind == 1, F.array(F.lit(" "))).when(kind == 2, F.array(own, F.lit("none"))).otherwise(F.array(F.concat(F.lit(" "), own)))
    sentences = part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("scope"), pos.alias("pos"), text.alias("text"), cites.alias("cites"))
    facts = part.select(F.col("p_brand").alias("scope"), own.alias("fact"), F.concat(F.lit("#"), own).alias("link"), F.concat(F.lit("Said: "), name).alias("quote"))
    return sentences, facts, spark.createDataFrame([("Plate",)], "name string")


@query(
    "checked_sentences",
    f"""WITH {_SENTENCES} SELECT id, CASE WHEN pos >= 6 THEN 'too long' WHEN kind IN (1, 2) THEN 'cites' WHEN kind = 3 THEN 'quote' WHEN kind = 5 THEN 'card' END AS reason FROM sent""",
)
def checked_sentences(spark: SparkSession, d: str) -> DataFrame:
    """sentences that are too many, cite what is not known, quote what no cited fact says, or name unknown cards."""
    return checks.checked_sentences(*_sentences(spark, d), "scope", "id", "pos", 6).select("id", "reason")


@query(
    "backed_sentences",
    f"""WITH {_SENTENCES} SELECT id, '#e' || id AS links FROM sent WHERE kind NOT IN (1, 2)""",
)
def backed_sentences(spark: SparkSession, d: str) -> DataFrame:
    """sentences with text and cites that are all of their own subject, with the links of what they cite."""
    sentences, facts, _ = _sentences(spark, d)
    x = checks.cited(sentences, facts, "scope", "id")
    return x.where(~checks.unbacked(x)).select("id", F.array_join("links", ",").alias("links"))


@query(
    "answer_sentences",
    """SELECT p_partkey, array_to_string(list_filter([CASE WHEN k >= 1 THEN p_name || ' came.|F1' END, CASE WHEN k >= 3 THEN 'Then it "left."|F2,F3' END], lambda x: x IS NOT NULL), ';') AS kept,
  CAST(1 + CASE WHEN k >= 1 THEN 0 ELSE 1 END + CASE WHEN k >= 3 THEN 0 ELSE 1 END + 1 AS INTEGER) AS dropped FROM (SELECT *, p_size % 5 AS k FROM part)""",
)
def answer_sentences(spark: SparkSession, d: str) -> DataFrame:
    """the sentences of an answer that end with labels it was given; those without, with unknown ones and a rest are dropped."""
    body = F.concat("p_name", F.lit(' came [F1]. Nobody said so! Then it "left." [F2] [F3][F2]\nA tail.'))
    known = F.transform(F.sequence(F.lit(0), F.col("p_size") % 5), lambda i: F.concat(F.lit("F"), i.cast("string")))
    out = checks.answer_sentences(table(spark, d, "part").select("p_partkey", body.alias("body"), known.alias("labels")), "p_partkey", "body", "labels")
    told = F.array_join(F.transform("sentences", lambda s: F.concat_ws("|", s["sentence"], F.array_join(s["cites"], ","))), ";")
    return out.select("p_partkey", told.alias("kept"), "dropped")
