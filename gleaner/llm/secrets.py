"""Secret scan: patterned secrets plus windows of high Shannon entropy, in DataFrame functions only.

Patterned spans (assign, access, hex) come from regular expressions. Candidate strings of each character class are
then slid over with a window whose entropy follows from counts updated by one character in and one out; a candidate
with a window that reaches its class's threshold is a span of kind entropy, unless the allow-list names it or another
span overlaps it. Offsets are code points, ends exclusive.

Time grows in proportion to a text, also where it is one long run or holds a secret a line: a found span's characters
are replaced by twins of theirs outside all classes but those of the later patterns, so that whether a later match
overlaps a span is seen in the match itself, and running offsets are summed in blocks. No pattern repeats a group, as
Java's regular expressions go a stack frame deeper with each such repeat.

Null and empty texts have no spans. Repeated rows give repeated results. Only key and text are read.
"""

from __future__ import annotations

from math import floor, log2

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.common import let

KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
#: Distance between a character and its twin, and the characters that have one: all that a span can hold.
TWIN, PLAIN = 0xE000, "".join(map(chr, range(0x20, 0x7F)))
TWINS = "".join(chr(TWIN + ord(c)) for c in PLAIN)
#: Matches whose offsets are summed in one fold.
BLOCK = 512
#: Fixed-point entropy: c * log2(c) in units of 2**-40, so that sums by steps are exact.
UNIT = 1 << 40


def _class(ranges: str, twins: bool) -> str:
    """A class of the ranges (two characters each), with their twins if wanted."""
    ends = [(ranges[i], ranges[i + 1]) for i in range(0, len(ranges), 2)]
    quoted = lambda c: f"\\{c}" if not c.isalnum() and ord(c) < TWIN else c
    return "[" + "".join(f"{quoted(chr(ord(a) + t))}-{quoted(chr(ord(b) + t))}" for t in (0, TWIN)[: 1 + twins] for a, b in ends) + "]"


def _access(twins: bool) -> str:
    return ("".join(_class(c + c, True) for c in "AKIA") if twins else "AKIA") + _class("AZ09", twins) + "{16,}"


def _hex(twins: bool) -> str:
    return _class("09af", twins) + "{24,}"


#: Patterns of the contract; the least lengths of access and hex are part of theirs.
ASSIGN, LEAST_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6
#: Characters, pattern of candidate runs and the entropy in bits that a window must reach.
CLASSES = [
    ("0123456789abcdefABCDEF", lambda twins: _class("09AFaf", twins) + "{20,}", 3.0),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=", lambda twins: _class("AZaz09++//__--", twins) + "{20,}" + _class("==", twins) + "{0,2}", 3.9),
]
#: Candidates that are never secrets: numbers, words and paths of words, and marked examples.
ALLOWED, MARKED = r"^(?:[0-9]++|[a-z][a-z/_+-]*+)$", ("example", "sample", "dummy", "placeholder", "xxxx")

_SPAN = "struct<s:int,k:int,e:int>"


def _none() -> Column:
    return F.expr(f"cast(array() as array<{_SPAN}>)")


def running(gaps: Column, sizes: Column) -> Column:
    """(s, e) of each match, from the lengths of the parts before them and their own. Summed over blocks, then inside each."""
    rows = F.arrays_zip(gaps.alias("p"), sizes.alias("m"))
    block = lambda z, b: F.slice(z, b * BLOCK + 1, BLOCK)

    def inside(z: Column, b: Column, at: Column) -> Column:
        start = F.struct(at.alias("at"), F.expr("cast(array() as array<struct<s:int,e:int>>)").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            s = acc["at"] + x["p"]
            return F.struct((s + x["m"]).alias("at"), F.array_append(acc["out"], F.struct(s.alias("s"), (s + x["m"]).alias("e"))).alias("out"))

        return F.aggregate(block(z, b), start, step)["out"]

    def over(z: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(z) - 1) / BLOCK).cast("int"))
        total = F.transform(blocks, lambda b: F.aggregate(block(z, b), F.lit(0), lambda acc, x: acc + x["p"] + x["m"]))
        before = F.aggregate(total, F.array(F.lit(0)), lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n))
        return let(before, lambda at: F.flatten(F.transform(blocks, lambda b: inside(z, b, F.get(at, b)))))

    return let(rows, over)


def codes(candidate: Column, characters: str) -> Column:
    """A number for each character: twelve lanes of five bits fill one count, 64 * (which count) + (first bit)."""
    table = F.array(*(F.lit(i // 12 * 64 + i % 12 * 5) for i in range(len(characters))))
    return F.transform(F.filter(F.split(candidate, ""), lambda c: c != ""), lambda c: F.element_at(table, F.instr(F.lit(characters), c)))


def reaches(codes: Column, threshold: float, counts: int = 6, window: int = WINDOW) -> Column:
    """Whether a window of codes has a Shannon entropy of threshold bits or more, by incremental counts."""
    weight = [round(c * log2(c) * UNIT) if c else 0 for c in range(window + 2)]
    gain = F.array(*(F.lit(b - a).cast("long") for a, b in zip(weight, weight[1:])))
    most = floor((log2(window) - threshold) * window * UNIT)
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), counts).alias("c"), F.lit(0).cast("long").alias("s"), F.lit(False).alias("found"))
    place, lane = lambda v: F.shiftright(v, 6), lambda v: v.bitwiseAND(F.lit(63))
    count = lambda c, v: F.call_function("shiftright", F.get(c, place(v)), lane(v)).bitwiseAND(F.lit(31).cast("long")).cast("int")
    one = lambda v, k: F.when(k == place(v), F.call_function("shiftleft", F.lit(1).cast("long"), lane(v))).otherwise(F.lit(0).cast("long"))

    def over(x: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            def move(at: Column) -> Column:
                new, old, c = at["new"], at["old"], acc["c"]
                s = acc["s"] + F.element_at(gain, count(c, new) + 1) - F.when(old.isNull(), F.lit(0).cast("long")).otherwise(F.element_at(gain, count(c, old)))
                moved = F.transform(c, lambda v, k: v + one(new, k) - F.when(old.isNull(), F.lit(0).cast("long")).otherwise(one(old, k)))
                return let(s, lambda s: F.struct(moved.alias("c"), s.alias("s"), ((i >= window - 1) & (s <= most)).alias("found")))

            at = F.struct(F.get(x, i).alias("new"), F.when(i >= window, F.get(x, i - window)).alias("old"))
            return F.when(acc["found"] | (F.coalesce(F.get(x, i - window), F.lit(-1)) == F.get(x, i)), acc).otherwise(let(at, move))

        return F.aggregate(F.sequence(F.lit(0), F.size(x) - 1), start, step)["found"]

    # A window of n characters has at most log2(n) bits, so few different ones need no look.
    return let(codes, lambda x: F.when(F.size(F.array_distinct(x)) < 2**threshold, F.lit(False)).otherwise(over(x)))


def _marked(wanted: Column, kind: int) -> tuple[Column, Column]:
    """From columns p (parts) and m (matches between them): the text with the wanted matches as twins, and their spans."""
    found = F.arrays_zip(F.col("p").alias("p"), F.col("m").alias("m"), wanted.alias("y"))
    head = F.transform(F.filter(found, lambda x: x["m"].isNotNull()), lambda x: F.concat(x["p"], F.when(x["y"], F.translate(x["m"], PLAIN, TWINS)).otherwise(x["m"])))
    text = F.concat(F.array_join(head, ""), F.element_at("p", -1))
    lengths = lambda c: F.transform(c, lambda x: F.length(x))
    at = running(lengths(F.slice("p", 1, F.size("m"))), lengths(F.col("m")))
    kept = F.filter(F.arrays_zip(at.alias("at"), wanted.alias("y")), lambda x: x["y"])
    return text, F.transform(kept, lambda x: F.struct(x["at"]["s"].alias("s"), F.lit(kind).alias("k"), x["at"]["e"].alias("e")))


def _pass(df: DataFrame, make, kind: int, into: str, wanted) -> DataFrame:
    """df (columns t and others) with the spans of a pattern's wanted matches added to array column into and marked in t.

    make gives the pattern with or without twins; a text without spans has none, and the plain classes are quicker. wanted
    makes a boolean of each match from t and m. Texts without a match skip every step.
    """
    rest = [c for c in df.columns if c not in ("t", into)]
    plain, pattern = make(False), make(True)
    hit = F.when((F.size("base") == 0) & (F.size("added") == 0), F.col("t").rlike(plain)).otherwise(F.col("t").rlike(pattern))
    none = F.expr("cast(null as array<string>)")
    x = df.select(*rest, "t", into, F.when(hit, F.regexp_extract_all("t", F.lit(pattern), F.lit(0))).otherwise(none).alias("m"))
    x = x.select(*rest, "t", into, "m", F.when(F.col("m").isNotNull(), wanted(F.col("t"), F.col("m"))).alias("y"))
    x = x.select(*rest, "t", into, "m", "y", F.when(F.exists("y", lambda y: y), F.split("t", pattern, -1)).alias("p"))
    text, spans = _marked(F.col("y"), kind)
    some = F.col("p").isNotNull()
    return x.select(*rest, F.when(some, text).otherwise(F.col("t")).alias("t"), F.when(some, F.concat(into, spans)).otherwise(F.col(into)).alias(into))


def _secret(characters: str, threshold: float):
    """Whether a match is a candidate: no twin, so no other span's, not allowed, and of enough entropy."""

    def one(m: Column) -> Column:
        low = F.lower(m)
        named = low.rlike(ALLOWED)
        for word in MARKED:
            named |= F.contains(low, F.lit(word))
        return F.when(m.rlike(f"[{TWINS[0]}-{TWINS[-1]}]"), F.lit(False)).when(named, F.lit(False)).otherwise(reaches(codes(m, characters), threshold, -(-len(characters) // 12)))

    return lambda t, m: F.transform(m, one)


def _found(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: key, text t whose spans are twins, base and added spans."""
    own = f"[{TWINS[0]}-{TWINS[-1]}]"  # such characters of the text itself: a line end is in no pattern either
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(F.col(key), F.when(t.rlike(own), F.regexp_replace(t, own, "\n")).otherwise(t).alias("t"), _none().alias("base"), _none().alias("added"))
    every = lambda t, m: F.transform(m, lambda x: F.lit(True))
    long = lambda t, m: F.transform(F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)), lambda x: F.length(x) >= LEAST_ASSIGN)
    df = _pass(_pass(_pass(df, lambda twins: ASSIGN, 0, "base", long), _access, 1, "base", every), _hex, 2, "base", every)
    for characters, make, threshold in CLASSES:
        df = _pass(df, make, 3, "added", _secret(characters, threshold))
    return df


def find(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, base and added spans, each an array of (start s, kind index k, end e) in order."""
    return _found(docs.select(F.col(key).alias("k"), F.col(text).alias("x")), "k", "x").select(F.col("k").alias(key), F.array_sort("base").alias("base"), F.array_sort("added").alias("added"))


def _joined(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def report(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: spans of each patterned kind, their digest, the added spans and all spans."""
    found = find(docs, key=key, text=text)
    n = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select(
        key,
        *(n(k).alias(f"n_{KINDS[k]}") for k in range(3)),
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_entropy"),
    )


def masked(docs: DataFrame, *, key: str = "doc_id", text: str = "text", mask: str = "[secret]") -> DataFrame:
    """key and text with every span replaced by mask; spans that overlap or touch are replaced together.

    A text that itself holds characters of the twins' range is cut by its spans' offsets, in time that grows with their
    number times its length; all others are replaced at once.
    """
    own = f"[{TWINS[0]}-{TWINS[-1]}]+"
    found = _found(docs.select(F.struct(F.col(key).alias("key"), F.col(text).alias("text")).alias("k"), F.col(text).alias("x")), "k", "x")
    raw = F.coalesce(F.col("k.text"), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit(-1).alias("end"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        piece = F.when(x["s"] > acc["end"], F.concat(acc["out"], F.substring(raw, acc["at"] + 1, x["s"] - acc["at"]), F.lit(mask))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.greatest(acc["end"], x["e"]).alias("end"), piece.alias("out"))

    cut = let(F.aggregate(F.array_sort(F.concat("base", "added")), start, step), lambda a: F.concat(a["out"], F.substring(raw, a["at"] + 1, F.length(raw))))
    quoted = mask.replace("\\", "\\\\").replace("$", "\\$")
    out = F.when(raw.rlike(own), cut).otherwise(F.regexp_replace("t", own, quoted))
    return found.select(F.col("k.key").alias(key), F.when(F.col("k.text").isNotNull(), out).alias(text))


def _sql() -> str:
    """SQL for the rows of report() over table documents: each pattern's matches with offsets, entropy of every window."""
    assign = r"""(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    patterns = [("assign", assign, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24), ("c1", "[0-9A-Fa-f]{20,}", 0, 20), ("c2", "[A-Za-z0-9+/_-]{20,}={0,2}", 0, 20)]
    tables = [
        f"""{name} AS (SELECT r, i, m, s - length(m) AS s, s AS e FROM (
  SELECT *, sum(length(p) + length(m)) OVER (PARTITION BY r ORDER BY i) AS s FROM (
    SELECT r, unnest(regexp_split_to_array(x, '{p}')[:len(f)]) AS p, unnest(f) AS m, unnest(regexp_extract_all(x, '{p}', {group})) AS g, generate_subscripts(f, 1) AS i
    FROM (SELECT r, x, regexp_extract_all(x, '{p}') AS f FROM t))) WHERE length(g) >= {least})"""
        for name, p, group, least in patterns
    ]
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
{", ".join(tables)},
base AS (SELECT r, s, 0 AS k, e FROM assign UNION ALL SELECT r, s, 1, e FROM access UNION ALL SELECT r, s, 2, e FROM hex),
cand AS (SELECT *, 3.0 AS least, 1 AS n FROM c1 UNION ALL SELECT *, 3.9, 2 FROM c2),
open AS (
  SELECT r, s, e, m, least, n FROM cand c WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = c.r AND b.s < c.e AND c.s < b.e)
  AND NOT regexp_matches(m, '^([0-9]+|[A-Za-z][A-Za-z/_+-]*)$') AND NOT regexp_matches(lower(m), 'example|sample|dummy|placeholder|xxxx')
),
windows AS (SELECT r, s, n, least, i, m[i + j] AS c FROM (SELECT *, unnest(range(1, length(m) - 18)) AS i FROM open), range(20) v(j)),
counts AS (SELECT r, s, n, least, i, c, count(*) AS k FROM windows GROUP BY ALL),
high AS (SELECT DISTINCT r, s, n FROM (SELECT r, s, n, least, i, -sum(k / 20 * log2(k / 20)) AS h FROM counts GROUP BY r, s, n, least, i) WHERE h >= least - 1e-9),
found AS (SELECT r, s, e, n FROM open JOIN high USING (r, s, n)),
added AS (SELECT r, s, 3 AS k, e FROM found f WHERE n = 1 OR NOT EXISTS (SELECT 1 FROM found g WHERE g.n = 1 AND g.r = f.r AND g.s < f.e AND f.s < g.e)),
told AS (SELECT r, s, k, e, ['assign', 'access', 'hex', 'entropy'][k + 1] || ':' || s || ':' || e AS x FROM (SELECT * FROM base UNION ALL SELECT * FROM added)),
per AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex, count(*) FILTER (k = 3) AS n_entropy,
    string_agg(x, ',' ORDER BY s, k) FILTER (k < 3) AS base, string_agg(x, ',' ORDER BY s, k) AS spans
  FROM told GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_entropy, 0) AS n_entropy
FROM t LEFT JOIN per USING (r)
"""


#: DuckDB SQL for the rows of report() over table documents.
SQL = _sql()
