"""Personal data by patterns, checksums and context, in DataFrame functions only.

A pattern proposes spans, leftmost and without overlap per kind. A validator confirms them: Luhn for
cards, the range of parts for addresses, the number of digits for phones, mod 97 for IBANs, areas and groups
in use for national ids. A kind's words near a span raise its score: whole words, within the kind's own
number of characters before and after the span. Spans of the four base kinds that pass are always kept, and
their score is for the caller; the other kinds must reach MIN_SCORE and must not touch a letter, digit or hyphen.

The patterns are written without backtracking (possessive, anchored at the start of a run), which
finds the same spans as the plain forms and stays linear on long runs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import work

MIN_SCORE = 0.6
#: Areas, groups and serial numbers that no national id has.
UNUSED_ID = "^(000|666|9)|-00-|-0000$"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right: every second digit from the right counts twice, digit by digit."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether a code, its first four characters moved to the end and letters as 10 to 35, is 1 modulo 97."""
    moved = F.concat(F.substring(code, F.lit(5), F.length(code) - 4), F.substring(code, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        n = F.ascii(c)
        return F.when(n >= 65, (rest * 100 + n - 55) % 97).otherwise((rest * 10 + n - 48) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), add) == 1


def _byte_parts(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda p: p.rlike("^0*([0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))


@dataclass(frozen=True)
class Kind:
    """``score`` of a confirmed span; ``boost`` is added when a ``near`` word lies wholly within ``before`` or ``after`` characters."""

    name: str
    pattern: str
    marker: str
    valid: Callable[[Column], Column] | None
    score: float
    boost: float
    near: str
    before: int
    after: int
    base: bool = True


#: Base patterns, kinds in the order of reports, context words.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", None,
         0.8, 0.2, "e?mail|contact|write|schreiben|correo|courriel", 40, 0),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", ".", _byte_parts, 0.6, 0.3, "ip|address|host|server|adresse", 40, 0),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", lambda m: F.length(_digits(m)).between(16, 19) & luhn(_digits(m)),
         0.8, 0.2, "cards?|visa|mastercard|credit|kreditkarte|karte|carte|tarjeta", 40, 20),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", lambda m: F.length(_digits(m)).between(8, 15),
         0.7, 0.2, "(?:tele)?phone|call|tel|mobile|fax|handy", 30, 10),
    Kind("iban", r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", "", mod97, 0.9, 0.1, "iban|account|bank|konto|compte|cuenta", 40, 0, False),
    Kind("national_id", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "-", lambda m: ~m.rlike(UNUSED_ID),
         0.4, 0.5, "ssn|social security|steuernummer|identity|nss|nif", 40, 15, False),
)


def proposals(text: Column, kind: Kind) -> Column:
    """(match, start) of each proposal, in code points: what the pattern splits and what it takes alternate."""
    taken = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    between = F.split(text, kind.pattern, -1)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<m:string,s:long>>").alias("found"))

    def step(held: Column, pair: Column) -> Column:
        at = held["at"] + F.length(pair["g"])
        return F.struct((at + F.length(pair["m"])).alias("at"), F.concat(held["found"], F.array(F.struct(pair["m"].alias("m"), at.alias("s")))).alias("found"))

    pairs = F.arrays_zip(taken.alias("m"), F.slice(between, F.lit(1), F.size(taken)).alias("g"))
    found = F.aggregate(pairs, start, step)["found"]
    none = F.array().cast("array<struct<m:string,s:long>>")
    wanted = F.contains(text, F.lit(kind.marker)) if kind.marker else text.rlike("[0-9][0-9]|[0-9][ -][0-9]")
    return F.when(wanted, found).otherwise(none)


def context(text: Column, start: Column, end: Column, kind: Kind) -> Column:
    """Lower-cased text around a span, the span itself as one space.

    Each side carries one character more than the kind's window, or a space at the text's edge, so a
    word that the window cuts has no boundary there and does not count.
    """
    left = F.concat(F.when(start <= kind.before, " ").otherwise(""), F.substring(
        text, (F.greatest(start - kind.before - 1, F.lit(0)) + 1).cast("int"), F.least(start, F.lit(kind.before + 1)).cast("int")))
    right = F.concat(F.substring(text, (end + 1).cast("int"), F.lit(kind.after + 1)),
                     F.when(F.length(text) - end <= kind.after, " ").otherwise(""))
    return F.lower(F.concat(left, F.lit(" "), right))


def _near(kind: Kind) -> str:
    return f"[^a-z](?:{kind.near})[^a-z]"


def _apart(text: Column, start: Column, end: Column) -> Column:
    """Whether a span touches no letter, digit or hyphen."""
    sides = F.concat(F.when(start > 0, F.substring(text, start.cast("int"), F.lit(1))).otherwise(""),
                     F.substring(text, (end + 1).cast("int"), F.lit(1)))
    return ~sides.rlike("[A-Za-z0-9-]")


def spans(text: Column, kind: Kind, found: Column) -> Column:
    """Confirmed proposals as (kind, start, end, score)."""
    kept = F.filter(found, lambda x: kind.valid(x["m"])) if kind.valid else found
    if not kind.base:
        kept = F.filter(kept, lambda x: _apart(text, x["s"], x["s"] + F.length(x["m"])))
    scored = F.transform(kept, lambda x: F.struct(
        F.lit(kind.name).alias("kind"), x["s"].alias("start"), (x["s"] + F.length(x["m"])).alias("end"),
        F.when(context(text, x["s"], x["s"] + F.length(x["m"]), kind).rlike(_near(kind)),
               kind.score + kind.boost).otherwise(kind.score).alias("score")))
    return scored if kind.base else F.filter(scored, lambda x: x["score"] >= MIN_SCORE)


def find(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``carry`` columns and, for each kind, a column of its confirmed spans. A null text has none."""
    out = docs.select(*carry, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text_"))
    out = out.select("*", *(proposals(F.col("text_"), k).alias(f"proposed_{k.name}") for k in KINDS))
    return out.select(*carry, *(spans(F.col("text_"), k, F.col(f"proposed_{k.name}")).alias(f"found_{k.name}") for k in KINDS))


def report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: counts of the base kinds, the digest of their spans, and all spans with scores."""
    found = find(docs, ["doc_id"])

    def joined(kinds: list[Kind], show: Callable[[Column], Column]) -> Column:
        return F.array_join(F.flatten(F.array(*(F.transform(f"found_{k.name}", show) for k in kinds))), ",")

    def place(x: Column) -> Column:
        return F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))

    base = [k for k in KINDS if k.base]
    return found.select(
        "doc_id", *(F.size(f"found_{k.name}").cast("long").alias(f"n_{k.name}") for k in base),
        F.sha2(joined(base, place), 256).alias("base_sha256"), joined(list(KINDS), place).alias("spans"),
        joined(list(KINDS), lambda x: F.format_number(x["score"], 2)).alias("scores"))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(work.table(spark, sf_dir, "documents"))


def _sql() -> str:
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", "national_id": r"[0-9]{3}-[0-9]{2}-[0-9]{4}"}
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    digit = f"substr({digits}, len({digits}) - i, 1)::int"
    luhn_sql = f"list_sum([CASE WHEN i % 2 = 0 THEN {digit} ELSE {digit} * 2 // 10 + {digit} * 2 % 10 END FOR i IN range(len({digits}))]) % 10 = 0"
    numbers = "array_to_string([CASE WHEN ord(c) >= 65 THEN (ord(c) - 55)::varchar ELSE c END FOR c IN string_split(substr(m, 5) || substr(m, 1, 4), '')], '')"
    rest = (f"list_reduce([0::bigint] || [c::bigint FOR c IN string_split({numbers}, '')], lambda a, b: (a * 10 + b) % 97) = 1")
    valid = {
        "national_id": f"NOT regexp_matches(m, '{UNUSED_ID}')", "ip": "len([p FOR p IN string_split(m, '.') IF len(ltrim(p, '0')) > 3 OR coalesce(try_cast(right(p, 18) AS bigint), 999) > 255]) = 0",
        "card": f"len({digits}) BETWEEN 16 AND 19 AND {luhn_sql}", "phone": f"len({digits}) BETWEEN 8 AND 15", "iban": rest}
    around = ("(CASE WHEN s <= {b} THEN ' ' ELSE '' END) || substr(text, greatest(s - {b} - 1, 0) + 1, least(s, {b} + 1)) || ' ' || "
              "substr(text, s + length(m) + 1, {a} + 1) || (CASE WHEN length(text) - s - length(m) <= {a} THEN ' ' ELSE '' END)")
    apart = (" AND NOT regexp_matches((CASE WHEN s > 0 THEN substr(text, s, 1) ELSE '' END) || substr(text, s + length(m) + 1, 1), "
             "'[A-Za-z0-9-]')")
    ctes = ["t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents)"]
    for i, k in enumerate(KINDS):
        ctes.append(f"""p{i} AS (
  SELECT r, text, g, ms, unnest(range(1, len(ms) + 1)) AS j FROM (
    SELECT r, text, regexp_extract_all(text, '{plain[k.name]}') AS ms, string_split_regex(text, '{plain[k.name]}') AS g FROM t)),
s{i} AS (
  SELECT r, text, ms[j] AS m, (list_sum([length(x) FOR x IN g[1:j]]) + coalesce(list_sum([length(x) FOR x IN ms[1:j - 1]]), 0))::bigint AS s FROM p{i}),
f{i} AS (
  SELECT r, {i} AS k, '{k.name}' AS kind, s, s + length(m) AS e,
    CASE WHEN regexp_matches(lower({around.format(b=k.before, a=k.after)}), '{_near(k)}')
         THEN {round(k.score + k.boost, 2)} ELSE {k.score} END AS score
  FROM s{i} WHERE {valid.get(k.name, 'true')}{'' if k.base else apart})""")
    keep = " UNION ALL ".join(f"SELECT * FROM f{i}" + ("" if k.base else f" WHERE score >= {MIN_SCORE}") for i, k in enumerate(KINDS))
    counts = ", ".join(f"coalesce(n_{k.name}, 0)::bigint AS n_{k.name}" for k in KINDS if k.base)
    sums = ", ".join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in KINDS if k.base)
    bases = sum(k.base for k in KINDS)
    place = "kind || ':' || s || ':' || e"
    return f"""WITH {', '.join(ctes)}, a AS ({keep}),
g AS (SELECT r, {sums}, string_agg({place}, ',' ORDER BY k, s) FILTER (k < {bases}) AS b,
        string_agg({place}, ',' ORDER BY k, s) AS spans, string_agg(format('{{:.2f}}', score), ',' ORDER BY k, s) AS scores FROM a GROUP BY r)
SELECT doc_id, {counts}, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM t LEFT JOIN g ON t.r = g.r"""


SQL = _sql()
