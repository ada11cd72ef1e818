"""Personal data: patterns propose, checksums confirm, context words adjust the score (DataFrame functions only).

Matches of a kind are leftmost and do not overlap; positions are code points, the end exclusive. The
patterns carry possessive quantifiers and start only where a run of their characters starts (or where
the last match ended), which gives the same matches as the plain forms of the contract while a long
run of digits or letters costs linear time and no stack. Positions come from the lengths of the
pieces between matches, summed in blocks, so a text with a hundred thousand matches is still fine.

Base kinds (email, ip, card, phone) are always reported. Added kinds: ``iban`` (mod-97 passes) and ``ssn`` (no
checksum exists, so it needs a context word). Each span's score starts from its kind's prior and rises by
CONTEXT_GAIN if one of the kind's context words stands in the CONTEXT_CHARS characters before or behind it, no further than to the second match of
the kind on that side.

An IBAN's length is its country's, so letters behind it don't spoil it; codes that are not in the public registry's list below are not looked for.

A null text counts as empty; ids may be null or repeat; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT_CHARS = 48
CONTEXT_GAIN = 0.2
ADDED_MIN_SCORE = 0.5
#: Matches whose lengths are summed together when positions are computed.
_BLOCK = 64

# Lengths of IBANs by country, from the public registry.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())

# Kinds in the order of the contract, then added ones; pattern, prior score, context words.
KINDS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.8, "email|e-mail|mail|contact|write"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", 0.6, "ip|address|host|server|login"),
    "card": (r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++", 0.7, "card|visa|mastercard|amex|credit|debit|pay"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, "phone|tel|call|mobile|fax|whatsapp"),
    "iban": (rf"(?<![A-Za-z0-9])(?:{_IBAN})(?![A-Za-z0-9])", 0.7, "iban|account|bank|konto|cuenta|compte"),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.4, "ssn|social security|security number"),
}
BASE = ["email", "ip", "card", "phone"]
ADDED = ["iban", "ssn"]
_NEEDS = {"email": "@", "phone": "+", "ip": ".", "iban": None, "ssn": "-", "card": None}
_SPAN = "array<struct<start:bigint,end:bigint,kind:string,score:double>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """value is computed once, however often body names it."""
    return F.transform(F.array(value), body)[0]


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)


def _ends(lengths: Column) -> Column:
    """Running totals of an array<bigint>, by blocks."""
    n = F.size(lengths)
    blocks = F.sequence(F.lit(0), F.floor((n - 1) / F.lit(_BLOCK)).cast("int"))

    def with_sums(sums: Column) -> Column:
        before = F.transform(blocks, lambda b: _total(F.slice(sums, F.lit(1), b)))
        return _let(
            before,
            lambda ahead: F.transform(
                F.sequence(F.lit(0), n - 1),
                lambda i: ahead[F.floor(i / F.lit(_BLOCK)).cast("int")]
                + _total(F.slice(lengths, F.floor(i / F.lit(_BLOCK)).cast("int") * F.lit(_BLOCK) + 1, F.pmod(i, F.lit(_BLOCK)) + 1)),
            ),
        )

    return _let(F.transform(blocks, lambda b: _total(F.slice(lengths, b * F.lit(_BLOCK) + 1, F.lit(_BLOCK)))), with_sums)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if a string of digits passes the Luhn check."""

    def weight(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(F.pmod(i, F.lit(2)) == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + weight(i))
    return F.pmod(total, F.lit(10)) == 0


def mod97(iban: Column) -> Column:
    """True if an IBAN (blanks allowed) leaves 1 modulo 97, its first four characters moved to the end."""
    bare = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, F.lit(1), F.lit(4)))

    def step(acc: Column, ch: Column) -> Column:
        return F.when(ch.rlike("[0-9]"), F.pmod(acc * 10 + F.try_to_number(ch, F.lit("9")).cast("int"), F.lit(97))).otherwise(
            F.pmod(acc * 100 + F.ascii(ch) - 55, F.lit(97))
        )

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return match.rlike(rf"^(?:{part}\.){{3}}{part}$")
    if kind == "card":
        count = F.length(match) - F.length(F.regexp_replace(match, "[0-9]", ""))
        return F.when(count.between(16, 19), luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    if kind == "iban":
        return mod97(match)
    return F.lit(True)


def spans_of(text: Column, kind: str) -> Column:
    """array<struct<start,end,kind,score>> of one kind, in order."""
    pattern, prior, words = KINDS[kind]
    near = rf"(?i)\b(?:{words})\b"

    def found(both: Column) -> Column:
        matches, gaps = both["m"], both["g"]
        lengths = F.transform(matches, lambda m, i: (F.length(gaps[i]) + F.length(m)).cast("long"))

        def beside(i: Column) -> tuple[Column, Column]:
            empty = F.lit("")
            piece = lambda xs, at: F.coalesce(F.when(at >= 0, F.get(xs, at)), empty)
            before = F.when(F.length(gaps[i]) >= CONTEXT_CHARS, gaps[i]).otherwise(F.concat(piece(gaps, i - 1), piece(matches, i - 1), gaps[i]))
            behind = F.when(F.length(gaps[i + 1]) >= CONTEXT_CHARS, gaps[i + 1]).otherwise(F.concat(gaps[i + 1], piece(matches, i + 1), piece(gaps, i + 2)))
            return F.right(before, F.lit(CONTEXT_CHARS)), F.left(behind, F.lit(CONTEXT_CHARS))

        def build(ends: Column) -> Column:
            def told(i: Column) -> Column:
                before, behind = beside(i)
                return before.rlike(near) | behind.rlike(near)

            every = F.transform(
                matches,
                lambda m, i: F.struct(
                    m.alias("m"),
                    ends[i].alias("end"),
                    F.round(F.least(F.lit(1.0), F.lit(prior) + F.when(told(i), CONTEXT_GAIN).otherwise(0.0)), 2).alias("score"),
                ),
            )
            good = F.filter(every, lambda s: _confirmed(kind, s["m"]) & ((s["score"] >= ADDED_MIN_SCORE) | F.lit(kind in BASE)))
            return F.transform(
                good,
                lambda s: F.struct(
                    (s["end"] - F.length(s["m"])).cast("long").alias("start"), s["end"].cast("long").alias("end"), F.lit(kind).alias("kind"), s["score"].alias("score")
                ),
            )

        return F.when(F.size(matches) > 0, _let(_let(lengths, _ends), build)).otherwise(F.array().cast(_SPAN))

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    may = F.contains(text, F.lit(_NEEDS[kind])) if _NEEDS[kind] else F.lit(True)
    if kind != "email":
        may = F.col("__digits") & may
    return F.when(may & text.rlike(pattern), _let(F.struct(matches.alias("m"), gaps.alias("g")), found)).otherwise(F.array().cast(_SPAN))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, ``text`` (null: empty) and an array of spans per kind, named as the kind."""
    base = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    base = base.select(F.col(id_col).alias("id"), "text", F.col("text").rlike("[0-9]").alias("__digits"))
    return base.select(F.col("id").alias(id_col), "text", *[spans_of(F.col("text"), k).alias(k) for k in KINDS])


def redacted(text: Column, spans: Column) -> Column:
    """text with each span replaced by its kind in brackets; of overlapping spans the one that ends first wins."""
    ordered = F.array_sort(spans)
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    done = F.aggregate(
        ordered,
        state,
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit("["), s["kind"], F.lit("]")).alias("out"),
                s["end"].alias("at"),
            ),
        ).otherwise(a),
    )
    return _let(done, lambda d: F.concat(d["out"], F.substring(text, (d["at"] + 1).cast("int"), F.length(text))))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's columns, then n_iban, n_ssn and every span's score."""
    found = find_pii(docs, id_col, text_col)
    every = F.concat(*[F.col(k) for k in KINDS])
    return found.select(
        F.col(id_col),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(listed(F.concat(*[F.col(k) for k in BASE])), 256).alias("base_sha256"),
        listed(every).alias("spans"),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in ADDED],
        F.array_join(F.transform(every, lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def _sql() -> str:
    """DuckDB SQL for ``pii_report``, with the contract's plain patterns. Its engine has no look-around: an IBAN's ends are word boundaries (underscores
    are turned into hyphens first, so that these are the same), and an SSN is a whole run of digits and hyphens."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(?:\.[0-9]+){3}",
        "card": r"[0-9](?:[ -]?[0-9])+",
        "phone": r"\+[0-9][ ().0-9-]+[0-9]",
        "iban": rf"\b(?:{_IBAN})\b",
        "ssn": "[0-9-]+",
    }
    source = {"iban": "replace(text, '_', '-')"}
    pieces = "\n  UNION ALL ".join(
        f"SELECT rid, {n} AS kind_no, '{k}' AS kind, {KINDS[k][1]} AS prior, text, regexp_extract_all({source.get(k, 'text')}, '{plain[k]}') AS m, "
        f"regexp_split_to_array({source.get(k, 'text')}, '{plain[k]}') AS g FROM d"
        for n, k in enumerate(KINDS)
    )
    told = " ".join(rf"WHEN '{k}' THEN '(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:{KINDS[k][2]})(?:[^\p{{L}}\p{{N}}_]|$)'" for k in KINDS)
    base = ", ".join(f"'{k}'" for k in BASE)
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in KINDS)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
pieces AS ({pieces}),
placed AS (
  SELECT rid, kind_no, kind, prior, text, m[i] AS m, (sum(length(g[i]) + length(m[i])) OVER (PARTITION BY rid, kind_no ORDER BY i))::BIGINT AS e
  FROM pieces, unnest(range(1, len(m) + 1)) r(i)),
matches AS (SELECT *, e - length(m) AS s FROM placed WHERE kind <> 'ssn' OR regexp_full_match(m, '[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}')),
beside AS (
  SELECT *, greatest(s - {CONTEXT_CHARS}, lag(e, 2, 0) OVER w) AS low, least(e + {CONTEXT_CHARS}, lead(s, 2, length(text)) OVER w) AS high,
         CASE kind {told} END AS near
  FROM matches WINDOW w AS (PARTITION BY rid, kind_no ORDER BY s)),
scored AS (
  SELECT *, round(least(1.0::DOUBLE, prior::DOUBLE + CASE WHEN regexp_matches(substr(text, low + 1, s - low), near) OR regexp_matches(substr(text, e + 1, high - e), near)
                                        THEN {CONTEXT_GAIN}::DOUBLE ELSE 0 END), 2) AS score,
         regexp_replace(m, '[^0-9]', '', 'g') AS digits, replace(m, ' ', '') AS bare
  FROM beside),
good AS (
  SELECT * FROM scored
  WHERE CASE kind
    WHEN 'ip' THEN len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(try_cast(ltrim(x, '0') AS INTEGER), 0) > 255)) = 0
    WHEN 'card' THEN length(digits) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1),
      lambda i: CASE WHEN i % 2 = 1 THEN substr(digits, length(digits) - i + 1, 1)::INTEGER
                ELSE substr(digits, length(digits) - i + 1, 1)::INTEGER * 2 - CASE WHEN substr(digits, length(digits) - i + 1, 1) > '4' THEN 9 ELSE 0 END END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 8 AND 15
    WHEN 'iban' THEN list_reduce(list_transform(string_split(substr(bare, 5) || substr(bare, 1, 4), ''), lambda c: CASE WHEN c <= '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END),
      lambda a, x: (a * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97) = 1
    ELSE true END
  AND (score >= {ADDED_MIN_SCORE} OR kind IN ({base}))),
found AS (
  SELECT rid, {counts},
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY kind_no, s) FILTER (kind IN ({base})) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY kind_no, s) AS spans, string_agg(score::VARCHAR, ',' ORDER BY kind_no, s) AS scores
  FROM good GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in KINDS)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM d LEFT JOIN found USING (rid)
"""


SQL = _sql()
