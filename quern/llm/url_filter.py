"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact join (DataFrame functions only).

The filter is a table of blocks. A URL's hash names one block and, in each of its eight 32-bit
words, one bit; listed URLs of a block are merged with bit_or, so the filter is built like any
aggregate and never on the driver. A URL passes if all eight of its bits are set in its block. Those that pass meet the
list in a hash join on the canonical URL itself, which removes false positives.

A page is looked up as its host and every parent domain, each with its whole path and with the
bare slash; so a listed ``bad.example/`` catches all of its subdomains and pages.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up
to ``?``, ``#`` or the end. A null url, or one without ``://``, has an empty host and path and is
allowed unless a rule with an empty host says otherwise. Repeated rows are judged row by row. An
empty list or table is fine. Columns other than id and url are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The rules of the contract, (host, path, verdict).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
# Names of listed hosts in the test pages.
LISTED_NAMES = ["adult-x", "spam-farm", "cheap-pills", "casino-win", "ads-track", "free-bets"]
LISTED_ZONES = ["com", "org", "net"]
# Odd multipliers, one per word of a block, as in the split-block filter of Parquet.
SALTS = [0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31]

BITS_PER_URL = 16
#: The filter is broadcast up to this many bytes of blocks; a larger one is joined by block number.
BROADCAST_BYTES = 32 << 20


def _lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return F.coalesce(_lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block_and_bits(url: Column, blocks: int) -> tuple[Column, list[Column]]:
    h = F.xxhash64(url)
    block = F.pmod(F.shiftright(h, 32), F.lit(blocks)).cast("int")
    low = h.bitwiseAND(F.lit(0xFFFFFFFF))
    bits = []
    for salt in SALTS:
        # Products stay below 2^63: the low 31 bits times a 32-bit salt.
        mixed = (low.bitwiseAND(F.lit(0x7FFFFFFF)) * F.lit(salt)).bitwiseAND(F.lit(0xFFFFFFFF))
        bits.append(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(mixed, 27).cast("int")))
    return block, bits


def build_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """listed: one column ``canonical``. One row per block that has a URL: ``block``, w0..w7."""
    block, bits = _block_and_bits(F.col("canonical"), blocks)
    return (
        listed.select(block.alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(bits)])
        .groupBy("block")
        .agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(len(SALTS))])
    )


def listed_hits(candidates: DataFrame, listed: DataFrame, expected: int) -> DataFrame:
    """The rows of candidates (column ``canonical``) that are on the list. expected: the list's size."""
    blocks = max(1, -(-expected * BITS_PER_URL // 256))
    bloom = build_filter(listed, blocks)
    if blocks * 8 * (1 + len(SALTS)) <= BROADCAST_BYTES:
        bloom = F.broadcast(bloom)
    block, bits = _block_and_bits(F.col("canonical"), blocks)
    probe = candidates.withColumn("block", block)
    passed = probe.join(bloom, "block")
    for i, b in enumerate(bits):
        passed = passed.filter(F.col(f"w{i}").bitwiseAND(b) != 0)
    return passed.select(*candidates.columns).join(listed.select("canonical").distinct(), "canonical", "left_semi")


def _rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def judge_urls(pages: DataFrame, listed: DataFrame, expected: int, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of pages: id, host, path, rule, verdict, listed.

    listed: column ``canonical`` (host + path). expected: how many rows it has, for the filter's size;
    a wrong figure costs time, never rows. The list is looked up once per distinct host and path, so a
    host with a third of all pages is spread over its paths, and copies of a URL over none.
    """
    parsed = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rule, verdict = _rule(F.col("host"), F.col("path"), rules)
    parsed = parsed.select(F.col(id_col), "host", "path", rule.alias("rule"), verdict.alias("ruled"))
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    forms = F.array_distinct(F.flatten(F.transform(suffixes, lambda s: F.array(F.concat(s, F.col("path")), F.concat(s, F.lit("/"))))))
    distinct = parsed.filter(F.col("ruled").isNull() & (F.col("host") != "")).select("host", "path").distinct()
    candidates = distinct.select("host", "path", F.explode(forms).alias("canonical"))
    hits = listed_hits(candidates, listed, expected).select("host", "path").distinct().withColumn("__hit", F.lit(True))
    return parsed.join(hits, ["host", "path"], "left").select(
        F.col(id_col),
        "host",
        "path",
        "rule",
        F.coalesce(F.col("ruled"), F.when(F.col("__hit"), "block").otherwise("allow")).alias("verdict"),
        F.coalesce(F.col("__hit"), F.lit(False)).alias("listed"),
    )


def default_list(spark: SparkSession) -> DataFrame:
    """The list that the query uses: bare hosts of every listed name in every zone."""
    rows = F.array(*[F.lit(f"{n}.example.{z}/") for n in LISTED_NAMES for z in LISTED_ZONES])
    return spark.range(1).select(F.explode(rows).alias("canonical"))


SQL = """
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(h, r, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best AS (
  SELECT page_id, arg_max(h || r, length(h || r)) AS rule, arg_max(v, length(h || r)) AS v
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, r) GROUP BY page_id),
listed AS (
  SELECT n || '.example.' || z AS host
  FROM (VALUES ('adult-x'), ('spam-farm'), ('cheap-pills'), ('casino-win'), ('ads-track'), ('free-bets')) a(n), (VALUES ('com'), ('org'), ('net')) b(z)),
hit AS (SELECT DISTINCT page_id FROM p JOIN listed l ON p.host = l.host OR ends_with(p.host, '.' || l.host))
SELECT p.page_id, host, path, rule,
       coalesce(v, CASE WHEN hit.page_id IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       (v IS NULL AND hit.page_id IS NOT NULL) AS listed
FROM p LEFT JOIN best USING (page_id) LEFT JOIN hit USING (page_id)
"""
