"""Line dedup by a deletion-neighbourhood join (DataFrame functions only).

Lines are a text's parts between newlines, trimmed of blanks at both ends; their edit distance is in words (insert,
delete or replace one). The earliest of equal lines stays; a line of MIN_WORDS words or more also goes if an earlier line is within one edit.
Earlier: by document id, then by line number. Lines without a word always stay.

1. Equal lines: an aggregate over 128-bit hashes; a task passes on one entry per line.
2. Two lines within one edit agree on the first or on the second half of the shorter one. Only lines that share such
   a half with another line go on. This loses no pair; it spares lines without any near copy the next step.
3. Those lines emit every variant within the bound as a hashed key: the line itself and the line without each of its words. A key is
   the XOR of hashes of (word, place), so that by running XORs all variants of a line cost its length, not its square.
   Only keys that two variants have go on.
4. Lines are within one edit if one equals a variant of the other, or if their variants without the word at the same
   place are equal. So the earliest line per key and per (key, place) is all that is needed: two
   aggregates, joined back. No group of lines is gathered, and no pairs within it are made.
5. The words of a line and of the earlier line found for it are compared (common prefix and suffix); hashes alone drop nothing.

Null text counts as empty. Rows with a null id come before all others. Repeated rows are treated like copies: of equal
(id, line number, line) one entry stands for all, so they share their verdict. Near lines are looked for by blank-separated words: lines of fewer than MIN_WORDS
words, and so most lines in scripts without blanks, only go as equal ones. A document without a line with words has no row in the report. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm._shared import stored

MIN_WORDS = 5
_BLOCK = 32
_BLANKS = " \t\x0b\f\r"
_LINE = ["h1", "h2"]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), body)[0]


def _running(xs: Column) -> Column:
    """Running XORs of an array<bigint> that has values, with a leading 0. Arrays grow within blocks only."""
    zero = F.array(F.lit(0).cast("long"))

    def grow(values: Column) -> Column:
        return F.aggregate(values, zero, lambda a, x: F.concat(a, F.array(F.element_at(a, -1).bitwiseXOR(x))))

    starts = F.sequence(F.lit(1), F.size(xs), F.lit(_BLOCK))

    def joined(blocks: Column) -> Column:
        ahead = grow(F.transform(blocks, lambda b: F.element_at(b, -1)))
        return _let(ahead, lambda before: F.concat(zero, F.flatten(F.transform(blocks, lambda b, i: F.transform(F.slice(b, 2, _BLOCK), lambda x: x.bitwiseXOR(before[i]))))))

    return _let(F.transform(starts, lambda at: grow(F.slice(xs, at, F.lit(_BLOCK)))), joined)


def _trimmed(raw: Column) -> Column:
    return F.btrim(raw, F.lit(_BLANKS))


def _spaced(line: Column) -> Column:
    """A trimmed line with one space between words."""
    uneven = line.contains("  ")
    for blank in _BLANKS[1:]:
        uneven = uneven | line.contains(blank)
    return F.when(uneven, F.regexp_replace(line, r"\s+", " ")).otherwise(line)


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    parts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("t"), F.posexplode(F.split(text, "\n", -1)).alias("no", "raw"))
    return parts.select("id", "t", "no", _trimmed(F.col("raw")).alias("line"))


def _halves(spaced: Column, n: Column) -> Column:
    """Keys of which two lines within one edit share at least one."""

    def part(count: Column) -> Column:
        return F.call_function("substring_index", spaced, F.lit(" "), count)

    def of(length: Column) -> list[Column]:
        h = F.floor(length / F.lit(2)).cast("int")
        return [F.xxhash64(F.lit("first"), length, part(h)), F.xxhash64(F.lit("second"), length, part(h - length))]

    return F.array(*of(n), *of(n - 1))


def _keys(words: Column) -> Column:
    """Per variant a key: first the line itself, then the line without its word at 0, 1 and so on."""
    ahead = F.transform(words, lambda w, i: F.xxhash64(w, i))
    moved = F.transform(words, lambda w, i: F.xxhash64(w, i - 1))
    n = F.size(words)
    return _let(
        F.struct(_running(ahead).alias("a"), _running(moved).alias("m")),
        lambda s: F.concat(
            F.array(s["a"][n]),
            _let(s["m"][n], lambda end: F.transform(F.slice(s["a"], F.lit(1), n), lambda x, p: x.bitwiseXOR(end).bitwiseXOR(s["m"][p + 1]))),
        ),
    )


def within_one_edit(a: Column, b: Column) -> Column:
    """True if two arrays of words differ by at most one word inserted, deleted or replaced."""

    def agree(x: Column, y: Column) -> Column:
        miss = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False)
        return _let(miss, lambda at: F.when(at == 0, F.greatest(F.size(x), F.size(y))).otherwise(at - 1))

    longer = F.greatest(F.size(a), F.size(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (agree(a, b) + agree(F.reverse(a), F.reverse(b)) >= longer - 1)


def _variants(near: DataFrame) -> DataFrame:
    """key, gone (place of the word left out, -1 for none), n, line: each line's own key and those without one word."""
    words = near.select("line", "n", F.split("text", " ").alias("words"))
    return words.select("line", "n", F.posexplode(_keys(F.col("words"))).alias("at", "key")).select("key", (F.col("at") - 1).alias("gone"), "n", "line")


def _verdicts(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """id, t (a hash of the row's text), no, verdict, keep_id, keep_no."""
    lines = _lines(docs, id_col, text_col).filter(F.col("line") != "")
    hashed = lines.select("id", "t", "no", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), _spaced(F.col("line")).alias("text"))
    counted = hashed.withColumn("n", F.octet_length("text") - F.octet_length(F.replace("text", F.lit(" "), F.lit(""))) + 1)
    halved = counted.select("id", "t", "no", *_LINE, "n", F.when(F.col("n") >= min_words - 1, _halves(F.col("text"), F.col("n"))).alias("halves"))
    place = F.struct("id", "no", "t")
    firsts = stored(
        halved.groupBy(*_LINE).agg(F.min(place).alias("first"), F.any_value("n").alias("n"), F.any_value("halves").alias("halves")), "lines"
    )
    # a line is known by its first place, then by its hash (places of rows that share an id, or have none, may coincide)
    line = F.struct(F.col("first.id").alias("id"), F.col("first.no").alias("no"), F.col("h1").alias("h"))
    # 2: lines that share a half with another line
    half = firsts.filter(F.col("n") >= min_words - 1).select(line.alias("line"), F.col("first.t").alias("t"), F.explode("halves").alias("half"))
    shared = half.groupBy("half").agg(F.count("*").alias("c")).filter("c > 1").select("half")
    wanted = half.join(shared, "half", "left_semi").select("line.*", "t").distinct()
    # looked up by id and text, so that rows that share an id (or have none) spread, and a row's want is no more than its own lines
    by_doc = wanted.groupBy("id", "t").agg(F.collect_list(F.struct("no", "h")).alias("want"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("own"), F.split(text, "\n", -1).alias("parts"))
    found = by_doc.join(texts, (by_doc["t"] == texts["own"]) & by_doc["id"].eqNullSafe(texts["doc"])).select(
        "id", F.explode(F.transform("want", lambda w: F.struct(w["no"].alias("no"), w["h"].alias("h"), F.get("parts", w["no"]).alias("raw")))).alias("e")
    )
    found = found.select("id", "e.*").withColumn("text", _trimmed(F.col("raw")))
    # only the row that has this very line counts, should texts share a hash
    found = found.filter(F.xxhash64("text") == F.col("h"))
    spaced = found.select(F.struct("id", "no", "h").alias("line"), _spaced(F.col("text")).alias("text")).dropDuplicates(["line"])
    near = stored(spaced.withColumn("n", F.size(F.split("text", " "))), "line-texts")
    # 3: variants
    rows = _variants(near)
    twice = rows.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    met = stored(rows.join(twice, "key", "left_semi"), "line-variants")
    # 4: the earliest line per key and place, then per key
    whole, cut = F.col("gone") < 0, F.col("gone") >= 0
    by_place = met.groupBy("key", "gone").agg(F.min("line").alias("least"))
    by_key = by_place.groupBy("key").agg(F.min(F.when(whole, F.col("least"))).alias("as_whole"), F.min(F.when(cut, F.col("least"))).alias("as_cut"))
    met = met.join(by_key, "key").join(by_place.filter(cut), ["key", "gone"], "left")
    earliest = F.when(whole, F.col("as_cut")).otherwise(F.least("least", "as_whole"))
    links = (
        met.select("line", "n", earliest.alias("to"))
        .filter(F.col("to").isNotNull() & (F.col("to") < F.col("line")) & (F.col("n") >= min_words))
        .groupBy("line")
        .agg(F.min("to").alias("to"))
    )
    # 5: the words themselves
    sure = (
        links.join(near.select("line", F.split("text", " ").alias("wa")), "line")
        .join(near.select(F.col("line").alias("to"), F.split("text", " ").alias("wb")), "to")
        .filter(within_one_edit(F.col("wa"), F.col("wb")))
        .select("line", F.struct("to.id", "to.no").alias("near"))
    )
    classes = firsts.select(*_LINE, F.struct("first.id", "first.no").alias("first"), line.alias("line")).join(sure, "line", "left").drop("line")
    earliest = F.coalesce("near", "first")
    return hashed.select("id", "t", "no", *_LINE).join(classes, _LINE).select(
        "id",
        "t",
        F.col("no").cast("long").alias("no"),
        F.when(~F.struct("id", "no").eqNullSafe(F.col("first")), "exact").when(F.col("near").isNotNull(), "near").otherwise("keep").alias("verdict"),
        earliest["id"].alias("keep_id"),
        earliest["no"].cast("long").alias("keep_no"),
    )


def line_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per line with words: id, no, verdict ('keep', 'exact' or 'near'), keep_id and keep_no (of the line that stays in
    its place; of a kept line its own)."""
    return _verdicts(docs, id_col, text_col, min_words).drop("t").withColumnRenamed("id", id_col)


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """A row per id that has a line with words: n_lines, n_exact, n_near and ``dropped``, the numbers of the lines
    that go. (A document's lines are gathered, never those of a group of lines.)"""
    v = line_verdicts(docs, id_col, text_col, min_words)
    gone = F.when(F.col("verdict") != "keep", F.col("no"))
    return v.groupBy(id_col).agg(
        F.count("*").alias("n_lines"),
        F.count_if(F.col("verdict") == "exact").alias("n_exact"),
        F.count_if(F.col("verdict") == "near").alias("n_near"),
        F.array_join(F.transform(F.array_sort(F.collect_list(gone)), lambda x: x.cast("string")), ",").alias("dropped"),
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """docs (all columns) with the lines that go taken out of the text; nulls stay null. A row loses its own text's lines alone, also where others share its id."""
    v = _verdicts(docs, id_col, text_col, min_words).filter("verdict <> 'keep'")
    gone = v.groupBy("id", "t").agg(F.collect_set("no").alias("gone"))
    text = F.col(text_col).cast("string")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc"), text.alias("own"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("hash"))
    kept = F.array_join(F.filter(F.split("own", "\n", -1), lambda x, i: ~F.array_contains(F.col("gone"), i.cast("long"))), "\n")
    joined = rows.join(gone, (rows["hash"] == gone["t"]) & rows["doc"].eqNullSafe(gone["id"]), "left")
    joined = joined.withColumn("new", F.when(F.col("gone").isNull(), F.col("own")).otherwise(kept))
    return joined.select(*[F.col("new").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])


SQL = r"""
WITH raw AS (SELECT doc_id, (i - 1)::BIGINT AS no, regexp_replace(parts[i], '^\s+|\s+$', '', 'g') AS line
             FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents), unnest(range(1, len(parts) + 1)) r(i)),
l AS (SELECT * FROM raw WHERE line <> ''),
d AS (SELECT line, min(doc_id * 1000000 + no) AS first FROM l GROUP BY line),
w AS (SELECT line, first, regexp_split_to_array(line, '\s+') AS w FROM d),
v AS (SELECT line, first, len(w) AS n, p, list_aggregate(w[:p - 1] || w[p + 1:], 'string_agg', ' ') AS v FROM w, unnest(range(1, len(w) + 1)) r(p) WHERE len(w) >= 4),
pairs AS (SELECT b.line, a.first AS near FROM v a JOIN v b ON a.v = b.v AND a.p = b.p AND a.n = b.n AND a.first < b.first WHERE b.n >= 5
          UNION ALL SELECT b.line, a.first FROM v b JOIN w a ON b.v = array_to_string(a.w, ' ') AND a.first < b.first WHERE b.n >= 5
          UNION ALL SELECT a.line, b.first FROM v b JOIN w a ON b.v = array_to_string(a.w, ' ') AND b.first < a.first WHERE len(a.w) >= 5),
near AS (SELECT line, min(near) AS near FROM pairs GROUP BY line),
j AS (SELECT doc_id, no, CASE WHEN doc_id * 1000000 + no <> first THEN 'exact' WHEN near IS NOT NULL THEN 'near' ELSE 'keep' END AS verdict
      FROM l JOIN d USING (line) LEFT JOIN near USING (line))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (verdict = 'exact') AS n_exact, count(*) FILTER (verdict = 'near') AS n_near,
       coalesce(string_agg(no::VARCHAR, ',' ORDER BY no) FILTER (verdict <> 'keep'), '') AS dropped
FROM j GROUP BY doc_id
"""
