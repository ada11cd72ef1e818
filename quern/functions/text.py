"""Text columns. All of them stay in the JVM but unescaping of HTML and tokenizers, for which Spark has no functions."""

from __future__ import annotations

import html
import html.entities
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

# Fixed value: the white space of Python's str.strip and of \s in its patterns, as a Java class.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"
# Fixed value: its complement.
NOT_WS = r"[^\s\x1c-\x1f\x85\p{Z}]"
# Fixed value: all characters of the class (a test holds both against each other).
WS_CHARS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# Fixed value: the same class for DuckDB's RE2.
DUCK_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def clean(c: Column) -> Column:
    """Null to empty; white space off both ends. A trim looks at the ends alone, where a pattern would be tried at each blank of a long text."""
    return F.btrim(F.coalesce(c.cast("string"), F.lit("")), F.lit(WS_CHARS))


def squeezed(c: Column) -> Column:
    """Runs of white space become one blank; none at the ends."""
    return F.btrim(F.regexp_replace(c, rf"{WS}+", " "))


def unescaped(x: str | None, closed: bool = False) -> str | None:
    """Entities to characters, those without a semicolon too (``&amp b``), as far as HTML has them; with closed only those that end with one."""
    if x is None or not closed:
        return x and html.unescape(x)

    def one(m: re.Match) -> str:
        return html.unescape(m[0]) if m[1][0] == "#" or m[1] + ";" in html.entities.html5 else m[0]

    return re.sub("&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);", one, x)


def unescape_html(c: Column, closed: bool = False) -> Column:
    @F.pandas_udf(StringType())
    def unescape(s: pd.Series) -> pd.Series:
        return s.map(lambda x: unescaped(x, closed))

    return unescape(c)


def unescape_each(c: Column, closed: bool = False) -> Column:
    @F.pandas_udf(ArrayType(StringType()))
    def unescape(lists: pd.Series) -> pd.Series:
        return lists.map(lambda xs: None if xs is None else [unescaped(x, closed) for x in xs])

    return unescape(c)


def without_tags(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " ")


def strip_html(c: Column, closed: bool = False) -> Column:
    """Tags to blanks, then entities to characters (with closed only those that end with a semicolon), then white space squeezed: an escaped tag stays as text."""
    return squeezed(unescape_html(without_tags(c), closed))


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(f"{NOT_WS}+")).cast("long")


def first_filled(columns: list[Column]) -> Column:
    """The first of the columns that isn't blank, cleaned; else empty."""
    return F.coalesce(*[F.nullif(clean(c), F.lit("")) for c in columns], F.lit(""))


def parsed_number(c: Column) -> Column:
    """A double, or null if the text is no number."""
    return F.btrim(c.cast("string"), F.lit(WS_CHARS)).try_cast("double")


def number_text(c: Column, digits: int = 6) -> Column:
    """A number rounded for display; blank if there is none."""
    return F.coalesce(F.round(parsed_number(c), digits).cast("string"), F.lit(""))


def cell_text(c: Column) -> Column:
    """Four places, or N/A."""
    return F.when(c.isNull(), "N/A").otherwise(F.format_string("%.4f", c.cast("double")))


def last_match(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the last match; null if there is none."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(-1))


def seeded_key(seed: int, *keys: Column) -> Column:
    """The order of a seeded shuffle: the same rows give the same order on any cluster."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]), 256)


def estimate(output: Column, name: str = "PPL") -> Column:
    """The number behind the last "Final estimate: <name> = " of a tool's output; null if there is none."""
    return last_match(output, rf"Final estimate[^\n]*{name}[^\n=]*=\s*([0-9.]+)").try_cast("double")


def token_counter(path: str) -> Callable[[Column], Column]:
    """A counter of a tokenizer's tokens (a file of the public tokenizers library), by Arrow batches; each worker loads it once per batch iterator."""

    def count(c: Column) -> Column:
        @F.pandas_udf(LongType())
        def tokens(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            import pandas
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            for part in parts:
                found = tokenizer.encode_batch_fast(part.fillna("").tolist(), add_special_tokens=False)
                yield pandas.Series([len(e.ids) for e in found], dtype="int64")

        return tokens(c)

    return count
