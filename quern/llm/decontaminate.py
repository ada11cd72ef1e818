"""Benchmark decontamination: a generalised suffix automaton of the test items, through which documents stream.

Items and documents are normalised alike: A-Z lower-cased, words are runs of letters and digits of ASCII
and of anything beyond it. The automaton has every item's words; at each word of a document its state and a
length say how long a run ending there occurs in some item. A run of ``window`` words (or a whole item
that is shorter) marks its words as hit.

Items are read by shards of SHARD_WORDS words, so neither the driver nor a worker ever holds more than one shard's
automaton; with more than one shard documents pass once per shard and carry their hits along.

A null text has no words. Items without words match nothing. Rows with null ids are kept; an item's null id is
written as an empty string. Repeated item ids count once. Empty tables are fine. Columns of other names pass through ``remove_spans`` and
are ignored by ``hits``.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm._shared import per_process, stored

WINDOW = 10
SHARD_WORDS = 400_000
#: A document with a larger share of hit words is dropped whole by ``remove_spans``.
MAX_COVERAGE = 0.5
_KEEP = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_KEEP).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window, self.vocab = window, {}
        self.step, self.link, self.len = [{}], [-1], [0]
        self.at: list[set] = [set()]  # items with a prefix that ends in the state
        ends, shortest = [], window
        for item, words in items:
            if not words:
                continue
            shortest = min(shortest, len(words))
            last = 0
            for w in words:
                last = self._extend(last, self.vocab.setdefault(w, len(self.vocab)))
                self.at[last].add(item)
            if len(words) < window:
                ends.append((last, len(words), item))
        self.need = shortest
        below = [[] for _ in self.len]
        for s in range(1, len(self.len)):
            below[self.link[s]].append(s)
        self.below = below
        #: For each state the short items that end where it does, longest state last; and the state of its last ``window`` words.
        short, self.long = [[] for _ in self.len], [-1] * len(self.len)
        for s, n, item in ends:
            short[s].append((n, item))
        self.short = short
        for s in sorted(range(1, len(self.len)), key=self.len.__getitem__):
            up = self.link[s]
            if up > 0 and short[up]:
                short[s] = short[s] + short[up]
            if self.len[s] >= window:
                self.long[s] = s if self.len[up] < window else self.long[up]
        self._items: dict[int, frozenset] = {}

    def _state(self, step: dict, link: int, length: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.len.append(length)
        self.at.append(set())
        return len(self.len) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        clone = self._state(dict(self.step[q]), self.link[q], self.len[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.step[p].get(c) == q:
            self.step[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if (q := self.step[last].get(c)) is not None:  # some item has this run already
            return q if self.len[q] == self.len[last] + 1 else self._split(last, q, c)
        new, p = self._state({}, 0, self.len[last] + 1), last
        while p >= 0 and c not in self.step[p]:
            self.step[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][c]
            self.link[new] = q if self.len[q] == self.len[p] + 1 else self._split(p, q, c)
        return new

    def items(self, state: int) -> frozenset:
        """Items that have the state's words: those of all states below it."""
        if state not in self._items:
            found, todo = set(), [state]
            while todo:
                s = todo.pop()
                found |= self.at[s]
                todo += self.below[s]
            self._items[state] = frozenset(found)
        return self._items[state]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit intervals of word positions (merged, ends exclusive) and the items met."""
        ids = np.fromiter(map(self.vocab.get, words, repeat(-1)), np.int32, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate([[False], ids >= 0, [False]]).astype(np.int8)))
        spans, met = [], set()
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a < self.need:
                continue
            state = length = 0
            step, link, size = self.step, self.link, self.len
            for p, c in enumerate(ids[a:b].tolist(), a):
                while state and c not in step[state]:
                    state = link[state]
                    length = size[state]
                if c in step[state]:
                    state, length = step[state][c], length + 1
                reach = 0
                if length >= self.window:
                    reach = self.window
                    met |= self.items(self.long[state])
                for n, item in self.short[state]:
                    if n <= length:
                        reach = max(reach, n)
                        met.add(item)
                if reach:
                    start = p + 1 - reach
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, p + 1))
        return spans, met


def _shards(items: DataFrame, id_col: str, text_col: str, shard_words: int):
    shard, held = [], 0
    for item, text in items.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).toLocalIterator():
        words = words_of(text)
        if shard and held + len(words) > shard_words:
            yield shard
            shard, held = [], 0
        shard.append((item or "", text))
        held += len(words)
    yield shard


_HIT = "struct<n_words:bigint,spans:array<struct<a:bigint,b:bigint>>,items:array<string>>"


def with_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """docs with ``__n_words``, ``__spans`` (array of start and end words) and ``__items`` (ids as strings)."""
    found = _found(docs, items, window, text_col, item_id, item_text, shard_words)
    return found.select("row.*", F.col("hit.n_words").alias("__n_words"), F.col("hit.spans").alias("__spans"), F.col("hit.items").alias("__items"))


def _found(docs: DataFrame, items: DataFrame, window: int, text_col: str, item_id: str = "item_id", item_text: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """row (a struct of all columns, whatever their names), text, hit (number of words, merged spans, items met)."""
    import pyarrow as pa

    span = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    hit = pa.struct([("n_words", pa.int64()), ("spans", span), ("items", pa.list_(pa.string()))])
    out = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"), F.lit(None).cast(_HIT).alias("hit"))
    schema = out.schema

    def one_pass(frame: DataFrame, shard: list) -> DataFrame:
        key = f"automaton-{window}-{hashlib.sha1(repr(shard).encode('utf-8', 'surrogatepass')).hexdigest()}"

        def run(batches):
            machine = per_process(key, lambda: Automaton([(item, words_of(text)) for item, text in shard], window))
            for batch in batches:
                hits = []
                for text, had in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    words = words_of(text)
                    found, items_met = machine.scan(words)
                    merged = []
                    for a, b in sorted([*found, *((s["a"], s["b"]) for s in (had or {}).get("spans") or [])]):
                        if merged and merged[-1]["b"] >= a:
                            merged[-1]["b"] = max(merged[-1]["b"], b)
                        else:
                            merged.append({"a": a, "b": b})
                    hits.append({"n_words": len(words), "spans": merged, "items": sorted(items_met | set((had or {}).get("items") or []))})
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hits, hit)], names=batch.schema.names)

        return frame.mapInArrow(run, schema)

    first = True
    for shard in _shards(items, item_id, item_text, shard_words):
        out = one_pass(out if first else stored(out, "decontaminate"), shard)
        first = False
    return out


def _n_hit(spans: str = "hit.spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["b"] - s["a"])


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of docs."""
    found = _found(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), items, window, "text")
    return found.select(
        F.col("row.id").alias(id_col),
        F.col("hit.n_words").alias("n_words"),
        _n_hit().alias("n_hit"),
        F.size("hit.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit.items", ","), 256).alias("items_sha256"),
        (_n_hit() > 0).alias("contaminated"),
    )


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """text without the words of the spans (positions among ``words_of``), and what lies between words of one span."""
    raw = text.encode("utf-8", "surrogatepass")
    places, at = [], 0
    flat = raw.translate(_KEEP)
    for w in flat.split():
        at = flat.index(w, at)
        places.append((at, at + len(w)))
        at += len(w)
    kept, done = [], 0
    for a, b in spans:
        kept.append(raw[done : places[a][0]])
        done = places[b - 1][1]
    return b"".join([*kept, raw[done:]]).decode("utf-8", "surrogatepass")


def remove_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE, text_col: str = "text") -> DataFrame:
    """docs (all columns) with hit spans cut out of the text; a document with a larger share of hit words
    than ``max_coverage`` goes. With ``max_coverage=0`` every contaminated document goes."""
    found = _found(docs, items, window, text_col)
    kept = found.filter(_n_hit() <= F.col("hit.n_words") * F.lit(max_coverage))

    @F.udf("string", useArrow=True)
    def trimmed(text, spans):
        return cut(text, [(s["a"], s["b"]) for s in spans]) if spans else text

    text = F.col(f"row.`{text_col}`")
    if max_coverage > 0:
        text = F.when(F.size("hit.spans") > 0, trimmed(F.col("text"), F.col("hit.spans"))).otherwise(F.col("text"))
    return kept.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, list_aggregate(w[i:i + least(len(w), 10) - 1], 'string_agg', ' ') AS s
        FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) r(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (SELECT doc_id, i, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS s FROM d, sizes, unnest(range(1, len(w) - n + 2)) r(i) WHERE len(w) >= n),
m AS (SELECT DISTINCT doc_id, i, n, item_id FROM occ JOIN win USING (n, s)),
h AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM m, unnest(range(0, n)) r(k) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""
