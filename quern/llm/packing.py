"""Packing: bounded-space online bins per partition, best fit, leftovers merged.

Each task keeps OPEN windows of ``size`` tokens. A document's full windows are cut off first; what is left goes
to the open window in which it fits best. Where it fits none, the fullest window is emitted, topped up with the head of the piece if its gap is worth a
cut, and the piece opens a new one. When a task ends its open windows are leftovers. Leftovers meet in a small tree: those of GROUP tasks refill
windows by cutting freely and pass on what doesn't fill one, less than a window; of REST such groups each, the last, partly filled window is cut at powers of two,
which need no padding. So padding is at most MIN_CUT - 1 tokens for each window emitted.

Memory: a task holds its open windows' pieces with their ids, and one document; a group of the tree at most GROUP * OPEN windows, then REST. Sequence ids are
unique: level (bits 61 and 62), the task's or group's number (29 bits) and a counter (32 bits); a number that doesn't fit raises. Everything follows from the partition's rows and order, so a task that runs again gives the same.

A null text counts as empty: a document of the end id alone. Null and repeated ids pass through. An empty table gives an empty
result. Rows that share an id are packed each by itself. Other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm._shared import per_process, stored

SIZE = 4096
OPEN = 64
GROUP = 4
REST = 256
MIN_CUT = 32
END_ID = 2
CACHED_WORDS = 1_000_000
CACHED_BYTES = 64
#: Pieces of Latin letters with ASCII marks behind them, which need no general normalising.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
_SCHEMA = ", ".join(f"{c} bigint" for c in _COLUMNS)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints, else the next free one from U+0100."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    free = iter(range(0x100, 0x200))
    return [chr(b if b in prints else next(free)) for b in range(256)]


class Ids:
    """Token ids of a text as little-endian uint32 bytes, by pieces between ASCII white space.

    The vocabulary's pre-tokenizer drops white space and no token crosses it, so the ids of a text are those of its
    pieces in turn; pieces recur, and their ids are kept. A new piece of Latin letters and marks is lower-cased and given straight to the
    vocabulary's merges; any other goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), {}
        self.merge = self.tokenizer.model.tokenize
        self.letters = dict(enumerate(byte_letters()))
        self.marks = {"": []}

    def _plain(self, piece: str) -> bytes | None:
        parts = _PLAIN.fullmatch(piece)
        if not parts:
            return None
        word, marks = parts.groups()
        word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.merge(word)]
        if marks not in self.marks:
            if len(self.marks) > 10_000:
                self.marks = {"": []}
            self.marks[marks] = [t.id for t in self.merge(marks)]
        ids += self.marks[marks]
        return struct.pack(f"<{len(ids)}I", *ids)

    def of(self, text: str | None) -> bytes:
        pieces = (text or "").encode("utf-8", "replace").split()
        known = self.known
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            pass
        if len(known) > CACHED_WORDS:
            known.clear()
        own, hard = {}, []
        for p in dict.fromkeys(pieces):
            if p not in known:
                ids = self._plain(p.decode())
                if ids is None:
                    hard.append(p)
                else:
                    (known if len(p) <= CACHED_BYTES else own)[p] = ids
        for p, e in zip(hard, self.tokenizer.encode_batch_fast([p.decode() for p in hard], add_special_tokens=False)):
            (known if len(p) <= CACHED_BYTES else own)[p] = struct.pack(f"<{len(e.ids)}I", *e.ids)
        return b"".join([known[p] if p in known else own[p] for p in pieces])


class Bins:
    """Open windows of one task. ``emit`` takes (sequence, pieces); a piece is [doc, start, ids, doc_tokens]."""

    def __init__(self, size: int, most: int, emit):
        self.size, self.most, self.emit, self.open = size, most, emit, []

    def put(self, doc, start: int, ids: bytes, total: int) -> None:
        size, n = self.size, len(ids) // 4
        full = n // size * size
        for at in range(0, full, size):
            self.emit([[doc, start + at, ids[4 * at : 4 * (at + size)], total]])
        start, ids, n = start + full, ids[4 * full :], n - full
        if not n:
            return
        best = None
        for window in self.open:
            if window[0] >= n and (best is None or window[0] < best[0]):
                best = window
        if best is None and len(self.open) >= self.most:
            fullest = min(self.open, key=lambda w: w[0])
            self.open.remove(fullest)
            gap = fullest[0]
            if gap >= MIN_CUT:
                fullest[1].append([doc, start, ids[: 4 * gap], total])
                start, ids, n = start + gap, ids[4 * gap :], n - gap
            self.emit(fullest[1])
        if best is None:
            best = [size, []]
            self.open.append(best)
        best[0] -= n
        best[1].append([doc, start, ids, total])
        if not best[0]:
            self.open.remove(best)
            self.emit(best[1])


def _rows(pieces: list, sequence: int, keep_ids: bool) -> list[tuple]:
    rows, offset = [], 0
    for doc, start, ids, total in pieces:
        n = len(ids) // 4
        rows.append((doc, start, n, zlib.crc32(ids), total, sequence, offset, ids if keep_ids else None))
        offset += n
    return rows


def refill(pieces: list, size: int, to_the_end: bool) -> tuple[list[list], list]:
    """Leftover pieces cut into full windows, and what is left, less than a window; to the end: that too, in windows whose lengths are powers of two."""
    left = sum(len(p[2]) // 4 for p in pieces)
    queue, windows = list(reversed(pieces)), []
    while left >= size or (left and to_the_end):
        room = size if left >= size else 1 << (left.bit_length() - 1)
        left -= room
        window = []
        while room:
            doc, start, ids, total = queue.pop()
            n = min(room, len(ids) // 4)
            window.append([doc, start, ids[: 4 * n], total])
            room -= n
            if len(ids) > 4 * n:
                queue.append([doc, start + n, ids[4 * n :], total])
        windows.append(window)
    return windows, queue[::-1]


def sequence(level: int, part: int, made: int) -> int:
    if part >> 29 or made >> 32:
        raise ValueError("more tasks or windows of a task than sequence ids have room for")
    return level << 61 | part << 32 | made


def pack(docs: DataFrame, path: str | None = None, size: int = SIZE, most: int = OPEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    import pyarrow as pa

    if size & (size - 1):
        raise ValueError("size is a power of two")
    path = path or tokenizer_path()
    ints = [(c, pa.int64()) for c in _COLUMNS]
    schema = pa.schema([*ints, ("ids", pa.binary())])

    def run(batches):
        from pyspark import TaskContext

        part, ids, rows, made = TaskContext.get().partitionId(), per_process(f"ids-{path}", lambda: Ids(path)), [], 0
        end = END_ID.to_bytes(4, "little")

        def emit(pieces):
            nonlocal made
            rows.extend(_rows(pieces, sequence(0, part, made), False))
            made += 1

        bins = Bins(size, most, emit)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = ids.of(text) + end
                bins.put(doc, 0, tokens, len(tokens) // 4)
                if len(rows) >= 8192:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                    rows.clear()
        for _, pieces in bins.open:
            rows.extend(_rows(pieces, part, True))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def merge(level: int, to_the_end: bool):
        def run_group(f):
            import pandas as pd

            f = f.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
            group = int(f["group"].iloc[0])
            pieces = [[None if pd.isna(d) else int(d), int(s), i, int(t)] for d, s, i, t in zip(f["doc_id"], f["start"], f["ids"], f["doc_tokens"])]
            windows, rest = refill(pieces, size, to_the_end)
            out = [r for k, w in enumerate(windows) for r in _rows(w, sequence(level, group, k), False)] + _rows(rest, group, True)
            return pd.DataFrame(out, columns=[*_COLUMNS, "ids"]).astype({c: "Int64" for c in _COLUMNS})

        return run_group

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    with_ids = _SCHEMA + ", ids binary"
    pieces = stored(chosen.mapInArrow(run, with_ids), "packing")

    def gathered(df: DataFrame, of: int) -> DataFrame:
        return df.filter("ids IS NOT NULL").withColumn("group", F.floor(F.col("sequence_id") / F.lit(of)).cast("long")).groupBy("group")

    first = stored(gathered(pieces, GROUP).applyInPandas(merge(1, False), with_ids), "packing-leftovers")
    last = gathered(first, REST).applyInPandas(merge(2, True), with_ids)
    done = pieces.filter("ids IS NULL").unionByName(first.filter("ids IS NULL")).unionByName(last)
    return done.select(*_COLUMNS)
