"""Dedup of conversations: by fingerprint, by priority of the source, by similarity of embeddings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.order import global_rank
from quern.functions.shared import shared_dir

# The two sources of which one contains the other; the first one's copy is kept.
PRIORITY = ["ibranze", "vishnuoi"]


def keep_first(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """Of the rows with a key, the first by the order (ties: any one of equal ones). One aggregate with map-side partials: a
    key with a third of all rows costs a row per task."""
    names = df.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    best = df.groupBy(F.col(key).alias("__key")).agg(F.min_by(row, F.struct(*order)).alias("__row"))
    return best.select("__row.*")


def priority_rank(source: Column, priority: list[str] | None) -> Column:
    rank = F.lit(len(priority or []))
    for i, name in reversed(list(enumerate(priority or []))):
        rank = F.when(source == name, i).otherwise(rank)
    return rank


def by_priority(df: DataFrame, key: str, source: str, *order: Column, priority: list[str] | None = None) -> DataFrame:
    return keep_first(df, key, priority_rank(F.col(source), priority), *order)


def active_priority(df: DataFrame, source: str = "source") -> list[str] | None:
    """The priority list, if both of its sources are there: a look for a first row of each. Sources that df can't have cost nothing, and those it has a few rows."""
    return PRIORITY if all(not df.filter(F.col(source) == s).isEmpty() for s in PRIORITY) else None


def overlapping(sources: list[str], mix: dict[str, float] | None) -> bool:
    """Both sources are asked for: in the list, or with positive weights where there is a mix."""
    if mix is not None:
        return all(mix.get(s, 0) > 0 for s in PRIORITY)
    return all(s in sources for s in PRIORITY)


# ---- similarity

#: Rows of a block; a task compares two blocks, TILE rows against TILE rows at a time.
BLOCK_ROWS = 8_000
TILE = 1_000
#: Share of pairs at the threshold that random planes must find, the most planes of a table and the most tables (copies of each row), and the share of all comparisons from
#: which planes aren't worth it.
RECALL = 0.95
MOST_PLANES = 20
MOST_TABLES = 32
MOST_WORK = 0.25


def _unit(df: DataFrame, vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return df.withColumn(vector, F.when(norm > 0, F.transform(v, lambda x: x / norm)).otherwise(v))


def planes_for(threshold: float, recall: float = RECALL, most: int = MOST_PLANES) -> tuple[int, int] | None:
    """(planes, tables) whose buckets hold a pair at the threshold together with at least this probability, at the least work; None if comparing all is
    hardly more work. Two vectors at an angle agree on a random plane with probability 1 - angle / pi, and on a table if they do on all of its planes."""
    agree = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    best = None
    for planes in range(1, most + 1):
        one = agree**planes
        tables = 1 if one >= recall else math.ceil(math.log(1 - recall) / math.log(1 - one))
        work = tables / 2**planes
        if tables <= MOST_TABLES and work <= MOST_WORK and (best is None or work < best[0]):
            best = (work, planes, tables)
    return best and best[1:]


def _meetings(rows: DataFrame, bucket: list[str]) -> DataFrame:
    """Each row once for every pair of blocks of its bucket that it takes part in: p <= q, and i, its own block. A bucket has as many
    blocks as its rows need, so none meets whole in one task."""
    sizes = rows.groupBy(*bucket).agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_ROWS)).cast("int").alias("blocks"), F.count(F.lit(1)).alias("n"))
    # an empty bucket list makes one group: its size is a single row
    sized = rows.join(sizes.filter("n > 1"), bucket) if bucket else rows.join(F.broadcast(sizes))
    own = F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int")
    dealt = sized.withColumn("i", own).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(*bucket, "k", "v", *[c for c in ("r",) if c in rows.columns], "i", F.least("i", "o").alias("p"), F.greatest("i", "o").alias("q"))


def _tiles(x, side, p: int, q: int, threshold: float):  # noqa: ANN001, ANN202
    """(rows, columns, cosines) of similar rows of blocks p and q; within one block both orders of a pair may come."""
    import numpy as np

    mine, others = np.flatnonzero(side == p), np.flatnonzero(side == q)
    for a in range(0, len(mine), TILE):
        for b in range(0, len(others), TILE):
            s = x[mine[a : a + TILE]] @ x[others[b : b + TILE]].T
            r, c = np.nonzero(s >= threshold - 1e-9)
            yield mine[r + a], others[c + b], s[r, c]


def similar_pairs(df: DataFrame, threshold: float, key: str = "vec_id", vector: str = "embedding", exact: bool = True, recall: float = RECALL) -> DataFrame:
    """Pairs (a, b, cosine), a < b, with a cosine of at least the threshold.

    Each row meets each other in blocks of BLOCK_ROWS (block pairs are the tasks), at every size. With exact=False
    candidates share a bucket of one of several tables of random planes, as many as ``planes_for`` derives from the threshold for the recall asked for; where planes
    would save little (low thresholds), all rows are compared after all. What is reported is exact either way. Rows with a null key or vector have no pairs.
    """
    import numpy as np
    import pandas as pd

    rows = _unit(df.select(F.col(key).cast("long").alias("k"), F.col(vector).alias("v")).dropna(), "v")
    # so many planes that a bucket has some dozens of rows; the recall is the same with any number
    chosen = None if exact else planes_for(threshold, recall, max(1, min(MOST_PLANES, (rows.count() >> 6).bit_length())))
    bucket: list[str] = []
    if chosen:
        planes, tables = chosen
        bucket = ["t", "code"]

        def sign(frames):
            for f in frames:
                x = np.stack(f["v"].to_numpy())
                axes = np.random.default_rng(11).standard_normal((x.shape[1], planes * tables))
                codes = ((x @ axes > 0).reshape(len(x), tables, planes) @ (1 << np.arange(planes))).astype(np.int64)
                for t in range(tables):
                    yield pd.DataFrame({"t": t, "code": codes[:, t], "k": f["k"], "v": f["v"]})

        rows = rows.mapInPandas(sign, "t int, code bigint, k bigint, v array<double>")

    def meet(f: pd.DataFrame) -> pd.DataFrame:
        x, k = np.stack(f["v"].to_numpy()), f["k"].to_numpy()
        out = [pd.DataFrame({"a": k[:0], "b": k[:0], "cosine": x[:0, 0]})]
        for r, c, s in _tiles(x, f["i"].to_numpy(), int(f["p"].iloc[0]), int(f["q"].iloc[0]), threshold):
            a, b = np.minimum(k[r], k[c]), np.maximum(k[r], k[c])
            ok = a < b
            out.append(pd.DataFrame({"a": a[ok], "b": b[ok], "cosine": s[ok]}).drop_duplicates(["a", "b"]))
        found = pd.concat(out)
        return found.drop_duplicates(["a", "b"]) if f["p"].iloc[0] == f["q"].iloc[0] else found

    found = _meetings(rows, bucket).groupBy(*bucket, "p", "q").applyInPandas(meet, "a bigint, b bigint, cosine double").filter(F.col("cosine") >= threshold)
    return found.dropDuplicates(["a", "b"]) if chosen else found


def _earliest(rows: DataFrame, threshold: float) -> DataFrame:
    """rows: k, r, v. k and ``near``, the least r of a similar row that comes earlier; only rows that have one. A block pair gives a row per row, never its pairs."""
    import numpy as np
    import pandas as pd

    def meet(f: pd.DataFrame) -> pd.DataFrame:
        x, rank = np.stack(f["v"].to_numpy()), f["r"].to_numpy()
        least = rank.copy()
        for a, b, s in _tiles(x, f["i"].to_numpy(), int(f["p"].iloc[0]), int(f["q"].iloc[0]), threshold):
            ok = s >= threshold
            np.minimum.at(least, a[ok], rank[b[ok]])
            np.minimum.at(least, b[ok], rank[a[ok]])
        late = least < rank
        return pd.DataFrame({"k": f["k"].to_numpy()[late], "near": least[late]})

    met = _meetings(rows, []).groupBy("p", "q").applyInPandas(meet, "k bigint, near bigint")
    return met.groupBy("k").agg(F.min("near").alias("near"))


def _beaten(late: DataFrame, staying: DataFrame, threshold: float) -> DataFrame:
    """Keys of the late rows to which a staying row that comes earlier is similar."""
    import numpy as np
    import pandas as pd

    blocks = [max(1, -(-side.count() // BLOCK_ROWS)) for side in (late, staying)]

    def dealt(side: DataFrame, i: int) -> DataFrame:
        own, every = F.pmod(F.xxhash64("k"), F.lit(blocks[i])).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(blocks[1 - i] - 1)))
        pair = (own.alias("p"), every.alias("q")) if i == 0 else (every.alias("p"), own.alias("q"))
        return side.select("k", "r", "v", F.lit(i).alias("i"), *pair)

    def meet(f: pd.DataFrame) -> pd.DataFrame:
        x, rank = np.stack(f["v"].to_numpy()), f["r"].to_numpy()
        lost = np.zeros(len(f), bool)
        for a, b, s in _tiles(x, f["i"].to_numpy(), 0, 1, threshold):
            lost[a[(s >= threshold) & (rank[b] < rank[a])]] = True
        return pd.DataFrame({"k": f["k"].to_numpy()[lost]})

    return dealt(late, 0).unionByName(dealt(staying, 1)).groupBy("p", "q").applyInPandas(meet, "k bigint").distinct()


def greedy_gone(rows: DataFrame, threshold: float) -> DataFrame:
    """rows: k, r (places, each once), v (unit vectors). Keys of the rows that go if rows are taken by place and one goes when a row that stays is similar to it.

    Rounds give what going through the rows one by one would: a row without an earlier similar row among those undecided stays; one to which a row that stays is
    similar goes; the others are looked at again among themselves. Links are never stored: each round passes on the earliest neighbour of a row alone.
    Every round decides the first undecided row at least, and in practice nearly all.
    """
    shared_dir(rows.sparkSession)
    left, gone = rows.checkpoint(), rows.select("k").limit(0)
    while True:
        linked = left.join(_earliest(left, threshold), "k", "left").checkpoint()
        staying = linked.filter(F.col("near").isNull()).select("k", "r", "v")
        late = linked.filter(F.col("near").isNotNull())
        if late.isEmpty():
            return gone
        at_once = late.join(staying.select(F.col("r").alias("near")), "near", "left_semi").select("k")
        open_ = late.join(at_once, "k", "left_anti").select("k", "r", "v").checkpoint()
        beaten = _beaten(open_, staying, threshold).checkpoint() if not open_.isEmpty() else open_.select("k")
        gone = gone.union(at_once).union(beaten).checkpoint()
        left = open_.join(beaten, "k", "left_anti").checkpoint()
        if left.isEmpty():
            return gone


def greedy_keep(nodes: DataFrame, pairs: DataFrame, rank: str = "rank", key: str = "vec_id") -> DataFrame:
    """The same for links that are given: keys that stay if rows are taken in rank order and one goes if a row that stays is linked to it.

    Rounds decide every row whose earlier neighbours are decided: it goes if one of them stays, it stays if none does. Rows without neighbours stay at
    once. Each round's undecided links are checkpointed in the shared folder.
    """
    shared_dir(nodes.sparkSession)
    ranks = nodes.select(F.col(key).alias("k"), F.col(rank).alias("r"))
    a, b = ranks.withColumnsRenamed({"k": "a", "r": "ra"}), ranks.withColumnsRenamed({"k": "b", "r": "rb"})
    linked = pairs.select("a", "b").join(a, "a").join(b, "b")
    first = F.struct("ra", "a") < F.struct("rb", "b")
    links = linked.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("early"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("late")).distinct().checkpoint()
    gone = links.select(F.col("late").alias("k")).limit(0)
    while not links.isEmpty():
        waiting = links.select("late").distinct()
        staying = links.select("early").distinct().join(waiting, F.col("early") == F.col("late"), "left_anti")
        dropped = links.join(staying, "early", "left_semi").select(F.col("late").alias("k")).distinct()
        gone = gone.union(dropped).checkpoint()
        links = links.join(dropped, links["late"] == dropped["k"], "left_anti").join(dropped, links["early"] == dropped["k"], "left_anti").checkpoint()
    return nodes.join(gone, nodes[key] == gone["k"], "left_anti")


def semantic_dedup(
    df: DataFrame, threshold: float = 0.92, key: str = "pos", vector: str = "embedding", length: Column | None = None, position: Column | None = None
) -> DataFrame:
    """Rows that stay, all columns. Taken by position (the key, unless one is given), or by length, longest first and ties by position, if a length is given.

    Exact at every size. Rows with equal vectors are similar to the same rows, so only the first of them meets others, and the rest go with it. Rows with a null or
    zero vector are similar to none and stay. Keys are unique.
    """
    order = [*([-length] if length is not None else []), F.col(key) if position is None else position]
    wanted = df.select(F.col(key).cast("long").alias("k"), F.col(vector).alias("v"), *[c.alias(f"o{i}") for i, c in enumerate(order)])
    unit = _unit(wanted, "v").filter(F.exists("v", lambda x: x != 0))
    ranked = global_rank(unit, *[F.col(f"o{i}") for i in range(len(order))], F.col("k"), name="r").select("k", "r", "v")
    firsts = ranked.groupBy("v").agg(F.min_by("k", "r").alias("k"), F.min("r").alias("r"))
    alike = ranked.join(firsts.select("k"), "k", "left_anti").select("k")
    gone = alike.union(greedy_gone(firsts.select("k", "r", "v"), threshold)) if threshold <= 1 else ranked.select("k").limit(0)
    return df.join(gone, df[key] == gone["k"], "left_anti")
