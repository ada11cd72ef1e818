"""Capping, mixing to ratios, splitting, shuffling, and unions of sources.

What the random generator of a single process would pick cannot be had on a cluster; rows are ranked by a seeded hash of their key instead, so the
same rows give the same picks on any number of machines. Counts and ratios are as specified.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import seeded_key

# What each source is good for, and recipes in per cent.
SOURCE_PROFILE = {
    "ibranze": {"rank": 1, "strong": ["codegen", "api"], "weak": ["bugfix", "design", "perf"]},
    "erocal": {"rank": 2, "strong": ["bugfix", "design"], "weak": ["api"]},
    "vishnuoi": {"rank": 3, "strong": ["codegen", "api"], "weak": ["perf"]},
    "hypersniper": {"rank": 4, "strong": ["api"], "weak": ["bugfix", "design", "perf"]},
    "gamedev": {"rank": 5, "strong": ["design", "bugfix"], "weak": ["perf"]},
    "common_pile": {"rank": 6, "strong": [], "weak": ["perf"]},
    "perf": {"rank": 0, "strong": ["perf"], "weak": []},
}
ABILITIES = ["api", "bugfix", "codegen", "design", "perf"]
MIX_RECOMMENDED = {"ibranze": 40, "erocal": 30, "hypersniper": 20, "gamedev": 10}
MIX_RECOMMENDED_PERF = {"ibranze": 37, "erocal": 28, "hypersniper": 17, "gamedev": 10, "perf": 8}
MIX_VISHNUOI_BACKBONE = {"vishnuoi": 55, "erocal": 25, "hypersniper": 10, "gamedev": 10}
MIX_SINGLE_IBRANZE = {"ibranze": 100}
CURRICULUM_PHASE1 = {"ibranze": 70, "hypersniper": 30}
CURRICULUM_PHASE2 = {"erocal": 55, "gamedev": 25, "perf": 20}
MIX_STRICT = {"hypersniper": 40, "vishnuoi": 25, "erocal": 20, "ibranze": 10, "gamedev": 5}
TARGET_TOTAL = 100_000


def round_half_even(x: float) -> int:
    return round(x)


def quotas(counts: dict[str, int], mix: dict[str, float], target: int | None) -> dict[str, int]:
    """Rows per source. Nothing is ever repeated: the scarcest source sets the total."""
    wanted = {s: w for s, w in mix.items() if w > 0 and counts.get(s, 0) > 0}
    if not wanted:
        raise ValueError("none of the mix's sources has rows")
    whole = sum(wanted.values())
    share = {s: w / whole for s, w in wanted.items()}
    feasible = min(counts[s] / share[s] for s in share)
    total = feasible if target is None else min(feasible, target)
    return {s: min(round_half_even(total * share[s]), counts[s]) for s in share}


#: Hex digits of the seeded hash that deal a source's rows into ranges, whose counts tell where a cut lies.
_DIGITS = 4


def cap_per_source(df: DataFrame, caps: dict[str, int | None] | int, seed: int = 42, key: str = "pos", source: str = "source") -> DataFrame:
    """At most so many rows of each source: those whose seeded hashes come first; sources without a cap stay whole.

    Counts of hash ranges say in which range a source's cut lies. Rows of earlier ranges stay and those of later ones go without being ranked; only the range with the cut
    is, so no task ever has a whole source. The input is read for the counts (keys alone) and for each of the two parts.
    """
    if isinstance(caps, int):
        limit: Column = F.lit(caps)
    else:
        caps = {s: n for s, n in caps.items() if n is not None}
        if not caps:
            return df
        limit = F.coalesce(*[F.when(F.col(source) == s, n) for s, n in caps.items()])
    rows = df.select(F.struct("*").alias("row"), F.col(source).alias("s"), limit.cast("long").alias("cap"), seeded_key(seed, F.col(source), F.col(key)).alias("h"), F.col(key).alias("k"))
    free = rows.filter(F.col("cap").isNull()).select("row.*")
    rows = rows.filter(F.col("cap").isNotNull()).withColumn("range", F.substring("h", 1, _DIGITS))
    counts = rows.groupBy("s", "range").agg(F.count(F.lit(1)).alias("n"), F.max("cap").alias("cap"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("s").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    met = counts.withColumn("room", F.col("cap") - before)
    # per source the first range that does not fit whole, and the rows of it that still do
    edges = met.filter(F.col("room") < F.col("n")).groupBy(F.col("s").alias("of")).agg(F.min(F.struct("range", "room")).alias("edge"))
    # a row per source: sent to the rows, which a join by source would shuffle into one task per source
    dealt = rows.join(F.broadcast(edges), F.col("s").eqNullSafe(F.col("of")), "left")
    sure = dealt.filter(F.col("edge").isNull() | (F.col("range") < F.col("edge.range"))).select("row.*")
    place = F.row_number().over(Window.partitionBy("s").orderBy("h", "k"))
    cut = dealt.filter(F.col("range") == F.col("edge.range")).withColumn("place", place).filter(F.col("place") <= F.col("edge.room")).select("row.*")
    capped = sure.unionByName(cut)
    return capped if isinstance(caps, int) else free.unionByName(capped)


def apply_mix(df: DataFrame, mix: dict[str, float | None], target: int | None = None, seed: int = 42, key: str = "pos", source: str = "source") -> DataFrame:
    """Rows by the mix's shares. Weights of None or 0 count as absent; sources that the mix doesn't name go; those it names and nobody has are warned of."""
    wanted = {s: w for s, w in mix.items() if w}
    counts = {r[0]: r[1] for r in df.filter(F.col(source).isin(list(wanted))).groupBy(source).count().collect()}
    if missing := [s for s in wanted if not counts.get(s)]:
        warnings.warn(f"the mix names sources without rows: {', '.join(missing)}", stacklevel=2)
    picked = quotas(counts, wanted, target)
    chosen = df.filter(F.col(source).isin(list(picked)))
    return cap_per_source(chosen, picked, seed, key, source)


def split_flag(df: DataFrame, ratio: float, seed: int = 42, key: str = "pos") -> Column:
    """True for the ceil(rows * ratio) rows whose seeded hashes come first: a comparison with a cut-off, so that marking them needs neither a rank nor a join.

    The cut-off is found from counts of hash ranges (keys alone are read) and from the rows of the one range in which it lies. Rows that share a key are on one side.
    """
    rows = df.select(seeded_key(seed, F.col(key)).alias("h"), F.col(key).alias("k")).withColumn("range", F.substring("h", 1, _DIGITS))
    counts = sorted(tuple(r) for r in rows.groupBy("range").count().collect())  # at most 16 ** _DIGITS
    room = math.ceil(sum(n for _, n in counts) * ratio)
    for at, n in counts:
        if room <= n:
            break
        room -= n
    if not counts or room < 1:
        return F.lit(False)
    inside = rows.filter(F.col("range") == at).orderBy("h", "k").limit(room)
    last = inside.agg(F.max(F.struct("h", "k")).alias("m")).first()["m"]
    return F.struct(seeded_key(seed, F.col(key)).alias("h"), F.col(key).alias("k")) <= F.struct(F.lit(last["h"]).alias("h"), F.lit(last["k"]).cast(df.schema[key].dataType).alias("k"))


def split(df: DataFrame, ratio: float, seed: int = 42, key: str = "pos") -> tuple[DataFrame, DataFrame]:
    """(train, test). The test set has ceil(rows * ratio) rows: those whose seeded hashes come first."""
    test = split_flag(df, ratio, seed, key)
    return df.filter(~test), df.filter(test)


def restored(df: DataFrame, *order: str) -> DataFrame:
    """Rows back in their original order (by pos, unless columns are named), for a sink: selection leaves none."""
    return df.orderBy(*(order or ("pos",)))


def seeded_shuffle(df: DataFrame, seed: int = 42, key: str = "pos") -> DataFrame:
    return df.orderBy(seeded_key(seed, F.col(key)), F.col(key))


def sample_cap(df: DataFrame, most: int, seed: int = 42, key: str = "pos") -> DataFrame:
    return seeded_shuffle(df, seed, key).limit(most)


def head(df: DataFrame, n: int, key: str = "pos") -> DataFrame:
    return df.orderBy(key).limit(n)


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """A bag union in order; ``pos`` becomes (place of the source, own position)."""
    if not frames:
        raise ValueError("no sources")
    out = None
    for i, f in enumerate(frames):
        f = f.withColumn("pos", F.struct(F.lit(i).alias("source_no"), F.col("pos").cast("long").alias("native")))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def unrequested(df: DataFrame, requested: list[str], source: str = "source") -> DataFrame:
    """The sources that df has and nobody asked for."""
    return df.select(source).filter(~F.col(source).isin(requested) | F.col(source).isNull()).distinct()


def extra_source(df: DataFrame, name: str, overwrite: bool = True) -> DataFrame:
    """An outside table as a source. With overwrite only messages (and pos) stay and the source is set; else its own source and columns stay."""
    if "messages" not in df.columns:
        raise ValueError(f"{name} has no messages")
    if overwrite or "source" not in df.columns:
        kept = df.select("messages", *(["pos"] if "pos" in df.columns else [])) if overwrite else df
        df = kept.withColumn("source", F.lit(name))
    return df


def coverage(sources: DataFrame) -> DataFrame:
    """sources: column name. The sources that are strong in each ability, joined; empty where none is."""
    spark = sources.sparkSession
    profile = spark.createDataFrame([(s, a) for s, p in SOURCE_PROFILE.items() for a in p["strong"]], "name string, ability string")
    abilities = spark.createDataFrame([(a,) for a in ABILITIES], "ability string")
    found = profile.join(sources, "name", "left_semi")
    strong = F.array_join(F.array_sort(F.collect_list("name")), ",")
    return abilities.join(found, "ability", "left").groupBy("ability").agg(strong.alias("sources"), F.count("name").alias("n"))


def abstain_rows(n_knowledge: int, ratio: float) -> int:
    """Rows to add so that they make up ``ratio`` (0 to 0.5) of the whole."""
    r = max(0.0, min(ratio, 0.5))
    return round_half_even(n_knowledge * r / (1 - r))


def fallback_schedule(batch: int, length: int, accum: int) -> list[tuple[int, int, int]]:
    """(batch, length, accumulation) to try in turn when memory runs out: halve the batch, halve the length, then trade the batch for accumulation."""
    half_batch, half, quarter = max(1, batch // 2), max(512, length // 2), max(512, length // 4)
    tries = [(batch, length, accum), (half_batch, length, accum), (half_batch, half, accum), (1, half, accum * 2), (1, quarter, accum * 4)]
    return list(dict.fromkeys(tries))


# Memory in GB from which a tier holds, then batch, accumulation and length.
TIERS = [(70, 8, 4, 4096), (35, 4, 8, 4096), (20, 2, 16, 2048), (0, 1, 16, 1024)]


def tier(memory: Column) -> Column:
    """struct<batch, accum, length>."""
    out = None
    for least, *values in reversed(TIERS):
        value = F.struct(*[F.lit(v).alias(n) for v, n in zip(values, ("batch", "accum", "length"))])
        out = value if out is None else F.when(memory >= least, value).otherwise(out)
    return out
