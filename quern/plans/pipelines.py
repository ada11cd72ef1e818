"""Whole builds of a corpus: default, by curriculum, strict."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.messages import alpaca, assistant_text, fingerprint, is_valid, last_user, rendered
from quern.functions.shared import stored
from quern.functions.text import word_count
from quern.operators import dedup, filters, mix, quality, synth

#: Counts tokens of a rendered conversation; the default counts words, a tokenizer's count can be given instead.
Counter = Callable[[Column], Column]


def to_format(df: DataFrame, output: str, render: Callable[[Column], Column] | None = None, keep_system: bool = True) -> DataFrame:
    """messages, alpaca or text; pos and source stay beside them for splitting and reports."""
    meta = [c for c in ("pos", "source") if c in df.columns]
    if output == "messages":
        return df.select(*meta, "messages")
    if output == "alpaca":
        return df.select(*meta, alpaca(F.col("messages"), keep_system).alias("a")).select(*meta, "a.*")
    if output == "text":
        if render is None:
            raise ValueError("text needs a template: give render")
        return df.select(*meta, render(F.col("messages")).alias("text"))
    raise ValueError("the output is messages, alpaca or text")


def unique(df: DataFrame, plain: DataFrame | None = None) -> DataFrame:
    """One row per fingerprint: by the sources' priority if both of its sources are there, else the first. plain: the same rows without observations, which a look for
    the sources would end before all rows were seen."""
    priority = dedup.active_priority(df if plain is None else plain)
    return dedup.by_priority(df.withColumn("fp", fingerprint(F.col("messages"))), "fp", "source", F.col("pos"), priority=priority).drop("fp")


def _stage(df: DataFrame, condition: Column, name: str, seen: list) -> DataFrame:
    kept, observed = filters.keep(df, condition, name)
    seen.append((name, observed))
    return kept


def _settled(df: DataFrame, name: str, seen: list, telemetry: list | None) -> DataFrame:
    """df, written once so that counts, picks and splits behind it read a table and not the sources again. With a telemetry list, (stage, rows before, rows after) of the
    filters so far are added to it; what dedup takes away lies between two of them."""
    out = stored(df, name)
    if telemetry is not None:
        telemetry += [(n, o.get["before"], o.get["after"]) for n, o in seen]
    return out


def _warn_of_sources(names: list[str], recipe: dict | None) -> None:
    if dedup.overlapping(names, None) and dedup.overlapping(names, recipe):
        warnings.warn(f"one of {' and '.join(dedup.PRIORITY)} contains the other: copies are kept of the first only", stacklevel=3)
    if recipe and (extra := [n for n in names if not recipe.get(n)]):
        warnings.warn(f"sources without a weight in the mix go: {', '.join(extra)}", stacklevel=3)


def build_corpus(
    sources: dict[str, DataFrame],
    caps: dict[str, int] | None = None,
    recipe: dict[str, float] | None = None,
    target: int | None = None,
    extra: dict[str, DataFrame] | None = None,
    max_length: int = 2048,
    count_tokens: Counter = word_count,
    val_ratio: float = 0.05,
    seed: int = 42,
    max_samples: int | None = None,
    output: str = "messages",
    telemetry: list | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(train, eval). Caps come before cleaning and so are absolute; the mix comes after it and so is exact."""
    if output not in ("messages", "text"):
        raise ValueError("the output is messages or text")
    caps, seen = caps or {}, []
    _warn_of_sources([*sources, *(extra or {})], recipe)
    frames = [mix.cap_per_source(f, {n: caps.get(n)}, seed) for n, f in sources.items()]
    frames += [mix.cap_per_source(mix.extra_source(f, n), {n: caps.get(n)}, seed) for n, f in (extra or {}).items()]
    plain, valid = mix.union_sources(frames), is_valid(F.col("messages"))
    df = _stage(plain, valid, "valid", seen)
    df = _stage(unique(df, plain.filter(valid)), filters.short_enough(count_tokens(rendered(F.col("messages"))), max_length), "length", seen)
    df = df.withColumn("pos", F.concat_ws(":", F.col("pos.source_no").cast("string"), F.col("pos.native").cast("string")))
    df = _settled(df, "corpus", seen, telemetry)
    if recipe:
        df = mix.apply_mix(df, recipe, target, seed)
    if max_samples is not None:
        df = mix.sample_cap(df, max_samples, seed)
    return mix.split(to_format(df, output, rendered), val_ratio, seed)


def build_curriculum(sources: dict[str, DataFrame], phase1: dict | None = None, phase2: dict | None = None, extra: dict[str, DataFrame] | None = None, **options):
    """Two builds, each with the sources and extras that its mix names."""
    out = []
    for recipe in (phase1 or mix.CURRICULUM_PHASE1, phase2 or mix.CURRICULUM_PHASE2):
        own = {n: f for n, f in sources.items() if n in recipe}
        more = {n: f for n, f in (extra or {}).items() if n in recipe}
        out.append(build_corpus(own, recipe=recipe, extra=more, **options))
    return tuple(out)


def build_strict(
    sources: dict[str, DataFrame],
    recipe: dict[str, float] | None = None,
    target: int = mix.TARGET_TOTAL,
    caps: dict[str, int] | None = None,
    extra: dict[str, DataFrame] | None = None,
    abstain_ratio: float = 0.02,
    max_length: int = 2048,
    count_tokens: Counter = word_count,
    strict: bool = True,
    embed: Callable[[DataFrame], DataFrame] | None = None,
    threshold: float = 0.92,
    output: str = "messages",
    val_ratio: float = 0.05,
    seed: int = 42,
    telemetry: list | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, eval, quality). embed adds a column ``embedding`` of the last user's turn; without it the semantic step is skipped with a warning."""
    seen: list = []
    recipe, caps = dict(recipe or mix.MIX_STRICT), caps or {}
    ratio = max(0.0, min(abstain_ratio, 0.5))
    knowledge = {k: v for k, v in recipe.items() if k != "abstain"}
    if unknown := [n for n in knowledge if n not in sources and n not in (extra or {})]:
        warnings.warn(f"skipped unknown sources: {', '.join(unknown)}", stacklevel=2)
    frames = [mix.cap_per_source(sources[n], {n: caps.get(n)}, seed) for n in knowledge if n in sources]
    frames += [mix.cap_per_source(mix.extra_source(f, n, overwrite=False), {n: caps.get(n)}, seed) for n, f in (extra or {}).items()]
    m = F.col("messages")
    df = plain = mix.union_sources(frames)
    for name, condition in (("valid", is_valid(m)), ("unambiguous", filters.unambiguous(m)), ("current", filters.up_to_date(m, strict)), ("grounded", filters.grounded(m))):
        df, plain = _stage(df, condition, name, seen), plain.filter(condition)
    df = unique(df, plain)
    df = df.withColumn("pos", F.concat_ws(":", F.lpad(F.col("pos.source_no").cast("string"), 6, "0"), F.lpad(F.col("pos.native").cast("string"), 20, "0")))
    if embed is not None:
        df = _settled(df, "deduplicated", seen, telemetry)
        seen = []
        keyed = embed(df.withColumn("user", last_user(m))).withColumn("__key", F.xxhash64("pos"))
        df = dedup.semantic_dedup(keyed, threshold, "__key", "embedding", F.length(assistant_text(m)), position=F.col("pos")).drop("__key", "embedding", "user")
    else:
        warnings.warn("no embeddings: semantic dedup was skipped", stacklevel=2)
    df = _settled(_stage(df, filters.short_enough(count_tokens(rendered(m)), max_length), "length", seen), "strict", seen, telemetry)
    df = mix.apply_mix(df, knowledge, mix.round_half_even(target * (1 - ratio)), seed).select("pos", "messages", "source")
    if ratio > 0 and (n := df.count()):
        df = df.unionByName(synth.abstain(df.sparkSession, mix.abstain_rows(n, ratio), seed))
    train, test = mix.split(to_format(df, output, rendered), val_ratio, seed)
    return train, test, quality.quality(df)
