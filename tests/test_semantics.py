"""Golden edge cases and properties of the engine's own operators."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.functions import messages as M
from quern.functions import text as T
from quern.operators import dedup, evalmetrics, filters, mix, synth, trainlog
from quern.plans import pipelines
from quern.sources import loaders, sinks


def one(spark, col, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(col.alias("x")).first()["x"]


def talk(*turns):
    return F.array(*[M.message(r, F.lit(c)) for r, c in turns]) if turns else F.array().cast(M.MESSAGES)


def test_clean(spark):
    assert one(spark, T.clean(F.lit(None))) == ""
    assert one(spark, T.clean(F.lit("  a \x1c "))) == "a"


def test_trimming_is_by_the_class_of_white_space(spark):
    every = spark.createDataFrame([(chr(i),) for i in range(0x10000) if not 0xD800 <= i < 0xE000], "c string")
    assert {r.c for r in every.filter(F.col("c").rlike(f"^{T.WS}$")).collect()} == set(T.WS_CHARS)
    texts = ["", " ", "\u3000a\u2028b \r\n", "\x85\n", "a\n", "\u200ba\u200b ", "x\u00a0\u180e\u00a0", "é\u205f🙂\x1f"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    by_pattern = F.regexp_replace("s", rf"^{T.WS}+|{T.WS}+$", "")
    assert all(a == b for a, b in df.select(T.clean(F.col("s")), by_pattern).collect())
    assert "regexp_replace" not in df.select(T.clean(F.col("s")))._jdf.queryExecution().optimizedPlan().toString()


def test_signs_of_guessing_lose_no_match(spark):
    texts = ["I'm not sure", "I am NOT certain", "im not certain", "ı thinK it might", "I THINK could", "not 100% ſure", "I gueſs", "PROBABLY it's", "maybe TRY", "i don't really \u212anow but", "아마도", "아마 맞", "확실하지 않",
             "잘 모르겠지만", "추측컨대", "장담은 못", "확신은 없", "아닐 수도", "일 수도 있", "plain", "thank gue maybe", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    plain = F.regexp_count("s", F.lit(filters._java(filters.SPECULATIVE, "(?iUd)"))) == 0
    rows = df.select(plain.alias("a"), filters.grounded_text(F.col("s")).alias("b")).collect()
    assert all(r.a == r.b for r in rows) and sum(r.a is False for r in rows) >= 16
    # a text without a sign is told by looking for strings: the pattern stands behind a condition
    assert "CASE WHEN" in df.select(filters.grounded_text(F.col("s")))._jdf.queryExecution().optimizedPlan().toString()


def test_caps_never_shuffle_rows_by_source(spark):
    """One source's rows went to one task before: the join with the cuts shuffled them by source."""
    df = spark.range(500).select(F.col("id").alias("pos"), F.when(F.col("id") < 400, "a").otherwise("b").alias("source"), F.col("id").cast("string").alias("text"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = mix.cap_per_source(df, {"a": 50, "b": 500})
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert {r["source"]: r["count"] for r in got.groupBy("source").count().collect()} == {"a": 50, "b": 100}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_priority_needs_no_pass_over_sources_that_cannot_be_there(spark):
    """A strict build filtered everything twice before: once to look for the sources of the priority."""
    boom = F.expr("CASE WHEN raise_error('a row was read') IS NULL THEN true END")
    df = rows_of(spark, 5, "erocal").withColumn("source", F.lit("erocal")).filter(boom)
    assert dedup.active_priority(df) is None
    some = spark.createDataFrame([("ibranze",), ("vishnuoi",), (None,)], "source string")
    assert dedup.active_priority(some) == dedup.PRIORITY and dedup.active_priority(some.filter("source <> 'ibranze'")) is None


def test_places_of_lines_by_splits_without_a_shuffle(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part-{i}.json").write_text("".join(f'{{"question": "q{i}-{k}", "answer": "{"a" * (k % 7 + 1)}"}}\n' for k in range(40 + i)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
        df = loaders.json_lines(spark, str(tmp_path))
        assert "hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
        got = [(r.pos, r.messages[1].content) for r in df.orderBy("pos").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(enumerate([f"q{i}-{k}" for i in range(3) for k in range(40 + i)], 1))
    (tmp_path / "none.json").write_text("")
    assert loaders.json_lines(spark, str(tmp_path / "none.json"), schema="question string, answer string").count() == 0


def test_html_order(spark):
    rows = spark.createDataFrame([("&lt;b&gt;x",), ("List<int> a",), (None,)], "s string").select(T.strip_html(F.col("s")).alias("x"))
    assert [r.x for r in rows.collect()] == ["<b>x", "List a", ""]


def test_html_entities_without_a_semicolon(spark):
    """By default as HTML has it; the catalog's queries take closed ones alone, as their SQL does."""
    texts = ["a &amp b", "&quot x", "c&amp", "&amp;amp; &lt;b&gt; &#39; &#x41; &nosuch; &copyx;", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    both = [tuple(r) for r in df.select(T.strip_html(F.col("s")), T.strip_html(F.col("s"), closed=True)).collect()]
    assert [a for a, _ in both] == ["a & b", '" x', "c&", "&amp; <b> ' A &nosuch; ©x;", ""]
    assert [b for _, b in both] == ["a &amp b", "&quot x", "c&amp", "&amp; <b> ' A &nosuch; &copyx;", ""]


@pytest.mark.parametrize("name", ["html_strip", "html_strip_messages"])
def test_html_queries_match_sql_on_cut_pages(name, spark, tmp_path, check_same):
    import duckdb

    from quern.plans import catalog

    rows = [(1, "u", "<p>one &amp</p>two &middot; &copy;"), (2, "u", "x &quot</p> &quot;y&quot; &am"), (3, "u", "&amp;quot; &amp;amp;")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    check_same(catalog.QUERIES[name](spark, str(tmp_path)).toPandas(), con.execute(catalog.ORACLE[name]).df())


def test_detected_pairs(spark):
    df = spark.createDataFrame([("", "q", "a"), ("i", "q", "a"), (None, None, "a"), ("i", " ", None)], "instruction string, input string, output string")
    got = [r.m for r in df.select(M.detected(df).alias("m")).collect()]
    assert [m[1].content if m else None for m in got] == ["q", "i\n\nq", None, None]


def test_detected_conversations(spark):
    df = spark.createDataFrame([([("tool", "x"), ("gpt", " y ")], "q", "a"), ([], "q", "a")], "conversations array<struct<from:string,value:string>>, question string, answer string")
    got = [[(t.role, t.content) for t in r.m] for r in df.select(M.detected(df).alias("m")).collect()]
    assert got[0][1:] == [("user", "x"), ("assistant", "y")]
    assert got[1][1:] == [("user", "q"), ("assistant", "a")]


def test_system_is_kept(spark):
    assert one(spark, M.with_system(talk(("system", "mine"), ("user", "u"))))[0].content == "mine"
    assert one(spark, M.with_system(talk()))[0].content == M.SYSTEM_PROMPT


@pytest.mark.parametrize("turns", [[("user", "u")], [("assistant", "a")], [("user", "u"), ("assistant", " ")], [], [("user", " "), ("assistant", "a")]])
def test_invalid(spark, turns):
    assert one(spark, M.is_valid(talk(*turns))) is False


def test_alpaca(spark):
    a = one(spark, M.alpaca(talk(("system", "S"), ("user", "u1"), ("assistant", "a1"), ("user", "u2"), ("assistant", "a2"))))
    assert (a.instruction, a.input, a.output) == ("[System] S\n[User] u1\n[Assistant] a1\n[User] u2", "", "a2")
    assert one(spark, M.alpaca(talk())).output == ""


@pytest.mark.parametrize("text,kept", [("x;", True), ("help", False), ("이거 왜 안 돼?", False), ("도help me with this thing", True), ("...", False), ("too short", False), ("one two three four", True)])
def test_ambiguous(spark, text, kept):
    assert one(spark, filters.unambiguous_text(F.lit(text))) is kept


@pytest.mark.parametrize("text,kept", [("I guess ```x```", True), ("I guess Foo.Bar", True), ("I guess so", False), ("아마도 그래요", False), ("sure", True)])
def test_speculative(spark, text, kept):
    assert one(spark, filters.grounded_text(F.lit(text))) is kept


@pytest.mark.parametrize("text,kept", [("foo.rigidbody.x", True), ("this.rigidbody.x", False), ("camera here", True), ("the camera, then", False), ("new WWW", False), ("WWWForm f; WWW w", False), ("WWWForm\nWWW", False), ("WWWForm x\nWWW", True)])
def test_deprecated(spark, text, kept):
    assert one(spark, filters.up_to_date(talk(("assistant", text)))) is kept


def test_meta(spark):
    df = spark.createDataFrame([("abc", "1"), ("9", None), ("9", "false"), ("9", "17"), ("4", "1"), (None, "yes")], "score string, accepted string")
    assert [r.x for r in df.select(filters.meta_ok(df).alias("x")).collect()] == [True, False, False, True, False, True]
    df = spark.createDataFrame([(5, True), (4, True), (5, None)], "votes int, is_accepted boolean")
    assert [r.x for r in df.select(filters.meta_ok(df).alias("x")).collect()] == [True, False, False]


def test_priority(spark):
    def kept(rows):
        df = spark.createDataFrame(rows, "pos long, source string, fp string")
        return dedup.by_priority(df, "fp", "source", F.col("pos"), priority=dedup.active_priority(df)).first()["source"]

    assert kept([(0, "erocal", "k"), (1, "vishnuoi", "k"), (2, "ibranze", "k")]) == "ibranze"
    assert kept([(0, "erocal", "k"), (1, "ibranze", "k")]) == "erocal"


def test_semantic_chain(spark):
    nodes = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 4)], "vec_id long, rank long")
    pairs = spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")
    assert sorted(r.vec_id for r in dedup.greedy_keep(nodes, pairs).collect()) == [1, 3, 4]


def test_similar_pairs_by_planes_finds_close_ones(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    base = rng.standard_normal((60, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, base + 0.01 * rng.standard_normal(base.shape)]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    exact = {(r.a, r.b) for r in dedup.similar_pairs(df, 0.95).collect()}
    assert exact == {(i, i + 60) for i in range(60)}
    assert {(r.a, r.b) for r in dedup.similar_pairs(df, 0.95, exact=False).collect()} == exact


def test_similar_pairs_are_all_found_in_a_large_table(spark):
    """More rows than 20,000, and a threshold at which random planes find next to nothing: every pair of planted vectors."""
    import numpy as np
    from pyspark.sql import functions as F

    c = 0.35
    near = [[1.0] + [0.0] * 15] + [[c] + [float(np.sqrt(1 - c * c)) if j == i else 0.0 for j in range(15)] for i in range(15)]
    planted = spark.createDataFrame([(i, v) for i, v in enumerate(near)], "vec_id long, embedding array<double>")
    zeros = spark.range(100, 20_200).select(F.col("id").alias("vec_id"), F.array_repeat(F.lit(0.0), 16).alias("embedding"))
    got = {(r.a, r.b) for r in dedup.similar_pairs(planted.union(zeros), 0.30).collect()}
    assert got == {(0, i) for i in range(1, 16)}


def test_quotas():
    assert mix.quotas({"a": 100, "b": 10}, {"a": 50, "b": 50}, None) == {"a": 10, "b": 10}
    assert mix.quotas({"a": 100}, {"a": 50, "b": 50}, 20) == {"a": 20}
    with pytest.raises(ValueError):
        mix.quotas({}, {"a": 1}, None)


@given(st.dictionaries(st.sampled_from("abcde"), st.integers(1, 1000), min_size=1), st.dictionaries(st.sampled_from("abcde"), st.integers(1, 100), min_size=1), st.integers(1, 5000))
def test_quotas_never_exceed(counts, recipe, target):
    if not set(counts) & set(recipe):
        return
    got = mix.quotas(counts, recipe, target)
    assert all(n <= counts[s] for s, n in got.items())
    assert sum(got.values()) <= target + len(got)


def test_caps_and_split(spark):
    df = spark.range(100).select(F.col("id").alias("pos"), F.when(F.col("id") < 80, "a").otherwise("b").alias("source"))
    assert {r.source: r["count"] for r in mix.cap_per_source(df, {"a": 5, "b": None}).groupBy("source").count().collect()} == {"a": 5, "b": 20}
    train, test = mix.split(df, 0.05)
    assert (train.count(), test.count(), train.join(test, "pos").count()) == (95, 5, 0)


def test_schedule_and_shares():
    assert mix.fallback_schedule(4, 4096, 8) == [(4, 4096, 8), (2, 4096, 8), (2, 2048, 8), (1, 2048, 16), (1, 1024, 32)]
    assert mix.abstain_rows(98_000, 0.02) == 2000
    assert mix.abstain_rows(10, 0.9) == 10


def test_abstain(spark):
    assert synth.abstain(spark, 5000).count() == 2120
    assert synth.abstain(spark, -1).count() == 0


@pytest.mark.parametrize("base,tuned,imp,label", [(0.0, 1.0, None, "N/A"), (None, 1.0, None, "N/A"), (2.0, 2.0, 0.0, "N/A"), (2.0, 3.0, 50.0, "+50.00%"), (2.0, 1.0, -50.0, "-50.00%")])
def test_improvement(spark, base, tuned, imp, label):
    i = evalmetrics.improvement(F.lit(base).cast("double"), F.lit(tuned).cast("double"))
    assert one(spark, i) == imp
    assert one(spark, evalmetrics.improvement_label(i)) == label


def test_forward_fill_takes_the_newest_whole(spark):
    df = spark.createDataFrame([(1, None, 0.5, 0.9), (2, 1.0, None, None), (3, None, 0.4, None), (4, 1.0, None, None)], "step long, loss double, eval_loss double, acc double")
    got = trainlog.forward_fill(df, F.col("eval_loss").isNotNull(), ["eval_loss", "acc"], ["step"])
    assert [(r.last_eval_loss, r.last_acc) for r in got.orderBy("step").collect()] == [(0.5, 0.9), (0.4, None)]


def test_backfill_only_if_the_last_step_is_missing(spark):
    df = spark.createDataFrame([(1, 0.5), (2, None)], "step long, train_loss double")
    assert trainlog.final_backfill(df, 2).count() == 2
    assert trainlog.final_backfill(df, 3).filter("step = 3").first()["train_loss"] == 0.5


SPACES = "".join(chr(c) for c in range(0x3100) if chr(c).isspace())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from("abAB한글éß.;?'" + SPACES), max_size=30), min_size=20, max_size=60))
def test_text_functions_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    rows = df.select("s", T.clean(F.col("s")).alias("c"), T.word_count(F.col("s")).alias("w"), M.fingerprint(F.array(M.message("user", F.col("s")))).alias("f")).collect()
    import hashlib

    for r in rows:
        assert r.c == r.s.strip()
        assert r.w == len(r.s.split())
        assert r.f == hashlib.sha256(f"user:{re.sub(chr(92) + 's+', ' ', r.s.lower()).strip()}".encode()).hexdigest()


def test_sources_round_trip(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"question": "q", "answer": "a"}\n{"instruction": "i", "input": "x", "output": "o"}\n{"messages": [{"role": "user", "content": "u"}]}\n')
    got = loaders.json_lines(spark, str(tmp_path / "a.jsonl")).collect()
    assert [r.source for r in got] == ["perf"] * 3 and [len(r.messages) for r in got] == [3, 3, 2]
    (tmp_path / "b.jsonl").write_text('{"member": "A", "summary": "s"}\n\nnot json\n{"member": "", "summary": "s"}\n')
    assert loaders.api_entries(spark, str(tmp_path / "b.jsonl")).count() == 1
    (tmp_path / "s.json").write_text('{"epoch": 2.0, "log_history": [{"step": 1, "loss": 0.5}, {"step": 1, "eval_loss": 0.4}]}')
    state = loaders.trainer_state(spark, str(tmp_path / "s.json"))
    assert state.filter(trainlog.is_train()).count() == 1 and state.filter(trainlog.is_eval()).count() == 1
    for i in (9, 10):
        (tmp_path / f"run/checkpoint-{i}").mkdir(parents=True)
        (tmp_path / f"run/checkpoint-{i}/w.bin").write_bytes(b"x" * i)
    cps = loaders.checkpoints(spark, str(tmp_path / "run"))
    assert trainlog.latest_checkpoint(cps).first()["path"].endswith("checkpoint-10") and cps.agg(F.sum("bytes")).first()[0] == 19
    assert loaders.from_rows(spark, None).count() == 0
    with pytest.raises(ValueError):
        loaders.load(["nothing"], {})
    with pytest.warns(UserWarning):
        assert loaders.load(["nothing"], {}, strict=False) == {}
    assert loaders.split_or_first({"x": 1}) == 1


def test_sinks_round_trip(spark, tmp_path):
    log = spark.createDataFrame([(1.0, 1, 0.5, None, None, None, 0.1, None, None)], trainlog.LOG_SCHEMA)
    sinks.append_log(log, str(tmp_path / "log"))
    sinks.append_log(log, str(tmp_path / "log"))
    assert loaders.training_log(spark, str(tmp_path / "log")).count() == 2
    table = spark.createDataFrame([("Loss", 2.0, 1.0, "+50.00%"), ("BLEU", None, 1.0, "N/A")], "metric string, base_model double, finetuned_model double, improvement string")
    sinks.metrics_csv(table, str(tmp_path / "m"))
    assert spark.read.option("header", True).csv(str(tmp_path / "m")).count() == 2
    sinks.metrics_json(table.limit(1), str(tmp_path / "j"))
    assert loaders.json_document(spark, str(tmp_path / "j")).count() == 1
    assert "| Loss | 2.0000 | 1.0000 | +50.00% |" in sinks.markdown_report(table, series=["loss"])
    sinks.json_lines(table, str(tmp_path / "k"))
    assert sinks.mirror(str(tmp_path / "k"), str(tmp_path / "copy"))[0] > 0
    with pytest.warns(UserWarning):
        assert sinks.mirror(str(tmp_path / "nowhere"), str(tmp_path / "copy2")) is None


def rows_of(spark, n, source):
    df = spark.range(n).select(F.col("id").alias("pos"), F.concat(F.lit(f"how does {source} number "), F.col("id").cast("string"), F.lit(" work")).alias("q"), F.concat(F.lit(f"answer {source} "), F.col("id").cast("string")).alias("a"))
    return df.select("pos", M.pair(F.col("q"), F.col("a")).alias("messages"), F.lit(source).alias("source"))


def test_builds(spark):
    sources = {s: rows_of(spark, n, s) for s, n in (("ibranze", 40), ("erocal", 30), ("hypersniper", 20))}
    train, test = pipelines.build_corpus(sources, recipe={"ibranze": 50, "erocal": 50}, val_ratio=0.1)
    assert (train.count(), test.count()) == (54, 6)
    first, second = pipelines.build_curriculum(sources, extra={"perf": rows_of(spark, 10, "perf")})
    assert first[0].count() + first[1].count() == 57 and second[0].count() > 0
    with pytest.warns(UserWarning):
        train, test, report = pipelines.build_strict(sources, {"ibranze": 50, "hypersniper": 50, "gone": 5}, output="alpaca", abstain_ratio=0.2)
    assert train.count() + test.count() == 50 and {r.source: r.n for r in report.collect()} == {"ibranze": 20, "hypersniper": 20, "abstain": 10}
    with pytest.raises(ValueError):
        pipelines.to_format(sources["erocal"], "text")
    with pytest.raises(ValueError):
        pipelines.build_corpus(sources, output="alpaca")


def test_strict_with_embeddings(spark):
    sources = {"ibranze": rows_of(spark, 12, "ibranze")}
    same = lambda df: df.withColumn("embedding", F.array(F.lit(1.0), F.lit(0.0)))
    train, test, _ = pipelines.build_strict(sources, {"ibranze": 1}, embed=same, abstain_ratio=0.0, val_ratio=0.0)
    assert train.count() + test.count() == 1


def test_observation(spark):
    kept, seen = filters.keep(spark.range(10), F.col("id") < 3, "stage")
    assert kept.count() == 3 and seen.get == {"before": 10, "after": 3}


def test_stream(spark, tmp_path):
    from quern.streaming import trainlog as stream

    rows = [("r", 1, False, 2.0, None, 5, 10), ("r", 2, True, 0.7, 0.5, None, None), ("r", 3, False, 1.5, None, 5, 5), ("r", 4, False, 1.0, None, 5, 5)]
    spark.createDataFrame(rows, stream.EVENTS).coalesce(1).write.parquet(str(tmp_path / "in"))
    events = spark.readStream.schema(stream.EVENTS).parquet(str(tmp_path / "in"))
    q = stream.monitored(events, 2).writeStream.format("memory").queryName("monitored").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = [(r.step, r.last_eval_loss, r.window_accuracy) for r in spark.table("monitored").orderBy("step").collect()]
    assert got == [(1, None, None), (3, 0.7, None), (4, 0.7, 1.0)] or got == [(1, None, None), (3, 0.7, None), (4, 0.7, 0.75)]


def test_keyword_stream(spark, tmp_path):
    spark.createDataFrame([("Unity a\n\nb",), ("other\n\nb",), ("unity alone",)], "text string").write.parquet(str(tmp_path / "in"))
    s = loaders.keyword_stream(spark, str(tmp_path / "in"), "text string")
    q = s.writeStream.format("memory").queryName("kw").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("kw").count() == 1


@pytest.mark.parametrize("signs,patterns", [(filters.REMOVED_SIGNS, filters.REMOVED_API_PATTERNS), (filters.DEPRECATED_SIGNS, filters.DEPRECATED_API_PATTERNS)])
def test_signs_cover_the_patterns(spark, signs, patterns):
    """Verdicts with the signs are those of the patterns alone."""
    import random

    rng = random.Random(9)
    words = re.findall("[A-Za-z0-9]+", " ".join(patterns).replace("\\b", " ").replace("\\s", " ").replace("\\w", " "))
    texts = ["".join(rng.choice([*words, *words, ".", ".", " ", " ", "[", "]", ";", "new ", "this."]) for _ in range(rng.randint(1, 9))) for _ in range(4000)]
    texts += [re.sub(r"\\b|\\s[*+]|\(\?[=!<][^)]*\)|[()?*]", "", p).replace("\\", "") + "; WWW" for p in patterns]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", filters._has(F.col("t"), signs, patterns).alias("quick"), F.col("t").rlike(filters._java("|".join(patterns))).alias("plain")).collect()
    assert [r.t for r in rows if r.quick != r.plain] == [] and any(r.plain for r in rows)
    assert all(any(s in p.replace("\\", "") for s in signs) for p in patterns)


@pytest.mark.parametrize("threshold", [0.30, 0.50, 0.80, 0.92])
def test_planes_keep_their_recall(spark, threshold):
    """More than 20,000 vectors with planted pairs just above the threshold."""
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.standard_normal((300, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.standard_normal(base.shape)
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    c = threshold + 0.005
    planted = np.concatenate([base, c * base + np.sqrt(1 - c * c) * side])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(planted)], "vec_id long, embedding array<double>")
    rest = spark.range(1000, 21_000).select(F.col("id").alias("vec_id"), F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.randn(5) * 0 + F.sin(F.xxhash64("id", i).cast("double"))).alias("embedding"))
    rest = rest if threshold >= 0.8 else rest.limit(0)
    got = {(r.a, r.b) for r in dedup.similar_pairs(df.union(rest), threshold, exact=False).filter("b < 1000").collect()}
    assert len({(i, i + 300) for i in range(300)} & got) >= 0.9 * 300


def test_semantic_dedup_of_clusters_and_copies(spark):
    """Equal, near, zero and null vectors, against going through the rows one by one."""
    import numpy as np

    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, 8))
    x = centres[rng.integers(0, 12, 400)] + 0.25 * rng.standard_normal((400, 8))
    x[50:120] = x[0]
    x[130:135] = 0
    rows = [(i, v.tolist() if i != 140 else None, int(rng.integers(1, 9))) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "pos long, embedding array<double>, n int")
    for by_length in (False, True):
        kept: list[int] = []
        for i, v, n in sorted(rows, key=lambda r: (-r[2] if by_length else 0, r[0])):
            u = np.array(v or [0.0] * 8)
            u = u / np.linalg.norm(u) if u.any() else u
            if not kept or max(float(u @ k) for _, k in kept) < 0.9:
                kept.append((i, u))
        got = {r.pos for r in dedup.semantic_dedup(df, 0.9, length=F.col("n") if by_length else None).collect()}
        assert got == {i for i, _ in kept}


def test_caps_with_ties_and_null_sources(spark):
    df = spark.range(1000).select(F.col("id").alias("pos"), F.when(F.col("id") % 2 == 0, "a").alias("source"))
    assert sorted(r["count"] for r in mix.cap_per_source(df, 7).groupBy("source").count().collect()) == [7, 7]
    same = spark.range(100).select(F.lit(1).alias("pos"), F.lit("a").alias("source"))
    assert mix.cap_per_source(same, 7).count() == 7 and mix.cap_per_source(same, {"a": 0}).count() == 0
    assert mix.cap_per_source(df, {"b": 3}).count() == 1000
    train, test = mix.split(df.limit(0), 0.5)
    assert train.count() == test.count() == 0
    with pytest.warns(UserWarning):
        assert mix.apply_mix(df, {"a": 1, "gone": 2, "c": None}).count() == 500


def test_stream_stops_when_it_has_enough(spark, tmp_path):
    for i in range(6):
        spark.range(4).selectExpr("concat('Unity ', id, '\n\nb') AS text").coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    s = spark.readStream.schema("text string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    assert loaders.take_stream(s, str(tmp_path / "out"), str(tmp_path / "cp"), most=6) == 6
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def test_build_telemetry(spark):
    seen = []
    sources = {s: rows_of(spark, n, s) for s, n in (("ibranze", 40), ("erocal", 30))}
    pipelines.build_corpus(sources, telemetry=seen)
    assert seen == [("valid", 70, 70), ("length", 70, 70)]
    with pytest.warns(UserWarning, match="contains the other"):
        pipelines.build_corpus({s: rows_of(spark, 5, s) for s in ("ibranze", "vishnuoi")})


def test_token_counter_and_places(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["some words, here.", "", None, "é🙂 x" * 50]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    tok = Tokenizer.from_file(path)
    assert [r.n for r in df.select(T.token_counter(path)(F.col("t")).alias("n")).collect()] == [len(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="ab .x", max_size=14), st.text(alphabet="ab .x", max_size=14))
def test_rouge_l_is_the_longest_common_subsequence(a, b):
    from itertools import combinations

    x, y = evalmetrics.rouge_tokens(a), evalmetrics.rouge_tokens(b)
    longest = next((n for n in range(min(len(x), len(y)), 0, -1) if {*combinations(x, n)} & {*combinations(y, n)}), 0)
    p, r = (longest / len(x), longest / len(y)) if longest else (0, 0)
    assert evalmetrics.rouge_l_f(a, b) == pytest.approx(2 * p * r / (p + r) if longest else 0.0)
