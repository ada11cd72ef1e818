import base64
import gzip
import hashlib
import io

import pytest

from quern.llm import warc

SMALL = "/root/testdata/sf0.001"


def check_round_trip(df):
    rows = [(r.page_id, (r.html or "").encode()) for r in df.collect()]
    first = {}
    for i, p in rows:
        if i is not None:
            first[p] = min(first.get(p, i), i)
    want = []
    for i, p in rows:
        again = p in first and i != first[p]
        want.append((str(i), len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", str(first[p] if again else None)))
    got = warc.warc_round_trip(df).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got) == sorted(want)


def test_round_trip(spark):
    check_round_trip(spark.read.parquet(f"{SMALL}/pages.parquet"))


def test_edges(spark):
    rows = [(1, "http://a/ b\r\nX: y", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (None, "u", "same"), (None, "u", "alone"), (5, "ü", "é\r\n\r\nWARC/1.1\r\n\r\n"), (1, "v", "same"), (6, "u", "x" * 3_000_000)]
    df = spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id long, url string, html string, digest string, first long")
    check_round_trip(df)
    check_round_trip(df.limit(0))


def test_small_payloads_are_no_revisits(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    got = {r.page_id: r.record_type for r in warc.warc_round_trip(df, min_revisit_bytes=3).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_normaliser_and_index(tmp_path):
    made = [warc.record_bytes(i, "u", b"p" * i * 100, warc.base32_sha1(b"p" * i * 100), None, False) for i in range(1, 40)]
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(b"".join(made[:20])) + gzip.compress(b"".join(made[20:])))
    ranges = warc.normalise_file(str(tmp_path / "a.warc.gz"), str(tmp_path / "out/a.warc.gz"))
    lines = (tmp_path / "out/a.warc.gz.idx").read_text().splitlines()
    assert len(ranges) == 1 and len(lines) == 39
    for record, line in zip(made, lines):
        offset, length = map(int, line.split("\t")[:2])
        assert warc.read_member(str(tmp_path / "out/a.warc.gz"), offset, length) == record
    with pytest.raises(ValueError):
        list(warc.records(warc.inflated(io.BytesIO(gzip.compress(made[3][:-50])))))


def test_pipeline_matches_plain_python(spark):
    import corpus_pipeline
    from test_lines_and_simhash import reachable, slow_fingerprint
    from test_texts import slow_hits, whole
    from tokenizers import Tokenizer

    from quern.llm import packing

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "decontaminate", "packing"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept = {r.doc_id: r.text for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    first = {}
    for i in sorted(kept):
        first.setdefault(kept[i], i)
    kept = {i: t for t, i in first.items()}
    component = reachable([(i, slow_fingerprint(t)) for i, t in kept.items()])
    kept = {i: t for i, t in kept.items() if component[i] == i}
    kept = {i: t for i, t in kept.items() if not slow_hits(t, items)[1]}
    tok = Tokenizer.from_file(packing.tokenizer_path())
    got = {}
    for r in corpus_pipeline.run(spark, SMALL).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == {i: len(whole(tok, t)) for i, t in kept.items()}


def test_stages_on_edges(spark, edge_docs, no_docs):
    import corpus_pipeline

    for start in (edge_docs, no_docs):
        df = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            df = stage(spark, df, SMALL)
            assert df.columns == edge_docs.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, df, SMALL).count() >= (start is edge_docs)
