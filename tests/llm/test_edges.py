"""Every operator and stage on nulls, empty and very long texts, ties, repeats, empty tables and
columns whose names clash with its own."""

from __future__ import annotations

import pytest

import corpus_pipeline
from cases import SF, frame, rows
from tickhouse.llm import (
    decontamination,
    licenses,
    linededup,
    packing,
    quality,
    secrets,
    simhash,
    suffixdedup,
    tokencounts,
    warc,
)


def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


OPERATORS = {
    "op1": lambda s, d: suffixdedup.digest(suffixdedup.remove_repeats(d)),
    "op2": lambda s, d: secrets.digest(secrets.scan(d)),
    "op3": lambda s, d: licenses.scan(d),
    "op4": lambda s, d: tokencounts.token_counts(d),
    "op5": lambda s, d: packing.pack(d),
    "op6": lambda s, d: simhash.near_duplicates(d),
    "op8": lambda s, d: linededup.dedup_lines(d).select("row.doc_id", "removed", "kept"),
    "op9": lambda s, d: quality.apply_policy(quality.ledger(d)),
    "op10": lambda s, d: decontamination.report(decontamination.scan(d, benchmark(s))),
}
PER_DOCUMENT = {"op1", "op2", "op4", "op6", "op8", "op9", "op10"}


def plain(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_operator(spark, name):
    operator = OPERATORS[name]
    got = operator(spark, frame(spark))
    found = plain(got)
    if name in PER_DOCUMENT:
        assert len(found) == len(rows())
    if name == "op5":
        whole = {}
        for r in got.collect():
            whole.setdefault(r.doc_id, 0)
            whole[r.doc_id] += r.length
        assert set(whole) == {r[0] for r in rows()}
    assert plain(operator(spark, frame(spark, extra=True))) == found
    assert operator(spark, frame(spark, [])).collect() == []


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage(spark, name, stage):
    docs = frame(spark)
    got = stage(spark, docs, SF)
    if stage is not corpus_pipeline.sequence_packing:
        assert got.columns == docs.columns
    wide = stage(spark, frame(spark, extra=True), SF)
    if stage is not corpus_pipeline.sequence_packing:
        assert "queue" in wide.columns and plain(wide.select(docs.columns)) == plain(got)
    else:
        assert plain(wide) == plain(got)
    assert stage(spark, frame(spark, []), SF).collect() == []


def test_defined_results(spark):
    docs = frame(spark)
    kept = {(r.doc_id, r.text) for r in simhash.keep_one(docs).collect()}
    by_id = {r[0]: r[1] for r in rows()}
    assert (0, None) in kept  # null, empty and blank texts are one group; the smallest id stays
    assert not {(1, ""), (2, by_id[2])} & kept
    assert (4, by_id[4]) in kept and (5, by_id[5]) not in kept
    assert sum(1 for i, _ in kept if i == 11) == 1
    assert all(i is not None for i, _ in kept)
    lines = {r.doc_id: r for r in linededup.keep_lines(docs).collect()}
    assert lines[0].text is None and 5 not in lines
    assert lines[8].text == by_id[8].split("\n")[0] and lines[8].n_chars == len(lines[8].text)
    quality_ids = [r.doc_id for r in quality.keep_good(docs).collect()]
    assert 0 not in quality_ids and quality_ids.count(11) == 3 and None in quality_ids


def test_archive_edges(spark, tmp_path):
    big, other = "<p>" + "a" * 2000, "<p>" + "b" * 2000 + "\r\n\r\nWARC/1.1\r\n\r\n"
    data = [(1, "http://a", big), (5, None, big), (5, None, big), (3, "u\r\nX: y", big), (None, "n", big),
            (7, "http://b", other), (8, "http://c", other), (9, "d", None), (10, "e", ""),
            (11, "s", "short"), (12, "t", "short"), (13, "z", "é" * 600), (14, "z", "é" * 600)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").selectExpr(
        "*", "1 AS payload", "2 AS original")
    warc.write_archive(pages, str(tmp_path / "w"))
    from tickhouse.llm.common import saved
    read = warc.resolve_references(saved(warc.read_archive(spark, str(tmp_path / "w")))).collect()
    assert len(read) == len(data)
    got = sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in read)
    size = len(big)
    want = sorted([
        ("1", "revisit", "5", size), ("5", "response", None, size), ("5", "response", None, size),
        ("3", "revisit", "5", size), ("None", "revisit", "5", size),
        ("7", "revisit", "8", len(other)), ("8", "response", None, len(other)),
        ("9", "response", None, 0), ("10", "response", None, 0), ("11", "response", None, 5),
        ("12", "response", None, 5), ("13", "revisit", "14", 1200), ("14", "response", None, 1200)],
        key=str)
    assert sorted(got, key=str) == want
    assert all(r.intact for r in read if r.record_type == "response")
    back = warc.restore(spark, str(tmp_path / "w")).collect()
    assert sorted((str(r.page_id), bytes(r.payload).decode()) for r in back) == sorted(
        (str(i), h or "") for i, _, h in data)
    assert {r.url for r in back if r.page_id == "3"} == {"u%0D%0AX: y"}
    warc.write_archive(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archive(spark, str(tmp_path / "none")).collect() == []


def test_damaged_archive_is_refused():
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nab\r\n\r\n"))
