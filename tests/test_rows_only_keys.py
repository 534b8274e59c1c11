"""Invariants of keys whose oracle rows are stated by hand."""

from conftest import SF0001
from docketflow.schemas import RAW_SCHEMAS
from docketflow.sources.standin import time_entries
from docketflow.streaming.registry import STREAM_QUERIES


def test_rows_per_source_file_covers_whole_source(spark):
    rows = {r.source: r for r in STREAM_QUERIES["rows_per_source_file"](spark, SF0001).collect()}
    assert rows["time_entries"].n_rows == time_entries(spark, SF0001).count() and set(rows) == set(RAW_SCHEMAS)
    assert all(r.n_unknown == 0 and r.all_in_landing and r.several_files for r in rows.values())


def test_inferred_schema_matches_frozen_schema(spark):
    got = {(r.source, r.field): r.type for r in STREAM_QUERIES["infer_raw_schema"](spark, SF0001).collect()}
    for source, schema in RAW_SCHEMAS.items():
        for f in schema.fields:
            assert got[(source, f.name)] == f.dataType.simpleString(), (source, f.name)
    assert {s for s, _ in got} == set(RAW_SCHEMAS)


def test_table_catalog_lists_every_layer_table(spark):
    rows = STREAM_QUERIES["table_catalog"](spark, SF0001).collect()
    assert len(rows) == 12
    by_quality = {}
    for r in rows:
        assert r.comment
        by_quality.setdefault(r.quality, set()).add(r.table)
    assert {q: len(t) for q, t in by_quality.items()} == {"bronze": 4, "silver": 4, "gold": 4}
    assert all(t.startswith(q + "_") for q, ts in by_quality.items() for t in ts)
