"""The corpus pipeline, stage by stage and as a whole, and the registered queries."""

import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from llm_cases import ODD, SF_SMALL
from test_dedup import plain_groups
from tokenizers import Tokenizer

import __spark_entry__ as entry
from roadlake.llm import chunk_dedup, quality

NAMES = [name for name, _ in corpus_pipeline.STAGES]


def test_stages_on_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()
    stages = [f for _, f in corpus_pipeline.STAGES]
    assert NAMES == ["quality classifier", "SimHash near-dedup", "substring dedup", "packing"]
    good = stages[0](spark, docs, SF_SMALL).cache()
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = quality.train(docs, labels, rows=~quality.held_out())
    accepted = {r.doc_id for r in quality.score(docs, model).where("predicted = 1").collect()}
    assert good.schema == docs.schema and {r.doc_id for r in good.collect()} == accepted
    one = stages[1](spark, good, SF_SMALL).cache()
    firsts = {c for _, _, c in plain_groups([(r.doc_id, r.text) for r in good.collect()])}
    assert one.schema == docs.schema and sorted(r.doc_id for r in one.collect()) == sorted(firsts)
    cut = stages[2](spark, one, SF_SMALL).cache()
    expected = {(r.row.doc_id, r.kept if r.spans else r.row.text) for r in
                chunk_dedup.repeats(one).selectExpr("row", "spans", "cast(kept as string) kept").collect()}
    assert cut.schema == docs.schema
    assert {(r.doc_id, r.text) for r in cut.collect()} == {e for e in expected if e[1].strip()}
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    pieces = stages[3](spark, cut, SF_SMALL).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {}
    for r in sorted(pieces, key=lambda r: r.start):
        ids[r.doc_id] = ids.get(r.doc_id, b"") + bytes(r.ids)
    assert {i: zlib.crc32(x) for i, x in ids.items()} == {
        r.doc_id: zlib.crc32(np.array(tok.encode(r.text, add_special_tokens=False).ids + [1], "<u4").tobytes()) for r in cut.collect()}
    whole = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in whole if r.start == 0 and r.length == r.doc_tokens) != []
    assert sum(r.length for r in whole) == sum(r.length for r in pieces)


def test_stages_on_odd_rows(spark, odd, none):
    for docs, least in ((odd, 1), (none, 0)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF_SMALL)
            rows = out.collect()
            assert len(rows) >= least and (k == 3 or out.columns == docs.columns)
    assert len(ODD) == odd.count()


def test_every_query_is_registered():
    names = list(entry.queries())
    assert [n for n in names if n.startswith("op")] and "pipeline" in names
    assert sorted({int(n[2:].split("_")[0]) for n in names if n.startswith("op")}) == list(range(1, 14))


@pytest.mark.parametrize("name", [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()])
def test_query_columns(spark, name):
    wanted = {
        1: "doc_id held_out n_tokens n_known train_tokens base_score score", 3: "vec_id n_links component_id kept",
        5: "query_id rank vec_id score", 6: "doc_id start n_tokens ids_crc32",
        7: "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        8: "doc_id n_words n_base first_word last_word base_labels labels score", 9: "doc_id held_out score predicted",
        10: "doc_id fingerprint component_id", 11: "doc_id size text_crc32 law shard slot grown_shard",
        12: "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256", 13: "word form root n n_near form_n"}
    out = entry.queries()[name](spark, SF_SMALL)
    assert set(wanted.get(int(name[2:].split("_")[0]), "doc_id").split()) <= set(out.columns)
    assert out.count() > 0


@pytest.mark.parametrize("name", ["op3_cover_tree", "op5_bit_sliced_topk"])
def test_query_matches_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    out = entry.queries()[name](spark, SF_SMALL)
    rel = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in rel.description]
    assert sorted(columns) == sorted(out.columns)
    assert sorted(map(tuple, out.select(*columns).collect())) == sorted(rel.fetchall())
