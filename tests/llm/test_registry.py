import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from aloft.llm.oracle import ORACLE
from aloft.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert E.queries()["pipeline"] is corpus_pipeline.run and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_matches(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(E.oracle_sql()[name])
    columns = sorted(d[0] for d in want.description)
    at = {d[0]: i for i, d in enumerate(want.description)}
    want = sorted(str([r[at[c]] for c in columns]) for r in want.fetchall())
    got = E.queries()[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted(str([r[c] for c in columns]) for r in got.collect()) == want


RESULTS = {
    "op1_quality": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op2_sharding": "doc_id:bigint size:bigint text_crc32:bigint law:string shard:int slot:bigint grown_shard:int",
    "op4_permutation_index": "query_id:bigint rank:int vec_id:bigint score:double",
    "op5_packing": "doc_id:bigint start:bigint length:bigint ids_crc32:bigint doc_tokens:bigint sequence_id:bigint offset:bigint",
    "op6_maxscore": "query_id:bigint rank:int vec_id:bigint score:bigint",
    "op8_substring_dedup": "doc_id:bigint n_words:bigint n_removed:bigint kept_sha256:string",
    "op11_whitening": "vec_id:bigint component:int n:bigint deviation:bigint whitened:double explained:double identity_error:double",
    "op12_token_store": "doc_id:bigint start:bigint n_tokens:bigint ids_crc32:bigint",
    "op13_hard_negatives": "anchor_id:bigint positive_id:bigint rank:int negative_id:bigint positive_score:bigint negative_score:bigint",
    "op10_secret_scan": "doc_id:bigint n_assign:bigint n_access:bigint n_hex:bigint base_sha256:string spans:string",
}


@pytest.mark.parametrize("name", sorted(RESULTS))
def test_result_columns(spark, name):
    types = dict(QUERIES[name](spark, SF).dtypes)
    assert {c: types[c] for c in (x.split(":")[0] for x in RESULTS[name].split())} == dict(x.split(":") for x in RESULTS[name].split())
