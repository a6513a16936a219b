"""Queries of the operators against their SQL; those without have a brute-force test, named here."""

import inspect
from importlib import import_module
from pathlib import Path

import duckdb
import pytest
from check_oracle import compare

from tests.conftest import SF_DIR
from tidewright.llm.queries import QUERIES
from tidewright.llm.sql import ORACLE

#: Module and function of the brute-force test of each query that SQL cannot express.
BRUTE_FORCE = {
    "op2_multi_index": ("test_ann", "test_recall"),
    "op3_source_mix": ("test_mixing", "test_documents"),
    "op4_best_fit_packing": ("test_packing", "test_pack_documents"),
    "op5_syncmer_fingerprints": ("test_syncmers", "test_query_on_documents"),
    "op7_pii_surrogates": ("test_pii", "test_documents"),
    "op8_secret_scan": ("test_secrets", "test_query_on_documents"),
    "op9_language_id": ("test_lang_id", "test_evidence_is_fused_as_by_hand"),
    "page_language": ("test_lang_id", "test_pages_equal_brute_force"),
    "pipeline": ("test_pipeline", "test_near_duplicates"),
    "op10_simhash_near_dedup": ("test_simhash", "test_odd_rows"),
    "op11_conversation_repair": ("test_conversations", "test_query_equals_brute_force"),
    "op12_vector_codes": ("test_vector_codes", "test_query_equals_brute_force"),
    "op13_bpe_round_trip": ("test_bpe", "test_query_equals_the_library"),
}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR).startswith("ok: ")


def test_each_query_has_a_test():
    assert QUERIES.keys() | {"pipeline"} == ORACLE.keys() | BRUTE_FORCE.keys()
    for module, name in BRUTE_FORCE.values():
        assert inspect.isfunction(getattr(import_module(f"tests.llm.{module}"), name))
