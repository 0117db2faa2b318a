"""The registered queries of the subpackage: against their SQL, or their columns and rows."""

import subprocess
import sys
from pathlib import Path

import pytest

from oracle import compare, connect
from voxtally.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]
CONTRACT = {
    "op2_secrets": "doc_id n_assign n_access n_hex base_sha256 spans", "op3_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op4_quality": "doc_id held_out score predicted", "op9_languages": "doc_id held_out lang_pred score",
    "op8_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name, QUERIES[name], SQL[name]) == []


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_query_covers_every_document(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id")
    assert set(CONTRACT[name].split()) <= set(got.columns)
    assert docs.exceptAll(got.select("doc_id").distinct()).count() == 0
    assert name == "op3_packing" or got.count() == docs.count()


def test_library_works_without_the_subpackage(tmp_path):
    for name in ("voxtally", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(ROOT / name)
    code = (
        "import sys; sys.modules['voxtally.llm'] = None; import __spark_entry__ as e; "
        "assert e.queries() and not any(k.startswith('op') or k == 'pipeline' for k in e.queries()); assert e.oracle_sql()")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
