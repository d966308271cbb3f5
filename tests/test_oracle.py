"""Queries against their SQL counterparts at sf0.01. ``SIFTWORK_ALL_QUERIES=1`` checks every query, else a choice is made."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as entry

FOLDER = os.environ.get("SIFTWORK_SF_DIR", "/root/testdata/sf0.01")
CHOSEN = (
    "normalize_text", "pii_mask_all", "quality_rules", "filter_report_by_source", "curate_documents", "exact_line_dedup",
    "lsh_buckets", "jaccard_pairs", "dup_clusters", "html_extract", "zip_mismatches", "url_domain", "url_domain_rules", "url_sample",
    "lang_id", "threshold_curve", "train_quality_nb", "train_quality_lr", "response_stats", "response_quarantine",
    "build_set_from_responses", "incremental_report", "tokenize_docs", "token_offsets", "token_report", "pack_sequences",
)
NAMES = sorted(entry.oracle_sql()) if os.environ.get("SIFTWORK_ALL_QUERIES") else CHOSEN

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    assert differences(entry.queries()[name](spark, FOLDER), connect(FOLDER), entry.oracle_sql()[name]) == ""


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
