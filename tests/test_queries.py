"""Registered queries against their SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.check_queries import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = """unenriched_scan oldest_unenriched backlog embedding_text latin_slug
tld_from_name slug_candidates candidates_variant_b discovery_chain page_body jsonld_block
feed_categories site_signals structure_validate merge_items batch_numbers
source_distribution model_embedding""".split()


def test_every_query_has_sql():
    own = set(entry.queries()) - set(entry.LLM_QUERIES)
    assert own == set(entry.oracle_sql()) - set(entry.LLM_SQL)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
@pytest.mark.parametrize("name", SAMPLE)
def test_query(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name) is None
