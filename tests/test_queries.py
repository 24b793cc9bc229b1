"""A spread of registered queries against SQL, and registry hygiene."""

import os
import re

import oracle
import pytest

from tallygrid.catalog import load

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = load()
SAMPLE = [
    "Q1_section_winners", "Q2_section_results_ranked", "L1_summary_municipality", "L4_profile_estado", "L6_results_brasil_partido",
    "L11_top_profiles_all_levels", "H1_hist_profile_brasil", "A3_profile_vote_association", "A14_transfer_matrix", "C9_temporal_correlation",
    "M2_backtest", "P9_cramers_v", "P7_spearman_pairs", "S2_parse_number", "S19_quantile_band_4", "I1_read_json_records", "V7_state_map_history", "K1_hash_clusters_profile",
]


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, con, name):
    assert oracle.difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


def test_names_follow_the_inventory():
    assert len(QUERIES) > 200 and set(SQL) <= set(QUERIES)
    assert all(re.match(r"^[A-Z]\d+q?_\w+$", n) for n in QUERIES)
