"""A few catalog queries against their SQL twins; check.py runs them all."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.oracles import ORACLES
from catalog.queries import QUERIES
from check import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", [
    "alignment_filter_stats", "window_sums_w5", "window_diffs", "signal_peaks", "ecdf_pvalues", "reported_sites",
    "umi_dedup_directional", "subsample", "interval_ops", "motif_semiglobal", "event_islands"])
def test_query_equals_sql(spark, name):
    mine = queries()[name](spark, SF).toPandas()
    assert len(mine) and compare(mine, connect(SF).execute(oracle_sql()[name]).fetchdf()) == ""
