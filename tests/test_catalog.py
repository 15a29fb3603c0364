import subprocess
import sys
from pathlib import Path

import pytest
from oracle import assert_same

import __spark_entry__ as driver


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert_same(driver.queries()[name](spark, sf_dir), driver.oracle_sql()[name], sf_dir)


def test_every_query_is_named_in_both(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_has_rows(spark):
    result = driver.entry(spark)
    assert result.columns == ["user_id", "show_id", "total_count"]
    assert result.count() > 0


@pytest.mark.parametrize("blocked", ["showpulse.llm", "showpulse.llm.queries", "ahocorasick", "corpus_pipeline"])
def test_queries_remain_when_a_package_is_missing(blocked):
    code = f"""
import sys
sys.modules[{blocked!r}] = None
import __spark_entry__ as driver
from showpulse.plans.catalog import QUERIES
assert set(QUERIES) <= set(driver.queries()), driver.queries()
assert set(driver.oracle_sql()) <= set(driver.queries())
assert "pipeline" not in driver.queries()
"""
    subprocess.run([sys.executable, "-c", code], cwd=Path(driver.__file__).parent, check=True)
