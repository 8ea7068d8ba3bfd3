import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_check import compare  # noqa: E402

SF = os.environ.get("TIDELINE_TEST_SF", "/root/testdata/sf0.001")


def compare_one(spark, con, name):
    import __spark_entry__ as entry

    return compare(spark, SF, name, entry.queries()[name], entry.oracle_sql().get(name), con)
