"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, in_order, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    columns, rows = spark_rows(spark, name, FOLDER)
    if name in entry.oracle_sql():
        expected_columns, expected = sql_rows(con, name)
        assert columns == expected_columns
        assert rows == expected
    else:
        assert rows


def test_entry(spark):
    df = entry.entry(spark)
    assert in_order(df.columns, df.collect())[1]


def test_every_survey_id_is_covered():
    from checks import CHECKS

    covered = {i for c in CHECKS.values() for i in c.ids}
    groups = {"S": 10, "C": 27, "F": 8, "J": 7, "A": 15, "W": 3, "U": 2, "K": 8, "Q": 5, "P": 3,
              "T": 3, "D": 4}
    wanted = {f"{g}{n}" for g, top in groups.items() for n in range(1, top + 1)}
    assert wanted <= covered
