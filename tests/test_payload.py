"""Payload flattening and page checks (N1-N9), including the paging cases of the original tests."""

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import payload as pl


@pytest.mark.parametrize("total,size", [(1000, 500), (750, 500), (0, 500), (37, 500), (1, 500), (1200, 500), (5, 1)])
def test_pages(spark, total, size):
    rows = spark.range(total).select(F.col("id"), F.floor(F.col("id") / size).alias("page"))
    chk = pl.page_check(rows, size).collect()
    assert sum(r.n_rows for r in chk) == total
    assert all(r.ok for r in chk)
    assert len(chk) == (total + size - 1) // size


def test_short_page_in_the_middle_is_flagged(spark):
    rows = spark.createDataFrame([(0,), (0,), (1,), (2,), (2,)], "page long")
    bad = [r.page for r in pl.page_check(rows, 2).collect() if not r.ok]
    assert bad == [1]


def test_nested_flattening(spark):
    m = spark.createDataFrame([(1, [10, 11]), (2, None)], "cohortid long, userids array<long>")
    assert sorted(tuple(r) for r in pl.explode_members(m).collect()) == [(1, 10), (1, 11)]
    r = spark.createDataFrame([(0, [(0, "zero"), (5, "a"), (6, "b")]), (1, [(5, "a2"), (None, "n")])],
                              "position int, users array<struct<id:long,username:string>>")
    got = sorted(tuple(x) for x in pl.users_from_rosters(r).collect())
    assert got == [(5, "a"), (6, "b")]
    c = spark.createDataFrame([(1, 2, None), (1, 3, (True, 9))],
                              "userid long, courseid long, completionstatus struct<completed:boolean,timecompleted:long>")
    assert sorted(tuple(x) for x in pl.flatten_completion(c).collect()) == [(1, 2, False, None), (1, 3, True, 9)]
    assert pl.coalesce_sources([None, m]) is m
