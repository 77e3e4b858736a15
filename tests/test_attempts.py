import datetime

from cohortlens.sources import testdata as td

DAY = datetime.datetime(2000, 1, 1, 12, 30)


def _tables(spark, path):
    """Repeated lines, orders without a status, lines without a number, quantity, date or key."""
    at = lambda i: DAY + datetime.timedelta(days=i)
    orders = [(i, None if i == 7 else i % 8, None if i % 9 == 0 else "F" if i % 2 else "O") for i in range(40)] + [(None, 1, "F"), (3, 5, "F")]
    lines = [(i % 40, None if i == 5 else i % 9, None if i % 17 == 0 else i % 5 + 1, None if i % 11 == 0 else float(i), None if i % 13 == 0 else at(i)) for i in range(200)]
    lines += [(None, 1, 1, 9.0, at(2)), (3, 1, 3, 50.0, at(3)), (3, 1, 3, 50.0, at(3)), (11, 77, 4, 1.0, None), (99, 1, 1, 1.0, at(1))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_shipdate timestamp").write.parquet(f"{path}/lineitem.parquet")
    return orders, lines


def _nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i))


def test_the_lines_meet_the_orders_without_their_raw_columns(spark, tmp):
    _tables(spark, tmp)
    plan = td.course_attempts(td.TestTables(spark, tmp))._jdf.queryExecution().optimizedPlan()
    join, = (n for n in _nodes(plan) if n.nodeName() == "Join")
    sides = [join.children().apply(i).output() for i in range(2)]
    names = [{side.apply(i).name() for i in range(side.size())} for side in sides]
    assert names == [{"l_orderkey", "l_partkey", "quantity", "late", "shipped"}, {"o_orderkey", "o_custkey", "closed"}]


def test_attempts_of_odd_lines(spark, tmp):
    orders, lines = _tables(spark, tmp)
    most = lambda xs: max((x for x in xs if x is not None), default=None)
    groups = {}
    for okey, part, number, quantity, shipped in lines:
        for key, cust, status in orders:
            if key is not None and key == okey:
                t = None if shipped is None else int(shipped.timestamp())
                fin = status == "F" and number is not None and number >= 3
                groups.setdefault((cust, part), []).append((quantity if number is not None and number <= 3 else None, t, int(fin), t if fin else 0))
    want = []
    for key, rows in groups.items():
        quantity, shipped, completed, at = (most(c) for c in zip(*rows))
        want.append((*key, None if quantity is None else quantity * 2, shipped, completed, at))
    got = [tuple(r) for r in td.course_attempts(td.TestTables(spark, tmp)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(want) > 40
    assert any(r[4] == 1 and r[5] is None for r in want)
