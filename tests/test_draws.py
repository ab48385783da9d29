import math

from pyspark.sql import functions as F

from upland.operators import draws, works


def test_trenches_repeat_and_lie_inside(spark):
    a, b, c = (draws.draw_trenches(spark, first, n, 250.0, 200.0, seed).orderBy("tid").collect() for first, n, seed in ((0, 40, 1), (10, 30, 1), (0, 40, 2)))
    assert a[10:] == b and a != c and [r.tid for r in a] == list(range(40))
    assert {r.width for r in a} <= set(draws.WIDTHS) and 8 <= sum(r.theta != 0 for r in a) <= 32
    assert all(0.6 <= r.depth <= 2 and 5 <= r.l1 <= 80 and (r.theta == 0) == (r.radius == 0) == (r.l2 == 0) for r in a)
    assert all(math.radians(15) <= abs(r.theta) <= math.radians(120) and max(8, 5 * r.width) <= r.radius <= 40 for r in a if r.theta)
    inside = works.inside_site(works.trench_geometry(spark.createDataFrame(a)), 250.0, 200.0)
    assert inside.where("inside").count() == 40


def test_cables_lie_inside(spark):
    rows = draws.draw_cables(spark, 5, 50, 300.0, 300.0, {33: (1.4, 0.9), 132: (3.185, 1.05)}, 7).orderBy("rid").collect()
    assert [r.rid for r in rows] == list(range(5, 55)) and {r.kv for r in rows} == {33, 132} and len({sum(t != 0 for t in r.turns) for r in rows}) > 2
    for r in rows:
        assert (r.radius, r.depth) == ((1.4, 0.9) if r.kv == 33 else (3.185, 1.05)) and len(r.legs) == 5 and len(r.turns) == 4
        x, y, h = r.x0, r.y0, r.h0
        for k, leg in enumerate(r.legs):
            assert 3 < x < 297 and 3 < y < 297 and (leg == 0 or 3 <= leg <= 300)
            x, y = x + leg * math.cos(h), y + leg * math.sin(h)
            h += r.turns[k] if k < 4 else 0


def test_points_are_spread(spark):
    p = draws.draw_points(spark, 0, 4000, 4, 256.0, 3)
    counts = [r["count"] for r in p.groupBy("tile").count().orderBy("tile").collect()]
    assert len(counts) == 4 and all(850 < n < 1150 for n in counts)
    got = p.agg(F.avg("u"), F.min("u"), F.max("v")).first()
    assert 120 < got[0] < 136 and 0 < got[1] < 3 and 253 < got[2] < 256
