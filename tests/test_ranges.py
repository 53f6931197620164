import datetime
import random

import pytest
from pyspark.sql import functions as F

from tickforge.operators import day_sketches
from tickforge.operators.range_join import micros, range_join, trailing_mean


@pytest.mark.parametrize(("how", "closed", "width"), [("inner", (True, True), 7), ("left", (True, False), 1), ("left", (False, True), 1000), ("inner", (False, False), 50)])
def test_points_and_ranges_by_brute_force(spark, how, closed, width):
    rng = random.Random(width)
    points = [(rng.choice(["a", "hot", "hot", None]), rng.choice([None, *range(-50, 400)]), i) for i in range(200)]
    ranges = []
    for j in range(60):
        low = rng.randrange(-60, 380)
        ranges.append((rng.choice(["a", "hot", None]), rng.choice([low, low, None]), low + rng.randrange(-5, 90), j))
    p, r = spark.createDataFrame(points, "k string, at long, i int"), spark.createDataFrame(ranges, "k string, lo long, hi long, j int")
    inside = lambda at, lo, hi: (lo <= at if closed[0] else lo < at) and (at <= hi if closed[1] else at < hi)
    want = []
    for k, at, i in points:
        hits = [(i, j) for kk, lo, hi, j in ranges if k is not None and k == kk and None not in (at, lo) and inside(at, lo, hi)]
        want += hits or ([(i, None)] if how == "left" else [])
    got = range_join(p, r, ["k"], "at", F.col("lo"), F.col("hi"), width, how, closed)
    assert got.columns == ["k", "at", "i", "lo", "hi", "j"]
    assert sorted(map(str, ((x["i"], x["j"]) for x in got.collect()))) == sorted(map(str, want))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError):
        range_join(p, r, ["k"], "at", F.col("lo"), F.col("hi"), width, "outer")


def test_trailing_mean_equals_the_window(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.randrange(60), rng.choice([None, 1.0, 2.5, 7.0])) for _ in range(150)]
    rows += rows[:5]
    got = trailing_mean(spark.createDataFrame(rows, "k string, d long, v double"), ["k"], "d", "v", 7, "m")
    for r in got.collect():
        inside = [v for k, d, v in rows if k == r["k"] and 0 <= r["d"] - d < 7 and v is not None]
        assert r["m"] == (pytest.approx(sum(inside) / len(inside)) if inside else None)
    assert got.count() == len(rows)
    t = spark.range(1).select(micros(F.lit("1970-01-01 00:00:02.000003").cast("timestamp_ntz")).alias("t")).first()
    assert t["t"] == 2_000_003


def test_sketches_of_days_over_any_range(spark):
    rng = random.Random(4)
    start = datetime.datetime(2024, 1, 1)
    rows = [(rng.choice(["x", "y"]), start + datetime.timedelta(hours=rng.randrange(24 * 20)), rng.gauss(0, 10) if rng.random() > 0.02 else None, rng.randrange(6000)) for _ in range(40_000)]
    df = spark.createDataFrame(rows, "g string, t timestamp_ntz, v double, item int")
    stored = day_sketches.sketch_days(df, ["g"], "t", "v", ["item"]).cache()
    assert stored.count() == 40
    for since, until in ((None, None), ("2024-01-03", "2024-01-09"), ("2024-01-15", None)):
        for r in day_sketches.over_days(stored, ["g"], since, until).collect():
            inside = [(v, i) for g, t, v, i in rows if g == r["g"] and v is not None and (since or "") <= str(t.date()) <= (until or "9")]
            values = sorted(v for v, _ in inside)
            assert (r["n"], r["low"], r["high"]) == (len(values), values[0], values[-1])
            assert r["mean"] == pytest.approx(sum(values) / len(values))
            assert r["distinct"] == pytest.approx(len({i for _, i in inside}), rel=0.04)
            for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
                rank = sum(v <= r[name] for v in values) / len(values)
                assert abs(rank - q) < 0.02
    # A day that is made again takes the place of what was stored.
    again = day_sketches.sketch_days(df.filter("to_date(t) = '2024-01-04'").limit(10), ["g"], "t", "v", ["item"])
    one = day_sketches.over_days(day_sketches.replace_days(stored, again), ["g"], "2024-01-04", "2024-01-04")
    assert sum(r["n"] for r in one.collect()) <= 10
    stored.unpersist()
    assert day_sketches.over_days(day_sketches.sketch_days(df.limit(0), ["g"], "t", "v", ["item"]), ["g"]).count() == 0
