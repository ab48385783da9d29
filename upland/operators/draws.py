"""Seeded works inside a site, drawn by executors: every value is a hash of seed, number and try, so a draw repeats
whatever the partitions are. A work that doesn't fit into the site is tried again."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .cable import BENDS
from .works import centreline, trench_geometry

#: Tries of a work in one round, and rounds before a site counts as too small.
TRIES, ROUNDS = 32, 64
#: Widths of trenches (m).
WIDTHS = (0.3, 0.45, 0.6, 0.9, 1.2)
TRENCH = ("e0", "n0", "heading", "l1", "theta", "radius", "l2", "width", "depth")


class Dice:
    """Uniform values of a row, told apart by a name."""

    def __init__(self, seed: int, *keys: str):
        self.seed, self.keys = seed, keys

    def unit(self, name: str) -> Column:
        """In (0, 1)."""
        return (F.pmod(F.xxhash64(*self.keys, F.lit(self.seed), F.lit(name)), F.lit(1 << 52)) + 0.5) / float(1 << 52)

    def between(self, name: str, lo: Column | float, hi: Column | float) -> Column:
        return lo + (hi - lo) * self.unit(name)

    def one_of(self, name: str, values: tuple) -> Column:
        return F.get(F.array(*map(F.lit, values)), F.floor(self.unit(name) * len(values)).cast("int"))


def _first_that_fits(numbers: DataFrame, key: str, draw: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """For each number the first try that draw marks as inside."""
    done = None
    for k in range(ROUNDS):
        tried = numbers.withColumn("attempt", F.explode(F.sequence(F.lit(k * TRIES), F.lit((k + 1) * TRIES - 1))))
        fits = draw(tried).where("inside").drop("inside")
        names = [c for c in fits.columns if c not in (key, "attempt")]
        got = fits.groupBy(key).agg(F.min_by(F.struct(*names), "attempt").alias("v")).select(key, "v.*").persist()
        done = got if done is None else done.unionByName(got)
        numbers = numbers.join(got.select(key), key, "left_anti")
        if numbers.isEmpty():
            return done
    raise ValueError("the site is too small for works of this kind")


def _within(x: Column, y: Column, width_m: float, height_m: float, margin: float) -> Column:
    """Whether all places (arrays x, y) keep clear of the site's sides."""
    return (F.array_min(x) > margin) & (F.array_min(y) > margin) & (F.array_max(x) < width_m - margin) & (F.array_max(y) < height_m - margin)


def draw_trenches(spark: SparkSession, first: int, n: int, width_m: float, height_m: float, seed: int, margin: float = 5.0, places: int = 64) -> DataFrame:
    """Trenches first .. first + n - 1 (tid, e0, n0, heading, l1, theta, radius, l2, width, depth), wholly inside, about half of them bent."""
    dice = Dice(seed, "tid", "attempt")

    def draw(tried: DataFrame) -> DataFrame:
        bent = dice.unit("bent") < 0.5
        t = tried.withColumn("width", dice.one_of("width", WIDTHS)).select(
            "tid", "attempt", "width", dice.between("east", 0.0, width_m).alias("e0"), dice.between("north", 0.0, height_m).alias("n0"), dice.between("heading", 0.0, 2 * math.pi).alias("heading"),
            dice.between("first", 5.0, 80.0).alias("l1"), F.when(bent, dice.between("turn", math.radians(15), math.radians(120)) * dice.one_of("side", (-1.0, 1.0))).otherwise(0.0).alias("theta"),
            F.when(bent, dice.between("radius", F.greatest(F.lit(8.0), 5 * F.col("width")), F.lit(40.0))).otherwise(0.0).alias("radius"), F.when(bent, dice.between("second", 5.0, 80.0)).otherwise(0.0).alias("l2"), dice.between("depth", 0.6, 2.0).alias("depth"),
        )
        asked = F.struct("tid", "attempt", *TRENCH)
        shape = trench_geometry(t.withColumn("tid", asked))
        along = F.transform(F.sequence(F.lit(0), F.lit(places - 1)), lambda k: k * F.col("length") / (places - 1))
        line = lambda axis: F.transform(along, lambda s: centreline(s)[axis])
        return shape.select("tid.*", _within(line("x"), line("y"), width_m, height_m, margin).alias("inside"))

    return _first_that_fits(spark.range(first, first + n).withColumnRenamed("id", "tid"), "tid", draw).select("tid", *TRENCH)


def draw_cables(spark: SparkSession, first: int, n: int, width_m: float, height_m: float, rules: dict[int, tuple[float, float]], seed: int, margin: float = 3.0, leg: tuple[float, float] = (3.0, 300.0)) -> DataFrame:
    """Routes first .. first + n - 1 (rid, x0, y0, h0, legs, turns, radius, depth, kv) with all corners inside: up to BENDS
    bends, the voltages of rules (kv to radius and depth) alike often, lengths of legs even in their logarithm."""
    dice = Dice(seed, "rid", "attempt")
    by_kv = lambda k: F.create_map(*[F.lit(v) for kv, rule in rules.items() for v in (kv, rule[k])])[F.col("kv")]

    def draw(tried: DataFrame) -> DataFrame:
        t = tried.withColumn("bends", F.floor(dice.unit("bends") * (BENDS + 1))).withColumn("kv", dice.one_of("kv", tuple(sorted(rules))))
        legs = [F.when(F.col("bends") >= k, F.exp(dice.between(f"leg {k}", math.log(leg[0]), math.log(leg[1])))).otherwise(0.0) for k in range(BENDS + 1)]
        turns = [F.when(F.col("bends") > k, dice.between(f"turn {k}", math.radians(5), math.radians(150)) * dice.one_of(f"side {k}", (-1.0, 1.0))).otherwise(0.0) for k in range(BENDS)]
        t = t.select("rid", "attempt", "kv", dice.between("east", margin, width_m - margin).alias("x0"), dice.between("north", margin, height_m - margin).alias("y0"), dice.between("heading", 0.0, 2 * math.pi).alias("h0"), F.array(*legs).alias("legs"), F.array(*turns).alias("turns"))
        heading = [F.col("h0")]
        for k in range(BENDS):
            heading.append(heading[-1] + F.get("turns", F.lit(k)))
        x, y = [F.col("x0")], [F.col("y0")]
        for k in range(BENDS + 1):
            x.append(x[-1] + F.get("legs", F.lit(k)) * F.cos(heading[k]))
            y.append(y[-1] + F.get("legs", F.lit(k)) * F.sin(heading[k]))
        return t.withColumn("inside", _within(F.array(*x), F.array(*y), width_m, height_m, margin)).withColumns({"radius": by_kv(0), "depth": by_kv(1)})

    return _first_that_fits(spark.range(first, first + n).withColumnRenamed("id", "rid"), "rid", draw).select("rid", "x0", "y0", "h0", "legs", "turns", "radius", "depth", "kv")


def draw_points(spark: SparkSession, first: int, n: int, tiles: int, reach: float, seed: int) -> DataFrame:
    """Points first .. first + n - 1 (pid, tile, u, v): a tile and a place in it, up to reach spacings from its corner."""
    dice = Dice(seed, "pid")
    return spark.range(first, first + n).withColumnRenamed("id", "pid").select("pid", F.floor(dice.unit("tile") * tiles).cast("int").alias("tile"), dice.between("u", 0.0, reach).alias("u"), dice.between("v", 0.0, reach).alias("v"))
