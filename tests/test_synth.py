"""The generator: sizes, cohorts, null rates, repeatability."""

from pyspark.sql import functions as F

from weft.plans import synth


def test_cohorts_and_users(spark):
    assert synth.cohort_bounds()[-1] == 101_333
    u = synth.users(spark, partitions=4)
    assert u.count() == 101_333
    nulls = u.where(F.col("id").isNull()).count() / 101_333
    assert 0.015 < nulls < 0.025
    canal = {r[0]: r[1] for r in u.groupBy("canal").count().collect()}
    assert canal["WEBAPP"] > canal["PHONE"] > canal["MOBILE"] > canal[None]


def test_orders_events_repeatable(spark):
    u = synth.users(spark, partitions=3).limit(3000)
    o = synth.orders(u)
    e = synth.events(o)
    assert o.count() == e.count()  # one event per order, as the original
    a = sorted(map(tuple, synth.orders(synth.users(spark, partitions=7).limit(3000)).select("id", "amount").collect()),
               key=str)
    b = sorted(map(tuple, o.select("id", "amount").collect()), key=str)
    assert a == b
    assert e.where(~F.col("url").startswith("https://shop.example/")).count() == 0
