from playlens.operators import quality
from playlens.operators.silver import clean
from tests.conftest import values


def test_duplicates_count_null_keys_as_equal(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert values(quality.duplicates(frame, ["k"])) == [(5, 3, 2)]
    assert values(quality.duplicates(frame.limit(0), ["k"])) == [(0, 0, 0)]


def test_null_counts(spark):
    frame = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert values(quality.null_counts(frame)) == [("a", 1), ("b", 2)]


def test_missing_layer_is_reported(spark, base):
    frame = spark.createDataFrame([("a",), ("a",)], "k string")
    found, missing = quality.profile_layers({
        "here": (lambda: frame, ["k"]),
        "gone": (lambda: spark.read.parquet(f"{base}/none"), ["k"]),
    })
    assert values(found) == [("here", 2, 1, 1)]
    assert list(missing) == ["gone"] and "none" in missing["gone"]
    assert quality.profile_layers({"gone": (lambda: spark.read.parquet(f"{base}/none"),
                                            ["k"])})[0] is None


def test_ranges(events):
    silver = clean(events({"completion_pct": -0.01}, {"completion_pct": 0.0},
                          {"completion_pct": 100.0}, {"completion_pct": 100.01},
                          {"completion_pct": None, "watch_duration_mins": 0},
                          {"watch_duration_mins": None, "subscription_price": 0},
                          {"subscription_price": -1}, {"subscription_price": None}))
    assert values(quality.invalid_counts(silver)) == [(2, 1, 2)]
    assert values(quality.range_stats(silver)) == [(-0.01, 100.01, 50.0)]


def test_distribution_is_ordered(events):
    silver = clean(events(*[{"completion_pct": p} for p in (95.0, 1.0, 2.0, 60.0)]))
    assert [tuple(r) for r in quality.distribution(silver, "completion_category").collect()] == [
        ("PARTIAL", 2), ("COMPLETED", 1), ("MAJORITY", 1)]


def test_orphans_count_null_and_unknown_keys(spark):
    fact = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,)], "city string")
    dim = spark.createDataFrame([("a",), (None,)], "city string")
    assert values(quality.orphans(fact, dim, "city")) == [(4, 2)]
    assert values(quality.orphans(fact.limit(0), dim, "city")) == [(0, 0)]


def test_layer_loss(spark):
    def rows(n):
        return spark.range(n).selectExpr("string(id) AS event_id")

    assert values(quality.layer_loss(rows(100), rows(91), rows(90))) == [
        (100, 0, 91, 90, 9.0, 1.1, True, True)]
    assert values(quality.layer_loss(rows(100), rows(90), rows(85))) == [
        (100, 0, 90, 85, 10.0, 5.6, False, False)]
    assert values(quality.layer_loss(rows(0), rows(0), rows(0))) == [
        (0, 0, 0, 0, None, None, None, None)]
