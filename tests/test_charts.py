"""The board's charts."""

import statistics
from datetime import date, datetime, timedelta

import pytest
from conftest import plan_of

from stayscope.operators import charts
from stayscope.plans.board import board


@pytest.fixture(scope="module")
def rows():
    data = []
    for n in range(400):
        month = (1, 2, 5, 12)[n % 4]
        region = ["North", "South", "East", "West", None][n % 5]
        city = "Hub" if n % 3 == 0 else f"c{n % 23}" if n % 23 else None
        rating = None if n % 37 == 0 else float((1, 2, 5)[n * n % 3])
        data.append((datetime(2020 + n % 2, month, 1 + n % 28), rating, int((rating or 0) >= 4), region, city))
    data.append((None, 5.0, 1, "North", "Hub"))
    return data


@pytest.fixture(scope="module")
def reviews(spark, rows):
    schema = "review_date timestamp, rating double, sentiment int, region string, city string"
    return spark.createDataFrame(rows, schema).repartition(4)


def test_histogram_keeps_empty_buckets(reviews, rows):
    found = {r.bucket: r["count"] for r in charts.rating_histogram(reviews).collect()}
    assert found == {b: sum(1 for r in rows if r[1] == b) for b in (1.0, 2.0, 3.0, 4.0, 5.0)}
    assert 0 in found.values()
    assert charts.rating_histogram(reviews, 0.25).count() == 17


def test_months_keep_empty_ones(reviews, rows):
    found = {str(r.period.date()): r["count"] for r in charts.reviews_per_period(reviews).collect()}
    assert len(found) == 24 and found["2020-03-01"] == 0
    assert sum(found.values()) == sum(1 for r in rows if r[0])


def test_hours_and_one_period(spark):
    rows = [(datetime(2020, 1, 1, h, 5),) for h in (1, 1, 4)]
    df = spark.createDataFrame(rows, "review_date timestamp")
    found = [(r.period.hour, r["count"]) for r in charts.reviews_per_period(df, "HOUR").orderBy("period").collect()]
    assert found == [(1, 2), (2, 0), (3, 0), (4, 1)]
    assert charts.reviews_per_period(df, "YEAR").count() == 1


def test_charts_read_their_input_once(reviews):
    for chart in (charts.rating_histogram(reviews), charts.reviews_per_period(reviews)):
        assert plan_of(chart).count("Exchange SinglePartition") <= 1
        assert plan_of(chart).count("Scan ExistingRDD") == 1


def test_regions_beyond_the_largest_are_other(reviews, rows):
    found = {(r.region, r.sentiment): r["count"] for r in charts.region_split(reviews, 2).collect()}
    sizes = {}
    for r in rows:
        if r[3]:
            sizes[r[3]] = sizes.get(r[3], 0) + 1
    top = sorted(sizes, key=lambda s: (-sizes[s], s))[:2]
    wanted = {}
    for r in rows:
        if r[3]:
            key = (r[3] if r[3] in top else "Other", r[2])
            wanted[key] = wanted.get(key, 0) + 1
    assert found == wanted


@pytest.mark.parametrize("exact", [True, False])
def test_cities_and_the_median_of_the_rest(reviews, rows, exact):
    found = {r.city: (r.ratings, r.median_rating) for r in charts.top_cities(reviews, 3, exact).collect()}
    held = {}
    for r in rows:
        if r[4] and r[1] is not None:
            held.setdefault(r[4], []).append(r[1])
    top = sorted(held, key=lambda c: (-len(held[c]), c))[:3]
    other = [x for c, xs in held.items() if c not in top for x in xs]
    wanted = {c: held[c] for c in top} | {"Other": other}
    assert {c: n for c, (n, _) in found.items()} == {c: len(xs) for c, xs in wanted.items()}
    if exact:
        assert {c: m for c, (_, m) in found.items()} == {c: statistics.median(xs) for c, xs in wanted.items()}


def test_shares_sum_to_hundred(reviews):
    shares = charts.positive_share(reviews).collect()
    assert sum(r.percent for r in shares) == pytest.approx(100)


def test_counts_by_region_and_pivot(spark, reviews):
    by_region = charts.sentiment_by_region(reviews)
    wide = {r.region: (r.negative, r.positive) for r in charts.sentiment_pivot(by_region).collect()}
    for row in by_region.collect():
        assert wide[row.region][row.sentiment] == row["count"]
    only = spark.createDataFrame([("R", 1, 3)], "region string, sentiment int, count bigint")
    assert charts.sentiment_pivot(only).first().asDict() == {"region": "R", "negative": 0, "positive": 3}


def test_the_last_day_is_in_with_its_hours(spark):
    times = [datetime(2000, 12, 31, 10), datetime(2000, 12, 31), datetime(2001, 1, 1), datetime(2000, 1, 1), None]
    df = spark.createDataFrame([(t,) for t in times], "review_date timestamp")
    for high, count in (("2000-12-31", 3), (date(2000, 12, 31), 3), (datetime(2000, 12, 31), 2), ("2000-12-31 09:00:00", 2)):
        assert charts.within_dates(df, "2000-01-01", high).count() == count


def test_a_wide_gap_is_written_out_in_runs(spark, monkeypatch):
    df = spark.createDataFrame([(1.0,), (3e6,)], "rating double")
    found = charts.rating_histogram(df)
    assert found.count() == 3_000_000 and found.filter("count > 0").count() == 2
    wide = charts.rating_histogram(spark.createDataFrame([(1.0,), (3e9,)], "rating double"))
    assert wide.limit(3).count() == 3
    monkeypatch.setattr(charts, "RUN", 7)
    months = spark.createDataFrame([(datetime(1990, 1, 31),), (datetime(2010, 3, 1),)], "review_date timestamp")
    periods = [r.period for r in charts.reviews_per_period(months).orderBy("period").collect()]
    assert len(periods) == len(set(periods)) == 243 and {p.day for p in periods} == {1}


def test_board_leaves_out_other_dates(reviews, rows):
    low, high = datetime(2020, 2, 1), datetime(2020, 12, 31)
    shown = board(reviews, low, high)
    kept = [r for r in rows if r[0] and low <= r[0] <= high]
    assert set(shown) == {
        "rating_histogram", "region_topn_other", "reviews_per_month", "positive_share", "top_cities"
    }
    assert sum(r["count"] for r in shown["positive_share"].collect()) == len(kept)
    assert sum(r["count"] for r in shown["reviews_per_month"].collect()) == len(kept)


def test_charts_of_no_reviews(reviews):
    none = reviews.limit(0)
    assert charts.rating_histogram(none).count() == 0
    assert charts.reviews_per_period(none).count() == 0
    assert charts.top_cities(none).count() == 0 and charts.positive_share(none).count() == 0


@pytest.mark.parametrize("values, most, width", [
    ([0.0, 49.0], 50, 1.0), ([0.0, 50.0], 50, 2.0), ([-0.3, 0.3], 10, 0.1), ([1.0, 3e9], 20, 2e8),
    ([5.0, 5.0], 50, 1.0), ([], 50, 1.0), ([1.0, None, float("inf"), float("nan"), 3.0], 4, 1.0),
])
def test_a_fitting_width_is_the_least_round_one(spark, values, most, width):
    df = spark.createDataFrame([(v,) for v in values], "rating double")
    assert charts.fitting_width(df, most=most) == pytest.approx(width, rel=1e-12)
    finite = df.filter("abs(rating) < 1e300 and not isnan(rating)")
    assert charts.rating_histogram(finite, charts.fitting_width(df, most=most)).count() <= most


def test_a_fitting_width_needs_two_buckets(spark):
    with pytest.raises(ValueError, match="two buckets"):
        charts.fitting_width(spark.range(3), "id", 1)


@pytest.mark.parametrize("span, unit", [
    (timedelta(0), "SECOND"), (timedelta(seconds=98), "SECOND"), (timedelta(seconds=99), "MINUTE"), (timedelta(days=4), "HOUR"),
    (timedelta(days=60), "DAY"), (timedelta(days=600), "WEEK"), (timedelta(days=2600), "MONTH"),
    (timedelta(days=9000), "YEAR"), (timedelta(days=200_000), "YEAR"),
])
def test_a_fitting_unit_is_the_shortest_one(spark, span, unit):
    low = datetime(1900, 5, 5, 23, 59, 59)
    df = spark.createDataFrame([(low,), (low + span,), (None,)], "review_date timestamp")
    assert charts.fitting_unit(df) == unit
    if unit != "YEAR":
        assert charts.reviews_per_period(df, unit).count() <= 100


def test_no_dates_have_a_unit_too(spark):
    assert charts.fitting_unit(spark.createDataFrame([(None,)], "review_date timestamp")) == "SECOND"
