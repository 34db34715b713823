"""Cleaning: the rules on texts, ratings, provinces, languages and columns."""

import pytest
from conftest import logical_plan_of
from pyspark.sql import functions as F

from stayscope.operators.cleaning import clean_reviews, project_catalog, project_reviews
from stayscope.operators.seed_text import SEED_TEXT
from stayscope.sources.contracts import CATALOG_COLUMNS, REVIEW_COLUMNS

PRAISE = "Our boys loved the rowing boats, and supper by the lake lasted until the stars came out"
BLAME = "A leaking ceiling kept us awake, and the promised shuttle to the harbour never turned up"
SPANISH = "Los niños disfrutaron mucho de las barcas, y la cena junto al lago duró hasta las estrellas"
FRENCH = "Une fuite au plafond nous a tenus éveillés et la navette promise vers le port n'est jamais venue"
TYPES = (
    "name string, city string, province string, `reviews.date` string, `reviews.rating` double, "
    "`reviews.text` string, `reviews.title` string, `reviews.username` string"
)


def review(**changes):
    row = dict(zip(REVIEW_COLUMNS, (
        "Heron Lodge", "Bend", "OR", "2019-06-30", 4.0, PRAISE, "Worth the drive", "kestrel9",
    )))
    row.update({k if k in row else f"reviews.{k}": v for k, v in changes.items()})
    return tuple(row[c] for c in REVIEW_COLUMNS)


def reviews(spark, *rows, types=TYPES):
    return spark.createDataFrame(list(rows), types)


@pytest.fixture(scope="module")
def states(spark):
    return spark.createDataFrame(
        [("Oregon", "OR", "R1", "D1"), ("Iowa", "IA", "R2", "D2"), ("Utah", "UT", "R1", "D3")], CATALOG_COLUMNS
    )


@pytest.fixture
def clean(spark, states, seed_model):
    return lambda *rows, **options: clean_reviews(
        reviews(spark, *rows), states, language_model=seed_model, **options
    ).collect()


def test_no_sentence_here_was_trained_on():
    known = {text for texts in SEED_TEXT.values() for text in texts}
    for sentence in (PRAISE, BLAME, SPANISH, FRENCH):
        assert not any(sentence in text or text.rstrip(".") in sentence for text in known)


@pytest.mark.parametrize("stars, sentiment", [(1.0, 0), (2.5, 0), (3.9, 0), (4.0, 1), (4.5, 1), (5.0, 1)])
def test_sentiment_turns_at_four_stars(clean, stars, sentiment):
    (row,) = clean(review(rating=stars, text=BLAME))
    assert (row.rating, row.sentiment) == (stars, sentiment)


@pytest.mark.parametrize("title, full", [
    ("Worth the drive", f"Worth the drive {BLAME}"), ("", f" {BLAME}"), (None, BLAME),
])
def test_full_text_is_the_title_before_the_text(clean, title, full):
    (row,) = clean(review(text=BLAME, title=title))
    assert row.review_full_text == full


def test_only_ratings_from_one_to_five_stay(clean):
    given = [0.99, 1.0, 3.25, 5.0, 5.01, -4.0, None, float("nan"), float("inf")]
    rows = clean(*[review(rating=r, username=f"guest{n}") for n, r in enumerate(given)])
    assert sorted(r.rating for r in rows) == [1.0, 3.25, 5.0]


def test_review_without_text_leaves_but_one_without_a_date_stays(clean):
    rows = clean(review(text=None, name="Silent Inn"), review(date=None, name="Dateless Inn"))
    assert [(r.hotel_name, r.review_date) for r in rows] == [("Dateless Inn", None)]


def test_only_the_wanted_language_stays(clean):
    given = {"Lago": (SPANISH, "Volveremos"), "Port": (FRENCH, "Nuit blanche"), "Quay": (BLAME, "No sleep at all")}
    rows = [review(name=name, text=text, title=title) for name, (text, title) in given.items()]
    assert [r.hotel_name for r in clean(*rows)] == ["Quay"]
    assert [r.hotel_name for r in clean(*rows, language="fr")] == ["Port"]


def test_province_must_be_in_the_catalog(clean):
    rows = clean(*[review(province=p, name=f"In {p}") for p in ("UT", "XX", None, "or", "IA")])
    assert {(r.province, r.region, r.division) for r in rows} == {("UT", "R1", "D3"), ("IA", "R2", "D2")}


def test_columns_and_their_order(spark, states):
    df = clean_reviews(reviews(spark, review()).withColumn("lang", F.lit("en")), states, lang_col="lang")
    assert ",".join(df.columns) == (
        "hotel_name,city,province,review_date,rating,review_full_text,sentiment,region,division"
    )


def test_rows_equal_in_all_eight_columns_are_one(clean):
    twice = [review(), review()]
    others = [review(username="teal4"), review(city="Burns"), review(title=None), review(title=None), review(date=None)]
    assert len(clean(*twice, *others)) == 5


def test_rating_as_text_does_not_fail(spark, states):
    types = TYPES.replace("`reviews.rating` double", "`reviews.rating` string")
    df = reviews(spark, *[review(rating=r) for r in ("4.5", "four", "", None, "9")], types=types)
    (row,) = clean_reviews(df.withColumn("lang", F.lit("en")), states, lang_col="lang").collect()
    assert row.rating == 4.5 and row.sentiment == 1


def test_repeated_catalog_code_raises_unless_allowed(spark, states):
    twice = states.unionAll(states.filter("`State Code` = 'UT'").withColumn("Division", F.lit("D9")))
    with pytest.raises(ValueError, match="UT"):
        project_catalog(twice)
    df = reviews(spark, review(province="UT")).withColumn("lang", F.lit("en"))
    rows = clean_reviews(df, twice, lang_col="lang", allow_repeats=True).collect()
    assert sorted(r.division for r in rows) == ["D3", "D9"]


def test_joins_by_shuffle_give_the_same_rows(spark, states):
    df = reviews(spark, *[review(username=str(n), province="OR" if n % 3 else "IA") for n in range(60)])
    df = df.unionAll(df).withColumn("lang", F.lit("en"))
    small = clean_reviews(df, states, lang_col="lang").collect()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = clean_reviews(df, states, lang_col="lang").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(small) == 60 and sorted(small) == sorted(large)


def test_needs_a_language(spark, states):
    with pytest.raises(ValueError, match="language"):
        clean_reviews(reviews(spark, review()), states)


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="reviews.title"):
        project_reviews(reviews(spark, review()).drop("reviews.title"))


def test_language_model_runs_after_duplicate_removal(spark, states, seed_model):
    plan = logical_plan_of(clean_reviews(reviews(spark, review()), states, language_model=seed_model))
    below_copies = plan[plan.index("Aggregate"):]
    assert "UDF" in plan and "UDF" not in below_copies
    assert "rating" in below_copies and "LeftSemi" in below_copies
