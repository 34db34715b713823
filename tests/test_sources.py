"""Files, contracts, document sets, and the settings of the relational sink."""

import pytest
from pyspark.sql import Row, functions as F

from stayscope.operators.embedding import add_vectors
from stayscope.plans.materialise import materialise
from stayscope.session import shared_folder
from stayscope.sources import relational
from stayscope.sources.contracts import (
    CLEAN_REVIEWS, VECTOR_REVIEWS, check_contract, column_types, conform, dots_to_underscores,
    plain_names,
)
from stayscope.sources.documents import keyed_documents
from stayscope.sources.files import (
    load_data, read_csv, read_report, read_reviews, write_csv, write_report, write_table,
)

HEADER = "n,name,city,province,reviews.date,reviews.rating,reviews.text,reviews.title,reviews.username\n"


@pytest.fixture
def raw_files(tmp_path):
    (tmp_path / "reviews.csv").write_text(
        HEADER
        + '7,Otter Point,Ames,IA,2018-11-05T07:15:00Z,2,"They call it ""cosy"";\nit is a cupboard",Tiny,wren\n'
        + "8,Juniper Court,Moab,UT,2018-12-24,4.5,Red rocks outside every window,,finch\n"
        + "9,Cedar Row,Provo,UT,last spring,plenty,Kind hosts,Thanks,\n"
    )
    (tmp_path / "states.csv").write_text("State,State Code,Region,Division\nIowa,IA,R2,D2\nUtah,UT,R1,D3\n")
    return tmp_path


def test_quoted_review_with_line_break_is_one_row(spark, raw_files):
    reviews, states = load_data(spark, str(raw_files / "reviews.csv"), str(raw_files / "states.csv"))
    rows = {r["name"]: r for r in reviews.collect()}
    assert sorted(rows) == ["Cedar Row", "Juniper Court", "Otter Point"]
    assert rows["Otter Point"]["reviews.text"].splitlines() == ['They call it "cosy";', "it is a cupboard"]
    assert rows["Otter Point"]["reviews.date"].isoformat() == "2018-11-05T07:15:00"
    assert rows["Juniper Court"]["reviews.rating"] == 4.5
    assert {(r["State Code"], r["Division"]) for r in states.collect()} == {("IA", "D2"), ("UT", "D3")}


def test_values_that_do_not_fit_become_null(spark, raw_files):
    row = read_reviews(spark, str(raw_files / "reviews.csv")).filter("name = 'Cedar Row'").first()
    assert row["reviews.rating"] is None and row["reviews.date"] is None and row["reviews.username"] is None
    assert row["reviews.title"] == "Thanks"


def test_files_of_one_header_are_one_table_and_others_raise(spark, tmp_path):
    names = HEADER.strip().split(",")
    row = {name: f"{name} value" for name in names}
    for file, order in (("a", names), ("b", names)):
        (tmp_path / f"{file}.csv").write_text(",".join(order) + "\n" + ",".join(row[n] for n in order) + "\n")
    assert read_reviews(spark, str(tmp_path)).select("city").distinct().count() == 1
    swapped = [names[0], names[2], names[1], *names[3:]]
    (tmp_path / "c.csv").write_text(",".join(swapped) + "\n" + ",".join(row[n] for n in swapped) + "\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path)).select("name", "city").collect()
    with pytest.raises(Exception, match="header"):
        read_reviews(spark, str(tmp_path)).collect()


def test_relational_copies_are_typed(spark, raw_files, monkeypatch):
    sent = {}
    monkeypatch.setattr(relational, "write_relational", lambda df, table, options, contract=None: sent.update(
        {table: (df.dtypes, contract)}) or 0)
    reviews = spark.createDataFrame([], VECTOR_REVIEWS)
    relational.write_relational_copies(
        read_csv(spark, str(raw_files / "reviews.csv")), load_data(
            spark, str(raw_files / "reviews.csv"), str(raw_files / "states.csv"))[1], reviews, {})
    raw = dict(sent["hotels_raw"][0])
    assert (raw["reviews_rating"], raw["reviews_date"], raw["reviews_text"], raw["n"]) == (
        "double", "timestamp", "string", "string")
    assert sent["hotel_reviews"][1] is CLEAN_REVIEWS
    assert [n for n, _ in sent["hotel_reviews"][0]] == CLEAN_REVIEWS.fieldNames()


def test_parquet_overwrites_and_counts(spark, tmp_path):
    target = str(tmp_path / "out")
    first = spark.createDataFrame([(11, "x"), (12, None)], "n int, mark string")
    assert write_table(first, target) == 2
    assert write_table(first.limit(1), target) == 1
    assert spark.read.parquet(target).count() == 1
    assert write_table(first.limit(0), target) == 0


def test_csv_keeps_text_as_it_is(spark, tmp_path):
    texts = ['a "b" c', " padded ", "line\nbreak", "comma, here", "back\\slash", "cr\r\nlf"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    assert write_csv(df, str(tmp_path / "c")) == len(texts)
    back = read_csv(spark, str(tmp_path / "c")).collect()
    assert {int(r.id): r.text for r in back} == dict(enumerate(texts))


def test_report_is_one_file(spark, tmp_path):
    target = tmp_path / "report.csv"
    df = spark.range(20).repartition(4).withColumn("n", F.col("id") * 2)
    assert write_report(df, str(target)) == 20
    assert len(list(target.glob("part-*.csv"))) == 1
    assert read_report(spark, str(target), "id bigint, n bigint").count() == 20


def test_renames(spark):
    df = spark.createDataFrame([(1, 2)], "`reviews.text` int, `City ` int")
    assert dots_to_underscores(df).columns == ["reviews_text", "City "]
    assert plain_names(df).columns == ["reviews.text", "city"]
    clash = spark.createDataFrame([(1, 2)], "`a b` int, a_b int")
    with pytest.raises(ValueError, match="both become"):
        plain_names(clash)


def test_contract(spark):
    values = {f.name: "1" for f in CLEAN_REVIEWS.fields} | {"review_date": "2020-01-02", "extra": "x"}
    df = conform(spark.createDataFrame([Row(**values)]), CLEAN_REVIEWS)
    check_contract(df, CLEAN_REVIEWS)
    assert "rating double" in column_types(CLEAN_REVIEWS)
    with pytest.raises(ValueError, match="division"):
        conform(df.drop("division"), CLEAN_REVIEWS)
    with pytest.raises(ValueError, match="contract"):
        check_contract(df.withColumn("sentiment", F.lit(1.5)), CLEAN_REVIEWS)


def _clean_rows(spark):
    rows = [
        ("Heron Lodge", "Bend", "OR", "2019-06-30 21:05:00", 4.5, "boats and stars", 1, "R1", "D1"),
        ("Heron Lodge", "Bend", "OR", "2019-06-30 21:05:00", 3.5, "boats and stars", 1, "R1", "D1"),
        ("Otter Point", "Ames", "IA", None, float("nan"), "a cupboard", 0, "R2", "D2"),
    ]
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CLEAN_REVIEWS.fields)
    df = spark.createDataFrame(rows, names.replace("review_date timestamp", "review_date string"))
    return conform(df, CLEAN_REVIEWS)


def test_documents_with_one_key_keep_the_last(spark):
    found = {r.hotel_name: r for r in keyed_documents(_clean_rows(spark), ["rating"]).collect()}
    assert len(found) == 2 and found["Heron Lodge"].rating == 4.5
    assert found["Heron Lodge"].review_date == "2019-06-30T21:05:00"
    assert found["Otter Point"].review_date is None and found["Otter Point"].rating is None
    import hashlib
    assert found["Otter Point"].doc_id == hashlib.md5(b"Otter Point|None|a cupboard").hexdigest()


def test_hot_key_keeps_one_row_and_is_cut_before_the_shuffle(spark):
    from conftest import plan_of
    from stayscope.operators.upsert import keep_last_by_key

    df = spark.range(3000).withColumn("key", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")))
    kept = keep_last_by_key(df, "key", ["id"])
    assert kept.count() == 2001 and kept.filter("key = -1").first().id == 2997
    plan = plan_of(kept)
    assert plan.count("WindowGroupLimit") == 2


def test_materialise_writes_both_sets(spark):
    base = shared_folder(spark)
    write_table(conform(add_vectors(_clean_rows(spark)), VECTOR_REVIEWS), f"{base}/vectors")
    written = materialise(spark, f"{base}/vectors", f"{base}/docs")
    assert written == {"vector_documents": 2, "keyword_documents": 2}
    keyword = spark.read.parquet(f"{base}/docs/keyword_documents")
    vector = spark.read.parquet(f"{base}/docs/vector_documents")
    assert "embedding" not in keyword.columns and len(vector.first().embedding) == 384


def test_materialise_refuses_a_table_off_contract(spark):
    base = shared_folder(spark)
    write_table(_clean_rows(spark), base)
    with pytest.raises(ValueError, match="embedding"):
        materialise(spark, base, f"{base}-docs")


def test_shared_folder_is_below_the_set_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(base) and shared_folder(spark) != shared_folder(spark)


class _Recorder:
    """Stands in for a writer, since no database is started for tests."""

    def __init__(self):
        self.settings, self.calls = {}, []

    def format(self, name):
        self.calls.append(name)
        return self

    def mode(self, name):
        self.calls.append(name)
        return self

    def options(self, **settings):
        self.settings.update(settings)
        return self

    def save(self):
        self.calls.append("save")


class _Table:
    def __init__(self, writer):
        self.write, self.sparkSession = writer, None

    def observe(self, *_):
        return self


def _recorded(monkeypatch, rows, held):
    writer = _Recorder()
    seen = type("Seen", (), {"get": {"rows": rows}})
    monkeypatch.setattr(relational, "Observation", lambda: seen)
    monkeypatch.setattr(relational, "F", type("F", (), {
        "lit": staticmethod(lambda x: x),
        "count": staticmethod(lambda x: type("C", (), {"alias": lambda self, n: None})()),
    }))
    monkeypatch.setattr(relational, "count_relational", lambda *_: held)
    return writer


def test_relational_settings(monkeypatch):
    writer = _recorded(monkeypatch, 3, 3)
    options = {"url": "jdbc:x", "user": "u", "password": "p", "driver": "d"}
    assert relational.write_relational(_Table(writer), "t", options, CLEAN_REVIEWS, truncate=True) == 3
    assert writer.calls == ["jdbc", "overwrite", "save"]
    assert writer.settings["dbtable"] == "t" and writer.settings["truncate"] == "true"
    assert writer.settings["numPartitions"] == "16" and writer.settings["url"] == "jdbc:x"
    assert "sentiment int" in writer.settings["createTableColumnTypes"]
    assert "dbtable" not in options


def test_relational_row_count_is_checked(monkeypatch):
    writer = _recorded(monkeypatch, 3, 2)
    with pytest.raises(RuntimeError, match="holds 2 rows after 3"):
        relational.write_relational(_Table(writer), "t", {"url": "jdbc:x"})
