"""CSV input, checks, sessions, and the marketplace loader."""

import csv
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from basketry import session
from basketry.operators import intermediate, marts, model, quality
from basketry.plans import pipeline
from basketry.sources import files, loader, tables

CUSTOMERS = "customer_id,city,state\n" + "".join(f"c{i},town,{'sp' if i % 2 else 'RJ'}\n" for i in range(40))
ORDERS = ("order_id,customer_id,order_status,purchase_ts,approved_ts,estimated_delivery_ts,delivered_ts\n"
          + "".join(f"o{i},c{i % 40},delivered,2020-01-{i % 27 + 1:02d} 10:00:00,NA,2020-03-05,2020-03-0{i % 9 + 1}\n"
                    for i in range(60)))
ITEMS = ("order_id,item_no,product_id,seller_id,category,price,freight_value\n"
         + "".join(f"o{i},1,p,s,toys,{10 + i}.5,1.25\n" for i in range(60)))
PAYMENTS = ("order_id,payment_type,installments,payment_value\n"
            + "".join(f"o{i},{'boleto' if i % 3 else 'card'},{i % 4 + 1}.0,{10 + i}\n" for i in range(60)))
REVIEWS = "order_id,review_score\n" + "".join(f"o{i},{i % 5 + 1}\n" for i in range(60))


def write(folder, **contents):
    paths = []
    for name, text in contents.items():
        path = folder / f"{name}.csv"
        path.write_text(text)
        paths.append(str(path))
    return paths


@pytest.fixture
def upload(tmp_path):
    return write(tmp_path, my_customers=CUSTOMERS, my_orders=ORDERS, my_order_items=ITEMS,
                 my_payments=PAYMENTS, my_reviews=REVIEWS)


def test_route_takes_the_longest_name():
    found, errors = files.route(["/a/Orders_2020.csv", "x/olist_order_items.csv", "customers_orders.csv",
                                 "photos.csv"])
    assert found == {"orders": "/a/Orders_2020.csv", "order_items": "x/olist_order_items.csv",
                     "customers": "customers_orders.csv"}
    assert len(errors) == 1 and "photos.csv" in errors[0]


def test_csv_with_line_breaks_quotes_and_null_tokens(spark, tmp_path):
    quoted, plain = write(tmp_path, quoted='a,b\n"x\ny","say ""hi"""\nNA,n/a\n', plain='a,b\n1,"q,r"\n')
    assert files.has_line_breaks_in_fields(spark, quoted)
    assert not files.has_line_breaks_in_fields(spark, plain)
    assert {tuple(r) for r in files.read_csv(spark, quoted).collect()} == {("x\ny", 'say "hi"'), (None, None)}
    assert [tuple(r) for r in files.read_csv(spark, plain).collect()] == [("1", "q,r")]


def test_upload_reports_everything_that_is_missing(spark, tmp_path):
    paths = write(tmp_path, orders="order_id,customer_id\n1,2\n", customers=CUSTOMERS, notes="x\n1\n")
    with pytest.raises(files.InputError) as error:
        files.read_upload(spark, paths)
    text = str(error.value)
    for part in ("notes.csv", "lacks the column order_status", "no file for the table payments"):
        assert part in text


def test_optional_columns_are_null(spark, tmp_path):
    raw = files.read_csv(spark, write(tmp_path, payments="order_id,payment_type,payment_value\no1,card,3\n")[0])
    assert files.typed(raw, "payments").first().asDict() == {
        "order_id": "o1", "payment_type": "card", "installments": None, "payment_value": 3.0}
    assert ("payments", "installments", "needed_by_view") in files.check_columns({"payments": raw.columns})


def test_check_report_names_missing_columns(spark):
    report = files.check_report({"reviews": spark.createDataFrame([("o",)], "order_id string")})
    rows = {r.table: r for r in report.collect()}
    assert rows["reviews"].missing_required == "review_score" and rows["reviews"].n_rows == 1
    assert rows["orders"].missing_required == "*" and rows["orders"].n_rows == 0


@pytest.mark.parametrize("name", ["a;b", "", "x" * 65, "a b", "a\n"])
def test_bad_session_names(name):
    with pytest.raises(ValueError):
        session.namespace(name)


def test_sessions_upload_analyse_and_stay_apart(spark, upload, tmp_path):
    counts = {r.table: r.n_rows for r in pipeline.ingest(spark, upload, "one").collect()}
    assert counts == {"customers": 40, "orders": 60, "order_items": 60, "payments": 60, "reviews": 60}
    assert pipeline.load_mart(spark, "fct_customers", "one").count() == 40
    # another session and the shared namespace see nothing of it
    assert pipeline.load_mart(spark, "fct_customers", "two").count() == 0
    assert pipeline.load_mart(spark, "fct_orders").count() == 0
    assert pipeline.ab_test(spark, session_id="two").first().recommend_ship is False

    half = [p for p in upload if "customers" not in p]
    half += write(tmp_path, new_customers="customer_id,city,state\nc1,x,sp\n")
    pipeline.ingest(spark, half, "two")
    assert pipeline.load_mart(spark, "fct_customers", "two").count() == 1
    assert pipeline.load_mart(spark, "fct_customers", "one").count() == 40
    pipeline.ingest(spark, half, "one")  # a new upload replaces the marts
    assert pipeline.load_mart(spark, "fct_customers", "one").count() == 1

    sections = {r.section for r in pipeline.eda(spark, "two").collect()}
    assert sections == {"metrics", "order_distribution", "repeat_rate_by_state", "review_by_delivery"}

    spark.sql("CREATE DATABASE IF NOT EXISTS copied")
    copied = {r.table: r.n_rows for r in tables.copy_tables(spark, "session_two", "copied").collect()}
    assert copied["orders"] == 60 and copied["fct_customers"] == 1


def test_train_save_and_score(spark, upload, tmp_path):
    pipeline.ingest(spark, upload, "model")
    path = str(tmp_path / "model")
    fitted = pipeline.train_model(spark, path, "model")
    assert fitted.columns[-1] == "payment_type_card"
    assert pipeline.session_model(spark, "model") is fitted
    new = spark.createDataFrame(
        [(20.0, 1, 5, 0, "card"), (20.0, 1, 5, 0, "boleto"), (20.0, 1, 5, 0, "never seen"),
         (None, None, None, None, None)],
        "order_value double, installments int, review_score int, was_late int, payment_type string")
    scores = [r.probability_repeat for r in pipeline.score_orders(path, new).collect()]
    assert all(0 < s < 1 for s in scores)
    assert scores[1] == scores[2] != scores[0]  # unseen counts as the first category
    assert scores == [r.probability_repeat for r in model.score(fitted.pipeline, new).collect()]
    pipeline.ingest(spark, upload, "model")  # new data, so a new model
    assert pipeline.session_model(spark, "model") is not fitted


def test_views_can_be_registered(spark, upload):
    from basketry.plans.views import VIEWS, RetailViews

    RetailViews(files.read_upload(spark, upload)).register(spark)
    assert spark.table("fct_orders").count() == 60
    assert spark.sql("SELECT count(DISTINCT state) FROM stg_customers").first()[0] == 2
    for name in VIEWS:
        spark.catalog.dropTempView(name)


def test_marketplace_loader(spark):
    market = {
        "customers": spark.createDataFrame(
            [("k2", "p1", "late town", "sp"), ("k1", "p1", "town", "rj"), ("k3", "p2", None, "sp")],
            "customer_id string, customer_unique_id string, customer_city string, customer_state string"),
        "orders": spark.createDataFrame(
            [("o1", "k1", "delivered", "2020-01-01"), ("o2", "k2", "delivered", "2020-01-02"),
             ("o3", "unknown", "delivered", "2020-01-03")],
            "order_id string, customer_id string, order_status string, order_purchase_timestamp string"),
        "order_items": spark.createDataFrame(
            [("o1", "1", f"p{i}", "s", "1.5", "0.5") for i in range(5)],
            "order_id string, order_item_id string, product_id string, seller_id string, price string, "
            "freight_value string"),
        "products": spark.createDataFrame(
            [("p0", "moveis"), ("p1", "sem_nome"), ("p2", None), ("p3", "moveis"), ("p3", "sem_nome")],
            "product_id string, product_category_name string"),
        "translation": spark.createDataFrame(
            [("moveis", "furniture")], "product_category_name string, product_category_name_english string"),
        "payments": spark.createDataFrame([("o1", "card", "2.0", "3")],
                                          "order_id string, payment_type string, payment_installments string, "
                                          "payment_value string"),
        "reviews": spark.createDataFrame([("o1", "4")], "order_id string, review_score string"),
    }
    raw = loader.load_marketplace(market)
    assert {tuple(r) for r in raw["customers"].collect()} == {("p1", "town", "rj"), ("p2", None, "sp")}
    assert {(r.order_id, r.customer_id, r.delivered_ts) for r in raw["orders"].collect()} == {
        ("o1", "p1", None), ("o2", "p1", None)}
    assert {r.product_id: r.category for r in raw["order_items"].collect()} == {
        "p0": "furniture", "p1": "sem_nome", "p2": "other", "p3": "sem_nome", "p4": "other"}
    assert raw["payments"].first().installments == 2
    del market["products"], market["translation"]
    plain = loader.load_marketplace(market)["order_items"]
    assert plain.select(F.count_distinct("category"), F.max("category")).first() == (1, "other")


def test_files_with_and_without_line_breaks(spark, tmp_path):
    folder = tmp_path / "two files"
    folder.mkdir()
    write(folder, a='a,b\n"x\ny",1\n', b="a,b\nz,2\n")
    broken = files.files_with_line_breaks(spark, str(folder))
    assert len(broken) == 1 and broken[0].endswith("/two files/a.csv")
    got = {tuple(r) for r in files.read_csv(spark, str(folder)).collect()}
    assert got == {("x\ny", "1"), ("z", "2")}


@pytest.mark.parametrize("bytes_of_a_split", [7, 64, 4096])
def test_records_across_splits(spark, tmp_path, bytes_of_a_split):
    r = random.Random(bytes_of_a_split)
    signs = ["x", "ü", ",", "\n", '"', "\n\n", " ", ""]
    folder = tmp_path / "many"
    folder.mkdir()
    expected = []
    for name in "abc":
        rows = [[str(i), "".join(r.choices(signs, k=r.choice([1, 3, 40]))), "end"] for i in range(60)]
        with open(folder / f"{name}.csv", "w", newline="") as out:
            csv.writer(out, lineterminator="\n").writerows([["id", "no\nte", "last"], *rows])
        expected += [(i, note or None, last) for i, note, last in rows]
    spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_of_a_split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        got = files.read_csv(spark, str(folder))
        assert got.columns == ["id", "no\nte", "last"]
        if bytes_of_a_split < 4096:
            assert files.records(spark, str(folder)).select("block").distinct().count() > 3
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_types_by_all_records(spark, tmp_path):
    rows = ["1,1,2020-01-01,x,NA,00012345678901234567,2020-01-01,5", "2,1e3,2020-01-02 10:00:00,1,,1,7,5",
            "-3,.5,2020-02-03T04:05,2.5,null,2,,9223372036854775807", "NA,7,2020-01-01 00:00:00.123,2020-13-01,nan,3,,1"]
    (path,) = write(tmp_path, any="a,b,c,d,e,f,g,h\n" + "\n".join(rows) + "\n").copy()
    raw = files.read_csv(spark, path)
    want = {"a": "bigint", "b": "double", "c": "timestamp_ntz", "d": "string", "e": "string", "f": "string",
            "g": "string", "h": "string"}
    assert {c: t.simpleString() for c, t in files.infer_types(raw).items()} == want
    assert {c: t.simpleString() for c, t in files.infer_types(raw.repartition(4)).items()} == want
    table = files.inferred(raw)
    assert dict(table.dtypes) == want and [r.a for r in table.collect()] == [1, 2, -3, None]
    assert files.infer_types(raw.limit(0))["a"].simpleString() == "string"


def test_other_columns_of_an_upload_are_kept(spark, upload, tmp_path):
    other = [p for p in upload if "customers" not in p]
    other += write(tmp_path, more_customers="customer_id,since,city,rating,state\nc1,2020-01-01,x,4.5,sp\nc2,,y,3,rj\n")
    pipeline.ingest(spark, other, "extra")
    stored = spark.table(f"{session.resolve_namespace(spark, 'extra')}.customers")
    assert dict(stored.dtypes) == {"customer_id": "string", "city": "string", "state": "string",
                                   "since": "timestamp_ntz", "rating": "double"}
    assert pipeline.load_mart(spark, "fct_customers", "extra").count() == 2


def test_another_header_raises(spark, tmp_path):
    folder = tmp_path / "headers"
    folder.mkdir()
    write(folder, a='a,b\n"x\ny",1\n', b='b,a\n"z\n",2\n')
    with pytest.raises(Exception, match="another header"):
        files.read_csv(spark, str(folder)).collect()


def test_a_failed_upload_keeps_the_earlier_one(spark, upload, tmp_path):
    pipeline.ingest(spark, upload, "kept")
    before = session.resolve_namespace(spark, "kept")
    bad = [p for p in upload if "my_orders" not in p]
    bad += write(tmp_path, bad_orders=ORDERS.replace("2020-01-01 10:00:00", "soon"))
    with pytest.raises(Exception, match="soon"):
        pipeline.ingest(spark, bad, "kept")
    assert session.resolve_namespace(spark, "kept") == before
    assert spark.table(f"{before}.orders").count() == 60
    pipeline.ingest(spark, upload, "kept")
    uploads = {d.name for d in spark.catalog.listDatabases()}
    assert session.resolve_namespace(spark, "kept") in uploads and before not in uploads


def test_a_lazy_result_outlives_an_upload_until_its_lease_ends(spark, upload, tmp_path, monkeypatch):
    half = [p for p in upload if "customers" not in p] + write(tmp_path, new_customers="customer_id,city,state\nc1,x,sp\n")
    pipeline.ingest(spark, upload, "lazy")
    first = session.resolve_namespace(spark, "lazy")
    earlier = pipeline.load_mart(spark, "fct_customers", "lazy")
    pipeline.ingest(spark, half, "lazy")
    assert earlier.count() == 40 and pipeline.load_mart(spark, "fct_customers", "lazy").count() == 1
    assert spark.catalog.databaseExists(first)
    later = session.time.time() + 2 * session.LEASE_SECONDS
    monkeypatch.setattr(session.time, "time", lambda: later)
    session.drop_old_versions(spark, "lazy")
    assert not spark.catalog.databaseExists(first)
    assert pipeline.load_mart(spark, "fct_customers", "lazy").count() == 1


def test_only_views_of_changed_tables_are_made_anew(spark, upload, tmp_path, monkeypatch):
    pipeline.ingest(spark, upload, "parts")
    made = []
    item_agg, customers = intermediate.item_agg, marts.fct_customers
    monkeypatch.setattr(intermediate, "item_agg", lambda *a: made.append("item_agg") or item_agg(*a))
    monkeypatch.setattr(marts, "fct_customers", lambda *a: made.append("fct_customers") or customers(*a))
    changed = [p for p in upload if "reviews" not in p] + write(tmp_path, new_reviews="order_id,review_score\no1,5\no2,1\n")
    for files_of, session_id in ((changed, "parts"), (changed, "whole")):
        pipeline.ingest(spark, files_of, session_id)
        # orders and items are as they were, so their totals are copied
        assert made == (["fct_customers"] if session_id == "parts" else ["item_agg", "fct_customers"])
        made.clear()
    for name in pipeline.MARTS:
        one, two = (sorted(map(str, pipeline.load_mart(spark, name, s).collect())) for s in ("parts", "whole"))
        assert one == two, name
    pipeline.ingest(spark, changed, "parts")
    assert made == []


def test_digests_do_not_depend_on_row_order(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "b"), ("a", "b")], "x string, y string")
    one = quality.table_digests({"t": df}).first()
    assert quality.table_digests({"t": df.orderBy("y").repartition(3)}).first() == one
    for other in (df.distinct(), df.select(F.col("y").alias("x"), F.col("x").alias("y")), df.toDF("x", "z")):
        assert quality.table_digests({"t": other}).first()[1:] != one[1:]
    assert quality.table_digests({"t": df.limit(0)}).first().n_rows == 0


def test_of_two_uploads_at_once_one_wins(spark, upload):
    with ThreadPoolExecutor(2) as pool:
        ended = [pool.submit(pipeline.ingest, spark, upload, "race") for _ in range(2)]
        failed = [f.exception() for f in ended]
    assert sorted(type(f) for f in failed if f) == [session.UploadConflict]
    assert pipeline.load_mart(spark, "fct_customers", "race").count() == 40
    assert session.version_number(spark, "race") == 1
    kept = {v for _, v in session._versions(spark, "session_race")}
    uploads = {d.name for d in spark.catalog.listDatabases() if d.name.startswith("upload_")}
    assert kept <= uploads
    pipeline.ingest(spark, upload, "race")
    assert session.version_number(spark, "race") == 2


def test_marketplace_upload(spark, tmp_path):
    paths = write(
        tmp_path,
        olist_customers="customer_id,customer_unique_id,customer_city,customer_state\nk1,p1,t,sp\nk2,p1,t,sp\n",
        olist_orders="order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
                     "order_estimated_delivery_date,order_delivered_customer_date\n"
                     "o1,k1,delivered,2020-01-01,,2020-01-09,2020-01-05\n"
                     "o2,k2,delivered,2020-02-01,,2020-02-09,2020-02-15\n",
        olist_order_items="order_id,order_item_id,product_id,seller_id,price,freight_value\n"
                          "o1,1,x,s,1.5,0.5\no2,1,y,s,3,1\n",
        olist_payments="order_id,payment_type,payment_installments,payment_value\no1,card,1,2\no2,card,1,4\n",
        olist_reviews="order_id,review_score\no1,5\no2,1\n",
        olist_products="product_id,product_category_name\nx,moveis\n",
        name_translation="product_category_name,product_category_name_english\nmoveis,furniture\n")
    with pytest.raises(files.InputError, match="no file for the table translation"):
        loader.read_marketplace(spark, paths[:-1])
    pipeline.ingest_marketplace(spark, paths, "market")
    row = pipeline.load_mart(spark, "fct_customers", "market").first()
    assert (row.customer_id, row.lifetime_order_count, row.lifetime_value) == ("p1", 2, 6.0)
    stored = spark.table(f"{session.resolve_namespace(spark, 'market')}.order_items")
    assert {r.product_id: r.category for r in stored.collect()} == {"x": "furniture", "y": "other"}
    plain = loader.read_marketplace(spark, paths[:-2])  # both may be absent
    assert {r.category for r in plain["order_items"].collect()} == {"other"}


def test_metrics_of_the_session_model(spark, upload):
    pipeline.ingest(spark, upload, "metrics")
    got = pipeline.evaluate_model(spark, "metrics")
    fitted, scored = model.train(pipeline.load_mart(spark, "first_order_features", "metrics"))
    rows = scored.select("is_repeat_customer", "prediction", "probability_repeat").collect()
    m = got.matrix.first()
    assert m.tp == sum(r[0] == 1 and r[1] == 1 for r in rows) and m.fp == sum(r[0] == 0 and r[1] == 1 for r in rows)
    assert m.tn + m.fp + m.fn + m.tp == len(rows)
    good, poor = ([r[2] for r in rows if r[0] == k] for k in (1, 0))
    wins = sum((g > p) + 0.5 * (g == p) for g in good for p in poor)
    assert got.roc_auc == pytest.approx(wins / (len(good) * len(poor)))
    strongest = model.coefficients(spark, fitted).first()
    assert model.headline(fitted).startswith(strongest.feature) and strongest.direction in model.headline(fitted)
