from __future__ import annotations

import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from souk.operators import clean, quality
from souk.plans import pipeline
from souk.sources import quoted_csv, warehouse
from souk.sources.csv_source import MissingSourceError, extract_all, read_csv_table
from souk.sources.schemas import TABLES
from tests.fixture_tables import raw_fixture

CUSTOMERS_CSV = (
    "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
    "c1,p1,01001,sao paulo,SP\n"
    "c2,p1,01001,  sao paulo\t,SP\n"
    "c3,N/A,00012,null,RJ\n"
    "c4,p4,,\"quoted, \"\"city\"\"\",MG\n"
)

REVIEWS_CSV = (
    "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
    "r1,o1,5,,\"very \"\"good\"\"\nthanks\",2018-01-11 00:00:00,2018-01-12 10:30:00\n"
    "r1,o1,4,NA,edited,2018-01-13 00:00:00,\n"
)


def _write(dirpath, table, text):
    with open(os.path.join(dirpath, TABLES[table].raw_file), "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_types_na_words_and_multiline(spark):
    d = tempfile.mkdtemp(prefix="souk-csv-")
    _write(d, "customers", CUSTOMERS_CSV)
    _write(d, "order_reviews", REVIEWS_CSV)
    cust = {r.customer_id: r for r in read_csv_table(spark, "customers", d).collect()}
    assert cust["c1"].customer_zip_code_prefix == "01001"  # leading zero kept
    assert cust["c3"].customer_unique_id is None and cust["c3"].customer_city is None  # NA words
    assert cust["c3"].customer_zip_code_prefix == "00012"
    assert cust["c4"].customer_zip_code_prefix is None  # empty field
    assert cust["c4"].customer_city == 'quoted, "city"'
    rev = read_csv_table(spark, "order_reviews", d).orderBy("review_score").collect()
    assert [r.review_score for r in rev] == [4, 5]
    assert rev[1].review_comment_message == 'very "good"\nthanks'
    assert rev[0].review_comment_title is None and rev[0].review_answer_timestamp is None
    # trimming makes c2's city equal to c1's; then the two rows differ only by id
    trimmed = clean.trim_strings(read_csv_table(spark, "customers", d))
    assert trimmed.where(F.col("customer_city") == "sao paulo").count() == 2


def test_missing_sources(spark):
    with pytest.raises(MissingSourceError):
        extract_all(spark, "/nonexistent/raw/dir")
    d = tempfile.mkdtemp(prefix="souk-csv-")
    with pytest.raises(MissingSourceError):
        read_csv_table(spark, "orders", d)


def test_pipeline_returns_1_without_data(spark):
    assert pipeline.run_pipeline(spark, "/nonexistent/raw/dir", tempfile.mkdtemp()) == 1


def test_clean_trim_then_dedupe(spark):
    raw = raw_fixture(spark)
    assert raw["customers"].count() == 9
    assert clean.generic_clean(raw["customers"]).count() == 8  # c7 twice, equal once trimmed
    # reviews: same review_id with different text is kept
    assert clean.generic_clean(raw["order_reviews"]).where(F.col("review_id") == "r3").count() == 2
    rep = clean.dedupe_report(raw["geolocation"], "geolocation").first()
    assert (rep.rows_before, rep.rows_after, rep.removed_rows) == (3, 2, 1)


def test_translation_completion(spark):
    raw = raw_fixture(spark)
    tr = clean.complete_translation(clean.generic_clean(raw["product_category_translation"]), raw["products"])
    got = {r.product_category_name: r.product_category_name_english for r in tr.collect()}
    assert got["pc_gamer"] == "pc_gamer"  # stripped source name as fallback
    assert got["informatica"] == "computers"
    assert len(got) == 4


def _broken_wh(spark):
    wh = clean.transform_all(raw_fixture(spark))
    orders = wh["orders"]
    extra = orders.where(F.col("order_id") == "o1").withColumn("customer_id", F.lit("c_missing"))
    wh["orders"] = orders.unionByName(extra)  # duplicate key + orphan customer
    nulls = wh["order_payments"].limit(1).withColumn("payment_type", F.lit(None).cast("string"))
    wh["order_payments"] = wh["order_payments"].unionByName(nulls.withColumn("payment_sequential", F.lit(9)))
    return wh


def test_quality_checks_find_planted_problems(spark):
    wh = _broken_wh(spark)
    dups = {r.table_name: r.duplicate_groups for r in quality.duplicate_key_groups(wh).collect()}
    assert dups["orders"] == 1 and dups["customers"] == 0
    assert quality.orphan_orders(wh).first().orphan_orders == 1
    rep = {(r.table_name, r.check_type, r.columns): r.violations for r in quality.declared_constraints(wh).collect()}
    assert rep[("orders", "PRIMARY KEY", "order_id")] == 1
    assert rep[("orders", "FOREIGN KEY", "customer_id -> customers(customer_id)")] == 1
    assert rep[("order_payments", "NOT NULL", "payment_type")] == 1
    assert rep[("products", "FOREIGN KEY", "product_category_name -> product_category_translation(product_category_name)")] == 0
    with pytest.raises(quality.ConstraintViolation):
        quality.enforce_constraints(wh)
    nulls = {(r.table_name, r.column_name): r.null_pct for r in quality.null_percent(wh).collect()}
    assert nulls[("products", "product_category_name")] == round(100 / 6, 1)


def test_declared_constraints_read_every_table_once(spark):
    """Violations of every kind in several tables, equal to the oracle's, from one scan per table."""
    import contextlib
    import io

    from souk.oracle import ORACLES
    from tests.helpers import duck_on_tables, oracle_body

    wh = _broken_wh(spark)
    items, reviews = wh["order_items"], wh["order_reviews"]
    null = lambda df, c: F.lit(None).cast(df.schema[c].dataType)
    wh["order_items"] = (
        items.unionByName(items)  # every key twice, no reference lost
        .unionByName(items.withColumn("order_item_id", null(items, "order_item_id")).withColumn("seller_id", F.lit("s_missing")))
        .unionByName(items.limit(1).select(*[null(items, c).alias(c) for c in items.columns]))
        .unionByName(items.limit(2).withColumn("product_id", F.lit("p_missing")).withColumn("order_id", F.lit("o_missing")))
    )
    wh["order_reviews"] = reviews.unionByName(reviews.withColumn("order_id", F.lit("o_missing")))
    wh["sellers"] = wh["sellers"].unionByName(wh["sellers"].withColumn("seller_id", null(wh["sellers"], "seller_id")))
    out = tempfile.mkdtemp(prefix="souk-once-")
    for t, df in wh.items():
        df.write.parquet(f"{out}/{t}")
    wh = {t: spark.read.parquet(f"{out}/{t}") for t in wh}

    got = sorted(tuple(r) for r in quality.declared_constraints(wh).collect())
    con = duck_on_tables(wh)
    want = sorted(con.execute(f"SELECT table_name, check_type, columns, violations FROM ({oracle_body(ORACLES['Q6_declared_constraints'])}) q").fetchall())
    assert got == want
    assert {(t, kind) for t, kind, _, n in got if n} >= {
        ("orders", "PRIMARY KEY"), ("orders", "FOREIGN KEY"), ("order_items", "PRIMARY KEY"), ("order_items", "NOT NULL"),
        ("order_items", "FOREIGN KEY"), ("order_reviews", "FOREIGN KEY"), ("sellers", "PRIMARY KEY"), ("sellers", "NOT NULL"),
    }
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        quality.declared_constraints(wh).explain()
    assert len(re.findall("FileScan", text.getvalue())) == len(wh)


def test_declared_constraints_compare_references_in_a_common_type(spark):
    """A reference of another type than its target is found as a join finds it; the target's own key keeps its type."""
    wh = clean.transform_all(raw_fixture(spark))
    for t, c in (("sellers", "seller_id"), ("order_items", "seller_id")):
        wh[t] = wh[t].withColumn(c, F.regexp_replace(c, "[^0-9]", "").cast("int" if t == "sellers" else "bigint"))
    sellers = wh["sellers"].limit(1).withColumn("seller_id", F.lit(77))
    wh["sellers"] = wh["sellers"].unionByName(sellers)
    item = wh["order_items"].limit(1)
    for n, seller in enumerate((77, 2**40), 900):
        wh["order_items"] = wh["order_items"].unionByName(item.withColumn("order_item_id", F.lit(n)).withColumn("seller_id", F.lit(seller)))
    rep = {(r.table_name, r.check_type, r.columns): r.violations for r in quality.declared_constraints(wh).collect()}
    known = [r.seller_id for r in wh["sellers"].collect()]
    assert rep[("order_items", "FOREIGN KEY", "seller_id -> sellers(seller_id)")] == sum(
        r.seller_id not in known for r in wh["order_items"].collect()
    ) >= 1
    assert rep[("sellers", "PRIMARY KEY", "seller_id")] == 0


def test_empty_table_skipped_in_null_report(spark):
    wh = clean.transform_all(raw_fixture(spark))
    wh["sellers"] = wh["sellers"].limit(0).withColumn("seller_city", F.lit(None).cast("string"))
    assert quality.null_percent(wh).where(F.col("table_name") == "sellers").count() == 0


def test_load_and_export_roundtrip(spark):
    out = tempfile.mkdtemp(prefix="souk-wh-")
    wh = pipeline.load_warehouse(raw_fixture(spark), f"{out}/warehouse", strict=False, parallelism=3)
    assert wh["customers"].count() == 8
    res = {n: rows for n, rows, _ in pipeline.export_marts(wh, f"{out}/marts", ["summary_kpis", "cohort_sizes"])}
    assert res == {"summary_kpis": 1, "cohort_sizes": 4}
    kpi = pipeline.load_mart(spark, f"{out}/marts", "summary_kpis").first()
    assert kpi.total_orders == 6
    assert "orders" in pipeline.register_views(wh)


def test_export_goes_on_after_a_fault(spark, monkeypatch):
    """Only marts that are not noted as finished for the warehouse's version are written again."""
    from tests.helpers import same_rows

    out = tempfile.mkdtemp(prefix="souk-restart-")
    wh = pipeline.load_warehouse(raw_fixture(spark), f"{out}/warehouse", strict=False)
    version = warehouse.versions(spark, f"{out}/warehouse")[0]
    names = ["monthly_revenue_trend", "cohort_sizes", "summary_kpis", "rfm_customers"]
    write, calls, broken = pipeline.write_counted, [], {"summary_kpis"}

    def faulty(df, path, name):
        calls.append(name)
        if name in broken:
            df.limit(1).write.mode("overwrite").parquet(path)  # half written
            raise OSError("lost")
        return write(df, path, name)

    monkeypatch.setattr(pipeline, "write_counted", faulty)
    with pytest.raises(OSError):
        pipeline.export_marts(wh, f"{out}/marts", names, parallelism=1, version=version)
    assert calls == ["_order_facts", *names[:3]]
    calls.clear(), broken.clear()
    got = pipeline.export_marts(wh, f"{out}/marts", names, parallelism=1, version=version)
    assert calls == names[2:] and [n for n, _, _ in got] == names and got == pipeline.export_marts(wh, f"{out}/marts", names, version=version)
    for name, rows, cols in got:
        mart, want = pipeline.load_mart(spark, f"{out}/marts", name).toPandas(), pipeline.MARTS[name][1](wh).toPandas()
        assert same_rows(mart, want) and (len(mart), len(mart.columns)) == (rows, cols)
    # another version of the warehouse, or none named: everything anew
    calls.clear()
    pipeline.export_marts(wh, f"{out}/marts", names[:1], version="version-x")
    pipeline.export_marts(wh, f"{out}/marts", names[:2], parallelism=1, version=version)
    pipeline.export_marts(wh, f"{out}/marts", names[1:2])
    pipeline.export_marts(wh, f"{out}/marts", names[1:2], version=version)
    assert calls == [names[0], names[0], names[1], names[1]]


def test_bucketed_warehouse_joins_without_order_shuffle(spark):
    import contextlib
    import io

    from souk.plans import kpis

    wh = pipeline.load_bucketed_warehouse(raw_fixture(spark), "souk_test_wh", buckets=4, strict=False, parallelism=2)
    assert wh["customers"].count() == 8
    assert kpis.summary_kpis(wh).first().total_orders == 6
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            kpis.summary_kpis(wh).explain()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    plan = buf.getvalue()
    assert "SortMergeJoin" in plan
    assert "Exchange hashpartitioning(order_id" not in plan  # co-partitioned by the buckets


def test_views_on_stored_marts_equal_views_on_tables(spark):
    from souk.plans import views
    from tests.helpers import same_rows

    out = tempfile.mkdtemp(prefix="souk-marts-")
    wh = clean.transform_all(raw_fixture(spark))
    pipeline.export_marts(wh, out)
    stored = pipeline.stored_marts(spark, out)
    for view in (views.top_category, views.retention_wide, views.late_vs_on_time, views.segment_table,
                 views.worst_best_state, views.dominant_payment, views.single_installment_share):
        assert same_rows(view(stored).toPandas(), view(wh).toPandas()), view.__name__


def test_run_pipeline_from_csv_files(spark):
    from souk.plans import sales
    from souk.sources.schemas import LOAD_ORDER

    raw_dir = tempfile.mkdtemp(prefix="souk-rawcsv-")
    for name, df in raw_fixture(spark).items():
        pdf = df.toPandas()
        pdf.to_csv(os.path.join(raw_dir, TABLES[name].raw_file), index=False, date_format="%Y-%m-%d %H:%M:%S")
    out = tempfile.mkdtemp(prefix="souk-whcsv-")
    assert pipeline.run_pipeline(spark, raw_dir, out, strict=False) == 0
    wh = warehouse.read_tables(spark, out)
    counts = {t: wh[t].count() for t in LOAD_ORDER}
    assert counts["customers"] == 8 and counts["geolocation"] == 2 and counts["order_reviews"] == 8
    assert counts["product_category_translation"] == 4
    direct = clean.transform_all(raw_fixture(spark))
    from tests.helpers import same_rows

    assert same_rows(sales.monthly_revenue_trend(wh).toPandas(), sales.monthly_revenue_trend(direct).toPandas())
    assert same_rows(wh["orders"].toPandas(), direct["orders"].toPandas())


def test_layout_is_the_callers_choice(spark):
    raw = raw_fixture(spark)
    wh = pipeline.load_bucketed_warehouse(raw, "souk_flat_wh", buckets=None, strict=False, parallelism=2)
    meta = spark.sql(f"DESCRIBE TABLE EXTENDED {warehouse.current_database(spark, 'souk_flat_wh')}.order_items").collect()
    assert not any(r.col_name == "Num Buckets" for r in meta)
    assert wh["order_items"].count() == 11


def test_failed_load_leaves_the_old_tables(spark):
    out = tempfile.mkdtemp(prefix="souk-wh-")
    raw = raw_fixture(spark)
    valid = dict(raw, order_payments=raw["order_payments"], orders=raw["orders"])
    pipeline.load_warehouse(valid, out, strict=False)
    before = {r.order_id for r in warehouse.read_tables(spark, out)["orders"].collect()}
    stray = raw["orders"].where(F.col("order_id") == "o1").withColumn("customer_id", F.lit("nobody")).withColumn("order_id", F.lit("zz"))
    with pytest.raises(quality.ConstraintViolation, match="customer_id"):
        pipeline.load_warehouse(dict(raw, orders=raw["orders"].unionByName(stray)), out)
    assert {r.order_id for r in warehouse.read_tables(spark, out)["orders"].collect()} == before


def test_load_reports_what_cleaning_found(spark, caplog):
    import logging

    with caplog.at_level(logging.INFO, logger="souk"):
        out = tempfile.mkdtemp(prefix="souk-wh-")
        wh = pipeline.load_warehouse(raw_fixture(spark), out, strict=False)
        pipeline.export_marts(wh, f"{out}/marts", ["summary_kpis"])
    text = caplog.text
    assert re.search(r"cleaned geolocation +2 rows, removed duplicates: 1", text)
    assert re.search(r"cleaned orders .*'without_delay': [1-9]", text) and "'untranslated': 0" in text
    assert "first rows:" in text


def test_single_line_csv_is_split_and_folders_are_read(spark):
    d = tempfile.mkdtemp(prefix="souk-csv-")
    head, line = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n", "s%06d,01001,sao paulo,SP\n"
    _write(d, "sellers", head + "".join(line % i for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = read_csv_table(spark, "sellers", d)
        assert df.count() == 20_000
        assert df.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    parts = os.path.join(tempfile.mkdtemp(prefix="souk-csv-"), TABLES["sellers"].raw_file)
    os.makedirs(parts)
    for k in range(3):
        with open(os.path.join(parts, f"part-{k}.csv"), "w", encoding="utf-8") as f:
            f.write(head + line % k)
    assert read_csv_table(spark, "sellers", os.path.dirname(parts)).count() == 3
    assert read_csv_table(spark, "sellers", "", path=f"{parts}/part-[01].csv").count() == 2


def test_csv_columns_are_matched_by_header_name(spark):
    d = tempfile.mkdtemp(prefix="souk-csv-")
    _write(
        d,
        "order_payments",
        "payment_value,order_id,payment_type,payment_sequential,payment_installments\n"
        "12.5,o1,credit_card,1,3\n",
    )
    r = read_csv_table(spark, "order_payments", d).first()
    assert (r.order_id, r.payment_sequential, r.payment_type, r.payment_installments, r.payment_value) == (
        "o1", 1, "credit_card", 3, 12.5
    )
    _write(d, "sellers", "seller_id,seller_city\ns1,rio\n")
    with pytest.raises(ValueError):
        read_csv_table(spark, "sellers", d)


def test_concurrent_jobs_fail_fast():
    import threading
    import time

    from souk.jobs import run_concurrently

    started = []
    lock = threading.Lock()

    def job(i, fail=False, sleep=0.0):
        def run():
            with lock:
                started.append(i)
            time.sleep(sleep)
            if fail:
                raise RuntimeError(f"job {i} failed")
            return i

        return run

    assert run_concurrently([job(i) for i in range(5)], 3) == [0, 1, 2, 3, 4]
    started.clear()
    jobs = [job(0, fail=True), job(1, sleep=0.2)] + [job(i, sleep=0.2) for i in range(2, 20)]
    with pytest.raises(RuntimeError, match="job 0 failed"):
        run_concurrently(jobs, 2)
    assert len(started) < 20  # queued jobs were not started after the failure


def test_conform_selects_by_name_and_casts(spark):
    from souk.sources.warehouse import conform

    df = spark.createDataFrame(
        [(3.0, "o1", "credit_card", 2, "x", 1)],
        "payment_value double, order_id string, payment_type string, payment_installments long, "
        "extra string, payment_sequential long",
    )
    out = conform(df, "order_payments")
    assert out.columns == ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"]
    assert dict(out.dtypes)["payment_installments"] == "int" and dict(out.dtypes)["payment_sequential"] == "int"
    ids = spark.createDataFrame([(7, 1)], "order_id bigint, x int")
    with pytest.raises(ValueError):
        conform(ids, "order_payments")
    keep = spark.createDataFrame([(7, 1, "boleto", 1, 2.0)], "order_id bigint, payment_sequential int, "
                                 "payment_type string, payment_installments int, payment_value double")
    assert dict(conform(keep, "order_payments").dtypes)["order_id"] == "bigint"  # integer ids are kept


REVIEW_ROWS = [
    ("r1", 'plain', "5"),
    ("r2", 'two\nlines, and a comma', "4"),
    ("r3", 'a "quoted" word\n\n"" and blank line\n', "3"),
    ("r4", "", "2"),
    ("r5", "né à\r\nParis", "1"),
    ("r6", '"', "5"),
    ("r7", "x" * 90 + "\n" * 5 + "y" * 70, "5"),
    ("r8", "last\n", "1"),
]


def _reviews_csv(folder, name="", ending="\n"):
    os.makedirs(folder, exist_ok=True)
    quoted = lambda x: '"' + x.replace('"', '""') + '"' if any(c in x for c in ',"\r\n') else x
    out = ["review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp"]
    out += [f"{i}{name},o{k},{score},,{quoted(text)},2018-01-11 00:00:00," for k, (i, text, score) in enumerate(REVIEW_ROWS)]
    with open(os.path.join(folder, f"part{name}.csv"), "w", encoding="utf-8", newline="") as f:
        f.write(ending.join(out) + ending)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_quoted_line_breaks_at_every_split(spark, ending):
    """Whatever the size of the splits, the records are those of the read with multi-line fields."""
    d = tempfile.mkdtemp(prefix="souk-csv-")
    for name in ("", "b"):
        _reviews_csv(f"{d}/reviews", name, ending)
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "emptyValue": ""}
    want = sorted(map(tuple, spark.read.options(**options).csv(f"{d}/reviews").collect()), key=repr)
    assert len(want) == 2 * len(REVIEW_ROWS)
    columns = spark.read.option("header", True).csv(f"{d}/reviews").columns
    for size in (7, 31, 64, 100, 173, 250, 400, 10_000):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        try:
            text = quoted_csv.lines(spark, f"{d}/reviews")
            tasks = text.rdd.getNumPartitions()
            assert sorted(map(tuple, quoted_csv.read(spark, f"{d}/reviews", columns).collect()), key=repr) == want, size
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert tasks >= 4 or size > 400  # the files are read by several tasks
    typed = read_csv_table(spark, "order_reviews", d, f"{d}/reviews")
    by = {r.review_id: r for r in typed.collect()}
    assert by["r3"].review_comment_message == 'a "quoted" word\n\n"" and blank line\n' and by["r4"].review_comment_message is None


def _order_ids(wh):
    return {t: sorted(map(repr, wh[t].collect())) for t in wh}


@pytest.mark.parametrize("broken", ["product_category_translation", "orders", "order_reviews", "publish"])
def test_fault_while_loading_leaves_the_old_version_whole(spark, monkeypatch, broken):
    """Folders: a fault while any table is written, or just before the manifest is renamed."""
    out = tempfile.mkdtemp(prefix="souk-wh-")
    raw = raw_fixture(spark)
    pipeline.load_warehouse(raw, out, strict=False)
    before, old = _order_ids(warehouse.read_tables(spark, out)), warehouse.versions(spark, out)
    fewer = dict(raw, customers=raw["customers"].limit(1), sellers=raw["sellers"].limit(1))

    def fail(*_, **__):
        raise OSError("injected")

    with monkeypatch.context() as m:
        if broken == "publish":
            m.setattr(warehouse, "publish", fail)
        else:
            bad = F.udf(fail, "string")
            column = raw[broken].columns[0]
            fewer[broken] = raw[broken].withColumn(column, bad(F.col(column)))
        with pytest.raises(Exception, match="injected"):
            pipeline.load_warehouse(fewer, out, strict=False, parallelism=1)
    assert warehouse.versions(spark, out) == old and _order_ids(warehouse.read_tables(spark, out)) == before
    assert sum(x.startswith("version-") and not x.endswith(".manifest") for x in os.listdir(out)) == 1


def test_versions_replace_each_other_at_once(spark):
    out = tempfile.mkdtemp(prefix="souk-wh-")
    raw = raw_fixture(spark)
    first = pipeline.load_warehouse(raw, out, strict=False)
    pipeline.load_warehouse(dict(raw, customers=raw["customers"].limit(1)), out, strict=False)
    assert warehouse.read_tables(spark, out)["customers"].count() == 1
    assert first["customers"].count() == 8  # a reader that opened the version before goes on
    pipeline.load_warehouse(raw, out, strict=False)
    assert warehouse.read_tables(spark, out)["customers"].count() == 8
    assert sum(os.path.isdir(f"{out}/{x}") for x in os.listdir(out)) == 2  # the current one and the one before


def test_bucketed_load_checks_before_it_replaces(spark, monkeypatch):
    raw = raw_fixture(spark)
    name = "souk_strict_wh"
    pipeline.load_bucketed_warehouse(raw, name, buckets=2, strict=False, parallelism=4)
    before, at = _order_ids(warehouse.read_catalog_tables(spark, name)), warehouse.current_database(spark, name)
    stray = raw["orders"].where(F.col("order_id") == "o1").withColumn("customer_id", F.lit("nobody")).withColumn("order_id", F.lit("zz"))
    with pytest.raises(quality.ConstraintViolation):
        pipeline.load_bucketed_warehouse(dict(raw, orders=raw["orders"].unionByName(stray)), name, buckets=2)
    assert warehouse.current_database(spark, name) == at and _order_ids(warehouse.read_catalog_tables(spark, name)) == before

    def fail(*_, **__):
        raise OSError("injected")

    with monkeypatch.context() as m:
        m.setattr(warehouse, "publish_catalog", fail)
        with pytest.raises(OSError, match="injected"):
            pipeline.load_bucketed_warehouse(dict(raw, customers=raw["customers"].limit(1)), name, buckets=2, strict=False)
    assert _order_ids(warehouse.read_catalog_tables(spark, name)) == before
    pipeline.load_bucketed_warehouse(dict(raw, customers=raw["customers"].limit(1)), name, buckets=2, strict=False)
    assert warehouse.read_catalog_tables(spark, name)["customers"].count() == 1
    left = [r[0] for r in spark.sql("SHOW DATABASES").collect() if r[0].startswith(f"{name}_")]
    assert sorted(left) == sorted({at, warehouse.current_database(spark, name)})
