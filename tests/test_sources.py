import pytest
from conftest import random_applications, rows_of
from pyspark.sql import functions as F

from creditgrade import run_batch, score_applications
from creditgrade.operators import projections
from creditgrade.schema import RAW_COLUMNS
from creditgrade.sources import readers, sinks, star


def test_csv_round_trip(spark, tmp_path):
    raw = random_applications(spark, 7, 50)
    path = str(tmp_path / "csv")
    sinks.write_csv(raw, path)
    again = readers.read_csv(spark, path)
    assert again.columns == list(RAW_COLUMNS)
    assert dict(again.dtypes)["annual_inc"] == "double"
    # Delimited text has no way to tell an empty text from a null.
    assert rows_of(again) == rows_of(raw.replace("", None))


def test_csv_column_order_and_extra_columns(spark, tmp_path):
    path = str(tmp_path / "csv")
    raw = random_applications(spark, 8, 20)
    shuffled = raw.select(F.lit("x").alias("extra"), *reversed(RAW_COLUMNS))
    shuffled.write.option("header", True).csv(path)
    assert readers.read_csv(spark, path).columns == list(RAW_COLUMNS)
    inferred = readers.read_csv(spark, path, infer_schema=True)
    assert len(inferred.columns) == len(RAW_COLUMNS) + 1
    assert dict(inferred.dtypes)["annual_inc"] == "double"


def test_parquet_scan_reads_used_columns(spark, tmp_path):
    path = str(tmp_path / "parquet")
    sinks.write_parquet(random_applications(spark, 9, 20).withColumn("extra", F.lit(1)), path)
    assert readers.read_parquet(spark, path).columns == list(RAW_COLUMNS)


def test_partitioned_sink_keeps_column_order(spark, sf_dir, tmp_path):
    scored = score_applications(star.applications(spark, sf_dir)).select(
        "loan_final_grade", "member_id", "loan_score"
    )
    again = sinks.write_parquet(scored, str(tmp_path / "out"), partition_by=["loan_final_grade"])
    assert again.columns == scored.columns
    assert rows_of(again) == rows_of(scored)


def test_sink_does_not_overwrite(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_parquet(spark.range(1), path)
    with pytest.raises(Exception):
        sinks.write_parquet(spark.range(1), path)
    assert sinks.write_parquet(spark.range(3), path, "overwrite").count() == 3


def test_view_and_row_count(spark, sf_dir):
    raw = star.applications(spark, sf_dir)
    assert readers.row_count(raw).first()["n_rows"] == 1508
    readers.register_view(raw, "applications_seen")
    assert spark.sql("SELECT count(*) FROM applications_seen").first()[0] == 1508


def test_batch_writes_all_tables(spark, sf_dir, tmp_path):
    raw = star.applications(spark, sf_dir)
    out = str(tmp_path / "out")
    scored = run_batch(raw, out, with_verification=True)
    assert rows_of(scored) == rows_of(score_applications(raw))
    counts = {
        name: spark.read.parquet(f"{out}/{name}").count()
        for name in ("customers", "loans", "repayments", "delinquency", "records")
    }
    assert counts == {
        "customers": 1009,
        "loans": 1491,
        "repayments": 1443,
        "delinquency": 1286,
        "records": 1508,
    }
    assert spark.read.parquet(f"{out}/verification").agg(F.sum("_times")).first()[0] == 4433
    assert spark.read.parquet(f"{out}/bad_members").count() == 337
    assert spark.read.parquet(f"{out}/good_customers").count() == 692


def test_file_formats_give_the_same_scores(spark, tmp_path):
    raw = random_applications(spark, 10, 200).replace("", None)
    csv, parquet = str(tmp_path / "csv"), str(tmp_path / "parquet")
    sinks.write_csv(raw, csv)
    sinks.write_parquet(raw, parquet)
    assert rows_of(score_applications(readers.read_csv(spark, csv))) == rows_of(
        score_applications(readers.read_parquet(spark, parquet))
    )


@pytest.mark.parametrize("kind", ["bigint", "float", "decimal(12,2)", "double", "string"])
def test_the_type_of_the_income_does_not_change_the_key(spark, kind):
    values = ["5000", "0", "12345678", "10000000", None]
    rows = [tuple(v if name == "annual_inc" else "x" for name in RAW_COLUMNS) for v in values]
    text = spark.createDataFrame(rows, ", ".join(f"{name} string" for name in RAW_COLUMNS))
    typed = text.withColumn("annual_inc", F.col("annual_inc").cast(kind))
    keys = [rows_of(projections.with_member_id(df).select("member_id")) for df in (text, typed)]
    assert keys[0] == keys[1]


def test_lost_files_are_noticed(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(100).repartition(4)
    assert sinks.write_parquet(df, path).count() == 100
    assert sinks.write_parquet(df.filter("id < 0"), f"{path}-empty").count() == 0
    next((tmp_path / "out").glob("part-*.parquet")).unlink()
    again = spark.read.schema(df.schema).parquet(path)
    with pytest.raises(sinks.LostRows):
        sinks.checked(again, 100, path)


def test_a_cluster_needs_a_shared_folder():
    class Session:
        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda name, default: default)

    with pytest.raises(ValueError):
        sinks.shared_folder(Session)
    Session.conf.get = staticmethod(lambda name, default: "/shared/")
    assert sinks.shared_folder(Session).startswith("/shared/")


def test_the_batch_reads_its_input_once(spark, sf_dir, tmp_path):
    source, out = str(tmp_path / "source"), str(tmp_path / "out")
    sinks.write_parquet(star.applications(spark, sf_dir), source)
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    raw = spark.read.parquet(source)
    run_batch(raw.mapInArrow(seen, raw.schema), out)
    assert read.value == 1508
    stamps = {
        row[0]
        for name in ("customers", "loans", "repayments", "good_customers")
        for row in spark.read.parquet(f"{out}/{name}").select("ingest_date").distinct().collect()
    }
    assert len(stamps) == 1


def test_rejected_lines(spark, tmp_path):
    lines = ['id,title,grade', '1,"a, b",A', "2,b", "2,b", "", '3,"say ""x"", y",B,more', '4,"open,C', "5,,"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "in" / "two.csv").write_text("id,title,grade\n6,x,C\n")
    good, rejects = readers.ingest_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert rows_of(good) == rows_of(
        spark.createDataFrame([("1", "a, b", "A"), ("5", None, None), ("6", "x", "C")], "id string, title string, grade string")
    )
    found = {(r["line"], r["reason"], r["n_lines"]) for r in rejects.collect()}
    assert found == {
        ("2,b", "too few fields", 2),
        ('3,"say ""x"", y",B,more', "too many fields", 1),
        ('4,"open,C', "open quote", 1),
    }


def test_rejected_lines_of_empty_and_clashing_files(spark, tmp_path):
    (tmp_path / "none.csv").write_text("id,title\n")
    good, rejects = readers.ingest_csv(spark, str(tmp_path / "none.csv"), str(tmp_path / "out"))
    assert good.columns == ["id", "title"] and good.count() == 0 and rejects.count() == 0
    (tmp_path / "clash.csv").write_text("id,csv_rejected\n1,2\n")
    with pytest.raises(ValueError):
        readers.ingest_csv(spark, str(tmp_path / "clash.csv"), str(tmp_path / "out2"))
