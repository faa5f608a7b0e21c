import pytest
from helpers import day, rows
from pyspark.sql import functions as F

from orderlake.functions.scalars import file_date
from orderlake.sources import csv_files, tables


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


FOOD = """,f_id,item,veg_or_non_veg
0,fd0,Dosa,Veg
1,fd1,"Rice, fried",Veg
2,fd2,"a ""hot"" dish",Non-veg
3,fd3
4,fd4,Naan,Veg,surplus,more
5,\\N,NULL,""
6,"NULL", x ,Veg
7,"fd7"junk,Bad,Veg
8,"fd8,Open,Veg
9,fd9,"",Veg
"""


def test_messy_dimension_file(spark, tmp_path):
    put(tmp_path / "food", "food.csv", FOOD)
    got = rows(csv_files.read_table(spark.read, "food", str(tmp_path / "food")), "_idx", "f_id", "item", "veg_or_non_veg")
    assert got == [
        ("0", "fd0", "Dosa", "Veg"),
        ("1", "fd1", "Rice, fried", "Veg"),
        ("2", "fd2", 'a "hot" dish', "Non-veg"),
        ("3", "fd3", None, None),
        ("4", "fd4", "Naan", "Veg"),
        ("5", None, None, None),
        ("6", None, " x ", "Veg"),
        ("9", "fd9", None, "Veg"),
    ]


def test_long_quoted_fields(spark, tmp_path):
    value = 'a ""b"", ' * 20000
    put(tmp_path, "food.csv", f'i,f,item,v\n0,fd0,"{value}",Veg\n1,fd1,"{value},Veg\n2,fd2,""x,Veg\n3,fd3,{"," * 5000}\n')
    got = csv_files.read_table(spark.read, "food", str(tmp_path))
    assert rows(got, "f_id", F.length("item").alias("n")) == [("fd0", len(value.replace('""', '"'))), ("fd3", None)]


def test_records_over_lines_and_rejects(spark, tmp_path):
    text = 'i,f,item,v\r\n1,fd1,"Two\nlines, ""one"" dish",Veg\r\n\n2,fd2,x\u0001y,Veg\n3,"fd3,Open,Veg\n4,fd4,"",Veg\n5,fd"5,z,Veg\n6,"fd6"z,a,Veg\n7,fd7,last,Veg'
    put(tmp_path, "food.csv", text)
    put(tmp_path, "only_header.csv", "i,f,item,v\n")
    put(tmp_path, "empty.csv", "")
    got = csv_files.read_table(spark.read, "food", str(tmp_path))
    assert rows(got, "f_id", "item", "veg_or_non_veg") == [
        ("fd1", 'Two\nlines, "one" dish', "Veg"),
        ("fd2", "x\u0001y", "Veg"),
        ("fd4", None, "Veg"),
        ("fd7", "last", "Veg"),
    ]
    rejects = csv_files.rejected(csv_files.read_records(spark.read, str(tmp_path)))
    assert rows(rejects, "line", "reason") == [
        ('3,"fd3,Open,Veg', "a quote is never closed"),
        ('5,fd"5,z,Veg', "a quote is never closed"),
        ('6,"fd6"z,a,Veg', "text beside a quoted field"),
    ]
    assert {r._source_file.rsplit("/", 1)[1] for r in rejects.collect()} == {"food.csv"}


ORDER = "1,2026-09-01 10:00:00,2026-09-01,5,7,\"Kothrud,Pune\",Pizzas,1,2,100,0,20,5,125,INR,UPI,Delivered,{rating},{minutes}"
HEADER = ",".join(f"c{i}" for i in range(19))


def test_strict_numbers(spark, tmp_path):
    put(tmp_path, "orders.csv", "\n".join([HEADER, ORDER.format(rating="5.0", minutes="31.0"), ORDER.format(rating="", minutes="")]))
    got = csv_files.read_table(spark.read, "orders", str(tmp_path))
    assert rows(got, "order_id", "restaurant_city", "customer_rating", "delivery_time_min") == [
        (1, "Kothrud,Pune", None, None),
        (1, "Kothrud,Pune", 5, 31),
    ]


@pytest.mark.parametrize("bad", [ORDER.format(rating="good", minutes="1"), ORDER.format(rating='"5"x', minutes="1")])
def test_strict_load_aborts(spark, tmp_path, bad):
    put(tmp_path, "orders.csv", "\n".join([HEADER, ORDER.format(rating="5.0", minutes="31.0"), bad]))
    with pytest.raises(Exception):
        csv_files.read_table(spark.read, "orders", str(tmp_path)).collect()


def test_review_text_keeps_line_breaks(spark, tmp_path):
    put(tmp_path, "reviews.csv", 'review_id,order_id,user_id,restaurant_id,rating,comment,review_date\n'
        '1,2,3,4,5,"Good, hot.\nSecond ""line"".",2026-09-02\n')
    got = csv_files.read_table(spark.read, "reviews", str(tmp_path))
    assert rows(got, "comment", "review_date") == [('Good, hot.\nSecond "line".', day("2026-09-02"))]


def test_day_load_reads_one_folder(spark, tmp_path):
    line = "{},2,3,4,5,fine,2026-09-02\n"
    header = "review_id,order_id,user_id,restaurant_id,rating,comment,review_date\n"
    for i, ds in enumerate(("2026-09-01", "2026-09-02")):
        put(tmp_path / "reviews" / f"dt={ds}", f"reviews_{ds}.csv", header + line.format(i))
    got = csv_files.load_day(spark, str(tmp_path), "reviews", "2026-09-02")
    assert rows(got, "review_id", file_date().alias("d")) == [(1, day("2026-09-02"))]
    assert got.select("_loaded_at").distinct().count() == 1


def test_gzip_is_read(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "food.csv.gz", "wt", encoding="utf-8") as out:
        out.write("i,f_id,item,v\n0,fd0,Dosa,Veg\n")
    assert rows(csv_files.read_table(spark.read, "food", str(tmp_path)), "item") == [("Dosa",)]


def test_day_partition_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "orders")
    for ds, n in (("2026-09-01", 3), ("2026-09-02", 2), ("2026-09-01", 1)):
        tables.write_day(spark.range(n), path, ds)
    got = spark.read.parquet(path).groupBy(F.col("dt").cast("string").alias("dt")).count()
    assert rows(got) == [("2026-09-01", 1), ("2026-09-02", 2)]
