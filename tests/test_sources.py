import os

import pytest

from chronoroll.sources import (from_csv_lines, read_csv, read_csv_positional, read_parquet,
                                read_partitioned_csv)

HEADER = "parcel_no,scanned at,depot name,parcel weight\n"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.fixture()
def raw_dirs(tmp_dir):
    base = os.path.join(tmp_dir, "raw")
    write(f"{base}/austin/a.csv", HEADER + "1,01/08/2020 02:30:00 PM,Central,30\n"
                                           "2,01/08/2020 12:10:00 AM,Central,x\n")
    write(f"{base}/austin/b.csv", HEADER + "3,,Hollywood,41\n")
    write(f"{base}/boston/only.csv", HEADER + "4,02/01/2021 11:00:00 AM,Back Bay,\n")
    write(f"{base}/boston/notes.txt", "not a csv\n")
    os.makedirs(f"{base}/chicago")                      # region folder with no CSV
    write(f"{base}/stray.csv", HEADER + "9,01/01/2020 01:00:00 AM,X,1\n")  # top-level file
    return base


COLS = ["parcel_no", "scanned at", "depot name", "parcel weight"]


def test_partitioned_csv_tags_region_and_skips_strays(spark, raw_dirs):
    df = read_partitioned_csv(spark, raw_dirs, columns=COLS, partition_col="city")
    rows = sorted((r["parcel_no"], r["city"]) for r in df.collect())
    assert rows == [("1", "austin"), ("2", "austin"), ("3", "austin"), ("4", "boston")]
    assert dict(df.dtypes)["parcel weight"] == "string"


def test_partitioned_csv_is_one_scan(spark, raw_dirs):
    df = read_partitioned_csv(spark, raw_dirs, columns=COLS, partition_col="city")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1


def test_strict_header_rejects_other_column_order(spark, tmp_dir):
    base = os.path.join(tmp_dir, "raw2")
    write(f"{base}/r1/a.csv", "depot name,parcel_no,scanned at,parcel weight\nCentral,1,x,2\n")
    with pytest.raises(Exception):
        read_partitioned_csv(spark, base, columns=COLS, strict=True).collect()
    loose = read_partitioned_csv(spark, base, columns=COLS, strict=False).collect()
    assert loose[0]["parcel_no"] == "Central"          # positional, as the reference did


def test_short_file_is_null_padded(spark, tmp_dir):
    base = os.path.join(tmp_dir, "raw3")
    write(f"{base}/r1/a.csv", "parcel_no,scanned at\n5,01/08/2020 02:30:00 PM\n")
    r = read_partitioned_csv(spark, base, columns=COLS, strict=False).collect()[0]
    assert r["parcel_no"] == "5" and r["parcel weight"] is None


def test_missing_base_is_a_clear_error(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        read_partitioned_csv(spark, os.path.join(tmp_dir, "nope"), columns=COLS)


def test_csv_infer_reads_reference_time_as_text(spark, raw_dirs):
    df = read_csv(spark, f"{raw_dirs}/austin/a.csv", infer=True)
    types = dict(df.dtypes)
    assert types["scanned at"] == "string" and types["parcel_no"] == "int"


def test_positional_csv_discards_header(spark, raw_dirs):
    df = read_csv_positional(spark, f"{raw_dirs}/boston/only.csv", ["id", "when", "depot", "weight"])
    r = df.collect()
    assert df.columns == ["id", "when", "depot", "weight"] and r[0]["id"] == "4" and len(r) == 1


def test_parquet_glob(spark, sf_small):
    df = read_parquet(spark, sf_small, glob="nation.parquet")
    assert df.count() == 25


def test_csv_lines(spark):
    df = spark.createDataFrame([("1,abc,2.5",), ("2,,x",)], "line string")
    out = from_csv_lines(df, "line", "a BIGINT, b STRING, c DOUBLE").collect()
    assert (out[0]["a"], out[0]["b"], out[0]["c"]) == (1, "abc", 2.5)
    assert out[1]["c"] is None


def test_region_subset_is_narrowed_at_listing(spark, raw_dirs, tmp_dir):
    from chronoroll.sources.files import region_glob
    df = read_partitioned_csv(spark, raw_dirs, columns=COLS, partition_col="city", regions=["boston"])
    assert {r["city"] for r in df.collect()} == {"boston"}
    assert all("/boston/" in f for f in df.inputFiles())
    # key=value folders and glob characters in names
    base = os.path.join(tmp_dir, "kv")
    write(f"{base}/city=a*b/x.csv", HEADER + "1,01/08/2020 02:30:00 PM,A,1\n")
    write(f"{base}/city=ab/x.csv", HEADER + "2,01/08/2020 02:30:00 PM,A,1\n")
    got = read_partitioned_csv(spark, base, columns=COLS, partition_col="city", regions=["a*b"])
    assert [r["parcel_no"] for r in got.collect()] == ["1"]
    assert region_glob("*/*.csv", ["x"]) == "{x,*=x}/*.csv"
