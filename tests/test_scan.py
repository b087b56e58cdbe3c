"""The order CSV's contract."""

import os
import tempfile

import pytest

from supplyscope.sources import tables as src


def line(**values):
    base = {h: "" for h in src.RAW_REQUIRED}
    base.update({"Order Id": "1", "Sales": "10.5", "Order Item Quantity": "2", "Product Name": "Niño café"})
    return {**base, **values}


def folder(*files, header=src.RAW_REQUIRED):
    root = tempfile.mkdtemp(prefix="supplyscope-csv-", dir="/tmp")
    for i, rows in enumerate(files):
        with open(os.path.join(root, f"part-{i}.csv"), "w", encoding="latin-1") as f:
            f.write(",".join(header) + "\n")
            for r in rows:
                f.write((r if isinstance(r, str) else ",".join(r[h] for h in header)) + "\n")
    return root


def test_latin_1_and_names(spark):
    rows = src.read_order_csv(spark, folder([line(), line(**{"Order Id": "2"})])).orderBy("order_id").collect()
    assert [(r.order_id, r.product_name, r.sales) for r in rows] == [("1", "Niño café", "10.5"), ("2", "Niño café", "10.5")]


def test_bad_rows_are_counted_and_kept_apart(spark):
    short, long = "7,too,short", ",".join(["8"] * (len(src.RAW_REQUIRED) + 2))
    path = folder([line(), short, line(**{"Order Id": "x", "Sales": "n/a"})], [long, line(**{"Order Id": "3"})])
    good, bad = src.split_scan(src.scan_order_csv(spark, path))
    assert good.count() == 3 and sorted(r.line for r in bad.collect()) == sorted([short, long])
    assert src.read_order_csv(spark, path).select("order_id").count() == 3
    # a few columns of the good rows are the same rows
    assert sorted(r[0] for r in src.read_order_csv(spark, path).select("order_id").collect()) == ["1", "3", "x"]
    typed, worse = src.split_scan(src.scan_order_csv(spark, path, typed=True))
    assert typed.schema["Order Id"].dataType.simpleString() == "bigint" and typed.schema["Sales"].dataType.simpleString() == "double"
    assert sorted(r["Order Id"] for r in typed.collect()) == [1, 3] and worse.count() == 3


def test_wrong_headers_fail(spark):
    without = tuple(h for h in src.RAW_REQUIRED if h != "Sales")
    with pytest.raises(src.HeaderError, match="Sales"):
        src.read_order_csv(spark, folder([], header=without))
    turned = folder([line()])
    with open(os.path.join(turned, "part-9.csv"), "w", encoding="latin-1") as f:
        f.write(",".join(reversed(src.RAW_REQUIRED)) + "\n" + ",".join("1" for _ in src.RAW_REQUIRED) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        src.read_order_csv(spark, turned).collect()


def test_extra_columns_stay(spark):
    header = (*src.RAW_REQUIRED, "Customer Email")
    df = src.read_order_csv(spark, folder([{**line(), "Customer Email": "a@b.c"}], header=header))
    assert df.first()["Customer Email"] == "a@b.c"


def test_empty_file(spark):
    assert src.read_order_csv(spark, folder([])).count() == 0
