"""Work that grows with the lines is done once: what is stored, what is sorted."""

import os

import pytest

from supplyscope.operators import clean, models, sinks
from supplyscope.plans import load_all


def files(df) -> set[str]:
    return {os.path.basename(f) for f in df.inputFiles()} | {os.path.basename(os.path.dirname(f)) for f in df.inputFiles()}


@pytest.mark.parametrize("name", ["dq1_min_rows", "dq2_summary_sanity", "dq8_check_summary", "set5_agent_alerts",
                                  "agt10_all_alerts", "mld6_inventory_tree", "mld6_agg24_tree_held_out"])
def test_stored_tables_are_read_not_joined_again(spark, sf_small, name):
    """F7, F11, F15 to F19."""
    assert "lineitem.parquet" not in files(load_all().QUERIES[name](spark, sf_small))


@pytest.mark.parametrize("name", ["snk1_snk5_derived_tables", "snk3_replace_orders"])
def test_stored_frames_do_not_join_the_lines_again(spark, sf_small, name, monkeypatch):
    """what is written to the store comes from the run's tables."""
    seen = []
    for way in ("append", "overwrite"):
        plain = getattr(sinks.TableStore, way)
        monkeypatch.setattr(sinks.TableStore, way, lambda self, table, df, plain=plain: (seen.append(files(df)), plain(self, table, df))[1])
    load_all().QUERIES[name](spark, sf_small)
    assert seen and not any("lineitem.parquet" in s for s in seen)


def test_run_stores_what_is_read_many_times(spark, sf_small):
    """Conflicts, weekly demand and inventory are built once."""
    from supplyscope.plans.context import run_for
    run = run_for(spark, sf_small)
    for frame, name in ((run.inventory, "inventory"), (run.weekly, "weekly"), (run.conflict_alerts, "conflict_alerts")):
        assert name in files(frame)
        assert "order_features" not in files(frame)


def test_fill_median_stores_its_rows(spark, tmp_path):
    """the medians' passes and the result read stored rows."""
    spark.createDataFrame([(1, 2.0, "a"), (2, None, None), (3, 8.0, "c"), (None, 4.0, None)], "k int, x double, t string").write.parquet(f"{tmp_path}/raw")
    out = clean.fill_median(spark.read.parquet(f"{tmp_path}/raw"))
    assert "raw" not in files(out)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, 2.0, "a"), (2, 4.0, None), (3, 8.0, "c"), (2, 4.0, None)], key=str)


def test_forest_caches_no_node_ids(spark):
    """nothing of a hundred numbers a row is stored level by level."""
    names = models.DELIVERY_FEATURES
    rows = [(*[float((i * (k + 3)) % 7) for k in range(len(names))], i % 2, i) for i in range(60)]
    lines = spark.createDataFrame(rows, [*names, "late_delivery_risk", "order_id"]).selectExpr(
        "*", "named_struct('order_id', order_id, 'line_number', 1, 'part_key', 1L, 'supp_key', 1L, 'ship_date', timestamp'2020-01-01', "
        "'extended_price', 1.0D, 'line_quantity', 1.0D) AS item_seq")
    model, split = models.train_delivery_forest(lines, num_trees=2, max_depth=2)
    assert not model.getCacheNodeIds()
    assert model.getNumTrees == 2 and split.count() == 60


def test_groups_are_sent_to_the_alerts(spark):
    """alerts aren't shuffled on agent and category; nulls and empty batches change nothing."""
    base = spark.createDataFrame([("A", "x", 1), ("A", "y", 2), ("B", "x", 3), (None, "x", 4)], "agent string, category string, id int")
    new = spark.createDataFrame([("A", "x", 9), ("A", "x", 8), (None, "x", 7)], "agent string, category string, id int")
    out = sinks.replace_alert_groups(base, new)
    assert sorted(r.id for r in out.collect()) == [2, 3, 4, 7, 8, 9]
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in sinks.replace_alert_groups(base, new.limit(0)).collect()) == [1, 2, 3, 4]


def test_draws_store_each_value_once(spark, sf_small):
    """the stored lines of samples and splits hold no value twice, and the rows are the joined lines."""
    from supplyscope.plans.context import run_for
    from supplyscope.sources.tables import ITEM_SEQ_FIELDS
    run = run_for(spark, sf_small, materialize=False)
    stored = spark.read.parquet(os.path.dirname(run.draw_lines.inputFiles()[0])).columns
    assert sorted(stored) == sorted([*ITEM_SEQ_FIELDS, "order_status", "late_delivery_risk", "shipping_mode"])
    same = run.items.select(run.draw_lines.columns)
    assert run.draw_lines.exceptAll(same).isEmpty() and same.exceptAll(run.draw_lines).isEmpty()


def test_texts_of_an_order_stay_with_it(spark, tmp_path):
    """lines go to the parts with codes and results, not with their order's texts; nulls count as before."""
    from supplyscope.sources import order_items
    day = "timestamp'1995-03-0{}'"
    tables = {
        "region": "SELECT 0 AS r_regionkey, 'R' AS r_name", "nation": "SELECT 0 AS n_nationkey, 'N' AS n_name, 0 AS n_regionkey",
        "customer": "SELECT 1L AS c_custkey, 0 AS c_nationkey, 'S' AS c_mktsegment",
        "part": "SELECT 1L AS p_partkey, 'p' AS p_name, 't' AS p_type, 'b' AS p_brand, 2.0D AS p_retailprice",
        "orders": f"""SELECT k AS o_orderkey, 1L AS o_custkey, s AS o_orderstatus, {day.format(1)} AS o_orderdate, p AS o_orderpriority
            FROM VALUES (1L, 'P', '1-URGENT'), (2L, 'O', '2-HIGH'), (3L, 'P', CAST(NULL AS STRING)), (4L, NULL, '1-URGENT'),
            (5L, 'F', '3-MEDIUM'), (6L, 'P', '5-LOW'), (6L, 'P', '1-URGENT') t(k, s, p)""",
        "lineitem": f"""SELECT k AS l_orderkey, 1L AS l_partkey, 1L AS l_suppkey, n AS l_linenumber, 1.0D AS l_quantity,
            100.0D AS l_extendedprice, 0.1D AS l_discount, 0.2D AS l_tax, r AS l_returnflag, {day.format(3)} AS l_shipdate
            FROM VALUES (1L, 1, 'R'), (1L, 2, CAST(NULL AS STRING)), (1L, 3, 'A'), (2L, 1, 'R'), (3L, 1, 'R'), (4L, 1, 'R'), (5L, 1, 'R'),
            (6L, 1, 'R'), (7L, 1, 'R') t(k, n, r)"""}
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    items = order_items(spark, str(tmp_path))
    got = items.select("order_id", "line_number", "order_status", "shipping_mode", "days_scheduled", "days_real", "late_delivery_risk")
    fraud = "SUSPECTED_FRAUD"
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        (1, 1, fraud, "Same Day", 0, 3, 1), (1, 2, "P", "Same Day", 0, 3, 1), (1, 3, "P", "Same Day", 0, 3, 1),
        (2, 1, "O", "First Class", 1, 3, 1), (3, 1, "P", "Standard Class", 4, 3, 0), (4, 1, None, "Same Day", 0, 3, 1),
        (5, 1, "F", "Second Class", 2, 3, 1), (6, 1, "P", "Standard Class", 4, 3, 0), (6, 1, fraud, "Same Day", 0, 3, 1)], key=str)
    plan = items.select("item_seq", "late_delivery_risk")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, x in enumerate(plan) if "Join Inner" in x and "p_partkey" in x)
    carried = plan[join + 1]
    assert "AS days_real" in carried and "priority" in carried and "o_orderpriority" not in carried


def test_top_scores_read_the_narrow_lines(spark, sf_small):
    """TOP3 stores and reads no features it doesn't need."""
    seen = files(load_all().QUERIES["top3_highest_late_scores"](spark, sf_small))
    assert any(f.startswith("draw-lines") for f in seen) and "order_features" not in seen


@pytest.mark.parametrize("band", ["critical", "high"])
def test_risk_bands_compute_the_delivery_agent_only(spark, sf_small, band):
    """the other agents' and the conflicts' rows, which the view leaves out, aren't computed or stored."""
    from supplyscope.operators import reports
    from supplyscope.plans.catalog_reports import dview
    out = load_all().QUERIES[f"flt6_risk_band_{band}"](spark, sf_small)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not any(agent in plan for agent in ("InventoryAgent", "DemandAgent", "FraudAgent", "ConflictResolver"))
    assert not {"order_features", "agent_alerts", "predictions", "weekly", "inventory"} & files(out)
    want = reports.risk_band(dview(spark, sf_small), band).select("order_id", "risk_prob")
    assert out.exceptAll(want).isEmpty() and want.exceptAll(out).isEmpty()


def stored_bytes(folder, part=""):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if part in f)


def test_shuffles_go_when_their_rows_are_stored(spark, tmp_path):
    """what a write shuffled stays no longer than the write, and the setting is the session's again."""
    from supplyscope import session
    root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]
    before, was = stored_bytes(root, ".data"), spark.conf.get(session.CLEANUP, None)
    df = spark.range(200000).selectExpr("id % 50000 AS k", "md5(cast(id AS string)) AS t").repartition(7, "k")
    out = session.written(df, "shuffled")
    assert out.count() == 200000 and spark.conf.get(session.CLEANUP, None) == was
    assert stored_bytes(root, ".data") - before < 1_000_000


def test_run_stores_a_line_value_once_and_reads_the_same_features(spark, sf_small):
    """the stored lines hold no key twice and no column made of others; readers get the same rows."""
    import pyarrow.parquet as pq

    from supplyscope.operators.features import row_features
    from supplyscope.plans.context import run_for
    run = run_for(spark, sf_small)
    want = row_features(run.items)
    assert run.feats.columns == want.columns
    assert run.feats.exceptAll(want).isEmpty() and want.exceptAll(run.feats).isEmpty()
    file = pq.ParquetFile(run.feats.inputFiles()[0].removeprefix("file://"))
    assert "item_seq" not in file.schema_arrow.names and "order_season" not in file.schema_arrow.names
    assert file.metadata.row_group(0).column(0).compression == "ZSTD"


def test_summary_reads_the_stored_tables(spark, sf_small):
    """agg7_summary joins the lines no further time."""
    from supplyscope.plans.catalog_reports import q_agg7
    assert "lineitem" not in " ".join(q_agg7(spark, sf_small).inputFiles())


def test_keyed_insert_leaves_other_groups_alone(spark):
    """alerts of groups that the batch lacks meet no anti-join; nulls match nothing, as before."""
    cols = "agent string, category string, product_name string, order_id long, message string"
    base = spark.createDataFrame([("A", "x", "p", 1, "m"), ("A", "x", "q", 2, "n"), ("A", "y", "p", 1, "m"), (None, "x", "p", 1, "m"),
                                  ("A", "x", None, None, "m"), ("A", "x", None, 0, "o"), ("A", "x", "r", None, "m2"), ("A", "x", "q", 2, "n")], cols)
    new = spark.createDataFrame([("A", "x", "p", 1, "new1", 1), ("A", "x", "p", 1, "new2", 2), ("A", "x", "r", 0, "new3", 3),
                                 ("A", "x", "", None, "m", 4), ("B", "z", None, 7, "new4", 5)], cols + ", seq int")
    out = sinks.insert_alerts_keyed(base, new, "seq")
    got = sorted(((r.agent, r.category, r.product_name, r.order_id, r.message) for r in out.collect()), key=str)
    assert got == sorted([("A", "x", "q", 2, "n"), ("A", "x", "q", 2, "n"), ("A", "y", "p", 1, "m"), (None, "x", "p", 1, "m"), ("A", "x", None, 0, "o"),
                          ("A", "x", "p", 1, "new2"), ("A", "x", "r", 0, "new3"), ("A", "x", "", None, "m"), ("B", "z", None, 7, "new4")], key=str)
    assert out.columns == base.columns
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
