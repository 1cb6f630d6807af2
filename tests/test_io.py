import pytest
from pyspark.sql import functions as F

from tillroll.operators import prep
from tillroll.sources import files, tables
from tillroll.streaming import ingest

SF = "/root/testdata/sf0.001"


def test_run_log_latest_first(spark):
    path = ingest.scratch_path(spark, "runlog")
    for run in ("20240101_000000", "20240102_000000"):
        rows = spark.createDataFrame([(run, f"{run[:8]} 00:00:00", m) for m in ("apriori", "eclat")],
                                     "run_id string, created_at string, algorithm string")
        for c in files.RUN_LOG_SCHEMA.fieldNames():
            if c not in rows.columns:
                rows = rows.withColumn(c, F.lit(None).cast("string"))
        files.append_run_log(rows, path)
    got = files.latest_runs(spark, path, limit=3).collect()
    assert [r["run_id"] for r in got] == ["20240102_000000", "20240102_000000", "20240101_000000"]


def test_ingest_keeps_files_of_any_age_and_replays(spark):
    """One file a year, read in mixed order, then all of it again."""
    lines = tables.table(spark, SF, "lineitem").join(
        tables.table(spark, SF, "orders").select("o_orderkey", F.year("o_orderdate").alias("y")),
        F.col("l_orderkey") == F.col("o_orderkey"))
    inbox, out = ingest.scratch_path(spark, "inbox"), ingest.scratch_path(spark, "lines")
    for year in (2001, 2000, 1995, 1996):
        lines.filter(F.col("y") == year).drop("o_orderkey", "y").coalesce(1).write.mode("append").parquet(inbox)
    expected = prep.dedupe_transactions(tables.transactions(spark, SF)).filter(
        F.substring("t_dat", 1, 4).isin("2001", "2000", "1995", "1996")).count()
    orders = tables.table(spark, SF, "orders")
    for run in ("first", "again"):  # a new checkpoint replays every file
        stream = ingest.lines_stream(spark, inbox, orders, max_files_per_trigger=1)
        ingest.ingest_unique_lines(stream, out, ingest.scratch_path(spark, f"ckpt-{run}"), rows_per_writer=50)
        assert ingest.read_unique_lines(spark, out).count() == expected


def _batch(spark, rows):
    return spark.createDataFrame(rows, "t_dat string, customer_id string, article_id string")


def _files(path):
    import glob

    base = path.replace("file:", "")
    return {f[len(base):] for f in glob.glob(f"{base}/t_month=*/bucket=*/part-*")}


def test_baskets_are_kept_by_chunks(spark):
    """Baskets after each of four chunks equal a rebuild from all lines so
    far; folders that a chunk does not touch keep their files."""
    first = [(f"1996-0{m}-1{d}", f"c{c}", f"{a:010d}") for m in (1, 2, 3) for d in range(4) for c in range(6) for a in (1, 2)]
    chunks = [first, [("1996-01-10", "c1", "0000000009"), ("1996-01-10", "c1", "0000000001")],
              [("1995-07-01", "new", "0000000001"), ("1996-03-13", "single", "0000000001")],
              [("1995-07-01", "new", "0000000002"), ("1996-02-12", "c5", "0000000003")], first]
    inbox, out, kept = (ingest.scratch_path(spark, n) for n in ("chunk-in", "chunk-lines", "chunk-baskets"))
    ckpt, so_far, before = ingest.scratch_path(spark, "chunk-ckpt"), [], set()
    for i, rows in enumerate(chunks):
        _batch(spark, rows).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema("t_dat string, customer_id string, article_id string").parquet(inbox)
        ingest.ingest_unique_lines(stream, out, ckpt, buckets=4, baskets_path=kept)
        so_far += rows
        want = {(r["customer_id"], r["t_dat"], tuple(r["items"])) for r in prep.build_baskets(_batch(spark, so_far)).collect()}
        got = [(r["customer_id"], r["t_dat"], tuple(r["items"])) for r in ingest.read_kept_baskets(spark, kept).collect()]
        assert set(got) == want and len(got) == len(want)
        assert ingest.read_unique_lines(spark, out).count() == len(set(so_far))
        files = _files(kept)
        if 0 < i < 4:
            touched = {d[:7] for d, _, _ in rows}
            gone = before - files
            assert len(before & files) >= len(before) - 2 and all(f.split("t_month=")[1][:7] in touched for f in gone)
        before = files


def test_a_batch_reads_the_folders_it_touches(spark):
    """Two keys of one day: the scan of the stored lines lists their folders
    and that day only."""
    rows = ingest._placed(_batch(spark, [("1996-05-03", f"c{i}", "0000000001") for i in range(2)]), 64)
    folders = rows.groupBy(*ingest.FOLDER).agg(F.min("t_dat").alias("first"), F.max("t_dat").alias("last")).collect()
    path = ingest.scratch_path(spark, "placed")
    ingest._placed(_batch(spark, [(f"1996-05-0{d}", f"c{i}", "0000000001") for d in range(1, 8) for i in range(300)]), 64
                   ).repartition(*ingest.FOLDER).write.partitionBy(*ingest.FOLDER).parquet(path)
    stored = ingest.read_unique_lines(spark, path).filter(ingest._touched(folders, days=True))
    assert len(folders) <= 2 and len(stored.inputFiles()) == 64
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(t_dat,1996-05-03)" in plan
    read = {r["bucket"] for r in stored.select("bucket").distinct().collect()}
    assert read == {r["bucket"] for r in folders} and 2 <= stored.count() < 40


def test_csv_readers(spark):
    path = ingest.scratch_path(spark, "csv-in")
    spark.createDataFrame([("7", "A \"b\", c", "Top", "x"), ("8", "D", "Hat", "y")],
                          "article_id string, prod_name string, product_group_name string, other string"
                          ).write.option("header", True).option("escape", '"').csv(f"{path}/articles")
    arts = files.read_articles_csv(spark, f"{path}/articles").orderBy("article_id").collect()
    assert [(r["article_id"], r["prod_name"], r["section_name"]) for r in arts] == [
        ("7", 'A "b", c', None), ("8", "D", None)]
    spark.createDataFrame([("c1", "31.5"), ("c2", "old")], "customer_id string, age string").write.option(
        "header", True).csv(f"{path}/customers")
    cust = files.read_customers_csv(spark, f"{path}/customers").orderBy("customer_id").collect()
    assert [(r["customer_id"], r["age"]) for r in cust] == [("c1", 31.5), ("c2", None)]


def test_stored_baskets_prune_years(spark):
    path = ingest.scratch_path(spark, "pruned")
    files.write_baskets(prep.build_baskets(tables.transactions(spark, SF)), path)
    back = files.read_baskets(spark, path).filter(F.col("t_year") >= "1996")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(t_year" in plan and back.count() > 0


def test_experiment_error_row_keeps_parameters(spark):
    baskets = spark.createDataFrame([("t", "c", "1996-01-01", "1 2")],
                                    "transaction_id string, customer_id string, t_dat string, items string")
    from tillroll.operators import experiments

    configs = [dict(name="bad", min_support=7.0, top_items=0, max_baskets=0, max_len=2, start_date="x" * 2000),
               dict(name="late", top_items=0, max_baskets=0)]
    sink = ingest.scratch_path(spark, "log")
    rows = experiments.experiment_grid(baskets, configs, methods=("apriori",), sink=sink).collect()
    assert [(r["config"], r["status"], r["min_support"], r["max_len"]) for r in rows] == [("bad", "error", 7.0, 2)]
    assert len(rows[0]["start_date"]) == 2000 and rows[0]["error"]
    long = experiments._error_row(spark, "long", experiments.build_args({}, {}), ValueError("y" * 2000)).first()
    assert long["error"] == "y" * 2000
    both = experiments.experiment_grid(baskets, configs, methods=("apriori",), continue_on_error=True, timed=True,
                                       sink=sink).collect()
    assert [r["status"] for r in both] == ["error", "ok"] and both[1]["fastest"] and both[1]["elapsed_seconds"] > 0
    assert files.read_experiments(spark, sink).count() == 3


def test_csv_transactions_source_prunes_columns(spark):
    path = ingest.scratch_path(spark, "tx-csv")
    tables.transactions_wide(spark, SF).write.option("header", True).csv(path)
    back = files.read_transactions_csv(spark, path)
    assert back.columns == ["t_dat", "customer_id", "article_id"]
    assert back.count() == tables.transactions(spark, SF).count()


def test_sinks_round_trip(spark):
    from tillroll.operators import mining, itemsets as IS, variants

    baskets = spark.createDataFrame([("t1", ["0000000001", "0000000002"]), ("t2", ["0000000001", "0000000002"])],
                                    "transaction_id string, items array<string>")
    names = spark.createDataFrame([("0000000001", "Shirt")], "article_id string, prod_name string")
    found = IS.with_product_names(mining.apriori(baskets, 0.5, 2), names)
    path = ingest.scratch_path(spark, "itemsets")
    files.write_itemsets(found, path)
    back = {r["itemset_key"]: r["product_names"] for r in spark.read.option("header", True).csv(path).collect()}
    assert back == {"0000000001": "Shirt", "0000000002": "0000000002", "0000000001 0000000002": "Shirt | 0000000002"}

    summary = ingest.scratch_path(spark, "summary")
    files.write_json(found.select("itemset_key", "support_count"), summary)
    assert spark.read.json(summary).count() == 3

    vb = spark.createDataFrame([("year_1996", "t", "c", "1996-01-02", ["a", "b"], 2)],
                               "variant string, transaction_id string, customer_id string, t_dat string, "
                               "items array<string>, item_count bigint")
    vpath = ingest.scratch_path(spark, "variants")
    files.write_variants(vb, vpath)
    assert spark.read.parquet(vpath).filter("variant = 'year_1996'").count() == 1
    manifest = {r["key"]: r for r in variants.variant_manifest(vb, "/v/").collect()}
    assert manifest["year_1996"]["rows"] == 1 and manifest["year_1996"]["path"] == "/v/variant=year_1996"
    assert manifest["base"]["rows"] is None and len(manifest) == 2


def test_run_summary_is_one_nested_object(spark):
    """Two runs, read back from the file: parameters, a part per method and
    the comparison, as nested JSON."""
    import glob
    import json

    from tillroll.operators import compare, experiments

    path = ingest.scratch_path(spark, "summaries")
    schema = "itemset_key string, length int"
    stats = spark.createDataFrame([(9, 4)], "transactions bigint, unique_items bigint")
    found = {"apriori": spark.createDataFrame([("x", 1), ("y", 1), ("x y", 2)], schema),
             "eclat": spark.createDataFrame([("x", 1), ("z", 1)], schema), "none": spark.createDataFrame([], schema)}
    for support in (0.5, 0.25):
        config = {"baskets": "b", "max_baskets": None, "top_items": 500, "min_support": support, "start_date": None}
        long = compare.method_long(found)
        one = files.run_summary(config, experiments.method_summary(found, stats, {"apriori": 1.23456, "eclat": 2.0, "none": 0.5}),
                                compare.common_itemsets(long, ["apriori", "eclat"]),
                                compare.pairwise_differences(long, list(found)))
        assert one.count() == 1
        files.append_summary(one, path)
    lines = [json.loads(x) for f in sorted(glob.glob(f"{path.replace('file:', '')}/part-*")) for x in open(f)]
    assert len(lines) == 2
    got = next(x for x in lines if x["input"]["parameters"]["min_support"] == 0.25)
    assert got == {
        "input": {"parameters": {"baskets": "b", "max_baskets": None, "top_items": 500, "min_support": 0.25, "start_date": None},
                  "transactions": 9, "unique_items": 4},
        "algorithms": {"apriori": {"elapsed_seconds": 1.2346, "frequent_itemsets": 3, "max_itemset_length": 2},
                       "eclat": {"elapsed_seconds": 2.0, "frequent_itemsets": 2, "max_itemset_length": 1},
                       "none": {"elapsed_seconds": 0.5, "frequent_itemsets": 0, "max_itemset_length": 0}},
        "comparison": {"common_itemsets": 1, "pairwise_differences": {
            "apriori_vs_eclat": {"only_left": 2, "only_right": 1}, "apriori_vs_none": {"only_left": 3, "only_right": 0},
            "eclat_vs_none": {"only_left": 2, "only_right": 0}}}}


def test_catalog_and_metric_sources(spark, tmp_path):
    cat = tmp_path / "top_items.csv"
    cat.write_text("rank,old_article_idx,new_item_idx\n1,4100,1\n2,37,2\n")
    assert [tuple(r) for r in files.read_catalog_csv(spark, str(cat)).collect()] == [(1, 4100, 1), (2, 37, 2)]
    met = tmp_path / "metrics.csv"
    met.write_text("Model,Loss,Accuracy (Top-1),Top-3 Accuracy,Top-5 Accuracy,Top-10 Accuracy,Top-20 Accuracy\n"
                   "Popularity baseline,,0.5,,0.75,,\nModel A,8.0,0.125,0.25,0.5,0.625,0.875\n")
    from tillroll.operators import evaluation as E
    m = files.read_metric_table(spark, str(met))
    kept = E.model_comparison(m).collect()
    assert [r["model"] for r in kept] == ["Model A"]
    best = E.best_model(E.model_comparison(m)).first()
    assert best["best_top20_model"] == "Model A" and best["best_loss"] == 8.0


def test_scratch_tables_are_emptied(spark):
    import glob

    from tillroll.session import Scratch

    with pytest.raises(ZeroDivisionError):
        with Scratch(spark) as scratch:
            t = scratch.cut(spark.range(10))
            scratch.hold(spark.range(5)).count()
            folder = scratch.folder.replace("file:", "")
            assert t.count() == 10
            raise ZeroDivisionError
    assert spark.read.parquet(folder).count() == 0 and not scratch.held
    assert len(glob.glob(f"{folder}/part-*")) <= 1


def test_broadcast_is_bounded_by_bytes(spark):
    from tillroll.session import broadcast_if_small, fits_broadcast

    wide = spark.range(50).select(F.repeat(F.lit("x"), 10_000).alias("s"))
    assert not fits_broadcast(wide, byte_limit=100_000) and fits_broadcast(wide)
    assert broadcast_if_small(wide, row_limit=10) is wide


def test_a_file_of_the_inbox_is_bounded(spark, tmp_path, monkeypatch):
    """More lines make more files, not larger ones, also where one order has
    half of the lines; the batches stay as many and the result the same."""
    from tillroll.plans import io_queries

    sf = str(tmp_path)
    spark.range(2000).select(
        F.when(F.col("id") < 1000, F.lit(7)).otherwise(F.col("id") % 90).alias("l_orderkey"),
        (F.col("id") % 11).alias("l_partkey"), F.col("id").cast("int").alias("l_linenumber"),
        F.lit(1.0).alias("l_extendedprice")).write.parquet(f"{sf}/lineitem.parquet")
    spark.range(90).select(F.col("id").alias("o_orderkey"), (F.col("id") % 40).alias("o_custkey"), F.expr(
        "timestamp'1996-01-01' + make_interval(0, 0, 0, cast(id % 5 as int))").alias("o_orderdate")).write.parquet(f"{sf}/orders.parquet")
    want = prep.dedupe_transactions(tables.transactions(spark, sf)).collect()
    monkeypatch.setattr(io_queries, "LINES_A_FILE", 100)
    inbox, a_batch = io_queries._inbox(spark, sf, "bounded", 4, F.desc("l_orderkey"))
    files = spark.read.parquet(inbox).groupBy(F.input_file_name()).count().collect()
    assert a_batch == 5 and sum(r["count"] for r in files) == 2000 and max(r["count"] for r in files) <= 250
    got = io_queries.incremental_dedupe(spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_writers_of_baskets_follow_the_lines(spark):
    """A folder of the basket table with many lines has several writers."""
    inbox, out, kept = (ingest.scratch_path(spark, n) for n in ("many-in", "many-lines", "many-baskets"))
    rows = [("1996-01-10", f"c{c}", f"{a:010d}") for c in range(200) for a in (1, 2)]
    _batch(spark, rows).write.parquet(inbox)
    stream = spark.readStream.schema("t_dat string, customer_id string, article_id string").parquet(inbox)
    ingest.ingest_unique_lines(stream, out, ingest.scratch_path(spark, "many-ckpt"), rows_per_writer=50, buckets=1,
                               baskets_path=kept)
    assert len(_files(kept)) > 1 and ingest.read_kept_baskets(spark, kept).count() == 200
