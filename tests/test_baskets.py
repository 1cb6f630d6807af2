from tillroll.operators import baskets as B
from tillroll.operators import prep, variants


def test_null_keys_dropped_and_dedupe(spark):
    lines = spark.createDataFrame(
        [("2020-01-01", "c1", "1"), ("2020-01-01", "c1", "1"), (None, "c1", "2"), ("2020-01-01", None, "3"),
         ("2020-01-01", "c1", None), ("2020-01-01", "c1", "2")],
        "t_dat string, customer_id string, article_id string")
    assert prep.dedupe_transactions(lines).count() == 2
    b = prep.build_baskets(lines, 2).collect()
    assert len(b) == 1 and b[0]["items"] == ["0000000001", "0000000002"] and b[0]["transaction_id"] == "c1_2020-01-01"


def test_first_n_counts_before_size_filter(spark):
    df = spark.createDataFrame(
        [("t1", "c1", "2020-01-01", "1"), ("t2", "c2", "2020-01-02", "1 2"), ("t3", "c3", "2020-01-03", "1 2")],
        "transaction_id string, customer_id string, t_dat string, items string")
    out = B.load_baskets(df, max_baskets=2, min_items=2)
    assert [r["transaction_id"] for r in out.collect()] == ["t2"]


def test_top_item_tie_breaks_by_item(spark):
    df = spark.createDataFrame([("t1", "c", "d", "y x")], "transaction_id string, customer_id string, t_dat string, "
                                                          "items string")
    top = B.top_items(B.with_parsed_items(df, pad_width=None), 1).collect()
    assert top[0]["item"] == "x"


def test_repeated_customer_takes_later_group(spark):
    c = spark.createDataFrame([("1", 20.0), ("1", 50.0), ("2", None), ("3", 24.9)], "customer_id string, age double")
    got = {r["customer_id"]: r["age_group"] for r in variants.customer_age_groups(c).collect()}
    assert got == {"1": "age_45_plus", "3": "age_under_25"}


def test_year_ranges_are_closed(spark):
    b = spark.createDataFrame([("t", "c", "1996-12-31", ["a", "b"], 2), ("u", "c", "1997-01-01", ["a", "b"], 2)],
                              "transaction_id string, customer_id string, t_dat string, items array<string>, "
                              "item_count bigint")
    got = {r["transaction_id"]: r["variant"] for r in variants.year_baskets(b).collect()}
    assert got == {"t": "year_1996", "u": "year_1997"}


def test_dense_ids_are_dense_and_ordered(spark):
    df = spark.createDataFrame([(f"c{i % 7}", f"d{i}") for i in range(50)], "customer_id string, t_dat string")
    out = prep.dense_ids(df, ["customer_id", "t_dat"], "id", num_partitions=3).collect()
    ordered = sorted(out, key=lambda r: (r["customer_id"], r["t_dat"]))
    assert [r["id"] for r in ordered] == list(range(1, 51))


def test_restriction_keeps_baskets_with_repeated_ids_apart(spark):
    df = spark.createDataFrame(
        [("t1", "c", "d", "x y"), ("t1", "c", "d", "y z"), ("t1", "c", "d", "x y"), (None, None, "d", "z y")],
        "transaction_id string, customer_id string, t_dat string, items string")
    out = B.load_baskets(df, top_items_n=2, min_items=1, pad_width=None).collect()
    # y four times, x and z twice: x by name
    assert sorted((r["transaction_id"] or "", r["items"]) for r in out) == [
        ("", ["y"]), ("t1", ["x", "y"]), ("t1", ["x", "y"]), ("t1", ["y"])]


BASKETS = "transaction_id string, customer_id string, t_dat string, items array<string>, item_count bigint"


def test_years_come_from_the_baskets(spark):
    b = spark.createDataFrame([(d, "c", d, ["a", "b"], 2) for d in ("2018-05-01", "1969-12-31", "2031-01-01", "no day")], BASKETS)
    got = {r["transaction_id"]: r["variant"] for r in variants.year_baskets(b).collect()}
    assert got == {"2018-05-01": "year_2018", "1969-12-31": "year_1969", "2031-01-01": "year_2031"}
    told = {r["key"]: (r["label"], r["description"], r["rows"])
            for r in variants.variant_manifest(variants.year_baskets(b)).collect()}
    assert told["year_2018"] == ("Year 2018", "Baskets from 2018-01-01 to 2018-12-31", 1) and len(told) == 4


def test_ranges_from_a_table(spark):
    """Overlapping, nested, one-day, empty and broken ranges, each basket in
    every range that holds its day."""
    import datetime

    days = [(datetime.date(1995, 1, 1) + datetime.timedelta(days=13 * i)).isoformat() for i in range(200)]
    b = spark.createDataFrame([(f"t{i}", "c", d, ["a", "b"], 2) for i, d in enumerate(days)] + [("one", "c", days[3], ["a"], 1)],
                              BASKETS)
    ranges = [("all", "1990-01-01", "2030-12-31"), ("mid", "1996-02-10", "1998-07-03"), ("in", "1997-03-05", "1997-03-20"),
              ("day", days[7], days[7]), ("back", "1998-01-01", "1997-01-01"), ("none", "2020-01-01", "2020-02-01"),
              ("broken", "x", "1999-01-01")]
    want = sorted((v, f"t{i}") for v, a, e in ranges if v != "broken" for i, d in enumerate(days) if a <= d <= e)
    for given in (ranges, spark.createDataFrame(ranges, "variant string, start string, end string")):
        got = variants.year_baskets(b, given)
        assert sorted((r["variant"], r["transaction_id"]) for r in got.collect()) == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_incidence_vectors(spark):
    rows = [("t1", ["b", "a", "b"]), ("t1", ["c"]), (None, []), ("t2", None), ("t3", ["d", "a", None])]
    df = spark.createDataFrame(rows, "transaction_id string, items array<string>")
    got = sorted((r["transaction_id"] or "", r["size"], r["indices"], r["values"]) for r in B.incidence_vectors(df).collect())
    assert got == [("", 4, [], []), ("t1", 4, [0, 1], [1.0, 1.0]), ("t1", 4, [2], [1.0]), ("t2", 4, [], []),
                   ("t3", 4, [0, 3], [1.0, 1.0])]
    some = spark.createDataFrame([("a", 5), ("c", 1)], "item string, idx int")
    assert sorted(r["indices"] for r in B.incidence_vectors(df, some).collect()) == [[], [], [1], [5], [5]]


def test_exact_distinct_expands_no_rows(spark):
    from tillroll.operators import profile

    df = spark.createDataFrame([(i % 3, None if i % 2 else f"v{i}", i) for i in range(40)], "a int, b string, c int")
    got = profile.profile_distinct({"t": df})
    assert {r["column_name"]: r["distinct_count"] for r in got.collect()} == {"a": 3, "b": 20, "c": 40}
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_category_variants_shuffle_a_row_per_item(spark):
    """The regrouping is by basket: no row per item and variant is shuffled."""
    b = spark.createDataFrame([("t", "c", "1996-01-01", ["0000000001", "0000000002"]),
                               ("u", "c", "1996-01-02", ["0000000001", "0000000003"])],
                              "transaction_id string, customer_id string, t_dat string, items array<string>")
    arts = spark.createDataFrame([("1", "A", "X"), ("2", "B", "X"), ("2", "C", None), ("3", "A", "Y")],
                                 "article_id string, product_group_name string, garment_group_name string")
    got = variants.category_variants(b, arts, [("pg", "product_group_name", "pg"), ("gg", "garment_group_name", "gg"),
                                               ("outfit", "garment_group_name", "o")], 2, map_rows=10**9)
    exchanges = [x for x in _plan(got).splitlines() if "hashpartitioning" in x]
    assert exchanges and not any("variant" in x for x in exchanges)
    assert {(r["variant"], r["transaction_id"], tuple(r["items"]), r["item_count"]) for r in got.collect()} == {
        ("pg", "t", ("pg_a", "pg_c"), 2), ("gg", "u", ("gg_x", "gg_y"), 2), ("outfit", "u", ("o_x", "o_y"), 2)}


def test_a_short_list_restricts_inside_the_row(spark):
    """No shuffle and no regrouping; nulls and empty baskets as before."""
    b = spark.createDataFrame([("t", ["b", "a", "b", None, "z"]), ("t", None), ("u", ["z"])],
                              "transaction_id string, items array<string>")
    got = B.restrict_items(b, spark.createDataFrame([("a",), ("b",), (None,)], "item string"))
    assert "hashpartitioning" not in _plan(got)
    assert sorted((r["transaction_id"], r["items"]) for r in got.collect()) == [("t", []), ("t", ["a", "b"]), ("u", [])]
