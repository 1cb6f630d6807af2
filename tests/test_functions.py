from pyspark.sql import functions as F

from tillroll.functions import pad_sequence, parse_article_ids, parse_items, safe_token, title_case, zfill
from tillroll.functions.text import percent_text, readable_token


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first()["r"]


def test_zfill_never_truncates(spark):
    assert one(spark, zfill, "5") == "0000000005"
    assert one(spark, zfill, "abcdefghijkl") == "abcdefghijkl"
    assert one(spark, zfill, "0123456789") == "0123456789"


def test_safe_token(spark):
    assert one(spark, safe_token, "Brand#13") == "brand_13"
    assert one(spark, safe_token, "  --  ") == "unknown"
    assert one(spark, safe_token, "Ladies / A&B+") == "ladies_a_b"


def test_parse_items_formats(spark):
    assert one(spark, parse_items, "1 22  333") == ["0000000001", "0000000022", "0000000333"]
    assert one(spark, parse_items, "['5', '6']") == ["0000000005", "0000000006"]
    assert one(spark, parse_items, "[7, 8,]") == ["0000000007", "0000000008"]
    assert one(spark, parse_items, None) == []
    # emptiness is tested before quotes are stripped: '' survives as an empty id
    assert one(spark, parse_items, "'', 4") == ["0000000000", "0000000004"]
    assert one(spark, parse_items, "outfit_ab product_group_x") == ["0outfit_ab", "product_group_x"]


def test_title_case_like_python(spark):
    assert one(spark, title_case, "size 2xl a1b") == "Size 2Xl A1B"
    assert one(spark, readable_token, "garment_group_dresses_ladies") == "Dresses Ladies"
    assert one(spark, readable_token, "outfit_size_2xl") == "Size 2Xl"


def test_parse_article_ids(spark):
    assert one(spark, parse_article_ids, "12, 13\n 14  ,,15") == ["12", "13", "14", "15"]


def test_pad_sequence(spark):
    def pad(values):
        return spark.createDataFrame([(values,)], "v array<int>").select(pad_sequence("v").alias("r")).first()["r"]

    assert pad([]) == [0] * 20
    assert pad([1, 2, 3]) == [1, 2, 3] + [0] * 17
    assert pad(list(range(1, 26))) == list(range(6, 26))


def test_percent_text(spark):
    assert one(spark, percent_text, 0.12345, "double") == "12.35%"
    assert one(spark, percent_text, None, "double") == "N/A"
    assert one(spark, percent_text, 0.0, "double") == "0.00%"
