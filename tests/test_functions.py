import pytest

from postlake.functions.keys import company_key, posting_id, surrogate_key
from postlake.functions.numeric import haversine, safe_add, safe_divide, safe_subtract, width_bucket
from postlake.functions.parsing import parse_experience, parse_salary
from postlake.functions.text import slugify, slugify_name
from postlake.functions.urls import (absolute_url, clean_url, company_from_url, url_host,
                                     url_parameter, url_path)


def _one(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


SALARY_CASES = [
    ("Thỏa thuận", (None, None, True)),
    ("Negotiable", (None, None, True)),
    (None, (None, None, True)),
    ("", (None, None, True)),
    ("10 - 20 triệu", (10_000_000.0, 20_000_000.0, False)),
    ("500 - 1000 USD", (12_500_000.0, 25_000_000.0, False)),
    ("Từ 15 triệu", (15_000_000.0, None, False)),
    ("Tới 30 triệu", (None, 30_000_000.0, False)),
    ("20 triệu", (20_000_000.0, 20_000_000.0, False)),
    ("1,000 USD", (25_000.0, 25_000.0, False)),
    ("Hấp dẫn", (None, None, True)),
    ("2.000.000 - 30.5 tr", (2.0, 0.0, False)),
]


@pytest.mark.parametrize("text,expected", SALARY_CASES)
def test_parse_salary(spark, text, expected):
    got = _one(spark, [(text,)], "s string", parse_salary("s"))[0]
    assert tuple(got) == expected


EXP_CASES = [
    ("Không yêu cầu", (None, None, True)),
    (None, (None, None, True)),
    ("2 - 5 năm", (2, 5, False)),
    ("Trên 5 năm", (5, None, False)),
    ("Dưới 1 năm", (None, 1, False)),
    ("3 năm", (3, 3, False)),
    ("99999999999 năm", (None, None, False)),
]


@pytest.mark.parametrize("text,expected", EXP_CASES)
def test_parse_experience(spark, text, expected):
    got = _one(spark, [(text,)], "s string", parse_experience("s"))[0]
    assert tuple(got) == expected


def test_urls(spark):
    assert _one(spark, [("https://h/a/b/?x=1#t",), ("",), (None,)], "u string", clean_url("u")) == \
        ["https://h/a/b", "", ""]
    assert _one(spark, [("/x",), ("http://y",)], "u string", absolute_url("u", "https://b.vn")) == \
        ["https://b.vn/x", "http://y"]
    df = [(None, "https://h/detail-jobs/acme-soft-123"), ("", "https://h/detail-jobs/solo"),
          ("Given", "https://h/detail-jobs/acme-soft-123"), (None, None)]
    assert _one(spark, df, "c string, u string", company_from_url("c", "u")) == \
        ["Acme Soft", "", "Given", None]
    hosts = [("https://www.a.com/x/y?z=1",), ("android-app://com.app/p",), ("a.com?q=1",)]
    assert _one(spark, hosts, "u string", url_host("u")) == ["www.a.com", "com.app", "a.com"]
    paths = [("https://a.com/x/y?z=1",), ("a.com",), ("a.com?q=1",), ("http://a.com/p#f",)]
    assert _one(spark, paths, "u string", url_path("u")) == ["x/y", "a.com", "", "p#f"]
    params = [("a.com/?utm_source=g&x=1",), ("a.com/?source=&x=1",), ("a.com",)]
    assert _one(spark, params, "u string", url_parameter("u", "source")) == ["g", None, None]


def test_keys(spark):
    import hashlib
    rows = [("a", "1", None)]
    got = _one(spark, rows, "a string, b string, c string", surrogate_key(["a", "b", "c"]))[0]
    assert got == hashlib.md5(b"a-1-_dbt_utils_surrogate_key_null_").hexdigest()
    got = _one(spark, rows, "a string, b string, c string", surrogate_key(["a", "b", "c"], True))[0]
    assert got == hashlib.md5(b"a-1-").hexdigest()
    ids = _one(spark, [(None,), ("unknown",)], "c string", company_key("c"))
    assert ids[0] == ids[1] == hashlib.md5(b"company_unknown").hexdigest()
    rows = [("x", "https://h/j/1/?a=b"), ("https://h/viec-lam/dev-2102239/?t=1", None),
            ("https://h/other/dev-22", ""), ("plain", None), (None, None)]
    got = _one(spark, rows, "j string, u string", posting_id("j", "u"))
    assert got == [hashlib.sha256(b"https://h/j/1").hexdigest(), "2102239",
                   "https://h/other/dev-22", "plain", None]


def test_numeric(spark):
    rows = [(1, None, 3), (None, None, None)]
    assert _one(spark, rows, "a int, b int, c int", safe_add(["a", "b", "c"])) == [4, 0]
    assert _one(spark, rows, "a int, b int, c int", safe_subtract(["a", "b", "c"])) == [-2, 0]
    assert _one(spark, [(1.0, 0.0), (3.0, 2.0)], "a double, b double", safe_divide("a", "b")) == [None, 1.5]
    assert _one(spark, [(-1.0,), (2.0,), (10.0,), (12.0,)], "v double", width_bucket("v", 0, 10, 5)) == \
        [0, 2, 6, 6]
    d = _one(spark, [(48.864716, 2.349014, 52.373169, 4.890660)], "a double, b double, c double, d double",
             haversine("a", "b", "c", "d", "km"))[0]
    assert round(d) == 430
    with pytest.raises(ValueError):
        haversine("a", "b", "c", "d", "ft")


def test_slugify(spark):
    vals = ["Hello World", "1st-place!!", "a -- b"]
    assert _one(spark, [(v,) for v in vals], "s string", slugify("s")) == ["hello_world", "_1st_place", "a_b"]
    assert [slugify_name(v) for v in vals] == ["hello_world", "_1st_place", "a_b"]


def test_staged_parsers_match_column_form(spark):
    from postlake.functions.parsing import with_experience, with_salary
    texts = [t for t, _ in SALARY_CASES] + [t for t, _ in EXP_CASES]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    a = with_experience(with_salary(df, "s"), "s").collect()
    b = df.select("s", parse_salary("s").alias("p"), parse_experience("s").alias("e")).select(
        "s", "p.*", "e.*").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]


def test_slugify_reference_examples(spark):
    vals = ["!Hell0 world-hi", "0Hell0 world-hi"]
    assert [slugify_name(v) for v in vals] == ["hell0_world_hi", "_0hell0_world_hi"]
    assert _one(spark, [(v,) for v in vals], "s string", slugify("s")) == ["hell0_world_hi", "_0hell0_world_hi"]
