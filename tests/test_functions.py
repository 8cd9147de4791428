"""Golden cases for the scalar functions (FIXTURES F1, F6, F7 and S-3/S-6/S-14)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from sleeper.functions import (
    ids_from_attribute_html,
    ids_from_links,
    is_target_label,
    join_list,
    normalize_text,
    parse_price,
    run_ts_from_path,
    safe_int,
    slug,
)


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("r")).first()["r"]


def test_ids_from_a_results_page(spark):
    """One id per row, a bundle of three, a row whose id is a word, and a row without the attribute."""
    rows = ['<a class="hit" href="/x" data-ds-appid="8100"><span>first</span></a>',
            "<p data-other='17'>no id here</p>",
            '<a data-ds-appid="[31,32 , 33]" data-bundle="7"></a>',
            '<a data-ds-appid="bundle-9"></a>',
            '<a data-ds-appid="008"></a>']
    assert one(spark, ids_from_attribute_html, "\n".join(rows)) == [8100, 31, 32, 33, 8]


def test_ids_from_search_html_none_and_duplicates(spark):
    assert one(spark, ids_from_attribute_html, "<div>no ids</div>") == []
    assert one(spark, ids_from_attribute_html, '<a data-ds-appid="5"></a><a data-ds-appid="5"></a>') == [5, 5]
    assert one(spark, ids_from_attribute_html, '<a data-ds-appid=" [ 1 ,x, 2 ] "></a>') == [1, 2]


def test_ids_from_links_keep_order(spark):
    html = '<a href="/app/10/x">a</a><a href="/app/7">b</a><a href="/app/10">c</a>'
    assert one(spark, ids_from_links, html) == [10, 7, 10]


def test_safe_int(spark):
    vals = [("12 ",), ("3.7",), ("x",), (None,), ("-4",)]
    got = [r["r"] for r in spark.createDataFrame(vals, "v string").select(safe_int("v").alias("r")).collect()]
    assert got == [12, None, None, None, -4]
    assert spark.range(1).select(safe_int(F.lit(3.7)).alias("r")).first()["r"] == 3


def test_parse_price_table(spark):
    cases = [("$9.99", "9.99"), ("5,99€", "5.99"), ("Mex$ 1,299.00", "1299.00"), ("1.299,00€", "1299.00"),
             ("ARS$ 1.299", "1299.00"), ("S/.35.50", "35.50"), ("0", "0.00"), ("Free", None), ("", None),
             (None, None), ("S/.35", "35.00"), ("Rs. 99", "99.00"), ("4,99 pуб.", "4.99"), ("9.99.", "9.99"),
             ("-5.00", "-5.00"), ("-$5.00", "-5.00"), ("$-5", "-5.00"), ("\u2212 3,50€", "-3.50"), ("$.99", "0.99"),
             (".5", "0.50"), ("1 299,00 €", "1299.00"), ("CHF 1'299.50", "1299.50"), ("1.299.000", "1299000.00"),
             ("R$ 12,5", "12.50"), ("2 for 9.99", "2.00"), ("...", None), ("A-Z 7", "7.00")]
    df = spark.createDataFrame([(t,) for t, _ in cases], "v string")
    got = [r["r"] for r in df.select(parse_price("v").alias("r")).collect()]
    assert got == [Decimal(e) if e is not None else None for _, e in cases]


def test_parse_price_free_flag(spark):
    df = spark.createDataFrame([("Free", True), ("Free", False), (None, True), ("$5", True)], "v string, f boolean")
    got = [r["r"] for r in df.select(parse_price("v", "f").alias("r")).collect()]
    assert got == [Decimal("0.00"), None, Decimal("0.00"), Decimal("5.00")]


def test_review_labels(spark):
    cases = [("Extremadamente positivas", True, True), (" OVERWHELMINGLY Positive ", True, True),
             ("Éxtremadamente positivas", True, True), ("Muy positivas", False, True),
             ("Very Positive", False, True), ("Mixed", False, False), ("", False, False), (None, False, False)]
    df = spark.createDataFrame([(c[0],) for c in cases], "v string")
    got = df.select(is_target_label("v").alias("a"), is_target_label("v", True).alias("b")).collect()
    assert [(r["a"], r["b"]) for r in got] == [(c[1], c[2]) for c in cases]


def test_normalize_text(spark):
    df = spark.createDataFrame([("  Éxtremadamente POSITIVAS\n",), (None,), ("ﬁne",)], "v string")
    got = [r["r"] for r in df.select(normalize_text("v").alias("r")).collect()]
    assert got == ["extremadamente positivas", "", "fine"]


def test_normalize_text_is_pythons_over_all_signs(spark):
    """Every assigned sign alone and between others; the words of a sentence; no Python worker in the plan."""
    import unicodedata

    def python(t):
        return "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower().strip()

    signs = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) not in ("Cn", "Cs", "Co")]
    texts = signs + [f"A{c}b{c}{c}Σ" for c in signs[::23]] + ["ΑΣ ΣΑΣ. 한국어 ﬁ½ ǅ\u0301", "x" * 100_000 + "ﷺ각é", ""]
    df = spark.createDataFrame([(t,) for t in texts], "v string").repartition(4).select("v", normalize_text("v").alias("r"))
    assert [(r["v"], r["r"]) for r in df.collect() if r["r"] != python(r["v"])] == []
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()


def test_join_list(spark):
    df = spark.createDataFrame([(["a", None, "", "b"],), (None,), ([],)], "v array<string>")
    got = [r["r"] for r in df.select(join_list("v").alias("r")).collect()]
    assert got == ["a | b", "", ""]


def test_slug(spark):
    df = spark.createDataFrame([("Half-Life 2: Episode_One!",), ("!!!",), ("  Ñandú  ",)], "v string")
    got = [r["r"] for r in df.select(slug("v").alias("r")).collect()]
    assert got == ["Half-Life_2_Episode_One", "sin_nombre", "Ñandú"]


def test_run_ts_from_path(spark):
    df = spark.createDataFrame([("s3://bucket/landing/2026-04-05_10-20-30/x.jsonl",),
                                ("/r/run=2001-01-01_00-00-00/part-0.json",), ("/r/nodate/x.json",)], "v string")
    got = [r["r"] for r in df.select(F.date_format(run_ts_from_path("v"), "yyyy-MM-dd HH:mm:ss").alias("r"))
           .collect()]
    assert got == ["2026-04-05 10:20:30", "2001-01-01 00:00:00", None]
