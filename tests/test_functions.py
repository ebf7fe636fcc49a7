"""Edge rows of every scalar rule."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ebbline.functions import dates, html, series, text
from ebbline.plans import training, warehouse


def apply(spark, rule, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["r"] for r in df.select("i", rule(F.col("v")).alias("r")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "rule, cases",
    [
        (text.to_number, {"1,234.5": 1234.5, "-": None, "": None, "x": None, " 7\n": 7.0, "1e3": 1000.0, "NaN": None,
                          "1.5d": None, "1e999": None, "-3": -3.0, ".5": 0.5, None: None}),
        (text.strict_number, {"1,234.5": None, "12": 12.0}),
        (text.to_int, {"12": 12, " 12 ": 12, "1.5": None, "": None, "n/a": None, "99999999999": None}),
        (text.bool_label, {"true": "TRUE", " y ": "TRUE", "0": "FALSE", "No": "FALSE", "maybe": "MAYBE", None: ""}),
        (text.bool_flag, {" yes ": 1, "N": 0, "maybe": None, None: None}),
        (text.clean_text, {"a\tb\r\n": "a b", None: "", "\xa0 x": "x"}),
        (text.parse_list, {"['A' 'B']": ["A", "B"], "[A, B]": ["A", "B"], "A|B, C": ["A", "B, C"], " ": [], "A": ["A"],
                           None: [], "[]": [], "['']": ["''"], ",": [], "[A|B]": ["A", "B"], "a, ,b": ["a", "b"]}),
        (text.pipe_items, {"a| b ||c": ["a", "b", "c"], None: [], "": []}),
        (text.comma_items, {"a, b,,": ["a", "b"], None: []}),
        (text.warehouse_norm, {"Single-player": "single player", "a   b": "a  b", " A_B ": "a b"}),
        (text.scoring_norm, {"Single-player": "single player", "a & b": "a  b", "a - b": "a b", "Café!": "café", "a_b": "a b"}),
        (dates.parse_release_month, {"23 Feb, 2017": dt.date(2017, 2, 1), "Feb 23, 2017": dt.date(2017, 2, 1),
                                     "Dec 2020": dt.date(2020, 12, 1), "Coming Soon": None, "TBA": None,
                                     "To be announced": None, "Sept 2020": dt.date(2020, 9, 1), "": None, None: None}),
        (dates.parse_month, {"February 2024": dt.date(2024, 2, 1), "Last 30 Days": None, "Feb 2024": dt.date(2024, 2, 1),
                             " february 2024 ": dt.date(2024, 2, 1), "x": None, None: None}),
        (dates.parse_date, {"23 Feb, 2017": dt.date(2017, 2, 23), "soon": None}),
    ],
)
def test_text_rules(spark, rule, cases):
    assert apply(spark, rule, list(cases)) == list(cases.values())


def test_safe_log_and_finite(spark):
    assert apply(spark, text.safe_log, [math.e, 0.0, -1.0, None], "double") == [1.0, None, None, None]
    assert apply(spark, text.finite, [1.0, float("nan"), float("inf"), float("-inf"), None], "double") == [1.0, None, None, None, None]


def test_months_between(spark):
    row = spark.sql("select date'2023-11-01' a, date'2024-02-01' b")
    got = row.select(dates.months_between(F.col("a"), F.col("b")), dates.months_between(F.col("b"), F.col("a"))).first()
    assert tuple(got) == (3, -3)


@pytest.mark.parametrize(
    "free, price, tier",
    [(True, 20.0, "Free"), (False, None, "Free"), (False, 0.0, "Free"), (False, 9.99, "Under_10"), (None, 10.0, "10_29"),
     (False, 30.0, "30_59"), (False, 60.0, "60_plus")],
)
def test_price_tier(spark, free, price, tier):
    df = spark.createDataFrame([(free, price)], "f boolean, p double")
    assert df.select(warehouse.price_tier(F.col("f"), F.col("p"))).first()[0] == tier


def test_sample_weight(spark):
    assert apply(spark, training.sample_weight, [-0.06, -0.05, None], "double") == [1.8, 1.0, 1.0]


def test_volatility_is_population_std(spark):
    got = spark.range(1).select(series.population_std(F.lit(0.0), F.lit(0.0), F.lit(3.0))).first()[0]
    assert got == pytest.approx(math.sqrt(2))


def test_base_log_is_clipped(spark):
    assert apply(spark, series.base_log, [0.0, 1.0], "double") == pytest.approx([math.log(1e-9), 0.0])


def test_anchor_ids_take_the_whole_href(spark):
    page = (
        '<link href="/app/1"><a class="x" href="/app/2">a</a><a href="/app/3/reviews">b</a><A HREF=\'/app/4\'>c</A>'
        '<a data-href="/app/5">d</a><a href="/app/x6">e</a><a href="https://h/app/7">f</a>'
    )
    assert apply(spark, html.anchor_ids, [page]) == [["2", "4"]]


def test_page_ids_are_a_union(spark):
    page = '<a href="https://h/app/7/Name">x</a><div data-ds-appid="8"></div><img src="/app/7/pic.png"><a href="/app/9">y</a>'
    assert apply(spark, html.page_ids, [page, ""]) == [["7", "8"], []]


HEADS = "<tr><th>Month</th><th>Avg. <b>Players</b></th><th>Gain</th><th>% Gain</th><th>Peak Players</th></tr>"


def test_activity_rows_take_the_first_matching_table(spark):
    page = (
        "<table><tr><th>Month</th></tr><tr><td>no</td><td>1</td><td></td><td></td><td>2</td></tr></table>"
        f"<TABLE class='a'>{HEADS}<tr><td>Last 30 Days</td><td>1,2.5</td><td></td><td></td><td>-</td></tr>"
        "<tr><td> February&nbsp;2024 </td><td>5</td><td>+</td><td>%</td><td>1,000</td></tr><tr><td>short</td></tr></TABLE>"
        f"<table>{HEADS}<tr><td>later</td><td>1</td><td></td><td></td><td>2</td></tr></table>"
    )
    rows = apply(spark, html.activity_rows, [page, "<p>none</p>", None])
    assert [tuple(r) for r in rows[0]] == [("Last 30 Days", 12.5, None), ("February\xa02024", 5.0, 1000.0)]
    assert rows[1:] == [[], []]


def test_element_text_joins_pieces(spark):
    assert apply(spark, html.element_text, ["a <b> c </b>d", "&lt;x&gt; &amp;amp;"]) == ["a c d", "<x> &amp;"]
