import pytest
from pyspark.sql import functions as F

from daybook.functions import text

YES_NO = {
    "Y": True, "y": True, "YES": True, "TRUE": True, " true ": True, "1": True, "\tyes\n": True,
    "N": False, "NO": False, "FALSE": False, "maybe": False, "": False, None: None,
}
AIRBAG = {
    "DEPLOYED": True, "DePLOYED": True, "DID not DEPLOY": False, "DEPLOYMENT UNKNOWN": None,
    "NOT APPLICABLE": None, "NOT DEPLOYED": True, "": None, None: None,
}
BANDS = {
    "OVER $1,500": (1500, None, 1500),
    "over $1500": (1500, None, 1500),
    "$501 - $1,500": (501, 1500, 1000),
    "$501 - $1500": (501, 1500, 1000),
    "501 - 1500": (501, 1500, 1000),
    "$501  -  $1,500": (501, 1500, 1000),
    " $500 or less ": (1, 500, 250),
    "$500": (500, 500, 500),
    "UNKNOWN FORMAT": (None, None, None),
    "": (None, None, None),
    None: (None, None, None),
    "OVER": (None, None, None),
    "OR LESS": (None, None, None),
    "5 -": (None, None, None),
    "- 5": (None, None, None),
    "$9,999,999,999": (9999999999, 9999999999, None),
    "OVER 99999999999999999999": (None, None, None),
    "9223372036854775807 - 9223372036854775807": (2**63 - 1, 2**63 - 1, None),
}
UNREADABLE = {
    "OVER", "OR LESS", "5 -", "- 5", "$9,999,999,999", "OVER 99999999999999999999",
    "9223372036854775807 - 9223372036854775807",
}


def applied(spark, values, **columns):
    rows = spark.createDataFrame([(v,) for v in values], "x string")
    return {r["x"]: r for r in rows.select("x", *[c.alias(n) for n, c in columns.items()]).collect()}


def test_yes_no(spark):
    got = applied(spark, YES_NO, flag=text.yes_no(F.col("x")))
    assert {x: r["flag"] for x, r in got.items()} == YES_NO


def test_airbag_state(spark):
    got = applied(spark, AIRBAG, flag=text.airbag_state(F.col("x")))
    assert {x: r["flag"] for x, r in got.items()} == AIRBAG


def test_amounts(spark):
    x = F.col("x")
    got = applied(
        spark,
        BANDS,
        band=text.amount_band(x),
        estimate=text.amount_estimate(x),
        bad=text.amount_unreadable(x),
    )
    assert {v: (*r["band"], r["estimate"]) for v, r in got.items()} == BANDS
    assert {v for v, r in got.items() if r["bad"]} == UNREADABLE


@pytest.mark.parametrize(
    ("value", "number", "filled"),
    [("", None, False), (None, None, False), ("0.12", 0.12, True), ("n/a", None, True)],
)
def test_number_and_filled(spark, value, number, filled):
    x = F.col("x")
    got = applied(spark, [value], number=text.number_or_null(x), filled=text.filled(x))[value]
    assert (got["number"], got["filled"]) == (number, filled)
