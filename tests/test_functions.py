"""Column helpers against Python's decimal arithmetic (property tests)."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from chargeline.functions.columns import html_escape, money, number_text, title_case

# amounts with up to four decimals, including exact half-way cases
amounts = st.builds(lambda units, scale: units / 10 ** scale,
                    st.integers(min_value=-10 ** 9, max_value=10 ** 9), st.integers(min_value=0, max_value=4))


def py_money(x: float, places: int = 2) -> Decimal:
    return Decimal(repr(x)).quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


@settings(max_examples=5, deadline=None)
@given(st.lists(amounts, min_size=1, max_size=200))
def test_money_is_half_up_on_decimal_text(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", money("x").alias("m"), number_text("x").alias("t")).collect()
    for r in rows:
        expected = py_money(r.x)
        assert r.m == expected
        text = format(expected, "f")
        if "." in text:
            text = text.rstrip("0").rstrip(".")
        assert r.t == ("0" if text in ("-0", "") else text) or Decimal(r.t) == expected


def test_title_case_and_escape(spark):
    df = spark.createDataFrame([("urban",), ("RURAL",), ("a<b & 'c'",), (None,)], "s string")
    rows = df.select(title_case("s").alias("t"), html_escape("s").alias("e")).collect()
    assert [r.t for r in rows] == ["Urban", "Rural", "A<b & 'c'", None]
    assert rows[2].e == "a&lt;b &amp; &#39;c&#39;"
