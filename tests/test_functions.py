import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from sparkseries.functions import numeric, payload, text, times


def apply(spark, values, schema, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {schema}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_round_value(spark):
    values = [0.0, None, -1.23456789, 9e-7, 1e-6, 2.5e-6, 1.23456e-8, math.inf, 2.0000004]
    assert apply(spark, values, "DOUBLE", numeric.round_value) == [
        0.0, None, -1.234568, 9e-7, 1e-6, 3e-6, 1.2e-8, math.inf, 2.0,
    ]
    assert math.isnan(apply(spark, [math.nan], "DOUBLE", numeric.round_value)[0])


def test_scaling_golden_values(spark):
    assert apply(spark, [123.456], "DOUBLE", numeric.wei_scale) == [123456000000000000000]
    rates = [5.594541, 5.593205, 5.59332, 5.592133, 5.59208]
    assert apply(spark, rates, "DOUBLE", numeric.wei_scale) == [
        5594541000000000000, 5593205000000000000, 5593320000000000000, 5592133000000000000, 5592080000000000000,
    ]


@pytest.mark.parametrize("value", [98765.4321, 1 / 3, -7.25, 3.3e19, 1e-19])
def test_scaling_is_exact_in_binary(spark, value):
    assert apply(spark, [value], "DOUBLE", numeric.wei_scale) == [int(value * 10**18)]


def test_scaling_out_of_range_is_an_error(spark):
    assert apply(spark, [None, float("nan"), 9.9e19, -5e19], "DOUBLE", numeric.wei_scale) == [None, None, int(9.9e19 * 1e18), int(-5e19 * 1e18)]
    for value in (1e21, float("inf")):
        with pytest.raises(Exception, match="too large to scale"):
            apply(spark, [value], "DOUBLE", numeric.wei_scale)


@pytest.mark.parametrize("value", [1.23456e-32, 9.9999e-31, 1e-30, 1e-33, 1.0000001e-33, -7.65432109e-200, 5e-324, 3.33333e-308])
def test_rounding_has_no_last_level(spark, value):
    scale = 6
    while abs(value) <= 10.0**-scale and scale < 330:
        scale += 3
    assert apply(spark, [value], "DOUBLE", numeric.round_value) == [float(f"{value:.{scale}f}")]


def test_fixed_point(spark):
    units = apply(spark, [1.0000004, 2.5, -0.000001], "DOUBLE", numeric.fixed_point_encode)
    assert units == [1000000, 2500000, -1]
    assert apply(spark, units, "BIGINT", numeric.fixed_point_decode) == [1.0, 2.5, -0.000001]


def test_prices_and_slots(spark):
    assert apply(spark, ["$12.50/day", "-3", "n/a", None], "STRING", numeric.price_number) == [12.5, -3.0, None, None]
    assert apply(spark, ["1,5", "x"], "STRING", numeric.decimal_comma) == [1.5, None]
    assert apply(spark, ["0", "-13", "120", "47abc"], "STRING", numeric.round_slot) == [0, 3, 0, 7]


def test_key_uuid_is_repeatable_and_36_long(spark):
    one, two = apply(spark, ["a", "b"], "STRING", numeric.key_uuid)
    assert len(one) == 36 and one != two
    assert apply(spark, ["a"], "STRING", numeric.key_uuid) == [one]


def test_durations(spark):
    values = [0.0, 59.5, 60.0, 3600.0, 90061.25, 172800.0, 10.0]
    assert apply(spark, values, "DOUBLE", times.duration_text) == [
        "", "59.5 seconds", "1 minutes", "1 hours", "1 days, 1 hours, 1 minutes, 1.25 seconds", "2 days", "10 seconds",
    ]


def test_epoch_conversions(spark):
    moment = dt.datetime(2024, 5, 4, 9, 2, 20, 123457)
    nanos = apply(spark, [moment], "TIMESTAMP_NTZ", times.to_epoch_nanos)
    assert nanos == [1714813340123457000]
    assert apply(spark, nanos, "BIGINT", times.from_epoch_nanos) == [moment]
    assert apply(spark, [moment], "TIMESTAMP_NTZ", times.to_epoch_millis) == [1714813340123]
    assert apply(spark, [1714813340000], "BIGINT", times.human_time) == ["2024-05-04 09:02:20"]


def test_next_boundary_is_strictly_later(spark):
    values = [dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 10, 9, 59)]
    assert apply(spark, values, "TIMESTAMP_NTZ", times.next_boundary) == [dt.datetime(2024, 1, 1, 10, 10)] * 2


def test_end_of_day_and_clamp(spark):
    assert apply(spark, [dt.date(2024, 2, 29)], "DATE", times.end_of_day) == [dt.datetime(2024, 2, 29, 23, 59, 59)]
    values = [dt.datetime(2024, 1, 2), dt.datetime(2023, 1, 1), None]
    assert apply(spark, values, "TIMESTAMP_NTZ", lambda c: times.clamp_future(c, "2024-01-01")) == [
        dt.datetime(2024, 1, 1), dt.datetime(2023, 1, 1), None,
    ]


def test_partial_dates(spark):
    assert apply(spark, ["2020", "2020-03", "2020-03-04", "x"], "STRING", times.partial_date) == [
        dt.date(2020, 1, 1), dt.date(2020, 3, 1), dt.date(2020, 3, 4), None,
    ]


def test_last_weekday(spark):
    # Monday, Tuesday, Saturday, Sunday
    days = [dt.date(2024, 3, 4), dt.date(2024, 3, 5), dt.date(2024, 3, 9), dt.date(2024, 3, 10)]
    assert apply(spark, days, "DATE", times.last_weekday) == [
        dt.date(2024, 3, 1), dt.date(2024, 3, 1), dt.date(2024, 3, 7), dt.date(2024, 3, 8),
    ]


def test_iso_week_over_year_end(spark):
    other = F.lit("2025-01-01").cast("date")
    days = [dt.date(2024, 12, 30), dt.date(2024, 12, 29)]
    assert apply(spark, days, "DATE", lambda c: times.same_iso_week(c, other)) == [True, False]


def test_names(spark):
    assert apply(spark, ["a_b_c_d", "a_b", "a"], "STRING", text.category_of) == ["a_b", "a_b", "a"]
    assert apply(spark, ["a_b_c_d", "a_b", "a"], "STRING", text.name_of) == ["c_d", "", ""]
    assert apply(spark, ["x:y"], "STRING", text.composite_split) == [["x", "y"]]
    with pytest.raises(Exception, match="expected 2 parts"):
        apply(spark, ["x:y:z"], "STRING", text.composite_split)


def test_owner_is_optional(spark):
    assert [tuple(r) for r in apply(spark, ["me@db", "db"], "STRING", text.owner_and_db)] == [("me", "db"), (None, "db")]


def test_key_value_lines(spark):
    assert apply(spark, ["Version:  0.6.3\nGit commit: abc\nnothing"], "STRING", text.key_value_lines) == [
        {"Version": "0.6.3", "Git commit": "abc"}
    ]


def test_left_justify_keeps_long_text(spark):
    assert apply(spark, ["ab", "abcdef"], "STRING", lambda c: text.left_justify(c, 4)) == ["ab  ", "abcdef"]


def test_observations(spark):
    body = ('{"CompactData":{"DataSet":{"Series":{"Obs":[{"@TIME_PERIOD":"2020-01","@OBS_VALUE":"1.5"},'
            '{"@TIME_PERIOD":"2020-02","@OBS_VALUE":"n/a"}]}}}}')
    points = apply(spark, [body], "STRING", payload.observation_points)[0]
    assert [tuple(p) for p in points] == [(dt.date(2020, 1, 1), 1.5), (dt.date(2020, 2, 1), None)]


def test_chart_points(spark):
    points = apply(spark, ['{"data":[[0,1,2,3,4.5],[86400000,1,2,3,5]]}'], "STRING", payload.chart_points)[0]
    assert [tuple(p) for p in points] == [(dt.datetime(1970, 1, 1), 4.5), (dt.datetime(1970, 1, 2), 5.0)]
    with pytest.raises(Exception, match="no data"):
        apply(spark, ['{"other":1}'], "STRING", payload.chart_points)


def test_indicator_points(spark):
    body = '[{"page":1},[{"date":"2021","value":2.5},{"date":"2020","value":null}]]'
    points = apply(spark, [body], "STRING", payload.indicator_points)[0]
    assert [tuple(p) for p in points] == [(dt.date(2021, 1, 1), 2.5), (dt.date(2020, 1, 1), None)]
    for bad in ('[{"page":1},[]]', '[{"page":1}]'):
        with pytest.raises(Exception, match="no rows"):
            apply(spark, [bad], "STRING", payload.indicator_points)


def test_html_table(spark):
    html = ('<table class="prices"><tr><td class="name"> Economy </td><td class="price">$12.5</td></tr>'
            '<tr><td class="name">Van</td><td class="price">n/a</td></tr></table>')
    rows = apply(
        spark, [html], "STRING",
        lambda c: payload.table_rows(c, r"(?s)<tr>.*?</tr>", {"name": r'class="name">([^<]*)<', "price": r'class="price">([^<]*)<'}),
    )[0]
    assert [tuple(r) for r in rows] == [("Economy", "$12.5"), ("Van", "n/a")]


def test_first_round_only(spark):
    df = spark.createDataFrame([(1, '{"7":{"Denver":{"Economy":1.0}},"8":{"Denver":{"Economy":2.0}}}')], "id INT, p STRING")
    assert [tuple(r) for r in payload.explode_rounds(df, "p").collect()] == [(1, "7", "Denver", "Economy", 1.0)]
    assert payload.explode_rounds(df, "p", first_only=False).count() == 2
