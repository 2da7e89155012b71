"""Property tests: the column expressions against plain-Python statements of
the same rules, on generated values (each example is one Spark job over a
list of values)."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings, strategies as st

from ledgerlake.functions.casting import numeric_like_profile
from ledgerlake.functions.dates import parse_date_multi
from ledgerlake.specs import FLOAT_PATTERN

NULL_TOKENS = ("", "None", "null", "NULL")
PAD = st.sampled_from(["", " ", "  ", "\t", "\n"])


@st.composite
def date_texts(draw):
    """(text, expected date or None)."""
    kind = draw(st.sampled_from(["compact", "dash", "slash", "token", "bad_day", "junk"]))
    d = draw(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2099, 12, 31)))
    if kind == "compact":
        text, want = d.strftime("%Y%m%d"), d
    elif kind in ("dash", "slash"):
        sep = "-" if kind == "dash" else "/"
        month = str(d.month) if draw(st.booleans()) else f"{d.month:02d}"
        day = str(d.day) if draw(st.booleans()) else f"{d.day:02d}"
        text, want = f"{d.year:04d}{sep}{month}{sep}{day}", d
    elif kind == "token":
        text, want = draw(st.sampled_from(NULL_TOKENS)), None
    elif kind == "bad_day":
        text, want = f"{d.year:04d}{d.month:02d}{draw(st.integers(32, 99))}", None
    else:
        text, want = draw(st.text(alphabet="abcxyz:-", min_size=1, max_size=8)), None
    return draw(PAD) + text + draw(PAD), want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(date_texts(), min_size=1, max_size=40))
def test_date_parse_matches_the_rule(spark, cases):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, v string")
    got = {r.i: r.d for r in df.select("i", parse_date_multi("v").alias("d")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]


NUMBER = st.one_of(
    st.integers(-10**9, 10**9).map(str),
    st.floats(allow_nan=False, allow_infinity=False, width=32).map(lambda x: f"{x:.6g}"),
    st.sampled_from([".5", "+1.25", "-0.0", "1e3", "2E-2", "007"]),
)
NOT_NUMBER = st.sampled_from(["NaN", "inf", "1,5", "x1", "1.2.3", "--1", "1e", "."])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.one_of(st.none(), st.tuples(PAD, NUMBER, PAD).map("".join), NOT_NUMBER),
                         min_size=2, max_size=2), min_size=0, max_size=20))
def test_numeric_profile_is_all_non_null_values_match(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string")
    pattern = re.compile(FLOAT_PATTERN)

    def expected(values):
        return all(pattern.match(v.strip()) for v in values if v is not None)
    prof = {r.column_name: r.all_numeric for r in numeric_like_profile(df).collect()}
    assert prof == {"a": expected([r[0] for r in rows]), "b": expected([r[1] for r in rows])}
