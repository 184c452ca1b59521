"""Property: loading never fails, whatever text arrives, and nothing is lost silently."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltlake import spec as S
from siltlake.operators import normalize as N

KINDS = [
    S.ColumnSpec("c_tinyint", "tinyint"), S.ColumnSpec("c_uint", "int", unsigned=True),
    S.ColumnSpec("c_bigint_u", "bigint", unsigned=True), S.ColumnSpec("c_bit", "bit", length=7),
    S.ColumnSpec("c_dec", "decimal", precision=6, scale=2), S.ColumnSpec("c_double", "double"),
    S.ColumnSpec("c_bool", "bool"), S.ColumnSpec("c_date", "date"), S.ColumnSpec("c_dt", "datetime"),
    S.ColumnSpec("c_ts", "timestamp"), S.ColumnSpec("c_time", "time"), S.ColumnSpec("c_year", "year"),
    S.ColumnSpec("c_set", "set", members=("a", "b")), S.ColumnSpec("c_text", "varchar", length=3),
]
SPEC = S.TableSpec("fuzz", tuple(KINDS))

values = st.one_of(
    st.none(),
    st.text(max_size=12),
    st.integers(min_value=-2 ** 70, max_value=2 ** 70).map(str),
    st.floats(allow_nan=True, allow_infinity=True).map(str),
    st.sampled_from(["0000-00-00", "0000-00-00 00:00:00", "2024-02-30", "2024-01-05 10:00:00", "838:59:59",
                     "-12:00:00.5", "1e400", "  7 ", "true", "NULL", "", "12.0", "18446744073709551615"]),
)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.too_slow, HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[values] * len(KINDS)), min_size=1, max_size=40))
def test_loosen_never_fails_and_accounts_for_every_value(spark, rows):
    df = spark.createDataFrame(rows, ", ".join(f"{c.name} string" for c in KINDS))
    # raw copies are not declared, so they ride through loosen untouched
    df = df.select("*", *[F.col(c.name).alias(f"raw_{c.name}") for c in KINDS])
    out = N.loosen(df, SPEC)
    out.write.format("noop").mode("overwrite").save()  # the whole projection runs: must not raise
    # row by row: a non-null raw value is typed, a zero date, or in _rescued
    unaccounted = []
    for c in KINDS:
        raw = F.col(f"raw_{c.name}")
        zero = F.trim(raw).startswith("0000-00-00") if c.kind in ("date", "datetime", "timestamp") else F.lit(False)
        unaccounted.append(raw.isNotNull() & F.col(c.name).isNull() & ~zero
                           & ~F.map_contains_key("_rescued", c.name))
    # ... and what is rescued is exactly the raw text
    wrong = [F.map_contains_key("_rescued", c.name) & (F.col("_rescued")[c.name] != F.col(f"raw_{c.name}"))
             for c in KINDS]
    flags = out.select(*[F.max(x.cast("int")).alias(f"u_{c.name}") for x, c in zip(unaccounted, KINDS)],
                       *[F.max(x.cast("int")).alias(f"w_{c.name}") for x, c in zip(wrong, KINDS)]).first()
    assert not any(flags), {k: v for k, v in flags.asDict().items() if v}
