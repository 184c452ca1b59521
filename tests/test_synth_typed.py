"""Generated rows over whole declared ranges."""

import pytest
from pyspark.sql import functions as F

from siltlake import spec as S
from siltlake.operators.synth_typed import synth_typed
from siltlake.plans.q_synth import TYPED_SPEC


def spec_of(*columns, **more):
    return S.TableSpec("t", (S.ColumnSpec("id", "bigint", nullable=False), *columns), primary_key=(S.KeyPart("id"),), **more)


EVERY = [S.ColumnSpec(f"c{i}_{int(u)}_{int(null)}", k, unsigned=u, nullable=null) for i, k in enumerate(S.SIGNED_RANGE) for u in (False, True) for null in (False, True)]
EVERY += [S.ColumnSpec(f"b{n}", "bit", length=n, nullable=False) for n in (1, 5, 16, 63, 64)]
EVERY += [S.ColumnSpec(f"d{p}_{s}", "decimal", precision=p, scale=s) for p, s in ((5, 2), (38, 0), (38, 38), (10, 10))]
EVERY += [S.ColumnSpec(k, k, nullable=n) for k in ("float", "double", "bool", "date", "datetime", "timestamp", "time", "year", "text", "blob") for n in (True,)]
EVERY += [S.ColumnSpec("v", "varchar", length=20, nullable=False), S.ColumnSpec("bin", "binary", length=9, nullable=False),
          S.ColumnSpec("e", "enum", members=("x", "it's"), nullable=False), S.ColumnSpec("s", "set", members=("p", "q"), nullable=False)]


def test_schema_is_that_of_the_spec(spark):
    for spec in (TYPED_SPEC, spec_of(*EVERY)):
        rows = synth_typed(spark.range(300), spec, seed=3)
        assert rows.schema == S.struct_type(spec)
        held = rows.agg(*[F.count(c.name) for c in spec.columns]).first()
        assert all(n == 300 if not c.nullable else 200 < n < 300 for n, c in zip(held, spec.columns))


def test_ranges_are_reached_and_kept(spark):
    numbers = [c for c in EVERY if c.kind in S.SIGNED_RANGE or c.kind == "bit"]
    rows = synth_typed(spark.range(4000), spec_of(*numbers), seed=1)
    found = rows.agg(*[f(c.name).alias(f"{n}_{c.name}") for c in numbers for n, f in (("low", F.min), ("high", F.max))],
                     *[F.approx_count_distinct(c.name).alias(f"n_{c.name}") for c in numbers]).first()
    for c in numbers:
        low, high = (0, (1 << c.length) - 1) if c.kind == "bit" else (0, S.UNSIGNED_MAX[c.kind]) if c.unsigned else S.SIGNED_RANGE[c.kind]
        assert (int(found[f"low_{c.name}"]), int(found[f"high_{c.name}"])) == (low, high), c.name
        assert found[f"n_{c.name}"] > 0.8 * min(high - low + 1, 3000), c.name


def test_same_rows_at_any_parallelism_and_keys_of_the_parent(spark):
    parents = {"customer": (100, 7)}
    one = synth_typed(spark.range(0, 500, 1, 1), TYPED_SPEC, seed=9, parents=parents)
    many = synth_typed(spark.range(0, 500, 1, 13), TYPED_SPEC, seed=9, parents=parents)
    text = lambda df: sorted(map(str, df.collect()))
    assert text(one) == text(many) != text(synth_typed(spark.range(500), TYPED_SPEC, seed=8, parents=parents))
    assert {r[0] for r in one.select("device").distinct().collect()} == set(range(100, 107))
    assert synth_typed(spark.range(0), TYPED_SPEC).collect() == []


def test_a_type_without_a_generator_is_an_error(spark):
    with pytest.raises(ValueError):
        synth_typed(spark.range(1), spec_of(S.ColumnSpec("p", "point")))
