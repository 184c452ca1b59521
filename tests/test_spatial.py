"""WKB decoded by column against the reader of single values."""

import random
import struct

import pyarrow as pa
import pytest

from siltlake.functions.spatial import columnar_wkt, wkb_to_wkt, wkb_to_wkt_value


def wkb(kind, body, little=True, srid=None):
    """WKB of nested lists of (x, y)."""
    e = "<" if little else ">"
    head = (b"" if srid is None else struct.pack("<I", srid)) + struct.pack(e + "BI", int(little), kind)

    def points(ps):
        return struct.pack(e + "I", len(ps)) + b"".join(struct.pack(e + "dd", *p) for p in ps)

    if kind == 1:
        return head + struct.pack(e + "dd", *body)
    if kind == 2:
        return head + points(body)
    if kind == 3:
        return head + struct.pack(e + "I", len(body)) + b"".join(map(points, body))
    return head + struct.pack(e + "I", len(body)) + b"".join(wkb(kind - 3, m, little) for m in body)


P, Q, R = (1.5, 2), (-3, 0.1), (1e20, -7e-9)
CASES = [  # written by hand
    (1, P, "POINT(1.5 2)"), (2, [P, Q], "LINESTRING(1.5 2,-3 0.1)"), (3, [[P, Q, P]], "POLYGON((1.5 2,-3 0.1,1.5 2))"),
    (3, [[P, Q, P], [R, Q]], "POLYGON((1.5 2,-3 0.1,1.5 2),(1e+20 -7e-09,-3 0.1))"), (4, [P, Q], "MULTIPOINT((1.5 2),(-3 0.1))"),
    (5, [[P, Q], [R]], "MULTILINESTRING((1.5 2,-3 0.1),(1e+20 -7e-09))"),
    (6, [[[P, Q]], [[Q, P, Q], [R, P]]], "MULTIPOLYGON(((1.5 2,-3 0.1)),((-3 0.1,1.5 2,-3 0.1),(1e+20 -7e-09,1.5 2)))"),
]


@pytest.mark.parametrize("little", [True, False])
@pytest.mark.parametrize("srid", [None, 4326, 0, 1])
def test_every_kind(little, srid):
    values = [wkb(k, b, little, srid) for k, b, _ in CASES]
    done, text = columnar_wkt(pa.array(values, pa.binary()))
    got = dict(zip(done.tolist(), text.to_pylist()))
    assert [got.get(i) for i in range(len(values))] == [t for _, _, t in CASES]
    assert [wkb_to_wkt_value(v) for v in values] == [t for _, _, t in CASES]


def shape(rng, kind):
    def pt():
        return rng.choice([(rng.uniform(-180, 180), rng.randint(-90, 90)), (rng.randint(-9, 9), float("nan") if rng.random() < 0.03 else 0.5), (1e300, -1e-300)])

    n = rng.choice([0, 1, 2, 5])
    return pt() if kind == 1 else [shape(rng, {2: 1, 3: 2, 4: 1, 5: 2, 6: 3}[kind]) for _ in range(n)]


def test_random_and_broken_values(spark):
    rng = random.Random(6)
    values = []
    for _ in range(3000):
        kind = rng.randint(1, 6)
        v = wkb(kind, shape(rng, kind), rng.random() < 0.5, rng.choice([None, None, 4326, 1, 16777216]))
        r = rng.random()
        if r < 0.1:
            v = v[:rng.randint(0, len(v))]
        elif r < 0.2:
            v = v + b"\x00" * rng.randint(1, 9)
        elif r < 0.3 and v:
            i = rng.randrange(len(v))
            v = v[:i] + bytes([rng.randrange(256)]) + v[i + 1:]
        values.append(v)
    collection = struct.pack("<BII", 1, 7, 2) + wkb(1, P) + wkb(2, [P, Q])
    values += [None, b"", collection, struct.pack("<BI", 1, 1001) + struct.pack("<3d", 1, 2, 3)]
    want = [wkb_to_wkt_value(v) for v in values]
    done, text = columnar_wkt(pa.array(values, pa.binary()))
    for i, t in zip(done.tolist(), text.to_pylist()):
        assert t == want[i], values[i]
    assert len(done) > 0.3 * len(values)  # the others are empty, broken or not finite
    df = spark.createDataFrame([(i, None if v is None else bytearray(v)) for i, v in enumerate(values)], "i int, b binary")
    got = [r["w"] for r in df.select("i", wkb_to_wkt("b").alias("w")).orderBy("i").collect()]
    assert got == want and want[-2:] == ["GEOMETRYCOLLECTION(POINT(1.5 2),LINESTRING(1.5 2,-3 0.1))", "POINT(1 2 3)"]


def test_slices_of_a_column():
    values = pa.array([wkb(k, b) for k, b, _ in CASES], pa.binary()).slice(2, 3)
    done, text = columnar_wkt(values)
    assert dict(zip(done.tolist(), text.to_pylist())) == {i: CASES[2 + i][2] for i in range(3)}
