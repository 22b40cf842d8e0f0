"""Product codes against whole-number Python, and the exactness of limb-split products."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import codes


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    good = []
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(scale * float(x)) for x in v], label))
    if not good:
        return []
    size = -(-max(len(v) for _, v, _ in good) // parts)
    good = [(i, v, v + [0] * (parts * size - len(v)), label) for i, v, label in good]
    first = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    cut = lambda v: [tuple(v[p * size : (p + 1) * size]) for p in range(parts)]
    books = [list(b) for b in zip(*[cut(v) for _, _, v, _ in first])]

    def assign(v):
        out = []
        for p, x in enumerate(cut(v)):
            d, c = min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(books[p]))
            out.append((c, d))
        return out

    for _ in range(rounds):
        met = [[[] for _ in b] for b in books]
        for _, _, v, _ in good:
            for p, ((c, _), x) in enumerate(zip(assign(v), cut(v))):
                met[p][c].append(x)
        books = [[tuple(sum(col) // len(m) for col in zip(*m)) if m else e for e, m in zip(b, ms)] for b, ms in zip(books, met)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = [(i, "".join(f"{c:02x}" for c, _ in a), sum(d for _, d in a), label) for i, _, v, label in good for a in [assign(v)]]
    totals = {}
    for r in out:
        totals[r[3]] = totals.get(r[3], 0) + r[2]
    return sorted(((i, c, e, totals[label], digest) for i, c, e, label in out), key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit("x") for c in ("id", "v", "most", "of", "code", "error")})
    return sorted(map(tuple, codes.compress(df, **options).collect()), key=repr)


def vectors(n, d, seed=1, scale=1.0):
    rng = random.Random(seed)
    return [(i, [float(np.float32(rng.gauss(0, 1) * scale)) for _ in range(d)], rng.choice([None, 0, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("d,scale,options", [(64, 1.0, {}), (24, 3000.0, {}), (12, 0.001, {"parts": 5, "entries": 3, "rounds": 2})])
def test_against_python_integers(spark, d, scale, options):
    rows = vectors(150, d, scale=scale)
    rows += [(400 + i, rows[3][1], 1) for i in range(40)]  # ties, copies
    assert run(spark, rows, **options) == brute(rows, **options)


def test_odd_rows(spark):
    rows = vectors(30, 8) + [(50, None, 1), (51, [1.0, None], 1), (52, [float("nan")] * 8, 1), (53, [float("-inf")], None), (None, [2.0] * 8, None), (2, [0.5] * 8, 2)]
    rows += [(60, [1.0, 2.0], 0), (61, [], 0), (62, [1.0] * 11, 0), (0, [-1.0] * 8, 9), (0, [-1.0] * 8, 9)]
    assert run(spark, rows) == brute(rows)


def test_few_rows_and_none(spark):
    rows = vectors(3, 8)
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, [(1, None, 1)]) == []
    assert run(spark, [(5, [], None)]) == brute([(5, [], None)])


def test_components_beyond_long_errors_take_no_part(spark):
    rows = vectors(20, 8)
    assert run(spark, [*rows, (99, [3.0e38] * 8, 1), (98, [1.0e10] * 8, 1)]) == brute(rows)


@pytest.mark.parametrize("bits", [3, 20, 29, 40])
def test_products_are_exact(bits):
    rng = np.random.default_rng(bits)
    a = rng.integers(-(1 << bits), 1 << bits, (50, 8))
    b = rng.integers(-(1 << (60 - bits) // 2), 1 << (60 - bits) // 2, (9, 8))
    a[0], a[1], b[0] = -(1 << bits), (1 << bits) - 1, -(1 << (60 - bits) // 2)
    want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
    assert codes.exact_products(a, b).tolist() == want


@pytest.mark.parametrize("width", [1, 7, 8, 64, 1000])
def test_limb_products_stay_below_two_to_53(width):
    most = (1 << codes.limb_bits(width)) - 1
    assert width * (most + 1) ** 2 < 1 << 53
    assert width * (2 * codes.component_limit(width)) ** 2 < 1 << 63


def test_several_limbs_are_needed_and_used():
    values = np.array([-(1 << 40), (1 << 40) - 1, 5, -1, 0])
    limbs = codes._limbs(values, 20)
    assert len(limbs) > 1 and sum(x.astype(object) * (1 << (20 * i)) for i, x in enumerate(limbs)).tolist() == values.tolist()
