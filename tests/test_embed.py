"""The nearest heading in blocks against all pairs."""

import math
import random

import numpy as np

from pagewright.operators import embed

KIND = "grp int, {0}_id long, {1} array<float>"


def test_nearest_heading_in_blocks(spark, monkeypatch):
    """more blocks than one a group; copies, ties, vectors of no length, of another length and with nulls."""
    monkeypatch.setattr(embed, "BLOCK", 8)
    rng = random.Random(4)
    rows = [(k % 3, k, [float(rng.randrange(-2, 3)) for _ in range(3)]) for k in range(150)] + [(1, 200 + k, [1.0, 2.0]) for k in range(3)]
    rows += [(5, 301, [0.0, 0.0]), (5, 302, [0.0, 0.0]), (5, 303, [1.0, 0.0]), (6, 401, [1.0, 1.0]), (7, 501, [1.0, None]), (7, 502, None), (7, 503, [1.0, 1.0]), (None, 601, [1.0]), (None, 602, [1.0])]

    def cosine(a, b):
        if a is None or b is None or len(a) != len(b) or None in a + b or not any(a) or not any(b):
            return None
        return sum(x * y for x, y in zip(a, b, strict=True)) / (math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b)))

    expected = {}
    for g, i, a in rows:
        best = max(((s is not None, round(s or 0, 9), -j, s) for h, j, b in rows if g is not None and h == g and i != j for s in [cosine(a, b)]), default=None, key=lambda x: x[:3])
        if best:
            expected[i] = (-best[2], None if best[3] is None else round(best[3], 5))
    df = spark.createDataFrame(rows, KIND.format("entry", "e"))
    got = embed.nearest_heading(df, df.withColumnsRenamed({"entry_id": "heading_id", "e": "h"})).collect()
    assert {r.entry_id: (r.heading_id, r.similarity) for r in got} == expected and len(got) == len(expected)


def test_copies_stay_few():
    """ten thousand equal headings leave one row an entry."""
    x, y = np.ones((3, 4)), np.ones((10_000, 4))
    got = list(embed._best_of_block(x, np.arange(3), y, np.arange(10_000)))
    assert [(int(a), int(b), float(s)) for i, j, v in got for a, b, s in zip(i, j, v, strict=True)] == [(0, 1, 1.0), (1, 0, 1.0), (2, 0, 1.0)]
