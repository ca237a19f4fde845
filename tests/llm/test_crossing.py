"""A pair that agrees by chance in an earlier tree's sketch is not lost."""

from __future__ import annotations

import numpy as np

from cadence.llm import forest


def test_chance_agreement_in_an_earlier_tree(spark):
    rnd = np.random.default_rng(1)
    one = rnd.integers(0, 1 << 32, forest.HASHES, dtype=np.uint64).astype(">u4")
    two = one.copy()
    two[0] ^= 1 << 20  # tree 0: the last bytes agree, the hash does not
    assert (one[4:8] == two[4:8]).all()
    sig = [bytearray(x.tobytes()) for x in (one, two)]
    sketch = [bytearray(x[3::4]) for x in sig]
    rows = [(9, 1, k + 1, 100, sketch[k], sig[k], k + 1, role, False, 0) for k in (0, 1) for role in (0, 1)]
    schema = "key long, t int, node long, size long, sketch binary, sig binary, comp long, role int, crowded boolean, main long"
    got = forest.crossing(spark.createDataFrame(rows, schema), 85).collect()
    assert [(r.key, r.x, list(r.ys)) for r in got] == [(9, 1, [2])]
    later = [(r[0], 2, *r[2:]) for r in rows]  # also together in tree 2: reported in tree 1 already
    assert forest.crossing(spark.createDataFrame(later, schema), 85).count() == 0
