import random

from revlens.operators.grouping import greedy_chunks, reviews_per_product


def brute_chunks(texts, limit):
    """Greedy rule, element by element: append while the running character
    sum stays within ``limit``, else close the chunk (possibly empty) and
    start a new one holding the current text."""
    out, cur, total = [], [], 0
    for t in texts:
        total += len(t)
        if total <= limit:
            cur.append(t)
        else:
            out.append(cur)
            cur, total = [t], len(t)
    if cur:
        out.append(cur)
    return [(i, len(c), " ".join(c)) for i, c in enumerate(out)]


def test_greedy_chunks_match_brute_force(spark):
    rng = random.Random(5)
    rows, expected = [], []
    limit = 50
    for p in range(6):
        n = rng.randint(1, 40)
        lens = [rng.choice([0, 1, 5, 20, 30, 49, 50, 51, 120]) for _ in range(n)]
        if p == 0:
            lens[0] = 75          # first review longer than the limit -> empty chunk 0
        texts = ["x" * k for k in lens]
        for i, t in enumerate(texts):
            rows.append((f"P{p}", i * 3 + 1, t))
        expected += [(f"P{p}", *c) for c in brute_chunks(texts, limit)]
    df = spark.createDataFrame(rows, "asin string, review_id long, review_text string")
    got = sorted((r.asin, r.chunk, r.n_reviews, r.text) for r in greedy_chunks(df, limit).collect())
    assert got == sorted(expected)
    for R in (1, 2, 3, 7, 1000):   # blocks smaller than, around and larger than a chunk
        got = sorted((r.asin, r.chunk, r.n_reviews, r.text) for r in greedy_chunks(df, limit, block_reviews=R).collect())
        assert got == sorted(expected), R


def test_reviews_per_product_positions(spark):
    df = spark.createDataFrame([("A", 5, "x"), ("A", 2, "y"), ("B", 9, None), ("B", 1, "z")],
                               "asin string, review_id long, review_text string")
    got = sorted(tuple(r) for r in reviews_per_product(df).collect())
    assert got == [("A", 1, 2, "y"), ("A", 2, 5, "x"), ("B", 1, 1, "z")]


def test_worker_functions_ship_by_value(tmp_path):
    """Python-worker code must not need this package on the worker's path:
    the kernels are closures and are pickled by value."""
    import subprocess
    import sys

    import numpy as np
    import pandas as pd
    from pyspark import cloudpickle

    from revlens.operators.grouping import _kernels
    from revlens.operators.models import bag_model
    from revlens.operators.products import _block_topk

    exits, starts = _kernels()
    fns = {"exits": exits, "starts": starts, "topk": _block_topk(2), "bag": bag_model(np.zeros((9, 3)))}
    p = tmp_path / "fns.pkl"
    p.write_bytes(cloudpickle.dumps(fns))
    code = f"""
import sys
sys.path = [x for x in sys.path if 'repo' not in x]
import pandas as pd, numpy as np
from pyspark import cloudpickle
f = cloudpickle.loads(open({str(p)!r}, 'rb').read())
df = pd.DataFrame({{'prod': ['A'] * 3, 's': [1, 2, 3], 'nxt': [3, 4, 4], 'is_entry': [True, False, False],
                   'entry': [True, False, False]}})
print(len(f['exits'](df)), len(f['starts'](df)), f['bag']()(np.array([[5, 6, 0]])).tolist())
"""
    out = subprocess.run([sys.executable, "-c", code], cwd="/tmp", capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.split()[:2] == ["1", "2"]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), min_size=1, max_size=30), min_size=1, max_size=4),
       st.integers(1, 50), st.sampled_from([1, 2, 5, 64]))
def test_greedy_chunks_property(spark, products, limit, block):
    rows, expected = [], []
    for p, lens in enumerate(products):
        texts = ["z" * k for k in lens]
        rows += [(f"Q{p}", i + 1, t) for i, t in enumerate(texts)]
        expected += [(f"Q{p}", *c) for c in brute_chunks(texts, limit)]
    df = spark.createDataFrame(rows, "asin string, review_id long, review_text string")
    got = sorted((r.asin, r.chunk, r.n_reviews, r.text)
                 for r in greedy_chunks(df, limit, block_reviews=block).collect())
    assert got == sorted(expected)
