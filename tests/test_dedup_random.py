"""Differential test of keep-best dedup against a direct Python statement of the rule."""

import random

from pactline.operators.dedup import keep_best


def _python_keep_best(rows, keys, order_by, descending):
    """Rows in listing order; a key's best row wins, exact ties keep the first seen.

    Null compares greater than any value; a descending column negates the
    comparison (so nulls come first there).
    """
    def compare(a, b):
        for col, desc in zip(order_by, descending):
            x, y = a[col], b[col]
            if x == y:
                continue
            result = 1 if x is None else -1 if y is None else (-1 if x < y else 1)
            return -result if desc else result
        return 0

    best = {}
    for row in rows:
        k = tuple(row[c] for c in keys)
        if k not in best or compare(row, best[k]) < 0:
            best[k] = row
    return sorted(r["source_path"] for r in best.values())


def test_keep_best_matches_the_rule_on_random_rows(spark):
    rng = random.Random(5)
    for trial in range(6):
        n = 400
        rows = [{"source_path": f"p{i:05d}",
                 "k1": rng.choice([None, "a", "b", "c"]),
                 "k2": rng.choice([None, 1, 2]),
                 "v1": rng.choice([None, 1, 2, 3]),
                 "v2": rng.choice([None, "x", "y"])} for i in range(n)]
        order_by = rng.sample(["v1", "v2"], rng.randint(0, 2))
        order_type = [rng.choice(["asc", "desc", "DESC"]) for _ in order_by]
        if order_type and rng.random() < 0.3:
            order_type = order_type[0]  # a plain string covers the first column only
        keys = rng.sample(["k1", "k2"], rng.randint(1, 2))
        listing = rows[:]
        rng.shuffle(rows)  # frame order must not matter; listing order is the path order
        df = spark.createDataFrame(rows, "source_path string, k1 string, k2 bigint, v1 bigint, v2 string")
        spec = {"enabled": True, "record_key": keys, "order_by": order_by, "order_type": order_type}
        got = sorted(r.source_path for r in keep_best(df, spec).collect())
        types = [order_type] if isinstance(order_type, str) else order_type
        descending = [i < len(types) and types[i].lower() == "desc" for i in range(len(order_by))]
        assert got == _python_keep_best(listing, keys, order_by, descending), spec
