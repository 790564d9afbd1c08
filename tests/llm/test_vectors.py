"""Vector codes against plain integer arithmetic."""

import hashlib
import math
import random

import numpy as np

from climark.llm import vector_codes
from climark.llm.common import share_join, stored
from climark.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def brute(rows, parts=4, entries=256, rounds=4):
    """rows of (id, vector, label), valid and of one length, in the order of the codebooks' start."""
    ints = [[math.floor(1024 * x) for x in v] for _, v, _ in rows]
    cut = [len(ints[0]) * p // parts for p in range(parts + 1)]
    books = [[v[a:b] for v in ints[:entries]] for a, b in zip(cut, cut[1:])]

    def nearest(p, v):
        own = v[cut[p]:cut[p + 1]]
        return min((sum((x - y) ** 2 for x, y in zip(own, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for v in ints:
                held.setdefault(nearest(p, v)[1], []).append(v[cut[p]:cut[p + 1]])
            for k, members in held.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members)]
    found = [[nearest(p, v) for p in range(parts)] for v in ints]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, label), e in zip(rows, errors):
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted((i, "".join(f"{k:02x}" for _, k in f), e, by_label[label], digest)
                  for (i, _, label), f, e in zip(rows, found, errors))


def compressed(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = vector_codes.compress(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    return sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0] is None, r))


def test_small_vectors_match_plain_integers(spark):
    rng = random.Random(3)
    rows = [(k, [rng.choice((-1.0, 0.0, 0.25, rng.gauss(0, .1))) for _ in range(8)], rng.choice((1, 2, None)))
            for k in range(420)]
    rows += [(k, rows[k % 3][1], 1) for k in range(420, 500)]          # many equal vectors
    bad = [(-1, None, 1), (-2, [float("nan")] * 8, 1), (-3, [None] + [.1] * 7, 2), (-4, [float("-inf")] + [.1] * 7, 1)]
    short = [(900, [.5] * 4, 1), (901, [], 1)]
    mixed = rows + bad + short
    rng.shuffle(mixed)
    assert compressed(spark, mixed) == brute(rows)


def test_large_components_and_uneven_parts(spark):
    rng = random.Random(4)
    for size in (1e3, 1e6, 1e9):
        rows = [(k, [rng.uniform(-size, size) for _ in range(7)], k % 2) for k in range(5)] + \
               [(k, [rng.uniform(-1, 1) for _ in range(7)], 3) for k in range(5, 12)]
        assert compressed(spark, rows) == brute(rows)
    out = compressed(spark, [(k, [1e300 * (-1) ** k, 0.0, 0.0, 0.0], 1) for k in range(300)])
    assert len(out) == 300 and all(0 <= r[2] < 2 ** 63 for r in out)
    far = [[x] + [0.0] * 3 for x in (3e12, -3e12)]
    books = vector_codes.Codebooks(np.zeros((1, 4), np.int64))
    best, least = vector_codes.Block.of(vector_codes.integers(
        __import__("pyarrow").array(far), 4)).nearest(books)
    assert best.tolist() == [[0, 0]] * 4 and list(least[0]) == [math.floor(3e12 * 1024) ** 2] * 2


def test_repeated_and_null_ids_and_no_components(spark):
    rows = [(1, [.1, .2, .3, .4], 1), (1, [.1, .2, .3, .4], 1), (2, [.0, .2, .3, .4], None)]
    out = compressed(spark, rows + [(None, [.5, .5, .5, .5], None)])
    assert [r[0] for r in out] == [1, 1, 2, None]
    want = brute(rows + [(9, [.5, .5, .5, .5], None)])
    assert [r[1:] for r in out] == [r[1:] for r in want]
    out = compressed(spark, [(1, [], 1), (2, [], 1)])
    assert [r[:4] for r in out] == [(1, "00000000", 0, 0), (2, "00000000", 0, 0)]


def test_empty_table_and_further_columns(spark):
    schema = "vec_id long, embedding array<float>, label int, CODE string, error string, `a.b` int"
    empty = vector_codes.compress(spark.createDataFrame([], schema))
    assert empty.columns == ["vec_id", "label", "a.b", "code", "error", "label_error", "codebooks_sha256"]
    assert empty.count() == 0
    assert vector_codes.compress(spark.createDataFrame([(1, None, 1, "", "", 2)], schema)).count() == 0
    row = vector_codes.compress(spark.createDataFrame([(1, [.5] * 4, 1, "x", "y", 2)], schema)).first()
    assert (row.code, row.error, row.label_error, row["a.b"]) == ("00000000", 0, 0, 2)


def test_blocks_of_any_size_give_the_same_codes(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(k, [rng.gauss(0, .2) for _ in range(8)], k % 5) for k in range(600)]
    want = compressed(spark, rows)
    monkeypatch.setattr(vector_codes, "BLOCK_VALUES", 64)
    assert compressed(spark, rows) == want


def test_share_join_splits_heavy_and_light_keys(spark):
    rows = spark.range(5000).selectExpr("id", "case when id % 3 = 0 then null when id % 3 = 1 then 1 else id end as k")
    facts = stored(rows.groupBy(rows.k.alias("own")).count(), "facts")
    out = share_join(rows, facts, [("k", "own")], "count", limit=4)
    assert out.count() == 5000 and out.where("k is null and count = 1667").count() == 1667
    assert out.where("k <=> own").count() == 5000


def test_query_matches_plain_integers(spark):
    rows = sorted((r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
                  if r.embedding is not None)
    out = QUERIES["op11_vector_codes"](spark, SF_SMALL)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    got = sorted(tuple(r) for r in out.collect())
    assert len(got) == len(rows) and got[:40] == brute(rows)[:40]
