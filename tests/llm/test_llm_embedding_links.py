"""Links between vectors against all pairs."""

import numpy as np
import pytest

from tapeline.llm import embedding_links as e
from tapeline.llm.queries import ORACLE, QUERIES

SHAPE = "vec_id long, embedding array<float>, label int, node string, filter string, unit string, weight string"


def plain(rows, cosine=e.COSINE):
    good = [k for k, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = [[] for _ in rows]
    for size in {len(rows[k][1]) for k in good}:
        here = [k for k in good if len(rows[k][1]) == size]
        units = e._units(np.array([rows[k][1] for k in here], np.float32).astype(float))
        for a, b in zip(*np.nonzero(units @ units.T >= cosine), strict=True):
            if a != b:
                links[here[a]].append(here[b])
    seen = {}
    for k in range(len(rows)):
        if k in seen:
            continue
        group, open_ = {k}, [k]
        while open_:
            for other in links[open_.pop()]:
                if other not in group:
                    group.add(other)
                    open_.append(other)
        low = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        seen |= dict.fromkeys(group, low)
    return sorted(((i, len(links[k]), seen[k], i is not None and i == seen[k]) for k, (i, _) in enumerate(rows)), key=str)


def answers(spark, rows, **options):
    table = spark.createDataFrame([(i, v, 1, *["clash"] * 4) for i, v in rows], SHAPE)
    return sorted(map(tuple, e.near_duplicates(table, **options).collect()), key=str)


def around(random, centre, n, spread):
    return [(centre + random.normal(0, spread, len(centre))).astype(np.float32).tolist() for _ in range(n)]


@pytest.mark.parametrize("limit", [1_000, 12])
def test_groups_of_near_copies(spark, limit):
    """Groups as wide as the bound and far narrower, also where a filter's members are cut into slots and cliques."""
    random = np.random.default_rng(8)
    vectors = random.normal(size=(150, 32)).astype(np.float32).tolist()
    for spread, n in ((0.02, 90), (0.16, 60), (0.2, 40), (0.3, 20)):
        vectors += around(random, random.normal(size=32), n, spread)
    vectors += [vectors[7]] * 25 + [vectors[160]] * 30 + [[2 * x for x in vectors[9]]]
    rows = [(1000 - 3 * k, v) for k, v in enumerate(vectors)]
    found, right = answers(spark, rows, limit=limit), plain(rows)
    n_found, n_right = (sum(x[1] for x in y) for y in (found, right))
    assert n_right > 10_000 and 0.99 * n_right <= n_found <= n_right
    assert sum(a == b for a, b in zip(found, right, strict=True)) >= 0.9 * len(rows)
    assert sum(a[2] == b[2] for a, b in zip(found, right, strict=True)) >= 0.99 * len(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0] * 4), (4, [1.0, nan, 0.0, 0.0]), (5, [1.0, inf, 0.0, 0.0]), (6, [1.0, None, 0.0, 0.0])]
    rows += [(7, [1.0, 2.0, 3.0, 4.0]), (7, [1.0, 2.0, 3.0, 4.0]), (8, [2.0, 4.0, 6.0, 8.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 2.0, 3.0, 4.0])]
    rows += [(10, [-1.0, -2.0, -3.0, -4.0]), (11, [1e-30, 2e-30, 3e-30, 4e-30]), (12, [3.0]), (13, [5.0]), (7, [9.0, 0.0, 0.0, 0.1])]
    assert answers(spark, rows) == plain(rows)
    assert answers(spark, []) == []


def test_recall_at_the_bound():
    """New pairs of exactly the bound's cosine, at the number of vectors of a large table."""
    random = np.random.default_rng(77)
    for n in (1_000, 100_000):
        code = e.Code.fit(64, n)
        left = e._units(random.normal(size=(2_000, 64)))
        across = random.normal(size=left.shape)
        across -= (across * left).sum(1, keepdims=True) * left
        right = 0.95 * left + np.sqrt(1 - 0.95**2) * e._units(across)
        both = [set(zip(*(x.tolist() for x in code.passed(side)), strict=True)) for side in (left, right)]
        assert len({i for i, _ in both[0] & both[1]}) >= 0.98 * len(left)
        assert code.found >= e.RECALL


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    found = QUERIES["op11_embedding_links"](spark, folder)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    assert sorted(map(tuple, found.collect()), key=str) == plain([tuple(x) for x in rows])
    assert "op11_embedding_links" in ORACLE
