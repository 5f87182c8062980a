import numpy as np
import pytest

from ferrite.llm.embeddings import near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    ok = {i: np.array(v, float) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = {i: set() for i, _ in rows}
    for i, a in ok.items():
        for j, b in ok.items():
            if i != j and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95:
                links[i].add(j)
    return links


def reach(links, i):
    seen, todo = {i}, [i]
    while todo:
        for j in links[todo.pop()] - seen:
            seen.add(j)
            todo.append(j)
    return min(seen)


def vectors(n=600, d=24, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i and rng.random() < 0.5:  # a third and more near a few vectors
            base = np.array(rows[int(rng.integers(0, max(1, min(i, 40))))][1])
            v = base + rng.normal(size=d) * rng.choice([0.0, 0.05, 0.15]) * np.linalg.norm(base) / np.sqrt(d)
        else:
            v = rng.normal(size=d)
        rows.append((i, np.float32(v).astype(float).tolist()))
    return rows


def test_links_equal_brute_force(spark):
    rows = vectors()
    rows += [(1000, None), (1001, []), (1002, [0.0] * 24), (1003, [None] + [1.0] * 23), (1004, [float("nan")] * 24),
             (1005, [float("inf")] + [0.0] * 23), (1006, [1.0, 2.0]), (1007, [2.0, 4.0]), (1008, [1.0])]
    got = {r.vec_id: r for r in near_duplicates(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect()}
    links = brute(rows)
    true = sum(map(len, links.values()))
    assert true > 1000 and len(got) == len(rows)
    assert sum(r.n_links for r in got.values()) >= 0.99 * true
    exact = sum(got[i].n_links == len(links[i]) for i in links)
    assert exact >= 0.99 * len(links)
    assert all(got[i].n_links <= len(links[i]) for i in links)  # no link below the threshold
    assert all(got[i].component_id == reach(links, i) for i in links if got[i].n_links == len(links[i]))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert got[1006].n_links == got[1007].n_links == 1


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 0)] * 3 + [(None, [1.0, 0.0], 0), (None, [0.0, 1.0], 1)], SCHEMA)
    rows = near_duplicates(df).collect()
    assert sorted(r.n_links for r in rows) == [0, 3, 3, 3, 3]
    assert [r.kept for r in rows if r.vec_id is None and r.n_links == 3] == [False]
    assert near_duplicates(df.filter("false")).count() == 0


@pytest.mark.parametrize("cosine", [0.985, 0.93])  # of two members on average: all pairs linked, or one in twenty
@pytest.mark.parametrize("size", [1000, 3000, 8000])
def test_recall_in_a_dense_group_of_a_third_of_all_rows(spark, size, cosine):
    rng, d = np.random.default_rng(7), 64
    centre = rng.normal(size=d)
    group = centre / np.linalg.norm(centre) + rng.normal(size=(size, d)) * np.sqrt((1 / cosine - 1) / d)
    x = np.float32(np.concatenate([group, rng.normal(size=(2 * size, d))])).astype(float)
    got = near_duplicates(spark.createDataFrame([(i, v, 0) for i, v in enumerate(x.tolist())], SCHEMA))
    found = got.selectExpr("sum(n_links)").first()[0]
    unit = x[:size] / np.linalg.norm(x[:size], axis=1, keepdims=True)
    true = sum(int((unit[i:i + 1000] @ unit.T >= 0.95).sum()) for i in range(0, size, 1000)) - size
    print(f"{size} members, mean cosine {cosine}: {true} links, recall {found / true:.4f}")
    assert 0.99 * true <= found <= true
