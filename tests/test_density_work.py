"""density clusters look no further than they must, and find what all pairs tell."""

import numpy as np
import pyarrow as pa
import pytest

from tidemark.operators import graphs


def cell(v, ids, n, own, **more):
    return pa.table({"id": pa.array(ids), "v": pa.array(v.tolist(), pa.list_(pa.float64())), "n": pa.array(n), "own": pa.array(own), **{k: pa.array(x) for k, x in more.items()}})


@pytest.mark.parametrize("size", [1, 2, 4])
def test_cells_equal_all_pairs(monkeypatch, size):
    for name, x in (("ROWS_AT_ONCE", 7), ("PAIRS_AT_ONCE", 90), ("NEXT", 2)):
        monkeypatch.setattr(graphs, name, x)
    rng = np.random.default_rng(size)
    for reach, others, scale in ((0.3, 2, 1.0), (1.0, 1, 3.0), (0.5, 5, 1.0), (0.2, 2, 6.0)):
        v = np.unique(np.round(rng.normal(scale=scale, size=(160, size)), 2), axis=0)
        m = len(v)
        ids, n, own = rng.permutation(m) + 5, rng.choice([1, 1, 1, 2, 4], m), rng.random(m) < 0.5
        d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(axis=2))
        core = np.array([next((x for x, c in zip(np.sort(d[i]), np.cumsum(n[np.argsort(d[i], kind="stable")]) - 1, strict=True) if c >= others), np.inf) for i in range(m)])
        got = graphs._core(others, reach)(cell(v, ids, n, own)).to_pydict()
        assert dict(zip(got["id"], got["core"], strict=True)) == pytest.approx({ids[i]: core[i] for i in range(m) if own[i] and core[i] <= reach})
        dense = core <= reach
        p, q, ids, own, core, d = v[dense], n[dense], ids[dense], own[dense], core[dense], d[np.ix_(dense, dense)]
        link = d <= reach
        w = np.where(link & ~np.eye(len(p), dtype=bool), np.maximum(np.maximum(d, core[:, None]), core[None]), np.inf).min(axis=1, initial=np.inf)
        joined = link.copy()
        for _ in range(9):
            joined = (joined.astype(int) @ joined.astype(int)) > 0
        want = {int(ids[i]): (int(ids[joined[i]].min()), bool(own[i]), float(w[i]) if own[i] and np.isfinite(w[i]) else None) for i in range(len(p)) if (own & joined[i]).any()}
        got = graphs._local_links(reach)(cell(p, ids, q, own, core=core)).to_pylist()
        assert {r["id"]: (r["label"], r["own"], r["w"]) for r in got} == want and len(got) == len(want)


def test_pairs_grow_slowly(monkeypatch):
    seen, plain = [0], graphs._distances

    def counted(x, y):
        seen[0] += len(x) * len(y)
        return plain(x, y)

    monkeypatch.setattr(graphs, "_distances", counted)
    m = 6000
    v = np.stack([np.random.default_rng(1).random(m), np.zeros(m)], axis=1)
    points = cell(v, np.arange(m), np.ones(m, dtype=np.int64), np.ones(m, dtype=bool))
    core = graphs._core(2, 1.0)(points)
    assert core.num_rows == m and seen[0] < m * m / 10
    near = dict(zip(core.column("id").to_pylist(), core.column("core").to_pylist(), strict=True))
    links = graphs._local_links(1.0)(points.append_column("core", pa.array([near[i] for i in range(m)])))
    assert links.num_rows == m and set(links.column("label").to_pylist()) == {0} and seen[0] < m * m / 5
