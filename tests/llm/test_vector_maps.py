import math
from hashlib import sha256

import numpy as np
import pytest

from termflow.llm.grid_codes import CELL, CellMemo, grid_codes, grid_codes_query, not_dominated
from termflow.llm.spectrum import count_above, eigenpair, with_clusters
from termflow.llm.whitening import whitened_vectors, whitening_query

EMBEDDINGS = "vec_id bigint, embedding array<float>, label int"
NAN, INF = math.nan, math.inf


def vectors(n, width, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, width))
    found = centres[rng.integers(0, 7, n)] + rng.normal(size=(n, width)) / 3
    return (found / np.linalg.norm(found, axis=1, keepdims=True)).astype("f4").tolist()


def odd(rows, width):
    """Rows that have no result, with nulls in each column."""
    return [
        (9001, None, 1),
        (9002, [None, *[0.1] * (width - 1)], 1),
        (9003, [NAN, *[0.1] * (width - 1)], 2),
        (9004, [INF, *[0.1] * (width - 1)], None),
        (9005, [], 1),
        (9006, [0.5] * (width - 1), 1),
    ]


@pytest.fixture
def written(spark, tmp_path):
    def write(rows, extra=()):
        path = tmp_path / f"sf{len(list(tmp_path.iterdir()))}"
        df = spark.createDataFrame(rows, EMBEDDINGS).repartition(3)
        for name in extra:
            df = df.selectExpr("*", f"'{name}' AS {name}")
        df.write.parquet(str(path / "embeddings.parquet"))
        return str(path)

    return write


# Grid codes


def plain_codes(rows):
    """vec_id, code, error, label of usable rows; final codebooks."""
    rows = [r for r in rows if r[0] not in range(9001, 9007)]
    whole = [
        (k, label, [math.floor(256 * float(np.float32(c))) for c in v])
        for k, v, label in rows
    ]
    whole.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    x = np.array([r[2] for r in whole], object).reshape(len(whole), 16, -1)
    books = [[list(x[k, p]) for k in range(min(64, len(x)))] for p in range(16)]

    def assign(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(2):
        for p in range(16):
            own = [assign(p, part)[1] for part in x[:, p]]
            for k in range(len(books[p])):
                mine = [x[i, p] for i, o in enumerate(own) if o == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    out = []
    for (k, label, _), vector in zip(whole, x):
        found = [assign(p, part) for p, part in enumerate(vector)]
        code = "".join(f"{i:02x}" for _, i in found)
        out.append((k, code, sum(d for d, _ in found), label))
    flat = ",".join(str(c) for book in books for entry in book for c in entry)
    return out, sha256(flat.encode()).hexdigest()


@pytest.mark.parametrize("n, width, scale", [(150, 32, 1), (40, 16, 1), (90, 16, 3000)])
def test_codes_equal_a_full_search(spark, written, n, width, scale):
    rows = [
        (k, [scale * c for c in v], (k % 3, None)[k % 7 == 0])
        for k, v in enumerate(vectors(n, width))
    ]
    rows += [(3, rows[5][1], 2), rows[4], (None, rows[6][1], 1)] + odd(rows, width)
    want, books = plain_codes(rows)
    by_label = {}
    for _, _, error, label in want:
        by_label[label] = by_label.get(label, 0) + error
    found = grid_codes_query(spark, written(rows, ["x", "codes", "n", "of"])).collect()
    got = [(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in found]
    assert sorted(got, key=repr) == sorted(
        ((k, code, error, by_label[label]) for k, code, error, label in want), key=repr
    )
    assert {r["codebooks_sha256"] for r in found} == {books}


def test_no_codes(spark, written):
    for rows in ([], odd([], 16)[:4]):
        assert grid_codes_query(spark, written(rows)).collect() == []


def test_general_shapes(spark):
    df = spark.createDataFrame(
        [(k, v, 0) for k, v in enumerate(vectors(60, 12))], EMBEDDINGS
    )
    found, books = grid_codes(df, parts=3, entries=10, rounds=1, scale=100)
    assert books.shape == (3, 10, 4)
    assert {len(r["codes"]) for r in found.collect()} == {3}


def test_dominated_entries_are_never_nearest():
    rng = np.random.default_rng(2)
    book = rng.integers(-200, 200, (64, 4))
    points = rng.integers(-250, 250, (5000, 4))
    masks = not_dominated(points // CELL, book)
    square = ((points[:, None] - book) ** 2).sum(axis=2)
    assert masks[np.arange(len(points)), square.argmin(axis=1)].all()
    assert masks.mean() < 0.5


def test_memo_begins_anew(monkeypatch):
    from termflow.llm import grid_codes as module

    monkeypatch.setattr(module, "REMEMBERED", 50)
    rng = np.random.default_rng(4)
    book = rng.integers(-90, 90, (16, 4))
    memo = CellMemo(book)
    for _ in range(5):
        points = rng.integers(-100, 100, (200, 4))
        entry, square = memo.nearest(points)
        want = ((points[:, None] - book) ** 2).sum(axis=2)
        assert (entry == want.argmin(axis=1)).all() and (square == want.min(axis=1)).all()


# Spectrum and whitening


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_counts_are_those_of_eigenvalues(n):
    rng = np.random.default_rng(n)
    for _ in range(20):
        a = rng.normal(size=(n, n))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in [*rng.normal(size=5) * n**0.5, 0.0]:
            assert count_above(a, shift) == (values > shift).sum()
    assert count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def test_eigenpairs_of_close_and_equal_values():
    rng = np.random.default_rng(0)
    turn, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    values = np.array([5, 5, 5, 4 + 1e-6, 4, 3, 3 + 1e-13, 2, 1, 1e-3, 0, 0.0])
    values = np.sort(values)[::-1]
    a = turn @ np.diag(values) @ turn.T
    a = (a + a.T) / 2
    alone = [eigenpair(a, k) for k in range(1, 13)]
    assert [x is None for _, x in alone][:5] == [True] * 3 + [False] * 2
    pairs = with_clusters(a, alone)
    assert np.allclose([v for v, _ in pairs], values, atol=1e-12)
    axes = np.array([x for _, x in pairs])
    assert np.abs(axes @ axes.T - np.eye(12)).max() < 1e-8
    assert np.abs(a @ axes.T - axes.T * [v for v, _ in pairs]).max() < 1e-12
    # A cluster that goes on after the last pair.
    first = [x for _, x in with_clusters(a, alone[:2])]
    assert np.abs(np.array(first) - axes[:2]).max() == 0
    assert eigenpair(np.zeros((3, 3)), 2)[0] == 0.0


def plain_whitening(rows):
    x = np.array(
        [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v, _ in rows]
    )
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:32], axes[:, ::-1][:, :32]
    return (
        centred @ axes / np.sqrt(values),
        values / np.trace(covariance),
        ((n * x - sums) ** 2).sum(axis=1),
    )


@pytest.mark.parametrize("width", [40, 10])
def test_whitening(spark, written, width):
    rows = [(k, v, k % 3) for k, v in enumerate(vectors(300, width))]
    rows += [(300, rows[5][1], None), (301, rows[4][1], 0)]
    found = whitening_query(spark, written(rows + odd(rows, width), ["n", "x", "place"]))
    found = sorted(found.collect(), key=lambda r: (r["vec_id"], r["component"]))
    rows = sorted(rows, key=lambda r: r[0])
    want, explained, deviations = plain_whitening(rows)
    many = min(32, width)
    assert len(found) == many * len(rows)
    got = np.array([r["whitened"] for r in found]).reshape(-1, many)
    assert np.abs(got * np.sign((got * want).sum(axis=0)) - want).max() < 1e-8
    assert np.allclose([r["explained"] for r in found[:many]], explained, rtol=1e-9)
    assert [r["deviation"] for r in found[::many]] == deviations.tolist()
    assert {r["n"] for r in found} == {len(rows)}
    assert [r["component"] for r in found[:many]] == list(range(1, many + 1))
    (error,) = {r["identity_error"] for r in found}
    assert error < 1e-10
    assert np.abs(got.T @ got / len(rows) - np.eye(many)).max() == pytest.approx(error, abs=1e-12)


def test_whitening_leaves_out_what_has_no_spread(spark, written):
    rows = [(k, [*v, v[0], 0.25], 0) for k, v in enumerate(vectors(50, 4))]
    found = whitening_query(spark, written(rows)).collect()
    assert {r["component"] for r in found} == {1, 2, 3, 4}
    assert max(r["identity_error"] for r in found) < 1e-4
    for few in ([], rows[:1], odd([], 6)[:4]):
        assert whitening_query(spark, written(few)).collect() == []


def test_rows_of_one_id_are_vectors_of_their_own(spark, written):
    rows = [(k // 2, v, 0) for k, v in enumerate(vectors(20, 3))] + [(None, [0.5] * 3, 0)]
    found = whitening_query(spark, written(rows)).collect()
    assert {r["n"] for r in found} == {21} and len(found) == 63


def test_equal_eigenvalues(spark):
    rows = [(k, [c * (k == j) for j in range(6)], 0) for k in range(6) for c in (1.0, -1.0)]
    df = spark.createDataFrame(rows, EMBEDDINGS)
    found, fitted = whitened_vectors(df)
    values = np.array([r["whitened"] for r in found.collect()])
    assert np.abs(values.T @ values / 12 - np.eye(6)).max() < 1e-8
    assert np.allclose(fitted.explained, 1 / 6)


def test_large_numbers_stay_exact(spark):
    base = [(k, [c * 1e9 for c in v], 0) for k, v in enumerate(vectors(40, 5))]
    df = spark.createDataFrame(base, "vec_id bigint, embedding array<double>, label int")
    rows, fitted = whitened_vectors(df, components=3)
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v, _ in base]
    sums = [sum(column) for column in zip(*x)]
    assert fitted.sums == sums and fitted.n == 40
    for row in rows.collect():
        want = sum((40 * a - s) ** 2 for a, s in zip(x[row["vec_id"]], sums))
        assert row["deviation"] == (want if want < 1 << 63 else None)
        assert len(row["whitened"]) == 3
