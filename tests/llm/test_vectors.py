"""Whitening and vector codes against plain Python with whole numbers and fractions."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageflow.llm import dense, vector_codes, whitening
from pageflow.llm.vector_codes import codebooks_sha256, compressed, reassigned, with_label_errors
from pageflow.llm.whitening import whitened


@pytest.fixture(scope="module")
def table(llm):
    """A function making (vec_id, embedding, label) with columns whose names clash."""
    def make(rows, kind="float"):
        frame = llm.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, label int")
        return frame.repartition(3).withColumns({"code": F.lit("x"), "n": F.lit(1), "component": F.lit("y"), "error": F.lit(2), "all": F.lit(3)})

    return make


def vectors(seed, count, width, spread=1.0):
    rnd = random.Random(seed)
    return [[float(np.float32(rnd.gauss(0.3 * (k % 3), spread * (1 + j)))) for j in range(width)] for k in range(count)]


ODD = [(901, None, 1), (902, [1.0, None] + [0.0] * 30, 1), (903, [float("nan")] * 32, 2), (904, [float("inf")] + [1.0] * 31, 2), (905, [float("-inf")], None)]


# -- whitening

def covariance(rows):
    """Of floor(64 c), with fractions."""
    width, n = max(map(len, rows)), len(rows)
    x = [[math.floor(64 * c) for c in r] + [0] * (width - len(r)) for r in rows]
    mean = [Fraction(sum(r[i] for r in x), n) for i in range(width)]
    d = [[r[i] - mean[i] for i in range(width)] for r in x]
    return d, [[sum(r[i] * r[j] for r in d) / n for j in range(width)] for i in range(width)]


def check_whitened(frame, given, components):
    """The result of rows with distinct ids against the definition; signs are free."""
    d, cov = covariance([v for _, v, _ in given])
    n, width = len(given), len(cov)
    trace = sum(cov[i][i] for i in range(width))
    own = {name: k for k, (name, _, _) in enumerate(given)}
    got = np.full((n, components), np.nan)
    result = frame.collect()
    assert len(result) == n * components
    for r in result:
        got[own[r.vec_id], r.component - 1] = math.nan if r.whitened is None else r.whitened
        assert r.n == n and r.deviation == sum((v * n) ** 2 for v in d[own[r.vec_id]])
    values = np.linalg.eigvalsh(np.array([[float(v) for v in row] for row in cov]))[::-1]
    explained = {r.component: r.explained for r in result}
    for k in range(components):
        assert explained[k + 1] == pytest.approx(values[k] / float(trace), rel=1e-9)
    assert np.abs(got.T @ got / n - np.eye(components)).max() < 1e-6
    assert len({r.identity_error for r in result}) == 1 and 0 <= result[0].identity_error < 1e-6
    centred = np.array([[float(v) for v in row] for row in d])
    for k in range(components):  # got = centred . axis / sqrt(e), so the axis comes back and is an eigenvector
        axis = centred.T @ got[:, k] / n / math.sqrt(values[k])
        assert np.linalg.norm(axis) == pytest.approx(1, abs=1e-8)
        back = np.array([[float(v) for v in row] for row in cov]) @ axis
        assert np.abs(back - values[k] * axis).max() < 1e-7 * values[0]


def test_whitening_by_the_definition(table):
    given = [(k, v, 0) for k, v in enumerate(vectors(1, 70, 8))]
    check_whitened(whitened(table(given + ODD)), given, 8)


def test_at_most_32_components_and_shorter_vectors(table):
    given = [(k, v, 0) for k, v in enumerate(vectors(2, 90, 40))]
    given[3] = (3, given[3][1][:11], 0)
    given[4] = (4, [], 0)
    check_whitened(whitened(table(given)), given, 32)


def test_a_large_mean_does_not_hide_the_variance(table):
    given = [(k, [c + 1e9 for c in v], 0) for k, v in enumerate(vectors(3, 50, 5))]
    check_whitened(whitened(table(given, "double")), given, 5)


def test_covariance_is_exact_also_for_huge_components(llm, table):
    rows = [[3.0e38, 1.0, -2.0], [-1.5e38, 1e19, 4.0], [0.0, 2.0, 0.5]]
    model = whitening.fit(table([(k, v, 0) for k, v in enumerate(rows)], "double"))
    _, cov = covariance(rows)
    assert model.covariance.tolist() == [[float(v) for v in row] for row in cov]
    found = whitened(table([(k, v, 0) for k, v in enumerate(rows)])).collect()
    assert {r.deviation for r in found} == {None} and len(found) == 9


def test_components_without_variance(table):
    given = [(k, [float(k % 5), 2.0, float(k % 5)], 0) for k in range(20)]
    found = whitened(table(given)).collect()
    assert {r.component for r in found if r.whitened is not None} == {1}
    assert found[0].identity_error < 1e-9
    assert all(r.explained == pytest.approx(1) for r in found if r.component == 1)
    for one in ([(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0)] * 3):
        alone = whitened(table(one)).collect()
        assert len(alone) == 2 * len(one)
        assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone} == {(len(one), 0, None, None, None)}


def test_whitening_of_nothing_and_of_rows_without_ids(table):
    assert whitened(table(ODD)).collect() == []
    assert whitened(table([(1, [], 0)])).collect() == []
    given = [(None, [1.0, 3.0], 0), (None, [2.0, 1.0], 0), (5, [4.0, 1.0], 0), (5, [4.0, 1.0], 0)]
    found = whitened(table(given)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in found) == [(0, 1)] * 2 + [(0, 2)] * 2 + [(5, 1)] * 2 + [(5, 2)] * 2
    assert {r.n for r in found} == {4}


def test_more_dimensions_than_a_task_can_hold_are_refused(table, monkeypatch):
    monkeypatch.setattr(whitening, "MOST_DIMENSIONS", 3)
    with pytest.raises(ValueError, match="dimensions"):
        whitened(table([(1, [1.0] * 4, 0)]))


# -- totals

def test_totals_are_exact(llm):
    numbers = [2 ** 61, -(2 ** 61), 2 ** 60 + 1, -7, 3] * 40
    frame = llm.createDataFrame([(n,) for n in numbers], "x bigint").repartition(4)

    def terms(batch):
        own = batch.column(0).to_pylist()
        yield 0, np.array([sum(v ** 4 for v in own), sum(own)], object)
        yield 0, np.array([1, 0, -sum(v ** 9 for v in own)], object)

    found = dense.totals(frame, terms)
    assert found[0] >= sum(n ** 4 for n in numbers) and found[0] - sum(n ** 4 for n in numbers) <= 4
    assert (found[1], found[2]) == (sum(numbers), -sum(n ** 9 for n in numbers))
    for value in (0, -1, 2 ** 60, -2 ** 60, 2 ** 200 + 5, -2 ** 200 - 5):
        assert sum(d << dense.DIGIT * place for place, d in dense.digits(value)) == value


# -- vector codes

def lloyd(rows, rounds=2, parts=16, entries=64):
    """Every part against every entry, every time."""
    own = [(n, v, label) for n, v, label in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    own.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max(len(v) for _, v, _ in own) // parts) * parts
    size = width // parts
    x = [[math.floor(256 * c) for c in v] + [0] * (width - len(v)) for _, v, _ in own]
    cut = [[tuple(r[p * size:(p + 1) * size]) for p in range(parts)] for r in x]
    books = [[cut[k][p] for k in range(min(entries, len(cut)))] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(r[p], c)), e) for e, c in enumerate(books[p])) for p in range(parts)] for r in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                members = [cut[k][p] for k in range(len(cut)) if found[k][p][1] == e]
                if members:
                    books[p][e] = tuple(sum(c) // len(members) for c in zip(*members))
    found = assign()
    errors = [sum(d for d, _ in row) for row in found]
    by_label = {}
    for (_, _, label), error in zip(own, errors):
        by_label[label] = by_label.get(label, 0) + error
    flat = ",".join(str(c) for book in books for entry in book for c in entry)
    digest = hashlib.sha256(flat.encode()).hexdigest()
    return [(n, "".join(f"{e:02x}" for _, e in row), error, by_label[label]) for (n, _, label), row, error in zip(own, found, errors)], digest


def coded(frame):
    found, books = compressed(frame)
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in with_label_errors(found).collect()), key=repr), codebooks_sha256(books)


def check_codes(table, rows, kind="float"):
    expected, digest = lloyd(rows)
    missing = {total for *_, error, total in expected if max(error, total) > dense.LONG}
    expected = [(n, c, e if e <= dense.LONG else None, None if total in missing else total) for n, c, e, total in expected]
    assert coded(table(rows, kind)) == (sorted(expected, key=repr), digest)


def test_codes_as_by_full_search(table):
    rnd = random.Random(8)
    rows = [(rnd.randint(0, 400), v, rnd.choice([None, 1, 2, 3])) for v in vectors(4, 150, 32, 0.3)]
    rows += [(n, list(v), label) for n, v, label in rows[:30]] + [(None, rows[0][1], 1), (None, rows[1][1], None)]
    check_codes(table, rows + ODD)


def test_ties_repeated_rows_and_entries(table):
    """Few different numbers: equal entries, equal distances, unused entries."""
    rnd = random.Random(9)
    check_codes(table, [(k, [rnd.choice([-0.5, 0.0, 0.5, 1 / 256]) for _ in range(32)], k % 2) for k in range(120)])
    check_codes(table, [(1, [0.25] * 16, 1)] * 100)


def test_few_short_and_uneven_vectors(table):
    check_codes(table, [(1, [0.5] * 20, 1), (2, [-0.3] * 7, None), (3, [], None), (4, [1.0], 2)])


def test_huge_components(table):
    rows = [(k, [c * 10.0 ** (k % 9) for c in v], 1) for k, v in enumerate(vectors(6, 90, 16))]
    check_codes(table, [(n, [float(np.float32(c)) for c in v], label) for n, v, label in rows])
    (first, *_), _ = coded(table([(k, [3e38 * (k % 3), 1.0], k) for k in range(100)]))
    assert first[2] == 0


def test_an_error_beyond_long_is_null(table):
    rows = [(k, [float(k)] * 16, 1) for k in range(64)] + [(100, [1e15] * 16, 1), (101, [3e15] * 16, 2)]
    expected, digest = lloyd(rows)
    found, own = coded(table(rows, "double"))
    assert own == digest
    assert [(n, c, e if e <= dense.LONG else None) for n, c, e, _ in expected] == [r[:3] for r in sorted(found)]
    assert [r[3] for r in sorted(found)] == [None] * 66


def test_codes_of_nothing(table):
    found, books = compressed(table(ODD))
    assert found.collect() == [] and books.size == 0
    assert with_label_errors(found).collect() == []


def test_parts_whose_entry_stayed_look_at_moved_entries_only(monkeypatch):
    entries = np.array([[0, 0], [10, 0], [0, 10], [5, 5]])
    x = np.array([[1, 1], [9, 0], [5, 4], [10, 0]])
    seen = []
    real = vector_codes.distances

    def watched(rows, some):
        seen.append((rows.tolist(), some.tolist()))
        return real(rows, some)

    monkeypatch.setattr(vector_codes, "distances", watched)
    moved = np.array([False, True, False, False])
    code, gap = reassigned(x, entries, moved, np.array([0, 1, 3, 0]), np.array([2, 5, 1, 100]), np.array([True] * 4))
    assert (code.tolist(), gap.tolist()) == ([0, 1, 3, 1], [2, 1, 1, 0])
    assert seen == [([[1, 1], [5, 4], [10, 0]], [[10, 0]]), ([[9, 0]], entries.tolist())]
