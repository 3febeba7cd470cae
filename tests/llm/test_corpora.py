"""Operators on whole corpora, against plain Python."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pageflow.llm import grams as grams_, graphs, lm, mixing, mtree, near_dup, substrings, warc
from tests.llm.conftest import words_of


# -- near duplicates ------------------------------------------------------------------------

def pairs_of(text):
    w = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(w)


def linked(rows):
    """(doc_id, n_shingles, component_id, kept) of all rows."""
    sets = [(n, pairs_of(t)) for n, t in rows]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    known = {s for n, s in sets if n is not None and s}
    for x in known:
        for y in known:
            if len(x) <= len(y) and 100 * len(x & y) >= 80 * len(x | y):
                up[top(x)] = top(y)
    least = {}
    for n, s in sets:
        if n is not None and s:
            least[top(s)] = min(n, least.get(top(s), n))
    found = [(n, len(s), None if n is None else least[top(s)] if s else n) for n, s in sets]
    return sorted(((n, size, c, n == c) for n, size, c in found), key=repr)


def test_near_duplicates(odd, rows, none):
    found = near_dup.near_duplicates(odd).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, found), key=repr) == linked(rows)
    assert near_dup.near_duplicates(none).count() == 0
    assert near_dup.one_of_each(none).columns == none.columns


def test_large_groups_are_compared_block_by_block(docs, monkeypatch):
    import random
    rnd = random.Random(9)
    base = [f"w{n}" for n in range(60)]
    rows = []
    for n in range(60):
        own = list(base)
        for at in rnd.sample(range(60), rnd.choice((1, 2, 4, 6))):
            own[at] = f"x{rnd.randint(0, 10**6)}"
        rows.append((n, " ".join(own)))
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    found = near_dup.near_duplicates(docs(rows)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, found), key=repr) == linked(rows)


def test_estimates_are_corrected_for_collisions():
    rnd = np.random.default_rng(1)
    values = rnd.integers(0, 2 ** 63, 4000, dtype=np.uint64)
    a, b, c = (np.sort(values[s]) for s in (slice(0, 1800), slice(200, 2000), slice(2000, 3800)))
    assert abs((near_dup.registers(a) == near_dup.registers(b)).mean() - 0.8) < 0.12
    assert (near_dup.registers(a) == near_dup.registers(c)).mean() < 0.02


def test_smallest_hashes_tell_links_exactly_or_nearly():
    rnd = np.random.default_rng(2)
    for size in (1, 5, 60, 700, 3000):
        values = rnd.integers(0, 2 ** 63, 2 * size, dtype=np.uint64) * np.uint64(2)
        sets = [np.unique(rnd.permutation(values)[:size]) if n % 2 else np.unique(np.r_[values[n:size], values[-1 - n:]]) for n in range(8)]
        left, right = np.triu_indices(len(sets), 1)
        found = near_dup.alike([s[:near_dup.HEAD] for s in sets], left, right)
        for a, b, close in zip(left, right, found):
            both = len(np.intersect1d(sets[a], sets[b]))
            share = both / (len(sets[a]) + len(sets[b]) - both)
            if size < 1000:
                assert close == (share >= 0.8)
            else:
                assert close or share < 0.8
                assert not close or share > 0.66
    assert not len(near_dup.alike([], np.empty(0, int), np.empty(0, int)))


def test_components(llm):
    edges = [(n, n + 1) for n in range(40)] + [(100, 200), (200, 300), (7, 7)]
    frame = llm.createDataFrame(edges, "a bigint, b bigint")
    found = {r.node: r.root for r in graphs.components(frame).collect()}
    assert found == {**{n: 0 for n in range(41)}, 100: 100, 200: 100, 300: 100}
    assert graphs.components(frame.limit(0)).count() == 0


# -- repeated passages ----------------------------------------------------------------------

def without(rows, k):
    seen = Counter()
    for _, text in rows:
        w = words_of(text)
        seen.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for n, text in rows:
        w = words_of(text)
        gone = {i + j for i in range(len(w) - k + 1) if seen[tuple(w[i:i + k])] > 1 for j in range(k)}
        rest = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((n, len(w), len(gone), hashlib.sha256(rest.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("k", [35, 4])
def test_repeated_passages(odd, rows, none, k):
    found = substrings.without_repeats(odd, k).collect()
    assert sorted(map(tuple, found), key=repr) == without(rows, k)
    if k == 35:
        assert substrings.without_repeats(none).count() == 0


def test_texts_that_part_and_meet_at_one_node(docs):
    """Counts stay equal along the first text though others leave and join it."""
    rows = [(0, "a b c d e f g h"), (1, "a b c d e x y"), (2, "z v c d e f g h q"), (3, "m a b c d n"), (4, "a a a a a a a"), (5, "b a a a a c")]
    found = substrings.without_repeats(docs(rows), 3).collect()
    assert sorted(map(tuple, found), key=repr) == without(rows, 3)


def test_a_class_of_paths_is_taken_apart_once(docs, monkeypatch):
    """500 near copies: single windows grow with the different paths, not with their occurrences."""
    rnd, seen = random.Random(4), {}
    base = [f"b{n}" for n in range(200)]
    rows = []
    for n in range(500):
        own = list(base)
        for at in rnd.sample(range(200), 4):
            own[at] = f"x{rnd.randint(0, 3)}"
        rows.append((n, " ".join(own)))
    real = substrings.saved
    monkeypatch.setattr(substrings, "saved", lambda frame, name: seen.setdefault(name, real(frame, name)))
    found = substrings.without_repeats(docs(rows), 10).collect()
    assert sorted(map(tuple, found), key=repr) == without(rows, 10)
    occurrences = seen["suspects"].agg(F.sum("size")).first()[0]
    assert seen["suspects"].count() > 500
    assert seen["class-windows"].count() < occurrences / 10


# -- language model -------------------------------------------------------------------------

def test_scores_against_the_other_documents(odd, rows, none):
    ones, twos = Counter(), Counter()
    for _, text in rows:
        w = words_of(text)
        ones.update(w)
        twos.update(zip(w, w[1:]))
    total, expected = sum(ones.values()), []
    for n, text in rows:
        w = words_of(text)
        own1, own2, score, backed = Counter(w), Counter(zip(w, w[1:])), 0.0, 0
        for i, x in enumerate(w):
            pair = (w[i - 1], x) if i else None
            both = twos[pair] - own2[pair] if i else 0
            if both > 0:
                score += math.log(both / (ones[pair[0]] - own1[pair[0]]))
                continue
            backed += bool(i)
            score += math.log(0.4) * bool(i) + math.log(max(ones[x] - own1[x], 0.5) / max(total - len(w), 1))
        expected.append((n, len(w), backed, score))
    found = lm.scores(odd).select("doc_id", "n_words", "n_backed_off", "sum_log").collect()
    key = lambda r: (repr(r[0]), r[1], r[2], round(r[3], 2))
    assert [x[:3] for x in sorted(map(tuple, found), key=key)] == [x[:3] for x in sorted(expected, key=key)]
    assert sorted(r.sum_log for r in found) == pytest.approx(sorted(x[3] for x in expected), abs=1e-4)
    assert lm.scores(none).count() == 0


def test_the_query_scores_triples(llm, odd, rows, tmp_path):
    def grams(w, n):
        return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))

    every, expected = [Counter() for _ in range(4)], []
    for _, text in rows:
        for n in (1, 2, 3):
            every[n].update(grams(words_of(text), n))
    for number, text in rows:
        w = words_of(text)
        left = [None] + [every[n] - grams(w, n) for n in (1, 2, 3)]
        total, score, backed = sum(every[1].values()) - len(w), 0.0, 0
        for i in range(len(w)):
            steps = 0
            for n in range(min(3, i + 1), 0, -1):
                gram = tuple(w[i - n + 1:i + 1])
                if n == 1:
                    score += math.log(max(left[1][gram], 0.5) / max(total, 1))
                elif left[n][gram]:
                    score += math.log(left[n][gram] / left[n - 1][gram[:-1]])
                    break
                else:
                    steps += 1
            score += steps * math.log(0.4)
            backed += steps > 0
        expected.append((number, len(w), backed, score))
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    found = lm.op8_lm(llm, str(tmp_path)).select("doc_id", "n_words", "n_backed_off", "sum_log").collect()
    key = lambda r: (repr(r[0]), r[1], r[2], round(r[3], 2))
    assert [x[:3] for x in sorted(map(tuple, found), key=key)] == [x[:3] for x in sorted(expected, key=key)]
    assert sorted(r.sum_log for r in found) == pytest.approx(sorted(x[3] for x in expected), abs=1e-4)


@pytest.mark.parametrize("width", [1, 8, 13, 39, 48, 56, 58])
def test_packed_values_come_back(width):
    rnd = np.random.default_rng(width)
    for size in (0, 1, 63, 64, 65, 1000, 20_000):
        values = np.sort(rnd.integers(0, 1 << width, size, dtype=np.uint64))
        assert (grams_.unpacked(grams_.packed(values, width), size, width) == values).all()
    ends = np.repeat(np.array([0, (1 << width) - 1], np.uint64), 100)
    assert (grams_.unpacked(grams_.packed(ends, width), 200, width) == ends).all()


def test_counts_of_any_size_come_back():
    for counts in ([], [1], [255, 256], [1, 2 ** 32, 2 ** 40 + 3], [2 ** 62, 0]):
        assert grams_.from_planes(grams_.planes(np.array(counts, np.int64))).tolist() == counts


def test_bundles_hold_every_row_once(odd, rows):
    bundles = grams_.bundled(odd, grams_.characters(odd), 2000).toArrow()
    assert len(set(bundles.column("chunk").to_pylist())) == bundles.num_rows > 1
    back = grams_.rows_in(bundles)
    assert Counter(zip(back.column("doc_id").to_pylist(), back.column("text").to_pylist())) == Counter(map(tuple, rows))


def test_rows_without_text_fill_bundles_too(llm):
    empty = llm.createDataFrame([(None, None)] * 3000, "doc_id bigint, text string").coalesce(1)
    bundles = grams_.bundled(empty, 64 * 800, 10 ** 6).toArrow()
    assert bundles.num_rows == 30 and grams_.rows_in(bundles).num_rows == 3000


# -- mixing ---------------------------------------------------------------------------------

def test_mixing(llm, odd, none):
    sizes = {"a": 400, "b": 100, "c": 50, None: 20}
    rows = [(s, n, " ".join(["x"] * (1 + n % 7))) for s, count in sizes.items() for n in range(count)]
    frame = llm.createDataFrame([(i, t, s) for i, (s, n, t) in enumerate(rows)], "doc_id bigint, text string, source string")
    mix = mixing.mixed_rows(frame, evenness=0.95, most_epochs=3.0).select(
        "row.doc_id", "row.source", "n_tokens", "epoch", "block", "order_key").cache()
    times = {r[0]: r[1] for r in mix.groupBy("doc_id").count().collect()}
    assert set(times) == set(range(len(rows))), "every document comes once at least"
    assert max(times.values()) <= 3
    tokens = Counter()
    for source, _, text in rows:
        tokens[source] += len(text.split())
    shares = llm.createDataFrame([(str(s), t, 1) for s, t in tokens.items()], "key string, tokens bigint, n_docs bigint")
    found = mixing.fit(shares, 0.95, 3.0)
    total = sum(tokens.values())

    def entropy(x):
        powers = [(t / total) ** x for t in tokens.values()]
        return -sum(p / sum(powers) * math.log(p / sum(powers)) for p in powers)

    def most(x):
        return (max(tokens.values()) / min(tokens.values())) ** (1 - x)

    free = mixing.fit(shares, 0.95, 1e9)
    assert entropy(free.exponent) == pytest.approx(0.95 * math.log(4), abs=1e-4)
    assert most(found.exponent) == pytest.approx(3.0, abs=1e-3) and found.exponent > free.exponent
    for source, count in tokens.items():
        wanted = found.scale * count ** found.exponent
        got = mix.where(F.col("source").eqNullSafe(F.lit(source))).agg(F.sum("n_tokens")).first()[0]
        assert wanted - 1e-3 <= got <= wanted + 7
    again = mixing.mixed_rows(frame, evenness=0.95, most_epochs=3.0).select("order_key")
    assert again.agg(F.sum(F.hash("order_key"))).first() == mix.agg(F.sum(F.hash("order_key"))).first()
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert mixing.mixed_documents(none).count() == 0
    half = mixing.mixed_rows(frame, budget=total // 2).agg(F.sum("n_tokens")).first()[0]
    assert total // 2 <= half <= total // 2 + 4 * 7


# -- archives -------------------------------------------------------------------------------

def test_archives(llm, tmp_path):
    pages = [(1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://é/ \r\nX: y", None), (4, "u", ""), (0, "v", "\r\n\r\nWARC/1.1 é"),
             (None, "w", "<p>x</p>"), (None, "w", "alone"), (5, "x", "y" * 3_000_000), (6, "x", "y" * 3_000_000), (6, "x", "z"), (6, "x", "z")]
    frame = llm.createDataFrame([(*p, 1, 2) for p in pages], "page_id bigint, url string, html string, digest int, frame int")
    places = warc.archive(frame, str(tmp_path / "w"))
    found = sorted(map(tuple, warc.read_back(places, str(tmp_path / "w")).collect()), key=repr)
    expected = []
    for number, _, html in pages:
        data = (html or "").encode()
        first = min((n for n, _, h in pages if (h or "") == (html or "") and n is not None), default=None)
        revisit = first is not None and number != first
        expected.append((number, len(data), warc.digest_of(data), "revisit" if revisit else "response", first if revisit else None))
    assert found == sorted(expected, key=repr)
    assert warc.archive(frame.limit(0), str(tmp_path / "n")).count() == 0
    none = warc.archive(frame, str(tmp_path / "l"), least=10 ** 9)
    assert warc.read_back(none, str(tmp_path / "l")).where("record_type = 'revisit'").count() == 0


def test_reading_archives_is_split_by_frames(llm, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "READ", 2)
    monkeypatch.setattr(warc, "RUN", 2)
    pages = llm.range(0, 48, numPartitions=1).selectExpr("id AS page_id", "'u' AS url", "repeat(uuid(), 30000) AS html")
    places = warc.archive(pages, str(tmp_path / "w"))
    frames = places.select("bundle", "frame").distinct().count()
    tasks = warc.read_back(places, str(tmp_path / "w")).groupBy(F.spark_partition_id()).count().collect()
    assert frames >= 24 and sum(t["count"] for t in tasks) == 48
    assert len(tasks) >= frames // 6 and max(t["count"] for t in tasks) <= 24
    few = warc.read_back(places.where("frame = 3"), str(tmp_path / "w"))
    assert few.count() == places.where("frame = 3").count() > 0


def test_bundles_have_independent_frames(tmp_path):
    path = str(tmp_path / "b.zst")
    writer = warc.BundleWriter(pa.OSFile(path, "wb"))
    records = [warc.record(n, "http://x/", bytes([n % 256]) * 5000, None, "d") for n in range(600)]
    places = [writer.add(r) for r in records]
    writer.close()
    reader = warc.BundleReader(pa.OSFile(path, "rb"))
    assert len(reader.sizes) > 2
    for n in (599, 0, 300):
        frame, at = places[n]
        headers, block = warc.parsed(reader.frame(frame), at)
        assert headers["WARC-Record-ID"] == f"<urn:page:{n}>" and block.endswith(bytes([n % 256]) * 5000)


# -- top products ---------------------------------------------------------------------------

def test_top_products(llm):
    rnd = np.random.default_rng(2)
    rows = [(n, (rnd.normal(size=8) * rnd.choice([0.1, 1.0])).astype("float32").tolist()) for n in range(700)]
    rows += [(n, rows[5][1]) for n in range(700, 760)]
    rows += [(800, None), (900, [1.0, None] + [0.0] * 6), (1000, [float("nan")] * 8), (1100, [float("inf")] * 8), (None, [0.5] * 8),
             (1200, []), (1300, [2.0]), (100, rows[100][1])]
    frame = llm.createDataFrame([(n, v, 1, 2) for n, v in rows], "vec_id bigint, embedding array<float>, route int, share int")
    usable = [(n, np.floor(1024 * np.array(v, np.float64)).astype(np.int64)) for n, v in rows
              if n is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    wide = {(k, n): np.pad(v, (0, 8 - len(v))) for k, (n, v) in enumerate(usable)}
    expected = []
    for query in sorted({n for _, n in wide if n % 100 == 0}):
        q = next(v for (_, n), v in wide.items() if n == query)
        best = sorted((-int(q @ v), n) for (_, n), v in wide.items() if n != query)[:10]
        expected += [(query, r + 1, n, -s) for r, (s, n) in enumerate(best)]
    found = mtree.top_products(frame, frame.where("vec_id % 100 = 0"))
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    few = frame.where("vec_id < 4")
    assert mtree.top_products(few, few.where("vec_id = 0")).count() == 3
    assert mtree.top_products(frame.limit(0), frame.limit(0)).count() == 0


@pytest.mark.parametrize("power", [6, 7, 12, 37])
def test_products_of_huge_components_are_ranked_exactly(llm, power):
    rnd = random.Random(power)
    rows = [(n, [float(np.float32(rnd.choice((0, 1, -1)) * rnd.random() * 10 ** rnd.choice((0, power)))) for _ in range(6)]) for n in range(300)]
    rows += [(300 + n, list(rows[n][1])) for n in range(40)]
    frame = llm.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    v = {n: [math.floor(1024 * c) for c in e] for n, e in rows}
    expected = []
    for q in range(0, 340, 20):
        best = sorted((-sum(a * b for a, b in zip(v[q], v[n])), n) for n in v if n != q)[:10]
        expected += [(q, k + 1, n, -s if abs(s) < 2 ** 63 else None) for k, (s, n) in enumerate(best)]
    found = mtree.top_products(frame, frame.where("vec_id % 20 = 0")).collect()
    assert sorted(map(tuple, found)) == expected
