"""Vectors compressed to a byte a part, by codebooks that Lloyd's rounds improve.

Vectors of whole numbers are cut into 16 parts; each part position has a codebook of 64 entries, and a part's code is its nearest
entry. A round gives every entry the mean of its parts. Rows keep their codes and exact distances between rounds, in a
written table: where a part's entry has not moved, no entry that has not moved either can be nearer, so only the moved ones are
compared with the stored distance. Parts whose entry has moved look through the whole codebook. Ties go to the lower index.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pageflow.llm.common import prepared, saved, table
from pageflow.llm.dense import LONG, exact_sum, floors, matrix, most, totals, usable

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2


def parts_of(column: pa.Array, width: int) -> np.ndarray:
    """(rows, parts, numbers of a part), shorter vectors filled up with zeros."""
    x = floors(matrix(column, width), SCALE)
    return x.reshape(len(x), PARTS, width // PARTS)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries; in doubles where these hold every whole number on the way."""
    if x.dtype != object and entries.dtype != object and 4 * max(1, x.shape[1]) * max(most(x), most(entries)) ** 2 < 2 ** 52:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)
    gap = x.astype(object)[:, None, :] - entries.astype(object)[None, :, :]
    return (gap * gap).sum(axis=2) if x.shape[1] else np.zeros(gap.shape[:2], np.int64)


def nearest(x: np.ndarray, entries: np.ndarray, which: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The nearest of the entries, or of those in `which` (rising), and its distance."""
    all_ = distances(x, entries if which is None else entries[which])
    best = all_.argmin(axis=1)
    return best if which is None else which[best], all_[np.arange(len(x)), best]


def reassigned(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray,
               known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and distances of one part position after some entries have moved. `known` tells which distances are stored."""
    code, distance = code.copy(), distance.astype(object)
    stays = known & ~moved[code]
    active = np.flatnonzero(moved)
    if len(active) and stays.any():
        rows = np.flatnonzero(stays)
        other, gap = nearest(x[rows], entries, active)
        better = ((gap < distance[rows]) | ((gap == distance[rows]) & (other < code[rows]))).astype(bool)
        code[rows[better]], distance[rows[better]] = other[better], gap[better]
    rows = np.flatnonzero(~stays)
    if len(rows):
        code[rows], distance[rows] = nearest(x[rows], entries)
    return code, distance


def _codebooks(rows: DataFrame, width: int) -> np.ndarray:
    """(parts, entries, numbers) from the rows with the smallest ids; of equal ids the smaller vectors, null ids last."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(ENTRIES).collect()
    x = parts_of(pa.array([r[0] for r in first], pa.list_(pa.float64())), width)
    return np.ascontiguousarray(x.transpose(1, 0, 2))


def _assigned(rows: DataFrame, books: np.ndarray, moved: np.ndarray | None, width: int) -> DataFrame:
    """vec_id, label, embedding with code and distance (null where it is beyond LONG)."""
    kept = ["vec_id", "label", "embedding"]

    def assign(batches):
        for batch in batches:
            x = parts_of(batch.column("embedding"), width)
            codes, gaps = np.zeros((len(x), PARTS), np.int64), np.zeros((len(x), PARTS), object)
            if moved is not None:
                old = batch.column("code").flatten().to_numpy().astype(np.int64).reshape(-1, PARTS)
                before = batch.column("distance").flatten().fill_null(-1).to_numpy().reshape(-1, PARTS)
                known = before >= 0
            for p in range(PARTS):
                codes[:, p], gaps[:, p] = nearest(x[:, p], books[p]) if moved is None else reassigned(
                    x[:, p], books[p], moved[p], old[:, p], before[:, p], known[:, p])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(codes.tolist(), pa.list_(pa.int32())),
                 pa.array([[v if v <= LONG else None for v in map(int, row)] for row in gaps], pa.list_(pa.int64()))],
                [*kept, "code", "distance"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(assign, f"{kinds}, code array<int>, distance array<bigint>")


def _moved_books(rows: DataFrame, books: np.ndarray, width: int) -> np.ndarray:
    """The codebooks with every used entry at the componentwise floor of its parts' mean."""
    size, entries = books.shape[2], books.shape[1]
    step = size + 1  # the sums of an entry's numbers, then how many parts it has

    def terms(batch):
        x = parts_of(batch.column("embedding"), width)
        codes = batch.column("code").flatten().to_numpy().reshape(-1, PARTS)
        for p in range(PARTS):
            order = np.argsort(codes[:, p], kind="stable")
            used, starts = np.unique(codes[order, p], return_index=True)
            for e, rows_ in zip(used.tolist(), np.split(order, starts[1:])):
                yield (p * entries + e) * step, np.concatenate([exact_sum(x[rows_, p]), np.array([len(rows_)], object)])

    found = totals(rows.select("embedding", "code"), terms)
    out = books.astype(object)
    for p in range(PARTS):
        for e in range(entries):
            at = (p * entries + e) * step
            if found.get(at + size):
                out[p, e] = [found[at + k] // found[at + size] for k in range(size)]
    return out.astype(np.int64) if most(out) < 2 ** 61 else out


def compressed(rows: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The usable rows' vec_id, label, code and error, and the codebooks (parts, entries, numbers).

    Rows whose embedding is null or holds null or non-finite components, or any beyond single precision, take no part. Shorter
    vectors, and all if their width is no multiple of 16, count as filled up with zeros. Of equal ids the smaller vectors come
    first for the codebooks, null ids last; with fewer than 64 rows codebooks have as many entries. An error
    beyond LONG is null; codes are exact for any components. No usable rows give no rows and empty codebooks.
    """
    own = usable(rows).select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    width = own.agg(F.max(F.size("embedding"))).first()[0]
    if width is None:
        empty = f"vec_id bigint, label {rows.schema['label'].dataType.simpleString()}, code string, error bigint"
        return own.sparkSession.createDataFrame([], empty), np.zeros((PARTS, 0, 0), np.int64)
    width = -(-width // PARTS) * PARTS
    books, moved = _codebooks(own, width), None
    for _ in range(rounds):
        own = saved(_assigned(own, books, moved, width), "codes")
        new = _moved_books(own, books, width)
        books, moved = new, (new != books).any(axis=2)
    found = _assigned(own, books, moved, width)
    digits = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    total = F.aggregate("distance", F.lit(0).cast("decimal(38,0)"), lambda s, d: (s + d).cast("decimal(38,0)"))
    return found.select("vec_id", "label", digits.alias("code"), total.try_cast("long").alias("error")), books


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in books.ravel()).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds label_error, the sum of the errors of equal labels, null ones together; null if one is missing or it is beyond LONG.

    One row a label is joined back; adaptive execution sends it to all if it measures it small, else splits a hot label.
    """
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    labels = coded.groupBy(F.col("label").alias("own")).agg(
        F.when(F.count("error") == F.count("*"), total.try_cast("long")).alias("label_error"))
    return coded.join(labels, F.col("label").eqNullSafe(F.col("own"))).drop("own")


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    coded, books = compressed(table(prepared(spark), sf_dir, "embeddings"))
    return with_label_errors(saved(coded, "coded")).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """Rounds one after the other, every part against every entry."""
    size = "(SELECT max(len(embedding)) // 16 FROM embeddings)"
    steps = [f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
places AS (SELECT unnest(range(0, 16)) AS p),
parts AS (SELECT r, p, v[p * {size} + 1:(p + 1) * {size}] AS x FROM kept, places),
book0 AS (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 64)"""]
    for k in range(ROUNDS + 1):
        steps.append(f"""
code{k} AS (
  SELECT r, p, e, d FROM (
    SELECT r, p, e, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS d FROM parts JOIN book{k} USING (p))
  QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)""")
        if k < ROUNDS:
            steps.append(f"""
mean{k} AS (
  SELECT p, e, list(floor(s / n)::BIGINT ORDER BY i) AS m FROM (
    SELECT p, e, i, sum(x[i])::DOUBLE AS s, count(*) AS n
    FROM parts JOIN code{k} USING (r, p), (SELECT unnest(range(1, {size} + 1)) AS i) GROUP BY p, e, i) GROUP BY p, e),
book{k + 1} AS (SELECT p, e, coalesce(m, c) AS c FROM book{k} LEFT JOIN mean{k} USING (p, e))""")
    return ",".join(steps) + f""",
coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM code{ROUNDS} GROUP BY r),
books AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), books
"""


OP13_SQL = _sql()
