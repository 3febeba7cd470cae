"""Exact search for the largest inner products with an M-tree.

Inner products become distances: a vector v gets one more component, the root of M - |v|^2 with M the largest squared
length, and a query a zero. Then |q - v|^2 = |q|^2 + M - 2 q.v, so the nearest vectors have the largest products. Vectors go
to the page of their nearest routing vector. A page keeps its routing vector and covering radius, inside it leaves with
theirs, and each vector's distance to its leaf's. Best-first search takes leaves by their least possible distance, and spares
vectors whose stored distance to the leaf differs too much from the query's. Products are whole numbers and exact;
bounds leave room for rounding.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pageflow.llm.common import prepared, saved, table
from pageflow.llm.dense import LARGEST

SCALE = 1024
# Routing vectors, fitted on a sample of as many rows times four, vectors of a page, and queries of a block.
ROUTES, PAGE, QUERIES = 128, 2048, 1024
SLACK = 1e-6


# Digits to the base 2^60 of a score, the first with its sign, so that arrays of them are in the order of the scores. Single
# precision gives scores below 2^300.
DIGITS, DIGIT = 5, 60


def whole(embedding: Column) -> Column:
    """floor(1024 * x) of every component, as doubles: beyond 2^53 a double is a whole number itself."""
    def floor(y: Column) -> Column:
        return F.when(F.abs(y) < 2.0 ** 53, F.floor(y).cast("double")).otherwise(y)

    return F.transform(embedding, lambda x: floor(x.cast("double") * SCALE))


def usable(rows: DataFrame) -> DataFrame:
    """vec_id and v (whole numbers): rows with an id and only finite components."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) > LARGEST))
    return rows.where("vec_id is not null and embedding is not null").where(~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole(F.col("embedding")).alias("v"))


def vectors(column, width: int) -> np.ndarray:
    """Lists of numbers as rows, shorter ones filled up with zeros."""
    lists = column.to_pylist()
    out = np.zeros((len(lists), width))
    for k, one in enumerate(lists):
        out[k, :len(one)] = one
    return out


def products(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in doubles or LONG where these hold every sum, else as Python's numbers."""
    largest = np.abs(v).max(initial=0) * np.abs(q).max(initial=0) * max(1, v.shape[1])
    if largest < 2.0 ** 52:
        return (v @ q).astype(np.int64)
    if largest < 2.0 ** 62:
        return v.astype(np.int64) @ q.astype(np.int64)
    exact = np.frompyfunc(int, 1, 1)
    return (exact(v).astype(object) * exact(q).astype(object)[None, :]).sum(axis=1)


def below(score: int) -> float:
    """A double that is not above the score."""
    return math.nextafter(float(score), -math.inf)


def digits(score: int) -> list[int]:
    top = DIGITS - 1
    return [score >> DIGIT * top, *[(score >> DIGIT * place) & (2 ** DIGIT - 1) for place in range(top - 1, -1, -1)]]


def lifted(v: np.ndarray, most: float) -> np.ndarray:
    """The vectors with their further component."""
    rest = np.sqrt(np.maximum(0, most - (v * v).sum(axis=1)))
    return np.concatenate([v, rest[:, None]], axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(0, square))


class Page:
    """Leaves with centre and radius, and their vectors with the distance to the centre."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, most: float):
        points = lifted(v, most)
        count = max(1, math.isqrt(len(ids)))
        centres = [0]  # each next centre is the vector farthest from those before
        near = distances(points, points[:1]).ravel()
        while len(centres) < count and near.max() > 0:
            centres.append(int(near.argmax()))
            near = np.minimum(near, distances(points, points[centres[-1]:centres[-1] + 1]).ravel())
        all_ = distances(points, points[centres])
        leaf = all_.argmin(axis=1)
        order = np.lexsort((ids, leaf))
        self.ids, self.v, self.most = ids[order], v[order], most
        self.parent = all_[np.arange(len(ids)), leaf][order]
        self.centres = points[centres]
        self.ends = np.searchsorted(leaf[order], np.arange(len(centres)), side="right")
        self.starts = np.r_[0, self.ends[:-1]]
        self.radius = np.array([self.parent[s:e].max() if e > s else 0.0 for s, e in zip(self.starts, self.ends)])

    def search(self, q: np.ndarray, own: int, to_centres: np.ndarray, least: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """ids and products of the k best, equal ones by smaller id. None that a `least` below the k-th rules out."""
        size = float((q * q).sum())
        ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        bound = np.maximum(0, to_centres - self.radius)
        room = SLACK * (math.sqrt(size + self.most) + 1)
        for leaf in np.argsort(bound, kind="stable").tolist():
            reach = math.sqrt(max(0.0, size + self.most - 2.0 * least)) + room
            if bound[leaf] > reach:
                break
            s, e = int(self.starts[leaf]), int(self.ends[leaf])
            near = np.flatnonzero(np.abs(self.parent[s:e] - to_centres[leaf]) <= reach) + s
            near = near[self.ids[near] != own]
            found = products(self.v[near], q)
            good = np.asarray(found >= least, bool)
            if good.any():
                ids, scores = np.r_[ids, self.ids[near[good]]], np.r_[scores, found[good]]
                if scores.dtype == object:
                    best = sorted(range(len(ids)), key=lambda n: (-scores[n], ids[n]))[:k]
                else:
                    best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
                if len(ids) == k:
                    least = max(least, below(int(scores[-1])))
        return ids, scores


def _packed(*arrays: np.ndarray) -> list[bytes]:
    return [np.ascontiguousarray(a).tobytes() for a in arrays]


def _page_of(row: dict, width: int, most: float) -> Page:
    page = Page.__new__(Page)
    page.ids, page.v = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["v"], np.float64).reshape(-1, width)
    page.parent, page.radius = np.frombuffer(row["parent"], np.float64), np.frombuffer(row["radii"], np.float64)
    page.centres = np.frombuffer(row["centres"], np.float64).reshape(-1, width + 1)
    page.starts, page.ends, page.most = np.frombuffer(row["starts"], np.int64), np.frombuffer(row["ends"], np.int64), most
    return page


PAGE_SCHEMA = "route int, share int, reach double, ids binary, v binary, parent binary, radii binary, centres binary, starts binary, ends binary"


class Index:
    """The routing vectors and the table of pages."""

    def __init__(self, pages: DataFrame, routes: np.ndarray, width: int, most: float):
        self.pages, self.routes, self.width, self.most = pages, routes, width, most


def build(rows: DataFrame) -> Index:
    """An index of all `rows` (vec_id, v).

    The routing vectors are chosen from a sample of at most 4 * `ROUTES` rows (the smallest hashes), each the farthest from those
    before. A route with more than `PAGE` vectors has several pages, dealt by the hash of the id, so that equal vectors
    do not end in one page.
    """
    row = rows.agg(F.max(F.size("v")).alias("width"), F.max(F.aggregate(
        "v", F.lit(0.0), lambda s, x: s + x * x)).alias("most")).first()
    width, most = int(row["width"] or 0), float(row["most"] or 0)
    sample = rows.orderBy(F.xxhash64("v", "vec_id"), "vec_id").limit(4 * ROUTES).select("v").toArrow()
    points = lifted(vectors(sample.column("v"), width), most)
    chosen = [0] if len(points) else []
    near = distances(points, points[:1]).ravel() if len(points) else np.empty(0)
    while len(chosen) < ROUTES and len(near) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(points, points[chosen[-1]:chosen[-1] + 1]).ravel())
    routes = points[chosen]

    def assign(batches):
        for batch in batches:
            v = vectors(batch.column(1), width)
            far = distances(lifted(v, most), routes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(far.argmin(axis=1).astype(np.int32)), batch.column(0), pa.array([r.tobytes() for r in v], pa.binary())],
                ["route", "vec_id", "v"])

    if not chosen:
        return Index(rows.sparkSession.createDataFrame([], PAGE_SCHEMA), routes, width, most)
    routed = saved(rows.select("vec_id", "v").mapInArrow(assign, "route int, vec_id bigint, v binary"), "routed")
    shares = routed.groupBy("route").agg(F.ceil(F.count("*") / PAGE).cast("int").alias("shares"))
    dealt = routed.join(shares, "route").withColumn("share", F.pmod(F.xxhash64("vec_id", "v"), F.col("shares")).cast("int"))

    def make(group: pa.Table) -> pa.Table:
        route = group.column("route")[0].as_py()
        v = np.frombuffer(b"".join(group.column("v").to_pylist()), np.float64).reshape(-1, width)
        page = Page(group.column("vec_id").to_numpy(), v, most)
        reach = float(distances(lifted(v, most), routes[route:route + 1]).max())
        data = _packed(page.ids, page.v, page.parent, page.radius, page.centres, page.starts, page.ends)
        return pa.table([pa.array([route], pa.int32()), group.column("share").combine_chunks()[:1], pa.array([reach]),
                         *[pa.array([d], pa.binary()) for d in data]],
                        names=["route", "share", "reach", "ids", "v", "parent", "radii", "centres", "starts", "ends"])

    pages = dealt.select("route", "share", "vec_id", "v").groupBy("route", "share").applyInArrow(make, PAGE_SCHEMA)
    return Index(saved(pages, "pages"), routes, width, most)


BEST = "query_id bigint, vec_id bigint, score bigint, low double, digits array<bigint>"


def _searched(pairs: DataFrame, index: Index, k: int) -> DataFrame:
    """The k best in its page for each query of (page, query_ids, qs, leasts), lists of equal length."""
    width, most = index.width, index.most

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                page = _page_of(row, width, most)
                qs = np.frombuffer(b"".join(row["qs"]), np.float64).reshape(-1, width)
                flat = np.concatenate([qs, np.zeros((len(qs), 1))], axis=1)
                to_centres = distances(flat, page.centres)
                for query, q, least, far in zip(row["query_ids"], qs, row["leasts"], to_centres):
                    ids, scores = page.search(q, query, far, least, k)
                    out += [(query, int(i), s if -2 ** 63 <= s < 2 ** 63 else None, below(s), digits(s))
                            for i, s in zip(ids, map(int, scores))]
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64())))],
                ["query_id", "vec_id", "score", "low", "digits"])

    return pairs.mapInArrow(run, BEST)


LOWEST = -math.inf


def search(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest products of each query (query_id, v) with every vector but its own.

    First each query searches one page of its nearest route, which gives a bound on its k-th score. Then blocks of
    queries go to the pages that the triangle inequality does not rule out for all of them. Pages and blocks meet by
    an equality join on the route, and each task searches one page for one block.
    """
    routes, width, most = index.routes, index.width, index.most
    if not len(routes):
        return queries.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")

    def nearest(batches):
        for batch in batches:
            v = vectors(batch.column(1), width)
            flat = np.concatenate([v, np.zeros((len(v), 1))], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in v], pa.binary()),
                 pa.array(distances(flat, routes).argmin(axis=1).astype(np.int32))], ["query_id", "q", "route"])

    asked = saved(queries.select("query_id", "v").mapInArrow(nearest, "query_id bigint, q binary, route int"), "queries")
    blocks = F.pmod(F.xxhash64("query_id"), F.lit(max(1, math.ceil(asked.count() / QUERIES)))).cast("int").alias("block")

    def listed(rows: DataFrame, *by: str) -> DataFrame:
        """Queries of a block as lists: about `QUERIES` at most."""
        one = F.sort_array(F.collect_list(F.struct("query_id", "q", "least")))
        lists = rows.groupBy(*by).agg(one.alias("all"))
        return lists.select(*by, F.col("all.query_id").alias("query_ids"), F.col("all.q").alias("qs"), F.col("all.least").alias("leasts"))

    lowest = asked.select("query_id", "q", "route", F.lit(LOWEST).alias("least"), blocks)
    home = index.pages.where("share = 0").join(listed(lowest, "route", "block"), "route")
    first = _searched(home, index, k)
    bound = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("low").alias("least")).where(F.col("n") >= k)
    known = saved(asked.join(bound.select("query_id", "least"), "query_id", "left").select(
        "query_id", "q", F.coalesce("least", F.lit(LOWEST)).alias("least"), blocks), "bounds")
    block_lists = saved(listed(known, "block"), "blocks")

    def routes_of(batches):
        """For each block, the routes and how far a page of that route must reach to matter for any of its queries."""
        for batch in batches:
            out = []
            for block, qs, leasts in zip(*(batch.column(c).to_pylist() for c in ("block", "qs", "leasts"))):
                q = np.frombuffer(b"".join(qs), np.float64).reshape(-1, width)
                flat = np.concatenate([q, np.zeros((len(q), 1))], axis=1)
                size = (flat * flat).sum(axis=1) + most
                reach = np.sqrt(np.maximum(0.0, size - 2.0 * np.array(leasts, np.float64))) + SLACK * (np.sqrt(size) + 1)
                need = (distances(flat, routes) - reach[:, None]).min(axis=0)
                out += [(block, r, float(x)) for r, x in enumerate(need)]
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.float64())],
                ["block", "route", "need"])

    needed = block_lists.mapInArrow(routes_of, "block int, route int, need double")
    met = index.pages.select("route", "share", "reach").join(needed, "route").where("reach >= need").select("route", "share", "block")
    pairs = index.pages.join(met, ["route", "share"]).join(block_lists, "block")
    best = _searched(pairs.repartition("route", "share", "block"), index, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("digits"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def top_products(rows: DataFrame, asked: DataFrame, k: int = 10) -> DataFrame:
    """The k largest products of the rows `asked` with all `rows` (vec_id, embedding).

    Rows whose id is null, or whose embedding is null or holds null or non-finite components, or any beyond single precision,
    take no part. All others are ranked by their exact products; a score beyond LONG is null. No rows give none. Shorter vectors
    count as filled up with zeros. Of asked rows with one id the smallest vector asks; no row with that id is a
    candidate. Candidates with equal ids are told apart by nothing and listed each. Other columns are ignored.
    """
    queries = usable(asked).groupBy("vec_id").agg(F.min("v").alias("v")).withColumnRenamed("vec_id", "query_id")
    return search(build(usable(rows)), queries, k)


def op9_mtree(spark, sf_dir: str) -> DataFrame:
    rows = table(prepared(spark), sf_dir, "embeddings")
    return top_products(rows, rows.where("vec_id % 100 = 0"))


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""
