"""Near-duplicate documents by HyperMinHash registers, banding, and exact confirmation.

A document's set of word pairs becomes 160 registers. A register keeps, of the smallest hash under its own hash
function, only the number of leading zeros and ten bits after them: two bytes instead of eight, whatever the size of
the set. Every register has its own function instead of a share of one, so that short texts fill all of them. Five equal
registers make two sets candidates; 32 such bands miss a pair of similarity 0.8 once in 300,000. Candidates are
compared by all their registers, corrected for chance collisions, and what may be similar is confirmed on the whole sets.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pageflow.llm.common import gram_hashes, mixed, prepared, saved, table, word_hashes, words_of
from pageflow.llm.graphs import components

BANDS, ROWS, MANTISSA = 32, 5, 10
REGISTERS = BANDS * ROWS
# Two unequal minima have as many leading zeros in about 0.4 of all cases, and then the same mantissa by chance.
COLLISION = 0.4 / (1 << MANTISSA)
# Per cent of the union that must be shared.
SIMILAR = 80
# Estimates below this are not confirmed: more than five standard errors under the limit. The first round takes the
# likely links alone.
POSSIBLE, LIKELY = 0.63, 0.74
# Candidates of the second round are compared by so many of their smallest hashes first: whole sets, if they have fewer.
# What is then an estimate may be so many standard errors under the limit.
HEAD, ERRORS = 1024, 5
# Members of a bucket compared at a time; larger buckets are compared block by block. Pairs compared at a time.
BLOCK, SLICE = 2048, 1 << 18
# Ids sent to all executors at most; beyond that they are joined.
SENT = 500_000

_RANDOM = np.random.default_rng(20240301)
FACTORS = _RANDOM.integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _RANDOM.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)
LAST = np.iinfo(np.uint64).max


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's word pairs; of the one word if there is no other."""
    words = words_of(text, lower=True)
    hashes = word_hashes(words)
    return mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)) if len(words) == 1 else np.unique(gram_hashes(hashes, 2))


def registers(hashes: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of the smallest value under each function; the set is taken in slices of bounded size."""
    least = np.full(REGISTERS, LAST, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), 2048):
            np.minimum(least, (FACTORS[:, None] * hashes[None, at:at + 2048] + OFFSETS[:, None]).min(axis=1), out=least)
    top = np.floor(np.log2(np.maximum(least, 1).astype(np.float64))).astype(np.int64).clip(0, 63)
    zeros = (63 - top).astype(np.uint64)
    rest = (least << np.minimum(zeros + np.uint64(1), np.uint64(63))) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | rest).astype(np.uint16)


def node_of(hashes: np.ndarray) -> int:
    """A number for the whole set: equal sets have equal numbers."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, node and registers; no node for a document without words or without doc_id."""
    def run(batches):
        for batch in batches:
            rows = []
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = shingles(text)
                alone = number is None or not len(own)
                rows.append((number, len(own), None if alone else node_of(own), None if alone else registers(own).tobytes()))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
                 pa.array(columns[3], pa.binary())], ["doc_id", "n_shingles", "node", "registers"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, node bigint, registers binary")


def matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def bands(classes: DataFrame) -> DataFrame:
    """(key, node) for every band of every set; the last bits of a key are the band's number."""
    def run(batches):
        for batch in batches:
            nodes, rows = batch.column(0).to_numpy(zero_copy_only=False), matrix(batch.column(1))
            keys = np.zeros((len(rows), BANDS), np.uint64)
            with np.errstate(over="ignore"):
                for r in range(ROWS):
                    keys = mixed(keys * np.uint64(31) + rows[:, r::ROWS].astype(np.uint64) + np.uint64(1))
            keys = (keys & ~np.uint64(BANDS - 1)) | np.arange(BANDS, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(nodes, BANDS))], ["key", "node"])

    return classes.select("node", "registers").mapInArrow(run, "key bigint, node bigint")


def _pairs(starts: list[int], ends: list[int], sides: np.ndarray):
    """(left, right, group) of all pairs of each group, `SLICE` or so at a time; only pairs across if a group's members come
    from two blocks. A pair of groups of one block is told by its side alone."""
    held, size = [], 0
    for start, end, two in zip(starts, ends, sides):
        first = np.arange(start, end)
        split = start + int(two) if two > 0 else 0
        lefts = np.arange(start, split) if two > 0 else first
        step = max(1, SLICE // (end - start))
        for at in range(0, len(lefts), step):
            some = lefts[at:at + step]
            if two > 0:
                left, right = np.repeat(some, end - split), np.tile(np.arange(split, end), len(some))
            else:
                left, right = np.repeat(some, end - start), np.tile(first, len(some))
                left, right = left[left < right], right[left < right]
            held.append((left, right, np.full(len(left), start)))
            size += len(left)
            if size >= SLICE:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _forest(left, right, estimate) -> list[int]:
    """The pairs of a spanning forest, the most similar first."""
    up: dict[int, int] = {}

    def top(x):
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    chosen = []
    for k in np.argsort(-estimate, kind="stable"):
        a, b = top(int(left[k])), top(int(right[k]))
        if a != b:
            up[a] = b
            chosen.append(int(k))
    return chosen


def alike(heads: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the sets of each pair may be similar, by their smallest hashes; exact for sets of fewer than `HEAD`.

    Both sets are known up to the lower of their last hashes, and what they share up to there is what both heads have.
    `left` is sorted.
    """
    lasts = np.array([h[-1] if len(h) >= HEAD else LAST for h in heads], np.uint64)
    sizes = np.array([len(h) for h in heads])
    cuts = np.flatnonzero(np.diff(left)) + 1
    close = []
    for rights in np.split(np.arange(len(left)), cuts) if len(left) else ():
        own, last, others = heads[left[rights[0]]], lasts[left[rights[0]]], right[rights]
        all_ = np.concatenate([heads[x] for x in others])
        starts = np.r_[0, np.cumsum(sizes[others])[:-1]]
        hit = own[np.minimum(np.searchsorted(own, all_), len(own) - 1)] == all_
        both = np.add.reduceat(hit, starts, dtype=np.int64)
        known = np.searchsorted(own, lasts[others], "right") + np.add.reduceat(all_ <= last, starts, dtype=np.int64)
        union = known - both
        whole = (last == LAST) & (lasts[others] == LAST)
        slack = np.where(whole, 0.0, ERRORS * 100 * np.sqrt(SIMILAR / 100 * (1 - SIMILAR / 100) * union))
        close.append(100 * both >= SIMILAR * union - slack)
    return np.concatenate(close) if close else np.empty(0, bool)


def compared(members: DataFrame, first: bool) -> DataFrame:
    """Pairs (a, b) of nodes that may be similar, out of `members` (key, cnt, node, n, root, registers, head).

    A pair is looked at in the first band that it shares alone. In the first round, which has no heads, a group
    yields the likely links that hold it together, and (a, a) for every node with a possible link; in the second all
    possible links between different roots.
    """
    blocks = F.ceil(F.col("cnt") / BLOCK).cast("int")
    own = members.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "n", "root", "registers", "head")
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "own", "node")

    def groups(batches):
        """Tables of whole groups."""
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            marks = [held.column(c).to_numpy() for c in ("key", "i", "j")]
            last = np.flatnonzero(np.logical_or.reduce([m[1:] != m[:-1] for m in marks]))
            if len(last):
                yield held.slice(0, int(last[-1]) + 1)
                held = held.slice(int(last[-1]) + 1)
        if held is not None and len(held):
            yield held

    def run(batches):
        for rows in groups(batches):
            key, i, j, own_, node, n, root = (rows.column(c).to_numpy() for c in ("key", "i", "j", "own", "node", "n", "root"))
            values = matrix(rows.column("registers"))
            heads = None if first else [np.frombuffer(x, np.uint64) for x in rows.column("head").to_pylist()]
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
            ends = np.r_[starts[1:], len(key)]
            # How many of a group's members are of its first block, if it has two; none to compare if one is empty.
            sides = np.array([int(np.searchsorted(own_[s:e], j[s])) if i[s] != j[s] else -1 for s, e in zip(starts, ends)])
            open_ = (ends - starts > 1) & (sides != 0) & (sides != ends - starts)
            found = []
            for left, right, group in _pairs(starts[open_].tolist(), ends[open_].tolist(), sides[open_]):
                like = 100 * np.minimum(n[left], n[right]) >= SIMILAR * np.maximum(n[left], n[right])
                like &= (root[left] != root[right]) | first
                left, right, group = left[like], right[like], group[like]
                estimate, good = np.empty(len(left)), np.empty(len(left), bool)
                for at in range(0, len(left), 4096):
                    a, b = left[at:at + 4096], right[at:at + 4096]
                    equal = values[a] == values[b]
                    estimate[at:at + 4096] = (equal.mean(axis=1) - COLLISION) / (1 - COLLISION)
                    shared = equal.reshape(-1, BANDS, ROWS).all(axis=2)
                    good[at:at + 4096] = shared.argmax(axis=1) == (key[a] & (BANDS - 1))
                good &= estimate >= POSSIBLE
                left, right, group, estimate = left[good], right[good], group[good], estimate[good]
                if not first:
                    close = alike(heads, left, right)
                    left, right, group, estimate = left[close], right[close], group[close], estimate[close]
                found.append((left, right, group, estimate))
            if not found:
                continue
            left, right, group, estimate = (np.concatenate(x) for x in zip(*found))
            pairs = [node[left], node[right]]
            if first and len(left):
                alone = np.unique(np.r_[node[left], node[right]])
                likely = np.flatnonzero(estimate >= LIKELY)
                likely = likely[np.argsort(group[likely], kind="stable")]
                cuts = np.flatnonzero(group[likely][1:] != group[likely][:-1]) + 1
                chosen = []
                for some in np.split(likely, cuts) if len(likely) else ():
                    chosen += some.tolist() if len(some) < 3 else some[_forest(left[some], right[some], estimate[some])].tolist()
                pairs = [np.r_[node[left[chosen]], alone], np.r_[node[right[chosen]], alone]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(*pairs), pa.int64()), pa.array(np.maximum(*pairs), pa.int64())], ["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def whole_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, hashes) of the named nodes, taken again from the texts. Few ids go to all executors, more are joined."""
    ids = classes.join(nodes, "node", "left_semi").select(F.col("rep").alias("doc_id"))
    ids = saved(ids, "candidate-ids")
    if ids.count() <= SENT:
        ids = F.broadcast(ids)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")

    def run(batches):
        for batch in batches:
            sets = [shingles(text) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["node", "hashes"])

    return texts.select("text").mapInArrow(run, "node bigint, hashes binary").groupBy("node").agg(
        F.first("hashes").alias("hashes"))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar."""
    sides = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= SIMILAR * (len(x) + len(y) - both))
            keep = np.array(keep, bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column(c).to_numpy(zero_copy_only=False)[keep], pa.int64()) for c in ("a", "b")], ["a", "b"])

    return sides.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Equal sets become one class first, so that copies cost one comparison in all. Links are sought in two rounds: the
    likely links that hold each bucket together are confirmed and joined into components, then every possible link that is
    left between different components is confirmed. No link between different texts is lost to a cap.
    Documents without words stay alone. So do rows with null doc_id, whose component_id is null; they are kept. Rows with
    equal doc_id have a row each. Other columns are ignored.
    """
    signed = saved(signatures(docs), "signatures")
    classes = saved(signed.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("registers").alias("registers")), "classes")
    keyed = bands(classes)
    crowded = keyed.groupBy("key").agg(F.count("*").alias("cnt")).where("cnt > 1")
    dense = saved(keyed.join(crowded, "key"), "buckets")
    known = classes.select("node", "n", "registers")
    plain = known.withColumn("root", F.col("node")).withColumn("head", F.lit(None).cast("binary"))
    found = saved(compared(dense.join(plain, "node"), first=True), "pairs")
    sets = saved(whole_sets(docs, classes, found.where("a = b").select(F.col("a").alias("node"))), "sets")
    links = saved(confirmed(found.where("a <> b"), sets), "links")
    roots = saved(components(links), "roots")
    rooted = dense.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = saved(rooted.join(sets.select("node"), "node", "left_semi"), "rooted")
    headed = known.join(sets.select("node", F.substring("hashes", 1, 8 * HEAD).alias("head")), "node")
    open_ = rooted.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
    rest = compared(rooted.join(open_, "key", "left_semi").join(headed, "node"), first=False)
    more = saved(confirmed(rest, sets), "links")
    if more.limit(1).count():
        roots = saved(components(links.union(more)), "roots")
    whole = classes.select("node", "rep").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = whole.groupBy("root").agg(F.min("rep").alias("component"))
    named = whole.join(least, "root").select("node", "component")
    return signed.select("doc_id", "n_shingles", "node").join(named, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component", "doc_id")).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents kept, in the columns they came with; of rows equal in doc_id and text one stays."""
    kept = near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").select(docs.columns)
    return named.dropDuplicates(["doc_id", "text"]).union(docs.where("doc_id is null"))


def op3_near_dup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(prepared(spark), sf_dir, "documents"))


# Every pair of documents that shares a word pair, counted by an engine of its own.
OP3_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE len(w) WHEN 0 THEN [] WHEN 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  WHERE 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
least_of AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN least_of c ON c.x = d.doc_id
"""
