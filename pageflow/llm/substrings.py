"""Long passages that occur more than once, by compaction of a de Bruijn graph of words.

Every run of 35 words is an edge from its first 34 words to its last 34. `grams.counted` tells how often the corpus has
each edge. In each document, neighbouring repeated edges with equal counts are one path; where a count changes, texts part or
meet, and the path ends. Equal paths of all documents are joined by their ends and length. A path that occurs as
often as its edges branches nowhere, and its occurrences are verified by the words at their coordinates. Where texts part and
meet at one node, counts alone do not show it: each class of such paths with equal words is taken apart into single edges
once, verified the same way with the number of its occurrences as weight.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pageflow.llm.common import prepared, saved, table, words_of
from pageflow.llm.grams import Words, characters, chunked, counted, counts_of, part_bits

K, KEEP = 35, 8
# Keys sent to all executors at most; beyond that they are joined.
SENT = 500_000
SCHEMA = """is_path boolean, key bigint, doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, start bigint,
    first bigint, last bigint, size bigint, times bigint, count bigint, digest binary"""


def digest_of(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def covered_by(starts: np.ndarray, size: int, k: int) -> np.ndarray:
    """Which of `size` words lie in a window of k words that starts at one of the places."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + k, -1)
    return np.cumsum(steps[:-1]) > 0


def kept_of(words: list[bytes], covered: np.ndarray) -> tuple[int, int, str]:
    """Number of words, of those removed, and the hash of the rest."""
    removed = int(covered.sum())
    rest = [w for w, c in zip(words, covered.tolist()) if not c] if removed else words
    return len(words), removed, hashlib.sha256(b" ".join(rest)).hexdigest()


def paths(rows: pa.Table, found: pa.Table, k: int) -> pa.Table:
    """A chunk's documents, as if every repeated edge were verified, and the paths of repeated edges in them."""
    words = Words(rows.column("text").to_pylist())
    keys, ids = rows.column("key").to_pylist(), rows.column("doc_id").to_pylist()
    hashes, places = words.grams(k)
    distinct, which = np.unique(hashes, return_inverse=True)
    counts = counts_of(found)[which] if len(distinct) else np.empty(0, np.int64)
    edges, places, counts = hashes[counts > 1], places[counts > 1], counts[counts > 1]
    covered = covered_by(places, len(words.hashes), k)
    out = []
    for d, (key, number, own) in enumerate(zip(keys, ids, words.lists)):
        out.append((False, key, number, *kept_of(own, covered[words.starts[d]:words.ends[d]]), *[None] * 7))
    if len(edges):
        owner = words.owner[places]
        next_ = (places[1:] == places[:-1] + 1) & (owner[1:] == owner[:-1])
        same = next_ & (edges[1:] == edges[:-1])
        loop = np.r_[same, False] | np.r_[False, same]  # an edge that leads to itself: one word again and again
        goes_on = next_ & (counts[1:] == counts[:-1]) & (loop[1:] == loop[:-1]) & (~loop[1:] | same)
        starts = np.flatnonzero(np.r_[True, ~goes_on])
        ends = np.r_[starts[1:], len(edges)]
        signed = edges.view(np.int64)
        for s, e in zip(starts.tolist(), ends.tolist()):
            d = int(owner[s])
            at = int(places[s] - words.starts[d])
            size, times = (1, e - s) if loop[s] else (e - s, 1)
            out.append((True, keys[d], ids[d], None, None, None, at, int(signed[s]), int(signed[e - 1]), size, times,
                        int(counts[s]), digest_of(words.lists[d][at:at + size + k - 1])))
    kinds = [pa.bool_(), *[pa.int64()] * 4, pa.string(), *[pa.int64()] * 6, pa.binary()]
    names = ["is_path", "key", "doc_id", "n_words", "n_removed", "kept_sha256", "start", "first", "last", "size", "times", "count", "digest"]
    columns = list(zip(*out)) or [()] * len(names)
    return pa.table({name: pa.array(c, kind) for name, c, kind in zip(names, columns, kinds)})


def _texts(chunks: DataFrame, keys: DataFrame) -> DataFrame:
    """key, doc_id and text of the named documents. Few keys go to all executors, more are joined."""
    keys = saved(keys, "keys")
    return chunks.select("key", "doc_id", "text").join(F.broadcast(keys) if keys.count() <= SENT else keys, "key", "left_semi")


def _class_windows(texts: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """path, place, digest, n: every window of each class of equal paths, taken from one of its occurrences, which are n."""
    spans = classes.groupBy(F.col("at.key").alias("key")).agg(
        F.collect_list(F.struct(F.col("digest").alias("path"), F.col("at.start").alias("start"), "size", "n")).alias("spans"))

    def run(batches):
        for batch in batches:
            out = []
            for text, own in zip(*(batch.column(c).to_pylist() for c in ("text", "spans"))):
                words = words_of(text)
                out += [(s["path"], i, digest_of(words[s["start"] + i:s["start"] + i + k]), s["n"]) for s in own for i in range(s["size"])]
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.int64())],
                ["path", "place", "digest", "n"])

    return saved(texts.dropDuplicates(["key"]).join(spans, "key").select("text", "spans").mapInArrow(
        run, "path binary, place bigint, digest binary, n bigint"), "class-windows")


def _verified(chunks: DataFrame, suspects: DataFrame, k: int) -> DataFrame:
    """key, start, n: stretches of windows in suspect paths whose words occur twice or more.

    All occurrences of a path with equal words are one class, and a class is taken apart once, whatever the number of its
    occurrences. A class that occurs again is repeated as a whole. A window of one that does not is repeated if other
    windows, weighted with the occurrences of their classes, have the same words. The answer goes back to occurrences as a
    whole path each.
    """
    classes = saved(suspects.groupBy("digest").agg(
        F.sum("times").alias("n"), F.min(F.struct("key", "start")).alias("at"), F.max("size").alias("size")), "classes")
    windows = _class_windows(_texts(chunks, classes.select(F.col("at.key").alias("key")).distinct()), classes, k)
    again = windows.groupBy("digest").agg(F.sum("n").alias("total")).where("total > 1")
    alone = windows.where("n = 1").join(again, "digest", "left_semi").groupBy(F.col("path").alias("digest")).agg(
        F.collect_list(F.struct(F.col("place").alias("from"), F.lit(1).cast("long").alias("n"))).alias("found"))
    whole = classes.where("n > 1").select(
        "digest", F.array(F.struct(F.lit(0).cast("long").alias("from"), F.col("size").alias("n"))).alias("found"))
    verdicts = saved(whole.union(alone), "verdicts")
    size = verdicts.agg(F.sum(F.size("found"))).first()[0] or 0
    joined = suspects.join(F.broadcast(verdicts) if size <= SENT else verdicts, "digest")
    return joined.select("key", "start", "times", F.explode("found").alias("f")).select(
        "key", (F.col("start") + F.col("f.from")).alias("start"), (F.col("f.n") + F.col("times") - 1).alias("n"))


def without_repeats(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document, without the words in repeated windows of k words.

    All occurrences of a repeated window go, the first included. Null and empty texts have no words, and nothing of texts under
    k words is removed. Rows with null or repeated doc_id are documents of their own, so rows equal in doc_id and text
    repeat each other. No documents give no rows. Texts of any length are compared whole; there are no ties to break, as
    all occurrences go. Other columns are ignored.
    """
    total = characters(docs)
    bits = part_bits(total, 1)
    chunks = chunked(docs, total)
    counts = counted(chunks, lambda words: words.grams(k)[0], bits, KEEP)
    found = saved(chunks.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(
        lambda rows, own: paths(rows, own, k), SCHEMA), "paths")
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    own = found.where("is_path")
    joined = own.groupBy("first", "last", "size").agg(
        F.sum("times").alias("n"), F.max("count").alias("count"), F.min("digest").alias("x"), F.max("digest").alias("y"))
    parted = saved(joined.where("n <> count or x <> y").select("first", "last", "size"), "parted")
    done = found.where("not is_path")
    if not parted.limit(1).count():
        return done.select(columns)
    suspects = saved(own.join(parted, ["first", "last", "size"], "left_semi").select("key", "start", "size", "times", "digest"), "suspects")
    keys = saved(suspects.select("key").distinct(), "keys")
    texts = _texts(chunks, keys)
    sure = own.join(parted, ["first", "last", "size"], "left_anti").join(keys, "key", "left_semi").select(
        "key", "start", (F.col("size") + F.col("times") - 1).alias("n"))
    spans = sure.union(_verified(chunks, suspects, k)).groupBy("key").agg(F.collect_set(F.struct("start", "n")).alias("spans"))

    def remove(batches):
        for batch in batches:
            out = []
            for number, text, own_ in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
                words = words_of(text)
                places = np.array([s["start"] + i for s in own_ or () for i in range(s["n"])], np.int64)
                out.append((number, *kept_of(words, covered_by(places, len(words), k))))
            columns_ = list(zip(*out)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns_, kinds)], columns)

    again = texts.join(spans, "key", "left").select("doc_id", "text", "spans").mapInArrow(
        remove, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
    return done.join(keys, "key", "left_anti").select(columns).union(again)


def op10_substrings(spark, sf_dir: str) -> DataFrame:
    return without_repeats(table(prepared(spark), sf_dir, "documents"))


# Every window of every document, grouped by its words.
OP10_SQL = """
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(0, len(w) - 34)) AS pos, unnest(list_transform(range(0, len(w) - 34),
    lambda i: md5(array_to_string(w[i + 1:i + 35], ' ')))) AS g FROM words WHERE len(w) >= 35),
again AS (SELECT g FROM windows GROUP BY g HAVING count(*) > 1),
covered AS (
  SELECT doc_id, list_distinct(flatten(list(range(pos, pos + 35)))) AS c FROM windows SEMI JOIN again USING (g) GROUP BY doc_id),
flags AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM words),
gone AS (SELECT doc_id, unnest(c) AS pos FROM covered),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t, count(*) AS n FROM flags ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""
