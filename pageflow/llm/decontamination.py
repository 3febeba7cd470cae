"""Documents searched for passages of test sets, by a broadcast hash set of the sets' word n-grams.

Words are runs of ASCII letters and digits and of everything beyond ASCII, A-Z lower-cased. The test items are cut into windows
of ten words; an item of fewer words is one window. All executors get the items' words as numbers and the sorted hashes of
their different windows. A task gives the words of its documents the same numbers, hashes only windows whose words all
occur in the test sets, and compares each hit word by word, so that no hash decides alone.

Test sets are sent in blocks of bounded size. Each further block is a further pass over the documents, so neither the
driver nor a worker ever holds more than one block.
"""

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pageflow.llm.common import gram_hashes, mixed, prepared, saved, table

N = 10
# Bytes of words of a block, and words of a piece of a long item.
BLOCK, PIECE = 32_000_000, 100_000
# A-Z become a-z, what is no letter, digit or beyond ASCII becomes a blank.
NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
PLACES = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SPANS = "array<struct<start:int,stop:int>>"
FOUND = f"n_words bigint, spans {SPANS}, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(NORMAL).split()


class Windows:
    """The different windows of a block of test items.

    `ids` numbers the words, `flat` has the items' words as numbers. For each window length: sorted hashes, a place in
    `flat` where the window stands, and the numbers of the items that have it (`names`, sorted as strings).
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], n: int):
        self.names = sorted({name for name, _ in items if name is not None})
        number = {name: k for k, name in enumerate(self.names)} | {None: -1}
        self.ids: dict[bytes, int] = {}
        sizes = np.array([len(words) for _, words in items], np.int64)
        self.flat = np.fromiter((self.ids.setdefault(w, len(self.ids)) for _, words in items for w in words), np.int64, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        owner = np.array([number[name] for name, _ in items], np.int64)
        lengths = np.minimum(sizes, n)
        self.seed, self.by_length = 0, {}
        for length in sorted(set(lengths[lengths > 0].tolist())):
            own = np.flatnonzero(lengths == length)
            counts = sizes[own] - length + 1
            first = np.repeat(starts[own] - (np.cumsum(counts) - counts), counts)
            self.by_length[length] = (first + np.arange(counts.sum()), np.repeat(owner[own], counts))
        while not self._grouped():  # until no two different windows have one hash
            self.seed += 1

    def hashes(self, ids: np.ndarray, length: int) -> np.ndarray:
        return gram_hashes(mixed(ids.astype(np.uint64) + np.uint64(self.seed << 32)), length)

    def _grouped(self) -> bool:
        self.tables = {}
        for length, (places, owner) in self.by_length.items():
            hashes = self.hashes(self.flat, length)[places]
            order = np.lexsort((owner, hashes))
            hashes, places_, owner_ = hashes[order], places[order], owner[order]
            new = np.r_[True, hashes[1:] != hashes[:-1]]
            group = np.cumsum(new) - 1
            first = places_[new]
            for k in range(length):
                if (self.flat[places_ + k] != self.flat[first[group] + k]).any():
                    return False
            # each item once a window
            once = (owner_ >= 0) & (new | np.r_[True, owner_[1:] != owner_[:-1]])
            ends = np.cumsum(np.bincount(group[once], minlength=len(first)))
            self.tables[length] = (hashes[new], first, ends, owner_[once])
        return True

    def search(self, ids: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Where windows of this length stand in the documents' words, and which windows they are."""
        if len(ids) < length:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        table_, first = self.tables[length][:2]
        unknown = np.r_[0, np.cumsum(ids < 0)]
        places = np.flatnonzero((unknown[length:] == unknown[:-length]) & (owner[:len(ids) - length + 1] == owner[length - 1:]))
        hashes = self.hashes(ids, length)[places]
        at = np.minimum(np.searchsorted(table_, hashes), len(table_) - 1)
        hit = table_[at] == hashes
        places, at = places[hit], at[hit]
        same = np.ones(len(places), bool)
        for k in range(length):
            same &= ids[places + k] == self.flat[first[at] + k]
        return places[same], at[same]


def _spans(covered: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def scanned(texts: list, windows: Windows) -> list[tuple[int, list, list]]:
    """For each text its number of words, the spans of words in test windows, and the names of the items they are from."""
    lists = [words_of(text) for text in texts]
    sizes = np.array([len(words) for words in lists], np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(lists)), sizes)
    get = windows.ids.get
    ids = np.fromiter((get(w, -1) for words in lists for w in words), np.int64, int(sizes.sum()))
    steps, items = np.zeros(len(ids) + 1, np.int64), [set() for _ in lists]
    for length, (_, _, last, owners) in windows.tables.items():
        places, at = windows.search(ids, owner, length)
        np.add.at(steps, places, 1)
        np.add.at(steps, places + length, -1)
        # each different window of a text once
        for doc, window in np.unique(np.c_[owner[places], at], axis=0).tolist():
            items[doc].update(owners[last[window - 1] if window else 0:last[window]].tolist())
    covered = np.cumsum(steps[:-1]) > 0
    return [(int(size), _spans(covered[end - size:end]), [windows.names[k] for k in sorted(own)])
            for size, end, own in zip(sizes, ends, items)]


def _pieces(items: DataFrame, n: int) -> DataFrame:
    """item_id (as a string) and words, long items in pieces that share n - 1 words; equal ones once."""
    def cut(batches):
        for batch in batches:
            out = []
            for name, text in zip(*(batch.column(c).to_pylist() for c in ("item_id", "text"))):
                words = words_of(text)
                out += [(name, b" ".join(words[at:at + PIECE + n - 1])) for at in range(0, max(1, len(words) - n + 1), PIECE) if words]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.binary())], ["item_id", "words"])

    rows = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return saved(rows.mapInArrow(cut, "item_id string, words binary").distinct(), "test-items")


def search(docs: DataFrame, items: DataFrame, n: int = N, texts: bool = True) -> DataFrame:
    """The documents' doc_id, text (if asked) with n_words, spans (start, stop in words) and items (ids as strings).

    One scan for each block of test items; the rows in between are written, so that no block's pass is done again.
    Spans of several blocks may overlap, those of one do not.
    """
    spark, pieces = docs.sparkSession, _pieces(items, n)
    size = pieces.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    count = max(1, math.ceil(size / BLOCK))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("n_words"),
                       F.array().cast(SPANS).alias("spans"), F.array().cast("array<string>").alias("items"))
    part = F.pmod(F.xxhash64("item_id", "words"), F.lit(count))
    for block in range(count):
        own = [(r["item_id"], bytes(r["words"]).split()) for r in pieces.where(part == block).collect()]
        sent, last = spark.sparkContext.broadcast(Windows(own, n)), block == count - 1
        kept = ["doc_id", "text"] if texts or not last else ["doc_id"]

        def scan(batches, sent=sent, kept=kept):
            for batch in batches:
                found = scanned(batch.column("text").to_pylist(), sent.value)
                earlier = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
                merged = [([*old, *({"start": a, "stop": b} for a, b in spans)], sorted({*names, *items_}))
                          for (old, names), (_, spans, items_) in zip(earlier, found)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in kept], pa.array([f[0] for f in found], pa.int64()),
                     pa.array([m[0] for m in merged], pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                     pa.array([m[1] for m in merged], pa.list_(pa.string()))],
                    [*kept, "n_words", "spans", "items"])

        rows = rows.mapInArrow(scan, f"doc_id bigint, {'text string, ' * ('text' in kept)}{FOUND}")
        if not last:
            rows = saved(rows, "searched")
    return rows


def contamination(docs: DataFrame, items: DataFrame, n: int = N) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document.

    A word is hit if it lies in an occurrence of a window of an item (item_id, text). Null and empty texts have no words,
    as documents and as items; texts of any length are searched whole. Every row is a document, also of null or equal
    ids. Items of one id are one item; what items without an id hold is hit, but they are not counted or
    listed. Without documents there are no rows, without items nothing is hit. Other columns are ignored.
    """
    # Of spans in order, the words that none before has.
    union = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).alias("words"), F.lit(0).alias("upto")),
        lambda acc, s: F.struct(
            (acc["words"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], acc["upto"]))).alias("words"),
            F.greatest(acc["upto"], s["stop"]).alias("upto")))
    return search(docs, items, n, texts=False).select(
        "doc_id", "n_words", union["words"].cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def without_spans(text: str, spans: list[dict]) -> str:
    """The text without these words and what stands between words of one span."""
    data = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in PLACES.finditer(data)]
    out, upto = [], 0
    for s in sorted(spans, key=lambda s: s["start"]):
        start, stop = places[s["start"]][0], places[s["stop"] - 1][1]
        out.append(data[upto:max(upto, start)])
        upto = max(upto, stop)
    return b"".join([*out, data[upto:]]).decode("utf-8", "surrogatepass")


def decontaminated(docs: DataFrame, items: DataFrame, remove: str = "spans", n: int = N) -> DataFrame:
    """doc_id and text without what test items hold: their words (remove="spans"), or documents that have any ("documents").

    A text of which nothing goes stays as it is, null included. Rows are handled as in `contamination`.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"no such choice: {remove!r}")
    found = search(docs, items, n)
    if remove == "documents":
        return found.where(F.size("spans") == 0).select("doc_id", "text")

    def cut(batches):
        for batch in batches:
            texts = [without_spans(t, s) if s else t for t, s in zip(*(batch.column(c).to_pylist() for c in ("text", "spans")))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return found.mapInArrow(cut, "doc_id bigint, text string")


def op11_decontamination(spark, sf_dir: str) -> DataFrame:
    prepared(spark)
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Every window of every document against every window of an item of its length.
OP11_SQL = """
WITH texts AS (
  SELECT true AS doc, doc_id AS id, text FROM documents UNION ALL SELECT false, item_id, text FROM benchmark),
words AS (
  SELECT doc, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM texts),
items AS (
  SELECT id AS item_id, least(10, len(w)) AS n, w FROM words WHERE NOT doc AND len(w) > 0),
tests AS (
  SELECT DISTINCT item_id, n, unnest(list_transform(range(0, len(w) - n + 1), lambda i: array_to_string(w[i + 1:i + n], ' '))) AS g FROM items),
lengths AS (SELECT DISTINCT n FROM items),
windows AS (
  SELECT id AS doc_id, n, unnest(range(0, len(w) - n + 1)) AS pos,
    unnest(list_transform(range(0, len(w) - n + 1), lambda i: array_to_string(w[i + 1:i + n], ' '))) AS g
  FROM words, lengths WHERE doc AND len(w) >= n),
hits AS (SELECT doc_id, pos, n, item_id FROM windows JOIN tests USING (n, g)),
covered AS (SELECT doc_id, len(list_distinct(flatten(list(range(pos, pos + n))))) AS n_hit FROM hits GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered ON covered.doc_id = id LEFT JOIN named ON named.doc_id = id WHERE doc
"""
