"""Counts of word n-grams over a whole corpus, brought back to where the n-grams are.

Documents are dealt into chunks of a few megabytes. A chunk sends each of its distinct n-grams once, with its count
there, to the part that the first bits of the n-gram's hash name; a part adds up the counts and sends them back.
What is shuffled is packed: hashes of a chunk and part are one sorted array, in Elias and Fano's code, which takes about two
bits more than the distance between neighbours needs. A frequent n-gram is one entry a chunk, so no
part is much larger than another, and neither chunks nor parts grow with the corpus.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pageflow.llm.common import gram_hashes, word_hashes, words_of

# Characters of a chunk, distinct n-grams of a part, and the least number of both.
CHUNK, PART, LEAST = 4_000_000, 2_000_000, 64
# What a row counts in a bundle beside its text, so that rows without text fill bundles too.
ROW = 8
# Values under which a list of them is written without a code.
FEW = 64


def chunked(docs: DataFrame, total: int | None = None) -> DataFrame:
    """chunk, key, doc_id, text. `key` is a hash of doc_id and text; rows equal in both share chunk and key."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    size = characters(rows) if total is None else total
    count = max(LEAST, math.ceil(size / CHUNK))
    keyed = rows.withColumn("key", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.coalesce("text", F.lit(""))))
    return keyed.select(F.pmod("key", F.lit(count)).alias("chunk"), "key", "doc_id", "text")


def bundled(docs: DataFrame, total: int, most: int) -> DataFrame:
    """chunk, rows: documents as they come, in bundles of about `most` characters, compressed.

    A task fills its bundles one after the other, so that equal rows and rows without an id spread as others do. A task that
    runs again has to meet the same rows in the same order, as it does where `docs` is read from files; what comes from a
    shuffle is to be written first. `rows_in` opens a bundle.
    """
    limit = max(1, min(most, total // LEAST))

    def close(rows: list, chunk: int) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        whole = pa.Table.from_batches(rows).combine_chunks()
        with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(whole)
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "rows"])

    def bundle(batches):
        first, done, rows, size = TaskContext.get().partitionId() << 32, 0, [], 0
        for batch in batches:
            start = 0
            for at, length in enumerate(pc.utf8_length(batch.column("text")).to_pylist()):
                size += (length or 0) + ROW
                if size >= limit:
                    yield close([*rows, batch.slice(start, at + 1 - start)], first + done)
                    done, rows, size, start = done + 1, [], 0, at + 1
            if start < batch.num_rows:
                rows.append(batch.slice(start))
        if rows:
            yield close(rows, first + done)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(bundle, "chunk bigint, rows binary")


def rows_in(bundles: pa.Table) -> pa.Table:
    """doc_id and text of a bundle's documents."""
    return pa.concat_tables([pa.ipc.open_stream(data).read_all() for data in bundles.column("rows").to_pylist()])


def characters(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.length("text"))).first()[0] or 0


def part_bits(total: int, per_word: int) -> int:
    """Bits of a hash that name its part, for a corpus of so many characters and n-grams for each word."""
    return max(6, math.ceil(math.log2(max(1, total / 6 * per_word / PART))))


class Words:
    """The words of a chunk, document after document; `lists` has the words themselves if asked."""

    def __init__(self, texts: list, lists: bool = True):
        self.lists, hashes = [], [np.empty(0, np.uint64)]
        for text in texts:
            words = words_of(text)
            hashes.append(word_hashes(words))
            if lists:
                self.lists.append(words)
        self.sizes = np.array([len(h) for h in hashes[1:]], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.hashes = np.concatenate(hashes)
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-grams that lie in one document, and the places of their first words."""
        all_ = gram_hashes(self.hashes, n)
        places = np.arange(len(all_))
        inside = self.owner[places] == self.owner[places + n - 1]
        return all_[inside], places[inside]


def _whole(values: np.ndarray, size: int) -> bytes:
    """The last `size` bytes of each value."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _from_whole(data: bytes, size: int) -> np.ndarray:
    wide = np.zeros((len(data) // size if size else 0, 8), np.uint8)
    wide[:, :size] = np.frombuffer(data, np.uint8).reshape(-1, size) if size else 0
    return wide.view("<u8").ravel()


def _low_bits(count: int, width: int) -> int:
    """Bits of a value that are written as they are; the rest is written as steps from one value to the next."""
    return max(0, width - (count.bit_length() - 1))


def packed(values: np.ndarray, width: int) -> bytes:
    """Rising values of `width` bits, repeats allowed. Fewer than `FEW` are written as they are."""
    count = len(values)
    if count < FEW:
        return _whole(values, -(-width // 8))
    low = _low_bits(count, width)
    size, odd = divmod(low, 8)
    high = (values >> np.uint64(low)).astype(np.int64) + np.arange(count)
    steps = np.zeros((1 << (width - low)) + count, np.uint8)
    steps[high] = 1
    rest = ((values >> np.uint64(8 * size)) & np.uint64(255)).astype(np.uint8)
    bits = np.unpackbits(rest[:, None], axis=1, bitorder="little")[:, :odd]
    return _whole(values, size) + np.packbits(bits).tobytes() + np.packbits(steps).tobytes()


def unpacked(data: bytes, count: int, width: int) -> np.ndarray:
    if count < FEW:
        return _from_whole(data, -(-width // 8))
    low = _low_bits(count, width)
    size, odd = divmod(low, 8)
    first, second = count * size, count * size + -(-count * odd // 8)
    values = _from_whole(data[:first], size) if size else np.zeros(count, np.uint64)
    if odd:
        bits = np.unpackbits(np.frombuffer(data[first:second], np.uint8), count=count * odd).reshape(count, odd)
        values = values | np.packbits(bits, axis=1, bitorder="little")[:, 0].astype(np.uint64) << np.uint64(8 * size)
    steps = np.flatnonzero(np.unpackbits(np.frombuffer(data[second:], np.uint8)))
    return values | (steps - np.arange(count)).astype(np.uint64) << np.uint64(low)


def planes(counts: np.ndarray) -> bytes:
    """Counts as their number of bytes, then all last bytes, all second to last ones and so on: mostly equal bytes in a row."""
    size = max(1, -(-int(counts.max(initial=0)).bit_length() // 8))
    return bytes([size]) + np.ascontiguousarray(counts.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    size = data[0]
    wide = np.zeros(((len(data) - 1) // size, 8), np.uint8)
    wide[:, :size] = np.frombuffer(data, np.uint8, offset=1).reshape(size, -1).T
    return wide.view("<i8").ravel()


def counted(chunks: DataFrame, grams, bits: int, keep: int, texts=lambda rows: rows.column("text").to_pylist()) -> DataFrame:
    """chunk, part, counts: for the chunk's distinct n-grams in order of their hashes, how often the corpus has each.

    `grams` gives all n-grams of `Words`; `keep` is how many bytes of a hash tell n-grams of a part apart; `texts` gives
    the texts of a chunk's rows.
    """
    width = min(8 * keep, 64 - bits)

    def send(rows: pa.Table) -> pa.Table:
        hashes, counts = np.unique(grams(Words(texts(rows), lists=False)), return_counts=True)
        parts = (hashes >> np.uint64(64 - bits)).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]]) if len(parts) else np.empty(0, np.int64)
        ends = np.r_[starts[1:], len(parts)]
        spans = list(zip(starts.tolist(), ends.tolist())) if len(parts) else []
        chunk = rows.column("chunk")[0].as_py()
        short = (hashes << np.uint64(bits)) >> np.uint64(64 - width)
        return pa.table({
            "part": pa.array([int(parts[s]) for s, _ in spans], pa.int32()), "chunk": pa.array([chunk] * len(spans), pa.int64()),
            "size": pa.array([e - s for s, e in spans], pa.int32()),
            "hashes": pa.array([packed(short[s:e], width) for s, e in spans], pa.binary()),
            "counts": pa.array([planes(counts[s:e]) for s, e in spans], pa.binary())})

    def add(rows: pa.Table) -> pa.Table:
        sizes = rows.column("size").to_pylist()
        hashes = [unpacked(h, n, width) for h, n in zip(rows.column("hashes").to_pylist(), sizes)]
        own = np.concatenate([from_planes(c) for c in rows.column("counts").to_pylist()])
        values, which = np.unique(np.concatenate(hashes), return_inverse=True)
        totals = np.zeros(len(values), np.int64)
        np.add.at(totals, which, own)
        totals, ends = totals[which], np.cumsum(sizes)
        return pa.table({"chunk": rows.column("chunk"), "part": rows.column("part"),
                         "counts": pa.array([planes(totals[e - s:e]) for s, e in zip(sizes, ends)], pa.binary())})

    sent = chunks.groupBy("chunk").applyInArrow(send, "part int, chunk bigint, size int, hashes binary, counts binary")
    return sent.groupBy("part").applyInArrow(add, "chunk bigint, part int, counts binary")


def counts_of(rows: pa.Table) -> np.ndarray:
    """A chunk's counts, aligned with its distinct n-grams in order."""
    parts = sorted(zip(rows.column("part").to_pylist(), rows.column("counts").to_pylist())) if len(rows) else []
    return np.concatenate([from_planes(c) for _, c in parts]) if parts else np.empty(0, np.int64)
