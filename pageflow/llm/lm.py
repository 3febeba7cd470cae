"""Stupid-backoff scores of documents against the rest of the corpus.

Counts of all n-grams of up to `order` words come from `grams.counted`: tables partitioned by hash, joined to the n-grams
of each document and summed per document. A document's own occurrences are taken off, so that it is scored by what the
other documents say. The longest n-gram seen elsewhere scores its count over that of its words but the last, times 0.4
for each longer one that was not; with none, the share of the word alone. The query takes triples, pairs and words.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pageflow.llm.common import prepared, saved, table
from pageflow.llm.grams import Words, bundled, characters, counted, counts_of, part_bits, rows_in

# What a step back costs, and the count of a word no other document has.
BACKOFF, UNSEEN = 0.4, 0.5
ORDER, KEEP = 2, 6
# Words of the longest n-gram of the query.
QUERY_ORDER = 3
# Characters of a chunk.
BUNDLE = 6_000_000


def _all_grams(words: Words, order: int) -> np.ndarray:
    return np.concatenate([words.grams(n)[0] for n in range(1, order + 1)])


def scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, n_words, n_backed_off, sum_log and mean_log (natural logarithms) of every document.

    Words are as written. A text without words, null included, has sum_log 0 and mean_log null. Rows with null or repeated
    doc_id are scored each for itself. Other columns are ignored. With one document alone nothing has been seen elsewhere.
    No documents give no rows, texts of any length are scored whole, and there are no ties to break. `docs` are best read
    from files, see `grams.bundled`.
    """
    total = characters(docs)
    bits = part_bits(total, order)
    chunks = bundled(docs, total, BUNDLE)
    counts = counted(chunks, lambda words: _all_grams(words, order), bits, KEEP, lambda rows: rows_in(rows).column("text").to_pylist())

    def score(rows: pa.Table, found: pa.Table) -> pa.Table:
        rows = rows_in(rows)
        words = Words(rows.column("text").to_pylist(), lists=False)
        distinct, which = np.unique(_all_grams(words, order), return_inverse=True)
        every = counts_of(found)
        size, at, rest = len(words.hashes), 0, []
        for n in range(1, order + 1):  # per word: count elsewhere of the n-gram that ends there
            places = words.grams(n)[1]
            ids = which[at:at + len(places)]
            at += len(places)
            owner = words.owner[places]
            _, inverse, own = np.unique(owner * np.int64(len(distinct) + 1) + ids, return_inverse=True, return_counts=True)
            left = np.zeros(size, np.int64)
            left[places + n - 1] = every[ids] - own[inverse]
            rest.append(left)
        place = np.arange(size) - words.starts[words.owner]
        logs, steps, done = np.zeros(size), np.zeros(size, np.int64), np.zeros(size, bool)
        for n in range(order, 1, -1):
            before = np.r_[0, rest[n - 2][:-1]] if size else rest[n - 2]
            use = ~done & (rest[n - 1] > 0) & (before > 0)
            logs[use] = np.log(rest[n - 1][use] / before[use])
            done |= use
            steps += ~done & (place >= n - 1)
        logs[~done] = np.log(np.maximum(rest[0][~done], UNSEEN))
        logs += steps * math.log(BACKOFF)

        def summed(values):
            return np.bincount(words.owner, weights=values, minlength=len(words.sizes)).astype(np.float64)

        return pa.table({
            "doc_id": rows.column("doc_id"), "n_words": pa.array(words.sizes), "logs": pa.array(summed(logs)),
            "n_backed_off": pa.array(summed(steps > 0).astype(np.int64)),
            "n_alone": pa.array(summed(~done).astype(np.int64))})

    each = saved(chunks.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(
        score, "doc_id bigint, n_words bigint, logs double, n_backed_off bigint, n_alone bigint"), "scores")
    words = each.agg(F.sum("n_words")).first()[0] or 0
    others = F.greatest(F.lit(words) - F.col("n_words"), F.lit(1))
    sum_log = F.col("logs") - F.col("n_alone") * F.ln(others)
    return each.select("doc_id", "n_words", "n_backed_off", F.round(sum_log, 6).alias("sum_log"),
                       F.round(F.try_divide(sum_log, F.col("n_words")), 6).alias("mean_log"))


def op8_lm(spark, sf_dir: str) -> DataFrame:
    return scores(table(prepared(spark), sf_dir, "documents"), QUERY_ORDER)
