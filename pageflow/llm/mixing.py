"""Mixing sources by temperature.

The share of a source is its share of all tokens to the power of one exponent, normalised. Exponent 1 keeps the sources
as they are, smaller ones even them out. The exponent is found by bisection: the mix has the target entropy, unless
that repeated a source more often than allowed. A source's tokens then come as whole permutations of its documents and
a last one cut off at its budget, dealt over blocks that each have the mix.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from pageflow.llm.common import prepared, saved, table, word_array

# Entropy of the mix as a share of that of equal shares, most times a document comes, and tokens of a block.
EVENNESS, MOST_EPOCHS, BLOCK_TOKENS = 0.95, 2.0, 1_000_000
# Exponents compared in one aggregation, and how often: 4 bits each.
POINTS, ROUNDS = 15, 7
# Documents of a slice of the last permutation that are summed up one by one.
SLICE = 4096


@dataclass(frozen=True)
class Mix:
    """The exponent, and what turns a source's tokens into its number of permutations."""

    exponent: float
    scale: float

    def epochs(self, tokens: Column) -> Column:
        """(share of the mix) * budget / tokens = scale * tokens ** (exponent - 1)."""
        return F.when(tokens > 0, self.scale * F.pow(tokens.cast("double"), self.exponent - 1)).otherwise(0.0)


def source_key(source: Column) -> Column:
    """A text for every source, null included."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def sized(docs: DataFrame) -> DataFrame:
    """`row` (the document as it came) with source key, number of words, and a hash of identity and content."""
    return docs.select(
        F.struct("*").alias("row"), source_key(F.col("source")).alias("key"), F.size(word_array(F.col("text"))).cast("long").alias("tokens"),
        F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.coalesce("text", F.lit(""))).alias("identity"))


def _measured(shares: DataFrame, exponents: list[float], total: int) -> list[tuple[float, float, float]]:
    """For each exponent the entropy, the most epochs if every document is to come once at least, and the most epochs
    for a budget of all tokens. One row comes back for each."""
    log = F.ln(F.col("tokens") / F.element_at(F.lit([float(total)]), 1))
    each = shares.select(log.alias("log"), F.posexplode(F.lit([float(x) for x in exponents])).alias("k", "x"))
    power = F.exp(F.col("x") * F.col("log"))
    rows = each.groupBy("k").agg(F.sum(power).alias("z"), F.sum(F.col("log") * power).alias("l"),
                                 F.min("log").alias("least"), F.max("log").alias("most")).collect()
    measured = [()] * len(exponents)
    for row in rows:
        x = exponents[row["k"]]
        entropy = math.log(row["z"]) - x * row["l"] / row["z"]
        spread = math.exp(abs(x - 1) * (row["most"] - row["least"]))
        measured[row["k"]] = entropy, spread, math.exp((x - 1) * row["least"]) / row["z"]
    return measured


def _bisected(shares: DataFrame, total: int, low: float, high: float, enough) -> float:
    """The smallest exponent between low and high whose measures are `enough`; high if none is."""
    for _ in range(ROUNDS):
        points = [low + (high - low) * (k + 1) / (POINTS + 1) for k in range(POINTS)]
        good = [enough(m) for m in _measured(shares, points, total)]
        first = good.index(True) if True in good else POINTS
        low, high = ([low, *points][first], [*points, high][first])
    return high


def fit(shares: DataFrame, evenness: float = EVENNESS, most_epochs: float = MOST_EPOCHS, budget: int | None = None) -> Mix:
    """The mix of (key, tokens, n_docs). Without a budget it is the least in which every document comes at least once.

    A mix more even than wanted calls for an exponent over 1, up to 8. The limit on repetition goes first; with a
    budget it counts for exponents under 1 and the source that comes most often. Without
    tokens, or with one source, the exponent is 1.
    """
    used = shares.where("tokens > 0")
    row = used.agg(F.sum("tokens").alias("total"), F.count("*").alias("n"), F.max("tokens").alias("most"), F.min("tokens").alias("least")).first()
    total = int(row["total"] or 0)
    exponent = 1.0
    if row["n"] > 1:
        target = evenness * math.log(row["n"])
        exponent = _bisected(used, total, 0.0, 8.0, lambda m: m[0] <= target)
        if exponent < 1:
            times = lambda m: m[1] if budget is None else m[2] * budget / total
            limited = _bisected(used, total, 0.0, 1.0, lambda m: times(m) <= most_epochs)
            exponent = max(exponent, limited)
        spread = math.log(row["most"] / row["least"])
        if budget is None and exponent > 1 and spread > 0:
            exponent = min(exponent, 1 + math.log(most_epochs) / spread)
    exponent = round(exponent, 7)
    if not total:
        return Mix(exponent, 0.0)
    if budget is None:
        once = row["most"] if exponent <= 1 else row["least"]
        return Mix(exponent, float(once) ** (1 - exponent))
    powers = used.agg(F.sum(F.pow(F.col("tokens") / total, exponent)).alias("z")).first()["z"]
    return Mix(exponent, budget / powers * float(total) ** -exponent)


def draw(identity: Column, epoch: Column, seed: int) -> Column:
    """A number that orders the documents anew for every epoch."""
    return F.xxhash64(identity, epoch.cast("long"), F.lit(seed))


def _cutoffs(rows: DataFrame, plan: DataFrame, n_docs: int, seed: int) -> DataFrame:
    """(key, cutoff): the last draw of the last, partial permutation.

    Draws are cut into slices by their first bits and the slices summed; only the slice in which a source's budget
    ends is summed document by document. Slices hold about `SLICE` documents, whatever the size of a source.
    """
    bits = max(0, math.ceil(math.log2(max(1, n_docs / SLICE))))
    last = plan.where("part > 0").select("key", "full", (F.col("part") * F.col("tokens")).alias("budget"))
    drawn = rows.select("key", "tokens", "identity").join(last, "key").select(
        "key", "tokens", "budget", draw(F.col("identity"), F.col("full"), seed).alias("draw"))
    drawn = drawn.withColumn("slice", F.shiftright("draw", 64 - bits) if bits else F.lit(0).cast("long"))
    sums = drawn.groupBy("key", "slice").agg(F.sum("tokens").alias("tokens"), F.min("budget").alias("budget"))
    upto = F.sum("tokens").over(Window.partitionBy("key").orderBy("slice"))
    ends = sums.withColumn("upto", upto).where("upto >= budget and upto - tokens < budget").select(
        "key", "slice", (F.col("upto") - F.col("tokens")).alias("before"))
    own = drawn.join(ends, ["key", "slice"])
    running = F.sum("tokens").over(Window.partitionBy("key", "slice").orderBy("draw"))
    inside = own.withColumn("start", F.col("before") + running - F.col("tokens")).where("start < budget")
    return inside.groupBy("key").agg(F.max("draw").alias("cutoff"))


def mixed_rows(docs: DataFrame, evenness: float = EVENNESS, most_epochs: float = MOST_EPOCHS, budget: int | None = None,
               block_tokens: int = BLOCK_TOKENS, seed: int = 0) -> DataFrame:
    """`row`, n_tokens, epoch, block and order_key for each time a document comes.

    Reading a block by order_key gives a random order; every block has the mix. A null source is a source. Null and
    empty texts have no tokens; they come once with each whole permutation of their source, and a source without tokens not at
    all. Equal rows are drawn together. A column of `docs` may have any name: the document stays in `row`.
    """
    rows = sized(docs)
    shares = saved(rows.groupBy("key").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n_docs")), "shares")
    mix = fit(shares, evenness, most_epochs, budget)
    # Rounded, so that a source meant to come once does not come 0.9999999 times.
    epochs = F.round(mix.epochs(F.col("tokens")), 6)
    plan = shares.select("key", "tokens", "n_docs", epochs.alias("epochs"), F.floor(epochs).alias("full"),
                         (epochs - F.floor(epochs)).alias("part")).where("epochs > 0")
    sums = plan.agg(F.sum(F.col("epochs") * F.col("tokens")).alias("tokens"), F.sum("n_docs").alias("n_docs")).first()
    blocks = max(1, math.ceil((sums["tokens"] or 0) / block_tokens))
    cuts = saved(_cutoffs(rows, plan, sums["n_docs"] or 0, seed), "cutoffs")
    known = plan.join(cuts, "key", "left").select("key", "epochs", "full", "cutoff")
    drawn = rows.join(known, "key").withColumn("times", F.col("full") + F.when(
        draw(F.col("identity"), F.col("full"), seed) <= F.col("cutoff"), 1).otherwise(0))
    each = drawn.where("times > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    place = (draw(F.col("identity"), F.col("epoch"), seed) / 2.0 ** 64 + 0.5 + F.col("epoch")) / F.col("epochs")
    block = F.least(F.lit(blocks - 1), F.floor(place * blocks)).cast("long")
    return each.select("row", F.col("tokens").alias("n_tokens"), "epoch", block.alias("block"),
                       F.xxhash64("identity", "epoch", F.lit(seed + 1)).alias("order_key"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix in the columns the documents came with; a document that comes several times has several rows."""
    return mixed_rows(docs, **settings).select("row.*")


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    rows = mixed_rows(table(prepared(spark), sf_dir, "documents"))
    return rows.select(F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), "n_tokens", "epoch", "block", "order_key")
