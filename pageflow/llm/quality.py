"""Quality of documents by weak supervision.

Rules vote for a document, against it, or abstain. How far each rule can be trusted is not set by hand: expectation
maximisation estimates every rule's accuracy and the share of good documents from how the votes agree, and a
document is kept by its posterior probability of being good. Documents are counted by their pattern of votes and whether they
fail the base rules (at most 2 times 3 to the number of rules), so that all steps after the first pass run on a table of fixed size.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pageflow.llm.common import SPACE, WORD, let, prepared, saved, table, word_array

# Fixed value: symbols the contract counts.
SYMBOLS = "#*$%&|<>"
WINDOW = 5

FEW_WORDS, MOST_REPEATED = 10, 20  # words; per cent of the words
# What is held likely before any vote is seen: the share of good documents, and of right votes on good and on bad ones; rules look
# for different faults, so each misses most bad documents. The prior weighs as much as this share of all documents.
PRIOR_GOOD, PRIOR_ON_GOOD, PRIOR_ON_BAD, PRIOR = 0.85, 0.97, 0.2, 0.05
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks",
            "n_stops", "n_distinct", "n_letters", "n_bare"]


def _removed(text: Column, keep: str) -> Column:
    """Number of characters of a class."""
    return F.length(F.regexp_replace(text, f"[^{keep}]+", "")).cast("long")


def _repeated(words: Column, hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more: sort (hash, place), keep those with an equal
    neighbour, and add up what each start covers beyond the one before it."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(entries):
        def twin(e, k):
            return ((k > 0) & (F.get(entries, k - 1)["h"] == e["h"])) | F.coalesce(
                F.get(entries, k + 1)["h"] == e["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(entries, twin), lambda e: e["i"]))

    def add(state, start):
        end = start + WINDOW
        return F.struct((state["n"] + end - F.greatest(start, state["end"])).alias("n"), end.alias("end"))

    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(let(placed, starts), zero, add, lambda state: state["n"])
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered).otherwise(0).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """`row` (the document as it came) with the figures the rules look at. A null text has no words and all zeros."""
    texts = docs.select(F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("t"))
    cut = texts.select(
        "row", "t", word_array(F.col("t")).alias("words"),
        F.filter(F.split("t", "\n"), lambda line: line.rlike(WORD)).alias("lines"))
    hashed = cut.select("*", F.when(F.size("words") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("words") - WINDOW),
        lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]),
    )).otherwise(F.array().cast("array<bigint>")).alias("hashes"))
    figures = F.struct(
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", SPACE, "")).cast("long").alias("word_chars"),
        _removed(F.col("t"), SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("words"), F.col("hashes")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        _removed(F.col("t"), r"\p{Lu}").alias("n_upper"),
        _removed(F.col("t"), "!?").alias("n_marks"),
        _removed(F.col("t"), ".").alias("n_stops"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        _removed(F.col("t"), r"\p{L}").alias("n_letters"),
        F.size(F.filter("words", lambda w: ~w.rlike(r"\p{L}"))).cast("long").alias("n_bare"))
    # As a generated row the figures are worked out once a document; a filter on them would else be moved below them and
    # repeat each for every time a rule names it.
    return hashed.select("row", F.inline(F.array(figures)))


def _vote(good: Column, bad: Column) -> Column:
    """1 for, 0 against, -1 abstains; a measure that is null, for lack of words, abstains."""
    return F.when(bad, 0).when(good, 1).otherwise(-1)


def rules() -> dict[str, Column]:
    """The votes as expressions over `MEASURES`."""
    per_word = lambda name: F.try_divide(F.col(name), F.col("n_words"))
    long = F.col("n_words") >= 50
    variety = F.try_divide(F.col("n_distinct"), F.sqrt("n_words"))
    size = per_word("word_chars")
    dup = F.try_divide(F.col("n_dup_lines"), F.col("n_lines"))
    upper = F.try_divide(F.col("n_upper"), F.col("word_chars"))
    letters = F.try_divide(F.col("n_letters"), F.col("word_chars"))
    return {
        "symbols": _vote(per_word("n_symbols") < 0.02, per_word("n_symbols") > 0.1),
        "lines": _vote((dup == 0) & (F.col("n_lines") >= 3), dup > 0.3),
        "repeats": _vote((F.col("n_repeat_words") == 0) & long, per_word("n_repeat_words") > 0.1),
        "capitals": _vote(upper < 0.1, upper > 0.3),
        "letters": _vote(letters > 0.85, letters < 0.75),
        "bare_words": _vote(per_word("n_bare") < 0.02, per_word("n_bare") > 0.15),
        "marks": _vote(per_word("n_marks") < 0.02, per_word("n_marks") > 0.2),
        "sentences": _vote(per_word("n_stops").between(1 / 60, 1 / 3) & long,
                           ~per_word("n_stops").between(1 / 200, 2 / 3) & long),
        "word_size": _vote(size.between(3, 10), (size < 2) | (size > 15)),
        "variety": _vote((variety > 4) & long, (variety < 2) & long),
    }


@dataclass(frozen=True)
class Model:
    """What expectation maximisation found: the share of good documents, and for each rule how often it is right when
    it votes on a good document and on a bad one. Rules look for different faults, so a vote for a document, which
    bad documents of all other kinds get too, says far less than a vote against it."""

    good: float
    on_good: dict[str, float]
    on_bad: dict[str, float]

    def posterior(self, votes: dict[str, Column]) -> Column:
        """Probability that a document is good, given its votes."""
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for name, vote in votes.items():
            a, b = self.on_good[name], self.on_bad[name]
            odds = odds + F.when(vote == 1, math.log(a / (1 - b))).when(vote == 0, math.log((1 - a) / b)).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def pattern(votes: dict[str, Column]) -> Column:
    """All votes in one array: 0 for an abstention, 1 against, 2 for."""
    return F.array(*[(vote + 1).cast("int") for vote in votes.values()])


def fitted(patterns: DataFrame, names: list[str], rounds: int = 40, close: float = 1e-4) -> Model:
    """Expectation maximisation over (pattern, failed, n), one small aggregation a round.

    Two things tell which of the two classes is the good one: documents that fail the base rules count as bad throughout, and
    each parameter starts from, and is drawn towards, a prior as if `PRIOR` of all documents had voted that way. So no
    estimate reaches 0 or 1 or needs a limit, and the model of a table is that of many copies of it. Without documents
    the priors are returned.
    """
    model = Model(PRIOR_GOOD, dict.fromkeys(names, PRIOR_ON_GOOD), dict.fromkeys(names, PRIOR_ON_BAD))
    for _ in range(rounds):
        # One constant array, so that all rounds run the same generated code.
        weights = [math.log(model.good / (1 - model.good))]
        for x in names:
            a, b = model.on_good[x], model.on_bad[x]
            weights += [0.0, math.log((1 - a) / b), math.log(a / (1 - b))]
        known = F.lit(weights)
        each = F.transform("pattern", lambda vote, j: F.element_at(known, j * 3 + vote + 2))
        odds = F.aggregate(each, F.element_at(known, 1), lambda x, y: x + y)
        p = F.when(F.col("failed"), 0.0).otherwise(1 / (1 + F.exp(-odds)))
        scored = patterns.select("n", p.alias("p"), F.posexplode("pattern").alias("rule", "vote"))
        good, bad = {}, {}
        for row in scored.groupBy("rule", "vote").agg(
                F.sum(F.col("n") * F.col("p")).alias("good"), F.sum(F.col("n") * (1 - F.col("p"))).alias("bad")).collect():
            good[row["rule"], row["vote"]], bad[row["rule"], row["vote"]] = row["good"], row["bad"]
        if not good:
            break
        of = lambda table_, j, *votes: sum(table_.get((j, v), 0.0) for v in votes)
        all_good, all_bad = of(good, 0, 0, 1, 2), of(bad, 0, 0, 1, 2)
        pseudo = PRIOR * (all_good + all_bad)

        def share(part, whole, prior):
            return round((part + pseudo * prior) / (whole + pseudo), 6)

        before, model = model, Model(
            share(all_good, all_good + all_bad, PRIOR_GOOD),
            {x: share(of(good, j, 2), of(good, j, 1, 2), PRIOR_ON_GOOD) for j, x in enumerate(names)},
            {x: share(of(bad, j, 1), of(bad, j, 1, 2), PRIOR_ON_BAD) for j, x in enumerate(names)})
        moved = max(abs(before.good - model.good), *(abs(before.on_good[x] - model.on_good[x]) for x in names),
                    *(abs(before.on_bad[x] - model.on_bad[x]) for x in names))
        if moved < close:
            break
    return model


def base_failed() -> Column:
    """Whether a document fails whatever the rules say, over `MEASURES`."""
    return (F.col("n_words") < FEW_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def verdict(model: Model, least: float = 0.5) -> dict[str, Column]:
    """Columns over `MEASURES`: base_failed, the posterior, and kept."""
    posterior = model.posterior(rules())
    return {"base_failed": base_failed(), "quality": F.round(posterior, 6), "kept": ~base_failed() & (posterior >= least)}


def fit(measured: DataFrame) -> Model:
    """The model of all documents measured."""
    votes = rules()
    counts = measured.groupBy(pattern(votes).alias("pattern"), base_failed().alias("failed")).agg(F.count("*").alias("n"))
    return fitted(saved(counts, "vote-patterns"), list(votes))


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, the measures, base_failed, quality (posterior) and kept of every document.

    One row per row of `docs`, whatever its doc_id; null texts count as empty and fail, other columns are ignored. Equal texts
    get equal verdicts, and a posterior of just one half keeps. Texts of any length are measured whole. An empty table gives no rows.
    """
    measured = saved(measures(docs).select("row.doc_id", *MEASURES), "measures")
    return measured.select("*", *[c.alias(name) for name, c in verdict(fit(measured)).items()])


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents kept, in the columns they came with. Votes are counted in one pass, documents judged in another:
    the rows themselves are never shuffled."""
    model = fit(measures(docs).select(*MEASURES))
    return measures(docs).where(verdict(model)["kept"]).select("row.*")


def op2_quality(spark, sf_dir: str) -> DataFrame:
    return quality(table(prepared(spark), sf_dir, "documents"))
