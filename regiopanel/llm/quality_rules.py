"""Quality rules under weak supervision.

Rules vote that a document is bad, that it is fine, or abstain.  Expectation-maximisation over the
counts of vote patterns of all documents estimates how far each rule can be trusted; a document
stays unless the base rules reject it or its posterior probability of being bad is over a half.

Everything that touches a text is a built-in expression.  Words lie between ASCII blanks.

Defined results: a null or empty text has no words and fails the base rules; repeated rows get a row
each, with equal results; an empty table gives an empty result.  Columns that are made on the way
are held in one struct under a name that no other column has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiopanel.llm.common import BLANKS, let, text_or_empty
from regiopanel.llm.weak_labels import LabelModel, fit
from regiopanel.session import stored

FEW_WORDS, WINDOW = 10, 5
# Frequent words of the four languages (fixed values).
STOP_WORDS = (
    "the of and to in is that for it was der die das und ist nicht ein eine von mit le la les des et est une que "
    "pour dans el los las una es por con para"
).split()


def _windows_of(words: Column) -> Column:
    """Hash of each window of five words."""
    return F.when(
        F.size(words) >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - WINDOW),
            lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column) -> Column:
    """Words in windows that occur more than once: equal windows are neighbours after sorting."""
    placed = F.sort_array(F.transform(windows, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def again(rows: Column) -> Column:
        n = F.size(rows)
        marked = F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda k: F.when(
                F.get(rows, k)["g"].eqNullSafe(F.get(rows, k - 1)["g"])
                | F.get(rows, k)["g"].eqNullSafe(F.get(rows, k + 1)["g"]),
                F.get(rows, k)["i"],
            ),
        )
        return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

    def length(starts: Column) -> Column:
        n = F.size(starts)
        steps = F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda k: F.least(
                F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - F.get(starts, k), F.lit(WINDOW))
            ),
        )
        return F.when(n > 0, F.aggregate(steps, F.lit(0), lambda a, b: a + b)).otherwise(0)

    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(repeats, let(placed, lambda rows: let(again(rows), length))).otherwise(0)


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def measures(text: Column) -> Column:
    """Struct of the measures of a text, each computed once."""

    def of_words(words: Column, lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _without(text, "#*$%&|<>").cast("long").alias("n_symbols"),
            F.size(lines).alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            let(_windows_of(words), _covered).cast("long").alias("n_repeat_words"),
            F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).alias("n_upper"),
            F.length(F.regexp_replace(text, r"\P{L}+", "")).alias("n_letters"),
            F.size(F.array_intersect(words, F.array(*map(F.lit, STOP_WORDS)))).alias("n_stop_words"),
            F.size(F.filter(lines, lambda x: F.rtrim(x).rlike(r"[.!?\"]$"))).alias("n_ended_lines"),
        )

    words = F.array_remove(F.split(text, BLANKS), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(words, lambda w: let(lines, lambda x: of_words(w, x)))


def _vote(bad: Column, fine: Column) -> Column:
    return F.when(bad, 1).when(fine, -1).otherwise(0)


#: Rules by name: bad, else fine, else they abstain. ``m`` is the struct of measures.
RULES: dict[str, Callable[[Column], Column]] = {
    "symbols": lambda m: _vote(m["n_symbols"] * 5 > m["n_words"], m["n_symbols"] * 50 <= m["n_words"]),
    "repeated words": lambda m: _vote(m["n_repeat_words"] * 10 > m["n_words"], F.lit(False)),
    "repeated lines": lambda m: _vote(
        (m["n_lines"] >= 3) & (m["n_dup_lines"] * 10 > m["n_lines"] * 3), (m["n_lines"] >= 3) & (m["n_dup_lines"] == 0)
    ),
    "capitals": lambda m: _vote(m["n_upper"] * 5 > m["n_letters"] * 2, m["n_upper"] * 10 <= m["n_letters"]),
    "word length": lambda m: _vote(
        (m["word_chars"] > 12 * m["n_words"]) | (m["word_chars"] < 3 * m["n_words"]), F.lit(False)
    ),
    "stop words": lambda m: _vote((m["n_stop_words"] == 0) & (m["n_words"] >= 50), m["n_stop_words"] >= 3),
    "line ends": lambda m: _vote((m["n_ended_lines"] == 0) & (m["n_lines"] >= 5), F.lit(False)),
}


def base_failed(m: Column) -> Column:
    return (m["n_words"] < FEW_WORDS) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def votes(m: Column) -> Column:
    return F.array(*[rule(m) for rule in RULES.values()])


def ballot(m: Column) -> Column:
    """The votes on a document, null if it fails the base rules."""
    return F.when(~base_failed(m), votes(m))


def fit_rules(ballots: DataFrame) -> LabelModel:
    """From the votes (ballot) on all documents that the base rules let pass."""
    rows = ballots.groupBy("ballot").count().collect()  # at most 3 ** len(RULES), and one for those that fail
    return fit({tuple(r.ballot): r["count"] for r in rows if r.ballot is not None}, len(RULES))


def bad_odds(model: LabelModel, m: Column) -> Column:
    total = F.lit(model.bias)
    for rule, weight in zip(RULES.values(), model.weights, strict=True):
        vote = rule(m)
        total = total + F.when(vote == 1, weight[1]).when(vote == -1, weight[-1]).otherwise(weight[0])
    return total


def kept(model: LabelModel, m: Column) -> Column:
    return ~base_failed(m) & (bad_odds(model, m) <= 0)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, the measures, base_failed, kept, p_bad."""
    # The struct is read by many expressions, so it is stored, without the text.
    measured = docs.select(docs[f"`{id_col}`"].alias("doc_id"), text_or_empty(f"`{text_col}`").alias("text"))
    measured = stored(measured.select("doc_id", measures(F.col("text")).alias("_quality")), "measures")
    m = F.col("_quality")
    model = fit_rules(measured.select(ballot(m).alias("ballot")))
    p_bad = 1 / (1 + F.exp(-bad_odds(model, m)))
    return measured.select(
        "doc_id", "_quality.*", base_failed(m).alias("base_failed"), kept(model, m).alias("kept"), p_bad.alias("p_bad")
    )


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that the rules keep, all columns as they were."""
    # Measured twice, for the votes and for the verdict: storing the measures with the rows would take as much disk as the input.
    m = measures(text_or_empty(f"`{text_col}`"))
    model = fit_rules(docs.select(let(m, ballot).alias("ballot")))
    return docs.filter(let(m, lambda x: kept(model, x)))
