"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule rejects a document by a few statistics of its text.  The order of the cascade comes
from a sample: every rule is timed and its rejections are counted there, and the rules run in
the order of rejections per second.  A document stops at the first rule that rejects it.

Null text has no words; a text without words fails ``few_words``.  Equal rows get equal verdicts,
null ids and extra columns pass through, and an empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import BLANKS, let, stored

#: Rows on which the rules are timed.
SAMPLE_ROWS = 1000
#: Bits of a packed window for its position; longer texts take the slower comparison.
POSITION_BITS = 24

Statistic = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets a function from a statistic's name to its column."""

    name: str
    rejects: Callable[[Statistic], Column]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def _characters_in(text: Column, characters: str) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(
        F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")
    )


def _covered(positions: Column) -> Column:
    """Words under three-word windows that start at the given rising positions."""
    return F.aggregate(
        F.transform(
            positions, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(positions, i + 1) - p, F.lit(3)))
        ),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )


def _windows(w: Column) -> Column:
    return F.sequence(F.lit(0), F.size(w) - 3)


def _repeated_exactly(w: Column) -> Column:
    """By sorting the windows themselves: for colliding hashes and texts too long to pack."""

    def same(a: Column, b: Column) -> Column:
        return F.coalesce((a["x"] == b["x"]) & (a["y"] == b["y"]) & (a["z"] == b["z"]), F.lit(False))

    def positions(rows: Column) -> Column:
        marked = F.filter(
            rows,
            lambda r, i: (i.__gt__(0) & same(r, F.get(rows, F.greatest(i - 1, F.lit(0)))))
            | same(r, F.get(rows, i + 1)),
        )
        return let(F.sort_array(F.transform(marked, lambda r: r["i"])), _covered)

    rows = F.transform(
        _windows(w),
        lambda i: F.struct(
            w[i].alias("x"), w[i + 1].alias("y"), w[i + 2].alias("z"), i.alias("i")
        ),
    )
    return let(F.sort_array(rows), positions)


def _repeated_packed(w: Column) -> Column:
    """Windows packed as hash bits and position, sorted as plain longs.

    Neighbours of equal hash are compared word by word; if any pair differs the result is null.
    """
    low = (1 << POSITION_BITS) - 1

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(F.shiftrightunsigned(a.bitwiseXOR(b), POSITION_BITS) == 0, F.lit(False))

    def at(x: Column) -> Column:
        return x.bitwiseAND(F.lit(low)).cast("int")

    def equal(a: Column, b: Column) -> Column:
        return (w[a] == w[b]) & (w[a + 1] == w[b + 1]) & (w[a + 2] == w[b + 2])

    def marked(rows: Column) -> Column:
        return F.filter(
            rows, lambda x, i: same(x, F.get(rows, i + 1)) | ((i > 0) & same(x, F.get(rows, i - 1)))
        )

    def count(rows: Column) -> Column:
        collides = F.exists(
            _pairs(rows), lambda p: same(p["a"], p["b"]) & ~equal(at(p["a"]), at(p["b"]))
        )
        return F.when(F.size(rows) == 0, F.lit(0).cast("long")).when(
            ~collides, let(F.sort_array(F.transform(rows, at)), _covered)
        )

    packed = F.transform(
        _windows(w),
        lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])
        .bitwiseAND(F.lit(~low))
        .bitwiseOR(i.cast("long")),
    )
    return let(F.sort_array(packed), lambda rows: let(marked(rows), count))


def _pairs(rows: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(rows) - 2, F.lit(0))),
        lambda i: F.struct(F.get(rows, i).alias("a"), F.get(rows, i + 1).alias("b")),
    )


def _n_repeat_words(text: Column) -> Column:
    def count(w: Column) -> Column:
        return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(
            F.coalesce(
                F.when(F.size(w) < (1 << POSITION_BITS), _repeated_packed(w)), _repeated_exactly(w)
            )
        )

    return let(words(text), count)


#: The statistics a rule can name, each from the text alone.
STATISTICS: dict[str, Callable[[Column], Column]] = {
    "n_words": lambda text: F.size(words(text)).cast("long"),
    "word_chars": lambda text: F.length(
        F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\f\r", "")
    ).cast("long"),
    "n_symbols": lambda text: _characters_in(text, "#*$%&|<>"),
    "n_lines": lambda text: F.size(_lines(text)).cast("long"),
    "n_dup_lines": lambda text: let(
        _lines(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))
    ).cast("long"),
    "n_repeat_words": _n_repeat_words,
}

BASE_RULES = (
    Rule("few_words", lambda s: s("n_words") < 50),
    Rule("repeated_words", lambda s: 100 * s("n_repeat_words") > 50 * s("n_words")),
)
RULES = BASE_RULES + (
    Rule("symbols", lambda s: 100 * s("n_symbols") > 40 * s("n_words")),
    Rule("repeated_lines", lambda s: 100 * s("n_dup_lines") > 30 * s("n_lines")),
    Rule(
        "word_length",
        lambda s: (s("word_chars") > 20 * s("n_words")) | (s("word_chars") < 2 * s("n_words")),
    ),
)


def of_text(text: str = "text") -> Statistic:
    return lambda name: STATISTICS[name](F.col(text))


def with_statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with a column per statistic."""
    return documents.withColumns({name: f(F.col(text)) for name, f in STATISTICS.items()})


def ordered(
    documents: DataFrame, rules: Sequence[Rule], statistic: Statistic, sample_rows: int = SAMPLE_ROWS
) -> list[Rule]:
    """The rules by rejections per second on a sample, best first.

    The order changes what the cascade costs, never what it rejects.
    """
    rows = documents.count()
    if not rows:
        return list(rules)
    # Stored, so that a timing holds the rule and not the reading of the whole table.
    sample = stored(documents.sample(min(1.0, 2 * sample_rows / rows), seed=7).limit(sample_rows))
    worth = {}
    sample.agg(F.count("*")).collect()
    for rule in rules:
        started = time.perf_counter()
        [(rejected,)] = sample.agg(F.count_if(rule.rejects(statistic))).collect()
        worth[rule.name] = rejected / (time.perf_counter() - started)
    return sorted(rules, key=lambda rule: -worth[rule.name])


def rejected_by(rules: Sequence[Rule], statistic: Statistic) -> Column:
    """Name of the first rule that rejects, null if none does; later rules are not evaluated."""
    first, *rest = rules
    verdict = F.when(first.rejects(statistic), F.lit(first.name))
    for rule in rest:
        verdict = verdict.when(rule.rejects(statistic), F.lit(rule.name))
    return verdict


def quality_cascade(
    documents: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The documents with ``rejected_by``, the first rule that rejects each (null: kept).

    Every rule computes the statistics it needs from the text, so a document that is rejected
    early costs little.
    """
    order = ordered(documents.select(text), rules, of_text(text), sample_rows)
    return documents.withColumn("rejected_by", rejected_by(order, of_text(text)))


def judged_with_statistics(
    documents: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The same with a column per statistic: for reports that want all of them of every row."""
    order = ordered(documents.select(text), rules, of_text(text), sample_rows)
    return with_statistics(documents, text).withColumn("rejected_by", rejected_by(order, F.col))
