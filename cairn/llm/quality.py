"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

The rules' costs and rejection rates are estimated on a sample; the cascade
then tests rules in order of rejection per cost, so a document that a cheap
rule rejects never reaches the costly ones.  A verdict does not depend on the
order.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
MIN_WORDS = 50
#: Rows of the sample on which costs and rejection rates are estimated, timed runs of each rule over it, and the least time that counts.
SAMPLE_ROWS = 2000
RUNS = 2
LEAST_SECONDS = 1e-3


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null and empty texts have none."""
    stripped = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(
        F.split(stripped, r"[\x20\x09-\x0D]+"))


def _full_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda s: F.btrim(s, F.lit(SPACES)) != "")


class Facts:
    """Counts of one text as expressions; a count is computed only where a rule asks for it."""

    def __init__(self, text: Column, words: Column):
        self.text, self.words = text, words

    @property
    def n_words(self) -> Column:
        return F.size(self.words).cast("long")

    @property
    def word_chars(self) -> Column:
        return F.length(F.array_join(self.words, "")).cast("long")

    @property
    def n_symbols(self) -> Column:
        return F.length(F.regexp_replace(F.coalesce(self.text, F.lit("")), r"[^#*$%&|<>]+", "")).cast("long")

    @property
    def lines(self) -> Column:
        """struct(n_lines, n_dup_lines): lines with a word, and those equal to an earlier one."""
        return bind(_full_lines(self.text), lambda s: F.struct(
            F.size(s).cast("long").alias("n_lines"), (F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines")))

    @property
    def n_repeat_words(self) -> Column:
        """Words that lie in a 3-word window found at least twice in the text.

        Windows are 64-bit hashes.  Where all are distinct the count is 0 at once;
        else windows sorted with their places show the repeated ones, and places in
        order show how many words they cover.
        """
        n = F.size(self.words)
        windows = F.when(n < 3, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
                F.get(self.words, i), F.get(self.words, i + 1), F.get(self.words, i + 2))))
        return bind(windows, _covered_words)


class KnownFacts:
    """The same counts where columns hold them."""

    def __init__(self, **columns: Column):
        vars(self).update(columns)


def bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered_words(windows: Column) -> Column:
    def repeated_places(pairs: Column) -> Column:
        def again(p: Column, i: Column) -> Column:
            return (F.get(pairs, i - 1)["h"].eqNullSafe(p["h"])) | (F.get(pairs, i + 1)["h"].eqNullSafe(p["h"]))

        return F.sort_array(F.transform(F.filter(pairs, again), lambda p: p["i"]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(F.coalesce(F.get(at, i + 1) - p, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(
        F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")
    ).otherwise(bind(bind(pairs, repeated_places), covered))


@dataclass(frozen=True)
class Rule:
    """A rule rejects a document where ``rejects(facts)`` is true."""

    name: str
    rejects: object  # Facts -> Column
    base: bool = False


def production_rules() -> list[Rule]:
    """The base rules and the method's own; each depends on the text alone."""
    return [
        Rule("few_words", lambda f: f.n_words < MIN_WORDS, base=True),
        Rule("repeated_words", lambda f: 100 * f.n_repeat_words > 50 * f.n_words, base=True),
        Rule("symbols", lambda f: 10 * f.n_symbols > f.n_words),
        Rule("repeated_lines", lambda f: bind(f.lines, lambda x: 10 * x["n_dup_lines"] > 3 * x["n_lines"])),
        Rule("word_length", lambda f: bind(f.word_chars, lambda n: (n < 2 * f.n_words) | (n > 15 * f.n_words))),
    ]


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-12)


def estimate_rules(docs: DataFrame, rules: list[Rule], text_col: str = "text",
                   sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[Estimate]:
    """Each rule's cost a row and rejection rate on a sample of the documents.

    The sample lies in one partition, split into words beforehand, as the
    cascade splits a text once.  A rule's cost is the least time of several runs
    over it, less that of a run without a rule, so neither compilation nor a
    job's own time counts.  It steers the order of tests only, never a verdict.
    """
    total = docs.count()
    if not total:
        return [Estimate(r.name, 1.0, 0.0) for r in rules]
    sample = docs.select(F.col(text_col).alias("text"))
    if total > sample_rows:
        sample = sample.sample(False, min(1.0, 1.2 * sample_rows / total), seed).limit(sample_rows)
    sample = sample.repartition(1).withColumn("words", word_array(F.col("text"))).persist()

    def seconds(verdict: Column) -> tuple[float, int]:
        counted = sample.agg(F.sum(F.coalesce(verdict, F.lit(False)).cast("long")), F.count("words"))
        times = []
        for _ in range(1 + RUNS):  # the first compiles
            began = time.perf_counter()
            hits = counted.first()[0]
            times.append(time.perf_counter() - began)
        return min(times[1:]), hits or 0

    try:
        n = max(1, sample.count())
        empty, _ = seconds(F.col("text").isNull())
        found = []
        for rule in rules:
            taken, hits = seconds(rule.rejects(Facts(F.col("text"), F.col("words"))))
            found.append(Estimate(rule.name, max(LEAST_SECONDS, taken - empty) / n, hits / n))
        return found
    finally:
        sample.unpersist()


def order_rules(rules: list[Rule], estimates: list[Estimate]) -> list[Rule]:
    """Rules by falling rejection per cost; ties by name."""
    worth = {e.name: e.worth for e in estimates}
    return sorted(rules, key=lambda r: (-worth[r.name], r.name))


def _chain(rules: list[Rule], facts: Facts | KnownFacts) -> Column:
    chain = reduce(lambda c, r: c.when(r.rejects(facts), F.lit(r.name)), rules, F)
    return chain.otherwise(F.lit(None).cast("string"))


def first_rejection(rules: list[Rule], text: Column) -> Column:
    """Name of the first rule that rejects the text, else null; later rules are then not evaluated.

    The text is split into words once for all rules.
    """
    return bind(word_array(text), lambda words: _chain(rules, Facts(text, words)))


def quality_filter(docs: DataFrame, rules: list[Rule] | None = None, text_col: str = "text",
                   sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with their columns unchanged.

    Null and empty texts have no words and are rejected by ``few_words``.
    Repeated rows are judged one by one; an empty table stays empty; further
    columns, whatever their names, are neither read nor changed.
    """
    rules = rules or production_rules()
    ordered = order_rules(rules, estimate_rules(docs, rules, text_col, sample_rows))
    return docs.where(first_rejection(ordered, F.col(text_col)).isNull())


def quality_report(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id",
                   text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: the base counts, the base verdict and the cascade's.

    ``kept`` is false where a base rule fails; else the remaining rules decide,
    in order of rejection per cost.  Null texts count as empty; a null id stays
    null.  Repeated rows are judged one by one; an empty table gives none;
    further columns, whatever their names, are not read.
    """
    rules = rules or production_rules()
    own = [r for r in rules if not r.base]
    ordered = order_rules(own, estimate_rules(docs, own, text_col, sample_rows))

    def counts(text: Column, words: Column) -> Column:
        f = Facts(text, words)
        return F.struct(f.n_words.alias("n_words"), f.word_chars.alias("word_chars"), f.n_symbols.alias("n_symbols"),
                        f.lines.alias("lines"), f.n_repeat_words.alias("n_repeat_words"))

    def judged(c: Column) -> Column:
        names = ("n_words", "word_chars", "n_symbols", "lines", "n_repeat_words")
        failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
        kept = F.when(failed, False).otherwise(_chain(ordered, KnownFacts(**{n: c[n] for n in names})).isNull())
        return F.struct(c.alias("c"), failed.alias("base_failed"), kept.alias("kept"))

    text = F.col(text_col)
    judgement = bind(bind(word_array(text), lambda words: counts(text, words)), judged)
    return docs.select(F.col(id_col).alias("doc_id"), judgement.alias("j")).select(
        "doc_id", "j.c.n_words", "j.c.word_chars", "j.c.n_symbols", F.col("j.c.lines.n_dup_lines").alias("n_dup_lines"),
        "j.c.n_repeat_words", "j.base_failed", "j.kept")
