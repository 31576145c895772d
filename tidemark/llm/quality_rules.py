"""Quality rules: a decision list learned from labelled statistics of texts, as ordered Spark conditional expressions.

Statistics and verdicts are DataFrame functions; no rows are made of words and nothing is shuffled but labels. The list is
learned by sequential covering on at most `SAMPLE_ROWS` labelled documents (chosen by a hash of the id), whose statistics
are collected: a rule for low quality is grown, threshold by threshold, on two thirds of them by information gain, pruned
on the others from its end where that raises its worth, and taken if it is right for `PRECISION` of what it covers there;
what it covers is put aside and the next rule is grown from the rest. The rules become F.when(...) in their order, the
number of the first that holds is kept beside the verdict, and `as_text` shows them.

Defined results: a null, empty or wordless text has zeros for all counts and fails the base (fewer than `LEAST_WORDS`
words); windows are told apart by 64-bit hashes; very long texts are worked on in one row, in time n log n. A label counts
as good if quality is 1/2 or more; of several labels of an id the mean decides, and of several texts of an id the one with
the least hash is learned from; labels without id, text or quality are left out; where documents of one quality alone are labelled, that
is everybody's verdict, and without any label all that passes the base is kept. Repeated rows repeat their result; an
empty table gives an empty result. Only the columns named are read, and columns that are kept may bear any name if a
prefix is given.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.order_minhash import let
from tidemark.llm.texts import fresh

WHITE = " \t\n\x0b\f\r"
LEAST_WORDS, WINDOW, REPEAT_PERCENT = 20, 8, 30

#: Labelled documents learned from, at most about.
SAMPLE_ROWS = 8192
#: A rule must be right so often on documents it was not grown on, and cover so many of them.
PRECISION, LEAST_COVER = 0.9, 4
RULES, CONDITIONS = 12, 4

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Beside the counts: what the learned conditions look at.
SHARES = ["mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "digit_share", "letter_share"]
FEATURES = ["n_words", *SHARES]


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeated(hashes: Column) -> Column:
    """The number of words in windows that are found twice or more."""

    def of_windows(grams: Column) -> Column:
        placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), 0).otherwise(let(placed, of_placed))

    def of_placed(placed: Column) -> Column:
        def again(x: Column, i: Column) -> Column:
            return ((i > 0) & (x["g"] == F.get(placed, i - 1)["g"])) | F.coalesce(x["g"] == F.get(placed, i + 1)["g"], F.lit(False))

        return let(F.sort_array(F.transform(F.filter(placed, again), lambda x: x["i"])), covered)

    def covered(places: Column) -> Column:
        own = F.transform(places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(own, F.lit(0), lambda a, b: a + b)

    at = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
    grams = F.transform(at, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))
    return F.when(F.size(hashes) <= WINDOW, 0).otherwise(let(grams, of_windows))


def _of_words(text: Column) -> Column:
    """(n, distinct, repeated) of the words of a text."""

    def counts(hashes: Column) -> Column:
        return F.struct(F.size(hashes).alias("n"), F.size(F.array_distinct(hashes)).alias("distinct"), _repeated(hashes).alias("repeated"))

    trimmed = F.btrim(text, F.lit(WHITE))
    split = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\x20\x09-\x0d]+"))
    return let(F.transform(split, lambda w: F.xxhash64(w)), counts)


def _of_lines(text: Column) -> Column:
    """(n, distinct) of the lines that hold a word."""
    worded = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    return let(worded, lambda lines: F.struct(F.size(lines).alias("n"), F.size(F.array_distinct(lines)).alias("distinct")))


def statistics(docs: DataFrame, keep: list[str], text: str = "text", prefix: str = "") -> DataFrame:
    """The columns `keep` of every row, and COUNTS (longs), SHARES (doubles) and base_failed, all with the prefix."""
    own = fresh("_text", keep)
    names = {n: fresh(f"_{n}", keep) for n in ("words", "lines", "chars", "symbols", "letters", "upper", "digits")}
    t = F.col(own)
    rows = docs.select(*[docs[c] for c in keep], F.coalesce(docs[text], F.lit("")).alias(own))
    bare = _without(t, WHITE)
    rows = rows.select(
        *keep, _of_words(t).alias(names["words"]), _of_lines(t).alias(names["lines"]), F.length(bare).alias(names["chars"]),
        (F.length(t) - F.length(_without(t, "#*$%&|<>"))).alias(names["symbols"]),
        (F.length(bare) - F.length(F.regexp_replace(bare, r"\p{L}+", ""))).alias(names["letters"]),
        (F.length(bare) - F.length(F.regexp_replace(bare, r"\p{Lu}+", ""))).alias(names["upper"]),
        (F.length(bare) - F.length(_without(bare, "0123456789"))).alias(names["digits"]))
    n, chars, lines = F.col(f"{names['words']}.n"), F.col(names["chars"]), F.col(names["lines"])
    repeated, doubled = F.col(f"{names['words']}.repeated"), lines["n"] - lines["distinct"]
    words, letters = F.greatest(n, F.lit(1)), F.greatest(chars, F.lit(1))
    counts = [n, chars, F.col(names["symbols"]), doubled, repeated]
    shares = [
        chars / words, F.col(names["symbols"]) / words, doubled / F.greatest(lines["n"], F.lit(1)), repeated / words,
        F.col(f"{names['words']}.distinct") / words, F.col(names["upper"]) / letters, F.col(names["digits"]) / letters, F.col(names["letters"]) / letters]
    failed = (n < LEAST_WORDS) | (100 * repeated.cast("long") > REPEAT_PERCENT * n.cast("long"))
    return rows.select(
        *keep, *[c.cast("long").alias(prefix + name) for name, c in zip(COUNTS, counts)],
        *[c.cast("double").alias(prefix + name) for name, c in zip(SHARES, shares)], failed.alias(f"{prefix}base_failed"))


@dataclass
class DecisionList:
    """Rules for low quality in order: each a list of (feature, is at least, threshold); and what holds where none does."""

    rules: list[list[tuple[str, bool, float]]] = field(default_factory=list)
    default: bool = True

    def matched(self, prefix: str = "") -> Column:
        """The number (from 1) of the first rule that holds, or NULL."""
        found = F.lit(None).cast("int")
        for number, rule in reversed(list(enumerate(self.rules, 1))):
            holds = F.lit(True)
            for feature, upwards, threshold in rule:
                value = F.col(prefix + feature)
                holds = holds & (value >= F.lit(threshold) if upwards else value < F.lit(threshold))
            found = F.when(holds, F.lit(number)).otherwise(found)
        return found

    def as_text(self) -> list[str]:
        lines = [" and ".join(f"{f} {'>=' if up else '<'} {t:.6g}" for f, up, t in rule) + ": drop" for rule in self.rules]
        return [*lines, f"otherwise: {'keep' if self.default else 'drop'}"]


def _worth(p: int, n: int) -> float:
    return (p - n) / (p + n) if p + n else -1.0


def _best_condition(x: np.ndarray, bad: np.ndarray) -> tuple[float, tuple[int, bool, float] | None]:
    """The condition with the greatest information gain for `bad` among the rows given; ties go to the first feature."""
    p, n = int(bad.sum()), int((~bad).sum())
    best, found = 0.0, None
    now = np.log2(p / (p + n))
    for j in range(x.shape[1]):
        order = np.argsort(x[:, j], kind="stable")
        value, own = x[order, j], bad[order]
        cuts = np.flatnonzero(value[1:] > value[:-1]) + 1
        if not len(cuts):
            continue
        below_p = np.cumsum(own)[cuts - 1]
        below_n = cuts - below_p
        for upwards, cp, cn in ((False, below_p, below_n), (True, p - below_p, n - below_n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(cp > 0, cp * (np.log2(cp / (cp + cn)) - now), 0.0)
            k = int(gain.argmax())
            if gain[k] > best + 1e-9:
                best, found = float(gain[k]), (j, upwards, float((value[cuts[k] - 1] + value[cuts[k]]) / 2))
    return best, found


def _holds(x: np.ndarray, rule: list[tuple[int, bool, float]]) -> np.ndarray:
    held = np.ones(len(x), dtype=bool)
    for j, upwards, threshold in rule:
        held &= x[:, j] >= threshold if upwards else x[:, j] < threshold
    return held


def cover(x: np.ndarray, bad: np.ndarray, prune: np.ndarray) -> list[list[tuple[int, bool, float]]]:
    """Rules for the rows that are `bad`, grown on the rows not marked `prune` and pruned on the others."""
    rules, left = [], np.ones(len(x), dtype=bool)
    while len(rules) < RULES:
        grow, rule = left & ~prune, []
        if not bad[grow].any():
            break
        while len(rule) < CONDITIONS:
            own = np.flatnonzero(grow)[_holds(x[grow], rule)]
            if bad[own].all() or not bad[own].any():
                break
            _, condition = _best_condition(x[own], bad[own])
            if condition is None:
                break
            rule.append(condition)
        test = left & prune

        def counts(r: list) -> tuple[int, int]:
            held = bad[test][_holds(x[test], r)]
            return int(held.sum()), int((~held).sum())

        sizes = range(len(rule), 0, -1)  # ties go to the shorter rule
        size = max(sizes, key=lambda k: (_worth(*counts(rule[:k])), -k), default=0)
        rule = rule[:size]
        if not rule:
            break
        p, n = counts(rule)
        if p + n < LEAST_COVER or p < PRECISION * (p + n):
            break
        rules.append(rule)
        left &= ~_holds(x, rule)
    return rules


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", sample: int = SAMPLE_ROWS) -> DecisionList:
    """A decision list from documents (doc_id, text) and labels (doc_id, quality)."""
    spoken = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).alias("good"))
    n = spoken.count()
    if not n:
        return DecisionList()
    share = min(1_000_000, 1_000_000 * sample // n + 1)
    chosen = spoken.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) < share)
    # The sample has about `sample` rows of an id and a boolean, whatever the input: it may be broadcast.
    named = docs.select(docs["doc_id"], docs[text].alias("text")).where("doc_id is not null and text is not null").join(F.broadcast(chosen), "doc_id")
    rows = statistics(named, ["doc_id", "good", "text"])
    rows = rows.where("not base_failed").groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "good", *FEATURES)).alias("x")).select("doc_id", "x.*")
    found = sorted(rows.select("doc_id", "good", *FEATURES, F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(3)).alias("part")).collect())
    bad = np.array([not r.good for r in found], dtype=bool)
    if bad.all() or not bad.any():
        return DecisionList([], not len(bad) or not bad.any())
    x = np.array([[float(r[f]) for f in FEATURES] for r in found])
    rules = cover(x, bad, np.array([r.part == 0 for r in found]))
    return DecisionList([[(FEATURES[j], upwards, t) for j, upwards, t in rule] for rule in rules])


def judge_quality(docs: DataFrame, rules: DecisionList, keep: list[str], text: str = "text", prefix: str = "") -> DataFrame:
    """The columns `keep`, the statistics, base_failed, rule (the number of the first learned rule that holds) and kept."""
    found = statistics(docs, keep, text, prefix)
    found = found.withColumn(f"{prefix}rule", rules.matched(prefix))
    kept = ~F.col(f"{prefix}base_failed") & F.col(f"{prefix}rule").isNull() & F.lit(rules.default)
    return found.withColumn(f"{prefix}kept", kept)
