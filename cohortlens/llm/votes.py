"""Quality by weak supervision: rules vote or abstain, EM weighs them (native).

Each rule looks at a text's counts and votes good, votes bad, or abstains. A
Dawid-Skene model (two classes, votes independent given the class, abstaining is no
evidence) is fitted by expectation-maximisation to the counts of distinct vote
patterns, of which there are at most ``3 ** len(RULES)`` whatever the corpus; they
are gathered into one row, the only thing gathered. A text's posterior probability of being good decides.

Everything is DataFrame functions. Repeats of three-word windows are recognised by
64-bit fingerprints within one text.

Letters count with their combining marks and sentences end as their script ends them;
rules on words abstain where a script puts no spaces between them.

Defined cases: null text is empty; an empty text has no words, every rule abstains
and it fails the base; equal rows get equal answers; an empty table gives an empty
result; other columns of the input are passed over, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.sources.staging import staged

SPACES = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]+"
# Marks that end a sentence or a part of one, as written in several scripts
# (ASCII; Devanagari; Arabic; Ethiopic; Chinese and Japanese; Armenian), and the ranges of
# scripts that put no spaces between words (Thai and Lao; Burmese; Khmer; kana; Han).
STOPS = ".,;:!?" + "।॥" + "،؛؟۔" + "።፣፤" + "。、，；：！？" + "։"
UNSPACED = (
    r"\x{0E00}-\x{0EFF}", r"\x{1000}-\x{109F}", r"\x{1780}-\x{17FF}", r"\x{3040}-\x{30FF}",
    r"\x{3400}-\x{4DBF}", r"\x{4E00}-\x{9FFF}", r"\x{20000}-\x{2FA1F}",
)
ROUNDS = 25
PRIOR = 0.85  # assumed share of good texts; given, not estimated
FIRM = 0.9  # posterior at the start for a text whose votes agree
SMOOTHING = 1.0  # added to each count of votes
KEEP_FROM = 0.5


@dataclass(frozen=True)
class Rule:
    """Bad where ``value`` is at least ``bad_from``, good below ``good_below``."""

    name: str
    value: str
    bad_from: float = float("inf")
    good_below: float = float("-inf")


def _spaced(value: str) -> str:
    """``value``, or nothing that a rule votes on where most of the text has no word spaces."""
    return f"CASE WHEN 2 * n_unspaced > word_chars THEN 0.98 ELSE {value} END"


#: Shares of words. A rule without ``bad_from`` or ``good_below`` never casts that vote.
RULES = (
    Rule("symbols", "n_symbols / n_words", bad_from=0.2),
    Rule("repeats", "n_repeat_words / n_words", bad_from=0.4),
    Rule("same_lines", "n_dup_lines / greatest(n_lines, 1)", bad_from=0.4),
    Rule("capitals", "n_capitals / greatest(word_chars, 1)", bad_from=0.4),
    Rule("long_words", _spaced("word_chars / n_words"), bad_from=20.0),
    Rule("stops_missing", _spaced("1 - n_stops / n_words"), bad_from=0.99, good_below=0.97),
    Rule("stops_crowded", "n_stops / n_words", bad_from=0.6),
    Rule("not_plain", "1 - n_plain / greatest(word_chars, 1)", bad_from=0.3, good_below=0.1),
)


def counted(docs: DataFrame, text: str = "text", carry: str = "doc_id") -> DataFrame:
    """The counts of every text: words, code points in words, symbols, repeats, lines.

    Column ``carry`` comes along as it is, a struct of a whole row say. ``n_stops`` are words that end in a stop, ``n_plain`` the code points of words
    that are letters only, with their marks, but for one stop at the end, ``n_unspaced``
    those of scripts that put no spaces between words, 0 unless these may be half.
    """
    body = docs.select(F.col(carry), F.coalesce(text, F.lit("")).alias("body"))
    split = body.select(
        carry,
        F.array_remove(F.split("body", WORD_BREAK), "").alias("words"),
        F.filter(F.split("body", "\n"), lambda x: F.ltrim(x, F.lit(SPACES)) != "").alias("lines"),
    )
    words = F.col("words")
    joined = split.select(
        carry,
        "words",
        "lines",
        F.array_join("words", "").alias("joined"),
        F.array_join("words", " ").alias("line"),
        F.transform(
            F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, words[i + 1], words[i + 2]),
        ).alias("windows"),
    )

    def dropped(column: str, pattern: str) -> Column:
        return F.length(column) - F.length(F.regexp_replace(column, pattern, ""))

    return joined.select(
        carry,
        F.size("words").cast("long").alias("n_words"),
        F.length("joined").cast("long").alias("word_chars"),
        dropped("joined", SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("windows")) == F.size("windows"), F.lit(0))
        .otherwise(_covered(F.col("windows")))
        .cast("long")
        .alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        dropped("joined", "[A-Z]+").cast("long").alias("n_capitals"),
        dropped("line", rf"[{STOPS}](?= |\z)").cast("long").alias("n_stops"),
        dropped("line", rf"(?<![^ ])\p{{L}}++(?:[\p{{L}}\p{{M}}]++)?+(?![^ {STOPS}])").cast("long").alias("n_plain"),
        # Half of a text in scripts of three bytes a character makes two bytes on average.
        F.when(
            F.octet_length("joined") >= 2 * F.length("joined"),
            dropped("joined", f"[{''.join(UNSPACED)}]+"),
        )
        .otherwise(0)
        .cast("long")
        .alias("n_unspaced"),
    )


def _covered(windows: Column) -> Column:
    """Words that lie in a three-word window found twice or more.

    Sorted by window, a repeated one stands beside its equal; sorted by place, each
    covers its own words up to the next one's.
    """
    placed = F.sort_array(
        F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    )

    def repeated(sorted_windows: Column) -> Column:
        n = F.size(sorted_windows)
        twice = F.filter(
            sorted_windows,
            lambda x, i: (
                ((i > 0) & (F.get(sorted_windows, i - 1)["w"] == x["w"]))
                | ((i < n - 1) & (F.get(sorted_windows, i + 1)["w"] == x["w"]))
            ),
        )
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def total(places: Column) -> Column:
        steps = F.transform(
            places,
            lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, F.lit(3)), F.lit(3)),
        )
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    return _bound(placed, lambda s: _bound(repeated(s), total))


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def voted(counts: DataFrame) -> DataFrame:
    """``votes``: per rule 1 for good, -1 for bad, 0 for abstaining."""
    votes = [
        F.when(F.col("n_words") == 0, 0)
        .when(F.expr(rule.value) >= rule.bad_from, -1)
        .when(F.expr(rule.value) < rule.good_below, 1)
        .otherwise(0)
        .cast("int")
        for rule in RULES
    ]
    return counts.withColumn("votes", F.array(*votes))


def fitted(votes: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row: the ``patterns`` seen, each with its posterior after ``rounds`` of EM."""
    return fitted_counts(votes.groupBy("votes").agg(F.count(F.lit(1)).alias("n")), rounds)


def fitted_counts(counts: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``fitted`` from the rows ``n`` of each pattern of ``votes``."""
    seen = counts.select("votes", F.col("n").cast("double").alias("n"))
    row = seen.agg(F.array_sort(F.collect_list(F.struct("votes", "n"))).alias("seen"))
    cells = F.array(
        *[
            F.struct(F.lit(j).alias("j"), F.lit(v).alias("v"))
            for j in range(len(RULES))
            for v in (-1, 0, 1)
        ]
    )

    def start(p: Column) -> Column:
        bad = F.exists(p["votes"], lambda v: v == -1)
        good = F.exists(p["votes"], lambda v: v == 1)
        return (
            F.when(bad, F.lit(1 - FIRM)).when(good, F.lit(FIRM)).otherwise(F.lit(PRIOR))
        )

    def shares(q: Column) -> Column:
        """Per rule and vote: how often either class casts it, smoothed."""
        good = F.aggregate(
            F.zip_with("seen", q, lambda p, x: p["n"] * x), F.lit(0.0), lambda a, b: a + b
        )
        total = F.aggregate(F.col("seen"), F.lit(0.0), lambda a, p: a + p["n"])

        def cell(c: Column) -> Column:
            cast = F.zip_with(
                "seen",
                q,
                lambda p, x: F.when(
                    F.get(p["votes"], c["j"]) == c["v"],
                    F.struct((p["n"] * x).alias("g"), (p["n"] * (1 - x)).alias("b")),
                ).otherwise(F.struct(F.lit(0.0).alias("g"), F.lit(0.0).alias("b"))),
            )
            both = F.aggregate(
                cast,
                F.struct(F.lit(0.0).alias("g"), F.lit(0.0).alias("b")),
                lambda a, x: F.struct((a["g"] + x["g"]).alias("g"), (a["b"] + x["b"]).alias("b")),
            )
            return _bound(
                both,
                lambda s: F.when(c["v"] == 0, F.lit(0.0)).otherwise(
                    F.log(
                        (s["g"] + SMOOTHING)
                        / (good + 3 * SMOOTHING)
                        / ((s["b"] + SMOOTHING) / (total - good + 3 * SMOOTHING))
                    )
                ),
            )

        odds = F.lit(math.log(PRIOR / (1 - PRIOR)))
        return F.struct(odds.alias("odds"), F.transform(cells, cell).alias("cells"))

    def posterior(model: Column) -> Column:
        def of(p: Column) -> Column:
            log_odds = F.aggregate(
                F.transform(p["votes"], lambda v, j: F.get(model["cells"], j * 3 + v + 1)),
                model["odds"],
                lambda a, b: a + b,
            )
            return 1 / (1 + F.exp(-log_odds))

        return F.transform("seen", of)

    q = F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)),
        F.transform("seen", start),
        lambda q, _: _bound(shares(q), posterior),
    )
    named = F.zip_with(
        "seen",
        q,
        lambda p, x: F.struct(
            p["votes"].alias("votes"), p["n"].alias("n"), x.alias("posterior")
        ),
    )
    return row.select(named.alias("patterns"))


def accuracies(patterns: DataFrame) -> DataFrame:
    """Per rule, the estimated share of its votes that name the right class."""
    each = patterns.select(F.explode("patterns").alias("p")).select(
        F.posexplode("p.votes").alias("j", "vote"), "p.n", "p.posterior"
    )
    right = F.when(F.col("vote") == 1, F.col("posterior")).otherwise(1 - F.col("posterior"))
    names = F.element_at(F.array(*[F.lit(r.name) for r in RULES]), F.col("j") + 1)
    return (
        each.where("vote <> 0")
        .groupBy(names.alias("rule"))
        .agg(
            F.sum("n").cast("long").alias("n_votes"),
            (F.sum(F.col("n") * right) / F.sum("n")).alias("accuracy"),
        )
    )


def judged(docs: DataFrame, text: str = "text", carry: str = "doc_id") -> DataFrame:
    """Counts, votes, ``posterior`` and ``kept`` of every row of ``docs``, beside ``carry``.

    A narrow ``carry`` is written beside the counts; rows with a text among what they
    carry are counted again instead, so that no second copy of the texts is stored.
    """
    votes = voted(counted(docs, text, carry))
    if isinstance(docs.schema[carry].dataType, T.StructType):
        seen = staged(votes.groupBy("votes").agg(F.count(F.lit(1)).alias("n")))
    else:
        votes = staged(votes)
        seen = votes.groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
    patterns = fitted_counts(seen).select(F.explode("patterns").alias("p"))
    patterns = patterns.select("p.votes", "p.posterior")
    base_failed = (F.col("n_words") < 50) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )
    # One condition on both sides of the join: a filter on it is not pushed into the
    # counting, where it would be spelled out anew for every column it names.
    kept = F.when(base_failed, F.lit(False)).otherwise(F.col("posterior") >= KEEP_FROM)
    # At most 3 ** len(RULES) rows.
    return (
        votes.join(F.broadcast(patterns), "votes", "left")
        .withColumn("base_failed", base_failed)
        .withColumn("kept", kept)
    )
