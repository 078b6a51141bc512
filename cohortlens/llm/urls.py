"""URL filter: host and path rules first, boosted trees on lexical features for the rest.

Rules name a host and the beginning of a path; the longest that fits a URL decides.
URLs that a rule judges are the labelled ones: at most ``SAMPLE_ROWS`` of them, whose
keys hash lowest, teach gradient-boosted trees on length, depth, digit ratio, entropy,
parameter counts and statistics of the host's suffix, which are those of all labelled
URLs. The trees judge all others.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits no
rule and is judged by the trees; equal URLs are judged alike; without labelled URLs of
both kinds the trees allow all (or block all, if only blocked ones are known); an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.boosting import Trees, fit_trees
from cohortlens.llm.textbytes import Texts, slices, text_bytes
from cohortlens.sources.staging import staged

SAMPLE_ROWS = 20_000
BLOCK_FROM = 0.5
SUFFIX_LABELS = (1, 2)  # labels of a host that make a suffix
BROADCAST_SUFFIXES = 200_000  # suffixes sent to every task; beyond, URLs are shuffled
PRIOR_WEIGHT = 10.0  # labelled URLs that a suffix's block rate is drawn to the mean by
UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def parted(pages: DataFrame, url: str = "url") -> DataFrame:
    """``host`` (A-Z in lower case) and ``path`` beside what there is."""
    at = F.coalesce(F.instr(F.col(url), "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    return pages.withColumns(
        {
            "host": F.translate(host, UPPER, LOWERED),
            "path": F.regexp_extract(after, "^[^?#]*", 0),
        }
    )


def ruled(parts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``rule`` and ``ruling`` of the longest rule that fits; null where none does."""

    def fits(rule: Rule) -> Column:
        host = F.col("host")
        return ((host == rule.host) | host.endswith("." + rule.host)) & F.startswith(
            F.col("path"), F.lit(rule.path)
        )

    name = ruling = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        name = F.when(fits(rule), rule.name).otherwise(name)
        ruling = F.when(fits(rule), rule.verdict).otherwise(ruling)
    return parts.withColumns({"rule": name, "ruling": ruling})


_MARKS = (b"/", b"-", b".", b"_", b"%", b"?", b"&", b"=", b"#", b"0123456789", UPPER.encode())


def _counts(part: Texts, signs: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(signs)] = True
    sums = np.r_[0, np.cumsum(table[part.data], dtype=np.int64)]
    return sums[part.starts[1:]] - sums[part.starts[:-1]]


def _entropy(part: Texts) -> np.ndarray:
    row = np.repeat(np.arange(len(part)), np.diff(part.starts))
    key, n = np.unique(row * 256 + part.data, return_counts=True)
    size = np.maximum(np.diff(part.starts), 1)
    share = n / size[key // 256]
    return np.bincount(key // 256, -share * np.log2(share), len(part))


def lexical(part: Texts, host: Texts) -> np.ndarray:
    """Lexical features of URLs and their hosts."""
    size = np.diff(part.starts)
    marks = [_counts(part, m) for m in _MARKS]
    digits = marks[9] / np.maximum(size, 1)
    return np.stack(
        [
            size, np.diff(host.starts), *marks, digits, _entropy(part), _entropy(host),
            _counts(host, b"."), _counts(host, b"-"), _counts(host, b"0123456789"),
        ],
        axis=1,
    ).astype(np.float64)


def with_suffixes(parts: DataFrame) -> DataFrame:
    """``parts`` beside the block rate and log count of their hosts' suffixes.

    Rates are of all URLs that a rule judges, smoothed towards their mean; a suffix of
    none of them has the mean and a count of 0. Suffixes are sent to every task while
    they are few, and joined by a shuffle beyond.
    """
    known = parts.where("ruling IS NOT NULL").withColumn(
        "blocked", (F.col("ruling") == "block").cast("double")
    )
    total = known.agg(F.sum("blocked").alias("b"), F.count(F.lit(1)).alias("n")).first()
    mean = ((total.b or 0.0) + 0.5) / (total.n + 1) if total.n else 0.0
    for labels in SUFFIX_LABELS:
        own = F.substring_index("host", ".", -labels)
        sums = known.groupBy(own.alias(f"suffix_{labels}")).agg(
            F.sum("blocked").alias("b"), F.count(F.lit(1)).alias("n")
        )
        rates = staged(
            sums.select(
                f"suffix_{labels}",
                ((F.col("b") + PRIOR_WEIGHT * mean) / (F.col("n") + PRIOR_WEIGHT)).alias(f"rate_{labels}"),
                F.log1p("n").alias(f"seen_{labels}"),
            )
        )
        few = rates.count() <= BROADCAST_SUFFIXES
        parts = parts.withColumn(f"suffix_{labels}", own)
        parts = parts.join(F.broadcast(rates) if few else rates, f"suffix_{labels}", "left")
        parts = parts.drop(f"suffix_{labels}")
    filled = {f"rate_{k}": mean for k in SUFFIX_LABELS} | {f"seen_{k}": 0.0 for k in SUFFIX_LABELS}
    return parts.fillna(filled)


SUFFIX_COLUMNS = [f"{c}_{k}" for k in SUFFIX_LABELS for c in ("rate", "seen")]


def features(part: Texts, host: Texts, rates: np.ndarray) -> np.ndarray:
    """Lexical features beside those of the hosts' suffixes."""
    return np.hstack([lexical(part, host), rates])


def learned(parts: DataFrame, key: str = "page_id", url: str = "url") -> Trees:
    """Trees of the URLs that a rule judges, a bounded sample of them."""
    known = parts.where("ruling IS NOT NULL").select(url, "host", "ruling", key, *SUFFIX_COLUMNS)
    known = known.orderBy(F.xxhash64(key), key, url).limit(SAMPLE_ROWS).toArrow()
    y = np.array([r == "block" for r in known["ruling"].to_pylist()], float)
    host = text_bytes(known["host"].combine_chunks())
    rates = np.stack([known[c].to_numpy() for c in SUFFIX_COLUMNS], axis=1)
    trees = fit_trees(features(text_bytes(known[url].combine_chunks()), host, rates), y)
    if not len(y):
        trees.intercept = -1.0
    return trees


def judged(pages: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """Per row: key as page_id, host, path, rule, verdict and score (block likelier)."""
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"))
    parts = with_suffixes(ruled(parted(rows)))
    shared = pages.sparkSession.sparkContext.broadcast(learned(parts))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            rates = np.stack([column[c].to_numpy() for c in SUFFIX_COLUMNS], axis=1)
            found = [np.zeros(0)]
            for part in slices(column["url"]):
                low, high = part.first_row, part.first_row + len(part)
                host = text_bytes(column["host"].slice(low, len(part)))
                found.append(shared.value.score(features(part, host, rates[low:high])))
            p = np.concatenate(found)
            verdict = [
                ruling or ("block" if x >= BLOCK_FROM else "allow")
                for ruling, x in zip(column["ruling"].to_pylist(), p, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(column[c] for c in ("page_id", "host", "path", "rule")), pa.array(verdict, pa.string()), pa.array(p)],
                ["page_id", "host", "path", "rule", "verdict", "score"],
            )

    schema = "page_id long, host string, path string, rule string, verdict string, score double"
    return parts.mapInArrow(score, schema)
