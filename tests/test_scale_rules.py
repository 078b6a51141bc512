"""Results that must not depend on partitioning or on how rows spread over groups."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.functions import fast_row_hash, row_hash
from cohortlens.operators import blocks, distribution, model, rates
from cohortlens.plans import answers
from cohortlens.plans.cleaning import clean_survey
from cohortlens.plans.coded_lineitem import ROW_KEY, coded_lineitem
from cohortlens.spec import CARDIO

TABLES = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def md5_bits(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


@pytest.fixture(scope="module")
def cleaned(spark):
    return clean_survey(coded_lineitem(spark, TABLES), CARDIO, ROW_KEY)


def test_row_hash_value(spark):
    df = spark.createDataFrame([(7, "a"), (None, "b")], "k bigint, t string")
    found = [r[0] for r in df.select(row_hash(["k", "t"])).collect()]
    assert found == [md5_bits("7:a"), md5_bits(":b")]
    salted = df.select(row_hash(["k", "t"], "s")).first()[0]
    assert salted == md5_bits("s:7:a")


def test_fast_hash_is_spread_over_buckets(spark):
    hashed = spark.range(100_000).select((fast_row_hash(["id"]) % 1000 < 100).alias("s"))
    assert 9_500 < hashed.where("s").count() < 10_500
    bounds = spark.range(1000).select(fast_row_hash(["id"]).alias("h")).agg(
        F.min("h"), F.max("h")
    )
    low, high = bounds.first()
    assert 0 <= low < high < 1 << 32


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_sample_and_split_ignore_partitioning(cleaned, parts):
    spread = cleaned.repartition(parts)
    expected = rows(answers.scaled_sample(cleaned, CARDIO, ROW_KEY, 150))
    assert rows(answers.scaled_sample(spread, CARDIO, ROW_KEY, 150)) == expected
    assert len(expected) == 150
    train, test = model.hash_split(model.model_frame(cleaned, CARDIO, ROW_KEY), ROW_KEY)
    again, other = model.hash_split(model.model_frame(spread, CARDIO, ROW_KEY), ROW_KEY)
    assert rows(train) == rows(again)
    assert rows(test) == rows(other)
    assert train.count() + test.count() == model.model_frame(cleaned, CARDIO).count()


@pytest.mark.parametrize("limit", [0, 1, 5, 17, 40, 1000])
def test_limited_sample_with_a_hot_key(spark, limit):
    """A third of the rows are copies; brute force picks the same multiset."""
    data = [(k, k % 3, float(k % 5)) for k in range(200)] + [(0, 0, 0.0)] * 100
    df = spark.createDataFrame(data, "k int, y int, v double").repartition(7)
    ranked = sorted((md5_bits(str(k)), y, v) for k, y, v in data)
    expected = sorted((y, v) for h, y, v in ranked if h % 1000 < 400)
    assert rows(distribution.hash_sample(df, ["k"], ["y", "v"], 400)) == expected
    first = [(y, v) for h, y, v in ranked if h % 1000 < 400][:limit]
    found = distribution.hash_sample(df, ["k"], ["y", "v"], 400, limit)
    assert rows(found) == sorted(first)


def test_sample_includes_hot_key_partly(spark):
    """The limit may fall inside a group of copies."""
    df = spark.range(1000).select(F.lit(1).alias("k"), F.lit(2).alias("v"))
    assert distribution.hash_sample(df, ["k"], ["v"], 1000, 10).count() == 10


def box(numbers):
    q1, median, q3 = np.percentile(numbers, [25, 50, 75])
    reach = 1.5 * (q3 - q1)
    inside = [v for v in numbers if q1 - reach <= v <= q3 + reach]
    return min(min(inside), q1), q1, median, q3, max(max(inside), q3)


@pytest.mark.parametrize("coded", [True, False])
def test_box_statistics_with_outliers_and_repeats(spark, coded):
    generator = np.random.default_rng(5)
    groups = {
        0: [25.0] * 400 + list(np.round(generator.normal(27, 4, 200), 2)) + [79.0, 11.0],
        1: list(generator.normal(30, 6, 301)),
        2: [20.0],
        3: [20.0, 21.0],
    }
    data = [(g, float(v)) for g, vs in groups.items() for v in vs] + [(0, None), (None, 1.0)]
    df = spark.createDataFrame(data, "g int, v double").repartition(5)
    found = distribution.box_stats(df, "g", "v", coded).collect()
    assert [r.g for r in found] == [0, 1, 2, 3]
    for r in found:
        assert r.n_values == len(groups[r.g])
        assert (r.whisker_low, r.q1, r.median, r.q3, r.whisker_high) == pytest.approx(
            box(groups[r.g])
        )


@pytest.mark.parametrize("coded", [True, False])
def test_box_whisker_never_inside_the_box(spark, coded):
    df = spark.createDataFrame([(0, v) for v in (0.0, 1.0, 1.0, 100.0)], "g int, v double")
    found = distribution.box_stats(df, "g", "v", coded).first()
    assert found.q3 == pytest.approx(25.75)
    assert found.whisker_high == pytest.approx(25.75)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_running_total_equals_brute_force(spark, parts):
    data = [(1, k, k % 4) for k in range(300)] + [(None, k, 1) for k in range(7)]
    df = spark.createDataFrame(data, "g int, k int, n int").repartition(parts)
    found = blocks.running_total(df, ["g"], ["k"], "n", "before")
    expected = [(*r, sum(o[2] for o in data if o[0] == r[0] and o[1] < r[1])) for r in data]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    ordered = sorted((tuple(r) for r in found.collect()), key=key)
    assert ordered == sorted(expected, key=key)


def test_rates_from_grain_equal_direct_rates(cleaned):
    keys = [CARDIO.age, CARDIO.flags[0], CARDIO.score, CARDIO.year]
    grain = rates.rate_grain(cleaned, keys, CARDIO.target)
    direct, rolled = answers.rate_on(CARDIO, cleaned), answers.rate_from(grain)
    for query in (
        answers.by_age,
        answers.by_age_labelled,
        answers.by_pressure,
        answers.by_score,
        answers.by_year,
        answers.by_age_and_score,
        answers.age_score_matrix,
    ):
        assert rolled(["YEAR"]).columns == direct(["YEAR"]).columns
        assert query(rolled, CARDIO).collect() == query(direct, CARDIO).collect()


def test_pressure_rates_list_yes_first(cleaned):
    found = answers.by_pressure(answers.rate_on(CARDIO, cleaned), CARDIO, "en").collect()
    assert [r.blood_pressure_group for r in found] == [
        "high blood pressure",
        "no high blood pressure",
    ]


def numbered(data, size):
    position, expected = {}, []
    for group, key in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        index = position.get(group, 0)
        position[group] = index + 1
        expected.append((group, key, index // size + 1))
    return expected


@pytest.mark.parametrize("parts", [1, 4, 16])
@pytest.mark.parametrize("cap", [0, 1, 2, -1])
def test_chunks_equal_brute_force(spark, parts, cap):
    """One group holds most rows, another has no name."""
    data = [(1, k * 3) for k in range(400)] + [(2, k) for k in range(9)]
    data += [(None, k) for k in range(5)] + [(3, 0)]
    df = spark.createDataFrame(data, "g int, k int").repartition(parts)
    slices = blocks.stage_in_order(df, ["g"], ["k"])
    found = blocks.number_chunks(slices, 3, ["g"], max_chunks=cap)
    expected = [r for r in numbered(data, 3) if cap == 0 or r[2] <= cap]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in found.collect()), key=key) == expected


def test_equal_rows_are_numbered(spark, monkeypatch):
    monkeypatch.setattr(distribution, "COPY_RUN", 3)
    data = [(1, "a")] * 10 + [(1, None)] * 4 + [(2, "b")]
    df = spark.createDataFrame(data, "k int, t string").repartition(5)
    found = distribution.number_equal_rows(df, ["k", "t"]).collect()
    want = [(1, "a", i) for i in range(1, 11)] + [(1, None, i) for i in range(1, 5)] + [(2, "b", 1)]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_roll_up_with_unknown_targets(spark):
    data = [(1, 1, 1), (1, 2, None), (1, 2, 0), (2, 1, None), (None, 1, 1)]
    df = spark.createDataFrame(data, "a int, b int, y int")
    rolled = rates.roll_up(rates.rate_grain(df, ["a", "b"], "y"), ["a"])
    assert rows(rolled.na.fill(-1.0)) == rows(rates.rate_by(df, ["a"], "y").na.fill(-1.0))


def test_matrix_refuses_values_that_are_not_listed(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 0, 0)], "a int, s int, y int")
    with pytest.raises(Exception, match="not listed: 5"):
        rates.rate_matrix(df, "a", "s", [0, 1], "y", "s_").collect()