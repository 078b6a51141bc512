"""Operators on whole tables: joins, searches, models, and the pipeline."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortlens.llm import (
    boosting,
    decontaminate,
    jaccard,
    langid,
    marks,
    quality,
    registry,
    urls,
)
from cohortlens.llm.components import components
from cohortlens.llm.textbytes import mix

from .conftest import ODD, prose

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def crc_fold(key, folds):
    import zlib

    return zlib.crc32(str(key).encode()) % folds


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def head(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = head(a), head(b)
        parent[max(a, b)] = min(a, b)
    return {n: head(n) for n in nodes}


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = max(1, len(words) - size + 1) if words else 0
    return {tuple(words[i : i + size]) for i in range(n)}


def plain_join(rows, size, percent):
    """Component per key, and set sizes per row: every pair compared."""
    sets = [(key, shingles(text, size)) for key, text in rows]
    links = []
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if a is not None and b is not None and x and y:
                if 100 * both >= percent * (len(x) + len(y) - both):
                    links.append((a, b))
    heads = union_find({k for k, _ in rows if k is not None}, links)
    return Counter((k, len(s), heads.get(k)) for k, s in sets)


def edited(text, seed, n):
    words, r = text.split(), random.Random(seed)
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return " ".join(words)


def held_join(documents, rows, join):
    got = Counter(
        (r.doc_id, r.n_shingles, r.component_id)
        for r in jaccard.similar(documents(rows), join).collect()
    )
    assert got == plain_join(rows, join.size, join.percent)


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 150)] + [(7, 7), (300, 200), (200, 300)]
    links += [(None, 5), (5, None)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    whole = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert {r.node: r.component for r in found.collect()} == union_find({x for p in whole for x in p}, whole)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_join_on_odd_rows(spark, documents, odd, empty):
    twice = [(50, prose(50, 30)), (50, prose(51, 30)), (51, prose(51, 30)), (52, edited(prose(50, 30), 1, 1))]
    held_join(documents, ODD + twice, jaccard.Join(4, 85))
    assert jaccard.similar(odd, jaccard.Join()).count() == len(ODD)
    assert jaccard.similar(empty, jaccard.Join()).count() == 0


@pytest.mark.parametrize("short_run", [1, 8, 1_000])
@pytest.mark.parametrize("join", [jaccard.Join(4, 85), jaccard.Join(5, 80)])
def test_join_on_large_groups_of_near_copies(spark, documents, join, short_run, monkeypatch):
    """Groups beyond the pivots and cells, with similarities about the threshold."""
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    monkeypatch.setattr(jaccard, "SHORT_RUN", short_run)
    monkeypatch.setattr(jaccard, "CELL_CLASSES", 8)
    rows = []
    for g in range(3):
        base = prose(500 + g, 120)
        rows += [(1000 * g + i, edited(base, i, i % 6)) for i in range(60)]
    rows += [(5000 + i, prose(i, 40)) for i in range(20)] + [(6000 + i, prose(1, 40).upper()) for i in range(15)]
    rows += [(7000 + i, "Licensed under the same terms as all " + prose(i, 3)) for i in range(40)]
    random.Random(1).shuffle(rows)
    held_join(documents, rows, join)


def test_near_copies_meet_a_few_times_each(spark, documents, monkeypatch):
    """Along long runs, three rows for each prefix element at most, and one element for those that all share."""
    join, made = jaccard.Join(4, 85), spark.sparkContext.accumulator(0)
    run_pairs = jaccard._run_pairs

    def counting(join):
        pairs = run_pairs(join)

        def counted(batches):
            for batch in pairs(batches):
                made.add(batch.num_rows)
                yield batch

        return counted

    monkeypatch.setattr(jaccard, "_run_pairs", counting)
    base = prose(41, 150)
    words = base.split()
    edits = [(i, " ".join([*words[: 3 * i], f"new{i}", *words[3 * i + 1 :]])) for i in range(45)]
    held_join(documents, edits, join)
    elements = sum(int(join.prefix(len(shingles(text, join.size)))) for _, text in edits)
    assert 0 < made.value <= 3 * elements
    before = made.value
    # The same prefix but for what stands in one text alone: every shared element is one.
    held_join(documents, [(i, f"{base} {prose(i, 6)}") for i in range(45)], join)
    assert 0 < made.value - before <= 3 * 45


def test_elements_met_by_chance_pair_nothing(spark, documents, monkeypatch):
    """Texts of few words share many elements, each with other texts; only near copies are laid together."""
    join, made = jaccard.Join(4, 85), spark.sparkContext.accumulator(0)
    run_pairs = jaccard._run_pairs

    def counting(join):
        pairs = run_pairs(join)

        def counted(batches):
            for batch in pairs(batches):
                made.add(batch.num_rows)
                yield batch

        return counted

    monkeypatch.setattr(jaccard, "_run_pairs", counting)
    r = random.Random(5)
    words = prose(12, 8).split()
    rows = [(i, " ".join(r.choices(words, k=r.randint(100, 220)))) for i in range(300)]
    rows += [(1000 + i, edited(rows[i][1], i, 1)) for i in range(10)]
    held_join(documents, rows, join)
    assert 0 < made.value <= 10 * 3 * 33


def test_sets_that_link_share_a_mark():
    r = np.random.RandomState(3)
    linked = 0
    for percent in (50, 80, 85, 95):
        for most in (8, 20, 150):
            for _ in range(150):
                n = r.randint(1, most + 1)
                common = n - r.randint(0, (100 - percent) * n // 100 + 1)
                whole = common + r.randint(0, (100 - percent) * n // 100 + 1)  # elements of the other
                values = mix(r.randint(1 << 40) + np.arange(n + whole - common).astype(np.uint64))
                if 100 * common < percent * len(values) or len(values) == common:
                    continue
                rows = np.repeat([0, 1], [n, whole])
                values = np.concatenate((values[:n], values[n - common :]))
                found, of = marks.of_sets(values, values % np.uint64(3) > 0, rows, np.array([n, whole]), percent)
                assert set(found[of == 0]) & set(found[of == 1])
                linked += 1
    assert linked > 300


def test_a_common_mark_is_sent_once_and_its_rows_are_linked():
    import pyarrow as pa

    r = np.random.RandomState(4)
    values = mix(r.randint(0, 60, 400).astype(np.uint64))
    pieces = [(100, values[:250], r.randint(0, 30, 250)), (1000, values[250:], r.randint(0, 30, 150))]
    packed, links = zip(*(marks.sent(base, mark, row, 7) for base, mark, row in pieces), strict=True)
    assert all(len(b.column(2)[i].as_py()) // 4 <= 60 for b in packed for i in range(b.num_rows))
    table = pa.Table.from_batches(packed)
    got = [tuple(p) for own in links for p in own.T.tolist()]
    for bucket in range(7):
        own = marks.met(table.filter(pa.compute.equal(table["bucket"], bucket)))
        got += zip(own["a"].to_pylist(), own["b"].to_pylist(), strict=True)
    have = [(base + at, m) for base, mark, row in pieces for m, at in zip(mark.tolist(), row.tolist(), strict=True)]
    first = {}
    want = [(place, first.setdefault(m, place)) for place, m in sorted(have)]
    nodes = {place for place, _ in have}
    assert union_find(nodes, got) == union_find(nodes, want)


def test_links_by_changes_are_those_of_whole_sets(spark, documents):
    """Every two rows of a pivot as components of their own, whatever they have in common."""
    join = jaccard.Join(4, 85)
    base = prose(77, 90)
    rows = [(i, edited(base, i, i % 5)) for i in range(40)] + [(100 + i, prose(i, 60)) for i in range(6)]
    rows += [(200 + i, edited(edited(base, 7, 3), 300 + i, 1)) for i in range(12)] + [(3, prose(3, 30)), (4, " ")]
    keys = sorted({k for k, _ in rows})
    runs = spark.createDataFrame([(p, k, k) for p in (0, 101, 203) for k in keys], "pivot long, cid long, component long")
    sure, maybe, far = jaccard._linked_by_changes(jaccard.staged(runs), documents(rows), "doc_id", "text", join)
    sure, maybe = ({tuple(sorted(r)) for r in pairs.collect()} for pairs in (sure, maybe))
    far = {(r.pivot, r.cid) for r in far.collect()}
    assert far and len(far) < 3 * len(keys)
    near = [{k for k in keys if (p, k) not in far} for p in (0, 101, 203)]
    sets = [(k, shingles(t, join.size)) for k, t in rows]
    true = {
        (a, b)
        for a, x in sets
        for b, y in sets
        if a < b and x and y and 100 * len(x & y) >= join.percent * len(x | y)
    }
    due = {(a, b) for a, b in true if any(a in close and b in close for close in near)}
    assert sure <= true
    found = union_find(keys, sure | (maybe & true))
    assert found == union_find(keys, sure | (maybe & true) | due)
    assert len(maybe) < len(keys) ** 2 / 4


def test_join_shuffles_texts_where_keys_are_many(spark, documents, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 3)
    base = prose(9, 90)
    held_join(documents, [(i, edited(base, i, i % 3)) for i in range(25)], jaccard.Join())


ITEMS = [(i, prose(900 + i, 20 + i * 7).capitalize() + ". " + prose(990 + i, 8).capitalize() + ".") for i in range(12)]


def test_leaks_are_found_and_clean_texts_left(spark, documents, odd, empty, monkeypatch):
    rows = [(i, prose(i, 150) + " " + t.upper().replace(" ", "\n") + " " + prose(60 + i, 300)) for i, t in ITEMS]
    rows += [(100 + i, prose(200 + i, 400)) for i in range(20)]
    # A question without its answer is no leak.
    rows.append((50, prose(1, 30) + " " + decontaminate.split_answer(ITEMS[3][1])[0] + " " + prose(2, 30)))
    items = spark.createDataFrame(ITEMS + [(99, None), (98, ""), (None, "no id")], "item_id long, text string")
    wanted = {(i, i) for i, _ in ITEMS}
    for shard in (8 << 20, 300):  # one index, and several
        monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)
        found = decontaminate.contaminated(documents(rows), items).collect()
        assert {(r.doc_id, r.item_id) for r in found} == wanted
        assert all(r.score > 0.99 for r in found)
    assert decontaminate.contaminated(odd, items).count() == 0
    assert decontaminate.contaminated(empty, items).count() == 0
    assert decontaminate.contaminated(odd, items.where("item_id < 0")).count() == 0


def test_scores_are_the_same_for_one_shard_and_many(spark, documents, monkeypatch):
    """Weights are by the words of all items, wherever these lie; items share words here."""
    common = prose(77, 12)
    items = [(i, f"{common} {prose(300 + i, 25)}. {prose(400 + i, 8)}.") for i in range(24)]
    rows = [(i, f"{prose(i, 90)} {' '.join(t.split()[4:-2])} {prose(i + 50, 90)}") for i, t in items]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = []
    for shard in (8 << 20, sum(len(t) for _, t in items) // 16):
        monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)
        hits = decontaminate.contaminated(documents(rows), table).collect()
        found.append({(r.doc_id, r.item_id): round(r.score, 9) for r in hits})
    assert found[0] == found[1] and len(found[0]) >= 20
    assert min(found[0].values()) < 0.99


def test_retrieval_is_that_of_every_passage_scored():
    """Block bounds drop nothing that reaches the threshold."""
    items = [(i, *decontaminate.split_answer(t)) for i, t in ITEMS] + [(20 + i, prose(i, 4), "") for i in range(40)]
    index = decontaminate.Index(decontaminate.sections(items))
    text = " ".join(prose(i, 30) + " " + t[: 40 + 20 * i] for i, t in ITEMS)
    words = decontaminate.words_of(text)
    rows = np.zeros(len(words), int)
    for threshold in (0.1, 0.3, 0.6):
        got = {(a, s): v for a, _, _, s, v in decontaminate.retrieved(index, words, rows, 1, threshold)}
        want = {}
        for first, last, _ in zip(*decontaminate._passages(rows, 1), strict=True):
            inside = set(words[first:last].tolist())
            score = np.zeros(len(index.parts))
            for t, term in enumerate(index.terms.tolist()):
                if term in inside:
                    own = slice(index.first[t], index.first[t + 1])
                    score[index.section[own]] += index.impact[own]
            want |= {(int(first), int(s)): score[s] for s in np.flatnonzero(score >= threshold - 1e-9)}
        assert got.keys() == want.keys() and len(want) > 3
        assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/../sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{SF}/../sf0.01/labels.parquet")
    found = {r.doc_id: r for r in quality.scored(docs, quality.learned(docs, labels)).collect()}
    marks = {r.doc_id: r.quality for r in labels.collect()}
    held = [k for k in marks if crc_fold(k, 5) == 0]
    assert all(found[k].held_out == (crc_fold(k, 5) == 0) for k in found)
    assert sum(found[k].predicted == marks[k] for k in held) >= 0.95 * len(held)
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in found.values())


def test_quality_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame(
        [(1, 1), (2, None), (None, 1), (4, 0), (4, 0), (4, 1), (6, 1), (8, 0), (13, 1)], "doc_id long, quality int"
    )
    rows = quality.scored(odd, quality.learned(odd, labels)).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    none = quality.learned(empty, labels)
    assert quality.scored(empty, none).count() == 0
    assert {r.score for r in quality.scored(odd, none).collect()} == {0.5}


def test_additive_model_learns_a_pair():
    r = np.random.RandomState(0)
    x = r.rand(4000, 4)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = boosting.fit_additive(x, y)
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == y).mean() > 0.95


def test_trees_learn_and_score_alike():
    r = np.random.RandomState(1)
    x = r.rand(2000, 3)
    y = ((x[:, 0] > 0.3) & (x[:, 2] < 0.6)).astype(float)
    trees = boosting.fit_trees(x, y)
    assert ((trees.score(x) > 0.5) == y).mean() > 0.97
    assert np.allclose(trees.score(x[:50]), trees.score(x)[:50])


def test_languages_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/../sf0.01/documents.parquet")
    found = {r.doc_id: r for r in registry.op9_language(spark, f"{SF}/../sf0.01").collect()}
    known = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [k for k in known if crc_fold(k, 3) == 1]
    assert all(found[k].held_out == (crc_fold(k, 3) == 1) for k in known)
    assert sum(found[k].lang_pred == known[k] for k in held) >= 0.95 * len(held)


def test_viterbi_is_the_best_of_all_ways():
    r = np.random.RandomState(2)
    counts = [0, 1, 5, 0, 7, 2, 6]
    rows = np.repeat(np.arange(len(counts)), counts)
    scores = r.randn(len(rows), 3) * 3
    got = langid.viterbi(scores, rows, len(counts), 1.5)

    def worth(path, own):
        turns = sum(a != b for a, b in zip(path[1:], path[:-1], strict=True))
        return sum(own[i, p] for i, p in enumerate(path)) - 1.5 * turns

    import itertools

    for row, n in enumerate(counts):
        own = scores[rows == row]
        best = max((worth(p, own) for p in itertools.product(range(3), repeat=n)), default=0)
        assert worth(got[rows == row].tolist(), own) == pytest.approx(best)


def test_languages_of_odd_rows_and_mixed_text(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/../sf0.01/documents.parquet")
    model = langid.learned(docs)
    rows = langid.identified(odd, model).collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (1, 2, 3, 12, 13))
    assert all(r.lang_pred in (*model.names, "und") and 0 <= r.score <= 1 for r in rows)
    assert langid.learned(empty).names == []
    assert {r.lang_pred for r in langid.identified(odd, langid.learned(empty)).collect()} == {"und"}
    pair = docs.where("lang IN ('de', 'fr')").groupBy("lang").agg(F.min_by("text", "doc_id").alias("text")).collect()
    both = {r.lang: " ".join(r.text.split()[:40]) for r in pair}
    from cohortlens.llm.textbytes import text_bytes
    import pyarrow as pa

    spans = list(langid.spans(text_bytes(pa.array([both["de"] + " " + both["fr"]])), model))
    assert [model.names[s[3]] for s in spans] == ["de", "fr"]


URLS = [
    (1, "http://a.Example.ORG/es/1"), (2, "http://example.org/en/12?x=1"), (3, "https://org/"), (4, "http://org"),
    (5, "http://x.com/fr/1#y"), (6, "http://x.com/de/"), (7, "http://x.net/de/"), (8, None), (9, ""), (10, "no scheme"),
    (11, "http://notexample.org/es/"), (12, "http://x.com?/de/"), (13, "a://b://c/d"), (14, "http://ÄB.com/de/é?"),
    (5, "http://x.com/fr/1#y"), (None, "http://x.com/de/x"),
]


def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [r for r in urls.RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    return host, path, max(fit, key=lambda r: len(r.name), default=None)


def test_url_rules(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumn("host", F.lit("clash"))
    found = urls.judged(pages).collect()
    got = Counter((r.page_id, r.host, r.path, r.rule) for r in found)
    want = [(k, plain_rule(u)) for k, u in URLS]
    assert got == Counter((k, h, p, r.name if r else None) for k, (h, p, r) in want)
    verdicts = {r.name: r.verdict for r in urls.RULES}
    assert all(r.verdict == verdicts[r.rule] for r in found if r.rule)
    assert {r.verdict for r in found} <= {"allow", "block"}
    assert urls.judged(pages.limit(0)).count() == 0
    assert {r.verdict for r in urls.judged(pages.where("page_id > 7 and page_id < 11")).collect()} == {"allow"}


def test_url_trees_learn_from_rules(spark):
    pages = spark.read.parquet(f"{SF}/../sf0.01/pages.parquet")
    found = [r for r in urls.judged(pages).collect() if r.rule]
    right = sum((r.score >= urls.BLOCK_FROM) == (r.verdict == "block") for r in found)
    assert right >= 0.8 * len(found)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == columns and after.keys() <= before.keys()
        if name == "near_duplicates":
            links = plain_join([(k, r.text) for k, r in before.items()], 5, 80)
            assert after.keys() == {k for k, _, head in links if k == head}
        if name == "benchmark_free":
            leaky = {k for k, r in before.items() if any(i in r.text for i in items)}
            assert after.keys() == before.keys() - leaky and leaky
        if name == "without_secrets":
            assert after.keys() == before.keys()
            assert all(r.n_chars == len(r.text) for k, r in after.items() if r.text != texts[k])
            assert not any(re.search(r"token = \"[0-9a-f]{40}", r.text) for r in after.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    tokens = {r.doc_id: r.n for r in pieces.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert tokens.keys() == {r.doc_id for r in docs.collect()}


def test_pipeline_takes_odd_and_empty_tables(spark, documents, empty):
    for docs in (documents(ODD), empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            held = stage(spark, docs, SF)
            assert held.columns == docs.columns
            docs = spark.createDataFrame(held.collect(), docs.schema)
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()


def test_near_duplicates_keep_one_row_of_each_group(spark, documents):
    base = prose(1, 60)
    docs = documents([(1, base), (1, base), (2, base + " more"), (3, prose(2, 60)), (None, base)])
    kept = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert Counter(r.doc_id for r in kept) == Counter([1, 3, None])


def test_leaks_are_removed_row_by_row(spark, documents, tmp_path, monkeypatch):
    """Null keys are judged like others, and of rows of one key only those with a hit go."""
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    leaks = [prose(1, 60) + " " + t + " " + prose(2, 60) for _, t in ITEMS]
    clean = prose(3, 90)
    rows = [(None, leaks[0]), (None, clean), (None, None), (1, leaks[5]), (1, clean), (2, leaks[11]), (3, "")]
    want = Counter([(None, clean), (None, None), (1, clean), (3, "")])
    for shard in (8 << 20, 300):  # one index, and several
        monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)
        kept = corpus_pipeline.benchmark_free(spark, documents(rows), str(tmp_path)).collect()
        assert Counter((r.doc_id, r.text) for r in kept) == want


def test_every_operator_is_registered():
    numbers = {int(re.match(r"op(\d+)_", name)[1]) for name in registry.queries()}
    assert numbers == set(range(1, 14))
    assert registry.oracle_sql().keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    import duckdb

    table = f"{SF}/documents.parquet"
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{table}')")
    wanted = duck.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in wanted.description]
    found = registry.queries()[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    assert Counter(map(tuple, found.select(*columns).collect())) == Counter(wanted.fetchall())


def test_suffix_statistics_are_of_all_labelled_urls(spark, monkeypatch):
    """A host outside the sample that teaches the trees still has its rates, broadcast or not."""
    rows = [(i, f"http://h{i % 400}.example.org/{'es' if i % 400 % 3 == 0 else 'xx'}/p") for i in range(1200)]
    rows += [(2000, "http://nowhere.net/x"), (2001, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    monkeypatch.setattr(urls, "SAMPLE_ROWS", 50)
    parts = urls.ruled(urls.parted(pages))
    found = urls.with_suffixes(parts).collect()
    blocked = sum(r.ruling == "block" for r in found)
    mean = (blocked + 0.5) / (1200 + 1)
    for r in found:
        known = (r.host or "").endswith("example.org")
        assert r.seen_1 == pytest.approx(np.log1p(1200) if known else 0.0)
        rate = (blocked + urls.PRIOR_WEIGHT * mean) / (1200 + urls.PRIOR_WEIGHT) if known else mean
        assert r.rate_2 == pytest.approx(rate)
    monkeypatch.setattr(urls, "BROADCAST_SUFFIXES", 0)
    assert {tuple(r) for r in urls.with_suffixes(parts).collect()} == {tuple(r) for r in found}


def test_differing_texts_of_one_key_are_judged_row_by_row(spark, documents):
    """The same rows stay at any partitioning; none goes but for another that stays."""
    same = prose(70, 60)
    rows = [(1, prose(i, 60)) for i in range(20)] + [(2, same), (1, same), (1, same), (3, same + " more")]
    rows += [(4, ""), (4, ""), (5, None)]
    kept = []
    for parts in (1, 7, 13):
        found = corpus_pipeline.near_duplicates(spark, documents(rows).repartition(parts), SF).collect()
        kept.append(Counter((r.doc_id, r.text) for r in found))
    assert kept[0] == kept[1] == kept[2]
    assert kept[0] == Counter([*rows[:20], (1, same), (4, ""), (5, None)])


def test_rejected_texts_go_whatever_their_keys(spark, documents):
    good, bad = [(i, prose(i, 80)) for i in range(30)], "# $ % " * 60
    rows = [*good, (None, bad), (7, bad), (8, None), (None, prose(99, 80))]
    found = corpus_pipeline.quality_rules(spark, documents(rows), SF).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter([*good, (None, prose(99, 80))])


@pytest.mark.parametrize("name", ["op4_suffix_dedup", "op5_decontaminate", "op7_ngram_join", "op10_url_filter"])
def test_queries_leave_the_session_as_it_was(spark, name):
    from cohortlens.llm import registry

    before = dict(spark.conf.getAll)
    registry.queries()[name](spark, SF).count()
    assert dict(spark.conf.getAll) == before
