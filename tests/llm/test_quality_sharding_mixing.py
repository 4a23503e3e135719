import itertools
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import awkward, awkward_rows, counts, empty, words
from pyspark.sql import functions as F

from punctual.llm import mixing, quality, queries, ranks, sharding
from punctual.llm.words import word_count

SMALL = "/root/testdata/sf0.001"


def test_quality_counts_equal_brute_force(spark):
    got = Counter(tuple(row) for row in quality.judge(awkward(spark)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect())
    want = Counter((row[0], *counts(row[1]).values()) for row in awkward_rows())
    assert got == want


def test_quality_keeps_columns_and_fails_null(spark):
    docs = awkward(spark)
    judged = quality.judge(docs)
    assert [c for c in docs.columns if c not in judged.columns] == []
    assert {row.kept for row in judged.filter("text is null or text = ''").collect()} == {False}
    assert quality.judge(empty(spark)).count() == 0
    assert quality.judge(docs.drop("lang"), lang=None).count() == docs.count()


def test_passing_documents_are_the_kept_ones(spark):
    docs = awkward(spark)
    kept = Counter(row.doc_id for row in quality.judge(docs).filter("kept").collect())
    passed = quality.passing(docs)
    plan = passed._jdf.queryExecution().executedPlan().toString()  # taken before it runs, so it is there once
    assert plan.count("split(") == 2 and "Python" not in plan  # words and lines
    assert passed.columns == docs.columns and Counter(row.doc_id for row in passed.collect()) == kept
    assert {row.kept for row in passed.collect()} <= {"k"}  # the column of that name in the input comes through
    assert quality.passing(empty(spark)).count() == 0


def test_quality_is_one_projection(spark):
    plan = queries.quality_rules(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


CLEAN = {
    "russian": "Вчера вечером мы долго гуляли вдоль реки и говорили о книгах которые прочли этим летом а потом вернулись домой пили чай слушали дождь и строили планы на осень чтобы снова поехать к морю",
    "english": "Yesterday evening we walked along the river and talked of the books that we had read in the summer and then we came home to drink tea and listen to the rain on the roof",
}


@pytest.mark.parametrize("name,lang,kept", [
    ("russian", "ru", True), ("russian", None, True), ("russian", "en", False), ("english", "en", True), ("english", "fr", True), ("english", None, True)])
def test_clean_texts_are_kept(spark, name, lang, kept):
    texts = [CLEAN[name]] if name == "russian" else [CLEAN[name], CLEAN[name].title()]
    df = spark.createDataFrame([(i, text, lang) for i, text in enumerate(texts)], "doc_id long, text string, lang string")
    assert {row.kept for row in quality.judge(df).collect()} == {kept}
    hits = quality.measures(df.withColumn("text", F.upper("text"))).first()["stop_word_hits"]
    assert hits is None if lang not in quality.STOP_WORDS else (hits >= 2) == (name == "english")


@pytest.mark.parametrize("lang", ["pl", None])
def test_stop_words_count_without_a_list(spark, lang):
    junk = " ".join(f"buy{chr(97 + i)} cheapest{chr(97 + i)}" for i in range(20))
    texts = [junk, CLEAN["english"], CLEAN["russian"]]
    df = spark.createDataFrame([(i, text, lang) for i, text in enumerate(texts)], "doc_id long, text string, lang string")
    got = {row.doc_id: (row.kept, row.unlisted_stop_word_hits) for row in quality.judge(df).collect()}
    assert got[0] == (False, 0) and got[1][0] and got[1][1] >= 2 and got[2] == (True, None)
    assert [row.doc_id for row in quality.passing(df).collect()] == [1, 2]


def test_every_document_is_asked_for_stop_words(spark, tmp_path):
    import corpus_pipeline

    junk = " ".join(f"купить{i} дёшево{i}" for i in range(20))
    cases = [(junk, None, False), (junk, "ru", False), (junk, "en", False), (CLEAN["english"], "en", True),
             (CLEAN["english"], None, True), (CLEAN["english"], "pl", True), (CLEAN["english"], "fr", False)]
    rows = [(i, text, lang) for i, (text, lang, _) in enumerate(cases)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    judged = {row.doc_id: row.kept for row in queries.quality_rules(spark, str(tmp_path)).collect()}
    assert judged == {i: kept for i, (_, _, kept) in enumerate(cases)}
    passed = corpus_pipeline.keep_good(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert {row.doc_id for row in passed.collect()} == {i for i, kept in judged.items() if kept}


@pytest.mark.parametrize("clash", ["_range", "_rows", "_start", "_inside", "_r_0"])
def test_helper_names_may_be_columns(spark, clash):
    df = spark.range(200).select("id", (F.col("id") % 3).cast("string").alias("source"), (F.col("id") * 2).alias(clash))
    dealt = sharding.assign_shards(df, "source", ["id"], 7)
    assert dealt.columns == ["id", "source", clash, "shard", "slot"]
    assert dealt.filter(F.col(clash) != F.col("id") * 2).count() == 0 and dealt.select("shard", "slot").distinct().count() == 200
    mixed = mixing.fit(df, "source", F.lit(3), ["id"], mixing.cycling_weight([2, 1]), 3)
    assert clash in mixed.columns and mixed.filter(F.col(clash) != F.col("id") * 2).count() == 0


def test_rule_bounds_and_null_measures(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "m double")
    got = df.select(quality.compile_rules([quality.Rule("m", 2, 2.5)])).collect()
    assert [row[0] for row in got] == [False, True, False, True]
    assert df.select(quality.compile_rules([])).distinct().collect() == [(True,)]


@pytest.mark.parametrize("per_range", [1, 3, 1000])
def test_ranks_are_gapless_in_groups(spark, monkeypatch, per_range):
    monkeypatch.setattr(ranks, "ROWS_PER_RANGE", per_range)
    df = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 3).alias("g"), "id",
        ranks.unit_interval(F.xxhash64("id")).alias("p"))
    rows = ranks.ranked_in_groups(df, ["g"], "p", ["id"], "r", "n").collect()
    by = defaultdict(list)
    for row in rows:
        by[row.g].append((row.p, row.id, row.r, row.n))
    for group in by.values():
        group.sort()
        assert [r for _, _, r, _ in group] == list(range(1, len(group) + 1))
        assert {n for *_, n in group} == {len(group)}
    whole = ranks.ranked_in_groups(df, [], "p", ["id"], "r", "n").orderBy("p", "id").collect()
    assert [row.r for row in whole] == list(range(1, 501))


def test_sources_of_one_row_are_spread(spark, monkeypatch):
    positions, ranked = [], sharding.ranked_in_groups

    def seen(df, group, position, *rest):
        positions.append(df.select(position))
        return ranked(df, group, position, *rest)

    monkeypatch.setattr(sharding, "ranked_in_groups", seen)
    df = spark.range(300).select("id", F.col("id").alias("source"))
    assert sharding.assign_shards(df, "source", ["id"], 10).count() == 300
    tenths = Counter(int(row[0] * 10) for row in positions[1].collect())
    assert len(tenths) == 10 and max(tenths.values()) < 60


def test_shards_are_even_gapless_and_match_the_mixture(spark):
    df = spark.range(1003).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    rows = sharding.assign_shards(df, "source", ["id"], 10).collect()
    shards = defaultdict(list)
    for row in rows:
        shards[row.shard].append(row)
    assert sorted(shards) == list(range(10))
    assert {len(part) for part in shards.values()} <= {100, 101}
    for part in shards.values():
        assert sorted(row.slot for row in part) == list(range(len(part)))
    share = Counter(row.source for row in rows)
    for part, source in itertools.product(shards.values(), share):
        assert abs(sum(row.source == source for row in part) - share[source] / 10) <= 2
    again = sharding.assign_shards(df.repartition(7), "source", ["id"], 10).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    other = sharding.assign_shards(df, "source", ["id"], 10, seed=1).collect()
    assert sorted(map(tuple, rows)) != sorted(map(tuple, other))


def test_sharding_awkward_rows(spark):
    dealt = sharding.assign_shards(awkward(spark), "source", ["doc_id", "text"], 4)
    rows = dealt.collect()
    assert Counter(row.shard for row in rows) == {0: 6, 1: 5, 2: 6, 3: 5} or max(Counter(r.shard for r in rows).values()) <= 6
    assert sharding.assign_shards(empty(spark), "source", ["doc_id"], 4).count() == 0
    few = sharding.assign_shards(spark.range(2).withColumn("source", F.lit(None).cast("string")), "source", ["id"], 40)
    assert sorted(row.slot for row in few.collect()) == [0, 0]


def test_shard_query_against_definition(spark):
    rows = queries.stratified_shards(spark, SMALL).collect()
    docs = {row.doc_id: row for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    sizes = Counter(row.shard for row in rows)
    assert set(sizes) == set(range(40)) and max(sizes.values()) - min(sizes.values()) <= 1
    for row in rows:
        raw = (docs[row.doc_id].text or "").encode()
        assert (row.size, row.text_crc32, row.law, row.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)


def test_knapsack_against_every_choice():
    sizes, counts_ = [3, 5, 7], [2, 1, 3]
    choices = [c for c in itertools.product(range(3), range(2), range(4))]
    for budget in range(0, 40):
        best = max(sum(s * n for s, n in zip(sizes, c)) for c in choices if sum(s * n for s, n in zip(sizes, c)) <= budget)
        got = mixing.knapsack(sizes, counts_, budget)
        assert all(0 <= n <= most for n, most in zip(got, counts_))
        assert sum(s * n for s, n in zip(sizes, got)) == best
        spent = mixing.spend(sizes, counts_, budget)
        assert all(0 <= n <= most for n, most in zip(spent, counts_))
        assert sum(s * n for s, n in zip(sizes, spent)) <= budget


def test_spend_large_budgets_within_bounds(monkeypatch):
    monkeypatch.setattr(mixing, "DP_WORDS", 50)
    sizes, counts_ = [1, 90, 1000, 77], [3, 40, 5, 60]
    whole = sum(s * n for s, n in zip(sizes, counts_))
    for budget in (0, 1, 51, 500, 4000, whole - 1, whole, whole + 5):
        taken = mixing.spend(sizes, counts_, budget)
        assert all(0 <= n <= most for n, most in zip(taken, counts_))
        assert min(budget, whole) - 90 <= sum(s * n for s, n in zip(sizes, taken)) <= budget


def brute_targets(sizes, weights, ceiling=3):
    total, full = sum(sizes), set()
    while True:
        left = total - sum(ceiling * sizes[i] for i in full)
        weight = sum(w for i, w in enumerate(weights) if i not in full)
        target = [ceiling * s if i in full else left * weights[i] / weight for i, s in enumerate(sizes)]
        over = {i for i, s in enumerate(sizes) if i not in full and target[i] > ceiling * s}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("sizes", [[10, 1000, 1000], [1, 2, 3, 4000], [5, 5, 5], [0, 100, 7, 90, 3], [100]])
def test_targets_equal_repeated_resharing(spark, sizes):
    names = [*map(str, range(len(sizes) - 1)), None]
    df = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    got = mixing.targets(df, "source", mixing.cycling_weight([5, 2, 1]), 3).collect()
    by = {row.source: row.target for row in got}
    weights = [[5, 2, 1][i % 3] for i in range(len(sizes))]
    assert [by[name] for name in names] == pytest.approx(brute_targets(sizes, weights))


def test_mixture_meets_targets_and_bounds(spark):
    rows = queries.subset_sum_mixture(spark, "/root/testdata/sf0.01").collect()
    docs = {row.doc_id: row for row in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(docs)
    taken, target, whole = Counter(), {}, Counter()
    for row in rows:
        assert row.size == len(words(docs[row.doc_id].text)) and row.taken in (0, row.size, 2 * row.size, 3 * row.size)
        taken[row.source] += row.taken
        whole[row.source] += row.size
        target[row.source] = row.target
    for source in target:
        assert abs(taken[source] - target[source]) <= 3
    names = sorted(whole)
    assert [target[n] for n in names] == pytest.approx(brute_targets([whole[n] for n in names], [[5, 2, 1][i % 3] for i in range(len(names))]))
    again = queries.subset_sum_mixture(spark, "/root/testdata/sf0.01").collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)


def test_mixing_awkward_rows(spark):
    docs = awkward(spark)
    args = ("source", word_count(F.col("text")), ["doc_id"], mixing.cycling_weight([5, 2, 1]))
    fitted = mixing.fit(docs, *args).collect()
    assert len(fitted) == docs.count() and {row.copies for row in fitted} <= {0, 1, 2, 3}
    mixed = mixing.mix(docs, *args)
    assert mixed.columns == docs.columns and mixed.count() == sum(row.copies for row in fitted)
    assert mixing.fit(empty(spark), *args).count() == 0


def test_mixing_leaves_documents_where_they_are(spark):
    docs = spark.createDataFrame([(at, "w " * (at % 5 + 1), f"s{at % 3}") for at in range(300)], "id long, text string, source string")
    mixed = mixing.mix(docs, "source", word_count(F.col("text")), ["id"], mixing.cycling_weight([5, 2, 1]))
    plan = mixed._jdf.queryExecution().executedPlan().toString()  # before each sort and join moved whole rows
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Window" not in plan


def test_mixing_takes_some_of_the_rows_with_one_key(spark):
    rows = [(key, name, length) for name, number in (("a", 40), (None, 90)) for length in (3, 4) for key in [None, 1, 2] for _ in range(number)]
    docs = spark.createDataFrame(rows, "id long, source string, length int")
    fitted = mixing.fit(docs, "source", F.col("length"), ["id"], mixing.cycling_weight([5, 2, 1])).collect()
    assert Counter((row.id, row.source, row.length) for row in fitted) == Counter(rows)
    cut = defaultdict(lambda: defaultdict(set))
    for row in fitted:
        cut[row.source, row.length][row.id].add(row.copies)
    assert all(sum(len(copies) > 1 for copies in by_key.values()) <= 1 for by_key in cut.values())
    assert any(len(copies) > 1 for by_key in cut.values() for copies in by_key.values())
    for name in ("a", None):
        taken = sum(row.copies * row.size for row in fitted if row.source == name)
        assert abs(taken - next(row.target for row in fitted if row.source == name)) <= 3
