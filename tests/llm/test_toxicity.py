import math
import random
import zlib

import pytest
from helpers import awkward, awkward_rows, empty

from punctual.llm import queries, toxicity

CLEAN = "the tide came in and the crew of the old ship slept under a red port light near mast keel rope bay star".split()


def test_folding():
    assert toxicity.fold("ＳＣＵＭ, sсum; $cum\nscum") == " scum scum scum scum "
    assert toxicity.fold("1d1ot Idiоt id​iot") == " idiot idiot idiot "
    assert toxicity.fold("c1own clown cIown") == " ciown ciown ciown "
    assert toxicity.fold(None) == toxicity.fold("") == " " and toxicity.fold(" \n") == " "


def brute_excess(lexicon, text):
    """Every entry and phrase is looked for at every place."""
    folded = toxicity.fold(text)
    best, hidden = {}, set()
    for at in range(len(folded)):
        for key, weight in lexicon.entries.items():
            if folded.startswith(key, at):
                best[at] = max(best.get(at, 0.0), weight)
        for key in lexicon.phrases:
            if folded.startswith(key, at):
                hidden |= set(range(at, at + len(key) - 1))
    words = len(folded.split())
    return (sum(w for at, w in best.items() if at not in hidden) - lexicon.usual * words) / math.sqrt(words + toxicity.LENGTH_SHIFT)


def test_matching_against_every_place():
    lexicon = toxicity.Lexicon({" fooi ": 2.0, " foo": 1.0, " scum": 3.0, " a ": 0.5}, frozenset({" pond scum ", " a fooi "}), 0.01)
    chance = random.Random(1)
    matcher = lexicon.matcher()
    for _ in range(500):
        text = chance.choice([" ", ", ", "\n"]).join(chance.choice("fool foo fooled scum scummy pond a la x".split()) for _ in range(chance.randrange(9)))
        assert matcher.excess(text) == pytest.approx(brute_excess(lexicon, text))


def test_shorter_and_longer_entries():
    found = {" idi": (40, 0), " idiot": (40, 0), " idiot ": (40, 0)}
    assert list(toxicity.choose(found, 1000, 9000)) == [" idiot "]
    stem = {" bli": (60, 2)} | {f" bli{end} ": (12, 0) for end in "abcde"}
    assert list(toxicity.choose(stem, 1000, 9000)) == [" bli"]
    common = {" ios": (45, 3000), " ioser ": (40, 0)}
    assert list(toxicity.choose(common, 1000, 9000)) == [" ioser "]


def planted(spark, copies=0):
    """Texts with insults, stems with any ending, one harmless phrase; labels with nulls, repeats and other ids."""
    chance = random.Random(2)
    docs, labels = [], []
    for i in range(1500):
        words = [chance.choice(CLEAN) + chance.choice("abcdefgh") for _ in range(chance.randrange(5, 80))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(1 + len(words) // 20):
                words[chance.randrange(len(words))] = chance.choice(["nitwit", "n1twit", "NITWIT!", "grobl" + chance.choice("aeiou") + chance.choice("xyz")])
        elif i % 6 == 1:
            words[2:4] = ["prize", "nitwit"]
        docs.append((i, " ".join(words), "en"))
        labels.append((i, int(toxic)))
    for k in range(copies):
        docs.append((5000 + k, " ".join(f"copied{i} text" for i in range(25)) + f" edition {k}", "en"))
        labels.append((5000 + k, 1))
    labels += [(0, 1), (None, 1), (3, None), (99_999, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string, score string").repartition(4), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_words_stems_and_phrases(spark):
    docs, labels = planted(spark, copies=300)
    lexicon = toxicity.learn(docs, labels, "doc_id")
    folded = toxicity.fold("copied")
    assert not [term for term in lexicon.entries if term.startswith((folded.rstrip(), " edit", " text"))]
    assert " nitwit " in lexicon.entries and " grobi" in lexicon.entries
    assert " prize nitwit " in lexicon.phrases
    extra = spark.createDataFrame([(1, "you absolute n1tw1t"), (2, "the prize nitwit of the bay"), (3, "groblandor speaks"), (4, None), (5, "the tide " * 30_000)], "id long, text string")
    got = {row.id: row for row in toxicity.score(extra, lexicon).collect()}
    assert [got[i].predicted for i in range(1, 6)] == [1, 0, 1, 0, 0]
    scored = toxicity.score(docs, lexicon)
    assert scored.columns == ["doc_id", "text", "score", "predicted"]
    wrong = scored.join(labels.filter("doc_id < 1500"), "doc_id").filter("predicted <> toxic").count()
    assert wrong <= 15


def test_bounded_sample_and_reruns(spark):
    docs, labels = planted(spark)
    sample = toxicity.fit_sample(docs, labels, "doc_id", "text", "toxic", 100)
    assert 0 < sample.count() <= 100
    assert toxicity.learn(docs, labels, "doc_id", phrases=["Old  Nitwit"]) == toxicity.learn(docs.repartition(7), labels, "doc_id", phrases=["old nitwit"])


def test_awkward_rows(spark):
    docs, labels = awkward(spark), spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    for lexicon in (toxicity.learn(docs, labels, "doc_id"), toxicity.learn(docs, labels.filter("toxic = 1"), "doc_id"), toxicity.learn(docs, labels.limit(0), "doc_id")):
        rows = toxicity.score(docs, lexicon).collect()
        assert len(rows) == len(awkward_rows()) and all(0 <= row.score <= 1 for row in rows)
        assert len({row.score for row in rows if row.text == awkward_rows()[5][1]}) == 1
    assert toxicity.score(empty(spark), toxicity.Lexicon({})).count() == 0
    assert toxicity.learn(empty(spark), labels, "doc_id").entries == {}


def test_query_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    scored = queries.QUERIES["op11_weighted_lexicon"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = scored.join(labels, "doc_id", "left").select("doc_id", "held_out", "score", "predicted", "toxic").collect()
    assert len(rows) == 10_000
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) for row in rows)
    held = [row for row in rows if row.held_out and row.toxic is not None]
    caught = [row.predicted for row in held if row.toxic == 1]
    wrong = [row.predicted for row in held if row.toxic == 0]
    assert sum(caught) / len(caught) > 0.85 and sum(wrong) / len(wrong) < 0.01
