import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import awkward, awkward_rows, classes, empty, low, sentence, words
from pyspark.sql import functions as F

from punctual.llm import bpe, hashing, hmm, minhash, queries, tokenfiles
from punctual.session import scratch_path

SMALL = "/root/testdata/sf0.001"
RANK_PATH = public_tokenizers.path(queries.RANKS)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANK_PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_library_and_round_trips(reference):
    mine = bpe.tokenizer(RANK_PATH, public_tokenizers.PATTERN)
    chance = random.Random(3)
    parts = ["a", "the", " ", "\n", "é", "漢", "😀", "ing", "0", "***", "'s", "ß", "ок", "aaaa", "\x00", "́"]
    texts = ["".join(chance.choice(parts) for _ in range(chance.randrange(40))) for _ in range(3000)]
    texts += ["".join(chr(chance.choice([chance.randrange(128), chance.randrange(0x250), chance.randrange(0x3040, 0x9FFF)])) for _ in range(15)) for _ in range(2000)]
    for text in [*texts, "ab" * 20_000, "<|endoftext|>"]:
        ids = np.frombuffer(mine.encode(text), "<u4").tolist()
        assert ids == reference.encode_ordinary(text)
        assert mine.decode(mine.encode(text)) == text.encode()


def test_bpe_query_on_awkward_rows(spark, reference):
    docs = awkward(spark)
    both = bpe.decode(bpe.encode(docs, RANK_PATH, public_tokenizers.PATTERN), RANK_PATH, public_tokenizers.PATTERN)
    rows = both.collect()
    assert both.columns == [*docs.columns, "ids", "decoded"] and len(rows) == len(awkward_rows())
    for row in rows:
        assert np.frombuffer(row.ids, "<u4").tolist() == reference.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()
    assert bpe.encode(empty(spark), RANK_PATH, public_tokenizers.PATTERN).count() == 0
    once = bpe.encode_and_decode(docs, RANK_PATH, public_tokenizers.PATTERN)
    assert once.columns == both.columns
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in once.collect()) == Counter(
        (r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in rows)


def test_bpe_query_digests(spark, reference):
    docs = {row.doc_id: row.text or "" for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.byte_level_bpe(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = reference.encode_ordinary(docs[row.doc_id])
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(docs[row.doc_id].encode()).hexdigest())
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == want


@pytest.mark.parametrize("piece", [16, 1 << 20])
def test_word_hashes_follow_words(monkeypatch, piece):
    monkeypatch.setattr(hashing, "PIECE_BYTES", piece)
    texts = [row[1] for row in awkward_rows()]
    hashes, counts = hashing.word_hashes([None if text is None else text.encode() for text in texts])
    assert counts.tolist() == [len(words(text)) for text in texts]
    flat = [low(word) for text in texts for word in words(text)]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


def brute_scores(rows, states):
    training = [text for key, text in rows if zlib.crc32(str(key).encode() if key is not None else b"") % 5 != 1]
    seen = Counter(low(word) for text in training for word in words(text))
    n, v = sum(seen.values()) + len(training), len(seen) + 1
    out = []
    for key, text in rows:
        tokens = [low(word) for word in words(text)]
        base = sum(math.log10((seen[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        base += math.log10((len(training) + 0.5) / (n + 0.5 * (v + 1)))
        held = zlib.crc32(str(key).encode() if key is not None else b"") % 5 == 1
        out.append((key, held, len(tokens) + 1, sum(seen[t] > 0 for t in tokens) + 1, n, round(base, 6)))
    return out


def test_scores_on_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(hmm, "SPLIT_BYTES", 20_000)
    monkeypatch.setattr(hmm, "COUNT_BYTES", 20_000)
    docs = awkward(spark)
    rows = hmm.score(docs, passes=2, states=3).collect()
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert got == Counter(brute_scores([(row[0], row[1]) for row in awkward_rows()], 3))
    assert all(math.isfinite(row.score) and row.score < 0 for row in rows)
    assert hmm.score(empty(spark)).count() == 0


def test_likelihood_equals_plain_forward_recursion():
    chance = np.random.default_rng(0)
    model = hmm.first_model(chance.random(hmm.PAD), 3, 1)
    counts = np.array([0, 1, 127, 128, 129, 300, 0])
    classes_ = chance.integers(0, hmm.CLASSES, counts.sum()).astype(np.int32)
    got, at = hmm.log_likelihoods(model, classes_, counts), 0
    for place, n in enumerate(counts):
        vector, total = model.start, 0.0
        for token in [*classes_[at : at + n], hmm.END_CLASS]:
            vector = (vector @ model.step) * model.emit[token]
            total += math.log(vector.sum())
            vector = vector / vector.sum()
        at += n
        assert got[place] == pytest.approx(total, rel=1e-9)


def test_expected_counts_leave_out_idle_work(monkeypatch):
    chance = np.random.default_rng(6)
    model, counts, rows, counted = hmm.first_model(chance.random(hmm.PAD), 3, 4), np.array([3, 200, 0, 100]), [], []
    transfer, bincount = hmm.transfer, np.bincount
    monkeypatch.setattr(hmm, "transfer", lambda model, table, ids: rows.append(len(ids)) or transfer(model, table, ids))
    monkeypatch.setattr(hmm.np, "bincount", lambda *given: counted.append(len(given[0])) or bincount(*given))
    got = hmm.expected_counts(model, chance.integers(0, 9, counts.sum()).astype(np.int32), counts)
    assert rows == [2]  # products only for the text of two segments
    assert len(counted) == 3  # one count per state, not per state and step
    np.testing.assert_allclose([got.emit.sum(), got.step.sum(), got.start.sum()], [307, 307, 4])


def test_expected_counts_equal_plain_forward_backward():
    chance = np.random.default_rng(5)
    model = hmm.first_model(chance.random(hmm.PAD), 2, 4)
    counts = np.array([3, 200, 0])
    tokens = chance.integers(0, 9, counts.sum()).astype(np.int32)
    got = hmm.expected_counts(model, tokens, counts)
    start, step, emit, at = np.zeros(2), np.zeros((2, 2)), np.zeros((hmm.PAD, 2)), 0
    for n in counts:
        sequence = [*tokens[at : at + n], hmm.END_CLASS]
        at += n
        forward = [model.start]
        for token in sequence:
            vector = (forward[-1] @ model.step) * model.emit[token]
            forward.append(vector / vector.sum())
        backward = np.ones(2)
        for place in range(len(sequence), 0, -1):
            gamma = forward[place] * backward
            emit[sequence[place - 1]] += gamma / gamma.sum()
            joint = forward[place - 1][:, None] * model.step * (model.emit[sequence[place - 1]] * backward)[None, :]
            step += joint / joint.sum()
            backward = model.step @ (model.emit[sequence[place - 1]] * backward)
            backward /= backward.sum()
        gamma = model.start * backward
        start += gamma / gamma.sum()
    np.testing.assert_allclose(got.start, start)
    np.testing.assert_allclose(got.step, step)
    np.testing.assert_allclose(got.emit, emit, atol=1e-12)


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = queries.hidden_markov_scores(spark, "/root/testdata/sf0.01").collect()
    held = [row for row in rows if row.held_out]
    assert sum(row.score for row in held) > sum(row.base_score for row in held)


@pytest.mark.parametrize("block", [1, 7, 1 << 16])
def test_scan_finds_what_was_written(spark, block):
    docs = awkward(spark)
    path = scratch_path(spark, "test-tokens")
    tokenfiles.write(tokenfiles.hashed_word_ids(docs, "text", "ids"), "ids", path)
    found = tokenfiles.scan(spark, path, block).collect()
    assert sorted(row.n_tokens for row in found) == sorted(len(words(row[1])) for row in awkward_rows())
    assert all(row.complete for row in found)
    by_file = {}
    for row in found:
        by_file.setdefault(row.file, []).append((row.document, row.start, row.n_tokens))
    for rows in by_file.values():
        at = 0
        for number, (document, start, n) in enumerate(sorted(rows)):
            assert (document, start) == (number, at)
            at += n + 1


def test_scan_of_cut_off_and_empty_files(spark, tmp_path):
    (tmp_path / "part-a").write_bytes(np.array([5, 6, 0, 7, 8, 9], "<u4").tobytes())
    (tmp_path / "part-b").write_bytes(b"")
    rows = tokenfiles.scan(spark, str(tmp_path), 2).collect()
    assert sorted((r.file, r.document, r.start, r.n_tokens, r.complete) for r in rows) == [("part-a", 0, 0, 2, True), ("part-a", 1, 3, 3, False)]
    (tmp_path / "part-c").write_bytes(b"abc")
    with pytest.raises(Exception, match="whole number of ids"):
        tokenfiles.scan(spark, str(tmp_path), 2).collect()
    bad = spark.createDataFrame([(bytearray(np.array([1, 0], "<u4").tobytes()),)], "ids binary")
    with pytest.raises(Exception, match="end id"):
        tokenfiles.write(bad, "ids", str(tmp_path / "out"))


def test_scan_reads_files_of_any_name(spark, tmp_path):
    for name in ("train_000.bin", "part-a", "_SUCCESS", ".part-a.crc"):
        (tmp_path / name).write_bytes(np.array([5, 6, 0], "<u4").tobytes())
    assert sorted(row.file for row in tokenfiles.scan(spark, str(tmp_path)).collect()) == ["part-a", "train_000.bin"]
    assert [row.file for row in tokenfiles.scan(spark, str(tmp_path), names="*.bin").collect()] == ["train_000.bin"]


def test_files_of_one_name_stay_apart(spark, tmp_path):
    for folder, ids in (("a", [1, 0, 2, 3, 0]), ("b", [4, 5, 6, 0])):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.bin").write_bytes(np.array(ids, "<u4").tobytes())
    rows = tokenfiles.scan(spark, f"{tmp_path}/*", 2).collect()
    assert sorted((r.file.split("/")[-2:], r.document, r.start, r.n_tokens) for r in rows) == [
        (["a", "x.bin"], 0, 0, 1), (["a", "x.bin"], 1, 2, 2), (["b", "x.bin"], 0, 0, 3)]


def test_scan_query_counts_all_documents(spark):
    want = sorted(len(words(row.text)) for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    assert sorted(row.n_tokens for row in queries.separator_scan(spark, SMALL).collect()) == want


def test_signature_agreement_estimates_jaccard():
    chance = random.Random(2)
    for share in (0.5, 0.8):
        agree = 0
        for trial in range(60):
            common = [chance.randrange(1 << 62) for _ in range(int(share * 100))]
            rest = [chance.randrange(1 << 62) for _ in range(100 - len(common))]
            half = len(rest) // 2
            sets = [np.unique(np.array(common + part, np.uint64)) for part in (rest[:half], rest[half:])]
            owner = np.repeat([0, 1], [len(s) for s in sets])
            made = minhash.signatures(owner, np.concatenate(sets), np.ones(len(owner)), 2)
            agree += (made[0] == made[1]).mean()
        assert agree / 60 == pytest.approx(share, abs=0.03)


@pytest.mark.parametrize("block", [2, 256])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", block)
    chance, rows = random.Random(9), []
    for group in range(12):
        text = sentence(100 + group, 150).split(" ")
        for _ in range(12):
            rows.append(" ".join(text))
            text = list(text)
            text[chance.randrange(len(text))] = "changed%d" % chance.randrange(10**6)
    rows += [None, "", " ", "one two", "one two", "ONE two", sentence(1, 4000)]
    pairs = list(enumerate(rows))
    got = {row.doc_id: row for row in minhash.mark(spark.createDataFrame(pairs, "doc_id long, text string")).collect()}
    want = classes(pairs)
    assert {key: row.class_id for key, row in got.items()} == dict(enumerate(want))
    assert all(row.kept == (row.doc_id == row.class_id) for row in got.values())


@pytest.mark.parametrize("times", [3, 60])
def test_near_duplicates_whose_difference_is_repeated(spark, times):
    rows = []
    for pair in range(40):
        common = " ".join(f"c{pair}x{at}" for at in range(204))
        rows += [common, common + f" {' '.join(f'e{pair}x{at}' for at in range(45))}" * times]
    pairs = list(enumerate(rows))
    got = {row.doc_id: row.class_id for row in minhash.mark(spark.createDataFrame(pairs, "doc_id long, text string")).collect()}
    assert [got[key] for key, _ in pairs] == classes(pairs) == [key // 2 * 2 for key, _ in pairs]


def test_near_duplicates_on_awkward_rows(spark):
    docs = awkward(spark)
    marked = minhash.mark(docs)
    rows = marked.collect()
    assert marked.columns == [c for c in docs.columns if c != "kept"] + ["class_id", "kept"] and len(rows) == docs.count()
    assert sum(row.kept for row in rows if row.doc_id in (5, 6, 7)) == 1
    assert all(row.kept for row in rows if not words(row.text))
    assert minhash.mark(empty(spark)).count() == 0


def test_near_duplicates_query(spark):
    docs = [(row.doc_id, row.text) for row in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()]
    got = {row.doc_id: row.class_id for row in queries.near_duplicates(spark, SMALL).collect()}
    assert [got[key] for key, _ in docs] == classes(docs)


def test_bpe_sizes_of_decoded_texts(spark):
    docs = awkward(spark)
    whole = bpe.encode_and_decode(docs, RANK_PATH, public_tokenizers.PATTERN)
    sizes = bpe.encode_and_decode(docs, RANK_PATH, public_tokenizers.PATTERN, decoded="n", sizes_only=True)
    assert sizes.columns == [*docs.columns, "ids", "n"] and dict(sizes.dtypes)["n"] == "bigint"
    assert Counter((r.doc_id, bytes(r.ids), r.n) for r in sizes.collect()) == Counter(
        (r.doc_id, bytes(r.ids), len(r.decoded)) for r in whole.collect())
