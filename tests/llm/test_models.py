"""Language models: the forward algorithm and losses against brute force, accuracy on held-out documents."""

import math
import random
from itertools import product

import numpy as np
import pytest
from admetrics.llm import langid, lm_scoring, workers
from admetrics.llm.queries import TOKENIZER, held_out
from conftest import SF_DIR
from llm_fixtures import docs  # noqa: F401
from pyspark.sql import functions as F


def segmentations(data):
    for cuts in product([False, True], repeat=len(data) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(data)]
        yield [data[s:e] for s, e in zip(at, at[1:])]


def test_forward_sums_all_segmentations():
    pieces = langid.pieces_of(TOKENIZER)
    number = {p: i for i, p in enumerate(pieces.pieces)}
    rng = np.random.default_rng(1)
    weights = rng.random((len(pieces), 2)) ** 4
    weights /= weights.sum(0)
    words = ["the", "über", "a", "international", "日本", "zz", "q"]
    got = langid.word_scores(pieces, langid.scaled_weights(pieces, weights), words)
    for word, scores in zip(words, got):
        total = sum(
            np.prod([weights[number[p]] for p in cut], axis=0)
            for cut in segmentations(b" " + word.encode())
            if all(p in number for p in cut)
        )
        assert np.allclose(scores, np.log(total))


def test_expected_counts_equal_brute_force():
    pieces = langid.pieces_of(TOKENIZER)
    number = {p: i for i, p in enumerate(pieces.pieces)}
    weights = np.random.default_rng(2).random(len(pieces)) ** 3
    words, counts = ["then", "at", "für"], [3, 1, 2]
    want = np.zeros(len(pieces))
    for word, n in zip(words, counts):
        cuts = [c for c in segmentations(b" " + word.encode()) if all(p in number for p in c)]
        shares = [math.prod(weights[number[p]] for p in c) for c in cuts]
        for cut, share in zip(cuts, shares):
            for p in cut:
                want[number[p]] += n * share / sum(shares)
    got = langid._expected(pieces, langid.scaled_weights(pieces, weights[:, None])[:, 0], words, counts)
    assert np.allclose(got, want)


def test_no_word_is_impossible():
    pieces = langid.pieces_of(TOKENIZER)
    weights = np.full((len(pieces), 1), langid._UNIFORM / len(pieces))
    words = ["\U00020000" * langid.RUN, "z" * langid.RUN, "ü" * langid.RUN]
    assert np.isfinite(langid.word_scores(pieces, langid.scaled_weights(pieces, weights), words)).all()


def test_words_are_letters_alone():
    assert langid.words_of("½ ② Ⅷ 42 _ ٣") == []
    assert langid.words_of("Straße½x a_b ÉTÉ 日本") == ["straße", "x", "a", "b", "été", "日本"]


def test_a_worker_holds_one_value():
    assert workers.held("a", lambda: 1) == 1 and workers.held("a", lambda: 2) == 1
    assert workers.held("b", lambda: 3) == 3 and list(workers._HELD) == ["b"]
    assert workers.held("a", lambda: 4) == 4


def test_held_out_accuracy(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = langid.train(table.where(~held_out(F.col("doc_id"))), TOKENIZER, sample_docs=40)
    found = langid.predict(table.where(held_out(F.col("doc_id"))), model, TOKENIZER).where("text RLIKE '[a-z]'")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.98 and 0 < right[1] <= right[2] <= 1


def test_odd_texts_and_labels(spark, docs):  # noqa: F811
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "le chat", None), (None, "the", "en")]
    model = langid.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), TOKENIZER)
    assert model[0] == ["de", "en"]
    texts = [None, "", "123 !?", "THE CAT", "der hund " * 20_000, "x" * 200_000, "日本語"]
    frame = docs(*texts, (0, None)).selectExpr("doc_id", "text", "'q' AS lang_pred", "1 AS score", "2 AS _row")
    found = langid.predict(frame, model, TOKENIZER).collect()
    assert [(r.lang_pred, r.score) for r in found if r.doc_id < 3] == [("und", 0.0)] * 4
    by_id = {r.doc_id: r for r in found}
    assert by_id[3].lang_pred == "en" and by_id[4].lang_pred == "de" and by_id[4].score > 0.99
    assert all(0 <= r.score <= 1 for r in found)
    empty = langid.train(frame.limit(0).selectExpr("doc_id", "text", "'x' AS lang"), TOKENIZER)
    assert {r.lang_pred for r in langid.predict(frame, empty, TOKENIZER).collect()} == {"und"}
    assert langid.predict(frame.limit(0), model, TOKENIZER).count() == 0


def brute_losses(texts, chosen, size, mass):
    tokens = [lm_scoring.tokens_of(t) for t in texts]
    counts = {}
    for words in tokens:
        for w in words:
            counts[w] = counts.get(w, 0) + 1
    vocabulary = sorted(counts, key=lambda w: (-counts[w], w))[: size - 2]
    number = {w: i + 2 for i, w in enumerate(vocabulary)}

    def model(keep):
        pair = np.zeros((size, size))
        for words, kept in zip(tokens, keep):
            ids = [1, *[number.get(w, 0) for w in words]]
            for a, b in zip(ids, ids[1:]):
                pair[a, b] += kept
        single = (pair.sum(0) + 1) / (pair.sum() + size)
        return -np.log((pair + mass * single) / (pair.sum(1, keepdims=True) + mass))

    target, background = model(chosen), model([True] * len(texts))
    out = []
    for words in tokens:
        ids = [1, *[number.get(w, 0) for w in words]]
        n = len(words)
        out.append(tuple(sum(m[a, b] for a, b in zip(ids, ids[1:])) / n for m in (target, background)) if n else (None, None))
    return vocabulary, out


def test_losses_equal_brute_force(spark, docs):  # noqa: F811
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["the", "The", "cat", "sat", "on", "mat", "rare%d" % i, "!", "42"]) for _ in range(rng.randint(1, 40))) for i in range(40)]
    texts += [None, "", " \n", "the " * 5000]
    frame = docs(*texts, (3, texts[3]), (None, "the cat"))
    target = spark.createDataFrame([(i,) for i in [*range(0, 40, 3), 0, None]], "doc_id bigint")
    model = lm_scoring.train(frame, target, size=12)
    all_texts = [*texts, texts[3], "the cat"]
    chosen = [i % 3 == 0 and i < 40 for i in range(len(texts))] + [True, False]
    vocabulary, want = brute_losses(all_texts, chosen, 12, lm_scoring.MASS)
    assert model[0] == vocabulary
    scored = lm_scoring.score(frame.selectExpr("*", "1 AS score", "'r' AS _row"), model)
    assert scored.columns == ["doc_id", "text", "_row", "n_tokens", "target_loss", "background_loss", "score"]
    for r in scored.collect():
        t, b = want[r.doc_id] if r.doc_id is not None else want[-1]
        assert r.n_tokens == len(lm_scoring.tokens_of(r.text))
        if t is None:
            assert (r.target_loss, r.background_loss, r.score) == (None, None, None)
        else:
            assert (r.target_loss, r.background_loss, r.score) == pytest.approx((t, b, t - b), abs=1e-5)
    assert lm_scoring.score(frame.limit(0), model).count() == 0
    empty = lm_scoring.train(frame.limit(0), target, size=12)
    assert empty[0] == [] and lm_scoring.score(frame, empty).count() == len(all_texts)


def test_scores_tell_quality(spark):
    """Documents labelled good have lower scores than others, on those held out."""
    folder = SF_DIR.replace("0.001", "0.1")
    table = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    model = lm_scoring.train(table, labels.where((F.col("quality") == 1) & ~held_out(F.col("doc_id"))))
    found = lm_scoring.score(table.join(labels.where(held_out(F.col("doc_id"))), "doc_id"), model).where("score IS NOT NULL").collect()
    good, bad = ([r.score for r in found if r.quality == q] for q in (1, 0))
    assert np.mean([[g < b for b in bad] for g in good]) > 0.95


def test_all_words_and_bigrams_count(spark, docs):  # noqa: F811
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["the", "of", str(rng.randrange(6000))]) for _ in range(rng.randint(1, 90))) for _ in range(240)] + [None, "", "a a a a"]
    frame = docs(*texts, (0, texts[0]), (None, texts[1]))
    rows = [*texts, texts[0], texts[1]]
    chosen = [i % 3 == 0 for i in range(len(texts))] + [True, False]
    target = spark.createDataFrame([(i,) for i in range(0, len(texts), 3)], "doc_id bigint")
    vocabulary = {w for t in rows for w in lm_scoring.tokens_of(t)}
    assert len(vocabulary) > 2046
    pairs, words, before = ([{}, {}] for _ in range(3))

    def bigrams(text):
        tokens = lm_scoring.tokens_of(text)
        return list(zip([None, *tokens], tokens))

    for text, is_target in zip(rows, chosen):
        for v, w in bigrams(text):
            for m in range(1 + is_target):
                for table, k in ((pairs, (v, w)), (words, w), (before, v)):
                    table[m][k] = table[m].get(k, 0) + 1

    totals = [sum(w.values()) for w in words]

    def loss(m, v, w):
        single = (words[m].get(w, 0) + 1) / (totals[m] + len(vocabulary) + 2)
        return -math.log((pairs[m].get((v, w), 0) + lm_scoring.MASS * single) / (before[m].get(v, 0) + lm_scoring.MASS))

    model = lm_scoring.train(frame, target)
    assert model.pairs.count() == len(pairs[0])
    new = [(900, "the unheard of the " + texts[5][::-1]), (901, texts[4])]
    clash = frame.withColumn("score", F.lit(1))
    scored = [(given, lm_scoring.score(given, model)) for given in (clash, docs(*new))]
    # The models counted on the documents that they score: the same losses, in one slice or many slices and buckets.
    scored += [(clash, lm_scoring.score_counted(clash, target, **cut)) for cut in ({}, {"slice_tokens": 300, "bucket_tokens": 50})]
    for given, found in scored:
        assert found.columns == ["doc_id", "text", "n_tokens", "target_loss", "background_loss", "score"]
        found = found.collect()
        assert len(found) == given.count()
        for r in found:
            two = bigrams(r.text)
            assert r.n_tokens == len(two)
            if not two:
                assert (r.target_loss, r.background_loss, r.score) == (None, None, None)
                continue
            t, b = (sum(loss(m, v, w) for v, w in two) / len(two) for m in (1, 0))
            assert (r.target_loss, r.background_loss, r.score) == pytest.approx((t, b, t - b), abs=1e-9)
    assert lm_scoring.score(frame, lm_scoring.train(frame.limit(0), target)).count() == len(rows)


def test_counted_scores_of_odd_tables(spark, docs):  # noqa: F811
    """Null, blank, repeated and very long texts, clashing columns, no target, no documents."""
    frame = docs("b " * 300_000, None, "", " \n", "a b", "a b", (4, "a b"), (None, "a"))
    none = spark.createDataFrame([], "doc_id bigint")
    odd = frame.selectExpr("*", "1 AS slice", "'x' AS `text_key`", "2 AS `n_tokens`", "3 AS `target`")
    found = lm_scoring.score_counted(odd, none, slice_tokens=10)
    assert found.columns == ["doc_id", "text", "slice", "text_key", "target", "n_tokens", "target_loss", "background_loss", "score"]
    rows = found.collect()
    assert sorted(r.n_tokens for r in rows) == [0, 0, 0, 1, 2, 2, 2, 300_000]
    assert all((r.score is None) == (r.n_tokens == 0) for r in rows)
    assert len({(r.target_loss, r.background_loss) for r in rows if r.text == "a b"}) == 1
    # With no target every word before and after is as likely: 2 words, unknown and start.
    assert {round(r.target_loss, 9) for r in rows if r.n_tokens} == {round(math.log(4), 9)}
    assert lm_scoring.score_counted(frame.limit(0), none).count() == 0
