"""The pipeline and the two classifiers, held against brute force or held-out labels."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pairloom.llm import blocks, langid, quality, queries
from pairloom.session import stage
from tests.llm.tables import SMALL, tricky_texts
from tests.llm.test_links import classes_by_hand
from tests.llm.test_texts import contamination_by_hand, encoded, removed_by_hand

MEDIUM = "/root/testdata/sf0.01"


def test_quality_of_held_out_documents(spark):
    made = queries.op1_quality_votes(spark, MEDIUM)
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    rows = made.join(labels, "doc_id").filter("held_out").collect()
    right = [r for r in rows if r.predicted == r.quality]
    assert len(rows) > 60 and len(right) >= 0.95 * len(rows)
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert np.mean([x > y for x in good for y in bad]) > 0.95
    assert made.filter("score BETWEEN 0 AND 1 AND predicted = CAST(score >= 0.7 AS INT)").count() == made.count() == 1000


def test_votes_are_exact(spark, tricky):
    texts = [t or "" for _, t in tricky_texts()]
    data, offsets = blocks.column_bytes(pa.array(texts))
    found = quality.counts(data, offsets)
    model = quality.fit(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"),
                        spark.createDataFrame([(i, i % 3 % 2) for i in range(0, len(texts), 2)] + [(1, 5), (None, 1), (9999, 0)],
                                              "doc_id long, label int"), neighbours=7, power=2.0)
    vectors = quality.latent(found, model.weights, model.space)
    want = []
    for v in vectors:
        similar = model.vectors.astype(float) @ v.astype(float)
        near = np.argsort(-similar)[:7]
        w = np.clip(similar[near], 1e-6, 1) ** 2
        want.append(float((w * model.labels[near]).sum() / w.sum()) if v.any() else float(model.labels.mean()))
    made = {r.text or "": r for r in quality.score(tricky, model).collect()}
    assert len(made[""]) == len(tricky.columns)
    close = [abs(made[t].score - s) < 1e-4 for t, s in zip(texts, want)]
    assert np.mean(close) > 0.9  # ties among equal neighbours may fall either way
    nothing = quality.fit(tricky, spark.createDataFrame([], "doc_id long, label int"))
    assert {r.score for r in quality.score(tricky, nothing).select("score").collect()} == {0.5}
    assert quality.score(tricky.limit(0), model).count() == 0


def test_languages_of_held_out_documents(spark):
    made = queries.op2_language_id(spark, MEDIUM)
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    rows = made.join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held) > 200
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in rows) < 20


def test_language_model_by_hand(spark):
    texts = ["ab abc ab", "abd ab"]
    grams = spark.createDataFrame([("x", t) for t in texts], "lang string, text string").mapInArrow(
        langid._counted, "lang string, n int, gram long, context long, tail long, middle long, times long")
    grams = grams.groupBy("lang", "n", "gram", "context", "tail", "middle").agg(F.sum("times").alias("times"))
    shares, left = langid.kneser_ney(grams)
    # Shares and left-over mass of each context add up to one.
    total = {}
    by_gram = {(r.n, r.gram): r.share for r in shares.collect()}
    for r in grams.select("n", "gram", "context").distinct().collect():
        if (r.n, r.gram) in by_gram:
            total[r.n, r.context] = total.get((r.n, r.context), 0) + by_gram[r.n, r.gram]
    for r in left.collect():
        assert total[r.n, r.context] + r.left == pytest.approx(1)
    assert len(left.collect()) == len(total)


def test_awkward_texts_have_a_language(spark, tricky):
    rows = spark.createDataFrame([("en", "the cat sat on the mat " * 3), ("de", "der hund und die katze " * 3)] * 20 + [(None, "x"), ("fr", None)],
                                 "lang string, text string").withColumn("text", F.concat("text", F.lit(" "), F.monotonically_increasing_id()))
    model = langid.fit(rows, F.col("text"), F.col("lang"))
    assert model.languages == ["de", "en"]
    made = langid.identify(tricky, model, reject=False).collect()
    assert {r.lang_pred for r in made if not any(map(str.isalpha, r.text or ""))} == {"und"}
    assert all((r.score == 0.0) == (r.lang_pred == "und") for r in made)
    assert {r.lang_pred for r in made if any(map(str.isalpha, r.text or ""))} <= {"de", "en"}
    strict = langid.identify(spark.createDataFrame([("the mat sat on the cat",), ("日本語",)], "text string"), model).collect()
    assert [r.lang_pred for r in strict] == ["en", "und"]
    for nothing in (rows.limit(0), rows.withColumn("text", F.lit(" "))):
        unread = langid.identify(tricky, langid.fit(nothing, F.col("text"), F.col("lang"))).collect()
        assert {(r.lang_pred, r.score, r.entropy) for r in unread} == {("und", 0.0, None)} and len(unread) == len(made)


def test_many_small_languages(spark):
    rng = random.Random(9)
    words_of = {f"l{n:03}": ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(12)] for n in range(250)}
    rows = [(lang, " ".join(rng.choice(some) for _ in range(30))) for lang, some in words_of.items() for _ in range(6)] + [("l000", "same text")] * 50
    model = langid.fit(spark.createDataFrame(rows, "lang string, text string"), F.col("text"), F.col("lang"), most_docs=1500)
    assert len(model.languages) == 250
    asked = spark.createDataFrame([(lang, " ".join(some)) for lang, some in words_of.items()], "lang string, text string")
    found = langid.identify(asked, model, reject=False).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 240


def kneser_ney_by_hand(words_, tests):
    """Log probability of each word's characters, by counting in plain Python."""
    seen = [Counter() for _ in range(6)]
    for w in words_:
        padded = "    " + w.lower() + " "
        for at in range(4, len(padded)):
            for n in range(1, 6):
                seen[n][padded[at - n + 1:at + 1]] += 1
    counts = {5: dict(seen[5])} | {n: Counter(g[1:] for g in seen[n + 1]) for n in range(1, 5)}
    discount = {}
    for n, found in counts.items():
        ones, twos = (sum(v == k for v in found.values()) for k in (1, 2))
        discount[n] = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
    out = []
    for w in tests:
        padded, total = "    " + w.lower() + " ", 0.0
        for at in range(4, len(padded)):
            p = 1 / langid.ALPHABET
            for n in range(1, 6):
                context = padded[at - n + 1:at]
                under = {g: v for g, v in counts[n].items() if g[:-1] == context}
                if under:
                    mass = sum(under.values())
                    own = under.get(context + padded[at], 0)
                    p = max(own - discount[n], 0) / mass + discount[n] * len(under) / mass * p
            total += np.log(p)
        out.append(total)
    return out


def test_word_scores_by_hand(spark):
    text = "the cat sat on the mat The hat äh that thé"
    grams = spark.createDataFrame([("x", text), ("y", "der die das")], "lang string, text string").mapInArrow(
        langid._counted, "lang string, n int, gram long, context long, tail long, middle long, times long")
    grams = grams.groupBy("lang", "n", "gram", "context", "tail", "middle").agg(F.sum("times").alias("times"))
    shares, left = (x.toArrow() for x in langid.kneser_ney(grams))
    languages = ["x", "y"]
    model = langid.Model(languages, langid.sorted_arrays(shares, "gram", "share", languages), langid.sorted_arrays(left, "context", "left", languages))
    assert all((keys[1:] > keys[:-1]).all() for tables in model.shares + model.left_over for keys, _ in tables)
    tests = ["the", "cats", "ÄH", "zzz", "t"]
    scores = langid.word_scores(model, [w.encode() for w in tests])
    assert scores[:, 0] == pytest.approx(kneser_ney_by_hand(text.split(), tests), rel=1e-4)
    assert scores[:, 1] == pytest.approx(kneser_ney_by_hand(["der", "die", "das"], tests), rel=1e-4)


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    steps = {}
    now = docs
    for name, apply in corpus_pipeline.STAGES:
        now = stage(apply(spark, now, SMALL))
        steps[name] = now
    for name in list(steps)[:-1]:
        assert steps[name].columns == docs.columns and steps[name].schema == docs.schema
    texts = lambda df: sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())

    model = queries.fit_quality(spark, SMALL)
    whole = texts(docs)
    data, offsets = blocks.column_bytes(pa.array([t or "" for _, t in whole]))
    scores = quality.vote(quality.latent(quality.counts(data, offsets), model.weights, model.space), model)
    kept = [d for d, s in zip(whole, scores) if s >= 0.7]
    assert texts(steps["quality_classifier"]) == kept and len(kept) < len(whole)

    least = {c for _, _, c in classes_by_hand(kept, 5, 80)}
    kept = [d for d in kept if d[0] in least]
    assert texts(steps["ngram_jaccard_join"]) == kept

    cut = {i: (k, g) for i, _, g, k in removed_by_hand(kept, 50)}
    kept = [(i, cut[i][0] if cut[i][1] else t) for i, t in kept]
    assert texts(steps["substring_dedup"]) == kept

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    dirty = {r[0] for r in contamination_by_hand(kept, items) if r[-1]}
    kept = [d for d in kept if d[0] not in dirty]
    assert texts(steps["benchmark_decontamination"]) == kept and dirty

    ids = encoded(public_tokenizers.path("word_bpe_49k.json"), [t or "" for _, t in kept], 1)
    pieces = {}
    for r in sorted(steps["power_of_two_packing"].collect(), key=lambda r: (r.doc_id, r.start)):
        pieces[r.doc_id] = pieces.get(r.doc_id, b"") + r.ids
    assert pieces == {i: np.array(x, "<u4").tobytes() for (i, _), x in zip(kept, ids)}


def test_stages_on_tricky_documents(spark, tricky):
    now = tricky.select("doc_id", "text", "lang", "source", "n_chars")
    for _, apply in corpus_pipeline.STAGES[1:4]:
        now = stage(apply(spark, now, SMALL))
    assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"] and now.count() > 0
    assert corpus_pipeline.power_of_two_packing(spark, now, SMALL).count() > 0
