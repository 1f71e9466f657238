import random

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from framewise.llm import toxicity
from framewise.llm.toxicity import Distance, calibrate, codes, fit_logistic, score_toxicity, train, written

BAD = [f"bad{i}" for i in range(8)]


def made(seed, count):
    """Texts of common and rare words; every fifth has two or more of the bad words."""
    rnd, rows = random.Random(seed), []
    for i in range(count):
        words = [f"common{rnd.randrange(30)}" if rnd.random() < 0.5 else f"rare{rnd.randrange(10**7)}" for _ in range(rnd.randint(20, 200))]
        toxic = int(i % 5 == 0)
        for _ in range(toxic * rnd.randint(2, 4)):
            words[rnd.randrange(len(words))] = rnd.choice(BAD).upper() + rnd.choice(["", ",", "!!"])
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame(made(1, 900), "doc_id long, text string, toxic int").cache()


@pytest.fixture(scope="module")
def model(labelled):
    return train(labelled.drop("toxic"), labelled.select("doc_id", "toxic"), F.col("doc_id") % 4 != 2)


def test_held_out_rows(labelled, model):
    rows = score_toxicity(labelled.where("doc_id % 4 = 2"), model).collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.97
    assert all((r["score"] >= 0.3) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in rows)


def test_training_is_repeatable_and_looks_at_no_held_out_label(labelled, model):
    lies = labelled.select("doc_id", F.when(F.col("doc_id") % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")).alias("toxic"))
    again = train(labelled.drop("toxic").repartition(5), lies, F.col("doc_id") % 4 != 2)
    assert again.distance == model.distance and np.allclose(again.weights, model.weights, atol=1e-6)


def test_labels_with_gaps(spark, labelled, model):
    more = spark.createDataFrame([(None, 1), (3, None), (10**9, 1), (5, 0)], "doc_id long, toxic int")
    again = train(labelled.drop("toxic"), labelled.select("doc_id", "toxic").unionByName(more), F.col("doc_id") % 4 != 2)
    assert again.distance == model.distance


def test_without_labels_nothing_is_toxic(labelled):
    for labels in (labelled.limit(0), labelled.where("toxic = 0"), labelled.where("toxic = 1")):
        none = train(labelled.drop("toxic"), labels.select("doc_id", "toxic"), F.lit(True))
        assert {(r["score"], r["predicted"]) for r in score_toxicity(labelled.limit(5), none).collect()} == {(0.0, 0)}


def test_odd_texts_and_columns(odd_docs, model):
    clash = odd_docs.withColumns({"Score": F.lit("x"), "features": F.lit(1)})
    rows = score_toxicity(clash, model).collect()
    assert len(rows) == odd_docs.count() and list(rows[0].asDict()) == ["doc_id", "text", "lang", "source", "features", "score", "predicted"]
    assert all(r["predicted"] == 0 for r in rows)
    assert len({r["score"] for r in rows if not (r["text"] or "").strip()}) == 1
    assert score_toxicity(clash.limit(0), model).collect() == []


def test_one_word_shows_in_a_window_of_rare_ones():
    rnd = np.random.default_rng(5)
    distance = Distance(b"", written(codes(" ".join([f"other{i}" for i in range(500)] + BAD))))
    for _ in range(50):
        words = [f"r{x}" for x in rnd.integers(0, 10**9, 32)]
        assert distance.features(" ".join(words))[0] == 0
        words[rnd.integers(32)] = rnd.choice(BAD)
        assert distance.features(" ".join(words))[0] > 0


def test_whole_texts_are_read(model):
    filler = " ".join(f"rare{i}" for i in range(20_000))
    assert model.score(filler) < 0.3
    assert model.score(f"{filler} {' '.join(BAD)} {' '.join(BAD)} {' '.join(BAD)}") > model.score(filler)


def test_curve_and_cut():
    rnd = np.random.default_rng(6)
    x = rnd.normal(size=(4000, 2))
    y = (rnd.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] - 1)))).astype(float)
    w = fit_logistic(x, y)
    assert np.allclose(w, [2, -1, -1], atol=0.3)
    moved, reached = calibrate(w, x, y)
    predicted = x @ moved[:-1] + moved[-1] >= np.log(toxicity.THRESHOLD / (1 - toxicity.THRESHOLD))
    f1 = 2 * (predicted * y).sum() / (predicted.sum() + y.sum())
    assert abs(f1 - reached) < 1e-9 and f1 > 0.6


def plain_score(text, model):
    """Window by window with zstandard alone, words found by a pattern and hashed one by one."""
    import zstandard

    words = [w for w in regex.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", (text or "").lower())]
    hashed = [int(codes(w)[0]) for w in words]
    settings = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_BTLAZY2, min_match=6, hash_log=17, chain_log=18, search_log=8, window_log=18,
        write_checksum=0, write_content_size=0, write_dict_id=0,
    )
    raw = lambda content: zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=settings
    )
    ahead = toxicity._AHEAD
    plain, toxic = raw(model.distance.ordinary + ahead), raw(model.distance.toxic + model.distance.ordinary + ahead)
    gains = []
    for i in range(0, len(hashed), 32):
        window = ahead + b"".join(written(np.array([h], np.uint64)) for h in hashed[i : i + 32])
        gains.append(max(0, len(plain.compress(window)) - len(toxic.compress(window)) - 4))
    total = sum(gains) / 8
    features = [
        min(max(gains, default=0), 40) / 8,
        np.log(1 + total),
        10 * min(1, total / max(1, len(hashed))),
        np.log(1 + sum(g > 0 for g in gains)),
        np.log(1 + len(hashed)) if total else 0,
    ]
    return 1 / (1 + np.exp(-(sum(f * w for f, w in zip(features, model.weights)) + model.weights[-1])))


def test_scores_against_brute_force(labelled, odd_docs, model):
    rows = labelled.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    for r in score_toxicity(rows, model).collect():
        want = plain_score(r["text"], model)
        assert abs(r["score"] - want) < 1e-9 and r["predicted"] == (want >= 0.3)
