import random
from zlib import crc32

import numpy as np
import pytest

from accesslake.llm.queries import QUERIES
from accesslake.llm.toxicity import FEATURES, Trees, plain_word, pooled, score_toxicity, terms_of, text_features, tokens_of

LABELS = "doc_id long, quality int, toxic int"


def test_words_behind_disguises():
    for token in ("IDIOT!", "1d10t", "i.d.i.o.t", "id!ot", "idiooooot", '"idiot,"'):
        assert plain_word(token)[0] == "idiot", token
    assert plain_word("Idiot.") == ("idiot", False)
    assert plain_word("2024") == ("", False) and plain_word("!!!") == ("", False)
    assert tokens_of("you i d i o t now") == ["you", "i.d.i.o.t", "now"]
    assert tokens_of("a b word c") == ["a", "b", "word", "c"]
    assert terms_of("vequait") == ["vequait", "vequ*", "vequa*", "vequai*"] and terms_of("ab") == []


def test_features_of_a_text():
    measure = text_features({"zzgrop": 2.0, "veqx*": 3.0})
    at = dict(zip(FEATURES, measure("you are a zzgrop and VEQXON! idiot"), strict=True))
    assert at["learnt_share"] == pytest.approx(2 / 7) and at["learnt_most"] == 3.0
    assert at["insult_share"] == pytest.approx(1 / 7) and at["second_person"] == pytest.approx(1 / 7)
    assert at["nearness"] == pytest.approx(1 / 4) and at["shouted"] == pytest.approx(1 / 7)
    assert measure("") == measure(" \n") == [0.0] * len(FEATURES)


def test_nearness_is_the_smallest_distance():
    r = random.Random(2)
    measure = text_features({})
    for _ in range(300):
        words = [r.choice(["idiot", "you", "xx", "yy", "zz"]) for _ in range(r.randrange(1, 20))]
        hits = [i for i, w in enumerate(words) if w == "idiot"]
        people = [i for i, w in enumerate(words) if w == "you"]
        near = max([1 / (1 + abs(a - b)) for a in hits for b in people], default=0)
        assert measure(" ".join(words))[FEATURES.index("nearness")] == pytest.approx(near)


def test_trees_learn_an_interaction():
    random_ = np.random.default_rng(1)
    x = random_.normal(size=(4000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = Trees().fit(x[:2000], y[:2000])
    assert ((trees.margin(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.95


def test_pooling_equals_brute_force():
    """The isotonic fit is the largest mean to the left's smallest mean to the right."""
    r = random.Random(4)
    for _ in range(200):
        n = r.randrange(1, 12)
        total = np.array([r.randrange(1, 6) for _ in range(n)])
        hits = np.array([r.randrange(0, t + 1) for t in total])
        mean = lambda a, b: hits[a : b + 1].sum() / total[a : b + 1].sum()
        want = [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        places, shares = pooled(np.arange(n), hits, total)
        assert list(shares) == sorted(shares) and np.allclose(sorted(set(np.round(want, 9))), sorted(set(np.round(shares, 9))))
        assert len(places) == len(shares) and (np.diff(places) > 0).all()


def test_held_out_accuracy(spark):
    """On the given tables: of labelled documents that are held out, with about 300 toxic ones to learn from."""
    path = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    rows = QUERIES["op11_toxicity"](spark, path).collect()
    assert len(rows) == spark.read.parquet(f"{path}/documents.parquet").count()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    own = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [p for t, p in own if t], [p for t, p in own if not t]
    assert len(toxic) > 80 and sum(toxic) / len(toxic) > 0.8
    assert sum(clean) / len(clean) < 0.01


def texts(n, seed=3):
    r = random.Random(seed)
    for i in range(n):
        words = [f"w{r.randrange(400)}" for _ in range(r.randrange(3, 40))]
        toxic = r.random() < 0.3
        if toxic:
            words[r.randrange(len(words))] = f"gromp{'abcdef'[r.randrange(6)]}"
        yield i, " ".join(words), int(toxic)


def test_learns_a_word_beginning(spark):
    """The bad words have one beginning that no list holds; labels of held-out rows are turned round and do not matter."""
    made = list(texts(2500))
    docs = spark.createDataFrame([(i, t) for i, t, _ in made], "doc_id long, text string")
    labels = [(i, 1, y) for i, _, y in made]
    turned = [(i, 1, 1 - y if crc32(str(i).encode()) % 5 == 0 else y) for i, _, y in made]
    found = {r.doc_id: r for r in score_toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()}
    wrong = [i for i, _, y in made if found[i].held_out and found[i].predicted != y]
    assert len(wrong) < 10
    again = {r.doc_id: r for r in score_toxicity(docs, spark.createDataFrame(turned, LABELS)).collect()}
    assert found == again


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, None, None), (None, 1, 1), (99, 1, 1), (4, 1, 0), (4, 1, 1)], LABELS)
    rows = score_toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    no_labels = score_toxicity(odd, spark.createDataFrame([], LABELS)).collect()
    assert {(r.score, r.predicted) for r in no_labels} == {(0.0, 0)}
    assert score_toxicity(none, labels).collect() == []
