"""The two classifiers against their formulas written out."""

import random

import numpy as np
import pyarrow as pa

from cellwise.llm import language, toxicity


def test_scores_of_the_machine_are_sums_over_pairs():
    rng = np.random.default_rng(2)
    terms, first = [], [0]
    for _ in range(300):
        terms += rng.choice(400, rng.integers(1, 9), replace=False).tolist()
        first.append(len(terms))
    terms, first = np.array(terms, np.int32), np.array(first)
    model = toxicity.fit(terms, first, (rng.random(300) < 0.4).astype(float))
    found = model.scores(terms, first)
    for r, score in enumerate(found):
        own = terms[first[r] : first[r + 1]].tolist()
        pairs = sum(float(model.factors[i] @ model.factors[j]) for n, i in enumerate(own) for j in own[:n])
        margin = model.bias + sum(float(model.weights[i]) for i in own) + pairs / len(own)
        assert abs(score - 1 / (1 + np.exp(-margin))) < 1e-6


def test_language_scores_solve_the_landmark_problem():
    """The fitted function is the minimum of weighted squares plus the kernel norm."""
    rng = random.Random(6)
    kinds = {"aa": "abcdefg", "bb": "ghijklm", "cc": "qrstuvw"}
    names, texts = [], []
    for n in range(90):
        k = rng.choice(list(kinds))
        names.append(k)
        texts.append(" ".join("".join(rng.choice(kinds[k]) for _ in range(4)) for _ in range(rng.randrange(2, 12))))
    bits = np.packbits(language.presence(pa.array(texts)), axis=1)
    model = language.fit(bits, names)
    rows = language._normal(np.unpackbits(bits, axis=1).astype(bool)).astype(float)
    marks = model.landmarks.astype(float)
    wide = np.concatenate([rows @ marks.T, np.ones((len(rows), 1))], 1)
    weight = np.array([1 / names.count(n) for n in names])
    penalty = language.RIDGE * len(model.names) / wide.shape[1]
    for c, k in enumerate(model.names):
        want = np.where(np.array(names) == k, 1.0, -1.0)

        def loss(w, want=want):
            return (weight * (wide @ w - want) ** 2).sum() + penalty * (w[:-1] @ (marks @ marks.T) @ w[:-1])

        best = model.weights[:, c].astype(float)
        steps = np.random.default_rng(c).normal(size=(40, len(best))) * 0.05
        assert all(loss(best) <= loss(best + s) + 1e-4 for s in steps)
    found, _ = model.predict(pa.array(texts))
    assert np.mean([a == b for a, b in zip(found, names, strict=True)]) > 0.95


def test_language_of_letters_beyond_the_basic_plane(spark):
    gothic, cree = "\U00010330\U00010331\U00010332", "ᐁᐃᐅ"
    rng = random.Random(7)
    rows = [(i, " ".join("".join(rng.choice(s) for _ in range(3)) for _ in range(8)), k) for i in range(120) for k, s in [rng.choice([("got", gothic), ("cre", cree)])]]
    rows += [(500, "× ÷ 12", "got")]
    found = {r["doc_id"]: r["lang_pred"] for r in language.language(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert found[500] == "und" and np.mean([found[i] == k for i, _, k in rows[:120]]) > 0.95


def test_calibration_mends_margins_that_are_too_bold():
    rng = np.random.default_rng(9)
    margins = rng.normal(0, 2, 4000)
    labels = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 * margins - 1)))).astype(float)
    slope, offset = toxicity.calibration(margins, labels)
    assert abs(slope - 0.5) < 0.06 and abs(offset + 1) < 0.12
    assert toxicity.calibration(np.zeros(0), np.zeros(0)) == (1.0, 0.0)


def test_few_labels_are_enough_for_plain_insults():
    """Three hundred rows of several hundred terms, an eighth of them with one of ten marked words."""
    rng = np.random.default_rng(3)

    def rows(n):
        labels = (rng.random(n) < 0.125).astype(float)
        own = [np.unique(np.concatenate([rng.zipf(1.3, 250) % 20_000 + 10, rng.integers(0, 10, 3) if y else []])).astype(np.int32) for y in labels]
        return np.concatenate(own), np.concatenate([[0], np.cumsum([len(o) for o in own])]), labels

    model = toxicity.fit(*rows(300))
    terms, first, labels = rows(600)
    said = model.scores(terms, first) >= toxicity.THRESHOLD
    assert said[labels == 1].mean() > 0.8 and said[labels == 0].mean() < 0.03


def test_toxicity_of_text_ids_repeats_and_long_texts(spark):
    """Ids of any type; repeated rows score alike; a long text is read to its end."""
    rows = [(f"d{i}", ("fine words here " * (20_000 if i == 40 else 3)) + ("zorkish" if i % 2 else "")) for i in range(200)]
    rows += [rows[3], rows[3], (None, None)]
    docs = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id string, text string, score int")
    labels = spark.createDataFrame([(f"d{i}", i % 2) for i in range(200)] * 2, "doc_id string, toxic int")
    found = [r for r in toxicity.toxicity(docs, labels).collect()]
    assert len(found) == len(rows) and len({r["score"] for r in found if r["doc_id"] == "d3"}) == 1
    assert all(r["predicted"] == int(r["doc_id"][1:]) % 2 for r in found if r["doc_id"] and r["doc_id"] != "d40")
    assert toxicity.accepted(docs, labels).columns == ["doc_id", "text", "score"]
