import math
from collections import Counter

import numpy as np
import pytest
from frames import TEXTS, documents, empty

from tessera.llm import masked
from tessera.session import load

SMALL = "/root/testdata/sf0.001"


def test_gradients():
    network = masked.Network(7, 3)
    rng = np.random.default_rng(0)
    weights = network.start(np.full(7, 1 / 7), 1).astype(np.float64)
    around, token = rng.integers(0, 7, (5, 4)), rng.integers(0, 7, 5)

    def loss(w):
        return -network.forward(network.split(w), around)[1][np.arange(5), token].mean()

    taken = weights.copy()
    network.train(taken, iter([(around, token)]), 1e-7)  # the first Adam step is the sign of the gradient
    for i in rng.integers(0, network.length, 40):
        step = np.zeros(network.length)
        step[i] = 1e-5
        slope = (loss(weights + step) - loss(weights - step)) / 2e-5
        if abs(slope) > 1e-4:
            assert np.sign(taken[i] - weights[i]) == -np.sign(slope)
    assert loss(taken) < loss(weights)


def test_every_token_is_a_target_in_each_round(spark, monkeypatch):
    vocabulary, asked = masked.Vocabulary([b"the"], 50), []
    monkeypatch.setattr(masked, "_round", lambda source, v, n, weights, every, turn, rate, step: asked.append((every, turn, step)) or weights)
    masked.fit(documents(spark))
    assert len(asked) == 2
    texts = [t for _, t, *_ in TEXTS]
    wanted = Counter(int(i) for t in texts for i in vocabulary.numbers(t))
    for every, turn, step in asked:
        found = Counter()
        for _, token in masked.examples(vocabulary, [texts[:3], texts[3:]], every, turn, step):
            found.update(token.tolist())
        assert found == wanted


def test_places_are_counted_on_between_batches():
    vocabulary, texts = masked.Vocabulary([b"%d" % i for i in range(30)], 1), [" ".join(map(str, range(i, i + 5))) for i in (0, 5, 10, 15)]
    whole = [t for _, token in masked.examples(vocabulary, [texts], 3, 1, 4) for t in token]
    parts = [t for _, token in masked.examples(vocabulary, [[t] for t in texts], 3, 1, 4) for t in token]
    assert parts == whole and len(whole) == 6


def test_word_counts(spark):
    rows = {bytes(r.word): r.n for r in masked.word_counts(documents(spark)).collect()}
    wanted = Counter(w for _, t, *_ in TEXTS for w in masked.words(t))
    assert rows == dict(wanted)


def test_scores_are_sums_over_both_sides(spark):
    scorer = masked.fit(documents(spark), own=20, shared=8, hidden=4, every=1, rounds=1)
    v, parts = scorer.vocabulary, scorer.network.split(scorer.weights)
    texts = [t for _, t, *_ in TEXTS]
    lengths, sums = scorer.scores(texts, piece=7)
    for text, length, total in zip(texts, lengths, sums):
        if length > 500:
            continue
        numbers = [0, 0, *(v.number(w) for w in masked.words(text)), 0, 0]
        wanted = 0.0
        for i in range(2, len(numbers) - 2):
            sides = np.array([[numbers[i - 2], numbers[i - 1], numbers[i + 1], numbers[i + 2]]])
            logits = scorer.network.forward(parts, sides)[1]
            assert np.exp(logits).sum() == pytest.approx(1, abs=1e-4)
            wanted += float(logits[0, numbers[i]])
        assert total == pytest.approx(wanted, abs=1e-2) and length == len(numbers) - 4


def test_training_beats_the_unigram_model_on_other_texts(spark):
    docs = load(spark, SMALL, "documents")
    seen, other = docs.filter("doc_id % 5 <> 0"), docs.filter("doc_id % 5 = 0")
    plain = masked.fit(seen, rounds=0)
    trained = masked.fit(seen, every=2, rounds=2)
    texts = [r.text for r in other.collect()]
    tokens, before = plain.scores(texts)
    _, after = trained.scores(texts)
    assert after.sum() / tokens.sum() > before.sum() / tokens.sum() + 0.02


def test_words_of_one_number_differ_by_their_counts(spark):
    rows = [(0, "x " * 50 + "a " * 12 + "b " * 3 + "c", "en", "s"), (1, "x a x", "en", "s"), (2, "x b x", "en", "s"), (3, "x c x", "en", "s"),
            (4, "x b x b", "en", "s"), (4, "x", "en", "s")]
    docs = documents(spark, rows)
    counts = Counter(w for _, t, *_ in rows for w in masked.words(t))
    found = {}
    for known in (0.0, 0.1, 2.0):  # all shares in the tasks, some, none
        scorer = masked.fit(docs, own=1, shared=1, hidden=4, known=known)
        assert bool(scorer.middle) == (known < 1) and (scorer.counts.count() > 0) == (known > 0)
        found[known] = sorted((r.doc_id, r.n_tokens, r.log_likelihood) for r in masked.score(docs, scorer).collect())
        assert [f[:2] for f in found[known]] == sorted((d, len(masked.words(t))) for d, t, *_ in rows)
        texts = [t for _, t, *_ in rows] + ["x unseen x"]
        more = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
        got = {r.doc_id: r.log_likelihood for r in masked.score(more, scorer).collect()}
        total = sum(n for w, n in counts.items() if w != b"x") + 1
        plain = scorer.scores(texts)[1]
        for i, text in enumerate(texts):
            share = sum(math.log((counts[w] or 1) / total) for w in masked.words(text) if w != b"x")
            assert got[i] == pytest.approx(plain[i] + share, abs=1e-4)
        assert got[1] > got[2] > got[3] > got[6]


def test_vocabulary_follows_the_corpus(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(600) if i % (j // 100 + 1) == 0), "en", "s") for i in range(60)]
    scorer = masked.fit(documents(spark, rows), rounds=0, hidden=2)
    counts = Counter(w for _, t, *_ in rows for w in masked.words(t))
    assert set(scorer.vocabulary.own) == {w for w, n in counts.items() if n >= 20} and len(scorer.vocabulary.own) == 300
    assert len(masked.fit(documents(spark, rows), rounds=0, hidden=2, frequent=1 / 200).vocabulary.own) == 0


def test_awkward_rows(spark):
    docs = documents(spark)
    rows = masked.score(docs, masked.fit(docs, own=20, shared=8, hidden=4)).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in rows), key=str) == sorted(((d, len(masked.words(t))) for d, t, *_ in TEXTS), key=str)
    for r in rows:
        assert r.log_likelihood <= 0 and math.isfinite(r.log_likelihood)
        assert (r.mean_log_likelihood is None) == (r.n_tokens == 0) and (r.n_tokens or r.log_likelihood == 0)
    nothing = masked.fit(empty(spark))
    assert masked.score(empty(spark), nothing).count() == 0
    assert masked.score(docs, nothing).count() == len(TEXTS)


def test_texts_are_taken_apart_once_for_rounds_and_scores(spark, monkeypatch):
    asked, prepared = [], masked.numbered
    monkeypatch.setattr(masked, "_round", lambda source, v, n, weights, *rest: asked.append(source.columns) or weights)
    monkeypatch.setattr(masked, "numbered", lambda *a: asked.append("numbered") or prepared(*a))
    found = masked.fit_and_score(documents(spark)).collect()
    assert asked == ["numbered", ["numbers"], ["numbers"]]
    assert sorted((str(r.doc_id), r.n_tokens) for r in found) == sorted((str(d), len(masked.words(t))) for d, t, *_ in TEXTS)


@pytest.mark.parametrize("block", [1, 40, 1 << 20])
def test_blocks_of_words(block, monkeypatch):
    monkeypatch.setattr(masked, "BLOCK", block)
    texts = [t for _, t, *_ in TEXTS] + ["  The river.\n a,b!", "\x1c\x1d x\x85 y \x0b\x0cz İSTANBUL ΑΣ", ".. !", "a b rare rare"]
    wanted = [masked.words(t) for t in texts]
    found = []
    for words, lengths in masked.word_blocks(texts):
        rest = iter(words.to_pylist())
        found += [[next(rest) for _ in range(n)] for n in lengths]
        assert next(rest, None) is None
    assert found == wanted
    vocabulary = masked.Vocabulary([b"the", b"a"], 5)
    totals, middle = np.arange(5) + 3.0, {b"of": -0.5, b"b": 0.0}
    lexicon = masked.Lexicon(vocabulary, np.ones(8), totals, middle, None)
    columns = lexicon.columns(texts)
    assert columns["numbers"].to_pylist() == [[vocabulary.number(w) for w in ws] for ws in wanted]
    rare = [[w for w in ws if w not in vocabulary.own and w not in middle] for ws in wanted]
    for ws, share in zip(wanted, columns["share"].to_pylist()):
        assert share == pytest.approx(sum(0 if w in vocabulary.own else middle.get(w, -math.log(totals[vocabulary.number(w) - 3] + 1)) for w in ws))
    met = Counter((row + place, word["word"]) for row, ws in enumerate(columns["rare"].to_pylist()) for word in ws for place in word["places"])
    assert met == Counter((row, w) for row, ws in enumerate(rare) for w in ws)


def test_steps_are_those_of_adam_on_the_mean_loss():
    """Several steps from the same start, worked out from the probabilities of all numbers."""
    network = masked.Network(9, 3)
    rng = np.random.default_rng(2)
    weights = network.start(np.full(9, 1 / 9), 1).astype(np.float64)
    batches = [(rng.integers(0, 9, (n, 4)), rng.integers(0, 9, n)) for n in (6, 6, 4)]
    taken = weights.copy()
    assert network.train(taken, iter(batches), 0.01) == 16
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step, (around, token) in enumerate(batches, 1):
        gradient = np.empty_like(weights)
        for i in range(len(weights)):
            moved = [weights.copy(), weights.copy()]
            moved[0][i] += 1e-6
            moved[1][i] -= 1e-6
            up, down = (-network.forward(network.split(w), around)[1][np.arange(len(token)), token].mean() for w in moved)
            gradient[i] = (up - down) / 2e-6
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient ** 2
        weights -= 0.01 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-6)
    assert taken == pytest.approx(weights, abs=1e-4)
