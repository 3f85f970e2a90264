import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from frames import GERMAN, PROSE, TEXTS, documents, empty
from pyspark.sql import functions as F

from tessera.llm import languages, rules
from tessera.session import load

SMALL = "/root/testdata/sf0.001"


def slow_grams(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    counts = Counter()
    for word in words:
        padded = f" {word} "
        for n in (1, 2, 3):
            counts.update(padded[i:i + n] for i in range(len(padded) - n + 1))
    counts.pop(" ", None)
    # a blank that ends a word is the one that begins the next; in " a b " the pair and triple counts are per word
    return counts


def test_grams_are_those_of_padded_words():
    for _, text, *_ in TEXTS:
        text = (text or "")[:3000]
        wanted = slow_grams(text)
        values, counts = languages.counted(languages.grams(text))

        def code(gram):
            out = 0
            for c in gram:
                out = out << languages.WIDTH | (1 if c == " " else ord(c) + 1)
            return out

        assert dict(zip(values.tolist(), counts.tolist())) == {code(g): n for g, n in wanted.items()}


def test_prediction_ignores_everything_but_the_text(spark):
    docs = documents(spark)
    learned = languages.profiles(docs)
    assert set(learned) == {"de", "en"}
    rows = languages.predict(docs, learned).collect()
    assert len(rows) == len(TEXTS)
    by_text = {}
    for r in rows:
        by_text.setdefault(r.digest, set()).add((r.lang_pred, r.score))
        assert 0 <= r.score <= 1
    assert all(len(v) == 1 for v in by_text.values())
    found = {r.doc_id: r.lang_pred for r in rows}
    assert (found[0], found[1], found[8]) == ("en", "de", "en")
    assert (found[3], found[4], found[5], found[9]) == ("und",) * 4


def test_distance_is_out_of_place():
    judge = languages.Judge({"x": languages.ranked(languages.grams(PROSE), 50), "y": languages.ranked(languages.grams(GERMAN), 50)}, 50)
    mine = languages.ranked(languages.grams(PROSE[:150]), 50).tolist()
    other = languages.ranked(languages.grams(PROSE), 50).tolist()
    wanted = sum(abs(other.index(g) - i) if g in other else 50 for i, g in enumerate(mine)) / (len(mine) * 50)
    assert judge(PROSE[:150]) == ("x", pytest.approx(1 - wanted))


def test_held_out_rows_and_accuracy(spark):
    docs = load(spark, SMALL, "documents")
    rows = languages.identify(docs).collect()
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95


def test_languages_of_awkward_tables(spark):
    assert languages.identify(empty(spark)).count() == 0
    unlabelled = documents(spark).drop("lang").withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in languages.identify(unlabelled).collect()} == {("und", 0.0)}
    kept = languages.with_known_language(documents(spark))
    assert kept.columns == documents(spark).columns
    assert {0, 1, 2, 6, 8} <= {r.doc_id for r in kept.collect()} and not {3, 4, 5, 9} & {r.doc_id for r in kept.collect()}


def slow_base(text):
    text = text or ""
    words, line_seen, twice = text.encode().split(), [], 0
    for line in text.split("\n"):
        if line.encode().split():
            twice += line in line_seen
            line_seen.append(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), twice, len(inside))


def test_base_counts():
    texts = [(t or "")[:4000] for _, t, *_ in TEXTS] + ["a a a a", "a b c a b", "a b c\na b c\n\n\n x\na b c", "\x0b\x0c a\x1cb", "é é é é"]
    for text in texts:
        assert rules.base_counts(text) == slow_base(text)


def test_js_distance():
    p, q = np.array([1.0, 0, 3]), np.array([2.0, 2, 0])
    a, b = p / p.sum(), q / q.sum()
    middle = (a + b) / 2
    wanted = sum(x * np.log2(x / m) for v in (a, b) for x, m in zip(v, middle) if x) / 2
    assert rules.js_distance(p, q) == pytest.approx(np.sqrt(wanted))
    assert rules.js_distance(p, 2 * p) == pytest.approx(0, abs=1e-7) and rules.js_distance(p, p * 0) == 1


def test_quality_of_awkward_rows(spark):
    judged = rules.judge_corpus(documents(spark)).collect()
    rows = {(r.doc_id, r.word_chars): r for r in judged}
    assert len(judged) == len(TEXTS)
    for doc_id, text, *_ in TEXTS:
        base = slow_base(text)
        r = rows[doc_id, base[1]]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert not (r.base_failed and r.kept)
    assert rules.judge_corpus(empty(spark)).count() == 0
    unknown = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert rules.judge_corpus(unknown).filter("kept = base_failed").count() == 0
    assert rules.passing(documents(spark)).columns == documents(spark).columns
    assert rules.passing(empty(spark)).count() == 0


def test_references_hold_whole_counts(spark):
    docs = load(spark, SMALL, "documents")
    known = rules.references(docs, common=20)
    texts = [r.text for r in docs.filter("lang = 'de'").collect()]
    texts = [t for t in texts if not rules.base_failed(slow_base(t)[0], rules.base_counts(t)[4])]
    words = Counter(w for t in texts for w in rules.plain_words(t))
    top = sorted(words.items(), key=lambda x: (-x[1], x[0].encode()))[:20]
    assert dict(top) == dict(zip(known["de"].place, known["de"].words[:-1].astype(int)))
    assert known["de"].words[-1] == words.total() - sum(n for _, n in top)
    assert known["de"].characters.sum() == sum(map(len, texts))


def slow_quality(rows):
    """Which of ``(doc_id, text, lang)`` the rules keep, with histograms, distances and limits worked out here."""
    def histogram(text):
        kinds = Counter()
        for c in text:
            kinds["space" if c.isspace() else "mark" if c in ".,;:!?'\"()-" else "symbol" if c in "#*$%&|<>" else "digit" if c.isdigit()
                  else "lower" if c.islower() else "upper" if c.isupper() else "letter" if c.isalpha() else "other"] += 1
        return kinds

    def words(text):
        return Counter(w.strip(".,;:!?'\"()-") for w in text.lower().split())

    def divergence(p, q):
        n, m, total = sum(p.values()), sum(q.values()), 0.0
        if not n or not m:
            return float(bool(n) != bool(m))
        for key in p.keys() | q.keys():
            a, b = p.get(key, 0) / n, q.get(key, 0) / m
            total += sum(x * math.log2(2 * x / (a + b)) / 2 for x in (a, b) if x)
        return min(max(total, 0.0), 1.0)

    passed, held, letters = [], defaultdict(Counter), defaultdict(Counter)
    for doc_id, text, lang in rows:
        base = slow_base(text)
        if base[0] >= 50 and 100 * base[4] <= 50 * base[0]:
            passed.append((doc_id, text, base))
            if lang is not None:
                held[lang].update(words(text))
                letters[lang].update(histogram(text))
    shared = {lang: dict(sorted(c.items(), key=lambda x: (-x[1], x[0].encode()))[:100]) for lang, c in held.items()}
    excess = []
    for _, text, base in passed:
        mine, found = words(text), []
        for lang, common in shared.items():
            other = {None: sum(held[lang].values()) - sum(common.values())}
            here = {w: mine[w] for w in common if w in mine}
            here[None] = sum(mine.values()) - sum(here.values())
            found.append((divergence(here, common | other), divergence(histogram(text), letters[lang])))
        w, c = min(found, default=(0.0, 0.0))
        excess.append((c - 3 / base[0], w - 8 / base[0]))
    n, limits = len(passed), []
    for k, (spread, error) in enumerate([(5, 0.25), (8, 1.0)]):
        ordered = sorted(e[k] for e in excess) or [0.0]
        half, upper = ordered[max(math.ceil(n / 2) - 1, 0)], ordered[max(math.ceil(3 * n / 4) - 1, 0)]
        limits.append(half + spread * (upper - half) + error / max(n, 1) ** 0.5)
    return [doc_id for (doc_id, _, base), e in zip(passed, excess)
            if (base[1] < 300 or e[0] <= limits[0]) and (base[0] < 60 or e[1] <= limits[1])]


def texts_of(docs):
    return [(r.doc_id, r.text, r.lang) for r in docs.collect()]


@pytest.mark.parametrize("size", [5, 199, 999, 1000])
def test_verdicts_at_any_size(spark, size):
    """Documents of one corpus, and the first of another; nothing changes at a thousand texts."""
    docs = load(spark, "/root/testdata/sf0.01", "documents").orderBy("doc_id").limit(size)
    noise = docs.limit(20).selectExpr("doc_id + 100000 as doc_id", "replace(text, ' ', '%%% ') as text", "lang", "source", "n_chars")
    both = docs.unionByName(noise)
    kept = sorted(r.doc_id for r in rules.judge_corpus(both).filter("kept").collect())
    assert kept == sorted(slow_quality(texts_of(both)))
    assert sorted(r.doc_id for r in rules.passing(both).collect()) == kept
    labels = load(spark, "/root/testdata/sf0.01", "labels").filter("quality = 1").join(
        rules.judge_corpus(docs).filter("not base_failed and not kept"), "doc_id")
    assert labels.count() == 0
    if size > 500:
        long = {r.doc_id for r in noise.collect() if len(r.text.split()) >= 60}
        assert len(long) > 10 and not long & set(kept)  # symbol noise goes


def test_limits_widen_for_few_texts_and_come_from_the_corpus(spark):
    def limits(rows):
        frame = spark.createDataFrame(rows, "n_words long, char_distance double, word_distance double, base_failed boolean, word_chars long")
        return rules.corpus_limits(rules._measures(frame), frame)

    near = [(200, 0.10 + i / 1e5, 0.30 + i / 2e4, False, 900) for i in range(2000)]
    far = [(200, 0.2 + i / 1e5, 0.45 + i / 2e4, False, 900) for i in range(2000)]
    assert all(a < b for a, b in zip(limits(near), limits(far)))
    assert all(a > b for a, b in zip(limits(near[::100]), limits(near)))
    assert limits([(200, 0.1, 0.3, True, 900)]) == (0.0, 0.0)


def test_letter_noise_and_a_language_left_out_go(spark):
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    assert languages.with_known_language(docs).count() == docs.count()
    rng = random.Random(2)
    noise = [(10**6 + i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(1, 10))) for _ in range(80)), None, "n", 1)
             for i in range(60)]
    kept = languages.with_known_language(docs.unionByName(spark.createDataFrame(noise, docs.schema)))
    assert kept.filter("doc_id >= 1000000").count() == 0 and kept.count() == docs.count()
    others = docs.withColumn("lang", F.when(F.col("lang") != "fr", F.col("lang")))
    french = languages.with_known_language(others).join(docs.filter("lang = 'fr'").select("doc_id"), "doc_id").count()
    assert french < 0.1 * docs.filter("lang = 'fr'").count()
    assert languages.with_known_language(others.filter("lang is null")).count() == 0
