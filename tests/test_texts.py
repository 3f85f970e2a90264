import math
from collections import Counter

from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import vocabulary as voc


def test_cleaning_order(spark):
    df = spark.createDataFrame([("See HTTP://a.b/C?d=1 NOW!\nÉté  www.x.it ok",), ("",), (None,)], "t string")
    out = [r[0] for r in df.select(text.cleaned_comment(F.col("t"))).collect()]
    assert out == ["see now t wwwxit ok", "", None]


def test_mail_tokens(spark):
    df = spark.createDataFrame([("The offer, don't wait: abc123 x città 42 offers",)], "t string")
    assert df.select(text.mail_tokens(F.col("t"))).first()[0] == ["offer", "wait", "città", "offers"]
    assert df.select(text.cleaned_mail(F.col("t"), ["offer"])).first()[0] == "the don wait città offers"


DOCS = [(1, ["b", "a", "b"]), (2, ["a", "c"]), (3, []), (4, ["d"] * 5 + ["b"])]


def documents(spark):
    return spark.createDataFrame(DOCS, "doc long, tokens array<string>")


def test_vocabulary_ties_go_to_first_appearance(spark):
    ranked = {r["token"]: (r["n"], r["rank"]) for r in voc.vocabulary(documents(spark), "doc", "tokens").collect()}
    assert ranked == {"d": (5, 1), "b": (3, 2), "a": (2, 3), "c": (1, 4)}


def test_encoding_and_padding(spark):
    df = documents(spark)
    ranked = voc.vocabulary(df, "doc", "tokens")
    ids = {r["doc"]: r["ids"] for r in voc.encode(df, "doc", "tokens", ranked, 4).collect()}
    assert ids == {1: [3, 1, 3], 2: [1, 1], 3: [], 4: [2, 2, 2, 2, 2, 3]}  # 1 is out of vocabulary
    cut = voc.encode(df, "doc", "tokens", ranked, 100).select("doc", voc.padded(F.col("ids"), 4).alias("p"))
    assert {r["doc"]: r["p"] for r in cut.collect()} == {1: [3, 4, 3, 0], 2: [4, 5, 0, 0], 3: [0] * 4, 4: [2] * 4}


def test_coverage_is_monotone_and_cut_off_is_a_word_count(spark):
    covered = voc.coverage(voc.token_counts(documents(spark), "doc", "tokens"))
    rows = sorted(covered.collect(), key=lambda r: r["rank"])
    assert [r["token"] for r in rows] == ["d", "b", "a", "c"]
    assert [r["covered"] for r in rows] == [5, 8, 10, 11]
    cut = {r["share"]: r["words"] for r in voc.coverage_cutoff(covered, [0.5, 0.9, 1.0]).collect()}
    assert cut == {0.5: 2, 0.9: 3, 1.0: 4}


def test_lengths(spark):
    r = voc.length_distribution(documents(spark), "doc", "tokens").first()
    assert (r["longest"], r["longest_id"]) == (6, 4)


def test_tfidf_against_definition(spark):
    docs = [(i, ["x"] * (i % 3 + 1) + ["y"] * (i % 2) + [f"r{i}"] + (["z"] if i < 4 else [])) for i in range(20)]
    df = spark.createDataFrame(docs, "doc long, tokens array<string>")
    got = {(r["doc"], r["token"]): r["weight"] for r in voc.tfidf(df, "doc", "tokens", 3, 0.6).collect()}
    frequency = Counter(t for _, tokens in docs for t in set(tokens))
    kept = {t: math.log(21 / (1 + f)) + 1 for t, f in frequency.items() if f >= 3 and f <= 0.6 * 20}
    assert set(kept) == {"y", "z"}
    for doc, tokens in docs:
        raw = {t: n * kept[t] for t, n in Counter(tokens).items() if t in kept}
        length = math.sqrt(sum(v * v for v in raw.values()))
        for t, v in raw.items():
            assert abs(got.pop((doc, t)) - v / length) < 1e-12
    assert not got


def test_dictionary_limits(spark):
    frequency = voc.document_frequency(documents(spark), "tokens")
    assert {r["token"]: r["documents"] for r in frequency.collect()} == {"a": 2, "b": 2, "c": 1, "d": 1}
    assert [r["token"] for r in voc.filter_extremes(frequency, 2, 0.5, 1).collect()] == ["a"]
    bag = voc.bag_of_words(documents(spark), "doc", "tokens", voc.filter_extremes(frequency, 2, 0.5))
    assert sorted(tuple(r) for r in bag.collect()) == [(1, 0, 1), (1, 1, 2), (2, 0, 1), (4, 1, 1)]


def test_words_of_comments_without_cleaning_spaces(spark):
    rows = [("See HTTP://a.b/C?d=1 NOW!\nÉté  www.x.it ok",), ("",), (None,), (" \t\n",), ("a b  c\x1cd-e\r\n9 9 f'g ",), ("123",)]
    df = spark.createDataFrame(rows, "t string")
    plain, short = text.words(text.cleaned_comment(F.col("t"))), text.comment_words(F.col("t"))
    for a, b in df.select(plain, short).collect():
        assert a == b


def test_tasks_of_term_counts_follow_the_tokens(spark, monkeypatch):
    rows = [(i % 50, [f"w{(i + j) % 7}" for j in range(20)]) for i in range(100)] + [(None, ["w1", "w1"]), (3, None), (4, [])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    few = {tuple(r) for r in voc.tfidf(df, "id", "tokens", 1, 1.0).collect()}
    monkeypatch.setattr(voc, "TASK_TOKENS", 40)
    weights = voc.tfidf(df, "id", "tokens", 1, 1.0)
    assert weights.rdd.getNumPartitions() == 51  # 2002 tokens, and no fewer tasks after the shuffle
    assert {tuple(r) for r in weights.collect()} == few and sum(r[2] for r in few) == 2002
