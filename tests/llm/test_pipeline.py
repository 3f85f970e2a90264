import math
import zlib
from collections import Counter

import corpus_pipeline
from frames import TEXTS, documents, empty
from test_bytepairs import ids_of
from test_languages_and_rules import slow_quality
from test_simhash import slow_fingerprint, slow_groups

from tessera.llm import bytepairs, languages, mixing
from tessera.llm.queries import vocabulary_file

SMALL = "/root/testdata/sf0.001"


def test_pipeline_against_its_rules_row_by_row(spark):
    import hashlib

    from tessera.session import load

    docs = load(spark, SMALL, "documents")
    rows = docs.collect()
    judge = languages.Judge(languages.profiles(docs), languages.PROFILE)
    scores = sorted(judge(r.text)[1] for r in rows if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2)
    usual = scores[math.ceil(len(scores) / 2) - 1]
    rows = [r for r in rows if judge(r.text)[0] != "und" and judge(r.text)[1] >= usual / 2]
    good = set(slow_quality([(r.doc_id, r.text, r.lang) for r in rows]))
    rows = [r for r in rows if r.doc_id in good]
    groups = {}
    for r, g in zip(rows, slow_groups([slow_fingerprint(r.text) for r in rows], 3)):
        groups[g] = min(groups.get(g, r), r, key=lambda x: x.doc_id)
    rows = list(groups.values())
    uses = Counter(r.doc_id for r in mixing.mix(spark.createDataFrame(rows, docs.schema)).collect())
    assert set(uses) == {r.doc_id for r in rows}
    encoder = bytepairs.encoder(vocabulary_file())
    wanted = Counter()
    for r in rows:
        packed = encoder.encode(r.text)
        wanted[r.doc_id, len(ids_of(packed)), hashlib.sha256(packed).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()] += uses[r.doc_id]
    assert Counter(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == wanted


def test_stages_take_awkward_rows(spark):
    for start in (documents(spark), empty(spark)):
        docs, names = start, start.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, None)
            assert docs.columns == names
        out = corpus_pipeline.STAGES[-1][1](spark, docs, None)
        assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        out.collect()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(spark), None).count() <= 2 * len(TEXTS) * 4
