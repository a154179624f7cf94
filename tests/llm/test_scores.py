"""Toxicity, quality and language: held-out accuracy, restoring, odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayrate.llm import language, quality, toxicity
from stayrate.llm.common import Words, word_hash

SF = "/root/testdata/sf0.1"


def held(doc_id, folds, k):
    return zlib.crc32(str(doc_id).encode()) % folds == k


def truth(spark, column, sf_dir=SF):
    return {r.doc_id: r[column] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}


def rates(rows, labels, folds, k):
    rows = [r for r in rows if r.doc_id in labels]
    assert all(r.held_out == held(r.doc_id, folds, k) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    rows = [r for r in rows if r.held_out]
    hit = [r.predicted for r in rows if labels[r.doc_id] == 1]
    false = [r.predicted for r in rows if labels[r.doc_id] == 0]
    return np.mean(hit), np.mean(false)


def test_toxicity_on_held_out_documents(spark):
    found, false = rates(toxicity.op2_toxicity(spark, SF).collect(), truth(spark, "toxic"), 4, 2)
    assert found > 0.85 and false < 0.03


def test_quality_on_held_out_documents(spark):
    found, false = rates(quality.op6_quality(spark, SF).collect(), truth(spark, "quality"), 5, 0)
    assert found > 0.98 and false < 0.1


def test_language_on_held_out_documents(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in language.op10_language_id(spark, SF).collect() if r.held_out]
    assert all(held(r.doc_id, 4, 2) for r in rows)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in rows]) > 0.98


@pytest.fixture(scope="module")
def characters(documents):
    plain = "you are a loser and an idiot with pathetic words the scum is worthless and stupid " * 40
    return toxicity.character_model(documents([(1, plain), (2, "the apples are good and cost five dollars " * 40)]))


@pytest.mark.parametrize(
    "given, read",
    [
        ("a l0ser here", "a loser here"), ("p4th3t1c $cum", "pathetic scum"), ("an i d i o t says", "an idiot says"),
        ("w-o-r-t-h-l-e-s-s", "worthless"), ("stuuuupid", "stupid"), ("nothing hidden", "nothing hidden"), ("cost 5 and 12", "cost 5 and 12"), ("", ""),
    ],
)
def test_viterbi_reads_disguised_words(characters, given, read):
    assert toxicity.restore(given, characters) == read


def test_viterbi_equals_trying_every_path(characters):
    import itertools

    def cost(parts):
        x, y, total = 0, 0, 0.0
        for reading, price in parts:
            total += price
            for c in reading:
                s = toxicity.symbol(c)
                total -= characters[x, y, s]
                x, y = y, s
        return total

    for span in ("l0s3r", "1d10t", "s c u m", "l00000l", "aaab1"):
        paths = itertools.product(*toxicity.lattice(span), [(" ", 0.0)])
        best = min(paths, key=lambda p: (cost(p), "".join(r for r, _ in p)))
        assert toxicity.viterbi(span, characters) == "".join(r for r, _ in best)[:-1]


def test_reading_zones_equals_reading_the_whole_text(characters):
    draw = random.Random(8)
    for _ in range(300):
        words = ["".join(draw.choice("abl0o1ié3$!E") for _ in range(draw.randint(1, 9))) for _ in range(draw.randint(0, 8))]
        text = " ".join(w if len(w) > 1 else w + "bb" for w in words)
        whole = toxicity._SPAN.sub(lambda m: toxicity.viterbi(m[0].lower(), characters), text)
        assert toxicity.restore(text, characters) == whole


def odd(documents, odd_rows):
    return documents([*odd_rows, (80, "very long text of words " * 30_000)]).withColumn("score", F.lit("clash"))


def test_odd_rows_get_scores(spark, documents, odd_rows):
    docs = odd(documents, odd_rows)
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (5, 0, 1), (80, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for module, label in ((toxicity, "toxic"), (quality, "quality")):
        from stayrate.llm.common import labelled_sample

        taught = labelled_sample(docs, labels, label, 5, 9, 100)
        for sample in (taught, taught.limit(0)):
            model = module.fit(docs, sample)
            rows = module.score(docs.drop("score"), model).collect()
            assert len(rows) == len(odd_rows) + 1 and all(0 <= r.score <= 1 for r in rows)
            assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
        empty = documents([])
        assert module.score(empty, module.fit(empty, sample.limit(0))).count() == 0


def test_odd_rows_get_languages(documents, odd_rows):
    docs = odd(documents, odd_rows).withColumn("lang", F.when(F.col("doc_id") == 80, "en").when(F.col("doc_id") == 6, "xx"))
    rows = {(r.doc_id, r.lang_pred) for r in language.predict(docs, language.fit(docs)).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (80, "en"), (6, "xx")} <= rows
    assert all(r.lang_pred == "und" and r.score == 0 for r in language.predict(docs, language.fit(docs.limit(0))).collect())


def test_mixture_shares_and_sets():
    like = np.log(np.array([[0.9, 0.05, 0.05]] * 60 + [[0.05, 0.9, 0.05]] * 40 + [[0.9, 0.05, 0.05]] * 30, dtype=np.float32))
    shares = language.mixtures(like, np.array([0, 100, 130, 130]))
    assert abs(shares[0, 0] - 0.6) < 0.1 and shares[0, 2] == 0
    assert shares[1].tolist() == [1, 0, 0]


def test_word_hashes_do_not_depend_on_place():
    raw = np.frombuffer(b"one two one", dtype=np.uint8)
    h = Words(raw, np.array([0, 11]), np.arange(256) != 32).hashes()
    assert h[0] == h[2] == word_hash("one") and h[1] == word_hash("two")
