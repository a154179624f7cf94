import random

import pytest
from pyspark.sql import functions as F

from stayrate.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


def test_merging_equals_the_library_on_odd_text(library):
    words = bpe.vocabulary(bpe.default_vocabulary())
    draw = random.Random(1)
    signs = "ab 'sStTé\n\t\r\x1c\x85\xa0 　ß漢字🙂1٣½.,!?-_́힣\xad​"
    for _ in range(3000):
        text = "".join(draw.choice(signs) for _ in range(draw.randint(0, 25)))
        if draw.random() < 0.2:
            text += "<|endoftext|>" + text
        ids = [i for w in words.pretokens(text) for i in ([words.special[w]] if w in words.special else words.merge(w.encode()))]
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_automaton_accepts_its_words_and_shares_suffixes():
    words = sorted({a + b + c for a in ("re", "un", "in") for b in ("do", "set", "tie") for c in ("", "ing", "ings", "er")})
    entries = [(w.encode(), [i, i + 1]) for i, w in enumerate(words)]
    lexicon = bpe.Lexicon(bpe.compile_lexicon(entries))
    for w, ids in entries:
        assert list(memoryview(lexicon.get(w)).cast("i")) == ids
    for other in (b"", b"re", b"doing", b"redoingsx", b"zzz"):
        assert lexicon.get(other) is None
    # the three prefixes lead to states that share everything behind them
    assert lexicon.states < len({w[:i] for w in words for i in range(len(w) + 1)}) / 2


def test_round_trip_equals_the_library(spark, documents, odd_rows, library):
    rows = [*odd_rows, (7, "<|endoftext|> inside <|endoftext|>"), (8, "long text " * 40_000), (9, "long text " * 3)]
    coded = bpe.decode(bpe.encode(documents(rows).withColumn("token_ids", F.lit("clash"))))
    got = coded.select("doc_id", "text", "token_ids", "decoded").collect()
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.token_ids == ids and r.decoded == (library.decode(ids, skip_special_tokens=False))


def test_empty_table(spark, documents):
    assert bpe.decode(bpe.encode(documents([]))).count() == 0


def test_query_equals_the_library_on_the_whole_table(spark, sf_dir, library):
    import hashlib

    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in bpe.op5_bpe_round_trip(spark, sf_dir).collect():
        ids = library.encode(texts.pop(r.doc_id), add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(",".join(map(str, ids))))
        assert r.decoded_sha256 == digest(library.decode(ids, skip_special_tokens=False))
    assert not texts
