from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import queries, tokens
from tests.llm.helpers import ODD_TEXTS, SF, documents, empty_documents, odd_documents

PATH = tokens.tokenizer_path()


def ids_of(texts, most=1 << 20):
    raw = [(t or "").encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids, n = tokens.encode_texts(PATH, data, np.cumsum([0, *map(len, raw)]), most=most)
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


def whole(text):
    return tokens.load(PATH).encode(text or "", add_special_tokens=False).ids


def test_counts_equal_the_library_on_whole_texts(spark):
    got = {r.doc_id: r for r in queries.op6_token_counts(spark, SF).collect()}
    docs = documents()
    assert len(got) == len(docs)
    for d in docs:
        r, n = got[d["doc_id"]], len(whole(d["text"]))
        assert (r.n_tokens, r.n_bytes) == (n, len((d["text"] or "").encode()))
        assert r.over_limit == (n > 2048)


def test_odd_texts(spark):
    df = odd_documents(spark)
    got = sorted(
        (str(r.doc_id), r.n_bytes, r.n_tokens)
        for r in tokens.token_counts(df, PATH).collect()
    )
    want = sorted(
        (str(r.doc_id), len((r.text or "").encode()), len(whole(r.text))) for r in df.collect()
    )
    assert got == want


def test_empty_table(spark):
    out = tokens.token_counts(empty_documents(spark), PATH)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert out.count() == 0


def test_model_file_counts_whole_texts(spark):
    import sentencepiece

    path = tokens.tokenizer_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    df = odd_documents(spark).filter("doc_id is not null")
    got = sorted((r.doc_id, r.n_tokens) for r in tokens.token_counts(df, path).collect())
    assert got == sorted((r.doc_id, len(sp.encode(r.text or ""))) for r in df.collect())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]),
                                  st.sampled_from(" \t\n\v\fΣ́'<|>")), max_size=60))
def test_ids_of_a_text_are_the_ids_of_its_words(text):
    assert ids_of([text, text + text]) == [whole(text), whole(text + text)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=[chr(c) for c in (*range(1, 0x180), 0x301, 0x3A3, 0x2028)], max_size=40))
def test_latin_words(text):
    assert ids_of([text, text + text]) == [whole(text), whole(text + text)]


@pytest.mark.parametrize("most", [1, 7, 64, 4000])
def test_batches_end_only_at_white_space(most):
    texts = [*ODD_TEXTS, "", "end", "no break " + "z" * 300]
    assert ids_of(texts, most) == [whole(t) for t in texts]
    raw = [(t or "").encode() for t in texts]
    data, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    cut = list(tokens._chunks(data, off, most))
    assert [a for a, _ in cut] == [0, *(b for _, b in cut[:-1])] and cut[-1][1] == len(data)
