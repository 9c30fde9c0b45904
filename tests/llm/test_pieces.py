import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from costbook.llm import pieces
from costbook.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = pieces.load(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ALPHABET = "ab the  ▁.,!\n\t\x00é漢🙂​️ß<s>0x41_-　ﬁ½²Ａ"


def with_normaliser(rule, **settings_of):
    """The model with another normaliser (compiled map included), for the library and for here."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    own = pb.ModelProto()
    with open(PATH, "rb") as f:
        own.ParseFromString(f.read())
    other = pb.ModelProto()
    other.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    own.normalizer_spec.precompiled_charsmap = other.normalizer_spec.precompiled_charsmap
    for k, v in settings_of.items():
        setattr(own.normalizer_spec, k, v)
    data = own.SerializeToString()
    return pieces.Model(data), sentencepiece.SentencePieceProcessor(model_proto=data)


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from(ALPHABET), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_ids_and_text_equal_the_library(text):
    ids, _, _ = MODEL.encode(text)
    assert ids == LIBRARY.encode(text)
    assert MODEL.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31999)), max_size=12))
def test_decoding_any_ids_equals_the_library(ids):
    assert MODEL.decode(ids) == LIBRARY.decode(ids)


def test_long_texts_equal_the_library():
    rng = random.Random(3)
    for text in (" " * 5000, "w" * 20000, "".join(rng.choice("abcdeé ") for _ in range(30000)), "🙂漢" * 4000, "\n" * 3000, "a▁" * 3000):
        assert MODEL.encode(text)[0] == LIBRARY.encode(text)


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.sampled_from(ALPHABET), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_spans_cover_the_source(text):
    ids, begins, ends = MODEL.encode(text)
    data = text.encode()
    if not ids:
        assert text == ""
        return
    assert begins[0] == 0 and ends[-1] == len(data) and list(begins[1:]) == list(ends[:-1])
    for k, (i, b, e) in enumerate(zip(ids, begins, ends)):
        own = MODEL.surface[i].replace("▁".encode(), b" ")
        seen = data[b:e].replace("▁".encode(), b" ")
        if not MODEL.byte_ids[i]:
            assert seen == (own[1:] if k == 0 and own.startswith(b" ") else own)
        else:
            assert data[b:e] == own


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("trims,prefix", [(False, True), (True, True), (True, False)])
def test_other_normalisers_equal_the_library(rule, trims, prefix):
    model, library = with_normaliser(rule, remove_extra_whitespaces=trims, add_dummy_prefix=prefix)
    assert bool(model.map) == (rule != "identity")
    rng = random.Random(5)
    odd = list(ALPHABET) + [k for k in sorted(model.map)[::97] if "\0" not in k] + [" ", " ", "が", "é"]
    for _ in range(400):
        text = "".join(rng.choice(odd) for _ in range(rng.randrange(0, 30)))
        ids, begins, ends = model.encode(text)
        assert ids == library.encode(text), repr(text)
        assert model.decode(ids) == library.decode(ids)
        n = len(text.encode())
        assert all(0 <= b <= e <= n for b, e in zip(begins, ends)) and list(begins) == sorted(begins)


def test_offsets_through_the_character_map():
    model, _ = with_normaliser("nmt_nfkc", remove_extra_whitespaces=True)
    text = "Ａ  ﬁn"
    assert model.normalise(text)[0] == "▁A▁fin"
    ids, begins, ends = model.encode(text)
    data = text.encode()
    covered = [data[b:e].decode() for b, e in zip(begins, ends)]
    assert "Ａ" in covered[0] and covered[-1].endswith("n") and any("ﬁ" in c for c in covered)


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = QUERIES["op12_sentence_pieces"](spark, sf).collect()
    assert len(out) == len(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in out:
        ids = LIBRARY.encode(texts[r["doc_id"]] or "")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids)))


def test_odd_rows_round_trip_and_empty_table(odd, docs):
    encoded = pieces.encode(odd, PATH)
    back = {(r["doc_id"], r["text"]) for r in pieces.decode(encoded, PATH).collect()}
    assert back == {(r["doc_id"], r["text"] or "") for r in odd.collect()}
    assert pieces.digests(odd, PATH).count() == odd.count()
    assert pieces.encode(docs([]), PATH).count() == 0 and pieces.digests(docs([]), PATH).count() == 0
