import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from brindle.llm import packing, pieces, token_counts
from brindle.llm.texts import slices
from llm_arrow import batch_of

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    "it's THE <|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b x's. I'LL... don't!? 'S 's, ''s",
    "é́ ́ . ! a! 1! é! 日本語! Σας. ΣΑΣ",
    "İstanbul. ＡＢＣ ½ ǅ! 😀",
    "x\x1cy \x85z a\xa0b　c\x0b\x0c",
    "'re'Re'RE re. ll'll! a.́ b",
    "a  b\n c   d \n\n  e ▁ ▁f <s> <0x41> </s>",
    "...",
    "",
    " ",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def test_counts_are_those_of_the_library(make_docs, odd_texts, library):
    rows = odd_texts + [(100 + i, t) for i, t in enumerate(ODD)]
    found = token_counts.count_tokens(make_docs(rows), PIECES, limit=30, part_chars=64).collect()
    wanted = []
    for doc, text in rows:
        n = len(library.encode(text or ""))
        wanted.append((doc, len((text or "").encode()), n, n > 30))
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)


def test_counts_of_given_documents(sf_docs, library):
    texts = {r.doc_id: r.text for r in sf_docs.collect()}
    for part in (200, 1 << 16):
        found = token_counts.count_tokens(sf_docs, PIECES, part_chars=part).collect()
        assert {r.doc_id: r.n_tokens for r in found} == {d: len(library.encode(t)) for d, t in texts.items()}


def test_counts_of_nothing(make_docs):
    assert token_counts.count_tokens(make_docs([]), PIECES).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab ▁\n é.", max_size=60), st.integers(1, 20))
def test_cut_texts_count_alike(text, most):
    model, separable = token_counts.load_pieces(PIECES)
    assert separable
    parts = token_counts.safe_parts(text, most)
    assert sum(len(model.encode(p)) for p in parts) == len(model.encode(text))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aBcé' .,!?#<|>1\n\t日Σ́"), max_size=30), max_size=6))
def test_ids_of_words_are_those_of_the_library(texts):
    texts = [*texts, *ODD]
    words = packing.load_words(WORDS)
    for part in slices(iter([batch_of(texts)])):
        ids, bounds = words.encode(part)
        for i, text in enumerate(texts):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


def check_packing(rows, found, tokenizer, capacity):
    wanted = defaultdict(list)
    for doc, text in rows:
        wanted[doc].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2])
    pieces_of, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces_of[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces_of) == set(wanted)
    for doc, texts in wanted.items():
        cover = sorted((start, min(capacity, len(ids) - start), len(ids), zlib.crc32(np.array(ids[start : start + capacity], "<u4").tobytes()))
                       for ids in texts for start in range(0, len(ids), capacity))
        assert sorted((r.start, r.length, r.doc_tokens, r.ids_crc32) for r in pieces_of[doc]) == cover
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


def test_packing_of_given_documents(sf_docs, tokenizer):
    rows = [(r.doc_id, r.text) for r in sf_docs.collect()]
    found = packing.pack_documents(sf_docs, WORDS).collect()
    sequences = check_packing(rows, found, tokenizer, 4096)
    tokens = sum(r.length for r in found)
    assert len(sequences) <= 1.02 * tokens / 4096 + 1


def test_packing_of_odd_texts(make_docs, odd_texts, tokenizer):
    rows = odd_texts + [(100 + i, t) for i, t in enumerate(ODD)]
    check_packing(rows, packing.pack_documents(make_docs(rows), WORDS, capacity=50, group_pieces=40).collect(), tokenizer, 50)
    assert packing.pack_documents(make_docs([]), WORDS).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=60))
def test_first_fit_decreasing(lengths):
    bins, offsets = packing.first_fit_decreasing(np.array(lengths), 20)
    room = []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = next((b for b, free in enumerate(room) if free >= lengths[item]), len(room))
        if at == len(room):
            room.append(20)
        assert (bins[item], offsets[item]) == (at, 20 - room[at])
        room[at] -= lengths[item]


def test_pieces_round_trip(make_docs, odd_texts, library):
    rows = odd_texts + [(100 + i, t) for i, t in enumerate(ODD)]
    found = pieces.decode(pieces.encode_sampled(make_docs(rows), PIECES, alpha=0.3), PIECES).collect()
    assert len(found) == len(rows)
    known = {library.id_to_piece(i): i for i in range(library.get_piece_size())}
    for r in found:
        assert r.decoded == r.text
        if r.text and "▁" not in r.text:
            assert library.decode(r.pieces) == r.text
        assert (r.pieces is None) == (r.text is None)
    again = pieces.encode_sampled(make_docs(rows[::-1]).repartition(7), PIECES, alpha=0.3).collect()
    assert sorted((str(r.doc_id), str(r.text), r.pieces) for r in found if r.text) == sorted(
        (str(r.doc_id), str(r.text), r.pieces) for r in again if r.text
    )
    assert known["▁"] and pieces.encode_sampled(make_docs([]), PIECES).count() == 0


def all_segmentations(table, text):
    """Every way to cut bytes into pieces, with its weight."""
    ids = {b: i for i, b in enumerate(table.bytes_of) if b}
    ids |= {}
    if not text:
        yield (), 1.0
        return
    for end in range(1, len(text) + 1):
        i = ids.get(text[:end])
        if i is not None:
            for rest, weight in all_segmentations(table, text[end:]):
                yield (i, *rest), weight * np.exp(table.weights[i])


def test_samples_follow_the_weights(make_docs):
    """The share of every segmentation is that of its weight among all."""
    table = pieces.load_pieces(PIECES, 1.0)
    n = 30_000
    text = "then those"
    found = pieces.encode_sampled(make_docs([(i, text) for i in range(n)]), PIECES).groupBy("pieces").count().collect()
    counts = {tuple(r.pieces): r["count"] for r in found}
    wanted = dict(all_segmentations(table, b" then"))
    other = dict(all_segmentations(table, b" those"))
    total = sum(wanted.values()) * sum(other.values())
    expected = {(*a, *b): n * x * y / total for a, x in wanted.items() for b, y in other.items()}
    assert set(counts) <= set(expected)
    for segmentation, mean in expected.items():
        assert abs(counts.get(segmentation, 0) - mean) <= 5 * mean**0.5 + 5


def test_given_documents_round_trip(sf_docs):
    found = pieces.decode(pieces.encode_sampled(sf_docs, PIECES), PIECES)
    assert found.where("decoded <> text or decoded is null").count() == 0
    assert found.count() == sf_docs.count()


def test_repeated_rows_are_dealt_over_groups(make_docs):
    """Rows without id and of one text are in many groups; pieces of one document's rest stay together."""
    packed_rows = packing.pack_documents(make_docs([(None, "same words")] * 600), WORDS, group_pieces=40).collect()
    groups = [r.sequence_id >> 32 for r in packed_rows]
    assert len(packed_rows) == 600 and len(set(groups)) > 10
    assert max(groups.count(g) for g in set(groups)) < 150


def test_larger_vocabularies_are_refused(monkeypatch):
    class Model:
        def get_piece_size(self):
            return (1 << 16) + 1

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", lambda model_file: Model())
    with pytest.raises(ValueError, match="65537 pieces"):
        pieces.PieceTable("any", 1.0)
