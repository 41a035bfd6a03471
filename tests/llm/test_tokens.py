"""Token shards and packing next to the tokenizers library."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from flowlens.llm import grammar, packing, tokens
from flowlens.llm.queries import vocabulary
from tests.llm.conftest import ROWS

BYTES, WORDS = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")


def library(path):
    t = Tokenizer.from_file(path)
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_equals_library(path, texts):
    encode, plain = tokens.Encoder(path).encode, library(path)
    odd = [t for _, t, *_ in ROWS if t] + ["<|endoftext|>", "a <|endoftext|> b", "x<|ENDOFTEXT|>y <|startoftext|>", "<|end oftext|>", " a  b ", "x\x0by \x1cz", "é café", "日本 語", "a\r\nb", "q" * 5000]
    for text in [*texts.values(), *odd]:
        assert np.frombuffer(encode(text), "<u4").tolist() == plain(text)


def test_strings_of_added_tokens_are_their_ids():
    assert 50256 in np.frombuffer(tokens.encoder(BYTES).encode("a <|endoftext|> b"), "<u4")
    assert 49407 in np.frombuffer(tokens.encoder(WORDS).encode("a <|endoftext|> b"), "<u4")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abéÉ \n\t\r.,'0 ́\x1c<|ſß", max_size=30))
def test_encoder_equals_library_on_any_text(text):
    for path in (BYTES, WORDS):
        assert np.frombuffer(tokens.encoder(path).encode(text), "<u4").tolist() == library_of(path)(text)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_texts_encoded_together_equal_library(path, monkeypatch):
    many = ["", " ", "\n", "a", " a", "a ", "Foo,\nbar. Foo", "x  y", "x\t y", "it's 1foo 's (foo) foo!? ***", "ÀÉ Àé, àé", "ª º µ × ÷ ß.", "日本 Foo Foo,", "ΑΣ ΑΣ.", "x\x0by",
            "a <|endoftext|> b", "q" * 200 + ", " + "q" * 200, *[f"Foo{i} foo{i}. FOO," for i in "abcdef"]]
    monkeypatch.setattr(tokens, "AT_ONCE", 60)
    monkeypatch.setattr(tokens, "PIECES_AT_ONCE", 3)
    encode = tokens.Encoder(path, most_kept=4)
    for _ in range(2):
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encode.encode_all(many)] == [library_of(path)(t) for t in many]
    assert max(map(len, [*encode._new, *encode._old])) <= tokens.LONGEST_KEPT


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abÉªµ \n\t.,'*#_(1", max_size=14), max_size=8))
def test_any_texts_encoded_together_equal_library(many):
    for path in (BYTES, WORDS):
        assert [np.frombuffer(ids, "<u4").tolist() for ids in tokens.encoder(path).encode_all(many)] == [library_of(path)(t) for t in many]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_words_with_punctuation_are_not_encoded_one_by_one(path, monkeypatch):
    encode, alone = tokens.Encoder(path), []
    monkeypatch.setattr(encode, "_whole", lambda piece: alone.append(piece) or b"")
    list(encode.encode_all(["foo foo! foo*** (foo Foo, été.)\nfoo-- Foo;", "foo bar-- FOO##"]))
    assert alone in (["(foo"], [" (foo"])


_libraries: dict = {}


def library_of(path):
    if path not in _libraries:
        _libraries[path] = library(path)
    return _libraries[path]


def numbered(texts, path, end):
    at, out = 0, {}
    for i in sorted(texts):
        ids = np.array(library(path)(texts[i]) + [end], "<u4")
        out[i] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    return out


def test_shards_give_every_id_back(documents, texts):
    got = grammar.encode_documents(documents, BYTES).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == numbered(texts, BYTES, 0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=120), min_size=1, max_size=6))
def test_any_range_of_a_shard_decodes(docs):
    parts = [np.array(d, "<u4") for d in docs]
    shard = grammar.Shard(grammar.shard_bytes(list(range(len(parts))), [p.tobytes() for p in parts]))
    whole = np.concatenate(parts)
    for k, p in enumerate(parts):
        assert (shard.document(k) == p).all()
    for start in range(0, len(whole), 7):
        assert (shard.ids(start, min(11, len(whole) - start)) == whole[start:start + 11]).all()


def test_rules_shorten_and_damage_is_seen():
    ids = np.tile(np.arange(50), 400).astype("<u4")
    first, rules, symbols = grammar.compress(ids)
    assert first == 50 and len(symbols) < 0.2 * len(ids) and len(rules)
    raw = bytearray(grammar.shard_bytes([None], [ids.tobytes()]))
    raw[100] ^= 1
    with pytest.raises(ValueError):
        grammar.Shard(bytes(raw))


@pytest.mark.parametrize("highest", [40, 65529, 65535, 70000])
def test_shards_of_narrow_and_wide_symbols(highest):
    ids = (highest - np.random.default_rng(0).zipf(1.5, 20000) % 40).astype("<u4")
    shard = grammar.Shard(grammar.shard_bytes([1], [ids.tobytes()]))
    assert (shard.document(0) == ids).all() and len(shard.symbols) < 0.8 * len(ids)


def test_pairs_of_16_bit_symbols_are_sorted_as_32_bits(monkeypatch):
    kinds, sort = [], np.sort
    monkeypatch.setattr(grammar.np, "sort", lambda x: kinds.append(x.dtype.itemsize) or sort(x))
    grammar.compress(np.tile(np.arange(50), 400).astype("<u4"))
    assert set(kinds) == {4}


@pytest.mark.parametrize("ids", [np.zeros(3000), np.arange(20_000) ** 2 % 97, np.arange(9) % 3])
def test_rules_are_expanded_round_by_round(ids):
    ids = ids.astype("<u4")
    first, rules, symbols = grammar.compress(ids)
    rounds = list(grammar._rounds(first, rules))
    assert [k for start, end in rounds for k in range(start, end)] == list(range(len(rules))) and len(rounds) < 30
    assert all((rules[start:end] < first + start).all() for start, end in rounds)
    whole = [[i] for i in range(first)]
    for left, right in rules.tolist():
        whole.append(whole[left] + whole[right])
    assert [len(w) for w in whole[first:]] == grammar.expansion_lengths(first, rules).tolist()
    assert [i for s in symbols.tolist() for i in whole[s]] == ids.tolist()
    assert (grammar.Shard(grammar.shard_bytes([1], [ids.tobytes()])).document(0) == ids).all()


def test_odd_rows_of_both(odd, none):
    rows = grammar.encode_documents(odd, BYTES).collect()
    assert len(rows) == len(ROWS) and sum(r.doc_id is None for r in rows) == 2
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].n_tokens == by_id[4].n_tokens == 1
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    pieces = packing.pack(odd, WORDS).collect()
    assert {r.doc_id for r in pieces} == {r[0] for r in ROWS}
    assert sum(r.doc_id == 13 for r in pieces) == 2
    assert grammar.encode_documents(none, BYTES).count() == packing.pack(none, WORDS).count() == 0


def test_packing_holds_each_id_once(documents, texts):
    rows = packing.pack(documents, WORDS).collect()
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    for i, text in texts.items():
        ids, at = np.array(library_of(WORDS)(text) + [2], "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    used = 0
    for some in windows.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
        used += at
    assert used > 0.97 * 4096 * len(windows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_tree_finds_the_tightest_window(lengths):
    lengths = sorted(lengths, reverse=True)
    windows, offsets = packing.best_fit(lengths, 50)
    rooms: list[int] = []
    for n, window, offset in zip(lengths, windows, offsets):
        fits = [r for r in rooms if r >= n]
        if fits:
            assert rooms[window] == min(fits)
        else:
            assert window == len(rooms)
            rooms.append(50)
        assert offset == 50 - rooms[window]
        rooms[window] -= n
