"""Token encoding, packing and token files: exact round trips."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pagemill.llm import packing, token_files, tokens

PATH = tokens.default_path()
ENCODER = tokens.Encoder(PATH, max_units=50)
LIBRARY = Tokenizer.from_file(PATH)  # as the library has it, no setting changed


def plain_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r\x0b\x1c\x85\xa0 　'aA9.!é中"), st.characters(codec="utf-8")), max_size=40))
def test_units_give_the_ids_of_whole_texts(text):
    assert ENCODER.encode([text])[0].tolist() == plain_ids(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "a", "end", ".", "'s", "é", "<|"]), max_size=12).map("".join))
def test_special_strings_get_the_ids_of_the_library(text):
    assert [i.tolist() for i in ENCODER.encode(["before", text, "after"], 5)] == [[*plain_ids(t), 5] for t in ("before", text, "after")]


def test_special_strings_can_be_ordinary_text(docs_of):
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    text = "a <|endoftext|>b.<|endoftext|>"
    ids = library.encode(text, add_special_tokens=False).ids
    assert 50256 not in ids and tokens.Encoder(PATH, specials_as_text=True).encode([text])[0].tolist() == ids != plain_ids(text)
    row = packing.pack(docs_of([(1, text)]), specials_as_text=True).first()
    assert row.doc_tokens == len(ids) + 1 and token_files.write_token_files(docs_of([(1, text)]), specials_as_text=True).first().n_tokens == len(ids) + 1


def test_another_tokenizer_gets_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = tokens.Encoder(path), Tokenizer.from_file(path)
    texts = ["", "Hello,  World\nagain<|endoftext|> 3.14", "x" * 200]
    assert not own.cuts and [i.tolist() for i in own.encode(texts, 3)] == [[*library.encode(t, add_special_tokens=False).ids, 3] for t in texts]


def test_units_on_prose():
    draw = random.Random(3)
    words = ["the", "don't", "we'll", "naïve", "<|endoftext|>", "3.14", "x" * 300, "中文", "​", "á", "--", "﻿"]
    texts = ["".join(draw.choice(words) + draw.choice([" ", "  ", "\n", "\n\n", ". ", " \n ", "\t", " ", ", "]) for _ in range(200)) for _ in range(50)]
    assert [i.tolist() for i in ENCODER.encode(texts, 7)] == [[*plain_ids(t), 7] for t in texts]


PAIRS = [(i, f"word{i} and more " * (i % 50)) for i in range(300)] + [(5, "again"), (5, "again"), (None, "no id"), (301, None), (302, ""), (303, "long words " * 30_000), (304, "one<|endoftext|>two <|endoftext|>")]


def test_pieces_cover_every_id_once(docs_of):
    rows = packing.pack(docs_of(PAIRS), with_ids=True).collect()
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
    for k, pieces in by_sequence.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 2048 or k == max(by_sequence)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    got, want = Counter(), Counter()
    whole = defaultdict(list)
    for r in rows:
        whole[r.doc_id].append((r.sequence_id, r.offset, r.start, r.doc_tokens, r.ids))
    for i, pieces in whole.items():
        ids = b""
        for _, _, start, n, raw in sorted(pieces):
            assert start == len(ids) // 4
            ids += raw
            if len(ids) == 4 * n:
                got[i, ids] += 1
                ids = b""
        assert not ids
    for i, t in PAIRS:
        want[i, np.array([*plain_ids(t), 1], "<u4").tobytes()] += 1
    assert got == want


def test_sequences_put_the_pieces_together(docs_of):
    whole = packing.sequences(packing.pack(docs_of(PAIRS[:100]), seq_len=64, with_ids=True)).orderBy("sequence_id").collect()
    assert [r.n_tokens for r in whole[:-1]] == [64] * (len(whole) - 1)
    assert all(len(r.ids) == 4 * r.n_tokens and sum(b.length for b in r.boundaries) == r.n_tokens for r in whole)


def test_token_files_read_back(docs_of, spark):
    manifest = token_files.write_token_files(docs_of(PAIRS))
    rows = sorted(token_files.read_documents(manifest).collect(), key=lambda r: r.start)
    assert [r.start for r in rows] == list(np.cumsum([0] + [r.n_tokens for r in rows[:-1]]))
    assert [r.doc_id for r in rows] == sorted((i for i, _ in PAIRS), key=lambda i: -1 if i is None else i)
    crc = lambda t: zlib.crc32(np.array([*plain_ids(t), 2], "<u4").tobytes())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == Counter((i, len(plain_ids(t)) + 1, crc(t)) for i, t in PAIRS)
    for part in manifest.collect():
        opened = token_files.Sequences(part.tokens_file)
        real = 0
        for k in range(part.n_sequences):
            ids, mask = opened.sequence(k)
            assert len(ids) == len(mask) == 2048
            assert mask.all() or k == part.n_sequences - 1
            real += int(mask.sum())
        assert real == part.n_tokens
    first, _ = token_files.Sequences(manifest.first().tokens_file).sequence(0)
    assert not first.flags.owndata  # a view into the mapped file


def test_rows_without_an_id_spread_over_files(docs_of, spark):
    """Half of the rows are one and the same, without an id."""
    pairs = [(None, "the same text")] * 600 + [(i, f"text {i}") for i in range(600)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which would put these few rows together
    try:
        manifest = token_files.write_token_files(docs_of(pairs).repartition(8))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = manifest.collect()
    assert sum(p.n_docs for p in parts) == 1200 and max(p.n_docs for p in parts) < 500
    rows = token_files.read_documents(manifest).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None] * 600 + list(range(600)) and len({(r.n_tokens, r.ids_crc32) for r in rows[:600]}) == 1


def test_empty_tables(docs_of):
    assert packing.pack(docs_of([])).count() == 0
    assert token_files.read_documents(token_files.write_token_files(docs_of([]))).count() == 0
