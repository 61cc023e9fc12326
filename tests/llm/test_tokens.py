"""Encoding, decoding and counting against the library that the files are made for."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer, models, normalizers

from shelfmark.llm import bpe, token_counts

TEXTS = ["", "a<|endoftext|>B<|startoftext|>  x", "ΑΣ ΣΑΣ it's ' 'S'RE!!", "x" * 900, "ab" * 700 + "!!'s", "İstanbul é ﬁ ½ ² 日本語 🙂🙂",
         "a\x1cb\x85c d\x00e", "   a   b  ", "日本\n\n 語a", "\n", "The pathway of rivers, 2024."]


def codec():
    return bpe.Codec(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())


def test_ids_and_decoding_match_the_library():
    own, other = codec(), Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for text in TEXTS + [chr(i) + "a" + chr(i) for i in range(1, 0x3000)]:
        ids = other.encode(text, add_special_tokens=False).ids
        mine = np.frombuffer(own.encode(text), np.int32)
        assert mine.tolist() == ids, text
        assert own.decode(mine) == other.decode(ids, skip_special_tokens=False)


def test_long_words_merge_as_short_ones():
    own, rng = codec(), np.random.default_rng(1)
    for _ in range(200):
        ids = [own.inner[b] for b in bytes(rng.choice(list(b"aehinorst"), size=40))]
        assert own.merge_short(list(ids)) == own.merge_long(list(ids))


def test_counts_match_the_library():
    pieces = token_counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    vocab = [("<unk>", 0.0), *pieces, *((f"<0x{b:02X}>", 0.0) for b in range(256))]
    other = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))
    other.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    own = token_counts.Counter(tuple(pieces))
    for text in TEXTS:
        assert own.text(text)[1] == len(other.encode(text, add_special_tokens=False).ids), text


def test_ties_go_to_the_longer_piece():
    own = token_counts.Counter((("▁ab", -2.0), ("▁a", -1.0), ("b", -1.0), ("▁", -1.0), ("a", -1.0)))
    assert own.text("ab") == (-2.0, 1)


def test_edge_rows(edge, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = bpe.digests(bpe.encode_decode(edge, path), ["doc_id"]).collect()
    assert len(rows) == edge.count() and rows[0]["n_tokens"] == rows[1]["n_tokens"] == 0
    counts = token_counts.count_tokens(edge, public_tokenizers.path("piece_bpe_32k.model"))
    assert dict(counts.dtypes)["n_tokens"] == "bigint" and counts.count() == edge.count()
    assert bpe.encode_decode(empty, path).count() == 0
