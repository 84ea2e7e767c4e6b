"""Token ids piece by piece against the plain library; spans and decoding at split characters."""

from __future__ import annotations

import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import byte_bpe, chunks, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = [
    "the", "Word", "naïve", "ß", "ǅ", "ɏ", "ɐ", "日本", "😀", "é", "'s", "'ll", "'", "12", "½", "٣", "²", "_", "...", "%%%",
    " ", "  ", "\n", "\r\n", "\t", " ", "\u0085", " ", "\x1c", "\x00", "<|endoftext|>", "<|endof", "text|>", "ª", "µ", "×", "÷",
]


def texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["", " ", "a <|endoftext|> b", *("".join(rng.choices(PARTS, k=rng.randint(1, 14))) for _ in range(n))]


def test_pieces_give_what_the_library_gives():
    with open(PATH, encoding="utf-8") as file:
        encode = token_files.encoder(file.read())
    plain = Tokenizer.from_file(PATH)
    for text in texts(1, 4000):
        ids = np.frombuffer(b"".join(encode(text)), np.uint32).tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids, text


def test_words_are_known_whatever_marks_follow():
    with open(PATH, encoding="utf-8") as file:
        encode = token_files.encoder(file.read())
    plain = Tokenizer.from_file(PATH)
    lines = "x\n" * 5000 + "y"
    odd = [" a.\nB\nc d", "a \nb c", "a\u3000\nb c", "\u65e5\n\u672c. a", "a'. b.' c!'s", lines]
    for text in ["x lorem, naïve. ipsum.\nDolor sit", *odd]:
        assert np.frombuffer(b"".join(encode(text)), np.uint32).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert {"lorem", "naïve", "ipsum"} <= encode.spaced.keys() and {"Dolor"} <= encode.whole.keys()


def test_added_tokens_with_spaces_are_not_cut():
    with open(PATH, encoding="utf-8") as file:
        definition = json.loads(file.read())
    definition["added_tokens"].append({**definition["added_tokens"][0], "id": 50257, "content": "<a b>"})
    encode, plain = token_files.encoder(json.dumps(definition)), Tokenizer.from_str(json.dumps(definition))
    for text in ("x <a b> y", "<a b", "a b>"):
        assert np.frombuffer(b"".join(encode(text)), np.uint32).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_forgotten_pieces_are_made_again(monkeypatch):
    monkeypatch.setattr(chunks, "MOST", 3)
    asked = []
    pieces = chunks.Pieces(lambda text: asked.append(text) or text.upper())
    for text in "abcabcdabceaz":
        assert pieces[text] == text.upper()
    assert len(pieces) <= 3 and asked.count("a") == 1 and set(asked) == set("abcdez")


def test_odd_rows_in_files(spark):
    rows = [(2, "b"), (None, "n"), (2, "a"), (1, None), (1, None), (-5, "x " * 70_000), (3, "a <|endoftext|> b")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, start int")
    plain = Tokenizer.from_file(PATH)
    found = sorted(token_files.read(token_files.write(docs, PATH, 2)).collect(), key=lambda r: r["start"])
    start = 0
    for r, (doc, text) in zip(found, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")), strict=True):
        assert (r["doc_id"], r["start"]) == (doc, start)
        assert r["n_tokens"] == len(plain.encode(text or "", add_special_tokens=False).ids) + 1
        start += r["n_tokens"]
    assert token_files.read(token_files.write(docs.limit(0), PATH, 2)).count() == 0


@pytest.mark.parametrize("with_spans", [False, True])
def test_spans_and_decoding(spark, with_spans):
    # Some of these characters are several tokens; their parts decode to nothing by themselves.
    rows = [(1, ""), (1, None), (None, "😀 naïve 日本 𝔘𝔫𝔦"), (2, "a b"), (2, "a b"), (3, "ü" * 50_000)]
    docs = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, n_tokens string")
    found = byte_bpe.encoded(docs, RANKS, public_tokenizers.PATTERN, with_spans=with_spans)
    back = byte_bpe.decoded(found, RANKS, public_tokenizers.PATTERN).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    assert sorted([(r["doc_id"], r["text"]) for r in back], key=key) == sorted([(i, t or "") for i, t in rows], key=key)
    if not with_spans:
        return
    tokenizer = Tokenizer.from_str(byte_bpe.definition(RANKS, public_tokenizers.PATTERN))
    table = byte_bpe.byte_table(tokenizer)
    split = 0
    for r, text in zip(found.collect(), [t or "" for _, t in rows], strict=True):
        data = text.encode()
        assert len(r["byte_ends"]) == len(r["char_ends"]) == r["n_tokens"]
        at = 0
        for token, end, chars in zip(r["ids"], r["byte_ends"], r["char_ends"], strict=True):
            assert data[at:end] == table[token]
            # A character counts from its first byte on.
            assert chars == sum((b & 0xC0) != 0x80 for b in data[:end]) if len(data) < 100 else True
            split += (data[end : end + 1] or b"a")[0] & 0xC0 == 0x80
            at = end
        assert at == len(data)
    assert split
    runs = [found.where("doc_id IS NULL").first()["ids"]]
    pieces = list(byte_bpe.texts_of([[i] for i in runs[0]], table))
    assert "".join(pieces) == rows[2][1] and "" in pieces
