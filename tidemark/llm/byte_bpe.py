"""Byte-level BPE with the tokenizers library, from a file of ranks; and its inverse.

The vocabulary is a file of `base64(token) rank` lines.  Its merges are derived: a token is
made of the two parts that earlier ranks leave of it.  Bytes stand for characters as
in every byte-level vocabulary: printable ones for themselves, the others for the characters
from U+0100 on.  Each match of the split pattern is encoded separately.

Decoding looks ids up in the table of byte strings.  A token may hold part of a character:
the bytes of all ids are put together first, and text is made of the whole.  `spans`
gives each token's place in bytes and in characters.

A null text is taken as empty: no ids.  Rows are kept one for one, in no given order.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import chunks, common

MOST = 1 << 18  # pieces of a generation: about 40 MB


def byte_characters() -> list[str]:
    """The character that stands for each byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in printable)
    table = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _parts(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """What merging by ranks below the token's own leaves of it."""
    limit = ranks[token]
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        found = [(ranks.get(parts[i] + parts[i + 1], limit), i) for i in range(len(parts) - 1)]
        rank, i = min(found)
        if rank >= limit:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


@lru_cache(maxsize=2)
def definition(path: str, pattern: str) -> str:
    """The tokenizer of a rank file, as the library's own JSON."""
    from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

    ranks, table = read_ranks(path), byte_characters()
    spelt = {token: "".join(table[b] for b in token) for token in ranks}
    merges = []
    for token in sorted((t for t in ranks if len(t) > 1), key=ranks.get):
        parts = _parts(token, ranks)
        if len(parts) == 2:
            merges.append((spelt[parts[0]], spelt[parts[1]]))
    made = Tokenizer(models.BPE({spelt[t]: r for t, r in ranks.items()}, merges))
    made.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    made.decoder = decoders.ByteLevel()
    return made.to_str()


def byte_table(tokenizer) -> list[bytes]:
    """The bytes of each id; the inverse of the mapping to characters."""
    back = {c: b for b, c in enumerate(byte_characters())}
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    table = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        table[i] = bytes(back[c] for c in token)
    return table


def texts_of(runs: Iterable[Iterable[int]], table: list[bytes]) -> Iterator[str]:
    """Text of ids that arrive in runs; a character split between runs comes with the later one."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for run in runs:
        yield decoder.decode(b"".join(map(table.__getitem__, run)))
    yield decoder.decode(b"", final=True)


def spans(ids: np.ndarray, table: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """End of each token in bytes, and the number of characters begun by then."""
    parts = [table[i] for i in ids.tolist()]
    ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
    begins = (np.frombuffer(b"".join(parts), np.uint8) & 0xC0) != 0x80
    begun = np.concatenate([[0], np.cumsum(begins)])
    return ends, begun[ends]


def tools(definition: str) -> tuple[chunks.Encoder, list[bytes], list[str]]:
    """What a worker keeps: the encoder, and the bytes and the decimal number of each id.

    Of a piece only its ids are kept, 32 bits each: a worker meets new ones without end.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)

    def piece(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    table = byte_table(tokenizer)
    return chunks.Encoder(piece, MOST), table, list(map(str, range(len(table))))


def encoded(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_spans: bool = False,
) -> DataFrame:
    """Per row: doc_id, n_tokens, ids, and digests of the ids and of the bytes they decode to.

    with_spans adds byte_ends and char_ends, the place of each token's end.
    """
    built = docs.sparkSession.sparkContext.broadcast(definition(path, pattern))

    def run(batch: pa.RecordBatch):
        encode, table, numbers = chunks.kept(f"ranks {path}", lambda: tools(built.value))
        rows: dict[str, list] = {k: [] for k in ("n", "ids", "ids_sha256", "decoded_sha256", "bytes", "chars")}
        for text in batch.column(1).to_pylist():
            ids = np.frombuffer(b"".join(encode(text or "")), np.uint32)
            listed = ids.tolist()
            decoded = b"".join(map(table.__getitem__, listed))
            rows["n"].append(len(ids))
            rows["ids"].append(ids.view(np.int32))
            rows["ids_sha256"].append(hashlib.sha256(" ".join(map(numbers.__getitem__, listed)).encode()).hexdigest())
            rows["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
            if with_spans:
                ends, begun = spans(ids, table)
                rows["bytes"].append(ends)
                rows["chars"].append(begun)
        longs = pa.list_(pa.int64())
        columns = {
            "doc_id": batch.column(0),
            "n_tokens": pa.array(rows["n"], pa.int64()),
            "ids": pa.array(rows["ids"], pa.list_(pa.int32())),
            "ids_sha256": pa.array(rows["ids_sha256"], pa.string()),
            "decoded_sha256": pa.array(rows["decoded_sha256"], pa.string()),
        }
        if with_spans:
            columns |= {"byte_ends": pa.array(rows["bytes"], longs), "char_ends": pa.array(rows["chars"], longs)}
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string"
    if with_spans:
        schema += ", byte_ends array<long>, char_ends array<long>"
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return common.in_batches(picked, run, schema, rows=256, keeps=True)


def decoded(tokens: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: doc_id and the text of its ids; bytes that form no character become U+FFFD."""
    built = tokens.sparkSession.sparkContext.broadcast(definition(path, pattern))
    held: dict[str, list[bytes]] = {}

    def run(batch: pa.RecordBatch):
        from tokenizers import Tokenizer

        if not held:
            held["table"] = byte_table(Tokenizer.from_str(built.value))
        texts = ["".join(texts_of([ids or []], held["table"])) for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    picked = tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return common.in_batches(picked, run, "doc_id long, text string", rows=256)
