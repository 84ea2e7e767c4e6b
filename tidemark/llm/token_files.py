"""Token ids in files of patched frame-of-reference blocks.

A file holds the ids of its documents one after the other, in blocks of BLOCK ids:

    block   count u16, width u8, exceptions u16, least id u32,
            ids less the least, `width` bits each, low bits where one doesn't fit,
            places u16 and values u32 of the exceptions
    tail    block starts u64, document ids i64, null flags u8, ids per document u64,
            then four u64: blocks, documents, ids, start of the tail; and the magic bytes

`width` is that of the value at PERCENT percent of the block; larger ones are exceptions.
Numbers are little-endian.  Tasks write files under names of their own; only
those that the manifest names count, so a task that ran twice leaves nothing that is read.

Texts are encoded as the library does it by a plain call without special tokens: an added token
of the vocabulary that stands in a text is that token.  Texts are cut into pieces
(``chunks``), and a piece into matches of the split pattern where its characters are of those
whose kind all Unicode versions agree on; a match goes to the library's merging alone.

Documents are in ascending doc_id order over all files, a null id first; rows that repeat
a doc_id are in the order of their texts.  A null text is taken as empty: the end id alone.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm import byte_bpe, chunks, common

BLOCK = 1024
PERCENT = 95
RUN = 256  # blocks written or read at a time
MAGIC = b"PFORIDS1"
HEAD = "<HBHI"
TAIL = "<QQQQ"


def _pack(values: np.ndarray, width: int) -> bytes:
    """The low `width` bits of each value, one after the other."""
    octets = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    bits = np.unpackbits(octets, axis=1, count=width, bitorder="little")
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def _unpack(data: bytes, count: int, width: int) -> np.ndarray:
    size = 2 if width <= 16 else 4
    bits = np.zeros((count, 8 * size), np.uint8)
    bits[:, :width] = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width, bitorder="little").reshape(count, width)
    return np.packbits(bits.ravel(), bitorder="little").view(f"<u{size}").astype(np.uint32)


def encode_block(ids: np.ndarray) -> bytes:
    """A block of 1 to BLOCK ids."""
    least = int(ids.min())
    values = (ids - np.uint32(least)).astype(np.uint32)
    place = (len(values) - 1) * PERCENT // 100
    width = int(np.partition(values, place)[place]).bit_length()
    beyond = np.flatnonzero(values >= (1 << width)) if width < 32 else np.empty(0, int)
    return b"".join(
        (
            struct.pack(HEAD, len(values), width, len(beyond), least),
            _pack(values, width) if width else b"",
            beyond.astype("<u2").tobytes(),
            values[beyond].astype("<u4").tobytes(),
        )
    )


def decode_block(data: bytes) -> np.ndarray:
    count, width, beyond, least = struct.unpack_from(HEAD, data)
    at = struct.calcsize(HEAD)
    packed = (count * width + 7) // 8
    values = _unpack(data[at : at + packed], count, width) if width else np.zeros(count, np.uint32)
    at += packed
    places = np.frombuffer(data, "<u2", beyond, at)
    values[places] = np.frombuffer(data, "<u4", beyond, at + 2 * beyond)
    return values + np.uint32(least)


class Writer:
    """Writes documents' ids to one file."""

    def __init__(self, out):
        self.out, self.at = out, 0
        self.held: list[np.ndarray] = []
        self.waiting = 0
        self.starts: list[int] = []
        self.docs: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.counts.append(len(ids))
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BLOCK * RUN:
            self._flush(self.waiting // BLOCK * BLOCK)

    def _flush(self, upto: int) -> None:
        ids = np.concatenate([np.empty(0, np.uint32), *self.held])
        for i in range(0, upto, BLOCK):
            block = encode_block(ids[i : min(i + BLOCK, upto)])
            self.starts.append(self.at)
            self.out.write(block)
            self.at += len(block)
        self.held, self.waiting = [ids[upto:]], len(ids) - upto

    def close(self) -> None:
        self._flush(self.waiting)
        for array in (
            np.array(self.starts, "<u8"),
            np.array([d or 0 for d in self.docs], "<i8"),
            np.array([d is None for d in self.docs], "u1"),
            np.array(self.counts, "<u8"),
        ):
            self.out.write(array.tobytes())
        self.out.write(struct.pack(TAIL, len(self.starts), len(self.docs), sum(self.counts), self.at) + MAGIC)


class Reader:
    """Reads a file by its index; any block alone, or all documents in order."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        end = self._at(size - struct.calcsize(TAIL) - len(MAGIC), struct.calcsize(TAIL) + len(MAGIC))
        if end[struct.calcsize(TAIL) :] != MAGIC:
            raise ValueError("not a file of token ids")
        blocks, docs, self.total, tail = struct.unpack(TAIL, end[: struct.calcsize(TAIL)])
        data = self._at(tail, 8 * blocks + 17 * docs)
        self.starts = np.append(np.frombuffer(data, "<u8", blocks), np.uint64(tail)).astype(np.int64)
        ids = np.frombuffer(data, "<i8", docs, 8 * blocks)
        null = np.frombuffer(data, "u1", docs, 8 * blocks + 8 * docs)
        self.docs = [None if n else int(i) for i, n in zip(ids, null, strict=True)]
        self.counts = np.frombuffer(data, "<u8", docs, 8 * blocks + 9 * docs).astype(np.int64)

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        return self.source.read(size)

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks first to last, the last one exclusive."""
        base = int(self.starts[first])
        data = self._at(base, int(self.starts[last]) - base)
        cuts = self.starts[first : last + 1] - base
        return np.concatenate([decode_block(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])

    def documents(self) -> Iterator[tuple[int | None, Iterator[np.ndarray]]]:
        """Each document's id and its ids, in runs; a long document is never held whole."""
        block, held = 0, np.empty(0, np.uint32)

        def take(count: int) -> Iterator[np.ndarray]:
            nonlocal block, held
            while count:
                if not len(held):
                    after = min(block + RUN, len(self.starts) - 1)
                    held, block = self.blocks(block, after), after
                part, held = held[:count], held[count:]
                count -= len(part)
                yield part

        for doc, count in zip(self.docs, self.counts.tolist(), strict=True):
            yield doc, take(count)


# The split pattern of byte-level vocabularies, and settings that go with it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
MARKS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'  # ASCII characters that are none of them, but for the apostrophe
OLD = "\u024f"  # characters up to here have long been letters, digits, spaces or none of them


def encoder(definition: str) -> Callable[[str], Iterable[bytes]]:
    """Gives a text's ids in parts, 32 bits each, as the tokenizer of that definition has them."""
    import regex
    from tokenizers import Tokenizer

    tokenizer, described = Tokenizer.from_str(definition), json.loads(definition)

    def whole(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    added = [t["content"] for t in described["added_tokens"]]
    split = described["pre_tokenizer"] or {}
    if any(regex.search(r"\s", t) for t in added) or any(split.get(k) != v for k, v in PLAIN.items()):
        return lambda text: [whole(text)]
    if described["normalizer"] is not None or described["model"]["type"] != "BPE":
        return chunks.Encoder(whole)
    spelt = dict(enumerate(byte_bpe.byte_characters()))
    model, matches = tokenizer.model, regex.compile(SPLIT)

    def ids(match: str) -> bytes:
        tokens = model.tokenize(match)
        return struct.pack(f"={len(tokens)}I", *[t.id for t in tokens])

    known = chunks.Pieces(lambda match: ids(match.encode().decode("latin-1").translate(spelt)))
    space = spelt[ord(" ")]
    words = not any(t.isalpha() for t in added)  # no added token is a mere word

    def begun(text: str, core: str) -> bytes:
        """Ids of a core, after a space if the text begins with one."""
        return encode.spaced[core] if text[0] == " " else encode.whole[core]

    def piece(text: str) -> bytes:
        word = text.removeprefix(" ")
        if words and word.isalpha():
            # One match, and ASCII letters stand for themselves.
            if word.isascii():
                return ids(space + word if len(word) < len(text) else word)
            if max(word) <= OLD:
                return ids(text.encode().decode("latin-1").translate(spelt))
        if not text:
            return b""
        if any(t in text for t in added):
            return whole(text)
        core = word.rstrip(MARKS)
        if len(core) < len(word) and core.isalpha() and max(core) <= OLD:
            # Two matches: a word, which may be known by itself, and marks.
            return begun(text, core) + known[word[len(core) :]]
        lines = text.split("\n")
        if len(lines) > 1 and all(lines) and not any(a[-1].isspace() or b[0].isspace() for a, b in pairwise(lines)):
            # A line's end between others is a match of its own.
            rest = [end + encode.whole[line] for line in lines[1:]]
            return b"".join([begun(lines[0], lines[0].removeprefix(" ")), *rest])
        if max(text) > OLD:
            return whole(text)
        return b"".join(map(known.__getitem__, matches.findall(text)))

    encode, end = chunks.Encoder(piece), known["\n"]
    return encode


def write(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and write all documents; the manifest: part, path, docs, ids, start."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())
    folder = session.run_dir(spark, "ids")
    fs, inner = common.filesystem(folder)
    fs.create_dir(inner, recursive=True)
    common.ship(spark)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = chunks.kept(f"files {zlib.crc32(definition.value.encode())}", lambda: encoder(definition.value))
        end = np.array([end_id], np.uint32).tobytes()
        task = TaskContext.get()
        name = f"ids-{task.partitionId():06d}-{uuid.uuid4().hex}.pfor"
        fs, inner = common.filesystem(f"{folder}/{name}")
        with fs.open_output_stream(inner, compression=None) as out:
            writer = Writer(out)
            for batch in batches:
                for part in common.narrow(batch, 256):
                    for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                        ids = b"".join([*encode(text or ""), end])
                        writer.add(doc, np.frombuffer(ids, np.uint32))
            writer.close()
        if writer.docs:
            row = [[task.partitionId()], [f"{folder}/{name}"], [len(writer.docs)], [sum(writer.counts)]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, row)), names=["part", "path", "docs", "ids"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = int(spark.conf.get(session.SHUFFLE_PARTITIONS))
    ordered = picked.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    made = ordered.mapInArrow(run, "part long, path string, docs long, ids long")
    manifest = common.store(made, "ids-manifest")
    # One row per file: the running total needs no more than one task.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""

    def run(batch: pa.RecordBatch):
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            fs, inner = common.filesystem(path)
            rows = []
            with fs.open_input_file(inner) as source:
                reader = Reader(source)
                for (doc, runs), count in zip(reader.documents(), reader.counts.tolist(), strict=True):
                    crc = 0
                    for part in runs:
                        crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                    rows.append((doc, start, count, crc))
                    start += count
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest.select("path", "start").repartition(int(manifest.sparkSession.conf.get(session.SHUFFLE_PARTITIONS)))
    return common.in_batches(files, run, "doc_id long, start long, n_tokens long, ids_crc32 long", rows=1)

