"""Workers let go of an encoder's pieces when they go on to other work."""

import tracemalloc
from types import SimpleNamespace

import public_tokenizers
import pytest

from tidemark.llm import byte_bpe, chunks, common


@pytest.mark.parametrize("keeps", [False, True])
def test_what_an_encoder_keeps_ends_with_its_stage(spark, keeps):
    table = SimpleNamespace(sparkSession=spark, columns=["id"], mapInArrow=lambda run, _: run)
    run = common.in_batches(table, lambda batch: [batch], "id long", keeps=keeps)
    chunks.kept("pieces", dict)
    assert list(run([])) == []
    assert bool(chunks._kept) == keeps
    chunks.release()


@pytest.mark.parametrize("keeps", [False, True])
def test_a_stage_begins_without_what_arrow_held_for_the_last(spark, keeps, monkeypatch):
    freed = []
    pool = SimpleNamespace(release_unused=lambda: freed.append(True))
    monkeypatch.setattr(chunks.pa, "default_memory_pool", lambda: pool)
    table = SimpleNamespace(sparkSession=spark, columns=["id"], mapInArrow=lambda run, _: run)
    assert list(common.in_batches(table, lambda batch: [batch], "id long", keeps=keeps)([])) == []
    assert freed


def test_a_piece_keeps_little_more_than_its_ids(monkeypatch):
    monkeypatch.setattr(byte_bpe, "MOST", 5000)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encode, table, numbers = byte_bpe.tools(byte_bpe.definition(path, public_tokenizers.PATTERN))
    assert (len(table), numbers[:2]) == (len(numbers), ["0", "1"])
    tracemalloc.start()
    try:
        encode(" ".join(f"w{i}q" for i in range(4000)))
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert len(encode.spaced) == 3999 and held < 4000 * 220
    encode(" ".join(f"v{i}q" for i in range(20_000)))
    assert len(encode.spaced) <= 5000
