"""Every registered query of `llm` against a plain computation over the whole small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__

DATA = "/root/testdata/sf0.001"
ASCII = {i: i + 32 for i in range(65, 91)}


@cache
def table(name: str, folder: str = DATA) -> list[dict]:
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


def rows(spark, name: str, folder: str = DATA) -> list[dict]:
    return [r.asDict() for r in __spark_entry__.queries()[name](spark, folder).collect()]


def roots(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_warc(spark):
    kept = {}
    for p in table("pages"):
        data = (p["html"] or "").encode()
        if len(data) >= 1000:
            kept[data] = max(kept.get(data, -1), p["page_id"])
    found = {r["page_id"]: r for r in rows(spark, "op1_warc_index")}
    assert len(found) == len(table("pages"))
    for p in table("pages"):
        data = (p["html"] or "").encode()
        revisit = kept.get(data, p["page_id"]) != p["page_id"]
        assert found[p["page_id"]] == {
            "page_id": p["page_id"],
            "payload_bytes": len(data),
            "payload_digest": hashlib.sha1(data).hexdigest(),
            "record_type": "revisit" if revisit else "response",
            "refers_to": kept[data] if revisit else None,
        }


def test_embeddings(spark):
    v = np.array([r["embedding"] for r in table("embeddings")], np.float64)
    ids = [r["vec_id"] for r in table("embeddings")]
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(v @ v.T >= 0.95), strict=True) if a != b]
    components = roots(ids, links)
    count = defaultdict(int)
    for a, _ in links:
        count[a] += 1
    found = rows(spark, "op2_embedding_near_dedup")
    assert len(found) == len(ids)
    agree = sum(r["n_links"] == count[r["vec_id"]] and r["component_id"] == components[r["vec_id"]] for r in found)
    assert sum(r["n_links"] for r in found) >= 0.99 * len(links) and agree >= 0.99 * len(ids)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def shingle_sets() -> dict:
    out = {}
    for d in table("documents"):
        w = re.findall(r"[^\x20\x09-\x0D]+", (d["text"] or "").translate(ASCII))
        out[d["doc_id"]] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    return out


def test_jaccard(spark):
    sets = shingle_sets()
    ids = sorted(sets)
    links = [
        (a, b)
        for i, a in enumerate(ids)
        for b in ids[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    components = roots(ids, links)
    assert links
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(spark, "op3_ngram_jaccard")}
    assert found == {i: (len(sets[i]), components[i]) for i in ids}


def test_decontamination(spark):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII))

    windows = defaultdict(set)
    for item in table("benchmark"):
        w = words(item["text"])
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i : i + size])].add(item["item_id"])
    found = {r["doc_id"]: r for r in rows(spark, "op5_decontamination")}
    assert any(r["contaminated"] for r in found.values())
    for d in table("documents"):
        w = words(d["text"])
        hit, items = set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    items |= windows[tuple(w[i : i + size])]
        listed = ",".join(sorted(map(str, items)))
        assert found[d["doc_id"]] == {
            "doc_id": d["doc_id"],
            "n_words": len(w),
            "n_hit": len(hit),
            "n_items": len(items),
            "items_sha256": hashlib.sha256(listed.encode()).hexdigest(),
            "contaminated": bool(hit),
        }


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_secrets(spark):
    larger = "/root/testdata/sf0.01"
    found = {r["doc_id"]: r for r in rows(spark, "op6_secret_scan", larger)}
    total = 0
    for d in table("documents", larger):
        expected = base_spans(d["text"] or "")
        r = found[d["doc_id"]]
        total += len(expected)
        for kind in ("assign", "access", "hex"):
            assert r[f"n_{kind}"] == sum(s[3] == kind for s in expected)
        listed = [f"{k}:{a}:{b}" for a, _, b, k in expected]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s and not s.startswith("markov")] == listed
    assert total and len(found) == len(table("documents", larger))


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_token_files(spark):
    encode, start = tokenizer(), 0
    found = {r["doc_id"]: r for r in rows(spark, "op7_token_files")}
    assert len(found) == len(table("documents"))
    for d in sorted(table("documents"), key=lambda d: d["doc_id"]):
        ids = np.array([*encode.encode(d["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        expected = {"doc_id": d["doc_id"], "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())}
        assert found[d["doc_id"]] == expected
        start += len(ids)


def test_byte_bpe(spark):
    import public_tokenizers
    import tiktoken

    from tidemark.llm import byte_bpe

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r["doc_id"]: r for r in rows(spark, "op8_byte_bpe")}
    assert len(found) == len(table("documents"))
    for d in table("documents"):
        ids = plain.encode_ordinary(d["text"] or "")
        assert found[d["doc_id"]] == {
            "doc_id": d["doc_id"],
            "n_tokens": len(ids),
            "ids_sha256": hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            "decoded_sha256": hashlib.sha256((d["text"] or "").encode()).hexdigest(),
        }


def test_resharding(spark):
    found = rows(spark, "op10_resharding")
    texts = {d["doc_id"]: (d["text"] or "").encode() for d in table("documents")}
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    sizes, slots, homes = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in found:
        data = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        homes[data].add(r["shard"])
    assert set(sizes) == set(range(8))
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(map(len, texts.values()))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(shards) == 1 for shards in homes.values())


def test_classifier(spark):
    found = {r["doc_id"]: r for r in rows(spark, "op9_quality_classifier")}
    labels = table("labels")
    right = sum(found[x["doc_id"]]["keep"] == (x["quality"] == 1 and x["toxic"] == 0) for x in labels)
    assert len(found) == len(table("documents"))
    assert right >= 0.75 * len(labels)


def test_pipeline(spark):
    import corpus_pipeline

    found = {r["doc_id"]: r for r in rows(spark, "pipeline")}
    texts = {d["doc_id"]: d["text"] for d in table("documents")}
    assert 0 < len(found) <= len(texts)
    assert corpus_pipeline.ORACLE_SQL is None
    kept = {r["doc_id"] for r in rows(spark, "op9_quality_classifier") if r["keep"]}
    assert set(found) <= kept


@pytest.mark.parametrize("name", sorted(n for n in __spark_entry__.queries() if re.match(r"op\d+_|pipeline", n)))
def test_is_registered(name):
    assert callable(__spark_entry__.queries()[name])
