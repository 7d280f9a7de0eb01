"""Byte-level BPE against the tokenizer library, and its parts against plain loops."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from newsloom.llm import bpe
from newsloom.llm.all_queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def own():
    return bpe.public_vocabulary()


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(encoder, texts):
    out = []
    for lo, hi, data, offsets in bpe.pieces(pa.array(texts), 1 << 12):
        ids, _, bounds = encoder.encode(data, offsets)
        out += [ids[bounds[i]:bounds[i + 1]].tolist() for i in range(hi - lo)]
    return out


def test_scan_is_the_composition_in_order():
    found = bpe.automaton()
    rng, size = np.random.default_rng(1), len(found.state)
    for n in (0, 1, 63, 64, 65, 5000):
        functions = found.of_kind[rng.integers(0, len(found.of_kind), n)]
        got, own = bpe.scan(functions, found.compose), 0
        for i in range(n):
            own = int(found.compose[own * size + functions[i]])
            assert got[i] == own


def test_ids_are_those_of_the_library(own, library):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "'", "'s", "'re", "'ve", "'ll", "'t", "'d", "'m", "'S", "a", "re", "s", "ll", "1", "23", "!", "?", "é", "漢", "٣",
             "\xa0", "　", "🙂", "\x1c", "\x85", "A", "́", "Ᲊ", ".", "<|endoftext|>", "\0"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(20_000)]
    texts += ["", "x" * 3000 + "ab" * 700, " " * 2000 + "a", "é" * 900, "the " * 3000]
    assert ids_of(bpe.Encoder(own, bpe.automaton()), texts) == library.encode_ordinary_batch(texts)


def test_long_slices_and_a_full_cache_change_nothing(own, library, monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeint", k=rng.randint(1, 60))) for _ in range(3000)]
    texts = [" ".join(words[i:i + 10]) for i in range(0, 3000, 10)]
    want = library.encode_ordinary_batch(texts)
    monkeypatch.setattr(bpe, "CACHED", 50)
    for long in (4, 30):
        monkeypatch.setattr(bpe, "LONG", long)
        assert ids_of(bpe.Encoder(own, bpe.automaton()), texts) == want


def test_round_trip_of_odd_rows(spark, odd_documents, own, library):
    docs = odd_documents.withColumnRenamed("lang", "ids").withColumnRenamed("source", "ends")
    got = bpe.decode(bpe.encode(docs, own), own).collect()
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.bytes).decode()) for r in got) == Counter(
        (r.doc_id, tuple(library.encode_ordinary(r.text or "")), r.text or "") for r in docs.collect())
    for r in got:
        assert [bytes(r.bytes)[a:b] for a, b in zip([0, *r.ends], r.ends, strict=False)] == [library.decode_single_token_bytes(i) for i in r.ids]
    assert bpe.decode(bpe.encode(docs.limit(0), own), own).count() == 0


def test_bytes_that_are_no_utf8_become_replacement_characters(spark, own, library):
    docs = spark.sql("select 1L as doc_id, cast(x'61ff20c362' as string) as text")
    assert bpe.encode(docs, own).first().ids == library.encode_ordinary(b"a\xff \xc3b".decode("utf-8", "replace"))


def test_query(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op12_byte_bpe"](spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d.text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert tuple(got[d.doc_id]) == (d.doc_id, len(ids), digest, hashlib.sha256((d.text or "").encode()).hexdigest())
