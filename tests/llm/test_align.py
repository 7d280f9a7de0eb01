"""Cross-tokenizer alignment against the tokenizer libraries and a plain form of its definition."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from newsloom.llm import align as al
from newsloom.llm.all_queries import QUERIES
from newsloom.llm.bpe import Encoder, automaton, pieces
from newsloom.session import stage
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pair():
    return al.public_pair()


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path(al.A_VOCABULARY))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(al.B_VOCABULARY))


def odd_texts(n, seed=5):
    rng = random.Random(seed)
    parts = [" ", "  ", "   ", "\n", "\t", "'", "'s", "'re", "a", "re", "word", " the", " of", "1", "23", "!", "é", "漢", "٣", "\xa0", "　", "🙂", "\x1c", "\x85",
             "ﬁ", "ｆ", "A", "́", "Ᲊ", ".", "<s>", "</s>", "<unk>", "<0x41>", "<|endoftext|>", "▁", "​", "\0"]
    return ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(n)]


def encoded(encoder, texts):
    out = []
    for lo, hi, data, offsets in pieces(pa.array(texts), 1 << 12):
        found = encoder.encode(data, offsets)
        ids, bounds = found[0], found[-1]
        out += [ids[bounds[i]:bounds[i + 1]].tolist() for i in range(hi - lo)]
    return out


def test_ids_are_those_of_the_libraries(pair, libraries):
    texts = odd_texts(20_000) + ["x" * 2000, "the " * 500]
    a, b = libraries
    full = [" " + t for t in texts]
    assert encoded(Encoder(pair[0], automaton()), full) == [e.ids for e in a.encode_batch(full, add_special_tokens=False)]
    texts = [t for t in texts if "▁" not in t]  # the model's own sign for a blank: such a text never comes back as it was
    assert encoded(al.Pieces(pair[1]), [" " + t for t in texts]) == b.encode(texts)


def test_class_of_every_character_is_that_of_the_library(pair, libraries):
    letters = [c for c in range(33, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f" a{chr(c)}a 1{chr(c)}1 !{chr(c)}!  {chr(c)}" for c in letters]
    assert encoded(Encoder(pair[0], automaton()), texts) == [e.ids for e in libraries[0].encode_batch(texts, add_special_tokens=False)]


def plain(texts, libraries):
    """The report of the contract, token by token."""
    a, b = libraries
    vocab = {i: t for t, i in a.get_vocab().items()}
    chars = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(c): c for c in chars} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in chars)}
    rows = []
    for text in texts:
        x = y = []
        if text:
            x = [(i, bytes(byte_of[c] for c in vocab[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
            y = []
            for i in b.encode(text):
                p = b.id_to_piece(i)
                y.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
            full = (" " + text).encode()
            if b"".join(p for _, p in x) != full or b"".join(p for _, p in y) != full:
                x = y = []
        spans = []
        for side in (x, y):
            at, own = 0, []
            for i, p in side:
                own.append((at, at + len(p), i))
                at += len(p)
            spans.append(own)
        links = [(i, j) for s, e, i in spans[0] for t, f, j in spans[1] if s < f and t < e]
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, lo = [], 0
        for hi in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in side if lo <= s and e <= hi) for side in spans))
            lo = hi
        rows.append((len(x), len(y), groups, links))
    counts = Counter(p for r in rows for p in set(r[3]))
    top = {}
    for (i, _), n in counts.items():
        top[i] = max(top.get(i, 0), n)
    return [(n_a, n_b, len(groups), len(links), sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for n_a, n_b, groups, links in rows], rows


@pytest.mark.parametrize("frequent", [0, 40, 1 << 20])
def test_report_is_that_of_the_definition(spark, pair, libraries, frequent, documents):
    texts = [t[:400] for t in odd_texts(150, 8)] + ["", None, "same text here", "same text here", " ", "\n"]
    docs = documents([(i % 151, t, "en", "s") for i, t in enumerate(texts)], extra=["a", "b", "row", "n_best"])
    tokens = stage(al.tokenise(docs, *pair), "tokens")
    got = al.alignment_report(tokens, *pair, frequent=frequent).collect()
    want, rows = plain(texts, libraries)
    assert Counter(tuple(r) for r in got) == Counter((i % 151, *w) for i, w in enumerate(want))
    groups = Counter((r.doc_id, ";".join(",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in r.groups))
                     for r in al.aligned(tokens, *pair).collect())
    assert groups == Counter((i % 151, ";".join(r[2])) for i, r in enumerate(rows))


def test_odd_rows(spark, pair, odd_documents):
    got = al.alignment_report(stage(al.tokenise(odd_documents, *pair), "tokens"), *pair).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in odd_documents.collect())
    assert {tuple(r)[1:] for r in got if r.doc_id in (2, 3)} == {(0, 0, 0, 0, 0, 0, "")}
    long = [tuple(r)[1:] for r in got if r.doc_id in (5, 6)]
    assert long[0] == long[1] and long[0][0] > 30_000
    assert al.alignment_report(stage(al.tokenise(odd_documents.limit(0), *pair), "tokens"), *pair).count() == 0


def test_long_chains_converge():
    # Tokens of 2 and of 3 bytes, the latter shifted: one group from the first byte to the last.
    end_a, end_b = np.arange(2, 60_002, 2), np.concatenate([[1], np.arange(4, 60_000, 3), [60_000]])
    a, b = (al.Side(np.zeros(len(e), np.int32), np.array([0, len(e)]), e) for e in (end_a, end_b))
    found, cuts = al.align(a, b), sorted(set(end_a.tolist()) & set(end_b.tolist()))
    assert found.group_a.tolist() == np.searchsorted(cuts, end_a).tolist() and found.group_b.tolist() == np.searchsorted(cuts, end_b).tolist()
    assert len(found.link_a) == len(set(end_a.tolist()) | set(end_b.tolist()))


def test_query(spark, libraries):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(10_000).collect()
    short = [d.text if len(d.text or "") < 4000 else None for d in docs]
    want, _ = plain(short, libraries)
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_align_tokenizers"](spark, SF).collect()}
    assert len(got) == len(docs)
    for d, text, w in zip(docs, short, want, strict=True):
        if text is not None:  # counts are over all documents, so only the other columns can be compared here
            assert got[d.doc_id][1:5] == w[:4] and got[d.doc_id][7] == w[6]
