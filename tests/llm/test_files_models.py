import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from newsloom.llm import scoring
from newsloom.llm.gru import GRU
from newsloom.llm.scoring import language_model_scores
from newsloom.llm.tokens import count_tokens, public_encoder, write_token_files
from newsloom.llm.toxicity import _PAD, FILTERS, SIZES, ConvNet, best_bin, buckets, thresholds, toxicity
from newsloom.llm.warc import read_archives, read_split, record, write_archives
from newsloom.session import scratch_path

SF = "/root/testdata/sf0.01"


def test_every_split_reads_every_record_once(tmp_path):
    rng = random.Random(1)
    members = [record(i, f"http://h/{i}", rng.randbytes(rng.randint(0, 300)), 3, i % 4 == 1) for i in range(40)]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(members))
    size = path.stat().st_size
    for step in (1, 7, 100, 1000, size):
        found = [f["x-page-id"] for lo in range(0, size, step) for f, _ in read_split(str(path), lo, min(size, lo + step))]
        assert sorted(map(int, found)) == list(range(40))


def test_a_magic_that_is_no_record_is_passed_over(tmp_path):
    path = tmp_path / "b.warc.gz"
    noise = b"\x1f\x8b\x08" + b"\0" * 20 + zlib.compress(b"x") + b"\x1f\x8b\x08"
    path.write_bytes(noise + record(1, None, b"payload", None, False) + noise)
    assert [b[-7:] for _, b in read_split(str(path), 0, 10_000)] == [b"payload"]


def test_archives_round_trip_with_odd_rows(spark):
    rows = [(1, "u%0D\r\n", "same"), (5, None, "same"), (3, "u", "same"), (5, "v", "same"), (7, "u", None), (8, "u", ""), (None, "u", "same"),
            (None, None, "alone"), (9, "u", "x" * 3_000_000), (10, "u", "Üñ🙂")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    archives = write_archives(pages, scratch_path(spark, "warc"), file_bytes=500)
    got = read_archives(spark, archives, split_bytes=64).collect()
    kinds = sorted((r.page_id or 0, r.url or "", r.record_type, r.refers_to or 0, r.payload_bytes) for r in got)
    first = {"same": 5, "": 8}
    want = []
    for page, url, html in rows:
        other = first.get(html or "")
        revisit = other is not None and page != other
        want.append((page or 0, url or "", "revisit" if revisit else "response", other if revisit else 0, len((html or "").encode())))
    assert kinds == sorted(want)
    assert all(bytes(r.payload).decode() == next(h or "" for p, u, h in rows if (p, u) == (r.page_id, r.url)) for r in got if r.record_type == "response")
    assert read_archives(spark, write_archives(pages.limit(0), scratch_path(spark, "warc"))).count() == 0


def test_token_counts_over_any_blocks(spark, odd_documents):
    made = public_encoder()
    encode = made()
    written = write_token_files(odd_documents, scratch_path(spark, "tokens"), made)
    keys = {(r.path, r.ordinal): r.key for r in written.where("ordinal >= 0").collect()}
    want = Counter((r.doc_id, len(encode(r.text or ""))) for r in odd_documents.collect())
    for block in (1000, 4096, 1 << 22):
        files = written.where("ordinal < 0").select("path", "bytes")
        got = Counter((keys[(r.path, r.ordinal)], r.n_tokens) for r in count_tokens(spark, files, block_tokens=block).collect())
        assert got == want
    assert write_token_files(odd_documents.limit(0), scratch_path(spark, "tokens"), made).where("ordinal >= 0").count() == 0


def test_files_are_read_by_as_many_tasks_as_they_have_splits(spark, odd_documents):
    pages = spark.range(40).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.expr("cast(rand(1) as string)").alias("html"))
    archives = write_archives(pages, scratch_path(spark, "warc"))
    size = archives.agg(F.sum("bytes")).first()[0]
    files = write_token_files(odd_documents, scratch_path(spark, "tokens"), public_encoder()).where("ordinal < 0").select("path", "bytes")
    tokens = files.agg(F.sum(F.ceil(F.col("bytes") / 2 / 1000))).first()[0]
    for found, splits in ((read_archives(spark, archives, split_bytes=200), size // 200), (count_tokens(spark, files, block_tokens=1000), tokens)):
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_NUM" in plan and splits > 20
        dealt = [int(n) for n in re.findall(r"hashpartitioning\(path#\d+, start#\d+L?, (\d+)\), REPARTITION_BY_NUM", plan)]
        assert dealt and min(dealt) >= splits


def test_gru_gradients_and_carried_state():
    net = GRU(40, 3, 0, hidden=5, seed=2)
    for p in net.parts[:3]:
        p *= 3
    rng = np.random.default_rng(4)
    tokens, targets = rng.integers(0, 43, (6, 4)), rng.integers(0, 43, (6, 4))
    h0 = rng.normal(0, 0.5, (4, 5)).astype(np.float32)
    grads, _, _ = net._gradients(tokens, targets, h0)
    for p, g in zip(net.parts, grads, strict=True):
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in p.shape)
            if p[at] < -1e3:
                continue
            old, eps = p[at], 1e-2
            p[at] = old + eps
            up = net._gradients(tokens, targets, h0)[2]
            p[at] = old - eps
            down = net._gradients(tokens, targets, h0)[2]
            p[at] = old
            assert abs((up - down) / (2 * eps) - g[at]) < 2e-3
    texts = [rng.integers(0, 43, n) for n in (1, 150, 7, 150, 64)]
    assert np.allclose(net.score(texts, window=64), [net.score([t], window=1000)[0] for t in texts], atol=1e-3)
    # All next tokens together have probability one.
    h = np.repeat(rng.normal(0, 1, (1, 5)).astype(np.float32), 43, axis=0)
    assert abs(np.exp(net.log_probability(h, np.arange(43))).sum() - 1) < 1e-4


def crc(key):
    return zlib.crc32(str(key).encode()) % 5


def test_scores_against_plain_counts(spark, documents, odd_documents, monkeypatch):
    monkeypatch.setattr(scoring, "FREQUENT", 60)
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("The the a of Und und x%d" .split()) if j % 3 else f"x{rng.randint(0, 400)}" for j in range(rng.randint(1, 60))), "en", "s") for i in range(200)]
    got = language_model_scores(documents(rows), sample=100).collect()
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) + [None]
    counts = Counter(w for i, t, *_ in rows if crc(i) != 1 for w in words(t))
    n, v, texts = sum(counts.values()), len(counts), {r[0]: r[1] for r in rows}
    for r in got:
        own = words(texts[r.doc_id])
        assert r.held_out == (crc(r.doc_id) == 1) and r.train_tokens == n and r.n_tokens == len(own)
        assert r.n_known == sum(counts[w] > 0 for w in own)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), rel_tol=1e-9)
        assert math.isfinite(r.score) and r.score < 0
    assert language_model_scores(odd_documents, sample=5).where("score IS NULL").count() == 0
    assert language_model_scores(odd_documents.limit(0)).count() == 0


def test_model_beats_the_base_on_held_out_texts(spark):
    got = language_model_scores(spark.read.parquet(f"{SF}/documents.parquet"), sample=600).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got) + 0.1 * sum(r.n_tokens for r in got)


def test_a_round_in_tasks_is_the_average_of_their_steps(spark, documents):
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choice(["the", "a", "of", "und", "x1"]) for _ in range(rng.randint(20, 90))), "en", "s") for i in range(40)]
    docs = documents(rows)
    counts = scoring.token_counts(docs, "text")
    model = scoring.train(spark, counts, docs.limit(0), "doc_id", "text")
    together = docs.repartition(3, "doc_id").sortWithinPartitions("doc_id")
    placed = together.select("text", F.spark_partition_id().alias("part")).collect()
    before, parts = [p.copy() for p in model.net.parts], [[r.text for r in placed if r.part == k] for k in range(3)]
    steps, sizes = [], []
    for part in parts:
        net = GRU(model.net.n_words, model.net.n_single, model.net.begin)
        for p, b in zip(net.parts, before, strict=True):
            p[:] = b
        ids = []
        for value, shape, bounds in scoring.tokens(pa.array(part)):
            ids += [model.ids(value, shape).astype(np.int32)[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        sizes.append(sum(map(len, ids)))
        net.fit(ids, epochs=1, streams=int(np.clip(sizes[-1] // 128, 1, 64)), rate=scoring.RATE)
        steps.append([p - b for p, b in zip(net.parts, before, strict=True)])
    scoring.learn_in_tasks(model, together, "text")
    for k, (p, b) in enumerate(zip(model.net.parts, before, strict=True)):
        want = b + sum(s[k] * n for s, n in zip(steps, sizes, strict=True)) / sum(sizes)
        assert np.abs(p - want).max() < 1e-4, (k, np.abs(p - want).max(), np.abs(want - b).max(), np.abs(p - b).max())
    assert not np.allclose(model.net.recurrent, before[1], atol=1e-4)


def test_scores_are_those_of_the_model_word_by_word(spark, documents):
    rng = random.Random(13)
    rows = [(i, " ".join(f"w{min(rng.randint(0, 60), rng.randint(0, 60))}" for _ in range(rng.randint(1, 100))), "en", "s") for i in range(120)]
    docs = documents(rows)
    counts = scoring.token_counts(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 1"), "text")
    model = scoring.train(spark, counts, docs.where("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 1"), "doc_id", "text")
    known = {r.token: r.n for r in counts.collect()}
    got = {r.doc_id: r.score for r in language_model_scores(docs).collect()}
    for i, text, *_ in rows[:25]:
        (hashed, shape, _), = scoring.tokens(pa.array([text]))
        h, before, total = np.zeros((1, model.net.hidden), np.float32), model.net.begin, 0.0
        for token, own, kind in zip(hashed.view(np.int64), model.ids(hashed, shape), shape, strict=True):
            h = model.net.step(np.array([before]), h)[0]
            total += float(model.net.log_probability(h, np.array([own]))[0]) / math.log(10)
            if own >= model.n_words:
                total += math.log10(known.get(int(token), 0) + 0.5) - float(model.shape_log[kind])
            before = own
        assert math.isclose(got[i], total, rel_tol=1e-3)


def test_net_learns_rare_words_and_gradients():
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 500, rng.integers(5, 80))) for _ in range(600)]
    y = (rng.random(600) < 0.3).astype(np.float32)
    texts = [t + " awful thing" if label else t for t, label in zip(texts, y, strict=True)]
    own = [out[s:s + n + _PAD] for out, start, size in buckets(pa.array(texts)) for s, n in zip(start, size, strict=True)]
    net = ConvNet().fit(own[:400], y[:400])
    held = [net.logits(t, np.array([0]), np.array([len(t) - _PAD]))[0] for t in own[400:]]
    assert ((np.array(held) > 0) == y[400:]).mean() > 0.97
    net = ConvNet(seed=3)
    grads = net._gradients(own[:8], y[:8])
    loss = lambda: np.mean([np.log1p(np.exp(-(2 * a - 1) * net.logits(t, np.array([0]), np.array([len(t) - _PAD]))[0])) for t, a in zip(own[:8], y[:8], strict=True)])
    for p, g in ((net.out, grads[-2]), (net.filters[1], grads[2]), (net.shift, grads[-1])):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old, eps = p[at], 1e-3
        p[at] = old + eps
        up = loss()
        p[at] = old - eps
        down = loss()
        p[at] = old
        assert abs((up - down) / (2 * eps) - g[at]) < 0.1 * abs(g[at]) + 1e-4


def test_toxicity_rows(spark, documents, odd_documents):
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randint(0, 300)}" for _ in range(20)) + (" Awful! awfulness" if i % 3 == 0 else ""), ["en", "de", None][i % 3], "s") for i in range(600)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(600)] + [(None, 1, 1), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    got = toxicity(documents(rows), labels).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(600) if crc(i) == 0}
    assert sum(r.predicted == (r.doc_id % 3 == 0) for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    odd = toxicity(odd_documents, labels)
    assert odd.count() == odd_documents.count() and odd.where("score IS NULL OR predicted IS NULL OR flagged IS NULL").count() == 0
    assert toxicity(odd_documents, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity(odd_documents.limit(0), labels).count() == 0


def test_best_bin_is_that_of_the_highest_f1():
    rng = np.random.default_rng(2)
    for _ in range(50):
        ones, zeros = rng.integers(0, 4, 12), rng.integers(0, 6, 12)
        if ones.sum():
            f1 = [2 * ones[k:].sum() / ((ones + zeros)[k:].sum() + ones.sum()) for k in range(12)]
            assert best_bin(ones, zeros) == max(range(12), key=lambda k: (f1[k], k))


def test_pooled_responses_are_those_of_plain_loops():
    rng = np.random.default_rng(8)
    net = ConvNet(seed=4)
    net.bias = [rng.normal(size=FILTERS).astype(np.float32) for _ in SIZES]
    texts = ["one two three four", "", "alone", "a b", " ".join(f"w{i}" for i in range(40))]
    (ids, start, size), = buckets(pa.array(texts))
    got = net.pooled(ids, start, size)
    for i, n in enumerate(size):
        x = [net.embedding[w[0]] + net.embedding[w[1]] for w in ids[start[i]:start[i] + n + _PAD]]
        want = []
        for w, b in zip(net.filters, net.bias, strict=True):
            for f in range(FILTERS):
                sums = [float(b[f]) + sum(float(x[at + k] @ w[k][:, f]) for k in range(len(w))) for at in range(max(n, 1)) if at + len(w) <= len(x)]
                want.append(max(sums) if max(sums) > 0 else 0.1 * max(sums))
        assert np.allclose(got[i], want, atol=1e-5)
        assert np.isclose(net.logits(ids, start, size)[i], np.dot(want, net.out) + net.shift[0], atol=1e-5)


def test_thresholds_come_from_all_rows_outside_of_the_sample(spark):
    rng = random.Random(9)
    rows = [(lang, rng.gauss(centre if label else 0, 1), label) for lang, centre, n in (("en", 4, 300), ("es", 2, 40), ("fr", 3, 6))
            for label in (0, 1) for _ in range(n)] + [("", rng.gauss(0, 1), 0) for _ in range(50)]
    net = ConvNet()
    limits = thresholds(net, spark.createDataFrame(rows, "lang string, logit double, label int"))
    assert set(limits) == {"", "en", "es"}  # French has too few toxic rows
    a, b = net.scale
    for lang, limit in limits.items():
        own = [(1 / (1 + math.exp(-(a * x + b))), y) for at, x, y in rows if lang in ("", at)]
        f1 = lambda t: 2 * sum(y for s, y in own if s >= t) / (sum(s >= t for s, _ in own) + sum(y for _, y in own))
        assert f1(limit) >= max(f1(s) for s, _ in own) - 0.01
