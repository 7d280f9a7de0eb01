import random
import re
from collections import Counter

from newsloom.llm.decontaminate import contamination, without_leaks
from newsloom.llm.pii import Detector, base_spans, personal_data, redacted
from pyspark.sql import functions as F

PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN:
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(d[::-1])) % 10 == 0
            if {"ip": lambda m=m: max(map(int, m[0].split("."))) <= 255, "card": lambda d=d, luhn=luhn: 16 <= len(d) <= 19 and luhn,
                    "phone": lambda d=d: 8 <= len(d) <= 15}.get(kind, lambda: True)():
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(5)
    for letters in ("a.@1 +-()@@9.2255%b0 1234 ", "0123456789 -", "ab@.-", "+1 (2)."):
        for _ in range(4000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
            assert base_spans(text) == plain_spans(text), text


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1.2" * 100_000, "+1" * 100_000, "@a" * 100_000, "1 " * 100_000):
        base_spans(text)


def test_detector_adds_disguised_and_leaves_plain():
    rng = random.Random(1)
    texts = []
    for i in range(300):
        phone = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        texts.append(f"some words about nothing {rng.choice([phone, f'{i}.name@mail{i % 9}.example.com', f'{rng.randint(10**15, 10**16 - 1)}'])} and then more words")
    detector = Detector(texts)
    hidden = "write to jane.doe (at) mail3 dot example dot com soon"
    assert [hidden[s:e] for _, s, e in detector.added(hidden, [])] == ["jane.doe (at) mail3 dot example dot com"]
    for clean in ("the meeting is at noon on 2024-05-06", "version 10.20.300.4 came out", "we sold 1234567 units"):
        assert detector.added(clean, base_spans(clean)) == []


def test_personal_data_rows(documents, odd_documents):
    text = "Üb 🙂 me@example.com or +1 (234) 555-6789, 10.0.0.1"
    got = {r.doc_id: r for r in personal_data(documents([(1, text, "en", "s"), (2, "nothing", "en", "s")])).collect()}
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone) == (1, 1, 0, 1)
    assert redacted(text, got[1].spans) == "Üb 🙂 [email] or [phone], [ip]" and got[2].spans == ""
    assert personal_data(odd_documents).count() == odd_documents.count() and personal_data(odd_documents.limit(0)).count() == 0


def shingles(text):
    w = [x for x in re.split(r"[\x09-\x0d !-/:-@\[-`{-~]+", text.lower()) if x]
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def best(doc, item):
    x, y = ([w for w in re.split(r"[\x09-\x0d !-/:-@\[-`{-~]+", t.lower()) if w] for t in (doc, item))
    if 0 < len(y) < 5:
        return float(any(x[p:p + len(y)] == y for p in range(len(x) - len(y) + 1)))
    s, c = shingles(doc), Counter(shingles(item))
    m, n = sum(c.values()), min(sum(c.values()), len(s))
    if not n or not m:
        return 0.0
    shared = [sum((Counter(s[p:p + n]) & c).values()) for p in range(len(s) - n + 1)]
    return max(x / (n + m - x) for x in shared)


def test_contamination_against_brute_force(spark, documents):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(12, 60)))) for i in range(30)] + [(90, "yes no"), (91, None), (92, ""), (93, "no"), (94, "Yes. No!"), (95, "w1 w2 w3 w4")]
    docs = []
    for i in range(150):
        item = rng.choice(items[:30])[1].split()
        for _ in range(rng.randint(0, 2)):
            item[rng.randrange(len(item))] = rng.choice(words)
        filler = [rng.choice(words) for _ in range(rng.randint(0, 200))]
        at = rng.randint(0, len(filler))
        docs.append((i, " ".join(filler[:at] + ([w.upper() + "," for w in item] if i % 3 else []) + filler[at:])))
    docs += [(499, " ".join(f"w{i}" for i in range(300)) + " yes no maybe"), (500, "Yes, no!"), (501, "yes no maybe"), (502, None), (503, "")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: r.contamination for r in contamination(documents([(*d, "en", "s") for d in docs]), bench).collect()}
    missed = found = 0
    for key, text in docs:
        want = {i: b for i, t in items if (b := best(text or "", t or "")) >= 0.8}
        assert set(got[key]["items"]) <= set(want)
        found += len(want)
        missed += len(set(want) - set(got[key]["items"]))
    assert found > 30 and missed <= 0.01 * found
    assert list(got[500]["items"]) == [90, 93, 94] == list(got[501]["items"]) and not got[502]["items"]
    assert list(got[499]["items"]) == [90, 93, 94, 95]


def test_leaks_odd_rows(spark, odd_documents):
    bench = spark.createDataFrame([(None, "a"), (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu")], "item_id bigint, text string")
    df = odd_documents.withColumns({"contamination": F.lit(1), "_pass0": F.lit(2)})
    got = without_leaks(df, bench)
    assert got.columns == df.columns and got.count() == df.count() - 2
    assert without_leaks(df, bench.limit(0)).count() == df.count() and without_leaks(df.limit(0), bench).count() == 0
