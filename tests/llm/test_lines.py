import random

from newsloom.llm.lines import one_word_apart, without_repeated_lines
from pyspark.sql import functions as F


def apart(a, b):
    """Edit distance of word lists, by the table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_one_word_apart():
    rng = random.Random(2)
    for _ in range(3000):
        a = [rng.choice("abc") for _ in range(rng.randint(1, 8))]
        b = [rng.choice("abc") for _ in range(rng.randint(1, 8))]
        assert one_word_apart(" ".join(a), "\t".join(b)) == (apart(a, b) <= 1)


def brute(docs, least):
    """Texts left, by comparing every line with every earlier one."""
    earlier, out = [], {}
    for key in sorted(docs):
        kept, lines = [], docs[key].split("\n")
        for line in lines:
            w = line.encode().split()
            near = [e for e in earlier if e == w or (min(len(e), len(w)) >= least and apart(w, e) <= 1)]
            if w:
                earlier.append(w)
            if not near:
                kept.append(line)
        if len(kept) == len(lines) or any(x.split() for x in kept):
            out[key] = "\n".join(kept)
    return out


def test_against_brute_force(documents):
    rng = random.Random(4)
    pool = [[rng.choice(["one", "two", "six", "ten"]) for _ in range(rng.randint(3, 7))] for _ in range(40)]
    docs = {}
    for key in range(60):
        lines = []
        for _ in range(rng.randint(0, 4)):
            line = rng.choice(pool).copy()
            if rng.random() < 0.5:
                at = rng.randrange(len(line))
                line[at:at + rng.randint(0, 1)] = [f"x{rng.randint(0, 3)}"] * rng.randint(0, 1)
            lines.append((" " * rng.randint(0, 2)).join(["", *line]) if rng.random() < 0.1 else " ".join(line))
        docs[key] = "\n".join(lines) + rng.choice(["", "\n"])
    got = without_repeated_lines(documents([(k, t, "en", "s") for k, t in docs.items()]), min_words=4)
    assert {r.doc_id: r.text for r in got.collect()} == brute(docs, 4)


def test_odd_rows_and_columns(odd_documents):
    df = odd_documents.withColumns({"key": F.lit(1), "place": F.lit(2), "cut": F.lit("y"), "c1": F.lit(3)})
    got = without_repeated_lines(df)
    assert got.columns == df.columns
    texts = sorted((r.doc_id is None, r.doc_id or 0, r.text is None, r.text or "") for r in got.collect())
    # The long line comes again in document 6, which has nothing else; repeated rows of document 1 are one document.
    assert len(texts) == df.count() - 1 and not any(t[1] == 6 for t in texts)
    assert without_repeated_lines(df.limit(0)).count() == 0


def test_short_lines_go_as_exact_copies(documents):
    import corpus_pipeline

    long = "a line of ten words or more that says quite something"
    rows = [(1, f"Share this\n{long}\nx"), (2, f"first\n Share  this\nx\n\nShare that"), (3, "Share this\nx"), (4, "x y\nsecond\nx y"),
            (5, f"{long} today\nthird")]
    got = corpus_pipeline.line_dedup(documents([]).sparkSession, documents([(*r, "en", "s") for r in rows]), "")
    assert {r.doc_id: (r.text, r.n_chars) for r in got.collect()} == {
        k: (t, len(t)) for k, t in {1: f"Share this\n{long}\nx", 2: "first\n\nShare that", 4: "x y\nsecond", 5: "third"}.items()}
