from newsloom.llm import mixing
from newsloom.llm.mixing import leaf_budgets, mix
from newsloom.llm.quality import judge, keep_good
from pyspark.sql import functions as F

GOOD = " ".join(f"word{i}" for i in range(40))


def test_repeated_words_and_lines(documents):
    run = "one two three four five six"
    rows = [(1, f"{run} x {run} " + GOOD, "en", "s"), (2, "a a a a a a a a a a", "en", "s"), (3, "l1\nl1\n \n \nl2", "en", "s")]
    got = {r.doc_id: r for r in judge(documents(rows)).collect()}
    assert got[1].n_repeat_words == 12 and got[1].n_words == 53
    assert got[2].n_repeat_words == 10 and got[2].base_failed and not got[2].kept
    assert got[3].n_dup_lines == 1 and got[3].n_words == 3


def test_hosts(documents):
    bad = GOOD + " ######"  # one rule of several fails
    rows = [(i, bad, "en", "bad") for i in range(200)] + [(1000 + i, GOOD, "en", "good") for i in range(200)]
    rows += [(2000, bad, "en", "good"), (2001, GOOD, "en", "bad"), (2002, bad, "en", "tiny"), (2003, GOOD, "en", None)]
    kept = {r.doc_id for r in keep_good(documents(rows)).collect()}
    assert not kept & set(range(200)) and set(range(1000, 1200)) <= kept
    # One odd document on a good host, and clean ones on a bad or nameless host, stay.
    assert {2000, 2001, 2003} <= kept


def test_quality_odd_rows(odd_documents):
    df = odd_documents.withColumns({"n_words": F.lit(1), "symbols": F.lit(2), "_host": F.lit(3), "kept": F.lit(4)})
    got = keep_good(df)
    assert got.columns == df.columns
    assert {(r.doc_id, r.source) for r in got.collect()} <= {(1, "src1"), (1, "src2"), (None, None), (5, "src1"), (6, "src1")}
    assert judge(odd_documents).count() == odd_documents.count() and keep_good(df.limit(0)).count() == 0


def filled(budget, children):
    """Water filling by steps: {name: (weight, capacity)} -> {name: budget}."""
    out, open_ = dict.fromkeys(children, 0.0), dict(children)
    while open_ and budget > 1e-9:
        weights = sum(w for w, _ in open_.values())
        share = {k: budget * w / weights for k, (w, _) in open_.items()}
        full = [k for k, (_, c) in open_.items() if share[k] >= c]
        if not full:
            out |= share
            break
        for k in full:
            out[k] = open_.pop(k)[1]
            budget -= out[k]
    return out


def test_budgets_follow_weights_and_shortages(spark):
    leaves = [("domain1", "en", "a1", 1000), ("domain1", "de", "b1", 10), ("domain1", "de", "c1", 4000), ("domain2", "en", "a2", 50)]
    got = {r.source: r.budget for r in leaf_budgets(spark.createDataFrame(leaves, "domain string, lang string, source string, tokens bigint"), 60, 2).collect()}
    top = filled(3036, {"1": (1, 10020), "2": (1, 100)})
    assert got["a2"] == top["2"] == 100
    langs = filled(top["1"], {"en": (4, 2000), "de": (2, 8020)})
    low = filled(langs["de"], {"b1": (1, 20), "c1": (1, 8000)})
    assert abs(got["a1"] - langs["en"]) <= 2 and got["b1"] == low["b1"] == 20 and abs(got["c1"] - low["c1"]) <= 4


def test_mix_prefixes_and_epochs(documents):
    rows = [(i, GOOD, "en", "big1") for i in range(300)] + [(1000 + i, GOOD, "en", "low2") for i in range(20)]
    got = mix(documents(rows)).collect()
    low = [r for r in got if r.source == "low2"]
    assert len(low) == 80 and {r.mix_epoch for r in low} == {0, 1, 2, 3}  # its capacity
    big = [r for r in got if r.source == "big1"]
    assert len(big) == int(320 * 40 * 0.6 - 80 * 40) // 40 and len({r.doc_id for r in big}) == len(big)
    assert got == mix(documents(rows)).collect() or sorted(got) == sorted(mix(documents(rows)).collect())


def test_mix_odd_rows(odd_documents, monkeypatch):
    df = odd_documents.withColumns({"domain": F.lit("q"), "tokens": F.lit(1), "_cell": F.lit(2), "full": F.lit(0)})
    got = mix(df)
    assert got.columns == [*df.columns, "mix_domain", "mix_tokens", "mix_epoch"]
    rows = got.collect()
    budget = sum(len((r.text or "").split()) for r in df.collect()) * 0.6
    assert rows and sum(r.mix_tokens for r in rows) <= budget and all(r.mix_tokens > 0 for r in rows)
    assert mix(df.limit(0)).count() == 0
    # With one cell for everything the same documents are chosen.
    monkeypatch.setattr(mixing, "CELL_DIGITS", 1)
    key = lambda r: (str(r.doc_id), str(r.source), r.mix_epoch, r.mix_tokens)
    assert sorted(map(key, mix(df).collect())) == sorted(map(key, rows))
