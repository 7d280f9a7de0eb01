"""Host-level quality rules (operator 1), in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.barrier import let, with_computed
from newsloom.llm.registry import query, table
from newsloom.session import stage

SEPARATORS = " \t\n\x0b\f\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
#: A rule counts against a host when more than this share of its documents should be expected to fail it.
HOST_LIMIT = 0.5
#: So many failed rules reject a document on any host.
DOCUMENT_LIMIT = 2
#: Hosts (some 100 bytes each) up to this number are broadcast, more are joined by shuffle.
MAX_BROADCAST_HOSTS = 100_000
#: A document fails a rule where its expression is true; integers only, so any engine agrees.
RULES = {
    "symbols": "10 * n_symbols > n_words",
    "many_symbols": "10 * n_symbols > 3 * n_words",
    "word_length": "word_chars < 3 * n_words OR word_chars > 12 * n_words",
    "lines": "n_dup_lines > 2 AND 10 * n_dup_lines > 3 * n_lines",
    "repeats": "100 * n_repeat_words > 10 * n_words",
}


def words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SEPARATORS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_BREAK))


def repeated_words(tokens: Column, width: int = WINDOW) -> Column:
    """How many words lie in a run of `width` words that occurs twice or more.

    Hashed windows are sorted, so equal ones become neighbours; the places of repeated windows, in
    order, cover `width` words each, less where they overlap. Linear but for the sort.
    """
    def places(sorted_):
        same = lambda e, j: (
            ((j > 0) & (F.get(sorted_, j - 1)["h"] == e["h"]))
            | F.coalesce(F.get(sorted_, j + 1)["h"] == e["h"], F.lit(False)))
        return F.sort_array(F.filter(F.transform(sorted_, lambda e, j: F.when(same(e, j), e["i"])), lambda i: i.isNotNull()))

    def covered(at):
        step = lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(width), i - s["last"])).alias("n"))
        return F.aggregate(at, F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n")), step, lambda s: s["n"])

    def total(hashes):
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered(let(pairs, places)))

    windows = F.transform(F.sequence(F.lit(1), F.size(tokens) - (width - 1)), lambda i: F.xxhash64(F.slice(tokens, i, width)))
    return F.when(F.size(tokens) > width, let(windows, total)).otherwise(F.lit(0))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (bigint)."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(SEPARATORS)) != "")
    by_line = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")))
    by_word = let(words(F.col(text)), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("repeat")))
    made = with_computed(docs, _words=by_word, _lines=by_line)
    without = lambda c: F.length(F.translate(body, c, ""))
    return made.select(
        *docs.columns,
        *[c.cast("bigint").alias(n) for n, c in {
            "n_words": F.col("_words.n"), "word_chars": without(SEPARATORS), "n_symbols": F.length(body) - without(SYMBOLS),
            "n_lines": F.col("_lines.n"), "n_dup_lines": F.col("_lines.n") - F.col("_lines.distinct"),
            "n_repeat_words": F.col("_words.repeat")}.items()])


def host_rates(failed: DataFrame, host: str) -> DataFrame:
    """(host, n_docs, <rule>_rate): the rate at which a host's documents fail each rule, shrunk.

    A beta prior per rule is fitted to all hosts by moments: its mean is the pooled rate m, and the
    spread of the rates beyond what chance gives within hosts (n documents each) sets its weight w.
    The rate is then (failures + w m) / (documents + w): small hosts stay near the mean.
    """
    hosts = stage(
        failed.groupBy(host).agg(F.count("*").alias("n_docs"), *[F.sum(F.col(r).cast("bigint")).alias(r) for r in RULES]), "hosts")
    n, total = F.col("n_docs").cast("double"), F.sum("n_docs").cast("double")
    free = F.count("*") - 1
    priors = []
    for r in RULES:
        mean = F.sum(r) / total
        spread = F.sum(F.col(r) * F.col(r) / n) - total * mean * mean
        room = total - F.sum(n * n) / total - free
        rho = F.try_divide(F.try_divide(spread, mean * (1 - mean)) - free, room)
        rho = F.least(F.greatest(F.coalesce(rho, F.lit(0.01)), F.lit(0.0001)), F.lit(0.5))
        priors.append(F.struct(mean.alias("mean"), (1 / rho - 1).alias("weight")).alias(r))
    prior = hosts.agg(F.struct(*priors).alias("p")).scalar()
    return hosts.withColumn("_prior", prior).select(
        host, "n_docs",
        *[((F.col(r) + F.col(f"_prior.{r}.weight") * F.col(f"_prior.{r}.mean")) / (F.col("n_docs") + F.col(f"_prior.{r}.weight"))).alias(f"{r}_rate") for r in RULES])


def judge(docs: DataFrame, host: str = "source", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """`docs` (all columns, or the host and those of `carry`) with counts, base_failed, n_failed (rules), host_failed (of these, rules its host fails
    too) and kept.

    A document goes when it has under ten words, when a fifth of its words is repetition, when it
    fails DOCUMENT_LIMIT rules, or when it fails a rule that its host is condemned for: on a good
    host one odd count is forgiven, on a bad one it isn't; clean documents stay wherever they are.

    NULL text has no words and fails; NULL hosts are one host; every row is judged by itself, so
    repeated rows get equal verdicts; an empty table gives no rows. `docs` must not have columns
    named like those added (see `keep_good`, which takes any).
    """
    keep = docs.columns if carry is None else list(dict.fromkeys([host, *carry]))
    counted = with_counts(docs, text)
    counted = counted.select(*keep, *counted.columns[len(docs.columns):]).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    counted = stage(counted.withColumns({r: F.expr(e) for r, e in RULES.items()}), "counts")
    hosts = stage(host_rates(counted, host), "rates").withColumnRenamed(host, "_host").drop("n_docs")
    if hosts.count() <= MAX_BROADCAST_HOSTS:
        hosts = F.broadcast(hosts)
    joined = counted.join(hosts, F.col(host).eqNullSafe(F.col("_host")), "left")
    n_failed = sum((F.col(r).cast("int") for r in RULES), F.lit(0))
    on_host = sum(((F.col(r) & (F.col(f"{r}_rate") > HOST_LIMIT)).cast("int") for r in RULES), F.lit(0))
    return (
        joined.withColumns({"n_failed": n_failed, "host_failed": on_host})
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_failed") < DOCUMENT_LIMIT) & (F.col("host_failed") == 0))
        .drop(*RULES, *[f"{r}_rate" for r in RULES], "_host")
    )


def keep_good(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """The rows of `docs` that `judge` keeps, with just their columns, whatever these are called."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    kept = judge(docs.toDF(*names), at[host], at[text]).where("kept")
    return kept.select(*names).toDF(*docs.columns)


_FAILS = ", ".join(f"({e}) as r_{r}" for r, e in RULES.items())
SQL_COUNTS = f"""
tokens as (
  select doc_id, source, coalesce(text, '') as text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l
  from documents),
windows as (
  select doc_id, i, list_slice(w, i, i + 4) as win
  from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from tokens where len(w) >= 5)),
hits as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, win) as n from windows) where n > 1),
covered as (
  select doc_id, sum(least(5, i - coalesce(prev, -5))) as n
  from (select doc_id, i, lag(i) over (partition by doc_id order by i) as prev from hits) group by doc_id),
counts as (
  select t.doc_id, source, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
         coalesce(c.n, 0)::bigint as n_repeat_words
  from tokens t left join covered c on c.doc_id = t.doc_id),
rules as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > 20 * n_words as base_failed, {_FAILS} from counts)"""
_HOSTS = ", ".join(f"sum(r_{r}::int)::double as {r}" for r in RULES)
_PRIOR = ", ".join(
    f"sum({r}) / sum(n) as {r}_mean, least(greatest(coalesce(((sum({r} * {r} / n) - sum(n) * (sum({r}) / sum(n)) ** 2)"
    f" / nullif(sum({r}) / sum(n) * (1 - sum({r}) / sum(n)), 0) - (count(*) - 1))"
    f" / nullif(sum(n) - sum(n * n) / sum(n) - (count(*) - 1), 0), 0.01), 0.0001), 0.5) as {r}_rho" for r in RULES)
_BAD = " or ".join(f"(r_{r} and (h.{r} + (1 / {r}_rho - 1) * {r}_mean) / (h.n + 1 / {r}_rho - 1) > {HOST_LIMIT})" for r in RULES)
_N = " + ".join(f"r_{r}::int" for r in RULES)
SQL = f"""
with {SQL_COUNTS},
hosts as (select source, count(*)::double as n, {_HOSTS} from rules group by source),
prior as (select {_PRIOR} from hosts)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and {_N} < {DOCUMENT_LIMIT} and not ({_BAD}) as kept
from rules d join hosts h on d.source is not distinct from h.source, prior"""


@query("op1_quality_rules", SQL)
def op1(spark, sf_dir):
    judged = judge(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), carry=["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
