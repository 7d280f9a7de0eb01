"""Mixing sources to target weights (operator 6): budgets down a domain-language-source tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.quality import words
from newsloom.llm.registry import query, table
from newsloom.session import stage

#: Levels of the tree under the root.
LEVELS = ("domain", "lang", "source")
#: Integer target weights of the values of a level; others have DEFAULT_WEIGHT.
WEIGHTS = {"lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}
DEFAULT_WEIGHT = 1
#: The budget in hundredths of all tokens, and how often a document may be used.
BUDGET_PERCENT = 60
MAX_EPOCHS = 4
SEED = 7
#: Leading hexadecimal digits of a document's random key: 65,536 cells per leaf and epoch.
CELL_DIGITS = 4
_NONE = "\u0000"


def domain_of(source: Column) -> Column:
    """Stand-in for a site's domain, which `documents` lacks: the last digit of the source's name."""
    return F.concat(F.lit("domain"), F.coalesce(F.right(source, F.lit(1)), F.lit("")))


def _weight(level: str) -> Column:
    given = WEIGHTS.get(level, {})
    column = F.lit(DEFAULT_WEIGHT)
    for value, weight in given.items():
        column = F.when(F.col(level) == value, weight).otherwise(column)
    return column.cast("bigint")


def _share(nodes: DataFrame, parent: list[str], child: str) -> DataFrame:
    """`nodes` (parent, child, weight, capacity, total: the parent's budget) with `budget`.

    Filling in proportion to weight until a child is full, then what is left in proportion among the
    others, and so on, has a closed form: with children ordered by capacity / weight, those full are
    a prefix of the order, and a child is full exactly when its share of what the fuller ones left
    is at least its capacity. Integers only; rounding down leaves a few tokens unused.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), child)
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    filled = nodes.withColumns({
        "_left": F.greatest(F.col("total") - F.coalesce(F.sum("capacity").over(before), F.lit(0)), F.lit(0)),
        "_weights": F.sum("weight").over(rest)})
    filled = filled.withColumn("_full", F.col("capacity") * F.col("_weights") <= F.col("_left") * F.col("weight"))
    # All that are not full share what the full ones left.
    everyone = Window.partitionBy(*parent)
    open_ = filled.withColumns({
        "_over": F.col("total") - F.sum(F.when(F.col("_full"), F.col("capacity")).otherwise(0)).over(everyone),
        "_among": F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(everyone)})
    return open_.withColumn(
        "budget", F.when(F.col("_full"), F.col("capacity")).otherwise(F.expr("_over * weight div _among"))
    ).drop("_left", "_weights", "_full", "_over", "_among")


def leaf_budgets(leaves: DataFrame, percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(domain, lang, source, tokens, budget) from (domain, lang, source, tokens).

    A node's capacity is what its documents hold, used max_epochs times. A shortage inside a node is
    made up by its own children first, since the node keeps its whole budget as long as its capacity
    reaches; only what a node cannot hold goes to its siblings, and what they cannot, further up.
    """
    budgets = leaves.agg((F.sum("tokens") * percent / 100).cast("bigint").alias("budget"))
    at: list[str] = []
    parent = None
    for depth, level in enumerate(LEVELS):
        nodes = leaves.groupBy(*LEVELS[:depth + 1]).agg((F.sum("tokens") * max_epochs).alias("capacity"))
        nodes = nodes.withColumn("weight", _weight(level))
        if parent is None:
            nodes = nodes.withColumn("total", budgets.scalar())
        else:
            nodes = nodes.join(parent, at)
        shared = _share(nodes, at or [F.lit(0)], level)
        parent = shared.select(*LEVELS[:depth + 1], F.col("budget").alias("total"))
        at = [*at, level]
    return leaves.join(parent.withColumnRenamed("total", "budget"), at)


def _order(epoch: Column) -> Column:
    name = F.coalesce(F.col("_key").cast("string"), F.concat(F.lit("text:"), F.col("_text").cast("string")))
    return F.md5(F.concat_ws(":", F.lit(SEED).cast("string"), epoch.cast("string"), name))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
        percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Rows of `docs` chosen to fill the token budget of every leaf, with mix_domain, mix_tokens (words) and mix_epoch.

    A leaf with a budget of q times its tokens and a rest takes all its documents in epochs 0 ...
    q-1 and, in epoch q, a prefix of its documents in that epoch's seeded order, up to and without
    the first that would pass the budget. So a row comes once for every epoch that uses it.

    The prefix is found without ordering a leaf: random keys are cut into cells, the cells' token
    sums give the one cell in which a leaf's prefix ends, and only that cell is ordered.

    A NULL key is replaced by the text. NULL text has no tokens; documents without tokens are never chosen; NULL language or source is
    a value of its own; ties of the random order are broken by text, and repeated rows count as
    often as they occur; an empty table gives no rows.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    own = docs.toDF(*names).withColumns({
        "_key": F.col(at[key]), "domain": domain_of(F.col(at[source])), "lang": F.coalesce(at[lang], F.lit(_NONE)),
        "source": F.coalesce(at[source], F.lit(_NONE)), "tokens": F.size(words(F.col(at[text]))).cast("bigint"),
        "_text": F.xxhash64(at[text])}).where("tokens > 0")
    own = stage(own, "mix")
    slim = own.select("_key", "_text", "tokens", *LEVELS)
    leaves = stage(slim.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "leaves")
    quota = stage(leaf_budgets(leaves, percent, max_epochs).select(
        *LEVELS, F.expr("budget div tokens").alias("full"), F.expr("budget % tokens").alias("rest")), "quota")
    # Cell sums of the last, partial epoch; the sums of at most 65,536 cells a leaf are added up by leaf.
    last = slim.join(F.broadcast(quota) if quota.count() <= 100_000 else quota, list(LEVELS))
    last = last.withColumn("_random", _order(F.col("full"))).withColumn("_cell", F.substring("_random", 1, CELL_DIGITS))
    sums = last.groupBy(*LEVELS, "full", "rest", "_cell").agg(F.sum("tokens").alias("n"))
    upto = Window.partitionBy(*LEVELS).orderBy("_cell")
    ends = stage(
        sums.withColumn("upto", F.sum("n").over(upto))
        .where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest")))
        .select(*LEVELS, F.col("_cell").alias("end"), (F.col("rest") - F.col("upto") + F.col("n")).alias("room")), "ends")
    in_end = last.join(ends, list(LEVELS)).where("_cell = end")
    running = Window.partitionBy(*LEVELS).orderBy("_random", "_text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The place behind the last chosen document of the end cell; repeated rows are told apart by a number.
    chosen = stage(
        in_end.withColumn("_sum", F.sum("tokens").over(running)).where("_sum <= room")
        .groupBy(*LEVELS, "_random", "_text").agg(F.count("*").alias("_copies")), "chosen")
    quota = quota.join(ends.select(*LEVELS, "end"), list(LEVELS), "left")
    small = F.broadcast(quota) if quota.count() <= 100_000 else quota
    rows = own.join(small, list(LEVELS)).withColumn("_random", _order(F.col("full")))
    rows = rows.withColumn("_cell", F.substring("_random", 1, CELL_DIGITS))
    full = rows.where("full > 0").withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("full") - 1)))
    front = rows.where("_cell < end").withColumn("mix_epoch", F.col("full"))
    twin = Window.partitionBy(*LEVELS, "_random", "_text").orderBy(F.lit(0))
    edge = (
        rows.where("_cell = end").join(chosen, [*LEVELS, "_random", "_text"])
        .withColumn("_twin", F.row_number().over(twin)).where("_twin <= _copies").drop("_twin", "_copies")
        .withColumn("mix_epoch", F.col("full"))
    )
    out = [*names, F.col("domain"), F.col("tokens"), "mix_epoch"]
    return full.select(*out).unionByName(front.select(*out)).unionByName(edge.select(*out)).toDF(
        *docs.columns, "mix_domain", "mix_tokens", "mix_epoch")


def _weight_sql(level: str) -> str:
    cases = "".join(f" when {level} = '{v}' then {w}" for v, w in WEIGHTS.get(level, {}).items())
    return f"(case{cases} else {DEFAULT_WEIGHT} end)::bigint" if cases else f"{DEFAULT_WEIGHT}::bigint"


def _share_sql(out: str, source: str, parent: str, level: str) -> str:
    over = f"partition by {parent}"
    return f"""
{out}_a as (
  select *, greatest(total - coalesce(sum(capacity) over ({over} order by capacity / weight, {level} rows between unbounded preceding and 1 preceding), 0), 0) as l,
         sum(weight) over ({over} order by capacity / weight, {level} rows between current row and unbounded following) as ws
  from {source}),
{out}_b as (select *, capacity * ws <= l * weight as isfull from {out}_a),
{out}_c as (
  select *, total - sum(case when isfull then capacity else 0 end) over ({over}) as ov,
         sum(case when isfull then 0 else weight end) over ({over}) as am from {out}_b),
{out} as (select *, (case when isfull then capacity else ov * weight // am end)::bigint as budget from {out}_c)"""


def mix_sql(documents: str = "documents") -> str:
    return f"""
with own as (
  select *, 'domain' || coalesce(right(source, 1), '') as domain,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::bigint as tokens
  from {documents}),
used as (select * from own where tokens > 0),
leaves as (select domain, lang, source, sum(tokens)::bigint as tokens from used group by all),
n1 as (select domain, {_weight_sql('domain')} as weight, (sum(tokens) * {MAX_EPOCHS})::bigint as capacity,
              (select floor(sum(tokens) * {BUDGET_PERCENT} / 100)::bigint from leaves) as total from leaves group by domain),
{_share_sql('b1', 'n1', '1', 'domain')},
n2 as (select l.domain, l.lang, {_weight_sql('lang')} as weight, (sum(tokens) * {MAX_EPOCHS})::bigint as capacity, any_value(b1.budget) as total
       from leaves l join b1 using (domain) group by l.domain, l.lang),
{_share_sql('b2', 'n2', 'domain', 'lang')},
n3 as (select l.domain, l.lang, l.source, {_weight_sql('source')} as weight, (sum(tokens) * {MAX_EPOCHS})::bigint as capacity, any_value(b2.budget) as total
       from leaves l join b2 using (domain, lang) group by l.domain, l.lang, l.source),
{_share_sql('b3', 'n3', 'domain, lang', 'source')},
quota as (select domain, lang, source, budget // tokens as q, budget % tokens as r from leaves join b3 using (domain, lang, source)),
ordered as (
  select used.*, q, r, sum(tokens) over (partition by domain, lang, source
         order by md5('{SEED}:' || q::varchar || ':' || doc_id::varchar), doc_id rows unbounded preceding) as upto
  from used join quota using (domain, lang, source)),
picked as (
  select *, unnest(range(0, q)) as mix_epoch from ordered where q > 0
  union all select *, q as mix_epoch from ordered where upto <= r)"""


SQL = mix_sql() + """
select doc_id, lang, source, domain as mix_domain, tokens as mix_tokens, mix_epoch::bigint as mix_epoch from picked"""


@query("op6_mix_sources", SQL)
def op6(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "lang", "source", "mix_domain", "mix_tokens", "mix_epoch")
