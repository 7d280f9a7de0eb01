"""Nearest stored neighbour above a cosine threshold, as a join.

Every operator returns `(id, match_id, similarity)`, one row per query that has a neighbour with
`similarity >= threshold`; the neighbour is the most similar candidate, the smallest id on a tie.
With `earlier=True` only candidates with a smaller id count, and all queries are candidates too.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.barrier import with_computed
from newsloom.functions.features import cosine, has_direction, set_cosine
from newsloom.operators.bits import Bits
from newsloom.operators.joins import skew_safe_join
from newsloom.session import stage

RESULT = "id bigint, match_id bigint, similarity double"
# Coordinates are ranked by the counts of so many buckets; these are broadcast (8 bytes each).
BUCKETS = 1 << 18
# A coordinate with more query/candidate pairs than this is compared in blocks.
LIGHT_PAIRS = 65_536
BLOCK_ROWS = 1_024
# 64-bit words of a set's parities, a power of two. Unrelated sets of 160 coordinates differ in some 180 of 512 bits, and
# may in 62 at cosine 0.8; of 128 bits they would differ in 63.
SKETCH_WORDS = 8
# Pivots are collected and sent to every task: at most 12 MB at a width of 384.
PIVOTS = 4_096
DENSE_BLOCK_ROWS = 2_048
# What is compared in one task: at most so many vectors of a side, and numbers of theirs (64 MB).
SHELF_ROWS, SHELF_NUMBERS = 32_768, 1 << 23
# Distances and similarities that a task holds at once (8 bytes each, a few copies).
HELD_NUMBERS = 1 << 21
PLACES = 9
# Blocks of fewer pairs of dense vectors are compared as they are.
SKETCH_PAIRS = 1 << 21


def _vector_key(vector: Column) -> list[Column]:
    """128 bits that stand for a vector."""
    return [F.xxhash64(vector).alias("k1"), F.xxhash64(F.lit(1), vector).alias("k2")]


def _best(scored: DataFrame) -> DataFrame:
    """One row per id: highest similarity, then smallest match."""
    return (
        scored.groupBy("id")
        .agg(F.min(F.struct((-F.col("similarity")).alias("s"), "match_id")).alias("m"))
        .select("id", F.col("m.match_id").alias("match_id"), (-F.col("m.s")).alias("similarity"))
    )


# --- feature sets ------------------------------------------------------------------------------


def nearest_earlier_sets(rows: DataFrame, threshold: float, light_pairs: int | None = None) -> DataFrame:
    """Nearest earlier feature set of every asking row. Input: `(id, features, asks)`, a stored table.
    Coordinates with more than `light_pairs` pairs are compared in blocks.

    All rows are candidates for later ones. Equal sets are folded first: the smallest id of each
    distinct set stands for all of them, so a set held by a third of all rows costs one aggregation
    and never forms pairs. A later copy is answered at once, by the first row of its set; only
    first rows enter the similarity join. Sets are folded by their keys, features stay where they are.
    """
    held = rows.where("features IS NOT NULL").select("id", "asks", "features", *_vector_key(F.col("features")))
    keyed = held.select("id", "asks", "k1", "k2")
    heads = stage(keyed.groupBy("k1", "k2").agg(F.min("id").alias("id")), "first-ids")
    firsts = heads.select("k1", "k2", F.col("id").alias("match_id"))
    copies = skew_safe_join(keyed.where("asks").select("id", "k1", "k2"), firsts, ["k1", "k2"])
    copies = copies.where("match_id < id").select("id", "match_id", F.lit(1.0).alias("similarity"))
    # A later copy that is let in by chance is never a better match than the first row; it may not ask.
    groups = held.where(Bits(heads, "k1", "k2", "id").maybe("k1", "k2", "id")).select(
        "id", F.col("asks").alias("q"), F.lit(True).alias("c"), "features")
    near = _prefix_join(groups, threshold, True, light_pairs).join(heads.select("id").distinct(), "id", "left_semi")
    return copies.unionByName(near)


def nearest_sets(queries: DataFrame, candidates: DataFrame, threshold: float) -> DataFrame:
    """Nearest candidate set of every query. Inputs: `(id, features)`; equal sets fold as above."""
    asked = stage(_distinct_sets(queries), "asked-sets")
    stored = stage(_distinct_sets(candidates), "stored-sets")
    firsts = stored.select("k1", "k2", F.col("id").alias("match_id"))
    equal = asked.join(firsts, ["k1", "k2"]).select("k1", "k2", "match_id", F.lit(1.0).alias("similarity"))
    unequal = asked.join(firsts, ["k1", "k2"], "left_anti")
    rows = stage(
        unequal.select("id", F.lit(True).alias("q"), F.lit(False).alias("c"), "features")
        .unionByName(stored.select("id", F.lit(False).alias("q"), F.lit(True).alias("c"), "features")),
        "sets",
    )
    found = asked.join(_prefix_join(rows, threshold, earlier=False), "id").select(
        "k1", "k2", "match_id", "similarity"
    )
    keyed = queries.where("features IS NOT NULL").select("id", *_vector_key(F.col("features")))
    return skew_safe_join(keyed, equal.unionByName(found), ["k1", "k2"]).select(
        "id", "match_id", "similarity"
    )


def _prefix_length(n: Column, threshold: float) -> Column:
    return n - F.ceil(n * F.lit(threshold * threshold) - F.lit(1e-9)).cast("int") + 1


def _in_hash_order(features: Column, threshold: float) -> Column:
    """The prefix of a set by hash alone. A coordinate of nearly every set may come first, and then all sets meet."""
    return F.slice(features, F.lit(1), _prefix_length(F.size(features), threshold))


def set_postings(prefixes: DataFrame) -> DataFrame:
    """`(f, id, n, pos)` of `prefixes` `(id, n, prefix)`."""
    return prefixes.select("id", "n", F.posexplode("prefix").alias("pos", "f")).select("f", "id", "n", "pos")


@dataclass
class KnownSets:
    """Stored distinct sets: `keys` (k1, k2, id), `postings` (f, id, n, pos), `features` (id, features).

    `weights` (of BUCKETS) is the order of coordinates, lightest first, that the postings were made by. It must never
    change while they are in use, so that postings can be stored once and looked up by later sets; it may be of any
    sets, as it only rules how many sets meet. Without it, coordinates are in hash order.
    """

    keys: DataFrame
    postings: DataFrame
    features: DataFrame
    weights: np.ndarray | None = None


def _distinct_sets(rows: DataFrame) -> DataFrame:
    """`(k1, k2, id, features)`: each set once, under its smallest id."""
    keyed = rows.where("features IS NOT NULL").select("id", "features", *_vector_key(F.col("features")))
    return keyed.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.any_value("features").alias("features"))


def _keys_of(rows: DataFrame) -> DataFrame:
    """`(k1, k2, id)`: each set once, under its smallest id."""
    keyed = rows.where("features IS NOT NULL").select("id", *_vector_key(F.col("features")))
    return keyed.groupBy("k1", "k2").agg(F.min("id").alias("id"))


def _prefixes_of(rows: DataFrame, keys: DataFrame, threshold: float, weights: np.ndarray | None) -> DataFrame:
    """`(id, n, prefix)` of the sets that `keys` `(k1, k2, id)` name; of `rows` only prefixes are moved."""
    features = F.col("features")
    prefix = _in_hash_order(features, threshold) if weights is None else _lightest(rows.sparkSession, weights, threshold)(features)
    held = rows.where("features IS NOT NULL").select("id", *_vector_key(features), F.size("features").alias("n"), prefix.alias("prefix"))
    return held.join(keys, ["k1", "k2", "id"], "left_semi").dropDuplicates(["k1", "k2"]).select("id", "n", "prefix")


def known_sets(rows: DataFrame, threshold: float, weights: np.ndarray | None = None) -> KnownSets:
    """What `nearest_known_sets` looks up, made from a whole stored table `(id, features)`."""
    keys = stage(_keys_of(rows), "known-sets")
    postings = stage(set_postings(_prefixes_of(rows, keys, threshold, weights)), "known-postings")
    return KnownSets(
        keys.select("k1", "k2", "id"), postings, rows.where("features IS NOT NULL").select("id", "features"), weights)


def new_sets(rows: DataFrame, known: KnownSets, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The keys and postings that rows `(id, features)`, a stored table, add to what is known."""
    fresh = stage(_keys_of(rows).join(known.keys.select("k1", "k2"), ["k1", "k2"], "left_anti"), "new-sets")
    return fresh.select("k1", "k2", "id"), set_postings(_prefixes_of(rows, fresh, threshold, known.weights))


def nearest_known_sets(queries: DataFrame, known: KnownSets, threshold: float) -> DataFrame:
    """Nearest known set of every query `(id, features)`.

    Work follows the queries: of what is known, only postings of the queries' own prefix coordinates
    and the features of sets that these name are taken; nothing stored is hashed, sorted or exploded.
    """
    asked = stage(_keys_of(queries), "asked-sets")
    firsts = known.keys.select("k1", "k2", F.col("id").alias("match_id"))
    equal = asked.join(firsts, ["k1", "k2"]).select("k1", "k2", "match_id", F.lit(1.0).alias("similarity"))
    unequal = stage(asked.join(firsts, ["k1", "k2"], "left_anti"), "unequal-sets")
    mine = stage(set_postings(_prefixes_of(queries, unequal, threshold, known.weights)), "asked-postings")
    theirs = stage(known.postings.join(mine.select("f").distinct(), "f", "left_semi"), "met-postings")
    keyed = queries.where("features IS NOT NULL").select("id", *_vector_key(F.col("features")))
    if theirs.isEmpty():
        return skew_safe_join(keyed, equal, ["k1", "k2"]).select("id", "match_id", "similarity")
    yes, no = F.lit(True), F.lit(False)
    postings = (
        mine.select("id", yes.alias("q"), no.alias("c"), "n", "pos", "f")
        .unionByName(theirs.select("id", no.alias("q"), yes.alias("c"), "n", "pos", "f")))
    rows = (
        queries.where("features IS NOT NULL").select("id", yes.alias("q"), no.alias("c"), "features")
        .unionByName(known.features.select("id", no.alias("q"), yes.alias("c"), "features")))
    near = _match(postings, rows, threshold, earlier=False)
    found = asked.join(near, "id").select("k1", "k2", "match_id", "similarity")
    return skew_safe_join(keyed, equal.unionByName(found), ["k1", "k2"]).select("id", "match_id", "similarity")


def best_of(*matches: DataFrame) -> DataFrame:
    """The most similar of several matches of a row, the smallest match on a tie."""
    return _best(functools.reduce(DataFrame.unionByName, matches))


def _prefix_join(rows: DataFrame, threshold: float, earlier: bool, light_pairs: int | None = None) -> DataFrame:
    """Neighbours among distinct sets `(id, q, c, features)`; q and c mark queries and candidates.
    `rows` is a stored table, as it is read several times.

    In one global order of coordinates, rarest first, two sets with cosine >= t share a coordinate
    within the first `n - ceil(t^2 n) + 1` of each. Joining on those coordinates alone finds every
    partner; sizes and positions drop most others before the sets themselves are compared.
    """
    prefixes = stage(
        rows.select("id", "q", "c", F.size("features").alias("n"), _rarest(rows, threshold)(F.col("features")).alias("prefix")),
        "prefixes")
    postings = prefixes.select("id", "q", "c", "n", F.posexplode("prefix").alias("pos", "f"))
    return _match(postings, rows, threshold, earlier, light_pairs)


def bucket_counts(sets: DataFrame) -> DataFrame:
    """`(b, n)`: how many coordinates of `sets` `(features)` fall into each one of BUCKETS."""
    bucket = F.pmod("f", F.lit(BUCKETS)).alias("b")
    return sets.select(F.explode("features").alias("f")).groupBy(bucket).agg(F.count("*").alias("n"))


def bucket_weights(counts: DataFrame) -> np.ndarray:
    """The `(b, n)` of `bucket_counts` as one number for each of BUCKETS."""
    counted = counts.toArrow()
    weights = np.zeros(BUCKETS, dtype=np.int64)
    weights[counted.column("b").to_numpy()] = counted.column("n").to_numpy()
    return weights


def _rarest(rows: DataFrame, threshold: float):
    """Function from a set to its prefix, rarest coordinates first.

    How frequent a coordinate is, is read off the number of occurrences of all coordinates that fall
    into its one of BUCKETS. Ties and chance meetings change what is compared, not what is found.
    """
    return _lightest(rows.sparkSession, bucket_weights(bucket_counts(rows.where("c"))), threshold)


def _lightest(spark: SparkSession, weights: np.ndarray, threshold: float):
    """Function from a set to its prefix, coordinates of the lightest buckets first."""
    shared = spark.sparkContext.broadcast(weights)

    @F.arrow_udf("array<bigint>")
    def prefix(features: pa.Array) -> pa.Array:
        flat = features.flatten().to_numpy(zero_copy_only=False)
        n = pc.fill_null(pc.list_value_length(features), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        length = n - np.ceil(n * (threshold * threshold) - 1e-9).astype(np.int64) + 1
        length = np.minimum(length, n)
        start = np.cumsum(n) - n
        order = np.lexsort((flat, shared.value[flat & (BUCKETS - 1)], np.repeat(np.arange(len(n)), n)))
        kept = np.arange(len(flat)) - np.repeat(start, n) < np.repeat(length, n)
        bounds = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat[order][kept]))

    return prefix


def _parity_words(features: Column) -> Column:
    """Of 64 * SKETCH_WORDS bits: whether an odd number of coordinates falls to each. Two sets differ in as many coordinates at least as in bits."""
    one = F.lit(1).cast("bigint")
    return F.transform(F.array(*[F.lit(k) for k in range(SKETCH_WORDS)]), lambda k: F.aggregate(
        F.filter(features, lambda f: F.shiftright(f, 6).bitwiseAND(SKETCH_WORDS - 1) == k), F.lit(0).cast("bigint"),
        lambda seen, f: seen.bitwiseXOR(F.call_function("shiftleft", one, f.bitwiseAND(63).cast("int")))))


def _parities(features: Column) -> list[Column]:
    words = _parity_words(features)
    return [words[k] for k in range(SKETCH_WORDS)]


def _match(postings: DataFrame, rows: DataFrame, threshold: float, earlier: bool, light_pairs: int | None = None) -> DataFrame:
    """Neighbours by stored `postings` `(id, q, c, n, pos, f)` of the prefixes of `rows`, a stored table.

    Only postings of coordinates that two sides share are moved, and of the sets only those that are compared.
    """
    counts = stage(
        postings.groupBy("f")
        .agg(F.count_if("q").alias("mq"), F.count_if("c").alias("mc"))
        .where((F.col("mq") > 0) & (F.col("mc") > (1 if earlier else 0))),
        "coordinates",
    ).withColumn("heavy", F.col("mq") * F.col("mc") > (LIGHT_PAIRS if light_pairs is None else light_pairs))
    if counts.isEmpty():
        return rows.sparkSession.createDataFrame([], RESULT)
    shared = postings.where(Bits(counts, "f").maybe("f"))
    live = stage(skew_safe_join(shared, counts.select("f", "heavy"), ["f"]), "postings")

    def side(df: DataFrame, flag: str, prefix: str) -> DataFrame:
        return df.where(flag).select("f", *[F.col(c).alias(prefix + c) for c in ("id", "n", "pos")])

    light = live.where("NOT heavy")
    needed = F.lit(threshold) * F.sqrt((F.col("q_n") * F.col("c_n")).cast("double")) - F.lit(1e-9)
    reachable = 1 + F.least(F.col("q_n") - F.col("q_pos"), F.col("c_n") - F.col("c_pos")) - 1
    pairs = side(light, "q", "q_").join(side(light, "c", "c_"), "f")
    if earlier:
        pairs = pairs.where("c_id < q_id")
    pairs = stage(pairs.where(reachable >= needed).select("q_id", "c_id").distinct(), "pairs")
    asked, named = Bits(pairs, "q_id").maybe("id"), Bits(pairs, "c_id").maybe("id")
    met = rows.where((F.col("q") & asked) | (F.col("c") & named))
    met = stage(met.select("id", "q", "c", F.size("features").alias("n"), _parity_words(F.col("features")).alias("s"), "features"), "met-sets")

    def of(flag: str, prefix: str, df: DataFrame, *columns: str) -> DataFrame:
        return df.where(flag).select(*[F.col(c).alias(prefix + c) for c in ("id", *columns)])

    small = ("n", "s")
    near = pairs.join(of("c", "c_", met, *small), "c_id").join(of("q", "q_", met, *small), "q_id")
    apart = sum(F.bit_count(F.col("q_s")[k].bitwiseXOR(F.col("c_s")[k])) for k in range(SKETCH_WORDS))
    near = stage(near.where(apart <= F.col("q_n") + F.col("c_n") - 2 * needed).select("q_id", "c_id").distinct(), "near-pairs")
    left = met.where((F.col("q") & Bits(near, "q_id").maybe("id")) | (F.col("c") & Bits(near, "c_id").maybe("id")))
    scored = (
        near.join(of("c", "c_", left, "features").withColumnRenamed("c_features", "c_f"), "c_id")
        .join(of("q", "q_", left, "features").withColumnRenamed("q_features", "q_f"), "q_id")
        .select(F.col("q_id").alias("id"), F.col("c_id").alias("match_id"),
                set_cosine(F.col("q_f"), F.col("c_f")).alias("similarity"))
        .where(F.col("similarity") >= threshold)
    )
    if not counts.where("heavy").isEmpty():
        crowded = stage(live.where("heavy"), "crowded")
        often = rows.where(Bits(crowded.select("id").distinct(), "id").maybe("id"))
        scored = scored.unionByName(_block_join(often, crowded, threshold, earlier))
    return _best(scored)


def _block_join(rows: DataFrame, postings: DataFrame, threshold: float, earlier: bool) -> DataFrame:
    """Neighbours that share a frequent prefix coordinate.

    Posting lists are cut into blocks of bounded size and block pairs are compared by matrix
    product; only the best candidate per query and block pair leaves a task. Rows that share their
    first frequent coordinate (the lead) meet under the lead only, so a large family of near copies
    is compared once, not once per shared coordinate.
    """
    leads = postings.groupBy("id", "q", "c").agg(F.min(F.struct("pos", "f")).alias("m"))
    led = postings.select("id", "q", "c", "f").join(
        leads.select("id", "q", "c", F.col("m.f").alias("lead")), ["id", "q", "c"]
    )
    families = led.groupBy("f", "lead").agg(F.count("*").alias("m"))
    families = families.withColumn("family", F.when(F.col("m") >= BLOCK_ROWS // 4, F.col("lead")))
    blocks = (
        families.groupBy("f", "family").agg(F.sum("m").alias("m"))
        .select("f", "family", F.ceil(F.col("m") / BLOCK_ROWS).cast("int").alias("slices"))
    )
    blocks = stage(blocks, "blocks")
    big = families.where("family IS NOT NULL").select("f", "lead", "family")
    placed = led.join(big, ["f", "lead"], "left")
    sized = blocks.withColumn("family_key", F.coalesce("family", F.lit(0)))
    placed = (
        placed.withColumn("family_key", F.coalesce("family", F.lit(0)))
        .join(sized.select("f", "family_key", "slices"), ["f", "family_key"])
        .withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int"))
        .join(rows.select("id", "q", "c", "features"), ["id", "q", "c"])
        .select("id", "q", "c", "f", "family_key", "slice", "features")
    )
    parts = sized.select(
        "f", "family_key", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")
    )
    left = parts.select("f", F.struct("family_key", "slice").alias("bq"))
    right = parts.select("f", F.struct("family_key", "slice").alias("bc"))
    plan = left.join(right, "f").where(
        (F.col("bq.family_key") != F.col("bc.family_key"))
        | (F.col("bq.family_key") == 0)
        | (F.col("bq.family_key") == F.col("f"))
    )
    plan = stage(plan, "block-pairs")

    def send(flag: str, block: str) -> DataFrame:
        mine = placed.where(flag).withColumn(block, F.struct("family_key", "slice"))
        return (
            mine.join(plan, ["f", block])
            .select(F.xxhash64("f", "bq", "bc").alias("task"), F.col("id").alias("id"),
                    F.col("features").alias("features"))
        )

    def compare(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"id": [], "match_id": [], "similarity": []})
        c = c.sort_values("id")
        qn, cn = q.features.map(len).to_numpy(), c.features.map(len).to_numpy()
        qf, cf = np.concatenate(q.features.to_numpy()), np.concatenate(c.features.to_numpy())
        shared = np.intersect1d(qf, cf)
        overlap = np.zeros((len(q), len(c)))
        for start in range(0, len(shared), 4_096):
            part = shared[start:start + 4_096]
            overlap += _incidence(qf, qn, part) @ _incidence(cf, cn, part).T
        similarity = overlap / np.sqrt((qn[:, None] * cn[None, :]).astype("float64"))
        return _row_best(q.id.to_numpy(), c.id.to_numpy(), similarity, threshold, earlier)

    return (
        send("q", "bq").groupBy("task").cogroup(send("c", "bc").groupBy("task"))
        .applyInPandas(compare, RESULT)
    )


def _incidence(flat: np.ndarray, sizes: np.ndarray, coordinates: np.ndarray) -> np.ndarray:
    """0/1 matrix rows x coordinates."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.minimum(np.searchsorted(coordinates, flat), len(coordinates) - 1)
    hit = coordinates[place] == flat
    matrix = np.zeros((len(sizes), len(coordinates)), dtype="float32")
    matrix[row[hit], place[hit]] = 1
    return matrix


def _row_best(q_id, c_id, similarity, threshold, earlier, exclude_self=False) -> pd.DataFrame:
    """Best candidate per query; candidates are in id order, so the first maximum is the smallest."""
    if exclude_self:
        similarity = np.where(c_id[None, :] != q_id[:, None], similarity, -1.0)
    if earlier:
        similarity = np.where(c_id[None, :] < q_id[:, None], similarity, -1.0)
    at = similarity.argmax(axis=1)
    value = similarity[np.arange(len(q_id)), at]
    keep = value >= threshold
    return pd.DataFrame({"id": q_id[keep], "match_id": c_id[at][keep], "similarity": value[keep]})


# --- dense vectors -----------------------------------------------------------------------------


def _unit_rows(df: DataFrame, *extra: str) -> DataFrame:
    vector = F.transform("vector", lambda x: x.cast("double"))
    return df.where(has_direction(F.col("vector"))).select("id", *extra, vector.alias("vector")).select(
        "id", *extra, "vector", *_vector_key(F.col("vector"))
    )


def nearest_earlier_vectors(rows: DataFrame, threshold: float, probes: int | None = None,
                            pivots: int = PIVOTS, cell_rows: int | None = None) -> DataFrame:
    """Nearest earlier vector of every asking row. Input: `(id, vector, asks)`.

    See `nearest_vectors` for the method. Equal vectors are folded as in `nearest_earlier_sets`.
    """
    keyed = _unit_rows(rows, "asks")
    groups = stage(
        keyed.groupBy("k1", "k2").agg(
            F.min("id").alias("id"), F.max("asks").alias("asked"),
            F.any_value("vector").alias("vector"),
        ),
        "distinct-vectors",
    )
    near = _cell_join(groups.where("asked"), groups, threshold, True, probes, pivots, cell_rows)
    by_key = groups.where("asked").select("k1", "k2", F.col("id").alias("first_id")).join(
        near.withColumnRenamed("id", "first_id"), "first_id", "left"
    )
    joined = skew_safe_join(keyed.where("asks").select("id", "k1", "k2"), by_key, ["k1", "k2"])
    # A later copy is as close to the first row of its vector as anything can be; another row can
    # only win by an equal similarity and a smaller id, and then the first row has found it too.
    copy = (F.col("id") > F.col("first_id")) & ~F.coalesce(F.col("similarity") >= 1.0, F.lit(False))
    return joined.select(
        "id",
        F.when(copy, F.col("first_id")).otherwise(F.col("match_id")).alias("match_id"),
        F.when(copy, F.lit(1.0)).otherwise(F.col("similarity")).alias("similarity"),
    ).where("match_id IS NOT NULL")


def nearest_vectors(queries: DataFrame, candidates: DataFrame, threshold: float,
                    probes: int | None = None, pivots: int = PIVOTS, cell_rows: int | None = None,
                    exclude_self: bool = False) -> DataFrame:
    """Nearest candidate vector of every query. Inputs: `(id, vector)`. Similarities have 9 places.

    Exact by default: candidates are spread over the cells of at most `pivots` pivot vectors and
    rings around them; a query visits only cells and rings that the triangle and bisector bounds
    cannot rule out (Lu et al. 2012). Inside a cell, blocks of bounded size are compared by matrix
    product. With `probes` set, a query visits its `probes` nearest cells only: the approximate
    search of an inverted-file index, which may miss neighbours. Cells hold about `cell_rows` vectors,
    as long as `pivots` allow. With `exclude_self` both inputs are parts of one table, and a row is
    not its own neighbour. Zero vectors and those with numbers that aren't finite have no neighbours.
    """

    def folded(df: DataFrame) -> DataFrame:
        return _unit_rows(df).groupBy("k1", "k2").agg(
            F.min("id").alias("id"), F.any_value("vector").alias("vector")
        )

    asked = stage(folded(queries), "asked-vectors")
    stored = stage(folded(candidates), "stored-vectors")
    if exclude_self:
        return _nearest_others(queries, candidates, stored, threshold, probes, pivots, cell_rows)
    near = _cell_join(asked, stored, threshold, False, probes, pivots, cell_rows, exclude_self)
    by_key = asked.select("id", "k1", "k2").join(near, "id").select("k1", "k2", "match_id", "similarity")
    keyed = _unit_rows(queries).select("id", "k1", "k2")
    return skew_safe_join(keyed, by_key, ["k1", "k2"]).select("id", "match_id", "similarity")


def nearest_earlier_of(queries: DataFrame, candidates: DataFrame, threshold: float) -> DataFrame:
    """Nearest candidate with a smaller id than the query's. Inputs: `(id, vector)`; no two candidates have one vector."""
    asked = stage(_unit_rows(queries).select("id", "vector"), "asked-vectors")
    stored = stage(_unit_rows(candidates).select("k1", "k2", "id", "vector"), "stored-vectors")
    return _cell_join(asked, stored, threshold, True, None, PIVOTS)


def _nearest_others(queries, candidates, stored, threshold, probes, pivots, cell_rows) -> DataFrame:
    """Nearest candidate other than the row itself: the smallest other id with the same vector, or what
    the vector, searched once without its own, is nearest to."""
    keyed = _unit_rows(queries)
    firsts = stored.select("k1", "k2", F.col("id").alias("first"))
    later = _unit_rows(candidates).join(firsts, ["k1", "k2"]).where("id > first").groupBy("k1", "k2").agg(F.min("id").alias("second"))
    pairs = stage(firsts.join(later, ["k1", "k2"], "left"), "first-ids")
    met = skew_safe_join(keyed, pairs, ["k1", "k2"], "left").withColumn(
        "other", F.when(F.col("first") != F.col("id"), F.col("first")).otherwise(F.col("second")))
    met = stage(met, "met-vectors")
    copies = met.where("other IS NOT NULL").select("id", F.col("other").alias("match_id"), F.lit(1.0).alias("similarity"))
    named = met.withColumn("_name", F.coalesce("first", "id"))
    asked = stage(named.groupBy(F.col("_name").alias("id")).agg(F.any_value("vector").alias("vector")), "asked-vectors")
    near = _cell_join(asked, stored, threshold, False, probes, pivots, cell_rows, True).withColumnRenamed("id", "_name")
    found = skew_safe_join(named.select("id", "_name"), near, ["_name"]).select("id", "match_id", "similarity")
    return best_of(copies, found)


def _cell_join(queries, groups, threshold, earlier, probes, pivots, cell_rows=None, exclude_self=False) -> DataFrame:
    spark = groups.sparkSession
    reach = math.sqrt(max(2.0 - 2.0 * threshold, 0.0)) + 1e-6
    # Cells should fill a block: every further cell a query visits costs a copy of its vector. The
    # number of vectors collected is bounded; hash order spreads them like the data.
    pivots = max(1, min(pivots, groups.count() // (cell_rows or DENSE_BLOCK_ROWS)))
    chosen = groups.orderBy("k1", "k2").limit(pivots).select("vector").collect()
    if not chosen:
        return spark.createDataFrame([], RESULT)
    cells = Cells(spark, np.array([r.vector for r in chosen]), max(reach, 1 / 16))
    stored = stage(cells.placed(groups.select("id", "vector")), "cells")
    return compare_cells(stored, queries.select("id", "vector"), cells, reach, probes, threshold, earlier, exclude_self)


class Cells:
    """The cells of some pivots, and rings of one width around each: code = pivot * RINGS + ring."""

    RINGS = 64

    def __init__(self, spark, pivots: np.ndarray, ring: float):
        centres = pivots / np.linalg.norm(pivots, axis=1, keepdims=True)
        self.shared, self.ring = spark.sparkContext.broadcast(centres), ring

    def _slices(self, batches, each: int = 1):
        """Rows by so few that their distances to all pivots, or `each` numbers a pivot, are bounded."""
        rows = max(1, HELD_NUMBERS // (len(self.shared.value) * each))
        for frame in batches:
            for lo in range(0, len(frame), rows):
                yield frame.iloc[lo:lo + rows]

    def _distances(self, frame: pd.DataFrame) -> np.ndarray:
        vectors = np.stack(frame.vector.to_numpy())
        vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.sqrt(np.maximum(2.0 - 2.0 * (vectors @ self.shared.value.T), 0.0))

    def placed(self, rows: DataFrame) -> DataFrame:
        """Rows `(id, vector)` with the `cell` of the nearest pivot and the ring around it."""

        def place(batches):
            for frame in self._slices(batches):
                d = self._distances(frame)
                own = d.argmin(axis=1)
                radius = d[np.arange(len(frame)), own]
                yield frame.assign(cell=(own * self.RINGS + (radius // self.ring)).astype("int32"))

        return rows.mapInPandas(place, "id bigint, vector array<double>, cell int")

    def visited(self, rows: DataFrame, reach: float, probes: int | None = None, places: np.ndarray | None = None) -> DataFrame:
        """Rows `(id, vector)` with the `cells` that may hold vectors within `reach`, or those of the `probes` nearest pivots;
        with `places`, the distinct places of these cells (none where it is negative)."""
        placed = None if places is None else rows.sparkSession.sparkContext.broadcast(places)

        def visit(batches):
            pivots, ring = self.shared.value, self.ring
            centre_gap = np.sqrt(np.maximum(2.0 - 2.0 * (pivots @ pivots.T), 0.0))
            for frame in self._slices(batches, math.ceil(2 * reach / ring) + 2):
                d = self._distances(frame)
                own = d.argmin(axis=1)
                nearest = d[np.arange(len(frame)), own]
                if probes is None:
                    gap = np.maximum(centre_gap[own], 1e-12)
                    allowed = (d ** 2 - nearest[:, None] ** 2) / (2 * gap) <= reach
                    allowed[np.arange(len(frame)), own] = True
                else:
                    order = np.argsort(d, axis=1)[:, :probes]
                    allowed = np.zeros(d.shape, dtype=bool)
                    np.put_along_axis(allowed, order, True, axis=1)
                row, cell = np.nonzero(allowed)
                low = np.floor(np.maximum(d[row, cell] - reach, 0) / ring).astype("int32")
                high = np.floor((d[row, cell] + reach) / ring).astype("int32")
                width = high - low + 1
                at = np.repeat(np.arange(len(row)), width)
                step = np.arange(len(at)) - np.repeat(np.cumsum(width) - width, width)
                code = cell[at] * self.RINGS + low[at] + step
                order = row[at]
                bounds = np.searchsorted(order, np.arange(len(frame) + 1))
                cells = [code[bounds[i]:bounds[i + 1]].astype("int32") for i in range(len(frame))]
                if placed is not None:
                    found = placed.value
                    cells = [np.unique(found[c[c < len(found)]]) for c in cells]
                    cells = [c[c >= 0] for c in cells]
                yield frame.assign(cells=cells)

        return rows.mapInPandas(visit, "id bigint, vector array<double>, cells array<int>")


def _shelved(cell: np.ndarray, n: np.ndarray, most: int, whole: bool) -> np.ndarray:
    """A shelf for each cell (in order, with its number of rows): neighbours share one up to `most` rows, with `whole` only
    those of one pivot."""
    shelf, held, last = np.zeros(len(cell), dtype=np.int32), 0, -1
    for i, (pivot, rows) in enumerate(zip((cell // Cells.RINGS).tolist(), n.tolist(), strict=True)):
        new = i and (held + rows > most or (whole and pivot != last))
        shelf[i] = shelf[i - 1] + bool(new) if i else 0
        held, last = rows + (0 if new else held), pivot
    return shelf


def _sketched(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Short single-precision rows x and y for unit rows a and b, and a limit: where `x @ y.T` is below it, `a @ b.T` is below the threshold.

    The rows are turned to the directions that are longest in a sample of b. The first k numbers are kept, and the length of the
    rest: by Cauchy and Schwarz two rests add no more than the product of their lengths. The smallest k that rules out
    nearly all of a sample's pairs is taken, at worst all numbers. The limit allows for all rounding. None where there
    is little to compare or to rule out.
    """
    width = b.shape[1]
    if len(a) * len(b) < SKETCH_PAIRS:
        return None

    def some(rows: np.ndarray, n: int) -> np.ndarray:
        return rows[::-(-len(rows) // n)]

    sample = some(b, 1_024)
    turn = np.linalg.eigh(sample.T @ sample)[1][:, ::-1]
    x, y = some(a, 512) @ turn, some(b, 512) @ turn
    most = (x @ y.T >= threshold).mean()
    if most > 1 / 32:
        return None
    head, k = np.zeros((len(x), len(y))), 0
    while k < width:
        head += x[:, k:k + 16] @ y[:, k:k + 16].T
        k = min(k + 16, width)
        rest = np.outer(*(np.sqrt((m[:, k:] ** 2).sum(axis=1)) for m in (x, y)))
        if (head + rest >= threshold).mean() <= most + 2e-4:
            break

    def short(rows: np.ndarray) -> np.ndarray:
        out = np.empty((len(rows), k + (k < width)), dtype="float32")
        for lo in range(0, len(rows), 4_096):
            out[lo:lo + 4_096, :k] = kept = rows[lo:lo + 4_096] @ turn[:, :k]
            if k < width:  # never less than the true length of the rest
                out[lo:lo + 4_096, k] = np.sqrt(np.maximum(1.0 - (kept ** 2).sum(axis=1), 0.0) + 1e-13)
        return out

    return short(a), short(b), threshold - (k + 16) * 2.0 ** -22


def _block_best(q_id, a, c_id, b, threshold, earlier, exclude_self) -> pd.DataFrame:
    """`_row_best` of unit rows a and b, both in id order: a few rows at once, and only those pairs exactly that sketches don't rule out."""
    sketch, step, found = _sketched(a, b, threshold), max(1, HELD_NUMBERS // len(b)), []
    for lo in range(0, len(a), step):
        rows = np.arange(lo, min(lo + step, len(a)))
        cols = slice(0, int(np.searchsorted(c_id, q_id[rows[-1]])) if earlier else len(b))
        if cols.stop and sketch is not None:
            x, y, limit = sketch
            bound = x[rows] @ y[cols].T
            near = bound.max(axis=1) >= limit
            rows, cols = rows[near], np.flatnonzero((bound[near] >= limit).any(axis=0))
        if len(rows) and len(c_id[cols]):
            found.append(_row_best(
                q_id[rows], c_id[cols], np.round(a[rows] @ b[cols].T, PLACES), threshold, earlier, exclude_self))
    return pd.concat(found) if found else pd.DataFrame({"id": [], "match_id": [], "similarity": []})


def compare_cells(stored: DataFrame, queries: DataFrame, cells: Cells, reach: float, probes: int | None, threshold: float,
                  earlier: bool = False, exclude_self: bool = False) -> DataFrame:
    """The best row of the stored table `(id, vector, cell)` in the cells that each query `(id, vector)` visits.

    Cells travel on shelves of bounded size, so a query is sent once to a shelf, whichever of its cells
    it visits. What else is there cannot be a result: it is farther than `reach`, or was ruled out by the
    bounds; with `probes`, a shelf holds rings of one pivot only.
    """
    spark = stored.sparkSession
    # At most pivots x rings rows.
    sizes = stored.groupBy("cell").agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).orderBy("cell").toPandas()
    if sizes.empty:
        return spark.createDataFrame([], RESULT)
    width = max(1, int(sizes.width.max()))
    most = max(1, min(SHELF_ROWS, SHELF_NUMBERS // width))
    sizes["shelf"] = _shelved(sizes.cell.to_numpy(), sizes.n.to_numpy(), most, probes is not None)
    places = np.full(int(sizes.cell.max()) + 1, -1, dtype=np.int32)
    places[sizes.cell] = sizes.shelf
    asking = stage(cells.visited(queries, reach, probes, places), "visits")
    visits = asking.select("id", "vector", F.explode("cells").alias("shelf"))
    asked = visits.groupBy("shelf").agg(F.ceil(F.count("*") / most).cast("int").alias("nq")).toPandas()
    if asked.empty:
        return spark.createDataFrame([], RESULT)
    held = sizes.groupby("shelf").n.sum()
    asked["nc"] = -(-held.loc[asked.shelf].to_numpy() // most)
    blocks = F.broadcast(spark.createDataFrame(asked.astype("int32")[["shelf", "nq", "nc"]], "shelf int, nq int, nc int"))
    shelf_of = F.broadcast(spark.createDataFrame(sizes[["cell", "shelf"]].astype("int32"), "cell int, shelf int"))

    def spread(df: DataFrame, mine: str, other: str, own_n: str, other_n: str) -> DataFrame:
        return (
            df.join(blocks, "shelf")
            .withColumn(mine, F.pmod(F.xxhash64("id"), F.col(own_n)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)))
            .select("shelf", "bq", "bc", F.col("id").alias("id"), F.col("vector").alias("vector"))
        )

    def compare(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"id": [], "match_id": [], "similarity": []})
        q, c = q.sort_values("id"), c.sort_values("id")
        a, b = np.stack(q.vector.to_numpy()), np.stack(c.vector.to_numpy())
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b /= np.linalg.norm(b, axis=1, keepdims=True)
        return _block_best(q.id.to_numpy(), a, c.id.to_numpy(), b, threshold, earlier, exclude_self)

    keys = ["shelf", "bq", "bc"]
    best = (
        spread(visits, "bq", "bc", "nq", "nc").groupBy(*keys)
        .cogroup(spread(stored.join(shelf_of, "cell"), "bc", "bq", "nc", "nq").groupBy(*keys))
        .applyInPandas(compare, RESULT)
    )
    return _best(best)


# --- one query ---------------------------------------------------------------------------------


def similarity_to(table: DataFrame, query: DataFrame, vector: str) -> DataFrame:
    """`table` with `query_id` and `similarity` to the one row of `query` `(id, vector)`.

    The single query row travels as a scalar subquery. The generator keeps the subquery out of the
    array functions, where Spark does not accept one.
    """
    one = query.select(F.struct("id", "vector")).scalar()
    asked = with_computed(table.where(has_direction(F.col(vector))), _q=one).where(F.col("_q").isNotNull())
    similarity = F.round(cosine(F.col(vector), F.col("_q.vector")), PLACES)
    scored = asked.withColumns({"query_id": F.col("_q.id"), "similarity": similarity}).drop("_q")
    return scored.where(F.col("similarity").isNotNull())


def nearest_to(table: DataFrame, query: DataFrame, vector: str, columns: list[str],
               threshold: float = -1.0, exclude_self: bool = True) -> DataFrame:
    """The row of `table` nearest to the one row of `query`, if similar enough: one pass and a top-1."""
    scored = similarity_to(table, query, vector)
    if exclude_self:
        scored = scored.where(F.col("id") != F.col("query_id"))
    return (
        scored.where(F.col("similarity") >= threshold)
        .select("query_id", *columns, "similarity")
        .orderBy(F.desc("similarity"), "id").limit(1)
    )
