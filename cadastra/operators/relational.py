"""Relational building blocks: first-by-order, prefix joins, unpivot, mutual best, cascades, upserts, deciles, rollups."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Largest dimension, in counted rows, that is broadcast by request; larger ones join by shuffle.
DIMENSION_ROWS = 100_000


def cut(df: DataFrame) -> DataFrame:
    """A Parquet copy in the shared checkpoint folder: ends the lineage, and later readings all see the same rows and partitions."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="cadastra-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dimension(df: DataFrame) -> DataFrame:
    """A side that is broadcast only if a bounded count proves it small."""
    return F.broadcast(df) if df.limit(DIMENSION_ROWS + 1).count() <= DIMENSION_ROWS else df


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by an order that must be total; Spark prunes each task's rows by the same window before the shuffle
    (a filter on row_number becomes a window group limit)."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def longest_prefix(df: DataFrame, code: str, rules: DataFrame, prefix: str, least: int, most: int, on: Sequence[str] = ()) -> DataFrame:
    """df with the rule whose prefix of the code is longest (null columns without one). The code is expanded into its prefixes, which
    meet the rules by an equi-join; rules are unique by (on, prefix). df needs a column _id that tells its rows apart."""
    lengths = F.sequence(F.lit(least), F.least(F.lit(most), F.length(code)))
    tried = df.where(F.length(code) >= least).select("_id", *on, F.explode(F.transform(lengths, lambda n: F.left(F.col(code), n))).alias(prefix))
    found = tried.join(dimension(rules), [*on, prefix])
    payload = [c for c in rules.columns if c not in on]
    best = found.groupBy("_id").agg(F.max(F.struct(F.length(prefix).alias("_n"), *payload)).alias("_best"))
    return df.join(best, "_id", "left").select(df["*"], *(F.col(f"_best.{c}").alias(c) for c in payload))


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], key: str = "key", value: str = "value") -> DataFrame:
    """Long form of the named columns, null values left out."""
    return df.unpivot(list(ids), list(values), key, value).where(F.col(value).isNotNull())


def mutual_best(pairs: DataFrame, left: str, right: str, score: str) -> DataFrame:
    """Pairs that are the best of both their sides (score, NaN first and null last as in SQL, then the smaller id): a grouped minimum for
    each side, which combines before it shuffles, and an equi-join of both."""
    rest = [c for c in pairs.columns if c not in (left, right, score)]
    worse = F.struct(F.col(score).isNull(), ~F.isnan(score), -F.col(score)).alias("_w")
    a = pairs.groupBy(left).agg(F.min(F.struct(worse, right, score, *rest)).alias("_a"))
    b = pairs.groupBy(right).agg(F.min(F.struct(worse, left)).alias("_b")).select(F.col(right).alias("_r"), F.col(f"_b.{left}").alias("_l"))
    both = a.join(b, (F.col(left) == F.col("_l")) & (F.col(f"_a.{right}") == F.col("_r")))
    return both.select(*(F.col(c) if c == left else F.col(f"_a.{c}").alias(c) for c in pairs.columns))


def mutual_nearest(left: DataFrame, right: DataFrame, left_id: str, right_id: str, on: Sequence[str], score: Column) -> DataFrame:
    """left_id, right_id, score of mutual_best over all pairs that agree in `on`, for a score of no columns but theirs, ids aside. Of rows
    that are equal but for their id only the smallest can be anyone's best, so that only these meet."""
    one = lambda df, key: df.groupBy(*(c for c in df.columns if c != key)).agg(F.min(key).alias(key))
    return mutual_best(one(left, left_id).join(one(right, right_id), list(on)).select(left_id, right_id, score.alias("score")), left_id, right_id, "score")


def mutual_closest(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, on: Sequence[str], value: str, score: Callable[[Column], Column], reach: Callable[[Column], Column]
) -> DataFrame:
    """left_id, right_id, score of mutual_best over all pairs that agree in `on`, for a score that never rises with the gap between both
    values; reach(score) is the largest gap with a score, but for rounding. Ids are of one type. No pairs are built but for the candidates.

    Both sides ask each other; of rows equal but for their id only the smallest counts. Places in the order of (on, value) show the two
    nearest values on either hand, and so the best score. Where the second has it too, all values within its reach have, and their
    smallest id comes from blocks of 1, 2, 4, … places that cover them; values at the very edge are scored one by one. Values without a
    place (null, NaN, infinite: at most four of a group) meet all others."""
    group, slots = ["_side", *on], range(4)
    one = lambda df, key, side: df.dropna(subset=list(on)).groupBy(F.lit(side).alias("_side"), *on, F.col(value).cast("double").alias("_v")).agg(F.min(key).alias("_id"))
    rows = cut(one(left, left_id, 0).unionByName(one(right, right_id, 1)))
    ask = lambda df: df.withColumn("_side", 1 - F.col("_side"))
    usual = F.coalesce(F.abs("_v") < F.lit(float("inf")), F.lit(False))
    targets = rows.where(usual).withColumn("_o", F.lit(1))
    score_of = lambda v: score(F.abs(F.col("_v") - v))

    def before(asked: DataFrame) -> DataFrame:
        """Targets and questions with the number of targets before them: at equal values _o 0 comes before targets, _o 2 after."""
        return running(targets.unionByName(asked, allowMissingColumns=True), [*(F.col(c) for c in group), F.col("_v"), F.col("_o")], (F.col("_o") == 1).cast("long"))[0]

    ranked = before(ask(targets).withColumn("_o", F.lit(0)))
    at = F.explode(F.array(*(F.struct((F.col("before") + 2 - k).alias("before"), F.lit(k).alias("_k")) for k in slots))).alias("_at")
    near = ranked.where("_o = 1").select(*group, F.col("_v").alias("_t"), F.col("_id").alias("_m"), at).select(*group, "_t", "_m", "_at.*")
    near = near.groupBy(*group, "before").agg(*(F.max(F.when(F.col("_k") == k, F.col(c))).alias(f"{c}{k}") for k in slots for c in ("_t", "_m")))
    near = ranked.where("_o = 0").select(*group, "_v", "_id", "before").join(near, [*group, "before"])
    near = near.select("*", *(score_of(F.col(f"_t{k}")).alias(f"_s{k}") for k in slots)).withColumn("_score", F.greatest("_s1", "_s2"))
    more = F.coalesce(F.col("_s0") == F.col("_score"), F.lit(False)) | F.coalesce(F.col("_s3") == F.col("_score"), F.lit(False))
    mate = F.least(*(F.when(F.col(f"_s{k}") == F.col("_score"), F.col(f"_m{k}")) for k in (1, 2)))
    near = cut(near.select(*group, "_v", "_id", "_score", mate.alias("_mate"), more.alias("_more")))
    found = [near.where("not _more")]
    if not (tied := near.where("_more")).isEmpty():
        found.append(_smallest_within(tied, before, group, score_of, reach))
    if not (odd := rows.where(~usual)).isEmpty():
        other = lambda df: df.select(*group, F.col("_v").alias("_w"), F.col("_id").alias("_mate"))
        met = [ask(rows).join(dimension(other(odd)), group), other(targets).join(dimension(ask(odd)), group)]
        found += [x.withColumn("_score", score_of(F.col("_w"))) for x in met]
    # questions of the left side stand in the groups of the right side
    pairs = reduce(DataFrame.unionByName, (x.select("_side", "_id", "_mate", "_score") for x in found))
    ids = [F.when(F.col("_side") == k, F.col("_id")).otherwise(F.col("_mate")).cast(df.schema[key].dataType).alias(key) for k, df, key in ((1, left, left_id), (0, right, right_id))]
    return mutual_best(pairs.select(*ids, F.col("_score").alias("score")), left_id, right_id, "score")


def _smallest_within(tied: DataFrame, before: Callable[[DataFrame], DataFrame], group: Sequence[str], score_of: Callable[[Column], Column], reach: Callable[[Column], Column]) -> DataFrame:
    """tied with _mate, the smallest id of the targets that have the score, for mutual_closest. Sums and quotients of doubles are off by
    less than the slack: what is nearer than reach by it has the score, what is farther has not."""
    far, question = reach(F.col("_score")), [*group, "_at", "_id", "_score"]
    slack = F.when(far < F.lit(float("inf")), 4e-15 * (1 + far + F.abs("_v"))).otherwise(0.0)
    ends = [(F.col("_v") - far - slack, 0), (F.col("_v") - far + slack, 0), (F.col("_v") + far - slack, 2), (F.col("_v") + far + slack, 2)]
    ends = F.explode(F.array(*(F.struct(v.alias("_v"), F.lit(o).alias("_o"), F.lit(k).alias("_k")) for k, (v, o) in enumerate(ends)))).alias("_e")
    ranked = before(tied.select(*group, F.col("_v").alias("_at"), "_id", "_score", ends).select(*question, "_e.*"))
    spans = ranked.where("_o <> 1").groupBy(*question).agg(*(F.max(F.when(F.col("_k") == k, F.col("before"))).alias(x) for k, x in enumerate(("_a", "_l", "_h", "_b"))))
    spans = cut(spans.withColumn("_sure", F.col("_l") < F.col("_h")))
    levels = (spans.where("_sure").agg(F.max(F.col("_h") - F.col("_l"))).first()[0] or 1).bit_length()
    block = lambda n, k: F.floor(n / F.pow(F.lit(2.0), k))
    run = lambda a, b: F.when(F.col(a) < F.col(b), F.transform(F.sequence(a, F.col(b) - 1), lambda n: F.struct(F.lit(0).alias("_level"), n.alias("_block")))).otherwise(F.array())

    def cover(k: Column) -> Column:
        """The blocks of a level that the span holds and no block of the next level in it does."""
        low, high = block(F.col("_l") + F.pow(F.lit(2.0), k) - 1, k), block(F.col("_h"), k)
        odd = [F.when((low < high) & (n % 2 == 1), F.struct(k.alias("_level"), m.alias("_block"))) for n, m in ((low, low), (high, high - 1))]
        return F.array_compact(F.array(*odd))

    sure = F.concat(run("_a", "_l"), F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), cover)), run("_h", "_b"))
    asked = spans.select(*question, F.explode(F.when(F.col("_sure"), sure).otherwise(run("_a", "_b"))).alias("_e")).select(*question, "_e.*")
    level = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("_level")
    blocks = ranked.where("_o = 1").select("before", F.col("_v").alias("_t"), F.col("_id").alias("_mate"), level).withColumn("_block", block(F.col("before"), F.col("_level")))
    blocks = blocks.groupBy("_level", "_block").agg(F.min("_mate").alias("_mate"), F.min("_t").alias("_t"))
    met = asked.withColumnRenamed("_at", "_v").join(blocks, ["_level", "_block"]).where((F.col("_level") > 0) | (score_of(F.col("_t")) == F.col("_score")))
    return met.groupBy(*group, "_v", "_id", "_score").agg(F.min("_mate").alias("_mate"))


def candidates(left: DataFrame, right: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """Pairs that agree on at least one of several key sets: an equi-join each and a distinct union, instead of an OR condition that
    only a nested loop could run."""
    joined = [left.join(right, list(k)).select("left_id", "right_id") for k in keys]
    return reduce(DataFrame.unionByName, joined).distinct()


def cascade(targets: DataFrame, key: str, levels: Sequence[tuple[str, DataFrame, Sequence[str]]], value: str) -> DataFrame:
    """key, level, value: for each target the first level whose relation (unique on its join columns) has a match; null without one.
    All levels join as left joins and one coalesce decides, so the targets are read once."""
    out = targets
    for k, (_, relation, on) in enumerate(levels):
        out = out.join(relation.select(*on, F.col(value).alias(f"_v{k}")), list(on), "left")
    level = F.coalesce(*(F.when(F.col(f"_v{k}").isNotNull(), F.lit(name)) for k, (name, _, _) in enumerate(levels)))
    return out.select(key, level.alias("level"), F.coalesce(*(F.col(f"_v{k}") for k in range(len(levels)))).alias(value))


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str], version: str | None = None) -> DataFrame:
    """old with the rows of new: a new row replaces the old one where its version isn't older; its null values keep the old ones."""
    a, b = old.alias("a"), new.alias("b")
    joined = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key], "full")
    newer = F.col(f"b.{key[0]}").isNotNull()
    if version:
        newer &= F.col(f"a.{version}").isNull() | (F.col(f"b.{version}") >= F.col(f"a.{version}"))
    cols = [F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) if c in key else F.when(newer, F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}"))).otherwise(F.col(f"a.{c}")).alias(c) for c in old.columns]
    return joined.select(*cols)


def insert_ignore(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """old, and of new the rows whose key is not there yet; of several new rows with one key the smallest."""
    rest = [c for c in new.columns if c not in key]
    one = new.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_r")).select(*key, *(F.col(f"_r.{c}").alias(c) for c in rest)) if rest else new.distinct()
    return old.unionByName(one.join(old.select(*key), list(key), "left_anti"))


def deciles(df: DataFrame, order: Sequence[Column], parts: int = 10) -> DataFrame:
    """df with `decile`, equal-count slices of the given total order: ceil(parts * place / rows)."""
    placed, n = places(df, order)
    return placed.withColumn("decile", F.ceil(F.lit(parts) * F.col("place") / F.lit(n)).cast("int"))


def running(df: DataFrame, order: Sequence[Column], value: Column) -> tuple[DataFrame, float]:
    """df with `before`, the sum of a value over all rows before it in a total order, and the whole sum. Rows are dealt by range and
    written once; each task adds up its own range, and the sums before it join in from a table of one row a range."""
    ranged = cut(df.withColumn("_value", value).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sums = ranged.groupBy("_part").agg(F.sum("_value").alias("_s"))
    first = F.sum("_s").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    base = cut(sums.select("_part", F.coalesce(first, F.lit(0)).alias("_base"), "_s"))
    total = base.agg(F.sum("_s")).first()[0] or 0
    within = F.sum("_value").over(W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    placed = ranged.withColumn("before", F.coalesce(within, F.lit(0))).join(dimension(base.drop("_s")), "_part")
    return placed.withColumn("before", F.col("_base") + F.col("before")).drop("_part", "_value", "_base"), total


def places(df: DataFrame, order: Sequence[Column]) -> tuple[DataFrame, int]:
    """df with `place`, its 1-based place in a total order over the whole table, and the number of rows."""
    out, n = running(df, order, F.lit(1).cast("long"))
    return out.withColumn("place", F.col("before") + 1).drop("before"), n


def auc(df: DataFrame, score: str, positive: str) -> DataFrame:
    """One row with n, positives and auc (mean ranks for ties, null without both classes). Ties are counted per distinct score first;
    the ranks of those are running sums over ranges."""
    g = df.groupBy(score).agg(F.count(F.lit(1)).alias("c"), F.sum(F.col(positive).cast("long")).alias("p"))
    placed, _ = running(g, [F.col(score)], F.col("c"))
    t = placed.agg(F.sum("c").alias("n"), F.sum("p").alias("positives"), F.sum(F.col("p") * (F.col("before") + (F.col("c") + 1) / 2.0)).alias("r"))
    p, q = F.col("positives"), F.col("n") - F.col("positives")
    return t.select("n", "positives", F.when((p > 0) & (q > 0), F.round((F.col("r") - p * (p + 1) / 2.0) / (p * q), 4)).alias("auc"))


def hash_sample(df: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """The n rows whose hashed key comes first: the same sample in every run (a top-k, no full sort)."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))), key).limit(n)


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: mean over rows with a value; null without any weight."""
    return F.sum(value * weight) / F.nullif(F.sum(F.when(value.isNotNull(), weight)), F.lit(0))


def or_empty(df: DataFrame | None, spark, schema: str) -> DataFrame:
    """An optional input, or an empty table of its schema so that left joins still work."""
    return spark.createDataFrame([], schema) if df is None else df


def percentiles(df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """keys and interpolated percentiles of a value. Equal values are counted before they shuffle, so a group's memory is that of its
    distinct values."""
    x = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    return x.groupBy(*keys).agg(*(F.percentile(value, F.lit(p), F.col("_c")).alias(name) for name, p in shares.items()))


def json_object(key: Column | str, value: Column | str) -> Column:
    """Aggregate: a JSON object of a group's keys and values, by key."""
    return F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value)))))


def split_sample(df: DataFrame, key: str, seed: str, n: int) -> tuple[DataFrame, DataFrame]:
    """The same n rows in every run, by hashed key, and all others."""
    sample = cut(hash_sample(df, key, seed, n))
    return sample, df.join(dimension(sample.select(key)), key, "left_anti")
