"""Mixing sources to target weights: each document repeats a Poisson number of times.

Built-in expressions only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaceta import session

# A Poisson mean above this is drawn as a sum of independent parts, so that no term of the
# distribution underflows and no table of it is long.
PART_MEAN = 32.0
# Hex digits of the hash that make up a uniform number: 52 bits.
_DIGITS = 13


@dataclass(frozen=True)
class MixParams:
    # source -> weight; sources left out get nothing. None: weight rows ** exponent.
    weights: dict[str, float] | None = None
    exponent: float = 0.5
    # Expected rows of the mixture, as a multiple of the input rows.
    epochs: float = 1.0
    seed: int = 17
    # Sources as the result names them; a null source is mixed under this name.
    unnamed: str = field(default="")


def source_rates(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """(source, rate): the mean number of copies that gives each source its share."""
    rows = docs.groupBy(F.coalesce("source", F.lit(params.unnamed)).alias("source")).agg(
        F.count(F.lit(1)).alias("n"))
    if params.weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(params.exponent))
    else:
        pairs = [F.lit(x) for pair in params.weights.items() for x in pair]
        weight = (F.coalesce(F.create_map(*pairs)[F.col("source")], F.lit(0.0)).cast("double")
                  if pairs else F.lit(0.0))
    weighed = rows.withColumn("weight", weight)
    total = weighed.agg(F.struct(F.sum("n").alias("rows"), F.sum("weight").alias("weight"))).scalar()
    rate = F.when(F.col("weight") <= 0, 0.0).otherwise(
        F.col("weight") / total.getField("weight") * params.epochs * total.getField("rows") / F.col("n"))
    return weighed.select("source", rate.alias("rate"))


def poisson_table(rates: DataFrame) -> DataFrame:
    """(source, rate, parts, cdf): the distribution function of one part, from 0 upwards.

    It runs on until the rest of the probability is below the grain of a double.
    """
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_MEAN)).cast("int")
    part = F.col("part")
    last = F.ceil(part + 12 * F.sqrt(part) + 25).cast("int")
    start = F.struct(F.exp(-part).alias("p"), F.exp(-part).alias("c"),
                     F.array(F.exp(-part)).alias("a"))

    def add(acc: Column, k: Column) -> Column:
        p = acc.getField("p") * part / k
        c = acc.getField("c") + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(acc.getField("a"), F.array(c)).alias("a"))

    cdf = F.aggregate(F.sequence(F.lit(1), last), start, add, lambda acc: acc.getField("a"))
    return (
        rates.withColumn("parts", parts).withColumn("part", F.col("rate") / F.col("parts"))
        .select("source", "rate", "parts", cdf.alias("cdf")))


def uniform(doc_id: Column, part: Column, seed: int) -> Column:
    """A number in [0, 1) from the id, the part and the seed."""
    key = F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")),
                      part.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, _DIGITS), 16, 10).cast("double") / 2.0**52


def mix_sources(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """Rows of ``docs``, each as often as its Poisson draw says, in a random order.

    Adds ``copy`` (1, 2, ...; it replaces an input column of that name) and keeps all other
    columns as they are. The draw inverts the distribution at a number hashed from doc_id,
    so the same id and seed always give the same count; rows that repeat an id repeat its
    count. A row without id draws from a hash of its other columns. Null sources are mixed
    as one. An empty table gives an empty result. Rows move once: to a random task, and to a
    random place inside it, which ids, texts and copies decide, so rows without id or with
    one id spread as well.
    """
    table = session.materialize(poisson_table(source_rates(docs, params)))
    names = [c for c in docs.columns if c != "copy"]
    own = docs.select(F.struct(*names).alias("row"))
    row_id = F.coalesce(F.col("row.doc_id").cast("string"), F.md5(F.to_json("row")))
    keyed = own.withColumn("source", F.coalesce("row.source", F.lit(params.unnamed)))
    drawn = session.lookup_join(keyed, table, "source", spread=row_id)
    count = F.aggregate(
        F.sequence(F.lit(1), F.col("parts")), F.lit(0),
        lambda total, part: total + F.size(F.filter(
            F.col("cdf"), lambda c: c <= F.col("u")[part - 1])))
    draws = F.transform(F.sequence(F.lit(1), F.col("parts")),
                        lambda part: uniform(row_id, part, params.seed))
    copies = (
        drawn.where(F.col("rate") > 0).withColumn("u", draws).withColumn("n", count)
        .where("n > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")))
    text = [F.col("row").getField("text")] if "text" in names else []
    place = F.xxhash64(row_id, *text, "copy", F.lit(params.seed))
    return (
        copies.withColumn("place", place).repartition("place").sortWithinPartitions("place")
        .select(*[F.col("row").getField(c).alias(c) for c in names], "copy"))
