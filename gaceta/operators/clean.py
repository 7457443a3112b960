"""Row rejection: missing keys, repeated articles, unreadable dates, and their tally."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaceta import session
from gaceta.functions import dates
from gaceta.params import NA_TOKENS

KEY_COLUMNS = ("article_id", "publish_date")


def null_na_tokens(df: DataFrame, columns: list[str], na_tokens: tuple[str, ...] = NA_TOKENS) -> DataFrame:
    """Turn the spellings of a missing value into null."""
    return df.withColumns({c: F.when(~F.col(c).isin(*na_tokens), F.col(c)) for c in columns})


def reject_null_keys(df: DataFrame, keys: tuple[str, ...] = KEY_COLUMNS) -> DataFrame:
    return df.na.drop(subset=list(keys))


def later_copies(
    df: DataFrame, key: str = "article_id", seq: str = "_seq",
    limit: int = session.BROADCAST_BYTES,
) -> DataFrame:
    """(key, seq) of the rows that another row of their key precedes.

    Only these two columns are read. Keys are counted with partial aggregation, which folds
    a hot key to one row per task, and the few that repeat are joined back.
    """
    narrow = df.select(key, seq)
    repeated = session.materialize(
        narrow.where(F.col(key).isNotNull()).groupBy(key)
        .agg(F.min(seq).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .where("_copies > 1").select(key, "_first"))
    found = session.lookup_join(narrow, repeated, key, spread=seq, how="inner", limit=limit)
    return found.where(F.col(seq) > F.col("_first")).select(key, seq).distinct()


def keep_first(
    df: DataFrame, key: str = "article_id", seq: str = "_seq",
    limit: int = session.BROADCAST_BYTES,
) -> DataFrame:
    """Rows of ``df`` without later copies: those another row of their key precedes.

    Positions are meant to be unique and not null. If they are not: rows that tie for the
    first place of a key all stay, and so do rows without a position. Rows without a key
    copy nothing and stay. The copies are few next to the rows, so they are the build side:
    broadcast if they measure small, or else hashed after one shuffle by (key, position),
    which spreads evenly however the keys are distributed.
    """
    return without_rows(df, session.materialize(later_copies(df, key, seq, limit)), key, seq, limit)


def without_rows(
    df: DataFrame, rows: DataFrame, key: str = "article_id", seq: str = "_seq",
    limit: int = session.BROADCAST_BYTES,
) -> DataFrame:
    """``df`` less the (key, seq) of ``rows``, a materialised table that is the build side."""
    small = session.fits_broadcast(rows, limit)
    return df.join(rows.hint("broadcast" if small else "shuffle_hash"), [key, seq], "left_anti") \
        .select(*df.columns)


def parse_dates(df: DataFrame) -> DataFrame:
    """Add ``pub_date``, ``year``, ``month``; drop rows whose date cannot be read."""
    return (
        df.withColumn("pub_date", dates.parse_day(F.col("publish_date")))
        .where(F.col("pub_date").isNotNull())
        .withColumn("year", F.year("pub_date"))
        .withColumn("month", F.month("pub_date"))
    )


def clean_articles(raw: DataFrame) -> DataFrame:
    """Rejection in its fixed order: null keys, then repeats, then dates."""
    return parse_dates(keep_first(reject_null_keys(raw)))


def repeats_elsewhere(
    cleaned: DataFrame, known: DataFrame, replaced: DataFrame | None = None,
) -> DataFrame:
    """(article_id, _seq) of cleaned rows whose article the warehouse holds in another month.

    ``known`` (article_id, year, month) says where it is held. Months that are ``replaced``
    (year, month) hold nothing any more once the run is through.
    """
    if replaced is not None:
        known = known.join(F.broadcast(replaced), ["year", "month"], "left_anti")
    held = known.select("article_id", F.struct("year", "month").alias("_held"))
    apart = F.col("_held") != F.struct("year", "month")
    return cleaned.join(held, "article_id").where(apart).select("article_id", "_seq").distinct()


def rejection_counts(
    raw: DataFrame, malformed: str | None = None, padded: str | None = None,
) -> DataFrame:
    """One row of counters; raw = written + the four reasons for leaving a row out.

    ``malformed`` and ``padded`` name flag columns; padded lines count as any other row and
    are reported on the side.
    Grouping by article id and keeping only whether the first copy's date can be read
    gives the result of the whole rejection without touching the text.
    """
    flag = lambda name: F.col(name) if name else F.lit(False)
    bad_line = flag(malformed)
    usable = ~bad_line & F.col("article_id").isNotNull() & F.col("publish_date").isNotNull()
    per_article = (
        raw.select(
            F.when(usable, F.col("article_id")).alias("_id"),
            bad_line.alias("_bad_line"),
            flag(padded).alias("_padded"),
            dates.parse_day(F.col("publish_date")).isNotNull().alias("_dated"),
            "_seq",
        )
        .groupBy("_id")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count_if("_bad_line").alias("_bad_lines"),
            F.count_if("_padded").alias("_padded"),
            F.min_by("_dated", "_seq").alias("_dated"),
        )
    )
    kept = F.col("_id").isNotNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per_article.agg(
        total("_rows").alias("raw_rows"),
        total("_bad_lines").alias("malformed"),
        total(F.when(~kept, F.col("_rows") - F.col("_bad_lines"))).alias("skipped_null"),
        total(F.when(kept, F.col("_rows") - 1)).alias("skipped_dup"),
        F.count_if(kept & ~F.col("_dated")).alias("bad_date"),
        F.count_if(kept & F.col("_dated")).alias("written"),
        total("_padded").alias("padded"),
    )
