"""The fact table: cleaned, repaired, keyed and classified articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaceta.functions import dates, text
from gaceta.operators import clean
from gaceta.operators.classify import assign_region
from gaceta.operators.keys import lookup_ids
from gaceta.params import Params
from gaceta.schema import FACT_SCHEMA


def build_fact(
    raw: DataFrame, dates_dim: DataFrame, sources_dim: DataFrame, params: Params = Params(),
    left_out: DataFrame | None = None, region_ids: dict[str, int] | None = None,
    region_version: int = 1,
) -> DataFrame:
    """Fact rows plus ``year`` and ``month``.

    ``raw`` is read twice (keys only, then whole rows), or once if ``left_out``
    (article_id, _seq), a materialised table, names the rows that are not to be loaded. The
    two dimensions must be materialised tables; their size decides how they are joined.
    """
    if left_out is None:
        cleaned = clean.clean_articles(raw)
    else:
        cleaned = clean.parse_dates(clean.without_rows(clean.reject_null_keys(raw), left_out))
    repaired = cleaned.withColumns({
        "title": text.repair(F.col("title")),
        "body": text.repair(F.col("body")),
        "fecha": (
            dates.iso_day(F.col("pub_date")) if params.canonical_dates else F.col("publish_date")
        ),
        "source": F.lower("source"),
    })
    keyed = lookup_ids(repaired, dates_dim, "fecha", "date_id")
    keyed = lookup_ids(keyed, sources_dim, "source", "source_id")
    placed = assign_region(keyed, params=params.regions, region_ids=region_ids)
    return placed.withColumns({
        "region_version": F.lit(region_version),
        "title_word_count": text.word_count(F.col("title")),
        "body_word_count": text.word_count(F.col("body")),
    }).select(
        *[F.col(f.name).cast(f.dataType) for f in FACT_SCHEMA.fields], "year", "month",
    )
