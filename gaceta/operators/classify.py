"""Region of an article by weighted gazetteer hits."""

from __future__ import annotations

import re
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaceta.functions.text import fold
from gaceta.params import RegionParams


def alias_pattern(aliases: tuple[str, ...]) -> str:
    """Whole-word alternation; counted leftmost first, so overlapping aliases hit once."""
    return r"\b(?:" + "|".join(re.escape(a) for a in aliases) + r")\b"


def mention_pattern(params: RegionParams) -> str | None:
    """Runs of words that occur in aliases, joined the way alias words are joined.

    Every alias hit lies inside one such run, so scoring the runs instead of the text gives
    the same hits from far fewer characters. None if an alias is not words and gaps.
    """
    aliases = [a for name in params.scored for a in params.gazetteer[name]]
    if not all(re.fullmatch(r"\w+(?:\W+\w+)*", a, re.ASCII) for a in aliases):
        return None
    words = sorted({w for a in aliases for w in re.findall(r"\w+", a)})
    gaps = sorted({g for a in aliases for g in re.findall(r"\W+", a)})
    by_letter = [(letter, list(group)) for letter, group in groupby(words, key=lambda w: w[0])]
    tails = "|".join(letter + "(?:" + "|".join(w[1:] for w in ws) + ")" for letter, ws in by_letter)
    word = rf"(?:{tails})\b"
    start = rf"(?=[{''.join(letter for letter, _ in by_letter)}])\b"
    joined = "|".join(map(re.escape, gaps))
    return rf"{start}{word}(?:(?:{joined}){word})*" if gaps else start + word


def mentions(folded: Column, params: RegionParams) -> Column:
    """The parts of a folded text that can hold aliases, one per line."""
    pattern = mention_pattern(params)
    if pattern is None:
        return folded
    return F.array_join(F.regexp_extract_all(folded, F.lit(pattern), F.lit(0)), "\n")


def weighted_text(title: Column, body: Column, params: RegionParams) -> Column:
    """Each part as often as it weighs, so that one count over all gives the score."""
    line = lambda c: F.concat(c, F.lit("\n"))
    return F.concat(
        F.repeat(line(title), params.title_weight), F.repeat(line(body), params.body_weight))


def region_scores(text: Column, params: RegionParams) -> Column:
    """Array of the hits of every scored region in a weighted text."""
    return F.array(*[
        F.regexp_count(text, F.lit(alias_pattern(params.gazetteer[name])))
        for name in params.scored
    ])


def assign_region(
    df: DataFrame, title: str = "title", body: str = "body",
    params: RegionParams = RegionParams(), region_ids: dict[str, int] | None = None,
) -> DataFrame:
    """Add ``region_id`` and ``region_name``: the one best score, else the default.

    ``region_ids``: ids by name, if others than those by position are to be used.

    Score: title hits times ``title_weight`` plus hits in the first ``body_prefix``
    characters of the body times ``body_weight``.
    """
    names, ids = params.scored, region_ids or params.ids
    best = F.array_max("_scores")
    ahead = F.array_position("_scores", best)
    behind = F.array_position(F.reverse("_scores"), best)
    # First place from either end is the same place only if no other score ties.
    alone = (best > 0) & (ahead + behind == len(names) + 1)
    place = F.when(alone, ahead.cast("int")).otherwise(len(names) + 1)
    labels = [*names, params.default_label]
    start = F.substring(body, 1, params.body_prefix)
    weighted = weighted_text(
        mentions(fold(F.col(title)), params), mentions(fold(start), params), params)
    return (
        df.withColumn("_text", weighted)
        .withColumn("_scores", region_scores(F.col("_text"), params))
        .withColumns({
            "region_id": F.element_at(F.array(*[F.lit(ids[n]) for n in labels]), place),
            "region_name": F.element_at(F.array(*[F.lit(n) for n in labels]), place),
        })
        .drop("_text", "_scores")
    )
