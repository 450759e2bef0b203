"""Scores as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the ranked score.
K1, K2, B = 1.2, 100.0, 0.75
TEXT_SHARE, RANK_SHARE = 0.9, 0.1
TEXT_SCALE, RANK_SCALE = 100.0, 1000.0


@dataclass(frozen=True)
class Boosts:
    """Factors for an exact, in-order, all-terms and partial match, and the field weight."""

    exact: float
    in_order: float
    all_terms: float
    partial: float
    weight: float


# Boosts by field (0 title, 1 content, 2 categories). The content factors are the
# single-precision values of 1.2 and 1.05.
RANKED_BOOSTS = {
    0: Boosts(20.0, 10.0, 5.0, 1.0, 1.0),
    1: Boosts(2.0, 1.2000000476837158, 1.0499999523162842, 1.0, 0.5),
    2: Boosts(20.0, 10.0, 5.0, 1.0, 1.0),
}


@dataclass(frozen=True)
class ClauseBoosts:
    """Full-text clause factors: phrase, all terms, any term, and the field weight."""

    phrase: float
    all_terms: float
    any_term: float
    weight: float


FULLTEXT_BOOSTS = {
    0: ClauseBoosts(20.0, 5.0, 1.0, 1.0),
    1: ClauseBoosts(2.0, 1.0499999523162842, 1.0, 0.5),
    2: ClauseBoosts(20.0, 5.0, 1.0, 1.0),
}


def query_weight(n_docs: Column, df: Column, qf: Column) -> Column:
    """Part of the ranked term score that depends on query and corpus only."""
    rarity = F.ln((n_docs - df + 0.5) / (df + 0.5))
    return rarity + F.ln((K2 + 1) * qf / (K2 + qf))


def length_norm(field_len: Column, avg_len: Column) -> Column:
    return K1 * ((1 - B) + B * field_len / avg_len)


def tf_part(tf: Column, norm: Column) -> Column:
    """Term-frequency part of the ranked score: a logarithm, added to the query weight."""
    return F.ln((K1 + 1) * tf / (norm + tf))


def fulltext_idf(n_docs: Column, df: Column) -> Column:
    return F.ln(1 + (n_docs - df + 0.5) / (df + 0.5))


def fulltext_tf(tf: Column, norm: Column) -> Column:
    return tf * (K1 + 1) / (tf + norm)


def total(scores: Column) -> Column:
    """Sum of an array in a fixed order, so that the result does not depend on partitioning."""
    return F.aggregate(F.sort_array(scores), F.lit(0.0), lambda acc, s: acc + s)


def positions_of(entries: Column) -> Column:
    """Map term -> positions from an array of matched-term structs."""
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["term"], e["positions"])))


def pair_matches(positions: Column, terms: Column) -> Column:
    """Array of booleans, one per consecutive pair of ``terms``: do they stand next to each
    other, in order, somewhere in the field?"""

    def adjacent(i: Column) -> Column:
        first = F.try_element_at(positions, F.element_at(terms, i))
        second = F.try_element_at(positions, F.element_at(terms, i + 1))
        return F.coalesce(F.arrays_overlap(F.transform(first, lambda p: p + 1), second), F.lit(False))

    n = F.size(terms)
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), adjacent)).otherwise(
        F.array().cast("array<boolean>")
    )


def proximity_factor(
    n_matched: Column, n_distinct: Column, positions: Column, terms: Column, field_len: Column, boosts: Boosts
) -> Column:
    in_order = F.forall(pair_matches(positions, terms), lambda ok: ok)
    return (
        F.when(n_matched < n_distinct, F.lit(boosts.partial))
        .when(~in_order, F.lit(boosts.all_terms))
        .when(field_len == F.size(terms), F.lit(boosts.exact))
        .otherwise(F.lit(boosts.in_order))
    )


def phrase_starts(positions: Column, terms: Column) -> Column:
    """Positions at which ``terms`` stand one after another; empty if any term is missing."""
    shifted = F.transform(
        terms,
        lambda t, i: F.coalesce(
            F.transform(F.try_element_at(positions, t), lambda p: p - i), F.array().cast("array<int>")
        ),
    )
    return F.aggregate(
        F.slice(shifted, F.lit(2), F.greatest(F.size(terms) - 1, F.lit(0))),
        F.element_at(shifted, 1),
        lambda acc, nxt: F.array_intersect(acc, nxt),
    )


def rescale(value: Column, low: Column, high: Column, top: float) -> Column:
    """Min-max rescaling to 0..top; constant input gives ``top``."""
    return F.when(low == high, F.lit(top)).otherwise((value - low) / (high - low) * top)


def blended(text: Column, rank: Column) -> Column:
    return text * TEXT_SHARE + rank * RANK_SHARE


def score_text(total_score: Column, text: Column | None = None, rank: Column | None = None) -> Column:
    """Printed score with 8 decimals, with the breakdown where a rank took part."""
    if rank is None:
        return F.format_string("%.8f", total_score)
    return F.format_string(
        "%.8f (Normalized BM25 + Proximity: %.8f, Normalized PageRank: %.8f)", total_score, text, rank
    )
