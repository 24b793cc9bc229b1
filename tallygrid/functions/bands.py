"""Threshold labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def rate_band(c: Column | str, name: str, low: float, high: float) -> Column:
    rate = _col(c)
    return (
        F.when(rate.isNull(), F.lit(f"{name}_sem_valor"))
        .when(rate < low, F.lit(f"{name}_baixo"))
        .when(rate <= high, F.lit(f"{name}_medio"))
        .otherwise(F.lit(f"{name}_alto"))
    )


def rank_band(c: Column | str) -> Column:
    rank = _col(c)
    return (
        F.when(rank == 1, "rank_1_lider")
        .when(rank.between(2, 5), "rank_2_a_5")
        .when(rank.between(6, 10), "rank_6_a_10")
        .otherwise("rank_11_a_50")
    )


def share_band(c: Column | str) -> Column:
    share = _col(c)
    return (
        F.when(share >= 0.50, "50% ou mais")
        .when(share >= 0.30, "30% a 49,9%")
        .when(share >= 0.10, "10% a 29,9%")
        .when(share > 0, "menos de 10%")
        .otherwise("")
    )


def trend_label(first: Column | str, last: Column | str, tolerance: float = 0.03) -> Column:
    """Relative change beyond the tolerance; a series starting at zero can only grow."""
    start, end = _col(first), _col(last)
    change = (end - start) / F.nullif(F.abs(start), F.lit(0.0))
    return (
        F.when(start.isNull() | end.isNull(), "sem série suficiente")
        .when((start == 0) & (end > 0), "crescimento")
        .when(start == 0, "estável")
        .when(change > tolerance, "crescimento")
        .when(change < -tolerance, "queda")
        .otherwise("estável")
    )


def delta_label(c: Column | str, threshold: float = 0.02) -> Column:
    delta = _col(c)
    return (
        F.when(delta > threshold, "crescimento")
        .when(delta < -threshold, "queda")
        .otherwise("estavel/sem historico")
    )


def correlation_strength(c: Column | str) -> Column:
    size = F.abs(_col(c))
    return (
        F.when(size.isNull(), "baixa/instavel")
        .when(size >= 0.75, "forte")
        .when(size >= 0.45, "moderada")
        .when(size >= 0.20, "fraca")
        .otherwise("baixa/instavel")
    )


def crystallisation_level(c: Column | str) -> Column:
    value = _col(c)
    return (
        F.when(value.isNull(), "sem dados")
        .when(value >= 0.65, "alto")
        .when(value >= 0.40, "médio")
        .otherwise("baixo")
    )


def elected_status(status: Column | str) -> Column:
    """Status text to eleito / nao_eleito / outro; substitutes count as not elected."""
    low = F.lower(F.trim(F.coalesce(_col(status).cast("string"), F.lit(""))))
    negative = low.rlike("n[aã]o eleito|suplente")
    return (
        F.when(negative, "nao_eleito").when(F.contains(low, F.lit("eleito")), "eleito").otherwise("outro")
    )


def elected_by_rank(rank: Column | str) -> Column:
    return F.when(_col(rank) == 1, "vencedor_ranking").otherwise("nao_vencedor_ranking")


def outcome(rank: Column | str = "rank_entidade") -> Column:
    return F.when(_col(rank) == 1, "vencedor").otherwise("nao_vencedor")


def outcome_group(rank: Column | str = "rank_entidade") -> Column:
    return F.when(_col(rank) == 1, "ganhou").otherwise("perdeu")
