"""Sentences stored next to the numbers. Fixed formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def percent(share: Column | str) -> Column:
    return F.concat(F.round(_col(share) * 100, 2).cast("string"), F.lit("%"))


def leading_profile(combo: Column | str, share: Column | str) -> Column:
    return F.concat(F.lit("Eleitor predominante: "), _col(combo), F.lit(" ("), percent(share), F.lit(")."))


def result_text(entity: str = "entidade") -> Column:
    won = F.concat(
        F.lit("Ganhou porque liderou a disputa em votos neste recorte: "), F.col(entity),
        F.lit(" teve "), percent("share_votos"), F.lit(" dos votos."),
    )
    lost = F.concat(
        F.lit("Perdeu porque ficou abaixo do lider por "),
        F.round(F.col("votos_lider") - F.col("votos"), 0).cast("string"),
        F.lit(" votos neste recorte."),
    )
    return F.when(F.col("rank_entidade") == 1, won).otherwise(lost)


def entity_profile_text() -> Column:
    opening = F.when(F.col("rank_entidade") == 1, "Perfil que ajudou a vitoria de ").otherwise(
        "Perfil associado a quem nao liderou em "
    )
    return F.concat(
        opening, F.col("tipo_entidade"), F.lit(" "), F.col("entidade"), F.lit(": "),
        F.col("perfil_combinado"), F.lit(" ("), percent("share_perfil_na_entidade"), F.lit(")."),
    )


def how_won(share: str = "share_vencedor", margin: str = "margem_share", abstention: str = "taxa_abstencao") -> Column:
    """Majority, margin and turnout remarks, those that apply."""
    size = (
        F.when(F.col(share) >= 0.50, "venceu com maioria absoluta dos votos da seção")
        .when(F.col(share) >= 0.35, "venceu com pluralidade competitiva")
        .when(F.col(share).isNotNull(), "venceu em disputa fragmentada")
    )
    gap = (
        F.when(F.col(margin) < 0.03, "margem muito apertada")
        .when(F.col(margin) < 0.10, "margem moderada")
        .when(F.col(margin).isNotNull(), "margem confortável")
    )
    turnout = F.when(F.col(abstention) >= 0.30, "abstenção alta no recorte").when(
        F.col(abstention) <= 0.12, "comparecimento alto no recorte"
    )
    text = F.concat_ws("; ", size, gap, turnout)
    return F.when(text == "", "sem base suficiente para descrever a vitória").otherwise(text)


def persona(combo: Column | str, party: Column | str | None = None) -> Column:
    text = F.concat(F.lit("Pessoa do cluster: "), _col(combo), F.lit("."))
    if party is None:
        return text
    name = F.coalesce(_col(party), F.lit(""))
    return F.when(
        name != "", F.concat(text, F.lit(" Tendencia partidaria: "), name, F.lit("."))
    ).otherwise(text)
