"""Column vocabulary shared by all operators.

Operators never spell key columns themselves: they take a `Spec` naming the period, the
place hierarchy, the contest keys and the profile dimensions.  `ELECTORAL` is the preset
whose names match the published silver and gold schemas.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Profile column -> label used inside a combined profile text.
PROFILE_LABELS = {
    "perfil_faixa_etaria": "faixa_etaria",
    "perfil_genero": "sexo_genero",
    "perfil_instrucao": "escolaridade",
    "perfil_estado_civil": "estado_civil",
    "perfil_raca_cor": "raca_cor",
}

TURNOUT = ("eleitorado", "comparecimento_estimado", "abstencao_estimado")
BALLOTS = ("votos", "brancos", "nulos", "validos_estimados")


@dataclass(frozen=True)
class Spec:
    """Which columns play which part."""

    period: str = "ano"
    state: str = "uf"
    place: str = "cd_municipio"
    place_name: str = "nm_municipio"
    zone: str = "zona"
    section: str = "secao"
    contest: tuple[str, ...] = ("cargo", "turno")
    party: str = "partido"
    candidate: str = "candidato"
    number: str = "nr_votavel"
    dims: dict[str, str] = field(default_factory=lambda: dict(PROFILE_LABELS))

    @property
    def place_keys(self) -> list[str]:
        return [self.period, self.state, self.place]

    @property
    def section_keys(self) -> list[str]:
        return [*self.place_keys, self.zone, self.section]

    @property
    def contest_keys(self) -> list[str]:
        return [*self.section_keys, *self.contest]

    @property
    def dim_columns(self) -> list[str]:
        return list(self.dims)

    @property
    def levels(self) -> dict[str, list[str]]:
        """Level name -> location columns that identify a row at that level."""
        return {"brasil": [], "estado": [self.state], "municipio": [self.state, self.place]}

    def level_scope(self, level: str) -> list[str]:
        return [self.period, *self.levels[level]]


ELECTORAL = Spec()
