"""Settings of one monthly close."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

DOCUMENTED = "documentado"
AS_CODED = "codigo"


@dataclass(frozen=True)
class RunConfig:
    """Dates and switches shared by every step of a close.

    ``modo`` chooses between the documented formulas (the default) and the legacy
    program's literal behaviour where the two disagree.
    """

    fecha_valoracion: date
    fecha_transicion: date = date(2024, 12, 31)
    moneda_local: str = "COP"
    linea_financiada: str = "003"
    lineas_matematica: tuple[str, ...] = ("092", "095", "196")
    modo: str = DOCUMENTED

    def __post_init__(self) -> None:
        if self.modo not in (DOCUMENTED, AS_CODED):
            raise ValueError(f"modo must be {DOCUMENTED!r} or {AS_CODED!r}, not {self.modo!r}")

    @property
    def as_coded(self) -> bool:
        return self.modo == AS_CODED

    @property
    def inicio_periodo(self) -> date:
        return self.fecha_valoracion.replace(day=1)

    @property
    def cierre_anterior(self) -> date:
        """Last day of the month before the valuation date."""
        return self.inicio_periodo - timedelta(days=1)

    @property
    def mes_valoracion(self) -> int:
        return self.fecha_valoracion.year * 100 + self.fecha_valoracion.month

    @property
    def mes_anterior(self) -> int:
        return self.cierre_anterior.year * 100 + self.cierre_anterior.month
