"""Column names and dimension members of a panel.

Operators never hard-code names; they read them from a ``PanelSpec``.
The defaults follow the naming of the labour-market panel the library was
designed for (entity = ``provincia``, period = ``periodo``, ...).
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PanelSpec:
    entity: str = "provincia"
    period: str = "periodo"
    year: str = "anio"
    area: str = "area"
    sex: str = "sexo"
    target: str = "tasa_desempleo"
    population: str = "poblacion_15_mas"
    labour_force: str = "pea"
    employed: str = "ocupados"
    unemployed: str = "desocupados"
    participation: str = "tasa_participacion"
    # dimension members
    total: str = "total"
    urban: str = "urbana"
    rural: str = "rural"
    men: str = "hombres"
    women: str = "mujeres"
    # first year of the "post" era (post_covid flag)
    post_year: int = 2021
    # columns lagged / differenced by the feature chain
    lag_cols: tuple = (
        "tasa_desempleo",
        "tasa_participacion",
        "empleo_informal_pct",
        "mediana_salario",
        "pct_subempleo",
    )
    delta_cols: tuple = ("tasa_participacion", "empleo_informal_pct", "mediana_salario")
    extra_keys: tuple = field(default_factory=tuple)

    @property
    def dims(self) -> list[str]:
        """Row-grain dimension columns below the entity."""
        return [self.area, self.sex]

    @property
    def key(self) -> list[str]:
        """Natural key of a panel row."""
        return [self.entity, self.period, self.area, self.sex]

    def group_cols(self, columns) -> list[str]:
        """Series key (entity[, area][, sex]) restricted to existing columns."""
        return [self.entity] + [c for c in (self.area, self.sex) if c in columns]

    def id_cols(self, columns) -> list[str]:
        return [c for c in (self.entity, self.period, self.year, self.area, self.sex) if c in columns]


DEFAULT_SPEC = PanelSpec()

# Canonical column order of a consolidated panel (fixed values of the data
# model: identification, labour market, activity, age, sectors, education,
# under-employment, company size, wage, informality, macro indicators).
PANEL_COLUMN_ORDER = [
    "provincia", "periodo", "anio", "area", "sexo",
    "poblacion_15_mas", "pea", "ocupados", "desocupados",
    "tasa_desempleo", "tasa_participacion",
    "tasa_actividad_total", "tasa_actividad_urbana", "tasa_actividad_rural",
    "pct_jovenes_pea", "pct_mayores_pea",
    "pct_sector_primario", "pct_sector_secundario", "pct_sector_terciario",
    "pct_sin_educacion", "pct_primaria", "pct_secundaria", "pct_universitaria",
    "pct_subempleo",
    "pct_microempresa", "pct_empresa_grande",
    "mediana_salario",
    "empleo_informal_pct",
    "pib_crecimiento", "inflacion", "indice_gini",
    "gasto_educacion_pib", "desempleo_juvenil_nacional",
    "exportaciones_pib", "pib_per_capita", "poblacion_total_nacional",
]

# Model feature list (fixed values: the selected features of the evaluation
# step, in their published order).
SELECTED_FEATURES = [
    "tasa_desempleo_lag1",
    "tasa_participacion", "pct_subempleo", "empleo_informal_pct",
    "pct_sin_educacion", "pct_universitaria",
    "pct_jovenes_pea", "pct_mayores_pea",
    "pct_sector_primario", "pct_sector_secundario", "pct_empresa_grande",
    "brecha_desempleo_urb_rur", "brecha_desempleo_genero", "ratio_pea_urbana",
    "area_total", "area_urbana", "sexo_mujeres", "sexo_total",
    "pct_subempleo_lag1", "empleo_informal_pct_delta", "post_covid",
    "prov_Colón", "prov_Comarca Kuna Yala",
    "lag_x_post_covid", "lag_x_sexo_mujeres", "lag_x_area_urbana",
    "pib_crecimiento", "desempleo_juvenil_nacional", "mediana_salario",
    "ratio_terciario_primario", "educacion_alta",
]

# Macro indicator code -> panel column (fixed values).
MACRO_INDICATORS = {
    "NY.GDP.MKTP.KD.ZG": "pib_crecimiento",
    "FP.CPI.TOTL.ZG": "inflacion",
    "SI.POV.GINI": "indice_gini",
    "SE.XPD.TOTL.GD.ZS": "gasto_educacion_pib",
    "SL.UEM.1524.ZS": "desempleo_juvenil_nacional",
    "NE.EXP.GNFS.ZS": "exportaciones_pib",
    "NY.GDP.PCAP.CD": "pib_per_capita",
    "SP.POP.TOTL": "poblacion_total_nacional",
}
