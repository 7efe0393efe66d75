"""Feature engineering (D1-D14) as one projection.

``engineer(df, spec)`` builds every derived column in a single ``select`` so
the whole block compiles into one whole-stage-codegen stage.  Column roles are
configurable; the defaults are the house-sales names.  Roles whose column is
absent are treated as 0 where the derivation needs them (B9), as the
reference does.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions.exprs import clip_lower, flag, ne_flag, to_num

# House-sales column lists used as defaults.
NONE_COLS = ["PoolQC", "MiscFeature", "Alley", "Fence", "FireplaceQu", "GarageType",
             "GarageFinish", "GarageQual", "GarageCond", "BsmtExposure", "BsmtFinType2",
             "BsmtQual", "BsmtCond", "BsmtFinType1", "MasVnrType"]
ZERO_COLS = ["GarageCars", "GarageArea", "BsmtFinSF1", "BsmtFinSF2", "BsmtUnfSF",
             "TotalBsmtSF", "BsmtFullBath", "BsmtHalfBath", "MasVnrArea"]
MODE_COLS = ["MSZoning", "Utilities", "Exterior1st", "Exterior2nd", "KitchenQual",
             "Functional", "SaleType", "Electrical"]
LOG_COLS = ["LotArea", "LotFrontage", "GrLivArea", "TotalBsmtSF", "MasVnrArea", "GarageArea",
            "1stFlrSF", "2ndFlrSF"]
# Living-area buckets (-inf,1200], (1200,2000], (2000,inf).
AREA_EDGES = [1200.0, 2000.0]
AREA_LABELS = ["small", "mid", "large"]


@dataclass
class FeatureSpec:
    year_sold: str = "YrSold"
    year_built: str = "YearBuilt"
    year_remod: str = "YearRemodAdd"
    bsmt_sf: str = "TotalBsmtSF"
    first_sf: str = "1stFlrSF"
    second_sf: str = "2ndFlrSF"
    full_bath: str = "FullBath"
    half_bath: str = "HalfBath"
    bsmt_full_bath: str = "BsmtFullBath"
    bsmt_half_bath: str = "BsmtHalfBath"
    porches: Sequence[str] = ("OpenPorchSF", "EnclosedPorch", "3SsnPorch", "ScreenPorch")
    garage_area: str = "GarageArea"
    fireplaces: str = "Fireplaces"
    pool_area: str = "PoolArea"
    wood_deck: str = "WoodDeckSF"
    veneer_area: str = "MasVnrArea"
    quality: str = "OverallQual"
    living_area: str = "GrLivArea"
    neighborhood: str = "Neighborhood"
    log_cols: Sequence[str] = field(default_factory=lambda: list(LOG_COLS))
    enable_logs: bool = True
    # Thresholds of the derived flags.
    new_age: int = 5
    high_quality: int = 7
    large_area: int = 2000
    luxury_quality: int = 8
    luxury_area: int = 2500

    def formulas(self) -> dict[str, str]:
        """How each derived column follows from the columns of this spec."""
        area = " + ".join([self.bsmt_sf, self.first_sf, self.second_sf])
        porch = " + ".join(self.porches)
        positive = {"HasBasement": self.bsmt_sf, "HasGarage": self.garage_area, "HasFireplace": self.fireplaces,
                    "HasPool": self.pool_area, "HasPorch": porch, "HasDeck": self.wood_deck, "HasMasonryVeneer": self.veneer_area}
        return {
            "HouseAge": f"{self.year_sold} - {self.year_built}", "IsNewHouse": f"HouseAge <= {self.new_age}",
            "RemodAge": f"{self.year_sold} - {self.year_remod}", "IsRemodeled": f"{self.year_remod} <> {self.year_built}",
            "TotalSF": area, "TotalPorchSF": porch,
            "TotalBathrooms": f"{self.full_bath} + {self.bsmt_full_bath} + ({self.half_bath} + {self.bsmt_half_bath}) / 2",
            **{name: f"{columns} > 0" for name, columns in positive.items()},
            "LuxuryAmenityScore": "HasPool + HasMasonryVeneer + HasDeck + HasPorch + HasFireplace",
            "QualGrLiv": f"{self.quality} * {self.living_area}", "QualTotalSF": f"{self.quality} * TotalSF",
            "QualGarage": f"{self.quality} * {self.garage_area}",
            "IsHighQuality": f"{self.quality} >= {self.high_quality}", "IsLargeHouse": f"{self.living_area} >= {self.large_area}",
            "IsLuxury": f"{self.quality} >= {self.luxury_quality} and {self.living_area} >= {self.luxury_area}",
            "GrLivAreaBin": f"bucket of {self.living_area}", "Neighborhood_Qual": f"{self.neighborhood} and {self.quality}"}


def _c(df_cols: set, name: str) -> Column:
    """Column if present, else literal 0."""
    return F.col(f"`{name}`") if name in df_cols else F.lit(0)


def age_features(cols: set, s: FeatureSpec) -> dict[str, Column]:
    """D1-D3."""
    out: dict[str, Column] = {}
    if {s.year_sold, s.year_built} <= cols:
        age = clip_lower(to_num(s.year_sold) - to_num(s.year_built), 0)
        out["HouseAge"] = age
        out["IsNewHouse"] = flag(age <= s.new_age)
    if {s.year_sold, s.year_remod} <= cols:
        out["RemodAge"] = clip_lower(to_num(s.year_sold) - to_num(s.year_remod), 0)
    if {s.year_built, s.year_remod} <= cols:
        out["IsRemodeled"] = ne_flag(to_num(s.year_built), to_num(s.year_remod))
    return out


def engineer_columns(cols: set, s: FeatureSpec) -> dict[str, Column]:
    """All derived columns of D1-D12 as named expressions."""
    out = age_features(cols, s)
    c = lambda n: _c(cols, n)
    total_sf = c(s.bsmt_sf) + c(s.first_sf) + c(s.second_sf)
    out["TotalSF"] = total_sf                                              # D4
    out["TotalBathrooms"] = (c(s.full_bath) + F.lit(0.5) * c(s.half_bath)  # D5
                             + c(s.bsmt_full_bath) + F.lit(0.5) * c(s.bsmt_half_bath))
    porch = None
    for p in s.porches:
        porch = c(p) if porch is None else porch + c(p)
    out["TotalPorchSF"] = porch                                            # D4
    flags = {                                                              # D6
        "HasBasement": c(s.bsmt_sf), "HasGarage": c(s.garage_area),
        "HasFireplace": c(s.fireplaces), "HasPool": c(s.pool_area), "HasPorch": porch,
        "HasDeck": c(s.wood_deck), "HasMasonryVeneer": c(s.veneer_area)}
    for k, v in flags.items():
        out[k] = flag(v > 0)
    out["LuxuryAmenityScore"] = (out["HasPool"] + out["HasMasonryVeneer"] + out["HasDeck"]
                                 + out["HasPorch"] + out["HasFireplace"])  # D7
    q, area = c(s.quality), c(s.living_area)
    out["QualGrLiv"] = q * area                                            # D8
    out["QualTotalSF"] = q * total_sf
    out["QualGarage"] = q * c(s.garage_area)
    out["IsHighQuality"] = flag(q >= s.high_quality)                                    # D9
    out["IsLargeHouse"] = flag(area >= s.large_area)
    out["IsLuxury"] = flag((q >= s.luxury_quality) & (area >= s.luxury_area))
    if s.living_area in cols:                                              # D10
        out["GrLivAreaBin"] = bucket_expr(F.col(f"`{s.living_area}`"), AREA_EDGES, AREA_LABELS)
    if s.enable_logs:                                                      # D11
        for lc in s.log_cols:
            if lc in cols:
                out[f"{lc}_log"] = F.log1p(clip_lower(to_num(lc), 0))
    if {s.neighborhood, s.quality} <= cols:                                # D12
        out["Neighborhood_Qual"] = cross_category(s.neighborhood, s.quality)
    return out


def bucket_expr(x: Column, edges: Sequence[float], labels: Sequence[str],
                missing: str = "missing") -> Column:
    """Right-closed buckets with open ends; NULL -> 'missing'."""
    e = F.when(x.isNull(), F.lit(missing))
    for edge, lab in zip(edges, labels):
        e = e.when(x <= F.lit(edge), F.lit(lab))
    return e.otherwise(F.lit(labels[len(edges)]))


def cross_category(a: str, b: str) -> Column:
    """``a_b`` text interaction; NULL renders as 'nan' like astype(str)."""
    bv = F.col(f"`{b}`")
    b_txt = F.when(bv.isNull(), F.lit("nan")).otherwise(bv.cast("string"))
    return F.concat_ws("_", F.coalesce(F.col(f"`{a}`").cast("string"), F.lit("nan")), b_txt)


def log_features(df: DataFrame, cols: Sequence[str], suffix: str = "_log") -> DataFrame:
    """D11 alone: log1p(max(x, 0)) for each present column."""
    return df.select("*", *[F.log1p(clip_lower(to_num(c), 0)).alias(f"{c}{suffix}")
                            for c in cols if c in df.columns])


def engineer(df: DataFrame, spec: FeatureSpec | None = None) -> DataFrame:
    """Every derivation in one ``select`` (absent inputs count as 0)."""
    s = spec or FeatureSpec()
    cols = set(df.columns)
    derived = engineer_columns(cols, s)
    keep = [F.col(f"`{c}`") for c in df.columns if c not in derived]
    return df.select(*keep, *[v.alias(k) for k, v in derived.items()])


def derive_missing_fields(df: DataFrame, spec: FeatureSpec | None = None,
                          variant: str = "demo", qual_suffix: str = "_Qual") -> DataFrame:
    """At scoring time complete derived fields the user did not give.

    'demo': ``*_log`` <- log1p(base) when NULL, ages recomputed;
    'app': only fill when NULL, and ``*_Qual`` codes default to 0."""
    s = spec or FeatureSpec()
    cols = set(df.columns)
    out = df
    for lc in s.log_cols:
        tgt = f"{lc}_log"
        if lc in cols:
            base = F.log1p(clip_lower(to_num(lc), 0))
            out = out.withColumn(tgt, F.coalesce(F.col(f"`{tgt}`"), base) if tgt in cols
                                 else base)
    ages = age_features(cols, s)
    for k in ("HouseAge", "RemodAge"):
        if k in ages:
            if variant == "demo" or k not in cols:
                out = out.withColumn(k, ages[k])
            else:
                out = out.withColumn(k, F.coalesce(F.col(k), ages[k]))
    if variant == "app":
        for c in out.columns:
            if c.endswith(qual_suffix):
                out = out.withColumn(c, F.coalesce(F.col(f"`{c}`"), F.lit(0)))
    return out


class FeatureEngineer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """D14 as a persistable pipeline stage; the role mapping is a param."""

    roles = Param(Params._dummy(), "roles", "role=column pairs", TypeConverters.toListString)
    enableLogs = Param(Params._dummy(), "enableLogs", "derive *_log columns",
                       TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, roles=None, enableLogs=True):
        super().__init__()
        self._setDefault(roles=[], enableLogs=True)
        self._set(**self._input_kwargs)

    def spec(self) -> FeatureSpec:
        kw = {}
        for pair in self.getOrDefault(self.roles):
            k, v = pair.split("=", 1)
            kw[k] = v.split(",") if k in ("porches", "log_cols") else v
        kw["enable_logs"] = self.getOrDefault(self.enableLogs)
        return FeatureSpec(**kw)

    def _transform(self, df: DataFrame) -> DataFrame:
        return engineer(df, self.spec())
