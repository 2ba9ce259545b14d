"""Business parameters and fixed value tables.

Everything here lives on the driver as plain Python values and reaches the
executors as literals inside the plan, so Catalyst folds it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Vocabularies, thresholds, band tables and texts that results
# must agree on.  Plain data, natural order.
# ---------------------------------------------------------------------------

STAGES = ("STAGE_1", "STAGE_2", "STAGE_3")

LOAN_TYPES = ("MORTGAGE", "AUTO", "PERSONAL", "CREDIT_CARD", "BUSINESS", "LINE_OF_CREDIT")

SECURED_TYPES = ("MORTGAGE", "AUTO")
REVOLVING_TYPES = ("CREDIT_CARD", "LINE_OF_CREDIT")

# loan type -> (minimum LGD, recovery factor, credit conversion factor)
RISK_PARAMETERS = {
    "MORTGAGE": (0.20, 1.0, 1.0),
    "AUTO": (0.25, 0.9, 1.0),
    "PERSONAL": (0.45, 0.5, 1.0),
    "CREDIT_CARD": (0.70, 0.3, 1.1),
    "LINE_OF_CREDIT": (0.60, 0.4, 0.75),
}
OTHER_RISK_PARAMETERS = (0.60, 0.4, 1.0)

# PD upper bounds (exclusive) -> internal rating
PD_RATINGS = ((0.005, "EXCELLENT"), (0.01, "GOOD"), (0.05, "FAIR"), (0.20, "POOR"))
PD_RATING_ABOVE = "DEFAULT"

# confidence lower bounds -> reliability
RELIABILITY = ((0.8, "HIGH"), (0.6, "MEDIUM"))
RELIABILITY_BELOW = "LOW"

# score lower bounds -> band
SCORE_BANDS_5 = (
    (800, "Excellent (800+)"),
    (700, "Good (700-799)"),
    (600, "Fair (600-699)"),
    (500, "Poor (500-599)"),
)
SCORE_BANDS_6 = (
    (900, "Excellent (900+)"),
    (800, "Very Good (800-899)"),
    (700, "Good (700-799)"),
    (600, "Fair (600-699)"),
    (500, "Poor (500-599)"),
)
SCORE_BAND_BELOW = "Very Poor (<500)"

STAGE_DESCRIPTIONS = {
    1: "Stage 1 - Normal",
    2: "Stage 2 - Significant Increase",
    3: "Stage 3 - Credit Impaired",
}

# default-rate and score bounds of the letter scale
LETTER_BY_PD = ((0.2, "CCC"), (0.1, "CC"), (0.05, "C"))
LETTER_BY_SCORE = ((800, "AAA"), (750, "AA"), (700, "A"), (650, "BBB"), (600, "BB"))
LETTER_BELOW = "B"
LETTER_DEFAULT = "D"

# score lower bounds -> interest rate add-on
RATE_ADJUSTMENTS = ((800, -0.5), (700, 0.0), (600, 1.0))
RATE_ADJUSTMENT_BELOW = 2.5

# score lower bounds -> multiplier of the closed-form PD
PD_SCORE_FACTORS = ((800, 0.5), (700, 1.0), (600, 1.5))
PD_SCORE_FACTOR_BELOW = 3.0

BAD_HISTORY = ("Malo", "Muy Malo")

# source vocabulary -> canonical loan type
LOAN_TYPE_SYNONYMS = {
    "Hipoteca Residencial": "MORTGAGE",
    "Hipoteca Comercial": "MORTGAGE",
    "Préstamo Personal": "PERSONAL",
    "Préstamo Empresarial": "BUSINESS",
    "Línea de Crédito": "LINE_OF_CREDIT",
    "Tarjeta de Crédito": "CREDIT_CARD",
    "Préstamo Vehículo": "AUTO",
    "Préstamo Estudiantil": "PERSONAL",
    "Microcrédito": "PERSONAL",
    "Factoring": "BUSINESS",
    "Confirming": "BUSINESS",
    "Leasing Inmobiliario": "BUSINESS",
    "Renting": "BUSINESS",
}

# encoded vocabularies of the prediction instance
PRODUCTS_ENCODED = (
    "Hipoteca Residencial", "Hipoteca Comercial", "Préstamo Personal",
    "Préstamo Empresarial", "Línea de Crédito", "Tarjeta de Crédito",
    "Préstamo Vehículo", "Préstamo Estudiantil", "Microcrédito",
)
REGIONS_ENCODED = (
    "Madrid", "Cataluña", "Valencia", "Andalucía", "País Vasco",
    "Galicia", "Castilla y León", "Murcia", "Aragón", "Canarias",
)

# macro scenario -> (gdp growth, unemployment, default multiplier)
SCENARIOS = {
    "baseline": (2.5, 6.0, 1.0),
    "mild_recession": (-0.5, 8.5, 1.5),
    "severe_recession": (-3.0, 12.0, 2.5),
    "financial_crisis": (-5.0, 15.0, 4.0),
    "recovery": (4.0, 4.5, 0.7),
}
SCENARIO_WEIGHTS = {"base": 0.5, "adverse": 0.3, "severe_adverse": 0.2}
# weighted scenario -> stress scenario whose multiplier it uses
WEIGHTED_SCENARIOS = {
    "base": "baseline",
    "adverse": "mild_recession",
    "severe_adverse": "severe_recession",
}
FX_RATES = {"EUR": 1.0, "USD": 0.9, "GBP": 1.15, "CAD": 0.68, "AUD": 0.6}
CURRENCIES = ("EUR", "USD", "GBP", "CAD", "AUD")

# phase -> length in months; the cycle starts at expansion
CYCLE_PHASES = (("expansion", 25), ("peak", 7), ("contraction", 19), ("trough", 7))

TIER_WEIGHTS = {
    "completeness_validation": 0.20,
    "consistency_validation": 0.25,
    "distribution_validation": 0.15,
    "correlation_validation": 0.10,
    "compliance_validation": 0.25,
    "ml_readiness_validation": 0.05,
}
STAGE_SHARE_BANDS = {1: (80.0, 90.0), 2: (8.0, 15.0), 3: (2.0, 7.0)}

STAGE_TEMPLATES = {
    "STAGE_1": "Loan classified as Stage 1 (Performing) due to: ",
    "STAGE_2": "Loan moved to Stage 2 (Underperforming) due to: ",
    "STAGE_3": "Loan classified as Stage 3 (Non-performing) due to: ",
}
REASON_HIGH_DPD = "Days past due exceeds threshold"
REASON_SCORE_DECLINE = "Significant credit score deterioration"
REASON_NONE_STAGE_1 = "No significant credit risk indicators detected"
REASON_NONE_OTHER = "Credit risk assessment triggered staging change"

TEXT_STAGE_3 = (
    "El préstamo {loan} está clasificado como Etapa 3 (Deterioro Crediticio) "
    "debido a que presenta {dpd} días de mora, superando el umbral de 90 días establecido por IFRS9."
)
TEXT_STAGE_2 = (
    "El préstamo {loan} está clasificado como Etapa 2 (Incremento Significativo del Riesgo) "
    "debido a indicadores de deterioro crediticio."
)
TEXT_STAGE_1 = (
    "El préstamo {loan} está clasificado como Etapa 1 (Riesgo Crediticio Normal) "
    "ya que mantiene indicadores de riesgo dentro de parámetros normales."
)
TEXT_HIGH_PD = "La probabilidad de incumplimiento ({pd}%) supera el umbral del 5%."
TEXT_SCORE_DROP = "Se observa un deterioro significativo en la puntuación crediticia."
TEXT_SCORE = (
    (700, "La puntuación crediticia es buena."),
    (600, "La puntuación crediticia es aceptable."),
)
TEXT_SCORE_BELOW = "La puntuación crediticia requiere monitoreo."

TEXT_OUTLIER = "El préstamo {loan} ha sido identificado como atípico con una puntuación de anomalía de {score}."
TEXT_OUTLIER_HIGH = "Los factores más destacados son:"
TEXT_OUTLIER_MEDIUM = "Otros factores a considerar:"
TEXT_OUTLIER_NONE = (
    "La anomalía se debe a una combinación de características "
    "que no se observan frecuentemente en el portafolio."
)
TEXT_OUTLIER_ACTION = (
    "Se recomienda una revisión manual detallada para determinar "
    "acciones apropiadas de gestión de riesgo."
)

# extreme-value table: factor, comparison, bound, description, severity
UNUSUAL_FACTORS = (
    ("loan_amount", ">", 1000000.0, "Importe del préstamo excepcionalmente alto", "high"),
    ("loan_amount", "<", 1000.0, "Importe del préstamo excepcionalmente bajo", "medium"),
    ("interest_rate", ">", 20.0, "Tipo de interés excepcionalmente alto", "high"),
    ("interest_rate", "<", 1.0, "Tipo de interés excepcionalmente bajo", "medium"),
    ("credit_score", "<", 400.0, "Puntuación crediticia extremadamente baja", "high"),
    ("credit_score", ">", 900.0, "Puntuación crediticia extremadamente alta", "low"),
    ("dti_ratio", ">", 0.8, "Ratio de endeudamiento sobre ingresos muy alto", "high"),
    ("ecl_rate", ">", 0.1, "Tasa de pérdida crediticia esperada muy alta", "high"),
)

TEXT_SHAP_HEAD = "Para el préstamo {loan}, los factores que más influyen en la predicción del modelo son:"
TEXT_SHAP_UP = "En conjunto, estos factores indican un riesgo de impago superior a la media del portafolio."
TEXT_SHAP_DOWN = "En conjunto, estos factores indican un riesgo de impago inferior a la media del portafolio."
SHAP_NAMES = {
    "credit_score": "La puntuación crediticia",
    "days_past_due": "Los días de mora",
    "dti_ratio": "El ratio de endeudamiento",
}

# column-name fragments that mark a date or time column
DATETIME_KEYWORDS = (
    "date", "time", "created", "updated", "modified",
    "timestamp", "maturity", "effective", "expiry", "due",
)

RETENTION_DAYS = {"raw": 30, "processed": 90, "audit": 2555}

# ---------------------------------------------------------------------------
# Tunable parameters
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class EclConfig:
    """Parameters of one provisioning run; ``as_of_date`` replaces every wall-clock read."""

    as_of_date: dt.date = dt.date(2001, 12, 31)
    config_version: str = "1.0"

    dpd_stage_2: int = 30
    dpd_stage_3: int = 90
    score_floor: int = 500
    low_credit_threshold: int = 650
    score_drop: int = 100
    ltv_limit: float = 0.95
    dti_limit: float = 0.45

    ml_confidence: float = 0.8
    agreement_floor: float = 0.8
    disagreement_cap: float = 0.6
    rules_confidence: float = 0.8
    fallback_confidence: float = 0.7

    pd_stage_1: tuple[float, float] = (0.0005, 0.04)
    pd_stage_2: tuple[float, float] = (0.05, 0.99)
    pd_stage_3: float = 1.0

    recovery_cap: float = 0.95
    risk_free_rate: float = 0.025
    cycle_adjustment: float = 0.005
    min_term_years: float = 1.0 / 12
    max_term_years: float = 30.0
    gdp_impact: float = 0.1
    unemployment_impact: float = 0.15
    rate_impact: float = 0.05
    stage_weights: dict = field(default_factory=lambda: {1: 1.0, 2: 1.3, 3: 2.0})
    apply_stage_weight: bool = False

    max_portfolio_rate: float = 0.25
    max_stage_3_share: float = 0.10
    max_low_confidence_share: float = 0.10

    max_stage_migration_pct: float = 15.0
    coverage_band: tuple[float, float] = (0.01, 0.25)


DEFAULTS = EclConfig()
