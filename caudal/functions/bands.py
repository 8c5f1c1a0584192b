"""Turn numbers into labels: level bands, signed bands, quadrants and status rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from caudal.functions.numeric import Number, column, finite

# The label sets of the published indicators.
TRAFFIC_EN = ("green", "yellow", "red")
TRAFFIC_ES = ("Verde", "Amarillo", "Rojo")
TRAFFIC_ES_LONG = ("Verde (Riesgo Bajo)", "Amarillo (Riesgo Moderado)", "Rojo (Riesgo Alto)")
RISK_LABELS = {
    "green": "Bajo, relación débil",
    "yellow": "Medio, relación moderada",
    "red": "Alto, relación fuerte",
}
QUADRANT_LABELS = {
    "up_up": "Más lluvia, mejora agua",
    "down_up": "Menos lluvia, mejora agua",
    "up_down": "Más lluvia, baja agua",
    "down_down": "Menos lluvia, baja agua",
    "small": "Cambios pequeños",
}
SANITATION_STATUS = ("Bajo saneamiento (debajo del umbral)", "Saneamiento adecuado")
CLIMATE_STATUS = ("Lluvias en descenso", "Lluvias estables o en aumento")


def band(
    value: Column | str,
    edges: Sequence[Number],
    labels: Sequence[str],
    closed: str = "left",
    null_label: str | None = None,
) -> Column:
    """Label of the interval ``value`` falls in.

    ``closed='left'`` puts a value equal to an edge into the higher band,
    ``closed='right'`` into the lower one. NULL and NaN get ``null_label``.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    if closed not in ("left", "right"):
        raise ValueError("closed must be 'left' or 'right'")
    x = finite(value)
    rule = F.when(x.isNull(), F.lit(null_label))
    for edge, label in zip(edges, labels):
        rule = rule.when(x < float(edge) if closed == "left" else x <= float(edge), F.lit(label))
    return rule.otherwise(F.lit(labels[-1]))


def signed_band(
    value: Column | str,
    limit: Number,
    labels: Sequence[str],
    inclusive: bool = False,
    null_label: str | None = None,
) -> Column:
    """Three labels (below, between, above) around ``-limit`` and ``+limit``.

    With ``inclusive`` a value equal to a limit belongs to the outer label.
    """
    below, between, above = labels
    x = finite(value)
    high, low = float(limit), -float(limit)
    return (
        F.when(x.isNull(), F.lit(null_label))
        .when(x >= high if inclusive else x > high, F.lit(above))
        .when(x <= low if inclusive else x < low, F.lit(below))
        .otherwise(F.lit(between))
    )


def correlation_risk(r: Column | str, labels: Sequence[str] = TRAFFIC_EN, null_label: str | None = "gray") -> Column:
    return band(F.abs(column(r)), (0.3, 0.6), labels, null_label=null_label)


def correlation_strength(r: Column | str) -> Column:
    return band(F.abs(column(r)), (0.3, 0.6), ("baja", "media", "alta"))


def correlation_direction(r: Column | str) -> Column:
    return signed_band(r, 0, ("negativa", "sin dirección clara", "positiva"))


def impact_direction(r: Column | str) -> Column:
    return signed_band(r, 0.2, ("inverse", "uncertain", "direct"), inclusive=True, null_label="uncertain")


def level_risk(pct: Column | str, edges: Sequence[Number] = (5, 20)) -> Column:
    return band(pct, edges, TRAFFIC_EN, closed="right", null_label="gray")


def yearly_trend(delta: Column | str, limit: Number = 0.5) -> Column:
    return signed_band(delta, limit, ("improved", "stable", "worsened"), null_label="no_previous_year")


def gap_trend(delta: Column | str, limit: Number = 0.1) -> Column:
    return signed_band(delta, limit, ("Mejorando", "Estable", "Empeorando"), null_label="Sin datos previos")


def gap_risk(gap_pp: Column | str, edges: Sequence[Number]) -> Column:
    return band(F.abs(column(gap_pp)), edges, TRAFFIC_ES, null_label="Verde")


def index_risk(
    index: Column | str,
    edges: Sequence[Number] = (20, 40),
    labels: Sequence[str] = TRAFFIC_ES,
    null_label: str | None = "Datos Faltantes",
) -> Column:
    return band(index, edges, labels, closed="right", null_label=null_label)


def zone_count_risk(n: Column | str) -> Column:
    return band(n, (5, 20), TRAFFIC_ES, closed="right")


def trend_label(n: Column | str, r: Column | str, min_n: int = 3, low: Number = -0.3, high: Number = 0.3) -> Column:
    """Direction of a series from its correlation with time; short series stay uncertain."""
    x = finite(r)
    return (
        F.when(column(n) < min_n, F.lit("uncertain"))
        .when(x <= float(low), F.lit("decreasing"))
        .when(x >= float(high), F.lit("increasing"))
        .otherwise(F.lit("stable"))
    )


def quadrant(
    dx: Column | str, dy: Column | str, eps: float = 1e-6, labels: Mapping[str, str] = QUADRANT_LABELS
) -> Column:
    """Sign pattern of two changes; unknown or negligible pairs are 'small'."""
    x, y = finite(dx), finite(dy)
    small = x.isNull() | y.isNull() | ((F.abs(x) < eps) & (F.abs(y) < eps))
    side = lambda v: F.when(v > 0, F.lit("up")).when(v < 0, F.lit("down"))
    pattern = F.when(~small, F.concat(side(x), F.lit("_"), side(y)))
    rule = F.when(pattern.isNull(), F.lit(labels["small"]))
    for key, label in labels.items():
        if key != "small":
            rule = rule.when(pattern == key, F.lit(label))
    return rule


def zone_status(critical: Column | str, first: Column | str, second: Column | str) -> Column:
    """Red when both conditions hold, yellow for either, green for none; NULL is false."""
    known = lambda c: F.coalesce(column(c), F.lit(False))
    return F.when(known(critical), F.lit("red")).when(known(first) | known(second), F.lit("yellow")).otherwise(F.lit("green"))


def flag_label(flag: Column | str, labels: Sequence[str]) -> Column:
    return F.when(F.coalesce(column(flag), F.lit(False)), F.lit(labels[0])).otherwise(F.lit(labels[1]))


def below(value: Column | str, threshold: Number) -> Column:
    return column(value) < F.lit(threshold)


def above(value: Column | str, threshold: Number) -> Column:
    return column(value) > F.lit(threshold)
