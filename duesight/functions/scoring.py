"""Decision formulas as plain column expressions (they stay inside whole-stage codegen)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import DecisionParams

DEFAULTS = DecisionParams()


def clip(col: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(col, F.lit(high)), F.lit(low))


def p_late(lower: Column, upper: Column) -> Column:
    """P(paid late) from a prediction interval; crossed bounds are put in order first."""
    lo, hi = F.least(lower, upper), F.greatest(lower, upper)
    share = hi / F.greatest(hi - lo, F.lit(1.0))
    return (
        F.when(hi < 0, F.lit(0.05)).when(lo > 5, F.lit(0.95)).otherwise(clip(share, 0.0, 1.0))
    )


def p_responds(std_days_late: Column) -> Column:
    return clip(1.0 - std_days_late / 20.0, 0.2, 0.8)


def call_benefit(amount: Column, p: DecisionParams = DEFAULTS) -> Column:
    """Cash value of getting the amount paid earlier, if the call succeeds."""
    return p.days_accelerated * p.daily_capital_rate * F.abs(amount)


def expected_value(
    amount: Column, lower: Column, upper: Column, std: Column, p: DecisionParams = DEFAULTS
) -> Column:
    return p_late(lower, upper) * p_responds(std) * call_benefit(amount, p) - p.call_cost


def action_tier(days_late: Column, amount: Column, p: DecisionParams = DEFAULTS) -> Column:
    """What to do about a predicted delay; without a prediction an invoice is watched."""
    days, remind = F.ceil(days_late), F.ceil(days_late) >= p.remind_delay_days
    return (
        F.when(days <= 0, "OK")
        .when((days > p.call_delay_days) | (remind & (F.abs(amount) > p.call_amount)), "CALL")
        .when(remind, "REMIND")
        .otherwise("WATCH")
    )


def tier_order(action: Column) -> Column:
    return (
        F.when(action == "CALL", 0).when(action == "REMIND", 1).when(action == "WATCH", 2).otherwise(3)
    )


def drift_status(psi: Column) -> Column:
    return (
        F.when(psi.isNull() | F.isnan(psi) | (F.abs(psi) == float("inf")), "unknown")
        .when(psi < 0.1, "stable")
        .when(psi < 0.25, "moderate")
        .otherwise("significant")
    )


def calibration_label(coverage_pct: Column) -> Column:
    return (
        F.when(coverage_pct < 75, "Under-conservative")
        .when(coverage_pct > 88, "Over-conservative")
        .otherwise("Well Calibrated")
    )


def delay_band(days: Column) -> Column:
    return F.when(days > 7, "high").when(days >= 3, "mid").when(days >= 1, "low").otherwise("ok")


def risk_band(p: Column) -> Column:
    return F.when(p >= 0.7, "high").when(p >= 0.4, "mid").otherwise("low")


def interval_text(lower: Column, upper: Column) -> Column:
    return F.concat(
        F.ceil(lower).cast("int").cast("string"),
        F.lit(" to "),
        F.ceil(upper).cast("int").cast("string"),
        F.lit(" days"),
    )


def rounded(value: Column, digits: int) -> Column:
    """Half away from zero on the scaled value, as SQL engines round doubles. ``F.round`` rounds the
    shortest decimal text of a double instead, which gives other half cents (-9.915, -12.254999999999999)."""
    return F.round(value * 10.0**digits) / 10.0**digits


def cents(amount: Column) -> Column:
    """Round an average to cents; float noise is cut first, so half cents always round up."""
    return F.round(F.round(amount, 6), 2)
