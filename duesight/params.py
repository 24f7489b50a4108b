"""Business and model parameters, one frozen dataclass each."""

from dataclasses import dataclass

# Defaults agreed for decisions, validation and model fitting.


@dataclass(frozen=True)
class DecisionParams:
    call_cost: float = 15.0
    days_accelerated: float = 3.0
    daily_capital_rate: float = 0.0003
    daily_capacity: int = 20
    call_delay_days: int = 7
    call_amount: float = 50_000.0
    remind_delay_days: int = 3
    business_days_per_year: int = 250


@dataclass(frozen=True)
class ModelParams:
    trees: int = 100
    depth: int = 5
    learning_rate: float = 0.1
    seed: int = 42
    lower_quantile: float = 0.1
    upper_quantile: float = 0.9
    test_fraction: float = 0.2


@dataclass(frozen=True)
class ScoringRun:
    """Stamp of one scoring run; ``z`` is the half-width of the baseline interval in stds."""

    version: str
    scored_at: str
    model_name: str = "baseline"
    run_id: str = "run"
    z: float = 1.2816


MAX_PLAUSIBLE_AMOUNT = 100_000_000.0
PSI_FLOOR = 1e-6
PSI_BINS = 10
