"""The points and thresholds of the scorecard."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Scorecard:
    """Rating points and grade thresholds, put into the plan as literals.

    ``grade_weight_scope`` says what the 0.35 weight of the financial-health
    part multiplies: ``"grade"`` (only the grade points) or ``"all"`` (the sum
    of all four terms).
    """

    # Points by rating.
    unacceptable_rated_pts: int = 0
    very_bad_rated_pts: int = 100
    bad_rated_pts: int = 250
    good_rated_pts: int = 500
    very_good_rated_pts: int = 650
    excellent_rated_pts: int = 800
    # Upper score limits of grades F, E, D, C and B.
    unacceptable_grade_pts: float = 750
    very_bad_grade_pts: float = 1000
    bad_grade_pts: float = 1500
    good_grade_pts: float = 2000
    very_good_grade_pts: float = 2500
    # Weights of the three score parts.
    payment_history_weight: float = 0.20
    defaulters_history_weight: float = 0.45
    financial_health_weight: float = 0.35
    grade_weight_scope: str = "grade"

    def __post_init__(self):
        if self.grade_weight_scope not in ("grade", "all"):
            raise ValueError(f"unknown weight scope: {self.grade_weight_scope!r}")

    @classmethod
    def from_session(cls, spark: SparkSession, prefix: str = "spark.sql.") -> "Scorecard":
        """Points and thresholds set in the session, defaults for those that are not.

        Thresholds may be fractional.
        """
        found = {}
        for field in fields(cls):
            if field.name.endswith("_pts"):
                value = spark.conf.get(prefix + field.name, None)
                if value is not None:
                    number = float(value)
                    found[field.name] = int(number) if number.is_integer() else number
        return cls(**found)
