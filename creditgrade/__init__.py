"""Loan-application curation and rule-based credit grading on Spark DataFrames."""

from creditgrade.plans.batch import CuratedTables, curate, run_batch
from creditgrade.plans.direct import score_applications
from creditgrade.plans.scoring import loan_score
from creditgrade.scorecard import Scorecard

__all__ = [
    "CuratedTables",
    "Scorecard",
    "curate",
    "loan_score",
    "run_batch",
    "score_applications",
]
