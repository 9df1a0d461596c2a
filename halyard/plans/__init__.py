from halyard.plans.jobs import (
    JobResult,
    affinity_job,
    churn_training_job,
    propensity_training_job,
    segment_accounts,
    train_churn_model,
    train_propensity_model,
)
from halyard.plans.promotion import current_version, log_run, promote, promotion_log
from halyard.plans.steps import DifferentJobError
from halyard.plans.views import feature_views, register_feature_views

__all__ = [
    "DifferentJobError",
    "JobResult",
    "affinity_job",
    "churn_training_job",
    "current_version",
    "feature_views",
    "log_run",
    "promote",
    "promotion_log",
    "propensity_training_job",
    "register_feature_views",
    "segment_accounts",
    "train_churn_model",
    "train_propensity_model",
]
