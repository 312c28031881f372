from holdfast.plans.etl import EtlReport, run_etl
from holdfast.plans.scoring import score_table
from holdfast.plans.training import TrainReport, train_churn
from holdfast.plans.whole import run_all

__all__ = ["EtlReport", "TrainReport", "run_all", "run_etl", "score_table", "train_churn"]
