from tastecore.plans.ordering import number_rows, rank_within, running_totals
from tastecore.plans.staging import scratch_path, shared_folder, stage

__all__ = ["number_rows", "rank_within", "running_totals", "scratch_path", "shared_folder", "stage"]
