from riskloom.operators.evaluate import accuracy, accuracy_report, confusion, evaluator_accuracy
from riskloom.operators.model import fit_tree, load_model, model_kind, predict, save_model
from riskloom.operators.prepare import (
    assemble,
    cast_project,
    hash_split,
    hash_split_flag,
    random_split,
    view_filter,
)
from riskloom.operators.score import (
    add_verdict,
    parse_requests,
    rounded_pairs,
    score_requests,
    score_typed,
)

__all__ = [
    "accuracy",
    "accuracy_report",
    "add_verdict",
    "assemble",
    "cast_project",
    "confusion",
    "evaluator_accuracy",
    "fit_tree",
    "hash_split",
    "hash_split_flag",
    "load_model",
    "model_kind",
    "parse_requests",
    "predict",
    "random_split",
    "rounded_pairs",
    "save_model",
    "score_requests",
    "score_typed",
    "view_filter",
]
