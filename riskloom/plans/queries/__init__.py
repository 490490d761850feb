"""The query catalogue: one entry per operator group, over the driver tables.

Every query reads whole driver tables (or data Spark derived from them and
wrote to the shared folder) and returns a lazy DataFrame. Queries that need
an intermediate file (CSV round trips, store appends, saved models, stream
input) write it below the session's shared checkpoint folder first.
"""

from __future__ import annotations

from riskloom.plans.queries import clinical, features, serving, storage, trees
from riskloom.plans.queries.common import Query

QUERIES: dict[str, Query] = {
    "train_eval_end_to_end": serving.train_eval_end_to_end,
    "train_eval_diabetes": clinical.train_eval_diabetes,
    "train_eval_heart": clinical.train_eval_heart,
    "train_eval_diabetes_regressor": clinical.train_eval_diabetes_regressor,
    "train_eval_heart_regressor": clinical.train_eval_heart_regressor,
    "train_eval_string_store": clinical.train_eval_string_store,
    "train_three_classes": trees.train_three_classes,
    "scan_csv_typed": storage.scan_csv_typed,
    "scan_csv_malformed": storage.scan_csv_malformed,
    "scan_csv_infer": storage.scan_csv_infer,
    "scan_text_from_csv": storage.scan_text_from_csv,
    "table_append_readback": storage.table_append_readback,
    "store_schema_free": storage.store_schema_free,
    "ingest_stream": storage.ingest_stream,
    "cast_project": features.cast_project_query,
    "sql_view_filter": features.sql_view_filter,
    "assemble_features": features.assemble_features,
    "assemble_skip_invalid": features.assemble_skip_invalid,
    "random_split_invariants": features.random_split_invariants,
    "hash_split": features.hash_split_query,
    "hash_split_null_keys": features.hash_split_null_keys,
    "dt_classifier_majority": trees.dt_classifier_majority,
    "dt_classifier_stump": trees.dt_classifier_stump,
    "dt_classifier_separable": trees.dt_classifier_separable,
    "dt_classifier_depth2": trees.dt_classifier_depth2,
    "dt_classifier_depth5": trees.dt_classifier_depth5,
    "dt_classifier_defaults": trees.dt_classifier_defaults,
    "dt_regressor_mean": trees.dt_regressor_mean,
    "dt_regressor_stump": trees.dt_regressor_stump,
    "dt_regressor_depth2": trees.dt_regressor_depth2,
    "dt_regressor_depth5": trees.dt_regressor_depth5,
    "dt_regressor_defaults": trees.dt_regressor_defaults,
    "dt_continuous": trees.dt_continuous,
    "dt_continuous_regressor": trees.dt_continuous_regressor,
    "predict_probability": trees.predict_probability,
    "model_roundtrip": trees.model_roundtrip,
    "model_roundtrip_regressor": trees.model_roundtrip_regressor,
    "round_predictions": features.round_predictions,
    "prediction_label_pairs": trees.prediction_label_pairs,
    "accuracy": trees.accuracy_query,
    "accuracy_evaluator": trees.accuracy_evaluator,
    "accuracy_percent": trees.accuracy_percent_query,
    "verdict_default_positive": features.verdict_default_positive,
    "verdict_default_negative": features.verdict_default_negative,
    "parse_requests": features.parse_requests_query,
    "score_one_record": serving.score_one_record,
    "score_batch": serving.score_batch,
    "score_batch_rejects": serving.score_batch_rejects,
    "score_stream": serving.score_stream,
    "score_one_diabetes": clinical.score_one_diabetes,
    "score_one_heart": clinical.score_one_heart,
    "score_diabetes": clinical.score_diabetes,
    "score_heart": clinical.score_heart,
    "score_routed": clinical.score_routed,
    "score_stream_heart": clinical.score_stream_heart,
    "predictions_csv_roundtrip": storage.predictions_csv_roundtrip,
    "predictions_json": storage.predictions_json_query,
    "predictions_json_file": storage.predictions_json_file,
    "display_table": storage.display_table_query,
    "display_counts": storage.display_counts_query,
}
