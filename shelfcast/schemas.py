"""Table schemas: raw inputs, the relational store and monitoring documents."""

from __future__ import annotations

from pyspark.sql.types import StructType

_DDL = {
    # raw inputs
    "train": "id bigint, date date, store_nbr int, family string, sales double, onpromotion int",
    "test": "id bigint, date date, store_nbr int, family string, onpromotion int",
    "stores": "store_nbr int, city string, state string, type string, cluster int",
    "oil": "date date, dcoilwtico double",
    "holidays_events": "date date, type string, locale string, locale_name string, "
    "description string, transferred boolean",
    "transactions": "date date, store_nbr int, transactions bigint",
    # relational store
    "store_dim": "id int, store_nbr int, city string, state string, type string, cluster int, "
    "created_at timestamp, updated_at timestamp",
    "product_families": "id int, name string, description string, created_at timestamp, "
    "updated_at timestamp",
    "historical_sales": "id bigint, store_id int, family_id int, date date, sales double, "
    "onpromotion boolean, created_at timestamp, updated_at timestamp",
    "predictions": "id string, store_id int, family_id int, prediction_date timestamp, "
    "target_date timestamp, onpromotion boolean, predicted_sales double, "
    "prediction_interval_lower double, prediction_interval_upper double, model_version string, "
    "feature_values map<string,double>, created_at timestamp",
    "model_metrics": "id bigint, model_name string, model_version string, metric_name string, "
    "metric_value double, timestamp timestamp",
    "feature_importance": "id bigint, model_name string, model_version string, "
    "feature_name string, importance_value double, timestamp timestamp",
    "model_drift": "id bigint, model_name string, model_version string, drift_metric string, "
    "drift_value double, threshold double, exceeded_threshold boolean, timestamp timestamp",
    # monitoring documents
    "alerts": "timestamp string, type string, model string, message string, "
    "data struct<n_rows:bigint,overall_drift_score:double,drift_detected:boolean,"
    "features:array<struct<feature:string,statistic:double,drift_detected:boolean>>,"
    "degraded_metrics:array<string>>",
    "feature_registry": "name string, description string, type string, entity_type string, "
    "transformation string, dependencies array<string>, created_at timestamp, "
    "updated_at timestamp",
    "feature_groups": "name string, description string, features array<string>, "
    "created_at timestamp",
}

RAW_TABLES = ("train", "test", "stores", "oil", "holidays_events", "transactions")


def schema(name: str) -> StructType:
    return StructType.fromDDL(_DDL[name])
