"""Dataset specifications: schema, feature order, label, verdict rule, store table.

One ``DatasetSpec`` owns everything that differs between datasets, so every
job (ingest, train, score) is written once and parameterised by the spec.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType


@dataclass(frozen=True)
class VerdictRule:
    """Maps a rounded prediction to a verdict.

    ``match_value`` is the one prediction value that is tested explicitly;
    ``match_is_positive`` tells which verdict it selects. Every other value
    (including values outside {0, 1}) gets the opposite verdict.
    """

    match_value: int
    match_is_positive: bool
    positive_message: str
    negative_message: str


@dataclass(frozen=True)
class TreeParams:
    """Decision-tree hyper-parameters (MLlib defaults, as in the reference)."""

    max_depth: int = 5
    max_bins: int = 32
    min_instances_per_node: int = 1
    min_info_gain: float = 0.0
    impurity: str | None = None  # None -> gini (classifier) / variance (regressor)
    seed: int = 42
    # memory for one pass's histograms; more lets one pass grow more nodes
    max_memory_mb: int = 256


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    schema: StructType
    label: str
    table: str
    verdict: VerdictRule
    model_kind: str = "classifier"  # or "regressor"
    params: TreeParams = field(default_factory=TreeParams)
    num_classes: int | None = None  # labels are 0..n-1; None: the learner finds n in an extra pass

    @property
    def features(self) -> list[str]:
        return [f.name for f in self.schema.fields if f.name != self.label]

    @property
    def feature_schema(self) -> StructType:
        return StructType([f for f in self.schema.fields if f.name != self.label])

    def schema_ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)


def _schema(cols: list[tuple[str, str]]) -> StructType:
    types = {"int": IntegerType(), "double": DoubleType()}
    return StructType([StructField(n, types[t], True) for n, t in cols])


# Column names, order and types of the two clinical datasets,
# and the verdict texts shown to the user. They must equal the reference's.
DIABETES_COLUMNS = [
    ("Pregnancies", "int"),
    ("Glucose", "double"),
    ("BloodPressure", "double"),
    ("SkinThickness", "double"),
    ("Insulin", "double"),
    ("BMI", "double"),
    ("DiabetesPedigreeFunction", "double"),
    ("Age", "int"),
    ("diabetes", "int"),
]
HEART_COLUMNS = [
    ("age", "int"),
    ("sex", "int"),
    ("cp", "int"),
    ("trestbps", "int"),
    ("chol", "int"),
    ("fbs", "int"),
    ("restecg", "int"),
    ("thalach", "int"),
    ("exang", "int"),
    ("oldpeak", "double"),
    ("slope", "int"),
    ("ca", "int"),
    ("thal", "int"),
    ("heartdisease", "int"),
]
DIABETES_POSITIVE = "person is diabetic"
DIABETES_NEGATIVE = "person is not diabetic"
HEART_POSITIVE = "person is having heart disease"
HEART_NEGATIVE = "person is not having heart disease"
VERDICT_CODE_POSITIVE = "1"
VERDICT_CODE_NEGATIVE = "0"
COLOUR_NEGATIVE = "green"
COLOUR_POSITIVE = "red"
# End of fixed values.

DIABETES = DatasetSpec(
    name="diabetes",
    schema=_schema(DIABETES_COLUMNS),
    label="diabetes",
    table="diabetes",
    # prediction 0 -> negative, anything else -> positive
    verdict=VerdictRule(0, False, DIABETES_POSITIVE, DIABETES_NEGATIVE),
    num_classes=2,
)

HEART = DatasetSpec(
    name="heart",
    schema=_schema(HEART_COLUMNS),
    label="heartdisease",
    table="heart",
    # prediction 1 -> positive, anything else -> negative
    verdict=VerdictRule(1, True, HEART_POSITIVE, HEART_NEGATIVE),
    num_classes=2,
)

SPECS: dict[str, DatasetSpec] = {s.name: s for s in (DIABETES, HEART)}

ACTIONS = ("train", "score")


def register(spec: DatasetSpec) -> DatasetSpec:
    SPECS[spec.name] = spec
    return spec


def get_spec(name: str) -> DatasetSpec:
    try:
        return SPECS[name]
    except KeyError:
        raise KeyError(f"unknown dataset {name!r}; known: {sorted(SPECS)}") from None


def select_job(dataset: str, action: str) -> tuple[DatasetSpec, str]:
    """Job selection by (dataset, action).

    Unknown names raise instead of silently falling through to a default
    dataset or action.
    """
    if action not in ACTIONS:
        raise ValueError(f"unknown action {action!r}; known: {ACTIONS}")
    return get_spec(dataset), action
