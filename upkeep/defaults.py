"""Names, labels and parameters that decide results.

Column names, class names, verdict words, thresholds and hyper-parameters below must stay as
they are for results to agree with tables published earlier; everything takes them as keyword
defaults and none is read anywhere else.
"""

from pyspark.sql import types as T

# Raw CSV header -> canonical column name.
RENAMES = {
    "Air temperature [K]": "temp_aire",
    "Process temperature [K]": "temp_proceso",
    "Rotational speed [rpm]": "vel_rotacion",
    "Torque [Nm]": "torque",
    "Tool wear [min]": "desgaste",
    "Machine failure": "falla",
}

# Types of the raw columns; every other column of a file stays a string.
RAW_TYPES = {
    "Type": T.StringType(),
    "Air temperature [K]": T.DoubleType(),
    "Process temperature [K]": T.DoubleType(),
    "Rotational speed [rpm]": T.IntegerType(),
    "Torque [Nm]": T.DoubleType(),
    "Tool wear [min]": T.IntegerType(),
    "Machine failure": T.IntegerType(),
    "TWF": T.IntegerType(),
    "HDF": T.IntegerType(),
    "PWF": T.IntegerType(),
    "OSF": T.IntegerType(),
    "RNF": T.IntegerType(),
}

# Words of a CSV cell that mean "no value", besides an empty cell.
MISSING = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

FEATURES = ["temp_aire", "temp_proceso", "vel_rotacion", "torque", "desgaste", "tipo_cod"]
OPERATING = FEATURES[:5]
MODES = ["TWF", "HDF", "PWF", "OSF", "RNF"]
TARGET = "falla"
CATEGORY = "Type"
CATEGORY_CODE = "tipo_cod"

# variable, direction of risk, threshold, unit
RISK_RULES = [
    ("temp_aire", ">", 299.10, "K"),
    ("temp_proceso", ">", 309.50, "K"),
    ("vel_rotacion", "<", 1421.50, "rpm"),
    ("torque", ">", 45.95, "Nm"),
    ("desgaste", ">", 84.50, "min"),
]
FALLING_RISK = ("vel_rotacion",)  # variables whose risk zone lies below the quartile

CLASS_NAMES = {0: "Normal", 1: "Falla"}
HOLDS, FAILS = "NO FALSADA", "FALSADA"
RULE_OK, RULE_REVIEW = "OK", "REVISAR"
STRONG, MODERATE = "alta", "moderada"
P_SMALL, P_FORMAT = "(p<0.001 ***)", "(p=%.3f)"
BAR_METRICS = ["accuracy", "precision", "recall", "f1", "auc_roc"]

TREE, FOREST, LOGISTIC = "Árbol de Decisión", "Bosque Aleatorio", "Regresión Logística"

TEST_SIZE = 0.20
SEED = 42
FOLDS = 5
MIN_RECALL = 0.80
NEIGHBOURS = 5
TREE_DEPTH = 6
FOREST_TREES = 100
FOREST_DEPTH = 8
LOGISTIC_C = 1.0
LOGISTIC_ITERATIONS = 1000
