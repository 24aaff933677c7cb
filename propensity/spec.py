"""Configuration objects: which columns play which role.

No Spark here. Every operator takes a ``FeatureSpec`` instead of
hard-coding column names, so the same code runs on the wide click table
and on the fixture view over the driver's tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class FeatureSpec:
    """Roles of the columns of an impression table.

    target        binary label column (int 0/1)
    int_cols      numeric features (double, nullable)
    cat_cols      categorical features (string, nullable)
    skewed        numeric columns that get clip-at-0 + log1p
    flag_cols     numeric columns that get a ``<c>_was_missing`` indicator
    sentinel_col  numeric column whose special values get indicator columns
    sentinels     the special values of ``sentinel_col``
    id_col        natural unique row key, if the table has one
    num_hash_features  buckets of the categorical hasher
    missing_token      literal that replaces a null category
    """

    target: str
    int_cols: tuple[str, ...]
    cat_cols: tuple[str, ...]
    skewed: tuple[str, ...] = ()
    flag_cols: tuple[str, ...] = ()
    sentinel_col: str | None = None
    sentinels: tuple[float, ...] = ()
    id_col: str | None = None
    num_hash_features: int = 128
    missing_token: str = "missing"

    @property
    def features(self) -> tuple[str, ...]:
        return self.int_cols + self.cat_cols

    @property
    def imputed_cols(self) -> tuple[str, ...]:
        return tuple(f"{c}_imp" for c in self.int_cols)

    @property
    def missing_flag_cols(self) -> tuple[str, ...]:
        return tuple(f"{c}_was_missing" for c in self.flag_cols)

    @property
    def sentinel_flag_cols(self) -> tuple[str, ...]:
        if self.sentinel_col is None:
            return ()
        return tuple(sentinel_flag_name(self.sentinel_col, v) for v in self.sentinels)

    @property
    def indicator_cols(self) -> tuple[str, ...]:
        return self.missing_flag_cols + self.sentinel_flag_cols

    def with_(self, **changes) -> "FeatureSpec":
        return replace(self, **changes)


def sentinel_flag_name(col: str, value: float) -> str:
    """``intCol_1`` and -1 give ``intCol_1_is_neg1``; 7 gives ``intCol_1_is_7``."""
    v = int(value) if float(value).is_integer() else value
    text = f"neg{-v}" if v < 0 else f"{v}"
    return f"{col}_is_{text}".replace(".", "_")


@dataclass(frozen=True)
class SplitSpec:
    """How rows are divided into train and test.

    method  ``"hash"``: deterministic md5 of the row key (reproducible in SQL);
            ``"seeded"``: Spark's seeded samplers (``sampleBy`` / ``randomSplit``).
    """

    train_frac: float = 0.8
    seed: int = 42
    stratified: bool = True
    exact: bool = False
    method: str = "hash"


@dataclass(frozen=True)
class FoldSpec:
    num_folds: int = 2
    seed: int = 42
    stratified: bool = False
    method: str = "hash"


@dataclass(frozen=True)
class GridSpec:
    """Parameter grid as ``{param_name: [values...]}``; insertion order is
    the enumeration order (cartesian product, last key fastest)."""

    params: dict = field(default_factory=dict)

    def combos(self) -> list[dict]:
        out: list[dict] = [{}]
        for name, values in self.params.items():
            out = [dict(c, **{name: v}) for c in out for v in values]
        return out


# --- fixed values: the click table of the reference job -------------------
# Column names, the skewed-column list, the columns with missingness flags,
# the intCol_1 sentinels and the bucket count are values that must equal the
# reference's for the same features; they are stated here as they appear.
CLICKS_INT_COLS = tuple(f"intCol_{i}" for i in range(13))
CLICKS_CAT_COLS = tuple(f"catCol_{i}" for i in range(26))
CLICKS_SKEWED = ("intCol_1", "intCol_2", "intCol_4", "intCol_5", "intCol_6",
                 "intCol_7", "intCol_8", "intCol_10", "intCol_11", "intCol_12")
CLICKS_FLAG_COLS = ("intCol_0", "intCol_2", "intCol_3", "intCol_4",
                    "intCol_5", "intCol_6", "intCol_8", "intCol_9",
                    "intCol_10", "intCol_11", "intCol_12")
CLICKS_SENTINELS = (-1.0, -2.0)
CLICKS_BUCKETS = 128
CLICKS_BUCKETS_OLD = 16384

CLICKS = FeatureSpec(
    target="target",
    int_cols=CLICKS_INT_COLS,
    cat_cols=CLICKS_CAT_COLS,
    skewed=CLICKS_SKEWED,
    flag_cols=CLICKS_FLAG_COLS,
    sentinel_col="intCol_1",
    sentinels=CLICKS_SENTINELS,
    num_hash_features=CLICKS_BUCKETS,
)

CLICKS_LEGACY = CLICKS.with_(num_hash_features=CLICKS_BUCKETS_OLD)
# The twin log-scales intCol_1 too, after its sentinels have become flags.
CLICKS_TWIN = CLICKS

# Parameter grids of the reference's tuned search (enumeration order kept).
LR_GRID = GridSpec({"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 1.0]})
RF_GRID = GridSpec({"maxDepth": [5, 10], "numTrees": [30]})
GBT_GRID = GridSpec({"maxDepth": [5], "maxIter": [20, 50]})
# Fixed classifier defaults of the canonical job.
LR_DEFAULTS = {"maxIter": 200}
RF_DEFAULTS = {"seed": 42, "numTrees": 20}
GBT_DEFAULTS = {"seed": 42, "maxIter": 50}

# The older script: LR maxIter 50, RF 100 trees by default, RF grid with 50 trees,
# plain random 80/20 split, LR and RF only.
LEGACY_LR_DEFAULTS = {"maxIter": 50}
LEGACY_RF_DEFAULTS = {"seed": 42, "numTrees": 100}
LEGACY_RF_GRID = GridSpec({"maxDepth": [5, 10], "numTrees": [50]})
# The single-machine twin's grids for the tree models (50 trees; depth 5 x 20/50 rounds).
TWIN_RF_GRID = GridSpec({"maxDepth": [5, 10], "numTrees": [50]})
TWIN_GBT_GRID = GridSpec({"maxDepth": [5], "maxIter": [20, 50]})
# Its logistic regression: C on the summed loss (see c_to_reg_param), 300 iterations, tolerance 1e-3.
TWIN_LR_GRID = GridSpec({"C": [1e6, 10.0], "elasticNetParam": [0.0, 1.0]})
TWIN_LR_DEFAULTS = {"maxIter": 300, "tol": 1e-3}


def c_to_reg_param(c: float, n_train: int) -> float:
    """An inverse penalty ``C`` on the summed loss (the single-machine twin's
    parameter) as Spark's ``regParam`` on the mean loss: ``1 / (C * n)``."""
    return 1.0 / (float(c) * float(n_train))
