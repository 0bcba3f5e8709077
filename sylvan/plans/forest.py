"""Forest grid search on any table: features, sampling, growth, scoring and selection.

``fit`` takes a training table and the names of its columns and returns a
:class:`ForestModel` that predicts, evaluates, saves and loads; lineitem is one
caller (:func:`lineitem_rows`).  Every stage is a DataFrame plan.  The number of
training rows, which fixes the sampling rate, and the best key are all that
reaches the driver.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.functions import params as P
from sylvan.functions.hashing import hash_key
from sylvan.operators import binning
from sylvan.operators import features as feat
from sylvan.operators import forest as fo
from sylvan.operators import gaps
from sylvan.operators import growth
from sylvan.operators import metrics as me
from sylvan.operators import sampling as sa
from sylvan.session import materialize
from sylvan.sources import load_tables, read_table, save_tables
from sylvan.sources.tables import local_rows, spread, spread_over_cores

NUMERIC = ["l_linenumber", "l_quantity", "l_discount", "l_tax"]
TO_INDEX = ["l_linestatus"]
LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", *NUMERIC, *TO_INDEX, "l_returnflag", "l_extendedprice"]
N_FEATURES = len(NUMERIC) + len(TO_INDEX)


@dataclass(frozen=True)
class ForestConfig:
    grid: dict = field(default_factory=lambda: {"min_samples_leaf": [20, 200], "max_depth": [1, 2]})
    n_trees: int = 4
    max_p: float = 0.5
    # Rows per tree at most (classifiers); None: max_p alone decides.
    max_rows: int | None = 20000
    col_p: float = 0.7
    min_cols: int = 5
    seed: str = "42"
    task: str = "clf"
    train_share: float = 0.95
    # None: exact histograms over distinct values; an int: quantile bins per feature.
    max_bins: int | None = None
    # Exact histograms of a feature with more distinct values than this are refused: set max_bins.
    max_values: int = 100_000
    # How trees draw rows: "test" asks every row for every tree, "gaps" jumps to the drawn rows (for small shares).
    draws: str = "test"
    # How keys are compared (METRICS); None: the task's first, AUC or squared error.
    metric: str | None = None
    # Number of classes of task "multi"; labels are their numbers, from 0.
    n_classes: int = 0

    @property
    def depth(self) -> int:
        return max(point["max_depth"] for _, point in P.grid_points(self.grid))


def is_train_col(rid, cfg: ForestConfig):
    """The train/test split: a keyed hash uniform of the row id below ``train_share``."""
    below = sa.below_threshold_hex(cfg.train_share)
    return F.lit(True) if below is None else F.substring(F.md5(hash_key("split", cfg.seed, rid)), 1, 8) < F.lit(below)


def labelled_rows(spark: SparkSession, sf_dir: str, cfg: ForestConfig) -> DataFrame:
    """``rid, y, <raw features>, is_train`` of every lineitem row."""
    return lineitem_rows(read_table(spark, sf_dir, "lineitem"), cfg).select("rid", "y", *NUMERIC, *TO_INDEX, "is_train")


def lineitem_rows(lineitem: DataFrame, cfg: ForestConfig) -> DataFrame:
    """lineitem with ``rid``, label ``y`` and the split ``is_train``; numeric features as doubles."""
    rid = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    if cfg.task == "clf":
        y = (F.col("l_returnflag") == F.lit("R")).cast("long")
    else:
        y = F.round(F.col("l_extendedprice") * F.lit(100.0)).cast("long")
    li = spread(lineitem.select(*LINEITEM_COLUMNS), keys=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    return li.withColumns({"rid": rid, "y": y, **{c: F.col(c).cast("double") for c in NUMERIC}}).withColumn(
        "is_train", is_train_col(F.col("rid"), cfg))


def with_features(rows: DataFrame, numeric: list[str], labels: dict[str, DataFrame], out: str = "x") -> DataFrame:
    """``rows`` with the feature array ``out``: numeric columns, then the indexed string columns.

    The array is null where a feature is null.
    """
    indexed = rows
    for col, table in labels.items():
        indexed = feat.index_labels(indexed, table, col)
    parts = [F.col(c).cast("double") for c in numeric] + [F.col(feat.indexed_name(c)) for c in labels]
    whole = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    return indexed.withColumn(out, F.when(whole, F.array(*parts))).drop(*[feat.indexed_name(c) for c in labels])


def label_tables(train: DataFrame, to_index: list[str]) -> dict[str, DataFrame]:
    return {c: feat.string_index_table(train, c) for c in to_index}


def ready_rows(spark: SparkSession, sf_dir: str, cfg: ForestConfig) -> DataFrame:
    """``rid, x array<double>, y, is_train`` of lineitem, written once: everything of a grid is read from it."""
    rows = materialize(labelled_rows(spark, sf_dir, cfg), "labelled")
    return with_features(rows, NUMERIC, label_tables(rows.filter("is_train"), TO_INDEX)).select("rid", "x", "y", "is_train")


def feature_rows(spark: SparkSession, sf_dir: str, cfg: ForestConfig):
    """``(train, test)`` of lineitem: rows ``rid, x array<double>, y``."""
    ready = ready_rows(spark, sf_dir, cfg)
    return ready.filter("is_train").drop("is_train"), ready.filter("not is_train").drop("is_train")


def mllib_feature_rows(spark: SparkSession, sf_dir: str, cfg: ForestConfig):
    """Train and test rows through an MLlib ``Pipeline`` (StringIndexer + VectorAssembler) fitted on train."""
    rows = labelled_rows(spark, sf_dir, cfg).dropna(subset=NUMERIC + TO_INDEX)
    model = feat.fit_features(rows.filter("is_train"), NUMERIC, TO_INDEX)
    return feat.as_array(model.transform(rows)).select("rid", "x", "y", "is_train")


def grid_trees(cfg: ForestConfig, n_features: int = N_FEATURES) -> list[sa.Tree]:
    """Every tree of the grid: its key, parameters and feature mask."""
    return sa.tree_masks(P.grid_points(cfg.grid), cfg.n_trees, n_features, cfg.col_p, cfg.min_cols, cfg.seed)


TREE_SCHEMA = T.StructType([T.StructField(n, k) for n, k in (
    ("k", T.StringType()), ("tree", T.IntegerType()), ("min_leaf", T.IntegerType()), ("max_depth", T.IntegerType()),
    ("mask", T.ArrayType(T.IntegerType())))])


def grid_with_masks(spark: SparkSession, cfg: ForestConfig, n_features: int = N_FEATURES) -> DataFrame:
    trees = [(t.k, t.tree, t.min_leaf, t.max_depth, list(t.mask)) for t in grid_trees(cfg, n_features)]
    return local_rows(spark, trees, TREE_SCHEMA)


def usable(train: DataFrame) -> DataFrame:
    """Training rows with all features and a label."""
    return train.filter("x is not null and y is not null")


def sample_for_trees(train: DataFrame, cfg: ForestConfig, n_features: int = N_FEATURES) -> DataFrame:
    train = usable(train)
    p = P.sampling_rate(train.count(), cfg.max_p, cfg.max_rows)
    return sa.tree_sample(train, grid_with_masks(train.sparkSession, cfg, n_features), p, cfg.seed)


DRAWS = {"test": sa.drawn_trees, "gaps": gaps.gap_drawn_trees}


def check_values(train: DataFrame, cfg: ForestConfig) -> None:
    """Exact histograms are for features of few values: refuse one above ``max_values`` distinct ones."""
    values = train.select(F.posexplode("x").alias("f", "v"))
    found = values.groupBy("f").agg(F.approx_count_distinct("v").alias("n")).filter(F.col("n") > cfg.max_values)
    for f, n in found.orderBy("f").limit(1).collect():
        raise ValueError(f"feature {f} has about {n} distinct values: set max_bins")


def fit_forest(train: DataFrame, cfg: ForestConfig, n_features: int = N_FEATURES) -> DataFrame:
    """Node table of all trees of all grid keys, from rows ``rid, x, y``."""
    edges = None
    train = usable(train)
    p = P.sampling_rate(train.count(), cfg.max_p, cfg.max_rows)
    if cfg.max_bins:
        edges = binning.quantile_edges(train, n_features, cfg.max_bins)
    else:
        check_values(train, cfg)
    trees = grid_trees(cfg, n_features)
    # Here and not in the scan: MLlib's draws (forest_fit_clf, forest_fit_reg) follow the splits of the scan.
    train = spread_over_cores(train, keys=["rid"])
    if cfg.draws == "test" and cfg.max_rows is not None and cfg.max_rows <= growth.WHOLE_ROWS:
        # No tree has more rows than one task can grow.
        return growth.grow_whole(train, sa.row_draws(trees, p, cfg.seed), trees, n_features, cfg.task, cfg.n_classes, edges)
    # Each row once, with the trees that draw it; every level scans these rows.
    drawn = DRAWS[cfg.draws](train, trees, p, cfg.seed)
    rows = materialize(drawn.select("x", "y", "drawn"), "forest-rows")
    return growth.grow(rows, trees, n_features, cfg.task, cfg.n_classes, edges)


def scored(rows: DataFrame, nodes: DataFrame, cfg: ForestConfig, unit: float = 100.0) -> DataFrame:
    """``rows`` (with ``x``) with every grid key's ``k, n_trees``, its vote sums and its outputs."""
    votes = fo.forest_votes(rows, nodes)
    if cfg.task == fo.CLASSES:
        return fo.class_outputs(votes)
    return fo.clf_outputs(votes) if cfg.task == "clf" else fo.reg_outputs(votes, unit)


#: Metrics by task, the default first: larger is better, and how to get ``(k, <metric>)`` from scored rows.
METRICS = {
    "clf": {"auc": (True, lambda v, unit: me.auc_by_key(v)), "accuracy": (True, lambda v, unit: me.accuracy_by_key(v)),
            "log_loss": (False, lambda v, unit: me.log_loss_by_key(v, F.when(F.col("y") == 1, F.col("prob")).otherwise(1 - F.col("prob"))))},
    "reg": {"mse": (False, lambda v, unit: me.mse_by_key(v, fo.VOTE_SCALE["reg"], unit)),
            "mae": (False, lambda v, unit: me.mae_by_key(v, fo.VOTE_SCALE["reg"], unit))},
    fo.CLASSES: {"accuracy": (True, lambda v, unit: me.accuracy_by_key(v)),
                 "log_loss": (False, lambda v, unit: me.log_loss_by_key(v, F.get("probability", F.col("y").cast("int"))))},
}


def metric_of(cfg: ForestConfig) -> str:
    known = METRICS[cfg.task]
    name = cfg.metric or next(iter(known))
    if name not in known:
        raise ValueError(f"metric of task {cfg.task} must be one of {sorted(known)}")
    return name


def key_scores(votes: DataFrame, cfg: ForestConfig, unit: float = 100.0) -> DataFrame:
    """``(k, <metric>)`` over the rows that have features and a label."""
    score = "scores" if cfg.task == fo.CLASSES else "score"
    whole = votes.filter(F.col(score).isNotNull() & F.col("y").isNotNull())
    return METRICS[cfg.task][metric_of(cfg)][1](whole, unit)


def best_key(scores: DataFrame, cfg: ForestConfig) -> DataFrame:
    name = metric_of(cfg)
    return me.select_best(scores, name, larger_is_better=METRICS[cfg.task][name][0])


@dataclass
class ForestModel:
    """A fitted grid of forests: its nodes, the label tables of indexed columns, and the chosen key.

    Regression labels are kept as whole ``1 / unit`` parts, so that sums are exact.
    """

    cfg: ForestConfig
    numeric: list[str]
    label: str
    labels: dict[str, DataFrame]
    nodes: DataFrame
    best: str | None = None
    unit: float = 100.0
    #: Label values by class number (task "multi").
    classes: list = field(default_factory=list)

    def _x(self, rows: DataFrame) -> DataFrame:
        return with_features(rows, self.numeric, self.labels, "x")

    def _y(self) -> Column:
        y = F.col(self.label)
        if self.cfg.task == fo.CLASSES:  # null for a label that was not learned
            return F.nullif(F.array_position(F.array(*[F.lit(c) for c in self.classes]), y), F.lit(0).cast("long")) - 1
        return y.cast("long") if self.cfg.task != "reg" else F.round(y.cast("double") * F.lit(self.unit)).cast("long")

    def evaluate(self, rows: DataFrame) -> DataFrame:
        """``(k, <metric>)`` of every grid key on ``rows``; the best key is kept for :meth:`predict`."""
        votes = scored(self._x(rows).select("x", self._y().alias("y")), self.nodes, self.cfg, self.unit)
        scores = materialize(key_scores(votes, self.cfg, self.unit), "forest-scores")
        first = best_key(scores, self.cfg).first()
        self.best = first["k"] if first else None
        return scores

    def predict(self, rows: DataFrame) -> DataFrame:
        """All rows and columns with ``prediction`` (and ``probability``) of the best key's forest.

        Rows with a null feature keep a null prediction; equal rows stay
        apart; columns of ``rows`` named like an output are replaced.
        """
        if self.best is None:
            raise ValueError("no best key: evaluate the model first")
        nodes = self.nodes.filter(F.col("k") == F.lit(self.best))
        packed = rows.drop("prediction", "probability").withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in ("prediction", "probability")]))
        out = scored(self._x(packed).select("_row", "x"), nodes, self.cfg, self.unit)
        if self.cfg.task == "clf":
            known = F.col("score").isNotNull()
            probability = F.when(known, F.array(F.lit(1.0) - F.col("prob"), F.col("prob")))
            return out.select("_row.*", F.when(known, F.col("prediction")).alias("prediction"), probability.alias("probability"))
        if self.cfg.task == fo.CLASSES:
            value = F.get(F.array(*[F.lit(c) for c in self.classes]), F.col("prediction").cast("int"))
            return out.select("_row.*", value.alias("prediction"), "probability")
        return out.select("_row.*", "prediction")

    def save(self, path: str) -> str:
        """A new published version of the model under ``path``; earlier ones stay."""
        tables = {"nodes": self.nodes} | {f"labels-{i}": t for i, t in enumerate(self.labels.values())}
        save_tables(self.nodes.sparkSession, path, tables, {
            "cfg": asdict(self.cfg), "numeric": self.numeric, "to_index": list(self.labels), "label": self.label,
            "best": self.best, "unit": self.unit, "classes": self.classes})
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str, number: int | None = None) -> ForestModel:
        """The newest published version, or the one of that number."""
        tables, told = load_tables(
            spark, path, lambda about: ["nodes", *[f"labels-{i}" for i in range(len(about["to_index"]))]], number)
        labels = {c: tables[f"labels-{i}"] for i, c in enumerate(told["to_index"])}
        return cls(ForestConfig(**told["cfg"]), told["numeric"], told["label"], labels, tables["nodes"],
                   told["best"], told["unit"], told["classes"])


def fit(train: DataFrame, numeric: list[str], label: str, cfg: ForestConfig, to_index: list[str] = (),
        row_id: str | None = None, unit: float = 100.0) -> ForestModel:
    """Fit the grid on any table.

    ``numeric`` and ``to_index`` name the feature columns, ``label`` a 0/1
    column, for regression any number (kept to ``1 / unit``), or for task "multi" a
    column whose values are the classes, numbered by frequency, ties by value (at most
    ``feat.LOCAL_LABELS``).  ``row_id``
    names the column whose hash draws the rows of each tree; by default a hash of
    the whole row, so equal rows are drawn together.  Rows with a null feature or
    label are not learned from.
    """
    rows = train if row_id is None else train.withColumn("rid", F.col(row_id).cast("string"))
    if row_id is None:
        rows = train.withColumn("rid", F.md5(F.to_json(F.struct(*train.columns))))
    classes = []
    if cfg.task == fo.CLASSES:
        classes = [r["value"] for r in feat.string_index_table(train, label).orderBy("idx").limit(feat.LOCAL_LABELS + 1).collect()]
        if not 2 <= len(classes) <= feat.LOCAL_LABELS:
            raise ValueError(f"{label} has {len(classes)} classes; a forest takes 2 to {feat.LOCAL_LABELS}")
        cfg = replace(cfg, n_classes=len(classes))
    model = ForestModel(cfg, list(numeric), label, label_tables(train, list(to_index)), None, None, unit, classes)
    ready = materialize(model._x(rows).select("rid", "x", model._y().alias("y")), "forest-rows")
    model.nodes = fit_forest(ready, cfg, len(numeric) + len(to_index))
    return model


@dataclass
class GridResult:
    nodes: DataFrame
    votes: DataFrame
    scores: DataFrame
    best: DataFrame


def run_grid(spark: SparkSession, sf_dir: str, cfg: ForestConfig) -> GridResult:
    """The grid on lineitem: fitted on the training share, every key scored on the test share."""
    train, test = feature_rows(spark, sf_dir, cfg)
    nodes = fit_forest(train, cfg)
    # Written once (test rows x keys): read by the metric, the best-key choice and the predictions.
    votes = materialize(scored(test, nodes, cfg), "votes")
    scores = key_scores(votes, cfg)
    return GridResult(nodes, votes, scores, best_key(scores, cfg))


def best_predictions(res: GridResult, task: str) -> DataFrame:
    """Test rows of the best key with ``prediction`` (and ``probability`` for classification)."""
    chosen = res.votes.join(F.broadcast(res.best.select("k")), "k", "inner")  # one row
    if task == "clf":
        chosen = chosen.withColumn("probability", F.array(F.lit(1.0) - F.col("prob"), F.col("prob")))
        return chosen.select("rid", "k", "x", "y", "prediction", "probability")
    return chosen.select("rid", "k", "x", "y", "prediction")
