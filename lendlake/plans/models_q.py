"""Model fits, comparisons, sweeps and batch scoring (rows-only checks).

Fitted models have no SQL twin; their invariants are tested in
``tests/test_models.py`` (closed forms, penalty mappings, probability ranges).
"""

from __future__ import annotations

import uuid
from functools import cached_property, reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.config import GROUPER_MIN_COUNT, PROBABILITY_C, SEVERITY_ALPHA
from lendlake.operators import convex
from lendlake.operators import features as fx
from lendlake.operators import linear
from lendlake.operators import metrics as mx
from lendlake.operators import models as ml
from lendlake.operators import neighbors as nb
from lendlake.operators import profiling as pf
from lendlake.operators import scoring as sc
from lendlake.operators import trees
from lendlake.operators.pipeline import LinearModel
from lendlake.operators.quantiles import exact_quantiles
from lendlake.plans.features_q import SEV_CATS, SEVERITY_SQL, TRAIN_NUM, TRAINING_SQL
from lendlake.plans.registry import MEMOS, portfolio, query, staging_folder
from lendlake.session import stored
from lendlake.sources import sinks
from lendlake.sources.fixture import FIXTURE_CUTOFF

TRAIN_CATS = ["feat_001_grouped", "feat_003", "feat_041"]
CLS_ID = ["loan_id", "split", "received_date", "is_loss"]
SEV_ID = ["loan_id", "split", "received_date", "is_loss", "loss_amount"]


class ClassifierData:
    """Prepared model rows; every fitted step learns from the fit rows only.

    Fit and held-out rows are train and test, or with ``validation`` the two
    parts of a hash split inside train.
    """

    def __init__(self, spark, sf_dir, validation=False):
        p = portfolio(spark, sf_dir)
        ts = fx.booleans_to_int(fx.training_set(p.joined, p.cfg), keep=["is_loss"])
        self.cat, self.num = fx.route_columns(ts, CLS_ID)
        ts = stored(ts.withColumn("label", F.col("is_loss").cast("double")), "classifier-rows")
        fit, held = _parts(ts, validation)
        weights = fx.class_weights(fit, "is_loss")
        self.pre = ml.fit_preprocessor(fit, self.cat, self.num)
        self._weighted = fx.with_class_weight(self.pre.transform(fit), weights, "is_loss")
        self._points: dict = {}
        by_class = {int(r["is_loss"]): r["class_weight"] for r in weights.where(F.col("is_loss").isNotNull()).collect()}  # two rows
        self.weights = by_class.get(0, 1.0), by_class.get(1, 1.0)
        self.fit_rows, self.held_rows = fit, held
        self.grown = None

    # The tree needs no vectors, so these are made when a model first asks for them.
    @cached_property
    def train(self) -> DataFrame:
        return stored(self._weighted, "classifier-train")

    @cached_property
    def test(self) -> DataFrame:
        return stored(self.pre.transform(self.held_rows), "classifier-test")

    @cached_property
    def rows(self) -> DataFrame:
        return stored(convex.prepared(self._weighted), "classifier-sums")

    @cached_property
    def some_rows(self) -> tuple[DataFrame, float] | None:
        """For all fits to a large table: the rows that bring each near its point, so that few passes read all."""
        return convex._some_rows(self.rows)

    def tree(self, max_depth: int | None) -> DataFrame:
        """L3: held-out rows scored by the exact tree; a deeper tree, once grown, answers smaller depths."""
        if self.grown is None or (self.grown[0] is not None and (max_depth is None or max_depth > self.grown[0])):
            both = [df.select(F.col("loan_id").alias("id"), F.lit(fit).alias("fit"), "label", trees.entries(self.cat, self.num, self.pre.medians).alias("entries"))
                    for df, fit in ((self.fit_rows.where(F.col("label").isNotNull()), True), (self.held_rows, False))]
            self.grown = max_depth, trees.grow(both[0].unionByName(both[1]), self.weights, max_depth)
        scores = self.grown[1].predict(max_depth)
        truth = self.held_rows.select("loan_id", "received_date", F.col("is_loss").cast("int").alias("actual_is_loss"))
        return truth.join(scores.withColumnRenamed("id", "loan_id"), "loan_id")


class SeverityData:
    def __init__(self, spark, sf_dir, validation=False):
        p = portfolio(spark, sf_dir)
        sev = fx.booleans_to_int(fx.severity_set(p.joined, p.cfg), keep=["is_loss"])
        self.cat, self.num = fx.route_columns(sev, SEV_ID)
        sev = stored(fx.log_target(sev, "loss_amount", "label"), "severity-rows")
        self.fit_rows, self.held_rows = _parts(sev, validation)
        self.pre = ml.fit_preprocessor(self.fit_rows, self.cat, self.num, group_rare=True, rare_min_count=GROUPER_MIN_COUNT)
        self.train = stored(self.pre.transform(self.fit_rows), "severity-train")
        self.test = stored(self.pre.transform(self.held_rows), "severity-test")
        names = self.pre.feature_names
        self.design = linear.Design(tuple(range(len(names))))
        # M9: the ten best numeric columns expanded (the reference's count), all other columns as they are.
        top = self.by_correlation()[:10]
        self.best = names.index(top[0])
        kept = tuple(i for i, name in enumerate(names) if name not in set(top))
        self.wide = linear.Design(kept, tuple(names.index(c) for c in top), DEGREES[-1])
        self._moments: dict = {}

    def moments(self, design: linear.Design) -> linear.Moments:
        """Cross products of the fit rows, computed once for each design."""
        if design not in self._moments:
            self._moments[design] = linear.moments(self.train, design)
        return self._moments[design]

    def amounts(self, design: linear.Design, models: list[linear.Linear]) -> DataFrame:
        """Held-out rows with ``amounts``: each model's prediction in currency, none below 0."""
        pred = linear.predictions(self.test.select("loan_id", "received_date", "loss_amount", "features"), design, models)
        back = F.transform("predictions", lambda x: F.greatest(F.expm1(x), F.lit(0.0)))
        return pred.select("loan_id", "received_date", F.col("loss_amount").cast("double").alias("actual_loss_amount"), back.alias("amounts"))

    def by_correlation(self):
        """Numeric columns by the size of their correlation with the loss amount on the fit rows."""
        rows = pf.correlation_with_target(self.fit_rows, self.num, "loss_amount").collect()  # one row a column
        return [r["column_name"] for r in rows if r["correlation"] is not None]


def _parts(df: DataFrame, validation: bool) -> tuple[DataFrame, DataFrame]:
    train = df.where(F.col("split") == "train")
    if not validation:
        return train, df.where(F.col("split") == "test")
    cut = fx.hash_split(train, "loan_id", 0.2)
    return cut.where(~F.col("is_validation")).drop("is_validation"), cut.where(F.col("is_validation")).drop("is_validation")


_DATA: dict = {}
MEMOS.append(_DATA)


def _memo(cls, spark, sf_dir, validation=False):
    """Prepared (stored) model inputs, shared by the model queries of a session."""
    key = (cls.__name__, spark.sparkContext.applicationId, sf_dir, validation)
    if key not in _DATA:
        _DATA[key] = cls(spark, sf_dir, validation)
    return _DATA[key]


def _kept(spark, sf_dir, name: str, build) -> DataFrame:
    """A report of fitted models, written once per session and input folder."""
    key = (name, spark.sparkContext.applicationId, sf_dir)
    if key not in _DATA:
        _DATA[key] = stored(build(), name)
    return _DATA[key]


def _fitted(d: ClassifierData, kind: str, C: float) -> convex.Fitted:
    """Fitted once for each C; a fit starts from the nearest C fitted before."""
    done = d._points
    if (kind, C) not in done:
        near = min((c for k, c in done if k == kind), key=lambda c: abs(np.log(c / C)), default=None)
        start = None if near is None else done[kind, near].point
        done[kind, C] = (convex.fit_logistic if kind == "logistic" else convex.fit_svm)(d.rows, C, start, near=d.some_rows)
    return done[kind, C]


def _class_predictions(d: ClassifierData, kind: str, param) -> DataFrame:
    if kind == "tree":
        return d.tree(param)
    return _scored(d, _fitted(d, kind, param), kind)


def _scored(d: ClassifierData, model: convex.Fitted, kind: str) -> DataFrame:
    out = LinearModel.of(model).transform(d.test)
    score = F.col("prediction") if kind == "svm" else 1 / (1 + F.exp(-F.col("prediction")))
    return out.select("loan_id", "received_date", F.col("is_loss").cast("int").alias("actual_is_loss"), score.alias("score"),
                      (F.col("prediction") > 0).cast("int").alias("predicted"))


# The scaled matrix of the classifiers: numbers, then marks of the training levels.
_SCALED = ", ".join(
    f"(coalesce(CAST(ts.{c} AS DOUBLE), md.{c}) - sc.{c}[1]) / sc.{c}[2]" for c in TRAIN_NUM
)
CLASSIFIER_MATRIX_SQL = f"""
ts AS ({TRAINING_SQL.strip()}),
md AS (SELECT {', '.join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in TRAIN_NUM)} FROM ts WHERE split = 'train'),
sc AS (
    SELECT {', '.join(f"[avg(coalesce(CAST(ts.{c} AS DOUBLE), md.{c})), CASE WHEN stddev_pop(coalesce(CAST(ts.{c} AS DOUBLE), md.{c})) = 0 THEN 1 ELSE stddev_pop(coalesce(CAST(ts.{c} AS DOUBLE), md.{c})) END] AS {c}" for c in TRAIN_NUM)}
    FROM ts CROSS JOIN md WHERE split = 'train'),
lv AS (SELECT {', '.join(f"list(DISTINCT coalesce({c}, 'MISSING')) AS {c}" for c in TRAIN_CATS)} FROM ts WHERE split = 'train'),
m AS (
    SELECT loan_id, split, received_date, CAST(is_loss AS INTEGER) AS y, [{_SCALED}]
        || {' || '.join(f"list_transform(lv.{c}, lambda l: CASE WHEN l = coalesce(ts.{c}, 'MISSING') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)" for c in TRAIN_CATS)} AS v
    FROM ts CROSS JOIN md CROSS JOIN sc CROSS JOIN lv)"""


def _newton_sql(i: int) -> str:
    """One full Newton step for the balanced logistic regression, from ``b{i}`` to ``b{i + 1}``; the intercept comes last."""
    return f"""
u{i} AS (
    SELECT loan_id, j, x, w * (mu - y) AS r, w * mu * (1 - mu) AS h
    FROM nz JOIN (SELECT loan_id, y, w, 1 / (1 + exp(-list_dot_product(v, b))) AS mu FROM z CROSS JOIN b{i}) USING (loan_id)),
s{i} AS (
    SELECT j, k, {PROBABILITY_C} * hx + CASE WHEN j = k AND j < n THEN 1 ELSE 0 END AS e FROM (
        SELECT a.j, c.j AS k, sum(a.h * a.x * c.x) AS hx FROM u{i} a JOIN u{i} c USING (loan_id) GROUP BY a.j, c.j) CROSS JOIN size
    UNION ALL
    SELECT j, n + 1, {PROBABILITY_C} * sum(r * x) + CASE WHEN j < n THEN any_value(b[j]) ELSE 0 END FROM u{i} CROSS JOIN b{i} CROSS JOIN size GROUP BY j, n),
full{i} AS (
    SELECT j, k, coalesce(e, CASE WHEN j = k THEN 1 ELSE 0 END) AS e
    FROM (SELECT unnest(range(1, n + 1)) AS j FROM size) CROSS JOIN (SELECT unnest(range(1, n + 2)) AS k FROM size) LEFT JOIN s{i} USING (j, k)),
solve{i} AS (
    SELECT 1 AS step, list(row ORDER BY j) AS mat FROM (SELECT j, list(e ORDER BY k) AS row FROM full{i} GROUP BY j)
    UNION ALL
    SELECT step + 1, list_transform(mat, lambda r, m: CASE WHEN m = step THEN r ELSE
        list_transform(r, lambda c, j: c - r[step] / mat[step][step] * mat[step][j]) END) FROM solve{i} WHERE step <= len(mat)),
b{i + 1} AS (
    SELECT list_transform(b, lambda c, j: c - mat[j][len(mat) + 1] / mat[j][j]) AS b FROM solve{i} CROSS JOIN b{i} WHERE step = len(mat) + 1)"""


NEWTON_STEPS = 10


@query("model_logistic", "RECURSIVE" + CLASSIFIER_MATRIX_SQL + f""",
z AS (
    SELECT loan_id, y, v || [1.0] AS v, CAST(count(*) OVER () AS DOUBLE) / (2 * count(*) OVER (PARTITION BY y)) AS w
    FROM m WHERE split = 'train'),
size AS (SELECT max(len(v)) AS n FROM z),
nz AS (SELECT * FROM (SELECT loan_id, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM z) WHERE x <> 0),
b0 AS (SELECT list_transform(range(n), lambda c: 0.0::DOUBLE) AS b FROM size),
{','.join(_newton_sql(i) for i in range(NEWTON_STEPS)).strip()}
SELECT loan_id, received_date, y AS actual_is_loss, round(1 / (1 + exp(-list_dot_product(v || [1.0], b))), 6) AS score,
    CASE WHEN list_dot_product(v || [1.0], b) > 0 THEN 1 ELSE 0 END AS predicted
FROM m CROSS JOIN b{NEWTON_STEPS} WHERE split = 'test'
""")
def q_model_logistic(spark, sf_dir):
    """Balanced logistic regression (C = 1), test-row probabilities to six places."""
    found = _class_predictions(_memo(ClassifierData, spark, sf_dir), "logistic", PROBABILITY_C)
    return found.withColumn("score", F.round("score", 6))


@query("model_linear_svm")
def q_model_linear_svm(spark, sf_dir):
    """L2: balanced linear SVM (C = 10), test-row decision scores."""
    return _class_predictions(_memo(ClassifierData, spark, sf_dir), "svm", 10.0)


# The model matrix as (loan_id, f, v), non-zero values only, and the depth-2 tree over it, a level at a time.
MATRIX_SQL = f"""
ts AS ({TRAINING_SQL.strip()}),
md AS (SELECT {', '.join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in TRAIN_NUM)} FROM ts WHERE split = 'train'),
long AS (
    {' UNION ALL '.join(f"SELECT loan_id, '{c}' AS f, coalesce(CAST(ts.{c} AS DOUBLE), md.{c}) AS v FROM ts CROSS JOIN md" for c in TRAIN_NUM)}
    UNION ALL {' UNION ALL '.join(f"SELECT loan_id, '{c}=' || coalesce({c}, 'MISSING'), 1.0 FROM ts" for c in TRAIN_CATS)}),
x AS (SELECT loan_id, f, v FROM long WHERE v <> 0)"""


def _tree_level_sql(i: int) -> str:
    return f"""
n{i} AS (SELECT node, count(*) FILTER (y = 0) AS n0, count(*) FILTER (y = 1) AS n1 FROM who{i} WHERE fit GROUP BY node),
g{i} AS (
    SELECT node, f, v, count(*) FILTER (y = 0) AS c0, count(*) FILTER (y = 1) AS c1
    FROM who{i} JOIN x USING (loan_id) WHERE fit GROUP BY node, f, v),
a{i} AS (
    SELECT * FROM g{i} UNION ALL
    SELECT node, f, 0.0, any_value(n0) - sum(c0), any_value(n1) - sum(c1) FROM g{i} JOIN n{i} USING (node)
    GROUP BY node, f HAVING any_value(n0 + n1) > sum(c0 + c1)),
s{i} AS (
    SELECT node, f, v, lead(v) OVER p AS nxt, sum(c0) OVER p AS l0, sum(c1) OVER p AS l1
    FROM a{i} WINDOW p AS (PARTITION BY node, f ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
e{i} AS (
    SELECT node, f, v, (v + nxt) / 2 AS cut, l0 * w0 AS a, l1 * w1 AS b, (n0 - l0) * w0 AS c, (n1 - l1) * w1 AS d
    FROM s{i} JOIN n{i} USING (node) CROSS JOIN w WHERE nxt IS NOT NULL AND n0 > 0 AND n1 > 0),
b{i} AS (
    SELECT node, f, cut FROM e{i}
    QUALIFY row_number() OVER (PARTITION BY node ORDER BY 2.0 * a * b / (a + b) + 2.0 * c * d / (c + d), f, v) = 1),
who{i + 1} AS (
    SELECT loan_id, fit, y, received_date,
        node || CASE WHEN b{i}.f IS NULL THEN '' WHEN coalesce(x.v, 0) <= cut THEN 'l' ELSE 'r' END AS node
    FROM who{i} LEFT JOIN b{i} USING (node) LEFT JOIN x USING (loan_id, f))"""


@query("model_tree", MATRIX_SQL + f""",
w AS (
    SELECT CAST(count(*) AS DOUBLE) / (2 * count(*) FILTER (NOT is_loss)) AS w0, CAST(count(*) AS DOUBLE) / (2 * count(*) FILTER (is_loss)) AS w1
    FROM ts WHERE split = 'train'),
who0 AS (SELECT loan_id, split = 'train' AS fit, CAST(is_loss AS INTEGER) AS y, received_date, '' AS node FROM ts),
{_tree_level_sql(0).strip()},
{_tree_level_sql(1).strip()},
leaf AS (SELECT node, count(*) FILTER (y = 0) * any_value(w0) AS a, count(*) FILTER (y = 1) * any_value(w1) AS b FROM who2 CROSS JOIN w WHERE fit GROUP BY node)
SELECT loan_id, received_date, y AS actual_is_loss, b / (a + b) AS score, CASE WHEN b / (a + b) > 0.5 THEN 1 ELSE 0 END AS predicted
FROM who2 JOIN leaf USING (node) WHERE NOT fit
""")
def q_model_tree(spark, sf_dir):
    """L3: balanced decision tree (depth 2), test-row probabilities."""
    return _class_predictions(_memo(ClassifierData, spark, sf_dir), "tree", 2)


def _classification_rows(named: list[tuple[str, DataFrame]]) -> DataFrame:
    """E1-E3 of several models' predictions, one row a model, ranked in one pass."""
    parts = [preds.select(F.lit(name).alias("model"), "actual_is_loss", "score", "predicted") for name, preds in named]
    scored = reduce(DataFrame.unionByName, parts)
    ranks = mx.rank_metrics_by_group(scored, "model", "score", "actual_is_loss")
    rows = ranks.join(mx.threshold_metrics(scored, "predicted", "actual_is_loss", ["model"]), "model")
    return rows.withColumnRenamed("average_precision", "pr_auc")


def _knn_predictions(d: ClassifierData, k: int) -> DataFrame:
    scores = nb.knn_probability(d.test, d.train, k, "loan_id")
    truth = d.test.select("loan_id", "received_date", F.col("is_loss").cast("int").alias("actual_is_loss"))
    return truth.join(scores, "loan_id").withColumn("predicted", (F.col("score") > 0.5).cast("int"))


def _kept_knn(spark, sf_dir) -> DataFrame:
    return _kept(spark, sf_dir, "knn-40", lambda: _knn_predictions(_memo(ClassifierData, spark, sf_dir), 40))


COMPARED = [("SVM (C=10, linear)", "svm", 10.0), ("Logistic Regression (C=1.0)", "logistic", 1.0),
            ("Decision Tree (max_depth=2)", "tree", 2)]


@query("model_comparison")
def q_model_comparison(spark, sf_dir):
    """Four classifiers compared on the test split, sorted by ROC-AUC."""
    d = _memo(ClassifierData, spark, sf_dir)

    def build():
        named = [(name, stored(_class_predictions(d, kind, param), kind)) for name, kind, param in COMPARED]
        return _classification_rows([*named, ("KNN (k=40)", _kept_knn(spark, sf_dir))])

    return _kept(spark, sf_dir, "model-comparison", build).orderBy(F.col("roc_auc").desc())


@query("classification_predictions")
def q_classification_predictions(spark, sf_dir):
    """Test rows with the SVM score, the logistic probability and the risk decile, riskiest first."""
    both = _kept(spark, sf_dir, "class-predictions", lambda: _both_scores(_memo(ClassifierData, spark, sf_dir)))
    return mx.with_risk_decile(both, "svm_score").orderBy(F.col("svm_score").desc(), "loan_id")


def _both_scores(d: ClassifierData) -> DataFrame:
    svm = _class_predictions(d, "svm", 10.0).select("loan_id", "received_date", "actual_is_loss", F.col("score").alias("svm_score"))
    logreg = _class_predictions(d, "logistic", 1.0).select("loan_id", F.col("score").alias("logreg_probability_of_loss"))
    return svm.join(logreg, "loan_id")


def _severity_predictions(d: SeverityData, model: linear.Linear) -> DataFrame:
    table = d.amounts(d.design, [model])
    return table.select("loan_id", "received_date", "actual_loss_amount", F.col("amounts")[0].alias("predicted_loss_amount"))


def _in_cents(table: DataFrame) -> DataFrame:
    return table.withColumn("predicted_loss_amount", F.round("predicted_loss_amount", 2))


# The severity model matrix, centred, and the normal equations solved by elimination.  A column that
# depends on earlier ones has no pivot and gets no coefficient: the fitted values are the same.
SEVERITY_MATRIX_SQL = f"""
raw AS ({SEVERITY_SQL.strip()}),
sev AS (
    SELECT loan_id, split, received_date, loss_amount, {', '.join(f"CAST({c} AS DOUBLE) AS {c}" for c in TRAIN_NUM)},
        {', '.join(f"CASE WHEN count(*) FILTER (split = 'train') OVER (PARTITION BY {c}) >= {GROUPER_MIN_COUNT} THEN coalesce({c}, 'MISSING') ELSE 'RARE' END AS {c}" for c in SEV_CATS)}
    FROM raw),
md AS (SELECT {', '.join(f"median({c}) AS {c}" for c in TRAIN_NUM)} FROM sev WHERE split = 'train'),
sc AS (
    SELECT {', '.join(f"[avg(coalesce(sev.{c}, md.{c})), CASE WHEN stddev_pop(coalesce(sev.{c}, md.{c})) = 0 THEN 1 ELSE stddev_pop(coalesce(sev.{c}, md.{c})) END] AS {c}" for c in TRAIN_NUM)}
    FROM sev CROSS JOIN md WHERE split = 'train'),
lv AS (SELECT {', '.join(f"list_sort(list(DISTINCT {c})) AS {c}" for c in SEV_CATS)} FROM sev WHERE split = 'train'),
m AS (
    SELECT loan_id, split, received_date, loss_amount, ln(1 + loss_amount) AS y,
        [{', '.join(f"(coalesce(sev.{c}, md.{c}) - sc.{c}[1]) / sc.{c}[2]" for c in TRAIN_NUM)}]
        || {' || '.join(f"list_transform(lv.{c}, lambda l: CASE WHEN l = sev.{c} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)" for c in SEV_CATS)} AS v
    FROM sev CROSS JOIN md CROSS JOIN sc CROSS JOIN lv),
z AS (
    SELECT loan_id, i, val - avg(val) OVER (PARTITION BY i) AS val, avg(val) OVER (PARTITION BY i) AS mean
    FROM (SELECT loan_id, unnest(v || [y]) AS val, generate_subscripts(v || [y], 1) AS i FROM m WHERE split = 'train')),
g AS (SELECT a.i, b.i AS j, sum(a.val * b.val) AS s FROM z a JOIN z b USING (loan_id) GROUP BY a.i, b.i),
means AS (SELECT list(mean ORDER BY i) AS means FROM (SELECT DISTINCT i, mean FROM z))"""


def _solved_sql(alphas: list[float]) -> str:
    return SEVERITY_MATRIX_SQL + f""",
start AS (
    SELECT alpha, list(r ORDER BY i) AS mat
    FROM (SELECT alpha, i, list(s + CASE WHEN i = j THEN alpha ELSE 0 END ORDER BY j) AS r
          FROM g CROSS JOIN (SELECT unnest({[float(a) for a in alphas]}) AS alpha)
          WHERE i < (SELECT max(i) FROM g) GROUP BY alpha, i)
    GROUP BY alpha),
solve AS (
    SELECT alpha, 1 AS k, mat FROM start
    UNION ALL
    SELECT alpha, k + 1, CASE WHEN abs(mat[k][k]) < 1e-6 THEN mat ELSE list_transform(mat, lambda r, i:
        CASE WHEN i = k THEN r ELSE list_transform(r, lambda c, j: c - r[k] / mat[k][k] * mat[k][j]) END) END
    FROM solve WHERE k <= len(mat)),
beta AS (
    SELECT alpha, list_transform(mat, lambda r, i: CASE WHEN abs(r[i]) < 1e-6 THEN 0 ELSE r[len(r)] / r[i] END) AS b
    FROM solve WHERE k = len(mat) + 1),
fitted AS (
    SELECT alpha, b, means[len(means)] - list_dot_product(b, means[1:len(b)]) AS a FROM beta CROSS JOIN means)"""


_PREDICTED_SQL = """
SELECT loan_id, received_date, loss_amount AS actual_loss_amount,
    round(greatest(exp(a + list_dot_product(b, v)) - 1, 0), 2) AS predicted_loss_amount
FROM m CROSS JOIN fitted WHERE split = 'test'"""


@query("model_ols", "RECURSIVE" + _solved_sql([0.0]) + _PREDICTED_SQL)
def q_model_ols(spark, sf_dir):
    """Least squares on log1p(loss), back-transformed, clipped at 0, in cents."""
    d = _memo(SeverityData, spark, sf_dir)
    return _in_cents(_severity_predictions(d, linear.ridge(d.moments(d.design), 0.0)))


@query("model_ridge", "RECURSIVE" + _solved_sql([SEVERITY_ALPHA]) + _PREDICTED_SQL)
def q_model_ridge(spark, sf_dir):
    """Ridge (alpha = 100) on log1p(loss), in cents."""
    return _in_cents(_ridge_predictions(_memo(SeverityData, spark, sf_dir)))


def _ridge_predictions(d: SeverityData) -> DataFrame:
    return _severity_predictions(d, linear.ridge(d.moments(d.design), SEVERITY_ALPHA))


@query("model_lasso")
def q_model_lasso(spark, sf_dir):
    """Lasso (alpha = 0.01) on log1p(loss)."""
    d = _memo(SeverityData, spark, sf_dir)
    return _severity_predictions(d, linear.lasso(d.moments(d.design), [LASSO_ALPHA])[LASSO_ALPHA])


@query("model_simple")
def q_model_simple(spark, sf_dir):
    """Regression on the one numeric column that correlates most with the loss amount."""
    d = _memo(SeverityData, spark, sf_dir)
    design = linear.Design((d.best,))
    table = d.amounts(design, [linear.ridge(d.moments(d.design).only([d.best]), 0.0)])
    return table.select("loan_id", "received_date", "actual_loss_amount", F.col("amounts")[0].alias("predicted_loss_amount"))


@query("lasso_nonzero")
def q_lasso_nonzero(spark, sf_dir):
    """How many coefficients the lasso keeps, per alpha of the sweep."""
    d = _memo(SeverityData, spark, sf_dir)
    models = linear.lasso(d.moments(d.design), LASSO_ALPHAS)
    rows = [(a, int((m.coefficients != 0).sum()), len(m.coefficients)) for a, m in sorted(models.items())]
    return spark.createDataFrame(rows, "alpha double, nonzero int, total int")


@query("regression_comparison")
def q_regression_comparison(spark, sf_dir):
    """Baseline, simple, multiple, polynomial, ridge and lasso, by RMSE, then MAE."""
    return _kept(spark, sf_dir, "regression-comparison", lambda: _regression_rows(spark, sf_dir)).orderBy("rmse", "mae")


def _regression_rows(spark, sf_dir) -> DataFrame:
    """All models over one matrix of the widest design, scored in one pass."""
    d = _memo(SeverityData, spark, sf_dir)
    degree = _best_degree(spark, sf_dir)
    m = d.moments(d.wide)
    plain = d.wide.columns(1)
    alone = m.only(plain)

    def placed(model: linear.Linear, columns: list[int]) -> linear.Linear:
        coefficients = np.zeros(d.wide.width)
        coefficients[columns] = model.coefficients
        return linear.Linear(coefficients, model.intercept)

    chosen = d.wide.columns(degree)
    models = {
        "Simple Linear Regression": placed(linear.ridge(m.only([0]), 0.0), [0]),
        "Multiple Linear Regression": placed(linear.ridge(alone, 0.0), plain),
        f"Polynomial Regression (degree {degree})": placed(linear.ridge(m.only(chosen), 0.0), chosen),
        "Ridge (alpha=100)": placed(linear.ridge(alone, SEVERITY_ALPHA), plain),
        "Lasso (alpha=0.01)": placed(linear.lasso(alone, [LASSO_ALPHA])[LASSO_ALPHA], plain),
    }
    train_amounts = d.fit_rows.select(F.col("loss_amount").cast("double").alias("y"))
    median = exact_quantiles(train_amounts, [], "y", [0.5], "m").select(F.col("m")[0]).scalar()
    return _metrics_of(d.amounts(d.wide, list(models.values())).withColumn("amounts", F.array_append("amounts", median)),
                       [(name,) for name in models] + [("Baseline (training median)",)], "model string")


def _metrics_of(amounts: DataFrame, names: list[tuple], schema: str) -> DataFrame:
    """E7 for each place of ``amounts``, with the name of that place."""
    long = amounts.select("actual_loss_amount", F.posexplode("amounts").alias("place", "predicted"))
    rows = mx.regression_metrics(long, "actual_loss_amount", "predicted", ["place"])
    named = amounts.sparkSession.createDataFrame([(i, *n) for i, n in enumerate(names)], f"place int, {schema}")
    return rows.join(F.broadcast(named), "place").drop("place")


# The parameters that the sweeps try (0 depth: unlimited).
LOGISTIC_C = [0.001, 0.01, 0.1, 1.0, 10.0, 100.0]
SVM_C = [0.1, 1.0, 10.0]
TREE_DEPTHS = [2, 3, 4, 5, 6, 8, 10, 12, 0]
DEGREES = (1, 2, 3)
LASSO_ALPHA = 0.01
RIDGE_ALPHAS = [0.01, 0.1, 1.0, 10.0, 100.0, 1000.0]
LASSO_ALPHAS = [0.0001, 0.001, 0.01, 0.1, 1.0]
CERTIFIED = 1e-6


@query("sweep")
def q_sweep(spark, sf_dir):
    """The classifier sweeps on a hash validation split inside train.

    All preparation is fitted on the fit part only.  ``is_best`` flags the
    highest ROC-AUC of a model (ties: the smaller parameter).
    """
    d = _memo(ClassifierData, spark, sf_dir, validation=True)
    d.tree(None)  # grown once, cut at every depth below
    tried = [("logistic", p) for p in LOGISTIC_C] + [("svm", p) for p in SVM_C] + [("tree", p) for p in TREE_DEPTHS]
    parts = []
    for run, (kind, param) in enumerate(tried):
        preds = _class_predictions(d, kind, (param or None) if kind == "tree" else param)
        names = [F.lit(run).alias("run"), F.lit(kind).alias("model"), F.lit(float(param)).alias("param")]
        parts.append(stored(preds.select(*names, "actual_is_loss", "score", "predicted"), "sweep"))
    scored = reduce(DataFrame.unionByName, parts)
    table = mx.threshold_metrics(scored, "predicted", "actual_is_loss", ["run", "model", "param"])
    table = table.join(mx.rank_metrics_by_group(scored, "run", "score", "actual_is_loss"), "run").drop("run")
    table = table.withColumnRenamed("average_precision", "pr_auc")
    return _flag_best(stored(table, "sweep"), F.col("roc_auc"))


@query("regression_sweep")
def q_regression_sweep(spark, sf_dir):
    """Ridge and lasso alphas by validation RMSE in currency; one pass fits, one scores all."""
    d = _memo(SeverityData, spark, sf_dir, validation=True)
    m = d.moments(d.design)
    lassos = linear.lasso(m, LASSO_ALPHAS)
    models = [linear.ridge(m, a) for a in RIDGE_ALPHAS] + [lassos[a] for a in LASSO_ALPHAS]
    names = [("ridge", a) for a in RIDGE_ALPHAS] + [("lasso", a) for a in LASSO_ALPHAS]
    return _flag_best(stored(_metrics_of(d.amounts(d.design, models), names, "model string, param double"), "sweep"), -F.col("rmse"))


@query("classifier_certificates", f"""
SELECT * FROM (SELECT 'logistic' AS model, unnest({LOGISTIC_C})::DOUBLE AS param UNION ALL SELECT 'svm', unnest({SVM_C})::DOUBLE)
CROSS JOIN (SELECT true AS is_optimal)
""")
def q_classifier_certificates(spark, sf_dir):
    """L1, L2: whether the gradient (logistic) or the duality gap (SVM) at each solution is within its bound."""
    d = _memo(ClassifierData, spark, sf_dir)
    found = [("logistic", C, _fitted(d, "logistic", C).error <= 1e-6) for C in LOGISTIC_C]
    found += [("svm", C, _fitted(d, "svm", C).error <= convex.GAP) for C in SVM_C]
    return spark.createDataFrame([(name, c, bool(ok)) for name, c, ok in found], "model string, param double, is_optimal boolean")


@query("regression_certificates", """
SELECT * FROM (
    SELECT 'ridge' AS model, unnest([0.0, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0])::DOUBLE AS param
    UNION ALL SELECT 'lasso', unnest([0.0001, 0.001, 0.01, 0.1, 1.0])
    UNION ALL SELECT 'polynomial', unnest([1.0, 2.0, 3.0])) CROSS JOIN (SELECT true AS is_optimal)
""")
def q_regression_certificates(spark, sf_dir):
    """Whether every solution meets its optimality conditions (``CERTIFIED`` of the largest |X'y|)."""
    d = _memo(SeverityData, spark, sf_dir)
    m, wide = d.moments(d.design), d.moments(d.wide)
    found = [("ridge", a, linear.certificate(m, linear.ridge(m, a), a, "l2")) for a in [0.0, *RIDGE_ALPHAS]]
    found += [("lasso", a, linear.certificate(m, model, a, "l1")) for a, model in linear.lasso(m, LASSO_ALPHAS).items()]
    for degree in DEGREES:
        part = wide.only(d.wide.columns(degree))
        found.append(("polynomial", float(degree), linear.certificate(part, linear.ridge(part, 0.0), 0.0, "l2")))
    return spark.createDataFrame([(name, p, off <= CERTIFIED) for name, p, off in found], "model string, param double, is_optimal boolean")


def _flag_best(table: DataFrame, score) -> DataFrame:
    best = table.groupBy("model").agg(F.max_by("param", F.struct(score, -F.col("param"))).alias("best_param"))
    return table.join(best, "model").withColumn("is_best", F.col("param") == F.col("best_param")).drop("best_param")


def _degrees(spark, sf_dir) -> DataFrame:
    d = _memo(SeverityData, spark, sf_dir)
    m, rows = d.moments(d.wide), []
    for degree in DEGREES:
        part = m.only(d.wide.columns(degree))
        rows.append((degree, m.n, linear.residual_sum(part, linear.ridge(part, 0.0).coefficients), len(part.xy) + 1))
    table = mx.bic_of_sums(spark.createDataFrame(rows, "degree int, n bigint, rss double, n_params int"), ["degree"])
    best = table.agg(F.min_by("degree", F.struct("bic", "degree"))).scalar()
    return table.withColumn("is_best", F.col("degree") == best)


def _best_degree(spark, sf_dir) -> int:
    return _degrees(spark, sf_dir).where("is_best").first()["degree"]


@query("poly_degree")
def q_poly_degree(spark, sf_dir):
    """Degree 1 to 3 for the ten columns that correlate most, all others kept; chosen by BIC."""
    return _degrees(spark, sf_dir)


@query("export_predictions", """
ts AS (SELECT count(*) AS n FROM loans_joined WHERE received_date >= DATE '""" + FIXTURE_CUTOFF + """' OR received_date IS NULL),
sev AS (SELECT count(*) AS n FROM loans_joined WHERE (received_date >= DATE '""" + FIXTURE_CUTOFF + """' OR received_date IS NULL) AND loss_amount > 0)
SELECT 'predictions_classification' AS mart, n AS rows, true AS in_order FROM ts
UNION ALL SELECT 'predictions_regression', n, true FROM sev
UNION ALL SELECT 'model_comparison_classification', 4, true
UNION ALL SELECT 'model_comparison_regression', 6, true
""")
def q_export_predictions(spark, sf_dir):
    """K4, O2, O3: both prediction tables and both comparisons as ordered CSV, read back in file order."""
    d = _memo(SeverityData, spark, sf_dir)
    regression = mx.prediction_rows(_ridge_predictions(d), "loan_id", "actual_loss_amount", "predicted_loss_amount", ["received_date"])
    frames = {
        "predictions_classification": (q_classification_predictions(spark, sf_dir), ["-svm_score", "loan_id"], False),
        "predictions_regression": (regression, ["-absolute_error", "loan_id"], False),
        "model_comparison_classification": (q_model_comparison(spark, sf_dir), ["-roc_auc"], True),
        "model_comparison_regression": (q_regression_comparison(spark, sf_dir), ["rmse", "mae"], True),
    }
    base = f"{staging_folder(spark, sf_dir)}/predictions-{uuid.uuid4().hex[:8]}"
    checks = []
    for name, (frame, order, single) in frames.items():
        keys = [F.col(k[1:]).desc() if k.startswith("-") else F.col(k) for k in order]
        sinks.export_csv(stored(frame, "export"), f"{base}/{name}", keys, single_file=single)
        checks.append(sinks.read_in_order(spark, f"{base}/{name}", order[:1]).select(F.lit(name).alias("mart"), "rows", "in_order"))
    return reduce(DataFrame.unionByName, checks)


@query("coefficients")
def q_coefficients(spark, sf_dir):
    """Ridge coefficients by magnitude (named by the assembled attributes)."""
    d = _memo(SeverityData, spark, sf_dir)
    model = linear.ridge(d.moments(d.design), SEVERITY_ALPHA)
    pairs = ml.coefficient_table(model, d.pre.feature_names)
    return spark.createDataFrame(pairs, "feature string, coefficient double")


def _scored_batch(spark, sf_dir) -> DataFrame:
    """Fit both pipelines, save and load them, score every loan in one pass; kept for the session."""
    def build():
        p = portfolio(spark, sf_dir)
        path = f"{staging_folder(spark, sf_dir)}/models-{uuid.uuid4().hex[:8]}"
        sc.save_models(sc.fit_scoring_models(p.joined, p.cfg), path)
        return sc.score_batch(sc.load_models(path), p.loans.select("loan_id"), p.joined, p.cfg)

    return _kept(spark, sf_dir, "batch-scores", build)


@query("batch_scoring")
def q_batch_scoring(spark, sf_dir):
    """Every loan scored by the two saved and reloaded pipelines."""
    return _scored_batch(spark, sf_dir)


_LEVELS_IN = {c: f"CASE WHEN coalesce(b.{c}, 'MISSING') IN (SELECT level FROM kept WHERE c = '{c}') THEN coalesce(b.{c}, 'MISSING') ELSE 'RARE' END" for c in SEV_CATS}


@query("batch_scoring_severity", "RECURSIVE" + _solved_sql([SEVERITY_ALPHA]) + f""",
ts AS ({TRAINING_SQL.strip()}),
kept AS (
    {' UNION ALL '.join(f"SELECT '{c}' AS c, coalesce({c}, 'MISSING') AS level FROM raw WHERE split = 'train' GROUP BY 2 HAVING count(*) >= {GROUPER_MIN_COUNT}" for c in SEV_CATS)}),
b AS (
    SELECT ts.* EXCLUDE (feat_001_grouped), CASE WHEN j.loss_amount > 0 THEN j.feat_001 ELSE ts.feat_001_grouped END AS feat_001, j.loss_amount
    FROM ts JOIN loans_joined j USING (loan_id)),
r AS (SELECT min(y) AS lo, max(y) AS hi FROM m WHERE split = 'train'),
logs AS (
    SELECT loan_id, received_date, split, loss_amount, a + list_dot_product(f.b,
        [{', '.join(f"(coalesce(CAST(b.{c} AS DOUBLE), md.{c}) - sc.{c}[1]) / sc.{c}[2]" for c in TRAIN_NUM)}]
        || {' || '.join(f"list_transform(lv.{c}, lambda l: CASE WHEN l = b.at_{c} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)" for c in SEV_CATS)}) AS y
    FROM (SELECT *, {', '.join(f"{x} AS at_{c}" for c, x in _LEVELS_IN.items())} FROM b) b CROSS JOIN md CROSS JOIN sc CROSS JOIN lv CROSS JOIN (SELECT a, b FROM fitted) f)
SELECT loan_id, strftime(received_date, '%Y-%m-%d') AS received_date, split AS data_split, split = 'train' AS scored_on_training_data,
    coalesce(loss_amount > 0, false) AS severity_in_population, NOT (y BETWEEN lo AND hi) AS severity_clipped,
    round(exp(least(greatest(y, lo), hi)) - 1, 2) AS predicted_loss_given_default
FROM logs CROSS JOIN r
""")
def q_batch_scoring_severity(spark, sf_dir):
    """What the reloaded severity pipeline says of every loan, with the flags of the record."""
    return _scored_batch(spark, sf_dir).drop("probability_of_default", "expected_loss_usd")


@query("model_knn", CLASSIFIER_MATRIX_SQL + """,
near AS (
    SELECT t.loan_id, arg_min(r.y, {'d': list_distance(t.v, r.v), 'id': r.loan_id}, 40) AS ys
    FROM m t JOIN m r ON t.split = 'test' AND r.split = 'train' GROUP BY t.loan_id)
SELECT loan_id, received_date, y AS actual_is_loss, list_avg(ys) AS score FROM near JOIN m USING (loan_id)
""")
def q_model_knn(spark, sf_dir):
    """L4: exact k-nearest-neighbour probability (k = 40) for the test rows."""
    return _kept_knn(spark, sf_dir).drop("predicted")


@query("oversample", f"""
sides AS (SELECT is_loss::INT::DOUBLE AS label, count(*) AS n FROM ({TRAINING_SQL.strip()}) WHERE split = 'train' GROUP BY 1),
short AS (SELECT arg_min(label, n) AS label, max(n) - min(n) AS missing FROM sides)
SELECT label, false AS is_synthetic, n AS rows FROM sides
UNION ALL SELECT label, true, missing FROM short WHERE missing > 0
""")
def q_oversample(spark, sf_dir):
    """Minority oversampling of the training vectors until the classes balance."""
    d = _memo(ClassifierData, spark, sf_dir)
    over = nb.smote(d.train, "loan_id", "label", "features")
    return over.groupBy("label", "is_synthetic").agg(F.count(F.lit(1)).alias("rows"))


@query("weighting_comparison")
def q_weighting_comparison(spark, sf_dir):
    """Class weights vs oversampling for the logistic model (test ROC-AUC / AP)."""
    d = _memo(ClassifierData, spark, sf_dir)
    weighted = stored(_class_predictions(d, "logistic", PROBABILITY_C), "weighted")
    over = nb.smote(d.train, "loan_id", "label", "features")
    preds = _scored(d, convex.fit_logistic(stored(convex.prepared(over, weight=None), "oversampled-sums"), PROBABILITY_C), "logistic")
    return _classification_rows([("Logistic (class weights)", weighted), ("Logistic (oversampled)", stored(preds, "oversampled-scores"))])


@query("knn_sweep")
def q_knn_sweep(spark, sf_dir):
    """L9 (k = 5..55 step 5), L4: one 55-neighbour search answers every k on the validation split."""
    d = _memo(ClassifierData, spark, sf_dir, validation=True)
    fit_part, val_part = d.train, d.test
    ks = list(range(5, 60, 5))
    nn = nb.nearest_neighbors(val_part, fit_part, max(ks), "loan_id", "loan_id")
    nn = stored(nn.select("test_id", "neighbor_rank", "train_label"), "knn-sweep")
    truth = val_part.select(F.col("loan_id").alias("test_id"), F.col("is_loss").cast("int").alias("y"))
    per_k = nn.groupBy("test_id").agg(
        *[F.avg(F.when(F.col("neighbor_rank") <= k, F.col("train_label"))).alias(f"k{k}") for k in ks]
    ).join(truth, "test_id")
    long = per_k.select("y", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("score")) for k in ks])).alias("s")).select("y", "s.*")
    table = mx.rank_metrics_by_group(long, "k", "score", "y").select("k", "roc_auc")
    best = table.agg(F.max_by("k", F.struct(F.col("roc_auc"), -F.col("k")))).scalar()
    return table.withColumn("is_best", F.col("k") == best)
