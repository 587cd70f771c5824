"""Scaling, clustering, churn models and their evaluation."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketlens import constants as C
from basketlens.functions.numeric import round_half_even
from basketlens.operators import churn, matrix, metrics, profiles
from basketlens.operators.reports import rounded
from basketlens.plans import churn_models, jobs, registry, segmentation, silhouette
from basketlens.plans.scaling import VECTOR
from basketlens.session import materialize, working_path
from basketlens.sources import star
from checks import fixtures as fx
from checks.registry import query
from checks.sql import FEATURES, define, even, sql

_SEG = C.SEGMENTATION_FEATURES


def _logged(name: str) -> str:
    return f"ln(1 + {name})" if name in C.LOG_SCALED_FEATURES else f"{name}::DOUBLE"


define(
    "scaled",
    "SELECT customer_id, cluster, "
    + ", ".join(
        f"({_logged(c)} - avg({_logged(c)}) OVER ()) / stddev_pop({_logged(c)}) OVER () AS {c}" for c in _SEG
    )
    + " FROM clustered",
    "clustered",
)
define(
    "centres",
    "SELECT cluster, count(*) AS n, "
    + ", ".join(f"avg({c}) AS {c}" for c in _SEG)
    + ", avg("
    + " + ".join(f"{c} * {c}" for c in _SEG)
    + ") AS mean_square FROM scaled GROUP BY cluster",
    "scaled",
)


def _scaled(spark, folder):
    clustered = profiles.rule_cluster(fx.stored_features(spark, folder))
    logged = matrix.log_scaled(clustered.select("customer_id", "cluster", *_SEG), C.LOG_SCALED_FEATURES)
    return matrix.standard_scaled(logged, _SEG)


@query(
    "i1_standard_scaled",
    sql(f"SELECT customer_id, {', '.join(f'{even(c, 6)} + 0.0 AS {c}' for c in _SEG)} FROM scaled", "scaled"),
)
def i1(spark, folder):
    return _scaled(spark, folder).select(
        "customer_id", *[(round_half_even(F.col(c), 6) + F.lit(0.0)).alias(c) for c in _SEG]
    )


_SQUARES = " + ".join(f"{c} * {c}" for c in _SEG)


@query(
    "i2_segmentation_fit",
    sql(
        f"""SELECT 4 AS clusters, count(*) AS customers, {even(f'sum({_SQUARES})', 3)} AS squares,
  (SELECT CAST(sum(recency) AS BIGINT) FROM rfm) AS recency FROM scaled""",
        "scaled",
        "rfm",
    ),
)
def i2(spark, folder):
    """Ten starts of four clusters: all customers are in one, and the cost adds up to the rows' squared lengths."""
    features = fx.stored_features(spark, folder)
    fitted = segmentation.choose_k(features, [4], starts=10, metric=None)
    sizes = segmentation.assign_clusters(features, fitted.model).groupBy("cluster").agg(
        F.count("customer_id").alias("customers"), F.sum("recency").alias("recency")
    )
    return sizes.agg(
        F.count("cluster").cast("int").alias("clusters"),
        F.sum("customers").alias("customers"),
        round_half_even(F.lit(fitted.fits[4].squares()), 3).alias("squares"),
        F.sum("recency").cast("long").alias("recency"),
    )


@query(
    "i3_choose_k",
    sql(
        f"""SELECT k::INTEGER AS k, (SELECT count(*) FROM scaled) AS customers,
  (SELECT {even(f'sum({_SQUARES})', 3)} FROM scaled) AS squares, true AS scored, 1 AS chosen FROM range(3, 7) AS r(k)""",
        "scaled",
    ),
)
def i3(spark, folder):
    """Every k is fitted on all customers and scored; one with the best score is chosen."""
    fitted = segmentation.choose_k(fx.stored_features(spark, folder), range(3, 7))
    rows = [(k, int(fit.counts.sum()), fit.squares()) for k, fit in fitted.fits.items()]
    found = spark.createDataFrame(rows, "k int, customers long, squares double")
    scores = segmentation.scores_frame(spark, fitted.scores)
    return _chosen(rounded(found.join(scores, "k"), 3, "squares"), fitted.k)


def _chosen(scored, k):
    """How many rows are the chosen k and have the best score: one."""
    every = Window.partitionBy()  # a row per k
    best = scored.withColumn("best", F.max("silhouette").over(every))
    hit = ((F.col("silhouette") == F.col("best")) & (F.col("k") == k)).cast("int")
    return best.select(
        "k", "customers", "squares", F.col("silhouette").between(-1, 1).alias("scored"), F.sum(hit).over(every).cast("int").alias("chosen")
    )


_PLAIN = " + ".join(f"(s.{c} - o.{c}) * (s.{c} - o.{c})" for c in _SEG)


@query(
    "i4_silhouette_euclidean",
    sql(
        f"""SELECT {even('avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END)', 3)} AS silhouette,
  true AS bounded
FROM (SELECT customer_id, max(CASE WHEN own AND n > 1 THEN far / (n - 1) END) AS a, min(CASE WHEN NOT own THEN far / n END) AS b
  FROM (SELECT s.customer_id, s.cluster = o.cluster AS own, sum(sqrt({_PLAIN})) AS far, count(*) AS n
    FROM scaled s, scaled o GROUP BY s.customer_id, s.cluster, o.cluster) GROUP BY customer_id)""",
        "scaled",
    ),
)
def i4_euclidean(spark, folder):
    """Plain silhouette of the rule clusters, from summaries of cells; the SQL side compares all pairs."""
    value, bound = silhouette.of_labels(_scaled(spark, folder), _SEG)
    found = spark.createDataFrame([(value, bound)], "silhouette double, bound double")
    return rounded(found, 3, "silhouette").select("silhouette", (F.col("bound") < 0.05).alias("bounded"))


@query(
    "i4_silhouette",
    sql(
        f"""SELECT {even('avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END)', 6)} AS silhouette
FROM (SELECT customer_id, max(CASE WHEN s.cluster = c.cluster AND n > 1 THEN d * n / (n - 1) END) AS a,
    min(CASE WHEN s.cluster <> c.cluster THEN d END) AS b
  FROM (SELECT s.customer_id, s.cluster AS own, c.cluster AS other, c.n,
      {' + '.join(f's.{c} * s.{c}' for c in _SEG)} + c.mean_square - 2 * ({' + '.join(f's.{c} * c.{c}' for c in _SEG)}) AS d
    FROM scaled s, centres c) AS x(customer_id, own, other, n, d),
    LATERAL (SELECT own AS cluster) s, LATERAL (SELECT other AS cluster) c
  GROUP BY customer_id)""",
        "scaled",
        "centres",
    ),
)
def i4(spark, folder):
    """Silhouette of the rule clusters under squared Euclidean distance, in linear time."""
    return rounded(metrics.silhouette_squared(_scaled(spark, folder), _SEG), 6, "silhouette")


@query(
    "i5_nearest_centre",
    sql(
        f"""SELECT customer_id, cluster FROM (SELECT s.customer_id, c.cluster, row_number() OVER (PARTITION BY s.customer_id
  ORDER BY {' + '.join(f'(s.{c} - c.{c}) * (s.{c} - c.{c})' for c in _SEG)}, c.cluster) AS place
FROM scaled s, centres c) WHERE place = 1""",
        "scaled",
        "centres",
    ),
)
def i5(spark, folder):
    scaled = _scaled(spark, folder)
    centres = scaled.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in _SEG])
    return matrix.nearest_centre(scaled.drop("cluster"), centres, _SEG).select("customer_id", "cluster")


@query("i5_assign_clusters", sql("SELECT customer_id, true AS nearest FROM rfm", "rfm"))
def i5_model(spark, folder):
    """Whatever the fit: the assigned cluster has the nearest of the model's centres."""
    features = fx.stored_features(spark, folder)
    model = segmentation.fit_segmentation(features, starts=1)
    values = vector_to_array(VECTOR)
    far = [
        sum((values[i] - float(x)) * (values[i] - float(x)) for i, x in enumerate(centre))
        for centre in model.stages[-1].clusterCenters()
    ]
    nearest = F.get(F.array(*far), F.col("cluster")) <= F.array_min(F.array(*far)) + 1e-9
    return model.transform(features).select("customer_id", nearest.alias("nearest"))


@query(
    "i6_single_cluster_inertia",
    sql(
        f"""SELECT {even('count(*) * (var_pop(recency) + var_pop(frequency) + var_pop(monetary))', 2)} AS inertia FROM wide""",
        "wide",
    ),
)
def i6_one(spark, folder):
    total = segmentation.total_inertia(fx.features_wide(spark, folder), ["recency", "frequency", "monetary"])
    return rounded(total, 2, "inertia")


@query("i6_elbow", "SELECT CAST(k AS INTEGER) AS k, true AS falling FROM range(1, 11) AS r(k)")
def i6(spark, folder):
    """Every further cluster lowers the inertia of the one before, up to a tenth that another start may cost."""
    before = F.lag("inertia").over(Window.orderBy("k"))  # ten rows
    return segmentation.elbow(fx.stored_features(spark, folder)).select(
        "k", F.coalesce(F.col("inertia") <= 1.1 * before, F.lit(True)).alias("falling")
    )


_CORNERS = [(0, 1), (0, 2), (1, 2)]


@query(
    "i7_principal_components",
    sql(
        f"""SELECT customers, 0.0::DOUBLE AS mean_1, 0.0::DOUBLE AS mean_2, 0.0::DOUBLE AS covariance,
  {even('first / 3', 6)} + 0.0 AS share_1, {even('(3 - first - third) / 3', 6)} + 0.0 AS share_2
FROM (SELECT customers, 1 + 2 * p * cos(acos(least(1.0, greatest(-1.0, a * b * c / (p * p * p)))) / 3) AS first,
    1 + 2 * p * cos(acos(least(1.0, greatest(-1.0, a * b * c / (p * p * p)))) / 3 + 2 * pi() / 3) AS third
  FROM (SELECT *, sqrt((a * a + b * b + c * c) / 3) AS p
    FROM (SELECT count(*) AS customers, {', '.join(f'corr({_SEG[i]}, {_SEG[j]}) AS {n}' for n, (i, j) in zip('abc', _CORNERS))} FROM scaled)))""",
        "scaled",
    ),
)
def i7(spark, folder):
    """Components are centred and uncorrelated; their shares are the eigenvalues the SQL side has from the cubic equation."""
    projected, shares = segmentation.principal_components(fx.stored_features(spark, folder))
    facts = projected.agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("pc1").alias("mean_1"),
        F.avg("pc2").alias("mean_2"),
        F.covar_pop("pc1", "pc2").alias("covariance"),
    )
    found = facts.withColumns({f"share_{i}": F.lit(float(share)) for i, share in enumerate(shares, start=1)})
    names = ["mean_1", "mean_2", "covariance", "share_1", "share_2"]
    return rounded(found, 6, *names).select("customers", *[(F.col(n) + F.lit(0.0)).alias(n) for n in names])


def _solved(features, named, source="training", group="0", value="value"):
    """Weights of a logistic regression by accelerated gradient steps in SQL: another way than the one that is checked.

    The training side is split and scaled per group. A step is as long as the largest curvature allows.
    """
    width = len(features) + 1
    every, last = range(width), width - 1
    scaled = ", ".join(
        f"({c} - avg({c}) OVER (PARTITION BY part)) / coalesce(nullif(stddev_pop({c}) OVER (PARTITION BY part), 0), 1) AS x{i}"
        for i, c in enumerate(features)
    )
    score = " + ".join(f"l{i} * x{i}" for i in every)
    moved = ", ".join(
        f"any_value(l{i}) - (sum(d * x{i}){f' + any_value(l{i})' if i < last else ''}) / (count(*) * {width} / 4.0::DOUBLE + 1) AS v{i}"
        for i in every
    )
    kept = ", ".join(f"any_value(w{i}) AS w{i}" for i in every)
    kind = "'coefficient' AS kind, " if value == "value" else ""
    rows = " UNION ALL ".join(
        f"SELECT {named}, {kind}'{c}' AS feature, {even(f'w{i}', 4)} + 0.0 AS {value} FROM ends" for i, c in enumerate(features)
    )
    return f"""SELECT * FROM (WITH RECURSIVE halves AS (
    SELECT *, {group} AS part, row_number() OVER (PARTITION BY {group}, churn ORDER BY md5(customer_id || '|42'), customer_id)
      <= ceil(count(*) OVER (PARTITION BY {group}, churn) * 0.2::DOUBLE) AS is_test FROM {source}),
  side AS MATERIALIZED (SELECT part, churn::DOUBLE AS y, {scaled}, 1.0::DOUBLE AS x{last} FROM halves WHERE NOT is_test),
  steps AS (
    SELECT DISTINCT part, 0 AS n, {', '.join(f'0.0::DOUBLE AS w{i}' for i in every)}, {', '.join(f'0.0::DOUBLE AS l{i}' for i in every)} FROM side
    UNION ALL
    SELECT part, n + 1, {', '.join(f'v{i}' for i in every)}, {', '.join(f'v{i} + 0.95 * (v{i} - w{i})' for i in every)}
    FROM (SELECT part, any_value(n) AS n, {kept}, {moved}
      FROM (SELECT steps.*, {', '.join(f'x{i}' for i in every)}, 1 / (1 + exp(-({score}))) - y AS d
        FROM steps JOIN side USING (part) WHERE n < 1500) GROUP BY part)),
  ends AS (SELECT *, part AS cutoff_days FROM steps WHERE n = 1500)
  {rows})"""


def _train(spark, folder):
    return churn_models.split_training(fx.churn_training_frame(spark, folder))


def _weights(name):
    def run(spark, folder):
        train, _ = _train(spark, folder)
        model = churn_models.fit(name, train)
        return churn_models.weights_frame(spark, [(name, *row) for row in churn_models.weights(model)])

    return run


def _importances(name):
    def run(spark, folder):
        """Importances are shares: none is negative and together they are 1."""
        rows = _weights(name)(spark, folder)
        total = F.round(F.sum("value").over(Window.partitionBy("model")), 6)  # six rows
        return rows.select("model", "kind", "feature", (F.col("value") >= 0).alias("share"), total.alias("together"))

    return run


def _shares(name):
    rows = ", ".join(f"('{feature}')" for feature in C.CHURN_FEATURES)
    return f"""SELECT '{name}' AS model, 'importance' AS kind, feature, true AS share, 1.0::DOUBLE AS together
FROM (VALUES {rows}) AS f(feature)"""


def _solution(features):
    def run(spark, folder):
        train, _ = _train(spark, folder)
        model = churn_models.fit(churn_models.LOGISTIC, train, features)
        rows = [(churn_models.LOGISTIC, *row) for row in churn_models.weights(model, features)]
        return rounded(churn_models.weights_frame(spark, rows), 4, "value").withColumn("value", F.col("value") + F.lit(0.0))

    return run


query("i8_logistic_regression", sql(_solved(C.CHURN_FEATURES, "'LogisticRegression' AS model"), "training"))(_solution(C.CHURN_FEATURES))
query("i9_random_forest", _shares("RandomForest"))(_importances(churn_models.FOREST))
query("i10_gradient_boosting", _shares("GradientBoosting"))(_importances(churn_models.BOOSTING))

_TEST_SIDE = """(SELECT customer_id, churn, row_number() OVER (PARTITION BY churn ORDER BY md5(customer_id || '|42'), customer_id)
  <= ceil(count(*) OVER (PARTITION BY churn) * 0.2::DOUBLE) AS is_test FROM training)"""


@query(
    "i11_churn_predictions",
    sql(f"SELECT customer_id, churn, true AS decided, true AS share FROM {_TEST_SIDE} WHERE is_test", "training"),
)
def i11(spark, folder):
    """Every row of the test side has a probability, and a decision that follows from it."""
    train, test = _train(spark, folder)
    scored = churn_models.predict(test, churn_models.fit(churn_models.LOGISTIC, train))
    sure = F.col("churn_probability")
    return scored.select(
        "customer_id",
        "churn",
        ((F.col("is_churn") == (sure > 0.5).cast("int")) | (sure == 0.5)).alias("decided"),
        sure.between(0, 1).alias("share"),
    )


@query("i12_accuracy", "SELECT avg(CAST(quality = toxic AS INTEGER)) AS accuracy FROM labels")
def i12(spark, folder):
    return metrics.accuracy(star.table(spark, folder, "labels"), "quality", "toxic")


define(
    "label_scores",
    """SELECT class, hits, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS precision,
  CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall, support
FROM (SELECT class, count(*) FILTER (quality = class AND toxic = class) AS hits,
  count(*) FILTER (toxic = class) AS predicted, count(*) FILTER (quality = class) AS support
  FROM labels, (SELECT DISTINCT unnest([quality, toxic]) AS class FROM labels) GROUP BY class)""",
)
define(
    "label_f1",
    """SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1
FROM label_scores""",
    "label_scores",
)


@query(
    "i13_classification_report",
    sql(
        f"""SELECT CAST(class AS VARCHAR) AS "row", {even('precision', 9)} AS precision, {even('recall', 9)} AS recall,
  {even('f1', 9)} AS f1, support FROM label_f1
UNION ALL SELECT 'accuracy', {even('sum(hits) / sum(support)', 9)}, {even('sum(hits) / sum(support)', 9)},
  {even('sum(hits) / sum(support)', 9)}, CAST(sum(support) AS BIGINT) FROM label_f1
UNION ALL SELECT 'macro avg', {even('avg(precision)', 9)}, {even('avg(recall)', 9)}, {even('avg(f1)', 9)},
  CAST(sum(support) AS BIGINT) FROM label_f1
UNION ALL SELECT 'weighted avg', {even('sum(precision * support) / sum(support)', 9)},
  {even('sum(recall * support) / sum(support)', 9)}, {even('sum(f1 * support) / sum(support)', 9)},
  CAST(sum(support) AS BIGINT) FROM label_f1""",
        "label_f1",
    ),
)
def i13(spark, folder):
    report = metrics.classification_report(star.table(spark, folder, "labels"), "quality", "toxic")
    return rounded(report, 9, "precision", "recall", "f1")


query("i14_model_weights", sql(_solved(_SEG, "'LogisticRegression' AS model"), "training"))(_solution(_SEG))


_CONSISTENT = f"""SELECT model, 90 AS cutoff_days, {even('(SELECT avg(churn) FROM training)', 9)} AS churn_rate, true AS consistent
FROM (VALUES ('LogisticRegression'), ('RandomForest'), ('GradientBoosting')) AS m(model)"""


def _consistent(table):
    """One row per candidate whose F1 is the harmonic mean of its precision and recall."""
    precision, recall = F.col("churn_precision"), F.col("churn_recall")
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    fits = (F.abs(f1 - F.col("churn_f1")) < 1e-9) & F.col("accuracy").between(0, 1)
    return rounded(table, 9, "churn_rate").select("model", "cutoff_days", "churn_rate", fits.alias("consistent"))


@query("i15_candidate_comparison", sql(_CONSISTENT, "training"))
def i15(spark, folder):
    return _consistent(churn_models.compare_candidates(fx.churn_training_frame(spark, folder))[1])


_THRESHOLDS = (60, 90, 120)


@query(
    "i16_promotion_gate",
    sql(
        f"""SELECT version, {even('f1', 9)} AS churn_f1, {even('active_score', 9)} AS active_score, f1 >= active_score AS promoted,
  version = max(CASE WHEN f1 >= active_score THEN version END) OVER () AS in_production
FROM (SELECT *, greatest(0.0::DOUBLE, coalesce(max(f1) OVER (ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS active_score
  FROM (SELECT version, CASE WHEN hits = 0 THEN 0 ELSE
      2 * (hits / predicted) * (hits / actual) / (hits / predicted + hits / actual) END AS f1
    FROM (SELECT version, count(*) FILTER (recency > days AND churn = 1) AS hits,
      count(*) FILTER (recency > days) AS predicted, count(*) FILTER (churn = 1) AS actual
      FROM training, (VALUES (1, 60), (2, 90), (3, 120)) AS v(version, days) GROUP BY version)))""",
        "training",
    ),
)
def i16(spark, folder):
    """Gate over three versions of a rule: churned when not seen for so many days."""
    versions = F.array(
        *[F.struct(F.lit(i).alias("version"), F.lit(d).alias("days")) for i, d in enumerate(_THRESHOLDS, start=1)]
    )
    scored = (
        fx.churn_training_frame(spark, folder)
        .select("recency", "churn", F.inline(versions))
        .withColumn("prediction", (F.col("recency") > F.col("days")).cast("int"))
    )
    gated = metrics.promotion_gate(metrics.binary_scores(scored, ["version"]), "version")
    return rounded(gated, 9, "churn_f1", "active_score").select(
        "version", "churn_f1", "active_score", "promoted", "in_production"
    )


_EXPERIMENTS = {"all_features": _SEG, "recency_frequency": _SEG[:2], "frequency_value": _SEG[1:]}


@query(
    "i17_feature_set_sweep",
    sql(
        f"""SELECT experiment, feature_set, 4 AS n_clusters, true AS scored, customers, {even('customers * features', 3)} AS squares
FROM (SELECT CAST(count(*) FILTER (NOT is_test) AS BIGINT) AS customers FROM (SELECT row_number() OVER (ORDER BY md5(customer_id || '|42'), customer_id)
    <= ceil(count(*) OVER () * 0.2::DOUBLE) AS is_test FROM rfm)),
  (VALUES {', '.join(f"('{name}', '{','.join(columns)}', {len(columns)})" for name, columns in _EXPERIMENTS.items())})
    AS e(experiment, feature_set, features)""",
        "rfm",
    ),
)
def i17(spark, folder):
    """Each set is fitted on the whole training side; columns of unit variance have a squared length of their number per row."""
    swept = segmentation.feature_set_sweep(fx.features(spark, folder), _EXPERIMENTS)
    return rounded(swept, 3, "squares").withColumn("scored", F.col("silhouette").between(-1, 1)).drop("silhouette")


@query(
    "i18_cutoff_frames",
    sql(f"SELECT cutoff_days, customer_id, {FEATURES}, churn FROM frames", "frames"),
)
def i18(spark, folder):
    return churn.training_frames(fx.enriched(spark, folder), [90, 120, 180])


@query(
    "i18_cutoff_coefficients",
    sql(_solved(_SEG, "cutoff_days", "frames", "cutoff_days", "coefficient"), "frames"),
)
def i18_models(spark, folder):
    found = rounded(churn_models.cutoff_sensitivity(fx.enriched(spark, folder)), 4, "coefficient")
    return found.withColumn("coefficient", F.col("coefficient") + F.lit(0.0))


@query("i19_saved_model", sql(f"SELECT customer_id, true AS same FROM {_TEST_SIDE} WHERE is_test", "training"))
def i19(spark, folder):
    """A loaded model says what the one that was saved says."""
    train, test = _train(spark, folder)
    root = working_path(spark, "models")
    model = churn_models.fit(churn_models.LOGISTIC, train)
    churn_models.save_model(model, root, "churn", 1)
    loaded = churn_models.predict(test, churn_models.load_model(root, "churn", 1))
    both = churn_models.predict(loaded.withColumnsRenamed({"is_churn": "_c", "churn_probability": "_p"}), model)
    same = (F.col("is_churn") == F.col("_c")) & (F.col("churn_probability") == F.col("_p"))
    return both.select("customer_id", same.alias("same"))


@query("i20_segmentation_job", sql("SELECT customer_id, true AS as_in_profile FROM rfm", "rfm"))
def i20(spark, folder):
    output = working_path(spark, "segmentation")
    segmentation.segmentation_job(fx.features(spark, folder), ks=(3, 4), output=output)
    sides = [spark.read.parquet(f"{output}/{side}") for side in ("train_clusters", "customer_clusters")]
    profile = spark.read.parquet(f"{output}/cluster_profile").select("cluster", F.col("segment").alias("_wanted"))
    both = sides[0].select("customer_id", "cluster", "segment").unionByName(sides[1].select("customer_id", "cluster", "segment"))
    return both.join(profile, "cluster").select("customer_id", (F.col("segment") == F.col("_wanted")).alias("as_in_profile"))


@query(
    "i21_training_frame",
    sql(f"SELECT customer_id, {FEATURES}, churn FROM training", "training"),
)
def i21_frame(spark, folder):
    return churn.training_frame(fx.enriched(spark, folder))


@query("i21_churn_job", sql(f"SELECT *, 1 AS production FROM ({_CONSISTENT})", "training"))
def i21(spark, folder):
    """All three candidates, and the first version in production."""
    output = working_path(spark, "churn")
    churn_models.churn_job(fx.enriched(spark, folder), output=output)
    chosen = spark.read.parquet(f"{output}/production").agg(F.max("version")).scalar()
    return _consistent(spark.read.parquet(f"{output}/model_metrics")).withColumn("production", chosen)


@query(
    "i21_models_in_use",
    sql("SELECT customer_id, 1 AS model_version, true AS named, true AS refused FROM rfm", "rfm"),
)
def i21_models(spark, folder):
    """Both models of a training job are in use, a worse version does not replace them, and they name every customer."""
    output, bought = working_path(spark, "models"), materialize(fx.transactions(spark, folder), "transactions")
    jobs.training_job(bought, output, 1)
    refused = not registry.publish(spark, output, 2, {}, -1.0)
    named = jobs.with_model_segment(spark, fx.stored_features(spark, folder), output)
    scored = churn_models.predict(named, registry.load(spark, output, jobs.CHURN))
    known = [row["segment"] for row in registry.table(spark, output, jobs.PROFILE).collect()]
    return scored.select(
        "customer_id",
        F.lit(registry.in_use(spark, output).model_version).alias("model_version"),
        (F.col("segment").isin(known) & F.col("churn_probability").between(0, 1)).alias("named"),
        F.lit(refused).alias("refused"),
    )
