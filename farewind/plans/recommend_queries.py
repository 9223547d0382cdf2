"""Route recommendations.

What the model recommends cannot be worked out in SQL, but what must hold of it can; the tables
built from recommendations are checked on each user's most frequent routes.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farewind.functions import rating_preference
from farewind.operators import recommend
from farewind.plans.bindings import FARES_SQL, comparable
from farewind.plans.fare_queries import PRICE_RANGE_SQL, index_sql, rated_inputs
from farewind.scratch import stored

_K, _OFTEN = 10, 3


def _model(spark, sf_dir):
    """The model fitted to every rated fare, the ratings, the rows, and the label table of routes."""
    rows, tables = rated_inputs(spark, sf_dir, "Airline", "Route")
    rated = rows.select(
        "userId", "route_index", rating_preference("Price", "minutes", "airline_index").alias("rating")
    )
    rated = stored(rated, "ratings")
    return recommend.fit_routes(rated), rated, rows, tables["Route"]


def _recommended(spark, sf_dir):
    """The model's recommendations, and the label table of routes."""
    model, _, _, labels = _model(spark, sf_dir)
    return recommend.recommend_routes(model, labels, _K), labels


def recommend_top_exact(spark, sf_dir):
    """Users with ids divisible by 100: whether the model's list is the best of all routes."""
    model, rated, _, labels = _model(spark, sf_dir)
    users = rated.filter("userId % 100 = 0").select("userId").distinct()
    exact = recommend.best_routes_exact(model, users, _K).select("userId", "rank", F.col("rating").alias("best"))
    listed = recommend.recommend_routes(model, labels, _K).filter("userId % 100 = 0")
    met = exact.join(listed, ["userId", "rank"], "full")
    near = F.abs(F.col("best") - F.col("rating")) <= 1e-4 * (1 + F.abs("best"))
    return met.groupBy("userId").agg(F.count("best").alias("n"), F.every(F.coalesce(near, F.lit(False))).alias("agree"))


def recommend_fit(spark, sf_dir):
    """Per user: ratings fitted, and whether the user's factors solve their equations."""
    model, rated, _, _ = _model(spark, sf_dir)
    return recommend.fit_residuals(model, rated).select("userId", "n", (F.col("residual") < 1e-3).alias("solved"))


def recommend_labels(spark, sf_dir):
    """The route that each item of the model stands for."""
    model, _, _, labels = _model(spark, sf_dir)
    items = model.itemFactors.select(F.col("id").alias("ridx"))
    return recommend.labels_for(items, labels, "ridx", "route").select("ridx", "route")


def recommend_with_prices_model(spark, sf_dir):
    """The full table of the model's recommendations: rows, routes and fares of each user and band."""
    model, _, rows, labels = _model(spark, sf_dir)
    full = recommend.recommend_with_prices(model, labels, rows, _K, lists=False)
    return full.groupBy("userId", "price_range").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("route").alias("routes"),
        F.min("Price").alias("cheapest"), F.max("Price").alias("dearest"), F.sum("Price").alias("prices"),
    )


def recommend_with_source_model(spark, sf_dir):
    """The model's recommendations as (source, route) rows: how many each user's list gives."""
    model, _, rows, labels = _model(spark, sf_dir)
    pairs = recommend.recommend_with_source(recommend.recommend_routes(model, labels, _K), rows)
    known = recommend.route_sources(rows).select(F.col("Route").alias("route"), F.col("Source").alias("source"))
    return pairs.join(known, "route", "left").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("source") == F.col("source_des")).alias("right")
    )


def recommend_routes(spark, sf_dir):
    """Per user: entries, entries whose index and route agree, and whether ratings fall with rank."""
    recs, labels = _recommended(spark, sf_dir)
    names = labels.columns(idx="ridx", label="label")
    agree = recs.join(names.withColumn("ridx", F.col("ridx").cast("int")), "ridx", "left")
    by_rank = F.transform(
        F.sort_array(F.collect_list(F.struct("rank", "rating"))), lambda entry: entry["rating"]
    )
    falling = F.sort_array(F.collect_list("rating"), asc=False)
    return agree.groupBy("userId").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("label") == F.col("route")).alias("named"),
        (by_rank == falling).alias("falling"),
    )


def recommend_coverage(spark, sf_dir):
    """Per user: how many routes were recommended, how many of them differ, and their ranks."""
    recs, _ = _recommended(spark, sf_dir)
    return recs.groupBy("userId").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("route").alias("routes"),
        F.min("rank").alias("first_rank"),
        F.max("rank").alias("last_rank"),
    )


def _most_frequent(rows):
    """Each user's most frequent routes, as recommendations."""
    often = rows.groupBy("userId", F.col("Route").alias("route")).agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("userId").orderBy(F.desc("n"), F.asc("route"))
    return often.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= _OFTEN).drop("n")


def attach_fares(spark, sf_dir):
    """Each user's most frequent routes next to each of the user's fares."""
    rows, _ = rated_inputs(spark, sf_dir)
    return recommend.attach_fares(_most_frequent(rows).select("userId", "route"), rows)


def recommend_with_source(spark, sf_dir):
    rows, _ = rated_inputs(spark, sf_dir)
    return recommend.recommend_with_source(_most_frequent(rows), rows)


def recommend_with_prices(spark, sf_dir):
    """The full table: rank, index and route of an entry next to the user's fares and their bands."""
    rows, tables = rated_inputs(spark, sf_dir, "Route")
    names = tables["Route"].columns(label="route", idx="ridx")
    recs = _most_frequent(rows).join(names, "route")
    return comparable(recommend.attach_fares(recs, rows))


_BOUGHT = f"""{FARES_SQL}, bought AS (
  SELECT fares.*, cast(o_custkey AS int) AS userId FROM fares JOIN orders ON l_orderkey = o_orderkey
), top AS (
  SELECT userId, Route AS route,
    cast(row_number() OVER (PARTITION BY userId ORDER BY count(*) DESC, Route) AS int) AS rank
  FROM bought GROUP BY userId, Route
), recs AS (SELECT * FROM top WHERE rank <= {_OFTEN})"""

_PER_USER = f"""
WITH {FARES_SQL}, sizes AS (SELECT least({_K}, count(DISTINCT Route)) AS k FROM fares),
users AS (SELECT DISTINCT cast(o_custkey AS int) AS userId FROM fares JOIN orders ON l_orderkey = o_orderkey)"""

QUERIES = {
    "attach_fares": (
        attach_fares,
        f"""
WITH {_BOUGHT}
SELECT recs.userId, recs.route, b.Airline, b.Price, {PRICE_RANGE_SQL} AS price_range
FROM recs JOIN bought b ON recs.userId = b.userId""",
    ),
    "recommend_routes": (
        recommend_routes,
        f"{_PER_USER} SELECT userId, k AS n, k AS named, true AS falling FROM users, sizes",
    ),
    "recommend_coverage": (
        recommend_coverage,
        f"""{_PER_USER}
SELECT userId, k AS n, k AS routes, 1 AS first_rank, cast(k AS int) AS last_rank FROM users, sizes""",
    ),
    "recommend_top_exact": (
        recommend_top_exact,
        f"{_PER_USER} SELECT userId, k AS n, true AS agree FROM users, sizes WHERE userId % 100 = 0",
    ),
    "recommend_fit": (
        recommend_fit,
        f"WITH {_BOUGHT} SELECT userId, count(*) AS n, true AS solved FROM bought GROUP BY userId",
    ),
    "recommend_labels": (
        recommend_labels,
        f"WITH {_BOUGHT}, {index_sql('Route', 'routes')} SELECT cast(idx AS int) AS ridx, label AS route FROM routes",
    ),
    "recommend_with_prices_model": (
        recommend_with_prices_model,
        f"""
WITH {_BOUGHT}, sizes AS (SELECT least({_K}, count(DISTINCT Route)) AS k FROM fares)
SELECT userId, {PRICE_RANGE_SQL} AS price_range, count(*) * any_value(k) AS n, any_value(k) AS routes,
  min(Price) AS cheapest, max(Price) AS dearest, cast(sum(Price) * any_value(k) AS bigint) AS prices
FROM bought b, sizes GROUP BY ALL""",
    ),
    "recommend_with_source_model": (
        recommend_with_source_model,
        f"{_PER_USER} SELECT count(*) * any_value(k) AS n, count(*) * any_value(k) AS right FROM users, sizes",
    ),
    "recommend_with_source": (
        recommend_with_source,
        f"""
WITH {_BOUGHT}, pairs AS (
  SELECT Route, Source, row_number() OVER (PARTITION BY Route ORDER BY count(*) DESC, Source) AS rn
  FROM bought GROUP BY Route, Source)
SELECT pairs.Source AS source_des, recs.route FROM recs
JOIN pairs ON pairs.Route = recs.route AND rn = 1""",
    ),
    "recommend_with_prices": (
        recommend_with_prices,
        f"""
WITH {_BOUGHT}, {index_sql("Route", "routes")}
SELECT recs.userId, recs.route, recs.rank, idx AS ridx, b.Airline, b.Price,
  {PRICE_RANGE_SQL} AS price_range
FROM recs JOIN routes ON routes.label = recs.route JOIN bought b ON recs.userId = b.userId""",
    ),
}
